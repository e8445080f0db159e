"""Every operator against its plain version, on driver rows and on odd rows."""
import brute
import pytest
from conftest import pairs

from scorelake.llm import decontaminate, lm, mixing, quality_rules, queries, repeats, simhash, token_store


def ordered(rows):
    return sorted(rows, key=repr)


TABLES = ["docs", "odd", "extra", "nothing"]


@pytest.fixture(params=TABLES)
def table(request):
    return request.getfixturevalue(request.param)


def test_tokens(table):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    got = token_store.stored_digest(table, queries.tokenizer_path(), shard_bytes=40_000, part_keys=50).drop("shard")
    want = brute.tokens(pairs(table), tokenizer)
    rows = pairs(got, "doc_id", "start", "n_tokens", "ids_crc32")
    # Rows of one id may stand in any order, so starts are compared as positions.
    assert ordered((d, n, c) for d, _, n, c in rows) == ordered((d, n, c) for d, _, n, c in want)
    at = 0
    for d, start, n, _ in sorted(rows, key=lambda r: r[1]):
        assert start == at
        at += n
    assert [d for d, *_ in sorted(rows, key=lambda r: r[1])] == [d for d, *_ in want]


def test_mix(table):
    plan = mixing.plan_mix(table).collect()
    sizes = {}
    for _, text, source in pairs(table, "doc_id", "text", "source"):
        sizes[source] = sizes.get(source, 0) + len(brute.SPACED.findall(text or ""))
    want = brute.targets(sizes, (5, 2, 1), 1.5, 2.0)
    assert ordered((r["doc_id"], r["size"]) for r in plan) == ordered((d, len(brute.SPACED.findall(t or ""))) for d, t in pairs(table))
    for r in plan:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        assert (r["position"] is not None) == (r["copies"] > 0) and (r["position_2"] is not None) == (r["copies"] > 1)
        assert 0 <= (r["position"] or 0) <= 1 and 0 <= (r["position_2"] or 0) <= 1
    for source in sizes:
        mine = [r for r in plan if r["source"] == source]
        assert abs(sum(r["taken"] for r in mine) - want[source]) <= max(r["size"] for r in mine)


def test_mix_reruns_agree(docs):
    a, b = (ordered(map(tuple, mixing.plan_mix(d).collect())) for d in (docs, docs.repartition(7)))
    assert a == b


def test_lm(table):
    for order in (1, 2, 3):
        key = lambda r: (repr(r[0]), r[1], round(r[2], 3))
        got = sorted(pairs(lm.lm_scores(table, order=order), "doc_id", "n_words", "log_score", "n_backoff"), key=key)
        want = sorted(brute.lm(pairs(table), order, 0.4), key=key)
        assert [(a, b, d) for a, b, _, d in got] == [(a, b, d) for a, b, _, d in want]
        assert [c for _, _, c, _ in got] == pytest.approx([c for _, _, c, _ in want], rel=1e-9)


def test_decontaminate(spark, table):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text")
    items = items.unionByName(spark.createDataFrame(
        [(900, "The the THE"), (901, "eight a shared passage that is long enough to be found again a"), (902, None), (903, ""), (904, "word1 tail"), (904, "no id here"), (None, "One")],
        "item_id long, text string"))
    got = decontaminate.contamination(table, items)
    assert ordered(pairs(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) == ordered(brute.contamination(pairs(table), pairs(items, "item_id", "text"), 10))


def test_decontaminate_in_passes(docs, spark):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    index = decontaminate.build_index(docs)
    phrases = decontaminate.phrases_of(items)
    once = decontaminate.matches(index, phrases)
    often = decontaminate.matches(index, phrases, per_pass=100)
    spread = lambda df: {(r["row"], p) for r in df.collect() for p in r["positions"]}
    assert spread(once) == spread(often) and spread(once)


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "red apples and then green pears"), (2, "green x x x x x x x x red"), (3, "pears"), (4, "green red")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "red green")], "item_id long, text string")
    index = decontaminate.build_index(docs)
    near = decontaminate.matches(index, decontaminate.phrases_of(items), slop=4)
    ids = {r["row"]: r["id"] for r in decontaminate.word_counts(index[1]).collect()}
    assert {ids[r["row"]] for r in near.collect()} == {1, 4}
    exact = decontaminate.matches(index, decontaminate.phrases_of(items))
    assert exact.count() == 0


@pytest.mark.parametrize("max_bits", [0, 2, 5])
def test_simhash(table, max_bits):
    got = simhash.near_duplicates(table, max_bits=max_bits)
    assert ordered(pairs(got, "doc_id", "fingerprint", "component_id")) == ordered(brute.components(pairs(table), max_bits))


def test_simhash_links_are_all_close_pairs(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    flips = [b ^ (np.uint64(1) << np.uint64(i)) ^ (np.uint64(1) << np.uint64(j)) for b in base[:100] for i, j in rng.integers(0, 64, (4, 2))]
    fps = np.unique(np.concatenate([base, np.array(flips, np.uint64)]))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    got = {tuple(sorted((a % (1 << 64), b % (1 << 64)))) for a, b in pairs(simhash.links(df), "a", "b")}
    want = {(int(fps[i]), int(fps[j])) for i in range(len(fps)) for j in range(i + 1, len(fps)) if int(fps[i] ^ fps[j]).bit_count() <= 2}
    assert got == want


@pytest.mark.parametrize("length", [200, 51])
def test_repeats(table, length):
    rows = [r for r in pairs(table)]
    got = repeats.dedup_repeats(table, length=length)
    assert ordered(pairs(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) == ordered(brute.repeats(rows, length))


def test_quality_rules(table):
    got = quality_rules.quality_rules(table)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert ordered(pairs(got, *names)) == ordered(brute.quality(pairs(table), quality_rules.NGRAM_LIMITS, quality_rules.LINE_LIMIT))

"""Ranked search, line dedup and the conversation trie against their plain versions."""
import random

import brute
import pytest
from conftest import pairs
from pyspark.sql import functions as F

from scorelake.llm import line_runs, prefix_trie, ranked_search

TABLES = ["docs", "odd", "extra", "nothing"]
TURNS = "conv_id long, turn long, role string, text string"


@pytest.fixture(params=TABLES)
def table(request):
    return request.getfixturevalue(request.param)


def ordered(rows):
    return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(900, "The the THE"), (901, "one two word1 TAIL eight"), (902, None), (903, ""), (904, "x-y"), (904, "no id here"), (None, "One héllo wörld"), (905, "passage shared found again the")]
    given = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text")
    return given.unionByName(spark.createDataFrame(rows, "item_id long, text string")).withColumn("score", F.lit("clash")).withColumn("rank", F.lit("clash"))


@pytest.mark.parametrize("segment_docs, block_items", [(8192, 256), (5, 7)])
def test_search(table, items, segment_docs, block_items):
    got = ranked_search.ranked_search(table, items, segment_docs=segment_docs, block_items=block_items)
    want = brute.search(pairs(table), pairs(items, "item_id", "text"), 10)
    assert ordered(pairs(got, "item_id", "rank", "doc_id", "score")) == ordered(want)


def test_search_with_all_postings(docs, items, monkeypatch):
    monkeypatch.setattr(ranked_search, "MANY_TERMS", 0)
    monkeypatch.setattr(ranked_search, "BROADCAST_TERMS", 0)
    got = ranked_search.ranked_search(docs, items, k=3)
    assert ordered(pairs(got, "item_id", "rank", "doc_id", "score")) == ordered(brute.search(pairs(docs), pairs(items, "item_id", "text"), 3))


def test_search_without_items(docs, items):
    assert ranked_search.ranked_search(docs, items.limit(0)).count() == 0


def test_search_prunes_without_loss(spark):
    """Ties at the bar, many frequent terms: pruned bundles give what whole scoring gives."""
    rng = random.Random(7)
    words = [f"w{int(rng.paretovariate(0.7)) % 300}" for _ in range(40_000)]
    rows = [(i % 900, " ".join(words[i * 20 : i * 20 + rng.randrange(1, 40)])) for i in range(1900)]
    asks = [(i, " ".join(rng.choices(words, k=12))) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    got = ranked_search.ranked_search(docs, spark.createDataFrame(asks, "item_id long, text string"))
    want = brute.search(rows, asks, 10)
    assert ordered(pairs(got, "item_id", "rank", "doc_id", "score")) == ordered(want)


def test_search_text_ids(spark):
    docs = spark.createDataFrame([("b", "red pear"), ("a", "red pear"), (None, "red pear"), ("c", "none"), ("d", "")], "doc_id string, text string")
    got = ranked_search.ranked_search(docs, spark.createDataFrame([("q", "red")], "item_id string, text string"))
    assert [r[1] for r in sorted(pairs(got, "rank", "doc_id"))] == ["a", "b", None]


@pytest.mark.parametrize("min_chars, min_docs", [(40, 5), (3, 2)])
def test_lines(table, min_chars, min_docs):
    got = line_runs.dedup_lines(table, min_chars=min_chars, min_docs=min_docs)
    assert ordered(pairs(got, "doc_id", "n_lines", "n_dropped", "kept")) == ordered(brute.lines(pairs(table), min_chars, min_docs))


@pytest.mark.parametrize("fan_out", [2, 3])
def test_lines_through_many_runs(spark, fan_out):
    """More batches than a level holds runs, so runs are compacted over three levels."""
    rng = random.Random(5)
    common = [f"{c * 45} line" for c in "abcdefgh"] + ["\r\t " + "A" * 45 + " LINE \f", "short"]
    rows = [(rng.choice([i, 7, None]), "\n".join(rng.choices([*common, f"{i} " + "own line of its own " * 3, ""], k=rng.randrange(1, 9)))) for i in range(400)]
    rows += [(1000, common[0]), (1000, common[0] + "\n" + common[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_runs.dedup_lines(df, batch_lines=100, fan_out=fan_out)
    want = brute.lines(rows, 40, 5)
    assert sum(n for _, _, n, _ in want) > 300
    assert ordered(pairs(got, "doc_id", "n_lines", "n_dropped", "kept")) == ordered(want)


def test_lines_of_one_third(spark):
    """A line and an id that a third of all rows hold."""
    rows = [(None if i % 3 == 0 else i, "z" * 50 + "\nrest") for i in range(900)]
    got = line_runs.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert ordered(pairs(got, "doc_id", "n_lines", "n_dropped", "kept")) == ordered(brute.lines(rows, 40, 5))


def test_runs_hold_each_line_once(spark):
    store = line_runs.LineRuns(spark, fan_out=2)
    for batch in ([(1, 2, 9), (2, 1, 8)], [(2, 3, 5)], [(1, 1, 4), (3, 1, 3)]):
        store.add(spark.createDataFrame(batch, "h long, n long, last long"))
    assert [len(level) for level in store.levels] == [1, 1]
    assert ordered(map(tuple, store.totals().collect())) == [(1, 3, 9), (2, 4, 8), (3, 1, 3)]
    base = store.base
    store.drop()
    assert not spark.catalog.databaseExists(base)


def turns(kind, spark):
    rng = random.Random(11)
    if kind == "given":
        return pairs(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"), "conv_id", "turn", "role", "text")
    if kind == "odd":
        rows = [(c, t, rng.choice(["user", None, ""]), rng.choice(["a b", "a  b", None, "", "x"])) for c in range(60) for t in rng.sample([None, 0, 1, 2, 5, -3], rng.randrange(1, 6))]
        return rows + [(None, 1, "user", "lost"), (None, None, None, None), (-5, 0, "user", "below zero"), (-20, 0, "user", "base"), (3, 9, "user", "same"), (3, 9, "user", "same"), (10**15 + 7, 0, "user", "far")]
    if kind == "deep":
        # Chains of 3,000 turns that part late, and one that ends inside another.
        return [(c, t, "user", f"turn {t} of {c if t > cut else 0}") for c, n, cut in [(20, 3000, 9999), (21, 2990, 2000), (22, 1500, 9999), (23, 2500, 2400)] for t in range(n)]
    # A third of all conversations are copies of one.
    return [(c, t, "user", f"copy {t}" if c % 3 == 0 else f"{c} {t}") for c in range(300) for t in range(5)]


@pytest.mark.parametrize("local_weight", [4096, 40, 1])
@pytest.mark.parametrize("kind", ["given", "odd", "copies"])
def test_trie(spark, kind, local_weight):
    rows = turns(kind, spark)
    df = spark.createDataFrame(rows, TURNS).withColumn("depth", F.lit("clash")).withColumn("conv", F.lit("clash"))
    got = [tuple(r) for r in prefix_trie.conversation_trie(df, local_weight=local_weight).collect()]
    assert ordered(got) == ordered(brute.trie(rows))


def test_trie_of_deep_chains(spark):
    rows = turns("deep", spark)
    df = spark.createDataFrame(rows, TURNS)
    got = {(r["conv_id"], r["depth"]): r for r in prefix_trie.conversation_trie(df, cycle=1, shared=1).collect()}
    assert len(got) == 1 + 3000 + 989 + 99 and got[20, 0]["n_leaves"] == 3
    assert [got[20, d]["n_convs"] for d in (0, 1500, 1501, 2001, 2002, 2402, 2501)] == [4, 4, 3, 3, 2, 1, 1]
    # Turn t (from 0) lies at depth t + 1; its text has four words.
    shared = {20: [(1, 1500, 3), (1501, 2001, 2), (2002, 2401, 1)]}[20]
    for d in (0, 700, 1501, 2300, 2900):
        assert got[20, d]["saved_tokens"] == sum(4 * n * max(0, b - max(a, d) + 1) for a, b, n in shared)


def test_trie_ties_do_not_depend_on_layout(spark):
    rows = [(c, t // 2, "user", f"text {t}") for c in range(8) for t in range(6)]
    df = spark.createDataFrame(rows, TURNS)
    a, b = (ordered(map(tuple, prefix_trie.conversation_trie(x).collect())) for x in (df, df.repartition(5)))
    assert a == b


def test_trie_of_nothing(spark):
    got = prefix_trie.conversation_trie(spark.createDataFrame([(None, 1, "user", "x")], TURNS))
    assert got.count() == 0 and got.columns[0] == "conv_id"

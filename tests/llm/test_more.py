"""Page text, URL filter, quality model, token lookup, index and pipeline."""
import html
import re

import brute
import duckdb
import numpy as np
import pytest
from conftest import pairs
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from scorelake.llm import bytescan, html_extract, mixing, quality_model, queries, simhash, token_store, url_filter
from scorelake.llm.oracle import ORACLES

SF = "/root/testdata/sf0.001"


def test_pages_hold_their_article(spark):
    """On the driver's pages: the blocks between the article's tags, read by a plain parser."""
    def article(page):
        body = page[page.index("<article>") + 9 : page.index("</article>")]
        blocks = re.split(r"</?(?:p|h1)\b[^>]*>", body)
        texts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "<br" in b else "", b)).split()) for b in blocks)
        return "\n".join(t for t in texts if t)

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_extract.extract_main_text(pages).collect()}
    for r in pages.collect():
        want = article(r["html"])
        assert got[r["page_id"]] == (want, len(want))


CASES = [
    ("", ""), (None, ""), ("plain", "plain"), ("<article><p>One.</p></article>", "One."),
    ("<article><h1>T &amp; U</h1><p>a&nbsp;b\n  c<b>d</b></p><ul><li>x<li>y</ul></article><aside><p>no</p></aside>", "T & U\na b cd\nx\ny"),
    ("<article><p>keep<div class='ad'>buy</div><p>too</article><footer>no</footer>", "keep\ntoo"),
    ("<header><h1>site</h1></header><main><h1>in</h1><p>body text</p><form><p>mail</p></form></main>", "in\nbody text"),
    ("<div class='cookie-notice'>we use cookies</div><article><p>text &lt;b&gt;</p><script>if (a<b) {'</p>'}</script><!-- <p>no</p> --></article>", "text <b>"),
    ("<article><p>a</p></article><section class='comments'><p>a reader says a lot of words here</p></section>", "a"),
    ("<article class='post'><p>a</p><div id=comments><p>reader</p></div><style>p{}</style></article>", "a"),
    ("<article><p title=\"a > b\">quoted</p><p>unclosed", "quoted\nunclosed"),
    ("<nav><p>" + "menu words " * 30 + "</p></nav><article><p>short</p></article>", "short"),
]


def test_pages_by_hand(spark):
    df = spark.createDataFrame([(i, "u", p, "clash") for i, (p, _) in enumerate(CASES)], "page_id long, url string, html string, text string")
    got = dict(pairs(html_extract.extract_main_text(df), "page_id", "text"))
    assert got == {i: want for i, (_, want) in enumerate(CASES)}
    assert html_extract.extract_main_text(df.limit(0)).count() == 0


#: Pages that no sample was made from; the label of a block is its first word.
HELD_OUT = [
    "<html><head><title>drop</title><body><div id=top><a href=/>drop Daily</a> <a href=/in>sign in</a></div><div><a href=/a>drop Home</a></div><div><a href=/b>drop News</a></div>"
    "<h1>keep A long walk</h1><div>keep By the river, in the morning, with nobody about.</div><div>keep Then rain.</div><div><a href=/full>keep the whole of this line is one link</a></div>"
    "<div>keep And home again before noon.</div><div><a href=/1>drop Ten more walks</a></div><div><a href=/2>drop Five more walks</a></div><div><a href=/3>drop One more walk</a></div>",
    "<body><nav><ul><li><a href=/>drop Start</a><li><a href=/x>drop Shop</a></ul></nav><main><h2>keep Soup</h2><ul><li>keep two onions<li>keep salt<li><a href=/leek>keep one leek</a></ul>"
    "<p>keep Boil it all.</p><aside>drop Our book</aside></main><div class='related-posts'><a href=/s>drop Stew</a></div><footer>drop (c) us</footer></body>",
    "<div class='site-header'><div>drop The Paper</div></div><table><tr><td><a href=/m>drop Menu</a><tr><td><a href=/n>drop Other</a></table><div class='entry'><div class='entry-header'><h1>keep Votes</h1></div>"
    "<p>keep The count is in, said the clerk, and it is close.</p><div class='share-buttons'>drop Share this</div><p>keep A second count is due.</p></div>"
    "<div class='post-comments'><p>drop I do not believe a word of it, says a reader at length.</p></div>",
    "<body><article><h1>keep Title</h1><p>keep <a href=/q>quoted</a> text</p><blockquote>keep said twice</blockquote><figure><img src=x><figcaption>keep a boat</figcaption></figure></article>"
    "<div><p>drop unmarked text beside the article, quite long as it is, of no use</p></div><form><label>drop Name</label></form></body>",
]


def test_blocks_of_held_out_pages():
    """Precision and recall of main-text blocks on pages that the tree has not seen."""
    right = kept = wanted = 0
    for page in HELD_OUT:
        blocks = html_extract.blocks_of(page)
        chosen = html_extract.predict(html_extract.tree(), html_extract.features(blocks))
        truth = np.array([b.text.startswith("keep") for b in blocks])
        right, kept, wanted = right + int((chosen & truth).sum()), kept + int(chosen.sum()), wanted + int(truth.sum())
    assert right / kept >= 0.95 and right / wanted >= 0.95, (right, kept, wanted)


def test_tree_looks_at_neighbours():
    def used(node):
        return set() if node.low is None else {html_extract.FEATURES[node.feature]} | used(node.low) | used(node.high)

    assert {"links_before", "links_after"} <= used(html_extract.tree())


def test_broken_pages_lose_nothing_else():
    text = html_extract.main_text
    assert text("<html><head><title>t</title><body><article><p>a</p></article>") == "a"
    assert text("<article><video-player></video-player><p>x</p><object-x>y</object-x><math-block>z</math-block></article>") == "x\nyz"
    assert text("<article><svg width='1'/><p>a</p><math/><p>b</p></article>") == "a\nb"
    assert text("<article><svg><title>no</title><p>no</p></svg><script>no</script ><p>a</p></article>") == "a"
    assert text("<article><select><p>a</p><script>b</article>") == "a\nb"
    assert text("<div class='post-header'><h1>Head</h1></div><p>b</p>") == "Head\nb"
    assert text("word") == "word" and text("<p>one</p><p><a href=x>two is a link</a></p><p>three</p>") == "one\ntwo is a link\nthree"
    assert text("<header>site</header><p>first</p>") == "first"


def test_broken_pages_take_no_longer():
    import time

    n = 50_000
    start = time.perf_counter()
    for page in ("<b>" * n + "x</i>" * n, "<b>" * n + "<a href=x>y" * n, "<ul><li>" + "<b>" * n + "<li>" * n, "<svg>" * n + "x", "<select>" * n, "<table>" + "<tr><td>" * n, "<a href=x>" * n):
        html_extract.main_text(page)
    assert time.perf_counter() - start < 7


def test_length_alone_drops_no_block():
    """A page that marks no article: unlinked blocks of one word, and of scripts without spaces."""
    page = ("<body><header>site</header><h1>Introduction</h1><p>日本語の文章です。</p><p>Yes.</p><div>ข้อความภาษาไทย</div><p>some more words</p>"
            "<ul><li><a href='/x'>更多新闻</a></li></ul><div class='ad'>buy</div><p>中文段落</p></body>")
    assert html_extract.main_text(page).split("\n") == ["Introduction", "日本語の文章です。", "Yes.", "ข้อความภาษาไทย", "some more words", "中文段落"]
    assert [b.words for b in html_extract.blocks_of("<p>中文 and more</p><p>ไทย</p><p>über</p>")] == [4, 3, 1]


def test_enclosing_elements_count_at_any_depth():
    """A link, a heading and a paragraph six levels above the text; links that were never closed."""
    six, end = "<span>" * 5 + "<b>", "</b>" + "</span>" * 5
    card = "<a href='/x'><div><div><div><h3><span><b>Teaser of eight words that should not stay</b></span></h3></div></div></div></a>"
    assert html_extract.main_text(f"<body><div>{card}</div><p>real text of the page</p></body>") == "real text of the page"
    linked, plain = html_extract.blocks_of(f"<body><div>{card}</div><p>real text of the page</p></body>")
    assert (linked.linked, linked.heading, plain.linked, plain.heading) == (8, True, 0, False)
    assert html_extract.blocks_of(f"<h2>{six}deep title{end}</h2>")[0].heading
    first, second = html_extract.blocks_of(f"<p class='ad'>{six}buy<div>text</div>")
    assert first.boiler and not second.boiler
    blocks = html_extract.blocks_of("<body><a name=top><p>one</p><a href='/x'><p>two</p><a href='/y'>three</a><p>four</p></body>")
    assert [(b.text, b.linked) for b in blocks] == [("one", 0), ("two", 1), ("three", 1), ("four", 0)]


def test_tree_learns_its_samples():
    x, y = html_extract.labelled()
    assert (html_extract.predict(html_extract.tree(), x) == (y > 0.5)).all()


def test_urls_by_hand(spark):
    urls = [None, "", "no scheme", "HTTP://A.Example.ORG/es/1", "http://example.org/en/12?x", "http://sub.example.org/en/2", "http://x.com/fr/#a",
            "http://x.com/de/1", "http://x.com/de", "http://bad.net/p/", "http://www.bad.net/p?q", "http://bad.net/P", "http://bad.net/p", "x://", "http://?a://b/c"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, block string")
    listed = spark.createDataFrame([("https://bad.net/p",), (None,), ("https://bad.net/p/",)], "url string")
    rows = url_filter.filter_urls(pages, listed, queries.RULES).orderBy("page_id").collect()
    assert [r["rule"] for r in rows] == [None, None, None, "example.org/es/", "example.org/en/1", "org/", "com/fr/", "com/de/", None, None, None, None, None, None, None]
    assert [r["verdict"] for r in rows] == ["allow", "allow", "allow", "block", "block", "allow", "allow", "block", "allow", "block", "block", "allow", "block", "allow", "allow"]
    assert rows[3]["host"] == "a.example.org" and rows[6]["path"] == "/fr/" and rows[8]["path"] == "/de"
    none = url_filter.filter_urls(pages, listed.limit(0), queries.RULES)
    assert none.filter("verdict = 'block'").count() == 3 and none.count() == len(urls)


def test_bloom_filter_has_no_false_negative(spark):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("entry"))
    blocks = 200
    table = url_filter.bloom_filter(keys, "entry", blocks)
    probes = spark.range(9000).select(F.concat(F.lit("k"), "id").alias("entry"), (F.col("id") < 3000).alias("listed"))
    joined = probes.withColumn("block", url_filter.block_number(F.col("entry"), blocks)).join(table, "block", "left")
    maybe = F.lit(True)
    for i, w in enumerate(url_filter.WORDS):
        maybe = maybe & (F.call_function("shiftright", F.col(w), url_filter.bit_of(F.col("entry"), i)).bitwiseAND(F.lit(1)) == 1)
    got = {r["listed"]: r["share"] for r in joined.groupBy("listed").agg(F.avg(F.coalesce(maybe, F.lit(False)).cast("double")).alias("share")).collect()}
    assert got[True] == 1.0 and got[False] < 0.05


def test_quality_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = queries.op10_quality_model(spark, "/root/testdata/sf0.01")
    assert scored.count() == docs.count()
    held = scored.filter("held_out").join(labels, "doc_id").toPandas()
    assert (held["predicted"] == held["quality"]).mean() > 0.97
    good, bad = (held["score"][held["quality"] == q].to_numpy() for q in (1, 0))
    assert (good[:, None] > bad[None, :]).mean() > 0.98


def test_training_reads_every_word(spark, monkeypatch):
    """Training features of long texts are those that scoring takes."""
    import pyarrow as pa

    texts = [" ".join(f"w{i}x{j}" for j in range(n)) for i, n in enumerate((3, 600, 3000))]
    want, seen = quality_model.features(*bytescan.text_bytes(pa.array(texts)), np.full(3, np.nan), quality_model.WORD_BITS), []
    monkeypatch.setattr(quality_model, "fit", lambda f, *_: seen.append(f))
    quality_model.train(spark.createDataFrame([(i, t, i % 2) for i, t in enumerate(texts)], "doc_id long, text string, y int"), "y")
    runs = lambda f: sorted((f.word[a:b].tolist(), f.value[a:b].tolist()) for a, b in zip(f.first, f.first[1:]))
    assert runs(seen[0]) == runs(want) and np.diff(want.first).max() > 2000


def test_factorisation_identity(odd):
    """Scores in linear time equal the sum over all pairs."""
    rng = np.random.default_rng(5)
    n, bits = len(quality_model.STRUCTURE), 6
    model = quality_model.Model(0.3, rng.normal(size=n + 64).astype(np.float32), rng.normal(size=(n + 64, 4)).astype(np.float32), np.zeros(n), np.ones(n), bits)
    import pyarrow as pa

    f = quality_model.features(*bytescan.text_bytes(pa.array(["a few words and more", None, "x", "THE the the!"])), np.array([1.0, np.nan, 2.0, 3.0]), bits)
    x = np.zeros((4, n + 64))
    x[:, :n] = model.dense(f.structure)
    for i in range(4):
        x[i, n + f.word[f.first[i] : f.first[i + 1]]] = f.value[f.first[i] : f.first[i + 1]]
    gram = model.v @ model.v.T
    want = [0.3 + x[i] @ model.w + sum(gram[a, b] * x[i, a] * x[i, b] for a in range(n + 64) for b in range(a)) for i in range(4)]
    assert model.margins(f) == pytest.approx(want, rel=1e-4, abs=1e-4)


def test_model_on_odd_tables(spark, odd, extra, nothing):
    for labelled in (nothing.withColumn("y", F.lit(1)), odd.withColumn("y", F.lit(1)), odd.withColumn("y", F.lit(None).cast("int")), odd.withColumn("y", (F.col("doc_id") % 2).cast("int"))):
        model = quality_model.train(labelled, "y")
        for table in (odd, extra, nothing):
            scores = [r[1] for r in pairs(quality_model.score(table, model), "doc_id", "score")]
            assert len(scores) == table.count() and all(0 <= s <= 1 for s in scores)
    assert quality_model.score(extra, model, keep=extra.columns, score_col="s_").columns == [*extra.columns, "s_"]


def test_perfect_hash():
    for n in (0, 1, 2, 63, 5000):
        keys = np.arange(n, dtype=np.int64) * 7919 - 100
        hashes = token_store.key_hash(keys)
        order = token_store.PerfectHash.build(hashes)
        again, _ = token_store.PerfectHash.load(order.dump())
        assert sorted(order(hashes)) == list(range(n)) and (order(hashes) == again(hashes)).all()


def test_lookup_of_some_keys_and_foreign_keys(spark, docs):
    manifest, folder, parts = token_store.store_tokens(docs, queries.tokenizer_path(), shard_bytes=30_000, part_keys=40)
    keys = spark.createDataFrame([(3,), (17,), (17,), (10**12,), (None,)], "key long")
    places = token_store.lookup(keys, folder, parts)
    got = {r["key"]: r["n_tokens"] for r in token_store.read_documents(manifest, places, folder, nulls=False).collect()}
    whole = {r["doc_id"]: r["n_tokens"] for r in queries.op1_token_store(spark, SF).collect()}
    assert got == {k: whole[k] for k in (3, 17)}


def test_one_id_over_many_shards(spark):
    docs = spark.createDataFrame([(7, f"text number {i} of one id") for i in range(300)] + [(8, "other"), (None, "none")], "doc_id long, text string")
    got = token_store.stored_digest(docs, queries.tokenizer_path(), shard_bytes=3_000)
    assert got.groupBy("doc_id").count().orderBy("doc_id").collect() == [(None, 1), (7, 300), (8, 1)]
    assert got.filter("doc_id = 7").select("shard").distinct().count() > 3


def test_training_order_follows_the_weights(docs):
    plan = mixing.plan_mix(docs)
    order = mixing.training_order(plan).collect()
    at = [r["position"] for r in order]
    assert at == sorted(at) and len(order) == plan.agg(F.sum("copies")).first()[0]


def test_schedule_is_inverted(spark):
    schedule = [(0.0, 1.0), (0.25, 3.0), (0.5, 0.0), (1.0, 2.0)]
    shares = np.linspace(0, 1, 41)
    df = spark.createDataFrame([(float(s),) for s in shares], "s double").select("s", mixing.position_of(F.col("s"), schedule).alias("t"))
    t = np.linspace(0, 1, 200_001)
    rate = np.interp(t, [x for x, _ in schedule], [y for _, y in schedule])
    area = np.concatenate([[0], np.cumsum((rate[1:] + rate[:-1]) / 2 * np.diff(t))])
    for s, got in df.collect():
        assert np.interp(got, t, area) / area[-1] == pytest.approx(s, abs=1e-6)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = contract.queries()[name](spark, SF).toArrow(), con.sql(ORACLES[name]).to_arrow_table()
    rows = lambda t: sorted(map(repr, zip(*[t.column(c).to_pylist() for c in sorted(t.column_names)])))
    assert sorted(got.column_names) == sorted(want.column_names) and rows(got) == rows(want)


def test_pipeline_stages(spark):
    """Each stage against the plain version of its decision, on what it was given."""
    from scorelake.sources.checkpoint import materialize

    docs = queries.table(spark, SF, "documents")
    items = pairs(queries.table(spark, SF, "benchmark"), "item_id", "text")
    for name, stage in corpus_pipeline.STAGES:
        before = pairs(docs)
        out = stage(spark, docs, SF)
        if name != "tokens":
            assert out.columns == docs.columns
            out = materialize(out, "t")
        after = pairs(out) if name != "tokens" else []
        if name == "near_duplicates":
            groups = {i: c for i, _, c in brute.components([(i, t) for i, (_, t) in enumerate(before)], 2)}
            assert len(after) == len(set(groups.values())) and set(after) <= set(before)
        if name == "decontamination":
            dirty = {r[0] for r in brute.contamination([(i, t) for i, (_, t) in enumerate(before)], items, 10) if r[5]}
            assert sorted(after) == sorted(b for i, b in enumerate(before) if i not in dirty)
        if name == "mixture":
            assert set(after) <= set(before) and max(after.count(x) for x in set(after)) <= 2
        if name == "tokens":
            assert out.count() == len(before)
        docs = out


@pytest.mark.parametrize("table", ["odd", "extra", "nothing"])
def test_pipeline_on_odd_tables(spark, request, table):
    docs = request.getfixturevalue(table)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns or name == "tokens"
        assert out.count() > 0 or table == "nothing"


def test_links_of_empty_and_single_tables(spark):
    assert simhash.links(spark.createDataFrame([], "fp long")).count() == 0
    assert simhash.links(spark.createDataFrame([(5,)], "fp long")).count() == 0


def test_keys_of_repeats_spread_over_all_ranges():
    """Half of the picked ranks are small numbers by construction; their keys must not be."""
    import random

    from scorelake.llm import exchange, repeats

    text = random.Random(3).randbytes(300_000)
    batch = exchange.Batch(np.arange(1), np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    table = repeats.runs_table(batch, 200)
    for keys in (table["rank"], table["run"]):
        sizes = np.diff(exchange.cut(np.sort(keys), 10))
        assert sizes.min() > 0.7 * sizes.mean() and sizes.max() < 1.3 * sizes.mean()


def test_totals_beyond_32_bits(spark):
    """Counts of a large corpus: the sum of three lists is no longer a 32-bit number."""
    from scorelake.llm import exchange

    keys, most = np.array([0, 7, 1 << 63], np.uint64), (1 << 32) - 1
    lists = [b for batch in range(3) for b in exchange.blocks(batch, keys, np.array([most, batch + 1, most]), 2)]
    sums = exchange.totals(spark.createDataFrame([r for b in lists for r in b.to_pylist()], exchange.BLOCKS), 2)
    for batch in range(3):
        found, first = exchange.read_totals(sums.filter(F.col("batch") == batch).toArrow())
        assert found.tolist() == [3 * most, 6, 3 * most] and first.tolist() == [batch == 0] * 3


@pytest.mark.parametrize("name", ["near_duplicates", "decontamination"])
def test_row_numbers_outlive_another_split(spark, tmp_path, monkeypatch, name):
    """The input files are split otherwise after the operator ran: the same rows go."""
    from corpus_pipeline import decontaminate

    stages, setting = dict(corpus_pipeline.STAGES), "spark.sql.files.maxPartitionBytes"
    queries.table(spark, SF, "documents").repartition(6).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    want = sorted(map(repr, pairs(stages[name](spark, docs, SF))))
    module, function = (simhash, "near_duplicates") if name == "near_duplicates" else (decontaminate, "contamination")
    operator, before = getattr(module, function), spark.conf.get(setting)

    def split(*args):
        from scorelake.sources.checkpoint import materialize

        out = materialize(operator(*args), "t")
        spark.conf.set(setting, "20000")
        return out

    monkeypatch.setattr(module, function, split)
    try:
        assert sorted(map(repr, pairs(stages[name](spark, docs, SF)))) == want
    finally:
        spark.conf.set(setting, before)


def test_smallest_id_of_a_group_stays(spark):
    """Whatever the order of the rows; null ids and larger ones are removed."""
    text = "one text of which there are several copies in the table "
    rows = [(None, text), (9, text), (4, text), (7, "something else altogether, alone here"), (4, text)]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], queries.table(spark, SF, "documents").select("doc_id", "text", "lang", "source", "n_chars").schema)
    for d in (docs, docs.orderBy(F.col("doc_id").desc()).coalesce(1)):
        assert sorted(r[0] for r in pairs(corpus_pipeline.near_duplicates(spark, d, SF))) == [4, 7]


def test_query_looks_beyond_word_pairs(monkeypatch):
    orders = []
    monkeypatch.setattr(queries, "table", lambda *_: None)
    monkeypatch.setattr(queries.lm, "lm_scores", lambda docs, order=2, **_: orders.append(order))
    queries.op5_lm_score(None, SF)
    assert orders[0] >= 3


def test_ids_that_are_no_numbers_are_refused(spark):
    docs = spark.createDataFrame([("a", "text")], "doc_id string, text string")
    with pytest.raises(ValueError, match="whole numbers"):
        token_store.store_tokens(docs, queries.tokenizer_path())


def test_other_tokenizers_encode_whole_texts(odd):
    """A byte-level tokenizer joins across what the other one parts."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    assert token_store.Encoder(queries.tokenizer_path()).by_piece and not token_store.Encoder(path).by_piece
    got = pairs(token_store.stored_digest(odd, path), "doc_id", "n_tokens", "ids_crc32")
    want = [(d, n, c) for d, _, n, c in brute.tokens(pairs(odd), Tokenizer.from_file(path))]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_a_third_of_all_rows_without_an_id_spreads(spark):
    """Rows of one id or of none lie in many slices of their source, as their texts differ."""
    rows = spark.range(9_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.concat(F.lit("text number "), "id").alias("text"), F.lit("a").alias("source"))
    plan = mixing.plan_mix(rows)
    assert plan.filter("doc_id IS NULL").select("position").distinct().count() > 800
    key = F.md5(F.concat_ws(":", F.lit("42"), F.col("doc_id").cast("string"), F.md5(F.col("text").cast("binary"))).cast("binary"))
    assert rows.filter("doc_id IS NULL").select(F.substring(key, 1, 2)).distinct().count() > 200


def test_buckets_of_near_equal_fingerprints(spark):
    """50,000 fingerprints that agree on most of their bits: no bucket costs the square of its size."""
    rng = np.random.default_rng(9)
    low = rng.choice(1 << 22, 50_000, replace=False).astype(np.uint64)
    fps = (np.uint64(0x5A5A5A5A5A) << np.uint64(22)) | low
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    got = {tuple(sorted(p)) for p in pairs(simhash.links(df), "a", "b")}
    known, want = set(fps.tolist()), set()
    for i in range(22):
        for j in range(i, 22):
            flip = (1 << i) | (1 << j)
            want |= {tuple(sorted((x, x ^ flip))) for x in known if x ^ flip in known}
    assert got == want

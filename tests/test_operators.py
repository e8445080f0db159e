import random
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scorelake.operators import duplicates, group_sums, ordinals, ranking, references, skew, upserts
from scorelake.plans import mapping


@pytest.fixture(scope="module")
def rows():
    """Half of all rows share one key; some keys are missing."""
    rng = random.Random(7)
    return [(i, "hot" if rng.random() < 0.5 else rng.choice(["a", "b", None, f"k{i}"]), rng.randint(0, 6), rng.random() < 0.8) for i in range(600)]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "id int, key string, v int, ok boolean").repartition(5, "id")


def test_keep_first(df, rows):
    first = {}
    for i, key, *_ in rows:
        first.setdefault(key, i)
    got = {r["key"]: r["id"] for r in duplicates.keep_first(df, ["key"], ["id"]).collect()}
    assert got == first


def test_keep_first_limits_groups_before_the_shuffle(df):
    plan = duplicates.keep_first(df, ["key"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_flag_duplicates_with_condition(df, rows):
    seen, late = set(), set()
    for i, key, _, ok in rows:
        if ok:
            (late.add(i) if key in seen else seen.add(key))
    marked = duplicates.flag_duplicates(df, ["key"], ["id"], F.col("ok"))
    got = marked.collect()
    assert len(got) == len(rows) and {r["id"] for r in got if r["_duplicate"]} == late


def test_all_copies_and_keys(df, rows):
    counts = pd.Series([r[1] or "" for r in rows]).value_counts()
    many = set(counts[counts > 1].index)
    assert {r["id"] for r in duplicates.all_copies(df, ["key"]).collect()} == {r[0] for r in rows if (r[1] or "") in many}
    assert {(r["key"] or "", r["copies"]) for r in duplicates.duplicate_keys(df, ["key"]).collect()} == {(k, int(counts[k])) for k in many}


@pytest.mark.parametrize("broadcast", [False, True])
def test_group_join_keeps_all_rows(spark, df, broadcast):
    groups = spark.createDataFrame([("hot", 1), ("a", 2), (None, 3)], "key string, g int")
    got = {(r["id"], r["g"]) for r in skew.group_left_join(df, groups, ["key"], broadcast=broadcast).collect()}
    look = {"hot": 1, "a": 2, None: 3}
    assert got == {(r["id"], look.get(r["key"])) for r in df.collect()}


def test_group_join_copies_no_group(spark):
    """One join on the plain key; nothing is repeated per salt."""
    rows = spark.range(1000).withColumn("key", (F.col("id") % 3).cast("string"))
    groups = rows.groupBy("key").agg(F.count("*").alias("g"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = skew.group_left_join(rows, groups, ["key"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Generate" not in plan and plan.count("SortMergeJoin") == 1


def test_references(spark, df):
    parent = spark.createDataFrame([("hot",), ("a",), ("a",)], "p string")
    marked = references.mark_present(df, "key", parent, "p")
    assert {(r["key"], r["_present"]) for r in marked.collect() if r["key"] in ("hot", "a", "b", None)} == {("hot", True), ("a", True), ("b", False), (None, False)}
    assert marked.count() == df.count()
    assert references.orphans(df, "key", parent, "p").filter("key in ('hot', 'a') or key is null").isEmpty()
    assert references.having_parent(df, "key", parent, "p").select("key").distinct().count() == 2
    a, b = spark.range(3), spark.range(3).union(spark.range(2))
    assert df.limit(1).select(references.same_set(a, b)).first()[0] is True
    assert df.limit(1).select(references.same_set(a, spark.range(4))).first()[0] is False


def test_group_sum(spark):
    data = [(1, "a", 60), (2, "a", 40), (3, "b", 90), (4, None, 10), (5, "c", 1)]
    df = spark.createDataFrame(data, "id int, k string, w int").withColumn("w", F.col("w").cast("decimal(18,6)"))
    skip = group_sums.flag_group_sum(df, ["k"], F.col("w"))
    assert {r["id"] for r in skip.collect() if r["_bad_total"] is not None} == {3}
    grouped = group_sums.flag_group_sum(df, ["k"], F.col("w"), alternative=None, null_keys="group")
    assert {r["id"] for r in grouped.collect() if r["_bad_total"] is not None} == {3, 4, 5}


@pytest.mark.parametrize("kind", ["decimal(5,2)", "double"])
def test_dense_ranks_match_pandas(spark, kind):
    rng = random.Random(3)
    data = [(i, rng.choice("xyz"), Decimal(rng.randint(0, 40)) / 10, Decimal(rng.randint(0, 9)) / 10) for i in range(300)]
    df = spark.createDataFrame(data, "id int, g string, a decimal(5,2), b decimal(5,2)")
    df = df.withColumns({"a": F.col("a").cast(kind), "b": F.col("b").cast(kind)})
    out = ranking.dense_rank_by(df, "a", "desc", "overall")
    out = ranking.dense_rank_by(out, "a", "desc", "inside", ["g"])
    got = ranking.dense_rank_by_pair(out, ("a", "desc"), ("b", "asc"), "pair").toPandas().sort_values("id")
    pdf = pd.DataFrame(data, columns=["id", "g", "a", "b"])
    assert list(got["overall"]) == list(pdf["a"].rank(method="dense", ascending=False).astype(int))
    assert list(got["inside"]) == list(pdf.groupby("g")["a"].rank(method="dense", ascending=False).astype(int))
    pairs = {p: i + 1 for i, p in enumerate(sorted({(-a, b) for _, _, a, b in data}))}
    assert list(got["pair"]) == [pairs[(-a, b)] for _, _, a, b in data]


def test_sequence_and_quantiles(spark):
    rng = random.Random(5)
    data = [(i, rng.choice([0.5, 1.25, 7.0, rng.random()])) for i in range(500)]
    df = spark.createDataFrame(data, "id int, v double").repartition(6)
    ids = {r["id"]: r["gid"] for r in ordinals.sequence_id(df.withColumn("gid", F.lit("")), [F.col("id")], "gid").collect()}
    assert ids == {i: f"G-{i + 1:06d}" for i in range(500)}
    probs = [0.0, 0.25, 0.5, 0.99, 1.0]
    got = {r["probability"]: r["quantile"] for r in ordinals.exact_quantiles(df, "v", probs).collect()}
    want = np.quantile([v for _, v in data], probs)
    assert all(abs(got[p] - w) < 1e-9 for p, w in zip(probs, want))
    three = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (None,)], "v double")
    assert sorted(r["quantile"] for r in ordinals.exact_quantiles(three, "v", [0.99, 0.5]).collect()) == pytest.approx([2.0, 9.84])


def test_upsert_keeps_creation_and_renews_update(spark):
    old, new = F.lit("2026-01-01").cast("date"), F.lit("2026-02-01").cast("date")
    target = upserts.first_load(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), old)
    source = spark.createDataFrame([(2, "B"), (3, None)], "k int, v string")
    got = {r["k"]: (r["v"], r["created_at"].month, r["updated_at"].month) for r in upserts.upsert(target, source, ["k"], new).collect()}
    assert got == {1: ("a", 1, 1), 2: ("B", 1, 2), 3: (None, 2, 2)}


def test_greedy_pairs_match_a_sequential_scan(spark):
    rng = random.Random(11)
    offers = [(w, f"c{c}", f"f{f}", rng.choice([1.0, 0.95, 0.7]), c, f) for w in range(6) for c in range(30) for f in range(5) if rng.random() < 0.6]
    want = set()
    for w in range(6):
        cols, fields = set(), set()
        for o in sorted((o for o in offers if o[0] == w), key=lambda o: (-o[3], o[4], o[5])):
            if o[1] not in cols and o[2] not in fields:
                cols.add(o[1])
                fields.add(o[2])
                want.add((w, o[1], o[2], o[3]))
    df = spark.createDataFrame(offers, "w int, col string, field string, s double, cpos int, fpos int")
    got = mapping.greedy_pairs(df, ["w"], "col", "field", [-F.col("s"), F.col("cpos"), F.col("fpos")], 5)
    assert {(r["w"], r["col"], r["field"], r["s"]) for r in got.collect()} == want

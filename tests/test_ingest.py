"""Uploads in one scan, profiles from one stream of cells, and the ingestion record."""
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from scorelake.plans import ingest, mapping, profile
from scorelake.sources import readers, uploads, versions, writers

COUNTED = ["table_name", "column_name", "inferred_type", "total_rows", "null_count", "unique_count", "min_number", "max_number", "sample_values", "column_count"]


def rows(df, *columns):
    return sorted(map(repr, df.select(*columns).collect()))


def nodes(df, pattern):
    return len(re.findall(pattern, df._jdf.queryExecution().executedPlan().toString()))


@pytest.fixture
def folder(tmp_path):
    """Two workbooks of small tables, every file with a header of its own."""
    for i in range(200):
        book = tmp_path / "up" / ("first" if i % 2 else "second")
        book.mkdir(parents=True, exist_ok=True)
        names = [f"c{j}" for j in range(1 + i % 5)] + ['odd "name", here'.replace('"', '""')] * (i % 3 == 0)
        head = ",".join(f'"{n}"' if " " in n else n for n in names)
        body = [",".join(["NA" if (r + j) % 4 == 0 else f"{r * j}" for j in range(len(names))]) for r in range(i % 7)]
        (book / f"t{i}.csv").write_text("\n".join([head, *body]) + "\n", encoding="utf-8")
    return str(tmp_path / "up")


def test_one_scan_reads_what_two_hundred_reads_do(spark, folder):
    sent = uploads.read_uploads(spark, folder)
    assert nodes(sent.cells, r"FileScan csv") == 1
    got = profile.profile_cells(sent.cells, sent.catalog)
    for book in ("first", "second"):
        tables = readers.read_workbook(spark, f"{folder}/{book}", ordinal=True)
        some = {n: tables[n] for n in sorted(tables)[::11]}
        want = profile.profile_cells(profile.cells_of(some, {n: ["_ord"] for n in some}), profile.catalog_of(some))
        mine = got.filter(F.col("workbook") == book).filter(F.col("table_name").isin(list(some)))
        assert rows(mine, *COUNTED) == rows(want, *COUNTED)


def test_plans_do_not_grow_with_the_number_of_tables(spark, tmp_path):
    seen = set()
    for many in (2, 50):
        root = tmp_path / f"n{many}"
        root.mkdir()
        for i in range(many):
            (root / f"t{i}.csv").write_text("a,b\n1,2\n", encoding="utf-8")
        sent = uploads.read_uploads(spark, str(root))
        df = profile.profile_cells(sent.cells, sent.catalog)
        seen.add((nodes(df, "FileScan"), nodes(df, "Exchange"), nodes(df, "Generate")))
    assert len(seen) == 1


def test_one_explode_and_one_shuffle_of_cells(spark):
    df = profile.profile_columns(spark.read.parquet("/root/testdata/sf0.001/orders.parquet"), "orders")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Generate explode", plan)) == 1 and len(re.findall(r"FileScan parquet", plan)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\((?:\w+#\d+, )*value#\d+", plan)) == 1


def test_ragged_rows_and_parts_of_one_table(spark, tmp_path):
    table = tmp_path / "up" / "notas.csv"
    table.mkdir(parents=True)
    (table / "part-1.csv").write_text('id,"na ""x"", y",nota\n1,a,5\n2\n3,b,4,extra,more\n\n', encoding="utf-8")
    (table / "part-2.csv").write_text('nota,id\n3,4\nNA,"5"\n', encoding="utf-8")
    (tmp_path / "up" / "empty.csv").write_text("x,y\n", encoding="utf-8")
    sent = uploads.read_uploads(spark, str(tmp_path / "up"))
    got = {(r["table_name"], r["column_name"]): r for r in profile.profile_cells(sent.cells, sent.catalog).collect()}
    assert {k: (r["total_rows"], r["null_count"], r["sample_values"]) for k, r in got.items()} == {
        ("notas", "id"): (5, 0, ["1", "2", "3", "4", "5"]), ("notas", 'na "x", y'): (3, 1, ["a", "b"]), ("notas", "nota"): (5, 2, ["5", "4", "3"]),
        ("empty", "x"): (0, 0, []), ("empty", "y"): (0, 0, [])}
    assert {r["workbook"] for r in got.values()} == {"up"}


def test_profile_state_over_many_tasks(spark):
    """A column of many distinct values in several tasks: exact counts, first values in row order."""
    df = spark.range(40_000).select(F.col("id").alias("n"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("t"), F.lit(None).cast("string").alias("e"))
    got = {r["column_name"]: r for r in profile.profile_columns(df.repartition(7), "x", ["n"]).collect()}
    assert (got["n"]["unique_count"], got["n"]["sample_values"], got["n"]["min_number"], got["n"]["max_number"]) == (40_000, list("01234"), 0.0, 39_999.0)
    assert (got["t"]["unique_count"], got["t"]["sample_values"], got["t"]["inferred_type"]) == (26_667, ["same", "1", "2", "4", "5"], "string")
    assert (got["e"]["inferred_type"], got["e"]["null_count"], got["e"]["sample_values"]) == ("empty", 40_000, [])


@pytest.fixture
def book(spark):
    def sheet(columns, data):
        names = columns.split()
        return spark.createDataFrame(data, ", ".join(f"`{n}` string" for n in names))

    return {
        "estudiantes": sheet("estudiante_id nombre apodo", [("E1", "Lucas", "L"), ("E2", "Elena", None)]),
        "evaluaciones": sheet("evaluacion_id nombre peso", [("EV1", "Quiz", "50"), ("EV2", "Parcial", "50")]),
        "notas": sheet("estudiante_id evaluacion_id nota", [("E1", "EV1", "4.0"), ("E2", "EV2", "4.5"), ("E2", "EV1", None)]),
        "glosario": sheet("a", [("x",)]),
    }


def test_proposal_has_profile_counts_and_ignored_columns(book):
    p = mapping.propose_mapping(book)
    assert p.row_counts == {"estudiantes": 2, "evaluaciones": 2, "notas": 3, "glosario": 1}
    assert p.ignored == ["glosario"] and p.ignored_columns == {"estudiantes": ["apodo"], "evaluaciones": [], "notas": []}
    kinds = {(r["table_name"], r["column_name"]): r["inferred_type"] for r in p.profile.collect()}
    assert kinds["notas", "nota"] == "float" and kinds["evaluaciones", "peso"] == "integer" and len(kinds) == 10


def test_proposals_of_uploaded_files(spark, book, tmp_path):
    for name, df in book.items():
        df.write.option("header", True).csv(str(tmp_path / "b" / f"{name}.csv"))
    sheets, profiled = mapping.propose_uploads(spark, str(tmp_path / "b"))
    got = {r["table_name"]: r for r in sheets.collect()}
    p = mapping.propose_mapping(book)
    assert {t: r["row_count"] for t, r in got.items()} == p.row_counts
    assert {r["entity"]: (t, r["column_mapping"]) for t, r in got.items() if r["entity"]} == p.mapping
    assert rows(profiled, *COUNTED[:6]) == rows(p.profile, *COUNTED[:6])


def stored(spark, root):
    found = ingest.read_ingestion(spark, root)
    return found and (found.tables["students"].count(), found.mapping.count(), found.manifest.agg(F.sum("row_count")).first()[0], ingest.mapping_of(found.mapping))


def test_ingestion_is_stored_with_its_record(spark, book, tmp_path):
    p = mapping.propose_mapping(book)
    done = ingest.ingest(spark, book, p.mapping, str(tmp_path), row_counts=p.row_counts)
    found = ingest.read_ingestion(spark, str(tmp_path))
    assert ingest.mapping_of(found.mapping) == p.mapping and set(found.tables) == set(done.tables)
    assert {r["table_name"]: (r["entity"], r["raw_rows"], r["stored_rows"]) for r in found.counts.collect()} == {
        "estudiantes": ("students", 2, 2), "evaluaciones": ("assessments", 2, 2), "notas": ("grades", 3, 3), "glosario": (None, 1, None)}
    listed = {(r["entity"], r["file"]): r for r in found.manifest.collect()}
    files = [f for f in tmp_path.rglob("*.parquet") if f.parent.name in found.tables]
    assert {(f.parent.name, f.name) for f in files} == set(listed)
    for f in files:
        r = listed[f.parent.name, f.name]
        assert (r["sha256"], r["size_bytes"]) == (hashlib.sha256(f.read_bytes()).hexdigest(), f.stat().st_size)
    assert {e: sum(r["row_count"] for (x, _), r in listed.items() if x == e) for e in ("students", "grades", "courses")} == {"students": 2, "grades": 3, "courses": 0}
    assert ingest.check_ingestion(spark, str(tmp_path)).isEmpty()
    touched = next(f for f in files if f.parent.name == "grades" and listed["grades", f.name]["row_count"])
    spark.createDataFrame([("g", "a", "s", "1", "d", "f", "{}")], done.tables["grades"].schema).coalesce(1).write.parquet(str(tmp_path / "other"))
    other = next((tmp_path / "other").glob("*.parquet"))
    touched.write_bytes(other.read_bytes())
    (touched.parent / f".{touched.name}.crc").unlink(missing_ok=True)
    (touched.parent / "more.parquet").write_bytes(other.read_bytes())
    assert {(r["file"], r["problem"]) for r in ingest.check_ingestion(spark, str(tmp_path)).collect()} == {(touched.name, "changed"), ("more.parquet", "unlisted")}


def test_failure_between_any_two_writes_leaves_the_old_load(spark, book, tmp_path, monkeypatch):
    root = str(tmp_path)
    p = mapping.propose_mapping(book)
    assert stored(spark, root) is None
    ingest.ingest(spark, book, p.mapping, root)
    before = stored(spark, root)
    more = {**book, "estudiantes": book["estudiantes"].unionByName(book["estudiantes"].withColumn("estudiante_id", F.lit("E3")))}
    plain, done = versions.LayerVersion.store, []

    def failing(at):
        def store(self, name, df):
            if name == at:
                raise OSError("disk full")
            done.append(name)
            return plain(self, name, df)

        return store

    for at in ("courses", "grades", "_manifest", "_mapping", "_counts"):
        with monkeypatch.context() as m:
            m.setattr(versions.LayerVersion, "store", failing(at))
            with pytest.raises(OSError):
                ingest.ingest(spark, more, p.mapping, root)
        assert stored(spark, root) == before
    with monkeypatch.context() as m:
        m.setattr(versions.LayerVersion, "commit", lambda self: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            ingest.ingest(spark, more, p.mapping, root)
    assert stored(spark, root) == before and len(done) > 30
    ingest.ingest(spark, more, p.mapping, root)
    assert stored(spark, root)[0] == 4
    assert len(versions.sweep_layer(spark, root, "ingested", grace_seconds=0)) == 7


def test_digests_stream_and_tell_equal_names_apart(spark, tmp_path):
    big = bytes(range(256)) * (3 * writers.DIGEST_BLOCK // 256) + b"tail"
    for name, data in (("one a+b", big), ("two", b""), ("three.gz", b"\x1f\x8bnot really")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.gz").write_bytes(data)
    got = writers.file_digests(spark, [str(tmp_path / "*")]).collect()
    # Spark lists no file of zero bytes.
    want = {(len(d), hashlib.sha256(d).hexdigest()) for d in (big, b"\x1f\x8bnot really")}
    assert {(r["size_bytes"], r["sha256"]) for r in got} == want and {r["file"] for r in got} == {"f.gz"} and len({r["at"] for r in got}) == 2
    sizes = [len(b) for b in writers.file_blocks(f"file:{tmp_path}/one a+b/f.gz")]
    assert max(sizes) <= writers.DIGEST_BLOCK and len(sizes) == 4


def test_scratch_frames_are_gone_afterwards(spark, tmp_path):
    from pathlib import Path

    from scorelake.sources.checkpoint import materialize, scratch

    with pytest.raises(RuntimeError), scratch(spark) as outer:
        materialize(spark.range(3), "a")
        with scratch(spark) as inner:
            materialize(spark.range(3), "b")
            assert list(Path(inner).iterdir()) and inner != outer
        assert not Path(inner).exists() and len(list(Path(outer).iterdir())) == 1
        raise RuntimeError("ends early")
    assert not Path(outer).exists()
    materialize(spark.range(1)).count()


def test_cells_are_counted_without_a_sort(spark, tmp_path):
    """Counts and places of cells fit hash maps, for opened tables as for uploads."""
    (tmp_path / "up").mkdir()
    (tmp_path / "up" / "t.csv").write_text("a,b\n1,2\n", encoding="utf-8")
    sent = uploads.read_uploads(spark, str(tmp_path / "up"))
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    for got in (profile.profile_cells(sent.cells, sent.catalog), profile.profile_columns(df, "orders")):
        assert nodes(got, r"SortAggregate") == 0


def test_first_values_over_blocks_and_parts(spark, tmp_path):
    """Samples are the first distinct values by file, block and line, however Spark deals the blocks to tasks."""
    table = tmp_path / "up" / "t.csv"
    table.mkdir(parents=True)
    cells = [f"v{(i // 700) * 7 % 10}" for i in range(6000)]
    for part, (a, b) in enumerate(((0, 1500), (1500, 1600), (1600, 6000))):
        (table / f"part-{part}.csv").write_text("id,v\n" + "".join(f"{i},{cells[i]}\n" for i in range(a, b)), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        sent = uploads.read_uploads(spark, str(tmp_path / "up"))
        got = {r["column_name"]: r for r in profile.profile_cells(sent.cells, sent.catalog).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got["v"]["sample_values"] == list(dict.fromkeys(cells))[:5] and got["v"]["unique_count"] == len(set(cells))
    assert got["id"]["sample_values"] == list("01234") and got["id"]["unique_count"] == 6000

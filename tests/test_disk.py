"""What a long job leaves behind and holds at a time."""
from pathlib import Path

from pyspark.sql import functions as F

from scorelake.operators import duplicates, references
from scorelake.plans import validate
from scorelake.sources import checkpoint
from scorelake.sources.checkpoint import Steps, materialize, scratch, shuffles_freed

GRADES = "grade_id assessment_id student_id score submission_date"


def kinds(folder):
    return {p.name.rsplit("-", 1)[0] for p in Path(folder).iterdir()} if Path(folder).exists() else set()


def as_of():
    return F.lit("2026-01-01").cast("date")


def tables(frame):
    marks = [("g1", "MAT0", "E1", "3,5", "2025-03-01"), ("g2", "MAT0", "E1", "3,5", "2025-03-01"), ("g3", "MAT0", "E9", "4", "2025-03-01"), ("g4", "X", "E1", "9", None),
             ("g5", None, None, None, None), ("g6", None, None, None, None), ("g7", "MAT1", "E2", "ND", "2999-01-01")]
    return {
        "subjects": frame("subject_id subject_name", [("MAT", "Mat")]),
        "students": frame("student_id first_name last_name gender birth_date document_number course_id", [(f"E{i}", "Ana", "Gil", "F", None, None, None) for i in range(4)]),
        "assessments": frame("assessment_id subject_id period_id assessment_name weight_percentage", [
            ("MAT0", "MAT", "1", "T", "40"), ("MAT1", "MAT", "1", "T", "60"), ("MAT1", "MAT", "1", "T", "60"), ("LEN0", "LEN", "1", "T", "100"), ("MAT2", "MAT", "2", "T", "70")]),
        "grades": frame(GRADES, marks),
    }


def rows(df):
    return sorted(map(repr, df.collect()))


def test_validation_leaves_only_its_labelled_frames(spark, frame):
    """What the rules store on their way is gone, and the rows are those of the plan in one piece."""
    given = tables(frame)
    with scratch(spark) as folder:
        done = validate.validate_all(given, {}, as_of())
        assert kinds(folder) == {f"labelled-{e}" for e in given}
        subjects, students, works = (done[e].valid for e in ("subjects", "students", "assessments"))
        want = validate.split(validate.label_assessments(given["assessments"], ["_ord"], subjects), "assessments")
        assert [rows(a) for a in done["assessments"]] == [rows(b) for b in want]
        want = validate.split(validate.label_grades(given["grades"], ["_ord"], as_of(), students, works), "grades")
        assert [rows(a) for a in done["grades"]] == [rows(b) for b in want]
        assert done["grades"].valid.count() == 1 and done["grades"].corrections.count() == 1


def test_stored_groups_give_the_same_rows_few_or_many(spark, monkeypatch):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else str(i % 7), i % 3) for i in range(60)], "id int, key string, other int")
    parent = spark.createDataFrame([("1",), ("1",), (None,)], "key string")
    plain = rows(duplicates.flag_duplicates(df, ["key", "other"], ["id"], F.col("id") > 9)), rows(references.mark_present(df, "key", parent, "key")), rows(references.having_parent(df, "key", parent))
    for few in (0, 5, 100):
        monkeypatch.setattr(checkpoint, "FEW_GROUPS", few)
        monkeypatch.setattr(duplicates, "FEW_HASHES", few)
        with scratch(spark) as folder:
            steps = Steps(spark)
            flagged = duplicates.flag_duplicates(df, ["key", "other"], ["id"], F.col("id") > 9, settle=steps.groups)
            got = rows(flagged), rows(references.mark_present(df, "key", parent, "key", settle=steps.groups)), rows(references.having_parent(df, "key", parent, settle=steps.groups))
            steps.clear()
            assert got == plain and kinds(folder) == set()


def test_shuffle_setting_comes_back_after_blocks_that_overlap(spark):
    """The block that began first may end first; the setting is the session's own after the last."""
    before = spark.conf.get(checkpoint.CLEANUP, None)
    one, two = shuffles_freed(spark), shuffles_freed(spark)
    one.__enter__(), two.__enter__()
    one.__exit__(None, None, None)
    assert spark.conf.get(checkpoint.CLEANUP) == "true"
    two.__exit__(None, None, None)
    assert spark.conf.get(checkpoint.CLEANUP) == (before or "false")


def test_steps_keep_the_newest_frame(spark):
    with scratch(spark) as folder:
        steps = Steps(spark)
        steps.groups(spark.range(2).toDF("a"))
        second = steps.next(steps.store(spark.range(3), "first"), "second")
        assert kinds(folder) == {"second"} and second.count() == 3
        assert [p for p in Path(folder).rglob("*.zstd.parquet")]
        kept = materialize(second, "kept")
        steps.clear()
        assert kinds(folder) == {"kept"} and kept.count() == 3


def test_counts_that_are_stored_give_the_same_report(spark):
    from scorelake.plans import reconcile

    tables = {"grades": spark.range(3), "students": spark.range(2)}
    kept = []
    plain = reconcile.reconcile(tables, tables, {}, {}, {"grades": spark.range(1)})
    stored = reconcile.reconcile(tables, tables, {}, {}, {"grades": spark.range(1)}, lambda df: kept.append(df.count()) or df)
    assert rows(stored) == rows(plain) and kept == [1] * 5


def test_report_of_entities_deletes_what_was_entered_for_it(spark):
    from scorelake.demo.queries import REGISTRY

    with scratch(spark) as folder:
        REGISTRY["reconcile_entities"](spark, "/root/testdata/sf0.001")
        assert kinds(folder) == {f"labelled-{e}" for e in ("courses", "subjects", "students", "assessments", "grades", "attendance")} | {"frame"}


def test_run_deletes_its_copies_once_they_are_landed(spark, monkeypatch):
    """Uploads go when the raw layer has them, labelled frames when their sinks are stored."""
    from scorelake.demo.queries import REGISTRY
    from scorelake.plans import layers

    seen, stage_all = [], layers.stage_all
    root = Path(checkpoint.checkpoint_root(spark)) / "scorelake"

    def staged(*given):
        scratched = Path(spark.conf.get(checkpoint.SCRATCH))
        seen.append((kinds(scratched), {k for k in kinds(root) if k.startswith("upload")}))
        return stage_all(*given)

    monkeypatch.setattr(layers, "stage_all", staged)
    assert REGISTRY["run_layers"](spark, "/root/testdata/sf0.001").count() == 6
    assert seen == [(set(), set())]


def test_compressed_uploads_are_read_like_plain_ones(spark, tmp_path):
    """A table of compressed parts, and one that is a compressed file, profile as their plain texts do."""
    import gzip

    from scorelake.plans import profile
    from scorelake.sources import uploads

    parts = ["id,nota\n1,5\n2,\n", "id,nota\n3,4\n4,5\n"]
    for name, pack, ending in (("plain", str.encode, ""), ("packed", lambda t: gzip.compress(t.encode()), ".gz")):
        table = tmp_path / name / "libro" / "notas.csv"
        table.mkdir(parents=True)
        for i, text in enumerate(parts):
            (table / f"part-{i}.csv{ending}").write_bytes(pack(text))
        (tmp_path / name / "libro" / f"una.csv{ending}").write_bytes(pack("a\n7\n"))
    plain, packed = (uploads.read_uploads(spark, str(tmp_path / n)) for n in ("plain", "packed"))
    got = rows(profile.profile_cells(packed.cells, packed.catalog))
    assert len(got) == 3 and got == rows(profile.profile_cells(plain.cells, plain.catalog))


def test_proposed_uploads_are_compressed_and_free_their_shuffles(spark):
    from scorelake.demo.queries import REGISTRY

    folders = set((Path(checkpoint.checkpoint_root(spark)) / "scorelake").glob("io-*"))
    got = REGISTRY["propose_uploads"](spark, "/root/testdata/sf0.001")
    assert got.count() == 7
    (new,) = set((Path(checkpoint.checkpoint_root(spark)) / "scorelake").glob("io-*")) - folders
    files = [p.name for p in new.rglob("part-*")]
    assert files and all(f.endswith(".csv.gz") for f in files)


def test_manifest_of_files_that_are_no_single_value(spark, monkeypatch):
    """Files longer than Spark takes as one value still have both digests."""
    from scorelake.demo.queries import REGISTRY
    from scorelake.sources import writers

    setting = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(setting, "5000")
    monkeypatch.setattr(writers, "ONE_VALUE", 5000, raising=False)
    try:
        got = REGISTRY["manifest"](spark, "/root/testdata/sf0.001").collect()
    finally:
        spark.conf.unset(setting)
    assert len(got) == 14 and all(r["digests_agree"] for r in got)

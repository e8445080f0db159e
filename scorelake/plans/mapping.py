"""Guessing which table is which entity and which column is which field.

The input is a catalog frame, one row per (workbook, table, column), so any
number of uploads is scored in one job:
workbook, table_name, table_position, column_name, position.
"""
from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scorelake.functions.dates import canonical_date_text
from scorelake.functions.numbers import half_up, to_double
from scorelake.functions.text import is_blank, normalize_header, pack_json, strip_text
from scorelake.operators.ordinals import exact_quantiles, sequence_id
from scorelake.plans import profile
from scorelake.plans.schemas import (
    ALIASES, BONUS, COLUMNS, FIELD_WORDS, IGNORED_TABLE_WORDS, MAPPING_REQUIRED, PROCESS_REQUIRED, TABLE_WORDS, WEIGHT_RULES,
)
from scorelake.sources.checkpoint import materialize
from scorelake.sources.readers import ORDINAL, empty_table
from scorelake.sources.uploads import read_uploads

MIN_SCORE = 0.4
# Upper 99 % quantile of a scale, its name, maximum, pass mark.
SCALES = [(5.2, "0-5", 5.0, 3.0), (10.5, "0-10", 10.0, 6.0), (None, "0-100", 100.0, 60.0)]


def _strings(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _overlaps(words: Column, text: Column) -> Column:
    return F.exists(words, lambda w: text.contains(w) | w.contains(text))


def build_catalog(spark: SparkSession, workbooks: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """Catalog of tables already opened: only their names are looked at."""
    rows = [
        (book, table, i, column, j)
        for book, tables in workbooks.items()
        for i, (table, df) in enumerate(tables.items())
        for j, column in enumerate(c for c in df.columns if c != ORDINAL)
    ]
    return spark.createDataFrame(rows, "workbook string, table_name string, table_position int, column_name string, position int")


def _word_rows(spark: SparkSession) -> DataFrame:
    """(entity, mark, word): fields by name, bonus sets by number; fixed size."""
    rows = [(e, f, w) for e, fields in FIELD_WORDS.items() for f, words in fields.items() for w in words]
    rows += [(e, f"#{i}", w) for e, (_, _, sets) in BONUS.items() for i, words in enumerate(sets) for w in words]
    return spark.createDataFrame(rows, "entity string, mark string, word string").distinct()


def score_tables(catalog: DataFrame) -> DataFrame:
    """Score of every (table, entity) above zero: 0.6 / 0.4 for the name, up to
    0.4 for the share of fields found, a bonus for key columns, at most 1."""
    spark = catalog.sparkSession
    where = ["workbook", "table_name"]
    # Headers repeat over the uploads: each distinct one is looked up once.
    heads = catalog.select("column_name").distinct().withColumn("word", normalize_header(F.col("column_name")))
    known = heads.join(F.broadcast(_word_rows(spark)), "word")
    # Stored, so that Spark knows how few headers say anything before it joins all columns with them.
    known = materialize(known.groupBy("column_name").agg(F.collect_set(F.struct("entity", "mark")).alias("marks")), "known-headers")
    found = catalog.select(*where, "column_name").join(known, "column_name").select(*where, F.inline("marks")).distinct()
    is_bonus = F.col("mark").startswith("#")
    hits = found.groupBy(*where, "entity").agg(F.count_if(~is_bonus).alias("_fields"), F.count_if(is_bonus).alias("_sets"))
    entities = F.array(
        *[
            F.struct(
                F.lit(i).alias("entity_position"), F.lit(e).alias("entity"), _strings(words).alias("words"),
                F.lit(len(FIELD_WORDS[e])).alias("field_count"),
                F.lit(BONUS[e][0] if e in BONUS else 0.0).alias("bonus"),
                F.lit((len(BONUS[e][2]) if BONUS[e][1] == "all" else 1) if e in BONUS else 99).alias("sets_needed"),
            )
            for i, (e, words) in enumerate(TABLE_WORDS.items())
        ]
    )
    names = catalog.groupBy(*where).agg(F.min("table_position").alias("table_position"))
    named = names.withColumn("_name", normalize_header(F.col("table_name")))
    pairs = named.select("*", F.explode(entities).alias("e")).select("*", "e.*")
    ignored = F.exists(_strings(IGNORED_TABLE_WORDS), lambda w: F.col("_name").contains(w))
    by_name = F.when(F.array_contains("words", F.col("_name")), 0.6).when(_overlaps(F.col("words"), F.col("_name")), 0.4).otherwise(0.0)
    scored = pairs.join(hits, [*where, "entity"], "left").fillna(0, ["_fields", "_sets"])
    bonus = F.when(F.col("_sets") >= F.col("sets_needed"), F.col("bonus")).otherwise(0.0)
    score = F.least(F.lit(1.0), F.round(by_name + (F.col("_fields") / F.col("field_count") * 0.4 + bonus), 2))
    out = scored.withColumn("score", F.when(ignored, 0.0).otherwise(score)).filter("score > 0")
    return out.select(*where, "table_position", "entity", "entity_position", "score")


def greedy_pairs(df: DataFrame, group: list[str], left: str, right: str, ranks: list[Column], rights: int) -> DataFrame:
    """Best-first one-to-one choice of (left, right) pairs inside each group.

    A pair that is offered more than once counts by its best offer. ``rights`` bounds the
    distinct right values of a group. A right value can lose at most rights - 1 lefts to
    the others, so only its best ``rights`` lefts matter; the rest go before the shuffle,
    and what is gathered is at most rights * rights pairs per group, however wide the group was.
    """
    rank = F.struct(*[r.alias(f"_r{i}") for i, r in enumerate(ranks)])
    row = F.struct(*[F.col(c) for c in df.columns if c not in group])
    pairs = df.groupBy(*group, left, right).agg(F.min(F.struct(rank.alias("rank"), row.alias("row"))).alias("_pair"))
    w = Window.partitionBy(*group, right).orderBy("_pair.rank")
    best = pairs.withColumn("_nth", F.row_number().over(w)).filter(F.col("_nth") <= rights)
    offers = best.groupBy(*group).agg(F.array_sort(F.collect_list("_pair")).alias("offers"))
    rows = F.transform("offers", lambda x: x["row"])

    def take(chosen: Column, x: Column) -> Column:
        taken = F.array_contains(chosen[left], x[left]) | F.array_contains(chosen[right], x[right])
        return F.when(taken, chosen).otherwise(F.concat(chosen, F.array(x)))

    chosen = F.aggregate(rows, F.slice(rows, 1, 0), take)
    return offers.select(*group, F.inline(chosen)).select(*df.columns)


def assign_entities(scores: DataFrame, minimum: float = MIN_SCORE) -> DataFrame:
    """One entity per table and one table per entity in every workbook."""
    ranks = [-F.col("score"), F.col("table_position"), F.col("entity_position")]
    return greedy_pairs(scores.filter(F.col("score") >= minimum), ["workbook"], "table_name", "entity", ranks, len(TABLE_WORDS))


def ignored_tables(catalog: DataFrame, assigned: DataFrame) -> DataFrame:
    return catalog.select("workbook", "table_name").distinct().join(assigned, ["workbook", "table_name"], "left_anti")


def map_columns(catalog: DataFrame, assigned: DataFrame) -> DataFrame:
    """(workbook, table, entity, column, field, confidence), one-to-one.

    1.0 for a field's first word or its own name, 0.95 for its other words,
    0.70 for an overlap. Each distinct (entity, header) is scored once, then
    joined back to the many columns that carry it; a header has at most one
    option per field.
    """
    where = ["workbook", "table_name"]
    own = assigned.select(*where, "entity")
    columns = catalog.join(own, where)
    fields = F.create_map(
        *[
            x
            for e, spec in FIELD_WORDS.items()
            for x in (
                F.lit(e),
                F.array(*[F.struct(F.lit(i).alias("place"), F.lit(f).alias("field"), _strings(ws).alias("words")) for i, (f, ws) in enumerate(spec.items())]),
            )
        ]
    )
    heads = columns.select("entity", "column_name").distinct().withColumn("word", normalize_header(F.col("column_name")))
    # One row per head and field: the header is normalised once, below the explode.
    tried = heads.select("*", F.explode(F.element_at(fields, F.col("entity"))).alias("f"))
    word, words = F.col("word"), F.col("f.words")
    top = (word == F.element_at(words, 1)) | (word == F.col("f.field"))
    score = F.when(F.array_contains(words, word), F.when(top, 1.0).otherwise(0.95)).when(_overlaps(words, word), 0.7)
    option = F.struct(F.col("f.place").alias("place"), F.col("f.field").alias("field"), F.col("confidence"))
    fitting = tried.withColumn("confidence", score).filter("confidence is not null")
    heads = materialize(fitting.groupBy("entity", "column_name").agg(F.collect_list(option).alias("options")), "fitting-headers")
    offers = columns.join(heads, ["entity", "column_name"]).select(*where, "entity", "column_name", "position", F.inline("options"))
    ranks = [-F.col("confidence"), F.col("position"), F.col("place")]
    widest = max(len(f) for f in FIELD_WORDS.values())
    chosen = greedy_pairs(offers, [*where, "entity"], "column_name", "field", ranks, widest)
    return chosen.select(*where, "entity", "column_name", "field", "confidence")


def proposal(catalog: DataFrame, minimum: float = MIN_SCORE) -> DataFrame:
    """One row per mapped table, with its mapping and confidences as maps and the columns no field took, in order.

    The maps hold at most one entry per field, the list the other columns of one table. The assignment and
    the mapping, a few rows per workbook, are stored because several joins read them.
    """
    where = ["workbook", "table_name"]
    assigned = materialize(assign_entities(score_tables(catalog), minimum), "assigned")
    mapped = materialize(map_columns(catalog, assigned), "mapped")
    maps = mapped.groupBy(*where).agg(
        F.map_from_entries(F.collect_list(F.struct("column_name", "field"))).alias("column_mapping"),
        F.map_from_entries(F.collect_list(F.struct("field", "confidence"))).alias("field_confidences"),
    )
    spare = ignored_columns(catalog, mapped, assigned).groupBy(*where).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("position", "column_name"))), lambda x: x["column_name"]).alias("ignored_columns"))
    none = F.array().cast("array<string>")
    return (
        assigned.select(*where, "entity", F.col("score").alias("confidence"))
        .join(maps, where, "left").join(spare, where, "left").withColumn("ignored_columns", F.coalesce("ignored_columns", none))
        .withColumn("ignored_column_count", F.size("ignored_columns"))
    )


def ignored_columns(catalog: DataFrame, mapped: DataFrame, assigned: DataFrame | None = None) -> DataFrame:
    """Columns of assigned tables that no field took; without an assignment, of tables of which some column was mapped."""
    where = ["workbook", "table_name"]
    inside = catalog.join((mapped if assigned is None else assigned).select(*where).distinct(), where, "left_semi")
    return inside.select(*where, "column_name", "position").join(mapped.select(*where, "column_name"), [*where, "column_name"], "left_anti")


def sheets(catalog: DataFrame, profiled: DataFrame, minimum: float = MIN_SCORE) -> DataFrame:
    """One row per table of any number of workbooks, mapped or not: entity, confidence, rows, mapping, ignored columns.

    Rows come from the profile, so no table is counted again; a table without rows counts 0.
    """
    where = ["workbook", "table_name"]
    counts = profiled.groupBy(*where).agg(F.max("total_rows").alias("row_count"))
    found = proposal(catalog, minimum).select(*where, "entity", "confidence", "column_mapping", "ignored_columns")
    return counts.join(found, where, "left").select(
        *where, "entity", F.coalesce("confidence", F.lit(0.0)).alias("confidence"), "row_count",
        F.coalesce("column_mapping", F.create_map().cast("map<string,string>")).alias("column_mapping"),
        F.coalesce("ignored_columns", F.array().cast("array<string>")).alias("ignored_columns"))


def detect_scale(scale: DataFrame | None, grades: DataFrame | None) -> DataFrame:
    """One row: scale_type, min_grade, max_grade, passing_grade.

    From the scale table (level, min_score, max_score) when it has rows, or
    else from the 99 % quantile of the scores.
    """
    if scale is not None and not scale.isEmpty():
        order = [ORDINAL] if ORDINAL in scale.columns else ["min_score", "level"]
        low, basic = to_double(F.col("min_score").cast("string")), normalize_header(F.col("level")).contains("basic")
        stats = scale.agg(
            F.max(to_double(F.col("max_score").cast("string"))).alias("max_grade"),
            F.min_by(low, F.when(basic, F.struct(*order))).alias("_basic"),
        )
        middle = exact_quantiles(scale.select(low.alias("v")), "v", [0.5]).agg(F.max("quantile")).scalar()
        kind = F.when(F.col("max_grade") <= 5.5, "0-5").when(F.col("max_grade") <= 10.5, "0-10").otherwise("0-100")
        return stats.select(
            kind.alias("scale_type"), F.lit(0.0).alias("min_grade"), "max_grade", F.coalesce(F.col("_basic"), middle).alias("passing_grade")
        )
    steps = F.array(
        *[
            F.struct(F.lit(t if t is not None else float("inf")).alias("limit"), F.lit(k).alias("scale_type"), F.lit(0.0).alias("min_grade"),
                     F.lit(m).alias("max_grade"), F.lit(p).alias("passing_grade"))
            for t, k, m, p in SCALES
        ]
    )
    if grades is None:
        top = empty_table(SparkSession.active(), []).agg(F.lit(None).cast("double").alias("quantile"))
    else:
        scores = grades.select(to_double(F.col("score").cast("string")).alias("v"))
        top = exact_quantiles(scores.filter(~F.isnan("v")), "v", [0.99]).agg(F.max("quantile").alias("quantile"))
    high = F.coalesce("quantile", F.lit(5.0))
    return top.select(F.element_at(F.filter(steps, lambda s: high <= s["limit"]), 1).alias("s")).select(
        "s.scale_type", "s.min_grade", "s.max_grade", "s.passing_grade"
    )


def weight_rule_shares(assessments: DataFrame, weight: str = "weight", rules=None) -> DataFrame:
    """Per candidate grouping: the share of groups summing to 100 (or 1).

    All candidates are grouped in one pass over the table; a group with a NULL key does
    not count for a candidate that has the key.
    """
    tried = [(place, rule, keys) for place, (rule, keys) in enumerate(rules or WEIGHT_RULES) if set(keys) <= set(assessments.columns)]
    if not tried:
        return None
    columns = list(dict.fromkeys(k for _, _, keys in tried for k in keys))
    value = F.coalesce(to_double(F.col(weight).cast("string")).try_cast("decimal(18,6)"), F.lit(0).cast("decimal(18,6)"))
    sums = assessments.groupingSets([[F.col(k) for k in keys] for _, _, keys in tried], *columns).agg(F.sum(value).alias("total"), F.grouping_id().alias("_set"))
    place = F.lit(None).cast("int")
    for i, _, keys in tried:
        left_out = int("".join("0" if c in keys else "1" for c in columns), 2)
        whole = F.lit(True)
        for k in keys:
            whole = whole & F.col(k).isNotNull()
        place = F.when((F.col("_set") == left_out) & whole, F.lit(i)).otherwise(place)
    good = F.col("total").between(99, 101) | F.col("total").between(0.99, 1.01)
    counted = sums.withColumn("place", place).filter("place IS NOT NULL").groupBy("place").agg(
        half_up(F.count_if(good), F.count(F.lit(1)), 4, "decimal(5,4)").alias("_share"))
    names = assessments.sparkSession.createDataFrame([(i, rule, ",".join(keys)) for i, rule, keys in tried], "place int, rule string, group_cols string")
    return names.join(counted, "place", "left").select(
        "place", "rule", "group_cols", F.coalesce("_share", F.lit(0).cast("decimal(5,4)")).alias("valid_group_ratio"))


def detect_weight_rule(assessments: DataFrame | None, weight: str = "weight", rules=None) -> DataFrame:
    """The grouping with the largest share; the earlier candidate wins a tie.

    The first candidate is the answer when none has a share, and "none" when
    there is no weight to add up.
    """
    name, keys = (rules or WEIGHT_RULES)[0]
    zero = F.lit(0).cast("decimal(5,4)")

    def fixed(rule: str, cols: str) -> DataFrame:
        one = SparkSession.active().range(1)
        return one.select(F.lit(rule).alias("rule"), F.lit(cols).alias("group_cols"), zero.alias("valid_group_ratio"))

    if assessments is not None and (weight not in assessments.columns or assessments.isEmpty()):
        return fixed("none", "")
    shares = weight_rule_shares(assessments, weight, rules) if assessments is not None else None
    if shares is None:
        return fixed(name, ",".join(keys))
    best = shares.orderBy(F.col("valid_group_ratio").desc(), "place").limit(1)
    found = F.col("valid_group_ratio") > 0
    return best.select(
        F.when(found, F.col("rule")).otherwise(name).alias("rule"),
        F.when(found, F.col("group_cols")).otherwise(",".join(keys)).alias("group_cols"), "valid_group_ratio",
    )


def apply_mapping(df: DataFrame, mapping: dict[str, str], entity: str) -> DataFrame:
    """Renames and projects a table onto the entity's canonical text columns.

    Optional fields that are absent are blank: nothing is made up. Columns
    without a place, mapped or not, are packed into ``extra``.
    """
    source = {field: column for column, field in mapping.items() if column in df.columns}
    cells, used = {}, set()
    for name in COLUMNS[entity][:-1]:
        field = next((f for f in [name, *ALIASES.get(name, [])] if f in source), None)
        if field is None:
            cells[name] = F.lit("")
            continue
        used.add(source[field])
        cell = F.col(f"`{source[field]}`").cast("string")
        cells[name] = canonical_date_text(cell) if "date" in name else cell
    if entity == "students" and "full_name" in source:
        used.add(source["full_name"])
        cells["first_name"], cells["last_name"] = F.col(f"`{source['full_name']}`").cast("string"), F.lit("")
    spare = [c for c in df.columns if c not in used and c != ORDINAL]
    cells["extra"] = pack_json(spare)
    kept = [ORDINAL] if ORDINAL in df.columns else []
    out = df.select(*[c.alias(n) for n, c in cells.items()], *kept)
    return name_fallback(out) if entity == "assessments" else out


def name_fallback(assessments: DataFrame) -> DataFrame:
    """When no assessment has a name: the type if any has one, else the id."""
    def all_blank(c: str) -> Column:
        blank = F.coalesce(strip_text(F.col(c)) == "", F.lit(False))
        return assessments.agg(F.coalesce(F.bool_and(blank), F.lit(True))).scalar()

    other = F.when(all_blank("assessment_type"), F.col("assessment_id")).otherwise(F.col("assessment_type"))
    return assessments.withColumn("assessment_name", F.when(all_blank("assessment_name"), other).otherwise(F.col("assessment_name")))


class Proposal(NamedTuple):
    mapping: dict[str, tuple[str, dict[str, str]]]  # entity -> (table, {column: field})
    confidence: dict[str, float]
    ignored: list[str]
    scale: DataFrame
    weight_rule: DataFrame
    warnings: list[str]
    can_process: bool
    profile: DataFrame  # a row per column
    row_counts: dict[str, int]
    ignored_columns: dict[str, list[str]]  # of mapped tables


def mapped_view(tables: dict[str, DataFrame], mapping: dict, entity: str) -> DataFrame | None:
    """The entity's table with mapped columns renamed to their fields."""
    if entity not in mapping:
        return None
    table, fields = mapping[entity]
    df = tables[table]
    kept = [ORDINAL] if ORDINAL in df.columns else []
    return df.select(*[F.col(f"`{c}`").alias(f) for c, f in fields.items()], *kept)


def propose_mapping(tables: dict[str, DataFrame]) -> Proposal:
    """Profile, mapping, scale and weight rule of one set of tables.

    Only names and one number per table come back to the driver; the profile is stored.
    """
    spark = next(iter(tables.values())).sparkSession
    catalog = build_catalog(spark, {"workbook": tables})
    placed = all(ORDINAL in df.columns for df in tables.values())
    order = {n: [ORDINAL] for n in tables} if placed else None
    profiled = materialize(profile.profile_cells(profile.cells_of(tables, order, hidden=(ORDINAL,)), catalog), "profile")
    mapping, confidence, ignored_cells = {}, {}, {}
    row_counts = {}
    for r in sheets(catalog, profiled).collect():
        row_counts[r["table_name"]] = r["row_count"]
        if r["entity"] is not None:
            mapping[r["entity"]] = (r["table_name"], dict(r["column_mapping"]))
            confidence[r["entity"]] = r["confidence"]
            ignored_cells[r["table_name"]] = list(r["ignored_columns"])
    missing = [e for e in PROCESS_REQUIRED if e not in mapping]
    warnings = [f"Faltan hojas obligatorias para el pipeline: {missing}"] if missing else []
    if "courses" not in mapping:
        warnings.append("No se detectó hoja de cursos; las evaluaciones y estudiantes no tendrán referencia de grupo.")
    if "subjects" not in mapping:
        warnings.append("No se detectó catálogo de materias.")
    scale, grades = mapped_view(tables, mapping, "performance_scale"), mapped_view(tables, mapping, "grades")
    scale = scale if scale is not None and {"level", "min_score", "max_score"} <= set(scale.columns) else None
    grades = grades if grades is not None and "score" in grades.columns else None
    work = mapped_view(tables, mapping, "assessments")
    taken = {table for table, _ in mapping.values()}
    ignored = [t for t in tables if t not in taken]
    return Proposal(mapping, confidence, ignored, detect_scale(scale, grades), detect_weight_rule(work), warnings, not missing, profiled, row_counts, ignored_cells)


def propose_uploads(spark: SparkSession, folder: str, minimum: float = MIN_SCORE) -> tuple[DataFrame, DataFrame]:
    """Sheets and profile of every text table below a folder, any number of workbooks in one scan."""
    uploads = read_uploads(spark, folder)
    profiled = materialize(profile.profile_cells(uploads.cells, uploads.catalog), "profile")
    return sheets(uploads.catalog, profiled, minimum), profiled


def missing_fields(mapping: dict) -> list[str]:
    """Mandatory fields, per entity, that the mapping does not supply."""
    gaps = []
    for entity, sets in MAPPING_REQUIRED.items():
        if entity in mapping:
            have = set(mapping[entity][1].values())
            gaps += [f"{entity}: {' | '.join(s)}" for s in sets if not have & set(s)]
    return gaps


def apply_proposal(tables: dict[str, DataFrame], mapping: dict) -> dict[str, DataFrame]:
    """Canonical text tables of every entity, empty ones where nothing maps.

    Grades of which none has an id are numbered G-000001 ... in file order.
    """
    gaps = missing_fields(mapping)
    if gaps:
        raise ValueError(f"mandatory fields are not mapped: {gaps}")
    spark = next(iter(tables.values())).sparkSession
    out = {}
    for entity, columns in COLUMNS.items():
        if entity not in mapping:
            out[entity] = empty_table(spark, columns)
            continue
        table, fields = mapping[entity]
        df = apply_mapping(tables[table], fields, entity)
        if entity == "grades" and ("grade_id" not in fields.values() or df.filter(~is_blank(F.col("grade_id"))).isEmpty()):
            order = [ORDINAL] if ORDINAL in df.columns else ["student_id", "assessment_id", "score", "submission_date", "extra"]
            df = sequence_id(df, [F.col(o) for o in order], "grade_id")
        out[entity] = df
    return out

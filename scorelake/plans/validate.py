"""Validation and quarantine.

Each ``label_*`` function adds ``error_reason`` (the first failing rule, NULL
when the row is valid) and ``_log`` (its corrections) to every row, in one
plan. ``split`` turns a labelled frame into valid rows, errors and
corrections. ``order`` names the columns that give file order; "keep the
first" refers to it.
"""
from __future__ import annotations

from collections.abc import Callable
from functools import partial
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.functions.dates import parse_date_multi
from scorelake.functions.numbers import COMMA_DECIMAL, float_or_null, float_text, stripped_float
from scorelake.functions.text import NULL_WORDS, VALIDATOR_GENDER, collapse_spaces, gender_code, is_blank, strip_seldom_padded, strip_text
from scorelake.operators.duplicates import flag_duplicates
from scorelake.operators.group_sums import flag_group_sum
from scorelake.operators.references import is_empty, mark_present
from scorelake.plans.schemas import PRIMARY_KEY, VALIDATED
from scorelake.sources.checkpoint import COMPACT, Steps, materialize
from scorelake.sources.parallel import together
from scorelake.sources.readers import ORDINAL

LOG_TYPE = "array<struct<field:string,original:string,corrected:string,reason:string>>"


class Split(NamedTuple):
    valid: DataFrame
    errors: DataFrame
    corrections: DataFrame


def first_reason(*rules: tuple[Column, Column | str]) -> Column:
    """The text of the first rule that holds, else NULL."""
    out = F.lit(None).cast("string")
    for broken, text in reversed(rules):
        out = F.when(broken, F.lit(text) if isinstance(text, str) else text).otherwise(out)
    return out


def _note(field: str, original: Column, corrected: Column, reason: Column | str, when: Column) -> Column:
    reason = F.lit(reason) if isinstance(reason, str) else reason
    entry = F.struct(
        F.lit(field).alias("field"), original.alias("original"), corrected.alias("corrected"), reason.alias("reason")
    )
    return F.when(when, entry)


def _log(*notes: Column) -> Column:
    return F.array_compact(F.array(*notes)).cast(LOG_TYPE)


def _no_log() -> Column:
    return F.array().cast(LOG_TYPE)


def _shown(c: Column) -> Column:
    """Stripped text as the reasons print it; NULL reads 'nan'."""
    return F.coalesce(strip_text(c), F.lit("nan"))


def label_courses(df: DataFrame, order: list[str]) -> DataFrame:
    marked = flag_duplicates(df, ["course_id"], order)
    reason = first_reason(
        (is_blank(F.col("course_id")), "Null or empty course_id"),
        (F.col("_duplicate"), F.concat(F.lit("Duplicate course_id primary key: "), "course_id")),
    )
    return marked.withColumn("error_reason", reason).withColumn("_log", _no_log()).drop("_duplicate")


def label_subjects(df: DataFrame, order: list[str]) -> DataFrame:
    marked = flag_duplicates(df, ["subject_id"], order)
    reason = first_reason(
        (is_blank(F.col("subject_id")), "Null or empty subject_id"),
        (is_blank(F.col("subject_name")), "Null or empty subject_name"),
        (F.col("_duplicate"), F.concat(F.lit("Duplicate subject_id: "), "subject_id")),
    )
    return marked.withColumn("error_reason", reason).withColumn("_log", _no_log()).drop("_duplicate")


def label_students(
    df: DataFrame, order: list[str], as_of: Column, courses: DataFrame | None = None, gender_words: dict | None = None
) -> DataFrame:
    """Names and genders are corrected in place before the rules run."""
    words = gender_words or VALIDATOR_GENDER
    name, neat = F.col("first_name"), collapse_spaces(F.col("first_name"))
    gender = strip_text(F.col("gender"))
    code = F.when(F.lower(gender).isin([w for ws in words.values() for w in ws]), gender_code(gender, words))
    respaced = F.coalesce((neat != name) & ~name.isin(NULL_WORDS[1:]), F.lit(False))
    recoded = F.coalesce(code != gender, F.lit(False))
    fixed = df.withColumn(
        "_log",
        _log(
            _note("first_name", name, neat, "Espacios y formato en nombre corregidos", respaced),
            _note("gender", gender, code, "Normalización de género a estándar ('M'/'F')", recoded),
        ),
    ).withColumns(
        {
            "first_name": F.when(respaced, neat).otherwise(name),
            "gender": F.when(recoded, code).otherwise(F.col("gender")),
            "_birth": parse_date_multi(F.col("birth_date")),
        }
    )
    marked = flag_duplicates(fixed, ["student_id"], order, out="_dup_id")
    has_document = ~is_blank(F.col("document_number"), ["", "nan"])
    marked = flag_duplicates(marked, ["document_number"], order, has_document, "_dup_document")
    unknown_course = F.lit(False)
    if courses is not None:
        marked = marked.withColumn("_course", strip_text(F.col("course_id")))
        known = courses.select(strip_text(F.col("course_id")).alias("course_id"))
        marked = mark_present(marked, "_course", known, "course_id")
        unknown_course = ~is_blank(F.col("course_id")) & ~F.col("_present") & ~is_empty(known)
    birth, raw = F.col("_birth"), F.col("birth_date")
    born = ~is_blank(raw)
    reason = first_reason(
        (is_blank(F.col("student_id")), "Null or empty student_id"),
        (born & birth.isNull(), F.concat(F.lit("Invalid birth_date format: '"), raw, F.lit("'"))),
        (
            born & ((F.year(birth) < 1920) | (birth > as_of)),
            F.concat(F.lit("Impossible birth_date: '"), raw, F.lit("' (out of biological bounds)")),
        ),
        (unknown_course, F.concat(F.lit("curso_id inexistente ("), strip_text(F.col("course_id")), F.lit(")"))),
        (F.col("_dup_id"), F.concat(F.lit("estudiante_id duplicado: "), "student_id")),
        (F.col("_dup_document"), F.concat(F.lit("documento duplicado: "), "document_number")),
    )
    return marked.withColumn("error_reason", reason).drop("_birth", "_dup_id", "_dup_document", "_course", "_present")


def _quoted(c: Column) -> Column:
    """Text as Python's repr shows it inside a tuple."""
    return F.when(c.contains("'") & ~c.contains('"'), F.concat(F.lit('"'), c, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("\\'")), F.lit("'"))
    )


def label_assessments(
    df: DataFrame,
    order: list[str],
    subjects: DataFrame | None = None,
    tolerance: float = 0.5,
    null_keys: str = "skip",
    steps: Steps | None = None,
) -> DataFrame:
    """Row rules first; then whole groups whose weights do not sum to 100 (or 1).

    Groups are (subject, period), or subject alone when no still-valid row
    carries a period. ``steps`` keeps what is stored on the way until it is cleared.
    """
    settle = steps.groups if steps else None
    number = float_or_null(F.replace("weight_percentage", F.lit(","), F.lit(".")))
    marked = flag_duplicates(df.withColumn("_number", F.nanvl(number, F.lit(None))), ["assessment_id"], order, settle=settle)
    unknown = F.lit(False)
    if subjects is not None:
        marked = marked.withColumn("_subject", strip_text(F.col("subject_id")))
        known = subjects.select(strip_text(F.col("subject_id")).alias("subject_id"))
        marked = mark_present(marked, "_subject", known, "subject_id", settle=settle)
        unknown = ~is_blank(F.col("subject_id")) & ~F.col("_present") & ~is_empty(known)
    weight = F.col("_number")
    by_row = first_reason(
        (is_blank(F.col("assessment_id")), "Null or empty assessment_id"),
        (is_blank(F.col("assessment_name")), "Null or empty assessment_name"),
        ((weight < 0) | (weight > 100), F.concat(F.lit("Weight percentage out of allowed range [0-100%]: "), float_text(weight))),
        (weight.isNull(), F.concat(F.lit("Non-numeric weight percentage: '"), _shown(F.col("weight_percentage")), F.lit("'"))),
        (unknown, F.concat(F.lit("Foreign key violation: subject_id '"), strip_text(F.col("subject_id")), F.lit("' does not exist"))),
        (F.col("_duplicate"), F.concat(F.lit("Duplicate assessment_id: "), "assessment_id")),
    )
    rows = marked.withColumns({"error_reason": by_row, "_weight": weight.try_cast("decimal(18,6)")})
    rows = rows.drop("_duplicate", "_subject", "_present", "_number")
    # Stored here: the period test, the group sums and the rows all read it.
    rows = steps.next(rows, "assessment-rows") if steps else materialize(rows, "assessment-rows", COMPACT)
    sound = F.col("error_reason").isNull()
    by_period = not rows.filter(sound & ~is_blank(F.col("period_id"))).isEmpty()
    keys = ["subject_id", "period_id"] if by_period else ["subject_id"]
    rows = flag_group_sum(rows, keys, F.col("_weight"), sound, 100, tolerance, (1.0, 0.01), null_keys, settle=settle)
    subject = F.coalesce(F.col("subject_id"), F.lit("nan"))
    period = F.coalesce(F.col("period_id"), F.lit("nan"))
    pair = F.concat(F.lit("("), _quoted(subject), F.lit(", "), _quoted(period), F.lit(")"))
    by_group = F.concat(
        F.lit("pesos de evaluación del grupo "), pair if by_period else subject, F.lit(" suman "),
        float_text(F.bround(F.col("_bad_total"), 2).cast("double")), F.lit("%, esperado 100%"),
    )
    reason = F.coalesce("error_reason", F.when(F.col("_bad_total").isNotNull(), by_group))
    return rows.withColumn("error_reason", reason).withColumn("_log", _no_log()).drop("_weight", "_bad_total")


def label_grades(
    df: DataFrame,
    order: list[str],
    as_of: Column,
    students: DataFrame | None = None,
    assessments: DataFrame | None = None,
    max_scale: float = 5.0,
    steps: Steps | None = None,
) -> DataFrame:
    """``_fixed_score`` carries the comma-corrected score of a valid row;
    ``score`` keeps the text as it came, which is what errors show.

    With ``steps`` the rows are stored after every join that shuffles them, and parsed after the last one.
    """
    text = strip_text(F.col("score"))
    dotted = F.when(text.rlike(COMMA_DECIMAL), F.replace(text, F.lit(","), F.lit("."))).otherwise(text)
    cells = {"_dotted": dotted, "_value": float_or_null(dotted), "_day": parse_date_multi(F.col("submission_date"))}
    # Parsed before the joins, so that a later filter on the reason reuses them.
    rows = df if steps else df.withColumns(cells)
    settle = steps.groups if steps else None
    keys = [c for c in ["student_id", "assessment_id", "score", "submission_date"] if c in df.columns]
    rows = flag_duplicates(rows, keys, order, settle=settle) if len(keys) >= 2 else rows.withColumn("_duplicate", F.lit(False))
    unknown = {}
    for key, parent in (("student_id", students), ("assessment_id", assessments)):
        unknown[key] = F.lit(False)
        if parent is not None:
            known = parent.select(strip_text(F.col(key)).alias(key))
            rows = steps.next(rows, "grade-rows") if steps and steps.shuffled else rows
            rows = rows.withColumn("_key", _shown(F.col(key)))
            rows = mark_present(rows, "_key", known, key, f"_has_{key}", settle).drop("_key")
            unknown[key] = ~F.col(f"_has_{key}") & ~is_empty(known)
    rows = rows.withColumns(cells) if steps else rows
    raw, day, value, parsed = F.col("score"), F.col("submission_date"), F.col("_value"), F.col("_day")
    comma, dotted, dated = text != F.col("_dotted"), F.col("_dotted"), ~is_blank(day)
    reason = first_reason(
        (F.col("_duplicate"), "fila duplicada"),
        (is_blank(raw), "nota nula"),
        (
            ~F.isnan(value) & ((value < 0) | (value > max_scale)),
            F.concat(F.lit("nota fuera de rango ("), float_text(value), F.lit(")")),
        ),
        (value.isNull(), F.concat(F.lit("nota no numérica ('"), raw, F.lit("')"))),
        (unknown["student_id"], F.concat(F.lit("estudiante_id inexistente ("), _shown(F.col("student_id")), F.lit(")"))),
        (unknown["assessment_id"], F.concat(F.lit("evaluacion_id inexistente ("), _shown(F.col("assessment_id")), F.lit(")"))),
        (dated & parsed.isNull(), F.concat(F.lit("fecha inválida (texto '"), day, F.lit("')"))),
        (dated & (parsed > as_of), F.concat(F.lit("fecha futura ("), day, F.lit(")"))),
    )
    why = F.concat(F.lit("Conversión de decimal con coma '"), text, F.lit("' a formato punto '"), dotted, F.lit("'"))
    reached = ~F.col("_duplicate") & F.coalesce(comma, F.lit(False))
    return rows.withColumns(
        {
            "error_reason": reason,
            "_log": _log(_note("score", text, dotted, why, reached)),
            "_fixed_score": F.when(comma, dotted).otherwise(raw),
        }
    ).drop("_duplicate", "_has_student_id", "_has_assessment_id", "_dotted", "_value", "_day")


def label_attendance(df: DataFrame) -> DataFrame:
    """Counts may be written as decimals and are cut to whole numbers."""
    def whole(name: str) -> Column:
        return stripped_float(strip_seldom_padded(F.col(name))).try_cast("bigint")

    student = strip_seldom_padded(F.col("student_id"))
    counted = df.withColumns({"_total": whole("total_classes"), "_absences": whole("absences")})
    total, absences = F.col("_total"), F.col("_absences")
    reason = first_reason(
        (student.isNull() | student.isin(NULL_WORDS), "Null or empty student_id"),
        (total.isNull() | absences.isNull(), "Valores de asistencia no enteros"),
        (absences < 0, "inasistencias negativas"),
        (absences > total, "inasistencias > días de clase"),
    )
    return counted.withColumn("error_reason", reason).withColumn("_log", _no_log()).drop("_total", "_absences")


def corrections_log(labelled: DataFrame, entity: str) -> DataFrame:
    """One row per corrected cell, rejected rows included."""
    key = PRIMARY_KEY[entity]
    notes = labelled.filter(F.size("_log") > 0).select(F.col(key).alias("id"), F.explode("_log").alias("n"))
    return notes.select(F.lit(entity).alias("entity"), F.coalesce("id", F.lit("nan")).alias("id"), "n.*")


def split(labelled: DataFrame, entity: str) -> Split:
    """Valid rows, errors with their reason, and the corrections log.

    The labelled frame is read three times; pass one that is stored.
    """
    data = [c for c in labelled.columns if not c.startswith("_") and c != "error_reason"]
    if ORDINAL in labelled.columns:
        data.append(ORDINAL)
    kept = labelled.filter(F.col("error_reason").isNull())
    if "_fixed_score" in labelled.columns:
        kept = kept.withColumn("score", F.col("_fixed_score"))
    bad = labelled.filter(F.col("error_reason").isNotNull())
    return Split(kept.select(*data), bad.select(*data, "error_reason"), corrections_log(labelled, entity))


def validate_all(
    tables: dict[str, DataFrame], order: dict[str, list[str]], as_of: Column, max_scale: float = 5.0,
    sink: Callable[[str, Split], Split] | None = None,
) -> dict[str, Split]:
    """All entities in dependency order, valid keys feeding the next rules.

    Every labelled frame is written once, so neither the three outputs nor the
    later entities run its joins again. Entities that do not depend on each
    other are validated side by side. ``sink`` (entity, split) -> split stores the three outputs; the
    labelled frame is deleted after that.
    """
    done: dict[str, Split] = {}

    def valid(entity: str) -> DataFrame | None:
        return done[entity].valid if entity in done else None

    labels = {
        "courses": lambda df, o, s: label_courses(df, o),
        "subjects": lambda df, o, s: label_subjects(df, o),
        "attendance": lambda df, o, s: label_attendance(df),
        "students": lambda df, o, s: label_students(df, o, as_of, valid("courses")),
        "assessments": lambda df, o, s: label_assessments(df, o, valid("subjects"), steps=s),
        "grades": lambda df, o, s: label_grades(df, o, as_of, valid("students"), valid("assessments"), max_scale, s),
    }

    def judge(entity: str) -> Split:
        steps = Steps(tables[entity].sparkSession)
        try:
            labelled = labels[entity](tables[entity], order.get(entity, [ORDINAL]), steps)
            if sink is None:
                return split(materialize(labelled, f"labelled-{entity}", COMPACT), entity)
            return sink(entity, split(steps.next(labelled, f"labelled-{entity}"), entity))
        finally:
            steps.clear()

    for wave in (["courses", "subjects", "attendance"], ["students", "assessments"], ["grades"]):
        jobs = {e: partial(judge, e) for e in wave if e in tables}
        if jobs:
            done.update(together(next(iter(tables.values())).sparkSession, jobs))
    return {e: done[e] for e in VALIDATED if e in done}


def summary(splits: dict[str, Split]) -> DataFrame:
    """entity, total, valid and errors, counted in one job."""
    frames = None
    for entity, s in splits.items():
        flags = s.valid.select(F.lit(1).alias("ok")).unionByName(s.errors.select(F.lit(0).alias("ok")))
        row = flags.agg(
            F.lit(entity).alias("entity"), F.count(F.lit(1)).alias("total"),
            F.count_if(F.col("ok") == 1).alias("valid"), F.count_if(F.col("ok") == 0).alias("errors"),
        )
        frames = row if frames is None else frames.unionByName(row)
    return frames


def check_required(df: DataFrame, required: list[str], entity: str) -> DataFrame:
    """One row per mandatory column: is it there, and how many cells are blank.

    All present columns are counted in a single pass.
    """
    cells = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(c in df.columns).alias("present"),
            (F.count_if(is_blank(F.col(c).cast("string"))) if c in df.columns else F.lit(None).cast("bigint")).alias("blank_count"),
        )
        for c in required
    ]
    return df.agg(F.array(*cells).alias("x")).select(F.lit(entity).alias("entity"), F.inline("x"))


def error_reasons(errors: DataFrame) -> DataFrame:
    return errors.groupBy("error_reason").agg(F.count(F.lit(1)).alias("error_count"))


def error_sample(errors: DataFrame, entity: str, n: int = 50, order: list[str] | None = None) -> DataFrame:
    """First n quarantined rows as text, NULL shown as '', with the full count."""
    shown = [c for c in errors.columns if not c.startswith("_")]
    total = errors.agg(F.count(F.lit(1))).scalar()
    first = (errors.orderBy(*order) if order else errors).limit(n)
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in shown]
    return first.select(F.lit(entity).alias("entity"), total.alias("error_total"), *cells)

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from scorelake.functions import dates, numbers, predicates, text
from scorelake.plans import mapping


def values(spark, column, rows, dtype="string"):
    df = spark.createDataFrame([(r,) for r in rows], f"c {dtype}")
    return [r[0] for r in df.select(column(F.col("c"))).collect()]


def test_text_cleaning(spark):
    assert values(spark, lambda C: text.blank_to_null(C), [" a ", "  ", None]) == ["a", None, None]
    assert values(spark, lambda C: text.strip_text(C), ["\t a \n"]) == ["a"]
    assert values(spark, lambda C: text.null_words(C), [" nan ", "None", "", " x "]) == [None, None, None, " x "]
    assert values(spark, lambda C: text.lower_email(C), [" A@B.Co ", " "]) == ["a@b.co", None]
    assert values(spark, lambda C: text.default_status(C), [" retirado", "", None]) == ["RETIRADO", "ACTIVO", "ACTIVO"]
    assert values(spark, lambda C: text.gender_code(C), [" Mujer", "HOMBRE", "fem", "otro", " "]) == ["F", "M", "fem", "otro", None]
    assert values(spark, lambda C: text.gender_code(C, text.VALIDATOR_GENDER), ["fem"]) == ["F"]
    assert values(spark, lambda C: text.collapse_spaces(C), ["  ANA \t MARIA "]) == ["ANA MARIA"]
    assert values(spark, lambda C: text.json_or_null(C), ['{"a": 1}', "{bad", " "]) == ['{"a": 1}', None, None]


@pytest.mark.parametrize("header", [text.normalize_header, text.normalize_header_nfkd])
def test_headers(spark, header):
    rows = ["  Código del Alumno ", "Nota (Final)", "PESO_%", "ñandú-Ü", None, "__x__"]
    assert values(spark, lambda C: header(C), rows) == ["codigo_del_alumno", "nota_final", "peso", "nandu_u", "", "x"]


def test_full_name_is_null_when_a_part_is(spark):
    assert values(spark, lambda C: text.full_name(C, F.lit("B")), ["A", None]) == ["A B", None]


def test_number_casts(spark):
    assert values(spark, lambda C: numbers.guarded_int(C), [" 12 ", "1.5", "-3", "99999999999"]) == [12, None, None, None]
    got = values(spark, lambda C: numbers.decimal_comma(C), ["4,5", "4.555", "1234.5", "x", " 3.0", "-1,25"])
    assert got == [Decimal("4.50"), Decimal("4.56"), None, None, None, Decimal("-1.25")]
    assert values(spark, lambda C: numbers.to_double(C), [" 4,5 ", "1e2", ".5", "5.", "1d", "0x1", "1_0"]) == [4.5, 100.0, 0.5, 5.0, None, None, None]


@pytest.mark.parametrize("x", [7.2, -1.5, 150.0, 12345678.0, 0.0001, 1e16, 1.5e22, 1e-5, 2.5e-7, float("inf"), 0.00025, 123456789012.25])
def test_float_text_prints_like_python(spark, x):
    assert values(spark, lambda C: numbers.float_text(C), [x], "double") == [repr(x)]


def test_exact_rounding(spark):
    df = spark.createDataFrame([(1, 8), (5, 0), (473, 200), (-473, 200)], "a bigint, b bigint")
    up = df.select(numbers.half_up(F.col("a"), F.col("b"), 2, "decimal(9,2)")).collect()
    assert [r[0] for r in up] == [Decimal("0.13"), None, Decimal("2.37"), Decimal("-2.37")]
    even = df.filter("a > 0").select(numbers.half_even(F.col("a"), F.col("b"), 2, "decimal(9,2)")).collect()
    assert [r[0] for r in even] == [Decimal("0.12"), None, Decimal("2.36")]


def test_mean_on_a_tie_rounds_up(spark):
    df = spark.createDataFrame([(Decimal("2.36"),), (Decimal("2.37"),)], "c decimal(5,2)")
    assert df.agg(numbers.mean_2(F.col("c"))).first()[0] == Decimal("2.37")
    assert df.limit(0).agg(numbers.mean_2(F.col("c"))).first()[0] is None


def test_points_bands_and_verdicts(spark):
    df = spark.createDataFrame([(Decimal("4.35"), Decimal("12.50"))], "s decimal(5,2), w decimal(5,2)")
    assert df.select(numbers.weighted_points(F.col("s"), F.col("w"))).first()[0] == Decimal("0.544")
    rows = [Decimal(x) for x in ("4.50", "4.49", "3.00", "2.99")]
    bands = values(spark, lambda C: numbers.performance_band(C), rows, "decimal(5,2)")
    assert bands == ["Excelente (Cuadro de Honor)", "Sobresaliente", "Aceptable", "Bajo / En Riesgo Académico"]


def test_dates(spark):
    rows = ["2025-02-03", "2025-2-3 10:05:59", "3/2/2025", "03-02-2025 1:2:3", "2025/02/03", "2025-02/03", "2025-02-30", "31/04/2025", "x", " ", None,
            "2025-02-03 24:00:00", "0000-01-01", "2025-02-03x"]
    d = date(2025, 2, 3)
    assert values(spark, lambda C: dates.parse_date_multi(C), rows) == [d, d, d, d, d, *[None] * 9]
    assert values(spark, lambda C: dates.canonical_date_text(C), ["3/2/2025", " 31/04/2025 ", " ", None]) == ["2025-02-03", "31/04/2025", "", ""]
    assert values(spark, lambda C: dates.guarded_iso_date(C), ["2025-02-03", " 2025-02-03", "2025-02-30", "2025-13-01"]) == [d, None, None, None]
    assert values(spark, lambda C: dates.iso_prefix_date(C), ["2025-02-03 00:00:00", "soon"]) == [d, None]


def test_predicates(spark):
    as_of = F.lit("2026-01-01").cast("date")
    assert values(spark, lambda C: predicates.decimal_in_range(C, 0, 5), ["5,0", "5.01", "x", None]) == [True, False, False, False]
    assert values(spark, lambda C: predicates.date_not_after(C, as_of), [None, " ", "2026-01-01", "2026-01-02", "1/1/2020"]) == [True, True, True, False, False]
    assert values(spark, lambda C: predicates.plausible_birth(C, as_of), ["1919-12-31", "1920-01-01", "2030-01-01"]) == [False, True, False]
    df = spark.createDataFrame([("3", "10"), ("-1", "10"), ("11", "10"), ("x", "10")], "a string, t string")
    assert [r[0] for r in df.select(predicates.absences_in_bounds(F.col("a"), F.col("t"))).collect()] == [True, False, False, False]


def test_pack_json_keeps_only_filled_cells(spark):
    df = spark.createDataFrame([("1", None), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(text.pack_json(["a", "b"])).collect()] == ['{"a":"1"}', ""]


def test_scale_constants_cover_every_maximum():
    assert [s[0] for s in mapping.SCALES][-1] is None


def test_both_strips_do_as_python(spark):
    ends = ["", " ", "\t", "\x1c", "\x00", "!", "~", "\x7f", "\x80", "\x85", "\xa0", "é", "\u2003", "\u3000", "😀"]
    cells = [f"{a}{m}{b}" for a in ends for m in ("", "a", "a b") for b in ends]
    for strip in (text.strip_text, text.strip_seldom_padded):
        assert values(spark, lambda C, strip=strip: strip(C), [*cells, None]) == [*(c.strip() for c in cells), None]

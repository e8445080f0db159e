"""Scalar text operators. Every function takes and returns a Column."""
from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words that mean "no value" once loaded as text.
NULL_WORDS = ["", "nan", "None"]

# Gender words. The loader and the validator differ by one word.
STAGING_GENDER = {"M": ["m", "masculino", "male", "hombre"], "F": ["f", "femenino", "female", "mujer"]}
VALIDATOR_GENDER = {"M": STAGING_GENDER["M"], "F": ["f", "femenino", "female", "fem", "mujer"]}

# Every character Python's str.strip() removes; F.trim alone only drops spaces.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def _accent_table() -> tuple[str, str]:
    """Latin letters whose compatibility form starts with a lone ASCII letter."""
    src, dst = [], []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        folded = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode()
        if len(folded) == 1:
            src.append(chr(code))
            dst.append(folded)
    return "".join(src), "".join(dst)


_ACCENTED, _PLAIN = _accent_table()


def trim_text(c: Column) -> Column:
    """Drop surrounding spaces (spaces only, as SQL TRIM does)."""
    return F.trim(c)


def strip_text(c: Column) -> Column:
    """Drop surrounding whitespace of every kind."""
    return F.btrim(c, F.lit(WHITESPACE))


def strip_seldom_padded(c: Column) -> Column:
    """As strip_text, for cells that are seldom padded: text with a visible ASCII character (! to DEL) at both ends
    is kept without a search among all the whitespace. Its code is longer, so it is not for stages of many expressions."""
    def visible(x: Column) -> Column:
        return (x >= "!") & (x < "\x80")

    return F.when(visible(c) & visible(F.substring(c, -1, 1)), c).otherwise(strip_text(c))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def null_words(c: Column, words: list[str] | None = None) -> Column:
    """NULL when the stripped text is a no-value word; otherwise untouched."""
    return F.when(~strip_text(c).isin(words or NULL_WORDS), c)


def is_blank(c: Column, words: list[str] | None = None) -> Column:
    """True for NULL, blank text and no-value words."""
    return c.isNull() | strip_text(c).isin(words or NULL_WORDS)


def lower_email(c: Column) -> Column:
    return F.nullif(F.lower(F.trim(c)), F.lit(""))


def default_status(c: Column, default: str = "ACTIVO") -> Column:
    return F.coalesce(F.nullif(F.upper(F.trim(c)), F.lit("")), F.lit(default))


def gender_code(c: Column, words: dict[str, list[str]] | None = None) -> Column:
    """Known words become their code; other text is kept trimmed, blank is NULL."""
    low, out = F.lower(F.trim(c)), blank_to_null(c)
    for code, names in (words or STAGING_GENDER).items():
        out = F.when(low.isin(names), F.lit(code)).otherwise(out)
    return out


def collapse_spaces(c: Column) -> Column:
    """Runs of whitespace become one space, and the ends are stripped."""
    return strip_text(F.regexp_replace(c, "(?U)\\s+", " "))


def _header_shape(c: Column) -> Column:
    words = F.regexp_replace(F.regexp_replace(c, "[^\\x00-\\x7F]", ""), "[^\\w\\s]", " ")
    return F.btrim(F.regexp_replace(words, "\\s+", "_"), F.lit("_"))


def normalize_header(c: Column) -> Column:
    """Lower snake_case ASCII form of a header, Latin accents folded, JVM only."""
    return F.coalesce(_header_shape(F.translate(F.lower(strip_text(c)), _ACCENTED, _PLAIN)), F.lit(""))


@F.pandas_udf(T.StringType())
def _nfkd_ascii(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFKD").str.encode("ascii", "ignore").str.decode("ascii")


def normalize_header_nfkd(c: Column) -> Column:
    """As normalize_header for every script that decomposes (Arrow batches)."""
    return F.coalesce(_header_shape(_nfkd_ascii(F.lower(strip_text(c)))), F.lit(""))


def full_name(first: Column, last: Column) -> Column:
    """First and last name with one space; NULL if either is NULL."""
    return F.concat(first, F.lit(" "), last)


def label_or(c: Column, label: str) -> Column:
    return F.coalesce(c, F.lit(label))


def named(column: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + column.replace("`", "``") + "`")


def contains_any(columns: list[str], needle: str) -> Column:
    """Case-insensitive contains over the text of all the given columns."""
    shown = F.concat_ws(" ", *[named(c).cast("string") for c in columns])
    return F.lower(shown).contains(needle.lower())


def json_or_null(c: Column) -> Column:
    """Blank or malformed JSON text becomes NULL; valid text is kept as it is."""
    body = blank_to_null(c)
    return F.when(F.try_parse_json(body).isNotNull(), body)


def pack_json(columns: list[str]) -> Column:
    """The non-null columns as one JSON object of texts, '' when there is none."""
    pairs = [x for c in columns for x in (F.lit(c), named(c).cast("string"))]
    if not pairs:
        return F.lit("")
    kept = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())
    return F.when(F.size(kept) > 0, F.to_json(kept)).otherwise(F.lit(""))

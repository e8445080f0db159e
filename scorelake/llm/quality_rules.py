"""Quality rules: how much of a text lies inside repeated word n-grams and lines."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.llm import bytescan as B

#: Fixed values, the published Gopher limits: largest share of word characters inside repeated n-grams, by n.
NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Largest share of word characters in lines that repeat an earlier line.
LINE_LIMIT = 0.20
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
NOT_NEWLINE = np.ones(256, bool)
NOT_NEWLINE[0x0A] = False


def measure(buf: np.ndarray, off: np.ndarray, limits: dict[int, float]) -> dict[str, np.ndarray]:
    """All measures of each text of a slice, as columns."""
    docs = len(off) - 1
    starts, ends, first = B.spans(buf, off, B.SPACED_WORD)
    n_words = np.diff(first)
    doc = np.repeat(np.arange(docs), n_words)
    points = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    chars = points[ends] - points[starts]
    word_chars = B.totals_by_text(chars, first)
    n_symbols = B.totals_by_text(SYMBOLS[buf], off)

    lines, line_ends, first_line = B.spans(buf, off, NOT_NEWLINE)
    low, high = np.searchsorted(starts, lines), np.searchsorted(starts, line_ends)
    worded = high > low
    line_doc = np.repeat(np.arange(docs), np.diff(first_line))
    keys = B.mix(B.span_hashes(buf, lines, line_ends) + line_doc.astype(B.U) * B.U(B.BASE))
    _, before = B.seen_twice(keys[worded])
    dup_line = np.zeros(len(lines), bool)
    dup_line[worded] = before
    upto = np.concatenate([[0], np.cumsum(chars)])
    line_chars = (upto[high] - upto[low]) * dup_line
    out = {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols,
        "n_dup_lines": B.totals_by_text(dup_line, first_line),
        "dup_line_share": B.totals_by_text(line_chars, first_line) / np.maximum(word_chars, 1),
    }

    words = B.span_hashes(buf, starts, ends)
    last = np.repeat(first[1:], n_words)

    def covered(n: int, repeats_only: bool) -> np.ndarray:
        """Which words lie in n-word windows found twice; repeats_only leaves out first finds."""
        marks = np.zeros(len(words) + 1, np.int64)
        hashes = B.rolling(words, n)
        fits = np.flatnonzero(np.arange(len(hashes)) + n <= last[: len(hashes)])
        found = B.seen_twice(B.mix(hashes[fits] + doc[fits].astype(B.U) * B.U(B.BASE)))[int(repeats_only)]
        at = fits[found]
        np.add.at(marks, at, 1) if len(at) < 64 else marks.__iadd__(np.bincount(at, minlength=len(marks)))
        marks -= np.bincount(at + n, minlength=len(marks))[: len(marks)]
        return np.cumsum(marks[:-1]) > 0

    out["n_repeat_words"] = B.totals_by_text(covered(3, False), first)
    for n in limits:
        out[f"dup_{n}"] = B.totals_by_text(chars * covered(n, True), first) / np.maximum(word_chars, 1)
    return out


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    ngram_limits: dict[int, float] = NGRAM_LIMITS, line_limit: float = LINE_LIMIT, min_words: int = 50,
) -> DataFrame:
    """One row per input row: the counts, the share of word characters inside n-grams
    (`dup_<n>`) and lines that repeat an earlier one of the same text, and verdicts.

    `base_failed`: fewer than `min_words` words, or over half of the words inside
    3-word windows found twice. `kept`: not failed, and every share within its limit.
    Hashes are rolled over word hashes once per n-gram length, in numpy, on slices of
    bounded size; nothing is shuffled, so no key can be hot.

    Null and empty texts have zero counts and fail. Repeated rows give repeated results,
    null ids stay null, other columns are not read. An empty table gives an empty table.
    """
    shares = [f"dup_{n}" for n in ngram_limits]
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in B.slices(batch, "text"):
                m = measure(*B.text_bytes(part.column("text")), ngram_limits)
                failed = (m["n_words"] < min_words) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
                kept = ~failed & (m["dup_line_share"] <= line_limit)
                for n, limit in ngram_limits.items():
                    kept &= m[f"dup_{n}"] <= limit
                columns = [pa.array(m[c].astype(np.int64)) for c in longs]
                columns += [pa.array(m[c].astype(np.float64)) for c in ["dup_line_share", *shares]]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *columns, pa.array(failed), pa.array(kept)],
                    ["id", *longs, "dup_line_share", *shares, "base_failed", "kept"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = ", ".join([
        f"id {rows.schema['id'].dataType.simpleString()}", *(f"{c} long" for c in longs),
        *(f"{c} double" for c in ["dup_line_share", *shares]), "base_failed boolean", "kept boolean"])
    return rows.mapInArrow(scan, schema).withColumnRenamed("id", id_col)

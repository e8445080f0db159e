"""Quality classifier: a factorisation machine over hashed words, structure and metadata."""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.llm import bytescan as B

#: Hashed word features; structure features come before them.
WORD_BITS = 14
RANK = 8
#: Most labelled rows that training reads, chosen by hash of the id; documented bound.
TRAIN_ROWS = 12_000
STRUCTURE = [
    "words", "mean_word", "upper", "digits", "symbols", "other_marks", "distinct_words", "repeated_triples",
    "repeated_lines", "mean_line", "beyond_ascii", "closed_lines", "white", "n_chars", "n_chars_missing",
]


def kinds() -> dict[str, np.ndarray]:
    byte = np.arange(256)
    upper = (byte >= 0x41) & (byte <= 0x5A)
    lower = (byte >= 0x61) & (byte <= 0x7A)
    digits = (byte >= 0x30) & (byte <= 0x39)
    symbols = np.zeros(256, bool)
    symbols[list(b"#*$%&|<>!")] = True
    marks = (byte > 0x20) & (byte < 0x7F) & ~upper & ~lower & ~digits & ~symbols
    return {"upper": upper, "digits": digits, "symbols": symbols, "other_marks": marks, "beyond_ascii": byte >= 0x80, "white": B.WHITE}


KINDS = kinds()
NOT_NEWLINE = np.arange(256) != 0x0A


@dataclass
class Features:
    """Structure rows (texts x STRUCTURE) and distinct hashed words in runs first[i]:first[i+1]."""

    structure: np.ndarray
    first: np.ndarray
    word: np.ndarray
    value: np.ndarray


def features(buf: np.ndarray, off: np.ndarray, n_chars: np.ndarray, bits: int) -> Features:
    docs = len(off) - 1
    size = np.maximum(np.diff(off), 1)
    s = {k: B.totals_by_text(table[buf], off) / size for k, table in KINDS.items()}
    starts, ends, first = B.spans(buf, off, B.SPACED_WORD)
    n = np.diff(first)
    some = np.maximum(n, 1)
    s["words"] = np.log1p(n) / 10
    s["mean_word"] = np.log1p(B.totals_by_text(ends - starts, first) / some) / 5
    doc = np.repeat(np.arange(docs), n)
    words = B.span_hashes(B.LOWER[buf], starts, ends)
    salt = doc.astype(B.U) * B.U(B.BASE)
    order = np.argsort(B.mix(words + salt))
    keys = B.mix(words + salt)[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = keys[1:] != keys[:-1]
    s["distinct_words"] = np.bincount(doc[order[fresh]], minlength=docs) / some
    triples = B.rolling(words, 3)
    fits = np.flatnonzero(np.arange(len(triples)) + 3 <= np.repeat(first[1:], n)[: len(triples)])
    again = B.seen_twice(B.mix(triples[fits] + salt[fits]))[1]
    s["repeated_triples"] = np.bincount(doc[fits[again]], minlength=docs) / some
    lines, line_ends, first_line = B.spans(buf, off, NOT_NEWLINE)
    line_doc = np.repeat(np.arange(docs), np.diff(first_line))
    again = B.seen_twice(B.mix(B.span_hashes(buf, lines, line_ends) + line_doc.astype(B.U) * B.U(B.BASE)))[1]
    n_lines = np.maximum(np.diff(first_line), 1)
    s["repeated_lines"] = B.totals_by_text(again, first_line) / n_lines
    s["mean_line"] = np.log1p(B.totals_by_text(line_ends - lines, first_line) / n_lines) / 10
    closed = np.isin(buf[line_ends - 1], np.frombuffer(b".!?", np.uint8)) if len(lines) else np.zeros(0, bool)
    s["closed_lines"] = B.totals_by_text(closed, first_line) / n_lines
    s["n_chars"] = np.log1p(np.nan_to_num(np.maximum(n_chars, 0))) / 12
    s["n_chars_missing"] = np.isnan(n_chars).astype(float)

    # Distinct hashed words of each text, in order of (text, feature), each text of length one.
    index = (words >> B.U(64 - bits)).astype(np.int64)
    pairs = B.distinct(doc * (1 << bits) + index)
    of, word = pairs >> bits, pairs & ((1 << bits) - 1)
    runs = np.searchsorted(of, np.arange(docs + 1))
    value = (1 / np.sqrt(np.maximum(np.diff(runs), 1)))[of]
    return Features(np.column_stack([s[c] for c in STRUCTURE]).astype(np.float32), runs, word.astype(np.int32), value.astype(np.float32))


@dataclass
class Model:
    """w0 + sum(w x) + 0.5 * sum_f((sum(v_f x))**2 - sum(v_f**2 x**2)); structure first, then words."""

    bias: float
    w: np.ndarray
    v: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    bits: int

    def dense(self, structure: np.ndarray) -> np.ndarray:
        return ((structure - self.mean) / self.scale).clip(-5, 5).astype(np.float32)

    def margins(self, f: Features) -> np.ndarray:
        x = self.dense(f.structure)
        n = x.shape[1]
        linear = self.bias + x @ self.w[:n] + by_run(self.w[n + f.word] * f.value, f.first)
        pair = np.zeros(len(x))
        for k in range(self.v.shape[1]):
            parts = self.v[n + f.word, k] * f.value
            total = x @ self.v[:n, k] + by_run(parts, f.first)
            pair += total**2 - (x**2) @ (self.v[:n, k] ** 2) - by_run(parts**2, f.first)
        return linear + 0.5 * pair

    def scores(self, f: Features) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margins(f).clip(-30, 30)))


def by_run(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return sums[first[1:]] - sums[first[:-1]]


def joined(parts: list[Features]) -> Features:
    shift = np.cumsum([0, *(len(p.word) for p in parts)])
    return Features(
        np.concatenate([p.structure for p in parts]), np.concatenate([[0], *(p.first[1:] + s for p, s in zip(parts, shift, strict=False))]),
        np.concatenate([p.word for p in parts]), np.concatenate([p.value for p in parts]))


def fit(f: Features, label: np.ndarray, bits: int, rank: int = RANK, epochs: int = 12, batch: int = 128, rate: float = 0.02, l2: float = 1e-4) -> Model:
    """Adam on the log loss, classes weighed equally; the seed and the row order fix the result."""
    rng = np.random.default_rng(7)
    n = f.structure.shape[1]
    size = n + (1 << bits)
    mean = f.structure.mean(0) if len(label) else np.zeros(n, np.float32)
    scale = np.maximum(f.structure.std(0), 1e-3) if len(label) else np.ones(n, np.float32)
    model = Model(0.0, np.zeros(size, np.float32), rng.normal(0, 0.05, (size, rank)).astype(np.float32), mean, scale, bits)
    if len(label) == 0 or label.min() == label.max():
        # One class or none: the score is the smoothed share of label 1.
        model.v[:] = 0
        model.bias = float(np.log((label.sum() + 0.5) / (len(label) - label.sum() + 0.5)))
        return model
    weight = np.where(label == 1, 0.5 / label.mean(), 0.5 / (1 - label.mean()))
    x_all = model.dense(f.structure)
    params = np.column_stack([model.w, model.v])  # column 0 is linear
    m1, m2, b1, b2 = np.zeros_like(params), np.zeros_like(params), 0.0, 0.0
    step = 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(label)), max(1, len(label) // batch)):
            step += 1
            counts = f.first[rows + 1] - f.first[rows]
            at = np.repeat(f.first[rows], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            own = np.repeat(np.arange(len(rows)), counts)
            word, value, x = f.word[at] + n, f.value[at], x_all[rows]
            runs = np.concatenate([[0], np.cumsum(counts)])
            p = params[word] * value[:, None]
            sums = np.add.reduceat(np.concatenate([p, np.zeros((1, p.shape[1]), p.dtype)]), np.minimum(runs[:-1], len(p)), axis=0)
            sums[counts == 0] = 0
            squares = np.column_stack([by_run((p[:, 1:] ** 2).sum(1), runs)])[:, 0]
            total = x @ params[:n] + sums
            margin = model.bias + total[:, 0] + 0.5 * ((total[:, 1:] ** 2).sum(1) - (x**2) @ (params[:n, 1:] ** 2).sum(1) - squares)
            err = ((1 / (1 + np.exp(-margin.clip(-30, 30))) - label[rows]) * weight[rows] / len(rows)).astype(np.float32)
            grad = np.zeros_like(params)
            g = np.empty_like(p)
            g[:, 0] = err[own] * value
            g[:, 1:] = (err[own] * value)[:, None] * (total[own, 1:] - p[:, 1:])
            order = np.argsort(word, kind="stable")
            cuts = np.flatnonzero(np.concatenate([[True], word[order][1:] != word[order][:-1]])) if len(word) else np.zeros(0, int)
            if len(cuts):
                grad[word[order][cuts]] = np.add.reduceat(g[order], cuts, axis=0)
            grad[:n, 0] = err @ x
            grad[:n, 1:] = x.T @ (err[:, None] * total[:, 1:]) - (err @ (x**2))[:, None] * params[:n, 1:]
            touched = np.unique(np.concatenate([np.arange(n), word]))
            gt = grad[touched] + l2 * params[touched]
            m1[touched] = 0.9 * m1[touched] + 0.1 * gt
            m2[touched] = 0.999 * m2[touched] + 0.001 * gt**2
            fix1, fix2 = 1 - 0.9**step, 1 - 0.999**step
            params[touched] -= rate * (m1[touched] / fix1) / (np.sqrt(m2[touched] / fix2) + 1e-8)
            gb = float(err.sum())
            b1, b2 = 0.9 * b1 + 0.1 * gb, 0.999 * b2 + 0.001 * gb * gb
            model.bias -= rate * (b1 / fix1) / (np.sqrt(b2 / fix2) + 1e-8)
    model.w, model.v = params[:, 0].copy(), params[:, 1:].copy()
    return model


def n_chars_of(docs: DataFrame, chars_col: str | None) -> Column:
    has = chars_col is not None and chars_col in docs.columns
    return (F.col(chars_col).cast("double") if has else F.lit(None).cast("double")).alias("n_chars")


def doubles(column: pa.Array) -> np.ndarray:
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(float)


def train(
    labelled: DataFrame, label_col: str, text_col: str = "text", chars_col: str | None = "n_chars",
    order_col: str = "doc_id", bits: int = WORD_BITS, rows: int = TRAIN_ROWS,
) -> Model:
    """Fits the machine on at most `rows` labelled rows, those with the smallest id hash.

    Features are taken in the executors; the driver receives `rows` feature lists (all word
    features of a text, at most 2**bits) and runs the descent. Rows with a null label are
    left out. Without rows, or with one class, the model is a constant.
    """
    sample = (
        labelled.filter(F.col(label_col).isNotNull())
        .select(F.xxhash64(F.col(order_col).cast("string"), F.lit(1)).alias("h"), F.col(order_col).cast("string").alias("k"),
                F.col(text_col).alias("text"), n_chars_of(labelled, chars_col), F.col(label_col).cast("int").alias("label")))
    picked = sample.select("h").orderBy("h").limit(rows).agg(F.max("h").alias("h")).first()["h"]
    if picked is None:
        nothing = Features(np.zeros((0, len(STRUCTURE)), np.float32), np.zeros(1, int), np.zeros(0, np.int32), np.zeros(0, np.float32))
        return fit(nothing, np.zeros(0), bits)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in B.slices(batch, "text"):
                f = features(*B.text_bytes(part.column("text")), doubles(part.column("n_chars")), bits)
                yield pa.RecordBatch.from_arrays(
                    [part.column("h"), part.column("k"), part.column("label"), pa.array([r.tobytes() for r in f.structure], pa.binary()),
                     pa.array([w.tobytes() for w in np.split(f.word, f.first[1:-1])], pa.binary())],
                    ["h", "k", "label", "structure", "words"])

    got = sample.filter(F.col("h") <= picked).mapInArrow(
        scan, "h long, k string, label int, structure binary, words binary").orderBy("h", "k", "words", "label").limit(rows).collect()
    words = [np.frombuffer(r["words"], np.int32) for r in got]
    counts = np.array([len(w) for w in words])
    value = np.repeat(1 / np.sqrt(np.maximum(counts, 1)), counts)
    f = Features(np.array([np.frombuffer(r["structure"], np.float32) for r in got]), np.concatenate([[0], np.cumsum(counts)]),
                 np.concatenate(words) if words else np.zeros(0, np.int32), value.astype(np.float32))
    return fit(f, np.array([r["label"] for r in got], float), bits)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars",
          score_col: str = "score", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (the id alone by default) and a score in 0 to 1 per input row.

    The model has a fixed size of (features x (rank + 1)) floats, about 0.6 MB, and is
    broadcast. Scoring is linear in the words of a text. Null and empty texts score by
    their structure row of zeros. Repeated rows get equal scores; null ids stay null.
    """
    keep = keep or [id_col]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # A kept text column is handed over once.
    text = f"c{keep.index(text_col)}" if text_col in keep else "text_"
    inner = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)], *([F.col(text_col).alias(text)] if text == "text_" else []), n_chars_of(docs, chars_col).alias("chars_"))
    schema = ", ".join([*(f"c{i} {inner.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(keep))), "score_ double"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in B.slices(batch, text):
                f = features(*B.text_bytes(part.column(text)), doubles(part.column("chars_")), m.bits)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(f"c{i}") for i in range(len(keep))), pa.array(m.scores(f))], [*(f"c{i}" for i in range(len(keep))), "score_"])

    out = inner.mapInArrow(scan, schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], F.col("score_").alias(score_col))

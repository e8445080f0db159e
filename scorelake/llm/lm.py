"""Stupid-backoff language-model scores, computed as joins of n-gram counts."""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.llm import bytescan as B
from scorelake.llm import exchange as X
from scorelake.sources.checkpoint import materialize

BACKOFF = 0.4
#: Word lists of different n-gram lengths must not meet under one hash.
SALT = np.uint64(0x632BE59BD9B4E019)


def grams(batch: X.Batch, order: int) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """For n = 1..order the hash of every n-gram and its text, and words per text."""
    buf, off = B.LOWER[batch.buf], batch.off
    starts, ends, first = B.spans(buf, off, B.SPACED_WORD)
    words = B.span_hashes(buf, starts, ends)
    counts = np.diff(first)
    doc = np.repeat(np.arange(len(counts)), counts)
    last = np.repeat(first[1:], counts)
    hashes, docs = [], []
    for n in range(1, order + 1):
        h = B.rolling(words, n)
        fits = np.arange(len(h)) + n <= last[: len(h)]
        hashes.append(B.mix(h[fits] + SALT * np.uint64(n)))
        docs.append(doc[: len(h)][fits])
    return hashes, docs, counts


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 2, backoff: float = BACKOFF) -> DataFrame:
    """(id, n_words, log_score, mean_log_score, n_backoff) per input row.

    Counts cover all rows. A row is scored by the counts of all other rows, its own taken
    off, or every n-gram would know itself. A word scores count(n-gram) / count(context) at
    the longest n-gram seen elsewhere, times `backoff` per step down; at the end stands
    (count(word) + 1) / (all words + 2), so that an unseen word has a score. n_backoff counts the
    words that stepped down at least once. `mean_log_score` is the log score per word.

    There is a count table per n, partitioned by hash; exploded n-grams of a batch of texts meet
    it as one list per partition, and the counts come back to the batch (see `exchange`). The tables are
    made one after the other, and what one of them shuffled is gone before the next.
    A word or n-gram that is everywhere costs one entry a batch.

    Words are runs without ASCII white space, A-Z lower-cased, told apart by 64-bit hashes.
    Null and empty texts have no words, score 0 and mean null. Repeated rows count
    as rows of their own: they know each other. Null ids stay null; other columns are
    not read; an empty table gives an empty table.
    """
    stored, ids, size = X.pack(docs, id_col, text_col)
    parts = X.parts_for(size / 7)

    def lists_of(n: int):
        def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table in batches:
                for number, batch in X.unpack_rows(table):
                    hashes, _, _ = grams(batch, n)
                    # Key 0 counts all words, in the table of n = 1.
                    keys, counts = np.unique(np.append(hashes[-1], np.uint64(0)), return_counts=True)
                    counts[0] = len(hashes[0])
                    yield from X.blocks(number, keys, counts, parts)

        return lists

    tables = []
    for n in range(1, order + 1):
        sums = X.totals(stored.mapInArrow(lists_of(n), X.BLOCKS), parts).drop("first")
        tables.append(materialize(sums, f"counts-{n}").withColumn("width", F.lit(n)))
    counted = reduce(DataFrame.unionByName, tables)

    def score(texts: pa.Table, totals: pa.Table) -> pa.Table:
        kinds = {"row": pa.int64(), "n_words": pa.int64(), "log_score": pa.float64(), "n_backoff": pa.int64()}
        if texts.num_rows == 0:
            return pa.table({c: pa.array([], t) for c, t in kinds.items()})
        (_, batch), = X.unpack_rows(texts)
        hashes, owners, n_words = grams(batch, order)
        found = [totals_of(totals, n) for n in range(1, order + 1)]
        everything = int(found[0][0])
        others = []
        for h, doc, known in zip(hashes, owners, found, strict=True):
            place = np.searchsorted(B.distinct(np.append(h, np.uint64(0))), h)
            # The same n-gram of the same text: its own count.
            order_ = np.lexsort((place, doc))
            fresh = np.ones(len(order_), bool)
            fresh[1:] = (place[order_][1:] != place[order_][:-1]) | (doc[order_][1:] != doc[order_][:-1])
            run = np.cumsum(fresh) - 1
            own = np.empty(len(h), np.int64)
            own[order_] = np.bincount(run)[run] if len(run) else 0
            others.append(known[place] - own)
        words = int(n_words.sum())
        first = np.concatenate([[0], np.cumsum(n_words)])
        doc = owners[0]
        left = everything - n_words[doc]
        log = np.log((others[0] + 1) / (left + 2))
        depth = np.zeros(words, np.int64)
        start = first[:-1][doc] if words else np.zeros(0, np.int64)
        position = np.arange(words) - start
        # Word i's n-gram begins at i - n + 1: rank among the n-grams that fit.
        for n in range(2, order + 1):
            can = np.flatnonzero(position >= n - 1)
            begin = can - (n - 1)
            offset = np.concatenate([[0], np.cumsum(np.maximum(n_words - n + 1, 0))])
            at = offset[doc[begin]] + position[begin]
            context_offset = np.concatenate([[0], np.cumsum(np.maximum(n_words - n + 2, 0))])
            context = others[n - 2][context_offset[doc[begin]] + position[begin]]
            whole = others[n - 1][at]
            hit = whole > 0
            log[can] = np.where(hit, np.log(np.maximum(whole, 1) / np.maximum(context, 1)), log[can] + np.log(backoff))
            depth[can] = np.where(hit, 0, depth[can] + 1)
        return pa.table({"row": batch.rows, "n_words": n_words, "log_score": by_text(log, first), "n_backoff": B.totals_by_text(depth > 0, first)})

    scored = stored.groupBy("batch").cogroup(counted.groupBy("batch")).applyInArrow(score, "row long, n_words long, log_score double, n_backoff long")
    return ids.join(scored, "row").selectExpr(
        f"id AS `{id_col}`", "n_words", "log_score", "CASE WHEN n_words > 0 THEN log_score / n_words END AS mean_log_score", "n_backoff")


def totals_of(totals: pa.Table, n: int) -> np.ndarray:
    """A batch's counts of n-grams over the whole corpus, in the order of its ascending keys."""
    rows = [r for r in totals.select(["width", "part", "n", "totals"]).to_pylist() if r["width"] == n]
    return np.concatenate([X.unplanes(r["totals"], r["n"]) for r in sorted(rows, key=lambda r: r["part"])]).astype(np.int64)


def by_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of each text's values; added text by text, so that a text's sum is its own."""
    out = np.zeros(len(first) - 1)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        out[some] = np.add.reduceat(values, first[some])
    return out

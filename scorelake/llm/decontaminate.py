"""Benchmark decontamination with a distributed positional inverted index.

The index is cut by document: a segment holds the postings of a run of texts. A segment
row per term has the term's positions; phrases are found by intersecting offset-adjusted
position lists from the rarest term on, inside each segment.
"""
from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.llm import bytescan as B
from scorelake.sources.checkpoint import materialize

WINDOW = 10
#: Text bytes per segment; a longer text is a segment of its own.
SEGMENT_BYTES = 8 << 20
#: Unused positions between the texts of a segment: no phrase or span reaches across.
GAP = 64
#: Phrases that one pass searches for; more are searched in several passes.
PHRASES = 200_000
#: Candidate places that one vectorised step intersects.
STEP = 2_000_000
SPAN = 1 << 33


def words_in(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Term hashes of all plain words, A-Z lower-cased, and the first word of each text."""
    low = B.LOWER[buf]
    starts, ends, first = B.spans(low, off, B.PLAIN_WORD)
    return B.span_hashes(low, starts, ends), first


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Stores the postings of every word; returns (segment, term, n, positions) and
    (place, texts, about, ids), one row per segment.

    Positions are 4-byte gaps, counted over the whole segment with GAP left out after
    each text. A row number, not the id, tells rows apart.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        segment = TaskContext.get().partitionId() << 20
        names = ["segment", "term", "n", "positions", "ids"]
        for batch in batches:
            for part in B.slices(batch, "text", SEGMENT_BYTES):  # at most one Arrow batch of rows
                terms, first = words_in(*B.text_bytes(part.column("text")))
                counts = np.diff(first)
                firsts = first[:-1] + GAP * np.arange(len(counts))
                at = np.arange(len(terms)) + GAP * np.repeat(np.arange(len(counts)), counts)
                order = np.argsort(terms, kind="stable")
                ranked, at = terms[order], at[order]
                new = np.ones(len(ranked), bool)
                new[1:] = ranked[1:] != ranked[:-1]
                begin = np.flatnonzero(new)
                gaps = np.diff(at, prepend=0)
                gaps[begin] = at[begin]
                ends = np.concatenate([begin, [len(at)]]).astype(np.int32) * 4
                lists = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(gaps.astype("<i4").tobytes())])
                none = pa.nulls(len(begin), pa.list_(part.column("id").type))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(begin), segment)), pa.array(ranked[begin].view(np.int64)), pa.array((np.diff(ends) // 4).astype(np.int32)), lists, none], names)
                about = np.concatenate([firsts, counts]).astype("<i8").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([segment]), pa.array([None], pa.int64()), pa.array([part.num_rows], pa.int32()), pa.array([about], pa.binary()),
                     pa.array([part.column("id").to_pylist()], pa.list_(part.column("id").type))], names)
                segment += 1

    # Term nulls mark the segment rows.
    stored = materialize(rows.mapInArrow(scan, f"segment long, term long, n int, positions binary, ids array<{kind}>"), "postings")
    return (stored.filter("ids IS NULL").select("segment", "term", "n", "positions"),
            stored.filter("ids IS NOT NULL").selectExpr("segment AS place", "n AS texts", "positions AS about", "ids"))


def phrases_of(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(item, terms) for every window of an item: `window` consecutive words, or the whole
    item if it has fewer, but not none. `item` is the id as text, empty for null."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in B.slices(batch, "text"):
                terms, first = words_in(*B.text_bytes(part.column("text")))
                items_, lists = [], []
                for i, item in enumerate(part.column("item").to_pylist()):
                    own = terms[first[i] : first[i + 1]]
                    for s in range(max(1, len(own) - window + 1) if len(own) else 0):
                        items_.append(item)
                        lists.append(own[s : s + window].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(items_, pa.string()), pa.array(lists, pa.binary())], ["item", "terms"])

    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text"))
    return rows.mapInArrow(scan, "item string, terms binary").distinct()


class Postings:
    """The position lists of one segment, searchable by (term, position)."""

    def __init__(self, table: pa.Table) -> None:
        order = np.argsort(table.column("term").to_numpy().view(np.uint64))
        table = table.take(pa.array(order))
        self.terms = table.column("term").to_numpy().view(np.uint64)
        self.n = table.column("n").to_numpy().astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.n)])
        gaps = np.frombuffer(b"".join(table.column("positions").to_pylist()), "<i4").astype(np.int64)
        sums = np.concatenate([[0], np.cumsum(gaps)])
        owner = np.repeat(np.arange(len(self.n)), self.n)
        self.at = sums[1:] - sums[self.first[:-1]][owner]
        self.keys = owner * SPAN + self.at

    def find(self, terms: np.ndarray) -> np.ndarray:
        """Number of each term in the segment, -1 if it has none."""
        place = np.searchsorted(self.terms, terms)
        place[place == len(self.terms)] = 0
        return np.where(self.terms[place] == terms, place, -1) if len(self.terms) else np.full(terms.shape, -1)

    def has(self, term: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Does the term stand somewhere from low to high."""
        low = np.maximum(low, 0)
        place = np.searchsorted(self.keys, term * SPAN + low)
        there = place < len(self.keys)
        there[there] = self.keys[place[there]] <= (term * SPAN + high)[there]
        return there & (high >= 0)


def search(postings: Postings, terms: np.ndarray, lengths: np.ndarray, slop: int | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(phrase, place) of all matches. Exact: the place of its first word. With a slop: places
    of its rarest word that have every other word within `slop` words."""
    number = postings.find(terms)
    used = np.arange(terms.shape[1])[None, :] < lengths[:, None]
    alive = np.flatnonzero(((number >= 0) | ~used).all(1))
    if not len(alive):
        return
    number, used = number[alive], used[alive]
    freq = np.where(used, postings.n[np.maximum(number, 0)], np.iinfo(np.int64).max)
    order = np.argsort(freq, axis=1, kind="stable")
    rare = order[:, 0]
    rows = np.arange(len(alive))
    size = freq[rows, rare]
    ends = np.cumsum(size)
    i = 0
    while i < len(alive):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + STEP, "right")))
        some = rows[i:j]
        who = np.repeat(some, size[some])
        begin = postings.first[number[some, rare[some]]]
        at = postings.at[np.repeat(begin - (np.cumsum(size[some]) - size[some]), size[some]) + np.arange(len(who))]
        if slop is None:
            at = at - rare[who]
        for k in range(1, terms.shape[1]):
            column = order[who, k]
            term = number[who, column]
            needed = used[who, column]
            low, high = (at + column, at + column) if slop is None else (at - slop, at + slop)
            fine = ~needed | postings.has(np.maximum(term, 0), low, high)
            who, at = who[fine], at[fine]
        if slop is None:
            fine = at >= 0
            who, at = who[fine], at[fine]
        yield alive[who], at
        i = j


def matches(index: tuple[DataFrame, DataFrame], phrases: DataFrame, slop: int | None = None, per_pass: int = PHRASES) -> DataFrame:
    """(row, positions, items) per row and pass that has a match: the numbers (from 0) of the
    words inside exact phrase matches, and the items whose phrases match. With a `slop`,
    proximity matches: positions are those of each phrase's rarest word.

    Phrases are few next to the corpus; they go out in passes of about `per_pass`, each
    one broadcast of known size. Postings of other terms are dropped before
    they move, those of a segment then meet in one task, and a segment has a size bound.
    """
    postings, segments = index
    spark = postings.sparkSession
    phrases = materialize(phrases, "phrases")
    passes = max(1, math.ceil(phrases.count() / per_pass))
    found = None
    for number in range(passes):
        mine = phrases.filter(F.pmod(F.xxhash64("item", "terms"), F.lit(passes)) == number)
        rows = mine.toArrow()
        items = rows.column("item").to_pylist()
        lists = [np.frombuffer(x, "<u8") for x in rows.column("terms").to_pylist()]
        lengths = np.array([len(x) for x in lists], np.int64)
        terms = np.zeros((len(lists), max([1, *lengths])), np.uint64)
        for i, x in enumerate(lists):
            terms[i, : len(x)] = x
        if lengths.max(initial=1) + (slop or 0) > GAP:
            raise ValueError(f"phrases and slop reach over {GAP} words")
        shared = spark.sparkContext.broadcast((items, terms, lengths))
        vocabulary = np.unique(terms[np.arange(terms.shape[1])[None, :] < lengths[:, None]])
        known = spark.createDataFrame(pa.table({"term": vocabulary.view(np.int64)}))
        asked = postings.join(F.broadcast(known), "term", "left_semi")
        part = asked.groupBy("segment").cogroup(segments.groupBy("place")).applyInArrow(
            searcher(shared, slop), "row long, positions array<int>, items array<string>")
        found = part if found is None else found.unionByName(part)
    return found


def searcher(shared: object, slop: int | None) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(lists: pa.Table, about: pa.Table) -> pa.Table:
        rows, positions, names = [], [], []
        if lists.num_rows and about.num_rows:
            items, terms, lengths = shared.value
            n = about.column("texts")[0].as_py()
            firsts, _ = np.frombuffer(about.column("about")[0].as_py(), "<i8").reshape(2, n)
            segment = about.column("place")[0].as_py()
            got = list(search(Postings(lists), terms, lengths, slop))
            if got:
                who, at = (np.concatenate(x) for x in zip(*got, strict=True))
                doc = np.searchsorted(firsts, at, "right") - 1
                length = lengths[who] if slop is None else np.ones(len(who), np.int64)
                words = np.repeat(at - firsts[doc] - (np.cumsum(length) - length), length) + np.arange(length.sum())
                hits = np.unique(np.repeat(doc, length) * SPAN + words)
                owners = np.unique(doc * SPAN + who)
                for d in np.unique(doc):
                    mine = hits[np.searchsorted(hits, d * SPAN) : np.searchsorted(hits, (d + 1) * SPAN)] - d * SPAN
                    by = owners[np.searchsorted(owners, d * SPAN) : np.searchsorted(owners, (d + 1) * SPAN)] - d * SPAN
                    rows.append((segment << 20) + int(d))
                    positions.append(mine.astype(np.int32))
                    names.append(sorted({items[i] for i in by}))
        return pa.table({"row": pa.array(rows, pa.int64()), "positions": pa.array(positions, pa.list_(pa.int32())), "items": pa.array(names, pa.list_(pa.string()))})

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, items, contaminated) per input row.

    A word is hit if it lies in an exact occurrence of a window of a benchmark item.
    `items` lists the items with occurring windows, sorted as strings.

    Null and empty texts have no words; null and empty items no window. Rows and items that
    repeat count as they are, item ids once. Null ids stay null, a null item id reads
    as an empty string; other columns are not read; empty tables give no hits, or no rows.
    """
    index = build_index(docs, id_col, text_col)
    found = matches(index, phrases_of(benchmark, item_col, item_text_col, window))
    merged = found.groupBy("row").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("positions")))).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    rows = word_counts(index[1])
    joined = rows.join(merged, "row", "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items).cast("binary"), 256).alias("items_sha256"), items.alias("items"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))


def word_counts(segments: DataFrame) -> DataFrame:
    """(row, id, n_words) of every indexed row, from the segment rows."""
    kind = segments.schema["ids"].dataType.elementType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                n = batch.column("texts")[i].as_py()
                _, counts = np.frombuffer(batch.column("about")[i].as_py(), "<i8").reshape(2, n)
                row = (batch.column("place")[i].as_py() << 20) + np.arange(n)
                yield pa.RecordBatch.from_arrays([pa.array(row), batch.column("ids").slice(i, 1).flatten(), pa.array(counts)], ["row", "id", "n_words"])

    return segments.mapInArrow(scan, f"row long, id {kind}, n_words long")

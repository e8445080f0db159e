"""Ranked lexical search by pipelined term partitioning.

Terms belong to owners, the rarest ones to the first. A bundle carries the sparse
accumulators of a block of items over a segment of documents from owner to owner; each
owner adds the integer contributions of its postings and hands the bundle on.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorelake.llm import bytescan as B
from scorelake.operators.ordinals import number_rows
from scorelake.sources.checkpoint import materialize

#: Bytes of `[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+` once A-Z is lower-cased.
TERM = B.PLAIN_WORD
#: Text bytes and documents of a segment, at most (a longer text is a segment of its own).
SEGMENT_BYTES = 8 << 20
SEGMENT_DOCS = 8192
#: Items of a block; a block's accumulators over a segment are what one task holds.
BLOCK_ITEMS = 256
#: An owner has the terms up to that share of all documents with terms; the last one the rest.
OWNER_SHARES = (0.001, 0.01, 0.1)
#: Up to so many different terms of the items (8 bytes each), only their postings are stored;
#: beyond that the postings of all terms are.
MANY_TERMS = 2_000_000
#: Up to so many rows, the table of the items' terms is broadcast.
BROADCAST_TERMS = 200_000


def _terms(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every term of the slice's texts, and the number of each text's first term."""
    buf, off = B.text_bytes(part.column("text"))
    buf = B.LOWER[buf]
    starts, ends, first = B.spans(buf, off, TERM)
    return B.span_hashes(buf, starts, ends), first


def item_terms(items: DataFrame) -> DataFrame:
    """(item, term) of the numbered items, each term once."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in B.slices(batch, "text"):
                hashes, first = _terms(part)
                items = np.repeat(part.column("item").to_numpy(), np.diff(first))
                yield pa.RecordBatch.from_arrays([pa.array(items), pa.array(hashes.view(np.int64))], ["item", "term"])

    return items.mapInArrow(scan, "item long, term long").distinct()


def build_postings(docs: DataFrame, id_col: str, text_col: str, known: np.ndarray | None, segment_docs: int = SEGMENT_DOCS) -> DataFrame:
    """The stored index: a row per segment (term null; ids ascending, null last, and lens, the terms of each
    document), and a row per segment and term (docs, places in ids; tfs), of `known` terms or of all.

    A segment is a slice of a scan task, so the texts are read once and not shuffled.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    names = ["segment", "term", "n", "words", "top_tf", "least", "docs", "tfs", "ids"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in B.slices(batch, "text", SEGMENT_BYTES, segment_docs):
                yield _segment(at, part, known, names)
                at += 1

    # Rows of a few bytes for texts of thousands: rebalanced, so that files keep a good size.
    schema = f"segment long, term long, n long, words long, top_tf long, least long, docs binary, tfs binary, ids array<{kind}>"
    return materialize(rows.mapInArrow(scan, schema).hint("rebalance"), "postings")


def _segment(number: int, part: pa.RecordBatch, known: np.ndarray | None, names: list[str]) -> pa.RecordBatch:
    size = part.num_rows
    order = pc.sort_indices(part.column("id"), null_placement="at_end").to_numpy()
    place = np.empty(size, np.int64)
    place[order] = np.arange(size)
    hashes, first = _terms(part)
    lens = np.diff(first)
    doc = np.repeat(place, lens)
    if known is not None:
        spot = np.searchsorted(known, hashes)
        spot[spot == len(known)] = 0
        hit = known[spot] == hashes if len(known) else np.zeros(len(hashes), bool)
        term, doc, table = spot[hit], doc[hit], known
    else:
        table, term = np.unique(hashes, return_inverse=True)
    pairs, tf = np.unique(term.astype(np.int64) * size + doc, return_counts=True)
    term, doc = pairs // size, pairs % size
    cuts = np.flatnonzero(np.diff(term, prepend=-1))
    ends = np.append(cuts[1:], len(term))[: len(cuts)]
    by_place = lens[order]
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(cuts) + 1, number)), pa.array([None, *table[term[cuts]].view(np.int64).tolist()], pa.int64()),
        pa.array([int((lens > 0).sum()), *(ends - cuts).tolist()], pa.int64()), pa.array([int(lens.sum())] + [None] * len(cuts), pa.int64()),
        pa.array([None, *(np.maximum.reduceat(tf, cuts).tolist() if len(cuts) else [])], pa.int64()),
        pa.array([None, *(np.minimum.reduceat(by_place[doc], cuts).tolist() if len(cuts) else [])], pa.int64()),
        pa.array([by_place.astype("<u4").tobytes(), *(doc[a:b].astype("<u2").tobytes() for a, b in zip(cuts, ends, strict=True))], pa.binary()),
        pa.array([None, *(tf[a:b].astype("<u4").tobytes() for a, b in zip(cuts, ends, strict=True))], pa.binary()),
        pa.array([part.column("id").take(pa.array(order)).to_pylist()] + [None] * len(cuts), pa.list_(part.column("id").type))], names)


def routes(postings: DataFrame, terms: DataFrame, n_docs: int, n_terms: int, block_items: int) -> DataFrame:
    """(term, block, owner, w, uses): a term's weight, its owner, and the items of the block that ask for it, each with
    the most that the owners after this one can still add to a score."""
    m = F.expr(f"10 + (90 * least * {n_docs}) div {n_terms}")
    best = F.expr("(1000000000 * top_tf) div (1000 * top_tf + 8 * m)")
    weighed = postings.filter("term IS NOT NULL").withColumn("m", m).groupBy("term").agg(F.sum("n").alias("df"), F.max(best).alias("best"))
    owner = F.lit(0)
    for share in OWNER_SHARES:
        owner = owner + (F.col("df") > F.lit(share * n_docs)).cast("int")
    weighed = weighed.select("term", F.floor(1000 * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1))).cast("long").alias("w"), owner.alias("owner"), "best")
    later = Window.partitionBy("item").orderBy("owner").rangeBetween(1, Window.unboundedFollowing)
    asked = terms.join(weighed, "term").withColumn("rest", F.coalesce(F.sum(F.col("w") * F.col("best")).over(later), F.lit(0)))
    block = F.floor(F.col("item") / block_items).cast("long").alias("block")
    return asked.groupBy("term", block, "owner", "w").agg(F.collect_list(F.struct((F.col("item") % block_items).cast("int").alias("item"), "rest")).alias("uses"))


class Bundle:
    """Scores of a block's items over a segment's documents; zero where a document has none."""

    def __init__(self, lens: bytes, held: dict | None):
        self.n = np.frombuffer(lens, "<u4").astype(np.int64)
        self.rows: dict[int, np.ndarray] = {}
        if held and held["items"]:
            counts = np.frombuffer(held["counts"], "<i4")
            docs, scores = np.frombuffer(held["docs"], "<u2"), np.frombuffer(held["scores"], "<i8")
            ends = np.cumsum(counts)
            for item, a, b in zip(np.frombuffer(held["items"], "<i4").tolist(), ends - counts, ends, strict=True):
                self.row(item)[docs[a:b]] = scores[a:b]

    def row(self, item: int) -> np.ndarray:
        if item not in self.rows:
            self.rows[item] = np.zeros(len(self.n), np.int64)
        return self.rows[item]

    def add(self, postings: pa.Table, m: np.ndarray) -> dict[int, int]:
        """Adds an owner's contributions; returns what each touched item can still gain after it."""
        rests = {}
        for r in postings.select(["w", "docs", "tfs", "uses"]).to_pylist():
            docs, tf = np.frombuffer(r["docs"], "<u2"), np.frombuffer(r["tfs"], "<u4").astype(np.int64)
            gain = r["w"] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[docs]))
            for use in r["uses"]:
                self.row(use["item"])[docs] += gain
                rests[use["item"]] = use["rest"]
        return rests

    def prune(self, rests: dict[int, int], k: int) -> None:
        """Forgets documents that cannot come among the segment's first k any more: with all that the later
        owners can add, they stay below k others as those stand now. Equal ones stay."""
        for item, rest in rests.items():
            row = self.rows[item]
            if len(row) > k and (bar := np.partition(row, -k)[-k]) > rest:
                row[row + rest < bar] = 0

    def packed(self) -> dict[str, bytes]:
        kept = {item: np.flatnonzero(row) for item, row in sorted(self.rows.items())}
        kept = {item: docs for item, docs in kept.items() if len(docs)}
        return {
            "items": np.array(list(kept), "<i4").tobytes(), "counts": np.array([len(d) for d in kept.values()], "<i4").tobytes(),
            "docs": b"".join(d.astype("<u2").tobytes() for d in kept.values()),
            "scores": b"".join(self.rows[i][d].astype("<i8").tobytes() for i, d in kept.items())}

    def best(self, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(item, places, scores) of the k highest scores, equal ones by place."""
        for item, row in sorted(self.rows.items()):
            bar = max(1, np.partition(row, -k)[-k] if len(row) > k else 1)
            docs = np.flatnonzero(row >= bar)
            docs = docs[np.argsort(-row[docs], kind="stable")][:k]
            if len(docs):
                yield item, docs, row[docs]


def ranked_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", k: int = 10, segment_docs: int = SEGMENT_DOCS, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(item_id, rank, id, score): each item's k highest-scoring rows with a score above 0, equal scores by
    ascending id, null last.

    Terms are runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z lower-cased, told by
    64-bit hashes. A bundle starts with the segment's document lengths and no score, goes through the owners from the rarest
    terms to the most frequent by a cogroup each on (block of items, segment), and drops an accumulator only where it provably
    stays below the segment's first k, so the result is exact. A term that all documents hold has one row a segment; a segment's accumulators are bounded
    by its documents and the block's items. The first k of a segment meet those of the others at the end.

    Null and empty texts have no term: such rows are never found, such items find nothing. Every row of `items` is an item of its
    own and every row of `docs` a document, repeated ones too, with ranks of their own. A text is one value in one task, some 40 times its bytes while it is scanned. Other columns are not read; an empty table on
    either side gives an empty result.
    """
    asked = items.select(F.col(item_col).alias("label"), F.col(item_text_col).alias("text"))
    numbered = number_rows(asked, [F.col("label"), F.col("text")], "item")
    terms = materialize(item_terms(numbered.select("item", "text")), "item_terms")
    few = terms.select("term").distinct()
    known = np.sort(np.array([r["term"] for r in few.collect()], np.int64).view(np.uint64)) if few.count() <= MANY_TERMS else None
    stored = build_postings(docs, id_col, text_col, known, segment_docs)
    n_docs, n_terms = stored.filter("term IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    plan = materialize(routes(stored, terms, n_docs, max(n_terms, 1), block_items), "routes")
    found = run_pipeline(stored, plan, (numbered.agg(F.max("item")).first()[0] or 0) // block_items + 1, block_items, n_docs, n_terms, k)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last()))
    ranked = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    return ranked.join(numbered.select("item", "label"), "item").select(F.col("label").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def run_pipeline(stored: DataFrame, plan: DataFrame, blocks: int, block_items: int, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, id, score) of the first k of every segment, after all owners."""
    few = plan.count() <= BROADCAST_TERMS
    lists = stored.filter("term IS NOT NULL").select(F.col("segment").alias("part"), "term", "docs", "tfs")
    kind = stored.schema["ids"].dataType.elementType.simpleString()
    empty = [F.lit(b"").alias(c) for c in ("items", "counts", "docs", "scores")]
    # The query set against all rows, in blocks: every segment starts a bundle for every block of items.
    bundles = stored.filter("term IS NULL").select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), "segment", "ids", F.col("docs").alias("lens"), *empty)
    state = f"block long, segment long, ids array<{kind}>, lens binary, items binary, counts binary, docs binary, scores binary"

    def lengths(bundle: Bundle) -> np.ndarray:
        return 10 + (90 * bundle.n * n_docs) // max(n_terms, 1)

    def visit(left: pa.Table, right: pa.Table) -> tuple[dict, Bundle, dict[int, int]]:
        held, = left.select(["block", "segment", "lens", "items", "counts", "docs", "scores"]).to_pylist()
        bundle = Bundle(held["lens"], held)
        return held, bundle, bundle.add(right, lengths(bundle))

    def hand_on(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            return left
        held, bundle, rests = visit(left, right)
        bundle.prune(rests, k)
        packed = bundle.packed()
        return pa.table({"block": left["block"], "segment": left["segment"], "ids": left["ids"], "lens": left["lens"], **{c: pa.array([packed[c]], pa.binary()) for c in ("items", "counts", "docs", "scores")}})

    def select(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = left.schema.field("ids").type.value_type
        if left.num_rows == 0:
            return pa.table({"item": pa.array([], pa.int64()), "id": pa.array([], ids), "score": pa.array([], pa.int64())})
        held, bundle, _ = visit(left, right)
        best = list(bundle.best(k))
        places = np.concatenate([d for _, d, _ in best]) if best else np.zeros(0, np.int64)
        return pa.table({
            "item": pa.array(np.repeat([held["block"] * block_items + i for i, _, _ in best], [len(d) for _, d, _ in best]).astype(np.int64)),
            "id": left["ids"].combine_chunks().flatten().take(pa.array(places)),
            "score": pa.array(np.concatenate([s for _, _, s in best]) if best else places)})

    for owner in range(len(OWNER_SHARES) + 1):
        mine = plan.filter(F.col("owner") == owner).select("term", "block", "w", "uses")
        owned = lists.join(F.broadcast(mine) if few else mine, "term").select("block", "part", "w", "docs", "tfs", "uses")
        meet = bundles.groupBy("block", "segment").cogroup(owned.groupBy("block", "part"))
        last = owner == len(OWNER_SHARES)
        bundles = meet.applyInArrow(select if last else hand_on, f"item long, id {kind}, score long" if last else state)
    return bundles

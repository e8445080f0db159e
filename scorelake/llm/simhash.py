"""SimHash near-duplicates by pivot distance tables, and connected components of links."""
from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.llm import bytescan as B
from scorelake.llm.components import connected_components
from scorelake.sources.checkpoint import materialize

SEED = 42
#: Number of reference fingerprints in the distance table.
PIVOTS = 16
#: Equal pieces that a candidate pair must share; a bucket then has at most 2**(64 * max_bits / pieces) members.
SHARED = 4
#: Buckets of more members are looked up by flipped bits where that is fewer steps.
LARGE = 256


def fingerprint(text: bytes, shingle: int) -> int:
    """Majority bits over the XXH64 of every word shingle; 0 for a text without words."""
    words = text.lower().split()  # on bytes: lowers A-Z, splits at \x20 and \x09-\x0D
    if not words:
        return 0
    body = b" ".join(words)
    if len(words) < shingle:
        hashes = np.array([xxhash.xxh64_intdigest(body, SEED)], np.uint64)
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = ends - sizes
        digest = xxhash.xxh64_intdigest
        hashes = np.array(
            [digest(body[a:b], SEED) for a, b in zip(starts.tolist(), ends[shingle - 1 :].tolist(), strict=False)], np.uint64)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp) per row; fp holds the 64 bits as a signed long."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in B.slices(batch, "text"):
                buf, off = B.text_bytes(part.column("text"))
                raw = buf.tobytes()
                fps = [fingerprint(raw[a:b], shingle) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(np.array(fps, np.uint64).view(np.int64))], ["id", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(scan, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: rows of the 64 x 64 Sylvester-Hadamard matrix, any two 32 bits apart."""
    bits = np.arange(64)
    rows = np.array([[bin(i & j).count("1") & 1 for j in bits] for i in 2 * np.arange(1, n + 1) - 1], np.uint64)
    return (rows << bits.astype(np.uint64)).sum(1, dtype=np.uint64)


def pieces(max_bits: int) -> list[int]:
    """64 bits cut into max_bits + SHARED masks: two fingerprints that close agree on SHARED of them."""
    cuts = np.linspace(0, 64, max_bits + SHARED + 1).round().astype(int)
    return [(1 << int(b)) - (1 << int(a)) for a, b in itertools.pairwise(cuts)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, max_bits: int = 2, n_pivots: int = PIVOTS) -> DataFrame:
    """(a, b) for all pairs of different fingerprints at most max_bits apart, a < b.

    Two such fingerprints agree on at least SHARED of max_bits + SHARED pieces, so they
    meet in the bucket of some choice of SHARED pieces. Inside a bucket rows are compared
    at growing lags of a sorted run: the table of distances to the pivots drops a pair
    whose coordinates differ by more than max_bits anywhere (triangle inequality), and
    the true distance verifies the rest. In a large bucket each member is looked up under every flip of its few
    open bits instead, so no bucket costs the square of its size. Fingerprints are distinct, so a bucket has a
    size bound whatever the number of documents, and a fingerprint at most
    sum(C(64, i), i <= max_bits) links.
    """
    masks = pieces(max_bits)
    refs = pivots(n_pivots)

    def key(i: int, choice: tuple[int, ...]) -> Column:
        mask = sum(masks[p] for p in choice)
        return F.struct(F.lit(i).cast("short").alias("choice"), F.col("fp").bitwiseAND(F.lit(signed(mask))).alias("bits"))

    choices = [key(i, c) for i, c in enumerate(itertools.combinations(range(len(masks)), SHARED))]
    keyed = fps.select("fp", F.explode(F.array(*choices)).alias("k")).select("k.choice", "k.bits", "fp")
    buckets = keyed.repartition("choice", "bits").sortWithinPartitions("choice", "bits", "fp")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches_of(batches):
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            # The last bucket may go on in the next batch: what is before it is ready.
            last = (now[0] == now[0][-1]) & (now[1] == now[1][-1])
            cut = len(last) - int(last[::-1].argmin()) if not last.all() else 0
            goes_on = bool(held) and held[0][0][0] == now[0][0] and held[0][1][0] == now[1][0]
            if cut == 0 and (goes_on or not held):
                held.append(now)
                continue
            yield from close_pairs(*joined([*held, [x[:cut] for x in now]]), refs, masks, max_bits)
            held = [[x[cut:] for x in now]]
        if held:
            yield from close_pairs(*joined(held), refs, masks, max_bits)

    found = buckets.mapInArrow(compare, "a long, b long")
    return found.distinct()


def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b for b in batches if b.num_rows)


def joined(runs: list[list[np.ndarray]]) -> list[np.ndarray]:
    return [np.concatenate(x) for x in zip(*runs, strict=True)]


def flips(open_bits: int, max_bits: int, most: int) -> np.ndarray | None:
    """Every mask of 1 to max_bits of these bits; None if there are more than `most`."""
    places = [np.uint64(1) << np.uint64(b) for b in range(64) if open_bits >> b & 1]
    if sum(math.comb(len(places), k) for k in range(1, max_bits + 1)) > most:
        return None
    return np.array([np.bitwise_or.reduce(c) for k in range(1, max_bits + 1) for c in itertools.combinations(places, k)], np.uint64)


def close_pairs(choice: np.ndarray, bits: np.ndarray, fp: np.ndarray, refs: np.ndarray, masks: list[int], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Verified pairs of one bucket, for all buckets of a run sorted by (choice, bits, fp).

    A bucket of more members than there are ways to flip max_bits of its open bits is looked up flip by
    flip, in time that grows with its size; in the others, members are compared at growing lags.
    """
    if len(fp) < 2:
        return
    raw = fp.view(np.uint64)
    cuts = np.flatnonzero(np.r_[True, (choice[1:] != choice[:-1]) | (bits[1:] != bits[:-1])])
    sizes = np.diff(np.r_[cuts, len(fp)])
    small = np.ones(len(fp), bool)
    chosen = list(itertools.combinations(range(len(masks)), SHARED))
    for at, size in zip(cuts[sizes > LARGE].tolist(), sizes[sizes > LARGE].tolist(), strict=True):
        fixed = sum(masks[p] for p in chosen[int(choice[at])])
        ways = flips(((1 << 64) - 1) ^ fixed, max_bits, size)
        if ways is None:
            continue
        small[at : at + size] = False
        mine = np.sort(raw[at : at + size])
        for way in ways:
            other = mine ^ way
            spot = np.searchsorted(mine, other)
            hit = (spot < size) & (mine[np.minimum(spot, size - 1)] == other) & (mine.view(np.int64) < other.view(np.int64))
            if hit.any():
                yield pa.RecordBatch.from_arrays([pa.array(mine[hit].view(np.int64)), pa.array(other[hit].view(np.int64))], ["a", "b"])
    choice, bits, fp, raw = choice[small], bits[small], fp[small], raw[small]
    table = np.bitwise_count(raw[:, None] ^ refs[None, :]).astype(np.int8)
    left = np.arange(len(fp))
    lag = 1
    while True:
        left = left[left + lag < len(fp)]
        left = left[(choice[left] == choice[left + lag]) & (bits[left] == bits[left + lag])]
        if not len(left):
            return
        near = left[(np.abs(table[left] - table[left + lag]) <= max_bits).all(1)]
        near = near[np.bitwise_count(raw[near] ^ raw[near + lag]) <= max_bits]
        if len(near):
            yield pa.RecordBatch.from_arrays([pa.array(fp[near]), pa.array(fp[near + lag])], ["a", "b"])
        lag += 1


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2, n_pivots: int = PIVOTS,
) -> DataFrame:
    """(id, fp, fingerprint, component_id) per input row.

    `fingerprint` is the SimHash of the lower-cased word shingles as 16 hex digits;
    `component_id` the smallest id reachable over links of at most `max_bits` bits. Equal
    fingerprints collapse before any pair is formed, so a group of copies is one node
    however large it is.

    Null and empty texts have fingerprint zero and link like any other. Repeated rows give
    repeated results. A null id gets its group's smallest id, null if none has one. Other
    columns are not read; an empty table gives an empty table.
    """
    # Rows shrink from a text to 16 bytes: rebalanced, so that files do not shrink with them.
    fps = materialize(fingerprints(docs, id_col, text_col, shingle).hint("rebalance", "fp"), "simhash")
    nodes = fps.groupBy("fp").agg(F.min("id").alias("label"))
    parts = connected_components(links(fps.select("fp").distinct(), max_bits, n_pivots), "a", "b")
    named = nodes.join(parts, nodes["fp"] == parts["node"], "left").select("fp", "label", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("label").alias("component_id"))
    of_fp = named.join(least, "component").select("fp", "component_id")
    return fps.join(of_fp, "fp").select(
        F.col("id").alias(id_col), "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

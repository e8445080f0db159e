"""Corpus-wide counts of hashed keys, dealt by hash and sent back to where they were asked.

Documents are packed into batches, one row each. A batch lists its distinct keys with
their counts once per hash partition; a partition adds up all lists it gets; each
batch's totals go back in the order of its list. A key that a third of all rows hold
costs one entry per batch, so no key is hot, and nothing is dropped.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.llm import bytescan as B
from scorelake.sources.checkpoint import materialize

#: Text bytes per batch; a longer text is a batch of its own.
BATCH_BYTES = 4 << 20
#: Key entries that one partition adds up, about.
PART_ENTRIES = 1_500_000
BLOCKS = "batch long, part int, n int, keys binary, counts binary"
TOTALS = "batch long, part int, n int, totals binary, first binary"
NOTHING = np.zeros(0, np.uint64)


class Batch(NamedTuple):
    """The texts of one batch: row numbers of the packing, bytes and offsets."""

    rows: np.ndarray
    buf: np.ndarray
    off: np.ndarray


def pack(docs: DataFrame, id_col: str, text_col: str, batch_bytes: int = BATCH_BYTES) -> tuple[DataFrame, DataFrame, int]:
    """Stores (batch, rows, offsets, body) and (row, id); returns both and the text bytes.

    `row` numbers the input rows, so equal or null ids stay apart.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 33
        codec = pa.Codec("zstd", 1)
        for batch in batches:
            for part in B.slices(batch, "text", batch_bytes):
                buf, off = B.text_bytes(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at]), pa.array([part.num_rows]), pa.array([off.astype("<i8").tobytes()], pa.binary()),
                     pa.array([codec.compress(buf.tobytes(), asbytes=True)], pa.binary()), pa.array([len(buf)]), pa.array([part.column("id").to_pylist()], pa.list_(part.column("id").type))],
                    ["batch", "n", "offsets", "body", "bytes", "ids"])
                at += part.num_rows

    # One row per batch: a text moves as one compressed value, not as a row.
    stored = materialize(rows.mapInArrow(scan, f"batch long, n long, offsets binary, body binary, bytes long, ids array<{kind}>"), "batches")
    ids = stored.select("batch", F.posexplode("ids").alias("place", "id")).select((F.col("batch") + F.col("place")).alias("row"), "id")
    size = stored.agg(F.sum("bytes")).first()[0] or 0
    return stored.select("batch", "n", "offsets", "body", "bytes"), ids, size


def unpack(batch: int, n: int, offsets: bytes, body: bytes, size: int) -> Batch:
    raw = pa.Codec("zstd").decompress(body, size, asbytes=True) if size else b""
    return Batch(batch + np.arange(n), np.frombuffer(raw, np.uint8), np.frombuffer(offsets, "<i8").astype(np.int64))


def unpack_rows(table: pa.RecordBatch | pa.Table) -> Iterator[tuple[int, Batch]]:
    for r in table.to_pylist():
        yield r["batch"], unpack(r["batch"], r["n"], r["offsets"], r["body"], r["bytes"])


def parts_for(entries: float) -> int:
    return max(1, math.ceil(entries / PART_ENTRIES))


def planes(values: np.ndarray) -> bytes:
    """Numbers of 8 bytes, byte by byte, without the high bytes that none of them uses."""
    rows = values.astype("<u8").view(np.uint8).reshape(-1, 8).T
    used = np.flatnonzero(rows.any(1))
    return rows[: used[-1] + 1 if len(used) else 0].tobytes()


def unplanes(data: bytes, n: int) -> np.ndarray:
    rows = np.zeros((8, n), np.uint8)
    rows[: len(data) // n] = np.frombuffer(data, np.uint8).reshape(-1, n)
    return np.ascontiguousarray(rows.T).view("<u8").ravel()


def blocks(batch: int, keys: np.ndarray, counts: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """Lists for every hash partition; keys are distinct and ascending."""
    cuts = cut(keys, parts)
    for p in range(parts):
        a, b = cuts[p], cuts[p + 1]
        if b > a:
            gaps = np.diff(keys[a:b], prepend=np.uint64(0))
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch]), pa.array([p], pa.int32()), pa.array([b - a], pa.int32()), pa.array([planes(gaps)], pa.binary()),
                 pa.array([planes(counts[a:b])], pa.binary())], ["batch", "part", "n", "keys", "counts"])


def cut(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each hash partition's range begins in ascending keys."""
    bounds = np.array([min(p * (1 << 64) // parts, (1 << 64) - 1) for p in range(1, parts)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]])


def totals(lists: DataFrame, parts: int) -> DataFrame:
    """(batch, part, n, totals, first): for each list, every key's count over all batches
    in 64 bits, and whether this batch is the first one with the key."""

    def add(table: pa.Table) -> pa.Table:
        n = table.column("n").to_numpy()
        keys = np.concatenate([np.cumsum(unplanes(k, m), dtype=np.uint64) for k, m in zip(table.column("keys").to_pylist(), n, strict=True)])
        counts = np.concatenate([unplanes(c, m) for c, m in zip(table.column("counts").to_pylist(), n, strict=True)])
        batch = table.column("batch").to_numpy()
        ends = np.cumsum(n)
        # Batches in order of their number, whatever order the lists came in.
        rank = np.repeat(np.argsort(np.argsort(batch)), n)
        order = np.lexsort((rank, keys))
        fresh = np.ones(len(keys), bool)
        fresh[1:] = keys[order][1:] != keys[order][:-1]
        group = np.cumsum(fresh) - 1
        sums = np.add.reduceat(counts[order], np.flatnonzero(fresh), dtype=np.int64)
        total, first = np.empty(len(keys), np.int64), np.empty(len(keys), bool)
        total[order] = sums[group]
        first[order] = fresh
        return pa.table({
            "batch": table.column("batch"), "part": table.column("part"), "n": table.column("n"),
            "totals": pa.array([planes(total[e - m : e]) for e, m in zip(ends, n, strict=True)], pa.binary()),
            "first": pa.array([np.packbits(first[e - m : e]).tobytes() for e, m in zip(ends, n, strict=True)], pa.binary())})

    return lists.repartition(parts, "part").groupBy("part").applyInArrow(add, TOTALS)


def read_totals(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A batch's totals and first marks, in the order of its ascending keys."""
    rows = sorted(table.select(["part", "n", "totals", "first"]).to_pylist(), key=lambda r: r["part"])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    return (np.concatenate([unplanes(r["totals"], r["n"]) for r in rows]).astype(np.int64),
            np.concatenate([np.unpackbits(np.frombuffer(r["first"], np.uint8), count=r["n"]).astype(bool) for r in rows]))

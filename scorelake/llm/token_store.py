"""Token ids as raw binary shards, with a minimal perfect hash index from keys to places.

Shard file: ids as little-endian unsigned 16- or 32-bit integers, document after
document, then the documents' first ids (n + 1 unsigned 64-bit numbers, counted in
ids), then their keys (n signed 64-bit numbers), then a footer of 8 unsigned 64-bit
numbers: magic, bytes per id, ids, documents, documents with a null key, 3 spare.

Index file: one per part of the key space, a minimal perfect hash (levels of bit
arrays, after Limasset et al. 2017) and one fixed-width record per key.
"""
from __future__ import annotations

import json
import math
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from scorelake.llm import bytescan as B
from scorelake.sources.checkpoint import checkpoint_root, materialize

MAGIC = 0x53485244
FOOTER = 64
END = 2
#: Text bytes per shard, on average.
SHARD_BYTES = 32 << 20
#: Keys per part of the index, on average.
PART_KEYS = 500_000
#: Pieces of text whose ids a Python worker remembers, about 40 bytes each.
KNOWN_UNITS = 2_000_000
#: How a tokenizer file must normalise and part text for `units_of` to part it alike.
UNIT_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
UNIT_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
RECORD = np.dtype([("print", "<u4"), ("shard", "<u4"), ("last", "<u4"), ("place", "<u4")])


def filesystem(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The shared folder's file system; a plain path is a local or mounted one."""
    return pa.fs.FileSystem.from_uri(path) if ":" in path else (pa.fs.LocalFileSystem(), path)


# ---- encoding ----------------------------------------------------------------------

LETTER, DIGIT, MARK, OTHER = 1, 2, 3, 4
KIND = np.full(256, OTHER, np.uint8)
KIND[B.WHITE] = 0
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
KIND[0x30:0x3A] = DIGIT
KIND[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) not in "'<"]] = MARK


def units_of(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of text that the tokenizer never joins: the bytes with simple words
    lower-cased, starts, ends, and the number of each text's first piece.

    It parts at white space, and lower-cases. A word of plain ASCII it also parts where letters,
    digits and marks meet; quotes, `<` (special tokens) and all that is beyond ASCII
    leave a word whole.
    """
    starts, ends, _ = B.spans(buf, off, B.SPACED_WORD)
    kind = KIND[buf]
    others = np.concatenate([[0], np.cumsum(kind == OTHER)])
    whole = others[ends] > others[starts]
    marks = np.zeros(len(buf) + 1, np.int8)
    marks[starts[whole]] += 1
    marks[ends[whole]] -= 1
    low = np.where(np.cumsum(marks[:-1], dtype=np.int8) > 0, buf, B.LOWER[buf])
    turn = np.flatnonzero((kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)) + 1
    if len(turn) and len(starts):
        turn = turn[~whole[np.searchsorted(starts, turn, "right") - 1]]
    new = np.zeros(len(buf), bool)
    new[starts] = True
    new[turn] = True
    begin = np.flatnonzero(new)
    stop = ends[np.searchsorted(starts, begin, "right") - 1]
    stop[:-1] = np.minimum(stop[:-1], begin[1:])
    return low, begin, stop, np.searchsorted(begin, off)


def parts_alike(config: dict) -> bool:
    """Whether the tokenizer of this file parts text where `units_of` does, so that pieces can be encoded one by one."""
    first, *rest = (config.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    split = {"type": "Split", "pattern": {"Regex": UNIT_SPLIT}, "behavior": "Removed", "invert": True}
    bytes_only = all(p.get("type") == "ByteLevel" and not p.get("use_regex") and not p.get("add_prefix_space") for p in rest)
    return config.get("normalizer") == UNIT_NORMALIZER and first == split and bytes_only


class Encoder:
    """Ids of whole texts. Each distinct piece (see `units_of`) goes through the library
    once and is then remembered under its 64-bit hash, up to KNOWN_UNITS of them. Texts of a tokenizer that
    parts otherwise go through the library whole."""

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as config:
            self.by_piece = parts_alike(json.load(config))
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.clear()

    def clear(self) -> None:
        self.keys, self.begin, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.pool, self.used = np.zeros(1 << 20, np.uint32 if self.width == 4 else np.uint16), 0

    def learn(self, keys: np.ndarray, units: list[str]) -> None:
        """Keys are ascending and new."""
        flat: list[int] = []
        sizes = []
        for i in range(0, len(units), 1 << 14):
            for e in self.tokenizer.encode_batch_fast(units[i : i + (1 << 14)], add_special_tokens=False):
                ids = e.ids
                flat += ids
                sizes.append(len(ids))
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + len(flat)] = flat
        size = np.array(sizes, np.int32)
        at = np.searchsorted(self.keys, keys)
        self.begin = np.insert(self.begin, at, self.used + np.cumsum(size, dtype=np.int64) - size)
        self.size = np.insert(self.size, at, size)
        self.keys = np.insert(self.keys, at, keys)
        self.used += len(flat)

    def __call__(self, column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by `end`, and the number of ids of each text."""
        if not self.by_piece:
            texts = [t or "" for t in column.to_pylist()]
            lists = [np.array([*e.ids, end], self.pool.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            return np.concatenate([self.pool[:0], *lists]), np.array([len(x) for x in lists], np.int64)
        buf, off = B.text_bytes(column)
        low, begin, stop, first = units_of(buf, off)
        hashes = B.span_hashes(low, begin, stop)
        keys, sample, code = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > KNOWN_UNITS:
            self.clear()
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != keys[inside]
        raw = low.tobytes()
        self.learn(keys[new], [raw[a:b].decode() for a, b in zip(begin[sample[new]].tolist(), stop[sample[new]].tolist(), strict=True)])
        at = np.searchsorted(self.keys, keys)[code]
        # The end id is one more piece, of length one, after each text's pieces.
        counts = np.diff(first) + 1
        ends = np.cumsum(counts) - 1
        sizes = np.ones(len(at) + len(off) - 1, np.int64)
        begins = np.zeros(len(sizes), np.int64)
        inner = np.ones(len(sizes), bool)
        inner[ends] = False
        sizes[inner], begins[inner] = self.size[at], self.begin[at]
        stops = np.cumsum(sizes)
        ids = self.pool[np.repeat(begins - (stops - sizes), sizes) + np.arange(stops[-1] if len(stops) else 0)]
        ids[stops[ends] - 1] = end
        return ids, np.diff(np.concatenate([[0], stops[ends]]))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def write_shards(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", root: str | None = None,
                 end: int = END, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, str]:
    """Writes one file per shard in ascending id order; returns the manifest and the folder.

    Rows are range-partitioned by (id, text hash, row number), so that even one id with a
    third of all rows spreads over many shards. A task names its file after itself, and
    the manifest, written by Spark's committer, lists one file per shard: what a
    lost or doubled task leaves behind is never read. Ids are whole numbers or null; others are an error before any work.
    """
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType
    if not isinstance(kind, IntegralType):
        raise ValueError(f"documents are keyed by whole numbers; {id_col} is {kind.simpleString()}")
    folder = f"{root or checkpoint_root(spark)}/tokens-{uuid.uuid4().hex}"
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + 32)).first()[0] or 0
    n = max(1, math.ceil(total / shard_bytes))
    dealt = rows.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    sorted_ = dealt.repartitionByRange(n, F.col("id").asc_nulls_first(), "tie", "row").sortWithinPartitions(F.col("id").asc_nulls_first(), "tie", "row")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(tokenizer)
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        shard = TaskContext.get().partitionId()
        name = f"{shard:08d}-{uuid.uuid4().hex}.ids"
        counts, keys, nulls = [], [], 0
        with fs.open_output_stream(f"{base}/{name}") as out:
            for batch in batches:
                for part in B.slices(batch, "text"):
                    ids, sizes = encode(part.column("text"), end)
                    out.write(ids.astype("<u2" if encode.width == 2 else "<u4").tobytes())
                    counts.append(sizes)
                    nulls += part.column("id").null_count
                    keys.append(part.column("id").fill_null(-(1 << 63)).to_numpy())
            sizes = np.concatenate([np.zeros(1, np.int64), *counts])
            key = np.concatenate([np.zeros(0, np.int64), *keys])
            out.write(np.cumsum(sizes).astype("<u8").tobytes())
            out.write(key.astype("<i8").tobytes())
            out.write(np.array([MAGIC, encode.width, sizes.sum(), len(key), nulls, 0, 0, 0], "<u8").tobytes())
        if len(key):
            yield pa.RecordBatch.from_pylist(
                [{"shard": shard, "file": name, "ids": int(sizes.sum()), "docs": len(key), "nulls": nulls}],
                pa.schema([("shard", pa.int32()), ("file", pa.string()), ("ids", pa.int64()), ("docs", pa.int64()), ("nulls", pa.int64())]))

    found = sorted_.select("id", "text").mapInArrow(write, "shard int, file string, ids long, docs long, nulls long")
    # One row per shard: running sums over all of them are a short list.
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    stored = materialize(found, "token-manifest")
    return stored.withColumn("first_id", F.coalesce(F.sum("ids").over(order), F.lit(0))), folder


def read_footer(fs: pa.fs.FileSystem, path: str, source: pa.NativeFile) -> tuple[np.ndarray, np.ndarray, int, int]:
    """A shard's document starts, keys, bytes per id and number of null keys."""
    size = source.size()
    head = np.frombuffer(source.read_at(FOOTER, size - FOOTER), "<u8")
    if head[0] != MAGIC:
        raise ValueError(f"{path} is no shard")
    width, ids, docs, nulls = (int(x) for x in head[1:5])
    starts = np.frombuffer(source.read_at(8 * (docs + 1), ids * width), "<u8").astype(np.int64)
    keys = np.frombuffer(source.read_at(8 * docs, ids * width + 8 * (docs + 1)), "<i8")
    return starts, keys, width, nulls


# ---- minimal perfect hash ----------------------------------------------------------

def key_hash(keys: np.ndarray) -> np.ndarray:
    return B.mix(keys.astype("<i8").view(np.uint64) ^ np.uint64(0xA0761D6478BD642F))


class PerfectHash:
    """Maps n distinct 64-bit hashes onto 0..n-1. Level by level, a hash whose slot no
    other one of the level wants sets that slot's bit; the others go on. The number of
    bits set before a slot is the hash's place."""

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.levels = levels
        self.ranks, before = [], 0
        for bits in levels:
            upto = np.cumsum(np.bitwise_count(bits).astype(np.int64))
            self.ranks.append(before + np.concatenate([[0], upto]))
            before += int(upto[-1]) if len(upto) else 0
        self.n = before

    @staticmethod
    def slots(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
        return (B.mix(hashes + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, hashes: np.ndarray, gamma: float = 2.0) -> PerfectHash:
        levels, left = [], hashes
        while len(left):
            if len(levels) > 200:
                raise ValueError("hashes are not distinct")
            size = max(64, -(-int(gamma * len(left)) // 64) * 64)
            slot = cls.slots(left, len(levels), size)
            alone = np.bincount(slot, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[slot]]
        return cls(levels)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash; of one that is not in the set, any place or -1."""
        out = np.full(len(hashes), -1, np.int64)
        left = np.arange(len(hashes))
        for level, bits in enumerate(self.levels):
            slot = self.slots(hashes[left], level, 64 * len(bits))
            word, bit = slot >> 6, (slot & 63).astype(np.uint64)
            hit = (bits[word] >> bit) & np.uint64(1) == 1
            at = slot[hit] >> 6
            below = bits[at] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[left[hit]] = self.ranks[level][at] + np.bitwise_count(below)
            left = left[~hit]
        return out

    def dump(self) -> bytes:
        sizes = np.array([len(self.levels), *(len(x) for x in self.levels)], "<u8")
        return sizes.tobytes() + b"".join(x.tobytes() for x in self.levels)

    @classmethod
    def load(cls, data: bytes) -> tuple[PerfectHash, int]:
        n = int(np.frombuffer(data, "<u8", 1)[0])
        sizes = np.frombuffer(data, "<u8", n, 8).astype(int)
        levels, at = [], 8 * (n + 1)
        for size in sizes:
            levels.append(np.frombuffer(data, "<u8", size, at))
            at += 8 * size
        return cls(levels), at


def fingerprints_of(hashes: np.ndarray) -> np.ndarray:
    return (B.mix(hashes ^ np.uint64(0xE7037ED1A0B428DB)) >> np.uint64(32)).astype(np.uint32)


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)


def read_shards(spark: SparkSession, manifest: DataFrame, folder: str, what: Callable[[int, str], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Runs `what` over each (shard, file) in a task of its own."""
    n = max(1, min(manifest.count(), 100_000))
    files = manifest.select("shard", "file").repartitionByRange(n, "shard")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, file in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield from what(shard, file)

    return files.mapInArrow(scan, schema)


def build_index(spark: SparkSession, manifest: DataFrame, folder: str, part_keys: int = PART_KEYS) -> int:
    """Writes the index files and their table beside the shards; returns the number of parts.

    A record holds a key's fingerprint, its first shard, the last shard that has the key,
    and the document's place in the first. Null keys have no record.
    """
    total = manifest.agg(F.sum("docs")).first()[0] or 0
    parts = max(1, math.ceil(total / part_keys))

    def keys_in(shard: int, file: str) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        with fs.open_input_file(f"{base}/{file}") as source:
            _, keys, _, nulls = read_footer(fs, file, source)
        fresh, first = np.unique(keys[nulls:], return_index=True)  # keys ascend within a shard
        yield pa.RecordBatch.from_arrays(
            [pa.array(part_of(key_hash(fresh), parts)), pa.array(fresh), pa.array(np.full(len(fresh), shard, np.int32)), pa.array((first + nulls).astype(np.int32))],
            ["part", "key", "shard", "place"])

    places = read_shards(spark, manifest, folder, keys_in, "part int, key long, shard int, place int")
    # A key that fills many shards has one row in each; they meet as one.
    records = places.groupBy("part", "key").agg(F.min(F.struct("shard", "place")).alias("first"), F.max("shard").alias("last"))

    def write(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        first = table.column("first").combine_chunks()
        hashes = key_hash(table.column("key").to_numpy())
        order = PerfectHash.build(hashes)
        at = order(hashes)
        rows = np.zeros(len(hashes), RECORD)
        rows["print"][at] = fingerprints_of(hashes)
        rows["shard"][at] = first.field("shard").to_numpy()
        rows["place"][at] = first.field("place").to_numpy()
        rows["last"][at] = table.column("last").to_numpy()
        name = f"index-{part:06d}-{uuid.uuid4().hex}"
        fs, base = filesystem(folder)
        with fs.open_output_stream(f"{base}/{name}") as out:
            out.write(order.dump())
            out.write(rows.tobytes())
        return pa.table({"part": pa.array([part], pa.int32()), "file": [name]})

    files = records.groupBy("part").applyInArrow(write, "part int, file string")
    files.write.mode("overwrite").parquet(f"{folder}/parts")
    return parts


class Index:
    """One part of the index, read whole: constant-time places of keys."""

    def __init__(self, folder: str, file: str) -> None:
        fs, base = filesystem(folder)
        with fs.open_input_file(f"{base}/{file}") as source:
            data = source.read()
        self.order, at = PerfectHash.load(data)
        self.rows = np.frombuffer(data, RECORD, self.order.n, at)

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys have a record whose fingerprint agrees, and those records."""
        hashes = key_hash(keys)
        at = self.order(hashes)
        known = at >= 0
        known[known] = self.rows["print"][at[known]] == fingerprints_of(hashes[known])
        return known, self.rows[at[known]]


def lookup(keys: DataFrame, folder: str, parts: int, key_col: str = "key") -> DataFrame:
    """(key, shard, last, place) of each distinct key that the index knows.

    A fingerprint lets a foreign key pass once in 2**32; whoever reads the shard then
    sees the stored key differ.
    """
    spark = keys.sparkSession
    files = spark.read.schema("part int, file string").parquet(f"{folder}/parts")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(part_of(key_hash(key), parts)), batch.column(0)], ["part", "key"])

    wanted = keys.select(F.col(key_col).cast("long").alias("key")).filter("key IS NOT NULL").distinct().mapInArrow(deal, "part int, key long")

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            return pa.table({c: pa.array([], t) for c, t in (("key", pa.int64()), ("shard", pa.int32()), ("last", pa.int32()), ("place", pa.int32()))})
        key = left.column("key").to_numpy()
        known, rows = Index(folder, right.column("file")[0].as_py())(key)
        return pa.table({"key": key[known], **{c: rows[c].astype(np.int32) for c in ("shard", "last", "place")}})

    return wanted.groupBy("part").cogroup(files.groupBy("part")).applyInArrow(find, "key long, shard int, last int, place int")


def read_documents(manifest: DataFrame, places: DataFrame, folder: str, nulls: bool = True) -> DataFrame:
    """(key, shard, start, n_tokens, ids_crc32) of every document at the given places.

    `places` holds (key, shard, last, place); a key's documents stand one after another,
    over the shards from `shard` to `last`. Each shard is read once, front to back, by the
    task that gets its places. With `nulls`, documents without a key are read too.
    """
    spark = places.sparkSession
    pieces = places.select("key", F.explode(F.sequence("shard", "last")).alias("shard"))
    if nulls:
        pieces = pieces.unionByName(manifest.filter("nulls > 0").select(F.lit(None).cast("long").alias("key"), "shard"))
    known = manifest.select("shard", "file", "first_id")
    n = max(1, min(manifest.count(), 100_000))

    def read(left: pa.Table, right: pa.Table) -> pa.Table:
        kinds = [("key", pa.int64()), ("shard", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
        if left.num_rows == 0 or right.num_rows == 0:
            return pa.table({c: pa.array([], t) for c, t in kinds})
        fs, base = filesystem(folder)
        shard, file, first_id = (right.column(c)[0].as_py() for c in ("shard", "file", "first_id"))
        with fs.open_input_file(f"{base}/{file}") as source:
            starts, keys, width, n_null = read_footer(fs, file, source)
            asked = left.column("key").combine_chunks()
            wanted = np.sort(asked.drop_null().to_numpy())
            real = keys[n_null:]
            at = np.searchsorted(wanted, real)
            mask = np.zeros(len(keys), bool)
            if len(wanted):
                mask[n_null:] = wanted[np.minimum(at, len(wanted) - 1)] == real
            mask[:n_null] = bool(asked.null_count)
            sums = np.zeros(len(keys), np.int64)
            for i in np.flatnonzero(mask):
                crc = 0
                for lo in range(int(starts[i]), int(starts[i + 1]), 1 << 22):
                    hi = min(lo + (1 << 22), int(starts[i + 1]))
                    ids = np.frombuffer(source.read_at((hi - lo) * width, lo * width), "<u2" if width == 2 else "<u4")
                    crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                sums[i] = crc
        at = np.flatnonzero(mask)
        return pa.table({
            "key": pa.array(keys[at], pa.int64(), mask=at < n_null), "shard": pa.array(np.full(len(at), shard, np.int32)),
            "start": starts[at] + first_id, "n_tokens": starts[at + 1] - starts[at], "ids_crc32": sums[at]})

    with_n = pieces.repartition(n, "shard")
    return with_n.groupBy("shard").cogroup(known.repartition(n, "shard").groupBy("shard")).applyInArrow(
        read, "key long, shard int, start long, n_tokens long, ids_crc32 long")


def store_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", root: str | None = None,
                 shard_bytes: int = SHARD_BYTES, part_keys: int = PART_KEYS) -> tuple[DataFrame, str, int]:
    """Encodes, writes shards and index; returns (manifest, folder, index parts).

    Texts that are null or empty hold the end id alone. Rows of equal id are all written,
    side by side; the index leads to the first and the reader goes on while the key lasts.
    Rows with a null id come first and are not indexed. An empty table gives no file.
    Other columns are not read. One shard or index part is what one task holds.
    """
    manifest, folder = write_shards(docs, tokenizer, id_col, text_col, root, shard_bytes=shard_bytes)
    return manifest, folder, build_index(docs.sparkSession, manifest, folder, part_keys)


def stored_digest(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", **sizes: int) -> DataFrame:
    """Writes the token store, then gets every document back by key: index, place, ids."""
    manifest, folder, parts = store_tokens(docs, tokenizer, id_col, text_col, **sizes)
    places = lookup(docs.select(F.col(id_col).alias("key")), folder, parts)
    return read_documents(manifest, places, folder).select(F.col("key").alias(id_col), "start", "n_tokens", "ids_crc32", "shard")

"""Exact repeats of long byte strings, from counted ranks of positions that content picks.

The method dealt for this was distributed prefix doubling: Spark sorts the rank pairs of all byte positions at growing
offsets and reranks until ranks are unique or past the threshold. That is not what runs here. In
its plain form one round moved 50 bytes of shuffle per byte of text (124 MB for 2.47 MB, measured), some
43 GB for the 0.86 GB of text of the larger check, where 2.3 GB are the limit. What replaces it gives the same
bytes with one doubling, ranks that are hashes counted by hash range, and no sort of pairs:

A string of `length` bytes holds a string of half its length (here K = ceil(length / 2)) that its content alone
picks: the one with the smallest hash among its first length - K + 1 places. So first the K-byte ranks of the picked
places are counted over the whole corpus: a place whose rank is unique takes all strings that
picked it out of the game. Neighbouring strings that picked the same place form a
run; runs that are equal as a whole are repeated as a whole, and only one of them stays.

What is left doubles once: a position's rank pair (K bytes here, K bytes at the offset
length - K on) is dealt by hash range and counted; pairs found twice are repeats.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from scorelake.llm import bytescan as B
from scorelake.llm import exchange as X
from scorelake.sources.checkpoint import materialize

LENGTH = 200
#: Bytes of string starts that one vectorised step handles.
PIECE = 1 << 18
#: Text bytes per batch; a batch's runs and rank pairs are in memory together.
BATCH_BYTES = 1 << 20
PICK_MASK = np.uint64(0xFFFFFF)
RUN_SALT = np.uint64(0x51AFD7ED558CCD25)
RANK_SALT = np.uint64(0xC4CEB9FE1A85EC53)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbours, from running minima of blocks of that width."""
    pad = -len(values) % width
    rows = np.concatenate([values, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: len(values) - width + 1], ahead[width - 1 : len(values)])


def runs_of(batch: X.Batch, length: int) -> Iterator[tuple[int, np.ndarray, dict[str, np.ndarray]]]:
    """Piece by piece: its first byte, its prefix sums, and the runs that start in it, as
    columns: begin and end (first and last start), rank of the picked place, rank of the run."""
    half = -(-length // 2)
    buf, off = batch.buf, batch.off
    for a in range(0, max(len(buf) - length + 1, 0), PIECE):
        piece = buf[a : a + PIECE + length - 1]
        sums = B.prefix_sums(piece)
        inverse = B.powers(len(sums))[1]
        ranks = B.mix((sums[half:] - sums[:-half]) * inverse[: len(sums) - half])
        order = (ranks & ~PICK_MASK) | (PICK_MASK - np.arange(len(ranks), dtype=np.uint64))
        least = sliding_min(order, length - half + 1)
        picked = (PICK_MASK - (least & PICK_MASK)).astype(np.int64)
        start = np.arange(len(picked)) + a
        doc = np.searchsorted(off, start, "right") - 1
        inside = start + length <= off[doc + 1]
        new = np.ones(len(picked), bool)
        new[1:] = (picked[1:] != picked[:-1]) | (doc[1:] != doc[:-1]) | (inside[1:] != inside[:-1])
        begin = np.flatnonzero(new)
        end = np.concatenate([begin[1:], [len(picked)]]) - 1
        keep = inside[begin]
        begin, end = begin[keep], end[keep]
        shape = (picked[begin] - begin).astype(np.uint64) * np.uint64(B.BASE) + (end - begin).astype(np.uint64)
        whole = B.mix((sums[end + length] - sums[begin]) * inverse[begin]) ^ RUN_SALT
        # Picked ranks are the smallest of many: mixed anew, or they would all fall into the first range.
        yield a, sums, {"begin": begin, "end": end, "rank": B.mix(ranks[picked[begin]] ^ RANK_SALT), "run": B.mix(whole + shape)}


def string_pairs(sums: np.ndarray, begin: np.ndarray, end: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all strings of the runs, and the hash of each one's rank pair."""
    half = -(-length // 2)
    n = end - begin + 1
    start = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
    inverse = B.powers(len(sums))[1]
    here = B.mix((sums[start + half] - sums[start]) * inverse[start])
    there = start + length - half
    ahead = B.mix((sums[there + half] - sums[there]) * inverse[there])
    return start, B.mix(here * np.uint64(B.BASE) + ahead)


def runs_table(batch: X.Batch, length: int) -> dict[str, np.ndarray]:
    parts = [{**r, "begin": r["begin"] + a, "end": r["end"] + a} for a, _, r in runs_of(batch, length)]
    return {c: np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, np.int64 if c in ("begin", "end") else np.uint64) for c in ("begin", "end", "rank", "run")}


def dedup_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept) per input row; `kept` is the
    text without every byte that a `length`-byte string covers which also starts
    elsewhere in the corpus, the same text included. Matches never cross texts.

    Each pass deals keys by ranges of their hash, which are of like size; a string that a third
    of all rows hold costs one entry per batch of texts. Ranks are 64-bit hashes.

    Null and empty texts, and texts shorter than `length`, keep all bytes. Copies remove each
    other whole, the first one too. `kept` is bytes: a cut may split a character. Null
    ids stay null, other columns are not read, an empty table gives an empty table.
    """
    stored, ids, size = X.pack(docs, id_col, text_col, BATCH_BYTES)
    half = -(-length // 2)
    parts = X.parts_for(4 * size / (length - half + 2))

    def first_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches:
            for number, batch in X.unpack_rows(table):
                r = runs_table(batch, length)
                keys, counts = np.unique(np.concatenate([r["rank"], r["run"]]), return_counts=True)
                yield from X.blocks(number, keys, counts, parts)

    ranks = X.totals(stored.mapInArrow(first_lists, X.BLOCKS), parts)
    state = "kind int, batch long, part int, n int, keys binary, counts binary, starts binary, ends binary"

    def double(texts: pa.Table, totals: pa.Table) -> pa.Table:
        """Spans of runs that are repeated as a whole, and the rank pairs that go on."""
        out = []
        if texts.num_rows:
            (number, batch), = X.unpack_rows(texts)
            found, first = X.read_totals(totals)
            r = runs_table(batch, length)
            keys = B.distinct(np.concatenate([r["rank"], r["run"]]))
            at_rank, at_run = np.searchsorted(keys, r["rank"]), np.searchsorted(keys, r["run"])
            n_rank, n_run = found[at_rank], found[at_run]
            whole = n_run > 1
            # Of equal runs one goes on, the first of the first batch, as a partner for others.
            lead = np.zeros(len(at_run), bool)
            lead[np.unique(at_run, return_index=True)[1]] = True
            go = (n_rank > n_run) & (~whole | (lead & first[at_run]))
            pairs, at = [], 0
            for _, sums, piece in runs_of(batch, length):
                mine = slice(at, at + len(piece["begin"]))
                at = mine.stop
                _, pair = string_pairs(sums, piece["begin"][go[mine]], piece["end"][go[mine]], length)
                pairs.append(pair)
            pair = np.concatenate(pairs) if pairs else X.NOTHING
            key, count = np.unique(pair, return_counts=True)
            for block in X.blocks(number, key, count, pair_parts):
                out.append(dict(kind=0, starts=b"", ends=b"", **block.to_pylist()[0]))
            # Runs as (begin, end), and whether they are settled: whole repeats need no more.
            settle = np.flatnonzero(whole | go)
            marks = np.packbits(np.stack([whole[settle], go[settle]]).ravel()).tobytes()
            out.append(dict(kind=1, batch=number, part=-1, n=len(settle), keys=marks, counts=b"",
                            starts=r["begin"][settle].astype("<i8").tobytes(), ends=r["end"][settle].astype("<i8").tobytes()))
        return pa.Table.from_pylist(out, SCHEMA)

    pair_parts = X.parts_for(size / 4)
    went = materialize(stored.groupBy("batch").cogroup(ranks.groupBy("batch")).applyInArrow(double, state), "repeat-state")
    pairs = X.totals(went.filter("kind = 0").select("batch", "part", "n", "keys", "counts"), pair_parts)
    runs = went.filter("kind = 1").selectExpr("batch", "n AS n_runs", "keys AS marks", "starts", "ends")

    asked = stored.join(runs, "batch")

    def settle(texts: pa.Table, totals: pa.Table) -> pa.Table:
        """Byte spans that repeats cover, merged, and what is left of each text."""
        if texts.num_rows == 0:
            return pa.Table.from_pylist([], RESULT)
        (_, batch), = X.unpack_rows(texts)
        n = texts.column("n_runs")[0].as_py()
        whole, go = np.unpackbits(np.frombuffer(texts.column("marks")[0].as_py(), np.uint8), count=2 * n).astype(bool).reshape(2, n)
        begin, end = (np.frombuffer(texts.column(c)[0].as_py(), "<i8") for c in ("starts", "ends"))
        found, _ = X.read_totals(totals)
        lows, highs = [begin[whole]], [end[whole] + length]
        gathered = []
        for a in range(0, max(len(batch.buf) - length + 1, 0), PIECE):
            mine = go & (begin >= a) & (begin < a + PIECE)
            if mine.any():
                sums = B.prefix_sums(batch.buf[a : a + PIECE + length - 1])
                start, pair = string_pairs(sums, begin[mine] - a, end[mine] - a, length)
                gathered.append((start + a, pair))
        if gathered:
            start, pair = (np.concatenate(x) for x in zip(*gathered, strict=True))
            again = found[np.searchsorted(B.distinct(pair), pair)] > 1
            lows.append(start[again])
            highs.append(start[again] + length)
        starts, ends = merged(np.concatenate(lows), np.concatenate(highs), batch.off)
        return digests(batch, starts, ends)

    done = asked.groupBy("batch").cogroup(pairs.groupBy("batch")).applyInArrow(
        settle, "row long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return ids.join(done, "row").selectExpr(f"id AS `{id_col}`", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")


SCHEMA = pa.schema([("kind", pa.int32()), ("batch", pa.int64()), ("part", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()),
                    ("counts", pa.binary()), ("starts", pa.binary()), ("ends", pa.binary())])
RESULT = pa.schema([("row", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                    ("kept_sha256", pa.string()), ("kept", pa.binary())])


def merged(lows: np.ndarray, highs: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of spans; spans that only touch join, unless a text ends between them."""
    if not len(lows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(lows, kind="stable")
    lows, reach = lows[order], np.maximum.accumulate(highs[order])
    doc = np.searchsorted(off, lows, "right")
    new = np.ones(len(lows), bool)
    new[1:] = (lows[1:] > reach[:-1]) | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(new)
    return lows[begin], reach[np.concatenate([begin[1:], [len(lows)]]) - 1]


def digests(batch: X.Batch, starts: np.ndarray, ends: np.ndarray) -> pa.Table:
    """A RESULT row per text, without the bytes of the spans."""
    first = np.searchsorted(starts, batch.off)
    raw, out = memoryview(batch.buf), []
    for i, row in enumerate(batch.rows):
        at, stop = int(batch.off[i]), int(batch.off[i + 1])
        size, kept = stop - at, []
        for s, e in zip(starts[first[i] : first[i + 1]].tolist(), ends[first[i] : first[i + 1]].tolist(), strict=True):
            kept.append(raw[at:s])
            at = e
        kept.append(raw[at:stop])
        text = b"".join(kept)
        out.append((int(row), size, size - len(text), int(first[i + 1] - first[i]), hashlib.sha256(text).hexdigest(), text))
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), RESULT, strict=True)], schema=RESULT)

"""The prefix trie of conversations, with subtree totals by centroid decomposition."""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from scorelake.llm.mixing import words_of
from scorelake.operators.ordinals import number_rows
from scorelake.sources.checkpoint import materialize

#: Largest weight (rebuilt turns at or below the top) of a component that one task takes apart.
LOCAL_WEIGHT = 4096
#: Turns of a conversation that one window runs over.
BLOCK = 1024
#: Conversation ids that one list of ends covers, as a power of two.
ENDS_BITS = 16


def rebuilt_turns(conversations: DataFrame, cycle: int = 20, shared: int = 4) -> tuple[DataFrame, DataFrame]:
    """(conv, depth, n, words, t1, t2) per rebuilt turn, t1 and t2 hashes of depth, role and text,
    and (conv, n) per conversation, n its rebuilt turns.

    Turns are numbered by one range sort over all conversations, so that a conversation
    with a third of all rows lies in many slices.
    """
    turn = F.struct(F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", F.xxhash64(turn).alias("g1"), F.xxhash64(F.lit(1), turn).alias("g2"), words_of(F.col("text")).alias("words"))
    turns = number_rows(rows, [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("g1"), F.col("g2")], "nth").drop("turn")
    lengths = materialize(turns.groupBy("conv").agg(F.min("nth").alias("first"), F.count(F.lit(1)).alias("len")), "lengths")
    bases = lengths.select(F.col("conv").alias("base"), F.col("len").alias("base_len"))
    convs = materialize(
        lengths.select("*", (F.crc32(F.col("conv").cast("string").cast("binary")) % shared).alias("h"), (F.col("conv") - F.col("conv") % cycle).alias("base"))
        .join(bases, "base", "left").withColumn("head", F.least("h", F.coalesce("base_len", F.lit(0))))
        .select("conv", "base", "first", "h", "head", (F.col("head") + F.greatest(F.col("len") - F.col("h"), F.lit(0))).alias("n")), "convs")
    placed = turns.join(convs.select("conv", "first", "h", "head", "n"), "conv").withColumn("at", F.col("nth") - F.col("first") + 1)
    own = placed.filter("at > h").select("conv", (F.col("head") + F.col("at") - F.col("h")).alias("depth"), "n", "words", "g1", "g2")
    # The first turns of a base go to its cycle of conversations, a few rows to each.
    heads = placed.filter((F.col("at") < shared) & (F.col("conv") % cycle == 0)).select(F.col("conv").alias("base"), F.col("at").alias("depth"), "words", "g1", "g2")
    taken = heads.join(convs.select("conv", "base", "h", "n"), "base").filter("depth <= h").select("conv", "depth", "n", "words", "g1", "g2")
    return own.unionByName(taken).select(
        "conv", "depth", "n", "words", F.xxhash64("depth", "g1").alias("t1"), F.xxhash64("depth", "g2").alias("t2")), convs.select("conv", "n")


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, depth, n, words, p, q, above_p, above_q): 128 bits that tell the sequence of the first
    `depth` turns, and those of the sequence before the last of them.

    They are running XORs of the turns' hashes (which hold the depth), taken over blocks of
    BLOCK turns and shifted by the blocks before, so no window holds a whole conversation.
    """
    block = F.floor((F.col("depth") - 1) / F.lit(BLOCK)).cast("long")
    rows = turns.withColumn("block", block)
    inside = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    long = rows.filter(F.col("n") > BLOCK).groupBy("conv", "block").agg(F.bit_xor("t1").alias("x1"), F.bit_xor("t2").alias("x2"))
    shifts = long.select("conv", "block", F.bit_xor("x1").over(before).alias("s1"), F.bit_xor("x2").over(before).alias("s2"))
    run = rows.select("*", F.bit_xor("t1").over(inside).alias("r1"), F.bit_xor("t2").over(inside).alias("r2")).join(shifts, ["conv", "block"], "left")
    whole = run.withColumn("p", F.col("r1").bitwiseXOR(F.coalesce("s1", F.lit(0)))).withColumn("q", F.col("r2").bitwiseXOR(F.coalesce("s2", F.lit(0))))
    return whole.select("conv", "depth", "n", "words", "p", "q", F.col("p").bitwiseXOR(F.col("t1")).alias("above_p"), F.col("q").bitwiseXOR(F.col("t2")).alias("above_q"))


def build_trie(members: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node: conv (the smallest member), depth, parent (its conv), n_convs,
    n_children, words of the last text, weight (rebuilt turns at or below it, with
    repeats), p and q. (conv, depth) tells a node."""
    one = F.lit(1)
    root = convs.agg(F.min("conv").alias("conv"), F.count(one).alias("n_convs"), F.sum(F.col("n") + 1).alias("weight")).filter("n_convs > 0").select(
        F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(c) for c in ("p", "q")], "conv", "n_convs", F.lit(0).cast("long").alias("words"), "weight",
        *[F.lit(None).cast("long").alias(c) for c in ("above_p", "above_q")])
    nodes = members.groupBy("depth", "p", "q").agg(
        F.min("conv").alias("conv"), F.count(one).alias("n_convs"), F.max("words").alias("words"), F.sum(F.col("n") - F.col("depth") + 1).alias("weight"),
        F.min("above_p").alias("above_p"), F.min("above_q").alias("above_q"))
    nodes = materialize(root.unionByName(nodes), "nodes")
    above = (F.col("depth") - 1).alias("depth"), F.col("above_p").alias("p"), F.col("above_q").alias("q")
    kids = nodes.filter("depth > 0").select(*above).groupBy("depth", "p", "q").agg(F.count(one).alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p").alias("above_p"), F.col("q").alias("above_q"), F.col("conv").alias("parent"))
    tree = nodes.join(kids, ["depth", "p", "q"], "left").join(parents, ["depth", "above_p", "above_q"], "left")
    return materialize(tree.select("conv", "depth", "parent", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "words", "weight", "p", "q"), "trie")


def node_paths(members: DataFrame, tree: DataFrame) -> DataFrame:
    """(conv, depth, owner, next): for every conversation that names a node, the conv of the node at
    each depth of its sequence, and at the depth below."""
    owners = tree.filter("depth > 0").select("conv").distinct()
    spots = members.select("conv", "depth", "p", "q").join(owners, "conv", "left_semi")
    named = tree.filter("depth > 0").select("depth", "p", "q", F.col("conv").alias("owner"))
    root = owners.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(tree.filter("depth = 0").first()["conv"]).cast("long").alias("owner"))
    path = materialize(spots.join(named, ["depth", "p", "q"]).select("conv", "depth", "owner").unionByName(root), "path")
    following = path.select("conv", (F.col("depth") - 1).alias("depth"), F.col("owner").alias("next"))
    return materialize(path.join(following, ["conv", "depth"], "left"), "paths")


def subtree_totals(tree: DataFrame, members: DataFrame, values: dict[str, Column], local_weight: int = LOCAL_WEIGHT) -> DataFrame:
    """(conv, depth, *values): each value summed over every node's subtree, itself included.

    Centroid decomposition of the parent edges. A component's centroid is the deepest node
    with over half of the component's weight below it. The total of the component's nodes below the centroid is added to
    every node on the way from the centroid up to the component's top; then the centroid is taken out, which leaves its child
    subtrees and the upper rest, each of at most half the weight. A pair of ancestor and descendant
    is parted by exactly one centroid, so each sum is complete, after about log2(weight) rounds however deep the trie.

    Components above `local_weight` are split by joins on the whole frame, a round for all of them
    at once; smaller ones are bounded and each is finished within a task.
    """
    names = list(values)
    state = materialize(tree.select(
        "conv", "depth", "parent", F.lit(tree.filter("depth = 0").first()["conv"]).cast("long").alias("top"), F.lit(0).cast("long").alias("top_depth"), F.col("weight").alias("below"),
        *[c.cast("long").alias(v) for v, c in values.items()], *[F.lit(0).cast("long").alias(f"sum_{v}") for v in names]), "state")
    paths = None
    while True:
        tops = materialize(state.filter((F.col("conv") == F.col("top")) & (F.col("depth") == F.col("top_depth")) & (F.col("below") > local_weight)).select("top", "top_depth", F.col("below").alias("whole")), "tops")
        if tops.isEmpty():
            break
        paths = node_paths(members, tree) if paths is None else paths
        state = materialize(split_once(state, tops, paths, names), "state")
    return finish_locally(state, names)


def split_once(state: DataFrame, tops: DataFrame, paths: DataFrame, names: list[str]) -> DataFrame:
    """The state after the centroid of every component in `tops` was taken out."""
    here = ["top", "top_depth"]
    heavy = state.join(tops, here).filter("2 * below > whole")
    centroids = materialize(heavy.groupBy(*here).agg(F.min_by(F.struct("conv", "depth", "below"), "below").alias("c")).select(
        *here, F.col("c.conv").alias("mid"), F.col("c.depth").alias("mid_depth"), F.col("c.below").alias("mid_below")), "centroids")
    at_mid = paths.select("conv", F.col("depth").alias("mid_depth"), "owner", "next")
    under = state.join(centroids, here).filter("depth >= mid_depth").join(at_mid, ["conv", "mid_depth"]).filter("owner = mid")
    under = materialize(under.select("conv", "depth", *here, "mid_depth", "next", (F.col("depth") > F.col("mid_depth")).alias("stays"), *names), "under")
    totals = under.groupBy(*here).agg(*[F.sum(v).alias(f"add_{v}") for v in names])
    way = paths.select(F.col("conv").alias("mid"), "depth", F.col("owner").alias("conv"))
    up = centroids.join(totals, here).join(way, "mid").filter("depth BETWEEN top_depth AND mid_depth").select("conv", "depth", "mid_below", *[f"add_{v}" for v in names])
    parted = under.select("conv", "depth", "stays", F.col("next"), (F.col("mid_depth") + 1).alias("next_depth"))
    out = state.join(parted, ["conv", "depth"], "left").join(up, ["conv", "depth"], "left")
    return out.select(
        "conv", "depth", "parent", F.when(F.col("stays").isNull(), F.col("top")).when(F.col("stays"), F.col("next")).alias("top"),
        F.when(F.col("stays").isNull(), F.col("top_depth")).when(F.col("stays"), F.col("next_depth")).alias("top_depth"),
        # The node below the centroid starts a component of its own; those above lose what was below the centroid.
        F.when(F.col("stays").isNull(), F.col("below") - F.coalesce("mid_below", F.lit(0))).otherwise(F.col("below")).alias("below"), *names,
        *[(F.col(f"sum_{v}") + F.coalesce(f"add_{v}", F.lit(0))).alias(f"sum_{v}") for v in names])


def decompose(parent: list[int], below: list[int], values: list[list[int]]) -> list[list[int]]:
    """Subtree sums of one component, its nodes in order of depth, the top first (its parent is -1)."""
    sums = [[0] * len(parent) for _ in values]
    children: list[list[int]] = [[] for _ in parent]
    for i, p in enumerate(parent):
        if p >= 0:
            children[p].append(i)
    gone = [False] * len(parent)
    parts = [0]
    while parts:
        top = mid = parts.pop()
        half = below[top]
        while (heavy := next((c for c in children[mid] if not gone[c] and 2 * below[c] > half), None)) is not None:
            mid = heavy
        under, at = [mid], 0
        while at < len(under):
            under.extend(c for c in children[under[at]] if not gone[c])
            at += 1
        totals = [sum(v[i] for i in under) for v in values]
        cut, node = below[mid], mid
        while True:
            below[node] -= cut
            for s, t in zip(sums, totals, strict=True):
                s[node] += t
            if node == top:
                break
            node = parent[node]
        gone[mid] = True
        parts.extend(c for c in children[mid] if not gone[c])
        if mid != top:
            parts.append(top)
    return sums


def finish_locally(state: DataFrame, names: list[str]) -> DataFrame:
    """Sums of all nodes, once every component is small; components stream through sorted tasks."""
    columns = ["top", "top_depth", "depth", "conv", "parent", "below", *names]
    done = state.filter("top IS NULL").select("conv", "depth", *[F.lit(0).cast("long").alias(v) for v in names])
    schema = ", ".join(f"{c} long" for c in ["conv", "depth", *names])

    def component(rows: list[tuple]) -> Iterator[tuple]:
        place = {(r[2], r[3]): i for i, r in enumerate(rows)}
        parents = [-1 if i == 0 else place[r[2] - 1, r[4]] for i, r in enumerate(rows)]
        sums = decompose(parents, [r[5] for r in rows], [[r[6 + k] for r in rows] for k in range(len(names))])
        for i, r in enumerate(rows):
            yield r[3], r[2], *[s[i] for s in sums]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["conv", "depth", *names])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out = [], []
        for batch in batches:
            for r in zip(*[batch.column(c).to_pylist() for c in columns], strict=True):
                if held and held[0][:2] != r[:2]:
                    out.extend(component(held))
                    held = []
                held.append(r)
            if out:
                yield table(out)
                out = []
        if held:
            yield table(list(component(held)))

    small = state.filter("top IS NOT NULL").select(*columns).repartition("top", "top_depth").sortWithinPartitions("top", "top_depth", "depth")
    parts = done.unionByName(small.mapInArrow(scan, schema)).withColumnsRenamed({v: f"part_{v}" for v in names})
    return state.join(parts, ["conv", "depth"]).select("conv", "depth", *[(F.col(f"sum_{v}") + F.col(f"part_{v}")).alias(v) for v in names])


def end_digests(members: DataFrame, convs: DataFrame) -> DataFrame:
    """(depth, p, q, ends_sha256) of the nodes at which a conversation ends.

    Ids are listed in stretches of 2**ENDS_BITS ids; a node's stretches stream in order
    through one running digest, so that its list is never held as a whole.
    """
    zero = F.lit(0).cast("long")
    ends = members.filter("depth = n").select("depth", "p", "q", "conv").unionByName(convs.filter("n = 0").select(zero.alias("depth"), zero.alias("p"), zero.alias("q"), "conv"))
    listed = ends.groupBy("depth", "p", "q", F.shiftright("conv", ENDS_BITS).alias("stretch")).agg(F.sort_array(F.collect_list("conv")).alias("ids"))
    texts = listed.select("depth", "p", "q", "stretch", F.array_join(F.col("ids").cast("array<string>"), ",").alias("text"))
    sorted_ = texts.repartition("depth", "p", "q").sortWithinPartitions("depth", "p", "q", "stretch")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, out = None, None, []
        for batch in batches:
            for *node, text in zip(*[batch.column(c).to_pylist() for c in ("depth", "p", "q", "text")], strict=True):
                if node == key:
                    digest.update(b",")
                else:
                    if key is not None:
                        out.append((*key, digest.hexdigest()))
                    key, digest = node, hashlib.sha256()
                digest.update(text.encode())
            if out:
                yield rows(out)
                out = []
        if key is not None:
            yield rows([(*key, digest.hexdigest())])

    def rows(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["depth", "p", "q", "ends_sha256"])

    return sorted_.mapInArrow(scan, "depth long, p long, q long, ends_sha256 string")


def conversation_trie(conversations: DataFrame, cycle: int = 20, shared: int = 4, local_weight: int = LOCAL_WEIGHT) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    Conversation c is rebuilt from the first crc32(c) % `shared` turns of conversation c - c % `cycle` (all, if it
    has fewer; none, if there is no such conversation) and its own turns after as many. saved_tokens is what storing each shared
    prefix once would save: over the subtree, (n_convs - 1) times the words of the node's last text.

    Turns are ordered by `turn`, null first, equal ones by a hash of role and text; null roles and texts count as
    empty. Rows without a conv_id belong to no conversation and are left out. Repeated rows are turns of their own. Sequences are told by
    128 bits of hashes; texts are read once, for their hash and words, and never shuffled. A very long text is one value of one row. Other columns are
    not read; an empty table has no node.
    """
    turns, convs = rebuilt_turns(conversations, cycle, shared)
    members = materialize(prefixes(turns), "members")
    tree = build_trie(members, convs)
    if tree.isEmpty():
        names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
        return tree.sparkSession.createDataFrame([], ", ".join(f"{c} long" for c in names) + ", ends_sha256 string")
    values = {"n_leaves": (F.col("n_children") == 0), "saved_tokens": (F.col("n_convs") - 1) * F.col("words")}
    sums = subtree_totals(tree, members, values, local_weight)
    out = tree.join(sums, ["conv", "depth"]).join(end_digests(members, convs), ["depth", "p", "q"], "left")
    return out.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))

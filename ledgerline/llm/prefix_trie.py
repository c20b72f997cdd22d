"""Prefix trie of conversations with totals of every subtree.

A conversation may share its first turns with another; each distinct sequence
of first turns is a node.  Turns are numbered and prefixes named by Spark, in
bounded ranges and blocks, so a long conversation is no task of its own.

Subtree totals come from a centroid decomposition of the parent edges.  Each
node weighs as many turns as it has members, so subtree weights are known
from one aggregate.  In a component the nodes with over half of its weight
below them are the path from its top to its centroid; the total of what is
below the centroid is added along that path, and the centroid's removal leaves
components of at most half the weight.  Rounds of Spark jobs split components
of more than ``PIECE`` turns, all at once; what is left is finished by the
same steps on arrays inside tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import prepare, written

#: Weight (member turns) of a component that one task finishes, and nodes of a task's share.
PIECE = 8192
#: Turns of one conversation whose prefixes one window names.
BLOCK = 4096
#: Ids joined into one string before strings of a node meet.
IDS = 4096


def numbered(turns: DataFrame) -> DataFrame:
    """(conv, pos, a, b, n_bytes) of each turn: place in its conversation from
    1, two digests of role and text, bytes of the text.

    Order: turn (null first), role, MD5 of the text; equal rows stay two turns.
    Rows are dealt in ranges of that order and counted per range."""
    text, role = F.coalesce(F.col("text").cast("string"), F.lit("")), F.coalesce(F.col("role").cast("string"), F.lit(""))
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.unhex(F.md5(text.cast("binary"))).alias("md5"), F.octet_length(text).cast("long").alias("n_bytes"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("md5")]
    dealt = written(rows.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id()), "op12-turns")
    sizes = dealt.groupBy("part", "conv").count()
    before = F.sum("count").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    split = sizes.withColumn("before", F.coalesce(before, F.lit(0)))
    placed = dealt.withColumn("at", F.row_number().over(Window.partitionBy("part", "conv").orderBy(*order)))
    return placed.join(split.filter("before > 0"), ["part", "conv"], "left").select(
        "conv", (F.col("at") + F.coalesce("before", F.lit(0))).cast("long").alias("pos"),
        F.xxhash64("role", "md5").alias("a"), F.xxhash64(F.lit(1), "md5", "role").alias("b"), "n_bytes")


def shared_starts(own: DataFrame, base_of: Column, kept: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first ``kept`` (at most ``most``) turns are those of
    conversation ``base_of``: rows (conv, depth, len, a, b, n_bytes), and (conv, len)."""
    convs = own.groupBy("conv").agg(F.max("pos").alias("n_own")).withColumn("base", base_of).withColumn("h", kept)
    sizes = convs.select(F.col("conv").alias("base"), F.col("n_own").alias("n_base"))
    convs = convs.join(sizes, "base", "left").select(
        "conv", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("k"), "n_own")
    convs = written(convs.withColumn("len", F.col("k") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))), "op12-convs")
    tail = own.join(convs.select("conv", "h", "k", "len"), "conv").filter("pos > h").select(
        "conv", (F.col("pos") - F.col("h") + F.col("k")).alias("depth"), "len", "a", "b", "n_bytes")
    head = own.filter(F.col("pos") <= most).withColumnRenamed("conv", "base").join(
        convs.select("conv", "base", "k", "len"), "base").filter("pos <= k").select(
        "conv", F.col("pos").alias("depth"), "len", "a", "b", "n_bytes")
    return head.unionByName(tail), convs.select("conv", "len")


def prefixes(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv, depth, len, p1, p2, q1, q2, n_bytes): the names of each prefix and
    of its parent.  A name is two 64-bit sums (exclusive or) of hashes of
    (place, turn), so blocks of a long conversation are named side by side."""
    rows = rows.withColumn("t1", F.xxhash64("depth", "a", "b")).withColumn("t2", F.xxhash64("b", F.lit(2), "a", "depth"))
    rows = rows.withColumn("block", F.expr(f"(depth - 1) div {BLOCK}")).drop("a", "b")
    x = lambda c, w: F.coalesce(F.bit_xor(c).over(w), F.lit(0).cast("long"))
    ahead = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv", "block").agg(F.bit_xor("t1").alias("s1"), F.bit_xor("t2").alias("s2"))
    blocks = blocks.select("conv", "block", x("s1", ahead).alias("o1"), x("s2", ahead).alias("o2"))
    inside = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    named = rows.withColumn("i1", x("t1", inside)).withColumn("i2", x("t2", inside)).join(
        blocks.filter("block > 0"), ["conv", "block"], "left")
    for k in ("1", "2"):
        named = named.withColumn("p" + k, F.col("i" + k).bitwiseXOR(F.coalesce("o" + k, F.lit(0).cast("long"))))
        named = named.withColumn("q" + k, F.col("p" + k).bitwiseXOR(F.col("t" + k)))
    zero = F.lit(0).cast("long")
    roots = lengths.select("conv", zero.alias("depth"), "len", zero.alias("p1"), zero.alias("p2"),
                           F.lit(None).cast("long").alias("q1"), F.lit(None).cast("long").alias("q2"), zero.alias("n_bytes"))
    return named.select(*roots.columns).unionByName(roots)


def nodes_of(paths: DataFrame) -> DataFrame:
    """One row a node: conv (smallest member), members, ends, subtree weight."""
    return paths.groupBy("depth", "p1", "p2").agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"),
        F.count_if(F.col("len") == F.col("depth")).alias("n_ends"),
        F.sum(F.col("len") - F.col("depth") + 1).alias("weight"),
        F.max("n_bytes").alias("n_bytes"), F.max("q1").alias("q1"), F.max("q2").alias("q2"))


def subtree_totals(nodes: DataFrame, paths: DataFrame, values: list[str], piece: int = PIECE) -> DataFrame:
    """(p1, p2, values...): each value summed over the node's subtree.

    ``nodes`` names each node's component (l1, l2) by its top; at first all
    are in the root's."""
    state = ["depth", "p1", "p2", "q1", "q2", "conv", "weight", "l1", "l2", *values, *["sum_" + v for v in values]]
    zero = F.lit(0).cast("long")
    live = nodes
    for v in values:
        live = live.withColumn("sum_" + v, zero)
    live = live.select(*state)
    done, small = [], []
    level = 0
    while True:
        tops = live.groupBy("l1", "l2").agg(F.max("weight").alias("whole"))  # a component weighs what its top does
        large = written(tops.filter(F.col("whole") > piece), f"op12-large-{level}")
        if large.isEmpty():
            small.append(live)
            break
        small.append(live.join(large, ["l1", "l2"], "left_anti").select(*state))
        live = live.join(large, ["l1", "l2"])
        path = live.filter(2 * F.col("weight") > F.col("whole"))
        centroid = written(path.groupBy("l1", "l2").agg(F.max_by(F.struct("depth", "p1", "p2", "weight"), "depth").alias("x")).select(
            "l1", "l2", *[F.col("x." + c).alias("x_" + c) for c in ("depth", "p1", "p2", "weight")]), f"op12-centroids-{level}")
        # conversations that go on below a centroid, and the child they go on with
        below = paths.select("conv", "depth", "p1", "p2", F.col("q1").alias("x_p1"), F.col("q2").alias("x_p2")).join(
            centroid.withColumn("depth", F.col("x_depth") + 1).select("l1", "l2", "depth", "x_p1", "x_p2"),
            ["depth", "x_p1", "x_p2"]).select("l1", "l2", "conv", F.col("p1").alias("c1"), F.col("p2").alias("c2"))
        live = live.join(centroid, ["l1", "l2"]).join(below, ["l1", "l2", "conv"], "left")
        on_path = 2 * F.col("weight") > F.col("whole")
        is_x = on_path & (F.col("depth") == F.col("x_depth"))
        under = F.col("c1").isNotNull() & (F.col("depth") > F.col("x_depth"))
        marked = live.withColumn("is_x", is_x).withColumn("under", under).withColumn("on_path", on_path)
        marked = marked.withColumn("weight", F.when(on_path & ~is_x, F.col("weight") - F.col("x_weight")).otherwise(F.col("weight")))
        marked = marked.select(
            *[c for c in state if c not in ("l1", "l2")], F.col("l1").alias("o1"), F.col("l2").alias("o2"),
            F.when(F.col("under"), F.col("c1")).otherwise(F.col("l1")).alias("l1"),
            F.when(F.col("under"), F.col("c2")).otherwise(F.col("l2")).alias("l2"), "is_x", "under", "on_path")
        marked = written(marked, f"op12-round-{level}")
        totals = marked.filter(F.col("is_x") | F.col("under")).groupBy("o1", "o2").agg(
            *[F.sum(v).alias("add_" + v) for v in values])
        live = marked.join(totals, ["o1", "o2"])
        for v in values:
            live = live.withColumn("sum_" + v, F.col("sum_" + v) + F.when(F.col("on_path"), F.col("add_" + v)).otherwise(zero))
        done.append(live.filter("is_x").select("p1", "p2", *["sum_" + v for v in values]))
        live = live.filter("not is_x").select(*state)
        level += 1
    rest = small[0]
    for s in small[1:]:
        rest = rest.unionByName(s)
    out = finish(rest, values, piece)
    for d in done:
        out = out.unionByName(d)
    return out.select("p1", "p2", *[F.col("sum_" + v).alias(v) for v in values])


def roots_of(parent: np.ndarray) -> np.ndarray:
    """Top of each node; tops are their own parent."""
    top = parent
    while True:
        up = top[top]
        if np.array_equal(up, top):
            return top
        top = up


def decompose(parent: np.ndarray, depth: np.ndarray, weight: np.ndarray, values: list[np.ndarray]) -> list[np.ndarray]:
    """Subtree sums of each value over a forest, by centroids of all trees at once.

    ``weight`` is positive and, like in ``subtree_totals``, of whole subtrees."""
    n = len(parent)
    parent, weight = parent.copy(), weight.copy()
    sums = [np.zeros(n, np.int64) for _ in values]
    live = np.arange(n)
    while len(live):
        top = roots_of(parent)
        path = live[2 * weight[live] > weight[top[live]]]
        deepest = np.full(n, -1, np.int64)
        np.maximum.at(deepest, top[path], depth[path])
        x = path[depth[path] == deepest[top[path]]]
        cut = parent.copy()
        cut[x] = x
        is_x = np.zeros(n, bool)
        is_x[x] = True
        inside = live[is_x[roots_of(cut)[live]]]
        for v, total in zip(values, sums):
            add = np.zeros(n, np.int64)
            np.add.at(add, top[inside], v[inside])
            total[path] += add[top[path]]
        lost = np.zeros(n, np.int64)
        lost[top[x]] = weight[x]
        above = path[~is_x[path]]
        weight[above] -= lost[top[above]]
        child = live[is_x[parent[live]]]
        parent[child] = child
        parent[x] = x
        live = live[~is_x[live]]
    return sums


def finish(pieces: DataFrame, values: list[str], piece: int) -> DataFrame:
    """The rounds of ``subtree_totals`` on components of at most ``piece`` weight, inside tasks."""
    shares = max(1, -(-pieces.count() // piece))
    dealt = pieces.withColumn("share", F.expr(f"pmod(xxhash64(l1, l2), {shares})"))
    names = ["p1", "p2", *["sum_" + v for v in values]]

    def run(key, table):
        col = {c: table.column(c).to_numpy(zero_copy_only=False) for c in table.column_names if c not in ("q1", "q2")}
        own = list(zip(col["p1"].tolist(), col["p2"].tolist()))
        at = {name: i for i, name in enumerate(own)}
        up = list(zip(table.column("q1").to_pylist(), table.column("q2").to_pylist()))
        label = list(zip(col["l1"].tolist(), col["l2"].tolist()))
        parent = np.array([i if own[i] == label[i] else at[up[i]] for i in range(len(own))], np.int64)
        sums = decompose(parent, col["depth"], col["weight"], [col[v] for v in values])
        return pa.table([pa.array(col["p1"]), pa.array(col["p2"])] + [
            pa.array(s + col["sum_" + v]) for s, v in zip(sums, values)], names)

    return dealt.groupBy("share").applyInArrow(run, ", ".join(n + " long" for n in names))


def joined_ids(ends: DataFrame) -> DataFrame:
    """(p1, p2, ends_sha256): digest of the comma-joined ascending ``conv`` of each node.

    Ids are joined into strings in ranges of (node, id); the strings of a node
    then pass its digest one after the other, so no list of ids is held."""
    text = "p1 long, p2 long, first long, ids string"

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, held = None, []

        def out():
            return pa.RecordBatch.from_arrays([pa.array([node[0]]), pa.array([node[1]]), pa.array([held[0]]),
                                               pa.array([",".join(map(str, held))])], ["p1", "p2", "first", "ids"])

        for batch in batches:
            for p1, p2, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if node != (p1, p2) or len(held) == IDS:
                    if held:
                        yield out()
                    node, held = (p1, p2), []
                held.append(conv)
        if held:
            yield out()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            rows: list[tuple] = []
            for p1, p2, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if node != (p1, p2):
                    if node:
                        rows.append((*node, digest.hexdigest()))
                    node, digest = (p1, p2), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if rows:
                yield _digest_batch(rows)
        if node:
            yield _digest_batch([(*node, digest.hexdigest())])

    strings = ends.repartitionByRange("p1", "p2", "conv").sortWithinPartitions("p1", "p2", "conv").mapInArrow(chunks, text)
    return strings.repartition("p1", "p2").sortWithinPartitions("p1", "p2", "first").mapInArrow(
        digests, "p1 long, p2 long, ends_sha256 string")


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    a, b, c = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c)], ["p1", "p2", "ends_sha256"])


def trie(paths: DataFrame, piece: int = PIECE) -> DataFrame:
    """One row a node of the trie over ``prefixes`` rows: conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    zero = F.lit(0).cast("long")
    nodes = written(nodes_of(paths).withColumn("leaves", (F.col("n_ends") == F.col("n_convs")).cast("long")).withColumn(
        "saved", (F.col("n_convs") - 1) * F.col("n_bytes")).withColumn("l1", zero).withColumn("l2", zero), "op12-nodes")
    totals = subtree_totals(nodes, paths, ["leaves", "saved"], piece)
    children = nodes.filter("depth > 0").groupBy(F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(
        F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv").alias("parent_conv_id"))
    ends = joined_ids(paths.filter("len = depth").select("p1", "p2", "conv"))
    own = nodes.select("p1", "p2", "q1", "q2", F.col("conv").alias("conv_id"), "depth", "n_convs").join(
        totals, ["p1", "p2"]).join(children, ["p1", "p2"], "left").join(ends, ["p1", "p2"], "left")
    return own.join(parents, ["q1", "q2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, base_of: Column | None = None, kept: Column | None = None, most: int = 0,
                piece: int = PIECE) -> DataFrame:
    """Trie of ``conversations`` (conv_id, turn, role, text), one row a node.

    With ``base_of`` and ``kept`` (expressions of ``conv``) a conversation's
    first ``kept`` turns, at most ``most``, are those of conversation
    ``base_of`` (all if it has fewer, none if it is absent) and its own go on
    after its first ``kept``.  A node is named by its smallest member and its
    depth; the root has depth 0.  Null role or text is empty, a null turn comes
    first, equal rows are turns each, rows without conv_id belong to no
    conversation and are left out; an empty table has no node.  Other columns
    are not read.
    """
    prepare(conversations.sparkSession)
    own = written(numbered(conversations), "op12-own")
    zero = F.lit(0).cast("long")
    rows, lengths = shared_starts(own, F.col("conv") if base_of is None else base_of, zero if kept is None else kept, most)
    return trie(written(prefixes(rows, lengths), "op12-paths"), piece)

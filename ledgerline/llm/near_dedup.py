"""Near-duplicate documents with an LSH forest.

MinHash signatures of word shingles are read in several orders (trees), each
starting at other positions.  In a tree, documents whose signatures share a
prefix form a region; a region with many documents is split by longer
prefixes (adaptive depth).  Candidates are neighbours of a region, links are
confirmed on full shingle sets, and components grow in rounds: a pair whose
ends are already connected is not compared.  Of large regions, documents with
too many shingles of their own have no link; those of the rest that stay
outside the largest component are at last compared with all of these.

Documents of equal shingle sets are one class from the start, so exact copies
cost one row per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U, lower_ascii, mix, pieces, prefix_hash, stretch_hash, text_buffer, word_hashes, word_spans
from .components import components
from .shared import prepare, unused, written

TREES, DEPTH, DEEPEST = 21, 3, 6
#: Regions up to this size are compared pair by pair; larger ones are split.
REGION = 24
#: Documents of a block when what large regions hide is compared.
BLOCK = 256
#: Shingles of a block that are compared at a time.
COLUMNS = 1 << 14
#: How often documents that can have no link are set aside before that.
LINKABLE_ROUNDS = 2
CHUNK_BYTES = 1 << 20
#: Documents without an id are numbered from here by the hash of their set.
NO_ID = 1 << 62
_SEEDS = mix(np.arange(1, 2 * TREES * DEPTH + 1, dtype=U) * U(0xC2B2AE3D27D4EB4F))


def shingle_sets(data: np.ndarray, bounds: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the documents of a buffer, sorted within
    each, and their ``n + 1`` offsets.  A document of fewer words is one
    shingle; one without words has none."""
    low = lower_ascii(data)
    starts, ends = word_spans(low, bounds)
    if not len(starts):
        return np.empty(0, U), np.zeros(len(bounds), np.int64)
    prefix = prefix_hash(word_hashes(low, starts, ends))
    first = np.searchsorted(starts, bounds)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    at = np.arange(len(starts))
    size = np.minimum(words, np.diff(first)[doc])
    own = at + size <= first[doc + 1]
    at, doc, size = at[own], doc[own], size[own]
    names = stretch_hash(prefix, at, at + size)
    order = np.lexsort((names, doc))
    names, doc = names[order], doc[order]
    fresh = np.ones(len(names), bool)
    fresh[1:] = (names[1:] != names[:-1]) | (doc[1:] != doc[:-1])
    names, doc = names[fresh], doc[fresh]
    return names, np.searchsorted(doc, np.arange(len(bounds)))


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """(node, text_key, n, h1, h2, sig): set size, two hashes of the set, its
    MinHashes.  ``docs``: id, text, text_key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        functions = TREES * DEPTH
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for a, b in pieces(offsets, CHUNK_BYTES):
                names, at = shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], words)
                size = np.diff(at)
                some = np.flatnonzero(size)
                sig = np.zeros((len(size), functions), np.uint32)
                h1, h2 = np.zeros(len(size), U), np.zeros(len(size), U)
                if len(some):
                    cut = at[some]
                    h1[some] = np.add.reduceat(mix(names), cut)
                    h2[some] = np.add.reduceat(mix(names + U(0x9FB21C651E98DF25)), cut)
                    for j in range(functions):
                        x = (names ^ _SEEDS[j]) * (_SEEDS[functions + j] | U(1))
                        x ^= x >> U(29)
                        x *= U(0xFF51AFD7ED558CCD)
                        sig[some, j] = np.minimum.reduceat((x >> U(32)).astype(np.uint32), cut)
                unnamed = pa.array((h1 >> U(2)).astype(np.int64) + NO_ID)
                yield pa.RecordBatch.from_arrays([
                    pa.compute.coalesce(batch.column(0).slice(a, b - a), unnamed), batch.column(2).slice(a, b - a),
                    pa.array(size.astype(np.int64)), pa.array(h1.view(np.int64)),
                    pa.array(h2.view(np.int64)), pa.array([s.tobytes() for s in sig], pa.binary())],
                    ["node", "text_key", "n", "h1", "h2", "sig"])

    return docs.mapInArrow(run, "node long, text_key long, n long, h1 long, h2 long, sig binary")


def tree_keys(reps: DataFrame, depth: int) -> DataFrame:
    """(key, above, node, n): the region of each document in each tree at a
    depth, and the one above that holds it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32).reshape(batch.num_rows, -1)
            for t in range(TREES):
                order = (np.arange(depth) + t * DEPTH) % (TREES * DEPTH)
                key = above = np.full(batch.num_rows, t + 1, U)
                for d in order:
                    above, key = key, mix(key * U(0x9E3779B97F4A7C15) + sig[:, d].astype(U))
                yield pa.RecordBatch.from_arrays([
                    pa.array(key.view(np.int64)), pa.array(above.view(np.int64)), batch.column(0), batch.column(1)],
                    ["key", "above", "node", "n"])

    return reps.select("node", "n", "sig").mapInArrow(run, "key long, above long, node long, n long")


def regions(keys: DataFrame, name: str) -> DataFrame:
    """Members of regions of two or more: keys with size and pivot (its smallest node)."""
    found = written(keys.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("pivot"),
                                            F.min(F.struct("node", "n")).alias("p"))
                    .where("size > 1").select("key", "size", "pivot", F.col("p.n").alias("pivot_n")), name + "-sizes")
    return written(keys.select("key", "node", "n").join(found, "key"), name)


def similar_sizes(a: str, b: str, percent: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links (a, b) among ``pairs``: percent * union <= 100 * intersection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = [np.frombuffer(x, U) for x in batch.column(2).to_pylist()]
            right = [np.frombuffer(x, U) for x in batch.column(3).to_pylist()]
            same = np.array([len(x) + len(y) - len(np.unique(np.concatenate((x, y)))) for x, y in zip(left, right)])
            size = np.array([len(x) + len(y) for x, y in zip(left, right)])
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(100 * same >= percent * (size - same))) for c in (batch.column(0), batch.column(1))],
                ["a", "b"])

    with_b = pairs.join(sets.select(F.col("node").alias("b"), F.col("names").alias("names_b")), "b")
    with_a = with_b.join(sets.select(F.col("node").alias("a"), F.col("names").alias("names_a")), "a")
    return with_a.select("a", "b", "names_a", "names_b").mapInArrow(run, "a long, b long")


def sets_of(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(node, names): full shingle sets of the ``nodes`` (node, id, text_key)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for a, b in pieces(offsets, CHUNK_BYTES):
                names, at = shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], words)
                raw = names.tobytes()
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a),
                    pa.array([raw[8 * x:8 * y] for x, y in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary())],
                    ["node", "names"])

    return docs.join(nodes, ["node", "text_key"]).select("node", "text").mapInArrow(run, "node long, names binary")


def _labelled(members: DataFrame, roots: DataFrame, node: str = "node", root: str = "root") -> DataFrame:
    own = roots.select(F.col("node").alias(node), F.col("root").alias(root))
    return members.join(own, node, "left").withColumn(root, F.coalesce(root, node))


def _cross_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of one region whose ends are not connected yet; regions are small."""
    a = members.select("key", F.col("node").alias("a"), F.col("n").alias("na"), F.col("root").alias("ra"))
    b = members.select("key", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("root").alias("rb"))
    return a.join(b, "key").where((F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb"))
                                  & similar_sizes("na", "nb", percent)).select("a", "b").distinct()


def _stars(members: DataFrame, percent: int) -> DataFrame:
    return members.where((F.col("node") != F.col("pivot")) & similar_sizes("n", "pivot_n", percent)).select(
        F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()


def _descend(reps: DataFrame, members: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of regions that hold more than one component: small
    regions pair by pair, large ones by their pivot and, split by one more
    signature value at a time, by their own regions."""
    pairs = None
    for depth in range(DEPTH, DEEPEST + 1):
        now = written(_labelled(members, roots), "labelled")
        mixed = now.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1"),
                                       F.min(F.struct("node", "root")).alias("p")).where("r0 <> r1")
        now = written(now.join(mixed.select("key", F.col("p.root").alias("pivot_root")), "key"), "mixed")
        large = now.where(F.col("size") > REGION)
        found = written(_cross_pairs(now.where(F.col("size") <= REGION), percent).unionByName(
            _stars(large.where("root <> pivot_root"), percent)), "pairs")
        pairs = found if pairs is None else pairs.unionByName(found)
        if depth == DEEPEST or large.isEmpty():
            break
        # the trees in which a document is in a large region go one value deeper
        wanted = large.select(F.col("key").alias("above"), "node")
        above = tree_keys(reps.join(wanted.select("node").distinct(), "node", "left_semi"), depth + 1)
        members = regions(written(above.join(wanted, ["node", "above"], "left_semi").select("key", "node", "n"), "keys"), "regions")
    return pairs.distinct()


def _clusters(members: DataFrame, roots: DataFrame, name: str) -> DataFrame:
    """(node, root, cluster) of documents that large regions chain together, of
    clusters with more than one component.  ``members``: key, node."""
    pivots = members.groupBy("key").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("c")).where("c > 1")
    cluster = components(members.join(pivots.select("key", "a"), "key").select("a", F.col("node").alias("b"))).select(
        "node", F.col("root").alias("cluster"))
    rows = written(_labelled(cluster, roots), name)
    mixed = rows.groupBy("cluster").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1")
    return rows.join(mixed.select("cluster"), "cluster")


def _linkable(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The nodes of ``rows`` that may have a link in their cluster.

    The shingles that two linked documents share make up ``percent`` of either,
    and each is held by two documents of the cluster; so one with too many
    shingles of its own has no link at all.  Work is linear in the sets."""

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cluster, node, raw in zip(*(c.to_pylist() for c in batch.columns)):
                names = np.frombuffer(raw, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(names), cluster)), pa.array(np.full(len(names), node)),
                                                  pa.array(names)], ["cluster", "node", "shingle"])

    held = rows.select("cluster", "node").join(sets, "node").select("cluster", "node", "names")
    own = held.select("cluster", "node", "names").mapInArrow(shingles, "cluster long, node long, shingle long")
    single = own.groupBy("cluster", "shingle").agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("node")).where("c = 1")
    alone = single.groupBy("node").agg(F.count(F.lit(1)).alias("alone"))
    size = held.select("node", (F.octet_length("names") / 8).cast("long").alias("n"))
    left = F.col("n") - F.coalesce("alone", F.lit(0))
    return size.join(alone, "node", "left").where(left * 100 >= F.col("n") * percent).select("node")


def _blocks(large: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that large regions still hide.  Documents that can have no link
    are set aside, twice, since what they shared then makes others stand alone;
    in each cluster of what is left, those outside its largest component are the
    queries, compared with all its documents, block by block."""
    members = large.select("key", "node")
    rows = _clusters(members, roots, "clusters")
    for i in range(LINKABLE_ROUNDS):
        members = written(members.join(_linkable(rows, sets, percent), "node", "left_semi").select("key", "node"), f"linkable-{i}")
        rows = _clusters(members, roots, f"clusters-{i}")
    rows = written(rows, "clusters")
    parts = rows.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("c"))
    whole = written(parts.groupBy("cluster").agg(
        F.max(F.struct("c", "root")).alias("m"), F.sum("c").alias("all")).select(
        "cluster", F.col("m.root").alias("main"), F.ceil(F.col("all") / BLOCK).alias("right"),
        F.ceil((F.col("all") - F.col("m.c")) / BLOCK).alias("left")), "cluster-sizes")
    rows = rows.join(whole, "cluster")
    own = F.xxhash64("node")
    queries = rows.where("root <> main").select(
        "node", "root", "cluster", F.pmod(own, "left").alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("right") - 1)).alias("j"))
    others = rows.select(
        "node", "root", "cluster", F.explode(F.sequence(F.lit(0).cast("long"), F.col("left") - 1)).alias("i"), F.pmod(own, "right").alias("j"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        x = [np.frombuffer(v, U) for v in left.column("names").to_pylist()]
        y = [np.frombuffer(v, U) for v in right.column("names").to_pylist()]
        if not x or not y:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        sizes = np.array([len(v) for v in (*x, *y)])
        # a shingle that one document has cannot be shared
        names, of, seen = np.unique(np.concatenate((*x, *y)), return_inverse=True, return_counts=True)
        shared = seen > 1
        column = np.cumsum(shared) - 1
        row, keep = np.repeat(np.arange(len(sizes)), sizes), shared[of]
        row, column = row[keep], column[of[keep]]
        same = np.zeros((len(x), len(y)), np.int64)
        for low in range(0, int(shared.sum()), COLUMNS):  # so many shingles at a time, however long the documents
            part = (column >= low) & (column < low + COLUMNS)
            grams = np.zeros((len(sizes), COLUMNS), np.float32)
            grams[row[part], column[part] - low] = 1
            same += np.rint(grams[:len(x)] @ grams[len(x):].T).astype(np.int64)
        union = sizes[:len(x), None] + sizes[None, len(x):] - same
        roots_x, roots_y = left.column("root").to_numpy(), right.column("root").to_numpy()
        i, j = np.nonzero((100 * same >= percent * union) & (roots_x[:, None] != roots_y[None, :]))
        return pa.table({"a": pa.array(left.column("node").to_numpy()[i]), "b": pa.array(right.column("node").to_numpy()[j])})

    by = ["cluster", "i", "j"]
    renamed = lambda df: df.select(*[F.col(c).alias(c) for c in df.columns])  # noqa: E731  both sides stem from one table
    return (renamed(queries.join(sets, "node")).groupBy(*by).cogroup(renamed(others.join(sets, "node")).groupBy(*by))
            .applyInArrow(run, "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                    percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document.

    Documents are linked when their sets of distinct ``words``-word shingles
    (A-Z lower-cased) have a Jaccard similarity of ``percent`` or more;
    component_id is the smallest doc_id reachable, kept marks it.

    A document with fewer words is one shingle; without words (or with a null
    text) it has none, is linked with nothing and kept.  Rows of one id are
    one document.  Documents without an id are told apart by their sets and
    rank last, so their component_id is null where they reach no other.
    Repeated rows give a row each.  An empty table gives an empty result.
    Other columns of ``docs`` are not read.  text_key (a hash of the text)
    and group (the component's internal number) identify rows for callers.
    """
    spark = docs.sparkSession
    prepare(spark)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    source = source.withColumn("text_key", F.xxhash64("text"))
    sigs = written(signatures(source, words), "signatures")
    some = sigs.where("n > 0")
    classes = written(some.groupBy("h1", "h2").agg(F.min(F.struct("node", "n", "text_key", "sig")).alias("r"))
                      .select("h1", "h2", "r.*"), "classes")
    # one set per node, though rows of one id may hold several
    reps = classes.groupBy("node").agg(F.min(F.struct("n", "text_key", "sig")).alias("r")).select("node", "r.*")
    members = regions(tree_keys(reps, DEPTH), "regions")
    wanted = members.select("node").distinct().join(reps.select("node", "text_key"), "node")
    # rows of one id and text are read once; documents without an id are found by their text
    texts = source.select(F.col("id").alias("node"), "text_key", "text")
    named = sets_of(texts.where("node is not null"), wanted.where(F.col("node") < NO_ID), words)
    unnamed = sets_of(texts.where("node is null").drop("node").join(
        wanted.where(F.col("node") >= NO_ID).withColumnRenamed("text_key", "key"), F.col("text_key") == F.col("key")
    ).select("node", "text_key", "text"), wanted.where(F.col("node") >= NO_ID), words)
    sets = written(named.unionByName(unnamed).groupBy("node").agg(F.min("names").alias("names")), "sets", "none")

    # 1. each document with the smallest pivot of its regions
    nearest = _stars(members, percent).groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = written(confirmed(nearest, sets, percent), "confirmed")
    roots = components(links)
    # 2. regions with more than one component, by longer and longer prefixes
    links = links.unionByName(written(confirmed(_descend(reps, members, roots, percent), sets, percent), "confirmed"))
    roots = components(links)
    # 3. what is left of the large regions
    large = members.where(F.col("size") > REGION)
    links = links.unionByName(written(_blocks(large, roots, sets, percent), "confirmed"))
    roots = components(links)

    by_class = written(classes.select("node", "h1", "h2").join(roots, "node", "left").select(
        "h1", "h2", F.coalesce("root", "node").alias("root")), "class-roots")
    joined = some.select("node", "text_key", "n", "h1", "h2").join(by_class, ["h1", "h2"]).select(
        "node", "text_key", "n", "root").unionByName(
        sigs.where("n = 0").select("node", "text_key", "n", F.col("node").alias("root")))
    return joined.select(
        F.when(F.col("node") < NO_ID, F.col("node")).alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("root") < NO_ID, F.col("root")).alias("component_id"), (F.col("node") == F.col("root")).alias("kept"),
        "text_key", F.col("root").alias("group"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                    percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component; documents without words
    (null texts too) stay.  All columns are kept, whatever their names; of a
    component the row with the smallest text hash stays, repeated rows of it
    once; rows without an id stand for themselves; an empty table gives an
    empty one."""
    found = near_duplicates(docs, id_col, text_col, words, percent).where("kept")
    one = found.where("n_shingles > 0").groupBy("group").agg(F.min(F.struct("text_key", "doc_id")).alias("r")).select("r.*")
    one = one.unionByName(found.where("n_shingles = 0").select("text_key", "doc_id").distinct())
    key, id_, own = unused(docs.columns, "_key", "_id", "_text_key")
    one = one.select(F.col("text_key").alias(key), F.col("doc_id").alias(id_))
    keyed = docs.withColumn(own, F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    kept = keyed.join(one, (F.col(own) == F.col(key)) & F.col(id_col).eqNullSafe(F.col(id_)))
    return kept.dropDuplicates([own, id_col]).select(*docs.columns)

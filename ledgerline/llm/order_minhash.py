"""Document fingerprints by Order MinHash, DataFrame functions only.

K-mers of words are numbered by occurrence, so a repeated k-mer counts each
time.  One hash deals the numbered k-mers into bins and orders each bin; the
``PICK`` smallest of a bin, put back into text order, are hashed as a tuple.
Equal tuples need equal k-mers in equal order, so the share of equal tuples
falls with the edit distance, also when words merely move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import prepare, written

KMER, BIN_BITS, PICK = 3, 5, 2
WORD_GAP = r"[\x20\x09-\x0D]+"
#: Documents of one bucket of the id order, on average.
BUCKET_DOCS = 2000
#: At most so many ranges of ids (and as many of rows without one): the first
#: row of each goes to all tasks.
MOST_BUCKETS = 1 << 14


def _bin(u: Column) -> Column:
    return F.shiftrightunsigned(u, 64 - BIN_BITS)


def fingerprint(df: DataFrame, text: str, out: str, kmer: int = KMER) -> DataFrame:
    """``df`` with ``out``: array of (bin, hash), at most one per bin, in bin order.

    No words give an empty array; fewer words than ``kmer`` are one k-mer."""
    keep = df.columns
    words = F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), WORD_GAP), "")
    d = df.select(*keep, F.transform(words, lambda w: F.xxhash64(w)).alias("_names"))
    whole = F.when(F.size("_names") > 0, F.array(F.xxhash64("_names"))).otherwise(F.array().cast("array<bigint>"))
    run = F.transform(F.slice("_names", F.lit(1), F.greatest(F.size("_names") - (kmer - 1), F.lit(0))),
                      lambda h, i: F.xxhash64(h, *[F.get("_names", i + k) for k in range(1, kmer)]))
    d = d.select(*keep, F.when(F.size("_names") < kmer, whole).otherwise(run).alias("_kmers"))
    d = d.withColumn("_placed", F.when(
        F.size(F.array_distinct("_kmers")) < F.size("_kmers"),
        F.array_sort(F.transform("_kmers", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))))
    # equal k-mers stand together in text order: the occurrence number is the distance to the first,
    # found by halving steps
    steps = F.array(*[F.lit(1 << k) for k in range(24, -1, -1)])
    same = lambda x, i: F.get(F.col("_placed"), i)["h"] == x["h"]
    number = lambda x, i: F.when(
        F.coalesce(same(x, i - 1), F.lit(False)),
        F.aggregate(steps, F.lit(0), lambda acc, p: F.when(
            F.coalesce(same(x, i - acc - p), F.lit(False)), acc + p).otherwise(acc))).otherwise(F.lit(0))
    numbered = F.transform("_placed", lambda x, i: F.struct(F.xxhash64(x["h"], number(x, i)).alias("u"), x["at"].alias("at")))
    plain = F.transform("_kmers", lambda h, i: F.struct(F.xxhash64(h, F.lit(0)).alias("u"), i.alias("at")))
    d = d.withColumn("_items", F.array_sort(F.when(F.col("_placed").isNull(), plain).otherwise(numbered)))
    d = d.select(*keep, F.filter("_items", lambda x, i: (i < PICK) | (
        _bin(F.get(F.col("_items"), i - PICK)["u"]) != _bin(x["u"]))).alias("_low"))
    return d.select(*keep, _tuples().alias(out))


def _tuples() -> Column:
    """Hash of each bin's picked k-mers in text order."""
    low = F.col("_low")

    def of(x: Column, i: Column) -> Column:
        after = F.get(low, i + 1)
        paired = F.coalesce(_bin(after["u"]) == _bin(x["u"]), F.lit(False))
        pair = F.when(~paired, F.xxhash64(x["u"])).when(x["at"] < after["at"], F.xxhash64(x["u"], after["u"])).otherwise(
            F.xxhash64(after["u"], x["u"]))
        first = F.coalesce(_bin(F.get(low, i - 1)["u"]) != _bin(x["u"]), F.lit(True))
        return F.struct(first.alias("first"), _bin(x["u"]).cast("int").alias("bin"), pair.alias("hash"))

    return F.transform(F.filter(F.transform("_low", of), lambda t: t["first"]),
                       lambda t: F.struct(t["bin"].alias("bin"), t["hash"].alias("hash")))


def likeness(a: str, b: str) -> Column:
    """Share of equal tuples among the bins that either fingerprint has; 1 if both are empty."""
    bins = F.size(F.array_union(F.transform(a, lambda t: t["bin"]), F.transform(b, lambda t: t["bin"])))
    return F.when(bins == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(bins, F.lit(1)))


def as_text(c: str) -> Column:
    return F.array_join(F.transform(c, lambda t: F.concat(F.lpad(F.hex(t["bin"]), 2, "0"), F.lpad(F.hex(t["hash"]), 16, "0"))), "")


def _range_edges(docs: DataFrame, buckets: int) -> list[int]:
    """Ids that cut the documents into about equal shares: quantiles, so that
    an id far from the others moves none of them."""
    if buckets < 2:
        return []
    shares = [i / buckets for i in range(1, buckets)]
    found = docs.agg(F.percentile_approx("id", shares, 10 * buckets)).first()[0]
    return sorted(set(found or []))


def _range_of(edges: list[int]) -> Column:
    """Number of edges that are smaller than the id, found by halving steps;
    descending, so that range 0 holds the largest ids."""
    if not edges:
        return F.lit(0).cast("long")
    table = F.split(F.lit(",".join(map(str, edges))), ",").cast("array<bigint>")
    steps = [1 << k for k in range(len(edges).bit_length() - 1, -1, -1)]
    below = F.aggregate(F.array(*[F.lit(k) for k in steps]), F.lit(0), lambda acc, p: F.when(
        F.coalesce(F.get(table, acc + p - 1) < F.col("id"), F.lit(False)), acc + p).otherwise(acc))
    return (F.lit(len(edges)) - below).cast("long")


def with_next(docs: DataFrame) -> DataFrame:
    """``docs`` (id, text) with print, next_text and next_print: fingerprints,
    and the following row in descending order of id (after the last: the first).

    Ids are dealt into ranges of about equal count, so one pass over the texts
    orders each range; only the first row of every range crosses ranges, found
    by id and text hash, and only those rows are fingerprinted again."""
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    n, none = docs.agg(F.count(F.lit(1)), F.count_if(F.col("id").isNull())).first()
    buckets = min(MOST_BUCKETS, max(1, -(-(n - none) // BUCKET_DOCS)))
    spare = min(MOST_BUCKETS, max(1, -(-none // BUCKET_DOCS)))
    edges = _range_edges(docs, buckets)
    place = F.when(F.col("id").isNotNull(), _range_of(edges)).otherwise(
        F.lit(len(edges) + 1) + F.pmod(F.col("key"), F.lit(spare)))
    plain = docs.withColumn("key", key).withColumn("bucket", place)
    rows = fingerprint(plain, "text", "print")
    order = Window.partitionBy("bucket").orderBy(F.col("id").desc_nulls_last(), "key")
    nxt = lambda c: F.lead(c).over(order)
    ranked = rows.select("id", "text", "print", "bucket", nxt("text").alias("next_text"), nxt("print").alias("next_print"),
                         F.lead(F.lit(1)).over(order).isNull().alias("last"))
    firsts = plain.select("bucket", "id", "key").groupBy("bucket").agg(
        F.min(F.struct(F.col("id").isNull().alias("null"), (-F.col("id")).alias("down"), "key")).alias("f"))
    chain = Window.orderBy("bucket")  # one row a range, at most 2 * MOST_BUCKETS
    around = chain.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = F.broadcast(written(firsts.select(
        "bucket", (-F.col("f.down")).alias("id"), F.col("f.key").alias("key"),
        F.coalesce(F.lag("bucket").over(chain), F.last("bucket").over(around)).alias("before")), "range-firsts"))
    heads = plain.alias("r").join(
        firsts.alias("f"), (F.col("r.bucket") == F.col("f.bucket")) & F.col("r.id").eqNullSafe(F.col("f.id"))
        & (F.col("r.key") == F.col("f.key"))).select(F.col("f.before").alias("bucket"), F.col("r.text").alias("head_text"))
    heads = written(heads.groupBy("bucket").agg(F.min("head_text").alias("head_text")), "range-heads")
    joined = ranked.join(fingerprint(heads, "head_text", "head_print"), "bucket", "left")
    return joined.select("id", "text", "print",
                         F.when(F.col("last"), F.col("head_text")).otherwise(F.col("next_text")).alias("next_text"),
                         F.when(F.col("last"), F.col("head_print")).otherwise(F.col("next_print")).alias("next_print"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, text, edited, next_text, print, edited_print, next_print) of each document.

    edited: the text with its last third replaced by as many first code
    points of the next document in descending order of id.  A null text is
    empty, and empty texts have an empty fingerprint; documents without an id
    come last, ties and repeated rows in the order of their text's hash; a
    single document is its own next; an empty table gives an empty result.
    Other columns of ``docs`` are not read.
    """
    prepare(docs.sparkSession)
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    d = with_next(own)
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    d = d.withColumn("n_chars", n.cast("long")).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third)))
    return fingerprint(d, "edited", "edited_print").withColumnRenamed("id", id_col)

"""Target-distribution importance resampling over hashed n-grams.

Every task interns the n-grams of a batch of texts in an open-addressed table
(``ngram_table``); a slot holds the n-gram's bucket and its count, so the CRC
is taken once per distinct n-gram of a batch.  Bucket counts of corpus and
target are added up over all texts, each bucket's gain is the log of how much
likelier the target uses it, and in a second pass the occurrences' slot ids
gather the gains.  Adding seeded Gumbel noise to the mean gain and drawing the
highest scores samples without replacement by importance.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import pieces, text_buffer
from .ngram_table import Bytes, intern
from .plain_words import normalised
from .shared import prepare, written

BUCKETS = 10_000
LONGEST = 2
LEAST_WORDS = 20
SHARE = 25
SEED = 7
#: Texts are interned in batches of about so many bytes, whose table stays in a core's cache.
CHUNK_BYTES = 1 << 18


def _features(data: np.ndarray, bounds: np.ndarray, longest: int):
    """The buffer, starts and sizes of all runs of 1 to ``longest`` words, the
    text of each run, and the words of each text."""
    buffer, starts, ends, begins = normalised(data, bounds)
    n_words = np.diff(begins)
    text = np.repeat(np.arange(len(n_words)), n_words)
    last = begins[1:][text]  # word after the text's last
    at, size, of = [], [], []
    for run in range(1, longest + 1):
        i = np.flatnonzero(np.arange(len(starts)) + run <= last)
        at.append(starts[i])
        size.append(ends[i + run - 1] - starts[i])
        of.append(text[i])
    return Bytes(buffer), np.concatenate(at), np.concatenate(size), np.concatenate(of), n_words


def _slots(data: np.ndarray, bounds: np.ndarray, longest: int, buckets: int):
    """Slot of each occurrence, its text, bucket and count of each slot, words of each text."""
    raw, start, size, of, n_words = _features(data, bounds, longest)
    slot, owner = intern(raw, start, size)
    bucket, count = np.zeros(len(owner), np.int64), np.bincount(slot, minlength=len(owner))
    used = np.flatnonzero(owner >= 0)
    first = owner[used]
    bucket[used] = raw.crc32(start[first], size[first]) % np.uint32(buckets)
    return slot, of, bucket, count, n_words


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """(bucket, n): occurrences of all n-grams of all texts; a task hands on one row a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            data, offsets = text_buffer(batch.column(0))
            for first, last in pieces(offsets, CHUNK_BYTES):
                base = offsets[first]
                _, _, bucket, count, _ = _slots(data[base:offsets[last]], offsets[first:last + 1] - base, longest, buckets)
                np.add.at(total, bucket, count)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    counts = texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def _dense(counts: DataFrame, buckets: int) -> list[int]:
    out = [0] * buckets
    for r in counts.collect():  # at most one row a bucket
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(corpus: list[int], target: list[int]) -> np.ndarray:
    """floor(1000 * ln of the smoothed frequency in the target over that in the corpus)."""
    n, all_s, all_t = len(corpus), sum(corpus), sum(target)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (all_s + n) / ((s + 1.0) * (all_t + n))))
                     for s, t in zip(corpus, target)], np.int64)


def noise(seed: int, key: str) -> int:
    """1000 times a Gumbel variate that the seed and the id decide, floored."""
    h = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296.0)))


def scores(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST,
           seed: int = SEED) -> DataFrame:
    """(id, n_words, n_features, weight, score) of each row of ``docs``."""
    buckets = len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(2))
            keys = batch.column(1).fill_null("").to_pylist()
            for first, last in pieces(offsets, CHUNK_BYTES):
                base = offsets[first]
                slot, of, bucket, _, n_words = _slots(data[base:offsets[last]], offsets[first:last + 1] - base, longest, buckets)
                gain = gains[bucket]  # one gain a slot
                total = np.zeros(last - first, np.int64)
                np.add.at(total, of, gain[slot])
                n = np.bincount(of, minlength=last - first)
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                drawn = weight + np.array([noise(seed, k) for k in keys[first:last]], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first)] + [pa.array(x) for x in (n_words, n, weight, drawn)],
                    [id_col, "n_words", "n_features", "weight", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), F.col(id_col).cast("string").alias("key"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"{id_col} {kind}, n_words long, n_features long, weight long, score long")


def drawn(scored: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS, id_col: str = "doc_id") -> DataFrame:
    """``scored`` with rank: 1, 2, 3 ... for the floor(share * N / 100) highest
    scores of the N documents with enough words, null for the others.

    Ranks are counted in ranges of the order, so no task holds all rows; one
    row a range goes through the driver."""
    able = scored.filter(F.col("n_words") >= least_words)
    order = [F.col("score").desc(), F.col(id_col).asc_nulls_last(), F.col("weight").desc(), F.col("n_features").desc()]
    dealt = written(able.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "op11-ranges")
    sizes = sorted((r["_range"], r["count"]) for r in dealt.groupBy("_range").count().collect())
    n = sum(c for _, c in sizes)
    before, starts = 0, []
    for part, c in sizes:
        starts.append((part, before))
        before += c
    limit = share * n // 100
    offsets = dealt.sparkSession.createDataFrame(starts, "_range int, _before long")  # one row a range
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) + F.col("_before")
    ranked = dealt.join(F.broadcast(offsets), "_range").withColumn("rank", place.cast("long"))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= limit, F.col("rank"))).drop("_range", "_before")
    rest = scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             share: int = SHARE, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, longest: int = LONGEST,
             seed: int = SEED) -> DataFrame:
    """Draw ``share`` percent of ``docs`` towards the texts of ``target``.

    Per row: id, n_words, n_features (occurrences of runs of 1 to ``longest``
    words), weight (floored mean gain), score (weight plus noise) and rank
    (null: not drawn; ties go to the smaller id, a null id last, whose noise is
    that of an empty id).  A null or empty text has no features and weight 0;
    repeated rows are scored and ranked each, as ties; an empty target makes
    every bucket equally likely there; an empty table gives an empty result.
    Other columns are not read.
    """
    prepare(docs.sparkSession)
    corpus = _dense(bucket_counts(docs, text_col, buckets, longest), buckets)
    wanted = _dense(bucket_counts(target, target_col, buckets, longest), buckets)
    scored = written(scores(docs, bucket_gains(corpus, wanted), id_col, text_col, longest, seed), "op11-scores")
    return drawn(scored, share, least_words, id_col)

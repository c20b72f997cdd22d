"""Quality rules with cross-document line frequency, DataFrame functions only.

Lines are normalised and hashed; per host, the distinct documents that hold a
line are counted.  Lines above the host's limit are boilerplate: they go, and
documents of which too little is left are rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import prepare, unused, written

WORD_GAP = r"[\x20\x09-\x0D]+"
HAS_WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

#: Fixed values of the base rules.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: A line is boilerplate when more than this percentage of a host's distinct
#: texts hold it, and at least this many.
MAX_LINE_PERCENT, MIN_DOCUMENTS = 5, 3
#: A document is depleted when less of its words is left (percent).
MIN_LEFT_PERCENT = 30


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_GAP), "")


def _repeat_words(shingles: Column) -> Column:
    """Words in 3-word windows that occur twice or more, from the window hashes.

    Windows sorted by hash stand beside their equals; the marked windows in
    text order then add three words each, less what the one before covers."""
    placed = F.array_sort(F.transform(shingles, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    repeated = F.transform(
        F.filter(
            F.transform(F.col("placed"), lambda x, i: F.struct(
                x["at"].alias("at"),
                ((x["h"] == F.get(F.col("placed"), i - 1)["h"]) | (x["h"] == F.get(F.col("placed"), i + 1)["h"])).alias("twice"))),
            lambda x: x["twice"]),
        lambda x: x["at"])
    return placed, F.array_sort(repeated)


def base_columns(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words (all long) and base_failed, and without ``text``."""
    keep = [c for c in docs.columns if c != text]
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(HAS_WORD))
    d = docs.select(
        *keep, words_of(t).alias("words"), lines.alias("lines"),
        (F.char_length(t) - F.char_length(F.regexp_replace(t, SYMBOLS, ""))).cast("long").alias("n_symbols"))
    d = d.select(
        *keep, F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"), "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("names"))
    shingle = F.transform(F.slice("names", F.lit(1), F.greatest(F.size("names") - 2, F.lit(0))),
                          lambda h, i: F.xxhash64(h, F.get("names", i + 1), F.get("names", i + 2)))
    d = d.withColumn("shingles", shingle)
    twice = F.size(F.array_distinct("shingles")) < F.size("shingles")
    placed, repeated = _repeat_words(F.col("shingles"))
    d = d.withColumn("placed", F.when(twice, placed))
    d = d.withColumn("at", F.when(F.col("placed").isNotNull(), repeated))
    covered = F.aggregate(
        F.col("at"), F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda acc, x: F.struct(x.alias("last"), (acc["n"] + F.least(x - acc["last"], F.lit(3))).alias("n")))
    d = d.withColumn("n_repeat_words", F.coalesce(covered["n"], F.lit(0)).cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return d.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    failed.alias("base_failed"))


def lines_of(text: Column) -> Column:
    """Normalised lines: numbers as 0, white space as one space, ends trimmed."""
    plain = F.regexp_replace(F.regexp_replace(text, "[0-9]+", "0"), r"[\x20\x09\x0B-\x0D]+", " ")
    return F.transform(F.split(plain, "\n", -1), lambda x: F.trim(x))


def boilerplate(docs: DataFrame, host: str, percent: int = MAX_LINE_PERCENT, documents: int | None = None) -> DataFrame:
    """(id, text_key, line, line_words): the lines of each document that too
    many documents of its host hold: over ``percent`` of them, or ``documents``
    of them however large the host.  ``docs``: id, text, host."""
    t = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "id", F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), F.xxhash64(t).alias("text_key"),
        F.posexplode(F.transform(lines_of(t), lambda x: F.struct(
            F.xxhash64(x).alias("hash"),
            (F.char_length(x) - F.char_length(F.replace(x, F.lit(" "), F.lit(""))) + 1).alias("words"),
            (x != "").alias("some")))).alias("line", "x"))
    rows = rows.where("x.some").select("id", "host", "text_key", "line", F.col("x.hash").alias("hash"),
                                       F.col("x.words").cast("long").alias("line_words"))
    held = (rows.groupBy("host", "hash", "text_key").agg(F.lit(1).alias("one"))
            .groupBy("host", "hash").agg(F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= MIN_DOCUMENTS))
    hosts = (docs.select(F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), F.xxhash64(t).alias("text_key"))
             .groupBy("host", "text_key").agg(F.lit(1).alias("one"))
             .groupBy("host").agg(F.count(F.lit(1)).alias("host_texts")))
    over = F.col("texts") * 100 > F.col("host_texts") * percent
    if documents is not None:
        over |= F.col("texts") >= documents
    common = held.join(hosts, "host").where(over).select("host", "hash")
    # one row per line of a text: repeated rows of a document count once
    return (rows.join(common, ["host", "hash"], "left_semi")
            .groupBy("id", "text_key", "line").agg(F.max("line_words").alias("line_words")))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          percent: int = MAX_LINE_PERCENT, documents: int | None = None) -> DataFrame:
    """Per document: id, the base columns, boilerplate_words, lines_removed
    (their places) and kept.

    kept is false if the base rules fail or if less than
    ``MIN_LEFT_PERCENT`` of the words are outside boilerplate lines (limits
    ``percent`` and ``documents``, see ``boilerplate``).
    Documents of equal text count once for a line's frequency, so copies do
    not turn a text into boilerplate.  A null text is empty (no words, base
    fails); null hosts are one host; null and repeated ids give a row per
    input row; an empty table gives an empty result.  Other columns of
    ``docs`` are not read.
    """
    prepare(docs.sparkSession)
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(host_col).alias("host"))
    gone = (boilerplate(own, "host", percent, documents).groupBy("id", "text_key").agg(
        F.sum("line_words").alias("boilerplate_words"), F.array_sort(F.collect_list("line")).alias("lines_removed"))
        .select(F.col("id").alias("gone_id"), F.col("text_key").alias("gone_key"), "boilerplate_words", "lines_removed"))
    base = base_columns(own.select(
        "id", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_key"), "text"))
    judged = base.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("text_key") == F.col("gone_key")), "left")
    words = F.coalesce("boilerplate_words", F.lit(0)).cast("long")
    depleted = (F.col("n_words") - words) * 100 < F.col("n_words") * MIN_LEFT_PERCENT
    return judged.select(
        F.col("id").alias(id_col), "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", words.alias("boilerplate_words"), "lines_removed",
        (~F.col("base_failed") & ~depleted).alias("kept"))


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          percent: int = MAX_LINE_PERCENT, documents: int | None = None) -> DataFrame:
    """``docs`` without the rejected documents (``judge``) and without
    boilerplate lines, all columns kept, whatever their names (``n_chars``,
    where present, follows the text).

    Null and empty texts fail the base rules and go; null ids and hosts are
    treated as in ``judge``; repeated rows stay repeated; ties do not matter, as
    a line's verdict holds for all documents of the host; an empty table gives
    an empty one."""
    prepare(docs.sparkSession)
    key, gone, id_ = unused(docs.columns, "_key", "_gone", "_id")
    # written: a filter on the verdict would otherwise be pushed into the rules and evaluate them over and over
    verdict = written(judge(docs, id_col, text_col, host_col, percent, documents).select(
        F.col(id_col).alias(id_), F.col("text_key").alias(key), F.col("lines_removed").alias(gone), F.col("kept").alias("is_kept")), "verdict")
    verdict = verdict.where("is_kept").drop("is_kept").dropDuplicates([id_, key])
    t = F.coalesce(F.col(text_col), F.lit(""))
    left = F.array_join(F.filter(F.split(t, "\n", -1), lambda x, i: ~F.array_contains(gone, i)), "\n")
    kept = docs.join(verdict, F.col(id_col).eqNullSafe(F.col(id_)) & (F.xxhash64(t) == F.col(key)))
    kept = kept.withColumn(text_col, F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(left))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length(text_col).cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)

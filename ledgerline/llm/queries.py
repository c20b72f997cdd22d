"""Registered queries of the subpackage and their DuckDB SQL.

Each ``opN_<name>`` applies operator N with production parameters to its whole
table and derives the digest columns from the operator's outputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import (chat, html_text, importance, language, license_scan, near_dedup, order_minhash, packing, prefix_trie, quality,
               sentence_bpe)
from .suffix_dedup import remove_repeats
from .substring_dedup import remove_repeated_words

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn=None, *, sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add(fn) if fn else add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OP1_SQL = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
b AS (SELECT doc_id, n, unnest(range(0, n)) AS p, h FROM d),
k AS (SELECT doc_id, p, substr(h, 2 * p + 1, 2) AS x,
             CASE WHEN p + 100 <= n THEN md5(substr(h, 2 * p + 1, 200)) END AS w FROM b),
r AS (SELECT doc_id, p, x,
             w IS NOT NULL AND row_number() OVER (PARTITION BY w ORDER BY doc_id, p) > 1 AS again FROM k),
c AS (SELECT doc_id, p, x, bool_or(again) OVER (PARTITION BY doc_id ORDER BY p
             ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone FROM r),
s AS (SELECT doc_id, p, x, gone, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS head
      FROM c),
a AS (SELECT doc_id, CAST(count_if(gone) AS BIGINT) AS n_removed, CAST(count_if(head) AS BIGINT) AS n_spans,
             string_agg(x, '' ORDER BY p) FILTER (WHERE NOT gone) AS kept FROM s GROUP BY doc_id)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, coalesce(a.n_removed, 0) AS n_removed,
       coalesce(a.n_spans, 0) AS n_spans, sha256(unhex(coalesce(a.kept, ''))) AS kept_sha256
FROM d LEFT JOIN a USING (doc_id)
"""

OP2_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, w FROM d),
k AS (SELECT doc_id, i, w[i] AS x, CASE WHEN i + 12 <= len(w) THEN array_to_string(w[i:i + 12], ' ') END AS v FROM p),
r AS (SELECT doc_id, i, x, v IS NOT NULL AND min(doc_id) OVER (PARTITION BY v) < doc_id AS again FROM k),
c AS (SELECT doc_id, i, x, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i
             ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone FROM r),
a AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n_words, CAST(count_if(gone) AS BIGINT) AS n_removed,
             string_agg(x, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM c GROUP BY doc_id)
SELECT d.doc_id, coalesce(a.n_words, 0) AS n_words, coalesce(a.n_removed, 0) AS n_removed,
       sha256(coalesce(a.kept, '')) AS kept_sha256
FROM d LEFT JOIN a USING (doc_id)
"""


@query(sql=OP1_SQL)
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query(sql=OP2_SQL)
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_words(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP3_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, length(replace(replace(replace(replace(role, '\', '\\'), '<', '\l'), '#', '\h'), ':', '\c'))
              + length(replace(replace(replace(replace(text, '\', '\\'), '<', '\l'), '#', '\h'), ':', '\c'))
              + length('### ') + length(': ') + length(' </turn>') + 1 AS size FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


def conversation_events(conversations: DataFrame) -> DataFrame:
    """A log whose fold is the conversations.  Texts come in three parts; by turn
    a message is streamed plainly, or starts as a wrong draft that an edit
    replaces, or is regenerated after a wrong continuation and an early answer
    to it.  Rows are in no order of their sequence numbers."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "message", F.row_number().over(w))
    third = F.floor(F.char_length("text") / 3).cast("int")
    a, b, c = (F.substring(F.col("text"), start, size) for start, size in (
        (F.lit(1), third), (third + 1, third), (2 * third + 1, F.char_length("text"))))
    event = lambda seq, kind, text, later=0: F.struct(
        F.lit(seq).alias("at"), F.lit(kind).alias("kind"), F.lit(later).alias("later"), text.alias("text"))
    rest = [event(9, chat.DELTA, c), event(8, chat.DELTA, b)]
    plain = F.array(*rest, event(1, chat.MESSAGE, a))
    edited = F.array(event(3, chat.EDIT, a), *rest, event(1, chat.MESSAGE, F.concat(F.lit("no, "), c)))
    again = F.array(*rest, event(4, chat.DELTA, F.lit(" early"), 1), event(2, chat.DELTA, F.lit("wrong")), event(1, chat.MESSAGE, c),
                    event(6, chat.REGENERATE, a), event(3, chat.MESSAGE, F.lit("too"), 1))
    way = F.pmod(F.col("message") + F.coalesce("conv_id", F.lit(0)), F.lit(3))
    log = rows.select("conv_id", "message", "role", F.explode(F.when(way == 0, plain).when(way == 1, edited).otherwise(again)).alias("e"))
    return log.select("conv_id", (F.col("message") * 16 + F.col("e.at")).alias("seq"), "e.kind",
                      (F.col("message") + F.col("e.later")).alias("message"), "role", "e.text")


@query(sql=OP3_SQL)
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    formatted = chat.render(chat.fold_events(conversation_events(rows.unionByName(extra))))
    back = chat.read_back(formatted)
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    lost = F.array_join("losses", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length(lost).cast("long").alias("loss_chars"), F.sha2(lost, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


@query
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ids = sentence_bpe.encode(docs).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), "ids", F.size("ids").cast("long").alias("n_ids"),
        F.xxhash64("ids").alias("ids_hash"))
    back = sentence_bpe.decode(ids, keep=("doc_id", "text", "n_ids", "ids_hash"))
    return back.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), "n_ids", "ids_hash",
        F.sha2("decoded", 256).alias("decoded_sha256"), (F.col("decoded") == F.col("text")).alias("lossless"))


@query
def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = order_minhash.fingerprints(table(spark, sf_dir, "documents"))
    return d.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        order_minhash.as_text("print").alias("fingerprint"), order_minhash.as_text("edited_print").alias("edited_fingerprint"),
        order_minhash.likeness("print", "edited_print").alias("near_edited"),
        order_minhash.likeness("print", "next_print").alias("near_next"))


OP6_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, greatest(len(w), 2))) AS i, w FROM d WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS x FROM p),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
t AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id),
k AS (SELECT a, b FROM t JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM k UNION SELECT b, a FROM k),
r AS (SELECT a AS node, b AS other FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.other = e.a),
g AS (SELECT node, least(node, min(other)) AS component FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(g.component, d.doc_id) AS component_id,
       coalesce(g.component, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN g ON g.node = d.doc_id
"""


@query(sql=OP6_SQL)
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=2).drop("text_key", "group")


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS host,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
dl AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM l
       WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
p AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, w FROM d),
k AS (SELECT doc_id, i, CASE WHEN i + 2 <= len(w) THEN w[i:i + 2] END AS s FROM p),
r AS (SELECT doc_id, i, s IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, s) > 1 AS again FROM k),
c AS (SELECT doc_id, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS hit FROM r),
rw AS (SELECT doc_id, count_if(hit) AS n_repeat_words FROM c GROUP BY doc_id),
nl AS (SELECT doc_id, host, t, trim(x) AS line FROM (
         SELECT doc_id, host, t, unnest(string_split(regexp_replace(regexp_replace(t, '[0-9]+', '0', 'g'),
                '[\x20\x09\x0B-\x0D]+', ' ', 'g'), chr(10))) AS x FROM d)),
h AS (SELECT host, count(DISTINCT t) AS host_texts FROM d GROUP BY host),
f AS (SELECT host, line FROM nl JOIN h USING (host) WHERE line <> '' GROUP BY host, line, host_texts
      HAVING count(DISTINCT t) >= 3 AND count(DISTINCT t) * 100 > host_texts * 5),
b AS (SELECT doc_id, sum(len(string_split(line, ' '))) AS boilerplate_words FROM nl SEMI JOIN f USING (host, line) GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             coalesce(n_dup_lines, 0) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
             CAST(coalesce(boilerplate_words, 0) AS BIGINT) AS boilerplate_words
      FROM d LEFT JOIN dl USING (doc_id) LEFT JOIN rw USING (doc_id) LEFT JOIN b USING (doc_id)),
e AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, boilerplate_words,
       NOT base_failed AND (n_words - boilerplate_words) * 100 >= n_words * 30 AS kept FROM e
"""


@query(sql=OP7_SQL)
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).drop("text_key", "lines_removed")


@query
def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


#: CRC-32 of a list of byte values, bit by bit.
CRC32 = """xor(list_reduce({bytes}, lambda c, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::UBIGINT[],
  lambda x, i: xor(x >> 1, 3988292384::UBIGINT * (x & 1)), xor(c, b)), 4294967295::UBIGINT), 4294967295::UBIGINT)"""

OP11_SQL = r"""
WITH w AS (
  SELECT doc_id AS id, 0 AS target, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT item_id, 1, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
o AS (SELECT id, target, unnest(w) AS f FROM w
      UNION ALL SELECT id, target, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w),
g AS (SELECT id, target, f, count(*) AS n FROM o GROUP BY id, target, f),
x AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM g)),
v AS (SELECT f, list_transform(range(1, len(h), 2), lambda i:
        (16 * (strpos('0123456789ABCDEF', h[i]) - 1) + strpos('0123456789ABCDEF', h[i + 1]) - 1)::UBIGINT) AS bytes FROM x),
k AS (SELECT f, CAST({crc} % 10000 AS BIGINT) AS bucket FROM v),
c AS (SELECT bucket, sum(n) FILTER (WHERE target = 0) AS s, sum(n) FILTER (WHERE target = 1) AS t FROM g JOIN k USING (f) GROUP BY bucket),
a AS (SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM c),
b AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(c.t, 0) + 1)::DOUBLE * (a.s + 10000)::DOUBLE
             / ((coalesce(c.s, 0) + 1)::DOUBLE * (a.t + 10000)::DOUBLE))) AS BIGINT) AS gain FROM c, a),
m AS (SELECT id, sum(n) AS n, floor(sum(n * gain)::DOUBLE / sum(n)) AS weight FROM g JOIN k USING (f) JOIN b USING (bucket)
      WHERE target = 0 GROUP BY id),
s AS (SELECT w.id AS doc_id, len(w) AS words, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
             CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || w.id), 1, 8))::BIGINT + 0.5)::DOUBLE / 4294967296))) AS BIGINT) AS score
      FROM w LEFT JOIN m USING (id) WHERE w.target = 0),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM s WHERE words >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= 25 * n // 100 THEN place END AS rank
FROM s LEFT JOIN r USING (doc_id)
""".replace("{crc}", CRC32.format(bytes="bytes"))


@query(sql=OP11_SQL)
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


OP12_SQL = """
WITH RECURSIVE t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS pos,
         md5(coalesce(role, '') || chr(10) || md5(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n_bytes
  FROM conversations WHERE conv_id IS NOT NULL),
v AS (SELECT c, count(*) AS n, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda d: ascii(d)::UBIGINT) AS bytes FROM t GROUP BY c),
h AS (SELECT c, n, c - c % 5 AS base, CAST({crc} % 9 AS BIGINT) AS h FROM v),
k AS (SELECT a.c, a.base, a.h, least(a.h, coalesce(b.n, 0)) AS k FROM h a LEFT JOIN h b ON b.c = a.base),
u AS (SELECT k.c, pos AS depth, x, n_bytes FROM k JOIN t ON t.c = k.base AND pos <= k.k
      UNION ALL SELECT k.c, pos - h + k.k, x, n_bytes FROM k JOIN t ON t.c = k.c AND pos > h),
z AS (SELECT k.c, count(u.c) AS size FROM k LEFT JOIN u USING (c) GROUP BY k.c),
p AS (SELECT c, 0::BIGINT AS depth, md5('') AS path, NULL::VARCHAR AS up, 0::BIGINT AS n_bytes FROM k
      UNION ALL SELECT p.c, u.depth, md5(p.path || u.x), p.path, u.n_bytes FROM p JOIN u ON u.c = p.c AND u.depth = p.depth + 1),
n AS (SELECT depth, path, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs, max(n_bytes) * (count(*) - 1) AS saved,
             bool_and(size = depth) AS leaf,
             sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE size = depth), '')) AS ends_sha256
      FROM p JOIN z USING (c) GROUP BY depth, path),
s AS (SELECT a.depth, a.path, sum(n.saved) AS saved, count_if(n.leaf) AS leaves
      FROM n JOIN p q ON q.c = n.conv_id AND q.depth <= n.depth JOIN n a ON a.path = q.path AND a.depth = q.depth
      GROUP BY a.depth, a.path),
d AS (SELECT up AS path, count(*) AS kids FROM n WHERE up IS NOT NULL GROUP BY up)
SELECT n.conv_id, n.depth, o.conv_id AS parent_conv_id, n.n_convs, coalesce(kids, 0) AS n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN s ON s.path = n.path AND s.depth = n.depth LEFT JOIN n o ON o.path = n.up AND o.depth = n.depth - 1 LEFT JOIN d ON d.path = n.path
""".replace("{crc}", CRC32.format(bytes="bytes"))


@query(sql=OP12_SQL)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv")
    return prefix_trie.prefix_trie(
        table(spark, sf_dir, "conversations"), base_of=conv - conv % 5, kept=F.crc32(conv.cast("string").cast("binary")) % 9, most=8)


@query
def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    exact = F.filter("findings", lambda x: x["exact"])
    first = F.transform(exact, lambda x: x["first_word"])
    return license_scan.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.size(exact).cast("long").alias("n_base"), F.array_min(first).alias("first_word"),
        F.array_max(first).alias("last_word"), license_scan.labels(exact_only=True).alias("base_labels"),
        license_scan.labels().alias("labels"),
        F.coalesce(F.array_max(F.transform("findings", lambda x: x["similarity"])), F.lit(0.0)).alias("score"))

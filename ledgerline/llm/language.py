"""Language identification with string kernels.

Texts are compared by the blended spectrum kernel: which byte n-grams of
lengths 1 to 3 they share (presence, not counts), normalised.  Nystroem
landmarks stand in for the training set, one-versus-rest kernel ridge
regression gives a score per language, and batches of documents are scored as
matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrays import pieces, text_buffer
from .shared import prepare

UNKNOWN = "und"
#: Bounded sample: labelled texts per language, and landmarks among them.
TRAIN_PER_LABEL, LANDMARKS_PER_LABEL = 160, 24
SHARES = 32
RIDGE = 1e-3
#: A prediction scored below this is no accepted language.
MIN_SCORE = 0.2
#: A text is of no known language if, for every label, the share of its 3-grams
#: that texts of the label hold is less than this part of the median share of
#: the learned texts.
FAMILIAR_PART = 0.5
GRAM2, GRAM3 = 1 << 13, 1 << 14
WIDTH = 256 + GRAM2 + GRAM3
BATCH_DOCS, BATCH_BYTES = 128, 1 << 20

#: Bytes as the kernel sees them: lower case, all but letters as a space.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[:128] = 32
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)


def presence(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row per document: which n-grams (hashed for n = 2, 3) it has."""
    rows = len(bounds) - 1
    out = np.zeros(rows * WIDTH, np.float32)
    if len(data):
        x = FOLD[data].astype(np.uint32)
        at = np.repeat(np.arange(rows, dtype=np.int64) * WIDTH, np.diff(bounds))
        out[at + x] = 1
        two = (x[:-1] << np.uint32(8)) | x[1:]
        same = at[:-1] == at[1:]
        out[at[:-1][same] + 256 + ((two * np.uint32(0x9E3779B1)) >> np.uint32(32 - 13))[same]] = 1
        if len(x) > 2:
            three = (two[:-1] << np.uint32(8)) | x[2:]
            same = at[:-2] == at[2:]
            out[at[:-2][same] + 256 + GRAM2 + ((three * np.uint32(0x85EBCA6B)) >> np.uint32(32 - 14))[same]] = 1
    return out.reshape(rows, WIDTH)


def normalised(grams: np.ndarray) -> np.ndarray:
    size = np.sqrt(grams.sum(axis=1, keepdims=True))
    return grams / np.maximum(size, 1)


@dataclass
class Model:
    labels: list[str]
    landmarks: np.ndarray  # packed bits
    weights: np.ndarray
    familiar: np.ndarray  # per 3-gram and label: known (1 or 0) less the least share

    def matrix(self) -> np.ndarray:
        return normalised(np.unpackbits(self.landmarks, axis=1)[:, :WIDTH].astype(np.float32)).T.copy()


def familiarity(grams: np.ndarray, labels: np.ndarray, names: list[str]) -> np.ndarray:
    """Which 3-grams at least two learned texts of a label hold, less the least
    share of them that a text of the label has.  The sum over a text's 3-grams
    is negative if it has a smaller share.  The least share follows from the
    learned texts, each held against the others; few texts of a label tell
    nothing, and the share is 0."""
    out = np.zeros((GRAM3, len(names)), np.float32)
    for k, name in enumerate(names):
        own = grams[labels == name][:, 256 + GRAM2:]
        count = own.sum(axis=0)
        share = (own @ (count > 2)) / np.maximum(own.sum(axis=1), 1)
        out[:, k] = (count > 1) - FAMILIAR_PART * np.median(share)
    return out


def fit(texts: list[str], labels: list[str], landmarks_per_label: int = LANDMARKS_PER_LABEL, ridge: float = RIDGE) -> Model:
    """Kernel ridge regression over Nystroem landmarks, one column per label."""
    names = sorted(set(labels))
    raw = [t.encode() for t in texts]
    grams = np.concatenate([presence(np.frombuffer(r, np.uint8), np.array([0, len(r)])) for r in raw])
    marks, seen = [], dict.fromkeys(names, 0)
    for i, label in enumerate(labels):
        if seen[label] < landmarks_per_label:
            seen[label] += 1
            marks.append(i)
    unit = normalised(grams)
    kernel = unit @ unit[marks].T
    inner = kernel[marks]
    target = np.where(np.array(labels)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    left = kernel.T.astype(np.float64) @ kernel + ridge * len(texts) * (inner + 1e-6 * np.eye(len(marks)))
    weights = np.linalg.solve(left, kernel.T.astype(np.float64) @ target)
    return Model(names, np.packbits(grams[marks].astype(np.uint8), axis=1), weights.astype(np.float32),
                 familiarity(grams, np.array(labels), names))


def training_rows(docs: DataFrame, text_col: str, label_col: str, learn: Column, per_label: int) -> list[tuple[str, str]]:
    """At most ``per_label`` distinct texts of each label, chosen by the hash
    of the text: (text, label).  The sample is the only thing collected."""
    rows = docs.where(learn & F.col(label_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("string").alias("label"))
    keys = rows.select("label", F.xxhash64("text").alias("key"))
    # copies count once; shares of a label are cut first, so no task reads more than SHARES * per_label rows of it
    keys = keys.groupBy("label", "key").agg(F.pmod("key", F.lit(SHARES)).alias("share"))
    for by in (["label", "share"], ["label"]):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy("key"))
        keys = keys.withColumn("rank", rank).where(F.col("rank") <= per_label).drop("rank")
    keys = [(r.label, r.key) for r in keys.select("label", "key").collect()]
    if not keys:
        return []
    found = (rows.where(F.xxhash64("text").isin([k for _, k in keys]))
             .groupBy("label", F.xxhash64("text").alias("key")).agg(F.min("text").alias("text")).collect())
    wanted = set(keys)
    return [(r.text, r.label) for r in sorted(found, key=lambda r: (r.key, r.label)) if (r.label, r.key) in wanted]


def score_texts(column, model: Model | None, marks: np.ndarray | None,
                reject: bool = False) -> tuple[list[str], list[float]]:
    """Label and score of each text of an Arrow column.  ``reject``: texts
    whose 3-grams are not those of any label are ``und`` too."""
    data, offsets = text_buffer(column)
    labels, scores = [], []
    for a, b in pieces(offsets, BATCH_BYTES):
        for first in range(a, b, BATCH_DOCS):
            last = min(b, first + BATCH_DOCS)
            base = offsets[first]
            part, bounds = data[base:offsets[last]], offsets[first:last + 1] - base
            folded = FOLD[part] != 32
            latin = np.concatenate(([0], np.cumsum(folded)))
            letters = latin[bounds[1:]] > latin[bounds[:-1]]
            plain = np.concatenate(([0], np.cumsum(folded & (part < 128))))
            for i in np.flatnonzero(letters & (plain[bounds[1:]] == plain[bounds[:-1]])):
                letters[i] = any(c.isalpha() for c in part[bounds[i]:bounds[i + 1]].tobytes().decode())
            if model is None:
                labels += [UNKNOWN] * (last - first)
                scores += [0.0] * (last - first)
                continue
            unit = normalised(presence(part, bounds))
            if reject:
                letters &= (unit[:, 256 + GRAM2:] @ model.familiar).max(axis=1) >= 0
            value = (unit @ marks) @ model.weights
            best = value.argmax(axis=1)
            score = np.clip((value[np.arange(len(best)), best] + 1) / 2, 0, 1)
            labels += [model.labels[k] if ok else UNKNOWN for k, ok in zip(best, letters)]
            scores += np.where(letters, score, 0.0).astype(float).tolist()
    return labels, scores


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of each row by ``model``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        marks = m.matrix() if m else None
        for batch in batches:
            labels, scores = score_texts(batch.column(1), m, marks)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def model_of(docs: DataFrame, id_col: str, text_col: str, label_col: str, per_label: int) -> Model | None:
    sample = training_rows(docs, text_col, label_col, ~held_out(id_col), per_label)
    return fit([t for t, _ in sample], [x for _, x in sample]) if sample else None


def accepted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
             per_label: int = TRAIN_PER_LABEL, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` without the rows whose language is unknown: no letters, 3-grams
    unlike those of every learned language (``FAMILIAR_PART``), or a score
    below ``min_score``.  Texts that mix learned languages stay.  All columns
    are kept, texts do not move.  With no labelled row there is no model, and
    only texts without letters go."""
    prepare(docs.sparkSession)
    model = model_of(docs, id_col, text_col, label_col, per_label)
    if model is None:
        return docs.where(F.col(text_col).rlike(r"\p{L}"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        marks = m.matrix()
        for batch in batches:
            labels, scores = score_texts(batch.column(at), m, marks, reject=True)
            yield batch.filter(pa.array([x != UNKNOWN and s >= min_score for x, s in zip(labels, scores)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
             per_label: int = TRAIN_PER_LABEL) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document.

    Learns from at most ``per_label`` labelled texts of each language among
    the documents that are not held out; labels, ids and sources take no part
    in a prediction.  Whole texts are read.  A text that is null or has no
    letter is ``und`` with score 0, and so is all if nothing is labelled; a
    null id is not held out; repeated rows give a row each; an empty table
    gives an empty result.  Other columns are not read.
    """
    prepare(docs.sparkSession)
    model = model_of(docs, id_col, text_col, label_col, per_label)
    return predict(docs, model, id_col, text_col).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")

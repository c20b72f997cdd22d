"""Suffix-array de-duplication by prefix-free parsing.

A rolling (Karp-Rabin) hash over every ``TRIGGER`` bytes sets the triggers:
the smallest hash of each ``window`` bytes is one, so phrases are bounded and
each window holds a trigger.  The dictionary is the set of distinct phrases,
the parse their sequence; suffixes of dictionary phrases in lexicographic
order, ties in order of the parse, give the corpus order up to the window
length, in which repeated windows are neighbours (``repeats``).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import repeats
from .arrays import BYTE_VALUES, U, mix, prefix_hash, stretch_hash

WINDOW = 100
TRIGGER = 32


def _read(data: np.ndarray, bounds: np.ndarray):
    return BYTE_VALUES[data], data, bounds


def triggers(values: np.ndarray, window: int, trigger: int = TRIGGER) -> tuple[np.ndarray, np.ndarray]:
    """For each window start, the position and the hash of its trigger: the
    leftmost smallest rolling hash inside the window."""
    trigger = min(trigger, window)
    places = len(values) - trigger + 1
    at = np.arange(places)
    rolling = stretch_hash(prefix_hash(values), at, at + trigger)
    bits = U(max(1, int(places).bit_length()))
    low = ((mix(rolling) >> bits) << bits) | at.astype(U)
    need, have = window - trigger + 1, 1
    while have < need:
        step = min(have, need - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    anchor = (low & ((U(1) << bits) - U(1))).astype(np.int64)
    return anchor, rolling[anchor]


def _report(block, covered, bounds) -> pa.Table:
    removed = np.concatenate(([0], np.cumsum(covered)))
    start = covered.copy()
    start[1:] &= ~covered[:-1]
    inner = bounds[(bounds < len(covered))]
    start[inner] = covered[inner]
    spans = np.concatenate(([0], np.cumsum(start)))
    digests, kept = [], []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        data = block.data[a:b]
        if removed[b] > removed[a]:
            data = data[~covered[a:b]]
        kept.append(data.tobytes())
        digests.append(hashlib.sha256(kept[-1]).hexdigest())
    return pa.table({
        "doc_id": pa.array(block.ids, pa.int64(), mask=block.null), "n_bytes": pa.array(np.diff(bounds)),
        "n_removed": pa.array(removed[bounds[1:]] - removed[bounds[:-1]]),
        "n_spans": pa.array(spans[bounds[1:]] - spans[bounds[:-1]]),
        "kept": pa.array(kept, pa.binary()), "kept_sha256": pa.array(digests, pa.string())})


def _without_kept(block, covered, bounds) -> pa.Table:
    return _report(block, covered, bounds).drop_columns(["kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   with_kept: bool = False) -> DataFrame:
    """Remove each byte of a ``window``-byte string that also starts earlier.

    Earlier: in a document with a smaller id, or at a smaller start of the
    same document; windows are judged on the input.  Returns per document
    doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256
    and, with ``with_kept``, the remaining bytes (``kept``, binary, since a
    cut may fall inside a character).

    A null text is empty; texts shorter than the window stay whole; a null
    id ranks last.  Rows with equal ids are separate documents, and windows
    of equal id and start do not remove each other.  An empty table gives an
    empty result.  Other columns of ``docs`` are not read.
    """
    units = repeats.Units(_read, triggers, window, False)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if with_kept:
        schema = schema.replace("kept_sha256", "kept binary, kept_sha256")
    return repeats.recurring(docs, id_col, text_col, units, 1, _report if with_kept else _without_kept, schema)



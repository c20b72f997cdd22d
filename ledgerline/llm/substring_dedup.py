"""Substring de-duplication by recompression.

Words get names (hashes, hence the same name everywhere).  Rounds rename the
text: a run of one symbol becomes a symbol, then each neighbouring pair of a
"left" and a "right" symbol does; the side is a bit of the symbol's name.
Names are hashes of their parts, so every task names equal parts alike and
equal substrings get equal symbols inside, but for a few at their edges.
Each symbol keeps the stretch of words that decided it.  A window's anchor is
the symbol decided inside the window that has the highest round, then the
smallest name, so equal windows have equal anchors: shared symbols reveal
repeats, and ``repeats`` verifies them word by word.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import repeats
from .arrays import TOP, U, mix, prefix_hash, stretch_hash, word_hashes, word_spans

WINDOW = 13


def _read(data: np.ndarray, bounds: np.ndarray):
    starts, ends = word_spans(data, bounds)
    values = word_hashes(data, starts, ends) if len(starts) else np.empty(0, U)
    return values, values, np.searchsorted(starts, bounds)


def recompress(values: np.ndarray, rounds: int):
    """Per round: names of the symbols, their starts, and the stretch
    ``[low, high)`` of words that decided each (it may pass the text's ends)."""
    n = len(values)
    name, start = values, np.arange(n)
    low, high = start, start + 1
    yield name, start, low, high
    for r in range(rounds):
        # runs: a symbol decided by the neighbours on both sides being others
        lead = np.ones(len(name), bool)
        lead[1:] = name[1:] != name[:-1]
        first = np.flatnonzero(lead)
        last = np.concatenate((first[1:], [len(name)])) - 1
        size = last - first + 1
        before = np.where(first > 0, low[first - 1], -1)
        after = np.where(last + 1 < len(name), high[np.minimum(last + 1, len(name) - 1)], n + 1)
        name = np.where(size > 1, mix(name[first] ^ mix(size.astype(U) + U(0x51ED270B * (r + 1)))), name[first])
        start, low, high = start[first], np.minimum(low[first], before), np.maximum(high[last], after)
        # pairs: a left symbol takes a right one behind it
        left = (mix(name + U(0xA0761D6478BD642F * (r + 1) & 0xFFFFFFFFFFFFFFFF)) & U(1)).astype(bool)
        joins = np.zeros(len(name), bool)
        joins[:-1] = left[:-1] & ~left[1:]
        joined = np.zeros(len(name), bool)
        joined[1:] = joins[:-1]
        before = np.concatenate(([-1], low[:-1]))
        after = np.concatenate((high[1:], [n + 1]))
        # a single symbol was decided by the neighbour that it did not join
        low2 = np.where(left, low, np.minimum(low, before))
        high2 = np.where(left, np.maximum(high, after), high)
        pair = np.flatnonzero(joins)
        name2 = name.copy()
        name2[pair] = mix(name[pair] * U(0x8EBC6AF09C88C6E3) ^ mix(name[pair + 1] + U(r + 1)))
        low2[pair] = np.minimum(low[pair], low[pair + 1])
        high2[pair] = np.maximum(high[pair], high[pair + 1])
        keep = ~joined
        name, start, low, high = name2[keep], start[keep], low2[keep], high2[keep]
        yield name, start, low, high


def rounds_for(window: int) -> int:
    """Rounds whose symbols a window can hold together with what decided them:
    the deciding words are about 4 after one round and double with each."""
    return max(1, int(np.log2(window / 6)))


def symbols_as_anchors(values: np.ndarray, window: int, rounds: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each window start, the position and the name of its anchor: the
    symbol together with all words that decided it."""
    places = len(values) - window + 1
    anchor = np.full(places, -1, np.int64)
    name = np.zeros(places, U)
    prefix = prefix_hash(values)
    for level, (names, start, low, high) in reversed(list(enumerate(recompress(values, rounds or rounds_for(window))))):
        open_ = np.flatnonzero(anchor < 0)
        if not len(open_):
            break
        at = np.full(len(values), -1, np.int64)
        at[start] = np.arange(len(start))
        best = np.full(len(open_), TOP)
        found = np.full(len(open_), -1, np.int64)
        for step in range(window):
            symbol = at[open_ + step]
            fits = (symbol >= 0) & (low[symbol] >= open_) & (high[symbol] <= open_ + window)
            key = np.where(fits, names[symbol], TOP)
            better = fits & ((key < best) | (found < 0))
            best = np.where(better, key, best)
            found = np.where(better, open_ + step, found)
        hit = np.flatnonzero(found >= 0)
        symbol = at[found[hit]]
        anchor[open_[hit]] = found[hit]
        name[open_[hit]] = mix(names[symbol] + U((level + 1) * 0x9FB21C651E98DF25 & 0xFFFFFFFFFFFFFFFF)) ^ stretch_hash(prefix, low[symbol], high[symbol])
    return anchor, name


def _words(block, covered, bounds):
    starts, ends = word_spans(block.data, block.bounds)
    removed = np.concatenate(([0], np.cumsum(covered)))
    for a, b, c, d in zip(bounds[:-1].tolist(), bounds[1:].tolist(), block.bounds[:-1].tolist(), block.bounds[1:].tolist()):
        cut = int(removed[b] - removed[a])
        yield a, b, c, d, cut, starts, ends


def _digests(block, covered, bounds) -> pa.Table:
    digests, cuts, sizes = [], [], []
    for a, b, c, d, cut, starts, ends in _words(block, covered, bounds):
        words = block.data[c:d].tobytes().split() if not cut else [
            block.data[s:e].tobytes() for s, e, gone in zip(starts[a:b], ends[a:b], covered[a:b]) if not gone]
        digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
        cuts.append(cut)
        sizes.append(b - a)
    return pa.table({
        "doc_id": pa.array(block.ids, pa.int64(), mask=block.null), "n_words": pa.array(sizes, pa.int64()),
        "n_removed": pa.array(cuts, pa.int64()), "kept_sha256": pa.array(digests, pa.string())})


def _texts(block, covered, bounds) -> pa.Table:
    texts, cuts, sizes = [], [], []
    for a, b, c, d, cut, starts, ends in _words(block, covered, bounds):
        data = block.data[c:d]
        if cut:
            # a removed word goes with the white space behind it
            follows = np.append(starts[a + 1:b], d)
            edge = np.zeros(d - c + 1, np.int64)
            gone = np.flatnonzero(covered[a:b])
            np.add.at(edge, starts[a:b][gone] - c, 1)
            np.add.at(edge, follows[gone] - c, -1)
            data = data[np.cumsum(edge[:-1]) == 0]
        texts.append(data.tobytes())
        cuts.append(cut)
        sizes.append(b - a)
    return pa.table({
        "doc_id": pa.array(block.ids, pa.int64(), mask=block.null), "n_words": pa.array(sizes, pa.int64()),
        "n_removed": pa.array(cuts, pa.int64()), "kept_text": pa.array(texts, pa.binary()).cast(pa.string()),
        "carried": pa.array(block.carried(), pa.string())})


def remove_repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Remove each word of a ``window``-word sequence that also starts in a
    document with a smaller id.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; windows are judged on the
    input.  Returns per document doc_id, n_words, n_removed and kept_sha256
    (kept words joined by one space).

    A null or empty text has no words; a null id ranks last; rows with equal
    ids do not remove words of each other, and each gives a row.  An empty
    table gives an empty result.  Other columns of ``docs`` are not read.
    """
    units = repeats.Units(_read, symbols_as_anchors, window, True)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return repeats.recurring(docs, id_col, text_col, units, 8, _digests, schema)


def without_repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with the texts that are left: removed words go with the white
    space behind each (``n_chars``, where present, follows the text).  Every
    row stays, a null text becomes empty; other columns travel unchanged, as
    JSON with microseconds.  Ids are whole numbers; rows of equal ids (ties) do
    not remove words of each other; an empty table gives an empty one."""
    units = repeats.Units(_read, symbols_as_anchors, window, True)
    schema = "doc_id long, n_words long, n_removed long, kept_text string, carried string"
    carry = [c for c in docs.columns if c not in (id_col, text_col)] or [id_col]
    left = repeats.recurring(docs, id_col, text_col, units, 8, _texts, schema, carry)
    fields = T.StructType([docs.schema[c] for c in carry])
    rows = left.withColumn("other", F.from_json("carried", fields, repeats.CARRIED_FORMAT))
    named = {id_col: F.col("doc_id").cast(docs.schema[id_col].dataType), text_col: F.col("kept_text")}
    if "n_chars" in docs.columns:
        named["n_chars"] = F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)
    return rows.select(*[named.get(c, F.col("other").getField(c)).alias(c) for c in docs.columns])

"""SentencePiece encoding with seeded merge-dropout, and decoding.

A segment is a run of spaces and the word behind it; no piece of a BPE
vocabulary crosses two.  In a segment's agenda the candidate merge of the
best score goes first, the leftmost among equals.  A candidate is skipped
for good when the hash of (seed, document, segment, its place and extent)
falls below the dropout rate, so a rerun gives the same pieces and another
seed gives others.  Whatever the segmentation, decoding gives the text back.

Segments of a batch advance together, one merge each per step; long ones use
a heap.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U, mix, pieces, text_buffer
from .shared import prepare

CHUNK_BYTES = 1 << 19
LONGEST = 48
SPACE = 0x20
#: Fixed value: the vocabulary's sign for a space.
SPACE_SIGN = "▁"
NO_MERGE = np.int32(1 << 30)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """Pieces, merges by score and byte pieces of a SentencePiece BPE model."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(self.size)]
        plain = [i for i in range(self.size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        ids = {names[i]: i for i in plain}
        self.bytes = np.zeros(256, np.int32)
        raw = [b""] * self.size
        for i in range(self.size):
            if model.is_byte(i):
                value = int(names[i][1:-1], 16)
                self.bytes[value] = i
                raw[i] = bytes([value])
        for i in plain:
            raw[i] = names[i].replace(SPACE_SIGN, " ").encode()
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_size = np.array([len(r) for r in raw], np.int64)
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size
        self.chars = np.full(0x110000, -1, np.int32)
        for i in plain:
            if len(names[i]) == 1 and names[i] != SPACE_SIGN:
                self.chars[ord(names[i])] = i
        self.chars[SPACE] = ids[SPACE_SIGN]
        order = sorted(plain, key=lambda i: (-model.get_score(i), i))
        rank = {i: k for k, i in enumerate(order)}
        self.by_rank = np.array(order, np.int32)
        merges = [(ids[p[:k]] * self.size + ids[p[k:]], rank[i]) for p, i in ids.items()
                  for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids]
        merges.sort()
        self.codes = np.array([m[0] for m in merges], np.int64)
        self.ranks = np.array([m[1] for m in merges], np.int32)

    def merge_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; ``NO_MERGE`` if there is none."""
        code = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        good = (self.codes[at] == code) & (left >= 0) & (right >= 0)
        return np.where(good, self.ranks[at], NO_MERGE)


def dropped(key: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray, limit: np.uint64) -> np.ndarray:
    """Whether the keyed hash skips the candidate that joins [start, middle) and [middle, end)."""
    place = (start.astype(U) << U(42)) ^ (middle.astype(U) << U(21)) ^ end.astype(U)
    return mix(key ^ mix(place + U(0x632BE59BD9B4E019))) < limit


def _step_together(symbols: np.ndarray, sizes: np.ndarray, keys: np.ndarray, v: Vocabulary, limit) -> tuple[np.ndarray, np.ndarray]:
    """Agendas of short segments, one merge of each per step."""
    rows, width = symbols.shape
    out, out_size = symbols.copy(), sizes.copy()
    start = np.broadcast_to(np.arange(width + 1, dtype=np.int32), (rows, width + 1)).copy()
    live = np.arange(rows)
    sym, n = symbols, sizes
    rank = v.merge_ranks(sym[:, :-1], sym[:, 1:])
    if limit:
        skip = dropped(keys[:, None], start[:, :-2], start[:, 1:-1], start[:, 2:], limit)
        rank = np.where(skip, NO_MERGE, rank)
    column, places = np.arange(width), np.arange(width + 1)
    while len(live):
        best = rank.argmin(axis=1)
        at = np.arange(len(live))
        top = rank[at, best]
        ready = top < NO_MERGE
        if not ready.all():
            done = ~ready
            out[live[done]], out_size[live[done]] = sym[done], n[done]
            live, sym, n, rank, start, keys = (a[ready] for a in (live, sym, n, rank, start, keys))
            best, top = best[ready], top[ready]
            at = np.arange(len(live))
            if not len(live):
                break
        shift = np.minimum(column + (column > best[:, None]), width - 1)
        sym = np.take_along_axis(sym, shift, 1)
        sym[:, -1] = -1
        sym[at, best] = v.by_rank[top]
        start = np.take_along_axis(start, np.minimum(places + (places > best[:, None]), width), 1)
        pairs = np.minimum(column[:-1] + (column[:-1] >= best[:, None] + 1), width - 2)
        rank = np.take_along_axis(rank, pairs, 1)
        rank[:, -1] = NO_MERGE
        n = n - 1
        for place in (best - 1, best):
            fit = np.flatnonzero((place >= 0) & (place + 1 < n))
            where = place[fit]
            new = v.merge_ranks(sym[fit, where], sym[fit, where + 1])
            if limit:
                skip = dropped(keys[fit], start[fit, where], start[fit, where + 1], start[fit, where + 2], limit)
                new = np.where(skip, NO_MERGE, new)
            rank[fit, where] = new
        gone = np.flatnonzero((best < width - 1) & (best + 1 >= n))
        rank[gone, best[gone]] = NO_MERGE
    return out, out_size


def _heap(symbols: list[int], key, v: Vocabulary, limit) -> list[int]:
    """Agenda of one long segment."""
    n = len(symbols)
    sym, prev, nxt, end = list(symbols), list(range(-1, n - 1)), list(range(1, n + 1)), list(range(1, n + 1))
    one = np.array([key], U)

    def candidates(lefts: list[int]) -> list[tuple]:
        lefts = [i for i in lefts if i >= 0 and nxt[i] < n]
        if not lefts:
            return []
        a, b = np.array(lefts), np.array([nxt[i] for i in lefts])
        rank = v.merge_ranks(np.array([sym[i] for i in a]), np.array([sym[i] for i in b]))
        ends = np.array([end[i] for i in b])
        if limit:
            rank = np.where(dropped(one, a, b, ends, limit), NO_MERGE, rank)
        return [(int(r), i, j, e) for r, i, j, e in zip(rank, lefts, b.tolist(), ends.tolist()) if r < NO_MERGE]

    agenda = candidates(list(range(n)))
    heapq.heapify(agenda)
    while agenda:
        rank, i, j, e = heapq.heappop(agenda)
        if sym[i] is None or nxt[i] != j or j >= n or sym[j] is None or end[j] != e:
            continue
        sym[i], sym[j] = int(v.by_rank[rank]), None
        nxt[i], end[i] = nxt[j], e
        if nxt[i] < n:
            prev[nxt[i]] = i
        for c in candidates([prev[i], i]):
            heapq.heappush(agenda, c)
    return [s for s in sym if s is not None]


def encode_buffer(data: np.ndarray, bounds: np.ndarray, doc_keys: np.ndarray, v: Vocabulary, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a buffer of documents and their ``n + 1`` offsets."""
    docs = len(bounds) - 1
    filled = np.diff(bounds) > 0
    chars = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    heads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    # a space goes before each document that is not empty
    first = heads[bounds[:-1]][filled]
    chars = np.insert(chars, first, SPACE)
    limits = np.concatenate(([0], np.cumsum(np.diff(heads[bounds]) + filled)))
    if not len(chars):
        return np.empty(0, np.int32), np.zeros(docs + 1, np.int64)
    space = chars == SPACE
    lead = space.copy()
    lead[1:] &= ~space[:-1]
    lead[limits[:-1][filled]] = True
    seg = np.flatnonzero(lead)
    size = np.diff(np.append(seg, len(chars)))
    doc = np.searchsorted(limits, seg, side="right") - 1
    ordinal = np.arange(len(seg)) - np.searchsorted(seg, limits[doc])
    keys = mix(doc_keys[doc] + ordinal.astype(U) * U(0x9E3779B97F4A7C15))
    limit = U(min(max(rate, 0.0), 1.0) * float((1 << 64) - 2048)) if rate > 0 else U(0)
    symbols = v.chars[chars]
    unknown = np.flatnonzero(symbols < 0)
    symbols[unknown] = -2 - chars[unknown].astype(np.int32)
    left = np.zeros(len(chars), bool)  # places of symbols that stay
    lengths = np.ones(len(seg), np.int64)
    edges = [1, 2, 4, 6, 8, 10, 13, 17, 24, 33, LONGEST]
    for low, high in zip([0, *edges[:-1]], edges):
        pick = np.flatnonzero((size > low) & (size <= high))
        if not len(pick) or high == 1:
            left[seg[pick]] = True
            continue
        at = seg[pick][:, None] + np.arange(high)
        inside = np.arange(high) < size[pick][:, None]
        matrix = np.where(inside, symbols[np.minimum(at, len(chars) - 1)], -1)
        got, count = _step_together(matrix, size[pick].copy(), keys[pick], v, limit)
        lengths[pick] = count
        kept = np.arange(high) < count[:, None]
        symbols[at[kept]] = got[kept]
        left[at[kept]] = True
    for s in np.flatnonzero(size > LONGEST).tolist():
        a = int(seg[s])
        got = _heap(symbols[a:a + size[s]].tolist(), keys[s], v, limit)
        symbols[a:a + len(got)] = got
        left[a:a + len(got)] = True
        lengths[s] = len(got)
    ids = symbols[left]
    total = np.concatenate(([0], np.cumsum(lengths)))[np.searchsorted(seg, limits)]
    odd = np.flatnonzero(ids < 0)
    if len(odd):
        as_bytes = [chr(-2 - c).encode() for c in ids[odd].tolist()]
        more = np.ones(len(ids), np.int64)
        more[odd] = [len(b) for b in as_bytes]
        at = np.concatenate(([0], np.cumsum(more)))
        wide = np.repeat(ids, more)
        where = np.repeat(at[odd], more[odd]) + np.concatenate([np.arange(len(b)) for b in as_bytes])
        wide[where] = v.bytes[np.frombuffer(b"".join(as_bytes), np.uint8)]
        ids, total = wide, at[total]
    return ids.astype(np.int32), total


def decode_buffer(ids: np.ndarray, bounds: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of each document's ids, without the space that encoding put first."""
    size = v.raw_size[ids]
    total = np.concatenate(([0], np.cumsum(size)))
    data = v.raw[np.repeat(v.raw_start[ids] - total[:-1], size) + np.arange(total[-1])]
    offsets = total[bounds]
    filled = np.diff(offsets) > 0
    data = np.delete(data, offsets[:-1][filled])
    return data, offsets - np.concatenate(([0], np.cumsum(filled)))


_known: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _known:
        _known[path] = Vocabulary(path)
    return _known[path]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
           rate: float = 0.1, seed: int = 1) -> DataFrame:
    """(doc_id, text, ids) of every document, one row per input row.

    ``rate`` is the share of candidate merges that are skipped; with 0 the
    ids are the model's own.  The space sign inside a text is encoded as
    bytes, so that it survives decoding.  A null or empty text has no ids
    (null stays null in ``text``); documents without an id, or of one id,
    share a key, so equal ones get equal pieces; an empty table gives an
    empty result.  Other columns of ``docs`` are not read.
    """
    prepare(docs.sparkSession)
    path = path or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            keys = mix(batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(U)
                       ^ mix(np.array([seed], np.int64).view(U)))
            for a, b in pieces(offsets, CHUNK_BYTES):
                ids, total = encode_buffer(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], keys[a:b], v, rate)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                    pa.ListArray.from_arrays(pa.array(total.astype(np.int32)), pa.array(ids))], ["doc_id", "text", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, text string, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``decoded``: the texts of the ``ids``; null ids are an empty text."""
    prepare(encoded.sparkSession)
    path = path or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            sizes = pa.compute.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            data, offsets = decode_buffer(ids, np.concatenate(([0], np.cumsum(sizes))), v)
            raw = data.tobytes()
            texts = [raw[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*keep, "decoded"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in encoded.select(*keep).schema.fields)
    return encoded.select(*keep, "ids").mapInArrow(run, f"{fields}, decoded string")

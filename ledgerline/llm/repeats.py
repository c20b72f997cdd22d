"""Exact search for fixed-length windows that recur earlier in the corpus.

Both substring operators cut texts into phrases that depend on content only,
so equal windows of two texts lie at the same place of equal phrases.  This
module moves phrases through Spark; the operators say how a text becomes
units (bytes or words) and which position anchors a window.

1. ``pack``: documents go into compressed blocks of a few MB (a shared table).
2. ``phrase_rows``: each block lists its phrases.  A phrase is a maximal run
   of windows with one anchor; its ``k1`` names the anchor, its ``k2`` all of
   its units.  Equal phrases of a block send one row, so a passage that a
   third of all documents hold costs at most one row per block.
3. ``verdicts``: per ``k1`` over the whole corpus, the earliest phrase.  One
   ``k2`` only: the phrase is a repeat unless it is that earliest.  Several:
   ambiguous, since neighbouring phrases share a part of their windows.
4. ``dictionary_rows``: the distinct ambiguous phrases travel with their
   units.  ``suffix_order`` sorts all their suffixes by the first window
   length, then by place in the corpus; within equal suffixes all but the
   earliest are repeats.  An anchor with very many phrases is split: each of
   its windows travels under the hash of its own units.
5. ``resolve``: each block combines the verdicts into covered units; equal
   phrases of one document share the verdict of the first.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import U, mix, pieces, prefix_hash, stretch_hash, text_buffer
from .shared import prepare, written

BLOCK_BYTES = 2 << 20
#: Units of one stretch of work: bounds the arrays of a very long text.
STRETCH = 2 << 20
#: An anchor with more phrases than this has its windows dealt out one by one.
HOT_PHRASES = 2048
#: Times of carried columns keep their microseconds.
CARRIED_FORMAT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
#: Bytes of window copies sorted at a time.
SORT_BYTES = 24 << 20
NO_ID = np.iinfo(np.int64).max

LATER, AMBIGUOUS, SPLIT = 1, 2, 3


@dataclass(frozen=True)
class Units:
    """How texts become units.

    ``read(data, bounds)`` gives the hash values of the units, the bytes that
    identify them (an array whose rows compare as the units do) and the unit
    offsets of the documents.  ``anchors(values, window)`` gives, for each
    window start, the anchor's position and its name.  ``by_document``: a
    window counts as earlier only if it starts in a smaller document."""

    read: Callable
    anchors: Callable
    window: int
    by_document: bool


@dataclass
class Phrases:
    k1: np.ndarray
    k2: np.ndarray
    low: np.ndarray
    count: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    first: np.ndarray
    later: np.ndarray


class Block:
    """A packed block of documents."""

    def __init__(self, payload: bytes):
        raw = zstandard.ZstdDecompressor().decompress(payload)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        self.ids = np.frombuffer(raw, np.int64, n, 8)
        self.null = np.frombuffer(raw, np.int64, n, 8 + 8 * n).astype(bool)
        self.bounds = np.frombuffer(raw, np.int64, n + 1, 8 + 16 * n)
        head = 8 + 16 * n + 8 * (n + 1)
        self.data = np.frombuffer(raw, np.uint8, int(self.bounds[-1]), head)
        self._rest = raw[head + int(self.bounds[-1]):]

    def carried(self) -> list[str | None]:
        """The other columns of the documents, as JSON, if they were packed."""
        return pickle.loads(self._rest)

    @staticmethod
    def pack(ids: pa.Array, bounds: np.ndarray, data: np.ndarray, carried: list[str | None]) -> bytes:
        null = np.asarray(ids.is_null().to_numpy(zero_copy_only=False), dtype=np.int64)
        numbers = ids.fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
        parts = (np.array([len(numbers)], np.int64), numbers, null, (bounds - bounds[0]).astype(np.int64), data)
        raw = b"".join(p.tobytes() for p in parts) + pickle.dumps(carried)
        return zstandard.ZstdCompressor(level=3).compress(raw)


def pack(docs: DataFrame, id_col: str, text_col: str, carry: list[str]) -> DataFrame:
    """Documents as compressed blocks: (block, payload, n_bytes); the columns
    ``carry`` travel along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 32
        waiting: list[tuple] = []

        def flush():
            nonlocal serial
            ids = pa.concat_arrays([w[0] for w in waiting])
            data = np.concatenate([w[2] for w in waiting])
            sizes = np.concatenate([np.diff(w[1]) for w in waiting])
            bounds = np.concatenate(([0], np.cumsum(sizes)))
            carried = [x for w in waiting for x in w[3]]
            waiting.clear()
            serial += 1
            return pa.RecordBatch.from_pydict({
                "block": pa.array([serial - 1], pa.int64()),
                "payload": pa.array([Block.pack(ids, bounds, data, carried)], pa.binary()),
                "n_bytes": pa.array([len(data)], pa.int64())})

        held = 0
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for first, last in pieces(offsets, BLOCK_BYTES):
                part = data[offsets[first]:offsets[last]].copy()
                if waiting and held + len(part) > BLOCK_BYTES:
                    yield flush()
                    held = 0
                ids = pa.array(batch.column(0).slice(first, last - first).to_pylist(), pa.int64())
                others = batch.column(2).slice(first, last - first).to_pylist() if carry else []
                waiting.append((ids, offsets[first:last + 1] - offsets[first], part, others))
                held += len(part)
        if waiting:
            yield flush()

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
                         *([F.to_json(F.struct(*carry), CARRIED_FORMAT).alias("carried")] if carry else []))
    return source.mapInArrow(run, "block long, payload binary, n_bytes long")


def phrases_of(block: Block, units: Units) -> tuple[Phrases, np.ndarray, np.ndarray, np.ndarray]:
    """Phrases of a block, the identifying rows and values of its units, and
    the unit offsets of its documents."""
    values, rows, bounds = units.read(block.data, block.bounds)
    window, n = units.window, len(values)
    parts = []
    for at in range(0, max(0, n - window + 1), STRETCH):
        piece = values[at:at + STRETCH + window - 1]
        places = len(piece) - window + 1
        anchor, name = units.anchors(piece, window)
        doc = np.searchsorted(bounds, np.arange(at, at + places), side="right") - 1
        whole = np.arange(at, at + places) + window <= bounds[doc + 1]
        fresh = np.ones(places, bool)
        fresh[1:] = (anchor[1:] != anchor[:-1]) | (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
        fresh[1:] |= whole[1:] & ~whole[:-1]
        low = np.flatnonzero(fresh & whole)
        run = np.cumsum(fresh) - 1
        count = np.bincount(run[whole], minlength=run[-1] + 1)[run[low]]
        prefix = prefix_hash(piece)
        k2 = mix(stretch_hash(prefix, low, low + count - 1 + window)
                 ^ mix((anchor[low] - low).astype(U) * U(0x2545F4914F6CDD1D) + count.astype(U)))
        parts.append((name[low], k2, low + at, count, doc[low]))
    if parts:
        k1, k2, low, count, doc = (np.concatenate(p) for p in zip(*parts))
    else:
        k1 = k2 = np.empty(0, U)
        low = count = doc = np.empty(0, np.int64)
    number = block.ids[doc]
    start = np.zeros(len(low), np.int64) if units.by_document else low - bounds[doc]
    order = np.lexsort((start, number, k2, k1))
    k1, k2, low, count, number, start = (a[order] for a in (k1, k2, low, count, number, start))
    first = np.ones(len(k1), bool)
    first[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
    lead = np.maximum.accumulate(np.where(first, np.arange(len(k1)), 0)) if len(k1) else np.empty(0, np.int64)
    later = (number > number[lead]) | ((number == number[lead]) & (start > start[lead]))
    return Phrases(k1, k2, low, count, number, start, first, later), rows, values, bounds


def phrase_rows(blocks: DataFrame, units: Units) -> DataFrame:
    """One row per block and anchor name: the earliest phrase and the number of distinct phrases."""

    def run(batches):
        for batch in batches:
            for number, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                p = phrases_of(Block(payload.as_py()), units)[0]
                if not len(p.k1):
                    continue
                lead = np.ones(len(p.k1), bool)
                lead[1:] = p.k1[1:] != p.k1[:-1]
                kinds = np.add.reduceat(p.first.astype(np.int32), np.flatnonzero(lead))
                yield pa.RecordBatch.from_pydict({
                    "k1": pa.array(p.k1[lead].view(np.int64)), "k2": pa.array(p.k2[lead].view(np.int64)),
                    "doc": pa.array(p.doc[lead]), "start": pa.array(p.start[lead].astype(np.int32)),
                    "kinds": pa.array(kinds.astype(np.int32)),
                    "block": pa.array(np.full(int(lead.sum()), number, np.int64))})

    return blocks.select("block", "payload").mapInArrow(
        run, "k1 long, k2 long, doc long, start int, kinds int, block long")


def verdicts(phrases: DataFrame) -> DataFrame:
    """(block, k1, status) of anchors whose phrases are not plainly new."""
    w = Window.partitionBy("k1")
    first = F.min(F.struct("doc", "start")).over(w)
    seen = phrases.select(
        "block", "k1",
        F.count(F.lit(1)).over(w).alias("rows"),
        (F.min("k2").over(w) == F.max("k2").over(w)).alias("one_text"),
        F.max("kinds").over(w).alias("most"),
        F.sum("kinds").over(w).alias("all_kinds"),
        (F.struct("doc", "start") > first).alias("later"))
    plain = F.col("one_text") & (F.col("most") == 1)
    status = (F.when(plain & F.col("later"), LATER)
              .when(plain, None)
              .when(F.col("all_kinds") > HOT_PHRASES, SPLIT)
              .otherwise(AMBIGUOUS))
    return seen.where((F.col("rows") > 1) | (F.col("most") > 1)).select(
        "block", "k1", status.cast("int").alias("status")).where("status is not null")


def _status_of(p: Phrases, keys: np.ndarray, status: np.ndarray) -> np.ndarray:
    """The verdict of each phrase (0: new)."""
    out = np.zeros(len(p.k1), np.int8)
    if len(keys) and len(p.k1):
        order = np.argsort(keys)
        keys, status = keys[order], status[order]
        at = np.minimum(np.searchsorted(keys, p.k1), len(keys) - 1)
        out = np.where(keys[at] == p.k1, status[at], 0).astype(np.int8)
    return out


def dictionary_rows(blocks: DataFrame, replies: DataFrame, units: Units) -> DataFrame:
    """The distinct ambiguous phrases of each block with their units."""
    window, schema = units.window, "key long, block long, slot int, doc long, start int, data binary"
    fields = pa.schema([("key", pa.int64()), ("block", pa.int64()), ("slot", pa.int32()), ("doc", pa.int64()),
                        ("start", pa.int32()), ("data", pa.binary())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        tables = [fields.empty_table()]
        for number, payload in zip(left.column("block").to_pylist(), left.column("payload")):
            p, rows, values, _ = phrases_of(Block(payload.as_py()), units)
            status = _status_of(p, right.column("k1").to_numpy().view(U), right.column("status").to_numpy())
            for kind in (AMBIGUOUS, SPLIT):
                pick = np.flatnonzero(p.first & (status == kind))
                if not len(pick):
                    continue
                key, low, count, doc, start = p.k1[pick], p.low[pick], p.count[pick], p.doc[pick], p.start[pick]
                if kind == SPLIT:
                    of = np.repeat(np.arange(len(pick)), count)
                    step = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
                    low, doc = low[of] + step, doc[of]
                    start = start[of] + (0 if units.by_document else step)
                    count = np.ones(len(of), np.int64)
                    key = stretch_hash(prefix_hash(values), low, low + window)
                width = rows.dtype.itemsize * (rows.shape[1] if rows.ndim > 1 else 1)
                flat, size = rows.tobytes(), (count - 1 + window) * width
                data = [flat[a:a + b] for a, b in zip((low * width).tolist(), size.tolist())]
                tables.append(pa.table({
                    "key": pa.array(key.view(np.int64)), "block": pa.array(np.full(len(key), number, np.int64)),
                    "slot": pa.array(low.astype(np.int32)), "doc": pa.array(doc),
                    "start": pa.array(start.astype(np.int32)), "data": pa.array(data, pa.binary())}, schema=fields))
        return pa.concat_tables(tables)

    unclear = replies.where(F.col("status") >= AMBIGUOUS)
    return (blocks.select("block", "payload").groupBy("block").cogroup(unclear.groupBy("block"))
            .applyInArrow(run, schema))


def _order(group: pa.Table, width: int, window: int, by_document: bool) -> pa.RecordBatch | None:
    """Suffix order of a group's phrases up to the window length; the windows
    that are not the earliest of their class, as a bit mask per phrase."""
    data = group.column("data").combine_chunks()
    offsets = np.frombuffer(data.buffers()[1], np.int32)[data.offset:data.offset + len(data) + 1].astype(np.int64)
    raw = np.frombuffer(data.buffers()[2], np.uint8)
    count = np.diff(offsets) // width - window + 1
    of = np.repeat(np.arange(len(count)), count)
    step = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    suffix = np.lib.stride_tricks.sliding_window_view(raw, window * width)[offsets[of] + step * width]
    suffix = np.ascontiguousarray(suffix).view(f"S{window * width}").ravel()
    doc = group.column("doc").to_numpy()[of]
    start = group.column("start").to_numpy()[of] + (0 if by_document else step)
    order = np.lexsort((start, doc, suffix))
    suffix, doc, start = suffix[order], doc[order], start[order]
    first = np.ones(len(order), bool)
    first[1:] = suffix[1:] != suffix[:-1]
    lead = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    later = np.empty(len(order), bool)
    later[order] = (doc > doc[lead]) | ((doc == doc[lead]) & (start > start[lead]))
    hit = np.flatnonzero(np.bincount(of, weights=later, minlength=len(count)))
    if not len(hit):
        return None
    ends = np.cumsum(count)
    masks = [np.packbits(later[ends[i] - count[i]:ends[i]]).tobytes() for i in hit]
    return pa.RecordBatch.from_pydict({
        "block": group.column("block").combine_chunks().take(pa.array(hit)),
        "slot": group.column("slot").combine_chunks().take(pa.array(hit)), "mask": pa.array(masks, pa.binary())})


def suffix_order(dictionary: DataFrame, units: Units, width: int) -> DataFrame:
    """(block, slot, mask): which windows of each ambiguous phrase recur earlier."""
    window, by_document = units.window, units.by_document

    def run(batches):
        held: list[pa.RecordBatch] = []

        def settle(table: pa.Table):
            size = (np.asarray(pa.compute.binary_length(table.column("data"))).astype(np.int64) // width - window + 1) * window * width
            key = table.column("key").to_numpy()
            edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            total = np.cumsum(size)
            at = 0
            while at < len(key):
                reach = np.searchsorted(total, (total[at - 1] if at else 0) + SORT_BYTES)
                stop = edge[edge > at]
                fits = stop[stop <= reach]
                end = int(fits[-1]) if len(fits) else (int(stop[0]) if len(stop) else len(key))
                if reach >= len(key):
                    end = len(key)
                out = _order(table.slice(at, end - at), width, window, by_document)
                if out is not None:
                    yield out
                at = end

        for batch in batches:
            held.append(batch)
            if sum(b.nbytes for b in held) > (2 << 20):
                table = pa.Table.from_batches(held)
                key = table.column("key").to_numpy()
                cut = int(np.searchsorted(key, key[-1]))
                if cut:
                    yield from settle(table.slice(0, cut).combine_chunks())
                    held = table.slice(cut).combine_chunks().to_batches()
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            if table.num_rows:
                yield from settle(table)

    return (dictionary.repartition("key").sortWithinPartitions("key")
            .mapInArrow(run, "block long, slot int, mask binary"))


def _share_masks(p: Phrases, hit: np.ndarray) -> None:
    """Only the first of a block's equal phrases has a mask in ``hit`` (a mark
    per window start): its equals that are not plainly later get it too."""
    lead = np.maximum.accumulate(np.where(p.first, np.arange(len(p.k1)), 0))
    marked = np.concatenate(([0], np.cumsum(hit)))
    copy = np.flatnonzero(~p.first & ~p.later)
    copy = copy[marked[p.low[lead[copy]] + p.count[copy]] > marked[p.low[lead[copy]]]]
    count = p.count[copy]
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    hit[np.repeat(p.low[copy], count) + step] |= hit[np.repeat(p.low[lead[copy]], count) + step]


def resolve(blocks: DataFrame, replies: DataFrame, masks: DataFrame, units: Units,
            report: Callable, schema: str) -> DataFrame:
    """``report(block, covered, unit_bounds)`` of each block as rows, where
    ``covered`` marks the units of windows that recur earlier."""
    window = units.window

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        tables = []
        slot, k1 = right.column("slot"), right.column("k1")
        is_mask = np.asarray(slot.is_valid())
        own = right.filter(pa.array(is_mask))
        keys = k1.filter(pa.array(~is_mask)).to_numpy().view(U)
        state = right.column("status").filter(pa.array(~is_mask)).to_numpy()
        for payload in left.column("payload"):
            block = Block(payload.as_py())
            p, _, values, bounds = phrases_of(block, units)
            known = np.flatnonzero(p.later | (_status_of(p, keys, state) == LATER))
            edge = np.zeros(len(values) + 1, np.int64)
            np.add.at(edge, p.low[known], 1)
            np.add.at(edge, p.low[known] + p.count[known] - 1 + window, -1)
            if own.num_rows:
                slots = own.column("slot").to_numpy().astype(np.int64)
                packed = own.column("mask").to_pylist()
                bits = [np.flatnonzero(np.unpackbits(np.frombuffer(m, np.uint8))) for m in packed]
                hit = np.zeros(len(values), bool)
                hit[np.concatenate([s + b for s, b in zip(slots, bits)])] = True
                _share_masks(p, hit)
                hits = np.flatnonzero(hit)
                np.add.at(edge, hits, 1)
                np.add.at(edge, hits + window, -1)
            tables.append(report(block, np.cumsum(edge[:-1]) > 0, bounds))
        return pa.concat_tables(tables)

    both = replies.select("block", "k1", "status", F.lit(None).cast("int").alias("slot"),
                          F.lit(None).cast("binary").alias("mask")).unionByName(
        masks.select("block", F.lit(None).cast("long").alias("k1"), F.lit(None).cast("int").alias("status"),
                     "slot", "mask"))
    return (blocks.select("block", "payload").groupBy("block").cogroup(both.groupBy("block"))
            .applyInArrow(run, schema))


def recurring(docs: DataFrame, id_col: str, text_col: str, units: Units, width: int,
              report: Callable, schema: str, carry: list[str] | None = None) -> DataFrame:
    """The whole job; ``width`` is the number of bytes that identify a unit."""
    prepare(docs.sparkSession)
    blocks = written(pack(docs, id_col, text_col, carry or []), "blocks", "none")
    replies = written(verdicts(phrase_rows(blocks, units)), "verdicts")
    masks = written(suffix_order(dictionary_rows(blocks, replies, units), units, width), "masks")
    return resolve(blocks, replies, masks, units, report, schema)

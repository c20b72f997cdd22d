"""Packing token sequences: first-fit decreasing with a tournament tree.

Documents are tokenised where they are read; only piece lengths travel.  They
meet in randomised groups of bounded size, in which each piece goes to the
first sequence that has room, found in O(log n) in a tournament tree of the
free capacities.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U, lower_ascii, pieces, text_buffer, word_hashes, word_spans
from .shared import prepare

CAPACITY = 2048
END = 1
GROUP_DOCS = 4096
CHUNK_BYTES = 1 << 20
#: Parts of words that a worker remembers; beyond, it starts afresh.
PARTS_KEPT = 4_000_000
SPACE, LETTER, DIGIT, SIGN, OTHER = range(5)
KINDS = np.full(256, SIGN, np.uint8)
KINDS[[9, 10, 11, 12, 13, 32]] = SPACE
KINDS[48:58] = DIGIT
KINDS[65:91] = KINDS[97:123] = LETTER
KINDS[128:] = OTHER
KINDS[[0, 39]] = OTHER
KINDS[1:9] = KINDS[14:32] = KINDS[127] = OTHER


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def part_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of stretches that the vocabulary encodes independently
    of their neighbours, and the lower-cased bytes.

    ASCII and Latin-1 words are cut where letters, digits and signs meet, as
    the pre-tokeniser does.  A word with any other character, an apostrophe
    (contractions) or "<|" (special tokens) stays whole and as it is."""
    kind = KINDS[data]
    lead = np.flatnonzero(data == 0xC3)
    lead = lead[(lead + 1 < len(data))]
    tail = data[np.minimum(lead + 1, len(data) - 1)]
    lead, tail = lead[(tail != 0x97) & (tail != 0xB7)], tail[(tail != 0x97) & (tail != 0xB7)]
    kind[lead], kind[lead + 1] = LETTER, LETTER
    low = lower_ascii(data)
    capital = lead[tail <= 0x9E] + 1
    low[capital] += np.uint8(32)
    angle = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124))
    kind[angle] = OTHER
    starts, ends = word_spans(data, bounds)
    odd = np.concatenate(([0], np.cumsum(kind == OTHER)))
    whole = odd[ends] > odd[starts]
    if whole.any():
        edge = np.zeros(len(data) + 1, np.int8)
        edge[starts[whole]] += 1
        edge[ends[whole]] -= 1
        inside = np.cumsum(edge[:-1], dtype=np.int8) > 0
        kind[inside] = OTHER
        low[inside] = data[inside]
    cut = np.ones(len(data), bool)
    cut[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    cut[starts] = True
    spoken = kind != SPACE
    first = np.flatnonzero(cut & spoken)
    last = np.ones(len(data), bool)
    last[:-1] = cut[1:] | ~spoken[1:]
    return first, np.flatnonzero(last & spoken) + 1, low


class PartEncoder:
    """Token ids of texts by the ``tokenizers`` library, each distinct part once."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        self.keys = np.empty(0, U)
        self.start = np.empty(0, np.int64)
        self.size = np.empty(0, np.int64)
        self.flat = np.empty(0, np.uint32)

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a buffer of documents and their ``n + 1`` offsets."""
        if not len(data):
            return np.empty(0, np.uint32), np.zeros(len(bounds), np.int64)
        starts, ends, low = part_spans(data, bounds)
        if len(self.keys) > PARTS_KEPT:
            self.forget()
        keys, where, of = np.unique(word_hashes(low, starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        if len(self.keys):
            known = self.keys[np.minimum(at, len(self.keys) - 1)] == keys
        new = np.flatnonzero(~known)
        if len(new):
            raw, a, b = low.tobytes(), starts[where[new]].tolist(), ends[where[new]].tolist()
            found = self.library.encode_batch_fast([raw[s:e].decode() for s, e in zip(a, b)], add_special_tokens=False)
            ids = [e.ids for e in found]
            size = np.fromiter((len(x) for x in ids), np.int64, len(ids))
            start = len(self.flat) + np.cumsum(size) - size
            flat = np.fromiter((i for x in ids for i in x), np.uint32, int(size.sum()))
            self.flat = np.concatenate((self.flat, flat))
            self.keys = np.insert(self.keys, at[new], keys[new])
            self.start = np.insert(self.start, at[new], start)
            self.size = np.insert(self.size, at[new], size)
            at = np.searchsorted(self.keys, keys)
        size = self.size[at][of]
        total = np.concatenate(([0], np.cumsum(size)))
        pick = np.repeat(self.start[at][of] - total[:-1], size) + np.arange(total[-1])
        return self.flat[pick], total[np.searchsorted(starts, bounds)]


_encoders: dict[str, PartEncoder] = {}


def encoder(path: str) -> PartEncoder:
    if path not in _encoders:
        _encoders[path] = PartEncoder(path)
    return _encoders[path]


def token_pieces(docs: DataFrame, id_col: str, text_col: str, path: str, capacity: int = CAPACITY,
                 end_id: int = END, with_ids: bool = False) -> DataFrame:
    """Documents as pieces of at most ``capacity`` ids:
    (doc_id, start, length, ids_crc32, doc_tokens, doc_crc32[, ids])."""
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, doc_crc32 long"
    schema += ", ids array<int>" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            numbers = batch.column(0).to_pylist()
            for first, last in pieces(offsets, CHUNK_BYTES):
                base = offsets[first]
                ids, bounds = words.encode(data[base:offsets[last]], offsets[first:last + 1] - base)
                rows: list[tuple] = []
                for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    doc = np.append(ids[a:b], np.uint32(end_id))
                    raw, n, number = doc.astype("<u4").tobytes(), b - a + 1, numbers[first + k]
                    whole = zlib.crc32(raw)
                    for s in range(0, n, capacity):
                        part = raw[4 * s:4 * (s + capacity)]
                        row = (number, s, len(part) // 4, zlib.crc32(part), n, whole)
                        rows.append(row + (doc[s:s + capacity].astype(np.int32),) if with_ids else row)
                columns = list(zip(*rows))
                arrays = [pa.array(c, pa.int64()) for c in columns[:6]]
                if with_ids:
                    ends = np.cumsum([0, *map(len, columns[6])], dtype=np.int32)
                    arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(columns[6]))))
                yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in schema.split(", ")])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, schema)


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item; items come in decreasing order.

    A tournament tree holds the free capacity of every bin: each inner node
    has the larger of its two, so the first bin with room is one descent."""
    n = len(lengths)
    leaves = 1 << max(1, (n - 1).bit_length())
    tree = [capacity] * (2 * leaves)
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    for i, size in enumerate(lengths.tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - tree[node]
        tree[node] -= size
        node //= 2
        while node:
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
            node //= 2
    return bins, offsets


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
         capacity: int = CAPACITY, group_docs: int = GROUP_DOCS, seed: int = 7, with_ids: bool = False) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    Per piece: doc_id, start (its document's ids before it), length,
    ids_crc32, doc_tokens, sequence_id, offset (gapless from 0) and, with
    ``with_ids``, ids.  A longer document is cut at multiples of the capacity.
    A group holds ``group_docs`` documents on average, dealt by a seeded hash
    of id and content.

    A null or empty text is its end id alone; a null id stays null; repeated
    rows are packed each; an empty table gives an empty result.  Other
    columns of ``docs`` are not read.
    """
    prepare(docs.sparkSession)
    found = token_pieces(docs, id_col, text_col, vocabulary or default_vocabulary(), capacity, with_ids=with_ids)
    groups = max(1, -(-docs.count() // group_docs))
    names = [c for c in found.columns if c != "doc_crc32"] + ["sequence_id", "offset"]
    dealt = found.withColumn(
        "part", F.expr(f"pmod(xxhash64({int(seed)}, doc_id, doc_tokens, doc_crc32), {groups})"))

    def run(key, table):
        part = int(key[0].as_py())
        cols = [table.column(c).to_numpy() for c in ("start", "doc_id", "ids_crc32")]
        length = table.column("length").to_numpy()
        order = np.lexsort((*cols, -length))
        length = length[order]
        bins, offset = np.empty(len(order), np.int64), np.zeros(len(order), np.int64)
        full = int(np.searchsorted(-length, -capacity, side="right"))
        bins[:full] = np.arange(full)  # a full piece leaves no room: its sequence is its own
        rest, offset[full:] = first_fit_decreasing(length[full:], capacity)
        bins[full:] = rest + full
        out = table.drop_columns(["part", "doc_crc32"]).take(pa.array(order))
        return (out.append_column("sequence_id", pa.array((part << 32) + bins))
                .append_column("offset", pa.array(offset)).select(names))

    schema = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
              + ("ids array<int>, " if with_ids else "") + "sequence_id long, offset long")
    return dealt.groupBy("part").applyInArrow(run, schema)

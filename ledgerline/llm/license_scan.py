"""License scans: fuzzy search for short notices.

A notice may be found with up to ``k`` edits.  By the pigeonhole principle one
of its ``k + 1`` parts is then in the text unchanged, so an Aho-Corasick
automaton of all parts locates the candidates, and the ``regex`` library
verifies each with a bounded number of errors and tells the span.  The words
of a phrase that counts only when unchanged are a notice without edits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import pieces, text_buffer
from .plain_words import normalised
from .shared import prepare

# fixed values: (phrase, label), counted where the words stand unchanged
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)
# fixed values: (notice, label), found with edits; words as the operator reads them
NOTICES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("licensed under the gnu general public license", "gpl"),
    ("licensed under the gnu lesser general public license", "lgpl"),
    ("licensed under the gnu affero general public license", "agpl"),
    ("licensed under cc by nc", "cc-by-nc"),
    ("licensed under cc by sa", "cc-by-sa"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("subject to the terms of the mozilla public license", "mpl"),
    ("free and unencumbered software released into the public domain", "unlicense"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
)
#: Edits (inserted, deleted or changed bytes) allowed: one for so many bytes of a notice.
BYTES_PER_EDIT = 12
CHUNK_BYTES = 1 << 20
FINDING = "struct<label:string,notice:string,exact:boolean,first_word:bigint,last_word:bigint,edits:bigint,similarity:double>"


def parts(notice: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` parts of nearly equal length, with their offsets."""
    cuts = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    """Automaton and patterns of phrases and notices, built once a worker."""

    def __init__(self, phrases, notices, bytes_per_edit: int):
        import ahocorasick
        import regex

        self.items = [(p, label, 0) for p, label in phrases]
        self.items += [(n, label, len(n) // bytes_per_edit) for n, label in notices]
        self.exact = len(phrases)
        self.patterns = [regex.compile(f"(?b)(?:{regex.escape(n)}){{e<={k}}}") for n, _, k in self.items]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, (notice, _, k) in enumerate(self.items):
            for at, part in parts(notice, k):
                seeds.setdefault(part, []).append((i, at))
        self.automaton = ahocorasick.Automaton()
        for part, uses in seeds.items():
            self.automaton.add_word(part, (len(part), uses))
        self.automaton.make_automaton()

    def candidates(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(notice number, place where it would begin if nothing moved, place of the found part)."""
        for end, (size, uses) in self.automaton.iter(text):
            for i, at in uses:
                yield i, end + 1 - size - at, end

    def verified(self, text: str, first: int, last: int, places: dict[int, list[int]]) -> list[tuple]:
        """(notice number, start, end, edits) in ``text[first:last]``: all phrases,
        and of notices that overlap the best one."""
        exact, hits = [], []
        for i, begins in places.items():
            notice, _, k = self.items[i]
            starts = sorted(set(begins))
            n = 0
            while n < len(starts):
                group = starts[n]
                while n < len(starts) and starts[n] <= group + k:
                    n += 1
                low = max(first, group - k)
                high = min(last, starts[n - 1] + len(notice) + k)
                m = self.patterns[i].search(text, low, high)
                if m and i >= self.exact:
                    hits.append((i, m.start(), m.end(), sum(m.fuzzy_counts)))
                elif m and _whole_words(text, m.start(), m.end(), first, last):
                    exact.append((i, m.start(), m.end(), 0))
        return exact + self._best(hits)

    def _best(self, hits: list[tuple]) -> list[tuple]:
        """Of hits that overlap, the one with the smallest share of edits, then the longest notice."""
        kept: list[tuple] = []
        cluster: list[tuple] = []
        reach = -1

        def close() -> None:
            taken: list[tuple] = []
            for h in sorted(cluster, key=lambda h: (h[3] / len(self.items[h[0]][0]), -len(self.items[h[0]][0]), h[1], h[0])):
                if all(h[2] <= t[1] or t[2] <= h[1] for t in taken):
                    taken.append(h)
            kept.extend(taken)

        for h in sorted(hits, key=lambda h: (h[1], h[2], h[0])):
            if h[1] >= reach:
                close()
                cluster = []
            cluster.append(h)
            reach = max(reach, h[2])
        close()
        return kept


def _whole_words(text: str, start: int, end: int, first: int, last: int) -> bool:
    return (start == first or text[start - 1] == " ") and (end >= last or text[end] in " \n")


_scanners: dict[tuple, Scanner] = {}


def scanner(*key) -> Scanner:
    if key not in _scanners:
        _scanners[key] = Scanner(*key)
    return _scanners[key]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, notices=NOTICES,
         bytes_per_edit: int = BYTES_PER_EDIT) -> DataFrame:
    """(id, n_words, findings) of each row of ``docs``.

    findings, in order of place: label, notice, exact (a phrase that stands
    unchanged as whole words), first_word and last_word (words from 0), edits
    and similarity (1 - edits / bytes of the notice).  Every place of a phrase
    is one finding; of notices that overlap the one with the smallest share of
    edits, then the longest, is reported.  Whole texts are searched, and edits
    count bytes.

    A null or empty text has no words and no findings; a null id stays null;
    repeated rows are scanned each; an empty table gives an empty result.
    Other columns of ``docs`` are not read.
    """
    prepare(docs.sparkSession)
    key = (tuple(map(tuple, phrases)), tuple(map(tuple, notices)), bytes_per_edit)
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, n_words bigint, findings array<{FINDING}>"
    names = [f.split(":")[0] for f in FINDING[len("struct<"):-1].split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = scanner(*key)
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for first, last in pieces(offsets, CHUNK_BYTES):
                base = offsets[first]
                buffer, starts, ends, begins = normalised(data[base:offsets[last]], offsets[first:last + 1] - base)
                text = buffer.tobytes().decode("latin-1")  # one character a byte
                rows: list[list[tuple]] = [[] for _ in range(last - first)]
                edges = np.append(starts, len(buffer))[begins]
                for doc, of in _by_text(found.candidates(text), edges).items():
                    for i, a, b, edits in found.verified(text, int(edges[doc]), int(edges[doc + 1]) - 1, of):
                        notice, label, _ = found.items[i]
                        w0 = int(np.searchsorted(starts, a, side="right")) - 1
                        w1 = int(np.searchsorted(starts, b - 1, side="right")) - 1
                        at = int(begins[doc])
                        rows[doc].append((label, notice, i < found.exact, w0 - at, w1 - at, edits,
                                          1 - edits / len(notice)))
                cells = [[dict(zip(names, f)) for f in sorted(r, key=lambda f: (f[3], f[4], not f[2], f[0], f[1]))] for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(np.diff(begins)),
                     pa.array(cells, pa.list_(_FINDING_ARROW))], [id_col, "n_words", "findings"])

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


_FINDING_ARROW = pa.struct([("label", pa.string()), ("notice", pa.string()), ("exact", pa.bool_()),
                            ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int64()),
                            ("similarity", pa.float64())])


def _by_text(candidates: Iterator[tuple[int, int, int]], edges: np.ndarray) -> dict[int, dict[int, list[int]]]:
    """Candidates of each text of a buffer, per notice; a part lies in one text."""
    out: dict[int, dict[int, list[int]]] = {}
    found = list(candidates)
    if found:
        docs = np.searchsorted(edges, np.array([at for _, _, at in found]), side="right") - 1
        for doc, (i, begin, _) in zip(docs.tolist(), found):
            out.setdefault(doc, {}).setdefault(i, []).append(begin)
    return out


def labels(exact_only: bool = False) -> Column:
    """Distinct labels of ``findings``, sorted, comma-joined."""
    f = F.filter("findings", lambda x: x["exact"]) if exact_only else F.col("findings")
    return F.array_join(F.array_sort(F.array_distinct(F.transform(f, lambda x: x["label"]))), ",")

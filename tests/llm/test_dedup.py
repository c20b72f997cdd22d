"""Recurring windows and near-duplicates against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from ledgerline.llm import near_dedup, repeats, substring_dedup, suffix_dedup
from ledgerline.llm.arrays import U, mix
from ledgerline.llm.components import components

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, n_removed long, kept boolean, block long"


def corpus(seed=3):
    """Texts with copies, shared passages, runs, nulls, empty and long texts, repeated and missing ids."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdé") for _ in range(r.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, line = prose(40), "All rights reserved by the\tpublisher.\n"
    texts = [prose(r.randint(0, 120)) for _ in range(30)]
    texts += [prose(20) + " " + passage + " " + prose(15) for _ in range(6)]
    texts += [texts[3]] * 4 + [line + texts[5], line + texts[6] + line, line * 12]
    texts += ["a" * 700, "a" * 250 + "b", "x y " * 90, "x " * 60, "the same " * 3, "  \n\t ", "", None, "one", "one"]
    texts += [texts[31].replace("a", "c", 3), prose(6000), "é" * 130]
    rows = [(3 * i % 101, t, 1, True, 5) for i, t in enumerate(texts)]
    return rows + [rows[3], (None, passage, 1, True, 5), (None, None, 1, True, 5)]


def removed_bytes(docs, window=100):
    first, order = {}, lambda i: (i is None, i or 0)
    for i, t in docs:
        b = (t or "").encode()
        for s in range(len(b) - window + 1):
            k, v = b[s:s + window], (order(i), s)
            first[k] = min(first.get(k, v), v)
    out = []
    for i, t in docs:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - window + 1):
            if first[b[s:s + window]] < (order(i), s):
                gone[s:s + window] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def removed_words(docs, window=13):
    big, first = 1 << 63, {}
    split = [(big if i is None else i, i, WORDS.findall(t or "")) for i, t in docs]
    for n, _, w in split:
        for s in range(len(w) - window + 1):
            k = tuple(w[s:s + window])
            first[k] = min(first.get(k, n), n)
    out = []
    for n, i, w in split:
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < n:
                gone[s:s + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("limits", [{}, {"BLOCK_BYTES": 900, "STRETCH": 300, "HOT_PHRASES": 2, "SORT_BYTES": 3000}])
def test_suffix_dedup_is_exact(spark, monkeypatch, limits):
    for k, v in limits.items():
        monkeypatch.setattr(repeats, k, v)
    data = corpus()
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    got = rows_of(suffix_dedup.remove_repeats(df))
    assert got == removed_bytes([r[:2] for r in data])
    kept = suffix_dedup.remove_repeats(df, with_kept=True).collect()
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in kept)


@pytest.mark.parametrize("limits", [{}, {"BLOCK_BYTES": 900, "STRETCH": 40, "HOT_PHRASES": 2, "SORT_BYTES": 3000}])
def test_substring_dedup_is_exact(spark, monkeypatch, limits):
    for k, v in limits.items():
        monkeypatch.setattr(repeats, k, v)
    data = corpus(4)
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    want = removed_words([r[:2] for r in data])
    assert rows_of(substring_dedup.remove_repeated_words(df)) == want
    left = substring_dedup.without_repeated_words(df)
    assert left.columns == df.columns
    words = sorted(((r.doc_id, hashlib.sha256(" ".join(WORDS.findall(r.text)).encode()).hexdigest())
                    for r in left.collect()), key=repr)
    assert words == sorted(((w[0], w[3]) for w in want), key=repr)


@pytest.mark.parametrize("hot", [2048, 1])
def test_copies_within_a_document_share_its_verdict(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_PHRASES", hot)
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    prose = lambda n: " ".join(word() for _ in range(n))
    data = []
    for k in range(12):  # an earlier document holds a part of what a later one says twice
        passage = prose(60)
        data.append((2 * k, prose(5) + " " + " ".join(passage.split()[:30 + k]) + " " + prose(5)))
        data.append((2 * k + 1, " ".join([passage, prose(9), passage, prose(7)])))
    data.append(data[-1])
    df = spark.createDataFrame(data, "doc_id long, text string").coalesce(1)
    assert rows_of(substring_dedup.remove_repeated_words(df)) == removed_words(data)
    assert rows_of(suffix_dedup.remove_repeats(df)) == removed_bytes(data)


def test_recompression_names_equal_substrings_alike():
    r = random.Random(1)
    values = mix(np.array([r.randint(0, 5) for _ in range(4000)], dtype=np.int64).view(U))
    copy = np.concatenate((mix(np.arange(77).astype(U)), values[500:900], mix(np.arange(50, 90).astype(U))))
    a, n = substring_dedup.symbols_as_anchors(values, 13)
    b, m = substring_dedup.symbols_as_anchors(copy, 13)
    inside = np.arange(500, 900 - 12)
    assert (a[inside] - inside == b[inside - 423] - (inside - 423)).all() and (n[inside] == m[inside - 423]).all()


def test_trigger_lies_in_its_window_and_follows_content():
    data = np.frombuffer(b"abcab" * 30 + bytes(range(200)) + b"z" * 300, np.uint8)
    values, _, _ = suffix_dedup._read(data, np.array([0, len(data)]))
    anchor, name = suffix_dedup.triggers(values, 100)
    at = np.arange(len(anchor))
    assert (anchor >= at).all() and (anchor + suffix_dedup.TRIGGER <= at + 100).all()
    again, same = suffix_dedup.triggers(values[37:], 100)
    assert (again == anchor[37:] - 37).all() and (same == name[37:]).all()


def brute_components(docs, words, percent):
    sets = []
    for i, t in docs:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = WORDS.findall(low)
        k = min(words, len(w))
        sets.append((i, {tuple(w[s:s + k]) for s in range(len(w) - k + 1)} if w else set()))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            (i, a), (j, b) = sets[x], sets[y]
            near = a and b and 100 * len(a & b) >= percent * len(a | b)
            if near or i is not None and i == j:
                root[find(x)] = find(y)
    low = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            low[find(x)] = min(low.get(find(x), i), i)
    return sorted(((i, len(s), low.get(find(x))) for x, (i, s) in enumerate(sets)), key=repr)


def near_corpus():
    r = random.Random(9)
    word = lambda: r.choice("abcdefgh") * r.randint(1, 3) + r.choice("xyz")
    base = [[word() for _ in range(120)] for _ in range(8)]
    rows = []
    for i in range(70):
        w = list(base[i % 8])
        for _ in range(r.choice([0, 0, 1, 2, 4, 9, 30])):
            w[r.randrange(len(w))] = word().upper()
        rows.append((i * 7 % 71, " ".join(w)))
    w = list(base[0])
    for i in range(60):  # one large chain: each differs from the one before
        w[2 * i % len(w)] = f"new{i}"
        rows.append((200 + i, " ".join(w)))
    rows += [(300, None), (301, " "), (302, ""), (303, "single"), (304, "Single"), (305, "single two"),
             (None, rows[5][1]), (None, "nobody else says this"), (None, None), rows[5], (306, "a b " * 500)]
    return rows


@pytest.mark.parametrize("region", [24, 3])
def test_near_duplicates_are_exact(spark, monkeypatch, region):
    monkeypatch.setattr(near_dedup, "REGION", region)
    data = near_corpus()
    df = spark.createDataFrame([(i, t, 1, True) for i, t in data], "doc_id long, text string, node long, kept boolean")
    got = near_dedup.near_duplicates(df, words=2).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute_components(data, 2, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)


def test_representatives_keep_one_of_each_group(spark):
    data = near_corpus()
    df = spark.createDataFrame(data, "doc_id long, text string")
    kept = near_dedup.representatives(df, words=2).collect()
    want = brute_components(data, 2, 80)
    groups = {c for i, n, c in want if n and c is not None}
    assert {r.doc_id for r in kept if r.text and r.text.strip() and r.doc_id is not None} == groups
    assert any(r.doc_id is None and r.text and r.text.startswith("nobody") for r in kept)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (500, 400)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect())
    assert all(got[i] == 1 for i in range(1, 41)) and all(got[i] == 100 for i in range(100, 130)) and got[500] == 400


@pytest.mark.parametrize("run", [suffix_dedup.remove_repeats, substring_dedup.remove_repeated_words,
                                 substring_dedup.without_repeated_words, near_dedup.near_duplicates,
                                 near_dedup.representatives])
def test_empty_tables(spark, run):
    assert run(spark.createDataFrame([], SCHEMA)).collect() == []


def test_carried_columns_keep_their_values(spark):
    import datetime as dt
    import decimal

    from pyspark.sql import functions as F

    words = " ".join(f"w{i}" for i in range(20))
    at = dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    rows = [(i, words + f" x{i}", at, at, dt.date(2024, 1, 2), decimal.Decimal("1.23"), float("nan") if i else 0.1, [1, None], b"\x00\xff", i == 1, None)
            for i in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, t timestamp, n timestamp_ntz, d date, m decimal(9,2), f double, a array<int>, "
                                     "b binary, carried boolean, nothing string")
    got = substring_dedup.without_repeated_words(df)
    assert got.schema == df.schema
    plain = lambda d: sorted(map(repr, d.drop("text").collect()))
    assert plain(got) == plain(df)
    assert [r.text for r in got.orderBy("doc_id").select(F.trim("text").alias("text")).collect()] == [words + " x0", "x1"]

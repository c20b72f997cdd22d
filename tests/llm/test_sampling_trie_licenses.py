"""Importance resampling, prefix trie and license scans against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import regex
import xxhash

from ledgerline.llm import importance, license_scan, ngram_table, plain_words, prefix_trie

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ODD = [None, "", "  \n\t ", "A b A b a", "One two, THREE-four_five. six", "É é 字字 １２ x\x7fy 🙂🙂ok", "é" * 40 + " " + "é" * 40,
       "a" * 70 + " " + "a" * 70 + "b " + "a" * 70, "word " * 4000, "x", "1 2 3", "trail ", " lead", "Ö ö Z[z]{y}"]


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def words(t):
    return WORD.findall(low(t))


def table(spark, texts, extra=()):
    rows = [(i, t, "s", 1.0, 7) for i, t in enumerate(texts)] + [(i, t, None, None, None) for i, t in extra]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words string, score double, rank long")


# n-gram table

def test_normalised_words():
    raw = [(t or "").encode() for t in ODD]
    bounds = np.cumsum([0] + [len(x) for x in raw])
    buffer, starts, ends, begins = plain_words.normalised(np.frombuffer(b"".join(raw), np.uint8), bounds)
    text = buffer.tobytes()
    for i, t in enumerate(ODD):
        assert [text[a:b].decode() for a, b in zip(starts[begins[i]:begins[i + 1]], ends[begins[i]:begins[i + 1]])] == words(t)
    assert text.count(b"\n") == sum(bool(words(t)) for t in ODD)


def test_table_hashes_and_interns():
    r = random.Random(1)
    raw = bytes(r.randrange(3) for _ in range(5000))
    start = np.array([r.randrange(4800) for _ in range(3000)])
    size = np.array([r.choice([1, 2, 3, 4, 7, 8, 9, 15, 16, 24, 31, 32, 33, 64, 65, 150]) for _ in range(3000)])
    text = ngram_table.Bytes(np.frombuffer(raw, np.uint8))
    grams = [raw[a:a + n] for a, n in zip(start, size)]
    assert text.xxhash64(start, size).tolist() == [xxhash.xxh64_intdigest(g) for g in grams]
    assert text.crc32(start, size).tolist() == [zlib.crc32(g) for g in grams]
    slot, owner = ngram_table.intern(text, start, size)
    named = {}
    for g, s in zip(grams, slot.tolist()):
        assert named.setdefault(g, s) == s and grams[owner[s]] == g
    assert len(set(named.values())) == len(named) == (owner >= 0).sum()


def test_table_tells_equal_keys_apart(monkeypatch):
    monkeypatch.setattr(ngram_table.Bytes, "xxhash64", lambda self, start, size: np.full(len(start), 5, np.uint64))
    raw = np.frombuffer(b"abcabdabcxyzabcd" + b"q" * 80 + b"z" + b"q" * 80, np.uint8)
    start, size = np.array([0, 3, 6, 9, 12, 12, 16, 97, 17]), np.array([3, 3, 3, 3, 3, 4, 80, 80, 79])
    slot, owner = ngram_table.intern(ngram_table.Bytes(raw), start, size)
    assert slot[0] == slot[2] == slot[4] and slot[6] == slot[7] and len(set(slot.tolist())) == 6 == (owner >= 0).sum()


# importance resampling

def drawn(rows, target, share, least, buckets, seed):
    grams = lambda t: [w for w in words(t)] + [" ".join(p) for p in zip(words(t), words(t)[1:])]
    count = lambda texts: np.bincount([zlib.crc32(g.encode()) % buckets for t in texts for g in grams(t)], minlength=buckets)
    s, t = count([x for _, x in rows]), count(target)
    gain = [math.floor(1000 * math.log((int(b) + 1) * (int(s.sum()) + buckets) / ((int(a) + 1) * (int(t.sum()) + buckets))))
            for a, b in zip(s, t)]
    out = []
    for i, text in rows:
        g = [gain[zlib.crc32(x.encode()) % buckets] for x in grams(text)]
        weight = sum(g) // len(g) if g else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(words(text)), len(g), weight, score, None])
    able = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], x[0] is None, x[0] or 0, -x[3], -x[2]))
    for k, x in enumerate(able[:share * len(able) // 100]):
        x[5] = k + 1
    return out


def test_resampling_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(importance, "CHUNK_BYTES", 300)
    r = random.Random(3)
    texts = ODD + [" ".join(r.choice("the of and License é x1 y2 z3".split()) for _ in range(r.randint(0, 60))) for _ in range(150)]
    extra = [(None, "no id " * 12), (3, "again the same id " * 9), (20, texts[20]), (20, texts[20])]
    target = ["the License of the é", None, "", "and x1 and"]
    docs = table(spark, texts, extra)
    cols = ("doc_id", "n_words", "n_features", "weight", "score", "rank")
    for share, least, buckets in ((25, 20, 10000), (100, 0, 7)):
        got = importance.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), share=share,
                                  least_words=least, buckets=buckets)
        assert set(got.columns) == set(cols)
        want = drawn(list(enumerate(texts)) + extra, target, share, least, buckets, 7)
        assert sorted((tuple(x[c] for c in cols) for x in got.collect()), key=repr) == sorted(map(tuple, want), key=repr)


def test_resampling_odd_tables(spark):
    none = spark.createDataFrame([], "text string")
    assert importance.resample(table(spark, []), none).collect() == []
    got = importance.resample(table(spark, ["a b c"] * 8), none, least_words=1).collect()
    assert sorted(x.rank for x in got if x.rank) == [1, 2] and len({x.weight for x in got}) == 1


def test_resampling_long_text(spark):
    r = random.Random(5)
    text = " ".join(r.choice(["alpha", "beta", "gamma", "字" * 12]) for _ in range(400_000))
    texts = [text, "z" * 3_000_000, "alpha"]
    got = importance.resample(table(spark, texts), table(spark, ["alpha"])).collect()
    want = drawn(list(enumerate(texts)), ["alpha"], 25, 20, 10000, 7)
    assert sorted((x.doc_id, x.n_words, x.n_features, x.weight, x.score, x.rank) for x in got) == [tuple(x) for x in want]


# prefix trie

def rebuilt(rows, base_of, kept):
    own = {}
    for c, turn, role, text in sorted((x for x in rows if x[0] is not None), key=lambda x: (
            x[1] is not None, x[1] or 0, x[2] or "", hashlib.md5((x[3] or "").encode()).digest())):
        own.setdefault(c, []).append((role or "", text or ""))
    return {c: own.get(base_of(c), [])[:kept(c)] + t[kept(c):] for c, t in own.items()}


def nodes(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for path in members:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        k = kids.get(path, [])
        leaves[path] = sum(leaves[x] for x in k) or 1
        saved[path] = sum(saved[x] for x in k) + (len(members[path]) - 1) * (len(path[-1][1].encode()) if path else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(kids.get(p, [])), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p)).encode()).hexdigest())
                  for p, m in members.items())


def collected(df):
    return sorted((x.conv_id, x.depth, -1 if x.parent_conv_id is None else x.parent_conv_id, x.n_convs, x.n_children, x.n_leaves,
                   x.saved_tokens, x.ends_sha256) for x in df.collect())


def conversations(spark, rows):
    return spark.createDataFrame([(*x, 1, "c") for x in rows], "conv_id long, turn long, role string, text string, depth int, conv string")


@pytest.mark.parametrize("piece", [25, 100_000])
def test_trie_against_brute_force(spark, monkeypatch, piece):
    from pyspark.sql import functions as F

    monkeypatch.setattr(prefix_trie, "BLOCK", 3)
    monkeypatch.setattr(prefix_trie, "IDS", 2)
    r = random.Random(8)
    rows = [(c, t, r.choice(["user", "assistant", None]), r.choice(["a", "b", "é", "", None])) for c in range(60)
            for t in range(r.randint(1, 7))]
    rows += [(c, t, "user", "same") for c in range(100, 112) for t in range(4)]  # copies
    rows += [(200, t, "user", f"t{t % 3}") for t in range(70)] + [(201, t, "user", f"t{t % 3}") for t in range(50)]  # long ones
    rows += [(5, None, "user", "first"), (5, 1, "user", "tie"), (5, 1, "user", "tie"), (None, 1, "user", "of none"), (None,) * 4]
    kept = lambda c: zlib.crc32(str(c).encode()) % 9
    conv = F.col("conv")
    got = prefix_trie.prefix_trie(conversations(spark, rows), base_of=conv - conv % 5,
                                  kept=F.crc32(conv.cast("string").cast("binary")) % 9, most=8, piece=piece)
    assert collected(got) == nodes(rebuilt(rows, lambda c: c - c % 5, kept))


def test_trie_of_plain_and_empty_conversations(spark):
    rows = [(1, 0, "u", "x"), (2, 0, "u", "x"), (2, 1, "a", "y"), (3, 0, "u", "z")]
    assert collected(prefix_trie.prefix_trie(conversations(spark, rows))) == nodes(rebuilt(rows, lambda c: c, lambda c: 0))
    assert prefix_trie.prefix_trie(conversations(spark, [])).collect() == []


def test_decomposition_sums_subtrees():
    r = random.Random(2)
    for shape in (lambda i: r.randrange(i), lambda i: i - 1, lambda i: max(0, i - 1 - r.randrange(3)), lambda i: 0):
        n = 300
        parent = np.array([0] + [shape(i) for i in range(1, n)])
        depth, own = np.zeros(n, np.int64), np.array([r.randint(1, 5) for _ in range(n)])
        for i in range(1, n):
            depth[i] = depth[parent[i]] + 1
        value = np.array([r.randint(0, 9) for _ in range(n)])
        weight, want = own.copy(), value.copy()
        for i in range(n - 1, 0, -1):
            weight[parent[i]] += weight[i]
            want[parent[i]] += want[i]
        assert prefix_trie.decompose(parent, depth, weight, [value])[0].tolist() == want.tolist()


# license scans

def exact_places(text, phrases):
    w = words(text)
    return sorted((i, label) for phrase, label in phrases for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split())


def fuzzy_labels(text, notices, bytes_per_edit):
    """Brute force: the whole text against each notice, without seeds."""
    flat = " ".join(words(text)).encode().decode("latin-1")
    hits = []
    for n, label in notices:
        k = len(n) // bytes_per_edit
        hits += [(sum(m.fuzzy_counts) / len(n), -len(n), m.start(), m.end(), label)
                 for m in regex.finditer(f"(?b)(?:{regex.escape(n)}){{e<={k}}}", flat, overlapped=True)]
    kept = []
    for h in sorted(hits):
        if all(h[3] <= a or b <= h[2] for a, b in kept):
            kept.append((h[2], h[3]))
            yield h[4], 1 - h[0]


def mangled(r, notice, edits):
    s = list(notice)
    for _ in range(edits):
        i = r.randrange(len(s))
        kind = r.randrange(3)
        if kind == 0:
            s[i] = r.choice("qxz")
        elif kind == 1:
            s.insert(i, r.choice("qxz"))
        elif len(s) > 1:
            del s[i]
    return "".join(s)


def license_texts():
    r = random.Random(11)
    filler = lambda: " ".join(r.choice("lorem ipsum licensed under the terms public mit permission gnu".split()) for _ in range(r.randint(0, 9)))
    texts = ODD + ["MIT License MIT-license, mit licenses", "The GNU General\nPublic   License!", "general public licen se", "mit license"]
    for notice, _ in license_scan.NOTICES:
        k = len(notice) // license_scan.BYTES_PER_EDIT
        texts += [f"{filler()}. {mangled(r, notice, e).title()} - {filler()}" for e in range(k + 1) for _ in range(3)]
    return texts + [filler() for _ in range(40)]


def test_license_scan_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(license_scan, "CHUNK_BYTES", 500)
    texts = license_texts()
    extra = [(None, "the mit license"), (3, "the mit license"), (3, "the mit license")]
    got = license_scan.scan(table(spark, texts, extra)).collect()
    assert len(got) == len(texts) + 3
    wanted = sorted([(i, t) for i, t in enumerate(texts)] + extra, key=repr)
    by_id = {}
    for row in got:
        by_id.setdefault(row.doc_id, []).append(row)
    for i, text in wanted:
        found = [x for x in by_id[i] if x.n_words == len(words(text))]
        row = found[0]
        assert sorted((f.first_word, f.label) for f in row.findings if f.exact) == exact_places(text, license_scan.PHRASES)
        brute = list(fuzzy_labels(text, license_scan.NOTICES, license_scan.BYTES_PER_EDIT))
        fuzzy = [f for f in row.findings if not f.exact]
        assert {f.label for f in fuzzy} == {label for label, _ in brute}
        assert not brute or max(f.similarity for f in fuzzy) == pytest.approx(max(s for _, s in brute))
        assert all(0 <= f.first_word <= f.last_word < row.n_words for f in row.findings)


def test_license_scan_reports_places(spark):
    text = "x " * 500_000 + "Relaesed under the MIT License. " + "y " * 500_000
    row = license_scan.scan(table(spark, [text])).first()
    assert row.n_words == 1_000_005
    assert [(f.label, f.exact, f.first_word, f.last_word, f.edits) for f in row.findings] == [
        ("mit", False, 500_000, 500_004, 2), ("mit", True, 500_003, 500_004, 0)]
    assert license_scan.scan(table(spark, [])).collect() == []


def test_registered_license_query(spark):
    from ledgerline.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = {x.doc_id: x.text for x in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {x.doc_id: x for x in QUERIES["op13_license_scan"](spark, sf).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        places = exact_places(t, license_scan.PHRASES)
        first = [p for p, _ in places]
        brute = list(fuzzy_labels(t, license_scan.NOTICES, license_scan.BYTES_PER_EDIT))
        base = {x for _, x in places}
        assert (got[i].n_words, got[i].n_base, got[i].first_word, got[i].last_word, got[i].base_labels, got[i].labels) == (
            len(words(t)), len(first), min(first, default=None), max(first, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | {x for x, _ in brute})))

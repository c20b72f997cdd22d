"""Chat, SentencePiece, fingerprints, quality, HTML, language, packing."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from ledgerline.llm import chat, html_text, language, order_minhash, packing, quality, sentence_bpe

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [
    "Plain words, and plain words again.", None, "", "   \n\t ", "don't I'VE x's 'stop ÀÉÎ Straße!", "İstanbul ΣΑΣ é", "ａ　b",
    "<|endoftext|>ab <|ENDOFTEXT|> x<|y", "é—x, “quoted” 字字 １２ ½ 🙂🙂ok __init__ $$$%% 12ab34", "a b c", "▁ sign ▁▁x",
    "lead  double   triple    spaces ", "\x00\x01 control \x1f", "x" * 700 + " " * 60 + "yz" * 300, "word " * 3000, "one",
    "line\r\nline\n\nline"]


def docs(spark, texts=TEXTS, extra=True):
    rows = [(i, t, "en", "h", 0, 0.5) for i, t in enumerate(texts)]
    rows += [(None, "no id here", None, None, None, None), (2, "same id", "de", "h", 1, 0.5), rows[0], rows[0]] if extra else []
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double")


# chat

def fold(events):
    """Brute force: replay each conversation."""
    order = {"message": 0, "edit": 1, "regenerate": 2, "delta": 3}
    state = {}
    for conv, seq, kind, message, role, text in sorted(events, key=lambda e: (repr(e[0]), e[1], order[e[2]], e[5] or "")):
        said = state.setdefault(conv, {})
        text = text or ""
        if kind == "regenerate":
            for m in [m for m in said if m > message]:
                del said[m]
        if kind == "delta" and message in said:
            said[message] = (role, said[message][1] + text)
        else:
            said[message] = (role, text)
    return {c: [s[m] for m in sorted(s)] for c, s in state.items() if s}


def test_chat_folds_and_reads_back(spark):
    r = random.Random(5)
    signs = ["\\", "<", "#", ":", "### ", " </turn>\n", ": ", "\\l", "\\\\h", "é🙂", "a", ""]
    events = []
    for conv in (1, 2, 3, None):
        for seq in range(60):
            events.append((conv, seq, r.choice(["message", "delta", "delta", "edit", "regenerate"]), r.randint(0, 6),
                           r.choice(["user", "assistant", "a:b #"]), "".join(r.choice(signs) for _ in range(r.randint(0, 5)))))
    df = spark.createDataFrame(events, "conv_id long, seq long, kind string, message long, role string, text string")
    back = chat.read_back(chat.render(chat.fold_events(df))).collect()
    got = {x.conv_id: [(t.role, t.text) for t in x.turns] for x in back}
    assert got == fold(events)
    for x in back:
        assert list(x.losses) == [t.text for t in x.turns if t.role == "assistant"]


def test_chat_nulls_ties_and_empty(spark):
    schema = "conv_id long, seq long, kind string, message long, role string, text string"
    rows = [(None,) * 6, (1, 1, "delta", 1, None, "q"), (1, 1, "delta", 1, None, "q"), (2, 1, "message", 1, "user", None)]
    got = {(m.conv_id, m.message): (m.role, m.text) for m in chat.fold_events(spark.createDataFrame(rows, schema)).collect()}
    assert got == {(None, 0): ("unknown", ""), (1, 1): ("unknown", "qq"), (2, 1): ("user", "")}
    assert chat.render(chat.fold_events(spark.createDataFrame([], schema))).collect() == []


# SentencePiece

def test_sentencepiece_without_dropout_is_the_library(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=sentence_bpe.default_vocabulary())
    texts = [t for t in TEXTS if not t or "▁" not in t]
    got = sentence_bpe.encode(docs(spark, texts, False), rate=0).collect()
    for r in got:
        assert list(r.ids) == (sp.encode(r.text) if r.text else [])


def test_sentencepiece_dropout_varies_and_decodes(spark):
    one, same, other = (sentence_bpe.encode(docs(spark), seed=s, rate=0.3) for s in (1, 1, 2))
    ids = [sorted(((r.doc_id, r.text, tuple(r.ids)) for r in e.collect()), key=repr) for e in (one, same, other)]
    assert ids[0] == ids[1] and ids[0] != ids[2]
    for e in (one, other):
        assert all(r.decoded == (r.text or "") for r in sentence_bpe.decode(e, keep=("doc_id", "text")).collect())
    assert sentence_bpe.encode(docs(spark, [], False)).collect() == []


def test_sentencepiece_heap_and_steps_agree():
    v = sentence_bpe.vocabulary(sentence_bpe.default_vocabulary())
    r = random.Random(2)
    words = ["".join(r.choice("abcdehilmnorst") for _ in range(r.randint(1, 46))) for _ in range(200)]
    data = np.frombuffer("".join(words).encode(), np.uint8)
    bounds = np.cumsum([0] + [len(w) for w in words])
    keys = sentence_bpe.mix(np.arange(len(words)).astype(np.uint64))
    ids, at = sentence_bpe.encode_buffer(data, bounds, keys, v, 0.2)
    limit = np.uint64(0.2 * float((1 << 64) - 2048))
    for k, w in enumerate(words):
        key = sentence_bpe.mix(keys[k:k + 1].copy())[0]
        assert sentence_bpe._heap(v.chars[[ord(c) for c in " " + w]].tolist(), key, v, limit) == ids[at[k]:at[k + 1]].tolist()


# fingerprints

def test_edited_texts_and_equal_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(order_minhash, "BUCKET_DOCS", 4)
    texts = [t for t in TEXTS if t != ""] + [" ".join(f"w{i * k % 37}" for i in range(200)) for k in range(1, 9)] + ["is it " * 400, "is it " * 600]
    got = order_minhash.fingerprints(docs(spark, texts, False)).collect()
    by = {r.doc_id: r for r in got}
    ids = sorted(by, reverse=True)
    assert ids == list(range(len(texts) - 1, -1, -1))
    for k, i in enumerate(ids):
        text, nxt = texts[i] or "", texts[ids[(k + 1) % len(ids)]] or ""
        cut = len(text) // 3
        assert by[i].edited == text[:len(text) - cut] + nxt[:cut] and by[i].next_text == nxt
    prints = {}
    for r in got:
        prints.setdefault(r.text, []).append(r.print)
    assert all(len(set(map(tuple, p))) == 1 for p in prints.values())
    assert by[len(texts) - 1].print != by[len(texts) - 2].print  # more occurrences


def test_a_far_off_id_leaves_the_ranges_even(spark, monkeypatch):
    monkeypatch.setattr(order_minhash, "BUCKET_DOCS", 10)
    ids = [*range(200), 10 ** 12, -(10 ** 15)]
    df = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string")
    edges = order_minhash._range_edges(df.withColumnRenamed("doc_id", "id"), 21)
    sizes = df.withColumnRenamed("doc_id", "id").groupBy(order_minhash._range_of(edges)).count().collect()
    assert len(sizes) >= 20 and max(r["count"] for r in sizes) <= 20
    down = sorted(ids, reverse=True)
    after = dict(zip(down, [*down[1:], down[0]]))
    assert all(r.next_text == f"text {after[r.doc_id]}" for r in order_minhash.fingerprints(df).collect())


def _xxhash(values):
    """Spark's xxhash64 of longs (seed 42, one after the other)."""
    m = (1 << 64) - 1
    rot = lambda x, r: ((x << r) | (x >> (64 - r))) & m
    p1, p2, p3, p4, p5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
    h = 42
    for v, size in values:
        if size == 8:
            h = (h + p5 + 8) & m
            h ^= rot((v & m) * p2 & m, 31) * p1 & m
            h = (rot(h, 27) * p1 + p4) & m
        else:
            h = (h + p5 + 4) & m
            h ^= (v & 0xFFFFFFFF) * p1 & m
            h = (rot(h, 23) * p2 + p3) & m
        h ^= h >> 33
        h = h * p2 & m
        h ^= h >> 29
        h = h * p3 & m
        h ^= h >> 32
    return h - (1 << 64) if h >> 63 else h


def brute_print(text):
    """Numbered 3-mers of words, 32 bins, the two smallest of each in text order."""
    import xxhash

    name = lambda w: (lambda h: h - (1 << 64) if h >> 63 else h)(xxhash.xxh64_intdigest(w.encode(), seed=42))
    names = [name(w) for w in WORDS.findall(text or "")]
    if len(names) >= 3:
        kmers = [_xxhash([(x, 8) for x in names[i:i + 3]]) for i in range(len(names) - 2)]
    else:
        kmers = [_xxhash([(x, 8) for x in names])] if names else []
    seen, bins = {}, {}
    for at, k in enumerate(kmers):
        u = _xxhash([(k, 8), (seen.get(k, 0), 4)])
        seen[k] = seen.get(k, 0) + 1
        bins.setdefault((u % (1 << 64)) >> 59, []).append((u, at))
    out = []
    for b, items in bins.items():
        low = sorted(sorted(items)[:2], key=lambda x: x[1])
        out.append((b, _xxhash([(u, 8) for u, _ in low])))
    return sorted(out)


def test_fingerprint_against_brute_force(spark):
    r = random.Random(9)
    texts = [*TEXTS, "a b c a b c a b c a b", "one two"] + [" ".join(r.choice("ab cd ef gh".split()) for _ in range(r.randint(0, 90))) for _ in range(40)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for row in order_minhash.fingerprint(df, "text", "p").collect():
        assert sorted((x.bin, x.hash) for x in row.p) == brute_print(row.text)


def test_fingerprint_is_sensitive_to_order(spark):
    from pyspark.sql import functions as F

    a = " ".join(f"w{i}" for i in range(300))
    blocks = [a.split()[k:k + 30] for k in range(0, 300, 30)]
    b = " ".join(w for x in reversed(blocks) for w in x)  # the same k-mers but for the seams
    df = order_minhash.fingerprint(order_minhash.fingerprint(spark.createDataFrame([(a, b)], "a string, b string"), "a", "pa"), "b", "pb")
    near = df.select(order_minhash.likeness("pa", "pb").alias("x"), order_minhash.likeness("pa", "pa").alias("y")).first()
    assert near.x < 0.75 and near.y == 1.0
    assert df.select(F.size("pa")).first()[0] > 20


def test_fingerprints_of_odd_tables(spark):
    got = order_minhash.fingerprints(docs(spark)).collect()
    assert len(got) == len(TEXTS) + 4
    alone = order_minhash.fingerprints(docs(spark, ["only one here"], False)).collect()
    assert alone[0].next_text == "only one here" == alone[0].edited[:0] + alone[0].next_text
    assert order_minhash.fingerprints(docs(spark, [], False)).collect() == []


# quality

def base(text):
    t = text or ""
    w = WORDS.findall(t)
    lines, seen, dup = t.split("\n"), set(), 0
    for x in lines:
        if WORDS.search(x):
            dup += x in seen
            seen.add(x)
    count = {}
    for i in range(len(w) - 2):
        count[tuple(w[i:i + 3])] = count.get(tuple(w[i:i + 3]), 0) + 1
    hit = set()
    for i in range(len(w) - 2):
        if count[tuple(w[i:i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(hit), failed)


def test_quality_base_columns_and_boilerplate(spark):
    r = random.Random(4)
    fresh = lambda n: " ".join("".join(r.choices("abcdefgh", k=7)) for _ in range(n))
    texts = [t for t in TEXTS if t is None or len(t) < 3000]
    menu = "home | about us | contact | terms and conditions of use | privacy policy | imprint | help and support"
    site = [fresh(60) + "\n" + menu.replace("|", "  |") for _ in range(25)] + ["\n".join([menu] * 6) + "\n" + fresh(4)]
    site += [fresh(80) for _ in range(10)] + ["x y z " * 40, *texts]
    copies = [fresh(70)] * 30
    rows = [(i, t, "site") for i, t in enumerate(site)] + [(100 + i, t, "copies") for i, t in enumerate(copies)]
    rows += [(None, fresh(55), None), rows[0]]
    df = spark.createDataFrame([(*x, 0, False) for x in rows], "doc_id long, text string, source string, n_chars long, kept boolean")
    got = quality.judge(df).collect()
    assert len(got) == len(rows)
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted(((x.doc_id, *(x[c] for c in columns)) for x in got), key=repr) == sorted(((i, *base(t)) for i, t, _ in rows), key=repr)
    by = {x.doc_id: x for x in got}
    assert by[1].lines_removed == [1] and by[1].kept and by[1].boilerplate_words == len(WORDS.findall(menu))
    assert not by[25].kept and all(by[100 + i].kept for i in range(30)) and by[None].kept
    left = quality.clean(df).collect()
    assert left[0].asDict().keys() == df.first().asDict().keys()
    assert {x.doc_id for x in left} == {x.doc_id for x in got if x.kept}
    assert all(len(x.text) == x.n_chars and "contact" not in x.text for x in left)
    assert quality.judge(df.limit(0)).collect() == [] == quality.clean(df.limit(0)).collect()


def test_cleaning_removes_lines_that_many_documents_of_a_large_host_hold(spark):
    r = random.Random(6)
    fresh = lambda n: " ".join("".join(r.choices("abcdefgh", k=7)) for _ in range(n))
    licence, seldom = "all rights reserved by the owners of this site", "see you next week"
    rows = [(i, fresh(30) + "\n" + (licence + "\n" if i < 45 else "") + fresh(30) + ("\n" + seldom if i % 30 == 0 else ""))
            for i in range(450)]  # 10 % and 3 % of the host's texts
    df = spark.createDataFrame([(i, t, "site") for i, t in rows], "doc_id long, text string, source string")
    left = {x.doc_id: x.text for x in quality.clean(df).collect()}
    assert left == {i: t.replace(licence + "\n", "") for i, t in rows}
    by_count = {x.doc_id: x.lines_removed for x in quality.judge(df, percent=90, documents=45).collect()}
    assert by_count == {i: [1] if i < 45 else None for i, _ in rows}
    assert all(x.lines_removed is None for x in quality.judge(df, percent=90, documents=46).collect())


def test_cleaning_keeps_clashing_columns(spark):
    from ledgerline.llm import near_dedup

    text = " ".join(a + b for a in "abcdefgh" for b in "stuvwxyz")
    rows = [(i, text + " x" + "pqrs"[i] + "\nshared line here", "s", f"k{i}", "g", "t", i) for i in range(4)] + [(9, None, None, "k", "g", "t", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _key string, _gone string, _text_key string, _id long")
    got = {r.doc_id: r.asDict() for r in quality.clean(df).collect()}
    assert got == {r[0]: dict(zip(df.columns, (r[0], r[1].split("\n")[0], *r[2:]))) for r in rows[:4]}
    kept = {tuple(r) for r in near_dedup.representatives(df).collect()}
    assert kept <= set(rows) and rows[4] in kept and len(kept) == 2


# HTML

def test_html_layout():
    page = """<!doctype html><html><head><title>no</title></head><body><p>One<p>Two <b>bold</b>x<div>d1<div hidden>no</div>
    <div style="display: none">no</div><div>d2</div></div><ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>
    <table><tr><td>ab<td>c<tr><th>longer cell<td>d<br>e</table>tail &amp; &lt;x&gt; 5 < 6<script>var t="</p>";</script>
    <pre>  kept
   space</pre><!-- no --><a href="x>y">link</a></body></html>"""
    text = html_text.page_text(page)
    assert text.split("\n") == [
        "One", "", "Two boldx", "", "d1", "d2", "", "- a", "- b", " 3. x", " 4. y", "", "- c", "",
        "ab          | c", "longer cell | d", "            | e", "", "tail & <x> 5 < 6", "", "  kept", "   space", "", "link"]


def test_html_shows_all_visible_words(spark):
    from html.parser import HTMLParser

    class Seen(HTMLParser):
        def __init__(self):
            super().__init__()
            self.skip, self.words = 0, []

        def handle_starttag(self, tag, attrs):
            self.skip += tag in ("head", "script", "style")

        def handle_endtag(self, tag):
            self.skip -= tag in ("head", "script", "style")

        def handle_data(self, data):
            if not self.skip:
                self.words += data

    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").limit(60).collect():
        seen = Seen()
        seen.feed(r.html)
        seen.close()
        plain = lambda s: sorted(re.sub(r"[\s|]|^ *- ", "", s))
        want, got = "".join(seen.words), html_text.page_text(r.html)
        got = re.sub(r"(?m)^ *(- |\d+\. )", "", got)
        assert plain(got) == plain(want)


def test_html_odd_pages(spark):
    pages = [(1, None), (2, ""), (3, "<" * 3000), (4, "<div>" * 30000 + "deep"), (None, "</p>x</b></table><td>y"), (1, "<b>r</b>"), (1, "<b>r</b>")]
    df = spark.createDataFrame([(*p, "t", 1) for p in pages], "page_id long, html string, text string, n_chars long")
    got = [(r.page_id, r.text) for r in html_text.extract(df).collect()]
    assert got == [(1, ""), (2, ""), (3, "<" * 3000), (4, "deep"), (None, "x\ny") if got[4][1] == "x\ny" else (None, "xy"), (1, "r"), (1, "r")]
    assert html_text.extract(df.limit(0)).collect() == []


def test_html_stays_linear():
    import time

    def seconds(page):
        t = time.process_time()
        text = html_text.page_text(page)
        return time.process_time() - t, len(text)

    unmatched = lambda n: "<div><span>x" * n + "</b>" * n
    nested = lambda n: "<b><table><tr><td>" + "<i>y" * n + "</b>" * n
    for page in (unmatched, nested):
        small, large = seconds(page(2000))[0], seconds(page(16000))[0]
        assert large < 30 * max(small, 0.01)
    wide = lambda n: "<table><tr><td>" + "w" * n + "<td>z</tr>" + "<tr><td>a<td>b</tr>" * n + "</table>"
    assert seconds(wide(4000))[1] < 4000 * 140


# language

def test_language_on_held_out_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got) and all(0 <= r.score <= 1 for r in got)
    ids = {r.doc_id for r in got}
    assert ids == {i for i in range(1000) if zlib.crc32(str(i).encode()) % 4 == 2}


def test_language_odd_rows(spark):
    got = {(r.doc_id, r.lang_pred, r.score > 0) for r in language.identify(docs(spark, [*TEXTS, "123 456", "字字字"])).collect()}
    assert (1, "und", False) in got and (len(TEXTS), "und", False) in got
    assert any(i == len(TEXTS) + 1 and p != "und" for i, p, _ in got)
    bare = docs(spark).drop("lang").selectExpr("*", "cast(null as string) as lang")
    assert {r.lang_pred for r in language.identify(bare).collect()} == {"und"}
    assert language.identify(docs(spark, [], False)).collect() == []
    kept = language.accepted(docs(spark))
    assert kept.schema == docs(spark).schema and all(r.text and r.text.strip() for r in kept.collect())


def test_language_rejects_noise_and_unlearned_languages(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    r = random.Random(3)
    word = lambda signs, low, high: "".join(r.choices(signs, k=r.randint(low, high)))
    odd = [" ".join(word("abcdefghijklmnopqrstuvwxyz", 2, 9) for _ in range(n)) for n in (60, 300, 3000)]
    odd += [" ".join(word("0123456789abcdef", 8, 32) for _ in range(n)) for n in (60, 600)]
    odd += ["Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i "
            "sumieniem i powinni postępować wobec innych w duchu braterstwa.", "Все люди рождаются свободными и равными в "
            "своем достоинстве и правах. Они наделены разумом и совестью.", "人人生而自由在尊严和权利上一律平等" * 5,
            "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto."]
    long = {}
    for x in d.where("size(split(text, ' ')) >= 50").orderBy("doc_id").collect():
        long.setdefault(x.lang, []).append(x)
    mixed = [" ".join(w for x in same for w in x.text.split()[:50]) for same in list(zip(*(long[k] for k in sorted(long))))[:10]]
    extra = [(-1 - i, t, None) for i, t in enumerate(odd)] + [(-100 - i, t, None) for i, t in enumerate(mixed)]
    kept = {x.doc_id for x in language.accepted(d.unionByName(spark.createDataFrame(extra, d.schema))).collect()}
    assert not [i for i, _, _ in extra if -100 < i and i in kept]
    assert all(-100 - i in kept for i in range(len(mixed)))
    assert {x.doc_id for same in long.values() for x in same} <= kept


# packing

def test_packing_ids_are_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(packing.default_vocabulary())
    df = docs(spark)
    rows = packing.pack(df, capacity=256, group_docs=5, with_ids=True).collect()
    want = sorted((r.doc_id, tuple(library.encode(r.text or "", add_special_tokens=False).ids + [1])) for r in df.collect() if r.doc_id is not None)
    parts, got = sorted((r for r in rows if r.doc_id is not None), key=lambda r: (r.doc_id, r.doc_tokens, r.start)), []
    for r in parts:
        assert r.length == len(r.ids) <= 256 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    by_len = {}
    for r in parts:
        by_len.setdefault((r.doc_id, r.doc_tokens, r.start), []).append(r)
    for (i, n, start), same in sorted(by_len.items()):
        if start == 0:
            for k in range(len(same)):
                got.append((i, tuple(x for s in range(0, n, 256) for x in by_len[i, n, s][k].ids)))
    assert sorted(got) == want
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.pack(docs(spark, [], False)).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_first_fit_decreasing_is_first_fit(seed):
    r = random.Random(seed)
    sizes = np.array(sorted((r.randint(1, 100) for _ in range(r.randint(1, 300))), reverse=True))
    bins, offsets = packing.first_fit_decreasing(sizes, 100)
    free, want = [], []
    for s in sizes.tolist():
        k = next((k for k, f in enumerate(free) if f >= s), len(free))
        if k == len(free):
            free.append(100)
        want.append((k, 100 - free[k]))
        free[k] -= s
    assert list(zip(bins.tolist(), offsets.tolist())) == want


def test_pipeline_stages(spark):
    import corpus_pipeline as C

    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert [n for n, _ in C.STAGES] == ["quality rules", "language ID", "MinHash near-dedup", "substring dedup", "packing"]
    whole = {r.doc_id for r in d.collect()}
    now = d
    for name, stage in C.STAGES[:-1]:
        now = C.written(stage(spark, now, "/root/testdata/sf0.001"), "test-stage")
        assert now.columns == d.columns
        ids = [r.doc_id for r in now.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= whole
        whole = set(ids)
    pieces = C.run(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id for r in pieces} == whole

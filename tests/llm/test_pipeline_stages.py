"""Every stage of the pipeline against brute force on its own input."""

import random
import re

import pytest

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def planted(spark):
    """The smallest documents table with rows that every stage rejects or changes."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    base = sorted(docs.collect(), key=lambda r: r.doc_id)
    long = [r for r in base if r.text and len(WORDS.findall(r.text)) >= 120][:12]
    r = random.Random(4)
    noise = lambda n: " ".join("".join(r.choices("bcdfghjklmnpqrstvwxz", k=r.randint(2, 9))) for _ in range(n))
    next_id = base[-1].doc_id + 1
    rows = []
    for i, x in enumerate(long):  # an exact copy, a near copy, a passage in another text
        w = WORDS.findall(x.text)
        rows.append((x.text, x.lang, "copies"))
        rows.append((" ".join(w[:60] + ["changed"] + w[61:]), x.lang, "copies"))
        other = WORDS.findall(long[(i + 1) % len(long)].text)
        rows.append((" ".join(other[70:115] + w[5:50] + other[60:70] + [f"end{i}"] * 3), x.lang, "passages"))
    rows += [(noise(90), None, "noise"), (None, "en", None), ("", "en", "noise"), ("a b c", "en", "noise")]
    rows += [(x.text + "\n\nfollow this site and its many friends\n" + str(i), x.lang, "menu") for i, x in enumerate(long[:6])]
    extra = [(next_id + i, t, lang, source, len(t) if t is not None else None) for i, (t, lang, source) in enumerate(rows)]
    return docs.unionByName(spark.createDataFrame(extra, docs.schema))


def clean(rows):
    """Base rules, and lines of more than 5 % (and 3) of a host's distinct texts."""
    plain = lambda x: re.sub(r"[\x20\x09\x0B-\x0D]+", " ", re.sub("[0-9]+", "0", x)).strip(" ")
    hosts, lines = {}, {}
    for x in rows:
        t, h = x.text or "", x.source or ""
        hosts.setdefault(h, set()).add(t)
        for line in {plain(y) for y in t.split("\n")} - {""}:
            lines.setdefault((h, line), set()).add(t)
    out = {}
    for x in rows:
        t, h = x.text or "", x.source or ""
        w = WORDS.findall(t)
        seen = {}
        for i in range(len(w) - 2):
            seen.setdefault(tuple(w[i:i + 3]), []).append(i)
        hit = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)}
        common = lambda y: len(lines.get((h, plain(y)), ())) >= 3 and 100 * len(lines[h, plain(y)]) > 5 * len(hosts[h])
        gone = [bool(plain(y)) and common(y) for y in t.split("\n")]
        lost = sum(len(plain(y).split(" ")) for y, g in zip(t.split("\n"), gone) if g)
        if len(w) >= 50 and 100 * len(hit) <= 50 * len(w) and (len(w) - lost) * 100 >= len(w) * 30:
            out[x.doc_id] = "\n".join(y for y, g in zip(t.split("\n"), gone) if not g)
    return out


def shingles(text, n=5):
    w = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def groups(rows):
    sets = {x.doc_id: shingles(x.text) for x in rows}
    group = {i: i for i in sets}

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted(i for i, s in sets.items() if s)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = sets[a], sets[b]
            if min(len(x), len(y)) * 100 >= max(len(x), len(y)) * 80 and 100 * len(x & y) >= 80 * len(x | y):
                group[max(top(a), top(b))] = min(top(a), top(b))
    return {i: top(i) for i in sets}


def without_passages(rows, n=13):
    first = {}
    words = {x.doc_id: [(m.start(), m.group()) for m in WORDS.finditer(x.text or "")] for x in rows}
    for i in sorted(words):
        w = [x for _, x in words[i]]
        for k in range(len(w) - n + 1):
            first.setdefault(tuple(w[k:k + n]), i)
    out = {}
    for x in rows:
        at, w, t = [a for a, _ in words[x.doc_id]], [y for _, y in words[x.doc_id]], x.text or ""
        gone = {k + j for k in range(len(w) - n + 1) if first[tuple(w[k:k + n])] < x.doc_id for j in range(n)}
        ends = [*at[1:], len(t)]
        out[x.doc_id] = (t[:at[0]] if at else t) + "".join(t[a:b] for k, (a, b) in enumerate(zip(at, ends)) if k not in gone)
    return out


def test_stages_against_brute_force(spark):
    from tokenizers import Tokenizer

    import corpus_pipeline as C
    from ledgerline.llm import packing

    stages = dict(C.STAGES)
    run = lambda name, d: C.written(stages[name](spark, d, SF), "stage-test")
    docs = planted(spark)
    whole = docs.collect()

    cleaned = run("quality rules", docs)
    got = {r.doc_id: r.text for r in cleaned.collect()}
    assert got == clean(whole) and len(got) < len(whole)
    before = {r.doc_id: r.text for r in whole}
    assert any(got[i] != before[i] for i in got)

    known = run("language ID", cleaned)
    left = {r.doc_id for r in known.collect()}
    noise = {r.doc_id for r in cleaned.where("source = 'noise'").collect()}
    assert noise and not noise & left and left | noise >= {r.doc_id for r in cleaned.where("lang is not null").collect()}

    single = run("MinHash near-dedup", known)
    group = groups(known.collect())
    kept = [r.doc_id for r in single.collect()]
    assert sorted(group[i] for i in kept) == sorted(set(group.values())) and len(kept) < len(group)

    own = run("substring dedup", single)
    want = without_passages(single.collect())
    assert {r.doc_id: r.text for r in own.collect()} == want
    assert any(want[r.doc_id] != r.text for r in single.collect())
    assert [r.n_chars == len(r.text) for r in own.collect()].count(False) == 0

    library = Tokenizer.from_file(packing.default_vocabulary())
    ids = {}
    for r in stages["packing"](spark, own, SF).collect():
        assert len(r.ids) == r.length
        ids.setdefault(r.doc_id, []).append((r.start, list(r.ids)))
    assert {i: [x for _, part in sorted(p) for x in part] for i, p in ids.items()} == {
        r.doc_id: library.encode(r.text or "", add_special_tokens=False).ids + [1] for r in own.collect()}


@pytest.mark.parametrize("rows", [0, 4])
def test_run_on_empty_and_odd_tables(spark, tmp_path, rows):
    import corpus_pipeline as C

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(None, None, None, None, None), (1, "", "en", "h", 0), (1, "same id " * 30, None, None, None), (2, "x" * 3000, "en", "h", None)][:rows]
    spark.createDataFrame(odd, docs.schema).write.parquet(str(tmp_path / "documents.parquet"))
    got = C.run(spark, str(tmp_path))
    assert got.collect() == [] and "ids" in got.columns

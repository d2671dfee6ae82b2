"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

from cardloom.llm import variants


def plain_counts(rows, least_chars=6, least_count=5):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least_chars:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= least_count}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain(words, times=5):
    near = {w: [x for x in words if is_near(w, x)] for w in words}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= times * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=lambda r: r[0])


def test_equals_all_pairs(spark):
    rng = random.Random(13)
    bases = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(6, 9))) for _ in range(60)]
    words = []
    for base in bases:
        words += [base] * rng.randrange(1, 400)
        for _ in range(6):
            at, c = rng.randrange(len(base)), rng.choice("abcdeéÀ")
            other = rng.choice([base[:at] + base[at + 1 :], base[:at] + c + base[at:], base[:at] + c + base[at + 1 :]])
            words += [other] * rng.randrange(1, 60)
    rng.shuffle(words)
    rows = [(i, rng.choice([" ", ", ", "1"]).join(w.upper() if rng.random() < 0.3 else w for w in words[i::90])) for i in range(90)]
    rows += [(None, "nullid nullid " * 3), (5, rows[5][1]), (91, None), (92, ""), (93, "aaaaaa aaaaaaa aaaaaab " * 5)]
    docs = spark.createDataFrame([(*r, "clash", 3) for r in rows], "doc_id long, text string, word string, n int").repartition(4)
    expected = plain(plain_counts(rows))
    assert found(variants.variants(docs)) == expected
    assert sum(r[1] is not None for r in expected) > 20


def test_anagrams_are_told_apart(spark):
    """All words have one key: what is near is found, and no pair of all that meet."""
    rng = random.Random(3)
    words = {"".join(rng.sample("abcdefgh", 8)) for _ in range(300)}
    words |= {w[:i] + w[i + 1 :] for w in sorted(words)[:40] for i in range(8)}
    counts = {w: 5 + i % 200 for i, w in enumerate(sorted(words))}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = Counter(r.word for r in variants.near(frame).collect())
    assert got == Counter({r[0]: r[4] for r in plain(counts) if r[4]})


def test_very_long_run(spark, monkeypatch):
    monkeypatch.setattr(variants, "CHUNK", 1000)
    long = "abcdefghij" * 5000
    rows = [(i, f"{long} {long[:777]}x{long[778:]} word word" if i else long) for i in range(7)]
    got = found(variants.variants(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == plain(plain_counts(rows)) and len(got) == 2 and got[0][4] == 1


def test_runs_by_chunk(monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choice("abÀ \nZ-") for _ in range(3000))
    whole = [x for part in variants.runs(text, 2) for x in part]
    monkeypatch.setattr(variants, "CHUNK", 7)
    assert [x for part in variants.runs(text, 2) for x in part] == whole == re.findall("[a-zÀ-ÿ]{2,}", text.replace("Z", "z"))


def test_chain_of_forms_and_ties(spark):
    counts = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 700, "zzzzzz": 5, "zzzzzy": 30, "zzzzzx": 30}
    rows = [(None, " ".join([w] * n)) for w, n in counts.items()]
    got = {r[0]: r for r in found(variants.variants(spark.createDataFrame(rows, "doc_id long, text string")))}
    assert got["aaaaaa"][1:3] == ("aaaaab", "aaabbb") and got["zzzzzz"][1:] == ("zzzzzx", "zzzzzx", 5, 2, 30) and got["zzzzzy"][1] is None


def test_empty_table(spark):
    assert variants.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0

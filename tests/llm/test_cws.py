"""Fingerprints by consistent weighted sampling against exact likeness."""

import random
from collections import Counter

import numpy as np

from cardloom.llm import cws


def exact(a, b):
    """Generalised Jaccard similarity of the bags of word pairs."""
    x, y = (Counter(zip(t.lower().split(), t.lower().split()[1:])) for t in (a, b))
    keys = x.keys() | y.keys()
    return sum(min(x[k], y[k]) for k in keys) / sum(max(x[k], y[k]) for k in keys)


def test_likeness_is_close_to_exact():
    rng = random.Random(6)
    words = [f"w{i}" for i in range(40)]
    errors = []
    for _ in range(60):
        a = [rng.choice(words) for _ in range(400)]
        b = a[: rng.randrange(400)] + [rng.choice(words) for _ in range(100)]
        errors.append(cws.likeness(cws.signature(" ".join(a)), cws.signature(" ".join(b))) - exact(" ".join(a), " ".join(b)))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_revisions(spark):
    texts = {5: "one two three four", 4: None, 3: "", 2: "one two three four", 1: "x"}
    docs = spark.createDataFrame([(k, v, "clash") for k, v in texts.items()], "doc_id long, text string, fingerprint string").repartition(3)
    rows = {r.doc_id: r for r in cws.revisions(docs).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5]
    assert rows[5].fingerprint == rows[2].fingerprint != rows[1].fingerprint and rows[3].fingerprint == rows[4].fingerprint
    import hashlib

    order = [5, 4, 3, 2, 1]
    for i, doc_id in enumerate(order):
        own, after = texts[doc_id] or "", texts[order[(i + 1) % 5]] or ""
        edited = own[: len(own) - len(own) // 2] + after[: len(own) // 2]
        assert rows[doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and rows[doc_id].n_chars == len(own)
        assert rows[doc_id].near_next == cws.likeness(cws.signature(own), cws.signature(after))
    assert rows[4].near_next == 1.0
    assert cws.revisions(docs.limit(0)).count() == 0


def test_repeated_and_null_ids(spark):
    """Rows of one id follow each other by text, null ids come last."""
    rows = [(2, "b b"), (2, "a a"), (None, "n n"), (2, "a a"), (7, "z z")]
    got = cws.revisions(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    order = [(7, "z z"), (2, "a a"), (2, "a a"), (2, "b b"), (None, "n n")]
    expected = [(i, cws.likeness(cws.signature(t), cws.signature(order[(k + 1) % 5][1]))) for k, (i, t) in enumerate(order)]
    assert sorted(((r.doc_id or 0), r.near_next) for r in got) == sorted((i or 0, x) for i, x in expected)

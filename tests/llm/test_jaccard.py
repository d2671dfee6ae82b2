"""Near copies against the similarity of all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest

from cardloom.llm import jaccard, simhash


def similarity(x, y):
    a, b = (set(jaccard.shingles_of(t, 5).tolist()) for t in (x, y))
    return len(a & b) / len(a | b) if a | b else 1.0


def least_ids(texts, limit=0.8):
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = [set(jaccard.shingles_of(t, 5).tolist()) for t in texts]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or len(a & b) >= limit * len(a | b) - 1e-9:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(texts))]


def test_shingles_are_runs_of_words():
    import xxhash

    words = "one Two three four five six seven".lower().split()
    expected = sorted(xxhash.xxh64_intdigest(" ".join(words[i : i + 5]).encode(), 42) for i in range(3))
    assert jaccard.shingles_of("one Two\tthree four five six  seven", 5).tolist() == expected
    assert jaccard.shingles_of("A b", 5).tolist() == [xxhash.xxh64_intdigest(b"a b", 42)] and not len(jaccard.shingles_of(" \n", 5)) and not len(jaccard.shingles_of(None, 5))


def test_keys_meet_at_the_border():
    """Whatever is frequent: one order for both, and one key at least in common."""
    rng = np.random.default_rng(2)
    for n in range(5, 200):
        both = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        least = -(-4 * n // 5)  # a subset of least similarity
        x, y = np.sort(both), np.sort(rng.choice(both, least, replace=False))
        frequent = np.sort(rng.choice(both, n // 2, replace=False))
        for known in (frequent, frequent[:0]):
            found = []
            for own in (x, y):
                rare, late = jaccard.split_keys(own, 0.8, known, np.arange(len(known)))
                keys = [*rare.tolist()[: jaccard.n_keys(len(own), 0.8)], *late.tolist()]
                assert len(keys) == jaccard.n_keys(len(own), 0.8)
                found.append(set(keys))
            assert found[0] & found[1] and len(found[0]) == n - least + 1


def test_shared_keys_of_sorted_rows():
    rng = np.random.default_rng(4)
    rows = sorted((int(k), int(i)) for k, i in rng.integers(0, 40, (300, 2)))
    expected = sorted({(k, i, len({j for o, j in rows if o == k})) for k, i in rows if len({j for o, j in rows if o == k}) > 1})
    whole = [(k, i, None, None, None, None, None, None) for k, i in rows]
    whole[100:100] = [(rows[100][0], 7, None, 55, 9, 9, [1, 2], dict.fromkeys(jaccard.WORDS, -3))]  # about a text
    kinds = [pa.int64()] * 6 + [pa.list_(pa.int64()), pa.struct([(w, pa.int64()) for w in jaccard.WORDS])]
    for step in (1, 7, 301):
        parts = [jaccard._row_batch([pa.array(x, k) for x, k in zip(zip(*whole[at : at + step]), kinds)]) for at in range(0, 301, step)]
        got = [r for b in jaccard._shared(iter(parts)) for r in b.to_pylist()]
        assert sorted((r["key"], r["id"], r["df"]) for r in got if r["df"] is not None) == expected
        assert [(r["key"], r["id"], r["fingerprint"], r["late"], set(r["bits"].values())) for r in got if r["df"] is None] == [(None, 7, 55, [1, 2], {-3})]
    assert sum(b.num_rows for b in jaccard._shared(iter([]))) == 0


def test_all_pairs_of_the_similarity_and_no_others(spark):
    """Planted pairs on both sides of the border: each is judged by its similarity."""
    rng = random.Random(11)
    texts = []
    for _ in range(300):
        own = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(40, 250))]
        edited = list(own)
        for at in rng.sample(range(len(own)), max(1, round(len(own) * rng.uniform(0.005, 0.05)))):
            edited[at] = f"edited{rng.randrange(10**6)}"
        texts += [" ".join(own), " ".join(edited)]
    near = [similarity(texts[i], texts[i + 1]) >= 0.8 for i in range(0, 600, 2)]
    assert 100 < sum(near) < 250
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id for r in simhash.near_copies_dropped(docs).collect()}
    assert [2 * i + 1 not in kept for i in range(300)] == near and all(2 * i in kept for i in range(300))


@pytest.mark.parametrize(("allowed", "near"), [(jaccard.PAIRS, None), (0, simhash.near_pairs)])
def test_groups_equal_all_pairs(spark, monkeypatch, allowed, near):
    """Chains, a passage that many hold, exact copies, with stars and without them, with fingerprints first."""
    monkeypatch.setattr(jaccard._links, "__defaults__", (allowed, None))
    monkeypatch.setattr(jaccard, "STARS", 2)
    rng = random.Random(5)
    passage = " ".join(f"common{i}" for i in range(30))
    texts = [None, "", " \n", "A b", "a B", "one two three four five"]
    for group in range(6):
        own = [f"g{group}x{i}" for i in range(120)]
        for step in range(25):  # every copy from the one before: a chain
            own[rng.randrange(120)] = f"new{rng.randrange(10**6)}"
            texts.append(" ".join(own))
    texts += [passage + " " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.choice([3, 6, 60]))) for _ in range(80)]
    texts += texts[10:20]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.component_id for r in jaccard.groups(docs, "doc_id", "text", 5, 0.8, near).collect()}
    assert [found[i] for i in range(len(texts))] == least_ids(texts)


def test_frequent_shingles_beyond_the_sample(spark, monkeypatch):
    """Groups are the same however little the sample knows."""
    rng = random.Random(8)
    passage = [f"common{i}" for i in range(40)]
    texts = []
    for _ in range(120):
        own = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([2, 4, 30]))]
        texts += [" ".join(passage + own), " ".join([*passage[: rng.randrange(30, 40)], *own])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for sample, frequent, part in ((20, 5, 3), (1, 1, 1)):
        monkeypatch.setattr(jaccard, "SAMPLE", sample)
        monkeypatch.setattr(jaccard, "PART", part)
        monkeypatch.setattr(jaccard, "BROADCAST", 0 if part == 1 else 1 << 20)
        monkeypatch.setattr(jaccard, "FREQUENT", frequent)
        found = {r.doc_id: r.component_id for r in jaccard.groups(docs, "doc_id", "text", 5, 0.8).collect()}
        assert [found[i] for i in range(len(texts))] == least_ids(texts), sample


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_copies_dropped(docs).count() == 0


def test_parities_rule_out_no_pair_that_is_alike():
    rng = np.random.default_rng(5)
    least, ruled_out = 0.8 / 1.8, 0
    for n in (1, 9, 40, 150, 600, 5_000):
        base = rng.integers(0, 2**64, 2 * n, np.uint64)
        for shared in sorted({n, int(0.95 * n), round(n * 16 / 18), int(0.86 * n), n // 2}):
            x, y = np.unique(base[:n]), np.unique(base[n - shared : 2 * n - shared])
            rows = [(7, band, len(z), i, 0, i, band) for i, z in enumerate((x, y), 1) for band in (3,)]
            words = [jaccard.parities(z) for z in (x, y)]
            bits = pa.StructArray.from_arrays([pa.array([w[k] for w in words], pa.int64()) for k in range(len(jaccard.WORDS))], jaccard.WORDS)
            batch = pa.record_batch([*(pa.array([r[k] for r in rows], pa.int64()) for k in range(7)), bits], ["key", "band", "size", "id", "at", "root", "own", "bits"])
            found = [tuple(b.to_pydict().values()) for b in jaccard._fitting(0.8, False)(iter([batch]))]
            counted = [b.to_pydict() for b in jaccard._fitting(0.8, True)(iter([batch]))]
            assert counted == [{"a": [2], "b": [len(found)]}]
            if len(np.intersect1d(x, y)) >= least * (len(x) + len(y)) - 1e-9:
                assert found == [([1], [2])]
            ruled_out += not found
    assert ruled_out >= 6

"""SimHash groups against all pairs."""

import random

import numpy as np
import pytest
import xxhash

from cardloom.llm import simhash


def plain_fingerprint(text, n):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in text.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def plain_groups(rows):
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(rows[i][1] ^ rows[j][1]).count("1") <= 4:
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [least[find(i)] for i in range(len(rows))]


def test_groups_equal_all_pairs(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(60)]
    texts = [None, "", " \n", "A b", "a B", "é É x y z", "one two three four", "one two three four"]
    for _ in range(40):
        own = [rng.choice(words) for _ in range(rng.randrange(30, 90))]
        texts += [" ".join(own), " ".join([*own[:-1], "edited"]), " ".join(own).upper()]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, fingerprint string")
    rows = sorted(simhash.groups(docs).withColumn("hex", simhash.as_hex("fingerprint")).collect())
    prints = [(i, plain_fingerprint(t, 4)) for i, t in enumerate(texts)]
    assert [r.hex for r in rows] == [f"{p:016x}" for _, p in prints]
    assert [r.component_id for r in rows] == plain_groups(prints)
    assert simhash.groups(docs.limit(0)).count() == 0


def test_keys_meet_within_four_bits():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    other = base.copy()
    for i in range(len(base)):
        for b in rng.choice(64, rng.integers(0, 5), replace=False):
            other[i] ^= np.uint64(1 << int(b))
    found = [{}, {}]
    for side, prints in enumerate((base, other)):
        for key, row in zip(*simhash.keys_of(prints)):
            found[side].setdefault(int(row), set()).add(int(key))
    assert all(found[0][i] & found[1][i] for i in range(len(base)))


def test_large_buckets_are_cut_exactly(spark):
    prints = [(x,) for x in range(1 << 10)] + [((1 << 62) + (1 << 50) + 3,)]
    frame = spark.createDataFrame(prints, "p long")
    links = simhash.links(frame, "p", 1, block=50).collect()
    root = {p: p for p, in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in links:
        assert (r.a < 1 << 10) == (r.b < 1 << 10)  # a forest joins what others connect
        root[find(r.a)] = find(r.b)
    assert len({find(p) for p, in prints}) == 2


def test_copies_of_four_fifths(spark):
    """Of pairs with a similarity around 0.85 most are found, of those around 0.5 none."""
    rng = random.Random(9)
    texts, pairs = [], []
    for near in [True] * 40 + [False] * 40:
        own = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        edited = list(own)
        for i in range(5, 200, 70 if near else 15):  # an edit changes five shingles
            edited[i] = "edited"
        a, b = ({tuple(x[i : i + 5]) for i in range(196)} for x in (own, edited))
        pairs.append((near, len(a & b) / len(a | b)))
        texts += [" ".join(own), " ".join(edited)]
    assert all(0.83 < j < 0.9 if near else j < 0.55 for near, j in pairs)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id for r in simhash.near_copies_dropped(docs).collect()}
    assert all(2 * i in kept for i in range(80)) and all(2 * i + 1 in kept for i in range(40, 80))
    assert sum(2 * i + 1 not in kept for i in range(40)) >= 30


def test_texts_of_one_id_stay_unless_they_are_copies(spark):
    texts = {k: " ".join(f"{k}{i}" for i in range(80)) for k in "abc"}
    rows = [(1, texts["a"], 7), (1, texts["b"], 7), (1, texts["b"], 8), (2, texts["a"] + " more", 7), (None, texts["c"], 7), (None, texts["c"], 7), (None, texts["b"], 7), (4, " \n", 7), (3, None, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_id int")
    kept = simhash.near_copies_dropped(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted([(1, texts["a"]), (1, texts["b"]), (0, texts["c"]), (3, "")])
    assert simhash.near_copies_dropped(docs.limit(0)).count() == 0


def test_one_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(300))
    docs = spark.createDataFrame([(3, text, "x"), (1, text, "y"), (1, text, "y"), (2, "other words here now and then", "z"), (9, None, "n")], "doc_id long, text string, source string")
    kept = simhash.near_copies_dropped(docs)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 9] and kept.columns == docs.columns


def test_keys_meet_for_every_split_of_errors():
    """Four errors in every way over the segments, (2, 1, 1) and its kin the hardest."""
    rng = np.random.default_rng(2)
    base, other = [], []
    for split in [(a, b, c) for a in range(5) for b in range(5) for c in range(5) if a + b + c <= 4]:
        for _ in range(40):
            x = y = int(rng.integers(0, 1 << 63))
            for (at, width), errors in zip(simhash.SEGMENTS, split):
                for bit in rng.choice(width, errors, replace=False):
                    y ^= 1 << at + int(bit)
            base.append(x), other.append(y)
    found = [{}, {}]
    for side, prints in enumerate((base, other)):
        for key, row in zip(*simhash.keys_of(np.array(prints, np.uint64))):
            found[side].setdefault(int(row), []).append(int(key))
    assert all(set(found[0][i]) & set(found[1][i]) for i in range(len(base)))
    assert all(len(keys) == len(set(keys)) for keys in found[0].values()) and max(map(len, found[0].values())) < 320


def test_unrelated_fingerprints_rarely_share_a_key():
    prints = np.random.default_rng(3).integers(0, 1 << 63, 20_000, dtype=np.uint64)
    keys, rows = simhash.keys_of(prints)
    assert 180 < len(keys) / len(prints) < 260
    _, sizes = np.unique(keys, return_counts=True)
    assert (sizes * (sizes - 1)).sum() / len(keys) < 2e-4  # others met in a bucket, which grows with the rows


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b c d e"), (5, "a b c d e"), (5, "quite other words, these are"), (5, "a b c d e"), (None, "alone here among all the others")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.groups(docs).collect()}
    assert simhash.groups(docs).count() == 5 and len(found) == 4
    by_text = [plain_fingerprint(t, 4) for _, t in rows]
    signed = [p - (1 << 64) if p >> 63 else p for p in by_text]
    assert found[None, signed[0]] == found[5, signed[0]] == found[5, signed[2]] == 5 and found[None, signed[4]] is None


@pytest.mark.parametrize("small", [0, 1 << 20])
def test_hot_keys_are_joined_where_they_are(spark, monkeypatch, small):
    from cardloom.llm import graph

    monkeypatch.setattr(graph, "SMALL", small)

    rows = spark.createDataFrame([(i if i % 3 else 0, i) for i in range(9000)] + [(None, 1)], "k long, v long")
    got = graph.least_by_key(rows, "k", "v", "least", 9001)
    assert got.count() == 9000 and got.where("least <> if(k = 0, 0, k)").count() == 0
    star = spark.createDataFrame([(0, i) for i in range(1, 4000)] + [(5000, 5001), (5001, 5002), (7, 7), (None, 3)], "a long, b long")
    roots = {r.node: r.root for r in graph.components(star).collect()}
    assert len(roots) == 4003 and {roots[i] for i in range(4000)} == {0} and {roots[i] for i in (5000, 5001, 5002)} == {5000}

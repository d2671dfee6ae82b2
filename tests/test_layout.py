"""The grid of cards against a plain version."""

import random
from statistics import median

from pyspark.sql import functions as F

from cardloom.operators import layout

SCHEMA = "page int, line_texts array<string>, line_rects array<struct<x:double,y:double,width:double,height:double>>, grid_pos string"


def plain_centers(values, k):
    groups = [[v] for v in sorted(values)]
    while len(groups) > k:
        gaps = [median(b) - median(a) for a, b in zip(groups, groups[1:])]
        i = gaps.index(min(gaps))
        groups[i : i + 2] = [groups[i] + groups[i + 1]]
    return [median(g) for g in groups]


def test_centers(spark):
    cases = [([1, 2, 10, 11, 12, 30], 3), ([0, 1, 2, 3], 2), ([5], 2), ([4, 4, 4], 2), ([], 2)]
    rng = random.Random(1)
    cases += [([rng.randrange(20) for _ in range(rng.randrange(1, 14))], rng.randrange(1, 4)) for _ in range(40)]
    frame = spark.createDataFrame([([float(x) for x in v], k) for v, k in cases], "v array<double>, k int")
    rows = frame.select(layout.centers(F.col("v"), F.col("k")).alias("c")).collect()
    assert [r.c for r in rows] == [plain_centers(v, k) for v, k in cases]


def plain_cards(texts, rects):
    items = [(r["y"] or 0.0, r["x"] or 0.0, i, t, (r["x"] or 0) + (r["width"] or 0) / 2, (r["y"] or 0) + (r["height"] or 0) / 2) for i, (t, r) in enumerate(zip(texts, rects))]
    found = {n: [] for n in range(1, 7)}
    if items:
        cy, cx = plain_centers([i[5] for i in items], min(3, len(texts))), plain_centers([i[4] for i in items], 2)
        for y, x, i, t, mx, my in items:
            row = min(range(len(cy)), key=lambda k: abs(my - cy[k]))
            column = min(range(len(cx)), key=lambda k: abs(mx - cx[k]))
            found[row * 2 + column + 1].append((y, x, i, t))
    return {n: [t for *_, t in sorted(v)] for n, v in found.items()}


def test_cards_equal_a_plain_version(spark):
    rng = random.Random(2)
    pages = [[None, None], [[], []], [["a"], []], [["a"], [{"x": 1.0, "y": None, "width": 2.0, "height": None}]]]
    for _ in range(30):
        n = rng.randrange(1, 12)
        rects = [{k: float(rng.randrange(6) * 10) for k in ("x", "y", "width", "height")} for _ in range(rng.randrange(n + 2))]
        pages.append([[f"line {i}" for i in range(n)], rects])
    frame = spark.createDataFrame([(i, t, r, "clash") for i, (t, r) in enumerate(pages)], SCHEMA)
    rows = layout.cards(frame).collect()
    assert len(rows) == 6 * len(pages)
    for r in rows:
        texts, rects = pages[r.page]
        assert r.line_texts == plain_cards(texts or [], rects or [])[r.card_no], (r, pages[r.page])
        assert r.grid_pos == f"r{(r.card_no + 1) // 2}c{(r.card_no - 1) % 2 + 1}" and r.has_text == bool(r.line_texts)


def test_empty_table(spark):
    assert layout.cards(spark.createDataFrame([], SCHEMA)).count() == 0

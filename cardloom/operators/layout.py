"""From the lines of a page to its grid of cards, within each row and without a shuffle.

Line centres are merged along each axis by joining the neighbouring clusters with
the least distance of medians until there are as many as rows or columns; each line
goes to the nearest row and column.  Merging is a sequence of choices, each of which depends on
the ones before, so it is an Arrow function that reads the boxes of a batch of pages and gives the places of lines in cards;
texts stay where they are, and all else is built-in expressions.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..functions.text import CARD, Profile, extracted

ROWS, COLUMNS = 3, 2


def _merged(values: list[float], target: int) -> list[float]:
    """Medians of at most target clusters of values, in rising order; see centers()."""
    own = sorted(values)
    n = len(own)

    def median(i: int, j: int) -> float:
        return (own[(i + j - 1) // 2] + own[(i + j) // 2]) / 2

    ends, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the cluster that starts at a place
    alive = [True] * n
    gaps = [(own[i + 1] - own[i], i, i + 1, i + 2) for i in range(n - 1)]  # distance, starts of both, end of the second
    heapify(gaps)
    for _ in range(n - max(target, 1)):
        while True:
            _, i, j, end = heappop(gaps)
            if alive[i] and alive[j] and ends[i] == j and ends[j] == end:
                break  # otherwise one of them has grown since
        ends[i], alive[j] = end, False
        if end < n:
            before[end] = i
            heappush(gaps, (median(end, ends[end]) - median(i, end), i, end, ends[end]))
        if i > 0:
            heappush(gaps, (median(i, end) - median(before[i], i), before[i], i, end))
    return [median(i, ends[i]) for i in range(n) if alive[i]]


def centers(values: Column, target: Column | int) -> Column:
    """Medians of at most target clusters of an array<double>, in rising order; of equal gaps the leftmost closes first.

    A cluster is a stretch of the sorted values, so its median is read off their middle, and a merge
    changes two gaps only: n log n steps for n values.
    """

    @arrow_udf("array<double>")
    def every(lists: pa.Array, targets: pa.Array) -> pa.Array:
        return pa.array([None if v is None else _merged(v, n) for v, n in zip(lists.to_pylist(), targets.to_pylist())], pa.list_(pa.float64()))

    return every(values, F.lit(target).cast("int") if isinstance(target, int) else target)


def _placed(xs: list[float], ys: list[float], widths: list[float], heights: list[float], n_lines: int, rows: int, columns: int) -> list[list[int]]:
    """Positions of the lines of each card, by y, x and position; of equally near centres the first counts."""
    places: list[list[int]] = [[] for _ in range(rows * columns)]
    cx, cy = [x + w / 2 for x, w in zip(xs, widths)], [y + h / 2 for y, h in zip(ys, heights)]
    across, down = _merged(cx, columns), _merged(cy, min(rows, n_lines))
    for i in sorted(range(len(xs)), key=lambda i: (ys[i], xs[i])):
        row = min(range(len(down)), key=lambda k: abs(cy[i] - down[k]))
        column = min(range(len(across)), key=lambda k: abs(cx[i] - across[k]))
        places[row * columns + column].append(i)
    return places


def places(boxes: Column, n_lines: Column, rows: int = ROWS, columns: int = COLUMNS) -> Column:
    """Array of rows * columns arrays of positions of boxes (array<struct<x,y,width,height>> of doubles, none null)."""

    @arrow_udf("array<array<int>>")
    def every(boxes: pa.Array, sizes: pa.Array) -> pa.Array:
        inner = boxes.flatten()
        fields = [inner.field(c).to_pylist() for c in ("x", "y", "width", "height")]
        out, at = [], 0
        for own, n in zip(pc.list_value_length(boxes).to_pylist(), sizes.to_pylist()):
            out.append(_placed(*(f[at : at + own] for f in fields), n, rows, columns))
            at += own
        return pa.array(out, pa.list_(pa.list_(pa.int32())))

    return every(boxes, n_lines)


def cards(
    pages: DataFrame, texts: str = "line_texts", rects: str = "line_rects", rows: int = ROWS, columns: int = COLUMNS, profile: Profile = CARD, fields: tuple[str, ...] | None = None
) -> DataFrame:
    """rows * columns cards for every page, empty ones too, in row-major order.

    Adds card_no, grid_pos, has_text, line_texts (by y, x, position) and extracted, with the given ``fields`` only or all;
    the column of rects is dropped.  Lines without a rect are left out; missing numbers
    of a rect are 0.  Null arrays count as empty.
    """
    none = F.array().cast("array<struct<x:double,y:double,width:double,height:double>>")
    lines = F.coalesce(F.col(texts), F.array().cast("array<string>"))
    boxes = F.slice(F.coalesce(F.col(rects), none), 1, F.greatest(F.size(lines), F.lit(0)))
    numbers = F.transform(boxes, lambda b: F.struct(*[F.coalesce(b[c].cast("double"), F.lit(0.0)).alias(c) for c in ("x", "y", "width", "height")]))
    own = "places"
    while own in pages.columns:
        own += "_"
    kept = [c for c in pages.columns if c not in (texts, rects, "card_no", "grid_pos", "has_text", "line_texts", "extracted")]
    page = pages.select(*kept, lines.alias(texts), places(numbers, F.size(lines), rows, columns).alias(own))
    card = page.select(*kept, texts, F.posexplode(own).alias("card_no", own))
    inside = F.transform(own, lambda i: F.get(texts, i))
    row, column = F.floor(F.col("card_no") / columns) + 1, F.col("card_no") % columns + 1
    found = card.select(
        *kept, (F.col("card_no") + 1).alias("card_no"), F.concat(F.lit("r"), row.cast("string"), F.lit("c"), column.cast("string")).alias("grid_pos"),
        (F.size(own) > 0).alias("has_text"), inside.alias("line_texts"),
    )
    return found.withColumn("extracted", extracted("line_texts", profile, fields))

"""Connected components of an undirected graph given as an edge table, and joins with hot keys."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import SMALL, gathered, settle

#: Keys with at least a row in so many are broadcast, so these are so many at most.
HOT = 1_000
#: Edges that one task unites; more take rounds over all tasks.
LOCAL = 250_000


def join_by_key(rows: DataFrame, found: DataFrame, key: str, n: str, total: int, small: int = SMALL) -> DataFrame:
    """Inner join of rows with found, which holds each key once and in ``n`` how many of the rows have it.

    Rows of keys that hold a ``HOT``-th of the ``total`` rows or more meet them by broadcast, where they
    are: there are ``HOT`` such keys at most.  All others are shuffled, and none of them fills a task.  Of a
    small table, of no more rows than ``small``, all keys are broadcast.
    """
    if total <= small:  # so found has no more rows either
        return rows.join(F.broadcast(found.drop(n)), key)
    most = max(1, total // HOT)
    hot, rest = F.broadcast(found.where(F.col(n) > most).drop(n)), found.where(F.col(n) <= most).drop(n)
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(rest, key))


def least_by_key(rows: DataFrame, key: str, value: Column | str, name: str, total: int) -> DataFrame:
    """rows with a column of the least value among the rows of their key; null keys go."""
    least = rows.groupBy(key).agg(F.min(value).alias(name), F.count("*").alias("_n"))
    return join_by_key(rows, least, key, "_n", total)


def _state(edges: DataFrame) -> tuple:
    """Count and order-free checksum of an edge set."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of the nodes of (hi, lo) edges, root being the least node of each component."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := above.setdefault(x, x)) != x:
            above[x] = x = above.setdefault(up, up)
        return x

    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = top(x), top(y)
            if x != y:
                above[max(x, y)] = min(x, y)
    nodes = list(above)
    if nodes:
        yield pa.record_batch([pa.array(nodes, pa.int64()), pa.array([top(x) for x in nodes], pa.int64())], ["node", "root"])


def components(edges: DataFrame, a: str = "a", b: str = "b", n: int | None = None) -> DataFrame:
    """(node, root) for each node that has an edge; root is the least node of its component.  n is how many edges there are, if known.

    Alternates large-star and small-star rounds until the edges stop changing,
    which takes a logarithmic number of rounds.  No more than ``LOCAL`` edges are united by one task instead.  Null ends and loops are ignored,
    repeated edges count once, and no edge ever reaches the driver.
    """
    ends = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    edges = ends.select(F.greatest(a, b).cast("long").alias("hi"), F.least(a, b).cast("long").alias("lo"))
    edges = edges.where("hi > lo").distinct()
    if n is not None and n <= LOCAL:
        return edges.select("hi", "lo").coalesce(1).mapInArrow(_united, "node long, root long")
    edges = settle(edges, n)
    before = _state(edges)
    edges = gathered(edges, before[0])
    while before[0]:
        both = edges.select(F.col("hi").alias("node"), F.col("lo").alias("other")).unionByName(
            edges.select(F.col("lo").alias("node"), F.col("hi").alias("other"))
        )
        large = (
            least_by_key(both, "node", "other", "least", 2 * before[0])
            .where("other > node")
            .select(F.col("other").alias("node"), F.least("least", "node").alias("other"))
            .distinct()
        )
        large = settle(large, before[0])
        small = least_by_key(large, "node", "other", "least", before[0]).select(F.explode(F.array("node", "other")).alias("hi"), F.col("least").alias("lo"))
        edges = settle(small.where("hi > lo").distinct(), 2 * before[0])
        now = _state(edges)
        if now == before:
            break
        before = now
    roots = edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root"))
    return roots.unionByName(edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())

"""Nearest neighbours by inner product through a hash-prefix forest.

Every vector has one long hash string per tree: ``BITS`` signs of random projections,
then ``SALT`` bits of its id, so that equal vectors still spread.  A tree is the sorted
array of these strings, cut into segments of about ``SEGMENT`` rows which lie in
different tasks.  A vector x gets the extra component sqrt(M^2 - |x|^2), M being the
largest norm, which turns the largest inner product into the smallest angle.

A query descends each tree to its own place and looks at the strings around it,
which share the longest prefixes with it.  The k-th best inner product found there
says how alike the true neighbours are at least; with p the chance that two such
vectors agree in a sign, prefixes of x signs in T trees find one with probability
1 - (1 - p^x)^T.  The query then ascends all trees at once, to the longest prefixes for
which that chance is ``COVERAGE``, and scores all strings with these prefixes; some
trees may stop one sign deeper than others.  So the effort follows the data: near
neighbours need few candidates, vectors without any structure a large share of all.

A task holds the vectors of one segment and reads the queries that come to it as a stream, so its memory
does not depend on their number; a segment to which more than ``BLOCK`` queries come is read by as
many tasks as they fill, and one to which none come by no task.  Vectors travel in the precision of
their column, once per tree and round.  Cuts are quantiles of a sample that grows with the
table; the driver holds 8 bytes for each segment of each tree, a thousandth of the rows in all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .runtime import settle

TREES, BITS, SALT, SEED = 16, 44, 19, 9
#: Rows of a segment, about, and rows of the sample for each of them.
SEGMENT, SAMPLED = 16_384, 64
#: Strings looked at around a query's place in each tree; the chance to find a true neighbour that the ascent aims at.
AROUND, COVERAGE = 64, 0.95
#: Queries of a segment that one task reads, about.
BLOCK = 32_768
_WEIGHTS = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)


@lru_cache(maxsize=8)
def _planes(size: int) -> np.ndarray:
    """A normal direction for each sign of each tree, in size + 1 dimensions."""
    return np.random.default_rng([SEED, size]).standard_normal((size + 1, TREES * BITS)).astype(np.float32)


def strings(vectors: np.ndarray, ids: np.ndarray, norm: float, query: bool = False) -> np.ndarray:
    """(rows, TREES) hash strings as longs; a query has no extra component and no salt."""
    scaled = vectors.astype(float) / norm
    extra = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(1 - (scaled**2).sum(axis=1), 0))
    own = np.column_stack([scaled, extra]).astype(np.float32)
    signs = (own @ _planes(vectors.shape[1]) > 0).reshape(len(own), TREES, BITS)
    # 22 bits each fit a float product exactly
    halves = [(signs[:, :, i : i + 22].astype(np.float32) @ _WEIGHTS[BITS - 22 :].astype(np.float32)).astype(np.int64) for i in (0, 22)]
    salt = 0 if query else (((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SALT)).astype(np.int64))[:, None]
    return (halves[0] << 22 | halves[1]) << SALT | salt


def depths(cosine: float, coverage: float = COVERAGE) -> tuple[int, int]:
    """(x, n): prefixes of x signs in n trees and x + 1 signs in the others find a vector with the coverage."""
    agree = 1 - np.arccos(np.clip(cosine, -1, 1)) / np.pi
    for x in range(BITS - 1, -1, -1):
        shallow, deep = np.log1p(-min(agree**x, 1 - 1e-12)), np.log1p(-min(agree ** (x + 1), 1 - 1e-12))
        for n in range(TREES + 1):
            if n * shallow + (TREES - n) * deep <= np.log(1 - coverage):
                return x, n
    return 0, TREES


def usable(vec_id: Column, embedding: Column) -> Column:
    """Rows that take part: an id, and a vector without null or non-finite components that is not zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vec_id.isNotNull() & embedding.isNotNull() & finite & F.exists(embedding, lambda x: x != 0)


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and offsets of a list column."""
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(np.diff(column.offsets.to_numpy()))])


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers, ids and matrix of the vectors of each length, a few thousand at a time."""
    flat, offsets = _matrix(batch.column(1))
    sizes, ids = np.diff(offsets), batch.column(0).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes).tolist():
        every = np.nonzero(sizes == size)[0]
        for at in range(0, len(every), 2048):
            rows = every[at : at + 2048]
            yield rows, ids[rows], flat[offsets[rows][:, None] + np.arange(size)]


ROUTED = pa.schema(
    [("size", pa.int32()), ("segment", pa.int64()), ("part", pa.int32()), ("query", pa.bool_()), ("low", pa.int64()), ("high", pa.int64()),
     ("vec_id", pa.int64()), ("floor", pa.float64()), ("vector", pa.binary())]
)
ROUTED_DDL = "size int, segment long, part int, query boolean, low long, high long, vec_id long, floor double, vector binary"


def _routed(segment, part, query: bool, low, high, ids, floor, vectors: np.ndarray) -> pa.RecordBatch:
    n, size = vectors.shape
    width = size * vectors.itemsize
    offsets = pa.py_buffer(np.arange(0, (n + 1) * width, width, dtype=np.int32))
    packed = pa.Array.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(np.ascontiguousarray(vectors))])
    columns = [np.full(n, size, np.int32), segment, part.astype(np.int32), np.full(n, query), low, high, ids, floor]
    return pa.record_batch([*(pa.array(c) for c in columns), packed], ROUTED)


class Forest:
    """Largest norm and the cuts of each tree, which are all that tasks need to know of the whole table."""

    def __init__(self, norm: float, cuts: list[np.ndarray]):
        self.norm, self.cuts = norm, cuts
        self.width = max(map(len, cuts)) + 1  # segments of a tree

    def descents(self, ids: np.ndarray, vectors: np.ndarray, floors: np.ndarray) -> Iterator[tuple]:
        """(rows, segment, low, high): each query in the one segment of each tree that holds its place."""
        key = strings(vectors, ids, self.norm, query=True)
        every = np.arange(len(ids))
        for t in range(TREES):
            yield every, t * self.width + np.searchsorted(self.cuts[t], key[:, t], "right"), key[:, t], key[:, t]

    def ascents(self, ids: np.ndarray, vectors: np.ndarray, floors: np.ndarray) -> Iterator[tuple]:
        """(rows, segment, low, high): each query in all segments that hold strings with the prefixes it has ascended to."""
        key = strings(vectors, ids, self.norm, query=True)
        cosine = np.where(np.isnan(floors), -1, floors) / (np.sqrt((vectors.astype(float) ** 2).sum(axis=1)) * self.norm)
        reach = np.array([depths(round(float(c), 3)) if not np.isnan(f) else (0, TREES) for c, f in zip(cosine, floors)])
        for t in range(TREES):
            depth = reach[:, 0] + (t >= reach[:, 1])
            shift = BITS - depth + SALT
            low = key[:, t] >> shift << shift
            high = low | ((np.int64(1) << shift) - 1)
            # at the root every string of one tree is a candidate, so the others have nothing to add
            wanted = (reach[:, 0] > 0) | (reach[:, 1] == 0) | (t == 0)
            first, last = (np.searchsorted(self.cuts[t], x, "right") for x in (low, high))
            count = np.where(wanted, last - first + 1, 0)
            row = np.repeat(np.arange(len(ids)), count)
            step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            for at in range(0, len(row), 8192):
                r = row[at : at + 8192]
                yield r, t * self.width + first[r] + step[at : at + 8192], low[r], high[r]

    def places(self, ids: np.ndarray, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(segment, key) of vectors in each tree."""
        key = strings(vectors, ids, self.norm)
        for t in range(TREES):
            yield t * self.width + np.searchsorted(self.cuts[t], key[:, t], "right"), key[:, t]


FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


class _Segment:
    """The vectors of a segment in the order of their strings, and how queries meet them."""

    def __init__(self, k: int, around: int):
        self.k, self.around = k, around
        self.parts: list[tuple] = []

    def add(self, keys: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.parts.append((keys, ids, vectors))

    def answers(self, low: np.ndarray, high: np.ndarray, ids: np.ndarray, floor: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch | None:
        """The best k of each query; queries come in the order of low and high."""
        if len(self.parts) != 1:
            self.parts = [tuple(map(np.concatenate, zip(*self.parts)))] if self.parts else []
        if not self.parts:
            return None
        keys, own, held = self.parts[0]
        change = np.nonzero((np.diff(low) != 0) | (np.diff(high) != 0))[0] + 1
        found = []
        for i, j in zip([0, *change], [*change, len(low)]):
            first, last = np.searchsorted(keys, low[i], "left"), np.searchsorted(keys, high[i], "right")
            if self.around:  # the strings next to its place
                first, last = max(0, first - self.around // 2), min(len(keys), last + self.around // 2)
            for g in range(i, j, 512):
                group = slice(g, min(g + 512, j))
                for at in range(first, last, 4096):
                    some = slice(at, min(at + 4096, last))
                    found.append(self._scored(ids[group], floor[group], vectors[group], own[some], held[some]))
        found = [x for x in found if len(x[0])]
        if not found:
            return None
        best = _best(*(np.concatenate(x) for x in zip(*found)), self.k)
        return pa.record_batch([pa.array(x) for x in best], FOUND)

    def _scored(self, asked: np.ndarray, floor: np.ndarray, queries: np.ndarray, own: np.ndarray, held: np.ndarray) -> tuple:
        """The k best of each query and what may tie with them; scores come from one plain sum in double precision per pair."""
        product = queries @ held.T
        product[asked[:, None] == own] = -np.inf
        unit = np.finfo(product.dtype).eps * 8 * queries.shape[1]
        reach = np.sqrt((queries.astype(float) ** 2).sum(axis=1) * (held.astype(float) ** 2).sum(axis=1).max(initial=0))
        slack = np.maximum(unit * reach, 1e-300)  # what rounding may do to a product
        least = floor - slack
        if product.shape[1] > self.k:
            least = np.maximum(least, np.partition(product, -self.k, axis=1)[:, -self.k] - 2 * slack)
        row, column = np.nonzero((product >= least[:, None]) & (product > -np.inf))
        score = np.einsum("ij,ij->i", queries[row].astype(float), held[column].astype(float))
        return _best(asked[row], own[column], score, self.k)


def _best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each query, ties to the smaller id."""
    if not len(query):
        return query, ids, score
    order = np.lexsort((ids, -score, query))
    query, ids, score = query[order], ids[order], score[order]
    starts = np.concatenate([[True], query[1:] != query[:-1]])
    rank = np.arange(len(query)) - np.maximum.accumulate(np.where(starts, np.arange(len(query)), 0))
    return query[rank < k], ids[rank < k], score[rank < k]


def _searched(rows: DataFrame, asked: DataFrame, forest: Forest, ways: Callable, dtype: str, k: int, around: int) -> DataFrame:
    """(query_id, vec_id, score): the k best of each query in each segment it comes to.

    ``ways`` says where a query comes to; asked has a floor below which scores do not count.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            floors = batch.column(2).to_numpy(zero_copy_only=False)
            for at, ids, vectors in _by_size(batch):
                for _, segment, _, _ in ways(forest, ids, vectors, floors[at]):
                    own, n = np.unique(segment, return_counts=True)
                    yield pa.record_batch([pa.array(own), pa.array(n)], ["segment", "n"])

    # a number for each segment of the index at most
    counts = asked.mapInArrow(counted, "segment long, n long").groupBy("segment").agg(F.sum("n")).collect()
    parts = np.zeros(TREES * forest.width, np.int64)
    for segment, n in counts:
        parts[segment] = -(-n // BLOCK)

    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, ids, vectors in _by_size(batch):
                for segment, key in forest.places(ids, vectors):
                    row = np.repeat(np.arange(len(ids)), parts[segment])
                    part = np.arange(len(row)) - np.repeat(np.cumsum(parts[segment]) - parts[segment], parts[segment])
                    for at in range(0, len(row), 8192):
                        r = row[at : at + 8192]
                        yield _routed(segment[r], part[at : at + 8192], False, key[r], key[r], ids[r], np.zeros(len(r)), vectors[r].astype(dtype))

    def queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            floors = batch.column(2).to_numpy(zero_copy_only=False)
            for at, ids, vectors in _by_size(batch):
                floor = floors[at]
                for r, segment, low, high in ways(forest, ids, vectors, floor):
                    part = _scattered(ids[r]) % parts[segment]
                    yield _routed(segment, part, True, low, high, ids[r], np.where(np.isnan(floor[r]), -np.inf, floor[r]), vectors[r].astype(dtype))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own = None, None
        for batch in batches:
            size, segment, part, query, low, high, ids, floor = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(8))
            edges = np.nonzero((np.diff(size) != 0) | (np.diff(segment) != 0) | (np.diff(part) != 0) | (query[1:] != query[:-1]))[0] + 1
            for i, j in zip([0, *edges], [*edges, len(ids)]):
                if i == j:
                    continue
                if (key := (size[i], segment[i], part[i])) != now:
                    now, own = key, _Segment(k, around)
                vectors = np.frombuffer(b"".join(batch.column(8).slice(i, j - i).to_pylist()), dtype).reshape(j - i, int(size[i]))
                if not query[i]:
                    own.add(low[i:j], ids[i:j], vectors)
                elif (found := own.answers(low[i:j], high[i:j], ids[i:j], floor[i:j], vectors)) is not None:
                    yield found

    routed = rows.mapInArrow(items, ROUTED_DDL).unionByName(asked.mapInArrow(queries, ROUTED_DDL))
    dealt = routed.repartition("size", "segment", "part").sortWithinPartitions("size", "segment", "part", "query", "low", "high", "vec_id")
    return dealt.mapInArrow(search, "query_id long, vec_id long, score double")


def _scattered(ids: np.ndarray) -> np.ndarray:
    return ((ids.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(33)).astype(np.int64)


def _cuts(rows: DataFrame, norm: float, n: int) -> list[np.ndarray]:
    """Where the strings of each tree are cut so that those of a sample fall evenly into the segments."""
    width = max(1, -(-n // SEGMENT))
    if width == 1:
        return [np.zeros(0, np.int64)] * TREES

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, ids, vectors in _by_size(batch):
                key = strings(vectors, ids, norm)
                yield pa.record_batch([pa.array(np.tile(np.arange(TREES, dtype=np.int32), len(ids))), pa.array(key.reshape(-1))], ["tree", "key"])

    share = min(1.0, max(4096, width * SAMPLED) / n)
    some = rows.where(F.pmod(F.xxhash64("vec_id", F.lit(SEED)), F.lit(1 << 30)) < int(share * (1 << 30)))
    keys = some.mapInArrow(sampled, "tree int, key long")
    tree = Window.partitionBy("tree")
    place = F.floor((F.row_number().over(tree.orderBy("key")) - 1) * width / F.count("*").over(tree))
    cut = keys.withColumn("place", place).groupBy("tree", "place").agg(F.min("key").alias("key")).where("place > 0")
    found: list[list[int]] = [[] for _ in range(TREES)]
    for tree_number, _, key in sorted(cut.collect()):
        found[tree_number].append(key)
    return [np.array(x, np.int64) for x in found]


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of vectors for each row of queries, found by the forest.

    score is the inner product in double precision; ties go to the smaller vec_id; a row
    with the query's own id is no candidate.  Rows with a null id and vectors that are
    null, zero or hold null or non-finite components take no part; vectors are compared
    with those of their own length.  Of rows with the same id the one with the least
    vector counts.  Fewer than k candidates are all returned; no candidates, no rows.
    Other columns are not read.
    """
    single = all(x.schema[embedding].dataType.simpleString() == "array<float>" for x in (vectors, queries))

    def prepared(rows: DataFrame) -> DataFrame:
        rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<float>" if single else "array<double>").alias("v"))
        return rows.where(usable(F.col("vec_id"), F.col("v"))).groupBy("vec_id").agg(F.min("v").alias("v"))

    rows, asked = settle(prepared(vectors)), settle(prepared(queries))
    norm2, n = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x)), F.count("*")).first()
    norm = max(float(norm2 or 0.0) ** 0.5, 1e-300)
    forest, dtype = Forest(norm, _cuts(rows, norm, n)), "<f4" if single else "<f8"
    first = _searched(rows, asked.withColumn("floor", F.lit(None).cast("double")), forest, Forest.descents, dtype, k, AROUND)
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def ranked(found: DataFrame) -> DataFrame:
        return found.dropDuplicates(["query_id", "vec_id"]).withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)

    first = settle(ranked(first))
    floors = first.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
    again = settle(asked.join(floors, "vec_id", "left").select("vec_id", "v", "floor"))
    second = _searched(rows, again, forest, Forest.ascents, dtype, k, 0)
    # what the descent met may lie outside the prefixes ascended to
    return ranked(second.unionByName(first.drop("rank"))).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

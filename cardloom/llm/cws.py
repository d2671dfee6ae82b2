"""Document fingerprints by consistent weighted sampling.

A document is a bag of terms (pairs of neighbouring words, or its one word) with
their counts as weights.  For each of ``SAMPLES`` hash functions a term of weight w
draws r and c from Gamma(2, 1) and b from the uniform distribution and gets

    t = floor(ln w / r + b),   ln y = r (t - b),   ln a = ln c - ln y - r.

The term with the least a and its t are the sample.  Two documents agree in a
sample with the probability of their generalised Jaccard similarity, the sum of
the lesser weights over the sum of the greater ones.

The draws come from a fixed table of 65,536 triples; the top bits of a hash of term
and function choose the triple.  The table is ordered by ln a at weight one, so among
terms of weight one the least hash is the least a, and ties fall to the other bits.
A fingerprint keeps one byte of each sample; likeness() corrects for chance matches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

SAMPLES, SEED = 128, 7
_TRIPLES, _CHUNK, REMEMBERED = 1 << 16, 2048, 500_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _draws() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(r, ln c, b) by triple in order of ln a at weight one, and an odd multiplier for each sample."""
    rng = np.random.default_rng(SEED)
    r, c, b = rng.gamma(2.0, size=_TRIPLES), np.log(rng.gamma(2.0, size=_TRIPLES)), rng.random(_TRIPLES)
    order = np.argsort(c + r * b - r, kind="stable")
    multipliers = rng.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return r[order], c[order], b[order], multipliers


@lru_cache(maxsize=4096)
def _at_weight(weight: int) -> tuple[np.ndarray, np.ndarray]:
    """ln a and t of each triple for a weight."""
    r, c, b, _ = _draws()
    t = np.floor(np.log(weight) / r + b)
    return (c - r * (t - b) - r).astype(np.float32), t.astype(np.int32)


class _Words(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode(), SEED)
        return value


_words = _Words()


def terms(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit terms of a text and their counts; a wordless text has one term of its own."""
    words = (text or "").lower().split()
    if not words:
        return np.zeros(1, np.uint64), np.ones(1, np.int64)
    own = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    if len(own) > 1:
        own = (own[:-1] ^ (own[:-1] >> np.uint64(29))) * _MIX + own[1:]
    own = (own ^ (own >> np.uint64(32))) * _MIX
    return np.unique(own, return_counts=True)


def signature(text: str | None) -> np.ndarray:
    """One byte for each sample."""
    term, weight = terms(text)
    multipliers = _draws()[3][:, None]
    best = np.full(SAMPLES, np.inf, np.float32)
    tie = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    chosen, step = np.zeros(SAMPLES, np.uint64), np.zeros(SAMPLES, np.int32)
    every = np.arange(SAMPLES)
    for w in np.unique(weight).tolist():
        value, t = _at_weight(w)
        some = term[weight == w]
        for at in range(0, len(some), _CHUNK):
            part = some[at : at + _CHUNK]
            hashes = part * multipliers
            triple = (hashes >> np.uint64(48)).astype(np.int64) if w > 1 else None
            place = hashes.argmin(axis=1) if w == 1 else value[triple].argmin(axis=1)
            least = hashes[every, place]
            if w > 1:  # terms that share the least triple: the least hash decides
                tied = triple == triple[every, place][:, None]
                place = np.where(tied, hashes, np.iinfo(np.uint64).max).argmin(axis=1)
                least = hashes[every, place]
            own = (least >> np.uint64(48)).astype(np.int64)
            better = (value[own] < best) | ((value[own] == best) & (least < tie))
            best, tie = np.where(better, value[own], best), np.where(better, least, tie)
            chosen, step = np.where(better, part[place], chosen), np.where(better, t[own], step)
    return (((chosen ^ (step.astype(np.uint64) * _MIX)) * _MIX) >> np.uint64(56)).astype(np.uint8)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated generalised Jaccard similarity of two signatures, 0 to 1."""
    equal = float((a == b).mean())
    return max(0.0, (equal - 1 / 256) / (1 - 1 / 256))


def fingerprint(text: Column | str) -> Column:
    """Fingerprint of a text column in hex, two digits a sample; null counts as empty."""

    @arrow_udf("string")
    def hashed(texts: pa.Array) -> pa.Array:
        return pa.array([signature(x.as_py()).tobytes().hex() for x in texts], pa.string())

    return hashed(text)


REVISIONS = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)
_LEAST = -(1 << 63)


def _ranges(docs: DataFrame, key: Column, buckets: int) -> tuple[list[int], dict[int, tuple[int, int]]]:
    """Lower ends of ranges of ids in falling order, and of each range's first id its range and the one before.

    Both are as long as the number of ranges, which does not grow with the rows.
    """
    shares = [i / buckets for i in range(buckets - 1, 0, -1)]
    ends = docs.agg(F.percentile_approx(key, shares or [0.0], max(10_000, 20 * buckets))).first()[0]
    ends = sorted({int(x) for x in ends or ()}, reverse=True)
    firsts = docs.groupBy(_bucket(ends)(key).alias("bucket")).agg(F.max(key).alias("first")).orderBy("bucket").collect()
    before = [firsts[-1]["bucket"], *(r["bucket"] for r in firsts)] if firsts else []
    return ends, {r["first"]: (r["bucket"], b) for r, b in zip(firsts, before)}


def _bucket(ends: list[int]):
    rising = np.array(ends[::-1], np.int64)

    @arrow_udf("int")
    def bucket(keys: pa.Array) -> pa.Array:
        found = len(rising) - np.searchsorted(rising, keys.to_numpy(zero_copy_only=False), "right")
        return pa.array(found.astype(np.int32))

    return bucket


def revisions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each document and of it with its second half overwritten by the next one.

    The next document is that of the next lower doc_id, after the last the first.
    Rows of one doc_id follow each other by text, null ids come last, null texts
    count as empty; one document alone is its own next.  Returns doc_id, n_chars (code
    points), edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next;
    other columns are not read, an empty table gives no rows.

    Ids are cut into ranges by approximate quantiles.  A range is sorted and read as a
    stream; the first row of the range after it is sent along, so texts are shuffled
    once and no task holds more than a batch.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    key = F.coalesce("doc_id", F.lit(_LEAST))
    ends, firsts = _ranges(docs.select("doc_id"), key, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rising = np.array(sorted(firsts), np.int64)
    before = np.array([firsts[k][1] for k in sorted(firsts)], np.int32)

    @arrow_udf("array<int>")
    def copies(keys: pa.Array) -> pa.Array:
        """Ranges that a row goes to: its own, and if it is a range's first the one before as -1 - range."""
        keys = keys.to_numpy(zero_copy_only=False)
        own = len(ends) - np.searchsorted(np.array(ends[::-1], np.int64), keys, "right")
        at = np.minimum(np.searchsorted(rising, keys), max(len(rising) - 1, 0))
        first = rising[at] == keys
        return pa.array([[o, -1 - before[i]] if f else [o] for o, f, i in zip(own, first, at)], pa.list_(pa.int32()))

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = []
            for bucket, ahead, own_id, own in zip(*(batch.column(i).to_pylist() for i in range(4))):
                own = own or ""
                mark = signature(own)
                if held is not None and held[0] == bucket:
                    rows.append(_revision(*held[1:], own, mark))
                    held = None
                if not ahead:
                    held = (bucket, own_id, own, mark)
            columns = zip(*rows) if rows else ([] for _ in REVISIONS)
            yield pa.record_batch([pa.array(x, f.type) for x, f in zip(columns, REVISIONS)], REVISIONS)

    placed = docs.withColumn("at", F.explode(copies(key))).select(
        F.when(F.col("at") < 0, -1 - F.col("at")).otherwise(F.col("at")).alias("bucket"), (F.col("at") < 0).alias("ahead"), "doc_id", "text"
    )
    order = ["bucket", "ahead", F.desc_nulls_last("doc_id"), "text"]
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return placed.repartition("bucket").sortWithinPartitions(*order).mapInArrow(paired, schema)


def _revision(doc_id: int | None, text: str, mark: np.ndarray, after: str, after_mark: np.ndarray) -> tuple:
    half = len(text) // 2
    edited = text[: len(text) - half] + after[:half]
    edited_mark = signature(edited)
    digest = hashlib.sha256(edited.encode()).hexdigest()
    marks = mark.tobytes().hex(), edited_mark.tobytes().hex()
    return doc_id, len(text), digest, *marks, likeness(mark, edited_mark), likeness(mark, after_mark)

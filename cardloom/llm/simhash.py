"""SimHash near-duplicate groups through Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits.  Each segment,
padded to 23 bits, is a received word of the perfect binary Golay code, which
decodes every word to the one codeword within three bits.  Two words that differ
in at most two bits have a word between them, so the codewords that a word and
its one-bit neighbours decode to (six of them, as a rule) always have one in
common.  That gives keys which survive errors:

* some segment has no error, so of the two others one has at most two: the key is
  the exact segment plus a codeword of the other one;
* no segment is without error, so with at most four errors two segments have
  exactly one each, and the third at most two: the key is a codeword of each of the first two, widened
  on one side only, and a codeword of the third.

So a key holds 33 bits at least.  A fingerprint has some 190 keys and meets, in all its buckets together, about
one of 1.2 million unrelated ones.

Equal keys bring fingerprints together; their distance is then verified.  A
bucket is searched breadth first for a spanning forest, so a dense group of n
fingerprints costs and emits about n links, not all its pairs.  Buckets above
``BLOCK`` members are cut into blocks that are compared pair by pair of blocks
in tasks of their own, which is exact too.

Four bits stand for copies of about 0.95 similarity and more; ``near_copies_dropped``
finds looser ones by their shingles themselves (``jaccard``).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from . import jaccard
from .graph import components, join_by_key, least_by_key
from .runtime import settle
from .shingles import hashes_of, majority

MAX_BITS = 4
BLOCK = 4096
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 generates the (23, 12, 7) code.
GENERATOR = 0b101011100011


def fingerprint(text: Column | str, shingle: int = 4) -> Column:
    """SimHash of a text column as a signed long.

    Words of a text are runs of non-white-space after lower-casing A-Z; shingles count
    as often as they occur.  Null and wordless texts give 0.
    """

    @arrow_udf("long")
    def hashed(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([majority(hashes_of(x.as_py(), shingle)) for x in texts], np.uint64).view(np.int64))

    return hashed(text)


@lru_cache(maxsize=1)
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low and high part of a word, and the error of each syndrome."""
    bit = []
    for i in range(23):
        word = 1 << i
        for shift in range(i - 11, -1, -1):
            if word >> (shift + 11) & 1:
                word ^= GENERATOR << shift
        bit.append(word)
    low, high = np.zeros(1 << 12, np.int64), np.zeros(1 << 11, np.int64)
    for i in range(23):
        part, at = (low, i) if i < 12 else (high, i - 12)
        part[(np.arange(len(part)) >> at & 1) == 1] ^= bit[i]
    error = np.zeros(1 << 11, np.int64)
    for i in range(23):
        for j in range(i, 23):
            for k in range(j, 23):
                places = {i, j, k}
                syndrome = 0
                for p in places:
                    syndrome ^= bit[p]
                error[syndrome] = sum(1 << p for p in places)
    return low, high, error


def codeword(words: np.ndarray) -> np.ndarray:
    """Index (0 to 4095) of the codeword within three bits of each 23-bit word."""
    low, high, error = _golay()
    return (words ^ error[low[words & 0xFFF] ^ high[words >> 12]]) >> 11


def nearby(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and distinct codeword indices of each word and its one-bit neighbours."""
    flips = np.array([0] + [1 << i for i in range(width)])
    found = np.sort(codeword(words[:, None] ^ flips), axis=1)
    new = np.ones(found.shape, bool)
    new[:, 1:] = found[:, 1:] != found[:, :-1]
    row, at = np.nonzero(new)
    return row, found[row, at]


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, row numbers) of unsigned fingerprints: any two within four bits have a key in common."""
    exact = [(prints >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    near = [nearby(x, width) for x, (_, width) in zip(exact, SEGMENTS)]
    plain = [codeword(x) for x in exact]
    keys, rows, kind = [], [], 0
    for a in range(3):
        for b in range(3):
            if a != b:
                row, code = near[b]
                keys.append(kind << 40 | exact[a][row] << 12 | code)
                rows.append(row)
                kind += 1
    for a, b, c in ((0, 1, 2), (0, 2, 1), (1, 2, 0)):
        (row_b, code_b), (row_a, code_a) = near[b], near[a]
        new = code_a != plain[a][row_a]
        row = np.concatenate([row_b, row_a[new]])
        pair = np.concatenate([plain[a][row_b] << 12 | code_b, code_a[new] << 12 | plain[b][row_a[new]]])
        row_c, code_c = near[c]
        counts = np.bincount(row_c, minlength=len(prints))
        starts, many = np.cumsum(counts) - counts, counts[row]
        each = np.repeat(np.arange(len(row)), many)
        step = np.arange(len(each)) - np.repeat(np.cumsum(many) - many, many)
        keys.append(kind << 40 | pair[each] << 12 | code_c[starts[row[each]] + step])
        rows.append(row[each])
        kind += 1
    return np.concatenate(keys), np.concatenate(rows)


def _near(x: np.ndarray, y: np.ndarray, max_bits: int) -> np.ndarray:
    """Whether rows of words are within max_bits in all."""
    return np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int64) <= max_bits


def forest(prints: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links (by first word) that span the groups of fingerprints with distinct first words, found breadth first."""
    links, rest = [], prints
    while len(rest) > 1:
        root, rest, queue = rest[0], rest[1:], [rest[0]]
        while queue and len(rest):
            close = _near(rest, queue.pop(), max_bits)
            if close.any():
                queue.extend(rest[close])
                links.extend((root[0], x[0]) for x in rest[close])
                rest = rest[~close]
    return links


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64())])


def _links(a: np.ndarray, b: np.ndarray, key: np.ndarray | None = None) -> pa.RecordBatch:
    """Links between fingerprints, or with a key members (a) of a bucket that is still to be cut."""
    b = pa.array(b.view(np.int64)) if key is None else pa.nulls(len(a), pa.int64())
    return pa.record_batch([pa.array(a.view(np.int64)), b, pa.array(key, pa.int64()) if key is not None else pa.nulls(len(a), pa.int64())], LINKS)


def _buckets(n_keys: int, max_bits: int, most: int | None):
    """Reads (key..., word...) rows sorted by key and gives links, and the members of buckets above most."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        cut: tuple | None = None  # the key whose members are passed on

        def linked(i: int, j: int) -> Iterator[pa.RecordBatch]:
            _, first = np.unique(words[i:j, 0], return_index=True)
            if found := forest(words[i:j][first], max_bits):
                yield _links(*np.array(found, np.uint64).T.copy())

        for batch in batches:
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
            now = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            keys, words = now[:n_keys], np.column_stack(now[n_keys:]).view(np.uint64)
            change = np.zeros(len(words), bool)
            for k in keys:
                change[1:] |= k[1:] != k[:-1]
            starts = np.concatenate([[0], np.nonzero(change)[0]])
            last = int(starts[-1])
            yield from _runs(words, starts, last, max_bits)
            for i, j in zip(starts[:-1], starts[1:]):
                if j - i > 8:
                    first = tuple(int(k[i]) for k in keys)
                    if first == cut or most is not None and j - i > most:
                        yield _links(words[i:j, 0], None, keys[0][i:j])
                    else:
                        yield from linked(i, j)
                elif cut is not None and tuple(int(k[i]) for k in keys) == cut:
                    yield _links(words[i:j, 0], None, keys[0][i:j])
            held = [x[last:] for x in now]
            if most is not None and (len(held[0]) > most or cut == tuple(int(k[last]) for k in keys)):
                cut = tuple(int(k[last]) for k in keys)
                yield _links(words[last:, 0], None, held[0])
                held = [x[:0] for x in held]
        if held is not None and len(held[0]) > 1:
            words = np.column_stack(held[n_keys:]).view(np.uint64)
            if cut is not None and tuple(int(k[0]) for k in held[:n_keys]) == cut:
                yield _links(words[:, 0], None, held[0])
            else:
                yield from linked(0, len(words))

    return search


def _runs(words: np.ndarray, starts: np.ndarray, last: int, max_bits: int) -> Iterator[pa.RecordBatch]:
    """Links within the buckets of at most eight members that end before row last."""
    sizes = np.diff(starts)
    small = np.repeat(sizes <= 8, sizes)
    own = np.repeat(np.arange(len(sizes)), sizes)
    for step in range(1, 8):
        if last <= step:
            break
        same = small[step:] & (own[step:] == own[:-step])
        at = np.nonzero(same)[0]
        if not len(at):
            break
        x, y = words[at], words[at + step]
        near = _near(x, y, max_bits) & (x[:, 0] != y[:, 0])
        if near.any():
            yield _links(x[near, 0], y[near, 0])


def links(prints: DataFrame, column: str = "fingerprint", max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(a, b) links that join distinct fingerprints within max_bits, four at most, into groups.

    Not every near pair is returned, but every near pair is connected by returned links.
    """
    prints = prints.select(F.col(column).cast("long").alias("word"))

    def widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(values), 4096):
                some = values[at : at + 4096]
                key, row = keys_of(some.view(np.uint64))
                yield pa.record_batch([pa.array(key), pa.array(some[row])], ["key", "word"])

    dealt = prints.mapInArrow(widen, "key long, word long").repartition("key").sortWithinPartitions("key", "word")
    found = settle(dealt.mapInArrow(_buckets(1, max_bits, block), "a long, b long, key long"))
    large = found.where("key is not null").select("key", F.col("a").alias("word")).distinct()
    parts = large.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    blocks = (
        large.join(parts, "key")
        .withColumn("own", own)
        .select("key", "word", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "word")
    )
    rest = (
        blocks.repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "word")
        .mapInArrow(_buckets(3, max_bits, None), "a long, b long, key long")
    )
    return found.where("key is null").select("a", "b").unionByName(rest.select("a", "b"))


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per row of docs.

    fingerprint is a signed long; component_id the least doc_id that
    links reach, the document itself included.  Null and wordless texts have fingerprint 0,
    which links like any other.  Repeated rows stay and share a component; a null doc_id keeps its row and is no
    component_id unless nothing else is there.  An empty table gives an empty result;
    other columns are not read.
    """
    prints = settle(docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text), shingle).alias("fingerprint")))
    distinct = settle(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("_n")))
    linked = components(links(distinct, "fingerprint", max_bits)).withColumnRenamed("node", "fingerprint")
    rooted = settle(distinct.join(linked, "fingerprint", "left").select("fingerprint", "least_id", "_n", F.coalesce("root", "fingerprint").alias("root")))
    n_distinct, n = rooted.agg(F.count("*"), F.coalesce(F.sum("_n"), F.lit(0))).first()
    named = least_by_key(rooted, "root", "least_id", "component_id", n_distinct).select("fingerprint", "component_id", "_n")
    return join_by_key(prints, named, "fingerprint", "_n", n).select("doc_id", "fingerprint", "component_id")


def near_pairs(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b) pairs of ids that join all rows of (id, fingerprint) whose fingerprints are near; ids are distinct."""
    prints = settle(prints)
    n = prints.count()
    own = settle(least_by_key(prints, "fingerprint", "id", "least", n), n)
    first = own.where("id = least").select("fingerprint", "id")
    linked = settle(links(first, "fingerprint", max_bits))
    for side in ("a", "b"):
        linked = linked.join(first.withColumnsRenamed({"fingerprint": side, "id": f"id_{side}"}), side)
    return own.where("id <> least").select(F.col("id").alias("a"), F.col("least").alias("b")).unionByName(linked.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")))


def near_copies_dropped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs without near copies: of each group the row of least doc_id stays, null ids last.

    Copies have a Jaccard similarity of their sets of shingles of at least the given one;
    all such pairs are linked, and no others.  Fingerprints that are near find most of them, the shared
    shingles of ``jaccard`` the rest; all are compared whole.  Different texts of one doc_id that are no copies
    both stay, equal rows count as one.  Null and wordless texts are copies.  Columns are those of docs.
    """
    return jaccard.one_of_each(docs, doc_id, text, shingle, similarity, near_pairs)


def as_hex(column: Column | str) -> Column:
    """16 lowercase hex digits of a signed long."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))

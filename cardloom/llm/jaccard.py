"""Pairs of texts whose sets of shingles have at least a given Jaccard similarity, all of them.

Two sets of a similarity of t or more have at least t * n shingles in common, n the size of
either.  So with all shingles in one order, the first n - ceil(t * n) + 1 of the one set and of
the other have one in common.  Those are the keys; any order is exact, and one from rare to
frequent keeps buckets small.

Here the order is: shingles by the number of texts that have them, then those that are frequent
in a sample of the documents, so that no shingle of a large part of all texts is ever dealt to be counted.  A text
with as many shingles of its own as it has keys has no copy at all and gets no key.  That is found for most texts from one
in ``PART`` of their shingles, and only the others deal all of them.

Two sets whose first key in common is at the places i and j have at most the lesser of n - i
and m - j shingles in common, which rules out most of those that share only frequent ones.
What is left is asked for the parities of its shingles in 512 cells: a cell with different ones has a shingle that
only one of the sets has, so sets with more such cells than the similarity leaves unshared are not alike.
The others are compared whole, by their texts.  Equal texts are one throughout.  Of the texts with keys,
candidates that another method finds (``near``) are compared first, which joins most copies.  In a bucket, members in order of size
meet only those that size and place allow, so what that rules out costs nothing.  Where the pairs that are allowed, by parities too, and not yet
in one group are still too many, each set is compared with the first of one of its buckets next; then all such pairs are compared.

Keys, hubs and texts that a large part of the rows have are met where these rows are, or in many parts.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import HOT, components, join_by_key, least_by_key
from .runtime import gathered, held, settle
from .shingles import hashes_of, majority

#: Documents that tell which shingles are frequent, and how many of these are known by name. Results do not depend on them.
SAMPLE, FREQUENT, SEED = 4_096, 65_536, 42
#: Stars are drawn while buckets hold more open pairs than so many for each of their rows, and this often at most.
#: The pairs are told from so many members of a bucket; results do not depend on it.
PAIRS, STARS, ASKED = 1, 6, 256
#: Words of 64 cells that hold the parities of a set.
WORDS = [f"w{i}" for i in range(8)]
#: Pairs of texts that one task compares, where there are few.
COMPARED = 4_096
#: One in so many shingles tells which texts have enough of their own. Texts up to so many are found by a broadcast of their numbers, more by a shuffle.
PART, BROADCAST = 3, 1 << 21
_SLACK = 1e-9


def shingles_of(text: str | None, shingle: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of shingle words; of all words where there are fewer, none without words."""
    return np.unique(hashes_of(text, shingle))


def n_keys(n: int, similarity: float) -> int:
    """How many of its n shingles a set this similar to another cannot lack all of."""
    return n - max(1, math.ceil(similarity * n - _SLACK)) + 1 if n else 0


def split_keys(hashes: np.ndarray, similarity: float, frequent: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes that are not frequent, and the frequent ones that are needed where those are fewer than the keys; frequent is sorted."""
    if not len(frequent):
        return hashes, hashes[:0]
    place = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
    known = frequent[place] == hashes
    rare = hashes[~known]
    late = hashes[known][np.argsort(rank[place[known]])]
    return rare, late[: max(0, n_keys(len(hashes), similarity) - len(rare))]


def parities(hashes: np.ndarray) -> np.ndarray:
    """Whether the number of hashes in each cell is odd, a bit a cell; where two sets differ, one has a hash that the other lacks."""
    cells = 64 * len(WORDS)
    odd = np.bincount((hashes % np.uint64(cells)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _alike(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common >= similarity * (len(x) + len(y) - common) - _SLACK


def _numbered(text: Column, *seed: Column) -> Column:
    """A text's number: equal texts have equal ones, and so have all wordless ones, null among them."""
    return F.xxhash64(*seed, F.when(text.rlike(r"[^\x20\x09-\x0D]"), text).otherwise(""))


def identified(docs: DataFrame, text: str, name: str) -> tuple[DataFrame, int]:
    """docs with a column of the text's number, different for different texts, and how many different texts there are.

    Texts that share a number of 64 bits, though a second one tells them apart, take a number made of both.
    """
    own, second = F.col(f"`{text}`").cast("string"), _free(docs, f"{name}_second")
    rows = docs.withColumns({name: _numbered(own), second: _numbered(own, F.lit(1))})
    numbers = settle(rows.groupBy(name).agg(F.min(second).alias("lo"), F.max(second).alias("hi")).groupBy((F.col("lo") < F.col("hi")).alias("clash")).agg(F.count("*").alias("n")))
    n = {r["clash"]: r["n"] for r in numbers.collect()}  # two rows at most
    if n.get(True):
        clash = settle(rows.groupBy(name).agg(F.min(second).alias("lo"), F.max(second).alias("hi")).where("lo < hi").select(name, F.lit(True).alias("clash")))
        rows = rows.join(clash, name, "left").withColumn(name, F.when(F.col("clash"), F.xxhash64(name, second)).otherwise(F.col(name)))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], name), sum(n.values())


def _frequent(own: DataFrame, shingle: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes that more than one text of a sample has, sorted, and their ranks from rare to frequent; own has n different texts."""
    some = own.sample(SAMPLE / n, SEED) if n > SAMPLE else own

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column(0):
                yield pa.record_batch([pa.array(shingles_of(x.as_py(), shingle).view(np.int64))], ["hash"])

    counts = some.dropDuplicates(["id"]).select("text").mapInArrow(hashed, "hash long").groupBy("hash").count().where("count > 1")
    rows = counts.orderBy(F.desc("count"), "hash").limit(FREQUENT).collect()
    hashes = np.array([r[0] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], -np.arange(len(rows))[order]


#: A shared key (key, id, df), or what is to be known of a text (id, fingerprint, n, dealt, late).
_ROWS = f"key long, id long, df long, fingerprint long, n long, dealt long, late array<long>, bits struct<{','.join(f'{w}:long' for w in WORDS)}>"
_BITS = pa.struct([(w, pa.int64()) for w in WORDS])
_ABOUT = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), _BITS)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (key, id) rows sorted by both those whose key has several ids, once each, with the number of these; rows about texts pass."""
    held = [np.zeros(0, np.int64)] * 2

    def several(keys: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        starts = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[0] if len(keys) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(starts, len(keys)))
        each = np.repeat(sizes, sizes)
        keep = each > 1
        found = [pa.array(x, pa.int64()) for x in (keys[keep], ids[keep], each[keep])]
        return _row_batch([*found, *(pa.nulls(len(found[0]), kind) for kind in _ABOUT)])

    for batch in batches:
        about = batch.column(3).is_valid()
        yield _row_batch([pa.nulls(len(x), x.type) if i == 0 else x for i, x in enumerate(batch.filter(about).columns)])
        batch = batch.filter(batch.column(3).is_null())
        keys, ids = (np.concatenate([h, batch.column(i).to_numpy(zero_copy_only=False)]) for i, h in enumerate(held))
        new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])]) if len(keys) else np.zeros(0, bool)
        keys, ids = keys[new], ids[new]
        last = np.searchsorted(keys, keys[-1], "left") if len(keys) else 0  # its run may go on
        yield several(keys[:last], ids[:last])
        held = [keys[last:], ids[last:]]
    yield several(*held)


def _row_batch(columns: list[pa.Array]) -> pa.RecordBatch:
    return pa.record_batch(columns, ["key", "id", "df", "fingerprint", "n", "dealt", "late", "bits"])


def _counted(own: DataFrame, shingle: int, similarity: float, frequent: np.ndarray, rank: np.ndarray, part: int) -> DataFrame:
    """Rows of _ROWS: of the shingles that are not frequent, one in part, those that several texts have, and a row about each text."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("jaccard")
        seen: set[int] = set()  # of this task: copies are looked at once in each
        for batch in batches:
            for own_id, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                if own_id in seen:
                    continue
                seen.add(own_id)
                every = hashes_of(x.as_py(), shingle)
                hashes = np.unique(every)
                rare, late = split_keys(hashes, similarity, frequent, rank)
                rare = rare[rare % np.uint64(part) == 0] if part > 1 else rare
                n = len(rare) + 1
                about = (np.uint64(majority(every)).view(np.int64), len(hashes), len(rare), late.view(np.int64), dict(zip(WORDS, parities(hashes).tolist())))
                more = [pa.array([v] + [None] * len(rare), kind) for v, kind in zip(about, _ABOUT)]
                keys = np.concatenate([np.array([own_id], np.int64), rare.view(np.int64)])
                yield _row_batch([pa.array(keys), pa.array(np.full(n, own_id, np.int64)), pa.nulls(n, pa.int64()), *more])

    dealt = own.select("id", "text").mapInArrow(keyed, _ROWS).repartition("key").sortWithinPartitions("key", "id")
    return settle(dealt.mapInArrow(_shared, _ROWS))


def _alive(found: DataFrame, similarity: float) -> DataFrame:
    """(id, fingerprint, n, dealt, late, bits, own, wanted) of the texts with fewer shingles of their own than keys, by what was dealt."""
    about = found.where("fingerprint IS NOT NULL").groupBy("id").agg(*[F.first(c).alias(c) for c in ("fingerprint", "n", "dealt", "late", "bits")])
    shared = found.where("df IS NOT NULL").groupBy("id").agg(F.count("*").alias("n_shared"))
    keys = F.when(F.col("n") > 0, F.col("n") - F.greatest(F.lit(1), F.ceil(similarity * F.col("n") - _SLACK)) + 1).otherwise(0)
    sized = about.join(shared, "id", "left").withColumn("own", F.col("dealt") - F.coalesce("n_shared", F.lit(0)))
    return sized.drop("n_shared").withColumn("wanted", keys - F.col("own")).where("wanted > 0")


def _keys(found: DataFrame, alive: DataFrame) -> DataFrame:
    """(key, id, size, at, bits) of the texts that may have a copy; at is the key's place among the text's shingles, bits are its parities."""
    place = F.row_number().over(Window.partitionBy("id").orderBy("df", "key"))
    shared = found.where("df IS NOT NULL").select("key", "id", "df").join(alive.select("id", "n", "own", "wanted"), "id")
    early = shared.withColumn("place", place).where("place <= wanted").select("key", "id", F.col("n").alias("size"), (F.col("own") + F.col("place") - 1).alias("at"))
    late = alive.select("id", F.col("n").alias("size"), "dealt", "bits", F.posexplode("late").alias("i", "key"))
    return early.join(alive.select("id", "bits"), "id").unionByName(late.select("key", "id", "size", (F.col("dealt") + F.col("i")).alias("at"), "bits"))


def _of(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows that have one of the distinct ids."""
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST else ids, "id", "left_semi")


def _verified(pairs: DataFrame, own: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Those of the (a, b) pairs whose whole sets are alike.

    A text that many pairs ask for is compared in many tasks: each has it once and reads those it is compared with.
    """

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, np.zeros(0, np.uint64)
        for batch in batches:
            hubs, others = [], []
            for hub, part, other, text in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
                own = shingles_of(text.as_py(), shingle)
                if other is None:
                    now, held = (hub, part), own
                elif now == (hub, part) and _alike(held, own, similarity):
                    hubs.append(hub)
                    others.append(other)
            yield pa.record_batch([pa.array(hubs, pa.int64()), pa.array(others, pa.int64())], ["a", "b"])
            pa.default_memory_pool().release_unused()

    pairs = settle(pairs)
    n = max(1, pairs.count())
    pairs = gathered(pairs, n)
    asked = settle(pairs.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("n")), 2 * n)
    hot = asked.where(F.col("n") > max(1, n // HOT)).select("id", F.ceil(F.col("n") * HOT / n).cast("int").alias("parts"))  # 2 * HOT ids at most
    many = [F.broadcast(hot.withColumnsRenamed({"id": side, "parts": f"parts_{side}"})) for side in ("a", "b")]
    both = pairs.join(many[0], "a", "left").join(many[1], "b", "left").na.fill(1, ["parts_a", "parts_b"])
    first = F.col("parts_a") >= F.col("parts_b")
    turned = both.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("hub"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("other"), F.greatest("parts_a", "parts_b").alias("parts"))
    placed = turned.select("hub", F.pmod(F.xxhash64("other"), F.col("parts")).cast("int").alias("part"), "other")
    # both joins read one shuffle of the texts that are asked for, each once
    texts = _of(own, asked.select("id")).groupBy("id").agg(F.min("text").alias("text"))
    members = placed.join(texts.withColumnRenamed("id", "other"), "other").select("hub", "part", "other", "text")
    hubs = placed.select("hub", "part").distinct().join(texts.withColumnRenamed("id", "hub"), "hub").select("hub", "part", F.lit(None).cast("long").alias("other"), "text")
    dealt = hubs.unionByName(members).repartition("hub", "part").sortWithinPartitions("hub", "part", F.asc_nulls_first("other"))
    return settle(gathered(dealt, n, COMPARED).mapInArrow(compared, "a long, b long"))


def _open(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one root, when the (id, root) rows are taken over.

    Members with the same root are joined by links; those of different ones may be.
    """
    n = buckets.count()
    taken = buckets.withColumnRenamed("root", "before").join(roots, "id", "left").withColumn("root", F.coalesce("root", "before"))
    named = settle(taken.select("key", "id", "size", "at", "bits", "root"), n)
    ends = named.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count("*").alias("_n"))
    return settle(join_by_key(named, ends.where("least < most").select("key", "_n"), "key", "_n", n), n)


def _pairs(a: str, b: str, similarity: float):
    """Whether two members are of different groups, and parities, sizes and places of the key allow the similarity if it is their first one."""
    apart = sum((F.bit_count(F.col(f"{a}.bits.{w}").bitwiseXOR(F.col(f"{b}.bits.{w}"))) for w in WORDS), F.lit(0))
    unshared = (1 - similarity) / (1 + similarity) * (F.col(f"{a}.size") + F.col(f"{b}.size")) + _SLACK
    left = F.least(F.col(f"{a}.size") - F.col(f"{a}.at"), F.col(f"{b}.size") - F.col(f"{b}.at"))
    fits = left >= similarity / (1 + similarity) * (F.col(f"{a}.size") + F.col(f"{b}.size")) - _SLACK
    return (F.col(f"{a}.root") != F.col(f"{b}.root")) & fits & (apart <= unshared)


def rooted(own: DataFrame, n_texts: int, shingle: int, similarity: float, near: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(node, root) of every id that has a copy, from (id, text) rows with so many different texts.

    ``near`` takes (id, fingerprint), the fingerprint being the majority of the bits of all shingles, and
    gives (a, b) pairs of ids to be compared first.
    """
    frequent, rank = _frequent(own, shingle, n_texts)
    some = settle(_alive(_counted(own, shingle, similarity, frequent, rank, PART), similarity).select("id"))
    found = _counted(_of(own, some), shingle, similarity, frequent, rank, 1)
    alive = settle(_alive(found, similarity))
    keys = settle(_keys(found, alive))
    several, n = keys.groupBy("key").agg(F.count("*").alias("_n")).where("_n > 1"), keys.count()
    buckets = settle(join_by_key(keys, several, "key", "_n", n).withColumn("root", F.col("id")), n)

    def verified(pairs: DataFrame) -> DataFrame:
        return _verified(pairs, own, shingle, similarity)

    first = None
    if near is not None:
        prints = buckets.select("id").distinct().join(alive.select("id", "fingerprint"), "id")
        first = verified(_ordered(near(prints).where("a <> b")))
    links = _links(buckets, verified, similarity, first=first)
    n = links.count()
    return settle(components(links, n=n), 2 * n)


def _rows(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, int]:
    """(doc_id, text, id) rows and the number of different texts."""
    return identified(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")), "text", "id")


def groups(docs: DataFrame, doc_id: str, text: str, shingle: int, similarity: float, near: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(doc_id, component_id): one row per row of docs; component_id is the least doc_id that copies of copies reach.

    Null and wordless texts are copies of each other.  A null doc_id is no component_id
    unless nothing else is there.
    """
    own, n_texts = _rows(docs, doc_id, text)
    rows, roots = own.select("doc_id", "id"), rooted(own.select("id", "text"), n_texts, shingle, similarity, near)
    own = rows.groupBy("id").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("_n"))
    named = settle(own.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id")))
    n_texts, n = named.agg(F.count("*"), F.coalesce(F.sum("_n"), F.lit(0))).first()
    found = least_by_key(named, "root", "least_id", "component_id", n_texts).select("id", "component_id", "_n")
    return join_by_key(rows, found, "id", "_n", n).select("doc_id", "component_id")


def one_of_each(docs: DataFrame, doc_id: str, text: str, shingle: int, similarity: float, near: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The row of least doc_id of each group of copies, null ids last; of different texts with this id in one group the one of least number.

    Ids and numbers are chosen first; then the texts are dealt once, to meet what was chosen.
    """
    keys = [_free(docs, "kept_id"), _free(docs, "kept_doc"), _free(docs, "kept_n")]
    named, n_texts = identified(docs, text, keys[0])
    own = named.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(keys[0]).alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    rows, roots = own.select("doc_id", "id"), rooted(own.select("id", "text"), n_texts, shingle, similarity, near)
    order = (F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("id"), F.col("_n"))
    counted = rows.groupBy("id", "doc_id").agg(F.count("*").alias("_n"))
    least = counted.groupBy("id").agg(F.min(F.struct(*order)).alias("least"))
    kept = least.join(roots.withColumnRenamed("node", "id"), "id", "left").groupBy(F.coalesce("root", "id")).agg(F.min("least").alias("least"))
    kept = kept.select(F.col("least.id").alias(keys[0]), _number(F.col("least.doc_id")).alias(keys[1]), F.col("least._n").alias(keys[2]))
    marked = named.withColumn(keys[1], _number(F.col(f"`{doc_id}`"))).join(settle(kept), keys[:2])
    once, more = marked.where(F.col(keys[2]) == 1), marked.where(F.col(keys[2]) > 1).dropDuplicates(keys[:2])
    return once.unionByName(more).select(*[F.col(f"`{c}`") for c in docs.columns])


def _number(doc_id: Column) -> Column:
    return F.xxhash64(doc_id.isNull(), doc_id)


def _free(docs: DataFrame, name: str) -> str:
    """A column name that docs doesn't have."""
    while name in docs.columns:
        name += "_"
    return name


def _links(buckets: DataFrame, verified: Callable[[DataFrame], DataFrame], similarity: float, allowed: int = PAIRS, first: DataFrame | None = None) -> DataFrame:
    """(a, b) links that join all sets of a bucket that are alike, directly or through others; first are links already known."""
    links = first
    if first is not None:
        buckets = _open(buckets, components(first, n=first.count()).withColumnRenamed("node", "id"))
    for star in range(STARS):
        if not _many(buckets, allowed, similarity):
            break
        n = buckets.count()
        member = F.struct(F.xxhash64("id", F.lit(star)).alias("_order"), "id", "size", "at", "root", "bits")
        drawn = least_by_key(buckets, "key", member, "hub", n).select(F.struct("id", "size", "at", "root", "bits").alias("own"), "hub")
        one = drawn.where(_pairs("own", "hub", similarity)).groupBy("own.id").agg(F.min(F.struct("hub._order", "hub.id", "hub.root")).alias("hub"))
        one = settle(one.select("id", F.least("id", "hub.id").alias("a"), F.greatest("id", "hub.id").alias("b"), "hub.root"), n)
        found = verified(_ordered(one))
        links = found if links is None else links.unionByName(found)
        # whoever is linked to its hub takes over the hub's root
        buckets = _open(buckets, one.join(_ordered(found), ["a", "b"]).select("id", "root"))
    found = verified(_ordered(_dealt(buckets, similarity).mapInArrow(_fitting(similarity, False), "a long, b long")))
    return found if links is None else links.unionByName(found)


def _many(buckets: DataFrame, allowed: int, similarity: float) -> bool:
    """Whether buckets hold more fitting pairs of different groups than so many for each row."""
    counted = _dealt(buckets, similarity).mapInArrow(_fitting(similarity, True), "a long, b long")
    n, pairs = counted.agg(F.coalesce(F.sum("a"), F.lit(0)), F.coalesce(F.sum("b"), F.lit(0))).first()
    return pairs > allowed * n


def _dealt(buckets: DataFrame, similarity: float) -> DataFrame:
    """Members by key and band of their size, sorted by size; a member is in its own band and, for smaller ones to find it, in the one below.

    Sets that are alike differ in size by the factor of the similarity at most, which is the width of a band.
    """
    band = F.floor(F.log(F.col("size")) / -math.log(similarity)).cast("int")
    both = buckets.withColumn("own", band).select("key", F.explode(F.array(F.col("own"), F.col("own") - 1)).alias("band"), "size", "id", "at", "root", "own", "bits")
    return both.repartition("key", "band").sortWithinPartitions("key", "band", "size", "id")


def _fitting(similarity: float, counted: bool):
    """Reads what _dealt() gives; returns (a, b) pairs that _pairs() allows, or (members, pairs) counts, the pairs told from ASKED members of each bucket."""
    least, unshared = similarity / (1 + similarity), (1 - similarity) / (1 + similarity)

    def windows(size: np.ndarray, left: np.ndarray, own: np.ndarray) -> np.ndarray:
        """How many of the members behind each one, in order of size, it may be alike."""
        most = np.minimum(size / similarity, left / least - size) + _SLACK
        return np.where(own, np.maximum(np.searchsorted(size, most, "right") - np.arange(len(size)) - 1, 0), 0)

    def partners(size, left, root, own, bits, step: int) -> Iterator[tuple[int, np.ndarray]]:
        """Every step-th member that has any, and its partners behind it."""
        many = windows(size, left, own)
        kinds, number, sizes = np.unique(root, return_inverse=True, return_counts=True)
        other = number != np.argmax(sizes)  # members of the largest group are compared with these only
        places = np.nonzero(other)[0]
        before = np.concatenate([[0], np.cumsum(other)])  # how many of these are before a place
        at = np.arange(len(size))
        for i in np.nonzero(many)[0][::step].tolist():
            j = at[i + 1 : i + 1 + many[i]] if other[i] else places[before[i + 1] : before[i + 1 + many[i]]]
            both = size[i] + size[j]
            j = j[(root[j] != root[i]) & (left[j] >= least * both - _SLACK)]
            j = j[np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1, dtype=np.int64) <= unshared * (size[i] + size[j]) + _SLACK]
            if len(j):
                yield i, j

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def ended(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            _, band, size, ids, place, root, own, bits = columns
            if len(size) < 2 or (root == root[0]).all():
                return
            step = max(1, len(size) // ASKED) if counted else 1
            found = partners(size, size - place, root, own == band, bits, step)
            if counted:
                yield pa.record_batch([pa.array([len(size)]), pa.array([step * sum(len(j) for _, j in found)])], ["a", "b"])
            else:
                for i, j in found:
                    yield pa.record_batch([pa.array(np.full(len(j), ids[i])), pa.array(ids[j])], ["a", "b"])

        for batch in batches:
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(7)]
            now.append(np.stack([w.to_numpy(zero_copy_only=False) for w in batch.column(7).flatten()], axis=1).view(np.uint64))
            now = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            change = np.nonzero((now[0][1:] != now[0][:-1]) | (now[1][1:] != now[1][:-1]))[0] + 1
            starts = [0, *change.tolist()]
            for i, j in zip(starts, starts[1:]):
                yield from ended([x[i:j] for x in now])
            held = [x[starts[-1] :] for x in now]
        if held is not None:
            yield from ended(held)

    return read


def _ordered(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    return pairs.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()

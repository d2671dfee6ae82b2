"""Spelling variants of words, grouped by anagram hashing.

A word's key is the sum of a power of each of its letters, so anagrams have equal keys, and words one letter apart
have keys that differ by the value of an added or removed letter, or by the difference of the values of two exchanged
ones.  Both sides of such a difference are turned into equal keys: a word meets the longer ones under its own key, which is
theirs less the letter they have more; words that exchange a letter meet under their keys less that letter.

The order of the letters is verified in the same join, by a hash of the letters in their places, and then letter by letter.
So a key that very many words have spreads over many tasks, and what is emitted grows with the words and their lengths: words that exchange a letter at one
place are no more than there are letters.  Entries hold hashes, not words, so a very long word has entries in proportion to its length.

The form of a word is its most frequent near word, if that is clearly more frequent; forms of forms lead to a root.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import identity, settle

LEAST_CHARS, LEAST_COUNT, TIMES = 6, 5, 5
POWER = 5
#: One in so many runs of a document loses a letter.
EVERY = 199
#: Words that a task counts before it passes them on, code points of a text that are read at a time, letters whose entries are made at a time.
HELD, CHUNK, LETTERS = 500_000, 1 << 20, 1 << 16
_LETTER = "a-zÀ-ÿ"
_OTHER = re.compile(f"[^{_LETTER}]")
#: An odd number and its inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def runs(text: str, least: int) -> Iterator[list[str]]:
    """Runs of at least so many letters of a text, A-Z in lower case; a list for each CHUNK of the text."""
    pattern = re.compile(f"[{_LETTER}]{{{max(least, 1)},}}")
    text = text.encode().lower().decode()  # bytes: A-Z only
    at = 0
    while at < len(text):
        end = at + CHUNK
        if end < len(text):
            stop = _OTHER.search(text, end)
            end = stop.start() if stop else len(text)
        yield pattern.findall(text, at, end)
        at = end


def occurrences(doc_id: int | None, text: str | None, least: int) -> Iterator[tuple[str, int]]:
    """(word, n) of a document; a run loses a letter if EVERY divides the checksum of doc_id (empty if null), colon and run."""
    prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for found in runs(text or "", least):
        for run, n in Counter(found).items():
            h = zlib.crc32(run.encode(), prefix)
            if h % EVERY == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= least:
                yield run, n


def counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of that many letters and occurrences in all."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def passed() -> pa.RecordBatch:
            out = pa.record_batch([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for own_id, own in zip(batch.column(0).to_pylist(), batch.column(1)):
                for word, n in occurrences(own_id, own.as_py(), least_chars):
                    held[word] += n
                    if len(held) >= HELD:
                        yield passed()
        yield passed()

    found = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(counted, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def keys_of(words: list[str]) -> tuple[np.ndarray, ...]:
    """(word number, key, rest, place, first) of each word whole, place -1, and without each of its letters.

    key is the anagram hash and rest the hash of the letters in their places, both modulo 2^64; first is
    whether the removed letter is the first of a stretch of equal ones, any of which leaves the same rest.
    """
    sizes = np.array([len(w) for w in words], np.int64)
    codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
    starts = np.cumsum(sizes) - sizes
    own = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(codes)) - starts[own]
    values = codes**POWER
    base = np.full(int(sizes.max(initial=0)) + 1, _BASE, np.uint64)
    base[0] = 1
    base = np.cumprod(base, dtype=np.uint64)
    terms = values * base[place]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    totals = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    ends = starts + sizes
    key, whole = totals[ends] - totals[starts], sums[ends] - sums[starts]
    at = np.arange(len(codes))
    rest = sums[at] - sums[starts[own]] + (sums[ends[own]] - sums[at + 1]) * np.uint64(_INVERSE)
    first = np.ones(len(codes), bool)
    first[1:] = (codes[1:] != codes[:-1]) | (place[1:] == 0)
    numbers = np.arange(len(words))
    return (
        np.concatenate([numbers, own]), np.concatenate([key, key[own] - values]), np.concatenate([whole, rest]),
        np.concatenate([np.full(len(words), -1), place]), np.concatenate([np.zeros(len(words), bool), first]),
    )


_ENTRIES = "id struct<x:long,y:long>, key long, rest long, place int, first boolean"


def entries(words: DataFrame) -> DataFrame:
    """(id, key, rest, place, first) of words with id: see keys_of()."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                end, letters = at, 0
                while end < len(texts) and (end == at or letters + len(texts[end]) <= LETTERS):
                    letters += len(texts[end])
                    end += 1
                number, key, rest, place, first = keys_of(texts[at:end])
                columns = [key.view(np.int64), rest.view(np.int64), place.astype(np.int32), first]
                yield pa.record_batch([batch.column(0).take(pa.array(number + at)), *map(pa.array, columns)], ["id", "key", "rest", "place", "first"])
                at = end

    return words.select("id", "word").mapInArrow(made, _ENTRIES)


def near(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n) of all words one letter apart, both ways; words has word and n, each word once."""
    words = settle(words.select(identity(F.col("word")).alias("id"), "word", "n"))
    found = settle(entries(words))

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("key", "rest", F.col("id").alias(name), F.col("place").alias(f"place_{name}"))

    whole, less = found.where("place < 0"), found.where("place >= 0")
    exchanged = side(less, "a").withColumn("place", F.col("place_a")).join(side(less, "b").withColumn("place", F.col("place_b")), ["key", "rest", "place"])
    added = side(whole, "a").join(side(less.where("first"), "b"), ["key", "rest"])
    columns = ["a", "place_a", "b", "place_b"]
    pairs = exchanged.where("a < b").select(*columns).unionByName(added.select(*columns))
    for name in ("a", "b"):
        pairs = pairs.join(words.select(F.col("id").alias(name), F.col("word").alias(f"word_{name}"), F.col("n").alias(f"n_{name}")), name)

    def rest(name: str) -> Column:
        word, place = F.col(f"word_{name}"), F.col(f"place_{name}")
        return F.when(place < 0, word).otherwise(F.concat(F.substring(word, F.lit(1), place), F.substring(word, place + 2, F.char_length(word))))

    verified = pairs.where((rest("a") == rest("b")) & (F.col("word_a") != F.col("word_b")))
    ways = [
        F.struct(F.col(f"word_{x}").alias("word"), F.col(f"n_{x}").alias("n"), F.col(f"word_{y}").alias("other"), F.col(f"n_{y}").alias("other_n"))
        for x, y in ("ab", "ba")
    ]
    return verified.select(F.explode(F.array(*ways)).alias("e")).select("e.*")


def rooted(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): root is where forms of forms end.  Each round doubles the steps; a form is more frequent than its word, so there are few."""
    roots = settle(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        found = settle(roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        roots = found.select("word", "root")
        if not found.where("moved").limit(1).count():
            return roots


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of all texts.

    Words are maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF) with A-Z in lower case, of at least ``least_chars`` code points and with
    ``least_count`` occurrences in all; n is how many.  One in ``EVERY`` runs of a document, by a checksum of doc_id and run, loses a letter first.
    n_near counts the words that differ by one letter more, less or exchanged; form is the most frequent of them, of equals the
    first in code-point order, if it occurs at least ``times`` as often as the word (its number is form_n), otherwise null; root is what
    forms of forms lead to, or the word itself.  Null texts have no words, a null doc_id is an empty one to the checksum, repeated
    rows count each, and an empty table gives an empty result.  Other columns are not read.
    """
    words = settle(counts(docs, doc_id, text, least_chars, least_count))
    best = near(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    own = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.other").alias("other"), (-F.col("best.less")).alias("other_n"))
    enough = F.col("other_n") >= times * F.col("n")
    formed = settle(own.select("word", F.when(enough, F.col("other")).alias("form"), "n", "n_near", F.when(enough, F.col("other_n")).alias("form_n")))
    roots = rooted(formed.where("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

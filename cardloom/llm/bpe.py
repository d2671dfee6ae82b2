"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Each pre-token is merged on its own.  Its live parts form a linked list; every
adjacent pair that is itself a token waits in the bucket of its merge rank, and
a two-level bitmap with one bit per bucket, in words of 256, finds the lowest rank in use by
two find-first-set steps.  A merge only re-files its two neighbours; entries
whose pair has meanwhile changed are stale and skipped when met.  So a pre-token
of n bytes takes about n log n steps however long it is.

Functions here are column expressions: each row is coded by itself, so repeated rows and other columns,
whatever their names, stay as they are, and an empty table gives none.  Null and empty texts have no ids.
"""

from __future__ import annotations

import base64
import re
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

#: Pre-tokens remembered by a Python worker, and the longest that is.
REMEMBERED, REMEMBERED_CHARS = 600_000, 40


def merged(piece: bytes, ranks: dict[bytes, int], pairs: list[int | None], bits: list[int]) -> list[int]:
    """Token ids of one pre-token.

    ``pairs`` has the rank of each two bytes.  ``bits`` holds words of a bit for each rank, and a local word
    a bit for each of them; all are zero before and after.
    """
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n, find, top = len(piece), ranks.get, 0
    after, before = list(range(1, n + 2)), list(range(-1, n))
    # rank of the pair that starts at each position; the last one starts none
    waiting: list[int | None] = [pairs[a << 8 | b] for a, b in zip(piece, piece[1:])]
    waiting += [None, None]
    buckets: dict[int, list[int]] = {}
    changed: tuple[int, ...] | range = range(n - 1)
    while True:
        for i in changed:  # file the pairs that have come up
            rank = waiting[i]
            if rank is None:
                continue
            if rank in buckets:
                heappush(buckets[rank], i)
                continue
            buckets[rank] = [i]
            word = rank >> 8
            if not bits[word]:
                top |= 1 << word
            bits[word] |= 1 << (rank & 255)
        while top:  # the leftmost position of the lowest rank
            word = (top & -top).bit_length() - 1
            own = bits[word]
            rank = word << 8 | (own & -own).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = buckets.pop(rank)[0]
                bits[word] = own = own & (own - 1)
                if not own:
                    top &= top - 1
            if waiting[i] == rank:
                break  # otherwise stale: the pair was merged or has changed
        else:
            break
        middle = after[i]
        end = after[middle]
        waiting[middle] = None
        after[i], before[end] = end, i
        waiting[i] = find(piece[i : after[end]]) if end < n else None
        left = before[i]
        if left >= 0:
            waiting[left] = find(piece[left:end])
            changed = (left, i)
        else:
            changed = (i,)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


def _latin(pattern: str):
    """A search that finds the same in texts up to U+00FF, with the classes of letters, numbers and white space written out.

    Null where the pattern uses more than these; then every text takes the general one.
    """
    chars = [chr(c) for c in range(256)]
    spelled = {
        name: "".join(map(re.escape, filter(regex.compile(name).match, chars))) for name in (r"\p{L}", r"\p{N}", r"\s")
    }

    def part(m: re.Match) -> str:
        text = m[0]
        if text[0] == "[":  # a class
            return re.sub(r"\\p\{[LN]\}|\\s", lambda x: spelled[x[0]], text)
        return f"[{spelled[text]}]" if text in spelled else f"[^{spelled[chr(92) + 's']}]" if text == r"\S" else text

    plain = re.sub(r"\[(?:\\.|[^\]])*\]|\\p\{\w+\}|\\.|.", part, pattern, flags=re.S)
    if re.search(r"\\[pPXRGKmMhHdDwWbB]|\(\?[^:=!]|\[\[|&&|--|\|\|", plain):
        return None
    return re.compile(plain).findall


class Codec(dict):
    """Packed ids by pre-token; a missing one is computed and, if short, remembered."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pieces = ranks, regex.compile(pattern).findall
        self.latin = _latin(pattern) or self.pieces
        self.pairs = [ranks.get(bytes((a, b))) for a in range(256) for b in range(256)]
        self.bits = [0] * ((max(ranks.values(), default=0) >> 8) + 1)
        self.token = {rank: token for token, rank in ranks.items()}

    def __missing__(self, piece: str) -> bytes:
        packed = np.array(merged(piece.encode(), self.ranks, self.pairs, self.bits), np.int32).tobytes()
        if len(piece) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = packed
        return packed

    def encode(self, text: str | None) -> bytes:
        text = text or ""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            pieces = self.pieces(text)
        else:
            pieces = self.latin(text)
        return b"".join(map(self.__getitem__, pieces))

    def decode(self, ids: list[int] | None) -> bytes:
        return b"".join(map(self.token.__getitem__, ids or ()))


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a file with lines "base64 rank"."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file; a Python worker keeps it between tasks."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(read_ranks(path), pattern)
    return _codecs[path, pattern]


def encode(text: Column | str, ranks_path: str, pattern: str) -> Column:
    """array<int> of token ids of a text column; null and empty texts give no ids.

    ``ranks_path`` is a rank file present on every executor, ``pattern`` splits a
    text into pre-tokens.  Special tokens do not exist: their strings are text.
    """

    @arrow_udf("array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        own = codec(ranks_path, pattern)
        packed = [own.encode(x.as_py()) for x in texts]
        offsets = np.zeros(len(packed) + 1, np.int64)
        np.cumsum([len(x) // 4 for x in packed], out=offsets[1:])
        ids = pa.array(np.frombuffer(b"".join(packed), np.int32))
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), ids)

    return encoded.asNondeterministic()(text)  # so that it runs once, however often it is read


def decode(ids: Column | str, ranks_path: str, pattern: str) -> Column:
    """Bytes of an array<int> column of ids (null: none); an id without a token is an error."""

    @arrow_udf("binary")
    def decoded(lists: pa.Array) -> pa.Array:
        own = codec(ranks_path, pattern)
        return pa.array([own.decode(x.values.to_numpy().tolist() if x.is_valid else None) for x in lists], pa.binary())

    return decoded.asNondeterministic()(ids)


def ids_text(ids: Column | str) -> Column:
    """Decimal ids joined by one space."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    return F.array_join(ids.cast("array<string>"), " ")

"""Order-preserving packing of documents into token sequences.

The documents of a partition follow each other as one stream of tokens that is
cut into windows of at most ``length`` tokens.  Where to cut is a shortest path:
with p the position of a candidate cut, pad(n) the padding of a window of n
tokens and penalty the price of truncating there,

    cost(j) = min over i, p[j] - p[i] <= length, of
              cost(i) + pad(p[j] - p[i]) + penalty(j).

pad(n) is length - n, so the minimum of cost(i) + p[i] over the sliding window
comes from a monotone queue in constant time; large powers of two need no padding
and are tried besides.  Candidates are the ends of
documents (free), of sentences, of words where no sentence ends for a while, and
single tokens where no word does.  The stream is cut in stretches of bounded
size, each ending in a cut that the dynamic program chose.
"""

from __future__ import annotations

import contextlib
import re
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .runtime import held

LENGTH, END = 4096, 2
#: What a cut costs, in tokens of padding: after a sentence, after a word, inside a word.
SENTENCE, WORD, INSIDE = 4.0, 32.0, 64.0
#: Without a better candidate, a word's end becomes one after so many tokens, any token after twice as many.
GAP = 128
#: Sequences that one run of the dynamic program looks at; words that a Python worker remembers, and the longest of them.
STRETCH, REMEMBERED, REMEMBERED_CHARS = 64, 500_000, 40
#: What ends a sentence when it is a token of its own at the end of a word.
SENTENCE_ENDS = (".", "!", "?", "...", '."', '!"', '?"', ".'", ".)", "!!", "…", "。", "！", "？")
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
#: Windows of these many tokens are tried besides full ones: powers of two from here on.
LEAST_POWER = 256
_TRAILING = "!#$%&*+,-./:;=?@|~"
#: Characters that stand for bytes in byte-level vocabularies; printable ones for themselves, the others from U+0100 on.
_PLAIN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTES = {b: chr(b if b in _PLAIN else 0x100 + sum(c not in _PLAIN for c in range(b))) for b in range(0x100)}
#: Words on which the short way is compared with the tokenizer before it is used.
_PROBES = ["the", "internationalisation", "straße", "naïvetés", "ñandú", "zzxqj", *filter(str.islower, map(chr, range(0x61, 0x100)))]


class Words:
    """Packed ids by word; the tokenizer never looks across white space, so words stand alone."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        #: Strings of the vocabulary that are one id wherever a text holds them, in this very case.
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.stops = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for mark in SENTENCE_ENDS:
            if len(ids := self.tokenizer.encode(mark, add_special_tokens=False).ids) == 1:
                self.stops[ids] = True
        self.known: dict[str, bytes] = {}
        self.model = self.tokenizer.model
        self.direct = all(self._letters(w) == self._ids(w).tobytes() for w in _PROBES)

    def _letters(self, word: str) -> bytes:
        """Ids of a lower-case word of letters, straight from the model: nothing before it would change or split the word."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_BYTES)
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _learn(self, new: set[str], latin: bool) -> None:
        """Encode words not yet known.

        Letters split from the marks that follow them, so a word may be made of known
        parts, and words of nothing but letters skip what comes before the model.
        """
        known = self.known
        stems = {w: w.rstrip(_TRAILING) for w in new}
        if self.direct:
            for x in set(stems.values()).difference(known):
                if x.isalpha() and (latin or x.isascii()):
                    known[x] = self._letters(x if latin else x.lower())
        for word, stem in stems.items():
            if word not in known:
                if word != stem and stem in known and stem.isalpha() and stem.lower().isalpha():  # lower case may add a mark
                    marks = word[len(stem) :]
                    if marks not in known:
                        known[marks] = self._ids(marks).tobytes()
                    known[word] = known[stem] + known[marks]
                else:
                    known[word] = self._ids(word).tobytes()

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a text, and the positions where words and where sentences end."""
        text, latin = text or "", False
        with contextlib.suppress(UnicodeEncodeError):  # case is lost anyway; here folding it is safe
            text.encode("latin-1")
            lower = text.lower()
            if not any(x in lower for x in self.special):
                text, latin = lower, True
        words = [w for w in _SPACE.split(text) if w] if _ODD_SPACE.search(text) else text.split()
        if len(self.known) > REMEMBERED:
            self.known.clear()
        if new := set(words).difference(self.known):
            self._learn(new, latin)
        packed = list(map(self.known.__getitem__, words))
        for word in new:
            if len(word) > REMEMBERED_CHARS:  # long words hardly come again
                del self.known[word]
        ends = np.cumsum(np.fromiter(map(len, packed), np.int64, len(packed)) >> 2)
        ids = np.frombuffer(b"".join(packed), "<u4")
        return ids, ends, ends[self.stops[ids[ends - 1]]]


def words(path: str) -> Words:
    own = held("packing")
    if path not in own:
        own[path] = Words(path)
    return own[path]


def candidates(n: int, word_ends: np.ndarray, sentence_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (1 to n, n included) where a document of n tokens may be cut, and the penalties."""
    at = np.append(sentence_ends, n)
    price = np.full(len(at), SENTENCE)
    price[-1] = 0.0
    if len(at) > 1 and at[-2] == n:
        at, price = np.delete(at, -2), np.delete(price, -2)
    at, price = _filled(at, price, GAP, WORD, word_ends)
    return _filled(at, price, 2 * GAP, INSIDE, None)


def _filled(at: np.ndarray, price: np.ndarray, gap: int, cost: float, ends: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The candidates and, wherever they leave more than gap tokens, more of them: each gap tokens the next of ends."""
    spaces = at.copy()
    spaces[1:] -= at[:-1]
    wide = np.nonzero(spaces > gap)[0]
    if not len(wide):
        return at, price
    more = np.concatenate([np.arange(at[i] - spaces[i] + gap, at[i], gap) for i in wide])
    if ends is not None:
        place = np.searchsorted(ends, more)
        more = ends[place[place < len(ends)]]
    more = np.setdiff1d(more, at)
    place = np.searchsorted(at, more)
    return np.insert(at, place, more), np.insert(price, place, cost)


def _exact(at: list[int], length: int) -> list:
    """Per position but the first: (power, index of the position so many tokens before it)."""
    found: list = [()] * (len(at) - 1)
    places = np.array(at)
    for power in (1 << k for k in range(length.bit_length()) if LEAST_POWER <= 1 << k < length):
        begin = np.searchsorted(places, places - power)
        for j in np.nonzero(places[begin] == places - power)[0].tolist():
            found[j - 1] = (*found[j - 1], (power, int(begin[j])))
    return found


def cuts(positions: list[int], prices: list[float], length: int) -> list[int]:
    """Cut positions of least cost between 0 and the last position, which is one of them.

    No two neighbouring positions are more than length apart.
    """
    at = [0, *positions]
    came, cost = [0], [0.0]  # the cost of a cut plus its position
    queue = deque([(0.0, 0)])  # (cost plus position, index), both rising
    for j, (p, price, exact) in enumerate(zip(positions, prices, _exact(at, length)), 1):
        while p - at[queue[0][1]] > length:
            queue.popleft()
        key, i = queue[0]
        key += length
        for power, k in exact:  # the whole cost of a window without padding grows by its length only
            if cost[k] + power < key:
                key, i = cost[k] + power, k
        came.append(i)
        key += price
        cost.append(key)
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    found, j = [], len(positions)
    while j:
        found.append(at[j])
        j = came[j]
    return found[::-1]


PIECES = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
)


class _Stream:
    """The tokens of a partition that are not yet in a sequence."""

    def __init__(self, length: int, first: int):
        self.length, self.sequence = length, first
        self.docs: deque = deque()  # [doc_id, ids, tokens already placed]
        self.at: list[int] = []
        self.price: list[float] = []
        self.size = 0

    def add(self, doc_id: int | None, ids: np.ndarray, at: np.ndarray, price: np.ndarray) -> None:
        self.docs.append([doc_id, ids, 0])
        self.at.extend((at + self.size).tolist())
        self.price.extend(price.tolist())
        self.size += len(ids)

    def _tail(self, begin: int, end: int) -> list[int]:
        """Cuts of the last window: into powers of two if that is cheaper than its padding."""
        left = end - begin
        if INSIDE * (left.bit_count() - 1) >= self.length - left:
            return [end]
        found = []
        while left:
            left -= 1 << (left.bit_length() - 1)
            found.append(end - left)
        return found

    def flush(self, whole: bool) -> list[tuple]:
        """Pieces of all sequences, or of those that end before the last quarter of the stream."""
        found = cuts(self.at, self.price, self.length)
        if not whole:
            found = [c for c in found if c <= self.size - self.size // 4] or found[:1]
        else:
            found[-1:] = self._tail(found[-2] if len(found) > 1 else 0, found[-1])
        pieces, begin = [], 0
        for end in found:
            offset = 0
            while begin + offset < end:
                doc = self.docs[0]
                take = min(len(doc[1]) - doc[2], end - begin - offset)
                part = doc[1][doc[2] : doc[2] + take]
                pieces.append((doc[0], doc[2], take, part.tobytes(), len(doc[1]), self.sequence, offset))
                offset, doc[2] = offset + take, doc[2] + take
                if doc[2] == len(doc[1]):
                    self.docs.popleft()
            begin, self.sequence = end, self.sequence + 1
        kept = np.searchsorted(self.at, begin, "right")
        self.at = [x - begin for x in self.at[kept:]]
        self.price = self.price[kept:]
        self.size -= begin
        return pieces


def pack(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, end: int = END) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` are little-endian unsigned 32-bit token ids.  A document is its text's
    ids by the tokenizer file (null and empty texts: none; special strings in a text are ids
    of their own, as the library has it) and then ``end``; each id
    is in one piece, and the pieces of a sequence have gapless offsets from 0.  The
    rows of an input partition are packed in their order without a shuffle, repeated
    rows as documents of their own and null ids as such; sequence_id numbers the
    sequences of all partitions.  Other columns are not read; an empty table gives
    no rows.
    """
    if length < 2 * GAP:
        raise ValueError(f"sequences of fewer than {2 * GAP} tokens leave no candidates to choose from")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = words(tokenizer_path)
        stream = _Stream(length, TaskContext.get().partitionId() << 33)
        for batch in batches:
            for i, x in zip(batch.column(0), batch.column(1)):
                ids, word_ends, stops = own.encode(x.as_py())
                at, price = candidates(len(ids) + 1, word_ends, stops)
                stream.add(i.as_py(), np.append(ids, np.uint32(end)), at, price)
                if stream.size >= STRETCH * length:
                    yield _batch(stream.flush(False))
        if stream.size:
            yield _batch(stream.flush(True))

    def _batch(pieces: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*pieces), PIECES)], PIECES)

    schema = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(packed, schema)

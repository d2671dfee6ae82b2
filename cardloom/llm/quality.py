"""Quality scores by non-negative positive-unlabelled learning over the make-up of a text.

Scores are column expressions: each row is scored by its text alone, so repeated rows and other columns,
whatever their names, stay as they are.  Null texts count as empty; where nothing can be learned all scores are the
share of label 1.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from itertools import chain

from pyspark.sql import Column, DataFrame

from . import pu

#: Folds by crc32(doc_id); the one that is never learned from; the score from which a text counts as good.
PARTS, HELD_OUT, LEAST_SCORE = 4, 2, 0.7
#: Characters of a word that are looked at as one piece, and marks of its shape that count as one; longer ones are several.
PIECE, MARKS = 60, 6
#: Shapes that a worker remembers, a few megabytes.
_REMEMBERED = 1 << 16
_LETTERS, _DIGITS, _TWICE = re.compile(r"[^\W\d_]+"), re.compile(r"\d+"), re.compile(r"(.)\1+")


class _Shapes(dict):
    """What a piece of a word is made of: a for letters, A for one capital, AA for several, 0 for digits, marks as they are."""

    def __missing__(self, word: str) -> tuple[str, ...]:
        core = "".join(c for c in word if c.isalpha())
        kind = "AA" if len(core) > 1 and core.isupper() else "A" if core[:1].isupper() else "a"
        marks = _TWICE.sub(r"\1", _DIGITS.sub("0", _LETTERS.sub("a", word)))
        shape = tuple(marks[i : i + MARKS].replace("a", kind, 1) for i in range(0, len(marks), MARKS))
        if len(self) >= _REMEMBERED:
            self.clear()
        self[word] = shape
        return shape


_shapes = _Shapes()


def _pieces(words: list[str]) -> Iterable[str]:
    """The words, long ones in consecutive pieces."""
    if max(map(len, words)) <= PIECE:
        return words
    return chain.from_iterable((w[i : i + PIECE] for i in range(0, len(w), PIECE)) for w in words)


def traits(text: str | None) -> set[str]:
    """Names of the bins that the shares of word shapes, repetitions and lines fall into."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return {"empty"}
    shapes: Counter = Counter()
    for parts, count in Counter(map(_shapes.__getitem__, _pieces(words))).items():
        for part in parts:
            shapes[part] += count
    total = shapes.total()
    found = {pu.bins(shape, count / total) for shape, count in shapes.items() if count * 200 >= total}
    distinct = len(set(words))
    found.add(pu.bins("again", sum(map(str.__eq__, words[1:], words[:-1])) / n))
    found.add(pu.bins("distinct", min(1.0, distinct / n ** 0.9)))
    found.add(pu.bins("top", Counter(words).most_common(1)[0][1] / n))
    found.add(f"words>{n.bit_length()}")
    lines = text.split("\n")
    found.add(pu.bins("lines again", 1 - len(set(lines)) / len(lines)))
    found.add(f"word length>{min(20, sum(map(len, words)) // n)}")
    return found


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text") -> pu.Model:
    """A model from trusted documents and unlabelled ones outside the held-out fold."""
    rows, prior = pu.sample(docs, labels, label, PARTS, HELD_OUT, doc_id, text)
    return pu.fit(rows, prior, traits, scaled=False)


def score(model: pu.Model, text: Column) -> Column:
    """Quality of each whole text, 0 to 1; null and empty texts get the score of an empty one."""
    return pu.score(model, text, traits)

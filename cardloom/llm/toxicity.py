"""Toxicity scores by non-negative positive-unlabelled learning over words and stems.

Scores are column expressions: each row is scored by its text alone, so repeated rows and other columns,
whatever their names, stay as they are.  Null texts count as empty; where nothing can be learned all scores are the
share of label 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from . import pu

#: Folds by crc32(doc_id); the one that is never learned from; the score from which a text counts as toxic.
PARTS, HELD_OUT, LEAST_SCORE = 3, 1, 0.7
#: Letters of a stem.
STEM = 4
_EDGES = ".,;:!?\"'()[]{}<>*#$%&|/\\-_=+~`«»„“”‚‘’…¡¿"


def words(text: str | None) -> set[str]:
    """Distinct lower-case words without punctuation at their ends, and the stems of the longer ones."""
    found = {w.strip(_EDGES) for w in set((text or "").lower().split())}
    found.discard("")
    return found | {f"{w[:STEM]}-" for w in found if len(w) > STEM}


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text") -> pu.Model:
    """A model from confirmed toxic documents and unlabelled ones outside the held-out fold."""
    rows, prior = pu.sample(docs, labels, label, PARTS, HELD_OUT, doc_id, text)
    return pu.fit(rows, prior, words, scaled=False)


def score(model: pu.Model, text: Column) -> Column:
    """Toxicity of each whole text, 0 to 1; null and empty texts get the score of no words."""
    return pu.score(model, text, words)

"""Cards through an outside service, in batches, resumable.

A provider is any picklable callable: it gets a list of {card_key, line_texts,
rule_extracted_hint} dicts and returns (answers, tokens used); answers are a list of dicts, or the service's own
text: JSON, fenced or not, of such a list or of an object that holds it as ``cards``.  Python
runs only here, as a stream of Arrow batches.  A task keeps a window of calls in flight, so a core waits for
several answers at a time; rows come in the order in which calls end, and no more are read than the window takes.
"""

from __future__ import annotations

import importlib
import json
import re
import time
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from queue import SimpleQueue

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..sources.session import importable
from .phones import standardised

Provider = Callable[[list[dict]], tuple[list[dict] | str, int]]
BATCH, RETRIES, WAIT = 6, 2, 2.0
#: Calls that a task has in flight.
IN_FLIGHT = 6
#: Answers that a task gathers before it passes them on, and for how many seconds at most while answers come.
SENT, HELD = 1_000, 1.0
_ANSWER = "card_key string, name string, title string, company string, address string, mobiles array<string>, is_key_person string, kp_role string"
_CALLED = pa.schema(
    [("card_key", pa.string()), ("name", pa.string()), ("title", pa.string()), ("company", pa.string()), ("address", pa.string()), ("mobiles", pa.list_(pa.string())),
     ("is_key_person", pa.string()), ("kp_role", pa.string()), ("tokens", pa.int64()), ("error", pa.string()), ("fatal", pa.bool_())]
)
_TEXTS = ("name", "title", "company", "address", "kp_role")


def _text(value) -> str | None:
    return None if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _row(key: str, answer: dict, tokens: int) -> dict:
    """An answer's fields as text; mobiles as a list, whatever came."""
    mobiles = answer.get("mobiles") or []
    mobiles = [str(x) for x in (mobiles if isinstance(mobiles, list) else [mobiles])]
    return {c: _text(answer.get(c)) for c in _TEXTS} | {"card_key": key, "mobiles": mobiles, "is_key_person": "true" if answer.get("is_key_person") else "false", "tokens": tokens, "error": None, "fatal": False}


def _parsed(answers: list[dict] | str) -> list[dict]:
    """The list of answers in a service's text; other text is an error, which is tried again."""
    if isinstance(answers, str):
        answers = json.loads(re.sub(r"\A\s*```(?:json)?\s*|\s*```\s*\Z", "", answers))
        answers = answers.get("cards", []) if isinstance(answers, dict) else answers
    if not isinstance(answers, list):
        raise ValueError("the answer holds no list of cards")
    return answers


def provider_at(place: str) -> Provider:
    """The provider that an import path names, as in "package.module:function"."""
    module, _, name = place.partition(":")
    return getattr(importlib.import_module(module), name)


def _is_fatal(error: Exception) -> bool:
    said = str(error).lower()
    return getattr(error, "code", None) in fixed.FATAL_STATUS or any(w in said for w in fixed.FATAL_WORDS)


def _called(provider: Provider, batch: list[dict], retries: int, wait: float) -> list[dict]:
    """A row for each card of the batch; cards without an answer get an empty one, a failed batch its error."""
    error: Exception | None = None
    for attempt in range(retries + 1):
        try:
            answers, tokens = provider(batch)
            by_key = {a.get("card_key"): a for a in _parsed(answers) if isinstance(a, dict)}
            return [_row(b["card_key"], by_key.get(b["card_key"], {}), tokens if i == 0 else 0) for i, b in enumerate(batch)]
        except Exception as e:  # noqa: BLE001  whatever a service does ends as a row, not as a lost run
            error = e
            if _is_fatal(e):
                break
            if attempt < retries:
                time.sleep(wait * (attempt + 1))
    return [_row(b["card_key"], {}, 0) | {"error": f"{type(error).__name__}: {error}", "fatal": _is_fatal(error)} for b in batch]


def _in_flight(work: Iterable[list[dict]], ask: Callable[[list[dict]], list[dict]], most: int) -> Iterator[list[dict]]:
    """What ask gives for each piece of work, in the order in which calls end; work is read only while fewer than most are in flight."""
    ended: SimpleQueue = SimpleQueue()
    with ThreadPoolExecutor(most) as pool:
        n = 0
        for piece in work:
            pool.submit(ask, piece).add_done_callback(ended.put)
            n += 1
            if n >= most:
                yield ended.get().result()
                n -= 1
        for _ in range(n):
            yield ended.get().result()


def _gathered(found: Iterable[list[dict]]) -> Iterator[pa.RecordBatch]:
    """Rows of several calls as one batch, since a batch costs much more than a row."""
    held, since = [], time.monotonic()
    for rows in found:
        held += rows
        if len(held) >= SENT or time.monotonic() - since > HELD:
            yield pa.RecordBatch.from_pylist(held, _CALLED)
            held, since = [], time.monotonic()
    if held:
        yield pa.RecordBatch.from_pylist(held, _CALLED)


def call(
    cards: DataFrame, provider: Provider, batch: int = BATCH, retries: int = RETRIES, wait: float = WAIT, at_once: int | None = None, in_flight: int = IN_FLIGHT
) -> DataFrame:
    """Answers for cards with card_key, line_texts and extracted: an answer struct, tokens, error, fatal.

    ``in_flight`` calls run at a time in each task (so the provider has to be safe for threads, or in_flight 1), and ``at_once`` deals the
    cards evenly to so many tasks; without it a task has a partition of the cards, which for a small file is all of them.  After a final error (access, quota) a task starts no more calls; its remaining
    cards get that error.  Tasks of one frame share nothing; runs in batches that share
    a stop are those of streaming.enriching.  Repeated cards are asked once each.
    """

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dead: list[str] = []

        def pieces() -> Iterator[list[dict]]:
            for rows in batches:
                asked = [{"card_key": r["card_key"], "line_texts": r["line_texts"] or [], "rule_extracted_hint": r["extracted"]} for r in rows.to_pylist()]
                yield from (asked[at : at + batch] for at in range(0, len(asked), batch))

        def ask(some: list[dict]) -> list[dict]:
            if dead:
                return [_row(b["card_key"], {}, 0) | {"error": dead[0], "fatal": True} for b in some]
            out = _called(provider, some, retries, wait)
            if out[-1]["fatal"]:
                dead.append(out[-1]["error"])
            return out

        yield from _gathered(_in_flight(pieces(), ask, in_flight))

    work = importable(cards).select("card_key", "line_texts", "extracted")
    work = work.repartition(at_once) if at_once else work
    called = work.mapInArrow(stream, f"{_ANSWER}, tokens bigint, error string, fatal boolean")
    names = [x.split()[0] for x in _ANSWER.split(", ")]
    return called.select("card_key", F.struct(*names).alias("answer"), "tokens", "error", "fatal")


def with_answers(cards: DataFrame, answers: DataFrame, model: str) -> DataFrame:
    """Cards joined with their answers, standardised; cards without an answer get empty fields.

    Of several answers to a key the one with the greatest ``ord`` counts (any, if there is
    no such column); answers to unknown keys are dropped.  Tokens, errors and the mark
    of final errors are carried along where answers have them.
    """
    order = F.col("ord") if "ord" in answers.columns else F.lit(0)
    carried = {"tokens": F.sum("tokens"), "error": F.max("error"), "fatal": F.bool_or("fatal")}
    more = [agg.alias(c) for c, agg in carried.items() if c in answers.columns]
    last = answers.groupBy("card_key").agg(F.max_by("answer", order).alias("answer"), *more)
    joined = cards.join(last, "card_key", "left")
    return joined.withColumns(standardised("answer")).withColumn("llm_model", F.lit(model)).drop("answer")


def standardise(cards: DataFrame, done: DataFrame, provider: Provider, model: str, **options) -> DataFrame:
    """Standardised rows with tokens, error and fatal for the cards that are not among those done.

    Append the result to ``done``'s table at once: reading it twice would call the
    service twice.  Rows with an error are not done and come again.  As many tasks call as the session has cores, unless ``at_once`` is given.
    """
    options = {"at_once": cards.sparkSession.sparkContext.defaultParallelism} | options
    good = done.where("error IS NULL") if "error" in done.columns else done
    left = cards.join(good.select("card_key").distinct(), "card_key", "left_anti").dropDuplicates(["card_key"])
    return with_answers(left, call(left, provider, **options), model)

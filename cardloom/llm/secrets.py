"""Secret scan with DataFrame functions: fixed rules plus a randomness test battery.

The rules find assignments, access keys and long hex runs.  The battery looks at
every long run of key characters that touches none of these.  It infers the run's encoding from its
characters, maps them to numbers and asks three questions, each answered by a
p-value under "uniform and independent symbols": are the symbols equally frequent
(chi-squared), do they cross the middle as often as they should (runs), is each
independent of the one before it (serial correlation)?  Fisher's sum combines
them.  A run that passes may still be an ordinary word, and the shorter it is the
likelier; ``p_text`` is the chance that text of the same length and encoding looks
as uniform.  Within each encoding and length class the Benjamini-Hochberg rule
over all such runs of the table sets how small it has to be, so that at most the share
``FALSE_SHARE`` of the reported ones is expected to be text.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import settle

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Longer quantifiers in place of a length check: a shorter match of these two never hides a longer one.
ACCESS, HEX = "AKIA[A-Z0-9]{16,}", "[0-9a-f]{24,}"
RUN = "[A-Za-z0-9+/_-]{20,}={0,2}"
MIN_VALUE = 6
FALSE_SHARE, LEAST_RANDOM = 0.01, 1e-4
#: Matches that are looked at together.
CHUNK = 256
#: Bins of p_text a decade, and how many there are.
BINS, LAST_BIN = 4, 80
_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Encoding, what all its characters match, its alphabet in order, the chance that two symbols of ordinary text agree.
ENCODINGS = (
    ("hex", "^([0-9a-f]+|[0-9A-F]+)$", _DIGITS + "abcdef", 0.1),
    ("base32", "^[A-Z2-7]+$", _UPPER + "234567", 0.065),
    ("base36", "^[0-9a-z]+$", _DIGITS + _LOWER, 0.065),
    ("base62", "^[0-9A-Za-z]+$", _DIGITS + _UPPER + _LOWER, 0.065),
    ("base64", "^[0-9A-Za-z+/]+$", _UPPER + _LOWER + _DIGITS + "+/", 0.065),
    ("base64url", "^[0-9A-Za-z_-]+$", _UPPER + _LOWER + _DIGITS + "-_", 0.065),
    ("mixed", "", _UPPER + _LOWER + _DIGITS + "+/-_", 0.065),
)
SPAN = "array<struct<start:int,end:int,kind:string>>"
_FOUND = "array<struct<start:int,end:int,value:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, inside a lambda too."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _chunks(items: Column) -> Column:
    """The array cut into arrays of CHUNK items, at least one; so that work that grows with the square of an array stays small."""
    last = F.greatest(F.ceil(F.size(items) / CHUNK).cast("int"), F.lit(1)) - 1
    return F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(items, c * CHUNK + 1, CHUNK))


def _scanned(items: Column, before: Callable[[Column], Column], each: Callable[[Column, Column], Column]) -> Column:
    """Concatenates each(chunk, what ``before`` makes of the chunks before it); ``before`` takes and gives an array of a value per chunk."""

    def body(chunks: Column) -> Column:
        return let(before(chunks), lambda known: F.flatten(F.transform(chunks, lambda c, i: each(c, F.get(known, i)))))

    return let(items, lambda own: let(_chunks(own), body))


def located(text: Column, pattern: str, group: int = 0) -> Column:
    """Start, end (code points, exclusive) and a group of each leftmost non-overlapping match.

    What lies between the matches comes from splitting at them, so positions are
    running sums of lengths, first of chunks and then within each.
    """
    # arrays_zip evaluates each of its arguments once; the gap after the last match meets a null
    parts = [F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match")]
    if group:
        parts.append(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))

    def width(x: Column) -> Column:
        return F.char_length(x["gap"]) + F.coalesce(F.char_length(x["match"]), F.lit(0))

    def begins(chunks: Column) -> Column:
        sizes = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda acc, x: acc + width(x)))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(sizes, start, lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")), lambda acc: acc["out"])

    def within(chunk: Column, begin: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + F.char_length(x["gap"])
            end = start + F.char_length(x["match"])
            one = F.struct(start.alias("start"), end.alias("end"), x["value" if group else "match"].alias("value"))
            return F.when(x["match"].isNull(), acc).otherwise(F.struct(end.alias("at"), F.array_append(acc["found"], one).alias("found")))

        return F.aggregate(chunk, F.struct(begin.alias("at"), F.array().cast(_FOUND).alias("found")), step, lambda acc: acc["found"])

    return F.when(text.rlike(pattern), _scanned(F.arrays_zip(*parts), begins, within)).otherwise(F.array().cast(_FOUND))


def _as_kind(found: Column, kind: str) -> Column:
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(kind).alias("kind")))


def base_spans(text: Column) -> list[Column]:
    """Spans of the three rules, a column each; text must not be null."""
    assign = F.filter(located(text, ASSIGN, 1), lambda x: F.char_length(x["value"]) >= MIN_VALUE)
    return [_as_kind(assign, "assign"), _as_kind(located(text, ACCESS), "access"), _as_kind(located(text, HEX), "hex")]


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution, by a polynomial good to seven digits."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * poly
    return F.greatest(F.when(z >= 0, upper).otherwise(1 - upper), F.lit(1e-300))


def _pick(encoding: Column, values: list) -> Column:
    chosen = F.lit(values[-1])
    for (name, *_), value in list(zip(ENCODINGS, values))[-2::-1]:
        chosen = F.when(encoding == name, F.lit(value)).otherwise(chosen)
    return chosen


def tested(runs: Column) -> Column:
    """The runs found by RUN with encoding, length and the p-values of the battery.

    Each transform evaluates once what the next one uses several times.
    """

    def named(x: Column) -> Column:
        core = F.rtrim(x["value"], F.lit("="))
        encoding = F.lit(ENCODINGS[-1][0])
        for name, pattern, *_ in ENCODINGS[-2::-1]:
            encoding = F.when(core.rlike(pattern), name).otherwise(encoding)
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), core.alias("core"), encoding.alias("encoding"))

    def numbered(x: Column) -> Column:
        alphabet = _pick(x["encoding"], [a for _, _, a, _ in ENCODINGS])
        core = F.when(x["encoding"] == "hex", F.lower(x["core"])).otherwise(x["core"])
        values = F.transform(F.split(core, ""), lambda c: F.instr(alphabet, c).cast("double"))
        return F.struct(
            *[x[k].alias(k) for k in ("start", "end", "encoding")],
            F.char_length(x["core"]).alias("length"),
            values.alias("values"),
            _pick(x["encoding"], [float(len(a)) for _, _, a, _ in ENCODINGS]).alias("k"),
            _pick(x["encoding"], [len(a) * same - 1 for _, _, a, same in ENCODINGS]).alias("excess"),
        )

    def summed(x: Column) -> Column:
        middle = (x["k"] + 1) / 2

        def step(acc: Column, v: Column) -> Column:
            above = v > middle
            return F.struct(
                v.alias("last"),
                (acc["s1"] + v).alias("s1"),
                (acc["s2"] + v * v).alias("s2"),
                (acc["s12"] + F.coalesce(acc["last"] * v, F.lit(0.0))).alias("s12"),
                (acc["above"] + above.cast("double")).alias("above"),
                (acc["runs"] + F.coalesce((above != (acc["last"] > middle)).cast("double"), F.lit(1.0))).alias("runs"),
            )

        zero = [F.lit(0.0).alias(k) for k in ("s1", "s2", "s12", "above", "runs")]
        sums = F.aggregate(x["values"], F.struct(F.lit(None).cast("double").alias("last"), *zero), step)
        squares = F.aggregate(
            F.array_distinct(x["values"]),
            F.lit(0.0),
            lambda acc, s: acc + F.pow(F.size(F.filter(x["values"], lambda v: v == s)).cast("double"), F.lit(2.0)),
        )
        ends = F.element_at(x["values"], 1) * F.element_at(x["values"], -1)
        return F.struct(*[x[k].alias(k) for k in ("start", "end", "encoding", "length", "k", "excess")], sums.alias("s"), squares.alias("squares"), ends.alias("ends"))

    def judged(x: Column) -> Column:
        n, k, s = x["length"].cast("double"), x["k"], x["s"]
        df, chi = k - 1, k * x["squares"] / n - n
        p_chi = _tail((F.pow(chi / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df)))
        split = 2 * s["above"] * (n - s["above"])
        spread = split * (split - n) / (n * n * (n - 1))
        p_runs = F.when(spread > 0, 2 * _tail(F.abs(s["runs"] - split / n - 1) / F.sqrt(spread))).otherwise(F.lit(1e-300))
        scatter = n * s["s2"] - s["s1"] * s["s1"]
        serial = F.when(scatter > 0, (n * (s["s12"] + x["ends"]) - s["s1"] * s["s1"]) / scatter).otherwise(F.lit(1.0))
        p_serial = 2 * _tail(F.abs(serial + 1 / (n - 1)) * F.sqrt(n))
        half = -(F.ln(p_chi) + F.ln(F.least(p_runs, F.lit(1.0))) + F.ln(F.least(p_serial, F.lit(1.0))))
        p_random = F.exp(-half) * (1 + half + half * half / 2)
        p_text = _tail((df + n * x["excess"] - chi) / F.sqrt(2 * df + 4 * n * x["excess"]))
        return F.struct(
            *[x[name].alias(name) for name in ("start", "end", "encoding", "length")],
            p_random.alias("p_random"),
            F.least(F.floor(-F.log10(p_text) * BINS), F.lit(LAST_BIN)).cast("int").alias("bin"),
            F.concat_ws(":", x["encoding"], F.floor(F.log2(n)).cast("string")).alias("cell"),
        )

    return F.transform(F.transform(F.transform(F.transform(runs, named), numbered), summed), judged)


def _apart(runs: Column, base: Column) -> Column:
    """The runs that touch no base span; both are brought in order and met chunk by chunk."""

    def event(x: Column, own: bool) -> Column:
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(own).alias("base"), (x["value"] if not own else F.lit(None).cast("string")).alias("value"))

    def ends(chunks: Column) -> Column:
        """Greatest end of the base spans of each chunk and least start, then of those before and after it."""
        own = F.transform(chunks, lambda c: F.filter(c, lambda x: x["base"]))
        last, first = F.transform(own, lambda c: F.array_max(F.transform(c, lambda x: x["end"]))), F.transform(own, lambda c: F.array_min(F.transform(c, lambda x: x["start"])))
        both = F.arrays_zip(last.alias("last"), first.alias("first"))
        return let(both, lambda z: F.transform(z, lambda _, i: F.struct(F.array_max(F.slice(z["last"], 1, i)).alias("before"), F.array_min(F.slice(z["first"], i + 2, F.size(z))).alias("after"))))

    def within(chunk: Column, known: Column) -> Column:
        return F.filter(
            chunk,
            lambda x: ~x["base"]
            & F.coalesce(x["start"] >= known["before"], F.lit(True))
            & F.coalesce(x["end"] <= known["after"], F.lit(True))
            & ~F.exists(chunk, lambda b: b["base"] & (b["start"] < x["end"]) & (x["start"] < b["end"])),
        )

    events = F.array_sort(F.concat(F.transform(base, lambda x: event(x, True)), F.transform(runs, lambda x: event(x, False))))
    kept = F.transform(_scanned(events, ends, within), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value")))
    return F.when(F.size(runs) == 0, F.array().cast(_FOUND)).when(F.size(base) == 0, runs).otherwise(kept)


def candidates(text: Column, base: Column) -> Column:
    """Long runs of key characters that touch no base span, with the results of the battery; text must not be null."""
    return tested(let(F.struct(located(text, RUN).alias("runs"), base.alias("base")), lambda x: _apart(x["runs"], x["base"])))


def thresholds(tests: DataFrame, column: str = "tests", false_share: float = FALSE_SHARE) -> dict[str, int]:
    """Least bin of p_text that is accepted, by cell of encoding and length class.

    The driver gets a row for each cell at most: 7 encodings times the binary
    logarithm of the longest run.  Cells without an acceptable bin are left out.
    """
    counts = tests.select(F.explode(column).alias("t")).groupBy("t.cell", "t.bin").agg(F.count("*").alias("n"))
    by_cell = counts.groupBy("cell").agg(F.sum("n").alias("all"), F.collect_list(F.struct("bin", "n")).alias("bins"))
    passing = F.filter(
        F.sequence(F.lit(0), F.lit(LAST_BIN)),
        lambda b: F.col("all") * F.pow(F.lit(10.0), -b / BINS)
        <= false_share * F.aggregate("bins", F.lit(0).cast("long"), lambda acc, x: acc + F.when(x["bin"] >= b, x["n"]).otherwise(F.lit(0).cast("long"))),
    )
    found = by_cell.select("cell", F.array_min(passing).alias("least")).where("least is not null")
    return {r["cell"]: r["least"] for r in found.collect()}


def random_spans(tests: Column, least: dict[str, int]) -> Column:
    """Spans of the runs that look random and are accepted for their cell."""
    cells = F.create_map(*[F.lit(v) for pair in sorted(least.items()) for v in pair]) if least else F.create_map().cast("map<string,int>")
    kept = F.filter(tests, lambda t: (t["p_random"] >= LEAST_RANDOM) & F.coalesce(t["bin"] >= F.try_element_at(cells, t["cell"]), F.lit(False)))
    return _as_kind(kept, "random")


def ordered(spans: Column) -> Column:
    """Spans by start, then kind as listed in KINDS."""
    rank = F.create_map(*[F.lit(v) for i, k in enumerate(KINDS) for v in (k, i)])
    keyed = F.transform(spans, lambda x: F.struct(x["start"].alias("start"), rank[x["kind"]].alias("rank"), x["end"].alias("end"), x["kind"].alias("kind")))
    return F.array_sort(keyed)


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined in order."""
    return F.array_join(F.transform(ordered(spans), lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def scanned(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs without the text column, with array columns assign, access, hex and tests.

    A null text counts as empty.  Columns of these names are replaced; repeated rows and
    all other columns stay.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    names = ("assign", "access", "hex")
    found = F.struct(*[c.alias(n) for n, c in zip(names, base_spans(whole))])
    every = let(found, lambda f: F.struct(*[f[n].alias(n) for n in names], candidates(whole, F.concat(*[f[n] for n in names])).alias("tests")))
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in (*names, "tests", text)]
    rest = [c for c in docs.columns if c not in (*names, "tests", text)]
    free = next(n for n in ("found", *(f"found_{i}" for i in range(len(rest) + 1))) if n not in rest)
    one = docs.select(*kept, every.alias(free))
    return one.select(*kept, *[F.col(f"`{free}`.{n}").alias(n) for n in (*names, "tests")])


def _cut(text: Column, spans: Column, mark: str) -> Column:
    """The text with a mark in place of each span or chain of overlapping spans; spans are in order.

    Each chunk of spans reads its own stretch of the text only.
    """

    def reach(chunks: Column) -> Column:
        """End of what the chunks before cover, and the end of the stretch that each chunk reads."""
        ends = F.transform(chunks, lambda c: F.array_max(F.transform(c, lambda x: x["end"])))
        return let(ends, lambda e: F.transform(e, lambda _, i: F.struct(F.coalesce(F.array_max(F.slice(e, 1, i)), F.lit(0)).alias("from"), F.array_max(F.slice(e, 1, i + 1)).alias("to"))))

    def within(chunk: Column, known: Column) -> Column:
        stretch = F.substring(text, known["from"] + 1, known["to"] - known["from"])

        def pieces(own: Column) -> Column:
            def step(acc: Column, x: Column) -> Column:
                gap = F.substring(own, acc["at"] - known["from"] + 1, x["start"] - acc["at"])
                return F.struct(
                    F.greatest(acc["at"], x["end"]).alias("at"),
                    F.when(x["start"] < acc["at"], acc["out"]).otherwise(F.array_append(acc["out"], F.concat(gap, F.lit(mark)))).alias("out"),
                )

            start = F.struct(known["from"].alias("at"), F.array().cast("array<string>").alias("out"))
            return F.aggregate(chunk, start, step, lambda acc: acc["out"])

        return let(stretch, pieces)

    last = F.array_max(F.transform(spans, lambda x: x["end"]))
    return F.concat(F.array_join(_scanned(spans, reach, within), ""), F.substring(text, last + 1, F.char_length(text)))


def redacted(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """docs with each secret in the text replaced by a mark; overlapping spans become one mark.

    Two passes: the first counts the battery's results over all documents that have long
    runs to set the thresholds, the second finds the spans again and cuts them out, so texts are
    neither shuffled nor kept.  Texts without secrets, null ones too, stay as they
    are; so do all other columns, repeated rows and the order of columns.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    # kept: thresholds() takes three times as long straight from that plan
    least = thresholds(settle(scanned(docs.select(text).where(whole.rlike(RUN)), text).select("tests")))
    spans = let(F.concat(*base_spans(whole)), lambda base: ordered(F.concat(base, random_spans(candidates(whole, base), least))))
    return docs.withColumn(text, let(spans, lambda own: F.when(F.size(own) > 0, _cut(whole, own, mark)).otherwise(F.col(text))))

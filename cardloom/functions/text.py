"""Column expressions over recognised lines: fields of a card, mobiles, cleaning, keys.

All are built-in expressions, so plans that use them stay in the JVM.  ``lines`` is an
array<string> column; a null array counts as empty.  Results are null only where said.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


@dataclass(frozen=True)
class Profile:
    """Which keywords count, whether their case does, and the longest name."""

    titles: tuple[str, ...]
    companies: tuple[str, ...]
    addresses: tuple[str, ...]
    ignore_case: bool
    name_chars: int


CARD = Profile(tuple(fixed.TITLES), tuple(fixed.COMPANIES), tuple(fixed.ADDRESSES), True, 30)
PAGE = Profile(tuple(fixed.TITLES[:16]), tuple(fixed.COMPANIES[:14]), tuple(fixed.ADDRESSES[:12]), False, 12)


def _column(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _lines(lines: Column | str) -> Column:
    return F.coalesce(_column(lines), F.array().cast("array<string>"))


#: Unicode white space and the separators that count as it in text.
_SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(text: Column | str) -> Column:
    """Text without Unicode white space at its ends."""
    return F.btrim(_column(text), F.lit(_SPACES))


def _sorted_matches(lines: Column, pattern: str, group: int = 0) -> Column:
    """Distinct matches in any line, sorted; no match of these patterns can cross a line."""
    found = F.flatten(F.transform(lines, lambda x: F.regexp_extract_all(x, F.lit(pattern), F.lit(group))))
    return F.array_sort(F.array_distinct(found))


def emails(lines: Column | str) -> Column:
    return _sorted_matches(_lines(lines), fixed.EMAIL)


def websites(lines: Column | str) -> Column:
    return _sorted_matches(_lines(lines), fixed.WEBSITE)


def wechat_ids(lines: Column | str) -> Column:
    return _sorted_matches(_lines(lines), fixed.WECHAT, 1)


def qq_ids(lines: Column | str) -> Column:
    return _sorted_matches(_lines(lines), fixed.QQ, 1)


def phone_candidates(lines: Column | str) -> Column:
    """Phone-like runs of each line as digits and plus signs, sorted and distinct.

    The pattern runs across single spaces, so two numbers with one between them are
    one candidate.  Every match has seven digits at least.
    """
    found = F.transform(
        _lines(lines),
        lambda x: F.transform(F.regexp_extract_all(x, F.lit(fixed.PHONE), F.lit(0)), lambda m: F.regexp_replace(m, r"(?U)[^\d+]", "")),
    )
    return F.array_sort(F.array_distinct(F.flatten(found)))


def _any_of(words: tuple[str, ...]) -> str:
    return "|".join(re.escape(w) for w in words)


def let(value: Column, body) -> Column:
    """body(value) with value computed once, inside a lambda too."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _has_word(text: Column, words: tuple[str, ...], profile: Profile) -> Column:
    """Substring searches one after the other; on long lines they beat one alternation by far."""

    def found(x: Column) -> Column:
        # a word that holds another one adds nothing
        own = list(dict.fromkeys(w.lower() if profile.ignore_case else w for w in words))
        return reduce(lambda a, b: a | b, (F.contains(x, F.lit(w)) for w in own if not any(o != w and o in w for o in own)))

    return let(F.lower(text), found) if profile.ignore_case else found(text)


def first_line_with(lines: Column | str, words: tuple[str, ...], profile: Profile = CARD) -> Column:
    """First line that holds any of the words, unchanged; null if none does."""
    return F.get(F.filter(_lines(lines), lambda x: _has_word(x, words, profile)), F.lit(0))


def guessed_name(lines: Column | str, profile: Profile = CARD) -> Column:
    """First stripped line that may be a name; null if none may.

    It has 2 code points or more, no keyword, e-mail, website or digit.
    """
    words = profile.companies + profile.titles + profile.addresses

    def may_be(x: Column) -> Column:
        size = F.char_length(x)
        return (size >= 2) & (size <= profile.name_chars) & ~_has_word(x, words, profile) & ~x.rlike(fixed.EMAIL) & ~x.rlike(fixed.WEBSITE) & ~x.rlike(r"(?U)\d")

    return F.get(F.filter(F.transform(_lines(lines), strip), may_be), F.lit(0))


def extracted(lines: Column | str, profile: Profile = CARD, fields: tuple[str, ...] | None = None) -> Column:
    """Struct of all fields of a card or page, or of those wanted; each costs passes of its own over the lines."""
    own = _lines(lines)
    every = {
        "name": lambda: guessed_name(own, profile), "company": lambda: first_line_with(own, profile.companies, profile), "title": lambda: first_line_with(own, profile.titles, profile),
        "phones": lambda: phone_candidates(own), "emails": lambda: emails(own), "websites": lambda: websites(own), "wechat_ids": lambda: wechat_ids(own), "qq_ids": lambda: qq_ids(own),
        "address": lambda: first_line_with(own, profile.addresses, profile), "full_text": lambda: F.array_join(own, "\n"),
    }
    return F.struct(*[every[c]().alias(c) for c in fields or every])


def token_mobiles(token: Column | str) -> Column:
    """Mainland mobiles in the digits of one token, left to right.

    Country prefixes need no removing: they hold no 1, so the search passes them.
    """
    return F.regexp_extract_all(F.regexp_replace(_column(token), "[^0-9+]", ""), F.lit(fixed.MOBILE), F.lit(0))


def mobiles(phones: Column | str) -> Column:
    """Distinct mobiles of a string of numbers in the order they are first seen; null gives none."""
    tokens = F.split(F.coalesce(_column(phones), F.lit("")), fixed.SEPARATORS)
    return F.array_distinct(F.flatten(F.transform(tokens, token_mobiles)))


def is_dirty(value: Column | str) -> Column:
    """Null, shorter than 2, nothing but marks, or a trace of an address on the web."""
    own = strip(_column(value))
    return F.coalesce((F.char_length(own) < 2) | own.rlike(r"\A[^\p{L}\p{N}]+\z") | own.rlike(fixed.DIRTY), F.lit(True))


def cleaned(value: Column | str) -> Column:
    """Stripped value; empty if it is dirty."""
    return F.when(is_dirty(value), "").otherwise(strip(_column(value)))


def card_key(*parts: Column | str) -> Column:
    """Parts joined by |, null ones as empty text."""
    return F.concat_ws("|", *[F.coalesce(_column(p).cast("string"), F.lit("")) for p in parts])


def is_fatal(status: Column | str, message: Column | str, error: Column | str) -> Column:
    """Errors of access, quota or payment, after which more calls make no sense.

    An empty message gives way to the error.
    """
    said = F.lower(F.coalesce(F.nullif(_column(message), F.lit("")), _column(error), F.lit("")))
    return F.coalesce(_column(status).isin(*fixed.FATAL_STATUS), F.lit(False)) | said.rlike(_any_of(tuple(fixed.FATAL_WORDS)))


def part_tag(file_name: Column | str) -> Column:
    """P2PartA and the like from a file name: phase 2 or 3, then the zone, else the first Latin letter, else X."""
    stem = F.regexp_replace(F.element_at(F.split(_column(file_name), "/"), -1), r"(?<=.)\.[^.]*\z", "")
    phase = F.regexp_extract(stem, "([23])期", 1)
    zone = F.coalesce(
        F.nullif(F.regexp_extract(stem, r"(?U)([A-Da-d])\s*区", 1), F.lit("")),
        F.nullif(F.regexp_extract(stem, "([A-Za-z])", 1), F.lit("")),
        F.lit("X"),
    )
    return F.concat(F.when(phase != "", F.concat(F.lit("P"), phase)).otherwise(""), F.lit("Part"), F.upper(zone))


def model_tag(model: Column | str) -> Column:
    """Model name with - and . as _."""
    return F.translate(_column(model), "-.", "__")


def model_short(model: Column | str) -> Column:
    """Short name of a model for file names."""
    own = _column(model)
    short = F.replace(own, F.lit("-"), F.lit(""))
    for part, name in fixed.MODEL_SHORT[::-1]:
        short = F.when(F.contains(own, F.lit(part)), name).otherwise(short)
    return short


def fingerprint(path: Column | str, length: Column | str, modified: Column | str) -> Column:
    """name:size:time of an input file; Spark knows the time to the microsecond."""
    return F.concat_ws(":", F.element_at(F.split(_column(path), "/"), -1), _column(length).cast("string"), (F.unix_micros(_column(modified)) * 1000).cast("string"))


def utc_now() -> Column:
    """Now as text, in UTC to the second."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def joined(values: Column | str) -> Column:
    """Array as text, separated by semicolons; null as empty."""
    return F.array_join(F.coalesce(_column(values), F.array().cast("array<string>")), ";")


def truthy(value: Column | str) -> Column:
    """Boolean of JSON text: false for null, false, 0, empty text, list or object; any other text is true."""
    own = _column(value)
    return F.coalesce(~own.isin("", "false", "null", "0", "0.0", "[]", "{}"), F.lit(False))

"""Secrets in texts: fixed patterns, and values near credential words by guess cost.

The patterns find assignments, access keys and long hexadecimal numbers. Beside
them, every value that follows a word such as ``password`` or ``bearer`` is cut
into known words, dates, repeats, keyboard walks and characters to be tried one
by one, in the way that takes the fewest guesses. Values that stay expensive
are secrets (kind ``guess``); ``password reset`` is not.

The known words are the corpus's own most frequent ones, so a model of
``dictionary`` words goes to the tasks. Spans are code points with an exclusive
end, and spans of patterns always stay. A null text is empty. Texts stay whole
and where they are, so long ones, repeated rows and repeated ids cost nothing
more. Clashing columns are replaced. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.common import with_text_columns

KINDS = ("assign", "access", "hex", "guess")
#: log2 of the guesses from which on a value is a secret.
LEAST_BITS = 32.0
#: Most frequent words of the corpus that the guesser knows, and how often one must occur.
DICTIONARY, LEAST_USES = 30_000, 20
LONGEST_WORD = 24
RANK_BUCKETS = 32

_ASSIGN = re.compile(
    "(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
# shorter runs would fail the length test
_HEX = re.compile("[0-9a-f]{32,}")

#: Letters of which one must be in a text with a credential word.
_HINTS = ("pass", "pwd", "secret", "token", "credential", "key", "auth", "bearer", "login", "pin")
_CONTEXT = re.compile(
    r"(?<![a-z0-9])(?:pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|credentials?"
    r"|(?:api|access|private|secret)?[ _-]?key|auth(?:orization)?|bearer|login)(?![a-z])"
    r"""["']?(?P<link>\s*(?:[:=]|=>|->)\s*|\s+(?:is|was)\s*:?\s+|\s+)["'`(<\[]?"""
    r"""(?P<value>[^\s"'`<>()\[\]]{6,})""",
    re.IGNORECASE | re.ASCII,
)
_TRAILING = ".,;:!?"

# The rows of a keyboard, and the alphabet and digits in order.
_WALKS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz")
_STEPS = {pair for row in _WALKS for run in (row, row[::-1]) for pair in zip(run, run[1:])}
_COLUMNS = ("1qaz", "2wsx", "3edc", "4rfv", "5tgb", "6yhn", "7ujm")
_STEPS |= {pair for row in _COLUMNS for run in (row, row[::-1]) for pair in zip(run, run[1:])}

# Letters that digits and signs stand for.
_LEET = str.maketrans("0134578@$", "oleastbas")
_DATES = re.compile(
    r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d"
    r"|(?:0[1-9]|1[0-2])[-/._](?:0[1-9]|[12]\d|3[01])[-/._]\d\d"
    r"|(?:19|20)\d\d"
)
_DATE_BITS, _YEAR_BITS = math.log2(366 * 200), math.log2(200)
#: Choosing the kind of the next part.
_PART_BITS = 2.0


def _character_bits(character: str) -> float:
    if character.isdigit() and character.isascii():
        return math.log2(10)
    if character.isalpha():
        return math.log2(26) if character.isascii() else math.log2(100)
    return math.log2(33)


def _case_bits(word: str) -> float:
    if word.islower() or not any(c.isupper() for c in word):
        return 0.0
    if word.isupper() or (word[0].isupper() and word[1:].islower()):
        return 1.0
    upper = sum(c.isupper() for c in word)
    return math.log2(math.comb(len(word), upper)) + 1


def guess_bits(value: str, ranks: Mapping[str, int]) -> float:
    """log2 of the fewest guesses: the cheapest cut of ``value`` into guessable parts.

    ``best[i]`` is the cost of the first i characters. Work grows with the
    length times ``LONGEST_WORD``.
    """
    size = len(value)
    lower = value.lower() if len(value.lower()) == size else value
    plain = lower.translate(_LEET)
    arrivals: list[list[tuple[int, float]]] = [[] for _ in range(size + 1)]
    for found in _dates(value):
        begin, end = found
        bits = _YEAR_BITS if end - begin == 4 else _DATE_BITS
        arrivals[end].append((begin, bits))
    walk = 0
    for at in range(1, size):
        walk = walk if (lower[at - 1], lower[at]) in _STEPS else at
        if at - walk >= 2:
            # start, direction and length of the walk
            arrivals[at + 1].append((walk, math.log2(94 * (at + 1 - walk)) + 1))
    # a new part pays for its kind; characters tried one by one are one part
    best, tried = [0.0] + [math.inf] * size, [math.inf] * (size + 1)
    repeats = [0] * 5
    for end in range(1, size + 1):
        step = _character_bits(value[end - 1])
        tried[end] = min(tried[end - 1], best[end - 1] + _PART_BITS) + step
        cost = tried[end]
        for begin in range(max(0, end - LONGEST_WORD), end - 2):
            rank = ranks.get(lower[begin:end])
            swaps = 0.0
            if rank is None and plain[begin:end] != lower[begin:end]:
                rank = ranks.get(plain[begin:end])
                swaps = 1.0 + sum(a != b for a, b in zip(plain[begin:end], lower[begin:end]))
            if rank is not None:
                bits = math.log2(rank + 1) + swaps + _case_bits(value[begin:end])
                cost = min(cost, best[begin] + _PART_BITS + bits)
        for unit in range(1, 5):
            # characters up to here that equal the ones a unit earlier
            same = end > unit and value[end - 1] == value[end - 1 - unit]
            repeats[unit] = repeats[unit] + 1 if same else 0
            times = repeats[unit] // unit
            if times >= (2 if unit == 1 else 1):
                begin = end - unit * times
                cost = min(cost, best[begin] + _PART_BITS + math.log2(times + 1))
        for begin, bits in arrivals[end]:
            cost = min(cost, best[begin] + _PART_BITS + bits)
        best[end] = cost
    return best[size]


def _dates(value: str) -> list[tuple[int, int]]:
    """Every place where a date or a year begins, whatever was read before it."""
    found, at = [], 0
    while match := _DATES.search(value, at):
        found.append(match.span())
        if match.end() - match.start() > 4 and value[match.start() : match.start() + 2] in ("19", "20"):
            found.append((match.start(), match.start() + 4))
        at = match.start() + 1
    return found


Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of the fixed patterns, in order; kinds by their place in ``KINDS``."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m.group()) >= 16]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def context_values(text: str) -> list[tuple[int, int]]:
    """Where values follow credential words.

    After a blank alone a value needs letters beside digits or signs.
    """
    lower = text.lower()
    if not any(hint in lower for hint in _HINTS):
        return []
    found, at = [], 0
    while match := _CONTEXT.search(text, at):
        start, end = match.span("value")
        value = text[start:end].rstrip(_TRAILING)
        plain = not any(c.isalpha() for c in value) or value.isalpha()
        if len(value) >= 6 and not (plain and not match["link"].strip()):
            found.append((start, start + len(value)))
        # a short value may itself be a credential word
        at = start if end - start < LONGEST_WORD else end
    return found


def all_spans(
    text: str, ranks: Mapping[str, int], least_bits: float = LEAST_BITS
) -> tuple[list[Span], list[Span], float]:
    """Spans of the patterns, all spans, and the largest guess cost near a credential word."""
    base = base_spans(text)
    starts, reach = [], []
    for start, _, end in base:
        starts.append(start)
        reach.append(max(end, reach[-1] if reach else 0))
    more, most = set(), 0.0
    for start, end in context_values(text):
        bits = guess_bits(text[start:end], ranks)
        most = max(most, bits)
        before = bisect_right(starts, end - 1)
        if bits >= least_bits and not (before and reach[before - 1] > start):
            more.add((start, 3, end))
    return base, sorted(base + list(more)), most


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def common_words(
    docs: DataFrame, dictionary: int = DICTIONARY, least: int = LEAST_USES
) -> dict[str, int]:
    """Rank, from 1, of the corpus's most frequent words; at most ``dictionary`` of them."""
    words = F.split(F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), "[^\\p{L}]+")
    counts = (
        docs.select(F.explode(words).alias("word"))
        .where(F.length("word").between(3, LONGEST_WORD))
        .groupBy("word")
        .count()
        .where(F.col("count") >= least)
    )
    # ranked in buckets first, so that one task and the driver see a bounded number
    best = [F.desc("count"), F.asc("word")]
    within = Window.partitionBy(F.pmod(F.xxhash64("word"), F.lit(RANK_BUCKETS))).orderBy(*best)
    heads = counts.withColumn("place", F.row_number().over(within))
    heads = heads.where(F.col("place") <= dictionary).coalesce(1)
    top = heads.orderBy(*best).limit(dictionary).select("word").collect()
    return {row["word"]: rank for rank, row in enumerate(top, 1)}


SCHEMA = (
    "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string,"
    " n_guess bigint, guess_bits double"
)


def find_secrets(
    docs: DataFrame, ranks: Mapping[str, int] | None = None, least_bits: float = LEAST_BITS
) -> DataFrame:
    """``docs`` with counts by kind, the spans, and the largest guess cost of a value."""
    known = common_words(docs) if ranks is None else ranks

    def scan(texts):
        rows = []
        for own in texts:
            text = own.decode() if own else ""
            base, spans, bits = all_spans(text, known, least_bits)
            kinds = [kind for _, kind, _ in spans]
            digest = hashlib.sha256(_joined(base).encode()).hexdigest()
            rows.append(
                (*[kinds.count(k) for k in range(3)], digest, _joined(spans), kinds.count(3), bits)
            )
        return [list(column) for column in zip(*rows, strict=True)] or [[] for _ in range(7)]

    return with_text_columns(docs, SCHEMA, scan)

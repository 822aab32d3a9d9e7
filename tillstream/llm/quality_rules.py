"""Quality rules as weak supervision.

Each rule looks at a document's statistics and votes good (1), bad (-1) or
abstains (0). Expectation-maximisation over the counts of vote patterns
estimates how often each rule is right about good and about bad documents; a
document stays if its posterior probability of being good reaches a threshold,
and not because it passes every rule.

Only the pattern counts reach the driver: at most three to the number of rules.

A null or empty text has no words: all counts are 0 and the length rule's base
test fails. Equal rows get equal results, an empty table an empty one, and a
column of the input named like a result is replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import set_aside, with_text_columns

SYMBOLS = b"[#*$%&|<>]"
# Frequent function words of the languages at hand.
FUNCTION_WORDS = {
    "en": "the of and to in a is that for it was on are with as be this by an at from or",
    "de": "der die und das den dem von zu mit ist des auf für nicht ein eine im sich auch es",
    "fr": "le la les de des et en un une du est que qui dans pour par sur pas au avec il",
    "es": "el la los las de del y en un una que es se no por con su para al lo",
}
_FUNCTION = frozenset(" ".join(FUNCTION_WORDS.values()).encode().split())

STATISTICS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_lines bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, n_function_words bigint, n_distinct_words bigint, n_bare_words bigint"
)

_GAPS = re.compile(rb"[ \t-\r]")
_SYMBOLS = re.compile(SYMBOLS)


def _repeat_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found at least twice."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts, last, covered = Counter(windows), -1, 0
    for place, window in enumerate(windows):
        if counts[window] > 1:
            covered += place + 2 - max(last, place - 1)
            last = place + 2
    return covered


def document_statistics(text: bytes | None) -> tuple[int, ...]:
    """The fields of ``STATISTICS``; a null text counts as empty."""
    text = text or b""
    words = text.split()
    joined = b"".join(words)
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\v\f\r")]
    return (
        len(words),
        len(joined.decode("utf-8", "replace")),
        len(_SYMBOLS.findall(text)),
        len(lines),
        len(lines) - len(set(lines)),
        _repeat_words(words),
        sum(word.lower() in _FUNCTION for word in words),
        len(set(words)),
        sum(1 for word in words if not word.strip(b"#*$%&|<>.,;:!?-_=+/\\\"'()[]{}~^`@0123456789")),
    )


def _columns(texts):
    rows = [document_statistics(text) for text in texts]
    return list(zip(*rows, strict=True)) if rows else [[] for _ in range(9)]


def with_statistics(docs: DataFrame) -> DataFrame:
    return with_text_columns(docs, STATISTICS, _columns)


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Votes by rule name."""
    words = F.col("n_words")
    symbols = _share("n_symbols", "n_words")
    repeats = _share("n_repeat_words", "n_words")
    dup_lines = _share("n_dup_lines", "n_lines")
    length = _share("word_chars", "n_words")
    function = _share("n_function_words", "n_words")
    variety = _share("n_distinct_words", "n_words")
    bare = _share("n_bare_words", "n_words")
    return {
        "length": _vote((words >= 100) & (words <= 100_000), words < 50),
        "symbols": _vote(symbols < 0.05, symbols > 0.15),
        "repeated_words": _vote(repeats < 0.2, repeats > 0.4),
        "repeated_lines": _vote((dup_lines == 0) & (F.col("n_lines") > 2), dup_lines > 0.5),
        "word_length": _vote((length >= 3) & (length <= 9), (length < 2) | (length > 14)),
        "function_words": _vote(function > 0.1, function < 0.03),
        "variety": _vote((variety > 0.2) | (words > 2000), (variety < 0.1) & (words > 50)),
        "bare_words": _vote(bare < 0.1, bare > 0.3),
    }


@dataclass(frozen=True)
class RuleModel:
    """``prior``: share of good documents. By rule: the probability that a vote is
    right, for good and for bad documents."""

    prior: float
    right_on_good: dict[str, float]
    right_on_bad: dict[str, float]

    def posterior(self) -> Column:
        """Probability of being good, from the votes in a column ``votes``."""
        total: Column = F.lit(math.log(self.prior / (1 - self.prior)))
        for name in self.right_on_good:
            good, bad = self.right_on_good[name], self.right_on_bad[name]
            vote = F.col(f"votes.{name}")
            total = total + F.when(vote == 1, math.log(good / (1 - bad))).when(
                vote == -1, math.log((1 - good) / bad)
            ).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def with_votes(docs: DataFrame) -> DataFrame:
    """Statistics, and a struct ``votes`` of each rule's vote."""
    votes = F.struct(*[vote.cast("int").alias(name) for name, vote in rules().items()])
    return with_statistics(docs).withColumn("votes", votes)


def fit_rules(voted: DataFrame, rounds: int = 50, start: float = 0.8) -> RuleModel:
    """Expectation-maximisation over the counts of vote patterns.

    Every rule starts as right with probability ``start``. Two pseudo-votes at
    that rate keep a rule that never votes, or is never wrong, away from 0 and
    1, and keep good from trading places with bad.
    """
    names = list(rules())
    counted = voted.groupBy("votes").count().collect()
    patterns = sorted((tuple(row.votes[n] for n in names), row["count"]) for row in counted)
    total = sum(count for _, count in patterns)
    prior, good = 0.7, dict.fromkeys(names, start)
    bad = dict(good)
    for _ in range(rounds if total else 0):
        mass, right_good, right_bad = 0.0, dict.fromkeys(names, 0.0), dict.fromkeys(names, 0.0)
        voted_good, voted_bad = dict.fromkeys(names, 0.0), dict.fromkeys(names, 0.0)
        for votes, count in patterns:
            odds = math.log(prior / (1 - prior))
            for name, vote in zip(names, votes, strict=True):
                if vote == 1:
                    odds += math.log(good[name] / (1 - bad[name]))
                elif vote == -1:
                    odds += math.log((1 - good[name]) / bad[name])
            share = 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))
            mass += share * count
            for name, vote in zip(names, votes, strict=True):
                if vote:
                    voted_good[name] += share * count
                    voted_bad[name] += (1 - share) * count
                    right_good[name] += share * count * (vote == 1)
                    right_bad[name] += (1 - share) * count * (vote == -1)
        weight = 2.0
        for name in names:
            good[name] = (right_good[name] + weight * start) / (voted_good[name] + weight)
            bad[name] = (right_bad[name] + weight * start) / (voted_bad[name] + weight)
        prior = (mass + 1) / (total + 2)
    return RuleModel(prior, good, bad)


def judge(voted: DataFrame, model: RuleModel, threshold: float = 0.5) -> DataFrame:
    """Columns base_failed, quality_probability and kept."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        voted.withColumn("base_failed", failed)
        .withColumn("quality_probability", model.posterior())
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality_probability") >= threshold))
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that stay, with their own columns only."""
    plain, back = set_aside(docs, ("text",))
    model = fit_rules(with_votes(docs.select("text")))
    return judge(with_votes(plain), model).filter("kept").select(*back)

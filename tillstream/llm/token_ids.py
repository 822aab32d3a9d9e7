"""Whole texts to token ids with the public tokenizers.

Neither tokenizer ever joins characters across the gaps matched here, so a text's
ids are its units' ids in a row. Units recur: each is encoded once and kept. Arrow
cuts a batch of texts into units, numbers them and puts their ids in a row, so that
Python sees a unit once a batch.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tillstream.llm.common import SEPARATORS, WHITE

#: Units that a worker gathers before it drops those not met since it last had so many; for speed only.
KEPT_UNITS = 250_000
#: Units that are encoded together; the tokenizers take longer a unit for many more.
TOGETHER = 128

_WORDS = re.compile(f"[^{WHITE}]+")
_SPACED = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]")
# For Arrow: a space at the start, runs of white space, white space other than the space and the line end, and the cut.
_ODD_GAPS = r"^ |  |\n\n| \n|\n |[\x00\t\x0b-\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_GAPS = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# The like of _MARK_INSIDE.
_MARKS_INSIDE = rf"[.,][^{_GAPS}]|(?:^|[^\p{{L}}\p{{N}}])[.,]"
# A full stop or comma that does not stand between a letter or digit and a gap.
_MARK_INSIDE = re.compile(f"[.,](?:(?=[^{WHITE}])|(?<![^\\W_][.,]))")
_MARK_AT_END = re.compile(f"(?<=[^\\W_])[.,](?![^{WHITE}])")


def dropped_gaps_of(texts: list[str]) -> list[str]:
    return [dropped_gaps(text) for text in texts]


def dropped_gaps(text: str) -> str:
    """Units, with ASCII white space between, for a tokenizer that drops white space.

    Where every full stop and comma ends a word, it is a unit of its own.
    """
    if SEPARATORS.search(text):
        return " ".join(_WORDS.findall(text))
    if not _MARK_INSIDE.search(text):
        text = text.replace(".", " .").replace(",", " ,")
    return text if text.isascii() else " ".join(text.split())


def leading_gaps(text: str) -> str | list[str]:
    """Units for a byte-level tokenizer: a word takes one space before it along.

    White space before a word leaves its last character to the word if that is
    a space, and as a unit of its own if not. Where white space stands alone
    everywhere, every space begins a unit and a line end is one; and a full stop
    or comma that ends a word is one too. Such units come as one text with
    ``\\0`` between.
    """
    return leading_gaps_of([text])[0]


def leading_gaps_of(texts: list[str]) -> list[str | list[str]]:
    """``leading_gaps`` of each text; Arrow tells which texts need more than the plain cuts."""
    column = pa.array(texts, pa.large_string())
    odd, inside = (
        pc.match_substring_regex(column, own).to_pylist() for own in (_ODD_GAPS, _MARKS_INSIDE)
    )
    return [_leading_gaps(*own) for own in zip(texts, odd, inside, strict=True)]


def _leading_gaps(text: str, odd: bool, inside: bool) -> str | list[str]:
    if odd:
        return _SPACED.findall(text)
    if inside:
        text = _MARK_AT_END.sub("\0\\g<0>", text)
    else:
        text = text.replace(".", "\0.").replace(",", "\0,")
    return text.replace(" ", "\0 ").replace("\n", "\0\n\0")


def _at_gaps(texts: pa.Array) -> pa.Array:
    return pc.ascii_split_whitespace(texts)


def _at_nulls(texts: pa.Array) -> pa.Array:
    return pc.split_pattern(texts, "\0")


# Letters that Unicode's normal form leaves alone, each with one lower case.
_LETTERS = re.compile(" ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u017f]+")
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
# The character that stands for a byte in byte-level tokenizers.
_VISIBLE = {
    byte: chr(0x100 + k) for k, byte in enumerate(sorted(set(range(0x100)).difference(_SHOWN)))
}
_UNITS = pa.large_list(pa.large_string())


class IdEncoder:
    """Texts to little-endian unsigned 32-bit ids, as the tokenizer gives them.

    A text that holds one of the tokenizer's added tokens is encoded as a whole.

    ``units`` gives each text's units as a list, or as one text that ``split`` cuts.
    ``between`` parts units that are encoded together: it must always be encoded as
    the one id ``mark``, which no unit without the character ``mark_text`` has.

    ``plain``, if given, does what the tokenizer does to units of Latin letters, with
    or without a space before them, until they come to its model; they are given and
    taken as one text with line ends between.
    """

    def __init__(
        self,
        path: str,
        units: Callable[[list[str]], list[str | list[str]]],
        split: Callable[[pa.Array], pa.Array],
        between: str,
        mark_text: str,
        plain: Callable[[str], str] | None = None,
    ):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        # whatever the case: a normalizer may find more than the plain string
        names = "|".join(re.escape(token.content) for token in added) or "(?!)"
        self.added = re.compile(names, re.IGNORECASE)
        self.units, self.split, self.between, self.mark_text = units, split, between, mark_text
        (self.mark,) = self.tokenizer.encode(between, add_special_tokens=False).ids
        self.plain = plain
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: list[str | None], end: int) -> list[bytes]:
        """Ids of every text (null: empty) and the end id, as bytes."""
        ids = [b""] * len(texts)
        whole = {k: text for k, text in enumerate(texts) if text and self.added.search(text)}
        cut = [k for k, text in enumerate(texts) if text and k not in whole]
        made = dict(zip(cut, self.units([texts[k] for k in cut]), strict=True))
        joined = [k for k in cut if isinstance(made[k], str)]
        units = self.split(pa.array([made.pop(k) for k in joined], pa.large_string())).cast(_UNITS)
        if made:
            units = pa.concat_arrays([units, pa.array(made.values(), _UNITS)])
        order = [*joined, *made]
        del made
        # what is no longer needed goes at once: a task's memory is for several of these
        numbered = units.flatten().dictionary_encode()
        ends = np.cumsum(units.value_lengths().to_numpy())
        del units
        found = self._units(numbered.dictionary.to_numpy(zero_copy_only=False).tolist())
        each, numbered = pa.array(found, pa.large_binary()), numbered.indices
        del found
        found = each.take(numbered)
        del each, numbered
        _, places, data = found.buffers()
        ends = np.frombuffer(places, np.int64, len(found) + 1)[ends].tolist()
        data = memoryview(data if data is not None else b"")
        for k, first, after in zip(order, [0, *ends], ends, strict=False):
            ids[k] = bytes(data[first:after])
        for k, own in zip(whole, self._ids(list(whole.values())), strict=True):
            ids[k] = own
        last = int(end).to_bytes(4, "little")
        return [own + last for own in ids]

    def _units(self, units: list[str]) -> list[bytes]:
        """Ids of distinct units."""
        if len(self.known) > KEPT_UNITS:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        found = list(map(known.get, units))
        letters, alone, together = [], [], []
        for k in [k for k, own in enumerate(found) if own is None]:
            unit = units[k]
            if (own := older.get(unit)) is not None:
                found[k] = known[unit] = own
            elif self.plain and _LETTERS.fullmatch(unit):
                letters.append(k)
            elif self.mark_text in unit or not unit or unit.isspace():
                alone.append(k)
            else:
                together.append(k)
        kinds = ((letters, self._plain_ids), (alone, self._ids), (together, self._ids_together))
        for places, encode in kinds:
            new = [units[k] for k in places]
            made = encode(new)
            known.update(zip(new, made, strict=True))
            for k, own in zip(places, made, strict=True):
                found[k] = own
        return found

    def _ids_together(self, units: list[str]) -> list[bytes]:
        """Ids of units without the character ``mark_text``."""
        found: list[bytes] = []
        for first in range(0, len(units), TOGETHER):
            (data,) = self._ids([self.between.join(units[first : first + TOGETHER])])
            marks = (4 * np.flatnonzero(np.frombuffer(data, "<u4") == self.mark)).tolist()
            starts = [0, *(mark + 4 for mark in marks)]
            found += [data[a:b] for a, b in zip(starts, [*marks, len(data)], strict=True)]
        return found

    def _plain_ids(self, units: list[str]) -> list[bytes]:
        """Ids of units of Latin letters, which come whole to the tokenizer's model."""
        if not units:
            return []
        tokenize = self.tokenizer.model.tokenize
        shown = self.plain("\n".join(units)).split("\n")
        found = [[token.id for token in tokenize(unit)] for unit in shown]
        data = np.fromiter(chain.from_iterable(found), "<u4").tobytes()
        ends = [4 * end for end in accumulate(map(len, found))]
        return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(own.ids, "<u4").tobytes() for own in found]


@cache
def word_bpe(path: str | None = None) -> IdEncoder:
    """The word tokenizer, by default the installed ``word_bpe_49k.json``; one for a process."""
    plain = None if path else _lower_visible
    return IdEncoder(
        path or _installed("word_bpe_49k.json"), dropped_gaps_of, _at_gaps, " | ", "|", plain
    )


@cache
def byte_bpe(path: str | None = None) -> IdEncoder:
    """The byte tokenizer, by default the installed ``byte_bpe_50k.json``; one for a process."""
    plain = None if path else _visible
    return IdEncoder(path or _installed("byte_bpe_50k.json"), leading_gaps_of, _at_nulls, "\n", "\n", plain)


def _visible(units: str) -> str:
    if units.isascii():
        return units.replace(" ", _VISIBLE[0x20])
    units = units.encode().decode("latin-1")
    for byte in set(units.encode("latin-1")).intersection(_VISIBLE).difference(b"\n"):
        units = units.replace(chr(byte), _VISIBLE[byte])
    return units


def _lower_visible(units: str) -> str:
    return _visible(units.lower())


def _installed(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)

"""Format-preserving pseudonyms for personal numbers, dates and addresses.

A value is recognised by its format and its validity (check digits, ranges,
calendar), read as a number of its format's domain, permuted there by a keyed
Feistel network, and written back in the same format. The permutation is fixed
by the key, so equal values get equal pseudonyms in all documents and different
ones stay different; the key's holder can turn it back.

| kind | valid | permuted |
|---|---|---|
| card | 13-19 digits, Luhn | all but the check digit, which is set anew |
| iban | length, mod 97 | all after the check digits, which are set anew |
| ssn | ddd-dd-dddd in use | all digits, again until in use |
| phone | + and 8-15 digits, or 3-3-4 digits | digits after the country code |
| ip | four numbers to 255 | the 32 bits |
| date | a day of 1900-2099 | the day |
| email | name@domain.tld | letters and digits of the name, each within its class |
| secret | 32, 40 or 64 hexadecimal digits in quotes | all digits |

Of a run of digits or letters that is no value as a whole, shorter parts that end
at a separator are tried, longest first (an IBAN's length by its country before
others), so that a value next to other numbers is found. A pseudonym that makes
up a valid value with the digits after it, one card in ten there, is found again
as that longer value and does not turn back.

A null text stays null, other texts keep their length unless an IP's numbers
change theirs. Everything else is left as it is.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import set_aside, with_text_columns

ROUNDS = 8
KINDS = ("card", "iban", "ssn", "phone", "ip", "date", "email", "secret")

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2100, 1, 1).toordinal() - _FIRST_DAY


class Feistel:
    """A keyed permutation of 0 ... size - 1, for one use (``tweak``)."""

    def __init__(self, key: bytes, tweak: str, size: int):
        self.left = math.isqrt(size)
        self.right, self.size = -(-size // self.left), size
        self.seed = hashlib.blake2b(f"{tweak}/{size}".encode(), key=key[:64], digest_size=32)

    def _mix(self, turn: int, half: int) -> int:
        state = self.seed.copy()
        state.update(f"/{turn}/{half}".encode())
        return int.from_bytes(state.digest(), "big")

    def permute(self, value: int) -> int:
        while True:
            high, low = divmod(value, self.right)
            for turn in range(0, ROUNDS, 2):
                high = (high + self._mix(turn, low)) % self.left
                low = (low + self._mix(turn + 1, high)) % self.right
            value = high * self.right + low
            if value < self.size:
                return value

    def restore(self, value: int) -> int:
        while True:
            high, low = divmod(value, self.right)
            for turn in range(ROUNDS - 2, -1, -2):
                low = (low - self._mix(turn + 1, high)) % self.right
                high = (high - self._mix(turn, low)) % self.left
            value = high * self.right + low
            if value < self.size:
                return value


def luhn_digit(payload: str) -> str:
    """The check digit that makes payload and digit pass the Luhn test."""
    total = 0
    for place, digit in enumerate(reversed(payload)):
        doubled = int(digit) * (2 if place % 2 == 0 else 1)
        total += doubled - 9 if doubled > 9 else doubled
    return str(-total % 10)


def _refill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced by ``digits``, one after another."""
    new = iter(digits)
    return "".join(next(new) if c in _DIGITS else c for c in shape)


def _only_digits(text: str) -> str:
    return "".join(c for c in text if c in _DIGITS)


def _iban_rest(text: str) -> int:
    moved = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97


class Pseudonymizer:
    """Finds values and replaces them under one key."""

    def __init__(self, key: bytes, kinds: tuple[str, ...] = KINDS, invert: bool = False):
        self.key, self.kinds, self.invert = key, kinds, invert
        self.networks: dict[tuple[str, int], Feistel] = {}
        self.replace: Callable[[str, str], str | None] = lru_cache(1 << 16)(self._replace)

    def _turn(self, tweak: str, size: int, value: int) -> int:
        network = self.networks.get((tweak, size))
        if network is None:
            network = self.networks[tweak, size] = Feistel(self.key, tweak, size)
        return network.restore(value) if self.invert else network.permute(value)

    def _turn_digits(self, tweak: str, digits: str) -> str:
        return f"{self._turn(tweak, 10 ** len(digits), int(digits)):0{len(digits)}d}"

    def _turn_classes(self, tweak: str, text: str) -> str:
        """Letters and digits, each within its class; other characters stay."""
        sets = [next((s for s in (_DIGITS, _LOWER, _UPPER) if c in s), "") for c in text]
        size, value = 1, 0
        for letters, c in zip(sets, text, strict=True):
            if letters:
                size, value = size * len(letters), value * len(letters) + letters.index(c)
        # the classes are part of the format: each sequence of them has its own permutation
        shape = "".join(letters[:1] or c for letters, c in zip(sets, text, strict=True))
        value, out = self._turn(f"{tweak}/{shape}", size, value), []
        for letters, c in zip(reversed(sets), reversed(text), strict=True):
            if letters:
                value, place = divmod(value, len(letters))
                c = letters[place]
            out.append(c)
        return "".join(reversed(out))

    def _replace(self, kind: str, text: str) -> str | None:
        """The pseudonym, or None for an invalid value."""
        return getattr(self, f"_{kind}")(text)

    def _card(self, text: str) -> str | None:
        digits = _only_digits(text)
        if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1]:
            return None
        if len(set(digits)) == 1:
            return None
        payload = self._turn_digits("card", digits[:-1])
        return _refill(text, payload + luhn_digit(payload))

    def _iban(self, text: str) -> str | None:
        plain = text.replace(" ", "")
        if not 15 <= len(plain) <= 34 or _iban_rest(plain) != 1:
            return None
        country, account = plain[:2], self._turn_classes("iban", plain[4:])
        check = 98 - _iban_rest(f"{country}00{account}")
        new = iter(f"{country}{check:02d}{account}")
        return "".join(c if c == " " else next(new) for c in text)

    def _ssn(self, text: str) -> str | None:
        def in_use(d):
            return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"

        digits = _only_digits(text)
        if not in_use(digits):
            return None
        digits = self._turn_digits("ssn", digits)
        while not in_use(digits):
            digits = self._turn_digits("ssn", digits)
        return _refill(text, digits)

    def _phone(self, text: str) -> str | None:
        digits = _only_digits(text)
        if not 8 <= len(digits) <= 15:
            return None
        code = re.match(r"\+(\d{1,3})(?=[ (.-])", text)
        keep = len(code[1]) if code else int(text[0] == "+")
        return _refill(text, digits[:keep] + self._turn_digits(f"phone{keep}", digits[keep:]))

    def _ip(self, text: str) -> str | None:
        parts = [int(part) for part in text.split(".")]
        if max(parts) > 255:
            return None
        value = self._turn("ip", 1 << 32, int.from_bytes(bytes(parts), "big"))
        return ".".join(map(str, value.to_bytes(4, "big")))

    def _date(self, text: str) -> str | None:
        parts = re.split(r"[-/.]", text)
        iso = len(parts[0]) == 4
        year, month, day = map(int, parts if iso else reversed(parts))
        swapped = not iso and month > 12 >= day  # month first
        if swapped:
            month, day = day, month
        try:
            number = datetime.date(year, month, day).toordinal() - _FIRST_DAY
        except ValueError:
            return None
        if not 0 <= number < _DAYS:
            return None
        tweak = f"date{'m' if swapped else ''}"
        while True:
            number = self._turn(tweak, _DAYS, number)
            new = datetime.date.fromordinal(number + _FIRST_DAY)
            # the order of day and month must be read back as it was
            if not swapped or new.day > 12:
                break
        fields = [f"{new.year:04d}", f"{new.month:02d}", f"{new.day:02d}"]
        if swapped:
            fields[1], fields[2] = fields[2], fields[1]
        between = next(c for c in text if c in "-/.")
        return between.join(fields if iso else reversed(fields))

    def _email(self, text: str) -> str | None:
        name, _, domain = text.rpartition("@")
        return f"{self._turn_classes('email', name)}@{domain}"

    def _secret(self, text: str) -> str | None:
        digits = text[1:-1]
        upper = digits.upper() == digits and digits.lower() != digits
        value = self._turn(f"secret{upper}", 16 ** len(digits), int(digits, 16))
        return f'"{value:0{len(digits)}{"X" if upper else "x"}}"'

    def text(self, text: str | None) -> tuple[str | None, dict[str, int]]:
        """The text with pseudonyms, and how many of each kind."""
        found: dict[str, int] = {}
        if not text:
            return text, found

        def swap(match: re.Match) -> str:
            new = self.replace("email", match[0])
            found["email"] = found.get("email", 0) + 1
            return new

        if "@" in text and "email" in self.kinds:
            text = _EMAIL.sub(swap, text)
        if _DIGIT.search(text):
            text = self._numbers(text, found)
        return text, found

    def _numbers(self, text: str, found: dict[str, int]) -> str:
        """The text with all valid values but addresses replaced.

        Where the longest candidate is not valid, shorter ones and other kinds
        are tried from the same place, then from later ones inside it.
        """
        out, done, at = [], 0, 0
        while match := _NUMBERS.search(text, at):
            start = match.start()
            at = start + 1
            for kind, end in _candidates(text, start):
                new = self.replace(kind, text[start:end])
                if new is None:
                    continue
                if kind in self.kinds:
                    out += [text[done:start], new]
                    found[kind] = found.get(kind, 0) + 1
                    done = end
                at = end
                break
        out.append(text[done:])
        return "".join(out)


_DIGIT = re.compile("[0-9]")
_EMAIL = re.compile(r"(?P<email>[^\s@<>|,;:()\"'\[\]{}=]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})")
#: What stands before a value; a number's own digits never do, so that no part of a run is taken.
_BEFORE = r"(?<![\w.@+])"
_KINDS = {
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "date": r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})"
    r"(?:(?=[Tt][0-9]{2}(?::?[0-9]{2}|(?![\w])))|(?![\w/-]|\.[0-9]))",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "ip": r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\w|\.[0-9])",
    "phone": r"(?:(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
    r"|\+[0-9](?:[ .-]?[0-9]){7,14})(?![\w-])",
    "card": r"[0-9](?:[ -]?[0-9]){12,18}(?![\w-])",
    "secret": r"\"(?:[0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32}|[0-9A-F]{64}|[0-9A-F]{40}|[0-9A-F]{32})\"",
}
_OF_KIND = {kind: re.compile(pattern) for kind, pattern in _KINDS.items()}
#: Where a value may begin; a long run of digits counts even if more digits follow.
_LOOSE = _KINDS | {
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2}",
    "card": r"[0-9](?:[ -]?[0-9]){12}",
}
_NUMBERS = re.compile(f"{_BEFORE}(?:{'|'.join(_LOOSE.values())})")
_CARD_RUN = re.compile(r"[0-9](?:[ -]?[0-9]){12,18}")
_IBAN_RUN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_WORD = re.compile(r"\w")
#: Signs of an IBAN by country; the length tried first.
_IBAN_SIGNS = {
    country: signs
    for signs, countries in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK",
        21: "CH HR LI LV", 22: "BG BH DE GB GE IE ME RS", 23: "AE GI IL", 24: "AD CZ ES MD PK RO SA SE SK TN",
        25: "PT", 26: "IS TR", 27: "FR GR IT MC SM", 28: "AL AZ CY DO HU LB PL", 29: "BR QA UA",
        30: "JO KW", 31: "MT",
    }.items()
    for country in countries.split()
}


def _cuts(text: str, run: re.Match, least: int, most: int) -> list[int]:
    """Ends within a run, longest first, that leave ``least`` to ``most`` signs and end a word."""
    ends, signs = [], 0
    for at in range(run.start(), run.end()):
        signs += text[at] not in " -"
        if text[at] not in " -" and least <= signs <= most and not _WORD.match(text, at + 1):
            ends.append(at + 1)
    return ends[::-1]


def _candidates(text: str, start: int):
    """(kind, end) of what may be a value at ``start``, in the order of ``_KINDS``."""
    for kind, pattern in _OF_KIND.items():
        if kind == "card":
            if run := _CARD_RUN.match(text, start):
                yield from (("card", end) for end in _cuts(text, run, 13, 19))
        elif kind == "iban":
            if run := _IBAN_RUN.match(text, start):
                own = _IBAN_SIGNS.get(text[start : start + 2], 0)
                ends = _cuts(text, run, own, own) if own else []
                yield from (("iban", end) for end in [*ends, *_cuts(text, run, 15, 34)])
        elif match := pattern.match(text, start):
            yield kind, match.end()


def pseudonymize(
    docs: DataFrame, key: str, kinds: tuple[str, ...] = KINDS, counts: bool = True
) -> DataFrame:
    """Documents with pseudonyms in ``text``, and ``n_<kind>`` columns if wanted."""
    names = [f"n_{kind}" for kind in kinds] if counts else []

    def make(texts):
        worker = Pseudonymizer(key.encode(), kinds)
        done = [worker.text(None if text is None else text.decode()) for text in texts]
        columns = [[found.get(name[2:], 0) for _, found in done] for name in names]
        return [[text for text, _ in done], *columns]

    schema = ", ".join(["text string", *[f"{name} bigint" for name in names]])
    return with_text_columns(docs, schema, make)


def replace_in_place(docs: DataFrame, key: str, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """The documents with pseudonyms; a column ``n_chars`` follows its text."""
    plain, back = set_aside(docs, ("text", "n_chars"))
    out = pseudonymize(plain, key, kinds, counts=False)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.length("text").cast(kind)
        out = out.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))
    return out.select(*back)

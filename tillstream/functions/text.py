"""Expressions over raw line text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillstream.schema import LINE_COLUMNS, LINE_SCHEMA

# Stands for a separating comma; a line that holds it itself is escaped first.
_CUT, _ESCAPE = "\x00", "\x01"
# Text without commas but for those within quotes, and the comma behind it, each
# right after the one before. Nothing matched is given back: a line is read once,
# and a run of quotes is taken in a single step.
_UP_TO_COMMA = '\\G([^",]*+(?:(?:(?:"")++|"[^"]++")[^",]*+)*+),'
# The CSV parser fails the query beyond so many columns.
_PARSER_COLUMNS = 20_480

CORRUPT = "_corrupt"
# Numbers are read as text so that a bad one is data, not a parser error.
_CSV_DDL = ", ".join(f"{name} STRING" for name in LINE_COLUMNS) + f", {CORRUPT} STRING"
_CSV_OPTIONS = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "columnNameOfCorruptRecord": CORRUPT,
}


def csv_record(line: Column) -> Column:
    """Struct of the eight fields as text; ``_corrupt`` is set on a wrong field count.

    A line with more commas than the parser has columns never reaches it: its
    fields are split here and lose their outer quotes.
    """
    return F.when(is_wide(line), _wide_record(line)).otherwise(
        F.from_csv(line, _CSV_DDL, _CSV_OPTIONS)
    )


def is_wide(line: Column) -> Column:
    """Whether the CSV parser could meet more columns than it can hold."""
    least = _PARSER_COLUMNS - 1
    # most lines are too short for that many commas, and need no search
    before = F.substring_index(line, ",", least)
    return F.coalesce((F.length(line) >= least) & (before != line), F.lit(False))


def wide_fields(line: Column) -> Column:
    """The eight fields of a line that is too wide for the parser, as typed as a line's."""
    record = _wide_record(line)
    typed = {field.name: field.dataType for field in LINE_SCHEMA}
    return F.struct(
        *[record.getField(name).try_cast(typed[name]).alias(name) for name in LINE_COLUMNS]
    )


def _wide_record(line: Column) -> Column:
    def unquoted(field: Column) -> Column:
        plain = F.trim(field)
        quoted = plain.startswith('"') & plain.endswith('"') & (F.length(plain) > 1)
        inner = F.replace(
            F.substr(plain, F.lit(2), F.length(plain) - 2), F.lit('""'), F.lit('"')
        )
        return F.nullif(F.when(quoted, inner).otherwise(plain), F.lit(""))

    # In an array, so that the line is split once for its eight fields.
    records = F.transform(
        F.array(split_outside_quotes(line, len(LINE_COLUMNS) + 1)),
        lambda fields: F.struct(
            *[unquoted(F.get(fields, F.lit(i))).alias(n) for i, n in enumerate(LINE_COLUMNS)],
            F.when(F.size(fields) != len(LINE_COLUMNS), line).alias(CORRUPT),
        ),
    )
    return F.get(records, F.lit(0))


def whole_number(text: Column) -> Column:
    """INT from plain digits with an optional sign; anything else is NULL."""
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("int"))


def number(text: Column) -> Column:
    """DOUBLE from text; unparsable text is NULL and ``NaN`` stays NaN."""
    return text.try_cast("double")


def split_outside_quotes(line: Column, limit: int = -1) -> Column:
    """Fields as an array; quotes and blank fields are kept as they are.

    A comma separates fields if an even number of quotes follows it. Such commas
    are marked and the line is cut at the marks: one pass for each step, whatever
    the line holds. With a ``limit`` the array ends there, and its last item holds
    all that is left, its commas in no certain form.
    """
    plain = ~F.contains(line, F.lit(_CUT))
    return (
        F.when(~F.contains(line, F.lit('"')), F.split(line, ",", limit))
        .when(plain, _cut(line, limit))
        .otherwise(F.transform(_cut(_escaped(line), limit), _unescaped))
    )


def _cut(line: Column, limit: int) -> Column:
    """With pairs of quotes, a comma ends what lies before it if that is whole pairs.

    Of an odd number the first quote has none to pair with: no comma before it
    separates, and pairs are counted from behind it.
    """
    odd = F.length(F.regexp_replace(line, '[^"]++', "")) % 2 == 1
    # in an array, so that the quotes are counted once
    cut = F.transform(
        F.array(F.when(odd, F.instr(line, '"')).otherwise(0)),
        lambda single: F.split(
            F.concat(
                F.substr(line, F.lit(1), single),
                F.regexp_replace(F.substr(line, single + 1), _UP_TO_COMMA, "$1" + _CUT),
            ),
            _CUT,
            limit,
        ),
    )
    return F.get(cut, F.lit(0))


def _escaped(line: Column) -> Column:
    safe = F.replace(line, F.lit(_ESCAPE), F.lit(_ESCAPE + "e"))
    return F.replace(safe, F.lit(_CUT), F.lit(_ESCAPE + "c"))


def _unescaped(field: Column) -> Column:
    safe = F.replace(field, F.lit(_ESCAPE + "c"), F.lit(_CUT))
    return F.replace(safe, F.lit(_ESCAPE + "e"), F.lit(_ESCAPE))


def line_key(line: Column) -> Column:
    """Message key of a raw line: everything before its first comma."""
    return F.substring_index(line, ",", 1)


def argument_items(argument: Column, separator: str = ",") -> Column:
    """Array of the non-empty items of a separated argument string."""
    return F.filter(
        F.split(argument, "\\Q" + separator + "\\E"), lambda item: F.length(item) > 0
    )

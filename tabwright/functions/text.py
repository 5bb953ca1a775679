"""Text expressions: missing values, amounts, field joining, words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabwright.fixed_values import MISSING_TEXT, MISSING_TOKEN, WORD_SPACE

_SPACES = "".join(chr(code) for code in WORD_SPACE)


def fill_missing(
    text: Column,
    spellings: Sequence[str] = tuple(MISSING_TEXT),
    token: str = MISSING_TOKEN,
) -> Column:
    """The token in place of NULL and of any spelling of a missing value."""
    return F.coalesce(F.when(~text.isin(list(spellings)), text), F.lit(token))


def amount_scientific(value: Column) -> Column:
    """``sign=1| mant=1.2346| exponent=7`` for a double; NULL stays NULL.

    Put together from casts: ``format_string`` is several times slower.
    """
    size = F.nullif(F.abs(value), F.lit(0.0))
    exponent = F.floor(F.log10(size))
    scaled = F.rint(size / F.pow(F.lit(10.0), exponent.cast("double")) * F.lit(10_000.0))
    digits = scaled.try_cast("bigint").cast("string")
    mantissa = F.concat(
        F.substr(digits, F.lit(1), F.length(digits) - 4), F.lit("."), F.right(digits, F.lit(4))
    )
    return F.concat(
        F.lit("sign="),
        F.signum(value).cast("int").cast("string"),
        F.lit("| mant="),
        F.when(value == 0, F.lit("0.0000")).otherwise(mantissa),
        F.lit("| exponent="),
        F.coalesce(exponent, F.lit(0)).cast("string"),
    )


def join_fields(
    names: Sequence[str],
    values: Sequence[Column],
    separator: str,
    key_value_separator: str,
    with_names: bool,
) -> Column:
    """``name:value^ name:value``, or the values only. Values must not be NULL."""
    if with_names:
        values = [
            F.concat(F.lit(name + key_value_separator), value)
            for name, value in zip(names, values, strict=True)
        ]
    return F.concat_ws(separator, *values)


def words(text: Column) -> Column:
    """The words of the text; an empty or blank text has none.

    Every separator becomes a space and the text is split at single spaces, which needs
    no regular expression.
    """
    plain = F.translate(text, _SPACES, " " * len(_SPACES))
    return F.array_remove(F.split(plain, " "), F.lit(""))


def word_count(text: Column) -> Column:
    """How many words a text has, ``size(words(text))``.

    Where words are parted by single spaces and all signs are ASCII, which most written rows
    are, the spaces are counted; that takes a fraction of the time of making the words.
    """
    trimmed = F.btrim(text)
    plain = F.octet_length(text) == F.length(text)
    for sign in ["  ", *[s for s in _SPACES if s.isascii() and s != " "]]:
        plain = plain & ~F.contains(trimmed, F.lit(sign))
    spaces = F.length(trimmed) - F.length(F.replace(trimmed, F.lit(" "), F.lit("")))
    return (
        F.when(text.isNull() | ~plain, F.size(words(text)))
        .when(F.length(trimmed) == 0, 0)
        .otherwise(spaces + 1)
    )

"""Phone number text: cleaning, join keys and origin."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ringlens.constants import COUNTRY_CODES, LANDLINE_AREAS, MOBILE_CODES

# A raw number of which 4 to 18 digits are left once + and 84 are stripped.
DIALABLE = r"^\+?(?:84[0-9]{4,18}|(?!84)[0-9]{4,18})\z"
BLANKS = " \t\n\r\x0b\x0c"


def stripped(col: Column) -> Column:
    """Text without surrounding white space; '' for NULL."""
    return F.btrim(F.coalesce(col.cast("string"), F.lit("")), F.lit(BLANKS))


def tail_from(text: Column, position: int) -> Column:
    """The text from a position on, however long it is."""
    return F.substring(text, F.lit(position), F.length(text))


def strip_country(col: Column) -> Column:
    """Without a leading ``+`` and then without one leading ``84``; substrings, as regexes cost more per row."""

    def without(text: Column, head: str) -> Column:
        return F.when(text.startswith(head), tail_from(text, len(head) + 1)).otherwise(text)

    return without(without(col.cast("string"), "+"), "84")


def join_key(col: Column) -> Column:
    """Digits without leading zeros; '' for missing or blank text, '0' when nothing is left."""
    text = stripped(col)
    digits = F.ltrim(F.regexp_replace(text, r"\D+", ""), F.lit("0"))
    return F.when(text == "", F.lit("")).when(digits == "", F.lit("0")).otherwise(digits)


def country_code(digits: Column) -> Column:
    """Longest listed calling code that starts ``digits``, else its first three digits."""
    found = [
        F.when(F.substring(digits, 1, size).isin([c for c in COUNTRY_CODES if len(c) == size]),
               F.substring(digits, 1, size))
        for size in (3, 2, 1)
    ]
    return F.coalesce(*found, F.substring(digits, 1, 3))


def phone_origin(phone: Column) -> Column:
    """STRUCT<is_international BOOLEAN, prefix STRING> of a raw phone number.

    Numbers that start with neither 0, 84 nor + are read as foreign numbers.
    """
    digits = F.regexp_replace(stripped(phone), r"[^0-9]", "")
    national = F.when(digits.startswith("84"), F.concat(F.lit("0"), tail_from(digits, 3))).when(
        digits.startswith("0"), digits
    )
    areas3 = [a for a in LANDLINE_AREAS if len(a) == 3]
    areas2 = [a for a in LANDLINE_AREAS if len(a) == 2]

    def origin(international: bool, prefix: Column) -> Column:
        return F.struct(F.lit(international).alias("is_international"), prefix.alias("prefix"))

    return (
        F.when(F.length(digits) <= 5, origin(False, digits))
        .when(F.substring(national, 2, 2).isin(MOBILE_CODES), origin(False, F.substring(national, 1, 3)))
        .when(F.substring(national, 2, 3).isin(areas3), origin(False, F.substring(national, 1, 4)))
        .when(F.substring(national, 2, 2).isin(areas2), origin(False, F.substring(national, 1, 3)))
        .when(digits.startswith("00"), origin(True, country_code(tail_from(digits, 3))))
        .otherwise(origin(True, country_code(digits)))
    )

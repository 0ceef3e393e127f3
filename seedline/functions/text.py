"""Text expressions. All are built-in column expressions; nothing leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import (
    CLUB_SPELLINGS,
    CLUBS_MEANING_NONE,
    GENDER_CODES,
    GRADE_NUMBERS,
    GRADE_WORDS,
)

NBSP = chr(0xA0)
# what counts as white space when stripping text
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85" + "".join(
    chr(code)
    for code in [0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def strip(c: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(c, F.lit(WHITESPACE))


def clean_name(c: Column) -> Column:
    """Hard spaces to blanks, trimmed, runs of blanks collapsed, asterisks dropped.

    Trimmed once more at the end: a trailing asterisk would otherwise leave a blank behind
    that changes the hashed athlete id.
    """
    blanks = strip(F.replace(c, F.lit(NBSP), F.lit(" ")))
    return strip(F.replace(F.regexp_replace(blanks, " +", " "), F.lit("*"), F.lit("")))


def title_case(c: Column) -> Column:
    """Capital after every non-letter (``O'Brien``), which ``initcap`` alone does not give."""
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda run: F.initcap(run)), "")


def full_name(first: Column, last: Column) -> Column:
    """First and last name in title case; a missing part is left out."""
    return title_case(F.concat_ws(" ", first, last))


def school_or_other(school: Column, other: Column) -> Column:
    return title_case(F.when(school.eqNullSafe("Other"), other).otherwise(school))


def to_number(c: Column) -> Column:
    """Plain decimal text to double, anything else (``1d``, ``NaN``, ``inf``) to NULL."""
    return F.when(c.rlike(NUMBER), F.trim(c).try_cast("double"))


def to_whole_number(c: Column) -> Column:
    value = c.cast("string")
    number = to_number(value)
    # digits alone first: a double holds whole numbers only up to 2^53
    return F.when(number == F.floor(number), F.coalesce(F.trim(value).try_cast("bigint"), number.try_cast("bigint")))


def parse_grade(c: Column) -> Column:
    """Grade 7 to 12 when the text contains the number, else by keyword."""
    compact = F.regexp_replace(F.lower(c), "[^a-z0-9]", "")
    grade = F.when(F.lit(False), F.lit(None).cast("bigint"))
    for number in GRADE_NUMBERS:
        grade = grade.when(F.contains(c, F.lit(str(number))), F.lit(number))
    for word, number in GRADE_WORDS.items():
        grade = grade.when(F.contains(compact, F.lit(word)), F.lit(number))
    return grade.cast("bigint")


def gender_code(c: Column) -> Column:
    lowered = F.lower(c)
    code = F.when(F.lit(False), lowered)
    for text, letter in GENDER_CODES.items():
        code = code.when(lowered == text, F.lit(letter))
    return code.otherwise(lowered)


def club_name(c: Column) -> Column:
    name = F.when(c.isin(CLUBS_MEANING_NONE), F.lit(None).cast("string"))
    for text, short in CLUB_SPELLINGS.items():
        name = name.when(c == text, F.lit(short))
    return name.otherwise(c)


def short_hash(first: Column, second: Column) -> Column:
    """First 12 hex digits of SHA-256 over ``"first,second"``; a missing part hashes as empty."""
    parts = [F.coalesce(part.cast("string"), F.lit("")) for part in (first, second)]
    return F.substring(F.sha2(F.concat(parts[0], F.lit(","), parts[1]), 256), 1, 12)

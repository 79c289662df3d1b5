"""Text rules: blanks, names, countries, phones, emails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

UNKNOWN = "Unknown"

# Country spellings (lower case) and the name they stand for.
COUNTRY_SPELLINGS = {
    "usa": "United States",
    "us": "United States",
    "united states": "United States",
    "u.k.": "United Kingdom",
    "england": "United Kingdom",
    "canada": "Canada",
    "can": "Canada",
}

# Every character that Unicode counts as white space, plus the four ASCII
# separators. Java's \s covers ASCII only, hence the explicit list.
SPACES = r"\t-\r\x1c-\x1f\x85\p{Z}"
# Fixed value: one @, a dot after it, no inner white space. Outer white space is allowed.
EMAIL = rf"^[{SPACES}]*[^@{SPACES}]+@[^@{SPACES}]+\.[^@{SPACES}]+[{SPACES}]*$"
# The same for plain ASCII without outer white space; far cheaper, and fits nearly all values.
ASCII_EMAIL = r"^[!-?A-~]+@[!-?A-~]+\.[!-?A-~]+$"
# Three, three and four digits, with a country code or not, that stand alone: addresses and card numbers do not fit.
PHONE_TOKEN = (
    r"(?<![0-9A-Za-z.()+-])(?:\+?[0-9]{1,3}[ .-])?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-]?)[0-9]{3}[ .-]?[0-9]{4}"
    r"(?![0-9A-Za-z()+-]|\.[0-9A-Za-z])"
)


def is_blank(c: Column) -> Column:
    """Null, empty or only spaces (a tab is not a space here)."""
    return c.isNull() | (F.trim(c) == "")


def fill_name(c: Column) -> Column:
    """``Unknown`` for a blank name; any other name as it is, outer spaces included."""
    return F.when(is_blank(c), UNKNOWN).otherwise(c)


def normalise_country(c: Column) -> Column:
    """Canonical country name; an unlisted spelling is kept, trimmed; blank becomes ``Unknown``."""
    trimmed = F.trim(c)
    spellings = F.create_map(*(F.lit(text) for pair in COUNTRY_SPELLINGS.items() for text in pair))
    return F.coalesce(
        F.try_element_at(spellings, F.lower(trimmed)), F.nullif(trimmed, F.lit("")), F.lit(UNKNOWN)
    )


def normalise_phone(c: Column) -> Column:
    """``XXX-XXX-XXXX`` if the text holds exactly ten digits (of any script), else null.

    Grouping comes before the length check: Spark then strips the text once,
    while an expression used only inside the branch is evaluated at each use.
    """
    digits = F.regexp_replace(c.cast("string"), r"\P{Nd}", "")
    grouped = F.concat_ws("-", F.substring(digits, 1, 3), F.substring(digits, 4, 3), F.substr(digits, F.lit(7)))
    return F.when(F.length(grouped) == len("XXX-XXX-XXXX"), grouped)


def is_valid_email(c: Column) -> Column:
    """Shape check on the value without its outer white space; null counts as invalid."""
    return F.coalesce(c.rlike(ASCII_EMAIL) | c.rlike(EMAIL), F.lit(False))


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim all string columns in a single projection."""
    return df.select(
        *(
            F.trim(df[f.name]).alias(f.name) if isinstance(f.dataType, StringType) else df[f.name]
            for f in df.schema.fields
        )
    )


def words_with_at(text: Column) -> Column:
    """Array of the words of a text that contain an ``@``. One linear split, no backtracking search."""
    return F.filter(F.split(text, f"[{SPACES}]+"), lambda word: word.contains("@"))


def phone_tokens(text: Column) -> Column:
    """Array of the phone numbers in a text, by their shape."""
    return F.regexp_extract_all(text, F.lit(PHONE_TOKEN), F.lit(0))

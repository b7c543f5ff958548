"""Names, dates and clean text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from litscreen import settings

# The blanks and the characters that make up a word.
BLANKS = (
    " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
NOT_WORD = r"[^\p{L}\p{M}\p{N}]+"
TOKEN = r"[\p{L}\p{M}\p{N}]+|[^\s\x0B\x1C-\x1F\x85\p{Z}\p{L}\p{M}\p{N}]"


def strip(text: Column) -> Column:
    """Drop blanks at both ends, line breaks and no-break spaces included."""
    return F.btrim(text, F.lit(BLANKS))


def folder_name(query: Column, length: int = settings.NAME_LENGTH) -> Column:
    """The start of a query in a form that can name a folder."""
    legal = F.regexp_replace(F.replace(query, F.lit(" "), F.lit("_")), settings.FORBIDDEN_NAME_CHARS, "")
    return F.substring(legal, 1, length)


def short_hash(text: Column, digits: int = settings.HASH_DIGITS) -> Column:
    """The first digits of the MD5 of a text."""
    return F.substring(F.md5(text), 1, digits)


def query_key(query: Column) -> Column:
    """Readable start and short hash: names a query and its folder."""
    return F.concat_ws("_", folder_name(query), short_hash(query))


def long_folder_name(query: Column) -> Column:
    """A folder name of any length, without the parts in brackets and with single ``_``."""
    outside = F.regexp_replace(query, settings.BRACKETED_PARTS, "")
    legal = F.regexp_replace(F.replace(outside, F.lit(" "), F.lit("_")), settings.FORBIDDEN_NAME_CHARS, "")
    return F.regexp_replace(F.regexp_replace(legal, "_+", "_"), r"\A_|_\z", "")


def reformat_date(
    text: Column,
    source: str = settings.STORED_DATE,
    target: str = settings.SEARCHED_DATE,
    strict: bool = True,
) -> Column:
    """Write a date in another form. A wrong date stops the job, or gives NULL if not strict."""
    day = F.try_to_date(text, source)
    if strict:
        refused = F.raise_error(F.concat(F.lit("not a date: "), text)).cast("date")
        day = F.when(text.isNotNull() & day.isNull(), refused).otherwise(day)
    return F.date_format(day, target)


def search_text(query: Column, mode: Column, since: Column, until: Column) -> Column:
    """What is searched for: the bare query, or the query with its range of dates."""
    dated = F.format_string(
        settings.DATED_SEARCH,
        query,
        F.date_format(since, settings.SEARCHED_DATE),
        F.date_format(until, settings.SEARCHED_DATE),
    )
    return F.when(mode == "FULL", query).when(mode == "INCREMENTAL", dated)


def without_quotes(text: Column) -> Column:
    """Delete every double quote."""
    return F.replace(text, F.lit('"'), F.lit(""))


def clean_id(value: Column) -> Column:
    """An ID as a string, without quote marks and outer blanks."""
    return strip(without_quotes(value.cast("string")))


def one_line(text: Column) -> Column:
    """Strip the lines, drop the empty ones and join the rest by one space."""
    lines = F.transform(F.split(text, r"[\r\n]+"), strip)
    return F.array_join(F.filter(lines, lambda line: line != ""), " ")


def words(text: Column) -> Column:
    """The text as words in lower case with one space around each: `` w1 w2 w3 ``."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), NOT_WORD, " ")), F.lit(" "))


def tokens(text: Column) -> Column:
    """Words in lower case, and every other visible character by itself."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))

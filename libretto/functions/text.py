"""Small text functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A letter, digit or underscore of any script, for engines whose \w is ASCII.
W = r"[\p{L}\p{N}_]"
WORDS = rf"{W}+(?:['’]{W}+)*"


def cleaned(text: Column) -> Column:
    """White space collapsed and trimmed; a space between a currency sign and a letter."""
    flat = F.trim(F.regexp_replace(text, F.lit(r"(?U)\s+"), F.lit(" ")))
    return F.regexp_replace(flat, F.lit(r"([€$£])(?=\p{L})"), F.lit("$1 "))


def tidied(text: Column) -> Column:
    """Runs of spaces and line breaks become one space, none stands before punctuation."""
    flat = F.regexp_replace(text, F.lit(r"[ \t\r\n]+"), F.lit(" "))
    return F.trim(F.regexp_replace(flat, F.lit(r" +([.,;:!?])"), F.lit("$1")))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORDS))


def speech_ms(words: Column, per_minute: int = 150) -> Column:
    """Estimated time to speak so many words, half-even."""
    return F.bround(words * F.lit(60_000) / F.lit(per_minute)).cast("long")


def clock(ms: Column) -> Column:
    """HH:MM:SS.mmm"""
    s = F.floor(ms / 1000)
    return F.format_string("%02d:%02d:%02d.%03d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60, F.pmod(ms, F.lit(1000)))


def kebab(name: Column) -> Column:
    return F.lower(F.regexp_replace(name, F.lit("(?<!^)(?=[A-Z])"), F.lit("-")))


def preview(text: Column, most: int = 120) -> Column:
    """At most so many characters, the last three then being dots."""
    return F.when(F.length(text) <= most, text).otherwise(F.concat(F.left(text, F.lit(most - 3)), F.lit("...")))


def is_references(heading: Column) -> Column:
    """A heading of a bibliography, in one of the fixed wordings."""
    flat = F.trim(F.regexp_replace(F.lower(heading), F.lit(r"[^\p{L}]+"), F.lit(" ")))
    return flat.isin("bibliografia", "bibliography", "references", "riferimenti")


def letters_of(number: Column) -> Column:
    """1 -> A, 26 -> Z, 27 -> AA: appendix letters, up to three of them."""
    n = number - 1
    letter = lambda x: F.char(F.lit(65) + x % 26)
    two, three = F.floor(n / 26) - 1, F.floor((F.floor(n / 26) - 1) / 26) - 1
    return F.concat(F.when(three >= 0, letter(three)).otherwise(""), F.when(two >= 0, letter(two)).otherwise(""), letter(n))


def unresolved(text: Column) -> Column:
    """The distinct symbols that speech text must not hold, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(r"[<>@#%€$£]"), F.lit(0))))


def comparable(text: Column) -> Column:
    """Text as compared with a transcript: lower case, one apostrophe, no other punctuation, white space collapsed.

    Native; accents stay. functions.metrics.comparable() also folds case fully and drops accents.
    """
    low = F.translate(F.lower(text), "’‘ʼ`´＇", "''''''")
    return F.trim(F.regexp_replace(F.regexp_replace(low, F.lit(r"[\p{P}&&[^']]"), F.lit(" ")), F.lit(r"\s+"), F.lit(" ")))


def percentile_nearest(values: Column, percent: int) -> Column:
    """The element at index ceil((n - 1) * percent / 100) of an array, sorted."""
    at = F.floor(((F.size(values) - 1) * percent + 99) / 100).cast("int")
    return F.when(F.size(values) > 0, F.get(F.array_sort(values), at))

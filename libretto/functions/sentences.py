"""Sentences, limit splitting and packing."""

from __future__ import annotations

import re
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Abbreviations that end no sentence, longest first where they are used.
ABBREVIATIONS = "dott. dott.ssa. prof. prof.ssa. sig. sig.ra. sig.na. ecc. es. art. n. cap. pag. sec. ca. vs.".split()
#: Stands for the full stop of an abbreviation or initial while a text is split.
HELD = "\ue000"
#: Stands between sentences.
CUT = "\ue001"


def sentences(text: Column, at_colons: bool = False) -> Column:
    """Array of the text's sentences, trimmed; native expressions only.

    A text ends a sentence at . ! ? (and : if asked) before white space. Abbreviations protect their
    stops wherever their letters stand, also at the end of a longer word, and come back in lower
    case; so do single capitals before a capital.
    """
    stems = "|".join(re.escape(a[:-1]) for a in sorted(ABBREVIATIONS, key=len, reverse=True))
    marked = F.split(F.regexp_replace(text, F.lit(rf"(?iu)(?=.{{1,8}}\.)({stems})\."), F.lit(CUT + "$1" + HELD)), CUT)
    low = lambda stem: F.translate(F.lower(stem), ".ſ", HELD + "s")
    piece = lambda p, i: F.when(i == 0, p).otherwise(F.concat(low(F.substring_index(p, HELD, 1)), F.substring(p, F.length(F.substring_index(p, HELD, 1)) + 1, F.length(p))))
    t = F.array_join(F.transform(marked, piece), "")
    t = F.regexp_replace(t, F.lit(r"(?<![\p{L}\p{N}_])(\p{Lu})\.(?=\s+\p{Lu})"), F.lit("$1" + HELD))
    ends = "[.!?:]" if at_colons else "[.!?]"
    parts = F.split(F.regexp_replace(t, F.lit(rf"({ends})\s+"), F.lit("$1" + CUT)), CUT)
    parts = F.transform(parts, lambda s: F.trim(F.translate(s, HELD, ".")))
    return F.filter(parts, lambda s: s != "")


def rows_of(df: DataFrame, column: Column | str, *keep: Column | str, pos: str = "i", value: str = "sentence") -> DataFrame:
    """A row an element of an array column, with its position. An inner explode would have the optimizer put a filter on the
    array's size below, which computes the array again; the outer one with a filter behind it doesn't."""
    return df.select(*keep, F.posexplode_outer(column).alias(pos, value)).where(F.col(pos).isNotNull())


#: A sign that may end a part, with the blanks behind it; a comma binds more than the others.
_SIGN = re.compile(r"([;,:])(?:\s+|$)")


def cut_at(text: str, limit: int) -> int:
    """Where a text longer than limit is cut: behind a sign and its blanks, else at the last blank; ValueError if neither is there.

    A sign counts if it stands, blanks included, within the limit. Where one cut leaves two parts of
    at least a quarter of the limit, the second within the limit too, the strongest sign wins (; and
    : before ,), then the one nearest the middle; else the last sign.
    """
    signs = [(m.end(), m[1] == ",") for m in _SIGN.finditer(text, 0, limit + 1) if m.end() <= limit]
    least = max(1, limit // 4)
    halves = [(weak, abs(2 * end - len(text)), end) for end, weak in signs if end >= least and least <= len(text) - end <= limit]
    if halves:
        return min(halves)[2]
    if signs:
        return signs[-1][0]
    if (at := text.rfind(" ", 0, limit + 1)) > 0:
        return at
    raise ValueError(f"cannot split within {limit} characters: {text[:40]}")


def limited(sentence: str, limit: int) -> list[str]:
    """Parts of at most `limit` characters, by cut_at."""
    if limit < 1:
        raise ValueError("the limit must be positive")
    out, rest = [], sentence.strip()
    while len(rest) > limit:
        at = cut_at(rest, limit)
        out.append(rest[:at].strip())
        rest = rest[at:].strip()
    return [*out, rest] if rest else out


_LONG, _CUTS = "__long", "__cuts"


def limit_split(df: DataFrame, column: str, limit: int, out: str = "parts") -> DataFrame:
    """df with `out`: for each sentence of the array column its parts (array of arrays).

    Only sentences beyond the limit cross to Python, each once a row.
    """
    long = F.array_distinct(F.filter(column, lambda s: F.length(s) > limit))

    @F.arrow_udf(ArrayType(ArrayType(StringType())))
    def cut(sentences: pa.Array) -> pa.Array:
        return pa.array([row and [limited(s, limit) for s in row] for row in sentences.to_pylist()], pa.list_(pa.list_(pa.string())))

    found = df.withColumn(_LONG, long).withColumn(_CUTS, cut(_LONG))
    found = found.withColumn(_CUTS, F.map_from_arrays(_LONG, _CUTS))
    return found.withColumn(out, F.transform(column, lambda s: F.coalesce(F.try_element_at(_CUTS, s), F.array(s)))).drop(_LONG, _CUTS)


def packed(parts: Column, limit: int) -> Column:
    """Neighbouring sentences joined by a space as long as they stay within the limit: array of (text, first, last)."""
    kind = "array<struct<text:string,first:int,last:int>>"

    def step(done: Column, s: Column) -> Column:
        fits = (F.size(done) > 0) & (F.length(F.try_element_at(done, F.lit(-1))["text"]) + 1 + F.length(s["s"]) <= limit)
        held = F.try_element_at(done, F.lit(-1))
        joined = F.concat(F.slice(done, 1, F.greatest(F.lit(0), F.size(done) - 1)), F.array(F.struct(F.concat(held["text"], F.lit(" "), s["s"]).alias("text"), held["first"].alias("first"), s["i"].alias("last"))))
        alone = F.concat(done, F.array(F.struct(s["s"].alias("text"), s["i"].alias("first"), s["i"].alias("last"))))
        return F.when(fits, joined).otherwise(alone).cast(kind)

    numbered = F.transform(parts, lambda s, i: F.struct(s.alias("s"), i.cast("int").alias("i")))
    return F.aggregate(numbered, F.array().cast(kind), step)

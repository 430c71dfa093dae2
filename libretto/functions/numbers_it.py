"""Italian cardinals, ordinals and decimals as words, from rules of composition."""

from __future__ import annotations

import re

# The names that all others are composed of.
UNITS = "zero uno due tre quattro cinque sei sette otto nove dieci undici dodici tredici quattordici quindici sedici diciassette diciotto diciannove".split()
TENS = "venti trenta quaranta cinquanta sessanta settanta ottanta novanta".split()
FIRST_ORDINALS = "zeresimo primo secondo terzo quarto quinto sesto settimo ottavo nono decimo".split()
SCALES = ((10**12, "bilione", "bilioni"), (10**9, "miliardo", "miliardi"), (10**6, "milione", "milioni"))


def _joined(a: str, b: str) -> str:
    """Two parts of one word; a final vowel gives way to the first of uno and otto (ottanta)."""
    if b.startswith(("uno", "ott")) and a[-1:] in "aio" and a != "":
        return a[:-1] + b
    return a + b


def _small(n: int) -> str:
    if n < 20:
        return UNITS[n]
    if n < 100:
        return _joined(TENS[n // 10 - 2], UNITS[n % 10] if n % 10 else "")
    if n < 1000:
        head = ("" if n < 200 else UNITS[n // 100]) + "cento"
        rest = n % 100
        if not rest:
            return head
        # cento keeps its vowel before uno, but not before otto
        return _joined(head, _small(rest)) if not _small(rest).startswith("u") else head + _small(rest)
    head = "mille" if n < 2000 else _small(n // 1000) + "mila"
    return head + (_small(n % 1000) if n % 1000 else "")


def cardinal(n: int) -> str:
    if n < 0:
        return "meno " + cardinal(-n)
    parts = []
    for value, one, many in SCALES:
        if count := n // value:
            parts.append(f"un {one}" if count == 1 else f"{cardinal(count)} {many}")
            n %= value
    if n or not parts:
        word = _small(n)
        parts.append(word[:-1] + "é" if word.endswith("tre") and word != "tre" else word)
    return " ".join(parts)


def ordinal(n: int) -> str:
    if n < len(FIRST_ORDINALS):
        return FIRST_ORDINALS[n]
    word = cardinal(n)
    if word.endswith("mila"):
        return word[:-4] + "millesimo"
    if word.endswith("tré"):
        return word[:-1] + "eesimo"
    return (word if word.endswith("sei") and n % 100 != 16 and n > 6 else word[:-1]) + "esimo"


# Fixed value: how numbers are written. Digits with thousands dots and a decimal comma, a comma or a dot decimal, or plain digits.
NUMBER = r"-?(?:\d{1,3}(?:\.\d{3})+(?:,\d+)?|\d+,\d+|\d+\.\d+|\d+)"


def parsed(token: str) -> tuple[bool, str, str]:
    """(negative, whole digits, fraction digits) of a NUMBER."""
    negative, body = token.startswith("-"), token.lstrip("-")
    if "," in body:
        whole, _, fraction = body.replace(".", "").partition(",")
    elif re.fullmatch(r"\d{1,3}(?:\.\d{3})+", body):
        whole, fraction = body.replace(".", ""), ""
    else:
        whole, _, fraction = body.partition(".")
    return negative, whole, fraction


def words(token: str) -> str:
    """A NUMBER in words: leading zeros of the fraction one by one, the rest as one number; zeros at its end are not said."""
    negative, whole, fraction = parsed(token)
    fraction = fraction.rstrip("0")
    out = cardinal(int(whole))
    if fraction:
        rest = fraction.lstrip("0")
        tail = ["zero"] * (len(fraction) - len(rest)) + ([cardinal(int(rest))] if rest else [])
        out += " virgola " + " ".join(tail)
    return "meno " + out if negative and (int(whole) or fraction) else out

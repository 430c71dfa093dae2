"""The ordered chain that turns written Italian into speech text, and its audit trail.

Rules are data. A rule is a list of (notation, speech) lines: the notation is a regular expression
with typed slots such as <a:number>, the speech is a template that names how each slot is said, as
in "{a:number} per cento". One engine compiles and applies them all, so a rule holds no code; what
there is to say lives in SPEAKERS. The order of RULES is part of the contract. Each rule that
changes the text is recorded with the text before and after.

A native filter (touched) finds the texts that any rule could change. Only those cross to Python, in
Arrow batches; the others are answered by Catalyst.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from libretto.functions.numbers_it import NUMBER, TENS, UNITS, cardinal, ordinal, parsed, words
from libretto.sources.lexicons import BUILT_IN, Entry, compiled

# The names of letters, months, currencies and sections, and the words for signs.
LETTERS = {
    "a": "a", "b": "bi", "c": "ci", "d": "di", "e": "e", "f": "effe", "g": "gi", "h": "acca", "i": "i", "j": "i lunga", "k": "cappa", "l": "elle", "m": "emme",
    "n": "enne", "o": "o", "p": "pi", "q": "cu", "r": "erre", "s": "esse", "t": "ti", "u": "u", "v": "vi", "w": "doppia vu", "x": "ics", "y": "ipsilon", "z": "zeta",
}
MONTHS = ("gennaio", "febbraio", "marzo", "aprile", "maggio", "giugno", "luglio", "agosto", "settembre", "ottobre", "novembre", "dicembre")
CURRENCIES = {"€": ("euro", "euro"), "$": ("dollaro", "dollari"), "£": ("sterlina", "sterline")}
SECTIONS = {"cap.": "capitolo", "capitolo": "capitolo", "sez.": "sezione", "sezione": "sezione", "par.": "paragrafo", "§": "paragrafo", "appendice": "appendice"}
SIGNS = {"&": "e", "+": "più", "=": "uguale a", "€": "euro", "$": "dollari", "£": "sterline"}

#: What a slot <name:kind> in a notation stands for.
SLOTS = {
    "number": NUMBER,
    "amount": NUMBER.removeprefix("-?"),
    "currency": "[€$£]",
    "letter": "[A-Za-z]",
    "symbol": r"[A-Za-z]|\d+",
    "day": "0?[1-9]|[12][0-9]|3[01]",
    "month": "0?[1-9]|1[0-2]",
    "year": r"\d{4}",
    "digits": r"\d+",
    "decimal": r"-?\d+[,.]\d+",
    "whole": r"-?\d+",
    "ratio": r"-?\d+(?:\s*/\s*-?\d+){1,2}",
    "label": "|".join(re.escape(s) for s in SECTIONS),
    "path": r"(?:[A-Za-z]|\d+)(?:\.\d+)*",
    "inner": "[^{}]*",
    "filled": "[^{}]+",
    "capitals": "[A-Z]{2,6}",
    "sign": "[" + re.escape("".join(SIGNS)) + "]",
    "stem": "(?:" + "|".join(sorted({*UNITS[1:], "un", "tré", "mille", "mila", *(f"{t[:-1]}{t[-1]}?" for t in [*TENS, "cento"])}, key=len, reverse=True)) + ")*(?:" + "|".join(t[:-1] for t in [*TENS, "cento"]) + ")",
}


def _money(amount: str, sign: str) -> str:
    negative, whole, fraction = parsed(amount)
    cents = int((fraction + "00")[:2])
    said = f"{'meno ' if negative and int(whole) else ''}{cardinal(int(whole))} {_unit(amount, sign)}"
    return said if not cents else f"{said} e {cardinal(cents)} {'centesimo' if cents == 1 else 'centesimi'}"


def _unit(amount: str, sign: str) -> str:
    _, whole, fraction = parsed(amount)
    one, many = CURRENCIES[sign]
    return many if int(whole) != 1 or fraction.strip("0") else one


def _part(token: str) -> str:
    return cardinal(int(token)) if token.isdigit() else LETTERS[token.lower()]


#: How a slot's text is said.
SPEAKERS: dict[str, Callable[..., str]] = {
    "as it is": str,
    "number": words,
    "cardinal": lambda t: cardinal(int(t)),
    "letter": lambda t: LETTERS[t.lower()],
    "symbol": lambda t: LETTERS.get(t.lower(), t),
    "raised": lambda t: f"alla {LETTERS[t.lower()]}" if t.lower() in LETTERS else f"a {t}",
    "day": lambda t: "primo" if int(t) == 1 else cardinal(int(t)),
    "month": lambda t: MONTHS[int(t) - 1],
    "unit": _unit,
    "money": _money,
    "ratio": lambda t: " a ".join(words(x.strip()) for x in t.split("/")),
    "masculine": lambda t: ordinal(int(t)),
    "feminine": lambda t: re.sub("o$", "a", ordinal(int(t))),
    "label": lambda t: SECTIONS[t.lower()],
    "path": lambda t: " punto ".join(_part(x) for x in t.split(".")),
    "spelled": lambda t: " ".join(LETTERS[c.lower()] for c in t),
    "sign": lambda t: SIGNS[t],
}

_OUT, _IN = r"(?<!\w)", r"(?!\w)"
_TO = r"\s*(?:--|[–—-])\s*"
_END = "(?![A-Za-z])"
_BRACED = r"(?P<brace>\{)?<v:symbol>(?(brace)\}|(?!\w))"

EQUATION_ONLY = ("equation-fraction", "equation-operators", "equation-identifiers")
LEXICON, UNICODE = "lexicon", "unicode-cleanup"
#: Rules in their order: (id, lines of notation and speech). LEXICON stands for the user's entries.
RULES: tuple[tuple[str, tuple[tuple[str, str], ...]], ...] = (
    (UNICODE, (("\u00ad", ""), ("[\u00a0\u202f]", " "), ("…", "..."))),
    ("dehyphenation", ((r"(?<=\w)-[ \t]*\n[ \t]*(?=\w)", ""),)),
    ("latex-cleanup", (
        (r"\\(?:begin|end)\s*\{equation\*?\}", " "), (r"\\label\s*\{<a:inner>\}", " "), (r"\\text\s*\{<a:inner>\}", "{a}"),
        (r"(?<=\d)\{,\}(?=\d)", ","), (rf"\\q?quad{_END}", " "), (r"\\[,;:!]", ""),
    )),
    ("latex-operator", (
        (rf"\\(?:times|cdot){_END}|[×·]", " per "), (rf"\\div{_END}|÷", " diviso "), (rf"\\approx{_END}|≈", " circa uguale a "),
        (rf"\\(?:rightarrow|to){_END}|→", " porta a "), (rf"\\euro{_END}", " € "), (r"\\%", "%"),
    )),
    ("latex-script", (
        (rf"{_OUT}<b:letter>_{_BRACED}", "{b:letter} con pedice {v:symbol}"), (rf"{_OUT}<b:letter>\^{_BRACED}", "{b:letter} elevato alla {v:symbol}"),
        (rf"\^{_BRACED}", " elevato {v:raised}"),
    )),
    ("equation-fraction", ((r"\\frac\s*\{<a:filled>\}\s*\{<b:filled>\}", "{a} diviso {b}"),)),
    ("equation-operators", ((r"\\(?:times|cdot)|[×·*]", " per "), (r"\\div|[÷/]", " diviso "), ("=", " uguale a "), (r"\+", " più "), (r"(?<!\d)-(?!\d)", " meno "))),
    ("equation-identifiers", ((rf"(?<![\w\\])<a:letter>{_IN}", "{a:letter}"),)),
    ("date", ((r"(?<![\w/])<d:day>/<m:month>/<y:year>(?![\w/])", "{d:day} {m:month} {y:cardinal}"),)),
    ("section-reference", ((rf"(?i:{_OUT}<a:label>\s*<b:path>){_IN}", "{a:label} {b:path}"),)),
    ("currency-range", ((rf"(?<![\w/])<a:number>{_TO}<b:amount>\s*<c:currency>", "{a:number} a {b:number} {b,c:unit}"),)),
    ("percentage-range", ((rf"(?<![\w/])<a:number>{_TO}<b:amount>\s*%", "{a:number} a {b:number} per cento"),)),
    ("range", ((rf"(?<![\w/])<a:number>{_TO}<b:amount>(?![\w/])", "{a:number} a {b:number}"),)),
    ("percentage", ((rf"{_OUT}<a:number>\s*%", "{a:number} per cento"),)),
    ("currency", ((rf"{_OUT}<a:number>\s*<c:currency>", "{a,c:money}"), (rf"<c:currency>\s*<a:number>{_IN}", "{a,c:money}"))),
    ("ratio", ((r"(?<![\d/])<a:ratio>(?![\d/])", "{a:ratio}"),)),
    ("ordinal", ((rf"{_OUT}<a:digits>[º°]{_IN}", "{a:masculine}"), (rf"{_OUT}<a:digits>ª{_IN}", "{a:feminine}"))),
    ("abbreviation", (
        (rf"(?i){_OUT}ecc\.{_IN}", "eccetera"), (rf"(?i){_OUT}dott\.{_IN}", "dottor"), (rf"(?i){_OUT}prof\.{_IN}", "professor"),
        (rf"(?i){_OUT}art\.(?=\s*\d)", "articolo "), (rf"(?i){_OUT}n\.(?=\s*\d)", "numero "),
    )),
    ("symbol", (("<a:sign>", " {a:sign} "),)),
    ("decimal", ((rf"{_OUT}<a:decimal>{_IN}", "{a:number}"),)),
    ("integer", ((r"(?<![\w.,])<a:whole>(?![\w.,])", "{a:number}"),)),
    ("anni-elision", ((rf"(?i){_OUT}<a:stem>[aio] anni{_IN}", "{a}’anni"),)),
    (LEXICON, ()),
    ("acronym", ((rf"{_OUT}<a:capitals>{_IN}", "{a:spelled}"),)),
    ("whitespace", ((r"[\t\r\f\v][ \t\r\f\v]*| [ \t\r\f\v]+", " "), (" ?\n+ ?", " "), (r"\s+(?=[.,;:!?])", ""), (r"^\s+|\s+\Z", ""))),
)


def _line(notation: str, speech: str) -> tuple[re.Pattern, Callable[[re.Match], str]]:
    """A rule's line, compiled: its pattern, and what a match of it says."""
    pattern = re.compile(re.sub(r"<(\w+):(\w+)>", lambda m: f"(?P<{m[1]}>{SLOTS[m[2]]})", notation))
    # Constant pieces of the template and its slots take turns.
    pieces = re.split(r"\{([\w,]+)(?::(\w+))?\}", speech)
    said = [(slots.split(","), SPEAKERS[kind or "as it is"], after) for slots, kind, after in zip(pieces[1::3], pieces[2::3], pieces[3::3], strict=True)]

    def speak(m: re.Match) -> str:
        return pieces[0] + "".join(speaker(*(m[s] for s in slots)) + after for slots, speaker, after in said)

    return pattern, speak


#: What a text must hold for a rule to find anything in it; a cheap search that spares the rule's own.
NEEDS = {
    "dehyphenation": "-[ \t]*\n", "latex-cleanup": r"\\|\{,", "latex-operator": r"[\\×·÷≈→]", "latex-script": "[_^]", "equation-fraction": r"\\frac",
    "date": "/", "section-reference": "(?i)cap|sez|par\\.|§|appendice", "currency-range": "[€$£]", "percentage-range": "%", "range": r"\d\s*[–—-]", "percentage": "%",
    "currency": "[€$£]", "ratio": "/", "ordinal": "[º°ª]", "abbreviation": r"(?i)(?:ecc|dott|prof|art|n)\.", "decimal": r"\d[,.]\d", "integer": r"\d", "anni-elision": "(?i) anni",
    "acronym": "[A-Z]{2}",
}
_NEEDS = {name: re.compile(needed) for name, needed in NEEDS.items()}


@lru_cache(maxsize=None)
def _lines(name: str) -> tuple[tuple[re.Pattern, Callable[[re.Match], str]], ...]:
    return tuple(_line(*line) for line in dict(RULES)[name])


def ruled(name: str, text: str) -> str:
    """The text after one rule; nested fractions are said from the inside out."""
    if name in _NEEDS and not _NEEDS[name].search(text):
        return text
    if name == UNICODE:
        text = unicodedata.normalize("NFC", text)
    while True:
        before = text
        for pattern, speak in _lines(name):
            text = pattern.sub(speak, text)
        if text == before or name != "equation-fraction":
            return text


def warnings_of(text: str) -> list[str]:
    """What speech can't say and no rule has settled."""
    math = ["unresolved-math: unsupported equation notation remains in spoken text"] if re.search(r"\\[A-Za-z]+|[{}_^]", text) else []
    left = "".join(sorted(set("<>@#%€$£") & set(text)))
    return math + ([f"unresolved-symbols: {left}"] if left else [])


def applied(text: str, entries: Sequence[Entry] = BUILT_IN, equation: bool = False, only: Sequence[str] | None = None) -> tuple[str, list[tuple[str, str, str]], list[str]]:
    """(spoken text, [(rule id, before, after)], warnings); `only` names the rules to apply."""
    trail = []

    def step(name: str, new: str) -> None:
        nonlocal text
        if new != text:
            trail.append((name, text, new))
            text = new

    for name, _ in RULES:
        if only is not None and name not in only or not equation and name in EQUATION_ONLY:
            continue
        if name != LEXICON:
            step(name, ruled(name, text))
            continue
        for full, pattern, spoken in compiled(tuple(entries)):
            step(full, pattern.sub(lambda m, s=spoken: s, text))
    return text, trail, warnings_of(text)


#: Plain text: letters and signs that stand for themselves, as every rule but those of words leaves them.
_PLAIN = "(?s)[^\\x20-\\x7e\\u00a1-\\u00a9\\u00ab\\u00ac\\u00ae-\\u00b6\\u00b8\\u00b9\\u00bb-\\u00d6\\u00d8-\\u00f6\\u00f8-\\u017f\\u2018-\\u201f]|[0-9\\\\^_{}$€£&+=%<>@#£]"
_WORDS = r"(?iu)(?<!\w)(ecc|dott|prof)\.|(vent|ant|cent)[aio] anni|(?<!\w)(cap\.|capitolo|sez\.|sezione|par\.|§|appendice)\s*[a-z](?!\w)"
_SHAPES = r"\s\s|\s[.,;:!?]|^\s|\s$|(?<!\w)[A-Z]{2,6}(?!\w)"


def touched(text: Column, entries: Sequence[Entry] = BUILT_IN) -> Column:
    """Whether any rule or warning may apply: false only where applied(text) leaves a paragraph as it is."""
    found = text.rlike(_PLAIN) | text.rlike(_WORDS) | text.rlike(_SHAPES)
    low = F.lower(text)
    for e in entries:
        if e.mode == "regex" or not e.pattern.isascii():
            return F.lit(True)
        found = found | low.contains(e.pattern.lower())
    return found


_TRAIL = ArrayType(StructType([StructField(n, StringType()) for n in ("rule_id", "before", "after")]))


def normalized(df: DataFrame, text: str = "display_text", entries: Sequence[Entry] = BUILT_IN, kind: str | None = None, only: Sequence[str] | None = None) -> DataFrame:
    """df with spoken_text, transformations and warnings; column `kind` may mark equations. A null text stays null."""
    added = ("spoken_text", "transformations", "warnings")
    keep = [c for c in df.columns if c not in added]
    df = df.select(keep)
    schema = df.schema.add(added[0], StringType()).add(added[1], _TRAIL).add(added[2], ArrayType(StringType()))
    needed = F.coalesce(touched(F.col(text), entries), F.lit(False))
    if kind:
        needed = needed | (F.col(text).isNotNull() & F.coalesce(F.col(kind) == "equation", F.lit(False)))

    def run(frame: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trail = pa.list_(pa.struct([(n, pa.string()) for n in ("rule_id", "before", "after")]))
        for batch in frame:
            equations = [k == "equation" for k in batch.column(kind).to_pylist()] if kind else [False] * batch.num_rows
            found = [applied(t, entries, e, only) for t, e in zip(batch.column(text).to_pylist(), equations, strict=True)]
            trails = [[dict(zip(("rule_id", "before", "after"), s, strict=True)) for s in x[1]] for x in found]
            columns = [pa.array([x[0] for x in found], pa.string()), pa.array(trails, trail), pa.array([x[2] for x in found], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *columns], names=[*keep, *added])

    same = df.where(~needed)
    none = [F.when(F.col(text).isNotNull(), F.array().cast(t)).alias(n) for n, t in ((added[1], _TRAIL), (added[2], ArrayType(StringType())))]
    return df.where(needed).mapInArrow(run, schema).unionByName(same.select(*keep, F.col(text).alias(added[0]), *none))

"""Pronunciation lexicons: the user's extension of the text rules."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, replace
from functools import lru_cache
from pathlib import Path


@dataclass(frozen=True)
class Entry:
    entry_id: str
    pattern: str
    spoken: str
    mode: str = "literal"
    priority: int = 0
    case_sensitive: bool = False
    word_boundaries: bool = True
    lexicon_id: str = "local"
    lexicon_index: int = 0
    entry_index: int = 0
    phoneme_override: str | None = None

    def regex(self) -> re.Pattern:
        body = re.escape(self.pattern) if self.mode == "literal" else self.pattern
        body = rf"(?<!\w)(?:{body})(?!\w)" if self.word_boundaries else body
        return re.compile(body, 0 if self.case_sensitive else re.I)


# The built-in entries (id, pattern, spoken, priority, case-sensitive).
_BUILT_IN = (
    ("acronimo-bce", "BCE", "bi ci e", 100, True),
    ("acronimo-bot", "BOT", "bot", 100, True),
    ("acronimo-btp", "BTP", "bi ti pi", 100, True),
    ("acronimo-etf", "ETF", "et effe", 100, True),
    ("acronimo-inps", "INPS", "inps", 100, True),
    ("benchmark", "benchmark", "bènchmark", 50, False),
    ("drawdown", "drawdown", "dròdaun", 50, False),
)
BUILT_IN = tuple(Entry(i, p, s, "literal", prio, case, True, "finance-it", 0, n) for n, (i, p, s, prio, case) in enumerate(_BUILT_IN))


def checked(entries: tuple[Entry, ...]) -> tuple[Entry, ...]:
    """The entries, if their ids are unique in each lexicon and no pattern matches the empty text."""
    seen = set()
    for e in entries:
        if (e.lexicon_id, e.entry_id) in seen:
            raise ValueError(f"entry {e.entry_id} stands twice in {e.lexicon_id}")
        seen.add((e.lexicon_id, e.entry_id))
        if e.mode not in ("literal", "regex") or not e.pattern or e.regex().match(""):
            raise ValueError(f"entry {e.entry_id} has no usable pattern")
    said: dict[str, str] = {}
    for e in entries:
        if e.phoneme_override and said.setdefault(e.spoken, e.phoneme_override) != e.phoneme_override:
            raise ValueError(f"{e.spoken} has two phoneme overrides")
    return entries


@lru_cache(maxsize=32)
def compiled(entries: tuple[Entry, ...]) -> tuple[tuple[str, re.Pattern, str], ...]:
    """(rule id, pattern, spoken) in order of precedence: priority, later lexicons, earlier entries."""
    order = sorted(checked(entries), key=lambda e: (-e.priority, -e.lexicon_index, e.entry_index))
    return tuple((f"lexicon.{e.lexicon_id}.{e.entry_id}", e.regex(), e.spoken) for e in order)


def load(path: str, index: int = 1, sha256: str | None = None) -> tuple[Entry, ...]:
    """The entries of a YAML lexicon; sha256, if given, must be that of the file."""
    import yaml

    raw = Path(path).read_bytes()
    if sha256 and hashlib.sha256(raw).hexdigest() != sha256:
        raise ValueError(f"{path} has changed")
    data = yaml.safe_load(raw)
    known = set(Entry.__dataclass_fields__)
    out = []
    for n, item in enumerate(data["entries"]):
        if extra := set(item) - known - {"notes"}:
            raise ValueError(f"unknown fields {sorted(extra)}")
        out.append(replace(Entry(**{k: v for k, v in item.items() if k in known}), lexicon_id=data["lexicon_id"], lexicon_index=index, entry_index=n))
    return checked(tuple(out))


def identity(entries: tuple[Entry, ...]) -> str:
    """One hash for a stack of lexicons."""
    return hashlib.sha256(repr(checked(entries)).encode()).hexdigest()

"""What media tools report, how outputs are named, what may be recorded of commands, and text differences."""

from __future__ import annotations

import difflib
import re
import subprocess

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROBE = "streams array<struct<codec_type:string,codec_name:string,channels:int,sample_rate:string>>, format struct<duration:string,tags:map<string,string>>, chapters array<struct<start:bigint,end:bigint,tags:map<string,string>>>"


def probed(df: DataFrame, report: str) -> DataFrame:
    """df with codec, channels, sample_rate, duration_ms, tags, has_cover and chapters out of a probe's JSON report."""
    p = F.from_json(report, PROBE)
    sound = F.try_element_at(F.filter(p["streams"], lambda s: s["codec_type"] == "audio"), F.lit(1))
    return df.withColumns({
        "codec": sound["codec_name"],
        "channels": sound["channels"],
        "sample_rate": sound["sample_rate"].cast("int"),
        "duration_ms": F.bround(p["format"]["duration"].cast("double") * 1000).cast("long"),
        "tags": p["format"]["tags"],
        "has_cover": F.exists(p["streams"], lambda s: s["codec_type"] == "video"),
        "chapters": p["chapters"],
    })


def output_name(book: Column, first: Column, last: Column) -> Column:
    """book.m4b, book-ch-first.m4b or book-first-to-last.m4b."""
    return F.when(first.isNull(), F.concat(book, F.lit(".m4b"))).when(first == last, F.concat(book, F.lit("-"), first, F.lit(".m4b"))).otherwise(F.concat(book, F.lit("-"), first, F.lit("-to-"), last, F.lit(".m4b")))


def redacted(command: Column, roots: dict[str, str]) -> Column:
    """A recorded command with machine paths named, longest first."""
    for path, name in sorted(roots.items(), key=lambda r: -len(r[0])):
        command = F.replace(command, F.lit(path), F.lit(f"<{name}>"))
    return command


def token_diff(before: str, after: str) -> list[tuple[str, str, str]]:
    """Differing runs of tokens: (operation, before, after)."""
    cut = lambda t: re.findall(r"\w+(?:['’]\w+)*|[^\w\s]", t)
    a, b = cut(before), cut(after)
    steps = difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes()
    return [(op, " ".join(a[i:j]), " ".join(b[k:m])) for op, i, j, k, m in steps if op != "equal"]


def repository(path: str) -> dict[str, object]:
    """The commit of a work tree and whether its tracked files are as committed."""
    git = lambda *a: subprocess.run(["git", "-C", path, *a], capture_output=True, text=True, check=True, timeout=60).stdout.strip()
    return {"commit": git("rev-parse", "HEAD"), "clean": not git("status", "--porcelain", "--untracked-files=no")}

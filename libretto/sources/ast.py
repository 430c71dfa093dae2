"""Block rows out of a document AST (tagged nodes {t, c}), as one Python table function."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql.functions import udtf

_SPACE = ("Space", "SoftBreak", "LineBreak")


def inline_text(nodes: list, notes: list | None = None) -> str:
    """Inline nodes as text; footnotes go to notes."""
    out = []
    for n in nodes:
        t, c = n["t"], n.get("c")
        if t == "Str":
            out.append(c)
        elif t in _SPACE:
            out.append(" ")
        elif t in ("Code", "Math", "RawInline"):
            out.append(c[1])
        elif t == "Quoted":
            out.append('"' + inline_text(c[1], notes) + '"')
        elif t in ("Link", "Image", "Span", "Cite"):
            out.append(inline_text(c[1], notes))
        elif t == "Note":
            if notes is not None:
                notes.append(c)
        elif isinstance(c, list):
            out.append(inline_text(c, notes))
    return " ".join("".join(out).split())


def _has(nodes: list, tag: str) -> bool:
    return any(n["t"] == tag or (isinstance(n.get("c"), list) and _has([x for x in n["c"] if isinstance(x, dict) and "t" in x], tag)) for n in nodes)


def block_rows(blocks: list, kind: str = "paragraph") -> Iterator[tuple[str, int | None, str, list[str], str | None]]:
    """(kind, heading level, text, warnings, reason if excluded) of blocks in order."""
    for b in blocks:
        t, c = b["t"], b.get("c")
        if t == "Header":
            yield "heading", c[0], inline_text(c[2]), [], None
        elif t in ("Para", "Plain"):
            yield from _paragraph(c, kind)
        elif t in ("BulletList", "OrderedList"):
            for item in c if t == "BulletList" else c[1]:
                yield from block_rows(item, "list_item")
        elif t == "BlockQuote":
            inner = list(block_rows(c))
            text = " ".join(r[2] for r in inner if r[0] != "footnote" and r[4] is None)
            if text:
                yield "quotation", None, text, [w for r in inner for w in r[3]], None
            yield from (r for r in inner if r[0] == "footnote" or r[4])
        elif t == "Table":
            text = " ".join(_strings(c)).strip()
            yield ("table", None, text, ["table-linearized"], None) if text else ("table", None, "", [], "empty-table")
        elif t == "Figure":
            text = " ".join(r[2] for r in block_rows(c[1][1])) if c[1][1] else ""
            yield ("caption", None, text, [], None) if text else ("caption", None, "", [], "non-narratable-image")
        elif t == "Div":
            yield from block_rows(c[1], kind)
        elif t in ("RawBlock", "CodeBlock", "HorizontalRule"):
            yield kind, None, "", [], "unsupported-block"
        else:
            text = " ".join(_strings(c)).strip()
            yield (kind, None, text, [f"unknown-block: {t}"], None) if text else (kind, None, "", [], "unsupported-block")


def _paragraph(nodes: list, kind: str) -> Iterator[tuple]:
    real = [n for n in nodes if n["t"] not in _SPACE]
    notes: list = []
    if len(real) == 1 and real[0]["t"] == "Math" and real[0]["c"][0]["t"] == "DisplayMath":
        text = real[0]["c"][1].strip()
        yield ("equation", None, text, ["equation-requires-review"], None) if text else ("equation", None, "", [], "empty-equation")
        return
    text = inline_text(nodes, notes)
    if real and all(n["t"] == "Image" for n in real):
        yield ("caption", None, text, [], None) if text.lower() not in ("", "image", "figura") else ("caption", None, "", [], "non-narratable-image")
    elif text:
        yield kind, None, text, ["inline-math"] if _has(nodes, "Math") else [], None
    for note in notes:
        inner = " ".join(r[2] for r in block_rows(note))
        if inner:
            yield "footnote", None, inner, [], None


def _strings(node: object) -> Iterator[str]:
    """All text of a nested value, paragraph by paragraph."""
    if isinstance(node, dict):
        if node.get("t") in ("Para", "Plain"):
            yield inline_text(node["c"])
        elif "c" in node:
            yield from _strings(node["c"])
    elif isinstance(node, list):
        for x in node:
            yield from _strings(x)


@udtf(returnType="pos int, kind string, level int, text string, warnings array<string>, reason string")
class AstBlocks:
    """AST JSON -> its blocks in order; join laterally."""

    def eval(self, ast: str):
        if ast:
            for pos, row in enumerate(block_rows(json.loads(ast)["blocks"])):
                yield (pos, *row)

"""Content-addressed bundles of files, and Markdown reports over result rows."""

from __future__ import annotations

import hashlib
import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame

from libretto.sources.artifacts import canonical, within


def publish(root: str, target: str, roles: dict[str, str]) -> str:
    """Copy files (relative path -> role) into target/<hash of the manifest>; an equal bundle is used again, another one of that name is an error."""
    files = []
    for path, role in sorted(roles.items()):
        source = within(root, path)
        if source.is_symlink():
            raise ValueError(f"{path} is a link")
        files.append({"path": path, "role": role, "sha256": hashlib.sha256(source.read_bytes()).hexdigest()})
    body = canonical({"files": files})
    name = hashlib.sha256(body).hexdigest()
    final = Path(target) / name
    if final.exists():
        verify(str(final))
        return str(final)
    Path(target).mkdir(parents=True, exist_ok=True)
    stage = Path(tempfile.mkdtemp(dir=target))
    for f in files:
        to = stage / f["path"]
        to.parent.mkdir(parents=True, exist_ok=True)
        shutil.copyfile(within(root, f["path"]), to)
        if hashlib.sha256(to.read_bytes()).hexdigest() != f["sha256"]:
            raise ValueError(f"{f['path']} changed while it was copied")
    (stage / "manifest.json").write_bytes(body + b"\n")
    os.replace(stage, final)
    return str(final)


def verify(bundle: str) -> None:
    """The bundle's files must be those of its manifest, all and no others."""
    import json

    want = {f["path"]: f["sha256"] for f in json.loads((Path(bundle) / "manifest.json").read_bytes())["files"]}
    have = {str(p.relative_to(bundle)): hashlib.sha256(p.read_bytes()).hexdigest() for p in Path(bundle).rglob("*") if p.is_file() and p.name != "manifest.json"}
    if want != have:
        raise ValueError(f"the bundle differs in {sorted(set(want.items()) ^ set(have.items()))[:4]}")


def fenced(text: str) -> str:
    """Inline code that survives the text's own back-ticks."""
    longest = max((len(r) for r in text.replace("`", " ` ").split() if set(r) == {"`"}), default=0)
    run = longest
    while "`" * (run + 1) in text:
        run += 1
    mark = "`" * (run + 1)
    pad = " " if text.startswith("`") or text.endswith("`") else ""
    return f"{mark}{pad}{text}{pad}{mark}"


def report(title: str, summary: DataFrame, *sections: tuple[str, DataFrame], most: int | None = None) -> str:
    """Markdown: a one-row summary as a list, then tables of all result rows in their order, fetched a partition
    at a time; with `most` each holds that many rows and says so."""
    (row,) = summary.limit(1).collect() or ({},)
    out = [f"# {title}", ""] + [f"- {k}: {v}" for k, v in (row.asDict() if row else {}).items()]
    for name, df in sections:
        out += ["", f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
        shown = df if most is None else df.limit(most + 1)
        for n, r in enumerate(shown.toLocalIterator()):
            if n == most:
                out.append(f"\nOnly the first {most} rows are shown.")
                break
            out.append("| " + " | ".join(str(v).replace("|", "\\|").replace("\n", " ") for v in r) + " |")
    return "\n".join(out) + "\n"

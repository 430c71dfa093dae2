"""Files around the engine: JSON envelopes, JSONL evidence, WAV folders, configuration, LaTeX trees."""

from __future__ import annotations

import hashlib
import json
import os
import re
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from libretto.functions.text import kebab


def canonical(value: object) -> bytes:
    """JSON with sorted keys, no spaces, UTF-8, no NaN."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False).encode()


def digest(value: object) -> str:
    return hashlib.sha256(canonical(value)).hexdigest()


def within(root: str, relative: str) -> Path:
    """A path below root, written relative and plain."""
    if not relative or relative.startswith("/") or relative != os.path.normpath(relative) or ".." in Path(relative).parts:
        raise ValueError(f"{relative} is not a plain relative path")
    return Path(root) / relative


def replace_file(path: Path, data: bytes) -> None:
    """Write beside, flush, then rename over."""
    path.parent.mkdir(parents=True, exist_ok=True)
    with tempfile.NamedTemporaryFile(dir=path.parent, delete=False) as f:
        f.write(data)
        f.flush()
        os.fsync(f.fileno())
    os.replace(f.name, path)


def write_envelope(root: str, relative: str, kind: str, payload: object, dependencies: list[tuple[str, str]] = ()) -> str:
    """An artifact's envelope; its dependencies must be there with the hashes named. Returns its own hash."""
    for path, sha in dependencies:
        if hashlib.sha256(within(root, path).read_bytes()).hexdigest() != sha:
            raise ValueError(f"{path} has changed")
    body = {"artifact_type": kind, "payload": payload, "payload_sha256": digest(payload), "dependencies": [{"path": p, "sha256": s} for p, s in dependencies]}
    data = canonical(body) + b"\n"
    replace_file(within(root, relative), data)
    return hashlib.sha256(data).hexdigest()


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Artifacts below path: path, artifact_type, payload (JSON text), payload_sha256, sha256 (of the file), dependencies."""
    schema = "artifact_type string, payload_sha256 string, dependencies array<struct<path:string,sha256:string>>"
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(path)
    text = F.decode("content", "UTF-8")
    body = F.from_json(text, schema)
    return raw.select("path", "content", body.alias("e"), F.get_json_object(text, "$.payload").alias("payload")).select("path", "e.artifact_type", "payload", "e.payload_sha256", F.sha2("content", 256).alias("sha256"), "e.dependencies")


def read_records(spark: SparkSession, path: str, schema: str, version: str) -> DataFrame:
    """JSONL evidence of one schema version; anything else fails the read."""
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    fits = F.assert_true(F.col("schema_version") == version, F.lit("another schema version"))
    return rows.where(fits.isNull())


def append_records(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def artifact_type(name):
    return kebab(name)


def read_config(path: str, required: dict[str, type], optional: dict[str, type] = {}) -> dict:  # noqa: B006
    """A YAML mapping with these fields and no others."""
    import yaml

    data = yaml.safe_load(Path(path).read_bytes())
    if not isinstance(data, dict):
        raise ValueError("the configuration must be a mapping")
    if wrong := (set(data) - set(required) - set(optional)) | (set(required) - set(data)):
        raise ValueError(f"unknown or missing fields: {sorted(wrong)}")
    for name, kind in (required | optional).items():
        if name in data and not isinstance(data[name], kind):
            raise ValueError(f"{name} must be {kind.__name__}")
    return data


def uncommented(line: str) -> str:
    """A LaTeX line up to its comment: a percent sign behind an even number of backslashes."""
    m = re.match(r"((?:[^%\\]|\\.)*)", line + " ")
    return m[1].rstrip() if m else line


def inlined(root: str, relative: str, seen: tuple[str, ...] = ()) -> str:
    """A LaTeX file with what it includes put in place; cycles and paths that leave root are errors."""
    name = relative if Path(relative).suffix else relative + ".tex"
    path = Path(os.path.realpath(Path(root) / name))
    if not path.is_relative_to(os.path.realpath(root)):
        raise ValueError(f"{relative} leaves the source tree")
    if str(path) in seen:
        raise ValueError(f"{relative} includes itself")
    out = []
    for line in path.read_text().splitlines():
        body = uncommented(line)
        out.append(re.sub(r"\\(?:input|include|import)\{([^{}]+)\}", lambda m: inlined(root, m[1].strip(), (*seen, str(path))), body))
    return "\n".join(out)


CITATION = r"\\(?:cite|citep|citet|autocite|parencite|textcite)\*?(?:\[[^\]]*\]){0,2}\{[^{}]*\}"


def without_citations(text):
    """(text without citations, how many there were), as Columns."""
    return F.regexp_replace(text, F.lit(r"\s*" + CITATION), F.lit("")), F.regexp_count(text, F.lit(CITATION))


def loudness(stderr):
    """The last JSON object of an analysis log that has both measures: struct of input_i, input_tp, input_lra, input_thresh."""
    found = F.regexp_extract_all(stderr, F.lit(r"(\{[^{}]*\})"), F.lit(1))
    both = F.filter(found, lambda x: x.contains('"input_i"') & x.contains('"output_i"'))
    return F.from_json(F.try_element_at(both, F.lit(-1)), "input_i string, input_tp string, input_lra string, input_thresh string")


def checked_envelopes(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """read_envelopes() with problem: type, payload-checksum, or null. The payload is hashed in the canonical
    form that write_envelope() gives it, as its text in the file, so nothing is parsed and written anew."""
    rows = read_envelopes(spark, path)
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(path)
    body = F.regexp_extract(F.decode("content", "UTF-8"), r'(?s)"payload":(.*),"payload_sha256":"[0-9a-f]*"\}\s*$', 1)
    rows = rows.join(raw.select(F.col("path").alias("_p"), F.sha2(body, 256).alias("_is")), F.col("path") == F.col("_p"))
    wrong_type = F.lit(False) if kind is None else ~F.col("artifact_type").eqNullSafe(F.lit(kind))
    problem = F.when(wrong_type, "type").when(~F.col("payload_sha256").eqNullSafe(F.col("_is")), "payload-checksum")
    return rows.withColumn("problem", problem).drop("_p", "_is")

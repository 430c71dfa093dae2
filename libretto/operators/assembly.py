"""Assembly of audio: the byte timeline with its silences, input hashes for reuse, agreement checks."""

from __future__ import annotations

from collections.abc import Iterable
from typing import BinaryIO

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def silence(frames: Column, width: int = 2) -> Column:
    """That many mono frames of zeros, as bytes."""
    return F.unhex(F.repeat(F.lit("00" * width), frames.cast("int")))


def pcm_pieces(timed: DataFrame, pcm: str = "pcm", pause: str = "pause_frames", audio: str = "audio_frames", width: int = 2) -> DataFrame:
    """timed with first_byte and piece: each row's silence and audio, where they stand in the book's file.

    A row's audio must hold the frames it claims, or piece is null and problem says so. Pieces are as
    large as a chunk; the file itself is their order, written by write_pieces.
    """
    fits = F.octet_length(pcm) == F.col(audio) * width
    return (
        timed.withColumn("first_byte", (F.col("start_frame") - F.col(pause)) * width)
        .withColumn("piece", F.when(fits, F.concat(silence(F.col(pause), width), F.col(pcm))))
        .withColumn("problem", F.when(~F.coalesce(fits, F.lit(False)), F.lit("frame-count")))
    )


def write_pieces(pieces: DataFrame, out: BinaryIO, by: Iterable[str] = ()) -> int:
    """Write one book's pieces in order, a partition at a time on the driver; returns the bytes. Gaps and bad pieces are errors."""
    at = 0
    for row in pieces.orderBy(*by, "first_byte").select("first_byte", "piece", "problem").toLocalIterator():
        if row.problem or row.first_byte != at:
            raise ValueError(row.problem or f"a gap before byte {row.first_byte}")
        at += out.write(row.piece)
    return at


def input_hash(df: DataFrame, inputs: list[str], out: str = "assembly_sha256") -> DataFrame:
    """df with one hash over all inputs, by name: equal hashes let an earlier assembly be used again."""
    named = F.to_json(F.struct(*(F.col(c).alias(c) for c in sorted(inputs))), {"ignoreNullFields": "false"})
    return df.withColumn(out, F.sha2(named, 256))


def reusable(wanted: DataFrame, kept: DataFrame, key: str, sha: str = "assembly_sha256") -> DataFrame:
    """wanted with reuse: whether what is kept under its key was made from the same inputs and holds its own hash."""
    k = kept.select(F.col(key), F.col(sha).alias("_made"), F.col("output_sha256").alias("_said"), F.col("actual_sha256").alias("_is"))
    same = (F.col("_made") == F.col(sha)) & (F.col("_said") == F.col("_is"))
    return wanted.join(k, key, "left").withColumn("reuse", F.coalesce(same, F.lit(False))).drop("_made", "_said", "_is")


def agreement(df: DataFrame, by: str, value: str) -> DataFrame:
    """A row a group: its one value, or null and how many different ones there are (nulls count as one)."""
    seen = df.groupBy(by).agg(F.count_distinct(value).alias("n"), F.max(F.col(value).isNull().cast("int")).alias("_null"), F.min(value).alias("_v"))
    values = F.col("n") + F.col("_null")
    return seen.select(by, F.when(values == 1, F.col("_v")).alias(value), values.cast("long").alias("values"), (values == 1).alias("agrees"))


def media_faults(df: DataFrame, rate: int, off_ms: int = 100, marker_ms: int = 1) -> DataFrame:
    """df with faults of probed media beside those of timeline.media_problems: tags, cover, chapters.

    Columns: tags and expected_tags (maps), has_cover and wants_cover, chapters and expected_chapters
    (arrays of struct title, start_ms, end_ms).
    """
    wrong = F.exists(F.map_keys("expected_tags"), lambda k: ~F.col("expected_tags")[k].eqNullSafe(F.try_element_at("tags", k)))
    near = lambda a, b: F.abs(a - b) <= marker_ms
    same = lambda p: (p["a"]["title"] == p["b"]["title"]) & near(p["a"]["start_ms"], p["b"]["start_ms"]) & near(p["a"]["end_ms"], p["b"]["end_ms"])
    pairs = F.arrays_zip(F.col("chapters").alias("a"), F.col("expected_chapters").alias("b"))
    marked = (F.size("chapters") == F.size("expected_chapters")) & F.forall(pairs, same)
    apart = F.exists(F.sequence(F.lit(2), F.size("chapters")), lambda i: F.col("chapters")[i - 1]["start_ms"] != F.col("chapters")[i - 2]["end_ms"])
    return df.withColumn("faults", F.array_compact(F.array(
        F.when(wrong, "tags"), F.when(F.col("has_cover") != F.col("wants_cover"), "cover"), F.when(~F.coalesce(marked, F.lit(False)), "chapters"),
        F.when((F.size("chapters") > 1) & apart, "markers-not-contiguous"),
    )))

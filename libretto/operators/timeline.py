"""Sample-accurate timelines: running sums of pauses and audio, and chapter markers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def frames_of(ms: Column, rate: int) -> Column:
    """Milliseconds in frames, half-even."""
    return F.bround(ms * F.lit(rate) / F.lit(1000)).cast("long")


def ms_of(frames: Column, rate: int) -> Column:
    """Frames in milliseconds, half-even, 1 at least."""
    return F.greatest(F.lit(1), F.bround(frames * F.lit(1000) / F.lit(rate))).cast("long")


def timeline(df: DataFrame, by: list[str], order: list[str], audio: str = "audio_frames", pause: str = "pause_frames") -> DataFrame:
    """df with start_frame: where a row's audio starts, after its own pause and all that stands before it."""
    before = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("start_frame", F.coalesce(F.sum(F.col(audio) + F.col(pause)).over(before), F.lit(0)) + F.col(pause))


def markers(timed: DataFrame, by: list[str], chapter: str, audio: str = "audio_frames", pause: str = "pause_frames") -> DataFrame:
    """A marker a chapter: from its first row's start (the first from 0) to the next one's, the last to the end."""
    starts = timed.groupBy(*by, chapter).agg(F.min("start_frame").alias("_s"), F.max(F.col("start_frame") + F.col(audio)).alias("_e"))
    order = Window.partitionBy(*by).orderBy("_s")
    first = F.when(F.row_number().over(order) == 1, F.lit(0)).otherwise(F.col("_s"))
    end = F.coalesce(F.lead("_s").over(order), F.max("_e").over(Window.partitionBy(*by)))
    return starts.select(*by, chapter, first.cast("long").alias("start_frame"), end.cast("long").alias("end_frame"))


def escaped(text: Column) -> Column:
    """As FFMETADATA wants it: backslash, =, ;, # and line breaks behind a backslash."""
    return F.regexp_replace(text, F.lit(r"([\\=;#\n])"), F.lit(r"\\$1"))


def ffmetadata(marks: DataFrame, rate: int, title: str, *by: str) -> DataFrame:
    """A row a book: the chapter file's text."""
    one = F.concat(F.lit(f"[CHAPTER]\nTIMEBASE=1/{rate}\nSTART="), F.col("start_frame"), F.lit("\nEND="), F.col("end_frame"), F.lit("\ntitle="), escaped(F.col(title)))
    listed = F.array_sort(F.collect_list(F.struct(F.col("start_frame").alias("o"), one.alias("t"))))
    return marks.groupBy(*by).agg(F.concat(F.lit(";FFMETADATA1\n"), F.array_join(F.transform(listed, lambda x: x["t"]), "\n"), F.lit("\n")).alias("ffmetadata"))


def media_problems(df: DataFrame, rate: int, target: float = -18.0, target_tolerance: float = 0.5, peak: float = -2.0, peak_tolerance: float = 0.5, off_ms: int = 100) -> DataFrame:
    """df with problems: what is wrong with probed media (codec, channels, sample_rate, duration_ms, expected_ms, loudness, true_peak)."""
    return df.withColumn("problems", F.array_compact(F.array(
        F.when(F.col("codec") != "aac", "codec"),
        F.when(F.col("channels") != 1, "channels"),
        F.when(F.col("sample_rate") != rate, "sample-rate"),
        F.when(F.abs(F.col("duration_ms") - F.col("expected_ms")) > off_ms, "duration"),
        F.when(F.abs(F.col("loudness") - target) > target_tolerance, "loudness"),
        F.when(F.col("true_peak") > peak + peak_tolerance, "true-peak"),
    )))

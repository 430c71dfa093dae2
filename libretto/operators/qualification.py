"""Qualification of engines: a fixed corpus of excerpts, timed runs, scores by category, compatible results."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from libretto.functions import metrics
from libretto.operators import synthesis


def corpus_problems(corpus: DataFrame, required: Sequence[str], size: int) -> DataFrame:
    """What is wrong with a corpus (excerpt_id, categories): its size, repeated ids, categories without an excerpt."""
    spark = corpus.sparkSession
    counted = corpus.agg(F.count("*").alias("n")).where(F.col("n") != size).select(F.format_string("%d excerpts", "n").alias("problem"))
    twice = corpus.groupBy("excerpt_id").count().where("count > 1").select(F.concat(F.lit("repeated: "), F.col("excerpt_id").cast("string")).alias("problem"))
    have = corpus.select(F.explode("categories").alias("c")).distinct()
    wanted = spark.createDataFrame([(c,) for c in required], "c string")
    return counted.unionByName(twice).unionByName(wanted.join(have, "c", "left_anti").select(F.concat(F.lit("no excerpt for "), "c").alias("problem")))


def qualified(corpus: DataFrame, make: Callable[[], Callable], rate: int, seed: int, speed: float = 1.0) -> DataFrame:
    """Samples of the corpus (excerpt_id, categories, spoken_text): audio or failure, and audio_seconds."""
    rows = corpus.select(F.col("excerpt_id").cast("string").alias("chunk_id"), F.sha2("spoken_text", 256).alias("content_sha256"), "spoken_text", F.lit(0).alias("retry_number"))
    made = synthesis.generated(rows.withColumn("cache_key", F.col("content_sha256")), make, rate, seed, speed, 0)
    return corpus.withColumn("chunk_id", F.col("excerpt_id").cast("string")).join(made, "chunk_id").withColumn("audio_seconds", F.col("frame_count") / rate).drop("chunk_id")


def totals(samples: DataFrame) -> DataFrame:
    """One row: seconds generated and of audio, rtf, counts and whether none, some or all failed."""
    out = samples.agg(F.sum("generation_seconds").alias("generation_seconds"), F.sum("audio_seconds").alias("audio_seconds"), F.count("*").alias("n"), F.count_if(F.col("exception_type").isNotNull()).alias("failed"))
    status = F.when(F.col("failed") == 0, "completed").when(F.col("failed") == F.col("n"), "failed").otherwise("partial")
    return out.withColumn("rtf", F.try_divide("generation_seconds", "audio_seconds")).withColumn("status", status)


def scores(samples: DataFrame, by: str | None = None, reference: str = "spoken_text", transcript: str = "transcript") -> DataFrame:
    """Micro-averaged wer and cer overall, or per value of an array column; a sample counts in each of its values."""
    rows = metrics.scored(samples, reference, transcript)
    if by is None:
        return rows.agg(F.count("*").alias("n"), metrics.micro_average("wer").alias("wer"), metrics.micro_average("cer").alias("cer"))
    rows = rows.withColumn("_by", F.explode(F.array_distinct(by)))
    return rows.groupBy(F.col("_by").alias("value")).agg(F.count("*").alias("n"), metrics.micro_average("wer").alias("wer"), metrics.micro_average("cer").alias("cer"))


def mismatched(samples: DataFrame, corpus: DataFrame) -> DataFrame:
    """Samples that don't stand where the corpus has them (both with column pos), or say something else."""
    c = corpus.select("pos", F.col("excerpt_id").alias("_e"), F.col("spoken_text").alias("_t"))
    return samples.join(c, "pos", "full").where(~F.col("excerpt_id").eqNullSafe(F.col("_e")) | ~F.col("spoken_text").eqNullSafe(F.col("_t")))

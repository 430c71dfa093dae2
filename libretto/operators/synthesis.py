"""Resumable synthesis and bounded verification: what is missing is made, what fails is tried again.

Engines and transcribers are plug-ins: an engine is a function (text, seed, rate, speed) -> PCM bytes,
a transcriber a function PCM bytes -> text. Both run inside Arrow functions, made once per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from libretto.functions import audio, metrics
from libretto.operators import states

GENERATED = "chunk_id string, cache_key string, chunk_content_sha256 string, output_sha256 string, sample_rate_hz int, frame_count long, duration_ms long, retry_number int, pcm binary, exception_type string, message string, attempt_count int"


def cache_keys(chunks: DataFrame, engine: str, revision: str, voice: str, rate: int, seed: int, speed: float) -> DataFrame:
    """chunks with cache_key: the hash of everything that shapes the audio, and of nothing else."""
    identity = F.struct(
        F.lit(engine).alias("engine"), F.lit(rate).alias("sample_rate_hz"), F.lit(revision).alias("revision"),
        F.lit(seed).alias("seed"), F.lit(speed).alias("speed"), F.col("spoken_text"), F.lit(voice).alias("voice_id"),
    )
    names = sorted(f for f in ("engine", "sample_rate_hz", "revision", "seed", "speed", "spoken_text", "voice_id"))
    return chunks.withColumn("_i", identity).withColumn("cache_key", F.sha2(F.to_json(F.struct(*(F.col(f"_i.{n}").alias(n) for n in names)), {"ignoreNullFields": "false"}), 256)).drop("_i")


def generated(pending: DataFrame, make: Callable[[], Callable], rate: int, seed: int, speed: float = 1.0, retries: int = 1) -> DataFrame:
    """A row a pending chunk (chunk_id, cache_key, content_sha256, spoken_text, retry_number): its audio, or its failure after retries + 1 attempts."""

    def run(frame: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = make()
        kinds = (pa.string(),) * 4 + (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.string(), pa.string(), pa.int32())
        names = [f.split()[0] for f in GENERATED.split(", ")]
        for batch in frame:
            rows = []
            for r in batch.select(["chunk_id", "cache_key", "content_sha256", "spoken_text", "retry_number"]).to_pylist():
                failure = None
                for attempt in range(retries + 1):
                    number = r["retry_number"] + attempt
                    try:
                        pcm = engine(r["spoken_text"], (seed + number) % (1 << 32), rate, speed)
                        if not pcm or len(pcm) % 2:
                            raise ValueError("the engine gave no whole samples")
                    except Exception as e:  # a failed attempt is a result
                        failure = (type(e).__name__, str(e), attempt + 1)
                        continue
                    frames = len(pcm) // 2
                    rows.append((r["chunk_id"], r["cache_key"], r["content_sha256"], hashlib.sha256(pcm).hexdigest(), rate, frames, max(1, round(frames * 1000 / rate)), number, pcm, None, None, attempt + 1))
                    break
                else:
                    rows.append((r["chunk_id"], r["cache_key"], r["content_sha256"], None, rate, None, None, r["retry_number"], None, *failure))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return pending.mapInArrow(run, GENERATED)


def synthesised(chunks: DataFrame, made: DataFrame, make: Callable[[], Callable], rate: int, seed: int, speed: float = 1.0, retries: int = 1, force: bool = False, retry: DataFrame | None = None) -> DataFrame:
    """What is new: rows for chunks without audio under their key, all with force, and those that retry (chunk_id, retry_number) names."""
    have = made.where("exception_type is null").select("chunk_id", "cache_key")
    todo = chunks if force else chunks.join(have, ["chunk_id", "cache_key"], "left_anti")
    todo = todo.withColumn("retry_number", F.lit(0))
    if retry is not None:
        again = chunks.join(retry.select("chunk_id", "retry_number"), "chunk_id")
        todo = todo.join(retry.select("chunk_id"), "chunk_id", "left_anti").unionByName(again)
    return generated(todo.select("chunk_id", "cache_key", "content_sha256", "spoken_text", "retry_number"), make, rate, seed, speed, retries)


def state(made: DataFrame) -> DataFrame:
    """One row: totals and completed, partial or failed."""
    out = made.agg(F.count_if(F.col("exception_type").isNull()).alias("generated"), F.count_if(F.col("exception_type").isNotNull()).alias("failed"), F.sum("duration_ms").alias("audio_ms"))
    return out.withColumn("status", F.when(F.col("failed") == 0, "completed").when(F.col("generated") == 0, "failed").otherwise("partial"))


MEASURES = "chunk_id string, generation_sha256 string, transcript string, wer double, cer double, missing_prefix_words int, missing_suffix_words int, repeated_ngram_count int, silence_ratio double, clipped_sample_ratio double, peak_dbfs double, speaking_rate_wpm double, word_count int, attempt_number int"


def measured(made: DataFrame, chunks: DataFrame, make: Callable[[], Callable]) -> DataFrame:
    """Transcripts of generated audio and all that classification needs."""
    rows = made.where("pcm is not null").join(chunks.select("chunk_id", "spoken_text"), "chunk_id").select("chunk_id", "output_sha256", "pcm", "sample_rate_hz", "retry_number", "spoken_text")

    def run(frame: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listen = make()
        kinds = (pa.string(),) * 3 + (pa.float64(),) * 2 + (pa.int32(),) * 3 + (pa.float64(),) * 4 + (pa.int32(),) * 2
        names = [f.split()[0] for f in MEASURES.split(", ")]
        for batch in frame:
            out = []
            for r in batch.to_pylist():
                heard = listen(r["pcm"])
                a, b = metrics.comparable(r["spoken_text"]).split(), metrics.comparable(heard).split()
                first, last = metrics.missing_ends(metrics.alignment(a, b))
                seconds = len(r["pcm"]) / 2 / r["sample_rate_hz"]
                out.append((r["chunk_id"], r["output_sha256"], heard, metrics.word_error(" ".join(a), " ".join(b))["rate"], metrics.character_error(" ".join(a), " ".join(b))["rate"], first, last, metrics.repetition_excess(a, b), *audio.pcm_quality(r["pcm"]), max(0.001, len(a) * 60 / seconds), len(a), r["retry_number"]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return rows.mapInArrow(run, MEASURES)


def verified(chunks: DataFrame, made: DataFrame, cached: DataFrame | None, make: Callable[[], Callable], thresholds: states.Thresholds = states.Thresholds(), retries: int = 2) -> DataFrame:
    """Classified measures of made; those in cached for the same chunk and audio aren't measured again."""
    if cached is None:
        return states.classified(measured(made, chunks, make), thresholds, retries)
    keys = cached.select("chunk_id", F.col("generation_sha256").alias("output_sha256"))
    fresh = states.classified(measured(made.join(keys, ["chunk_id", "output_sha256"], "left_anti"), chunks, make), thresholds, retries)
    still = made.select("chunk_id", F.col("output_sha256").alias("generation_sha256"))
    return fresh.unionByName(cached.join(still, ["chunk_id", "generation_sha256"], "left_semi"))


def verification_loop(chunks: DataFrame, made: DataFrame, engine: Callable[[], Callable], listener: Callable[[], Callable], keep: Callable[[DataFrame], DataFrame], rate: int, seed: int, retries: int = 2) -> tuple[DataFrame, DataFrame]:
    """(audio, verifications) after passes of verify and retry, at most retries + 2; keep() stores a pass's rows."""
    checked = None
    for _ in range(retries + 2):
        checked = keep(verified(chunks, made, checked, listener, retries=retries))
        again = checked.where("status = 'retryable'").select("chunk_id", (F.col("attempt_number") + 1).alias("retry_number"))
        if again.isEmpty():
            break
        new = synthesised(chunks.join(again.select("chunk_id"), "chunk_id", "left_semi"), made, engine, rate, seed, retry=again)
        made = keep(states.merged(new, made, chunks))
    return made, checked

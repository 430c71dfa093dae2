"""State joins of the audio pipeline: generation state, verification, classification, review, scoring."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def block_mismatches(document: DataFrame, normalized: DataFrame, key: str = "block_id") -> DataFrame:
    """Keys that stand on one side only: (key, side)."""
    a, b = document.select(key), normalized.select(key)
    return a.join(b, key, "left_anti").withColumn("side", F.lit("missing")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("extra")))


def generation_state(chunks: DataFrame, records: DataFrame, failures: DataFrame, keys: tuple[str, ...] = ("chunk_id", "cache_key")) -> DataFrame:
    """chunks with state: generated, failed or missing; a record stands above a failure."""
    on = list(keys)
    r = records.select(*on).distinct().withColumn("_r", F.lit(True))
    f = failures.select(*on).distinct().withColumn("_f", F.lit(True))
    state = F.when(F.col("_r"), "generated").when(F.col("_f"), "failed").otherwise("missing")
    return chunks.join(r, on, "left").join(f, on, "left").withColumn("state", state).drop("_r", "_f")


def selected(states: DataFrame, start: int | None = None, end: int | None = None, failed_only: bool = False) -> DataFrame:
    """Chunks of a range of sequences (ends included), all or those that failed."""
    out = states if start is None else states.where(F.col("sequence") >= start)
    out = out if end is None else out.where(F.col("sequence") <= end)
    return out.where("state = 'failed'") if failed_only else out


def pending(states: DataFrame, force: bool = False) -> DataFrame:
    return states if force else states.where("state <> 'generated'")


def merged(fresh: DataFrame, prior: DataFrame, still: DataFrame, key: str = "chunk_id") -> DataFrame:
    """The fresh rows, and those of prior that aren't among them and are still wanted."""
    return fresh.unionByName(prior.join(fresh.select(key), key, "left_anti").join(still.select(key), key, "left_semi"))


@dataclass(frozen=True)
class Thresholds:
    """The defaults of verification."""

    wer: float = 0.70
    cer: float = 0.85
    missing_prefix: int = 1
    missing_suffix: int = 1
    repeated_ngrams: int = 0
    silence: float = 0.95
    clipped: float = 0.001
    slowest: float = 70.0
    fastest: float = 260.0
    rate_words: int = 4


#: Reasons that a new attempt may cure, in their order, before those that need a reviewer.
RETRYABLE = ("empty-transcript", "missing-prefix", "missing-suffix", "repeated-ngram", "excessive-silence", "clipping", "speaking-rate-low", "speaking-rate-high")


def reasons(t: Thresholds = Thresholds()) -> Column:
    """Reason codes of a row with transcript, wer, cer, missing_prefix_words, missing_suffix_words,
    repeated_ngram_count, silence_ratio, clipped_sample_ratio, speaking_rate_wpm and word_count."""
    rated = F.col("word_count") >= t.rate_words
    tests = (
        (F.length(F.trim("transcript")) == 0, "empty-transcript"),
        (F.col("missing_prefix_words") > t.missing_prefix, "missing-prefix"),
        (F.col("missing_suffix_words") > t.missing_suffix, "missing-suffix"),
        (F.col("repeated_ngram_count") > t.repeated_ngrams, "repeated-ngram"),
        (F.col("silence_ratio") > t.silence, "excessive-silence"),
        (F.col("clipped_sample_ratio") > t.clipped, "clipping"),
        (rated & (F.col("speaking_rate_wpm") < t.slowest), "speaking-rate-low"),
        (rated & (F.col("speaking_rate_wpm") > t.fastest), "speaking-rate-high"),
        (F.col("wer") > t.wer, "wer-high"),
        (F.col("cer") > t.cer, "cer-high"),
    )
    return F.array_compact(F.array(*(F.when(test, name) for test, name in tests)))


def classified(df: DataFrame, t: Thresholds = Thresholds(), retries: int = 2) -> DataFrame:
    """df with reason_codes and status: accepted, retryable (an attempt is left) or review."""
    out = df.withColumn("reason_codes", reasons(t))
    cure = F.arrays_overlap("reason_codes", F.array(*map(F.lit, RETRYABLE)))
    status = F.when(F.size("reason_codes") == 0, "accepted").when(cure & (F.col("attempt_number") < retries), "retryable").otherwise("review")
    return out.withColumn("status", status)


def decided(verifications: DataFrame, decisions: DataFrame) -> DataFrame:
    """Reviewers' decisions (chunk_id, generation_sha256, action) upon verifications.

    accept holds for rows in review, regenerate for all but retryable ones, both only for the
    generation they were made for; column refused says why one doesn't hold.
    """
    d = decisions.select("chunk_id", F.col("generation_sha256").alias("_g"), F.col("action").alias("_a"))
    out = verifications.join(d, "chunk_id", "left")
    refused = F.when(F.col("_a").isNull(), None).when(F.col("_g") != F.col("generation_sha256"), "stale").when((F.col("_a") == "accept") & (F.col("status") != "review"), "not in review").when((F.col("_a") == "regenerate") & (F.col("status") == "retryable"), "will be retried")
    out = out.withColumn("refused", refused)
    holds = F.col("_a").isNotNull() & F.col("refused").isNull()
    status = F.when(holds & (F.col("_a") == "accept"), "accepted").when(holds & (F.col("_a") == "regenerate"), "retryable").otherwise(F.col("status"))
    codes = F.when(holds, F.concat("reason_codes", F.array(F.concat(F.lit("manual-"), F.col("_a"))))).otherwise(F.col("reason_codes"))
    return out.withColumn("status", status).withColumn("reason_codes", codes).drop("_g", "_a")


def overall(df: DataFrame) -> DataFrame:
    """One row: counts by status and the overall status; retryable stands above review."""
    out = df.agg(*(F.count_if(F.col("status") == s).alias(s) for s in ("accepted", "retryable", "review")))
    return out.withColumn("status", F.when(F.col("retryable") > 0, "retryable").when(F.col("review") > 0, "review").otherwise("completed"))


def retry_seed(seed: Column, attempt: Column) -> Column:
    return F.pmod(seed + attempt, F.lit(1 << 32))


def speaking_rate(words: Column, seconds: Column) -> Column:
    return F.greatest(F.lit(0.001), words * 60 / seconds)


def assembly_inputs(chunks: DataFrame, generations: DataFrame, verifications: DataFrame) -> DataFrame:
    """chunks joined with what assembly needs; problem: missing, stale-generation, unverified, stale-verification or unaccepted."""
    g = generations.select("chunk_id", F.col("chunk_content_sha256").alias("_c"), F.col("output_sha256").alias("generation_sha256"), "sample_rate_hz", "frame_count")
    v = verifications.select("chunk_id", F.col("generation_sha256").alias("_v"), F.col("status").alias("_s"))
    out = chunks.join(g, "chunk_id", "left").join(v, "chunk_id", "left")
    problem = (
        F.when(F.col("_c").isNull(), "missing")
        .when(F.col("_c") != F.col("content_sha256"), "stale-generation")
        .when(F.col("_v").isNull(), "unverified")
        .when(F.col("_v") != F.col("generation_sha256"), "stale-verification")
        .when(F.col("_s") != "accepted", "unaccepted")
    )
    return out.withColumn("problem", problem).drop("_c", "_v", "_s")


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")

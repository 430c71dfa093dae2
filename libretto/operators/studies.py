"""Study statistics: paired A/B runs, bootstrap intervals, rankings, multi-valued categories, blind packages."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def paired(samples: DataFrame, base: str, variant: str, passes: int = 4) -> DataFrame:
    """A row a complete session: summed medians of both candidates and their reductions.

    samples: session_id, pass_index, candidate, excerpt, generation_seconds, rtf. Each candidate's
    passes are medians per excerpt first; sessions without all passes are left out.
    """
    whole = samples.groupBy("session_id").agg(F.count_distinct("pass_index").alias("_n")).where(F.col("_n") == passes).select("session_id")
    mid = samples.join(whole, "session_id", "left_semi").groupBy("session_id", "excerpt", "candidate").agg(F.median("generation_seconds").alias("s"), F.median("rtf").alias("r"))
    of = lambda c, x: F.sum(F.when(F.col("candidate") == c, F.col(x)))
    out = mid.groupBy("session_id").agg(of(base, "s").alias("base_s"), of(variant, "s").alias("variant_s"), of(base, "r").alias("_br"), of(variant, "r").alias("_vr"))
    return out.where("base_s is not null and variant_s is not null").select("session_id", "base_s", "variant_s", (1 - F.col("variant_s") / F.col("base_s")).alias("reduction"), (1 - F.col("_vr") / F.col("_br")).alias("rtf_reduction"))


def median_interval(values: Sequence[float], resamples: int = 10_000, seed: int = 0, block: int = 1 << 20) -> tuple[float, float] | None:
    """Percentile bootstrap of the median, 95 %, of values in their given order; None for fewer than two.

    The draws are those of Python's seeded generator, value after value and resample after resample,
    taken in blocks so that memory is bounded.
    """
    import numpy as np

    n, given = len(values), np.asarray(values, dtype=np.float64)
    if n < 2:
        return None
    *words, place = random.Random(seed).getstate()[1]
    draw, medians = np.random.RandomState(), []
    draw.set_state(("MT19937", words, place))  # numpy's twister gives the same fractions, many at a time
    each = max(1, block // n)
    for at in range(0, resamples, each):
        rows = min(each, resamples - at)
        picks = (draw.random_sample(rows * n) * n).astype(np.int64)
        medians.append(np.median(given[picks].reshape(rows, n), axis=1))
    ranked = np.sort(np.concatenate(medians))
    return tuple(float(ranked[round(q * (resamples - 1))]) for q in (0.025, 0.975))


def median_intervals(df: DataFrame, by: str, value: str, order: str, resamples: int = 10_000) -> DataFrame:
    """A row a group: n, median and its bootstrap interval; values are drawn in rising `order`. A group is a study's few values."""
    import pandas as pd

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        found = frame.sort_values(order, kind="stable")[value].dropna().tolist()
        low, high = median_interval(found, resamples) or (None, None)
        return pd.DataFrame({by: [frame[by].iloc[0]], "n": [len(found)], "median": [float(pd.Series(found).median()) if found else None], "low": [low], "high": [high]})

    return df.select(by, value, order).groupBy(by).applyInPandas(run, f"{by} {dict(df.dtypes)[by]}, n long, median double, low double, high double")


def worst(df: DataFrame, k: int = 5, wer: str = "wer", cer: str = "cer", key: str = "excerpt_id") -> DataFrame:
    return df.where(F.col(wer) > 0).orderBy(F.desc(wer), F.desc(cer), key).limit(k)


def by_category(df: DataFrame, categories: str, *sums: str) -> DataFrame:
    """Sums overall and per category; a row counts in each of its categories."""
    total = df.agg(F.count("*").alias("n"), *(F.sum(s).alias(s) for s in sums)).select(F.lit(None).cast("string").alias("category"), "n", *sums)
    each = df.withColumn("category", F.explode(F.array_distinct(categories))).groupBy("category").agg(F.count("*").alias("n"), *(F.sum(s).alias(s) for s in sums))
    return total.unionByName(each)


def blind(excerpts: DataFrame, candidates: Sequence[str], excerpt: str = "excerpt_id", seed: int = 0) -> DataFrame:
    """Every excerpt with every candidate in an order drawn per excerpt by hash: clip_id hides the candidate."""
    rows = excerpts.select(excerpt, F.explode(F.array(*map(F.lit, candidates))).alias("candidate"))
    order = Window.partitionBy(excerpt).orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(excerpt).cast("string"), "candidate")))
    rows = rows.withColumn("position", F.row_number().over(order))
    return rows.withColumn("clip_id", F.format_string("%s-%s", F.col(excerpt).cast("string"), F.char(F.lit(96) + F.col("position"))))


def checklist(df: DataFrame, chapter: str, key: str, flagged: str, each: int = 5) -> DataFrame:
    """All flagged rows, and `each` others of every chapter by hash of their keys."""
    order = Window.partitionBy(chapter).orderBy(F.sha2(F.col(key).cast("string"), 256))
    some = df.where(~F.col(flagged)).withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= each).drop("_k")
    return df.where(F.col(flagged)).unionByName(some)

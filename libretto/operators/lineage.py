"""Lineage: which artifacts are stale, which files differ, what need not be made again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stale(artifacts: DataFrame) -> DataFrame:
    """Dependencies of artifacts (path, sha256, dependencies array of (path, sha256)) that no longer hold: (path, dependency, problem)."""
    want = artifacts.select("path", F.explode("dependencies").alias("d")).select("path", F.col("d.path").alias("dependency"), F.col("d.sha256").alias("_w"))
    now = artifacts.select(F.col("path").alias("dependency"), F.col("sha256").alias("_n"))
    problem = F.when(F.col("_n").isNull(), "missing").when(F.col("_n") != F.col("_w"), "changed")
    return want.join(now, "dependency", "left").withColumn("problem", problem).where("problem is not null").select("path", "dependency", "problem")


def links_broken(expected: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Expected links (path, sha256) whose artifact is missing or has another hash."""
    now = artifacts.select("path", F.col("sha256").alias("actual"))
    return expected.join(now, "path", "left").where("actual is null or actual <> sha256")


def set_difference(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows on one side only, with side: missing or unexpected."""
    names = expected.columns
    return expected.exceptAll(actual.select(names)).withColumn("side", F.lit("missing")).unionByName(actual.select(names).exceptAll(expected).withColumn("side", F.lit("unexpected")))


def to_make(wanted: DataFrame, made: DataFrame, *keys: str) -> DataFrame:
    """Wanted rows that nothing was made for yet under the same content keys."""
    return wanted.join(made.select(*keys), list(keys), "left_anti")


def tree_hash(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """One row: the hash of a tree of files, from their sorted paths and hashes."""
    one = F.struct(F.col(path).alias("path"), F.sha2(F.col(content), 256).alias("sha256"))
    return files.agg(F.sha2(F.to_json(F.array_sort(F.collect_list(one))), 256).alias("sha256"))

"""Chunks: blocks cut into sentences, limited and packed, with pauses, ids and content hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from libretto.functions.sentences import limit_split, packed, rows_of, sentences

# Default pauses in ms.
PAUSES = {"none": 0, "clause": 150, "sentence": 250, "paragraph": 600, "chapter": 1500}


def content_hash(**fields: Column) -> Column:
    """SHA-256 of the fields' canonical JSON: names sorted, compact, nulls kept."""
    return F.sha2(F.to_json(F.struct(*(c.alias(n) for n, c in sorted(fields.items()))), {"ignoreNullFields": "false"}), 256)


def pause_ms(kind: Column, pauses: dict[str, int] = PAUSES) -> Column:
    out = F.lit(None).cast("int")
    for name, ms in pauses.items():
        out = F.when(kind == name, ms).otherwise(out)
    return out


def chunked(blocks: DataFrame, limit: int, language: str = "it", at_colons: bool = False, pack: bool = False, pauses: dict[str, int] = PAUSES) -> DataFrame:
    """Chunks of blocks (book_id, chapter_id, chapter_order, block_id, block_pos, display_text, spoken_text).

    Chunk ids are <block>.s<first>[-s<last>].p<part>. A chunk shows the display text's sentence if both
    texts have as many sentences, else all of the block's display text. `sequence` counts a book's
    chunks from 0: chapters have offsets, so that no window spans a whole book's rows.
    """
    b = blocks.withColumn("_s", sentences(F.col("spoken_text"), at_colons))
    b = b.withColumn("_d", F.when(F.col("display_text") == F.col("spoken_text"), F.col("_s")).otherwise(sentences(F.col("display_text"), at_colons)))
    if pack:
        b = b.withColumn("_u", packed(F.col("_s"), limit))
    else:
        b = b.withColumn("_u", F.transform("_s", lambda s, i: F.struct(s.alias("text"), i.cast("int").alias("first"), i.cast("int").alias("last"))))
    b = limit_split(b.withColumn("_t", F.transform("_u", lambda u: u["text"])), "_t", limit, "_p")
    units = rows_of(b, F.arrays_zip("_u", "_p"), "*", pos="_n", value="_z")
    parts = rows_of(units, F.col("_z._p"), "*", pos="_part", value="spoken")
    first, last = F.col("_z._u.first"), F.col("_z._u.last")
    name = F.when(first == last, F.format_string("s%04d", first)).otherwise(F.format_string("s%04d-s%04d", first, last))
    same = F.size("_s") == F.size("_d")
    shown = F.when(same, F.array_join(F.slice("_d", first + 1, last - first + 1), " ")).otherwise(F.col("display_text"))
    rows = parts.select(
        "book_id", "chapter_id", "chapter_order", F.col("block_id").alias("paragraph_id"), "block_pos", first.alias("_first"), F.col("_part"),
        F.concat_ws(".", "block_id", name).alias("sentence_id"), F.concat_ws(".", "block_id", name, F.format_string("p%04d", "_part")).alias("chunk_id"),
        shown.alias("display_text"), F.col("spoken").alias("spoken_text"),
    )
    order = Window.partitionBy("book_id", "chapter_order").orderBy("block_pos", "_first", "_part")
    ends = Window.partitionBy("book_id").orderBy("chapter_order").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("book_id", "chapter_order").agg(F.count("*").alias("_c")).withColumn("_before", F.coalesce(F.sum("_c").over(ends), F.lit(0))).drop("_c")
    rows = rows.join(counts, ["book_id", "chapter_order"]).withColumn("_k", F.row_number().over(order))
    before = F.lag("spoken_text").over(order)
    kind = (
        F.when(F.col("_k") == 1, "chapter")
        .when(F.lag("paragraph_id").over(order) != F.col("paragraph_id"), "paragraph")
        .when(F.col("_part") > 0, "none")
        .when(before.endswith(":"), "clause")
        .otherwise("sentence")
    )
    rows = rows.withColumn("sequence", (F.col("_before") + F.col("_k") - 1).cast("int")).withColumn("_kind", kind)
    digest = content_hash(chapter_id=F.col("chapter_id"), expected_language=F.lit(language), paragraph_id=F.col("paragraph_id"), sentence_id=F.col("sentence_id"), spoken_text=F.col("spoken_text"))
    return rows.select(
        "book_id", "chunk_id", "chapter_id", "paragraph_id", "sentence_id", "sequence", "display_text", "spoken_text", F.lit(language).alias("expected_language"),
        F.struct(F.col("_kind").alias("break_before"), pause_ms(F.col("_kind"), pauses).alias("duration_ms")).alias("pause"), digest.alias("content_sha256"),
    )


def anomalies(chunks: DataFrame, limit: int) -> DataFrame:
    """Chunks whose sequence has a gap, whose text is over the limit or whose break isn't the one their neighbours ask for."""
    order = Window.partitionBy("book_id").orderBy("sequence")
    prev = lambda c: F.lag(c).over(order)
    wanted = (
        F.when(prev("chapter_id").isNull() | (prev("chapter_id") != F.col("chapter_id")), "chapter")
        .when(prev("paragraph_id") != F.col("paragraph_id"), "paragraph")
        .when(prev("sentence_id") == F.col("sentence_id"), "none")
        .when(prev("spoken_text").endswith(":"), "clause")
        .otherwise("sentence")
    )
    found = F.array_compact(F.array(
        F.when(F.col("sequence") != F.coalesce(prev("sequence") + 1, F.lit(0)), "sequence"),
        F.when(F.length("spoken_text") > limit, "limit"),
        F.when(F.col("pause.break_before") != wanted, "break"),
    ))
    return chunks.withColumn("anomalies", found).where(F.size("anomalies") > 0)


def outliers(df: DataFrame, length: Column, limit: int, short: int = 20, percent: int = 90) -> DataFrame:
    """Rows with column outlier: short, or near the character limit."""
    near = -(-limit * percent // 100)
    return df.withColumn("outlier", F.when(length < short, "short").when(length >= near, "near character limit")).where("outlier is not null")


def length_stats(df: DataFrame, length: Column, limit: int, *by: str) -> DataFrame:
    """n, shortest, longest, at_limit, median and p95 (nearest rank, upper) of the lengths.

    Lengths are counted first, so that a group is as long as it has different lengths, however
    many rows it has; the ranks are running counts over those.
    """
    counts = df.groupBy(*by, length.alias("_l")).agg(F.count("*").alias("_c"))
    ran = Window.partitionBy(*by).orderBy("_l")
    counts = counts.withColumn("_upto", F.sum("_c").over(ran)).withColumn("_n", F.sum("_c").over(Window.partitionBy(*by)))
    at = lambda p: F.min(F.when(F.col("_upto") > F.floor(((F.col("_n") - 1) * p + 99) / 100), F.col("_l")))
    return counts.groupBy(*by).agg(
        F.sum("_c").alias("n"), F.min("_l").alias("shortest"), F.max("_l").alias("longest"),
        F.coalesce(F.sum(F.when(F.col("_l") >= limit, F.col("_c"))), F.lit(0)).alias("at_limit"), at(50).alias("median"), at(95).alias("p95"),
    )

"""The text stages, each in one call and over any number of books: ingest, normalize, chunk, and all of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from libretto.functions import rules
from libretto.functions.text import preview
from libretto.operators import chapters, chunks, reviews
from libretto.sources.ast import AstBlocks
from libretto.sources.lexicons import BUILT_IN, Entry


def ingest(books: DataFrame, exclude: Sequence[str] = (), level: int = 1, fallback: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(blocks, exclusions) of books (book_id, ast). Exclusions: what the reader can't narrate, blocks of the kinds in
    `exclude`, what a bibliography holds. A book without an AST gives rows of neither."""
    rows = books.select("book_id", "ast").lateralJoin(AstBlocks(F.col("ast").outer())).drop("ast").withColumnRenamed("text", "display_text")
    reader = rows.where("reason is not null").select("book_id", "pos", F.col("reason").alias("reason_code"), F.col("kind").alias("description"))
    stay, named = chapters.diverted(rows.where("reason is null"), list(exclude))
    placed = chapters.segmented(stay, text="display_text", at=level, fallback=fallback)
    listed = placed.where("excluded").select("book_id", "pos", F.lit("bibliography").alias("reason_code"), preview(F.col("display_text")).alias("description"))
    chapter, block = chapters.ids(F.col("chapter_no"), F.col("block_no"))
    blocks = placed.where("not excluded").select(
        "book_id", "pos", chapter.alias("chapter_id"), F.col("chapter_no").alias("chapter_order"), "chapter_title", block.alias("block_id"), F.col("block_no").alias("block_pos"),
        "kind", "display_text", chapters.own_warnings(F.col("warnings"), F.col("kind")).alias("warnings"),
    )
    return blocks, reader.unionByName(named.select("book_id", "pos", "reason_code", "description")).unionByName(listed)


def normalize(blocks: DataFrame, entries: Sequence[Entry] = BUILT_IN) -> DataFrame:
    """blocks with spoken_text and transformations; the rules' warnings stand behind the reader's."""
    out = rules.normalized(blocks.withColumnRenamed("warnings", "_read"), "display_text", entries, "kind")
    return out.withColumn("warnings", F.concat("_read", "warnings")).drop("_read")


def chunk(blocks: DataFrame, limit: int, language: str = "it", pack: bool = False) -> DataFrame:
    """Chunks of normalized blocks that say something."""
    return chunks.chunked(blocks.where(F.trim("spoken_text") != ""), limit, language, pack=pack)


def run(books: DataFrame, limit: int, exclude: Sequence[str] = (), level: int = 1, language: str = "it") -> dict[str, DataFrame]:
    """All text stages: blocks, exclusions, chunks, and a summary row a book."""
    blocks, gone = ingest(books, exclude, level)
    said = normalize(blocks)
    return {"blocks": said, "exclusions": gone, "chunks": chunk(said, limit, language), "summary": reviews.ingest_summary(said, gone)}

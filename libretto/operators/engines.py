"""What an engine says of itself, held against the requests it gets and the results it gives."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Capabilities:
    """named_voices: none named means that any name will do."""

    engine: str
    model: str
    sample_rate_hz: int
    longest_text: int | None = None
    reference_voices: bool = False
    named_voices: tuple[str, ...] | None = ()
    seed: bool = True
    speed: bool = True
    temperature: bool = False


def pinned(have: Capabilities, engine: str, model: str, health: tuple[str, str, bool, str]) -> None:
    """The engine must be the candidate's by its capabilities and by its health (engine, model, healthy, detail), and be well."""
    if (have.engine, have.model) != (engine, model) or health[:2] != (engine, model):
        raise ValueError(f"the engine is not the pinned {engine}, {model}")
    if not health[2]:
        raise ValueError(f"{engine} is not well: {health[3]}")


def refused(have: Capabilities, voice: str = "voice_id", reference: str = "reference_path") -> Column:
    """Why the engine can't serve a request, the first reason of these; null if it can.

    Columns: spoken_text, sample_rate_hz, seed, speed, temperature, and those that name the voice. named_voices None: it
    knows no named ones.
    """
    out = F.when(F.col("sample_rate_hz") != have.sample_rate_hz, "sample-rate")
    if have.longest_text is not None:
        out = out.when(F.length("spoken_text") > have.longest_text, "text-length")
    referred = F.col(reference).isNotNull()
    if not have.reference_voices:
        out = out.when(referred, "reference-voice")
    if have.named_voices is None:
        out = out.when(~referred, "named-voice")
    elif have.named_voices:
        out = out.when(~referred & ~F.coalesce(F.col(voice).isin(*have.named_voices), F.lit(False)), "unknown-voice")
    if not have.seed:
        out = out.when(F.col("seed") != 0, "seed")
    if not have.speed:
        out = out.when(F.col("speed") != 1.0, "speed")
    if not have.temperature:
        out = out.when(F.col("temperature").isNotNull(), "temperature")
    return out


def mismatched(results: DataFrame, requests: DataFrame, key: str, same: list[str], rate: int) -> DataFrame:
    """Results that differ from their request in one of the columns `same`, or aren't at the engine's rate: key and the names."""
    asked = requests.select(key, *(F.col(c).alias(f"_{c}") for c in same))
    wrong = [F.when(~F.col(c).eqNullSafe(F.col(f"_{c}")), F.lit(c)) for c in same]
    rated = F.when(~F.col("result_rate_hz").eqNullSafe(F.lit(rate)), F.lit("result_rate_hz"))
    rows = results.join(asked, key, "left").select(key, F.array_compact(F.array(*wrong, rated)).alias("wrong"))
    return rows.where(F.size("wrong") > 0)

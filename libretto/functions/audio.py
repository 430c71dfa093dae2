"""PCM audio: WAV bytes, float samples, quality ratios and a deterministic synthetic voice."""

from __future__ import annotations

import hashlib
import io
import math
import struct
import wave
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType

#: Silence below -50 dBFS, clipping from 32760 on.
SILENT, CLIPPED = round(32767 * 10 ** (-50 / 20)), 32760
MULTIPLIER, INCREMENT = 6364136223846793005, 1442695040888963407


def wav_bytes(pcm: bytes, rate: int) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(pcm)
    return out.getvalue()


def wav_problem(data: bytes, rate: int) -> tuple[int, str | None]:
    """(frames, what is wrong) of WAV bytes that must be mono, 16 bit, uncompressed and whole."""
    try:
        with wave.open(io.BytesIO(data)) as w:
            frames = w.getnframes()
            if w.getnchannels() != 1:
                return frames, "channels"
            if w.getsampwidth() != 2 or w.getcomptype() != "NONE":
                return frames, "encoding"
            if w.getframerate() != rate:
                return frames, "sample-rate"
            if not frames:
                return 0, "empty"
            return frames, None if len(w.readframes(frames)) == 2 * frames else "truncated"
    except (wave.Error, EOFError, struct.error):
        return 0, "not a WAV file"


def pcm_of(samples) -> bytes:
    """Floats as 16-bit PCM, clipped, cut toward zero; ValueError if there are none or not finite ones."""
    import numpy as np

    x = np.asarray(samples, dtype=np.float64)
    if not x.size or not np.isfinite(x).all():
        raise ValueError("samples must be finite, and some")
    return np.clip(np.trunc(x * 32768), -32768, 32767).astype("<i2").tobytes()


def voice(text: str, seed: int, rate: int = 24_000, speed: float = 1.0) -> bytes:
    """Deterministic PCM for a text: a 64-bit congruential generator seeded by text and seed."""
    import numpy as np

    state = int.from_bytes(hashlib.sha256(f"{seed}\0{text}".encode()).digest()[:8], "little")
    frames = max(1, round(max(0.08, 0.012 * len(text) / speed) * rate))
    # x_k = m^k x + c (m^k - 1)/(m - 1): both factors by doubling
    power, total, filled = np.ones(frames, dtype=np.uint64), np.zeros(frames, dtype=np.uint64), 1
    with np.errstate(over="ignore"):
        m, c = np.uint64(MULTIPLIER), np.uint64(INCREMENT)
        pm, pc = m, c
        while filled < frames:
            n = min(filled, frames - filled)
            power[filled : filled + n] = power[:n] * pm
            total[filled : filled + n] = total[:n] * pm + pc
            pm, pc, filled = pm * pm, pc * pm + pc, filled + n
        states = power * (np.uint64(state) * m + c) + total
    return (((states >> np.uint64(48)) & np.uint64(0x3FFF)).astype(np.int64) - 8192).astype("<i2").tobytes()


def synthesised(df: DataFrame, text: str = "spoken_text", seed: str = "seed", rate: int = 24_000, speed: float = 1.0) -> DataFrame:
    """df with pcm and frames from the synthetic voice; the boundary where a real engine plugs in."""
    schema = df.select("*").schema.add("pcm", BinaryType()).add("frames", LongType())

    def run(frame: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frame:
            found = [voice(t or "", s or 0, rate, speed) for t, s in zip(batch.column(text).to_pylist(), batch.column(seed).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary()), pa.array([len(x) // 2 for x in found], pa.int64())], names=[*batch.schema.names, "pcm", "frames"])

    return df.mapInArrow(run, schema)


def quality(samples: Column) -> dict[str, Column]:
    """silence_ratio, clipped_sample_ratio and peak_dbfs (within -120 and 0) of an array of integer samples; native."""
    n = F.size(samples)
    share = lambda test: F.size(F.filter(samples, test)) / n
    peak = F.array_max(F.transform(samples, lambda s: F.abs(s)))
    dbfs = F.when(peak <= 0, F.lit(-120.0)).otherwise(F.greatest(F.lit(-120.0), F.least(F.lit(0.0), 20 * F.log10(peak / F.lit(32768)))))
    return {"silence_ratio": share(lambda s: F.abs(s) <= SILENT), "clipped_sample_ratio": share(lambda s: F.abs(s) >= CLIPPED), "peak_dbfs": dbfs}


def pcm_quality(pcm: bytes) -> tuple[float, float, float]:
    """The same of PCM bytes."""
    import numpy as np

    x = np.abs(np.frombuffer(pcm, dtype="<i2").astype(np.int32))
    if not len(x):
        return 1.0, 0.0, -120.0
    peak = int(x.max())
    return float((x <= SILENT).mean()), float((x >= CLIPPED).mean()), max(-120.0, min(0.0, 20 * math.log10(peak / 32768))) if peak else -120.0

"""Exact top-k search by inner product with pivot-table elimination.

Vectors are taken as integers, floor(scale * x). A table holds each row's distances to PIVOTS
pivots (rows of a bounded sample, chosen farthest first). For a query q and a row x, the largest
|d(q, p) - d(x, p)| over the pivots p bounds d(q, x) from below, and so the inner product
(|q|^2 + |x|^2 - d(q, x)^2) / 2 from above; the rows' norms give |q||x| as a further bound. Rows are
evaluated in the order of that bound until the next bound is below the k-th score found, so the
result is exact, with ties to the smaller id.

Rows are dealt into blocks of about BLOCK and queries into chunks of QUERIES; each pair of a block
and a chunk is one bounded unit of work that keeps at most k rows for a query, and the blocks'
rows are merged by a sum of the k best. Nothing is broadcast but the pivots, at most PIVOTS
vectors.

Vectors that are null or hold null or non-finite components take no part, nor do rows without an
id; vectors of different length have no score. A repeated id is a row of its own, but never its
own partner. Components and scores beyond a long count as the nearest long. Fewer than k partners give all of them; no query row gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from libretto.llm.common import grouped, partitions, stored

PIVOTS, SAMPLE, BLOCK, QUERIES = 32, 4096, 8192, 512


def integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component; null where the vector takes no part."""
    x = F.transform(vector, lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(fine, F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def pivots_of(rows: DataFrame, count: int, sample: int):
    """Farthest-first pivots by vector length, out of a bounded sample of rows (lowest hashes of their ids)."""
    import numpy as np

    found = {}
    for r in rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").collect():
        found.setdefault(len(r.v), []).append(r.v)
    out = {}
    for size, vectors in found.items():
        x = np.array(vectors, dtype=np.float64).reshape(len(vectors), size)
        picked, gap = [0], np.linalg.norm(x - x[0], axis=1)
        while len(picked) < min(count, len(x)) and gap.max() > 0:
            picked.append(int(gap.argmax()))
            gap = np.minimum(gap, np.linalg.norm(x - x[picked[-1]], axis=1))
        out[size] = x[picked]
    return out


def topk(df: DataFrame, is_query: Column, k: int, scale: int = 256, key: str = "vec_id", vector: str = "embedding", block: int = BLOCK, chunk: int = QUERIES) -> DataFrame:
    """Rows query_id, rank (from 1), <key>, score: for each query row its k best other rows."""
    spark = df.sparkSession
    rows = stored(df.select(F.col(key).cast("long").alias("id"), integers(F.col(vector), scale).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")).where("id is not null and v is not null"))
    counts = rows.agg(F.count("*").alias("n"), F.count_if("q").alias("q")).first()
    blocks, chunks = max(1, -(-counts.n // block)), max(1, -(-counts.q // chunk))
    pivots = pivots_of(rows, PIVOTS, SAMPLE)
    rows = stored(rows.mapInArrow(lambda frame: tabled(frame, pivots), "id long, v array<long>, q boolean, d array<double>"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    base = rows.select("id", "v", "d", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("b"), F.lit(0).alias("side"), every(chunks).alias("c"))
    asks = rows.where("q").select("id", "v", "d", every(blocks).alias("b"), F.lit(1).alias("side"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(chunks)).cast("int").alias("c"))
    units = max(1, min(blocks * chunks, 4 * partitions(spark)))
    dealt = base.unionByName(asks).repartition(units, "b", "c").sortWithinPartitions("b", "c", "side", "id")

    def run(frame: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in grouped(frame, ["b", "c"]):
            for found in best(unit, k):
                yield pa.RecordBatch.from_arrays([pa.array(x, type=pa.int64()) for x in found], names=["query_id", "id", "score"])

    near = dealt.mapInArrow(run, "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(key), "score")


def saturated(scores):
    """Whole numbers of any length as longs; what a long can't hold becomes the nearest it can."""
    import numpy as np

    return np.array([min(max(int(s), -(2**63)), 2**63 - 1) for s in np.atleast_1d(scores)], dtype=np.int64)


def tabled(frame: Iterator[pa.RecordBatch], pivots: dict) -> Iterator[pa.RecordBatch]:
    """The pivot table: each row with d, its distances to the pivots of its length."""
    import numpy as np

    for batch in frame:
        v = batch.column("v")
        sizes = np.asarray(pc.list_value_length(v))
        far = [np.empty(0)] * batch.num_rows
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            x = np.asarray(v.take(pa.array(at)).flatten(), dtype=np.float64).reshape(len(at), size)
            d = np.stack([np.sqrt(((x - p) ** 2).sum(1)) for p in pivots[int(size)]], axis=1) if len(pivots.get(int(size), ())) else np.empty((len(at), 0))
            for i, row in zip(at.tolist(), d, strict=True):
                far[i] = row
        ends = np.cumsum([0, *map(len, far)]).astype(np.int32)
        d = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(far) if far else np.empty(0)))
        yield pa.RecordBatch.from_arrays([batch.column("id"), v, batch.column("q"), d], names=["id", "v", "q", "d"])


def best(unit: pa.Table, k: int) -> Iterator[tuple]:
    """The k best rows (query id, row id, score) of each query within one unit."""
    import numpy as np

    side, ids = unit["side"].to_numpy(), unit["id"].to_numpy()
    sizes = np.array([len(x) for x in unit["v"]])
    for size in np.unique(sizes[side == 1]):
        at, ask = np.flatnonzero((sizes == size) & (side == 0)), np.flatnonzero((sizes == size) & (side == 1))
        if not len(at):
            continue
        take = lambda ix: np.asarray(unit["v"].take(pa.array(ix)).combine_chunks().flatten()).reshape(len(ix), size)  # noqa: B023,E731
        x, q = take(at), take(ask)
        wide = max(int(np.abs(x).max(initial=0)), int(np.abs(q).max(initial=0)))
        if wide * wide * max(1, int(size)) >= 2**52:  # beyond doubles' exact integers: whole numbers of any length
            x, q = (np.array(m.tolist(), dtype=object).reshape(m.shape) for m in (x, q))
        xf, qf = x.astype(np.float64), q.astype(np.float64)
        x2, q2 = (xf * xf).sum(1), (qf * qf).sum(1)
        far = np.zeros((len(q), len(x)))
        tx, tq = (np.asarray(unit["d"].take(pa.array(ix)).combine_chunks().flatten()).reshape(len(ix), -1) for ix in (at, ask))
        for dx, dq in zip(tx.T, tq.T, strict=True):
            np.maximum(far, np.abs(dq[:, None] - dx[None, :]), out=far)
        bound = np.minimum((q2[:, None] + x2[None, :] - far * far) / 2, np.sqrt(q2)[:, None] * np.sqrt(x2)[None, :])
        bound += 1e-9 * (q2[:, None] + x2[None, :]) + 1e-6  # rounding of the bound itself
        xid = ids[at]
        for i, me in enumerate(ids[ask]):
            order = np.argsort(-bound[i], kind="stable")
            got_id, got = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
            start, step = 0, max(64, 4 * k)
            while start < len(order):
                if len(got) >= k and bound[i, order[start]] < got[k - 1]:
                    break
                ix = order[start : start + step]
                ix = ix[xid[ix] != me]
                score = saturated(x[ix] @ q[i]) if x.dtype == object else (xf[ix] @ qf[i]).astype(np.int64)
                got, got_id = np.concatenate([got, score]), np.concatenate([got_id, xid[ix]])
                rank = np.lexsort((got_id, ~got))[:k]  # ~ turns the order of longs around without overflow
                got, got_id = got[rank], got_id[rank]
                start, step = start + step, step * 2
            if len(got):
                yield np.full(len(got), me), got_id, got

"""Embedding near-duplicates by product quantisation.

Vectors are scaled to length 1. A coarse quantiser (k-means on a bounded sample of TRAIN rows)
makes inverted lists; each vector stands in its PROBES nearest lists with the code of its
residual, one byte for each subspace, and the residual's quantisation error. Within a list,
distances from a vector to codes come from asymmetric lookup tables. With error e and bound
t = sqrt(2 - 2 * cosine), a pair can only link if its table distance is at most t + e (triangle
inequality), so the table loses no link among vectors of a list; what it leaves is reranked by the
exact cosine in double precision. A pair that meets in several lists counts in the first only.

Bitwise equal vectors are one class, compared once. Lists larger than CHUNK are cut into chunks
that meet pairwise, so a unit of work is bounded; units return numbers of links and a spanning
forest, never the pairs. Components are found over the forests.

Vectors that are null, zero, or hold null or non-finite components link with nothing, nor do
vectors of different length with each other; a row without an id takes no part and is kept.
Repeated rows are vectors of their own and link with each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from libretto.llm.common import block_units, components, forest, grouped, stored

COSINE, TRAIN, LISTS, PROBES, PARTS, CODES, CHUNK = 0.9, 16384, (4, 1024, 128), 4, 8, 256, 2048


def usable(vector: Column) -> Column:
    """The vector as doubles; null where it links with nothing."""
    x = F.transform(vector, lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    return F.when(fine, x)


def unit(x):
    """Rows scaled to length 1, also where squares would overflow or vanish."""
    import numpy as np

    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def matrix(column, width: int):
    """A list column as rows of `width` doubles, shorter vectors padded with zeros; and their lengths."""
    import numpy as np

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.asarray(pa.compute.list_value_length(column))
    flat = np.asarray(column.flatten(), dtype=np.float64)
    if (size == width).all():
        return flat.reshape(-1, width), size
    out = np.zeros((len(size), width))
    out[np.arange(width) < size[:, None]] = flat
    return out, size


def nearest(x, centres, k: int):
    """Indices of the k nearest centres of each row, nearest first."""
    import numpy as np

    d = (centres**2).sum(1)[None, :] - 2 * x @ centres.T
    if k >= d.shape[1]:
        return np.argsort(d, axis=1, kind="stable")
    part = np.argpartition(d, k - 1, axis=1)[:, :k]
    return np.take_along_axis(part, np.argsort(np.take_along_axis(d, part, 1), axis=1, kind="stable"), 1)


def kmeans(x, k: int, rounds: int, seed: int):
    import numpy as np

    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), size=min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = np.concatenate([nearest(x[i : i + 4096], centres, 1)[:, 0] for i in range(0, len(x), 4096)])
        count = np.bincount(own, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, own, x)
        full = count > 0
        centres[full] = total[full] / count[full, None]
    return centres


class Index:
    """Coarse centres and residual codebooks; the model that every task shares."""

    def __init__(self, sample, lists: int, parts: int = PARTS, codes: int = CODES, seed: int = 5):
        import numpy as np

        self.width = sample.shape[1]
        self.centres = kmeans(sample, lists, 12, seed)
        rest = sample - self.centres[nearest(sample, self.centres, 1)[:, 0]]
        self.cuts = np.array_split(np.arange(self.width), min(parts, self.width))
        self.books = [kmeans(rest[:, c], codes, 8, seed + 1 + i) for i, c in enumerate(self.cuts)]

    def encode(self, x, lists):
        """Codes (rows, parts) of the residuals of x to its lists, and the codes' errors."""
        import numpy as np

        rest = x - self.centres[lists]
        code = np.stack([nearest(rest[:, c], b, 1)[:, 0] for c, b in zip(self.cuts, self.books, strict=True)], axis=1).astype(np.uint8)
        error = np.sqrt(sum(((rest[:, c] - b[code[:, i]]) ** 2).sum(1) for i, (c, b) in enumerate(zip(self.cuts, self.books, strict=True))))
        return code, error

    def tables(self, x, one: int):
        """For each row, squared distances of its residual's parts to the codebooks."""
        rest = x - self.centres[one]
        return [((rest[:, c] ** 2).sum(1)[:, None] - 2 * rest[:, c] @ b.T + (b**2).sum(1)[None, :]) for c, b in zip(self.cuts, self.books, strict=True)]


def pairs_of(index: Index, one: int, x, size, probes, code, error, a, b, cosine: float):
    """Pairs (i of a, j of b, as row numbers) that link and that count in list `one`."""
    import numpy as np

    reach = math.sqrt(max(0.0, 2 - 2 * cosine)) + error[b][None, :] + 1e-9
    out_i, out_j = [], []
    for at in range(0, len(a), 256):
        i = a[at : at + 256]
        far = np.zeros((len(i), len(b)))
        for part, t in enumerate(index.tables(x[i], one)):
            far += t[:, code[b, part]]
        p, q = np.nonzero(far <= reach * reach)
        p, q = i[p], b[q]
        ok = (p != q) & (size[p] == size[q])
        p, q = p[ok], q[ok]
        for cut in range(0, len(p), 1 << 16):
            r, s = p[cut : cut + (1 << 16)], q[cut : cut + (1 << 16)]
            ok = (x[r] * x[s]).sum(1) >= cosine
            r, s = r[ok], s[ok]
            if len(r):
                shared = (probes[r][:, :, None] == probes[s][:, None, :]).any(2)
                first = np.where(shared, probes[r], np.iinfo(np.int32).max).min(1)
                r, s = r[first == one], s[first == one]
                out_i.append(r)
                out_j.append(s)
    none = np.empty(0, dtype=np.int64)
    return (np.concatenate(out_i), np.concatenate(out_j)) if out_i else (none, none)


def linked(df: DataFrame, cosine: float = COSINE, key: str = "vec_id", vector: str = "embedding", probes: int = PROBES, train: int = TRAIN, chunk: int = CHUNK) -> DataFrame:
    """Rows <key>, n_links, component_id, kept: one for each row of df."""
    spark = df.sparkSession
    kind = dict(df.dtypes)[vector]  # vectors travel in their own type; all arithmetic is in doubles
    rows = df.select(F.col(key).cast("long").alias("id"), F.when(usable(F.col(vector)).isNotNull() & F.col(key).isNotNull(), F.col(vector)).alias("v"))
    rows = rows.withColumn("h1", F.when(F.col("v").isNotNull(), F.xxhash64("v"))).withColumn("h2", F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(1), "v")))
    fine = rows.where("v is not null")
    classes = fine.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("n"))
    reps = stored(fine.join(classes, ["h1", "h2"]).where("id = rep").dropDuplicates(["h1", "h2"]).select("h1", "h2", "rep", "n", "v"))
    about = reps.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    if not about.n:
        return df.select(F.col(key), F.lit(0).cast("long").alias("n_links"), F.col(key).cast("long").alias("component_id"), F.lit(True).alias("kept"))
    width = about.width
    sample = reps.orderBy(F.xxhash64("h1"), "h2").limit(train).select("v").toArrow()["v"]
    least, most, each = LISTS
    model = Index(unit(matrix(sample, width)[0]), max(least, min(most, about.n // each)))
    shared = spark.sparkContext.broadcast(model)  # at most LISTS centres and PARTS x CODES codes
    probes = min(probes, len(model.centres))

    def insert(frame: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        index = shared.value
        for batch in frame:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                x, size = matrix(part.column("v"), width)
                x = unit(x)
                near = np.sort(nearest(x, index.centres, probes), axis=1).astype(np.int32)
                for p in range(probes):
                    code, error = index.encode(x, near[:, p])
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(c) for c in ("h1", "h2", "rep", "n")), pa.array(near[:, p]), listed(near), pa.array([r.tobytes() for r in code], pa.binary()), pa.array(error), pa.array(size.astype(np.int32)), part.column("v")],
                        names=["h1", "h2", "rep", "n", "list", "probes", "code", "error", "size", "x"],
                    )

    lists = stored(reps.mapInArrow(insert, f"h1 long, h2 long, rep long, n long, list int, probes array<int>, code binary, error double, size int, x {kind}"))
    sizes = lists.groupBy("list").agg(F.ceil(F.count("*") / F.lit(chunk)).cast("int").alias("chunks"))
    dealt = block_units(lists.join(F.broadcast(sizes), "list"), "list", "chunks", ["h1", "h2"])  # a row a list, of LISTS at most

    def search(frame: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        index = shared.value
        for t in grouped(frame, ["list", "_a", "_b"]):
            one, ca, cb = t["list"][0].as_py(), t["_a"][0].as_py(), t["_b"][0].as_py()
            own, n, rep = t["_own"].to_numpy(), t["n"].to_numpy(), t["rep"].to_numpy()
            x = unit(matrix(t["x"], width)[0])
            near = np.asarray(t["probes"].combine_chunks().flatten()).reshape(len(x), -1)
            code = np.frombuffer(b"".join(t["code"].to_pylist()), dtype=np.uint8).reshape(len(x), -1)
            a, b = np.flatnonzero(own == ca), np.flatnonzero(own == cb)
            i, j = pairs_of(index, one, x, t["size"].to_numpy(), near, code, t["error"].to_numpy(), a, b, cosine)
            if ca == cb:
                i, j = i[i < j], j[i < j]
            if not len(i):
                continue
            count = np.bincount(i, n[j], len(x)) + np.bincount(j, n[i], len(x))
            order = np.argsort(rep, kind="stable")  # the forest's roots are the smallest ids
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            root = np.asarray(forest(len(x), rank[i], rank[j]))
            hit = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([t["h1"].combine_chunks().take(pa.array(hit)), t["h2"].combine_chunks().take(pa.array(hit)), pa.array(rep[hit]), pa.array(rep[order[root[rank[hit]]]]), pa.array(count[hit].astype(np.int64))], names=["h1", "h2", "rep", "low", "links"])

    found = stored(dealt.mapInArrow(search, "h1 long, h2 long, rep long, low long, links long"))
    part = components(found.select(F.col("rep").alias("u"), F.col("low").alias("v")))
    links = found.groupBy("h1", "h2").agg(F.sum("links").alias("links"))
    known = classes.join(links, ["h1", "h2"], "left").join(part, classes["rep"] == part["node"], "left")
    known = known.select("h1", "h2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("_n"), F.coalesce("component", "rep").alias("_c"))
    out = rows.select("id", "h1", "h2").join(known, ["h1", "h2"], "left")
    component = F.coalesce("_c", "id")
    return out.select(F.col("id").alias(key), F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def listed(x) -> pa.ListArray:
    """A matrix as a list column."""
    import numpy as np

    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1] if x.size else 1, dtype=np.int32)), pa.array(x.reshape(-1)))

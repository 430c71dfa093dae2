"""What the operators share: tables, shared storage, connected components, streamed groups."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of bytes that are neither space nor tab .. carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where the session names none, a local master uses
    one in its warehouse; a cluster must name one."""
    if not (path := spark.conf.get("spark.checkpoint.dir", None)):
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


#: Rows of ids and numbers that make a file of some MB.
FILE_ROWS = 200_000
#: On file: paths no checksum file stands beside each file, which halves the number of files.
PLAIN = {"compression": "zstd", "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def stored(df: DataFrame, rows: int | None = None) -> DataFrame:
    """The rows of df, written once to the shared folder; readers survive lost executors.

    rows: a bound on the number of rows where it is known, so that small tables get few files.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/libretto/{uuid.uuid4().hex}"
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // FILE_ROWS)))
    df.write.options(**PLAIN).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """As stored(), dealt to n buckets by hash of keys, so that later joins on all keys don't shuffle it again."""
    spark = df.sparkSession
    name = f"libretto_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/libretto/{name}"
    df.repartition(n, *keys).write.options(**PLAIN).option("path", path).bucketBy(n, *keys).sortBy(*keys).saveAsTable(name)
    return spark.table(name)


#: Bytes of text in a bucket of bucketed(), about.
BUCKET_BYTES = 32 << 20


def buckets(spark: SparkSession, size: int) -> int:
    """Buckets for so many bytes of text; with fewer than shuffles have partitions, joins would deal them anew."""
    return max(partitions(spark), -(-size // BUCKET_BYTES))


def unrepeated(frame: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of frame but those whose keys equal the row's before; in sorted rows, each key's first."""
    import numpy as np

    last = None
    for batch in frame:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        new[0] = last != tuple(c[0] for c in columns)
        last = tuple(c[-1] for c in columns)
        yield batch if new.all() else batch.filter(pa.array(new))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows in an Arrow batch of whole texts, at most.
BATCH_ROWS = 1000


def lean(spark: SparkSession) -> None:
    """Whole texts cross to Python in batches of few rows, as a batch stands in memory several times."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def batches(frame: Iterator[pa.RecordBatch], text: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each has about `most` bytes in column `text`; a longer text stands alone."""
    import numpy as np

    for batch in frame:
        if not batch.num_rows:
            continue
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
        total, start = np.cumsum(size), 0
        while start < len(size):
            before = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, before + most, side="right")))
            yield batch.slice(start, end - start)
            start = end


def grouped(frame: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Groups of equal keys from batches sorted by keys; many small groups come without a call for each."""
    import numpy as np

    held: list[pa.RecordBatch] = []

    def same(a: pa.RecordBatch, i: int, b: pa.RecordBatch, j: int) -> bool:
        return all(a.column(k)[i].as_py() == b.column(k)[j].as_py() for k in keys)

    for batch in frame:
        n = batch.num_rows
        if not n:
            continue
        new = np.zeros(n, dtype=bool)
        for k in keys:
            c = batch.column(k).to_numpy(zero_copy_only=False)
            new[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(new).tolist(), n]
        if held and not same(held[-1], held[-1].num_rows - 1, batch, 0):
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            if b < n:
                yield pa.Table.from_batches([*held, batch.slice(a, b - a)])
                held = []
            else:
                held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of undirected edges (u, v): rows (node, component), its smallest node.

    Alternates large-star and small-star steps until every node points at the smallest node it
    reaches. Minima per node are pre-aggregated and stored, so that the joins on nodes have plain
    exchanges on both sides and a node with very many edges is split; each round is written to the
    shared folder.
    """
    e = edges.select("u", "v").where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e, before = stored(e), None
    n = e.count()
    for _ in range(most_rounds if n else 0):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), 2 * n)
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        near = stored(large.where("u <> v").distinct(), n)
        least = stored(near.groupBy("u").agg(F.min("v").alias("m")), n)
        small = near.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        e = stored(small.where("u <> v").distinct(), 2 * n)
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % (1 << 40)).alias("sum")).first()
        if now == before:
            break
        n, before = now.n, now
    else:
        if n:
            raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), "v")).groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.col("v").alias("component"))


def clear(spark: SparkSession) -> None:
    """Delete everything that operators have stored in the shared folder; nothing may read it any more."""
    for t in spark.catalog.listTables():
        if t.name.startswith("libretto_"):
            spark.sql(f"DROP TABLE IF EXISTS {t.name}")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/libretto")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def block_units(df: DataFrame, group: str, chunks: str, salt: list[str]) -> DataFrame:
    """Deal each group to units (group, a, b), a <= b, so that every pair of its rows meets in one unit.

    A group is cut into as many chunks as column `chunks` says; a row goes to its own chunk (column
    _own, by hash of `salt`) paired with each chunk of its group. A unit of a chunk with itself
    holds that chunk alone; a unit of two holds both, and only pairs across count there.
    """
    own = F.pmod(F.xxhash64(*salt), F.col(chunks)).cast("int")
    rows = df.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col(chunks).cast("int") - 1)))
    rows = rows.withColumn("_a", F.least("_own", "_other")).withColumn("_b", F.greatest("_own", "_other")).drop("_other")
    n = partitions(df.sparkSession)
    return rows.repartition(n, group, "_a", "_b").sortWithinPartitions(group, "_a", "_b")


def forest(n: int, left, right):
    """Root (smallest index reached) of each of n nodes joined by the pairs (left, right)."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in zip(left, right, strict=True):
        a, b = find(int(i)), find(int(j))
        if a != b:
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]

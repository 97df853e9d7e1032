"""Small helpers that several operators share."""

from __future__ import annotations

import posixpath
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.session import shared_dir


_BATCH_BYTES, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"

# Rows, of some numbers each, that one task may take without slowing others.
FEW = 50_000


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame, written to the shared folder and read back.

    This cuts the lineage: lost executors cost a read, and what was random or
    numbered stays as it was written.
    """
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def gathered(df: DataFrame, label: str) -> DataFrame:
    """The frame, written and read back; up to ``FEW`` rows then lie in one file.

    What reads them takes one task in place of one per shuffle partition, and Spark
    sees that they are small enough to broadcast.
    """
    stored = written(df, label)
    if len(stored.inputFiles()) > 1 and stored.count() <= FEW:
        return written(stored.coalesce(1), label)
    return stored


def discard(df: DataFrame) -> None:
    """Delete the files of a frame that :func:`written` gave and that no one reads any more."""
    spark = df.sparkSession
    for folder in {posixpath.dirname(file) for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    """Let whole texts go to Python some megabytes at a time, unless the session chose a size.

    Rows alone bound batches by default, and texts differ in length a thousandfold.
    """
    if spark.conf.get(_BATCH_BYTES) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_BYTES, "8m")


def tasks(spark: SparkSession) -> int:
    """Number of shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop input columns named like those that an operator adds."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def text_of(column: str = "text") -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def third_fold(doc_id: str = "doc_id") -> Column:
    """Whether a row is held out: crc32 of its id as text leaves 2 modulo 4.

    Rows without an id are not held out.
    """
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def hashed_sample(rows: DataFrame, about: int) -> DataFrame:
    """About so many of the rows, or all if there are fewer, chosen by hash of id and text.

    For fitting models of fixed size only.
    """
    total = rows.count()
    if total <= about:
        return rows
    highest = int(-(1 << 63) + about / total * ((1 << 64) - 1))
    return rows.where(F.xxhash64("doc_id", "text") <= F.lit(highest))


def upper_part(hashed: Column, parts: int) -> Column:
    """Which of ``parts`` equal ranges of the signed 64-bit numbers a hash is in."""
    return F.shiftright((F.shiftright(hashed, 32) + F.lit(1 << 31)) * F.lit(parts), 32)


def ranked(df: DataFrame, keys: Sequence[str], hashed: str, ties: Sequence[str] = (),
           plan: DataFrame | None = None) -> DataFrame:
    """Add each row's ``rank`` from 0 within its keys, in the order of a hash and ``ties``.

    No task gets more than one hash range of a key, however frequent the key is: rows
    are counted per key and range, and numbered within their range. Whole rows are
    shuffled once; for counting, ``df`` is read once more with few columns. Keys must
    not be null. ``plan`` may hold further columns, one row per key.
    """
    spread = df.withColumn("_part", upper_part(F.col(hashed), tasks(df.sparkSession)))
    counts = spread.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = counts.select(*keys, "_part",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    if plan is not None:
        starts = starts.join(plan, list(keys))
    within = Window.partitionBy(*keys, "_part").orderBy(hashed, *ties)
    numbered = spread.withColumn("_row", F.row_number().over(within).cast("long"))
    return (
        numbered.join(starts, [*keys, "_part"])
        .withColumn("rank", F.col("_start") + F.col("_row") - 1)
        .drop("_part", "_start", "_row")
    )


def text_runs(texts: Sequence[str], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges of texts with about ``most`` characters together.

    A text is never cut: one that is longer makes a range of its own.
    """
    first = held = 0
    for i, text in enumerate(texts):
        if i > first and held + len(text) > most:
            yield first, i
            first, held = i, 0
        held += len(text)
    if first < len(texts):
        yield first, len(texts)


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble unsigned 64-bit numbers one to one (the splitmix64 finaliser)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)

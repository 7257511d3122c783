"""Helpers shared by the training-data operators: staging tables, and text expressions."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words and the white space between them, as the contracts define them.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A lookup table of at most this many rows may be broadcast; its row count is always taken first.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir). Only a local master gets one of its own."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    sc = spark.sparkContext
    if found := sc.getCheckpointDir():
        return found.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="tidemark-"))
    return sc.getCheckpointDir().rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet to the shared folder and read again: a later loss of executors
    re-reads the table instead of the lineage."""
    path = f"{shared_dir(df.sparkSession)}/tidemark/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Freed memory of this process goes back to the system: Python workers are kept between tasks, and count in the executor's memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def lean(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """`work` for mapInArrow, after which its worker gives back what it has freed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def small(df: DataFrame, rows: int = BROADCAST_ROWS, wide: Column | None = None) -> DataFrame:
    """`df` (a staged table) with a broadcast hint if its counted rows are within the bound, and the bytes of its `wide` column, if it
    has one, within BROADCAST_BYTES; else as it is: the join then shuffles, and adaptive execution splits skewed partitions."""
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(wide), F.lit(0)) if wide is not None else F.lit(0)).first()
    return F.broadcast(df) if n <= rows and size <= BROADCAST_BYTES else df


def spread_join(rows: DataFrame, one: DataFrame, key: str, weight: str) -> DataFrame:
    """`rows` with the columns of `one` (a staged table, a row a key, which `weight` rows have), nulls where it lacks the key. Keys
    that have over a thousandth of all rows, fewer than a thousand therefore, are broadcast: no task gets all rows of one."""
    total = one.agg(F.sum(weight)).first()[0] or 0
    heavy, found = one.where(F.col(weight) * 1000 > total).drop(weight), one.drop(weight)
    light = rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(found, key, "left")
    return rows.join(F.broadcast(heavy), key).unionByName(light)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once a row however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else. On pure ASCII text lower() does that, and is cheaper."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """For each name a column name that `df` does not have yet."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        name = "_" + name
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

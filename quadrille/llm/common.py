"""Shared folders, batching of whole texts, and distributed prefix sums."""

from __future__ import annotations

import contextlib
import contextvars
import ctypes
import math
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Words of every operator here: runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset on a single machine, as in tests, one local folder is made for the session; a cluster must name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all machines of {master} share")
        app = spark.sparkContext.applicationId
        base = _LOCAL.setdefault(app, tempfile.mkdtemp(prefix="quadrille-"))
    return base.rstrip("/")


class Scope:
    """The tables that one call writes on its way, and which of them outlive it."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []
        self.kept: set[str] = set()

    def keep(self, df: DataFrame) -> DataFrame:
        """``df``, with the tables that it reads kept when the scope ends."""
        names = {f.rsplit("/", 2)[-2] for f in df.inputFiles()}
        self.kept |= {p for p in self.paths if p.rsplit("/", 1)[-1] in names}
        return df

    def clear(self, *but: DataFrame) -> None:
        """Delete now what nothing will read any more: all but what was kept and the tables ``but``."""
        names = {f.rsplit("/", 2)[-2] for df in but for f in df.inputFiles()}
        gone = [p for p in self.paths if p not in self.kept and p.rsplit("/", 1)[-1] not in names]
        self.paths = [p for p in self.paths if p not in gone]
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in gone:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)


#: The innermost scope of the present thread; another thread has its own, so no call deletes what another one reads.
_INNERMOST: contextvars.ContextVar[Scope | None] = contextvars.ContextVar("scope", default=None)


@contextlib.contextmanager
def scope(spark: SparkSession) -> Iterator[Scope]:
    """Own the tables written inside: those not kept are deleted at the end, also when it fails.

    Tables kept pass to the scope around this one; where there is none they stay until the caller clears the folder,
    as do tables written outside any scope.
    """
    own, around = Scope(spark), _INNERMOST.get()
    token = _INNERMOST.set(own)
    try:
        yield own
    except BaseException:
        own.kept.clear()
        raise
    finally:
        _INNERMOST.reset(token)
        own.clear()
        if around is not None:
            around.paths += own.paths


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return a reader of it, which cuts the lineage.

    A lost executor then costs a task that reads a file again, not the whole history of the rows.
    """
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    if (own := _INNERMOST.get()) is not None:
        own.paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def attach(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``rows``, a written table, with the columns of ``table``, which has one row a ``key``; a hot key is dealt in parts."""
    counts = rows.groupBy(key).agg(F.count("*").alias("__n"))
    named = materialise(table.join(counts, key), "named")
    return heavy_join(rows, named, [key], "__n").drop("__n")


#: A key is heavy where it holds more than this share of all rows, so there are fewer heavy keys than its inverse.
HEAVY = 1 / 1000


def heavy_join(rows: DataFrame, named: DataFrame, keys: list[str], count: str, how: str = "inner", total: int | None = None) -> DataFrame:
    """``rows`` joined with ``named``, a written table of one row a key that says in ``count`` how many rows have it.

    Rows of a heavy key are dealt over as many parts as it fills, and its row of ``named`` is repeated for each part.
    Heavy keys are fewer than 1 / ``HEAVY``, so they are broadcast.  ``rows`` is to be a written table too: the part is
    the row's number, which then is the same whenever a task runs again.
    """
    total = total or named.agg(F.sum(count)).first()[0] or 0
    limit = max(1, math.ceil(total * HEAVY))
    parts = F.ceil(F.col(count) / limit).cast("int")
    heavy = F.broadcast(named.where(F.col(count) > limit).select(*keys, parts.alias("__parts")))
    dealt = rows.withColumn("__row", F.monotonically_increasing_id()).join(heavy, keys, "left")
    dealt = dealt.withColumn("__part", F.coalesce(F.pmod("__row", "__parts"), F.lit(0)).cast("int")).drop("__row", "__parts")
    spread = named.withColumn("__part", F.explode(F.when(F.col(count) > limit, F.sequence(F.lit(0), parts - 1)).otherwise(F.array(F.lit(0)))))
    return dealt.join(spread, [*keys, "__part"], how).drop("__part")


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text; a null text is an empty one."""
    return pc.fill_null(column.cast(pa.large_binary()), b"").to_pylist()


def nullable(kind: pa.DataType) -> pa.DataType:
    """The type with nullable fields throughout, as declared schemas are."""
    if pa.types.is_struct(kind):
        return pa.struct([pa.field(f.name, nullable(f.type)) for f in kind])
    if pa.types.is_list(kind):
        return pa.list_(pa.field(kind.value_field.name, nullable(kind.value_type)))
    return kind


def settle() -> None:
    """Give freed memory back to the machine: a worker lives on from stage to stage, beside others of its executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # only one C library has it
        ctypes.CDLL(None).malloc_trim(0)


def text_slices(batch: pa.RecordBatch | pa.Table, column: str, limit: int = 2 << 20) -> Iterator:
    """Cut a batch into runs of whole rows with about ``limit`` bytes of text, so that memory stays bounded."""
    lengths = pc.fill_null(pc.binary_length(batch[column].cast(pa.large_binary())), 0)
    ends = np.cumsum(np.asarray(lengths.to_numpy(zero_copy_only=False) if isinstance(lengths, pa.Array) else lengths.to_numpy(), dtype=np.int64))
    start = 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
    settle()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_count(text: Column) -> Column:
    """Number of words, native: parts between runs of white space, without an empty first and last part."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]+"))).cast("long")


def prefix_sums(df: DataFrame, order: list[Column], value: str, before: str, partitions: int | None = None) -> DataFrame:
    """Add ``before``: the sum of ``value`` over all rows that come earlier in the order of ``order``.

    The rows are dealt by ranges of the order, so a hot key spreads over as many ranges as it fills; each range sums
    its own rows and only one total a range (their number is the number of partitions) is added up on the driver.
    ``order`` should be total; rows that tie on all of it take any order among themselves.
    """
    keys = [f"__o{i}" for i in range(len(order))]
    dealt = df.withColumns(dict(zip(keys, order, strict=True)))
    dealt = dealt.repartitionByRange(partitions, *keys) if partitions else dealt.repartitionByRange(*keys)
    dealt = materialise(dealt.withColumn("__range", F.spark_partition_id()), "ranges")
    totals = dealt.groupBy("__range").agg(F.sum(value).alias("t")).orderBy("__range").collect()
    starts, sofar = [0] * (max((row["__range"] for row in totals), default=0) + 1), 0
    for row in totals:
        starts[row["__range"]] = sofar
        sofar += row["t"] or 0
    within = Window.partitionBy("__range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    out = dealt.withColumn("__before", F.coalesce(F.sum(value).over(within), F.lit(0)))
    start = F.element_at(F.lit(starts), F.col("__range") + 1)
    return out.withColumn(before, (start + F.col("__before")).cast("long")).drop("__range", "__before", *keys)

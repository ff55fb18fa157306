"""What several operators share: table reading, lineage cuts, batch bounds."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of the contracts: a run of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
ROWS_A_FILE = 50_000
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only a local session, where all is one machine, gets one of our own if it names none."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = f"file://{tempfile.mkdtemp(prefix='panelspark-')}"
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def cut(df: DataFrame, rows: int | None = None) -> DataFrame:
    """The rows as a table written to the shared folder: lineage ends here, and a lost executor costs nothing. ``discard`` deletes it. ``rows``: about how many there are, where that is known, so that few rows don't become many files."""
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(6, rows // ROWS_A_FILE))
    at = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(at)
    out = spark.read.schema(df.schema).parquet(at)
    out._cut_at = at
    for kept in _open:
        kept.append(out)
    return out


def discard(*cuts: DataFrame) -> None:
    """Deletes tables that ``cut`` wrote and nothing reads any more."""
    for x in cuts:
        spark = x.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(x._cut_at)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


_open: list[list[DataFrame]] = []


def settled(make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` gives, written as a cut; the cuts that it made on the way are deleted."""
    _open.append([])
    try:
        out = cut(make())
        discard(*(x for x in _open[-1] if x is not out and x._cut_at != out._cut_at))
    finally:
        inner = _open.pop()
    for kept in _open:  # an outer call has only the result left to delete
        kept[:] = [x for x in kept if x is out or x not in inner]
    return out


def small_batches(spark: SparkSession) -> None:
    """Bounds what a Python worker holds at once, rows and bytes of an Arrow batch, by the same numbers for all operators; bounds that the session has set stay."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", 256), ("spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20)):
        if spark.conf.get(key) == spark.sparkContext._jvm.org.apache.spark.sql.internal.SQLConf().getConfString(key):
            spark.conf.set(key, str(most))


def release() -> None:
    """Gives a Python worker's free memory back to the system: idle workers wait beside busy ones, and keep what they once needed otherwise."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The function of batches, whose worker releases its free memory when the task ends."""

    def run(batches: Iterator) -> Iterator:
        yield from work(batches)
        release()

    return run


def n_words(text: Column) -> Column:
    """Words of a text by the contracts' pattern; null has none."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), ""))

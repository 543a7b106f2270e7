"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import uuid

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import scoped_session, scratch_path

#: A word is a run of other characters than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def fold(key: str, parts: int, which: int) -> Column:
    """Whether crc32 of the key as text leaves ``which`` when divided by ``parts``; false for null."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % parts == which, F.lit(False))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_small_batches(df: DataFrame, limit: int = 4 << 20) -> DataFrame:
    """``df`` with batches of about ``limit`` bytes for its Python workers, in place of Spark's larger ones.

    The size is a setting of the session, so the same plan is taken into a sibling session.
    """
    spark, name = df.sparkSession, f"small_batches_{uuid.uuid4().hex}"
    sibling = scoped_session(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": str(limit)})
    df.createGlobalTempView(name)
    try:
        return sibling.table(f"global_temp.{name}")
    finally:
        spark.catalog.dropGlobalTempView(name)


def raw_bytes(column: pa.Array) -> list:
    """UTF-8 bytes of a string column, None for null."""
    return column.cast(pa.binary()).to_pylist()


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that columns added beside it can have any name."""
    return F.struct(*(F.col(f"`{name.replace('`', '``')}`") for name in df.columns))


def unit(*columns: Column) -> Column:
    """A number in [0, 1) that depends on the values alone."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(2**53))


def frequent(counts: DataFrame, column: str, most: int) -> DataFrame:
    """The rows whose count reaches the least power of two that at most ``most`` rows reach.

    Counts of counts decide, so nothing is sorted and no task gathers rows of all others.
    """
    size = F.floor(F.log2(F.col(column))).cast("int")
    sizes = counts.filter(F.col(column) > 0).groupBy(size.alias("size")).count().orderBy(F.col("size").desc()).collect()  # 64 rows at most
    least, total = 64, 0
    for row in sizes:
        total += row["count"]
        if total > most:
            break
        least = row["size"]
    return counts.filter(F.col(column) >= F.lit(2.0**least))


def portions(batch: pa.RecordBatch, column: int, limit: int = 4 << 20):
    """Cut a batch into slices whose strings hold about ``limit`` bytes; a longer text stands alone."""
    sizes = [0 if n is None else n for n in pa.compute.binary_length(batch.column(column)).to_pylist()]
    start = held = 0
    for row, size in enumerate(sizes):
        if held and held + size > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


class Recent:
    """A bounded memo: what was not used since half of the room was last filled goes."""

    def __init__(self, room: int):
        self.half = room // 2
        self.young: dict = {}
        self.old: dict = {}

    def recall(self, key):
        """The value of a key that ``young`` does not have; None if it is not known."""
        value = self.old.get(key)
        if value is not None:
            self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(self.young) >= self.half:
            self.old = dict(self.young)
            self.young.clear()  # the same object: callers hold on to it
        self.young[key] = value


_HELD: dict = {}


def forget() -> None:
    """Drop what this worker process remembers, and give all memory that it has freed back to the system."""
    _HELD.clear()
    _give_back()


def _give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    getattr(ctypes.CDLL(None), "malloc_trim", int)(0)  # glibc keeps freed memory otherwise; other libraries have no such call


def held(name, build):
    """What a worker process remembers from task to task: ``build()``, once, in place of what it held under another name.

    The memory of what goes is given back to the system before the new is built, and what building took, after it.
    """
    if name not in _HELD:
        forget()
        _HELD[name] = build()
        _give_back()
    return _HELD[name]


def forgetting(run):
    """``run``, for ``mapInArrow``, in tasks that leave nothing in the memory of their worker, which waits for the next ones."""

    def whole(batches):
        yield from run(batches)
        forget()

    return whole

"""Helpers shared by the text operators: scratch tables and bounded text batches."""
from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.session import scratch_path

#: Characters that separate words (fixed by the contracts): space and \x09-\x0D.
#: ``bytes.split()`` without an argument splits on exactly these.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Text that one step of a Python task holds as words at a time.
CHUNK_BYTES = 1 << 20

#: Bytes of a batch on its way between Spark and a Python task; either side holds some batches of every running task.
BATCH_BYTES = 4 << 20
MAX_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """From now on batches of this session end at ``BATCH_BYTES`` (or less, if the session says so); rows are never cut.

    Spark's own bound is a number of rows, which for long texts is many times that."""
    held = spark.conf.get(MAX_BATCH, None)
    if not held or spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(held) > BATCH_BYTES:
        spark.conf.set(MAX_BATCH, str(BATCH_BYTES))


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    A written table cuts the lineage and outlives any executor.  Collecting
    the driver's garbage lets Spark delete the shuffle files behind it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    df.sparkSession.sparkContext._jvm.System.gc()
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.__dict__["scratch"] = path
    _OPEN[path] = df.sparkSession
    return out


#: Tables written and not yet deleted.
_OPEN: dict[str, SparkSession] = {}


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``save`` that nothing reads any more."""
    for t in tables:
        path = t.__dict__.get("scratch")
        if path and _OPEN.pop(path, None):
            _delete(t.sparkSession, path)


def open_tables() -> list[str]:
    """Paths of the tables that ``save`` has written and nobody has deleted."""
    return list(_OPEN)


def discard_since(mark: list[str], *keep: DataFrame) -> None:
    """Delete the tables written since ``open_tables()`` gave ``mark``, but for ``keep``."""
    kept = {*mark, *(t.__dict__.get("scratch") for t in keep)}
    for path in [p for p in _OPEN if p not in kept]:
        _delete(_OPEN.pop(path), path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def training_row(remainder: int, id_col: str = "doc_id"):
    """True where crc32(id as text) mod 5 is not ``remainder`` (a null id counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(5)) != remainder


def pieces(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES,
           rows: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """Cut record batches into slices of about ``limit`` bytes of text and at most ``rows`` rows (one row at least)."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(b.schema.get_field_index(text))), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if i > start and (held + n > limit or i - start >= rows):
                yield b.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield b.slice(start)
    pa.default_memory_pool().release_unused()  # the worker lives on and may wait beside others


def raw(b: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    """A string column as UTF-8 bytes, without decoding."""
    return b.column(b.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def ids(b: pa.RecordBatch, name: str = "doc_id") -> list[int | None]:
    return b.column(b.schema.get_field_index(name)).to_pylist()


class WordHashes(dict):
    """word -> 64-bit hash, remembered for words of the same task; memory stays bounded by ``trim``."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def trim(self, most: int = 100_000) -> None:
        if len(self) > most:
            self.clear()

"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.plans.scratch import scratch_root

#: A byte of a word stays (A-Z as a-z), any other ASCII byte becomes a space.
#: Words are runs of 0-9, a-z and non-ASCII characters.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Words of a whole text (UTF-8), A-Z lower-cased; null has none."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


#: Bytes of text that are split into words at a time.
PIECE = 1 << 20


def pieces(data: bytes, size: int | None = None) -> Iterator[bytes]:
    """``data`` in parts of about ``size`` bytes, cut at blanks only."""
    start, size = 0, size or PIECE
    while len(data) - start > size:
        end = data.find(b" ", start + size)
        if end < 0:
            break
        yield data[start:end]
        start = end
    yield data[start:] if start else data


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """Column by exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that added columns cannot clash with them."""
    return F.struct(*[col(c) for c in df.columns])


def unused(df: DataFrame, name: str) -> str:
    """``name``, or it with so many _ that no column of ``df`` is called like it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def settle(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder: later reads do not
    run its plan again and survive the loss of executors."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """As :func:`settle`, as compressed Parquet: for rows that carry texts."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/tillflow-llm/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096,
            max_chars: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """Arrow batches of tuples, cut at ``size`` rows or about ``max_chars`` of text."""
    held: list[tuple] = []
    chars = 0
    for row in rows:
        held.append(row)
        chars += sum(len(v) for v in row if isinstance(v, (str, bytes)))
        if len(held) >= size or chars >= max_chars:
            yield _batch(held, schema)
            held, chars = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), type=f.type) for c, f in zip(columns, schema)], schema=schema)


def tuples(parts: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of Arrow batches, one batch in memory at a time."""
    for part in parts:
        yield from zip(*[c.to_pylist() for c in part.columns])


def trimmed(task: Callable) -> Callable:
    """A task that, when it ends, gives the memory it held back to the system: workers
    are kept for later tasks, and several of them share an executor's memory."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(parts)
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # another C library
            pass

    return run

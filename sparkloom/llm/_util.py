"""Shared pieces of the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the class of characters between words, as a Java and Python pattern.
SPACES = r"[\x20\x09-\x0D]+"
NOT_SPACES = r"[^\x20\x09-\x0D]+"

#: A-Z lower-cased, every other byte as it is.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: A-Z lower-cased, then every byte that is no digit, letter or non-ASCII byte becomes a space.
ALNUM = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Array of the words between SPACES; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def quoted(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def without(df: DataFrame, *names: str) -> list[Column]:
    """All columns of df but those named (as Spark compares names): an operator's own column replaces one of the input."""
    taken = {n.lower() for n in names}
    return [quoted(c) for c in df.columns if c.lower() not in taken]


def held_out(id_col: Column, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(modulus)) == remainder, F.lit(False))


def text_bytes(column: pa.ChunkedArray | pa.Array) -> Iterator[bytes]:
    """UTF-8 of each value of a string or binary column, one at a time; null counts as empty."""
    for value in column:
        buffer = value.as_buffer() if value.is_valid else None
        yield b"" if buffer is None else buffer.to_pybytes()


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Smaller Arrow batches for what runs meanwhile: both the JVM and the Python worker hold a batch or two of whole texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, min(int(before), rows) if int(before) > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def total_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of text in docs: what the numbers of buckets and blocks are derived from."""
    return docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0


def offsets(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the stretches of True."""
    edge = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def spans_column(starts: np.ndarray, ends: np.ndarray, per_row: np.ndarray) -> pa.Array:
    """array<struct<start, end>> from flat spans and the number of them in each row."""
    item = pa.StructArray.from_arrays([pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(offsets(per_row), pa.int32()), item)


SPANS = "array<struct<start:bigint,end:bigint>>"

"""Shared helpers: tables, the shared folder, byte views of Arrow text, hashes."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
# Bytes that the kernels of the pipeline's stages work on at once. Their arrays take up to 60 times as much, an executor has
# a Python worker for each core, and a worker, which serves one stage after another, keeps much of the most it ever took.
BLOCK = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, read by Spark only."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from spark.checkpoint.dir; where it is unset, as in tests, one of our own."""
    return (spark.conf.get("spark.checkpoint.dir", None) or _own_dir(spark.sparkContext.applicationId)).rstrip("/")


@cache
def _own_dir(application: str) -> str:
    return "file://" + tempfile.mkdtemp(prefix="waymesh-shared-")


def _remove(spark: SparkSession, path: str) -> None:
    jvm, sc = spark._jvm, spark.sparkContext
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    try:
        if spark.sparkContext._jsc is not None:
            _remove(spark, path)
    except Exception:  # the session may be gone; the folder is a scratch area
        return


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder, reread: it cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/waymesh-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove_at_exit, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._waymesh_path = path
    return out


def dropped(df: DataFrame) -> None:
    """Delete a written() table that nothing reads any more."""
    if path := getattr(df, "_waymesh_path", None):
        _remove(df.sparkSession, path)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without making Python strings; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, most: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Row ranges of about `most` bytes each; a longer row stands alone."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to
        at = to


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shifts and odd multipliers)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_RNG = np.random.default_rng(20240117)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        out = np.ones(size, np.uint64)
        at = 1
        while at < size:
            out[at : 2 * at] = out[:at] * U64(pow(base, at, 1 << 64))
            at *= 2
        _POWERS[base] = have = out
    return have[:n]


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_hashes(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word, first word of each row) for words cut at `separator` bytes.

    separator: 256 booleans. A word's hash is a polynomial over random byte values, from one
    running sum over the whole block, so there is no loop over words or rows.
    """
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~separator[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | first[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | first[1:])) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_BASE, n), out=sums[1:])
    h = mix((sums[ends] - sums[starts]) * _powers(_INVERSE, n + 1)[starts] + (ends - starts).astype(np.uint64))
    return h, np.searchsorted(starts, offsets)


def appended(docs: DataFrame, fields: list[tuple[str, str]], kernel, *cols: str) -> DataFrame:
    """docs with `fields` (name, type) added by kernel(arrays of `cols`) -> arrays, batch by batch.

    A column of docs that has the name of an added one is replaced. Other columns pass through
    whatever their names are (positions are used inside).
    """
    from pyspark.sql.types import StructType

    base = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in {n for n, _ in fields} or c in cols])
    names = base.columns
    if any(n in names for n, _ in fields):
        raise ValueError("an input column of the operator has the name of an added column")
    inner = base.toDF(*[f"c{i}" for i in range(len(names))])
    at = [names.index(c) for c in cols]
    more = StructType.fromDDL(", ".join(f"n{i} {kind}" for i, (_, kind) in enumerate(fields)))
    schema = StructType([*inner.schema.fields, *more.fields])
    labels = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, *kernel(*(batch.column(i) for i in at))], names=labels)

    return inner.mapInArrow(run, schema).toDF(*names, *[n for n, _ in fields])


def rows_through(docs: DataFrame, operator) -> DataFrame:
    """The rows that operator(inner, at) returns, with the columns of docs and no others.

    inner is docs with columns named by position and at maps a column's name to that; so names with
    dots or equal to an added column's don't matter. operator keeps inner's columns.
    """
    inner = docs.toDF(*[f"in{i}" for i in range(len(docs.columns))])
    out = operator(inner, dict(zip(docs.columns[::-1], inner.columns[::-1], strict=True)))
    return out.select(*inner.columns).toDF(*docs.columns)

"""Labelled samples and hashed text features of the classifiers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .language import held_out


def labelled_sample(docs: DataFrame, labels: DataFrame, classes: dict[str, int], text_col: str = "text", id_col: str = "doc_id", grade: str = "grade") -> DataFrame:
    """(id, text, grade) of at most classes[g] rows of each grade g, chosen by a hash of the id.

    labels: id and grade (string), one row per id. Only rows that are not held out are taken. The
    ids are a bounded set (the sum of `classes`), so they are sent to all executors and the text
    table is read once, without a shuffle. They travel as an Arrow table: a frame of Python rows would
    start Python workers of a second kind in all executors, which stay.
    """
    spark = docs.sparkSession
    open_rows = labels.filter(F.col(id_col).isNotNull() & ~held_out(id_col))
    chosen = []
    for g, most in classes.items():
        chosen.append(open_rows.filter(F.col(grade) == g).orderBy(F.xxhash64(id_col), id_col).select(id_col, grade).limit(most).toArrow())
    ids = spark.createDataFrame(pa.concat_tables(chosen), open_rows.select(id_col, grade).schema)
    return docs.select(id_col, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).join(F.broadcast(ids), id_col)


def trigram_buckets(data: np.ndarray, bits: int) -> np.ndarray:
    """The bucket of the byte trigram that starts at each byte but the last two."""
    x = data.astype(np.uint32)
    return ((x[:-2] << np.uint32(16) | x[1:-1] << np.uint32(8) | x[2:]) * np.uint32(2654435761)) >> np.uint32(32 - bits)


class Adam:
    """Plain Adam over one array."""

    def __init__(self, n: int, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(n), np.zeros(n), 0, rate

    def step(self, w: np.ndarray, g: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (g - self.m)
        self.v += 0.001 * (g * g - self.v)
        w -= self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))

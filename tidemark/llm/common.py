"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The folder that holds the package.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: Rows of one Arrow batch. Texts may be long, so a batch is far below Spark's 10,000 rows.
BATCH_ROWS = 512


def prepare(spark: SparkSession) -> SparkSession:
    """Settings that the Python stages rely on.

    Arrow batches are small, so that a worker's memory has a bound. Python workers look for this package
    where the driver found it; where it is installed on the executors that changes nothing.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])
    return spark


def map_rows(df: DataFrame, work: Callable[[pa.RecordBatch], Iterable[list] | None], schema: str) -> DataFrame:
    """``work`` turns an input batch into columns (lists or Arrow arrays, in the order of ``schema``)."""
    prepare(df.sparkSession)
    empty = df.sparkSession.createDataFrame([], schema)
    kinds = [_arrow(f.dataType) for f in empty.schema.fields]
    names = empty.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = work(batch)
            if columns is not None:
                arrays = [c.cast(k) if isinstance(c, pa.Array) else pa.array(c, type=k) for c, k in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.mapInArrow(run, empty.schema)


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def lists(values: list[np.ndarray], dtype: str) -> pa.Array:
    """Numpy arrays as one Arrow array of lists."""
    ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
    flat = np.concatenate(values).astype(dtype, copy=False) if values else np.empty(0, dtype)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def utf8(value: str | None) -> bytes:
    return b"" if value is None else value.encode("utf-8")


def own_names(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Only the ``wanted`` columns (new name: column of ``df``), so that extra columns cannot clash with ours."""
    return df.select(*[quoted(old).alias(new) for new, old in wanted.items()])


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")

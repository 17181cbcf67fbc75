"""DataFrames from Python objects: pandas, Arrow, polars, numpy, rows and dicts."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import DataFrame, SparkSession


def from_object(spark: SparkSession, x: Any) -> DataFrame:
    """A DataFrame of any object that ``can_scan`` accepts. Streams are read once."""
    if isinstance(x, DataFrame):
        return x
    if hasattr(x, "dataframe") and isinstance(x.dataframe, DataFrame):  # a relation
        return x.dataframe
    if isinstance(x, pd.DataFrame):
        return from_pandas(spark, x)
    if isinstance(x, (np.ndarray, dict)) or _is_arrays(x):
        return from_numpy(spark, x)
    if isinstance(x, ds.FileSystemDataset) and (files := _files_of(spark, x)) is not None:
        return files
    if (table := arrow_table(x)) is not None:
        return spark.createDataFrame(table)
    raise TypeError(f"can't read a {type(x).__name__}")


def can_scan(x: Any) -> bool:
    return (
        isinstance(x, (DataFrame, pd.DataFrame, np.ndarray, pa.Table, pa.RecordBatch, pa.RecordBatchReader, ds.Dataset, ds.Scanner))
        or hasattr(x, "__arrow_c_stream__") or hasattr(x, "dataframe") and isinstance(x.dataframe, DataFrame) or _is_arrays(x)
        or isinstance(x, dict) and bool(x) and all(isinstance(v, np.ndarray) for v in x.values())
    )


def _is_arrays(x: Any) -> bool:
    return isinstance(x, (list, tuple)) and bool(x) and all(isinstance(v, np.ndarray) for v in x)


def _files_of(spark: SparkSession, x: ds.FileSystemDataset) -> DataFrame | None:
    """A dataset of local Parquet or ORC files as Spark's own scan of them, with pruning and
    pushdown; None for others, and where columns come from folder names."""
    kind = {"parquet": "parquet", "orc": "orc"}.get(x.format.default_extname)
    if kind is None or x.filesystem.type_name != "local" or not x.files:
        return None
    df = spark.read.format(kind).load([f"file://{f}" for f in x.files])
    return df.select(*[f"`{n}`" for n in x.schema.names]) if set(x.schema.names) <= set(df.columns) else None


def arrow_table(x: Any) -> pa.Table | None:
    if isinstance(x, pa.Table):
        return x
    if isinstance(x, pa.RecordBatch):
        return pa.Table.from_batches([x])
    if isinstance(x, pa.RecordBatchReader):
        return x.read_all()
    if isinstance(x, (ds.Dataset, ds.Scanner)):
        return x.to_table()
    if hasattr(x, "collect_schema") and hasattr(x, "collect"):  # a lazy polars frame
        x = x.collect()
    if hasattr(x, "to_arrow"):
        return x.to_arrow()
    if hasattr(x, "__arrow_c_stream__"):
        return pa.table(x)
    return None


def from_pandas(spark: SparkSession, frame: pd.DataFrame) -> DataFrame:
    frame = frame.rename(columns=str)
    try:
        return spark.createDataFrame(pa.Table.from_pandas(frame, preserve_index=False))
    except (pa.ArrowInvalid, pa.ArrowTypeError):  # mixed objects: as text
        return spark.createDataFrame(frame.apply(lambda c: c.where(c.isna(), c.astype(str)) if c.dtype == object else c))


def from_numpy(spark: SparkSession, x: Any) -> DataFrame:
    """A 1-D array, the rows of a 2-D array as columns, a list of arrays, or a dict of them."""
    if isinstance(x, np.ndarray):
        x = [x] if x.ndim == 1 else list(x)
    named = x if isinstance(x, dict) else {f"column{i}": a for i, a in enumerate(x)}
    columns = {}
    for name, a in named.items():
        mask = np.ma.getmaskarray(a) if isinstance(a, np.ma.MaskedArray) else None
        columns[name] = pa.array(np.ma.getdata(a) if mask is not None else a, mask=mask)
    return spark.createDataFrame(pa.table(columns))


def from_values(spark: SparkSession, *args: Any) -> DataFrame:
    """Rows of tuples, one row of scalars, or dicts of one row each."""
    if not args:
        raise ValueError("no values")
    if all(isinstance(a, dict) for a in args):
        return spark.createDataFrame([tuple(a.values()) for a in args], list(args[0]))
    if len(args) == 1 and isinstance(args[0], Iterable) and not isinstance(args[0], (str, bytes, tuple)):
        args = tuple(args[0])
    rows = [tuple(a) if isinstance(a, (list, tuple)) else None for a in args]
    if any(r is None for r in rows):
        rows = [tuple(args)]
    return spark.createDataFrame(rows, [f"col{i}" for i in range(len(rows[0]))])

"""Windows over event time, for streams and for finished tables alike."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_at_once: int = 1) -> DataFrame:
    """Parquet files of a folder as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(path)


def tumbling(df: DataFrame, ts: str, width: str, by: list[str], aggs: list[Column], late: str | None = None, slide: str | None = None) -> DataFrame:
    """Aggregates by windows of ``width`` (every ``slide``); ``late``: the watermark's delay."""
    if late and df.isStreaming:
        df = df.withWatermark(ts, late)
    window = F.window(ts, width, slide) if slide else F.window(ts, width)
    return df.groupBy(window.alias("w"), *by).agg(*aggs).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, *[c for c in _names(aggs)])


def sessions(df: DataFrame, ts: str, gap: str, by: list[str], aggs: list[Column], late: str | None = None) -> DataFrame:
    """Aggregates by runs of events that are less than ``gap`` apart."""
    if late and df.isStreaming:
        df = df.withWatermark(ts, late)
    out = df.groupBy(F.session_window(ts, gap).alias("w"), *by).agg(*aggs)
    return out.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *by, *[c for c in _names(aggs)])


def _names(aggs: list[Column]) -> Iterator[str]:
    for a in aggs:
        yield str(a).split(" AS ")[-1].rstrip("'>")


def deduplicated(df: DataFrame, ts: str, keys: list[str], late: str) -> DataFrame:
    """One row for each key within the watermark."""
    if not df.isStreaming:
        return df.dropDuplicates(keys)
    return df.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def running_totals(df: DataFrame, key: str, value: str, key_type: str) -> DataFrame:
    """Sum and count of each key so far, kept as state; a row for each key in each batch."""

    def update(k: tuple, frames: Iterator[pd.DataFrame], state: Any) -> Iterator[pd.DataFrame]:
        n, total = state.get if state.exists else (0, 0.0)
        for frame in frames:
            n, total = n + len(frame), total + float(frame[value].sum())
        state.update((n, total))
        yield pd.DataFrame({key: [k[0]], "n": [n], "total": [total]})

    return df.groupBy(key).applyInPandasWithState(update, f"{key} {key_type}, n long, total double", "n long, total double", "update", "NoTimeout")


def to_table(df: DataFrame, table: str, checkpoint: str, mode: str = "append") -> Any:
    """Starts writing a stream to a table, for what is there now."""
    return df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).toTable(table)

"""Parquet, CSV, JSON and table sinks."""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from .formats import java_pattern


def _writer(df: DataFrame, overwrite: bool | None, append: bool | None, partition_by: list[str] | None, write_partition_columns: bool | None) -> DataFrameWriter:
    if partition_by and write_partition_columns:  # the columns stay in the files, too
        df = df.withColumns({f"__part_{c}": F.col(c) for c in partition_by})
        df = df.select(*df.columns)
        partition_by = [f"__part_{c}" for c in partition_by]
    out = df.write.mode("append" if append else "overwrite" if overwrite else "errorifexists")
    return out.partitionBy(*partition_by) if partition_by else out


def write_parquet(
    df: DataFrame, path: str, compression: str | None = None, field_ids: Any = None, row_group_size_bytes: int | str | None = None, row_group_size: int | None = None,
    overwrite: bool | None = None, per_thread_output: bool | None = None, use_tmp_file: bool | None = None, partition_by: list[str] | None = None,
    write_partition_columns: bool | None = None, append: bool | None = None, filename_pattern: str | None = None, file_size_bytes: int | str | None = None,
) -> None:
    """A folder of Parquet files, one for each task and partition value.

    ``field_ids``: {column: id}, kept in the files' schema. ``row_group_size`` limits the rows of a
    file; Spark sizes row groups by bytes. ``filename_pattern`` has no Spark form and is refused.
    ``per_thread_output`` and ``use_tmp_file`` are always so in Spark.
    """
    if filename_pattern:
        raise NotImplementedError("Spark names its files itself")
    for name, number in (field_ids or {}).items():
        df = df.withMetadata(name, {"parquet.field.id": number})
    out = _writer(df, overwrite, append, partition_by, write_partition_columns)
    if compression:
        out = out.option("compression", "none" if compression == "uncompressed" else compression)
    if row_group_size_bytes:
        out = out.option("parquet.block.size", _bytes(row_group_size_bytes))
    if row_group_size:
        out = out.option("maxRecordsPerFile", row_group_size)
    out.parquet(str(path))


def write_csv(
    df: DataFrame, path: str, sep: str | None = None, na_rep: str | None = None, header: bool | None = True, quotechar: str | None = None, escapechar: str | None = None,
    date_format: str | None = None, timestamp_format: str | None = None, quoting: str | int | None = None, encoding: str | None = None, compression: str | None = None,
    overwrite: bool | None = None, per_thread_output: bool | None = None, use_tmp_file: bool | None = None, partition_by: list[str] | None = None, write_partition_columns: bool | None = None,
) -> None:
    """A folder of CSV files. ``quoting``: ``force`` or 1 quotes every value."""
    out = _writer(df, overwrite, None, partition_by, write_partition_columns).option("header", bool(header))
    options = {
        "sep": sep, "nullValue": na_rep, "quote": quotechar, "escape": escapechar or '"', "encoding": encoding, "compression": compression,
        "dateFormat": date_format and java_pattern(date_format), "timestampFormat": timestamp_format and java_pattern(timestamp_format),
        "timestampNTZFormat": timestamp_format and java_pattern(timestamp_format), "quoteAll": True if str(quoting).lower() in ("force", "all", "quote_all", "1") else None,
    }
    out.options(**{k: v for k, v in options.items() if v is not None}).csv(str(path))


def write_json(df: DataFrame, path: str, overwrite: bool | None = None, append: bool | None = None, compression: str | None = None, partition_by: list[str] | None = None) -> None:
    out = _writer(df, overwrite, append, partition_by, None)
    (out.option("compression", compression) if compression else out).json(str(path))


def replace_table(df: DataFrame, table: str) -> None:
    """New contents for a table that ``df`` may read: written beside it, then put in its place."""
    spark, beside = df.sparkSession, f"{table}__{uuid.uuid4().hex[:8]}"
    df.write.saveAsTable(beside)
    try:
        spark.table(beside).write.mode("overwrite").insertInto(table, overwrite=True)
    finally:
        spark.sql(f"DROP TABLE {beside}")


def _bytes(size: int | str) -> int:
    if isinstance(size, int):
        return size
    number = float("".join(c for c in size if c.isdigit() or c == "."))
    unit = "".join(c for c in size if c.isalpha()).lower()
    return int(number * {"": 1, "b": 1, "kb": 10**3, "mb": 10**6, "gb": 10**9, "kib": 2**10, "mib": 2**20, "gib": 2**30}[unit])

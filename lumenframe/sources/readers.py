"""CSV, JSON and Parquet scans with the options of the relational API."""

from __future__ import annotations

import functools
import io
import os
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..types import data_type
from .formats import java_pattern
from .paths import scratch

Paths = str | Path | bytes | list | Any


#: File systems of ``register_filesystem`` by protocol; their files are copied before a scan.
FILESYSTEMS: dict[str, Any] = {}


def paths_of(given: Paths, spark: SparkSession) -> list[str]:
    """Paths of a string, path, list or file-like object; what only Python can read is copied."""
    if isinstance(given, (list, tuple)):
        return [p for g in given for p in paths_of(g, spark)]
    if isinstance(given, (str, Path)):
        protocol = str(given).split("://", 1)[0] if "://" in str(given) else ""
        if protocol not in FILESYSTEMS:
            return [str(given)]
        fs = FILESYSTEMS[protocol]
        return [_copied(spark, fs.open(p, "rb"), os.path.splitext(p)[1]) for p in sorted(fs.glob(str(given)))]
    content = io.BytesIO(given) if isinstance(given, bytes) else given
    return [_copied(spark, content, "")]


def _copied(spark: SparkSession, source: Any, suffix: str, piece: int = 4 << 20) -> str:
    """A file with what ``source`` holds in the folder that all machines share, copied in pieces."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{scratch(spark, 'copy')}/data{suffix}")
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    while content := source.read(piece):
        out.write(content.encode() if isinstance(content, str) else content)
    out.close()
    return target.toString()


def _found(reader: Any, hive_partitioning: bool | None) -> Any:
    """``reader``; without partitions, folders named ``k=v`` give no columns."""
    return reader.option("recursiveFileLookup", True) if hive_partitioning is False else reader


def _refused(**given: Any) -> None:
    """Options that would change what is read and that Spark can't follow."""
    wrong = [k for k, v in given.items() if v is not None]
    if wrong:
        raise NotImplementedError(f"no Spark counterpart of {', '.join(wrong)}")


def _finish(df: DataFrame, filename: bool | str | None, drop: list[str] | None = None) -> DataFrame:
    if filename:
        df = df.withColumn(filename if isinstance(filename, str) else "filename", F.col("_metadata.file_path"))
    return df.drop(*(drop or ()))


def read_parquet(
    spark: SparkSession, path: Paths, binary_as_string: bool = False, *, file_row_number: bool = False, filename: bool | str = False,
    hive_partitioning: bool | None = None, union_by_name: bool = False, compression: str | None = None,
) -> DataFrame:
    """Parquet files; ``file_row_number`` and ``filename`` add columns, ``union_by_name`` merges schemas."""
    df = _found(spark.read.option("mergeSchema", bool(union_by_name)), hive_partitioning).parquet(*paths_of(path, spark))
    if binary_as_string:
        df = df.withColumns({f.name: F.decode(F.col(f.name), "UTF-8") for f in df.schema if isinstance(f.dataType, T.BinaryType)}) if any(isinstance(f.dataType, T.BinaryType) for f in df.schema) else df
    if file_row_number:
        df = df.withColumn("file_row_number", F.col("_metadata.row_index"))
    return _finish(df, filename)


def read_csv(
    spark: SparkSession, path: Paths, *, header: bool | int | None = None, compression: str | None = None, sep: str | None = None, delimiter: str | None = None,
    dtype: dict | list | None = None, na_values: str | list[str] | None = None, skiprows: int | None = None, quotechar: str | None = None, escapechar: str | None = None,
    encoding: str | None = None, parallel: bool | None = None, date_format: str | None = None, timestamp_format: str | None = None, sample_size: int | None = None,
    auto_detect: bool | int | None = None, all_varchar: bool | None = None, normalize_names: bool | None = None, null_padding: bool | None = None, names: list[str] | None = None,
    lineterminator: str | None = None, columns: dict[str, Any] | None = None, auto_type_candidates: list[str] | None = None, max_line_size: int | None = None,
    ignore_errors: bool | None = None, store_rejects: bool | None = None, rejects_table: str | None = None, rejects_scan: str | None = None, rejects_limit: int | None = None,
    force_not_null: list[str] | None = None, buffer_size: int | None = None, decimal: str | None = None, allow_quoted_nulls: bool | None = None,
    filename: bool | str | None = None, hive_partitioning: bool | None = None, union_by_name: bool | None = None, hive_types: dict | None = None,
    hive_types_autocast: bool | None = None, thousands: str | None = None, comment: str | None = None, files_to_sniff: int | None = None, strict_mode: bool | None = None,
) -> DataFrame:
    """CSV files.

    Without ``columns`` or a full ``dtype`` the types are inferred, in one more pass over the text;
    give them for large inputs. Without ``header`` the first line is one if no field of it is a
    number and the line after it has one, or if its fields are unlike. ``store_rejects`` keeps bad
    lines in the temporary view ``rejects_table``. Options that size buffers or threads have no
    effect, as Spark sizes its own.
    """
    files = paths_of(path, spark)
    if union_by_name and len(files) > 1:
        given = {k: v for k, v in locals().items() if k not in ("spark", "path", "files", "union_by_name")}
        return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [read_csv(spark, f, **given) for f in files])
    mark = sep or delimiter
    lines = [] if mark and header is not None else [x for x in _head(spark, files) if x]
    mark = mark or _sniffed(lines)
    if header is None:
        header = _has_header(lines, mark, quotechar or '"') if not names or columns else False
    nulls = [na_values] if isinstance(na_values, str) else list(na_values or [""])
    given = dict(columns) if columns else None
    if given is None and isinstance(dtype, (list, tuple)) and names and len(names) == len(dtype):
        given = dict(zip(names, dtype, strict=True))
    schema = T.StructType([T.StructField(n, data_type(t)) for n, t in given.items()]) if given else None
    options = {
        "sep": mark, "header": bool(header), "quote": quotechar or '"', "escape": escapechar or '"', "encoding": encoding, "nullValue": nulls[0], "comment": comment,
        "dateFormat": date_format and java_pattern(date_format), "timestampFormat": timestamp_format and java_pattern(timestamp_format),
        "timestampNTZFormat": timestamp_format and java_pattern(timestamp_format), "lineSep": lineterminator, "compression": compression,
        "inferSchema": schema is None and not all_varchar and not thousands and decimal in (None, "."), "enforceSchema": True,
        "mode": "DROPMALFORMED" if ignore_errors and not store_rejects else "PERMISSIVE" if null_padding or store_rejects else "FAILFAST",
        "maxCharsPerColumn": max_line_size, "emptyValue": "", "preferDate": True,
    }
    reader = _found(spark.read.options(**{k: v for k, v in options.items() if v is not None}), hive_partitioning)
    if skiprows:
        lines = spark.read.text(files).withColumns({"__file": F.col("_metadata.file_path"), "__at": F.monotonically_increasing_id()})
        return _skipped(spark, reader, lines, skiprows, schema)
    if store_rejects and schema is not None:
        wide = T.StructType([*schema.fields, T.StructField("__rejected", T.StringType())])
        df = reader.schema(wide).option("columnNameOfCorruptRecord", "__rejected").csv(files)
        bad = df.where("__rejected IS NOT NULL").select(F.col("__rejected").alias("csv_line"))
        (bad.limit(rejects_limit) if rejects_limit else bad).createOrReplaceTempView(rejects_table or "reject_errors")
        df = df.where("__rejected IS NULL").drop("__rejected")
    else:
        df = (reader.schema(schema) if schema is not None else reader).csv(files)
    if names and not columns:
        df = df.toDF(*[*names, *df.columns[len(names) :]])
    for extra in nulls[1:]:
        df = df.replace(extra, None, subset=[f.name for f in df.schema if isinstance(f.dataType, T.StringType)])
    if thousands or decimal not in (None, "."):
        df = _numbers(df, thousands, decimal or ".")
    if isinstance(dtype, dict):
        df = df.withColumns({n: F.col(n).cast(data_type(t)) for n, t in dtype.items()})
    if force_not_null:
        df = df.fillna("", subset=force_not_null)
    if normalize_names:
        df = df.toDF(*[_normal(c) for c in df.columns])
    for name, kind in (hive_types or {}).items():
        df = df.withColumn(name, F.col(name).cast(data_type(kind)))
    return _finish(df, filename)


def _skipped(spark: SparkSession, reader: Any, lines: DataFrame, n: int, schema: T.StructType | None) -> DataFrame:
    """Without the first ``n`` lines of each file."""
    first = lines.groupBy("__file").agg(F.min("__at").alias("__first"))
    left = lines.join(F.broadcast(first), "__file").where(F.col("__at") - F.col("__first") >= n).select("value")
    rows = left.rdd.map(lambda r: r.value)
    return (reader.schema(schema) if schema is not None else reader).csv(rows)


def _numbers(df: DataFrame, thousands: str | None, decimal: str) -> DataFrame:
    """Text columns that are numbers in this notation, as double."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]

    def number(c: str) -> Any:
        x = F.replace(F.col(c), F.lit(thousands)) if thousands else F.col(c)
        return (F.replace(x, F.lit(decimal), F.lit(".")) if decimal != "." else x).try_cast("double")

    ok = df.agg(*[F.bool_and(F.col(c).isNull() | number(c).isNotNull()).alias(c) for c in texts]).first() if texts else {}
    return df.withColumns({c: number(c) for c in texts if ok[c]}) if texts else df


def _normal(name: str) -> str:
    out = "".join(c if c.isalnum() else "_" for c in name.strip().lower()).strip("_")
    return f"_{out}" if out[:1].isdigit() else out or "column"


def _head(spark: SparkSession, files: list[str], n: int = 20) -> list[str]:
    """The first lines."""
    return [r.value for r in spark.read.text(files[:1]).limit(n).collect()]


def _sniffed(lines: list[str]) -> str:
    best = max(",|;\t", key=lambda c: (min((x.count(c) for x in lines), default=0), -",|;\t".index(c)))
    return best if lines and min(x.count(best) for x in lines) else ","


def _has_header(lines: list[str], sep: str, quote: str) -> bool:
    if len(lines) < 2:
        return True
    first, second = ([x.strip().strip(quote) for x in line.split(sep)] for line in lines[:2])
    number = lambda x: x.replace(".", "", 1).replace("-", "", 1).isdigit()
    return not any(map(number, first)) and (any(map(number, second)) or len(set(first)) == len(first))


def read_json(
    spark: SparkSession, path: Paths, *, columns: dict[str, Any] | None = None, sample_size: int | None = None, maximum_depth: int | None = None, records: bool | str | None = None,
    format: str | None = None, date_format: str | None = None, timestamp_format: str | None = None, compression: str | None = None, maximum_object_size: int | None = None,  # noqa: A002
    ignore_errors: bool | None = None, convert_strings_to_integers: bool | None = None, field_appearance_threshold: float | None = None, map_inference_threshold: int | None = None,
    maximum_sample_files: int | None = None, filename: bool | str | None = None, hive_partitioning: bool | None = None, union_by_name: bool | None = None,
    hive_types: dict | None = None, hive_types_autocast: bool | None = None,
) -> DataFrame:
    """JSON files: one object a line, or arrays and spread-out objects with another ``format``.

    ``records=False`` gives one column ``json`` with each object as a struct. Columns of several
    files are united by name. Options that would infer other types than Spark does are refused.
    """
    _refused(maximum_depth=maximum_depth, field_appearance_threshold=field_appearance_threshold, map_inference_threshold=map_inference_threshold)
    schema = T.StructType([T.StructField(n, data_type(t)) for n, t in columns.items()]) if columns else None
    options = {
        "multiLine": format in ("array", "unstructured"), "dateFormat": date_format and java_pattern(date_format), "timestampFormat": timestamp_format and java_pattern(timestamp_format),
        "mode": "DROPMALFORMED" if ignore_errors else "FAILFAST", "compression": compression, "samplingRatio": None,
    }
    reader = _found(spark.read.options(**{k: v for k, v in options.items() if v is not None}), hive_partitioning)
    df = (reader.schema(schema) if schema is not None else reader).json(paths_of(path, spark))
    if records in (False, "false"):
        df = df.select(F.struct("*").alias("json"))
    for name, kind in (hive_types or {}).items():
        df = df.withColumn(name, F.col(name).cast(data_type(kind)))
    return _finish(df, filename)


def read_orc(spark: SparkSession, path: Paths) -> DataFrame:
    return spark.read.orc(paths_of(path, spark))


def read_text(spark: SparkSession, path: Paths) -> DataFrame:
    return spark.read.text(paths_of(path, spark))

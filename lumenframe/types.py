"""Type names of the relational dialect as Spark types, and typed constants."""

from __future__ import annotations

import datetime
import decimal
import types as _types
import typing
import uuid
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bare type names that Spark spells otherwise. Unsigned types take the next wider signed one.
SPARK_NAMES = {
    "VARCHAR": "STRING", "TEXT": "STRING", "CHAR": "STRING", "BPCHAR": "STRING", "UUID": "STRING", "JSON": "STRING", "BIT": "STRING", "ENUM": "STRING",
    "BLOB": "BINARY", "BYTEA": "BINARY", "VARBINARY": "BINARY", "BOOL": "BOOLEAN", "LOGICAL": "BOOLEAN",
    "INT1": "TINYINT", "INT2": "SMALLINT", "INT4": "INT", "INT8": "BIGINT", "INTEGER": "INT", "SIGNED": "INT", "SHORT": "SMALLINT", "LONG": "BIGINT",
    "UTINYINT": "SMALLINT", "USMALLINT": "INT", "UINTEGER": "BIGINT", "UBIGINT": "DECIMAL(20,0)", "HUGEINT": "DECIMAL(38,0)", "UHUGEINT": "DECIMAL(38,0)",
    "FLOAT4": "FLOAT", "REAL": "FLOAT", "FLOAT8": "DOUBLE", "NUMERIC": "DECIMAL(18,3)", "DECIMAL": "DECIMAL(18,3)",
    "TIMESTAMP": "TIMESTAMP_NTZ", "DATETIME": "TIMESTAMP_NTZ", "TIMESTAMP_S": "TIMESTAMP_NTZ", "TIMESTAMP_MS": "TIMESTAMP_NTZ", "TIMESTAMP_US": "TIMESTAMP_NTZ",
    "TIMESTAMP_NS": "TIMESTAMP_NTZ", "TIMESTAMPTZ": "TIMESTAMP", "TIME": "BIGINT",
}

#: Smallest and largest values of unsigned and huge types, checked on write.
RANGES = {"UTINYINT": (0, 2**8 - 1), "USMALLINT": (0, 2**16 - 1), "UINTEGER": (0, 2**32 - 1), "UBIGINT": (0, 2**64 - 1), "HUGEINT": (-(10**38) + 1, 10**38 - 1), "UHUGEINT": (0, 10**38 - 1)}

_PYTHON = {
    bool: T.BooleanType(), int: T.LongType(), float: T.DoubleType(), str: T.StringType(), bytes: T.BinaryType(), bytearray: T.BinaryType(),
    datetime.datetime: T.TimestampNTZType(), datetime.date: T.DateType(), datetime.timedelta: T.DayTimeIntervalType(), datetime.time: T.LongType(),
    decimal.Decimal: T.DecimalType(38, 10), uuid.UUID: T.StringType(), type(None): T.NullType(),
}


def data_type(given: object) -> T.DataType:
    """A Spark type from a type name, a Python or numpy type, ``list[T]``, ``dict[K, V]`` or a dict of fields."""
    if isinstance(given, T.DataType):
        return given
    if isinstance(given, str):
        return _parse(given)
    if isinstance(given, dict):
        return struct_type(given)
    if isinstance(given, type) and given in _PYTHON:
        return _PYTHON[given]
    origin, args = typing.get_origin(given), typing.get_args(given)
    if origin is list:
        return T.ArrayType(data_type(args[0]))
    if origin is dict:
        return T.MapType(data_type(args[0]), data_type(args[1]))
    if origin in (typing.Union, _types.UnionType):
        real = [a for a in args if a is not type(None)]
        return data_type(real[0]) if len(real) == 1 else union_type({f"u{i + 1}": a for i, a in enumerate(real)})
    name = getattr(given, "__name__", str(given)).rstrip("_").lower()
    numpy = {"int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint", "uint8": "smallint", "uint16": "int", "uint32": "bigint", "uint64": "decimal(20,0)", "float16": "float", "float32": "float", "float64": "double", "bool": "boolean", "str": "string", "datetime64": "timestamp_ntz"}
    if name in numpy:
        return _parse(numpy[name])
    raise TypeError(f"no type for {given!r}")


def _parse(name: str) -> T.DataType:
    name = name.strip()
    if name.endswith("[]"):
        return T.ArrayType(_parse(name[:-2]))
    if name.endswith("]") and "[" in name and name[name.rindex("[") + 1 : -1].isdigit():
        return T.ArrayType(_parse(name[: name.rindex("[")]))
    upper = name.upper()
    if upper in SPARK_NAMES:
        return T.DataType.fromDDL(SPARK_NAMES[upper])
    if upper.startswith(("STRUCT(", "ROW(")) and name.endswith(")"):
        from .plans.lexer import split_top, text, tokens

        fields = [text(f).strip().split(None, 1) for f in split_top(tokens(name[name.index("(") + 1 : -1]), ",")]
        return struct_type({n.strip('"'): t for n, t in fields})
    if upper.startswith("MAP(") and name.endswith(")"):
        from .plans.lexer import split_top, text, tokens

        key, value = (text(x).strip() for x in split_top(tokens(name[4:-1]), ","))
        return T.MapType(_parse(key), _parse(value))
    return T.DataType.fromDDL(name)


#: The dialect's names of Spark's plain types.
NAMES = {
    "tinyint": "TINYINT", "smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT", "float": "FLOAT", "double": "DOUBLE", "boolean": "BOOLEAN", "string": "VARCHAR", "binary": "BLOB", "date": "DATE",
    "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP", "void": "INTEGER", "variant": "VARIANT",
}


def type_name(kind: T.DataType) -> str:
    """The dialect's name of a Spark type."""
    if isinstance(kind, T.ArrayType):
        return f"{type_name(kind.elementType)}[]"
    if isinstance(kind, T.MapType):
        return f"MAP({type_name(kind.keyType)}, {type_name(kind.valueType)})"
    if isinstance(kind, T.StructType):
        return f"STRUCT({', '.join(f'{f.name} {type_name(f.dataType)}' for f in kind)})"
    if isinstance(kind, T.DecimalType):
        return f"DECIMAL({kind.precision},{kind.scale})"
    if isinstance(kind, (T.DayTimeIntervalType, T.YearMonthIntervalType)):
        return "INTERVAL"
    return NAMES.get(kind.simpleString().split(" ")[0], kind.simpleString().upper())


def array_type(item: object, size: int | None = None) -> T.ArrayType:
    """A list; Spark arrays have no fixed length, so ``size`` is checked by ``check_length``."""
    return T.ArrayType(data_type(item))


list_type = array_type


def struct_type(fields: dict[str, object] | list[object]) -> T.StructType:
    pairs = fields.items() if isinstance(fields, dict) else ((f"v{i + 1}", x) for i, x in enumerate(fields))
    return T.StructType([T.StructField(n, data_type(t)) for n, t in pairs])


row_type = struct_type


def map_type(key: object, value: object) -> T.MapType:
    return T.MapType(data_type(key), data_type(value))


def decimal_type(width: int, scale: int) -> T.DecimalType:
    return T.DecimalType(width, scale)


def string_type(collation: str = "") -> T.StringType:
    return T.StringType(collation) if collation else T.StringType()


def union_type(members: dict[str, object] | list[object]) -> T.StructType:
    """A tag and one nullable field for each member."""
    own = struct_type(members)
    return T.StructType([T.StructField("tag", T.StringType()), *own.fields])


def enum_type(name: str, values: list[str]) -> EnumType:
    return EnumType(name, tuple(values))


@dataclass(frozen=True)
class EnumType:
    """A string with a fixed list of values, ordered by their position."""

    name: str
    values: tuple[str, ...]

    def check(self, c: Column) -> Column:
        """``c``; an error where it isn't one of the values."""
        ok = c.isNull() | c.isin(list(self.values))
        return F.when(ok, c).otherwise(F.raise_error(F.concat(F.lit(f"not in enum {self.name}: "), c)))

    def position(self, c: Column) -> Column:
        return F.array_position(F.array(*[F.lit(v) for v in self.values]), c)


def check_length(c: Column, size: int) -> Column:
    """An array of exactly ``size``, else an error."""
    return F.when(c.isNull() | (F.size(c) == size), c).otherwise(F.raise_error(F.lit(f"array length is not {size}")))


def check_range(c: Column, name: str) -> Column:
    """A value that the unsigned or huge type ``name`` holds, else an error."""
    low, high = RANGES[name.upper()]
    wide = c.cast("decimal(38,0)")
    ok = c.isNull() | ((wide >= F.lit(decimal.Decimal(low))) & (wide <= F.lit(decimal.Decimal(high))))
    return F.when(ok, c).otherwise(F.raise_error(F.lit(f"out of range for {name.upper()}")))


def value(x: object, kind: object) -> Column:
    """A typed constant."""
    return F.lit(x).cast(data_type(kind))


for _name in ("Boolean", "TinyInt", "SmallInt", "Integer", "BigInt", "UTinyInt", "USmallInt", "UInteger", "UBigInt", "HugeInt", "Float", "Double", "Varchar", "Blob", "Date", "Timestamp", "TimestampTZ", "Uuid"):
    globals()[f"{_name}Value"] = (lambda kind: lambda x: value(x, kind))({"TimestampTZ": "TIMESTAMPTZ"}.get(_name, _name.upper()))


def DecimalValue(x: object, width: int, scale: int) -> Column:  # noqa: N802
    return value(x, T.DecimalType(width, scale))

"""Composable expressions over Spark columns, with the relational defaults for order and NULLs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .plans.dialect import FUNCTIONS, rewrite
from .types import data_type


def column_of(x: object) -> Column:
    """An expression or column as it is, a string as a column's name, anything else as a constant."""
    if isinstance(x, Expression):
        return x.column
    if isinstance(x, Column):
        return x
    if isinstance(x, (str, bytes)):
        return F.col(x if isinstance(x, str) else x.decode())
    return F.lit(x)


class Expression:
    """A Spark column with sort direction, null placement and a name."""

    def __init__(self, column: Column, name: str | None = None, descending: bool = False, nulls_first: bool | None = None, exclude: tuple[str, ...] | None = None) -> None:
        self.column = column
        self.name = name
        self.descending = descending
        self.first = nulls_first
        self.exclude = exclude  # of a star

    def _with(self, column: Column) -> Expression:
        return Expression(column)

    # arithmetic
    def __add__(self, o): return self._with(self.column + _value(o))  # noqa: ANN001, ANN204, E704
    def __sub__(self, o): return self._with(self.column - _value(o))  # noqa: ANN001, ANN204, E704
    def __mul__(self, o): return self._with(self.column * _value(o))  # noqa: ANN001, ANN204, E704
    def __truediv__(self, o): return self._with(F.try_divide(self.column, _value(o)))  # noqa: ANN001, ANN204, E704
    def __mod__(self, o): return self._with(F.try_mod(self.column, _value(o)))  # noqa: ANN001, ANN204, E704
    def __pow__(self, o): return self._with(F.pow(self.column, _value(o)))  # noqa: ANN001, ANN204, E704
    def __floordiv__(self, o): return self._with(_div(self.column, _value(o)))  # noqa: ANN001, ANN204, E704
    def __radd__(self, o): return self._with(_value(o) + self.column)  # noqa: ANN001, ANN204, E704
    def __rsub__(self, o): return self._with(_value(o) - self.column)  # noqa: ANN001, ANN204, E704
    def __rmul__(self, o): return self._with(_value(o) * self.column)  # noqa: ANN001, ANN204, E704
    def __rtruediv__(self, o): return self._with(F.try_divide(_value(o), self.column))  # noqa: ANN001, ANN204, E704
    def __rmod__(self, o): return self._with(F.try_mod(_value(o), self.column))  # noqa: ANN001, ANN204, E704
    def __rpow__(self, o): return self._with(F.pow(_value(o), self.column))  # noqa: ANN001, ANN204, E704
    def __rfloordiv__(self, o): return self._with(_div(_value(o), self.column))  # noqa: ANN001, ANN204, E704
    def __neg__(self): return self._with(-self.column)  # noqa: ANN204, E704

    # comparison and logic
    def __eq__(self, o): return self._with(self.column == _value(o))  # noqa: ANN001, ANN204, E704
    def __ne__(self, o): return self._with(self.column != _value(o))  # noqa: ANN001, ANN204, E704
    def __gt__(self, o): return self._with(self.column > _value(o))  # noqa: ANN001, ANN204, E704
    def __ge__(self, o): return self._with(self.column >= _value(o))  # noqa: ANN001, ANN204, E704
    def __lt__(self, o): return self._with(self.column < _value(o))  # noqa: ANN001, ANN204, E704
    def __le__(self, o): return self._with(self.column <= _value(o))  # noqa: ANN001, ANN204, E704
    def __and__(self, o): return self._with(self.column & _value(o))  # noqa: ANN001, ANN204, E704
    def __or__(self, o): return self._with(self.column | _value(o))  # noqa: ANN001, ANN204, E704
    def __rand__(self, o): return self._with(_value(o) & self.column)  # noqa: ANN001, ANN204, E704
    def __ror__(self, o): return self._with(_value(o) | self.column)  # noqa: ANN001, ANN204, E704
    def __invert__(self): return self._with(~self.column)  # noqa: ANN204, E704
    __hash__ = object.__hash__

    def isnull(self) -> Expression:
        return self._with(self.column.isNull())

    def isnotnull(self) -> Expression:
        return self._with(self.column.isNotNull())

    def isin(self, *values: object) -> Expression:
        if not values:
            raise ValueError("isin needs a value at least")
        return self._with(self.column.isin(*[_value(v) for v in values]))

    def isnotin(self, *values: object) -> Expression:
        return ~self.isin(*values)

    def between(self, low: object, high: object) -> Expression:
        return self._with(self.column.between(_value(low), _value(high)))

    def collate(self, collation: str) -> Expression:
        return self._with(F.collate(self.column, collation))

    def cast(self, kind: object) -> Expression:
        return self._with(self.column.cast(data_type(kind)))

    def try_cast(self, kind: object) -> Expression:
        return self._with(self.column.try_cast(data_type(kind)))

    def alias(self, name: str) -> Expression:
        return Expression(self.column.alias(name), name)

    def get_name(self) -> str:
        return self.name or str(self.column)

    # order: NULLs last unless said otherwise
    def asc(self) -> Expression:
        return Expression(self.column, self.name, False, self.first)

    def desc(self) -> Expression:
        return Expression(self.column, self.name, True, self.first)

    def nulls_first(self) -> Expression:
        return Expression(self.column, self.name, self.descending, True)

    def nulls_last(self) -> Expression:
        return Expression(self.column, self.name, self.descending, False)

    @property
    def sort_column(self) -> Column:
        if self.descending:
            return self.column.desc_nulls_first() if self.first else self.column.desc_nulls_last()
        return self.column.asc_nulls_first() if self.first else self.column.asc_nulls_last()

    # CASE
    def when(self, condition: object, value: object) -> Expression:
        return self._with(self.column.when(column_of(condition), _value(value)))

    def otherwise(self, value: object) -> Expression:
        return self._with(self.column.otherwise(_value(value)))

    def show(self) -> None:
        print(self.column)

    def __repr__(self) -> str:
        return f"Expression({self.column})"


def _value(x: object) -> Column:
    return x.column if isinstance(x, Expression) else x if isinstance(x, Column) else F.lit(x)


def _div(a: Column, b: Column) -> Column:
    """Whole-number division, NULL for division by zero."""
    whole = F.try_divide(a, b)
    return F.when(whole < 0, F.ceil(whole)).otherwise(F.floor(whole))


def ColumnExpression(*names: str) -> Expression:  # noqa: N802
    """A column, its parts quoted one by one; ``*`` is all columns."""
    if names == ("*",):
        return StarExpression()
    return Expression(F.col(".".join("`" + n.replace("`", "``") + "`" for n in names)), names[-1])


def ConstantExpression(value: object) -> Expression:  # noqa: N802
    return Expression(_value(value))


def StarExpression(*, exclude: list[str | Expression] | None = None) -> Expression:  # noqa: N802
    """All columns but those in ``exclude``."""
    names = tuple(e.get_name() if isinstance(e, Expression) else e for e in exclude or ())
    return Expression(F.col("*"), "*", exclude=names)


def DefaultExpression() -> Expression:  # noqa: N802
    """A column's default value, in an insert."""
    return Expression(F.expr("DEFAULT"))


def CaseExpression(condition: object, value: object) -> Expression:  # noqa: N802
    return Expression(F.when(column_of(condition), _value(value)))


def FunctionExpression(name: str, *args: object) -> Expression:  # noqa: N802
    """A call of a Spark function; names of the relational dialect are translated."""
    return Expression(F.call_function(FUNCTIONS.get(name.lower(), name), *[column_of(a) for a in args]))


def CoalesceOperator(*args: object) -> Expression:  # noqa: N802
    if not args:
        raise ValueError("CoalesceOperator needs an argument at least")
    return Expression(F.coalesce(*[column_of(a) for a in args]))


def LambdaExpression(names: str | tuple[str, ...], body: object) -> Callable[..., Column]:  # noqa: N802
    """A function for higher-order functions; in ``body`` the parameters are columns of these names,
    or ``body`` is a Python function of expressions, or SQL text."""
    names = (names,) if isinstance(names, str) else tuple(names)
    if callable(body) and not isinstance(body, Expression):
        return _of_arity(len(names), lambda *xs: column_of(body(*[Expression(x) for x in xs])))
    if isinstance(body, str):
        sql = f"({', '.join(names)}) -> {rewrite(body)}"
        return sql  # type: ignore[return-value]
    raise TypeError("the body of a lambda is a function or SQL text")


def _of_arity(n: int, f: Callable[..., Column]) -> Callable[..., Column]:
    return {1: lambda x: f(x), 2: lambda x, y: f(x, y), 3: lambda x, y, z: f(x, y, z)}[n]


def SQLExpression(sql: str) -> Expression:  # noqa: N802
    """One expression of the relational dialect."""
    return Expression(F.expr(rewrite(sql)))

"""Python functions in queries: per row or per Arrow batch, with policies for NULLs and errors."""

from __future__ import annotations

import functools
import inspect
from collections.abc import Callable
from typing import Any, get_type_hints

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from .types import data_type


def vectorized(f: Callable) -> Callable:
    """Marks a function as one that takes and gives Arrow arrays."""
    f.__vectorized__ = True
    return f


def signature(f: Callable, parameters: list | None, return_type: Any) -> tuple[list | None, Any]:
    """Types from annotations where none are given; a return type is needed."""
    hints = get_type_hints(f)
    if return_type is None:
        return_type = hints.get("return")
    if return_type is None:
        raise ValueError("a return type is needed, by annotation or argument")
    if parameters is None:
        names = [p.name for p in inspect.signature(f).parameters.values() if p.kind in (p.POSITIONAL_ONLY, p.POSITIONAL_OR_KEYWORD)]
        parameters = [hints[n] for n in names] if all(n in hints for n in names) and names else None
    return parameters, return_type


def build(
    f: Callable, parameters: list | None = None, return_type: Any = None, *, kind: str = "native", null_handling: str = "default",
    exception_handling: str = "default", side_effects: bool = False,
) -> Any:
    """A Spark function of ``f``.

    ``kind``: ``native`` calls it for each row, ``arrow`` for each batch. ``null_handling``:
    ``default`` gives NULL for any NULL argument without a call, and a NULL result is an error;
    ``special`` passes NULLs on. ``exception_handling``: ``return_null`` gives NULL for an error.
    """
    arrow = kind == "arrow" or getattr(f, "__vectorized__", False)
    _, result = signature(f, parameters, return_type) if not arrow or return_type is None else (None, return_type)
    out_type = data_type(result)
    special, quiet = null_handling == "special", exception_handling == "return_null"

    if arrow:

        @functools.wraps(f, assigned=("__name__", "__doc__"), updated=())
        def batch(*columns: pd.Series) -> pd.Series:
            arrays = [pa.array(c, from_pandas=True) for c in columns]
            size = len(arrays[0]) if arrays else 0
            keep = None
            if not special and any(a.null_count for a in arrays):
                keep = functools.reduce(lambda x, y: x & y, [a.is_valid().to_numpy(zero_copy_only=False) for a in arrays])
                arrays = [a.filter(pa.array(keep)) for a in arrays]
            try:
                out = f(*arrays)
            except Exception:
                if not quiet:
                    raise
                return pd.Series([None] * size, dtype=object)
            out = (out.combine_chunks() if isinstance(out, pa.ChunkedArray) else pa.array(out) if not isinstance(out, pa.Array) else out).to_pandas()
            if keep is None:
                return out
            full = pd.Series([None] * size, dtype=object)
            full[keep] = out.to_numpy()
            return full

        batch.__wrapped__ = None
        del batch.__wrapped__
        batch.__annotations__ = {"columns": pd.Series, "return": pd.Series}
        made = F.pandas_udf(batch, out_type)
    else:

        def row(*args: Any) -> Any:
            if not special and any(a is None for a in args):
                return None
            try:
                out = f(*args)
            except Exception:
                if quiet:
                    return None
                raise
            if out is None and not special:
                raise ValueError("the function returned NULL; use null_handling='special'")
            return out

        row.__name__ = getattr(f, "__name__", "udf")
        made = F.udf(row, out_type, useArrow=True)
    return made.asNondeterministic() if side_effects else made

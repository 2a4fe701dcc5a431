"""Arrow UDFs made on use: importing a module needs no session."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _fields(kind: str) -> list[str] | None:
    """The field names of a flat struct type, None for any other type."""
    return re.findall(r"[<,]\s*(\w+):", kind) if kind.startswith("struct<") else None


def _packed(values: list, fields: list[str] | None) -> pd.Series | pd.DataFrame:
    return pd.Series(values, dtype=object) if fields is None else pd.DataFrame.from_records(values, columns=fields).astype(object)


def _plain(s: pd.Series) -> pd.Series:
    return s.astype(object).where(s.notna(), None)


#: Results that a task remembers before it forgets them all.
REMEMBERED = 200_000


def mapped(fn: Callable, kind: str, *cols: Column | str) -> Column:
    """``fn`` of the columns; a task remembers what it has computed for values that come again. Null and NaN come as None."""
    fields = _fields(kind)
    known: dict = {}

    def run(*series: pd.Series) -> pd.Series | pd.DataFrame:
        if len(known) > REMEMBERED:
            known.clear()
        rows = list(zip(*map(_plain, series)))
        for r in rows:
            if r not in known:
                known[r] = fn(*r)
        return _packed([known[r] for r in rows], fields)

    if len(cols) == 1:
        return F.pandas_udf(lambda a: run(a), kind)(*cols)
    return F.pandas_udf(lambda *a: run(*a), kind)(*cols)


def each(fn: Callable, kind: str, col: Column | str) -> Column:
    """``fn`` of each value, for values that rarely repeat. Null comes as None."""
    fields = _fields(kind)
    return F.pandas_udf(lambda s: _packed([fn(v) for v in _plain(s)], fields), kind)(col)

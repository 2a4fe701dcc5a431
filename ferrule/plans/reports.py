"""Reports as Markdown and JSON, from results that are small by nature: aggregates, top-k lists."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame


def _rows(df: DataFrame, most: int) -> list[dict]:
    rows = [r.asDict(recursive=True) for r in df.limit(most + 1).collect()]
    if len(rows) > most:
        raise ValueError(f"a report is made of at most {most} rows")
    return rows


def markdown_table(df: DataFrame, most: int = 1000) -> str:
    """A result as a Markdown table; numbers rounded to 4 places."""
    form = lambda v: "" if v is None else f"{v:.4f}".rstrip("0").rstrip(".") if isinstance(v, float) else str(v).replace("|", "\\|")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    return "\n".join([*lines, *("| " + " | ".join(form(r[c]) for c in df.columns) + " |" for r in _rows(df, most))])


def rounded(value: object, places: int = 6) -> object:
    """A nested result with all its floats rounded."""
    if isinstance(value, float):
        return round(value, places)
    if isinstance(value, dict):
        return {k: rounded(v, places) for k, v in value.items()}
    return [rounded(v, places) for v in value] if isinstance(value, list) else value


def report(title: str, parts: dict[str, DataFrame], most: int = 1000) -> str:
    """A Markdown report with a part for each result."""
    return "\n\n".join([f"# {title}", *(f"## {name}\n\n{markdown_table(df, most)}" for name, df in parts.items())]) + "\n"


def as_json(parts: dict[str, DataFrame], most: int = 1000) -> str:
    return json.dumps({k: rounded(_rows(df, most)) for k, df in parts.items()}, ensure_ascii=False, indent=1, default=str)

"""Model calls as batch hooks: a function from texts to answers runs in the executors; a stub stands in for models here."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Hook = Callable[[list[str]], list[str]]


class Denied(Exception):
    """An answer that asking again won't change, such as a failed login."""


def first_object(text: str | None) -> dict | None:
    """The first JSON object in free text."""
    decoder = json.JSONDecoder()
    for i, c in enumerate(text or ""):
        if c == "{":
            try:
                found, _ = decoder.raw_decode(text[i:])
            except ValueError:
                continue
            if isinstance(found, dict):
                return found
    return None


def flatten_content(content: object) -> str:
    """The text of an answer that may be a text, a list of blocks or a block."""
    if isinstance(content, list):
        return "\n".join(filter(None, map(flatten_content, content)))
    if isinstance(content, dict):
        return str(content.get("text") or content.get("content") or "")
    return "" if content is None else str(content)


def with_retry(call: Callable[[], str], attempts: int = 3, base: float = 5.0, sleep: Callable[[float], None] = time.sleep) -> str:
    """The answer, asking again after 1, 2, ... times ``base`` seconds; a denial is passed on at once."""
    for i in range(1, attempts + 1):
        try:
            return call()
        except Denied:
            raise
        except Exception:
            if i == attempts:
                raise
            sleep(base * i)
    raise AssertionError


def ask(df: DataFrame, prompt: Column, hook: Hook, out: str = "answer", batch: int = 16, attempts: int = 3, base: float = 5.0) -> DataFrame:
    """``df`` with the hook's answers: ``out``, and ``error`` where a batch failed for good. A bad row fails no job."""
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields], f"`{out}` string", "error string"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), batch):
                part = b.iloc[i : i + batch]
                try:
                    answers: list[str | None] = with_retry(lambda p=part: hook(list(p["_prompt"])), attempts, base)
                    errors: list[str | None] = [None] * len(part)
                except Exception as e:
                    answers, errors = [None] * len(part), [f"{type(e).__name__}: {e}"] * len(part)
                yield part.drop(columns=["_prompt"]).assign(**{out: answers, "error": errors})

    return df.withColumn("_prompt", prompt).mapInPandas(run, schema)


def ask_once(df: DataFrame, keys: list[str], prompt: Column, hook: Hook, out: str = "answer") -> DataFrame:
    """As :func:`ask`, but once for each distinct key; the answers are joined back."""
    asked = ask(df.select(*keys).distinct(), prompt, hook, out)
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    return df.alias("a").join(asked.alias("b"), on, "left").select("a.*", f"b.{out}", "b.error")


def stub(prompts: list[str]) -> list[str]:
    """A deterministic stand-in for a model."""
    return [json.dumps({"length": len(p or ""), "words": len((p or "").split())}) for p in prompts]


def prompt_of(template: str, **columns: Column) -> Column:
    """A template with its {names} replaced by columns."""
    out = F.lit(template)
    for name, c in columns.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(c.cast("string"), F.lit("")))
    return out


def listed(items: Column, most: int = 15) -> Column:
    """The first items of a list as lines, and how many more there are."""
    more = F.size(items) - most
    return F.concat(F.array_join(F.slice(items, 1, most), "\n"), F.when(more > 0, F.concat(F.lit("\n... and "), more.cast("string"), F.lit(" more"))).otherwise(""))


def needs_rerun(confidence: Column, rationale: Column, asked: Column, count: Column, most: int) -> Column:
    """Whether an extraction is made again: asked for or without a valid judgement, and runs are left."""
    invalid = (F.coalesce(confidence, F.lit(0.0)) == 0) & (F.coalesce(F.trim(rationale), F.lit("")) == "")
    return (F.coalesce(asked, F.lit(False)) | invalid) & (count < most)


def collapsed(before: DataFrame, after: DataFrame, key: str, signature: list[str]) -> DataFrame:
    """(key) of papers whose correction has fewer rows and lost a signature."""
    n = before.groupBy(key).agg(F.count("*").alias("b")).join(after.groupBy(key).agg(F.count("*").alias("a")), key, "left").where(F.coalesce("a", F.lit(0)) < F.col("b"))
    on = [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in [key, *signature]]
    lost = before.select(key, *signature).distinct().alias("x").join(after.select(key, *signature).distinct().alias("y"), on, "left_anti")
    return n.select(key).join(lost.select(key).distinct(), key, "left_semi")

"""Rules, prompts and settings from files; all of it is small and read on the driver."""

from __future__ import annotations

import re
import shutil
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def _yaml(path: str) -> dict:
    try:
        import yaml
    except ImportError as e:  # an optional library
        raise RuntimeError("reading YAML needs the yaml library") from e
    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


def rules(path: str, required: tuple[str, ...] = ()) -> dict:
    """A rule file, its patterns compiled once to prove that they are ones."""
    found = _yaml(path)
    if missing := [k for k in required if k not in found]:
        raise KeyError(f"{path} lacks {', '.join(missing)}")
    for patterns in (found.get("parameter_patterns") or {}).values():
        for p in patterns:
            re.compile(p)
    return found


def rule_table(spark: SparkSession, mapping: dict[str, list[str] | str]) -> DataFrame:
    """(raw, key, ord) of a rule mapping, in its order."""
    rows = [(w, k, i) for i, (k, ws) in enumerate(mapping.items()) for w in ([ws] if isinstance(ws, str) else ws)]
    return spark.createDataFrame(rows, "raw string, key string, ord int")


@lru_cache(maxsize=64)
def templates(path: str, required: tuple[str, ...] = ()) -> dict:
    """Prompt templates, read once; a missing one is an error."""
    found = _yaml(path)
    if missing := [k for k in required if not found.get(k)]:
        raise KeyError(f"{path} lacks {', '.join(missing)}")
    return found


def contract(template: str, phrases: list[str]) -> list[str]:
    """The phrases that a template must hold and doesn't."""
    return [p for p in phrases if p not in template]


def env_faults(text: str) -> list[str]:
    """Lines of a .env file with unbalanced quotes or without a value's name."""
    faults = []
    for i, line in enumerate(text.splitlines(), 1):
        s = line.strip()
        if not s or s.startswith("#"):
            continue
        name, eq, value = s.partition("=")
        if not eq or not re.fullmatch(r"(?:export\s+)?[A-Za-z_]\w*", name.strip()):
            faults.append(f"line {i}: no NAME=value")
        elif value.count('"') % 2 or value.count("'") % 2:
            faults.append(f"line {i}: unbalanced quotes")
    return faults


def clear_caches(root: str, name: str = "_ocr_cache") -> int:
    """Remove the cache folders below a folder; how many there were."""
    found = [p for p in Path(root).rglob(name) if p.is_dir()]
    for p in found:
        shutil.rmtree(p, ignore_errors=True)
    return len(found)

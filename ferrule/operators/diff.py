"""Differences between two copies of a table, by content-defined chunks.

Both sides are reduced to their current row of each key, range-partitioned together on the key and sorted.
Each side's key sequence is cut where a rolling hash of the last keys meets a condition, so an inserted or
lost row moves no cut further away. Equal ranges of both sides lie in the same partition, so fingerprints of
chunks are anti-joined there, as a merge, without another shuffle. Only rows of chunks without a twin leave the
Python stage; their fields are compared by the key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A cut is made where the rolling hash modulo CHUNK_ROWS is 0, hence CHUNK_ROWS is the mean chunk length.
CHUNK_ROWS = 32
#: Keys in the rolling window.
WINDOW = 3
#: A task decides its rows at the latest when it holds so many; a bound on memory, never on what is compared.
MOST_HELD = 100_000

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def current_rows(df: DataFrame, keys: dict[str, Column], fields: dict[str, Column], order: Sequence[Column]) -> DataFrame:
    """One row of each key: the greatest by ``order``. Aggregated before the shuffle, so hot keys are no burden.

    Null keys form a key of their own; of rows equal in ``order`` the greatest fields win, so the result is fixed.
    """
    packed = F.struct(*[c.alias(n) for n, c in fields.items()])
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], packed.alias("v"))
    return df.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(F.max(rank).alias("_rank")).select(*keys, *[F.col("_rank.v")[n].alias(n) for n in fields])


def _hash(cols: Sequence[str], seed: int) -> Column:
    """A 64-bit hash in which null, '' and a shift between columns differ."""
    return F.xxhash64(F.lit(seed), *[x for c in cols for x in (F.col(c).isNull(), F.coalesce(F.col(c).cast("string"), F.lit("")))])


def _cuts(keys: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a chunk ends after each key, by the rolling hash over the last WINDOW keys; the new tail."""
    full = np.concatenate([tail, keys.astype(np.int64).view(np.uint64)])
    rolled = np.zeros(len(full), dtype=np.uint64)
    for i in range(min(WINDOW, len(full))):
        rolled[i:] += full[: len(full) - i] * _MULTIPLIERS[i]
    rolled ^= rolled >> np.uint64(29)
    return (rolled[len(tail) :] % np.uint64(CHUNK_ROWS)) == 0, full[-(WINDOW - 1) :]


def _antijoin(rows: pd.DataFrame) -> pd.DataFrame:
    """The rows of chunks whose fingerprint the other side lacks."""
    prints: list[dict[bytes, list[np.ndarray]]] = [{}, {}]
    side, cut, hashes = rows["_side"].to_numpy(), rows["_cut"].to_numpy(), rows[["_h1", "_h2"]].to_numpy(dtype=np.int64)
    for me in (0, 1):
        at = np.flatnonzero(side == me)
        for chunk in np.split(at, np.flatnonzero(cut[at])[:] + 1):
            if len(chunk):
                prints[me].setdefault(hashlib.blake2b(hashes[chunk].tobytes(), digest_size=16).digest(), []).append(chunk)
    keep = [c for me in (0, 1) for p, chunks in prints[me].items() if p not in prints[1 - me] for c in chunks]
    return rows.iloc[np.sort(np.concatenate(keep))] if keep else rows.iloc[:0]


def _unmatched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows, sorted by key, of chunks without a twin. Decided where both sides end a chunk at the same key."""
    held: pd.DataFrame | None = None
    tails = [np.zeros(0, dtype=np.uint64)] * 2
    internal = ["_cut", "_k", "_h1", "_h2"]
    for batch in batches:
        if batch.empty:
            continue
        cut, side = np.zeros(len(batch), dtype=bool), batch["_side"].to_numpy()
        for me in (0, 1):
            if (own := side == me).any():
                cut[own], tails[me] = _cuts(batch["_k"].to_numpy()[own], tails[me])
        batch = batch.assign(_cut=cut)
        held = batch if held is None or held.empty else pd.concat([held, batch], ignore_index=True)
        side, cut, key = held["_side"].to_numpy(), held["_cut"].to_numpy(), held["_k"].to_numpy()
        clean = np.append(key[1:] != key[:-1], False)
        ends = np.flatnonzero(clean)
        for me in (0, 1):
            #: The last row of this side so far, at each position; -1 where it has none.
            last = np.maximum.accumulate(np.where(side == me, np.arange(len(held)), -1))
            clean &= (last < 0) | cut[last]
        at = np.flatnonzero(clean)
        if not len(at) and len(held) > MOST_HELD:
            at = ends
        if len(at):
            yield _antijoin(held.iloc[: at[-1] + 1]).drop(columns=internal)
            held = held.iloc[at[-1] + 1 :].reset_index(drop=True)
    if held is not None and len(held):
        yield _antijoin(held).drop(columns=internal)


def unmatched_rows(left: DataFrame, right: DataFrame, keys: Sequence[str], fields: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows (_side 0 or 1, keys, fields) of chunks that the other copy does not hold in the same form.

    Both frames hold string columns ``keys`` and ``fields`` and one row of each key.
    """
    both = left.select(F.lit(0).alias("_side"), *keys, *fields).unionByName(right.select(F.lit(1).alias("_side"), *keys, *fields))
    both = both.select("*", _hash(keys, 1).alias("_k"), _hash([*keys, *fields], 2).alias("_h1"), _hash([*keys, *fields], 3).alias("_h2"))
    ranged = both.repartitionByRange(*([partitions] if partitions else []), *keys).sortWithinPartitions(*keys, "_side")
    schema = ", ".join(["_side int", *[f"`{c}` string" for c in (*keys, *fields)]])
    return ranged.mapInPandas(_unmatched, schema)


def diff_tables(left: DataFrame, right: DataFrame, keys: Sequence[str], fields: Sequence[str], only_left: str, only_right: str) -> DataFrame:
    """Keys missing on either side and fields that differ: (keys, diff_kind, left_value, right_value).

    ``left`` and ``right`` hold one row of each key (see :func:`current_rows`). Null and '' differ, null equals null,
    also in keys. Empty tables give the other side's keys or nothing; columns beyond keys and fields are not read.
    """
    rows = unmatched_rows(left, right, keys, fields)
    value = F.struct(*fields)
    sides = rows.groupBy(*keys).agg(*[F.max(F.when(F.col("_side") == i, value)).alias(f"_{n}") for i, n in enumerate("lr")])
    kinds = [F.when(F.col("_l").isNull(), F.array(_kind(only_right))).when(F.col("_r").isNull(), F.array(_kind(only_left)))]
    fieldwise = F.filter(F.array(*[_kind(f, f) for f in fields]), lambda k: ~k["left_value"].eqNullSafe(k["right_value"]))
    return sides.select(*keys, F.explode(kinds[0].otherwise(fieldwise)).alias("_kind")).select(*keys, "_kind.*")


def _kind(kind: str, field: str | None = None) -> Column:
    side = [F.col(f"_{s}.{field}") if field else F.lit(None).cast("string") for s in "lr"]
    return F.struct(F.lit(kind).alias("diff_kind"), side[0].alias("left_value"), side[1].alias("right_value"))

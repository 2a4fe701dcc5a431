"""Texts into containers of fixed capacity with as little unused space as possible.

Minimum bin slack: in a window of items a container takes the longest remaining item and then, of all multisets of
remaining lengths, the one that comes closest to the capacity. A bitset holds which sums can be reached; it is grown
by the counts of each length in binary parts, and walked back to the counts that make the best sum.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrule.session import cut

#: Containers that a window's items fill on average: what bounds a task, and the one container a window may leave unfilled.
WINDOW_CONTAINERS = 400

#: Capacities that may be asked for at once; more are an error.
MOST_PACKS = 1_000

OUT = "pack_id bigint, container_id bigint, slot int, doc_id bigint, piece int, n_tokens bigint, fill bigint"


def best_subset(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length to take so that their sum is as near to ``room`` as possible without exceeding it."""
    mask, reached, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x in counts if 0 < x <= room), reverse=True):
        left, part = min(counts[length], room // length), 1
        while left:
            take = min(part, left)
            steps.append((length, take, reached))
            reached |= (reached << (length * take)) & mask
            left, part = left - take, part * 2
            if reached >> room & 1:
                left = 0
        if reached >> room & 1:
            break
    total = reached.bit_length() - 1
    chosen: dict[int, int] = defaultdict(int)
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] += take
            total -= length * take
    return chosen


def pack(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Positions of items by container; no length may exceed the capacity. Items of length 0 join the first container."""
    queues: dict[int, list[int]] = defaultdict(list)
    for i in np.argsort(-np.arange(len(lengths)), kind="stable"):
        queues[int(lengths[i])].append(int(i))
    empty = queues.pop(0, [])
    counts = {x: len(q) for x, q in queues.items()}
    order, at, out = sorted(counts, reverse=True), 0, []
    while at < len(order):
        if not counts[order[at]]:
            at += 1
            continue
        first = order[at]
        counts[first] -= 1
        box = [queues[first].pop()]
        for x, n in sorted(best_subset({k: c for k, c in counts.items() if c}, capacity - first).items(), reverse=True):
            counts[x] -= n
            box += [queues[x].pop() for _ in range(n)]
        out.append(box)
    if empty:
        out[:1] = [(out[0] if out else []) + empty[::-1]]
    return out


def _window(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["doc_id", "piece"], kind="stable").reset_index(drop=True)
    rows = []
    tokens = pdf["n_tokens"].to_numpy()
    for k, box in enumerate(pack(tokens, int(pdf["capacity_tokens"].iloc[0]))):
        fill = int(tokens[box].sum())
        rows += [(k, slot, i, fill) for slot, i in enumerate(box)]
    k, slot, i, fill = map(np.array, zip(*rows))
    picked = pdf.iloc[i]
    window = picked["window"].to_numpy(dtype=np.int64)
    return pd.DataFrame({"pack_id": picked["pack_id"].to_numpy(), "container_id": window * 1_000_000 + k, "slot": slot, "doc_id": picked["doc_id"].to_numpy(), "piece": picked["piece"].to_numpy(), "n_tokens": picked["n_tokens"].to_numpy(), "fill": fill})


def fill_containers(sizes: DataFrame, packs: DataFrame) -> DataFrame:
    """(pack_id, container_id, slot, doc_id, piece, n_tokens, fill): every text in containers of each capacity.

    ``sizes``: (doc_id, n_tokens), one row for each text. Texts longer than a capacity alone are split into full pieces
    and a remainder, numbered from 0. Items go to windows by a hash of text and piece, so windows are alike in size
    whatever the keys; the number of windows follows from the total size. Texts without tokens take a slot of size 0.
    """
    sizes = cut(sizes)
    capacities = packs.select("pack_id", F.col("capacity_tokens").cast("bigint").alias("capacity_tokens")).where("capacity_tokens > 0").dropDuplicates(["pack_id"])
    total = sizes.agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n")).collect()[0]
    # pack_sizes is a parameter table of a few rows, which is checked; each text is repeated once for each capacity.
    if capacities.count() > MOST_PACKS:
        raise ValueError(f"more than {MOST_PACKS} pack sizes: each text is repeated for each of them")
    pieces = sizes.crossJoin(F.broadcast(capacities))
    whole = F.col("n_tokens") <= F.col("capacity_tokens")
    last = F.when(whole, 0).otherwise(F.ceil(F.col("n_tokens") / F.col("capacity_tokens")).cast("int") - 1)
    pieces = pieces.select("pack_id", "capacity_tokens", "doc_id", "n_tokens", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    own = F.least(F.col("capacity_tokens"), F.col("n_tokens") - F.col("piece") * F.col("capacity_tokens"))
    pieces = pieces.select("pack_id", "capacity_tokens", "doc_id", "piece", own.alias("n_tokens"))
    windows = F.greatest(F.ceil(F.lit(int(total.t or 0)) / (F.col("capacity_tokens") * WINDOW_CONTAINERS)), F.ceil(F.lit(int(total.n)) / F.lit(20_000))).cast("bigint")
    pieces = pieces.withColumn("window", F.pmod(F.xxhash64("doc_id", "piece", F.lit(42)), F.greatest(windows, F.lit(1).cast("bigint"))))
    return pieces.groupBy("pack_id", "window").applyInPandas(_window, OUT)


def fill_rates(packed: DataFrame, packs: DataFrame) -> DataFrame:
    """(pack_id, capacity_tokens, n_containers, n_tokens, fill_share): how full the containers of each capacity are."""
    boxes = packed.groupBy("pack_id", "container_id").agg(F.sum("n_tokens").alias("n"))
    summed = boxes.groupBy("pack_id").agg(F.count("*").alias("n_containers"), F.sum("n").alias("n_tokens"))
    out = summed.join(packs.select("pack_id", "capacity_tokens"), "pack_id")
    return out.select("pack_id", "capacity_tokens", "n_containers", "n_tokens", (F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens"))).alias("fill_share"))

"""Texts of several sources mixed to target shares of the tokens.

Equal-token blocks are allotted to sources by Sainte-Laguë's highest quotients, then each source's blocks to shards in
the same way, by what a shard holds of the source. Within a shard a seeded order of the source's texts says which
blocks are drawn; where a source is drawn more than once, whole passes come first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferrule.session import cut

BLOCK_TOKENS = 1024
#: Tokens of a shard: what one task of the seeded selection sorts.
SHARD_TOKENS = 20_000_000
#: Sources that may be listed; more are an error.
MOST_SOURCES = 100_000


def sainte_lague(weights: Sequence[float], seats: int, most: Sequence[float] | None = None) -> list[int]:
    """Seats by highest quotients weight / (2k + 1); ties go to the earlier party, ``most`` caps a party's seats.

    The quotient of the last seat is found by bisection and only the seats at its edge are handed out singly, so the
    work doesn't grow with the number of seats.
    """
    n = len(weights)
    caps = [float("inf") if most is None else int(most[i]) for i in range(n)]
    open_ = [i for i in range(n) if weights[i] > 0 and caps[i] > 0]
    if not open_ or seats <= 0:
        return [0] * n
    seats = int(min(seats, sum(caps[i] for i in open_)))

    def held(divisor: float) -> list[int]:
        out = [0] * n
        for i in open_:
            out[i] = int(min(caps[i], weights[i] / divisor + 0.5))
        return out

    low, high = min(weights[i] for i in open_) / (4 * seats + 4), 2 * max(weights[i] for i in open_) + 1
    for _ in range(400):
        middle = (low * high) ** 0.5
        low, high = (middle, high) if sum(held(middle)) > seats else (low, middle)
        if high / low < 1 + 1e-13:
            break
    out = held(high)
    while (left := seats - sum(out)) > 0:
        best = max((i for i in open_ if out[i] < caps[i]), key=lambda i: (weights[i] / (2 * out[i] + 1), -i))
        out[best] += 1
        if left > 10 * n + 10:  # many equal quotients at the edge
            out[best] += int(min(caps[best] - out[best], left // (2 * n)))
    return out


def plan(available: dict[str, int], targets: list[tuple[str, float, int]], block: int = BLOCK_TOKENS) -> tuple[int, dict[str, int]]:
    """(total tokens, blocks of each source): the largest mix whose shares all sources can supply within their repeats.

    A source without any text can't be supplied; the others then share by their own targets.
    """
    usable = [(s, w, r) for s, w, r in targets if w and w > 0 and available.get(s, 0) > 0 and r and r > 0]
    if not usable:
        return 0, {}
    whole = sum(w for _, w, _ in usable)
    total = min(r * available[s] * whole / w for s, w, r in usable)
    blocks = sainte_lague([w for _, w, _ in usable], max(1, int(total // block)), [max(1, -(-r * available[s] // block)) for s, _, r in usable])
    return int(total), {s: b for (s, _, _), b in zip(usable, blocks)}


def mix(sizes: DataFrame, targets: DataFrame, seed: int = 42, block: int = BLOCK_TOKENS, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(doc_id, source, n_tokens, repeats) of the texts drawn.

    ``sizes``: (doc_id, source, n_tokens). Texts of no or an unlisted source, and those without tokens, are not drawn.
    What comes to the driver: sums by source and shard, a row for each some ten million tokens.
    """
    listed = targets.select("source", "target_share", "max_repeats").limit(MOST_SOURCES + 1).collect()
    if len(listed) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    wanted = [(r.source, float(r.target_share or 0), int(r.max_repeats or 0)) for r in listed if r.source is not None]
    sizes = cut(sizes.where("n_tokens > 0").where(F.col("source").isin([w[0] for w in wanted])))
    total = sizes.agg(F.sum("n_tokens")).collect()[0][0] or 0
    shards = max(1, -(-int(total) // shard_tokens))
    placed = sizes.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(shards)).cast("int"))
    held: dict[str, dict[int, int]] = {}
    for r in placed.groupBy("source", "shard").agg(F.sum("n_tokens").alias("n")).collect():
        held.setdefault(r.source, {})[r.shard] = int(r.n)
    _, blocks = plan({s: sum(h.values()) for s, h in held.items()}, wanted, block)
    repeats = {s: r for s, _, r in wanted}
    quotas = []
    for s, b in blocks.items():
        at = sorted(held[s])
        caps = [max(1, -(-held[s][h] * repeats[s] // block)) for h in at]
        for h, q in zip(at, sainte_lague([held[s][h] for h in at], b, caps)):
            tokens = min(q * block, repeats[s] * held[s][h])
            quotas.append((s, h, int(tokens // held[s][h]), int(tokens % held[s][h])))
    spark = sizes.sparkSession
    quota = spark.createDataFrame(quotas, "source string, shard int, passes int, rest bigint")
    order = Window.partitionBy("source", "shard").orderBy(F.xxhash64("doc_id", F.lit(seed + 1)), "doc_id")
    before = F.coalesce(F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    drawn = placed.join(quota, ["source", "shard"]).withColumn("before", before)
    extra = (F.col("before") + F.col("n_tokens") / 2 <= F.col("rest")).cast("int")
    return drawn.select("doc_id", "source", "n_tokens", (F.col("passes") + extra).alias("repeats")).where("repeats > 0")


def shares(drawn: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, reached_share, n_tokens, n_texts, most_repeats): what each source contributes."""
    by = drawn.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("n_tokens"), F.count("*").alias("n_texts"), F.max("repeats").alias("most_repeats"))
    whole = by.agg(F.sum("n_tokens").alias("all_tokens"))
    out = targets.join(by, "source", "left").crossJoin(F.broadcast(whole))
    n = F.coalesce("n_tokens", F.lit(0).cast("bigint"))
    return out.select("source", "target_share", F.coalesce(n / F.col("all_tokens"), F.lit(0.0)).alias("reached_share"), n.alias("n_tokens"), F.coalesce("n_texts", F.lit(0).cast("bigint")).alias("n_texts"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"))

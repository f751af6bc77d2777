"""Temperature mixing of sources, realised as budgeted block permutations.

A source with token share ``p`` gets a weight in proportion to ``p ** exponent``. The exponent is bisected, many cuts of
the interval in each pass over the source totals, until the weights have the wanted entropy or no source is repeated
more often than allowed. A weight times the budget is a number of epochs: whole ones use every row of the source again,
the last one uses the rows of a random permutation until its tokens are spent. The permutation is by blocks of rows, so
only the block where the budget ends is looked into row by row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import fresh
from tokenloom.session import materialise

BLOCK_ROWS = 4096
_CUTS = 64
_PASSES = 4
_WORD = r"[^\x20\x09-\x0D]+"


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def _moments(shares: DataFrame, exponents: list[float]) -> dict[float, tuple[float, float]]:
    """Per exponent: the sum of ``p ** e``, and the entropy of the weights as a share of the largest possible one."""
    power = F.exp(F.col("e") * F.log("p"))
    each = shares.select("p", F.explode(F.lit(exponents).cast("array<double>")).alias("e"))
    found = each.groupBy("e").agg(F.sum(power).alias("z"), F.sum(power * F.log("p")).alias("s"), F.count("*").alias("n"))
    out = {}
    for e, z, s, n in found.collect():
        out[e] = (z, (math.log(z) - e * s / z) / math.log(n) if n > 1 else 1.0)
    return out


def bisect_exponent(
    shares: DataFrame, total: int, budget: int | None, target_entropy: float | None, max_epochs: float | None
) -> float:
    """The exponent for sources ``p`` of ``total`` tokens; a wanted entropy and a repetition limit both hold if they can.

    Entropy falls as the exponent grows, and so do the most epochs of a source up to exponent 1, where all are equal.
    The exponent that satisfies the entropy is raised, at most to 1, where the limit asks for it.
    """
    least = math.log(shares.agg(F.min("p")).first()[0])
    most = math.log(shares.agg(F.max("p")).first()[0])

    def epochs(e: float, z: float) -> float:
        if budget is None:
            return math.exp((e - 1) * (least - most))
        return budget / total / z * math.exp((e - 1) * (least if e <= 1 else most))

    def least_exponent(low: float, high: float, holds) -> float:
        """The least of the interval at which ``holds``, which stays true above it; its upper end if nowhere."""
        for _ in range(_PASSES):
            grid = [low + (high - low) * i / _CUTS for i in range(_CUTS + 1)]
            found = _moments(shares, grid)
            at = next((i for i, e in enumerate(grid) if holds(e, *found[e])), _CUTS)
            low, high = grid[max(0, at - 1)], grid[at]
        return high

    exponent = 1.0
    if target_entropy is not None:
        exponent = least_exponent(0.0, 8.0, lambda e, z, h: h <= target_entropy)
    elif max_epochs is not None:
        exponent = 0.0
    if max_epochs is not None and exponent < 1:
        exponent = least_exponent(exponent, 1.0, lambda e, z, h: epochs(e, z) <= max_epochs)
    # Sums may differ in their last digits between runs; the exponent must not.
    return round(exponent, 6)


def mixing_plan(
    docs: DataFrame,
    budget: int | None = None,
    target_entropy: float | None = None,
    max_epochs: float | None = 4.0,
    seed: int = 42,
) -> DataFrame:
    """Per source: ``tokens``, ``n_rows``, ``weight``, ``epochs``, and the cut ``(whole, blocks, cut_block, cut_key)``.

    ``budget`` is in tokens; without one it is the least that uses every source whole, so no row is left out. A null
    source is a source of its own. A source without tokens has weight 0 and its rows are used once.
    """
    rows = docs.select(F.col("source"), n_tokens(F.col("text")).alias("tokens"), _key(seed).alias("key"))
    rows = materialise(rows)
    sums = materialise(rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n_rows")))
    total = sums.agg(F.sum("tokens")).first()[0] or 0
    shares = sums.filter("tokens > 0").withColumn("p", F.col("tokens") / F.lit(float(total or 1)))
    if total:
        exponent = bisect_exponent(shares, total, budget, target_entropy, max_epochs)
        z = _moments(shares, [exponent])[exponent][0]
        weight = F.round(F.exp(F.lit(exponent) * F.log("p")) / F.lit(z), 12)
        weighted = shares.withColumn("weight", weight)
        if budget is None:
            budget = math.ceil(weighted.agg(F.max(F.col("tokens") / F.col("weight"))).first()[0])
        weighted = weighted.withColumn("epochs", F.round(F.col("weight") * F.lit(float(budget)) / F.col("tokens"), 9)).drop("p")
    else:
        weighted = shares.select("source", "tokens", "n_rows", F.lit(0.0).alias("weight"), F.lit(1.0).alias("epochs"))
    silent = sums.filter("tokens = 0").select("*", F.lit(0.0).alias("weight"), F.lit(1.0).alias("epochs"))
    plan = weighted.unionByName(silent).select(
        "*",
        F.floor("epochs").cast("int").alias("whole"),
        F.floor((F.col("epochs") - F.floor("epochs")) * F.col("tokens")).cast("long").alias("rest"),
        F.ceil(F.col("n_rows") / BLOCK_ROWS).cast("long").alias("blocks"),
    )
    plan = materialise(plan)
    return _with_cuts(rows, plan)


def _key(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(key, blocks)


def _place(key: Column) -> Column:
    return F.xxhash64(key)


def _with_cuts(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The block in which the rest of the budget ends, and the last row key in it that is still within."""
    same = rows["source"].eqNullSafe(plan["source"])
    placed = rows.join(plan.select("source", "blocks", "rest"), same).select(
        plan["source"], "rest", "tokens", _block(F.col("key"), F.col("blocks")).alias("block"), _place(F.col("key")).alias("place")
    )
    totals = placed.groupBy("source", "rest", "block").agg(F.sum("tokens").alias("tokens"))
    running = F.sum("tokens").over(Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, 0))
    ends = totals.withColumn("end", running).filter(F.col("end") > F.col("rest"))
    cut = ends.groupBy("source").agg(F.min(F.struct("block", "tokens", "end")).alias("x")).select(
        F.col("source").alias("cut_source"), F.col("x.block").alias("cut_block"), (F.col("x.end") - F.col("x.tokens")).alias("spent")
    )
    cut = materialise(cut)
    own = placed.join(cut, placed["source"].eqNullSafe(cut["cut_source"]) & (placed["block"] == cut["cut_block"]))
    within = F.sum("tokens").over(Window.partitionBy("source").orderBy("place"))
    last = own.withColumn("used", F.col("spent") + within).filter("used <= rest").groupBy("cut_source").agg(F.max("place").alias("cut_key"))
    last = last.select(F.col("cut_source").alias("last_source"), "cut_key")
    with_block = plan.join(cut, plan["source"].eqNullSafe(cut["cut_source"]), "left")
    with_key = with_block.join(last, with_block["source"].eqNullSafe(last["last_source"]), "left")
    return materialise(with_key.drop("cut_source", "last_source", "spent"))


def mix(
    docs: DataFrame,
    budget: int | None = None,
    target_entropy: float | None = None,
    max_epochs: float | None = 4.0,
    seed: int = 42,
    epoch: str | None = None,
    order: str | None = None,
) -> DataFrame:
    """Every use of a row of ``docs(doc_id, text, source, …)``, with all its columns.

    ``epoch`` names a column for the number of the use, from 0; ``order`` one for a sort key from 0 to 1 that spreads
    every source evenly over the mixture and permutes blocks, and rows in them, anew in each epoch. Repeated rows have
    equal keys and are taken or left together; null ids and texts are ordinary values; an empty table stays empty.
    """
    plan = mixing_plan(docs, budget, target_entropy, max_epochs, seed)
    name = fresh(docs, "mix")
    packed = plan.select(F.struct("*").alias(name))
    joined = docs.join(packed, docs["source"].eqNullSafe(packed[name]["source"]))
    key = _key(seed)
    block, place = _block(key, F.col(f"{name}.blocks")), _place(key)
    before = block < F.coalesce(F.col(f"{name}.cut_block"), F.lit(0))
    within = (block == F.col(f"{name}.cut_block")) & (place <= F.col(f"{name}.cut_key"))
    uses = F.col(f"{name}.whole") + F.when(before | F.coalesce(within, F.lit(False)), 1).otherwise(0)
    count = fresh(docs, epoch or "use")
    numbers = F.when(uses > 0, F.sequence(F.lit(0), uses - 1)).otherwise(F.array().cast("array<int>"))
    used = joined.withColumn(count, F.explode(numbers))
    if order:
        # Blocks in the order of their hash in this epoch, rows in the order of theirs in the block.
        turn = F.pmod(F.xxhash64(F.col(count), block), F.lit(1 << 26)) * F.lit(float(1 << 26)) + F.pmod(
            F.xxhash64(F.col(count), place), F.lit(1 << 26)
        )
        used = used.withColumn(order, (F.col(count) + turn / F.lit(float(1 << 52))) / F.ceil(f"{name}.epochs"))
    return used.drop(name, *([] if epoch else [count]))

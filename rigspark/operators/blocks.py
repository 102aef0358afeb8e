"""Sorted values of many groups, in blocks of bounded size with running sums.

Ranks and sums up to a value are looked up: in a directory of the blocks first, then by halving inside
one block. What a look-up costs does not depend on how many values a group has beside that directory.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import cut, small

#: Values of a block, and parts of a group that are sorted apart.
BLOCK, PARTS = 4096, 256


def halvings(size: Column, most: int) -> Column:
    """The steps of ``leading`` that an array of ``size`` needs: those not above it."""
    return F.filter(F.array(*(F.lit(1 << i) for i in reversed(range(most.bit_length())))), lambda s: s <= size)


def leading(array: Column, holds: Callable[[Column], Column], most: int, steps: Column | None = None) -> Column:
    """How many elements at the head of ``array`` (at most ``most``) satisfy ``holds``, which no element after the first failing one does; by halving.

    ``steps``: the array's own ``halvings``, where it is short and met by many rows.
    """
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(most.bit_length())))) if steps is None else steps
    further = lambda at, by: at + F.when(F.coalesce(holds(F.get(array, at + by - 1)), F.lit(False)), by).otherwise(F.lit(0))
    return F.aggregate(steps, F.lit(0), further)


class SortedBlocks:
    """(keys, value, n) sorted by value within ``keys``; rows without key or value do not count.

    A group is cut into parts by a sketch of its values, so no task sorts a whole group; a directory has one
    row for every 4096 values. Both tables are written in the shared folder once and only read afterwards.
    """

    def __init__(self, values: DataFrame, keys: list[str]):
        self.keys = keys
        rows = cut(values.select(*keys, F.col("value").cast("double").alias("value"), F.col("n").cast("long").alias("n")).filter("value is not null"))
        shares = [i / PARTS for i in range(1, PARTS)]
        cuts = small(rows.groupBy(*keys).agg(F.percentile_approx("value", shares, 10_000).alias("__cuts")), PARTS)
        dealt = rows.join(cuts, keys).withColumn("part", leading(F.col("__cuts"), lambda c: c < F.col("value"), PARTS)).drop("__cuts")
        block = F.floor((F.row_number().over(Window.partitionBy(*keys, "part").orderBy("value")) - 1) / BLOCK).cast("int")
        inside = Window.partitionBy(*keys, "part", "block").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
        running = F.struct("value", F.sum("n").over(inside).alias("n"), F.sum(F.col("value") * F.col("n")).over(inside).alias("s"))
        self.blocks = cut(
            dealt.withColumn("block", block)
            .select(*keys, "part", "block", "value", "n", running.alias("run"))
            .groupBy(*keys, "part", "block")
            .agg(F.min("value").alias("low"), F.sum("n").alias("n"), F.sum(F.col("value") * F.col("n")).alias("s"), F.array_sort(F.collect_list("run")).alias("runs"))  # a block
        )
        before = Window.partitionBy(*keys).orderBy("part", "block").rowsBetween(Window.unboundedPreceding, -1)
        starts = {c: F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("n", "s")}
        self.directory = cut(self.blocks.select(*keys, "part", "block", "low", *(e.alias(f"{c}_before") for c, e in starts.items())))
        self.totals = cut(self.blocks.groupBy(*keys).agg(F.sum("n").alias("total")))

    def _found(self, probes: DataFrame, by: str, at_once: bool) -> DataFrame:
        """Each probe (keys, idx, at) beside the last block whose ``by`` is not above ``at``."""
        entry = F.struct("part", "block", "n_before", "s_before")
        known = self.directory.select(*self.keys, F.col(by).cast("double").alias("at"), F.lit(0).alias("kind"), F.lit(None).cast("int").alias("idx"), entry.alias("entry"))
        asked = probes.select(*self.keys, F.col("at").cast("double").alias("at"), F.lit(1).alias("kind"), F.col("idx").cast("int").alias("idx")).withColumn("entry", F.lit(None).cast(known.schema["entry"].dataType))
        upwards = Window.partitionBy(*self.keys).orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
        placed = known.union(asked).withColumn("entry", F.last("entry", ignorenulls=True).over(upwards)).filter("kind = 1 and entry is not null")
        placed = placed.select(*self.keys, "idx", "at", "entry.*")
        return self.blocks.select(*self.keys, "part", "block", "runs").join(F.broadcast(placed) if at_once else placed, [*self.keys, "part", "block"])

    def upto(self, probes: DataFrame, at_once: bool = False) -> DataFrame:
        """keys, idx, and count and sum of the values that are at most ``at``; no row where there are none. ``at_once`` says that the probes are few enough to be broadcast."""
        run = F.get("runs", leading(F.col("runs"), lambda r: r["value"] <= F.col("at"), BLOCK) - 1)
        found = self._found(probes, "low", at_once).withColumn("run", run)
        return found.select(*self.keys, "idx", (F.col("n_before") + F.col("run.n")).alias("n"), (F.col("s_before") + F.col("run.s")).alias("s"))

    def at_rank(self, probes: DataFrame, at_once: bool = False) -> DataFrame:
        """keys, idx, at, and the value of rank ``at`` (from 0)."""
        run = F.get("runs", leading(F.col("runs"), lambda r: r["n"] <= F.col("at") - F.col("n_before"), BLOCK))
        return self._found(probes, "n_before", at_once).select(*self.keys, "idx", "at", run["value"].alias("value"))

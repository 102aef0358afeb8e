"""Comparing two splat sets field by field."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.encoding import log_transform
from ..functions.geometry import quaternion_angle_deg, sigmoid
from .quantiles import at_share, select_ranks
from .rank import levelled_rank
from .scratch import cut, kept, small

KEYS = ("x", "y", "z", "vx", "vy", "vz")


def integer_keys(splats: DataFrame, ranges: DataFrame) -> DataFrame:
    """``k_x`` .. ``k_vz``: positions in the 16-bit steps of shared ranges, so that joins are exact."""
    from ..functions.encoding import split16
    from .quantize import _wide

    out = splats.join(F.broadcast(_wide(ranges)), "clip_id")  # one row a clip
    keys = {}
    for i, c in enumerate(KEYS):
        g = "means" if i < 3 else "motion"
        keys[f"k_{c}"] = split16(log_transform(F.col(c)), F.col(f"mn_{g}_{i % 3}"), F.col(f"mx_{g}_{i % 3}"))
    return out.withColumns(keys).select(*splats.columns, *keys)


def canonical_rank(splats: DataFrame) -> DataFrame:
    """``rank`` in the canonical order of a group; its upper bits of the first key deal it into 256 parts."""
    return levelled_rank(splats, ["clip_id", "grp"], F.shiftright("k_x", 8), [*(f"k_{c}" for c in KEYS), "splat_id"], "rank")


def ambiguous(splats: DataFrame) -> DataFrame:
    """Rows whose complete key equals that of the row before."""
    w = Window.partitionBy("clip_id", "grp").orderBy(*(f"k_{c}" for c in KEYS), "splat_id")
    key = F.struct(*(f"k_{c}" for c in KEYS))
    return splats.withColumn("__same", F.lag(key).over(w) == key).filter("__same").drop("__same")


def pair_splats(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """The k-th row of each group on both sides: ``columns`` as a_* and b_*."""
    side = lambda df, n: canonical_rank(df).select("clip_id", "grp", "rank", *(F.col(c).alias(f"{n}_{c}") for c in columns))
    return side(a, "a").join(side(b, "b"), ["clip_id", "grp", "rank"])


def displaced(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("clip_id").agg(F.sum((F.col("a_splat_id") != F.col("b_splat_id")).cast("long")).alias("displaced"))


def _apart() -> Column:
    return F.greatest(*(F.abs(F.col(f"a_k_{c}") - F.col(f"b_k_{c}")) for c in KEYS))


def membership(pairs: DataFrame) -> DataFrame:
    """Groups with pairs whose keys differ by more than one step, and how many. Pairs that were ``repaired`` do not count."""
    kept = pairs.filter(~F.col("repaired")) if "repaired" in pairs.columns else pairs
    return kept.filter(_apart() > 1).groupBy("clip_id", "grp").agg(F.count(F.lit(1)).alias("offenders"))


def repair_pairs(pairs: DataFrame, limit: float = 0.002) -> DataFrame:
    """Pairs whose keys disagree, however little, paired anew by nearest position inside their group, in row order; ``repaired`` marks them.

    Clips with more than ``limit`` of such pairs (but at least one is always allowed) are left as they are, and so is
    the only such row of a group. Pairs are written once and never dealt by group; only repaired ones move.
    """
    pairs = kept(pairs)
    off = _apart() > 0
    of_group = cut(pairs.groupBy("clip_id", "grp").agg(F.sum(off.cast("long")).alias("__near"), F.count(F.lit(1)).alias("__n")))
    of_clip = of_group.groupBy("clip_id").agg(F.sum("__near").alias("__wrong"), F.sum("__n").alias("__all"))
    few = F.col("__wrong") <= F.greatest(F.lit(1), F.floor(F.col("__all") * limit))
    mended = of_group.filter(F.col("__near") > 1).join(of_clip.filter(few), "clip_id").select("clip_id", "grp", F.lit(True).alias("__mended"))
    marked = pairs.join(small(mended, 3), ["clip_id", "grp"], "left").withColumn("repaired", F.coalesce(off & F.col("__mended"), F.lit(False))).drop("__mended")
    right = [c for c in pairs.columns if c.startswith("b_")]

    def nearest(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank").reset_index(drop=True)
        a, b = pdf[["a_x", "a_y", "a_z"]].to_numpy(), pdf[["b_x", "b_y", "b_z"]].to_numpy()
        free, taken = np.ones(len(b), bool), []
        for p in a:
            far = np.where(free, ((b - p) ** 2).sum(axis=1), np.inf)
            taken.append(int(far.argmin()))
            free[taken[-1]] = False
        pdf[right] = pdf[right].iloc[taken].to_numpy()
        return pdf

    fixed = marked.filter("repaired")
    again = cut(fixed.groupBy("clip_id", "grp").applyInPandas(nearest, fixed.schema))  # 0.2 % of a clip at most
    return marked.filter(~F.col("repaired")).unionByName(again)


def error_table(pairs: DataFrame, fields: list[str]) -> DataFrame:
    """clip_id, field, mean_error, p99_error, max_error; opacity in linear alpha."""
    value = lambda n, c: sigmoid(F.col(f"{n}_{c}")) if c == "opacity" else F.col(f"{n}_{c}").cast("double")
    errors = F.array(*(F.struct(F.lit(c).alias("field"), F.abs(value("a", c) - value("b", c)).alias("e")) for c in fields))
    long = pairs.select("clip_id", F.explode(errors).alias("r")).select("clip_id", F.col("r.field").alias("field"), F.col("r.e").alias("e"))
    means = long.groupBy("clip_id", "field").agg(F.avg("e").alias("mean_error"), F.max("e").alias("max_error"))
    return means.join(select_ranks(long, ["clip_id", "field"], [at_share("p99_error", "e", 0.99)]), ["clip_id", "field"])


def split16_tolerance(value: Column, mn: Column, mx: Column) -> Column:
    """What a split value may be off by, at its own size: one step of the log axis, and some rounding where the axis has no width."""
    return (mx - mn) / 65535.0 * (1.0 + F.abs(value)) + 1e-6 * F.abs(value) + 1e-9


def tolerances(pairs: DataFrame, fields: list[str], sides: list[tuple[DataFrame | None, DataFrame | None]]) -> DataFrame:
    """``tol_<field>`` for each pair: what each side's own quantising may have cost, added up; null where no bound is known.

    ``sides``: (ranges, codebooks) of each side that was quantised. Split fields depend on the value of side a,
    codebook fields on the largest gap of the clip's codebook; t_sigma and opacity are judged by what they do instead.
    """
    from .quantize import GROUPS, adjacent_gap

    attr = {**{f"scale_{i}": "scale" for i in range(3)}, **{f"f_dc_{i}": "dc" for i in range(3)}, "t_center": "t_center"}
    parts: dict[str, list[Column]] = {c: [] for c in fields}
    out = pairs
    for n, (ranges, codebooks) in enumerate(sides):
        if ranges is not None:
            for g, axes in GROUPS.items():
                for i, c in enumerate(axes):
                    if c in parts:
                        own = ranges.filter((F.col("grp") == g) & (F.col("axis") == i)).select("clip_id", F.col("mn").alias(f"__mn{n}_{c}"), F.col("mx").alias(f"__mx{n}_{c}"))
                        out = out.join(F.broadcast(own), "clip_id", "left")  # one row a clip
                        parts[c].append(split16_tolerance(F.col(f"a_{c}"), F.col(f"__mn{n}_{c}"), F.col(f"__mx{n}_{c}")))
        if codebooks is not None:
            gaps = adjacent_gap(codebooks)
            for c in fields:
                if c in attr:
                    own = gaps.filter(F.col("attr") == attr[c]).select("clip_id", F.col("tolerance").alias(f"__gap{n}_{c}"))
                    out = out.join(F.broadcast(own), "clip_id", "left")  # one row a clip
                    parts[c].append(F.col(f"__gap{n}_{c}"))
    added = {}
    for c, found in parts.items():
        total = F.lit(None).cast("double")
        for k, p in enumerate(found):
            total = p if k == 0 else F.coalesce(total + p, total, p)
        added[f"tol_{c}"] = total
    return out.withColumns(added).select(*pairs.columns, *added)


def judge_each(bounded: DataFrame, fields: list[str]) -> DataFrame:
    """clip_id, field, share over tolerance and verdict of pairs with their own ``tol_<field>``.

    Codebook fields may go over in 1 % of the rows, others in none; without any tolerance the verdict is advisory.
    """
    codebook = lambda c: c.startswith(("scale_", "f_dc_")) or c in ("t_center", "t_sigma")
    error = lambda c: F.abs(F.col(f"a_{c}").cast("double") - F.col(f"b_{c}").cast("double"))
    table = bounded.groupBy("clip_id").agg(
        *(F.avg((error(c) > F.col(f"tol_{c}") * 1.001 + 1e-9).cast("double")).alias(c) for c in fields)  # null without a tolerance
    )
    rows = (
        F.struct(
            F.lit(c).alias("field"), F.col(c).alias("over_share"),
            F.when(F.col(c).isNull(), "advisory").when(F.col(c) <= (0.01 if codebook(c) else 0.0), "pass").otherwise("fail").alias("verdict"),
        )
        for c in fields
    )
    return table.select("clip_id", F.explode(F.array(*rows)).alias("r")).select("clip_id", "r.*")


def temporal_weight_error(pairs: DataFrame, time_min: float, time_max: float, bar: float = 2 / 255) -> DataFrame:
    """Share of rows whose weight differs by more than ``bar`` at the end of the clip that is farther from their centre, and the verdict: 1 % may."""
    far = F.greatest(F.abs(F.col("a_t_center") - F.lit(float(time_min))), F.abs(F.lit(float(time_max)) - F.col("a_t_center")))
    weight = lambda s: F.exp(F.lit(-0.5) * (far / F.greatest(F.col(s), F.lit(1e-9))) * (far / F.greatest(F.col(s), F.lit(1e-9))))
    over = F.abs(weight("a_t_sigma") - weight("b_t_sigma")) > bar * 1.001 + 1e-9
    share = pairs.groupBy("clip_id").agg(F.avg(over.cast("double")).alias("over_share"))
    return share.withColumn("verdict", F.when(F.col("over_share") <= 0.01, "pass").otherwise("fail"))


def rotation_error(pairs: DataFrame, bar: float = 2.0) -> DataFrame:
    """Largest angle between the rotations of a pair, in degrees, and the verdict: none may be above ``bar``."""
    norm = lambda n: F.sqrt(sum((F.col(f"{n}_rot_{i}") * F.col(f"{n}_rot_{i}") for i in range(4)), F.lit(0.0)))
    dot = sum((F.col(f"a_rot_{i}") * F.col(f"b_rot_{i}") for i in range(4)), F.lit(0.0)) / F.greatest(norm("a") * norm("b"), F.lit(1e-12))
    most = pairs.groupBy("clip_id").agg(F.max(quaternion_angle_deg(dot)).alias("max_degrees"))
    return most.withColumn("verdict", F.when(F.col("max_degrees") <= bar * 1.001 + 1e-9, "pass").otherwise("fail"))


def reorder_like(source: DataFrame, archive: DataFrame, time_min: float, time_max: float) -> tuple[DataFrame, DataFrame]:
    """Source splats in the order that an archive records, and their own segment table, which the caller must compare with the archive's.

    ``archive``: clip_id, segment_duration, k_sigma, persistent_span_mult. The few distinct settings are read, and each
    orders its own clips; clips without segments are one block.
    """
    from . import temporal

    settings = archive.select("segment_duration", F.coalesce("k_sigma", F.lit(3.8)).alias("k"), F.coalesce("persistent_span_mult", F.lit(3.0)).alias("m"))
    ordered = table = None
    for duration, k, m in settings.distinct().collect():  # distinct encoder settings, not clips
        same = F.col("segment_duration").eqNullSafe(F.lit(duration)) & (F.coalesce("k_sigma", F.lit(3.8)) == k) & (F.coalesce("persistent_span_mult", F.lit(3.0)) == m)
        own = source.join(F.broadcast(archive.filter(same).select("clip_id")), "clip_id", "left_semi")  # one row a clip
        step = duration or max(time_max - time_min, 1e-9)
        made = temporal.order_splats(own, time_min, time_max, step, k, m if duration else float("inf"))
        segments = temporal.segment_table(own, time_min, time_max, step, k, m if duration else float("inf"))
        ordered = made if ordered is None else ordered.unionByName(made)
        table = segments if table is None else table.unionByName(segments)
    return ordered, table


def sh_layout_ratio(pairs: DataFrame, bar: float = 0.25) -> DataFrame:
    """Mean error of ``f_rest`` over the deviation of side a; a wrong layout is far above the bar."""
    both = F.arrays_zip(F.col("a_f_rest").alias("a"), F.col("b_f_rest").alias("b"))
    flat = pairs.select("clip_id", F.explode(both).alias("r"))
    ratio = F.avg(F.abs(F.col("r.a") - F.col("r.b"))) / F.stddev_pop("r.a")
    return flat.groupBy("clip_id").agg(ratio.alias("ratio")).withColumn("verdict", F.when(F.col("ratio") <= bar, "pass").otherwise("fail"))


def field_presence(a: DataFrame, b: DataFrame, required: list[str], noted: list[str]) -> DataFrame:
    """Columns that hold values on one side only: a failure, or a note."""
    fields = [*required, *noted]
    count = lambda df, n: df.agg(*((F.count(c) if c in df.columns else F.lit(0)).alias(c) for c in fields)).select(
        F.explode(F.array(*(F.struct(F.lit(c).alias("field"), (F.col(c) > 0).alias(n)) for c in fields))).alias("r")
    ).select("r.*")
    verdict = F.when(F.col("field").isin(noted), "note").otherwise("fail")
    return count(a, "in_a").join(count(b, "in_b"), "field").filter("in_a <> in_b").withColumn("verdict", verdict)


def same_rows(a: DataFrame, b: DataFrame, ignore: list[str] | None = None) -> DataFrame:
    """Rows of one side only, with the side; empty if both hold the same rows."""
    columns = [c for c in a.columns if c not in (ignore or [])]
    one, other = a.select(*columns), b.select(*columns)
    return one.exceptAll(other).withColumn("side", F.lit("a")).unionByName(other.exceptAll(one).withColumn("side", F.lit("b")))


def group_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """First segment of each clip whose row range differs between two segment tables."""
    right = b.select("clip_id", "seg_idx", F.col("first").alias("b_first"), F.col("last").alias("b_last"))
    same = (F.col("first") == F.col("b_first")) & (F.col("last") == F.col("b_last"))
    return a.join(right, ["clip_id", "seg_idx"], "full").filter(~F.coalesce(same, F.lit(False))).groupBy("clip_id").agg(F.min("seg_idx").alias("first_difference"))


def count_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    n = lambda df, name: df.groupBy("clip_id").agg(F.count(F.lit(1)).alias(name))
    return n(a, "n_a").join(n(b, "n_b"), "clip_id", "full").na.fill(0).filter("n_a <> n_b")

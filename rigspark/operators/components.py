"""Connected parts: voxels of splats, and runs of mask pixels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import sigmoid
from .cameras import first_of_group
from .scratch import cut

MOST_ROUNDS = 200


def label_components(nodes: DataFrame, links: DataFrame, keys: list[str]) -> DataFrame:
    """``label``: the least id reachable from each id of ``nodes``, by rounds of least neighbour and pointer jumping.

    ``nodes`` has keys + id, ``links`` keys + a, b in both directions. Rounds end when no label changes.
    """
    labels = cut(nodes.select(*keys, "id", F.col("id").alias("label")))
    links = cut(links.select(*keys, "a", "b"))
    for _ in range(MOST_ROUNDS):
        near = links.join(labels.select(*keys, F.col("id").alias("b"), F.col("label").alias("m")), [*keys, "b"])
        least = near.groupBy(*keys, F.col("a").alias("id")).agg(F.min("m").alias("m"))
        stepped = labels.join(least, [*keys, "id"], "left").select(*keys, "id", "label", F.least("label", F.coalesce("m", "label")).alias("next"))
        jump = stepped.select(*keys, F.col("id").alias("next"), F.col("next").alias("far"))
        jumped = cut(stepped.join(jump, [*keys, "next"], "left").select(*keys, "id", "label", F.least("next", F.coalesce("far", "next")).alias("next")))
        changed = jumped.filter("next <> label").limit(1).count()
        labels = jumped.select(*keys, "id", F.col("next").alias("label"))
        if not changed:
            return labels
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")


def main_cluster(splats: DataFrame, cell_fraction: float = 0.03) -> DataFrame:
    """Splats of the 26-connected voxel component with the most alpha, by clip. Voxels, not splats, are linked."""
    box = splats.groupBy("clip_id").agg(*(f(a).alias(f"{n}_{a}") for a in "xyz" for n, f in (("lo", F.min), ("hi", F.max))))
    diagonal = F.sqrt(sum(((F.col(f"hi_{a}") - F.col(f"lo_{a}")) * (F.col(f"hi_{a}") - F.col(f"lo_{a}")) for a in "xyz"), F.lit(0.0)))
    box = box.withColumn("cell", F.greatest(diagonal * cell_fraction, F.lit(1e-9)))
    rows = splats.join(F.broadcast(box), "clip_id")  # one row a clip
    for a in "xyz":
        rows = rows.withColumn(f"c{a}", F.floor((F.col(a) - F.col(f"lo_{a}")) / F.col("cell")).cast("long"))
    # at most 1 / cell_fraction cells an axis, so 21 bits are enough
    code = lambda x, y, z: F.shiftleft(x, 42) + F.shiftleft(y, 21) + z
    rows = rows.withColumn("id", code(F.col("cx"), F.col("cy"), F.col("cz")))
    voxels = rows.groupBy("clip_id", "id", "cx", "cy", "cz").agg(F.sum(sigmoid(F.col("opacity"))).alias("mass"))
    steps = F.array(*(F.struct(*(F.lit(d).alias(n) for n, d in zip("xyz", (i, j, k), strict=True))) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1) if (i, j, k) != (0, 0, 0)))
    around = voxels.select("clip_id", F.col("id").alias("a"), "cx", "cy", "cz", F.explode(steps).alias("s"))
    around = around.filter("cx + s.x >= 0 and cy + s.y >= 0 and cz + s.z >= 0").select("clip_id", "a", code(F.col("cx") + F.col("s.x"), F.col("cy") + F.col("s.y"), F.col("cz") + F.col("s.z")).alias("b"))
    links = around.join(voxels.select("clip_id", F.col("id").alias("b")), ["clip_id", "b"])
    labels = label_components(voxels, links, ["clip_id"])
    mass = labels.join(voxels, ["clip_id", "id"]).groupBy("clip_id", "label").agg(F.sum("mass").alias("mass"))
    best = mass.groupBy("clip_id").agg(F.max_by("label", F.struct(F.col("mass"), -F.col("label"))).alias("label"))
    kept = labels.join(F.broadcast(best), ["clip_id", "label"]).select("clip_id", "id")  # one row a clip
    return rows.join(kept, ["clip_id", "id"], "left_semi").select(*splats.columns)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by group (image, capture) as tables of whole groups, with the number of each row's group in its table. One group and one batch are held."""
    rest, images = None, lambda t, first: (t, np.repeat(np.arange(len(first)), np.diff(first, append=t.num_rows)))
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        first = first_of_group(rows, keys)
        if first[-1]:
            yield images(rows.slice(0, first[-1]), first[:-1])
        rest = rows.slice(first[-1])
    if rest is not None:
        yield images(rest, np.zeros(1, np.int64))


def _whole(table: pa.Table, *columns: str) -> list[np.ndarray]:
    return [table.column(c).to_numpy().astype(np.int64) for c in columns]


def _meeting(asked: tuple[np.ndarray, ...], runs: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of an asked span and a run (line, x0, x1; runs sorted by line and x0) that share a pixel of a line."""
    (line, x0, x1), (of, r0, r1) = asked, runs
    if not len(line) or not len(of):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = min(x0.min(), r0.min())
    width = max(x1.max(), r1.max()) - least + 2
    reach = np.maximum.accumulate(of * width + r1 - least)  # runs of a line may overlap
    low = np.searchsorted(reach, line * width + x0 - least, "left")
    number = np.maximum(np.searchsorted(of * width + r0 - least, line * width + x1 - least, "right") - low, 0)
    a = np.repeat(np.arange(len(line)), number)
    b = np.arange(len(a)) - np.repeat(np.cumsum(number) - number, number) + low[a]
    met = r1[b] >= x0[a]
    return a[met], b[met]


def least_linked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least row that each of ``n`` rows reaches over links, by hooking roots and pointer jumping."""
    root = np.arange(n)
    while len(a):
        a, b = root[a], root[b]
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
    return root


def _lines(of: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Numbers of lines; an empty one lies between two images."""
    return of * (y.max() - y.min() + 2) + y - y.min()


def mask_components(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Runs with ``label``: the 4-connected part of their image, named by its least run. ``runs`` has keys + y, x0, x1.

    Runs are dealt and sorted by image once, and the parts of whole images are found as they stream by.
    """

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, of in whole_groups(batches, keys):
            y, x0, x1 = _whole(table, "y", "x0", "x1")
            line = _lines(of, y)
            low, up = _meeting((line - 1, x0, x1), (line, x0, x1))
            twice = np.flatnonzero((line[1:] == line[:-1]) & (x0[1:] == x0[:-1]))
            root = least_linked(len(line), np.concatenate((low, twice + 1)), np.concatenate((up, twice)))
            yield from table.append_column("label", pa.array(((y << 32) + x0)[root])).to_batches()

    columns = [*keys, *(c for c in runs.columns if c not in keys)]
    types = dict(runs.dtypes)
    dealt = runs.dropna(subset=[*keys, "y", "x0", "x1"]).select(*columns).repartition(*keys).sortWithinPartitions(*keys, "y", "x0")
    return dealt.mapInArrow(label, ", ".join(f"`{c}` {types[c]}" for c in columns) + ", label long")


def _with_keypoints(labelled: DataFrame, keypoints: DataFrame, keys: list[str]) -> DataFrame:
    """Runs (``__kind`` 0) and keypoints (1, or 2 where they lie nowhere), dealt and sorted by image, so that runs move once more and no pair of both does."""
    types = dict(labelled.dtypes)
    known = F.col("px").isNotNull() & F.col("py").isNotNull()
    spot = lambda c, n: F.when(known, F.col(c)).otherwise(0).cast(types[n]).alias(n)
    marks = keypoints.dropna(subset=keys).select(*keys, spot("py", "y"), spot("px", "x0"), spot("px", "x1"), F.when(known, 1).otherwise(2).alias("__kind"))
    both = labelled.withColumn("__kind", F.lit(0)).unionByName(marks, allowMissingColumns=True)
    return both.repartition(*keys).sortWithinPartitions(*keys, "y", "x0")


def _hits(table: pa.Table, of: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows that are runs, the number of each one's part, keypoints on each part, pairs of a keypoint's row and a run on it, and kinds."""
    kind, y, x0, x1 = _whole(table, "__kind", "y", "x0", "x1")
    line, run, mark = _lines(of, y), np.flatnonzero(kind == 0), np.flatnonzero(kind == 1)
    name = np.unique(table.column("label").take(pa.array(run)).to_numpy(), return_inverse=True)[1]
    part = np.unique(of[run] * (len(run) + 1) + name, return_inverse=True)[1]
    m, r = _meeting((line[mark], x0[mark], x1[mark]), (line[run], x0[run], x1[run]))
    return run, part, np.bincount(part[r], minlength=part.max(initial=-1) + 1), mark[m], r, kind


def component_hits(labelled: DataFrame, keypoints: DataFrame, keys: list[str], min_hits: int = 1) -> tuple[DataFrame, DataFrame]:
    """Runs of parts with ``min_hits`` keypoints (px, py: whole pixels), and parts total and kept of each image."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, of in whole_groups(batches, keys):
            run, part, hits, _, _, _ = _hits(table, of)
            yield from table.select(columns).take(pa.array(run[hits[part] >= min_hits])).to_batches()

    columns, types = labelled.columns, dict(labelled.dtypes)
    kept = _with_keypoints(labelled, keypoints, keys).mapInArrow(keep, ", ".join(f"`{c}` {types[c]}" for c in columns))
    return kept, component_report(labelled, keypoints, keys, min_hits).select(*keys, "components_total", "components_kept")


def component_report(labelled: DataFrame, keypoints: DataFrame, keys: list[str], min_hits: int = 1) -> DataFrame:
    """One row an image that has runs: parts total and with ``min_hits`` keypoints, and the share of its keypoints on runs and on kept runs (none gives 0)."""
    types = dict(labelled.dtypes)

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, of in whole_groups(batches, keys):
            run, part, hits, mark, on, kind = _hits(table, of)
            n, image = of[-1] + 1, np.zeros(len(hits), np.int64)
            image[part] = of[run]
            count = lambda rows: np.bincount(of[rows], minlength=n)
            parts = [np.bincount(image, minlength=n), np.bincount(image[hits >= min_hits], minlength=n)]
            every = np.maximum(count(kind > 0), 1)
            shares = [count(np.unique(mark)) / every, count(np.unique(mark[hits[part[on]] >= min_hits])) / every]
            masked = np.flatnonzero(parts[0])
            heads = table.select(keys).take(pa.array(np.searchsorted(of, masked)))
            made = [heads.column(k).combine_chunks() for k in keys] + [pa.array(v[masked]) for v in (*parts, *shares)]
            yield pa.RecordBatch.from_arrays(made, names=[*keys, *names])

    names = ["components_total", "components_kept", "coverage_before", "coverage_after"]
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), *(f"{n} {t}" for n, t in zip(names, ("long", "long", "double", "double"), strict=True))])
    return _with_keypoints(labelled.select(*keys, "y", "x0", "x1", "label"), keypoints, keys).mapInArrow(report, schema)

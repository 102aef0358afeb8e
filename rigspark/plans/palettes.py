"""Queries of palettes, trained for three groups of the embeddings at once, against whole rounds in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import palettes, quantize
from .queries import query

_ENTRIES, _ROUNDS, _P = 16, 3, 1_000_003


def _draw(n: int):
    """An order of vectors that both sides can compute: a multiple of the key modulo a prime."""
    return F.pmod(F.col("splat_id") * F.lit(7919 + 2 * n), F.lit(_P))


def _vectors(spark, d) -> DataFrame:
    """Whole numbers in 45 places for two vectors of three, none for those that hold no number."""
    v = spark.read.parquet(f"{d}/embeddings.parquet").filter("vec_id is not null")
    whole = F.transform(F.slice("embedding", 1, 45), lambda x: F.floor(x.cast("double") * 64).cast("double"))
    return v.select((F.col("vec_id") % 3).alias("clip_id"), F.col("vec_id").alias("splat_id"), F.when((F.col("vec_id") % 7 != 0) & (F.size("embedding") >= 45), whole).alias("f_rest"))


def _drawn(n: int) -> str:
    return f"SELECT clip_id, v, row_number() OVER (PARTITION BY clip_id ORDER BY splat_id * {7919 + 2 * n} % {_P}, splat_id) - 1 AS entry FROM given"


def _rounds() -> dict[str, str]:
    """Entries c0, c1, ... after each round, empty ones moved onto others of the sample, and the labels by the last."""
    steps = {
        "rows": "SELECT vec_id % 3 AS clip_id, vec_id AS splat_id, CASE WHEN vec_id % 7 <> 0 AND len(embedding) >= 45 THEN list_transform(embedding[1:45], lambda x: floor(CAST(x AS DOUBLE) * 64)) END AS v FROM embeddings WHERE vec_id IS NOT NULL",
        "given": "SELECT * FROM rows WHERE v IS NOT NULL",
        "c0": f"SELECT * FROM ({_drawn(5)}) WHERE entry < {_ENTRIES}",
    }
    near = lambda c: f"SELECT g.clip_id, g.splat_id, any_value(g.v) AS v, min({{'d': list_sum(list_transform(list_zip(g.v, {c}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 'e': {c}.entry}}).e AS entry FROM given g JOIN {c} ON g.clip_id = {c}.clip_id GROUP BY g.clip_id, g.splat_id"
    for n in range(_ROUNDS):
        c = f"c{n}"
        steps[f"l{n}"] = near(c)
        steps[f"m{n}"] = f"SELECT clip_id, entry, list(m ORDER BY i) AS v FROM (SELECT clip_id, entry, i, avg(x) AS m FROM (SELECT clip_id, entry, unnest(v) AS x, unnest(range(0, 45)) AS i FROM l{n}) GROUP BY clip_id, entry, i) GROUP BY clip_id, entry"
        steps[f"e{n}"] = f"SELECT clip_id, entry, row_number() OVER (PARTITION BY clip_id ORDER BY entry) - 1 AS turn FROM {c} WHERE (clip_id, entry) NOT IN (SELECT (clip_id, entry) FROM m{n})"
        steps[f"c{n + 1}"] = (
            f"SELECT {c}.clip_id, {c}.entry, coalesce(m.v, o.v, {c}.v) AS v FROM {c} LEFT JOIN m{n} m ON m.clip_id = {c}.clip_id AND m.entry = {c}.entry"
            f" LEFT JOIN e{n} e ON e.clip_id = {c}.clip_id AND e.entry = {c}.entry LEFT JOIN ({_drawn(6 + n)}) o ON o.clip_id = e.clip_id AND o.entry = e.turn"
        )
    steps["labels"] = near(f"c{_ROUNDS}")
    return steps


@query(
    "vq_assign",
    "SELECT rows.clip_id, rows.splat_id, CAST(labels.entry AS INT) AS sh_label FROM rows LEFT JOIN labels ON rows.splat_id = labels.splat_id",
    **_rounds(),
)
def _(spark, d):
    v = _vectors(spark, d)
    trained = palettes.train_palettes(v, "f_rest", "splat_id", _ENTRIES, _ROUNDS, draw=_draw)
    return palettes.assign_palette(v, "f_rest", "splat_id", trained, "sh_label").select("clip_id", "splat_id", "sh_label")


@query(  # a codebook with an entry for each value loses nothing, so what comes back are the centroids
    "palette_decoded",
    f"SELECT rows.clip_id, rows.splat_id, round(list_sum(c.v), 4) + 0e0 AS total, round(c.v[1], 5) + 0e0 AS first, round(c.v[45], 5) + 0e0 AS last FROM rows LEFT JOIN labels ON rows.splat_id = labels.splat_id LEFT JOIN c{_ROUNDS} c ON c.clip_id = rows.clip_id AND c.entry = labels.entry",
    **_rounds(),
)
def _(spark, d):
    labelled, book, texels = quantize.with_palette(_vectors(spark, d), _ENTRIES, _ENTRIES * 45, rounds=_ROUNDS, draw=_draw)
    back = quantize.decode_palette(labelled.drop("f_rest"), book, texels)
    total = F.aggregate("f_rest", F.lit(0.0), lambda a, b: a + b)
    shown = {"total": F.round(total, 4) + 0.0, "first": F.round(F.col("f_rest")[0], 5) + 0.0, "last": F.round(F.col("f_rest")[44], 5) + 0.0}
    return back.select("clip_id", "splat_id", *(e.alias(n) for n, e in shown.items()))

"""Colours of splats from a small trained network, by batches."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


@dataclass
class TwoLayers:
    """Weights of a two-layer perceptron, in one of two layouts.

    With biases, negative units leak by 0.1. Without, the weights are padded (columns of the first layer, rows of the
    second); what is beyond the given inputs and outputs is ignored, and negative units leak by 0.01.
    """

    first: np.ndarray
    second: np.ndarray
    first_bias: np.ndarray | None = None
    second_bias: np.ndarray | None = None
    outputs: int = 3
    leak: float | None = None

    def __call__(self, x: np.ndarray) -> np.ndarray:
        leak = self.leak if self.leak is not None else 0.01 if self.first_bias is None else 0.1
        h = x @ self.first[:, : x.shape[1]].T + (0 if self.first_bias is None else self.first_bias)
        h = np.where(h > 0, h, leak * h)
        return h @ self.second[: self.outputs].T + (0 if self.second_bias is None else self.second_bias[: self.outputs])


def contracted(x: np.ndarray) -> np.ndarray:
    """Unbounded scenes drawn into a ball of radius two, which is then laid into the unit cube."""
    n = np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    return np.where(n <= 1, x, (2 - 1 / n) * x / n) / 4 + 0.5


def frequencies(x: np.ndarray, bands: int, interleaved: bool) -> np.ndarray:
    """Sines and cosines of doubling frequencies; a band's columns side by side, or all bands of a column."""
    angle = np.pi * x[:, :, None] * 2.0 ** np.arange(bands)
    pairs = np.stack((np.sin(angle), np.cos(angle)), axis=3)
    return (pairs if interleaved else pairs.transpose(0, 2, 3, 1)).reshape(len(x), -1)


def bake_appearance(splats: DataFrame, network: TwoLayers, bands: int = 16, interleaved: bool = True, features: int = 3) -> DataFrame:
    """``f_dc_*`` of each splat from its contracted position, centre time and static features (``app``), by one network."""
    shared = splats.sparkSession.sparkContext.broadcast(network)  # a fixed number of weights

    def baked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            place = np.column_stack((contracted(pdf[["x", "y", "z"]].to_numpy(float)), pdf["t_center"].to_numpy(float)))
            own = np.stack(pdf["app"].to_numpy()).astype(float)[:, :features]
            out = shared.value(np.column_stack((frequencies(place, bands, interleaved), own)))
            yield pdf[["clip_id", "splat_id"]].assign(**{f"f_dc_{c}": out[:, c] for c in range(3)})

    return splats.select("clip_id", "splat_id", "x", "y", "z", "t_center", "app").mapInPandas(
        baked, "clip_id long, splat_id long, f_dc_0 double, f_dc_1 double, f_dc_2 double"
    )

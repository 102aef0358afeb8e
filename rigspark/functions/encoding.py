"""Encodings of splat columns as bytes, and their inverses, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def log_transform(x: Column) -> Column:
    return F.signum(x) * F.log1p(F.abs(x))


def log_inverse(t: Column) -> Column:
    return F.signum(t) * (F.exp(F.abs(t)) - 1.0)


def split16(value: Column, low: Column, high: Column) -> Column:
    """0..65535 of a value inside a range; a range without width counts as one wide."""
    span = F.when(high > low, high - low).otherwise(1.0)
    return F.least(F.greatest(F.rint((value - low) / span * 65535.0), F.lit(0.0)), F.lit(65535.0)).cast("int")


def low_byte(q: Column) -> Column:
    return q.bitwiseAND(255).cast("short")


def high_byte(q: Column) -> Column:
    return F.shiftright(q, 8).cast("short")


def join16(low: Column, high: Column, mn: Column, mx: Column) -> Column:
    span = F.when(mx > mn, mx - mn).otherwise(1.0)
    return mn + (low + high * 256) / 65535.0 * span


def alpha8(opacity: Column) -> Column:
    a = F.rint(F.lit(255.0) / (F.lit(1.0) + F.exp(-opacity)))
    return F.least(F.greatest(a, F.lit(0.0)), F.lit(255.0)).cast("short")


def opacity_of(byte: Column) -> Column:
    a = F.least(F.greatest(byte / 255.0, F.lit(1e-5)), F.lit(1.0 - 1e-5))
    return F.log(a / (F.lit(1.0) - a))


def spread10(v: Column) -> Column:
    """Ten bits spread to every third bit."""
    v = v.bitwiseAND(0x3FF)
    for shift, mask in ((16, 0x30000FF), (8, 0x300F00F), (4, 0x30C30C3), (2, 0x9249249)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(mask)
    return v


def morton30(x: Column, y: Column, z: Column) -> Column:
    """Interleaved code of three cells of 0..1023, x lowest."""
    return spread10(x).bitwiseOR(F.shiftleft(spread10(y), 1)).bitwiseOR(F.shiftleft(spread10(z), 2))


def cell1024(v: Column, low: Column, high: Column) -> Column:
    span = F.when(high > low, high - low).otherwise(1.0)
    return F.least(F.greatest(F.floor((v - low) / span * 1023.0), F.lit(0)), F.lit(1023)).cast("long")


def smallest_three(q: list[Column]) -> Column:
    """(b0, b1, b2, mode): the largest of four components (w first) is left out and made positive; of equal ones x goes before y, z and w."""
    norm = F.greatest(F.sqrt(sum((c * c for c in q), F.lit(0.0))), F.lit(1e-12))
    q = [c / norm for c in q]
    most = F.greatest(*(F.abs(c) for c in q))
    # compiled conditions: functions over arrays are interpreted, for every row again
    largest = F.when(F.abs(q[1]) == most, 1).when(F.abs(q[2]) == most, 2).when(F.abs(q[3]) == most, 3).when(most.isNotNull(), 0)
    sign = F.when(F.when(largest == 1, q[1]).when(largest == 2, q[2]).when(largest == 3, q[3]).otherwise(q[0]) < 0, -1.0).otherwise(1.0)
    byte = lambda c: F.rint((c * sign * math.sqrt(2.0) / 2.0 + 0.5) * 255.0)
    kept = [F.when(largest <= i, q[i + 1]).otherwise(q[i]) for i in range(3)]
    clamp = lambda i: F.least(F.greatest(byte(kept[i]), F.lit(0.0)), F.lit(255.0)).cast("short")
    return F.struct(clamp(0).alias("b0"), clamp(1).alias("b1"), clamp(2).alias("b2"), (largest + 252).cast("short").alias("mode"))


def from_smallest_three(b: list[Column], mode: Column) -> list[Column]:
    small = [(c / 255.0 - 0.5) * 2.0 / math.sqrt(2.0) for c in b]
    big = F.sqrt(F.greatest(F.lit(0.0), F.lit(1.0) - sum((c * c for c in small), F.lit(0.0))))
    where = mode - 252
    rest = F.array(*small)
    return [F.when(where == i, big).otherwise(F.get(rest, F.when(where > i, F.lit(i)).otherwise(F.lit(i - 1)))) for i in range(4)]


def palette_size(n: Column) -> Column:
    """Next power of two of n / 16, between 1024 and 65536."""
    wanted = F.greatest(F.lit(1024.0), n / 16.0)
    return F.least(F.pow(F.lit(2.0), F.ceil(F.log2(wanted))), F.lit(65536.0)).cast("int")

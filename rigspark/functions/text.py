"""Names, times and log lines as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_stem(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(name, r"^.*[/\\]", ""), r"(?<=.)\.[^.]*$", "")


def camera_label(name: Column) -> Column:
    """The stem without its prefixes."""
    return F.regexp_replace(file_stem(name), r"^Camera_(undistorted_)?", "")


def trailing_id(name: Column) -> Column:
    """The number at the end, or null."""
    digits = F.regexp_extract(name, r"(\d+)$", 1)
    return F.when(digits != "", digits.cast("long"))


def seconds(text: Column) -> Column:
    """Seconds of '1500ms', '1.5s' or '1.5'."""
    t = F.lower(F.trim(text))
    number = lambda cut: F.expr("double('1')") * F.regexp_replace(t, cut, "").try_cast("double")
    return F.when(t.endswith("ms"), number("ms$") / 1000.0).when(t.endswith("s"), number("s$")).otherwise(number("^$"))


def last_change(log: Column, label: str) -> Column:
    """The number behind '->' in the last line '<label> ... a -> b'."""
    found = F.regexp_extract_all(log, F.lit(label + r"[^\n]*?-?[0-9.]+\s*->\s*(-?[0-9.]+)"), F.lit(1))
    return F.when(F.size(found) > 0, F.element_at(found, -1).try_cast("double"))


def seek_time(t: Column, frame_offset: Column, fps: Column) -> Column:
    return t - frame_offset / fps


def frame_offset(offset: Column, fps: Column) -> Column:
    return F.rint(offset * fps).cast("int")

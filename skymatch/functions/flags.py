"""Boolean flags as bits of one long column."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bit of each flag in the packed column ``flags``.
FLAG_BITS = {
    "base_PixelFlags_flag": 0, "base_PixelFlags_flag_offimage": 1, "base_PixelFlags_flag_edge": 2, "base_PixelFlags_flag_interpolated": 3,
    "base_PixelFlags_flag_saturated": 4, "base_PixelFlags_flag_cr": 5, "base_PixelFlags_flag_bad": 6, "base_PixelFlags_flag_suspect": 7,
    "base_PixelFlags_flag_interpolatedCenter": 8, "base_PixelFlags_flag_saturatedCenter": 9, "base_PixelFlags_flag_crCenter": 10,
    "base_PixelFlags_flag_suspectCenter": 11, "slot_Centroid_flag": 12, "slot_ApFlux_flag": 15, "slot_ApFlux_flag_apertureTruncated": 16,
    "slot_PsfFlux_flag": 17, "slot_PsfFlux_flag_noGoodPixels": 18, "slot_PsfFlux_flag_edge": 19, "ip_diffim_forced_PsfFlux_flag": 20,
    "ip_diffim_forced_PsfFlux_flag_noGoodPixels": 21, "ip_diffim_forced_PsfFlux_flag_edge": 22, "slot_Shape_flag": 23,
    "slot_Shape_flag_no_pixels": 24, "slot_Shape_flag_not_contained": 25, "slot_Shape_flag_parent_source": 26,
    "ext_trailedSources_Naive_flag_edge": 27, "base_PixelFlags_flag_streak": 28, "base_PixelFlags_flag_streakCenter": 29,
    "base_PixelFlags_flag_injected": 30, "base_PixelFlags_flag_injectedCenter": 31, "base_PixelFlags_flag_injected_template": 32,
    "base_PixelFlags_flag_injected_templateCenter": 33, "base_PixelFlags_flag_nodata": 34, "base_PixelFlags_flag_nodataCenter": 35,
    "ext_trailedSources_Naive_flag": 36,
}
# Prefixes of raw names and what stands for them in the standard names; the first that fits is used.
RENAMES = {
    "base_PixelFlags_flag": "pixelFlags",
    "ip_diffim_forced_PsfFlux": "forced_PsfFlux",
    "slot_ApFlux": "apFlux",
    "slot_Centroid": "centroid",
    "slot_PsfFlux": "psfFlux",
    "slot_Shape": "shape",
    "ext_trailedSources_Naive": "trail",
}


def renamed(name: str, rules: Mapping[str, str] = RENAMES) -> str:
    for old, new in rules.items():
        if name.startswith(old):
            return new + name[len(old) :]
    return name


def pack(bits: Mapping[str, int] = FLAG_BITS) -> Column:
    """The flag columns as one long; a null flag is not set."""
    return reduce(lambda x, y: x.bitwiseOR(y), (F.when(F.col(n), F.lit(1 << b).cast("long")).otherwise(F.lit(0).cast("long")) for n, b in bits.items()), F.lit(0).cast("long"))


class PackedFlags:
    """Names and bits of packed flag columns: ``layout`` maps a column to its flags."""

    def __init__(self, layout: Mapping[str, Mapping[str, int]] | None = None):
        self.layout = dict(layout or {"flags": FLAG_BITS})

    def _bits(self, column: str) -> Mapping[str, int]:
        if column not in self.layout:
            raise ValueError(f"no packed column {column}")
        return self.layout[column]

    def exists(self, name: str, column: str = "flags") -> bool:
        return name in self._bits(column)

    def mask(self, names: list[str], column: str = "flags") -> int:
        """The sum of the bits of ``names``; for a test, ``(column & mask) != 0``."""
        bits = self._bits(column)
        if unknown := [n for n in names if n not in bits]:
            raise ValueError(f"no flags {unknown} in {column}")
        return sum(1 << bits[n] for n in names)

    def unpack(self, df: DataFrame, column: str = "flags") -> DataFrame:
        """One boolean column per flag."""
        return df.withColumns({n: F.getbit(F.col(column), F.lit(b)) == 1 for n, b in self._bits(column).items()})


def flag_columns(df: DataFrame, names: list[str], rules: Mapping[str, str] = RENAMES) -> dict[str, Column]:
    """Standard name and column of every flag; a raw catalog without one of them is an error."""
    if missing := [n for n in names if n not in df.columns]:
        raise KeyError(f"flags are missing: {missing}")
    return {renamed(n, rules): F.col(n) for n in names}

"""Visits that can go side by side: those whose regions are apart, or that come later than all they touch.

Two visits conflict if their padded fields meet. Of two that conflict, the later must see what the earlier wrote; visits that do not conflict share no
object. So a visit goes in the round after the last of the earlier visits that it conflicts with: rounds keep the order of time where it matters, and the
visits of one round run at once.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import unit_vector
from ..operators.crossmatch import drop_unplaced, range_join

#: Arcseconds between the fields of two visits that share no object: objects are loaded around a field, and move a little.
MARGIN = 60.0


def fields_of(sources: DataFrame) -> DataFrame:
    """visit, detector, t (first midpoint), a centre (x, y, z) and the angle in radians to the farthest source. Without placed sources there is no field."""
    x, y, z = unit_vector(F.col("ra"), F.col("dec"))
    placed = drop_unplaced(sources).select("visit", "detector", "midpointMjdTai", x.alias("x"), y.alias("y"), z.alias("z"))
    centres = placed.groupBy("visit", "detector").agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"), F.avg("z").alias("cz"), F.min("midpointMjdTai").alias("t"))
    length = F.sqrt(sum((F.col(c) * F.col(c) for c in ("cx", "cy", "cz")), F.lit(0.0)))
    centres = centres.withColumns({c: F.col(c) / length for c in ("cx", "cy", "cz")})
    chord = F.sqrt(sum(((F.col(c) - F.col(f"c{c}")) ** 2 for c in "xyz"), F.lit(0.0)))
    far = placed.drop("midpointMjdTai").join(centres, ["visit", "detector"]).groupBy("visit", "detector").agg(F.max(chord).alias("chord"), *[F.first(c).alias(c) for c in ("cx", "cy", "cz", "t")])
    return far.select("visit", "detector", "t", "cx", "cy", "cz", (2 * F.asin(F.least(F.lit(1.0), F.col("chord") / 2))).alias("angle"))


def conflicts(fields: DataFrame, margin: float = MARGIN) -> DataFrame:
    """Pairs (visit, detector) and (visit2, detector2) of different fields that are at most their angles and the margin apart; each pair once."""
    pad = math.radians(margin / 3600)
    widest = fields.agg(F.max("angle")).first()[0] or 0.0
    most = 2 * math.sin(min(math.pi, 2 * widest + pad) / 2)
    left = fields.select("visit", "detector", F.col("angle").alias("a1"), F.col("cx").alias("lx"), F.col("cy").alias("ly"), F.col("cz").alias("lz"))
    right = fields.select(F.col("visit").alias("visit2"), F.col("detector").alias("detector2"), F.col("angle").alias("a2"), F.col("cx").alias("rx"), F.col("cy").alias("ry"), F.col("cz").alias("rz"))
    near = range_join(left, right, F.lit(most), most, cell_radii=2.0)
    meets = 2 * F.asin(F.least(F.lit(1.0), F.col("chord") / 2)) <= F.col("a1") + F.col("a2") + pad
    return near.where(meets & (F.struct("visit", "detector") < F.struct(F.col("visit2").alias("visit"), F.col("detector2").alias("detector")))).select("visit", "detector", "visit2", "detector2")


def plan_rounds(sources: DataFrame, margin: float = MARGIN) -> list[list[tuple[int, int]]]:
    """(visit, detector) by rounds. The visits of a batch and their conflicts come to the driver, not their sources; visits without a placed source stay out."""
    from ..scratch import materialize, release

    fields = materialize(fields_of(sources), "fields")
    order = [(r["visit"], r["detector"]) for r in fields.orderBy("t", "visit", "detector").select("visit", "detector").collect()]
    place = {v: i for i, v in enumerate(order)}
    earlier: dict[tuple[int, int], list[tuple[int, int]]] = {v: [] for v in order}
    for a, b, c, d in conflicts(fields, margin).collect():
        first, second = sorted([(a, b), (c, d)], key=place.__getitem__)
        earlier[second].append(first)
    release(fields)
    rounds: list[list[tuple[int, int]]] = []
    of: dict[tuple[int, int], int] = {}
    for v in order:
        of[v] = max((of[u] + 1 for u in earlier[v]), default=0)
        if of[v] == len(rounds):
            rounds.append([])
        rounds[of[v]].append(v)
    return rounds

"""Visits side by side: rounds against all pairs, and the same catalog as one by one."""

import dataclasses
import math
import random

import pytest

from skymatch.sources import store
from skymatch.streaming.rounds import plan_rounds
from skymatch.streaming.visits import VisitConfig, process_batch

SOURCE = "diaSourceId bigint, visit bigint, detector int, ra double, dec double, psfFlux double, psfFluxErr double, midpointMjdTai double, band string"


def field(visit, ra, dec, n=4, step=0.01):
    return [(100 * visit + i, visit, 1, (ra + step * i) % 360, dec, 5.0 + visit, 1.0, 60000.0 + visit, "g") for i in range(n)]


def apart(rows, u, v):
    """Angle between the nearest sources of two visits, in degrees."""
    vector = lambda r: (math.cos(math.radians(r[4])) * math.cos(math.radians(r[3])), math.cos(math.radians(r[4])) * math.sin(math.radians(r[3])), math.sin(math.radians(r[4])))
    return min(math.degrees(2 * math.asin(min(1.0, math.dist(vector(a), vector(b)) / 2))) for a in rows if a[1] == u for b in rows if b[1] == v)


@pytest.mark.parametrize("seed", [1, 2])
def test_rounds_part_what_touches_and_keep_the_order(spark, seed):
    rng = random.Random(seed)
    rows = [r for v in range(1, 25) for r in field(v, rng.choice([0.0, 359.99, 40.0, 40.3]) + rng.uniform(-0.2, 0.2), rng.uniform(-0.2, 0.2))]
    rows.append((9999, 77, 1, None, None, 1.0, 1.0, 60000.0, "g"))
    rounds = plan_rounds(spark.createDataFrame(rows, SOURCE))
    of = {v: i for i, r in enumerate(rounds) for v, _ in r}
    assert sorted(of) == list(range(1, 25)) and len(rounds) < 24
    for u in of:
        for v in of:
            if u < v and apart(rows, u, v) < 60 / 3600:
                assert of[u] < of[v]
    for v, i in of.items():
        if i:  # not later than it must
            assert any(of[u] == i - 1 and u < v and apart(rows, u, v) < 0.1 for u in of)


def test_the_catalog_is_that_of_one_visit_after_another(spark, tmp_path):
    rows = field(1, 10.0, 1.0) + field(2, 50.0, 1.0) + field(3, 10.0 + 1e-5, 1.0)
    df = spark.createDataFrame(rows, SOURCE)
    assert [sorted(r) for r in plan_rounds(df)] == [[(1, 1), (2, 1)], [(3, 1)]]
    catalogs = []
    for name, n in (("one", 1), ("many", 2)):
        catalog = store.Catalog(spark, str(tmp_path / name))
        results = process_batch(catalog, df, dataclasses.replace(VisitConfig(), side_by_side=n))
        assert sorted((r.visit, r.counts["numNewDiaObjects"], r.counts["numUpdatedDiaObjects"]) for r in results) == [(1, 4, 0), (2, 4, 0), (3, 0, 4)]
        catalogs.append([sorted(map(str, catalog.read(t).drop("validityStartMjdTai", "timeProcessedMjdTai").collect())) for t in store.TABLES])
        assert all(catalog.status(v, 1) == store.DONE for v in range(1, 4)) and catalog.state().version == 6
    assert catalogs[0] == catalogs[1]

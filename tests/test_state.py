"""Keyed state of a stream against a recomputation from all rows."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from skymatch.operators import stats
from skymatch.streaming import state

SCHEMA = "diaSourceId bigint, diaObjectId bigint, band string, ra double, dec double, midpointMjdTai double, psfFlux double, psfFluxErr double, scienceFlux double, scienceFluxErr double"
NAN, INF = float("nan"), float("inf")


def make(n=300, seed=2):
    rng = random.Random(seed)
    flux = lambda: rng.choice([rng.uniform(-5, 50)] * 8 + [NAN, INF, None])
    err = lambda: rng.choice([rng.uniform(0.1, 3)] * 8 + [0.0, NAN, None])
    time = lambda: rng.choice([60000.0 + rng.randrange(40)] * 9 + [None])
    return [(i, rng.randrange(7), rng.choice(["g", "r", "i", None]), rng.choice([(359.9999 + rng.uniform(0, 0.0003)) % 360, None]), 1.0 + rng.uniform(0, 1e-4), time(), flux(), err(), flux(), err()) for i in range(1, n)]


def recomputed(df):
    wide = stats.band_statistics(df).collect()
    names = [f.split()[0] for f in state.STATISTICS.split(", ")]
    bands = {(r.diaObjectId, b): [r[f"{b}_{c}"] for c in names] for r in wide for b in "gri"}
    places = {r.diaObjectId: (r.ra, r.dec, r.nDiaSources) for r in stats.mean_positions(df).collect()}
    return bands, places, names


def check(found, df):
    bands, places, names = recomputed(df)
    rows = found.collect()
    got = {(r.diaObjectId, r.band): [r[c] for c in names] for r in rows if r.band is not None}
    assert len(got) + len(places) == len(rows)
    for key, want in bands.items():
        have = got.get(key)
        if have is None:
            assert all(v is None for v in want)
            continue
        for name, a, b in zip(names, have, want, strict=True):
            assert (a or None) == (b or None) if a is None or b is None else a == pytest.approx(b, rel=1e-5, abs=1e-5), (key, name, a, b)
    for r in rows:
        if r.band is None:
            ra, dec, n = places[r.diaObjectId]
            assert r.nDiaSources == n and (r.ra - ra + 180) % 360 - 180 == pytest.approx(0, abs=1e-9) and r.dec == pytest.approx(dec)


def test_stream_of_mixed_times_restarts_and_repeats(spark, tmp_path):
    rows = make()
    random.Random(1).shuffle(rows)  # late sources between early ones
    everything = spark.createDataFrame(rows + [(999, 0, "g", 1.0, 1.0, 60000.0, 1.0, 1.0, 1.0, 1.0)], SCHEMA)
    root = str(tmp_path)
    run = lambda: state.statistics_stream(spark, f"{root}/in", everything.schema, f"{root}/out", f"{root}/k", groups=3)
    for low in (0, 150):
        everything_so_far = spark.createDataFrame(rows[: low + 150], SCHEMA)
        part = spark.createDataFrame(rows[low : low + 150] + rows[:20], SCHEMA)  # some come again
        part.withColumn("f", F.col("diaSourceId") % 3).repartition(3, "f").drop("f").write.mode("append").parquet(f"{root}/in")
        found = run()
        check(found, everything_so_far.where("diaObjectId <> 0"))
    assert sorted(map(str, run().collect())) == sorted(map(str, found.collect()))  # nothing new, nothing changes


def test_a_late_source_parts_a_slope():
    frame = lambda rows: pd.DataFrame([(i, t, f, 1.0, f, 1.0) for i, t, f in rows], columns=["diaSourceId", "midpointMjdTai", "psfFlux", "psfFluxErr", "scienceFlux", "scienceFluxErr"])
    one, new = state.add_sources(state._NEW_BAND, frame([(1, 1.0, 0.0), (3, 3.0, 20.0)]))
    assert state.band_results(one)[6] == 10.0 and new.all()
    two, new = state.add_sources(one, frame([(2, 2.0, 18.0), (3, 3.0, 20.0), (2, 2.0, 18.0)]))
    assert state.band_results(two)[6] == 18.0 and new.tolist() == [True, False, False]
    three, _ = state.add_sources(two, frame([(4, 1.5, 17.0)]))
    assert state.band_results(three)[6] == 34.0 and state.band_results(three)[2] == 4
    empty, _ = state.add_sources(state._NEW_BAND, frame([(1, 1.0, NAN)]))
    assert state.band_results(empty) == (None, None, 0, None, None, None, None, 1.0, None, None)


class Store:
    """A map state that counts the calls."""

    def __init__(self):
        self.values, self.calls = {}, 0

    def containsKey(self, key):  # noqa: N802
        self.calls += 1
        return key in self.values

    def getValue(self, key):  # noqa: N802
        self.calls += 1
        return self.values[key]

    def updateValue(self, key, value):  # noqa: N802
        self.calls += 1
        self.values[key] = value


def test_calls_follow_the_pages_and_not_the_objects(monkeypatch):
    """Sliced batches of many objects against one pass over all rows, with a bounded number of calls to the state."""
    monkeypatch.setattr(state, "SLICE_ROWS", 700)
    rng = random.Random(4)
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    frame = pd.DataFrame([(i, rng.randrange(1, 900), rng.choice(["g", "r", None]), rng.uniform(0, 360), rng.uniform(-80, 80), 60000.0 + rng.randrange(30), rng.uniform(0, 9), rng.uniform(1, 2), rng.uniform(0, 9), 1.0) for i in range(4000)], columns=names)

    def run(parts, pages):
        processor = state.ObjectStatistics(pages)
        store = Store()
        processor.init(type("Handle", (), {"getMapState": lambda self, *a: store})())
        last = {}
        for part in parts:
            chunks = iter([part.iloc[i : i + 300] for i in range(0, len(part), 300)])
            for out in processor.handleInputRows((0,), chunks, None):
                got = {(r[0], r[1] if isinstance(r[1], str) else None): r[2:] for r in out.itertuples(index=False, name=None)}
                assert len(got) == len(out)
                last |= got
        return last, store.calls

    again = [frame.iloc[:2500], frame.iloc[2000:]]  # some come again
    small, calls = run(again, 16)
    whole, _ = run([frame], 1)
    assert calls <= 2 * 3 * 16 and small.keys() == whole.keys() and {k[0] for k in small} == set(frame["diaObjectId"])
    for key, values in whole.items():
        for a, b in zip(small[key], values, strict=True):
            assert pd.isna(a) == pd.isna(b) and (pd.isna(a) or a == pytest.approx(b, rel=1e-9)), key

"""Range join, scores and assignment."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skymatch.operators import assign, crossmatch

S = "visit bigint, detector int, diaSourceId bigint, ra double, dec double, raErr double, decErr double"
O = "diaObjectId bigint, ra double, dec double, raErr double, decErr double"
SEC = 1 / 3600


def sources(spark, rows):
    return spark.createDataFrame([(1, 1, *r) for r in rows], S)


def matched(spark, s, o, config=crossmatch.MatchConfig()):
    return {r.diaSourceId: r.diaObjectId for r in assign.match(sources(spark, s), spark.createDataFrame(o, O), config).collect()}


def test_basic(spark):
    s = [(i, 0.04 * i, 0.04 * i, None, None) for i in range(5)]
    o = [(i + 1, 0.04 * (i + 1), 0.04 * (i + 1), None, None) for i in range(5)]  # 0 would mean no object
    a = assign.associate(sources(spark, s), spark.createDataFrame(o, O))
    assert {r.diaSourceId: r.diaObjectId for r in a.matched.collect()} == {1: 1, 2: 2, 3: 3, 4: 4}
    c = a.counts.first()
    assert (c.nUpdatedDiaObjects, c.nUnassociatedDiaObjects, a.unmatched.count()) == (4, 1, 1)


def test_likelihood_value(spark):
    sigma = 0.05 * SEC
    p = crossmatch.scored(sources(spark, [(1, 10.0, 0.0, sigma, sigma)]), spark.createDataFrame([(1, 10.0, 0.05 * SEC, sigma, sigma)], O)).first()
    assert p.by_likelihood and p.score == pytest.approx(0.25 + 0.5 * math.log((2 * sigma**2) ** 2), abs=1e-6)


def test_far_in_errors_but_within_radius_is_matched(spark):
    assert matched(spark, [(1, 10.0, 0.0, 0.05 * SEC, 0.05 * SEC)], [(7, 10.0, 0.7 * SEC, 0.05 * SEC, 0.05 * SEC)]) == {1: 7}


def test_tight_beats_loose(spark):
    o = [(1, 10.0, 0.15 * SEC, 0.05 * SEC, 0.05 * SEC), (2, 10.0, -0.30 * SEC, 0.5 * SEC, 0.5 * SEC)]
    assert matched(spark, [(1, 10.0, 0.0, 0.05 * SEC, 0.05 * SEC)], o) == {1: 1}


def test_right_ascension_wraps(spark):
    assert matched(spark, [(1, 359.99999, 0.0, None, None)], [(5, 0.00001, 0.0, None, None)]) == {1: 5}


def test_contention_goes_to_the_closer(spark):
    assert matched(spark, [(1, 10.0, 0.3 * SEC, None, None), (2, 10.0, 0.1 * SEC, None, None)], [(9, 10.0, 0.0, None, None)]) == {2: 9}


def test_optimum_not_greedy(spark):
    s = [(100, 10.0, 0.0, None, None), (101, 10.0, 0.5 * SEC, None, None)]
    o = [(1, 10.0, 0.2 * SEC, None, None), (2, 10.0, -0.6 * SEC, None, None)]
    assert matched(spark, s, o) == {100: 2, 101: 1}


@pytest.mark.parametrize("fallback,chi2", [(0.05, 50.0), (0.2, 3.125)])
def test_fallback_errors(spark, fallback, chi2):
    config = crossmatch.MatchConfig(error_fallback=fallback)
    nan = float("nan")
    df = spark.createDataFrame([(0.0, 0.5 * SEC, nan, nan, 0.0, 0.0, nan, nan)], "sRa double, sDec double, sRaErr double, sDecErr double, oRa double, oDec double, oRaErr double, oDecErr double")
    score = df.select(crossmatch.nll(config)).first()[0]
    v = 2 * (fallback * SEC) ** 2
    assert score == pytest.approx(0.5 * chi2 + 0.5 * math.log(v * v))


def test_unplaced_sources_leave(spark):
    s = sources(spark, [(1, 1.0, 1.0, None, None), (2, float("nan"), 1.0, None, None), (3, 1.0, None, None, None)])
    assert [r[0] for r in crossmatch.drop_unplaced(s).select("diaSourceId").collect()] == [1]
    assert sorted(r[0] for r in crossmatch.unplaced(s).collect()) == [2, 3]


def test_no_objects(spark):
    a = assign.associate(sources(spark, [(1, 1.0, 1.0, None, None)]), spark.createDataFrame([], O))
    assert a.matched.count() == 0 and a.unmatched.count() == 1 and a.counts.first().nUpdatedDiaObjects == 0


def test_float_ids_are_an_error(spark):
    with pytest.raises(ValueError):
        assign.match(sources(spark, []), spark.createDataFrame([], O.replace("diaObjectId bigint", "diaObjectId double")))


def cheapest(source, target, cost, price):
    """Least cost over all ways of giving sources objects, or none."""
    pairs = {}
    for s, t, c in zip(source, target, cost, strict=True):
        pairs.setdefault(s, {})[t] = c

    def walk(left, used):
        if not left:
            return 0.0
        ways = [price + walk(left[1:], used)]
        ways += [c + walk(left[1:], used | {t}) for t, c in pairs[left[0]].items() if t not in used]
        return min(ways)

    return walk(sorted(pairs), frozenset())


def total(source, cost, price, kept):
    return cost[kept].sum() + price * (len(set(source.tolist())) - len(kept))


def test_solver_is_optimal():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n, m = rng.integers(1, 6), rng.integers(1, 6)
        at = np.argwhere(rng.random((n, m)) < rng.choice([0.3, 0.7, 1.0]))
        if not len(at):
            continue
        source, target = at[:, 0] * 7, at[:, 1] * 5
        cost = rng.choice([rng.normal(size=len(at)), rng.integers(0, 3, len(at)) - 1.0])
        price = float(cost.max() + rng.choice([0.1, 1.0]))
        kept = assign.solve(source, target, cost, price)
        assert len(set(source[kept])) == len(set(target[kept])) == len(kept)
        assert total(source, cost, price, kept) == pytest.approx(cheapest(source, target, cost, price))


def first_of_equals(source, target, cost, price):
    """All ways, added up in the order of the sources: least sum, then the way whose first different source is left out or has the smaller object."""
    ways = [(0.0, (), ())]
    for s in sorted(set(source.tolist())):
        mine = [(price, -1)] + [(c, t) for a, t, c in zip(source.tolist(), target.tolist(), cost.tolist(), strict=True) if a == s]
        ways = [(x + c, choice + (t,), used + ((t,) if t >= 0 else ())) for x, choice, used in ways for c, t in mine if t not in used]
    return min(ways)[1]


def test_of_equal_assignments_the_stated_one_is_returned():
    rng = np.random.default_rng(5)
    for _ in range(400):
        n, m = rng.integers(1, 6), rng.integers(1, 5)
        at = np.argwhere(rng.random((n, m)) < rng.choice([0.6, 1.0]))
        if not len(at):
            continue
        source, target = at[:, 0] * 7 + 3, at[:, 1] * 5 + 1
        cost = rng.choice([0.1, 0.2, 0.3, 0.7], len(at)) - rng.choice([0.0, 19.3])
        price = float(cost.max() + 1)
        shuffled = rng.permutation(len(at))
        source, target, cost = source[shuffled], target[shuffled], cost[shuffled]
        want = first_of_equals(source, target, cost, price)
        for kept in (assign.solve(source, target, cost, price), assign._solved(pa.table({"diaSourceId": source, "diaObjectId": target, "score": cost, "unmatched": np.full(len(cost), price)}), np.zeros(len(cost), dtype=np.int64))):
            got = dict(zip(source[kept].tolist(), target[kept].tolist(), strict=True))
            assert tuple(got.get(s, -1) for s in sorted(set(source.tolist()))) == want


def test_scores_differ_from_sql_by_no_more_than_the_logarithm(spark):
    """Right ascensions are subtracted with the roundings of the SQL."""
    rows = [(150 + i * 1e-5 + 1e-4 * k / 7, 150 + i * 1e-5) for i in range(50) for k in (-1, 1)]
    from skymatch.functions.geometry import ra_difference

    got = [r[0] for r in spark.createDataFrame(rows, "a double, b double").select(ra_difference(F.col("a"), F.col("b"))).collect()]
    assert got == [math.fmod(math.fmod(a - b + 180, 360) + 360, 360) - 180 for a, b in rows]


def test_one_crowded_visit_by_components(spark):
    """All sources in one visit: chains that share objects, stars of both kinds and lone pairs, against all ways."""
    rng = np.random.default_rng(8)
    o, s = [], []
    for field in range(30):
        n_objects, n_sources = int(rng.integers(1, 5)), int(rng.integers(1, 6))
        o += [(100 * field + i + 1, 10.0 + 0.01 * field, (0.7 * i + rng.uniform(-0.2, 0.2)) * SEC, None, None) for i in range(n_objects)]
        s += [(1000 * field + i, 10.0 + 0.01 * field, (rng.uniform(-0.5, 0.7 * n_objects)) * SEC, None, None) for i in range(n_sources)]
    chord = 2 * math.sin(math.radians(SEC) / 2)
    price = 1.01 * math.radians(SEC) + 1e-300
    got = assign.match(sources(spark, s), spark.createDataFrame(o, O)).collect()
    far = {(a, b): 2 * math.sin(abs(math.radians(d - e)) / 2) for a, ra, d, *_ in s for b, rb, e, *_ in o if ra == rb}
    for field in range(30):
        mine = [(a, b, c) for (a, b), c in far.items() if a // 1000 == field and c <= chord]
        if not mine:
            continue
        kept = [r for r in got if r.diaSourceId // 1000 == field]
        assert len({r.diaSourceId for r in kept}) == len({r.diaObjectId for r in kept}) == len(kept)
        found = sum(far[r.diaSourceId, r.diaObjectId] for r in kept) + price * (len({a for a, *_ in mine}) - len(kept))
        assert found == pytest.approx(cheapest(*zip(*mine, strict=True), price))
    shuffled = sources(spark, s[::-1]).repartition(3)
    again = assign.match(shuffled, spark.createDataFrame(o, O)).collect()
    assert sorted((r.diaSourceId, r.diaObjectId) for r in again) == sorted((r.diaSourceId, r.diaObjectId) for r in got)


def test_components_may_span_batches():
    rows = [(1, 1, s, o, 0.1 * abs(s - o), s // 4, 5.0) for s in range(40) for o in (s, s + 1) if (s + 1) // 4 == s // 4]
    names = ["visit", "detector", "diaSourceId", "diaObjectId", "score", "component", "unmatched"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.float64()]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
    for size in (1, 3, 6, 7, 60):
        parts = [batch[i : i + size] for i in range(0, len(rows), size)] + [batch[:0]]
        got = [r for b in assign._solve_all(parts) for r in b.to_pylist()]
        assert sorted((r["diaSourceId"], r["diaObjectId"]) for r in got) == sorted((s, s) for _, _, s, o, *_ in rows if s == o)


def test_range_join_equals_all_pairs(spark):
    rng = np.random.default_rng(1)
    pos = [(i, float(a), float(d)) for i, (a, d) in enumerate(zip(rng.uniform(359.99, 360.01, 150) % 360, np.append(rng.uniform(-0.01, 0.01, 140), [90.0] * 10), strict=True))]
    df = spark.createDataFrame(pos, "id bigint, ra double, dec double")
    from skymatch.functions.geometry import unit_vector

    x, y, z = unit_vector(F.col("ra"), F.col("dec"))
    left = df.select(F.col("id").alias("a"), x.alias("lx"), y.alias("ly"), z.alias("lz"))
    right = df.select(F.col("id").alias("b"), x.alias("rx"), y.alias("ry"), z.alias("rz"))
    r = math.radians(0.003)
    got = {(p.a, p.b) for p in crossmatch.range_join(left, right, r, r, 3.0).collect()}
    v = np.array([[math.cos(math.radians(d)) * math.cos(math.radians(a)), math.cos(math.radians(d)) * math.sin(math.radians(a)), math.sin(math.radians(d))] for _, a, d in pos])
    far = np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1))
    assert got == {(int(i), int(j)) for i, j in zip(*np.where(far <= r), strict=True)}


@pytest.mark.parametrize("points", [[(359.9, 1.0), (359.99, 1.1), (0.01, 0.9), (0.1, 1.0)], [(10.0, 89.9), (130.0, 89.95), (250.0, 89.9)], [(77.0, -45.0)]])
def test_region_of_holds_all_sources(spark, points):
    from skymatch.streaming.visits import region_of

    df = spark.createDataFrame(points, "ra double, dec double")
    region = region_of(df)
    assert df.where(region.contains(F.col("ra"), F.col("dec"))).count() == len(points)
    far = spark.createDataFrame([(180.0, 0.0), (5.0, 3.0), (0.0, 80.0)], "ra double, dec double")
    assert far.where(region.contains(F.col("ra"), F.col("dec"))).count() == 0
    assert region_of(df.where("ra > 1000")) is None


def test_newest_version_decides_and_writes_repeat(spark, tmp_path):
    from skymatch.functions.geometry import Polygon
    from skymatch.sources.schemas import empty
    from skymatch.sources.store import Catalog

    catalog = Catalog(spark, str(tmp_path / "catalog"))
    old = spark.createDataFrame([(1, 10.001, 5.001), (2, 10.002, 5.002)], "diaObjectId bigint, ra double, dec double")
    new = spark.createDataFrame([(1, 10.012, 5.001)], "diaObjectId bigint, ra double, dec double")
    none = empty(spark, "diaSource"), empty(spark, "diaForcedSource")
    catalog.write(1, 0, 60000.0, old, *none)
    log, catalog.log = catalog.log, lambda *_: (_ for _ in ()).throw(OSError("no log"))
    with pytest.raises(OSError):
        catalog.write(2, 0, 60001.0, new, *none)
    catalog.log = log
    catalog.write(2, 0, 60001.0, new, *none)  # a run that failed before its log entry is written again
    assert catalog.read("diaObject").count() == 3
    region = Polygon.of_degrees([(10.0, 5.0), (10.01, 5.0), (10.01, 5.01), (10.0, 5.01)])
    assert [r.diaObjectId for r in catalog.load_objects(region).collect()] == [2]

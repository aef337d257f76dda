from collections import Counter, defaultdict

import numpy as np
import pytest
from skymatch.llm import mixing as M


def brute_targets(sizes):
    """Shares by weight, the excess over twice the size reshared by weight until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, free = {}, set(names)
    left = 1.5 * sum(sizes.values())
    while free:
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        full = {s for s in free if share[s] > 2 * sizes[s]}
        if not full:
            return target | share
        for s in full:
            target[s] = 2 * sizes[s]
            left -= 2 * sizes[s]
        free -= full
    return target


def test_targets(spark):
    rng = np.random.default_rng(3)
    for _ in range(5):
        sizes = {f"s{i}": int(rng.integers(0, 1000) ** 2) for i in range(7)} | {None: 50}
        got = {r.source: r.target for r in M.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")).collect()}
        want = brute_targets(sizes)
        assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s], abs=1e-6) for s in want)


def test_report(docs, rows):
    got = M.report(docs).collect()
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(d), len((t or "").split())) for d, t, *_ in rows)
    size = Counter()
    for _, t, _, s, _ in rows:
        size[s] += len((t or "").split())
    want, taken, target = brute_targets(size), Counter(), defaultdict(set)
    source = {(str(d), len((t or "").split())): s for d, t, _, s, _ in rows}
    for r in got:
        s = source[str(r.doc_id), r.size]
        taken[s] += r.taken
        target[s].add((r.source_size, round(r.target, 6)))
        assert 0 <= r.taken <= 2 * r.size
    for s in size:
        assert target[s] == {(size[s], round(want[s], 6))}
        # Documents are taken whole, so one that outweighs all others of its source leaves half of it open.
        largest = max(len((t or "").split()) for _, t, _, x, _ in rows if x == s)
        assert abs(taken[s] - want[s]) <= (largest / 2 if largest > 0.5 * size[s] else max(60, 0.01 * want[s]))
    assert sorted(map(tuple, M.report(docs).select("doc_id", "size", "taken").collect()), key=str) == sorted(((r.doc_id, r.size, r.taken) for r in got), key=str)


def test_large_edges_are_parted(spark, monkeypatch):
    monkeypatch.setattr(M, "EDGE_ROWS", 20)
    monkeypatch.setattr(M, "MOST_BLOCKS", 32)
    rng = np.random.default_rng(2)
    rows = [(i if i % 3 else 7, " ".join(["w"] * int(n)), "abc"[i % 3]) for i, n in enumerate(rng.integers(1, 40, 900))]
    got = M.report(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), block_words=300).collect()
    assert len(got) == 900 and all(r.taken <= 2 * r.size for r in got)
    by = {}
    for r in got:
        by.setdefault((r.source_size, r.target), []).append(r.taken)
    assert len(by) == 3 and all(abs(sum(x) - target) <= 0.01 * target for (_, target), x in by.items())


def test_quotas_add_up():
    rng = np.random.default_rng(1)
    q = np.array([100, 3, 0, 57])
    split = M.split_quotas(q, 16, rng)
    assert split.shape == (16, 4) and (split.sum(axis=0) == q).all() and (split >= 0).all()
    assert split.sum(axis=1).max() - split.sum(axis=1).min() <= 1


def test_draws_are_disjoint_and_complete(docs):
    mix = M.Mix(docs, block_words=500)
    draws = mix.draws().collect()
    passes = Counter(r.uid for r in draws)
    assert passes == Counter({r.uid: r.passes for r in mix.documents.collect() if r.passes})
    assert len({(r.uid, r["pass"]) for r in draws}) == len(draws) and {r.shard for r in draws} <= set(range(16))


def test_report_and_documents_are_the_draws(docs, monkeypatch):
    plans = []

    class Kept(M.Mix):
        def __init__(self, docs, **options):
            super().__init__(docs, **options | {"block_words": 500})
            plans.append(self)

    monkeypatch.setattr(M, "Mix", Kept)
    got = M.report(docs).collect()
    assert len({d.shard for r in got for d in r.draws}) == 16
    assert all(len(r.draws) == r.passes and r.taken == r.size * r.passes for r in got)
    assert Counter((str(r.doc_id), d["pass"], d.shard, d.place) for r in got for d in r.draws) == Counter((str(r.doc_id), r["pass"], r.shard, r.place) for r in plans[0].draws().collect())
    out = [len((r.text or "").split()) for r in M.mixed_documents(docs).collect()]
    assert out == [r.size for r in sorted(plans[1].draws().collect(), key=lambda r: (r.shard, r.place))]
    # The shards are those of the quotas.
    monkeypatch.setattr(M, "split_quotas", lambda q, n, rng: np.concatenate([np.zeros((n - 1, len(q)), dtype=np.int64), q[None, :]]))
    assert {d.shard for r in M.report(docs).collect() for d in r.draws} == {15}


def test_fit_comes_close():
    taken = M.fit(np.array([1304, 5, 700, 80]), 2084)
    assert np.array([1304, 5, 700, 80])[taken].sum() == 2084


def test_mixed_documents_keep_columns(docs):
    docs = docs.selectExpr("*", "1 as __row", "2 as __pass", "3 as place")
    out = M.mixed_documents(docs)
    assert out.columns == docs.columns and {(r["__row"], r["__pass"], r.place, r.shard) for r in out.collect()} == {(1, 2, 3, 7)}
    assert out.columns == docs.columns and out.count() == sum(r.passes for r in M.report(docs).select("passes").collect())


def test_empty_table(empty):
    assert M.report(empty).count() == 0
    assert M.Mix(empty).draws().count() == 0

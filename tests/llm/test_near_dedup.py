import random
from itertools import combinations

import pytest
from skymatch.llm import near_dedup as N
from skymatch.llm.components import connected_components


def shingle_set(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute_components(rows, k):
    """Smallest reachable doc_id of every row by comparing all pairs."""
    sets = [shingle_set(r[1], k) for r in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        c = len(sets[i] & sets[j])
        if c and 100 * c >= 80 * (len(sets[i]) + len(sets[j]) - c):
            group[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [(len(s), least.get(find(i))) for i, s in enumerate(sets)]


@pytest.mark.parametrize("k,sent", [(2, 500_000), (5, 500_000), (2, 0)])
def test_components_match_all_pairs(docs, rows, k, sent, monkeypatch):
    monkeypatch.setattr(N, "SENT_IDS", sent)  # 0: the texts are joined by a shuffle
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in N.report(docs, k=k).collect()), key=str)
    want = sorted(((r[0], n, c, r[0] == c) for r, (n, c) in zip(rows, brute_components(rows, k), strict=True)), key=str)
    assert got == want


def test_near_group_whose_pivot_links_few(spark, monkeypatch):
    """Links between others than the pivot are found, in blocks smaller than the group."""
    monkeypatch.setattr(N, "BLOCK", 16)
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    rows = []
    for i in range(90):
        w = list(base)
        for at in rng.sample(range(150), rng.choice([2, 5, 8, 12, 15])):
            w[at] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: r.component_id for r in N.report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {r[0]: c for r, (_, c) in zip(rows, brute_components(rows, 2), strict=True)}


def test_deduplicate_keeps_one_row_of_each(docs, rows):
    out = N.deduplicate(docs, k=5)
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.collect()]
    comps = brute_components(rows, 5)
    linked = {c for (n, c) in comps if n}
    alone = {r[0] for r, (n, _) in zip(rows, comps, strict=True) if not n}
    assert sorted(map(str, ids)) == sorted(map(str, linked | alone))


def test_repeated_and_empty_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (3, None), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "7 as __uid", "8 as _uid")
    out = N.deduplicate(df)
    assert out.columns == df.columns and sorted((r.doc_id, r.text or "", r["__uid"]) for r in out.collect()) == [(1, "a b c d e f", 7), (3, "", 7), (3, "", 7), (4, "", 7)]


def test_long_path_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (7, 7)], "u bigint, v bigint")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}


def test_empty_table(empty):
    assert N.report(empty).count() == 0 and N.deduplicate(empty).count() == 0

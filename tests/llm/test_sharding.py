import random
import zlib
from collections import defaultdict
from itertools import accumulate

import pytest
from skymatch.llm import sharding as S


def brute_capacity(sizes, shards):
    """Smallest possible largest sum of a split of ``sizes`` into at most ``shards`` runs, by dynamic programming."""
    ends = [0, *accumulate(sizes)]
    best = [0] + [float("inf")] * len(sizes)
    for _ in range(shards):
        best = [0] + [min(max(best[j], ends[i] - ends[j]) for j in range(i)) for i in range(1, len(ends))]
    return best[-1]


def test_assignment(docs, rows):
    got = S.assign(docs, 16).collect()
    assert len(got) == len(rows)
    texts = defaultdict(set)
    by_shard = defaultdict(list)
    for (doc_id, text, *_), r in zip(sorted(rows, key=lambda r: (str(r[0]), str(r[1]))), sorted(got, key=lambda r: str(r.doc_id)), strict=True):
        assert doc_id == r.doc_id and r.law == "bytes" and r.grown_shard is None
        assert r.size == len((text or "").encode()) + 1 and r.text_crc32 == zlib.crc32((text or "").encode())
        texts[text].add(r.shard)
    assert all(len(s) == 1 for s in texts.values())
    for r in got:
        by_shard[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values()) and set(by_shard) <= set(range(16))


@pytest.mark.parametrize("n", [1, 5, 16, 300])
def test_cuts_reach_the_smallest_capacity(spark, n, monkeypatch):
    rng = random.Random(n)
    sizes = {f"{rng.getrandbits(256):064x}": rng.randrange(1, 2000) for _ in range(n)}
    monkeypatch.setattr(S, "FIRST_DIGITS", 1)
    monkeypatch.setattr(S, "MORE_DIGITS", 1)
    df = spark.createDataFrame(list(sizes.items()), "key string, size bigint")
    cuts = S.contiguous_cuts(df, 16)
    sums = defaultdict(int)
    for key, size in sizes.items():
        sums[sum(key >= c for c in cuts)] += size
    assert max(sums.values()) == brute_capacity([sizes[k] for k in sorted(sizes)], 16) == S.smallest_capacity([sizes[k] for k in sorted(sizes)], 16)


def test_hot_group_gets_its_own_shard(spark):
    rows = [(i, "same text " * 50 if i % 3 == 0 else f"text {i} " * 20) for i in range(3000)]
    got = S.assign(spark.createDataFrame(rows, "doc_id bigint, text string"), 16).collect()
    sums = defaultdict(int)
    for r in got:
        sums[r.shard] += r.size
    assert {r.shard for r in got if r.doc_id % 3 == 0} == {0} and all(r.doc_id % 3 == 0 for r in got if r.shard == 0)
    rest = [v for k, v in sums.items() if k]
    assert len(rest) == 15 and max(rest) < 1.1 * min(rest)


def test_write_shards(spark, tmp_path):
    df = spark.createDataFrame([(i, f"text {i % 50}") for i in range(200)], "doc_id bigint, text string")
    S.write_shards(df, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, back.select("doc_id", "text").collect())) == sorted(map(tuple, df.collect()))


def test_empty_table(empty):
    assert S.assign(empty).count() == 0

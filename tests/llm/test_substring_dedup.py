import hashlib
from collections import Counter

import numpy as np
import pytest
from skymatch.llm import substring_dedup as S


def brute(rows, width):
    split = [(r[1] or "").encode().split() for r in rows]
    seen = Counter(tuple(w[i : i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for r, w in zip(rows, split, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        out.append((r[0], len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("width,chunk", [(35, 6 << 20), (35, 20_000), (3, 20_000)])
def test_matches_brute_force(docs, rows, width, chunk, monkeypatch):
    monkeypatch.setattr(S, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(S, "BUCKET_WINDOWS", 2000)
    got = sorted(map(tuple, S.report(docs, width).collect()), key=str)
    assert got == brute(rows, width)


@pytest.mark.parametrize("fan,relayed", [(1, 3), (3, 1000)])
def test_relays_match_brute_force(docs, rows, fan, relayed, monkeypatch):
    for name, value in {"CHUNK_BYTES": 20_000, "BUCKET_WINDOWS": 8000, "FAN_BITS": fan, "RELAYED": relayed}.items():
        monkeypatch.setattr(S, name, value)
    assert sorted(map(tuple, S.report(docs, 35).collect()), key=str) == brute(rows, 35)


def test_windows_that_share_the_first_hash_are_told_apart():
    one, two = np.array([7, 5, 7, 7, 5], dtype=np.uint64), np.array([1, 2, 3, 1, 2], dtype=np.uint32)
    a, b, which, times = S.distinct_pairs(one, two)
    assert a.tolist() == [5, 7, 7] and b.tolist() == [2, 1, 3] and which.tolist() == [1, 0, 2, 1, 0] and times.tolist() == [2, 2, 1]
    import pyarrow as pa

    sent = [S._messages(0, a[1:2], b[1:2], np.array([False]), 0), S._messages(1, a[1:], b[1:], np.array([False, False]), 0)]
    back = S._count(pa.concat_tables(sent)).to_pydict()
    assert [np.unpackbits(np.frombuffer(x, dtype=np.uint8))[:2].tolist() for x in back["repeated"]] == [[1, 0], [1, 0]]


def test_intervals_and_kept_words(spark):
    same = " ".join(f"s{i}" for i in range(40))
    df = spark.createDataFrame([(1, f"a {same} b"), (2, f"{same} c  d")], "doc_id bigint, text string")
    got = {r.doc_id: (r.begins, r.ends, r.kept) for r in S.remove_repeats(df).collect()}
    assert got == {1: ([1], [41], "a b"), 2: ([0], [40], "c d")}


def test_planes():
    x = np.sort(np.random.default_rng(1).integers(0, 2**64, 1000, dtype=np.uint64))
    assert (S.unpack(S.pack(x)) == x).all() and len(S.unpack(S.pack(x[:0]))) == 0


def test_equal_windows_have_equal_hashes():
    rng = np.random.default_rng(2)
    w = rng.integers(0, 2**64, 300, dtype=np.uint64)
    w[200:240] = w[10:50]
    h = S.window_hashes(w, 35)
    assert (h[200:206] == h[10:16]).all() and len(np.unique(h)) == len(h) - 6


def test_empty_table(empty):
    assert S.report(empty).count() == 0

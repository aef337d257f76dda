import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skymatch.llm import collocations

SCHEMA = "doc_id bigint, text string, lang string"
COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def split_pieces(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for mark in ".,;:!?\n\x0b\x0c\r":
        lowered = lowered.replace(mark, "\n")
    return [[w for w in piece.replace("\t", " ").split(" ") if w] for piece in lowered.split("\n")]


def brute(rows, longest=3, least=10, share=50, top=2000):
    counts, n = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for words in split_pieces(text):
            n[lang] += len(words)
            for k in range(1, longest + 1):
                counts.setdefault(lang, Counter()).update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) and 100 * b >= share * a for q, b in candidates.items()):
                continue
            score, cut = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def found(df):
    assert df.columns == list(COLUMNS)
    return sorted(tuple(r) for r in df.collect())


def make(seed, n=250):
    rng = random.Random(seed)
    vocab = ["the", "New", "york", "über", "naïve", "a", "of", "KK", "x\x85y", "zz\x00", "😀"] + [f"w{i}" for i in range(25)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.choice([0, 1, 2, 5, 30, 60])):
            words += rng.choice([["New", "York", "city"], ["of", "the"], ["the"] * rng.randrange(6), [rng.choice(vocab)], [rng.choice(vocab)]])
        text = "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "!? "]) for w in words)
        rows.append((rng.choice([None, i]), rng.choice([text, text, text.upper(), None]), rng.choice(["en", "en", "en", "de", None, "und", ""])))
    return rows + rows[:20] + [(1, "long " * 30_000 + "tail words here " * 9, "en")]


@pytest.mark.parametrize(("seed", "settings_"), [(1, {}), (2, {"least": 3, "share": 80, "top": 40}), (3, {"longest": 4, "least": 4})])
def test_against_counting(spark, seed, settings_):
    rows = make(seed)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6).withColumns({c: F.lit(7) for c in ("bucket", "n", "phrases", "phrase", "f", "a", "rank", "_w", "_nth")})
    got = found(collocations.collocations(docs, **settings_))
    assert got == brute(rows, **settings_) and len(got) > 20


def test_empty(spark, empty):
    result = collocations.collocations(empty)
    assert result.count() == 0
    assert [t for _, t in result.dtypes] == ["string", "bigint", "string"] + ["bigint"] * 5
    blank = spark.createDataFrame([(1, None, "en"), (2, " \n .", "en"), (None, "", None)], SCHEMA)
    assert collocations.collocations(blank).count() == 0


def test_counts_beyond_64_bits(spark):
    a, l, r = 4_000_000_007, 5_000_000_029, 7_000_000_001
    counts = spark.createDataFrame([("en", "p", l), ("en", "q", r), ("en", "p q", a), ("en", "big", 10**15), ("en", "big big", 10**15 - 1)], "lang string, phrase string, f bigint")
    scores = {x.phrase: x.score for x in collocations.scored(counts).collect()}
    assert scores == {"p q": 1_000_000 * a * a // (l * r), "big big": 1_000_000 * (10**15 - 1) ** 2 // 10**30}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcde"), min_size=1, max_size=40), min_size=1, max_size=12), st.integers(1, 5), st.integers(1, 40))
def test_bitmaps_count_all_phrases(lines, longest, together):
    shard = collocations.Shard()
    for line in lines:
        shard.add([w.encode() for w in line])
    words, places = shard.laid_out()
    old, collocations.TOGETHER = collocations.TOGETHER, together
    try:
        got = {}
        for phrases, bits in collocations.mine(places, len(words), longest):
            for p, n in zip(phrases, bits, strict=True):
                key = tuple(words[c].decode() for c in p)
                assert key not in got
                got[key] = int(n)
    finally:
        collocations.TOGETHER = old
    want = Counter(tuple(x[i : i + k]) for x in lines for k in range(1, longest + 1) for i in range(len(x) - k + 1))
    assert got == want


def test_long_texts_are_laid_out_in_parts(monkeypatch):
    text = b"One two, three four\x0b five" * 7
    whole = [x for part in collocations.pieces(text) for x in part]
    monkeypatch.setattr(collocations, "TEXT_BYTES", 9)
    parts = list(collocations.pieces(text))
    assert len(parts) > 7 and [w for part in parts for w in part if w != b"\xff"] == [w for w in whole if w != b"\xff"]
    cut = [piece for part in parts for piece in b" ".join(part).split(b" \xff ")]
    assert [p for p in cut if p] == b" ".join(whole).split(b" \xff ")


def test_shards_are_closed_and_summed(monkeypatch):
    monkeypatch.setattr(collocations, "SHARD_PLACES", 10)
    shard = collocations.Shard()
    assert not shard.add([b"a"] * 8) and shard.add([b"b"])
    rows = [r for pack in collocations.packs("en", shard, 3, 4) for r in pack.to_pylist()]
    total = Counter()
    for r in rows:
        for phrase in r["phrases"].split(b"\n"):
            total[phrase] += r["n"]
    assert total == {b"": 9, b"a": 8, b"b": 1, b"a a": 7, b"a a a": 6}
    assert np.all([0 <= r["bucket"] < 4 for r in rows])

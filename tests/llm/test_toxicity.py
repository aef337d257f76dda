import random
import re
import zlib
from collections import Counter

import numpy as np
from skymatch.llm import toxicity as T

LABELS = "doc_id bigint, quality int, toxic int"
BAD = ["vile", "dreadful", "loathsome", "wretch"]


def corpus(n=600, seed=9):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        w = [f"{'abcdefg'[rng.randrange(7)]}{rng.randrange(300):x}" for _ in range(rng.randrange(8, 60))]
        bad = rng.random() < 0.3
        if bad:
            for x in rng.sample(BAD, 2):
                w.insert(rng.randrange(len(w)), x)
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    got = {r.doc_id: r for r in T.report(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, LABELS)).collect()}
    held = [(got[i].predicted, t) for i, _, t in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(p == t for p, t in held) >= 0.97 * len(held) > 0
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert not {e for e in r.evidence if zlib.crc32(str(e).encode()) % 4 == 2}


def test_nearest_is_exact():
    rng = np.random.default_rng(1)
    vocabulary = {f"w{i}".encode(): i for i in range(40)}
    index = T.ExampleIndex(vocabulary, rng.uniform(1, 5, 40), k=7)
    texts = [" ".join(f"w{j}" for j in rng.integers(0, 60, rng.integers(1, 12))) for _ in range(500)]
    index.fill((i, t, int(rng.random() < 0.3)) for i, t in enumerate(texts))
    dense = np.zeros((len(index.ids), 41))
    for row, i in enumerate(index.ids.tolist()):
        terms, weights = index.vector(texts[i])
        dense[row, terms] = weights
    for t in texts[:60]:
        terms, weights = index.vector(t)
        q = np.zeros(41)
        q[terms] = weights
        want = np.sort((dense @ q)[dense @ q > 0])[::-1][:7]
        assert np.allclose(index.nearest(terms, weights)[1], want)


def test_texts_without_telling_terms_find_their_copies(spark):
    rows, labels = corpus(300)
    plain = "an odd kind of harm said in words that occur nowhere else at all"
    examples = [i for i in range(300, 420) if zlib.crc32(str(i).encode()) % 4 != 2][:15]
    rows += [(i, plain) for i in examples] + [(1000, plain), (1001, rows[7][1])]
    labels += [(i, 0, 1) for i in examples]
    got = {r.doc_id: r for r in T.report(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, LABELS)).collect()}
    assert set(got[1000].evidence) == set(examples) and got[1000].predicted == 1
    assert got[1001].evidence[0] == 7 or zlib.crc32(b"7") % 4 == 2
    assert all(len(r.evidence) == 15 for r in got.values())


def test_isotonic_levels_rise():
    knots, levels = T.isotonic(np.array([0.1, 0.2, 0.3, 0.4]), np.array([0, 1, 0, 1]))
    assert (np.diff(levels) > 0).all() and levels.tolist() == [0, 0.5, 1] and len(knots) == 3


def test_odd_rows_and_missing_labels(spark, docs, rows, empty):
    none = spark.createDataFrame([], LABELS)
    got = T.report(docs, none).collect()
    assert len(got) == len(rows) and all(r.score == 0 for r in got)
    assert T.report(empty, none).count() == 0


def test_blocks_are_ruled_out_without_loss(monkeypatch):
    """Two kinds of texts: the blocks of the other kind are left out, ties go to the smaller id, and one's own example does not count."""
    monkeypatch.setattr(T, "BLOCK", 8)
    rng = np.random.default_rng(3)
    vocabulary = {f"{c}{i}".encode(): i + 30 * (c == "b") for c in "ab" for i in range(30)}
    index = T.ExampleIndex(vocabulary, rng.uniform(1, 5, 60), k=5)
    texts = [" ".join(f"{'ab'[i % 2]}{j}" for j in rng.integers(0, 30, 6)) for i in range(400)]
    texts[10] = texts[4] = texts[2]
    index.fill((i, t, 0) for i, t in enumerate(texts))
    vectors = [index.vector(t) for t in texts[:100]]
    found = index.nearest_of(vectors, [*range(50), *[None] * 50])
    place = {i: p for p, i in enumerate(index.ids.tolist())}
    dense = np.zeros((400, 60))
    for i, t in enumerate(texts):
        terms, weights = index.vector(t)
        dense[i, terms] = weights.astype(np.float32)
    for q, (at, cosines) in enumerate(found):
        every = np.round(dense @ np.array([dict(zip(*map(np.ndarray.tolist, vectors[q]), strict=True)).get(t, 0.0) for t in range(60)]), 12)
        if q < 50:
            every[q] = 0
        want = [i for i in np.lexsort((np.arange(400), -every)) if every[i] > 0][:5]
        assert np.allclose(cosines, every[want]) and [index.ids[p] for p in at] == want, (q, place)
    assert index.scored < 0.6 * 100 * len(index.dense)


def test_report_by_brute_force(spark):
    """Every evidence and score, from dense loops over all words of all texts; repeated and very long rows among them."""
    rows, labels = corpus(240, seed=4)
    rows += [(500, rows[1][1]), (501, rows[1][1]), (502, " ".join(t for _, t in rows)), (502, "vile " * 3000), (503, None)]
    labels += [(500, 1, 0), (501, 0, 1), (502, 0, 1), (503, 0, 0)]
    docs, marks = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, LABELS)
    index = T.fit(docs, marks)
    counts = [Counter(re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").lower().encode())) for _, t in rows]
    marked = [t[1:] for t in index.vocabulary if t.startswith(b"^")]

    def held(times):
        out = dict(times)
        for stem in marked:
            n = sum(k for w, k in times.items() if w.startswith(stem) and w != stem and len(stem) in T.BEGINNINGS)
            if n:
                out[b"^" + stem] = n
        return out

    kept = [held(c) for c in counts]
    idf = {t: np.log((1 + len(rows)) / (1 + sum(t in k for k in kept))) + 1 for t in index.vocabulary}
    factor = {t: index.idf[i] / idf[t] for t, i in index.vocabulary.items()}
    assert all(f >= 1 - 1e-9 for f in factor.values()) and b"vile" in {t for t, f in factor.items() if f > 1.5}
    rare = np.log((1 + len(rows)) / 2) + 1
    known = list(index.vocabulary)

    def vector(times):
        w = np.array([(1 + np.log(times[t])) * idf[t] * factor[t] if t in times else 0.0 for t in known])
        others = sum(((1 + np.log(n)) * rare) ** 2 for t, n in times.items() if t not in index.vocabulary)
        norm = np.sqrt((w**2).sum() + others)
        return w / norm if norm else w

    vectors = [vector(k) for k in kept]
    toxic = {i: t for i, _, t in labels}
    examples = [e for e, (i, _) in enumerate(rows) if zlib.crc32(str(i).encode()) % 4 != 2]
    base = np.mean([toxic[rows[e][0]] for e in examples])
    assert len(index.ids) == len(examples)
    matrix = np.array([vectors[e] for e in examples])
    want = {}
    for (i, text), v in zip(rows, vectors, strict=True):
        cosines = matrix @ v
        best = [e for e in np.lexsort(([rows[e][0] for e in examples], -np.round(cosines, 6))) if cosines[e] > 0][:15]
        w = 1 / (1.05 - np.minimum(cosines[best], 1))
        raw = (w @ np.array([toxic[rows[examples[e]][0]] for e in best]) + base / 1.05) / (w.sum() + 1 / 1.05) if best else base
        score = np.interp(raw, index.knots, index.levels) if best and len(index.knots) else raw
        want.setdefault(i, []).append((float(score), sorted(np.round(cosines[best], 5).tolist()), {rows[examples[e]][0]: round(float(cosines[e]), 5) for e in range(len(examples))}))
    got = T.report(docs, marks).collect()
    assert len(got) == len(rows)
    for r in got:
        # Equal cosines may be told apart by rounding, so neighbours are held by their cosines.
        assert any(abs(r.score - score) < 1e-3 and (i_is_repeated(rows, r.doc_id) or np.allclose(sorted(of[e] for e in r.evidence), cosines, atol=3e-5)) for score, cosines, of in want[r.doc_id]), r


def i_is_repeated(rows, doc_id):
    return sum(i == doc_id for i, _ in rows) > 1

import random
import zlib

from skymatch.llm import quality as Q

LABELS = "doc_id bigint, quality int, toxic int"


def corpus(n=400, seed=4):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        w = [f"{'abcdefg'[rng.randrange(7)]}{rng.randrange(500):x}" for _ in range(rng.randrange(5, 120))]
        good = rng.random() < 0.7
        if not good:
            kind = rng.randrange(3)
            w = [x + "$$$" for x in w] if kind == 0 else [w[0]] * len(w) + ["!"] if kind == 1 else [x.upper() + "!!" for x in w]
        rows.append((i, " ".join(w)))
        if rng.random() < 0.6:
            labels.append((i, int(good), 0))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in Q.report(docs, spark.createDataFrame(labels, LABELS)).collect()}
    assert len(got) == len(rows)
    held = [(got[i].predicted, q) for i, q, _ in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(p == q for p, q in held) >= 0.95 * len(held) > 0
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_held_out_labels_are_never_used(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, t) for i, q, t in labels]
    a, b = (sorted(map(tuple, Q.report(docs, spark.createDataFrame(x, LABELS)).collect())) for x in (labels, turned))
    assert a == b


def test_paths():
    tree = "DecisionTree\n  If (feature 0 <= 1.5)\n   If (feature 1 <= -2.0)\n    Predict: 1.0\n   Else (feature 1 > -2.0)\n    Predict: 0.0\n  Else (feature 0 > 1.5)\n   Predict: 1.0\n"
    got = {r.bounds for r in Q.paths(tree, ["a", "b"])}
    assert got == {(("a", True, 1.5),), (("a", True, 1.5), ("b", True, -2.0)), (("a", True, 1.5), ("b", False, -2.0)), (("a", False, 1.5),)}


def test_odd_rows_and_missing_labels(spark, docs, rows, empty):
    none = spark.createDataFrame([], LABELS)
    got = Q.report(docs, none).collect()
    assert len(got) == len(rows) and all(r.score == 0.5 for r in got)
    one = spark.createDataFrame([(0, 1, 0), (2, None, 0), (None, 0, 1)], LABELS)
    assert all(0 <= r.score <= 1 for r in Q.report(docs, one).collect())
    assert Q.report(empty, none).count() == 0
    odd = docs.selectExpr("*", "1 as q_text", "2 as q_stat_chars", "3 as q_row", "4 as __text")
    kept = Q.keep_good(odd, none)
    assert kept.columns == odd.columns and kept.dtypes == odd.dtypes and kept.count() == len(rows)
    assert Q.keep_good(empty, none).count() == 0

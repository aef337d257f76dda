import random

from skymatch.llm import decontam as D
from skymatch.llm.common import alnum_words

ITEMS = "item_id bigint, text string"


def grams(text, n=5):
    w = alnum_words(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def test_pairs_match_all_against_all(spark, docs, rows):
    rng = random.Random(2)
    long = [t for _, t, *_ in rows if t and len(t.split()) >= 60]
    items = []
    for i in range(30):
        w = rng.choice(long).split()
        a = rng.randrange(len(w) - 50)
        piece = w[a : a + rng.choice([6, 15, 50])]
        for _ in range(rng.choice([0, 0, 1, 3])):
            piece[rng.randrange(len(piece))] = "changed"
        items.append((i, " ".join(piece)))
    items += [(100, None), (101, ""), (102, "too short item"), (103, long[0]), (103, long[0]), (104, "SINGLE!"), (106, ", ?")]
    items += [(110 + n, " ".join(long[n].split()[7 : 7 + n])) for n in range(1, 6)]
    got = sorted((str(r.doc_id), r.item_id, r.n_shingles, r.n_common) for r in D.contaminated(docs, spark.createDataFrame(items, ITEMS)).collect())
    want = []
    for doc_id, text, *_ in rows:
        for item, t in items:
            n = max(1, min(5, len(alnum_words(t))))
            x, y = grams(text, n), grams(t, n)
            if y and 100 * len(x & y) >= 80 * len(y):
                want.append((str(doc_id), item, len(y), len(x & y)))
    assert got == sorted(want) and want


def test_short_items(spark):
    docs = spark.createDataFrame([(1, "The Answer: four, yes."), (2, "answer yes four"), (3, "four yes"), (4, None), (5, "a four yes b answer four yes")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "answer four yes"), (2, "four  yes")], ITEMS)
    got = {(r.doc_id, r.item_id, r.n_shingles, r.containment) for r in D.contaminated(docs, items).collect()}
    assert got == {(1, 1, 1, 1.0), (5, 1, 1, 1.0), (1, 2, 1, 1.0), (3, 2, 1, 1.0), (5, 2, 1, 1.0)}
    assert sorted(r.doc_id for r in D.decontaminate(docs, items).collect()) == [2, 4]


def test_parts_give_the_same(spark, docs, rows, monkeypatch):
    items = spark.createDataFrame([(i, r[1]) for i, r in enumerate(rows[:20])], ITEMS)
    whole = sorted(map(tuple, D.contaminated(docs, items).collect()), key=str)
    monkeypatch.setattr(D, "PART_BYTES", 2000)
    assert sorted(map(tuple, D.contaminated(docs, items).collect()), key=str) == whole


def test_decontaminate(spark, docs, rows):
    items = spark.createDataFrame([(1, rows[3][1]), (2, "no such words stand in any document here")], ITEMS)
    bad = {r.doc_id for r in D.contaminated(docs, items).collect()}
    out = D.decontaminate(docs, items)
    assert out.schema == docs.schema
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(str(r[0]) for r in rows if r[0] not in bad)


def test_empty_tables(spark, docs, empty):
    none = spark.createDataFrame([], ITEMS)
    assert D.contaminated(docs, none).count() == 0 and D.decontaminate(docs, none).count() == docs.count()
    assert D.contaminated(empty, none).count() == 0


def test_items_of_middle_size_are_never_missed():
    rng = random.Random(8)
    items = [[f"w{rng.randrange(10**9)}" for _ in range(rng.choice([37, 40, 44, 54, 84]))] for _ in range(2500)]
    index = D.ItemIndex((i, " ".join(w)) for i, w in enumerate(items))
    of = D.WordHashes()
    for i, w in enumerate(items):
        n = len(w) - 4
        least = -(-80 * n // 100)
        # The fewest shingles at the threshold, and one less.
        a = rng.randrange(n - least + 1)
        for common, want in ((least, [(i, n, least)]), (least - 1, [])):
            x = of.of(alnum_words(" ".join(["before", *w[a : a + common + 4], "after"])))
            assert index.found(D.shingles(x, 5)) == want

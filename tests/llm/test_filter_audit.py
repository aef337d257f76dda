import random
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skymatch.llm import filter_audit

LABELS = "doc_id bigint, quality int, toxic int"
KEYS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def words(text):
    return text.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ")


def failed(rows):
    """Filters that each row fails, by their wording."""
    out = []
    for doc_id, text, *_ in rows:
        text = text or ""
        w = [x for x in words(text) if x]
        fails = ""
        if len(w) < 100:
            fails += "A"
        if 100 * len(set(w)) < 80 * len(w):
            fails += "B"
        if 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text):
            fails += "C"
        if any(c in "#$%&*|" for c in text):
            fails += "D"
        if doc_id is not None and any(r[0] is not None and r[0] < doc_id and (r[1] or "") == text for r in rows):
            fails += "E"
        out.append(fails)
    return out


def brute(rows, labels):
    fails = failed(rows)
    good = {d for d, q, t in labels if d is not None and q == 1}
    toxic = {d for d, q, t in labels if d is not None and t == 1}
    out = []
    for part in {r[2] or "" for r in rows}:
        mine = [(r[0], f) for r, f in zip(rows, fails, strict=True) if (r[2] or "") == part]
        steps = []
        for order in permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, 1):
                gone, left = [m for m in left if letter in m[1]], [m for m in left if letter not in m[1]]
                unique = sum(f == letter for _, f in mine)
                steps.append([part, "".join(order), step, len(left), len(gone), sum(letter in f for _, f in mine) - len(gone), unique, sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)])
        total = {x: sum(s[4] for s in steps if s[1][s[2] - 1] == x) for x in "ABCDE"}
        out += [(*s, total[s[1][s[2] - 1]]) for s in steps]
    return sorted(out)


def collected(df):
    return sorted(tuple(r[c] for c in KEYS) for r in df.collect())


def texts(seed):
    rng = random.Random(seed)
    plain = [" ".join(f"w{rng.randrange(9000)}" for _ in range(n)) for n in (99, 100, 101, 150)]
    few = " ".join(["same"] * 120)
    return [*plain, few, few.upper(), plain[1] + " 5%", "É" * 90 + "ABCDEFGHI", "É" * 90 + "ABCDEFGHIJK", "", None, " \t\x0b\n", "a|b", "A", "x\x85y " * 100, "$" + few.upper(), "very " + "long text " * 40_000]


@pytest.mark.parametrize("seed", [1, 2])
def test_every_order_against_applying_the_filters(spark, seed):
    rng = random.Random(seed)
    pool = texts(seed)
    rows = [(rng.choice([None, *range(60)]), rng.choice(pool), rng.choice(["en", "de", "", None])) for _ in range(120)]
    rows += [rows[3]] * 3
    labels = [(rng.choice([None, *range(60)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(5)
    clashing = docs.withColumns({c: F.lit(7) for c in ("part", "fails", "n", "high", "low", "good", "toxic", "step", "pos", "col")})
    found = filter_audit.audit(clashing, spark.createDataFrame(labels, LABELS).withColumn("good", F.lit(3)))
    assert collected(found) == brute(rows, labels)
    assert found.dtypes == [("part", "string"), ("filter_order", "string"), ("step", "int"), *((c, "bigint") for c in KEYS[3:])]


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], LABELS)
    assert filter_audit.audit(empty, labels).count() == 0
    docs = spark.createDataFrame([(1, "a|b", None)], "doc_id bigint, text string, lang string")
    assert collected(filter_audit.audit(docs, labels)) == brute([(1, "a|b", None)], [])


def test_more_parts_than_a_task_holds(monkeypatch):
    rng = random.Random(5)
    rows = [(f"l{rng.randrange(7)}", rng.randrange(32), rng.randrange(2), rng.randrange(2), rng.randrange(1, 4)) for _ in range(90)]
    columns = zip(*rows, strict=True)
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["part", "fails", "good", "toxic", "n"])
    batches = [batch[i : i + 30] for i in range(0, 90, 30)]

    def summed():
        out, made = {}, 0
        for found in filter_audit._removals(batches):
            for row in found.to_pylist():
                made += 1
                for c in ("removed", "good", "toxic"):
                    out[row["part"], c] = np.array(row[c]) + out.get((row["part"], c), 0)
        return {k: v.tolist() for k, v in out.items()}, made

    whole, parts = summed()
    monkeypatch.setattr(filter_audit, "HELD_PARTS", 2)
    pieces, more = summed()
    assert parts == 7 < more and whole == pieces
    assert sum(map(sum, (v for (_, c), v in whole.items() if c == "removed"))) == 120 * sum(r[4] for r in rows)


def test_table_of_first_failures():
    table = filter_audit.first_failures()
    assert table.shape == (32, 120) and (table[0] == 5).all()
    for mask in range(32):
        for o, order in enumerate(filter_audit.ORDERS):
            hit = [s for s, letter in enumerate(order) if mask >> "ABCDE".index(letter) & 1]
            assert table[mask, o] == (hit[0] if hit else 5)

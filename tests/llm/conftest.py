import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LICENSES = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "the GNU General Public License, version 3", "mit-LICENSE mit license", "All rights reserved."]


def word(rng, n=4000):
    return f"{'aeiou'[rng.randrange(5)]}{'bcdfgklmnprstvz'[rng.randrange(15)]}{rng.randrange(n):x}"


def make_rows(seed=1, n=120):
    """Small documents with copies, near copies, shared passages, licence lines, odd characters, nulls, empty and long texts."""
    rng = random.Random(seed)
    passage = " ".join(word(rng) for _ in range(60))
    rows, texts = [], []
    for i in range(n):
        kind = rng.randrange(10)
        if kind == 0 and texts:
            text = rng.choice(texts)
        elif kind == 1 and texts:
            w = rng.choice(texts).split(" ")
            for _ in range(max(1, len(w) // 30)):
                w[rng.randrange(len(w))] = word(rng)
            text = " ".join(w)
        else:
            text = " ".join(word(rng) + rng.choice(["", "", "", ".", ",", "!"]) for _ in range(rng.choice([1, 3, 40, 80, 200])))
            if kind == 2:
                text += "\n" + rng.choice(LICENSES)
            if kind == 3:
                text = text + " " + passage + " Ünïcode K " + word(rng)
        texts.append(text)
        rows.append((i, text, "en", f"src{rng.randrange(4)}" if rng.random() < 0.9 else None, len(text)))
    rows += [(n, None, None, None, None), (n + 1, "", "en", "src1", 0), (n + 2, " \t\n", "en", "src1", 3), (None, "no id at all", "en", "src2", 12), (n + 3, "single", "en", "Src9", 6)]
    rows += [(n + 4, " ".join(word(rng, 50) for _ in range(30_000)), "en", "src0", 0)]
    rows += [rows[5], rows[5]]  # repeated rows
    return rows


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """With an extra column whose name clashes with columns that the operators use."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit(7) for c in ("key", "row", "uid", "size", "label", "w", "chunk", "shard", "_id")})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)

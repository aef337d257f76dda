import random
import re

from skymatch.llm import license_scan as L

WORD = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def expected(text):
    w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    starts, labels = [], set()
    for phrase, label in L.BASE_PHRASES.items():
        p = phrase.split()
        at = [k for k in range(len(w)) if w[k : k + len(p)] == p]
        starts += at
        labels |= {label} if at else set()
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_base_matches_plain_search(docs, rows):
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in L.report(docs).collect()), key=str)
    assert got == sorted(((r[0], *expected(r[1])) for r in rows), key=str)


def test_base_labels_stay_and_scores_are_shares(docs):
    for r in L.report(docs).collect():
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score == 1 or not r.n_base) and (r.score == 0) == (r.labels == "")


def test_changed_notice_is_found_across_diagonals(spark):
    notice = next(n for n in L.NOTICES if n.startswith("redistribution"))
    w = notice.split()
    changed = " ".join(["x"] * 5 + w[:9] + ["very"] + w[9:])
    df = spark.createDataFrame([(1, changed), (2, " ".join(w[:4])), (3, "the mit " + "licence")], "doc_id bigint, text string")
    got = {r.doc_id: r.labels for r in L.report(df).collect()}
    assert got == {1: "bsd", 2: "", 3: ""}


def covered(w, notice, anchor):
    """Words of the notice that stand, with a neighbour, up to two places behind where ``anchor`` puts them."""
    pairs = {t for t in range(len(notice) - 1) for p in range(max(0, anchor + t), anchor + t + L.MAX_SHIFT + 1) if w[p : p + 2] == notice[t : t + 2]}
    return len(pairs | {t + 1 for t in pairs})


def own_labels(text):
    """By brute force: every notice at every place; of those that begin at one word, the ones with most words."""
    w = re.findall(WORD, (text or "").lower())
    found = {label for phrase, label in L.BASE_PHRASES.items() if f" {phrase} " in f" {' '.join(w)} "}
    best = {}
    for phrase, label in L.NOTICES.items():
        notice = phrase.split()
        for anchor in range(-2, len(w)):
            n = covered(w, notice, anchor)
            if n >= L.MIN_COVER * len(notice):
                start = next(p for p in range(max(0, anchor), len(w)) if any(w[p : p + 2] == notice[t : t + 2] and anchor <= p - t <= anchor + L.MAX_SHIFT for t in range(len(notice) - 1)))
                best.setdefault(start, []).append((n, label))
    for here in best.values():
        found |= {label for n, label in here if n == max(here)[0]}
    return ",".join(sorted(found))


def test_own_labels_against_brute_force(spark):
    rng = random.Random(4)
    texts = ["all rights all rights", "rights all rights", "licensed under cc by cc by cc by cc by", "licensed under cc by nc 3 0", "licensed under CC BY 2.0", "cc by nc", "All rights, reserved!", ""]
    for notice in L.NOTICES:
        for _ in range(6):
            w = [str(rng.randrange(50)) for _ in range(rng.randrange(4))] + notice.split() + ["end"] * rng.randrange(3)
            for _ in range(rng.randrange(4)):
                i = rng.randrange(len(w))
                w[i : i + rng.randrange(2)] = rng.choice([["x"], [], [w[rng.randrange(len(w))]], ["the", "mit"]])
                w = w or ["x"]
            texts.append(" ".join(w * rng.choice([1, 1, 2])))
    got = {r.doc_id: r.labels for r in L.report(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert got == {i: own_labels(t) for i, t in enumerate(texts)}
    assert [got[i] for i in range(8)] == ["", "", "cc-by", "cc-by-nc", "cc-by", "", "all-rights-reserved", ""]


def test_kelvin_sign_lower_cases_no_ascii_word(spark):
    df = spark.createDataFrame([(1, "MIT LICENSE Kelvin İ"), (2, "mıt license")], "doc_id bigint, text string")
    got = {r.doc_id: (r.n_words, r.n_base) for r in L.report(df).collect()}
    assert got == {1: (4, 1), 2: (2, 0)}


def test_empty_table(empty):
    assert L.report(empty).count() == 0

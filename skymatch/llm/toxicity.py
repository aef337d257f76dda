"""Toxicity scores from the nearest labelled examples by exact TF-IDF cosine over a block-max inverted index.

Examples are a bounded sample of labelled rows. Their vectors hold all their words, and beginnings of words that tell the classes
apart. Weights are 1 + log(count) times the inverse document frequency over all documents (a word in no example counts in
the length of a vector as if one document held it), times a factor for terms that are much more frequent in toxic examples than
in others; support is counted once per group of look-alike examples, so that copies don't vote for their own words.

Examples lie in blocks, those with the same heaviest words side by side. The index holds, for each term and block, the largest weight
and the postings (as a matrix where a term is frequent). The products of a text's weights with a block's largest ones bound
every cosine in it. The blocks of highest bounds are scored first; after that only blocks whose bound reaches the k-th best
cosine so far, and what may be among the k nearest is summed again from its whole vector, so the result is exact. Votes
weighted by distance (and one by the rate of all examples) give the raw score. An isotonic fit on examples that did not
choose the terms, each left out of its own vote, turns it into a calibrated one. The neighbours are returned as evidence.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Collection, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import alnum_words, batches_of, materialize, release, rows_of
from .quality import held_out

#: Labelled rows that serve as examples, at most: those with the smallest hashes of their doc_id.
SAMPLE_ROWS = 20_000
NEIGHBOURS, BATCH = 15, 128
#: Examples of a block, and blocks of a text that are scored before any is ruled out.
BLOCK, PROBED = 128, 2
#: One in so many examples calibrates instead of choosing terms.
CALIBRATES = 4
#: Share of the examples beyond which a term is frequent.
FREQUENT = 0.05
#: Terms that get a factor: least look-alike groups, least ratio of the rates, least z score.
LEAST_SUPPORT, LEAST_RATIO, LEAST_Z = 3, 4.0, 5.0
#: Lengths in bytes of the beginnings of longer words that are terms too; a mark keeps them apart from words.
BEGINNINGS, MARK = (4, 5, 6, 7, 8), b"^"
THRESHOLD = 0.3


def terms_of(word: bytes) -> list[bytes]:
    return [word, *(MARK + word[:n] for n in BEGINNINGS if len(word) > n)]


_SEEN = pa.schema([("group", pa.int64()), ("term", pa.binary())])


def _terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for text in (t for (t,) in rows_of(batches, "text")):
            w = alnum_words(text)
            # Look-alikes mostly share the smallest hash of their word pairs.
            group = min((xxhash.xxh3_64_intdigest(a + b" " + b) for a, b in zip(w, w[1:], strict=False)), default=0) >> 1
            for term in {t for x in set(w) for t in terms_of(x)}:
                yield group, term

    yield from batches_of(rows(), _SEEN, size=20_000)


class Terms:
    """Looks up the terms of the vocabulary in whole texts."""

    def __init__(self, vocabulary: dict[bytes, int]):
        self.vocabulary = vocabulary
        stems = [t.removeprefix(MARK) for t in vocabulary if t.startswith(MARK)]
        self.heads = {t[: min(BEGINNINGS)] for t in stems}
        # Beginnings of the words of the vocabulary, so that texts need looking up other words' alone.
        self.begun: dict[int, list[int]] = {}
        for word, i in self.beginnings(vocabulary):
            self.begun.setdefault(vocabulary[word], []).append(i)
        self.begins = np.zeros(len(vocabulary) + 1, dtype=bool)
        self.begins[list(self.begun)] = True

    def beginnings(self, words: Iterable[bytes]) -> Iterator[tuple[bytes, int]]:
        """Words with each of their beginnings that is a term."""
        n, heads, get = min(BEGINNINGS), self.heads, self.vocabulary.get
        for word in [w for w in words if w[:n] in heads]:
            for term in terms_of(word)[1:]:
                if (i := get(term)) is not None:
                    yield word, i

    def _looked_up(self, words: Collection[bytes]) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """The term of each word (-1: none), and every beginning that is a term with the place of its word."""
        terms = np.fromiter(map(self.vocabulary.get, words, itertools.repeat(-1)), dtype=np.int64, count=len(words))
        more = [(i, at) for at in np.flatnonzero(self.begins[terms]).tolist() for i in self.begun[int(terms[at])]]
        if self.heads:
            place = {w: at for at, (w, known) in enumerate(zip(words, (terms >= 0).tolist(), strict=True)) if not known}
            more += [(i, place[w]) for w, i in self.beginnings(place)]
        return terms, more

    def present(self, text: str | None) -> np.ndarray:
        """The terms of the vocabulary that stand in the text."""
        terms, more = self._looked_up(set(alnum_words(text)))
        terms = terms[terms >= 0]
        return np.union1d(terms, [i for i, _ in more]) if more else terms

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The terms of the vocabulary in the text, in ascending order, how often each stands there, and how often each other word."""
        times = Counter(alnum_words(text))
        n = np.fromiter(times.values(), dtype=np.int64, count=len(times))
        terms, more = self._looked_up(times)
        known = terms >= 0
        others, terms, n_terms = n[~known], terms[known], n[known]
        if more:
            terms = np.append(terms, [i for i, _ in more])
            n_terms = np.append(n_terms, n[[at for _, at in more]])
            terms, which = np.unique(terms, return_inverse=True)
            return terms, np.bincount(which, n_terms, minlength=len(terms)), others
        order = np.argsort(terms)
        return terms[order], n_terms[order], others


def _frequencies(shared):
    """How many texts hold each term, and how many texts there are (-1)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, terms = np.zeros(len(shared.value), dtype=np.int64), 0, Terms(shared.value)
        for (text,) in rows_of(batches, "text"):
            total += 1
            n[terms.present(text).astype(np.int64)] += 1
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *some.tolist()], pa.int64()), pa.array([total, *n[some].tolist()], pa.int64())], names=["term", "n"])

    return run


def frequencies(texts: DataFrame, vocabulary: dict[bytes, int]) -> tuple[int, np.ndarray]:
    """Number of texts, and of those that hold each term of a bounded vocabulary."""
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)
    counts = texts.select("text").mapInArrow(_frequencies(shared), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    term, n = (counts.column(c).to_numpy() for c in ("term", "n"))
    found = np.zeros(len(vocabulary))
    found[term[term >= 0]] = n[term >= 0]
    return int(n[term < 0].sum()), found


def telling_terms(sample: DataFrame) -> dict[bytes, float]:
    """Terms of ``sample`` (text, label) that are much more frequent in toxic examples, and the factors of their weights."""
    seen = materialize(sample.where("label = 1").select("text").mapInArrow(_terms, "group bigint, term binary").distinct(), "toxicity-terms")
    p = seen.agg(F.count_distinct("group")).first()[0]
    # Terms of a bounded sample.
    found = seen.groupBy("term").agg(F.count("*").alias("a")).where(F.col("a") >= LEAST_SUPPORT).collect()
    release(seen)
    names = [bytes(r["term"]) for r in found]
    q, b = frequencies(sample.where("label = 0"), {t: i for i, t in enumerate(names)})
    if not names or not p or not q:
        return {}
    a = np.array([r["a"] for r in found], dtype=np.float64)
    ratio = (a + 0.5) / (p + 1) / ((b + 0.5) / (q + 1))
    pooled = (a + b) / (p + q)
    z = (a / p - b / q) / np.sqrt(pooled * (1 - pooled + 1e-12) * (1 / p + 1 / q))
    kept: dict[bytes, float] = {}
    alike: dict[tuple[float, float], list[bytes]] = {}
    for i in sorted(np.flatnonzero((ratio >= LEAST_RATIO) & (z >= LEAST_Z)).tolist(), key=lambda i: (-z[i], -len(names[i]), names[i])):
        stem, same = names[i].removeprefix(MARK), alike.setdefault((a[i], b[i]), [])
        # Beginnings of one word that always come together are one term.
        if not any(stem.startswith(x) or x.startswith(stem) for x in same):
            same.append(stem)
            kept[names[i]] = 1 + (z[i] / LEAST_Z) ** 2
    return kept


class ExampleIndex:
    """Unit vectors of the examples, and the lists of the examples that hold each term."""

    def __init__(self, vocabulary: dict[bytes, int], idf: np.ndarray, k: int = NEIGHBOURS, rare: float = 0.0):
        """``idf`` holds the weights of the terms, ``rare`` that of a word outside the vocabulary."""
        self.k, self.vocabulary, self.idf, self.rare = k, vocabulary, idf, rare
        self.ids = self.labels = np.zeros(0, dtype=np.int64)
        self.base, self.knots, self.levels = 0.0, np.zeros(0), np.zeros(0)
        self.known = self.postings = None
        self.scored = 0

    def __getstate__(self):
        # Each worker makes its own lists.
        return self.__dict__ | {"known": None, "postings": None, "dense": None, "tops": None}

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights of the unit vector of a whole text; nothing if it has no term of the vocabulary."""
        if self.known is None:
            self.known = Terms(self.vocabulary)
        terms, counts, others = self.known.counts(text)
        weights = (1 + np.log(counts)) * self.idf[terms]
        other = (1 + np.log(others)) * self.rare
        return terms, weights / np.sqrt((weights**2).sum() + (other**2).sum())

    def fill(self, examples: Iterable[tuple[int, str | None, int]]) -> ExampleIndex:
        # Single precision, in which the vectors are sent.
        kept = [(doc_id, label, *(x.astype(t) for x, t in zip(self.vector(text), (np.int32, np.float32), strict=True))) for doc_id, text, label in examples]
        shared = np.bincount(np.concatenate([np.zeros(0, dtype=np.int32), *(e[2] for e in kept)]), minlength=len(self.idf)) > 1

        def place(e):
            terms, weights = e[2][shared[e[2]]], e[3][shared[e[2]]]
            return tuple(terms[np.argsort(-weights, kind="stable")[:3]].tolist()), e[0], e[1], e[2].tobytes(), e[3].tobytes()

        kept.sort(key=place)
        self.ids, self.labels = np.array([e[0] for e in kept], dtype=np.int64), np.array([e[1] for e in kept], dtype=np.int64)
        self.base = float(self.labels.mean()) if len(kept) else 0.0
        self.sizes = np.array([len(e[2]) for e in kept], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.terms = np.concatenate([np.zeros(0, dtype=np.int32), *(e[2] for e in kept)])
        self.weights = np.concatenate([np.zeros(0, dtype=np.float32), *(e[3] for e in kept)])
        return self

    def _lists(self) -> None:
        """Short lists as postings; long ones as a matrix per block, with the largest value of each term in each block."""
        held = np.bincount(self.terms, minlength=len(self.idf))
        example = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.sizes)
        frequent = np.flatnonzero(held > FREQUENT * len(self.ids))
        self.row = np.full(len(self.idf), -1, dtype=np.int32)
        self.row[frequent] = np.arange(len(frequent))
        self.dense = np.zeros((-(-len(self.ids) // BLOCK), len(frequent), BLOCK), dtype=np.float32)
        row = self.row[self.terms]
        often = row >= 0
        self.dense[example[often] // BLOCK, row[often], example[often] % BLOCK] = self.weights[often]
        self.tops = np.ascontiguousarray(self.dense.max(axis=2).T)
        rest = np.flatnonzero(~often)
        rest = rest[np.argsort(self.terms[rest], kind="stable")]
        self.held = np.where(self.row < 0, held, 0)
        self.first = np.cumsum(self.held) - self.held
        self.postings = example[rest], self.weights[rest]
        self.whole = np.zeros(len(self.idf))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, leave: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest cosine over 0 and these cosines; ties go to the smaller id."""
        return self.nearest_of([(terms, weights)], [leave])[0]

    def nearest_of(self, vectors: list[tuple[np.ndarray, np.ndarray]], leave: list[int | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The same for each of a batch of vectors; examples with the id to leave don't count."""
        if not len(self.terms):
            return [(np.zeros(0, dtype=np.int64), np.zeros(0)) for _ in vectors]
        if self.postings is None:
            self._lists()
        blocks = len(self.dense)
        asked = np.zeros((len(vectors), len(self.tops)), dtype=np.float32)
        sums = np.zeros((len(vectors), blocks * BLOCK), dtype=np.float32)
        for q, (terms, weights) in enumerate(vectors):
            row = self.row[terms]
            asked[q, row[row >= 0]] = weights[row >= 0]
            n = self.held[terms]
            of = np.repeat(self.first[terms] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            sums[q] = np.bincount(self.postings[0][of], np.repeat(weights.astype(np.float32), n) * self.postings[1][of], minlength=sums.shape[1])
        # What the short lists give, and the most that the long ones can add in a block, with more than any error of single precision.
        bounds = sums.reshape(len(vectors), blocks, BLOCK).max(axis=2) + asked @ self.tops + 1e-4
        own = [np.flatnonzero(self.ids == i) if i is not None else [] for i in leave]
        best = np.argsort(-bounds, axis=1)[:, :PROBED]
        least, done = np.zeros(len(vectors)), np.zeros(bounds.shape, dtype=bool)
        chosen = np.zeros_like(done)
        np.put_along_axis(chosen, best, True, axis=1)
        for first in (True, False):
            # One product serves all texts of the batch that ask for a block.
            for b in np.flatnonzero(chosen.any(axis=0)).tolist():
                some = np.flatnonzero(chosen[:, b])
                sums[some, b * BLOCK : (b + 1) * BLOCK] += asked[some] @ self.dense[b]
            done |= chosen
            for q in range(len(vectors)):
                sums[q, own[q]] = 0
                if first:
                    scored = sums[q].reshape(blocks, BLOCK)[best[q]].ravel()
                    least[q] = np.partition(scored, -self.k)[-self.k] if len(scored) >= self.k else 0.0
            # A block left out holds nothing that reaches the k-th best of those scored, nor do its unfinished sums.
            chosen = (bounds >= least[:, None]) & ~done
        self.scored += int(done.sum())
        return [self._summed(*v, x, float(low)) for v, x, low in zip(vectors, sums, least, strict=True)]

    def _summed(self, terms: np.ndarray, weights: np.ndarray, sums: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """The k best, by cosines from the whole vectors of all that may be among them."""
        at = np.flatnonzero((sums > 0) & (sums >= least - 1e-4))
        if not len(at):
            return at, np.zeros(0)
        if len(at) > self.k:
            at = at[sums[at] >= np.partition(sums[at], -self.k)[-self.k] - 1e-4]
        n = self.sizes[at]
        begin = np.cumsum(n) - n
        of = np.repeat(self.starts[at] - begin, n) + np.arange(n.sum())
        self.whole[terms] = weights
        cosines = np.add.reduceat(self.whole[self.terms[of]] * self.weights[of], begin)
        self.whole[terms] = 0
        best = np.lexsort((at, self.ids[at], -cosines))[: self.k]
        return at[best], cosines[best]

    def vote(self, at: np.ndarray, cosines: np.ndarray) -> float:
        """Share of toxic votes; the rate of all examples votes once, at cosine 0."""
        w, own = 1 / (1.05 - np.minimum(cosines, 1.0)), 1 / 1.05
        return float((w @ self.labels[at] + own * self.base) / (w.sum() + own))

    def raw(self, texts: list[str | None], leave: list[int | None]) -> list[tuple[float, np.ndarray]]:
        """Raw score and nearest examples of every text."""
        return [(self.vote(at, cosines), at) for at, cosines in self.nearest_of([self.vector(t) for t in texts], leave)]

    def score(self, texts: list[str | None]) -> Iterator[tuple[float, list[int]]]:
        for raw, at in self.raw(texts, [None] * len(texts)):
            if len(at) and len(self.knots):
                raw = float(np.interp(raw, self.knots, self.levels))
            yield min(1.0, max(0.0, raw)), self.ids[at].tolist()


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and non-decreasing levels of the least-squares fit of ``y`` by pooling adjacent violators."""
    pools: list[list[float]] = []  # mean, weight, sum of x
    for v, t in sorted(zip(x.tolist(), y.tolist(), strict=True)):
        pools.append([float(t), 1.0, v])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            m, n, s = pools.pop()
            pools[-1] = [(pools[-1][0] * pools[-1][1] + m * n) / (pools[-1][1] + n), pools[-1][1] + n, pools[-1][2] + s]
    return np.array([s / n for _, n, s in pools]), np.array([m for m, _, _ in pools])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> ExampleIndex:
    """The index of the labelled rows that are not held out."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")).where(F.col("label").isin(0, 1) & F.col("_id").isNotNull() & ~held_out(F.col("_id"), 4, 2))
    sample = known.orderBy(F.xxhash64("_id"), "label").limit(sample_rows)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    # Bounded by sample_rows, so it may be sent to every executor.
    examples = materialize(texts.join(F.broadcast(sample), "_id").select(F.col("_id").cast("long").alias("doc_id"), "text", "label"), "toxicity-examples")
    calibrates = F.pmod(F.xxhash64("doc_id", F.lit("calibrates")), F.lit(CALIBRATES)) == 0
    factors = telling_terms(examples.where(~calibrates))
    vocabulary = {t: i for i, t in enumerate(factors)}
    # The words of the examples, so no more of them than the sample is large.
    for (text,) in examples.select("text").toLocalIterator():
        for word in alnum_words(text):
            vocabulary.setdefault(word, len(vocabulary))
    total, n = frequencies(texts, vocabulary)
    weights = np.log((1 + total) / (1 + n)) + 1
    weights[: len(factors)] *= np.array(list(factors.values()))
    index = ExampleIndex(vocabulary, weights, rare=np.log((1 + total) / 2) + 1 if total else 0.0)
    index.fill((r["doc_id"], r["text"], r["label"]) for r in examples.toLocalIterator())
    own = examples.where(calibrates).mapInArrow(_raw(docs.sparkSession.sparkContext.broadcast(index)), "raw double, label int").toArrow()
    index.knots, index.levels = isotonic(own.column("raw").to_numpy(), own.column("label").to_numpy())
    release(examples)
    return index


_RAW = pa.schema([("raw", pa.float64()), ("label", pa.int32())])


def _raw(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for some in itertools.batched(rows_of(batches, "doc_id", "text", "label"), BATCH):
                for (raw, _), (_, _, label) in zip(shared.value.raw([t for _, t, _ in some], [i for i, _, _ in some]), some, strict=True):
                    yield raw, label

        yield from batches_of(rows(), _RAW, size=4096)

    return run


_SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("evidence", pa.list_(pa.int64()))])


def _score(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for some in itertools.batched(rows_of(batches, "doc_id", "text"), BATCH):
                for (doc_id, _), found in zip(some, shared.value.score([t for _, t in some]), strict=True):
                    yield doc_id, *found

        yield from batches_of(rows(), _SCORES, size=4096)

    return run


def report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted and evidence (ids of the nearest examples) of every document.

    Null text is scored as empty. A text without any word of the examples gets the rate of toxic examples (0 without examples). Rows
    that share a doc_id, repeated rows too, are scored each for itself; as an example each has a vote. Of equal cosines the smaller
    doc_id is nearer. Very long texts count whole. Without labels of both classes no term has a factor. Other columns are ignored,
    whatever their names. No rows: no rows.
    """
    index = fit(docs, labels, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(index)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scored = texts.mapInArrow(_score(shared), "doc_id bigint, score double, evidence array<bigint>")
    return scored.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence")

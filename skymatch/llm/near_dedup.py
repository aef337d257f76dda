"""MinHash near-duplicate detection.

Each document's set of word shingles is hashed by many universal hash functions; the minima are cut into bands, and documents
that agree on a whole band meet in a bucket. Documents with the same set are one class from the start, so that copies are never
paired. In a bucket, every class is first compared with the bucket's pivot alone, by a 128-bit signature and then by the full
sets; links form components by alternating stars. Only classes of one bucket that lie in different components after that
can still hold a link that matters. They meet in blocks of bounded size with larger sketches (the smallest 512 shingle hashes,
which is the whole set of most documents), twice: first each block names a spanning set of likely links, and after those are
verified and joined, all pairs that are still apart and may reach the threshold. Every link counts only once the full sets
confirm it. So the components are those of all links that any bucket holds, while no group's pairs are ever all written out.

With 32 bands of 4 minima, a pair at the threshold of 0.8 shares no bucket with probability (1 - 0.8^4)^32 = 5e-8. The
signature holds a bit of each minimum; a pair at 0.8 differs in 13 bits on average and in more than 36 with probability 1e-9.
A sketch's estimate may fall short of the threshold by five standard deviations.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, batches_of, free_name, lower_space_words, materialize, mix, release, rows_of, shingles
from .components import connected_components

BANDS, BAND_ROWS = 32, 4
MINIMA = BANDS * BAND_ROWS
#: Signature bits that may differ in a pair that is compared further.
MOST_DIFFERENT = 36
#: Classes of one bucket that one task compares with each other, and smallest shingle hashes in a sketch.
BLOCK, SKETCH = 1024, 512
#: Ids up to this number (of 8 bytes each) are sent to every executor to pick documents; more are joined by a shuffle of the texts.
SENT_IDS = 500_000
#: Parts into which the members of a bucket are dealt where they are joined to what is known of it.
SALTS = 16


def hash_parameters(n: int = MINIMA, seed: int = 20) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 2**64, n, dtype=np.uint64) | np.uint64(1), rng.integers(0, 2**64, n, dtype=np.uint64)


def minima(x: np.ndarray, a: np.ndarray, b: np.ndarray, step: int = 1024) -> np.ndarray:
    """Smallest value of every hash function a * x + b (mod 2^64) over the set ``x``."""
    low = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(x), step):
        np.minimum(low, (a[:, None] * x[None, i : i + step] + b[:, None]).min(axis=1), out=low)
    return low


_SKETCH = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("fp", pa.binary()), ("keys", pa.list_(pa.int64())), ("s1", pa.int64()), ("s2", pa.int64())])


def _sketches(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = hash_parameters()
        of, band = WordHashes(), np.arange(BANDS, dtype=np.uint64)

        def rows():
            for uid, doc_id, text in rows_of(batches, "uid", "doc_id", "text"):
                x = shingles(of.of(lower_space_words(text)), k)
                if not len(x):
                    yield uid, doc_id, 0, None, None, 0, 0
                    continue
                low = mix(minima(x, a, b))
                keys = band.copy()
                for j in range(BAND_ROWS):
                    keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + low[j::BAND_ROWS])
                s1, s2 = np.packbits((low & np.uint64(1)).astype(np.uint8)).view(np.int64)
                yield uid, doc_id, len(x), xxhash.xxh3_128_digest(x.tobytes()), keys.view(np.int64), int(s1), int(s2)

        yield from batches_of(rows(), _SKETCH)

    return run


_SETS = pa.schema([("uid", pa.int64()), ("members", pa.list_(pa.int64()))])
_SMALLEST = pa.schema([("uid", pa.int64()), ("smallest", pa.binary())])


def _sets(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = WordHashes()
        yield from batches_of(((uid, shingles(of.of(lower_space_words(text)), k).view(np.int64)) for uid, text in rows_of(batches, "uid", "text")), _SETS)

    return run


def _smallest(k: int):
    """The leading 32 bits of the SKETCH smallest shingle hashes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = WordHashes()
        yield from batches_of(((uid, (shingles(of.of(lower_space_words(text)), k)[:SKETCH] >> np.uint64(32)).astype("<u4").tobytes()) for uid, text in rows_of(batches, "uid", "text")), _SMALLEST)

    return run


def _spark_schema(schema: pa.Schema) -> str:
    kinds = {"int64": "bigint", "binary": "binary", "list<item: int64>": "array<bigint>"}
    return ", ".join(f"{f.name} {kinds[str(f.type)]}" for f in schema)


def _different(x1: Column, x2: Column, y1: Column, y2: Column) -> Column:
    return F.bit_count(x1.bitwiseXOR(y1)) + F.bit_count(x2.bitwiseXOR(y2))


def similar(v: np.ndarray, whole: bool, others: list[np.ndarray], wholes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated similarity of sketch ``v`` to each of ``others``, and the sample size (0 where both are whole sets, so exact)."""
    flat, sizes = np.concatenate(others), np.array([len(o) for o in others])
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    # Up to the smaller of the two last values, both sketches hold all of their set.
    last = np.minimum(v[-1] if not whole else np.uint32(0xFFFFFFFF), np.where(wholes, np.uint32(0xFFFFFFFF), flat[begin + sizes - 1]))
    seen = flat <= np.repeat(last, sizes)
    at = np.minimum(np.searchsorted(v, flat), len(v) - 1)
    common = np.add.reduceat(seen & (v[at] == flat), begin).astype(np.int64)
    union = np.add.reduceat(seen, begin).astype(np.int64) + np.searchsorted(v, last, "right") - common
    return common / np.maximum(union, 1), np.where(wholes & whole, 0, union)


def _find(parent: dict[int, int], x: int) -> int:
    while parent.setdefault(x, x) != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _across(threshold: int, likely: bool):
    """Pairs of one block of a bucket that lie in different components: a spanning set of likely links, or all that may be links.

    A pair that shares several buckets is looked at in the first of its shared bands alone.
    """
    least = threshold / 100

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        name, first, second = int(key[0]), key[1], key[2]
        node, component, n, own = (pdf[c].to_numpy() for c in ("node", "component", "n_shingles", "own"))
        s1, s2 = pdf["s1"].to_numpy(), pdf["s2"].to_numpy()
        keys = np.stack(pdf["keys"].to_list())
        sketches = [np.frombuffer(x, dtype="<u4") for x in pdf["smallest"]]
        wholes = np.array([len(x) < SKETCH for x in sketches])
        band = int(np.flatnonzero(keys[0] == name)[0])
        names, sizes = np.unique(component, return_counts=True)
        most = names[sizes.argmax()]  # its members are reached from the others
        parent: dict[int, int] = {}
        a, b = [], []
        for i in np.flatnonzero(component != most).tolist():
            fit = (component != component[i]) & ((component == most) | (node > node[i])) & (100 * np.minimum(n, n[i]) >= threshold * np.maximum(n, n[i]))
            if first != second:
                fit &= own != own[i]
            at = np.flatnonzero(fit)
            # Unsigned, since bitwise_count takes absolute values.
            far = np.bitwise_count((s1[at] ^ s1[i]).view(np.uint64)).astype(np.int64) + np.bitwise_count((s2[at] ^ s2[i]).view(np.uint64))
            at = at[far <= MOST_DIFFERENT]
            if len(at) and band:
                at = at[~(keys[at, :band] == keys[i, :band]).any(axis=1)]
            if not len(at):
                continue
            value, sample = similar(sketches[i], bool(wholes[i]), [sketches[j] for j in at.tolist()], wholes[at])
            # Whole sets hold leading bits of hashes: a few shingles may have fallen together.
            slack = np.where(sample > 0, 5 * np.sqrt(least * (1 - least) / np.maximum(sample, 1)), 3 / n[i])
            if not likely:
                at = at[value >= least - slack]
                a += [node[i]] * len(at)
                b += node[at].tolist()
                continue
            for j in at[np.argsort(-value, kind="stable")][: int((value >= least).sum())].tolist():
                x, y = _find(parent, int(component[i])), _find(parent, int(component[j]))
                if x != y:
                    parent[x] = y
                    a.append(node[i])
                    b.append(node[j])
        a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


class NearDuplicates:
    """Classes, links and components of ``docs``; see the module's text.

    ``assigned``: uid, doc_id, n_shingles, component_id (smallest doc_id), component (a uid that names it).
    Rows are numbered and kept first, so a uid is a row, repeated rows included. Empty documents are linked with nothing.
    """

    def __init__(self, docs: DataFrame, k: int = 2, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text", uid_col: str | None = None):
        """``uid_col``, if given, numbers the rows of a kept table."""
        self.k, self.threshold = k, threshold
        uid = F.col(uid_col) if uid_col else F.monotonically_increasing_id()
        self.docs = docs.select(uid.alias("uid"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        if not uid_col:
            self.docs = materialize(self.docs, "near-documents")
        self.rows = materialize(self.docs.mapInArrow(_sketches(k), _spark_schema(_SKETCH)), "near-sketches")
        full = self.rows.where("n_shingles > 0")
        self.classes = materialize(
            full.groupBy("fp").agg(F.min_by(F.struct(F.col("uid").alias("node"), "n_shingles", "keys", "s1", "s2"), "uid").alias("c"), F.min("doc_id").alias("least")).select("fp", "least", "c.*"), "near-classes"
        )
        self.signatures = self.classes.select("node", "n_shingles", "s1", "s2")
        self.links = self._linked()

    def _texts(self, ids: DataFrame) -> DataFrame:
        """uid and text of the documents named by ``ids`` (uid, distinct)."""
        ids = F.broadcast(ids) if ids.count() <= SENT_IDS else ids
        return self.docs.select("uid", "text").join(ids, "uid", "left_semi")

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """Of ``pairs`` (a, b), those whose full sets meet the threshold, as edges (u, v)."""
        ids = materialize(pairs.select(F.col("a").alias("uid")).unionByName(pairs.select(F.col("b").alias("uid"))).distinct(), "near-ids")
        sets = materialize(self._texts(ids).mapInArrow(_sets(self.k), _spark_schema(_SETS)).dropDuplicates(["uid"]), "near-sets")
        both = pairs.join(sets.select(F.col("uid").alias("a"), F.col("members").alias("x")), "a").join(sets.select(F.col("uid").alias("b"), F.col("members").alias("y")), "b")
        common = both.select("a", "b", F.size(F.array_intersect("x", "y")).cast("long").alias("c"), (F.size("x") + F.size("y")).cast("long").alias("n"))
        edges = materialize(common.where(100 * F.col("c") >= self.threshold * (F.col("n") - F.col("c"))).select(F.col("a").alias("u"), F.col("b").alias("v")), "near-edges")
        release(ids, sets)
        return edges

    def _near(self, pairs: DataFrame) -> DataFrame:
        s = self.signatures
        one, two = (s.select(F.col("node").alias(p), F.col("n_shingles").alias(f"n_{p}"), F.col("s1").alias(f"s1_{p}"), F.col("s2").alias(f"s2_{p}")) for p in "ab")
        fit = 100 * F.least("n_a", "n_b") >= self.threshold * F.greatest("n_a", "n_b")
        return pairs.join(one, "a").join(two, "b").where(fit & (_different(F.col("s1_a"), F.col("s2_a"), F.col("s1_b"), F.col("s2_b")) <= MOST_DIFFERENT)).select("a", "b")

    def _linked(self) -> DataFrame:
        keyed = self.classes.select("node", F.pmod(F.xxhash64("node"), F.lit(SALTS)).alias("salt"), F.explode("keys").alias("key"))
        # One bucket may hold a large share of all classes, so the few rows about it are copied and its members are parted.
        salted = lambda df: df.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        pivots = materialize(keyed.groupBy("key").agg(F.min("node").alias("pivot"), F.count("*").alias("n")).where("n > 1"), "near-pivots")
        members = materialize(keyed.join(salted(pivots), ["key", "salt"]), "near-members")
        stars = members.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
        tested = materialize(self._near(stars), "near-pairs")
        edges = self._verified(tested)
        self.components = materialize(connected_components(edges), "near-components")
        # Others of a bucket than its pivot: they have not been compared with each other yet.
        others = members.where("n > 2 and node <> pivot").select("key", "salt", "node", "n")
        for likely in (True, False):
            named = materialize(others.join(self.components, "node", "left").withColumn("component", F.coalesce("component", "node")), "near-named")
            mixed = named.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
            left = materialize(named.join(salted(mixed), ["key", "salt"]).drop("salt"), "near-left")
            ids = materialize(left.select(F.col("node").alias("uid")).distinct(), "near-ids")
            sketched = self._texts(ids).mapInArrow(_smallest(self.k), "uid bigint, smallest binary").dropDuplicates(["uid"]).withColumnRenamed("uid", "node")
            described = materialize(self.classes.select("node", "n_shingles", "keys", "s1", "s2").join(sketched, "node"), "near-described")
            blocks = F.ceil(F.col("n") / BLOCK).cast("int")
            rows = left.join(described, "node").withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
            # Each block meets every block of its bucket, itself included, in one group.
            met = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumn("first", F.least("own", "other")).withColumn("second", F.greatest("own", "other"))
            pairs = met.groupBy("key", "first", "second").applyInPandas(_across(self.threshold, likely), "a bigint, b bigint").distinct()
            fresh = materialize(pairs.join(tested, ["a", "b"], "left_anti"), "near-pairs")
            release(named, left, ids, described)
            if fresh.isEmpty():
                continue
            edges = edges.unionByName(self._verified(fresh))
            tested = tested.unionByName(fresh)
            self.components = materialize(connected_components(edges), "near-components")
        release(members, pivots)
        return edges

    @property
    def assigned(self) -> DataFrame:
        classes = self.classes.select("fp", "least", "node").join(self.components, "node", "left").withColumn("component", F.coalesce("component", "node"))
        named = classes.groupBy("component").agg(F.min("least").alias("component_id"))
        found = materialize(classes.join(named, "component").select("fp", "component_id", "component"), "near-components")
        rows = self.rows.join(found, "fp", "left")
        component_id = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
        return rows.select("uid", "doc_id", "n_shingles", component_id.alias("component_id"), F.coalesce("component", "uid").alias("component"))


def report(docs: DataFrame, k: int = 2, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document.

    A null doc_id is its component's last choice and never kept beside another. Null and empty texts have no set and a component
    of their own. Rows that share a doc_id, repeated rows too, are rows of their own, all kept if the doc_id is the least. Very
    long texts are hashed whole. Other columns are ignored, whatever their names. No rows: no rows.
    """
    found = NearDuplicates(docs, k, threshold, id_col, text_col).assigned
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))


def deduplicate(docs: DataFrame, k: int = 5, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, of which each component keeps one: that with the smallest doc_id (null last; of equal ones the first read).

    Null and empty texts are linked with nothing, so each such row stays. No rows: no rows.
    """
    uid = free_name(docs, "uid")
    keyed = materialize(docs.withColumn(uid, F.monotonically_increasing_id()), "near-input")
    found = NearDuplicates(keyed, k, threshold, id_col, text_col, uid).assigned
    heads = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "uid")).getField("uid").alias(uid)).select(uid)
    return keyed.join(heads, uid, "left_semi").drop(uid)

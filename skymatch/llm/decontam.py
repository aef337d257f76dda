"""Benchmark decontamination: which test items stand inside which documents.

A sketch of a long document would lose a short item in it, so the items are indexed instead. A document that holds c of an item's
n shingles lacks n - c of them, so of any m shingles of the item it holds m - (n - c) at least. Every item is therefore
represented by its n - c + EXTRA shingles that are rarest among the items, where c is the least number at the threshold (by all
of them if it has no more). A document's every shingle is looked up in this table; an item of which EXTRA (or, if all its shingles
are there, c) are found is a candidate, and the whole sets decide. So no item is missed, whatever its size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, alnum_words, batches_of, rows_of, shingles

SHINGLE, THRESHOLD = 5, 80
#: Shingles of an item that a candidate's document must hold, out of so many more than it may lack.
EXTRA = 8
#: Text bytes of the items that one index holds; a larger benchmark is searched in several parts, one index after the other.
PART_BYTES = 32 << 20


class ItemIndex:
    """Sorted representing shingles with the items that have them, and every item's whole set."""

    def __init__(self, items: Iterable[tuple[int, str | None]], threshold: int = THRESHOLD):
        of = WordHashes()
        self.threshold, self.ids = threshold, []
        self.short: set[int] = set()  # lengths of the items of fewer words than a shingle, each one shingle of its own
        sets = [np.empty(0, dtype=np.uint64)]
        for item_id, text in items:
            words = of.of(alnum_words(text))
            if len(words):
                self.ids.append(item_id)
                sets.append(shingles(words, SHINGLE))
                if len(words) < SHINGLE:
                    self.short.add(len(words))
        self.all, self.sizes = np.concatenate(sets), np.array([len(x) for x in sets[1:]], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        lacking = self.sizes - -(-threshold * self.sizes // 100)
        most = np.minimum(self.sizes, lacking + EXTRA)
        self.need = most - lacking
        # The rarest first within each item.
        _, which, counts = np.unique(self.all, return_inverse=True, return_counts=True)
        item = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.sizes)
        order = np.lexsort((self.all, counts[which], item))
        order = order[np.arange(len(order)) - np.repeat(self.starts, self.sizes) < np.repeat(most, self.sizes)]
        order = order[np.argsort(self.all[order], kind="stable")]
        self.keys, self.items = self.all[order], item[order]

    def document(self, words: np.ndarray) -> np.ndarray:
        """Shingles of a document that items can share with it, by the hashes of its words: of five words, and of the lengths of short items."""
        lengths = [n for n in (*sorted(self.short), SHINGLE) if n <= len(words)]
        sets = [shingles(words, n) for n in lengths]
        return np.unique(np.concatenate(sets)) if len(sets) > 1 else sets[0] if sets else np.empty(0, dtype=np.uint64)

    def found(self, x: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, its shingles, those of them in ``x``) for the items contained in the document set ``x``."""
        low, high = np.searchsorted(self.keys, x, "left"), np.searchsorted(self.keys, x, "right")
        hit = np.flatnonzero(high > low)
        if not len(hit):
            return []
        out = []
        which, n = np.unique(np.concatenate([self.items[low[i] : high[i]] for i in hit]), return_counts=True)
        for i in which[n >= self.need[which]].tolist():
            size = int(self.sizes[i])
            common = int(np.isin(self.all[self.starts[i] : self.starts[i] + size], x, assume_unique=True).sum())
            if 100 * common >= self.threshold * size:
                out.append((self.ids[i], size, common))
        return out


def indexes(benchmark: DataFrame, threshold: int = THRESHOLD, item_col: str = "item_id", text_col: str = "text") -> Iterator[ItemIndex]:
    """Indexes of the benchmark's parts, each of about PART_BYTES of text."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-total // PART_BYTES))
    for i in range(parts):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == i)
        yield ItemIndex(((r["item_id"], r["text"]) for r in part.collect()), threshold)


_PAIRS = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_shingles", pa.int64()), ("n_common", pa.int64())])


def _probe(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, of = shared.value, WordHashes()

        def rows():
            for doc_id, text in rows_of(batches, "doc_id", "text"):
                words = of.of(alnum_words(text))
                for item in index.found(index.document(words)):
                    yield doc_id, *item

        yield from batches_of(rows(), _PAIRS)

    return run


def _clean(shared, text_col: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, of = shared.value, WordHashes()
        for batch in batches:
            keep = []
            for text in batch.column(batch.schema.get_field_index(text_col)).to_pylist():
                words = of.of(alnum_words(text))
                keep.append(not index.found(index.document(words)))
            yield batch.filter(pa.array(keep, type=pa.bool_()))

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, n_shingles, n_common, containment) for each item that stands in a document.

    Words are lower-cased runs of letters, digits and non-ASCII characters. An item of fewer than five words is one shingle, which stands in a document
    where its words follow one another there. Null, empty and blank texts match nothing. Very long texts are read whole. Rows that share an id are reported
    each for itself, ties and repeats included. Extra columns are not read, so their names can't clash. Empty tables give no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = None
    for index in indexes(benchmark, threshold, text_col="text"):
        # At most PART_BYTES of items, so an index of bounded size.
        part = texts.mapInArrow(_probe(spark.sparkContext.broadcast(index)), "doc_id bigint, item_id bigint, n_shingles bigint, n_common bigint")
        found = part if found is None else found.unionByName(part)
    return found.withColumn("containment", F.col("n_common") / F.col("n_shingles"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: int = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item stands, with all their columns, whatever these are called; rows with null or empty texts stay, repeated rows stay
    or go together, very long texts are read whole. An empty benchmark removes nothing."""
    out = docs
    for index in indexes(benchmark, threshold):
        out = out.mapInArrow(_clean(docs.sparkSession.sparkContext.broadcast(index), text_col), docs.schema)
    return out

"""Filter interaction audit: what each of five filters removes under every order in which they could be applied.

One scan of the texts (Arrow batches, bytes alone) says which filters a document fails by itself and leaves a 128-bit digest of its text; a grouped
minimum over the digests finds copies. A document's failures are a number below 32, and a table of 32 by 120 says at which step each of the 120
orders removes such a document, so no order is ever applied. Tasks hold one array of counts per part, not rows; Spark sums the arrays.

Rows: every row counts, repeated rows as often as they come. A null text is empty, a null ``lang`` is the part ''. A row without doc_id is no copy, makes
no copies and has no label. Two digests of different texts agree with probability n^2 / 2^129. Extra columns are not read, so their names can't clash.
An empty table has no parts and gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = len(FILTERS)
#: Cells of a part's array: orders by steps, and one more step for documents that stay.
CELLS = len(ORDERS) * (STEPS + 1)
#: Parts whose arrays a task holds at a time; beyond it they are handed on and begun anew.
HELD_PARTS = 256

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_NOT_CAPITALS = bytes(b for b in range(256) if b not in _CAPITALS)
_CONTINUATION = bytes(range(0x80, 0xC0))
_MARKS = b"#$%&*|"


def first_failures() -> np.ndarray:
    """[failures, order]: the step, from 0, that removes a document failing these filters; 5 if it stays. Bit i of failures stands for filter i."""
    table = np.full((1 << STEPS, len(ORDERS)), STEPS, dtype=np.int64)
    for o, order in enumerate(ORDERS):
        for step in reversed(range(STEPS)):
            fails = np.arange(1 << STEPS) >> FILTERS.index(order[step]) & 1 == 1
            table[fails, o] = step
    return table


def own_failures(text: bytes) -> int:
    """Failures A to D of one text (UTF-8): short, repetitive, capitals, marks."""
    words = text.split()  # bytes.split() parts at \\x20 and \\x09-\\x0D alone
    points = len(text.translate(None, _CONTINUATION))
    return (
        (len(words) < 100)
        | (100 * len(set(words)) < 80 * len(words)) << 1
        | (100 * len(text.translate(None, _NOT_CAPITALS)) > 10 * points) << 2
        | any(m in text for m in _MARKS) << 3
    )


def _facts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fails, digests = [], []
        for text in batch.column(2):
            data = text.as_py() or b""
            fails.append(own_failures(data))
            digests.append(hashlib.blake2b(data, digest_size=16).digest())
        both = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fails, pa.int32()), pa.array(both[:, 0]), pa.array(both[:, 1])], names=["doc_id", "part", "fails", "high", "low"])


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, fails (bits of A to E), n: rows of documents by what they fail; rows equal in all of it are counted together."""
    read = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("lang").cast("string"), F.lit("")), F.col("text").cast("binary"))
    facts = materialize(read.mapInArrow(_facts, "doc_id long, part string, fails int, high long, low long"), "audit-facts")
    rows = facts.groupBy("doc_id", "part", "fails", "high", "low").agg(F.count(F.lit(1)).alias("n"))
    with_id = rows.where(F.col("doc_id").isNotNull())
    # One row per distinct text, keyed by its smallest id as well: a group of copies spreads over the tasks by its ids.
    smallest = facts.where(F.col("doc_id").isNotNull()).groupBy("high", "low").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    marked = with_id.join(smallest, ["high", "low", "doc_id"], "left")
    copied = marked.select("doc_id", "part", (F.col("fails") + F.when(F.col("is_first"), 0).otherwise(1 << FILTERS.index("E"))).alias("fails"), "n")
    return copied.unionByName(rows.where(F.col("doc_id").isNull()).select("doc_id", "part", "fails", "n"))


def label_flags(labels: DataFrame) -> DataFrame:
    """doc_id, good, toxic: one row per id; of repeated labels any 1 holds."""
    return labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*(F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))))


def _removals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = first_failures()
    places: dict[str, int] = {}
    sums = np.zeros((3, HELD_PARTS, CELLS), dtype=np.int64)  # all, good, toxic

    def held() -> pa.RecordBatch:
        names = list(places)
        arrays = [pa.FixedSizeListArray.from_arrays(pa.array(s[: len(names)].ravel()), CELLS).cast(pa.list_(pa.int64())) for s in sums]
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *arrays], names=["part", "removed", "good", "toxic"])

    for batch in batches:
        parts = batch.column(0).dictionary_encode()
        codes = np.asarray(parts.indices)
        fails, good, toxic, n = (np.asarray(batch.column(i)) for i in range(1, 5))
        for begin in range(0, len(parts.dictionary), HELD_PARTS):
            names = parts.dictionary[begin : begin + HELD_PARTS].to_pylist()
            if len(places) + sum(name not in places for name in names) > HELD_PARTS:
                yield held()
                places.clear()
                sums[:] = 0
            place = np.array([places.setdefault(name, len(places)) for name in names])
            here = (codes >= begin) & (codes < begin + HELD_PARTS)
            index = (place[codes[here] - begin] * CELLS)[:, None] + np.arange(len(ORDERS)) * (STEPS + 1) + table[fails[here]]
            for kind, counted in enumerate((n, n * good, n * toxic)):
                weights = np.repeat(counted[here].astype(np.float64), len(ORDERS))
                sums[kind] += np.bincount(index.ravel(), weights=weights, minlength=sums[kind].size).astype(np.int64).reshape(sums[kind].shape)
    if places:
        yield held()


def interactions(failed: DataFrame) -> DataFrame:
    """Report of orders and steps from rows of ``part, fails, good, toxic, n``: see :func:`audit`."""
    arrays = failed.select("part", "fails", F.col("good").cast("long"), F.col("toxic").cast("long"), "n").mapInArrow(_removals, "part string, removed array<long>, good array<long>, toxic array<long>")
    summed = arrays.select("part", F.posexplode(F.arrays_zip("removed", "good", "toxic"))).groupBy("part", "pos").agg(*(F.sum(f"col.{c}").alias(c) for c in ("removed", "good", "toxic")))
    at = F.col("pos") % (STEPS + 1)
    order = F.element_at(F.array(*map(F.lit, ORDERS)), (F.floor(F.col("pos") / (STEPS + 1)) + 1).cast("int"))
    in_order = Window.partitionBy("part", "filter_order").orderBy("step")
    of_filter = Window.partitionBy("part", "_filter")
    rest = F.sum("removed").over(in_order.rowsBetween(1, Window.unboundedFollowing))

    def when_at(step: int) -> Column:
        """What the filter removes at this step: the same in all orders that have it there first, or last."""
        return F.max(F.when(F.col("step") == step, F.col("removed"))).over(of_filter)

    steps = summed.select("part", order.alias("filter_order"), (at + 1).cast("int").alias("step"), "removed", "good", "toxic").withColumn("kept", rest).where(F.col("step") <= STEPS)
    return steps.withColumn("_filter", F.expr("substring(filter_order, step, 1)")).select(
        "part", "filter_order", "step", "kept", "removed", (when_at(1) - F.col("removed")).alias("redundant"), when_at(STEPS).alias("unique_fails"),
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), F.sum("removed").over(of_filter).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (``lang``), order of the filters and step, with zeros: documents kept after it, removed at it, failing its filter but removed before
    (redundant), failing its filter alone (unique_fails), removed documents labelled good or toxic, and the filter's removals over all orders (shapley).

    Nulls, repeated rows, empty tables and extra columns: as the module says. Very long texts are read whole; a text of blanks has no words.
    """
    failed = failures(docs)
    flagged = failed.where(F.col("doc_id").isNotNull()).join(label_flags(labels), "doc_id", "left")
    rows = flagged.unionByName(failed.where(F.col("doc_id").isNull()), allowMissingColumns=True)
    return interactions(rows.select("part", "fails", *(F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic")), "n"))

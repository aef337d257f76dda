"""Mixing sources to target weights.

Targets are shares of a total by weight, each at most a set multiple of its source (the excess goes to the others by
weight). Each source's documents are dealt by hash into blocks of about equal words. A target is met by whole passes over the
source, then by the blocks of one more pass in permuted order, then by single documents of the few next blocks (by parts of them
first, where they hold many documents), taken in permuted order while they fit, with a few swaps to come closer. A splitting tree then halves the output shards again and again; at each node the
exact block quotas of all sources are split by one multivariate-hypergeometric draw, so that every shard gets a random share
and the shares add up exactly. Each shard draws its own disjoint run of the permuted blocks and orders its documents by hash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import free_name, materialize

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (3.0, 1.0, 2.0)
TOTAL_SHARE, MOST_PASSES = 1.5, 2.0
#: Words of a block, about, and most blocks of a source, whose order one task decides (larger sources get larger blocks, and their edge is parted further).
BLOCK_WORDS, MOST_BLOCKS = 20_000, 4096
#: Blocks behind the last whole one from which single documents fill what is missing.
EDGE_BLOCKS = 8
#: Documents of a source that one task fits, about; where the edge blocks hold more, they are parted first.
EDGE_ROWS = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, total_share: float = TOTAL_SHARE, most: float = MOST_PASSES) -> DataFrame:
    """source, source_size and target from (source, source_size). One row per source: a small table, ordered in one task."""
    everyone = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    df = sizes.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    # Sources reach their cap in the order of cap over weight; the level of the others is the first that none of them exceeds.
    df = df.withColumn("ratio", F.col("cap") / F.col("weight"))
    before = W.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    df = df.withColumn("total", total_share * F.sum("source_size").over(everyone)).withColumn("weights", F.sum("weight").over(everyone))
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    df = df.withColumn("level", level).withColumn("capped", F.row_number().over(W.orderBy("ratio", F.col("source").asc_nulls_last())))
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("capped", "level"))).over(everyone)
    df = df.withColumn("level", first.getField("level"))
    return df.select("source", F.col("source_size").cast("long"), F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))


def split_quotas(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """shards x sources: the quotas split down a binary tree of shards by multivariate-hypergeometric draws."""
    if shards == 1:
        return quotas[None, :]
    left = shards // 2
    drawn = rng.multivariate_hypergeometric(quotas, int(quotas.sum()) * left // shards, method="marginals") if len(quotas) else quotas
    return np.concatenate([split_quotas(drawn, left, rng), split_quotas(quotas - drawn, shards - left, rng)])


#: Swaps that may follow, each of a taken document for a longer one that brings the sum closer to the target.
SWAPS = 8


def fit(sizes: np.ndarray, room: int) -> np.ndarray:
    """Which documents, in the given order, are taken: each if it still fits; then the best swaps while any word is missing."""
    taken = np.zeros(len(sizes), dtype=bool)
    for i, size in enumerate(sizes):
        if 0 < size <= room:
            taken[i] = True
            room -= size
    for _ in range(SWAPS):
        inside, outside = np.flatnonzero(taken), np.flatnonzero(~taken)
        if room <= 0 or not len(inside) or not len(outside):
            break
        inside = inside[np.argsort(sizes[inside], kind="stable")]
        # For each document left out, the shortest taken one whose place it could fill.
        at = np.searchsorted(sizes[inside], sizes[outside] - room)
        gain = np.where(at < len(inside), sizes[outside] - sizes[inside[np.minimum(at, len(inside) - 1)]], 0)
        best = int(gain.argmax())
        if gain[best] <= 0:
            break
        taken[outside[best]], taken[inside[at[best]]] = True, False
        room -= int(gain[best])
    return taken


def _fit(pdf):
    """The documents taken from one source's edge blocks, in permuted order."""
    pdf = pdf.sort_values(["nth", "dealt", "doc_id", "uid"])
    return pdf[fit(pdf["size"].to_numpy(), int(pdf["room"].iloc[0]))][["uid"]]


class Mix:
    """The plan of a mix: ``documents`` (uid, doc_id, source, size, source_size, target, block, dealt, passes, draws) and ``draws()``."""

    def __init__(self, docs: DataFrame, shards: int = 16, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block_words: int = BLOCK_WORDS):
        self.spark, self.shards, self.seed = docs.sparkSession, shards, seed
        slim = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"), F.xxhash64(F.lit(seed), F.col(id_col)).alias("dealt"))
        # Kept, so that the numbers of rows stay the same in all later steps.
        slim = materialize(slim.withColumn("uid", F.monotonically_increasing_id()), "mixing-documents")
        sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
        targets = source_targets(sizes)
        whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
        targets = targets.withColumn("whole", whole.cast("int")).withColumn("extra", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
        blocks = F.least(F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)), F.lit(MOST_BLOCKS))
        self.targets = materialize(targets.withColumn("n_blocks", blocks), "mixing-targets")
        same = lambda a, b: a["source"].eqNullSafe(b["source"])
        # A few rows per source, far below any broadcast limit unless sources are many; then Spark joins by shuffling.
        t = self.targets
        placed = slim.join(t, same(slim, t)).drop(t["source"]).withColumn("block", F.pmod(F.xxhash64(F.lit(seed), F.lit("block"), "dealt"), "n_blocks"))
        block = placed.groupBy("source", "block", "whole", "extra").agg(F.sum("size").alias("words"))
        order = W.partitionBy("source").orderBy(F.xxhash64(F.lit(seed), F.lit("order"), "block"), "block")
        block = block.withColumn("nth", F.row_number().over(order) - 1).withColumn("until", F.sum("words").over(order.rowsBetween(W.unboundedPreceding, 0)))
        block = block.withColumn("in_extra", F.col("until") <= F.col("extra"))
        source = W.partitionBy("source")
        block = block.withColumn("n_in", F.count(F.when(F.col("in_extra"), 1)).over(source)).withColumn("room", F.col("extra") - F.sum(F.when(F.col("in_extra"), F.col("words")).otherwise(0)).over(source))
        edge = (F.col("room") > 0) & ~F.col("in_extra") & (F.col("nth") < F.col("n_in") + EDGE_BLOCKS)
        self.blocks = materialize(block.select("source", "block", "whole", "nth", "in_extra", F.when(edge, F.col("room")).alias("room")), "mixing-blocks")
        b = materialize(self._dealt(), "mixing-dealt")
        marked = placed.join(b.select(F.col("source").alias("s"), F.col("block").alias("k"), "nth", "in_extra", "room", "shards"), F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("k")), "left")
        fitted = self._fitted(marked.where("room > 0 and size > 0").select("source", "uid", "doc_id", "dealt", "size", "nth", "room")).withColumn("fits", F.lit(1))
        passes = F.col("whole") + F.coalesce(F.col("in_extra").cast("int"), F.lit(0)) + F.coalesce("fits", F.lit(0))
        # The passes over a block are numbered from 0; a document of an edge block that did not fit has one less than its block.
        place = lambda shard, i: F.struct(i.alias("pass"), shard.alias("shard"), F.xxhash64(F.lit(seed), F.lit("place"), shard, i, "dealt", "uid").alias("place"))
        drawn = F.transform(F.slice(F.coalesce("shards", F.array().cast("array<int>")), F.lit(1), passes), place)
        self.documents = marked.join(fitted, "uid", "left").select("uid", "doc_id", "source", "size", "source_size", "target", "block", "dealt", passes.alias("passes"), drawn.alias("draws"))

    def _fitted(self, edge: DataFrame) -> DataFrame:
        """uid of the documents of the edge blocks that fill each source's room.

        An edge of more than EDGE_ROWS documents is dealt into parts, which are taken whole in permuted order while they fit; the few
        parts behind them are the next, smaller edge, until one task can fit it.
        """
        whole, ready, level = [], [], 0
        while True:
            rows = edge.groupBy("source").agg(F.count("*").alias("rows")).where(F.col("rows") > EDGE_ROWS)
            rows = rows.select(F.col("source").alias("s"), F.least(F.ceil(16 * F.col("rows") / EDGE_ROWS), F.lit(MOST_BLOCKS)).alias("parts"))
            if rows.isEmpty():
                break
            level += 1
            large = edge.join(rows, F.col("source").eqNullSafe(F.col("s")), "left")
            ready.append(large.where("parts is null").select(*edge.columns))
            large = large.where("parts is not null").withColumn("part", F.pmod(F.xxhash64(F.lit(self.seed), F.lit(level), "dealt", "uid"), "parts"))
            order = W.partitionBy("source").orderBy(F.xxhash64(F.lit(self.seed), F.lit(level), "part"), "part")
            part = large.groupBy("source", "part", "room").agg(F.sum("size").alias("words")).withColumn("place", F.row_number().over(order))
            part = part.withColumn("fits", F.sum("words").over(order.rowsBetween(W.unboundedPreceding, 0)) <= F.col("room"))
            source = W.partitionBy("source")
            part = part.withColumn("n_fit", F.count(F.when(F.col("fits"), 1)).over(source)).withColumn("left", F.col("room") - F.coalesce(F.sum(F.when(F.col("fits"), F.col("words"))).over(source), F.lit(0)))
            part = part.where(F.col("fits") | ((F.col("left") > 0) & (F.col("place") <= F.col("n_fit") + EDGE_BLOCKS)))
            part = part.select(F.col("source").alias("t"), F.col("part").alias("u"), "fits", "left", "place")
            dealt = materialize(large.join(part, F.col("source").eqNullSafe(F.col("t")) & (F.col("part") == F.col("u"))).select("source", "uid", "doc_id", "dealt", "size", "fits", "left", "place"), "mixing-edge")
            whole.append(dealt.where("fits").select("uid"))
            edge = dealt.where("not fits").select("source", "uid", "doc_id", "dealt", "size", F.col("place").alias("nth"), F.col("left").alias("room"))
        for more in ready:
            edge = edge.unionByName(more)
        fitted = edge.groupBy("source").applyInPandas(_fit, "uid long")
        for more in whole:
            fitted = fitted.unionByName(more)
        return fitted

    def quotas(self) -> DataFrame:
        """(source, shard, low, high): which of a source's drawn blocks, counted over all passes, go to which shard."""
        # One row per source: its number of drawn blocks.
        rows = self.blocks.groupBy("source").agg(F.sum(F.col("whole") + F.when(F.col("in_extra") | (F.col("room") > 0), 1).otherwise(0)).alias("draws")).collect()
        rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
        split = split_quotas(np.array([r["draws"] for r in rows], dtype=np.int64), self.shards, np.random.default_rng(self.seed))
        ends = split.cumsum(axis=0) if len(rows) else split
        out = [(r["source"], s, int(ends[s, i] - split[s, i]), int(ends[s, i])) for i, r in enumerate(rows) for s in range(self.shards) if split[s, i]]
        return self.spark.createDataFrame(out, "source string, shard int, low long, high long")

    def _dealt(self) -> DataFrame:
        """The blocks, each with the shards of its passes in order."""
        n = W.partitionBy("source")
        drawn = self.blocks.withColumn("n", F.count("*").over(n)).select("source", "block", F.posexplode(F.sequence(F.lit(0), F.col("whole"))).alias("pass", "_"), "whole", "nth", "n", "in_extra", "room")
        drawn = drawn.where((F.col("pass") < F.col("whole")) | F.col("in_extra") | (F.col("room") > 0)).withColumn("rank", F.col("pass") * F.col("n") + F.col("nth"))
        q = self.quotas().withColumnRenamed("source", "q")
        dealt = drawn.join(q, F.col("source").eqNullSafe(F.col("q")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))).select(F.col("source").alias("s"), F.col("block").alias("k"), "pass", "shard")
        dealt = dealt.groupBy("s", "k").agg(F.array_sort(F.collect_list(F.struct("pass", "shard"))).getField("shard").alias("shards"))
        return self.blocks.join(dealt, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("k")), "left").drop("s", "k")

    def draws(self) -> DataFrame:
        """One row per document and pass: uid, doc_id, source, size, pass, shard, position key within the shard."""
        return self.documents.select("uid", "doc_id", "source", "size", F.inline("draws"))


def mixed_documents(docs: DataFrame, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents of the mix, a row for each draw, with the columns of ``docs``; rows lie by shard and by place within it.

    Null texts have size 0 and ride with their block; repeated rows are rows of their own; very long texts are taken whole; no
    rows give no rows.
    """
    row, shard, place = (free_name(docs, c) for c in ("row", "shard", "place"))
    keyed = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "mixing-input")
    plan = Mix(keyed, seed=seed, id_col=row, text_col=text_col, source_col=source_col)
    draws = plan.draws().select(F.col("doc_id").alias(row), F.col("shard").alias(shard), F.col("place").alias(place))
    return keyed.join(draws, row).orderBy(shard, place, row).drop(row, shard, place)


def report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken, passes and draws (pass, shard and place in the shard of each) of every document.

    Null text has size 0 and is never short of its target; null is a source of its own, the last. Rows that share a doc_id are
    taken each for itself (they share a block, and ties go by row). An empty table gives no rows.
    """
    passes = F.size("draws")
    return Mix(docs, **options).documents.select("doc_id", "size", "source_size", "target", (F.col("size") * passes).cast("long").alias("taken"), passes.alias("passes"), "draws")

"""Shards of near-equal bytes by a minimax contiguous partition, in DataFrame functions only.

Documents with equal texts form one atomic group, ordered by the SHA-256 of the text. The smallest shard capacity that
lets a greedy walk over the ordered groups end within the given number of shards is found by binary search, and the
shards are cut where that walk cuts.

The driver never holds the list of groups. It holds a summary: sums of sizes by the first hex digits of the key. A summary
bounds where each cut can fall for any capacity still in question, so only those few stretches are summed again by longer
prefixes, until every cut falls between single groups. The summary stays at some ten thousand rows at any input size.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize

#: Hex digits of the first summary (4096 sums) and digits added where cuts may fall.
FIRST_DIGITS, MORE_DIGITS, KEY_DIGITS = 3, 2, 64
#: Rows that share one numbering task, about.
ROWS_A_NUMBERING = 50_000
#: The key of a null text; no text has it as its SHA-256.
NULL_KEY = "0" * KEY_DIGITS


def text_key(text: Column) -> Column:
    return F.coalesce(F.sha2(text, 256), F.lit(NULL_KEY))


def greedy_ends(ends: list[int], capacity: int, start: int, most: int) -> list[int] | None:
    """Ends (as running sums) of at most ``most`` shards filled in order up to ``capacity``; None if they don't suffice."""
    cuts: list[int] = []
    while start < ends[-1]:
        k = bisect_right(ends, start + capacity) - 1
        if len(cuts) == most or k < 0 or ends[k] <= start:
            return None
        cuts.append(start := ends[k])
    return cuts


def smallest_capacity(sizes: list[int], shards: int) -> int:
    """Binary search over the capacity, checking each greedily."""
    ends = list(accumulate(sizes))
    low, high = max(max(sizes), -(-ends[-1] // shards)), ends[-1]
    while low < high:
        middle = (low + high) // 2
        if greedy_ends(ends, middle, 0, shards) is None:
            low = middle + 1
        else:
            high = middle
    return low


def _sums(groups: DataFrame, digits: int, prefixes: list[str] | None = None) -> list[tuple[str, int, int, int]]:
    """(prefix, bytes, groups, largest group) by the first ``digits`` digits, under ``prefixes`` alone if given."""
    if prefixes is not None:
        groups = groups.where(F.substring("key", 1, len(prefixes[0])).isin(prefixes))
    by = F.substring("key", 1, digits).alias("prefix")
    return sorted(tuple(r) for r in groups.groupBy(by).agg(F.sum("size"), F.count("*"), F.max("size")).collect())


def contiguous_cuts(groups: DataFrame, shards: int) -> list[str]:
    """First keys (or their prefixes) of shards 1, 2, ... under the smallest feasible capacity.

    ``groups`` has key (hex string, distinct) and size (long, over 0). Fewer cuts than ``shards - 1`` leave the last shards empty.
    """
    summary = _sums(groups, FIRST_DIGITS)
    if not summary or shards < 2:
        return []
    while True:
        sizes = [s[1] for s in summary]
        ends = list(accumulate(sizes))
        least = max(max(s[3] for s in summary), -(-ends[-1] // shards))
        most = smallest_capacity(sizes, shards)  # whole stretches kept together can only need more
        # The cut after shard k lies between the shortest walk under the least capacity and k times the largest.
        unsure: dict[int, list[str]] = {}
        low = high = 0
        for _ in range(shards):
            high = min(ends[-1], high + most)
            k = bisect_right(ends, low + least) - 1
            low = max(low, ends[k] if k >= 0 else 0)
            for i in range(bisect_right(ends, low), len(ends)):
                if ends[i] - sizes[i] > high:
                    break
                if summary[i][2] > 1 and len(summary[i][0]) < KEY_DIGITS:
                    unsure.setdefault(len(summary[i][0]), []).append(summary[i][0])
        if not unsure:
            break
        finer: dict[str, tuple[str, int, int, int]] = {s[0]: s for s in summary}
        for digits, prefixes in unsure.items():
            chosen = sorted(set(prefixes))
            for p in chosen:
                del finer[p]
            finer |= {s[0]: s for s in _sums(groups, digits + MORE_DIGITS, chosen)}
        summary = sorted(finer.values())
    cuts = greedy_ends(ends, most, 0, shards) or []
    first_after = dict(zip(ends, [s[0] for s in summary[1:]], strict=False))
    return [first_after[c] for c in cuts[:-1]]


def assign(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document under the law ``bytes``.

    Size is the UTF-8 length plus 1. Null texts form one group, of size 1 each, with CRC 0; equal texts always share a
    shard, however large that makes it. A group above the mean of what is left gets a shard of its own first, so that it
    does not set the capacity of the others. Rows that share a doc_id are placed each for itself. No rows: no rows.
    """
    spark = docs.sparkSession
    text = F.col(text_col)
    slim = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).alias("text_crc32"),
            text_key(text).alias("key"),
        ),
        "sharding-documents",
    )
    groups = materialize(slim.groupBy("key").agg(F.sum("size").alias("size")), "sharding-groups")
    left, alone = groups.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0], []
    # Groups above the mean shard: fewer than there are shards.
    for key, size in sorted(groups.where(F.col("size") * shards > left).collect(), key=lambda g: (-g[1], g[0])):
        if size * (shards - len(alone)) > left and len(alone) < shards - 1:
            alone.append(key)
            left -= size
    cuts = contiguous_cuts(groups.where(~F.col("key").isin(alone)) if alone else groups, shards - len(alone))
    shard = F.lit(len(alone))
    for cut in cuts:
        shard = shard + (F.col("key") >= cut).cast("int")
    for i, key in enumerate(alone):
        shard = F.when(F.col("key") == key, i).otherwise(shard)
    placed = slim.withColumn("shard", shard.cast("int"))
    # Slots: number small parts of each shard by themselves, then shift each part by what stands before it.
    parts = max(1, -(-slim.count() // ROWS_A_NUMBERING))
    placed = placed.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)))
    before = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = before.select("shard", "part", (F.sum("n").over(W.partitionBy("shard").orderBy("part")) - F.col("n")).alias("before"))
    return (
        placed.withColumn("nth", F.row_number().over(W.partitionBy("shard", "part").orderBy("doc_id", "key")))
        .join(before, ["shard", "part"])
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("nth") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    )


def write_shards(docs: DataFrame, path: str, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write whole documents under ``path/shard=N`` in slot order, and return the assignment."""
    placed = materialize(assign(docs, shards, id_col, text_col), "sharding-assigned")
    body = docs.withColumn("_key", F.struct(F.col(id_col).alias("doc_id"), F.coalesce(F.crc32(F.col(text_col).cast("binary")), F.lit(0)).alias("text_crc32")))
    chosen = placed.groupBy(F.struct("doc_id", "text_crc32").alias("_key")).agg(F.min("shard").alias("shard"), F.min("slot").alias("slot"))
    joined = body.join(chosen, body["_key"].eqNullSafe(chosen["_key"])).drop("_key")
    joined.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return placed

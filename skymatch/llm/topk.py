"""Exact top-k search by inner product over norm-sorted vectors.

Vectors are rotated by the singular vectors of the table, so that most of an inner product lies in the first components. Each task
sorts its share of the vectors by descending length and walks down it with a block of queries, holding every query's k best
scores so far. It stops a query once length times length can't reach its k-th score; before that, the sum over the first
rotated components plus the Cauchy-Schwarz bound of the rest (product of the residual lengths) rules out most vectors, and
the others are scored in whole numbers. Bounds carry a margin far above rounding, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize, shuffle_partitions

SCALE, K, EVERY = 1024, 10, 100
#: Queries that go to all executors at a time, and vectors that are tried at a time.
QUERY_BLOCK, STEP = 4096, 1024
#: Leading rotated components that are summed before the bound is taken.
HEAD = 16


def whole_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and floor(1024 x) of every component; vectors that are null or hold null or non-finite components are left out."""
    x = F.col(vector_col)
    fine = x.isNotNull() & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < float("inf")))
    return table.where(fine & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(SCALE * e.cast("double")).cast("long")).alias("x"))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of equal width; shorter vectors are filled with zeros, which leaves inner products as they are."""
    out = np.zeros((len(column), width), dtype=np.int64)
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    if (lengths == width).all():
        return flat.reshape(len(column), width).astype(np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


def _gram(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = _matrix(batch.column(0), width).astype(np.float64)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int64()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])

    return run


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of the table, largest first: eigenvectors of the sum of all outer products."""
    sums = vectors.select("x").mapInArrow(_gram(width), "i long, row array<double>").select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    gram = np.zeros((width, width))
    for i, j, v in sums.collect():  # width x width numbers
        gram[i, j] = v
    return np.linalg.eigh((gram + gram.T) / 2)[1][:, ::-1]


_BEST = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _wide_scores(x: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Scores in numbers of any size; one that a long can't hold is an error."""
    scores = [sum(a * b for a, b in zip(row, query.tolist(), strict=True)) for row in x.tolist()]
    if any(abs(s) >= 2**63 for s in scores):
        raise OverflowError("an inner product is beyond 64 bits")
    return np.array(scores, dtype=np.int64)


class Search:
    """The k best vectors of each query of a block among the vectors shown so far."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, x: np.ndarray, turn: np.ndarray, k: int):
        self.keys, self.ids, self.x, self.turn, self.k = keys, ids, x, turn, k
        self.rotated = x.astype(np.float64) @ turn
        self.length = np.sqrt((self.rotated**2).sum(axis=1))
        self.rest = np.sqrt(np.maximum(0, (self.rotated[:, HEAD:] ** 2).sum(axis=1)))
        self.best: list[list[tuple[int, int]]] = [[] for _ in ids]
        self.least = np.full(len(ids), -np.inf)

    def show(self, keys: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        """``x``: more vectors, by descending length within a task; ``keys`` number their rows."""
        rotated = x.astype(np.float64) @ self.turn
        length = np.sqrt((rotated**2).sum(axis=1))
        rest = np.sqrt(np.maximum(0, (rotated[:, HEAD:] ** 2).sum(axis=1)))
        slack = 1e-9 * (1 + self.length * length.max(initial=0.0)) + 1e-6
        alive = np.flatnonzero(self.length * length.max(initial=0.0) + slack >= self.least)
        if not len(alive):
            return
        bound = self.rotated[alive, :HEAD] @ rotated[:, :HEAD].T + self.rest[alive, None] * rest[None, :] + slack[alive, None]
        may = bound >= self.least[alive, None]
        # Whole-number scores; floats are exact up to 2^53.
        top = float(np.abs(self.x).max(initial=0)) * float(np.abs(x).max(initial=0)) * self.x.shape[1]
        for row, q in zip(may, alive.tolist(), strict=True):
            at = np.flatnonzero(row & (keys != self.keys[q]))
            if not len(at):
                continue
            if top < 2**53:
                scores = (x[at].astype(np.float64) @ self.x[q].astype(np.float64)).astype(np.int64)
            else:
                scores = x[at] @ self.x[q] if top < 2**62 else _wide_scores(x[at], self.x[q])
            if len(at) > self.k:
                order = np.lexsort((ids[at], -scores))[: self.k]
                at, scores = at[order], scores[order]
            self.best[q] = sorted(self.best[q] + list(zip((-scores).tolist(), ids[at].tolist(), strict=True)))[: self.k]
            if len(self.best[q]) == self.k:
                self.least[q] = -self.best[q][-1][0]

    def rows(self) -> Iterator[pa.RecordBatch]:
        found = [(int(key), int(q), v, -s) for key, q, best in zip(self.keys, self.ids, self.best, strict=True) for s, v in best]
        for a in range(0, len(found), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found[a : a + 10_000], strict=True)], schema=_BEST)


def _search(queries, width: int, k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(*queries.value, k)
        for batch in batches:
            for a in range(0, batch.num_rows, STEP):
                piece = batch.slice(a, STEP)
                search.show(*(piece.column(i).to_numpy(zero_copy_only=False) for i in range(2)), _matrix(piece.column(2), width))
        yield from search.rows()

    return run


def top_k(table: DataFrame, k: int = K, every: int = EVERY, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score: for each row whose id is divisible by ``every``, the k best others by score, then id.

    Ties and zero vectors are ranked like any. Rows are told apart by where they lie, not by their id: of repeated rows each is a query of its own, with
    ranks of its own, and finds the others. Vectors of unequal length are compared as if filled up with zeros. A score beyond 64 bits is an error. Extra
    columns are not read. An empty table, or one without whole vectors, gives no rows.
    """
    spark = table.sparkSession
    vectors = whole_vectors(table, id_col, vector_col)
    norm = F.aggregate("x", F.lit(0.0), lambda a, e: a + e.cast("double") * e.cast("double"))
    # Dealt evenly, then sorted by descending length in each task.
    kept = materialize(vectors.withColumns({"norm": norm, "key": F.monotonically_increasing_id()}), "topk-vectors")
    width = kept.agg(F.coalesce(F.max(F.size("x")), F.lit(0))).first()[0]
    if not width:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    turn = rotation(kept, width)
    asked = kept.where(F.col("vec_id") % every == 0)
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    dealt = kept.repartition(shuffle_partitions(spark), F.xxhash64("key")).sortWithinPartitions(F.desc("norm")).select("key", "vec_id", "x")
    found = None
    for i in range(blocks):
        # Blocks of the query set, of bounded size, one after the other against all rows.
        block = asked.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == i).select("key", "vec_id", "x").toArrow()
        queries = (block.column("key").to_numpy(), block.column("vec_id").to_numpy(), np.concatenate([_matrix(c, width) for c in block.column("x").chunks] or [np.zeros((0, width), dtype=np.int64)]), turn)
        part = dealt.mapInArrow(_search(spark.sparkContext.broadcast(queries), width, k), "query_row long, query_id long, vec_id long, score long")
        found = part if found is None else found.unionByName(part)
    order = W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

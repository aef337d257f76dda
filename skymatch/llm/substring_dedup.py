"""Substring deduplication: words covered by a window of 35 words that also stands elsewhere are removed.

Every window of every document gets a 64-bit Rabin-Karp hash and 32 bits of a second one with another base. Documents are dealt
into chunks of a few megabytes by hash of their content. Each chunk sends its distinct window hashes, sorted and as byte planes of
their differences (about 10 bytes a window), to buckets by leading bits; a window that stands in thousands of places reaches its
bucket once per chunk at most. A bucket counts its hashes over all chunks and answers each chunk with one bit per hash. The
chunk then merges its repeated windows into maximal intervals and cuts them out. Bucket and chunk counts follow the text's
size, and a sender writes to 2^FAN_BITS buckets at most: where more are needed, relays merge the messages of some thousand senders
to one bucket and part them again, so the number of messages grows in proportion to the text.

Windows count as equal if all 96 bits are: two different ones among n do so with probability n^2 / 2^97 in all (1e-3 at 1.5e13
windows, about 100 TB), words being told apart by 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, mix, shuffle_partitions, space_words

WINDOW = 35
CHUNK_BYTES = 6 << 20
#: Windows of a bucket, about.
BUCKET_WINDOWS = 1 << 20
_BASE = 0x9E3779B97F4A7C55
_SECOND = 0xC2B2AE3D27D4EB4F
#: log2 of the buckets that one sender writes to, at most, and messages that one relay merges, about.
FAN_BITS, RELAYED = 12, 4096
#: Chunks of a task, about.
TASK_CHUNKS = 8


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, np.uint64(base), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def window_hashes(words: np.ndarray, width: int, base: int = _BASE) -> np.ndarray:
    """Rabin-Karp hash of each window of ``width`` word hashes, by sums of word times power (mod 2^64), moved to a common power."""
    if len(words) < width:
        return np.empty(0, dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(words * _powers(base, len(words))[:-1], dtype=np.uint64)])
    return mix((sums[width:] - sums[:-width]) * _powers(pow(base, -1, 1 << 64), len(words) - width))


def distinct_pairs(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of hashes in order, which of them each given pair is, and how often each was given."""
    order = np.argsort(one, kind="stable")
    a, b = one[order], two[order]
    if ((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any():  # different windows that share the first hash
        order = np.lexsort((two, one))
        a, b = one[order], two[order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    which = np.empty(len(a), dtype=np.int64)
    which[order] = np.cumsum(new) - 1
    return a[new], b[new], which, np.diff(np.append(np.flatnonzero(new), len(a)))


class Chunk:
    """The windows of some documents: for each its document, its first word and its hashes."""

    def __init__(self, texts: list[str | None], width: int):
        of = WordHashes()
        self.words = [space_words(t) for t in texts]
        lengths = np.array([len(w) for w in self.words], dtype=np.int64)
        flat = np.concatenate([of.of(w) for w in self.words]) if texts else np.empty(0, dtype=np.uint64)
        self.first = np.concatenate([[0], np.cumsum(lengths)])[:-1].astype(np.int64)
        whole = np.zeros(len(flat), dtype=bool)  # windows that end inside their document
        for a, n in zip(self.first.tolist(), lengths.tolist(), strict=True):
            whole[a : a + max(0, n - width + 1)] = True
        self.starts = np.flatnonzero(whole)
        self.size = len(flat)
        one, two = window_hashes(flat, width), (window_hashes(mix(flat), width, _SECOND) >> np.uint64(32)).astype(np.uint32)
        self.one, self.two, self.which, self.times = distinct_pairs(one[self.starts], two[self.starts]) if len(self.starts) else distinct_pairs(one[:0], two[:0])


def pack(sorted_hashes: np.ndarray) -> bytes:
    """Byte planes of the differences of sorted hashes; the planes of zeros cost next to nothing once compressed."""
    steps = np.diff(sorted_hashes, prepend=np.uint64(0))
    return steps.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(planes: bytes) -> np.ndarray:
    n = len(planes) // 8
    steps = np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(8, n).T).view("<u8").reshape(-1)
    return np.cumsum(steps, dtype=np.uint64)


_SENT = pa.schema([("bucket", pa.int64()), ("sender", pa.int64()), ("one", pa.binary()), ("two", pa.binary()), ("again", pa.binary())])
_SENT_SQL = "bucket bigint, sender bigint, one binary, two binary, again binary"
_BACK = pa.schema([("sender", pa.int64()), ("bucket", pa.int64()), ("repeated", pa.binary())])
_BACK_SQL = "sender bigint, bucket bigint, repeated binary"


def _buckets(one: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of the stretches of sorted hashes that share their leading bits."""
    bucket = (one >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(one), dtype=np.int64)
    names, at = np.unique(bucket, return_index=True)
    return list(zip(names.tolist(), at.tolist(), [*at[1:].tolist(), len(one)], strict=True))


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(bits: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=n).astype(bool)


def _messages(sender: int, one: np.ndarray, two: np.ndarray, again: np.ndarray, bits: int) -> pa.Table:
    rows = [(b, sender, pack(one[i:j]), two[i:j].astype("<u4").tobytes(), _bits(again[i:j])) for b, i, j in _buckets(one, bits)]
    return pa.table([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), _SENT, strict=True)], schema=_SENT) if rows else _SENT.empty_table()


def _send(width: int, bits: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        chunk = Chunk(table.column("text").to_pylist(), width)
        return _messages(key[0].as_py(), chunk.one, chunk.two, chunk.times > 1, bits)

    return run


class Received:
    """Messages put together: distinct hashes, those that stand in several places, and the way back."""

    def __init__(self, table: pa.Table):
        self.senders, self.buckets = table.column("sender").to_pylist(), table.column("bucket").to_pylist()
        parts = [unpack(x) for x in table.column("one").to_pylist()]
        self.sizes = [len(p) for p in parts]
        none = np.zeros(0, dtype=np.uint64)
        two = np.frombuffer(b"".join(table.column("two").to_pylist()), dtype="<u4")
        again = np.concatenate([none.astype(bool), *(_flags(x, n) for x, n in zip(table.column("again").to_pylist(), self.sizes, strict=True))])
        self.one, self.two, self.which, times = distinct_pairs(np.concatenate([none, *parts]), two)
        self.again = times > 1
        self.again[self.which[again]] = True

    def answers(self, repeated: np.ndarray) -> pa.Table:
        each, ends = repeated[self.which], np.cumsum(self.sizes).tolist()
        bits = [_bits(each[j - n : j]) for n, j in zip(self.sizes, ends, strict=True)]
        return pa.table([pa.array(self.senders, pa.int64()), pa.array(self.buckets, pa.int64()), pa.array(bits, pa.binary())], schema=_BACK)


def _count(table: pa.Table) -> pa.Table:
    received = Received(table)
    return received.answers(received.again)


def _told(one: np.ndarray, answers: pa.Table, bits: int) -> np.ndarray:
    """Which of the sorted hashes are repeated, from the answers of all buckets."""
    told = dict(zip(answers.column("bucket").to_pylist(), answers.column("repeated").to_pylist(), strict=True))
    return np.concatenate([np.zeros(0, dtype=bool), *(_flags(told[b], j - i) for b, i, j in _buckets(one, bits))])


def _relay(bits: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        received = Received(table)
        return _messages(key[0].as_py(), received.one, received.two, received.again, bits)

    return run


def _relay_back(bits: int):
    def run(messages: pa.Table, answers: pa.Table) -> pa.Table:
        received = Received(messages)
        return received.answers(_told(received.one, answers, bits))

    return run


def exchange(sent: DataFrame, senders: int, bits: int, all_bits: int) -> DataFrame:
    """Answers (sender, bucket, repeated) to messages by ``bits`` leading bits, when buckets are told apart by ``all_bits``."""
    if bits == all_bits:
        return sent.groupBy("bucket").applyInArrow(_count, _BACK_SQL)
    further, relays = min(all_bits, bits + FAN_BITS), max(1, -(-senders // RELAYED))
    # The messages of a bucket are dealt to several relays; a relay then sends for all of them.
    dealt = sent.withColumn("relay", F.col("bucket") * relays + F.pmod("sender", F.lit(relays)))
    answers = exchange(dealt.groupBy("relay").applyInArrow(_relay(further), _SENT_SQL), relays, further, all_bits)
    return dealt.groupBy("relay").cogroup(answers.groupBy("sender")).applyInArrow(_relay_back(further), _BACK_SQL)


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("begins", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("kept", pa.binary())])
_RESULT_SQL = "doc_id bigint, n_words bigint, n_removed bigint, begins array<bigint>, ends array<bigint>, kept binary"


def _cut(width: int, bits: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = Chunk(docs.column("text").to_pylist(), width)
        starts = chunk.starts[_told(chunk.one, answers, bits)[chunk.which]] if len(chunk.starts) else chunk.starts
        # A word is covered where more windows have begun than ended.
        edge = np.zeros(chunk.size + 1, dtype=np.int32)
        edge[starts] += 1
        edge[starts + width] -= 1
        covered = np.cumsum(edge)[:-1] > 0
        out = []
        for doc_id, words, a in zip(docs.column("doc_id").to_pylist(), chunk.words, chunk.first.tolist(), strict=True):
            gone = covered[a : a + len(words)]
            turns = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
            kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g) if len(turns) else b" ".join(words)
            out.append((doc_id, len(words), int(gone.sum()), turns[::2], turns[1::2], kept))
        return pa.table([pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True), _RESULT, strict=True)], schema=_RESULT) if out else _RESULT.empty_table()

    return run


def remove_repeats(docs: DataFrame, width: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, removed intervals of words [begins, ends), and the kept words joined by spaces.

    Null text has no words. Texts shorter than a window lose nothing; very long ones are cut whole. Rows that share a doc_id, and
    repeated rows, count as documents of their own, so that repeated rows of 35 words or more lose their words. Other columns are
    ignored, whatever their names. Empty tables give no rows.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    chunks = max(1, -(-size // CHUNK_BYTES))
    bits = max(0, int(size / 6 / BUCKET_WINDOWS).bit_length())
    fan = min(bits, FAN_BITS)
    # The partition read parts rows that are repeated often.
    chunk = F.pmod(F.xxhash64(id_col, text_col, F.spark_partition_id()), F.lit(chunks))
    dealt = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), chunk.alias("chunk"))
    dealt = dealt.repartition(max(shuffle_partitions(docs.sparkSession), -(-chunks // TASK_CHUNKS)), "chunk")
    sent = dealt.groupBy("chunk").applyInArrow(_send(width, fan), _SENT_SQL)
    back = exchange(sent, chunks, fan, bits)
    cut = dealt.groupBy("chunk").cogroup(back.groupBy("sender")).applyInArrow(_cut(width, fan), _RESULT_SQL)
    return cut.withColumn("kept", F.col("kept").cast("string"))


def report(docs: DataFrame, width: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, and the SHA-256 of the kept words."""
    return remove_repeats(docs, width, id_col, text_col).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))

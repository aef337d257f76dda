"""Token files: documents as token ids under a static range asymmetric numeral system (rANS).

A token file is a folder. ``tables`` holds the shared frequency table, made from the counts of all ids in all documents.
``ranges`` holds the number of ids before each range of documents, and
``blocks`` independent blocks in ascending doc_id order: each has its range, the position of its first id there, its
documents with their lengths, and its ids as one rANS stream of interleaved lanes. Every block carries checkpoints (the
lanes' states and the place in the stream at regular steps), from which decoding can start anywhere, and two checksums, of the stream
and of the ids. Any reader needs the table and the block alone, so blocks are decoded in parallel.
"""

from __future__ import annotations

import gc
import json
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import batches_of, materialize, new_path, release, rows_of, shuffle_partitions

VERSION = 2
#: log2 of the sum of all table frequencies; states lie in [2^31, 2^63) and move 32 bits at a time.
SCALE_BITS = 20
LANES, CHECKPOINT_ROWS = 1024, 128
#: Ids of a block, about: a block ends with the document that reaches it.
BLOCK_IDS = 524_288
#: Ids of a range of documents, which one task encodes, about.
RANGE_IDS = 32 << 20
END_ID = 1
_LOW = np.uint64(1 << 31)
_32, _BITS, _MASK = np.uint64(32), np.uint64(SCALE_BITS), np.uint64((1 << SCALE_BITS) - 1)


class Table:
    """Frequencies scaled to 2^SCALE_BITS, every counted symbol keeping at least 1."""

    def __init__(self, symbols: np.ndarray, freqs: np.ndarray):
        self.symbols, self.freqs = symbols.astype(np.int64), freqs.astype(np.int64)
        top = int(self.symbols.max()) + 1 if len(symbols) else 1
        self.f, self.c = np.zeros(top, dtype=np.uint64), np.zeros(top, dtype=np.uint64)
        self.f[self.symbols] = self.freqs
        self.c[self.symbols] = np.cumsum(self.freqs) - self.freqs
        self.slot = np.repeat(self.symbols, self.freqs).astype(np.uint32)

    @classmethod
    def of_counts(cls, symbols: np.ndarray, counts: np.ndarray) -> Table:
        if len(symbols) > 1 << SCALE_BITS:
            raise ValueError(f"{len(symbols)} symbols don't fit a table of 2^{SCALE_BITS}")
        order = np.argsort(symbols)
        symbols, counts = symbols[order], counts[order].astype(np.float64)
        if not len(symbols):
            return cls(symbols, counts)
        spare = (1 << SCALE_BITS) - len(symbols)
        freqs = 1 + np.floor(counts / counts.sum() * spare).astype(np.int64)
        freqs[np.argmax(freqs)] += (1 << SCALE_BITS) - freqs.sum()
        return cls(symbols, freqs)


def encode(ids: np.ndarray, table: Table) -> dict:
    """One block's stream: 32-bit words, final states, checkpoints (row, words before it, states)."""
    n = len(ids)
    rows = -(-n // LANES)
    x = np.full(LANES, _LOW, dtype=np.uint64)
    f, c = table.f[ids], table.c[ids]
    chunks, emitted, marks = [], 0, []
    for r in range(rows - 1, -1, -1):
        a, b = r * LANES, min(n, (r + 1) * LANES)
        fr, xr = f[a:b], x[: b - a]
        full = xr >= (fr << np.uint64(63 - SCALE_BITS))
        out = (xr[full] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        chunks.append(out)
        emitted += len(out)
        xr = np.where(full, xr >> _32, xr)
        q, rest = np.divmod(xr, fr)
        x[: b - a] = (q << _BITS) + rest + c[a:b]
        if r % CHECKPOINT_ROWS == 0 and r:
            marks.append((r, emitted, x.copy()))
    words = np.concatenate(chunks[::-1]) if chunks else np.empty(0, dtype=np.uint32)
    marks = [(r, emitted - at, states) for r, at, states in reversed(marks)]
    return {"n": n, "words": words.astype("<u4").tobytes(), "states": x.astype("<u8").tobytes(), "mark_rows": [m[0] for m in marks], "mark_words": [m[1] for m in marks], "mark_states": [m[2].astype("<u8").tobytes() for m in marks]}


def decode(n: int, words: bytes, states: bytes, table: Table, row: int = 0, at: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids from ``row`` (of LANES ids each) to ``stop`` of a block of ``n`` ids; ``states`` and ``at`` are those of the checkpoint."""
    stream, x = np.frombuffer(words, dtype="<u4"), np.frombuffer(states, dtype="<u8").astype(np.uint64)
    rows = -(-n // LANES) if stop is None else stop
    out = np.empty(max(0, min(n, rows * LANES) - row * LANES), dtype=np.uint32)
    for r in range(row, rows):
        a, b = r * LANES, min(n, (r + 1) * LANES)
        xr = x[: b - a]
        slot = xr & _MASK
        s = table.slot[slot]
        out[a - row * LANES : b - row * LANES] = s
        xr = table.f[s] * (xr >> _BITS) + slot - table.c[s]
        low = np.flatnonzero(xr < _LOW)
        if len(low):
            xr[low] = (xr[low] << _32) | stream[at : at + len(low)].astype(np.uint64)
            at += len(low)
        x[: b - a] = xr
    return out


# --- tokens -----------------------------------------------------------------------------------------------------

_TOKENIZERS: dict[int, Encoder] = {}

_PUNCTUATION = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

# The parts of a tokenizer file for which a text's ids are those of its words, in order.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_WORD_END = "</w>"


def splits_at_spaces(spec: dict) -> bool:
    """Whether the tokenizer drops white space, never joins text across it, parts letters from the rest and lower-cases."""
    normalizer, pre, model = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    steps = pre.get("pretokenizers") or []
    return (
        normalizer.get("normalizers") == _NORMALIZERS
        and [x.get("type") for x in steps] == ["Split", "ByteLevel"]
        and (steps[0].get("pattern"), steps[0].get("behavior"), steps[0].get("invert")) == ({"Regex": _SPLIT}, "Removed", True)
        and (steps[1].get("add_prefix_space"), steps[1].get("use_regex")) == (False, False)
        and (model.get("type"), model.get("end_of_word_suffix"), model.get("dropout")) == ("BPE", _WORD_END, None)
        and not any(c.isspace() for t in spec.get("added_tokens") or [] for c in t["content"])
    )


class Encoder:
    """Ids of whole texts by the tokenizers library, each distinct word encoded once while it is remembered.

    Where the tokenizer's file allows it (:func:`splits_at_spaces`), a text's ids are those of its words, and those of a word of Latin
    letters with ASCII punctuation behind it are those of the letters and of the punctuation. With any other file whole
    texts are encoded. Words are remembered in two generations of ``limit`` words, so that rare ones are forgotten.
    """

    def __init__(self, source: str, limit: int = 900_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_str(source), limit
        self.by_words = splits_at_spaces(json.loads(source))
        vocabulary = self.tokenizer.get_vocab()
        self.kind = "<u2" if max(vocabulary.values(), default=0) < 1 << 16 else "<u4"
        self.end = np.array([END_ID], dtype=self.kind).tobytes()
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith(_WORD_END)]] = True
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    @staticmethod
    def letters(core: bytes) -> bytes | None:
        """The form by which Latin letters are remembered; None for anything else."""
        if core.isalpha():  # ASCII letters alone
            return core.lower()
        text = core.decode()
        # The lower form of one letter ends in a combining mark.
        return core if text.isalpha() and text.lower().isalpha() and max(text) < "\u0250" else None

    def _each(self, parts: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([p.decode() for p in parts], add_special_tokens=False)
        return [np.array(e.ids, dtype=self.kind).tobytes() for e in found]

    def _joined(self, parts: list[bytes]) -> list[bytes]:
        """Ids of letters or punctuation alone, encoded as one text and parted behind each token that ends a word."""
        if not parts:
            return []
        ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(parts).decode()], add_special_tokens=False)[0].ids, dtype=self.kind)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(parts) or ends[-1] != len(ids):
            return self._each(parts)
        raw, at = ids.tobytes(), (ends * ids.itemsize).tolist()
        return [raw[i:j] for i, j in zip([0, *at], at, strict=False)]

    def _learn(self, fresh: set[bytes]) -> None:
        """Remember ``fresh`` words."""
        young, old, letters = self.young, self.old, self.letters
        words, cores, tails, odd = [], [], [], []
        for word in fresh:
            bare = word.rstrip(_PUNCTUATION)
            core = letters(bare)
            if core is None:
                odd.append(word)
            else:
                words.append(word)
                cores.append(core)
                tails.append(word[len(bare) :])
        parts = set(cores).union(tails).difference(young)
        parts.discard(b"")
        young.update({p: old[p] for p in parts if p in old})
        plain = list(parts.difference(young))
        young.update(zip(plain, self._joined(plain), strict=True))
        young.update(zip(odd, self._each(odd), strict=True))
        for word, core, tail in zip(words, cores, tails, strict=True):
            young[word] = young[core] + young[tail] if tail else young[core]

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """Ids of every UTF-8 text as little-endian integers of type ``kind``, END_ID appended."""
        if not self.by_words:
            return [ids + self.end for ids in self._each([t or b"" for t in texts])]
        split = [t.split() if t else [] for t in texts]
        fresh = set().union(*split).difference(self.young)
        for word in [w for w in fresh if w in self.old]:
            self.young[word] = self.old[word]
        self._learn(fresh.difference(self.young))
        out = [b"".join(map(self.young.__getitem__, words)) + self.end for words in split]
        if len(self.young) > self.limit:
            self.young, self.old = {}, self.young
        return out


def _encoder(shared) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if shared.id not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[shared.id] = Encoder(shared.value)
    return _TOKENIZERS[shared.id]


class _Shared:
    """A broadcast value with an id that Python workers can remember results by."""

    def __init__(self, spark: SparkSession, value):
        self.broadcast = spark.sparkContext.broadcast(value)
        self.id = zlib.crc32(value.encode())

    @property
    def value(self):
        return self.broadcast.value


#: A row per document; the last row of every task holds the counts of its ids instead.
_IDS = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("ids", pa.binary()), ("symbols", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
_IDS_SQL = "doc_id bigint, row bigint, ids binary, symbols array<bigint>, counts array<bigint>"


def _tokenize(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        narrow = encoder.kind == "<u2"

        def rows():
            total = np.zeros(len(encoder.last), dtype=np.int64)
            for batch in batches:
                for a in range(0, batch.num_rows, 256):
                    piece = batch.slice(a, 256)
                    doc_ids, numbers, texts = (piece.column(piece.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "row", "text"))
                    found = encoder.encode(texts)
                    total += np.bincount(np.frombuffer(b"".join(found), dtype=encoder.kind), minlength=len(total))
                    for doc_id, number, ids in zip(doc_ids, numbers, found, strict=True):
                        yield doc_id, number, (b"\x02" if narrow else b"\x04") + ids, None, None
            at = np.flatnonzero(total)
            yield None, None, None, at, total[at]

        # Words and ids make no reference cycles, and looking for them costs a sixth of the time.
        gc.disable()
        try:
            yield from batches_of(rows(), _IDS)
        finally:
            gc.enable()

    return run


def _wide(ids: bytes) -> np.ndarray:
    """Ids of 16 bits behind a byte 2, or of 32 bits behind a byte 4."""
    return np.frombuffer(ids, dtype="<u2" if ids[0] == 2 else "<u4", offset=1).astype(np.uint32)


_FILE = pa.schema(
    [("part", pa.int32()), ("block", pa.int64()), ("start", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64()))]
    + [("words", pa.binary()), ("states", pa.binary()), ("mark_rows", pa.list_(pa.int64())), ("mark_words", pa.list_(pa.int64())), ("mark_states", pa.list_(pa.binary())), ("words_crc32", pa.int64()), ("ids_crc32", pa.int64())]
)
_FILE_SQL = "part int, block bigint, start bigint, n_ids bigint, doc_ids array<bigint>, lengths array<bigint>, words binary, states binary, mark_rows array<bigint>, mark_words array<bigint>, mark_states array<binary>, words_crc32 bigint, ids_crc32 bigint"


def _encode_blocks(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(*shared.value)

        def packed(part, block, start, docs, parts):
            ids = np.concatenate(parts)
            e = encode(ids, table)
            return part, block, start, len(ids), docs, [len(p) for p in parts], e["words"], e["states"], e["mark_rows"], e["mark_words"], e["mark_states"], zlib.crc32(e["words"]), zlib.crc32(ids.astype("<u4").tobytes())

        def rows():
            part, block, start, held = None, 0, 0, 0
            docs, parts = [], []
            for part, doc_id, raw in rows_of(batches, "part", "doc_id", "ids"):  # noqa: B007
                docs.append(doc_id)
                parts.append(_wide(raw))
                held += len(parts[-1])
                if held >= BLOCK_IDS:
                    yield packed(part, block, start, docs, parts)
                    block, start, held = block + 1, start + held, 0
                    docs, parts = [], []
            if docs:
                yield packed(part, block, start, docs, parts)

        yield from batches_of(rows(), _FILE, size=8)

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_json: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write all documents to the token file ``path``, in ascending order of ``id_col`` (null first; ties by a hash of the ids).

    Texts are tokenized where they are read, and ids are counted there; ids alone are shuffled, to ranges whose number follows their amount.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).cast("binary").alias("text"))
    raw = materialize(texts.mapInArrow(_tokenize(_Shared(spark, tokenizer_json)), _IDS_SQL), "token-ids")
    # One row per id of the vocabulary.
    counts = raw.where("symbols is not null").select(F.explode(F.arrays_zip("symbols", "counts")).alias("x")).groupBy(F.col("x.symbols").alias("symbol")).agg(F.sum("x.counts").alias("n")).toPandas()
    table = Table.of_counts(counts["symbol"].to_numpy(dtype=np.int64), counts["n"].to_numpy(dtype=np.int64))
    checksum = zlib.crc32(table.symbols.tobytes() + table.freqs.tobytes())
    spark.createDataFrame([(VERSION, SCALE_BITS, LANES, CHECKPOINT_ROWS, table.symbols.tolist(), table.freqs.tolist(), checksum)], "version int, scale_bits int, lanes int, checkpoint_rows int, symbols array<bigint>, freqs array<bigint>, crc32 bigint").coalesce(1).write.parquet(f"{path}/tables")
    ranges = max(shuffle_partitions(spark), -(-int(counts["n"].sum()) // RANGE_IDS))
    # Rows that share a doc_id can be parted too: by a hash of their ids, then by their number.
    keyed = raw.where("ids is not null").select("doc_id", F.xxhash64("ids").alias("tie"), "row", "ids")
    ordered = keyed.repartitionByRange(ranges, "doc_id", "tie", "row").sortWithinPartitions("doc_id", "tie", "row")
    shared = spark.sparkContext.broadcast((table.symbols, table.freqs))
    blocks = ordered.select(F.spark_partition_id().alias("part"), "doc_id", "ids").mapInArrow(_encode_blocks(shared), _FILE_SQL)
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")
    # Ids before each range of documents: one row per range.
    sums = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n"))
    sums.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before")).coalesce(1).write.parquet(f"{path}/ranges")
    release(raw)


_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def _decode_blocks(shared, wanted: frozenset[int] | None = None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(*shared.value)

        def rows():
            columns = ("start", "n_ids", "doc_ids", "lengths", "words", "states", "mark_rows", "mark_words", "mark_states", "words_crc32", "ids_crc32")
            for start, n, docs, lengths, words, states, mark_rows, mark_words, mark_states, words_crc, ids_crc in rows_of(batches, *columns):
                if zlib.crc32(words) != words_crc:
                    raise ValueError(f"the block at id {start} is damaged")
                if wanted is not None:
                    marks, at = [(0, 0, states), *zip(mark_rows, mark_words, mark_states, strict=True)], 0
                    for doc_id, length in zip(docs, lengths, strict=True):
                        if doc_id in wanted:
                            # From the last checkpoint at or before the document's first id.
                            row, word, state = marks[bisect_right(mark_rows, at // LANES)]
                            ids = decode(n, words, state, table, row, word, -(-(at + length) // LANES))[at - row * LANES :][:length]
                            yield doc_id, start + at, length, ids.astype("<u4").tobytes()
                        at += length
                    continue
                ids = decode(n, words, states, table).astype("<u4").tobytes()
                if zlib.crc32(ids) != ids_crc:
                    raise ValueError(f"the block at id {start} was decoded to other ids")
                at = 0
                for doc_id, length in zip(docs, lengths, strict=True):
                    yield doc_id, start + at, length, ids[4 * at : 4 * (at + length)]
                    at += length

        yield from batches_of(rows(), _DOCS)

    return run


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian unsigned 32-bit) of every document of a token file, checked against its checksums.

    With ``doc_ids``, of those documents alone, each decoded from the checkpoint before it.
    """
    t = spark.read.parquet(f"{path}/tables").first()
    symbols, freqs = np.array(t["symbols"], dtype=np.int64), np.array(t["freqs"], dtype=np.int64)
    if t["version"] != VERSION or t["lanes"] != LANES or t["scale_bits"] != SCALE_BITS or zlib.crc32(symbols.tobytes() + freqs.tobytes()) != t["crc32"]:
        raise ValueError(f"{path} has another version or a damaged table")
    shared = spark.sparkContext.broadcast((symbols, freqs))
    blocks = spark.read.parquet(f"{path}/blocks").join(spark.read.parquet(f"{path}/ranges"), "part").withColumn("start", F.col("start") + F.col("before")).drop("before")
    if doc_ids is not None:
        blocks = blocks.where(F.arrays_overlap("doc_ids", F.array(*[F.lit(i).cast("long") for i in doc_ids])))
    return blocks.mapInArrow(_decode_blocks(shared, None if doc_ids is None else frozenset(doc_ids)), "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def report(docs: DataFrame, tokenizer_path: str, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` as a token file, read it back, and return doc_id, start, n_tokens, ids_crc32 of every document.

    Null text counts as empty, so it has the end id alone. Rows that share a doc_id, repeated rows too, are written each for
    itself; a null doc_id comes first. A very long text makes a block of its own. Other columns are ignored, whatever their
    names. No rows: an empty file and no rows.
    """
    spark = docs.sparkSession
    path = path or new_path(spark, "tokens")
    with open(tokenizer_path, encoding="utf-8") as source:  # a file of the driver; its text goes to the executors
        write_tokens(docs, path, source.read(), id_col, text_col)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

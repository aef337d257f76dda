"""Phrase collocation mining: phrases whose words stand together more often than their parts' counts explain, per language.

Texts are cut at punctuation and line ends into pieces. A task lays the words of one language out in shards of places, with an empty place after every
piece. Each word of a shard has a bitmap of its places, kept as its non-zero bytes. A phrase is extended depth-first, group by group of first words: its
bitmap is shifted by one place and ANDed with the bitmaps of all words there, which gives the bitmaps of the phrases one word longer; the empty places stop
a phrase at the end of its piece. The bits set are the shard's count, and Spark sums the counts of all shards in one grouped sum.

Shards send every phrase, so the sums are exact: phrases go in packs of like counts per bucket (sorted text compresses to some ten bytes a phrase), and a
pack is taken apart after the shuffle. A frequent phrase has one row per shard at most, so no phrase is a hot key. Later steps see only phrases that reach
the least count.

Rows: repeated rows count as often as they come; null and blank texts have no words; a null ``lang`` is ``und``. A piece is never cut, however long. Other
columns are not read, so their names can't clash. An empty table gives no rows. Ties in score and count are ranked by the bytes of the phrase.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, mix, shuffle_partitions

#: Places, and bytes of different words, after which a shard is counted and a new one begun (at the end of a piece).
SHARD_PLACES = 1 << 19
SHARD_BYTES = 32 << 20
#: Bytes of a text that are laid out at a time, up to the end of a piece.
TEXT_BYTES = 1 << 20
#: Bitmap bytes of the first words that are extended together.
TOGETHER = 1 << 15
#: Buckets per shuffle partition: phrases spread evenly over the partitions, and a pack still holds many.
BUCKETS = 8
#: Parts whose best phrases are ranked together.
TOGETHER_PARTS = 8
NO_LANG = "und"

#: Stands between pieces; no character has this byte.
_GAP = b"\xff"
_PIECES = bytes(10 if chr(b) in ".,;:!?\n\x0b\x0c\r" else b for b in range(256))


class _Codes(dict):
    """Numbers of words in order of appearance."""

    bytes = 0

    def __missing__(self, word: bytes) -> int:
        self.bytes += len(word)
        code = self[word] = len(self) - 1
        return code


class Shard:
    """Places of the words of one language: the code of a word, or -1 at the end of a piece."""

    def __init__(self) -> None:
        self.codes = _Codes()
        self.codes[_GAP] = -1
        self.places = array("i")

    def add(self, words: list[bytes]) -> bool:
        """Lay words and gaps out, with a gap at the end; true once the shard is full."""
        self.places.extend(map(self.codes.__getitem__, words))
        self.places.append(-1)
        return len(self.places) >= SHARD_PLACES or self.codes.bytes >= SHARD_BYTES

    def laid_out(self) -> tuple[list[bytes], np.ndarray]:
        """Words in byte order, and the places with codes in that order."""
        words = sorted(w for w in self.codes if w != _GAP)
        rank = np.empty(len(words) + 1, dtype=np.int64)
        rank[[self.codes[w] for w in words]] = np.arange(len(words))
        rank[-1] = -1
        return words, rank[np.frombuffer(self.places, dtype=np.int32)]


class Bitmaps:
    """Bitmaps of all words of a shard, as their non-zero bytes by block of eight places."""

    def __init__(self, places: np.ndarray, n_words: int):
        at = np.flatnonzero(places >= 0)
        key = (at >> 3) * n_words + places[at]
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.diff(key[order], prepend=-1))
        self.mask = np.bitwise_or.reduceat((1 << (at & 7)).astype(np.uint8)[order], first) if len(at) else np.empty(0, np.uint8)
        self.block, self.word = np.divmod(key[order][first], max(n_words, 1))
        self.begin = np.searchsorted(self.block, np.arange((len(places) >> 3) + 3))

    def extend(self, phrase: np.ndarray, block: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bitmaps of all phrases one word longer: phrase that is extended, its next word, block, mask."""
        over = np.flatnonzero(mask >> 7)  # the last place of a block moves to the first of the next
        stay = np.flatnonzero(mask & 0x7F)
        phrase, block = np.concatenate([phrase[stay], phrase[over]]), np.concatenate([block[stay], block[over] + 1])
        mask = np.concatenate([mask[stay] << 1, np.ones(len(over), np.uint8)])
        begin = self.begin[block]
        many = self.begin[block + 1] - begin
        entry = np.repeat(begin - np.cumsum(many) + many, many) + np.arange(many.sum())
        both = np.repeat(mask, many) & self.mask[entry]
        hit = np.flatnonzero(both)
        return np.repeat(phrase, many)[hit], self.word[entry[hit]], self.block[entry[hit]], both[hit]


def _counted(phrase: np.ndarray, word: np.ndarray, block: np.ndarray, mask: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple]:
    """Bitmap entries put in order of (phrase, word): the different ones, their bits, and the entries under their new numbers."""
    key = phrase * n_words + word
    order = np.argsort(key, kind="stable")
    key = key[order]
    begins = np.diff(key, prepend=-1) != 0
    first = np.flatnonzero(begins)
    bits = np.add.reduceat(np.bitwise_count(mask[order]).astype(np.int64), first)
    return *np.divmod(key[first], n_words), bits, (np.cumsum(begins) - 1, block[order], mask[order])


def mine(places: np.ndarray, n_words: int, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """[phrase, word] codes and counts of all phrases of up to ``longest`` words, in groups of one length."""
    if not n_words:
        return
    maps = Bitmaps(places, n_words)
    order = np.argsort(maps.word, kind="stable")
    word, block, mask = maps.word[order], maps.block[order], maps.mask[order]
    ends = np.searchsorted(word, np.arange(n_words), side="right")
    low = 0
    while low < len(word):
        # whole words up to TOGETHER entries, one word at least
        high = ends[min(max(np.searchsorted(ends, low + TOGETHER, side="right") - 1, word[low]), n_words - 1)]
        part = slice(low, high)
        _, codes, bits, entries = _counted(np.zeros(high - low, np.int64), word[part], block[part], mask[part], n_words)
        phrases = codes[:, None]
        yield phrases, bits
        for _ in range(longest - 1):
            longer = maps.extend(*entries)
            if not len(longer[0]):
                break
            parent, codes, bits, entries = _counted(*longer, n_words)
            phrases = np.column_stack([phrases[parent], codes])
            yield phrases, bits
        low = high


def packs(lang: str, shard: Shard, longest: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Counts of a shard: one row per bucket and count, with the phrases (joined by line feeds) that have it. The empty phrase counts all words."""
    words, places = shard.laid_out()
    found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for phrases, bits in mine(places, len(words), longest):
        found.setdefault(phrases.shape[1], []).append((phrases.astype(np.int32), bits))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    vocabulary = pa.array(words, pa.large_binary())
    names = ["lang", "bucket", "n", "phrases"]

    def rows(bucket: np.ndarray, n: np.ndarray, phrases: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(bucket, pa.int32()), pa.array(n, pa.int64()), phrases.cast(pa.binary())], names=names)

    if found:
        yield rows(np.zeros(1), np.array([np.count_nonzero(places >= 0)]), pa.array([b""]))
    for length in sorted(found):
        codes, bits = np.concatenate([p for p, _ in found[length]]), np.concatenate([n for _, n in found.pop(length)])
        key = np.zeros(len(codes), dtype=np.uint64)
        for j in range(length):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + hashes[codes[:, j]])
        bucket = (key % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((bits, bucket))
        n, bucket, codes = bits[order], bucket[order], codes[order]
        columns = [vocabulary.take(pa.array(codes[:, j])) for j in range(length)]
        texts = pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.large_binary())) if length > 1 else columns[0]
        first = np.flatnonzero((np.diff(n, prepend=-1) != 0) | (np.diff(bucket, prepend=-1) != 0))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([*first, len(n)], pa.int32()), texts), pa.scalar(b"\n", pa.large_binary()))
        del codes, columns, texts, order, key
        for low in range(0, len(first), 4096):
            yield rows(bucket[first[low : low + 4096]], n[first[low : low + 4096]], joined[low : low + 4096])


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text, A-Z lower-cased, with gaps between its pieces; a long text in several lists, none of which cuts a piece.

    bytes.split() parts at blanks and tabs alone, for the other four characters at which it does are gaps by then.
    """
    text = text.lower().translate(_PIECES)
    low = 0
    while low < len(text):
        high = text.find(b"\n", low + TEXT_BYTES)
        high = len(text) if high < 0 else high
        words = text[low:high].replace(b"\n", b" " + _GAP + b" ").split()
        if words:
            yield words
        low = high + 1


def phrase_counts(docs: DataFrame, longest: int, least: int) -> DataFrame:
    """lang, phrase, f: places of every phrase of up to ``longest`` words that has ``least`` of them; the empty phrase stands for all words."""
    buckets = BUCKETS * shuffle_partitions(docs.sparkSession)

    def shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Shard] = {}
        weight = 0  # places of all shards, and a hundred for each
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for words in pieces(text.as_py() or b""):
                    if lang not in held:
                        held[lang] = Shard()
                        weight += 100
                    full = held[lang].add(words)
                    weight += len(words) + 1
                    if full or weight >= 2 * SHARD_PLACES:
                        out = lang if full else max(held, key=lambda x: len(held[x].places))
                        weight -= len(held[out].places) + 100
                        yield from packs(out, held.pop(out), longest, buckets)
        for lang, shard in held.items():
            yield from packs(lang, shard, longest, buckets)

    read = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)), F.col("text").cast("binary"))
    packed = read.mapInArrow(shards, "lang string, bucket int, n long, phrases binary")
    apart = packed.repartition("lang", "bucket").select("lang", "bucket", "n", F.explode(F.split(F.col("phrases").cast("string"), "\n")).alias("phrase"))
    counts = apart.groupBy("lang", "bucket", "phrase").agg(F.sum("n").alias("f"))
    return counts.where((F.col("f") >= least) | (F.col("phrase") == "")).select("lang", "phrase", "f")


def association(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(1000000 * a * a / (l * r)) for counts below 10^16, in whole numbers of up to 38 digits."""
    a, l, r = (x.cast("decimal(19,0)") for x in (a, l, r))  # noqa: E741
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (a * a), l * r)


def scored(counts: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score of every phrase of two words or more in ``counts``, by the cut that scores lowest, then the first such."""
    words = F.split("phrase", " ")
    cut = F.explode(F.transform(F.sequence(F.lit(1), F.size("_w") - 1), lambda k: F.struct(k.alias("k"), F.array_join(F.slice("_w", 1, k), " ").alias("first"), F.array_join(F.slice("_w", k + 1, F.size("_w")), " ").alias("rest"))))
    cuts = counts.withColumn("_w", words).where(F.size("_w") > 1).select("lang", "phrase", F.col("f").alias("a"), cut.alias("cut")).select("lang", "phrase", "a", "cut.*")
    for side, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(association(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def covered(counts: DataFrame) -> DataFrame:
    """lang, phrase, most: phrases of two words or more within a longer one in ``counts``, with the largest count of such."""
    words = F.split("phrase", " ")
    inner = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.size("_w") - 1), lambda k: F.transform(F.sequence(F.lit(1), F.size("_w") - k + 1), lambda at: F.array_join(F.slice("_w", at, k), " ")))))
    longer = counts.withColumn("_w", words).where(F.size("_w") > 2)
    return longer.select("lang", inner.alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("most"))


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, share: int = 50, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of each language: lang, rank, phrase, a (places), l and r (of its parts at the cut), n (words), score.

    A phrase needs ``least`` places; it is dropped where a longer one that holds it has ``share`` percent of its places. Score: a * a / (l * r) in
    millionths, at the cut where it is lowest; ranked by score, then places, then the phrase's bytes. Nulls, odd texts and repeats: as the module says.
    """
    counts = materialize(phrase_counts(docs, longest, least), "phrases")
    phrases = counts.where(F.col("phrase") != "")
    kept = scored(phrases).join(covered(phrases), ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("most") < share * F.col("a"), F.lit(True)))
    # The best of every part of a language first, then of every few parts together: no task ranks more than a few times ``top`` phrases.
    parts = 8 * shuffle_partitions(docs.sparkSession)
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = kept
    while parts > 1:
        in_part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(parts))).orderBy(*order)
        best = best.withColumn("_nth", F.row_number().over(in_part)).where(F.col("_nth") <= top)
        parts //= TOGETHER_PARTS
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    totals = counts.where(F.col("phrase") == "").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

"""Phrase collocations by SON partitioning: frequent phrases from locally frequent ones, counted exactly.

Texts (A-Z lower-cased) are cut into pieces at ``. , ; : ! ?`` and line breaks, pieces into words at spaces and
tabs. A phrase is a run of words of one piece; everything is counted for each language on its own.

The tables' partitions are dealt to ``SHARDS`` shards. A phrase that is found ``support`` times in all has at
least ``support / SHARDS`` occurrences in some shard, however uneven shards are. So each shard is mined
completely at this lowered support: first pairs of frequent words, then longer phrases all of whose pairs were
frequent in a shard. A shard may be of any size; its counts come from an aggregation by shard and phrase of
what chunks of about ``CHUNK`` bytes have counted in numpy. The union of the locally frequent phrases, with
every phrase's parts in it, are the candidates. A last pass counts all of them in all texts, by their words.

Between the passes goes a table of bits, one for each hash value of a candidate: ``BITS_EACH`` bits for a
candidate, ``MOST_BITS`` (32 MB) at most, the only thing that is broadcast. It may let through phrases that are
no candidates, which costs time and changes nothing, as the last pass adds up exact counts. Two phrases
of one chunk would be taken for one if their 64-bit hashes were equal.

A null text counts as empty, a null language is ``und``. doc_ids play no part, so repeated rows count each time
and extra columns, also with clashing names, are left out. Words of any length count. An empty table, or one
without frequent phrases, gives no rows. Ties are in the order stated at ``collocations``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from risklens.llm.quality import in_blocks
from risklens.llm.shared import bounded, pick, written
from risklens.llm.words import Spans, mix, pair, text_column

SHARDS = 16
CHUNK = 12 << 20
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 15, 1 << 28
#: Bits that one row holds while the table is put together.
ROW_BITS = 1 << 15
#: Groups that a language's phrases are ranked in before the best of all are found.
GROUPS = (1024, 32)

_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BETWEEN = _BREAK.copy()
_BETWEEN[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Chunk:
    """Words of a chunk of texts: byte spans, document, hashes, and whether the next word follows in the piece."""

    def __init__(self, column, salt: np.ndarray):
        texts = text_column(column)
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=len(texts) + 1 + texts.offset)[texts.offset:]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        inside = ~_BETWEEN[data]
        first = np.zeros(len(data), dtype=bool)  # bytes that begin a text
        first[offsets[:-1][np.diff(offsets) > 0]] = True
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | first[1:]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | first[1:]
        self.data = _LOWER[data]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        # Breaks and texts begun so far; equal for two words of one piece only.
        piece = np.cumsum(_BREAK[data], dtype=np.int32)[self.start]
        self.doc = np.searchsorted(offsets, self.start, side="right") - 1
        self.follows = (piece[1:] == piece[:-1]) & (self.doc[1:] == self.doc[:-1])
        self.word = mix(Spans(self.data, self.start, self.end).hash + salt[self.doc])

    def texts(self, at: np.ndarray, words: int) -> pa.Array:
        """The phrases of ``words`` words from the given words on, joined by single spaces."""
        word = (at[:, None] + np.arange(words)).ravel()
        size = self.end[word] - self.start[word] + 1
        size[words - 1::words] -= 1  # no space after the last
        stop = np.cumsum(size)
        flat = self.data[np.minimum(np.arange(stop[-1] if len(stop) else 0) + np.repeat(self.start[word] - (stop - size), size),
                                    len(self.data) - 1)]
        flat[np.delete(stop, np.s_[words - 1::words]) - 1] = 0x20
        offsets = np.concatenate([[0], stop[words - 1::words]]).astype(np.int64)
        whole = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(flat))
        return whole.cast(pa.string())


class Bits:
    """Which hash values were put in; it may answer yes for others."""

    def __init__(self, table: np.ndarray):
        self.table, self.shift = table, np.uint64(64 - int(len(table) * 8).bit_length() + 1)

    def __contains__(self, _):
        raise TypeError("ask for arrays by has()")

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> self.shift
        return (self.table[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bits(hashes: DataFrame) -> bytes:
    """The bit table of a written table of hashes (long ``hash``)."""
    wanted = max(LEAST_BITS, min(MOST_BITS, BITS_EACH * hashes.count()))
    size = 1 << (wanted - 1).bit_length()
    at = F.shiftrightunsigned("hash", 64 - (size.bit_length() - 1))
    places = hashes.select(F.floor(at / ROW_BITS).cast("int").alias("block"), (at % ROW_BITS).cast("int").alias("place"))
    rows = places.groupBy("block").agg(F.collect_set("place").alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            packed = []
            for places in b.column(1):
                row = np.zeros(ROW_BITS, dtype=np.uint8)
                row[places.values.to_numpy()] = 1
                packed.append(np.packbits(row, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(packed, pa.binary())], ["block", "packed"])

    table = bytearray(size // 8)
    for r in rows.mapInArrow(run, "block int, packed binary").collect():  # size / ROW_BITS rows at most
        table[r.block * ROW_BITS // 8:(r.block + 1) * ROW_BITS // 8] = r.packed
    return bytes(table)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Chunk, pa.Array]]:
    """Chunks of about ``CHUNK`` bytes of (text, lang, salt) rows, and the languages of their texts."""
    held, size = [], 0
    for b in batches:
        at = 0
        for block in in_blocks(b.column(0), CHUNK):
            part = b.slice(at, len(block))
            at += len(block)
            held.append((block, part.column(1), part.column(2).to_numpy().view(np.uint64)))
            size += block.nbytes
            if size >= CHUNK:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held: list) -> tuple[Chunk, pa.Array]:
    texts, langs, salts = zip(*held)
    return Chunk(pa.concat_arrays(texts), np.concatenate(salts)), pa.concat_arrays(langs)


def _runs(chunk: Chunk, upto: int) -> Iterator[tuple[int, np.ndarray]]:
    """Hashes of the runs of 2, 3, ... words from each word, whether within a piece or not."""
    run = chunk.word
    for k in range(2, upto + 1):
        run = pair(run[:-1], chunk.word[k - 1:]) if len(chunk.word) >= k else chunk.word[:0]
        yield k, run


def _both(flags: np.ndarray) -> np.ndarray:
    """For each place but the last: flagged there and at the next."""
    return flags[:-1] & flags[1:]


def _plain(docs: DataFrame) -> DataFrame:
    plain = pick(docs, "text", "lang").select(F.coalesce("text", F.lit("")).alias("text"),
                                              F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    return plain.select("text", "lang", F.xxhash64("lang").alias("salt"))


def _over_chunks(docs: DataFrame, make: Callable[[Chunk, pa.Array, int], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() % SHARDS
        for chunk, langs in _chunks(batches):
            yield from make(chunk, langs, shard)
    return _plain(docs).mapInArrow(run, schema)


def _words(docs: DataFrame) -> DataFrame:
    """(lang, word, f, hash) of all words; the word null and f the number of all words of the language."""
    def make(chunk: Chunk, langs: pa.Array, shard: int) -> Iterator[pa.RecordBatch]:
        hashes, first, count = np.unique(chunk.word, return_index=True, return_counts=True)
        names = langs.dictionary_encode()
        each = np.bincount(names.indices.to_numpy()[chunk.doc], minlength=len(names.dictionary))
        yield pa.RecordBatch.from_arrays(
            [pa.concat_arrays([langs.take(pa.array(chunk.doc[first])), names.dictionary]),
             pa.concat_arrays([chunk.texts(first, 1), pa.nulls(len(each), pa.string())]),
             pa.array(np.append(count, each)), pa.array(np.append(hashes, np.zeros(len(each), np.uint64)).view(np.int64))],
            ["lang", "word", "f", "hash"])
    found = _over_chunks(docs, make, "lang string, word string, f long, hash long")
    return found.groupBy("lang", "word").agg(F.sum("f").alias("f"), F.first("hash").alias("hash"))


def _mined(docs: DataFrame, counted: Callable[[Chunk], Iterator[np.ndarray]], local: int) -> DataFrame:
    """(hash) of the phrases that ``counted`` gives at least ``local`` times in some shard."""
    def make(chunk: Chunk, langs: pa.Array, shard: int) -> Iterator[pa.RecordBatch]:
        for hashes in counted(chunk):
            found, count = np.unique(hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), shard, np.int32)), pa.array(found.view(np.int64)),
                                              pa.array(count)], ["shard", "hash", "f"])
    each = _over_chunks(docs, make, "shard int, hash long, f long")
    return written(each.groupBy("shard", "hash").agg(F.sum("f").alias("f")).where(F.col("f") >= local).select("hash").distinct())


def frequent(docs: DataFrame, support: int = 100, longest: int = 5) -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, f) of all phrases of 1 to ``longest`` words found ``support`` times; (lang, n) of all words."""
    spark, local = docs.sparkSession, math.ceil(support / SHARDS)
    words = written(_words(docs).where(F.col("word").isNull() | (F.col("f") >= support)))
    totals = words.where("word IS NULL").select("lang", F.col("f").alias("n"))
    single = words.where("word IS NOT NULL")
    one = spark.sparkContext.broadcast(bits(single.select("hash")))
    table = lambda held: Bits(np.frombuffer(held.value, dtype=np.uint8))

    def open_pairs(chunk: Chunk) -> np.ndarray:
        return chunk.follows & _both(table(one).has(chunk.word))

    def count_pairs(chunk: Chunk) -> Iterator[np.ndarray]:
        for k, run in _runs(chunk, 2):
            yield run[open_pairs(chunk)]

    two = spark.sparkContext.broadcast(bits(_mined(docs, count_pairs, local)))

    def count_longer(chunk: Chunk) -> Iterator[np.ndarray]:
        for k, run in _runs(chunk, longest):
            if k == 2:
                flags = open_pairs(chunk) & table(two).has(run)
            else:
                flags = _both(flags)
                yield run[flags]

    more = spark.sparkContext.broadcast(bits(_mined(docs, count_longer, local)))

    def count_all(chunk: Chunk, langs: pa.Array, shard: int) -> Iterator[pa.RecordBatch]:
        for k, run in _runs(chunk, longest):
            flags = open_pairs(chunk) if k == 2 else _both(flags)
            flags = flags & table(two if k == 2 else more).has(run)
            at = np.flatnonzero(flags)
            _, first, count = np.unique(run[at], return_index=True, return_counts=True)
            at = at[first]
            yield pa.RecordBatch.from_arrays([langs.take(pa.array(chunk.doc[at])), pa.array(np.full(len(at), k, np.int32)),
                                              chunk.texts(at, k), pa.array(count)], ["lang", "words", "phrase", "f"])

    phrases = (_over_chunks(docs, count_all, "lang string, words int, phrase string, f long")
               .groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= support))
    ones = single.select("lang", F.lit(1).alias("words"), F.col("word").alias("phrase"), "f")
    return written(ones.unionByName(phrases)), totals


def scored(phrases: DataFrame, totals: DataFrame, scale: int = 1000) -> DataFrame:
    """(lang, words, phrase, a, l, r, n, score) of all phrases of two words and more, by their lowest-scoring cut.

    A cut's score is floor(scale a n / (l r)), in decimals of 38 digits; of equal ones the first cut counts.
    """
    parts = phrases.select("lang", "phrase", "f")
    one, two = parts.toDF("l_lang", "l_phrase", "l"), parts.toDF("r_lang", "r_phrase", "r")
    sizes = bounded(totals.toDF("n_lang", "n"))
    cuts = (phrases.where("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"),
                                              F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
            .withColumn("left", F.expr("substring_index(phrase, ' ', k)"))
            .withColumn("right", F.expr("substring_index(phrase, ' ', k - words)")))
    cuts = (cuts.join(one, (F.col("lang") == F.col("l_lang")) & (F.col("left") == F.col("l_phrase")))
            .join(two, (F.col("lang") == F.col("r_lang")) & (F.col("right") == F.col("r_phrase"))))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.join(sizes, F.col("lang") == F.col("n_lang")).withColumn("over", wide("a") * wide("n") * F.lit(scale).cast("decimal(9,0)"))
    cuts = cuts.withColumn("under", wide("l") * wide("r")).withColumn("score", F.expr("over div under"))
    best = cuts.groupBy("lang", "words", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "words", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def outermost(phrases: DataFrame, candidates: DataFrame, percent: int = 100) -> DataFrame:
    """The candidates that no longer phrase, found ``percent`` per cent as often or more, contains.

    If any longer phrase is frequent enough, so is one of the two that are longer by one word.
    """
    longer = phrases.where("words > 2").select("lang", "f", F.explode(F.array(
        F.expr("substring_index(phrase, ' ', words - 1)"), F.expr("substring_index(phrase, ' ', 1 - words)"))).alias("inner"))
    around = longer.groupBy("lang", "inner").agg(F.max("f").alias("around")).withColumnRenamed("lang", "a_lang")
    joined = candidates.join(around, (F.col("lang") == F.col("a_lang")) & (F.col("phrase") == F.col("inner")), "left")
    kept = F.col("around").isNull() | (F.lit(100).cast("decimal(9,0)") * F.col("around") < F.lit(percent).cast("decimal(9,0)") * F.col("a"))
    return joined.where(kept).select(*candidates.columns)


def first_of_each(found: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language with their rank, by rounds over groups that hold a share of it each."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    for groups in GROUPS:
        own = Window.partitionBy("lang", "part").orderBy(*order)
        found = (found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(groups)))
                 .withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= top).drop("part", "rank"))
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)


def collocations(docs: DataFrame, support: int = 100, longest: int = 5, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of 2 to ``longest`` words.

    Best by score, then by number of occurrences, then by phrase in the order of its bytes.
    """
    phrases, totals = frequent(docs, support, longest)
    found = first_of_each(outermost(phrases, scored(phrases, totals)), top)
    return found.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

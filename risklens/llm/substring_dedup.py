"""Repeated passages by difference-cover anchors.

Two equal runs of ``WINDOW`` words can lie at any two offsets. ``COVER`` is a difference cover modulo
``PERIOD``: whatever the offsets, some k < PERIOD puts both i + k and j + k on cover positions. So both
runs hold an equal anchor of WINDOW - PERIOD + 1 words at cover positions, and only the anchors there,
4 of 13, are exchanged (hashes of all positions come from one pass over arrays). Windows around anchors that occur more than once are then extended to
their full length and compared by 96 bits; every one but the earliest marks its words.

Texts are dealt once into chunks of about ``CHUNK`` bytes. A chunk sends its distinct anchors to shards
chosen by hash, which answer with one bit each: repeated or not. In the same way it sends its distinct
windows, each with the document it is first in, and learns which start in an earlier document. A
passage that a third of all documents share so arrives once from each chunk, and answers go back in the
order of the requests. Documents of the same words as an earlier one are settled first by a digest of the
sequence: all their windows start earlier.

Documents are ordered by doc_id, null last, then by a hash of the text; rows equal in both count as one
document and get equal results. Null text has no words; what has fewer than WINDOW words stays whole. A very long
text is in one chunk, as all rows equal in doc_id and text are. An empty table gives no rows; columns other than
doc_id and text, also ones with clashing names, are left out.
"""

from __future__ import annotations

import hashlib
import math
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from risklens.llm.exchange import SCHEMA, Routes, dealt, pack, received, unpack
from risklens.llm.quality import in_blocks
from risklens.llm.shared import pick, spread, written
from risklens.llm.words import Words, mix, ngrams

WINDOW = 20
#: A perfect difference set: the differences of its members are all residues modulo 13.
PERIOD, COVER = 13, (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
CHUNK = 12 << 20
#: What becomes of a document, and what a shard's answer is about.
SHORT, SEARCHED, COPY = 0, 1, 2
ANCHORS, WINDOWS = 1, 2


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, h, g): h and g together stand for doc_id and text."""
    plain = pick(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    return plain.select("doc_id", "text", F.xxhash64("text").alias("h"), F.xxhash64(F.lit(5), "doc_id", "text").alias("g"))


def _sequences(docs: DataFrame) -> DataFrame:
    """(doc_id, h, g, n, size, d1, d2): number, bytes and digest of the words in their order."""
    def run(batches):
        for b in batches:
            at = 0
            for block in in_blocks(b.column(3)):
                w, n = Words(block), len(block)
                place = (np.arange(len(w.hash)) - np.repeat(w.first[:-1], w.counts)).astype(np.uint64)
                sums = []
                for s in (3, 4):
                    part = mix(w.hash + (place * np.uint64(2 * s + 1) << np.uint64(8)) + np.uint64(s))
                    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part)])
                    sums.append(pa.array((total[w.first[1:]] - total[w.first[:-1]]).view(np.int64)))
                yield pa.RecordBatch.from_arrays([*[b.column(i).slice(at, n) for i in range(3)], pa.array(w.counts.astype(np.int64)),
                                                  pa.array(np.diff(w.offsets)), *sums], ["doc_id", "h", "g", "n", "size", "d1", "d2"])
                at += n
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "h", "g", "text").mapInArrow(
        run, f"doc_id {kind}, h long, g long, n long, size long, d1 long, d2 long")


class _Chunk:
    """Searched documents of a chunk in their order, and their anchors by shard.

    ``right`` has the status rows of the chunk's documents and the answers so far.
    """

    def __init__(self, left: pa.Table, right: pa.Table, shards: int):
        self.shards = shards
        rows = {(g, h): (no, state) for g, h, no, state in zip(*(right[c].to_pylist() for c in ("g", "h", "no", "state")))}
        found = [rows[k] for k in zip(left["g"].to_pylist(), left["h"].to_pylist())]
        no = np.array([x[0] for x in found])
        self.state = np.array([x[1] for x in found])
        mine = np.flatnonzero(self.state == SEARCHED)
        self.no, first = np.unique(no[mine], return_index=True)
        self.row_of = {n: i for i, n in enumerate(self.no.tolist())}
        self.numbers = no
        w = self.words = Words(left["text"].take(pa.array(mine[first])))
        self.doc = w.doc_of()
        self.place = np.arange(len(w.hash)) - np.repeat(w.first[:-1], w.counts)
        self.at = np.flatnonzero(np.isin(self.place % PERIOD, COVER) & (self.place <= w.counts[self.doc] - ANCHOR))
        hashes = ngrams(w.hash, ANCHOR)
        self.anchors, self.which, count = np.unique(hashes[self.at], return_inverse=True, return_counts=True)
        self.several = count > 1
        self.by_shard = self.dealt(self.anchors)
        self.answers = {(kind, s): parts[0] for _, s, kind, parts in received(right)}

    def dealt(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Order of sorted keys by shard, the shards that have any, and where each begins."""
        return dealt((mix(keys) % np.uint64(self.shards)).astype(np.int64))

    def answered(self, kind: int, order: np.ndarray, owners: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The shards' bits in the order of the keys."""
        out = np.zeros(len(order), dtype=bool)
        for s, i, j in zip(owners.tolist(), bounds[:-1], bounds[1:]):
            bits = np.frombuffer(self.answers[kind, s], dtype=np.uint8)
            out[order[i:j]] = np.unpackbits(bits, count=j - i).astype(bool)
        return out

    def windows(self) -> None:
        """Windows that hold a repeated anchor, grouped; the first of a group is the earliest here."""
        w = self.words
        hit = np.zeros(len(w.hash) + PERIOD, dtype=bool)
        hit[self.at[self.answered(ANCHORS, *self.by_shard)[self.which]]] = True
        near = hit[:len(w.hash)].copy()
        for k in range(1, PERIOD):
            near |= hit[k:k + len(w.hash)]
        # Anchors of the next text do no harm: windows end inside their own.
        where = np.flatnonzero(near & (self.place <= w.counts[self.doc] - WINDOW))
        w1 = ngrams(w.hash, WINDOW)[where]
        w2 = (ngrams(mix(w.hash + np.uint64(9)), WINDOW)[where] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        order = np.lexsort((where, w2, w1))
        self.start, w1, w2 = where[order], w1[order], w2[order]
        fresh = np.ones(len(w1), dtype=bool)
        fresh[1:] = (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])
        self.leader = np.flatnonzero(fresh)
        self.group = np.cumsum(fresh) - 1
        self.w1, self.w2 = w1[self.leader], w2[self.leader]
        self.w_by_shard = self.dealt(self.w1)

    def repeated(self) -> dict[int, np.ndarray]:
        """Starts of repeated windows of each document, by its number."""
        self.windows()
        gone = self.answered(WINDOWS, *self.w_by_shard)[self.group]
        later = np.ones(len(self.start), dtype=bool)
        later[self.leader] = False
        at = np.sort(self.start[gone | later])
        cut = np.searchsorted(self.doc[at], np.arange(len(self.no) + 1))
        return {n: self.place[at[cut[i]:cut[i + 1]]] for n, i in self.row_of.items()}


def _exchanged(texts: DataFrame, known: DataFrame, chunks: int, shards: int, kind: int) -> DataFrame:
    """``known`` and the shards' answers about anchors or windows of the chunks."""
    routes = Routes(max(chunks, shards))

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = _Chunk(left, right, shards)
        number = left["chunk"][0].as_py()
        if kind == WINDOWS:
            chunk.windows()

        def requests():
            order, owners, bounds = chunk.by_shard if kind == ANCHORS else chunk.w_by_shard
            for s, i, j in zip(owners.tolist(), bounds[:-1], bounds[1:]):
                at = order[i:j]
                if kind == ANCHORS:
                    parts = pack(chunk.anchors[at]), np.packbits(chunk.several[at]).tobytes(), b"", b""
                else:
                    docs, index = np.unique(chunk.doc[chunk.start[chunk.leader[at]]], return_inverse=True)
                    narrow = np.uint16 if len(docs) <= 1 << 16 else np.uint32
                    parts = pack(chunk.w1[at]), chunk.w2[at].tobytes(), index.astype(narrow).tobytes(), chunk.no[docs].tobytes()
                yield s, number, kind, parts
        return routes.sent(requests(), number)

    def answer(table: pa.Table) -> pa.Table:
        shard, requests = table["node"][0].as_py(), list(received(table))
        keys = [unpack(p[0]) for *_, p in requests]
        bounds = np.cumsum([0, *map(len, keys)])
        if kind == ANCHORS:
            several = np.concatenate([np.unpackbits(np.frombuffer(p[1], dtype=np.uint8), count=len(k)) for (*_, p), k in zip(requests, keys)])
            _, at = np.unique(np.concatenate(keys), return_inverse=True)
            bits = (np.bincount(at, weights=several + 1) > 1)[at]
        else:
            w1, w2 = np.concatenate(keys), np.concatenate([np.frombuffer(p[1], dtype=np.uint32) for *_, p in requests])
            no = np.concatenate([np.frombuffer(p[3], dtype=np.int64)[np.frombuffer(p[2], dtype=np.uint16 if len(p[2]) == 2 * len(k) else np.uint32)]
                                 for (*_, p), k in zip(requests, keys)])
            order = np.lexsort((no, w2, w1))
            fresh = np.ones(len(order), dtype=bool)
            fresh[1:] = (w1[order[1:]] != w1[order[:-1]]) | (w2[order[1:]] != w2[order[:-1]])
            bits = np.zeros(len(order), dtype=bool)
            bits[order] = ~fresh
        return routes.sent(((chunk, shard, kind, (np.packbits(bits[i:j]).tobytes(),))
                            for (_, chunk, _, _), i, j in zip(requests, bounds[:-1], bounds[1:])), shard)

    asked = routes.delivered(texts.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(ask, SCHEMA))
    answers = routes.delivered(asked.groupBy("node").applyInArrow(answer, SCHEMA))
    return known.unionByName(answers.withColumnRenamed("node", "chunk"), allowMissingColumns=True)


def _kept(text: bytes, starts: np.ndarray | None) -> tuple[int, int, str]:
    """Words, words covered by the windows at ``starts``, and digest of what stays."""
    words = text.split()  # bytes split at the six separators only
    n, gone = len(words), 0
    if starts is not None and len(starts):
        cover = np.zeros(n + 1, dtype=np.int64)
        cover[starts] += 1
        cover[starts + WINDOW] -= 1
        stay = np.cumsum(cover[:-1]) == 0
        gone, words = int(n - stay.sum()), compress(words, stay)
    return n, gone, hashlib.sha256(b" ".join(words)).hexdigest()


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document."""
    texts = _keyed(docs)
    kind = texts.schema["doc_id"].dataType.simpleString()
    sequences = written(_sequences(texts))
    chunks = max(1, math.ceil((sequences.agg(F.sum("size")).first()[0] or 0) / CHUNK))
    shards = max(chunks, spread(docs.sparkSession))
    rank = [F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("h"), F.col("g")]
    first = (sequences.where(F.col("n") >= WINDOW).groupBy("d1", "d2", "n").agg(F.min(F.struct(*rank)).alias("r"))
             .select(F.col("r.g").alias("g"), F.col("r.h").alias("h"), F.lit(SEARCHED).alias("first")))
    # ``no`` numbers documents in their order.
    chunk = F.pmod(F.col("g"), F.lit(chunks)).alias("chunk")
    state = F.when(F.col("n") < WINDOW, SHORT).otherwise(F.coalesce("first", F.lit(COPY)))
    status = written(sequences.groupBy("g", "h").agg(F.first("doc_id").alias("doc_id"), F.first("n").alias("n"))
                     .join(first, ["g", "h"], "left")
                     .orderBy(F.col("doc_id").asc_nulls_last(), "h", "g")
                     .select(chunk, "g", "h", F.monotonically_increasing_id().alias("no"), state.alias("state"),
                             F.lit(None).cast("binary").alias("data")))
    texts = texts.select(chunk, "doc_id", "g", "h", "text")

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = _Chunk(left, right, shards)
        starts, out = chunk.repeated(), []
        for text, no, state in zip(left["text"], chunk.numbers.tolist(), chunk.state.tolist()):
            n, gone, digest = _kept(text.as_buffer().to_pybytes(), starts.get(no) if state == SEARCHED else None)
            out.append((n, n, hashlib.sha256(b"").hexdigest()) if state == COPY else (n, gone, digest))
        n, gone, digest = zip(*out)
        return pa.table({"doc_id": left["doc_id"], "n_words": pa.array(n, pa.int64()), "n_removed": pa.array(gone, pa.int64()),
                         "kept_sha256": pa.array(digest, pa.string())})

    known = _exchanged(texts, _exchanged(texts, status, chunks, shards, ANCHORS), chunks, shards, WINDOWS)
    return texts.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(
        finish, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")

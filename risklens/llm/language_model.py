"""Scoring by an n-gram model kept as Elias-Fano tries.

Tokens are a text's words (A-Z lower-cased) and one end. Texts are dealt into chunks of about
``CHUNK`` bytes. A chunk sends its distinct words and word pairs, with their counts in training texts, to
shards chosen by hash, so a frequent word or pair arrives once from each chunk. A shard adds the
counts up, builds its part of the trie and answers the same requests in their order; the answers go
back to the chunks, which score their texts. Requests and answers travel in bundles (``exchange``), whose number
grows with that of the chunks. No model is broadcast, and no task holds more than a chunk or a shard.

A trie has three memory-mapped levels: contexts, monotone pointers to their first successor, and the
successors, relative to their context and made monotone by its rank. All are Elias-Fano coded; next
to the successors lie their counts as 8-bit codes, exact to 64 and in steps of 12 % above. From these
and the exact counts of words follow the smoothed probabilities

    p(w | v) = l c(v w) / c(v) + (1 - l) (c(w) + 1) / (N + V + 1),

where the weight l depends on the magnitude of c(v) and maximises the likelihood of the training texts
when each pair is left out of its own counts. A text's ratios of the two parts are kept as counts of
log-spaced cells, twenty to a factor of ten, so weights can be fitted after the only pass.

Training texts meet their own counts, so their scores don't compare with those of held-out texts.

Null text counts as empty: its only token is the end. A row whose doc_id is null is a training text
unless ``train`` says otherwise. Rows that repeat a doc_id are texts of their own, but rows equal in doc_id and text go
to one chunk, as a very long text does. Nothing depends on an order, so there are no ties. An empty table gives no
rows; columns other than doc_id and text, also ones with clashing names, are left out.
"""

from __future__ import annotations

import math
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from risklens.llm.exchange import SCHEMA, Routes, dealt, pack, received, unpack
from risklens.llm.shared import pick, spread, written
from risklens.llm.words import Words, mix, pair

CHUNK = 9 << 20
#: Values of a coded level that are decoded together.
BLOCK = 1 << 16
BEGIN, END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
_LOW = np.uint64(0xFFFFFFFF)
EXACT, STEP = 64, 1.12
#: Cells of log10 of c(v w) / (c(v) (c(w) + 1)), and classes of c(v) by powers of two.
CELLS, CELLS_PER_TEN, LEAST = 512, 20, -25.0
CLASSES = 48


def encode_count(c: np.ndarray) -> np.ndarray:
    large = EXACT + np.rint(np.log(np.maximum(c, EXACT) / EXACT) / math.log(STEP))
    return np.minimum(np.where(c <= EXACT, c, large), 255).astype(np.uint8)


def decode_count(code: np.ndarray) -> np.ndarray:
    code = code.astype(float)
    return np.where(code <= EXACT, code, EXACT * STEP ** (code - EXACT))


class EliasFano:
    """A non-decreasing sequence: low bits in place, high bits in unary, one bit for each step.

    Values are read block by block: the place in the high bits where each block begins is kept, so a search
    never decodes a whole level.
    """

    def __init__(self, values: np.ndarray, universe: int):
        self.n = len(values)
        self.low_bits = max(0, int(universe // max(self.n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        shifts = np.arange(self.low_bits, dtype=np.uint64)
        low = np.zeros(-(-self.n * self.low_bits // 8), dtype=np.uint8)
        for i in range(0, self.n, BLOCK):  # low bits of a block fill whole bytes
            bits = ((values[i:i + BLOCK, None] >> shifts) & np.uint64(1)).astype(np.uint8)
            packed = np.packbits(bits.ravel(), bitorder="little")
            low[i * self.low_bits // 8:i * self.low_bits // 8 + len(packed)] = packed
        place = (values >> np.uint64(self.low_bits)).astype(np.int64) + np.arange(self.n)
        ones = np.zeros(int(place[-1]) + 1 if self.n else 0, dtype=np.uint8)
        ones[place] = 1
        self.low, self.high = low, np.packbits(ones, bitorder="little")
        #: Place of the first one of each block, and one past the last.
        self.begins = np.append(place[::BLOCK], len(ones))

    def block(self, k: int) -> np.ndarray:
        """The values from ``k * BLOCK`` on, ``BLOCK`` at most."""
        start, stop = int(self.begins[k]), int(self.begins[k + 1])
        bits = np.unpackbits(np.asarray(self.high[start // 8:-(-stop // 8)]), bitorder="little")
        place = np.flatnonzero(bits[start % 8:start % 8 + stop - start]) + start
        out = (place - k * BLOCK - np.arange(len(place))).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            at, m = k * BLOCK * self.low_bits // 8, len(out)
            bits = np.unpackbits(np.asarray(self.low[at:at + -(-m * self.low_bits // 8)]), bitorder="little")
            weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
            out |= (bits[:m * self.low_bits].reshape(m, -1) * weights).sum(axis=1, dtype=np.uint64)
        return out

    def at(self, index: np.ndarray) -> np.ndarray:
        """Values at non-decreasing places."""
        out = np.empty(len(index), dtype=np.uint64)
        for k in np.unique(index // BLOCK):
            i, j = np.searchsorted(index, (k * BLOCK, (k + 1) * BLOCK))
            out[i:j] = self.block(int(k))[index[i:j] - k * BLOCK]
        return out

    def successor(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and value of the first element not less than each of the sorted ``wanted``; place n beyond the last."""
        place, value = np.full(len(wanted), self.n, dtype=np.int64), np.zeros(len(wanted), dtype=np.uint64)
        i = 0
        for k in range(len(self.begins) - 1):
            if i == len(wanted):
                break
            values = self.block(k)
            j = int(np.searchsorted(wanted, values[-1], side="right"))
            if j > i:
                at = np.searchsorted(values, wanted[i:j])
                place[i:j], value[i:j] = at + k * BLOCK, values[at]
                i = j
        return place, value


class Trie:
    """Counts of (context, successor) keys: the upper and lower 32 bits of sorted 64-bit keys."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        context = keys >> np.uint64(32)
        first = np.ones(len(keys), dtype=bool)
        first[1:] = context[1:] != context[:-1]
        start = np.flatnonzero(first)
        rank = np.cumsum(first) - 1
        self.contexts = EliasFano(context[start], 1 << 32)
        self.pointers = EliasFano(np.append(start, len(keys)), len(keys) + 1)
        self.successors = EliasFano((rank.astype(np.uint64) << np.uint64(32)) | (keys & _LOW), max(len(start), 1) << 32)
        self.codes = encode_count(counts)
        self._map()

    def _map(self) -> None:
        """Move all levels to one file without a name and map it into memory."""
        levels = [(e, name) for e in (self.contexts, self.pointers, self.successors) for name in ("low", "high")]
        levels.append((self, "codes"))
        with tempfile.TemporaryFile() as file:
            for owner, name in levels:
                file.write(getattr(owner, name).tobytes())
            file.flush()
            size = file.tell()
            whole = np.memmap(file, dtype=np.uint8, mode="r", shape=(size,)) if size else np.zeros(0, np.uint8)
        at = 0
        for owner, name in levels:
            n = getattr(owner, name).nbytes
            setattr(owner, name, whole[at:at + n])
            at += n

    def search(self, keys: np.ndarray) -> np.ndarray:
        """Codes of sorted keys, 0 for those not in the trie."""
        found = np.zeros(len(keys), dtype=np.uint8)
        rank, context = self.contexts.successor(keys >> np.uint64(32))
        known = np.flatnonzero((rank < self.contexts.n) & (context == keys >> np.uint64(32)))
        # Relative to the context: its first successor that is not less, before the next context's begin.
        wanted = (rank[known].astype(np.uint64) << np.uint64(32)) | (keys[known] & _LOW)
        at, value = self.successors.successor(wanted)
        inside = (at < self.pointers.at(rank[known] + 1).astype(np.int64)) & (value == wanted)
        found[known[inside]] = self.codes[at[inside]]
        return found


class _Chunk:
    """Tokens of a chunk as numbers of its distinct words and pairs, which are ordered by shard."""

    def __init__(self, table: pa.Table, shards: int):
        w = Words(table["text"], lower=True)
        self.rows = w.rows
        size = w.counts + 1
        total = int(size.sum())
        self.doc = np.repeat(np.arange(w.rows), size)
        ends = np.cumsum(size) - 1
        tokens = np.empty(total, dtype=np.uint64)
        tokens[np.arange(len(w.hash)) + w.doc_of()] = w.hash
        tokens[ends] = END
        starts = ends - w.counts
        before = np.empty(total, dtype=np.uint64)
        before[1:] = tokens[:-1]
        before[starts] = BEGIN
        self.train = np.repeat(table["train"].to_numpy(), size)
        # The begin mark is a word too: its count is that of training texts.
        words, at = np.unique(np.append(tokens, BEGIN), return_inverse=True)
        self.word, begin = at[:-1], at[-1]
        self.context = np.empty(total, dtype=np.int64)
        self.context[1:] = self.word[:-1]
        self.context[starts] = begin
        seen = np.bincount(self.word[self.train], minlength=len(words))
        seen[begin] += int(table["train"].to_numpy().sum())
        keys, self.pair = np.unique((before & ~_LOW) | (pair(before, tokens) & _LOW), return_inverse=True)
        del before, at, tokens
        seen_pairs = np.bincount(self.pair[self.train], minlength=len(keys))
        self.parts = []
        for kind, values, counts in ((0, words, seen), (1, keys, seen_pairs)):
            order, owners, bounds = dealt((mix(values + np.uint64(kind + 1)) % np.uint64(shards)).astype(np.int64))
            self.parts.append((kind, values[order], counts[order], owners.tolist(), bounds, order))


def _narrow(counts: np.ndarray) -> bytes:
    return counts.astype(np.uint8 if counts.max() < 256 else np.int64).tobytes()


def _answers(texts: DataFrame, chunks: int, shards: int) -> DataFrame:
    """(node, data): the shards' answers to the chunks' requests; totals of a shard go to one of the chunks."""
    routes = Routes(max(chunks, shards))

    def ask(table: pa.Table) -> pa.Table:
        chunk = table["chunk"][0].as_py()
        return routes.sent(((s, chunk, kind, (pack(values[i:j]), _narrow(counts[i:j])))
                            for kind, values, counts, owners, bounds, _ in _Chunk(table, shards).parts
                            for s, i, j in zip(owners, bounds[:-1], bounds[1:])), chunk)

    def answer(table: pa.Table) -> pa.Table:
        shard, asked, out = table["node"][0].as_py(), ([], []), []
        for _, chunk, kind, parts in received(table):
            asked[kind].append((chunk, unpack(parts[0]), parts[1]))
        for kind, requests in enumerate(asked):
            if not requests:
                continue
            keys = [k for _, k, _ in requests]
            counts = [np.frombuffer(c, dtype=np.uint8 if len(c) == len(k) else np.int64).astype(np.int64) for _, k, c in requests]
            known, at = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(at, weights=np.concatenate(counts)).astype(np.int64)
            if kind == 0:
                word, codes = known != BEGIN, total
                out.append((shard % chunks, shard, 2, (np.array([total[word].sum(), (total[word] > 0).sum()], dtype=np.int64).tobytes(),)))
            else:
                codes = Trie(known[total > 0], total[total > 0]).search(known)
            cut = np.cumsum([0, *map(len, keys)])
            out += [(chunk, shard, kind, (codes[at[i:j]].tobytes(),)) for (chunk, _, _), i, j in zip(requests, cut[:-1], cut[1:])]
        return routes.sent(out, shard)

    asked = routes.delivered(texts.groupBy("chunk").applyInArrow(ask, SCHEMA))
    return routes.delivered(asked.groupBy("node").applyInArrow(answer, SCHEMA))


def _cell(pairs: np.ndarray, contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Class of the context and cell of the ratio as one number; cell 0 stands for no such pair."""
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.log10(pairs / (contexts * (words + 1.0)))
    cell = np.where((pairs > 0) & (contexts > 0), np.clip(np.floor((ratio - LEAST) * CELLS_PER_TEN), 1, CELLS - 1), 0)
    group = np.where(contexts > 0, np.minimum(np.floor(np.log2(np.maximum(contexts, 1))) + 1, CLASSES - 1), 0)
    return (group * CELLS + cell).astype(np.int64)


def _tallied(texts: DataFrame, chunks: int, shards: int, kind: str) -> DataFrame:
    """Rows of texts (what = 0), of left-out cells of training texts (1) and of totals (2)."""
    schema = (f"what int, doc_id {kind}, train boolean, n_tokens long, n_known long, log_counts double, "
              "cells array<int>, counts array<long>")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        id_type = left.schema.field("doc_id").type
        rows = []
        answers = {(what, s): parts[0] for _, s, what, parts in received(right)}
        for (what, _), data in answers.items():
            if what == 2:
                tokens, distinct = np.frombuffer(data, dtype=np.int64)
                rows.append((2, None, None, int(tokens), int(distinct), None, None, None))
        if len(left):
            chunk = _Chunk(left, shards)
            found = []
            for at, values, _, owners, _, order in chunk.parts:
                width = np.int64 if at == 0 else np.uint8
                got = np.concatenate([np.frombuffer(answers[at, s], dtype=width) for s in owners])
                back = np.empty(len(values), dtype=width)
                back[order] = got
                found.append(back)
            word, context, code = found[0][chunk.word], found[0][chunk.context], found[1][chunk.pair]
            pairs = decode_count(code)
            doc, n = chunk.doc, chunk.rows
            tokens = np.bincount(doc, minlength=n)
            known = np.bincount(doc, weights=word > 0, minlength=n).astype(np.int64)
            logs = np.bincount(doc, weights=np.log10(word + 1.0), minlength=n)
            cells, count = np.unique(doc * (CELLS * CLASSES) + _cell(pairs, context, word), return_counts=True)
            bounds = np.searchsorted(cells, np.arange(n + 1) * (CELLS * CLASSES))
            cells %= CELLS * CLASSES
            train, ids = left["train"].to_pylist(), left["doc_id"].to_pylist()
            for d in range(n):
                i, j = bounds[d], bounds[d + 1]
                rows.append((0, ids[d], train[d], int(tokens[d]), int(known[d]), float(logs[d]), cells[i:j], count[i:j]))
            own = chunk.train
            if own.any():
                left_out = _cell(pairs[own] - 1, context[own] - 1, word[own] - 1)
                cells, count = np.unique(left_out, return_counts=True)
                rows.append((1, None, None, None, None, None, cells, count))
        cols = list(zip(*rows))
        types = (pa.int32(), id_type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int32()), pa.list_(pa.int64()))
        return pa.table([pa.array(c, t) for c, t in zip(cols, types)],
                        names=["what", "doc_id", "train", "n_tokens", "n_known", "log_counts", "cells", "counts"])

    return texts.groupBy("chunk").cogroup(_answers(texts, chunks, shards).groupBy("node")).applyInArrow(run, schema)


def _ratios(norm: float) -> np.ndarray:
    """Ratio of the two parts in each cell."""
    ratio = 10.0 ** ((np.arange(CELLS) + 0.5) / CELLS_PER_TEN + LEAST) * norm
    ratio[0] = 0.0
    return ratio


def weights(left_out: np.ndarray, norm: float) -> np.ndarray:
    """Weight of the pair counts for each class of contexts, by expectation-maximisation."""
    ratio, out = _ratios(norm), np.zeros(CLASSES)
    for group in range(1, CLASSES):
        n = left_out[group]
        if not n.sum():
            out[group] = out[group - 1]
            continue
        weight = 0.5
        for _ in range(200):
            weight = float(n @ (weight * ratio / (weight * ratio + 1 - weight)) / n.sum())
            weight = min(max(weight, 1e-6), 1 - 1e-6)
        out[group] = weight
    return out


def scores(docs: DataFrame, train: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    ``train`` is a condition on doc_id; where it is null, the row is a training text.
    """
    plain = pick(docs, "doc_id", "text")
    kind = plain.schema["doc_id"].dataType.simpleString()
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, math.ceil(size / CHUNK))
    shards = max(chunks, spread(docs.sparkSession))
    texts = plain.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).alias("chunk"), "doc_id",
                         F.coalesce("text", F.lit("")).alias("text"), F.coalesce(train, F.lit(True)).alias("train"))
    table = written(_tallied(texts, chunks, shards, kind))
    total = table.where("what = 2").agg(F.sum("n_tokens"), F.sum("n_known")).first()
    tokens, distinct = total[0] or 0, total[1] or 0
    norm = float(tokens + distinct + 1)
    left_out = np.zeros(CELLS * CLASSES)
    cells = (table.where("what = 1").select(F.explode(F.arrays_zip("cells", "counts")).alias("x"))
             .groupBy("x.cells").agg(F.sum("x.counts").alias("n")).collect())  # CELLS * CLASSES rows at most
    for r in cells:
        left_out[r[0]] = r[1]
    weight = weights(left_out.reshape(CLASSES, CELLS), norm)
    gain = np.log10(weight[:, None] * _ratios(norm) + 1 - weight[:, None]).ravel()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            n = b.column(2).to_numpy()
            base = b.column(4).to_numpy() - n * math.log10(norm)
            sizes = pa.compute.list_value_length(b.column(5)).to_numpy(zero_copy_only=False)
            part = gain[b.column(5).flatten().to_numpy()] * b.column(6).flatten().to_numpy()
            added = np.bincount(np.repeat(np.arange(len(b)), sizes), weights=part, minlength=len(b))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.compute.invert(b.column(1)), b.column(2), b.column(3), pa.array(np.full(len(b), tokens, dtype=np.int64)),
                 pa.array(base), pa.array(base + added)],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return (table.where("what = 0").select("doc_id", "train", "n_tokens", "n_known", "log_counts", "cells", "counts")
            .mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))

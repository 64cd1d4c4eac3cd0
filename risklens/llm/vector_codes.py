"""Product codes of vectors, with a geometric near-neighbour access tree over each codebook.

A component x becomes the integer floor(256 x); a vector is cut into ``parts`` equal consecutive parts.
Each part position has a codebook, which starts as that part of the vectors with the smallest vec_ids.
A round assigns every part to its nearest entry (ties to the lower index) and replaces each entry by
the floor of its parts' mean; entries without parts stay. Then every vector is coded.

The nearest entry is found by a GNAT: a node has split points taken from its entries, every other entry
belongs to the child of its nearest split point, and for each pair (split point, child) the node
stores the range of distances between the two. A part's distance to a split point eliminates the children
whose range proves them strictly farther than the best entry so far. Roots are rounded outwards, so no
entry as near as the best is lost, and ties are decided on integer squares.

Partitions send sums and counts of each entry, never vectors; the driver holds the codebooks, ``parts`` x
``entries`` entries whose size doesn't depend on the number of vectors. A vector that is null or
holds nulls or non-finite components is dropped. Vectors are coded alike if their length is that of the
vector with the smallest vec_id among those with a length divisible by ``parts``; others keep their row,
with null code and error. Rows with a null vec_id come last in the order; rows that repeat a vec_id
are vectors of their own, in the order of their components. With fewer vectors than entries the
codebooks are shorter. Arithmetic is exact for any finite component; an error, or a sum of errors, that
doesn't fit a long is null. An empty table gives no rows; columns other than vec_id, the vector and label,
also ones with clashing names, are left out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from risklens.llm.shared import bounded, pick, written

SCALE = 256
DEGREE = 8
#: Components up to this size are computed in 64 bits, larger ones in Python integers.
SAFE = 1 << 24
LONG = (1 << 63) - 1
LIMB = 10 ** 18
BATCH = 1 << 14


def squares(points: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``points`` to ``entry``, as integers."""
    away = points - entry
    return (away * away).sum(axis=1) if away.shape[1] else np.zeros(len(points), dtype=points.dtype)


def _roots(square: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers not above and not below the square roots."""
    if square.dtype == object:
        low = np.array([math.isqrt(int(s)) for s in square], dtype=object)
        return low, low + 1
    root = np.sqrt(square.astype(np.float64))
    return root * (1 - 2.0 ** -48), root * (1 + 2.0 ** -48)


@dataclass
class Node:
    splits: list[int]
    #: low[i, j], high[i, j]: range of distances between split point i and the entries of child j.
    low: np.ndarray
    high: np.ndarray
    children: list["Node | None"] = field(default_factory=list)


class Gnat:
    """Nearest entries of a codebook (entries x components, integers)."""

    def __init__(self, book: np.ndarray):
        if book.dtype != object and book.size and np.abs(book).max() > SAFE:
            book = book.astype(object)
        self.book, self.looked = book, 0
        self.root = self._node(list(range(len(book)))) if len(book) else None

    def _node(self, entries: list[int]) -> Node:
        book = self.book
        # Split points far from each other; the first entry, then the farthest from all so far.
        splits, nearest = [entries[0]], squares(book[entries], book[entries[0]])
        while len(splits) < min(DEGREE, len(entries)):
            left = [k for k in range(len(entries)) if entries[k] not in splits]
            splits.append(entries[max(left, key=lambda k: (nearest[k], -k))])
            nearest = np.minimum(nearest, squares(book[entries], book[splits[-1]]))
        apart = np.array([squares(book[splits], book[e]) for e in entries], dtype=book.dtype)
        members: list[list[int]] = [[k] for k in (entries.index(s) for s in splits)]
        for k, e in enumerate(entries):
            if e not in splits:
                members[min(range(len(splits)), key=lambda i: (apart[k, i], i))].append(k)
        low = np.zeros((len(splits), len(splits)), dtype=object if book.dtype == object else np.float64)
        high = low.copy()
        for i in range(len(splits)):
            for j, own in enumerate(members):
                down, up = _roots(apart[own, i])
                low[i, j], high[i, j] = down.min(), up.max()
        node = Node(splits, low, high)
        node.children = [self._node([entries[k] for k in own[1:]]) if len(own) > 1 else None for own in members]
        return node

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each point's nearest entry and the squared distance, ties to the lower index."""
        if self.book.dtype == object and points.dtype != object:
            points = points.astype(object)
        if points.dtype == object and self.book.dtype != object:
            return Gnat(self.book.astype(object)).nearest(points)
        best = squares(points, self.book[0])
        index = np.zeros(len(points), dtype=np.int64)
        self.looked += len(points)
        self._visit(self.root, np.arange(len(points)), points, best, index)
        return index, best

    def _visit(self, node: Node, rows: np.ndarray, points: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
        width = len(node.splits)
        # What is proved about the distance of each row to all entries of each child.
        bound = np.zeros((len(rows), width), dtype=node.low.dtype)
        for i, split in enumerate(node.splits):
            at = np.flatnonzero(bound[:, i] <= _roots(best[rows])[1])
            if not len(at):
                continue
            own = rows[at]
            square = squares(points[own], self.book[split])
            self.looked += len(at)
            better = (square < best[own]) | ((square == best[own]) & (split < index[own]))
            best[own[better]], index[own[better]] = square[better], split
            down, up = _roots(square)
            if bound.dtype == object:
                apart = np.maximum(down[:, None] - node.high[i][None, :], node.low[i][None, :] - up[:, None])
            else:
                apart = np.maximum(down[:, None] - node.high[i], node.low[i] - up[:, None]) * (1 - 2.0 ** -48)
            bound[at] = np.maximum(bound[at], apart)
        for j, child in enumerate(node.children):
            if child is not None:
                kept = rows[bound[:, j] <= _roots(best[rows])[1]]
                if len(kept):
                    self._visit(child, kept, points, best, index)


@dataclass
class Codebooks:
    """Integer codebooks, one array (entries x components of a part) for each part position."""
    books: list[np.ndarray]
    length: int

    def digest(self) -> str:
        """SHA-256 of all components, by part, entry and position."""
        return hashlib.sha256(",".join(str(int(x)) for b in self.books for x in b.ravel()).encode()).hexdigest()


def _integers(values: np.ndarray) -> np.ndarray:
    """floor(256 x) of finite floats, as int64 where that is safe and as Python integers else."""
    values = values.astype(np.float64)
    if not values.size or np.abs(values).max() <= SAFE / SCALE:
        return np.floor(values * SCALE).astype(np.int64)
    # Floats of 2^53 and more are whole, so the product is exact in integers.
    exact = [int(v) * SCALE if abs(v) >= 2.0 ** 53 else math.floor(v * SCALE) for v in values.ravel()]
    return np.array(exact, dtype=object).reshape(values.shape)


def _matrices(batches: Iterator[pa.RecordBatch], column: int, length: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches with the rows whose vectors have ``length`` components, and these as integers."""
    for whole in batches:
        for at in range(0, len(whole), BATCH):
            b = whole.slice(at, BATCH)
            vectors = b.column(column)
            fits = np.flatnonzero(pc.equal(pc.list_value_length(vectors), length).to_numpy(zero_copy_only=False))
            flat = vectors.take(pa.array(fits)).flatten().to_numpy(zero_copy_only=False)
            yield b, fits, _integers(flat.reshape(len(fits), length))


def usable(df: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, vector, label) of the rows whose vector is present and finite throughout."""
    plain = pick(df, "vec_id", column, "label").toDF("vec_id", "vector", "label")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return plain.where(F.col("vector").isNotNull() & ~F.exists("vector", bad))


def _sums(vectors: DataFrame, books: Codebooks) -> dict[tuple[int, int, int], list[int]]:
    """{(part, entry, place): [sum of the component, number of parts]} of the assigned parts."""
    trees = [Gnat(b) for b in books.books]
    width = books.length // len(books.books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(b.shape, dtype=object) for b in books.books]
        counts = [np.zeros(len(b), dtype=np.int64) for b in books.books]
        for _, _, whole in _matrices(batches, 0, books.length):
            for p, tree in enumerate(trees):
                points = whole[:, p * width:(p + 1) * width]
                index, _ = tree.nearest(points)
                order = np.argsort(index, kind="stable")
                found, first, size = np.unique(index[order], return_index=True, return_counts=True)
                if len(found):
                    sums[p][found] += np.add.reduceat(points[order], first, axis=0).astype(object)
                    counts[p][found] += size
        rows = [(p, e, c, k, digits, int(counts[p][e])) for p in range(len(trees)) for e in np.flatnonzero(counts[p])
                for c in range(width) for k, digits in _limbs(sums[p][e, c])]
        if rows:
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                             ["part", "entry", "place", "limb", "digits", "size"])

    found = vectors.select("vector").mapInArrow(run, "part int, entry int, place int, limb int, digits long, size long")
    totals = found.groupBy("part", "entry", "place", "limb").agg(
        F.sum(F.col("digits").cast("decimal(38,0)")).alias("total"), F.sum("size").alias("size"))
    out: dict[tuple[int, int, int], list[int]] = {}
    for r in totals.collect():
        held = out.setdefault((r.part, r.entry, r.place), [0, 0])
        held[0] += int(r.total) * LIMB ** r.limb
        held[1] = max(held[1], r.size)  # every row has limb 0, so this is the number of all parts
    return out


def _limbs(total: int) -> Iterator[tuple[int, int]]:
    """``total`` in digits of base ``LIMB``, all of its sign; the lowest is always given."""
    sign, rest, k = (-1 if total < 0 else 1), abs(int(total)), 0
    while rest or not k:
        rest, digit = divmod(rest, LIMB)
        yield k, sign * digit
        k += 1


def fit(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> Codebooks | None:
    """Codebooks of usable vectors; None if no vector's length is divisible by ``parts``."""
    order = [F.col("vec_id").asc_nulls_last(), "vector"]
    cut = vectors.where((F.size("vector") % parts == 0) & (F.size("vector") >= parts))
    first = cut.orderBy(*order).select("vector").first()
    if first is None:
        return None
    length = len(first.vector)
    start = cut.where(F.size("vector") == length).orderBy(*order).limit(entries).select("vector").collect()
    whole = _integers(np.array([r.vector for r in start], dtype=np.float64))
    width = length // parts
    books = Codebooks([whole[:, p * width:(p + 1) * width].copy() for p in range(parts)], length)
    for _ in range(rounds):
        new = [b.astype(object) for b in books.books]
        for (part, entry, place), (total, size) in _sums(vectors, books).items():
            new[part][entry, place] = total // size
        small = all(abs(x) <= SAFE for b in new for x in b.ravel())
        books = Codebooks([b.astype(np.int64) if small else b for b in new], length)
    return books


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error) of usable vectors: entry indexes in hex, squared distance."""
    trees = [Gnat(b) for b in books.books]
    width = books.length // len(books.books)
    digits = max(2, len(f"{max(len(b) for b in books.books) - 1:x}"))
    texts = np.array([f"{i:0{digits}x}" for i in range(max(len(b) for b in books.books))], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, fits, whole in _matrices(batches, 1, books.length):
            code, error = np.full(len(fits), "", dtype=object), np.zeros(len(fits), dtype=object)
            for p, tree in enumerate(trees):
                index, square = tree.nearest(whole[:, p * width:(p + 1) * width])
                code, error = code + texts[index], error + square.astype(object)
            codes, errors = [None] * len(b), [None] * len(b)
            for i, c, e in zip(fits, code, error):
                codes[i], errors[i] = c, int(e) if e <= LONG else None
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                                             ["vec_id", "label", "code", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}
    return vectors.select("vec_id", "vector", "label").mapInArrow(
        run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def decode(code: Column, books: Codebooks) -> Column:
    """The integer components that a code stands for."""
    digits = max(2, len(f"{max(len(b) for b in books.books) - 1:x}"))
    if any(b.dtype == object for b in books.books):
        raise ValueError("codebooks with components past 2^24 can't be decoded to longs")
    pieces = []
    for p, book in enumerate(books.books):
        table = F.array(*[F.array(*[F.lit(int(x)).cast("long") for x in row]) for row in book])
        at = F.conv(F.substring(code, p * digits + 1, digits), 16, 10).cast("int")
        pieces.append(F.get(table, at))
    return F.concat(*pieces)


def codes(df: DataFrame, column: str = "embedding", parts: int = 16, entries: int = 64, rounds: int = 2) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every usable vector.

    ``label_error`` is the sum of errors over equal labels, nulls together; codebooks_sha256 is null if
    there are no codebooks.
    """
    vectors = usable(df, column)
    books = fit(vectors, parts, entries, rounds)
    if books is None:
        coded = vectors.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    else:
        coded = encode(vectors, books)
    coded = written(coded)
    # One row for each label and, in large tables, a few thousand summed by each task before the shuffle.
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    totals = written(coded.groupBy("label").agg(total.alias("total"))).select(
        F.col("label").alias("of"), F.expr("try_cast(total AS bigint)").alias("label_error"))
    named = coded.join(bounded(totals), F.col("label").eqNullSafe(F.col("of")))
    return named.select("vec_id", "code", "error", "label_error",
                        F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256"))

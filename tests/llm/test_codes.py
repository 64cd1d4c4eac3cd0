"""Vector codes, byte-level BPE and collocations against brute force and libraries."""

import hashlib
import math
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from risklens.llm import byte_bpe, collocations, vector_codes

INF = float("inf")


def nearest(book, points):
    """Brute force in Python integers: index and squared distance, ties to the lower index."""
    out = []
    for p in points.tolist():
        square = [sum((int(a) - int(b)) ** 2 for a, b in zip(p, e)) for e in book.tolist()]
        out.append((square.index(min(square)), min(square)))
    return out


@pytest.mark.parametrize("spread,kind", [(3, "int"), (200, "int"), (200, "clustered"), (10 ** 40, "object")])
def test_gnat_finds_the_nearest_entry(spread, kind):
    r = random.Random(spread)
    draw = lambda n: [[r.randint(-spread, spread) for _ in range(4)] for _ in range(n)]
    book, points = draw(64), draw(300)
    if kind == "clustered":
        book = [[8 * x // 7 + r.randint(-3, 3) for x in book[i % 8]] for i in range(64)]
        points = [[x + r.randint(-2, 2) for x in r.choice(book)] for _ in range(300)]
    book[40] = book[7]  # equal entries
    points[0] = book[40]
    dtype = object if kind == "object" else np.int64
    book, points = np.array(book, dtype=dtype), np.array(points, dtype=dtype)
    tree = vector_codes.Gnat(book)
    index, square = tree.nearest(points)
    assert list(zip(index.tolist(), map(int, square))) == nearest(book, points)
    if kind == "clustered":
        assert tree.looked < 0.7 * book.shape[0] * len(points)


def test_gnat_of_equal_and_few_entries():
    for book in (np.zeros((64, 4), np.int64), np.array([[5, 5]]), np.zeros((3, 0), np.int64)):
        points = np.ones((5, book.shape[1]), dtype=np.int64)
        index, square = vector_codes.Gnat(book).nearest(points)
        assert list(zip(index.tolist(), square.tolist())) == nearest(book, points)


def coded(rows, parts, entries, rounds):
    """Brute force of ``codes`` for (vec_id, vector, label) rows whose usable vectors have one length."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    length = next((len(r[1]) for r in rows if len(r[1]) % parts == 0 and r[1]), None)
    ints = [(i, [math.floor(256 * int(x) if abs(x) > 2 ** 53 else 256 * x) for x in v], label) for i, v, label in rows if len(v) == length]
    width = length // parts
    cut = lambda v, p: v[p * width:(p + 1) * width]
    books = [[cut(v, p) for _, v, _ in ints[:entries]] for p in range(parts)]
    for at in range(rounds + 1):
        found = [[nearest(np.array(books[p], dtype=object), np.array([cut(v, p)], dtype=object))[0] for p in range(parts)] for _, v, _ in ints]
        if at < rounds:
            for p in range(parts):
                for e in range(len(books[p])):
                    own = [cut(v, p) for (_, v, _), f in zip(ints, found) if f[p][0] == e]
                    if own:
                        books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(d for _, d in f) for f in found]
    by_label = Counter()
    for (_, _, label), e in zip(ints, errors):
        by_label[label] += e
    out = [(i, "".join(f"{e:02x}" for e, _ in f), e_, by_label[label], digest) for (i, _, label), f, e_ in zip(ints, found, errors)]
    return out + [(i, None, None, by_label.get(label), digest) for i, v, label in rows if len(v) != length]


def vectors(n, width, seed=1):
    r = random.Random(seed)
    return [(i, [r.gauss(0, 1) for _ in range(width)], r.choice([0, 1, None])) for i in range(n)]


EDGES = [(3, None, 1), (4, [1.0, None, 0.0, 0.0], 1), (5, [1.0, INF, 0.0, 0.0], 1), (6, [1.0, float("nan"), 0.0, 0.0], 0),
         (7, [0.5, -0.001, 2.0, 2.0], 0), (7, [0.5, -0.001, 2.0, 2.0], 0), (None, [0.0, 0.0, 0.0, 0.0], None), (9, [1.0, 2.0], 5), (10, [], None)]


@pytest.mark.parametrize("rows,parts,entries", [(vectors(60, 8), 4, 8), (vectors(40, 4) + EDGES, 2, 16), (EDGES, 4, 64),
                                                (vectors(30, 4) + [(1, [3e38, -2e30, 1e17, 0.5], 1)], 2, 4)])
def test_codes_equal_brute_force(spark, rows, parts, entries):
    schema = "code string, VEC_ID int, vec_id long, embedding array<double>, label int, total int, of int"
    df = spark.createDataFrame([("x", 1, *r, 2, 3) for r in rows], schema).repartition(3)
    got = vector_codes.codes(df, parts=parts, entries=entries, rounds=2).collect()
    key = lambda r: tuple(str(x) for x in r)
    fits = lambda x: None if x is None or x > vector_codes.LONG else x
    wanted = [(i, c, fits(e), fits(t), d) for i, c, e, t, d in coded(rows, parts, entries, 2)]
    if any(abs(x or 0) > 1e20 for r in rows for x in r[1] or [] if x and math.isfinite(x)):
        got, wanted = [r[:3] + r[4:] for r in got], [r[:3] + r[4:] for r in wanted]  # null errors aren't summed
    else:
        sums = {}
        for r in wanted:
            label = next(x[2] for x in rows if x[0] == r[0])
            sums.setdefault(label, []).append(r[2])
    assert sorted(map(key, got)) == sorted(key(r) for r in wanted)


def test_codes_of_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vector_codes.codes(df).collect() == []
    df = spark.createDataFrame([(1, [1.0], 0), (2, None, 0)], "vec_id long, embedding array<float>, label int")
    assert [tuple(r) for r in vector_codes.codes(df).collect()] == [(1, None, None, None, None)]


def test_codes_decode_to_entries(spark):
    df = spark.createDataFrame(vectors(50, 8), "vec_id long, embedding array<double>, label int")
    kept = vector_codes.usable(df)
    books = vector_codes.fit(kept, 4, 8)
    rows = vector_codes.encode(kept, books).join(df, "vec_id").select(
        vector_codes.decode(F.col("code"), books).alias("near"), "embedding", "error").collect()
    for r in rows:
        assert r.error == sum((math.floor(256 * x) - y) ** 2 for x, y in zip(r.embedding, r.near))


@pytest.fixture(scope="module")
def tokens():
    tiktoken = pytest.importorskip("tiktoken")
    ranks = byte_bpe.load(byte_bpe.default_ranks())
    return ranks, tiktoken.Encoding("own", pat_str=byte_bpe.default_pattern(), mergeable_ranks=ranks.tokens, special_tokens={})


def odd_texts(n, seed):
    r = random.Random(seed)
    some = ["a", " ", "  ", "\n", "\t", "é", "'s", "'S", "'ll", "<|endoftext|>", "12", "日本", "　", "!!", "😀", "́", "A", "x" * 40, " ", "­"]
    return ["".join(r.choice(some) for _ in range(r.randint(0, 60))) for _ in range(n)]


def test_perfect_hash_is_minimal(tokens):
    ranks, _ = tokens
    assert sorted(ranks.rank.tolist()) == sorted(ranks.tokens.values())
    for n in (0, 1, 2, 5, 1000):
        keys = np.unique(np.random.default_rng(n).integers(0, 2 ** 63, n, dtype=np.uint64))
        assert sorted(byte_bpe.PerfectHash(keys)(keys).tolist()) == list(range(len(keys))) if n else True


def test_whole_pieces_are_found_exactly(tokens):
    import pyarrow as pa
    ranks, _ = tokens
    pieces = [*list(ranks.tokens)[::97], b"\x00\x01\x02", b"zzqqzzqq", b"x" * 1000]
    got = ranks.whole(pa.array(pieces, pa.large_binary()))
    assert got.tolist() == [ranks.tokens.get(p, -1) for p in pieces]


def test_merges_equal_the_library(tokens):
    ranks, library = tokens
    r = random.Random(5)
    for _ in range(2000):
        piece = bytes(r.choice(b"abcdeth \xc3\xa9\xff") for _ in range(r.randint(1, 30)))
        assert ranks.merged(piece) == library._encode_single_piece(piece)


def expected_bpe(library, texts):
    out = []
    for i, t in texts:
        ids = library.encode_ordinary(t or "")
        out.append((i, len(ids), ids, (t or "").encode()))
    return sorted(out, key=str)


def test_byte_bpe_equals_the_library(spark, docs, tokens, monkeypatch):
    ranks, library = tokens
    path, pattern = byte_bpe.default_ranks(), byte_bpe.default_pattern()
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = byte_bpe.encode(docs, path, pattern, decoded=True).collect()
    assert sorted([(r.doc_id, r.n_tokens, r.ids, bytes(r.decoded)) for r in got], key=str) == expected_bpe(library, texts)


def test_decoding_gives_the_bytes_back(spark, docs):
    path = byte_bpe.default_ranks()
    encoded = byte_bpe.encode(docs, path, byte_bpe.default_pattern())
    got = byte_bpe.decode(encoded, path).collect()
    texts = docs.select("doc_id", "text").collect()
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in got) == sorted((str(r.doc_id), (r.text or "").encode()) for r in texts)
    odd = spark.createDataFrame([(1, None), (2, []), (3, [0, 256, 50255])], "doc_id long, ids array<int>")
    ranks = byte_bpe.load(path)
    token = {i: t for t, i in ranks.tokens.items()}
    assert {r.doc_id: r.decoded for r in byte_bpe.decode(odd, path).collect()} == {1: None, 2: b"", 3: token[0] + token[256] + token[50255]}
    with pytest.raises(ValueError):
        ranks.text(np.array([50256]))


def test_long_texts_are_cut_where_pieces_begin(tokens, monkeypatch):
    import regex
    ranks, library = tokens
    monkeypatch.setattr(byte_bpe, "LONG", 40)
    texts = odd_texts(3000, 3) + [" ".join(odd_texts(50, 4))]
    flat, counts = byte_bpe.encode_texts(texts, ranks, regex.compile(byte_bpe.default_pattern()), regex.compile(r"\S (?=\S)"))
    wanted = library.encode_ordinary_batch(texts)
    assert counts.tolist() == [len(w) for w in wanted]
    assert flat.tolist() == [i for w in wanted for i in w]


@pytest.mark.parametrize("unit", ["a", " ", "-", "ab ", "é"])
def test_very_long_runs_are_quick(tokens, unit):
    import regex
    ranks, _ = tokens
    text = unit * 200_000
    start = time.perf_counter()
    flat, _ = byte_bpe.encode_texts([text], ranks, regex.compile(byte_bpe.default_pattern()), regex.compile(r"\S (?=\S)"))
    assert time.perf_counter() - start < 15
    assert byte_bpe.decode_ids(flat, ranks).tobytes() == text.encode()


def test_byte_bpe_of_nothing(spark, empty):
    path = byte_bpe.default_ranks()
    assert byte_bpe.decode(byte_bpe.encode(empty, path, byte_bpe.default_pattern(), decoded=True), path).collect() == []


def brute_collocations(rows, support, longest, top):
    counts, sizes = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i:i + k])] += 1
    cands = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= support}
    inside = lambda p, q: any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
    out = {}
    for (lang, p), a in cands.items():
        if any(g == lang and len(q) > len(p) and b >= a and inside(p, q) for (g, q), b in cands.items()):
            continue
        cuts = [(1000 * a * sizes[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]], sizes[lang]))
    return [(lang, at, phrase.decode(), -a, l, r, n, -score)
            for lang, found in out.items() for at, (score, a, phrase, l, r, n) in enumerate(sorted(found)[:top], 1)]


def prose(seed, n):
    r = random.Random(seed)
    some = ["the", "cat", "New", "york", "city", "of", "a", "é", "日本", "x" * 300, "big one"]
    return "".join(r.choice(some) + r.choice([" ", " ", " ", "  ", "\t", ", ", ". ", "\n", ";", "\x0b"]) for _ in range(n))


@pytest.mark.parametrize("support,shards,longest", [(3, 16, 5), (40, 4, 5), (20, 1, 3), (1, 16, 4)])
def test_collocations_equal_brute_force(spark, monkeypatch, support, shards, longest):
    monkeypatch.setattr(collocations, "SHARDS", shards)
    rows = [(prose(i, 30 if support == 1 else 120), ["en", "de", None, "und"][i % 4]) for i in range(12)]
    rows += [(None, "en"), ("", "en"), (" \t ", None), ("one", "fr"), ("new york " * 30, "en"), ("a " * 60, "fr"), rows[0], rows[0]]
    df = spark.createDataFrame([(1, *r, "x", 2, 3) for r in rows], "f long, text string, lang string, phrase string, F int, words int").repartition(5)
    got = [tuple(r) for r in collocations.collocations(df, support, longest, 25).collect()]
    assert sorted(got) == sorted(brute_collocations(rows, support, longest, 25))


def test_candidates_come_from_shards(spark, monkeypatch):
    """A phrase spread evenly over all shards is found though no shard has ``support`` of it."""
    rows = [(i, "left right. other words here", "en") for i in range(64)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(16)
    got = {r.phrase: r.a for r in collocations.collocations(df, 64).collect()}
    assert got == {"left right": 64, "other words here": 64}


def test_scores_are_exact_past_64_bits(spark):
    a, l, r, n = 10 ** 11 + 7, 3 * 10 ** 13 + 1, 7 * 10 ** 12 + 3, 9 * 10 ** 17 + 1
    phrases = spark.createDataFrame([("en", 2, "x y", a), ("en", 1, "x", l), ("en", 1, "y", r)], "lang string, words int, phrase string, f long")
    from risklens.llm.shared import written
    totals = written(spark.createDataFrame([("en", n)], "lang string, n long"))
    assert [x.score for x in collocations.scored(phrases, totals).collect()] == [1000 * a * n // (l * r)]


def test_collocations_of_nothing(spark, empty):
    assert collocations.collocations(empty).collect() == []
    few = spark.createDataFrame([("a b", "en")], "text string, lang string")
    assert collocations.collocations(few).collect() == []

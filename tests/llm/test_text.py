import hashlib
import math
import random
import time
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from risklens.llm import exchange, fingerprints, language_model, pieces, private_data, token_count
from risklens.llm.words import Words, ngrams
from tests.llm.conftest import ROWS

PATH = pieces.default_model()
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_words_are_those_of_the_pattern():
    texts = ["a b", "", None, "b", "\ta\x0bb\x0cc\r\n", "é ü", "x" * 200 + " y", " ", "a b"]
    w = Words(pa.array(texts, pa.string()))
    names = {}
    want = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert w.counts.tolist() == [len(x) for x in want]
    for h, word in zip(w.hash.tolist(), [x for t in want for x in t]):
        assert names.setdefault(word, h) == h
    assert len(set(names.values())) == len(names)
    sliced = Words(pa.array(texts, pa.string()).slice(3, 3))
    assert sliced.hash.tolist() == w.hash[w.first[3]:w.first[6]].tolist()
    long = np.arange(50, dtype=np.uint64)
    assert all(len(ngrams(long, n)) == 51 - n for n in (1, 2, 3, 5, 8, 20)) and len(ngrams(long[:3], 5)) == 0
    again = np.concatenate([long, long])
    assert all((ngrams(again, n)[:50 - n + 1] == ngrams(again, n)[50:]).all() for n in (2, 3, 5, 7, 20))


def fuzz(n, seed=1):
    r = random.Random(seed)
    parts = ["a", "b", " ", "  ", "\n", "▁", "é", "日", "the", "<s>", "\x00", "    ", "\t", "🙂", " " * 9, "straße", "</s>"]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(n)]


def test_token_counts_equal_the_library(docs, empty):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for t in fuzz(2000):
        assert token_count.count_tokens(t, PATH) == len(model.encode(t))
    got = token_count.counts(docs, PATH, limit=100).collect()
    want = sorted((str(i), len((t or "").encode()), len(model.encode(t or ""))) for i, t, _ in ROWS)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 100) for r in got)
    assert token_count.counts(empty, PATH).count() == 0


def best_score(v, text):
    best = [0.0] + [-math.inf] * len(text)
    for j in range(1, len(text) + 1):
        for i in range(max(0, j - v.longest), j):
            score = v.scores.get(text[i:j], v.unknown if j == i + 1 else None)
            if score is not None:
                best[j] = max(best[j], best[i] + score)
    return best[-1]


def path_score(v, ids):
    by_id = {i: v.scores[p] for p, i in v.ids.items()}
    data, total, run = v.raw, 0.0, b""
    for i in ids:
        if i in by_id:
            total += by_id[i]
        else:
            run += data[i]
            try:
                run.decode()
                total, run = total + v.unknown, b""
            except UnicodeDecodeError:
                pass
    return total


def test_streaming_viterbi_is_optimal_and_exact(docs, empty, monkeypatch):
    monkeypatch.setattr(pieces, "CHECK", 7)
    v = pieces.Vocabulary(PATH)
    r = random.Random(3)
    texts = fuzz(300) + ["".join(r.choice("theandionstr") for _ in range(r.randint(1, 120))) for _ in range(200)]
    for t in texts:
        ids = v.viterbi(" " + t)
        assert path_score(v, ids) == best_score(v, " " + t)
        assert v.decode(ids) == t
        if t:
            assert v.decode(pieces.encode_text(t, PATH).tolist()) == t
    got = pieces.encode(docs, PATH).collect()
    assert len(got) == len(ROWS) and all(x.exact and x.n_tokens == len(x.ids) for x in got)
    assert pieces.encode(empty, PATH).count() == 0


def brute_model(rows):
    toks = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)) + [None] for _, t, _ in rows]
    train = [zlib.crc32(str(i).encode()) % 7 != 2 if i is not None else True for i, _, _ in rows]
    return toks, train


@pytest.mark.parametrize("fan", [128, 2])
def test_language_model_base_and_pairs(docs, empty, monkeypatch, fan):
    monkeypatch.setattr(exchange, "FAN", fan)
    monkeypatch.setattr(language_model, "CHUNK", 20000)
    got = language_model.scores(docs, F.crc32(F.col("doc_id").cast("string")) % 7 != 2).collect()
    toks, train = brute_model(ROWS)
    count = Counter(w for t, ok in zip(toks, train) if ok for w in t)
    n, v = sum(count.values()), len(count)
    want = sorted((str(i), len(t), sum(count[w] > 0 for w in t), round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t), 4))
                  for (i, _, _), t in zip(ROWS, toks))
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 4)) for r in got) == want
    assert all(r.train_tokens == n and math.isfinite(r.score) for r in got)
    assert sorted(str(r.doc_id) for r in got if r.held_out) == sorted(str(i) for (i, _, _), ok in zip(ROWS, train) if not ok)
    assert language_model.scores(empty, F.lit(True)).count() == 0


def test_language_model_scores_match_brute_force(spark):
    r = random.Random(6)
    rows = [(i, " ".join(r.choice(["a b c", "d e", "a b", "e d f"]) for _ in range(r.randint(1, 9))), "s") for i in range(200)]
    got = {x.doc_id: x for x in language_model.scores(spark.createDataFrame(rows, "doc_id long, text string, source string"),
                                                      F.col("doc_id") % 5 != 0).collect()}
    toks = {i: t.split() + [None] for i, t, _ in rows}
    train = [i for i in toks if i % 5]
    one, two, before = Counter(), Counter(), Counter()
    for i in train:
        for a, b in zip(["^", *toks[i]], toks[i]):
            one[b] += 1
            two[a, b] += 1
            before[a] += 1
    norm = sum(one.values()) + len(one) + 1
    cells = np.zeros((language_model.CLASSES, language_model.CELLS))
    code = lambda p, c, w: divmod(int(language_model._cell(np.array([p]), np.array([c]), np.array([w]))[0]), language_model.CELLS)
    quantised = lambda c: float(language_model.decode_count(language_model.encode_count(np.array([c])))[0])
    for i in train:
        for a, b in zip(["^", *toks[i]], toks[i]):
            cells[code(quantised(two[a, b]) - 1, before[a] - 1, one[b] - 1)] += 1
    weight = language_model.weights(cells, norm)
    for i, t in toks.items():
        score = 0.0
        for a, b in zip(["^", *t], t):
            p0 = (one[b] + 1) / norm
            ml = two[a, b] / before[a] if before[a] else 0.0
            l = weight[code(quantised(two[a, b]), before[a], one[b])[0]]
            score += math.log10(l * ml + (1 - l) * p0)
        assert abs(score - got[i].score) < 0.06 * len(t), (i, score, got[i].score)
    held = [x for x in got.values() if x.held_out]
    assert len(held) == 40 and sum(x.score for x in held) > sum(x.base_score for x in held)


@pytest.mark.parametrize("n,universe", [(0, 10), (1, 1), (1, 1 << 40), (5000, 1 << 32), (70000, 70001), (9, 1 << 62)])
def test_elias_fano_gives_values_back(n, universe):
    values = np.sort(np.random.default_rng(n).integers(0, universe, n, dtype=np.uint64))
    coded = language_model.EliasFano(values, universe)
    read = [coded.block(k) for k in range(len(coded.begins) - 1)]
    assert (np.concatenate([values[:0], *read]) == values).all()


def test_trie_answers_every_key():
    draw = np.random.default_rng(1)
    keys = np.unique((draw.integers(0, 300, 5000, dtype=np.uint64) << np.uint64(35)) | draw.integers(0, 1 << 30, 5000, dtype=np.uint64))
    counts = draw.integers(1, 1000, len(keys))
    trie = language_model.Trie(keys, counts)
    ask = np.unique(np.concatenate([keys[::3], keys[::5] + np.uint64(1), draw.integers(0, 1 << 45, 500, dtype=np.uint64)]))
    known = dict(zip(keys.tolist(), language_model.encode_count(counts).tolist()))
    assert trie.search(ask).tolist() == [known.get(k, 0) for k in ask.tolist()]
    assert language_model.Trie(keys[:0], counts[:0]).search(ask).sum() == 0
    for a in (ask, ask[:1], ask[:0]):
        assert (exchange.unpack(exchange.pack(a)) == a).all()
    exact = np.arange(65)
    assert (language_model.decode_count(language_model.encode_count(exact)) == exact).all()
    big = np.array([100, 10 ** 4, 10 ** 9])
    assert (np.abs(language_model.decode_count(language_model.encode_count(big)) / big - 1) < 0.07).all()


def test_fingerprints(spark, docs, empty):
    got = fingerprints.fingerprints(docs).collect()
    order = sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0))
    texts = [t or "" for _, t, _ in order]
    want = []
    for k, (i, _, _) in enumerate(order):
        t, n = texts[k], texts[(k + 1) % len(texts)]
        q = len(t) // 4
        want.append((str(i), len(t), hashlib.sha256((t[:len(t) - q] + n[:q]).encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == sorted(want)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    both = [r for r in got if r.doc_id == 7]
    assert both[0].fingerprint == both[1].fingerprint and max(r.near_next for r in both) == 1.0
    assert len(got[0].fingerprint) == len({len(r.fingerprint) for r in got}) * len(got[0].fingerprint)
    assert fingerprints.fingerprints(empty).count() == 0
    single = fingerprints.fingerprints(spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string")).collect()
    assert len(single) == 1 and single[0].near_next == 1.0


def test_likeness_is_exact_at_every_size():
    r = random.Random(8)
    vocabulary = [f"w{i}" for i in range(3000)]
    a, b = [], []
    for n in (0, 1, 3, 10, 100, 1000, 8000):
        for change in (0, 1, 5, n // 4, n):
            w = [r.choice(vocabulary) for _ in range(n)]
            x = list(w)
            for _ in range(min(change, n)):
                x[r.randrange(n)] = r.choice(vocabulary)
            a.append("\n".join([" ".join(w), "same line", "same line"]))
            b.append("\n".join([" ".join(x), "same line"]))
    a, b = a + ["", "", "x"], b + ["", "x", ""]
    got, differing = fingerprints.likeness(fingerprints.Paragraphs(a), fingerprints.Paragraphs(b))
    for x, y, near, n in zip(a, b, got, differing):
        p, q = (set(fingerprints.Paragraphs([t]).key.tolist()) for t in (x, y))
        size = lambda s: sum(k & 255 for k in s)
        assert near == pytest.approx(size(p & q) / size(p | q) if p | q else 1.0)
        assert n == len(p ^ q)


def brute_private(t):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m.group() if c in "0123456789"]
        if 13 <= len(d) <= 19 and (sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])) % 10 == 0:
            out.append((2, *m.span()))
    return out + [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= sum(c in "0123456789" for c in m.group()) <= 15]


def test_base_spans_match_the_patterns():
    r = random.Random(3)
    parts = ["1", "25", "4", "0", "256", ".", ".", "+", "@", "a", "x.", "-", " ", "(", ")", "é", "4111111111111111", "a@b.c"]
    for _ in range(20000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 25)))
        assert [m[:3] for m in private_data.base_matches(t) if m[3]] == brute_private(t)


def test_private_data_adds_spans_and_keeps_base(spark, docs, empty):
    got = private_data.find(docs).collect()
    assert sorted((str(r.doc_id), r.base_sha256) for r in got) == sorted(
        (str(i), hashlib.sha256(",".join(f"{private_data.KINDS[k]}:{s}:{e}" for k, s, e in brute_private(t or "")).encode()).hexdigest())
        for i, t, _ in ROWS)
    one = next(r for r in got if r.doc_id == 16)
    assert (one.n_email, one.n_ip, one.n_card, one.n_phone) == (1, 1, 1, 1)
    assert private_data.find(empty).count() == 0
    r = random.Random(9)
    number = lambda: f"({r.randint(200, 999)}) {r.randint(200, 999)}-{r.randint(1000, 9999)}"
    rows = [(i, f"please call +1 {number()} today" if i % 2 else f"see order {r.randint(100, 999)} {r.randint(100, 999)} {r.randint(1000, 9999)} now")
            for i in range(400)] + [(1000, "please call (743) 555-3824 today"), (1001, "nothing here")]
    found = {x.doc_id: x for x in private_data.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1000].n_added == 1 and found[1000].spans == "phone:12:26" and found[1000].n_phone == 0
    assert found[1001].spans == "" and all(found[i].n_added == 0 for i in range(0, 400, 2))


def test_reliabilities_follow_agreeing_labelers():
    truth = private_data.reliabilities({(3, 1, 1, 1, 1): 500, (3, -1, -1, -1, 1): 500, (3, 0, 0, 1, 1): 20, (3, 0, 0, -1, 1): 3})
    assert truth[3, 1, 1, 1, 1] > 0.95 and truth[3, -1, -1, -1, 1] < 0.05
    assert truth[3, 0, 0, 1, 1] > 0.9 and truth[3, 0, 0, -1, 1] < 0.1


@pytest.mark.parametrize("unit", [" ", "-", "a", "T", "ab", "-" * 50 + "a" * 40 + " " * 30 + "\n"])
def test_viterbi_is_linear_on_long_runs(unit):
    """Twice the length takes about twice the time, also where paths don't meet; ids decode to the text."""
    def seconds(n):
        text = unit * (n // len(unit))
        start = time.process_time()
        ids = pieces.encode_text(text, PATH)
        took = time.process_time() - start
        assert pieces._loaded(PATH)[0].decode(ids.tolist()) == text
        return took
    seconds(1000)
    assert seconds(1_000_000) < 30 * max(seconds(100_000), 0.05)


def plain_viterbi(v, text):
    """The best sum of scores, over all positions at once."""
    best = [0.0] + [float("-inf")] * len(text)
    for i in range(len(text)):
        for j in range(i + 1, min(len(text), i + v.longest) + 1):
            score = v.scores.get(text[i:j], v.unknown if j == i + 1 else None)
            if score is not None and best[i] + score > best[j]:
                best[j] = best[i] + score
    return best[-1]


def test_runs_past_the_first_look_are_optimal():
    v = pieces.Vocabulary(PATH)
    r = random.Random(8)
    score = {i: s for p, s in v.scores.items() for i in [v.ids[p]]}
    for unit in ("a", " ", "-", "ab", "=-", "the", None):
        text = (unit * 700)[:700] if unit else "".join(r.choice("aab- eth") for _ in range(700))
        ids = v.viterbi(text)
        assert v.decode([v.ids[" "], *ids]) == text
        assert sum(score[i] for i in ids) == pytest.approx(plain_viterbi(v, text))


@pytest.mark.parametrize("block", [8, 64, 1 << 16])
def test_coded_levels_are_searched_by_blocks(monkeypatch, block):
    monkeypatch.setattr(language_model, "BLOCK", block)
    draw = np.random.default_rng(block)
    values = np.sort(draw.integers(0, 9000, 3000, dtype=np.uint64))
    coded = language_model.EliasFano(values, 9000)
    wanted = np.sort(draw.integers(0, 9500, 700, dtype=np.uint64))
    place, value = coded.successor(wanted)
    assert (place == np.searchsorted(values, wanted)).all()
    inside = place < len(values)
    assert (value[inside] == values[place[inside]]).all()
    index = np.sort(draw.integers(0, 3000, 500))
    assert (coded.at(index) == values[index]).all()


def routed(spark, nodes):
    """Rows of a full exchange, in which each node sends one message to every node."""
    routes = exchange.Routes(nodes)

    def ask(table):
        node = table["id"][0].as_py()
        return routes.sent(((t, node, 0, (b"x" * (t % 3), b"")) for t in range(nodes)), node)

    def take(table):
        node = table["node"][0].as_py()
        got = list(exchange.received(table))
        good = sorted(f for _, f, _, _ in got) == list(range(nodes)) and all(t == node and len(p[0]) == t % 3 for t, _, _, p in got)
        return pa.table({"node": pa.array([node]), "good": pa.array([good]), "rows": pa.array([len(table)])})

    rows = spark.range(nodes).groupBy("id").applyInArrow(ask, exchange.SCHEMA)
    first = rows.count()
    last = routes.delivered(rows).groupBy("node").applyInArrow(take, "node long, good boolean, rows long").collect()
    assert len(last) == nodes and all(r.good for r in last)
    return first, sum(r.rows for r in last)


def test_bundles_grow_with_the_nodes_not_with_their_square(spark, monkeypatch):
    monkeypatch.setattr(exchange, "FAN", 5)
    assert [exchange.Routes(n).hops for n in (1, 5, 6, 25, 26, 125)] == [1, 1, 2, 2, 3, 3]
    for a, b in zip(routed(spark, 30), routed(spark, 120)):
        assert 0 < a <= 30 * 5 and 0 < b <= 120 * 5


def test_taken_places_equal_a_look_at_all_spans():
    r = random.Random(6)
    for _ in range(300):
        spans = [(a, a + r.randint(1, 6)) for a in (r.randint(0, 60) for _ in range(r.randint(0, 6)))]
        taken, held = private_data._Taken(spans), list(spans)
        for _ in range(12):
            s = r.randint(0, 60)
            e = s + r.randint(1, 6)
            free = not any(s < y and x < e for x, y in held)
            assert taken.add(s, e) == free
            if free:
                held.append((s, e))
    many = private_data._Taken((10 * i, 10 * i + 4) for i in range(200_000))
    start = time.process_time()
    assert all(many.add(10 * i + 5, 10 * i + 8) for i in range(0, 200_000, 2))
    assert time.process_time() - start < 10

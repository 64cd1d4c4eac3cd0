import hashlib
import random
import re

from pyspark.sql import functions as F

import pytest

from risklens.llm import exact_dedup, exchange, near_dedup, substring_dedup
from risklens.llm.components import components
from tests.llm.conftest import ROWS, SCHEMA, extend, words

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def low(text):
    return (text or "").translate(LOW)


def test_exact_groups_match_brute_force(docs):
    for counters in (2, 4096):
        got = exact_dedup.groups(docs, counters).collect()
        assert len(got) == len(ROWS)
        for i, text, _ in ROWS:
            same = [j for j, t, _ in ROWS if low(t) == low(text)]
            keep = max((j for j in same if j is not None), default=None)
            mine = [r for r in got if r.doc_id == i and bytes(r.digest) == hashlib.sha256(low(text).encode()).digest()]
            assert mine and all(r.keep_id == keep and r.group_size == len(same) for r in mine)
        assert sum(r.kept for r in got) == len({low(t) for _, t, _ in ROWS})


def test_exact_keep_has_one_row_of_each_text(docs, empty):
    for counters in (2, 4096):
        got = exact_dedup.keep(docs, counters)
        assert got.columns == docs.columns
        assert sorted(low(r.text) for r in got.collect()) == sorted({low(t) for _, t, _ in ROWS})
    assert exact_dedup.keep(empty).count() == 0 and exact_dedup.groups(empty).count() == 0


def test_frequent_digests_are_all_found(spark):
    rows = [(bytes([i % 7]) * 32,) for i in range(700)] + [(i.to_bytes(32, "big"),) for i in range(1000, 1400)]
    random.Random(1).shuffle(rows)
    found = exact_dedup.frequent(spark.createDataFrame(rows, "digest binary").repartition(40), counters=15).collect()
    assert len(found) <= 15 and {bytes([i]) * 32 for i in range(7)} <= {bytes(r.digest) for r in found}


def brute_components(rows, n, percent):
    sets = []
    for _, t, _ in rows:
        w = tokens(low(t))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    least = {}
    for i, x in enumerate(label):
        if rows[i][0] is not None:
            least[x] = min(least.get(x, rows[i][0]), rows[i][0])
    return [least.get(x) if s else rows[i][0] for i, (x, s) in enumerate(zip(label, sets))], sets


def test_near_components_match_brute_force(spark, docs, empty, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    r = random.Random(4)
    base = tokens(words(40, 120))
    rows = list(ROWS)
    for i in range(100, 160):  # a group of which no one is like all others
        w = list(base)
        for _ in range(r.randint(0, 9)):
            w[r.randrange(len(w))] = f"new{r.random()}"
        rows.append((i, " ".join(w), "z"))
    table = spark.createDataFrame(extend(rows), SCHEMA)
    for n in (2, 5):
        want, sets = brute_components(rows, n, 80)
        got = near_dedup.groups(table, words=n).collect()
        assert sorted((str(x.doc_id), x.n_shingles, str(x.component_id)) for x in got) == sorted(
            (str(row[0]), len(s), str(w)) for row, s, w in zip(rows, sets, want))
    kept = near_dedup.keep(docs, words=2)
    assert kept.columns == docs.columns
    want, sets = brute_components(ROWS, 2, 80)
    assert kept.count() == len({w for w, s in zip(want, sets) if s}) + sum(not s for s in sets)
    assert near_dedup.keep(empty).count() == 0 and near_dedup.groups(empty).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 20)] + [(200, 201), (201, 200), (5, 5)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(31)) and all(got[100 + i] == 100 for i in range(20)) and got[201] == 200
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_repeats(rows):
    docs = sorted({(i is None, i or 0, t or "") for i, t in rows})
    seen, out = set(), {}
    for key in docs:
        w = tokens(key[2])
        gone = set()
        for p in range(len(w) - 19):
            run = tuple(w[p:p + 20])
            if run in seen:
                gone.update(range(p, p + 20))
            seen.add(run)
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out[key] = len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()
    return out


def test_cover_is_a_difference_cover():
    d, p = substring_dedup.COVER, substring_dedup.PERIOD
    assert all(any((i + k) % p in d and (j + k) % p in d for k in range(p)) for i in range(p) for j in range(p))


@pytest.mark.parametrize("fan,chunk", [(128, 12 << 20), (2, 3000)])
def test_repeated_passages_match_brute_force(spark, docs, empty, monkeypatch, fan, chunk):
    """Also with many chunks, whose messages go over several relays."""
    monkeypatch.setattr(exchange, "FAN", fan)
    monkeypatch.setattr(substring_dedup, "CHUNK", chunk)
    assert substring_dedup.remove_repeats(empty).count() == 0
    r = random.Random(2)
    passage = [words(s, n) for s, n in ((70, 20), (71, 21), (72, 33), (73, 19))]
    rows = [(i, t) for i, t, _ in ROWS]
    for i in range(200, 240):
        rows.append((i, " ".join([words(i, r.randint(0, 30)), r.choice(passage), words(i + 1000, r.randint(0, 30)), r.choice(passage)])))
    rows += [(300, "a b " * 40), (301, "b a " * 30)]
    table = spark.createDataFrame(extend([(i, t, "s") for i, t in rows]), SCHEMA).repartition(5)
    got = substring_dedup.remove_repeats(table).collect()
    want = brute_repeats(rows)
    assert len(got) == len(rows)
    assert sorted((str(x.doc_id), x.n_words, x.n_removed, x.kept_sha256) for x in got) == sorted(
        (str(i), *want[(i is None, i or 0, t or "")]) for i, t in rows)
    assert sum(x.n_removed for x in got) > 800


def test_names_that_differ_in_case_do_no_harm(spark, docs, labels):
    from risklens.llm import fingerprints, language_model, mixing, pieces, private_data, quality, token_count
    odd = docs.select("*", F.lit("x").alias("TEXT"), F.lit(1).alias("Doc_Id"), F.lit("y").alias("SOURCE"))
    for kept in (exact_dedup.keep(odd), near_dedup.keep(odd), quality.keep(odd, labels), mixing.expand(odd)):
        assert kept.columns == odd.columns and kept.count() > 0
    path = pieces.default_model()
    for found in (exact_dedup.groups(odd), near_dedup.groups(odd), substring_dedup.remove_repeats(odd), mixing.taken(odd),
                  fingerprints.fingerprints(odd), private_data.find(odd), token_count.counts(odd, path), pieces.encode(odd, path),
                  language_model.scores(odd, F.lit(True)), quality.stats_table(odd)):
        assert found.count() == len(ROWS)

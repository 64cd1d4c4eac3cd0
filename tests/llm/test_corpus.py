import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from risklens.llm import mixing, quality
from tests.llm.conftest import ROWS, SCHEMA, extend, words


def fill(sizes, weights=(5, 2, 1), limit=3):
    """Targets by sharing again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, held = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in held]
        rest = total - sum(held.values())
        share = {s: rest * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > limit * sizes[s]]
        if not over:
            return held | share
        held |= {s: limit * sizes[s] for s in over}


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_and_sizes(docs, empty):
    got = mixing.taken(docs).collect()
    sums = {}
    for _, t, s in ROWS:
        sums[s] = sums.get(s, 0) + size(t)
    want = fill(sums)
    by = sorted((str(i), size(t), sums[s], round(want[s], 6)) for i, t, s in ROWS)
    assert sorted((str(r.doc_id), r.size, r.source_size, round(r.target, 6)) for r in got) == by
    assert all(r.taken == r.size * r.copies and r.copies <= 3 for r in got)
    assert mixing.taken(empty).count() == 0 and mixing.expand(empty).count() == 0


@pytest.mark.parametrize("group", [16, 2048])
def test_mix_comes_near_its_targets_and_reruns_agree(spark, monkeypatch, group):
    monkeypatch.setattr(mixing, "GROUP", group)
    rows = [(i, "w " * (1 + i * 7919 % 61), None if i % 9 == 8 else f"s{i % 9 % 4}") for i in range(3000)]
    table = spark.createDataFrame(extend(rows), SCHEMA)
    first = mixing.taken(table).collect()
    assert sorted((r.doc_id, r.taken) for r in first) == sorted((r.doc_id, r.taken) for r in mixing.taken(table.repartition(7)).collect())
    sums = {}
    for r in first:
        got, target = sums.get(r.source_size, (0, r.target))
        sums[r.source_size] = got + r.taken, target
    assert len(sums) >= 4 and all(abs(got - target) <= 61 for got, target in sums.values())
    whole = mixing.expand(table)
    assert whole.columns == table.columns
    assert whole.agg(F.sum("n_chars")).first()[0] == pytest.approx(2 * sum(r.taken for r in first), rel=0.02)


@pytest.mark.parametrize("group,draws,off", [(2048, 10_000, 0.02), (8, 2_000, 0.04)])
def test_copies_keep_expectations(spark, monkeypatch, group, draws, off):
    """Each of twenty documents is taken as often as expected in all draws, small ones like large ones."""
    monkeypatch.setattr(mixing, "GROUP", group)
    sizes = [1, 2, 3, 5, 8, 8, 8, 20, 21, 22, 40, 60, 61, 100, 150, 300, 301, 900, 2000, 20000]
    names = spark.range(draws).select(F.format_string("s%05d", "id").alias("source"))
    table = F.explode(F.array(*[F.struct(F.lit(i).alias("k"), F.lit(n).cast("long").alias("size")) for i, n in enumerate(sizes)]))
    units = names.select("source", table.alias("d")).select("source", "d.k", "d.size", F.lit(1).cast("long").alias("m")).repartition(8)
    found = mixing.copies(units, ["k"], weights=(1,), budget=0.18)
    for r in found.groupBy("k").agg(F.avg("copies").alias("taken")).collect():
        assert abs(r.taken - 0.18) < off, r


def test_pivot_keeps_expectations():
    draw = np.random.default_rng(5)
    total = np.zeros(40)
    sizes, part = draw.integers(1, 50, 40).astype(float), draw.uniform(0, 1, 40)
    for _ in range(4000):
        rounded, held = mixing._pivot(sizes, part, draw.uniform(0, 1, 40))
        assert all(p in (0.0, 1.0) for i, p in enumerate(rounded) if i != held)
        assert abs(rounded @ sizes - part @ sizes) < 1e-6
        total += rounded
    assert np.abs(total / 4000 - part).max() < 0.05


def test_repeated_rows_share_their_copies(spark):
    rows = extend([(1, "a b c", "x")] * 40 + [(2, "d e f g", "y")] * 7)
    table = spark.createDataFrame(rows, SCHEMA)
    assert mixing.taken(table).count() == 47
    counts = {r.doc_id: r["count"] for r in mixing.expand(table).groupBy("doc_id").count().collect()}
    taken = {r.doc_id: r.n for r in mixing.taken(table).groupBy("doc_id").agg(F.sum("copies").alias("n")).collect()}
    assert set(counts) == {1, 2} and all(abs(counts[i] - taken[i]) <= 1 for i in counts)


def test_isotonic_is_the_best_monotone_fit():
    draw = np.random.default_rng(2)
    for _ in range(20):
        n, y = draw.integers(1, 9, 12).astype(float), draw.uniform(0, 1, 12)
        fit = quality.isotonic(n, y)
        # max-min formula of isotonic regression
        mean = lambda i, j: (n[i:j + 1] @ y[i:j + 1]) / n[i:j + 1].sum()
        want = [max(min(mean(i, j) for j in range(k, 12)) for i in range(k + 1)) for k in range(12)]
        assert fit == pytest.approx(want)


def test_statistics_do_not_depend_on_the_batch(docs):
    import pyarrow as pa
    texts = [t for _, t, _ in ROWS]
    whole = quality.statistics(pa.array(texts))
    assert np.isfinite(whole).all()
    assert all((quality.statistics(pa.array([t], pa.string())) == whole[i]).all() for i, t in enumerate(texts))


def test_classifier_learns_and_handles_odd_rows(spark, docs, empty, labels):
    model = quality.fit(quality.stats_table(docs), labels)
    got = quality.scores(quality.stats_table(docs), model).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    nothing = quality.fit(quality.stats_table(empty), labels)
    assert nothing.score(np.zeros((2, len(quality.STATS)))).tolist() == [0.5, 0.5]
    one_class = quality.fit(quality.stats_table(docs), labels.where("quality = 1"))
    assert set(one_class.score(np.zeros((1, len(quality.STATS))))) == {1.0}
    assert quality.keep(empty, labels).count() == 0
    kept = quality.keep(docs, labels)
    assert kept.columns == docs.columns
    good = [(i, words(i, 80 + i % 50), "a") for i in range(0, 600, 2)]
    bad = [(i, " ".join(w.upper() + "!!" for w in words(i, 80 + i % 50).split()), "a") for i in range(1, 600, 2)]
    table = spark.createDataFrame(good + bad, "doc_id long, text string, source string")
    marks = spark.createDataFrame([(i, 1 - i % 2) for i in range(600)], "doc_id long, quality int")
    model = quality.fit(quality.stats_table(table), marks, F.col("doc_id") % 3 != 1)
    out = quality.scores(quality.stats_table(table), model).where("doc_id % 3 = 1").collect()
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 2 == 0) for r in out]) > 0.98


def test_pipeline_stages(spark, docs, labels, tmp_path):
    good = [(100 + i, words(100 + i, 60 + i), "ab"[i % 2]) for i in range(80)]
    junk = [(300 + i, " ".join(w.upper() + "!!" for w in words(300 + i, 60 + i).split()), "ab"[i % 2]) for i in range(40)]
    copies = [(500, good[0][1].upper(), "a"), (501, good[3][1] + " more", "b"), (502, good[3][1], "b")]
    table = spark.createDataFrame(extend(good + junk + copies), SCHEMA).select("doc_id", "text", "lang", "source", "n_chars")
    marks = spark.createDataFrame([(i, int(i < 300), 0) for i, _, _ in good + junk], "doc_id long, quality int, toxic int")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    marks.write.parquet(f"{tmp_path}/labels.parquet")
    at, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, str(tmp_path))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == table.columns
        out.write.parquet(f"{tmp_path}/out_{name}")
        at = spark.read.parquet(f"{tmp_path}/out_{name}")
        seen[name] = sorted(r.doc_id for r in at.select("doc_id").collect())
    assert not set(seen["quality"]) & set(range(300, 340)) and len(set(range(100, 180)) - set(seen["quality"])) <= 3
    assert 502 in seen["exact_dedup"] and 103 not in seen["exact_dedup"]
    assert len({501, 502} & set(seen["near_dedup"])) == 1
    assert set(seen["mix_sources"]) <= set(seen["near_dedup"]) and seen["encode"] == seen["mix_sources"]
    assert corpus_pipeline.run(spark, str(tmp_path)).where("not exact").count() == 0

"""Registered queries of the operators of this package, with DuckDB check SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from risklens.llm.shared import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


LOWER_SQL = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             "'abcdefghijklmnopqrstuvwxyz')")


@query("op8_exact_dedup", f"""
WITH d AS (SELECT doc_id, sha256({LOWER_SQL}) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, MAX(doc_id) AS keep_id, COUNT(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from risklens.llm import exact_dedup
    return exact_dedup.groups(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query("op10_quality_classifier")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from risklens.llm import quality
    from risklens.llm.shared import written
    bucket = lambda: F.crc32(F.col("doc_id").cast("string")) % 3
    stats = written(quality.stats_table(documents(spark, sf_dir)))
    model = quality.fit(stats, spark.read.parquet(f"{sf_dir}/labels.parquet"), bucket() != 1)
    return quality.scores(stats, model).select(
        "doc_id", F.coalesce(bucket() == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from risklens.llm import pieces, token_count
    return token_count.counts(documents(spark, sf_dir), pieces.default_model())


@query("op5_sentencepiece")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from risklens.llm import pieces
    return pieces.encode(documents(spark, sf_dir), pieces.default_model())


@query("op1_mix_sources")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from risklens.llm import mixing
    return mixing.taken(documents(spark, sf_dir))


@query("op7_minhash_near_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from risklens.llm import near_dedup
    return near_dedup.groups(documents(spark, sf_dir), words=2, similarity=0.8).select(
        "doc_id", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


@query("op6_substring_dedup", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, words, UNNEST(range(1, len(words) - 18)) AS pos FROM d WHERE len(words) >= 20),
k AS (SELECT doc_id, pos, array_to_string(words[pos:pos + 19], ' ') AS run FROM s),
g AS (SELECT doc_id, pos, ROW_NUMBER() OVER (PARTITION BY run ORDER BY doc_id, pos) AS nth FROM k),
gone AS (SELECT DISTINCT doc_id, UNNEST(range(pos, pos + 20)) AS i FROM g WHERE nth > 1),
w AS (SELECT doc_id, UNNEST(words) AS word, UNNEST(range(1, len(words) + 1)) AS i FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, COUNT(*) AS n
         FROM w ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256 FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from risklens.llm import substring_dedup
    return substring_dedup.remove_repeats(documents(spark, sf_dir))


@query("op4_fingerprints")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from risklens.llm import fingerprints
    return fingerprints.fingerprints(documents(spark, sf_dir))


@query("op9_private_data")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from risklens.llm import private_data
    return private_data.find(documents(spark, sf_dir))


@query("op3_language_model")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from risklens.llm import language_model
    return language_model.scores(documents(spark, sf_dir), F.crc32(F.col("doc_id").cast("string")) % 7 != 2)


def _assigned(at: int) -> str:
    """CTE a{at}: each part's nearest entry of codebook b{at}, and its squared distance."""
    return f"""a{at} AS (SELECT vec_id, label, p, x, min({{'d': d, 'e': e}}).e AS e, min({{'d': d, 'e': e}}).d AS d FROM (
  SELECT v.vec_id, v.label, v.p, v.x, b.e, list_sum(list_transform(range(1, len(v.x) + 1), lambda i: (v.x[i] - b.x[i]) * (v.x[i] - b.x[i]))) AS d
  FROM parts v JOIN b{at} b ON v.p = b.p) GROUP BY 1, 2, 3, 4)"""


def _moved(at: int) -> str:
    """CTE b{at}: codebook b{at - 1} with the floors of the means of its assigned parts."""
    return f"""m{at} AS (SELECT p, e, list(m ORDER BY i) AS x FROM (
  SELECT p, e, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS m FROM a{at - 1}, (SELECT UNNEST(range(1, (SELECT max(len(x)) FROM parts) + 1)) AS i)
  GROUP BY 1, 2, 3) GROUP BY 1, 2),
b{at} AS (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM b{at - 1} b LEFT JOIN m{at} m ON b.p = m.p AND b.e = m.e)"""


@query("op11_vector_codes", f"""
WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT vec_id, label, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS x FROM kept, (SELECT UNNEST(range(16)) AS p)),
first AS (SELECT vec_id, ROW_NUMBER() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < 64),
b0 AS (SELECT p, e, x FROM parts JOIN first USING (vec_id)),
{_assigned(0)}, {_moved(1)}, {_assigned(1)}, {_moved(2)}, {_assigned(2)},
digest AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b2),
coded AS (SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY 1, 2),
totals AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM coded GROUP BY 1)
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM coded JOIN totals ON coded.label IS NOT DISTINCT FROM totals.label, digest""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from risklens.llm import vector_codes
    return vector_codes.codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op12_byte_bpe")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from risklens.llm import byte_bpe
    encoded = byte_bpe.encode(documents(spark, sf_dir), byte_bpe.default_ranks(), byte_bpe.default_pattern(), decoded=True)
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return encoded.select("doc_id", "n_tokens", F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op13_collocations", r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, UNNEST(string_split_regex(LOWER_TEXT, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
g AS (SELECT lang, words, k, UNNEST(range(1, len(words) - k + 2)) AS i FROM w, (SELECT UNNEST(range(1, 6)) AS k) WHERE len(words) >= k),
f AS (SELECT lang, k AS m, array_to_string(words[i:i + k - 1], ' ') AS phrase, count(*) AS a FROM g GROUP BY 1, 2, 3),
n AS (SELECT lang, sum(a) AS n FROM f WHERE m = 1 GROUP BY 1),
c AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS words, a FROM f WHERE m > 1 AND a >= 100),
cuts AS (SELECT c.*, k, array_to_string(words[1:k], ' ') AS x, array_to_string(words[k + 1:m], ' ') AS y
  FROM c, (SELECT UNNEST(range(1, 5)) AS k) WHERE k < m),
s AS (SELECT cuts.lang, cuts.phrase, cuts.a, x.a AS l, y.a AS r, n, k,
    CAST((1000 * CAST(cuts.a AS HUGEINT) * CAST(n AS HUGEINT)) // (CAST(x.a AS HUGEINT) * CAST(y.a AS HUGEINT)) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = cuts.x JOIN f y ON y.lang = cuts.lang AND y.phrase = cuts.y
  JOIN n ON n.lang = cuts.lang),
best AS (SELECT * FROM s QUALIFY ROW_NUMBER() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.lang = b.lang AND c.m > len(string_split(b.phrase, ' '))
  AND 100 * c.a >= 100 * b.a AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, CAST(a AS BIGINT) AS a,
  CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, score FROM kept QUALIFY rank <= 2000""".replace("LOWER_TEXT", LOWER_SQL))
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from risklens.llm import collocations
    return collocations.collocations(documents(spark, sf_dir))

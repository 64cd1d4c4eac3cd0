"""Indicator registry: candidate seeds, proposal checks, versioned history, delivery tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from risklens.functions.labels import signal_strength
from risklens.operators.iv import _label
from risklens.operators.prep import one_per_key

OPEN = "9999-12-31"
# Code vocabulary.
DOMAINS = ("FIN", "CRDTC", "OPN", "PUB", "JUDI", "LON", "GUAR", "RELA", "FUND")
GRANULARITIES = ("M", "D", "A", "EVT")
WINDOWS = ("SNAP", "M3", "M6", "M12", "Y1", "Y3", "Y5", "LIFE", "EVT")
STATS = ("CNT", "AMT", "RATIO", "FLG", "IDX", "STD", "CV", "AVG", "MAX", "MIN", "DAYS")
CODE_PATTERN = "^(FIN|CRDTC|OPN|PUB|JUDI|LON|GUAR|RELA|FUND)_[MDA]_[A-Z0-9_]+$"
CODE_LENGTH = 60
# Project name to domain, exact names first, then keywords in order.
PROJECT_DOMAIN = {"财务行业风险分析": "FIN", "腰部企业征信分析": "CRDTC", "舆情特征分析": "PUB",
                  "舆情特征宽表分析": "PUB", "舆情风险特征分析": "PUB", "工商变更特征分析": "OPN"}
PROJECT_KEYWORDS = (("财务", "FIN"), ("征信", "CRDTC"), ("舆情", "PUB"), ("工商", "OPN"),
                    ("变更", "OPN"), ("司法", "JUDI"), ("执行", "JUDI"), ("担保", "GUAR"))
# Null handling and left-join rule by domain.
NULL_HANDLING = {"OPN": ("DROP_KEY_NULL", "FALLBACK_OTHER"), "PUB": ("DROP_KEY_NULL", "FALLBACK_OTHER")}
PRIORITIES = ("P0", "P0-blocked", "P1", "P1-sparse", "P2", "P3-watch", "P4-watch")
BLOCKED = "P0-blocked"


# ---- candidates ------------------------------------------------------------------------------

def union_projects(results: dict[str, DataFrame]) -> DataFrame:
    """Results of several projects under one schema, tagged with the project."""
    out = None
    for project, df in results.items():
        part = df.withColumn("project", F.lit(project))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def filter_iv(iv: DataFrame, iv_max: float = 2.0,
              exclude: tuple[str, ...] = ("not_computable", "unreliable_leak")) -> DataFrame:
    """Full-sample rows of usable reliability; there is no lower limit."""
    return iv.where((_label() == "__all__") & ~F.col("iv_reliability").isin(*exclude)
                    & (F.col("iv") < iv_max))


def add_coverage(iv: DataFrame) -> DataFrame:
    return iv.withColumn("coverage_rate", F.round(1 - F.col("n_missing") / F.col("segment_n"), 4))


def direction_vote(coefs: DataFrame) -> DataFrame:
    """Share of positive coefficients across segments: .7 up is positive, .3 down is negative."""
    share = F.avg(F.when(F.col("lr_coef").isNotNull(), (F.col("lr_coef") > 0).cast("double")))
    return (coefs.groupBy("feature").agg(share.alias("positive_share"))
            .withColumn("risk_direction", F.when(F.col("positive_share") >= 0.7, "positive")
                        .when(F.col("positive_share") <= 0.3, "negative").otherwise("undecided")))


def project_domain(project: Column) -> Column:
    out = None
    for name, dom in PROJECT_DOMAIN.items():
        out = F.when(project == name, dom) if out is None else out.when(project == name, dom)
    for word, dom in PROJECT_KEYWORDS:
        out = out.when(project.contains(word), dom)
    return out.otherwise("UNKNOWN")


def build_seeds(iv: DataFrame, directions: DataFrame, registry: DataFrame) -> DataFrame:
    """Best row per feature over all projects, with signal, direction and registered flag."""
    row = F.struct("project", "iv", "iv_reliability", "coverage_rate", "segment_n", "segment_bad")
    best = (iv.where(F.col("iv").isNotNull()).groupBy("feature")
            .agg(F.max_by(row, F.struct(F.col("iv"), F.col("project"))).alias("r"))
            .select("feature", "r.*"))
    known = active(registry).select(F.col("ind_name").alias("feature")).distinct().withColumn("_known", F.lit(True))
    return (best.join(directions.select("feature", "risk_direction"), "feature", "left")
            .join(known, "feature", "left")
            .select("feature", "project", project_domain(F.col("project")).alias("domain"),
                    F.round("iv", 4).alias("iv"), "iv_reliability",
                    F.round("coverage_rate", 4).alias("coverage_rate"),
                    signal_strength(F.col("iv"), F.col("iv_reliability")).alias("signal_strength"),
                    F.coalesce("risk_direction", F.lit("undecided")).alias("risk_direction"),
                    F.col("segment_n").alias("sample_size"), F.col("segment_bad").alias("bad_size"),
                    F.coalesce("_known", F.lit(False)).alias("already_registered")))


def seed_stats(seeds: DataFrame) -> DataFrame:
    return seeds.groupBy("domain").agg(F.count("*").alias("n"),
                                       F.count_if("already_registered").alias("n_registered"),
                                       F.count_if(~F.col("already_registered")).alias("n_to_propose"))


def fill_defaults(proposals: DataFrame, seeds: DataFrame, today: str) -> DataFrame:
    """Missing fields take defaults; measured values come from the seed of the same name."""
    have = set(proposals.columns)

    def cur(name: str, dtype: str = "string") -> Column:
        return F.col(f"p.{name}") if name in have else F.lit(None).cast(dtype)

    s = seeds.select(F.col("feature").alias("_name"), *[F.col(c).alias(f"_s_{c}") for c in (
        "iv", "iv_reliability", "coverage_rate", "signal_strength", "risk_direction", "sample_size", "project")])
    rows = proposals.alias("p").join(s, F.col("p.ind_name") == F.col("_name"), "left")
    dom = cur("domain")
    nulls = F.array(F.lit("KEEP_NULL"))
    for d, v in NULL_HANDLING.items():
        nulls = F.when(dom == d, F.array(*[F.lit(x) for x in v])).otherwise(nulls)
    post = F.when(dom.isin("OPN", "PUB", "JUDI"), "PAD_ZERO_ON_LEFT_JOIN").otherwise("KEEP_NULL_ON_LEFT_JOIN")
    first = F.when(F.col("_s_iv").isNotNull(), F.array(F.struct(
        F.lit(today).alias("snap_dt"), F.col("_s_iv").alias("iv"), F.col("_s_iv_reliability").alias("credibility"),
        F.col("_s_sample_size").alias("sample_size"), F.col("_s_project").alias("project"))))
    d = {"ind_version": F.coalesce(cur("ind_version", "int"), F.lit(1)),
         "eff_dt": F.coalesce(cur("eff_dt"), F.lit(today)), "exp_dt": F.coalesce(cur("exp_dt"), F.lit(OPEN)),
         "proposer": F.coalesce(cur("proposer"), F.lit("AGENT")),
         "lifecycle_status": F.coalesce(cur("lifecycle_status"), F.lit("DRAFT")),
         "owner": F.coalesce(cur("owner"), F.lit("RISK_TEAM")),
         "granularity": F.coalesce(cur("granularity"), F.lit("M")), "window": F.coalesce(cur("window"), F.lit("SNAP")),
         "ref_date_logic": F.coalesce(cur("ref_date_logic"), F.lit("BATCH_MAX")),
         "is_dynamic_expansion": F.coalesce(cur("is_dynamic_expansion", "int"), F.lit(0)),
         "post_processing_rule": F.coalesce(F.nullif(cur("post_processing_rule"), F.lit("")), post),
         "null_handling": F.coalesce(cur("null_handling", "array<string>"), nulls),
         "current_iv": F.coalesce(cur("current_iv", "double"), F.col("_s_iv")),
         "current_reliability": F.coalesce(cur("current_reliability"), F.col("_s_iv_reliability")),
         "current_coverage_rate": F.coalesce(cur("current_coverage_rate", "double"), F.col("_s_coverage_rate")),
         "current_signal_strength": F.coalesce(cur("current_signal_strength"), F.col("_s_signal_strength")),
         "current_risk_direction": F.coalesce(cur("current_risk_direction"), F.col("_s_risk_direction")),
         "iv_history": F.coalesce(cur("iv_history", "array<struct<snap_dt:string,iv:double,credibility:string,"
                                                    "sample_size:bigint,project:string>>"), first)}
    keep = [F.col(f"p.{c}") for c in proposals.columns if c not in d]
    return rows.select(*keep, *[c.alias(n) for n, c in d.items()])


# ---- codes -----------------------------------------------------------------------------------

def code_errors(code: Column) -> Column:
    """Array of naming errors, empty when the code is valid."""
    part = lambda i: F.get(F.split(code, "_"), F.lit(i))
    errors = F.array(
        F.when(F.length(code) > CODE_LENGTH, "too_long"), F.when(~code.rlike(CODE_PATTERN), "pattern"),
        F.when(~part(0).isin(*DOMAINS), "domain"),
        F.when(part(1).isNotNull() & ~part(1).isin(*GRANULARITIES), "granularity"))
    return F.filter(errors, lambda e: e.isNotNull())


def parse_code(code: Column) -> dict[str, Column]:
    """Domain, granularity, business key, window and statistic of a code."""
    parts = F.split(code, "_")
    rest = F.slice(parts, 3, F.greatest(F.size(parts) - 2, F.lit(0)))
    last = lambda a: F.get(a, F.size(a) - 1)
    short = lambda a: F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))
    has_stat = F.coalesce(last(rest).isin(*STATS), F.lit(False))
    rest2 = F.when(has_stat, short(rest)).otherwise(rest)
    has_win = F.coalesce(last(rest2).isin(*WINDOWS), F.lit(False))
    rest3 = F.when(has_win, short(rest2)).otherwise(rest2)
    return {"domain": F.get(parts, F.lit(0)), "granularity": F.get(parts, F.lit(1)),
            "business_key": F.when(F.size(rest3) > 0, F.array_join(rest3, "_")),
            "window": F.when(has_win, last(rest2)), "stat": F.when(has_stat, last(rest))}


def compose_code(domain: Column, key: Column, window: Column, stat: Column, granularity: Column) -> Column:
    clean = F.regexp_replace(F.upper(key), "[^A-Z0-9_]+", "_")
    clean = F.regexp_replace(F.regexp_replace(clean, "_+", "_"), "^_|_$", "")
    parts = F.array(domain, granularity, clean, window, stat)
    return F.array_join(F.filter(parts, lambda p: p.isNotNull() & (p != "")), "_")


# ---- proposal checks -------------------------------------------------------------------------

# Required fields, enumerations, length limits and ranges of a registry row.
REQUIRED = ("ind_code", "ind_version", "ind_name", "domain", "granularity", "window", "value_type",
            "biz_definition", "calc_logic", "source_tables", "source_fields", "priority",
            "lifecycle_status", "proposer", "owner", "eff_dt", "exp_dt", "is_dynamic_expansion",
            "ref_date_logic", "post_processing_rule")
ENUMS = {"domain": DOMAINS, "granularity": GRANULARITIES, "window": WINDOWS,
         "value_type": ("NUM", "RATIO", "FLG", "IDX", "STR", "DATE"),
         "current_signal_strength": ("strong", "medium", "weak", "watch"),
         "current_reliability": ("reliable", "reference", "unreliable_small", "not_analysed"),
         "current_risk_direction": ("positive", "negative", "undecided"), "priority": PRIORITIES,
         "lifecycle_status": ("DRAFT", "ACTIVE", "DEPRECATED", "RETIRED"),
         "proposer": ("HUMAN", "AGENT", "MIGRATION"), "is_dynamic_expansion": (0, 1),
         "ref_date_logic": ("BATCH_MAX", "SYS_TODAY", "EXPLICIT_PARAM", "SNAP_DT", "NONE"),
         "post_processing_rule": ("PAD_ZERO_ON_LEFT_JOIN", "KEEP_NULL_ON_LEFT_JOIN", "NONE")}
LENGTHS = {"ind_code": (None, 60), "ind_name": (2, 200), "ind_name_en": (None, 200), "value_unit": (None, 20),
           "biz_definition": (5, 2000), "calc_logic": (5, 4000), "proposer_detail": (None, 200),
           "owner": (None, 50), "notes": (None, 2000), "dynamic_template": (None, 200),
           "parent_template_code": (None, 60)}
RANGES = {"ind_version": (1, None), "current_iv": (0.0, 2.0), "current_coverage_rate": (-1.0, 1.0)}
NON_EMPTY = ("source_tables", "source_fields")
PATTERNS = {"ind_code": CODE_PATTERN, "part_ymd": "^[0-9]{8}$"}
DATES = ("eff_dt", "exp_dt", "etl_dt")


def schema_errors(df: DataFrame) -> Column:
    """Array of violated constraints of a row, over the columns the table has."""
    have, out = set(df.columns), []
    for c in REQUIRED:
        out.append(F.when(F.col(c).isNull(), f"{c}:required") if c in have else F.lit(f"{c}:required"))
    for c, vals in ENUMS.items():
        if c in have:
            out.append(F.when(~F.col(c).isin(*vals), f"{c}:enum"))
    for c, (lo, hi) in LENGTHS.items():
        if c in have:
            n = F.length(c)
            bad = F.lit(False)
            if lo is not None:
                bad = bad | (n < lo)
            if hi is not None:
                bad = bad | (n > hi)
            out.append(F.when(bad, f"{c}:length"))
    for c, (lo, hi) in RANGES.items():
        if c in have:
            bad = F.lit(False)
            if lo is not None:
                bad = bad | (F.col(c) < lo)
            if hi is not None:
                bad = bad | (F.col(c) > hi)
            out.append(F.when(bad, f"{c}:range"))
    for c in NON_EMPTY:
        if c in have:
            out.append(F.when(F.size(c) == 0, f"{c}:empty"))
    for c, pat in PATTERNS.items():
        if c in have:
            out.append(F.when(~F.col(c).rlike(pat), f"{c}:pattern"))
    for c in DATES:
        if c in have:
            out.append(F.when(F.col(c).isNotNull() & F.expr(f"try_to_date(CAST({c} AS STRING)) IS NULL"), f"{c}:date"))
    return F.filter(F.array(*out), lambda e: e.isNotNull())


FIELD_PATTERN = "^([A-Z][A-Z0-9_]+)\\.([A-Z][A-Z0-9_]+)"


def check_fields(proposals: DataFrame, dictionary: DataFrame, key: str = "ind_code") -> DataFrame:
    """Source tables and fields against the dictionary (table_name, field_name).

    Unknown tables warn, unknown fields of known tables are errors, no table at all is an error
    unless the proposal is marked blocked.
    """
    tables = dictionary.select("table_name").distinct().withColumn("_t", F.lit(1))
    fields = dictionary.select("table_name", "field_name").distinct().withColumn("_f", F.lit(1))
    t = (proposals.select(key, F.explode("source_tables").alias("table_name"))
         .join(tables, "table_name", "left")
         .groupBy(key).agg(F.count_if(F.col("_t").isNull()).alias("n_unknown_tables")))
    f = proposals.select(key, F.explode("source_fields").alias("f")).select(
        key, F.regexp_extract("f", FIELD_PATTERN, 1).alias("table_name"),
        F.regexp_extract("f", FIELD_PATTERN, 2).alias("field_name"))
    f = (f.join(tables, "table_name", "left").join(fields, ["table_name", "field_name"], "left")
         .groupBy(key).agg(F.count_if(F.col("table_name") == "").alias("n_odd_fields"),
                           F.count_if(F.col("_t").isNotNull() & F.col("_f").isNull()).alias("n_unknown_fields")))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    none = (F.coalesce(F.size("source_tables"), F.lit(0)) <= 0) & (F.coalesce("priority", F.lit("")) != BLOCKED)
    out = (proposals.select(key, none.alias("no_table")).join(t, key, "left").join(f, key, "left")
           .select(key, "no_table", zero("n_unknown_tables"), zero("n_odd_fields"), zero("n_unknown_fields")))
    return (out.withColumn("passed", (F.col("n_unknown_fields") == 0) & ~F.col("no_table"))
            .withColumn("n_warnings", F.col("n_unknown_tables") + F.col("n_odd_fields")))


def tokens(name: Column) -> Column:
    """Distinct lower-case words; every CJK character counts as a word."""
    spaced = F.regexp_replace(F.lower(name), "([\\u4e00-\\u9fff])", " $1 ")
    return F.array_sort(F.array_distinct(F.filter(F.split(spaced, "[^a-z0-9\\u4e00-\\u9fff]+"),
                                                  lambda t: t != "")))


def similar_names(candidates: DataFrame, existing: DataFrame, key: str = "ind_code",
                  name: str = "ind_name", min_score: float = 72.25, min_words: int = 1) -> DataFrame:
    """Pairs (candidate key, existing code, score) whose token-set score reaches ``min_score``.

    The score is the share of the shorter name's words found in the other name (100 when one name
    contains the other). Names collapse to distinct word sets first. Two sets can only reach the
    score when one of the rarest words of the shorter one occurs in the longer one, so only those
    words are joined on; frequent words never form a join key unless a name has no other. Names of
    fewer than ``min_words`` words are left out of the pairs.
    """
    left, scored, right = _similar_sets(candidates, existing, key, name, min_score, min_words)
    return left.join(scored, "a"), right


def _similar_sets(candidates: DataFrame, existing: DataFrame, key: str = "ind_code", name: str = "ind_name",
                  min_score: float = 72.25, min_words: int = 1) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(candidate codes and sets, pairs of different sets with scores, existing codes and sets)."""
    sides = []
    for df, k in ((candidates, "a"), (existing, "b")):
        sides.append(df.select(F.col(key).alias(f"{k}_code"), tokens(F.col(name)).alias(k))
                     .where(F.size(k) > 0))
    left, right = sides
    sets_a, sets_b = (df.select(k).where(F.size(k) >= min_words).distinct() for df, k in ((left, "a"), (right, "b")))
    freq = (sets_a.select(F.explode("a").alias("t")).unionByName(sets_b.select(F.explode("b").alias("t")))
            .groupBy("t").agg(F.count("*").alias("f")))

    def rare_first(df: DataFrame, k: str) -> DataFrame:
        e = df.select(k, F.explode(k).alias("t")).join(freq, "t")
        return e.groupBy(k).agg(F.sort_array(F.collect_list(F.struct("f", "t"))).alias("_o")).select(
            k, F.transform("_o", lambda s: s["t"]).alias("order"))  # one short array per name

    t = min_score / 100
    prefix = lambda: F.slice("order", 1, (F.size("order") - F.ceil(F.size("order") * t - 1e-9) + 1).cast("int"))
    pa = rare_first(sets_a, "a").select("a", F.explode(prefix()).alias("t"))
    pb = rare_first(sets_b, "b").select("b", F.explode(prefix()).alias("t"))
    ea, eb = sets_a.select("a", F.explode("a").alias("t")), sets_b.select("b", F.explode("b").alias("t"))
    pairs = (pa.join(eb, "t").where(F.size("a") <= F.size("b")).select("a", "b")
             .unionByName(pb.join(ea, "t").where(F.size("b") < F.size("a")).select("a", "b")).distinct())
    both = F.size(F.array_intersect("a", "b"))
    scored = pairs.select("a", "b", (both / F.least(F.size("a"), F.size("b")) * 100).alias("score"))
    return left, scored.where(F.col("score") >= min_score), right


def check_duplicates(candidates: DataFrame, existing: DataFrame, threshold: float = 85.0,
                     key: str = "ind_code", name: str = "ind_name") -> DataFrame:
    """Best match of each candidate: duplicate from ``threshold``, warning from 85 % of it."""
    left, right = similar_names(candidates, existing, key, name, threshold * 0.85, min_words=2)
    first = right.groupBy("b").agg(F.min("b_code").alias("b_code"))  # one code per word set
    # A name of one word is part of every name with that word: only the smallest code can be the
    # best, so a frequent word takes one row, not all its pairs.
    words = first.select("b_code", F.size("b").alias("n"), F.explode("b").alias("t"))
    with_word = words.groupBy("t").agg(F.min("b_code").alias("any_code"),
                                       F.min(F.when(F.col("n") == 1, F.col("b_code"))).alias("one_code"))
    mine = candidates.select(F.col(key).alias("a_code"), tokens(F.col(name)).alias("a"))
    single = (mine.select("a_code", F.size("a").alias("n"), F.explode("a").alias("t")).join(with_word, "t")
              .select("a_code", F.when(F.col("n") == 1, F.col("any_code")).otherwise(F.col("one_code")).alias("b_code"),
                      F.lit(100.0).alias("score")).where("b_code is not null"))
    best = (left.join(first, "b").select("a_code", "b_code", "score").unionByName(single).groupBy("a_code")
            .agg(F.min_by(F.struct("b_code", "score"), F.struct(-F.col("score"), F.col("b_code"))).alias("m")))
    out = (candidates.select(F.col(key)).join(
        best.select(F.col("a_code").alias(key), F.col("m.b_code").alias("matched_code"), "m.score"), key, "left"))
    s = F.coalesce("score", F.lit(0.0))
    return out.withColumn("score", s).withColumn("verdict", F.when(s >= threshold, "duplicate").when(
        s >= threshold * 0.85, "similar").otherwise("new"))


def top_similar(candidates: DataFrame, existing: DataFrame, k: int = 5, **kw) -> DataFrame:
    """The ``k`` closest existing names per candidate; equal word sets are ranked by code."""
    left, scored, right = _similar_sets(candidates, existing, **kw)
    # Only the k smallest codes of a word set can be among the k best of any candidate, and candidates with
    # equal word sets have the same best: they are picked once per set, so a candidate meets k rows at most.
    w = Window.partitionBy("b").orderBy("b_code")
    few = right.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")
    best, order = Window.partitionBy("a"), (F.desc("score"), F.asc("b_code"))
    near = (scored.join(few, "b").withColumn("_r", F.row_number().over(best.orderBy(*order)))
            .where(F.col("_r") <= k).select("a", "b_code", "score"))
    # Codes may repeat, with other names.
    rank = Window.partitionBy("a_code").orderBy(*order)
    return (left.join(near, "a").withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
            .select("a_code", "b_code", "score", "rank"))


# Functions a calculation must not use, and words that show a partition filter.
FORBIDDEN = ("current_date", "current_timestamp", "now", "today")
PARTITION_WORDS = ("part_ymd", "partition", "etl_dt")


# Words of a calculation that are neither columns nor tables.
CALC_WORDS = ("select", "from", "join", "left", "right", "inner", "full", "outer", "on", "where", "group", "order", "by",
              "having", "and", "or", "not", "in", "is", "null", "like", "between", "case", "when", "then", "else", "end",
              "as", "distinct", "over", "partition", "rows", "asc", "desc", "true", "false", "interval", "union", "all")


def calc_scan(calc: Column) -> dict[str, Column]:
    """What a calculation refers to, found by pattern.

    Note lines and quoted text are left out. ``functions``, ``tables`` (after from and join) and
    ``columns`` (all other names) are lower-case, distinct and sorted; ``forbidden`` are the functions that must
    not be used; ``odd`` marks unbalanced brackets or quotes, which warn.
    """
    bare_text = F.regexp_replace(F.regexp_replace(calc, "(?m)(--|#).*$", " "), "'[^']*'", " ")
    lower = F.lower(bare_text)
    each = lambda pattern: F.array_distinct(F.regexp_extract_all(lower, F.lit(pattern), F.lit(1)))
    funcs = F.array_sort(each("([a-z_][a-z0-9_]*)\\s*\\("))
    bare = each("\\b(current_date|current_timestamp)\\b")
    used = F.array_sort(F.array_intersect(F.array_union(funcs, bare), F.array(*[F.lit(f) for f in FORBIDDEN])))
    tables = F.array_sort(each("\\b(?:from|join)\\s+([a-z_][a-z0-9_.]*)"))
    names = each("(?<![\\w.])([a-z_][a-z0-9_.]*)\\b(?!\\s*\\()")
    known = F.array_union(F.array_union(tables, bare), F.array(*[F.lit(w) for w in CALC_WORDS]))
    count = lambda c: F.length(bare_text) - F.length(F.replace(bare_text, F.lit(c)))
    part = F.lit(False)
    for w in PARTITION_WORDS:
        part = part | F.lower(calc).contains(w)
    return {"functions": funcs, "forbidden": used, "has_partition": part, "tables": tables,
            "columns": F.array_sort(F.array_except(names, known)),
            "odd": F.coalesce((count("(") != count(")")) | bare_text.contains("'"), F.lit(False)),
            "passed": F.coalesce((F.length(calc) >= 5) & (F.size(used) == 0), F.lit(False))}


CHECK_ORDER = ("schema", "naming", "fields", "calc_logic", "dedup")


def roll_up(proposals: DataFrame, checks: dict[str, DataFrame | tuple[Column, Column]], key: str = "ind_code") -> DataFrame:
    """First failing check of every proposal.

    ``checks`` maps a name to (passed, warnings) as columns of ``proposals``, all computed in one
    projection, or to a table (key, passed, n_warnings) that is joined.
    """
    used = [n for n in CHECK_ORDER if n in checks]
    on_row = {n: c for n, c in checks.items() if isinstance(c, tuple)}
    out = proposals.select(key, *[x.alias(f"_{k}_{n}") for n, c in on_row.items() for k, x in zip("pw", c)])
    for name in used:
        if name not in on_row:
            c = checks[name]
            warn = F.col("n_warnings") if "n_warnings" in c.columns else F.lit(0)
            out = out.join(c.select(key, F.col("passed").alias(f"_p_{name}"), warn.alias(f"_w_{name}")), key, "left")
    failed = [F.when(~F.coalesce(f"_p_{n}", F.lit(True)), n) for n in used]
    warns = sum((F.coalesce(f"_w_{n}", F.lit(0)) for n in used[1:]), F.coalesce(f"_w_{used[0]}", F.lit(0)))
    return out.select(key, F.coalesce(*failed).alias("rejected_at"),
                      F.filter(F.array(*failed), lambda f: f.isNotNull()).alias("failed_checks"),
                      warns.cast("bigint").alias("n_warnings"))


def roll_up_stats(rolled: DataFrame, alarm: float = 0.5) -> DataFrame:
    out = rolled.agg(F.count("*").alias("n"), F.count_if(F.col("rejected_at").isNull()).alias("n_validated"),
                     F.count("rejected_at").alias("n_rejected"))
    rate = F.round(F.coalesce(F.try_divide(F.col("n_rejected").cast("double"), F.col("n")), F.lit(0.0)), 3)
    return out.withColumn("rejection_rate", rate).withColumn("alarm", F.col("rejection_rate") > alarm)


def rejected_by_check(rolled: DataFrame) -> DataFrame:
    return rolled.where(F.col("rejected_at").isNotNull()).groupBy("rejected_at").agg(F.count("*").alias("n"))


# ---- verification ----------------------------------------------------------------------------

def verification_request(proposals: DataFrame) -> DataFrame:
    """Request rows with the expected IV band (0.7 to 1.3 times the known IV)."""
    iv = F.col("current_iv")
    keep = [c for c in ("ind_code", "ind_version", "ind_name", "domain", "biz_definition", "calc_logic",
                        "source_tables", "source_fields", "ref_date_logic", "null_handling",
                        "post_processing_rule", "is_dynamic_expansion") if c in proposals.columns]
    return proposals.select(
        *keep, F.round(F.when(iv.isNotNull(), F.greatest(F.lit(0.0), iv * 0.7)), 4).alias("expected_iv_low"),
        F.round(iv * 1.3, 4).alias("expected_iv_high"),
        F.col("current_coverage_rate").alias("expected_coverage_rate"))


def merge_verification(proposals: DataFrame, response: DataFrame) -> DataFrame:
    """Attach results by code; a success replaces the measured values and extends the history."""
    r = response.select(F.col("ind_code").alias("_c"), *[
        F.col(c).alias(f"_r_{c}") for c in ("status", "iv", "coverage_rate", "reliability", "sample_size",
                                            "risk_direction", "snap_dt")])
    ok = F.coalesce(F.col("_r_status") == "SUCCESS", F.lit(False))

    def fresh(new: str, old: str, text: bool = False) -> Column:
        n = F.nullif(F.col(f"_r_{new}"), F.lit("")) if text else F.col(f"_r_{new}")
        return F.when(ok, F.coalesce(n, F.col(old))).otherwise(F.col(old))

    entry = F.struct(F.coalesce("_r_snap_dt", F.lit("")).alias("snap_dt"), F.col("_r_iv").alias("iv"),
                     F.coalesce("_r_reliability", F.lit("")).alias("credibility"),
                     F.coalesce("_r_sample_size", F.lit(0)).cast("bigint").alias("sample_size"),
                     F.lit("verification").alias("project"))
    old = F.coalesce("iv_history", F.array().cast(
        "array<struct<snap_dt:string,iv:double,credibility:string,sample_size:bigint,project:string>>"))
    new = {"verification_status": F.coalesce("_r_status", F.when(F.col("_c").isNull(), "NOT_PROCESSED"),
                                             F.lit("UNKNOWN")),
           "verified_iv": F.col("_r_iv"), "verified_coverage_rate": F.col("_r_coverage_rate"),
           "current_iv": fresh("iv", "current_iv"),
           "current_coverage_rate": fresh("coverage_rate", "current_coverage_rate"),
           "current_reliability": fresh("reliability", "current_reliability", True),
           "current_risk_direction": fresh("risk_direction", "current_risk_direction", True),
           "iv_history": F.when(ok, F.array_append(old, entry)).otherwise(F.col("iv_history"))}
    joined = proposals.join(r, F.col("ind_code") == F.col("_c"), "left")
    return joined.select(*[F.col(c) for c in proposals.columns if c not in new],
                         *[c.alias(n) for n, c in new.items()])


def priority(iv: Column, coverage: Column, reliability: Column, current: Column, status: Column) -> Column:
    v, c = F.coalesce(iv, F.lit(0.0)), F.coalesce(coverage, F.lit(0.0))
    blocked = F.coalesce(current == BLOCKED, F.lit(False)) & ~F.coalesce(status == "SUCCESS", F.lit(False))
    return (F.when(F.coalesce(reliability != "reliable", F.lit(False)), "P4-watch").when(blocked, BLOCKED)
            .when((v >= 0.10) & (c >= 0.95), "P0").when(v >= 0.10, BLOCKED)
            .when((v >= 0.05) & (c >= 0.80), "P1").when((c < 0.50) & (v >= 0.02), "P1-sparse")
            .when(v >= 0.02, "P2").otherwise("P3-watch"))


# ---- versioned store -------------------------------------------------------------------------

# A change in one of these opens a new version; these others are updated in place.
BUSINESS = ("ind_name", "domain", "granularity", "window", "value_type", "biz_definition", "calc_logic",
            "source_tables", "source_fields", "is_dynamic_expansion", "dynamic_template", "ref_date_logic",
            "null_handling", "post_processing_rule")
SOFT = ("current_signal_strength", "current_iv", "current_reliability", "current_coverage_rate",
        "current_risk_direction", "iv_history", "priority", "priority_history", "notes", "etl_timestamp",
        "batch_id")


def active(registry: DataFrame) -> DataFrame:
    return registry.where(F.col("exp_dt") == OPEN)


def find(registry: DataFrame, code: str, version: int | None = None) -> DataFrame:
    if version is None:
        return active(registry).where(F.col("ind_code") == code)
    return registry.where((F.col("ind_code") == code) & (F.col("ind_version") == version))


def code_name_pairs(registry: DataFrame) -> DataFrame:
    return active(registry).select("ind_code", "ind_name")


def _steps(registry: DataFrame, batch: DataFrame, batch_id: str, today: str, order: str | None) -> DataFrame:
    """Open rows and batch records by code in the order they take effect.

    Columns: ``r`` (the row), seq (0 for the open row, then the batch in ``order``), version group and
    step (kept, inserted, new_version, soft_update). A record is compared with the one before it,
    which by then has the same business fields as the open version. Codes that repeat in a batch
    need an ``order`` without ties; otherwise the query fails.
    """
    cols = registry.columns
    have = set(batch.columns)
    types = {f.name: f.dataType for f in registry.schema.fields}
    given = {"batch_id": F.lit(batch_id), "exp_dt": F.lit(OPEN)}
    new = batch.select(F.struct(*[given.get(c, F.col(c) if c in have else F.lit(None)).cast(types[c]).alias(c) for c in cols]).alias("r"),
                       F.lit(1).alias("rank"), (F.col(order) if order else F.lit(0)).alias("order"))
    old = active(registry).select(F.struct(*cols).alias("r"), F.lit(0).alias("rank"), F.lit(None).cast(new.schema["order"].dataType).alias("order"))
    by_code = Window.partitionBy("r.ind_code").orderBy("rank", "order")
    before = F.lag(F.struct("r", "rank", "order")).over(by_code)
    changed = F.lit(False)
    for c in BUSINESS:
        if c in cols:
            changed = changed | ~F.col(f"before.r.{c}").eqNullSafe(F.col(f"r.{c}"))
    tie = (F.col("before.rank") == 1) & F.col("before.order").eqNullSafe(F.col("order"))
    step = (F.when(tie, F.raise_error(F.concat(F.lit("code repeats in the batch without an order: "), F.col("r.ind_code"))))
            .when(F.col("rank") == 0, "kept").when(F.col("before").isNull(), "inserted").when(changed, "new_version").otherwise("soft_update"))
    rows = old.unionByName(new).withColumn("before", before).withColumn("step", step)
    opens = F.col("step").isin("inserted", "new_version").cast("int")
    return (rows.withColumn("seq", F.row_number().over(by_code)).withColumn("group", F.sum(opens).over(by_code))
            .withColumn("opened", F.max(F.struct("group")).over(Window.partitionBy("r.ind_code"))["group"])
            .select(F.col("r.ind_code").alias("code"), "r", "seq", "group", "opened", "step"))


def scd2_merge(registry: DataFrame, batch: DataFrame, batch_id: str, today: str,
               order: str | None = None) -> DataFrame:
    """The registry after a batch, with the ``action`` that made each row of it what it is.

    Records take effect one after another: a new code opens version 1 (from its eff_dt, else today), a
    change in a business field closes the open version and opens the next one today, anything else
    updates the soft fields in place. ``order`` names the batch column that gives the sequence of
    records of one code; a code that repeats without one, or with ties in it, fails.
    """
    cols, have = registry.columns, set(batch.columns)
    past = registry.where(F.col("exp_dt") != OPEN)
    used = past.groupBy(F.col("ind_code").alias("code")).agg(F.max("ind_version").alias("used"))
    versions = (_steps(registry, batch, batch_id, today, order).groupBy("code", "group", "opened")
                .agg(F.min_by("r", "seq").alias("first"), F.max_by("r", "seq").alias("last"),
                     F.min_by("step", "seq").alias("began"), F.max_by("step", "seq").alias("ended"))
                .join(used, "code", "left"))
    # Versions opened by this batch go on from the open one, or from the last closed one.
    base = F.when(F.col("began") == "kept", F.col("first.ind_version"))
    at = Window.partitionBy("code")
    versions = versions.withColumn("base", F.coalesce(F.max(base).over(at), F.col("used"), F.lit(0)))
    mine = F.col("began") != "kept"

    def value(c: str) -> Column:
        if c == "ind_version":
            return F.when(mine, F.col("base") + F.col("group")).otherwise(F.col("first.ind_version"))
        if c == "exp_dt":
            return F.when(F.col("group") < F.col("opened"), F.lit(today)).otherwise(F.col("first.exp_dt"))
        if c == "eff_dt":
            return (F.when(F.col("began") == "inserted", F.coalesce("first.eff_dt", F.lit(today)))
                    .when(mine, F.lit(today)).otherwise(F.col("first.eff_dt")))
        if c in SOFT and (c in have or c == "batch_id"):
            return F.col(f"last.{c}")
        return F.col(f"first.{c}")

    types = {f.name: f.dataType for f in registry.schema.fields}
    action = F.when(mine, F.col("began")).when(F.col("opened") > 0, "closed").otherwise(F.col("ended"))
    current = versions.select(*[value(c).cast(types[c]).alias(c) for c in cols], action.alias("action"))
    return past.withColumn("action", F.lit("kept")).unionByName(current)


def deprecate(registry: DataFrame, codes: list[str] | DataFrame, today: str) -> DataFrame:
    """Close the open versions of the codes and mark them deprecated."""
    if isinstance(codes, DataFrame):
        listed = codes.select("ind_code").distinct().withColumn("_d", F.lit(True))
        rows = registry.join(listed, "ind_code", "left").withColumn("_d", F.coalesce("_d", F.lit(False)))
    else:
        rows = registry.withColumn("_d", F.col("ind_code").isin(list(codes)))
    hit = F.col("_d") & (F.col("exp_dt") == OPEN)
    return rows.withColumns({
        "lifecycle_status": F.when(hit, "DEPRECATED").otherwise(F.col("lifecycle_status")),
        "exp_dt": F.when(hit, F.lit(today)).otherwise(F.col("exp_dt"))}).select(*registry.columns)


def _flat(df: DataFrame, cols: list[str]) -> DataFrame:
    nested = {f.name for f in df.schema.fields if f.dataType.typeName() in ("array", "map", "struct")}
    return df.select(*[F.to_json(c).alias(c) if c in nested else F.col(c) for c in cols if c in df.columns])


def snapshot(registry: DataFrame) -> DataFrame:
    """Open rows with nested columns as JSON."""
    return _flat(active(registry), registry.columns)


def register(registry: DataFrame, proposals: DataFrame, batch_id: str, today: str,
             order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Merge the proposals that did not fail verification: (registry, counts of records by action)."""
    failed = F.coalesce(F.col("verification_status").isin("FAIL", "SQL_ERROR"), F.lit(False))
    good = proposals.where(~failed).withColumn("lifecycle_status", F.lit("ACTIVE"))
    merged = scd2_merge(registry, good, batch_id, today, order)
    acts = (_steps(registry, good, batch_id, today, order).where("step != 'kept'")
            .groupBy(F.col("step").alias("action")).agg(F.count("*").alias("n")))
    skipped = proposals.where(failed).agg(F.count("*").alias("n")).select(F.lit("skipped").alias("action"), "n")
    return merged, acts.unionByName(skipped.where("n > 0"))


# The delivered columns.
DELIVERY = ("ind_code", "ind_name", "domain", "priority", "granularity", "window", "biz_definition", "calc_logic",
            "source_tables", "source_fields", "current_iv", "current_reliability", "current_coverage_rate",
            "current_risk_direction", "ref_date_logic", "null_handling", "post_processing_rule",
            "verification_status", "verified_iv", "lifecycle_status", "ind_version")


def delivery(proposals: DataFrame) -> DataFrame:
    return _flat(proposals, list(DELIVERY))


def review_counts(proposals: DataFrame) -> DataFrame:
    """Counts by domain, by priority and by verification status."""
    cells = F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.coalesce(F.col(c), F.lit(d)).alias("value"))
        for k, c, d in (("domain", "domain", "?"), ("priority", "priority", "?"),
                        ("status", "verification_status", "NOT_PROCESSED"))]))
    return proposals.select(cells.alias("c")).groupBy("c.kind", "c.value").agg(F.count("*").alias("n"))


def top_registered(registry: DataFrame, n: int = 30) -> DataFrame:
    """Leading open indicators per domain by IV."""
    w = Window.partitionBy("domain").orderBy(F.desc(F.coalesce("current_iv", F.lit(0.0))), F.asc("ind_code"))
    return (active(registry).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
            .select("domain", "rank", "ind_code", "ind_name", "current_iv", "priority"))


def base_table_fields(domain_tables: DataFrame, dictionary: DataFrame, cap: int = 80) -> DataFrame:
    """Fields of each domain's tables, at most ``cap`` listed per table; missing tables are flagged."""
    w = Window.partitionBy("domain", "table_name").orderBy("field_name")
    rows = domain_tables.join(dictionary.select("table_name", "field_name"), "table_name", "left")
    total = F.count("field_name").over(Window.partitionBy("domain", "table_name"))
    return (rows.withColumn("rank", F.row_number().over(w)).withColumn("n_fields", total)
            .where(F.col("rank") <= cap)
            .select("domain", "table_name", "field_name", "rank", "n_fields",
                    F.col("field_name").isNull().alias("is_missing")))

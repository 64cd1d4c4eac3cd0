"""Entity-level triggers: thresholds inside a scope, hit flags, weighted score, report tables."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from risklens.operators.quantiles import group_quantiles

OPS = {">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b,
       "<=": lambda a, b: a <= b}
WAIST = {"dim": "is_mid_high_rating", "value": 1}
# Sample minima below which the median replaces the mean of the bads.
MIN_GOOD, MIN_BAD = 10, 5
# Score bands.
BANDS = ((0, 5), (5, 10), (10, 15), (15, 20), (20, 30), (30, 50), (50, 100))


@dataclass(frozen=True)
class Trigger:
    name: str
    column: str
    direction: str                 # 'positive': high values are risky
    iv: float
    category: str
    explicit: tuple[str, float] | None = None
    scope: Any = None              # None, 'full', 'waist', {dim, value}, {dim, values}
    iv_waist: float | None = None

    @property
    def weight(self) -> float:
        if self.scope == "waist" and self.iv_waist is not None:
            return self.iv_waist
        return self.iv

    @property
    def category_short(self) -> str:
        return self.category.split("-")[0]


def _number(column: str) -> Column:
    """Numeric reading of a column; unreadable text and NaN are missing."""
    x = F.expr(f"try_cast(`{column}` AS DOUBLE)")
    return F.when(~F.isnan(x), x)


def scope_mask(columns: list[str], scope: Any) -> Column | None:
    """Predicate of a scope; None when its dimension is not in the table."""
    if scope in (None, "full"):
        return F.lit(True)
    if scope == "waist":
        scope = WAIST
    dim = scope.get("dim")
    if dim not in columns:
        return None
    c = F.col(f"`{dim}`")
    if "values" in scope:
        return F.coalesce(c.isin(list(scope["values"])), F.lit(False))
    if "value" in scope:
        return F.coalesce(c == F.lit(scope["value"]), F.lit(False))
    return F.lit(True)


def scope_label(scope: Any) -> str:
    if scope in (None, "full"):
        return "__all__"
    if scope == "waist":
        return "waist"
    if "values" in scope:
        return f"{scope['dim']} in [{', '.join(map(str, scope['values']))}]"
    if "value" in scope:
        return f"{scope['dim']}={scope['value']}"
    return str(scope)


def thresholds(df: DataFrame, triggers: list[Trigger], target: str) -> list[dict]:
    """Operator and value of every trigger, from one aggregate over the table."""
    cols, out, aggs = df.columns, {}, []
    y = F.col(target)
    for i, t in enumerate(triggers):
        base = {"name": t.name, "column": t.column, "category": t.category, "iv": t.iv,
                "direction": t.direction, "scope": scope_label(t.scope), "operator": None,
                "value": None, "source": None, "good_mean": None, "bad_mean": None,
                "check": None, "skip_reason": None}
        out[i] = base
        if t.column not in cols:
            base["skip_reason"] = "column_missing"
            continue
        mask = scope_mask(cols, t.scope)
        if mask is None:
            base["skip_reason"] = "scope_missing"
            continue
        if t.explicit:
            base.update(operator=t.explicit[0], value=float(t.explicit[1]), source="explicit")
            continue
        x = F.when(mask, _number(t.column))
        for k, v in (("g", 0), ("b", 1)):
            side = F.when(y == v, x)
            aggs += [F.count(side).alias(f"n{k}_{i}"), F.avg(side).alias(f"m{k}_{i}")]
    if not aggs:
        return list(out.values())
    row = df.agg(*aggs).first()
    thin = []
    for i, t in enumerate(triggers):
        if f"ng_{i}" not in row.asDict():
            continue
        op = ">=" if t.direction == "positive" else "<="
        if row[f"ng_{i}"] < MIN_GOOD or row[f"nb_{i}"] < MIN_BAD:
            out[i].update(operator=op, source="scope_median")
            thin.append(i)
            continue
        g, b = row[f"mg_{i}"], row[f"mb_{i}"]
        agrees = b > g if t.direction == "positive" else b < g
        out[i].update(operator=op, value=b, source="bad_mean", good_mean=g, bad_mean=b,
                      check="consistent" if agrees else "conflict")
    if thin:
        parts = F.explode(F.array(*[
            F.struct(F.lit(i).alias("i"), F.when(
                scope_mask(cols, triggers[i].scope), _number(triggers[i].column)).alias("x"))
            for i in thin]))
        for r in group_quantiles(df.select(parts.alias("p")).select("p.*"), ["i"], [0.5]).collect():
            out[r["i"]]["value"] = r["q"][0]
    return list(out.values())


THRESHOLD_SCHEMA = ("name string, column string, category string, iv double, direction string, "
                    "scope string, operator string, value double, source string, good_mean double, "
                    "bad_mean double, check string, skip_reason string")


def threshold_table(spark, found: list[dict]) -> DataFrame:
    """Explanation table: one row per trigger."""
    order = [c.split()[0] for c in THRESHOLD_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(f[c] for c in order) for f in found], THRESHOLD_SCHEMA)


def issues(spark, found: list[dict]) -> DataFrame:
    """Triggers that were skipped or whose direction conflicts with the data."""
    t = threshold_table(spark, found)
    issue = F.coalesce("skip_reason", F.when(F.col("check") == "conflict", F.col("check")))
    return t.withColumn("issue", issue).where(F.col("issue").isNotNull()).select("name", "scope", "issue")


def _live(t: Trigger, f: dict) -> bool:
    return f["skip_reason"] is None and f["value"] is not None


def flags(df: DataFrame, triggers: list[Trigger], found: list[dict], *, key: str, target: str,
          keep: list[str] = ()) -> DataFrame:
    """Wide table: ``value_i`` and ``hit_i`` (1 / 0, null without a value) per trigger."""
    values, hits = {}, {}
    for i, (t, f) in enumerate(zip(triggers, found)):
        x = _number(t.column) if t.column in df.columns else F.lit(None).cast("double")
        values[f"value_{i}"] = x
        if not _live(t, f):
            hits[f"hit_{i}"] = F.lit(None).cast("int")
            continue
        hit = OPS[f["operator"]](x, F.lit(float(f["value"]))) & scope_mask(df.columns, t.scope)
        hits[f"hit_{i}"] = F.when(x.isNotNull(), hit.cast("int"))
    return df.select(key, *keep, target, *[c.alias(n) for n, c in values.items()],
                     *[c.alias(n) for n, c in hits.items()])


def score(wide: DataFrame, triggers: list[Trigger], found: list[dict], *,
          skip_in_weight: bool = True) -> DataFrame:
    """Trigger count, count per category, IV-weighted score in percent and the list of names."""
    h = [F.coalesce(F.col(f"hit_{i}"), F.lit(0)) for i in range(len(triggers))]
    add = lambda cs: sum(cs[1:], cs[0]) if cs else F.lit(0)
    weight = sum(t.weight for t, f in zip(triggers, found) if skip_in_weight or _live(t, f))
    cols = {"n_hits": add(h)}
    if weight > 0:
        points = add([c * F.lit(float(t.weight)) for c, t in zip(h, triggers)])
        cols["score"] = F.round(points / F.lit(weight) * 100, 2)
    else:
        cols["score"] = F.lit(0.0)
    for cat in dict.fromkeys(t.category_short for t, f in zip(triggers, found) if _live(t, f)):
        cols[f"hits_{cat}"] = add([c for c, t in zip(h, triggers) if t.category_short == cat])
    names = F.array(*[F.when(c == 1, F.lit(t.name)) for c, t in zip(h, triggers)])
    cols["hit_names"] = F.concat_ws("; ", names)
    return wide.withColumns(cols)


def long_table(wide: DataFrame, triggers: list[Trigger], found: list[dict], *, key: str,
               target: str, keep: list[str] = ()) -> DataFrame:
    """One row per (entity, hit trigger) with its threshold, direction and scope."""
    cells = F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.col(f"value_{i}").alias("value"), F.col(f"hit_{i}").alias("hit"))
        for i in range(len(triggers))]))
    info = wide.sparkSession.createDataFrame(
        [(i, t.name, t.category, float(t.iv), t.direction, scope_label(t.scope), f["operator"],
          f["value"], f["source"]) for i, (t, f) in enumerate(zip(triggers, found))],
        "i int, trigger string, category string, iv double, direction string, scope string, "
        "operator string, threshold double, threshold_source string")
    return (wide.select(key, *keep, target, cells.alias("c")).where(F.col("c.hit") == 1)
            .select(key, *keep, target, "c.i", "c.value")
            .join(F.broadcast(info), "i").drop("i"))  # one row per configured trigger


def slim(wide: DataFrame, *, key: str, keep: list[str] = ()) -> DataFrame:
    """Export form: metadata and target are dropped unless listed."""
    fixed = {key, "n_hits", "score", "hit_names"}
    return wide.select(*[c for c in wide.columns if c in fixed or c in set(keep)
                         or c.startswith(("value_", "hit_", "hits_"))])


def hit_summary(wide: DataFrame, triggers: list[Trigger], target: str) -> DataFrame:
    """Hit rate and bad hit rate of every trigger, in percent."""
    bad = F.col(target) == 1
    aggs = []
    for i in range(len(triggers)):
        h = F.col(f"hit_{i}")
        aggs += [F.count(h).alias(f"a_{i}"), F.count_if(h == 1).alias(f"b_{i}"),
                 F.count_if((h == 1) & bad).alias(f"c_{i}"),
                 F.count_if(h.isNotNull() & bad).alias(f"d_{i}")]
    cells = F.explode(F.array(*[
        F.struct(F.lit(t.name).alias("trigger"), F.col(f"a_{i}").alias("n_valid"),
                 F.col(f"b_{i}").alias("n_hit"), F.col(f"c_{i}").alias("n_bad_hit"),
                 F.col(f"d_{i}").alias("n_bad")) for i, t in enumerate(triggers)]))
    pct = lambda a, b: F.coalesce(F.try_divide(F.col(a) * 100.0, F.col(b)), F.lit(0.0))
    return (wide.agg(*aggs).select(cells.alias("c")).select("c.*")
            .withColumn("hit_pct", pct("n_hit", "n_valid"))
            .withColumn("bad_hit_pct", pct("n_bad_hit", "n_bad")))


def class_summary(scored: DataFrame, target: str) -> DataFrame:
    return scored.groupBy(target).agg(F.count("*").alias("n"), F.avg("n_hits").alias("avg_hits"),
                                      F.avg("score").alias("avg_score"))


def score_bands(scored: DataFrame, target: str) -> DataFrame:
    """Entities and bad rate per score band; a score of zero has its own band."""
    s = F.col("score")
    band = F.when(s <= 0, "0")
    for lo, hi in BANDS:
        band = band.when(s <= hi, f"{lo}-{hi}" if hi < 100 else f"{lo}+")
    return (scored.groupBy(band.alias("band"))
            .agg(F.count("*").alias("n"), F.sum(F.col(target).cast("bigint")).alias("n_bad"))
            .withColumn("bad_pct", F.col("n_bad") / F.col("n") * 100))


def extract(df: DataFrame, triggers: list[Trigger], *, key: str, target: str,
            keep: list[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The whole job: (scored wide table, long hit table, threshold table)."""
    found = thresholds(df, triggers, target)
    wide = score(flags(df, triggers, found, key=key, target=target, keep=keep), triggers, found)
    return (wide, long_table(wide, triggers, found, key=key, target=target, keep=keep),
            threshold_table(df.sparkSession, found))

"""Ratio features from declarative specs, and winsorising.

A spec is a list of ``Feature`` rows: output name, the input columns it needs, and an expression
over them. A feature is built only when all its inputs exist. All features of a table come from one
projection.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from risklens.functions.labels import safe_divide
from risklens.operators.quantiles import group_quantiles


@dataclass(frozen=True)
class Feature:
    name: str
    needs: tuple[str, ...]
    build: Callable[..., Column]
    winsorise: bool = True
    only_if_absent: bool = False


def ratio(name: str, num: str, den: str, **kw) -> Feature:
    return Feature(name, (num, den), lambda n, d: safe_divide(n, d), **kw)


def z(c: Column) -> Column:
    return F.coalesce(c.cast("double"), F.lit(0.0))


def build_features(df: DataFrame, specs: list[Feature],
                   names: dict[str, str] | None = None) -> DataFrame:
    """Add the features whose inputs exist; ``names`` maps spec inputs to actual columns."""
    names = names or {}
    have = set(df.columns)
    # A feature may use an earlier one: columns already defined are inlined as expressions.
    made: dict[str, Column] = {}

    def source(c: str) -> Column | None:
        if c in made:
            return made[c]
        actual = names.get(c, c)
        return F.col(f"`{actual}`") if actual in have else None

    for s in specs:
        if s.only_if_absent and names.get(s.name, s.name) in have:
            continue
        args = [source(c) for c in s.needs]
        if all(a is not None for a in args):
            made[s.name] = s.build(*args)
    return df.withColumns(made)


def winsorise(df: DataFrame, features: list[str], lower: float = 0.01, upper: float = 0.99,
              min_n: int = 20) -> DataFrame:
    """Clip every feature to its exact quantiles; short or flat columns stay as they are."""
    features = [f for f in features if f in df.columns]
    if not features:
        return df
    pairs = F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"`{f}`").cast("double").alias("x"))
        for f in features]))
    q = group_quantiles(df.select(pairs.alias("p")).select("p.*"), ["feature"], [lower, upper])
    limits = {r["feature"]: r["q"] for r in q.collect() if r["n"] >= min_n and r["q"][0] != r["q"][1]}
    return df.withColumns({
        f: F.when(F.col(f"`{f}`").isNotNull(),
                  F.least(F.lit(hi), F.greatest(F.lit(lo), F.col(f"`{f}`").cast("double"))))
        for f, (lo, hi) in limits.items()})


# The credit-report features.
_I, _B, _NB = "institutions", "bank_institutions", "nonbank_institutions"
_SL, _CF, _OPEN = "small_loan_companies", "consumer_finance_companies", "open_institutions"
_GQ, _OD, _ODB = "guarantor_queries", "overdue_institutions", "overdue_balance"
CREDIT_INPUTS = (_GQ, _I, _OPEN, _NB, _B, _OD, _ODB, _SL, _CF)


def _pos(c: Column) -> Column:
    return F.coalesce(c > 0, F.lit(False)).cast("int")


CREDIT = [
    ratio("nonbank_share", _NB, _I), ratio("bank_share", _B, _I),
    ratio("small_loan_share", _SL, _I), ratio("consumer_finance_share", _CF, _I),
    ratio("open_share", _OPEN, _I),
    Feature("high_risk_channels", (_SL, _CF), lambda a, b: a + b),
    ratio("high_risk_share", "high_risk_channels", _I),
    Feature("has_high_risk", ("high_risk_channels",), _pos),
    ratio("nonbank_bank_ratio", _NB, _B),
    Feature("credit_spread", (_I,), lambda a: F.log1p(a)),
    ratio("query_open_ratio", _GQ, _OPEN), ratio("query_institution_ratio", _GQ, _I),
    Feature("high_risk_open_cross", ("high_risk_channels", _OPEN), lambda a, b: a * b),
    Feature("settled_share", (_I, _OPEN), lambda t, o: safe_divide(t - o, t)),
    ratio("overdue_share", _OD, _I), ratio("queries_per_institution", _GQ, _I),
    ratio("open_per_institution", _OPEN, _I),
    Feature("overdue_per_lender", (_ODB, _NB, _B), lambda o, n, b: safe_divide(o, n + b)),
    Feature("pure_nonbank_share", (_NB, _B), lambda n, b: safe_divide(n, n + b)),
    ratio("review_pressure", _GQ, _OPEN),
    Feature("high_risk_total", (_SL, _CF), lambda a, b: a + b),
    Feature("high_risk_total_share", (_SL, _CF, _I), lambda a, b, t: safe_divide(a + b, t)),
    Feature("channel_variety", (_B, _NB, _SL, _CF),
            lambda a, b, c, d: _pos(a) + _pos(b) + _pos(c) + _pos(d)),
    Feature("log_institutions", (_I,), lambda a: F.log1p(z(a))),
    Feature("log_open_institutions", (_OPEN,), lambda a: F.log1p(z(a))),
]


def credit_features(df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    return build_features(df, CREDIT, names)


# The change-history features.
CHANGE_WINDOWS = (30, 90, 180, 365)
CHANGE_SHORT_WINDOWS = (30, 90)
CHANGE_HIGH_RISK = ("legal_rep", "shareholder", "capital")


def change_features(df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Window shares, type concentration, high-risk counts and net tag change."""
    names = names or {}
    have = {k for k in _change_inputs() if names.get(k, k) in df.columns}
    specs = [ratio(f"change_share_{d}d", f"changes_{d}d", "changes_total") for d in CHANGE_WINDOWS]
    specs.append(Feature("type_concentration", ("change_types", "changes_total"),
                         lambda t, n: 1 - safe_divide(t, n)))
    cumulative = tuple(f"{k}_changes" for k in CHANGE_HIGH_RISK if f"{k}_changes" in have)
    if cumulative:
        specs.append(Feature("high_risk_changes", cumulative, lambda *c: _total(c)))
        specs.append(ratio("high_risk_change_share", "high_risk_changes", "changes_total"))
    for d in CHANGE_SHORT_WINDOWS:
        cols = tuple(f"{k}_changes_{d}d" for k in CHANGE_HIGH_RISK if f"{k}_changes_{d}d" in have)
        if cols:
            specs.append(Feature(f"high_risk_changes_{d}d", cols, lambda *c: _total(c)))
    specs.append(Feature("net_tags", ("tags_added", "tags_removed"), lambda a, r: z(a) - z(r)))
    return build_features(df, specs, names)


def _total(cols) -> Column:
    out = z(cols[0])
    for c in cols[1:]:
        out = out + z(c)
    return out


def _change_inputs() -> list[str]:
    return (["changes_total", "change_types", "tags_added", "tags_removed"]
            + [f"changes_{d}d" for d in CHANGE_WINDOWS]
            + [f"{k}_changes" for k in CHANGE_HIGH_RISK]
            + [f"{k}_changes_{d}d" for k in CHANGE_HIGH_RISK for d in CHANGE_SHORT_WINDOWS])


# The financial ratios.
def _loans(s: Column, l: Column) -> Column:
    return z(s) + z(l)


_TA, _CA, _CL, _TL = "total_assets", "current_assets", "current_liabilities", "total_liabilities"
_EQ, _REV, _COST, _CASH = "equity", "revenue", "operating_cost", "cash"
_STB, _LTB, _OCF, _NP = "short_term_loans", "long_term_loans", "operating_cash_in", "net_profit"
_TP, _FE, _INT, _AR, _INV = ("total_profit", "finance_expense", "interest_expense", "receivables",
                             "inventory")
_LINE, _BAL = "credit_line", "on_balance_credit"

FINANCE = [
    Feature("working_capital", (_CA, _CL), lambda a, b: a - b, winsorise=False),
    ratio("working_capital_ratio", "working_capital", _TA),
    ratio("short_loan_pressure", _STB, _CA), ratio("short_loan_share", _STB, _TL),
    ratio("long_liability_ratio", "noncurrent_liabilities", _TA),
    Feature("loan_dependence", (_STB, _LTB, _TA), lambda s, l, t: safe_divide(_loans(s, l), t)),
    ratio("equity_multiplier", _TA, _EQ), ratio("debt_equity_ratio", _TL, _EQ),
    ratio("interest_cover", _TP, _FE), ratio("interest_revenue_share", _INT, _REV),
    ratio("receivable_revenue_share", _AR, _REV), ratio("inventory_revenue_share", _INV, _REV),
    Feature("receivable_inventory_share", (_AR, _INV, _CA),
            lambda a, i, c: safe_divide(z(a) + z(i), c)),
    ratio("inventory_asset_share", _INV, _CA, only_if_absent=True),
    ratio("receivable_asset_share", _AR, _CA, only_if_absent=True),
    ratio("cash_asset_share", _CASH, _CA, only_if_absent=True),
    ratio("intangible_share", "intangible_assets", _TA),
    ratio("equity_investment_share", "long_equity_investment", _TA),
    ratio("noncurrent_asset_share", "noncurrent_assets", _TA),
    ratio("payable_turnover", _COST, "payables"), ratio("payable_cost_share", "payables", _COST),
    ratio("fixed_asset_turnover", _REV, "fixed_assets"),
    ratio("working_capital_turnover", _REV, "working_capital"),
    ratio("asset_cash_quality", _OCF, _TA),
    Feature("cost_profit_ratio", (_TP, _COST, "period_expenses"),
            lambda p, c, e: safe_divide(p, z(c) + z(e))),
    ratio("cost_ratio", _COST, _REV), ratio("research_intensity", "research_expense", _REV),
    ratio("admin_expense_ratio", "admin_expense", _REV),
    ratio("sales_expense_ratio", "sales_expense", _REV),
    ratio("finance_expense_ratio", _FE, _REV),
    ratio("profit_cash_ratio", _NP, _OCF), ratio("cash_profit_ratio", _OCF, _NP),
    ratio("retained_earnings_share", "retained_earnings", _EQ),
    ratio("surplus_reserve_share", "surplus_reserve", _EQ),
    Feature("cash_loan_cover", (_OCF, _STB, _LTB), lambda c, s, l: safe_divide(c, _loans(s, l))),
    ratio("cash_interest_cover", _OCF, _INT),
    Feature("free_cash_flow", (_OCF, "investing_net"), lambda c, i: z(c) - F.abs(z(i)),
            winsorise=False),
    Feature("cash_months", (_CASH, _COST), lambda c, k: safe_divide(c, k / 12)),
    ratio("cash_short_loan_cover", _CASH, _STB),
    ratio("financing_dependence", "financing_cash_in", _OCF),
    ratio("investing_cash_share", "investing_cash_in", _OCF),
    ratio("line_usage", _BAL, _LINE), ratio("line_asset_ratio", _LINE, _TA),
    ratio("line_revenue_ratio", _LINE, _REV), ratio("line_equity_ratio", _LINE, _EQ),
    ratio("line_cash_ratio", _LINE, _OCF),
    Feature("own_loan_share", (_BAL, _STB, _LTB),
            lambda b, s, l: _cap(safe_divide(b, _loans(s, l)))),
    Feature("other_bank_loans", (_BAL, _STB, _LTB),
            lambda b, s, l: F.greatest(F.lit(0.0), _loans(s, l) - z(b)), winsorise=False),
    Feature("debt_revenue_ratio", (_STB, _LTB, _REV),
            lambda s, l, r: safe_divide(_loans(s, l), r)),
    ratio("paid_in_capital_share", "paid_in_capital", _TA),
    ratio("capital_reserve_share", "capital_reserve", _EQ),
    Feature("paid_in_loan_ratio", ("paid_in_capital", _STB, _LTB),
            lambda p, s, l: safe_divide(p, _loans(s, l))),
]


def _cap(c: Column) -> Column:
    return F.when(c.isNotNull(), F.least(F.lit(1.0), c))


def finance_features(df: DataFrame, names: dict[str, str] | None = None,
                     clip: bool = True) -> DataFrame:
    """Financial ratios; the ratios (not the three amounts) are winsorised at 1 % / 99 %."""
    out = build_features(df, FINANCE, names)
    if not clip:
        return out
    return winsorise(out, [s.name for s in FINANCE if s.winsorise and s.name in out.columns])

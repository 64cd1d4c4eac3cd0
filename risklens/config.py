"""Column roles, sample gates and label thresholds used across the library."""

from __future__ import annotations

from dataclasses import dataclass, field

ALL = "__all__"
TAG_DIM = "__tag__"
TAG_PREFIX = "is_"


@dataclass(frozen=True)
class Roles:
    """Which columns of a wide table play which part."""

    key: str
    target: str
    features: tuple[str, ...]
    dims: tuple[str, ...] = ()
    tags: tuple[str, ...] = ()
    derived: tuple[str, ...] = ()

    @property
    def raw(self) -> tuple[str, ...]:
        return tuple(f for f in self.features if f not in self.derived)

    def only(self, *features: str) -> "Roles":
        return Roles(self.key, self.target, tuple(features), self.dims, self.tags,
                     tuple(f for f in self.derived if f in features))


# Sample gates.
@dataclass(frozen=True)
class Gates:
    min_n: int = 50
    min_bad_iv: int = 10
    min_bad_corr: int = 15
    min_good_corr: int = 30
    min_bad_lr: int = 20
    min_good_lr: int = 50
    min_n_cv: int = 200
    min_bad_cv: int = 30


# Information-value settings.
@dataclass(frozen=True)
class IvSettings:
    bins: int = 10
    min_bins: int = 3
    full_bins_n: int = 300
    full_bins_bad: int = 30
    woe_cap: float = 5.0
    suspect: float = 2.0
    too_strong: float = 0.5
    strong: float = 0.3
    medium: float = 0.1
    weak: float = 0.02
    strict_bad: int = 20
    low_bad_iv: float = 0.5
    low_n: int = 200
    reference_iv: float = 1.0


# Rule mining.
@dataclass(frozen=True)
class RuleSettings:
    max_depth: int = 3
    min_leaf_ratio: float = 0.05
    min_leaf_floor: int = 10
    min_bad_in_leaf: int = 5
    min_coverage: float = 0.01
    min_lift: float = 1.5
    top_k: int = 10
    holdout_ratio: float = 0.3
    holdout_min_bad: int = 10
    bootstrap_n: int = 200
    min_valid_ratio: float = 0.6
    cv_stable: float = 0.20
    cv_fair: float = 0.40
    lift_stop: float = 3.0
    lift_warn: float = 2.0
    decimals: int = 4


# Threshold exploration.
@dataclass(frozen=True)
class ThresholdSettings:
    min_ratio: float = 2.0
    max_p: float = 0.05
    min_bad_high: int = 10
    alert_min: float = 0.01
    alert_max: float = 0.30
    min_iv: float = 0.02
    min_n: int = 50
    min_bad: int = 10
    ratio_cap: float = 999.0
    zero_inflated: float = 0.80
    min_bin_share: float = 0.05
    pre_bins: int = 20
    max_bins: int = 8
    stars: tuple = field(default=((0.001, "***"), (0.01, "**"), (0.05, "*")))


GATES = Gates()
IV = IvSettings()
RULES = RuleSettings()
THRESHOLDS = ThresholdSettings()

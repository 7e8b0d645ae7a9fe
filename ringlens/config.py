"""Settings of the operators, all with the defaults the results are defined by."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from ringlens import constants


@dataclass(frozen=True)
class FeatureConfig:
    """How calls are read and enriched.

    ``heavy_rows`` is the number of calls above which one reporter is handled
    by the hierarchical plan instead of a window over all of its calls.
    """

    work_days: tuple[int, ...] = (0, 1, 2, 3, 4)  # Monday is 0
    first_hour: int = 7
    last_hour: int = 19
    success_seconds: float = 20.0
    prefix_length: int = 4
    other_provider: str = "others"
    out_type: int = 1
    in_type: int = 2
    out_missed_type: int = 3
    in_missed_type: int = 4
    heavy_rows: int = 4_000_000


@dataclass(frozen=True)
class LabelRules:
    """Evidence a number needs before feedback labels it."""

    spam_members: int = 3
    spam_reports: int = 5
    spam_rate: float = 0.70
    ham_members: int = 3
    ham_reports: int = 5
    ham_rate: float = 0.70
    strong_total: int = 6
    volume_floor: int = 8
    volume_quantile: float = 0.95
    volume_min_phones: int = 50


@dataclass(frozen=True)
class RiskConfig:
    """Levels and limits of the risk evaluation."""

    score_levels: tuple[tuple[float, int], ...] = tuple(constants.SCORE_LEVELS)
    foreign_prefixes: tuple[str, ...] = tuple(constants.RISKY_FOREIGN_PREFIXES)
    domestic_prefixes: tuple[str, ...] = tuple(constants.RISKY_DOMESTIC_PREFIXES)
    blacklist: tuple[str, ...] = tuple(constants.BLACKLISTED_PHONES)
    blacklist_level: int = 4
    foreign_level: int = 2
    foreign_risky_level: int = 3
    prefix_level: int = 2
    prefix_short_level: int = 3
    short_seconds: float = 5.0
    short_min_calls: int = 2
    missed_level: int = 3
    missed_ratio: float = 0.60
    missed_min_calls: int = 5
    frequent_level: int = 3
    frequent_per_day: float = 10.0
    frequent_short_seconds: float = 10.0
    callback_level: int = 2
    callback_rate: float = 0.10
    callback_min_calls: int = 5
    out_of_hours_level: int = 2
    contact_credit: int = 2
    history_credit: int = 1
    history_min_calls: int = 5
    history_min_seconds: float = 60.0
    foreign_floor: int = 1
    messages: dict[int, tuple[str, str]] = field(default_factory=lambda: dict(constants.LEVEL_MESSAGES))


    @classmethod
    def from_mapping(cls, settings: Mapping[str, Any]) -> RiskConfig:
        """Settings as a configuration file holds them.

        A list that the mapping does not have is empty; a number that it does
        not have keeps its default.
        """
        known: dict[str, Any] = {
            "score_levels": tuple((float(limit), int(level)) for limit, level in settings.get("model_thresholds") or ()),
            "foreign_prefixes": tuple(map(str, settings.get("intl_risk_prefixes") or ())),
            "domestic_prefixes": tuple(map(str, settings.get("domestic_risk_prefixes") or ())),
            "blacklist": tuple(map(str, settings.get("hard_blacklist_numbers") or ())),
            "messages": {
                int(level): (text.get("title", ""), text.get("subtitle", ""))
                for level, text in (settings.get("level_messages") or {}).items()
            },
        }
        for section, names in RISK_SECTIONS.items():
            given = settings.get(section) or {}
            known |= {field_name: given[name] for name, field_name in names.items() if name in given}
        return cls(**known)

    def to_mapping(self) -> dict[str, Any]:
        """What ``from_mapping`` reads, so far as a configuration file has a name for it."""
        return {
            "model_thresholds": [list(pair) for pair in self.score_levels],
            "intl_risk_prefixes": list(self.foreign_prefixes),
            "domestic_risk_prefixes": list(self.domestic_prefixes),
            "hard_blacklist_numbers": list(self.blacklist),
            "level_messages": {
                str(level): {"title": title, "subtitle": subtitle} for level, (title, subtitle) in self.messages.items()
            },
            **{
                section: {name: getattr(self, field_name) for name, field_name in names.items()}
                for section, names in RISK_SECTIONS.items()
            },
        }


#: Sections and names of a risk configuration, and the fields they set.
RISK_SECTIONS = {
    "rule_levels": {
        "hard_blacklist": "blacklist_level", "intl_base": "foreign_level", "intl_prefix_boost_to": "foreign_risky_level",
        "domestic_prefix_base": "prefix_level", "domestic_short_call_boost_to": "prefix_short_level",
        "behavior_miss_ratio_to": "missed_level", "behavior_high_freq_to": "frequent_level",
        "behavior_low_callback_to": "callback_level",
    },
    "behavior_rules": {
        "short_call_min_total": "short_min_calls", "short_call_seconds": "short_seconds",
        "miss_ratio_min_total": "missed_min_calls", "miss_ratio_high": "missed_ratio",
        "high_freq_per_day": "frequent_per_day", "high_freq_short_call_seconds": "frequent_short_seconds",
        "low_callback_rate": "callback_rate", "low_callback_min_total": "callback_min_calls",
        "outside_business_hour_level": "out_of_hours_level",
    },
    "whitelist_adjustments": {
        "in_contact_reduce": "contact_credit", "good_history_reduce": "history_credit",
        "good_history_min_success_calls": "history_min_calls",
        "good_history_min_avg_in_duration": "history_min_seconds", "intl_min_level_after_reduce": "foreign_floor",
    },
}


@dataclass(frozen=True)
class SplitConfig:
    test_share: float = 0.15
    validation_share: float = 0.20
    seed: int = 42


@dataclass(frozen=True)
class TreeParams:
    """Boosted-tree settings.

    Of ``rounds`` trees the model keeps those up to the lowest loss on
    validation rows that ``patience`` further rounds do not lower.
    """

    rounds: int = 100
    depth: int = 6
    learning_rate: float = 0.05
    row_sample: float = 0.8
    column_sample: float = 0.8
    bins: int = 256
    min_child_rows: int = 1
    min_gain: float = 0.0
    patience: int = 50
    seed: int = 42


@dataclass(frozen=True)
class SearchSpace:
    """Ranges (low, high) that tuning draws from, ends included; rounds and bins in steps."""

    rounds: tuple[int, int] = (800, 3500)
    rounds_step: int = 100
    depth: tuple[int, int] = (3, 10)
    min_child_rows: tuple[float, float] = (1.0, 12.0)
    learning_rate: tuple[float, float] = (0.01, 0.2)
    row_sample: tuple[float, float] = (0.6, 1.0)
    column_sample: tuple[float, float] = (0.5, 1.0)
    min_gain: tuple[float, float] = (0.0, 0.08)
    bins: tuple[int, int] = (128, 512)
    bins_step: int = 64
    patience: int = 80

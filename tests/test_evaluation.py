"""Metrics, thresholds, splits, the gate and risk levels."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from ringlens.config import RiskConfig, SplitConfig
from ringlens.constants import BLACKLISTED_PHONES, RISKY_FOREIGN_PREFIXES
from ringlens.operators import risk
from ringlens.operators.metrics import Grid, best_threshold, class_weight, metrics_at, roc_auc, threshold_sweep
from ringlens.operators.promotion import promotion_gate
from ringlens.operators.risk import evaluate_risk, lowered, model_level, risk_features, rule_level, trust_credit
from ringlens.operators.split import stratified_split


def scored(spark, rows):
    return spark.createDataFrame(rows, "label int, score double")


def random_scores(seed, rows=300):
    """Scores that sit on thresholds, just beside them, outside the grid, and a third on one value."""
    rng = random.Random(seed)
    grid = [0.01 + i * 0.01 for i in range(99)]
    pool = [*grid, *(math.nextafter(g, 0) for g in grid), *(math.nextafter(g, 1) for g in grid), 0.0, 1.0, 0.005]
    return [(rng.randrange(2), 0.3 if rng.random() < 0.33 else rng.choice(pool)) for _ in range(rows)]


def test_class_weight(spark):
    def weight(negative, positive):
        return class_weight(scored(spark, [(0, 0.1)] * negative + [(1, 0.1)] * positive)).first()[0]

    assert (weight(10, 2), weight(5, 0), weight(0, 5)) == (5.0, 1.0, 1.0)


def test_grid_is_built_by_one_formula():
    assert Grid().size == 99
    assert Grid(step=0.05).size == 20


@pytest.mark.parametrize("seed", [1, 2])
def test_sweep_matches_brute_force(spark, seed):
    rows = random_scores(seed)
    got = {r["threshold"]: (r["tn"], r["fp"], r["fn"], r["tp"]) for r in threshold_sweep(scored(spark, rows)).collect()}
    expected = {}
    for t in (0.01 + i * 0.01 for i in range(99)):
        cells = [(y, s >= t) for y, s in rows]
        expected[t] = tuple(cells.count(c) for c in [(0, False), (0, True), (1, False), (1, True)])
    assert got == expected


def test_best_threshold(spark):
    rows = list(zip([0, 0, 1, 1, 1], [0.1, 0.4, 0.35, 0.8, 0.9]))
    best = best_threshold(scored(spark, rows), Grid(step=0.05)).first()
    assert best["threshold"] == pytest.approx(0.11)
    assert best["f1"] == pytest.approx(6 / 7)


def test_single_class_keeps_one_half(spark):
    best = best_threshold(scored(spark, [(1, 0.7), (1, 0.2)])).first()
    assert (best["threshold"], best["tp"], best["fn"], best["f1"]) == (0.5, 1, 1, pytest.approx(2 / 3))
    assert roc_auc(scored(spark, [(1, 0.7), (1, 0.2)])).first()["auc"] is None


def test_undefined_measures_are_zero(spark):
    row = metrics_at(scored(spark, [(0, 0.1), (1, 0.2)]), [0.5]).first()
    assert (row["precision"], row["recall"], row["f1"], row["accuracy"]) == (0.0, 0.0, 0.0, 0.5)


@pytest.mark.parametrize("seed", [3, 4])
def test_auc_matches_brute_force(spark, seed):
    rows = random_scores(seed)
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    pairs = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert roc_auc(scored(spark, rows)).first()["auc"] == pytest.approx(pairs / (len(pos) * len(neg)), abs=1e-12)


def test_split_sizes_and_stability(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("key"), (F.col("id") % 4 == 0).cast("int").alias("label"))
    done = stratified_split(rows, "key")
    sizes = {(r["label"], r["role"]): r["count"] for r in done.groupBy("label", "role").count().collect()}
    for label, n in ((0, 750), (1, 250)):
        test = math.ceil(0.15 * n)
        held_out = math.ceil(0.2 * (n - test))
        assert sizes[label, "test"] == test
        assert sizes[label, "validation"] == held_out
        assert sizes[label, "train"] == n - test - held_out
    again = stratified_split(rows.orderBy(F.desc("key")), "key")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, done.collect()))
    other = stratified_split(rows, "key", config=SplitConfig(seed=7))
    assert sorted(map(tuple, other.collect())) != sorted(map(tuple, done.collect()))


def test_copies_of_a_key_share_a_role(spark):
    rows = spark.createDataFrame([("same", 1)] * 50 + [(str(i), 1) for i in range(100)], "key string, label int")
    done = stratified_split(rows, "key")
    assert done.count() == 150
    assert done.where("key = 'same'").select("role").distinct().count() == 1


GATE = [
    # new_auc, old_auc, new_f1, old_f1, has_old, promoted, reason
    (0.9, None, 0.8, None, False, True, "no_old_metrics"),
    (0.9, 0.8, 0.1, 0.9, True, True, "better_auc_val"),
    (0.8, 0.9, 0.9, 0.1, True, False, "not_better_auc_val"),
    (0.8, 0.8, 0.9, 0.8, True, True, "tie_auc_val_better_f1@best"),
    (0.8, 0.8, 0.8, 0.8, True, False, "not_better_auc_val"),
    (0.8, 0.8, None, 0.8, True, False, "not_better_auc_val"),
    (None, 0.8, 0.9, 0.8, True, True, "better_f1@best"),
    (0.8, float("nan"), 0.7, 0.8, True, False, "not_better_f1@best"),
    (None, 0.8, None, 0.8, True, False, "new_f1@best_missing"),
    (None, None, 0.8, None, True, True, "old_f1@best_missing_new_has"),
]


def test_promotion_gate(spark):
    df = spark.createDataFrame(
        [(i, *row[:5]) for i, row in enumerate(GATE)],
        "i int, new_auc double, old_auc double, new_f1 double, old_f1 double, has_old boolean",
    )
    got = [(r["promoted"], r["reason"]) for r in promotion_gate(df).orderBy("i").collect()]
    assert got == [row[5:] for row in GATE]


PLAIN = {
    "phone": "0912345678", "prefix": "091", "is_international": False, "total_call": 1, "miss_call": 0,
    "avg_duration": 30.0, "frequency_per_day": 1.0, "callback_rate": 0.5, "mostly_out_of_business_hour": False,
    "in_contact": False, "successful_call_count": 0, "avg_in_duration": 0.0, "score": 0.0,
}
KINDS = (
    "phone string, prefix string, is_international boolean, total_call int, miss_call int, avg_duration double, "
    "frequency_per_day double, callback_rate double, mostly_out_of_business_hour boolean, in_contact boolean, "
    "successful_call_count int, avg_in_duration double, score double"
)


def case(spark, **changes):
    return spark.createDataFrame([tuple({**PLAIN, **changes}.values())], KINDS)


def rules(spark, **changes):
    level, reasons = rule_level()
    return tuple(case(spark, **changes).select(level, reasons).first())


def test_model_levels(spark):
    scores = [0.1, 0.29, 0.30, 0.35, 0.6, 0.75, 0.9, 1.5]
    df = spark.createDataFrame([(s,) for s in scores], "score double")
    assert [r[0] for r in df.select(model_level(F.col("score"))).collect()] == [0, 0, 1, 1, 2, 3, 4, 4]


def test_rule_levels(spark):
    assert rules(spark) == (0, [])
    level, reasons = rules(spark, phone=BLACKLISTED_PHONES[0], mostly_out_of_business_hour=True)
    assert (level, len(reasons)) == (4, 1)
    assert rules(spark, total_call=10, miss_call=8)[0] == 3
    assert rules(spark, total_call=10, miss_call=6)[0] == 0
    risky = RISKY_FOREIGN_PREFIXES[0]
    assert rules(spark, phone=f"+{risky}123456", prefix=risky, is_international=True)[0] == 3
    assert rules(spark, phone="+331234567", prefix="33", is_international=True)[0] == 2
    assert rules(spark, frequency_per_day=15.0, avg_duration=5.0)[0] == 3
    assert rules(spark, callback_rate=0.05, total_call=5)[0] == 2
    assert rules(spark, mostly_out_of_business_hour=True)[0] == 2
    assert rules(spark, phone="0241234567", prefix="024")[0] == 2
    level, reasons = rules(spark, phone="0241234567", prefix="024", total_call=2, avg_duration=4.0)
    assert level == 3 and "024" in reasons[0]


@pytest.mark.parametrize(
    ("base", "changes", "final", "credit"),
    [
        (3, {"in_contact": True}, 1, -2),
        (1, {"in_contact": True, "successful_call_count": 10, "avg_in_duration": 120.0}, 0, -3),
        (1, {"in_contact": True, "is_international": True}, 1, -2),
        (3, {"successful_call_count": 5, "avg_in_duration": 60.0}, 2, -1),
        (3, {"successful_call_count": 5, "avg_in_duration": 59.0}, 3, 0),
    ],
)
def test_trust(spark, base, changes, final, credit):
    got = case(spark, **changes).select(lowered(F.lit(base), trust_credit()), trust_credit()).first()
    assert tuple(got) == (final, credit)


@pytest.mark.parametrize(
    ("changes", "levels"),
    [
        (
            {
                "score": 0.85, "total_call": 15, "miss_call": 12, "avg_duration": 4.5, "frequency_per_day": 10.0,
                "callback_rate": 0.05, "mostly_out_of_business_hour": True,
            },
            (4, 3, 4),
        ),
        ({"score": 0.8, "total_call": 10, "miss_call": 2, "avg_duration": 45.0}, (3, 0, 3)),
        ({"score": 0.1}, (0, 0, 0)),
        ({"score": 0.95}, (4, 0, 4)),
    ],
)
def test_whole_evaluation(spark, changes, levels):
    row = evaluate_risk(case(spark, **changes), "score").first()
    assert (row["model_level"], row["rule_level"], row["final_level"]) == levels
    assert row["reasons"][0].endswith(f"{changes['score']:.2f} (Level {levels[0]}).")
    assert len(row["reasons"]) == (1 if levels[1] == 0 else 2 + 4)


def test_pool_row_to_level(spark):
    df = spark.createDataFrame(
        [(" +84912345678 ", 0.3, 10, 3, 2, 600.0, 2.0, 0.4, 8.0, 2.0, 1.0, 5, 45.0)],
        "phone string, Score double, sum_call int, call_to_miss int, call_in_miss int, duration double, "
        "mean_call_by_day double, call_back_rate double, in_hour double, not_in_hour double, "
        "avg_in_contact double, total_contacted int, avg_duration_call_in double",
    )
    row = evaluate_risk(risk_features(df, keep=("Score",))).first()
    assert (row["phone"], row["model_level"], row["rule_level"], row["final_level"]) == ("+84912345678", 1, 0, 0)
    assert row["features_used"]["avg_duration"] == 60.0


def test_limits_are_configurable(spark):
    config = RiskConfig(score_levels=((0.5, 0), (1.01, 1)), domestic_prefixes=(), foreign_prefixes=(), blacklist=())
    row = evaluate_risk(case(spark, score=0.7, phone="1900123", prefix="1"), "score", config).first()
    assert (row["model_level"], row["rule_level"], row["final_level"]) == (1, 0, 1)


def test_features_may_be_missing_or_text(spark):
    df = spark.createDataFrame([("0912000001", "7", "x", None)], "phone string, sum_call string, duration string, in_hour double")
    row = risk_features(df).first()
    assert (row["total_call"], row["avg_duration"], row["in_contact"]) == (7, 0.0, False)


def test_rows_without_a_key_are_split_like_others(spark):
    rows = spark.range(2000).select(
        F.when(F.col("id") % 10 < 4, None).otherwise(F.col("id")).alias("key"), (F.col("id") % 2).alias("label"), F.col("id").alias("x")
    )
    sizes = {r.role: r["count"] for r in stratified_split(rows, "key").groupBy("role").count().collect()}
    assert sizes == {"test": 300, "validation": 340, "train": 1360}
    keyless = stratified_split(rows, "key").where("key is null").groupBy("role").count().collect()
    assert {r.role for r in keyless} == {"test", "validation", "train"}


def test_all_measures_leave_out_the_same_rows(spark):
    from ringlens.operators.metrics import left_out, metrics_at, roc_auc, threshold_sweep

    good = [(1, 0.9), (0, 0.2), (1, 0.6), (0, 0.7)]
    odd = [(1, None), (0, float("nan")), (None, 0.5), (2, 0.5), (None, None)]
    clean = spark.createDataFrame(good, "label int, score double")
    dirty = spark.createDataFrame(good + odd, "label int, score double")
    for measure in (roc_auc, threshold_sweep, lambda df: metrics_at(df, [0.5, 0.98])):
        assert sorted(map(tuple, measure(dirty).collect())) == sorted(map(tuple, measure(clean).collect()))
    assert tuple(left_out(dirty).first()) == (9, 5)


def test_settings_from_a_mapping(spark):
    from ringlens.config import RiskConfig

    plain = RiskConfig.from_mapping({})
    assert plain.score_levels == () and plain.blacklist == () and plain.messages == {}
    assert plain.missed_level == 3 and plain.short_seconds == 5.0 and plain.foreign_floor == 1
    given = RiskConfig.from_mapping(
        {
            "model_thresholds": [[0.5, 1], [1.01, 4]], "hard_blacklist_numbers": [113], "rule_levels": {"hard_blacklist": 3},
            "behavior_rules": {"miss_ratio_high": 0.9}, "level_messages": {"1": {"title": "t"}},
        }
    )
    assert given.score_levels == ((0.5, 1), (1.01, 4)) and given.blacklist == ("113",) and given.blacklist_level == 3
    assert given.missed_ratio == 0.9 and given.missed_min_calls == 5 and given.messages == {1: ("t", "")}


def test_settings_from_files(spark, tmp_path):
    from ringlens.config import FeatureConfig, RiskConfig
    from ringlens.sources.settings import load_external_data, load_risk_config, load_settings

    (tmp_path / "risk.json").write_text(json.dumps(RiskConfig(missed_ratio=0.7, blacklist=("113",)).to_mapping()))
    assert load_risk_config(spark, str(tmp_path / "risk.json")) == RiskConfig(missed_ratio=0.7, blacklist=("113",))
    (tmp_path / "empty.json").write_text("")
    assert load_risk_config(spark, str(tmp_path / "empty.json")) == RiskConfig.from_mapping({})
    (tmp_path / "list.json").write_text("[1]")
    with pytest.raises(ValueError, match="mapping"):
        load_settings(spark, str(tmp_path / "list.json"))
    (tmp_path / "external.json").write_text('{"providers": {"a": ["86", 96], "b": null}, "work_days": [2, 3]}')
    owned, config = load_external_data(spark, str(tmp_path / "external.json"), FeatureConfig(prefix_length=2))
    assert owned == {"a": ("86", "96"), "b": ()} and config == FeatureConfig(prefix_length=2, work_days=(2, 3))
    pytest.importorskip("yaml")
    (tmp_path / "external.yml").write_text('providers:\n  a:\n    - "086"\nlevel: {1: x}\n')
    assert load_external_data(spark, str(tmp_path / "external.yml")) == ({"a": ("086",)}, FeatureConfig())
    (tmp_path / "risk.yaml").write_text("behavior_rules:\n  miss_ratio_high: 0.9\n")
    assert load_risk_config(spark, str(tmp_path / "risk.yaml")).missed_ratio == 0.9


def test_blacklist_of_any_size(spark):
    from ringlens.operators.risk import evaluate_risk, risk_features

    pool = spark.createDataFrame([("0912000001", 0.1, 3_000_000_000), ("0912000002", 0.1, 5)], "phone string, Score double, sum_call long")
    rows = risk_features(pool, keep=("Score",))
    assert {r.phone: r.total_call for r in rows.collect()} == {"0912000001": 3_000_000_000, "0912000002": 5}
    listed = spark.range(5000).select(F.concat(F.lit(" 091200"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("phone")).where("id <> 2")
    levels = {r.phone: r.rule_level for r in evaluate_risk(rows, blacklist=listed.union(listed)).collect()}
    assert levels["0912000001"] == 4 and levels["0912000002"] < 4


def test_prefix_table_agrees_with_the_lists(spark):
    """The settings' lists as a table give the same levels, with null and overlong phones and a hot beginning."""
    rng = random.Random(4)
    config = RiskConfig(domestic_prefixes=("0243", "02", "0912", "84"), foreign_prefixes=("231", "1"))
    phones = [f"{rng.choice(['0243', '02', '0912', '0913', '84', '+231', '+1', '00231'])}{rng.randrange(10**6):06d}" for _ in range(200)]
    phones += [None, "", "0", "0243" + "7" * 5_000]
    pool = spark.createDataFrame([(phone, 6, i / 203) for i, phone in enumerate(phones)], "phone string, sum_call int, Score double")
    rows = risk.risk_features(pool, keep=("Score",))
    listed = [("domestic", head, place) for place, head in enumerate(config.domestic_prefixes)]
    listed += [("foreign", head, 0) for head in config.foreign_prefixes] + [("domestic", None, 0), ("domestic", "0912", 9)]
    table = spark.createDataFrame(listed, "kind string, head string, place long")
    expected = sorted(map(str, risk.evaluate_risk(rows, config=config).collect()))
    assert sorted(map(str, risk.evaluate_risk(rows, config=config, prefixes=table).collect())) == expected
    marked = risk.mark_prefixes(rows, table, "first", "risky", heavy_rows=20)
    plain = risk.mark_prefixes(rows, table, "first", "risky")
    assert sorted(map(str, marked.collect())) == sorted(map(str, plain.collect()))
    none = risk.evaluate_risk(rows, config=RiskConfig(domestic_prefixes=(), foreign_prefixes=()))
    assert sorted(map(str, risk.evaluate_risk(rows, config=config, prefixes=table.limit(0)).collect())) == sorted(map(str, none.collect()))

"""Settings from files: risk rules, provider prefixes and working days."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import replace
from typing import Any

from pyspark.sql import SparkSession

from ringlens.config import FeatureConfig, RiskConfig


def load_settings(spark: SparkSession, path: str) -> dict[str, Any]:
    """The mapping in a JSON or YAML file on any file system Spark reads; YAML needs its parser to be installed."""
    texts = [row.value for row in spark.read.text(path, wholetext=True).take(2)]
    if len(texts) > 1:
        raise ValueError(f"{path} holds more than one file")
    text = texts[0] if texts else ""
    if path.lower().endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as error:
            raise RuntimeError(f"no YAML parser is installed to read {path}; JSON needs none") from error
        settings = yaml.safe_load(text)
    else:
        settings = json.loads(text) if text.strip() else {}
    if not isinstance(settings or {}, Mapping):
        raise ValueError(f"{path} does not hold a mapping")
    return dict(settings or {})


def load_risk_config(spark: SparkSession, path: str) -> RiskConfig:
    return RiskConfig.from_mapping(load_settings(spark, path))


def load_external_data(
    spark: SparkSession, path: str, config: FeatureConfig = FeatureConfig()
) -> tuple[dict[str, tuple[str, ...]], FeatureConfig]:
    """Prefixes by provider, and ``config`` with the file's working days; without these it stays as it is."""
    settings = load_settings(spark, path)
    owned = {str(name): tuple(map(str, heads or ())) for name, heads in (settings.get("providers") or {}).items()}
    days = settings.get("work_days")
    return owned, config if days is None else replace(config, work_days=tuple(map(int, days)))

"""Champion or challenger: the gate a candidate model has to pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AUC, F1 = "auc_val", "f1@best"


def _known(name: str) -> Column:
    value = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(value), value)


def promotion_gate(pairs: DataFrame, min_delta: float = 1e-6) -> DataFrame:
    """Adds promoted, reason and the compared values to candidate/production metric pairs.

    Reads new_auc, old_auc, new_f1, old_f1 (NULL or NaN when missing) and
    has_old. AUC decides; F1 decides ties and cases where an AUC is missing.
    """
    new_auc, old_auc, new_f1, old_f1 = (_known(n) for n in ("new_auc", "old_auc", "new_f1", "old_f1"))
    delta = F.lit(min_delta)

    def verdict(promoted: bool, reason: str, new: Column | None = None, old: Column | None = None) -> Column:
        missing = F.lit(None).cast("double")
        return F.struct(
            F.lit(promoted).alias("promoted"),
            F.lit(reason).alias("reason"),
            (missing if new is None else new).alias("new"),
            (missing if old is None else old).alias("old"),
        )

    no_auc = new_auc.isNull() | old_auc.isNull()
    better_f1 = new_f1 > old_f1 + delta
    gate = (
        F.when(~F.col("has_old"), verdict(True, "no_old_metrics"))
        .when(no_auc & new_f1.isNull(), verdict(False, f"new_{F1}_missing"))
        .when(no_auc & old_f1.isNull(), verdict(True, f"old_{F1}_missing_new_has"))
        .when(no_auc & better_f1, verdict(True, f"better_{F1}", new_f1, old_f1))
        .when(no_auc, verdict(False, f"not_better_{F1}", new_f1, old_f1))
        .when(new_auc > old_auc + delta, verdict(True, f"better_{AUC}", new_auc, old_auc))
        .when(
            (F.abs(new_auc - old_auc) <= delta) & better_f1,
            verdict(True, f"tie_{AUC}_better_{F1}", new_f1, old_f1),
        )
        .otherwise(verdict(False, f"not_better_{AUC}", new_auc, old_auc))
    )
    return pairs.withColumn("_gate", gate).select(*pairs.columns, "_gate.*")

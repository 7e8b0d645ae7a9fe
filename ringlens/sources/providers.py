"""The provider dimension: which network owns which prefix."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def provider_dimension(spark: SparkSession, providers: Mapping[str, Sequence[str]] | DataFrame | None) -> DataFrame:
    """(prefix, provider) rows of any number; a prefix claimed twice would multiply calls and is refused.

    A DataFrame with these columns is taken as the dimension itself.
    """
    if isinstance(providers, DataFrame):
        dimension = providers.select("prefix", "provider")
        repeated = dimension.groupBy("prefix").count().where("count > 1").limit(10).collect()
        if repeated:
            raise ValueError(f"prefixes owned by more than one provider, such as {sorted(row.prefix for row in repeated)}")
        return dimension
    rows = [(str(prefix), str(name)) for name, owned in (providers or {}).items() for prefix in owned or []]
    repeated = [prefix for prefix, times in Counter(prefix for prefix, _ in rows).items() if times > 1]
    if repeated:
        raise ValueError(f"prefixes owned by more than one provider: {sorted(repeated)}")
    columns = {name: pa.array([row[i] for row in rows], pa.string()) for i, name in enumerate(("prefix", "provider"))}
    return spark.createDataFrame(pa.table(columns))

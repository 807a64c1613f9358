"""Key contracts of raw tables, checked by a job because Parquet tables enforce none."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ContractError(ValueError):
    pass


def check_key(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows repeat a key, how many lack a part of it."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(missing, F.col("_n"))), F.lit(0)).alias("missing_keys"),
    ).select(F.lit(name).alias("table_name"), "*")


def require_key(name: str, df: DataFrame, keys: Sequence[str]) -> None:
    found = check_key(name, df, keys).first()
    if found["repeated_keys"] or found["missing_keys"]:
        raise ContractError(
            f"{name}: key ({', '.join(keys)}) has {found['repeated_keys']} repeated and "
            f"{found['missing_keys']} missing values")

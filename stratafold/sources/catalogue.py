"""Reading the account catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafold import fixed_values as fv


def active_accounts(catalogue: DataFrame, platform: str | None = fv.PLATFORM) -> DataFrame:
    active = catalogue.where("activo")
    if platform is not None:
        active = active.where(F.lower("platform") == platform.lower())
    return active.select("account_id", "account_name", "platform")


def active_platforms(catalogue: DataFrame, platform: str | None = None) -> DataFrame:
    return active_accounts(catalogue, platform).select("platform").distinct()

"""Lazy composition of the three layers over one bronze set.

``Warehouse(bronze, params)`` exposes every model as a DataFrame property;
nothing runs until an action. ``plans.pipeline`` materialises the layers as
tables instead (silver once, then quarantine and gold read it).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from subledger.params import RunParams
from subledger.plans import marts, quarantine, silver
from subledger.sources.bronze import Bronze


class Warehouse:
    def __init__(self, bronze: Bronze, params: RunParams, silver_tables: dict | None = None):
        self.bronze = bronze
        self.params = params
        self._silver = silver_tables or {}

    # ---- silver --------------------------------------------------------
    def _stg(self, name: str, build) -> DataFrame:
        df = self._silver.get(name)
        return df if df is not None else build(self.bronze, self.params)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return self._stg("stg_customers", silver.stg_customers)

    @cached_property
    def stg_subscriptions(self) -> DataFrame:
        return self._stg("stg_subscriptions", silver.stg_subscriptions)

    @cached_property
    def stg_transactions(self) -> DataFrame:
        return self._stg("stg_transactions", silver.stg_transactions)

    @cached_property
    def stg_monthly_revenue(self) -> DataFrame:
        return self._stg("stg_monthly_revenue", silver.stg_monthly_revenue)

    # ---- quarantine (full-build form) ----------------------------------
    @cached_property
    def quarantine_customers(self) -> DataFrame:
        return quarantine.quarantine_customers(self.bronze, self.params)

    @cached_property
    def quarantine_subscriptions(self) -> DataFrame:
        return quarantine.quarantine_subscriptions(self.bronze, self.params)

    @cached_property
    def quarantine_transactions(self) -> DataFrame:
        return quarantine.quarantine_transactions(self.bronze, self.params)

    # ---- gold ----------------------------------------------------------
    @cached_property
    def mart_mrr(self) -> DataFrame:
        return marts.mart_mrr(self.stg_monthly_revenue)

    @cached_property
    def mrr_components(self) -> dict[str, DataFrame]:
        return marts.mrr_components(self.stg_monthly_revenue)

    @cached_property
    def customer_metrics(self) -> DataFrame:
        return marts.customer_metrics(self.stg_customers, self.stg_subscriptions, self.stg_monthly_revenue)

    @cached_property
    def mart_cac_ltv(self) -> DataFrame:
        return marts.mart_cac_ltv(self.stg_customers, self.stg_subscriptions, self.stg_monthly_revenue)

    @cached_property
    def mart_transactions(self) -> DataFrame:
        return marts.mart_transactions(self.stg_transactions)

    MODELS = (
        "stg_customers", "stg_subscriptions", "stg_transactions", "stg_monthly_revenue",
        "quarantine_customers", "quarantine_subscriptions", "quarantine_transactions",
        "mart_mrr", "mart_cac_ltv", "mart_transactions",
    )

    def register_views(self, prefix: str = "") -> list[str]:
        """Expose every model as a temporary view for SQL users (the silver
        layer of the reference is a set of views). Nothing is computed."""
        names = []
        for m in self.MODELS:
            getattr(self, m).createOrReplaceTempView(prefix + m)
            names.append(prefix + m)
        return names

"""Lazy wiring of views -> silver -> dimensions -> facts for one data folder.

Every attribute is a DataFrame built on first use; nothing runs until an
action.  ``materialize_facts`` writes the three facts once to the shared
work folder (SURVEY O3) so a KPI run reads them instead of re-running the
star joins for every KPI; a written table also cuts lineage, so a lost
executor recomputes from the files, not from the raw tables.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path
from ..sources import views
from ..sources.tables import Tables
from . import gold, silver


_SHARED: dict[tuple[int, str], "Warehouse"] = {}


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self.t = Tables(spark, root)

    @classmethod
    def of(cls, spark: SparkSession, root: str) -> "Warehouse":
        """The shared (lazy, never materialised) warehouse of a session and
        data folder: its DataFrames are analysed once and reused by every
        query, like variables in a notebook."""
        key = (id(spark), root.rstrip("/"))
        w = _SHARED.get(key)
        if w is None or w.spark is not spark:
            w = _SHARED[key] = cls(spark, root)
        return w

    @staticmethod
    def refresh() -> None:
        """Forget shared warehouses and resolved tables (after new data
        lands, so the next ``of`` re-reads the folders)."""
        _SHARED.clear()
        Tables.refresh()

    # silver-level entities (typed views over the test tables)
    @cached_property
    def policies(self) -> DataFrame:
        return views.policies_core(self.t)

    @cached_property
    def policies_with_agent(self) -> DataFrame:
        return views.policies(self.t)

    @cached_property
    def claims(self) -> DataFrame:
        return views.claims(self.t)

    @cached_property
    def payments(self) -> DataFrame:
        return silver.clean_payments(views.bronze_payments(self.t))

    @cached_property
    def payments_typed(self) -> DataFrame:
        return views.payments(self.t)

    # bronze snapshots
    @cached_property
    def bronze_policies(self) -> DataFrame:
        return views.bronze_policies(self.t)

    @cached_property
    def bronze_customers(self) -> DataFrame:
        return views.bronze_customers(self.t)

    @cached_property
    def silver_policies(self) -> DataFrame:
        return silver.clean_policies(self.bronze_policies)

    # dimensions
    @cached_property
    def dim_customer(self) -> DataFrame:
        return views.dim_customer(self.t)

    @cached_property
    def dim_vehicle(self) -> DataFrame:
        return views.dim_vehicle(self.t)

    # facts
    @cached_property
    def fact_policy(self) -> DataFrame:
        return gold.fact_policy(self.policies, self.dim_customer, self.dim_vehicle)

    @cached_property
    def fact_claims(self) -> DataFrame:
        return gold.fact_claims(self.claims, self.dim_customer, self.dim_vehicle)

    @cached_property
    def fact_payments(self) -> DataFrame:
        return gold.fact_payments(self.payments_typed, self.dim_customer)

    @cached_property
    def gold(self) -> "Warehouse":
        """A warehouse whose dimensions and facts are read from tables
        written once (first use) to the shared work folder -- what the KPIs
        read, like the reference's KPI cells read the gold fact tables."""
        g = Warehouse(self.spark, self.root)
        g.t = self.t
        g.materialize_facts()
        return g

    @cached_property
    def published(self) -> "Warehouse":
        """This warehouse's layers written once: the gold tables of
        ``gold`` plus the silver entities (``policies``, ``claims``,
        ``payments``).  ``register_catalog`` names them in the catalog."""
        g = self.gold
        folder = g.folder.rsplit("/", 1)[0] + "/silver"
        for table, df in (("policies", self.policies_with_agent), ("claims", self.claims),
                          ("payments", self.payments)):
            df.write.mode("overwrite").parquet(f"{folder}/{table}")
        g.silver_folder = folder
        return g

    def register_catalog(self, silver_db: str = "silver", gold_db: str = "gold") -> None:
        """Point ``silver.*`` and ``gold.*`` catalog tables at this
        (published) warehouse's folders.  Table names are session-wide, so
        call this right before SQL that should read *these* folders; a
        DataFrame binds to the files when ``spark.sql`` analyses it."""
        from ..operators.catalog_tables import ensure_database, register_table
        base = self.folder.rsplit("/", 1)[0]
        ensure_database(self.spark, silver_db, f"{base}/{silver_db}.db")
        ensure_database(self.spark, gold_db, f"{base}/{gold_db}.db")
        for table in ("policies", "claims", "payments"):
            register_table(self.spark, silver_db, table, f"{self.silver_folder}/{table}")
        for name in ("dim_customer", "dim_vehicle", "fact_policy", "fact_claims", "fact_payments"):
            register_table(self.spark, gold_db, name, f"{self.folder}/{name}")

    def materialize_facts(self, folder: str | None = None) -> str:
        """Write the dimensions, then the facts built on the *written*
        dimensions, under the shared work folder; point this warehouse at
        the files."""
        folder = folder or scratch_path(self.spark, "warehouse") + "/gold"
        self.folder = folder
        facts = ("fact_policy", "fact_claims", "fact_payments")
        for name in facts:  # rebuild facts over the written dimensions
            self.__dict__.pop(name, None)
        for group in (("dim_customer", "dim_vehicle"), facts):
            # tables of a group are independent jobs: submit them together
            frames = {name: getattr(self, name) for name in group}
            with ThreadPoolExecutor(max_workers=len(frames)) as pool:
                list(pool.map(lambda item: item[1].write.mode("overwrite")
                              .parquet(f"{folder}/{item[0]}"), frames.items()))
            for name in group:
                self.__dict__[name] = self.spark.read.parquet(f"{folder}/{name}")
        return folder

"""Registry of the verifiable queries: Spark callable + DuckDB oracle SQL.

A query is registered with :func:`register`; its Spark side receives
``(spark, sf_dir)`` and returns a DataFrame in edge form, its oracle side is
the binding CTEs plus a SQL body (``None`` for rows-only operators).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, lru_cache

from pyspark.sql import DataFrame, SparkSession

from growlytics.config import Params
from growlytics.plans.edge import edge
from growlytics.plans.oracle import BINDING
from growlytics.sources.binding import Binding, bind
from growlytics.session import ensure_checkpoint_dir
from growlytics.sources.warehouse import Warehouse, materialized_binding


@lru_cache(maxsize=1)
def _code_version() -> str:
    """Hash of the code that defines the marts (sources, cleaning, staging,
    marts and what they import)."""
    import hashlib
    import os

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    h = hashlib.sha1()
    for rel in ("config.py", "functions/dates.py", "sources/binding.py", "sources/files.py", "sources/schemas.py",
                "sources/warehouse.py", "operators/quality.py", "operators/staging.py", "operators/marts.py", "operators/user_days.py"):
        with open(os.path.join(root, rel), "rb") as fh:
            h.update(fh.read())
    return h.hexdigest()[:12]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
PARAMS = Params.binding()


def register(name: str, sql: str | None = None, extra: str = "", raw: bool = False):
    """Decorator: ``fn(ctx) -> DataFrame`` becomes ``(spark, sf_dir) -> DataFrame``."""

    def deco(fn: Callable[["Ctx"], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(Ctx(spark, sf_dir))
            return df if raw else edge(df)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = BINDING + extra + sql
        return fn

    return deco


class Ctx:
    """Lazy access to the binding, the warehouse and the parameters."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.p = PARAMS

    @property
    def binding(self) -> Binding:
        return bind(self.spark, self.sf_dir)

    @cached_property
    def landed(self):
        return materialized_binding(self.spark, self.sf_dir, ensure_checkpoint_dir(self.spark), _code_version())

    @property
    def wh(self) -> Warehouse:
        """The star schema, built once per input folder by the ETL step
        (bucketed by user_id under the shared folder) and read as tables; a
        table is built when it is first read."""
        return self.landed.wh

    def raw(self, dataset: str) -> DataFrame:
        """A landing table (raw dataset) written by the ETL step."""
        return self.landed.raw(dataset)

    @property
    def wh_lazy(self) -> Warehouse:
        """The same star schema as one lazy plan over the raw tables."""
        return Warehouse.from_binding(self.spark, self.sf_dir)

    def table(self, name: str) -> DataFrame:
        return self.binding.table(name)


@lru_cache(maxsize=1)
def load_all() -> None:
    """Import the query modules so they register themselves."""
    import importlib

    for mod in MODULES:
        importlib.import_module(f"growlytics.plans.{mod}")


MODULES = (
    "q_quality",
    "q_load",
    "q_marts",
    "q_kpis",
    "q_activity",
    "q_revenue",
    "q_cohorts",
    "q_segments",
    "q_experiments",
    "q_survival",
    "q_churn",
    "q_streaming",
)

"""growlytics: subscription-product growth analytics as Spark DataFrame jobs.

Layout
------
- ``sources``   readers, sinks, the test-table binding and the staging layer
- ``operators`` marts, data-quality tests, KPIs, funnels, cohorts, RFM,
                experiment statistics, survival, churn model
- ``functions`` Column-level helpers (normal / chi-square tails, dates)
- ``plans``     the registered queries and their DuckDB oracle SQL
- ``streaming`` Structured Streaming event intake

Every operator is a pure function ``DataFrame(s) -> DataFrame`` built from
built-in Column expressions, so Catalyst plans it and it scales with the
cluster.  Parameters live in :class:`growlytics.config.Params`.
"""

from growlytics.config import Params

__all__ = ["Params"]
__version__ = "0.1.0"

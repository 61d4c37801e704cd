"""Parameters of the analytics (as-of dates, cutoffs, prices, thresholds).

Two presets: :meth:`Params.reference` carries the dates and thresholds the
original SaaS stack hard-codes; :meth:`Params.binding` adapts them to the
TPC-H-ish test tables (see ``growlytics.sources.binding``).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# Plans and prices: Free, Pro 29.00, Enterprise 299.00; paid plans Pro and
# Enterprise; plan ids Free 1, Pro 2, Enterprise 3, anything else 0.
# Statuses: active, cancelled.  Missing recency: 365 days.
# Survival: dense curve capped at 730 days, no-churn horizon 1095 days,
# 30.4375 days per month, fallback monthly churn 0.03 (curve 0..360 step 30).
# Churn rule score: base 0.15, +0.55 if recency > 90 else +0.25 if > 30,
# +0.15 on Mobile, clamped to [0.05, 0.95].
# Churn model: 100 trees, depth 6, seed 42, 20 % test split, 50 rows minimum.
# Experiment: alpha 0.05, single-comparison critical z 1.96.
# ---------------------------------------------------------------------------
PLAN_PRICES = (("Pro", 29.0), ("Enterprise", 299.0))
PLAN_IDS = (("Free", 1), ("Pro", 2), ("Enterprise", 3))
PAID_PLANS = ("Pro", "Enterprise")
ACCEPTED_STATUS = ("active", "cancelled")
ACCEPTED_PLANS = ("Free", "Pro", "Enterprise")

SEGMENT_NAMES = (
    "High-Value Champions",
    "Power Users",
    "Loyal Customers",
    "At-Risk (Paid Churned)",
    "Hibernating / Dormant",
    "Engaged Free Users",
    "New / Average Users",
)

CHURN_FEATURES = (
    "plan",
    "channel",
    "session_count",
    "recency",
    "device_type",
    "search_count",
    "pv_count",
    "total_events",
    "total_revenue",
)
# Importances reported when no model has been trained (same order as above).
DEFAULT_IMPORTANCES = (0.05, 0.05, 0.15, 0.40, 0.05, 0.05, 0.05, 0.10, 0.10)

REFERENCE_FUNNEL = (
    ("1. Homepage View", ("page_view",)),
    ("2. Account Signup", ("signup",)),
    ("3. Account Login", ("login",)),
    ("4. Paid Conversion", ("upgrade", "purchase")),
)


@dataclass(frozen=True)
class Params:
    as_of: dt.date = dt.date(2026, 6, 22)
    wau_cutoff: dt.date = dt.date(2026, 6, 15)
    dau_cutoff: dt.date = dt.date(2026, 6, 21)
    mrr_cutoff: dt.date = dt.date(2026, 5, 22)
    calendar_start: dt.date = dt.date(2025, 6, 1)
    calendar_end: dt.date = dt.date(2026, 7, 1)
    enrol_start: dt.date = dt.date(2026, 1, 1)
    paid_plans: tuple = PAID_PLANS
    plan_prices: tuple = PLAN_PRICES
    missing_recency: int = 365
    # RFM rule cascade (strict bounds, first match wins)
    champion_recency: int = 30
    power_recency: int = 14
    power_frequency: int = 40
    loyal_recency: int = 45
    at_risk_recency: int = 90
    dormant_recency: int = 60
    engaged_free_frequency: int = 15
    # experiments
    alpha: float = 0.05
    single_z: float = 1.96
    control_variant: str = "Control"
    excluded_variants: tuple = ("N/A",)
    # survival
    tenure_cap: int = 730
    no_churn_horizon: float = 1095.0
    days_per_month: float = 30.4375
    fallback_monthly_churn: float = 0.03
    # churn model
    churn_trees: int = 100
    churn_depth: int = 6
    seed: int = 42
    test_fraction: float = 0.2
    min_training_rows: int = 50
    search_event: str = "search"
    page_view_event: str = "page_view"
    default_device: str = "Desktop"
    # funnel: ordered (label, event types)
    funnel_steps: tuple = REFERENCE_FUNNEL
    signup_event: str = "signup"
    landing_event: str = "page_view"
    # experiment log (ab_data) preparation
    sample_size: int = 25000
    rescale_start: dt.datetime = dt.datetime(2025, 6, 22)
    rescale_end: dt.datetime = dt.datetime(2026, 6, 22)
    experiment_id: str = "EXP_2026_CTA_COLOR"
    # billing schedule
    billing_days: int = 30
    extra: dict = field(default_factory=dict)

    @property
    def paid(self) -> list[str]:
        return list(self.paid_plans)

    @property
    def price_map(self) -> dict[str, float]:
        return dict(self.plan_prices)

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)

    @staticmethod
    def reference() -> "Params":
        return Params()

    @staticmethod
    def binding() -> "Params":
        """Dates and thresholds for the TPC-H-ish test tables.

        Orders run 1995-01-01 .. 2001-08-01, so the as-of date is the day
        after the last order; activity there is sparser than in the SaaS
        simulation, so the two frequency thresholds are lowered.
        """
        return Params(
            as_of=dt.date(2001, 8, 2),
            wau_cutoff=dt.date(2001, 7, 26),
            dau_cutoff=dt.date(2001, 8, 1),
            mrr_cutoff=dt.date(2001, 7, 2),
            calendar_start=dt.date(1995, 1, 1),
            calendar_end=dt.date(2001, 8, 31),
            enrol_start=dt.date(2026, 1, 1),
            power_frequency=12,
            engaged_free_frequency=8,
            search_event="click",
            page_view_event="view",
            funnel_steps=(
                ("1. View", ("view",)),
                ("2. Click", ("click",)),
                ("3. Signup", ("signup",)),
                ("4. Purchase", ("purchase",)),
            ),
            signup_event="signup",
            landing_event="view",
            sample_size=1000,
            rescale_start=dt.datetime(2025, 6, 22),
            rescale_end=dt.datetime(2026, 6, 22),
            experiment_id="EXP_3ARM",
        )

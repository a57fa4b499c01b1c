"""Business constants and the bundle of entity frames every operator reads."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace

from pyspark.sql import DataFrame

# Business vocabulary shared with the systems that feed the engine.
PLAN_TIERS = {"starter": 1, "growth": 2, "business": 3, "enterprise": 4}
PLAN_PRICES = {"starter": 99, "growth": 299, "business": 799, "enterprise": 2499}
SIZE_MIDPOINTS = {"1-10": 5, "11-50": 30, "51-200": 125, "201-1000": 600, "1000+": 2500}
SIZE_TIERS = {
    "1-10": "smb",
    "11-50": "smb",
    "51-200": "mid_market",
    "201-1000": "enterprise",
    "1000+": "enterprise",
}
RISK_LABELS = {
    "usage_drop": "Usage drop >40%",
    "no_login": "No login 14d",
    "high_tickets": "2+ high tickets",
    "payment_failure": "Payment failed",
    "low_csat": "CSAT < 3",
    "low_seat_util": "Seat util < 25%",
}


@dataclass(frozen=True)
class HealthWeights:
    usage: float = 0.25
    seats: float = 0.20
    features: float = 0.15
    support: float = 0.15
    csat: float = 0.10
    payment: float = 0.10
    tenure: float = 0.05


@dataclass(frozen=True)
class MetricConfig:
    """Thresholds and weights; override with ``dataclasses.replace``."""

    usage_drop: float = 0.40
    idle_days: int = 14
    low_seat_util: float = 0.25
    low_csat: float = 3
    open_tickets: int = 2
    inactive_days: int = 90
    stagnation_days: int = 60
    dead_band: float = 5
    weights: HealthWeights = field(default_factory=HealthWeights)
    core_categories: tuple[str, ...] = ("core", "workflow", "automation")


@dataclass(frozen=True)
class Tables:
    """Typed entity frames. Everything stays lazy until a result is written."""

    accounts: DataFrame
    plans: DataFrame
    features: DataFrame
    subscriptions: DataFrame
    invoices: DataFrame
    usage_events: DataFrame
    tickets: DataFrame
    leads: DataFrame

    def for_tenant(self, tenant_id) -> "Tables":
        """Scope every frame that carries a ``tenant_id`` column to one tenant."""
        scoped = {}
        for f in fields(self):
            df = getattr(self, f.name)
            if "tenant_id" in df.columns:
                scoped[f.name] = df.where(df.tenant_id == tenant_id)
        return replace(self, **scoped)

"""Run configuration: column names, split fractions and business economics.

The numbers below are the defaults of the analysed project and must stay equal
to them for the reports to agree.
"""
from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (defaults that the results depend on)
#   seed 42; test 0.20, validation 0.20, stratified; 5 CV folds;
#   monthly margin 50.0, expected lifetime 24 months, offer cost 60.0,
#   offer success 0.30, annual discount rate 0.10;
#   discount action: cost 30.0, success 0.25; call action: cost 100.0, success 0.45;
#   4 segments; margin proxy divisor 65.0, margin fraction clipped to [0.1, 1.0];
#   contract horizons: Month-to-month 12, One year 24, Two year 48, default 12.
# ---------------------------------------------------------------------------
CONTRACT_HORIZON = {"Month-to-month": 12, "One year": 24, "Two year": 48}
DEFAULT_HORIZON = 12
MARGIN_DIVISOR = 65.0
ACTIONS = ("do_nothing", "discount", "call")


@dataclass(frozen=True)
class Economics:
    avg_monthly_margin: float = 50.0
    expected_lifetime_months: int = 24
    retention_offer_cost: float = 60.0
    offer_success_rate: float = 0.30
    annual_discount_rate: float = 0.10
    discount_cost: float = 30.0
    discount_success: float = 0.25
    call_cost: float = 100.0
    call_success: float = 0.45

    @property
    def actions(self) -> dict[str, tuple[float, float]]:
        """What each action costs and the share of its customers that it keeps."""
        return dict(zip(ACTIONS, [(0.0, 0.0), (self.discount_cost, self.discount_success), (self.call_cost, self.call_success)]))

    @property
    def monthly_rate(self) -> float:
        return (1.0 + self.annual_discount_rate) ** (1.0 / 12.0) - 1.0

    def annuity_factor(self, months: float) -> float:
        """Present value of 1 per month for ``months`` periods."""
        r = self.monthly_rate
        if r <= 0:
            return float(months)
        return (1.0 - (1.0 + r) ** (-months)) / r

    @property
    def customer_value(self) -> float:
        """V: present value of the retained margin over the expected lifetime."""
        return self.avg_monthly_margin * self.annuity_factor(self.expected_lifetime_months)

    @property
    def margin_fraction(self) -> float:
        return min(1.0, max(0.1, self.avg_monthly_margin / MARGIN_DIVISOR))

    def validate(self) -> None:
        if self.customer_value <= 0 or self.retention_offer_cost <= 0:
            raise ValueError("customer value and offer cost must be positive")
        for s in (self.offer_success_rate, self.discount_success, self.call_success):
            if not 0.0 <= s <= 1.0:
                raise ValueError("success rates must lie in [0, 1]")


@dataclass(frozen=True)
class Settings:
    id_col: str = "customerID"
    target_col: str = "Churn"
    seed: int = 42
    test_size: float = 0.20
    validation_size: float = 0.20
    stratify: bool = True
    cv_folds: int = 5
    n_clusters: int = 4
    economics: Economics = field(default_factory=Economics)


DEFAULT = Settings()

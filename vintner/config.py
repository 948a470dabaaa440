"""Names, levels, steps and thresholds. Everything here is data; jobs take overrides as arguments."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: column names and constants that results depend on -------------------------
COHORT_MONTH = "cohort_month"
IS_PROMO = "plan__is_promo"
ADD_TYPE = "gross_add__type"
GROSS_ADDS = "gross_adds"
MISSING_CAMPAIGN = "NONE"

LEVEL_COLUMNS = ("brand", "sku_type", "channel", "traffic_source", "campaign")

BILLING_DAYS = (30, 60, 90, 180, 365, 730, 1095, 1460)
EARLY_DAYS = {1: "one", 3: "three", 7: "seven"}
MATURITY_DAYS = tuple(EARLY_DAYS) + BILLING_DAYS

BASE_REGRESSORS = (
    "avg_recurring_days",
    "avg_recurring_price",
    "gross_adds_canceled_day_one_rate",
    "cross_sell_adds_day_one_rate",
    "avg_cross_sell_price",
)
PROMO_REGRESSORS = (
    "avg_promo_days",
    "avg_promo_price",
    "promo_to_recurring_days_ratio",
    "promo_to_recurring_price_ratio",
)

RISK_DIMENSIONS = (
    "processor",
    "merchant_account",
    "card_network",
    "brand_slug",
    "sku_type_slug",
    "channel_slug",
    "traffic_source_short_name",
    "offer_type",
    "bin",
)
MIN_BAD_COUNT = 100

LTV_LEVELS = ("brand", "acquisition_sku_bucket", "acquisition_channel", "payment_type", "mobile")
LTV_MONTHS = (1, 3, 6, 12, 24)
FORECAST_TARGETS = ("canceled_day_1", "ltv_1mo", "ltv_3mo", "ltv_6mo", "ltv_12mo")
MIN_GROUP_SIZE = 50
FORECAST_DAYS = 480

TRAINED = "TRAINED"
PREDICTED = "PREDICTED"
BYPASSED = "BYPASSED"

Z_95 = 1.959963984540054  # normal quantile of 0.975
Z_80 = 1.2815515655446004  # normal quantile of 0.9
# ----------------------------------------------------------------------------------------------


def matured_column(days: int) -> str:
    return f"gross_adds_created_over_{days}_days_ago"


def billings_column(days: int) -> str:
    return f"net_billings_{days}_days"


def avg_billings_column(days: int) -> str:
    return f"avg_net_billings_{days}_days"


def total_billings_column(days: int) -> str:
    return f"total_net_billings_{days}_days"


def canceled_column(days: int) -> str:
    return f"gross_adds_canceled_day_{EARLY_DAYS[days]}"


def cross_sell_column(days: int) -> str:
    unit = "day" if days == 1 else "days"
    return f"cross_sell_adds_{EARLY_DAYS[days]}_{unit}_since_gross_add"


def cross_sell_rate_column(days: int) -> str:
    return f"cross_sell_adds_day_{EARLY_DAYS[days]}_rate"


@dataclass(frozen=True)
class Level:
    """A prefix of the grouping hierarchy."""

    name: str

    @property
    def columns(self) -> list[str]:
        depth = LEVEL_COLUMNS.index(self.name.lower()) + 1
        return list(LEVEL_COLUMNS[:depth])

    @property
    def keys(self) -> list[str]:
        """Grain of the spine and of every feature view at this level."""
        return [COHORT_MONTH, IS_PROMO, ADD_TYPE, *self.columns]

    @property
    def categories(self) -> list[str]:
        return [ADD_TYPE, *self.columns]


LEVELS = tuple(Level(c.upper()) for c in LEVEL_COLUMNS)


@dataclass(frozen=True)
class Step:
    """One model of the cascade: what it predicts and which counts it fills back."""

    number: int
    name: str
    targets: tuple[str, ...]
    maturity: str  # cohort size that decides whether a row can train or needs a prediction
    filled: tuple[str, ...] = ()  # counts recomputed as rate x base, one per target
    base_on_promo: str = GROSS_ADDS
    is_retention: bool = False
    promo_only: bool = False

    @property
    def status_column(self) -> str:
        return f"{self.name.lower()}_model"

    def base(self, is_promo: bool) -> str:
        return self.base_on_promo if is_promo else GROSS_ADDS

    def applies_to(self, is_promo: bool) -> bool:
        return is_promo or not self.promo_only


def _steps() -> tuple[Step, ...]:
    early = [
        Step(
            number,
            f"DAY_{days}_METRICS",
            (canceled_column(days) + "_rate", cross_sell_rate_column(days)),
            matured_column(days),
            (canceled_column(days), cross_sell_column(days)),
        )
        for number, days in ((1, 3), (2, 7))
    ]
    retention = [
        Step(
            3,
            "PROMO_ACTIVATION_RATE_EXCL_RETRIES",
            ("promo_activation_rate_excl_retries",),
            "eligible_promo_activations",
            ("survived_promo_activations_excl_retries",),
            is_retention=True,
            promo_only=True,
        ),
        Step(
            4,
            "FIRST_REBILL_RATE_EXCL_RETRIES",
            ("first_rebill_rate_excl_retries",),
            "eligible_first_rebills",
            ("survived_first_rebills_excl_retries",),
            base_on_promo="survived_promo_activations_excl_retries",
            is_retention=True,
        ),
    ]
    billing = [
        Step(number, avg_billings_column(days).upper(), (avg_billings_column(days),), matured_column(days))
        for number, days in enumerate(BILLING_DAYS, start=5)
    ]
    return tuple(early + retention + billing)


STEPS = _steps()


def regressors(step: Step, is_promo: bool) -> list[str]:
    """Numeric inputs of a step: the base set, every earlier target, promo terms on promo rows."""
    earlier = [t for s in STEPS if s.number < step.number for t in s.targets]
    return [*BASE_REGRESSORS, *earlier, *(PROMO_REGRESSORS if is_promo else ())]


@dataclass(frozen=True)
class TreeParams:
    """Gradient-boosting defaults."""

    trees: int = 100
    depth: int = 6
    learning_rate: float = 0.1
    row_share: float = 0.8
    column_share: float = 0.8
    seed: int = 42
    bins: int = 256
    rows_per_partition: int = 20_000


@dataclass(frozen=True)
class CascadeSettings:
    min_cohort_size: float = 400
    base_threshold: float = 0.5
    test_share: float = 0.1
    split_seed: int = 42
    evaluate: bool = True
    impute: str = "median"
    max_categories: int | None = None
    trees: TreeParams = field(default_factory=TreeParams)
    steps: tuple[Step, ...] = STEPS

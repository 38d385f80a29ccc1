"""Run configuration and the fixed domain vocabularies."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# ---------------------------------------------------------------------------
# These must equal the source project's vocabularies exactly.
# ---------------------------------------------------------------------------
CHANNELS = ("client 1", "client 2", "client na")

DOCUMENT_CATEGORIES = (
    "address_proof",
    "bank_account_details",
    "digitalid",
    "driving_license",
    "id_card",
    "open_banking",
    "passport",
    "payslip",
    "residence_permit",
    "tax_document",
)

# Order fixes the ctl01..ctl11 column prefixes of the monthly pivot.
CONTROL_NAMES = (
    "address_consistency",
    "address_locality_consistency",
    "alternate_family_name_consistency",
    "alternate_family_name_detection",
    "bic_iban_consistency",
    "birthdate_mrz_consistency",
    "date_validation",
    "family_name_account_holder_search",
    "family_name_consistency",
    "family_name_search",
    "personal_id_consistency",
)

CONTROL_SCORES = (
    "advanced",
    "ADVANCEDPF",
    "efficient",
    "EFFICIENTPF",
    "EFFICIENTPLUS",
    "jdiEfficientPlus",
    "standard",
    "STANDARDPF",
    "STANDARDPLUS",
    "controlna",
)

STATUSES = ("OK", "KO", "NA")

# Stand-in for a NULL score / channel / status where a model replaces it.
SCORE_NA = "controlna"
CHANNEL_NA = "client na"
STATUS_NULL_LABEL = "NULL"

LOOKBACK_DAYS = 730
TREND_MONTHS = 12
HISTORY_MONTHS_BACK = 12
HISTORY_MONTHS_AHEAD = 6
FRESHNESS_WARN_HOURS = 24
FRESHNESS_ERROR_HOURS = 48
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Config:
    """Everything a run depends on. ``as_of`` replaces the wall clock.

    ``late_days`` > 0 makes incremental loads re-read a trailing window below the
    high-water mark; sinks replace rows by key, so the re-read is idempotent.
    """

    as_of: dt.date
    lookback_days: int = LOOKBACK_DAYS
    trend_months: int = TREND_MONTHS
    channels: tuple[str, ...] = CHANNELS
    document_categories: tuple[str, ...] = DOCUMENT_CATEGORIES
    control_names: tuple[str, ...] = CONTROL_NAMES
    control_scores: tuple[str, ...] = CONTROL_SCORES
    history_months_back: int = HISTORY_MONTHS_BACK
    history_months_ahead: int = HISTORY_MONTHS_AHEAD
    freshness_warn_hours: int = FRESHNESS_WARN_HOURS
    freshness_error_hours: int = FRESHNESS_ERROR_HOURS
    late_days: int = 0
    # Partition size of the incremental tables: "day" keeps a nightly rewrite to
    # the touched days; "month" suits small or sparse data (fewer, larger files).
    partition_granularity: str = "day"

    def __post_init__(self):
        if not isinstance(self.as_of, dt.date) or isinstance(self.as_of, dt.datetime):
            raise TypeError("Config.as_of must be a datetime.date")
        if self.partition_granularity not in ("day", "month"):
            raise ValueError("partition_granularity must be 'day' or 'month'")
        if self.lookback_days < 0 or self.trend_months < 0:
            raise ValueError("lookback_days and trend_months must be >= 0")

    @property
    def lookback_start(self) -> dt.date:
        """First day inside the lookback window (inclusive lower bound)."""
        return self.as_of - dt.timedelta(days=self.lookback_days)

    @property
    def trend_start(self) -> dt.date:
        """``as_of`` minus ``trend_months`` calendar months (day clamped)."""
        return add_months(self.as_of, -self.trend_months)


def add_months(d: dt.date, months: int) -> dt.date:
    """Calendar month arithmetic with end-of-month clamping (as SQL intervals do)."""
    y, m = divmod(d.month - 1 + months, 12)
    year, month = d.year + y, m + 1
    nxt = dt.date(year + (month // 12), month % 12 + 1, 1)
    last = (nxt - dt.timedelta(days=1)).day
    return dt.date(year, month, min(d.day, last))


def month_start(d: dt.date) -> dt.date:
    return d.replace(day=1)

"""Thresholds, code sets and table locations.

Everything an operator needs besides its input DataFrame lives in one frozen
dataclass that callers pass in; nothing is read from a global or from the
environment.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# These must equal the business rules the pipeline reproduces.
# ---------------------------------------------------------------------------
ACCEPTED_CURRENCIES = ("USD", "EUR", "GBP", "CAD", "JPY", "AUD", "CHF", "HKD", "SGD", "MXN")
HIGH_RISK_MCC = ("6010", "6011", "7995", "5912", "6051")
CHANNEL_ALIASES = {
    "WEB": "ONLINE",
    "INTERNET": "ONLINE",
    "MOB": "MOBILE",
    "APP": "MOBILE",
    "TLR": "BRANCH",
    "TELLER": "BRANCH",
}
VALID_TRANSACTION_TYPES = ("CREDIT", "DEBIT", "TRANSFER", "FEE", "REVERSAL")
VALID_CHANNELS = ("ONLINE", "MOBILE", "ATM", "BRANCH", "PHONE")
FEATURE_CHANNELS = ("ONLINE", "ATM", "BRANCH", "MOBILE")  # PHONE is counted nowhere
LANDING_PIPELINE_VERSION = "2.4.0"
LANDING_SOURCE_SYSTEM = "CBS_NIGHTLY_EXPORT"
SILVER_PIPELINE_VERSION = "1.6.0"
FEATURE_PIPELINE_VERSION = "3.1.0"
STREAM_PIPELINE_NAME = "STREAM_EH_CONSUMER"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class RiskSettings:
    """Business thresholds used by the cleansing, feature and signal operators."""

    sar_threshold_usd: float = 10_000.0
    round_amount_unit: float = 1_000.0
    round_amount_min_usd: float = 5_000.0
    off_hours_first_hour: int = 0
    off_hours_last_hour: int = 5
    off_hours_min_usd: float = 2_000.0
    intl_high_value_usd: float = 5_000.0
    high_risk_score: float = 0.75
    velocity_window_hours: int = 24
    velocity_max_count: int = 50
    accepted_currencies: tuple[str, ...] = ACCEPTED_CURRENCIES
    high_risk_mcc: tuple[str, ...] = HIGH_RISK_MCC
    channel_aliases: dict[str, str] = field(default_factory=lambda: dict(CHANNEL_ALIASES))
    token_salt: str | None = None  # a secret: every caller that makes tokens passes its own
    lookback_days: int = 95
    windows: tuple[int, ...] = (7, 30, 90)

    def __hash__(self) -> int:  # dict field makes the default hash fail
        return hash((self.sar_threshold_usd, self.token_salt, self.windows))


DEFAULT_SETTINGS = RiskSettings()


@dataclass(frozen=True)
class Zones:
    """Bronze / silver / gold table locations under one root (A11).

    ``root`` is any Hadoop-compatible URI: a local directory in tests,
    ``s3a://bucket/lake`` or ``abfss://container@account.dfs.core.windows.net``
    on a cluster.
    """

    root: str

    def _path(self, zone: str, domain: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{zone}/{domain}/{table}"

    def bronze(self, domain: str, table: str) -> str:
        return self._path("bronze", domain, table)

    def silver(self, domain: str, table: str) -> str:
        return self._path("silver", domain, table)

    def gold(self, domain: str, table: str) -> str:
        return self._path("gold", domain, table)

    # The tables the daily chain reads and writes.
    @property
    def landing(self) -> str:
        return self.bronze("landing", "cbs_export")

    @property
    def transactions(self) -> str:
        return self.bronze("financial", "transactions")

    @property
    def quarantine(self) -> str:
        return self.bronze("financial", "transactions_quarantine")

    @property
    def transactions_stream(self) -> str:
        return self.bronze("financial", "transactions_stream")

    @property
    def stream_checkpoint(self) -> str:
        return f"{self.root.rstrip('/')}/bronze/_checkpoints/transactions_stream"

    @property
    def transactions_clean(self) -> str:
        return self.silver("financial", "transactions_clean")

    @property
    def account_days(self) -> str:
        return self.gold("risk", "account_days")

    @property
    def credit_risk_features(self) -> str:
        return self.gold("risk", "credit_risk_features")

    @property
    def fraud_signals(self) -> str:
        return self.gold("risk", "fraud_signals")

    @property
    def dq_audit_log(self) -> str:
        return self.gold("quality", "dq_audit_log")

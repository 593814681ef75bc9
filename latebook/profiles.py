"""Parameters of the delinquency rules: plain dataclasses, no Spark objects.

Every date the rules depend on derives from an explicit ``as_of`` date, so that a run can
be repeated later with the same result.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# They must equal the published ones for the results to match.
PAYMENT_TERM_DAYS = 30
ALERT_OPEN_VALUE = 10000.0
STREAM_ALERT_PERCENT = 20.0
SEVERITY_NONE = "NENHUMA"
SEVERITY_CRITICAL = "CRÍTICA"
SEVERITY_BANDS = ((90, "CRÍTICA"), (60, "ALTA"), (30, "MÉDIA"), (15, "BAIXA"))
AMOUNT_BANDS = ((100, "BAIXO"), (500, "MÉDIO"), (1000, "ALTO"))
AMOUNT_BAND_TOP = "MUITO_ALTO"
DEFAULT_METHOD = "NOT_SPECIFIED"
DEFAULT_METHOD_STREAM = "unknown"
DEFAULT_STATUS = "completed"
STATUS_OK = "SUCESSO"
STATUS_ERROR = "ERRO"
RULE_TEXT = {
    "regra1": "Pagamento com mais de 30 dias de atraso nos últimos 3 meses",
    "regra2": "Mais de 3 pagamentos com mais de 15 dias de atraso nos últimos 6 meses",
}
GATE_THRESHOLDS = {"landing_to_bronze": 0.05, "bronze_to_silver": 0.05, "silver_to_gold": 0.02}
GATE_DEFAULT = 0.1
RATE_BANDS = ((15.0, "red"), (10.0, "orange"), (5.0, "yellow"))
RATE_BAND_LOW = "green"
QUALITY_BANDS = ((95.0, "green"), (90.0, "yellow"), (80.0, "orange"))
QUALITY_BAND_LOW = "red"


@dataclass(frozen=True)
class RuleProfile:
    """One lateness rule: rows of a look-back window that are later than a threshold.

    ``min_occurrences`` is how many such rows make a customer delinquent; ``bounded``
    closes the window at its reference date, which the batch rules leave open.
    """

    name: str
    window_col: str
    lookback_days: int
    min_days_late: int
    min_occurrences: int = 1
    bounded: bool = False


BATCH_RULES = (
    RuleProfile("regra1", "transaction_date", 90, 30),
    RuleProfile("regra2", "transaction_date", 180, 15, min_occurrences=4),
)
BATCH_V2_RULES = (
    RuleProfile("regra1", "transaction_date", 90, 30, bounded=True),
    RuleProfile("regra2", "transaction_date", 180, 15, min_occurrences=4, bounded=True),
)
SPEC_RULES = (
    RuleProfile("late_30d_3m", "due_date", 90, 30),
    RuleProfile("late_15d_6m", "due_date", 180, 15),
)
STREAM_RULES = (
    RuleProfile("criterio_1", "transaction_date", 90, 30),
    RuleProfile("criterio_2", "transaction_date", 180, 15),
)


@dataclass(frozen=True)
class AnalysisWindow:
    """The dates of one execution: the reference date is the last day of the month before."""

    as_of: dt.date

    @property
    def reference_date(self) -> dt.date:
        return self.as_of.replace(day=1) - dt.timedelta(days=1)

    @property
    def reference_month(self) -> str:
        return self.reference_date.strftime("%Y-%m")

    @property
    def execution_id(self) -> str:
        return self.as_of.strftime("%Y%m%d_%H%M%S")

    @property
    def stamp(self) -> str:
        return self.as_of.strftime("%Y-%m-%d %H:%M:%S")

    def lookback(self, days: int) -> dt.date:
        return self.reference_date - dt.timedelta(days=days)

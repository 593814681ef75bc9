"""Column expressions: built-in Spark functions only, so they stay inside generated code."""

from latebook.functions.dates import (
    analysis_window_columns, date_parts, due_date, parse_timestamp, reference_columns,
)
from latebook.functions.hashing import content_hash, discovered_key_columns, key_hash
from latebook.functions.lateness import (
    banded, days_late, days_late_clamped, open_value, severity,
)
from latebook.functions.money import amount_band
from latebook.functions.privacy import mask_partial, mask_pii, pseudonym, redact_names

__all__ = [
    "amount_band", "analysis_window_columns", "banded", "content_hash", "date_parts", "days_late",
    "days_late_clamped", "discovered_key_columns", "due_date", "key_hash", "mask_partial",
    "mask_pii", "open_value", "parse_timestamp", "pseudonym", "redact_names",
    "reference_columns", "severity",
]

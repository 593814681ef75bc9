"""Masking, pseudonyms and redaction of personal data in columns and free text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names to redact, the replacement, and the shapes of personal identifiers.
REDACTED_NAMES = ("customer_id", "cpf", "email")
REDACTION_TEXT = "*********(redacted)"
MASK = "****"
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+"
CPF_PATTERN = r"(?<!\w)[0-9]{3}\.?[0-9]{3}\.?[0-9]{3}-?[0-9]{2}(?!\w)"


def mask_partial(value: Column) -> Column:
    """First two and last two characters around a mask.

    Identifiers of up to four characters stay readable; use ``pseudonym`` for those.
    """
    return F.concat(F.substring(value, 1, 2), F.lit(MASK), F.substring(value, -2, 2))


def pseudonym(value: Column, salt: str) -> Column:
    """A salted hash: joins still work, the identifier cannot be read back."""
    return F.sha2(F.concat(F.lit(salt), value), 256)


def redact_names(text: Column) -> Column:
    """Replace every word that holds a redacted name.

    The look-behind starts matches at word starts only, where the longest match would
    start anyway; it keeps the search linear on very long words. Texts without any of the
    names skip the pattern.
    """
    names = "|".join(REDACTED_NAMES)
    found = reduce(lambda a, b: a | b, [F.contains(text, F.lit(n)) for n in REDACTED_NAMES])
    redacted = F.regexp_replace(text, rf"(?<!\w)\w*?(?:{names})\w*", REDACTION_TEXT)
    return F.when(found, redacted).otherwise(text)


def mask_pii(text: Column) -> Column:
    """Mask e-mail addresses and taxpayer numbers anywhere in a text.

    The address pattern is tried where a run of its characters begins, or right after the
    match before, and takes the run without going back: linear on very long runs.
    """
    local, domain = EMAIL_PATTERN.split("@")
    start = rf"(?:\G|(?<!{local.removesuffix('+')}))"
    masked = F.when(F.contains(text, F.lit("@")), F.regexp_replace(
        text, f"{start}{local}+@{domain}+", "<EMAIL>")).otherwise(text)
    return F.regexp_replace(masked, CPF_PATTERN, "<CPF>")

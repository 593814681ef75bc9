"""Row keys and content hashes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The separator and the name fragments that mark key columns.
HASH_SEPARATOR = "||"
KEY_NAME_FRAGMENTS = ("id", "cod_", "num_")


def key_hash(columns: Sequence[str]) -> Column:
    """SHA-256 over the joined columns; nulls are left out of the joined text."""
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *[F.col(c) for c in columns]), 256)


def content_hash(columns: Sequence[str]) -> Column:
    return key_hash(columns)


def discovered_key_columns(columns: Iterable[str]) -> list[str]:
    """Columns whose name holds a key fragment anywhere, or all columns if none does.

    ``amount_paid`` and ``date_paid`` hold ``id`` too, so pass explicit keys to upserts.
    """
    names = list(columns)
    return [n for n in names if any(f in n for f in KEY_NAME_FRAGMENTS)] or names

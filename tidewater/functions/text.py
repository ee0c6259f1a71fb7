"""String column expressions: PIN extraction, lane, hashing helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater import config


def pincode(address: Column) -> Column:
    """Indian PIN from a free-text address, or NULL.

    Confusable letters are rewritten to digits, every PIN-shaped group is found
    and the last one wins (addresses end with the PIN); the two halves are
    joined without the separator.
    """
    cleaned = F.translate(address, config.PIN_CONFUSABLES_FROM, config.PIN_CONFUSABLES_TO)
    groups = F.regexp_extract_all(cleaned, F.lit(config.PIN_PATTERN), 0)
    last = F.when(F.size(groups) > 0, F.element_at(groups, -1))
    return F.regexp_replace(last, "[^0-9]", "")


def lane(origin: Column, dest: Column) -> Column:
    """``origin-dest``; NULL when either side is NULL (SQL ``||`` semantics)."""
    return F.concat(origin, F.lit("-"), dest)


def lane_text(origin: Column, dest: Column) -> Column:
    """``origin-dest`` with missing sides as empty text (never NULL)."""
    return F.concat(F.coalesce(origin, F.lit("")), F.lit("-"), F.coalesce(dest, F.lit("")))


def sha1_prefix(text: Column, n: int = 16) -> Column:
    return F.substring(F.sha1(text), 1, n)


def exception_id(shipment_id: Column, exception_type: Column) -> Column:
    """Stable exception id: first 16 hex of sha1(``shipment|type``)."""
    return sha1_prefix(F.concat(shipment_id, F.lit("|"), exception_type), 16)

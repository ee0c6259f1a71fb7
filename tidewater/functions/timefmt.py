"""Column expressions for wire timestamps, hour arithmetic and rounding.

All of them are built-in Spark expressions (codegen, no Python per row).  The
library expects the session time zone to be UTC (``tidewater.session.ensure_utc``).
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_FMT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
# Lenient readers: single-digit fields are accepted like the strptime forms.
ISO_READ = "yyyy-M-d'T'H:m:s'Z'"
EU_SLASH_READ = "d/M/yyyy H:m"
EU_SLASH_WRITE = "dd/MM/yyyy HH:mm"

# Epoch milliseconds accepted: years 1..9999.
_MIN_MS = -62135596800000
_MAX_MS = 253402300799999


def asof_literal(asof: str | datetime) -> Column:
    """An ``asof`` instant as a TIMESTAMP literal (UTC)."""
    return F.lit(to_datetime(asof)).cast("timestamp")


def to_datetime(asof: str | datetime) -> datetime:
    if isinstance(asof, datetime):
        return asof if asof.tzinfo else asof.replace(tzinfo=timezone.utc)
    text = asof.strip().replace("Z", "+00:00").replace(" ", "T")
    dt = datetime.fromisoformat(text)
    return dt if dt.tzinfo else dt.replace(tzinfo=timezone.utc)


def asof_seconds(asof: str | datetime) -> int:
    return int(to_datetime(asof).timestamp())


def parse_epoch_ms(text: Column) -> Column:
    ms = text.try_cast("bigint")
    # Whole seconds (silver precision): floor division keeps pre-1970 instants right.
    return F.when(ms.between(_MIN_MS, _MAX_MS), F.timestamp_seconds(F.floor(ms / 1000)))


def parse_wire_ts(text: Column, ts_format: Column | str) -> Column:
    """Parse a carrier wire timestamp; NULL when it does not parse.

    ``ts_format`` is ``iso8601 | epoch_ms | eu_slash`` (a column or a literal).
    The result has whole seconds, the precision silver keeps (the text
    formats carry no fraction; epoch milliseconds are floored).
    """
    fmt = F.lit(ts_format) if isinstance(ts_format, str) else ts_format
    parsed = (
        F.when(fmt == "iso8601", F.try_to_timestamp(text, F.lit(ISO_READ)))
        .when(fmt == "epoch_ms", parse_epoch_ms(text))
        .when(fmt == "eu_slash", F.try_to_timestamp(text, F.lit(EU_SLASH_READ)))
    )
    return parsed


def format_wire_ts(ts: Column, ts_format: Column | str) -> Column:
    """Render a TIMESTAMP in a carrier's wire format (inverse of ``parse_wire_ts``)."""
    fmt = F.lit(ts_format) if isinstance(ts_format, str) else ts_format
    return (
        F.when(fmt == "iso8601", F.date_format(ts, ISO_FMT))
        .when(fmt == "epoch_ms", F.unix_millis(ts).cast("string"))
        .when(fmt == "eu_slash", F.date_format(ts, EU_SLASH_WRITE))
    )


def iso(ts: Column) -> Column:
    """ISO-8601 UTC text at second precision, as silver tables store it."""
    return F.date_format(ts, ISO_FMT)


def seconds_between(later: Column, earlier: Column) -> Column:
    """Whole seconds ``later - earlier`` as BIGINT."""
    return F.unix_seconds(later) - F.unix_seconds(earlier)


def hours_1dp(seconds: Column) -> Column:
    """Hours rounded to one decimal, half away from zero, computed on the exact
    seconds value so every engine gets the same digit on ``.x5`` ties."""
    s = seconds.cast("double")
    return F.signum(s) * F.floor((F.abs(s) * 10 + 1800) / 3600) / 10.0


def hours_text1(seconds: Column) -> Column:
    """Positive whole seconds as hours text with one decimal, as ``'%.1f'``
    renders the double ``seconds / 3600``.

    Only ``x.x5`` hours (odd multiples of 180 s) need care: there the double
    lies above, below or exactly on the tie.  Its fraction times 2**52 is a
    whole number, so the comparison with the tie is exact; on it, the digit
    goes to even."""
    s = seconds.cast("bigint")
    hours = s.cast("double") / 3600.0
    tenths = F.floor(s / 360)
    over = s - tenths * 360
    scaled = ((hours - F.floor(hours)) * float(2 ** 52)).cast("bigint") * 20
    tie = ((tenths % 10) * 2 + 1) * F.lit(2 ** 52)
    up = (over > 180) | ((over == 180) & ((scaled > tie) | ((scaled == tie) & (tenths % 2 == 1))))
    t = tenths + F.when(up, 1).otherwise(0)
    return F.concat(F.floor(t / 10).cast("string"), F.lit("."), (t % 10).cast("string"))


def hours_text0(seconds: Column) -> Column:
    """Hours as integer text with half-even rounding (``'{:.0f}'`` style)."""
    return F.bround(seconds.cast("double") / 3600.0, 0).cast("bigint").cast("string")


def minute_diff(later: Column, earlier: Column) -> Column:
    """Number of minute boundaries crossed from ``earlier`` to ``later``."""
    return F.floor(F.unix_seconds(later) / 60) - F.floor(F.unix_seconds(earlier) / 60)

"""Alert decisions and state as table operators.

State is a table ``exception_id, type, band, alerted_at``; a run is a pure
function ``(queue, state, delivery results) -> (decisions, next state,
failures)``: one left join on ``exception_id``, one anti join + union for the
new state.  Nothing is collected to the driver.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater import config
from tidewater.functions.timefmt import asof_literal

STATE_COLUMNS = ["exception_id", "type", "band", "alerted_at"]


def band(age_hours: Column) -> Column:
    """Severity band 0/1/2 with inclusive lower edges at 48 h and 96 h."""
    out = F.lit(0)
    for edge in config.BANDS_H:
        out = out + F.when(age_hours >= edge, 1).otherwise(0)
    return out


def message(decision: Column) -> Column:
    prefix = F.when(decision == "escalated", F.lit(":rotating_light: ESCALATION")) \
        .otherwise(F.lit(":package: New exception"))
    return F.concat(prefix, F.lit(" ["), F.col("exception_type"), F.lit("] shipment "),
                    F.col("shipment_id"), F.lit(" ("), F.col("carrier"), F.lit(") — "),
                    F.col("detail"), F.lit(" — age "), F.col("age_hours").cast("string"), F.lit("h"))


def decide(queue: DataFrame, state: DataFrame) -> DataFrame:
    """Per exception: ``band``, ``prior_band``, ``decision`` (new | escalated |
    suppressed) and the message text for alerts that go out."""
    s = state.select("exception_id", F.col("band").alias("prior_band"))
    j = queue.join(s, "exception_id", "left").withColumn("band", band(F.col("age_hours")))
    decision = (F.when(F.col("prior_band").isNull(), F.lit("new"))
                .when(F.col("band") > F.col("prior_band"), F.lit("escalated"))
                .otherwise(F.lit("suppressed")))
    j = j.withColumn("decision", decision)
    return j.select("exception_id", "shipment_id", "carrier", "exception_type", "age_hours", "band",
                    "prior_band", "decision",
                    F.when(F.col("decision") != "suppressed", message(F.col("decision"))).alias("message"))


def state_from_queue(queue: DataFrame, alerted_at: str | datetime) -> DataFrame:
    """State as if every exception of ``queue`` had been alerted at ``alerted_at``."""
    return queue.select("exception_id", F.col("exception_type").alias("type"),
                        band(F.col("age_hours")).alias("band"), asof_literal(alerted_at).alias("alerted_at"))


def next_state(state: DataFrame, decisions: DataFrame, now: str | datetime,
               delivered: DataFrame | None = None, ops: DataFrame | None = None) -> DataFrame:
    """State after a run: alerts that were delivered are recorded (type, band,
    now); failed ones are not, so the next run retries them.  Entries are never
    pruned.  ``delivered``: ``exception_id, ok`` (missing -> delivered).
    ``ops``: fired ops alerts (``quarantine_spike``), recorded under their key
    of the day in the same state."""
    sent = decisions.where(F.col("decision") != "suppressed").select("exception_id", "exception_type", "band")
    if ops is not None:
        sent = sent.unionByName(ops.select("exception_id", F.lit("ops").alias("exception_type"), F.lit(0).alias("band")))
    if delivered is not None:
        sent = sent.join(delivered, "exception_id", "left").where(F.coalesce(F.col("ok"), F.lit(True)))
    rec = sent.select("exception_id", F.col("exception_type").alias("type"), "band",
                      asof_literal(now).alias("alerted_at"))
    return state.select(*STATE_COLUMNS).join(rec.select("exception_id"), "exception_id", "left_anti") \
        .unionByName(rec)


def failures(decisions: DataFrame, delivered: DataFrame, now: str | datetime,
             queue: DataFrame | None = None) -> DataFrame:
    """Ledger rows for alerts whose delivery failed (append-only sink); with
    ``queue`` each also holds the whole ``exception`` that was to be reported."""
    sent = decisions.where(F.col("decision") != "suppressed").join(delivered, "exception_id")
    failed = sent.where(~F.col("ok")).select(asof_literal(now).alias("failed_at"), "exception_id", "message")
    if queue is None:
        return failed
    whole = queue.select("exception_id", F.struct(*queue.columns).alias("exception"))
    return failed.join(whole, "exception_id").select("failed_at", "exception_id", "exception", "message")


def quarantine_share(counters: DataFrame) -> DataFrame:
    """Percent of read rows quarantined in a run (0 when nothing was read)."""
    read, q = F.col("events_read"), F.col("quarantined_total")
    pct = F.when(read > 0, q * 100.0 / read).otherwise(F.lit(0.0))
    return counters.select("events_read", "quarantined_total", pct.alias("quarantine_pct"))


def quarantine_spike(counters: DataFrame, state: DataFrame, now: str | datetime) -> DataFrame:
    """Ops alert row when the quarantine share exceeds 5 %, once per UTC day:
    the key ``ops:quarantine_spike:<date>`` must not be in the state yet."""
    share = quarantine_share(counters)
    key = F.concat(F.lit("ops:quarantine_spike:"), F.date_format(asof_literal(now), "yyyy-MM-dd"))
    fired = share.where(F.col("quarantine_pct") > config.QUARANTINE_SPIKE_PCT).select(
        key.alias("exception_id"),
        F.concat(F.lit(":warning: QUARANTINE SPIKE — "), F.col("quarantined_total").cast("string"), F.lit("/"),
                 F.col("events_read").cast("string"), F.lit(" events ("),
                 F.format_string("%.1f", F.col("quarantine_pct")), F.lit("%) quarantined this run")).alias("message"),
        "quarantine_pct")
    return fired.join(state.select("exception_id"), "exception_id", "left_anti")


def feed_silence(landed_times: DataFrame, files_landed: Column | int, now: str | datetime,
                 max_silence_h: float = config.FEED_SILENCE_MAX_H) -> DataFrame:
    """One-row verdict: hours since the newest landed record/file (NULL when
    there is none) and whether the feed is silent (nothing landed this run and
    no bronze at all or silence above the limit).  ``landed_times`` has ``ts``."""
    newest = landed_times.agg(F.max("ts").alias("newest"))
    hours = (F.unix_seconds(asof_literal(now)) - F.unix_seconds(F.col("newest"))) / 3600.0
    landed = files_landed if isinstance(files_landed, Column) else F.lit(files_landed)
    return newest.select(
        F.round(hours, 2).alias("feed_silence_hours"),
        ((landed == 0) & (F.col("newest").isNull() | (hours > max_silence_h))).alias("silent"))

"""ETA for in-flight shipments, and its holdout evaluation.

Everything starts from the per-shipment state (one row per shipment), so the
model is two aggregates over shipments: medians per (carrier, lane) and one
global row.  The global row is attached with an equi-join on a constant key
(a single-row, broadcast build side); lane medians and mart offsets are
joined on (carrier, lane) and left to adaptive execution to broadcast or
shuffle.  Exceptions are pre-aggregated per shipment (at most one row per
exception type) before the join.

All time arithmetic is in integer seconds; the span uses the learned ratio,
so the prediction is floored to a whole second at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater import config
from tidewater.functions.text import lane_text
from tidewater.functions.timefmt import hours_1dp, hours_text1, iso
from tidewater.operators.gold import round_ratio
from tidewater.operators.selection import medians

ETA_COLUMNS = ["shipment_id", "carrier", "lane", "last_event_type", "predicted_delivery_ts",
               "planned_anchor_ts", "planned_span_h", "span_source", "median_offset_h", "offset_source",
               "live_adjustment_h", "adjustment_reason"]
DELAY_MIN_S = int(config.ETA_DEPARTURE_DELAY_MIN_H * 3600)


def _s(c: Column) -> Column:
    return F.unix_seconds(c)


def features(state: DataFrame) -> DataFrame:
    """Per-shipment inputs: carrier and lane of the last milestone, planned and
    actual seconds of first/last/departed rows, completion flag."""
    last = F.col("last")
    return state.select(
        "shipment_id",
        last["carrier"].alias("carrier"),
        lane_text(last["origin"], last["dest"]).alias("lane"),
        last["event_type"].alias("last_event_type"),
        (last["event_type"] == "delivered").alias("completed"),
        _s(F.col("first_planned_ts")).alias("first_planned_s"),
        _s(last["planned_ts"]).alias("last_planned_s"),
        _s(last["actual_ts"]).alias("last_actual_s"),
        _s(F.col("first_departed_planned_ts")).alias("first_dep_planned_s"),
        _s(F.col("vessel_departed.planned_ts")).alias("dep_planned_s"),
        _s(F.col("vessel_departed.actual_ts")).alias("dep_actual_s"),
    )


_MEASURES = ("span_s", "off_s", "ratio")


def _sketched(c: Column) -> Column:
    return F.percentile_approx(c, 0.5, 10000).cast("double")


def learn(completed: DataFrame, approx: bool = False) -> tuple[DataFrame, DataFrame]:
    """(lane model, global model) from completed shipments' features.

    span = last planned - first planned; offset = last actual - last planned,
    minus the departure delay when that delay exceeds one hour; ratio =
    span / (first departed planned - first planned) when both are positive."""
    span = F.col("last_planned_s") - F.col("first_planned_s")
    dep_delay = F.col("dep_actual_s") - F.col("dep_planned_s")
    off = (F.col("last_actual_s") - F.col("last_planned_s")
           - F.when(dep_delay > DELAY_MIN_S, dep_delay).otherwise(0))
    gap = F.col("first_dep_planned_s") - F.col("first_planned_s")
    ratio = F.when((gap > 0) & (span > 0), span.cast("double") / gap)
    rows = completed.select("carrier", "lane", span.cast("double").alias("span_s"),
                            off.cast("double").alias("off_s"), ratio.alias("ratio"))
    if approx:
        lane_model = rows.groupBy("carrier", "lane").agg(
            _sketched(F.col("span_s")).alias("lane_span_s"), _sketched(F.col("off_s")).alias("lane_off_s"))
        picks = [_sketched(F.col(c)).alias(c) for c in _MEASURES]
        global_model = rows.agg(*picks, F.count(F.lit(1)).alias("trained_on"))
    else:
        # one selection for all: a row a measure, once for its lane and once for the whole
        each = rows.select("carrier", "lane", F.explode(F.array(*[
            F.struct(F.lit(m).alias("measure"), F.lit(whole).alias("whole"), F.col(m).alias("v"))
            for m in _MEASURES for whole in (True, False) if whole or m != "ratio"])).alias("x"))
        key = lambda c: F.when(~F.col("x.whole"), F.col(c)).alias(c)
        each = each.select("x.measure", "x.whole", key("carrier"), key("lane"), "x.v")
        found = medians(each, ["measure", "whole", "carrier", "lane"], "v")
        pick = lambda m: F.max(F.when(F.col("measure") == m, F.col("median")))
        lane_model = found.where("not whole").groupBy("carrier", "lane").agg(
            pick("span_s").alias("lane_span_s"), pick("off_s").alias("lane_off_s"))
        global_model = found.where("whole").agg(*[pick(m).alias(m) for m in _MEASURES], F.coalesce(
            F.max(F.when(F.col("measure") == "span_s", F.col("n"))), F.lit(0)).alias("trained_on"))
    return lane_model, global_model.select(
        F.coalesce("span_s", F.lit(0.0)).alias("global_span_s"), F.coalesce("off_s", F.lit(0.0)).alias("global_off_s"),
        F.col("ratio").alias("departed_ratio"), "trained_on")


def exception_adjustments(queue: DataFrame) -> DataFrame:
    """Per shipment: adjustment seconds and reason texts in exception-id order."""
    stalled = F.col("exception_type") == "VESSEL_STALLED"
    congested = F.col("probable_cause") == "congestion"
    secs = (F.when(stalled, F.lit(config.STALL_ADJ_H * 3600))
            .when(congested, F.lit(config.CONGESTION_ADJ_H * 3600)))
    text = (F.when(stalled, F.lit(f"vessel_stalled(+{config.STALL_ADJ_H}h)"))
            .when(congested, F.lit(f"congestion(+{config.CONGESTION_ADJ_H}h)")))
    q = queue.select("shipment_id", "exception_id", secs.alias("secs"), text.alias("text")) \
        .where(F.col("secs").isNotNull())
    g = q.groupBy("shipment_id").agg(
        F.sum("secs").alias("exc_adj_s"),
        F.sort_array(F.collect_list(F.struct("exception_id", "text"))).alias("_r"))
    return g.select("shipment_id", "exc_adj_s",
                    F.array_join(F.transform("_r", lambda r: r["text"]), ";").alias("exc_reasons"))


def predict(feats: DataFrame, lane_model: DataFrame, global_model: DataFrame,
            adjustments: DataFrame | None = None, mart_offsets: DataFrame | None = None) -> DataFrame:
    """Predicted delivery with every input that produced it.

    ``mart_offsets``: ``carrier, lane, median_offset_h`` (the eta_baseline rows
    of delivered milestones); when given, they win over learned offsets."""
    f = feats.withColumn("_one", F.lit(1))
    g = F.broadcast(global_model.withColumn("_one", F.lit(1)))  # exactly one row
    f = f.join(g, "_one", "left").drop("_one")
    f = f.join(lane_model, ["carrier", "lane"], "left")
    if mart_offsets is not None:
        m = mart_offsets.select("carrier", "lane", (F.col("median_offset_h") * 3600).alias("mart_off_s"))
        f = f.join(m, ["carrier", "lane"], "left")
    else:
        f = f.withColumn("mart_off_s", F.lit(None).cast("double"))
    if adjustments is not None:
        f = f.join(adjustments, "shipment_id", "left")
    else:
        f = f.select("*", F.lit(None).cast("double").alias("exc_adj_s"),
                     F.lit(None).cast("string").alias("exc_reasons"))

    ratio = F.col("departed_ratio")
    gap = F.col("dep_planned_s") - F.col("first_planned_s")
    use_ratio = F.col("dep_planned_s").isNotNull() & ratio.isNotNull() & (ratio != 0) & (gap > 0)
    span_s = (F.when(use_ratio, gap * ratio)
              .when(F.col("lane_span_s").isNotNull(), F.col("lane_span_s"))
              .otherwise(F.col("global_span_s")))
    span_src = (F.when(use_ratio, F.concat(F.lit("planned_ratio(x"), F.format_string("%.2f", ratio), F.lit(")")))
                .when(F.col("lane_span_s").isNotNull(), F.concat(F.lit("lane_median("), F.col("lane"), F.lit(")")))
                .otherwise(F.lit("global_median")))
    off_s = F.coalesce(F.col("mart_off_s"), F.col("lane_off_s"), F.col("global_off_s"))
    off_src = (F.when(F.col("mart_off_s").isNotNull(), F.lit("eta_baseline_mart"))
               .when(F.col("lane_off_s").isNotNull(), F.concat(F.lit("lane_median("), F.col("lane"), F.lit(")")))
               .otherwise(F.lit("global_median")))
    dep_delay = F.col("dep_actual_s") - F.col("dep_planned_s")
    late = dep_delay > DELAY_MIN_S
    adj_s = F.when(late, dep_delay).otherwise(0) + F.coalesce(F.col("exc_adj_s"), F.lit(0.0))
    dep_text = F.when(late, F.concat(F.lit("observed_departure_delay(+"),
                                     hours_text1(dep_delay), F.lit("h)")))
    reason = F.coalesce(F.nullif(F.concat_ws(";", dep_text, F.col("exc_reasons")), F.lit("")),
                        F.lit("none"))
    f = f.select("*", span_s.alias("_span"), off_s.alias("_off"), adj_s.alias("_adj"),
                 span_src.alias("span_source"), off_src.alias("offset_source"),
                 reason.alias("adjustment_reason"))
    # whole seconds of the sum rounded to microseconds: 1043.9999999999998 s are 1044 s
    micros = F.bround((F.col("_span") + F.col("_off") + F.col("_adj")) * 1e6, 0)
    pred_s = F.col("first_planned_s") + F.floor(micros / 1e6)
    return f.select(
        "shipment_id", "carrier", "lane", "last_event_type",
        F.timestamp_seconds(pred_s).alias("predicted_delivery_ts"),
        F.timestamp_seconds(F.col("first_planned_s")).alias("planned_anchor_ts"),
        hours_1dp(F.col("_span")).alias("planned_span_h"), "span_source",
        hours_1dp(F.col("_off")).alias("median_offset_h"), "offset_source",
        hours_1dp(F.col("_adj")).alias("live_adjustment_h"), "adjustment_reason",
    )


def shipment_eta(state: DataFrame, queue: DataFrame, mart_offsets: DataFrame | None = None,
                 approx: bool = False) -> DataFrame:
    """Predictions for every shipment whose last milestone is not delivered."""
    feats = features(state)
    lane_model, global_model = learn(feats.where("completed"), approx)
    return predict(feats.where(~F.col("completed")), lane_model, global_model,
                   exception_adjustments(queue), mart_offsets)


def is_train(shipment_id: Column) -> Column:
    """Hash split: the sha1 of the id read as an integer is even (its last hex digit is)."""
    return F.substring(F.sha1(shipment_id), 40, 1).isin("0", "2", "4", "6", "8", "a", "c", "e")


def evaluate(silver: DataFrame, state: DataFrame, queue: DataFrame,
             cutoff: str = "vessel_departed", approx: bool = False) -> DataFrame:
    """Holdout MAE: train on even-hash completed shipments, predict the others
    from their milestones up to ``cutoff`` (no mart offsets), compare with the
    actual delivery.  One row: test_shipments, train_shipments, mae_hours."""
    from tidewater.operators.state import shipment_state  # local: avoid a cycle

    feats = features(state).where("completed")
    train = feats.where(is_train(F.col("shipment_id")))
    lane_model, global_model = learn(train, approx)
    test_ids = feats.where(~is_train(F.col("shipment_id"))).select(
        "shipment_id", F.col("last_actual_s").alias("actual_s"))
    cut = config.MILESTONE_INDEX[cutoff]
    visible = silver.join(test_ids.select("shipment_id"), "shipment_id", "left_semi") \
        .where(F.col("ms_idx") <= cut)
    pred = predict(features(shipment_state(visible)), lane_model, global_model,
                   exception_adjustments(queue), None)
    err = pred.join(test_ids, "shipment_id").select(
        F.abs(F.unix_seconds("predicted_delivery_ts") - F.col("actual_s")).alias("err_s"))
    scored = err.agg(F.count(F.lit(1)).alias("test_shipments"), F.sum("err_s").alias("_e"))
    trained = global_model.select(F.col("trained_on").alias("train_shipments"), F.lit(1).alias("_one"))
    out = scored.withColumn("_one", F.lit(1)).join(F.broadcast(trained), "_one").drop("_one")
    return out.select("test_shipments", "train_shipments",
                      F.when(F.col("test_shipments") > 0,
                             round_ratio(F.col("_e"), F.col("test_shipments") * 3600, 2)).alias("mae_hours"))


def format_eta(eta: DataFrame) -> DataFrame:
    return eta.select(*[iso(F.col(c)).alias(c) if c in ("predicted_delivery_ts", "planned_anchor_ts")
                        else F.col(c) for c in ETA_COLUMNS])


def run_summary(state: DataFrame, mart_offsets: DataFrame | None = None) -> DataFrame:
    """One row: shipments predicted (in flight), completed shipments trained
    on, and mart offsets available."""
    f = features(state).agg(F.count_if(~F.col("completed")).alias("inflight"),
                            F.count_if(F.col("completed")).alias("completed_trained_on"))
    if mart_offsets is None:
        return f.withColumn("mart_offsets_used", F.lit(0).cast("bigint"))
    m = mart_offsets.agg(F.count(F.lit(1)).alias("mart_offsets_used"))
    return f.withColumn("_k", F.lit(1)).join(m.withColumn("_k", F.lit(1)), "_k").drop("_k")

"""Run metrics, SLO checks and governed metric answers.

Governed metrics are evaluated for every filter combination at once: each mart
row is exploded into the (carrier filter, port filter) combinations it belongs
to (at most 2 x 4 per row), then one aggregate per combination.  The answers
table is therefore bounded by the configured metrics, carriers and ports.
Questions are matched to all phrases in one pass, as a projection.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater import config
from tidewater.functions.phrases import found as find_phrases
from tidewater.functions.timefmt import asof_literal
from tidewater.operators.gold import round_ratio


# ---- run metrics -------------------------------------------------------------

def run_metrics(counters: DataFrame, queue: DataFrame) -> DataFrame:
    """``metric, label, value`` rows from the run counters and the queue."""
    c = counters
    simple = ["events_read", "events_processed", "duplicates"]
    rows = [F.struct(F.lit(m).alias("metric"), F.lit("").alias("label"), F.col(m).cast("bigint").alias("value"))
            for m in simple]
    rows += [F.struct(F.lit("quarantined").alias("metric"), F.lit(f'reason="{r}"').alias("label"),
                      F.col(f"quarantined_{r}").cast("bigint").alias("value"))
             for r in config.QUARANTINE_REASONS]
    base = c.select(F.inline(F.array(*rows)))
    # the queue is counted once; the total is the sum over its types (a row a type)
    by_type = queue.groupBy("exception_type").agg(F.count(F.lit(1)).cast("bigint").alias("value"))
    one = lambda metric, label, value: F.struct(F.lit(metric).alias("metric"), label.alias("label"), value.alias("value"))
    label = F.concat(F.lit('type="'), F.col("exception_type"), F.lit('"'))
    of_queue = by_type.agg(F.collect_list(one("exceptions_by_type", label, F.col("value"))).alias("typed"),
                           F.coalesce(F.sum("value"), F.lit(0)).cast("bigint").alias("total"))
    total = F.array(one("exceptions", F.lit(""), F.col("total")))
    return base.unionByName(of_queue.select(F.inline(F.concat("typed", total))))


def exposition(metric_rows: DataFrame, prefix: str = "tidewater_") -> DataFrame:
    """Prometheus text lines, one per metric row (a string column)."""
    label = F.when(F.col("label") != "", F.concat(F.lit("{"), F.col("label"), F.lit("}"))).otherwise(F.lit(""))
    return metric_rows.select(F.concat(F.lit(prefix), F.col("metric"), label, F.lit(" "),
                                       F.col("value").cast("string")).alias("line"))


def job_metrics(runs: DataFrame) -> DataFrame:
    """``metric, label, value`` of each job's newest run from a run log ``job,
    finished_at, seconds, rows``: run seconds, instant of the last run, rows read."""
    last = runs.groupBy("job").agg(F.max_by(F.struct("finished_at", "seconds", "rows"), "finished_at").alias("r"))
    label = F.concat(F.lit('job="'), "job", F.lit('"'))
    one = lambda name, v: F.struct(F.lit(name).alias("metric"), label.alias("label"), v.cast("bigint").alias("value"))
    return last.select(F.inline(F.array(
        one("run_seconds", F.ceil("r.seconds")), one("last_run_timestamp", F.unix_seconds("r.finished_at")),
        one("rows_read", F.col("r.rows")))))


def run_freshness(runs: DataFrame, now: str | datetime) -> DataFrame:
    """Time since each job last finished against its target: ``slo, lag_s, target_s, ok``; a job that never
    ran has a null lag and is not ok."""
    targets = [("normalize", "normalize_freshness", config.SLO_NORMALIZE_FRESHNESS_S),
               ("ais", "ais_staleness", config.SLO_AIS_STALENESS_S)]
    newest = [F.max(F.when(F.col("job") == job, F.col("finished_at"))).alias(job) for job, _, _ in targets]
    rows = F.array(*[F.struct(F.lit(slo).alias("slo"), (F.unix_seconds(asof_literal(now)) - F.unix_seconds(job)).alias("lag_s"),
                              F.lit(target).cast("bigint").alias("target_s")) for job, slo, target in targets])
    out = runs.agg(*newest).select(F.inline(rows))
    return out.withColumn("ok", F.coalesce(F.col("lag_s") < F.col("target_s"), F.lit(False)))


def slo_freshness(silver: DataFrame, now: str | datetime, positions: DataFrame | None = None) -> DataFrame:
    """Lag of the newest silver event against the freshness target and the
    feed-silence limit, and, when AIS positions are given, of the newest AIS
    report against the staleness target: ``slo, lag_s, target_s, ok``."""
    now_s = F.unix_seconds(asof_literal(now))
    newest = silver.agg(F.max("actual_ts").alias("newest"))
    targets = [("normalize_freshness", config.SLO_NORMALIZE_FRESHNESS_S),
               ("feed_silence", int(config.FEED_SILENCE_MAX_H * 3600))]
    rows = F.array(*[F.struct(F.lit(n).alias("slo"), F.lit(t).cast("bigint").alias("target_s")) for n, t in targets])
    out = newest.select((now_s - F.unix_seconds(F.col("newest"))).alias("lag_s"), F.inline(rows))
    if positions is not None:
        ais_lag = positions.agg(F.max("received_at").alias("newest")).select(
            (now_s - F.unix_seconds(F.col("newest"))).alias("lag_s"),
            F.lit("ais_staleness").alias("slo"), F.lit(config.SLO_AIS_STALENESS_S).cast("bigint").alias("target_s"))
        out = out.unionByName(ais_lag)
    return out.select("slo", "lag_s", "target_s", (F.col("lag_s") < F.col("target_s")).alias("ok"))


# ---- governed metrics ----------------------------------------------------------

def metric_rows(marts: dict[str, DataFrame]) -> DataFrame:
    """Long form of the marts: ``metric, carrier, lane, value, weight``.

    Each mart is read once; its metrics come out of one projection as an
    exploded array of (metric, value, weight) structs."""
    by_mart: dict[str, list] = {}
    for name, (mart, column, _agg, weight, _unit, _syn) in config.METRICS.items():
        by_mart.setdefault(mart, []).append(F.struct(
            F.lit(name).alias("metric"), F.col(column).cast("double").alias("value"),
            (F.col(weight).cast("double") if weight else F.lit(None).cast("double")).alias("weight")))
    parts = [marts[mart].select("carrier", "lane", F.explode(F.array(*cols)).alias("m"))
             .select(F.col("m.metric").alias("metric"), "carrier", "lane", "m.value", "m.weight")
             for mart, cols in by_mart.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _agg_value(metric: Column) -> list[Column]:
    """Aggregates producing ``value`` for the metric's governed aggregation.

    Each aggregate only sees the rows of the metrics that use it (others feed
    NULL), so e.g. the exact median keeps values for median metrics only."""
    v = F.col("value")
    t = F.round(v * 100).cast("bigint")  # hundredths: marts carry at most 2 dp
    kinds = {}
    for name, (_m, _c, agg, _w, _u, _s) in config.METRICS.items():
        kinds.setdefault(agg, []).append(name)

    def only(kind, col):
        return F.when(metric.isin(*kinds.get(kind, [])), col)

    n = F.count(v)
    w = F.when(v.isNotNull(), F.col("weight"))
    sum_w = F.sum(only("weighted_avg", w))
    by_type = {
        "sum": F.when(n > 0, F.sum(only("sum", v))),
        "avg": F.when(n > 0, round_ratio(F.sum(only("avg", t)), n * 100, 2)),
        "weighted_avg": F.when((n > 0) & (sum_w != 0),
                               round_ratio(F.sum(only("weighted_avg", t * w)), F.round(sum_w * 100), 2)),
        "median_of_medians": F.when(n > 0, round_ratio(F.round(F.median(only("median_of_medians", t)) * 2),
                                                       F.lit(200), 2)),
    }
    expr = None
    for name, (_m, _c, agg, _w, _u, _s) in config.METRICS.items():
        expr = (F.when(metric == name, by_type[agg]) if expr is None
                else expr.when(metric == name, by_type[agg]))
    return [expr.alias("value"), F.count(F.lit(1)).alias("rows_used")]


def _with_filters(rows: DataFrame) -> DataFrame:
    """Each mart row once per filter combination it satisfies: carrier filter
    in (none, its carrier); port filter in (none, each port code in its lane)."""
    ports = F.filter(F.array(*[F.lit(p) for p in config.PORT_CODES]),
                     lambda p: F.coalesce(F.col("lane"), F.lit("")).contains(p))
    by_carrier = rows.select(
        "*", F.explode(F.array(F.lit(None).cast("string"), F.col("carrier"))).alias("carrier_filter"))
    return by_carrier.select(
        "*", F.explode(F.concat(F.array(F.lit(None).cast("string")), ports)).alias("port_filter"))


def governed_values(marts: dict[str, DataFrame], rows: DataFrame | None = None) -> DataFrame:
    """Value of every metric for every (carrier filter, port filter) with rows.
    ``rows``: the filtered metric rows, when the caller already built them."""
    rows = rows if rows is not None else _with_filters(metric_rows(marts))
    g = rows.groupBy("metric", "carrier_filter", "port_filter").agg(*_agg_value(F.col("metric")))
    meta = [(n, m[0], m[1], m[2]) for n, m in config.METRICS.items()]
    spark = rows.sparkSession
    md = F.broadcast(spark.createDataFrame(meta, "metric string, mart string, column_name string, "
                                                 "aggregation string"))
    return g.join(md, "metric")


def superlatives(marts: dict[str, DataFrame], rows: DataFrame | None = None) -> DataFrame:
    """Best and worst carrier per (metric, filters), and the values of all carriers by name.
    Ties go to the alphabetically first carrier."""
    rows = rows if rows is not None else _with_filters(metric_rows(marts))
    per = rows.groupBy("metric", "carrier_filter", "port_filter", "carrier").agg(*_agg_value(F.col("metric"))) \
        .where(F.col("value").isNotNull())
    lower = F.col("metric").isin(*config.LOWER_IS_BETTER)
    lo = F.min_by("carrier", F.struct(F.col("value"), F.col("carrier")))
    hi = F.min_by("carrier", F.struct(-F.col("value"), F.col("carrier")))
    g = per.groupBy("metric", "carrier_filter", "port_filter").agg(
        lo.alias("_lo"), hi.alias("_hi"), F.min("value").alias("_lov"), F.max("value").alias("_hiv"),
        F.array_sort(F.collect_list(F.struct("carrier", "value"))).alias("all_values"))  # a row a carrier
    return g.select("metric", "carrier_filter", "port_filter",
                    F.when(lower, F.col("_lo")).otherwise(F.col("_hi")).alias("best_entity"),
                    F.when(lower, F.col("_lov")).otherwise(F.col("_hiv")).alias("best_value"),
                    F.when(lower, F.col("_hi")).otherwise(F.col("_lo")).alias("worst_entity"),
                    F.when(lower, F.col("_hiv")).otherwise(F.col("_lov")).alias("worst_value"), "all_values")


def phrase_rows() -> list[tuple[str, str, str, int, int]]:
    """``kind, key, phrase, plen, ord`` of every phrase (config order)."""
    rows = []
    for name, (_m, _c, _a, _w, _u, syn) in config.METRICS.items():
        rows += [("metric", name, p) for p in [name.replace("_", " ")] + syn]
    for dim, values in config.DIMENSION_PHRASES.items():
        rows += [(dim, code, p) for p, code in values.items()]
    return [(kind, key, p, len(p), i) for i, (kind, key, p) in enumerate(rows)]


def _tokens(text: Column) -> Column:
    """Lower-cased text with every run of non-alphanumerics (except ``-``) as
    one space, padded, so `` phrase `` containment is a whole-word match."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^a-z0-9\-]+", " "), F.lit(" "))


def resolve_questions(questions: DataFrame, mode: str = "substring") -> DataFrame:
    """``question_id, metric, carrier_filter, port_filter, superlative`` per question.

    Longest contained phrase wins per kind (first in config order on a tie);
    superlative words are matched best before worst.  ``mode="substring"``
    reproduces plain containment (so "la" also hits inside "delay");
    ``mode="token"`` matches phrases and superlative words on word boundaries."""
    if mode == "token":
        q = questions.select("question_id", _tokens(F.col("question")).alias("_ql"))
        spell = lambda p: f" {re.sub('[^a-z0-9-]+', ' ', p.lower())} "
        words = lambda ws: [f" {w} " for w in ws]
    elif mode == "substring":
        q = questions.select("question_id", F.lower(F.col("question")).alias("_ql"))
        spell = str
        words = list
    else:
        raise ValueError(f"unknown mode {mode!r}")
    listed = [(kind, key, spell(p), plen, i) for kind, key, p, plen, i in phrase_rows()]

    def pick(kind):
        """Key of the longest phrase of a kind that the text contains, the first listed of equals."""
        rank = {}
        for _, key, phrase, plen, i in (r for r in listed if r[0] == kind):
            rank.setdefault(phrase, (plen, -i, key))
        of = F.create_map(*[x for p, (plen, i, key) in rank.items()
                            for x in (F.lit(p), F.struct(F.lit(plen), F.lit(i), F.lit(key).alias("key")))])
        best = F.array_max(F.transform(find_phrases(F.col("_ql"), list(rank)), lambda p: F.element_at(of, p)))
        return best.key

    res = q.select("question_id", "_ql", pick("metric").alias("metric"), pick("carrier").alias("carrier_filter"),
                   pick("port").alias("port_filter"))
    best = F.lit(False)
    for w in words(config.SUPERLATIVE_BEST):
        best = best | F.col("_ql").contains(w)
    worst = F.lit(False)
    for w in words(config.SUPERLATIVE_WORST):
        worst = worst | F.col("_ql").contains(w)
    return res.select("question_id", F.when(best, "best").when(worst, "worst").alias("superlative"), "metric",
                      "carrier_filter", "port_filter")


def _number(value: Column) -> Column:
    """A value as text: up to two decimals, at least one."""
    return F.regexp_replace(F.format_string("%.2f", value), "0$", "")


def _cited(answers: DataFrame) -> DataFrame:
    """Answers with what they rest on: answer or refusal text, the values of all carriers, mart, column,
    aggregation, unit, definition and filters of the metric."""
    def of(field):
        return F.element_at(F.create_map(*[F.lit(x) for name in config.METRICS for x in (name, field(name))]),
                            F.coalesce("metric", F.lit("")))

    answers = answers.withColumns({
        "mart": of(lambda m: config.METRICS[m][0]), "column_name": of(lambda m: config.METRICS[m][1]),
        "aggregation": of(lambda m: config.METRICS[m][2]), "unit": of(lambda m: config.METRICS[m][4]),
        "definition": of(config.METRIC_DEFINITIONS.get),
        "filters": F.when(F.col("metric").isNotNull(), F.concat_ws(
            ", ", F.concat(F.lit("carrier="), "carrier_filter"), F.concat(F.lit("port="), "port_filter")))})
    text = F.concat(_number(F.col("value")), "unit")
    none = F.concat(F.lit("no rows of "), "mart", F.lit(" match the filters: "), "filters")
    listed = F.array_join(F.transform("all_values", lambda v: F.concat(v.carrier, F.lit("="), _number(v.value))), ";")
    return answers.withColumns({
        "answer": F.when(F.col("kind") == "superlative", F.concat("entity", F.lit(": "), text))
                   .when(F.col("kind") == "value", text),
        "refusal": F.when(F.col("kind") == "refusal", F.coalesce(
            none, F.lit("only governed metrics are answered: " + ", ".join(config.METRICS)))),
        "all_values": F.when(F.col("kind") == "superlative", listed)})


def answer_questions(questions: DataFrame, marts: dict[str, DataFrame], mode: str = "substring",
                     cite: bool = False) -> DataFrame:
    """``question_id, metric, carrier_filter, port_filter, kind, entity, value,
    rows_used``; kind is superlative | value | refusal.  ``cite`` adds what an
    answer rests on: ``answer, refusal, all_values, mart, column_name,
    aggregation, unit, definition, filters``."""
    r = resolve_questions(questions, mode)
    keys = ["metric", "carrier_filter", "port_filter"]
    rows = _with_filters(metric_rows(marts))   # built once, read by both aggregates
    vals = governed_values(marts, rows).select(*keys, "value", "rows_used")  # adaptive execution checks their size
    sups = superlatives(marts, rows)
    cond_v = [r[k].eqNullSafe(vals[k]) for k in keys]
    j = r.join(vals, cond_v, "left").select(r["*"], vals["value"], vals["rows_used"])
    cond_s = [j[k].eqNullSafe(sups[k]) for k in keys]
    j = j.join(sups, cond_s, "left").select(j["*"], "best_entity", "best_value", "worst_entity", "worst_value", "all_values")
    sup_entity = F.when(F.col("superlative") == "best", F.col("best_entity")) \
        .when(F.col("superlative") == "worst", F.col("worst_entity"))
    sup_value = F.when(F.col("superlative") == "best", F.col("best_value")) \
        .when(F.col("superlative") == "worst", F.col("worst_value"))
    is_sup = F.col("metric").isNotNull() & sup_entity.isNotNull()
    is_val = F.col("metric").isNotNull() & ~is_sup & F.col("value").isNotNull()
    kind = F.when(is_sup, "superlative").when(is_val, "value").otherwise("refusal")
    out = j.select(
        "question_id", "metric", "carrier_filter", "port_filter", kind.alias("kind"),
        F.when(is_sup, sup_entity).alias("entity"),
        F.when(is_sup, sup_value).when(is_val, F.col("value")).alias("value"),
        F.when(is_sup | is_val, F.col("rows_used")).when(F.col("metric").isNotNull(), F.lit(0))
        .cast("bigint").alias("rows_used"), "all_values",
    )
    return _cited(out) if cite else out.drop("all_values")


def run_trend(run_rows: DataFrame, every: str = "1 hour") -> DataFrame:
    """Dashboard series from the append-only run table: per time bucket of
    ``run_ts``, the last value of each metric and the sum over runs."""
    g = run_rows.groupBy(F.window("run_ts", every).alias("w"), "metric", "label").agg(
        F.max_by("value", "run_ts").alias("last_value"), F.sum("value").alias("total"),
        F.count(F.lit(1)).alias("runs"))
    return g.select(F.col("w.start").alias("bucket_start"), "metric", "label", "last_value", "total", "runs")

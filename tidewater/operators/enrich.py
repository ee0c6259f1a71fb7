"""Port conditions: weather alerts, forecast and disruption news per port-day.

Two inputs are supported:

* landed payloads (``sources.weather``): per-date JSON documents keyed by port
  (alerts, daily forecast arrays) plus a list of news headlines;
* observation rows (``sources.feeds.supplier_conditions``): several
  observations per port-day, combined with an aggregate.

Headlines are matched to all port names in one pass, as a projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater import config
from tidewater.functions import phrases

CONDITION_COLUMNS = ["port", "date", "weather_alerts", "weather_code",
                     "wind_max_kmh", "precip_mm", "disruption_news"]


def headline_counts(headlines: DataFrame, text_col: str = "title", date_col: str | None = "date") -> DataFrame:
    """``port, [date,] disruption_news``: headlines whose lower-cased text
    contains the lower-cased port name.  All names are looked for in one pass
    over each whole text (``functions.phrases``), without a join.  With
    ``date_col=None`` the counts are per port only."""
    codes: dict[str, list[str]] = {}
    for code, name, *_ in config.PORTS:
        codes.setdefault(name.lower(), []).append(code)
    ports_of = F.create_map(*[x for name, held in codes.items() for x in (F.lit(name), F.array(*map(F.lit, held)))])
    ports = F.flatten(F.transform(phrases.found(F.lower(F.col(text_col)), list(codes)), lambda p: F.element_at(ports_of, p)))
    keys = ["port"] + (["date"] if date_col else [])
    matched = headlines.select(*([F.col(date_col).alias("date")] if date_col else []), F.explode(ports).alias("port"))
    return matched.groupBy(*keys).agg(F.count(F.lit(1)).alias("disruption_news"))


def conditions_from_payloads(alerts: DataFrame, forecast: DataFrame, headlines: DataFrame) -> DataFrame:
    """port_conditions from landed payloads.

    ``alerts``: ``date, port, n_alerts``; ``forecast``: ``date, port,
    weather_code, wind_max_kmh, precip_mm`` (first daily value, may be NULL);
    ``headlines``: ``date, title``.  Every configured port gets a row for each
    date present in any input; missing values become 0 / NULL."""
    dates = alerts.select("date").union(forecast.select("date")).union(headlines.select("date")).distinct()
    grid = dates.select("date", F.explode(F.array(*[F.lit(p) for p in config.PORT_CODES])).alias("port"))
    news = headline_counts(headlines)
    out = (grid.join(alerts, ["date", "port"], "left")
           .join(forecast, ["date", "port"], "left")
           .join(news, ["port", "date"], "left"))
    return out.select(
        "port", "date",
        F.coalesce(F.col("n_alerts"), F.lit(0)).cast("bigint").alias("weather_alerts"),
        F.col("weather_code").cast("string").alias("weather_code"),
        F.col("wind_max_kmh").cast("string").alias("wind_max_kmh"),
        F.col("precip_mm").cast("double").alias("precip_mm"),
        F.coalesce(F.col("disruption_news"), F.lit(0)).cast("bigint").alias("disruption_news"),
    )


def conditions_from_observations(obs: DataFrame) -> DataFrame:
    """port_conditions from observation rows: alerts, precipitation and news
    are summed, weather code and wind take the maximum, per (port, date)."""
    return obs.groupBy("port", "date").agg(
        F.sum("weather_alerts").cast("bigint").alias("weather_alerts"),
        F.max("weather_code").alias("weather_code"),
        F.max(F.col("wind_max_kmh").try_cast("double")).alias("wind_max_kmh"),
        F.sum("precip_mm").alias("precip_mm"),
        F.sum("disruption_news").cast("bigint").alias("disruption_news"),
    ).select(*CONDITION_COLUMNS)

"""Q1-Q6 straight from the cleaned inputs, with both join sides pre-aggregated.

Over the stored mart a question filters and counts rows. Computed from the
inputs, the same count is a sum of products: the filtered flights are reduced
to one row per five-minute key (and per airport for Q2) with a count, the
weather to one row per key and needed attributes with a count, and the join
multiplies the two. Partial aggregation runs map-side on both sides before
any shuffle, so the join sees at most keys x groups rows, a key holding a
large share of the flights collapses to one row per partition, and no flight x
observation pair is ever formed. The result equals the mart count exactly
(checked against the SQL oracle, which counts the expanded rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windshear.config import COMPASS, WIND_BOUNDS, HubConfig
from windshear.functions.times import day_bounds
from windshear.functions.labels import interruption_class
from windshear.functions.wind import has_wind_bin, weather_delayed
from windshear.operators.filters import delayed_15, exclude_airport, not_null, time_window, weather_cancelled
from windshear.operators.joins import WEIGHT
from windshear.operators.projections import flight_side_projection, role_columns
from windshear.operators.reshape import bars_long, interruption_matrix
from windshear.plans import etl
from windshear.plans.queries import (
    Bound,
    bound,
    delay_count_keys,
    finish_delay_count,
    finish_wind_rose,
)


def question_inputs(flights_raw: DataFrame, weather_raw: DataFrame, airports_raw: DataFrame,
                    zones_raw: DataFrame, cfg: HubConfig) -> tuple[DataFrame, DataFrame]:
    """(flights with the mart's flight columns and the grid key, cleaned weather)."""
    flights = etl.localise_flights(etl.clean_flights(flights_raw, cfg), airports_raw, zones_raw, cfg)
    diverted_iata = F.col("diverted").cast("string").alias("diverted_iata")
    return flight_side_projection(flights, diverted_iata), etl.prepared_weather(weather_raw, cfg)


def _n(name: str):
    return F.count(F.lit(1)).alias(name)


def wind_rose(flights: DataFrame, weather: DataFrame, direction: str, lo: Bound, hi: Bound,
              compass: Sequence[str] = COMPASS, bounds: Sequence[float] = WIND_BOUNDS) -> DataFrame:
    """Q1 from the inputs. ``bounds`` must be the bins the weather was cleaned with."""
    c = role_columns(direction)
    f = (flights.where(time_window(c.time, bound(lo), bound(hi)) & delayed_15(c.del15) & not_null(c.time))
         .groupBy("time_interval").agg(_n("n_f")))
    # "has a bin" is tested on the speed, not on the bin label: the filter is
    # pushed into the weather scan and would otherwise inline the whole bin chain.
    w = (weather.where(not_null("card_dir") & has_wind_bin("wind_speed", bounds))
         .groupBy("time_interval", "card_dir", "binned_wind").agg(_n("n_w")))
    pairs = f.join(w, on="time_interval").select(
        "card_dir", "binned_wind", (F.col("n_f") * F.col("n_w")).alias(WEIGHT))
    counts = pairs.groupBy("card_dir", "binned_wind").agg(F.sum(WEIGHT).alias("count"))
    return finish_wind_rose(counts, compass)


def airport_delay_count(flights: DataFrame, weather: DataFrame, direction: str, lo: Bound, hi: Bound,
                        *, counterpart: bool = False) -> DataFrame:
    """Q2 from the inputs. A flight with no weather row counts once (left join)."""
    c, key = delay_count_keys(direction, counterpart=counterpart)
    pred = time_window(c.time, bound(lo), bound(hi)) & not_null(c.time) & delayed_15(c.del15)
    if counterpart:
        pred = pred & (F.col("dep_or_arr") == direction)
    keys = [key.iata, key.long, key.lat]
    f = flights.where(pred).groupBy("time_interval", *keys).agg(_n("n_f"))
    w = weather.groupBy("time_interval").agg(_n("n_w"))
    pairs = f.join(w, on="time_interval", how="left").select(
        *keys, (F.col("n_f") * F.coalesce(F.col("n_w"), F.lit(1).cast("long"))).alias(WEIGHT))
    counts = pairs.groupBy(*keys).agg(F.sum(WEIGHT).alias(c.del15))
    return finish_delay_count(counts, direction, counterpart=counterpart)


def crosswind_interruptions(flights: DataFrame, weather: DataFrame, direction: str,
                            lo: Bound, hi: Bound) -> DataFrame:
    """Q3 from the inputs: four sums of (flights x observations) in one aggregate."""
    c = role_columns(direction)
    delayed, cancelled = weather_delayed("wthr_code"), weather_cancelled()
    f = (flights.where(time_window(c.time, bound(lo), bound(hi)) & (delayed | cancelled))
         .groupBy("time_interval")
         .agg(F.count_if(delayed).alias("n_delay"), F.count_if(cancelled).alias("n_cncl")))
    # Only classes 1 and 2 are summed; filtering first keeps the join small
    # (the class expression is cheap enough to evaluate in the pushed filter).
    w = (weather.where(F.col("crosswind_lim").isin(1, 2))
         .groupBy("time_interval", "crosswind_lim").agg(_n("n_w")))
    pairs = f.join(w, on="time_interval").select(
        "crosswind_lim", (F.col("n_delay") * F.col("n_w")).alias("delays"),
        (F.col("n_cncl") * F.col("n_w")).alias("cancels"))
    lim = F.col("crosswind_lim")
    counts = pairs.agg(
        *[F.coalesce(F.sum(F.when(lim == k, F.col(col))), F.lit(0).cast("long")).alias(name)
          for name, k, col in (("dry_delay", 1, "delays"), ("wet_delay", 2, "delays"),
                               ("dry_cncl", 1, "cancels"), ("wet_cncl", 2, "cancels"))])
    return interruption_matrix(counts)


def interruption_classes(flights: DataFrame, weather: DataFrame, lim_condition, name: str) -> DataFrame:
    """C15-C17 counted over mart rows, from the inputs: ``name, n``.

    The class of each flight over the limit is computed first, and flights are
    grouped per key by it (five values and NULL, however many texts the fields hold); weather is
    grouped per key by whether it is over the limit. The joined groups weigh
    the product of their counts; below the limit, and without weather, the class is NULL.
    """
    f = flights.groupBy("time_interval", interruption_class(F.lit(True)).alias("_class")).agg(_n("n_f"))
    w = weather.groupBy("time_interval", F.coalesce(lim_condition, F.lit(False)).alias("_over")).agg(_n("n_w"))
    pairs = f.join(w, on="time_interval", how="left")
    weight = F.col("n_f") * F.coalesce(F.col("n_w"), F.lit(1).cast("long"))
    return pairs.groupBy(F.when(F.col("_over"), F.col("_class")).alias(name)).agg(F.sum(weight).alias("n"))


def delay_map(flights: DataFrame, weather: DataFrame, hub: str, direction: str, start, end, *,
              inclusive_end: bool = False) -> DataFrame:
    """Q4 from the inputs."""
    lo, hi = day_bounds(start, end, inclusive_end=inclusive_end)
    return exclude_airport(airport_delay_count(flights, weather, direction, lo, hi),
                           role_columns(direction).iata, hub)


def interruption_bars(flights: DataFrame, weather: DataFrame, direction: str, start, end, *,
                      inclusive_end: bool = False) -> DataFrame:
    """Q5 from the inputs."""
    lo, hi = day_bounds(start, end, inclusive_end=inclusive_end)
    return bars_long(crosswind_interruptions(flights, weather, direction, lo, hi))


def wind_rose_days(flights: DataFrame, weather: DataFrame, direction: str, start, end, *,
                   inclusive_end: bool = False, bounds: Sequence[float] = WIND_BOUNDS) -> DataFrame:
    """Q6 from the inputs."""
    lo, hi = day_bounds(start, end, inclusive_end=inclusive_end)
    return wind_rose(flights, weather, direction, lo, hi, bounds=bounds)


__all__ = ["question_inputs", "wind_rose", "airport_delay_count", "crosswind_interruptions",
           "delay_map", "interruption_bars", "wind_rose_days", "interruption_classes"]

"""Local time, holiday calendar and expected hourly order volume."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.constants import (BASE_ORDERS_PER_REGION_PER_HOUR, DOW_MULTIPLIERS, FIXED_HOLIDAY_DATES,
                                  GOLDEN_WEEK_DAYS, GOLDEN_WEEK_FIRST, GOLDEN_WEEK_REGION, GOLDEN_WEEK_START,
                                  GOLDEN_WEEK_STEP, HOLIDAY_GROUP, HOLIDAY_MULTIPLIERS, INTRADAY_MULTIPLIERS,
                                  MONTHLY_MULTIPLIERS, REGION_UTC_OFFSETS, REGIONS, VOLUME_NOISE_PCT)
from marketlens.functions.calendar import last_weekday, nth_weekday
from marketlens.functions.scalars import hour_floor, lookup, to_local


def with_local_time(df: DataFrame, ts: str = "created_at", region: str = "region") -> DataFrame:
    """Local wall-clock time from a naive UTC timestamp and the region's fixed offset."""
    offset = lookup(region, REGION_UTC_OFFSETS)
    local = to_local(F.col(ts), offset)
    return df.select("*", offset.alias("utc_offset"), local.alias("local_ts"),
                     F.to_date(local).alias("local_date"), F.hour(local).alias("local_hour"))


def _holiday_date(name: str, year: Column) -> Column:
    if name == "thanksgiving":
        return nth_weekday(year, 11, 3, 4)
    if name == "black_friday":
        return F.date_add(nth_weekday(year, 11, 3, 4), 1)
    if name == "cyber_monday":
        return F.date_add(nth_weekday(year, 11, 3, 4), 4)
    if name == "memorial_day":
        return last_weekday(year, 5, 0)
    if name == "labor_day":
        return nth_weekday(year, 9, 0, 1)
    m, d = FIXED_HOLIDAY_DATES[name]
    return F.make_date(year, F.lit(m), F.lit(d))


def holiday_entries(year: Column) -> Column:
    """array<struct<region, holiday_name, holiday_date, multiplier>> for one year."""
    entries = []
    for region in REGIONS:
        for name, mult in HOLIDAY_MULTIPLIERS[HOLIDAY_GROUP[region]].items():
            entries.append(F.struct(F.lit(region).alias("region"), F.lit(name).alias("holiday_name"),
                                    _holiday_date(name, year).alias("holiday_date"),
                                    F.lit(float(mult)).alias("multiplier")))
        if region == GOLDEN_WEEK_REGION:
            m, d = GOLDEN_WEEK_START
            start = F.make_date(year, F.lit(m), F.lit(d))
            for i in range(GOLDEN_WEEK_DAYS):
                entries.append(F.struct(F.lit(region).alias("region"),
                                        F.lit(f"golden_week_{i + 1}").alias("holiday_name"),
                                        F.date_add(start, i).alias("holiday_date"),
                                        F.lit(GOLDEN_WEEK_FIRST + GOLDEN_WEEK_STEP * i).alias("multiplier")))
    return F.array(*entries)


def holiday_calendar(years: DataFrame, year_col: str = "year") -> DataFrame:
    """One row per (region, holiday date) for every year in ``years``.

    Dates come from calendar rules evaluated as column expressions, so the
    calendar is derived from the data's own years (53 rows per year).
    """
    e = years.select(F.col(year_col).cast("int").alias("year")).distinct().select(
        "year", F.explode(holiday_entries(F.col("year"))).alias("h"))
    return e.select("year", "h.region", "h.holiday_name", "h.holiday_date", "h.multiplier")


def years_of(df: DataFrame, ts: str = "created_at") -> DataFrame:
    """Local-calendar years a UTC timestamp column can fall in (offsets may cross New Year)."""
    y = df.select(F.year(ts).alias("y")).distinct()
    return y.select(F.explode(F.array(F.col("y") - 1, F.col("y"), F.col("y") + 1)).alias("year")).distinct()


def expected_volume(hours: DataFrame, calendar: DataFrame, ts: str = "hour_ts",
                    local_calendar: bool = False) -> DataFrame:
    """Expected orders per (region, UTC hour) before noise, with the +/-15% band.

    base x intraday[local hour] x weekday x month x holiday[region, local
    date] (1.0 when none). Weekday and month are taken from the UTC time, as
    the volume model computes them; ``local_calendar=True`` takes them from
    the local time instead (the model's documented intent). Multipliers are
    literal arrays indexed inline. A region without a local time has no
    expectation: it stays, with NULLs.
    """
    h = with_local_time(hours, ts=ts)
    cal_ts = F.col("local_ts") if local_calendar else F.col(ts)
    intraday = F.try_element_at(F.array(*[F.lit(x) for x in INTRADAY_MULTIPLIERS]), F.col("local_hour") + 1)
    dow = F.try_element_at(F.array(*[F.lit(x) for x in DOW_MULTIPLIERS]), F.weekday(cal_ts) + 1)
    month = F.try_element_at(F.array(*[F.lit(x) for x in MONTHLY_MULTIPLIERS]), F.month(cal_ts))
    cal = calendar.groupBy("region", "holiday_date").agg(F.max("multiplier").alias("holiday"))
    j = h.join(cal, (h.region == cal.region) & (h.local_date == cal.holiday_date), "left").drop(cal.region)
    holiday = F.coalesce(F.col("holiday"), F.lit(1.0))
    expected = F.lit(float(BASE_ORDERS_PER_REGION_PER_HOUR)) * intraday * dow * month * holiday
    band = VOLUME_NOISE_PCT / 100.0
    keep = [c for c in hours.columns]
    return j.select(
        *keep, "local_ts", "local_hour",
        intraday.alias("intraday_multiplier"), dow.alias("dow_multiplier"), month.alias("monthly_multiplier"),
        holiday.alias("holiday_multiplier"), expected.alias("expected_orders"),
        (expected * (1 - band)).alias("lower_bound"), (expected * (1 + band)).alias("upper_bound"),
    )


def hourly_actuals(orders: DataFrame, regions=REGIONS, since: str | None = None, until: str | None = None) -> DataFrame:
    """Orders per (region, UTC hour): every hour of each day and every region, zero-filled.

    Days are those with orders, or ``since`` to ``until`` ("yyyy-MM-dd", both included), which also reports days
    without any. Regions are the given ones and all others that the orders have, NULL included. The grid grows with
    days and regions, not with orders or with the distance of a stray timestamp.
    """
    hour_ts = hour_floor("created_at")
    counts = orders.groupBy("region", hour_ts.alias("hour_ts")).agg(F.count(F.lit(1)).alias("actual_orders"))
    if since is not None and until is not None:
        days = orders.sparkSession.range(1).select(F.explode(F.sequence(
            F.lit(since).cast("date"), F.lit(until).cast("date"))).alias("day"))
    else:
        days = counts.filter(F.col("hour_ts").isNotNull()).select(F.to_date("hour_ts").alias("day")).distinct()
    listed = F.explode(F.array(*[F.lit(r) for r in regions])).alias("region")
    hours = F.explode(F.transform(F.sequence(F.lit(0), F.lit(23)),
                                  lambda h: F.col("day").cast("timestamp_ntz") + F.make_dt_interval(hours=h))).alias("hour_ts")
    # other regions get the hours of the days on which they have orders
    other = counts.filter(~F.coalesce(F.col("region").isin(list(regions)), F.lit(False)) & F.col("hour_ts").isNotNull())
    other = other.select(F.to_date("hour_ts").alias("day"), "region").distinct()
    if since is not None and until is not None:
        other = other.filter(F.col("day").between(F.lit(since).cast("date"), F.lit(until).cast("date")))
    grid = days.select("day", listed).unionByName(other).select("region", hours)
    zero = grid.withColumn("actual_orders", F.lit(0).cast("long"))
    inside = counts.filter(F.col("hour_ts").isNotNull())
    if since is not None and until is not None:
        inside = inside.filter(F.to_date("hour_ts").between(F.lit(since).cast("date"), F.lit(until).cast("date")))
    return zero.unionByName(inside).groupBy("region", "hour_ts").agg(F.sum("actual_orders").alias("actual_orders"))


def volume_anomaly(actuals: DataFrame, calendar: DataFrame, slack: float = 0.5,
                   local_calendar: bool = False) -> DataFrame:
    """Every (region, hour) with its band test: outside the expected band widened by ``slack`` orders.

    The slack absorbs rounding to whole orders. A region without an expectation is reported with
    ``has_baseline`` false and no verdict.
    """
    e = expected_volume(actuals, calendar, local_calendar=local_calendar)
    return e.select(
        "region", "hour_ts", "local_hour", "actual_orders", "expected_orders", "lower_bound", "upper_bound",
        ((F.col("actual_orders") < F.col("lower_bound") - slack)
         | (F.col("actual_orders") > F.col("upper_bound") + slack)).alias("is_anomaly"),
        (F.col("actual_orders") / F.col("expected_orders") - 1).alias("deviation"),
        F.col("expected_orders").isNotNull().alias("has_baseline"),
    )

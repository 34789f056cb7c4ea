"""Date and time dimensions (G1, G2), generated from a range with
``sequence`` + ``explode``; every column is a built-in date expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _suffix(day: Column) -> Column:
    return (F.when(day.isin(11, 12, 13), F.lit("th")).when(day % 10 == 1, F.lit("st"))
            .when(day % 10 == 2, F.lit("nd")).when(day % 10 == 3, F.lit("rd")).otherwise(F.lit("th")))


def _us_week(d: Column) -> Column:
    """US week: weeks start Sunday, week 1 holds January 1."""
    jan1 = F.trunc(d, "year")
    return (F.floor((F.dayofyear(d) + F.dayofweek(jan1) - 2) / 7) + 1)


def dim_dates_from(dates: DataFrame, col: str = "the_date") -> DataFrame:
    """G1: 35 columns for each date of ``dates`` (one column of DateType)."""
    d = F.col(col)
    iso_dow = F.extract(F.lit("DAYOFWEEK_ISO"), d)
    week = _us_week(d)
    eoy = F.last_day(F.add_months(F.trunc(d, "year"), 11))
    base = dates.select(d.alias("the_date")).withColumn("_w", week.cast("smallint"))
    d = F.col("the_date")
    wm = Window.partitionBy(F.year(d), F.month(d)).orderBy("_w")
    fq = F.trunc(d, "quarter")
    return base.select(
        d.alias("date_key"), d.alias("the_date"),
        F.dayofmonth(d).cast("smallint").alias("the_day"),
        _suffix(F.dayofmonth(d)).alias("the_day_suffix"),
        F.date_format(d, "EEEE").alias("the_day_name"),
        iso_dow.cast("smallint").alias("the_day_of_week"),
        (F.floor((F.dayofmonth(d) - 1) / 7) + 1).cast("smallint").alias("the_day_of_week_in_month"),
        F.dayofyear(d).cast("smallint").alias("the_day_of_year"),
        (iso_dow >= 6).alias("is_weekend"),
        F.col("_w").alias("the_week"),
        F.weekofyear(d).cast("smallint").alias("the_iso_week"),
        F.date_sub(d, (iso_dow - 1).cast("int")).alias("the_first_of_week"),
        F.date_add(d, (7 - iso_dow).cast("int")).alias("the_last_of_week"),
        F.dense_rank().over(wm).cast("smallint").alias("the_week_of_month"),
        F.month(d).cast("smallint").alias("the_month"),
        F.date_format(d, "MMMM").alias("the_month_name"),
        F.trunc(d, "month").alias("the_first_of_month"),
        F.last_day(d).alias("the_last_of_month"),
        F.add_months(F.trunc(d, "month"), 1).alias("the_first_of_next_month"),
        F.last_day(F.add_months(F.trunc(d, "month"), 1)).alias("the_last_of_next_month"),
        F.quarter(d).cast("smallint").alias("the_quarter"),
        fq.alias("the_first_of_quarter"),
        F.last_day(F.add_months(fq, 2)).alias("the_last_of_quarter"),
        F.year(d).cast("smallint").alias("the_year"),
        F.year(F.date_add(d, (4 - iso_dow).cast("int"))).cast("smallint").alias("the_iso_year"),
        F.trunc(d, "year").alias("the_first_of_year"),
        eoy.alias("the_last_of_year"),
        (F.dayofyear(eoy) == 366).alias("is_leap_year"),
        (_us_week(eoy) >= 53).alias("has_53_weeks"),
        (F.weekofyear(F.make_date(F.year(d), F.lit(12), F.lit(28))) == 53).alias("has_53_iso_weeks"),
        F.date_format(d, "MMyyyy").alias("mmyyyy"),
        F.date_format(d, "MM/dd/yyyy").alias("style_101"),
        F.date_format(d, "dd/MM/yyyy").alias("style_103"),
        F.date_format(d, "yyyyMMdd").alias("style_112"),
        F.date_format(d, "yyyy-MM-dd").alias("style_120"))


def date_span(df: DataFrame, col: str) -> DataFrame:
    """Every calendar date from the earliest to the latest value of ``col``."""
    return (df.agg(F.min(F.to_date(col)).alias("lo"), F.max(F.to_date(col)).alias("hi"))
              .select(F.explode(F.sequence("lo", "hi")).alias("the_date")))


def dim_dates(spark, start: str = "2020-01-01", end: str = "2035-12-31") -> DataFrame:
    """The reference's fixed range (5,844 rows)."""
    r = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date")))
                              .alias("the_date"))
    return dim_dates_from(r)


# Portion-of-day buckets by hour (inclusive start hour).
PORTIONS = [(0, "overnight"), (5, "early_morning"), (8, "morning"), (11, "late_morning"), (12, "noon"),
            (13, "afternoon"), (17, "evening"), (20, "night")]


def dim_times_from(minutes: DataFrame, col: str = "minute_of_day") -> DataFrame:
    """10 columns per minute of day.  ``the_time`` is HH:mm:00 text
    (the TIME type is off by default in this Spark version)."""
    m = F.col(col)
    h = F.floor(m / 60)
    mi = m % 60
    h12 = F.when(h % 12 == 0, F.lit(12)).otherwise(h % 12)
    portion = None
    for start, name in reversed(PORTIONS):
        portion = F.when(h >= start, F.lit(name)) if portion is None else portion.when(h >= start, F.lit(name))
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    ampm = F.when(h < 12, F.lit("AM")).otherwise(F.lit("PM"))
    return minutes.select(
        m.cast("smallint").alias("time_key"),
        F.concat(two(h), F.lit(":"), two(mi), F.lit(":00")).alias("the_time"),
        h.cast("smallint").alias("the_hour"), mi.cast("smallint").alias("the_minute"),
        m.cast("smallint").alias("the_minute_of_day"), h12.cast("smallint").alias("the_hour_12"),
        ampm.alias("am_pm"), portion.alias("portion_of_day"),
        F.concat(two(h), F.lit(":"), two(mi)).alias("style_hhmm"),
        F.concat(two(h12), F.lit(":"), two(mi), F.lit(" "), ampm).alias("style_hhmm_12"))


def minute_span(df: DataFrame, col: str) -> DataFrame:
    """Every minute of day from the earliest to the latest observed one."""
    mod = F.hour(col) * 60 + F.minute(col)
    return (df.agg(F.min(mod).alias("lo"), F.max(mod).alias("hi"))
              .select(F.explode(F.sequence("lo", "hi")).alias("minute_of_day")))

"""The four dimensions: calendar, departments, items and versioned vendors."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.functions.text import pick, replace_first, zero_filled
from ledgerlane.functions.dates import year_month
from ledgerlane.schemas import BUDGET_TIERS, DAYS_ID, DAYS_SHORT_ID, MONTHS_ID

# Span of the calendar.
CALENDAR_START, CALENDAR_END = date(2018, 1, 1), date(2027, 12, 31)

# How a vendor looked before the change its history stands for.
HISTORY_BEFORE = date(2021, 1, 1)
HISTORY_ENDS = date(2021, 12, 31)
HISTORY_EVERY = 3
FORMER_CITY, FORMER_PROVINCE, FORMER_TERMS = "Jakarta Pusat", "DKI Jakarta", "Net 60"
FORMER_SUFFIX = " (Versi Lama)"
COMPANY_FORM = r" (?:Tbk\.?|PT )"


def surrogate_key(*parts: Column) -> Column:
    """MD5 of the parts joined by ``|``; NULL when any part is."""
    texts = [part.cast("string") for part in parts]
    joined = texts[0]
    for text in texts[1:]:
        joined = F.concat(joined, F.lit("|"), text)
    return F.md5(joined)


def date_spine(spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END
               ) -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("full_date"))


def calendar(spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END
             ) -> DataFrame:
    day = F.col("full_date")
    year, quarter, month = F.year(day), F.quarter(day), F.month(day)
    iso_year, week = F.extract(F.lit("YEAROFWEEK"), day), F.weekofyear(day)
    sunday_first, monday_first = F.dayofweek(day), F.weekday(day)
    weekend = sunday_first.isin(1, 7)
    quarter_end = F.date_sub(F.add_months(F.trunc(day, "quarter"), 3), 1)
    year_end = F.date_sub(F.add_months(F.trunc(day, "year"), 12), 1)
    return date_spine(spark, start, end).select(
        (year * 10000 + month * 100 + F.dayofmonth(day)).alias("date_key"),
        "full_date",
        # the month name is padded to nine characters, as the report format has it
        F.concat(F.date_format(day, "dd"), F.lit(" "),
                 F.rpad(F.date_format(day, "MMMM"), 9, " "), F.lit(" "),
                 F.date_format(day, "yyyy")).alias("date_label"),
        year.alias("year"),
        iso_year.alias("iso_year"),
        quarter.alias("quarter_number"),
        F.concat(F.lit("Q"), quarter).alias("quarter_label"),
        F.concat(year, F.lit("-Q"), quarter).alias("year_quarter"),
        month.alias("month_number"),
        F.date_format(day, "MMM").alias("month_short_en"),
        pick(month - 1, MONTHS_ID).alias("month_name_id"),
        year_month(day).alias("year_month"),
        week.alias("week_of_year"),
        F.concat(iso_year, F.lit("-W"), zero_filled(week, 2)).alias("year_week"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        (sunday_first - 1).alias("day_of_week_sun0"),
        (monday_first + 1).alias("day_of_week_iso"),
        pick(monday_first, DAYS_ID).alias("day_name_id"),
        pick(monday_first, DAYS_SHORT_ID).alias("day_short_id"),
        weekend.alias("is_weekend"),
        (~weekend).alias("is_weekday"),
        (day == F.trunc(day, "month")).alias("is_first_day_of_month"),
        (day == F.last_day(day)).alias("is_last_day_of_month"),
        (day == quarter_end).alias("is_last_day_of_quarter"),
        (day == F.trunc(day, "year")).alias("is_first_day_of_year"),
        (day == year_end).alias("is_last_day_of_year"),
        year.alias("fiscal_year"),
        quarter.alias("fiscal_quarter"),
        month.alias("fiscal_month"),
    )


def departments(staged: DataFrame) -> DataFrame:
    """Never changes once loaded (slowly changing type 0)."""
    budget = F.col("budget_annual_idr")
    large, medium, small = BUDGET_TIERS
    return staged.select(
        surrogate_key(F.col("department_id")).alias("department_sk"),
        "department_id",
        "department_code",
        "department_name",
        "cost_center",
        "location",
        "manager_name",
        "budget_annual_idr",
        F.when(budget >= 5_000_000_000, large).when(budget >= 1_000_000_000, medium)
        .otherwise(small).alias("budget_tier"),
        "created_at",
        "loaded_at",
    )


def items(staged: DataFrame) -> DataFrame:
    """Overwritten on change (slowly changing type 1)."""
    return staged.select(
        surrogate_key(F.col("item_id")).alias("item_sk"),
        "item_id",
        "item_code",
        "item_name",
        "item_category",
        "unit_of_measure",
        F.col("unit_price_idr").alias("current_unit_price_idr"),
        "price_tier",
        "min_order_qty",
        F.col("lead_time_days").alias("standard_lead_time_days"),
        "is_fast_moving",
        "is_active",
        "created_at",
        F.col("loaded_at").alias("last_updated_at"),
    )


VENDOR_COLUMNS = (
    "vendor_sk", "dbt_valid_from", "dbt_valid_to", "is_current_record", "record_version",
    "vendor_id", "vendor_name", "city", "province", "payment_terms", "vendor_code",
    "vendor_category", "vendor_type", "address", "postal_code", "phone", "email", "npwp",
    "vendor_rating", "is_active", "is_goods_vendor", "is_service_vendor", "registered_date",
    "created_at",
)


def _has_history() -> Column:
    old = F.col("registered_date") < F.lit(HISTORY_BEFORE)
    return old & (F.col("vendor_id") % HISTORY_EVERY == 0)


def vendor_history(staged: DataFrame) -> DataFrame:
    """The closed first version of every vendor that has one."""
    return staged.filter(_has_history()).withColumns({
        "vendor_name": F.concat(
            replace_first(F.col("vendor_name"), COMPANY_FORM, " "), F.lit(FORMER_SUFFIX)
        ),
        "city": F.lit(FORMER_CITY),
        "province": F.lit(FORMER_PROVINCE),
        "payment_terms": F.lit(FORMER_TERMS),
        "dbt_valid_from": F.col("registered_date"),
        "dbt_valid_to": F.lit(HISTORY_ENDS),
        "is_current_record": F.lit(False),
        "record_version": F.lit(1),
    })


def vendor_current(staged: DataFrame) -> DataFrame:
    """The open version of every vendor."""
    changed = F.coalesce(_has_history(), F.lit(False))
    return staged.withColumns({
        "dbt_valid_from": F.when(changed, F.date_add(F.lit(HISTORY_ENDS), 1))
        .otherwise(F.col("registered_date")),
        "dbt_valid_to": F.lit(None).cast("date"),
        "is_current_record": F.lit(True),
        "record_version": F.when(changed, 2).otherwise(1),
    })


def vendors(staged: DataFrame) -> DataFrame:
    """All versions of all vendors (slowly changing type 2)."""
    versions = vendor_history(staged).unionByName(vendor_current(staged))
    keyed = versions.withColumn(
        "vendor_sk", surrogate_key(F.col("vendor_id"), F.col("dbt_valid_from"))
    )
    return keyed.select(*VENDOR_COLUMNS)

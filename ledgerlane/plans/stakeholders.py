"""Reports by audience: purchasing managers, finance, operations and warehouse staff.

None counts cancelled lines. Ties at a row limit are settled by the group key. Windows run over
grouped rows whose number per partition is bounded by the months or quarters of the calendar.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlane.functions.dates import days_between, year_month
from ledgerlane.functions.numeric import at_least, deviations, in_units, percent, ratio, square, value_of
from ledgerlane.operators.rollup import Lookup, flag, grouped, hundredths, present
from ledgerlane.plans.reports import BILLION, average, not_cancelled
from ledgerlane.plans.warehouse import Marts
from ledgerlane.schemas import MONEY

MONTHLY, QUARTERLY = "Bulanan", "Kuartalan"
NO_RECEIPT = "Belum Ada GR"

# Days until an invoice falls due, by payment terms.
DUE_DAYS = {"COD": 0, "DP 50%": 15, "Net 15": 15, "Net 30": 30, "Net 45": 45, "Net 60": 60}
OTHER_DUE_DAYS = 30

# Supplier dependence.
SINGLE_SOURCE, HIGH_RISK, MEDIUM_RISK, SPREAD = (
    "Single Source", "Risiko Tinggi", "Risiko Sedang", "Tersebar",
)

def _line() -> Column:
    return F.lit(1)


def _net() -> Column:
    return F.col("net_total_ordered_idr")


def _received_value() -> Column:
    return F.col("net_total_received_idr")


def _billions(column: str, name: str) -> Column:
    return in_units(F.col(column), BILLION).alias(name)


def _received(m: Marts) -> DataFrame:
    return not_cancelled(m.fact).filter("has_goods_receipt")


def _items(m: Marts, *attributes: str) -> Lookup:
    return Lookup(m.items, "item_sk", attributes)


def _vendors(m: Marts, *attributes: str) -> Lookup:
    return Lookup(m.vendors, "vendor_sk", attributes)


def _departments(m: Marts, *attributes: str) -> Lookup:
    return Lookup(m.departments, "department_sk", attributes)


def _quarters(m: Marts) -> Lookup:
    """The calendar's size is fixed by its end dates."""
    dates = m.dates.withColumnRenamed("date_key", "date_key_po_date")
    return Lookup(dates, "date_key_po_date", ["year_quarter"], bounded=True)


def value_by_period(m: Marts, limit: int = 12) -> DataFrame:
    """Months and quarters from one scan: each order counts in its month and in its quarter.

    An order dated outside the calendar has no quarter and counts in its month alone.
    """
    orders = not_cancelled(m.fact).groupBy("po_year_month", "date_key_po_date", "po_id").agg(
        F.count("po_line_id").alias("lines"),
        F.sum(_net()).alias("net"),
        F.sum("discount_amount_idr").alias("discount"),
    )
    dated = orders.join(_quarters(m).columns(), "date_key_po_date", "left")

    def period(kind: str, column: str) -> Column:
        return F.struct(F.lit(kind).alias("tipe_periode"), F.col(column).alias("periode"))

    month, quarter = period(MONTHLY, "po_year_month"), period(QUARTERLY, "year_quarter")
    periods = F.when(F.col("year_quarter").isNull(), F.array(month)).otherwise(
        F.array(month, quarter)
    )
    return (
        dated.select("po_id", "lines", "net", "discount", F.explode(periods).alias("p"))
        .select("*", "p.*")
        .groupBy("tipe_periode", "periode")
        .agg(
            F.countDistinct("po_id").alias("jumlah_po"),
            F.sum("lines").alias("jumlah_line"),
            F.sum("net").alias("net"),
            F.sum("discount").alias("discount"),
        )
        .orderBy(F.desc("periode"), "tipe_periode")
        .limit(limit)
        .select(
            "tipe_periode", "periode", "jumlah_po", "jumlah_line",
            _billions("net", "total_neto_miliar_idr"),
            _billions("discount", "total_diskon_miliar_idr"),
        )
    )


def top_vendors_latest_year(m: Marts, limit: int = 10) -> DataFrame:
    """The latest year is a scalar subquery on the partition column, so only its files are read."""
    fact = not_cancelled(m.fact)
    latest = fact.agg(F.max("po_year")).scalar()
    totals = grouped(
        fact.filter(F.col("po_year") == latest), ["po_year"],
        [_vendors(m, "vendor_name", "vendor_category")],
        {
            "lines": present("po_line_id"),
            "net": _net(),
            "fulfilled_pct": hundredths("fulfillment_pct"),
        },
        distinct=["po_id"],
        distinct_by_key=True,
    )
    return totals.orderBy(F.desc("net"), "vendor_name", "vendor_category").limit(limit).select(
        F.col("po_year").alias("tahun"), "vendor_name", "vendor_category",
        F.col("n_po_id").alias("jumlah_po"), F.col("lines").alias("jumlah_line"),
        _billions("net", "total_neto_miliar_idr"),
        average("fulfilled_pct", "lines", 1, scale=2).alias("avg_fulfillment_pct"),
    )


def order_to_receipt_days(m: Marts) -> DataFrame:
    days = {
        "expected": "expected_lead_time_days",
        "actual": "actual_lead_time_days",
        "variance": "lead_time_variance_days",
    }
    totals = grouped(
        _received(m), [], [_items(m, "item_category")],
        {
            "lines": _line(),
            "on_time": flag(F.col("is_on_time")),
            **{name: F.col(column) for name, column in days.items()},
            **{f"n_{name}": present(column) for name, column in days.items()},
        },
    )
    return totals.orderBy(
        F.desc_nulls_first(F.col("actual") / F.nullif(F.col("n_actual"), F.lit(0))),
        "item_category",
    ).select(
        "item_category",
        F.col("lines").alias("jumlah_line_gr"),
        *[average(name, f"n_{name}", 1).alias(f"avg_{name}_days") for name in days],
        percent(F.col("on_time"), F.col("lines"), 1).alias("pct_on_time"),
    )


def timeliness_split(m: Marts) -> DataFrame:
    """The share window sees one row per timeliness label."""
    label = F.coalesce("delivery_timeliness", F.lit(NO_RECEIPT)).alias("status_ketepatan")
    totals = not_cancelled(m.fact).groupBy(label).agg(
        F.count(_line()).alias("jumlah_line"), F.sum(_net()).alias("net")
    )
    everything = F.sum("jumlah_line").over(Window.partitionBy())
    return totals.select(
        "status_ketepatan",
        "jumlah_line",
        percent(F.col("jumlah_line"), everything, 1).alias("pct_dari_total"),
        _billions("net", "total_neto_miliar_idr"),
    ).orderBy(F.desc("jumlah_line"), "status_ketepatan")


def price_rises(m: Marts, limit: int = 10) -> DataFrame:
    """Each month is compared with the category's last month that has lines."""
    now, before = F.col("avg_net_unit_price_idr"), F.col("prev_avg_net_unit_price_idr")
    months = grouped(
        not_cancelled(m.fact), ["po_year_month"], [_items(m, "item_category")],
        {
            "jumlah_line": _line(),
            "price": F.col("net_unit_price_idr"),
            "priced": present("net_unit_price_idr"),
        },
    ).withColumn("avg_net_unit_price_idr", average("price", "priced", 0))
    line = Window.partitionBy("item_category").orderBy("po_year_month")
    compared = months.withColumn(
        "prev_avg_net_unit_price_idr", F.lag("avg_net_unit_price_idr").over(line)
    )
    return compared.filter(now > before).select(
        F.col("po_year_month").alias("tahun_bulan"), "item_category",
        "prev_avg_net_unit_price_idr", "avg_net_unit_price_idr",
        percent(now - before, before, 1).alias("pct_kenaikan_harga"), "jumlah_line",
    ).orderBy(F.desc_nulls_last("pct_kenaikan_harga"), "tahun_bulan", "item_category").limit(limit)


def actual_against_budget(m: Marts, limit: int = 15) -> DataFrame:
    """The monthly budget is a twelfth of the year's; the twelfth is taken inside the ratios."""
    budget = F.col("budget_annual_idr")
    totals = grouped(
        not_cancelled(m.fact), ["po_year_month"],
        [_departments(m, "department_name", "budget_annual_idr")],
        {"actual": _received_value()},
    )
    return totals.orderBy(
        F.desc("po_year_month"), F.desc("actual"), "department_name", "budget_annual_idr"
    ).limit(limit).select(
        F.col("po_year_month").alias("tahun_bulan"), "department_name",
        _billions("actual", "actual_miliar_idr"),
        ratio(budget, F.lit(12 * 10**BILLION), 2).alias("budget_proxy_miliar_idr"),
        percent(F.col("actual") * 12, budget, 1).alias("pct_realisasi_budget_proxy"),
    )


def payables_ageing(m: Marts, as_of: date | None = None, limit: int = 10) -> DataFrame:
    """Ages are taken on ``as_of``, today when it is not given.

    The terms on the order count, not those of the vendor.
    """
    today = F.lit(as_of) if as_of else F.current_date()
    terms = F.create_map(*[F.lit(part) for pair in DUE_DAYS.items() for part in pair])
    due = F.coalesce(terms[F.col("payment_terms")], F.lit(OTHER_DUE_DAYS))
    aged = _received(m).withColumn("age", days_between(today, F.col("gr_date")))
    totals = grouped(
        aged, ["payment_terms"], [_vendors(m, "vendor_name")],
        {
            "jumlah_line_gr": _line(),
            "owed": _received_value(),
            "overdue": F.when(F.col("age") > due, _received_value()),
        },
        extremes=["age"],
    )
    return totals.orderBy(F.desc("owed"), "vendor_name", "payment_terms").limit(limit).select(
        "vendor_name", "payment_terms", "jumlah_line_gr",
        _billions("owed", "outstanding_proxy_miliar_idr"),
        _billions("overdue", "overdue_proxy_miliar_idr"),
        F.col("max_age").alias("max_age_days"),
    )


def discount_frequency(m: Marts, limit: int = 10) -> DataFrame:
    discounted = F.col("jumlah_line_diskon")
    totals = grouped(
        not_cancelled(m.fact), [], [_vendors(m, "vendor_name", "vendor_category")],
        {
            "jumlah_line_diskon": flag(F.col("has_discount")),
            "jumlah_line_total": _line(),
            "discount": F.col("discount_amount_idr"),
            "rate": hundredths("discount_pct"),
            "rated": present("discount_pct"),
        },
    )
    return totals.filter(discounted > 0).orderBy(
        F.desc("jumlah_line_diskon"), F.desc("discount"), "vendor_name", "vendor_category"
    ).limit(limit).select(
        "vendor_name", "vendor_category", "jumlah_line_diskon", "jumlah_line_total",
        percent(discounted, F.col("jumlah_line_total"), 1).alias("pct_line_diskon"),
        _billions("discount", "total_diskon_miliar_idr"),
        average("rate", "rated", 2, scale=2).alias("avg_discount_pct"),
    )


def spend_share_by_category(m: Marts) -> DataFrame:
    """The share window sees one row per item category."""
    totals = grouped(
        not_cancelled(m.fact), [], [_items(m, "item_category")],
        {"spend": _received_value(), "lines": present("po_line_id")},
        distinct=["po_id"],
        reduce_first=False,
    )
    everything = F.sum("spend").over(Window.partitionBy())
    shared = totals.withColumn("pct_total_spend", percent(F.col("spend"), everything, 1))
    return shared.orderBy(F.desc("spend"), "item_category").select(
        "item_category", _billions("spend", "spend_miliar_idr"), "pct_total_spend",
        F.col("n_po_id").alias("jumlah_po"), F.col("lines").alias("jumlah_line"),
    )


def unusual_spend(m: Marts, limit: int = 10) -> DataFrame:
    """Months above a department's average by more than two standard deviations.

    A department whose months are all alike is measured against its average instead. Sums of squares
    are whole numbers of any width, so nothing depends on the order of rows and only the result is
    rounded. A department's sum over its months times their number must stay below 10^26.
    """
    months = grouped(
        not_cancelled(m.fact), ["po_year_month"], [_departments(m, "department_name")],
        {"spend": _net()},
    )
    own = Window.partitionBy("department_name")
    scored = months.withColumns({
        "total": F.sum("spend").over(own), "months": F.count(_line()).over(own),
    }).withColumn("above", F.col("spend").cast("decimal(38,0)") * F.col("months") - F.col("total"))
    parts = [f"square_{i}" for i in range(3)]
    scored = scored.withColumns(dict(zip(parts, square(F.col("above")), strict=True)))
    scored = scored.withColumns({part: F.sum(part).over(own) for part in parts})
    above, count, squares = F.col("above"), F.col("months"), tuple(map(F.col, parts))
    alike = (squares[0] == 0) & (squares[1] == 0) & (squares[2] == 0)
    # above^2 / months^2 > 4 * squares / months^3
    beyond = ~at_least(squares, F.lit(4), square(above), count)
    unusual = F.when(alike, above > F.col("total") * 2).otherwise((above > 0) & beyond)
    hundredths_of = deviations(above, squares, count)
    return scored.filter(unusual).select(
        F.col("po_year_month").alias("tahun_bulan"), "department_name", "spend",
        _billions("spend", "spend_miliar_idr"),
        ratio(F.col("total"), F.col("months") * 10**BILLION, 2).alias("baseline_miliar_idr"),
        (hundredths_of.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).alias("z_score_proxy"),
    ).orderBy(
        F.desc_nulls_last("z_score_proxy"), F.desc("spend"), "tahun_bulan", "department_name"
    ).limit(limit).drop("spend")


def vendor_quarter_trend(m: Marts, limit: int = 15) -> DataFrame:
    quarters = grouped(
        _received(m), [], [_quarters(m), _vendors(m, "vendor_name")],
        {
            "lines": _line(),
            "on_time": flag(F.col("is_on_time")),
            "fulfilled_pct": hundredths("fulfillment_pct"),
            "variance": F.col("lead_time_variance_days"),
            "n_variance": present("lead_time_variance_days"),
            "net": _net(),
        },
    ).withColumn("pct_on_time", percent(F.col("on_time"), F.col("lines"), 1))
    line = Window.partitionBy("vendor_name").orderBy("year_quarter")
    compared = quarters.withColumn("prev_q_pct_on_time", F.lag("pct_on_time").over(line))
    return compared.orderBy(F.desc("year_quarter"), F.desc("net"), "vendor_name").limit(
        limit
    ).select(
        "year_quarter", "vendor_name", F.col("lines").alias("jumlah_line_gr"),
        average("fulfilled_pct", "lines", 1, scale=2).alias("avg_fulfillment_pct"),
        "pct_on_time", "prev_q_pct_on_time",
        average("variance", "n_variance", 1).alias("avg_variance_days"),
        _billions("net", "total_neto_miliar_idr"),
    )


def _numbers(dimension: DataFrame, key: str, names: tuple[str, ...], number: str) -> DataFrame:
    """A number for each key, the same for equal names and ascending with them.

    Numbers come from a distributed sort of the distinct names. They are good for comparing within
    one plan and never leave it.
    """
    ordered = dimension.select(*names).distinct().orderBy(*names)
    numbered = ordered.withColumn(number, F.monotonically_increasing_id())
    return dimension.select(key, *names).join(numbered, list(names)).select(key, number)


def supplier_dependence(m: Marts, limit: int = 10) -> DataFrame:
    """The largest supplier of each item and its share.

    Item and vendor names are numbered first, so that pairs of them travel as numbers; names are
    fetched for the rows kept. The supplier count, the item total and the largest supplier are one
    mergeable aggregate, so the suppliers of a hot item are combined task by task and never sorted
    in one place.
    """
    item = ("item_category", "item_name")
    vendors = m.vendors.where("is_current_record")
    pairs = (
        not_cancelled(m.fact).groupBy("item_id", "vendor_id")
        .agg(F.count(_line()).alias("jumlah_line"), F.sum(_net()).alias("spend"))
        .join(_numbers(m.items, "item_id", item, "item_no"), "item_id")
        .join(_numbers(vendors, "vendor_id", ("vendor_name",), "vendor_no"), "vendor_id")
        .groupBy("item_no", "vendor_no")
        .agg(
            F.sum("jumlah_line").alias("jumlah_line"), F.sum("spend").alias("spend"),
            F.min("item_id").alias("item_id"), F.min("vendor_id").alias("vendor_id"),
        )
    )
    largest = F.min_by(
        F.struct("vendor_id", "jumlah_line", "spend"), F.struct(-F.col("spend"), "vendor_no")
    )
    items = pairs.groupBy("item_no").agg(
        F.min("item_id").alias("item_id"),
        F.count(_line()).alias("jumlah_vendor_item"),
        F.sum("spend").alias("total"),
        largest.alias("top"),
    ).select("*", "top.*")
    spend, whole = F.col("spend"), F.nullif(F.col("total"), F.lit(0))
    share = spend.cast("double") / whole.cast("double")
    kept = items.withColumn("share", share).orderBy(
        F.desc_nulls_last("share"), F.desc("spend"), "item_no"
    ).limit(limit)
    named = kept.join(m.items.select("item_id", *item), "item_id").join(
        vendors.select("vendor_id", "vendor_name"), "vendor_id"
    )
    return named.orderBy(F.desc_nulls_last("share"), F.desc("spend"), *item).select(
        *item,
        F.col("vendor_name").alias("vendor_dominan"),
        "jumlah_vendor_item",
        "jumlah_line",
        _billions("spend", "vendor_spend_miliar_idr"),
        percent(spend, whole, 1).alias("pct_spend_item"),
        F.when(F.col("jumlah_vendor_item") == 1, SINGLE_SOURCE)
        .when(spend * 10 >= whole * 7, HIGH_RISK)
        .when(spend * 2 >= whole, MEDIUM_RISK)
        .otherwise(SPREAD)
        .alias("tingkat_risiko"),
    )


def negotiation_savings(m: Marts, limit: int = 10) -> DataFrame:
    """What lines cost below the list price; lines above it save nothing.

    The list price is met line by line, since prices tell nearly all lines of an item apart.
    """
    listed, quantity = F.col("current_unit_price_idr"), F.col("quantity_ordered")
    below = F.greatest(listed - F.col("net_unit_price_idr"), F.lit(0)).cast(MONEY)
    items = _items(m, "item_category", "current_unit_price_idr")
    lines = not_cancelled(m.fact).select(
        "item_sk", "vendor_sk", "net_unit_price_idr", "quantity_ordered", "net_total_ordered_idr"
    ).join(items.columns(), items.key)
    totals = grouped(
        lines, ["item_category"], [_vendors(m, "vendor_name")],
        {
            "jumlah_line": _line(),
            "saved": value_of(below, quantity),
            "listed": value_of(listed, quantity),
            "net": _net(),
        },
    )
    return totals.orderBy(F.desc("saved"), "vendor_name", "item_category").limit(limit).select(
        "vendor_name", "item_category", "jumlah_line",
        _billions("saved", "savings_proxy_miliar_idr"),
        _billions("listed", "nilai_referensi_miliar_idr"),
        _billions("net", "nilai_negosiasi_miliar_idr"),
        percent(F.col("saved"), F.col("listed"), 1).alias("pct_savings_proxy"),
    )


def requests_by_department(m: Marts, limit: int = 10) -> DataFrame:
    totals = grouped(
        not_cancelled(m.fact), [], [_departments(m, "department_name", "location")],
        {"lines": present("po_line_id"), "net": _net()},
        distinct=["pr_id", "po_id"],
    )
    return totals.orderBy(
        F.desc("n_pr_id"), F.desc("net"), "department_name", "location"
    ).limit(limit).select(
        "department_name", "location",
        F.col("n_pr_id").alias("jumlah_pr_proxy"), F.col("n_po_id").alias("jumlah_po"),
        F.col("lines").alias("jumlah_line"), _billions("net", "total_ordered_miliar_idr"),
    )


def received_by_item_month(m: Marts, limit: int = 15) -> DataFrame:
    keys = ("tahun_bulan_gr", "item_category", "item_name", "unit_of_measure")
    lines = _received(m).withColumn("tahun_bulan_gr", year_month(F.col("gr_date")))
    totals = grouped(
        lines, ["tahun_bulan_gr", "unit_of_measure"], [_items(m, "item_category", "item_name")],
        {
            "total_qty_diterima": F.col("quantity_received_calc"),
            "jumlah_line_gr": present("po_line_id"),
            "received": _received_value(),
        },
    )
    return totals.orderBy(
        F.desc("tahun_bulan_gr"), F.desc("total_qty_diterima"), *keys[1:]
    ).limit(limit).select(
        *keys, "total_qty_diterima", "jumlah_line_gr",
        _billions("received", "nilai_diterima_miliar_idr"),
    )


def quantity_mismatches(m: Marts, limit: int = 15) -> DataFrame:
    keys = ("item_category", "item_name", "receipt_status", "shortage_severity")
    totals = grouped(
        _received(m).filter("quantity_variance_gr <> 0"), keys[2:], [_items(m, *keys[:2])],
        {
            "jumlah_line": _line(),
            "total_qty_dipesan": F.col("quantity_ordered"),
            "total_qty_diterima": F.col("quantity_received_calc"),
            "total_variance_gr": F.col("quantity_variance_gr"),
            "fulfilled_pct": hundredths("fulfillment_pct"),
            "shortfall": F.col("value_shortfall_idr"),
        },
    )
    return totals.orderBy(
        F.desc(F.abs("total_variance_gr")), F.desc("shortfall"), *keys
    ).limit(limit).select(
        *keys, "jumlah_line", "total_qty_dipesan", "total_qty_diterima", "total_variance_gr",
        average("fulfilled_pct", "jumlah_line", 1, scale=2).alias("avg_fulfillment_pct"),
        _billions("shortfall", "shortfall_miliar_idr"),
    )


def stock_out_risk(m: Marts, limit: int = 15) -> DataFrame:
    short, late = F.col("is_short_delivery"), ~F.col("is_on_time")
    totals = grouped(
        _received(m).filter(short | late), [], [_items(m, "item_category", "item_name")],
        {
            "jumlah_short_delivery": flag(short),
            "jumlah_terlambat": flag(late),
            "total_unfulfilled_qty": F.col("unfulfilled_qty"),
            "variance": F.col("lead_time_variance_days"),
            "n_variance": present("lead_time_variance_days"),
            "shortfall": F.col("value_shortfall_idr"),
        },
    )
    delay = F.col("variance") / F.nullif(F.col("n_variance"), F.lit(0))
    return totals.orderBy(
        F.desc("total_unfulfilled_qty"), F.desc_nulls_last(delay), "item_category", "item_name"
    ).limit(limit).select(
        "item_category", "item_name", "jumlah_short_delivery", "jumlah_terlambat",
        "total_unfulfilled_qty",
        average("variance", "n_variance", 1).alias("avg_delay_days"),
        _billions("shortfall", "value_shortfall_miliar_idr"),
    )


STAKEHOLDER_REPORTS = {
    "PM1": value_by_period,
    "PM2": top_vendors_latest_year,
    "PM3": order_to_receipt_days,
    "PM4": timeliness_split,
    "PM5": price_rises,
    "FIN1": actual_against_budget,
    "FIN2": payables_ageing,
    "FIN3": discount_frequency,
    "FIN4": spend_share_by_category,
    "FIN5": unusual_spend,
    "OPS1": vendor_quarter_trend,
    "OPS2": supplier_dependence,
    "OPS3": negotiation_savings,
    "OPS4": requests_by_department,
    "WH1": received_by_item_month,
    "WH2": quantity_mismatches,
    "WH3": stock_out_risk,
}

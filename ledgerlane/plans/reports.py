"""The analytic reports over the marts. Output column names and labels are the published ones.

Each report scans the fact once, reads only the columns it names and reduces it before it looks a
dimension up.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlane.functions.numeric import count_where, in_units, mean, percent, ratio
from ledgerlane.operators.rollup import Lookup, flag, grouped, hundredths, present
from ledgerlane.plans.warehouse import Marts

MILLION, BILLION = 6, 9


def not_cancelled(fact: DataFrame) -> DataFrame:
    return fact.filter("NOT is_cancelled")


def punctual() -> Column:
    return F.col("is_on_time") & F.col("has_goods_receipt")


def average(total: str, rows: str, places: int, scale: int = 0) -> Column:
    """Rounded ``total / rows`` of summed columns, the total in units of ``10 ** -scale``."""
    return ratio(F.col(total), F.col(rows) * F.lit(10**scale), places)


def monthly_order_value(m: Marts) -> DataFrame:
    net, gross, discount = (F.col(c) for c in ("net", "gross", "discount"))
    months = not_cancelled(m.fact).groupBy("po_year", "po_month", "po_year_month").agg(
        F.countDistinct("po_id").alias("jumlah_po"),
        F.count("po_line_id").alias("jumlah_po_line"),
        F.sum("net_total_ordered_idr").alias("net"),
        mean(F.col("net_total_ordered_idr"), 0).alias("average"),
        F.sum("gross_total_ordered_idr").alias("gross"),
        F.sum("discount_amount_idr").alias("discount"),
    )
    return months.select(
        F.col("po_year").alias("tahun"),
        F.col("po_month").alias("bulan"),
        F.col("po_year_month").alias("tahun_bulan"),
        "jumlah_po",
        "jumlah_po_line",
        net.alias("total_nilai_neto_idr"),
        F.col("average").alias("rata_rata_nilai_per_line_idr"),
        gross.alias("total_nilai_bruto_idr"),
        discount.alias("total_diskon_idr"),
        percent(discount, gross, 2).alias("pct_diskon_rata_rata"),
        in_units(net, MILLION).alias("total_nilai_neto_juta_idr"),
    ).orderBy("tahun_bulan")


def top_vendors(m: Marts, limit: int = 5) -> DataFrame:
    """Ranks only the rows kept: whatever outranks a kept row is kept as well."""
    attributes = ("vendor_id", "vendor_name", "vendor_category", "vendor_type", "city",
                  "province", "payment_terms")
    totals = grouped(
        not_cancelled(m.fact), [],
        [Lookup(m.vendors, "vendor_sk", attributes)],
        {
            "lines": present("po_line_id"),
            "net": F.col("net_total_ordered_idr"),
            "fulfilled_pct": hundredths("fulfillment_pct"),
            "jumlah_line_ada_gr": flag(F.col("has_goods_receipt")),
            "jumlah_line_terpenuhi": flag(F.col("is_fully_fulfilled")),
            "jumlah_on_time": flag(punctual()),
        },
        distinct=["po_id"],
        distinct_by_key=True,
    )
    best = totals.orderBy(F.desc("net"), "vendor_id").limit(limit)
    place = F.rank().over(Window.orderBy(F.desc("net")))
    return best.withColumn("ranking_nilai", place).select(
        *attributes[:4],
        F.col("city").alias("kota"),
        F.col("province").alias("provinsi"),
        F.col("payment_terms").alias("syarat_pembayaran"),
        F.col("n_po_id").alias("jumlah_po"),
        F.col("lines").alias("jumlah_po_line"),
        F.col("net").alias("total_nilai_neto_idr"),
        in_units(F.col("net"), MILLION).alias("total_nilai_neto_juta"),
        average("fulfilled_pct", "lines", 1, scale=2).alias("avg_fulfillment_pct"),
        "jumlah_line_ada_gr",
        "jumlah_line_terpenuhi",
        "jumlah_on_time",
        percent(F.col("jumlah_on_time"), F.col("jumlah_line_ada_gr"), 1)
        .alias("pct_on_time_delivery"),
        "ranking_nilai",
    )


# Output column and the label it counts. Only the first label occurs in the data;
# the others are kept as published and count nothing.
LATENESS_COLUMNS = {
    "tepat_waktu": "Tepat Waktu",
    "terlambat_ringan": "Terlambat Ringan",
    "terlambat_sedang": "Terlambat Sedang",
    "terlambat_parah": "Terlambat Parah",
}


def lead_time_by_category(m: Marts) -> DataFrame:
    expected, actual = "expected_lead_time_days", "actual_lead_time_days"
    variance = "lead_time_variance_days"
    totals = grouped(
        not_cancelled(m.fact), [], [Lookup(m.items, "item_sk", ["item_category"])],
        {
            "total_po_line": present("po_line_id"),
            "po_line_ada_gr": flag(F.col("has_goods_receipt")),
            "on_time": flag(punctual()),
            **{f"sum_{name}": F.col(name) for name in (expected, actual, variance)},
            **{f"n_{name}": present(name) for name in (expected, actual, variance)},
            **{
                name: flag(F.col("delivery_timeliness") == label)
                for name, label in LATENESS_COLUMNS.items()
            },
        },
        extremes=[expected, actual],
    )
    return totals.select(
        F.col("item_category").alias("kategori_item"),
        "total_po_line",
        "po_line_ada_gr",
        average(f"sum_{expected}", f"n_{expected}", 1).alias("rata_expected_lead_time_hari"),
        F.col(f"min_{expected}").alias("min_expected_lead_time"),
        F.col(f"max_{expected}").alias("max_expected_lead_time"),
        average(f"sum_{actual}", f"n_{actual}", 1).alias("rata_actual_lead_time_hari"),
        F.col(f"min_{actual}").alias("min_actual_lead_time"),
        F.col(f"max_{actual}").alias("max_actual_lead_time"),
        average(f"sum_{variance}", f"n_{variance}", 1).alias("rata_variansi_lead_time_hari"),
        percent(F.col("on_time"), F.col("po_line_ada_gr"), 1).alias("pct_on_time"),
        *LATENESS_COLUMNS,
    ).orderBy(F.desc_nulls_last("rata_actual_lead_time_hari"), "kategori_item")


# Report heading and the row labels below it, in published order.
MISMATCH_TITLE = "=== RINGKASAN KETIDAKSESUAIAN KUANTITAS ==="
MISMATCH_ROWS = (
    "Total PO Lines",
    "Belum Ada Penerimaan (GR)",
    "Penerimaan Lengkap (100%)",
    "Penerimaan Kurang (< 100%)",
    "Penerimaan Lebih (> 100%)",
)


def mismatch_summary(m: Marts) -> DataFrame:
    """A heading and five counts, all from one scan."""
    conditions = (
        F.lit(True),
        ~F.col("has_goods_receipt"),
        F.col("is_fully_fulfilled"),
        F.col("is_short_delivery"),
        F.col("is_over_delivery"),
    )
    counts = not_cancelled(m.fact).agg(
        *[count_where(condition).alias(f"n{i}") for i, condition in enumerate(conditions)]
    )

    def row(label: str, detail: Column) -> Column:
        return F.struct(F.lit(label).alias("laporan"), detail.cast("string").alias("detail"))

    rows = [row(MISMATCH_TITLE, F.lit(None))]
    rows += [row(label, F.col(f"n{i}")) for i, label in enumerate(MISMATCH_ROWS)]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def mismatch_by_severity(m: Marts) -> DataFrame:
    """One row per severity label and one for lines without receipt.

    The published order names labels that never occur, so every row ties in it; the label itself
    settles the order. The total window runs over these few grouped rows only.
    """
    totals = not_cancelled(m.fact).groupBy(
        F.col("shortage_severity").alias("tingkat_kekurangan")
    ).agg(
        F.count("po_line_id").alias("jumlah_po_line"),
        F.sum("quantity_ordered").alias("total_qty_dipesan"),
        F.sum("quantity_received_calc").alias("total_qty_diterima"),
        F.sum("unfulfilled_qty").alias("total_qty_tidak_terpenuhi"),
        F.sum("net_total_ordered_idr").alias("total_nilai_dipesan_idr"),
        F.sum("net_total_received_idr").alias("total_nilai_diterima_idr"),
        F.sum("value_shortfall_idr").alias("total_nilai_shortfall_idr"),
        mean(F.col("fulfillment_pct"), 1, scale=2).alias("avg_fulfillment_pct"),
        F.sum("rejected_goods_value_idr").alias("total_nilai_barang_ditolak_idr"),
        count_where(F.col("is_rejected_by_inspection")).alias("jumlah_line_ada_penolakan"),
    )
    everything = F.sum("jumlah_po_line").over(Window.partitionBy())
    shared = totals.withColumn("pct_dari_total", percent(F.col("jumlah_po_line"), everything, 1))
    first = ["tingkat_kekurangan", "jumlah_po_line", "pct_dari_total"]
    rest = [name for name in totals.columns if name not in first]
    return shared.select(*first, *rest).orderBy(F.asc_nulls_last("tingkat_kekurangan"))


def mismatch_by_year(m: Marts) -> DataFrame:
    received = F.col("has_goods_receipt")
    return not_cancelled(m.fact).groupBy(F.col("po_year").alias("tahun")).agg(
        F.count("po_line_id").alias("total_po_line"),
        count_where(F.col("is_fully_fulfilled")).alias("terpenuhi_penuh"),
        count_where(F.col("is_short_delivery")).alias("kekurangan"),
        count_where(F.col("is_over_delivery")).alias("kelebihan"),
        count_where(~received).alias("belum_ada_gr"),
        percent(count_where(F.col("is_fully_fulfilled")), count_where(received), 1)
        .alias("pct_terpenuhi_penuh"),
        mean(F.when(received, F.col("fulfillment_pct")), 1, scale=2).alias("avg_fulfillment_pct"),
    ).orderBy("tahun")


def spend_by_department(m: Marts) -> DataFrame:
    """Cancelled lines count here. The ranking window sees one row per department."""
    ordered, received = F.col("ordered"), F.col("received")
    budget = F.col("budget_annual_idr")
    attributes = ("department_id", "department_name", "cost_center", "location", "manager_name",
                  "budget_tier", "budget_annual_idr")
    waiting = ~F.col("has_goods_receipt") & ~F.col("is_cancelled") & ~F.col("is_completed")
    totals = grouped(
        m.fact, [], [Lookup(m.departments, "department_sk", attributes)],
        {
            "lines": present("po_line_id"),
            "ordered": F.col("net_total_ordered_idr"),
            "received": F.col("net_total_received_idr"),
            "shortfall": F.col("value_shortfall_idr"),
            "rejected": F.col("rejected_goods_value_idr"),
            "po_line_selesai": flag(F.col("is_completed")),
            "po_line_dibatalkan": flag(F.col("is_cancelled")),
            "po_line_dalam_proses": flag(waiting),
        },
        distinct=["po_id"],
        reduce_first=False,
    )
    ranked = totals.withColumn(
        "ranking_pengeluaran", F.rank().over(Window.orderBy(F.desc("received")))
    ).orderBy(F.desc("received"), "department_id")
    return ranked.select(
        "department_id",
        F.col("department_name").alias("nama_departemen"),
        F.col("cost_center").alias("kode_cost_center"),
        F.col("location").alias("lokasi"),
        F.col("manager_name").alias("manajer"),
        F.col("budget_tier").alias("segmen_anggaran"),
        in_units(budget, MILLION, 1).alias("anggaran_tahunan_juta_idr"),
        F.col("n_po_id").alias("jumlah_po"),
        F.col("lines").alias("jumlah_po_line"),
        in_units(ordered, MILLION).alias("total_dipesan_juta_idr"),
        in_units(received, MILLION).alias("total_diterima_juta_idr"),
        in_units(F.col("shortfall"), MILLION).alias("total_shortfall_juta_idr"),
        in_units(F.col("rejected"), MILLION).alias("nilai_barang_ditolak_juta_idr"),
        percent(received, ordered, 1).alias("pct_realisasi_pesanan"),
        percent(ordered, budget, 1).alias("pct_utilisasi_anggaran_kumulatif"),
        "po_line_selesai",
        "po_line_dibatalkan",
        "po_line_dalam_proses",
        "ranking_pengeluaran",
    )


# What the row-count report says it expects.
EXPECTATIONS = {
    "dim_date": "3652 (2018-2027, 10 tahun)",
    "dim_departments": "30 departemen",
    "dim_items": "300 item",
    "dim_vendors (current only)": "150 (satu per vendor_id)",
    "dim_vendors (all versions)": "~169 (150 current + ~19 historical)",
    "fct_purchase_order_lines": "~10821 PO lines",
    "fct — has_goods_receipt = TRUE": "~8174 (sesuai jumlah GR lines)",
    "fct — vendor_sk NULL (orphan)": "0 (tidak boleh ada orphan vendor)",
    "fct — date_key_po_date NULL (orphan)": "0 (tidak boleh ada orphan date PO)",
}


def row_counts(m: Marts) -> DataFrame:
    """Row counts of the marts and orphan counts of the fact; each table is scanned once."""

    def counts(table: DataFrame, conditions: dict[str, Column]) -> DataFrame:
        found = table.agg(*[
            count_where(condition).alias(f"n{i}") for i, condition in enumerate(conditions.values())
        ])
        rows = [
            F.struct(
                F.lit(name).alias("nama_tabel"),
                F.col(f"n{i}").alias("jumlah_baris"),
                F.lit(EXPECTATIONS[name]).alias("ekspektasi"),
            )
            for i, name in enumerate(conditions)
        ]
        return found.select(F.explode(F.array(*rows)).alias("r")).select("r.*")

    everything = F.lit(True)
    parts = [
        counts(m.dates, {"dim_date": everything}),
        counts(m.departments, {"dim_departments": everything}),
        counts(m.items, {"dim_items": everything}),
        counts(m.vendors, {
            "dim_vendors (current only)": F.col("is_current_record"),
            "dim_vendors (all versions)": everything,
        }),
        counts(m.fact, {
            "fct_purchase_order_lines": everything,
            "fct — has_goods_receipt = TRUE": F.col("has_goods_receipt"),
            "fct — vendor_sk NULL (orphan)": F.col("vendor_sk").isNull(),
            "fct — date_key_po_date NULL (orphan)": F.col("date_key_po_date").isNull(),
        }),
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("nama_tabel")


REPORTS = {
    "Q1": monthly_order_value,
    "Q2": top_vendors,
    "Q3": lead_time_by_category,
    "Q4a": mismatch_summary,
    "Q4b": mismatch_by_severity,
    "Q4c": mismatch_by_year,
    "Q5": spend_by_department,
    "Q6": row_counts,
}

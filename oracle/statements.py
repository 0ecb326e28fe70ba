"""The expected result of every registered query, as one DuckDB statement each."""

from __future__ import annotations

from oracle.tables import stamp, with_tables
from oracle.text import mean, percent, ratio, typed, units

MILLION, BILLION = 6, 9

DEPARTMENT = (
    "department_id:i department_code:s department_name:s cost_center:s location:s "
    "manager_name:s budget_annual_idr:d created_at:t loaded_at:s"
)
VENDOR = (
    "vendor_id:i vendor_code:s vendor_name:s vendor_category:s vendor_type:s address:s city:s "
    "province:s postal_code:s phone:s email:s npwp:s payment_terms:s vendor_rating:d "
    "is_active:b is_goods_vendor:b is_service_vendor:b registered_date:t created_at:t"
)
ITEM = (
    "item_id:i item_code:s item_name:s item_category:s unit_of_measure:s {price}:d "
    "min_order_qty:i {lead}:i is_active:b price_tier:s is_fast_moving:b created_at:t {loaded}:s"
)
VERSION = "dbt_valid_from:t dbt_valid_to:t is_current_record:b record_version:i"
LIFECYCLE = (
    "po_line_id:i po_id:i pr_id:i vendor_id:i department_id:i item_id:i gr_id:i po_number:s "
    "gr_number:s line_number:i po_date:t delivery_date_expected:t gr_date:t po_year:i po_month:i "
    "po_year_month:s quantity_ordered:i quantity_received:i {counted}:i quantity_variance_gr:i "
    "unfulfilled_qty:i fulfillment_pct:d unit_price_idr:d net_unit_price_idr:d discount_pct:d "
    "discount_amount_idr:d has_discount:b discount_tier:s gross_total_ordered_idr:d "
    "net_total_ordered_idr:d net_total_received_idr:d value_shortfall_idr:d "
    "rejected_goods_value_idr:d expected_lead_time_days:i actual_lead_time_days:i "
    "lead_time_variance_days:i po_status:s line_status:s lifecycle_stage:s receipt_status:s "
    "delivery_timeliness:s shortage_severity:s is_on_time:b is_short_delivery:b "
    "is_over_delivery:b is_full_delivery:b has_goods_receipt:b is_fully_fulfilled:b "
    "is_rejected_by_inspection:b needs_reinspection:b unit_of_measure:s warehouse_location:s "
    "inspection_status:s payment_terms:s is_cancelled:b is_completed:b"
)
FACT_KEYS = (
    "fct_po_line_sk:s date_key_po_date:i date_key_delivery_expected:i date_key_gr_date:i "
    "vendor_sk:s department_sk:s item_sk:s"
)
FACT = f"{FACT_KEYS} {LIFECYCLE.format(counted='quantity_received_calc')}"
RECEIPT = (
    "gr_id:i gr_number:s gr_date:t gr_year:i gr_month:i gr_year_month:s po_id:i po_line_id:i "
    "item_id:i quantity_ordered:i quantity_received:i quantity_variance:i variance_pct:d "
    "quantity_fulfillment_pct:d receipt_status:s lead_time_days:i is_on_time:b "
    "delivery_timeliness:s is_short_delivery:b is_over_delivery:b is_full_delivery:b "
    "shortage_severity:s unit_price_idr:d total_received_value_idr:d shortage_value_idr:d "
    "warehouse_location:s received_by:s inspection_status:s is_rejected_by_inspection:b "
    "needs_reinspection:b notes:s created_at:t loaded_at:s"
)
_CALENDAR = (
    "date_key:i full_date:t date_label:s year:i iso_year:i quarter_number:i quarter_label:s "
    "year_quarter:s month_number:i month_short_en:s month_name_id:s year_month:s "
    "week_of_year:i year_week:s day_of_month:i day_of_year:i day_of_week_sun0:i "
    "day_of_week_iso:i day_name_id:s day_short_id:s is_weekend:b is_weekday:b "
    "is_first_day_of_month:b is_last_day_of_month:b is_last_day_of_quarter:b "
    "is_first_day_of_year:b is_last_day_of_year:b fiscal_year:i fiscal_quarter:i "
    "fiscal_month:i"
)


def _table(source: str, columns: str) -> str:
    return f"SELECT {typed(columns)} FROM {source}"


_ROW = {
    "T1": _table("s_departments", DEPARTMENT),
    "T2": _table("s_vendors", f"{VENDOR} loaded_at:s"),
    "T3": _table("s_items", ITEM.format(price="unit_price_idr", lead="lead_time_days",
                                        loaded="loaded_at")),
    "T4": _table(
        "s_purchase_requests",
        "pr_id:i pr_number:s pr_date:t pr_year:i pr_month:i pr_year_month:s department_id:i "
        "requester_name:s requester_email:s purpose:s priority:s pr_status:s approved_by:s "
        "approval_date:t is_approved:b is_rejected:b is_pending:b approval_lead_days:i "
        "total_amount_idr:d notes:s created_at:t loaded_at:s"),
    "T5": _table(
        "s_purchase_orders",
        "po_id:i po_number:s po_date:t po_year:i po_month:i po_year_month:s pr_id:i vendor_id:i "
        "department_id:i expected_delivery_date:t expected_lead_time_days:i payment_terms:s "
        "po_status:s shipping_address:s approved_by:s approval_date:t approval_lag_days:i "
        "is_open:b is_partial:b is_completed:b is_cancelled:b is_active_po:b "
        "total_amount_idr:d notes:s created_at:t loaded_at:s"),
    "T6": _table(
        "s_purchase_order_lines",
        "line_id:i po_id:i item_id:i line_number:i quantity_ordered:i unit_of_measure:s "
        "unit_price_idr:d discount_pct:d net_unit_price_idr:d gross_total_price_idr:d "
        "net_total_price_idr:d discount_amount_idr:d has_discount:b discount_tier:s "
        "delivery_date_expected:t line_status:s notes:s created_at:t loaded_at:s"),
    "T7": _table("s_goods_receipts", RECEIPT),
    "L1": _table("latest_receipts", RECEIPT),
    "L2": _table("lifecycle", LIFECYCLE.format(counted="quantity_received_coalesced")),
    "D1": " UNION ALL ".join(
        f"SELECT '{role}' AS date_role, CAST({key} AS BIGINT) AS document_id, {typed(_CALENDAR)} "
        f"FROM {source} JOIN dim_date ON {day} = full_date"
        for role, key, source, day in (
            ("order", "po_id", "raw_purchase_orders", "po_date"),
            ("promised", "po_id", "raw_purchase_orders", "expected_delivery_date"),
            ("receipt", "gr_id", "raw_goods_receipts", "gr_date"),
        )
    ),
    "D2": _table("dim_departments", f"department_sk:s {DEPARTMENT} budget_tier:s"),
    "D3": _table("dim_items", "item_sk:s " + ITEM.format(
        price="current_unit_price_idr", lead="standard_lead_time_days",
        loaded="last_updated_at")),
    "D4": _table("dim_vendors", f"vendor_sk:s {VERSION} {VENDOR}"),
    "X1": _table("fact", FACT),
    "X6": _table("fact", FACT),
}

# The loads applied in D5. One of 2024-07-01 is run twice; of the first run nothing is left, since the
# second has other values for the same vendors. A third of 2024-10-01 follows. One vendor in eleven
# comes again under a new number.
def _incoming(**changed: str) -> str:
    replaced = ", ".join(f"{expression} AS {name}" for name, expression in changed.items())
    return f"""
        SELECT * REPLACE ({replaced}) FROM (
            SELECT * FROM s_vendors
            UNION ALL SELECT * REPLACE (-vendor_id AS vendor_id) FROM s_vendors WHERE vendor_id % 11 = 0)"""


def _applied(versions: str, incoming: str, day: str) -> str:
    return f"""
        WITH known AS ({versions}), incoming AS ({incoming}),
        compared AS (
            SELECT n.vendor_id, o.record_version,
                   o.vendor_id IS NOT NULL AND (o.payment_terms, o.city, o.province) IS DISTINCT FROM
                       (n.payment_terms, n.city, n.province) AS changed,
                   o.vendor_id IS NULL AS fresh
            FROM incoming n LEFT JOIN known o ON n.vendor_id = o.vendor_id AND o.is_current_record)
        SELECT d.* REPLACE (
                   CASE WHEN d.is_current_record AND c.changed THEN {day} - 1
                        ELSE d.dbt_valid_to END AS dbt_valid_to,
                   d.is_current_record AND NOT coalesce(c.changed, false) AS is_current_record)
        FROM known d LEFT JOIN compared c USING (vendor_id)
        UNION ALL
        SELECT md5(vendor_id || '|' || CAST({day} AS VARCHAR)), i.*, {day}, NULL, true,
               coalesce(c.record_version, 0) + 1
        FROM incoming i JOIN compared c USING (vendor_id) WHERE c.changed OR c.fresh"""


_TERMS = "CASE WHEN abs(vendor_id) % 5 = 0 THEN 'Net 45' ELSE payment_terms END"
_SECOND = _applied("SELECT * FROM dim_vendors", _incoming(
    payment_terms=_TERMS, city="CASE WHEN abs(vendor_id) % 7 = 0 THEN 'Medan' ELSE city END",
    province="CASE WHEN abs(vendor_id) % 13 = 0 THEN 'Sumatera' ELSE province END",
), "DATE '2024-07-01'")
_THIRD = _applied(_SECOND, _incoming(
    payment_terms=_TERMS, city="CASE WHEN abs(vendor_id) % 7 < 2 THEN 'Bogor' ELSE city END",
    province="CASE WHEN abs(vendor_id) % 13 = 0 THEN 'Sumatera' ELSE province END",
), "DATE '2024-10-01'")
_D5 = f"""SELECT {typed(f"vendor_sk:s {VERSION} {VENDOR}")} FROM ({_THIRD})"""

_ROW["D5"] = _D5
_ROW["D6"] = """
    SELECT CAST(o.po_id AS BIGINT) AS po_id, v.vendor_sk,
           CAST(v.record_version AS BIGINT) AS record_version
    FROM s_purchase_orders o LEFT JOIN dim_vendors v
         ON o.vendor_id = v.vendor_id AND o.po_date >= v.dbt_valid_from
            AND o.po_date <= coalesce(v.dbt_valid_to, DATE '9999-12-31')"""

_ON_TIME = "count(*) FILTER (WHERE is_on_time AND has_goods_receipt)"
_WITH_GR = "count(*) FILTER (WHERE has_goods_receipt)"
_NET, _GROSS = "sum(net_total_ordered_idr)", "sum(gross_total_ordered_idr)"
_RECEIVED, _DISCOUNT = "sum(net_total_received_idr)", "sum(discount_amount_idr)"
_FULFILMENT = mean("fulfillment_pct", 1, scale=2)
_COUNTS = "count(DISTINCT po_id) AS jumlah_po, count(*) AS jumlah_po_line"

_ANALYTIC = {
    "Q1": f"""
        SELECT CAST(po_year AS BIGINT) AS tahun, CAST(po_month AS BIGINT) AS bulan,
               po_year_month AS tahun_bulan, {_COUNTS},
               CAST({_NET} AS DOUBLE) AS total_nilai_neto_idr,
               {mean('net_total_ordered_idr', 0)} AS rata_rata_nilai_per_line_idr,
               CAST({_GROSS} AS DOUBLE) AS total_nilai_bruto_idr,
               CAST({_DISCOUNT} AS DOUBLE) AS total_diskon_idr,
               {percent(_DISCOUNT, _GROSS, 2)} AS pct_diskon_rata_rata,
               {units(_NET, MILLION)} AS total_nilai_neto_juta_idr
        FROM kept GROUP BY po_year, po_month, po_year_month""",
    "Q2": f"""
        SELECT v.vendor_id, v.vendor_name, v.vendor_category, v.vendor_type, v.city AS kota,
               v.province AS provinsi, v.payment_terms AS syarat_pembayaran, {_COUNTS},
               CAST({_NET} AS DOUBLE) AS total_nilai_neto_idr,
               {units(_NET, MILLION)} AS total_nilai_neto_juta,
               {_FULFILMENT} AS avg_fulfillment_pct,
               {_WITH_GR} AS jumlah_line_ada_gr,
               count(*) FILTER (WHERE is_fully_fulfilled) AS jumlah_line_terpenuhi,
               {_ON_TIME} AS jumlah_on_time,
               {percent(_ON_TIME, _WITH_GR, 1)} AS pct_on_time_delivery,
               rank() OVER (ORDER BY {_NET} DESC) AS ranking_nilai
        FROM kept f JOIN dim_vendors v USING (vendor_sk)
        GROUP BY ALL ORDER BY {_NET} DESC, v.vendor_id LIMIT 5""",
    "Q3": f"""
        SELECT i.item_category AS kategori_item, count(*) AS total_po_line,
               {_WITH_GR} AS po_line_ada_gr,
               {mean('expected_lead_time_days', 1)} AS rata_expected_lead_time_hari,
               CAST(min(expected_lead_time_days) AS BIGINT) AS min_expected_lead_time,
               CAST(max(expected_lead_time_days) AS BIGINT) AS max_expected_lead_time,
               {mean('actual_lead_time_days', 1)} AS rata_actual_lead_time_hari,
               min(actual_lead_time_days) AS min_actual_lead_time,
               max(actual_lead_time_days) AS max_actual_lead_time,
               {mean('lead_time_variance_days', 1)} AS rata_variansi_lead_time_hari,
               {percent(_ON_TIME, _WITH_GR, 1)} AS pct_on_time,
               count(*) FILTER (WHERE delivery_timeliness = 'Tepat Waktu') AS tepat_waktu,
               count(*) FILTER (WHERE delivery_timeliness = 'Terlambat Ringan')
                   AS terlambat_ringan,
               count(*) FILTER (WHERE delivery_timeliness = 'Terlambat Sedang')
                   AS terlambat_sedang,
               count(*) FILTER (WHERE delivery_timeliness = 'Terlambat Parah')
                   AS terlambat_parah
        FROM kept JOIN dim_items i USING (item_sk) GROUP BY i.item_category""",
    "Q4a": """
        SELECT laporan, CAST(detail AS VARCHAR) AS detail FROM (
            SELECT '=== RINGKASAN KETIDAKSESUAIAN KUANTITAS ===' AS laporan,
                   CAST(NULL AS BIGINT) AS detail
            UNION ALL SELECT 'Total PO Lines', count(*) FROM kept
            UNION ALL SELECT 'Belum Ada Penerimaan (GR)', count(*) FROM kept
                      WHERE NOT has_goods_receipt
            UNION ALL SELECT 'Penerimaan Lengkap (100%)', count(*) FROM kept
                      WHERE is_fully_fulfilled
            UNION ALL SELECT 'Penerimaan Kurang (< 100%)', count(*) FROM kept
                      WHERE is_short_delivery
            UNION ALL SELECT 'Penerimaan Lebih (> 100%)', count(*) FROM kept
                      WHERE is_over_delivery)""",
    "Q4b": f"""
        SELECT shortage_severity AS tingkat_kekurangan, count(*) AS jumlah_po_line,
               {percent('count(*)', '(SELECT count(*) FROM kept)', 1)} AS pct_dari_total,
               CAST(sum(quantity_ordered) AS BIGINT) AS total_qty_dipesan,
               CAST(sum(quantity_received_calc) AS BIGINT) AS total_qty_diterima,
               CAST(sum(unfulfilled_qty) AS BIGINT) AS total_qty_tidak_terpenuhi,
               CAST({_NET} AS DOUBLE) AS total_nilai_dipesan_idr,
               CAST({_RECEIVED} AS DOUBLE) AS total_nilai_diterima_idr,
               CAST(sum(value_shortfall_idr) AS DOUBLE) AS total_nilai_shortfall_idr,
               {_FULFILMENT} AS avg_fulfillment_pct,
               CAST(sum(rejected_goods_value_idr) AS DOUBLE) AS total_nilai_barang_ditolak_idr,
               count(*) FILTER (WHERE is_rejected_by_inspection) AS jumlah_line_ada_penolakan
        FROM kept GROUP BY shortage_severity""",
    "Q4c": f"""
        SELECT CAST(po_year AS BIGINT) AS tahun, count(*) AS total_po_line,
               count(*) FILTER (WHERE is_fully_fulfilled) AS terpenuhi_penuh,
               count(*) FILTER (WHERE is_short_delivery) AS kekurangan,
               count(*) FILTER (WHERE is_over_delivery) AS kelebihan,
               count(*) FILTER (WHERE NOT has_goods_receipt) AS belum_ada_gr,
               {percent('count(*) FILTER (WHERE is_fully_fulfilled)', _WITH_GR, 1)}
                   AS pct_terpenuhi_penuh,
               {ratio('sum(CAST(round(fulfillment_pct * 100) AS BIGINT)) '
                      'FILTER (WHERE has_goods_receipt)', f'{_WITH_GR} * 100', 1)}
                   AS avg_fulfillment_pct
        FROM kept GROUP BY po_year""",
    "Q5": f"""
        SELECT d.department_id, d.department_name AS nama_departemen,
               d.cost_center AS kode_cost_center, d.location AS lokasi,
               d.manager_name AS manajer, d.budget_tier AS segmen_anggaran,
               {units('d.budget_annual_idr', MILLION, 1)} AS anggaran_tahunan_juta_idr,
               {_COUNTS}, {units(_NET, MILLION)} AS total_dipesan_juta_idr,
               {units(_RECEIVED, MILLION)} AS total_diterima_juta_idr,
               {units('sum(value_shortfall_idr)', MILLION)} AS total_shortfall_juta_idr,
               {units('sum(rejected_goods_value_idr)', MILLION)} AS nilai_barang_ditolak_juta_idr,
               {percent(_RECEIVED, _NET, 1)} AS pct_realisasi_pesanan,
               {percent(_NET, 'd.budget_annual_idr', 1)} AS pct_utilisasi_anggaran_kumulatif,
               count(*) FILTER (WHERE is_completed) AS po_line_selesai,
               count(*) FILTER (WHERE is_cancelled) AS po_line_dibatalkan,
               count(*) FILTER (WHERE NOT (has_goods_receipt OR is_cancelled OR is_completed))
                   AS po_line_dalam_proses,
               rank() OVER (ORDER BY {_RECEIVED} DESC) AS ranking_pengeluaran
        FROM fact JOIN dim_departments d USING (department_sk)
        GROUP BY d.department_id, d.department_name, d.cost_center, d.location, d.manager_name,
                 d.budget_tier, d.budget_annual_idr""",
    "Q6": """
        SELECT * FROM (VALUES
            ('dim_date', (SELECT count(*) FROM dim_date), '3652 (2018-2027, 10 tahun)'),
            ('dim_departments', (SELECT count(*) FROM dim_departments), '30 departemen'),
            ('dim_items', (SELECT count(*) FROM dim_items), '300 item'),
            ('dim_vendors (current only)',
             (SELECT count(*) FROM dim_vendors WHERE is_current_record),
             '150 (satu per vendor_id)'),
            ('dim_vendors (all versions)', (SELECT count(*) FROM dim_vendors),
             '~169 (150 current + ~19 historical)'),
            ('fct_purchase_order_lines', (SELECT count(*) FROM fact), '~10821 PO lines'),
            ('fct — has_goods_receipt = TRUE',
             (SELECT count(*) FROM fact WHERE has_goods_receipt), '~8174 (sesuai jumlah GR lines)'),
            ('fct — vendor_sk NULL (orphan)',
             (SELECT count(*) FROM fact WHERE vendor_sk IS NULL),
             '0 (tidak boleh ada orphan vendor)'),
            ('fct — date_key_po_date NULL (orphan)',
             (SELECT count(*) FROM fact WHERE date_key_po_date IS NULL),
             '0 (tidak boleh ada orphan date PO)')
        ) AS t(nama_tabel, jumlah_baris, ekspektasi)""",
}

_PUNCTUAL = percent("count(*) FILTER (WHERE is_on_time)", "count(*)", 1)
_PERIOD = (
    "count(DISTINCT po_id) AS jumlah_po, count(*) AS jumlah_line, "
    f"{units(_NET, BILLION)} AS total_neto_miliar_idr, "
    f"{units(_DISCOUNT, BILLION)} AS total_diskon_miliar_idr"
)
_SAVED = "sum(greatest(current_unit_price_idr - net_unit_price_idr, 0) * quantity_ordered)"
_LISTED = "sum(current_unit_price_idr * quantity_ordered)"

_STAKEHOLDER = {
    "PM1": f"""
        SELECT 'Bulanan' AS tipe_periode, po_year_month AS periode, {_PERIOD}
        FROM kept GROUP BY po_year_month
        UNION ALL
        SELECT 'Kuartalan', year_quarter, {_PERIOD}
        FROM kept JOIN dim_date ON date_key_po_date = date_key GROUP BY year_quarter
        ORDER BY periode DESC, tipe_periode LIMIT 12""",
    "PM2": f"""
        SELECT CAST(po_year AS BIGINT) AS tahun, vendor_name, vendor_category,
               count(DISTINCT po_id) AS jumlah_po, count(*) AS jumlah_line,
               {units(_NET, BILLION)} AS total_neto_miliar_idr,
               {_FULFILMENT} AS avg_fulfillment_pct
        FROM kept JOIN dim_vendors USING (vendor_sk)
        WHERE po_year = (SELECT max(po_year) FROM kept)
        GROUP BY po_year, vendor_name, vendor_category
        ORDER BY {_NET} DESC, vendor_name, vendor_category LIMIT 10""",
    "PM3": f"""
        SELECT item_category, count(*) AS jumlah_line_gr,
               {mean('expected_lead_time_days', 1)} AS avg_expected_days,
               {mean('actual_lead_time_days', 1)} AS avg_actual_days,
               {mean('lead_time_variance_days', 1)} AS avg_variance_days,
               {_PUNCTUAL} AS pct_on_time
        FROM kept JOIN dim_items USING (item_sk) WHERE has_goods_receipt
        GROUP BY item_category""",
    "PM4": f"""
        SELECT coalesce(delivery_timeliness, 'Belum Ada GR') AS status_ketepatan,
               count(*) AS jumlah_line,
               {percent('count(*)', '(SELECT count(*) FROM kept)', 1)} AS pct_dari_total,
               {units(_NET, BILLION)} AS total_neto_miliar_idr
        FROM kept GROUP BY ALL""",
    "PM5": f"""
        WITH months AS (
            SELECT po_year_month AS tahun_bulan, item_category, count(*) AS jumlah_line,
                   {mean('net_unit_price_idr', 0)} AS avg_net_unit_price_idr
            FROM kept JOIN dim_items USING (item_sk) GROUP BY ALL),
        compared AS (
            SELECT *, lag(avg_net_unit_price_idr) OVER (PARTITION BY item_category
                                                        ORDER BY tahun_bulan)
                   AS prev_avg_net_unit_price_idr
            FROM months)
        SELECT tahun_bulan, item_category, prev_avg_net_unit_price_idr, avg_net_unit_price_idr,
               {percent('avg_net_unit_price_idr - prev_avg_net_unit_price_idr',
                        'prev_avg_net_unit_price_idr', 1)} AS pct_kenaikan_harga, jumlah_line
        FROM compared WHERE avg_net_unit_price_idr > prev_avg_net_unit_price_idr
        ORDER BY pct_kenaikan_harga DESC NULLS LAST, tahun_bulan, item_category LIMIT 10""",
    "FIN1": f"""
        SELECT po_year_month AS tahun_bulan, department_name,
               {units(_RECEIVED, BILLION)} AS actual_miliar_idr,
               {ratio('budget_annual_idr', str(12 * 10**BILLION), 2)} AS budget_proxy_miliar_idr,
               {percent(f'{_RECEIVED} * 12', 'budget_annual_idr', 1)}
                   AS pct_realisasi_budget_proxy
        FROM kept JOIN dim_departments USING (department_sk)
        GROUP BY po_year_month, department_name, budget_annual_idr
        ORDER BY po_year_month DESC, {_RECEIVED} DESC, department_name, budget_annual_idr
        LIMIT 15""",
    "FIN2": f"""
        WITH aged AS (
            SELECT v.vendor_name, f.payment_terms, net_total_received_idr AS owed,
                   CAST(DATE '2024-12-31' - gr_date AS BIGINT) AS age,
                   CASE f.payment_terms WHEN 'COD' THEN 0 WHEN 'DP 50%' THEN 15
                        ELSE CAST(substr(f.payment_terms, 5) AS BIGINT) END AS due
            FROM kept f JOIN dim_vendors v USING (vendor_sk) WHERE has_goods_receipt)
        SELECT vendor_name, payment_terms, count(*) AS jumlah_line_gr,
               {units('sum(owed)', BILLION)} AS outstanding_proxy_miliar_idr,
               {units('(sum(owed) FILTER (WHERE age > due))', BILLION)}
                   AS overdue_proxy_miliar_idr,
               max(age) AS max_age_days
        FROM aged GROUP BY ALL ORDER BY sum(owed) DESC, vendor_name, payment_terms LIMIT 10""",
    "FIN3": f"""
        SELECT vendor_name, vendor_category,
               count(*) FILTER (WHERE has_discount) AS jumlah_line_diskon,
               count(*) AS jumlah_line_total,
               {percent('count(*) FILTER (WHERE has_discount)', 'count(*)', 1)}
                   AS pct_line_diskon,
               {units(_DISCOUNT, BILLION)} AS total_diskon_miliar_idr,
               {mean('discount_pct', 2)} AS avg_discount_pct
        FROM kept JOIN dim_vendors USING (vendor_sk) GROUP BY vendor_name, vendor_category
        HAVING jumlah_line_diskon > 0
        ORDER BY jumlah_line_diskon DESC, {_DISCOUNT} DESC, vendor_name, vendor_category
        LIMIT 10""",
    "FIN4": f"""
        SELECT item_category, {units(_RECEIVED, BILLION)} AS spend_miliar_idr,
               {percent(_RECEIVED, f'(SELECT {_RECEIVED} FROM kept JOIN dim_items USING (item_sk))',
                        1)} AS pct_total_spend,
               count(DISTINCT po_id) AS jumlah_po, count(*) AS jumlah_line
        FROM kept JOIN dim_items USING (item_sk) GROUP BY item_category""",
    "FIN5": f"""
        WITH months AS (
            SELECT po_year_month AS tahun_bulan, department_name, {_NET} AS spend
            FROM kept JOIN dim_departments USING (department_sk) GROUP BY ALL),
        scored AS (
            SELECT *, sum(spend) OVER w AS total, count(*) OVER w AS n,
                   CAST(sum(spend) OVER w AS DOUBLE) / count(*) OVER w AS average,
                   nullif(stddev_pop(CAST(spend AS DOUBLE)) OVER w, 0) AS deviation
            FROM months WINDOW w AS (PARTITION BY department_name))
        SELECT tahun_bulan, department_name, {units('spend', BILLION)} AS spend_miliar_idr,
               {ratio('total', f'n * {10**BILLION}', 2)} AS baseline_miliar_idr,
               round((spend - average) / deviation, 2) AS z_score_proxy
        FROM scored WHERE spend > average + 2 * coalesce(deviation, average)
        ORDER BY z_score_proxy DESC NULLS LAST, spend DESC, tahun_bulan, department_name
        LIMIT 10""",
    "OPS1": f"""
        WITH quarters AS (
            SELECT year_quarter, vendor_name, count(*) AS jumlah_line_gr,
                   {_FULFILMENT} AS avg_fulfillment_pct, {_PUNCTUAL} AS pct_on_time,
                   {mean('lead_time_variance_days', 1)} AS avg_variance_days, {_NET} AS net
            FROM kept JOIN dim_date ON date_key_po_date = date_key
                 JOIN dim_vendors USING (vendor_sk)
            WHERE has_goods_receipt GROUP BY year_quarter, vendor_name)
        SELECT year_quarter, vendor_name, jumlah_line_gr, avg_fulfillment_pct, pct_on_time,
               lag(pct_on_time) OVER (PARTITION BY vendor_name ORDER BY year_quarter)
                   AS prev_q_pct_on_time,
               avg_variance_days, {units('net', BILLION)} AS total_neto_miliar_idr
        FROM quarters ORDER BY year_quarter DESC, net DESC, vendor_name LIMIT 15""",
    "OPS2": f"""
        WITH pairs AS (
            SELECT item_category, item_name, vendor_name, count(*) AS lines, {_NET} AS spend
            FROM kept JOIN dim_items USING (item_sk) JOIN dim_vendors v USING (vendor_sk)
            GROUP BY item_category, item_name, vendor_name),
        ranked AS (
            SELECT *, count(*) OVER i AS vendors, sum(spend) OVER i AS total,
                   row_number() OVER (PARTITION BY item_category, item_name
                                      ORDER BY spend DESC, vendor_name) AS place
            FROM pairs WINDOW i AS (PARTITION BY item_category, item_name))
        SELECT item_category, item_name, vendor_name AS vendor_dominan,
               vendors AS jumlah_vendor_item, lines AS jumlah_line,
               {units('spend', BILLION)} AS vendor_spend_miliar_idr,
               {percent('spend', 'total', 1)} AS pct_spend_item,
               CASE WHEN vendors = 1 THEN 'Single Source'
                    WHEN spend * 100 >= nullif(total, 0) * 70 THEN 'Risiko Tinggi'
                    WHEN spend * 100 >= nullif(total, 0) * 50 THEN 'Risiko Sedang'
                    ELSE 'Tersebar' END AS tingkat_risiko
        FROM ranked WHERE place = 1
        ORDER BY CAST(spend AS DOUBLE) / CAST(nullif(total, 0) AS DOUBLE) DESC NULLS LAST,
                 spend DESC, item_category, item_name LIMIT 10""",
    "OPS3": f"""
        SELECT vendor_name, item_category, count(*) AS jumlah_line,
               {units(_SAVED, BILLION)} AS savings_proxy_miliar_idr,
               {units(_LISTED, BILLION)} AS nilai_referensi_miliar_idr,
               {units(_NET, BILLION)} AS nilai_negosiasi_miliar_idr,
               {percent(_SAVED, _LISTED, 1)} AS pct_savings_proxy
        FROM kept JOIN dim_items USING (item_sk) JOIN dim_vendors v USING (vendor_sk)
        GROUP BY vendor_name, item_category
        ORDER BY {_SAVED} DESC, vendor_name, item_category LIMIT 10""",
    "OPS4": f"""
        SELECT department_name, location, count(DISTINCT pr_id) AS jumlah_pr_proxy,
               count(DISTINCT po_id) AS jumlah_po, count(*) AS jumlah_line,
               {units(_NET, BILLION)} AS total_ordered_miliar_idr
        FROM kept JOIN dim_departments USING (department_sk) GROUP BY department_name, location
        ORDER BY jumlah_pr_proxy DESC, {_NET} DESC, department_name, location LIMIT 10""",
    "WH1": f"""
        SELECT strftime(gr_date, '%Y-%m') AS tahun_bulan_gr, i.item_category, i.item_name,
               f.unit_of_measure,
               CAST(sum(quantity_received_calc) AS BIGINT) AS total_qty_diterima,
               count(*) AS jumlah_line_gr, {units(_RECEIVED, BILLION)} AS nilai_diterima_miliar_idr
        FROM kept f JOIN dim_items i USING (item_sk) WHERE has_goods_receipt
        GROUP BY ALL
        ORDER BY tahun_bulan_gr DESC, total_qty_diterima DESC, i.item_category, i.item_name,
                 f.unit_of_measure LIMIT 15""",
    "WH2": f"""
        SELECT item_category, item_name, receipt_status, shortage_severity,
               count(*) AS jumlah_line,
               CAST(sum(quantity_ordered) AS BIGINT) AS total_qty_dipesan,
               CAST(sum(quantity_received_calc) AS BIGINT) AS total_qty_diterima,
               CAST(sum(quantity_variance_gr) AS BIGINT) AS total_variance_gr,
               {_FULFILMENT} AS avg_fulfillment_pct,
               {units('sum(value_shortfall_idr)', BILLION)} AS shortfall_miliar_idr
        FROM kept JOIN dim_items USING (item_sk)
        WHERE has_goods_receipt AND quantity_variance_gr <> 0
        GROUP BY item_category, item_name, receipt_status, shortage_severity
        ORDER BY abs(sum(quantity_variance_gr)) DESC, sum(value_shortfall_idr) DESC,
                 item_category, item_name, receipt_status, shortage_severity LIMIT 15""",
    "WH3": f"""
        SELECT item_category, item_name,
               count(*) FILTER (WHERE is_short_delivery) AS jumlah_short_delivery,
               count(*) FILTER (WHERE NOT is_on_time) AS jumlah_terlambat,
               CAST(sum(unfulfilled_qty) AS BIGINT) AS total_unfulfilled_qty,
               {mean('lead_time_variance_days', 1)} AS avg_delay_days,
               {units('sum(value_shortfall_idr)', BILLION)} AS value_shortfall_miliar_idr
        FROM kept JOIN dim_items USING (item_sk)
        WHERE has_goods_receipt AND (is_short_delivery OR NOT is_on_time)
        GROUP BY item_category, item_name
        ORDER BY sum(unfulfilled_qty) DESC, avg(lead_time_variance_days) DESC NULLS LAST,
                 item_category, item_name LIMIT 15""",
}

_RAW_NAMES = {
    "departments": 9, "vendors": 18, "items": 11, "purchase_requests": 15, "purchase_orders": 16,
    "purchase_order_lines": 14, "goods_receipts": 21,
}


def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


_DOCUMENTS = {
    "G1": "SELECT po_id, total_amount FROM raw_purchase_orders",
    "G2": "SELECT pr_id, total_amount FROM raw_purchase_requests",
    "G3": """
        SELECT 'requests' AS kind, pr_id AS id FROM raw_purchase_requests
        WHERE status = 'Disetujui'
        UNION ALL SELECT 'vendors', vendor_id FROM raw_vendors WHERE is_active
        UNION ALL SELECT 'items', item_id FROM raw_items WHERE is_active""",
    "G4": """
        SELECT line_id, po_id FROM raw_purchase_order_lines
        WHERE po_id IN (SELECT po_id FROM raw_purchase_orders
                        WHERE status IN ('Selesai', 'Sebagian Diterima'))""",
    "G5": """
        SELECT pr_id FROM (
            SELECT pr_id, row_number() OVER (ORDER BY md5('42|' || pr_id), pr_id) AS place,
                   count(*) OVER () AS available
            FROM raw_purchase_requests WHERE status = 'Disetujui')
        WHERE place <= available // 2""",
    "G5_replacement": """
        WITH approved AS (
            SELECT pr_id, row_number() OVER (ORDER BY md5('42|' || pr_id), pr_id) - 1 AS place,
                   count(*) OVER () AS available
            FROM raw_purchase_requests WHERE status = 'Disetujui'),
        draws AS (
            SELECT CAST('0x' || substr(md5('42|draw|' || (j - 1)), 1, 15) AS BIGINT) AS drawn
            FROM (SELECT row_number() OVER () AS j FROM raw_purchase_orders))
        SELECT pr_id, count(*) AS times
        FROM draws JOIN approved ON place = drawn % (SELECT max(available) FROM approved)
        GROUP BY pr_id""",
    "G6": f"""
        SELECT {typed("gr_id:i quantity_variance:i variance_pct:d receipt_status:s "
                      "lead_time_days:i is_on_time:b")}
        FROM (SELECT * REPLACE (measured_pct AS variance_pct) FROM raw_goods_receipts)""",
    "G7": """
        SELECT 'PR' AS kind, pr_id AS id, pr_number AS number FROM raw_purchase_requests
        UNION ALL SELECT 'PO', po_id, po_number FROM raw_purchase_orders
        UNION ALL SELECT 'GR', gr_id, gr_number FROM raw_goods_receipts""",
    "G8": """
        SELECT 'status' AS "column", status AS value, count(*) AS "rows"
        FROM raw_purchase_orders WHERE status IS NOT NULL GROUP BY status
        UNION ALL SELECT 'receipt_status', receipt_status, count(*)
        FROM raw_goods_receipts WHERE receipt_status IS NOT NULL GROUP BY receipt_status""",
    "G9": f"""
        SELECT min(lead_time_days) AS lead_min,
               CAST(median(lead_time_days) AS DOUBLE) AS lead_median,
               {mean('lead_time_days', 1)} AS lead_mean, max(lead_time_days) AS lead_max,
               {percent('count(*) FILTER (WHERE is_on_time)', 'count(is_on_time)', 1)}
                   AS on_time_pct,
               CAST(min(variance_pct) AS DOUBLE) AS variance_min,
               {mean('variance_pct', 2, scale=2)} AS variance_mean,
               CAST(max(variance_pct) AS DOUBLE) AS variance_max
        FROM (SELECT * REPLACE (round(CAST(CAST(variance_pct AS VARCHAR) AS DECIMAL(38, 18)), 2)
                                    AS variance_pct) FROM raw_goods_receipts)""",
    "G10": "WITH shapes AS (" + _union(
        f"SELECT '{name}' AS \"table\", (SELECT count(*) FROM raw_{name}) AS n, {columns} AS c"
        for name, columns in _RAW_NAMES.items()
    ) + """)
        SELECT coalesce("table", 'GRAND TOTAL') AS "table", CAST(sum(n) AS BIGINT) AS "rows",
               CAST(sum(c) AS BIGINT) AS "columns"
        FROM shapes GROUP BY ROLLUP ("table")""",
    "V6": _union(
        f"""SELECT '{name}' AS "table", CAST(max({stamp(name)}) AS VARCHAR) AS newest,
                   date_diff('second', max({stamp(name)}), TIMESTAMP '2025-01-02 06:00:00') // 3600
                       AS age_hours,
                   CASE WHEN age_hours > 49 THEN 'error' WHEN age_hours > 25 THEN 'warn' ELSE 'pass' END
                       AS status
            FROM raw_{name} HAVING count(*) > 0"""
        for name in _RAW_NAMES
    ),
}

# Columns of each raw table by kind of cell.
_CELLS = {
    "departments": "department_id:i department_code:s department_name:s cost_center:s location:s "
                   "manager_name:s budget_annual:i created_at:t",
    "vendors": "vendor_id:i vendor_code:s vendor_name:s vendor_category:s vendor_type:s address:s "
               "city:s province:s postal_code:i phone:s email:s npwp:s payment_terms:s rating:d "
               "is_active:b registered_date:t created_at:t",
    "items": "item_id:i item_code:s item_name:s item_category:s unit_of_measure:s unit_price:i "
             "min_order_qty:i lead_time_days:i is_active:b created_at:t",
    "purchase_requests": "pr_id:i pr_number:s pr_date:t department_id:i requester_name:s "
                         "requester_email:s purpose:s priority:s status:s approved_by:s "
                         "approval_date:t notes:s created_at:t total_amount:i",
    "purchase_orders": "po_id:i po_number:s po_date:t pr_id:i vendor_id:i department_id:i "
                       "expected_delivery_date:t payment_terms:s status:s shipping_address:s "
                       "approved_by:s approval_date:t notes:s created_at:t total_amount:i",
    "purchase_order_lines": "line_id:i po_id:i item_id:i line_number:i quantity_ordered:i "
                            "unit_of_measure:s unit_price:i discount_pct:i total_price:i "
                            "delivery_date_expected:t line_status:s notes:s created_at:t",
    "goods_receipts": "gr_id:i gr_number:s gr_date:t po_id:i po_line_id:i item_id:i "
                      "quantity_ordered:i quantity_received:i quantity_variance:i variance_pct:d "
                      "receipt_status:s lead_time_days:i is_on_time:b unit_price:d "
                      "total_received_value:i warehouse_location:s received_by:s "
                      "inspection_status:s notes:s created_at:t",
}


def _names(table: str, kinds: str) -> list[str]:
    return [pair.split(":")[0] for pair in _CELLS[table].split() if pair.split(":")[1] in kinds]


def _loaded(table: str) -> str:
    """Measures of one table after its way through CSV: missing cells, characters, key figures."""
    missing = " + ".join(f"count(*) - count({name})" for name in _names(table, "sidbt"))
    chars = " + ".join(f"coalesce(sum(length({name})), 0)" for name in _names(table, "s"))
    whole = " + ".join(f"coalesce(sum({name} % 1000003), 0)" for name in _names(table, "i"))
    return (
        f"SELECT '{table}' AS \"table\", count(*) AS n, {missing} AS missing, {chars} AS chars, "
        f"{whole} AS whole FROM raw_{table}"
    )


_DOCUMENTS["S1"] = "WITH loads AS (" + _union(_loaded(name) for name in _RAW_NAMES) + """)
    SELECT coalesce("table", 'GRAND TOTAL') AS "table", CAST(sum(n) AS BIGINT) AS "rows",
           CAST(0 AS BIGINT) AS bad_rows, 'OK' AS status, CAST(sum(missing) AS BIGINT) AS missing,
           CAST(sum(chars) AS BIGINT) AS chars, CAST(sum(whole) AS BIGINT) AS whole,
           '2025-01-01 00:00:00' AS ingested_at
    FROM loads GROUP BY ROLLUP ("table")"""


def _type_of(table: str, name: str) -> str:
    """The type rule of S3 for one column, over all its values."""

    def every(pattern: str) -> str:
        return f"coalesce(bool_and(regexp_matches(v, '{pattern}')), false)"

    return f"""
        SELECT '{table}' AS "table", '{name}' AS "column",
               CASE WHEN count(v) = 0 THEN 'DOUBLE PRECISION'
                    WHEN {every('^(True|False|TRUE|FALSE|true|false)$')} AND count(v) = count(*)
                    THEN 'BOOLEAN'
                    WHEN {every('^[+-]?[0-9]+$')} AND count(v) = count(*) THEN 'BIGINT'
                    WHEN {every('^[+-]?[0-9]+([.][0-9]*)?$')} THEN 'DOUBLE PRECISION'
                    WHEN {every('^[0-9]{4}-[0-9]{2}-[0-9]{2}$')} THEN 'DATE'
                    ELSE 'TEXT' END AS "type"
        FROM (SELECT CAST({name} AS VARCHAR) AS v FROM raw_{table})"""


_DOCUMENTS["S3"] = _union(
    [_type_of(table, name) for table in _RAW_NAMES for name in _names(table, "idsbt")]
    + [f"SELECT '{table}', '_ingested_at', 'TEXT' FROM raw_{table} HAVING count(*) > 0" for table in _RAW_NAMES]
)


def statements() -> dict[str, str]:
    from oracle.checks import CHECKS

    everything = {**_ROW, **_ANALYTIC, **_STAKEHOLDER, **_DOCUMENTS, **CHECKS}
    return {key: with_tables(sql) for key, sql in everything.items()}

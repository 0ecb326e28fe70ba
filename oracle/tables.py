"""Common table expressions from the given tables to the fact, in dependency order."""

from __future__ import annotations

from oracle.text import pick, zero_filled

_DAY = "CAST(o_orderdate AS DATE) + 8401"
_TERMS = ("Net 15", "Net 30", "Net 45", "Net 60", "COD", "DP 50%")
_UNITS = ("Pcs", "Unit", "Box", "Set", "Kg")
_NOTES = (None, "  ", " catatan ")

# Day and key of each raw table's load stamps; the hour is the key's remainder by 24.
STAMPS = {
    "departments": ("2025-01-01", "department_id"),
    "vendors": ("2024-12-31", "vendor_id"),
    "items": ("2025-01-01", "item_id"),
    "purchase_requests": ("2024-12-30", "pr_id"),
    "purchase_orders": ("2025-01-01", "po_id"),
    "purchase_order_lines": ("2025-01-01", "line_id"),
    "goods_receipts": ("2024-12-31", "gr_id"),
}


def stamp(table: str) -> str:
    day, key = STAMPS[table]
    return f"(TIMESTAMP '{day} 00:00:00' + to_hours(CAST({key} % 24 AS INTEGER)))"


def _flag(condition: str) -> str:
    return f"coalesce({condition}, false)"


_RAW = {
    "raw_departments": f"""
        SELECT CAST(n_nationkey AS BIGINT) + 1 AS department_id,
               'DEPT' || {zero_filled('n_nationkey + 1', 3)} AS department_code,
               CASE WHEN n_nationkey % 23 = 22 THEN '   ' ELSE ' ' || n_name || ' ' END
                   AS department_name,
               'CC' || {zero_filled('(n_nationkey + 1) * 100', 6)} AS cost_center,
               r_name AS location, 'Manager ' || (n_nationkey + 1) AS manager_name,
               200000000 + CAST(n_nationkey AS BIGINT) * 400000000 AS budget_annual,
               DATE '2018-01-01' + n_nationkey AS created_at
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "raw_vendors": f"""
        SELECT s_suppkey + 1 AS vendor_id,
               'VND' || {zero_filled('s_suppkey + 1', 9)} AS vendor_code,
               CASE WHEN s_suppkey % 41 = 5 THEN ' ' ELSE 'PT ' || s_name ||
                   {pick('s_suppkey % 4', ' Tbk.', ' PT Tbk', '', ' (Persero) Tbk')} END
                   AS vendor_name,
               {pick('s_suppkey % 6', 'ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD')}
                   AS vendor_category,
               {pick('s_suppkey % 3', 'Barang', 'Jasa', 'Barang & Jasa')} AS vendor_type,
               'Jl. ' || (s_suppkey + 1) AS address, n_name AS city, r_name AS province,
               (s_suppkey * 7919) % 100000 AS postal_code, '0' || (s_suppkey + 1) AS phone,
               ' Sales' || (s_suppkey + 1) || '@Example.COM ' AS email,
               {zero_filled('s_suppkey + 1', 15)} AS npwp,
               {pick('s_suppkey % 6', *_TERMS)} AS payment_terms,
               (25 + s_suppkey % 26) / 10.0 AS rating, s_suppkey % 12 <> 0 AS is_active,
               DATE '2018-01-01' + CAST((s_suppkey * 37) % 2000 AS INTEGER) AS registered_date,
               registered_date AS created_at
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
                      JOIN region ON n_regionkey = r_regionkey""",
    "raw_items": f"""
        SELECT p_partkey + 1 AS item_id, 'ITM' || {zero_filled('p_partkey + 1', 9)} AS item_code,
               CASE WHEN p_partkey % 211 = 7 THEN '  ' ELSE p_name || ' #' || p_partkey END
                   AS item_name,
               p_type AS item_category, {pick('p_size % 5', *_UNITS)} AS unit_of_measure,
               CAST(floor(p_retailprice * p_size * p_size) AS BIGINT) AS unit_price,
               list_extract([1, 2, 5, 10, 12, 24], p_size % 6 + 1) AS min_order_qty,
               1 + p_size % 14 AS lead_time_days, p_partkey % 20 <> 0 AS is_active,
               DATE '2018-01-01' AS created_at
        FROM part""",
    "base_orders": f"""
        SELECT o_orderkey + 1 AS po_id,
               CASE WHEN o_orderkey % 997 <> 0 THEN {_DAY} END AS po_date,
               'PO-' || strftime(po_date, '%Y%m') || '-' || {zero_filled('o_orderkey + 1', 9)}
                   AS po_number,
               CASE WHEN o_orderkey % 10 = 3 THEN o_orderkey ELSE o_orderkey + 1 END AS pr_id,
               o_custkey % (SELECT count(*) FROM supplier) + 1 AS vendor_id,
               o_custkey % (SELECT count(*) FROM nation) + 1 AS department_id,
               po_date + CAST(3 + o_orderkey % 28 AS INTEGER) AS expected_delivery_date,
               {pick('o_custkey % 6', *_TERMS)} AS payment_terms,
               CASE o_orderstatus WHEN 'F' THEN 'Selesai' WHEN 'P' THEN 'Sebagian Diterima'
                   ELSE CASE WHEN o_orderkey % 5 < 2 THEN 'Dibatalkan' ELSE 'Terbuka' END END
                   AS status,
               'Gudang ' || (o_custkey % 12) AS shipping_address,
               ' Approver ' || (o_orderkey % 40) AS approved_by,
               po_date + CAST(o_orderkey % 4 AS INTEGER) AS approval_date,
               {pick('o_orderkey % 3', *_NOTES)} AS notes, {_DAY} AS created_at
        FROM orders WHERE o_orderkey % 10 >= 2""",
    "base_lines": f"""
        SELECT ((l_orderkey + 1) * 10 + l_linenumber) * (SELECT max(p_partkey) + 1 FROM part) + part
                   AS line_id,
               l_orderkey + 1 AS po_id,
               part + 1 AS item_id, CAST(l_linenumber AS BIGINT) AS line_number, part,
               CASE WHEN (part + l_orderkey) % 97 = 0 THEN 0 ELSE quantity END AS quantity_ordered,
               {pick('part % 5', *_UNITS)} AS unit_of_measure, cents // quantity AS unit_price,
               discount + discount // 2 AS discount_pct,
               unit_price * quantity_ordered AS total_price,
               {pick('part % 3', *_NOTES)} AS notes
        FROM (SELECT l_orderkey, l_linenumber, l_partkey AS part,
                     CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
                     CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents,
                     max(CAST(round(l_discount * 100) AS BIGINT)) AS discount
              FROM lineitem GROUP BY ALL)""",
    "raw_purchase_orders": """
        SELECT o.*, CAST(coalesce(t.total, 0) AS BIGINT) AS total_amount
        FROM base_orders o LEFT JOIN
             (SELECT po_id, sum(total_price) AS total FROM base_lines GROUP BY po_id) t
             USING (po_id)""",
    "base_requests": f"""
        SELECT o_orderkey + 1 AS pr_id,
               {_DAY} - CAST(3 + o_orderkey % 12 AS INTEGER) AS pr_date,
               'PR-' || strftime(pr_date, '%Y%m') || '-' || {zero_filled('o_orderkey + 1', 9)}
                   AS pr_number,
               o_custkey % (SELECT count(*) FROM nation) + 1 AS department_id,
               'Requester ' || o_custkey AS requester_name,
               ' R' || o_custkey || '@Example.COM ' AS requester_email,
               o_orderpriority AS purpose,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Mendesak' WHEN '2-HIGH' THEN 'Tinggi'
                   WHEN '3-MEDIUM' THEN 'Sedang' ELSE 'Rendah' END AS priority,
               CASE o_orderkey % 10 WHEN 0 THEN 'Ditolak' WHEN 1 THEN 'Pending Approval'
                   ELSE 'Disetujui' END AS status,
               CASE WHEN status = 'Disetujui' THEN ' Approver ' || (o_orderkey % 40) END
                   AS approved_by,
               CASE WHEN status = 'Disetujui' THEN pr_date + CAST(1 + o_orderkey % 7 AS INTEGER)
                   END AS approval_date,
               {pick('o_orderkey % 3', *_NOTES)} AS notes, pr_date AS created_at
        FROM orders""",
    "raw_purchase_requests": """
        SELECT r.*, CAST(coalesce(t.total, 0) AS BIGINT) AS total_amount
        FROM base_requests r LEFT JOIN
             (SELECT pr_id, sum(total_amount) AS total FROM raw_purchase_orders GROUP BY pr_id) t
             USING (pr_id)""",
    "ordered_lines": """
        SELECT l.*, o.po_date, o.expected_delivery_date, o.status, o.created_at
        FROM base_lines l JOIN base_orders o USING (po_id)""",
    "raw_purchase_order_lines": """
        SELECT line_id, po_id, item_id, line_number, quantity_ordered, unit_of_measure,
               unit_price, discount_pct, total_price,
               expected_delivery_date AS delivery_date_expected, status AS line_status, notes,
               created_at
        FROM ordered_lines""",
    "receipt_seeds": """
        SELECT *, quantity_ordered AS q,
               (part * 31 + (po_id - 1) * 17 + line_number * 7) % 100 AS h,
               (part * 13 + line_number * 5) % 100 AS k,
               CASE WHEN k < 72 THEN CASE WHEN po_date IS NOT NULL THEN
                        greatest(po_date + 1, expected_delivery_date - CAST(k % 4 AS INTEGER)) END
                    ELSE expected_delivery_date + CAST(1 + k % 45 AS INTEGER) END AS arrived
        FROM ordered_lines WHERE status IN ('Selesai', 'Sebagian Diterima')""",
    "receipt_rows": """
        SELECT *, line_id * 10 + 2 AS gr_id, arrived AS gr_date,
               CASE WHEN (h * k) % 199 = 198 THEN -1 WHEN h < 55 THEN q
                    WHEN h < 75 THEN greatest(1, q * 95 // 100)
                    WHEN h < 90 THEN greatest(1, q * 80 // 100)
                    WHEN h < 97 THEN greatest(1, q * 60 // 100)
                    ELSE q * 110 // 100 END AS quantity_received
        FROM receipt_seeds
        UNION ALL
        SELECT *, line_id * 10 + 1, CASE WHEN h % 20 = 0 THEN arrived ELSE arrived - 1 END, q // 2
        FROM receipt_seeds WHERE h % 10 = 0""",
    "raw_goods_receipts": f"""
        SELECT gr_id,
               'GR-' || strftime(gr_date, '%Y%m') || '-' || {zero_filled('gr_id', 10)}
                   AS gr_number,
               gr_date, po_id, line_id AS po_line_id, item_id, quantity_ordered,
               quantity_received, quantity_received - q AS quantity_variance,
               CASE WHEN q > 0 THEN CAST(sign(quantity_variance) *
                   ((abs(quantity_variance) * 20000 + q) // (2 * q)) AS DOUBLE) / 100 END
                   AS measured_pct,
               CASE WHEN h % 17 = 3 THEN measured_pct + CAST(0.0049999996 AS DOUBLE)
                    ELSE measured_pct END AS variance_pct,
               CASE WHEN quantity_variance = 0 THEN 'Lengkap'
                    WHEN quantity_variance > 0 THEN 'Lebih'
                    WHEN -quantity_variance * 10 <= q THEN 'Kurang'
                    WHEN -quantity_variance * 4 <= q THEN 'Kurang Signifikan'
                    ELSE 'Barang Sangat Kurang' END AS receipt_status,
               CAST(gr_date - po_date AS BIGINT) AS lead_time_days,
               gr_date <= expected_delivery_date AS is_on_time,
               unit_price * 100000 + part % 7 * 4 AS price_units,
               CAST(unit_price * quantity_received AS BIGINT) AS total_received_value,
               CAST(price_units AS DOUBLE) / 100000 AS unit_price,
               {pick('h % 8', 'WH-A01', 'WH-A02', 'WH-A03', 'WH-B01', 'WH-B02', 'WH-C01',
                     'WH-C02', 'WH-D01')} AS warehouse_location,
               'Clerk ' || (part % 50) AS received_by,
               CASE WHEN h % 14 = 0 THEN 'Ditolak' WHEN h % 14 <= 2 THEN 'Perlu Pemeriksaan Ulang'
                    ELSE 'Lulus' END AS inspection_status,
               {pick('part % 3', *_NOTES)} AS notes, gr_date AS created_at
        FROM receipt_rows""",
}

_STAGED = {
    "s_departments": f"""
        SELECT department_id, department_code, trim(department_name) AS department_name,
               cost_center, location, manager_name, budget_annual AS budget_annual_idr,
               created_at, {stamp('departments')} AS loaded_at
        FROM raw_departments WHERE trim(department_name) <> ''""",
    "s_vendors": f"""
        SELECT vendor_id, vendor_code, trim(vendor_name) AS vendor_name, vendor_category,
               vendor_type, address, city, province,
               lpad(CAST(postal_code AS VARCHAR), 5, '0') AS postal_code, phone,
               lower(trim(email)) AS email, npwp, payment_terms, rating AS vendor_rating,
               is_active, vendor_type <> 'Jasa' AS is_goods_vendor,
               vendor_type <> 'Barang' AS is_service_vendor, registered_date, created_at, {stamp('vendors')} AS loaded_at
        FROM raw_vendors WHERE trim(vendor_name) <> ''""",
    "s_items": f"""
        SELECT item_id, item_code, trim(item_name) AS item_name, item_category, unit_of_measure,
               unit_price AS unit_price_idr, min_order_qty, lead_time_days, is_active,
               CASE WHEN unit_price < 100000 THEN 'Murah' WHEN unit_price > 1000000 THEN 'Mahal'
                    ELSE 'Menengah' END AS price_tier,
               lead_time_days <= 3 AS is_fast_moving, created_at, {stamp('items')} AS loaded_at
        FROM raw_items WHERE trim(item_name) <> ''""",
    "s_purchase_requests": f"""
        SELECT pr_id, pr_number, pr_date, year(pr_date) AS pr_year, month(pr_date) AS pr_month,
               strftime(pr_date, '%Y-%m') AS pr_year_month, department_id, requester_name,
               lower(trim(requester_email)) AS requester_email, purpose, priority,
               status AS pr_status, trim(approved_by) AS approved_by, approval_date,
               status = 'Disetujui' AS is_approved, status = 'Ditolak' AS is_rejected,
               status = 'Pending Approval' AS is_pending,
               approval_date - pr_date AS approval_lead_days, total_amount AS total_amount_idr,
               nullif(trim(notes), '') AS notes, created_at, {stamp('purchase_requests')} AS loaded_at
        FROM raw_purchase_requests WHERE pr_date IS NOT NULL""",
    "s_purchase_orders": f"""
        SELECT po_id, po_number, po_date, year(po_date) AS po_year, month(po_date) AS po_month,
               strftime(po_date, '%Y-%m') AS po_year_month, pr_id, vendor_id, department_id,
               expected_delivery_date,
               expected_delivery_date - po_date AS expected_lead_time_days, payment_terms,
               status AS po_status, shipping_address, trim(approved_by) AS approved_by,
               approval_date, approval_date - po_date AS approval_lag_days,
               status = 'Terbuka' AS is_open, status = 'Sebagian Diterima' AS is_partial,
               status = 'Selesai' AS is_completed, status = 'Dibatalkan' AS is_cancelled,
               status IN ('Terbuka', 'Sebagian Diterima') AS is_active_po,
               total_amount AS total_amount_idr, nullif(trim(notes), '') AS notes, created_at,
               {stamp('purchase_orders')} AS loaded_at
        FROM raw_purchase_orders WHERE po_date IS NOT NULL""",
    "s_purchase_order_lines": f"""
        SELECT line_id, po_id, item_id, line_number, quantity_ordered, unit_of_measure,
               unit_price AS unit_price_idr, discount_pct,
               (unit_price * (100 - discount_pct) + 50) // 100 AS net_unit_price_idr,
               total_price AS gross_total_price_idr,
               (unit_price * quantity_ordered * (100 - discount_pct) + 50) // 100
                   AS net_total_price_idr,
               (unit_price * quantity_ordered * discount_pct + 50) // 100 AS discount_amount_idr,
               discount_pct > 0 AS has_discount,
               CASE WHEN discount_pct = 0 THEN 'Tanpa Diskon' WHEN discount_pct <= 5
                    THEN 'Diskon Kecil' WHEN discount_pct <= 10 THEN 'Diskon Sedang'
                    ELSE 'Diskon Besar' END AS discount_tier,
               delivery_date_expected, line_status, nullif(trim(notes), '') AS notes, created_at,
               {stamp('purchase_order_lines')} AS loaded_at
        FROM raw_purchase_order_lines WHERE quantity_ordered > 0""",
    "s_goods_receipts": f"""
        SELECT gr_id, gr_number, gr_date, year(gr_date) AS gr_year, month(gr_date) AS gr_month,
               strftime(gr_date, '%Y-%m') AS gr_year_month, po_id, po_line_id, item_id,
               quantity_ordered, quantity_received, quantity_variance,
               round(CAST(CAST(variance_pct AS VARCHAR) AS DECIMAL(38, 18)), 2) AS variance_pct,
               CASE WHEN quantity_ordered > 0 THEN ((quantity_received * 20000 + quantity_ordered)
                    // (2 * quantity_ordered)) / 100.0 END AS quantity_fulfillment_pct,
               receipt_status, lead_time_days, is_on_time,
               CASE WHEN is_on_time THEN 'Tepat Waktu'
                    WHEN lead_time_days <= 7 THEN 'Terlambat ≤1 Minggu'
                    WHEN lead_time_days <= 14 THEN 'Terlambat ≤2 Minggu'
                    WHEN lead_time_days <= 30 THEN 'Terlambat ≤1 Bulan'
                    ELSE 'Terlambat >1 Bulan' END AS delivery_timeliness,
               quantity_variance < 0 AS is_short_delivery,
               quantity_variance > 0 AS is_over_delivery,
               quantity_variance = 0 AS is_full_delivery,
               CASE WHEN quantity_variance >= 0 THEN 'Tidak Ada Kekurangan'
                    WHEN abs(quantity_variance) * 10 <= nullif(quantity_ordered, 0)
                    THEN 'Kurang Ringan (<10%)'
                    WHEN abs(quantity_variance) * 4 <= nullif(quantity_ordered, 0)
                    THEN 'Kurang Sedang (10–25%)'
                    ELSE 'Kurang Parah (>25%)' END AS shortage_severity,
               unit_price AS unit_price_idr, total_received_value AS total_received_value_idr,
               (2 * greatest(-quantity_variance, 0) * price_units + 100000) // 200000
                   AS shortage_value_idr,
               warehouse_location, received_by, inspection_status,
               inspection_status = 'Ditolak' AS is_rejected_by_inspection,
               inspection_status = 'Perlu Pemeriksaan Ulang' AS needs_reinspection,
               nullif(trim(notes), '') AS notes, created_at, {stamp('goods_receipts')} AS loaded_at
        FROM raw_goods_receipts WHERE gr_date IS NOT NULL AND quantity_received >= 0""",
}

_MONTHS = ("Januari", "Februari", "Maret", "April", "Mei", "Juni", "Juli", "Agustus",
           "September", "Oktober", "November", "Desember")
_DAYS = ("Senin", "Selasa", "Rabu", "Kamis", "Jumat", "Sabtu", "Minggu")
_SHORT = ("Sen", "Sel", "Rab", "Kam", "Jum", "Sab", "Min")

_MARTS = {
    "dim_date": f"""
        SELECT year(d) * 10000 + month(d) * 100 + day(d) AS date_key, d AS full_date,
               strftime(d, '%d ') || rpad(monthname(d), 9, ' ') || strftime(d, ' %Y')
                   AS date_label,
               year(d) AS year, isoyear(d) AS iso_year, quarter(d) AS quarter_number,
               'Q' || quarter(d) AS quarter_label,
               year(d) || '-Q' || quarter(d) AS year_quarter, month(d) AS month_number,
               strftime(d, '%b') AS month_short_en, {pick('month(d) - 1', *_MONTHS)}
                   AS month_name_id,
               strftime(d, '%Y-%m') AS year_month, weekofyear(d) AS week_of_year,
               isoyear(d) || '-W' || {zero_filled('weekofyear(d)', 2)} AS year_week,
               day(d) AS day_of_month, dayofyear(d) AS day_of_year,
               dayofweek(d) AS day_of_week_sun0, isodow(d) AS day_of_week_iso,
               {pick('isodow(d) - 1', *_DAYS)} AS day_name_id,
               {pick('isodow(d) - 1', *_SHORT)} AS day_short_id,
               isodow(d) >= 6 AS is_weekend, isodow(d) < 6 AS is_weekday,
               day(d) = 1 AS is_first_day_of_month, day(d + 1) = 1 AS is_last_day_of_month,
               day(d + 1) = 1 AND month(d) % 3 = 0 AS is_last_day_of_quarter,
               dayofyear(d) = 1 AS is_first_day_of_year,
               dayofyear(d + 1) = 1 AS is_last_day_of_year,
               year(d) AS fiscal_year, quarter(d) AS fiscal_quarter, month(d) AS fiscal_month
        FROM (SELECT CAST(unnest(range(DATE '2018-01-01', DATE '2028-01-01', INTERVAL 1 DAY))
                          AS DATE) AS d)""",
    "dim_departments": """
        SELECT md5(CAST(department_id AS VARCHAR)) AS department_sk, *,
               CASE WHEN budget_annual_idr >= 5000000000 THEN 'Anggaran Besar'
                    WHEN budget_annual_idr >= 1000000000 THEN 'Anggaran Menengah'
                    ELSE 'Anggaran Kecil' END AS budget_tier
        FROM s_departments""",
    "dim_items": """
        SELECT md5(CAST(item_id AS VARCHAR)) AS item_sk, *,
               unit_price_idr AS current_unit_price_idr,
               lead_time_days AS standard_lead_time_days, loaded_at AS last_updated_at
        FROM s_items""",
    "vendor_versions": """
        SELECT * REPLACE (regexp_replace(vendor_name, ' (Tbk\\.?|PT )', ' ') || ' (Versi Lama)'
                              AS vendor_name,
                          'Jakarta Pusat' AS city, 'DKI Jakarta' AS province,
                          'Net 60' AS payment_terms),
               registered_date AS dbt_valid_from, DATE '2021-12-31' AS dbt_valid_to,
               false AS is_current_record, 1 AS record_version
        FROM s_vendors WHERE registered_date < DATE '2021-01-01' AND vendor_id % 3 = 0
        UNION ALL
        SELECT *, CASE WHEN registered_date < DATE '2021-01-01' AND vendor_id % 3 = 0
                       THEN DATE '2022-01-01' ELSE registered_date END,
               NULL, true,
               CASE WHEN registered_date < DATE '2021-01-01' AND vendor_id % 3 = 0 THEN 2
                    ELSE 1 END
        FROM s_vendors""",
    "dim_vendors": """
        SELECT md5(vendor_id || '|' || CAST(dbt_valid_from AS VARCHAR)) AS vendor_sk, *
        FROM vendor_versions""",
    "latest_receipts": """
        SELECT * FROM s_goods_receipts
        QUALIFY row_number() OVER (PARTITION BY po_line_id
                                   ORDER BY gr_date DESC, gr_id DESC) = 1""",
    "lifecycle": """
        SELECT l.line_id AS po_line_id, l.po_id, o.pr_id, o.vendor_id, o.department_id, l.item_id,
               g.gr_id, o.po_number, g.gr_number, l.line_number, o.po_date,
               l.delivery_date_expected, g.gr_date, o.po_year, o.po_month, o.po_year_month,
               l.quantity_ordered, g.quantity_received,
               coalesce(g.quantity_received, 0) AS quantity_received_coalesced,
               coalesce(g.quantity_variance, 0) AS quantity_variance_gr,
               l.quantity_ordered - quantity_received_coalesced AS unfulfilled_qty,
               ((quantity_received_coalesced * 20000 + l.quantity_ordered)
                   // (2 * l.quantity_ordered)) / 100.0 AS fulfillment_pct,
               l.unit_price_idr, l.net_unit_price_idr, l.discount_pct, l.discount_amount_idr,
               l.has_discount, l.discount_tier,
               l.gross_total_price_idr AS gross_total_ordered_idr,
               l.net_total_price_idr AS net_total_ordered_idr,
               quantity_received_coalesced * l.net_unit_price_idr AS net_total_received_idr,
               net_total_ordered_idr - net_total_received_idr AS value_shortfall_idr,
               CASE WHEN g.is_rejected_by_inspection THEN net_total_received_idr ELSE 0 END
                   AS rejected_goods_value_idr,
               o.expected_lead_time_days, g.lead_time_days AS actual_lead_time_days,
               g.lead_time_days - o.expected_lead_time_days AS lead_time_variance_days,
               o.po_status, l.line_status,
               CASE WHEN o.is_cancelled THEN 'Dibatalkan'
                    WHEN g.gr_id IS NULL THEN CASE WHEN o.is_open THEN 'Menunggu Penerimaan'
                                                   ELSE 'Ditutup Tanpa Penerimaan' END
                    WHEN g.quantity_received >= l.quantity_ordered
                    THEN 'Selesai – Terpenuhi Penuh'
                    WHEN g.quantity_received > 0 THEN 'Selesai – Terpenuhi Sebagian'
                    ELSE 'Tidak Ada Penerimaan' END AS lifecycle_stage,
               g.receipt_status, g.delivery_timeliness, g.shortage_severity, g.is_on_time,
               g.is_short_delivery, g.is_over_delivery, g.is_full_delivery,
               g.gr_id IS NOT NULL AS has_goods_receipt,
               quantity_received_coalesced >= l.quantity_ordered AS is_fully_fulfilled,
               coalesce(g.is_rejected_by_inspection, false) AS is_rejected_by_inspection,
               coalesce(g.needs_reinspection, false) AS needs_reinspection,
               l.unit_of_measure, g.warehouse_location, g.inspection_status, o.payment_terms,
               o.is_cancelled, o.is_completed
        FROM s_purchase_order_lines l JOIN s_purchase_orders o USING (po_id)
             LEFT JOIN latest_receipts g ON l.line_id = g.po_line_id""",
    "fact": """
        SELECT md5(CAST(c.po_line_id AS VARCHAR)) AS fct_po_line_sk,
               dp.date_key AS date_key_po_date, de.date_key AS date_key_delivery_expected,
               dg.date_key AS date_key_gr_date, v.vendor_sk, d.department_sk, i.item_sk, c.*,
               c.quantity_received_coalesced AS quantity_received_calc
        FROM lifecycle c
             LEFT JOIN dim_date dp ON c.po_date = dp.full_date
             LEFT JOIN dim_date de ON c.delivery_date_expected = de.full_date
             LEFT JOIN dim_date dg ON c.gr_date = dg.full_date
             LEFT JOIN dim_vendors v ON c.vendor_id = v.vendor_id AND v.is_current_record
             LEFT JOIN dim_departments d ON c.department_id = d.department_id
             LEFT JOIN dim_items i ON c.item_id = i.item_id""",
    "kept": "SELECT * FROM fact WHERE NOT is_cancelled",
}

_ALL = {**_RAW, **_STAGED, **_MARTS}


def with_tables(statement: str) -> str:
    """Put the table expressions before a statement that reads them."""
    if statement.lstrip().startswith("WITH"):
        statement = f"SELECT * FROM ({statement})"
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in _ALL.items())
    return f"WITH {ctes}\n{statement}"

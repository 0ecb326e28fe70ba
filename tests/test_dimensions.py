from __future__ import annotations

import hashlib
from datetime import date

import pytest

from ledgerlane.operators import dimensions, staging


def test_calendar(spark):
    days = {row.full_date: row for row in dimensions.calendar(spark).collect()}
    assert len(days) == 3652
    new_year = days[date(2021, 1, 1)]
    assert (new_year.iso_year, new_year.week_of_year, new_year.year_week) == (2020, 53, "2020-W53")
    assert new_year.is_first_day_of_year and new_year.is_first_day_of_month
    friday = days[date(2024, 3, 15)]
    assert friday.date_key == 20240315
    assert friday.date_label == "15 March     2024"
    assert (friday.month_name_id, friday.day_name_id, friday.day_short_id) == ("Maret", "Jumat", "Jum")
    assert (friday.day_of_week_sun0, friday.day_of_week_iso, friday.is_weekend) == (5, 5, False)
    sunday = days[date(2024, 3, 31)]
    assert (sunday.day_of_week_sun0, sunday.day_of_week_iso, sunday.is_weekend) == (0, 7, True)
    assert sunday.is_last_day_of_month and sunday.is_last_day_of_quarter
    assert not sunday.is_last_day_of_year and days[date(2024, 12, 31)].is_last_day_of_year


@pytest.mark.parametrize("budget,tier", [
    (5_000_000_000, "Anggaran Besar"),
    (4_999_999_999, "Anggaran Menengah"),
    (1_000_000_000, "Anggaran Menengah"),
    (999_999_999, "Anggaran Kecil"),
    (None, "Anggaran Kecil"),
])
def test_budget_tier(raw, budget, tier):
    rows = staging.departments(raw("departments", dict(budget_annual=budget)))
    row = dimensions.departments(rows).first()
    assert row.budget_tier == tier
    assert row.department_sk == hashlib.md5(b"1").hexdigest()


def versions(raw, **vendor):
    rows = dimensions.vendors(staging.vendors(raw("vendors", vendor)))
    return rows.orderBy("record_version").collect()


def test_old_vendor_has_two_versions_that_meet(raw):
    old, new = versions(raw, vendor_id=3, registered_date=date(2020, 12, 31), city="Bandung")
    assert (old.dbt_valid_from, old.dbt_valid_to) == (date(2020, 12, 31), date(2021, 12, 31))
    assert (new.dbt_valid_from, new.dbt_valid_to) == (date(2022, 1, 1), None)
    assert (old.is_current_record, new.is_current_record) == (False, True)
    assert (old.city, old.province, old.payment_terms) == ("Jakarta Pusat", "DKI Jakarta", "Net 60")
    assert new.city == "Bandung"
    assert old.vendor_sk == hashlib.md5(b"3|2020-12-31").hexdigest()
    assert new.vendor_sk == hashlib.md5(b"3|2022-01-01").hexdigest()


@pytest.mark.parametrize("vendor", [
    dict(vendor_id=3, registered_date=date(2021, 1, 1)),
    dict(vendor_id=4, registered_date=date(2018, 1, 1)),
])
def test_other_vendors_have_one_version(raw, vendor):
    (only,) = versions(raw, **vendor)
    assert (only.record_version, only.is_current_record) == (1, True)
    assert only.dbt_valid_from == vendor["registered_date"]


def test_vendor_without_registration_has_no_key(raw):
    (only,) = versions(raw, vendor_id=3, registered_date=None)
    assert (only.vendor_sk, only.record_version) == (None, 1)


@pytest.mark.parametrize("name,former", [
    ("PT A Tbk. PT B", "PT A  PT B (Versi Lama)"),
    ("PT A Tbk", "PT A  (Versi Lama)"),
    ("CV PT Maju", "CV Maju (Versi Lama)"),
    ("CV Maju", "CV Maju (Versi Lama)"),
])
def test_former_name_loses_one_company_form(raw, name, former):
    assert versions(raw, vendor_id=3, vendor_name=name)[0].vendor_name == former

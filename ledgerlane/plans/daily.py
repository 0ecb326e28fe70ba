"""One run of the whole flow: load, build, check, report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from ledgerlane.operators import quality
from ledgerlane.plans import checks, ingest
from ledgerlane.plans.reports import REPORTS
from ledgerlane.plans.stakeholders import STAKEHOLDER_REPORTS, payables_ageing
from ledgerlane.plans.warehouse import TRACKED, Marts, Warehouse
from ledgerlane.sources.layers import MARTS, RAW, LayerStore


class ChecksFailed(RuntimeError):
    """Declared checks of severity ``error`` failed; the run shows none of its tables."""


@dataclass(frozen=True)
class Run:
    """What a run leaves: its load summary, its tables and the results of its checks."""

    loads: DataFrame
    marts: Marts
    checks: DataFrame
    smoke: DataFrame

    def reports(self, as_of: date | None = None) -> dict[str, DataFrame]:
        """All reports as plans."""
        built = {
            key: report(self.marts) for key, report in {**REPORTS, **STAKEHOLDER_REPORTS}.items()
        }
        return {**built, "FIN2": payables_ageing(self.marts, as_of)}


def run(
    spark: SparkSession,
    folder: str,
    root: str,
    loaded: datetime,
    *,
    bounds: dict[str, tuple[int | None, int | None]] | None = None,
    accepted: dict[str, dict[str, Sequence]] | None = None,
    gate: bool = True,
    keep_bad_rows: bool = False,
    multi_line: bool = False,
    most_bad: float = 1.0,
) -> Run:
    """Load the CSV files of ``folder`` into ``root``, bring the marts up to date and check both.

    Tables of an earlier run under ``root`` are carried forward: the load is applied to the stored
    vendor history as of the day of ``loaded``, and the stored fact is updated in place, by the
    years that hold changed lines. Raw tables and marts are written, checked and only then shown: if a
    stage or a check of severity ``error`` fails, readers keep the tables of the run before, and the
    next run starts from them. The results of the checks and rows set aside are stored either way.
    ``bounds`` replaces the expected table sizes, ``accepted`` the values that columns may hold and
    ``most_bad`` the share of rows of a file that may be set aside; without ``gate`` failed checks are
    shown too.
    """
    store = LayerStore(spark, root, publish=True)
    with store.held(RAW, MARTS, TRACKED):
        loads = ingest.ingest(
            spark, store, folder, loaded, keep_bad_rows=keep_bad_rows, multi_line=multi_line, most_bad=most_bad
        )
        warehouse = Warehouse(spark, lambda table, _: store.read(RAW, table), store,
                              keep_raw=False)
        warehouse.update_vendors(loaded.date())
        warehouse.update_fact()
        marts = warehouse.marts()
        store.write("checks", "declared", checks.all_checks(warehouse.raw_tables(), marts, accepted))
        store.write("checks", "smoke", checks.smoke_checks(marts, bounds))
        results = store.read("checks", "declared")
        if gate:
            failed = quality.gate(results).collect()  # at most one row per declared check
            if failed:
                raise ChecksFailed(", ".join(f"{r.check}({r.table}.{r.column})" for r in failed))
    return Run(loads, marts, results, store.read("checks", "smoke"))

"""What each fact declares: its columns, grain, partitioning, references and row rules (Q1-Q3, Q6).

Facts that a batch reloads as a whole are partitioned by batch, periodic facts by their date key, postings by month,
and the service lifecycle, one row a service, by a hash of the service.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.operators.quality import Rule, not_null
from martkit.plans.marts import service, workforce
from martkit.sources.fact_table import FactTable
from martkit.sources.store import SnapshotStore

#: Keys that every fact has, with their dimension.
FACT_KEYS = {"AgencyKey": ("DimAgency", "AgencyKey"), "ModeKey": ("DimMode", "ModeKey"),
             "ServiceTypeKey": ("DimServiceType", "ServiceTypeKey")}


@dataclass(frozen=True)
class FactSpec:
    """``part``: SQL for a row's partition number; ``rules``: name -> SQL condition (NULL passes)."""

    empty: Callable[[SparkSession], DataFrame]
    grain: Sequence[str]
    part: str
    key_col: str
    dates: Sequence[str] = ()           # date keys that must be set and be in the calendar
    not_negative: Sequence[str] = ()
    rules: dict[str, str] = field(default_factory=dict)

    def table(self, store: SnapshotStore, name: str) -> FactTable:
        return store.fact(name, self.empty(store.spark).schema, self.grain, F.expr(self.part), self.key_col)

    def keys(self) -> dict[str, tuple[str, str]]:
        return {**FACT_KEYS, **{d: ("DimDate", "DateKey") for d in self.dates}}

    def row_rules(self) -> list[Rule]:
        return [*not_null(*self.keys()), *(Rule(f"{c} not negative", F.col(c) >= 0) for c in self.not_negative),
                *(Rule(n, F.expr(sql)) for n, sql in self.rules.items())]


_POSTING = ["OpenPositions", "DaysOpen", "HiredCount"]

FACTS = {
    "Fact_Annual_Service_Performance": FactSpec(
        service.empty_fact_annual, service.ANNUAL_GRAIN, "DateKey", "AnnualServicePerformanceKey", ["DateKey"],
        [m for m, _ in service.ANNUAL_MEASURES.values()]),
    "Fact_Major_Safety_Event": FactSpec(
        service.empty_fact_safety, ["SourceIncidentID"], "ETL_BatchID", "MajorSafetyEventKey", ["EventDateKey"],
        [*service.SAFETY_MEASURES, "VehicleInvolvedCount", "EvacuationCount", "PropertyDamageAmount"]),
    "Fact_Service_Availability": FactSpec(
        service.empty_fact_availability, service.AVAILABILITY_GRAIN, "ETL_BatchID", "ServiceAvailabilityKey",
        ["StartDateKey"], rules={"start not after end": "StartDateKey <= EndDateKey"}),
    "Fact_Service_Lifecycle_Accumulating": FactSpec(
        service.empty_fact_lifecycle, service.LIFECYCLE_KEY,
        "pmod(xxhash64(AgencyKey, ModeKey, ServiceTypeKey), 64)", "ServiceLifecycleKey",
        not_negative=["YearsInService", *(f"{k}Annual{m}" for k in ("Peak", "Latest") for m, _ in service.PEAK_MEASURES),
                      *(f"TotalObserved{m}" for m in ("UPT", "VRM", "VRH", "MajorSafetyEvents", "Fatalities", "Injuries"))]),
    "FactJobPosting": FactSpec(
        workforce.empty_fact_job_posting, ["OpeningID"], "DateKey div 100", "JobPostingFactKey", ["DateKey"],
        [*_POSTING, "SalaryMinHourly"], {"salary range": "SalaryMinHourly <= SalaryMaxHourly"}),
    "FactEmployeeSnapshot": FactSpec(
        workforce.empty_fact_employee_snapshot, workforce.SNAPSHOT_GRAIN, "DateKey", "SnapshotFactKey", ["DateKey"],
        [*workforce.UNIFIED_MEASURES, "HoursPerEmployee"]),
    "FactAgencyLaborCoverage": FactSpec(
        workforce.empty_fact_labor_coverage, workforce.COVERAGE_GRAIN, "DateKey", "CoverageFactKey"),
    "FactJobPostingLifecycle": FactSpec(
        workforce.empty_fact_posting_lifecycle, ["OpeningID"], "PostingDateKey div 100", "LifecycleFactKey",
        not_negative=_POSTING, rules={"filled not before posting": "FilledDateKey >= PostingDateKey"}),
}

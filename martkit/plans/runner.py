"""Mart runners (G1-G7): ordered loader steps with skip flags, two failure policies and one
audit row per step.  Plain Python on the driver; every step is a Spark job that reads the
published inputs and writes its table through the ``SnapshotStore``: dimensions publish a
complete next snapshot, facts are staged, checked and then append their new rows or replace the partitions
that a reload or an accumulating load touches (``sources/fact_table.py``).

* ``fail_fast``            stop at the first failing step and raise
* ``continue_then_raise``  run every step, then raise if any failed

``MartRunner.run_all`` runs common -> service -> workforce; a later mart runs only when
no earlier mart reported an error, and the run raises at the end if anything failed.
"""

from __future__ import annotations

import datetime as _dt
import traceback
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martkit.functions.dates import batch_id as make_batch_id
from martkit.operators.facts import FactChange
from martkit.plans.fact_specs import FACTS
from martkit.plans.marts import common, service, workforce
from martkit.sources.fact_table import FactTable, LoadCounts, LoadRejected, Staged
from martkit.sources.store import AuditLog, SnapshotStore


class MartLoadError(RuntimeError):
    pass


@dataclass
class StepResult:
    name: str
    status: str
    rows_written: int = 0
    mode: str | None = None  # "append" (only new rows), "partitions" (touched ones rewritten), "replace" (whole table)
    seconds: float = 0.0
    error: str | None = None
    counts: LoadCounts = field(default_factory=LoadCounts)

    @property
    def inserted(self) -> int:
        return self.counts.inserted


@dataclass
class Step:
    """``run`` writes one table (named like the step unless it returns another name); the
    audit row takes its row count from an observation on that write."""
    name: str
    run: Callable[[], str | None]
    skip: bool = False
    optional: bool = False  # a failure is recorded, but neither stops nor fails the run


@dataclass
class MartRunner:
    spark: SparkSession
    store: SnapshotStore
    load_date: _dt.date = field(default_factory=lambda: _dt.datetime.now(_dt.timezone.utc).date())
    batch_id: int | None = None
    initial_effective: str | None = "1900-01-01"
    reload: bool = False
    skip_steps: frozenset[str] = frozenset()  # steps that are left out, by name (G1)
    append_openings: bool = False              # add to staged job openings instead of replacing them
    throw_on_failure: bool = True              # False: a failed job-opening load is recorded and the run goes on

    def __post_init__(self):
        self.batch_id = self.batch_id or make_batch_id()
        self.audit = AuditLog(self.store)
        self.load_ts = F.lit(_dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)).cast("timestamp")
        self._written: dict[str, tuple[str, int, LoadCounts]] = {}

    # --- plumbing -----------------------------------------------------------------------
    def _observed(self, name: str, df: DataFrame) -> tuple[DataFrame, Observation]:
        # Row counts for the audit come out of the write job itself (no extra count action).
        obs = Observation(f"{name}_{len(self._written)}")
        return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs

    def _publish(self, name: str, df: DataFrame) -> None:
        """Publish a complete next snapshot of ``name``."""
        observed, obs = self._observed(name, df)
        self.store.publish(name, observed)
        rows = int(obs.get["rows"])
        self._written[name] = ("replace", rows, LoadCounts(inserted=rows))

    def _write(self, name: str, change: FactChange) -> None:
        """Append a delta, or publish a complete next snapshot."""
        if change.mode == "append":
            observed, obs = self._observed(name, change.rows)
            self.store.append(name, observed)
            rows = int(obs.get["rows"])
            self._written[name] = ("append", rows, LoadCounts(inserted=rows))
        else:
            self._publish(name, change.rows)

    def _fact(self, name: str) -> FactTable:
        return FACTS[name].table(self.store, name)

    def _load_fact(self, name: str, staged: Staged) -> None:
        """Stage, check and publish a fact load (``fact_table``); its violations go to ``dq_report``.

        A violation fails the step, and the fact stays as it was."""
        spec = FACTS[name]
        keys = {k: (self.store.read(dim), pk) for k, (dim, pk) in spec.keys().items() if self.store.exists(dim)}
        try:
            counts = self._fact(name).load(staged, spec.row_rules(), keys)
        except LoadRejected as e:
            self._report(name, e.violations)
            raise MartLoadError(str(e)) from e
        self._report(name, counts.violations)
        mode = "append" if staged.replace is None else "partitions"
        self._written[name] = (mode, counts.inserted + counts.updated, counts)

    def _report(self, name: str, violations: Mapping[str, int]) -> None:
        rows = [(self.batch_id, name, f"{name}: {check}", int(n)) for check, n in violations.items()]
        self.store.log("dq_report", self.spark.createDataFrame(
            rows, "run_id bigint, table string, check string, violations bigint").coalesce(1))

    def _table(self, name: str, empty: Callable[[SparkSession], DataFrame]) -> DataFrame:
        return self.store.read(name) if self.store.exists(name) else empty(self.spark)

    def run_steps(self, steps: Sequence[Step], policy: str = "fail_fast", mart: str = "") -> list[StepResult]:
        results = []
        for st in steps:
            if st.skip or st.name in self.skip_steps:
                results.append(StepResult(st.name, "SKIPPED"))
                continue
            start = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
            step_name = f"{mart}.{st.name}" if mart else st.name
            self.audit.start(self.batch_id, step_name, self.load_date, start)
            res = StepResult(st.name, "IN_PROGRESS")
            try:
                published = st.run() or st.name
                res.mode, res.rows_written, res.counts = self._written.get(published, (None, 0, LoadCounts()))
                res.status = "SUCCESS"
            except Exception as exc:  # noqa: BLE001 - recorded, then re-raised per policy
                res.status, res.error = "FAILED", f"{type(exc).__name__}: {exc}"
                traceback.print_exc()
            end = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
            res.seconds = (end - start).total_seconds()
            self.audit.record(self.batch_id, step_name, self.load_date, start, end,
                              res.status, processed=res.rows_written, inserted=res.counts.inserted,
                              updated=res.counts.updated, deleted=res.counts.deleted,
                              duplicates=res.counts.duplicates, error=res.error)
            results.append(res)
            if res.status == "FAILED" and st.optional:
                continue
            if res.status == "FAILED" and policy == "fail_fast":
                raise MartLoadError(f"{mart}: step {st.name} failed: {res.error}")
        optional = {st.name for st in steps if st.optional}
        failed = [r for r in results if r.status == "FAILED" and r.name not in optional]
        if failed:
            raise MartLoadError(f"{mart}: steps failed: {[r.name for r in failed]}")
        return results

    # --- staging ------------------------------------------------------------------------
    def stage(self, raw: Mapping[str, DataFrame]) -> list[StepResult]:
        """Staging loaders (L1-L9) for whatever raw feeds are given (full refresh).

        Keys: agency_information, agency_mode_service, ts_<metric>, archive_<metric>,
        safety_events, employees_<year>, job_openings.  Job-opening rejects are kept in
        ``stg_job_openings_rejects``."""
        steps = []

        def add(name: str, fn: Callable[[], DataFrame]):
            steps.append(Step(name, lambda: (self._publish(name, fn()), name)[1]))

        if "agency_information" in raw:
            add("stg_agency_information", lambda: service.stage_agency_information(raw["agency_information"]))
        if "agency_mode_service" in raw:
            add("stg_agency_mode_service", lambda: service.stage_agency_mode_service(raw["agency_mode_service"]))
        for key in raw:
            if key.startswith("ts_"):
                add(f"stg_{key}", lambda k=key: service.stage_metric(raw[k]))
            elif key.startswith("archive_"):
                add(f"stg_{key}", lambda k=key: service.stage_metric(raw[k], archive=True))
            elif key.startswith("employees_"):
                add(f"stg_{key}", lambda k=key: workforce.stage_employees(raw[k], int(k.split("_")[1])))
        if "safety_events" in raw:
            add("stg_major_safety_event", lambda: service.stage_safety_events(raw["safety_events"]))
        if "job_openings" in raw:
            def jobs():
                valid, rejects = workforce.stage_job_openings(raw["job_openings"])
                for name, rows in (("stg_job_openings_rejects", rejects), ("stg_job_openings", valid)):
                    if self.append_openings:
                        self._write(name, FactChange(rows, "append"))
                    else:
                        self._publish(name, rows)
                return "stg_job_openings"
            steps.append(Step("stg_job_openings", jobs, optional=not self.throw_on_failure))
        years = sorted(int(k.split("_")[1]) for k in raw if k.startswith("employees_"))
        if years:
            # every staged year, not only those of this run's feed
            add("stg_employee_unified", lambda: workforce.unify_employees(
                {int(n.rsplit("_", 1)[1]): self.store.read(n) for n in self.store.names("stg_employees_")}))
        return self.run_steps(steps, "fail_fast", "staging")

    # --- G1: common dimensions ----------------------------------------------------------------
    def run_common(self, raw_calendar: DataFrame | None = None, skip_date=False, skip_agency=False,
                   skip_mode=False, skip_service_type=False) -> list[StepResult]:
        def date_step():
            cur = self._table("DimDate", common.empty_dim_date)
            nxt = common.dim_date_load(raw_calendar, cur) if raw_calendar is not None else cur
            special = [-1, 99991231]
            if nxt.where(~F.col("DateKey").isin(special)).isEmpty():
                raise MartLoadError("the calendar has no real date: facts could not resolve any")
            self._publish("DimDate", nxt)

        def agency_step():
            cur = self._table("DimAgency", common.empty_dim_agency)
            nxt = common.dim_agency_load(self.store.read("stg_agency_information"), cur, self.load_date,
                                         self.initial_effective)
            self._publish("DimAgency", nxt)

        def mode_step():
            self._publish("DimMode", common.dim_mode(self.spark))
            bad = common.verify_static_dims(self.spark).filter(~F.col("ok")).count()
            if bad:
                raise MartLoadError("static dimension size check failed")

        def tos_step():
            self._publish("DimServiceType", common.dim_service_type(self.spark))

        return self.run_steps([Step("DimDate", date_step, skip_date), Step("DimAgency", agency_step, skip_agency),
                               Step("DimMode", mode_step, skip_mode),
                               Step("DimServiceType", tos_step, skip_service_type)], "fail_fast", "common")

    # --- G2 / G5: service mart ----------------------------------------------------------------
    def run_service_dimensions(self, skip_urban=False, skip_event_type=False, skip_incident=False):
        def urban():
            cur = self._table("DimUrbanArea", service.empty_dim_urban_area)
            self._publish("DimUrbanArea", service.dim_urban_area_load(
                self.store.read("stg_agency_information"), cur, self.load_date, self.initial_effective))

        def event_type():
            cur = self._table("DimSafetyEventType", service.empty_dim_safety_event_type)
            self._publish("DimSafetyEventType", service.dim_safety_event_type_load(
                self.store.read("stg_major_safety_event"), cur))

        def incident():
            cur = self._table("DimSafetyIncident", service.empty_dim_safety_incident)
            self._publish("DimSafetyIncident", service.dim_safety_incident_load(
                self.store.read("stg_major_safety_event"), cur))

        return self.run_steps([Step("DimUrbanArea", urban, skip_urban),
                               Step("DimSafetyEventType", event_type, skip_event_type),
                               Step("DimSafetyIncident", incident, skip_incident)], "fail_fast", "service_dims")

    def _dims(self) -> dict[str, DataFrame]:
        r = self.store.read
        out = {"calendar": r("DimDate"), "agency": r("DimAgency"), "mode": r("DimMode"),
               "service_type": r("DimServiceType")}
        for name, key in (("DimUrbanArea", "urban"), ("DimSafetyEventType", "event_type"),
                          ("DimSafetyIncident", "incident"), ("DimEmploymentType", "employment_type"),
                          ("DimDepartment", "department"), ("DimJobRole", "job_role")):
            if self.store.exists(name):
                out[key] = r(name)
        return out

    def run_service_facts(self) -> list[StepResult]:
        d = self._dims()
        kw = {"batch_id": self.batch_id, "load_ts": self.load_ts}

        def annual():
            metrics = {m: self.store.read(f"stg_ts_{m}") for m in service.CURRENT_METRICS
                       if self.store.exists(f"stg_ts_{m}")}
            name = "Fact_Annual_Service_Performance"
            self._load_fact(name, service.fact_annual_service_performance(
                metrics, d["calendar"], d["agency"], d["mode"], d["service_type"], d["urban"], self._fact(name),
                reload=self.reload, **kw))

        def safety():
            name = "Fact_Major_Safety_Event"
            self._load_fact(name, service.fact_major_safety_event(
                self.store.read("stg_major_safety_event"), d["calendar"], d["agency"], d["mode"], d["service_type"],
                d["urban"], d["event_type"], d["incident"], self._fact(name), reload=self.reload, **kw))

        def availability():
            name = "Fact_Service_Availability"
            self._load_fact(name, service.fact_service_availability(
                self.store.read("stg_agency_mode_service"), d["calendar"], d["agency"], d["mode"],
                d["service_type"], self._fact(name), reload=self.reload, **kw))

        def lifecycle():
            name = "Fact_Service_Lifecycle_Accumulating"
            self._load_fact(name, service.fact_service_lifecycle(
                self.store.read("Fact_Annual_Service_Performance"), self.store.read("Fact_Service_Availability"),
                self.store.read("Fact_Major_Safety_Event"), d["calendar"], self._fact(name), **kw))

        return self.run_steps([Step("Fact_Annual_Service_Performance", annual),
                               Step("Fact_Major_Safety_Event", safety),
                               Step("Fact_Service_Availability", availability),
                               Step("Fact_Service_Lifecycle_Accumulating", lifecycle)], "fail_fast", "service_facts")

    # --- G3 / G4: workforce mart --------------------------------------------------------------
    def run_workforce_dimensions(self) -> list[StepResult]:
        def emp():
            cur = self._table("DimEmploymentType", workforce.dim_employment_type_seed)
            self._publish("DimEmploymentType", workforce.dim_employment_type_load(
                self.store.read("stg_job_openings"), cur))

        def dept():
            cur = self._table("DimDepartment", workforce.dim_department_seed)
            self._publish("DimDepartment", workforce.dim_department_load(self.spark, cur))

        def role():
            cur = self._table("DimJobRole", workforce.dim_job_role_seed)
            self._publish("DimJobRole", workforce.dim_job_role_load(
                self.store.read("stg_job_openings"), cur, self.load_date, self.initial_effective))

        return self.run_steps([Step("DimEmploymentType", emp), Step("DimDepartment", dept), Step("DimJobRole", role)],
                              "fail_fast", "workforce_dims")

    def run_workforce_facts(self) -> list[StepResult]:
        d = self._dims()
        cal = d["calendar"]

        def posting():
            self._load_fact("FactJobPosting", workforce.fact_job_posting(
                self.store.read("stg_job_openings"), cal, d, self._fact("FactJobPosting"), batch_id=self.batch_id,
                load_ts=self.load_ts))

        def snapshot():
            self._load_fact("FactEmployeeSnapshot", workforce.fact_employee_snapshot(
                self.store.read("stg_employee_unified"), cal, d, self._fact("FactEmployeeSnapshot"),
                batch_id=self.batch_id, load_ts=self.load_ts))

        def coverage():
            self._load_fact("FactAgencyLaborCoverage", workforce.fact_labor_coverage(
                self.store.read("stg_employee_unified"), cal, d, self._fact("FactAgencyLaborCoverage")))

        def lifecycle():
            self._load_fact("FactJobPostingLifecycle", workforce.fact_posting_lifecycle(
                self.store.read("stg_job_openings"), cal, d, self._fact("FactJobPostingLifecycle")))

        has_jobs = self.store.exists("stg_job_openings")
        has_emp = self.store.exists("stg_employee_unified")
        return self.run_steps([Step("FactJobPosting", posting, not has_jobs),
                               Step("FactEmployeeSnapshot", snapshot, not has_emp),
                               Step("FactAgencyLaborCoverage", coverage, not has_emp),
                               Step("FactJobPostingLifecycle", lifecycle, not has_jobs)],
                              "continue_then_raise", "workforce_facts")

    # --- G6 / G7 -------------------------------------------------------------------------------
    def run_all(self, raw: Mapping[str, DataFrame] | None = None, raw_calendar: DataFrame | None = None,
                skip_staging: bool = False, skip_service: bool = False, skip_workforce: bool = False,
                dims_only: bool = False) -> dict[str, list[StepResult] | str]:
        """Common -> service -> workforce, later marts gated on no earlier error."""
        report: dict[str, list[StepResult] | str] = {}
        errors = []

        def phase(name, fn):
            if errors:
                report[name] = "SKIPPED_AFTER_ERROR"
                return
            try:
                report[name] = fn()
            except MartLoadError as exc:
                errors.append(str(exc))
                report[name] = f"FAILED: {exc}"

        if raw and not skip_staging:
            phase("staging", lambda: self.stage(raw))
        phase("common", lambda: self.run_common(raw_calendar))
        if not skip_service:
            phase("service_dimensions", self.run_service_dimensions)
            if not dims_only:
                phase("service_facts", self.run_service_facts)
        if not skip_workforce:
            phase("workforce_dimensions", self.run_workforce_dimensions)
            if not dims_only:
                phase("workforce_facts", self.run_workforce_facts)
        if errors:
            raise MartLoadError("; ".join(errors))
        return report

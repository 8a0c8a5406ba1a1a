"""Workforce (HR) mart: employee and job-opening staging, HR dimensions and the four
HR facts (L6-L9, L13-L15, L19-L22).

The yearly employee files come in two generations of layout (2014-2018 without and
2019-2024 with the operator / non-operator split) whose header names follow a naming
rule; the header maps and the multi-measure unpivot variants are generated from that rule.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.functions import cleanse as cl
from martkit.functions import dates as dt
from martkit.functions.spec import normalise_headers
from martkit.operators.dedup import dedup_grain, keep_first, latest_per_key
from martkit.operators.facts import FactChange, accumulating_conditional, load_accumulating, load_new, with_lineage
from martkit.operators.lookup import Lookup, drop_unresolved, mapped_key, resolve_keys, year_start_lookup
from martkit.operators.quality import Rule, split_rejects
from martkit.operators.reshape import unpivot_measures
from martkit.operators.scd import insert_new, scd2_apply
from martkit.sources.fact_table import CHANGE, FactTable, Staged

SMALL_DIM_ROWS = 1_000_000

# --- L6 / L7: yearly employee files -----------------------------------------------------

# The words the employee headers are built from (see employee_layout).
EMPLOYMENT = {"ft": "Full Time", "pt": "Part Time"}
DEPARTMENTS = {"vehicle_operations": "Vehicle Operations", "vehicle_maintenance": "Vehicle Maintenance",
               "facility_maintenance": "Facility Maintenance", "general_administration": "General Administration"}
OPERATOR = {"op": "Operator", "nonop": "Non-Operator"}
# Header spellings of the 2014-2017 files that differ from the rule.
GEN1_DEPT_LABELS = {"facility_maintenance": "Non-Vehicle Maintenance"}
GEN1_HEADER_QUIRKS = {"ft_general_administration_hours": "Full Time General Administration Maintenance Hours Worked"}


def employee_layout(year: int) -> dict[str, str]:
    """Canonical staging column -> raw header of the ``year`` file (the naming rule)."""
    m = {"ntd_id": "5 Digit NTD ID" if year <= 2016 else "NTD ID", "agency_name": "Agency Name",
         "reporter_type": "Reporter Type", "mode": "Mode", "tos": "TOS"}
    if year >= 2019:
        m["reporting_module"] = "Reporting Module"
    for e, E in EMPLOYMENT.items():
        if year <= 2017:
            for d, D in DEPARTMENTS.items():
                D = GEN1_DEPT_LABELS.get(d, D)
                m[f"{e}_{d}_hours"] = f"{E} {D} Hours Worked"
                m[f"{e}_{d}_count"] = f"{E} {D} Employee Count"
            m.update({f"{e}_operating_hours": f"Total {E} Operating Labor Hours Worked",
                      f"{e}_capital_hours": f"Total {E} Capital Labor Hours Worked",
                      f"{e}_operating_count": f"Total {E} Operating Employee Count",
                      f"{e}_capital_count": f"Total {E} Capital Employee Count"})
        elif year == 2018:
            for d, D in DEPARTMENTS.items():
                m[f"{e}_{d}_hours"] = f"Total {E} ({D}) Hours Worked"
                m[f"{e}_{d}_count"] = f"Total {E} ({D}) Employee Count"
            m.update({f"{e}_operating_hours": f"Total {E} (Operating Labor) Hours Worked",
                      f"{e}_capital_hours": f"Total {E} (Capital Labor) Hours Worked",
                      f"{e}_operating_count": f"Total {E} (Operations) Employee Count",
                      f"{e}_capital_count": f"Total {E} (Capital Labor) Employee Count"})
        else:
            for d, D in DEPARTMENTS.items():
                for o, O in OPERATOR.items():
                    m[f"{e}_{o}_{d}_hours"] = f"{E} {O} ({D}) Hours Worked"
                    m[f"{e}_{o}_{d}_count"] = f"{E} {O} ({D}) Employee Count"
                m[f"{e}_{d}_hours"] = f"Total {E} ({D}) Hours Worked"
                m[f"{e}_{d}_count"] = f"Total {E} ({D}) Employee Count"
            for o, O in OPERATOR.items():
                if e == "ft":
                    m[f"{e}_{o}_operating_hours"] = f"Total {E} {O} (Operating Labor) Hours Worked"
                    m[f"{e}_{o}_capital_hours"] = f"{E} {O} (Capital Labor) Hours Worked"
                m[f"{e}_{o}_total_hours"] = f"Total {E} {O} Hours Worked"
                m[f"{e}_{o}_total_count"] = f"Total {E} {O} Employee Count"
            if e == "ft":
                m[f"{e}_operating_hours"] = f"Total {E} (Operating Labor) Hours Worked"
                m[f"{e}_capital_hours"] = f"Total {E} (Capital Labor) Hours Worked"
        m[f"{e}_total_hours"] = f"Total {E} Hours Worked"
        m[f"{e}_total_count"] = f"Total {E} Employee Count"
    if year <= 2017:
        m.update(GEN1_HEADER_QUIRKS)
    return m


def stage_employees(raw: DataFrame, year: int) -> DataFrame:
    """One yearly employee file -> typed staging.  Header padding is stripped,
    ids with separators -> text, hours -> int (truncating), counts -> decimal(18,2)."""
    src = normalise_headers(raw)
    cols = []
    for target, header in employee_layout(year).items():
        c = F.col(f"`{header}`")
        if target == "ntd_id":
            cols.append(cl.thousands_to_id(c).alias(target))
        elif target.endswith("_hours"):
            cols.append(cl.thousands_to_int(c).alias(target))
        elif target.endswith("_count"):
            cols.append(cl.thousands_number(c).alias(target))
        else:
            cols.append(cl.null_if_blank(c).alias(target))
    return src.select(*cols)


# --- L8: unified long employee table ---------------------------------------------------

EMPLOYMENT_TYPE_LABELS = {"ft": "FullTime", "pt": "PartTime"}
GEN1_BUCKETS = {**DEPARTMENTS, "operating": "Operating", "capital": "Capital", "total": "Total"}
UNIFIED_MEASURES = ["HoursWorked", "EmployeeCount", "OperatingHours", "CapitalHours", "TotalHours",
                    "OperatingEmployees", "CapitalEmployees", "TotalEmployees"]


def employee_variants(year: int) -> list[dict[str, Column]]:
    """The (employment type x department [x operator type]) rows one wide staging row
    fans out into, with the per-row measures (generated from the naming rule)."""
    out = []
    for e, label in EMPLOYMENT_TYPE_LABELS.items():
        if year <= 2018:
            for d, dname in GEN1_BUCKETS.items():
                out.append({"EmploymentType": F.lit(label), "DepartmentName": F.lit(dname),
                            "OperatorType": F.lit(None).cast("string"),
                            "HoursWorked": f"{e}_{d}_hours", "EmployeeCount": f"{e}_{d}_count",
                            "OperatingHours": f"{e}_operating_hours", "CapitalHours": f"{e}_capital_hours",
                            "TotalHours": f"{e}_total_hours", "OperatingEmployees": f"{e}_operating_count",
                            "CapitalEmployees": f"{e}_capital_count", "TotalEmployees": f"{e}_total_count"})
        else:
            for d, dname in DEPARTMENTS.items():
                for o, oname in (("op", "Operator"), ("nonop", "Non Operator")):
                    # Part-time files carry no operating/capital split: the operator-type total
                    # stands in for both, and the part-time total for the total hours (as the
                    # source layout maps them).
                    op_h = f"{e}_{o}_operating_hours" if e == "ft" else f"{e}_{o}_total_hours"
                    cap_h = f"{e}_{o}_capital_hours" if e == "ft" else f"{e}_{o}_total_hours"
                    tot_h = f"{e}_{o}_total_hours" if e == "ft" else f"{e}_total_hours"
                    out.append({"EmploymentType": F.lit(label), "DepartmentName": F.lit(dname),
                                "OperatorType": F.lit(oname),
                                "HoursWorked": f"{e}_{o}_{d}_hours", "EmployeeCount": f"{e}_{o}_{d}_count",
                                "OperatingHours": op_h, "CapitalHours": cap_h, "TotalHours": tot_h,
                                "OperatingEmployees": f"{e}_{o}_total_count", "CapitalEmployees": f"{e}_{o}_total_count",
                                "TotalEmployees": f"{e}_total_count"})
    return out


def unify_employees(staged_by_year: Mapping[int, DataFrame]) -> DataFrame:
    """Every yearly staging table unpivoted (R2) into one long grain and unioned (R3);
    a row is kept when hours or count is present, missing measures become 0."""
    frames = []
    for year, s in staged_by_year.items():
        if "reporting_module" not in s.columns:
            s = s.withColumn("reporting_module", F.lit(None).cast("string"))
        ids = ["ntd_id", "agency_name", "reporter_type", "reporting_module", "mode", "tos"]
        long = unpivot_measures(s, ids, employee_variants(year), require_any=["HoursWorked", "EmployeeCount"])
        frames.append(long.select(
            F.lit(year).alias("ReportYear"), F.col("ntd_id").alias("NTD_ID"), F.col("agency_name").alias("AgencyName"),
            F.col("reporter_type").alias("ReporterType"), F.col("reporting_module").alias("ReportingModule"),
            F.col("mode").alias("ModeCode"), F.col("tos").alias("TOSCode"), "EmploymentType", "DepartmentName",
            "OperatorType", *[F.coalesce(F.col(m).cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)")).alias(m)
                              for m in UNIFIED_MEASURES]))
    return functools.reduce(lambda a, b: a.unionByName(b), frames)


# --- L9: job openings (cleanse -> validate -> gate) ------------------------------------

# Spellings of employment type and posting status, and the labor classes.
EMPLOYMENT_TYPE_MAP = {"Full-Time": ["FULL-TIME", "FULL TIME", "FT"], "Part-Time": ["PART-TIME", "PART TIME", "PT"],
                       "Temporary": ["TEMPORARY", "TEMP"], "Seasonal": ["SEASONAL", "SEASON"],
                       "Contract": ["CONTRACT", "CTR"]}
POSTING_STATUS_MAP = {"Open": ["OPEN"], "Closed": ["CLOSED"], "Filled": ["FILLED"], "Withdrawn": ["WITHDRAWN"],
                      "Cancelled": ["CANCELLED", "CANCELED"]}
LABOR_CLASSES = ["Vehicle Operations", "Vehicle Maintenance", "Facility Maintenance", "General Administration"]


def _num(c: str, dtype: str, ok) -> Column:
    v = F.regexp_replace(F.trim(F.col(c)), r"[$,]", "").try_cast("decimal(38,4)")
    return F.when(ok(v), v.try_cast(dtype))


def _upper_default(c: str, default: str = "Unknown") -> Column:
    return F.upper(cl.default_if_blank(c, default))


def clean_job_openings(raw: DataFrame) -> DataFrame:
    """Cleansing step: validity probes for dates / numbers, defaults, code conformance."""
    return raw.select(
        cl.null_if_blank("OpeningID").alias("opening_id"),
        dt.valid_date("PostingDate").alias("posting_date"),
        dt.valid_date("ClosingDate").alias("closing_date"),
        dt.valid_date("FilledDate").alias("filled_date"),
        _num("OpenPositions", "int", lambda v: v.cast("int") > 0).alias("open_positions"),
        _num("DaysOpen", "int", lambda v: v.cast("int") >= 0).alias("days_open"),
        _num("HiredCount", "int", lambda v: v.cast("int") >= 0).alias("hired_count"),
        _num("SalaryMinHourly", "decimal(18,2)", lambda v: v >= 0).alias("salary_min_hourly"),
        _num("SalaryMaxHourly", "decimal(18,2)", lambda v: v >= 0).alias("salary_max_hourly"),
        _num("SalaryMidHourly", "decimal(18,2)", lambda v: v >= 0).alias("salary_mid_hourly"),
        cl.null_if_blank("NTD_ID").alias("ntd_id"),
        _upper_default("AgencyName").alias("agency_name"), _upper_default("ReporterType").alias("reporter_type"),
        _upper_default("ReportingModule").alias("reporting_module"),
        cl.default_if_blank("OrganizationType").alias("organization_type"),
        _upper_default("City").alias("city"), _upper_default("State").alias("state"),
        _upper_default("Region").alias("region"),
        cl.default_if_blank("ModeCode", "UNKNOWN").alias("mode_code"), cl.default_if_blank("ModeName").alias("mode_name"),
        cl.default_if_blank("TOS", "UNKNOWN").alias("tos"),
        cl.default_if_blank("TypeOfServiceName").alias("type_of_service_name"),
        F.when(F.trim("NTDLaborObjectClass").isin(*LABOR_CLASSES), F.trim("NTDLaborObjectClass"))
         .otherwise(F.lit("General Administration")).alias("ntd_labor_object_class"),
        cl.default_if_blank("OperatorStatus").alias("operator_status"),
        cl.conform_code("EmploymentType", EMPLOYMENT_TYPE_MAP, default="Full-Time").alias("employment_type"),
        cl.default_if_blank("PositionTitle", "Unknown Position").alias("position_title"),
        cl.default_if_blank("Department", "Unknown Department").alias("department"),
        cl.default_if_blank("SalaryType", "Hourly").alias("salary_type"),
        cl.conform_code("PostingStatus", POSTING_STATUS_MAP, default="Open").alias("posting_status"),
        cl.null_if_blank("VacancyReason").alias("vacancy_reason"),
        cl.default_if_blank("SourceSystem").alias("source_system"),
        F.upper(cl.default_if_blank("SyntheticDataFlag", "N")).alias("synthetic_data_flag"),
        cl.null_if_blank("SourceBasisURL").alias("source_basis_url"),
        cl.null_if_blank("SourceBasisNote").alias("source_basis_note"))


def job_opening_rules() -> list[Rule]:
    """Row gates of the job-opening load (a NULL comparison passes, as in SQL CHECK)."""
    return [Rule("missing_opening_id", F.col("opening_id").isNotNull(), null_passes=False),
            Rule("invalid_posting_date", F.col("posting_date").isNotNull(), null_passes=False),
            Rule("salary_range_invalid", F.col("salary_min_hourly") <= F.col("salary_max_hourly")),
            Rule("date_sequence_invalid", F.col("closing_date") >= F.col("posting_date"))]


def stage_job_openings(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cleansed -> validated -> (loadable rows, rejected rows with reason).

    Rows without an opening id are rejected (they cannot be de-duplicated later)."""
    cleaned = clean_job_openings(raw).withColumns({
        "posting_date_key": dt.date_key("posting_date"), "report_year": F.year("posting_date")})
    return split_rejects(cleaned, job_opening_rules())


# --- L13-L15: HR dimensions --------------------------------------------------------------

# Seeded employment types (code, name, is-full-time).
EMPLOYMENT_TYPE_SEED = [("FT", "Full-Time", True), ("PT", "Part-Time", False), ("CT", "Contract", None),
                        ("ST", "Seasonal", False), ("TE", "Temporary", False)]
# Ordered LIKE classification of free-text employment types onto the seeded codes.
EMPLOYMENT_CLASS_RULES = [("%FULL%", "FT"), ("FT", "FT"), ("%PART%", "PT"), ("PT", "PT"), ("%TEMP%", "TE"),
                          ("%SEASONAL%", "ST"), ("%CONTRACT%", "CT")]


def dim_employment_type_seed(spark: SparkSession) -> DataFrame:
    rows = [(-1, "N/A", "Unknown Employment Type", None)] + [(i + 1, *r) for i, r in enumerate(EMPLOYMENT_TYPE_SEED)]
    return spark.createDataFrame(rows, "EmploymentTypeKey int, EmploymentTypeCode string, "
                                       "EmploymentTypeName string, IsFullTime boolean")


def dim_employment_type_load(staged_jobs: DataFrame, existing: DataFrame) -> DataFrame:
    """Classify staged employment types onto ONE code table (the seeded codes), keep
    the first name per code, insert codes not yet present."""
    t = F.trim("employment_type")
    src = staged_jobs.filter(F.col("employment_type").isNotNull() & (t != "")).select(
        cl.classify_like(t, EMPLOYMENT_CLASS_RULES, default="N/A").alias("EmploymentTypeCode"),
        t.alias("EmploymentTypeName"),
        F.when(F.upper(t).like("%FULL%"), True).when(F.upper(t).like("%PART%"), False).alias("IsFullTime"))
    src = keep_first(src, ["EmploymentTypeCode"], ["EmploymentTypeName"])
    return insert_new(existing, src, ["EmploymentTypeCode"], "EmploymentTypeKey")


# The department list the HR dimension is seeded from; roll-up members.
DEPARTMENT_NAMES = ["Administration", "Capital", "Customer Service", "Facility Maintenance", "Finance",
                    "General Administration", "Human Resources", "Information Technology", "Maintenance",
                    "Operating", "Operations", "Planning", "Safety", "Total", "Vehicle Maintenance",
                    "Vehicle Operations"]
ROLLUP_DEPARTMENTS = ["Total", "Operating", "Capital"]


def dim_department_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(-1, "N/A", "Unknown Department", None, False)],
                                 "DepartmentKey int, DepartmentCode string, DepartmentName string, "
                                 "NTDLaborObjectClass string, IsRollup boolean")


def dim_department_load(spark: SparkSession, existing: DataFrame) -> DataFrame:
    """MERGE (insert-only) of the department list on its upper-cased code; roll-up
    members ('Total', 'Operating', 'Capital') are flagged so they are not summed with
    real departments."""
    names = spark.createDataFrame([(n,) for n in DEPARTMENT_NAMES], "DepartmentName string")
    src = names.filter(F.trim("DepartmentName") != "").select(
        F.upper(cl.truncate(F.trim("DepartmentName"), 50)).alias("DepartmentCode"), "DepartmentName",
        F.col("DepartmentName").isin(*ROLLUP_DEPARTMENTS).alias("IsRollup"))
    return insert_new(existing, src, ["DepartmentCode"], "DepartmentKey")


def dim_job_role_seed(spark: SparkSession) -> DataFrame:
    import datetime as _d
    return spark.createDataFrame(
        [(-1, "Unknown Position", None, None, None, None, _d.date(1900, 1, 1), _d.date(9999, 12, 31), True)],
        "JobRoleKey int, PositionTitle string, LaborCategory string, OperatorStatus string, "
        "TypicalSalaryMin decimal(18,2), TypicalSalaryMax decimal(18,2), EffectiveDate date, "
        "ExpirationDate date, CurrentFlag boolean")


def dim_job_role_load(staged_jobs: DataFrame, existing: DataFrame, load_date, initial_effective=None) -> DataFrame:
    """One row per trimmed position title (MAX category / status, MIN of minimum and
    MAX of maximum salary), then SCD2 on those attributes."""
    title = F.trim("position_title")
    src = staged_jobs.filter(F.col("position_title").isNotNull() & (title != "")).groupBy(
        title.alias("PositionTitle")).agg(
            F.max(cl.truncate(F.trim("ntd_labor_object_class"), 100)).alias("LaborCategory"),
            F.max(cl.truncate(F.trim("operator_status"), 50)).alias("OperatorStatus"),
            F.min(F.col("salary_min_hourly").cast("decimal(18,2)")).alias("TypicalSalaryMin"),
            F.max(F.col("salary_max_hourly").cast("decimal(18,2)")).alias("TypicalSalaryMax"))
    return scd2_apply(existing, src, ["PositionTitle"],
                      ["LaborCategory", "OperatorStatus", "TypicalSalaryMin", "TypicalSalaryMax"], load_date,
                      "JobRoleKey", initial_effective=initial_effective)


# --- shared lookups -----------------------------------------------------------------------

def _lookups(dims: Mapping[str, DataFrame], date_col: str | Column, ntd: str, mode: str, tos: str,
             emp_type: str | Column, dept: str, title: str | None = None) -> list[Lookup]:
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    out = [Lookup(dims["agency"], [(ntd, "NTD_ID")], "AgencyKey", "AgencyKey", asof=d),
           Lookup(dims["mode"], [(mode, "ModeCode")], "ModeKey", "ModeKey", broadcast=True),
           Lookup(dims["service_type"], [(tos, "TOSCode")], "ServiceTypeKey", "ServiceTypeKey", broadcast=True),
           Lookup(dims["employment_type"], [(emp_type, "EmploymentTypeName")], "EmploymentTypeKey",
                  "EmploymentTypeKey", broadcast=SMALL_DIM_ROWS),
           Lookup(dims["department"], [(dept, "DepartmentName")], "DepartmentKey", "DepartmentKey", normalise=True,
                  broadcast=SMALL_DIM_ROWS)]
    if title is not None:
        out.append(Lookup(dims["job_role"], [(title, "PositionTitle")], "JobRoleKey", "JobRoleKey", asof=d))
    return out


def _date_key_lookup(calendar: DataFrame, col: str | Column, out: str, default: int | None = -1) -> Lookup:
    # Calendar: bounded by its date range, not by data volume -> broadcast.
    return Lookup(calendar.filter(F.col("DateKey") > 0), [(col, "FullDate")], "DateKey", out, default=default,
                  broadcast=True)


def _append(existing: DataFrame | FactTable, rows: DataFrame, grain: list[str], key_col: str, batch_id, source_system,
            load_ts, lineage: bool = True) -> FactChange | Staged:
    def finish(new: DataFrame) -> DataFrame:
        if not lineage:
            return new
        return with_lineage(new, batch_id, source_system, load_ts, batch_col="ETL_BatchID",
                            source_col="RecordSourceSystem", inserted_col="ETL_InsertDate").withColumn(
            "ETL_UpdateDate", F.lit(None).cast("timestamp"))

    return load_new(existing, rows, grain, key_col, finish)


# --- L19: job posting (transaction fact) ----------------------------------------------------

def empty_fact_job_posting(spark) -> DataFrame:
    return spark.createDataFrame([], "JobPostingFactKey bigint, DateKey int, AgencyKey int, ModeKey int, "
                                     "ServiceTypeKey int, EmploymentTypeKey int, DepartmentKey int, JobRoleKey int, "
                                     "OpeningID string, OpenPositions int, DaysOpen int, HiredCount int, "
                                     "SalaryMinHourly decimal(18,2), SalaryMaxHourly decimal(18,2), "
                                     "SalaryMidHourly decimal(18,2), PostingStatus string, VacancyReason string, "
                                     "ETL_InsertDate timestamp, ETL_UpdateDate timestamp, ETL_BatchID bigint, "
                                     "RecordSourceSystem string")


def latest_postings(staged_jobs: DataFrame) -> DataFrame:
    """The latest staged row per opening id (posting date, then date key, descending)."""
    return latest_per_key(staged_jobs.filter(F.col("opening_id").isNotNull()), ["opening_id"],
                          ["posting_date", "posting_date_key"])


def fact_job_posting(staged_jobs: DataFrame, calendar: DataFrame, dims: Mapping[str, DataFrame],
                     existing: DataFrame | FactTable, batch_id=None, source_system: str = "HR_Job_Openings",
                     load_ts=None) -> FactChange | Staged:
    """Latest row per opening, every key resolved as of the posting date, appended once
    per opening id."""
    p = latest_postings(staged_jobs)
    rows = resolve_keys(p, [_date_key_lookup(calendar, "posting_date", "DateKey")] +
                        _lookups(dims, "posting_date", "ntd_id", "mode_code", "tos", "employment_type", "department",
                                 "position_title"))
    fact_rows = rows.select("DateKey", "AgencyKey", "ModeKey", "ServiceTypeKey", "EmploymentTypeKey", "DepartmentKey",
                            "JobRoleKey", F.col("opening_id").alias("OpeningID"),
                            F.col("open_positions").alias("OpenPositions"), F.col("days_open").alias("DaysOpen"),
                            F.col("hired_count").alias("HiredCount"),
                            F.col("salary_min_hourly").alias("SalaryMinHourly"),
                            F.col("salary_max_hourly").alias("SalaryMaxHourly"),
                            F.col("salary_mid_hourly").alias("SalaryMidHourly"),
                            F.col("posting_status").alias("PostingStatus"),
                            F.col("vacancy_reason").alias("VacancyReason"))
    return _append(existing, fact_rows, ["OpeningID"], "JobPostingFactKey", batch_id, source_system, load_ts)


# --- L20: employee snapshot (periodic snapshot) ---------------------------------------------

SNAPSHOT_GRAIN = ["DateKey", "AgencyKey", "ModeKey", "ServiceTypeKey", "EmploymentTypeKey", "DepartmentKey"]
# Unified employment labels -> employment type names.
EMPLOYMENT_LABEL_TO_NAME = {"FullTime": "Full-Time", "PartTime": "Part-Time"}


def empty_fact_employee_snapshot(spark) -> DataFrame:
    m = ", ".join(f"{c} decimal(18,2)" for c in UNIFIED_MEASURES)
    return spark.createDataFrame([], "SnapshotFactKey bigint, DateKey int, AgencyKey int, ModeKey int, "
                                     f"ServiceTypeKey int, EmploymentTypeKey int, DepartmentKey int, {m}, "
                                     "HoursPerEmployee decimal(18,4), ETL_InsertDate timestamp, "
                                     "ETL_UpdateDate timestamp, ETL_BatchID bigint, RecordSourceSystem string")


def _year_start(unified: DataFrame, calendar: DataFrame) -> DataFrame:
    u = year_start_lookup(unified, "ReportYear", calendar, "DateKey")
    fd = calendar.filter(F.col("DateKey") > 0).select(F.col("DateKey").alias("_dk"), F.col("FullDate").alias("_fd"))
    return u.join(F.broadcast(fd), u["DateKey"] == fd["_dk"], "left").drop("_dk")


def combine_operator_split(unified: DataFrame) -> DataFrame:
    """One row per source grain: the Operator and Non Operator rows of a 2019+ file combined.

    Hours and counts of the two rows add up, as do the operating / capital measures, which each
    row carries for its own operator type.  What both rows repeat is taken once: the employee
    total, and the total hours of part-time rows (the whole part-time total)."""
    split = F.col("OperatorType").isNotNull()
    repeated = {"TotalEmployees": split, "TotalHours": split & (F.col("EmploymentType") == "PartTime")}
    zero = F.lit(0).cast("decimal(18,2)")

    def combined(m: str) -> Column:
        if m not in repeated:
            return F.sum(m)
        once = F.coalesce(repeated[m], F.lit(False))
        return F.coalesce(F.max(F.when(once, F.col(m))), zero) + F.coalesce(F.sum(F.when(~once, F.col(m))), zero)

    return unified.groupBy("ReportYear", "NTD_ID", "ModeCode", "TOSCode", "EmploymentType", "DepartmentName").agg(
        *[combined(m).cast("decimal(18,2)").alias(m) for m in UNIFIED_MEASURES])


def fact_employee_snapshot(unified: DataFrame, calendar: DataFrame, dims: Mapping[str, DataFrame],
                           existing: DataFrame | FactTable, batch_id=None, source_system: str = "NTD_Employees",
                           load_ts=None) -> FactChange | Staged:
    """The operator split combined (``combine_operator_split``), rows resolved as of
    January 1st of the report year, measures summed to the declared grain, hours per
    employee recomputed with a zero guard, appended when the grain is new."""
    u = _year_start(combine_operator_split(unified), calendar)
    emp = mapped_key("EmploymentType", EMPLOYMENT_LABEL_TO_NAME, "Unknown Employment Type")
    rows = resolve_keys(u, _lookups(dims, "_fd", "NTD_ID", "ModeCode", "TOSCode", emp, "DepartmentName"))
    agg = rows.groupBy(*SNAPSHOT_GRAIN).agg(*[F.sum(m).cast("decimal(18,2)").alias(m) for m in UNIFIED_MEASURES])
    agg = agg.withColumn("HoursPerEmployee", cl.guarded_ratio("HoursWorked", "EmployeeCount", "decimal(18,4)"))
    return _append(existing, agg, SNAPSHOT_GRAIN, "SnapshotFactKey", batch_id, source_system, load_ts)


# --- L21: agency labor coverage (factless) ---------------------------------------------------

COVERAGE_GRAIN = ["DateKey", "AgencyKey", "DepartmentKey", "ModeKey", "ServiceTypeKey", "EmploymentTypeKey"]


def empty_fact_labor_coverage(spark) -> DataFrame:
    return spark.createDataFrame([], "CoverageFactKey bigint, DateKey int, AgencyKey int, DepartmentKey int, "
                                     "ModeKey int, ServiceTypeKey int, EmploymentTypeKey int")


def fact_labor_coverage(unified: DataFrame, calendar: DataFrame, dims: Mapping[str, DataFrame],
                        existing: DataFrame | FactTable) -> FactChange | Staged:
    """Distinct coverage grain with hours > 0 -> keys (as of Jan 1st) -> dedup of
    the resolved grain -> agency required -> appended when new (null-safe grain)."""
    g = unified.filter(F.col("HoursWorked") > 0).select("ReportYear", "NTD_ID", "ModeCode", "TOSCode",
                                                         "DepartmentName", "EmploymentType").distinct()
    g = g.withColumn("_jan1", dt.first_of_year("ReportYear"))
    g = resolve_keys(g, [_date_key_lookup(calendar, "_jan1", "DateKey")])
    # The as-of date is the calendar row's date: a year missing from the calendar cannot
    # resolve its agency either, so that coverage row is not loaded.
    g = g.withColumn("_fd", F.when(F.col("DateKey") != -1, F.col("_jan1")))
    emp = mapped_key("EmploymentType", EMPLOYMENT_LABEL_TO_NAME, F.col("EmploymentType"))
    rows = resolve_keys(g, _lookups(dims, "_fd", "NTD_ID", "ModeCode", "TOSCode", emp, "DepartmentName"))
    rows = drop_unresolved(dedup_grain(rows.select(*COVERAGE_GRAIN), COVERAGE_GRAIN), "AgencyKey")
    return _append(existing, rows, COVERAGE_GRAIN, "CoverageFactKey", None, None, None, lineage=False)


# --- L22: job posting lifecycle (accumulating snapshot) -------------------------------------

def empty_fact_posting_lifecycle(spark) -> DataFrame:
    return spark.createDataFrame([], "LifecycleFactKey bigint, AgencyKey int, ModeKey int, ServiceTypeKey int, "
                                     "EmploymentTypeKey int, DepartmentKey int, JobRoleKey int, OpeningID string, "
                                     "PostingDateKey int, FilledDateKey int, ClosingDateKey int, DaysOpen int, "
                                     "OpenPositions int, HiredCount int, PostingStatus string")


def fact_posting_lifecycle(staged_jobs: DataFrame, calendar: DataFrame, dims: Mapping[str, DataFrame],
                           existing: DataFrame | FactTable) -> FactChange | Staged:
    """One row per opening with three role-playing milestone dates (posting,
    filled - kept only when not before posting -, closing).  Matched openings keep a known
    milestone when the new one is unknown and take the new measures / status; new
    openings are inserted with fresh keys."""
    p = latest_postings(staged_jobs)
    rows = resolve_keys(p, [_date_key_lookup(calendar, "posting_date", "PostingDateKey"),
                            _date_key_lookup(calendar, "filled_date", "_fill", default=None),
                            _date_key_lookup(calendar, "closing_date", "ClosingDateKey", default=None)] +
                        _lookups(dims, "posting_date", "ntd_id", "mode_code", "tos", "employment_type", "department",
                                 "position_title"))
    incoming = rows.select(
        F.lit(None).cast("bigint").alias("LifecycleFactKey"), "AgencyKey", "ModeKey", "ServiceTypeKey",
        "EmploymentTypeKey", "DepartmentKey", "JobRoleKey", F.col("opening_id").alias("OpeningID"), "PostingDateKey",
        F.when((F.col("PostingDateKey") != -1), cl.keep_if_not_before("_fill", "PostingDateKey")).alias("FilledDateKey"),
        "ClosingDateKey", F.col("days_open").alias("DaysOpen"), F.col("open_positions").alias("OpenPositions"),
        F.col("hired_count").alias("HiredCount"), F.col("posting_status").alias("PostingStatus"))
    return load_accumulating(
        existing, incoming, ["OpeningID"], "LifecycleFactKey", lambda old, inc: accumulating_conditional(
            old, inc, ["OpeningID"], milestones=["PostingDateKey", "FilledDateKey", "ClosingDateKey"],
            measures=["DaysOpen", "OpenPositions", "HiredCount", "PostingStatus"], change_col=CHANGE))


# --- Q7: post-load data-quality report of the job-opening staging ---------------------------

def job_openings_dq_report(staged_jobs: DataFrame) -> DataFrame:
    """Expected-zero checks on the loaded postings (NULL critical fields, salary range, date
    order) as (check, violations) rows, computed in one aggregate pass."""
    from martkit.operators.quality import check_rules
    rules = [Rule("null_critical_fields", F.col("opening_id").isNotNull() & F.col("posting_date").isNotNull() &
                  F.col("employment_type").isNotNull(), null_passes=False),
             Rule("salary_range", F.col("salary_min_hourly") <= F.col("salary_max_hourly")),
             Rule("date_order", F.col("closing_date") >= F.col("posting_date"))]
    return check_rules(staged_jobs, rules).withColumnRenamed("rule", "check")


def job_openings_summary(staged_jobs: DataFrame) -> DataFrame:
    """Postings and average salaries by employment type, most frequent first."""
    return staged_jobs.groupBy("employment_type").agg(
        F.count(F.lit(1)).alias("postings"),
        F.avg("salary_min_hourly").cast("decimal(18,2)").alias("avg_salary_min"),
        F.avg("salary_max_hourly").cast("decimal(18,2)").alias("avg_salary_max")).orderBy(F.desc("postings"),
                                                                                          "employment_type")

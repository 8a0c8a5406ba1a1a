"""Service (transport) mart: staging loaders, dimensions and the four facts
(L1-L5, L16-L18, L23-L26).

Raw inputs are all-string DataFrames with the feed's own header names.  Staging is one
declarative column spec per feed; dimensions and facts are composed from the operator
library (SCD, lookups, unpivot + alignment, idempotent append, accumulating upsert).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.functions import cleanse as cl
from martkit.functions import dates as dt
from martkit.functions.spec import Col, project
from martkit.operators.aggregates import arg_max, mode_per_group, sum_zero
from martkit.operators.dedup import keep_first
from martkit.operators.facts import FactChange, accumulating_replace, load_accumulating, load_new, with_lineage
from martkit.operators.lookup import Lookup, drop_unresolved, resolve_keys, year_start_lookup
from martkit.operators.reshape import align_metrics, unpivot_years
from martkit.operators.rollup import Rollup
from martkit.operators.scd import insert_new, scd1_upsert, scd2_apply
from martkit.sources.fact_table import CHANGE, FactTable, Staged

# Dimensions bounded by code lists or the calendar are broadcast after a row check.
SMALL_DIM_ROWS = 1_000_000


def _t(target: str, raw: str, n: int | None = None, token: str = "None") -> Col:
    return Col(target, raw, "text", length=n, token=token)


# --- L1: agency information ------------------------------------------------------------

# Raw header names of the agency feed and the staging column lengths.
AGENCY_INFO_SPEC = [
    _t("state_parent_ntd_id", "State/Parent NTD ID", 50), _t("ntd_id", "NTD ID", 50),
    _t("legacy_ntd_id", "Legacy NTD ID", 50), _t("agency_name", "Agency Name", 255),
    _t("division_department", "Division/Department", 255), _t("reporter_acronym", "Reporter Acronym", 50),
    _t("doing_business_as", "Doing Business As", 255), _t("reporter_type", "Reporter Type", 100),
    _t("reporting_module", "Reporting Module", 50), _t("organization_type", "Organization Type", 255),
    _t("reported_by_ntd_id", "Reported By NTD ID", 50), _t("reported_by_name", "Reported by Name", 255),
    _t("public_sponsor", "Public Sponsor", 255), _t("subrecipient_type", "Subrecipient Type", 100),
    Col("fy_end_date", "FY End Date", "expr", fn=lambda c: dt.safe_date(cl.null_if_token(c, "None"))),
    Col("original_due_date", "Original Due Date", "expr", fn=lambda c: dt.safe_date(cl.null_if_token(c, "None"))),
    _t("address_line_1", "Address Line 1", 255), _t("address_line_2", "Address Line 2", 255),
    _t("po_box", "P.O. Box", 100), _t("city", "City", 100), _t("state", "State", 20),
    Col("zip_code", "Zip Code", "code"), Col("zip_code_ext", "Zip Code Ext", "code"),
    Col("region", "Region", "float_int"), _t("url", "URL", 500), _t("fta_recipient_id", "FTA Recipient ID", 50),
    _t("ueid", "UEID", 50), Col("service_area_sq_miles", "Service Area Sq Miles", "decimal"),
    Col("service_area_pop", "Service Area Pop", "float_bigint"),
    Col("primary_uza_uace_code", "Primary UZA UACE Code", "expr",
        fn=lambda c: cl.truncate(cl.strip_decimal_suffix(F.trim(c)), 50)),
    _t("uza_name", "UZA Name", 255), _t("tribal_area_name", "Tribal Area Name", 255),
    Col("population", "Population", "float_bigint"), Col("density", "Density", "decimal"),
    Col("sq_miles", "Sq Miles", "decimal"), Col("voms_do", "VOMS DO", "decimal"), Col("voms_pt", "VOMS PT", "decimal"),
    Col("total_voms", "Total VOMS", "decimal"), Col("volunteer_drivers", "Volunteer Drivers", "decimal"),
    Col("personal_vehicles", "Personal Vehicles", "decimal"), _t("tam_tier", "TAM Tier", 100),
    Col("number_of_state_counties", "Number of State Counties", "decimal"),
    Col("number_of_counties_with_service", "Number of Counties with Service", "decimal"),
    Col("state_admin_funds_expended", "State Admin Funds Expended", "decimal"),
]


def stage_agency_information(raw: DataFrame) -> DataFrame:
    """L1: typed agency staging, one row per NTD id (deterministic pick among duplicates)."""
    staged = project(raw, AGENCY_INFO_SPEC)
    return keep_first(staged, ["ntd_id"])


# --- L2: agency mode / type of service ------------------------------------------------

# Raw header names of the mode / type-of-service feed and staging lengths.
AGENCY_MODE_SERVICE_SPEC = [
    _t("state_parent_ntd_id", "State/Parent NTD ID", 50), _t("ntd_id", "NTD ID", 50),
    _t("agency_name", "Agency Name", 255), _t("reporter_type", "Reporter Type", 100),
    _t("reporting_module", "Reporting Module", 50), _t("mode", "Mode", 20), _t("type_of_service_code", "TOS", 20),
    Col("voms", "Vehicles Operated at Maximum Service (VOMS)", "float_decimal"),
    Col("vams", "Vehicles Available at Maximum Service (VAMS)", "float_decimal"),
    _t("rail", "Rail", 5), _t("fixed_route", "Fixed Route", 5), _t("seasonal_segment", "Seasonal Segment", 5),
    _t("fixed_guideway_high_intensity", "Fixed Guideway/High Intensity", 5), _t("service_type", "Service Type", 100),
    Col("commitment_date", "Commitment Date", "expr", fn=lambda c: dt.safe_date(cl.null_if_token(c, "None"))),
    Col("start_service_date", "Start Service Date", "expr", fn=lambda c: dt.safe_date(cl.null_if_token(c, "None"))),
    Col("end_service_date", "End Service Date", "expr", fn=lambda c: dt.safe_date(cl.null_if_token(c, "None"))),
]


def stage_agency_mode_service(raw: DataFrame) -> DataFrame:
    """L2: typed agency x mode x type-of-service periods."""
    return project(raw, AGENCY_MODE_SERVICE_SPEC)


# --- L3 / L4: yearly metric time series ------------------------------------------------

# The metric files, their year ranges and (in _metric_spec) their headers.
CURRENT_METRICS = ["drm", "fares", "opexp_total", "upt", "pmt", "vrm", "vrh", "voms"]
ARCHIVE_METRICS = ["drm", "upt", "pmt", "vrm", "vrh", "opexp_total"]
CURRENT_YEARS = list(range(2015, 2025))
ARCHIVE_YEARS = list(range(1991, 2015))


def _metric_spec(years: list[int], archive: bool) -> list[Col]:
    blank = ""
    head = [] if archive else [Col("last_report_year", "Last Report Year", "int", token=blank)]
    ids = [Col("ntd_id", "NTD ID", "float_id", token=blank)] if archive else [_t("ntd_id", "NTD ID", 50, blank)]
    if archive:
        ids.append(_t("legacy_ntd_id", "Legacy NTD ID", 50, blank))
    body = [_t("agency_name", "Agency Name", 255, blank)]
    if not archive:
        body.append(_t("agency_status", "Agency Status", 50, blank))
    body += [_t("reporter_type", "Reporter Type", 100, blank), _t("reporting_module", "Reporting Module", 50, blank),
             _t("city", "City", 100, blank), _t("state", "State", 20, blank),
             Col("census_year", "Census Year", "int", token=blank) if archive else
             _t("census_year", "Census Year", 20, blank),
             _t("primary_uza_name", "Primary UZA Name", 255, blank),
             Col("uace_code", "UACE Code", "float_id", token=blank),
             Col("uza_area_sq_miles", "UZA Area SQ Miles", "float_decimal", token=blank),
             Col("uza_population", "UZA Population", "float_bigint", token=blank)]
    if archive:
        body += [_t("mode", "Mode", 20, blank), _t("service", "Service", 20, blank),
                 _t("mode_status", "Mode Status", 50, blank)]
    else:
        body += [_t("mode_status", "Mode_Status", 50, blank), _t("mode", "Mode", 20, blank),
                 _t("type_of_service", "Type of Service", 20, blank)]
    ys = [Col(f"y{y}", str(y), "float_decimal", token=blank) for y in years]
    return head + ids + body + ys


def stage_metric(raw: DataFrame, archive: bool = False) -> DataFrame:
    """L3/L4: one generic loader for every yearly metric file (current 2015-2024 or archive
    1991-2014): float-formatted text -> numbers, ids and codes stripped of '.0'."""
    return project(raw, _metric_spec(ARCHIVE_YEARS if archive else CURRENT_YEARS, archive))


# --- L5: major safety events -----------------------------------------------------------

def _int(c: str) -> Column:
    return F.col(f"`{c}`").try_cast("int")


# Header prefixes of the passenger and employee casualty columns.
FATALITY_PARTS = (["Transit Vehicle Rider", "People Waiting or Leaving"],
                  ["Transit Vehicle Operator", "Non-Operator Transit Employee", "Other Worker"])


def stage_safety_events(raw: DataFrame) -> DataFrame:
    """One row per incident number; passenger / employee buckets summed NULL-as-0 and
    'other' = total - passenger - employee clamped at 0 (NULL total stays NULL)."""
    incident = F.col("`Incident Number`").try_cast("bigint")
    cols = [incident.alias("incident_number"),
            cl.clean_text("NTD ID", 50, "").alias("ntd_id"), cl.clean_text("Agency", 255, "").alias("agency_name"),
            cl.clean_text("Primary UZA UACE Code", 50, "").alias("primary_uza_uace_code"),
            cl.clean_text("Mode", 20, "").alias("mode"), cl.clean_text("TOS", 20, "").alias("type_of_service_code"),
            dt.parse_date(F.col("`Event Date`")).alias("event_date"), dt.safe_time(F.col("`Event Time`")).alias("event_time"),
            _int("Year").alias("year"),
            cl.clean_text("Event Category", 100, "").alias("event_category"),
            cl.clean_text("Event Type", 200, "").alias("event_type"),
            cl.clean_text("Event Type Group", 100, "").alias("event_type_group"),
            cl.clean_text("Safety/Security", 20, "").alias("safety_security"),
            F.col("`Event Description`").alias("event_description")]
    for kind in ("Fatalities", "Injuries"):
        word = "fatality" if kind == "Fatalities" else "injury"
        passenger = [_int(f"{p} {kind}") for p in FATALITY_PARTS[0]]
        employee = [_int(f"{p} {kind}") for p in FATALITY_PARTS[1]]
        total = _int(f"Total {kind}")
        cols += [cl.sum_null_zero(*passenger).alias(f"passenger_{word}_count"),
                 cl.sum_null_zero(*employee).alias(f"employee_{word}_count"),
                 cl.clamped_remainder(total, *(passenger + employee)).alias(f"other_{word}_count"),
                 total.alias(f"total_{word}_count")]
    cols += [_int("Number of Transit Vehicles Involved").alias("number_of_transit_vehicles_involved"),
             cl.text_to_flag(F.col("`Evacuation`")).alias("evacuation"),
             F.replace(F.col("`Property Damage`"), F.lit(","), F.lit("")).try_cast("decimal(18,2)")
             .alias("property_damage_amount")]
    staged = raw.select(*cols)
    return keep_first(staged, ["incident_number"])


# --- L16: urban area (SCD2) --------------------------------------------------------------

def empty_dim_urban_area(spark) -> DataFrame:
    return spark.createDataFrame(
        [(-1, "N/A", "Unknown Urban Area", None, None, None, _dt.date(1900, 1, 1), _dt.date(9999, 12, 31), True)],
        "UrbanAreaKey int, UACECode string, UZAName string, UZASqMiles decimal(18,2), UZAPopulation bigint, "
        "UZADensity decimal(18,2), EffectiveDate date, ExpirationDate date, CurrentFlag boolean")


def dim_urban_area_load(staged_agency: DataFrame, existing: DataFrame, load_date,
                        initial_effective=None) -> DataFrame:
    """One row per UACE code (MAX over the agencies that report it), then SCD2."""
    code = F.trim("primary_uza_uace_code")
    src = staged_agency.filter(F.col("primary_uza_uace_code").isNotNull() & (code != "")) \
        .groupBy(code.alias("UACECode")).agg(
            F.max(cl.null_if_blank("uza_name")).alias("UZAName"),
            F.max("sq_miles").cast("decimal(18,2)").alias("UZASqMiles"),
            F.max("population").cast("bigint").alias("UZAPopulation"),
            F.max("density").cast("decimal(18,2)").alias("UZADensity"))
    return scd2_apply(existing, src, ["UACECode"], ["UZAName", "UZASqMiles", "UZAPopulation", "UZADensity"],
                      load_date, "UrbanAreaKey", initial_effective=initial_effective)


# --- L17: safety event type (insert-only, null-safe) ------------------------------------

# safety/security spellings -> severity level.
SEVERITY_MAP = {"Safety": ["SFT", "SAFETY"], "Security": ["SEC", "SECURITY"]}


def severity_level(c: str | Column) -> Column:
    """One shared classifier for the dimension load and the fact lookup; other text kept."""
    col = F.col(c) if isinstance(c, str) else c
    u = F.upper(col)
    out = None
    for target, spellings in SEVERITY_MAP.items():
        cond = u.isin(*spellings)
        out = F.when(cond, F.lit(target)) if out is None else out.when(cond, F.lit(target))
    return out.otherwise(col)


def _event_type_columns(staged: DataFrame) -> DataFrame:
    return staged.select(
        cl.null_if_blank("event_category").alias("EventCategory"),
        F.coalesce(cl.null_if_blank("event_type"), F.lit("Unknown")).alias("EventType"),
        cl.null_if_blank("event_type_group").alias("EventSubType"),
        severity_level(cl.null_if_blank("safety_security")).alias("SeverityLevel"))


def empty_dim_safety_event_type(spark) -> DataFrame:
    return spark.createDataFrame([(-1, "Unknown", "Unknown", None, None)],
                                 "SafetyEventTypeKey int, EventCategory string, EventType string, "
                                 "EventSubType string, SeverityLevel string")


EVENT_TYPE_GRAIN = ["EventCategory", "EventType", "EventSubType", "SeverityLevel"]


def dim_safety_event_type_load(staged_events: DataFrame, existing: DataFrame) -> DataFrame:
    """Distinct (category, type, sub-type, severity) combinations inserted when not
    present, compared NULL-safely."""
    src = _event_type_columns(staged_events).filter(F.col("EventCategory").isNotNull()).distinct()
    return insert_new(existing, src, EVENT_TYPE_GRAIN, "SafetyEventTypeKey", null_safe=True)


# --- L18: safety incident (SCD1) ---------------------------------------------------------

def empty_dim_safety_incident(spark) -> DataFrame:
    return spark.createDataFrame([(-1, "N/A", "Unknown Safety Incident")],
                                 "SafetyIncidentKey int, SourceEventID string, EventDescription string")


def dim_safety_incident_load(staged_events: DataFrame, existing: DataFrame) -> DataFrame:
    """Type-1 incident dimension - description overwritten only when it changed."""
    src = staged_events.select(F.trim(F.col("incident_number").cast("string")).alias("SourceEventID"),
                               F.trim("event_description").alias("EventDescription")) \
        .filter(F.col("SourceEventID").isNotNull() & (F.col("SourceEventID") != ""))
    return scd1_upsert(existing, src, ["SourceEventID"], "SafetyIncidentKey", ["EventDescription"])


# --- shared lookups ------------------------------------------------------------------------

def _date_lookup(calendar: DataFrame, col: str | Column, out: str, default: int | None = -1) -> Lookup:
    # Calendar: bounded by its date range, not by data volume -> broadcast.
    return Lookup(calendar.filter(F.col("DateKey") > 0), [(col, "FullDate")], "DateKey", out, default=default,
                  broadcast=True)


def _agency_lookup(agency: DataFrame, ntd: str | Column, asof: Column, interval: str = "closed") -> Lookup:
    return Lookup(agency, [(ntd, "NTD_ID")], "AgencyKey", "AgencyKey", asof=asof, interval=interval)


def _mode_lookup(mode: DataFrame, col: str | Column) -> Lookup:
    return Lookup(mode, [(col, "ModeCode")], "ModeKey", "ModeKey", broadcast=True)


def _tos_lookup(tos: DataFrame, col: str | Column) -> Lookup:
    return Lookup(tos, [(col, "TOSCode")], "ServiceTypeKey", "ServiceTypeKey", broadcast=True)


def _urban_lookup(urban: DataFrame, col: str | Column, asof: Column) -> Lookup:
    return Lookup(urban, [(col, "UACECode")], "UrbanAreaKey", "UrbanAreaKey", asof=asof)


def _publish_rows(existing: DataFrame | FactTable, rows: DataFrame, grain: list[str], key_col: str, reload: bool,
                  batch_id: int | None, source_system: str, load_ts: Column | None,
                  by_batch: bool = False) -> FactChange | Staged:
    """Idempotent append (only rows whose grain is new, keyed after the current maximum,
    with lineage columns) or, when reloading, the reloaded grain replaced.  ``by_batch``: a reload also drops
    everything that this batch id loaded before, so rows withdrawn from a batch that is sent again do not
    stay; such facts are partitioned by batch."""
    def finish(new: DataFrame) -> DataFrame:
        return with_lineage(new, batch_id, source_system, load_ts, batch_col="ETL_BatchID",
                            source_col="RecordSourceSystem", inserted_col="ETL_InsertDate").withColumn(
            "ETL_UpdateDate", F.lit(None).cast("timestamp"))

    own = by_batch and batch_id is not None
    return load_new(existing, rows, grain, key_col, finish, reload, [batch_id] if own else [],
                    F.col("ETL_BatchID").eqNullSafe(F.lit(batch_id)) if own else None)


# --- L23: annual service performance (periodic snapshot) ---------------------------------

# Staged metric name -> fact measure and its type.
ANNUAL_MEASURES = {"upt": ("UPT", "bigint"), "pmt": ("PMT", "bigint"), "vrm": ("VRM", "bigint"),
                   "vrh": ("VRH", "bigint"), "voms": ("VOMS", "int"), "drm": ("DRM", "bigint"),
                   "fares": ("Fares", "decimal(18,2)"), "opexp_total": ("OperatingExpenseTotal", "decimal(18,2)")}
ANNUAL_GRAIN = ["DateKey", "AgencyKey", "ModeKey", "ServiceTypeKey"]


def empty_fact_annual(spark) -> DataFrame:
    measures = ", ".join(f"{m} {t}" for m, t in ANNUAL_MEASURES.values())
    return spark.createDataFrame([], "AnnualServicePerformanceKey bigint, DateKey int, AgencyKey int, ModeKey int, "
                                     f"ServiceTypeKey int, UrbanAreaKey int, {measures}, ETL_InsertDate timestamp, "
                                     "ETL_UpdateDate timestamp, ETL_BatchID bigint, RecordSourceSystem string")


def fact_annual_service_performance(metrics: Mapping[str, DataFrame], calendar: DataFrame, agency: DataFrame,
                                    mode: DataFrame, tos: DataFrame, urban: DataFrame, existing: DataFrame | FactTable,
                                    batch_id: int | None = None, source_system: str = "NTD_Annual_Performance",
                                    reload: bool = False, load_ts: Column | None = None) -> FactChange | Staged:
    """Every staged metric unpivoted (year columns -> rows), aligned on
    (year, agency, mode, service) in ONE conditional aggregate, the urban area taken as
    the most frequent code of that key, keys resolved as of January 1st of the year, rows
    aggregated to the declared grain and appended idempotently (or reloaded by grain).
    Rows whose agency does not resolve are dropped."""
    g = ["ReportYear", "ntd_id", "mode", "type_of_service"]
    longs = {}
    code_rows = []
    for name, staged in metrics.items():
        years = [c for c in staged.columns if c.startswith("y") and c[1:].isdigit()]
        long = unpivot_years(staged, ["ntd_id", "uace_code", "mode", "type_of_service"], years,
                             value_col="value", year_col="ReportYear")
        longs[ANNUAL_MEASURES[name][0]] = long
        code_rows.append(long.select(*g, "uace_code"))
    aligned = align_metrics(longs, g)
    codes = mode_per_group(code_rows[0].unionByName(*code_rows[1:]) if len(code_rows) > 1 else code_rows[0],
                           g, "uace_code", out="uace_code")
    rows = aligned.join(codes, [aligned[c].eqNullSafe(codes[c]) for c in g], "left") \
        .select(*[aligned[c] for c in g], codes["uace_code"], *[aligned[m] for m in longs])
    rows = year_start_lookup(rows, "ReportYear", calendar, "DateKey")
    cal_dates = calendar.filter(F.col("DateKey") > 0).select(F.col("DateKey").alias("_dk"), F.col("FullDate").alias("_fd"))
    rows = rows.join(F.broadcast(cal_dates), rows["DateKey"] == cal_dates["_dk"], "left")
    asof = dt.asof_date(F.col("_fd"), F.col("ReportYear"))
    rows = resolve_keys(rows, [_agency_lookup(agency, "ntd_id", asof), _mode_lookup(mode, "mode"),
                               _tos_lookup(tos, "type_of_service"), _urban_lookup(urban, "uace_code", asof)])
    rows = drop_unresolved(rows, "AgencyKey")
    aggs = [F.max(m).cast(ANNUAL_MEASURES[k][1]).alias(m) for k, (m, _) in ANNUAL_MEASURES.items() if m in longs]
    fact_rows = rows.groupBy(*ANNUAL_GRAIN).agg(F.max("UrbanAreaKey").alias("UrbanAreaKey"), *aggs)
    for k, (m, t) in ANNUAL_MEASURES.items():
        if m not in fact_rows.columns:
            fact_rows = fact_rows.withColumn(m, F.lit(None).cast(t))
    return _publish_rows(existing, fact_rows, ANNUAL_GRAIN, "AnnualServicePerformanceKey", reload, batch_id,
                         source_system, load_ts)


# --- L24: major safety event (transaction fact) -------------------------------------------

SAFETY_MEASURES = ["PassengerFatalityCount", "EmployeeFatalityCount", "OtherFatalityCount", "TotalFatalityCount",
                   "PassengerInjuryCount", "EmployeeInjuryCount", "OtherInjuryCount", "TotalInjuryCount"]


def empty_fact_safety(spark) -> DataFrame:
    m = ", ".join(f"{c} int" for c in SAFETY_MEASURES)
    return spark.createDataFrame([], "MajorSafetyEventKey bigint, EventDateKey int, AgencyKey int, ModeKey int, "
                                     "ServiceTypeKey int, UrbanAreaKey int, SafetyEventTypeKey int, "
                                     f"SafetyIncidentDescriptionKey int, SourceIncidentID string, EventTime string, {m}, "
                                     "VehicleInvolvedCount int, EvacuationCount int, PropertyDamageAmount decimal(18,2), "
                                     "ETL_InsertDate timestamp, ETL_UpdateDate timestamp, ETL_BatchID bigint, "
                                     "RecordSourceSystem string")


def fact_major_safety_event(staged_events: DataFrame, calendar: DataFrame, agency: DataFrame, mode: DataFrame,
                            tos: DataFrame, urban: DataFrame, event_type: DataFrame, incident: DataFrame,
                            existing: DataFrame | FactTable, batch_id: int | None = None,
                            source_system: str = "NTD_Major_Safety_Events", reload: bool = False,
                            load_ts: Column | None = None) -> FactChange | Staged:
    """One row per incident, every dimension resolved (as of the event date for the
    SCD2 ones, null-safe on the 4-column event type, cast id for the incident), appended
    once per incident id (degenerate dimension) or reloaded."""
    e = staged_events.filter(F.col("incident_number").isNotNull())
    types = _event_type_columns(e).columns
    e = e.select("*", *[c.alias(f"_et_{n}") for n, c in zip(types, [
        cl.null_if_blank("event_category"), F.coalesce(cl.null_if_blank("event_type"), F.lit("Unknown")),
        cl.null_if_blank("event_type_group"), severity_level(cl.null_if_blank("safety_security"))])])
    d = F.col("event_date")
    rows = resolve_keys(e, [
        _date_lookup(calendar, "event_date", "EventDateKey"),
        _agency_lookup(agency, "ntd_id", d), _mode_lookup(mode, "mode"), _tos_lookup(tos, "type_of_service_code"),
        _urban_lookup(urban, "primary_uza_uace_code", d),
        Lookup(event_type, [(f"_et_{c}", c) for c in EVENT_TYPE_GRAIN], "SafetyEventTypeKey", "SafetyEventTypeKey",
               null_safe=True, broadcast=SMALL_DIM_ROWS),
        Lookup(incident, [(F.col("incident_number").cast("string"), "SourceEventID")], "SafetyIncidentKey",
               "SafetyIncidentDescriptionKey")])
    fact_rows = rows.select(
        "EventDateKey", "AgencyKey", "ModeKey", "ServiceTypeKey", "UrbanAreaKey", "SafetyEventTypeKey",
        "SafetyIncidentDescriptionKey", F.col("incident_number").cast("string").alias("SourceIncidentID"),
        F.col("event_time").alias("EventTime"),
        F.col("passenger_fatality_count").alias("PassengerFatalityCount"),
        F.col("employee_fatality_count").alias("EmployeeFatalityCount"),
        F.col("other_fatality_count").alias("OtherFatalityCount"),
        F.col("total_fatality_count").alias("TotalFatalityCount"),
        F.col("passenger_injury_count").alias("PassengerInjuryCount"),
        F.col("employee_injury_count").alias("EmployeeInjuryCount"),
        F.col("other_injury_count").alias("OtherInjuryCount"),
        F.col("total_injury_count").alias("TotalInjuryCount"),
        F.col("number_of_transit_vehicles_involved").alias("VehicleInvolvedCount"),
        F.when(F.col("evacuation"), 1).otherwise(0).alias("EvacuationCount"),
        F.col("property_damage_amount").alias("PropertyDamageAmount"))
    return _publish_rows(existing, fact_rows, ["SourceIncidentID"], "MajorSafetyEventKey", reload, batch_id,
                         source_system, load_ts, by_batch=True)


# --- L25: service availability (factless coverage over periods) ------------------------

AVAILABILITY_GRAIN = ["AgencyKey", "ModeKey", "ServiceTypeKey", "CommitmentDateKey", "StartDateKey", "EndDateKey"]
# Service-type texts that describe actual service periods.
SERVICE_PERIOD_TYPES = ("Active Service", "Ending Service")


def empty_fact_availability(spark) -> DataFrame:
    return spark.createDataFrame([], "ServiceAvailabilityKey bigint, AgencyKey int, ModeKey int, ServiceTypeKey int, "
                                     "CommitmentDateKey int, StartDateKey int, EndDateKey int, ServiceActiveFlag boolean, "
                                     "ETL_InsertDate timestamp, ETL_UpdateDate timestamp, ETL_BatchID bigint, "
                                     "RecordSourceSystem string")


def fact_service_availability(staged_ams: DataFrame, calendar: DataFrame, agency: DataFrame, mode: DataFrame,
                              tos: DataFrame, existing: DataFrame | FactTable, batch_id: int | None = None,
                              source_system: str = "NTD_Agency_Mode_Service", reload: bool = False,
                              load_ts: Column | None = None) -> FactChange | Staged:
    """Distinct service periods (duplicate periods collapse), actual-service rows only,
    keys resolved as of the start date, a known start date and agency required, open end
    -> 99991231, appended when the (null-safe) period grain is new."""
    period = ["ntd_id", "mode", "type_of_service_code", "service_type", "commitment_date", "start_service_date",
              "end_service_date"]
    s = staged_ams.select(*period).filter(F.col("service_type").isin(*SERVICE_PERIOD_TYPES)).distinct()
    rows = resolve_keys(s, [
        _agency_lookup(agency, "ntd_id", F.col("start_service_date")), _mode_lookup(mode, "mode"),
        _tos_lookup(tos, "type_of_service_code"),
        _date_lookup(calendar, "commitment_date", "CommitmentDateKey", default=None),
        _date_lookup(calendar, "start_service_date", "StartDateKey", default=None),
        _date_lookup(calendar, "end_service_date", "EndDateKey", default=None)])
    rows = rows.filter(F.col("StartDateKey").isNotNull())
    rows = drop_unresolved(rows, "AgencyKey")
    # 'Ending Service' -> inactive; 'Active Service' (and anything unclear) -> active.
    fact_rows = rows.select(*AVAILABILITY_GRAIN[:-1], dt.open_ended_key("EndDateKey").alias("EndDateKey"),
                            (~cl.status_flag("service_type", ["Ending Service"])).alias("ServiceActiveFlag"))
    # One row per declared grain; when an active and an ending record share it, the ending
    # record wins (deterministically).
    fact_rows = keep_first(fact_rows, AVAILABILITY_GRAIN, [F.col("ServiceActiveFlag").asc()])
    return _publish_rows(existing, fact_rows, AVAILABILITY_GRAIN, "ServiceAvailabilityKey", reload, batch_id,
                         source_system, load_ts, by_batch=True)


# --- L26: service lifecycle (accumulating snapshot) --------------------------------------

LIFECYCLE_KEY = ["AgencyKey", "ModeKey", "ServiceTypeKey"]
PEAK_MEASURES = [("UPT", "bigint"), ("VRM", "bigint"), ("VRH", "bigint"), ("VOMS", "int")]


def empty_fact_lifecycle(spark) -> DataFrame:
    peaks = ", ".join(f"Peak{m}DateKey int" for m, _ in PEAK_MEASURES)
    vals = ", ".join(f"PeakAnnual{m} {t}, LatestAnnual{m} {t}" for m, t in PEAK_MEASURES)
    totals = ", ".join(f"TotalObserved{m} bigint" for m, _ in PEAK_MEASURES[:3])
    return spark.createDataFrame([], "ServiceLifecycleKey bigint, AgencyKey int, ModeKey int, ServiceTypeKey int, "
                                     f"UrbanAreaKey int, FirstObservedDateKey int, CommitmentDateKey int, {peaks}, "
                                     "LatestObservedDateKey int, EndServiceDateKey int, YearsInService int, "
                                     f"{vals}, {totals}, TotalObservedMajorSafetyEvents bigint, "
                                     "TotalObservedFatalities bigint, TotalObservedInjuries bigint, "
                                     "LifecycleCompleteFlag boolean, ETL_InsertDate timestamp, "
                                     "ETL_UpdateDate timestamp, ETL_BatchID bigint, RecordSourceSystem string")


#: What the lifecycle keeps of the annual fact, as states that add up over loads.
SERVICE_ROLLUP = Rollup(LIFECYCLE_KEY, "DateKey", sums=[m for m, _ in PEAK_MEASURES[:3]],
                        peaks=[m for m, _ in PEAK_MEASURES], category="UrbanAreaKey", not_category=(-1,))


def observed_service(merged: DataFrame) -> DataFrame:
    """The lifecycle's observed part from merged states (known dates only, so a year is a date key's first digits)."""
    year = {k: F.expr(f"{k} div 10000") for k in ("first", "last")}
    cols = [*LIFECYCLE_KEY, F.col("first").alias("FirstObservedDateKey"), F.col("last").alias("LatestObservedDateKey"),
            (year["last"] - year["first"] + 1).cast("int").alias("YearsInService"), "UrbanAreaKey"]
    for m, t in PEAK_MEASURES:
        cols += [F.col(f"peak_{m}.at").alias(f"Peak{m}DateKey"), F.col(f"peak_{m}.value").cast(t).alias(f"PeakAnnual{m}"),
                 F.col(f"late_{m}.value").cast(t).alias(f"LatestAnnual{m}")]
    cols += [F.col(f"sum_{m}").cast("bigint").alias(f"TotalObserved{m}") for m, _ in PEAK_MEASURES[:3]]
    return merged.select(*cols)


def fact_service_lifecycle(annual: DataFrame, availability: DataFrame, safety: DataFrame, calendar: DataFrame,
                           existing: DataFrame | FactTable, batch_id: int | None = None,
                           source_system: str = "NTD_Service_Lifecycle", load_ts: Column | None = None) -> FactChange | Staged:
    """L26/C16+C13: one row per agency x mode x service.  First / latest observed year,
    the peak year of each measure (ties -> later year) and its value, latest values,
    NULL-as-0 totals, span of calendar years (unknown dates excluded), most frequent urban
    area - all in ONE grouped aggregate; earliest commitment and latest ended service from
    the availability fact, safety totals (0 when none) from the safety fact; then a full
    replace of existing rows that keeps their key and original insert time."""
    cal = calendar.filter(F.col("DateKey") > 0).select("DateKey", "CalendarYear")
    a = annual.filter(F.col("DateKey") > 0).join(F.broadcast(cal), "DateKey")
    aggs = [F.min("DateKey").alias("FirstObservedDateKey"), F.max("DateKey").alias("LatestObservedDateKey"),
            (F.max("CalendarYear") - F.min("CalendarYear") + 1).cast("int").alias("YearsInService")]
    for m, t in PEAK_MEASURES:
        order = (F.coalesce(F.col(m), F.lit(0)), F.col("DateKey"))
        aggs += [arg_max("DateKey", *order).alias(f"Peak{m}DateKey"),
                 arg_max(m, *order).cast(t).alias(f"PeakAnnual{m}"),
                 arg_max(m, "DateKey").cast(t).alias(f"LatestAnnual{m}")]
    for m, _ in PEAK_MEASURES[:3]:
        aggs.append(sum_zero(m).cast("bigint").alias(f"TotalObserved{m}"))
    life = a.groupBy(*LIFECYCLE_KEY).agg(*aggs)
    ua = mode_per_group(annual.filter(F.col("UrbanAreaKey") != -1), LIFECYCLE_KEY, "UrbanAreaKey", out="UrbanAreaKey")
    return _lifecycle(life.join(ua, LIFECYCLE_KEY, "left"), availability, safety, existing, batch_id, source_system, load_ts)


def fact_service_lifecycle_merged(merged: DataFrame, availability: DataFrame, safety: DataFrame,
                                  existing: DataFrame | FactTable, batch_id: int | None = None,
                                  source_system: str = "NTD_Service_Lifecycle", load_ts: Column | None = None
                                  ) -> FactChange | Staged:
    """L26 from the stored states of the annual fact (``SERVICE_ROLLUP``): the fact itself is not read."""
    return _lifecycle(observed_service(merged), availability, safety, existing, batch_id, source_system, load_ts)


def _lifecycle(life: DataFrame, availability: DataFrame, safety: DataFrame, existing: DataFrame | FactTable,
               batch_id: int | None, source_system: str, load_ts: Column | None) -> FactChange | Staged:
    av = availability.groupBy(*LIFECYCLE_KEY).agg(
        F.min("CommitmentDateKey").alias("_commit"),
        F.max(F.when(~F.col("ServiceActiveFlag"), F.col("EndDateKey"))).alias("_end"))
    sf = safety.groupBy(*LIFECYCLE_KEY).agg(F.count(F.lit(1)).cast("bigint").alias("TotalObservedMajorSafetyEvents"),
                                            sum_zero("TotalFatalityCount").cast("bigint").alias("TotalObservedFatalities"),
                                            sum_zero("TotalInjuryCount").cast("bigint").alias("TotalObservedInjuries"))
    j = life.join(av, LIFECYCLE_KEY, "left").join(sf, LIFECYCLE_KEY, "left")
    j = j.withColumns({
        "UrbanAreaKey": F.coalesce("UrbanAreaKey", F.lit(-1)),
        "CommitmentDateKey": F.coalesce("_commit", "FirstObservedDateKey"),
        "EndServiceDateKey": F.col("_end"),
        "LifecycleCompleteFlag": F.coalesce(F.col("_end") < F.col("LatestObservedDateKey"), F.lit(False)),
        "TotalObservedMajorSafetyEvents": F.coalesce("TotalObservedMajorSafetyEvents", F.lit(0)),
        "TotalObservedFatalities": F.coalesce("TotalObservedFatalities", F.lit(0)),
        "TotalObservedInjuries": F.coalesce("TotalObservedInjuries", F.lit(0)),
    }).drop("_commit", "_end")
    ts = load_ts if load_ts is not None else F.current_timestamp()
    incoming = j.withColumns({"ServiceLifecycleKey": F.lit(None).cast("bigint"), "ETL_InsertDate": ts,
                              "ETL_UpdateDate": ts, "ETL_BatchID": F.lit(batch_id).cast("bigint"),
                              "RecordSourceSystem": F.lit(source_system)})
    incoming = incoming.select(*[F.col(f.name).cast(f.dataType) for f in existing.schema.fields])
    retain = ["ServiceLifecycleKey", "ETL_InsertDate"]
    return load_accumulating(
        existing, incoming, LIFECYCLE_KEY, "ServiceLifecycleKey", lambda old, inc: accumulating_replace(
            old, inc, LIFECYCLE_KEY, [*retain, *(c for c in old.columns if c not in incoming.columns)], CHANGE))

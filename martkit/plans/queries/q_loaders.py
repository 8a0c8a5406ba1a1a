"""The mart loaders (L1-L26) end to end over feeds in the raw layout.

Each feed only renames and formats rows of the test tables into the headers and text formats
that a loader reads (suppliers as agencies, line items as yearly metrics and working hours, events
as incidents, orders as job openings); the loaders do all the work.  Fact rows are shown with
the natural keys of the dimension members that their surrogate keys point at.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.operators.lookup import Lookup, resolve_keys
from martkit.operators.rollup import RollupStore
from martkit.plans.calendar import DIM_DATE_COLUMNS, calendar_from_dates, calendar_range, with_special_dates
from martkit.plans.fact_specs import FACTS
from martkit.plans.marts import common, service, workforce
from martkit.plans.queries.registry import query, table
from martkit.session import checkpoint_dir
from martkit.sources.fact_table import FactTable
from martkit.sources.store import SnapshotStore

LOAD_DATE = "2024-06-01"
FIRST = "1900-01-01"


def feed(df: DataFrame, columns: dict[str, Column | str], headers: list[str]) -> DataFrame:
    """An all-string feed with every header; those not given are empty."""
    null = F.lit(None)
    return df.select(*[F.expr(columns[h]).cast("string").alias(h) if isinstance(columns.get(h), str)
                       else columns.get(h, null).cast("string").alias(h) for h in headers])


def agency_feed(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").join(F.broadcast(table(spark, sf, "nation")),  # nation: one row a country
                                          F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return feed(s, {
        "NTD ID": "concat('  ', s_suppkey, ' ')", "Legacy NTD ID": "CASE WHEN s_suppkey % 3 = 0 THEN 'None' ELSE CAST(s_suppkey AS STRING) END",
        "Agency Name": "s_name", "City": "n_name", "State": "'None'", "Region": "concat(n_regionkey, '.0')",
        "Organization Type": "CASE WHEN s_acctbal < 0 THEN ' City ' ELSE 'State' END",
        "Service Area Sq Miles": "CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS STRING)",
        "Primary UZA UACE Code": "concat(s_nationkey, '.0')", "UZA Name": "n_name",
        "Population": "concat(s_suppkey * 10, '.0')"}, [c.source for c in service.AGENCY_INFO_SPEC])


def _written(df: DataFrame) -> DataFrame:
    """A table written once to the cluster's checkpoint folder, as a run writes its staging tables and dimensions."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _fact(spark: SparkSession, name: str) -> FactTable:
    """A fact, still empty, in a store of its own under the checkpoint folder."""
    return FACTS[name].table(SnapshotStore(spark, f"{checkpoint_dir(spark).rstrip('/')}/store-{uuid.uuid4().hex}"), name)


def _agency(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(staged agencies, agency dimension)."""
    staged = _written(service.stage_agency_information(agency_feed(spark, sf)))
    return staged, _written(common.dim_agency_load(staged, common.empty_dim_agency(spark), LOAD_DATE, FIRST))


def _calendar(spark: SparkSession) -> DataFrame:
    return with_special_dates(calendar_range(spark, "1992-01-01", "2024-12-31"))


#: Modes and service types that the feeds hold, some of them unknown to the dimensions.
def _mode(key: str) -> str:
    return f"CASE {key} % 3 WHEN 0 THEN 'MB' WHEN 1 THEN 'LR' ELSE 'XX' END"


def _tos(key: str) -> str:
    return f"CASE {key} % 4 WHEN 0 THEN 'DO' WHEN 1 THEN 'PT' ELSE 'XX' END"


def _known(case: str) -> str:
    return case.replace("'XX'", "'N/A'")


def _named(fact: DataFrame, dims: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Replace surrogate keys by natural ones: key column -> (dimension, its key, its natural key)."""
    out = fact
    for col, (dim, key, natural) in dims.items():
        side = dim.select(F.col(key).alias(f"_k_{col}"), F.col(natural).alias(f"_n_{col}"))
        out = out.join(side, F.col(col) == F.col(f"_k_{col}"), "left").drop(col, f"_k_{col}").withColumnRenamed(
            f"_n_{col}", natural)
    return out


AGENCY_SQL = """
ag AS (SELECT CAST(s_suppkey AS VARCHAR) AS ntd, s_name, n_name, n_regionkey, s_acctbal, s_suppkey, s_nationkey
       FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey)"""


@query("load_agency_dimension", sql=f"""
WITH {AGENCY_SQL}
SELECT CAST(row_number() OVER (ORDER BY ntd) AS INTEGER) AS AgencyKey, ntd AS NTD_ID,
       CASE WHEN s_suppkey % 3 <> 0 THEN ntd END AS LegacyNTD_ID, s_name AS AgencyName, n_name AS City,
       CAST(NULL AS VARCHAR) AS State, CAST(n_regionkey AS INTEGER) AS Region,
       CASE WHEN s_acctbal < 0 THEN 'City' ELSE 'State' END AS OrganizationType,
       CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS SqMiles, DATE '1900-01-01' AS EffectiveDate, TRUE AS CurrentFlag
FROM ag UNION ALL
SELECT -1, 'N/A', NULL, 'Unknown Agency', NULL, NULL, NULL, NULL, NULL, DATE '1900-01-01', TRUE
""")
def load_agency_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """L1 + L11: the agency feed staged and loaded as a type-2 dimension, twice (the second
    load changes nothing)."""
    staged, dim = _agency(spark, sf)
    again = common.dim_agency_load(staged, dim, "2024-07-01", FIRST)
    return again.select("AgencyKey", "NTD_ID", "LegacyNTD_ID", "AgencyName", "City", "State",
                        F.col("Region").cast("int").alias("Region"), "OrganizationType",
                        F.col("ServiceAreaSqMiles").cast("double").alias("SqMiles"), "EffectiveDate", "CurrentFlag")


@query("load_urban_area_dimension", sql=f"""
WITH {AGENCY_SQL}
SELECT CAST(s_nationkey AS VARCHAR) AS UACECode, max(n_name) AS UZAName, CAST(max(s_suppkey) * 10 AS BIGINT) AS UZAPopulation
FROM ag WHERE s_nationkey IS NOT NULL GROUP BY 1 UNION ALL SELECT 'N/A', 'Unknown Urban Area', NULL
""")
def load_urban_area_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """One member for each urban area code of the staged agencies, type 2."""
    staged, _ = _agency(spark, sf)
    dim = service.dim_urban_area_load(staged, service.empty_dim_urban_area(spark), LOAD_DATE, FIRST)
    return dim.select("UACECode", "UZAName", "UZAPopulation")


def metric_feed(spark: SparkSession, sf: str, value: Column) -> DataFrame:
    """A yearly metric file: a row for each supplier, line status and return flag, a column for
    each of the layout's ten years (ship years in rotation)."""
    li = table(spark, sf, "lineitem").withColumn("_y", F.lit(2015) + F.pmod(F.year("l_shipdate") - 1992, F.lit(10)))
    rows = li.groupBy("l_suppkey", "l_linestatus", "l_returnflag").agg(
        *[F.sum(F.when(F.col("_y") == y, value)).alias(f"v{y}") for y in service.CURRENT_YEARS])
    return feed(rows, {
        "NTD ID": "l_suppkey", "Mode": "CASE l_linestatus WHEN 'O' THEN 'MB' ELSE 'LR' END",
        "Type of Service": "CASE l_returnflag WHEN 'R' THEN 'DO' WHEN 'A' THEN 'PT' ELSE 'XX' END",
        "UACE Code": "concat(l_suppkey % 25, '.0')",
        **{str(y): f"coalesce(CAST(CAST(v{y} AS DECIMAL(18,1)) AS STRING), '')" for y in service.CURRENT_YEARS}},
        [c.source for c in service._metric_spec(service.CURRENT_YEARS, False)])


@query("load_annual_service", sql="""
SELECT CAST((2015 + (year(l_shipdate) - 1992) % 10) * 10000 + 101 AS INTEGER) AS DateKey, CAST(l_suppkey AS VARCHAR) AS NTD_ID,
       CASE l_linestatus WHEN 'O' THEN 'MB' ELSE 'LR' END AS ModeCode,
       CASE l_returnflag WHEN 'R' THEN 'DO' WHEN 'A' THEN 'PT' ELSE 'N/A' END AS TOSCode,
       coalesce(max(u.c), 'N/A') AS UACECode, CAST(sum(l_quantity) AS BIGINT) AS UPT, CAST(count(*) AS BIGINT) AS VRM
FROM lineitem LEFT JOIN (SELECT DISTINCT CAST(s_nationkey AS VARCHAR) AS c FROM supplier) u
     ON u.c = CAST(l_suppkey % 25 AS VARCHAR)
WHERE l_suppkey IN (SELECT s_suppkey FROM supplier) GROUP BY 1, 2, 3, 4
""")
def load_annual_service(spark: SparkSession, sf: str) -> DataFrame:
    """L3 + L23: two yearly metric files staged, unpivoted, aligned, keyed and appended."""
    staged, agency = _agency(spark, sf)
    urban = _written(service.dim_urban_area_load(staged, service.empty_dim_urban_area(spark), LOAD_DATE, FIRST))
    metrics = {"upt": _written(service.stage_metric(metric_feed(spark, sf, F.col("l_quantity")))),
               "vrm": _written(service.stage_metric(metric_feed(spark, sf, F.lit(1))))}
    mode, tos = common.dim_mode(spark), common.dim_service_type(spark)
    change = service.fact_annual_service_performance(metrics, _calendar(spark), agency, mode, tos, urban,
                                                     service.empty_fact_annual(spark), batch_id=1)
    return _named(change.rows.select("DateKey", "AgencyKey", "ModeKey", "ServiceTypeKey", "UrbanAreaKey", "UPT", "VRM"), {
        "AgencyKey": (agency, "AgencyKey", "NTD_ID"), "ModeKey": (mode, "ModeKey", "ModeCode"),
        "ServiceTypeKey": (tos, "ServiceTypeKey", "TOSCode"), "UrbanAreaKey": (urban, "UrbanAreaKey", "UACECode")})


def employee_feed(spark: SparkSession, sf: str) -> DataFrame:
    """A 2019 employee file: a row for each supplier; headers written out."""
    li = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        *[F.coalesce(F.sum(F.when((F.col("l_linestatus") == s) & (F.col("l_returnflag") == r), F.col("l_quantity"))),
                     F.lit(0.0)).cast("bigint").alias(f"h{s}{r}") for s in "OF" for r in "RAN"],
        F.count(F.lit(1)).alias("n"))
    return feed(li, {
        "NTD ID": "format_number(l_suppkey, 0)", "Mode": "' MB '", "TOS": "'DO'",
        "Full Time Operator (Vehicle Operations) Hours Worked": "format_number(hOR, 0)",
        "Full Time Non-Operator (Vehicle Operations) Hours Worked": "concat(hFR, '.7')",
        "Full Time Operator (Vehicle Operations) Employee Count": "2",
        "Full Time Non-Operator (Vehicle Operations) Employee Count": "n",
        "Full Time Operator (Facility Maintenance) Hours Worked": "hOA",
        "Part Time Operator (Vehicle Maintenance) Hours Worked": "hON",
        "Part Time Non-Operator (Vehicle Maintenance) Employee Count": "''",
        "Total Full Time Operator (Operating Labor) Hours Worked": "hOR + hOA",
        "Total Full Time Non-Operator (Operating Labor) Hours Worked": "hFR",
        "Full Time Operator (Capital Labor) Hours Worked": "hOA", "Full Time Non-Operator (Capital Labor) Hours Worked": "hFA",
        "Total Full Time Operator Hours Worked": "hOR", "Total Full Time Non-Operator Hours Worked": "hFR",
        "Total Full Time Employee Count": "n + 2", "Total Part Time Hours Worked": "hON + hFN",
        "Total Part Time Operator Hours Worked": "hON", "Total Part Time Employee Count": "n"},
        list(workforce.employee_layout(2019).values()))


@query("load_employee_snapshot", sql="""
WITH e AS (SELECT l_suppkey AS s, count(*) AS n,
  CAST(coalesce(sum(l_quantity) FILTER (l_linestatus = 'O' AND l_returnflag = 'R'), 0) AS BIGINT) AS "or",
  CAST(coalesce(sum(l_quantity) FILTER (l_linestatus = 'F' AND l_returnflag = 'R'), 0) AS BIGINT) AS fr,
  CAST(coalesce(sum(l_quantity) FILTER (l_linestatus = 'O' AND l_returnflag = 'A'), 0) AS BIGINT) AS oa,
  CAST(coalesce(sum(l_quantity) FILTER (l_linestatus = 'F' AND l_returnflag = 'A'), 0) AS BIGINT) AS fa,
  CAST(coalesce(sum(l_quantity) FILTER (l_linestatus = 'O' AND l_returnflag = 'N'), 0) AS BIGINT) AS "on",
  CAST(coalesce(sum(l_quantity) FILTER (l_linestatus = 'F' AND l_returnflag = 'N'), 0) AS BIGINT) AS fn
  FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier) GROUP BY 1)
SELECT 20190101 AS DateKey, CAST(s AS VARCHAR) AS NTD_ID, 'Full-Time' AS EmploymentTypeName, 'Vehicle Operations' AS DepartmentName,
       CAST("or" + fr AS DOUBLE) AS HoursWorked, CAST(2 + n AS DOUBLE) AS EmployeeCount, CAST("or" + oa + fr AS DOUBLE) AS OperatingHours,
       CAST(oa + fa AS DOUBLE) AS CapitalHours, CAST("or" + fr AS DOUBLE) AS TotalHours, CAST(n + 2 AS DOUBLE) AS TotalEmployees,
       CAST(round(CAST("or" + fr AS DECIMAL(18,4)) / (2 + n), 4) AS DOUBLE) AS HoursPerEmployee FROM e
UNION ALL
SELECT 20190101, CAST(s AS VARCHAR), 'Full-Time', 'Facility Maintenance', CAST(oa AS DOUBLE), 0, CAST("or" + oa AS DOUBLE),
       CAST(oa AS DOUBLE), CAST("or" AS DOUBLE), CAST(n + 2 AS DOUBLE), NULL FROM e
UNION ALL
SELECT 20190101, CAST(s AS VARCHAR), 'Part-Time', 'Vehicle Maintenance', CAST("on" AS DOUBLE), 0, CAST("on" AS DOUBLE),
       CAST("on" AS DOUBLE), CAST("on" + fn AS DOUBLE), CAST(n AS DOUBLE), NULL FROM e
""")
def load_employee_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """L7 + L8 + L20: a 2019 employee file staged, unpivoted to variants, the operator split
    combined and loaded at the snapshot grain."""
    _, agency = _agency(spark, sf)
    staged = _written(workforce.stage_employees(employee_feed(spark, sf), 2019))
    unified = _written(workforce.unify_employees({2019: staged}))
    dims = _workforce_dims(spark, agency)
    rows = workforce.fact_employee_snapshot(unified, _calendar(spark), dims,
                                            workforce.empty_fact_employee_snapshot(spark), batch_id=1).rows
    shown = ["HoursWorked", "EmployeeCount", "OperatingHours", "CapitalHours", "TotalHours", "TotalEmployees",
             "HoursPerEmployee"]
    return _named(rows.select("DateKey", "AgencyKey", "EmploymentTypeKey", "DepartmentKey",
                              *[F.col(c).cast("double").alias(c) for c in shown]), {
        "AgencyKey": (agency, "AgencyKey", "NTD_ID"),
        "EmploymentTypeKey": (dims["employment_type"], "EmploymentTypeKey", "EmploymentTypeName"),
        "DepartmentKey": (dims["department"], "DepartmentKey", "DepartmentName")})


def _workforce_dims(spark: SparkSession, agency: DataFrame) -> dict[str, DataFrame]:
    return {"agency": agency, "mode": common.dim_mode(spark), "service_type": common.dim_service_type(spark),
            "employment_type": workforce.dim_employment_type_seed(spark),
            "department": _written(workforce.dim_department_load(spark, workforce.dim_department_seed(spark)))}


SAFETY_HEADERS = [
    "Incident Number", "NTD ID", "Agency", "Primary UZA UACE Code", "Mode", "TOS", "Event Date", "Event Time", "Year",
    "Event Category", "Event Type", "Event Type Group", "Safety/Security", "Event Description",
    *[f"{p} {k}" for k in ("Fatalities", "Injuries") for p in (
        "Transit Vehicle Rider", "People Waiting or Leaving", "Transit Vehicle Operator", "Non-Operator Transit Employee",
        "Other Worker", "Total")], "Number of Transit Vehicles Involved", "Evacuation", "Property Damage"]


def safety_feed(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumn("i", F.floor("value").cast("int"))
    return feed(e, {
        "Incident Number": "event_id", "NTD ID": "concat(user_id, ' ')", "Mode": _mode("event_id"), "TOS": _tos("event_id"),
        "Event Date": "date_format(ts, 'M/d/yyyy')", "Event Time": "date_format(ts, 'H:mm')",
        "Event Category": "event_type", "Event Type": "''", "Event Type Group": "' '",
        "Safety/Security": "CASE event_type WHEN 'error' THEN 'sft' WHEN 'click' THEN 'SECURITY' ELSE 'other' END",
        "Event Description": "concat(' event ', event_id)", "Transit Vehicle Rider Injuries": "i % 7",
        "Transit Vehicle Operator Injuries": "i % 5", "Other Worker Injuries": "i % 5", "Total Injuries": "i",
        "Evacuation": "CASE event_type WHEN 'view' THEN 'True' WHEN 'click' THEN 'false' ELSE '' END",
        "Property Damage": "format_number(CAST(value * 1000 AS DECIMAL(18,2)), 2)"}, SAFETY_HEADERS)


@query("load_safety_events", sql=f"""
WITH v AS (SELECT *, CAST(floor(value) AS INTEGER) AS i FROM events)
SELECT CAST(event_id AS VARCHAR) AS SourceIncidentID, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS EventDateKey,
       CASE WHEN user_id IN (SELECT s_suppkey FROM supplier) THEN CAST(user_id AS VARCHAR) ELSE 'N/A' END AS NTD_ID,
       {_known(_mode('event_id'))} AS ModeCode, {_known(_tos('event_id'))} AS TOSCode,
       strftime(ts, '%H:%M') || ':00' AS EventTime, event_type AS EventCategory,
       CASE event_type WHEN 'error' THEN 'Safety' WHEN 'click' THEN 'Security' ELSE 'other' END AS SeverityLevel,
       i % 7 AS PassengerInjuryCount, 2 * (i % 5) AS EmployeeInjuryCount, greatest(i - i % 7 - 2 * (i % 5), 0) AS OtherInjuryCount,
       i AS TotalInjuryCount, CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS EvacuationCount,
       CAST(CAST(value * 1000 AS DECIMAL(18,2)) AS DOUBLE) AS PropertyDamageAmount, 'event ' || event_id AS EventDescription
FROM v
""")
def load_safety_events(spark: SparkSession, sf: str) -> DataFrame:
    """L5 + L17 + L18 + L24: incidents staged, the event type and incident dimensions loaded,
    and the transaction fact keyed (null-safe on the event type) and appended once."""
    staged_agency, agency = _agency(spark, sf)
    raw = safety_feed(spark, sf)
    staged = _written(service.stage_safety_events(raw.unionByName(raw.where("Mode IS NULL"))))
    types = _written(service.dim_safety_event_type_load(staged, service.empty_dim_safety_event_type(spark)))
    incidents = _written(service.dim_safety_incident_load(staged, service.empty_dim_safety_incident(spark)))
    urban = _written(service.dim_urban_area_load(staged_agency, service.empty_dim_urban_area(spark), LOAD_DATE, FIRST))
    mode, tos = common.dim_mode(spark), common.dim_service_type(spark)
    rows = service.fact_major_safety_event(staged, _calendar(spark), agency, mode, tos, urban, types, incidents,
                                           service.empty_fact_safety(spark), batch_id=1).rows
    out = _named(rows, {"AgencyKey": (agency, "AgencyKey", "NTD_ID"), "ModeKey": (mode, "ModeKey", "ModeCode"),
                        "ServiceTypeKey": (tos, "ServiceTypeKey", "TOSCode"),
                        "SafetyIncidentDescriptionKey": (incidents, "SafetyIncidentKey", "EventDescription")})
    kinds = types.select("SafetyEventTypeKey", "EventCategory", "SeverityLevel")
    return out.join(kinds, "SafetyEventTypeKey").select(
        "SourceIncidentID", "EventDateKey", "NTD_ID", "ModeCode", "TOSCode", "EventTime", "EventCategory", "SeverityLevel", "PassengerInjuryCount",
        "EmployeeInjuryCount", "OtherInjuryCount", "TotalInjuryCount", "EvacuationCount",
        F.col("PropertyDamageAmount").cast("double").alias("PropertyDamageAmount"), "EventDescription")


def availability_feed(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return feed(li, {
        "NTD ID": "l_suppkey", "Mode": _mode("l_suppkey"), "TOS": _tos("l_orderkey"),
        "Service Type": "CASE WHEN l_returnflag = 'A' THEN 'Planned' WHEN l_linestatus = 'O' THEN 'Active Service' "
                        "ELSE 'Ending Service' END",
        "Commitment Date": "'None'", "Start Service Date": "date_format(l_shipdate, 'yyyy-MM-dd')",
        "End Service Date": "CASE WHEN l_returnflag = 'R' THEN CAST(date_add(l_shipdate, 30) AS STRING) ELSE 'None' END"},
        [c.source for c in service.AGENCY_MODE_SERVICE_SPEC])


@query("load_service_availability", sql=f"""
WITH p AS (SELECT DISTINCT s_suppkey AS s, CAST(l_shipdate AS DATE) AS d, l_linestatus AS st, l_returnflag AS r,
                  {_known(_mode('l_suppkey'))} AS m, {_known(_tos('l_orderkey'))} AS t
           FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)
SELECT CAST(s AS VARCHAR) AS NTD_ID, m AS ModeCode, t AS TOSCode, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS StartDateKey,
       CASE WHEN r = 'R' THEN CAST(strftime(d + 30, '%Y%m%d') AS INTEGER) ELSE 99991231 END AS EndDateKey,
       bool_and(st = 'O') AS ServiceActiveFlag
FROM p WHERE r <> 'A' GROUP BY 1, 2, 3, 4, 5
""")
def load_service_availability(spark: SparkSession, sf: str) -> DataFrame:
    """L2 + L25: service periods staged (duplicates, open ends, other service types), keyed as
    of their start and appended at the period grain."""
    _, agency = _agency(spark, sf)
    mode, tos = common.dim_mode(spark), common.dim_service_type(spark)
    rows = service.fact_service_availability(_written(service.stage_agency_mode_service(availability_feed(spark, sf))), _calendar(spark), agency,
                                             mode, tos, service.empty_fact_availability(spark), batch_id=1).rows
    return _named(rows.select("AgencyKey", "ModeKey", "ServiceTypeKey", "StartDateKey", "EndDateKey", "ServiceActiveFlag"), {
        "AgencyKey": (agency, "AgencyKey", "NTD_ID"), "ModeKey": (mode, "ModeKey", "ModeCode"),
        "ServiceTypeKey": (tos, "ServiceTypeKey", "TOSCode")})


JOB_HEADERS = ["OpeningID", "PostingDate", "NTD_ID", "AgencyName", "ReporterType", "ReportingModule", "OrganizationType",
               "City", "State", "Region", "ModeCode", "ModeName", "TOS", "TypeOfServiceName", "NTDLaborObjectClass",
               "OperatorStatus", "EmploymentType", "PositionTitle", "Department", "OpenPositions", "SalaryMinHourly",
               "SalaryMaxHourly", "SalaryMidHourly", "SalaryType", "PostingStatus", "ClosingDate", "FilledDate", "DaysOpen",
               "HiredCount", "VacancyReason", "SourceSystem", "SyntheticDataFlag", "SourceBasisURL", "SourceBasisNote"]


def job_feed(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").withColumn("p", F.col("o_totalprice").cast("decimal(18,2)"))
    return feed(o, {
        "OpeningID": "CASE WHEN o_orderkey % 50 = 7 THEN ' ' ELSE concat(' J', o_orderkey) END",
        "PostingDate": "CASE WHEN o_orderkey % 40 = 3 THEN '1900-01-01' ELSE date_format(o_orderdate, 'M/d/yyyy') END",
        "NTD_ID": "o_custkey", "ModeCode": _mode("o_orderkey"), "TOS": _tos("o_orderkey"), "PositionTitle": "concat(' ', o_orderpriority)",
        "EmploymentType": "CASE o_orderstatus WHEN 'F' THEN 'full time' WHEN 'O' THEN 'pt' ELSE 'weird' END",
        "Department": "'vehicle operations'", "OpenPositions": "o_orderkey % 5", "SalaryMinHourly": "concat('$', p)",
        "SalaryMaxHourly": "CASE WHEN o_orderkey % 30 = 4 THEN '1' ELSE CAST(p + 5 AS STRING) END",
        "PostingStatus": "CASE o_orderstatus WHEN 'F' THEN ' filled' WHEN 'O' THEN 'OPEN' ELSE 'canceled' END",
        "ClosingDate": "CASE WHEN o_orderkey % 60 = 5 THEN '1950-01-01' ELSE date_format(date_add(o_orderdate, 20), 'yyyy-MM-dd') END",
        "FilledDate": "CASE WHEN o_orderkey % 3 = 0 THEN date_format(date_add(o_orderdate, CAST(o_orderkey % 20 - 5 AS INT)), 'yyyy-MM-dd') END"},
        JOB_HEADERS)


VALID_JOBS = """
j AS (SELECT *, 'J' || o_orderkey AS id, CAST(o_orderdate AS DATE) AS d, CAST(o_totalprice AS DECIMAL(18,2)) AS p,
             CASE o_orderstatus WHEN 'O' THEN 'Part-Time' ELSE 'Full-Time' END AS et FROM orders),
ok AS (SELECT * FROM j WHERE o_orderkey % 50 <> 7 AND o_orderkey % 40 <> 3 AND NOT (o_orderkey % 30 = 4 AND p > 1)
       AND o_orderkey % 60 <> 5)"""


@query("load_job_rejects", sql="""
SELECT CASE WHEN o_orderkey % 50 = 7 THEN 'missing' ELSE 'J' || o_orderkey END AS opening, count(*) AS n FROM orders
WHERE o_orderkey % 50 = 7 OR o_orderkey % 40 = 3 OR (o_orderkey % 30 = 4 AND o_totalprice > 1) OR o_orderkey % 60 = 5
GROUP BY 1
""")
def load_job_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """The openings that the validation gate turns away (no id, placeholder date, salary range,
    date order)."""
    _, rejects = workforce.stage_job_openings(job_feed(spark, sf))
    return rejects.groupBy(F.coalesce("opening_id", F.lit("missing")).alias("opening")).agg(F.count(F.lit(1)).alias("n"))


def _jobs(spark: SparkSession, sf: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    _, agency = _agency(spark, sf)
    staged = _written(workforce.stage_job_openings(job_feed(spark, sf))[0])
    dims = _workforce_dims(spark, agency)
    dims["employment_type"] = _written(workforce.dim_employment_type_load(staged, dims["employment_type"]))
    dims["job_role"] = _written(workforce.dim_job_role_load(staged, workforce.dim_job_role_seed(spark), LOAD_DATE, FIRST))
    return staged, dims


@query("load_job_postings", sql=f"""
WITH {VALID_JOBS}
SELECT id AS OpeningID, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS DateKey,
       CASE WHEN o_custkey IN (SELECT s_suppkey FROM supplier) THEN CAST(o_custkey AS VARCHAR) ELSE 'N/A' END AS NTD_ID,
       {_known(_mode('o_orderkey'))} AS ModeCode, {_known(_tos('o_orderkey'))} AS TOSCode,
       et AS EmploymentTypeName, 'Vehicle Operations' AS DepartmentName, o_orderpriority AS PositionTitle,
       CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_orderkey % 5 AS INTEGER) END AS OpenPositions, CAST(p AS DOUBLE) AS SalaryMin,
       CASE o_orderstatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' ELSE 'Cancelled' END AS PostingStatus
FROM ok
""")
def load_job_postings(spark: SparkSession, sf: str) -> DataFrame:
    """L9 + L13 + L14 + L15 + L19: openings cleansed, gated, the HR dimensions loaded from them and the
    posting fact keyed as of the posting date."""
    staged, dims = _jobs(spark, sf)
    rows = workforce.fact_job_posting(staged, _calendar(spark), dims, workforce.empty_fact_job_posting(spark), batch_id=1).rows
    out = _named(rows, {"AgencyKey": (dims["agency"], "AgencyKey", "NTD_ID"),
                        "ModeKey": (dims["mode"], "ModeKey", "ModeCode"),
                        "ServiceTypeKey": (dims["service_type"], "ServiceTypeKey", "TOSCode"),
                        "EmploymentTypeKey": (dims["employment_type"], "EmploymentTypeKey", "EmploymentTypeName"),
                        "DepartmentKey": (dims["department"], "DepartmentKey", "DepartmentName"),
                        "JobRoleKey": (dims["job_role"], "JobRoleKey", "PositionTitle")})
    return out.select("OpeningID", "DateKey", "NTD_ID", "ModeCode", "TOSCode", "EmploymentTypeName", "DepartmentName", "PositionTitle",
                      "OpenPositions", F.col("SalaryMinHourly").cast("double").alias("SalaryMin"), "PostingStatus")


@query("load_posting_lifecycle", sql=f"""
WITH {VALID_JOBS}
SELECT id AS OpeningID, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS PostingDateKey,
       CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 20 >= 5
            THEN CAST(strftime(d + CAST(o_orderkey % 20 - 5 AS INTEGER), '%Y%m%d') AS INTEGER) END AS FilledDateKey,
       CAST(strftime(d + 20, '%Y%m%d') AS INTEGER) AS ClosingDateKey
FROM ok
""")
def load_posting_lifecycle(spark: SparkSession, sf: str) -> DataFrame:
    """The posting lifecycle loaded twice into a fact partitioned by posting month; the second load finds
    every opening again and changes none."""
    staged, dims = _jobs(spark, sf)
    fact = _fact(spark, "FactJobPostingLifecycle")
    for _ in range(2):
        fact.load(workforce.fact_posting_lifecycle(staged, _calendar(spark), dims, fact))
    return fact.read().select("OpeningID", "PostingDateKey", "FilledDateKey", "ClosingDateKey")


def archive_feed(spark: SparkSession, sf: str) -> DataFrame:
    """An archive metric file (1991-2014): a row for each supplier and line status."""
    li = table(spark, sf, "lineitem").withColumn("_y", F.year("l_shipdate"))
    rows = li.groupBy("l_suppkey", "l_linestatus").agg(
        *[F.sum(F.when(F.col("_y") == y, F.col("l_quantity"))).alias(f"v{y}") for y in range(1995, 2002)])
    return feed(rows, {
        "NTD ID": "concat(l_suppkey, '.0')", "Legacy NTD ID": "CASE WHEN l_suppkey % 2 = 0 THEN '' ELSE lpad(l_suppkey, 4, '0') END",
        "Mode": "CASE l_linestatus WHEN 'O' THEN ' MB' ELSE 'LR' END", "Service": "'DO'", "Census Year": "'2010'",
        "UACE Code": "concat(l_suppkey % 25, '.0')", "UZA Area SQ Miles": "'n/a'",
        **{str(y): f"coalesce(CAST(CAST(v{y} AS DECIMAL(18,1)) AS STRING), ' ')" for y in range(1995, 2002)}},
        [c.source for c in service._metric_spec(service.ARCHIVE_YEARS, True)])


@query("load_archive_metric", sql="""
SELECT CAST(l_suppkey AS VARCHAR) AS ntd_id, CASE WHEN l_suppkey % 2 = 1 THEN lpad(CAST(l_suppkey AS VARCHAR), 4, '0') END AS legacy_ntd_id,
       CASE l_linestatus WHEN 'O' THEN 'MB' ELSE 'LR' END AS mode, CAST(l_suppkey % 25 AS VARCHAR) AS uace_code, 2010 AS census_year,
       CAST(sum(l_quantity) FILTER (year(l_shipdate) = 1995) AS DOUBLE) AS y1995,
       CAST(sum(l_quantity) FILTER (year(l_shipdate) = 2001) AS DOUBLE) AS y2001, CAST(NULL AS DOUBLE) AS y1991
FROM lineitem GROUP BY l_suppkey, l_linestatus
""")
def load_archive_metric(spark: SparkSession, sf: str) -> DataFrame:
    """L4: an archive metric file staged: float-formatted ids and codes, blank years, text that is no number."""
    return service.stage_metric(archive_feed(spark, sf), archive=True).select(
        "ntd_id", "legacy_ntd_id", "mode", "uace_code", "census_year",
        *[F.col(f"y{y}").cast("double").alias(f"y{y}") for y in (1995, 2001, 1991)])


def old_employee_feed(spark: SparkSession, sf: str) -> DataFrame:
    """A 2016 employee file with padded headers: one row for each supplier."""
    lay = workforce.employee_layout(2016)
    li = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).otherwise(0)).cast("bigint").alias("o"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0)).cast("bigint").alias("r"),
        F.count(F.lit(1)).alias("n"))
    raw = feed(li, {
        lay["ntd_id"]: "format_number(l_suppkey, 0)", lay["mode"]: "'MB'", lay["tos"]: "'DO'",
        lay["ft_vehicle_operations_hours"]: "concat(format_number(o, 0), '.9')", lay["ft_vehicle_operations_count"]: "n",
        lay["pt_facility_maintenance_hours"]: "r", lay["pt_facility_maintenance_count"]: "'1.5'",
        lay["ft_total_hours"]: "o + r", lay["ft_total_count"]: "''"}, list(lay.values()))
    return raw.toDF(*[f" {c}  " for c in raw.columns])


@query("load_employee_history", sql="""
WITH e AS (SELECT CAST(l_suppkey AS VARCHAR) AS s, count(*) AS n,
             CAST(coalesce(sum(l_quantity) FILTER (l_linestatus = 'O'), 0) AS BIGINT) AS o,
             CAST(coalesce(sum(l_quantity) FILTER (l_returnflag = 'R'), 0) AS BIGINT) AS r FROM lineitem GROUP BY 1)
SELECT 2016 AS ReportYear, s AS NTD_ID, 'FullTime' AS EmploymentType, 'Vehicle Operations' AS DepartmentName,
       CAST(o AS DOUBLE) AS HoursWorked, CAST(n AS DOUBLE) AS EmployeeCount, CAST(o + r AS DOUBLE) AS TotalHours FROM e WHERE o > 0
UNION ALL SELECT 2016, s, 'FullTime', 'Total', CAST(o + r AS DOUBLE), 0, CAST(o + r AS DOUBLE) FROM e WHERE o + r > 0
UNION ALL SELECT 2016, s, 'PartTime', 'Facility Maintenance', CAST(r AS DOUBLE), 1.5, 0 FROM e WHERE r > 0
""")
def load_employee_history(spark: SparkSession, sf: str) -> DataFrame:
    """L6 + L8: a 2016 employee file (other headers, no operator split) staged and unpivoted."""
    staged = _written(workforce.stage_employees(old_employee_feed(spark, sf), 2016))
    rows = workforce.unify_employees({2016: staged}).where("HoursWorked > 0")
    return rows.select("ReportYear", "NTD_ID", "EmploymentType", "DepartmentName",
                       *[F.col(c).cast("double").alias(c) for c in ("HoursWorked", "EmployeeCount", "TotalHours")])


@query("load_labor_coverage", sql="""
WITH e AS (SELECT l_suppkey AS s,
  coalesce(sum(l_quantity) FILTER (l_linestatus = 'O' AND l_returnflag = 'R'), 0)
    + coalesce(sum(l_quantity) FILTER (l_linestatus = 'F' AND l_returnflag = 'R'), 0) AS ops,
  coalesce(sum(l_quantity) FILTER (l_linestatus = 'O' AND l_returnflag = 'A'), 0) AS oa,
  coalesce(sum(l_quantity) FILTER (l_linestatus = 'O' AND l_returnflag = 'N'), 0) AS "on"
  FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier) GROUP BY 1)
SELECT 20190101 AS DateKey, CAST(s AS VARCHAR) AS NTD_ID, 'MB' AS ModeCode, 'DO' AS TOSCode, 'Full-Time' AS EmploymentTypeName,
       'Vehicle Operations' AS DepartmentName FROM e WHERE ops > 0
UNION ALL SELECT 20190101, CAST(s AS VARCHAR), 'MB', 'DO', 'Full-Time', 'Facility Maintenance' FROM e WHERE oa > 0
UNION ALL SELECT 20190101, CAST(s AS VARCHAR), 'MB', 'DO', 'Part-Time', 'Vehicle Maintenance' FROM e WHERE "on" > 0
""")
def load_labor_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """The factless coverage of a 2019 employee file, loaded twice into a fact partitioned by year start."""
    _, agency = _agency(spark, sf)
    staged = _written(workforce.stage_employees(employee_feed(spark, sf), 2019))
    unified = _written(workforce.unify_employees({2019: staged}))
    dims = _workforce_dims(spark, agency)
    fact = _fact(spark, "FactAgencyLaborCoverage")
    for _ in range(2):
        fact.load(workforce.fact_labor_coverage(unified, _calendar(spark), dims, fact))
    return _named(fact.read().select(*workforce.COVERAGE_GRAIN), {
        "AgencyKey": (agency, "AgencyKey", "NTD_ID"), "ModeKey": (dims["mode"], "ModeKey", "ModeCode"),
        "ServiceTypeKey": (dims["service_type"], "ServiceTypeKey", "TOSCode"),
        "EmploymentTypeKey": (dims["employment_type"], "EmploymentTypeKey", "EmploymentTypeName"),
        "DepartmentKey": (dims["department"], "DepartmentKey", "DepartmentName")})


@query("load_calendar", sql="""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS DateKey, d AS FullDate, CAST(year(d) AS INTEGER) AS CalendarYear,
       CAST(quarter(d) AS INTEGER) AS CalendarQuarter, CASE WHEN month(d) <> 1 THEN strftime(d, '%b') END AS MonthShortName
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE day(o_orderdate) <> 15)
UNION ALL SELECT -1, DATE '1900-01-01', -1, -1, 'Unk' UNION ALL SELECT 99991231, DATE '9999-12-31', 9999, 4, 'Dec'
""")
def load_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """A raw calendar file of the order dates (repeated lines, ids that are no numbers, undefined names) loaded twice."""
    cal = calendar_from_dates(table(spark, sf, "orders"), "o_orderdate")
    names = {"DateKey": "Id", "FullDate": "Date"}
    raw = cal.select(*[F.col(c).cast("string").alias(names.get(c, c)) for c in DIM_DATE_COLUMNS])
    raw = raw.withColumns({"Id": F.when(F.col("CalendarDayInMonth") == "15", "x").otherwise(F.concat(F.lit(" "), "Id")),
                           "MonthShortName": F.when(F.col("CalendarMonth") == "1", "undefined").otherwise(F.col("MonthShortName"))})
    raw = raw.unionByName(raw)
    once = _written(common.dim_date_load(raw, common.empty_dim_date(spark)))
    return common.dim_date_load(raw, once).select("DateKey", "FullDate", "CalendarYear", "CalendarQuarter", "MonthShortName")


@query("static_dimensions", sql=f"""
SELECT {_known(_mode('event_id'))} AS ModeCode, {_known(_tos('event_id'))} AS TOSCode, count(*) AS n, 1 AS sizes_ok FROM events
GROUP BY 1, 2
""")
def static_dimensions(spark: SparkSession, sf: str) -> DataFrame:
    """The fixed mode and service type dimensions, their sizes checked, as every event's codes resolve on them."""
    mode, tos = common.dim_mode(spark), common.dim_service_type(spark)
    codes = table(spark, sf, "events").select(F.expr(_mode("event_id")).alias("m"), F.expr(_tos("event_id")).alias("t"))
    keyed = resolve_keys(codes, [Lookup(mode, [("m", "ModeCode")], "ModeKey", "ModeKey", broadcast=True),
                                 Lookup(tos, [("t", "TOSCode")], "ServiceTypeKey", "ServiceTypeKey", broadcast=True)])
    counted = keyed.groupBy("ModeKey", "ServiceTypeKey").agg(F.count(F.lit(1)).alias("n"))
    sizes_ok = all(r.ok for r in common.verify_static_dims(spark).collect())  # two rows
    return _named(counted.withColumn("sizes_ok", F.lit(int(sizes_ok))), {
        "ModeKey": (mode, "ModeKey", "ModeCode"), "ServiceTypeKey": (tos, "ServiceTypeKey", "TOSCode")})


@query("load_service_lifecycle", sql=f"""
WITH a AS (
  SELECT CAST((2015 + (year(l_shipdate) - 1992) % 10) * 10000 + 101 AS INTEGER) AS dk, CAST(l_suppkey AS VARCHAR) AS ntd,
         CASE l_linestatus WHEN 'O' THEN 'MB' ELSE 'LR' END AS m,
         CASE l_returnflag WHEN 'R' THEN 'DO' WHEN 'A' THEN 'PT' ELSE 'N/A' END AS t,
         max(u.c) AS uace, CAST(sum(l_quantity) AS BIGINT) AS upt, count(*) AS vrm
  FROM lineitem LEFT JOIN (SELECT DISTINCT CAST(s_nationkey AS VARCHAR) AS c FROM supplier) u
       ON u.c = CAST(l_suppkey % 25 AS VARCHAR)
  WHERE l_suppkey IN (SELECT s_suppkey FROM supplier) GROUP BY 1, 2, 3, 4),
r AS (SELECT *, row_number() OVER (PARTITION BY ntd, m, t ORDER BY upt DESC, dk DESC) AS best,
             row_number() OVER (PARTITION BY ntd, m, t ORDER BY dk DESC) AS late FROM a),
life AS (SELECT ntd, m, t, min(dk) AS first, max(dk) AS last, max(uace) AS uace, max(dk) FILTER (best = 1) AS peak_dk,
                max(upt) FILTER (best = 1) AS peak, max(upt) FILTER (late = 1) AS latest, sum(upt) AS upt, sum(vrm) AS vrm
         FROM r GROUP BY 1, 2, 3),
p AS (SELECT CAST(s_suppkey AS VARCHAR) AS ntd, {_known(_mode('l_suppkey'))} AS m, {_known(_tos('l_orderkey'))} AS t,
             CAST(l_shipdate AS DATE) AS d, l_returnflag AS rf, bool_and(l_linestatus = 'O') AS active
      FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_returnflag <> 'A' GROUP BY 1, 2, 3, 4, 5),
av AS (SELECT ntd, m, t, max(CASE WHEN rf = 'R' THEN CAST(strftime(d + 30, '%Y%m%d') AS INTEGER) ELSE 99991231 END) AS ended
       FROM p WHERE NOT active GROUP BY 1, 2, 3),
sf AS (SELECT CAST(user_id AS VARCHAR) AS ntd, {_known(_mode('event_id'))} AS m, {_known(_tos('event_id'))} AS t, count(*) AS n,
              sum(CAST(floor(value) AS INTEGER)) AS injuries FROM events GROUP BY 1, 2, 3)
SELECT life.ntd AS NTD_ID, life.m AS ModeCode, life.t AS TOSCode, coalesce(uace, 'N/A') AS UACECode, first AS FirstObservedDateKey,
       last AS LatestObservedDateKey, CAST(last // 10000 - first // 10000 + 1 AS INTEGER) AS YearsInService,
       peak_dk AS PeakUPTDateKey, peak AS PeakAnnualUPT, latest AS LatestAnnualUPT, CAST(upt AS BIGINT) AS TotalObservedUPT,
       CAST(vrm AS BIGINT) AS TotalObservedVRM, coalesce(sf.n, 0) AS TotalObservedMajorSafetyEvents,
       CAST(coalesce(injuries, 0) AS BIGINT) AS TotalObservedInjuries, ended AS EndServiceDateKey,
       CASE WHEN ended < last THEN 1 ELSE 0 END AS complete
FROM life LEFT JOIN av USING (ntd, m, t) LEFT JOIN sf USING (ntd, m, t)
""")
def load_service_lifecycle(spark: SparkSession, sf: str) -> DataFrame:
    """The service lifecycle from the annual, availability and safety facts.  The first load knows the years before
    2019 and reads the annual fact; the second has all years and merges stored states of the two batches."""
    staged_agency, agency = _agency(spark, sf)
    urban = _written(service.dim_urban_area_load(staged_agency, service.empty_dim_urban_area(spark), LOAD_DATE, FIRST))
    mode, tos, cal = common.dim_mode(spark), common.dim_service_type(spark), _calendar(spark)
    metrics = {"upt": _written(service.stage_metric(metric_feed(spark, sf, F.col("l_quantity")))),
               "vrm": _written(service.stage_metric(metric_feed(spark, sf, F.lit(1))))}
    annual = _written(service.fact_annual_service_performance(
        metrics, cal, agency, mode, tos, urban, service.empty_fact_annual(spark), batch_id=1).rows)
    availability = _written(service.fact_service_availability(
        _written(service.stage_agency_mode_service(availability_feed(spark, sf))), cal, agency, mode, tos,
        service.empty_fact_availability(spark), batch_id=1).rows)
    events = _written(service.stage_safety_events(safety_feed(spark, sf)))
    types = _written(service.dim_safety_event_type_load(events, service.empty_dim_safety_event_type(spark)))
    incidents = _written(service.dim_safety_incident_load(events, service.empty_dim_safety_incident(spark)))
    safety = _written(service.fact_major_safety_event(events, cal, agency, mode, tos, urban, types, incidents,
                                                      service.empty_fact_safety(spark), batch_id=1).rows)
    fact = _fact(spark, "Fact_Service_Lifecycle_Accumulating")
    early = annual.where("DateKey < 20190000")
    fact.load(service.fact_service_lifecycle(early, availability, safety, cal, fact, batch_id=1))
    states = RollupStore(spark, f"{fact.path}-states", service.SERVICE_ROLLUP)
    states.put(1, early)
    states.put(2, annual.where("DateKey >= 20190000"))
    fact.load(service.fact_service_lifecycle_merged(states.result(), availability, safety, fact, batch_id=2))
    return _named(fact.read(), {
        "AgencyKey": (agency, "AgencyKey", "NTD_ID"), "ModeKey": (mode, "ModeKey", "ModeCode"),
        "ServiceTypeKey": (tos, "ServiceTypeKey", "TOSCode"), "UrbanAreaKey": (urban, "UrbanAreaKey", "UACECode")}).select(
        "NTD_ID", "ModeCode", "TOSCode", "UACECode", "FirstObservedDateKey", "LatestObservedDateKey", "YearsInService",
        "PeakUPTDateKey", "PeakAnnualUPT", "LatestAnnualUPT", "TotalObservedUPT", "TotalObservedVRM",
        "TotalObservedMajorSafetyEvents", "TotalObservedInjuries", "EndServiceDateKey",
        F.col("LifecycleCompleteFlag").cast("int").alias("complete"))

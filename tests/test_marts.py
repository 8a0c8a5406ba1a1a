"""End-to-end mart loads over small literal raw fixtures (the cases listed in FIXTURES.md)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martkit.plans.calendar import DIM_DATE_COLUMNS, calendar_range
from martkit.plans.marts import service, workforce
from martkit.plans.runner import MartLoadError, MartRunner
from martkit.sources.store import SnapshotStore


def raw_df(spark, columns, rows):
    """All-string raw frame; each row is a dict (missing columns -> NULL)."""
    data = [tuple(None if r.get(c) is None else str(r.get(c)) for c in columns) for r in rows]
    return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in columns))


AGENCY_COLS = [c.source for c in service.AGENCY_INFO_SPEC]
AMS_COLS = [c.source for c in service.AGENCY_MODE_SERVICE_SPEC]
METRIC_COLS = [c.source for c in service._metric_spec(service.CURRENT_YEARS, False)]
SAFETY_COLS = ["Incident Number", "NTD ID", "Agency", "Primary UZA UACE Code", "Mode", "TOS", "Event Date",
               "Event Time", "Year", "Event Category", "Event Type", "Event Type Group", "Safety/Security",
               "Event Description"] + [f"{p} {k}" for k in ("Fatalities", "Injuries")
                                      for p in service.FATALITY_PARTS[0] + service.FATALITY_PARTS[1] + ["Total"]] + \
              ["Number of Transit Vehicles Involved", "Evacuation", "Property Damage"]
JOB_COLS = ["OpeningID", "PostingDate", "NTD_ID", "AgencyName", "ReporterType", "ReportingModule", "OrganizationType",
            "City", "State", "Region", "ModeCode", "ModeName", "TOS", "TypeOfServiceName", "NTDLaborObjectClass",
            "OperatorStatus", "EmploymentType", "PositionTitle", "Department", "OpenPositions", "SalaryMinHourly",
            "SalaryMaxHourly", "SalaryMidHourly", "SalaryType", "PostingStatus", "ClosingDate", "FilledDate",
            "DaysOpen", "HiredCount", "VacancyReason", "SourceSystem", "SyntheticDataFlag", "SourceBasisURL",
            "SourceBasisNote"]


def fixtures(spark):
    agency = raw_df(spark, AGENCY_COLS, [
        {"NTD ID": " 10001 ", "Agency Name": "King County Metro", "City": "Seattle", "State": "WA", "Region": "10.0",
         "Zip Code": "98104.0", "Primary UZA UACE Code": "80389.0", "UZA Name": "Seattle", "Sq Miles": "1000.5",
         "Population": "3500000.0", "Density": "3400", "Service Area Pop": "2200000.0", "Legacy NTD ID": "0001"},
        {"NTD ID": "10001", "Agency Name": "King County Metro (dup)", "Legacy NTD ID": "0000", "Zip Code": "98104.0",
         "Region": "10.0", "Primary UZA UACE Code": "80389.0"},
        {"NTD ID": "20002", "Agency Name": "Metro Two", "City": "None", "Region": "None",
         "Primary UZA UACE Code": "80389", "UZA Name": "Seattle", "Population": "3600000"},
        {"NTD ID": "  ", "Agency Name": "Blank id"},
    ])
    ams = raw_df(spark, AMS_COLS, [
        {"NTD ID": "10001", "Mode": "MB", "TOS": "DO", "Service Type": "Active Service",
         "Commitment Date": "2010-01-01", "Start Service Date": "2015-01-01", "End Service Date": None},
        {"NTD ID": "10001", "Mode": "MB", "TOS": "DO", "Service Type": "Active Service",
         "Commitment Date": "2010-01-01", "Start Service Date": "2015-01-01", "End Service Date": None},
        {"NTD ID": "10001", "Mode": "LR", "TOS": "PT", "Service Type": "Ending Service",
         "Commitment Date": None, "Start Service Date": "2016-03-01", "End Service Date": "2018-12-31"},
        {"NTD ID": "20002", "Mode": "DR", "TOS": "TX", "Service Type": "Planned", "Start Service Date": "2016-01-01"},
        {"NTD ID": "20002", "Mode": "DR", "TOS": "TX", "Service Type": "Active Service", "Start Service Date": None},
        {"NTD ID": "99999", "Mode": "MB", "TOS": "DO", "Service Type": "Active Service",
         "Start Service Date": "2015-01-01"},
    ])

    def metric(values):
        rows = []
        for ntd, mode, tos, uace, series in values:
            r = {"NTD ID": ntd, "Mode": mode, "Type of Service": tos, "UACE Code": uace}
            r.update({str(y): v for y, v in series.items()})
            rows.append(r)
        return raw_df(spark, METRIC_COLS, rows)

    upt = metric([("10001", "MB", "DO", "80389.0", {2015: "416.0", 2016: "500", 2017: "", 2018: "abc"}),
                  ("10001", "MB", "DO", "12345", {2015: "1.0"}),
                  ("20002", "DR", "TX", "80389", {2016: "77"})])
    vrm = metric([("10001", "MB", "DO", "80389", {2015: "10", 2016: "900"}),
                  ("10001", "LR", "PT", "80389", {2017: "5"})])
    safety_rows = [
        {"Incident Number": "1", "NTD ID": "10001", "Mode": "MB", "TOS": "DO", "Event Date": "12/31/2016",
         "Event Time": "7:05", "Event Category": "Collision", "Event Type": "Vehicle", "Event Type Group": "G1",
         "Safety/Security": "SFT", "Event Description": "first", "Transit Vehicle Rider Fatalities": "2",
         "Other Worker Fatalities": "1", "Total Fatalities": "2", "Total Injuries": "5",
         "Transit Vehicle Rider Injuries": "1", "Evacuation": "TRUE", "Property Damage": "1,000",
         "Primary UZA UACE Code": "80389"},
        {"Incident Number": "1", "NTD ID": "10001", "Event Description": "duplicate"},
        {"Incident Number": "2", "NTD ID": "20002", "Mode": "DR", "TOS": "TX", "Event Date": "2017-02-03",
         "Event Category": "Security", "Event Type": "Assault", "Safety/Security": "SECURITY",
         "Event Description": "second", "Evacuation": "false", "Total Fatalities": None},
        {"Incident Number": "3", "NTD ID": "10001", "Event Date": "bad", "Event Category": "Collision",
         "Event Type": "Vehicle", "Event Type Group": "G1", "Safety/Security": "SAFETY", "Evacuation": ""},
    ]
    safety = raw_df(spark, SAFETY_COLS, safety_rows)

    def employees(year, pad=False):
        lay = workforce.employee_layout(year)
        cols = [f"  {h} " if pad else h for h in lay.values()]
        row = {lay["ntd_id"]: "10,001", lay["agency_name"]: "King County Metro", lay["mode"]: "MB", lay["tos"]: "DO"}
        if year < 2019:
            row.update({lay["ft_vehicle_operations_hours"]: "1,234.9", lay["ft_vehicle_operations_count"]: "10",
                        lay["ft_total_hours"]: "2,000", lay["ft_total_count"]: "20"})
        else:
            row.update({lay["ft_op_vehicle_operations_hours"]: "100", lay["ft_op_vehicle_operations_count"]: "2",
                        lay["ft_nonop_vehicle_operations_hours"]: "50.5", lay["ft_total_count"]: "9",
                        lay["pt_op_vehicle_maintenance_hours"]: "", lay["pt_op_vehicle_maintenance_count"]: ""})
        data = [{(f"  {k} " if pad else k): v for k, v in row.items()}]
        return raw_df(spark, cols, data)

    jobs = raw_df(spark, JOB_COLS, [
        {"OpeningID": "J1", "PostingDate": "2016-01-05", "NTD_ID": "10001", "ModeCode": "MB", "TOS": "DO",
         "EmploymentType": "full time", "PositionTitle": "Bus Operator", "Department": "vehicle operations",
         "SalaryMinHourly": "20", "SalaryMaxHourly": "30", "PostingStatus": "filled", "FilledDate": "2016-02-01",
         "ClosingDate": "2016-02-10", "OpenPositions": "3", "HiredCount": "2", "DaysOpen": "30",
         "NTDLaborObjectClass": "Vehicle Operations", "OperatorStatus": "Operator"},
        {"OpeningID": "J1", "PostingDate": "2015-12-01", "NTD_ID": "10001", "PositionTitle": "Bus Operator"},
        {"OpeningID": "J2", "PostingDate": "1900-01-01", "PositionTitle": "Mechanic"},
        {"OpeningID": "J3", "PostingDate": "2016-03-01", "SalaryMinHourly": "50", "SalaryMaxHourly": "40"},
        {"OpeningID": "J4", "PostingDate": "2016-03-01", "ClosingDate": "2016-01-01"},
        {"OpeningID": " ", "PostingDate": "2016-03-01"},
        {"OpeningID": "J5", "PostingDate": "3/15/2016", "NTD_ID": "20002", "EmploymentType": "PT",
         "PositionTitle": "Mechanic", "FilledDate": "2016-01-01", "PostingStatus": "weird", "Department": "Safety"},
    ])
    cal = calendar_range(spark, "2010-01-01", "2019-12-31")
    raw_cal = cal.select(*[F.col(c).cast("string").alias({"DateKey": "Id", "FullDate": "Date"}.get(c, c))
                           for c in DIM_DATE_COLUMNS])
    raw_cal = raw_cal.unionByName(raw_df(spark, raw_cal.columns, [{"Id": "x", "Date": "2020-01-01"},
                                                                   {"Id": "20200102", "Date": "2020-01-02",
                                                                    "DayLongName": "undefined"}]))
    raw = {"agency_information": agency, "agency_mode_service": ams, "ts_upt": upt, "ts_vrm": vrm,
           "safety_events": safety, "employees_2014": employees(2014), "employees_2018": employees(2018),
           "employees_2019": employees(2019), "employees_2022": employees(2022, pad=True), "job_openings": jobs}
    return raw, raw_cal


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("mart"))
    store = SnapshotStore(spark, root)
    raw, raw_cal = fixtures(spark)
    runner = MartRunner(spark, store, load_date=dt.date(2024, 1, 1), batch_id=1)
    report = runner.run_all(raw, raw_cal)
    return store, runner, raw, raw_cal, report


def test_staging(warehouse):
    store, *_ = warehouse
    ag = {r.ntd_id: r for r in store.read("stg_agency_information").collect()}
    assert set(ag) == {"10001", "20002", ""}  # only the 'None' sentinel is nulled here
    assert ag["10001"].zip_code == "98104" and ag["10001"].region == 10
    assert ag["20002"].city is None and ag["20002"].primary_uza_uace_code == "80389"
    upt = {(r.ntd_id, r.uace_code): r for r in store.read("stg_ts_upt").collect()}
    r = upt[("10001", "80389")]
    assert (float(r.y2015), float(r.y2016), r.y2017, r.y2018) == (416.0, 500.0, None, None)
    ev = {r.incident_number: r for r in store.read("stg_major_safety_event").collect()}
    assert set(ev) == {1, 2, 3}
    e1 = ev[1]
    assert (e1.passenger_fatality_count, e1.employee_fatality_count, e1.other_fatality_count) == (2, 1, 0)
    assert e1.event_date == dt.date(2016, 12, 31) and e1.event_time == "07:05:00" and e1.evacuation is True
    assert float(e1.property_damage_amount) == 1000.0 and ev[2].other_fatality_count is None
    uni = store.read("stg_employee_unified")
    assert set(r.ReportYear for r in uni.select("ReportYear").distinct().collect()) == {2014, 2018, 2019, 2022}
    r14 = uni.filter("ReportYear = 2014 AND DepartmentName = 'Vehicle Operations' AND EmploymentType = 'FullTime'")
    assert [(float(x.HoursWorked), float(x.EmployeeCount)) for x in r14.collect()] == [(1234.0, 10.0)]
    r22 = uni.filter("ReportYear = 2022").select("OperatorType", "HoursWorked").collect()
    assert sorted((x.OperatorType, float(x.HoursWorked)) for x in r22) == [("Non Operator", 50.0), ("Operator", 100.0)]
    jobs = store.read("stg_job_openings")
    assert sorted(r.opening_id for r in jobs.collect()) == ["J1", "J1", "J5"]
    rej = {r.opening_id: r.dq_reason for r in store.read("stg_job_openings_rejects").collect()}
    assert rej == {"J2": "invalid_posting_date", "J3": "salary_range_invalid", "J4": "date_sequence_invalid",
                   None: "missing_opening_id"}


def test_dimensions(warehouse):
    store, *_ = warehouse
    dd = store.read("DimDate")
    assert dd.filter("DateKey = -1").count() == 1 and dd.filter("DateKey = 20200102").first().DayLongName is None
    assert dd.filter("DateKey > 0").count() == 3652 + 1 + 1  # + 2020-01-02 + the 99991231 member
    ag = store.read("DimAgency").collect()
    assert sorted(r.NTD_ID for r in ag) == ["10001", "20002", "N/A"]
    assert {r.NTD_ID: r.EffectiveDate for r in ag}["10001"] == dt.date(1900, 1, 1)
    assert store.read("DimMode").count() == 22 and store.read("DimServiceType").count() == 5
    ua = store.read("DimUrbanArea").filter("UrbanAreaKey > 0").collect()
    assert [(r.UACECode, r.UZAPopulation) for r in ua] == [("80389", 3600000)]
    et = store.read("DimSafetyEventType").collect()
    assert sorted((r.EventCategory, r.SeverityLevel) for r in et if r.SafetyEventTypeKey > 0) == \
        [("Collision", "Safety"), ("Security", "Security")]
    assert store.read("DimSafetyIncident").count() == 4
    emp = {r.EmploymentTypeCode for r in store.read("DimEmploymentType").collect()}
    assert emp == {"N/A", "FT", "PT", "CT", "ST", "TE"}
    dept = store.read("DimDepartment")
    assert dept.count() == 17 and dept.filter("IsRollup").count() == 3
    assert sorted(r.PositionTitle for r in store.read("DimJobRole").collect()) == \
        ["Bus Operator", "Mechanic", "Unknown Position"]


def test_service_facts(warehouse):
    store, *_ = warehouse
    annual = store.read("Fact_Annual_Service_Performance").collect()
    got = sorted((r.DateKey, r.ModeKey > 0, r.UPT, r.VRM) for r in annual)
    assert got == [(20150101, True, 416, 10), (20160101, True, 77, None), (20160101, True, 500, 900),
                   (20170101, True, None, 5)]
    assert all(r.AgencyKey > 0 for r in annual)
    safety = {r.SourceIncidentID: r for r in store.read("Fact_Major_Safety_Event").collect()}
    assert set(safety) == {"1", "2", "3"}
    assert safety["1"].SafetyEventTypeKey > 0 and safety["2"].SafetyEventTypeKey > 0
    assert safety["3"].EventDateKey == -1 and safety["1"].EvacuationCount == 1
    av = store.read("Fact_Service_Availability").collect()
    assert sorted((r.StartDateKey, r.EndDateKey, r.CommitmentDateKey, r.ServiceActiveFlag) for r in av) == \
        [(20150101, 99991231, 20100101, True), (20160301, 20181231, None, False)]
    life = store.read("Fact_Service_Lifecycle_Accumulating").collect()
    assert len(life) == 3 and all(r.ServiceLifecycleKey is not None for r in life)
    mb = [r for r in life if r.FirstObservedDateKey == 20150101][0]
    assert (mb.LatestObservedDateKey, mb.YearsInService, mb.PeakUPTDateKey, mb.PeakAnnualUPT, mb.LatestAnnualUPT,
            mb.TotalObservedUPT, mb.PeakVRMDateKey, mb.TotalObservedVRM, mb.CommitmentDateKey) == \
        (20160101, 2, 20160101, 500, 500, 916, 20160101, 910, 20100101)
    assert (mb.TotalObservedMajorSafetyEvents, mb.TotalObservedFatalities, mb.TotalObservedInjuries) == (1, 2, 5)
    lr = [r for r in life if r.FirstObservedDateKey == 20170101 and r.PeakVRMDateKey == 20170101][0]
    assert (lr.EndServiceDateKey, lr.LifecycleCompleteFlag, lr.TotalObservedMajorSafetyEvents) == (20181231, False, 0)


def test_workforce_facts(warehouse):
    store, *_ = warehouse
    post = store.read("FactJobPosting").collect()
    assert sorted(r.OpeningID for r in post) == ["J1", "J5"]
    j1 = [r for r in post if r.OpeningID == "J1"][0]
    assert j1.DateKey == 20160105 and j1.AgencyKey > 0 and j1.EmploymentTypeKey > 0 and j1.DepartmentKey > 0
    snap = store.read("FactEmployeeSnapshot").filter("DateKey = 20140101").collect()
    assert len(snap) == 2 and all(r.AgencyKey > 0 and r.EmploymentTypeKey > 0 for r in snap)
    vo = sorted((float(r.HoursWorked), float(r.EmployeeCount), float(r.HoursPerEmployee)) for r in snap)
    assert vo == [(1234.0, 10.0, 123.4), (2000.0, 20.0, 100.0)]
    cov = store.read("FactAgencyLaborCoverage")
    assert cov.filter("AgencyKey = -1").count() == 0 and cov.count() == 5
    lc = {r.OpeningID: r for r in store.read("FactJobPostingLifecycle").collect()}
    assert lc["J1"].FilledDateKey == 20160201 and lc["J5"].FilledDateKey is None


def test_rerun_is_idempotent(spark, warehouse):
    store, runner, raw, raw_cal, _ = warehouse
    facts = ["Fact_Annual_Service_Performance", "Fact_Major_Safety_Event", "Fact_Service_Availability",
             "Fact_Service_Lifecycle_Accumulating", "FactJobPosting", "FactEmployeeSnapshot",
             "FactAgencyLaborCoverage", "FactJobPostingLifecycle", "DimAgency", "DimUrbanArea", "DimJobRole"]
    before = {t: store.read(t).count() for t in facts}
    MartRunner(spark, store, load_date=dt.date(2024, 1, 2), batch_id=2).run_all(raw, raw_cal)
    after = {t: store.read(t).count() for t in facts}
    assert before == after
    audit = store.read("etl_load_audit")
    assert audit.filter("status = 'FAILED'").count() == 0 and audit.select("run_id").distinct().count() == 2
    ins = {r.run_id: r.rows_inserted for r in
           audit.filter("procedure_name = 'service_facts.Fact_Major_Safety_Event' AND status = 'SUCCESS'").collect()}
    # every step has its start row and its final row
    assert audit.filter("status = 'IN_PROGRESS'").count() == audit.filter("status <> 'IN_PROGRESS'").count()
    assert ins == {1: 3, 2: 0}  # observed on the append itself: 3 incidents, then nothing new


def test_failure_gates_later_marts(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    runner = MartRunner(spark, store, load_date=dt.date(2024, 1, 1), batch_id=3)
    with pytest.raises(MartLoadError):
        runner.run_all(raw=None)  # no staged agency: the common mart fails, nothing else runs
    assert not store.exists("DimUrbanArea")
    assert store.read("etl_load_audit").filter("status = 'FAILED'").count() == 1


def test_job_openings_dq_report(warehouse):
    store, *_ = warehouse
    jobs = store.read("stg_job_openings")
    rep = dict((r.check, r.violations) for r in workforce.job_openings_dq_report(jobs).collect())
    assert rep == {"null_critical_fields": 0, "salary_range": 0, "date_order": 0}
    top = workforce.job_openings_summary(jobs).first()
    assert (top.employment_type, top.postings) == ("Full-Time", 2)


def test_cli_loads_from_csv_folder(spark, tmp_path):
    from martkit.plans import cli
    raw, raw_cal = fixtures(spark)
    raw_dir = tmp_path / "raw"
    raw_dir.mkdir()
    for name, df in list(raw.items()) + [("calendar", raw_cal)]:
        pdf = df.toPandas()
        pdf.to_csv(raw_dir / f"{name}.csv", index=False)
    store_dir = str(tmp_path / "mart")
    report = cli.main(["--raw-dir", str(raw_dir), "--store", store_dir, "--load-date", "2024-01-01",
                       "--batch-id", "7", "--skip-workforce"], spark=spark)
    st = SnapshotStore(spark, store_dir)
    assert "workforce_facts" not in report and st.read("Fact_Major_Safety_Event").count() == 3
    assert st.read("DimDate").filter("DateKey > 0").count() == 3652 + 2


def test_every_fact_key_resolves(warehouse):
    """Referential integrity (Q3) after every fact load: each foreign key - including the
    unknown member -1 - exists in its dimension."""
    from martkit.operators.quality import combine_checks, referential
    store, *_ = warehouse
    dims = {"AgencyKey": "DimAgency", "ModeKey": "DimMode", "ServiceTypeKey": "DimServiceType",
            "UrbanAreaKey": "DimUrbanArea", "SafetyEventTypeKey": "DimSafetyEventType",
            "EmploymentTypeKey": "DimEmploymentType", "DepartmentKey": "DimDepartment", "JobRoleKey": "DimJobRole"}
    dates = {"DateKey", "EventDateKey", "StartDateKey", "EndDateKey", "CommitmentDateKey", "PostingDateKey",
             "FilledDateKey", "ClosingDateKey"}
    facts = ["Fact_Annual_Service_Performance", "Fact_Major_Safety_Event", "Fact_Service_Availability",
             "Fact_Service_Lifecycle_Accumulating", "FactJobPosting", "FactEmployeeSnapshot",
             "FactAgencyLaborCoverage", "FactJobPostingLifecycle"]
    checks = []
    for f in facts:
        fact = store.read(f)
        for col in fact.columns:
            if col in dims:
                checks.append(referential(fact, col, store.read(dims[col]), col, name=f"{f}.{col}"))
            elif col in dates:
                checks.append(referential(fact, col, store.read("DimDate"), "DateKey", name=f"{f}.{col}"))
    bad = {r.check: r.violations for r in combine_checks(*checks).collect() if r.violations}
    assert bad == {}


def test_reload_replaces_by_grain(spark, warehouse):
    """--reload: service facts are replaced on their grain (same row counts, new batch id)."""
    store, runner, raw, raw_cal, _ = warehouse
    facts = ["Fact_Annual_Service_Performance", "Fact_Major_Safety_Event", "Fact_Service_Availability"]
    before = {t: store.read(t).count() for t in facts}
    MartRunner(spark, store, load_date=dt.date(2024, 1, 3), batch_id=9, reload=True).run_all(
        raw, raw_cal, skip_workforce=True)
    for t in facts:
        f = store.read(t)
        assert f.count() == before[t], t
        assert {r.ETL_BatchID for r in f.select("ETL_BatchID").distinct().collect()} == {9}, t


def test_rows_withdrawn_from_a_batch_go(spark):
    """A reload of the same batch id drops what the batch loaded before."""
    from martkit.plans.marts import service
    existing = service.empty_fact_availability(spark)
    cols = "AgencyKey int, ModeKey int, ServiceTypeKey int, CommitmentDateKey int, StartDateKey int, EndDateKey int, " \
           "ServiceActiveFlag boolean"
    rows = spark.createDataFrame([(i, 1, 1, None, 20200101, 99991231, True) for i in (1, 2)], cols)

    def load(cur, new, batch, reload):
        return service._publish_rows(cur, new, service.AVAILABILITY_GRAIN, "ServiceAvailabilityKey", reload, batch, "t",
                                     None, by_batch=True).next_snapshot(cur)

    one = load(existing, rows, 7, False)
    two = load(one, rows.where("AgencyKey = 2").withColumn("AgencyKey", F.lit(3)), 8, False)
    again = load(two, rows.where("AgencyKey = 2"), 7, True)
    assert sorted((r.AgencyKey, r.ETL_BatchID) for r in again.collect()) == [(2, 7), (3, 8)]


def test_openings_append_and_skips(spark, tmp_root):
    store = SnapshotStore(spark, tmp_root)
    jobs = raw_df(spark, JOB_COLS, [{"OpeningID": "J1", "PostingDate": "2016-01-05"}, {"OpeningID": " "}])
    for _ in range(2):
        MartRunner(spark, store, append_openings=True).stage({"job_openings": jobs})
    assert store.read("stg_job_openings").count() == 2 and store.read("stg_job_openings_rejects").count() == 2
    MartRunner(spark, store).stage({"job_openings": jobs})
    assert store.read("stg_job_openings").count() == 1
    bad = jobs.drop("PostingDate")
    done = MartRunner(spark, store, throw_on_failure=False).stage({"job_openings": bad})
    assert [r.status for r in done] == ["FAILED"]
    with pytest.raises(Exception, match="stg_job_openings"):
        MartRunner(spark, store).stage({"job_openings": bad})
    skipped = MartRunner(spark, store, skip_steps=frozenset({"DimDate", "DimAgency"})).run_common()
    assert [r.status for r in skipped] == ["SKIPPED", "SKIPPED", "SUCCESS", "SUCCESS"]
    with pytest.raises(Exception, match="no real date"):
        MartRunner(spark, store).run_common()

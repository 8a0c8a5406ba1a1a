import os

from pyspark.sql import functions as F

from martkit.plans.marts import service, workforce
from martkit.sources.raw import read_raw_csv, read_yearly
from martkit.sources.store import ensure_namespace, write_staging


def test_read_raw_csv_all_strings_and_trimmed_headers(spark, tmp_root):
    path = os.path.join(tmp_root, "raw.csv")
    with open(path, "w") as f:
        f.write(" NTD ID ,Agency Name , 2015 \n00001,Metro,416.0\n00002,None,\n")
    df = read_raw_csv(spark, path)
    assert df.columns == ["NTD ID", "Agency Name", "2015"]
    assert all(t == "string" for _, t in df.dtypes)
    assert [tuple(r) for r in df.collect()] == [("00001", "Metro", "416.0"), ("00002", "None", None)]


def test_read_yearly_conforms_layouts(spark, tmp_root):
    p14, p17 = os.path.join(tmp_root, "e2014.csv"), os.path.join(tmp_root, "e2017.csv")
    with open(p14, "w") as f:
        f.write("5 Digit NTD ID,Agency Name\n1,A\n")
    with open(p17, "w") as f:
        f.write("NTD ID,Agency Name,Extra\n2,B,x\n")
    out = read_yearly(spark, {2014: p14, 2017: p17},
                      {2014: {"5 Digit NTD ID": "ntd_id"}, 2017: {"NTD ID": "ntd_id"}},
                      ["ntd_id", "Agency Name"])
    assert sorted(tuple(r) for r in out.collect()) == [("1", "A", 2014), ("2", "B", 2017)]


def test_staging_truncate_switch_and_namespace(spark, tmp_root):
    path = os.path.join(tmp_root, "stg")
    write_staging(spark.range(3), path)
    write_staging(spark.range(2), path, truncate_before_load=False)
    assert spark.read.parquet(path).count() == 5
    write_staging(spark.range(1), path)
    assert spark.read.parquet(path).count() == 1
    ensure_namespace(spark, "martkit_test_ns")
    assert "martkit_test_ns" in [d.name for d in spark.catalog.listDatabases()]


def test_archive_metric_staging(spark):
    cols = [c.source for c in service._metric_spec(service.ARCHIVE_YEARS, True)]
    row = {c: None for c in cols}
    row.update({"NTD ID": "1234.0", "Legacy NTD ID": " L1 ", "Census Year": "2010", "UACE Code": "80389.0",
                "Mode": "MB", "Service": "DO", "1991": "12.5", "2014": "", "2000": "x"})
    raw = spark.createDataFrame([tuple(row[c] for c in cols)], ", ".join(f"`{c}` string" for c in cols))
    r = service.stage_metric(raw, archive=True).first()
    assert (r.ntd_id, r.legacy_ntd_id, r.census_year, r.uace_code, r.service) == ("1234", "L1", 2010, "80389", "DO")
    assert float(r.y1991) == 12.5 and r.y2014 is None and r.y2000 is None


def test_every_employee_layout_year_stages(spark):
    for year in range(2014, 2025):
        lay = workforce.employee_layout(year)
        headers = list(lay.values())
        assert len(set(headers)) == len(headers), year
        vals = {h: "1" for h in headers}
        vals[lay["ntd_id"]] = "12,345"
        raw = spark.createDataFrame([tuple(vals[h] for h in headers)], ", ".join(f"`{h}` string" for h in headers))
        s = workforce.stage_employees(raw, year)
        r = s.first()
        assert r.ntd_id == "12345"
        u = workforce.unify_employees({year: s})
        n = len(workforce.employee_variants(year))
        assert u.count() == n == (14 if year <= 2018 else 16), year
        assert u.filter(F.col("HoursWorked") != 1).count() == 0


def test_cli_discovers_only_known_feeds(spark, tmp_root):
    from martkit.plans.cli import discover_feeds
    for name in ("agency_information.csv", "employees_2019.csv", "ts_upt.csv", "notes.csv", "calendar.txt"):
        with open(os.path.join(tmp_root, name), "w") as f:
            f.write("a,b\n1,2\n")
    assert sorted(discover_feeds(spark, tmp_root)) == ["agency_information", "employees_2019", "ts_upt"]

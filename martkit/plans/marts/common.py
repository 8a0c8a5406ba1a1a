"""Common mart: calendar, agency (SCD2), mode and type-of-service dimensions.

Every loader is a pure function ``(inputs..., current dimension) -> next dimension``; the
runner publishes the result and writes the audit row.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.functions import cleanse as cl
from martkit.operators.dedup import keep_first
from martkit.operators.joins import anti_join
from martkit.operators.scd import scd2_apply, verify_static
from martkit.plans.calendar import DIM_DATE_COLUMNS, special_dates

# NTD mode codes and names.
MODES = [
    ("AR", "Alaska Railroad"), ("CB", "Commuter Bus"), ("CC", "Cable Car"), ("CR", "Commuter Rail"),
    ("DR", "Demand Response"), ("DT", "Demand Response Taxi"), ("EB", "Electric Bus"), ("FB", "Ferryboat"),
    ("HR", "Heavy Rail"), ("IP", "Inclined Plane"), ("LR", "Light Rail"), ("MB", "Motor Bus"),
    ("MG", "Monorail / Automated Guideway"), ("OR", "Other Rail"), ("PB", "Publico"), ("RB", "Bus Rapid Transit"),
    ("SR", "Streetcar Rail"), ("TB", "Trolleybus"), ("TR", "Aerial Tramway"), ("VP", "Vanpool"), ("YR", "Hybrid Rail"),
]

# NTD type-of-service codes, names and categories.
SERVICE_TYPES = [
    ("DO", "Directly Operated", "Direct Operations"),
    ("PT", "Purchased Transportation", "Contracted Operations"),
    ("TN", "Volunteer Driver", "Non-Traditional"),
    ("TX", "Taxi", "Non-Traditional"),
]

AGENCY_SCHEMA = T.StructType([
    T.StructField("AgencyKey", T.IntegerType()), T.StructField("NTD_ID", T.StringType()),
    T.StructField("LegacyNTD_ID", T.StringType()), T.StructField("AgencyName", T.StringType()),
    T.StructField("OrganizationType", T.StringType()), T.StructField("City", T.StringType()),
    T.StructField("State", T.StringType()), T.StructField("Region", T.ShortType()),
    T.StructField("ServiceAreaSqMiles", T.DecimalType(18, 2)), T.StructField("ServiceAreaPopulation", T.LongType()),
    T.StructField("EffectiveDate", T.DateType()), T.StructField("ExpirationDate", T.DateType()),
    T.StructField("CurrentFlag", T.BooleanType()),
])

AGENCY_TEXT_ATTRS = ["AgencyName", "City", "State", "OrganizationType"]
AGENCY_NUM_ATTRS = ["Region", "ServiceAreaSqMiles", "ServiceAreaPopulation"]


def dim_mode(spark: SparkSession) -> DataFrame:
    """Static mode dimension: unknown member -1 plus the fixed code list (keys 1..n)."""
    rows = [(-1, "N/A", "Unknown Mode")] + [(i + 1, c, n) for i, (c, n) in enumerate(MODES)]
    return spark.createDataFrame(rows, "ModeKey int, ModeCode string, ModeName string")


def dim_service_type(spark: SparkSession) -> DataFrame:
    rows = [(-1, "N/A", "Unknown Service Type", None)] + [(i + 1, *r) for i, r in enumerate(SERVICE_TYPES)]
    return spark.createDataFrame(rows, "ServiceTypeKey int, TOSCode string, ServiceTypeName string, ServiceCategory string")


def verify_static_dims(spark: SparkSession) -> DataFrame:
    """The static dimensions hold their expected member counts (+ unknown)."""
    return verify_static(dim_mode(spark), len(MODES) + 1, "DimMode").unionByName(
        verify_static(dim_service_type(spark), len(SERVICE_TYPES) + 1, "DimServiceType"))


def empty_dim_date(spark: SparkSession) -> DataFrame:
    """The calendar dimension as created: only the two special members."""
    return special_dates(spark)


def dim_date_load(raw_calendar: DataFrame, existing: DataFrame) -> DataFrame:
    """Insert-only calendar load from the raw calendar file.

    Rows whose id or date does not cast are skipped, 'undefined' attribute text becomes
    NULL, and ids already in the dimension are never touched (idempotent).
    """
    raw = raw_calendar
    dk = cl.safe_cast(F.trim("Id"), "int")
    fd = cl.safe_cast(F.trim("Date"), "date")
    src_names = {"DateKey": "Id", "FullDate": "Date"}
    cols = []
    for c in DIM_DATE_COLUMNS:
        if c == "DateKey":
            cols.append(dk.alias(c))
        elif c == "FullDate":
            cols.append(fd.alias(c))
        elif c.endswith("Name"):
            cols.append(cl.null_if_token(src_names.get(c, c), "undefined").alias(c))
        else:
            cols.append(cl.safe_cast(cl.null_if_token(c, "undefined"), "int").alias(c))
    staged = raw.select(*cols).filter(F.col("DateKey").isNotNull() & F.col("FullDate").isNotNull())
    staged = keep_first(staged, ["DateKey"], ["FullDate"])
    new = anti_join(staged, existing, ["DateKey"])
    return existing.unionByName(new.select(*existing.columns))


def empty_dim_agency(spark: SparkSession) -> DataFrame:
    unknown = (-1, "N/A", None, "Unknown Agency", None, None, None, None, None, None,
               _dt.date(1900, 1, 1), _dt.date(9999, 12, 31), True)
    return spark.createDataFrame([unknown], AGENCY_SCHEMA)


def agency_source(staged_agency: DataFrame) -> DataFrame:
    """Cleaned agency rows for the SCD2 compare: trimmed, non-blank id, one row per id
    (duplicates resolved by the largest legacy id, then all columns)."""
    s = staged_agency
    src = s.select(
        F.trim("ntd_id").alias("NTD_ID"), F.trim("legacy_ntd_id").alias("LegacyNTD_ID"),
        F.trim("agency_name").alias("AgencyName"), F.trim("organization_type").alias("OrganizationType"),
        F.trim("city").alias("City"), F.trim("state").alias("State"),
        F.col("region").try_cast("smallint").alias("Region"),
        F.col("service_area_sq_miles").cast("decimal(18,2)").alias("ServiceAreaSqMiles"),
        F.col("service_area_pop").cast("bigint").alias("ServiceAreaPopulation"),
    ).filter(F.col("NTD_ID").isNotNull() & (F.col("NTD_ID") != ""))
    return keep_first(src, ["NTD_ID"], [F.col("LegacyNTD_ID").desc_nulls_last()])


def dim_agency_load(staged_agency: DataFrame, existing: DataFrame, load_date: str | _dt.date,
                    initial_effective: str | _dt.date | None = None) -> DataFrame:
    """SCD2 agency dimension.  Text and numeric attributes are compared null-safely
    (a NULL-to-value change is a change); a changed agency's current version expires the
    day before ``load_date`` and a new version starts on it."""
    src = agency_source(staged_agency)
    return scd2_apply(existing, src, ["NTD_ID"], AGENCY_TEXT_ATTRS + AGENCY_NUM_ATTRS, load_date, "AgencyKey",
                      initial_effective=initial_effective)

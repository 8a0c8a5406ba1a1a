"""Slowly changing dimensions as pure DataFrame functions.

A dimension load never mutates in place: it returns the complete next snapshot of the
dimension, which the store publishes atomically (``martkit.sources.store``).

SCD2 in one pass: the *current* versions are full-outer-joined with the staged source on
the natural key (one shuffle of each side by that key; history rows and the unknown
member bypass the join untouched).  Each joined row yields its existing version (kept,
expired, or corrected in place for a same-day rerun) and, for NEW / CHANGE, a new version,
via one explode; the versions are checkpointed once so the join is not re-run.  New
versions get surrogate keys after the current maximum (``assign_keys``).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.functions.cleanse import any_differs
from martkit.functions.dates import HIGH_DATE
from martkit.operators.joins import anti_join
from martkit.operators.keys import assign_keys, unique_source
from martkit.session import checkpoint_dir

NEW, CHANGE, NO_CHANGE = "NEW", "CHANGE", "NO_CHANGE"


def _date_lit(d: str | _dt.date) -> Column:
    return F.lit(str(d)).cast("date")


def _typed(df: DataFrame, name: str, value: Column) -> Column:
    return value.cast(df.schema[name].dataType).alias(name)


# --- C2 / C3: insert-only -------------------------------------------------------------

def insert_new(dim: DataFrame, src: DataFrame, natural_key: Sequence[str], key_col: str,
               null_safe: bool = False, defaults: dict[str, Column] | None = None) -> DataFrame:
    """SCD0 / MERGE-insert-only: add source members whose natural key is not yet in the
    dimension, keyed after the current maximum.  Existing members are never changed.

    A natural key that repeats in ``src`` raises; rows without any key part are left out
    (``keys.key_report`` counts both).  Columns of the dimension that the source
    lacks are filled from ``defaults`` or NULL.
    """
    src = unique_source(src, natural_key, "insert-only load")
    new = anti_join(src, dim, list(natural_key), null_safe=null_safe)
    keyed = assign_keys(new, list(natural_key), key_col, existing=dim)
    defaults = defaults or {}
    cols = []
    for f in dim.schema.fields:
        if f.name in keyed.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(defaults.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name))
    return dim.unionByName(keyed.select(*cols))


# --- C4: SCD1 upsert ------------------------------------------------------------------

def scd1_upsert(dim: DataFrame, src: DataFrame, natural_key: Sequence[str], key_col: str,
                tracked: Sequence[str], updated_col: str | None = None,
                load_ts: Column | None = None, materialize: bool = True) -> DataFrame:
    """Overwrite tracked attributes of matched members only when one of them changed
    (null-safe), insert unmatched source members with new keys.

    Keys match null-safely; rows without any key part are left out, a key that repeats in
    ``src`` raises.  One full outer join on the natural key yields each existing member (updated or not) and
    each new member in a single explode pass; with ``materialize`` the result is
    checkpointed once, so key assignment and publishing do not re-run the join.
    """
    nk = list(natural_key)
    carried = [c for c in src.columns if c in dim.columns and c != key_col]
    s = unique_source(src, nk, "type-1 load").select(*[F.col(c).alias(f"_s_{c}") for c in carried],
                                                     F.lit(True).alias("_mk_src"))
    cond = None
    for c in nk:
        eq = dim[c].eqNullSafe(s[f"_s_{c}"])
        cond = eq if cond is None else cond & eq
    j = dim.join(s, cond, "full_outer")
    has_cur = F.col(key_col).isNotNull()
    has_src = F.coalesce(F.col("_mk_src"), F.lit(False))
    changed = has_cur & has_src & any_differs([(F.col(t), F.col(f"_s_{t}")) for t in tracked])
    ts = load_ts if load_ts is not None else F.current_timestamp()
    old_cols, new_cols = [], []
    for f in dim.schema.fields:
        c = F.col(f.name)
        if f.name in tracked:
            c = F.when(changed, F.col(f"_s_{f.name}")).otherwise(c)
        elif f.name == updated_col:
            c = F.when(changed, ts).otherwise(c)
        old_cols.append(c.cast(f.dataType).alias(f.name))
        if f.name == key_col:
            n = F.lit(None)
        elif f.name == updated_col:
            n = ts
        elif f.name in carried:
            n = F.col(f"_s_{f.name}")
        else:
            n = F.lit(None)
        new_cols.append(n.cast(f.dataType).alias(f.name))
    old_v = F.when(has_cur, F.struct(*old_cols, F.lit(False).alias("_mk_new")))
    new_v = F.when(has_src & ~has_cur, F.struct(*new_cols, F.lit(True).alias("_mk_new")))
    rows = j.select(F.explode(F.array(old_v, new_v)).alias("_v")).filter(F.col("_v").isNotNull()).select("_v.*")
    if materialize:
        checkpoint_dir(dim.sparkSession)
        rows = rows.checkpoint(eager=True)
    existing = rows.filter(~F.col("_mk_new")).drop("_mk_new")
    keyed = assign_keys(rows.filter(F.col("_mk_new")).drop("_mk_new", key_col), nk, key_col,
                        key_type=dim.schema[key_col].dataType.simpleString(), existing=dim)
    return existing.unionByName(keyed.select(*dim.columns))


def scd1_counts(dim: DataFrame, src: DataFrame, natural_key: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """(inserted, updated, unchanged) counts of an SCD1 upsert, in one aggregate."""
    classified = scd2_classify(dim, src, natural_key, tracked, current_flag=None)
    return classified.agg(
        F.sum(F.when(F.col("ChangeType") == NEW, 1).otherwise(0)).cast("bigint").alias("inserted"),
        F.sum(F.when(F.col("ChangeType") == CHANGE, 1).otherwise(0)).cast("bigint").alias("updated"),
        F.sum(F.when(F.col("ChangeType") == NO_CHANGE, 1).otherwise(0)).cast("bigint").alias("unchanged"))


# --- C5 / C6: change detection ---------------------------------------------------------

def scd2_classify(dim: DataFrame, src: DataFrame, natural_key: Sequence[str], tracked: Sequence[str],
                  current_flag: str | None = "CurrentFlag", key_col: str | None = None,
                  unknown_key: int = -1, hashed: Sequence[str] = ()) -> DataFrame:
    """Source rows tagged NEW / CHANGE / NO_CHANGE against the current versions.

    Natural keys match null-safely.  ``tracked`` columns are compared null-safely; ``hashed`` columns are compared through
    one SHA-256 row hash (the text-attribute variant) - both detect the same changes.
    """
    nk = list(natural_key)
    cur = dim
    if current_flag:
        cur = cur.filter(F.col(current_flag).cast("boolean"))
    if key_col:
        cur = cur.filter(F.col(key_col) != unknown_key)
    from martkit.functions.cleanse import row_hash
    cur_cols = [F.col(c).alias(f"_d_{c}") for c in nk + [t for t in tracked if t not in nk]]
    if hashed:
        cur_cols.append(row_hash(*hashed).alias("_d_hash"))
    d = cur.select(*cur_cols, F.lit(True).alias("_d_is"))
    s = src.withColumn("_s_hash", row_hash(*hashed)) if hashed else src
    cond = None
    for c in nk:  # null-safe like the load itself: a composite key may have NULL parts
        eq = s[c].eqNullSafe(d[f"_d_{c}"])
        cond = eq if cond is None else cond & eq
    j = s.join(d, cond, "left")
    diff = any_differs([(F.col(t), F.col(f"_d_{t}")) for t in tracked if t not in hashed])
    if hashed:
        diff = diff | (F.col("_s_hash") != F.col("_d_hash"))
    ct = (F.when(F.col("_d_is").isNull(), F.lit(NEW))
           .when(diff, F.lit(CHANGE)).otherwise(F.lit(NO_CHANGE)))
    out = j.withColumn("ChangeType", ct)
    return out.drop(*[c for c in out.columns if c.startswith("_d_") or c == "_s_hash"])


def change_counts(classified: DataFrame) -> DataFrame:
    """Q8: rows per change type."""
    return classified.groupBy("ChangeType").agg(F.count(F.lit(1)).alias("n"))


# --- C7: SCD2 apply -------------------------------------------------------------------

def scd2_apply(dim: DataFrame, src: DataFrame, natural_key: Sequence[str], tracked: Sequence[str],
               load_date: str | _dt.date, key_col: str,
               eff_col: str = "EffectiveDate", exp_col: str = "ExpirationDate",
               cur_col: str = "CurrentFlag", initial_effective: str | _dt.date | None = None,
               high_date: str = HIGH_DATE, unknown_key: int = -1, materialize: bool = True) -> DataFrame:
    """Next snapshot of a type-2 dimension after loading ``src`` as of ``load_date``.

    * NEW member: one version, effective ``initial_effective`` (if given) else ``load_date``.
    * CHANGE: the current version expires on ``load_date - 1`` (flag off) and a new version
      starts on ``load_date``; if the current version itself started on ``load_date`` (same-day
      rerun) it is corrected in place instead, keeping its key.
    * NO_CHANGE and members absent from ``src``: untouched.  History rows: untouched.

    Natural keys match null-safely, so a composite key may have NULL parts; rows of ``src``
    without any key part are left out and a key that repeats raises (``keys.key_report``
    counts both).  Columns of ``src`` that exist in the dimension
    are carried onto new versions, other dimension columns become NULL there.  With
    ``materialize`` (default) the versions are checkpointed once, so the current-vs-source
    join runs once per load.
    """
    nk = list(natural_key)
    load = _date_lit(load_date)
    is_current = F.col(cur_col).cast("boolean") & (F.col(key_col) != unknown_key)
    current = dim.filter(is_current)
    other = dim.filter(~is_current | F.col(cur_col).isNull())

    carried = [c for c in src.columns if c in dim.columns and c not in (key_col, eff_col, exp_col, cur_col)]
    s = unique_source(src, nk, "type-2 load").select(*[F.col(c).alias(f"_s_{c}") for c in carried],
                                                     F.lit(True).alias("_mk_src"))
    cond = None
    for c in nk:
        eq = current[c].eqNullSafe(s[f"_s_{c}"])
        cond = eq if cond is None else cond & eq
    j = current.join(s, cond, "full_outer")

    has_cur = F.col(key_col).isNotNull()
    has_src = F.coalesce(F.col("_mk_src"), F.lit(False))
    changed = has_cur & has_src & any_differs([(F.col(t), F.col(f"_s_{t}")) for t in tracked])
    same_day = changed & (F.col(eff_col) == load)
    expire = changed & ~same_day

    # Every joined row yields up to two versions in ONE pass: its existing version (kept,
    # expired, or corrected in place) and, for NEW / CHANGE, a new version (key still NULL).
    existing_cols, new_cols = [], []
    eff_new = load if initial_effective is None else F.when(has_cur, load).otherwise(_date_lit(initial_effective))
    for f in dim.schema.fields:
        c = F.col(f.name)
        if f.name == exp_col:
            c = F.when(expire, F.date_sub(load, 1)).otherwise(c)
        elif f.name == cur_col:
            c = F.when(expire, F.lit(False)).otherwise(F.col(cur_col).cast("boolean"))
        elif f.name in carried and f.name not in nk:
            c = F.when(same_day, F.col(f"_s_{f.name}")).otherwise(c)
        existing_cols.append(c.cast(f.dataType).alias(f.name))
        if f.name == key_col:
            n = F.lit(None)
        elif f.name == eff_col:
            n = eff_new
        elif f.name == exp_col:
            n = _date_lit(high_date)
        elif f.name == cur_col:
            n = F.lit(True)
        elif f.name in carried:
            n = F.col(f"_s_{f.name}")
        else:
            n = F.lit(None)
        new_cols.append(n.cast(f.dataType).alias(f.name))
    old_v = F.when(has_cur, F.struct(*existing_cols, F.lit(False).alias("_mk_new")))
    new_v = F.when(has_src & (~has_cur | expire), F.struct(*new_cols, F.lit(True).alias("_mk_new")))
    versions = j.select(F.explode(F.array(old_v, new_v)).alias("_v")).filter(F.col("_v").isNotNull()).select("_v.*")
    if materialize:
        # Cut the lineage once: the keyed new versions and the published snapshot both read
        # this checkpoint instead of re-running the full-outer shuffle join.
        checkpoint_dir(dim.sparkSession)
        versions = versions.checkpoint(eager=True)
    existing = versions.filter(~F.col("_mk_new")).drop("_mk_new")
    new_versions = versions.filter(F.col("_mk_new")).drop("_mk_new", key_col)
    keyed = assign_keys(new_versions, nk, key_col, key_type=dim.schema[key_col].dataType.simpleString(),
                        existing=dim)
    return other.unionByName(existing).unionByName(keyed.select(*dim.columns))


def scd2_delta(dim: DataFrame, src: DataFrame, natural_key: Sequence[str], tracked: Sequence[str],
               load_date: str | _dt.date, key_col: str, eff_col: str = "EffectiveDate", exp_col: str = "ExpirationDate",
               cur_col: str = "CurrentFlag", initial_effective: str | _dt.date | None = None,
               high_date: str = HIGH_DATE, unknown_key: int = -1, kind_col: str = "_mk_kind") -> DataFrame:
    """The versions that ``scd2_apply`` would add or alter, and no other, with what they are in ``kind_col``:

    ``new`` (first version of a member), ``changed`` (next version of a member), ``closed`` (the version that a change
    ends, with its new expiration) and ``corrected`` (a version of the same day, altered in place).  Only these rows are
    checkpointed.  A version is known by its surrogate key; ``apply_delta`` puts a delta onto a dimension.
    """
    nk = list(natural_key)
    load = _date_lit(load_date)
    current = dim.filter(F.col(cur_col).cast("boolean") & (F.col(key_col) != unknown_key))
    carried = [c for c in src.columns if c in dim.columns and c not in (key_col, eff_col, exp_col, cur_col)]
    s = unique_source(src, nk, "type-2 load").select(*[F.col(c).alias(f"_s_{c}") for c in carried])
    cond = None
    for c in nk:
        eq = s[f"_s_{c}"].eqNullSafe(current[c])
        cond = eq if cond is None else cond & eq
    # members that the source does not hold cannot change: the source drives the join
    j = s.join(current, cond, "left")
    has_cur = F.col(key_col).isNotNull()
    changed = has_cur & any_differs([(F.col(t), F.col(f"_s_{t}")) for t in tracked])
    same_day = changed & (F.col(eff_col) == load)
    kinds = F.when(~has_cur, F.array(F.lit("new"))).when(same_day, F.array(F.lit("corrected"))).when(
        changed, F.array(F.lit("closed"), F.lit("changed")))
    rows = j.withColumn("_mk_kinds", kinds).where("_mk_kinds IS NOT NULL").withColumn(kind_col, F.explode("_mk_kinds"))
    fresh = F.col(kind_col).isin("new", "changed")
    closed = F.col(kind_col) == "closed"
    first = load if initial_effective is None else F.when(F.col(kind_col) == "new", _date_lit(initial_effective)).otherwise(load)
    values = []
    for f in dim.schema.fields:
        c = F.col(f.name)
        if f.name == key_col:
            v = F.when(~fresh, c)
        elif f.name == eff_col:
            v = F.when(fresh, first).otherwise(c)
        elif f.name == exp_col:
            v = F.when(fresh, _date_lit(high_date)).when(closed, F.date_sub(load, 1)).otherwise(c)
        elif f.name == cur_col:
            v = ~closed
        elif f.name in carried:
            v = F.when(closed, c).otherwise(F.col(f"_s_{f.name}"))
        else:
            v = F.when(~fresh, c)
        values.append(v.cast(f.dataType).alias(f.name))
    checkpoint_dir(dim.sparkSession)
    rows = rows.select(*values, kind_col).checkpoint(eager=True)
    keyed = assign_keys(rows.where(fresh).drop(key_col), nk, key_col,
                        key_type=dim.schema[key_col].dataType.simpleString(), existing=dim)
    return rows.where(~fresh).unionByName(keyed.select(*rows.columns))


def apply_delta(dim: DataFrame, delta: DataFrame, key_col: str) -> DataFrame:
    """``dim`` with the versions of a delta: known surrogate keys replaced, new ones added."""
    return anti_join(dim, delta, [key_col]).unionByName(delta.select(*dim.columns))


def seed_dimension(rows: DataFrame, natural_key: Sequence[str], key_col: str, specials: DataFrame | None = None,
                   eff_col: str | None = None, exp_col: str | None = None, cur_col: str | None = None,
                   effective: str = "1900-01-01", high_date: str = HIGH_DATE) -> DataFrame:
    """Initial load of a dimension: keys 1..n in natural-key order, optional SCD2 columns, plus
    special members (unioned before/after key assignment; their keys are fixed)."""
    keyed = assign_keys(rows, list(natural_key), key_col, start_after=0)
    if eff_col:
        keyed = keyed.withColumn(eff_col, _date_lit(effective))
    if exp_col:
        keyed = keyed.withColumn(exp_col, _date_lit(high_date))
    if cur_col:
        keyed = keyed.withColumn(cur_col, F.lit(True))
    if specials is not None:
        keyed = specials.select(*keyed.columns).unionByName(keyed)
    return keyed


def verify_static(dim: DataFrame, expected_rows: int, name: str) -> DataFrame:
    """Static reference dimension check - one row (name, rows, expected, ok)."""
    return dim.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("dimension"), "rows", F.lit(expected_rows).cast("bigint").alias("expected"),
        (F.col("rows") == expected_rows).alias("ok"))

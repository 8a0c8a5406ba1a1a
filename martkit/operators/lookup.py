"""Dimension key resolution.

A ``Lookup`` describes one natural-key -> surrogate-key resolution; ``resolve_keys`` folds
a list of them over a fact.  Misses become the unknown member (-1 by default).

Join strategy:
* the dimension side is projected to the join columns + key (+ validity dates) before the
  join, so at most a few narrow columns are shuffled or broadcast;
* ``broadcast=True`` is for dimensions whose size is bounded by construction (static code
  tables); an ``int`` broadcasts only after counting at most that many rows
  (``bounded_broadcast``); ``None`` leaves the choice to AQE's runtime size statistics;
* for shuffle joins, fact rows with a NULL join key (they can never match) are salted
  over many partitions in the same pass, so the NULL/unknown group cannot become one giant
  skewed task; AQE's skew-join splitting handles hot non-NULL keys on the streamed (fact)
  side of the left outer join;
* effective-dated lookups keep the equality in the join condition and the validity range
  as a residual predicate, so they plan as hash / sort-merge joins, never nested loops.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martkit.functions.cleanse import norm_key

UNKNOWN_KEY = -1


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast-hint ``df`` only when it provably holds at most ``max_rows`` rows.

    The check is a plain count (partial sums) of a stored table; beyond the bound the DataFrame
    is returned unchanged and the planner falls back to a shuffle join.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


@dataclass
class Lookup:
    """One surrogate-key lookup.

    on        pairs ``(fact column or expression, dim column)`` compared with ``=``
    key       surrogate key column of the dimension
    out       output column on the fact
    asof      fact-side date for an effective-dated (SCD2) lookup
    interval  'closed' (eff <= d <= exp) or 'half_open' (eff <= d < exp)
    normalise compare UPPER(TRIM()) of both sides (case/pad-insensitive source semantics)
    null_safe compare with <=> instead of =
    """

    dim: DataFrame
    on: Sequence[tuple[str | Column, str]]
    key: str
    out: str
    asof: str | Column | None = None
    eff: str = "EffectiveDate"
    exp: str = "ExpirationDate"
    interval: str = "closed"
    default: int | None = UNKNOWN_KEY
    normalise: bool = False
    null_safe: bool = False
    broadcast: bool | int | None = None
    extra: Sequence[str] = field(default_factory=tuple)  # other dim columns to carry over


def _checked(side: DataFrame, lk: Lookup, tag: str) -> DataFrame:
    """The dimension side with a check in its plan: a key that would match a fact row twice raises.

    Plain lookups: a natural key must not repeat.  As-of lookups: the validity intervals of one
    key must not overlap.  Keys with a NULL part never match under ``=`` and are left out.
    """
    keys = [f"_{tag}_k{i}" for i in range(len(lk.on))]
    key = f"_{tag}_key"
    if not lk.null_safe:
        side = side.dropna(subset=keys)
    shown = F.to_json(F.struct(*keys))
    kind = side.schema[key].dataType
    if lk.asof is None:
        others = [c for c in side.columns if c not in keys]
        one = side.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*others)).alias("_r"))
        fault = F.raise_error(F.concat(F.lit(f"lookup {lk.out}: dimension key repeats: "), shown)).cast(kind)
        return one.select(*keys, *[(F.when(F.col("_n") > 1, fault).otherwise(F.col(f"_r.{c}")) if c == key
                                    else F.col(f"_r.{c}")).alias(c) for c in others])
    following = F.lead(f"_{tag}_eff").over(Window.partitionBy(*keys).orderBy(f"_{tag}_eff", f"_{tag}_exp"))
    ends = F.col(f"_{tag}_exp")
    overlap = following <= ends if lk.interval == "closed" else following < ends
    fault = F.raise_error(F.concat(F.lit(f"lookup {lk.out}: validity intervals overlap: "), shown)).cast(kind)
    return side.withColumn("_over", overlap).withColumn(
        key, F.when(F.col("_over"), fault).otherwise(F.col(key))).drop("_over")


def _dim_side(lk: Lookup, tag: str) -> tuple[DataFrame, list[str], bool]:
    cols = []
    for i, (_, dcol) in enumerate(lk.on):
        c = F.col(dcol)
        cols.append((norm_key(c) if lk.normalise else c).alias(f"_{tag}_k{i}"))
    cols.append(F.col(lk.key).alias(f"_{tag}_key"))
    if lk.asof is not None:
        cols += [F.col(lk.eff).alias(f"_{tag}_eff"), F.col(lk.exp).alias(f"_{tag}_exp")]
    extra_names = []
    for e in lk.extra:
        cols.append(F.col(e).alias(f"_{tag}_x_{e}"))
        extra_names.append(e)
    side = _checked(lk.dim.select(*cols), lk, tag)
    broadcasted = False
    if lk.broadcast is True:
        side, broadcasted = F.broadcast(side), True
    elif isinstance(lk.broadcast, int) and not isinstance(lk.broadcast, bool):
        if lk.dim.count() <= lk.broadcast:
            side, broadcasted = F.broadcast(side), True
    return side, extra_names, broadcasted


# NULL-key fact rows are spread over this many salt values in a shuffle join.
NULL_SALT_BUCKETS = 256


def lookup(fact: DataFrame, lk: Lookup, tag: str | None = None) -> DataFrame:
    tag = tag or f"lk_{lk.out}"
    side, extra, broadcasted = _dim_side(lk, tag)
    fact_keys = []
    work = fact
    for i, (fcol, _) in enumerate(lk.on):
        c = _as_col(fcol)
        work = work.withColumn(f"_{tag}_f{i}", norm_key(c) if lk.normalise else c)
        fact_keys.append(f"_{tag}_f{i}")
    if lk.asof is not None:
        work = work.withColumn(f"_{tag}_d", _as_col(lk.asof))

    cond = None
    for i, fk in enumerate(fact_keys):
        fc, dc = work[fk], side[f"_{tag}_k{i}"]
        eq = fc.eqNullSafe(dc) if lk.null_safe else fc == dc
        cond = eq if cond is None else cond & eq
    salted = not broadcasted
    if salted:
        # A NULL key never matches under ``=``, but hash partitioning would send every NULL-key row to
        # one reducer.  An extra equi-join column spreads them out in the same single pass:
        # 0 for every dimension row and every fact row with a key, 1..N for NULL-key fact
        # rows (by the task's input partition, which a retried task reproduces exactly).
        # The dimension's 0 is computed from its data so the optimizer cannot fold it into
        # a residual predicate (which would drop it from the shuffle key).
        any_null = None
        for fk in fact_keys:
            c = F.col(fk).isNull()
            any_null = c if any_null is None else any_null | c
        spread = F.pmod(F.spark_partition_id(), F.lit(NULL_SALT_BUCKETS)) + 1
        work = work.withColumn(f"_{tag}_fs", F.when(any_null, spread).otherwise(F.lit(0)).cast("bigint"))
        zero = F.pmod(F.xxhash64(F.col(f"_{tag}_k0")), F.lit(1))
        if lk.null_safe:
            # NULL keys do match here: a dimension row with one is copied to every salt
            null_dim = F.lit(False)
            for i in range(len(lk.on)):
                null_dim = null_dim | F.col(f"_{tag}_k{i}").isNull()
            salts = F.sequence(F.lit(1), F.lit(NULL_SALT_BUCKETS)).cast("array<bigint>")
            side = side.withColumn(f"_{tag}_ds", F.explode(F.when(null_dim, salts).otherwise(F.array(zero))))
        else:
            side = side.withColumn(f"_{tag}_ds", zero)
        cond = cond & (work[f"_{tag}_fs"] == side[f"_{tag}_ds"])
    if lk.asof is not None:
        d = work[f"_{tag}_d"]
        upper = d <= side[f"_{tag}_exp"] if lk.interval == "closed" else d < side[f"_{tag}_exp"]
        cond = cond & (d >= side[f"_{tag}_eff"]) & upper

    key_expr = F.col(f"_{tag}_key")
    if lk.default is not None:
        key_expr = F.coalesce(key_expr, F.lit(lk.default).cast(lk.dim.schema[lk.key].dataType))
    helpers = fact_keys + ([f"_{tag}_d"] if lk.asof is not None else []) + ([f"_{tag}_fs"] if salted else [])

    out = work.join(side, cond, "left").withColumn(lk.out, key_expr)
    for e in extra:
        out = out.withColumn(e, F.col(f"_{tag}_x_{e}"))
    return out.drop(*(helpers + side.columns))


def resolve_keys(fact: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Resolve every dimension key of a fact; each miss becomes the unknown member.

    Filter the fact *before* resolving its keys: the NULL-key salt of a shuffle lookup is
    derived from the task's partition index, which the optimizer treats as non-deterministic,
    so a filter on fact columns written after this call is not pushed below the join."""
    out = fact
    for i, lk in enumerate(lookups):
        out = lookup(out, lk, tag=f"lk{i}")
    return out


def drop_unresolved(df: DataFrame, *key_cols: str, unknown: int = UNKNOWN_KEY) -> DataFrame:
    """Keep rows whose required dimension keys resolved (not NULL and not the unknown member)."""
    cond = F.lit(True)
    for k in key_cols:
        cond = cond & F.col(k).isNotNull() & (F.col(k) != unknown)
    return df.filter(cond)


def mapped_key(c: str | Column, mapping: dict[str, str], default: str | Column | None = None) -> Column:
    """CASE-mapped join key (e.g. 'FullTime' -> 'Full-Time'); unmatched -> ``default``
    (a literal, a column such as the input itself, or NULL)."""
    col = _as_col(c)
    out = None
    for src, dst in mapping.items():
        cond = col == F.lit(src)
        out = F.when(cond, F.lit(dst)) if out is None else out.when(cond, F.lit(dst))
    dflt = default if isinstance(default, Column) else (F.lit(default) if default is not None else F.lit(None).cast("string"))
    return dflt if out is None else out.otherwise(dflt)


def year_start_lookup(df: DataFrame, year_col: str, calendar: DataFrame, out: str,
                      cal_year: str = "CalendarYear", cal_doy: str = "CalendarDay",
                      cal_key: str = "DateKey", default: int | None = UNKNOWN_KEY) -> DataFrame:
    """The first calendar date key of a year (calendar row with day-of-year 1).

    The calendar is filtered to one row per year before the join, so the build side is at
    most a few hundred rows and is broadcast.
    """
    starts = calendar.filter(F.col(cal_doy) == 1).select(
        F.col(cal_year).alias("_ys_year"), F.col(cal_key).alias("_ys_key"))
    j = df.join(F.broadcast(starts), df[year_col] == starts["_ys_year"], "left")
    key = F.col("_ys_key") if default is None else F.coalesce(F.col("_ys_key"), F.lit(default))
    return j.withColumn(out, key).drop("_ys_year", "_ys_key")

"""Data-quality checks over DataFrames (Q1-Q9).

Declared constraints (CHECK / NOT NULL / UNIQUE / FOREIGN KEY) become checks that run in as
few passes as possible: all row rules of a table are evaluated in ONE aggregate, uniqueness
is one group-by, referential integrity one anti join.  A rule is a boolean ``Column``; a
NULL result passes, as a SQL CHECK constraint does.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.operators.joins import anti_join


@dataclass(frozen=True)
class Rule:
    name: str
    condition: Column
    null_passes: bool = True


def not_null(*cols: str) -> list[Rule]:
    """Q6: NOT NULL as rules (NULL must fail here, so ``null_passes`` is off)."""
    return [Rule(f"{c}_not_null", F.col(c).isNotNull(), null_passes=False) for c in cols]


def _violation(rule: Rule) -> Column:
    ok = F.coalesce(rule.condition, F.lit(rule.null_passes))
    return F.when(~ok, 1).otherwise(0)


def check_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Q1/Q6: (rule, violations) for every rule, computed in a single aggregate pass."""
    wide = df.agg(*[F.sum(_violation(r)).cast("bigint").alias(f"r{i}") for i, r in enumerate(rules)])
    pairs = ", ".join(f"'{r.name}', coalesce(r{i}, 0L)" for i, r in enumerate(rules))
    return wide.selectExpr(f"stack({len(rules)}, {pairs}) as (rule, violations)")


def flag_rows(df: DataFrame, rules: Sequence[Rule], valid_col: str = "dq_valid",
              reason_col: str | None = "dq_reason") -> DataFrame:
    """Q4: per-row DQ flags (one boolean column per rule, True = violation), the overall
    validity flag and the first failing rule's name."""
    out = df.withColumns({f"dq_{r.name}": _violation(r) == 1 for r in rules})
    bad = F.lit(False)
    for r in rules:
        bad = bad | F.col(f"dq_{r.name}")
    out = out.withColumn(valid_col, ~bad)
    if reason_col:
        reason = None
        for r in rules:
            cond = F.col(f"dq_{r.name}")
            reason = F.when(cond, F.lit(r.name)) if reason is None else reason.when(cond, F.lit(r.name))
        out = out.withColumn(reason_col, reason)
    return out


def split_rejects(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """P10/Q4: (valid rows, rejected rows with their reason) - the rejects are kept, not dropped."""
    flagged = flag_rows(df, rules)
    flag_cols = [f"dq_{r.name}" for r in rules]
    valid = flagged.filter(F.col("dq_valid")).drop(*flag_cols, "dq_valid", "dq_reason")
    rejects = flagged.filter(~F.col("dq_valid")).drop(*flag_cols, "dq_valid")
    return valid, rejects


def uniqueness(df: DataFrame, key: Sequence[str], where: Column | None = None, name: str | None = None) -> DataFrame:
    """Q2: (check, violations) = number of key values occurring more than once (optionally
    under a filter, like a filtered unique index)."""
    src = df.filter(where) if where is not None else df
    dups = src.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return dups.agg(F.count(F.lit(1)).cast("bigint").alias("violations")).select(
        F.lit(name or "unique_" + "_".join(key)).alias("check"), "violations")


def referential(fact: DataFrame, fk: str, dim: DataFrame, pk: str, name: str | None = None) -> DataFrame:
    """Q3: (check, violations) = fact rows whose foreign key has no dimension row (NULL FKs pass)."""
    orphans = anti_join(fact.filter(F.col(fk).isNotNull()), dim, {fk: pk})
    return orphans.agg(F.count(F.lit(1)).cast("bigint").alias("violations")).select(
        F.lit(name or f"fk_{fk}").alias("check"), "violations")


def combine_checks(*checks: DataFrame) -> DataFrame:
    """Q7: one report from several check results (all shaped (check|rule, violations))."""
    norm = [c.withColumnRenamed("rule", "check") for c in checks]
    out = norm[0]
    for c in norm[1:]:
        out = out.unionByName(c)
    return out

"""Fact-table maintenance.

Every function returns the *next snapshot* (or the rows to append); publishing is the
store's job.  Grain comparisons are null-safe by default so that an idempotent append on
a nullable grain never re-inserts rows whose grain contains NULL (the unique-grain
violation the source system hits).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.operators.joins import anti_join, semi_join
from martkit.operators.keys import assign_keys_hashed, unique_source
from martkit.session import checkpoint_dir
from martkit.sources.fact_table import INSERTED, KEPT, UPDATED, FactTable, Staged


# Incoming batches whose distinct grain fits under this many rows are checked against the
# fact through broadcast keys (no shuffle of the fact); larger ones use a shuffle anti join.
MAX_BROADCAST_BATCH_KEYS = 5_000_000


@dataclass
class FactChange:
    """What one fact load writes.

    ``append``: only the new rows, added to the current version (the existing files are
    never rewritten - the normal, incremental case for transaction and periodic facts);
    ``replace``: a complete next snapshot (reloads, and accumulating snapshots whose rows
    change in place)."""

    rows: DataFrame
    mode: str = "append"

    def next_snapshot(self, existing: DataFrame) -> DataFrame:
        return existing.unionByName(self.rows) if self.mode == "append" else self.rows


def with_lineage(df: DataFrame, batch_id: int | None = None, source_system: str | None = None,
                 load_ts: Column | None = None, batch_col: str = "BatchID", source_col: str = "SourceSystem",
                 inserted_col: str = "InsertedDate", updated_col: str | None = None) -> DataFrame:
    """Lineage columns; the timestamp is one driver-side literal for the whole run."""
    ts = load_ts if load_ts is not None else F.current_timestamp()
    out = df.withColumn(inserted_col, ts)
    if updated_col:
        out = out.withColumn(updated_col, ts)
    if batch_id is not None:
        out = out.withColumn(batch_col, F.lit(batch_id).cast("bigint"))
    if source_system is not None:
        out = out.withColumn(source_col, F.lit(source_system))
    return out


def _written_once(rows: DataFrame) -> DataFrame:
    checkpoint_dir(rows.sparkSession)
    return rows.checkpoint(eager=True)


def new_rows(fact: DataFrame, rows: DataFrame, grain: Sequence[str], null_safe: bool = True,
             max_broadcast_keys: int | None = MAX_BROADCAST_BATCH_KEYS, materialize: bool = True) -> DataFrame:
    """The incoming rows whose grain is not yet in the fact (NOT EXISTS on the grain).

    The batch is checkpointed first (batch-sized write), so an expensive upstream (key
    resolution, aggregation) is computed once; pass ``materialize=False`` for rows that are
    stored or persisted already.  A load batch is small next to a fact that grows for years:
    when it has at most ``max_broadcast_keys`` rows (a plain count of the stored batch), the
    fact is only *scanned*: a left-semi join against the broadcast batch keys picks the few
    fact keys that already exist, and the anti join runs against that small set.  Otherwise
    it is a plain (shuffle) anti join.
    """
    g = list(grain)
    if materialize:
        rows = _written_once(rows)
    if max_broadcast_keys and rows.count() <= max_broadcast_keys:
        keys = F.broadcast(rows.select(*g).distinct())
        seen = semi_join(fact.select(*g), keys, g, null_safe=null_safe)
        return anti_join(rows, seen, g, null_safe=null_safe)
    return anti_join(rows, fact, g, null_safe=null_safe)


def append_idempotent(fact: DataFrame, rows: DataFrame, grain: Sequence[str], null_safe: bool = True,
                      materialize: bool = True) -> DataFrame:
    """Next snapshot = fact + new rows; running it twice adds nothing the second time."""
    return fact.unionByName(new_rows(fact, rows, grain, null_safe, materialize=materialize),
                            allowMissingColumns=True)


def _bounded_keys(rows: DataFrame, grain: list[str], max_rows: int | None) -> DataFrame:
    """The distinct grain of stored ``rows``, broadcast-hinted when a plain count finds at most
    ``max_rows`` of them."""
    keys = rows.select(*grain).distinct()
    if max_rows and rows.count() <= max_rows:
        return F.broadcast(keys)
    return keys


def reload_by_grain(fact: DataFrame, rows: DataFrame, grain: Sequence[str], null_safe: bool = True,
                    max_broadcast_keys: int | None = MAX_BROADCAST_BATCH_KEYS) -> DataFrame:
    """Delete fact rows whose grain is being reloaded, then insert the new rows.
    The rows are written once; their keys are broadcast when they fit the bound, so the fact
    is not shuffled."""
    g = list(grain)
    rows = _written_once(rows)
    kept = anti_join(fact, _bounded_keys(rows, g, max_broadcast_keys), g, null_safe=null_safe)
    return kept.unionByName(rows, allowMissingColumns=True)


def reload_by_batch(fact: DataFrame, rows: DataFrame, batch_col: str, batch_id: int) -> DataFrame:
    """Drop everything a batch loaded, then insert that batch's rows again.

    When the fact is stored partitioned by ``batch_col`` the store can instead overwrite
    just that partition (dynamic partition overwrite)."""
    return fact.filter(~F.col(batch_col).eqNullSafe(F.lit(batch_id))).unionByName(rows, allowMissingColumns=True)


def load_new(existing: DataFrame | FactTable, rows: DataFrame, grain: Sequence[str], key_col: str,
             finish: Callable[[DataFrame], DataFrame], reload: bool = False, parts: Sequence[int] = (),
             withdrawn: Column | None = None) -> FactChange | Staged:
    """C10/C11 with surrogate keys: the rows whose grain is new, or a reload of the rows' grain.

    ``finish`` adds what a new row needs besides its key (lineage).  On a ``FactTable`` only partitions that can
    hold a grain of the batch are read, the largest key comes from the summaries, and a reload writes the touched
    partitions only (``parts``: partitions that it replaces as a whole).  On a plain DataFrame the result is a
    ``FactChange`` over it (``withdrawn``: old rows that a reload drops besides).
    """
    g = list(grain)
    if isinstance(existing, FactTable):
        rows = _written_once(rows)
        n = rows.count()
        if not reload:
            fresh = anti_join(rows, existing.rows_like(rows), g, null_safe=True)
        keyed = assign_keys_hashed(finish(rows if reload else fresh), g, key_col, existing=existing.largest_key(),
                                   existing_key="max_key", expected_rows=n)
        return existing.reload(keyed, parts) if reload else existing.append(keyed, incoming=n)
    incoming = rows if reload else new_rows(existing, rows, g, materialize=True)
    keyed = assign_keys_hashed(finish(incoming), g, key_col, existing=existing)
    keyed = keyed.select(*[F.col(f.name).cast(f.dataType) for f in existing.schema.fields])
    if not reload:
        return FactChange(keyed, "append")
    kept = existing if withdrawn is None else existing.filter(~withdrawn)
    return FactChange(reload_by_grain(kept, keyed, g), "replace")


def load_accumulating(existing: DataFrame | FactTable, incoming: DataFrame, key: Sequence[str], key_col: str,
                      merge: Callable[[DataFrame, DataFrame], DataFrame]) -> FactChange | Staged:
    """C12/C13 with surrogate keys for new rows: ``merge(old, incoming)`` adds the change type (``_mk_change``).

    ``incoming`` and the merged rows are written once.  On a ``FactTable`` only the touched partitions take part.
    """
    def keyed(old: DataFrame, inc: DataFrame, top: DataFrame, top_key: str) -> DataFrame:
        merged = _written_once(merge(old, inc))
        fresh = assign_keys_hashed(merged.filter(F.col(key_col).isNull()).drop(key_col), list(key), key_col,
                                   existing=top, existing_key=top_key, key_type=merged.schema[key_col].dataType.simpleString())
        return merged.filter(F.col(key_col).isNotNull()).unionByName(fresh.select(*merged.columns))

    if isinstance(existing, FactTable):
        return existing.upsert(incoming, lambda old, inc: keyed(old, inc, existing.largest_key(), "max_key"))
    return FactChange(keyed(existing, _written_once(incoming), existing, key_col).select(*existing.columns), "replace")


def accumulating_conditional(existing: DataFrame, incoming: DataFrame, key: Sequence[str],
                             milestones: Sequence[str], measures: Sequence[str] = (),
                             unknown: int = -1, updated_col: str | None = None,
                             load_ts: Column | None = None, change_col: str | None = None) -> DataFrame:
    """Accumulating-snapshot upsert, field by field.

    Matched rows: a milestone takes the incoming value unless that value is unknown (NULL or
    ``unknown``) - then the existing milestone is kept; a measure takes the incoming value
    unless it is NULL.  ``updated_col`` is refreshed only when something changed (null-safe).
    Unmatched incoming rows are inserted; unmatched existing rows are kept.  Keys match
    null-safely; incoming rows without any key part cannot be told apart and are left out
    (``keys.key_report`` counts them), and a key that repeats among them raises.
    One full outer join on the business key.  ``change_col`` adds the change type of every row.
    """
    k = list(key)
    inc = unique_source(incoming, k, "accumulating load").select(
        *[F.col(c).alias(f"_n_{c}") for c in incoming.columns], F.lit(True).alias("_mk_n"))
    old_rows = existing.withColumn("_mk_o", F.lit(True))
    cond = None
    for c in k:
        eq = old_rows[c].eqNullSafe(inc[f"_n_{c}"])
        cond = eq if cond is None else cond & eq
    j = old_rows.join(inc, cond, "full_outer")
    has_old = F.coalesce(F.col("_mk_o"), F.lit(False))
    has_new = F.coalesce(F.col("_mk_n"), F.lit(False))

    values: dict[str, Column] = {}
    change = F.lit(False)
    for f in existing.schema.fields:
        c, n = f.name, f"_n_{f.name}"
        old = F.col(c)
        if c in k:
            v = F.coalesce(old, F.col(n))
        elif n not in j.columns or c == updated_col:
            v = old
        elif c in milestones:
            new = F.col(n)
            known = new.isNotNull() & (new != unknown)
            v = F.when(has_old & ~known, old).otherwise(new)
            change = change | (has_old & has_new & ~old.eqNullSafe(v))
        elif c in measures:
            new = F.col(n)
            v = F.when(has_old & new.isNull(), old).otherwise(new)
            change = change | (has_old & has_new & ~old.eqNullSafe(v))
        else:  # descriptive attributes are written once, on insert
            v = F.when(has_new & ~has_old, F.col(n)).otherwise(old)
        values[c] = v
    if updated_col:
        ts = load_ts if load_ts is not None else F.current_timestamp()
        values[updated_col] = F.when(change | (has_new & ~has_old), ts).otherwise(F.col(updated_col))
    kind = []
    if change_col:
        kind = [F.when(~has_old, F.lit(INSERTED)).when(change, F.lit(UPDATED)).otherwise(F.lit(KEPT)).alias(change_col)]
    return j.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in existing.schema.fields], *kind)


def accumulating_replace(existing: DataFrame, incoming: DataFrame, key: Sequence[str],
                         retain: Sequence[str] = (), change_col: str | None = None) -> DataFrame:
    """Full replace on the business key.  Incoming rows replace existing ones, but keep
    the existing values of ``retain`` columns (surrogate key, original insert timestamp);
    existing rows without an incoming row are kept as they are.  A key that repeats in
    ``incoming`` or has a NULL part raises.  ``change_col`` adds the change type of every row."""
    k = list(key)
    no_key = F.lit(False)
    for c in k:
        no_key = no_key | F.col(c).isNull()
    first = incoming.schema[k[0]].dataType
    fault = F.raise_error(F.concat(F.lit(f"accumulating replace: key ({', '.join(k)}) has a NULL part: "),
                                   F.to_json(F.struct(*k)))).cast(first)
    checked = incoming.withColumn(k[0], F.when(no_key, fault).otherwise(F.col(k[0])))
    inc = unique_source(checked, k, "accumulating replace")
    old = existing.select(*k, *[F.col(c).alias(f"_old_{c}") for c in retain], F.lit(True).alias("_mk_old"))
    inc = inc.join(old, k, "left")
    for c in retain:
        base = F.col(c) if c in incoming.columns else F.lit(None)
        inc = inc.withColumn(c, F.coalesce(F.col(f"_old_{c}"), base)).drop(f"_old_{c}")
    kept = anti_join(existing, incoming, k)
    if change_col:
        inc = inc.withColumn(change_col, F.when(F.col("_mk_old"), F.lit(UPDATED)).otherwise(F.lit(INSERTED)))
        kept = kept.withColumn(change_col, F.lit(KEPT))
    return kept.unionByName(inc.select(*kept.columns))

"""MERGE without a transactional table format (K5-K8, K11; builders B1-B5).

``merge_frame`` computes the new state of a keyed table as a DataFrame:

* target rows LEFT JOIN source rows on the keys (plain ``=``: NULL keys
  never match, B1) -> matched clauses in order (first applicable wins:
  delete drops the row, update rewrites it); unmatched target rows stay;
* source rows whose key is absent from the target (anti join against the
  target's distinct keys) -> not-matched (insert) clauses.

Both joins keep the big target on the streaming side, where AQE can split
a skewed key, and the anti join sees each target key once.  Writers for
path tables live in :mod:`ledgerflow.sinks`.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators.copies import q

Cond = Column | str | Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None

_REF = re.compile(r"\b(source|target)\.(\w+)\b")


@dataclass(frozen=True)
class Clause:
    """One WHEN clause.  ``kind``: 'delete' | 'update' (matched) or 'insert' (not matched)."""

    kind: str
    condition: Cond = None
    values: Mapping[str, Cond] | None = None  # None = every target column from the source


@dataclass(frozen=True)
class MergeSpec:
    """Keys as (target column, source column) pairs plus ordered clauses.

    Only the last matched clause may omit its condition (K11)."""

    on: Sequence[tuple[str, str]]
    clauses: Sequence[Clause] = field(default_factory=tuple)

    def __post_init__(self):
        if not self.on:
            raise ValueError("MERGE needs at least one key column: without keys every row would meet every other")
        matched = [c for c in self.clauses if c.kind in ("delete", "update")]
        for c in matched[:-1]:
            if c.condition is None:
                raise ValueError("only the last MATCHED clause may omit its condition")
        for c in self.clauses:
            if c.kind not in ("delete", "update", "insert"):
                raise ValueError(f"unknown clause kind {c.kind!r}")


def _resolve(cond: Cond) -> Column | None:
    if cond is None:
        return None
    if isinstance(cond, Column):
        return cond
    if isinstance(cond, str):
        return F.expr(_REF.sub(lambda m: f"`{'s__' if m.group(1) == 'source' else 't__'}{m.group(2)}`", cond))
    return cond(lambda c: F.col(f"`t__{c}`"), lambda c: F.col(f"`s__{c}`"))


# ---- builders (B1-B5) ------------------------------------------------------

def key_pairs(keys: Sequence[str]) -> list[tuple[str, str]]:
    """B1: same-named keys on both sides."""
    return [(k, k) for k in keys]


def delete_when(column: str, code: str) -> Clause:
    """Matched rows whose source ``column`` equals ``code`` are deleted."""
    return Clause("delete", lambda t, s: s(column) == F.lit(code))


def upsert_spec(keys: Sequence[str], delete_code_col: str | None = None, delete_code: str = "D",
                insert_when: Cond = None) -> MergeSpec:
    """K5/K6: [delete when source.col = code], update all, insert all."""
    clauses = []
    if delete_code_col:
        clauses.append(delete_when(delete_code_col, delete_code))
    clauses += [Clause("update"), Clause("insert", insert_when)]
    return MergeSpec(key_pairs(keys), tuple(clauses))


def delete_only_spec(keys: Sequence[str], condition: Cond) -> MergeSpec:
    """K7: matched and condition -> delete; nothing else changes."""
    return MergeSpec(key_pairs(keys), (Clause("delete", condition),))


def key_rewrite_spec(target_key: str = "participant_id", old_col: str = "old_participant_id",
                     new_col: str = "new_participant_id") -> MergeSpec:
    """Target key = source old id -> set target key to the new id; no insert."""
    return MergeSpec([(target_key, old_col)], (Clause("update", None, {target_key: f"source.{new_col}"}),))


# ---- evaluation ------------------------------------------------------------

def check_unique_matches(target: DataFrame, source: DataFrame, spec: MergeSpec) -> None:
    """Raise when two source rows match one target row (as transactional MERGE does).

    Only the source is aggregated in the common case; the target is read
    (key columns only, semi-joined to the duplicate keys) just when the
    source actually repeats a key."""
    sk = [s for _, s in spec.on]
    present = None
    for k in sk:
        c = q(k).isNotNull()
        present = c if present is None else present & c
    dup = source.where(present).groupBy(*[q(s) for s in sk]).count().where("count > 1").drop("count")
    if not dup.limit(1).count():
        return
    tkeys = target.select(*[q(t).alias(s) for t, s in spec.on])
    if tkeys.join(dup, sk, "left_semi").limit(1).count():
        raise ValueError("MERGE: several source rows match the same target row")


def merge_frame(target: DataFrame, source: DataFrame, spec: MergeSpec, check_unique: bool = True) -> DataFrame:
    """New table state after MERGE ``source`` INTO ``target`` (schema of ``target``)."""
    if check_unique:
        check_unique_matches(target, source, spec)
    tcols = target.columns
    t = target.select(*[q(c).alias(f"t__{c}") for c in tcols])
    s = source.select(*[q(c).alias(f"s__{c}") for c in source.columns], F.lit(True).alias("_s"))
    on = None
    for tk, sk in spec.on:
        c = t[f"t__{tk}"] == s[f"s__{sk}"]
        on = c if on is None else on & c
    joined = t.join(s, on, "left")
    matched = F.col("_s").isNotNull()

    # matched side: first applicable clause wins
    action = None  # 0 keep, 1 delete, 2+i update i
    updates = []
    for clause in [c for c in spec.clauses if c.kind in ("delete", "update")]:
        cond = _resolve(clause.condition)
        applies = matched & (F.coalesce(cond, F.lit(False)) if cond is not None else F.lit(True))
        code = F.lit(1) if clause.kind == "delete" else F.lit(2 + len(updates))
        if clause.kind == "update":
            updates.append(clause)
        action = F.when(applies, code) if action is None else action.when(applies, code)
    action = (action.otherwise(F.lit(0)) if action is not None else F.lit(0)).alias("_act")
    staged = joined.select("*", action)

    def updated_value(c: str) -> Column:
        expr = F.col(f"`t__{c}`")
        for i, clause in enumerate(updates):
            if clause.values is None:
                if f"s__{c}" in s.columns:
                    val = F.col(f"`s__{c}`")
                else:
                    continue
            elif c in clause.values:
                val = _resolve(clause.values[c])
            else:
                continue
            expr = F.when(F.col("_act") == 2 + i, val.cast(target.schema[c].dataType)).otherwise(expr)
        return expr.alias(c)

    kept = staged.where(F.col("_act") != 1).select(*[updated_value(c) for c in tcols])

    inserts = [c for c in spec.clauses if c.kind == "insert"]
    if not inserts:
        return kept
    tkeys = target.select(*[q(tk).alias(f"_tk_{i}") for i, (tk, _) in enumerate(spec.on)]).distinct()
    anti = None
    for i, (_, sk) in enumerate(spec.on):
        c = s[f"s__{sk}"] == tkeys[f"_tk_{i}"]
        anti = c if anti is None else anti & c
    fresh = s.join(tkeys, anti, "left_anti")
    which = None
    for i, clause in enumerate(inserts):
        cond = _resolve(clause.condition)
        applies = F.coalesce(cond, F.lit(False)) if cond is not None else F.lit(True)
        which = F.when(applies, F.lit(i)) if which is None else which.when(applies, F.lit(i))
    fresh = fresh.withColumn("_ins", which)

    def inserted_value(c: str) -> Column:
        expr = F.lit(None).cast(target.schema[c].dataType)
        for i, clause in reversed(list(enumerate(inserts))):
            if clause.values is None:
                val = F.col(f"`s__{c}`") if f"s__{c}" in s.columns else F.lit(None)
            else:
                val = _resolve(clause.values[c]) if c in clause.values else F.lit(None)
            expr = F.when(F.col("_ins") == i, val.cast(target.schema[c].dataType)).otherwise(expr)
        return expr.alias(c)

    added = fresh.where(F.col("_ins").isNotNull()).select(*[inserted_value(c) for c in tcols])
    return kept.unionByName(added)


def delete_matching(target: DataFrame, source: DataFrame, keys: Sequence[str], condition: Cond = None) -> DataFrame:
    """K7 as a plain anti join: drop target rows whose key meets a source row
    satisfying ``condition`` (evaluated on the source)."""
    s = source.select(*[q(c).alias(f"s__{c}") for c in source.columns])
    cond = _resolve(condition)
    if cond is not None:
        s = s.where(F.coalesce(cond, F.lit(False)))
    s = s.select(*[F.col(f"`s__{k}`") for k in keys]).distinct()
    on = None
    for k in keys:
        c = target[k] == s[f"s__{k}"]
        on = c if on is None else on & c
    return target.join(s, on, "left_anti")


def rewrite_keys(target: DataFrame, changes: DataFrame, target_key: str = "participant_id",
                 old_col: str = "old_participant_id", new_col: str = "new_participant_id",
                 check_unique: bool = True) -> DataFrame:
    """One-hop id rewrite: target key = old id -> new id.

    An old id mapped twice is ambiguous and raises (D22); chains are not
    followed.  The change list is de-duplicated before the left join.
    """
    m = changes.select(q(old_col).alias("_old"), q(new_col).alias("_new")).where(F.col("_old").isNotNull()).distinct()
    if check_unique and m.groupBy("_old").count().where("count > 1").limit(1).count():
        raise ValueError("id rewrite: an old id maps to several new ids")
    j = target.join(m, target[target_key] == m["_old"], "left")
    return j.select(*[
        F.when(F.col("_old").isNotNull(), F.col("_new")).otherwise(q(c)).alias(c) if c == target_key else q(c)
        for c in target.columns
    ])

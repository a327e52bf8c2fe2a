"""Join operators: sentinel (null-safe) keys, prefix keys, the prioritised
rule join (J11), latest-batch semi join (J12) and two-frame merge (J14)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerflow.functions.cleansing import NULL_KEY
from ledgerflow.operators.copies import q
from ledgerflow.session import scratch_path

# A dimension side is broadcast only when counting it proves that it has at
# most this many rows and about this many bytes; otherwise it stays a
# shuffle join (AQE may still switch it at run time from measured sizes).
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def is_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """At most ``max_rows`` rows and ``max_bytes`` of values: one combinable aggregate, one row to the driver."""
    width = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns), F.lit(8))
    probe = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return probe["n"] <= max_rows and (probe["b"] or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast ``df`` only when :func:`is_small` holds."""
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def sentinel(c: Column, value: str = NULL_KEY) -> Column:
    """J3 key expression: NULL -> sentinel, so NULL keys meet each other."""
    return F.coalesce(c, F.lit(value))


def sentinel_on(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], value: str = NULL_KEY) -> Column:
    """AND of ``coalesce(l.a, s) = coalesce(r.b, s)``; stays an equi (hash) join."""
    cond = None
    for a, b in pairs:
        c = sentinel(left[a], value) == sentinel(right[b], value)
        cond = c if cond is None else cond & c
    return cond


# A key counts as heavy from this share of a side's rows (so a side has at most 64 of them), and its rows are
# dealt over this many join keys.
HEAVY_SHARE = 1 / 64
HEAVY_DEAL = 64


def _sentinel_hash(df: DataFrame, cols: Sequence[str]) -> Column:
    return F.xxhash64(*[sentinel(df[c].cast("string")) for c in cols])


def heavy_keys(df: DataFrame, cols: Sequence[str], share: float = HEAVY_SHARE) -> list[int]:
    """Hashes of the sentinel keys that hold ``share`` of the rows or more: a
    frequency sketch, filled by one combinable aggregate.  At most ``1 / share``
    numbers come to the driver, whatever the size of the input."""
    most = int(1 / share)
    found = df.select(_sentinel_hash(df, cols).alias("_h")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(_h, {most}, {100 * most})").alias("top")).first()
    return sorted(e["item"] for e in found["top"] or [] if e["item"] is not None and e["count"] >= share * found["n"])


def dealt_join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], how: str = "left",
               heavy: Sequence[int] | None = None, deal: int = HEAVY_DEAL) -> DataFrame:
    """J3 as :func:`sentinel_on` joins, with heavy keys dealt over tasks.

    Left rows of a heavy key (the NULL key above all) get one of ``deal``
    numbers, drawn from the row's values, so a task that is run again draws
    the same; right rows of such a key are there once per number.  All other keys are
    joined as they are.  ``heavy``: :func:`heavy_keys` of the left side or of
    what it was made from (None: looked up here, one more pass over two columns)."""
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"a {how!r} join would return unmatched right rows once per number")
    hot = list(heavy if heavy is not None else heavy_keys(left, [a for a, _ in pairs]))
    if not hot:
        return left.join(right, sentinel_on(left, right, pairs), how)
    drawn = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(deal)).cast("int")
    one = left.withColumn("_deal", F.when(_sentinel_hash(left, [a for a, _ in pairs]).isin(hot), drawn).otherwise(0))
    every = F.sequence(F.lit(0), F.lit(deal - 1))
    many = right.withColumn("_deal_of", F.explode(F.when(_sentinel_hash(right, [b for _, b in pairs]).isin(hot), every).otherwise(F.array(F.lit(0)))))
    return one.join(many, sentinel_on(one, many, pairs) & (one["_deal"] == many["_deal_of"]), how).drop("_deal", "_deal_of")


# Joined rows that a part of a dealt product makes about, and the most parts that one is dealt into.
PART_PAIRS = 1 << 19
MOST_PARTS = 4096


# The JVM leaves methods of more bytes than this to its interpreter.
COMPILED_METHOD_BYTES = 8000


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """What runs meanwhile runs operator by operator where the one method that Spark makes of a stage would be too
    long to be compiled: a stage of many columns took about ten times as long when it was interpreted."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), COMPILED_METHOD_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to scratch and read again: where two branches of a plan
    would compute it twice, or before a join that makes many rows of one, since
    Spark's compiled stages compute a column where it is used, which is once per
    joined row, unless it comes from a file or a shuffle."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def product_join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], how: str = "inner",
                 part_pairs: int = PART_PAIRS, most_parts: int = MOST_PARTS) -> DataFrame:
    """Equi join whose keys repeat on both sides, so that it makes many more rows than it reads.

    What a key makes is counted first (rows of the left times rows of the
    right).  Left rows of a key that makes more than a part should are dealt
    over several, drawn from their values as in :func:`dealt_join`, and its
    right rows are there once per part, so no task makes a large key's rows
    alone.  ``left`` is read twice (counted, then joined): see :func:`written`."""
    if how not in ("left", "inner"):
        raise ValueError(f"a {how!r} join would return unmatched right rows once per part")
    spark = left.sparkSession
    names = [f"_p{i}" for i in range(len(pairs))]
    lefts = left.groupBy(*[q(a).alias(c) for (a, _), c in zip(pairs, names, strict=True)]).agg(F.count(F.lit(1)).alias("_l"))
    rights = right.groupBy(*[q(b).alias(c) for (_, b), c in zip(pairs, names, strict=True)]).agg(F.count(F.lit(1)).alias("_r"))
    sizes = lefts.join(rights, names).select(*names, (F.col("_l").cast("double") * F.col("_r")).alias("_pairs"))
    total = sizes.agg(F.sum("_pairs")).first()[0] or 0
    part = max(part_pairs, total / most_parts)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(total / part))
    # fewer than most_parts keys can be heavy
    heavy = F.broadcast(sizes.where(F.col("_pairs") > part).select(*names, F.ceil(F.col("_pairs") / part).cast("int").alias("_parts")))

    def on(df: DataFrame, columns: Sequence[str]) -> Column:
        return reduce(lambda a, b: a & b, [df[c] == heavy[n] for c, n in zip(columns, names, strict=True)])

    drawn = F.coalesce(F.pmod(F.xxhash64(*[q(c) for c in left.columns]), F.col("_parts")).cast("int"), F.lit(0))
    one = left.join(heavy, on(left, [a for a, _ in pairs]), "left").select(*[q(c) for c in left.columns], drawn.alias("_deal"))
    every = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))
    many = right.join(heavy, on(right, [b for _, b in pairs]), "left").select(*[q(c) for c in right.columns], every.alias("_deal_of"))
    # by number, so that parts are not put together again by their bytes, which say nothing of what they make
    one = one.repartition(parts, *[q(a) for a, _ in pairs], "_deal")
    many = many.repartition(parts, *[q(b) for _, b in pairs], "_deal_of")
    cond = reduce(lambda x, y: x & y, [one[a] == many[b] for a, b in pairs], one["_deal"] == many["_deal_of"])
    return one.join(many.hint("merge"), cond, how).drop("_deal", "_deal_of")


def prefix(c: Column, length: int = 13) -> Column:
    """J7/J8 key expression: the first ``length`` characters."""
    return F.substring(c, 1, length)


# The prioritised transaction-type rules.  Rule 0 matches on
# the transaction code alone; rules 1-6 compare one usage code (when the
# transaction's value is in the rule's set) plus code and activity; rule 7
# applies otherwise and needs a type row whose ten usage codes are NULL.
RULE0_CODES = ("035", "363", "815", "383", "387", "801", "813", "820", "833", "844", "850", "851", "966")
# The code list of the older single-feed transactions.
RULE0_CODES_SINGLE_FEED = ("35", "363", "383", "387", "801", "813", "820", "833", "844", "850", "851", "966")
RULES = (
    ("usage_code_1", ("1", "2", "3", "4", "5", "6", "7", "8", "9", "A", "B", "C", "L")),
    ("usage_code_2", ("3", "7", "8", "9", "A", "C", "L", "O", "T", "U", "V")),
    ("usage_code_3", ("8", "9")),
    ("usage_code_4", ("1", "2", "3", "4", "5", "6", "7", "8", "9", "A", "B", "C", "D", "L", "R", "WR", "X", "Z")),
    ("usage_code_5", ("9",)),
    ("standard_usage_code_4", ("1", "2", "R")),
)
TYPE_CODE_COLUMNS = (
    "usage_code_1", "usage_code_2", "usage_code_3", "usage_code_4", "usage_code_5",
    "standard_usage_code_1", "standard_usage_code_2", "standard_usage_code_3", "standard_usage_code_4",
    "standard_usage_code_5",
)
MISSING_ACTIVITY = -9999


def activity_key(c: Column) -> Column:
    return F.coalesce(c.try_cast("int"), F.lit(MISSING_ACTIVITY))


def _in_sql(values: Sequence[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _activity_sql(col: str) -> str:
    return f"coalesce(try_cast(`{col}` AS int), {MISSING_ACTIVITY})"


def transaction_rule_keys(
    df: DataFrame, code_col: str = "base_transaction_code", activity_col: str = "activity_type",
    rule0_codes: Sequence[str] = RULE0_CODES,
) -> DataFrame:
    """Left side of J11: first applicable rule, the value it compares, the activity key."""
    rule = f"CASE WHEN `{code_col}` IN ({_in_sql(rule0_codes)}) THEN 0"
    val = f"CASE WHEN `{code_col}` IN ({_in_sql(rule0_codes)}) THEN ''"
    for i, (column, values) in enumerate(RULES, start=1):
        rule += f" WHEN `{column}` IN ({_in_sql(values)}) THEN {i}"
        val += f" WHEN `{column}` IN ({_in_sql(values)}) THEN `{column}`"
    rule += f" ELSE {len(RULES) + 1} END"
    val += " ELSE '' END"
    return df.withColumns({"_rule": F.expr(rule), "_rval": F.expr(val)}).withColumn(
        "_ract", F.expr(f"CASE WHEN _rule = 0 THEN 0 ELSE {_activity_sql(activity_col)} END"))


def type_rule_rows(types: DataFrame, code_col: str = "base_transaction_code", activity_col: str = "activity_type") -> DataFrame:
    """Right side of J11: one row per rule a type row can serve (at most 8x the table)."""
    act = _activity_sql(activity_col)
    all_null = " AND ".join(f"`{c}` IS NULL" for c in TYPE_CODE_COLUMNS)
    options = ["named_struct('_rr', 0, '_rv', '', '_ra', 0, '_rok', true)"]
    for i, (column, values) in enumerate(RULES, start=1):
        options.append(f"named_struct('_rr', {i}, '_rv', `{column}`, '_ra', {act}, "
                       f"'_rok', coalesce(`{column}` IN ({_in_sql(values)}), false))")
    options.append(f"named_struct('_rr', {len(RULES) + 1}, '_rv', '', '_ra', {act}, '_rok', {all_null})")
    expanded = types.select("*", F.inline(F.expr(f"array({', '.join(options)})")))
    return expanded.where("_rok").drop("_rok").withColumnsRenamed({"_rr": "_rule", "_rv": "_rval", "_ra": "_ract"})


@dataclass(frozen=True)
class PreparedTypes:
    """Right side of J11: rule rows with prefixed type columns, their distinct
    keys, whether the rows are small enough to broadcast, and the types' codes
    where they are few (None: not known, or more than ``MOST_CODES``)."""

    rows: DataFrame
    keys: DataFrame
    small: bool
    codes: tuple[str, ...] | None = None


# The most codes that are listed in a filter.
MOST_CODES = 4096


def few_codes(keys: DataFrame, most: int = MOST_CODES) -> tuple[str, ...] | None:
    """The distinct codes of the types' keys, if they are text and at most ``most``."""
    if keys.schema["_t_code"].dataType != StringType():
        return None
    found = keys.select("_t_code").where("_t_code IS NOT NULL").distinct().limit(most + 1).collect()
    return tuple(sorted(r[0] for r in found)) if len(found) <= most else None


def prepared_types(types: DataFrame, type_prefix: str = "tt_", code_col: str = "base_transaction_code",
                   activity_col: str = "activity_type", broadcast_types: bool = True) -> PreparedTypes:
    """Right side of J11, ready to join, probed for its size.  Build once, join many times."""
    right = type_rule_rows(types, code_col, activity_col)
    right = right.select(
        *[q(c).alias(type_prefix + c) for c in types.columns],
        F.col("_rule").alias("_t_rule"), F.col("_rval").alias("_t_rval"), F.col("_ract").alias("_t_ract"),
    )
    small = broadcast_types and is_small(right)
    if not small:  # read for the keys, for the counts and for the join, each time by few tasks where the types are few files
        right = written(right.repartition(int(types.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "rule-types")
    keys = right.select(F.col(type_prefix + code_col).alias("_t_code"), "_t_rule", "_t_rval", "_t_ract").distinct()
    codes = few_codes(keys)
    # the keys are few as long as codes and activities are, whatever the rows
    keys = F.broadcast(keys) if small else broadcast_if_small(keys) if broadcast_types else keys
    return PreparedTypes(right, keys, small, codes)


def of_codes(transactions: DataFrame, prepared: PreparedTypes, code_col: str = "base_transaction_code") -> DataFrame:
    """Transactions whose code some type has: every rule compares the code, so no type takes the others.

    Where the codes are few this is a filter, which Spark moves down to the scan, below what is computed of a row
    and below a shuffle of the rows; it leaves a semi join above them."""
    if prepared.codes is None or transactions.schema[code_col].dataType != StringType():
        return transactions
    return transactions.where(q(code_col).isin(*prepared.codes)) if prepared.codes else transactions.where(F.lit(False))


def typed_rows(transactions: DataFrame, prepared: PreparedTypes, code_col: str = "base_transaction_code",
               activity_col: str = "activity_type", rule0_codes: Sequence[str] | None = None, how: str = "left_semi") -> DataFrame:
    """Transactions that a type row takes (``left_anti``: those that none does), each once; meets the types' distinct keys alone."""
    if how == "left_semi":
        transactions = of_codes(transactions, prepared, code_col)
    left, keys = transaction_rule_keys(transactions, code_col, activity_col, rule0_codes or RULE0_CODES), prepared.keys
    cond = ((left["_rule"] == keys["_t_rule"]) & (left[code_col] == keys["_t_code"])
            & (left["_rval"] == keys["_t_rval"]) & (left["_ract"] == keys["_t_ract"]))
    return left.join(keys, cond, how).drop("_rule", "_rval", "_ract")


def rule_join(
    transactions: DataFrame, types: DataFrame, how: str = "left", type_prefix: str = "tt_",
    code_col: str = "base_transaction_code", activity_col: str = "activity_type", broadcast_types: bool = True,
    prepared: PreparedTypes | None = None, rule0_codes: Sequence[str] | None = None,
) -> DataFrame:
    """Join each transaction to the type rows of its first applicable rule.

    Equivalent to the CASE-in-ON join, but the condition becomes equi keys
    (rule, code, value, activity), so Spark hash-joins instead of running a
    nested loop.  Type columns come back prefixed with ``type_prefix``;
    ``rule0_codes`` are the codes that match on the code alone.  Types too
    many to broadcast are joined by :func:`product_join`, since a code's types
    meet all of its transactions.
    """
    ready = prepared or prepared_types(types, type_prefix, code_col, activity_col, broadcast_types)
    if how in ("left_semi", "left_anti"):
        return typed_rows(transactions, ready, code_col, activity_col, rule0_codes, how)
    if how == "inner":
        transactions = of_codes(transactions, ready, code_col)
    if not ready.small and how == "inner":  # what no type takes is not written
        transactions = typed_rows(transactions, ready, code_col, activity_col, rule0_codes)
    left = transaction_rule_keys(transactions, code_col, activity_col, rule0_codes or RULE0_CODES)
    if not ready.small and how in ("inner", "left"):
        left = written(left, "rule-left")
    return join_rule_rows(left, ready, how, code_col, type_prefix + code_col).drop("_rule", "_rval", "_ract")


def join_rule_rows(left: DataFrame, prepared: PreparedTypes, how: str = "inner", code_col: str = "base_transaction_code",
                   type_code_col: str = "tt_base_transaction_code") -> DataFrame:
    """Rows with rule keys (:func:`transaction_rule_keys`) to the types' rule rows."""
    right = prepared.rows
    pairs = [("_rule", "_t_rule"), (code_col, type_code_col), ("_rval", "_t_rval"), ("_ract", "_t_ract")]
    if prepared.small or how not in ("left", "inner"):
        cond = reduce(lambda a, b: a & b, [left[a] == right[b] for a, b in pairs])
        joined = left.join(F.broadcast(right) if prepared.small else right, cond, how)
    else:
        joined = product_join(left, right, pairs, how)
    return joined.drop("_t_rule", "_t_rval", "_t_ract")


def latest_batches(batches: DataFrame, batch_col: str = "batch_date", n: int = 2, distinct: bool = True) -> DataFrame:
    """O1: the ``n`` most recent batch values (distinct first, D5)."""
    values = batches.select(q(batch_col))
    if distinct:
        values = values.distinct()
    return values.orderBy(q(batch_col).desc_nulls_last()).limit(n)


def keep_latest_batches(
    df: DataFrame, batch_col: str = "batch_date", n: int = 2, reference: DataFrame | None = None, distinct: bool = True
) -> DataFrame:
    """Rows whose batch is among the ``n`` latest batches of ``reference``
    (default: the frame itself, D4).  The kept list has at most ``n`` rows,
    so it is broadcast into a semi join.  Where ``df`` is partitioned by the
    batch, the broadcast list prunes its partitions at run time."""
    kept = latest_batches(reference if reference is not None else df, batch_col, n, distinct)
    kept = kept.withColumnRenamed(batch_col, "_kept_batch")
    # holds for every batch that can match; a comparison on this side is what makes Spark prune the other one by it
    kept = F.broadcast(kept.where(F.length(F.col("_kept_batch").cast("string")) >= 0))
    return df.join(kept, df[batch_col] == kept["_kept_batch"], "left_semi")


def merge_frames(df1: DataFrame, df2: DataFrame, keys: Sequence[str], prefer: str = "left",
                 repeated: str = "first") -> DataFrame:
    """One row per key; each other column is the preferred frame's value,
    or the other frame's when that is NULL (``coalesce``).  Columns present in
    only one frame pass through; the output has the union of columns (df1
    order first).

    Equals a full outer join on the keys when each frame has at most one row
    per key.  ``repeated`` says what a key with several rows in one frame
    gives: ``"first"`` takes that frame's smallest row (by all its columns in
    order, NULLs first) as a whole, ``"error"`` fails the query when such a row
    is met.  Rows with a NULL key never match (as with ``=``) and pass through.

    A tagged union and one ``groupBy`` evaluate each frame once: partial
    aggregation handles a hot key, and a row with a NULL key is a group of its
    own by a tag that no other row has.
    """
    if repeated not in ("first", "error"):
        raise ValueError(f"repeated must be 'first' or 'error', not {repeated!r}")
    keys = list(keys)
    names = list(df1.columns) + [c for c in df2.columns if c not in set(df1.columns)]
    values = [c for c in names if c not in set(keys)]
    first, second = (1, 2) if prefer == "left" else (2, 1)

    def tagged(df: DataFrame, side: int) -> DataFrame:
        present = set(df.columns)
        return df.selectExpr(*[f"`{c}`" if c in present else f"NULL AS `{c}`" for c in names], f"{side} AS _side")

    has_key = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    row = "struct(" + ", ".join(f"`{c}`" for c in values) + ")" if values else "struct(1 AS _none)"
    both = tagged(df1, 1).unionByName(tagged(df2, 2)).selectExpr(
        *[f"`{k}`" for k in keys], "_side", f"{row} AS _row",
        f"CASE WHEN NOT ({has_key}) THEN monotonically_increasing_id() END AS _alone")
    sides = [f"min(CASE WHEN _side = {n} THEN _row END) AS _{place}" for place, n in (("a", first), ("b", second))]
    counts = ["count_if(_side = 1) AS _n1", "count_if(_side = 2) AS _n2"] if repeated == "error" else []
    merged = both.groupBy(*[F.col(f"`{k}`") for k in keys], "_alone").agg(*[F.expr(x) for x in sides + counts])
    if repeated == "error":
        merged = merged.where("if(_n1 > 1 OR _n2 > 1, raise_error('merge_frames: a key has several rows in one frame'), true)")
    return merged.selectExpr(*[f"`{c}`" if c in set(keys) else f"coalesce(_a.`{c}`, _b.`{c}`) AS `{c}`" for c in names])

"""One-pass quality report for bar tables (missing values, invalid option types,
duplicate keys, OHLC invariants, non-positive strikes) with the verdict.

The checks are aggregates of a single ``agg`` (or ``groupBy(...).agg``), each
partial before the shuffle; only the invalid option types, of which there can be
any number, are counted by value in a grouped aggregate of their own.
Checks apply to the columns that are present, so the same report serves the
options, futures and spot tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketbars.schemas import DEDUP_KEYS, OPTION_TYPES, OPTIONS_COLUMNS

_DOUBLE = (T.DoubleType, T.FloatType)


def _missing(df: DataFrame, c: str) -> Column:
    col = F.col(c)
    if isinstance(df.schema[c].dataType, _DOUBLE):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def _num(df: DataFrame, c: str) -> Column:
    col = F.col(c)
    if isinstance(df.schema[c].dataType, _DOUBLE):
        return F.when(~F.isnan(col), col)   # NaN behaves like a missing value
    return col


def ohlc_violation(df: DataFrame) -> Column:
    """True when High < Low/Open/Close or Low > Open/Close (NULL never counts)."""
    o, h, lo, c = (_num(df, x) for x in ("Open", "High", "Low", "Close"))
    cond = (h < lo) | (h < o) | (h < c) | (lo > o) | (lo > c)
    return F.coalesce(cond, F.lit(False))


def _py_set_text(values: Column) -> Column:
    """Sorted string array -> ``{'a', 'b'}``."""
    quoted = F.transform(values, lambda v: F.concat(F.lit("'"), v, F.lit("'")))
    return F.concat(F.lit("{"), F.array_join(quoted, ", "), F.lit("}"))


def invalid_type_counts(df: DataFrame, group_by: Sequence[str] = (), col: str = "OptionType",
                        allowed: Sequence[str] = tuple(OPTION_TYPES)) -> DataFrame:
    """Every invalid value per group, with its rows: [group columns], ``col``, rows."""
    bad = F.col(col).isNotNull() & ~F.col(col).isin(*allowed)
    return df.where(bad).groupBy(*group_by, col).agg(F.count(F.lit(1)).alias("rows"))


LISTED = 100        # invalid values that a report names; the others are counted


def with_invalid_types(report: DataFrame, df: DataFrame, group_by: Sequence[str] = (),
                       col: str = "OptionType",
                       allowed: Sequence[str] = tuple(OPTION_TYPES),
                       listed: int | None = LISTED) -> DataFrame:
    """``report`` (one row per group of ``df``) with ``invalid_values``, the number of
    different invalid values, and ``invalid_types``, the first ``listed`` of them in order
    (None: all of them).

    Dirty free text can have any number of values: they are brought down to one row each
    (``invalid_type_counts``), and with ``listed`` only the first few of a group, found
    before the shuffle by group, come into its row."""
    group_by = list(group_by)
    counts = named = invalid_type_counts(df, group_by, col, allowed)
    if listed is not None:
        some = Window.partitionBy(*group_by).orderBy(col)
        named = counts.withColumn("_n", F.row_number().over(some)).where(F.col("_n") <= listed)
    first = named.groupBy(*group_by).agg(F.array_sort(F.collect_list(col)).alias("invalid_types"))
    total = counts.groupBy(*group_by).agg(F.count(F.lit(1)).alias("invalid_values"))
    no_types, no_values = F.array().cast("array<string>"), F.lit(0).cast("bigint")
    if not group_by:
        return report.withColumns({
            "invalid_types": F.coalesce(first.select("invalid_types").scalar(), no_types),
            "invalid_values": F.coalesce(total.select("invalid_values").scalar(), no_values)})
    for part, column, none in ((first, "invalid_types", no_types), (total, "invalid_values", no_values)):
        named = part.select(*[F.col(g).alias(f"_{g}") for g in group_by], column)
        on = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group_by]
        report = (report.join(named, on, "left").drop(*[f"_{g}" for g in group_by])
                  .withColumn(column, F.coalesce(column, none)))
    return report


def quality_report(df: DataFrame, expected_columns: Sequence[str] = OPTIONS_COLUMNS,
                   keys: Sequence[str] = DEDUP_KEYS["options"],
                   group_by: Sequence[str] | None = None) -> DataFrame:
    """Counts of every check plus ``ok`` and the ordered ``errors`` list.

    Output columns: [group columns], rows, missing_<col> for each expected column
    present, invalid_types (sorted array of the first ``LISTED``), invalid_values (how many
    there are; ``invalid_type_counts`` has a row for each), duplicate_rows,
    ohlc_violations, nonpositive_strikes, ok, errors (array of messages in check order).
    With ``group_by`` the verdict is computed per group in the same job.
    """
    group_by = list(group_by or [])
    present = [c for c in expected_columns if c in df.columns]
    extra = [g for g in group_by if g not in expected_columns]   # grouping-only columns
    columns_ok = [c for c in df.columns if c not in extra] == list(expected_columns)

    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(_missing(df, c)).alias(f"missing_{c}") for c in present]
    has_type = "OptionType" in df.columns
    key_cols = [k for k in keys if k in df.columns]
    if key_cols:
        # struct(...) so that keys containing NULLs are still counted as values
        aggs.append((F.count(F.lit(1)) - F.count_distinct(F.struct(*key_cols)))
                    .alias("duplicate_rows"))
    has_ohlc = all(c in df.columns for c in ("Open", "High", "Low", "Close"))
    if has_ohlc:
        aggs.append(F.count_if(ohlc_violation(df)).alias("ohlc_violations"))
    has_strike = "Strike" in df.columns
    if has_strike:
        aggs.append(F.count_if(F.col("Strike") <= 0).alias("nonpositive_strikes"))

    rep = df.groupBy(*group_by).agg(*aggs) if group_by else df.agg(*aggs)
    if has_type:
        rep = with_invalid_types(rep, df, group_by)

    rows = F.col("rows")
    msgs = []
    if not columns_ok:
        msgs.append(F.lit("Unexpected column structure."))
    msgs += [F.when(F.col(f"missing_{c}") > 0, F.lit(f"Missing values in {c}."))
             for c in present]
    if has_type:
        left = F.col("invalid_values") - F.size("invalid_types")
        msgs.append(F.when(F.size("invalid_types") > 0, F.concat(
            F.lit("Invalid OptionType: "), _py_set_text(F.col("invalid_types")),
            F.when(left > 0, F.concat(F.lit(" and "), left.cast("string"), F.lit(" more")))
            .otherwise(F.lit("")))))
    if key_cols:
        msgs.append(F.when(F.col("duplicate_rows") > 0,
                           F.concat(F.lit("Duplicate rows: "), F.col("duplicate_rows").cast("string"))))
    if has_ohlc:
        msgs.append(F.when(F.col("ohlc_violations") > 0,
                           F.concat(F.lit("Invalid OHLC rows: "), F.col("ohlc_violations").cast("string"))))
    if has_strike:
        msgs.append(F.when(F.col("nonpositive_strikes") > 0, F.lit("Non-positive strike price.")))

    head = [F.lit("Unexpected column structure.")] if not columns_ok else []
    empty_errors = F.array(*(head + [F.lit("DataFrame is empty.")]))
    errors = F.when(rows == 0, empty_errors).otherwise(
        F.array_compact(F.array(*msgs)) if msgs else F.array().cast("array<string>"))
    return rep.withColumn("errors", errors).withColumn("ok", F.size("errors") == 0)


def duplicate_count(df: DataFrame, keys: Sequence[str],
                    group_by: Sequence[str] | None = None) -> DataFrame:
    """rows, distinct_keys and duplicate_rows (rows beyond the first of each
    key; keys with NULLs compare equal, as a struct)."""
    k = F.struct(*[F.col(c) for c in keys])
    aggs = [F.count(F.lit(1)).alias("rows"), F.count_distinct(k).alias("distinct_keys")]
    rep = df.groupBy(*group_by).agg(*aggs) if group_by else df.agg(*aggs)
    return rep.withColumn("duplicate_rows", F.col("rows") - F.col("distinct_keys"))


def validate(df: DataFrame, **kwargs) -> tuple[bool, list[str]]:
    """Driver-side verdict ``(ok, errors)`` of the whole table (one small row back)."""
    r = quality_report(df, **kwargs).select("ok", "errors").first()
    if r is None:   # grouped report of an empty table
        return False, ["DataFrame is empty."]
    return bool(r["ok"]), list(r["errors"])

"""Column profiles and rules drafted from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.quantiles import exact_quantiles


def _melt(df: DataFrame, columns: list[str], kind: str, name: str) -> DataFrame:
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias(name)) for c in columns]
    return df.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")


def value_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows per column and value, values as text; pre-aggregated on the map side."""
    return _melt(df, columns or df.columns, "string", "value").groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("rows")
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column: rows, nulls, distinct values, and for numbers mean, sd and quartiles.

    Everything is exact. Minimum and maximum are numbers for numeric columns and text for others.
    """
    names = columns or df.columns
    numbers = [c for c in numeric_columns(df) if c in names]
    measures = F.array(*[_measures(c, c in numbers) for c in names])
    one_pass = df.agg(measures.alias("m")).select(F.inline("m"))
    distinct = value_counts(df, names).groupBy(F.col("column").alias("_d")).agg(F.count("value").alias("n_distinct"))
    out = one_pass.join(distinct, F.col("column") == F.col("_d"), "left").drop("_d")
    if numbers:
        quartiles = exact_quantiles(_melt(df, numbers, "double", "v"), ["column"], "v", [0.25, 0.5, 0.75], few_keys=True)
        out = out.join(quartiles, "column", "left")
    else:
        out = out.withColumn("quantiles", F.lit(None).cast("array<double>"))
    quartile = lambda i: F.col("quantiles")[i]
    return out.withColumns({"q1": quartile(0), "median": quartile(1), "q3": quartile(2)}).drop("quantiles")


def _measures(column: str, is_number: bool) -> Column:
    number = F.col(column).cast("double") if is_number else F.lit(None).cast("double")
    text = F.lit(None).cast("string") if is_number else F.col(column).cast("string")
    rows = F.count(F.lit(1))
    return F.struct(
        F.lit(column).alias("column"), rows.alias("n_rows"), (rows - F.count(column)).alias("n_nulls"),
        F.min(text).alias("min_text"), F.max(text).alias("max_text"), F.min(number).alias("min"),
        F.max(number).alias("max"), F.avg(number).alias("mean"), F.stddev_samp(number).alias("sd"),
    )


def suggest_rules(
    df: DataFrame, exclude: list[str] | None = None, max_set: int = 10, columns: list[str] | None = None
) -> DataFrame:
    """Draft rules: not-null, unique, numeric range, and value set for columns of few values.

    One row per draft: column, rule, minimum, maximum, values (comma-separated).
    """
    names = [c for c in (columns or df.columns) if c not in (exclude or [])]
    p = profile(df, names)
    few = p.where(F.col("n_distinct").between(1, max_set)).select(F.col("column").alias("_c"))
    sets = (
        value_counts(df, names).where("value IS NOT NULL").join(F.broadcast(few), F.col("column") == F.col("_c"))
        .groupBy("column").agg(F.array_join(F.array_sort(F.collect_list("value")), ",").alias("values"))
        .withColumnRenamed("column", "_s")
    )

    def draft(rule: str, when, minimum=None, maximum=None, values=None):
        null = F.lit(None)
        return F.when(when, F.struct(
            F.lit(rule).alias("rule"), (null if minimum is None else minimum).cast("double").alias("minimum"),
            (null if maximum is None else maximum).cast("double").alias("maximum"),
            (null if values is None else values).cast("string").alias("values")))

    drafts = F.array(
        draft("not_null", F.col("n_nulls") == 0),
        draft("unique", (F.col("n_nulls") == 0) & (F.col("n_distinct") == F.col("n_rows"))),
        draft("between", F.col("min").isNotNull(), F.col("min"), F.col("max")),
        draft("in_set", F.col("values").isNotNull(), values=F.col("values")),
    )
    joined = p.join(sets, F.col("column") == F.col("_s"), "left")
    return joined.select("column", F.explode(F.array_compact(drafts)).alias("d")).select("column", "d.*")


DISTINCT_BITS, QUANTILE_SIZE = 12, 200


def profile_parts(df: DataFrame, part: str, columns: list[str] | None = None) -> DataFrame:
    """One row per part and column of what can be merged: counts, sums, extremes, and sketches of distinct values and of quantiles.

    A part is a day, a month or a folder; its rows are read once, when it arrives or changes. The sketches have a bounded size: about 4 KB for distinct values
    (a relative standard error of 1.6 %) and a few KB for quantiles (a rank error of about 1.3 %).
    """
    names = [c for c in columns or df.columns if c != part]
    numbers = [c for c in numeric_columns(df) if c in names]

    def measures(c: str) -> Column:
        number = F.col(c).cast("double") if c in numbers else F.lit(None).cast("double")
        text = F.lit(None).cast("string") if c in numbers else F.col(c).cast("string")
        rows = F.count(F.lit(1))
        quantiles = F.kll_sketch_agg_double(number, QUANTILE_SIZE) if c in numbers else F.lit(None).cast("binary")
        return F.struct(
            F.lit(c).alias("column"), rows.alias("n_rows"), (rows - F.count(c)).alias("n_nulls"), F.min(text).alias("min_text"), F.max(text).alias("max_text"),
            F.min(number).alias("min"), F.max(number).alias("max"), F.sum(number).alias("sum"),
            F.hll_sketch_agg(F.col(c).cast("string"), DISTINCT_BITS).alias("distinct"), quantiles.alias("quantiles"),
        )

    return df.groupBy(part).agg(F.array(*[measures(c) for c in names]).alias("m")).select(part, F.inline("m"))


def profile_of_parts(parts: DataFrame) -> DataFrame:
    """One row per column of all parts together: counts, extremes and mean are exact; ``n_distinct`` and the quartiles are estimates."""
    merged = parts.groupBy("column").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"), F.min("min_text").alias("min_text"), F.max("max_text").alias("max_text"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.sum("sum").alias("sum"), F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double(F.when(F.col("min").isNotNull(), F.col("quantiles"))).alias("quantiles"),
    )
    quartiles = F.when(F.col("min").isNotNull(), F.kll_sketch_get_quantile_double("quantiles", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))))
    return merged.select(
        "column", "n_rows", "n_nulls", "min_text", "max_text", "min", "max", (F.col("sum") / F.nullif(F.col("n_rows") - F.col("n_nulls"), F.lit(0))).alias("mean"),
        F.hll_sketch_estimate("distinct").alias("n_distinct"), quartiles.alias("_q"),
    ).withColumns({n: F.col("_q")[k] for k, n in enumerate(["q1", "median", "q3"])}).drop("_q")

"""Data-quality rules over DataFrames and suites of them.

Row rules (a Boolean per row), table rules and schema rules of one table are measured together
in a single aggregation. Grouped rules need their own job. Every rule yields one result row:
rule, column, success, evaluated, failing, percent.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.ordered import before, last_value
from daybook.functions.quantiles import exact_quantiles
from daybook.functions.skew import attach_per_key

RESULT_COLUMNS = ["rule", "column", "success", "evaluated", "failing", "percent"]


@dataclass(frozen=True)
class RowRule:
    """Every row passes or fails; rows where ``skip`` holds are not judged."""

    rule: str
    column: str
    passes: Column
    skip: Column | None = None
    where: Column | None = None
    mostly: float = 1.0

    @property
    def in_scope(self) -> Column:
        scope = F.lit(True) if self.where is None else F.coalesce(self.where, F.lit(False))
        return scope if self.skip is None else scope & ~self.skip

    @property
    def fails(self) -> Column:
        return self.in_scope & ~F.coalesce(self.passes, F.lit(False))


@dataclass(frozen=True)
class TableRule:
    """One aggregate of the whole table decides."""

    rule: str
    column: str
    success: Column


@dataclass(frozen=True)
class SchemaRule:
    """The schema alone decides."""

    rule: str
    column: str
    check: Callable[[DataFrame], bool]


@dataclass(frozen=True)
class GroupRule:
    """``measure`` gives one row (evaluated, failing), ``failing`` the failing rows or groups."""

    rule: str
    column: str
    measure: Callable[[DataFrame], DataFrame]
    failing: Callable[[DataFrame], DataFrame]
    mostly: float = 1.0


Rule = RowRule | TableRule | SchemaRule | GroupRule


# row rules


def not_null(column: str, where: Column | None = None, mostly: float = 1.0) -> RowRule:
    return RowRule("not_null", column, F.col(column).isNotNull(), None, where, mostly)


def _value_rule(rule: str, column: str, passes: Column, where, mostly) -> RowRule:
    return RowRule(rule, column, passes, F.col(column).isNull(), where, mostly)


def in_set(column: str, values: list, where: Column | None = None, mostly: float = 1.0) -> RowRule:
    return _value_rule("in_set", column, F.col(column).isin(values), where, mostly)


def between(
    column: str, minimum=None, maximum=None, strict_min: bool = False, strict_max: bool = False,
    where: Column | None = None, mostly: float = 1.0,
) -> RowRule:
    """Numbers, dates or timestamps within limits; a missing limit is open."""
    c = F.col(column)
    passes = F.lit(True)
    if minimum is not None:
        passes = passes & (c > F.lit(minimum) if strict_min else c >= F.lit(minimum))
    if maximum is not None:
        passes = passes & (c < F.lit(maximum) if strict_max else c <= F.lit(maximum))
    return _value_rule("between", column, passes, where, mostly)


def length_between(column: str, minimum: int | None = None, maximum: int | None = None,
                   where: Column | None = None, mostly: float = 1.0) -> RowRule:
    size = F.length(column)
    passes = F.lit(True)
    if minimum is not None:
        passes = passes & (size >= minimum)
    if maximum is not None:
        passes = passes & (size <= maximum)
    return _value_rule("length_between", column, passes, where, mostly)


def matches_regex(column: str, pattern: str, where: Column | None = None, mostly: float = 1.0) -> RowRule:
    return _value_rule("matches_regex", column, F.col(column).rlike(pattern), where, mostly)


def custom_rule(name: str, columns: list[str], predicate: Callable[..., Column],
                where: Column | None = None, mostly: float = 1.0) -> RowRule:
    """A user's rule: ``predicate`` gets the columns and returns a Boolean column."""
    nulls = F.col(columns[0]).isNull()
    for c in columns[1:]:
        nulls = nulls | F.col(c).isNull()
    return RowRule(name, ",".join(columns), predicate(*[F.col(c) for c in columns]), nulls, where, mostly)


# fixed values: country, dial code, trunk prefix, pattern of the national number
PHONE_PLANS = {
    "NG": ("234", "0", "^(70|80|81|90|91)[0-9]{8}$"),
    "US": ("1", "1", "^[2-9][0-9]{2}[2-9][0-9]{6}$"),
    "GB": ("44", "0", "^(7[1-57-9][0-9]{8}|[12][0-9]{8,9}|3[0-9]{9})$"),
}
PHONE_ALIASES = {"UK": "GB"}


def phone_is_valid(phone: Column, country: Column) -> Column:
    """Valid under the country's numbering plan, with or without dial code or trunk prefix.

    Covers the plans in ``PHONE_PLANS``; other countries and numbers that cannot be read are
    invalid.
    """
    plain = F.regexp_replace(F.trim(phone), r"[\s().-]", "")
    valid = F.lit(False)
    names = {**{c: c for c in PHONE_PLANS}, **PHONE_ALIASES}
    for name, plan in names.items():
        dial, trunk, pattern = PHONE_PLANS[plan]
        national = lambda prefix: F.regexp_replace(plain, f"^{prefix}", "")
        forms = (
            (plain.startswith("+" + dial) & national(r"\+" + dial).rlike(pattern))
            | plain.rlike(pattern)
            | (plain.startswith(dial) & national(dial).rlike(pattern))
            | (plain.startswith(trunk) & national(trunk).rlike(pattern))
        )
        valid = F.when(country == name, forms).otherwise(valid)
    return valid


def valid_phone(column: str, country: str, mostly: float = 1.0) -> RowRule:
    return RowRule("valid_phone", column, phone_is_valid(F.col(column), F.col(country)),
                   F.col(column).isNull(), None, mostly)


# table and schema rules


def row_count_between(minimum: int | None = None, maximum: int | None = None) -> TableRule:
    n = F.count(F.lit(1))
    success = F.lit(True)
    if minimum is not None:
        success = success & (n >= minimum)
    if maximum is not None:
        success = success & (n <= maximum)
    return TableRule("row_count_between", "", success)


def recent_data(column: str, datepart: str, interval: int, as_of: str | date | Column) -> TableRule:
    """The newest value lies at most ``interval`` dateparts (day, week, month, hour) before ``as_of``."""
    if datepart not in ("hour", "day", "week", "month", "year"):
        raise ValueError(f"unknown datepart {datepart}")
    now = as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("timestamp")
    newest = F.max(F.col(column).cast("timestamp"))
    limit = F.timestamp_add(datepart.upper(), F.lit(-interval), now)
    return TableRule("recent_data", column, F.coalesce(newest >= limit, F.lit(False)))


def columns_match_set(names: list[str]) -> SchemaRule:
    return SchemaRule("columns_match_set", "", lambda df: set(df.columns) == set(names))


# fixed values: declared type and the Spark types it admits
TYPE_NAMES = {
    "TEXT": (T.StringType, T.VarcharType, T.CharType),
    "INTEGER": (T.IntegerType, T.LongType, T.ShortType, T.ByteType),
    "FLOAT": (T.DoubleType, T.FloatType, T.DecimalType),
    "BOOLEAN": (T.BooleanType,),
    "TIMESTAMP": (T.TimestampType, T.TimestampNTZType),
    "DATE": (T.DateType,),
}


def column_type(column: str, declared: str) -> SchemaRule:
    kinds = TYPE_NAMES[declared.upper()]

    def check(df: DataFrame) -> bool:
        return column in df.columns and isinstance(df.schema[column].dataType, kinds)

    return SchemaRule("column_type", column, check)


# grouped rules


def unique(columns: str | list[str], where: Column | None = None, mostly: float = 1.0) -> GroupRule:
    """Non-null values occur once. All rows of a repeated value fail."""
    names = [columns] if isinstance(columns, str) else columns

    def counted(df: DataFrame) -> DataFrame:
        rows = df if where is None else df.where(where)
        return rows.dropna(subset=names).groupBy(*names).agg(F.count(F.lit(1)).alias("occurrences"))

    def measure(df: DataFrame) -> DataFrame:
        repeated = F.when(F.col("occurrences") > 1, F.col("occurrences")).otherwise(0)
        return counted(df).agg(F.coalesce(F.sum("occurrences"), F.lit(0)).alias("evaluated"),
                               F.coalesce(F.sum(repeated), F.lit(0)).alias("failing"))

    return GroupRule("unique", ",".join(names), measure, lambda df: counted(df).where("occurrences > 1"), mostly)


def relationships(column: str, parent: DataFrame, field_name: str, mostly: float = 1.0) -> GroupRule:
    """Every non-null value exists in the parent column.

    Values are counted before the join, so a value shared by many rows is joined once.
    """

    def counted(df: DataFrame) -> DataFrame:
        return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("occurrences"))

    def known() -> DataFrame:
        return parent.select(F.col(field_name).alias("_parent")).where("_parent IS NOT NULL").distinct()

    def failing(df: DataFrame) -> DataFrame:
        return counted(df).join(known(), F.col(column) == F.col("_parent"), "left_anti")

    def measure(df: DataFrame) -> DataFrame:
        joined = counted(df).join(known(), F.col(column) == F.col("_parent"), "left")
        missing = F.when(F.col("_parent").isNull(), F.col("occurrences")).otherwise(0)
        return joined.agg(F.coalesce(F.sum("occurrences"), F.lit(0)).alias("evaluated"),
                          F.coalesce(F.sum(missing), F.lit(0)).alias("failing"))

    return GroupRule("relationships", column, measure, failing, mostly)


def distinct_values_in_set(column: str, values: list, where: Column | None = None) -> GroupRule:
    """No distinct value (of the rows in ``where``) lies outside the set."""

    def distinct(df: DataFrame) -> DataFrame:
        rows = df if where is None else df.where(where)
        return rows.select(column).where(F.col(column).isNotNull()).distinct()

    def measure(df: DataFrame) -> DataFrame:
        return distinct(df).agg(F.count(F.lit(1)).alias("evaluated"),
                                F.count(F.when(~F.col(column).isin(values), 1)).alias("failing"))

    return GroupRule("distinct_values_in_set", column, measure, lambda df: distinct(df).where(~F.col(column).isin(values)))


def _rows_rule(rule: str, column: str, evaluated: Column, failing: Callable[[DataFrame], DataFrame],
               mostly: float = 1.0, base: Callable[[DataFrame], DataFrame] | None = None) -> GroupRule:
    def measure(df: DataFrame) -> DataFrame:
        total = (base(df) if base else df).agg(F.count(F.when(evaluated, 1)).alias("evaluated"))
        failed = failing(df).agg(F.count(F.lit(1)).alias("n"))
        return total.withColumn("failing", failed.scalar())

    return GroupRule(rule, column, measure, failing, mostly)


def within_historical_range(column: str, history: DataFrame, history_column: str, deviations: float = 3) -> GroupRule:
    """Values within mean +- ``deviations`` sample sd of another table."""
    mean, sd = F.avg(history_column), F.stddev_samp(history_column)
    limits = history.agg(F.struct((mean - sd * deviations).alias("lower"), (mean + sd * deviations).alias("upper")))

    def failing(df: DataFrame) -> DataFrame:
        bounded = df.withColumn("_limits", limits.scalar()).withColumns(
            {"lower_bound": F.col("_limits.lower"), "upper_bound": F.col("_limits.upper")}
        ).drop("_limits")
        return bounded.where((F.col(column) > F.col("upper_bound")) | (F.col(column) < F.col("lower_bound")))

    return _rows_rule("within_historical_range", column, F.col(column).isNotNull(), failing)


def _listed(order: str | list[str]) -> list[str]:
    return [order] if isinstance(order, str) else list(order)


def reasonable_movement(column: str, order: str | list[str], partition_by: list[str] | None = None, max_pct: float = 20) -> GroupRule:
    """Change against the row before of at most ``max_pct`` percent.

    ``partition_by`` names the series; without it the table is one series. A series has one row per ``order`` value.
    """

    def failing(df: DataFrame) -> DataFrame:
        change = F.abs(F.col(column) - F.col("previous_value")) / F.nullif(F.col("previous_value"), F.lit(0.0)) * 100
        moved = before(df, partition_by, _listed(order), 1, {"previous_value": last_value(column)})
        return moved.withColumn("change_pct", change).where(F.col("change_pct") > max_pct)

    return _rows_rule("reasonable_movement", column, F.col(column).isNotNull(), failing)


def balanced(buy: Column | str, sell: Column | str, day: str, tolerance_pct: float = 1) -> GroupRule:
    """Sums of both sides per day differ by at most ``tolerance_pct`` percent of the buy side."""
    b = F.col(buy) if isinstance(buy, str) else buy
    s = F.col(sell) if isinstance(sell, str) else sell

    def per_day(df: DataFrame) -> DataFrame:
        sums = df.groupBy(day).agg(F.sum(b).alias("total_buy"), F.sum(s).alias("total_sell"))
        gap = F.abs(F.col("total_buy") - F.col("total_sell")) / F.nullif(F.col("total_buy"), F.lit(0.0)) * 100
        return sums.withColumn("imbalance_pct", gap)

    return _rows_rule("balanced", day, F.lit(True), lambda df: per_day(df).where(F.col("imbalance_pct") > tolerance_pct),
                      base=per_day)


def balanced_daily_volumes(buy: str, sell: str, day: str, side: str, buy_type: str = "BUY", sell_type: str = "SELL",
                           tolerance: float = 0.1) -> GroupRule:
    """Buy and sell volumes per day, told apart by ``side``, differ by at most ``tolerance`` of the greater."""

    def per_day(df: DataFrame) -> DataFrame:
        sums = df.groupBy(day).agg(
            F.sum(F.when(F.col(side) == buy_type, F.col(buy)).otherwise(0.0)).alias("buy_volume"),
            F.sum(F.when(F.col(side) == sell_type, F.col(sell)).otherwise(0.0)).alias("sell_volume"),
        )
        greater = F.nullif(F.greatest("buy_volume", "sell_volume"), F.lit(0.0))
        return sums.withColumn("gap", F.abs(F.col("buy_volume") - F.col("sell_volume")) / greater)

    return _rows_rule("balanced_daily_volumes", day, F.lit(True), lambda df: per_day(df).where(F.col("gap") > tolerance),
                      base=per_day)


def no_duplicates(id_column: str, ts_column: str) -> GroupRule:
    """No (id, time) pair occurs more than once (nulls are equal to each other)."""

    def counted(df: DataFrame) -> DataFrame:
        return df.groupBy(id_column, ts_column).agg(F.count(F.lit(1)).alias("occurrence_count"))

    failing = lambda df: counted(df).where("occurrence_count > 1")
    return _rows_rule("no_duplicates", f"{id_column},{ts_column}", F.lit(True), failing, base=counted)


def suspicious_volume(column: str, order: str | list[str], partition_by: list[str] | None = None, window: int = 30) -> GroupRule:
    """Values at most mean + 3 sd of the ``window`` rows before them in their series; without ``partition_by`` the table is one series."""

    def failing(df: DataFrame) -> DataFrame:
        stats = {"avg_volume": lambda w: F.avg(column).over(w), "vol_std": lambda w: F.stddev_samp(column).over(w)}
        compared = before(df, partition_by, _listed(order), window, stats)
        return compared.where(F.col(column) > F.col("avg_volume") + F.col("vol_std") * 3)

    return _rows_rule("suspicious_volume", column, F.col(column).isNotNull(), failing)


def _fences(bounds: DataFrame) -> DataFrame:
    q1, q3 = F.element_at("quantiles", 1), F.element_at("quantiles", 2)
    return bounds.withColumns({"lower": q1 - (q3 - q1) * 1.5, "upper": q3 + (q3 - q1) * 1.5}).drop("quantiles")


def _outside(column: str) -> Column:
    inside = (F.col(column) > F.col("lower")) & (F.col(column) < F.col("upper"))
    return F.col(column).isNotNull() & ~F.coalesce(inside, F.lit(False))


def within_quartile_limits(column: str, mostly: float = 1.0) -> GroupRule:
    """Strictly inside Q1 - 1.5 IQR and Q3 + 1.5 IQR of the column."""

    def failing(df: DataFrame) -> DataFrame:
        fences = _fences(exact_quantiles(df, [], column, [0.25, 0.75]))
        limits = fences.select(F.struct("lower", "upper")).scalar()
        fenced = df.withColumn("_limits", limits).withColumns({"lower": F.col("_limits.lower"), "upper": F.col("_limits.upper")})
        return fenced.drop("_limits").where(_outside(column))

    return _rows_rule("within_quartile_limits", column, F.col(column).isNotNull(), failing, mostly)


def within_quartile_limits_by(column: str, category: str, mostly: float = 1.0) -> GroupRule:
    """Strictly inside the quartile limits of the row's category."""

    def failing(df: DataFrame) -> DataFrame:
        rows = df.where(F.col(column).isNotNull())
        fences = _fences(exact_quantiles(rows, [category], column, [0.25, 0.75]))
        return attach_per_key(rows, fences, [category]).where(_outside(column))

    return _rows_rule("within_quartile_limits_by", column, F.col(column).isNotNull(), failing, mostly)


# running rules


def _result(rule: Rule, success: Column, evaluated: Column, failing: Column) -> Column:
    percent = F.round(F.when(evaluated > 0, failing / evaluated * 100).otherwise(0.0), 4)
    return F.struct(
        F.lit(rule.rule).alias("rule"), F.lit(rule.column).alias("column"), success.alias("success"),
        evaluated.cast("long").alias("evaluated"), failing.cast("long").alias("failing"),
        percent.cast("double").alias("percent"),
    )


def _enough(evaluated: Column, failing: Column, mostly: float) -> Column:
    return (evaluated - failing) >= evaluated * mostly - 1e-9


def _one_pass(df: DataFrame, rules: list[RowRule | TableRule | SchemaRule]) -> DataFrame:
    measures, results = [F.count(F.lit(1)).alias("_n")], []
    for i, rule in enumerate(rules):
        if isinstance(rule, RowRule):
            measures += [F.count(F.when(rule.in_scope, 1)).alias(f"_e{i}"), F.count(F.when(rule.fails, 1)).alias(f"_f{i}")]
            evaluated, failing = F.col(f"_e{i}"), F.col(f"_f{i}")
            results.append(_result(rule, _enough(evaluated, failing, rule.mostly), evaluated, failing))
        elif isinstance(rule, TableRule):
            measures.append(rule.success.alias(f"_s{i}"))
            results.append(_result(rule, F.col(f"_s{i}"), F.col("_n"), F.when(F.col(f"_s{i}"), 0).otherwise(1)))
        else:
            good = rule.check(df)
            results.append(_result(rule, F.lit(good), F.lit(1), F.lit(0 if good else 1)))
    return df.agg(*measures).select(F.inline(F.array(*results)))


def run_suite(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One result row per rule. All row, table and schema rules share one pass over the data."""
    together = [r for r in rules if not isinstance(r, GroupRule)]
    parts = [_one_pass(df, together)] if together else []
    for rule in rules:
        if isinstance(rule, GroupRule):
            e, f = F.col("evaluated"), F.col("failing")
            one = rule.measure(df).select(_result(rule, _enough(e, f, rule.mostly), e, f).alias("r"))
            parts.append(one.select("r.*"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def failing_rows(df: DataFrame, rule: RowRule | GroupRule) -> DataFrame:
    """The rows (or groups) that break the rule."""
    return df.where(rule.fails) if isinstance(rule, RowRule) else rule.failing(df)


def relaxed(rule: RowRule | GroupRule, mostly: float) -> RowRule | GroupRule:
    """The same rule, passed when at least the share ``mostly`` of values passes."""
    return replace(rule, mostly=mostly)


@dataclass(frozen=True)
class Run:
    """Describes one run of a suite."""

    data_asset: str
    suite: str
    run_time: str
    schema_name: str = "public"
    regex_columns: list[str] = field(default_factory=lambda: ["first_name", "last_name", "email"])


def suite_summary(results: DataFrame, run: Run) -> DataFrame:
    """One row per run: success percent, counts, and counts by kind of rule."""
    ok = F.col("success")

    def counts(name: str, condition: Column) -> list[Column]:
        return [F.count(F.when(condition, 1)).alias(f"expectation_{name}"),
                F.count(F.when(condition & ok, 1)).alias(f"expectation_{name}_true")]

    kinds = [*counts("not_null", F.col("rule") == "not_null"), *counts("unique", F.col("rule") == "unique")]
    for c in run.regex_columns:
        kinds += counts(c, (F.col("rule") == "matches_regex") & (F.col("column") == c))
    good, total = F.count(F.when(ok, 1)), F.count(F.lit(1))
    return results.agg(
        F.first(F.lit(run.run_time).cast("timestamp")).alias("created"), F.first(F.lit(run.data_asset)).alias("data_asset_name"),
        F.first(F.lit(run.data_asset)).alias("table_name"), F.first(F.lit(run.schema_name)).alias("schema_name"),
        F.first(F.lit(run.suite)).alias("expectation_suite_name"),
        F.first(F.date_format(F.lit(run.run_time).cast("timestamp"), "yyyy-MM-dd:HH:mm:ss")).alias("run_time"),
        F.round(good / total * 100, 3).alias("success_percent"),
        total.alias("evaluated_expectations"), good.alias("successful_expectations"),
        (total - good).alias("unsuccessful_expectations"), (total == good).alias("success"), *kinds,
    )


def store_run(results: DataFrame, run: Run, history_path: str, json_path: str | None = None) -> None:
    """Append the summary to the history table and keep a JSON copy of the results."""
    suite_summary(results, run).write.mode("append").parquet(history_path)
    if json_path:
        results.write.mode("overwrite").json(json_path)



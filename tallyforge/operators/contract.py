"""Declarative data contracts.

A contract compiles to plain columns: one projection casts the fields, one boolean finds bad
rows and one array holds their failures, so all rules share a single scan without shuffles.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tallyforge.functions.columns import quoted, ratio

CHECKS: dict[str, Callable[..., Column]] = {}
ROW_CHECKS: dict[str, Callable[..., Column]] = {}
GROUP_CHECKS: dict[str, Callable[..., Column]] = {}
CONTRACTS: dict[str, "Contract"] = {}
FAILURE_HEAD = 100


def register_check(name: str):
    """Make a field check `fn(col, **params) -> Column` available to contracts by name."""
    def keep(fn):
        CHECKS[name] = fn
        return fn
    return keep


def register_group_check(name: str):
    """Make a check of the whole table, `fn(**params) -> aggregate Column`, available by name."""
    def keep(fn):
        GROUP_CHECKS[name] = fn
        return fn
    return keep


def register_contract(contract: "Contract") -> "Contract":
    """Make a contract available under its name."""
    CONTRACTS[contract.name] = contract
    return contract


def contract_named(name: str) -> "Contract":
    if name not in CONTRACTS:
        raise ValueError(f"unknown contract {name!r}, registered are {sorted(CONTRACTS)}")
    return CONTRACTS[name]


def register_row_check(name: str):
    """Make a check over several columns, `fn(**params) -> Column`, available by name."""
    def keep(fn):
        ROW_CHECKS[name] = fn
        return fn
    return keep


@register_check("in_range")
def in_range(col: Column, min_val: Any = 0.0, max_val: Any = 1e9) -> Column:
    return col.between(min_val, max_val)


@register_check("length_between")
def length_between(col: Column, min_len: int = 1, max_len: int = 255) -> Column:
    return F.length(col.cast("string")).between(min_len, max_len)


@register_check("isin")
def isin(col: Column, values: Sequence[Any] = ()) -> Column:
    return col.isin(list(values))


@register_check("matches")
def matches(col: Column, pattern: str = "") -> Column:
    """The text form matches from its start."""
    return col.cast("string").rlike(f"^(?:{pattern})")


@register_check("at_most")
def at_most(col: Column, threshold: float = 0.0) -> Column:
    return col <= threshold


@register_row_check("sum_at_most")
def sum_at_most(components: Sequence[str] = (), total: str | float = "") -> Column:
    """Sum of the components, nulls as 0, does not exceed a column or a number."""
    value = F.lit(0.0)
    for c in components:
        value = value + F.coalesce(F.col(quoted(c)), F.lit(0.0))
    return value <= (F.col(quoted(total)) if isinstance(total, str) else F.lit(total))


@register_row_check("ordered_triple")
def ordered_triple(low: str = "", target: str = "", high: str = "") -> Column:
    return (F.col(quoted(low)) <= F.col(quoted(target))) & (F.col(quoted(target)) <= F.col(quoted(high)))


@dataclass(frozen=True)
class Check:
    """A named check with parameters; severity `warn` is reported but never makes a row invalid."""
    kind: str
    params: dict[str, Any] = field(default_factory=dict)
    severity: str = "error"
    message: str = ""
    target: str = ""  # the column that failures are listed under

    @property
    def label(self) -> str:
        return self.message or self.kind


@dataclass(frozen=True)
class Field:
    """A typed column. With `regex` the name is a pattern that may stand for several columns."""
    name: str
    dtype: str
    checks: tuple[Check, ...] = ()
    nullable: bool = False
    required: bool = True
    regex: bool = False

    def matching(self, columns: list[str]) -> list[str]:
        return [c for c in columns if (re.match(self.name, c) if self.regex else c == self.name)]


@dataclass(frozen=True)
class GroupMean:
    """Mean of `target` in one group stays under its mean in another; an absent group gives 0 or +infinity."""
    by: str
    target: str
    lower: Any
    higher: Any
    message: str = "group_mean"

    def holds(self) -> Column:
        low = F.coalesce(F.avg(F.when(F.col(quoted(self.by)) == self.lower, F.col(quoted(self.target)))), F.lit(0.0))
        high = F.coalesce(F.avg(F.when(F.col(quoted(self.by)) == self.higher, F.col(quoted(self.target)))),
                          F.lit(float("inf")))
        return low < high


@dataclass(frozen=True)
class GroupCheck:
    """A registered check over the whole table: its function gives one aggregate that is true if the table keeps it."""
    name: str
    params: Mapping[str, Any] = field(default_factory=dict)
    message: str = ""
    target: str = ""  # the column that failures are listed under

    def __post_init__(self) -> None:
        if self.name not in GROUP_CHECKS:
            raise ValueError(f"unknown group check {self.name!r}")
        object.__setattr__(self, "message", self.message or self.name)

    def holds(self) -> Column:
        return F.coalesce(GROUP_CHECKS[self.name](**self.params), F.lit(False))


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    row_checks: tuple[Check, ...] = ()
    group_checks: tuple[GroupMean | GroupCheck, ...] = ()
    coerce: bool = True
    strict: bool = False
    ordered: bool = False
    unique_names: bool = True
    add_missing: bool = False
    coercion_scope: str = "row"  # "table": a failed cast cannot be pinned on rows and spoils all of them

    def extend(self, name: str, *fields: Field, **changes: Any) -> "Contract":
        return replace(self, name=name, fields=self.fields + fields, **changes)

    # --- structure ---------------------------------------------------------------------

    def structure_failures(self, columns: list[str]) -> list[tuple[str, str]]:
        """(column, rule) for every break of the table shape; decided from the schema alone."""
        out = []
        known: list[str] = []
        for f in self.fields:
            hit = f.matching(columns)
            known += hit
            if not hit and f.required and not (self.add_missing and f.nullable):
                out.append((f.name, "column_required"))
        if self.unique_names:
            out += [(c, "column_unique") for c in dict.fromkeys(columns) if columns.count(c) > 1]
        if self.strict:
            out += [(c, "column_not_in_contract") for c in columns if c not in known]
        if self.ordered:
            want = [f.name for f in self.fields if f.name in columns]
            if want != [c for c in columns if c in want]:
                out.append((",".join(want), "column_order"))
        return out

    # --- rows ----------------------------------------------------------------------------

    def _typed(self, df: DataFrame) -> tuple[DataFrame, dict[str, tuple[Field, str]]]:
        """Cast the contract columns; the raw column stays as `__raw<i>` where its type changes."""
        types = dict(df.dtypes)
        at: dict[str, tuple[Field, str]] = {}
        cols, raws = {}, {}
        for f in self.fields:
            for name in f.matching(df.columns):
                raw = F.col(quoted(name))
                if self.coerce and types[name] != f.dtype:
                    raws[f"__raw{len(at)}"] = raw
                    cols[name] = raw.try_cast(f.dtype)
                    at[name] = (f, f"__raw{len(at)}")
                else:
                    cols[name] = raw
                    at[name] = (f, name)
                if f.dtype in ("double", "float"):
                    cols[name] = F.when(~F.isnan(cols[name]), cols[name])
        missing = [f for f in self.fields if self.add_missing and f.nullable and not f.matching(df.columns)]
        out = df.select(*[cols.get(c, F.col(quoted(c))).alias(c) for c in df.columns],
                        *[F.lit(None).cast(f.dtype).alias(f.name) for f in missing],
                        *[raw.alias(n) for n, raw in raws.items()])
        return out, at

    def _rules(self, at: dict[str, tuple[Field, str]], columns: list[str]) -> list[tuple[str, str, str, Column, Column]]:
        """(column, rule, severity, fails, value) in contract order; null passes all but the null rule."""
        rules = []
        for name, (f, raw) in at.items():
            col, was = F.col(quoted(name)), F.col(quoted(raw))
            if raw != name:
                rules.append((name, f"coerce_{f.dtype}", "error", was.isNotNull() & col.isNull(), was))
            if not f.nullable:
                rules.append((name, "not_nullable", "error", was.isNull() if raw != name else col.isNull(), col))
            for c in f.checks:
                rules.append((name, c.label, c.severity, ~F.coalesce(CHECKS[c.kind](col, **c.params), F.lit(True)), col))
        for c in self.row_checks:
            used = [v for p in c.params.values() for v in ([p] if isinstance(p, str) else p if isinstance(p, (list, tuple)) else [])]
            if all(u in columns for u in used):
                rules.append((",".join(used), c.label, c.severity,
                              ~F.coalesce(ROW_CHECKS[c.kind](**c.params), F.lit(True)), F.lit(None)))
        return rules

    def annotate(self, df: DataFrame, depth: str = "both") -> DataFrame:
        """Coerced rows with `_failures`, an array of (rule_id, column, check_rule, severity, failure_value)."""
        typed, at = self._typed(df)
        keep = [c for c in typed.columns if not c.startswith("__raw")]
        rules = self._rules(at, typed.columns) if depth != "schema_only" else []
        items, any_fails = [], F.lit(False)
        for i, (column, check, severity, fails, value) in enumerate(rules):
            any_fails = any_fails | fails
            items.append(F.when(fails, F.struct(
                F.lit(i).alias("rule_id"), F.lit(column).alias("column"), F.lit(check).alias("check_rule"),
                F.lit(severity).alias("severity"), value.cast("string").alias("failure_value"))))
        empty = F.from_json(F.lit("[]"), "array<struct<rule_id:int,column:string,check_rule:string,"
                                         "severity:string,failure_value:string>>")
        failures = F.when(any_fails, F.array_compact(F.array(*items))).otherwise(empty) if items else empty
        return typed.select(*[F.col(quoted(c)) for c in keep], failures.alias("_failures"))

    def _bad_row(self) -> Column:
        return F.exists("_failures", lambda f: f["severity"] == "error")

    def failures(self, df: DataFrame, depth: str = "both", carry: Sequence[str] = ()) -> DataFrame:
        """Every failing cell: rule_id, column, check_rule, severity, failure_value, the key and carried columns.

        Shape and group failures come first, with negative ids and a null key.
        """
        if depth not in ("schema_only", "data_only"):
            depth = "both"
        extra = [*self.key, *carry]
        typed = [n for n in extra if n in df.columns]
        annotated = self.annotate(df, depth)
        rows = (annotated.where(F.size("_failures") > 0)
                .select(*[F.col(quoted(k)) for k in typed], F.inline("_failures")))
        out = rows.select("rule_id", "column", "check_rule", "severity", "failure_value", *typed)
        nulls = [F.lit(None).cast(annotated.schema[k].dataType).alias(k) for k in typed]
        if depth != "data_only":
            found = self.structure_failures(df.columns)
            if found:
                cells = F.array(*[F.struct(F.lit(-1000 + i).alias("rule_id"), F.lit(c).alias("column"),
                                           F.lit(r).alias("check_rule")) for i, (c, r) in enumerate(found)])
                shape = df.sparkSession.range(1).select(F.inline(cells)).select(
                    "*", F.lit("error").alias("severity"), F.lit(None).cast("string").alias("failure_value"), *nulls)
                out = shape.unionByName(out)
        if depth != "schema_only" and self.group_checks:
            one = annotated.agg(*[g.holds().alias(f"g{i}") for i, g in enumerate(self.group_checks)])
            cells = F.array(*[F.struct(F.lit(-100 + i).alias("rule_id"), F.lit(g.target).alias("column"),
                                       F.lit(g.message).alias("check_rule"), F.col(f"g{i}").alias("ok"))
                              for i, g in enumerate(self.group_checks)])
            groups = one.select(F.inline(cells)).where(~F.col("ok")).select(
                "rule_id", "column", "check_rule", F.lit("error").alias("severity"),
                F.lit(None).cast("string").alias("failure_value"), *nulls)
            out = groups.unionByName(out)
        return out

    def first_failure(self, df: DataFrame) -> DataFrame:
        """The failure an eager check would stop at: lowest rule, then lowest key."""
        return self.failures(df).where(F.col("severity") == "error").orderBy("rule_id", *self.key).limit(1)

    def failure_head(self, df: DataFrame, split: str, n: int = FAILURE_HEAD) -> DataFrame:
        """The first `n` failures of each split, for reports."""
        order = Window.partitionBy(split).orderBy("rule_id", *self.key)
        return (self.failures(df, carry=[split]).withColumn("position", F.row_number().over(order))
                .where(F.col("position") <= n))

    def drop_invalid(self, df: DataFrame) -> DataFrame:
        """Coerced rows without an error."""
        return self.annotate(df).where(~self._bad_row()).drop("_failures")

    def invalid(self, df: DataFrame) -> DataFrame:
        return self.annotate(df).where(self._bad_row())

    # --- table verdicts --------------------------------------------------------------------

    def summary(self, df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        """Rows, failing cells, bad rows and error rate, over the table or per group of `by`.

        A failure that no row can be blamed for (table shape, group means, table-scoped
        coercion) makes all rows bad.
        """
        shape = len(self.structure_failures(df.columns))
        errors = F.filter("_failures", lambda f: f["severity"] == "error")
        loose = F.lit(shape).cast("long")
        for g in self.group_checks:
            loose = loose + F.when(g.holds(), 0).otherwise(1)
        if self.coercion_scope == "table":
            loose = loose + F.coalesce(F.sum(F.size(F.filter(
                "_failures", lambda f: f["check_rule"].startswith("coerce_")))), F.lit(0))
        grouped = self.annotate(df).groupBy(*by)
        total = grouped.agg(
            F.count(F.lit(1)).alias("total_records"),
            F.coalesce(F.sum(F.size(errors)), F.lit(0)).alias("cell_failures"),
            F.count_if(F.size(errors) > 0).alias("bad_rows"), loose.alias("unknown_index_error_count"))
        bad = F.when(F.col("unknown_index_error_count") > 0, F.col("total_records")).otherwise(F.col("bad_rows"))
        return total.select(
            *by, "total_records",
            (F.col("cell_failures") + F.col("unknown_index_error_count")).alias("failure_count"),
            "unknown_index_error_count", bad.alias("invalid_record_count"),
            F.coalesce(ratio(bad, F.col("total_records")), F.lit(0.0)).alias("error_rate"))

    def split_gate(self, df: DataFrame, split: str = "split") -> DataFrame:
        """Per split: records, failures, PASSED or FAILED, and the verdict over all splits."""
        per = self.summary(df, [split])
        status = F.when(F.col("failure_count") > 0, "FAILED").otherwise("PASSED")
        overall = F.when(F.max("failure_count").over(Window.partitionBy()) > 0, "FAILED").otherwise("PASSED")
        return per.select(split, "total_records", F.col("failure_count").alias("error_count"),
                          status.alias("status"), overall.alias("overall_status"))

    def route(self, df: DataFrame, limit: float, valid_path: str, quarantine_path: str) -> Row:
        """Write the valid rows, or quarantine the whole input and fail when the error rate exceeds `limit`."""
        report = self.summary(df).first()
        if report["error_rate"] > limit:
            df.write.mode("overwrite").parquet(quarantine_path)
            raise ContractError(self.name, report)
        if report["invalid_record_count"] and report["unknown_index_error_count"]:
            raise ContractError(self.name, report)
        self.drop_invalid(df).write.mode("overwrite").parquet(valid_path)
        return report


class ContractError(ValueError):
    def __init__(self, contract: str, report: Row) -> None:
        super().__init__(f"contract {contract!r}: error rate {report['error_rate']:.4%}, "
                         f"{report['invalid_record_count']} of {report['total_records']} rows")
        self.report = report


def policy_tier(rate: Column, drop_under: float = 0.01, stop_over: float = 0.05) -> Column:
    """drop (few errors), quarantine (some) or stop (too many)."""
    return F.when(rate < drop_under, "drop").when(rate <= stop_over, "quarantine").otherwise("stop")


def contract_from_rules(name: str, rules: Sequence[Row], key: Sequence[str], target: str | None = None,
                        with_target: bool = True) -> Contract:
    """Contract from the rows of `profile.infer_contract`; the target is left out for scoring inputs."""
    fields = []
    for r in rules:
        if r["column"] == target and not with_target:
            continue
        checks = []
        if r["min_value"] is not None:
            checks.append(Check("in_range", {"min_val": r["min_value"], "max_val": r["max_value"]}))
        if r["allowed_values"] is not None:
            checks.append(Check("isin", {"values": json.loads(r["allowed_values"])}))
        fields.append(Field(r["column"], r["dtype"], tuple(checks), nullable=r["nullable"]))
    return Contract(name, tuple(fields), tuple(key), strict=True)


# The ranges and categories of the workout measurements.
WORKOUT_INPUT = Contract(
    "workout_input",
    (
        Field("User_ID", "bigint", (Check("in_range", {"min_val": 1, "max_val": 2**63 - 1}),)),
        Field("Gender", "string", (Check("isin", {"values": ["male", "female", "other"]}),
                                   Check("length_between", {"min_len": 1, "max_len": 10}))),
        Field("Age", "bigint", (Check("in_range", {"min_val": 0, "max_val": 200}),)),
        Field("Height", "double", (Check("in_range", {"min_val": 40.0, "max_val": 255.0}),)),
        Field("Weight", "double", (Check("in_range", {"min_val": 2.0, "max_val": 300.0}),)),
        Field("Duration", "double", (Check("in_range", {"min_val": 0.0, "max_val": 300.0}),)),
        Field("Heart_Rate", "double", (Check("in_range", {"min_val": 40.0, "max_val": 220.0}),)),
        Field("Body_Temp", "double", (Check("in_range", {"min_val": 35.0, "max_val": 42.5}),)),
    ),
    key=("User_ID",), strict=True)
WORKOUT_TRAINING = WORKOUT_INPUT.extend(
    "workout_training", Field("Calories", "double", (Check("in_range", {"min_val": 1.0, "max_val": 5000.0}),)))
register_contract(WORKOUT_INPUT)
register_contract(WORKOUT_TRAINING)

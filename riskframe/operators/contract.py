"""Dataset checks in one aggregate, row-level violations, and the overall verdict."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.config import TRAINING_CONTRACT, ColumnRule, Contract
from riskframe.functions.columns import array, double, num, q, struct, text
from riskframe.operators.quality import quality

CHECK_SCHEMA = ("check_name string, column_name string, passed boolean, severity string, "
                "violations bigint, observed double")


class ContractViolation(ValueError):
    """Raised by the pipeline gate when the verdict is negative."""


def _type_ok(rule: ColumnRule, dtype: T.DataType) -> bool:
    wanted = T.IntegralType if rule.kind == "int" else T.NumericType
    return isinstance(dtype, wanted)


def schema_checks(df: DataFrame, contract: Contract = TRAINING_CONTRACT, key: str | None = None) -> DataFrame:
    """Presence, unexpected columns and types: read from the schema, no job."""
    present = {f.name: f.dataType for f in df.schema.fields}
    rows = []
    for rule in contract.rules:
        there = rule.column in present
        rows.append(("present", rule.column, there, "error", int(not there), None))
    for name in present:
        if name not in contract.columns and name != key:
            rows.append(("unexpected", name, False, "warn", 1, None))
    for rule in contract.rules:
        if rule.column in present:
            ok = _type_ok(rule, present[rule.column])
            rows.append(("type", rule.column, ok, "error", int(not ok), None))
    return df.sparkSession.createDataFrame(rows, CHECK_SCHEMA)


def range_checks(df: DataFrame, contract: Contract = TRAINING_CONTRACT) -> DataFrame:
    """Minimum, maximum and allowed values of every column from a single pass.

    Missing values do not break a bound, but they are outside any allowed set.
    """
    cells = []

    def cell(check: str, column: str, violated: str, observed: str) -> None:
        bad = f"count_if({violated})"
        cells.append(struct(check_name=text(check), column_name=text(column), passed=f"{bad} = 0",
                            severity="'error'", violations=bad, observed=f"CAST({observed} AS DOUBLE)"))

    for rule in contract.rules:
        if rule.column not in df.columns:
            continue
        c = q(rule.column)
        if rule.minimum is not None:
            cell("min", rule.column, f"{c} < {num(rule.minimum)}", f"min({c})")
        if rule.maximum is not None:
            cell("max", rule.column, f"{c} > {num(rule.maximum)}", f"max({c})")
        if rule.allowed is not None:
            cell("allowed", rule.column, not_allowed(rule), "NULL")
    one_row = df.agg(*[F.expr(c).alias(f"c{i}") for i, c in enumerate(cells)])
    return one_row.selectExpr(f"inline({array([f'c{i}' for i in range(len(cells))])})")


def not_allowed(rule: ColumnRule) -> str:
    """True for a value outside the allowed set, and for a missing one."""
    return f"NOT coalesce({q(rule.column)} IN ({', '.join(map(num, rule.allowed))}), false)"


def dataset_checks(df: DataFrame, contract: Contract = TRAINING_CONTRACT, key: str | None = None) -> DataFrame:
    return schema_checks(df, contract, key).unionByName(range_checks(df, contract))


def invalid_values(df: DataFrame, contract: Contract = TRAINING_CONTRACT) -> DataFrame:
    """Every value outside its allowed set with its count (a missing value counts as one)."""
    rules = [r for r in contract.rules if r.allowed is not None and r.column in df.columns]
    cells = array([
        f"CASE WHEN {not_allowed(r)} THEN {struct(column_name=text(r.column), value=double(r.column))} END"
        for r in rules])
    return (df.selectExpr(f"inline(array_compact({cells}))")
            .groupBy("column_name", "value").agg(F.count("*").alias("n")))


def quality_checks(q_table: DataFrame, contract: Contract = TRAINING_CONTRACT) -> DataFrame:
    """Missing and duplicate percentages of a quality row as two more rows of the check table."""
    rows = array([
        struct(check_name=text(name), column_name="CAST(NULL AS STRING)", passed=f"{pct} <= {num(float(limit))}",
               severity="'error'", violations=n, observed=pct)
        for name, pct, limit, n in (
            ("missing", "missing_percentage", contract.max_missing_pct, "missing_count"),
            ("duplicate", "duplicate_percentage", contract.max_duplicate_pct, "duplicate_count"),
        )
    ])
    return q_table.selectExpr(f"inline({rows})")


def all_checks(df: DataFrame, contract: Contract = TRAINING_CONTRACT, key: str | None = None) -> DataFrame:
    q_table = quality(df, [c for c in df.columns if c != key])
    return dataset_checks(df, contract, key).unionByName(quality_checks(q_table, contract))


def verdict(checks: DataFrame) -> DataFrame:
    """One row: the overall status, the three group results and the two percentages."""
    failed = "NOT passed AND severity = 'error'"

    def group(*names: str) -> str:
        listed = ", ".join(map(text, names))
        return f"CASE WHEN count_if({failed} AND check_name IN ({listed})) = 0 THEN 'Passed' ELSE 'Failed' END"

    def observed(name: str) -> str:
        return f"coalesce(max(CASE WHEN check_name = {text(name)} THEN observed END), 0D)"

    overall = f"CASE WHEN count_if({failed}) = 0 THEN 'Validation Passed' ELSE 'Validation Failed' END"
    return checks.agg(
        F.expr(overall).alias("validation_status"),
        F.expr(group("present")).alias("column_validation"),
        F.expr(group("type")).alias("type_validation"),
        F.expr(group("min", "max", "allowed")).alias("range_validation"),
        F.expr(observed("missing")).alias("missing_percentage"),
        F.expr(observed("duplicate")).alias("duplicate_percentage"),
    )


def status_lines(one_verdict: DataFrame) -> DataFrame:
    """The verdict as the six text lines of a status report."""
    # The wording of the report.
    lines = array([
        "concat('Validation Status: ', validation_status)",
        "concat('Column Validation: ', column_validation)",
        "concat('Type Validation: ', type_validation)",
        "concat('Range Validation: ', range_validation)",
        "format_string('Missing Percentage: %.2f%%', missing_percentage)",
        "format_string('Duplicate Percentage: %.2f%%', duplicate_percentage)",
    ])
    return one_verdict.selectExpr(f"posexplode({lines}) AS (line_no, line)")


def gate(one_verdict: DataFrame) -> None:
    status = one_verdict.first()["validation_status"]
    if status != "Validation Passed":
        raise ContractViolation(status)


def _row_rule_checks(rule: ColumnRule) -> list[tuple[str, str]]:
    c = q(rule.column)
    out = [("type", f"{c} IS NULL")]
    if rule.minimum is not None:
        out.append(("min", f"{c} < {num(rule.minimum)}"))
    if rule.maximum is not None:
        out.append(("max", f"{c} > {num(rule.maximum)}"))
    if rule.allowed is not None:
        out.append(("allowed", f"{c} NOT IN ({', '.join(map(num, rule.allowed))})"))
    return out


def violations_column(df: DataFrame, contract: Contract) -> str:
    """All broken rules of a row as ``COLUMN:rule``, in contract order.

    A missing value, or a cell that did not parse as the declared type, breaks ``type`` and
    no other rule of its column.
    """
    names = []
    for rule in contract.rules:
        if rule.column not in df.columns:
            names.append(text(f"{rule.column}:present"))
            continue
        names += [f"CASE WHEN {bad} THEN {text(f'{rule.column}:{check}')} END"
                  for check, bad in _row_rule_checks(rule)]
    return f"array_compact({array(names)})"


def with_violations(df: DataFrame, contract: Contract = TRAINING_CONTRACT) -> DataFrame:
    return df.selectExpr("*", f"{violations_column(df, contract)} AS violations").selectExpr(
        "*", "get(violations, 0) AS first_violation")


def valid_filter(df: DataFrame, contract: Contract) -> str:
    """One conjunction over the input columns, so the scan can prune with it."""
    if any(r.column not in df.columns for r in contract.rules):
        return "false"
    parts = [f"{q(r.column)} IS NOT NULL" if check == "type" else f"NOT ({bad})"
             for r in contract.rules for check, bad in _row_rule_checks(r)]
    return " AND ".join(parts)


def split_by_contract(df: DataFrame, contract: Contract = TRAINING_CONTRACT) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy every rule, and the quarantined rest with the reasons."""
    good = valid_filter(df, contract)
    return df.where(good), with_violations(df.where(f"NOT coalesce({good}, false)"), contract)

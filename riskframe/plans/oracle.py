"""ANSI SQL twins of the registered queries, built on the same derived account table."""

from __future__ import annotations

from math import factorial

from riskframe.config import (
    BILL_COLUMNS, CATEGORICAL_FEATURES, CONTRACTS, INPUT_COLUMNS, NUMERIC_FEATURES,
    PAY_COLUMNS, PAYMENT_COLUMNS, TARGET, Contract,
)
from riskframe.functions.labels import (
    EDUCATION_LABELS, GENDER_LABELS, MARRIAGE_LABELS, PAY_LABELS, READABLE_NAMES,
)
from riskframe.operators.features import BALANCE_FEATURES, PAYMENT_FEATURES, RATIO_FEATURES
from riskframe.operators.score import (
    FIXED_COVER_TREES, FIXED_KERNEL_INTERCEPT, FIXED_KERNEL_WEIGHTS, FIXED_LEAVES, FIXED_SCORECARD, FIXED_TREE_COLUMNS,
)

ENGINEERED = RATIO_FEATURES + PAYMENT_FEATURES + BALANCE_FEATURES
WEIGHTS = FIXED_SCORECARD.weights
ALL_COLUMNS = (*INPUT_COLUMNS, TARGET)
COPY_OFFSET = 1_000_000_000_000
BASE = "base_value"


def _list(parts) -> str:
    return ", ".join(parts)


def _pivot(m: int, column: str, source: str) -> str:
    return f"max(CASE WHEN m = {m} THEN {column} END) AS {source}{m}"


ACCOUNTS = f"""
dated AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, (month(o_orderdate) - 1) % 6 + 1 AS m,
         cast(o_totalprice AS decimal(18,2)) AS total FROM orders),
bills AS (
  SELECT o_custkey, m, sum(total) AS bill,
         sum(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN -1 ELSE 0 END) AS standing
  FROM dated GROUP BY o_custkey, m),
refunds AS (
  SELECT o_custkey, m, sum(cast(l_extendedprice AS decimal(18,2))) AS paid
  FROM dated JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' GROUP BY o_custkey, m),
bill_wide AS (
  SELECT o_custkey, sum(standing) AS standing,
         {_list(_pivot(m, 'bill', 'bill') for m in range(1, 7))},
         {_list(_pivot(m, 'standing', 'standing') for m in range(1, 7))}
  FROM bills GROUP BY o_custkey),
paid_wide AS (
  SELECT o_custkey AS paid_custkey, {_list(_pivot(m, 'paid', 'paid') for m in range(1, 7))}
  FROM refunds GROUP BY o_custkey),
accounts AS (
  SELECT c_custkey AS account_id,
         cast(10000 + (c_custkey * 7919 % 100) * 10000 AS bigint) AS LIMIT_BAL,
         cast(1 + c_custkey % 2 AS bigint) AS SEX,
         cast(c_custkey % 7 AS bigint) AS EDUCATION,
         cast(c_nationkey % 4 AS bigint) AS MARRIAGE,
         cast(21 + c_custkey % 59 AS bigint) AS AGE,
         {_list(f"cast(greatest(-2, least(8, coalesce(standing{m}, -2))) AS bigint) AS {c}"
                for m, c in enumerate(PAY_COLUMNS, 1))},
         {_list(f"cast(bill{m} AS double) AS BILL_AMT{m}" for m in range(1, 7))},
         {_list(f"cast(paid{m} AS double) AS PAY_AMT{m}" for m in range(1, 7))},
         cast(CASE WHEN coalesce(standing, 0) + c_custkey % 5 >= 3 THEN 1 ELSE 0 END AS bigint) AS {TARGET}
  FROM customer LEFT JOIN bill_wide ON c_custkey = o_custkey
                LEFT JOIN paid_wide ON c_custkey = paid_custkey)"""

RAW = f"""
raw_accounts AS (
  SELECT account_id, {_list(ALL_COLUMNS)} FROM accounts
  UNION ALL
  SELECT account_id + {COPY_OFFSET}, {_list(ALL_COLUMNS)} FROM accounts
  WHERE account_id IN (SELECT user_id FROM events))"""

FILLED = f"""
filled AS (SELECT account_id, {_list(f"coalesce({c}, 0) AS {c}" for c in ALL_COLUMNS)} FROM accounts)"""


def _row_sum(cols) -> str:
    return " + ".join(f"coalesce({c}, 0)" for c in cols)


def _row_mean(cols) -> str:
    present = " + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in cols)
    return f"coalesce(cast({_row_sum(cols)} AS double) / nullif({present}, 0), 0)"


def features_cte(source: str, name: str = "featured") -> str:
    limit = "nullif(cast(LIMIT_BAL AS double), 0)"
    exprs = {
        "PAY_AMT_TO_LIMIT_RATIO": f"coalesce(({' + '.join(PAYMENT_COLUMNS)}) / {limit}, 0)",
        "BILL_AMT_TO_LIMIT_RATIO": f"coalesce(BILL_AMT1 / {limit}, 0)",
        "PAY_TO_BILL_RATIO": "coalesce(PAY_AMT1 / nullif(BILL_AMT1 + 1, 0), 0)",
        "AVG_PAY_STATUS": _row_mean(PAY_COLUMNS),
        "MAX_PAY_DELAY": f"coalesce(greatest({_list(PAY_COLUMNS)}), 0)",
        "MONTHS_WITH_DELAY": "cast(" + " + ".join(f"CASE WHEN {c} > 0 THEN 1 ELSE 0 END" for c in PAY_COLUMNS) + " AS bigint)",
        "TOTAL_BILL_AMT": _row_sum(BILL_COLUMNS),
        "AVG_BILL_AMT": _row_mean(BILL_COLUMNS),
        "BILL_AMT_TREND": "coalesce(BILL_AMT1 - BILL_AMT6, 0)",
        "TOTAL_PAY_AMT": _row_sum(PAYMENT_COLUMNS),
        "AVG_PAY_AMT": _row_mean(PAYMENT_COLUMNS),
    }
    return f"\n{name} AS (SELECT *, {_list(f'{e} AS {n}' for n, e in exprs.items())} FROM {source})"


LOGIT = " + ".join(["(-0.55)", *(f"cast({f} AS double) * ({w!r})" for f, w in WEIGHTS.items())])
BANDS = ("CASE WHEN {p} < 0.3 THEN 'Low Risk' WHEN {p} < 0.6 THEN 'Medium Risk' ELSE 'High Risk' END")
SCORED = f"""
with_p AS (SELECT *, 1.0 / (1.0 + exp(-({LOGIT}))) AS probability FROM featured),
scored AS (SELECT *, CASE WHEN probability > 0.5 THEN 1 ELSE 0 END AS prediction,
                  probability * 100 AS risk_score, {BANDS.format(p='probability')} AS risk_category FROM with_p)"""

ON_ACCOUNTS = f"WITH {ACCOUNTS}"
ON_RAW = f"WITH {ACCOUNTS},{RAW}"
ON_FEATURES = f"WITH {ACCOUNTS},{features_cte('accounts')}"
ON_FILLED = f"WITH {ACCOUNTS},{FILLED},{features_cte('filled')}"
ON_SCORED = f"{ON_FILLED},{SCORED}"


def hash_sql(seed: int = 42, key: str = "account_id") -> str:
    return f"cast('0x' || substr(md5(concat_ws('|', cast({key} AS varchar), '{seed}')), 1, 8) AS bigint)"


TEST_CUT = int(round(0.2 * 2**32))

BACKGROUND = f"""
bg_rows AS (SELECT * FROM scored ORDER BY {hash_sql()}, account_id LIMIT 100),
bg AS (SELECT {_list(f"avg({f}) AS bg_{f}" for f in WEIGHTS)} FROM bg_rows),
phi AS (SELECT s.*, {_list(f"({w!r}) * (s.{f} - bg.bg_{f}) AS phi_{f}" for f, w in WEIGHTS.items())},
               (-0.55) + {" + ".join(f"({w!r}) * bg.bg_{f}" for f, w in WEIGHTS.items())} AS {BASE}
        FROM scored s CROSS JOIN bg),
long_phi AS ({" UNION ALL ".join(
    f"SELECT account_id, probability, {BASE}, '{f}' AS feature, cast({f} AS double) AS value, phi_{f} AS contribution FROM phi"
    for f in WEIGHTS)}),
stats AS (SELECT feature, avg(contribution) AS mean_contribution, stddev_pop(contribution) AS std_contribution,
                 avg(abs(contribution)) AS mean_abs_contribution, count(*) AS n_rows FROM long_phi GROUP BY feature),
ranked AS (SELECT *, row_number() OVER (ORDER BY mean_abs_contribution DESC, feature) AS importance_rank FROM stats),
ordered AS (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY abs(contribution) DESC, feature) AS position
            FROM long_phi)"""
ON_PHI = f"{ON_SCORED},{BACKGROUND}"


def _range_rows(contract: Contract, table: str) -> str:
    rows = []
    for r in contract.rules:
        c = r.column

        def row(check: str, bad: str, observed: str) -> str:
            return (f"SELECT '{check}' AS check_name, '{c}' AS column_name, count(CASE WHEN {bad} THEN 1 END) = 0 AS passed, "
                    f"'error' AS severity, count(CASE WHEN {bad} THEN 1 END) AS violations, "
                    f"cast({observed} AS double) AS observed FROM {table}")

        if r.minimum is not None:
            rows.append(row("min", f"{c} < {r.minimum}", f"min({c})"))
        if r.maximum is not None:
            rows.append(row("max", f"{c} > {r.maximum}", f"max({c})"))
        if r.allowed is not None:
            rows.append(row("allowed", f"{c} IS NULL OR {c} NOT IN ({_list(map(str, r.allowed))})", "NULL"))
    return " UNION ALL ".join(rows)


def _schema_rows(contract: Contract) -> str:
    return " UNION ALL ".join(
        f"SELECT '{check}' AS check_name, '{r.column}' AS column_name, true AS passed, 'error' AS severity, "
        f"cast(0 AS bigint) AS violations, cast(NULL AS double) AS observed"
        for check in ("present", "type") for r in contract.rules)


def _violations(contract: Contract) -> str:
    cases = []
    for r in contract.rules:
        c = r.column
        cases.append(f"CASE WHEN {c} IS NULL THEN '{c}:type' END")
        if r.minimum is not None:
            cases.append(f"CASE WHEN {c} < {r.minimum} THEN '{c}:min' END")
        if r.maximum is not None:
            cases.append(f"CASE WHEN {c} > {r.maximum} THEN '{c}:max' END")
        if r.allowed is not None:
            cases.append(f"CASE WHEN {c} NOT IN ({_list(map(str, r.allowed))}) THEN '{c}:allowed' END")
    return f"list_filter([{_list(cases)}], lambda x: x IS NOT NULL)"


TRAINING, SERVING = CONTRACTS["training"], CONTRACTS["serving"]

NULLS = " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in ALL_COLUMNS)
QUALITY = f"""
quality AS (
  SELECT cast(n AS bigint) AS rows, cast({len(ALL_COLUMNS)} AS bigint) AS columns, cast(missing AS bigint) AS missing_count,
         missing * 100.0 / (n * {len(ALL_COLUMNS)}) AS missing_percentage,
         cast(n - d AS bigint) AS duplicate_count, (n - d) * 100.0 / n AS duplicate_percentage
  FROM (SELECT count(*) AS n, sum({NULLS}) AS missing FROM raw_accounts)
  CROSS JOIN (SELECT count(*) AS d FROM (SELECT DISTINCT {_list(ALL_COLUMNS)} FROM raw_accounts)))"""
VERDICT = f"""
checks AS ({_schema_rows(TRAINING)} UNION ALL {_range_rows(TRAINING, 'raw_accounts')}),
verdict AS (
  SELECT CASE WHEN bool_and(passed) AND max(missing_percentage) <= 5 AND max(duplicate_percentage) <= 1
              THEN 'Validation Passed' ELSE 'Validation Failed' END AS validation_status,
         CASE WHEN bool_and(passed) FILTER (WHERE check_name = 'present') THEN 'Passed' ELSE 'Failed' END AS column_validation,
         CASE WHEN bool_and(passed) FILTER (WHERE check_name = 'type') THEN 'Passed' ELSE 'Failed' END AS type_validation,
         CASE WHEN bool_and(passed) FILTER (WHERE check_name IN ('min', 'max', 'allowed')) THEN 'Passed' ELSE 'Failed' END AS range_validation,
         round(max(missing_percentage), 6) AS missing_percentage, round(max(duplicate_percentage), 6) AS duplicate_percentage
  FROM checks CROSS JOIN quality)"""

PROFILED = (*NUMERIC_FEATURES, *CATEGORICAL_FEATURES, TARGET)


def _unpivot(columns, source: str, keep: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {keep}'{c}' AS column_name, cast({c} AS double) AS x FROM {source}" for c in columns)


def _decode(column: str, labels: dict) -> str:
    return "CASE " + column + " " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in labels.items()) + " END"


IMPUTED = f"""
medians AS (SELECT {_list(f"quantile_cont({c}, 0.5) AS med_{c}" for c in NUMERIC_FEATURES)} FROM accounts),
imputed AS (SELECT account_id, {_list(f"cast(coalesce({c}, med_{c}) AS double) AS {c}" for c in NUMERIC_FEATURES)}
            FROM accounts CROSS JOIN medians),
quartiles AS (SELECT {_list(f"quantile_cont({c}, {q}) AS q{n}_{c}" for c in NUMERIC_FEATURES for n, q in ((1, 0.25), (2, 0.5), (3, 0.75)))}
              FROM imputed)"""

QUOTAS = f"""
classes AS (SELECT {TARGET}, count(*) AS n_cls, sum(count(*)) OVER () AS n_all FROM accounts GROUP BY {TARGET}),
shares AS (SELECT *, ceil(n_all * 0.2) AS n_test, floor(ceil(n_all * 0.2) * n_cls / n_all) AS base,
                  ceil(n_all * 0.2) * n_cls / n_all - floor(ceil(n_all * 0.2) * n_cls / n_all) AS rest FROM classes),
quotas AS (SELECT {TARGET} AS q_flag, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, {TARGET})
                  <= n_test - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM shares),
placed AS (SELECT account_id, {TARGET}, row_number() OVER (PARTITION BY {TARGET} ORDER BY {hash_sql()}, account_id) AS rn FROM accounts),
split AS (SELECT account_id, {TARGET}, rn <= quota AS is_test FROM placed JOIN quotas ON {TARGET} = q_flag)"""

METRICS = f"""
cm AS (SELECT {TARGET} AS label, prediction, count(*) AS n FROM scored GROUP BY 1, 2),
per_class AS (
  SELECT k AS cls, sum(CASE WHEN label = k THEN n ELSE 0 END) AS support,
         sum(CASE WHEN prediction = k THEN n ELSE 0 END) AS predicted,
         sum(CASE WHEN label = k AND prediction = k THEN n ELSE 0 END) AS tp
  FROM cm CROSS JOIN (SELECT unnest([0, 1]) AS k) GROUP BY k),
rates AS (SELECT *, coalesce(tp * 1.0 / nullif(predicted, 0), 0) AS p, coalesce(tp * 1.0 / nullif(support, 0), 0) AS r FROM per_class),
f_rates AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM rates),
headline AS (SELECT sum(tp) * 1.0 / sum(support) AS accuracy, sum(p * support) / sum(support) AS precision,
                    sum(r * support) / sum(support) AS recall, sum(f * support) / sum(support) AS f1_score FROM f_rates),
by_score AS (SELECT probability, sum({TARGET}) AS pos, sum(1 - {TARGET}) AS neg FROM scored GROUP BY probability),
steps AS (SELECT pos, neg, sum(neg) OVER (ORDER BY probability) - neg AS below FROM by_score),
auc AS (SELECT sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) AS roc_auc FROM steps)"""

SCALED = (*NUMERIC_FEATURES, *ENGINEERED)
PREPARED = f"""
parts AS (SELECT f.*, is_test FROM featured f JOIN (SELECT account_id AS k, is_test FROM split) ON account_id = k),
fit AS (SELECT {_list(f"quantile_cont(cast({c} AS double), {p}) AS q{n}_{c}" for c in SCALED for n, p in ((1, 0.25), (2, 0.5), (3, 0.75)))}
        FROM parts WHERE NOT is_test),
codes AS ({_unpivot(CATEGORICAL_FEATURES, 'parts', 'account_id, is_test, ')}),
known AS (SELECT column_name AS c, x AS known_x, row_number() OVER (PARTITION BY column_name ORDER BY x) AS place
          FROM (SELECT DISTINCT column_name, x FROM codes WHERE NOT is_test))"""

DISPLAY = 6
POINTS = 20


def _pd_rows() -> str:
    return " UNION ALL ".join(f"""
  SELECT '{f}' AS feature, point, grid_value,
         avg(1.0 / (1.0 + exp(-(logit + ({w!r}) * (grid_value - {f}))))) AS mean_probability
  FROM (SELECT cast({f} AS double) AS {f}, {LOGIT} AS logit FROM featured)
  CROSS JOIN (SELECT p AS point, lo + (hi - lo) * p / {POINTS - 1} AS grid_value
              FROM (SELECT min(cast({f} AS double)) AS lo, max(cast({f} AS double)) AS hi FROM featured)
              CROSS JOIN (SELECT unnest(range(0, {POINTS})) AS p))
  GROUP BY point, grid_value""" for f, w in WEIGHTS.items())


STREAMED = f"""
open_accounts AS (SELECT * FROM scored WHERE account_id % 10 <> 0),
requests AS (SELECT event_id AS request_id, user_id AS account_id, strftime(ts, '%Y-%m-%d') AS day, s.* EXCLUDE (account_id),
                    CASE WHEN s.account_id IS NULL THEN 'unknown account' ELSE 'scored' END AS status
             FROM events LEFT JOIN open_accounts s ON user_id = s.account_id),
windows AS (SELECT day, count(*) AS n, avg(probability) AS mean_probability,
                   count(CASE WHEN prediction = 1 THEN 1 END) AS default_predictions,
                   count(CASE WHEN risk_category = 'High Risk' THEN 1 END) AS high_risk_count,
                   count(CASE WHEN risk_category = 'Medium Risk' THEN 1 END) AS medium_risk_count,
                   count(CASE WHEN risk_category = 'Low Risk' THEN 1 END) AS low_risk_count,
                   count(CASE WHEN probability IS NULL THEN 1 END) AS unknown_accounts
            FROM requests GROUP BY day)"""

_READABLE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in READABLE_NAMES.items())
_TITLE = ("array_to_string(list_transform(string_split(replace(feature, '_', ' '), ' '), "
          "lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ')")

SERVING_OK = " AND ".join(
    f"{r.column} IS NOT NULL" + (f" AND {r.column} >= {r.minimum}" if r.minimum is not None else "")
    + (f" AND {r.column} <= {r.maximum}" if r.maximum is not None else "") for r in SERVING.rules)

SUMMARY = f"""
SELECT count(*) AS total_records, count(CASE WHEN prediction = 1 THEN 1 END) AS default_predictions,
       count(CASE WHEN prediction = 0 THEN 1 END) AS no_default_predictions, round(avg(risk_score), 6) AS avg_risk_score,
       count(CASE WHEN risk_category = 'High Risk' THEN 1 END) AS high_risk_count,
       count(CASE WHEN risk_category = 'Medium Risk' THEN 1 END) AS medium_risk_count,
       count(CASE WHEN risk_category = 'Low Risk' THEN 1 END) AS low_risk_count FROM scored"""

CODE_RULES = tuple((r.column, r.allowed) for r in TRAINING.rules if r.allowed is not None)

SQL: dict[str, str] = {
    "account_table": f"{ON_ACCOUNTS} SELECT account_id, {_list(ALL_COLUMNS)} FROM accounts",
    "clean_accounts": f"""{ON_RAW} SELECT min(account_id) AS account_id, {_list(ALL_COLUMNS)} FROM raw_accounts
        WHERE {" AND ".join(f"{c} IS NOT NULL" for c in ALL_COLUMNS)} GROUP BY {_list(ALL_COLUMNS)}""",
    "fill_missing": f"{ON_FILLED} SELECT account_id, {_list(ALL_COLUMNS)} FROM filled",
    "text_round_trip": f"{ON_ACCOUNTS} SELECT account_id, {_list(ALL_COLUMNS)} FROM accounts",
    "dataset_checks": f"{ON_ACCOUNTS} {_schema_rows(TRAINING)} UNION ALL {_range_rows(TRAINING, 'accounts')}",
    "invalid_values": f"""{ON_ACCOUNTS}, widened AS (SELECT {_list(ALL_COLUMNS)} FROM accounts UNION ALL
        SELECT {_list({'EDUCATION': '9', 'SEX': 'NULL', 'MARRIAGE': 'MARRIAGE + 2'}.get(c, c) for c in ALL_COLUMNS)} FROM accounts WHERE account_id % 37 = 0)
        SELECT column_name, value, count(*) AS n FROM ({" UNION ALL ".join(
            f"SELECT '{c}' AS column_name, cast({c} AS double) AS value FROM widened WHERE {c} IS NULL OR {c} NOT IN ({_list(map(str, ok))})"
            for c, ok in CODE_RULES)}) GROUP BY column_name, value""",
    "row_violations": f"{ON_ACCOUNTS} SELECT account_id, v[1] AS first_violation, len(v) AS n_violations, array_to_string(v, ',') AS violations FROM (SELECT account_id, {_violations(TRAINING)} AS v FROM accounts)",
    "row_violations_serving": f"{ON_ACCOUNTS} SELECT account_id, v[1] AS first_violation, len(v) AS n_violations, array_to_string(v, ',') AS violations FROM (SELECT account_id, {_violations(SERVING)} AS v FROM accounts)",
    "quarantine_split": f"{ON_ACCOUNTS} SELECT account_id, len({_violations(SERVING)}) = 0 AS valid FROM accounts",
    "batch_outcome": f"{ON_ACCOUNTS} SELECT count(*) AS total, count(CASE WHEN {SERVING_OK} THEN 1 END) AS success_count, count(*) - count(CASE WHEN {SERVING_OK} THEN 1 END) AS error_count FROM accounts",
    "quality": f"{ON_RAW},{QUALITY} SELECT rows, columns, missing_count, round(missing_percentage, 6) AS missing_percentage, duplicate_count, round(duplicate_percentage, 6) AS duplicate_percentage FROM quality",
    "verdict": f"{ON_RAW},{QUALITY},{VERDICT} SELECT * FROM verdict",
    "status_report": f"""{ON_RAW},{QUALITY},{VERDICT}
        SELECT 0 AS line_no, 'Validation Status: ' || validation_status AS line FROM verdict
        UNION ALL SELECT 1, 'Column Validation: ' || column_validation FROM verdict
        UNION ALL SELECT 2, 'Type Validation: ' || type_validation FROM verdict
        UNION ALL SELECT 3, 'Range Validation: ' || range_validation FROM verdict
        UNION ALL SELECT 4, 'Missing Percentage: ' || printf('%.2f%%', missing_percentage) FROM verdict
        UNION ALL SELECT 5, 'Duplicate Percentage: ' || printf('%.2f%%', duplicate_percentage) FROM verdict""",
    "target_distribution": f"{ON_ACCOUNTS} SELECT {TARGET} AS value, count(*) AS n FROM accounts GROUP BY {TARGET}",
    "numeric_profile": f"""{ON_ACCOUNTS} SELECT column_name, count(x) AS n, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std,
        min(x) AS min, max(x) AS max, round(median(x), 4) AS median FROM ({_unpivot(PROFILED, 'accounts')}) GROUP BY column_name""",
    "drift": f"""{ON_ACCOUNTS}, parted AS (SELECT *, {hash_sql()} < {TEST_CUT} AS is_test FROM accounts),
        p AS (SELECT column_name, is_test, avg(x) AS mean, stddev_samp(x) AS std FROM ({_unpivot(PROFILED, 'parted', 'is_test, ')}) GROUP BY 1, 2)
        SELECT b.column_name, round(b.mean, 4) AS baseline_mean, round(b.std, 4) AS baseline_std, round(c.mean, 4) AS current_mean,
               round(abs(c.mean - b.mean) / b.std, 6) AS score, abs(c.mean - b.mean) / b.std > 0.1 AS drifted
        FROM p b JOIN p c ON b.column_name = c.column_name AND NOT b.is_test AND c.is_test""",
    "outliers": f"""{ON_ACCOUNTS}, cells AS ({_unpivot(PROFILED, 'accounts')}),
        s AS (SELECT column_name AS c, avg(x) AS mean, stddev_samp(x) AS std FROM cells GROUP BY 1)
        SELECT column_name, count(x) AS n, count(CASE WHEN abs((x - mean) / nullif(std, 0)) > 3 THEN 1 END) AS outliers
        FROM cells JOIN s ON column_name = c GROUP BY column_name""",
    "outlier_rows": f"""{ON_ACCOUNTS}, s AS (SELECT {_list(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in NUMERIC_FEATURES)} FROM accounts)
        SELECT account_id, {" + ".join(f"CASE WHEN abs(({c} - m_{c}) / nullif(s_{c}, 0)) > 3 THEN 1 ELSE 0 END" for c in NUMERIC_FEATURES)} AS n_outliers
        FROM accounts CROSS JOIN s""",
    "engineered_features": f"{ON_FEATURES} SELECT account_id, {_list(ENGINEERED)} FROM featured",
    "median_impute": f"{ON_ACCOUNTS},{IMPUTED} SELECT account_id, {_list(f'round({c}, 4) AS {c}' for c in NUMERIC_FEATURES)} FROM imputed",
    "robust_scale": f"""{ON_ACCOUNTS},{IMPUTED} SELECT account_id,
        {_list(f"round(({c} - q2_{c}) / CASE WHEN q3_{c} = q1_{c} THEN 1 ELSE q3_{c} - q1_{c} END, 6) AS {c}" for c in NUMERIC_FEATURES)}
        FROM imputed CROSS JOIN quartiles""",
    "category_counts": f"{ON_ACCOUNTS} SELECT column_name, x AS value, count(*) AS n FROM ({_unpivot(CATEGORICAL_FEATURES, 'accounts')}) WHERE x IS NOT NULL GROUP BY 1, 2",
    "mode_impute": f"""{ON_ACCOUNTS}, counted AS (SELECT column_name, x, count(*) AS n FROM ({_unpivot(CATEGORICAL_FEATURES, 'accounts')}) WHERE x IS NOT NULL GROUP BY 1, 2)
        SELECT column_name, x AS mode FROM (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, x) AS rn FROM counted) WHERE rn = 1""",
    "one_hot": f"""{ON_ACCOUNTS}, cells AS ({_unpivot(CATEGORICAL_FEATURES, 'accounts', 'account_id, ')}),
        firsts AS (SELECT column_name AS c, min(x) AS first_x FROM cells GROUP BY 1)
        SELECT account_id, column_name || '_' || cast(cast(x AS bigint) AS varchar) AS feature
        FROM cells JOIN firsts ON column_name = c WHERE x <> first_x""",
    "prepared_matrix": f"""{ON_FILLED},{QUOTAS},{PREPARED}
        {" UNION ALL ".join(f"SELECT account_id, '{c}' AS feature, round((cast({c} AS double) - q2_{c}) / CASE WHEN q3_{c} = q1_{c} THEN 1 ELSE q3_{c} - q1_{c} END, 6) AS value FROM parts CROSS JOIN fit" for c in SCALED)}
        UNION ALL SELECT account_id, column_name || '_' || cast(cast(x AS bigint) AS varchar), 1.0 FROM codes JOIN known ON column_name = c AND x = known_x AND place > 1""",
    "matrix_export": f"""{ON_FILLED},{QUOTAS},{PREPARED}
        {" UNION ALL ".join(f"SELECT account_id, '{c}' AS feature, round((cast({c} AS double) - q2_{c}) / CASE WHEN q3_{c} = q1_{c} THEN 1 ELSE q3_{c} - q1_{c} END, 6) AS value FROM parts CROSS JOIN fit" for c in SCALED)}
        UNION ALL SELECT account_id, column_name || '_' || cast(cast(x AS bigint) AS varchar), 1.0 FROM codes JOIN known ON column_name = c AND x = known_x AND place > 1
        UNION ALL SELECT account_id, 'label', cast({TARGET} AS double) FROM accounts""",
    "malformed_lines": f"{ON_ACCOUNTS} SELECT CASE WHEN account_id % 50 = 0 THEN 'quarantined' ELSE 'kept' END AS part, count(*) AS n FROM accounts GROUP BY 1",
    "awkward_inputs": f"""{ON_ACCOUNTS} SELECT account_id, CASE WHEN account_id % 11 = 0 OR account_id % 13 = 0 THEN NULL ELSE BILL_AMT1 END AS BILL_AMT1,
        {TARGET}, cast({len(INPUT_COLUMNS) + 2} AS bigint) AS n_features, '{TARGET}' AS target_name, 'note' AS failed_columns FROM accounts""",
    "switched_features": f"{ON_FEATURES} SELECT account_id, {_list(f'round({c}, 6) AS {c}' if c not in ('MAX_PAY_DELAY', 'MONTHS_WITH_DELAY') else c for c in PAYMENT_FEATURES)} FROM featured",
    "one_record": f"""{ON_PHI} SELECT p.account_id, p.prediction, round(p.probability, 6) AS probability, p.risk_category,
        (SELECT string_agg(feature, ',' ORDER BY position) FROM ordered o WHERE o.account_id = p.account_id AND position <= 3) AS explanation
        FROM phi p WHERE p.account_id = (SELECT min(account_id) FROM phi)""",
    "train_job_tables": f"""{ON_RAW}, whole AS (SELECT {_list(ALL_COLUMNS)}, count(*) AS copies FROM raw_accounts GROUP BY {_list(ALL_COLUMNS)}),
        kept AS (SELECT * FROM whole WHERE {" AND ".join(f"{c} IS NOT NULL" for c in ALL_COLUMNS)}),
        n AS (SELECT (SELECT cast(sum(copies) AS bigint) FROM whole) AS read, (SELECT count(*) FROM whole) AS differing, (SELECT count(*) FROM kept) AS kept,
                     (SELECT cast(ceil(count(*) * 0.2) AS bigint) FROM kept) AS test)
        SELECT 'read' AS part, read AS n FROM n UNION ALL SELECT 'repeated', read - differing FROM n UNION ALL SELECT 'incomplete', differing - kept FROM n
        UNION ALL SELECT 'kept', kept FROM n UNION ALL SELECT 'judged', test FROM n UNION ALL SELECT 'test', test FROM n
        UNION ALL SELECT 'test_matrix', test FROM n UNION ALL SELECT 'train', kept - test FROM n UNION ALL SELECT 'train_matrix', kept - test FROM n""",
    "fixed_tree_attribution": f"""{ON_ACCOUNTS}, hashed AS (SELECT account_id, {_list(FIXED_TREE_COLUMNS)}, {hash_sql()} AS h FROM accounts),
        wide AS (SELECT account_id, h, {{{_list(f"'{c}': cast({c} AS double)" for c in FIXED_TREE_COLUMNS)}}} AS v FROM hashed),
        long AS ({" UNION ALL ".join(f"SELECT account_id, h, '{c}' AS f, v.{c} AS x FROM wide" for c in FIXED_TREE_COLUMNS)}),
        chosen AS (SELECT account_id FROM hashed ORDER BY h, account_id LIMIT 1000),
        behind AS (SELECT account_id FROM hashed ORDER BY h, account_id LIMIT 100),
        leaves(leaf, value, f, lo, hi) AS (VALUES {_list(f"({i}, {v}, '{c}', {lo}, {hi})" for i, (v, conditions) in enumerate(FIXED_LEAVES) for c, lo, hi in conditions)}),
        mine AS (SELECT account_id, leaf, l.f, l.value, x > lo AND x <= hi AS yes FROM long JOIN leaves l USING (f) WHERE account_id IN (SELECT account_id FROM chosen)),
        theirs AS (SELECT account_id AS other, leaf, l.f, x > lo AND x <= hi AS yes FROM long JOIN leaves l USING (f) WHERE account_id IN (SELECT account_id FROM behind)),
        cells AS (SELECT m.account_id, t.other, m.leaf, m.f, m.value, m.yes AND NOT t.yes AS gains, t.yes AND NOT m.yes AS loses, NOT m.yes AND NOT t.yes AS dead
                  FROM mine m JOIN theirs t ON m.leaf = t.leaf AND m.f = t.f),
        counted AS (SELECT *, count(*) FILTER (gains) OVER w AS a, count(*) FILTER (loses) OVER w AS b, bool_or(dead) OVER w AS gone
                    FROM cells WINDOW w AS (PARTITION BY account_id, other, leaf)),
        parts AS (SELECT account_id, f, CASE WHEN gone THEN 0 WHEN gains THEN value * factorial(cast(a - 1 AS integer)) * factorial(cast(b AS integer)) / factorial(cast(a + b AS integer))
                  WHEN loses THEN -value * factorial(cast(a AS integer)) * factorial(cast(b - 1 AS integer)) / factorial(cast(a + b AS integer)) ELSE 0 END AS phi FROM counted)
        SELECT account_id, f AS feature, round(cast(sum(phi) AS double) / (SELECT count(*) FROM behind), 6) AS contribution FROM parts GROUP BY 1, 2""",
    "fitted_score_facts": f"{ON_ACCOUNTS} SELECT count(*) AS n, count(*) AS in_range, count(*) AS class_agrees, count(*) AS score_agrees, count(*) AS band_agrees FROM accounts",
    "tree_importance_facts": f"{ON_FILLED},{QUOTAS},{PREPARED} SELECT cast({len(SCALED)} + (SELECT count(*) FROM known WHERE place > 1) AS bigint) AS n_features, cast(1 AS double) AS total",
    "sampled_attribution_facts": f"""{ON_FILLED},{QUOTAS},{PREPARED}, n AS (SELECT least(1000, count(*)) AS n FROM split WHERE is_test)
        SELECT n AS n_rows, cast({len(SCALED)} + (SELECT count(*) FROM known WHERE place > 1) AS bigint) AS n_features, n AS n_exact FROM n""",
    "cv_report_facts": "SELECT 5 AS folds, true AS in_range, true AS mean_agrees, true AS deviation_agrees",
    "standard_scale": f"""{ON_FILLED}, s AS (SELECT {_list(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in NUMERIC_FEATURES)} FROM filled)
        SELECT account_id, {_list(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in NUMERIC_FEATURES)} FROM filled CROSS JOIN s""",
    "hash_split": f"{ON_ACCOUNTS} SELECT account_id, {hash_sql()} < {TEST_CUT} AS is_test FROM accounts",
    "split_counts": f"{ON_ACCOUNTS},{QUOTAS} SELECT {TARGET}, is_test, count(*) AS n FROM split GROUP BY 1, 2",
    "exact_split": f"{ON_ACCOUNTS},{QUOTAS} SELECT account_id, is_test FROM split",
    "coded_logistic": f"{ON_ACCOUNTS} SELECT EDUCATION, count(*) AS n, round(avg({TARGET}), 4) AS default_rate FROM accounts GROUP BY 1",
    "fold_counts": f"""{ON_ACCOUNTS}, ranges AS (SELECT {TARGET} AS cls, {hash_sql(43)} >> 16 AS bucket, count(*) AS n FROM accounts GROUP BY 1, 2),
        upto AS (SELECT *, sum(n) OVER (PARTITION BY cls ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY cls) AS n_cls FROM ranges),
        ends AS (SELECT cls, k, min(bucket) AS last FROM upto, range(1, 5) AS t(k) WHERE upto * 5 >= n_cls * k GROUP BY 1, 2),
        folded AS (SELECT u.cls, u.n, (SELECT count(*) FROM ends e WHERE e.cls = u.cls AND e.last < u.bucket) AS fold FROM upto u)
        SELECT cls AS {TARGET}, cast(fold AS integer) AS fold, cast(sum(n) AS bigint) AS n FROM folded GROUP BY 1, 2""",
    "sample_rows": f"{ON_ACCOUNTS} SELECT account_id FROM accounts ORDER BY {hash_sql()}, account_id LIMIT 100",
    "score": f"{ON_SCORED} SELECT account_id, prediction, round(probability, 6) AS probability, round(risk_score, 4) AS risk_score, risk_category FROM scored",
    "risk_bands": f"""{ON_SCORED} SELECT account_id, risk_category,
        CASE WHEN probability > 0.7 THEN 'High' WHEN probability > 0.4 THEN 'Medium' ELSE 'Low' END AS explain_band,
        CASE WHEN probability < 0.3 THEN 'LOW RISK' WHEN probability < 0.7 THEN 'MEDIUM RISK' ELSE 'HIGH RISK' END AS documented_band FROM scored""",
    "batch_score_summary": f"{ON_SCORED} {SUMMARY}",
    "risk_distribution": f"{ON_SCORED} SELECT risk_category, count(*) AS n FROM scored GROUP BY 1",
    "decode_labels": f"""{ON_SCORED} SELECT account_id, {_decode('SEX', GENDER_LABELS)} AS gender_label, {_decode('EDUCATION', EDUCATION_LABELS)} AS education_label,
        {_decode('MARRIAGE', MARRIAGE_LABELS)} AS marital_status_label, {_decode('PAY_0', PAY_LABELS)} AS payment_status_label,
        CASE prediction WHEN 1 THEN 'Default Risk' ELSE 'No Default Risk' END AS verdict FROM scored""",
    "confusion_matrix": f"{ON_SCORED} SELECT cast({TARGET} AS integer) AS label, prediction, count(*) AS n FROM scored GROUP BY 1, 2",
    "weighted_metrics": f"{ON_SCORED},{METRICS} SELECT round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score FROM headline",
    "roc_auc": f"{ON_SCORED},{METRICS} SELECT round(roc_auc, 6) AS roc_auc FROM auc",
    "evaluation_report": f"""{ON_SCORED},{METRICS} SELECT 'fixed scorecard' AS model_name, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision,
        round(recall, 6) AS recall, round(f1_score, 6) AS f1_score, round(roc_auc, 6) AS roc_auc,
        {_list(f"cast((SELECT coalesce(sum(n), 0) FROM cm WHERE label = {y} AND prediction = {p}) AS bigint) AS {name}"
               for y, p, name in ((0, 0, 'true_negatives'), (0, 1, 'false_positives'), (1, 0, 'false_negatives'), (1, 1, 'true_positives')))}
        FROM headline CROSS JOIN auc""",
    "metric_card": f"""{ON_SCORED},{METRICS}, m AS (SELECT * FROM headline CROSS JOIN auc)
        {" UNION ALL ".join(f"SELECT 'fixed scorecard' AS model_name, '{c}' AS metric, round({c}, 6) AS value FROM m" for c in ("accuracy", "precision", "recall", "f1_score", "roc_auc"))}""",
    "linear_attribution": f"{ON_PHI} SELECT account_id, feature, value, round(contribution, 6) AS contribution FROM long_phi",
    "base_value": f"{ON_PHI} SELECT round(max({BASE}), 6) AS base_value, count(*) AS n_rows FROM phi",
    "global_importance": f"{ON_PHI} SELECT feature, round(mean_abs_contribution, 6) AS importance FROM ranked WHERE importance_rank <= 5",
    "attribution_stats": f"""{ON_PHI} SELECT feature, round(mean_contribution, 6) AS mean_contribution, round(std_contribution, 6) AS std_contribution,
        round(mean_abs_contribution, 6) AS mean_abs_contribution, n_rows, cast({len(WEIGHTS)} AS bigint) AS n_features FROM stats""",
    "top_contributions": f"{ON_PHI} SELECT account_id, cast(position AS integer) AS position, feature, value, round(contribution, 6) AS contribution FROM ordered WHERE position <= 5",
    "local_explanation": f"""{ON_PHI} SELECT p.account_id, prediction, round(1 - p.probability, 6) AS p_no_default, round(p.probability, 6) AS p_default,
        round(p.{BASE}, 6) AS base_value, o.feature AS top_feature, round(o.contribution, 6) AS top_contribution,
        round({" + ".join(f"phi_{f}" for f in WEIGHTS)}, 6) AS total_contribution
        FROM phi p JOIN ordered o ON p.account_id = o.account_id AND o.position = 1""",
    "waterfall": f"""{ON_PHI}, grouped AS (
        SELECT account_id, {BASE}, least(position, {DISPLAY}) AS step,
               CASE WHEN position < {DISPLAY} THEN feature ELSE '{len(WEIGHTS) - DISPLAY + 1} other features' END AS feature, sum(contribution) AS contribution
        FROM ordered GROUP BY 1, 2, 3, 4)
        SELECT account_id, cast(step AS integer) AS step, feature, round(contribution, 6) AS contribution,
               round({BASE} + sum(contribution) OVER (PARTITION BY account_id ORDER BY step), 6) AS running_total FROM grouped""",
    "push_totals": f"""{ON_PHI} SELECT account_id, round({BASE}, 6) AS base_value,
        round({" + ".join(f"greatest(phi_{f}, 0)" for f in WEIGHTS)}, 6) AS push_up,
        round({" + ".join(f"least(phi_{f}, 0)" for f in WEIGHTS)}, 6) AS push_down,
        round({BASE} + {" + ".join(f"phi_{f}" for f in WEIGHTS)}, 6) AS output_value FROM phi""",
    "impact_table": f"""{ON_PHI} SELECT account_id, cast(importance_rank AS integer) AS rank, l.feature, value, round(contribution, 6) AS contribution
        FROM long_phi l JOIN ranked r ON l.feature = r.feature WHERE importance_rank <= 5""",
    "partial_dependence": f"""{ON_PHI}, curves AS ({_pd_rows()})
        SELECT c.feature, cast(point AS integer) AS point, round(grid_value, 4) AS grid_value, round(mean_probability, 6) AS mean_probability
        FROM curves c JOIN ranked r ON c.feature = r.feature WHERE importance_rank <= 5""",
    "decision_paths": f"""{ON_PHI}, picked AS (SELECT account_id AS k FROM accounts ORDER BY {hash_sql()}, account_id LIMIT 20)
        SELECT account_id, cast({len(WEIGHTS)} + 1 - importance_rank AS integer) AS step, l.feature,
               round({BASE} + sum(contribution) OVER (PARTITION BY account_id ORDER BY importance_rank DESC), 6) AS cumulative
        FROM long_phi l JOIN ranked r ON l.feature = r.feature JOIN picked ON account_id = k""",
    "contribution_matrix": f"""{ON_PHI}, picked AS (SELECT account_id AS k FROM accounts ORDER BY {hash_sql()}, account_id LIMIT 50)
        SELECT account_id, round(probability, 6) AS probability, {_list(f"round(phi_{f}, 6) AS {f}" for f in WEIGHTS)} FROM phi JOIN picked ON account_id = k""",
    "readable_names": f"{ON_PHI} SELECT feature, CASE feature {_READABLE} ELSE {_TITLE} END AS readable_name, n_rows FROM stats",
    "stream_score": f"{ON_SCORED} SELECT account_id, prediction, round(probability, 6) AS probability, risk_category FROM scored WHERE account_id IN (SELECT account_id FROM accounts WHERE {SERVING_OK})",
    "stream_quarantine": f"{ON_ACCOUNTS} SELECT account_id, v[1] AS first_violation FROM (SELECT account_id, {_violations(SERVING)} AS v FROM accounts) WHERE len(v) > 0",
    "window_monitor": f"{ON_SCORED},{STREAMED} SELECT day, n, round(mean_probability, 6) AS mean_probability, default_predictions, high_risk_count, medium_risk_count, low_risk_count, unknown_accounts FROM windows",
    "window_drift": f"""{ON_SCORED},{STREAMED}, b AS (SELECT avg(probability) AS m, stddev_samp(probability) AS s FROM open_accounts)
        SELECT day, n, round(abs(mean_probability - m) / s, 6) AS score, abs(mean_probability - m) / s > 0.1 AS drifted FROM windows CROSS JOIN b""",
    "stream_column_drift": f"""{ON_SCORED},{STREAMED},
        base AS ({" UNION ALL ".join(f"SELECT '{c}' AS column_name, avg(cast({c} AS double)) AS m, stddev_samp(cast({c} AS double)) AS s FROM open_accounts" for c in (*NUMERIC_FEATURES, *CATEGORICAL_FEATURES))}),
        daily AS ({" UNION ALL ".join(f"SELECT day, '{c}' AS column_name, count({c}) AS n, avg(cast({c} AS double)) AS x FROM requests GROUP BY 1" for c in (*NUMERIC_FEATURES, *CATEGORICAL_FEATURES))})
        SELECT day, column_name, n, round(abs(x - m) / s, 6) AS score, coalesce(abs(x - m) / s > 0.1, false) AS drifted FROM daily JOIN base USING (column_name)""",
    "late_requests": f"""{ON_SCORED}, open_accounts AS (SELECT account_id, probability FROM scored WHERE account_id % 10 <> 0),
        requests AS (SELECT event_id, ts, probability, date_trunc('day', ts) + INTERVAL 1 DAY AS ends FROM events LEFT JOIN open_accounts ON user_id = account_id),
        first_mark AS (SELECT max(ts) - INTERVAL 3 DAY AS mark FROM requests WHERE event_id % 2 = 0),
        last_mark AS (SELECT max(ts) - INTERVAL 3 DAY AS mark FROM requests),
        parted AS (SELECT strftime(ts, '%Y-%m-%d') AS day, probability,
                   CASE WHEN event_id % 2 = 1 AND ends <= f.mark THEN 'late' WHEN ends <= l.mark THEN 'closed' ELSE 'open' END AS part
                   FROM requests, first_mark f, last_mark l)
        SELECT day, part, count(*) AS n, round(avg(probability), 6) AS mean_probability FROM parted GROUP BY 1, 2""",
    "audit_trail": f"{ON_SCORED},{STREAMED} SELECT request_id, account_id, day, round(probability, 6) AS probability, risk_category, status, 'fixed-1' AS model_version FROM requests",
}


# ---------------------------------------------------------------- models, by other algorithms than the operators use

def _shapley(columns: tuple[str, ...], value: str) -> list[str]:
    """One Shapley value for each column from the values ``value0`` ... of all subsets of known columns, numbered by bits."""
    n, out = len(columns), []
    for i in range(n):
        terms = []
        for mask in range(2 ** n):
            if not mask >> i & 1:
                size = bin(mask).count("1")
                terms.append(f"({factorial(size) * factorial(n - size - 1)} / {factorial(n)}.0) * ({value}{mask | 1 << i} - {value}{mask})")
        out.append(" + ".join(terms))
    return out


def _known(node: tuple, columns: tuple[str, ...], mask: int) -> tuple[str, float]:
    """What a tree is expected to give if the columns of a subset are known and the others follow the cover."""
    if len(node) == 2:
        return f"({node[0]!r})", node[1]
    column, cut, low, high = node
    (a, a_cover), (b, b_cover) = _known(low, columns, mask), _known(high, columns, mask)
    cover = a_cover + b_cover
    if mask >> columns.index(column) & 1:
        return f"(CASE WHEN {column} <= {cut!r} THEN {a} ELSE {b} END)", cover
    return f"(({a} * {a_cover!r} + {b} * {b_cover!r}) / {cover!r})", cover


def _long(columns: tuple[str, ...], source: str, rest: str) -> str:
    phis = _shapley(columns, "v")
    return " UNION ALL ".join(f"SELECT account_id, '{c}' AS feature, round({phi}, 6) AS contribution, {rest} FROM {source}" for c, phi in zip(columns, phis))


def cover_sql() -> str:
    values = []
    for mask in range(2 ** len(FIXED_TREE_COLUMNS)):
        trees = " + ".join(_known(t, FIXED_TREE_COLUMNS, mask)[0] for t in FIXED_COVER_TREES)
        values.append(f"cast({trees} AS double) AS v{mask}")
    return f"""{ON_ACCOUNTS}, chosen AS (SELECT * FROM accounts ORDER BY {hash_sql()}, account_id LIMIT 1000),
        valued AS (SELECT account_id, {_list(values)} FROM chosen)
        {_long(FIXED_TREE_COLUMNS, "valued", "round(v0, 6) AS base_value, round(1 / (1 + exp(-v7)), 6) AS probability")}"""


def kernel_sql() -> str:
    columns = tuple(FIXED_KERNEL_WEIGHTS)
    values = []
    for mask in range(2 ** len(columns)):
        logit = " + ".join(f"({FIXED_KERNEL_WEIGHTS[c]!r}) * {'s' if mask >> i & 1 else 'b'}.{c}" for i, c in enumerate(columns))
        values.append(f"avg(1 / (1 + exp(-(({FIXED_KERNEL_INTERCEPT!r}) + {logit})))) AS v{mask}")
    return f"""{ON_ACCOUNTS}, ranked AS (SELECT *, row_number() OVER (ORDER BY {hash_sql()}, account_id) AS place FROM accounts),
        valued AS (SELECT s.account_id, {_list(values)} FROM ranked s, ranked b WHERE s.place <= 1000 AND b.place <= 100 GROUP BY 1)
        {_long(columns, "valued", "round(v0, 6) AS base_value, round(v15, 6) AS probability")}"""


# Columns and parameters of the boosting round.
ROUND_COLUMNS = ("PAY_0", "EDUCATION", "MARRIAGE", "SEX")
LAMBDA, LEAST_HESSIAN, LEAST_GAIN, RATE = 1.0, 1.0, 1e-6, 0.1


def boosting_sql(depth: int = 2) -> str:
    """Every cut of every node is tried by summing its rows anew."""
    rows = _list(f"cast({c} AS double) AS {c}" for c in ROUND_COLUMNS)
    ctes = [f"at0 AS (SELECT account_id, 'root' AS node, 0.5 - {TARGET} AS g, 0.25 AS h, {rows} FROM accounts)"]
    for k in range(depth + 1):
        ctes.append(f"sum{k} AS (SELECT node, sum(g) AS g, sum(h) AS h, count(*) AS n FROM at{k} GROUP BY node)")
        if k == depth:
            break
        cuts = " UNION ALL ".join(f"SELECT DISTINCT node, {i} AS f, {c} AS cut FROM at{k}" for i, c in enumerate(ROUND_COLUMNS))
        below = "CASE f " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(ROUND_COLUMNS)) + " END <= cut"
        ctes.append(f"""tried{k} AS (SELECT node, f, cut, sum(g) FILTER ({below}) AS gl, sum(h) FILTER ({below}) AS hl, sum(g) AS g, sum(h) AS h
            FROM at{k} JOIN ({cuts}) cuts USING (node) GROUP BY 1, 2, 3)""")
        ctes.append(f"""judged{k} AS (SELECT *, gl * gl / (hl + {LAMBDA}) + (g - gl) * (g - gl) / (h - hl + {LAMBDA}) - g * g / (h + {LAMBDA}) AS gain
            FROM tried{k} WHERE hl >= {LEAST_HESSIAN} AND h - hl >= {LEAST_HESSIAN})""")
        ctes.append(f"""best{k} AS (SELECT * FROM judged{k} WHERE gain > {LEAST_GAIN}
            QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 9) DESC, f, cut) = 1)""")
        ctes.append(f"""at{k + 1} AS (SELECT account_id, node || CASE WHEN {below} THEN ' low' ELSE ' high' END AS node, g, h, {_list(ROUND_COLUMNS)}
            FROM at{k} JOIN (SELECT node, f, cut FROM best{k}) b USING (node))""")
    names = "CASE f " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(ROUND_COLUMNS)) + " END"
    levels = [f"""SELECT s.node, {names if k < depth else 'NULL'} AS feature, {'cut' if k < depth else 'cast(NULL AS double)'} AS threshold,
        {'CASE WHEN f IS NULL THEN' if k < depth else ''} round(-s.g / (s.h + {LAMBDA}) * {RATE}, 6) {'END' if k < depth else ''} AS leaf_value, s.n
        FROM sum{k} s {f'LEFT JOIN (SELECT node, f, cut FROM best{k}) b USING (node)' if k < depth else ''}""" for k in range(depth + 1)]
    made = " UNION ALL ".join(levels)
    return f"{ON_ACCOUNTS}, {_list(ctes)} SELECT node, feature, cast(threshold AS double) AS threshold, cast(leaf_value AS double) AS leaf_value, n FROM ({made})"


SQL |= {
    # unpenalised models of one coded column give the default rate of each code
    "versioned_stream": f"""{ON_ACCOUNTS}, rates AS (SELECT account_id, avg({TARGET}) OVER (PARTITION BY EDUCATION) AS first_rate,
            avg({TARGET}) OVER (PARTITION BY MARRIAGE) AS second_rate FROM accounts)
        SELECT account_id, round(CASE WHEN account_id % 2 = 0 THEN first_rate ELSE second_rate END, 4) AS probability,
               cast(account_id % 2 + 1 AS bigint) AS model_version FROM rates""",
    "cover_tree_attribution": cover_sql(),
    "kernel_attribution": kernel_sql(),
    "boosting_round": boosting_sql(),
    "small_nodes": f"""{ON_ACCOUNTS},{QUOTAS} SELECT 5 AS n_trees, 0 AS n_small, 5 AS n_whole, count(*) AS n_scored, count(*) AS n_equal
        FROM split WHERE is_test""",
    # with C = 1: the gradient of each weight is its penalty's slope; the intercept is negative, as rates are below one half
    "penalised_intercept": f"""{ON_ACCOUNTS}, sides AS (SELECT SEX, count(*) AS n, avg({TARGET}) AS y FROM accounts GROUP BY SEX),
        two AS (SELECT sum(n) FILTER (SEX = 2) AS n1, sum(n * y) FILTER (SEX = 2) / sum(n) FILTER (SEX = 2) AS y1,
                       sum(n) FILTER (SEX <> 2) AS n0, sum(n * y) FILTER (SEX <> 2) / sum(n) FILTER (SEX <> 2) AS y0 FROM sides),
        solved AS (SELECT *, (n0 * y0 + n1 * y1 + 1) / (n0 + n1) AS alike, abs(n1 * (alike - y1)) <= 1 AS flat, sign(y1 - y0) AS s FROM two)
        SELECT SEX, n, round(cast(CASE WHEN flat THEN alike WHEN SEX = 2 THEN y1 - s / n1 ELSE y0 + (1 + s) / n0 END AS double), 4) AS probability
        FROM sides CROSS JOIN solved""",
}

# What the queries plant, number and weigh.
PLANTED = {"AGE": "CASE WHEN account_id % 41 = 0 THEN 17 ELSE AGE END", "SEX": "CASE WHEN account_id % 43 = 0 THEN 9 ELSE SEX END"}
INDEXED = ("AGE", "LIMIT_BAL", "account_id")

CODES = f"""
marked AS (SELECT account_id, AGE, LIMIT_BAL, {hash_sql()} < {TEST_CUT} AS is_test FROM accounts),
codes AS ({" UNION ALL ".join(f"SELECT '{c}' AS column_name, cast({c} AS double) AS value, count(*) AS n FROM marked WHERE NOT is_test GROUP BY 2" for c in INDEXED)}),
numbered AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY value) - 1 AS position, count(*) OVER (PARTITION BY column_name) AS size FROM codes)"""
_WIDTHS = [f"(SELECT max(size) - 1 FROM numbered WHERE column_name = '{c}')" for c in INDEXED]

FOLDS = f"""
ranges AS (SELECT {TARGET} AS cls, {hash_sql(43)} >> 16 AS bucket, count(*) AS n FROM accounts GROUP BY 1, 2),
upto AS (SELECT *, sum(n) OVER (PARTITION BY cls ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY cls) AS n_cls FROM ranges),
ends AS (SELECT cls, k, min(bucket) AS last FROM upto, range(1, 5) AS t(k) WHERE upto * 5 >= n_cls * k GROUP BY 1, 2),
folded AS (SELECT SEX AS code, {TARGET} AS y, (SELECT count(*) FROM ends e WHERE e.cls = a.{TARGET} AND e.last < ({hash_sql(43)} >> 16)) AS fold FROM accounts a)"""


def _gain(column: str) -> str:
    """Gini gain of every cut of a column."""
    return f"""SELECT '{column}' AS feature, v, nl, nr, n, yl, yr, y,
        2 * (y / n) * (1 - y / n) - (nl * 2 * (yl / nl) * (1 - yl / nl) + nr * 2 * (yr / nr) * (1 - yr / nr)) / n AS gain
        FROM (SELECT v, count(*) FILTER ({column} <= v) AS nl, count(*) FILTER ({column} > v) AS nr, count(*) AS n,
                     sum({TARGET}) FILTER ({column} <= v) AS yl, sum({TARGET}) FILTER ({column} > v) AS yr, sum({TARGET}) AS y
              FROM accounts, (SELECT DISTINCT {column} AS v FROM accounts) GROUP BY v) WHERE nr > 0"""


SQL |= {
    "format_round_trip": f"{ON_ACCOUNTS} SELECT format, account_id, {_list(ALL_COLUMNS)} FROM accounts CROSS JOIN (VALUES ('json'), ('orc'), ('parquet')) f(format)",
    "preview_rows": f"{ON_ACCOUNTS} SELECT account_id, {_list(ALL_COLUMNS)} FROM accounts ORDER BY account_id LIMIT 5",
    "code_index": f"{ON_ACCOUNTS},{CODES} SELECT column_name, value, n, position FROM numbered",
    "sparse_codes": f"""{ON_ACCOUNTS},{CODES}, placed AS ({" UNION ALL ".join(
        f"SELECT m.account_id, position - 1 + {' + '.join(['0', *_WIDTHS[:i]])} AS place FROM marked m JOIN numbered k ON column_name = '{c}' AND m.{c} = value AND position > 0"
        for i, c in enumerate(INDEXED))})
        SELECT account_id, cast({' + '.join(_WIDTHS)} AS bigint) AS width, cast(place AS bigint) AS place FROM placed""",
    "gate_stop": f"""{ON_FILLED}, planted AS (SELECT DISTINCT {_list(f"{PLANTED.get(c, c)} AS {c}" for c in ALL_COLUMNS)} FROM filled),
        judged AS ({_range_rows(TRAINING, "planted")})
        SELECT check_name, column_name, violations, 'Validation Failed' AS status FROM judged WHERE NOT passed""",
    "score_job_tables": f"""{ON_ACCOUNTS}, c AS (SELECT count(CASE WHEN {SERVING_OK} THEN 1 END) AS good, count(*) AS n FROM accounts)
        SELECT unnest(['scored', 'summary', 'distribution', 'quarantine']) AS part, unnest([good, good, good, n - good]) AS n FROM c""",
    "explain_job_tables": f"""{ON_ACCOUNTS}, codes AS (SELECT EDUCATION AS code, row_number() OVER (ORDER BY EDUCATION) - 1 AS place FROM (SELECT DISTINCT EDUCATION FROM accounts)),
        behind AS (SELECT EDUCATION AS code FROM accounts ORDER BY {hash_sql()}, account_id LIMIT 100),
        means AS (SELECT c.code, place * 0.25 AS w, (SELECT avg(CASE WHEN b.code = c.code THEN 1.0 ELSE 0.0 END) FROM behind b) AS m FROM codes c WHERE place > 0),
        parts AS (SELECT m.code, w * (CASE WHEN EDUCATION = m.code THEN 1 ELSE 0 END - m.m) AS phi FROM accounts CROSS JOIN means m)
        SELECT 'EDUCATION_' || code AS feature, round(cast(avg(phi) AS double), 6) AS mean_contribution, round(cast(avg(abs(phi)) AS double), 6) AS mean_abs_contribution,
               count(*) AS n_rows, 'linear' AS method, 'LogisticRegressionModel' AS model_type,
               round(cast((SELECT sum(w * m) - 1 FROM means) AS double), 6) AS base_value, count(*) AS n_local FROM parts GROUP BY code""",
    "coded_cv_scores": f"""{ON_ACCOUNTS},{FOLDS},
        rated AS (SELECT f.k AS fold, code, avg(y) AS rate FROM folded, range(0, 5) AS f(k) WHERE fold <> f.k GROUP BY 1, 2),
        held AS (SELECT d.fold, rate, sum(y) AS pos, count(*) - sum(y) AS neg FROM folded d JOIN rated r ON r.fold = d.fold AND r.code = d.code GROUP BY 1, 2),
        areas AS (SELECT a.fold, sum(a.pos * b.neg * CASE WHEN a.rate > b.rate THEN 1 WHEN a.rate = b.rate THEN 0.5 ELSE 0 END) / (any_value(t.p) * any_value(t.q)) AS auc
                  FROM held a JOIN held b ON a.fold = b.fold JOIN (SELECT fold, sum(pos) AS p, sum(neg) AS q FROM held GROUP BY 1) t ON t.fold = a.fold GROUP BY 1)
        SELECT round(avg(auc) OVER (), 5) AS mean_cv_score, round(stddev_pop(auc) OVER (), 5) AS std_cv_score, cast(fold AS integer) AS fold, round(auc, 5) AS auc FROM areas""",
    "stump_importance": f"""{ON_ACCOUNTS}, tried AS ({" UNION ALL ".join(map(_gain, ROUND_COLUMNS))}),
        best AS (SELECT feature FROM tried ORDER BY gain DESC LIMIT 1)
        SELECT c AS feature, CASE WHEN c = (SELECT feature FROM best) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS importance FROM (SELECT unnest({list(ROUND_COLUMNS)!r}) AS c)""",
}

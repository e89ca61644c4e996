"""DuckDB SQL that each registered query must agree with.

Written independently of the DataFrame code, from the definitions. Only the raw
tables exist there, so every text starts from the derived portfolio.
"""

from __future__ import annotations

from ..fixed_values import FULL_CATEGORICAL, FULL_NUMERIC, RECORDED_CATEGORICAL, RECORDED_NUMERIC, SUMMARY_COLUMNS
from ..schema import LOAN_COLUMNS

_LOANS = """
WITH b AS (
  SELECT o_orderkey AS k, o_custkey AS ck, o_orderstatus AS st, o_orderpriority AS pr,
         o_totalprice AS tp, CAST(o_orderdate AS DATE) AS od, c_mktsegment AS seg,
         CAST(15000 + floor(abs(c_acctbal) * 10) AS INT) AS inc, n_regionkey AS rk
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
p AS (
  SELECT b.*, CAST(300 + (k * 37) % 601 AS INT) AS score,
    CASE pr WHEN '1-URGENT' THEN 'Personal' WHEN '2-HIGH' THEN 'Auto' WHEN '3-MEDIUM' THEN 'Home'
            WHEN '4-NOT SPECIFIED' THEN 'Education' ELSE 'Business' END AS purpose,
    CASE WHEN (k * 31) % 100 < 78 THEN 0 WHEN (k * 31) % 100 < 80 THEN 1 WHEN (k * 31) % 100 < 86 THEN 30
         WHEN (k * 31) % 100 < 90 THEN 60 WHEN (k * 31) % 100 < 94 THEN 90
         WHEN (k * 31) % 100 < 97 THEN 120 ELSE 180 END AS dpd,
    CASE WHEN k % 20 = 7 THEN 'Written-Off' WHEN st = 'F' THEN 'Closed' WHEN st = 'O' THEN 'Active'
         ELSE 'Current' END AS status
  FROM b),
l AS (
  SELECT p.*,
    CAST(floor(tp) * CASE purpose WHEN 'Home' THEN 12 WHEN 'Business' THEN 4 ELSE 1 END AS INT) AS amt,
    CAST(CASE purpose WHEN 'Home' THEN 180 + 60 * (k % 4) WHEN 'Auto' THEN 36 + 12 * (k % 4)
         WHEN 'Personal' THEN 12 + 12 * (k % 4) WHEN 'Education' THEN 60 + 24 * (k % 4)
         ELSE 36 + 24 * (k % 4) END AS INT) AS term,
    greatest(700, least(1800, 850 + (750 - score) * 2)) / 1e2 AS rate
  FROM p),
r AS (
  SELECT l.*,
    CAST(floor(amt * (rate / 1200) * pow(1 + rate / 1200, term) / (pow(1 + rate / 1200, term) - 1)) AS INT) AS emi,
    CAST(floor(inc * (ck % 41) / 1e2) AS INT) AS oemi,
    CASE WHEN dpd > 90 OR status = 'Written-Off' THEN 1 ELSE 0 END AS def,
    CAST(CASE WHEN k % 43 = 5 THEN NULL ELSE (k * 7) % 6 END AS INT) AS late
  FROM l),
loans AS (
  SELECT concat('CUST', lpad(CAST(ck AS VARCHAR), 8, '0')) AS customer_id,
  CAST(18 + (ck * 7) % 58 AS INT) AS age,
  CASE seg WHEN 'BUILDING' THEN 'Self-Employed' WHEN 'MACHINERY' THEN 'Business'
           WHEN 'FURNITURE' THEN 'Professional' ELSE 'Salaried' END AS employment_type,
  CASE ck % 4 WHEN 0 THEN 'Graduate' WHEN 1 THEN 'Post-Graduate' WHEN 2 THEN 'Under-Graduate'
              ELSE 'Doctorate' END AS education,
  CASE WHEN ck % 20 < 12 THEN 'Married' WHEN ck % 20 < 19 THEN 'Single' ELSE 'Divorced' END AS marital_status,
  CAST(CASE WHEN ck % 41 = 3 THEN NULL ELSE ck % 5 END AS INT) AS dependents,
  CASE rk % 3 WHEN 0 THEN 'Tier1' WHEN 1 THEN 'Tier2' ELSE 'Tier3' END AS city_tier,
  inc AS monthly_income, score AS credit_score, oemi AS existing_emi,
  CAST((ck * 13) % 241 AS INT) AS credit_history_months, CAST(ck % 6 AS INT) AS existing_loans,
  CASE WHEN k % 53 = 11 THEN NULL ELSE (10 + k % 81) / 1e2 END AS credit_utilization_ratio,
  concat('LOAN', lpad(CAST(k AS VARCHAR), 8, '0')) AS loan_id, purpose AS loan_purpose, amt AS loan_amount,
  term AS loan_term_months, rate AS interest_rate, od AS application_date, status AS loan_status,
  CAST(od + CAST(7 + k % 24 AS INT) AS DATE) AS disbursement_date,
  emi AS emi_amount, dpd AS current_dpd, CAST(greatest(dpd, 30 * (k % 4)) AS INT) AS max_dpd_12m,
  late AS late_payments_12m, (50 + (k * 11) % 51) / 1e2 AS payment_history_pct,
  CAST((k * 17) % term AS INT) AS total_payments_made, def AS is_default,
  CASE WHEN def = 1 THEN 'High' WHEN dpd > 30 THEN 'Medium' WHEN score < 650 OR late > 2 THEN 'Medium'
       ELSE 'Low' END AS risk_category,
  CASE WHEN def = 1 THEN (40 + k % 31) / 1e2 ELSE 0e0 END AS estimated_lgd,
  floor(amt * 1e2 / (inc * 12)) / 1e2 AS ltv_ratio, floor((emi + oemi) * 1e2 / inc) / 1e2 AS dti_ratio
  FROM r)"""

_DIRTY = (
    _LOANS
    + """,
keyed AS (SELECT CAST(substr(loan_id, 5) AS BIGINT) AS k, * FROM loans),
dirty AS (
  SELECT * REPLACE (
    CASE WHEN k % 97 = 1 THEN NULL ELSE customer_id END AS customer_id,
    CASE WHEN k % 137 = 9 THEN NULL ELSE loan_id END AS loan_id,
    CASE WHEN k % 101 = 2 THEN NULL WHEN k % 103 = 3 THEN 0 ELSE loan_amount END AS loan_amount,
    CASE WHEN k % 109 = 5 THEN NULL WHEN k % 107 = 4 THEN 950 ELSE credit_score END AS credit_score,
    CASE WHEN k % 113 = 6 THEN -1 ELSE current_dpd END AS current_dpd,
    CASE WHEN k % 131 = 8 THEN DATE '2030-01-01' ELSE application_date END AS application_date,
    CASE WHEN k % 127 = 7 THEN CAST(application_date - 1 AS DATE) ELSE disbursement_date END AS disbursement_date,
    CASE WHEN k % 139 = 10 THEN 0 ELSE monthly_income END AS monthly_income)
  FROM keyed)"""
)

_CHECKS = [
    ("Null check - customer_id", "customer_id IS NULL", "nulls found"),
    ("Null check - loan_id", "loan_id IS NULL", "nulls found"),
    ("Null check - loan_amount", "loan_amount IS NULL", "nulls found"),
    ("Null check - credit_score", "credit_score IS NULL", "nulls found"),
    ("Credit score range (300-900)", "credit_score < 300 OR credit_score > 900", "invalid scores"),
    ("DPD non-negative", "current_dpd < 0", "negative values"),
    ("Loan amount positive", "loan_amount <= 0", "invalid amounts"),
    (
        "Valid date logic",
        "application_date > DATE '2001-12-31' OR disbursement_date < application_date",
        "invalid dates",
    ),
]
_ANY_BAD = " OR ".join(f"coalesce({cond}, false)" for _, cond, _ in _CHECKS)


def _report(source: str, only_failed: bool = False) -> str:
    rows = " UNION ALL ".join(
        f"""SELECT '{name}' AS "check", n = 0 AS passed, concat(n, ' {words}') AS details
            FROM (SELECT count(*) FILTER (WHERE {cond}) AS n FROM {source})"""
        for name, cond, words in _CHECKS
    )
    return f"SELECT * FROM ({rows}){' WHERE NOT passed' if only_failed else ''}"


_CREDIT = """
    CASE WHEN credit_score >= 750 THEN 'Excellent' WHEN credit_score >= 700 THEN 'Good'
         WHEN credit_score >= 650 THEN 'Fair' WHEN credit_score >= 600 THEN 'Poor'
         ELSE 'Very Poor' END AS credit_score_bucket,
    CAST(credit_history_months / 12 AS DOUBLE) AS credit_history_years,
    CASE WHEN credit_utilization_ratio < 3e-1 THEN 'Low' WHEN credit_utilization_ratio < 6e-1 THEN 'Medium'
         ELSE 'High' END AS utilization_category,
    CASE WHEN existing_loans > 0 THEN 1 ELSE 0 END AS has_existing_loans,
    CASE WHEN credit_history_months >= 60 THEN 'Experienced' WHEN credit_history_months >= 24 THEN 'Moderate'
         ELSE 'Limited' END AS credit_experience"""
_LOAN = """
    CAST(loan_amount AS DOUBLE) / nullif(CAST(monthly_income AS BIGINT) * 12, 0) AS loan_to_annual_income,
    CAST(emi_amount AS DOUBLE) / nullif(monthly_income, 0) * 100 AS emi_burden_pct,
    CAST(emi_amount + existing_emi AS DOUBLE) / nullif(monthly_income, 0) * 100 AS total_debt_burden,
    CASE WHEN loan_term_months <= 24 THEN 'Short' WHEN loan_term_months <= 60 THEN 'Medium'
         ELSE 'Long' END AS loan_term_category,
    CASE WHEN interest_rate < 9 THEN 'Low' WHEN interest_rate < 12 THEN 'Medium'
         ELSE 'High' END AS interest_rate_bucket,
    CASE WHEN loan_amount < 100000 THEN 'Small' WHEN loan_amount < 500000 THEN 'Medium'
         WHEN loan_amount < 2000000 THEN 'Large' ELSE 'Very Large' END AS loan_amount_bucket"""
_REPAYMENT = """
    CASE WHEN current_dpd = 0 THEN 'Current' WHEN current_dpd <= 30 THEN 'DPD-30'
         WHEN current_dpd <= 60 THEN 'DPD-60' WHEN current_dpd <= 90 THEN 'DPD-90'
         ELSE 'DPD-90+' END AS dpd_category,
    payment_history_pct * 100 - late_payments_12m * 5 AS payment_consistency_score,
    CASE WHEN late_payments_12m >= 3 OR max_dpd_12m > 60 THEN 1 ELSE 0 END AS high_delinquency_risk,
    CAST(DATE '2001-12-31' - disbursement_date AS INT) AS days_since_disbursement,
    total_payments_made / loan_term_months * 100 AS loan_maturity_pct,
    (100 - current_dpd) * payment_history_pct AS payment_behavior_score"""
_DEMOGRAPHIC = """
    CASE WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44'
         WHEN age < 55 THEN '45-54' ELSE '55+' END AS age_group,
    CASE WHEN monthly_income < 30000 THEN 'Low' WHEN monthly_income < 60000 THEN 'Middle'
         WHEN monthly_income < 100000 THEN 'Upper-Middle' ELSE 'High' END AS income_bracket,
    CAST(dependents + CASE WHEN marital_status = 'Married' THEN 2 ELSE 1 END AS INT) AS family_size,
    monthly_income / (dependents + CASE WHEN marital_status = 'Married' THEN 2 ELSE 1 END) AS per_capita_income,
    CASE employment_type WHEN 'Salaried' THEN 100 WHEN 'Professional' THEN 90 WHEN 'Self-Employed' THEN 70
         ELSE 60 END AS employment_stability_score"""
_TIME = """
    CAST(year(application_date) AS INT) AS application_year,
    CAST(month(application_date) AS INT) AS application_month,
    CAST(quarter(application_date) AS INT) AS application_quarter,
    CAST(dayofweek(application_date) + 1 AS INT) AS application_day_of_week,
    CAST(date_sub('month', disbursement_date, DATE '2001-12-31') AS INT) AS loan_vintage_months,
    CASE WHEN month(application_date) IN (3, 4, 5) THEN 'Spring' WHEN month(application_date) IN (6, 7, 8)
         THEN 'Summer' WHEN month(application_date) IN (9, 10, 11) THEN 'Fall' ELSE 'Winter' END
      AS application_season"""
_SCORE = """
    (100 - ((credit_score - 300) / 6)) * 4e-1 + (current_dpd / 180 * 100) * 3e-1
      + (dti_ratio * 100) * 2e-1 + (late_payments_12m * 10) * 1e-1"""


def _features(source: str) -> str:
    return f"""
stage1 AS (
  SELECT *, {_CREDIT}, {_LOAN}, {_REPAYMENT}, {_DEMOGRAPHIC}, {_TIME}, {_SCORE} AS combined_risk_score
  FROM {source}),
feat AS (
  SELECT *, combined_risk_score / 100 AS pd_proxy,
    combined_risk_score / 100 * estimated_lgd
      * (loan_amount - CAST(emi_amount AS BIGINT) * total_payments_made) AS expected_loss_amount,
    CASE WHEN current_dpd > 0 OR late_payments_12m >= 2 OR payment_consistency_score < 70 THEN 1 ELSE 0 END
      AS early_warning_flag,
    CASE WHEN max_dpd_12m > current_dpd AND max_dpd_12m > 30 THEN 1 ELSE 0 END AS credit_deterioration
  FROM stage1)"""


# Every numeric column of feat.
_NUMERIC = (
    "age", "dependents", "monthly_income", "credit_score", "existing_emi", "credit_history_months", "existing_loans",
    "credit_utilization_ratio", "loan_amount", "loan_term_months", "interest_rate", "emi_amount", "current_dpd",
    "max_dpd_12m", "late_payments_12m", "payment_history_pct", "total_payments_made", "is_default", "estimated_lgd",
    "ltv_ratio", "dti_ratio", "credit_history_years", "has_existing_loans", "loan_to_annual_income", "emi_burden_pct",
    "total_debt_burden", "payment_consistency_score", "high_delinquency_risk", "days_since_disbursement",
    "loan_maturity_pct", "payment_behavior_score", "family_size", "per_capita_income", "employment_stability_score",
    "combined_risk_score", "pd_proxy", "expected_loss_amount", "early_warning_flag", "credit_deterioration",
    "application_year", "application_month", "application_quarter", "application_day_of_week", "loan_vintage_months",
)
_FEAT = f"{_LOANS},{_features('loans')}"
_SCORED = (
    _FEAT
    + """,
scored AS (
  SELECT loan_id, is_default, combined_risk_score AS score, pd_proxy AS probability,
    CASE WHEN combined_risk_score >= 60 THEN 1 ELSE 0 END AS prediction
  FROM feat WHERE combined_risk_score IS NOT NULL),
cm AS (
  SELECT count(*) FILTER (WHERE is_default = 1 AND prediction = 1) AS tp,
         count(*) FILTER (WHERE is_default = 0 AND prediction = 1) AS fp,
         count(*) FILTER (WHERE is_default = 1 AND prediction = 0) AS fn,
         count(*) FILTER (WHERE is_default = 0 AND prediction = 0) AS tn FROM scored)"""
)
_AVERAGES = """
    avg(loan_amount) OVER (PARTITION BY loan_purpose) AS avg_amount_by_purpose,
    avg(current_dpd) OVER (PARTITION BY loan_purpose) AS avg_dpd_by_purpose,
    avg(monthly_income) OVER (PARTITION BY city_tier) AS avg_income_by_tier"""
_DEVIATION = "(loan_amount - avg_amount_by_purpose) / avg_amount_by_purpose * 100 AS amount_deviation_pct"


def _hash(null_safe: bool = False, columns=LOAN_COLUMNS) -> str:
    parts = [f"CAST({n} AS VARCHAR)" for n in columns]
    if null_safe:
        parts = [f"coalesce({p}, '\\0')" for p in parts]
    return f"sha256(concat_ws('||', {', '.join(parts)}))"


_HASHED = f"{_LOANS}, hashed AS (SELECT *, {_hash()} AS record_hash FROM loans)"
_BATCH2 = f"""{_HASHED},
numbered AS (SELECT CAST(substr(loan_id, 5) AS BIGINT) AS k, * FROM loans),
batch2 AS (
  SELECT * EXCLUDE (k) REPLACE (
    CASE WHEN k % 10 = 1 THEN current_dpd + 30 ELSE current_dpd END AS current_dpd,
    CASE WHEN k % 10 NOT IN (0, 1) THEN concat('LOAN', lpad(CAST(k + 10000000 AS VARCHAR), 8, '0'))
         ELSE loan_id END AS loan_id)
  FROM numbered WHERE k % 10 = 0 OR k % 10 = 1 OR k % 50 = 2),
hashed2 AS (SELECT *, {_hash()} AS record_hash FROM batch2),
fresh AS (SELECT * FROM hashed2 n WHERE NOT EXISTS (
  SELECT 1 FROM hashed o WHERE o.loan_id = n.loan_id AND o.record_hash = n.record_hash))"""
_UNIT = "CAST(concat('0x', substr(md5(concat_ws('|', '42', loan_id)), 1, 7)) AS BIGINT) / 268435456e0"
_SPLIT = f"""{_LOANS},
drawn AS (SELECT *, {_UNIT} AS u FROM loans),
placed AS (SELECT *, count(*) OVER (PARTITION BY is_default ORDER BY u) AS upto,
                  count(*) OVER (PARTITION BY is_default) AS size FROM drawn),
cuts AS (SELECT is_default, min(u) AS cut FROM placed WHERE upto >= round(size * 2e-1) GROUP BY is_default),
split AS (SELECT d.*, d.u <= c.cut AS is_test FROM drawn d JOIN cuts c USING (is_default))"""
_ALL = ", ".join(LOAN_COLUMNS)


def _count_by(source: str, key: str) -> str:
    return f"SELECT {key}, count(*) AS count FROM {source} GROUP BY {key}"


def _long(source: str, columns, value: str) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS feature, {value.format(n)} AS value FROM {source}" for n in columns)


def _kpis(where: str = "true") -> str:
    return f"""SELECT round(coalesce(sum(loan_amount), 0) / 1e6, 6) AS total_portfolio_m,
      count(*) AS total_loans, round(avg(is_default) * 100, 6) AS default_rate_pct,
      round(avg(is_default) * 100 - 85e-1, 6) AS default_rate_delta, round(avg(current_dpd), 6) AS avg_dpd,
      count(*) FILTER (WHERE risk_category = 'High') AS high_risk_loans FROM loans WHERE {where}"""


def _dpd_histogram(lowest: str) -> str:
    bins = [("Current", 0, 1), ("1-30", 1, 30), ("31-60", 30, 60), ("61-90", 60, 90), ("90+", 90, 180)]
    return " UNION ALL ".join(
        f"""SELECT CAST({i} AS INT) AS bin, '{name}' AS dpd_bucket, count(*) AS count FROM loans
            WHERE current_dpd {lowest if i == 1 else '>'} {lo} AND current_dpd <= {hi}"""
        for i, (name, lo, hi) in enumerate(bins, start=1)
    )


_MONTHS = """,
months AS (
  SELECT last_day(application_date) AS month_end, sum(loan_amount) AS total, avg(is_default) AS rate
  FROM loans GROUP BY 1),
spine AS (
  SELECT last_day(CAST(unnest(generate_series(
    (SELECT date_trunc('month', min(month_end)) FROM months),
    (SELECT date_trunc('month', max(month_end)) FROM months), INTERVAL 1 MONTH)) AS DATE)) AS month_end)"""


def _ratio(a: str, b: str) -> str:
    return f"coalesce(({a}) / nullif(CAST({b} AS DOUBLE), 0), 0e0)"


def _class_row(name: str, hit: str, predicted: str, actual: str) -> str:
    p, r = _ratio(hit, predicted), _ratio(hit, actual)
    f = _ratio(f"2 * {hit}", f"{predicted} + {actual}")
    return f"SELECT '{name}' AS class, {p} AS precision, {r} AS recall, {f} AS f1_score, {actual} AS support FROM cm"


_REPORT = f""",
per_class AS ({_class_row('No Default', 'tn', '(tn + fn)', '(tn + fp)')}
  UNION ALL {_class_row('Default', 'tp', '(tp + fp)', '(tp + fn)')}),
report AS (
  SELECT * FROM per_class
  UNION ALL SELECT 'accuracy', a, a, a, n FROM
    (SELECT (tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE) AS a, tp + fp + fn + tn AS n FROM cm)
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support) FROM per_class
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1_score * support) / sum(support), sum(support) FROM per_class)"""

def _pseudonyms(key: bytes, version: int) -> str:
    """HMAC-SHA256 written out: hash of the outer pad and the hash of the inner pad and the text."""
    inner, outer = (bytes(b ^ mask for b in key.ljust(64, b"\0")).hex() for mask in (0x36, 0x5C))
    return f"""{_LOANS} SELECT loan_id, sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode(customer_id))))
      AS customer_id, CAST({version} AS INT) AS key_version FROM loans"""


ORACLE: dict[str, str] = {
    "segment_risk_profile": f"""{_FEAT}
      SELECT credit_score_bucket, loan_purpose, count(*) AS loans, CAST(sum(loan_amount) AS BIGINT) AS exposure,
        round(avg(is_default), 3) AS default_rate, round(avg(combined_risk_score), 3) AS avg_risk_score,
        round(sum(expected_loss_amount), 3) AS expected_loss
      FROM feat GROUP BY ALL""",
    "s01_csv_scan": f"{_LOANS} SELECT * FROM loans",
    "s02_typed_loans": f"{_LOANS} SELECT * FROM loans",
    "s03_table_scan": f"{_LOANS} SELECT * FROM loans",
    "s04_partitioned_scan": f"{_LOANS} SELECT * FROM loans",
    "s06_audit_columns": f"{_HASHED} SELECT loan_id, true AS has_timestamp, true AS has_file, record_hash FROM hashed",
    "s07_record_hash": f"{_LOANS} SELECT loan_id, {_hash()} AS record_hash, {_hash(True)} AS null_safe_hash FROM loans",
    "s08_record_key": f"{_DIRTY} SELECT customer_id, loan_id, customer_id || '||' || loan_id AS record_key FROM dirty",
    "s09_bronze_create": f"""{_HASHED} SELECT loan_status, count(*) AS loans, count(DISTINCT record_hash) AS hashes
      FROM hashed GROUP BY loan_status""",
    "s10_bronze_merge": f"""{_BATCH2} SELECT loan_id, loan_status, current_dpd, record_hash FROM hashed
      UNION ALL SELECT loan_id, loan_status, current_dpd, record_hash FROM fresh""",
    "s10_bucketed_merge": f"""{_BATCH2} SELECT loan_id, loan_status, current_dpd, record_hash FROM hashed
      UNION ALL SELECT loan_id, loan_status, current_dpd, record_hash FROM fresh""",
    "s11_silver_write": f"{_LOANS} SELECT risk_category, loan_purpose, count(*) AS count FROM loans GROUP BY ALL",
    "s12_replace_partitions": f"""{_LOANS} SELECT loan_id, risk_category, loan_purpose,
      CAST(current_dpd + CASE WHEN risk_category = 'High' THEN 1 ELSE 0 END AS INT) AS current_dpd FROM loans""",
    "s13_compaction": f"{_LOANS} SELECT count(*) AS rows_before, count(*) AS rows_after, true AS same FROM loans",
    "s14_table_statistics": f"{_LOANS} SELECT count(*) AS rows FROM loans",
    "s15_table_detail": f"{_LOANS} SELECT loan_status, count(*) AS rows, true AS has_files FROM loans GROUP BY 1",
    "s16_registered_table": f"""{_LOANS} SELECT loan_status, count(*) AS loans,
      CAST(sum(loan_amount) AS BIGINT) AS amount FROM loans GROUP BY loan_status""",
    "s17_csv_export": f"{_LOANS} SELECT loan_id, loan_amount, risk_category FROM loans WHERE risk_category = 'High'",
    "s19_text_lines": f"{_LOANS} SELECT DISTINCT customer_id AS value FROM loans",
    "s20_write_verification": f"""{_LOANS} SELECT count(*) AS rows, CAST(32 AS INT) AS columns, true AS complete
      FROM loans""",
    "s23_sample_rows": f"""{_LOANS} SELECT loan_id, customer_id, loan_amount, credit_score, risk_category
      FROM loans ORDER BY loan_id LIMIT 5""",
    "s24_latest_version": f"""{_BATCH2}, every AS (
        SELECT loan_id, loan_status, current_dpd, record_hash, 1 AS sent FROM hashed
        UNION ALL SELECT loan_id, loan_status, current_dpd, record_hash, 2 FROM fresh)
      SELECT loan_id, loan_status, current_dpd, record_hash FROM every
      QUALIFY row_number() OVER (PARTITION BY loan_id ORDER BY sent DESC, record_hash DESC) = 1""",
    "p02_aliased_columns": f"""{_FEAT} SELECT loan_id AS id, combined_risk_score AS risk_score, pd_proxy AS pd,
      emi_burden_pct AS emi_burden FROM feat""",
    "p03_existing_columns": f"""{_LOANS} SELECT loan_id, customer_id, loan_amount, current_dpd, credit_score,
      risk_category FROM loans""",
    "p04_null_rows": f"{_LOANS} SELECT loan_id, customer_id FROM loans WHERE dependents IS NULL",
    "p05_score_out_of_range": f"{_DIRTY} SELECT loan_id, credit_score FROM dirty WHERE {_CHECKS[4][1]}",
    "p06_sign_checks": f"""{_DIRTY} SELECT loan_id, current_dpd, loan_amount FROM dirty
      WHERE {_CHECKS[5][1]} OR {_CHECKS[6][1]}""",
    "p07_date_logic": f"""{_DIRTY} SELECT loan_id, application_date, disbursement_date,
      coalesce(disbursement_date < application_date, false) AS order_broken FROM dirty WHERE {_CHECKS[7][1]}""",
    "p08_membership": f"{_LOANS} SELECT loan_id, loan_status FROM loans WHERE loan_status IN ('Active', 'Closed')",
    "p09_date_range": f"""{_LOANS} SELECT loan_id, application_date FROM loans
      WHERE application_date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'""",
    "p10_high_risk": f"{_LOANS} SELECT loan_id, current_dpd, loan_status FROM loans WHERE risk_category = 'High'",
    "p11_distinct_values": f"{_LOANS} SELECT DISTINCT loan_status FROM loans",
    "p12_bounds": f"""{_LOANS} SELECT min(application_date) AS min_application_date,
      max(application_date) AS max_application_date FROM loans""",
    "p13_keyed_customers": _pseudonyms(b"second key, in use", 2),
    "p13_rotated_customers": _pseudonyms(b"second key, in use", 2),
    "p13_masked_customers": f"{_LOANS} SELECT loan_id, sha256('salt-1' || customer_id) AS customer_id FROM loans",
    "q09_quality_report": f"{_DIRTY} {_report('dirty')}",
    "q09_quality_report_clean": f"{_LOANS} {_report('loans')}",
    "q10_gate_clean_rows": f"{_DIRTY} SELECT {_ALL} FROM dirty WHERE NOT ({_ANY_BAD})",
    "q10_gate_quarantined": f"""{_DIRTY} SELECT customer_id, loan_id, concat_ws('; ', {', '.join(
        f"CASE WHEN {cond} THEN '{name}' END" for name, cond, _ in _CHECKS)}) AS failed_checks
      FROM dirty WHERE {_ANY_BAD}""",
    "q11_critical_nulls": f"""{_DIRTY},{_features('dirty')}
      SELECT feature, count(*) FILTER (WHERE value IS NULL) AS null_count FROM ({_long('feat', (
        'credit_score_bucket', 'loan_to_annual_income', 'emi_burden_pct', 'dpd_category',
        'combined_risk_score', 'pd_proxy'), 'CAST({} AS VARCHAR)')}) GROUP BY feature""",
    "q12_invalid_numbers": f"""{_DIRTY},{_features('dirty')}
      SELECT feature, count(*) FILTER (WHERE value IS NULL OR isnan(value) OR isinf(value)) AS invalid_count
      FROM ({_long('feat', _NUMERIC, 'CAST({} AS DOUBLE)')}) GROUP BY feature""",
    "q12_invalid_features": f"""{_DIRTY},{_features('dirty')}
      SELECT feature, count(*) FILTER (WHERE value IS NULL OR isnan(value) OR isinf(value)) AS invalid_count
      FROM ({_long('feat', _NUMERIC, 'CAST({} AS DOUBLE)')}) GROUP BY feature""",
    "q12_validate_features": f"""{_DIRTY},{_features('dirty')}
      SELECT 'null:' || feature AS "check", count(*) FILTER (WHERE value IS NULL) AS "rows" FROM ({_long('feat', (
        'credit_score_bucket', 'loan_to_annual_income', 'emi_burden_pct', 'dpd_category',
        'combined_risk_score', 'pd_proxy'), 'CAST({} AS VARCHAR)')}) GROUP BY feature
      UNION ALL
      SELECT 'invalid:' || feature, count(*) FILTER (WHERE value IS NULL OR isnan(value))
      FROM ({_long('feat', _NUMERIC, 'CAST({} AS DOUBLE)')}) GROUP BY feature""",
    "q13_missing_cells": f"""{_DIRTY} SELECT CAST(sum({' + '.join(
        f'CASE WHEN {n} IS NULL THEN 1 ELSE 0 END' for n in LOAN_COLUMNS)}) AS BIGINT) AS missing_values FROM dirty""",
    "f_credit_features": f"{_LOANS} SELECT loan_id, {_CREDIT} FROM loans",
    "f_loan_features": f"{_DIRTY} SELECT loan_id, {_LOAN} FROM dirty WHERE loan_id IS NOT NULL",
    "f_repayment_features": f"{_LOANS} SELECT loan_id, {_REPAYMENT} FROM loans",
    "f_demographic_features": f"{_LOANS} SELECT loan_id, {_DEMOGRAPHIC} FROM loans",
    "f_risk_features": f"""{_FEAT} SELECT loan_id, combined_risk_score, pd_proxy, expected_loss_amount,
      early_warning_flag, credit_deterioration FROM feat""",
    "f_time_features": f"{_LOANS} SELECT loan_id, {_TIME} FROM loans",
    "f_undecided_flags": f"""{_FEAT} SELECT loan_id, CAST(existing_loans > 0 AS INT) AS has_existing_loans,
      CAST(late_payments_12m >= 3 OR max_dpd_12m > 60 AS INT) AS high_delinquency_risk,
      CAST(current_dpd > 0 OR late_payments_12m >= 2 OR payment_consistency_score < 70 AS INT)
        AS early_warning_flag,
      CAST(trunc(days_since_disbursement / 30) AS INT) AS loan_vintage_months FROM feat""",
    "f35_feature_stamp": f"{_LOANS} SELECT loan_id, true AS stamped FROM loans",
    "f36_all_features": f"{_FEAT}, averaged AS (SELECT *, {_AVERAGES} FROM feat) SELECT *, {_DEVIATION} FROM averaged",
    "w01_w03_group_averages": f"""{_LOANS}, averaged AS (SELECT *, {_AVERAGES} FROM loans)
      SELECT loan_id, avg_amount_by_purpose, avg_dpd_by_purpose, avg_income_by_tier, {_DEVIATION} FROM averaged""",
    "w01_null_group_average": f"""{_LOANS}, holed AS (
        SELECT loan_id, loan_amount, nullif(loan_purpose, 'Home') AS loan_purpose FROM loans)
      SELECT loan_id, loan_purpose, avg(loan_amount) OVER (PARTITION BY loan_purpose) AS avg_amount_by_purpose
      FROM holed""",
    "j01_purpose_statistics": f"""{_LOANS}, stats AS (
        SELECT loan_purpose, avg(loan_amount) AS avg_amount, avg(current_dpd) AS avg_dpd FROM loans GROUP BY 1)
      SELECT loan_id, loan_purpose, avg_amount, avg_dpd FROM loans LEFT JOIN stats USING (loan_purpose)""",
    "j02_tier_statistics": f"""{_LOANS}, stats AS (
        SELECT city_tier, avg(monthly_income) AS avg_income FROM loans GROUP BY 1)
      SELECT loan_id, city_tier, avg_income FROM loans LEFT JOIN stats USING (city_tier)""",
    "j03_unmatched_rows": f"{_BATCH2} SELECT loan_id, current_dpd FROM fresh",
    "j04_profiles_side_by_side": f"""{_BATCH2} SELECT loan_id, record_hash, customer_id, age, monthly_income, credit_score,
      loan_amount, loan_purpose, emi_amount, current_dpd FROM (SELECT * FROM hashed UNION ALL SELECT * FROM fresh)""",
    "a01_count_by_status": f"{_LOANS} {_count_by('loans', 'loan_status')}",
    "a02_count_by_risk": f"{_LOANS} {_count_by('loans', 'risk_category')}",
    "a03_count_by_score_bucket": f"{_FEAT} {_count_by('feat', 'credit_score_bucket')}",
    "a04_count_by_purpose": f"{_LOANS} {_count_by('loans', 'loan_purpose')}",
    "a05_default_rate": f"{_LOANS} SELECT avg(is_default) AS default_rate FROM loans",
    "a05_default_rate_by_split": f"""{_SPLIT} SELECT is_test, round(avg(is_default), 6) AS default_rate
      FROM split GROUP BY is_test""",
    "a06_risk_summary": f"""{_FEAT} SELECT round(avg(combined_risk_score), 4) AS avg_risk_score,
      round(avg(pd_proxy), 4) AS avg_pd, round(avg(emi_burden_pct), 4) AS avg_emi_burden,
      round(avg(payment_consistency_score), 4) AS avg_payment_score FROM feat""",
    "a07_group_means": f"""{_LOANS} SELECT loan_purpose AS grp, avg(loan_amount) AS avg_amount,
        avg(current_dpd) AS avg_dpd FROM loans GROUP BY 1
      UNION ALL SELECT city_tier, avg(monthly_income), NULL FROM loans GROUP BY 1""",
    "a08_numeric_summary": f"""{_LOANS}
      SELECT feature, count(value) AS count, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std,
        min(value) AS min, round(quantile_cont(value, 0.25), 4) AS p25, round(quantile_cont(value, 0.5), 4) AS p50,
        round(quantile_cont(value, 0.75), 4) AS p75, max(value) AS max
      FROM ({_long('loans', SUMMARY_COLUMNS, 'CAST({} AS DOUBLE)')}) GROUP BY feature""",
    "a09_table_shape": f"{_FEAT} SELECT count(*) AS total_records, CAST(65 AS INT) AS total_columns FROM feat",
    "a10_medians": f"""{_FEAT} SELECT feature, round(median(value), 4) AS median
      FROM ({_long('feat', FULL_NUMERIC, 'CAST({} AS DOUBLE)')}) GROUP BY feature""",
    "a11_class_imbalance": f"""{_LOANS} SELECT CAST(count(*) - sum(is_default) AS DOUBLE) / sum(is_default)
      AS scale_pos_weight FROM loans""",
    "a12_segment_rollup": f"""{_FEAT} SELECT risk_category, loan_purpose,
        CAST(grouping(risk_category, loan_purpose) AS INT) AS level, count(*) AS loans,
        CAST(sum(loan_amount) AS BIGINT) AS exposure, round(avg(is_default), 3) AS default_rate,
        round(sum(expected_loss_amount), 3) AS expected_loss
      FROM feat GROUP BY ROLLUP (risk_category, loan_purpose)""",
    "t05_seeded_sample": f"""{_LOANS} SELECT loan_id, customer_id, loan_amount FROM loans
      ORDER BY {_UNIT}, loan_id LIMIT 1000""",
    "d01_key_metrics": f"{_LOANS} {_kpis()}",
    "d02_risk_distribution": f"""{_LOANS} SELECT risk_category, count(*) AS count,
      count(*) / CAST((SELECT count(*) FROM loans) AS DOUBLE) AS share FROM loans GROUP BY risk_category""",
    "d03_dpd_histogram": f"{_LOANS} {_dpd_histogram('>')}",
    "d03_dpd_histogram_with_current": f"{_LOANS} {_dpd_histogram('>=')}",
    "d04_monthly_volume": f"""{_LOANS}{_MONTHS} SELECT month_end, coalesce(total, 0) / 1e6 AS volume_m
      FROM spine LEFT JOIN months USING (month_end)""",
    "d05_monthly_default_rate": f"""{_LOANS}{_MONTHS} SELECT month_end, round(rate * 100, 6) AS default_rate_pct,
      85e-1 AS target_pct FROM spine LEFT JOIN months USING (month_end)""",
    "d06_score_histogram": f"""{_LOANS} SELECT CAST(least(29, floor((credit_score - 300) / 20)) AS INT) AS bin,
      count(*) AS count, 3e2 + least(29, floor((credit_score - 300) / 20)) * 20 AS bin_start
      FROM loans WHERE credit_score BETWEEN 300 AND 900 GROUP BY 1, 3""",
    "d07_amount_by_purpose": f"""{_LOANS} SELECT loan_purpose, sum(loan_amount) / 1e6 AS amount_m
      FROM loans GROUP BY loan_purpose""",
    "d08_high_risk_list": f"""{_LOANS} SELECT loan_id, customer_id, loan_amount, current_dpd, credit_score,
      risk_category FROM loans WHERE risk_category = 'High'
      ORDER BY current_dpd DESC, loan_amount DESC, loan_id LIMIT 20""",
    "d09_high_risk_export": f"{_LOANS} SELECT * FROM loans WHERE risk_category = 'High'",
    "d10_filtered_export": f"""{_LOANS} SELECT * FROM loans WHERE risk_category IN ('Low', 'Medium')
      AND application_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""",
    "d11_filtered_metrics": _LOANS + _kpis(
        """risk_category IN ('High', 'Medium') AND loan_status IN ('Active', 'Closed')
           AND application_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'"""),
    "m01_feature_matrix": f"""{_FEAT} SELECT loan_id, is_default,
      {', '.join((*RECORDED_NUMERIC, *RECORDED_CATEGORICAL))} FROM feat""",
    "m02_label_codes": f"""{_FEAT} SELECT feature, value,
        CAST(row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS INT) AS code
      FROM (SELECT DISTINCT feature, value FROM ({_long('feat', FULL_CATEGORICAL, "coalesce({}, 'None')")}))""",
    "m02_encoded_loans": f"""{_LOANS} SELECT loan_id, {', '.join(
        f'CAST(dense_rank() OVER (ORDER BY {n}) - 1 AS INT) AS {n}_code'
        for n in ('employment_type', 'education', 'city_tier', 'marital_status'))} FROM loans""",
    "m03_median_imputation": f"""{_LOANS} SELECT loan_id, {', '.join(
        f'coalesce(CAST({n} AS DOUBLE), (SELECT median({n}) FROM loans)) AS {n}'
        for n in ('dependents', 'late_payments_12m', 'credit_utilization_ratio'))} FROM loans""",
    "m04_hash_split": f"{_LOANS} SELECT loan_id, is_default, {_UNIT} < 2e-1 AS is_test FROM loans",
    "m04_stratified_split": f"{_SPLIT} SELECT loan_id, is_default, is_test FROM split",
    "m05_class_weights": f"""{_LOANS} SELECT loan_id, is_default, CASE WHEN is_default = 1
      THEN (SELECT CAST(count(*) - sum(is_default) AS DOUBLE) / sum(is_default) FROM loans) ELSE 1e0 END AS weight
      FROM loans""",
    "m06_scored_facts": f"""{_SPLIT} SELECT loan_id, is_default, is_test, TRUE AS probability_valid,
      TRUE AS prediction_fits, TRUE AS rating_fits, TRUE AS reloaded_equal FROM split""",
    "m13_importance_facts": f"""{_LOANS} SELECT CAST({len(RECORDED_NUMERIC) + len(RECORDED_CATEGORICAL)} AS BIGINT) AS features,
      CAST(0 AS BIGINT) AS negative, 1e0 AS total,
      '[{", ".join(sorted((*RECORDED_NUMERIC, *RECORDED_CATEGORICAL)))}]' AS names FROM (SELECT 1 FROM loans LIMIT 1)""",
    "st3_streamed_facts": f"{_LOANS} SELECT loan_id, TRUE AS same_probability, TRUE AS same_rating FROM loans",
    "m08_binary_metrics": f"""{_SCORED} SELECT round({_ratio('tp + tn', 'tp + fp + fn + tn')}, 6) AS accuracy,
      round({_ratio('tp', 'tp + fp')}, 6) AS precision, round({_ratio('tp', 'tp + fn')}, 6) AS recall,
      round({_ratio('2 * tp', '2 * tp + fp + fn')}, 6) AS f1_score FROM cm""",
    "m09_auc_roc": f"""{_SCORED}, ranked AS (
        SELECT is_default, rank() OVER (ORDER BY score) AS r0, count(*) OVER (PARTITION BY score) AS ties FROM scored)
      SELECT round((sum(r0 + (ties - 1) / 2e0) FILTER (WHERE is_default = 1)
          - sum(is_default) * (sum(is_default) + 1) / 2e0)
        / (sum(is_default) * CAST(count(*) - sum(is_default) AS DOUBLE)), 6) AS auc_roc FROM ranked""",
    "m10_classification_report": f"""{_SCORED}{_REPORT} SELECT class, round(precision, 6) AS precision,
      round(recall, 6) AS recall, round(f1_score, 6) AS f1_score, CAST(support AS BIGINT) AS support FROM report""",
    "m11_confusion_matrix": f"""{_SCORED} SELECT is_default AS actual,
      count(*) FILTER (WHERE prediction = 0) AS predicted_0, count(*) FILTER (WHERE prediction = 1) AS predicted_1
      FROM scored GROUP BY is_default""",
    "m12_roc_curve": f"""{_SCORED}, steps AS (
        SELECT score, sum(is_default) AS pos, sum(1 - is_default) AS neg FROM scored GROUP BY score)
      SELECT CAST(sum(neg) OVER w AS DOUBLE) / (SELECT sum(neg) FROM steps) AS fpr,
        CAST(sum(pos) OVER w AS DOUBLE) / (SELECT sum(pos) FROM steps) AS tpr, score AS threshold
      FROM steps WINDOW w AS (ORDER BY score DESC)""",
    "m14_calibration": f"""{_SCORED}, span AS (SELECT min(probability) AS lo, max(probability) AS hi FROM scored),
      placed AS (SELECT CAST(greatest(1, least(10, ceil((probability - lo) / ((hi - lo) / 10)))) AS INT) AS bin,
        is_default FROM scored, span),
      found AS (SELECT bin, avg(is_default) AS rate, count(*) AS n FROM placed GROUP BY bin)
      SELECT CAST(i AS INT) AS bin, round(lo + (i - 1) * ((hi - lo) / 10), 6) AS bin_low,
        round(lo + i * ((hi - lo) / 10), 6) AS bin_high, round(rate, 6) AS actual_default_rate,
        coalesce(n, 0) AS count
      FROM (SELECT unnest(range(1, 11)) AS i) JOIN span ON true LEFT JOIN found ON found.bin = i""",
    "m15_risk_rating": f"""{_FEAT} SELECT loan_id, CASE WHEN pd_proxy IS NULL THEN NULL
      WHEN pd_proxy < 1e-1 THEN 'Very Low' WHEN pd_proxy < 25e-2 THEN 'Low' WHEN pd_proxy < 5e-1 THEN 'Medium'
      WHEN pd_proxy < 75e-2 THEN 'High' ELSE 'Very High' END AS risk_rating FROM feat""",
    "m17_run_record": f"""{_SCORED} SELECT 'score_rule' AS run, '60' AS cut,
      round({_ratio('tp + tn', 'tp + fp + fn + tn')}, 6) AS accuracy, round({_ratio('tp', 'tp + fn')}, 6) AS recall,
      tp + fp + fn + tn AS rows FROM cm""",
    "st1_stream_ingest": f"{_HASHED} SELECT * FROM hashed",
    "st2_stream_silver": f"""{_FEAT}, averaged AS (SELECT *, {_AVERAGES} FROM feat)
      SELECT loan_id, risk_category, loan_purpose, combined_risk_score, expected_loss_amount,
        avg_amount_by_purpose, {_DEVIATION} FROM averaged""",
    "st4_windowed_metrics": f"""{_LOANS}, slotted AS (
        SELECT *, CAST(DATE '1970-01-01' + CAST(floor((application_date - DATE '1970-01-01') / 30) * 30 AS INT)
          AS DATE) AS window_start FROM loans),
      slots AS (SELECT window_start, CAST(window_start + 30 AS DATE) AS window_end, loan_purpose, count(*) AS loans,
        CAST(sum(loan_amount) AS BIGINT) AS amount, round(avg(is_default), 6) AS default_rate
        FROM slotted GROUP BY ALL)
      SELECT * FROM slots WHERE window_end <= (SELECT max(application_date) - 30 FROM loans)""",
    "st4_late_rows": f"""{_LOANS} SELECT loan_purpose, CAST(count(*) AS BIGINT) AS loans,
      CAST(sum(loan_amount) AS BIGINT) AS amount, TRUE AS some_late FROM loans GROUP BY loan_purpose""",
    "st5_merge_after_lost_checkpoint": f"{_HASHED} SELECT loan_id, record_hash, application_date FROM hashed",
    "st5_stream_dedupe": f"{_HASHED} SELECT loan_id, record_hash, application_date FROM hashed",
    "st6_stream_quality": f"{_DIRTY} {_report('dirty', only_failed=True)}",
    "l_pricing_rules": f"""{_LOANS} SELECT loan_id, emi_amount AS emi,
      round(greatest(7e0, least(18e0, 85e-1 + (750 - credit_score) / 50)), 2) AS rate,
      greatest(0e0, least(1e0, (750 - credit_score) / 450)) AS dpd_probability, max_dpd_12m AS max_dpd,
      CASE employment_type WHEN 'Salaried' THEN 1e0 WHEN 'Self-Employed' THEN 12e-1 WHEN 'Business' THEN 15e-1
        ELSE 18e-1 END AS income_multiplier,
      CAST(application_date + 7 AS DATE) AS earliest_disbursement FROM loans""",
    "l_label_rules": f"""{_LOANS} SELECT loan_id, is_default, risk_category AS risk, is_default = 1 AS has_loss,
      round(loan_amount / (monthly_income * 12), 2) AS ltv_ratio,
      round((emi_amount + existing_emi) / monthly_income, 2) AS dti_ratio FROM loans""",
    "l09_padded_keys": """SELECT concat('CUST', lpad(CAST(o_custkey AS VARCHAR), 8, '0')) AS customer_id,
      concat('LOAN', lpad(CAST(o_orderkey AS VARCHAR), 8, '0')) AS loan_id FROM orders""",
}
ORACLE["st4_windows_after_lost_checkpoint"] = ORACLE["st4_windowed_metrics"]

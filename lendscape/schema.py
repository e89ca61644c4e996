"""Declared schema of the loan portfolio source."""

from __future__ import annotations

from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType, StructField, StructType

_TYPES = {"string": StringType(), "int": IntegerType(), "double": DoubleType(), "date": DateType()}

# Column, type, required, in file order. "Required" is advisory:
# file sources relax it, so the quality gate checks it.
_COLUMNS = """
customer_id string required
age int required
employment_type string required
education string required
marital_status string required
dependents int
city_tier string
monthly_income int required
credit_score int required
existing_emi int
credit_history_months int
existing_loans int
credit_utilization_ratio double
loan_id string required
loan_purpose string required
loan_amount int required
loan_term_months int required
interest_rate double required
application_date date required
loan_status string required
disbursement_date date
emi_amount int required
current_dpd int required
max_dpd_12m int
late_payments_12m int
payment_history_pct double
total_payments_made int
is_default int required
risk_category string required
estimated_lgd double
ltv_ratio double
dti_ratio double
"""

_rows = [line.split() for line in _COLUMNS.strip().splitlines()]
LOAN_SCHEMA = StructType([StructField(r[0], _TYPES[r[1]], "required" not in r) for r in _rows])
LOAN_COLUMNS = tuple(LOAN_SCHEMA.fieldNames())
CORRUPT_COLUMN = "_corrupt_record"

"""A loan portfolio derived from the star-schema tables: one loan per order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lending
from ..functions.binning import lookup
from ..functions.keys import padded_key
from ..schema import LOAN_COLUMNS

# fixed values of the derivation
PURPOSE = {"1-URGENT": "Personal", "2-HIGH": "Auto", "3-MEDIUM": "Home", "4-NOT SPECIFIED": "Education"}
EMPLOYMENT = {"BUILDING": "Self-Employed", "MACHINERY": "Business", "FURNITURE": "Professional"}
AMOUNT_FACTOR = {"Home": 12, "Business": 4}
TERM = {"Home": (180, 60), "Auto": (36, 12), "Personal": (12, 12), "Education": (60, 24)}
TERM_OTHER = (36, 24)
DPD_SHARES = ((78, 0), (80, 1), (86, 30), (90, 60), (94, 90), (97, 120))
AS_OF = "2001-12-31"

c = F.col


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loans_from(*[table(spark, sf_dir, n) for n in ("orders", "customer", "nation")])


def loans_from(orders: DataFrame, customer: DataFrame, nation: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The 32-column portfolio and the columns ``carry`` of ``orders``, which may be a stream.

    Customers meet nations first: that side stays small, and Spark decides by
    size whether to broadcast it; a customer with very many orders is split by
    the adaptive skew join.
    """
    holders = customer.join(nation, c("c_nationkey") == c("n_nationkey")).select(
        c("c_custkey").alias("ck"),
        c("c_mktsegment").alias("seg"),
        (F.lit(15000) + F.floor(F.abs(c("c_acctbal")) * 10)).cast("int").alias("inc"),
        c("n_regionkey").alias("rk"),
    )
    base = orders.select(
        c("o_orderkey").alias("k"),
        c("o_custkey").alias("ck"),
        c("o_orderstatus").alias("st"),
        c("o_orderpriority").alias("pr"),
        c("o_totalprice").alias("tp"),
        c("o_orderdate").cast("date").alias("od"),
        *carry,
    ).join(holders, "ck")

    draw = (c("k") * 31) % 100
    dpd = F.when(draw < DPD_SHARES[0][0], DPD_SHARES[0][1])
    for bound, days in DPD_SHARES[1:]:
        dpd = dpd.when(draw < bound, days)
    base = base.withColumns(
        {
            "score": (F.lit(300) + (c("k") * 37) % 601).cast("int"),
            "purpose": lookup("pr", PURPOSE, "Business"),
            "dpd": dpd.otherwise(180),
            "status": F.when(c("k") % 20 == 7, "Written-Off")
            .when(c("st") == "F", "Closed")
            .when(c("st") == "O", "Active")
            .otherwise("Current"),
        }
    )
    term = F.lit(TERM_OTHER[0]) + TERM_OTHER[1] * (c("k") % 4)
    for name, (start, step) in TERM.items():
        term = F.when(c("purpose") == name, F.lit(start) + step * (c("k") % 4)).otherwise(term)
    base = base.withColumns(
        {
            "amt": (F.floor("tp") * lookup("purpose", AMOUNT_FACTOR, 1)).cast("int"),
            "term": term.cast("int"),
            "rate": F.greatest(F.lit(700), F.least(F.lit(1800), F.lit(850) + (F.lit(750) - c("score")) * 2)) / 1e2,
        }
    )
    base = base.withColumns(
        {
            "emi": lending.emi(c("amt"), c("rate"), c("term")),
            "oemi": F.floor(c("inc") * (c("ck") % 41) / 1e2).cast("int"),
            "def": lending.is_default(c("dpd"), c("status")),
            "late": F.when(c("k") % 43 != 5, (c("k") * 7) % 6).cast("int"),
        }
    )
    education = F.element_at(
        F.array(*[F.lit(e) for e in ("Graduate", "Post-Graduate", "Under-Graduate", "Doctorate")]),
        (c("ck") % 4 + 1).cast("int"),
    )
    tier = F.element_at(F.array(F.lit("Tier1"), F.lit("Tier2"), F.lit("Tier3")), (c("rk") % 3 + 1).cast("int"))
    columns = {
        "customer_id": padded_key("CUST", c("ck")),
        "age": (F.lit(18) + (c("ck") * 7) % 58).cast("int"),
        "employment_type": lookup("seg", EMPLOYMENT, "Salaried"),
        "education": education,
        "marital_status": F.when(c("ck") % 20 < 12, "Married").when(c("ck") % 20 < 19, "Single").otherwise("Divorced"),
        "dependents": F.when(c("ck") % 41 != 3, c("ck") % 5).cast("int"),
        "city_tier": tier,
        "monthly_income": c("inc"),
        "credit_score": c("score"),
        "existing_emi": c("oemi"),
        "credit_history_months": ((c("ck") * 13) % 241).cast("int"),
        "existing_loans": (c("ck") % 6).cast("int"),
        "credit_utilization_ratio": F.when(c("k") % 53 != 11, (F.lit(10) + c("k") % 81) / 1e2),
        "loan_id": padded_key("LOAN", c("k")),
        "loan_purpose": c("purpose"),
        "loan_amount": c("amt"),
        "loan_term_months": c("term"),
        "interest_rate": c("rate"),
        "application_date": c("od"),
        "loan_status": c("status"),
        "disbursement_date": lending.disbursed_on(c("od"), F.lit(7) + c("k") % 24),
        "emi_amount": c("emi"),
        "current_dpd": c("dpd"),
        "max_dpd_12m": lending.max_dpd(c("dpd"), 30 * (c("k") % 4)).cast("int"),
        "late_payments_12m": c("late"),
        "payment_history_pct": (F.lit(50) + (c("k") * 11) % 51) / 1e2,
        "total_payments_made": ((c("k") * 17) % c("term")).cast("int"),
        "is_default": c("def"),
        "risk_category": lending.risk_category(c("def"), c("dpd"), c("score"), c("late")),
        "estimated_lgd": F.when(c("def") == 1, (F.lit(40) + c("k") % 31) / 1e2).otherwise(F.lit(0.0)),
        "ltv_ratio": F.floor(c("amt") * 1e2 / (c("inc") * 12)) / 1e2,
        "dti_ratio": F.floor((c("emi") + c("oemi")) * 1e2 / c("inc")) / 1e2,
    }
    return base.select(*[columns[name].alias(name) for name in LOAN_COLUMNS], *carry)


def loan_number(column: str = "loan_id"):
    return F.substring(column, 5, 20).cast("bigint")


def dirty_loans(clean: DataFrame) -> DataFrame:
    """The portfolio with known faults planted by loan number."""
    k = loan_number()
    null = F.lit(None)
    faults = {
        "customer_id": F.when(k % 97 == 1, null).otherwise(c("customer_id")),
        "loan_id": F.when(k % 137 == 9, null).otherwise(c("loan_id")),
        "loan_amount": F.when(k % 101 == 2, null).when(k % 103 == 3, 0).otherwise(c("loan_amount")),
        "credit_score": F.when(k % 109 == 5, null).when(k % 107 == 4, 950).otherwise(c("credit_score")),
        "current_dpd": F.when(k % 113 == 6, -1).otherwise(c("current_dpd")),
        "application_date": F.when(k % 131 == 8, F.lit("2030-01-01").cast("date")).otherwise(c("application_date")),
        "disbursement_date": F.when(k % 127 == 7, F.date_sub("application_date", 1)).otherwise(
            c("disbursement_date")
        ),
        "monthly_income": F.when(k % 139 == 10, 0).otherwise(c("monthly_income")),
    }
    return clean.select(*[faults.get(n, c(n)).alias(n) for n in clean.columns])


def second_batch(first: DataFrame) -> DataFrame:
    """Resent, changed and new loans that follow a first delivery."""
    k = loan_number()
    part = F.when(k % 10 == 0, "resent").when(k % 10 == 1, "changed").when(k % 50 == 2, "new")
    tagged = first.withColumns({"_part": part, "_k": k}).where("_part IS NOT NULL")
    return tagged.withColumns(
        {
            "current_dpd": F.when(c("_part") == "changed", c("current_dpd") + 30).otherwise(c("current_dpd")),
            "loan_id": F.when(c("_part") == "new", padded_key("LOAN", c("_k") + 10_000_000)).otherwise(c("loan_id")),
        }
    ).drop("_part", "_k")

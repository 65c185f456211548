"""Executive profit-and-loss statements (PJ-09).

The reference states six SQL statements that repeat the same sale/refund
aggregate four times and scan the ledger once per rule.  Here the statements
share two one-row aggregates:

* ``sales_purchase``: one pass over the service fare fact with four
  conditional sums (AG-01);
* ``ledger_summary``: one pass over the ledger with one conditional sum per
  category rule (AG-03) -- incentive, expense and EBITDA expense.

Each statement is then a projection of those one-row frames set side by side
(JN-08, the reference's CROSS JOIN, done as a union folded by ``max``), so the
whole P&L costs one scan of each fact.  A rule with no
matching row keeps SQL's NULL (``sum`` over nothing), so profit is NULL then,
as in the reference.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PnlParams:
    # Fixed values of the reference statements.
    period_start: str = "2025-07-01"
    period_end: str = "2025-07-31"
    sale_record_type: int = 1
    refund_record_type: int = 2
    sale_side_status: int = 2
    refund_side_status: int = 4
    incentive_code: str = "300105"
    expense_code: str = "421023"
    excluded_doc_codes: tuple = ("INV", "RF")
    incentive_category: int = 9
    ebitda_excluded_categories: tuple = (9, 10, 11, 12)


def join_fare_service(fare: DataFrame, service: DataFrame) -> DataFrame:
    """Composite-key join of fare and service facts (JN-03)."""
    return fare.join(
        service.withColumnRenamed("service_type_id", "_svc_type"),
        (fare["fare_id"] == F.col("cus_base_fare_id"))
        & (fare["service_type_id"] == F.col("_svc_type")),
        "inner").drop("_svc_type")


def gmv_term() -> Column:
    """customer_price + deal_discount - customer_tax - rounding_amount (D-12)."""
    return (F.col("customer_price") + F.col("deal_discount")
            - F.col("customer_tax") - F.col("rounding_amount"))


def purchase_term() -> Column:
    """supplier_amount - supplier_tax (D-12)."""
    return F.col("supplier_amount") - F.col("supplier_tax")


def _between(c: Column, lo: str, hi: str) -> Column:
    # BETWEEN against date literals: the literals are cast to the column's own
    # type, so on a timestamp the upper bound is midnight and 10:00 on the
    # last day is outside, as in SQL (FP-06).
    return c.between(F.lit(lo), F.lit(hi))


def sales_purchase(service_fare: DataFrame, supp_doc: DataFrame,
                   service_dim: DataFrame, service_type_dim: DataFrame,
                   p: PnlParams = PnlParams()) -> DataFrame:
    """One row: gmv_sale, gmv_refund, purchase_sale, purchase_refund.

    ``service_fare`` holds the fare and service columns already joined (see
    ``join_fare_service``).  The two dimensions are joined only to require a
    match (JN-09); their size is checked at run time by adaptive execution,
    which turns the join into a broadcast when they are small.
    """
    doc = supp_doc.select(
        "supp_doc_no_id", "service_id",
        F.col("last_action").alias("doc_last_action"),
        "sys_sale_side_status", "sys_refund_side_status", "sale_date", "refund_date")
    rt = F.col("record_type")
    joined = (service_fare
              .join(doc, service_fare["ta_supp_doc_no_id"] == doc["supp_doc_no_id"])
              .join(service_dim.select("service_id"), "service_id")
              .join(service_type_dim.select("service_type_id"), "service_type_id"))
    window = (
        (F.col("doc_last_action") != 0) & (F.col("last_action") != 0)
        & (((rt == p.sale_record_type) & (F.col("sys_sale_side_status") == p.sale_side_status)
            & _between(F.col("sale_date"), p.period_start, p.period_end))
           | ((rt == p.refund_record_type) & (F.col("sys_refund_side_status") == p.refund_side_status)
              & _between(F.col("refund_date"), p.period_start, p.period_end))))
    sale = rt == p.sale_record_type
    refund = rt == p.refund_record_type
    zero = F.lit(0)
    return joined.filter(window).agg(
        F.sum(F.when(sale, gmv_term()).otherwise(zero)).alias("gmv_sale"),
        F.sum(F.when(refund, gmv_term()).otherwise(zero)).alias("gmv_refund"),
        F.sum(F.when(sale, purchase_term()).otherwise(zero)).alias("purchase_sale"),
        F.sum(F.when(refund, purchase_term()).otherwise(zero)).alias("purchase_refund"),
    )


def _ledger(transactions: DataFrame, chart: DataFrame, documents: DataFrame,
            glcode: DataFrame, p: PnlParams) -> DataFrame:
    tx = transactions.filter(_between(F.col("transaction_date"), p.period_start, p.period_end))
    return (tx.join(chart.select("ac_chart_of_ac_id", "code"),
                    tx["ac_main_ledger_id"] == chart["ac_chart_of_ac_id"])
            .join(documents.select("ba_documents_id", "doc_no_code_part"), "ba_documents_id")
            .join(glcode.select("ac_chart_of_ac_id", "category"), "ac_chart_of_ac_id"))


def _signed_amount() -> Column:
    return -F.col("base_cur_amount") * F.col("dr_or_cr")


def _code_rule(code: str, p: PnlParams) -> Column:
    # NOT IN drops a NULL document code (unknown), as in SQL (FP-08).
    return (F.col("code") == code) | ~F.col("doc_no_code_part").isin(*p.excluded_doc_codes)


def incentive_by_code(transactions: DataFrame, chart: DataFrame, documents: DataFrame,
                      glcode: DataFrame, p: PnlParams = PnlParams()) -> DataFrame:
    """Incentive and other mapping, grouped by account code (AG-02)."""
    return (_ledger(transactions, chart, documents, glcode, p)
            .filter((F.col("category") == p.incentive_category) & _code_rule(p.incentive_code, p))
            .groupBy("code")
            .agg(F.sum(_signed_amount()).alias("incentive_amount")))


def ledger_summary(transactions: DataFrame, chart: DataFrame, documents: DataFrame,
                   glcode: DataFrame, p: PnlParams = PnlParams()) -> DataFrame:
    """One row: incentive_amount, total_expense, ebitda_expense (AG-03), one scan."""
    cat = F.col("category")
    incentive = (cat == p.incentive_category) & _code_rule(p.incentive_code, p)
    expense = (cat != p.incentive_category) & _code_rule(p.expense_code, p)
    ebitda = ~cat.isin(*p.ebitda_excluded_categories) & _code_rule(p.expense_code, p)
    amt = _signed_amount()
    return _ledger(transactions, chart, documents, glcode, p).agg(
        F.sum(F.when(incentive, amt)).alias("incentive_amount"),
        F.sum(F.when(expense, amt)).alias("total_expense"),
        F.sum(F.when(ebitda, amt)).alias("ebitda_expense"),
    )


def one_row(*frames: DataFrame) -> DataFrame:
    """Side by side combination of one-row aggregates (JN-08) without a join.

    The frames are stacked by name and folded with ``max`` per column: each
    column has exactly one non-NULL source row, and a figure that is NULL
    (a rule matching no row) stays NULL.
    """
    stacked = frames[0]
    for f in frames[1:]:
        stacked = stacked.unionByName(f, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def summary(sp: DataFrame, ledger: DataFrame) -> DataFrame:
    """All P&L figures in one row (AG-04..AG-07); both inputs are one row."""
    gmv = F.col("gmv_sale") - F.col("gmv_refund")
    purchase = F.col("purchase_sale") - F.col("purchase_refund")
    op_rev = gmv - purchase
    total_rev = op_rev + F.col("incentive_amount")
    return one_row(sp, ledger).select(
        gmv.alias("gmv"), purchase.alias("purchase"), op_rev.alias("operational_revenue"),
        F.col("incentive_amount"), total_rev.alias("total_revenue"),
        F.col("total_expense"), (total_rev + F.col("total_expense")).alias("net_profit"),
        F.col("ebitda_expense"), (total_rev + F.col("ebitda_expense")).alias("ebitda"),
    )


def as_double(df: DataFrame) -> DataFrame:
    """Money is summed exactly in DECIMAL, reported as double."""
    return df.select([F.col(c).cast("double").alias(c) for c in df.columns])


# The six statements of the reference, as projections of ``summary``.
def gmv_statement(sp: DataFrame) -> DataFrame:
    """Total sales, total purchase and operational revenue: needs only ``sales_purchase``."""
    gmv = F.col("gmv_sale") - F.col("gmv_refund")
    purchase = F.col("purchase_sale") - F.col("purchase_refund")
    return as_double(sp.select(gmv.alias("gmv"), purchase.alias("purchase"),
                               (gmv - purchase).alias("operational_revenue")))


def total_revenue_statement(s: DataFrame) -> DataFrame:
    return as_double(s.select(F.col("gmv").alias("total_gmv"), F.col("purchase").alias("total_purchase"),
                              "operational_revenue", "incentive_amount", "total_revenue"))


def expense_statement(ledger: DataFrame) -> DataFrame:
    """Total expense: needs only ``ledger_summary``."""
    return as_double(ledger.select(F.col("total_expense").alias("expense")))


def net_profit_statement(s: DataFrame) -> DataFrame:
    return as_double(s.select("total_revenue", "total_expense", "net_profit"))


def ebitda_statement(s: DataFrame) -> DataFrame:
    return as_double(s.select("total_revenue", F.col("ebitda_expense").alias("total_expense"),
                              F.col("ebitda").alias("ebitda")))


def as_double_cols(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select([F.col(c).cast("double").alias(c) if c in cols else F.col(c)
                      for c in df.columns])

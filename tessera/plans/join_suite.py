"""Twenty business questions, five for each of four subjects, by kind of join."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import joins as J

Get = Callable[[str], DataFrame]


# Retail
def qa1(t: Get) -> DataFrame:
    """All purchases with the customer who made them."""
    return J.inner(t("retail_orders"), t("retail_customers"), "customer_id").select("name", "order_id", "amount")


def qa2(t: Get) -> DataFrame:
    """All customers and any orders they placed."""
    return J.keep_right(t("retail_orders"), t("retail_customers"), "customer_id").select("order_id", "name")


def qa3(t: Get) -> DataFrame:
    """Whether each order was returned; an order returned in parts appears once per part."""
    return J.exists_flag(t("retail_orders"), t("retail_returns"), "order_id", "is_returned").select("order_id", "is_returned")


def qa4(t: Get) -> DataFrame:
    """Returned orders and who made them."""
    returned = J.chain(t("retail_returns"), (t("retail_orders"), "order_id"), (t("retail_customers"), "customer_id"))
    return returned.select("name", "order_id", "return_date")


def qa5(t: Get) -> DataFrame:
    """Customers who never made a purchase."""
    return J.anti(t("retail_customers"), t("retail_orders"), "customer_id").select("name")


# Healthcare
def _visits(t: Get) -> DataFrame:
    return J.chain(t("visits"), (t("patients"), "patient_id"), (t("providers"), "provider_id"))


def qb1(t: Get) -> DataFrame:
    """Each visit with its patient and provider."""
    return _visits(t).select("patient_name", "provider_name", "visit_date")


def qb2(t: Get) -> DataFrame:
    """All patients and any visits they had."""
    return J.keep_left(t("patients"), t("visits"), "patient_id").select("patient_name", "visit_id")


def qb3(t: Get) -> DataFrame:
    """All providers and any visits they handled."""
    return J.keep_left(t("providers"), t("visits"), "provider_id").select("provider_name", "visit_id")


def qb4(t: Get) -> DataFrame:
    """Patients who never had a visit."""
    return J.anti(t("patients"), t("visits"), "patient_id").select("patient_name")


def qb5(t: Get) -> DataFrame:
    """Visits handled by cardiology providers."""
    return _visits(t).filter(F.col("specialty") == "Cardiology").select("patient_name", "provider_name", "visit_date")


# Manufacturing quality
def qc1(t: Get) -> DataFrame:
    """Batches and their test results."""
    return J.inner(t("batches"), t("quality_tests"), "batch_id").select("batch_id", "test_type", "result_type")


def qc2(t: Get) -> DataFrame:
    """All batches, also those without tests."""
    return J.keep_left(t("batches"), t("quality_tests"), "batch_id").select("batch_id", "test_type", "result_type")


def qc3(t: Get) -> DataFrame:
    """Batches with both a failed test and a deviation."""
    failed = t("quality_tests").filter(F.col("result_type") == "Fail")
    return J.has_all(t("batches").distinct(), [failed, t("deviations")], "batch_id")


def qc4(t: Get) -> DataFrame:
    """Number of tests and of deviations per batch."""
    return J.counts_per_key(
        t("batches"), "batch_id", test_count=(t("quality_tests"), "test_id"), deviation_count=(t("deviations"), "deviation_id")
    )


def qc5(t: Get) -> DataFrame:
    """Batches without deviations."""
    return J.anti(t("batches"), t("deviations"), "batch_id").select("batch_id")


# Marketing
def qd1(t: Get) -> DataFrame:
    """All sends with the customer's address."""
    return J.inner(t("campaign_sends"), t("mkt_customers"), "customer_id").select("email", "campaign_id", "send_date")


def qd2(t: Get) -> DataFrame:
    """Whether each send was clicked."""
    return J.exists_flag(t("campaign_sends"), t("clicks"), "send_id", "clicked").select("send_id", "clicked")


def qd3(t: Get) -> DataFrame:
    """All customers and any campaigns they received."""
    return J.keep_left(t("mkt_customers"), t("campaign_sends"), "customer_id").select("email", "campaign_id")


def qd4(t: Get) -> DataFrame:
    """Sends that were never clicked."""
    return J.anti(t("campaign_sends"), t("clicks"), "send_id").select("send_id")


def qd5(t: Get) -> DataFrame:
    """Customers who never received a campaign."""
    return J.anti(t("mkt_customers"), t("campaign_sends"), "customer_id").select("email")


QUESTIONS: dict[str, Callable[[Get], DataFrame]] = {
    f.__name__: f for f in (qa1, qa2, qa3, qa4, qa5, qb1, qb2, qb3, qb4, qb5, qc1, qc2, qc3, qc4, qc5, qd1, qd2, qd3, qd4, qd5)
}

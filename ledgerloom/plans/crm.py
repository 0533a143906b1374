"""CRM marts: accounts, opportunities and the governed alert feed."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.datasets import Datasets, model

# --- fixed values: alert rule ---------------------------------------------------
HIGH_VALUE_OPEN_AMOUNT = Decimal("100000")
# ------------------------------------------------------------------------------


@model("dim_accounts", materialized="table")
def dim_accounts(ds: Datasets) -> DataFrame:
    a = ds["stg_crm_accounts"]
    u = ds["stg_crm_users"].select(F.col("user_id").alias("owner_id"),
                                   F.col("user_name").alias("account_owner"))
    return a.join(u, "owner_id", "left").select(
        "account_id", "account_name", "account_type", "industry", "annual_revenue",
        "number_of_employees", "billing_country", "owner_id", "account_owner",
        "created_date",
    )


@model("fct_opportunities", materialized="table")
def fct_opportunities(ds: Datasets) -> DataFrame:
    o = ds["stg_crm_opportunities"]
    a = ds["stg_crm_accounts"].select("account_id", "account_name")
    if ds.parts("customer"):    # too many to broadcast: a task holds its accounts, no opportunity is sorted
        a = a.hint("shuffle_hash")
    u = ds["stg_crm_users"].select(F.col("user_id").alias("owner_id"),
                                   F.col("user_name").alias("opportunity_owner"))
    return (
        o.join(a, "account_id", "left")
        .join(u, "owner_id", "left")
        .select(
            "opportunity_id", "account_id", "account_name", "opportunity_name", "stage_name",
            "amount", "close_date", "probability", "is_closed", "is_won",
            "opportunity_type", "lead_source", "owner_id", "opportunity_owner",
            (F.col("amount") * F.col("probability") / 100).cast("decimal(18,2)")
            .alias("weighted_amount"),
            "created_date",
        )
    )


@model("opportunity_states", materialized="ephemeral")
def opportunity_states(ds: Datasets) -> DataFrame:
    """What an opportunity adds to the open pipeline from a day on: its amount, then 0 once closed."""
    o = ds["fct_opportunities"]
    opened = F.struct(F.col("created_date").alias("state_date"), F.lit(0).alias("state_order"),
                      F.col("amount").alias("open_amount"))
    closed = F.struct(F.greatest("created_date", "close_date").alias("state_date"),
                      F.lit(1).alias("state_order"),
                      F.lit(0).cast("decimal(18,2)").alias("open_amount"))
    return o.select("opportunity_id", "account_id", "lead_source", "opportunity_owner", F.inline(
        F.when(F.col("is_closed"), F.array(opened, closed)).otherwise(F.array(opened))))


@model("crm_opportunity_alerts", materialized="table")
def crm_opportunity_alerts(ds: Datasets) -> DataFrame:
    """Open opportunities that are large (>= 100k) or overdue as of ``ds.as_of``.

    The high-value test comes first, so a large overdue deal is reported as
    ``high_value_open``.
    """
    o = ds["fct_opportunities"]
    big = F.col("amount") >= F.lit(HIGH_VALUE_OPEN_AMOUNT).cast("decimal(18,2)")
    overdue = F.col("close_date") < ds.as_of_col()
    return o.filter(~F.col("is_closed") & (big | overdue)).select(
        "opportunity_id", "account_id", "account_name", "opportunity_name",
        "opportunity_owner", "stage_name", "amount", "close_date",
        F.when(big, F.lit("high_value_open")).otherwise(F.lit("overdue_open")).alias("alert_reason"),
    )

"""Typed catalog of the tables. Money and ratios are DECIMAL: sums of them are exact,
so results do not change with the order in which tasks finish."""

from __future__ import annotations

from pyspark.sql import types as T

_MONEY = T.DecimalType(18, 2)
# Sums of eight digits stay within a machine word.
_RATIO = T.DecimalType(8, 6)
_VOLUME = T.DecimalType(18, 4)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


ACCOUNTS = _table(
    account_id=T.StringType(),
    company_name=T.StringType(),
    plan_tier=T.StringType(),
    mrr=_MONEY,
    arr=_MONEY,
    seats_licensed=T.IntegerType(),
    employee_count=T.IntegerType(),
    contract_start_date=T.DateType(),
    contract_end_date=T.DateType(),
    renewal_months=T.IntegerType(),
    industry=T.StringType(),
    region=T.StringType(),
    csm_assigned=T.StringType(),
    churned=T.IntegerType(),
    churn_date=T.DateType(),
)

USAGE_METRICS = _table(
    account_id=T.StringType(),
    month=T.DateType(),
    logins=T.LongType(),
    active_users=T.IntegerType(),
    seats_licensed=T.IntegerType(),
    active_user_ratio=_RATIO,
    features_used=T.IntegerType(),
    total_features=T.IntegerType(),
    feature_adoption_pct=_RATIO,
    data_processed_gb=_VOLUME,
    api_calls=T.LongType(),
    has_api_integration=T.IntegerType(),
)

SUPPORT_TICKETS = _table(
    ticket_id=T.StringType(),
    account_id=T.StringType(),
    created_date=T.DateType(),
    category=T.StringType(),
    priority=T.StringType(),
    resolution_hours=T.IntegerType(),
    csat_score=T.DoubleType(),
)

NPS_SURVEYS = _table(
    account_id=T.StringType(),
    survey_date=T.DateType(),
    quarter=T.StringType(),
    nps_score=T.IntegerType(),
    respondent_role=T.StringType(),
)

MODEL_COMPARISON = _table(
    model=T.StringType(),
    roc_auc=T.DoubleType(),
    average_precision=T.DoubleType(),
    f1=T.DoubleType(),
    precision=T.DoubleType(),
    recall=T.DoubleType(),
    cv_roc_auc_mean=T.DoubleType(),
    cv_roc_auc_std=T.DoubleType(),
)

# The order warehouse. Declared, so opening a table reads no file footers.
WAREHOUSE_TABLES = {
    "region": _table(r_regionkey=T.IntegerType(), r_name=T.StringType()),
    "nation": _table(
        n_nationkey=T.IntegerType(), n_name=T.StringType(), n_regionkey=T.IntegerType()
    ),
    "customer": _table(
        c_custkey=T.LongType(),
        c_name=T.StringType(),
        c_nationkey=T.IntegerType(),
        c_acctbal=T.DoubleType(),
        c_mktsegment=T.StringType(),
    ),
    "orders": _table(
        o_orderkey=T.LongType(),
        o_custkey=T.LongType(),
        o_orderstatus=T.StringType(),
        o_totalprice=T.DoubleType(),
        o_orderdate=T.TimestampNTZType(),
        o_orderpriority=T.StringType(),
    ),
    "lineitem": _table(
        l_orderkey=T.LongType(),
        l_partkey=T.LongType(),
        l_suppkey=T.LongType(),
        l_linenumber=T.IntegerType(),
        l_quantity=T.DoubleType(),
        l_extendedprice=T.DoubleType(),
        l_discount=T.DoubleType(),
        l_tax=T.DoubleType(),
        l_returnflag=T.StringType(),
        l_linestatus=T.StringType(),
        l_shipdate=T.TimestampNTZType(),
    ),
}

RAW_TABLES = {
    "accounts": ACCOUNTS,
    "usage_metrics": USAGE_METRICS,
    "support_tickets": SUPPORT_TICKETS,
    "nps_surveys": NPS_SURVEYS,
}

# The features in model-vector order.
BASE_FEATURES = (
    "mrr",
    "arr",
    "seats_licensed",
    "employee_count",
    "tenure_days",
    "days_until_renewal",
    "mrr_per_seat",
    "plan_tier_encoded",
)
USAGE_FEATURES = (
    "avg_monthly_logins",
    "avg_active_user_ratio",
    "avg_feature_adoption_pct",
    "avg_data_processed_gb",
    "total_api_calls",
    "has_api_integration",
    "login_trend_pct",
    "logins_mom_change",
)
SUPPORT_FEATURES = (
    "avg_resolution_hours",
    "avg_csat_score",
    "pct_high_critical_tickets",
    "tickets_last_90d",
    "days_since_last_ticket",
    "days_since_critical_ticket",
    "ticket_velocity_ratio",
)
NPS_FEATURES = ("last_nps_score", "nps_trend", "avg_nps_score", "nps_response_count")
REGIONS = ("APAC", "EMEA", "NA")


def feature_names(regions=REGIONS) -> list[str]:
    """Feature columns in order; the region dummies follow the region list."""
    dummies = [f"region_{name}" for name in sorted(regions)]
    return [*BASE_FEATURES, *dummies, *USAGE_FEATURES, *SUPPORT_FEATURES, *NPS_FEATURES]


def features_schema(regions=REGIONS, id_type: T.DataType | None = None) -> T.StructType:
    """Schema of a stored feature table."""
    columns = {"account_id": id_type or T.StringType()}
    columns.update({name: T.DoubleType() for name in feature_names(regions)})
    columns["churned"] = T.IntegerType()
    return _table(**columns)

"""Queries for sources, filters, projections and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayline.checks.registry import check
from stayline.checks.shared import comparison, evaluated, predictions, scores, survey_features, usage_features
from stayline.checks.sql import ACTION, LABEL, RISK, TIER_CODE, TODAY, big, dbl, query, rnd, score_of
from stayline.functions import scalars as S
from stayline.operators.profile import null_counts, profile
from stayline.operators.shapes import upsert
from stayline.plans import evaluation as E
from stayline.plans import features as P
from stayline.session import ensure_checkpoint_dir
from stayline.sources.schemas import BASE_FEATURES
from stayline.sources.warehouse import REGIONS, SNAPSHOT


# --- sources and sinks -------------------------------------------------------

_FIGURES = 'roc_auc, average_precision, f1, "precision", recall, cv_roc_auc_mean, cv_roc_auc_std'


@check(
    "a6_metric_upsert",
    query(
        f"""SELECT model, {_FIGURES} FROM comparison WHERE model = 'alpha'
        UNION ALL SELECT 'beta', {_FIGURES} FROM comparison WHERE model = 'gamma'
        UNION ALL SELECT model, {_FIGURES} FROM comparison WHERE model = 'gamma'"""
    ),
)
def _(w):
    ensure_checkpoint_dir(w.spark)
    rows = comparison(w).checkpoint()
    existing = rows.where("model in ('alpha', 'beta')")
    third = rows.where("model = 'gamma'")
    existing = upsert(existing, third.withColumn("model", F.regexp_replace("model", "gamma", "beta")), "model")
    return upsert(existing, third, "model")


_NUMERIC = ["mrr", "arr", "seats_licensed", "employee_count", "renewal_months", "churned"]
_CATEGORICAL = ["account_id", "company_name", "plan_tier", "industry", "region", "csm_assigned", "churn_date"]
_DATES = ["contract_start_date", "contract_end_date"]
# The types of the columns as they are stored.
_TYPES = {
    "mrr": "decimal(12,2)", "arr": "decimal(14,2)", "seats_licensed": "int", "employee_count": "int", "renewal_months": "int",
    "churned": "int", "account_id": "bigint", "company_name": "string", "plan_tier": "string", "industry": "string",
    "region": "string", "csm_assigned": "string", "churn_date": "date", "contract_start_date": "date", "contract_end_date": "date",
}


def _profile_sql() -> str:
    parts = [
        f"""SELECT '{c}' AS column_name, count({c}) AS non_null, count(DISTINCT {c}) AS n_distinct,
        (SELECT max(k) FROM (SELECT count({c}) AS k FROM accounts GROUP BY {c})) AS top_frequency,
        NULL AS top_value, {rnd(f"avg({dbl(c)})", 6)} AS mean, {rnd(f"stddev_samp({dbl(c)})", 6)} AS std,
        {dbl(f"min({c})")} AS min, {dbl(f"max({c})")} AS max,
        {rnd(f"quantile_cont({dbl(c)}, 0.25)", 4)} AS q25, {rnd(f"quantile_cont({dbl(c)}, 0.5)", 4)} AS q50,
        {rnd(f"quantile_cont({dbl(c)}, 0.75)", 4)} AS q75, NULL AS first_date, NULL AS last_date FROM accounts"""
        for c in _NUMERIC
    ] + [
        f"""SELECT '{c}', count({c}), count(DISTINCT {c}),
        (SELECT max(k) FROM (SELECT count({c}) AS k FROM accounts GROUP BY {c})),
        (SELECT CAST({c} AS VARCHAR) FROM accounts WHERE {c} IS NOT NULL GROUP BY {c}
         ORDER BY count(*) DESC, CAST({c} AS VARCHAR) LIMIT 1),
        NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM accounts"""
        for c in _CATEGORICAL
    ] + [
        f"""SELECT '{c}', count({c}), count(DISTINCT {c}),
        (SELECT max(k) FROM (SELECT count({c}) AS k FROM accounts GROUP BY {c})),
        NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, CAST(min({c}) AS VARCHAR), CAST(max({c}) AS VARCHAR) FROM accounts"""
        for c in _DATES
    ]
    kinds = ", ".join(f"('{c}', '{t}')" for c, t in _TYPES.items())
    return query(
        f"""SELECT p.*, k.data_type, (SELECT count(*) FROM accounts) AS n_rows, {big(str(len(_TYPES)))} AS n_columns
        FROM ({" UNION ALL ".join(parts)}) p JOIN (VALUES {kinds}) k(name, data_type) ON p.column_name = k.name"""
    )


@check("a7_table_profile", _profile_sql())
def _(w):
    table = profile(w.accounts, _NUMERIC, _CATEGORICAL, _DATES)
    rounded = {c: S.numpy_round(F.col(c), 6) for c in ("mean", "std")}
    quartiles = {c: S.numpy_round(F.col(c), 4) for c in ("q25", "q50", "q75")}
    return table.withColumns({**rounded, **quartiles})


_ACCOUNT_COLUMNS = (
    "account_id company_name plan_tier mrr arr seats_licensed employee_count renewal_months industry region "
    "csm_assigned contract_start_date contract_end_date churned churn_date"
).split()


@check(
    "a8_null_counts",
    query(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null FROM accounts" for c in _ACCOUNT_COLUMNS
        )
        + ") WHERE n_null > 0"
    ),
)
def _(w):
    return null_counts(w.accounts)


# --- filters, predicates, projections ---------------------------------------


@check(
    "b1_snapshot_filter",
    query(
        f"""SELECT 'usage' AS fact, account_id, count(*) AS n FROM usage WHERE month <= {TODAY} GROUP BY 2
        UNION ALL SELECT 'ticket', account_id, count(*) FROM tickets WHERE created_date <= {TODAY} GROUP BY 2
        UNION ALL SELECT 'survey', account_id, count(*) FROM nps WHERE survey_date <= {TODAY} GROUP BY 2"""
    ),
)
def _(w):
    def kept(facts, name, day):
        rows = facts.where(F.col(day) <= F.lit(SNAPSHOT)).groupBy("account_id")
        return rows.agg(F.count(F.lit(1)).alias("n")).withColumn("fact", F.lit(name))

    return (
        kept(w.usage, "usage", "month")
        .unionByName(kept(w.tickets, "ticket", "created_date"))
        .unionByName(kept(w.nps, "survey", "survey_date"))
    )


@check(
    "b2_recent_window_filter",
    query(
        f"""SELECT ticket_id, account_id, CAST(created_date AS VARCHAR) AS created_date FROM tickets
        WHERE created_date <= {TODAY} AND created_date >= {TODAY} - 90"""
    ),
)
def _(w):
    day = F.col("created_date")
    return w.tickets.where((day <= F.lit(SNAPSHOT)) & (day >= F.date_sub(F.lit(SNAPSHOT), 90))).select(
        "ticket_id", "account_id", "created_date"
    )


@check(
    "b3_set_membership",
    query("SELECT ticket_id, account_id, priority FROM tickets WHERE priority IN ('high', 'critical')"),
)
def _(w):
    return w.tickets.where(S.is_one_of(F.col("priority"), S.URGENT_PRIORITIES)).select(
        "ticket_id", "account_id", "priority"
    )


@check(
    "b4_equality_filter",
    query(
        """SELECT 'critical ticket' AS found, ticket_id AS id FROM tickets WHERE priority = 'critical'
        UNION ALL SELECT 'churned account', account_id FROM accounts WHERE churned = 1"""
    ),
)
def _(w):
    tickets = w.tickets.where(F.col("priority") == "critical")
    accounts = w.labels.where(F.col("churned") == 1)
    return tickets.select(F.lit("critical ticket").alias("found"), F.col("ticket_id").alias("id")).unionByName(
        accounts.select(F.lit("churned account").alias("found"), F.col("account_id").alias("id"))
    )


_PICKED = (
    "account_id churned plan_tier mrr arr seats_licensed employee_count industry region "
    "contract_start_date contract_end_date renewal_months"
).split()


def _plain_sql(columns) -> str:
    kinds = {"mrr": dbl, "arr": dbl, "contract_start_date": "date", "contract_end_date": "date", "churn_date": "date"}
    whole = ("churned", "seats_licensed", "employee_count", "renewal_months")

    def item(c):
        kind = kinds.get(c)
        if kind == "date":
            return f"CAST({c} AS VARCHAR) AS {c}"
        if kind:
            return f"{kind(c)} AS {c}"
        return f"{big(c)} AS {c}" if c in whole else c

    return ", ".join(item(c) for c in columns)


@check("b5_column_projection", query(f"SELECT {_plain_sql(_PICKED)} FROM accounts"))
def _(w):
    return w.accounts.select(*_PICKED)


@check(
    "b6_drop_if_present",
    query(f"SELECT {_plain_sql([c for c in _ACCOUNT_COLUMNS if c not in P.HELPERS])} FROM accounts"),
)
def _(w):
    return w.accounts.drop(*P.HELPERS)


@check(
    "b7_reorder_columns",
    query(
        f"""SELECT account_id, {dbl('mrr')} AS mrr, {dbl('arr')} AS arr, {big('seats_licensed')} AS seats_licensed,
        {big('employee_count')} AS employee_count, {big('tenure_days')} AS tenure_days,
        {big('days_until_renewal')} AS days_until_renewal, mrr_per_seat,
        {big('plan_tier_encoded')} AS plan_tier_encoded, {big('churned')} AS churned FROM account_feats"""
    ),
)
def _(w):
    return P.account_features(w.accounts, SNAPSHOT, REGIONS).select("account_id", *BASE_FEATURES, "churned")


@check(
    "b8_rename_aggregate",
    query("SELECT account_id, count(*) AS nps_response_count, max(nps_score) AS best_nps_score FROM nps GROUP BY 1"),
)
def _(w):
    return w.nps.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("nps_response_count"), F.max("nps_score").alias("best_nps_score")
    )


@check(
    "b9_lookup_map",
    query(f"SELECT account_id, {big(TIER_CODE)} AS plan_tier_encoded, {LABEL} AS churn_label FROM accounts"),
)
def _(w):
    return w.accounts.select(
        "account_id",
        S.plan_tier_code(F.col("plan_tier")).alias("plan_tier_encoded"),
        S.churn_label(F.col("churned")).alias("churn_label"),
    )


_FLAGS = ", ".join(f"CAST(region = '{r}' AS BIGINT) AS \"region_{r}\"" for r in REGIONS)


@check("b10_one_hot", query(f"SELECT account_id, {_FLAGS} FROM base"))
def _(w):
    flags = S.one_hot(F.col("region"), REGIONS, "region")
    return w.account_base.select("account_id", *[c.alias(n) for n, c in flags.items()])


@check(
    "b11_indicator",
    query(
        """SELECT ticket_id, CASE WHEN priority IN ('high', 'critical') THEN 1::BIGINT ELSE 0 END AS is_high_critical
        FROM tickets"""
    ),
)
def _(w):
    urgent = S.is_one_of(F.col("priority"), S.URGENT_PRIORITIES)
    return w.tickets.select("ticket_id", S.flag(urgent).alias("is_high_critical"))


@check("b12_risk_bands", query(f"SELECT account_id, churn_proba, {RISK} AS risk_tier FROM scored"))
def _(w):
    return predictions(w).select(
        "account_id", "churn_proba", S.risk_tier(F.col("churn_proba")).alias("risk_tier")
    )


@check(
    "b13_action_rule",
    query(
        f"""SELECT account_id, risk_tier, plan_tier, {ACTION} AS recommended_action FROM scores
        WHERE risk_tier IN ('Critical', 'High')"""
    ),
)
def _(w):
    return (
        scores(w)
        .where(S.is_one_of(F.col("risk_tier"), S.ACTION_TIERS))
        .select(
            "account_id",
            "risk_tier",
            "plan_tier",
            S.recommended_action(F.col("risk_tier"), F.col("plan_tier")).alias("recommended_action"),
        )
    )


@check(
    "b14_ordered_category",
    query(f"SELECT account_id, plan_tier, {big(TIER_CODE)} AS tier_position FROM base ORDER BY 3, 1"),
)
def _(w):
    place = S.category_position(F.col("plan_tier"), S.PLAN_TIERS)
    return w.account_base.select("account_id", "plan_tier", place.alias("tier_position")).orderBy(
        "tier_position", "account_id"
    )


# --- scalar functions --------------------------------------------------------


@check(
    "c1_date_difference",
    query(
        f"""SELECT account_id, {big(f'{TODAY} - contract_start_date')} AS days_since_start,
        {big(f'contract_end_date - {TODAY}')} AS days_until_renewal FROM accounts"""
    ),
)
def _(w):
    return w.accounts.select(
        "account_id",
        S.days_between(F.lit(SNAPSHOT), F.col("contract_start_date")).alias("days_since_start"),
        S.days_between(F.col("contract_end_date"), F.lit(SNAPSHOT)).alias("days_until_renewal"),
    )


@check(
    "c2_clip_lower",
    query(
        f"""SELECT account_id, {big('greatest(seats_licensed, 1)')} AS seats,
        {big(f'CASE WHEN contract_start_date IS NOT NULL THEN greatest({TODAY} - contract_start_date, 0) END')} AS tenure
        FROM accounts"""
    ),
)
def _(w):
    tenure = S.days_between(F.lit(SNAPSHOT), F.col("contract_start_date"))
    return w.accounts.select(
        "account_id",
        S.clip_lower(F.col("seats_licensed"), 1).alias("seats"),
        S.clip_lower(tenure, 0).alias("tenure"),
    )


@check(
    "c3_date_minus_days",
    query("SELECT ticket_id, CAST(created_date - 90 AS VARCHAR) AS window_start FROM tickets"),
)
def _(w):
    return w.tickets.select("ticket_id", F.date_sub("created_date", 90).alias("window_start"))


@check(
    "c4_rounding",
    query(
        "SELECT account_id, "
        + ", ".join(f"{rnd('CAST(mrr AS DOUBLE) / 8', d)} AS round_{d}" for d in (0, 2, 3, 4))
        + " FROM base"
    ),
)
def _(w):
    value = F.col("mrr").cast("double") / 8
    return w.account_base.select(
        "account_id", *[S.numpy_round(value, d).alias(f"round_{d}") for d in (0, 2, 3, 4)]
    )


@check(
    "c5_column_ratio",
    query("SELECT account_id, CAST(mrr AS DOUBLE) / nullif(seats_licensed, 0) AS mrr_per_seat FROM base"),
)
def _(w):
    return w.account_base.select(
        "account_id", S.ratio(F.col("mrr"), F.col("seats_licensed")).alias("mrr_per_seat")
    )


@check(
    "c6_ticket_velocity",
    query(
        f"""SELECT t.account_id, {rnd("tickets_last_90d::DOUBLE / ((total_tickets::DOUBLE / greatest(months_observed, 1)) * 3 + 1e-3)", 3)}
        AS ticket_velocity_ratio FROM ticket_feats t JOIN usage_aggs u ON t.account_id = u.account_id"""
    ),
)
def _(w):
    tickets = P.ticket_features(w.tickets, SNAPSHOT)
    usage = usage_features(w).select("account_id", "months_observed")
    velocity = P.ticket_velocity(F.col("tickets_last_90d"), F.col("total_tickets"), F.col("months_observed"))
    return tickets.join(usage, "account_id").select("account_id", velocity.alias("ticket_velocity_ratio"))


@check(
    "c7_expected_loss",
    query(f"SELECT account_id, {rnd(f'{score_of(7919)} * CAST(arr AS DOUBLE)', 0)} AS arr_at_risk FROM base"),
)
def _(w):
    joined = predictions(w).join(w.account_base.select("account_id", "arr"), "account_id")
    return joined.select(
        "account_id", S.expected_loss(F.col("churn_proba"), F.col("arr")).alias("arr_at_risk")
    )


@check(
    "c8_f1_score",
    query(
        """SELECT threshold, 2 * ((tp::DOUBLE / (tp + fp)) * (tp::DOUBLE / n_pos))
        / (tp::DOUBLE / (tp + fp) + tp::DOUBLE / n_pos + 1e-9) AS f1 FROM curve"""
    ),
)
def _(w):
    return E.f1_by_threshold(evaluated(w)).select("threshold", "f1")


@check(
    "c9_null_fill",
    query(
        """SELECT a.account_id, coalesce(days_since_critical_ticket, 999) AS days_since_critical_ticket,
        coalesce(last_nps_score, 5) AS last_nps_score, coalesce(nps_response_count, 0) AS nps_response_count
        FROM base a LEFT JOIN ticket_feats t ON a.account_id = t.account_id
        LEFT JOIN nps_feats n ON a.account_id = n.account_id"""
    ),
)
def _(w):
    joined = (
        w.account_base.select("account_id")
        .join(P.ticket_features(w.tickets, SNAPSHOT), "account_id", "left")
        .join(survey_features(w), "account_id", "left")
    )
    return P.fill_nps(P.fill_tickets(joined)).select(
        "account_id", "days_since_critical_ticket", "last_nps_score", "nps_response_count"
    )


@check(
    "c10_presentation",
    query(
        """SELECT account_id, format('${:,d}', CAST(round_even(CAST(arr AS DOUBLE), 0) AS BIGINT)) AS arr_text,
        churn_proba * 100 AS percent FROM scored"""
    ),
)
def _(w):
    return scores(w).select(
        "account_id", S.dollars(F.col("arr")).alias("arr_text"), (F.col("churn_proba") * 100).alias("percent")
    )

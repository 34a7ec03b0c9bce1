"""Queries for aggregations, ordered operators, sorting, top-k and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayline.checks.registry import check
from stayline.checks.shared import evaluated, predictions, rival_figures, scores, survey_features, usage_features
from stayline.checks.sql import big, dbl, mean, query, rnd
from stayline.functions import scalars as S
from stayline.operators.ordering import rank_rows, top_k
from stayline.operators.shapes import best_row
from stayline.plans import eda, evaluation, modeling, scoring
from stayline.plans import features as P
from stayline.sources.warehouse import REGIONS, SNAPSHOT

_CHURN = mean("churned")


@check(
    "f1_group_mean_count",
    query(
        f"SELECT account_id, {rnd(mean('nps_score'), 2)} AS avg_nps_score, count(*) AS nps_response_count FROM nps GROUP BY 1"
    ),
)
def _(w):
    return w.nps.groupBy("account_id").agg(
        S.numpy_round(S.mean_of(F.col("nps_score")), 2).alias("avg_nps_score"),
        F.count(F.lit(1)).alias("nps_response_count"),
    )


@check("f2_usage_aggregates", query("SELECT * FROM usage_aggs"))
def _(w):
    return usage_features(w).drop("login_trend_pct", "logins_mom_change")


@check(
    "f3_ticket_aggregates",
    query(
        f"""SELECT account_id, count(ticket_id) AS total_tickets, {mean('resolution_hours')} AS avg_resolution_h,
        {mean('csat_score')} AS avg_csat FROM tickets GROUP BY 1"""
    ),
)
def _(w):
    return eda.ticket_profile(w.tickets).drop("pct_high_crit")


@check(
    "f4_mean_of_predicate",
    query(
        f"""SELECT account_id, {mean("CASE WHEN priority IN ('high', 'critical') THEN 1 ELSE 0 END")} AS pct_high_crit
        FROM tickets GROUP BY 1"""
    ),
)
def _(w):
    return eda.ticket_profile(w.tickets).select("account_id", "pct_high_crit")


@check(
    "f5_filtered_count",
    query("SELECT account_id, tickets_last_90d FROM ticket_feats"),
)
def _(w):
    return P.ticket_features(w.tickets, SNAPSHOT).select("account_id", "tickets_last_90d")


@check(
    "f6_latest_dates",
    query(
        """SELECT account_id, CAST(max(created_date) AS VARCHAR) AS last_ticket,
        CAST(max(created_date) FILTER (priority = 'critical') AS VARCHAR) AS last_critical
        FROM tickets_seen GROUP BY 1"""
    ),
)
def _(w):
    day = F.col("created_date")
    return (
        w.tickets.where(day <= F.lit(SNAPSHOT))
        .groupBy("account_id")
        .agg(
            F.max(day).alias("last_ticket"),
            F.max(F.when(F.col("priority") == "critical", day)).alias("last_critical"),
        )
    )


@check(
    "f7_churn_overall",
    query(
        """SELECT churn_label, count(*) AS accounts, count(*)::DOUBLE / (SELECT count(*) FROM accounts) AS share
        FROM labelled GROUP BY 1"""
    ),
)
def _(w):
    return eda.churn_overview(w.labels)


@check("f7_churn_rate", query(f"SELECT {_CHURN} AS churn_rate FROM accounts"))
def _(w):
    return eda.churn_rate(w.labels)


@check(
    "f8_churn_by_tier",
    query(
        f"""SELECT CASE plan_tier WHEN 'starter' THEN 0::BIGINT WHEN 'professional' THEN 1 ELSE 2 END AS position,
        plan_tier, count(*) AS accounts, {_CHURN} AS churn_rate FROM accounts GROUP BY 1, 2"""
    ),
)
def _(w):
    return eda.churn_by_tier(w.accounts)


@check("f9_churn_by_region", query(f"SELECT region, {_CHURN} AS churn_rate FROM accounts GROUP BY 1"))
def _(w):
    return eda.churn_by_region(w.accounts)


@check(
    "f10_churn_by_industry",
    query(f"SELECT industry, count(*) AS accounts, {_CHURN} AS churn_rate FROM accounts GROUP BY 1 ORDER BY 3"),
)
def _(w):
    return eda.churn_by_industry(w.accounts)


@check(
    "f11_churn_by_api",
    query(
        f"""SELECT CASE has_api WHEN 1 THEN 'Has API' ELSE 'No API' END AS integration, count(*) AS accounts,
        {rnd(_CHURN, 3)} AS churn_rate FROM accounts a
        JOIN (SELECT account_id, max(has_api_integration) AS has_api FROM usage GROUP BY 1) u
        ON a.account_id = u.account_id GROUP BY 1"""
    ),
)
def _(w):
    return eda.churn_by_api(w.accounts, w.usage)


@check(
    "f12_median_mrr_by_tier",
    query(
        f"""SELECT plan_tier, churn_label, {rnd('median(CAST(mrr AS DOUBLE))', 4)} AS median_mrr,
        CASE plan_tier WHEN 'starter' THEN 0::BIGINT WHEN 'professional' THEN 1 ELSE 2 END AS tier_position
        FROM labelled GROUP BY 1, 2"""
    ),
)
def _(w):
    return eda.median_mrr_by_tier(w.accounts).withColumn(
        "median_mrr", S.numpy_round(F.col("median_mrr"), 4)
    )


@check(
    "f13_median_mrr_by_label",
    query(f"SELECT churn_label, {rnd('median(CAST(mrr AS DOUBLE))', 4)} AS median_mrr FROM labelled GROUP BY 1"),
)
def _(w):
    return eda.median_mrr(w.accounts).withColumn("median_mrr", S.numpy_round(F.col("median_mrr"), 4))


@check(
    "f14_arr_lost",
    query(
        f"""SELECT {dbl('sum(arr)')} AS total_arr, {dbl('sum(arr) FILTER (churned = 1)')} AS lost_arr,
        {dbl('sum(arr) FILTER (churned = 1)')} / {dbl('sum(arr)')} AS lost_share FROM accounts"""
    ),
)
def _(w):
    return eda.arr_lost(w.accounts)


@check(
    "f15_mrr_histogram",
    query(
        """SELECT e.churn_label, CAST(e.bin AS BIGINT) AS bin, e.bin_from,
        count(l.account_id) AS accounts
        FROM (SELECT churn_label, bin, lo + bin * step AS bin_from, lo + (bin + 1) * step AS bin_to, bin = 39 AS closed
              FROM (SELECT churn_label, min(CAST(mrr AS DOUBLE)) AS lo,
                    (max(CAST(mrr AS DOUBLE)) - min(CAST(mrr AS DOUBLE))) / 40 AS step FROM labelled GROUP BY 1),
                   range(40) r(bin)) e
        LEFT JOIN labelled l ON l.churn_label = e.churn_label AND CAST(l.mrr AS DOUBLE) >= e.bin_from
             AND (CAST(l.mrr AS DOUBLE) < e.bin_to OR e.closed) GROUP BY 1, 2, 3"""
    ),
)
def _(w):
    return eda.mrr_histogram(w.accounts)


@check(
    "f16_logins_by_month",
    query(
        f"""SELECT CAST(month AS VARCHAR) AS month, churn_label, {mean('logins')} AS avg_logins FROM usage u
        JOIN labelled l ON u.account_id = l.account_id GROUP BY 1, 2"""
    ),
)
def _(w):
    return eda.logins_by_month(w.usage, w.accounts)


@check(
    "f17_adoption_by_label",
    query(
        f"""SELECT churn_label, {mean('feature_adoption_pct')} AS avg_feature_adoption FROM usage u
        JOIN labelled l ON u.account_id = l.account_id GROUP BY 1"""
    ),
)
def _(w):
    return eda.adoption_by_label(w.usage, w.accounts)


@check(
    "f18_logins_by_churned",
    query(
        f"""SELECT {big('churned')} AS churned, {rnd(mean('logins'), 1)} AS avg_logins FROM usage u
        JOIN accounts a ON u.account_id = a.account_id GROUP BY 1"""
    ),
)
def _(w):
    return eda.logins_by_churned(w.usage, w.accounts)


@check(
    "f19_nps_by_churned",
    query(
        f"""SELECT {big('churned')} AS churned, {rnd(mean('nps_score'), 2)} AS avg_nps FROM nps n
        JOIN accounts a ON n.account_id = a.account_id GROUP BY 1"""
    ),
)
def _(w):
    return eda.nps_by_churned(w.nps, w.accounts)


_MIX = ", ".join(
    f"count(*) FILTER (priority = '{p}')::DOUBLE / count(*) * 100 AS {p}" for p in ("critical", "high", "low", "medium")
)


@check(
    "f20_priority_mix",
    query(
        f"SELECT churn_label, {_MIX} FROM tickets t JOIN labelled l ON t.account_id = l.account_id GROUP BY 1"
    ),
)
def _(w):
    return eda.priority_mix(w.tickets, w.accounts)


@check(
    "f21_mean_of_means",
    query(
        f"""SELECT churn_label, {rnd('avg(avg_csat)', 9)} AS avg_csat, {rnd('avg(pct) * 100', 9)} AS pct_high_critical
        FROM (SELECT account_id, {mean('csat_score')} AS avg_csat,
              {mean("CASE WHEN priority IN ('high', 'critical') THEN 1 ELSE 0 END")} AS pct FROM tickets GROUP BY 1) t
        JOIN labelled l ON t.account_id = l.account_id GROUP BY 1"""
    ),
)
def _(w):
    means = eda.support_by_label(w.tickets, w.accounts)
    return means.select(
        "churn_label", *[S.numpy_round(F.col(c), 9).alias(c) for c in ("avg_csat", "pct_high_critical")]
    )


@check(
    "f22_nps_distribution",
    query(
        """SELECT s.nps_score, count(*) FILTER (churn_label = 'Active') AS active,
        count(*) FILTER (churn_label = 'Churned') AS churned
        FROM (SELECT range AS nps_score FROM range(11)) s LEFT JOIN nps n ON n.nps_score = s.nps_score
        LEFT JOIN labelled l ON n.account_id = l.account_id GROUP BY 1"""
    ),
)
def _(w):
    return eda.nps_distribution(w.nps, w.accounts)


_QUARTERS = ("Q1_1999", "Q2_1999", "Q3_1999", "Q4_1999", "Q1_2000", "Q1_1900")


@check(
    "f23_nps_by_quarter",
    query(
        "SELECT CAST(p AS BIGINT) AS position, n.quarter, churn_label, "
        + f"{mean('nps_score')} AS avg_nps FROM nps n JOIN labelled l ON n.account_id = l.account_id JOIN (VALUES "
        + ", ".join(f"({i}, '{q}')" for i, q in enumerate(_QUARTERS))
        + ") o(p, quarter) ON o.quarter = n.quarter GROUP BY 1, 2, 3"
    ),
)
def _(w):
    return eda.nps_by_quarter(w.nps, w.accounts, _QUARTERS)


_TIER_ROWS = "(VALUES (0::BIGINT, 'Critical'), (1, 'High'), (2, 'Moderate'), (3, 'Low')) t(position, risk_tier)"


@check(
    "f24_risk_tier_summary",
    query(
        f"""SELECT t.position, t.risk_tier, s.accounts, s.total_arr, s.arr_at_risk, s.avg_churn_proba,
        s.arr_at_risk / max(s.arr_at_risk) OVER () AS relative_risk FROM {_TIER_ROWS}
        LEFT JOIN (SELECT risk_tier, count(*) AS accounts, {rnd('sum(arr)', 0)} AS total_arr,
                   sum(arr_at_risk) AS arr_at_risk, {rnd('avg(churn_proba)', 9)} AS avg_churn_proba
                   FROM scores GROUP BY 1) s ON s.risk_tier = t.risk_tier"""
    ),
)
def _(w):
    return scoring.tier_summary(scores(w)).withColumn(
        "avg_churn_proba", S.numpy_round(F.col("avg_churn_proba"), 9)
    )


_PORTFOLIO = """SELECT count(*) AS total_accounts, CAST(sum(arr) AS DOUBLE) AS total_arr,
    count(*) FILTER (risk_tier = 'Critical') AS critical_accounts, count(*) FILTER (risk_tier = 'High') AS high_accounts,
    sum(arr_at_risk) FILTER (risk_tier IN ('Critical', 'High')) AS arr_at_risk,
    sum(arr_at_risk) FILTER (risk_tier = 'Critical') AS critical_arr_at_risk,
    count(*) FILTER (risk_tier IN ('Critical', 'High')) AS listed_accounts FROM scores"""


@check("f25_portfolio_summary", query(_PORTFOLIO))
def _(w):
    return scoring.portfolio_summary(scores(w))


@check(
    "f26_class_balance",
    query(
        f"""SELECT is_test, count(*) FILTER (churned = 0) AS neg, count(*) FILTER (churned = 1) AS pos,
        {rnd("count(*) FILTER (churned = 0)::DOUBLE / count(*) FILTER (churned = 1)", 2)} AS neg_per_pos,
        count(*) FILTER (churned = 1)::DOUBLE / count(*) AS positive_rate FROM split GROUP BY 1"""
    ),
)
def _(w):
    return evaluation.class_balance(modeling.stratified_split(w.labels), "churned", ["is_test"])


@check(
    "f27_best_model",
    query("SELECT model, f1 FROM rival_figures ORDER BY f1 DESC, position LIMIT 1"),
)
def _(w):
    return best_row(rival_figures(w), "f1", "position", "model")


@check("f28_distinct", query("SELECT DISTINCT plan_tier, churn_label FROM labelled"))
def _(w):
    return eda.with_label(w.accounts).select("plan_tier", "churn_label").distinct()


# --- ordered per-group operators ---------------------------------------------


@check("g1_first_last_trend", query("SELECT account_id, months_observed, login_trend_pct FROM usage_feats"))
def _(w):
    return usage_features(w).select("account_id", "months_observed", "login_trend_pct")


@check("g2_last_two_change", query("SELECT account_id, logins_mom_change FROM usage_feats"))
def _(w):
    return usage_features(w).select("account_id", "logins_mom_change")


@check("g3_last_and_first_value", query("SELECT account_id, last_nps_score, nps_trend FROM nps_feats"))
def _(w):
    return survey_features(w).select("account_id", "last_nps_score", "nps_trend")


@check(
    "g4_share_within_group",
    query(
        """SELECT churn_label, priority, count(*) AS tickets,
        count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY churn_label) AS share
        FROM tickets t JOIN labelled l ON t.account_id = l.account_id GROUP BY 1, 2"""
    ),
)
def _(w):
    return eda.priority_share(w.tickets, w.accounts)


@check("g5_rank_by_position", query("SELECT rank, account_id, arr_at_risk FROM actions"))
def _(w):
    return scoring.action_list(scores(w)).select("rank", "account_id", "arr_at_risk")


@check("g6_cumulative_counts", query("SELECT threshold, pos, neg, tp, fp FROM curve"))
def _(w):
    return evaluation.cumulative_counts(evaluated(w)).drop("n_pos", "n_neg")


# --- sort, top-k, unions -----------------------------------------------------


@check(
    "h1_sort_by_column",
    query("SELECT account_id, churn_proba FROM scored ORDER BY churn_proba DESC, account_id"),
)
def _(w):
    return predictions(w).select("account_id", "churn_proba").orderBy(F.desc("churn_proba"), "account_id")


@check(
    "h2_total_order_rank",
    query(
        """SELECT account_id, arr_at_risk, row_number() OVER (ORDER BY arr_at_risk DESC, account_id) AS rank FROM scores"""
    ),
)
def _(w):
    return rank_rows(
        scores(w).select("account_id", "arr_at_risk"), [F.desc("arr_at_risk"), F.asc("account_id")]
    )


_TOP = "company_name, plan_tier, csm_assigned, churn_proba, risk_tier, arr_at_risk"


@check("h3_top_ten_accounts", query(f"SELECT {_TOP} FROM actions ORDER BY rank LIMIT 10"))
def _(w):
    flagged = scores(w).where(S.is_one_of(F.col("risk_tier"), S.ACTION_TIERS))
    best = top_k(flagged, [F.desc("arr_at_risk"), F.asc("account_id")], 10)
    return best.select(*[c.strip() for c in _TOP.split(",")])


@check(
    "h4_union_of_extremes",
    query(
        """SELECT account_id, arr_at_risk FROM (SELECT account_id, arr_at_risk FROM scores ORDER BY arr_at_risk, account_id LIMIT 15)
        UNION ALL SELECT account_id, arr_at_risk FROM
        (SELECT account_id, arr_at_risk FROM scores ORDER BY arr_at_risk DESC, account_id LIMIT 15)"""
    ),
)
def _(w):
    table = scores(w).select("account_id", "arr_at_risk")
    low = top_k(table, [F.asc("arr_at_risk"), F.asc("account_id")], 15)
    high = top_k(table, [F.desc("arr_at_risk"), F.asc("account_id")], 15)
    return low.unionByName(high)


@check(
    "h5_add_columns",
    query(
        "SELECT account_id, region, plan_tier, "
        + ", ".join(f'"region_{r}"' for r in REGIONS)
        + " FROM account_feats"
    ),
)
def _(w):
    return w.account_base.select("account_id", "region", "plan_tier").withColumns(
        S.one_hot(F.col("region"), REGIONS, "region")
    )

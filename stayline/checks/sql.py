"""SQL building blocks for the comparison queries (DuckDB dialect).

They are written the direct way - row numbers, joins, one subquery per figure - so
that they check the Spark plans instead of repeating them.
"""

from __future__ import annotations

from stayline.sources.warehouse import LABEL_DAYS, REGIONS, SNAPSHOT

TODAY = f"DATE '{SNAPSHOT:%Y-%m-%d}'"


def rnd(value: str, digits: int) -> str:
    """Half-even rounding of the scaled double."""
    if digits == 0:
        return f"round_even(CAST({value} AS DOUBLE), 0)"
    return f"(round_even(CAST({value} AS DOUBLE) * 1e{digits}, 0) / 1e{digits})"


def mean(value: str) -> str:
    return f"(CAST(sum({value}) AS DOUBLE) / nullif(count({value}), 0))"


def dbl(value: str) -> str:
    return f"CAST({value} AS DOUBLE)"


def big(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


TIER_CODE = "CASE plan_tier WHEN 'starter' THEN 0 WHEN 'professional' THEN 1 WHEN 'enterprise' THEN 2 END"
LABEL = "CASE churned WHEN 0 THEN 'Active' WHEN 1 THEN 'Churned' END"
RISK = (
    "CASE WHEN churn_proba >= 0.75 THEN 'Critical' WHEN churn_proba >= 0.5 THEN 'High' "
    "WHEN churn_proba >= 0.25 THEN 'Moderate' ELSE 'Low' END"
)
ACTION = (
    "CASE WHEN risk_tier = 'Critical' AND plan_tier = 'enterprise' THEN 'Executive escalation + QBR within 7 days' "
    "WHEN risk_tier = 'Critical' THEN 'CSM intervention call within 48 hours' "
    "WHEN plan_tier = 'enterprise' THEN 'CSM check-in + usage review this week' "
    "ELSE 'Automated re-engagement sequence + CSM follow-up' END"
)


def score_of(multiplier: int) -> str:
    """The closed-form score: a fixed pattern of the account number, four decimals."""
    return f"(CAST((account_id * {multiplier}) % 10000 AS DOUBLE) / 1e4)"


REGION_FLAGS = ", ".join(
    f"CAST(coalesce(region = '{r}', false) AS BIGINT) AS \"region_{r}\"" for r in REGIONS
)
REGION_NAMES = ", ".join(f'"region_{r}"' for r in REGIONS)

_AUC = """(sum(mid) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2e0)
    / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0))"""
_RIVAL_SCORES = " ".join(f"WHEN '{name}' THEN {score_of(m)}" for name, m in (("alpha", 7919), ("beta", 6271), ("gamma", 4523)))

# name -> (needed blocks, query)
BLOCKS: dict[str, tuple[tuple[str, ...], str]] = {
    "base": (
        (),
        """SELECT c_custkey AS account_id, c_name AS company_name,
        CASE WHEN c_acctbal < 3850 THEN 'starter' WHEN c_acctbal < 7950 THEN 'professional' ELSE 'enterprise' END AS plan_tier,
        CAST(abs(c_acctbal) AS DECIMAL(12,2)) AS mrr,
        CAST(CAST(abs(c_acctbal) AS DECIMAL(12,2)) * 12 AS DECIMAL(14,2)) AS arr,
        c_custkey % 50 AS seats_licensed, c_custkey % 997 AS employee_count,
        CASE WHEN c_custkey % 10 < 7 THEN 12 ELSE 24 END AS renewal_months,
        c_mktsegment AS industry, r_name AS region, n_name AS csm_assigned
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ),
    "span": (
        (),
        f"""SELECT o_custkey AS account_id, min(CAST(o_orderdate AS DATE)) AS contract_start_date,
        max(CASE WHEN CAST(o_orderdate AS DATE) <= {TODAY} THEN CAST(o_orderdate AS DATE) END) AS last_order_date,
        max(CASE WHEN CAST(o_orderdate AS DATE) > {TODAY}
                  AND CAST(o_orderdate AS DATE) <= {TODAY} + {LABEL_DAYS} THEN 1 ELSE 0 END) AS renewed
        FROM orders GROUP BY o_custkey""",
    ),
    "accounts": (
        ("base", "span"),
        f"""SELECT b.*, contract_start_date, contract_start_date + renewal_months * 30 AS contract_end_date,
        1 - coalesce(renewed, 0) AS churned,
        CASE WHEN coalesce(renewed, 0) = 0 THEN last_order_date END AS churn_date
        FROM base b LEFT JOIN span s ON b.account_id = s.account_id""",
    ),
    "labelled": (("accounts",), f"SELECT *, {LABEL} AS churn_label FROM accounts"),
    "usage": (
        (),
        f"""SELECT o_custkey AS account_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
        CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS logins,
        CAST({rnd("CAST(sum(CAST(round_even(l_discount * 100, 0) AS BIGINT)) AS DOUBLE) / (count(*) * 10)", 3)} AS DECIMAL(9,3)) AS active_user_ratio,
        CAST({rnd("CAST(sum(CAST(round_even(l_tax * 100, 0) AS BIGINT)) AS DOUBLE) / (count(*) * 100)", 3)} AS DECIMAL(9,3)) AS feature_adoption_pct,
        CAST({rnd("CAST(sum(CAST(round_even(l_extendedprice * 100, 0) AS BIGINT)) AS DOUBLE) / 100000", 2)} AS DECIMAL(14,2)) AS data_processed_gb,
        count(*) AS api_calls,
        max(CASE WHEN round_even(l_tax * 100, 0) >= 7 THEN 1 ELSE 0 END) AS has_api_integration
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
    ),
    "tickets": (
        (),
        """SELECT o_orderkey AS ticket_id, o_custkey AS account_id, CAST(o_orderdate AS DATE) AS created_date,
        o_orderstatus AS category,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'critical' WHEN '2-HIGH' THEN 'high'
             WHEN '3-MEDIUM' THEN 'medium' ELSE 'low' END AS priority,
        1 + o_orderkey % 72 AS resolution_hours,
        CASE WHEN o_orderstatus <> 'P' THEN 1 + o_orderkey % 5 END AS csat_score
        FROM orders""",
    ),
    "nps": (
        (),
        """SELECT o_custkey AS account_id, CAST(l_shipdate AS DATE) AS survey_date,
        'Q' || quarter(l_shipdate) || '_' || year(l_shipdate) AS quarter,
        CAST(round_even(l_discount * 100, 0) AS BIGINT) AS nps_score
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE l_linenumber = 1 AND l_returnflag = 'R'""",
    ),
    "account_feats": (
        ("accounts",),
        f"""SELECT account_id, churned, plan_tier, mrr, arr, seats_licensed, employee_count, industry, region,
        contract_start_date, contract_end_date, renewal_months,
        CASE WHEN contract_start_date IS NOT NULL THEN greatest({TODAY} - contract_start_date, 0) END AS tenure_days,
        contract_end_date - {TODAY} AS days_until_renewal,
        {rnd("CAST(mrr AS DOUBLE) / greatest(seats_licensed, 1)", 2)} AS mrr_per_seat,
        {TIER_CODE} AS plan_tier_encoded, {REGION_FLAGS}
        FROM accounts""",
    ),
    "usage_seen": (("usage",), f"SELECT * FROM usage WHERE month <= {TODAY}"),
    "usage_numbered": (
        ("usage_seen",),
        """SELECT account_id, month, logins,
        row_number() OVER (PARTITION BY account_id ORDER BY month) AS up,
        row_number() OVER (PARTITION BY account_id ORDER BY month DESC) AS down,
        count(*) OVER (PARTITION BY account_id) AS n FROM usage_seen""",
    ),
    "trend_parts": (
        ("usage_numbered",),
        """SELECT account_id, max(n) AS n, avg(CASE WHEN up <= 3 THEN logins END) AS first_mean,
        avg(CASE WHEN down <= 3 THEN logins END) AS last_mean,
        max(CASE WHEN down = 1 THEN logins END) AS newest, max(CASE WHEN down = 2 THEN logins END) AS previous
        FROM usage_numbered GROUP BY account_id""",
    ),
    "usage_aggs": (
        ("usage_seen",),
        f"""SELECT account_id, {rnd(mean("logins"), 4)} AS avg_monthly_logins,
        {rnd(mean("active_user_ratio"), 4)} AS avg_active_user_ratio,
        {rnd(mean("feature_adoption_pct"), 4)} AS avg_feature_adoption_pct,
        {rnd(mean("data_processed_gb"), 4)} AS avg_data_processed_gb,
        {big("sum(api_calls)")} AS total_api_calls,
        {big("max(has_api_integration)")} AS has_api_integration, count(month) AS months_observed
        FROM usage_seen GROUP BY account_id""",
    ),
    "usage_feats": (
        ("usage_aggs", "trend_parts"),
        f"""SELECT a.*, CASE WHEN n < 4 OR first_mean = 0 THEN 0.0::DOUBLE
             ELSE {rnd("(last_mean - first_mean) / first_mean", 4)} END AS login_trend_pct,
        CASE WHEN n < 2 THEN 0.0::DOUBLE ELSE CAST(newest - previous AS DOUBLE) END AS logins_mom_change
        FROM usage_aggs a JOIN trend_parts t ON a.account_id = t.account_id""",
    ),
    "tickets_seen": (("tickets",), f"SELECT * FROM tickets WHERE created_date <= {TODAY}"),
    "ticket_feats": (
        ("tickets_seen",),
        f"""SELECT account_id, count(ticket_id) AS total_tickets,
        {rnd(mean("resolution_hours"), 3)} AS avg_resolution_hours,
        {rnd(mean("csat_score"), 3)} AS avg_csat_score,
        {rnd(mean("CASE WHEN priority IN ('high', 'critical') THEN 1 ELSE 0 END"), 3)} AS pct_high_critical_tickets,
        count(*) FILTER (created_date >= {TODAY} - 90) AS tickets_last_90d,
        {TODAY} - max(created_date) AS days_since_last_ticket,
        {TODAY} - max(created_date) FILTER (priority = 'critical') AS days_since_critical_ticket
        FROM tickets_seen GROUP BY account_id""",
    ),
    "nps_seen": (("nps",), f"SELECT * FROM nps WHERE survey_date <= {TODAY}"),
    "nps_numbered": (
        ("nps_seen",),
        """SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY survey_date, nps_score) AS up,
        row_number() OVER (PARTITION BY account_id ORDER BY survey_date DESC, nps_score DESC) AS down
        FROM nps_seen""",
    ),
    "nps_feats": (
        ("nps_numbered",),
        f"""SELECT account_id, max(CASE WHEN down = 1 THEN nps_score END) AS last_nps_score,
        CAST(max(CASE WHEN down = 1 THEN nps_score END) - max(CASE WHEN up = 1 THEN nps_score END) AS DOUBLE) AS nps_trend,
        {rnd(mean("nps_score"), 2)} AS avg_nps_score, count(*) AS nps_response_count
        FROM nps_numbered GROUP BY account_id""",
    ),
    "joined": (
        ("account_feats", "usage_feats", "ticket_feats", "nps_feats"),
        """SELECT a.*, u.* EXCLUDE (account_id), t.* EXCLUDE (account_id), n.* EXCLUDE (account_id)
        FROM account_feats a LEFT JOIN usage_feats u ON a.account_id = u.account_id
        LEFT JOIN ticket_feats t ON a.account_id = t.account_id
        LEFT JOIN nps_feats n ON a.account_id = n.account_id""",
    ),
    "features": (
        ("joined",),
        f"""SELECT account_id, CAST(mrr AS DOUBLE) AS mrr, CAST(arr AS DOUBLE) AS arr, seats_licensed, employee_count,
        {big("tenure_days")} AS tenure_days, {big("days_until_renewal")} AS days_until_renewal, mrr_per_seat,
        {big("plan_tier_encoded")} AS plan_tier_encoded, {REGION_NAMES},
        avg_monthly_logins, avg_active_user_ratio, avg_feature_adoption_pct, avg_data_processed_gb,
        total_api_calls, has_api_integration,
        coalesce(login_trend_pct, 0) AS login_trend_pct, coalesce(logins_mom_change, 0) AS logins_mom_change,
        avg_resolution_hours,
        coalesce(avg_csat_score, (SELECT median(avg_csat_score) FROM joined)) AS avg_csat_score,
        coalesce(pct_high_critical_tickets, 0) AS pct_high_critical_tickets,
        coalesce(tickets_last_90d, 0) AS tickets_last_90d,
        coalesce(days_since_last_ticket, 999) AS days_since_last_ticket,
        coalesce(days_since_critical_ticket, 999) AS days_since_critical_ticket,
        CASE WHEN months_observed IS NOT NULL THEN
        {rnd("coalesce(tickets_last_90d, 0)::DOUBLE / ((coalesce(total_tickets, 0)::DOUBLE / greatest(months_observed, 1)) * 3 + 1e-3)", 3)}
        END AS ticket_velocity_ratio,
        coalesce(last_nps_score, 5) AS last_nps_score, coalesce(nps_trend, 0) AS nps_trend,
        coalesce(avg_nps_score, 5) AS avg_nps_score, coalesce(nps_response_count, 0) AS nps_response_count,
        {big("churned")} AS churned FROM joined""",
    ),
    "scored": (
        ("accounts",),
        f"""SELECT account_id, churned, {score_of(7919)} AS churn_proba, company_name, plan_tier, mrr, arr,
        csm_assigned, region, industry, contract_end_date FROM accounts""",
    ),
    "scores": (
        ("scored",),
        f"""SELECT *, {RISK} AS risk_tier, {rnd("churn_proba * CAST(arr AS DOUBLE)", 0)} AS arr_at_risk FROM scored""",
    ),
    "actions": (
        ("scores",),
        f"""SELECT row_number() OVER (ORDER BY arr_at_risk DESC, account_id) AS rank, account_id, company_name,
        plan_tier, csm_assigned, region, CAST(mrr AS DOUBLE) AS mrr, CAST(arr AS DOUBLE) AS arr, churn_proba, risk_tier,
        arr_at_risk, CAST(contract_end_date AS VARCHAR) AS contract_end_date, {ACTION} AS recommended_action
        FROM scores WHERE risk_tier IN ('Critical', 'High')""",
    ),
    "evaluated": (("accounts",), f"SELECT account_id, churned AS label, {score_of(7919)} AS score FROM accounts"),
    "curve": (
        ("evaluated",),
        """SELECT t.threshold, t.n_pos, t.n_neg,
        count(*) FILTER (e.label = 1 AND e.score >= t.threshold) AS tp,
        count(*) FILTER (e.label = 0 AND e.score >= t.threshold) AS fp,
        count(*) FILTER (e.label = 1 AND e.score = t.threshold) AS pos,
        count(*) FILTER (e.label = 0 AND e.score = t.threshold) AS neg
        FROM (SELECT score AS threshold, sum(count(*) FILTER (label = 1)) OVER () AS n_pos,
                     sum(count(*) FILTER (label = 0)) OVER () AS n_neg FROM evaluated GROUP BY score) t
        JOIN evaluated e ON e.score >= t.threshold GROUP BY t.threshold, t.n_pos, t.n_neg""",
    ),
    # Three closed-form scores stand for three models.
    "rivals": (
        ("accounts",),
        f"""SELECT 'alpha' AS model, 1 AS position, churned AS label, {score_of(7919)} AS score FROM accounts
        UNION ALL SELECT 'beta', 2, churned, {score_of(6271)} FROM accounts
        UNION ALL SELECT 'gamma', 3, churned, {score_of(4523)} FROM accounts""",
    ),
    "rival_figures": (
        ("rivals",),
        f"""SELECT model, position, {rnd("r.auc", 3)} AS roc_auc, {rnd("2e0 * tp / (2 * tp + fp + fn)", 3)} AS f1,
        {rnd("tp::DOUBLE / (tp + fp)", 3)} AS "precision", {rnd("tp::DOUBLE / (tp + fn)", 3)} AS recall
        FROM (SELECT model, position, count(*) FILTER (label = 1 AND score >= 0.5) AS tp,
              count(*) FILTER (label = 0 AND score >= 0.5) AS fp,
              count(*) FILTER (label = 1 AND score < 0.5) AS fn FROM rivals GROUP BY model, position) c
        JOIN (SELECT model AS m, (sum(mid) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2e0)
                     / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)) AS auc
              FROM (SELECT model, label, rank() OVER (PARTITION BY model ORDER BY score)
                       + (count(*) OVER (PARTITION BY model, score) - 1) / 2e0 AS mid FROM rivals) GROUP BY model) r
        ON r.m = c.model""",
    ),
    # All seven figures of the comparison table, of the closed-form scores; folds over the training rows.
    "comparison": (
        ("rivals", "split"),
        f"""SELECT c.model, {rnd("h.auc", 3)} AS roc_auc, {rnd("p.ap", 3)} AS average_precision,
        {rnd("2e0 * tp / (2 * tp + fp + fn)", 3)} AS f1, {rnd("tp::DOUBLE / (tp + fp)", 3)} AS "precision",
        {rnd("tp::DOUBLE / (tp + fn)", 3)} AS recall, {rnd("v.mean", 3)} AS cv_roc_auc_mean, {rnd("v.std", 3)} AS cv_roc_auc_std
        FROM (SELECT model, count(*) FILTER (label = 1 AND score > 0.5) AS tp, count(*) FILTER (label = 0 AND score > 0.5) AS fp,
              count(*) FILTER (label = 1 AND score <= 0.5) AS fn FROM rivals GROUP BY model) c
        JOIN (SELECT model, {_AUC} AS auc
              FROM (SELECT model, label, rank() OVER (PARTITION BY model ORDER BY score)
                       + (count(*) OVER (PARTITION BY model, score) - 1) / 2e0 AS mid FROM rivals) GROUP BY model) h ON h.model = c.model
        JOIN (SELECT model, sum(pos::DOUBLE / n_pos * tp / (tp + fp)) AS ap
              FROM (SELECT model, pos, sum(pos) OVER (PARTITION BY model) AS n_pos, sum(pos) OVER upto AS tp, sum(neg) OVER upto AS fp
                    FROM (SELECT model, score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM rivals GROUP BY model, score)
                    WINDOW upto AS (PARTITION BY model ORDER BY score DESC)) GROUP BY model) p ON p.model = c.model
        JOIN (SELECT model, avg(auc) AS mean, stddev_pop(auc) AS std
              FROM (SELECT model, fold, {_AUC} AS auc
                    FROM (SELECT model, fold, label, rank() OVER (PARTITION BY model, fold ORDER BY score)
                             + (count(*) OVER (PARTITION BY model, fold, score) - 1) / 2e0 AS mid
                          FROM (SELECT model, label, fold, CASE model {_RIVAL_SCORES} END AS score
                                FROM (SELECT account_id, churned AS label,
                                      (row_number() OVER (ORDER BY churned, md5(account_id || ':43'), account_id) - 1) % 5 AS fold
                                      FROM split WHERE NOT is_test) CROSS JOIN (VALUES ('alpha'), ('beta'), ('gamma')) m(model)))
                    GROUP BY model, fold) GROUP BY model) v ON v.model = c.model""",
    ),
    "hashed": (
        ("accounts",),
        """SELECT account_id, churned, md5(account_id || ':42') AS h FROM accounts""",
    ),
    "quotas": (
        ("accounts",),
        """SELECT churned, n_class, f + CASE WHEN row_number() OVER (ORDER BY e - f DESC, churned) <= n_test - sum(f) OVER () THEN 1 ELSE 0 END AS quota
        FROM (SELECT churned, n_class, n_test, n_class * n_test / n AS e, floor(n_class * n_test / n) AS f
              FROM (SELECT churned, count(*) AS n_class, sum(count(*)) OVER () AS n,
                    ceil(sum(count(*)) OVER () * 2e-1) AS n_test FROM accounts GROUP BY churned))""",
    ),
    "split": (
        ("hashed", "quotas"),
        """SELECT h.account_id, h.churned,
        row_number() OVER (PARTITION BY h.churned ORDER BY h.h, h.account_id) <= q.quota AS is_test
        FROM hashed h JOIN quotas q ON h.churned = q.churned""",
    ),
}


def query(body: str) -> str:
    """Put the blocks a query names in front of it."""
    import re

    wanted: list[str] = []

    def need(name: str) -> None:
        if name in wanted:
            return
        for other in BLOCKS[name][0]:
            need(other)
        wanted.append(name)

    for name in BLOCKS:
        if re.search(rf"\b(?:FROM|JOIN|,)\s+{name}\b", body):
            need(name)
    heads = ",\n".join(f"{name} AS ({BLOCKS[name][1]})" for name in wanted)
    return f"WITH {heads}\n{body}" if heads else body

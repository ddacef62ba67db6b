"""SQL counterparts of the registered queries, written for DuckDB.

They are formulated independently of the Spark plans: the inactive run comes
from the full account x month grid, the curve metrics from plain windows, and
so on.  ``NODES`` holds named subqueries; a query pulls in those it uses.
"""

from __future__ import annotations

import re

from checks.fixtures import VIEWS, duck
from checks.queries import (
    ASKED_FOR,
    SEGMENTS,
    SHAPES,
    SMALL_RANDOM,
)
from checks.shapes import shaped_sql
from tidewatch.operators.measures import BALANCES
from tidewatch.plans import training as tr
from tidewatch.settings import MODEL_LEVELS, MOVEMENT_LEVELS, PIVOT_MEASURES, SETTLED_CLAIM_STATUSES

MONTHS = range(1, 13)


def q(name: str) -> str:
    return '"' + name + '"'


def text_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def level_case(column: str, levels: dict[str, int]) -> str:
    arms = " ".join(f"WHEN '{n.replace(chr(39), chr(39) * 2)}' THEN {v}" for n, v in levels.items())
    return f"CASE {column} {arms} END"


NODES: dict[str, str] = {name: duck(text) for name, text in VIEWS.items()}

NODES.update(
    accounts="SELECT * FROM customer_master WHERE dealer_group = 'Z001'",
    sales="""
        SELECT * FROM sales_data
        WHERE dealer_code IN (SELECT dealer_code FROM accounts)
          AND indicator_cancel IS NULL AND invoice_type NOT IN ('S1','S2','S3','S4')""",
    ref="""
        SELECT max(invoice_date) AS max_date,
               date_trunc('month', max(invoice_date)) - INTERVAL 1 DAY AS ref FROM sales""",
    closed="SELECT s.* FROM sales s, ref WHERE s.invoice_date <= ref.ref",
    axis="SELECT period, row_number() OVER (ORDER BY period) AS idx FROM (SELECT DISTINCT period FROM closed)",
    grid="""
        SELECT a.dealer_code, m.period AS month, m.idx, coalesce(v.v, 0) AS ndp_value,
               CASE WHEN v.dealer_code IS NULL THEN 1 ELSE 0 END AS no_sales_flag
        FROM (SELECT DISTINCT dealer_code FROM closed) a CROSS JOIN axis m
        LEFT JOIN (SELECT dealer_code, period, sum(ndp_value) AS v FROM closed GROUP BY 1, 2) v
          ON v.dealer_code = a.dealer_code AND v.period = m.period""",
    runs="""
        SELECT dealer_code, count(*) AS n, min(month) AS start
        FROM (SELECT *, idx - row_number() OVER (PARTITION BY dealer_code ORDER BY idx) AS island
              FROM grid WHERE no_sales_flag = 1)
        GROUP BY dealer_code, island""",
    streak="""
        SELECT d.dealer_code, coalesce(r.n, 0) AS max_no_sales_streak, r.start AS max_streak_start_period
        FROM (SELECT DISTINCT dealer_code FROM closed) d
        LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY dealer_code ORDER BY n DESC, start) AS k FROM runs) r
          ON r.dealer_code = d.dealer_code AND r.k = 1""",
    labels="""
        SELECT dealer_code, last_invoice_date, last_billed_days,
               CASE WHEN last_billed_days > 90 THEN 'Churned' ELSE 'Active' END AS churn_status
        FROM (SELECT dealer_code, max(invoice_date) AS last_invoice_date,
                     date_diff('day', max(invoice_date), any_value(ref.ref)) AS last_billed_days
              FROM closed, ref GROUP BY dealer_code)""",
    windows="""
        SELECT *, CAST(threshold_end_date - INTERVAL 12 MONTH AS DATE) AS threshold_start_date
        FROM (SELECT l.*, s.max_no_sales_streak, s.max_streak_start_period,
                     CASE WHEN l.churn_status = 'Active'
                               AND (s.max_streak_start_period IS NULL
                                    OR CAST(s.max_streak_start_period || '-01' AS DATE) <= ref.ref - INTERVAL 1 YEAR)
                          THEN CAST(ref.ref AS DATE)
                          ELSE CAST(s.max_streak_start_period || '-01' AS DATE) END AS threshold_end_date
              FROM labels l JOIN streak s ON s.dealer_code = l.dealer_code, ref)
        WHERE threshold_end_date > DATE '1996-02-01'""",
    wsales="""
        SELECT c.*, w.churn_status, w.last_billed_days, w.threshold_start_date, w.threshold_end_date
        FROM closed c JOIN windows w ON w.dealer_code = c.dealer_code
        WHERE c.invoice_date >= date_trunc('month', w.threshold_start_date)
          AND c.invoice_date <= date_trunc('month', w.threshold_end_date)""",
    intervals="""
        SELECT dealer_code, avg(gap) AS avg_days_between_purchase
        FROM (SELECT dealer_code,
                     date_diff('day', lag(invoice_date) OVER (PARTITION BY dealer_code ORDER BY invoice_date),
                               invoice_date) AS gap FROM wsales)
        GROUP BY dealer_code""",
    ages="""
        SELECT a.*, CAST(floor(date_diff('day', a.creation_date, CAST(ref.ref AS DATE)) / 365.0) AS BIGINT) AS dealership_age
        FROM accounts a, ref""",
    totals="""
        SELECT dealer_code, period AS month, sum(ndp_value) AS total_sales,
               count(DISTINCT invoice_number) AS total_invoices, sum(volume) AS total_units
        FROM wsales GROUP BY 1, 2""",
    monthly="""
        SELECT t.*, t.total_invoices / n.n AS avg_invoices, t.total_sales / n.n AS avg_sales,
               t.total_units / n.n AS avg_units_purchased, a.territory_code, a.dealer_club_category
        FROM totals t LEFT JOIN accounts a ON a.dealer_code = t.dealer_code,
             (SELECT CAST(count(DISTINCT month) AS DOUBLE) AS n FROM totals) n""",
    peers="""
        SELECT m.*,
            avg(total_sales) OVER t AS avg_sales_of_dealers_in_same_territory,
            avg(total_invoices) OVER t AS avg_orders_of_dealers_in_same_territory,
            avg(total_units) OVER t AS avg_units_of_dealers_in_same_territory,
            avg(total_sales) OVER c AS avg_sales_of_dealers_in_same_dealer_club_category,
            avg(total_invoices) OVER c AS avg_orders_of_dealers_in_dealer_club_category,
            avg(total_units) OVER c AS avg_units_of_dealers_in_dealer_club_category
        FROM monthly m
        WINDOW t AS (PARTITION BY territory_code, month), c AS (PARTITION BY dealer_club_category, month)""",
    clubs="""
        SELECT * FROM (
            SELECT m.dealer_code, m.period, m.sas_amount, m.dealer_club,
                   strftime(CAST(m.period || '-01' AS DATE) - INTERVAL 1 MONTH, '%Y-%m') AS month
            FROM monthly_club_mapping m WHERE m.dealer_code IN (SELECT dealer_code FROM accounts))
        WHERE month <= (SELECT strftime(ref, '%Y-%m') FROM ref)""",
    rotated="""
        SELECT r.*,
            avg(rotation) OVER (PARTITION BY territory_code, month) AS terrwise_rotation,
            avg(rotation) OVER (PARTITION BY dealer_club_category, month) AS dealerclub_wise_rotation
        FROM (SELECT p.*, c.sas_amount, p.total_sales / c.sas_amount AS rotation
              FROM peers p LEFT JOIN clubs c ON c.dealer_code = p.dealer_code AND c.month = p.month) r""",
    moves=f"""
        SELECT dealer_code, count(*) FILTER (m = 'Demoted') AS "Demoted",
               count(*) FILTER (m = 'Promoted') AS "Promoted", count(*) FILTER (m = 'no_change') AS no_change
        FROM (SELECT dealer_code, CASE WHEN prev IS NULL THEN NULL WHEN cur > prev THEN 'Promoted'
                                       WHEN cur < prev THEN 'Demoted' ELSE 'no_change' END AS m
              FROM (SELECT dealer_code, cur, lag(cur) OVER (PARTITION BY dealer_code ORDER BY month) AS prev
                    FROM (SELECT dealer_code, month, {level_case('dealer_club', MOVEMENT_LEVELS)} AS cur FROM clubs)))
        WHERE m IS NOT NULL GROUP BY dealer_code""",
    balances="""
        SELECT dealer_code, substr(period, 1, 4) || '-' || substr(period, 5, 2) AS month,
               """ + ", ".join(q(b) for b in BALANCES) + """
        FROM customer_financial WHERE dealer_code IN (SELECT dealer_code FROM accounts)""",
    notes="""
        SELECT dealer_code, period AS month, sum(note_value) AS total_credit_note_value,
               avg(note_value) AS avg_credit_note_value
        FROM credit_note WHERE dealer_code IN (SELECT dealer_code FROM accounts) GROUP BY 1, 2""",
    channels="""
        SELECT dealer_code, month, count(*) FILTER (o IS NULL) AS offline, count(*) FILTER (o IS NOT NULL) AS online,
               count(*) AS total_orders
        FROM (SELECT i.dealer_code, i.month, o.inv AS o
              FROM (SELECT dealer_code, period AS month, split_part(invoice_number, '.', 1) AS inv,
                           row_number() OVER (PARTITION BY split_part(invoice_number, '.', 1)
                                              ORDER BY period, dealer_code) AS k FROM sales) i
              LEFT JOIN (SELECT DISTINCT Dealercode AS dc, products_invoiceNumber AS inv FROM orders_online
                         WHERE Dealercode IN (SELECT dealer_code FROM accounts)) o
                ON o.dc = i.dealer_code AND o.inv = i.inv
              WHERE i.k = 1)
        GROUP BY 1, 2""",
    claims="""
        SELECT DealerCode AS dealer_code, ClaimNo, ClaimDate, strftime(ClaimDate, '%Y-%m') AS month, ClaimStatus
        FROM claims_data WHERE DealerCode IN (SELECT dealer_code FROM accounts)""",
    claim_counts=f"""
        SELECT t.dealer_code, t.month, t.unique_claims, s.n AS settled_claims, t.unique_claims - s.n AS active_claims
        FROM (SELECT dealer_code, month, count(DISTINCT ClaimNo) AS unique_claims FROM claims GROUP BY 1, 2) t
        LEFT JOIN (SELECT dealer_code, month, count(*) AS n
                   FROM (SELECT *, row_number() OVER (PARTITION BY ClaimNo ORDER BY ClaimDate, dealer_code) AS k
                         FROM claims WHERE ClaimStatus IN ({text_list(SETTLED_CLAIM_STATUSES)}))
                   WHERE k = 1 GROUP BY 1, 2) s
          ON s.dealer_code = t.dealer_code AND s.month = t.month""",
    visits="""
        SELECT dealerCode AS dealer_code, strftime(updatedAt, '%Y-%m') AS month, count(DISTINCT _id) AS visit_count
        FROM visits_flat WHERE completed AND dealerCode IN (SELECT dealer_code FROM accounts) GROUP BY 1, 2""",
    wide="""
        SELECT r.*, """ + ", ".join(f"b.{q(b)}" for b in BALANCES) + """,
               n.total_credit_note_value, n.avg_credit_note_value, c.offline, c.online, c.total_orders,
               k.unique_claims, k.settled_claims, k.active_claims, v.visit_count
        FROM rotated r
        LEFT JOIN balances b ON b.dealer_code = r.dealer_code AND b.month = r.month
        LEFT JOIN notes n ON n.dealer_code = r.dealer_code AND n.month = r.month
        LEFT JOIN channels c ON c.dealer_code = r.dealer_code AND c.month = r.month
        LEFT JOIN claim_counts k ON k.dealer_code = r.dealer_code AND k.month = r.month
        LEFT JOIN visits v ON v.dealer_code = r.dealer_code AND v.month = r.month""",
    labelled="""
        SELECT *, date_diff('month', CAST(month || '-01' AS DATE),
                            CAST(max(month) OVER (PARTITION BY dealer_code) || '-01' AS DATE)) + 1 AS rel
        FROM wide""",
    pivoted="SELECT dealer_code, " + ", ".join(
        f'max(CASE WHEN rel = {n} THEN {q(m)} END) AS "{m}_cm-{n}"' for m in PIVOT_MEASURES for n in MONTHS
    ) + " FROM labelled WHERE rel <= 12 GROUP BY dealer_code",
    features="""
        SELECT p.*, a.territory_code, a.dealer_club_category, a.dealership_age, i.avg_days_between_purchase,
               m."Demoted", m."Promoted", m.no_change, t.zone, t.region_name, t.dealer_count,
               w.last_billed_days, w.churn_status
        FROM pivoted p
        LEFT JOIN ages a ON a.dealer_code = p.dealer_code
        LEFT JOIN intervals i ON i.dealer_code = p.dealer_code
        LEFT JOIN moves m ON m.dealer_code = p.dealer_code
        LEFT JOIN territory_master t ON t.territory_code = a.territory_code
        LEFT JOIN windows w ON w.dealer_code = p.dealer_code""",
    recent="SELECT * FROM windows WHERE last_billed_days <= 365",
    placed="""
        SELECT r.*, a.territory_code, a.dealer_club_category, t.zone, t.region_name
        FROM recent r LEFT JOIN accounts a ON a.dealer_code = r.dealer_code
        LEFT JOIN territory_master t ON t.territory_code = a.territory_code""",
    hashed="""
        SELECT *, (CAST('0x' || substr(md5(dealer_code || '|42'), 1, 8) AS BIGINT) % 10000) AS bucket,
               CAST('0x' || substr(md5(dealer_code || '|42'), 1, 15) AS BIGINT) AS place FROM recent""",
    formula="""
        SELECT *, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS pred
        FROM (SELECT dealer_code, last_billed_days, bucket / 10000.0::DOUBLE AS h,
                     CASE WHEN row_number() OVER (PARTITION BY churn_status ORDER BY place)
                               <= round(0.2 * count(*) OVER (PARTITION BY churn_status)) THEN 'test' ELSE 'train' END AS dataset,
                     CASE churn_status WHEN 'Churned' THEN 1 ELSE 0 END AS y,
                     1.0::DOUBLE / (1.0::DOUBLE + exp(-(0.02::DOUBLE * (last_billed_days - 90)
                       + 3.0::DOUBLE * (bucket / 10000.0::DOUBLE - 0.5::DOUBLE)))) AS p
              FROM hashed)""",
    results="""
        SELECT dealer_code, predicted_churn, churn_probability, last_billed_days, h,
               CASE predicted_churn WHEN 1 THEN 'Churned' ELSE 'Active' END AS prediction_label,
               CASE WHEN churn_probability <= 0.3 THEN 'Low Risk' WHEN churn_probability <= 0.7 THEN 'Medium Risk'
                    ELSE 'High Risk' END AS risk_category,
               strftime((SELECT ref FROM ref), '%Y-%m-%d %H:%M:%S') AS prediction_timestamp
        FROM (SELECT dealer_code, pred AS predicted_churn, last_billed_days, h,
                     CASE WHEN p < 1e-4 THEN 0 ELSE round_even(p, 5) END AS churn_probability FROM formula)""",
    outcomes="""
        SELECT dataset, count(*) FILTER (y = 0 AND pred = 0) AS tn, count(*) FILTER (y = 0 AND pred = 1) AS fp,
               count(*) FILTER (y = 1 AND pred = 0) AS fn, count(*) FILTER (y = 1 AND pred = 1) AS tp, count(*) AS n
        FROM formula GROUP BY dataset""",
    per_class="""
        SELECT *, coalesce(2.0 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0,
                  coalesce(2.0 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1, (tn + tp)::DOUBLE / n AS accuracy
        FROM (SELECT *, tn + fp AS n0, tp + fn AS n1,
                     coalesce(tn::DOUBLE / nullif(tn + fn, 0), 0) AS p0, coalesce(tn::DOUBLE / nullif(tn + fp, 0), 0) AS r0,
                     coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS p1, coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS r1
              FROM outcomes)""",
    weighted="""
        SELECT dataset, accuracy, (p0 * n0 + p1 * n1) / n AS precision, (r0 * n0 + r1 * n1) / n AS recall,
               (f0 * n0 + f1 * n1) / n AS f1_score FROM per_class""",
    auc="""
        SELECT dataset, (sum(rank * y) - any_value(np) * (any_value(np) + 1) / 2.0) / (any_value(np) * any_value(nn)) AS roc_auc
        FROM (SELECT dataset, y, rank() OVER (PARTITION BY dataset ORDER BY p)
                       + (count(*) OVER (PARTITION BY dataset, p) - 1) / 2.0 AS rank,
                     sum(y) OVER (PARTITION BY dataset) AS np, sum(1 - y) OVER (PARTITION BY dataset) AS nn
              FROM formula)
        GROUP BY dataset""",
    errors="""
        SELECT dealer_code, y AS true_label, pred AS predicted_label,
               CASE WHEN p < 1e-4 THEN 0 ELSE round_even(p, 5) END AS confidence_score,
               CASE pred WHEN 1 THEN 'false_positive' ELSE 'false_negative' END AS error_kind
        FROM formula WHERE y <> pred""",
    linear="""
        SELECT dealer_code, pred, feature, value, contribution FROM (
            SELECT dealer_code, pred, 'last_billed_days' AS feature, last_billed_days::DOUBLE AS value,
                   0.02::DOUBLE * (last_billed_days - avg(last_billed_days) OVER ()) AS contribution FROM formula
            UNION ALL
            SELECT dealer_code, pred, 'h', h, 3.0::DOUBLE * (h - avg(h) OVER ()) FROM formula)""",
    gappy="""
        SELECT o_orderkey, CASE WHEN o_totalprice < 300000 THEN o_totalprice END AS price,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS priority FROM orders""",
    all_valid="""
        SELECT * FROM sales_data WHERE indicator_cancel IS NULL AND invoice_type NOT IN ('S1','S2','S3','S4')""",
    all_labels="""
        SELECT dealer_code, CASE WHEN date_diff('day', max(invoice_date), any_value(r.ref)) > 90 THEN 'Churned' ELSE 'Active' END AS churn_status
        FROM all_valid, (SELECT date_trunc('month', max(invoice_date)) - INTERVAL 1 DAY AS ref FROM all_valid) r
        WHERE invoice_date <= r.ref GROUP BY dealer_code""",
)

BODIES: dict[str, str] = {
    "scan_project_limit": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 20",
    "load_accounts": "SELECT * FROM accounts",
    "load_sales": "SELECT * FROM sales",
    "load_restricted": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {k} AS dealer_code, count(*) AS n_rows FROM {t} "
        f"WHERE {k} IN (SELECT dealer_code FROM accounts) GROUP BY 2"
        for t, k in (
            ("claims_data", "DealerCode"), ("visits_flat", "dealerCode"),
            ("monthly_club_mapping", "dealer_code"), ("credit_note", "dealer_code"),
            ("customer_financial", "dealer_code"), ("orders_online", "Dealercode"),
        )
    ),
    "write_roundtrip": "SELECT * FROM totals",
    "append_evolve": """
        SELECT dealer_code, churn_status, NULL AS severity FROM windows
        UNION ALL SELECT dealer_code, churn_status, round(last_billed_days / 120.0, 4) FROM recent""",
    "csv_schema_roundtrip": "SELECT *, round(last_billed_days / 120.0, 4) AS severity FROM windows",
    "schema_cast": """
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey, o_totalprice, 1 AS extra
        FROM orders""",
    "schema_diff": """
        SELECT 'o_orderkey' AS column_name, 'bigint' AS expected, 'string' AS actual, count(*) AS n_values, 0 AS n_not_castable FROM orders
        UNION ALL SELECT 'o_custkey', 'bigint', 'string', count(*), count(*) FILTER (o_orderstatus = 'P') FROM orders
        UNION ALL SELECT 'o_orderstatus', 'string', NULL, 0, 0
        UNION ALL SELECT 'extra', NULL, 'int', count(*), 0 FROM orders""",
    "reference_date": "SELECT max_date AS max_invoice_date, ref AS reference_date FROM ref",
    "closed_month_sales": "SELECT * FROM closed",
    "activity_grid": "SELECT * FROM grid",
    "churn_label": "SELECT * FROM labels",
    "no_sales_streak": "SELECT * FROM streak",
    "account_windows": "SELECT * FROM windows",
    "lifecycle_incremental": "SELECT * FROM windows",
    "account_window_sales": "SELECT * FROM wsales",
    "window_sales_by_month": "SELECT * FROM wsales",
    "purchase_interval": "SELECT * FROM intervals",
    "account_age": "SELECT * FROM ages",
    "monthly_sales": "SELECT * FROM monthly",
    "peer_means": "SELECT * FROM peers",
    "club_month_shift": "SELECT * FROM clubs",
    "rotation": "SELECT * FROM rotated",
    "club_movement": "SELECT * FROM moves",
    "financial_month": "SELECT * FROM balances",
    "credit_notes": "SELECT * FROM notes",
    "order_channel": "SELECT * FROM channels",
    "claim_counts": "SELECT * FROM claim_counts",
    "visit_counts": "SELECT * FROM visits",
    "mom_change": """
        SELECT level, group_key, month,
               sales / nullif(lag(sales) OVER (PARTITION BY level, group_key ORDER BY month), 0) - 1 AS change_sales
        FROM (SELECT 'account' AS level, dealer_code AS group_key, month, avg_sales AS sales FROM monthly
              UNION ALL SELECT 'territory', territory_code, month, avg(total_sales) FROM monthly GROUP BY 2, 3
              UNION ALL SELECT 'club', dealer_club_category, month, avg(total_sales) FROM monthly GROUP BY 2, 3)""",
    "market_share": "SELECT *, " + ", ".join(
        f"{s.lower()} * 100.0 / nullif(total, 0) AS {s.lower()}_share" for s in SEGMENTS
    ) + " FROM (SELECT CAST(c_nationkey AS VARCHAR) AS territory_code, sum(c_acctbal) AS total, " + ", ".join(
        f"coalesce(sum(c_acctbal) FILTER (c_mktsegment = '{s}'), 0) AS {s.lower()}" for s in SEGMENTS
    ) + " FROM customer GROUP BY 1)",
    "relative_month": "SELECT *, 'cm-' || rel AS cm_label FROM labelled WHERE rel <= 12",
    "monthly_wide": "SELECT * FROM wide",
    "feature_pivot": "SELECT * FROM pivoted",
    "account_features": "SELECT * FROM features",
    **{
        f"checked_join_{how}": f"""
        SELECT coalesce(a.dealer_code, l.dealer_code) AS dealer_code, a.territory_code, l.churn_status
        FROM accounts a {join} JOIN all_labels l ON l.dealer_code = a.dealer_code"""
        for how, join in (("left", "LEFT"), ("inner", "INNER"), ("right", "RIGHT"), ("outer", "FULL OUTER"))
    },
    "recent_accounts": "SELECT * FROM recent",
    "severity": "SELECT *, round(last_billed_days / 120.0, 4) AS severity FROM windows",
    "label_encode": "SELECT dealer_code, dense_rank() OVER (ORDER BY territory_code) - 1 AS territory_code_encoded FROM placed",
    "align_schema": "SELECT *, 0 AS not_in_input FROM recent",
    "impute_mean_mode": """
        SELECT o_orderkey, coalesce(price, (SELECT avg(price) FROM gappy)) AS price,
               coalesce(priority, (SELECT priority FROM gappy WHERE priority IS NOT NULL
                                   GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS priority
        FROM gappy""",
    "drop_nulls": "SELECT * FROM gappy WHERE price IS NOT NULL",
    "coerce_numeric": """
        SELECT p_partkey, CASE WHEN p_size > 25 THEN 0 ELSE p_retailprice END AS price_text,
               CAST(replace(p_brand, 'Brand#', '') AS DOUBLE) AS brand_text, 0 AS p_type FROM part""",
    "coerce_dates": """
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS day_text,
               CASE WHEN o_orderstatus <> 'F' THEN o_orderdate END AS compact_text FROM orders""",
    "stratified_split": """
        SELECT y AS true_label, count(*) FILTER (dataset = 'train') AS n_train,
               count(*) FILTER (dataset = 'test') AS n_test,
               count(*) FILTER (dataset = 'test') / count(*)::DOUBLE AS test_share FROM formula GROUP BY y""",
    "split_union": "SELECT dealer_code, dataset, y AS true_label FROM formula",
    "group_summary": "SELECT l_returnflag, " + ", ".join(
        f"count({c}) AS {c}_count, round(avg({c}), 2) AS {c}_mean, round(stddev_samp({c}), 2) AS {c}_std, "
        f"min({c}) AS {c}_min, max({c}) AS {c}_max" for c in ("l_quantity", "l_extendedprice")
    ) + " FROM lineitem GROUP BY 1",
    "iqr_outliers": " UNION ALL ".join(
        f"""SELECT dealer_code || '/' || month AS account_month, '{c}' AS column_name, {c} AS value
            FROM totals, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM totals) b
            WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)"""
        for c in ("total_sales", "total_invoices", "total_units")
    ),
    "class_weight": """
        SELECT count(*) FILTER (y = 0) AS n_negative, count(*) FILTER (y = 1) AS n_positive,
               count(*) FILTER (y = 0) / count(*) FILTER (y = 1)::DOUBLE AS positive_weight FROM formula""",
    "class_distribution": """
        SELECT churn_status, count(*) AS n, count(*) * 100.0 / (SELECT count(*) FROM windows) AS percent
        FROM windows GROUP BY 1""",
    "confusion_matrix": " UNION ALL ".join(
        f"SELECT dataset, {t} AS true_label, {p} AS predicted_label, {c} AS n FROM outcomes"
        for t, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
    ),
    "weighted_metrics": "SELECT * FROM weighted",
    "class_report": """
        SELECT dataset, '0' AS label, p0 AS precision, r0 AS recall, f0 AS f1_score, n0 AS support FROM per_class
        UNION ALL SELECT dataset, '1', p1, r1, f1, n1 FROM per_class
        UNION ALL SELECT dataset, 'accuracy', NULL, NULL, accuracy, n FROM per_class
        UNION ALL SELECT dataset, 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM per_class
        UNION ALL SELECT w.dataset, 'weighted avg', w.precision, w.recall, w.f1_score, o.n
                  FROM weighted w JOIN outcomes o ON o.dataset = w.dataset""",
    "roc_auc": "SELECT * FROM auc",
    "roc_curve": """
        SELECT dataset, NULL AS threshold, 0 AS fpr, 0 AS tpr FROM formula GROUP BY 1
        UNION ALL
        SELECT DISTINCT dataset, p,
               sum(1 - y) OVER w / (sum(1 - y) OVER d)::DOUBLE, sum(y) OVER w / (sum(y) OVER d)::DOUBLE
        FROM formula
        WINDOW w AS (PARTITION BY dataset ORDER BY p DESC), d AS (PARTITION BY dataset)""",
    "metrics_long": " UNION ALL ".join(
        [f"SELECT dataset, '{m}' AS metric, {m} AS value FROM weighted" for m in ("accuracy", "precision", "recall", "f1_score")]
        + ["SELECT dataset, 'roc_auc', roc_auc FROM auc"]
    ),
    "prediction_errors": """
        SELECT e.*, s.* FROM errors e, (
            SELECT count(*) AS n_errors, count(*) FILTER (predicted_label = 1) AS n_false_positive,
                   count(*) FILTER (predicted_label = 0) AS n_false_negative, avg(confidence_score) AS mean_confidence,
                   stddev_samp(confidence_score) AS std_confidence, min(confidence_score) AS min_confidence,
                   quantile_cont(confidence_score, 0.25) AS q1_confidence,
                   quantile_cont(confidence_score, 0.5) AS median_confidence,
                   quantile_cont(confidence_score, 0.75) AS q3_confidence, max(confidence_score) AS max_confidence
            FROM errors) s""",
    "importance_cut": "SELECT feature, importance FROM (SELECT *, quantile_cont(importance, 0.75) OVER () AS cut FROM ("
    + " UNION ALL ".join(
        f"SELECT '{m}' AS feature, count({q(m)}) / count(*)::DOUBLE AS importance FROM wide" for m in PIVOT_MEASURES
    ) + ")) WHERE importance >= cut",
    "score_bands": "SELECT * FROM results",
    "high_risk": "SELECT * FROM results WHERE churn_probability >= 0.7",
    "top_risk": "SELECT * FROM results ORDER BY churn_probability DESC, dealer_code LIMIT 10",
    "score_subset": f"SELECT * FROM results WHERE dealer_code IN ({text_list(ASKED_FOR)})",
    "point_lookup": "SELECT * FROM results WHERE dealer_code = '1002'",
    "prediction_summary": """
        SELECT count(*) AS n_accounts, sum(predicted_churn) AS n_churn, sum(predicted_churn) * 100.0 / count(*) AS churn_rate,
               count(*) FILTER (risk_category = 'Low Risk') AS n_low,
               count(*) FILTER (risk_category = 'Medium Risk') AS n_medium,
               count(*) FILTER (risk_category = 'High Risk') AS n_high,
               n_low * 100.0 / count(*) AS low_share, n_medium * 100.0 / count(*) AS medium_share,
               n_high * 100.0 / count(*) AS high_share, avg(churn_probability) AS mean_probability,
               median(churn_probability) AS median_probability, max(churn_probability) AS max_probability,
               min(churn_probability) AS min_probability FROM results""",
    "predictions_with_territory": """
        SELECT r.*, a.territory_code FROM results r LEFT JOIN accounts a ON a.dealer_code = r.dealer_code""",
    "run_stamp": """
        SELECT o_orderkey, CAST(o_orderdate + (CASE WHEN o_orderstatus = 'P' THEN INTERVAL '18:45:00' ELSE INTERVAL '18:15:00' END)
               + INTERVAL '5:30:00' AS DATE) AS created_at FROM orders""",
    "linear_contributions": "SELECT * FROM linear",
    "explanations": """
        SELECT dealer_code, any_value(pred) AS predicted_churn, count(*) FILTER (contribution > 0) AS n_positive,
               count(*) FILTER (contribution < 0) AS n_negative, arg_max(feature, abs(contribution)) AS first_top,
               coalesce(sum(contribution) FILTER (contribution > 0), 0) AS total_positive_impact,
               coalesce(sum(contribution) FILTER (contribution < 0), 0) AS total_negative_impact,
               sum(contribution) AS net_impact
        FROM linear GROUP BY dealer_code""",
    "explanations_json": """
        SELECT dealer_code, 'positive_features' AS kind, feature, contribution AS impact,
               row_number() OVER (PARTITION BY dealer_code ORDER BY contribution DESC, feature) - 1 AS position
        FROM linear WHERE contribution > 0
        UNION ALL SELECT dealer_code, 'negative_features', feature, contribution,
               row_number() OVER (PARTITION BY dealer_code ORDER BY contribution, feature) - 1
        FROM linear WHERE contribution < 0
        UNION ALL SELECT dealer_code, 'top_features', feature, abs(contribution),
               row_number() OVER (PARTITION BY dealer_code ORDER BY abs(contribution) DESC, feature) - 1
        FROM linear""",
    "global_attribution": "SELECT feature, avg(abs(contribution)) AS mean_abs_contribution FROM linear GROUP BY 1",
    "top_contributions": """
        SELECT dealer_code, k AS rank, feature, value, contribution, abs(contribution) AS abs_contribution
        FROM (SELECT *, row_number() OVER (PARTITION BY dealer_code ORDER BY abs(contribution) DESC, feature) AS k FROM linear)
        WHERE k <= 10""",
    "churn_drivers": """
        SELECT feature, count(*) AS count, avg(contribution) AS mean_impact, max(contribution) AS max_impact,
               sum(contribution) AS total_impact
        FROM linear WHERE contribution > 0 GROUP BY 1 ORDER BY total_impact DESC LIMIT 10""",
    "append_evolve_table": """
        SELECT dealer_code, churn_status, NULL AS severity FROM windows
        UNION ALL SELECT dealer_code, churn_status, round(last_billed_days / 120.0, 4) FROM recent""",
    # Properties of the trained model's results: which rows there must be, and that each one is right.
    "train_gbt_check": """
        SELECT dataset, unnest(['accuracy', 'precision', 'recall', 'f1_score', 'roc_auc']) AS metric, 1 AS equal, 1 AS learned
        FROM (SELECT DISTINCT dataset FROM formula)""",
    "train_quick_check": """
        SELECT unnest(['accuracy', 'precision', 'recall', 'f1_score', 'roc_auc']) AS metric, 1 AS equal, 1 AS learned""",
    "random_search_check": f"SELECT unnest({[tr.point_text(p) for p in tr.draw_points(SMALL_RANDOM, 4, 42)]}) AS params, 1 AS in_range",
    "grid_search_check": """
        SELECT '{"learning_rate": ' || r || ', "max_depth": 2, "n_estimators": ' || n || '}' AS params, 1 AS equal
        FROM (SELECT unnest(['0.1', '0.3']) AS r), (SELECT unnest([2, 4, 8]) AS n)""",
    "profile_sketch_check": "SELECT column_name, 1 AS within FROM (DESCRIBE SELECT * FROM sales_data)",
    "score_loaded_check": "SELECT dealer_code, 1 AS equal FROM features WHERE last_billed_days <= 365",
    "prediction_csv_roundtrip": "SELECT dealer_code, predicted_churn, churn_probability, risk_category FROM results",
    "daily_rerun_check": "SELECT dealer_code, 2 AS n_rows, 2 AS n_days FROM results",
    "feature_importance_check": "SELECT 1.0 AS total, 0 AS negative, 0 AS repeated",
    "score_accounts_check": "SELECT dealer_code, 1 AS class_follows FROM features WHERE last_billed_days <= 365",
    "score_all_check": "SELECT dealer_code, 'right' AS label, 'right' AS band FROM features WHERE last_billed_days <= 365",
    "tree_contributions_check": "SELECT dealer_code, 1 AS adds_up FROM features WHERE last_billed_days <= 365",
    "explain_all_check": """
        SELECT dealer_code, 1 AS n_top, 1 AS has_base
        FROM (SELECT dealer_code, row_number() OVER (PARTITION BY churn_status
                                                     ORDER BY CAST('0x' || substr(md5(dealer_code || '|42'), 1, 15) AS BIGINT)) AS k,
                     count(*) OVER (PARTITION BY churn_status) AS n
              FROM features WHERE last_billed_days <= 365)
        WHERE k <= round(0.2 * n)""",
    "daily_job_check": "SELECT dealer_code, 1 AS explained FROM features WHERE last_billed_days <= 365",
}

SALES_TYPES = {
    "dealer_code": "string", "invoice_date": "timestamp_ntz", "period": "string", "ndp_value": "double",
    "invoice_number": "string", "volume": "double", "indicator_cancel": "string", "invoice_type": "string",
}
BODIES["quality_report"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) - count({c}) AS null_count, count(*) AS n_rows, "
    f"8 AS n_columns, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM sales_data)) AS duplicate_rows FROM sales_data"
    for c, t in SALES_TYPES.items()
)
BODIES["column_profile"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) - count({c}) AS null_count, "
    f"count(DISTINCT {c}) AS unique_values, "
    + (f"min({c}) AS min_value, max({c}) AS max_value" if t == "double" else "NULL AS min_value, NULL AS max_value")
    + " FROM sales_data"
    for c, t in SALES_TYPES.items()
)

# -- queries whose columns depend on the data: names of the zones and regions -------------
ZONES = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
REGIONS = tuple(f"NATION_{i}" for i in range(25))


def _flags(integer: bool) -> list[str]:
    one, zero = ("1::BIGINT", "0::BIGINT") if integer else ("1.0::DOUBLE", "0.0::DOUBLE")
    return [
        f"CASE WHEN {c} = '{v}' THEN {one} ELSE {zero} END AS \"{c}_{v}\""
        for c, values in (("zone", ZONES), ("region_name", REGIONS))
        for v in values
    ]


def _filled(expr: str, name: str) -> str:
    digits, nudge = (6, "1e-9") if "rotation" in name else (4, "1e-7")
    return f"round(coalesce(CAST({expr} AS DOUBLE), 0.0) + {nudge}, {digits}) AS {q(name)}"


def _encoded(target: bool) -> str:
    pivot = [_filled(q(f"{m}_cm-{n}"), f"{m}_cm-{n}") for m in PIVOT_MEASURES for n in MONTHS]
    rest = [
        _filled(c, c.strip('"'))
        for c in ("dealership_age", "avg_days_between_purchase", '"Demoted"', '"Promoted"', "no_change", "dealer_count")
    ]
    club = _filled(level_case("upper(trim(dealer_club_category))", MODEL_LEVELS), "dealer_club_category")
    code = _filled("dense_rank() OVER (ORDER BY territory_code) - 1", "territory_code_encoded")
    label = ["CASE churn_status WHEN 'Churned' THEN 1::BIGINT ELSE 0::BIGINT END AS churn_status"] if target else []
    columns = ["dealer_code", *pivot, *rest, club, *_flags(False), code, *label]
    return "SELECT " + ", ".join(columns) + " FROM features WHERE last_billed_days <= 365"


WHOLE: dict[str, str] = {
    "one_hot": "SELECT dealer_code, " + ", ".join(_flags(True)) + " FROM placed",
    "encode_features": _encoded(True),
    "prepare_scoring": _encoded(False),
}


def with_nodes(text: str) -> str:
    """Prefix a statement with the named subqueries it needs, in order of use."""
    names = "|".join(sorted(NODES, key=len, reverse=True))
    order: list[str] = []

    def visit(body: str, inside: frozenset[str]):
        for name in re.findall(rf"\b(?:FROM|JOIN|,)\s+\(*\s*({names})\b(?!\s*\()", body):
            if name not in order and name not in inside:
                visit(NODES[name], inside | {name})
                order.append(name)

    visit(text, frozenset())
    if not order:
        return text
    return "WITH " + ", ".join(f"{n} AS MATERIALIZED ({NODES[n]})" for n in order) + " " + text


def oracle_sql() -> dict[str, str]:
    """Key -> complete statement."""
    out = {k: with_nodes(shaped_sql(body, SHAPES[k])) for k, body in BODIES.items()}
    out.update({k: with_nodes(body) for k, body in WHOLE.items()})
    return out

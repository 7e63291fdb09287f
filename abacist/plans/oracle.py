"""SQL twins of the registered queries, written straight on the generated tables for DuckDB.

They follow the definition of each report row by row (plain joins, distinct counts, sorted lists
for percentiles) and share none of the folding the Spark plans use.
"""

from __future__ import annotations

from abacist.plans import testdata as data

# Fixed values, written out here as well so that a wrong edge in the reports shows.
DOCUMENT_TIERS = ((500, 10), (1000, 9), (1500, 8), (2000, 7), (3000, 6), (5000, 5))
TIER_EDGES = VOLUME_EDGES = (500, 1000, 1500, 2000, 3000, 5000)
TIER_LABELS = (
    "0–500 (10 Kč)",
    "501–1000 (9 Kč)",
    "1001–1500 (8 Kč)",
    "1501–2000 (7 Kč)",
    "2001–3000 (6 Kč)",
    "3001–5000 (5 Kč)",
    "5000+ (custom)",
)
VOLUME_LABELS = ("0–500", "501–1000", "1001–1500", "1501–2000", "2001–3000", "3001–5000", "5000+")
AGE_EDGES = (0, 1, 3, 7, 14, 30, 60, 90)
AGE_LABELS = ("0d", "1-2d", "3-6d", "7-13d", "14-29d", "30-59d", "60-89d", "90d+")

MONTHS = data.YEARS.months()
SPRINTS = data.sprint_names()


# --- SQL snippets -----------------------------------------------------------------------------


def rounded(expr: str, digits: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(28,10)), {digits}) AS DECIMAL(18,{digits}))"


def percent(num: str, den: str, digits: int = 1) -> str:
    return rounded(f"({num}) * 100.0 / nullif({den}, 0)", digits)


def quotient(num: str, den: str, digits: int) -> str:
    return rounded(f"({num}) * 1.0 / nullif({den}, 0)", digits)


def money(units: str) -> str:
    return f"CAST(round(CAST({units} AS DECIMAL(15,0)) * 0.035, 2) AS DECIMAL(18,2))"


def czk(eur: str) -> str:
    return f"CAST(round({eur} * 25.0, 2) AS DECIMAL(18,2))"


def cost(prompt: str, completion: str, digits: int) -> str:
    tokens = [f"CAST({c} AS DECIMAL(18,0))" for c in (prompt, completion)]
    total = f"{tokens[0]} * 0.000002101 + {tokens[1]} * 0.00000841"
    return f"CAST(round({total}, {digits}) AS DECIMAL(18,{digits}))"


def listed_percentile(values: str, per_cent: int) -> str:
    """Continuous percentile of a sorted list, ranks in whole numbers."""
    low = f"{values}[({per_cent} * (len({values}) - 1)) // 100 + 1]"
    high = f"{values}[({per_cent} * (len({values}) - 1) + 99) // 100 + 1]"
    return f"({low} + ({high} - {low}) * (({per_cent} * (len({values}) - 1)) % 100) / 100.0)"


def month(column: str, grain: str = "month") -> str:
    return f"CAST(date_trunc('{grain}', {column}) AS DATE)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def label_case(value: str, edges, labels) -> str:
    whens = " ".join(f"WHEN {value} <= {e} THEN '{x}'" for e, x in zip(edges, labels))
    return f"CASE {whens} ELSE '{labels[-1]}' END"


def cells(column: str, labels, value: str, agg: str = "max", default: str = "") -> str:
    """One conditional aggregate per label, the long-hand form of a pivot."""
    cell = "{agg}(CASE WHEN {column} = '{label}' THEN {value} END)"
    if default:
        cell = f"coalesce({cell}, {default})"
    return ", ".join(
        f'{cell.format(agg=agg, column=column, label=x, value=value)} AS "{x}"' for x in labels
    )


# --- usage billing ----------------------------------------------------------------------------

EXCLUDED = ", ".join(str(u) for u in data.EXCLUDED)

USERS = """usr AS (
    SELECT c_custkey AS user_id, c_nationkey,
           coalesce(nullif(trim(split_part(c_name, '#', 1) || ' ' ||
                        CASE WHEN c_custkey % 10 <> 0 THEN split_part(c_name, '#', 2) END), ''),
                    CASE WHEN c_custkey % 25 <> 0 THEN 'u' || c_custkey || '@example.org' END,
                    '(unknown user)') AS user_name
    FROM customer)"""

CASES = f"""{USERS}, cse AS (
    SELECT o_orderkey, o_orderdate, o_orderstatus, o_orderpriority, o_custkey,
           coalesce(user_name, '(unknown user)') AS user_name,
           coalesce(n_name, '(none)') AS role_name,
           CASE o_orderstatus WHEN 'F' THEN 5 WHEN 'P' THEN 2 ELSE 1 END AS state_id
    FROM orders LEFT JOIN usr ON user_id = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
    WHERE o_custkey IS NULL OR o_custkey NOT IN ({EXCLUDED}))"""

ITEMS = f"""{CASES}, itm AS (
    SELECT cse.*, l_linenumber,
           CASE l_returnflag || l_linestatus WHEN 'RF' THEN 5 WHEN 'RO' THEN 2 WHEN 'AF' THEN 4
                WHEN 'AO' THEN 4 WHEN 'NF' THEN 3 ELSE 1 END AS status_id
    FROM lineitem JOIN cse ON o_orderkey = l_orderkey),
billed AS (SELECT * FROM itm WHERE status_id IN (2, 4, 5)),
status_name AS (SELECT * FROM (VALUES (1, 'CREATED'), (2, 'MATCHED'), (3, 'NOT_MATCHED'),
                               (4, 'MATCH_NOT_FOUND'), (5, 'PAIRED')) v(status_id, status_name))"""

IN_MONTH = f"o_orderdate >= DATE '{data.MONTH.start}' AND o_orderdate < DATE '{data.MONTH.end}'"

SUMMARY = f"""smy AS (
    SELECT user_name, role_name, count(DISTINCT o_orderkey) AS cases, count(*) AS billable_items,
           {money("count(*)")} AS amount_eur
    FROM billed WHERE {{where}} GROUP BY ALL)"""

MONTHLY = f"""mon AS (
    SELECT user_name, {month("o_orderdate")} AS month, count(DISTINCT o_orderkey) AS cases,
           count(*) AS billable_items, {money("count(*)")} AS amount_eur
    FROM billed GROUP BY ALL)"""

SPINE = """dense AS (
    SELECT s.user_name, s.month, coalesce(mon.cases, 0) AS cases,
           coalesce(mon.billable_items, 0) AS billable_items,
           coalesce(mon.amount_eur, 0) AS amount_eur
    FROM (SELECT user_name, CAST(unnest(generate_series(CAST(min(month) AS TIMESTAMP),
                 CAST(max(month) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month
          FROM mon GROUP BY user_name) s
    LEFT JOIN mon ON mon.user_name = s.user_name AND mon.month = s.month)"""


def growth_sql(source: str) -> str:
    return f"""SELECT user_name, month, cases, billable_items, amount_eur,
        lag(billable_items) OVER w AS prev_month_items,
        lag(amount_eur) OVER w AS prev_month_amount_eur,
        {percent("billable_items - lag(billable_items) OVER w", "lag(billable_items) OVER w")}
            AS items_growth_pct,
        {percent("amount_eur - lag(amount_eur) OVER w", "lag(amount_eur) OVER w")}
            AS revenue_growth_pct
    FROM {source} WINDOW w AS (PARTITION BY user_name ORDER BY month)"""


def ytd_sql(where: str) -> str:
    total = "CAST(items_amount_eur + 650.00 AS DECIMAL(18,2))"
    return f"""WITH {ITEMS}, mon AS (
        SELECT {month("o_orderdate")} AS month, count(*) AS billable_items,
               {money("count(*)")} AS items_amount_eur
        FROM billed WHERE {where} GROUP BY ALL),
    tot AS (SELECT month, billable_items, items_amount_eur,
                   CAST(650.00 AS DECIMAL(18,2)) AS azure_fee_eur, {total} AS total_eur,
                   {czk(total)} AS total_czk FROM mon)
    SELECT *, {big("sum(billable_items) OVER w")} AS cumulative_items,
           CAST(sum(total_eur) OVER w AS DECIMAL(18,2)) AS cumulative_eur,
           CAST(sum(total_czk) OVER w AS DECIMAL(18,2)) AS cumulative_czk
    FROM tot WINDOW w AS (ORDER BY month)"""


def pareto_sql(entity: str, volume: str, source: str) -> str:
    return f"""SELECT rank() OVER (ORDER BY {volume} DESC) AS rank, {entity}, {volume},
        {percent(volume, f"sum({volume}) OVER ()")} AS pct_of_total,
        {percent(f"sum({volume}) OVER (ORDER BY {volume} DESC)", f"sum({volume}) OVER ()")}
            AS cumulative_pct
    FROM {source}"""


STATUS_DISTRIBUTION = f"""dist AS (
    SELECT user_name, status_id, status_name, status_id IN (2, 4, 5) AS is_billable,
           count(*) AS item_count
    FROM itm JOIN status_name USING (status_id) GROUP BY ALL)"""

QUALITY = f"""qual AS (
    SELECT user_name, {month("o_orderdate")} AS month,
           count(*) FILTER (status_id IN (2, 4, 5)) AS billable_items,
           count(*) FILTER (status_id = 5) AS paired,
           count(*) FILTER (status_id = 2) AS matched_not_paired,
           count(*) FILTER (status_id = 4) AS match_not_found,
           count(*) FILTER (status_id = 3) AS not_matched_unbilled,
           count(*) FILTER (status_id = 1) AS still_created_unbilled,
           count(*) FILTER (l_linenumber <= 3) AS exact_found
    FROM itm GROUP BY ALL),
rates AS (
    SELECT * EXCLUDE (exact_found),
           {percent("paired", "billable_items")} AS pair_rate_pct,
           {percent("match_not_found", "billable_items")} AS no_match_rate_pct,
           {percent("exact_found", "billable_items")} AS exact_dimensions_pct
    FROM qual)"""


def rate_matrix_sql(metric: str) -> str:
    labels = cells("strftime(month, '%Y-%m')", MONTHS, metric)
    return f"""WITH {ITEMS}, {QUALITY}
    SELECT user_name, {labels} FROM rates WHERE {metric} IS NOT NULL GROUP BY user_name"""


FUNNEL = f"""fun AS (
    SELECT {month("o_orderdate")} AS month, state_id,
           CASE state_id WHEN 1 THEN 'OPENED' WHEN 2 THEN 'PARSED' ELSE 'PROCESSED' END AS state_name,
           state_id >= 4 AS is_settled, count(*) AS cases, {big("sum(o_orderkey % 50)")} AS items_total,
           {rounded("avg(o_custkey % 101)", 1)} AS avg_pct_matched,
           {rounded("avg(o_orderkey % 97)", 1)} AS avg_pct_done
    FROM cse GROUP BY ALL)"""

def depth_sql(items: str) -> str:
    return f"""WITH {CASES}, per_item AS (
            SELECT user_name, {month("o_orderdate")} AS month, o_orderkey, count(l_orderkey) AS offers,
                   count(*) FILTER (l_returnflag = 'R') AS chosen,
                   min(l_discount * 10 + l_tax) AS best,
                   min(l_discount * 10 + l_tax) FILTER (l_returnflag = 'R') AS dist
            FROM {items} cse LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL),
        grp AS (
            SELECT user_name, month, count(*) AS billable_items, sum(offers) AS offers,
                   count(*) FILTER (offers = 0) AS items_with_no_offer,
                   count(*) FILTER (chosen > 0) AS items_with_selection,
                   avg(best) AS best, avg(dist) AS dist,
                   list(dist ORDER BY dist) FILTER (dist IS NOT NULL) AS l
            FROM per_item GROUP BY ALL)
        SELECT user_name, month, billable_items,
               {quotient("offers", "billable_items", 2)} AS avg_offers_per_item,
               items_with_no_offer, items_with_selection,
               {percent("items_with_selection", "billable_items")} AS selection_rate_pct,
               {rounded("best", 4)} AS avg_best_distance,
               {rounded("dist", 4)} AS avg_selected_distance,
               {rounded(listed_percentile("l", 50), 4)} AS p50_selected_distance
        FROM grp"""


def attach_sql(items: str) -> str:
    return f"""WITH {CASES}, chain AS (
            SELECT {month("o_orderdate")} AS month, o_orderkey, l_partkey, l_returnflag, l_quantity
            FROM {items} cse LEFT JOIN lineitem ON l_orderkey = o_orderkey
            WHERE o_orderpriority <> '5-LOW')
        SELECT month, count(DISTINCT o_orderkey) AS selected_offers,
               count(l_partkey) AS accessories_offered,
               count(l_partkey) FILTER (l_returnflag = 'R') AS accessories_selected,
               {big("sum(CAST(l_quantity AS INTEGER)) FILTER (l_returnflag = 'R')")}
                   AS accessory_qty_selected,
               {percent("count(DISTINCT o_orderkey) FILTER (l_returnflag = 'R')",
                        "count(DISTINCT o_orderkey)")} AS offers_with_accessory_pct
        FROM chain GROUP BY month"""


USAGE = {
    "display_name": f"WITH {USERS} SELECT user_id, user_name FROM usr",
    "billable_units": f"""WITH {ITEMS}
        SELECT o_orderkey AS case_id, o_orderkey AS item_id, status_id, o_orderdate AS created_at,
               user_name, role_name FROM billed""",
    "usage_summary": f"""WITH {ITEMS}, {SUMMARY.format(where="true")}
        SELECT *, {czk("amount_eur")} AS amount_czk FROM smy""",
    "usage_summary_month": f"""WITH {ITEMS}, {SUMMARY.format(where=IN_MONTH)}
        SELECT *, {czk("amount_eur")} AS amount_czk FROM smy""",
    "usage_summary_by_id": f"""WITH {ITEMS}, smy AS (
            SELECT o_custkey AS user_id, 'Sam ' || (o_custkey % 7) AS user_name, role_name,
                   count(DISTINCT o_orderkey) AS cases, count(*) AS billable_items,
                   {money("count(*)")} AS amount_eur
            FROM billed GROUP BY ALL)
        SELECT *, {czk("amount_eur")} AS amount_czk FROM smy""",
    "invoice_lines": f"""WITH {ITEMS}, {SUMMARY.format(where=IN_MONTH)},
        tot AS (SELECT {big("sum(cases)")} AS cases, {big("sum(billable_items)")} AS items FROM smy),
        lines AS (
            SELECT 0 AS line_order, * FROM smy
            UNION ALL SELECT 1, 'ZZ SUBTOTAL (items)', '', cases, items, {money("items")} FROM tot
            UNION ALL SELECT 2, 'ZZ AZURE INFRA FEE', '', NULL, NULL, 650.00
            UNION ALL SELECT 3, 'ZZ TOTAL', '', cases, items, {money("items")} + 650.00 FROM tot)
        SELECT line_order, user_name, role_name, cases, billable_items,
               CAST(amount_eur AS DECIMAL(18,2)) AS amount_eur, {czk("amount_eur")} AS amount_czk
        FROM lines""",
    "mom_growth": f"WITH {ITEMS}, {MONTHLY} {growth_sql('mon')}",
    "mom_growth_calendar": f"WITH {ITEMS}, {MONTHLY}, {SPINE} {growth_sql('dense')}",
    "growth_matrix": f"""WITH {ITEMS}, {MONTHLY}, grown AS ({growth_sql('mon')})
        SELECT user_name, {cells("strftime(month, '%Y-%m')", MONTHS, "items_growth_pct")}
        FROM grown GROUP BY user_name""",
    "consumption_trend": f"""WITH {ITEMS}, {MONTHLY}
        SELECT *, {czk("amount_eur")} AS amount_czk FROM mon""",
    "ytd_cumulative": ytd_sql("year(o_orderdate) = 1996"),
    "ytd_cumulative_all_years": ytd_sql("true"),
    "daily_volume": f"""WITH {ITEMS}
        SELECT user_name, CAST(o_orderdate AS DATE) AS day, count(DISTINCT o_orderkey) AS cases,
               count(*) AS billable_items FROM billed GROUP BY ALL""",
    "daily_volume_month": f"""WITH {ITEMS}
        SELECT user_name, CAST(o_orderdate AS DATE) AS day, count(DISTINCT o_orderkey) AS cases,
               count(*) AS billable_items FROM billed WHERE {IN_MONTH} GROUP BY ALL""",
    "revenue_pareto": f"""WITH v AS (
            SELECT o_custkey AS user_id, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS revenue
            FROM orders GROUP BY o_custkey)
        SELECT rank() OVER (ORDER BY revenue DESC) AS rank, user_id, revenue,
               {percent("revenue", "sum(revenue) OVER ()")} AS pct_of_total,
               {percent("sum(revenue) OVER (ORDER BY revenue DESC)", "sum(revenue) OVER ()")} AS cumulative_pct
        FROM v""",
    "invoice_reconciliation": f"""WITH x AS (
            SELECT l_orderkey, o_orderkey, coalesce({IN_MONTH}, false) AS inside, o_custkey IN ({EXCLUDED}) AS gone,
                   l_returnflag || l_linestatus IN ('RF', 'RO', 'AF', 'AO') AS ok
            FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey),
        c AS (
            SELECT count(*) AS scanned, 0::BIGINT AS without_id, 0::BIGINT AS item_deleted,
                   count(*) FILTER (NOT ok) AS unbillable, count(*) FILTER (ok) AS billable,
                   count(*) FILTER (ok AND o_orderkey IS NULL) AS without_case,
                   count(*) FILTER (ok AND o_orderkey IS NOT NULL AND NOT inside) AS outside_period,
                   count(*) FILTER (ok AND inside AND gone) AS excluded, 0::BIGINT AS case_deleted,
                   count(*) FILTER (ok AND inside AND NOT gone) AS billed,
                   count(DISTINCT l_orderkey) FILTER (ok AND inside AND NOT gone) AS billed_cases,
                   count(*) FILTER (ok AND inside AND NOT gone) AS invoiced,
                   count(DISTINCT l_orderkey) FILTER (ok AND inside AND NOT gone) AS invoiced_cases FROM x)
        SELECT * FROM (UNPIVOT c ON COLUMNS(*) INTO NAME count VALUE items)""",
    "daily_volume_refreshed": f"""WITH {ITEMS}
        SELECT user_name, CAST(o_orderdate AS DATE) AS day, count(DISTINCT o_orderkey) AS cases,
               count(*) AS billable_items FROM billed GROUP BY ALL""",
    "daily_matrix": f"""WITH {ITEMS}
        SELECT user_name, {cells("strftime(o_orderdate, '%d')", data.MONTH.days(), "1", "count")}
        FROM billed WHERE {IN_MONTH} GROUP BY user_name""",
    "batch_efficiency": f"""WITH {ITEMS}, per_case AS (
            SELECT user_name, o_orderkey, count(*) AS n FROM billed GROUP BY ALL),
        per_user AS (
            SELECT user_name, count(*) AS cases, {big("sum(n)")} AS billable_items,
                   min(n) AS smallest_case, max(n) AS largest_case, list(n ORDER BY n) AS l
            FROM per_case GROUP BY user_name)
        SELECT * EXCLUDE (l), {quotient("billable_items", "cases", 1)} AS items_per_case,
               {rounded(listed_percentile("l", 50), 1)} AS median_case_size,
               {rounded(listed_percentile("l", 95), 1)} AS p95_case_size
        FROM per_user""",
    "usage_pareto": f"""WITH {ITEMS},
        vol AS (SELECT user_name, count(*) AS billable_items FROM billed GROUP BY user_name)
        {pareto_sql("user_name", "billable_items", "vol")}""",
    "status_distribution": f"""WITH {ITEMS}, {STATUS_DISTRIBUTION}
        SELECT *, {percent("item_count", "sum(item_count) OVER (PARTITION BY user_name)")}
                   AS pct_of_user FROM dist""",
    "status_distribution_month": f"""WITH {ITEMS}, sel AS (SELECT * FROM itm WHERE {IN_MONTH}),
        {STATUS_DISTRIBUTION.replace("FROM itm", "FROM sel")}
        SELECT *, {percent("item_count", "sum(item_count) OVER (PARTITION BY user_name)")}
                   AS pct_of_user FROM dist""",
    "status_matrix": f"""WITH {ITEMS}, {STATUS_DISTRIBUTION}
        SELECT user_name, {cells("status_name", data.STATUS_NAMES, "item_count", default="0")}
        FROM dist GROUP BY user_name""",
    "match_quality": f"WITH {ITEMS}, {QUALITY} SELECT * FROM rates",
    "quality_matrix_pair_rate": rate_matrix_sql("pair_rate_pct"),
    "quality_matrix_no_match_rate": rate_matrix_sql("no_match_rate_pct"),
    "state_funnel": f"""WITH {CASES}, {FUNNEL}
        SELECT *, {percent("cases", "sum(cases) OVER (PARTITION BY month)")} AS pct_of_month
        FROM fun""",
    "funnel_matrix": f"""WITH {CASES}, {FUNNEL}
        SELECT strftime(month, '%Y-%m') AS month,
               {cells("state_name", ["OPENED", "PARSED", "NOT_PARSED", "FAILED", "PROCESSED", "EXPORTED", "NOT_EXPORTED", "DROPPED"], "cases", default="0")}
        FROM fun GROUP BY ALL""",
    "settled_rate": f"""WITH {CASES}
        SELECT {month("o_orderdate")} AS month,
               CAST(100.0 AS DOUBLE) * count(*) FILTER (state_id >= 4) / count(*) AS settled_pct
        FROM cse GROUP BY ALL""",
    "stage_latency": f"""WITH {CASES}, spans AS (
            SELECT {month("o_orderdate")} AS month,
                   epoch_us(l_shipdate) - epoch_us(o_orderdate) AS parse,
                   epoch_us(o_orderdate + INTERVAL 90 DAY) - epoch_us(l_shipdate)
                       + l_linenumber * 60000000 + CAST(l_quantity * 1000000 AS BIGINT) AS process,
                   CAST(l_quantity AS INTEGER) AS n
            FROM cse JOIN lineitem ON l_orderkey = o_orderkey WHERE state_id >= 4),
        lists AS (
            SELECT month, count(*) AS cases, avg(parse) AS a1, avg(process) AS a2,
                   list(parse ORDER BY parse) AS p, list(process ORDER BY process) AS q,
                   sum(n) AS n FROM spans GROUP BY month)
        SELECT month, cases, {rounded("a1 / 1e6", 1)} AS avg_parse_secs,
               {rounded(listed_percentile("p", 50) + " / 1e6", 1)} AS p50_parse_secs,
               {rounded(listed_percentile("p", 95) + " / 1e6", 1)} AS p95_parse_secs,
               {rounded("a2 / 1e6", 1)} AS avg_process_secs,
               {rounded(listed_percentile("q", 50) + " / 1e6", 1)} AS p50_process_secs,
               {rounded(listed_percentile("q", 95) + " / 1e6", 1)} AS p95_process_secs,
               {quotient("n", "cases", 1)} AS avg_items_per_case
        FROM lists""",
    "candidate_depth": depth_sql("cse"),
    "candidate_depth_grouped": depth_sql(
        """(SELECT i.o_orderkey, c.o_orderdate, c.user_name FROM orders i
            JOIN cse c ON c.o_orderkey = i.o_orderkey - i.o_orderkey % 4)"""
    ),
    "attach_rate": attach_sql("cse"),
    "attach_rate_fanned": attach_sql(
        """(SELECT o.o_orderkey, o.o_orderpriority, c.o_orderdate FROM orders o
            LEFT JOIN orders e ON e.o_orderkey = o.o_orderkey - o.o_orderkey % 2
            JOIN cse c ON c.o_orderkey = coalesce(e.o_orderkey, o.o_orderkey) // 8 * 8)"""
    ),
    "volume_band": f"""WITH {ITEMS}, {MONTHLY}
        SELECT *, {label_case("billable_items", VOLUME_EDGES, VOLUME_LABELS)} AS volume_band
        FROM mon""",
}


# --- document billing -------------------------------------------------------------------------


def price_sql(units: str, beyond: str = "2990") -> str:
    """Bracket by bracket: the price at the bracket's start plus the units above it."""
    whens, start, lower = [], 0, 0
    for upper, rate in DOCUMENT_TIERS:
        whens.append(f"WHEN {units} <= {upper} THEN {start} + ({units} - {lower}) * {rate}")
        start, lower = start + (upper - lower) * rate, upper
    listed = f"greatest(2990, CASE {' '.join(whens)} END)"
    return f"CASE WHEN {units} > {lower} THEN {beyond} ELSE {listed} END"


RECORDS = """live AS (
    SELECT n_name AS client_name, l_orderkey, l_partkey, l_shipdate,
           CASE l_returnflag || l_linestatus WHEN 'RF' THEN 18 WHEN 'RO' THEN 18 WHEN 'AF' THEN 12
                WHEN 'AO' THEN 12 WHEN 'NF' THEN 20 ELSE 7 END AS state_id
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
    WHERE l_linenumber <> 7),
rec AS (SELECT * FROM live WHERE state_id >= 18 OR state_id = 12)"""


def client_months(grain: str = "month") -> str:
    return f"""mon AS (
        SELECT client_name, {month("l_shipdate", grain)} AS month, count(*) AS records_created
        FROM rec GROUP BY ALL)"""


PRICED_MONTHS = f"""priced AS (
    SELECT *, {big(price_sql("records_created"))} AS monthly_price_czk,
           records_created > 5000 AS needs_custom_price FROM mon)"""

SEGMENTS = """rec AS (
    SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 'BUILDING' ELSE 'OTHERS' END AS client_name, l_shipdate
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
    WHERE l_linenumber <> 7)"""


def invoice_sql(where: str) -> str:
    return f"""WITH {RECORDS}, per AS (
        SELECT client_name, count(DISTINCT l_orderkey) AS jobs_harvested, count(*) AS records_created
        FROM rec WHERE {where} GROUP BY client_name),
    priced AS (SELECT *, {big(price_sql("records_created"))} AS monthly_price_czk,
                      records_created > 5000 AS needs_custom_price FROM per)
    SELECT * FROM priced
    UNION ALL
    SELECT 'ZZ TOTAL', {big("sum(jobs_harvested)")}, {big("sum(records_created)")},
           {big("sum(monthly_price_czk)")}, coalesce(bool_or(needs_custom_price), false)
    FROM priced"""


def tier_sql(grain: str) -> str:
    return f"""WITH {RECORDS}, {client_months(grain)}
    SELECT *, {label_case("records_created", TIER_EDGES, TIER_LABELS)} AS pricing_tier FROM mon"""


DOCUMENTS = {
    "tiered_price": f"""WITH u AS (
            SELECT p_partkey, CAST(floor(p_retailprice) AS BIGINT) * 3 - 2600 AS units FROM part)
        SELECT p_partkey, units, {big(price_sql("units"))} AS price,
               {big(price_sql("units", "NULL"))} AS open_price, units > 5000 AS needs_custom_price
        FROM u""",
    "billable_records": f"""WITH {RECORDS}
        SELECT client_name, l_orderkey AS record_id, l_orderkey AS job_harvest_id, state_id,
               l_shipdate AS created_at FROM rec""",
    "client_invoice": invoice_sql("true"),
    "client_invoice_month": invoice_sql("year(l_shipdate) = 1996 AND month(l_shipdate) = 3"),
    "client_mom_growth": f"""WITH {RECORDS}, {client_months()}, {PRICED_MONTHS}
        SELECT *, lag(records_created) OVER w AS prev_month_records,
               lag(monthly_price_czk) OVER w AS prev_month_price_czk,
               {percent("records_created - lag(records_created) OVER w",
                        "lag(records_created) OVER w")} AS records_growth_pct,
               {percent("monthly_price_czk - lag(monthly_price_czk) OVER w",
                        "lag(monthly_price_czk) OVER w")} AS revenue_growth_pct
        FROM priced WINDOW w AS (PARTITION BY client_name ORDER BY month)""",
    "report_bundle": f"""SELECT * FROM (
            WITH {ITEMS}, {SUMMARY.format(where="true")}
            SELECT 'usage' AS report, user_name AS name, {big("billable_items")} AS units FROM smy)
        UNION ALL SELECT * FROM (
            WITH {RECORDS} SELECT 'records', client_name, count(*) FROM rec GROUP BY client_name)""",
    "client_revenue_dated": f"""WITH {RECORDS}, {client_months()},
        list(client, since, until, lower, upper, rate, minimum) AS (VALUES {data.DATED_PRICES}),
        per AS (
            SELECT m.client_name, month, records_created, client IS NOT NULL AS own,
                   CAST(greatest(sum(greatest(least(records_created, coalesce(upper, records_created)) - lower, 0) * rate),
                        max(minimum)) AS DECIMAL(18,2)) AS price
            FROM mon m JOIN list ON (client = m.client_name OR client IS NULL)
                AND month >= coalesce(since, DATE '0001-01-01') AND month < coalesce(until, DATE '9999-01-01')
            GROUP BY ALL)
        SELECT mon.client_name, mon.month, mon.records_created, price AS price_czk, own AS own_list
        FROM mon LEFT JOIN (SELECT * FROM per QUALIFY row_number() OVER (PARTITION BY client_name, month ORDER BY own DESC) = 1) p
            ON p.client_name = mon.client_name AND p.month = mon.month""",
    "client_daily_volume": f"""WITH {RECORDS}
        SELECT client_name, CAST(l_shipdate AS DATE) AS day, count(*) AS records_created
        FROM rec GROUP BY ALL""",
    "client_revenue_trend": f"WITH {RECORDS}, {client_months()}, {PRICED_MONTHS} SELECT * FROM priced",
    "client_state_distribution": f"""WITH {RECORDS}, per AS (
            SELECT client_name, state_id, count(*) AS record_count FROM live GROUP BY ALL)
        SELECT *, {percent("record_count", "sum(record_count) OVER (PARTITION BY client_name)")}
                   AS pct_of_client FROM per""",
    "job_efficiency": f"""WITH {RECORDS}
        SELECT client_name, count(DISTINCT l_orderkey) AS jobs_harvested,
               count(*) AS records_created,
               {quotient("count(*)", "count(DISTINCT l_orderkey)", 1)} AS records_per_job
        FROM rec GROUP BY client_name""",
    "ytd_revenue": f"""WITH {RECORDS}, {client_months()}, {PRICED_MONTHS}, tot AS (
            SELECT month, {big("sum(monthly_price_czk)")} AS monthly_revenue_czk,
                   bool_or(needs_custom_price) AS needs_custom_price
            FROM priced GROUP BY month)
        SELECT *, {big("sum(monthly_revenue_czk) OVER (ORDER BY month)")} AS cumulative_revenue_czk
        FROM tot""",
    "segment_revenue_trend": f"WITH {SEGMENTS}, {client_months('year')}, {PRICED_MONTHS} SELECT * FROM priced",
    "segment_ytd_revenue": f"""WITH {SEGMENTS}, {client_months("year")}, tot AS (
            SELECT month, {big(f"sum({price_sql('records_created', 'NULL')})")} AS monthly_revenue_czk,
                   bool_or(records_created > 5000) AS needs_custom_price
            FROM mon GROUP BY month)
        SELECT *, {big("sum(monthly_revenue_czk) OVER (ORDER BY month)")} AS cumulative_revenue_czk
        FROM tot""",
    "tier_distribution": tier_sql("month"),
    "tier_distribution_yearly": tier_sql("year"),
    "client_pareto": f"""WITH {RECORDS},
        vol AS (SELECT client_name, count(*) AS records_created FROM rec GROUP BY client_name)
        {pareto_sql("client_name", "records_created", "vol")}""",
    "unbilled_records": f"""WITH {RECORDS}
        SELECT client_name, state_id, count(*) AS unbilled_records
        FROM live WHERE NOT (state_id >= 18 OR state_id = 12) GROUP BY ALL""",
    "duplicate_rate": f"""WITH {RECORDS}
        SELECT client_name, count(*) AS records, count(DISTINCT l_partkey) AS distinct_keys,
               {percent("count(*) - count(DISTINCT l_partkey)", "count(*)", 2)} AS duplicate_pct
        FROM live GROUP BY client_name""",
    "error_rate": f"""WITH {RECORDS}
        SELECT client_name, count(*) AS records, count(*) FILTER (state_id = 7) AS errors,
               {percent("count(*) FILTER (state_id = 7)", "count(*)", 2)} AS error_pct
        FROM live GROUP BY client_name""",
}


# --- model usage ------------------------------------------------------------------------------

CALLS = """k AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
calls AS (
    SELECT event_id, user_id AS record_id, ts AS called, k * 1000 AS p, k * 10 + user_id AS c,
           k * 1010 + user_id AS t, value AS secs, event_type AS model FROM k),
owned AS (
    SELECT calls.*, n_name AS client_name FROM calls
    JOIN customer ON c_custkey = record_id JOIN nation ON n_nationkey = c_nationkey)"""

LINES = """calls AS (
    SELECT l_orderkey AS record_id, l_shipdate AS called,
           CAST(l_quantity AS BIGINT) * 1000 + l_linenumber AS p,
           CAST(l_quantity AS BIGINT) * 37 AS c,
           CAST(l_quantity AS BIGINT) * 1037 + l_linenumber AS t,
           l_tax * 100 + l_quantity AS secs, 'model-' || l_returnflag AS model FROM lineitem),
owned AS (
    SELECT calls.*, n_name AS client_name FROM calls JOIN orders ON o_orderkey = record_id
    JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)"""

TOKENS = {
    "token_cost": f"WITH {CALLS} SELECT event_id AS usage_id, {cost('p', 'c', 6)} AS cost_eur FROM calls",
    "llm_cost_by_client_month": f"""WITH {LINES}
        SELECT client_name, {month("called")} AS month, count(DISTINCT record_id) AS records_processed,
               count(*) AS llm_calls, {big("sum(p)")} AS total_prompt_tokens,
               {big("sum(c)")} AS total_completion_tokens, {big("sum(t)")} AS total_tokens,
               {cost("sum(p)", "sum(c)", 4)} AS total_cost_eur
        FROM owned GROUP BY ALL""",
    "llm_latency_by_client": f"""WITH {CALLS}, per AS (
            SELECT client_name, count(DISTINCT record_id) AS records_processed, avg(secs) AS a,
                   min(secs) AS mn, max(secs) AS mx, list(secs ORDER BY secs) AS l
            FROM owned GROUP BY client_name)
        SELECT client_name, records_processed, {rounded("a", 2)} AS avg_elapsed_sec,
               {rounded("mn", 2)} AS min_elapsed_sec, {rounded("mx", 2)} AS max_elapsed_sec,
               {rounded(listed_percentile("l", 95), 2)} AS p95_elapsed_sec FROM per""",
    "token_efficiency": f"""WITH {LINES}
        SELECT client_name, {big("sum(p)")} AS total_prompt_tokens,
               {big("sum(c)")} AS total_completion_tokens,
               {percent("sum(c)", "sum(p)", 2)} AS completion_pct,
               {cost("sum(p)", "sum(c)", 4)} AS total_cost_eur
        FROM owned GROUP BY client_name""",
    "calls_per_record": f"""WITH {CALLS}
        SELECT client_name, count(DISTINCT record_id) AS records, count(*) AS llm_calls,
               {quotient("count(*)", "count(DISTINCT record_id)", 2)} AS calls_per_record
        FROM owned GROUP BY client_name""",
    "model_usage_monthly": f"""WITH {LINES}
        SELECT {month("called")} AS month, model AS model_name, count(*) AS llm_calls,
               {big("sum(t)")} AS total_tokens, {rounded("avg(secs)", 2)} AS avg_elapsed_sec,
               {cost("sum(p)", "sum(c)", 4)} AS total_cost_eur
        FROM calls GROUP BY ALL""",
    "llm_daily_volume": f"""WITH {CALLS}
        SELECT CAST(called AS DATE) AS day, count(*) AS llm_calls,
               count(DISTINCT record_id) AS records_processed, {big("sum(t)")} AS total_tokens,
               {cost("sum(p)", "sum(c)", 4)} AS cost_eur
        FROM calls GROUP BY ALL""",
    "slowest_calls": f"""WITH {CALLS}
        SELECT client_name, record_id, secs AS elapsed_time_seconds, t AS total_tokens,
               model AS model_name, CAST(called AS DATE) AS date, {cost("p", "c", 6)} AS cost_eur
        FROM owned ORDER BY secs DESC NULLS LAST, event_id LIMIT 50""",
    "llm_cost_trend": f"""WITH {LINES}, mon AS (
            SELECT {month("called")} AS month, {big("sum(p)")} AS prompt_tokens,
                   {big("sum(c)")} AS completion_tokens, {big("sum(t)")} AS total_tokens,
                   count(*) AS llm_calls, {cost("sum(p)", "sum(c)", 4)} AS cost_eur
            FROM calls GROUP BY ALL)
        SELECT *, CAST(sum(cost_eur) OVER (ORDER BY month) AS DECIMAL(18,4)) AS cumulative_cost_eur
        FROM mon""",
    "llm_cost_trend_of_grain": f"""WITH {LINES}, mon AS (
            SELECT {month("called")} AS month, {big("sum(p)")} AS prompt_tokens,
                   {big("sum(c)")} AS completion_tokens, {big("sum(t)")} AS total_tokens,
                   count(*) AS llm_calls, {cost("sum(p)", "sum(c)", 4)} AS cost_eur
            FROM calls GROUP BY ALL)
        SELECT *, CAST(sum(cost_eur) OVER (ORDER BY month) AS DECIMAL(18,4)) AS cumulative_cost_eur
        FROM mon""",
    "llm_records_estimated": f"""WITH {LINES}
        SELECT client_name, {month("called")} AS month, count(DISTINCT record_id) AS records_processed,
               count(*) AS llm_calls, {cost("sum(p)", "sum(c)", 4)} AS total_cost_eur, true AS within
        FROM owned GROUP BY ALL""",
}


# --- sprint carry-over ------------------------------------------------------------------------

ISSUES = """iss AS (
    SELECT 'Team ' || strftime(o_orderdate, '%Y-%m') AS sprint_name,
           year(o_orderdate) * 100 + month(o_orderdate) AS sprint_id,
           last_day(o_orderdate) AS sprint_end,
           CASE l_returnflag WHEN 'R' THEN 'not_completed' WHEN 'A' THEN 'completed'
                ELSE 'punted' END AS bucket,
           'P-' || l_partkey AS issue_key, 'part ' || l_partkey AS summary,
           CASE WHEN n_nationkey = 7 THEN 'Unassigned' ELSE n_name END AS assignee,
           l_linestatus AS status, CAST(l_linenumber AS VARCHAR) AS issue_type,
           o_orderpriority AS priority, l_quantity AS story_points,
           'https://tracker.example/browse/P-' || l_partkey AS url,
           CASE WHEN l_linenumber = 1 THEN 0 ELSE 1 END AS relevant, l_linenumber, n_nationkey
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey
    JOIN nation ON n_nationkey = s_nationkey),
carried AS (SELECT * FROM iss WHERE bucket = 'not_completed')"""

SPRINT_DIM = """spr AS (
    SELECT DISTINCT year(o_orderdate) * 100 + month(o_orderdate) AS id,
           'Team ' || strftime(o_orderdate, '%Y-%m') AS name,
           strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') || 'T00:00:00.000Z' AS "startDate",
           strftime(last_day(o_orderdate), '%Y-%m-%d') || 'T00:00:00.000Z' AS "endDate"
    FROM orders)"""


def flat_reports_sql(issues: str) -> str:
    return f"""WITH {ISSUES}
        SELECT CAST(sprint_id AS INTEGER) AS sprint_id, sprint_name, sprint_end, bucket,
               issue_key || CASE WHEN n > 1 THEN '/' || n ELSE '' END AS issue_key,
               summary,
               CASE WHEN n_nationkey <> 7 THEN 'Agent ' || n_nationkey
                    WHEN l_linenumber > 2 THEN 'agent7' ELSE 'Unassigned' END AS assignee,
               CASE WHEN l_linenumber <> 5 THEN status END AS status,
               CASE WHEN l_linenumber <> 3 THEN 'type ' || l_linenumber ELSE '3' END AS issue_type,
               priority, CASE WHEN l_linenumber <> 4 THEN story_points END AS story_points,
               url || CASE WHEN n > 1 THEN '/' || n ELSE '' END AS url,
               1 AS relevant
        FROM iss, generate_series(1, {issues}) AS g(n)"""


TOTALS = "tot AS (SELECT assignee, count(*) AS n FROM carried GROUP BY assignee)"

RATE_CELLS = ", ".join(
    f"""CAST(count(*) FILTER (sprint_name = '{s}' AND relevant = 1 AND bucket = 'not_completed')
             AS DOUBLE) / nullif(count(*) FILTER (sprint_name = '{s}' AND relevant = 1), 0) AS "{s}" """
    for s in SPRINTS
)

SPRINT_REPORTS = {
    "unreadable_reports": """SELECT CASE o_orderpriority WHEN '5-LOW' THEN 'unreadable'
            WHEN '1-URGENT' THEN 'no sprintId' ELSE 'read' END AS reason, count(*) AS reports
        FROM orders GROUP BY ALL""",
    "select_sprints": f"""WITH {SPRINT_DIM}, last AS (
            SELECT * FROM spr WHERE name LIKE 'Team 199%' ORDER BY "endDate" DESC, id DESC LIMIT 30)
        SELECT CAST(id AS INTEGER) AS id, name, "startDate", "endDate",
               CAST(row_number() OVER (ORDER BY "endDate", id) AS INTEGER) AS seq FROM last""",
    "select_sprints_year": f"""WITH {SPRINT_DIM}
        SELECT CAST(id AS INTEGER) AS id, name, "startDate", "endDate",
               CAST(row_number() OVER (ORDER BY "endDate", id) AS INTEGER) AS seq
        FROM spr WHERE "startDate" LIKE '1997%'""",
    "flatten_sprint_reports": flat_reports_sql("1"),
    "flatten_sprint_reports_long": flat_reports_sql("1 + l_linenumber % 3"),
    "carryover_rows": f"""WITH {ISSUES}
        SELECT * EXCLUDE (l_linenumber, n_nationkey, sprint_id), CAST(sprint_id AS INTEGER) AS sprint_id
        FROM iss WHERE bucket IN ('not_completed', 'punted')""",
    "carryover_matrix": f"""WITH {ISSUES}
        SELECT assignee, {cells("sprint_name", SPRINTS, "1", "count")}, count(*) AS "TOTAL"
        FROM carried GROUP BY assignee""",
    "carryover_matrix_odd_names": f"""WITH {ISSUES}, odd AS (
            SELECT assignee, 'Team, "1`.5" ' || year(sprint_end) AS sprint_name FROM carried)
        SELECT assignee, {", ".join(
            "count(CASE WHEN sprint_name = '" + s + "' THEN 1 END) AS " + '"' + s.replace('"', '""') + '"'
            for s in data.odd_sprint_names())}, count(*) AS "TOTAL"
        FROM odd GROUP BY assignee""",
    "carryover_trend": f"""WITH {ISSUES}, {TOTALS},
        top AS (SELECT assignee FROM tot ORDER BY n DESC, assignee LIMIT 10),
        s(sprint_name) AS (VALUES {", ".join(f"('{s}')" for s in SPRINTS)})
        SELECT top.assignee, s.sprint_name, count(carried.issue_key) AS carried
        FROM top CROSS JOIN s LEFT JOIN carried
            ON carried.assignee = top.assignee AND carried.sprint_name = s.sprint_name
        GROUP BY ALL""",
    "team_trend": f"""WITH {ISSUES}, {SPRINT_DIM}, n AS (
            SELECT name AS sprint_name, row_number() OVER (ORDER BY "endDate", id) AS seq,
                   (SELECT count(*) FROM carried WHERE sprint_name = name) AS carried FROM spr)
        SELECT sprint_name, CAST(seq AS INTEGER) AS seq, carried,
               avg(carried) OVER (ORDER BY seq ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS moving_avg
        FROM n""",
    "tickets_for": f"""WITH {ISSUES}
        SELECT sprint_name, sprint_end, bucket, issue_key, summary, status, issue_type, priority,
               story_points, url
        FROM iss WHERE assignee = 'NATION_3' AND bucket IN ('not_completed', 'punted')""",
    "repeat_offenders": f"""WITH {ISSUES}
        SELECT issue_key, summary, assignee, CAST(count(DISTINCT sprint_name) AS INTEGER) AS times_carried,
               string_agg(DISTINCT sprint_name, ', ' ORDER BY sprint_name) AS sprints
        FROM carried GROUP BY ALL HAVING count(DISTINCT sprint_name) >= 2""",
    "carryover_rate": f"""WITH {ISSUES}
        SELECT assignee, {RATE_CELLS} FROM iss WHERE assignee <> 'Unassigned'
        GROUP BY assignee HAVING count(*) FILTER (bucket = 'not_completed') > 0""",
    "bucket_counts": f"WITH {ISSUES} SELECT bucket, count(*) AS issues FROM iss GROUP BY bucket",
    "bucket_counts_per_sprint": f"""WITH {ISSUES}
        SELECT sprint_name, bucket, count(*) AS issues FROM iss GROUP BY ALL""",
}


# --- service-desk tickets ---------------------------------------------------------------------

LOCAL = "timezone('Europe/Prague', timezone('UTC', {}))"

ROWS = f"""src AS (
    SELECT *, o_orderdate + to_hours(o_orderkey % 24) AS c_utc,
           CASE WHEN o_orderstatus = 'F'
                THEN o_orderdate + to_hours(o_orderkey % 24 + o_orderkey % 2400) END AS r_utc
    FROM orders JOIN customer ON c_custkey = o_custkey),
tck AS (
    SELECT 'T-' || o_orderkey AS key, 'https://tracker.example/browse/T-' || o_orderkey AS url,
           'order ' || o_orderkey AS summary, c_mktsegment AS issuetype,
           CASE o_orderstatus WHEN 'F' THEN 'Resolved' WHEN 'O' THEN 'Waiting' ELSE 'Working' END AS status,
           CASE o_orderstatus WHEN 'F' THEN 'Done' WHEN 'O' THEN 'To Do' ELSE 'In Progress' END
               AS status_category,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'Highest' WHEN '2-HIGH' THEN 'High'
                WHEN '3-MEDIUM' THEN 'Medium' WHEN '4-NOT SPECIFIED' THEN 'Unset' ELSE 'Lowest' END
               AS priority,
           CASE WHEN c_nationkey = 7 THEN 'Unassigned' ELSE 'Agent ' || c_nationkey END AS assignee,
           c_name AS reporter, 'u' || o_custkey || '@example.org' AS reporter_email,
           CASE WHEN o_orderstatus = 'F' THEN 'Fixed' ELSE '' END AS resolution,
           CASE WHEN o_orderkey % 3 = 0 THEN 'a, ' || o_orderpriority ELSE '' END AS labels,
           c_mktsegment || ', ' || o_orderstatus AS components,
           CAST(CASE WHEN o_orderkey % 4 <> 0 THEN 2 ELSE 0 END AS BIGINT) AS comment_count,
           CASE WHEN o_orderkey % 4 <> 0 THEN 'handled' || chr(10) || 'by' || chr(10) || c_name
                ELSE '' END AS last_comment,
           CASE WHEN o_orderkey % 4 <> 0 THEN c_name ELSE '' END AS last_comment_user,
           CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN false
                ELSE o_totalprice > 250000 END AS breached,
           CASE WHEN o_orderkey % 5 <> 0 AND o_orderstatus <> 'F' THEN '2h' ELSE '' END AS remaining,
           CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderstatus = 'F' THEN '3h' ELSE '1h' END AS elapsed,
           c_utc, r_utc
    FROM src)"""

SLA_NAME = data.SLA_FIELDS["sla_1"]
SLA_COLUMNS = ", ".join(f'{m} AS "{SLA_NAME} — {m}"' for m in ("breached", "remaining", "elapsed"))
AS_OF = f"TIMESTAMP '{data.AS_OF}'"


def days_sql(later: str, earlier: str) -> str:
    return f"CAST(floor((epoch({later}) - epoch({earlier})) / 86400) AS INTEGER)"


FEATURES = f"""{ROWS}, loc AS (
    SELECT *, {LOCAL.format("c_utc")} AS created, {LOCAL.format("c_utc")} AS updated,
           {LOCAL.format("r_utc")} AS resolutiondate FROM tck),
feat AS (
    SELECT *, {days_sql(AS_OF, "created")} AS age_days,
           {days_sql("resolutiondate", "created")} AS resolution_days,
           strftime(created, '%Y-%m') AS month,
           strftime(date_trunc('week', created), '%Y-%m-%d') || '/' ||
               strftime(date_trunc('week', created) + INTERVAL 6 DAY, '%Y-%m-%d') AS week,
           status_category IN ('To Do', 'In Progress') AS is_open
    FROM loc)"""

AGE_CASE = "CASE {} END".format(
    " ".join(
        f"WHEN age_days >= {e} THEN '{x}'" for e, x in reversed(list(zip(AGE_EDGES, AGE_LABELS)))
    )
)


def export_sql(where: str) -> str:
    def stamp(c: str) -> str:
        return f"strftime({c}, '%Y-%m-%d %H:%M') AS {c}"

    return f"""WITH {FEATURES}
    SELECT key, summary, issuetype, status, priority, assignee, reporter, reporter_email, labels,
           comment_count, last_comment, last_comment_user, {stamp("created")}, {stamp("updated")},
           {stamp("resolutiondate")}, age_days, {SLA_COLUMNS}, url
    FROM feat WHERE {where}"""


def count_sql(column: str) -> str:
    return f"WITH {FEATURES} SELECT {column}, count(*) AS count FROM feat GROUP BY {column}"


def tenth(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(18,1))"


TICKETS = {
    "flatten_tickets": f"""WITH {ROWS}
        SELECT * EXCLUDE (breached, remaining, elapsed, c_utc, r_utc), {SLA_COLUMNS},
               strftime(c_utc, '%Y-%m-%dT%H:%M:%S.000+0000') AS created,
               strftime(c_utc, '%Y-%m-%dT%H:%M:%S.000+0000') AS updated,
               strftime(r_utc, '%Y-%m-%dT%H:%M:%S.000+0000') AS resolutiondate
        FROM tck""",
    "last_comment": """SELECT conv_id, count(*) AS comment_count, arg_max(text, turn) AS last_comment,
               arg_max(role, turn) AS last_comment_user FROM conversations GROUP BY conv_id""",
    "document_text": """SELECT conv_id, turn, array_to_string(
                   list_filter(string_split(text, chr(10)), lambda x: x <> ''), chr(10)) AS plain
        FROM conversations""",
    "document_text_deep": """SELECT conv_id,
            string_agg(replace(text, chr(10), ' '), chr(10) ORDER BY turn, text) AS plain
        FROM conversations GROUP BY conv_id""",
    "sla_status": f"WITH {ROWS} SELECT key, breached, remaining, elapsed FROM tck",
    "ticket_features": f"""WITH {FEATURES}
        SELECT key, created, resolutiondate, age_days, resolution_days, month, week, is_open
        FROM feat""",
    "ticket_kpis": f"""WITH {FEATURES}
        SELECT 'Total issues' AS metric, {tenth("count(*)")} AS value FROM feat
        UNION ALL SELECT 'Open', {tenth("count(*) FILTER (is_open)")} FROM feat
        UNION ALL SELECT 'Closed / Done', {tenth("count(*) FILTER (NOT is_open)")} FROM feat
        UNION ALL SELECT 'Avg age open (days)', {rounded("avg(age_days) FILTER (is_open)", 1)} FROM feat
        UNION ALL SELECT 'Avg resolution (days)', {rounded("avg(resolution_days)", 1)} FROM feat""",
    "ticket_kpis_of_documents": f"""WITH {FEATURES}
        SELECT 'Total issues' AS metric, {tenth("count(*)")} AS value FROM feat
        UNION ALL SELECT 'Open', {tenth("count(*) FILTER (is_open)")} FROM feat
        UNION ALL SELECT 'Closed / Done', {tenth("count(*) FILTER (NOT is_open)")} FROM feat
        UNION ALL SELECT 'Avg age open (days)', {rounded("avg(age_days) FILTER (is_open)", 1)} FROM feat
        UNION ALL SELECT 'Avg resolution (days)', {rounded("avg(resolution_days)", 1)} FROM feat""",
    "count_by_status": count_sql("status"),
    "count_by_type": count_sql("issuetype"),
    "count_by_priority": count_sql("priority"),
    "monthly_volume": f"""WITH {FEATURES}, m AS (
            SELECT month, count(*) AS issues FROM feat GROUP BY month)
        SELECT month, issues, {big("sum(issues) OVER (ORDER BY month)")} AS cumulative FROM m""",
    "ordered_priority": f"""WITH {FEATURES},
        o(priority, ordinal) AS (VALUES ('Highest', 1), ('High', 2), ('Medium', 3), ('Low', 4), ('Lowest', 5))
        SELECT priority, count(*) AS count, any_value(ordinal) AS ordinal
        FROM feat JOIN o USING (priority) GROUP BY priority""",
    "assignee_workload": f"""WITH {FEATURES}
        SELECT assignee, count(*) FILTER (NOT is_open) AS closed, count(*) FILTER (is_open) AS open,
               count(*) AS total FROM feat GROUP BY assignee""",
    "top_reporters": f"""WITH {FEATURES}
        SELECT reporter, count(*) AS total, count(*) FILTER (is_open) AS open,
               min(reporter_email) AS email
        FROM feat GROUP BY reporter ORDER BY total DESC, reporter LIMIT 20""",
    "aging_buckets": f"""WITH {FEATURES}, b AS (
            SELECT {AGE_CASE} AS age_bucket FROM feat WHERE is_open)
        SELECT age_bucket, count(*) AS count FROM b WHERE age_bucket IS NOT NULL GROUP BY ALL""",
    "aging_by_assignee": f"""WITH {FEATURES}, b AS (
            SELECT assignee, {AGE_CASE} AS age_bucket FROM feat WHERE is_open)
        SELECT assignee, {cells("age_bucket", AGE_LABELS, "1", "count")}
        FROM b WHERE age_bucket IS NOT NULL GROUP BY assignee""",
    "oldest_open": f"""WITH {FEATURES}
        SELECT key, summary, status, priority, assignee, age_days, created FROM feat WHERE is_open
        ORDER BY age_days DESC, created, key LIMIT 20""",
    "resolution_stats": f"""WITH {FEATURES}, s AS (
            SELECT count(resolution_days) AS count, avg(resolution_days) AS a,
                   stddev_samp(resolution_days) AS sd, min(resolution_days) AS mn,
                   max(resolution_days) AS mx,
                   list(resolution_days ORDER BY resolution_days)
                       FILTER (resolution_days IS NOT NULL) AS l FROM feat)
        SELECT count, {rounded("a", 1)} AS mean, {rounded("sd", 1)} AS std, {rounded("mn", 1)} AS min,
               {rounded(listed_percentile("l", 25), 1)} AS p25,
               {rounded(listed_percentile("l", 50), 1)} AS p50,
               {rounded(listed_percentile("l", 75), 1)} AS p75, {rounded("mx", 1)} AS max FROM s""",
    "resolution_histogram": f"""WITH {FEATURES},
        v AS (SELECT least(resolution_days, 60) AS d FROM feat WHERE resolution_days IS NOT NULL),
        r AS (SELECT min(d) AS lo, max(d) AS hi FROM v),
        b AS (SELECT least((d - lo) * 30 // (hi - lo), 29) AS bin, count(*) AS n FROM v, r GROUP BY ALL),
        s AS (SELECT CAST(unnest(range(30)) AS INTEGER) AS bin)
        SELECT s.bin, CAST(lo AS DOUBLE) + CAST(hi - lo AS DOUBLE) * s.bin / 30 AS from_days,
               CAST(lo AS DOUBLE) + CAST(hi - lo AS DOUBLE) * (s.bin + 1) / 30 AS to_days,
               coalesce(n, 0) AS issues
        FROM s CROSS JOIN r LEFT JOIN b ON b.bin = s.bin""",
    "median_resolution_by_type": f"""WITH {FEATURES}
        SELECT issuetype, CAST(median(resolution_days) AS DOUBLE) AS median_days
        FROM feat WHERE resolution_days IS NOT NULL GROUP BY issuetype""",
    "month_category_matrix": f"""WITH {FEATURES}
        SELECT month, {cells("status_category", ["To Do", "In Progress", "Done"], "1", "count")}
        FROM feat GROUP BY month""",
    "ticket_export": export_sql("true"),
    "ticket_export_open": export_sql("is_open"),
}

ORACLE: dict[str, str] = {**USAGE, **DOCUMENTS, **TOKENS, **SPRINT_REPORTS, **TICKETS}

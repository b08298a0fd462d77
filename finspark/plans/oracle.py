"""DuckDB SQL for each registered query (independent formulation used as
the correctness oracle). Adapters are written once as CTE text.

Recipe (G9): decimal(18,4) addends before every sum, means as
``cast(sum(dec) as double) / count``, dates as DATE, no ``round`` on doubles."""

from __future__ import annotations

D = "decimal(18,4)"


def _income(key_expr: str, join: str, period: str = "last_day(cast(l.l_shipdate as date))",
            name: str = "ds") -> str:
    return f"""
  SELECT {key_expr} AS entity, {period} AS {name},
    cast(sum(cast(l.l_extendedprice * (1.0 - l.l_discount) as {D})) as double) AS revenue,
    cast(sum(case when l.l_returnflag = 'R' then cast(l.l_extendedprice as {D}) else 0 end) as double) AS cogs_materials,
    cast(sum(case when l.l_returnflag = 'A' then cast(l.l_extendedprice as {D}) else 0 end) as double) AS cogs_labor,
    cast(sum(case when l.l_returnflag = 'N' then cast(l.l_extendedprice * l.l_tax as {D}) else 0 end) as double) AS cogs_overhead,
    cast(sum(cast(l.l_extendedprice * l.l_discount as {D})) as double) AS operating_expenses,
    cast(sum(cast(l.l_quantity as {D})) as double) AS interest_expense,
    cast(sum(cast(l.l_extendedprice * l.l_tax as {D})) as double) AS taxes
  FROM lineitem l {join}
  GROUP BY 1, 2"""


INCOME_NATION = _income("cast(s.s_nationkey as bigint)", "JOIN supplier s ON l.l_suppkey = s.s_suppkey")
INCOME_SUPPLIER = _income("cast(l.l_suppkey as bigint)",
                          "WHERE l.l_suppkey IN (SELECT s_suppkey FROM supplier)")
INCOME_SUPPLIER_YEAR = _income("cast(l.l_suppkey as bigint)",
                               "WHERE l.l_suppkey IN (SELECT s_suppkey FROM supplier)",
                               "cast(year(l.l_shipdate) as integer)", "fiscal_year")

ORDERS_MONTHLY = f"""
  SELECT cast(c.c_nationkey as bigint) AS entity, last_day(cast(o.o_orderdate as date)) AS ds,
    sum(case when o.o_orderpriority = '1-URGENT' then cast(o.o_totalprice as {D}) else 0 end) AS capex,
    sum(case when o.o_orderpriority = '1-URGENT' then 1 else 0 end) AS n_urgent,
    cast(sum(case when o.o_orderstatus = 'F' then cast(o.o_totalprice as {D}) else 0 end) as double) AS long_term_debt,
    cast(sum(case when o.o_orderstatus = 'P' then cast(o.o_totalprice as {D}) else 0 end) as double) AS short_term_debt
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2"""

DRIVERS = f"""
  SELECT coalesce(od.ds, ld.ds) AS ds, od.economic_activity_index, od.consumer_confidence_index,
         ld.interest_rate_proxy, ld.ev_component_cost_index
  FROM (SELECT last_day(cast(o_orderdate as date)) AS ds,
               cast(count(*) as double) AS economic_activity_index,
               cast(sum(cast(o_totalprice as {D})) as double) / count(o_totalprice) AS consumer_confidence_index
        FROM orders GROUP BY 1) od
  FULL OUTER JOIN
       (SELECT last_day(cast(l_shipdate as date)) AS ds,
               cast(sum(cast(l_discount as {D})) as double) / count(l_discount) AS interest_rate_proxy,
               cast(sum(cast(l_extendedprice as {D})) as double)
                 / nullif(cast(sum(cast(l_quantity as {D})) as double), 0) AS ev_component_cost_index
        FROM lineitem GROUP BY 1) ld
  ON od.ds = ld.ds"""

DRV = ("economic_activity_index", "consumer_confidence_index", "interest_rate_proxy", "ev_component_cost_index")


def _mean(c: str) -> str:
    return f"cast(sum(cast({c} as {D})) as double) / count({c})"


def _ffill(c: str, part: str = "entity", order: str = "ds") -> str:
    return (f"last_value({c} IGNORE NULLS) OVER (PARTITION BY {part} ORDER BY {order} "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")


CASH_FLOW_FACT = f"""
WITH inc AS ({INCOME_NATION}),
om AS ({ORDERS_MONTHLY}),
cx AS (SELECT entity, ds, cast(capex as double) AS capex_outflow FROM om WHERE n_urgent > 0),
cxm AS (SELECT entity, ds, cast(sum(cast(capex_outflow as {D})) as double) AS capex_outflow FROM cx GROUP BY 1, 2),
db AS (SELECT entity, ds, coalesce(long_term_debt, 0.0) AS long_term_debt, coalesce(short_term_debt, 0.0) AS short_term_debt,
         coalesce((coalesce(long_term_debt, 0.0) + coalesce(short_term_debt, 0.0))
                  - lag(coalesce(long_term_debt, 0.0) + coalesce(short_term_debt, 0.0))
                      OVER (PARTITION BY entity ORDER BY ds), 0.0) AS net_debt_financing_activity
       FROM om),
drv AS ({DRIVERS}),
ind AS (SELECT ds, {', '.join('avg(' + c + ') AS ' + c for c in DRV)} FROM drv GROUP BY ds),
j AS (SELECT inc.entity, inc.ds, revenue, cogs_materials, cogs_labor, cogs_overhead, operating_expenses,
             interest_expense, taxes, coalesce(cxm.capex_outflow, 0.0) AS capex_outflow,
             {', '.join('ind.' + c for c in DRV)},
             coalesce(db.long_term_debt, 0.0) AS long_term_debt, coalesce(db.short_term_debt, 0.0) AS short_term_debt,
             coalesce(db.net_debt_financing_activity, 0.0) AS net_debt_financing_activity
      FROM inc LEFT JOIN cxm ON inc.entity = cxm.entity AND inc.ds = cxm.ds
               LEFT JOIN ind ON inc.ds = ind.ds
               LEFT JOIN db ON inc.entity = db.entity AND inc.ds = db.ds),
f AS (SELECT entity, ds, revenue, cogs_materials, cogs_labor, cogs_overhead, operating_expenses, interest_expense, taxes,
             capex_outflow, {', '.join(_ffill(c) + ' AS ' + c for c in DRV)},
             long_term_debt, short_term_debt, net_debt_financing_activity,
             revenue AS inflow_operating_revenue,
             cogs_materials + cogs_labor + cogs_overhead AS outflow_cogs,
             operating_expenses AS outflow_opex_raw,
             case when operating_expenses < revenue * 0.01 then revenue * 0.15 else operating_expenses end AS outflow_opex,
             interest_expense AS outflow_interest, taxes AS outflow_taxes
      FROM j),
g AS (SELECT *, inflow_operating_revenue - (outflow_cogs + outflow_opex + outflow_interest + outflow_taxes)
                  AS net_operating_cash_flow,
             -capex_outflow AS net_investing_cash_flow, net_debt_financing_activity AS net_financing_cash_flow
      FROM f)
SELECT *, net_operating_cash_flow + net_investing_cash_flow + net_financing_cash_flow AS net_change_in_cash_total FROM g
"""

OPEX_SANITY_PATCH = f"""
WITH inc AS ({INCOME_SUPPLIER})
SELECT entity, ds, revenue, operating_expenses AS outflow_opex_raw,
       case when operating_expenses < revenue * 0.01 then revenue * 0.15 else operating_expenses end AS outflow_opex,
       operating_expenses < revenue * 0.01 AS is_patched
FROM inc
"""

ORACLE: dict[str, str] = {
    "cash_flow_fact": CASH_FLOW_FACT,
    "opex_sanity_patch": OPEX_SANITY_PATCH,
}

CAPEX = f"""SELECT entity, ds, cast(capex as double) AS capex_outflow FROM ({ORDERS_MONTHLY}) om WHERE n_urgent > 0"""

ORACLE["resample_sum"] = f"""
WITH cx AS ({CAPEX}),
rng AS (SELECT entity, date_trunc('month', min(ds)) AS lo, date_trunc('month', max(ds)) AS hi FROM cx GROUP BY 1),
sp AS (SELECT entity, last_day(cast(unnest(generate_series(lo, hi, interval 1 month)) as date)) AS ds FROM rng)
SELECT sp.entity, sp.ds, coalesce(cast(sum(cast(cx.capex_outflow as {D})) as double), 0.0) AS capex_outflow
FROM sp LEFT JOIN cx ON sp.entity = cx.entity AND sp.ds = cx.ds
GROUP BY 1, 2
"""

ORACLE["resample_mean_ffill"] = f"""
WITH e AS (SELECT cast(user_id as bigint) AS entity, cast(ts as date) AS ds, value FROM events),
m AS (SELECT entity, ds, {_mean('value')} AS value FROM e GROUP BY 1, 2),
days AS (SELECT cast(unnest(generate_series(min(ds), max(ds), interval 1 day)) as date) AS ds FROM e),
sp AS (SELECT u.entity, d.ds FROM (SELECT DISTINCT entity FROM e) u, days d),
j AS (SELECT sp.entity, sp.ds, m.value FROM sp LEFT JOIN m ON sp.entity = m.entity AND sp.ds = m.ds)
SELECT entity, ds, {_ffill('value')} AS value FROM j
"""

ORACLE["dim_load"] = """
SELECT name, row_number() OVER (ORDER BY name) AS id
FROM (SELECT p_brand AS name FROM part UNION SELECT p_type FROM part) WHERE name IS NOT NULL
"""

_BRAND_DIM = """SELECT name, row_number() OVER (ORDER BY name) AS id
  FROM (SELECT DISTINCT p_brand AS name FROM part WHERE p_brand IS NOT NULL)"""
_SUPP_DIM = """SELECT name, row_number() OVER (ORDER BY name) AS id
  FROM (SELECT DISTINCT s_name AS name FROM supplier WHERE s_name IS NOT NULL)"""
_BRAND_TEXT = """
  SELECT s.s_name, b.brands || ' ; ' || b.first_brand || ' ; Brandt#' || cast(b.l_suppkey % 7 as varchar) || ' ;' AS brands
  FROM (SELECT l_suppkey, string_agg(p_brand, '; ' ORDER BY p_brand) AS brands, min(p_brand) AS first_brand
        FROM (SELECT DISTINCT l.l_suppkey, p.p_brand FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)
        GROUP BY 1) b
  JOIN supplier s ON b.l_suppkey = s.s_suppkey"""
_BRAND_ITEMS = f"""
  SELECT s_name, item FROM (
    SELECT s_name, trim(unnest(string_split(brands, ';'))) AS item FROM ({_BRAND_TEXT}))
  WHERE item <> ''"""

ORACLE["bridge_explode"] = f"""
SELECT DISTINCT sd.id AS supplier_id, bd.id AS brand_id
FROM ({_BRAND_ITEMS}) i JOIN ({_SUPP_DIM}) sd ON i.s_name = sd.name JOIN ({_BRAND_DIM}) bd ON i.item = bd.name
"""

ORACLE["bridge_unknown_names"] = f"""
SELECT DISTINCT i.s_name, i.item AS unknown_brands
FROM ({_BRAND_ITEMS}) i JOIN ({_SUPP_DIM}) sd ON i.s_name = sd.name
WHERE i.item NOT IN (SELECT name FROM ({_BRAND_DIM}))
"""

ORACLE["fact_append_fk"] = f"""
WITH pd AS (SELECT name, row_number() OVER (ORDER BY name) AS id
            FROM (SELECT DISTINCT 'P' || cast(p_partkey as varchar) AS name FROM part)),
sd AS ({_SUPP_DIM})
SELECT l.l_orderkey, l.l_linenumber, pd.id AS part_id, sd.id AS supplier_id, l.l_quantity, l.l_extendedprice
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN pd ON (case when l.l_linenumber = 7 then 'Q' else 'P' end) || cast(l.l_partkey as varchar) = pd.name JOIN sd ON s.s_name = sd.name
"""

_DUP = """SELECT l_orderkey, l_linenumber, cast(l_shipdate as date) AS l_shipdate, l_partkey, l_suppkey,
                 l_extendedprice, l_quantity FROM lineitem"""


def _dedupe(direction: str) -> str:
    return f"""
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate {direction}, l_partkey {direction}, l_suppkey {direction},
                 l_extendedprice {direction}, l_quantity {direction}) AS rn
  FROM ({_DUP})) WHERE rn = 1
"""


ORACLE["fact_upsert_last_wins"] = _dedupe("DESC")
ORACLE["fact_upsert_first_wins"] = _dedupe("ASC")

ORACLE["unmatched_refs"] = """
SELECT o_orderkey, o_custkey, o_totalprice, cast(o_orderdate as date) AS o_orderdate FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
"""

ORACLE["profile_pivot"] = "SELECT user_id, " + ", ".join(
    f"cast(sum(case when event_type = '{t}' then cast(value as {D}) end) as double) AS {t}"
    for t in ("click", "error", "purchase", "signup", "view")) + " FROM events WHERE user_id IS NOT NULL GROUP BY 1"

ORACLE["goal_year_extract"] = """
WITH g AS (SELECT o_orderkey, o_orderpriority AS goal,
                  case when o_orderstatus = 'P' then 'Improve ' || o_orderpriority
                       else 'Target ' || o_orderpriority || ' by ' || cast(year(o_orderdate) as varchar) end AS description
           FROM orders)
SELECT o_orderkey, concat_ws(' - ', goal, description) AS goal_description,
       try_cast(nullif(regexp_extract(description, 'by\\s+(\\d{4})', 1), '') as integer) AS target_year
FROM g
"""

ORACLE["percent_text_clean"] = """
WITH s AS (SELECT l_orderkey, l_linenumber,
                  case when l_discount = 0 then 'N/A' when l_linenumber = 7 then 'abc'
                       when l_linenumber = 6 then NULL
                       else cast(cast(round(l_discount * 100.0) as bigint) as varchar) || '%' end AS uplift_text,
                  l_quantity AS duration_months
           FROM lineitem)
SELECT l_orderkey, l_linenumber, uplift_text,
       case when upper(trim(uplift_text)) = 'N/A' then NULL
            else try_cast(replace(trim(uplift_text), '%', '') as double) / 100.0 end AS sales_uplift_est,
       cast(duration_months as integer) AS duration_months
FROM s
"""

ORACLE["money_text_clean"] = """
WITH c AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, cast(round(o_totalprice * 100) as bigint) AS cents FROM orders),
t AS (SELECT o_orderkey,
             case when o_orderstatus = 'P' then '  ' when o_orderpriority = '5-LOW' then 'n/a'
                  else cast(cents // 100000 as varchar) || ',' || lpad(cast((cents // 100) % 1000 as varchar), 3, '0')
                       || '.' || lpad(cast(cents % 100 as varchar), 2, '0') end AS money_text
      FROM c)
SELECT o_orderkey, money_text, try_cast(nullif(trim(replace(money_text, ',', '')), '') as double) AS amount FROM t
"""

ORACLE["latest_per_group"] = """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT o_custkey, o_orderkey, cast(o_orderdate as date) AS o_orderdate, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1
"""

ORACLE["nway_outer"] = f"""
WITH inc AS (SELECT entity, ds, revenue FROM ({INCOME_NATION})),
cx AS ({CAPEX}),
db AS (SELECT entity, ds, long_term_debt FROM ({ORDERS_MONTHLY}))
SELECT coalesce(inc.entity, cx.entity, db.entity) AS entity, coalesce(inc.ds, cx.ds, db.ds) AS ds,
       inc.revenue, cx.capex_outflow, db.long_term_debt
FROM inc FULL OUTER JOIN cx ON inc.entity = cx.entity AND inc.ds = cx.ds
FULL OUTER JOIN db ON coalesce(inc.entity, cx.entity) = db.entity AND coalesce(inc.ds, cx.ds) = db.ds
"""

BALANCE_YEAR_END = """
  SELECT nation, fiscal_year,
    o_totalprice * 10.0 AS total_assets, o_totalprice * 6.0 AS total_current_assets,
    o_totalprice * 0.5 AS inventory_raw_materials, o_totalprice * 0.25 AS inventory_wip,
    o_totalprice * 0.75 AS inventory_finished_goods, o_totalprice * 1.5 AS accounts_payable,
    o_totalprice * 2.0 AS long_term_debt, o_totalprice * 0.5 AS short_term_debt,
    o_totalprice * 3.0 AS total_current_liabilities, o_totalprice * 4.0 - c_acctbal AS total_liabilities,
    o_totalprice * 6.0 + c_acctbal AS total_equity, c_acctbal AS cash
  FROM (SELECT cast(c.c_nationkey as bigint) AS nation, cast(year(o.o_orderdate) as integer) AS fiscal_year, o.o_totalprice, c.c_acctbal,
               row_number() OVER (PARTITION BY c.c_nationkey, year(o.o_orderdate)
                                  ORDER BY o.o_orderdate DESC, o.o_orderkey DESC) AS rn
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey) WHERE rn = 1"""

BAL_COLS = ("total_assets", "total_current_assets", "inventory_raw_materials", "inventory_wip",
            "inventory_finished_goods", "accounts_payable", "long_term_debt", "short_term_debt",
            "total_current_liabilities", "total_liabilities", "total_equity", "cash")
INC_COLS = ("revenue", "cogs_materials", "cogs_labor", "cogs_overhead", "operating_expenses",
            "interest_expense", "taxes")

ORACLE["peer_statement_merge"] = f"""
WITH i0 AS (SELECT entity AS competitor_id, fiscal_year, {', '.join(INC_COLS)} FROM ({INCOME_SUPPLIER_YEAR})),
inc AS (SELECT * FROM i0 UNION ALL SELECT * REPLACE (cast(2010 as integer) AS fiscal_year) FROM i0 WHERE fiscal_year = 1997),
b0 AS (SELECT cast(s.s_suppkey as bigint) AS competitor_id, b.fiscal_year, {', '.join('b.' + c for c in BAL_COLS)}
        FROM ({BALANCE_YEAR_END}) b JOIN supplier s ON b.nation = cast(s.s_nationkey as bigint)
),
bal AS (SELECT * FROM b0 UNION ALL SELECT * REPLACE (cast(2011 as integer) AS fiscal_year) FROM b0 WHERE fiscal_year = 1995)
SELECT coalesce(inc.competitor_id, bal.competitor_id) AS competitor_id, coalesce(inc.fiscal_year, bal.fiscal_year) AS fiscal_year,
       {', '.join('inc.' + c for c in INC_COLS)}, {', '.join('bal.' + c for c in BAL_COLS)}
FROM inc FULL OUTER JOIN bal ON inc.competitor_id = bal.competitor_id AND inc.fiscal_year = bal.fiscal_year
"""


BALANCE_MONTHLY = """
  SELECT nation, balance_date,
    o_totalprice * 10.0 AS total_assets, o_totalprice * 6.0 AS total_current_assets,
    o_totalprice * 0.5 AS inventory_raw_materials, o_totalprice * 0.25 AS inventory_wip,
    o_totalprice * 0.75 AS inventory_finished_goods, o_totalprice * 1.5 AS accounts_payable,
    o_totalprice * 2.0 AS long_term_debt, o_totalprice * 0.5 AS short_term_debt,
    o_totalprice * 3.0 AS total_current_liabilities, o_totalprice * 4.0 - c_acctbal AS total_liabilities,
    o_totalprice * 6.0 + c_acctbal AS total_equity, c_acctbal AS cash
  FROM (SELECT cast(c.c_nationkey as bigint) AS nation, last_day(cast(o.o_orderdate as date)) AS balance_date,
               o.o_totalprice, c.c_acctbal,
               row_number() OVER (PARTITION BY c.c_nationkey, last_day(cast(o.o_orderdate as date))
                                  ORDER BY o.o_orderdate DESC, o.o_orderkey DESC) AS rn
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey) WHERE rn = 1"""

YEAR_END = f"""
  SELECT nation, cast(year(balance_date) as integer) AS fiscal_year, total_assets,
         inventory_raw_materials + inventory_wip + inventory_finished_goods AS inventory,
         accounts_payable, long_term_debt, total_current_assets, total_current_liabilities,
         total_liabilities, total_equity, cash AS cash_and_equivalents
  FROM (SELECT *, row_number() OVER (PARTITION BY nation, year(balance_date) ORDER BY balance_date DESC) AS rn
        FROM ({BALANCE_MONTHLY})) WHERE rn = 1"""

_INCM = f"SELECT * FROM ({INCOME_SUPPLIER})"
_dd = lambda c: f"cast({c} as {D})"
_COGS = f"({_dd('cogs_materials')} + {_dd('cogs_labor')} + {_dd('cogs_overhead')})"
ANNUAL = f"""
  SELECT i.entity, i.fiscal_year, i.total_revenue, i.cost_of_revenue, i.gross_profit, i.operating_income,
         i.interest_expense, i.net_income, b.total_assets, b.inventory, b.accounts_payable, b.long_term_debt,
         b.total_current_assets, b.total_current_liabilities, b.total_liabilities, b.total_equity,
         b.cash_and_equivalents
  FROM (SELECT entity, cast(year(ds) as integer) AS fiscal_year,
               cast(sum({_dd('revenue')}) as double) AS total_revenue,
               cast(sum({_COGS}) as double) AS cost_of_revenue,
               cast(sum({_dd('revenue')} - {_COGS}) as double) AS gross_profit,
               cast(sum({_dd('revenue')} - {_COGS} - {_dd('operating_expenses')}) as double) AS operating_income,
               cast(sum({_dd('interest_expense')}) as double) AS interest_expense,
               cast(sum({_dd('revenue')} - {_COGS} - {_dd('operating_expenses')} - {_dd('interest_expense')}
                        - {_dd('taxes')}) as double) AS net_income
        FROM ({_INCM}) GROUP BY 1, 2) i
  JOIN (SELECT cast(s.s_suppkey as bigint) AS entity, y.* EXCLUDE (nation)
        FROM ({YEAR_END}) y JOIN supplier s ON y.nation = cast(s.s_nationkey as bigint)) b
    ON i.entity = b.entity AND i.fiscal_year = b.fiscal_year"""

ORACLE["annual_statements"] = ANNUAL

_LEVEL = [
    ("Profitability", "Gross Profit Margin", "gross_profit", "total_revenue"),
    ("Profitability", "Operating Profit Margin", "operating_income", "total_revenue"),
    ("Profitability", "Net Profit Margin", "net_income", "total_revenue"),
    ("Profitability", "Return on Assets (ROA)", "net_income", "total_assets"),
    ("Profitability", "Return on Equity (ROE)", "net_income", "total_equity"),
    ("Liquidity", "Current Ratio", "total_current_assets", "total_current_liabilities"),
    ("Liquidity", "Quick Ratio (Acid Test)", "(total_current_assets - inventory)", "total_current_liabilities"),
    ("Solvency", "Debt-to-Equity Ratio", "total_liabilities", "total_equity"),
    ("Solvency", "Debt-to-Assets Ratio", "total_liabilities", "total_assets"),
    ("Solvency", "Interest Coverage Ratio", "operating_income", "interest_expense"),
    ("Efficiency", "Asset Turnover", "total_revenue", "total_assets"),
    ("Efficiency", "Inventory Turnover", "cost_of_revenue", "inventory"),
]
ORACLE["financial_ratios"] = f"WITH a AS ({ANNUAL})\nSELECT * FROM (\n" + "\nUNION ALL\n".join(
    f"SELECT entity, fiscal_year, '{cat}' AS ratio_category, '{name}' AS ratio_name, "
    f"cast({num} as double) / nullif(cast({den} as double), 0) AS ratio_value FROM a"
    for cat, name, num, den in _LEVEL) + "\n) WHERE ratio_value IS NOT NULL"

ORACLE["growth_yoy"] = f"""
WITH a AS ({ANNUAL}),
p AS (SELECT entity, fiscal_year, total_revenue, net_income,
             lag(total_revenue) OVER (PARTITION BY entity ORDER BY fiscal_year) AS prev_rev,
             lag(net_income) OVER (PARTITION BY entity ORDER BY fiscal_year) AS prev_ni FROM a)
SELECT * FROM (
  SELECT entity, fiscal_year, 'Growth' AS ratio_category, 'Revenue Growth YoY' AS ratio_name,
         (total_revenue - prev_rev) / nullif(abs(prev_rev), 0) AS ratio_value FROM p
  UNION ALL
  SELECT entity, fiscal_year, 'Growth', 'Net Income Growth YoY',
         (net_income - prev_ni) / nullif(abs(prev_ni), 0) FROM p
) WHERE ratio_value IS NOT NULL"""

ORACLE["derive_equity"] = f"""
WITH y AS (SELECT y.nation, y.fiscal_year, y.total_assets, y.total_liabilities,
                  case when n.n_regionkey IN (0, 2) OR (y.nation = 1 AND y.fiscal_year = 1998) then NULL
                       else y.total_equity end AS total_equity
           FROM ({YEAR_END}) y JOIN nation n ON y.nation = cast(n.n_nationkey as bigint)),
f AS (SELECT nation, count(total_equity) = 0 AND count(total_assets) > 0 AND count(total_liabilities) > 0 AS d
      FROM y GROUP BY nation)
SELECT y.nation, y.fiscal_year, y.total_assets, y.total_liabilities,
       case when f.d then y.total_assets - y.total_liabilities else y.total_equity end AS total_equity
FROM y JOIN f ON y.nation = f.nation
"""

DEPTS = f"""
  SELECT concat_ws('-', c_mktsegment, cast(c_nationkey as varchar)) AS department, requested AS requested_budget,
         case when n_regionkey = 1 then NULL else requested * 0.7 end AS min_required,
         case when n_regionkey = 3 then NULL else requested * 1.2 end AS max_plausible,
         cast(bal as double) / cast(n as double) / 1000.0 AS roi_score,
         cast(n as double) / 10.0 AS efficiency_score,
         25.0 - cast(c_nationkey as double) AS strategic_score
  FROM (SELECT c_mktsegment, c_nationkey, sum(cast(abs(c_acctbal) as {D})) AS requested,
               sum(cast(c_acctbal as {D})) AS bal, count(*) AS n
        FROM customer GROUP BY 1, 2) g JOIN nation ON g.c_nationkey = nation.n_nationkey"""

ALLOCATION = f"""
WITH d AS ({DEPTS}),
sc AS (SELECT scenario, cast(f as decimal(2,1)) * (SELECT sum(requested_budget) FROM d) AS cap
       FROM (VALUES ('full', '1.0'), ('tight', '0.8'), ('infeasible', '0.5')) t(scenario, f)),
x AS (SELECT sc.scenario, d.department, d.requested_budget, d.min_required, d.max_plausible,
             0.5 * roi_score + 0.2 * efficiency_score + 0.3 * strategic_score AS value_factor,
             cast(coalesce(min_required, 0) as decimal(38,6)) AS lo,
             greatest(cast(coalesce(max_plausible, requested_budget * 1.5) as decimal(38,6)),
                      cast(coalesce(min_required, 0) as decimal(38,6))) AS hi,
             cast(sc.cap as decimal(38,6)) AS cap
      FROM d, sc),
y AS (SELECT *, sum(lo) OVER (PARTITION BY scenario) AS sum_lo,
             coalesce(sum(hi - lo) OVER (PARTITION BY scenario ORDER BY value_factor DESC, department
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM x)
SELECT scenario, department, cast(requested_budget as double) AS requested_budget,
       cast(min_required as double) AS min_required, cast(max_plausible as double) AS max_plausible, value_factor,
       cast(lo + case when value_factor > 0 then least(hi - lo, greatest(0, cap - sum_lo - before)) else 0 end
            as double) AS optimized_allocation
FROM y WHERE sum_lo <= cap"""

ORACLE["budget_allocation"] = ALLOCATION
ORACLE["budget_pivot"] = f"""
WITH a AS ({ALLOCATION})
SELECT department, max(case when scenario = 'full' then optimized_allocation end) AS "full",
       max(case when scenario = 'tight' then optimized_allocation end) AS "tight"
FROM a GROUP BY department"""

_SHOCKS = """(VALUES ('tariff', 'ev_component_cost_index', cast(0.25 as double), DATE '1998-03-01', DATE '1999-06-30'),
         ('tariff', 'consumer_confidence_index', cast(-0.15 as double), DATE '1998-03-01', DATE '1999-06-30'),
         ('recession', 'economic_activity_index', cast(-0.05 as double), DATE '2000-01-01', DATE '2000-12-31'),
         ('recession', 'interest_rate_proxy', cast(0.10 as double), DATE '2000-01-01', DATE '2000-12-31'))
        sh(scenario, driver, pct, s, e)"""


def _factor(col: str, scen: str, ds: str, shocks: str = "shk") -> str:
    return (f"coalesce((SELECT product(1.0 + pct) FROM {shocks} WHERE {shocks}.scenario = {scen} "
            f"AND {shocks}.driver = '{col}' AND {ds} BETWEEN {shocks}.s AND {shocks}.e), 1.0)")


ORACLE["driver_shock"] = f"""
WITH drv AS ({DRIVERS}),
shk AS (SELECT * FROM {_SHOCKS}),
sc AS (SELECT DISTINCT scenario FROM shk)
SELECT sc.scenario, drv.ds, {', '.join(f"drv.{c} * {_factor(c, 'sc.scenario', 'drv.ds')} AS {c}" for c in DRV)}
FROM drv, sc
"""

ORACLE["scenario_overlay"] = f"""
WITH drv AS ({DRIVERS}),
alt AS (SELECT ds, economic_activity_index * 1.0 AS economic_activity_index,
               consumer_confidence_index * (1.0 + cast(-0.15 as double)) AS consumer_confidence_index,
               interest_rate_proxy * 1.0 AS interest_rate_proxy,
               ev_component_cost_index * (1.0 + cast(0.25 as double)) AS ev_component_cost_index
        FROM drv)
SELECT drv.ds, {', '.join(f"case when drv.ds BETWEEN DATE '1998-01-31' AND DATE '1999-06-30' then alt.{c} else drv.{c} end AS {c}" for c in DRV)}
FROM drv LEFT JOIN alt ON drv.ds = alt.ds
"""

ORDER_REVENUE_NATION = f"""
  SELECT cast(c.c_nationkey as bigint) AS entity, last_day(cast(o.o_orderdate as date)) AS ds,
         cast(sum(cast(o.o_totalprice as {D})) as double) AS revenue
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2"""

ORACLE["history_splice"] = f"""
WITH older AS (SELECT entity, last_day(cast(ds - interval 36 month as date)) AS ds, revenue FROM ({ORDER_REVENUE_NATION})),
newer AS (SELECT entity, ds, revenue FROM ({INCOME_NATION})),
f AS (SELECT entity, min(ds) AS first_ds FROM newer GROUP BY 1)
SELECT o.entity, o.ds, o.revenue, 'synthetic' AS source FROM older o LEFT JOIN f ON o.entity = f.entity
WHERE f.first_ds IS NULL OR o.ds < f.first_ds
UNION ALL
SELECT entity, ds, revenue, 'actual' FROM newer
"""


_TWO96 = f"cast({2 ** 96} as hugeint)"


def _exact_sum(expr: str) -> str:
    """Sum of doubles without rounding between rows: whole parts and parts
    below one (in units of 2^-96) as two integer sums, written out in digits
    of 24 bits and turned into a double from the largest one on."""
    whole = f"sum(cast(trunc({expr}) as hugeint))"
    part = f"sum(cast((({expr}) - trunc({expr})) * {float(2 ** 96)!r} as hugeint))"
    down = lambda h, f: f"({h} + {f} // {_TWO96} - (case when {f} % {_TWO96} < 0 then 1 else 0 end))"
    sign = f"case when {down('_s.h', '_s.f')} < 0 then -1 else 1 end"
    digits = [f"cast((_t.h // cast({2 ** (24 * k)} as hugeint)) % 16777216 as double) * {float(2 ** (24 * k))!r}" for k in range(4, -1, -1)]
    digits += [f"cast((_t.f // cast({2 ** (24 * (4 - k))} as hugeint)) % 16777216 as double) * {2.0 ** (-24 * k)!r}" for k in range(1, 5)]
    return (f"list_transform(list_transform(list_transform([{{'h': {whole}, 'f': {part}}}], lambda _s: {{'s': _s, 'g': {sign}}}), "
            f"lambda _r: {{'g': _r.g, 'h': {down('_r.g * _r.s.h', '_r.g * _r.s.f')}, "
            f"'f': (_r.g * _r.s.f) % {_TWO96} + (case when (_r.g * _r.s.f) % {_TWO96} < 0 then {_TWO96} else 0 end)}}), "
            f"lambda _t: _t.g * (0.0::double + {' + '.join(digits)}))[1]")


def _exact_mean(expr: str) -> str:
    return f"{_exact_sum(expr)} / nullif(cast(count({expr}) as double), 0)"


CALIBRATION = f"""
  SELECT entity, cast(sum(cast(inflow_operating_revenue as {D})) as double) / count(inflow_operating_revenue) AS avg_revenue,
         {_exact_mean('outflow_cogs / nullif(inflow_operating_revenue, 0)')} AS avg_cogs_ratio,
         {_exact_mean('outflow_opex / nullif(inflow_operating_revenue, 0)')} AS avg_opex_ratio,
         count(*) AS n_months
  FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY ds) AS rn FROM ({CASH_FLOW_FACT}))
  WHERE rn <= 12 GROUP BY entity"""

ORACLE["calibration_stats"] = CALIBRATION

DRIVERS_NATION = f"""
  SELECT coalesce(od.entity, ld.entity) AS entity, coalesce(od.ds, ld.ds) AS ds,
         od.economic_activity_index, od.consumer_confidence_index, ld.interest_rate_proxy, ld.ev_component_cost_index
  FROM (SELECT cast(c.c_nationkey as bigint) AS entity, last_day(cast(o.o_orderdate as date)) AS ds,
               cast(count(*) as double) AS economic_activity_index,
               cast(sum(cast(o.o_totalprice as {D})) as double) / nullif(cast(count(o.o_totalprice) as double), 0)
                 AS consumer_confidence_index
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2) od
  FULL OUTER JOIN
       (SELECT cast(s.s_nationkey as bigint) AS entity, last_day(cast(l.l_shipdate as date)) AS ds,
               cast(sum(cast(l.l_discount as {D})) as double) / nullif(cast(count(l.l_discount) as double), 0)
                 AS interest_rate_proxy,
               cast(sum(cast(l.l_extendedprice as {D})) as double) / nullif(cast(sum(cast(l.l_quantity as {D})) as double), 0)
                 AS ev_component_cost_index
        FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey GROUP BY 1, 2) ld
  ON od.entity = ld.entity AND od.ds = ld.ds"""

ORACLE["synthetic_history"] = f"""
WITH m AS (SELECT *, economic_activity_index AS total_vehicle_sales, ev_component_cost_index AS cpi,
                  row_number() OVER (PARTITION BY entity ORDER BY ds DESC) AS rn FROM ({DRIVERS_NATION})),
st AS (SELECT entity, {_exact_mean('case when rn <= 12 then total_vehicle_sales end')} AS market,
              {_exact_mean('cpi')} AS cpi_mean
       FROM m GROUP BY entity),
c AS ({CALIBRATION}),
x AS (SELECT m.*, st.market, st.cpi_mean, coalesce(c.avg_revenue, 500000000.0) AS scale,
             coalesce(c.avg_cogs_ratio, 0.65) AS r_cogs, coalesce(c.avg_opex_ratio, 0.15) AS r_opex
      FROM m JOIN st ON m.entity = st.entity LEFT JOIN c ON m.entity = c.entity),
y AS (SELECT *, total_vehicle_sales * (scale / nullif(market, 0)) AS inflow_operating_revenue FROM x)
SELECT entity, ds, inflow_operating_revenue, inflow_operating_revenue * r_cogs * (cpi / nullif(cpi_mean, 0)) AS outflow_cogs,
       inflow_operating_revenue * r_opex AS outflow_opex, cpi AS ev_component_cost_index,
       interest_rate_proxy, consumer_confidence_index
FROM y
"""

def _noise(seed: int, *keys: str) -> str:
    """Twelve 20-bit numbers out of two md5 sums, summed and centred."""
    text = f"'{seed}' || " + " || ".join(f"'|' || coalesce(cast({k} as varchar), '')" for k in keys)
    parts = [f"cast(cast('0x' || substr(md5('{h}' || {text}), {5 * i + 1}, 5) as bigint) as double)" for h in "ab" for i in range(6)]
    return f"(({' + '.join(parts)} + 6.0) / 1048576.0 - 6.0)"


ORACLE["synthetic_history_noise"] = ORACLE["synthetic_history"].replace(
    "total_vehicle_sales * (scale / nullif(market, 0)) AS",
    f"total_vehicle_sales * (scale / nullif(market, 0)) * (1.0 + 0.02 * {_noise(42, 'm_entity', 'm_ds')}) AS").replace(
    "x AS (SELECT m.*,", "x AS (SELECT m.*, m.entity AS m_entity, m.ds AS m_ds,").replace(
    """cpi AS ev_component_cost_index,
       interest_rate_proxy, consumer_confidence_index""", "").replace("AS outflow_opex, ", "AS outflow_opex ")

ORACLE["backtest_rescaled_truth"] = f"""
WITH m AS (SELECT entity, ds, economic_activity_index AS sales FROM ({DRIVERS_NATION})),
b AS (SELECT entity, {_exact_mean('sales')} AS base FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY ds DESC) AS rn
      FROM m WHERE ds < DATE '2000-01-01') WHERE rn <= 12 GROUP BY entity),
t AS (SELECT m.entity, m.ds, sales * (500000000.0 / nullif(base, 0)) AS y FROM m JOIN b ON m.entity = b.entity),
s AS (SELECT t.entity, t.y, p.y AS yhat FROM t JOIN t p ON p.entity = t.entity AND p.ds = last_day(t.ds - INTERVAL 12 MONTH)
      WHERE t.ds >= DATE '2000-01-01' AND t.y IS NOT NULL AND p.y IS NOT NULL),
e AS (SELECT entity, count(*) AS n_test, {_exact_mean('abs(y - yhat) / greatest(abs(y), 2.220446049250313e-16)')} AS mape FROM s GROUP BY entity)
SELECT entity, n_test, mape, case when mape < 0.10 then 'EXCELLENT' when mape < 0.20 then 'ACCEPTABLE' else 'VOLATILE' end AS verdict FROM e
"""

_COMP = ("inflow_operating_revenue", "outflow_cogs", "outflow_opex")

ORACLE["holdout_metrics"] = f"""
WITH f AS ({CASH_FLOW_FACT}),
l AS ({' UNION ALL '.join(f"SELECT entity, '{c}' AS component, ds, {c} AS y FROM f" for c in _COMP)}),
j AS (SELECT l.entity, l.component, l.ds, l.y, p.y AS yhat FROM l
      LEFT JOIN l p ON p.entity = l.entity AND p.component = l.component AND last_day(p.ds + INTERVAL 12 MONTH) = l.ds),
h AS (SELECT *, row_number() OVER (PARTITION BY entity, component ORDER BY ds DESC) AS rn FROM j)
SELECT entity, component, count(case when y IS NOT NULL AND yhat IS NOT NULL then 1 end) AS n,
       {_exact_mean('abs(y - yhat)')} AS mae,
       sqrt({_exact_mean('(y - yhat) * (y - yhat)')}) AS rmse,
       {_exact_mean('abs((y - yhat) / nullif(y, 0))')} * 100.0 AS mape
FROM h WHERE rn <= 6 GROUP BY 1, 2
"""

ORACLE["backtest_verdict"] = f"""
WITH inc AS (SELECT entity, ds, revenue AS y FROM ({INCOME_NATION})),
tr AS (SELECT entity, month(ds) AS moy, y AS yhat FROM inc WHERE ds < DATE '2000-01-01' AND ds >= DATE '1999-01-01'),
s AS (SELECT i.entity, i.ds, i.y, tr.yhat FROM inc i LEFT JOIN tr ON i.entity = tr.entity AND month(i.ds) = tr.moy
      WHERE i.ds >= DATE '2000-01-01' AND i.y IS NOT NULL AND tr.yhat IS NOT NULL),
m AS (SELECT entity, count(*) AS n_test,
             {_exact_mean('abs(y - yhat) / greatest(abs(y), 2.220446049250313e-16)')} AS mape
      FROM s GROUP BY 1)
SELECT entity, n_test, mape,
       case when mape < 0.10 then 'EXCELLENT' when mape < 0.20 then 'ACCEPTABLE' else 'VOLATILE' end AS verdict
FROM m
"""

_COMP_WIDE = f"""
  SELECT f.entity, f.ds,
         case when f.ds <= DATE '2000-12-31' then f.inflow_operating_revenue end AS rev_a,
         case when f.ds <= DATE '2000-12-31' then f.outflow_cogs end AS cogs_a,
         case when f.ds <= DATE '2000-12-31' then f.outflow_opex end AS opex_a,
         p.inflow_operating_revenue AS rev_f, p.outflow_cogs AS cogs_f, p.outflow_opex AS opex_f
  FROM f LEFT JOIN f p ON p.entity = f.entity AND last_day(p.ds + INTERVAL 12 MONTH) = f.ds"""
_HIST = """SELECT entity, ds, interest_expense AS h_int, taxes AS h_tax, long_term_debt AS h_ltd,
                  net_debt_financing_activity AS h_nf, capex_outflow AS h_capex FROM f WHERE ds <= DATE '2000-12-31'"""

ORACLE["net_cash_rollup"] = f"""
WITH f AS ({CASH_FLOW_FACT}),
comp AS ({_COMP_WIDE}),
h AS ({_HIST}),
cx AS (SELECT entity, ds, sum(capex_outflow) AS capex FROM ({CAPEX}) GROUP BY 1, 2),
j AS (SELECT c.*, coalesce(rev_a, rev_f) AS rev, coalesce(cogs_a, cogs_f) AS cogs, coalesce(opex_a, opex_f) AS opex,
             h.h_int, h.h_tax, h.h_ltd, h.h_nf, coalesce(cast(cx.capex as double), 0.0) AS capex
      FROM comp c LEFT JOIN h ON c.entity = h.entity AND c.ds = h.ds
                  LEFT JOIN cx ON c.entity = cx.entity AND c.ds = cx.ds),
st AS (SELECT entity, min(case when rev_a IS NULL then ds end) AS start FROM j GROUP BY 1),
j2 AS (SELECT j.*, st.start FROM j LEFT JOIN st ON j.entity = st.entity),
lt AS (SELECT entity, arg_max(h_ltd, ds) FILTER (WHERE ds < start AND h_ltd IS NOT NULL) AS last_ltd FROM j2 GROUP BY 1),
k AS (SELECT j2.*, case when ds >= start then coalesce(lt.last_ltd, 0.0) end AS ltd
      FROM j2 LEFT JOIN lt ON j2.entity = lt.entity),
k2 AS (SELECT *, coalesce(h_int, coalesce(ltd, 0.0) * 0.03 / 12.0) AS interest_final FROM k),
k3 AS (SELECT *, coalesce(coalesce(rev - (cogs + opex), rev_f - (cogs_f + opex_f)), 0.0)
                 - coalesce(interest_final, 0.0) AS ebt FROM k2),
k4 AS (SELECT *, coalesce(h_tax, case when ebt > 0 then ebt * 0.25 else 0.0 end) AS taxes_final FROM k3),
k5 AS (SELECT *, rev - (cogs + opex + interest_final + taxes_final) AS cfo, -coalesce(capex, 0.0) AS cfi,
              coalesce(coalesce(h_nf, 0.0), 0.0) AS cff FROM k4)
SELECT entity, ds, rev AS inflow_operating_revenue_final, cogs AS outflow_cogs_final, opex AS outflow_opex_final,
       interest_final AS outflow_interest_final, taxes_final AS outflow_taxes_final,
       cfo AS net_operating_cash_flow, cfi AS net_investing_cash_flow, cff AS net_financing_cash_flow,
       coalesce(cfo, 0.0) + coalesce(cfi, 0.0) + coalesce(cff, 0.0) AS net_change_in_cash_total
FROM k5
"""

_ELAST = f"""
drv AS ({DRIVERS}),
alt AS (SELECT ds,
          economic_activity_index * (case when ds BETWEEN DATE '2000-06-01' AND DATE '2001-06-30'
                                          then 1.0 + cast(-0.05 as double) else 1.0 end) AS economic_activity_index,
          consumer_confidence_index * (case when ds BETWEEN DATE '2000-06-01' AND DATE '2001-06-30'
                                            then 1.0 + cast(-0.15 as double) else 1.0 end) AS consumer_confidence_index,
          ev_component_cost_index * 1.0 AS ev_component_cost_index
        FROM drv),
ind AS (SELECT b.ds,
          (a.economic_activity_index - b.economic_activity_index) / nullif(b.economic_activity_index, 0) AS activity_pct_delta,
          (a.consumer_confidence_index - b.consumer_confidence_index) / nullif(b.consumer_confidence_index, 0) AS confidence_pct_delta,
          (a.ev_component_cost_index - b.ev_component_cost_index) / nullif(b.ev_component_cost_index, 0) AS cost_pct_delta
        FROM drv b JOIN alt a ON b.ds = a.ds),
el AS (SELECT c.entity, c.ds, c.rev_a, c.rev_f, c.cogs_a, c.cogs_f, c.opex_a, c.opex_f,
          case when c.rev_a IS NULL
               then coalesce(c.rev_a, c.rev_f) * (1.0 + (0.6 * coalesce(ind.activity_pct_delta, 0.0)
                                                         + 0.4 * coalesce(ind.confidence_pct_delta, 0.0)))
               else coalesce(c.rev_a, c.rev_f) end AS rev,
          coalesce(c.cogs_a, c.cogs_f) AS cogs, coalesce(c.opex_a, c.opex_f) AS opex,
          ind.activity_pct_delta, ind.confidence_pct_delta, ind.cost_pct_delta
        FROM comp c LEFT JOIN ind ON c.ds = ind.ds)"""

ORACLE["elasticity_overlay"] = f"""
WITH f AS ({CASH_FLOW_FACT}),
comp AS ({_COMP_WIDE}),
{_ELAST}
SELECT entity, ds, rev AS inflow_operating_revenue_final, cogs AS outflow_cogs_final, opex AS outflow_opex_final,
       activity_pct_delta, confidence_pct_delta, cost_pct_delta
FROM el
"""


def _everywhere(src: str) -> str:
    return f"""
  SELECT x.entity, x.ds,
         x.rev - (x.cogs + x.opex + x.interest_final + x.taxes_final) - coalesce(x.h_capex, 0.0)
           + coalesce(x.h_nf, 0.0) AS total
  FROM (SELECT y.*, coalesce(y.h_tax, case when y.ebt > 0 then y.ebt * 0.25 else 0.0 end) AS taxes_final
        FROM (SELECT z.*, (z.rev - (z.cogs + z.opex)) - z.interest_final AS ebt
              FROM (SELECT s.entity, s.ds, s.rev, s.cogs, s.opex, h.h_tax, h.h_nf, h.h_capex,
                           coalesce(h.h_int, coalesce(lt.last_ltd, 0.0) * 0.03 / 12.0) AS interest_final
                    FROM ({src}) s
                    LEFT JOIN h ON s.entity = h.entity AND s.ds = h.ds
                    LEFT JOIN (SELECT entity, arg_max(h_ltd, ds) FILTER (WHERE h_ltd IS NOT NULL) AS last_ltd
                               FROM h GROUP BY 1) lt ON s.entity = lt.entity) z) y) x"""


ORACLE["scenario_comparison"] = f"""
WITH f AS ({CASH_FLOW_FACT}),
comp AS ({_COMP_WIDE}),
h AS ({_HIST}),
{_ELAST},
b AS ({_everywhere("SELECT entity, ds, coalesce(rev_a, rev_f) AS rev, coalesce(cogs_a, cogs_f) AS cogs, coalesce(opex_a, opex_f) AS opex FROM comp")}),
a AS ({_everywhere("SELECT entity, ds, rev, cogs, opex FROM el")})
SELECT coalesce(b.entity, a.entity) AS entity, coalesce(b.ds, a.ds) AS ds, b.total AS base_value, a.total AS alt_value,
       a.total - b.total AS delta, (a.total - b.total) / nullif(abs(b.total), 0) AS pct_delta,
       coalesce(b.ds, a.ds) BETWEEN DATE '2000-06-01' AND DATE '2001-06-30' AS in_window
FROM b FULL OUTER JOIN a ON b.entity = a.entity AND b.ds = a.ds
"""


ORACLE["forecast_trend"] = f"""
WITH i AS (SELECT entity, year(ds) * 12 + month(ds) - {1995 * 12 + 1} AS t, revenue FROM ({INCOME_NATION})),
s AS (SELECT entity, cast(count(*) as double) AS n, cast(sum(cast(t as bigint)) as double) AS sx,
             cast(sum(cast(t as bigint) * cast(t as bigint)) as double) AS sxx,
             cast(sum(cast(revenue as {D})) as double) AS sy,
             cast(sum(cast(cast(t as double) * revenue as decimal(22,4))) as double) AS sxy
      FROM i WHERE t IS NOT NULL AND revenue IS NOT NULL GROUP BY 1),
r AS (SELECT *, (n * sxy - sx * sy) / nullif(n * sxx - sx * sx, 0) AS slope FROM s)
SELECT entity, cast(n as bigint) AS n, slope, (sy - slope * sx) / n AS intercept FROM r
"""


def _fixed(v: str) -> str:
    """4-decimal fixed point of a double expression, half away from zero."""
    return (f"cast(case when ({v}) < 0 then -floor(-({v}) * 10000.0 + 0.5) "
            f"else floor(({v}) * 10000.0 + 0.5) end as bigint)")


#: Components of the forecast, as in the Spark queries.
_FITTED = ("inflow_operating_revenue", "outflow_cogs", "outflow_opex")


_GRAM_FEATURES = ["x_intercept", "x_trend"] + [f"x_{a}{k}" for k in (1, 2, 3) for a in ("sin", "cos")] + [f"x_{d}" for d in DRV]


def _gram_sql(what: str | None = None) -> str:
    """The Gram sums of every series, or other aggregates of the design rows."""
    aggs = ["count(t) AS n"]
    f, sq = _GRAM_FEATURES, "100000000.0"
    for i in range(len(f)):
        for j in range(i, len(f)):
            aggs.append(f"cast(sum({f[i]} * {f[j]}) as double) / {sq} AS g_{i}_{j}")
    for i in range(len(f)):
        aggs.append(f"cast(sum({f[i]} * t) as double) / {sq} AS xy_{i}")
    aggs.append(f"cast(sum(t * t) as double) / {sq} AS yy")
    return f"""{_design_sql()}
SELECT entity, component, {', '.join(aggs) if what is None else what} FROM x WHERE t IS NOT NULL GROUP BY entity, component
"""


def _design_sql() -> str:
    """CTEs up to ``x``, the fixed-point design of every training row."""
    import math
    drivers = DRV
    ang = lambda k: f"cast(dayofyear(ds) as double) * {repr(2.0 * math.pi / 365.25 * k)}"
    fx = {"x_intercept": _fixed("1.0"),
          "x_trend": _fixed("cast(year(ds) * 12 + month(ds) - m0 as double) / 12.0")}
    for k in (1, 2, 3):
        fx[f"x_sin{k}"] = _fixed(f"sin({ang(k)})")
        fx[f"x_cos{k}"] = _fixed(f"cos({ang(k)})")
    for d in drivers:
        fx[f"x_{d}"] = _fixed(f"coalesce(({d} - mu_{d}) / nullif(sd_{d}, 0), 0.0)")
    stats = ", ".join([f"avg({d}) AS mu_{d}, stddev_samp({d}) AS sd_{d}" for d in drivers])
    ly = "case when y > 0 then ln(y) end"
    parts = " UNION ALL ".join(f"SELECT entity, ds, '{c}' AS component, {c} AS y FROM f" for c in _FITTED)
    return f"""
WITH f AS ({CASH_FLOW_FACT}),
dn AS ({DRIVERS_NATION}),
c AS ({parts}),
o AS (SELECT c.entity, c.component, c.ds, c.y, {', '.join('dn.' + d for d in drivers)}
      FROM c LEFT JOIN dn ON c.entity = dn.entity AND c.ds = dn.ds WHERE c.y IS NOT NULL),
tr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity, component ORDER BY ds DESC) AS rn FROM o) WHERE rn > 6),
st0 AS (SELECT entity, component, min(year(ds) * 12 + month(ds)) AS m0, min(y) > 0 AS mult,
               avg({ly}) AS mu_log, stddev_samp({ly}) AS sd_log, avg(y) AS mu_lin, stddev_samp(y) AS sd_lin,
               {stats} FROM tr GROUP BY 1, 2),
st AS (SELECT *, coalesce(case when mult then mu_log else mu_lin end, 0.0) AS ymu,
              coalesce(case when (case when mult then sd_log else sd_lin end) > 0
                            then (case when mult then sd_log else sd_lin end) end, 1.0) AS ysd FROM st0),
x AS (SELECT tr.entity, tr.component, tr.ds, year(tr.ds) * 12 + month(tr.ds) - m0 AS month_no, {', '.join(f'{v} AS {k}' for k, v in fx.items())},
             {_fixed("((case when st.mult then ln(y) else y end) - ymu) / ysd")} AS t
      FROM tr JOIN st ON tr.entity = st.entity AND tr.component = st.component)"""


ORACLE["forecast_gram"] = _gram_sql()
ORACLE["forecast_fit_check"] = _gram_sql("count(t) AS n_gram, count(t) AS n_fit, max(ds) AS train_end, true AS solved")

# Hinge columns formed row by row, for every candidate break.
ORACLE["forecast_hinge_gram"] = f"""{_design_sql()},
size AS (SELECT entity, component, count(t) AS n, cast(max(month_no) + 1 as integer) AS months FROM x GROUP BY ALL),
brk AS (SELECT DISTINCT entity, component, cast(floor(j * floor((months - 1) * 0.8) / 12.0) as integer) AS break_month, months
        FROM size, range(1, 13) AS r(j) WHERE n > {len(_GRAM_FEATURES)}),
h AS (SELECT x.*, break_month, x_trend - cast(floor(break_month / 12.0 * 10000.0 + 0.5) as bigint) AS h FROM x JOIN brk USING (entity, component)
      WHERE break_month > 0 AND break_month < months - 1 AND month_no > break_month AND t IS NOT NULL)
SELECT entity, component, break_month, count(*) AS n_after,
  {', '.join(f"cast(sum(h * {f}) as double) / 100000000.0 AS hx_{i}" for i, f in enumerate(_GRAM_FEATURES))},
  cast(sum(h * t) as double) / 100000000.0 AS hy, cast(sum(h * h) as double) / 100000000.0 AS hh
FROM h GROUP BY entity, component, break_month
"""

ORACLE["training_frame"] = f"""
WITH sp AS ({ORACLE["history_splice"]}),
drv AS ({DRIVERS})
SELECT sp.entity, sp.ds, sp.revenue, sp.source, {', '.join('drv.' + c for c in DRV)}
FROM sp JOIN drv ON sp.ds = drv.ds
WHERE {' AND '.join('drv.' + c + ' IS NOT NULL' for c in DRV)}
"""

ORACLE["scenario_totals"] = f"""
WITH c AS ({ORACLE["scenario_comparison"]})
SELECT entity, {_exact_sum('base_value')} AS base_total, {_exact_sum('alt_value')} AS alt_total
FROM c GROUP BY entity
"""

ORACLE["dim_incremental"] = """
WITH ex AS (SELECT name, row_number() OVER (ORDER BY name) AS id
            FROM (SELECT DISTINCT p_brand AS name FROM part WHERE p_size < 25 AND p_brand IS NOT NULL)),
nw AS (SELECT name FROM (SELECT p_brand AS name FROM part UNION SELECT p_type FROM part)
       WHERE name IS NOT NULL AND name NOT IN (SELECT name FROM ex))
SELECT name, id FROM ex
UNION ALL
SELECT name, row_number() OVER (ORDER BY name) + (SELECT coalesce(max(id), 0) FROM ex) AS id FROM nw
"""

ORACLE["statement_load"] = f"""
WITH inc AS ({INCOME_NATION})
SELECT entity, ds AS statement_date, 1 AS revision, revenue * 1.01 AS revenue, cogs_materials, cogs_labor,
       cogs_overhead, operating_expenses, interest_expense, taxes
FROM inc
"""

ORACLE["profile_attributes"] = """
WITH c AS (SELECT c_nationkey, count(*) AS n_cust FROM customer GROUP BY 1),
b AS (SELECT n.n_name AS company, n.n_nationkey, r.r_name, c.n_cust
      FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey LEFT JOIN c ON n.n_nationkey = c.c_nationkey)
SELECT company, cast(n_nationkey + 1900 as integer) AS "Founded",
       cast(coalesce(n_cust, 0) as integer) AS "Employees", r_name AS "Region",
       cast(NULL as varchar) AS "Headquarters"
FROM b WHERE company IS NOT NULL
"""

ORACLE["series_pivot"] = "WITH m AS (SELECT event_type AS series_id, cast(ts as date) AS ds, " + \
    _mean("value") + " AS value FROM events GROUP BY 1, 2),\n" + \
    "rng AS (SELECT series_id, min(ds) AS lo, max(ds) AS hi FROM m GROUP BY 1),\n" + \
    "sp AS (SELECT series_id, cast(unnest(generate_series(lo, hi, interval 1 day)) as date) AS ds FROM rng),\n" + \
    "f AS (SELECT sp.series_id, sp.ds, m.value FROM sp LEFT JOIN m ON sp.series_id = m.series_id AND sp.ds = m.ds)\n" + \
    "SELECT ds, " + ", ".join(f"max(case when series_id = '{t}' then value end) AS {t}_value"
                             for t in ("click", "error", "purchase", "signup", "view")) + \
    " FROM f WHERE series_id IN ('click', 'error', 'purchase', 'signup', 'view') GROUP BY ds"

ORACLE["statement_transpose"] = f"""
WITH inc AS ({INCOME_SUPPLIER_YEAR})
SELECT 'S' || cast(entity as varchar) AS ticker, fiscal_year, revenue AS "Total Revenue",
       cogs_materials AS "Cost of Revenue", operating_expenses AS "Operating Expense", taxes AS "Tax Provision"
FROM inc
"""

_BATCH = """SELECT cast(k as bigint) AS c_custkey, case when o_orderkey % 5 <> 0 then o_totalprice end AS c_acctbal,
                   o_orderkey AS batch_seq
            FROM (SELECT *, unnest([o_custkey, o_custkey + 10000000000]) AS k FROM orders)"""

ORACLE["upsert_into_existing"] = f"""
WITH b AS ({_BATCH}),
w AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY batch_seq DESC) = 1)
SELECT coalesce(cast(c.c_custkey as bigint), w.c_custkey) AS c_custkey,
       case when w.c_custkey IS NULL then c.c_acctbal else w.c_acctbal end AS c_acctbal, c.c_nationkey, w.batch_seq
FROM customer c FULL JOIN w ON c.c_custkey = w.c_custkey
"""

ORACLE["insert_into_existing"] = f"""
WITH b AS ({_BATCH}),
w AS (SELECT * FROM b WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)
      QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY batch_seq) = 1)
SELECT cast(c_custkey as bigint) AS c_custkey, c_acctbal, c_nationkey FROM customer
UNION ALL SELECT c_custkey, c_acctbal, NULL FROM w
"""

ORACLE["append_existing"] = f"""
SELECT cast(c_custkey as bigint) AS c_custkey, c_acctbal, c_nationkey, cast(NULL as bigint) AS batch_seq FROM customer
UNION ALL SELECT c_custkey, c_acctbal, NULL, batch_seq FROM ({_BATCH})
"""

ORACLE["peer_load"] = f"""
WITH sd AS ({_SUPP_DIM}),
inc AS (SELECT s.s_name, i.* FROM ({INCOME_SUPPLIER_YEAR}) i JOIN supplier s ON i.entity = s.s_suppkey),
bal AS (SELECT s.s_name, b.* FROM ({BALANCE_YEAR_END}) b JOIN supplier s ON b.nation = s.s_nationkey),
j AS (SELECT coalesce(inc.s_name, bal.s_name) AS s_name, coalesce(inc.fiscal_year, bal.fiscal_year) AS fiscal_year,
             floor(revenue) AS total_revenue, floor(cogs_materials) AS cost_of_revenue, floor(interest_expense) AS interest_expense,
             floor(total_assets) AS total_assets, floor(bal.accounts_payable) AS accounts_payable,
             floor(bal.long_term_debt) AS long_term_debt
      FROM inc FULL JOIN bal ON inc.s_name = bal.s_name AND inc.fiscal_year = bal.fiscal_year)
SELECT sd.id AS competitor_id, cast(fiscal_year as integer) AS fiscal_year, total_revenue, cost_of_revenue,
       cast(NULL as double) AS gross_profit, cast(NULL as double) AS operating_income, interest_expense,
       cast(NULL as double) AS net_income, total_assets, cast(NULL as double) AS inventory, accounts_payable, long_term_debt
FROM j JOIN sd ON j.s_name = sd.name
"""

ORACLE["long_series_carries"] = """
SELECT event_id, value, last_value(value IGNORE NULLS) OVER up AS filled, first_value(value IGNORE NULLS) OVER down AS next_known,
       lag(value) OVER o AS before, lead(value) OVER o AS behind, coalesce(value - lag(value) OVER o, 0.0) AS diff
FROM (SELECT event_id, ts, CASE WHEN event_type <> 'error' THEN value END AS value FROM events)
WINDOW o AS (ORDER BY ts, event_id), up AS (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       down AS (ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
"""

ORACLE["hot_entity_fill"] = """
SELECT event_id, entity, coalesce(last_value(value IGNORE NULLS) OVER up, first_value(value IGNORE NULLS) OVER down, 0.0) AS value
FROM (SELECT event_id, ts, CASE WHEN event_type IN ('error', 'view') THEN event_type ELSE 'rest' END AS entity,
             CASE WHEN value > 10 THEN value END AS value FROM events)
WINDOW up AS (PARTITION BY entity ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       down AS (PARTITION BY entity ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
"""

ORACLE["upsert_moved_keys"] = """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey,
       CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1.0 ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey % 3 = 0 THEN translate(o_orderstatus, 'FOP', 'OPX') ELSE o_orderstatus END AS o_orderstatus
FROM orders
UNION ALL
SELECT CAST(o_orderkey + 10000000000 AS BIGINT), o_totalprice, 'N' FROM orders
"""

ORACLE["fact_load_upsert"] = f"""
WITH pd AS (SELECT name, row_number() OVER (ORDER BY name) AS id FROM (SELECT DISTINCT 'P' || cast(p_partkey as varchar) AS name FROM part)),
sd AS ({_SUPP_DIM}),
f AS (SELECT l_orderkey, pd.id AS part_id, sd.id AS supplier_id, cast(l_shipdate as date) AS l_shipdate, l_linenumber, l_quantity
      FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN pd ON 'P' || cast(l.l_partkey as varchar) = pd.name
      LEFT JOIN sd ON (case when l_linenumber = 7 then '?' || s_name else s_name end) = sd.name)
SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY l_orderkey, part_id
  ORDER BY case when l_linenumber <= 3 then 0 else 1 end DESC, l_shipdate DESC, l_linenumber DESC, l_quantity DESC, supplier_id DESC NULLS LAST) = 1
"""

ORACLE["dim_stored_batches"] = """
WITH a AS (SELECT name, row_number() OVER (ORDER BY name) AS id FROM (SELECT DISTINCT p_brand AS name FROM part
           WHERE p_size < 25 AND p_brand IS NOT NULL)),
b AS (SELECT name, row_number() OVER (ORDER BY name) + (SELECT count(*) FROM a) AS id FROM (
      SELECT p_brand AS name FROM part UNION SELECT p_type FROM part) WHERE name IS NOT NULL AND name NOT IN (SELECT name FROM a)),
n AS (SELECT p_brand AS name, count(*) AS n_parts FROM part GROUP BY p_brand)
SELECT name, id, n_parts FROM (SELECT * FROM a UNION ALL SELECT * FROM b) LEFT JOIN n USING (name)
"""

ORACLE["peer_load_new_companies"] = f"""
WITH j AS (SELECT coalesce(i.s_name, b.s_name) AS company, coalesce(i.fiscal_year, b.fiscal_year) AS fiscal_year, floor(revenue) AS total_revenue,
                  floor(interest_expense) AS interest_expense, floor(total_assets) AS total_assets, floor(b.long_term_debt) AS long_term_debt
      FROM (SELECT s_name, i.* FROM ({INCOME_SUPPLIER_YEAR}) i JOIN supplier s ON i.entity = s.s_suppkey) i
      FULL JOIN (SELECT s_name, b.* FROM ({BALANCE_YEAR_END}) b JOIN supplier s ON b.nation = s.s_nationkey) b
      ON i.s_name = b.s_name AND i.fiscal_year = b.fiscal_year),
names AS (SELECT DISTINCT company, right(company, 1) IN ('3', '6', '9') AS early FROM j WHERE company IS NOT NULL),
ids AS (SELECT company, row_number() OVER (ORDER BY early DESC, company) AS id FROM names)
SELECT company, id AS competitor_id, cast(fiscal_year as integer) AS fiscal_year, total_revenue, interest_expense, total_assets, long_term_debt
FROM j JOIN ids USING (company)
"""

_SHEET = """
SELECT o_orderkey AS k, o_orderkey % 23 = 0 AS short,
  CASE WHEN o_orderkey % 17 = 0 THEN '1996-13-45' WHEN o_orderkey % 19 = 0 THEN ' ' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS ordered,
  CASE WHEN o_orderkey % 11 = 0 THEN 'n/a' WHEN o_orderkey % 13 = 0 THEN ''
       ELSE printf('%d,%03d.%02d', cast(round(o_totalprice * 100) as bigint) // 100000,
                   (cast(round(o_totalprice * 100) as bigint) // 100) % 1000, cast(round(o_totalprice * 100) as bigint) % 100) END AS amount,
  CASE WHEN o_orderkey % 5 = 0 THEN 'N/A' WHEN o_orderkey % 7 = 0 THEN '7 of 9' ELSE (o_orderkey % 9) || '%' END AS discount,
  o_orderpriority || ', "' || o_orderstatus || '"' AS note
FROM orders"""
_SHEET_REASON = """CASE WHEN short THEN 'wrong number of fields' WHEN ordered = ' ' THEN 'ordered: missing'
  WHEN ordered = '1996-13-45' THEN 'ordered: no date: 1996-13-45' WHEN amount = 'n/a' THEN 'amount: no money: n/a'
  WHEN discount = '7 of 9' THEN 'discount: no percent: 7 of 9' END"""

ORACLE["text_sheet_rows"] = f"""
SELECT CAST(k AS BIGINT) AS "order", CAST(ordered AS DATE) AS ordered, CAST(nullif(replace(amount, ',', ''), '') AS DOUBLE) AS amount,
       CASE WHEN discount <> 'N/A' THEN CAST(replace(discount, '%', '') AS DOUBLE) / 100.0 END AS discount, note
FROM ({_SHEET}) WHERE {_SHEET_REASON} IS NULL
"""

ORACLE["text_sheet_rejects"] = f"""
SELECT CASE WHEN short THEN k || ',' || ordered ELSE concat_ws(',', ' ' || k, ordered, amount, discount, note) END AS line, {_SHEET_REASON} AS reason
FROM ({_SHEET}) WHERE {_SHEET_REASON} IS NOT NULL
"""

ORACLE["fact_hot_names"] = f"""
WITH pd AS (SELECT name, row_number() OVER (ORDER BY name) AS id FROM (SELECT DISTINCT 'P' || cast(p_partkey as varchar) AS name FROM part)),
sd AS ({_SUPP_DIM}),
f AS (SELECT l_orderkey, l_linenumber, l_quantity,
             CASE WHEN l_linenumber <= 2 THEN 'P1' WHEN l_linenumber = 7 THEN '?' ELSE 'P' || cast(l_partkey as varchar) END AS part,
             CASE WHEN l_linenumber <= 2 THEN 'Supplier#000000001' WHEN l_linenumber = 3 THEN 'nobody'
                  WHEN l_linenumber <> 4 THEN s_name END AS supplier
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
SELECT l_orderkey, l_linenumber, pd.id AS part_id, sd.id AS supplier_id, l_quantity
FROM f JOIN pd ON f.part = pd.name LEFT JOIN sd ON f.supplier = sd.name
"""

_RATIO_COLS = ("total_revenue", "cost_of_revenue", "gross_profit", "operating_income", "net_income", "interest_expense", "total_assets",
               "inventory", "total_current_assets", "total_current_liabilities", "total_liabilities", "total_equity")
_ABSENT = ", ".join(f"cast(NULL as double) AS {c}" for c in _RATIO_COLS[-4:])
_HOME_MONTH = f"SELECT *, {_COGS} AS cogs FROM ({INCOME_NATION})"
_COMPANIES = f"""
  SELECT n.n_name AS company_name, i.fiscal_year, {', '.join(_RATIO_COLS)}
  FROM (SELECT entity, cast(year(ds) as integer) AS fiscal_year, cast(sum({_dd('revenue')}) as double) AS total_revenue,
               cast(sum(cogs) as double) AS cost_of_revenue, cast(sum({_dd('revenue')} - cogs) as double) AS gross_profit,
               cast(sum({_dd('revenue')} - cogs - {_dd('operating_expenses')}) as double) AS operating_income,
               cast(sum({_dd('interest_expense')}) as double) AS interest_expense,
               cast(sum({_dd('revenue')} - cogs - {_dd('operating_expenses')} - {_dd('interest_expense')} - {_dd('taxes')}) as double) AS net_income
        FROM ({_HOME_MONTH}) GROUP BY 1, 2) i
  JOIN ({YEAR_END}) b ON b.nation = i.entity AND b.fiscal_year = i.fiscal_year
  JOIN nation n ON n.n_nationkey = i.entity
  UNION ALL
  SELECT coalesce(i.s_name, b.s_name), coalesce(i.fiscal_year, b.fiscal_year), floor(revenue), floor(cogs_materials),
         floor(revenue - cogs_materials), floor(revenue - operating_expenses), floor(revenue - taxes), floor(interest_expense),
         floor(total_assets), floor(inventory_raw_materials), {_ABSENT}
  FROM (SELECT s_name, x.* FROM ({INCOME_SUPPLIER_YEAR}) x JOIN supplier s ON x.entity = s.s_suppkey) i
  FULL JOIN (SELECT s_name, x.* FROM ({BALANCE_YEAR_END}) x JOIN supplier s ON x.nation = s.s_nationkey) b
  ON i.s_name = b.s_name AND i.fiscal_year = b.fiscal_year"""
_GROWN = [(f"{label} Growth YoY", c) for label, c in (("Revenue", "total_revenue"), ("Net Income", "net_income"))]
ORACLE["company_ratios"] = f"WITH a AS ({_COMPANIES}),\n" + (
    "g AS (SELECT *, lag(total_revenue) OVER w AS prev_total_revenue, lag(net_income) OVER w AS prev_net_income FROM a\n"
    "      WINDOW w AS (PARTITION BY company_name ORDER BY fiscal_year))\nSELECT * FROM (\n") + "\nUNION ALL\n".join(
    [f"SELECT company_name, fiscal_year, '{cat}' AS ratio_category, '{name}' AS ratio_name, "
     f"cast({num} as double) / nullif(cast({den} as double), 0) AS ratio_value FROM a" for cat, name, num, den in _LEVEL]
    + [f"SELECT company_name, fiscal_year, 'Growth', '{name}', ({c} - prev_{c}) / nullif(abs(prev_{c}), 0) FROM g"
       for name, c in _GROWN]) + "\n) WHERE ratio_value IS NOT NULL"

_STATEMENT = f"""
WITH i AS (SELECT *, entity = 5 AND year(ds) = 1995 AS lost FROM ({INCOME_NATION})),
r AS (SELECT *, CASE WHEN entity = 3 THEN 'taxes: no double: tba' WHEN lost THEN 'statement_date: missing' END AS reason FROM i)"""
ORACLE["statement_catalogue"] = f"""{_STATEMENT}
SELECT entity, ds AS statement_date, CASE WHEN reason IS NULL THEN floor(revenue * 1.5) ELSE floor(revenue) END AS revenue,
       CASE WHEN reason IS NOT NULL THEN taxes WHEN entity <> 4 THEN floor(taxes) END AS taxes,
       CASE WHEN ds < DATE '1997-01-01' THEN 'opening' END AS status,
       CASE WHEN reason IS NULL THEN cast(1 as integer) END AS revision,
       CASE WHEN reason IS NULL THEN 'by ' || cast(entity as varchar) END AS prepared_by
FROM r WHERE reason IS NULL OR ds < DATE '1997-01-01'
"""
ORACLE["statement_catalogue_rejects"] = f"{_STATEMENT}\nSELECT reason, count(*) AS n_rows FROM r WHERE reason IS NOT NULL GROUP BY reason\n"

ORACLE["csv_round_trip"] = """
SELECT cast(o_orderkey as bigint) AS k, cast(o_orderdate as date) AS ds, CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS price,
       regexp_replace('No' || lower(o_orderpriority) || o_orderstatus, '[^A-Za-z0-9]', '', 'g') AS code, o_orderstatus AS status, read_as
FROM orders, (VALUES ('typed'), ('text')) v(read_as)
"""

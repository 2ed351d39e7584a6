"""Scorecard queries on invoices, orders and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenderlake.fixed_values import ORDER_RISK_LABELS
from tenderlake.operators.joins import attach
from tenderlake.operators.windows import group_total
from tenderlake.plans import scorecard as sc
from workload import views
from workload.sqltext import INVOICE_CTE, KEYS_CTE, bare, over_invoices
from workload.views import SCORING_DATES, churn_scores, invoices, scorecard_keys, view, written

PRODUCTS_SINCE = "1998-08-01"
FEATURES = [
    "gap_mean", "gap_std", "days_since", "order_count", "order_qty", "margin_rate", "price_level", "family_share",
]
CLASSES = [
    ("Order pattern", "gap_"), ("Recency", " days_since "), ("Volume", "order_"),
    ("Margin", "margin"), ("Price", "price"), ("Mix", "family"),
]

VALUE = """
value as (select i.key, max(k.last_trx_date) as last_trx_date, max(diff_mean) as diff_mean, max(diff_std) as diff_std,
    sum(inv_delivered_gp) as value_at_risk
  from invoices i join score_keys k on i.key = k.key
  where i.billing_date >= cast(k.last_trx_date - interval 1 year as date) and i.billing_date <= k.last_trx_date
  group by i.key)
"""
SCORES = """
scores as (select key, (cast(split_part(key, '_', 1) as bigint) * 7919 % 1000) / 1000.0 as churn_prob from score_keys)
"""
DEVIATION = f"""
gaps_now as (select s.key, s.churn_prob, v.last_trx_date, v.diff_mean, v.diff_std, v.value_at_risk,
    (select max(last_trx_date) from value) + 1 as order_ref_date,
    cast((select max(last_trx_date) from value) + 1 - v.last_trx_date as int) as order_diff
  from scores s left join value v on s.key = v.key),
deviation as (select *, (order_diff - diff_mean) / nullif(diff_std, 0) as z from gaps_now),
risked as (select * exclude (z),
    case when z > 1.5 then '{ORDER_RISK_LABELS[0]}' when z > 1 then '{ORDER_RISK_LABELS[1]}'
         else '{ORDER_RISK_LABELS[2]}' end as "Order deviation risk",
    churn_prob + least(greatest(z, 0), 2) / 2.0 as churn_risk
  from deviation)
"""
BANDS = """
kept as (select *, row_number() over (order by churn_risk desc, key) - 1 as pos
  from risked where churn_prob / nullif(churn_risk, 0) > 0.3),
size as (select cast(round_even(count(*) * 0.042, 0) as bigint) as n from risked),
banded as (
  select kept.* exclude (pos), case when pos < cast(floor(n * 0.10) as bigint) then 'Very High'
    when pos < cast(floor(n * 0.30) as bigint) then 'High' when pos < cast(floor(n * 0.60) as bigint) then 'Medium'
    when pos <= n then 'Low' else 'Very Low' end as "Total churn risk"
  from kept cross join size
  union all
  select *, 'Unavailable' from risked where churn_prob / nullif(churn_risk, 0) <= 0.3)
"""
DRIVERS = f"""
contributions as (
  select k.key, f.feature,
    ((cast(split_part(k.key, '_', 1) as bigint) * (7 + 3 * f.i)
      + cast(split_part(k.key, '#', 2) as bigint) * (5 + f.i)) % 256 - 96) / 128.0 as contribution
  from score_keys k cross join (values {", ".join(f"({i}, '{f}')" for i, f in enumerate(FEATURES))}) f(i, feature)),
classes as (select * from (values {", ".join(f"('{c}', '{v}')" for c, v in CLASSES)}) c(class, variable)),
class_sums as (select key, class, sum(greatest(contribution, 0.0)) as total
  from contributions join classes on contains(feature, trim(variable)) group by key, class),
ranked as (select key, class, row_number() over (partition by key order by total desc, class) as r from class_sums),
drivers as (select key, {", ".join(
    f'''max(case when r = {i} then class end) as "Top Driver {i}"''' for i in range(1, 6))} from ranked group by key)
"""
PRODUCTS = f"""
product_sums as (select customer_bill_to_id, product_family, product_no, max(horizontal) as horizontal,
    sum(inv_delivered_gp) as profit from invoices where billing_date >= date '{PRODUCTS_SINCE}' group by all),
horizontals as (select product_family, max(horizontal) as h from product_sums group by all),
top_rows as (select *, row_number() over (partition by customer_bill_to_id, product_family
    order by profit desc, product_no) as r from product_sums),
tops as (select cast(customer_bill_to_id as varchar) as "Customer", t.product_family as "Product", h as "Horizontal",
    cast(product_no as varchar) as "Top Product", profit as top_profit
  from top_rows t join horizontals z on t.product_family = z.product_family where r = 1)
"""
ORDERS = f"sales_orders as ({bare(views.SALES_ORDERS_SQL)}), families as ({bare(views.FAMILY_MAP_SQL)})"


def _open(on_product: bool) -> str:
    return f"""
open_lines as (select distinct t.customer_bill_to_id, t.product_code from sales_orders t
  join (select customer_bill_to_id, product_code, max(order_entry_date) as d from sales_orders group by all) m
    on t.customer_bill_to_id = m.customer_bill_to_id and t.order_entry_date = m.d
    {"and t.product_code = m.product_code" if on_product else ""}
  where t.line_item_status not in ('CNCL', 'CLSD') and t.order_entry_date >= date '{SCORING_DATES[0]}'
    and t.order_entry_date <= date '{SCORING_DATES[1]}'),
open_codes as (select distinct cast(o.customer_bill_to_id as varchar) as "Customer",
    replace(f.family_code, '-', '_') as family_code
  from open_lines o left join families f on o.product_code = f.product_no)
"""


PROGRAM = f"""
program as ({bare(views.PROGRAM_SQL)}),
program_hits as (select distinct substr(coalesce(ship_to, '0'), 1, 6) as "Customer",
    contains(lower(coalesce(supplier_name, '0')), 'brenntag') as b,
    contains(lower(coalesce(supplier_name, '0')), 'nexeo') as n from program)
"""
SERVICE = f"""
calls as ({bare(views.CALLS_SQL)}),
cases as ({bare(views.CASES_SQL)}),
industries as (select cast(customer_bill_to_id as varchar) as "Customer", min(uic_industry_group_name) as "Industry"
  from invoices i join (select customer_bill_to_id, max(billing_date) as d from invoices group by all) m
    using (customer_bill_to_id) where i.billing_date = m.d group by all),
call_dates as (select cast(customer_bill_to_id as varchar) as "Customer", max(call_date) as last_call_date
  from calls group by all),
case_counts as (select cast(customer_bill_to_id as varchar) as "Customer", count(distinct case_number) as open_cases
  from cases where case_status in ('Assigned', 'Draft', 'Awaiting Investigator Assignment', 'Under Investigation')
    and case_record_type in ('Customer Complaint', 'Customer Complaint Assigned', 'Internal Complaint',
      'Internal Complaint Assigned') group by all)
"""
ATTRIBUTES = f"""
customer_map as ({bare(views.CUSTOMER_MAP_SQL)}),
attributes as (select lob, bill_to_key, region, district, general_manager, sales_manager, seller, bill_to_name
  from (select *, row_number() over (partition by bill_to_key, lob order by region, district, general_manager,
    sales_manager, seller, bill_to_name) as r from customer_map) where r = 1),
product_names as ({bare(views.PRODUCT_MAP_SQL)})
"""
CARD = """
card as (select b.key, 'Churn Prevention' as "AI_Source", 'LCD' as "LOB", a.region as "Region",
    a.district as "District", a.general_manager as "General Manager", a.sales_manager as "Sales Manager",
    a.seller as "Seller", split_part(b.key, '_', 1) as "Customer", a.bill_to_name as "Customer Name",
    f.family_code as "Product Family Code", t."Horizontal", split_part(b.key, '_', 2) as "Product Family",
    coalesce(t."Top Product", '0') as "Top Product", p.product_name as "Top Product Name", b."Total churn risk",
    b.value_at_risk as "Annual product iDGP at risk",
    coalesce(w.worth, 0) as "Annual customer iDGP at risk",
    b.last_trx_date as "Last Transaction Date",
    case when exists (select 1 from open_codes o where o."Customer" = split_part(b.key, '_', 1)
      and o.family_code = replace(f.family_code, '-', '_')) then 'Yes' else 'No' end as "Open Order Flag",
    b.diff_mean as "Avg. days between orders", b.order_diff as "Days since last transaction",
    case when exists (select 1 from program_hits h where h."Customer" = split_part(b.key, '_', 1) and h.b)
      then 'Yes' else ' ' end as "Brenntag CPP",
    case when exists (select 1 from program_hits h where h."Customer" = split_part(b.key, '_', 1) and h.n)
      then 'Yes' else ' ' end as "Nexeo CPP",
    b."Order deviation risk", b.churn_prob, b.churn_risk, i."Industry", c.last_call_date, s.open_cases,
    d."Top Driver 1", d."Top Driver 2", d."Top Driver 3", d."Top Driver 4", d."Top Driver 5"
  from banded b
  left join (select split_part(key, '_', 1) as customer, sum(value_at_risk) as worth from risked group by 1) w
    on w.customer = split_part(b.key, '_', 1)
  left join tops t on t."Customer" = split_part(b.key, '_', 1) and t."Product" = split_part(b.key, '_', 2)
  left join attributes a on a.bill_to_key = split_part(b.key, '_', 1) and a.lob = 'LCD'
  left join product_names p on p.product_key = coalesce(t."Top Product", '0')
  left join (select distinct product_family, family_code from families) f
    on f.product_family = split_part(b.key, '_', 2)
  left join drivers d on d.key = b.key
  left join industries i on i."Customer" = split_part(b.key, '_', 1)
  left join call_dates c on c."Customer" = split_part(b.key, '_', 1)
  left join case_counts s on s."Customer" = split_part(b.key, '_', 1))
"""
REPS = f"""
hierarchy as ({bare(views.SALES_HIERARCHY_SQL)}),
reps as (select * from (select *, row_number() over (partition by sales_rep order by industry, director, sales_manager)
  as r from hierarchy) where r = 1)
"""
CARD_PARTS = [KEYS_CTE, VALUE, SCORES, DEVIATION, BANDS, DRIVERS, PRODUCTS, ORDERS, _open(True), PROGRAM, SERVICE,
              ATTRIBUTES, CARD]
CARD_DOUBLES = ["Annual product iDGP at risk", "Annual customer iDGP at risk", "Avg. days between orders",
                "churn_prob", "churn_risk"]
LAYOUT_DOUBLES = CARD_DOUBLES[:3]


def _names(columns):
    return ", ".join(f'"{c}"' for c in columns)


LCD_HEAD = ["AI_Source", *sc.SALES_COLUMNS["lcd"]]
FULL_TAIL = ["Horizontal", "Product Family Code", *sc.PRODUCT_COLUMNS, *sc.RISK_COLUMNS, "churn_prob", "churn_risk",
             "open_cases", "last_call_date", *sc.DRIVER_COLUMNS]
FIELD_TAIL = ["Horizontal", *sc.PRODUCT_COLUMNS, *sc.RISK_COLUMNS, *sc.DRIVER_COLUMNS]
LCD_FULL = [*LCD_HEAD, *FULL_TAIL]
LCD_FIELD = [*LCD_HEAD, *FIELD_TAIL]
LCD_DASHBOARD = [*LCD_HEAD, "Product Family Code", *FIELD_TAIL]
FI_FULL = ["AI_Source", *sc.SALES_COLUMNS["fi"], *FULL_TAIL]
FI_FIELD = ["AI_Source", "Industry", "Director", "Sales Manager", "Seller", "Customer", "Customer Name", *FIELD_TAIL]
FI_DASHBOARD = [*FI_FIELD[:7], "Product Family Code", *FIELD_TAIL]


def _layout(lob, kind, columns, doubles):
    replaced = {"Industry": "reps.industry", "Director": "reps.director", "Sales Manager": "reps.sales_manager"}
    if lob == "lcd" or kind == "full":
        sql = f"select {_names(columns)} from card"
        return (lambda s, d: layout(s, d, lob, kind), over_invoices(*CARD_PARTS, sql), doubles)
    picked = ", ".join('{} as "{}"'.format(replaced.get(c, f'card."{c}"'), c) for c in columns)
    sql = f'select {picked} from card left join reps on card."Seller" = reps.sales_rep'
    return (lambda s, d: layout(s, d, lob, kind), over_invoices(*CARD_PARTS, REPS, sql), doubles)


def scores(s, d):
    return written(s, d, "scores", lambda: churn_scores(s, d))


def value(s, d):
    return sc.value_at_risk(invoices(s, d), scorecard_keys(s, d))


def risked(s, d):
    worth = value(s, d)
    rows = scores(s, d).select("key", "churn_prob").join(worth, "key", "left")
    return sc.with_order_risk(rows, worth.agg(F.max("last_trx_date")))


def contributions(s, d):
    customer = F.split("key", "_")[0].cast("long")
    brand = F.split("key", "#")[1].cast("long")
    rows = F.array(*[
        F.struct(
            F.lit(f).alias("feature"),
            (((customer * (7 + 3 * i) + brand * (5 + i)) % 256 - 96) / F.lit(128.0)).alias("contribution"),
        )
        for i, f in enumerate(FEATURES)
    ])
    return scorecard_keys(s, d).select("key", F.inline(rows))


def drivers(s, d):
    return sc.top_drivers(contributions(s, d), sc.feature_classes(FEATURES, CLASSES))


def open_orders(s, d, match):
    return sc.open_orders(view(s, d, views.SALES_ORDERS_SQL), view(s, d, views.FAMILY_MAP_SQL), *SCORING_DATES, match)


def card(s, d):
    inputs = sc.ScorecardInputs(
        scores=scores(s, d), score_keys=scorecard_keys(s, d), drivers=drivers(s, d), invoices=invoices(s, d),
        orders=view(s, d, views.SALES_ORDERS_SQL), products=view(s, d, views.FAMILY_MAP_SQL),
        customer_map=view(s, d, views.CUSTOMER_MAP_SQL), product_names=view(s, d, views.PRODUCT_MAP_SQL),
        program=view(s, d, views.PROGRAM_SQL), calls=view(s, d, views.CALLS_SQL),
        cases=view(s, d, views.CASES_SQL),
    )
    return sc.scorecard(inputs, "lcd", PRODUCTS_SINCE, *SCORING_DATES)


def written_card(s, d):
    return written(s, d, "card", lambda: card(s, d))


def layout(s, d, lob, name):
    return sc.layouts(written_card(s, d), lob, view(s, d, views.SALES_HIERARCHY_SQL))[name]


def program_flags(s, d):
    rows = scores(s, d).select("key", F.split("key", "_")[0].alias("Customer"))
    flags = sc.program_flags(view(s, d, views.PROGRAM_SQL))
    return attach(rows, flags, ["Customer"], check=False, hot=True).fillna(" ", ["Brenntag CPP", "Nexeo CPP"])


QUERIES = {
    "value_at_risk": (value, over_invoices(KEYS_CTE, VALUE, "select * from value"),
                      ["diff_mean", "diff_std", "value_at_risk"]),
    "order_deviation_risk": (
        risked, over_invoices(KEYS_CTE, VALUE, SCORES, DEVIATION, "select * from risked"),
        ["churn_prob", "diff_mean", "diff_std", "value_at_risk", "churn_risk"],
    ),
    "annual_customer_value": (
        lambda s, d: group_total(
            value(s, d).select("key", "value_at_risk", F.split("key", "_")[0].alias("Customer")),
            ["Customer"], "value_at_risk", "annual_value",
        ),
        over_invoices(KEYS_CTE, VALUE, """select key, value_at_risk, split_part(key, '_', 1) as "Customer",
          sum(value_at_risk) over (partition by split_part(key, '_', 1)) as annual_value from value"""),
        ["value_at_risk", "annual_value"],
    ),
    "total_churn_risk_bands": (
        lambda s, d: sc.with_risk_bands(risked(s, d)),
        over_invoices(KEYS_CTE, VALUE, SCORES, DEVIATION, BANDS, "select * from banded"),
        ["churn_prob", "diff_mean", "diff_std", "value_at_risk", "churn_risk"],
    ),
    "top_drivers": (drivers, over_invoices(KEYS_CTE, DRIVERS, "select * from drivers"), []),
    "top_products": (
        lambda s, d: sc.top_products(
            invoices(s, d), invoices(s, d).select("customer_bill_to_id").distinct(), PRODUCTS_SINCE
        ),
        over_invoices(PRODUCTS, "select * from tops"), ["top_profit"],
    ),
    "open_orders": (
        lambda s, d: open_orders(s, d, "product"),
        over_invoices(ORDERS, _open(True), "select * from open_codes"), [],
    ),
    "open_orders_by_customer_date": (
        lambda s, d: open_orders(s, d, "customer"),
        over_invoices(ORDERS, _open(False), "select * from open_codes"), [],
    ),
    "program_flags": (
        program_flags,
        over_invoices(KEYS_CTE, PROGRAM, """select key, split_part(key, '_', 1) as "Customer",
          case when split_part(key, '_', 1) in (select "Customer" from program_hits where b) then 'Yes' else ' ' end
            as "Brenntag CPP",
          case when split_part(key, '_', 1) in (select "Customer" from program_hits where n) then 'Yes' else ' ' end
            as "Nexeo CPP" from score_keys"""), [],
    ),
    "customer_industry": (
        lambda s, d: sc.customer_industry(invoices(s, d)), over_invoices(SERVICE, "select * from industries"), []),
    "last_call_date": (
        lambda s, d: sc.last_calls(view(s, d, views.CALLS_SQL)),
        over_invoices(SERVICE, "select * from call_dates"), []),
    "open_case_count": (
        lambda s, d: sc.open_cases(view(s, d, views.CASES_SQL)),
        over_invoices(SERVICE, "select * from case_counts"), []),
    "scorecard": (card, over_invoices(*CARD_PARTS, "select * from card"), CARD_DOUBLES),
    "scorecard_full": _layout("lcd", "full", LCD_FULL, CARD_DOUBLES),
    "scorecard_field": _layout("lcd", "field", LCD_FIELD, LAYOUT_DOUBLES),
    "scorecard_dashboard": _layout("lcd", "dashboard", LCD_DASHBOARD, LAYOUT_DOUBLES),
    "scorecard_full_industry": _layout("fi", "full", FI_FULL, CARD_DOUBLES),
    "scorecard_field_hierarchy": _layout("fi", "field", FI_FIELD, LAYOUT_DOUBLES),
    "scorecard_dashboard_hierarchy": _layout("fi", "dashboard", FI_DASHBOARD, LAYOUT_DOUBLES),
    "risk_summary": (
        lambda s, d: sc.risk_summary(written_card(s, d)),
        over_invoices(*CARD_PARTS, """select "Total churn risk", avg(churn_prob) as mean_churn_prob,
          min(churn_prob) as min_churn_prob, max(churn_prob) as max_churn_prob,
          coalesce(sum("Annual product iDGP at risk")
            filter ("Total churn risk" in ('Very High', 'High', 'Medium')), 0) as value_at_risk
          from card group by 1"""),
        ["mean_churn_prob", "min_churn_prob", "max_churn_prob", "value_at_risk"]),
}

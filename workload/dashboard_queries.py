"""Queries for the reference table and the dashboard tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenderlake.operators import reshape
from tenderlake.plans import dashboard
from tenderlake.plans.features import cost_qty_distance
from tenderlake.fixed_values import PEER_COLUMNS, REFERENCE_NAMES
from tenderlake.plans.reference_table import (
    bid_reference_table, reference_tables, totals, with_link_counts,
)
from workload.bid_queries import AWARDED, COSTS, NEXT_KEY, PRICED
from workload.sqltext import CLUSTER_CTE, bare, over_bids
from workload.views import CLUSTER_YEAR, IMPORTANCE_SQL, LOOKUP, bids, clusters, view, written

TREES = 20

REFERENCE = f"""
details as (select distinct key, fiscal, destination_no, bid_line_no, customer_no, customer_name,
  destination_county_name, destination_state_prov, bid_due_date, total_qty_ty, award_price_ty, award_competitor_id
  from priced),
house as (select key, min(committed_price_ty) as cmp_price,
    first(case when award_competitor_id = 'CMP' then 'Yes' else 'No' end
      order by committed_price_ty, case when award_competitor_id = 'CMP' then 'Yes' else 'No' end) as cmp_won_bid
  from priced where price_competitor_id = 'CMP' group by key),
tops as (select key,
    first(price_competitor_id order by committed_price_ty desc, price_competitor_id)
      filter (price_competitor_id is not null) as top_competitor_id,
    max(committed_price_ty) as top_competitor_price
  from priced where price_competitor_id is distinct from 'CMP' group by key),
last_year as (select {NEXT_KEY} as key, min(award_price_ty) as last_yr_award_price,
    first(award_competitor_id order by award_price_ty, award_competitor_id nulls first) as last_yr_award_competitor_id
  from priced group by 1),
reference_rows as (select d.*, h.cmp_price, h.cmp_won_bid, t.top_competitor_id, t.top_competitor_price,
    l.last_yr_award_competitor_id, l.last_yr_award_price,
    d.award_price_ty - l.last_yr_award_price as delta_awardprice_lastyr,
    case when d.award_competitor_id = l.last_yr_award_competitor_id then d.award_competitor_id else 'None' end
      as incumbent,
    d.destination_county_name || ', ' || d.destination_state_prov as city_state
  from details d left join house h on d.key = h.key left join tops t on d.key = t.key
  left join last_year l on d.key = l.key)
"""
REFERENCE_DOUBLES = [
    "total_qty_ty", "award_price_ty", "cmp_price", "top_competitor_price", "last_yr_award_price",
    "delta_awardprice_lastyr",
]
# All house offers and last-year awards, and every detail joined with all of them.
LINKED = f"""
all_details as (select distinct key, fiscal, destination_no, bid_line_no, customer_no, customer_name,
  destination_county_name, destination_state_prov, bid_due_date, total_qty_ty, award_price_ty, award_competitor_id
  from priced),
all_house as (select distinct key, committed_price_ty as cmp_price,
  case when award_competitor_id = 'CMP' then 'Yes' else 'No' end as cmp_won_bid
  from priced where price_competitor_id = 'CMP'),
all_awards as (select distinct {NEXT_KEY} as key, award_price_ty as last_yr_award_price,
  award_competitor_id as last_yr_award_competitor_id from priced),
link_counts as (select d.key, n_details, coalesce(n_house, 0) as n_house_offers, coalesce(n_awards, 0) as n_last_yr_awards
  from (select key, count(*) as n_details from all_details group by key) d
  left join (select key, count(*) as n_house from all_house group by key) h on d.key = h.key
  left join (select key, count(*) as n_awards from all_awards group by key) a on d.key = a.key),
joined_rows as (select d.*, h.cmp_price, h.cmp_won_bid, t.top_competitor_id, t.top_competitor_price,
    a.last_yr_award_competitor_id, a.last_yr_award_price,
    d.award_price_ty - a.last_yr_award_price as delta_awardprice_lastyr,
    case when d.award_competitor_id = a.last_yr_award_competitor_id then d.award_competitor_id else 'None' end
      as incumbent,
    d.destination_county_name || ', ' || d.destination_state_prov as city_state
  from all_details d left join all_house h on d.key = h.key left join tops t on d.key = t.key
  left join all_awards a on d.key = a.key)
"""
TAGGED = f"""
{CLUSTER_CTE.strip()},
clustering as (select split_part(key, '_', 2) as destination_no, cast(split_part(key, '_', 3) as int) as bid_line_no,
  cluster as "Cluster" from clusters where key like '{CLUSTER_YEAR}_%'),
tagged as (select r.*, c."Cluster" from reference_rows r left join clustering c
  on r.destination_no = c.destination_no and r.bid_line_no = c.bid_line_no)
"""
REPORT = "report as (select " + ", ".join(
    f'"{c}" as "{h}"' for c, h in REFERENCE_NAMES.items()
) + " from tagged)"
REPORT_DOUBLES = [
    "Volume (K Tons)", "CMP Bid Price", "Top Competitor Bid Price", "Bid Price Last Year", "Delta YoY AwardPrice",
]
PRICES = """
price_rows as (select a.key, a.p as "Predicted_price", a.p * 0.9 as error_down_95, a.p * 1.1 as error_up_95,
    a.p - c.committed_cost_ty as estimated_margin, a.p * 0.9 - c.committed_cost_ty as margin_lower,
    a.p * 1.1 - c.committed_cost_ty as margin_upper
  from (select key, min(award_price_ty) as p from awarded group by key) a join costs c on a.key = c.key)
"""
BY_CATEGORY = """
labelled as (
  select key, 'Proposed (Average)' as "Category", estimated_margin as m, "Predicted_price" as p from price_rows
  union all select key, 'Conservative (2.5th Percentile)', margin_lower, error_down_95 from price_rows
  union all select key, 'Ambitious (97.5th Percentile)', margin_upper, error_up_95 from price_rows),
micro as (select key, "Category", cast(round(m * 1e6) as bigint) as m, cast(round(p * 1e6) as bigint) as p
  from labelled),
cent as (select key, "Category", m, p, cast(floor(m / 10000.0) as bigint) as mq, cast(floor(p / 10000.0) as bigint) as pq
  from micro),
by_category as (select key, "Category",
  (mq + case when m - mq * 10000 > 5000 or (m - mq * 10000 = 5000 and mq % 2 <> 0) then 1 else 0 end) / 100.0
    as "Margin",
  (pq + case when p - pq * 10000 > 5000 or (p - pq * 10000 = 5000 and pq % 2 <> 0) then 1 else 0 end) / 100.0
    as "Price",
  cast(split_part(key, '_', 1) as int) as fiscal, split_part(key, '_', 2) as destination,
  cast(split_part(key, '_', 3) as int) as bidlineno from cent)
"""
PERFORMANCE = """
performance as (select key,
    case when "Category" = 'Ambitious (97.5th Percentile)' then 'Net Price vs. Market' else 'Gap to next best' end
      as "Price", "Margin" as "This Year", "Price" as "Last Year", fiscal, destination, bidlineno
  from by_category where "Category" <> 'Proposed (Average)')
"""
TREE_ROWS = f"""
tree_rows as (select key, t as tree_id, p * (0.8 + 0.02 * t) as price
  from (select key, min(award_price_ty) as p from bids group by key), unnest(generate_series(0, {TREES - 1})) u(t))
"""
IMPORTANT = "important as (select distinct key from bids where award_competitor_id = 'CMP')"
LINE = f"fiscal = {LOOKUP['fiscal']} and destination = '{LOOKUP['destination']}' and bidlineno = {LOOKUP['bidlineno']}"


def reference(s, d):
    return written(s, d, "reference", lambda: bid_reference_table(bids(s, d)))


def linked(s, d):
    """The linked tables, written once."""
    parts = reference_tables(bids(s, d))
    return type(parts)(*[
        written(s, d, f"reference-{name}", lambda table=table: table)
        for name, table in (("details", parts.details), ("house", parts.house), ("awards", parts.awards))
    ])


def clustering(s, d):
    return clusters(s, d).where(F.col("key").startswith(f"{CLUSTER_YEAR}_")).withColumnRenamed("cluster", "Cluster")


def tagged(s, d):
    return dashboard.with_cluster(reference(s, d), clustering(s, d))


def report(s, d):
    return dashboard.reference_report(tagged(s, d))


def prices(s, d):
    """Award price as prediction, ten percent either way, less the mean committed cost."""
    offers = bids(s, d).where(F.col("award_price_ty") > 0)
    price = offers.groupBy("key").agg(F.min("award_price_ty").alias("Predicted_price"))
    costs = cost_qty_distance(offers).select("key", "committed_cost_ty")
    p, cost = F.col("Predicted_price"), F.col("committed_cost_ty")
    return price.join(costs, "key").select(
        "key", "Predicted_price",
        (p * F.lit(0.9)).alias("error_down_95"), (p * F.lit(1.1)).alias("error_up_95"),
        (p - cost).alias("estimated_margin"),
        (p * F.lit(0.9) - cost).alias("margin_lower"), (p * F.lit(1.1) - cost).alias("margin_upper"),
    )


def by_category(s, d):
    return dashboard.price_by_category(prices(s, d))


def trees(s, d):
    """A row per key and tree with a price around the award price."""
    keys = bids(s, d).groupBy("key").agg(F.min("award_price_ty").alias("p"))
    rows = keys.select("key", "p", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree_id"))
    price = F.col("p") * (F.lit(0.8) + F.lit(0.02) * F.col("tree_id"))
    return rows.select("key", "tree_id", price.alias("price"))


def important(s, d):
    """Keys the house won."""
    return bids(s, d).where(F.col("award_competitor_id") == "CMP").select("key").distinct()


def key_tables(s, d):
    return [prices(s, d), reference(s, d), trees(s, d), important(s, d)]


KEYS_SQL = """
common as (select key from price_rows intersect select key from reference_rows
  intersect select key from tree_rows intersect select key from important)
"""
KEY_PARTS = """key, cast(split_part(key, '_', 1) as int) as fiscal, split_part(key, '_', 2) as destination,
  cast(split_part(key, '_', 3) as int) as bidlineno"""



def _choices(column, condition, **chosen):
    return (
        lambda s, d: reshape.distinct_choices(dashboard.dashboard_keys(key_tables(s, d)), column, **chosen),
        over_bids(AWARDED, PRICED, COSTS, PRICES, REFERENCE, TREE_ROWS, IMPORTANT, KEYS_SQL,
                  f"select distinct {column} from (select {KEY_PARTS} from common) where {condition}"),
        [],
    )


QUERIES = {
    "bid_reference_table": (
        lambda s, d: bid_reference_table(bids(s, d)),
        over_bids(PRICED, REFERENCE, "select * from reference_rows"),
        REFERENCE_DOUBLES,
    ),
    "dashboard_cluster_details": (
        tagged,
        over_bids(PRICED, REFERENCE, TAGGED, "select * from tagged"),
        REFERENCE_DOUBLES,
    ),
    "dashboard_keys": (
        lambda s, d: dashboard.dashboard_keys(key_tables(s, d)),
        over_bids(AWARDED, PRICED, COSTS, PRICES, REFERENCE, TREE_ROWS, IMPORTANT, KEYS_SQL,
                  f"select {KEY_PARTS} from common"),
        [],
    ),
    "dashboard_selected_keys": (
        lambda s, d: dashboard.dashboard_keys(
            key_tables(s, d), ["1999_H7_12", "1999_H7_13", "2000_H3_30", "2001_H10_48"]
        ),
        over_bids(AWARDED, PRICED, COSTS, PRICES, REFERENCE, TREE_ROWS, IMPORTANT, KEYS_SQL,
                  f"""select {KEY_PARTS} from common
                  where key in ('1999_H7_12', '1999_H7_13', '2000_H3_30', '2001_H10_48')"""),
        [],
    ),
    "dashboard_choices_fiscal": _choices("fiscal", "true"),
    "dashboard_choices_destination": _choices("destination", f"fiscal = {LOOKUP['fiscal']}", fiscal=LOOKUP["fiscal"]),
    "dashboard_choices_bidlineno": _choices(
        "bidlineno", f"fiscal = {LOOKUP['fiscal']} and destination = '{LOOKUP['destination']}'",
        fiscal=LOOKUP["fiscal"], destination=LOOKUP["destination"],
    ),
    "dashboard_top_importance": (
        lambda s, d: dashboard.top_importance(view(s, d, IMPORTANCE_SQL)),
        f"""select "Feature" as variable, cast(replace("Relative Importance", '%', '') as double) as importance
        from ({bare(IMPORTANCE_SQL)}) order by importance desc, variable limit 5""",
        ["importance"],
    ),
    "dashboard_price_by_category": (
        by_category,
        over_bids(AWARDED, COSTS, PRICES, BY_CATEGORY, "select * from by_category"),
        ["Margin", "Price"],
    ),
    "dashboard_reference_report": (
        report,
        over_bids(PRICED, REFERENCE, TAGGED, REPORT, "select * from report"),
        REPORT_DOUBLES,
    ),
    "dashboard_performance": (
        lambda s, d: dashboard.performance_table(by_category(s, d)),
        over_bids(AWARDED, COSTS, PRICES, BY_CATEGORY, PERFORMANCE, "select * from performance"),
        ["This Year", "Last Year"],
    ),
    "win_probability_curve": (
        lambda s, d: dashboard.win_probability_curve(trees(s, d), **LOOKUP),
        over_bids(TREE_ROWS, f"""select 100.0 * row_number() over (order by price desc) / {TREES}.0 as win_probability,
          price from tree_rows where key = '{LOOKUP['fiscal']}_{LOOKUP['destination']}_{LOOKUP['bidlineno']}'"""),
        ["win_probability", "price"],
    ),
    "similar_bids": (
        lambda s, d: dashboard.similar_bids(report(s, d), CLUSTER_YEAR, **LOOKUP),
        over_bids(PRICED, REFERENCE, TAGGED, REPORT, f"""
        select distinct {', '.join(f'"{c}"' for c in PEER_COLUMNS)} from report
        where fiscal = {CLUSTER_YEAR} and "Cluster" in (select "Cluster" from report
          where fiscal = {LOOKUP['fiscal']} and destination_no = '{LOOKUP['destination']}'
            and bid_line_no = {LOOKUP['bidlineno']})
        order by {', '.join(f'"{c}" nulls last' for c in PEER_COLUMNS)} limit 5"""),
        REPORT_DOUBLES,
    ),
    "reference_house_offers": (
        lambda s, d: linked(s, d).house,
        over_bids(PRICED, REFERENCE, LINKED, "select * from all_house"),
        ["cmp_price"],
    ),
    "reference_last_awards": (
        lambda s, d: linked(s, d).awards,
        over_bids(PRICED, REFERENCE, LINKED, "select * from all_awards where key in (select key from all_details)"),
        ["last_yr_award_price"],
    ),
    "reference_links": (
        lambda s, d: linked(s, d).links,
        over_bids(PRICED, REFERENCE, LINKED, """select l.*, n_rows from link_counts l
          join (select key, count(*) as n_rows from joined_rows group by key) j on l.key = j.key"""),
        [],
    ),
    "reference_with_counts": (
        lambda s, d: with_link_counts(reference(s, d), linked(s, d)),
        over_bids(PRICED, REFERENCE, LINKED, """select r.*, n_house_offers, n_last_yr_awards
          from reference_rows r join link_counts l on r.key = l.key"""),
        REFERENCE_DOUBLES,
    ),
    "reference_totals": (
        lambda s, d: totals(linked(s, d)),
        over_bids(PRICED, REFERENCE, LINKED, """select fiscal, count(*) as n_rows,
          count(last_yr_award_price) as n_compared, sum(delta_awardprice_lastyr) as delta_awardprice_lastyr,
          count(*) filter (incumbent <> 'None') as n_incumbent from joined_rows group by fiscal"""),
        ["delta_awardprice_lastyr"],
    ),
    "similar_offers": (
        lambda s, d: dashboard.similar_offers(linked(s, d), clustering(s, d), CLUSTER_YEAR, **LOOKUP),
        over_bids(PRICED, REFERENCE, LINKED, TAGGED.replace("reference_rows", "joined_rows"), REPORT, f"""
        select distinct {', '.join(f'"{c}"' for c in PEER_COLUMNS)} from report
        where fiscal = {CLUSTER_YEAR} and "Cluster" in (select "Cluster" from report
          where fiscal = {LOOKUP['fiscal']} and destination_no = '{LOOKUP['destination']}'
            and bid_line_no = {LOOKUP['bidlineno']})
        order by {', '.join(f'"{c}" nulls last' for c in PEER_COLUMNS)} limit 5"""),
        REPORT_DOUBLES,
    ),
    "bid_line_detail": (
        lambda s, d: dashboard.bid_line_detail(report(s, d), LOOKUP["destination"], LOOKUP["bidlineno"]),
        over_bids(PRICED, REFERENCE, TAGGED, REPORT, f"""
        select "City & State", "Date", "Volume (K Tons)", "CMP Won Bid" from report
        where destination_no = '{LOOKUP['destination']}' and bid_line_no = {LOOKUP['bidlineno']}"""),
        ["Volume (K Tons)"],
    ),
    "price_table_lookup": (
        lambda s, d: dashboard.price_table(by_category(s, d), **LOOKUP),
        over_bids(AWARDED, COSTS, PRICES, BY_CATEGORY,
                  f'select "Category", "Price", "Margin" from by_category where {LINE}'),
        ["Margin", "Price"],
    ),
    "performance_lookup": (
        lambda s, d: dashboard.performance_lookup(
            dashboard.performance_table(by_category(s, d)), **LOOKUP
        ),
        over_bids(AWARDED, COSTS, PRICES, BY_CATEGORY, PERFORMANCE,
                  f'select "Price", "This Year", "Last Year" from performance where {LINE}'),
        ["This Year", "Last Year"],
    ),
}

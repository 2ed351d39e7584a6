"""Queries on the bid table: cleaning, key tables, feature groups, reference table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenderlake.plans import bids as bid_plans
from tenderlake.plans import features
from workload.sqltext import CLUSTER_CTE, over_bids
from workload.views import CALENDAR, RUN_YEAR, bids, clusters, raw_bids, unserved

AWARDED = "awarded as (select * from bids where award_price_ty > 0)"
PRICED = "priced as (select * from bids where award_price_ty > 0 and committed_price_ty > 0)"
NEXT_KEY = "concat(cast(fiscal + 1 as varchar), '_', destination_no, '_', cast(bid_line_no as varchar))"

CORE = [
    "key", "fiscal", "destination_no", "bid_line_no", "price_competitor_id", "committed_price_ty",
    "award_price_ty", "award_competitor_id", "total_qty_ty", "bid_due_date", "customer_no", "bid_no",
    "bid_type_name", "destination_zip_postal",
]
FEATURE_TABLE_DOUBLES = [
    "target", "distance_ty", "stockpile_depot_cost_ty", "direct_transfer_depot_cost_ty", "freight_cost_ty",
    "fuel_surcharge_cost_ty", "equipment_cost_ty", "committed_cost_ty", "total_qty_ty",
    "avg_awardprice_destination_prevyear", "avg_wt_awardprice_region_prev1year", "per_pricemovement_region",
    "min_qty_per", "max_qty_per", "contract_timeframe", "nbc_committed_price_prevyr", "min_price_gap_nbc",
    "cmp_committed_price_prevyr", "cmp_nbc_pricediff_prevyr", "fill_rate_CMP",
    "avg_committed_price_prevyr_cluster", "avg_award_price_prevyr_cluster",
]

KEY_ROWS = f"""
award_rows as (
  select distinct fiscal, destination_no, bid_line_no, key, award_price_ty as target, bid_due_date as date from awarded),
key_table as (
  select fiscal, destination_no, bid_line_no,
         first(date order by target nulls first, date nulls first) filter (date is not null) as date,
         key, min(target) as target
  from award_rows group by fiscal, destination_no, bid_line_no, key)
"""

TYPES = """
region_product as (
  select key,
    first(sales_region_name order by sales_region_name nulls first)
      filter (sales_region_name is not null) as sales_region_name,
    first(product_name order by sales_region_name nulls first, product_name nulls first)
      filter (product_name is not null) as product_name,
    first(bid_type_name order by sales_region_name nulls first, product_name nulls first, bid_type_name nulls first)
      filter (bid_type_name is not null) as bid_type_name,
    first(customer_type_name order by sales_region_name nulls first, product_name nulls first,
      bid_type_name nulls first, customer_type_name nulls first)
      filter (customer_type_name is not null) as customer_type_name
  from awarded group by key)
"""
COSTS = """
costs as (
  select key, avg(total_qty_ty) as total_qty_ty, avg(distance_ty) as distance_ty,
    avg(stockpile_depot_cost_ty) as stockpile_depot_cost_ty,
    avg(direct_transfer_depot_cost_ty) as direct_transfer_depot_cost_ty,
    avg(freight_cost_ty) as freight_cost_ty, avg(fuel_surcharge_cost_ty) as fuel_surcharge_cost_ty,
    avg(equipment_cost_ty) as equipment_cost_ty, avg(committed_cost_ty) as committed_cost_ty
  from (select distinct key, award_price_ty, total_qty_ty, min_purchase_qty_ty, max_supply_qty_ty, distance_ty,
          stockpile_depot_cost_ty, direct_transfer_depot_cost_ty, freight_cost_ty, fuel_surcharge_cost_ty,
          equipment_cost_ty, committed_cost_ty from awarded)
  group by key)
"""
RIVALS = f"""
rivals as (
  select {NEXT_KEY} as key, count(distinct price_competitor_id) as num_competitors_prevyear,
    case when count(distinct price_competitor_id) = 0 then 1 else 0 end as "Is_NoCompetitionPrevYear"
  from bids where committed_price_ty > 0 and price_competitor_id is distinct from 'CMP' group by 1)
"""
DESTINATION = """
destination_means as (
  select fiscal + 1 as fiscal, destination_no, avg(award_price_ty) as avg_awardprice_destination_prevyear
  from (select distinct key, fiscal, bid_line_no, destination_no, award_price_ty from awarded)
  group by fiscal, destination_no),
destination_prices as (
  select distinct a.key, m.avg_awardprice_destination_prevyear
  from awarded a join destination_means m on a.fiscal = m.fiscal and a.destination_no = m.destination_no)
"""
REGION = """
weighted as (
  select distinct key, fiscal, sales_region_name, award_price_ty / nullif(total_qty_ty, 0) as w from awarded),
region_means as (
  select fiscal, sales_region_name, avg(w) as m
  from (select distinct fiscal, sales_region_name, w from weighted) where sales_region_name is not null group by all),
region_rows as (
  select w.key, w.sales_region_name, p1.m as one, p1.m / nullif(p2.m, 0) - 1 as movement
  from weighted w
  join region_means p1 on p1.fiscal = w.fiscal - 1 and p1.sales_region_name = w.sales_region_name
  join region_means p2 on p2.fiscal = w.fiscal - 2 and p2.sales_region_name = w.sales_region_name),
region_prices as (
  select key, first(one order by sales_region_name) filter (one is not null) as avg_wt_awardprice_region_prev1year,
    first(movement order by sales_region_name) filter (movement is not null) as per_pricemovement_region
  from region_rows group by key)
"""
QUANTITY = """
quantity_means as (
  select key, avg(min_purchase_qty_ty) as lo, avg(max_supply_qty_ty) as hi, avg(total_qty_ty) as total_qty_ty
  from (select distinct key, min_purchase_qty_ty, max_supply_qty_ty, total_qty_ty from awarded) group by key),
quantities as (
  select key, total_qty_ty, lo / nullif(total_qty_ty, 0) as min_qty_per, hi / nullif(total_qty_ty, 0) as max_qty_per,
    case when hi > 0 and total_qty_ty >= 0 then 1 else 0 end as "Is_minmaxqtypresent" from quantity_means)
"""
TIMEFRAME = """
timeframes as (
  select key, avg(expiry_date - effective_date) as contract_timeframe
  from (select distinct key, effective_date, expiry_date from awarded) group by key)
"""
ROLLOVER = "rollovers as (select key, bool_and(rollover) as rollover from awarded group by key)"
NEXT_BEST = f"""
prev_offers as (select distinct {NEXT_KEY} as key, price_competitor_id, committed_price_ty, award_price_ty,
  award_competitor_id, committed_price_ty - award_price_ty as gap from priced),
prev_rivals as (select * from prev_offers where price_competitor_id is distinct from 'CMP'),
tied as (select r.* from prev_rivals r join (select key, min(gap) as least from prev_rivals group by key) m
  on r.key = m.key and r.gap = m.least),
best as (select key,
    first(price_competitor_id order by price_competitor_id, committed_price_ty)
      filter (price_competitor_id is not null) as rival,
    first(committed_price_ty order by price_competitor_id nulls first, committed_price_ty) as price,
    min(gap) as gap
  from tied group by key),
house as (select key, min(committed_price_ty) as price,
    first(award_competitor_id order by committed_price_ty, award_price_ty, award_competitor_id nulls first)
      filter (award_competitor_id is not null) as winner
  from prev_offers where price_competitor_id = 'CMP' group by key),
next_best as (select b.key, b.price as nbc_committed_price_prevyr, b.gap as min_price_gap_nbc,
    case when rival = 'CS' then 1 else 0 end as "Is_cargill_nbc",
    case when rival = 'MS' then 1 else 0 end as "Is_KplusS_nbc",
    h.price as cmp_committed_price_prevyr,
    case when winner = 'CMP' then 1 else 0 end as "Is_cmp_awarded_prevyr",
    h.price - b.price as cmp_nbc_pricediff_prevyr
  from best b join house h on b.key = h.key)
"""
FILL = f"""
due as (select distinct fiscal, destination_no, bid_line_no, key, bid_due_date, price_competitor_id,
  award_competitor_id, total_qty_ty from priced),
won as (select fiscal, price_competitor_id, bid_due_date, coalesce(sum(total_qty_ty), 0) as qty
  from due where price_competitor_id = award_competitor_id group by all),
share as (select *, qty / nullif(sum(qty) over (partition by fiscal, price_competitor_id), 0) / 1.25 as part from won),
cumulated as (select fiscal, price_competitor_id, bid_due_date, sum(part) over (
  partition by fiscal, price_competitor_id order by bid_due_date rows unbounded preceding) as rate from share),
grid as (select p.fiscal, p.price_competitor_id, cast(d.day as date) as bid_due_date
  from (select distinct fiscal, price_competitor_id from due where price_competitor_id is not null) p
  cross join (select unnest(generate_series(date '{CALENDAR[0]}', date '{CALENDAR[1]}', interval 1 day)) as day) d),
daily as (select fiscal, price_competitor_id, bid_due_date,
    coalesce(last_value(rate ignore nulls) over (partition by fiscal, price_competitor_id order by bid_due_date
      rows between unbounded preceding and current row), 0) as fill_rate
  from grid full join cumulated using (fiscal, price_competitor_id, bid_due_date)),
fill_rates as (select w.key, arg_min(h.fill_rate, w.bid_due_date) as "fill_rate_CMP"
  from due w
  join daily d on d.fiscal = w.fiscal and d.price_competitor_id = w.price_competitor_id
    and d.bid_due_date = w.bid_due_date
  join daily h on h.price_competitor_id = 'CMP' and h.fiscal = w.fiscal and h.bid_due_date = w.bid_due_date
  where w.price_competitor_id = w.award_competitor_id group by w.key)
"""
FLAGS = """
states as (select destination_state_prov, case when count(distinct bid_line_no) = 1 then 1 else 0 end as only_one
  from awarded group by 1),
flags as (select key,
    first(only_one order by a.destination_state_prov) filter (only_one is not null) as is_onlybid_in_state,
    first(regexp_matches(lower(bid_name), '^emergency') order by bid_name) filter (bid_name is not null)
      as is_emergency_bid,
    first(regexp_matches(lower(bid_name), '^supplemental') order by bid_name) filter (bid_name is not null)
      as is_supplemental_bid
  from awarded a left join states s on a.destination_state_prov = s.destination_state_prov group by key)
"""
CLUSTER = f"""
{CLUSTER_CTE.strip()},
cluster_base as (select distinct p.key, p.fiscal, p.price_competitor_id, p.committed_price_ty, p.award_price_ty,
  c.cluster from priced p left join clusters c on p.key = c.key),
cluster_committed as (select fiscal, cluster, avg(committed_price_ty) as m from (select distinct cluster, fiscal, key,
  price_competitor_id, committed_price_ty from cluster_base) where cluster is not null group by all),
cluster_award as (select fiscal, cluster, avg(award_price_ty) as m from (select distinct cluster, fiscal,
  award_price_ty from cluster_base) where cluster is not null group by all),
cluster_rivals as (select fiscal, cluster, count(distinct price_competitor_id) as n from cluster_base
  where cluster is not null group by all),
cluster_values as (select k.key, k.fiscal, k.cluster, c.m as avg_committed_price_prevyr_cluster,
    a.m as avg_award_price_prevyr_cluster, r.n as num_competitors_prevyr_cluster
  from (select distinct key, fiscal, cluster from cluster_base) k
  left join cluster_committed c on c.fiscal = k.fiscal - 1 and c.cluster = k.cluster
  left join cluster_award a on a.fiscal = k.fiscal - 1 and a.cluster = k.cluster
  left join cluster_rivals r on r.fiscal = k.fiscal - 1 and r.cluster = k.cluster)
"""

FEATURE_TABLE = over_bids(
    AWARDED, PRICED, KEY_ROWS, TYPES, COSTS, RIVALS, DESTINATION, REGION, QUANTITY, TIMEFRAME, ROLLOVER,
    NEXT_BEST, FILL, FLAGS, CLUSTER,
    f"""
select *
from (select key, date, target from key_table where year(date) <= {RUN_YEAR - 1}) k
left join region_product using (key) left join rivals using (key) left join costs using (key)
left join destination_prices using (key) left join region_prices using (key)
left join (select * exclude (total_qty_ty) from quantities) using (key)
left join timeframes using (key) left join rollovers using (key) left join next_best using (key)
left join fill_rates using (key) left join flags using (key) left join cluster_values using (key)
""",
)


def _feature(build, *ctes, table, doubles=()):
    return (lambda s, d: build(bids(s, d)), over_bids(*ctes, f"select * from {table}"), doubles)


def target(s, d):
    return bid_plans.target_table(bids(s, d), RUN_YEAR - 1)


def training_features(s, d):
    return features.feature_table(target(s, d), bids(s, d), clusters(s, d), CALENDAR)


def scoring_features(s, d):
    keys = bid_plans.scoring_table(bids(s, d), RUN_YEAR)
    return features.feature_table(keys, bids(s, d), clusters(s, d), CALENDAR, ["key"], RUN_YEAR)


QUERIES = {
    "intermediate_bids": (
        lambda s, d: bid_plans.intermediate_bids(raw_bids(s, d), unserved(s, d)).select(*CORE),
        over_bids(f"select {', '.join(CORE)} from bids"),
        ["committed_price_ty", "award_price_ty", "total_qty_ty"],
    ),
    "target_table": (
        target,
        over_bids(AWARDED, KEY_ROWS, f"select * from key_table where year(date) <= {RUN_YEAR - 1}"),
        ["target"],
    ),
    "scoring_table": (
        lambda s, d: bid_plans.scoring_table(bids(s, d), RUN_YEAR),
        over_bids(AWARDED, KEY_ROWS, f"select * from key_table where year(date) = {RUN_YEAR}"),
        ["target"],
    ),
    "feature_region_product_types": _feature(features.region_product_types, AWARDED, TYPES, table="region_product"),
    "feature_cost_qty_distance": _feature(
        features.cost_qty_distance, AWARDED, COSTS, table="costs", doubles=features.COST_COLUMNS
    ),
    "feature_competitors_previous_year": _feature(features.competitors_previous_year, RIVALS, table="rivals"),
    "feature_destination_price": _feature(
        features.destination_price_previous_year, AWARDED, DESTINATION, table="destination_prices",
        doubles=["avg_awardprice_destination_prevyear"],
    ),
    "feature_region_price_movement": _feature(
        features.region_price_movement, AWARDED, REGION, table="region_prices",
        doubles=["avg_wt_awardprice_region_prev1year", "per_pricemovement_region"],
    ),
    "feature_min_max_quantity": _feature(
        features.min_max_quantity, AWARDED, QUANTITY, table="quantities",
        doubles=["total_qty_ty", "min_qty_per", "max_qty_per"],
    ),
    "feature_contract_timeframe": _feature(
        features.contract_timeframe, AWARDED, TIMEFRAME, table="timeframes", doubles=["contract_timeframe"]
    ),
    "feature_rollover": _feature(features.rollover_contract, AWARDED, ROLLOVER, table="rollovers"),
    "feature_next_best_competitor": _feature(
        features.next_best_competitor, PRICED, NEXT_BEST, table="next_best",
        doubles=["nbc_committed_price_prevyr", "min_price_gap_nbc", "cmp_committed_price_prevyr",
                 "cmp_nbc_pricediff_prevyr"],
    ),
    "daily_fill_rate": (
        lambda s, d: features.daily_fill_rate(bids(s, d), CALENDAR),
        over_bids(PRICED, FILL, "select * from daily"),
        ["fill_rate"],
    ),
    "feature_fill_rate": (
        lambda s, d: features.fill_rate(bids(s, d), CALENDAR),
        over_bids(PRICED, FILL, "select * from fill_rates"),
        ["fill_rate_CMP"],
    ),
    "feature_bid_flags": _feature(features.bid_flags, AWARDED, FLAGS, table="flags"),
    "feature_cluster": (
        lambda s, d: features.cluster_features(bids(s, d), clusters(s, d)),
        over_bids(PRICED, CLUSTER, "select * from cluster_values"),
        ["avg_committed_price_prevyr_cluster", "avg_award_price_prevyr_cluster"],
    ),
    "feature_table": (training_features, FEATURE_TABLE, FEATURE_TABLE_DOUBLES),
    "scoring_feature_table": (
        scoring_features,
        FEATURE_TABLE.replace(
            f"select key, date, target from key_table where year(date) <= {RUN_YEAR - 1}",
            f"select key from key_table where year(date) = {RUN_YEAR}",
        ),
        [c for c in FEATURE_TABLE_DOUBLES if c != "target"],
    ),
}

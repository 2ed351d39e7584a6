"""Single operators as queries of their own, on the bid, invoice and tree-price views."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenderlake.functions import aggregates, columns
from tenderlake.operators import joins, reshape, windows
from tenderlake.plans import features, scorecard, trees
from tenderlake.sources.ingest import typed_bids
from workload import views
from workload.bid_queries import AWARDED, COSTS, FILL, PRICED
from workload.dashboard_queries import PRICES, prices
from workload.scorecard_queries import DRIVERS, SCORES, contributions, scores
from workload.sqltext import KEYS_CTE, bare, over_bids, over_invoices, over_raw
from workload.views import CALENDAR, bids, clusters, invoices, raw_bids, scorecard_keys, table, tree_prices, view

RAW_TEXT_SQL = """
select
  cast(o.o_orderkey as varchar(20)) as "BID_#",
  concat(cast(c.c_custkey as varchar(20)), '.7') as "CUSTOMER_ID",
  case when c.c_custkey % 5 = 0 then 'n/a' else cast(c.c_custkey as varchar(20)) end as "DEPOT_#",
  case when o.o_orderkey % 7 = 0 then 'unknown' else concat(substr(cast(cast(o.o_orderdate as date) as varchar(10)), 9, 2),
    '/', substr(cast(cast(o.o_orderdate as date) as varchar(10)), 6, 2), '/',
    substr(cast(cast(o.o_orderdate as date) as varchar(10)), 1, 4), ' 00:00:00') end as "BID_DUE_DATE",
  concat('Qu', n.n_name, 'é è é', '�', 'x', '�') as "BID_NAME",
  case when o.o_orderkey % 11 = 0 then '-' else concat(cast(o.o_orderkey % 1000 as varchar(10)), '.25') end
    as "TOTAL_QTY_TY",
  case o.o_orderkey % 3 when 0 then 'Y' when 1 then 'N' else null end as "ROLLOVER",
  o.o_orderpriority as "REMARK"
from {orders} o
join {customer} c on o.o_custkey = c.c_custkey
join {nation} n on c.c_nationkey = n.n_nationkey
"""

TREE_CTE = """
tree_rows as (select cast(vec_id as varchar) as key, unnest(generate_series(0, len(embedding) - 1)) as tree_id,
  cast(unnest(embedding) as double) as price from embeddings)
"""
ORDERS_CTE = f"sales_orders as ({bare(views.SALES_ORDERS_SQL)})"


def fills(s, d):
    won = features.won_quantity(bids(s, d))
    return windows.capacity_share(won, ["fiscal", "price_competitor_id"], "bid_due_date", "total_qty_ty", 1.25)


def competitor_years(s, d):
    rows = bids(s, d).where((F.col("award_price_ty") > 0) & (F.col("committed_price_ty") > 0))
    return rows.select("fiscal", "price_competitor_id").dropna().distinct()


def prices_long(s, d):
    return reshape.to_long(prices(s, d), ["key"])


def prices_wide(s, d):
    names = ["Predicted_price", "error_down_95", "error_up_95", "estimated_margin", "margin_lower", "margin_upper"]
    return reshape.to_wide(prices_long(s, d), ["key"], "variable", "value", names)


MATRIX_TREES = 64
TYPE_NAMES = ["Municipal", "County", "State", "Institutional"]

QUERIES = {
    "import_typed_columns": (
        lambda s, d: typed_bids(view(s, d, RAW_TEXT_SQL)),
        f"""select cast("BID_#" as int) as "bid_no", cast(trunc(try_cast("CUSTOMER_ID" as double)) as int) as customer_id,
          cast(trunc(try_cast("DEPOT_#" as double)) as int) as "depot_no",
          cast(try_strptime("BID_DUE_DATE", '%d/%m/%Y %H:%M:%S') as date) as bid_due_date,
          regexp_replace(translate("BID_NAME", 'éè', 'ee'), '�', 'e') as bid_name,
          try_cast("TOTAL_QTY_TY" as double) as total_qty_ty, "ROLLOVER" = 'Y' as rollover, "REMARK" as remark
        from ({bare(RAW_TEXT_SQL)})""", ["total_qty_ty"]),
    "lenient_int_cast": (
        lambda s, d: table(s, d, "customer").select(
            "c_custkey", columns.lenient_int(F.col("c_acctbal").cast("string")).alias("balance"),
            columns.lenient_int("c_name").alias("bad"),
        ),
        """select c_custkey, cast(trunc(c_acctbal) as int) as balance, cast(null as int) as bad from customer""", []),
    "accent_repair": (
        lambda s, d: typed_bids(view(s, d, RAW_TEXT_SQL).select("`BID_#`", "BID_NAME")),
        f"""select cast("BID_#" as int) as bid_no,
          regexp_replace(replace(replace("BID_NAME", 'é', 'e'), 'è', 'e'), '�', 'e') as bid_name
        from ({bare(RAW_TEXT_SQL)})""", []),
    "not_house_null_safe": (
        lambda s, d: raw_bids(s, d).where(columns.differs_from("price_competitor_id", "CMP"))
        .groupBy("price_competitor_id").agg(F.count("*").alias("offers")),
        over_raw("""select price_competitor_id, count(*) as offers from raw
          where price_competitor_id <> 'CMP' or price_competitor_id is null group by 1"""), []),
    "supplier_name_contains": (
        lambda s, d: scorecard.program_customers(view(s, d, views.PROGRAM_SQL), "brenntag"),
        f"""select distinct substr(ship_to, 1, 6) as "Customer" from ({bare(views.PROGRAM_SQL)})
        where supplier_name ilike '%brenntag%'""", []),
    "unserved_anti_join": (
        lambda s, d: joins.without_listed(raw_bids(s, d), views.unserved(s, d), "destination_zip_postal")
        .groupBy("fiscal").agg(F.count("*").alias("offers")),
        over_raw(f"""select fiscal, count(*) as offers from raw where not exists (select 1
          from ({bare(views.UNSERVED_SQL)}) u where u.destination_zip_postal = raw.destination_zip_postal)
          group by fiscal"""), []),
    "calendar_by_group": (
        lambda s, d: joins.with_calendar(competitor_years(s, d), *CALENDAR, "bid_due_date"),
        over_bids(PRICED, FILL, "select fiscal, price_competitor_id, bid_due_date from grid"), []),
    "calendar_outer_join": (
        lambda s, d: joins.with_calendar(competitor_years(s, d), "1996-01-01", "1999-12-31", "bid_due_date").join(
            fills(s, d).select("fiscal", "price_competitor_id", "bid_due_date", "fill_rate"),
            ["fiscal", "price_competitor_id", "bid_due_date"], "outer"),
        over_bids(PRICED, FILL, """select fiscal, price_competitor_id, bid_due_date, rate as fill_rate from (
          select * from grid where bid_due_date between date '1996-01-01' and date '1999-12-31') g
          full join cumulated using (fiscal, price_competitor_id, bid_due_date)"""), ["fill_rate"]),
    "semi_join": (
        lambda s, d: joins.only_listed(
            invoices(s, d), view(s, d, views.CALLS_SQL).distinct(), ["customer_bill_to_id"]
        ).groupBy("customer_bill_to_id").agg(F.count("*").alias("lines")),
        over_invoices(f"""select customer_bill_to_id, count(*) as lines from invoices where customer_bill_to_id in
          (select customer_bill_to_id from ({bare(views.CALLS_SQL)})) group by 1"""), []),
    "last_year_date_range_join": (
        lambda s, d: joins.within_last_year(
            invoices(s, d).groupBy("key", "billing_date").agg(F.sum("inv_delivered_gp").alias("gp")),
            scorecard_keys(s, d).select("key", "last_trx_date"), "billing_date", "last_trx_date"),
        over_invoices(KEYS_CTE, """select i.key, i.billing_date, k.last_trx_date, sum(inv_delivered_gp) as gp
          from invoices i join score_keys k on i.key = k.key and i.billing_date <= k.last_trx_date
            and i.billing_date >= cast(k.last_trx_date - interval 1 year as date) group by all"""), ["gp"]),
    "latest_order_rows": (
        lambda s, d: joins.latest_rows(
            view(s, d, views.SALES_ORDERS_SQL), ["customer_bill_to_id"], "order_entry_date"),
        f"""with {ORDERS_CTE} select s.* from sales_orders s join (select customer_bill_to_id,
          max(order_entry_date) as last from sales_orders group by 1) m
          on s.customer_bill_to_id = m.customer_bill_to_id and s.order_entry_date = m.last""", []),
    "validated_lookup_join": (
        lambda s, d: joins.attach(
            bids(s, d).groupBy("key").agg(F.count("*").alias("offers")), clusters(s, d), ["key"]),
        over_bids("""k as (select key, count(*) as offers from bids group by key)""",
                  """c as (select distinct key, bid_line_no % 7 as cluster from bids where bid_line_no % 11 <> 0)""",
                  "select k.*, c.cluster from k left join c on k.key = c.key"), []),
    "membership_flag": (
        lambda s, d: joins.membership(
            bids(s, d).select("key").distinct(), bids(s, d).where(F.col("award_competitor_id") == "CMP"),
            ["key"], "house_won", "Yes", "No"),
        over_bids("""select key, case when max(case when award_competitor_id = 'CMP' then 1 else 0 end) = 1
          then 'Yes' else 'No' end as house_won from bids group by key"""), []),
    "distinct_competitors": (
        lambda s, d: bids(s, d).groupBy("fiscal", "destination_no").agg(
            F.count_distinct("price_competitor_id").alias("competitors")),
        over_bids("""select fiscal, destination_no, count(distinct price_competitor_id) as competitors
          from bids group by all"""), []),
    "first_non_null_per_key": (
        lambda s, d: aggregates.first_per_key(
            bids(s, d).select("key", "bid_no", "price_competitor_id", "bid_name", "equipment_cost_ty"), ["key"]),
        over_bids("""select key, min(bid_no) as bid_no,
          first(price_competitor_id order by bid_no, price_competitor_id) filter (price_competitor_id is not null)
            as price_competitor_id,
          first(bid_name order by bid_no, price_competitor_id nulls first, bid_name) filter (bid_name is not null)
            as bid_name,
          first(equipment_cost_ty order by bid_no, price_competitor_id nulls first, bid_name nulls first,
            equipment_cost_ty) filter (equipment_cost_ty is not null) as equipment_cost_ty
          from bids group by key"""), ["equipment_cost_ty"]),
    "one_row_per_key": (
        lambda s, d: joins.one_row_per(
            bids(s, d).select("key", "bid_due_date", "price_competitor_id", "committed_price_ty"), ["key"],
            [F.col("bid_due_date")]),
        over_bids("""select key, bid_due_date, price_competitor_id, committed_price_ty from (
          select *, row_number() over (partition by key order by bid_due_date, price_competitor_id nulls last,
            committed_price_ty) as r from bids) where r = 1"""), ["committed_price_ty"]),
    "top_product_by_profit": (
        lambda s, d: invoices(s, d).groupBy("customer_bill_to_id", "product_no")
        .agg(F.sum("inv_delivered_gp").alias("profit"))
        .groupBy("customer_bill_to_id").agg(aggregates.top_by("product_no", "profit").alias("product_no")),
        over_invoices("""p as (select customer_bill_to_id, product_no, sum(inv_delivered_gp) as profit
          from invoices group by all)""", """select customer_bill_to_id, product_no from (select *, row_number() over (
          partition by customer_bill_to_id order by profit desc, product_no) as r from p) where r = 1"""), []),
    "price_interval_percentiles": (
        lambda s, d: tree_prices(s, d).groupBy("key").agg(
            aggregates.percentile("price", 0.025).alias("error_down_95"),
            aggregates.percentile("price", 0.975).alias("error_up_95")),
        f"""with {TREE_CTE} select key, quantile_cont(price, 0.025) as error_down_95,
          quantile_cont(price, 0.975) as error_up_95 from tree_rows group by key""",
        ["error_down_95", "error_up_95"]),
    "group_total_on_rows": (
        lambda s, d: windows.group_total(
            bids(s, d).select("key", "bid_no", "price_competitor_id", "total_qty_ty"), ["key"], "total_qty_ty", "whole"),
        over_bids("""select key, bid_no, price_competitor_id, total_qty_ty,
          sum(total_qty_ty) over (partition by key) as whole from bids"""), ["total_qty_ty", "whole"]),
    "cumulative_share": (
        fills,
        over_bids(PRICED, FILL, """select s.fiscal, s.price_competitor_id, s.bid_due_date, s.qty as total_qty_ty,
          c.rate as fill_rate from share s join cumulated c using (fiscal, price_competitor_id, bid_due_date)"""),
        ["total_qty_ty", "fill_rate"]),
    "forward_fill": (
        lambda s, d: fills(s, d).select(
            "fiscal", "price_competitor_id", "bid_due_date",
            F.when(F.dayofmonth("bid_due_date") % 3 == 0, F.col("fill_rate")).alias("known"),
        ).withColumn("filled", windows.forward_fill("known", ["fiscal", "price_competitor_id"], "bid_due_date")),
        over_bids(PRICED, FILL, """k as (select fiscal, price_competitor_id, bid_due_date,
            case when day(bid_due_date) % 3 = 0 then rate end as known from cumulated)""",
                  """select *, coalesce(last_value(known ignore nulls) over (partition by fiscal, price_competitor_id
            order by bid_due_date rows between unbounded preceding and current row), 0.0) as filled from k"""),
        ["known", "filled"]),
    "rank_bands": (
        lambda s, d: windows.band_by_rank(scores(s, d), "churn_prob", "key", scores(s, d).count(), "band").select(
            "key", "churn_prob", "band"),
        over_invoices(KEYS_CTE, SCORES, """r as (select *, row_number() over (order by churn_prob desc, key) - 1 as pos,
            cast(round_even(count(*) over () * 0.042, 0) as bigint) as n from scores)""",
                      """select key, churn_prob, case when pos < cast(floor(n * 0.10) as bigint) then 'Very High'
            when pos < cast(floor(n * 0.30) as bigint) then 'High'
            when pos < cast(floor(n * 0.60) as bigint) then 'Medium'
            when pos <= n then 'Low' else 'Very Low' end as band from r"""), ["churn_prob"]),
    "global_rank": (
        lambda s, d: windows.rank_by(
            bids(s, d).groupBy("key").agg(F.max("committed_price_ty").alias("price")),
            [F.col("price").desc(), F.col("key").asc()], "position"),
        over_bids("k as (select key, max(committed_price_ty) as price from bids group by key)",
                  "select *, row_number() over (order by price desc, key) - 1 as position from k"), ["price"]),
    "win_probability_rank": (
        lambda s, d: windows.win_probability(tree_prices(s, d)),
        f"""with {TREE_CTE} select key, price, 100.0 * row_number() over (partition by key order by price desc, tree_id)
          / count(*) over (partition by key) as win_probability from tree_rows""", ["price", "win_probability"]),
    "top_names_per_key": (
        lambda s, d: windows.top_names(
            contributions(s, d), "key", "feature", "contribution", 3, "name_"),
        over_invoices(KEYS_CTE, DRIVERS, """r as (select key, feature, row_number() over (partition by key
          order by contribution desc, feature) as r from contributions)""",
                      """select key, max(case when r = 1 then feature end) as name_1,
          max(case when r = 2 then feature end) as name_2, max(case when r = 3 then feature end) as name_3
          from r group by key"""), []),
    "stacked_keys": (
        lambda s, d: reshape.stack([
            raw_bids(s, d).select("fiscal", "committed_price_ty"), bids(s, d).select("committed_price_ty", "fiscal")
        ]).groupBy("fiscal").agg(F.count("*").alias("offers"), F.avg("committed_price_ty").alias("price")),
        over_bids("""select fiscal, count(*) as offers, avg(committed_price_ty) as price from (
          select fiscal, committed_price_ty from raw union all select fiscal, committed_price_ty from bids)
          group by fiscal"""), ["price"]),
    "common_keys": (
        lambda s, d: reshape.common_keys([
            bids(s, d).where(F.col("price_competitor_id") == c) for c in ("CMP", "CS", "MS", "AM")
        ]),
        over_bids(" select key from bids where price_competitor_id in ('CMP', 'CS', 'MS', 'AM') group by key "
                  "having count(distinct price_competitor_id) = 4"), []),
    "wide_to_long": (
        prices_long,
        over_bids(AWARDED, COSTS, PRICES, """select key, variable, value from price_rows unpivot (value for variable in (
          "Predicted_price", error_down_95, error_up_95, estimated_margin, margin_lower, margin_upper))"""), ["value"]),
    "long_to_wide": (
        prices_wide,
        over_bids(AWARDED, COSTS, PRICES, "select * from price_rows"),
        ["Predicted_price", "error_down_95", "error_up_95", "estimated_margin", "margin_lower", "margin_upper"]),
    "one_hot_columns": (
        lambda s, d: reshape.one_hot(
            features.region_product_types(bids(s, d)).select("key", "bid_type_name"), {"bid_type_name": TYPE_NAMES}),
        over_bids(AWARDED, """t as (select key, first(bid_type_name order by sales_region_name nulls first,
            product_name nulls first, bid_type_name nulls first) filter (bid_type_name is not null) as t
          from awarded group by key)""", "select key, " + ", ".join(
            f"cast(coalesce(t = '{n}', false) as int) as \"bid_type_name_{n}\"" for n in TYPE_NAMES) + " from t"), []),
    "aligned_scoring_columns": (
        lambda s, d: reshape.align_columns(
            reshape.one_hot(
                features.region_product_types(bids(s, d).where(F.col("fiscal") == 2001)).select("key", "bid_type_name"),
                {"bid_type_name": ["State", "Commercial"]}),
            reshape.one_hot(bids(s, d).select("key", "bid_type_name"), {"bid_type_name": TYPE_NAMES})),
        over_bids(AWARDED, """t as (select key, first(bid_type_name order by sales_region_name nulls first,
            product_name nulls first, bid_type_name nulls first) filter (bid_type_name is not null) as t
          from awarded where fiscal = 2001 group by key)""", "select key, " + ", ".join(
            "cast(coalesce(t = 'State', false) as int)" + ' as "bid_type_name_State"' if n == "State"
            else f'cast(null as int) as "bid_type_name_{n}"' for n in TYPE_NAMES) + " from t"), []),
    "array_to_rows": (
        tree_prices, f"with {TREE_CTE} select key, cast(tree_id as int) as tree_id, price from tree_rows", ["price"]),
    "tree_price_matrix": (
        lambda s, d: trees.tree_price_columns(
            table(s, d, "embeddings").select(
                F.col("vec_id").cast("string").alias("key"), F.col("embedding").cast("array<double>").alias("tree_prices")),
            MATRIX_TREES),
        "select cast(vec_id as varchar) as key, " + ", ".join(
            f'cast(embedding[{i + 1}] as double) as "{i}"' for i in range(MATRIX_TREES)) + " from embeddings",
        [str(i) for i in range(MATRIX_TREES)]),
    "key_parts": (
        lambda s, d: bids(s, d).select("key").distinct().select("key", *columns.key_parts()),
        over_bids("""select distinct key, fiscal, destination_no as destination, bid_line_no as bidlineno from bids"""),
        []),
    "customer_product_parts": (
        lambda s, d: scorecard_keys(s, d).select("key", *columns.split_once("key", "Customer", "Product")),
        over_invoices("""select distinct key, cast(customer_bill_to_id as varchar) as "Customer",
          product_family as "Product" from invoices"""), []),
    "days_between": (
        lambda s, d: bids(s, d).groupBy("fiscal").agg(
            F.sum(F.datediff("expiry_date", "effective_date")).alias("days")),
        over_bids("""select fiscal, cast(sum(date_diff('day', effective_date, expiry_date)) as bigint) as days
          from bids group by fiscal"""), []),
    "daily_calendar": (
        lambda s, d: joins.with_calendar(
            table(s, d, "orders").select(F.year("o_orderdate").alias("fiscal")).distinct(),
            "2015-01-01", "2019-12-31", "day"),
        """select fiscal, cast(day as date) as day from (select distinct cast(year(o_orderdate) as int) as fiscal
          from orders), (select unnest(generate_series(date '2015-01-01', date '2019-12-31', interval 1 day)) as day)""",
        []),
}

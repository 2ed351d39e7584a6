"""The library's input tables, derived from the given test tables.

The view texts are valid in Spark SQL and DuckDB; `{name}` stands for a table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.plans.bids import intermediate_bids
from tenderlake.storage import materialize, tuned

RUN_YEAR = 2001
CALENDAR = ("1995-01-01", "2001-12-31")
CLUSTER_YEAR = 2000
SCORING_DATES = ("2000-01-01", "2001-12-31")
LOOKUP = {"fiscal": 1999, "destination": "H7", "bidlineno": 13}

OFFERS_SQL = """
select
  cast(year(o.o_orderdate) as int) as fiscal,
  concat('H', cast(c.c_nationkey as varchar(10))) as destination_no,
  p.p_size as bid_line_no,
  case when l.l_suppkey % 50 = 7 then null when l.l_suppkey % 6 = 0 then 'CMP'
       when l.l_suppkey % 6 = 1 then 'CS' when l.l_suppkey % 6 = 2 then 'MS'
       when l.l_suppkey % 6 = 3 then 'AM' when l.l_suppkey % 6 = 4 then 'DT' else 'NS' end as price_competitor_id,
  l.l_extendedprice / l.l_quantity as committed_price_ty,
  l.l_quantity - 1.0 as total_qty_ty,
  l.l_quantity * (1.0 - l.l_discount) as min_purchase_qty_ty,
  case when l.l_returnflag = 'R' then null else l.l_quantity * (1.0 + l.l_tax) end as max_supply_qty_ty,
  cast(p.p_size * 10 as double) as distance_ty,
  p.p_retailprice * 0.01 as stockpile_depot_cost_ty,
  p.p_retailprice * 0.02 as direct_transfer_depot_cost_ty,
  p.p_retailprice * l.l_tax as freight_cost_ty,
  p.p_retailprice * l.l_discount as fuel_surcharge_cost_ty,
  case when l.l_linenumber = 1 then null else cast(l.l_linenumber as double) * 1.5 end as equipment_cost_ty,
  p.p_retailprice * (0.03 + l.l_tax + l.l_discount) as committed_cost_ty,
  cast(o.o_orderdate as date) as bid_due_date,
  cast(least(o.o_orderdate, l.l_shipdate) as date) as effective_date,
  cast(greatest(o.o_orderdate, l.l_shipdate) as date) as expiry_date,
  l.l_linestatus = 'O' as rollover,
  r.r_name as sales_region_name,
  p.p_type as product_name,
  o.o_orderpriority as customer_type_name,
  case c.c_mktsegment when 'AUTOMOBILE' then 'Municipal' when 'BUILDING' then 'County'
       when 'FURNITURE' then 'State' when 'HOUSEHOLD' then 'Institutional' else 'Commercial' end as bid_type_name,
  case o.o_orderpriority when '1-URGENT' then concat('Emergency ', n.n_name)
       when '2-HIGH' then concat('Supplemental ', n.n_name)
       when '4-NOT SPECIFIED' then null else concat('Regular ', n.n_name) end as bid_name,
  o.o_orderkey as bid_no,
  c.c_custkey as customer_no,
  c.c_name as customer_name,
  n.n_name as destination_county_name,
  concat('ST', cast(o.o_orderkey as varchar(20))) as destination_state_prov,
  cast(c.c_custkey as varchar(20)) as destination_zip_postal
from {lineitem} l
join {orders} o on l.l_orderkey = o.o_orderkey
join {customer} c on o.o_custkey = c.c_custkey
join {part} p on l.l_partkey = p.p_partkey
join {nation} n on c.c_nationkey = n.n_nationkey
join {region} r on n.n_regionkey = r.r_regionkey
"""

UNSERVED_SQL = "select cast(c_custkey as varchar(20)) as destination_zip_postal from {customer} where c_acctbal < 0"

INVOICE_SQL = """
select
  100000 + o.o_custkey as customer_bill_to_id,
  l.l_partkey as product_no,
  p.p_brand as product_family,
  replace(p.p_brand, '#', '-') as family_code,
  p.p_type as horizontal,
  cast(l.l_shipdate as date) as billing_date,
  l.l_extendedprice * l.l_discount as inv_delivered_gp,
  l.l_quantity as quantity,
  c.c_mktsegment as uic_industry_group_name,
  concat(cast(100000 + o.o_custkey as varchar(20)), '_', p.p_brand) as key
from {lineitem} l
join {orders} o on l.l_orderkey = o.o_orderkey
join {customer} c on o.o_custkey = c.c_custkey
join {part} p on l.l_partkey = p.p_partkey
"""

SALES_ORDERS_SQL = """
select
  100000 + o.o_custkey as customer_bill_to_id,
  l.l_partkey as product_code,
  cast(o.o_orderdate as date) as order_entry_date,
  case o.o_orderstatus when 'F' then 'CLSD' when 'P' then 'CNCL' else 'OPEN' end as line_item_status
from {lineitem} l
join {orders} o on l.l_orderkey = o.o_orderkey
"""

PROGRAM_SQL = """
select distinct
  concat(cast(100000 + o.o_custkey as varchar(20)), '-01') as ship_to,
  case when l.l_suppkey % 10 = 3 then 'BRENNTAG Gulf' when l.l_suppkey % 10 = 4 then 'Nexeo West'
       when l.l_suppkey % 10 = 5 then null else s.s_name end as supplier_name
from {lineitem} l
join {orders} o on l.l_orderkey = o.o_orderkey
join {supplier} s on l.l_suppkey = s.s_suppkey
"""

CALLS_SQL = """
select 100000 + user_id as customer_bill_to_id, cast(ts as date) as call_date
from {events} where event_type = 'click'
"""

CASES_SQL = """
select
  100000 + user_id as customer_bill_to_id,
  event_id as case_number,
  case event_id % 5 when 0 then 'Assigned' when 1 then 'Draft' when 2 then 'Awaiting Investigator Assignment'
       when 3 then 'Under Investigation' else 'Closed' end as case_status,
  case event_id % 3 when 0 then 'Customer Complaint' when 1 then 'Internal Complaint' else 'Question' end
    as case_record_type
from {events} where event_type = 'error'
"""

CUSTOMER_MAP_SQL = """
select
  'LCD' as lob,
  cast(100000 + c.c_custkey as varchar(20)) as bill_to_key,
  r.r_name as region,
  n.n_name as district,
  concat('GM ', r.r_name) as general_manager,
  concat('SM ', n.n_name) as sales_manager,
  concat('Rep ', cast(c.c_custkey % 20 as varchar(4))) as seller,
  c.c_name as bill_to_name
from {customer} c
join {nation} n on c.c_nationkey = n.n_nationkey
join {region} r on n.n_regionkey = r.r_regionkey
union all
select
  'LCD', cast(100000 + c.c_custkey as varchar(20)), 'SECOND', 'SECOND', 'ZZ', 'ZZ', 'ZZ', c.c_name
from {customer} c
"""

PRODUCT_MAP_SQL = "select cast(p_partkey as varchar(20)) as product_key, p_name as product_name from {part}"

FAMILY_MAP_SQL = """
select distinct p_brand as product_family, replace(p_brand, '#', '-') as family_code, p_partkey as product_no from {part}
"""

SALES_HIERARCHY_SQL = """
select
  concat('Rep ', cast(s_suppkey % 20 as varchar(4))) as sales_rep,
  case s_suppkey % 3 when 0 then 'Food' when 1 then 'Pharma' else 'Coatings' end as industry,
  concat('Director ', cast(s_nationkey % 4 as varchar(4))) as director,
  concat('Manager ', cast(s_nationkey as varchar(4))) as sales_manager
from {supplier}
"""

IMPORTANCE_SQL = """
select p_brand as "Feature", concat(cast(sum(p_size) as varchar(12)), '%') as "Relative Importance"
from {part} group by p_brand
"""

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings"]
_WRITTEN: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tuned(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    used = {name: table(spark, sf_dir, name) for name in TABLES if "{" + name + "}" in text}
    return spark.sql(text.replace('"', "`"), **used)


def order_lines(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """The rows of a view of order lines, its tables joined in another order than its text names them.

    Orders meet their customers while they are fewer than the lines, and lines their parts, so the lines are
    shuffled twice at most and never with the columns of a customer. Column names have their table's letter
    in front, so the text's expressions hold for the joined rows as they are.
    """
    chosen, joins = text.split("from {lineitem} l")
    get = lambda name: table(spark, sf_dir, name)
    lines = get("lineitem").join(get("part"), F.col("l_partkey") == F.col("p_partkey"))
    orders = get("orders").join(get("customer"), F.col("o_custkey") == F.col("c_custkey"))
    if "{nation}" in joins:
        orders = orders.join(get("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        orders = orders.join(get("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return spark.sql(re.sub(r"\b[locpnr]\.", "", chosen) + "from {rows}", rows=rows)


def written(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A table built once per session and kept in the shared folder."""
    slot = (spark.sparkContext.applicationId, sf_dir, name)
    if slot not in _WRITTEN:
        _WRITTEN[slot] = materialize(build(), name, "zstd")
    return _WRITTEN[slot]


def raw_bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers with the award of their bid line: lowest price of a named competitor, smallest id."""
    offers = order_lines(spark, sf_dir, OFFERS_SQL)
    line = ["fiscal", "destination_no", "bid_line_no"]
    # Written first, so that Spark knows its size: the wide offers are only shuffled if it is large.
    awards = written(spark, sf_dir, "awards", lambda: (
        offers.where(F.col("price_competitor_id").isNotNull())
        .groupBy(*line)
        .agg(F.min(F.struct("committed_price_ty", "price_competitor_id")).alias("award"))
        .select(
            *line,
            F.col("award.committed_price_ty").alias("award_price_ty"),
            F.col("award.price_competitor_id").alias("award_competitor_id"),
        )
    ))
    return offers.join(awards, line)


def unserved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, UNSERVED_SQL)


def bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned bid table, written once; all features read it."""
    return written(
        spark, sf_dir, "bids", lambda: intermediate_bids(raw_bids(spark, sf_dir), unserved(spark, sf_dir))
    )


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The static key to cluster mapping, written once."""
    keys = bids(spark, sf_dir).where(F.col("bid_line_no") % 11 != 0)
    mapping = keys.select("key", (F.col("bid_line_no") % 7).alias("cluster")).distinct()
    return written(spark, sf_dir, "clusters", lambda: mapping)


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(spark, sf_dir, "invoices", lambda: order_lines(spark, sf_dir, INVOICE_SQL))


def scorecard_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(spark, sf_dir, "score-keys", lambda: _scorecard_keys(spark, sf_dir))


def _scorecard_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last date and day gaps between distinct billing dates; a key has at most one row per day.

    A key's days are a list, so keys are shuffled once and not once for every day.
    """
    days = invoices(spark, sf_dir).groupBy("key").agg(F.sort_array(F.collect_set("billing_date")).alias("days"))
    since = lambda day, at: F.struct(day.alias("billing_date"), F.datediff(day, F.get("days", at - 1)).alias("gap"))
    gaps = days.select("key", F.inline_outer(F.transform("days", since)))
    return gaps.groupBy("key").agg(
        F.max("billing_date").alias("last_trx_date"),
        F.avg("gap").alias("diff_mean"),
        F.try_divide(F.stddev_samp("gap"), F.lit(1.0)).alias("diff_std"),
    )


def churn_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score per key that needs no model."""
    customer = F.split("key", "_")[0].cast("long")
    return scorecard_keys(spark, sf_dir).withColumn("churn_prob", (customer * 7919 % 1000) / F.lit(1000.0))


def tree_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding elements standing for the prices of single trees."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("key"),
        F.posexplode("embedding").alias("tree_id", "price"),
    ).withColumn("price", F.col("price").cast("double"))

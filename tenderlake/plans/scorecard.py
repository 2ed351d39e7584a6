"""Churn scorecard: value at risk, order deviation, risk bands, drivers, enrichment, layouts.

Invoices are summed to (key, day), (customer, product) or (customer, day) before any join, so a
hot customer reaches the joins as a bounded number of rows.

Rules of our own, kept here so they can be replaced: the order risk labels and the order part of
the total risk (both from z, the order gap in standard deviations), and drivers as shares of the
summed positive contributions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.fixed_values import (
    BAND_UNAVAILABLE, CLOSED_ORDER_STATUSES, COMPLAINT_TYPES, INTRINSIC_CUT, OPEN_CASE_STATUSES,
    ORDER_RISK_CEILING, ORDER_RISK_CUTS, ORDER_RISK_LABELS, PROGRAM_SUPPLIERS, SCORECARD_SOURCE,
    TOP_DRIVERS, TOTAL_BANDS,
)
from tenderlake.functions.aggregates import top_by, total
from tenderlake.functions.columns import mentions, non_negative, ratio, split_once
from tenderlake.operators.joins import attach, membership, one_row_per, only_listed, splittable, unique_on, within_last_year
from tenderlake.operators.windows import band_label, top_columns
from tenderlake.storage import materialize


def value_at_risk(invoices: DataFrame, keys: DataFrame) -> DataFrame:
    """Profit of the last year up to each key's last transaction.

    Invoices meet their key as they are, and one shuffle serves the join and the sums; summing them to days
    before would take another for rows that are hardly fewer. AQE splits a hot key.
    """
    recent = within_last_year(
        invoices.select("key", "billing_date", "inv_delivered_gp"),
        splittable(keys.select("key", "last_trx_date", "diff_mean", "diff_std"), ["key"]), "billing_date", "last_trx_date",
    )
    return recent.groupBy("key").agg(
        F.max("last_trx_date").alias("last_trx_date"),
        F.max("diff_mean").alias("diff_mean"),
        F.max("diff_std").alias("diff_std"),
        F.sum("inv_delivered_gp").alias("value_at_risk"),
    )


def _order_z() -> Column:
    return ratio(F.col("order_diff") - F.col("diff_mean"), "diff_std")


def order_risk() -> Column:
    """How far the gap since the last order is beyond the usual gap."""
    past, due = ORDER_RISK_CUTS
    worst, middle, normal = ORDER_RISK_LABELS
    z = _order_z()
    return F.when(z > past, worst).when(z > due, middle).otherwise(normal)


def total_risk() -> Column:
    """Churn probability plus the order part: z held to 0..ceiling, scaled to 0..1; unknown z is 0."""
    held = F.least(F.greatest(_order_z(), F.lit(0.0)), F.lit(ORDER_RISK_CEILING))
    return F.col("churn_prob") + held / F.lit(ORDER_RISK_CEILING)


def with_order_risk(scored: DataFrame, reference_date) -> DataFrame:
    """`reference_date` is a date or a one-value DataFrame holding the last transaction date."""
    if isinstance(reference_date, DataFrame):
        reference_date = F.date_add(reference_date.scalar(), 1)
    else:
        reference_date = F.lit(reference_date).cast("date")
    return (
        scored.withColumn("order_ref_date", reference_date)
        .withColumn("order_diff", F.datediff("order_ref_date", "last_trx_date"))
        .withColumn("Order deviation risk", order_risk())
        .withColumn("churn_risk", total_risk())
    )


def with_risk_bands(scored: DataFrame, scored_rows: int | None = None, key: str = "key") -> DataFrame:
    """Total churn risk band per row.

    Rows whose churn probability is at most 0.3 of the total risk are "Unavailable"; the others
    are banded by rank. Rows without a ratio are in neither part. Only key and scores are written, for
    finding the cuts; labels are an expression on the rows themselves.
    """
    slim = materialize(scored.select(key, "churn_prob", "churn_risk"), "scores")
    return _banded(scored, slim, scored_rows, key)


def _banded(scored: DataFrame, slim: DataFrame, scored_rows: int | None, key: str) -> DataFrame:
    """`scored` with its band; `slim` holds key and scores of the same rows, written."""
    share = ratio("churn_prob", "churn_risk")
    rows = slim.count() if scored_rows is None else scored_rows
    label = band_label(slim.where(share > INTRINSIC_CUT), "churn_risk", key, rows)
    band = F.when(share > INTRINSIC_CUT, label).otherwise(F.lit(BAND_UNAVAILABLE))
    return scored.where(share.isNotNull()).withColumn("Total churn risk", band)


def feature_classes(features: Sequence[str], classes: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
    """(class, feature) for every class variable that occurs in the feature's name."""
    return [(c, f) for c, variable in classes for f in features if variable.strip() in f]


def class_sums(contributions: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per key: its positive contributions summed in a column per driver class.

    `pairs` comes from the model's column list, so the mapping is as small as that list. Every
    key gets every class, with zero where nothing contributes.
    """
    by_class: dict[str, list[str]] = {}
    for name, feature in pairs:
        by_class.setdefault(name, []).append(feature)
    value = non_negative("contribution")
    sums = [
        F.sum(sum((F.when(F.col("feature") == f, value).otherwise(0.0) for f in features), F.lit(0.0))).alias(name)
        for name, features in by_class.items()
    ]
    wide = contributions.groupBy("key").agg(*sums)
    return wide.select("key", *[F.coalesce(f"`{c}`", F.lit(0.0)).alias(c) for c in by_class])


def class_contributions(contributions: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """The sums of `class_sums` as rows of key, class and contribution."""
    wide = class_sums(contributions, pairs)
    return wide.unpivot("key", [c for c in wide.columns if c != "key"], "class", "contribution")


def top_drivers(contributions: DataFrame, pairs: Sequence[tuple[str, str]], n: int = TOP_DRIVERS) -> DataFrame:
    """The n driver classes with the largest share per key, ranked within the key's row."""
    return top_columns(class_sums(contributions, pairs), "key", n, "Top Driver ")


def top_products(invoices: DataFrame, customers: DataFrame | None, since) -> DataFrame:
    """Per customer and product family the product with the highest profit, plus the family's horizontal.

    `customers` limits the customers, after the sums and so on few rows.
    """
    recent = invoices.where(F.col("billing_date") >= F.lit(since).cast("date"))
    sums = recent.groupBy("customer_bill_to_id", "product_family", "product_no").agg(
        F.max("horizontal").alias("horizontal"), F.sum("inv_delivered_gp").alias("profit")
    )
    if customers is not None:
        sums = only_listed(sums, customers, ["customer_bill_to_id"])
    top = sums.groupBy("customer_bill_to_id", "product_family").agg(
        top_by("product_no", "profit").alias("top_product"), F.max("profit").alias("top_profit")
    ).where(F.col("top_profit").isNotNull())
    rows = recent if customers is None else sums
    horizontals = materialize(rows.groupBy("product_family").agg(F.max("horizontal").alias("Horizontal")), "horizontals")
    # A row per family, written so that Spark knows how few they are; a family may hold a third of the rows.
    return top.join(horizontals, "product_family", "left").select(
        F.col("customer_bill_to_id").cast("string").alias("Customer"),
        F.col("product_family").alias("Product"),
        "Horizontal",
        F.col("top_product").cast("string").alias("Top Product"),
        "top_profit",
    )


def open_orders(orders: DataFrame, products: DataFrame, start, end, match: str = "product") -> DataFrame:
    """Customers and family codes with an open line at the latest order date within the dates.

    `match="product"` uses the latest date of the customer's product; `match="customer"` accepts a
    line dated like the latest order of any of the customer's products.
    """
    open_line = ~F.col("line_item_status").isin(CLOSED_ORDER_STATUSES)
    if match == "product":
        # The largest pair of date and flag: the last date, and whether any of its lines is open.
        last = orders.groupBy("customer_bill_to_id", "product_code").agg(
            F.max(F.struct("order_entry_date", open_line.alias("open"))).alias("_last")
        )
        lines = last.select("customer_bill_to_id", "product_code", "_last.*")
    else:
        days = orders.groupBy("customer_bill_to_id", "product_code", "order_entry_date").agg(F.max(open_line).alias("open"))
        dates = days.groupBy("customer_bill_to_id", "product_code").agg(F.max("order_entry_date").alias("order_entry_date"))
        dates = dates.select("customer_bill_to_id", "order_entry_date").distinct()
        lines = only_listed(days, dates, ["customer_bill_to_id", "order_entry_date"])
    lines = lines.where(
        F.col("open") & F.col("order_entry_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    ).select("customer_bill_to_id", "product_code").distinct()
    codes = products.select(F.col("product_no").alias("product_code"), "family_code").distinct()
    return lines.join(codes, "product_code", "left").select(
        F.col("customer_bill_to_id").cast("string").alias("Customer"),
        F.replace("family_code", F.lit("-"), F.lit("_")).alias("family_code"),
    ).distinct()


def program_customers(program: DataFrame, text: str) -> DataFrame:
    """Customers (first six characters of the ship-to) of suppliers whose name mentions the text."""
    filled = program.fillna("0", ["ship_to", "supplier_name"])
    return filled.where(mentions("supplier_name", text)).select(
        F.substring("ship_to", 1, 6).alias("Customer")
    ).distinct()


def program_flags(program: DataFrame) -> DataFrame:
    """Per customer of the program whether it buys from each named supplier, in one pass."""
    filled = program.fillna("0", ["ship_to", "supplier_name"])
    flags = [
        F.when(F.max(mentions("supplier_name", text)), "Yes").otherwise(" ").alias(column)
        for column, text in PROGRAM_SUPPLIERS.items()
    ]
    return filled.groupBy(F.substring("ship_to", 1, 6).alias("Customer")).agg(*flags)


def customer_industry(invoices: DataFrame) -> DataFrame:
    """Industry at the customer's last billing date, the smallest name on ties."""
    day, industry = F.col("billing_date"), F.col("uic_industry_group_name")
    # The smallest is of the last day; missing days and names come after all others.
    first = F.struct(day.isNull(), -F.unix_date(day), industry.isNull(), industry.alias("industry"))
    latest = invoices.groupBy("customer_bill_to_id").agg(F.min(first).alias("_last"))
    return latest.select(
        F.col("customer_bill_to_id").cast("string").alias("Customer"), F.col("_last.industry").alias("Industry")
    )


def last_calls(calls: DataFrame) -> DataFrame:
    return calls.groupBy(F.col("customer_bill_to_id").cast("string").alias("Customer")).agg(
        F.max("call_date").alias("last_call_date")
    )


def open_cases(cases: DataFrame) -> DataFrame:
    wanted = cases.where(
        F.col("case_status").isin(OPEN_CASE_STATUSES) & F.col("case_record_type").isin(COMPLAINT_TYPES)
    )
    return wanted.groupBy(F.col("customer_bill_to_id").cast("string").alias("Customer")).agg(
        F.count_distinct("case_number").alias("open_cases")
    )


def customer_attributes(mapping: DataFrame) -> DataFrame:
    """One row per customer and line of business: the first by region, district and so on."""
    columns = ["lob", "bill_to_key", "region", "district", "general_manager", "sales_manager", "seller", "bill_to_name"]
    return one_row_per(mapping.select(*columns).distinct(), ["bill_to_key", "lob"], [])


@dataclass
class ScorecardInputs:
    """Tables the scorecard reads; `scores` holds key and churn_prob, `drivers` key and top drivers.

    `invoices` are those of the scored customers; `history`, if given, is the full invoice table that top
    products and industries come from.
    """

    scores: DataFrame
    score_keys: DataFrame
    drivers: DataFrame
    invoices: DataFrame
    orders: DataFrame
    products: DataFrame
    customer_map: DataFrame
    product_names: DataFrame
    program: DataFrame
    calls: DataFrame
    cases: DataFrame
    history: DataFrame | None = None


DRIVER_COLUMNS = [f"Top Driver {i}" for i in range(1, TOP_DRIVERS + 1)]


def customer_table(inputs: ScorecardInputs, scored: DataFrame, lob: str) -> DataFrame:
    """One row per scored customer: total value, sales attributes, program flags, service record.

    `scored` holds the customer and value at risk of every scored key. All parts are grouped by customer, so the joins here share one partitioning and the scored
    rows meet a single customer-level table.
    """
    totals = scored.groupBy("Customer").agg(total("value_at_risk").alias("Annual customer iDGP at risk"))
    attributes = customer_attributes(inputs.customer_map.where(F.col("lob") == lob)).select(
        F.col("bill_to_key").alias("Customer"), F.col("region").alias("Region"),
        F.col("district").alias("District"), F.col("general_manager").alias("General Manager"),
        F.col("sales_manager").alias("Sales Manager"), F.col("seller").alias("Seller"),
        F.col("bill_to_name").alias("Customer Name"),
    )
    history = inputs.invoices if inputs.history is None else inputs.history
    parts = [
        attributes, program_flags(inputs.program), customer_industry(history), last_calls(inputs.calls),
        open_cases(inputs.cases),
    ]
    table = totals
    for part in parts:
        table = attach(table, part, ["Customer"], check=False)
    return table.fillna(" ", list(PROGRAM_SUPPLIERS))


def of_keys(rows: DataFrame) -> DataFrame:
    """Rows of a customer and product as rows of their key; a customer with an underscore has no key."""
    key = F.concat("Customer", F.lit("_"), "Product")
    return rows.where(~F.contains("Customer", F.lit("_"))).withColumn("key", key).drop("Customer", "Product")


def open_keys(orders: DataFrame, families: DataFrame) -> DataFrame:
    """Keys of customers and families with an open order; codes are compared with dashes as underscores on both sides."""
    code = F.replace("Product Family Code", F.lit("-"), F.lit("_"))
    return of_keys(orders.join(families.select("Product", code.alias("family_code")), "family_code").drop("family_code"))


def scorecard(inputs: ScorecardInputs, lob: str, products_since, order_start, order_end) -> DataFrame:
    """One row per scored key with risk, value, product, sales and service details."""
    lob = lob.upper()
    # Read by the cuts, the customer totals and the card. Columns that follow from others are added where they are read.
    # Values of keys without a score count for the last date only; value and scores are written as one table.
    value = value_at_risk(inputs.invoices, inputs.score_keys).withColumnRenamed("key", "_key")
    scores = inputs.scores.select("key", "churn_prob", F.lit(True).alias("_scored"))
    met = materialize(scores.join(value, F.col("key") == F.col("_key"), "full").drop("_key"), "scores", "zstd")
    last = met.agg(F.max("last_trx_date"))
    scored = met.where("_scored").drop("_scored")
    customer, product = split_once("key", "Customer", "Product")

    # What belongs to a key is joined by the key: the rows are shuffled for it once, while they are few columns.
    families = inputs.products.select(
        F.col("product_family").alias("Product"), F.col("family_code").alias("Product Family Code")
    ).dropna().distinct()
    families = materialize(unique_on(families, ["Product"]), "families")
    base = scored.join(inputs.drivers, "key", "left")
    history = inputs.invoices if inputs.history is None else inputs.history
    customers = None if inputs.history is None else inputs.invoices.select("customer_bill_to_id").distinct()
    top = top_products(history, customers, products_since).drop("top_profit")
    names = inputs.product_names.select(
        F.col("product_key").cast("string").alias("Top Product"), F.col("product_name").alias("Top Product Name")
    ).distinct()
    base = attach(base, of_keys(attach(top, names, ["Top Product"], hot=True)), ["key"], check=False)
    orders = open_orders(inputs.orders, inputs.products, order_start, order_end)
    base = membership(base, open_keys(orders, families), ["key"], "Open Order Flag", "Yes", "No")
    totals = scored.select(customer, "value_at_risk")
    base = attach(base.withColumn("Customer", customer), customer_table(inputs, totals, lob), ["Customer"], check=False, hot=True)

    slim = with_order_risk(scored, last).select("key", "churn_prob", "churn_risk")
    base = _banded(with_order_risk(base, last), slim, None, "key").withColumn("LOB", F.lit(lob))
    # Families are few; a key without a top product has product "0" and its name, if there is one.
    base = attach(base.withColumn("Product", product), families, ["Product"], check=False, hot=True)
    unnamed = names.where(F.col("Top Product") == "0").agg(F.max("Top Product Name")).scalar()
    base = base.withColumn("Top Product Name", F.when(F.col("Top Product").isNull(), unnamed).otherwise(F.col("Top Product Name")))
    base = base.withColumn("Top Product", F.coalesce("Top Product", F.lit("0")))
    return base.select(
        "key", F.lit(SCORECARD_SOURCE).alias("AI_Source"), "LOB", "Region", "District", "General Manager",
        "Sales Manager", "Seller", "Customer", "Customer Name", "`Product Family Code`", "Horizontal",
        F.col("Product").alias("Product Family"), "Top Product", "Top Product Name", "Total churn risk",
        F.col("value_at_risk").alias("Annual product iDGP at risk"), "Annual customer iDGP at risk",
        F.col("last_trx_date").alias("Last Transaction Date"), "Open Order Flag",
        F.col("diff_mean").alias("Avg. days between orders"),
        F.col("order_diff").alias("Days since last transaction"),
        *PROGRAM_SUPPLIERS, "Order deviation risk", "churn_prob", "churn_risk",
        "Industry", "last_call_date", "open_cases", *DRIVER_COLUMNS,
    )


RISK_COLUMNS = [
    "Total churn risk", "Annual product iDGP at risk", "Annual customer iDGP at risk", "Last Transaction Date",
    "Open Order Flag", "Avg. days between orders", "Days since last transaction", "Brenntag CPP", "Nexeo CPP",
    "Order deviation risk",
]
SALES_COLUMNS = {
    "lcd": ["LOB", "Region", "District", "General Manager", "Sales Manager", "Seller", "Customer", "Customer Name"],
    "fi": ["LOB", "Region", "Industry", "General Manager", "Sales Manager", "Seller", "Customer", "Customer Name"],
}
HIERARCHY_COLUMNS = ["Industry", "Director", "Sales Manager", "Seller", "Customer", "Customer Name"]
PRODUCT_COLUMNS = ["Product Family", "Top Product", "Top Product Name"]


def layouts(card: DataFrame, lob: str, hierarchy: DataFrame | None = None) -> dict[str, DataFrame]:
    """The three outputs of a line of business: full, field and dashboard.

    `fi` takes industry, director and sales manager of the field and dashboard outputs from the
    sales hierarchy, one row per sales rep.
    """
    full = ["AI_Source", *SALES_COLUMNS[lob], "Horizontal", "Product Family Code", *PRODUCT_COLUMNS,
            *RISK_COLUMNS, "churn_prob", "churn_risk", "open_cases", "last_call_date", *DRIVER_COLUMNS]
    head = ["AI_Source", *SALES_COLUMNS["lcd"]]
    sold = card
    if lob == "fi":
        reps = one_row_per(hierarchy.select("sales_rep", "industry", "director", "sales_manager"), ["sales_rep"], [])
        sold = attach(
            card.drop("LOB", "Region", "District", "General Manager", "Sales Manager", "Industry"),
            reps.toDF("Seller", "Industry", "Director", "Sales Manager"), ["Seller"], check=False, hot=True,
        )
        head = ["AI_Source", *HIERARCHY_COLUMNS]
    field = [*head, "Horizontal", *PRODUCT_COLUMNS, *RISK_COLUMNS, *DRIVER_COLUMNS]
    dashboard = [*head, "Product Family Code", "Horizontal", *PRODUCT_COLUMNS, *RISK_COLUMNS, *DRIVER_COLUMNS]
    pick = lambda df, names: df.select(*[F.col(f"`{n}`") for n in names])
    return {"full": pick(card, full), "field": pick(sold, field), "dashboard": pick(sold, dashboard)}


def risk_summary(card: DataFrame) -> DataFrame:
    """Mean, least and highest churn probability per band, and the value in the bands acted on."""
    value = F.col("Annual product iDGP at risk")
    return card.groupBy("Total churn risk").agg(
        F.avg("churn_prob").alias("mean_churn_prob"),
        F.min("churn_prob").alias("min_churn_prob"),
        F.max("churn_prob").alias("max_churn_prob"),
        F.coalesce(F.sum(F.when(F.col("Total churn risk").isin(TOTAL_BANDS), value)), F.lit(0.0)).alias("value_at_risk"),
    )

"""Queries of the churn plan: snapshots, the split of customers, and what must hold of every score."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tenderlake.plans import churn, trees
from tenderlake.storage import new_path
from workload.sqltext import over_invoices
from workload.views import invoices, written

SNAPSHOT_DATE = date(1997, 6, 30)
TREES, DEPTH = 50, 5


def snapshot_sql(as_of: str, target: bool) -> str:
    days = f"{churn.YEAR} days" if target else "0 days"
    followed = f"(select max(1.0) from invoices f where f.key = s.key and f.billing_date > {as_of} and f.billing_date <= {as_of} + interval '{days}')"
    return f"""
daily as (select key, billing_date, sum(inv_delivered_gp) as profit, sum(quantity) as quantity, count(*) as lines,
    sum(inv_delivered_gp / quantity) as price, count(inv_delivered_gp / quantity) as priced,
    min(uic_industry_group_name) as segment
  from invoices where billing_date <= {as_of} group by key, billing_date),
spaced as (select *, billing_date - lag(billing_date) over (partition by key order by billing_date) as gap from daily),
snapshot as (select s.key, {f"1.0 - coalesce({followed}, 0.0) as target, " if target else ""}
    cast(cast({as_of} as date) - max(billing_date) as double) as days_since, sum(profit) as profit,
    coalesce(sum(profit) filter (billing_date > {as_of} - interval '{churn.YEAR} days'), 0) as profit_last_year,
    sum(quantity) as quantity,
    coalesce(sum(quantity) filter (billing_date > {as_of} - interval '{churn.YEAR} days'), 0) as quantity_last_year,
    cast(sum(lines) as double) as lines, sum(price) / nullif(sum(priced), 0) as price_level,
    avg(gap) as gap_mean, stddev_samp(gap) as gap_std, min(segment) as segment
  from spaced s group by s.key)
"""


PAST = snapshot_sql(f"date '{SNAPSHOT_DATE}'", True)
FOLD = f"cast('0x' || substr(md5(split_part(key, '_', 1)), 1, 8) as bigint) % {churn.FOLDS}"
DOUBLES = ["target", "days_since", "profit", "profit_last_year", "quantity", "quantity_last_year", "lines", "price_level", "gap_mean", "gap_std"]


def past(s, d):
    return written(s, d, "churn-past", lambda: churn.snapshot(invoices(s, d), SNAPSHOT_DATE, churn.YEAR))


def today(s, d):
    """The snapshot on the last day of the data."""
    last = invoices(s, d).agg(F.max("billing_date")).first()[0]
    return written(s, d, "churn-today", lambda: churn.snapshot(invoices(s, d), last))


_KEPT: dict[tuple, churn.ChurnBundle] = {}


def kept(s, d, boosted=False):
    """A bundle that was fitted, saved and loaded again."""
    slot = (s.sparkContext.applicationId, d, boosted)
    if slot not in _KEPT:
        folder = new_path(s, "churn-bundle")
        count, depth = (20, 3) if boosted else (TREES, DEPTH)
        churn.save(churn.fit(past(s, d), date(2001, 1, 15), SNAPSHOT_DATE, count, depth, boosted), s, folder)
        _KEPT[slot] = churn.load(s, folder, date(2001, 1, 15))
    return _KEPT[slot]


def held_out(s, d):
    return churn.apply(kept(s, d), past(s, d).where(churn.customer_fold() == 0))


def held_out_checks(s, d):
    """Rows judged, scores out of range, and customers that were also fitted on."""
    scored = held_out(s, d).select("key", "target", "churn_prob")
    customer = F.split("key", "_")[0].alias("customer")
    fitted = past(s, d).where(churn.customer_fold() != 0).select(customer).distinct()
    both = scored.select(customer).distinct().join(fitted, "customer").agg(F.count("*").alias("customers_in_both"))
    checks = scored.agg(
        F.count("*").alias("rows"), F.count_distinct("key").alias("keys"),
        F.count_if(F.col("churn_prob").isNull() | ~F.col("churn_prob").between(0.0, 1.0)).alias("out_of_range"),
    )
    return checks.withColumn("customers_in_both", both.scalar())


def scored_today(s, d):
    return written(s, d, "churn-scored", lambda: churn.apply(kept(s, d), today(s, d)))


def score_checks(s, d):
    """Keys scored today and scores out of range; the saved model loads with all its columns."""
    # Only scores are asked for: leaves and vectors of all rows are neither computed nor written.
    return churn.apply(kept(s, d), today(s, d)).select("key", "churn_prob").agg(
        F.count_distinct("key").alias("keys"),
        F.count_if(F.col("churn_prob").isNull() | ~F.col("churn_prob").between(0.0, 1.0)).alias("out_of_range"),
        F.lit(len(kept(s, d).columns)).alias("columns"),
    )


def sums_of_contributions(s, d, boosted=False):
    """Keys, and keys whose contributions do not add up to the score (to the margin, if boosted)."""
    bundle = kept(s, d, boosted)
    scored = scored_today(s, d) if not boosted else written(s, d, "churn-scored-boosted", lambda: churn.apply(bundle, today(s, d)))
    model = bundle.model.stages[-1]
    root = trees.root_value(trees.node_table(model, s), trees.tree_weights(model))
    added = churn.explained(bundle, scored).groupBy("key").agg(F.sum("contribution").alias("added"))
    met = scored.join(added, "key", "left")
    total = F.coalesce("added", F.lit(0.0)) + F.lit(root)
    # A boosted classifier's probability is that of twice its margin.
    reached = 1 / (1 + F.exp(-2 * total)) if boosted else total
    return met.agg(F.count("*").alias("keys"), F.count_if(F.abs(reached - F.col("churn_prob")) > 1e-9).alias("apart"))


def driver_checks(s, d):
    """Keys with drivers, and how many of them name one driver twice."""
    top = churn.drivers(kept(s, d), scored_today(s, d))
    names = F.array_compact(F.array(*[F.col(f"`{c}`") for c in top.columns if c.startswith("Top Driver")]))
    return top.agg(F.count("*").alias("keys"), F.count_if(F.size(names) > F.size(F.array_distinct(names))).alias("repeated"))


KEYS = "select count(distinct key) as keys"
QUERIES = {
    "churn_snapshot": (past, over_invoices(PAST, "select * from snapshot"), DOUBLES),
    "churn_snapshot_today": (
        today,
        over_invoices("last_day as (select max(billing_date) as d from invoices)", snapshot_sql("(select d from last_day)", False), "select * from snapshot"),
        DOUBLES[1:],
    ),
    "churn_folds": (
        lambda s, d: past(s, d).groupBy(churn.customer_fold().alias("fold"), "target").agg(
            F.count("*").alias("rows"), F.count_distinct(F.split("key", "_")[0]).alias("customers")
        ),
        over_invoices(PAST, f"""select cast({FOLD} as integer) as fold, target, count(*) as rows,
          count(distinct split_part(key, '_', 1)) as customers from snapshot group by all"""),
        ["target"],
    ),
    "churn_held_out_checks": (
        held_out_checks,
        over_invoices(PAST, f"""select count(*) as rows, count(distinct key) as keys, cast(0 as bigint) as out_of_range,
          cast(0 as bigint) as customers_in_both from snapshot where {FOLD} = 0"""),
        [],
    ),
    "churn_score_checks": (
        score_checks,
        over_invoices(f"{KEYS}, cast(0 as bigint) as out_of_range, {len(DOUBLES)} as columns from invoices"),
        [],
    ),
    "churn_contribution_sums": (
        sums_of_contributions, over_invoices(f"{KEYS}, cast(0 as bigint) as apart from invoices"), [],
    ),
    "churn_margin_sums": (
        lambda s, d: sums_of_contributions(s, d, True), over_invoices(f"{KEYS}, cast(0 as bigint) as apart from invoices"), [],
    ),
    "churn_driver_checks": (
        driver_checks, over_invoices(f"{KEYS}, cast(0 as bigint) as repeated from invoices"), [],
    ),
    "churn_held_out_quality": (lambda s, d: churn.quality(held_out(s, d)), None, []),
}

"""Shared parts of the comparison SQL."""

from __future__ import annotations

from workload import views


def bare(text: str) -> str:
    """A view text with the plain table names DuckDB knows."""
    for name in views.TABLES:
        text = text.replace("{" + name + "}", name)
    return text


RAW_CTES = f"""
offers as ({bare(views.OFFERS_SQL)}),
lowest as (
  select fiscal, destination_no, bid_line_no, min(committed_price_ty) as award_price_ty
  from offers where price_competitor_id is not null group by all),
awards as (
  select o.fiscal, o.destination_no, o.bid_line_no, l.award_price_ty,
         min(o.price_competitor_id) as award_competitor_id
  from offers o join lowest l
    on o.fiscal = l.fiscal and o.destination_no = l.destination_no and o.bid_line_no = l.bid_line_no
   and o.committed_price_ty = l.award_price_ty
  where o.price_competitor_id is not null group by all),
raw as (select * from offers join awards using (fiscal, destination_no, bid_line_no))
"""

BID_CTES = RAW_CTES + f""",
unserved as ({bare(views.UNSERVED_SQL)}),
bids as materialized (
  select *, concat(cast(fiscal as varchar), '_', destination_no, '_', cast(bid_line_no as varchar)) as key
  from raw
  where bid_type_name in ('Municipal', 'County', 'State', 'Institutional', 'Govt Tendered')
    and award_price_ty < 5000
    and destination_zip_postal not in (select destination_zip_postal from unserved))
"""

CLUSTER_CTE = """
clusters as (select distinct key, bid_line_no % 7 as cluster from bids where bid_line_no % 11 <> 0)
"""

INVOICE_CTE = f"invoices as materialized ({bare(views.INVOICE_SQL)})"

KEYS_CTE = """
days as (select distinct key, billing_date from invoices),
gaps as (select key, billing_date,
  billing_date - lag(billing_date) over (partition by key order by billing_date) as gap from days),
score_keys as (select key, max(billing_date) as last_trx_date, avg(gap) as diff_mean, stddev_samp(gap) as diff_std
  from gaps group by key)
"""


def over_raw(*parts: str) -> str:
    return _joined(RAW_CTES, *parts)


def over_bids(*parts: str) -> str:
    return _joined(BID_CTES, *parts)


def over_invoices(*parts: str) -> str:
    return _joined(INVOICE_CTE, *parts)


def _joined(*parts: str) -> str:
    """Named parts, then the final select."""
    *named, last = parts
    return "with " + ", ".join(p.strip() for p in named) + "\n" + last

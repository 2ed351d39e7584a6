"""Values the results depend on."""

# Ids, lists, cuts, labels and formats that must stay as they are
# for the results to come out right.

HOUSE_ID = "CMP"
RIVAL_FLAG_IDS = {"Is_cargill_nbc": "CS", "Is_KplusS_nbc": "MS"}

SERVED_BID_TYPES = ["Municipal", "County", "State", "Institutional", "Govt Tendered"]
AWARD_PRICE_LIMIT = 5000
CAPACITY_FACTOR = 1.25
FILL_RATE_CALENDAR = ("2015-01-01", "2019-12-31")

SCORECARD_SHARE = 0.042
BAND_CUTS = [0.10, 0.30, 0.60, 1.0]
BAND_LABELS = ["Very High", "High", "Medium", "Low", "Very Low"]
BAND_UNAVAILABLE = "Unavailable"
TOTAL_BANDS = ["Very High", "High", "Medium"]
INTRINSIC_CUT = 0.3
ORDER_RISK_LABELS = ["Well past due", "Past due", "Within order pattern"]
ORDER_RISK_CUTS = [1.5, 1.0]
ORDER_RISK_CEILING = 2.0
TOP_DRIVERS = 5

CLOSED_ORDER_STATUSES = ["CNCL", "CLSD"]
OPEN_CASE_STATUSES = [
    "Assigned",
    "Draft",
    "Awaiting Investigator Assignment",
    "Under Investigation",
]
COMPLAINT_TYPES = [
    "Customer Complaint",
    "Customer Complaint Assigned",
    "Internal Complaint",
    "Internal Complaint Assigned",
]
PROGRAM_SUPPLIERS = {"Brenntag CPP": "brenntag", "Nexeo CPP": "nexeo"}
SCORECARD_SOURCE = "Churn Prevention"

CATEGORY_AVERAGE = "Proposed (Average)"
CATEGORY_LOW = "Conservative (2.5th Percentile)"
CATEGORY_HIGH = "Ambitious (97.5th Percentile)"
PERFORMANCE_HIGH = "Net Price vs. Market"
PERFORMANCE_LOW = "Gap to next best"

REFERENCE_DETAILS = [
    "key", "fiscal", "destination_no", "bid_line_no", "customer_no", "customer_name",
    "destination_county_name", "destination_state_prov", "bid_due_date", "total_qty_ty",
    "award_price_ty", "award_competitor_id",
]
REFERENCE_NAMES = {
    "key": "key",
    "fiscal": "fiscal",
    "destination_no": "destination_no",
    "bid_line_no": "bid_line_no",
    "Cluster": "Cluster",
    "customer_name": "Customer Name",
    "city_state": "City & State",
    "destination_county_name": "City",
    "destination_state_prov": "State",
    "total_qty_ty": "Volume (K Tons)",
    "bid_due_date": "Date",
    "cmp_won_bid": "CMP Won Bid",
    "cmp_price": "CMP Bid Price",
    "top_competitor_id": "Top Competitor",
    "top_competitor_price": "Top Competitor Bid Price",
    "last_yr_award_price": "Bid Price Last Year",
    "delta_awardprice_lastyr": "Delta YoY AwardPrice",
    "incumbent": "Incumbent",
}
PEER_COLUMNS = [
    "Customer Name", "City & State", "Volume (K Tons)", "Date", "CMP Won Bid", "CMP Bid Price",
    "Top Competitor", "Top Competitor Bid Price", "Bid Price Last Year", "Delta YoY AwardPrice", "Incumbent",
]

INT_COLUMNS = [
    "bid_line_id", "bid_line_dest_id", "customer_id", "destination_id", "fiscal",
    "bid_no", "bid_line_no", "depot_no", "producer_id", "product_id",
]
DATE_COLUMNS = ["bid_due_date", "effective_date", "expiry_date", "opening_date"]
TEXT_COLUMNS = [
    "currency_uom", "distance_uom", "weight_uom", "price_competitor_name",
    "sales_region_name", "bid_name", "bid_type_name", "destination_no",
    "customer_name", "customer_county_name", "customer_state_prov",
    "customer_type_name", "destination_name", "destination_county_name",
    "destination_state_prov", "request_method", "depot_name", "producer_name",
    "product_name", "award_competitor_name", "customer_no", "award_competitor_id",
    "price_competitor_id", "destination_zip_postal",
]
NUMBER_COLUMNS = [
    "total_qty_ty", "total_ef_qty_ty", "min_purchase_qty_ty", "max_supply_qty_ty",
    "distance_ty", "stockpile_depot_cost_ty", "direct_transfer_depot_cost_ty",
    "freight_cost_ty", "fuel_surcharge_cost_ty", "equipment_cost_ty",
    "committed_cost_ty", "committed_price_ty", "committed_mr_ty",
    "committed_margin_ty", "award_price_ty", "award_mr_ty", "award_margin_ty",
    "shipment_qty_ty",
]
FLAG_COLUMNS = ["multi_year", "rollover", "cmp_costs_yn"]
CSV_TIMESTAMP_FORMATS = ["d/M/yyyy H:m:s", "d/MMM/yyyy H:m:s"]
# End of fixed values.

"""Fixed values the operators must agree on. Dates and numbers are business parameters, not tuning."""

# Promotion kinds, in the order of their source columns.
PROMOTION_LABELS = {
    "label_001": "prom0",
    "label_002": "prom1",
    "label_003": "prom2",
    "label_004": "prom3",
    "label_005": "prom4",
    "label_006": "prom5",
    "label_007": "prom6",
    "label_008": "prom7",
}
PROMOTION_KINDS = list(PROMOTION_LABELS.values())
PROMOTION_FLAGS = [*PROMOTION_KINDS, "is_vip", "free_gift"]

# The offer columns kept at ingest.
OFFER_PRICES = ["unit_price", "required_num", "amount", "prom_price", "retail_price"]
OFFER_COLUMNS = [
    "item", "offer_code", "offer_start_date", "offer_end_date", "osd_type", "outputs",
    *PROMOTION_FLAGS, *OFFER_PRICES, "flag",
]

# Spelling corrections of store attributes (simultaneous, never chained).
LOCATION_TYPE_MAP = {
    "Inmall": "inmall",
    "Inline+inmall": "inline+inmall",
    "Inmall+Inline": "inline+inmall",
    "Inmall+inline": "inline+inmall",
    "inmall+inline": "inline+inmall",
    "Inline": "inline",
    "Inline+Inmall": "inline+inmall",
    " Inline+inmall": "inline+inmall",
}
FLOOR_TYPE_MAP = {
    "G/F+2/F": "G/F+1/F",
    "G/F+4/F": "G/F+1/F",
    "G/F+B/2": "B/1+G/F",
    "1/F+B/2": "1/F",
    "2/F+B/3": "2/F",
    "B1/F": "B1",
    "G/F+B/1": "B/1+G/F",
    "B1": "B/1",
}
GRADE_MAP = {"高级": "Premium", "标准": "Standard", "经济": "Economy"}
VALUE_MAPS = {
    "pds_location_type_en": LOCATION_TYPE_MAP,
    "pds_floor_type": FLOOR_TYPE_MAP,
    "pds_grace": GRADE_MAP,
}

# What replaces a missing entry.
MISSING_TEXT = "None"
MISSING_TEXT_WEEKLY = "No_data"
TEXT_COLUMNS = [
    "activity_desc", "pds_grace", "pds_store_segmentation", "store_type", "city_tier",
    "pds_floor_type", "pds_location_type_en", "osd_type",
]
MISSING_MEETING_TYPE = "Others(其它"
MISSING_REQUIRED_NUM = 1
MISSING_OFFER_SIZE = 100
MISSING_DAY_OF_PROM = -1

# Sales cleaning.
OUTLIER_QUANTITY = 200
OUTLIER_DAYS = 7
MAX_QUANTITY = 50
MAX_PAYMENT = 3000
STORE_AREAS = ["1", "2", "3", "4"]
MIN_DAY = "2019-01-01"
LOW_SALES_START = "2020-04-01"
PANDEMIC_MONTHS = ["2020-01", "2020-02", "2020-03"]
PANDEMIC_SPAN = ("2020-01-01", "2020-04-01")

# Attributes kept of a store.
STORE_ATTRIBUTES = [
    "distt_idnt", "regn_idnt", "area_idnt", "mkt_idnt", "store_type", "loc_fmt_cde", "loc_selling_area",
    "loc_tot_area", "pds_location_type_en", "pds_mtg_type", "pds_store_segmentation", "pds_grace",
    "pds_floor_type", "city_tier", "zone_id", "is_intracity_dlvr_store", "loc_wh", "is_central_store",
]

# Acceptance band of sell-through and result labels.
PASS_BAND = (0.65, 1.2)
MODEL_ID = "SC_A5_LGBM_V1"
SCENARIO = "TopSales"
AID = "A5"
LOW_VOLUME = 100

# Columns of the model table.
INDEX_FEATURES = ["day_dt", "store_id", "item_code", "loc_wh"]
MODEL_FEATURES = [
    "year", "month", "day_of_prom", "weekday", "day_type", "is_5th", "store_type", "activity_desc",
    *PROMOTION_FLAGS, "required_num", "unit_price", "p_rate", "dis_spring", "num_items_in_offer",
    "loc_selling_area", "pds_grace",
]
TARGET = "ttl_quantity"
CATEGORICAL = ["year", "month", "store_type", "activity_desc"]
LOW_SALES_FEATURES = ["unit_price", "weekday", "day_type", "is_5th"]
CORRELATION_FEATURES = [
    "is_5th", "weekday", "day_type", "deal_price", *PROMOTION_FLAGS, "required_num", "amount",
    "prom_price", "unit_price", "retail_price", "p_rate", "loc_selling_area",
]

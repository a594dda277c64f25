"""Column types of the input tables. Ids are strings everywhere; money and quantities are doubles."""

from pyspark.sql import types as T

from shelfwise.constants import OFFER_PRICES, PROMOTION_FLAGS, PROMOTION_LABELS


KINDS = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _struct(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, KINDS[kind]) for name, kind in columns.items()])


SALES = _struct(
    item_code="string", store_id="string", day_dt="date",
    ttl_quantity="double", avg_amountofsales="double", ttl_amt_payment="double",
)
TRANSACTIONS = _struct(
    prd_id="string", transaction_date="timestamp_ntz", work_date="date", deliver_storeid="string",
    order_store="string", loc_idnt="string", channel="string",
    quantity="double", amountofsales="double", amt_payment="double",
)
SHELF_PLAN = _struct(item_idnt="string", wk_idnt="string", loc_idnt="string")
CALENDAR = _struct(
    day_dt="date", wk_idnt="string", day_type="int", last_day_type="int", activity_desc="string",
    mday="int", yday="int", year="int", month="int", weekday="int", is_5th="int",
)
STORE = _struct(
    store_id="string", distt_idnt="string", regn_idnt="string", area_idnt="string", mkt_idnt="string",
    store_type="string", loc_fmt_cde="string", loc_selling_area="double", loc_tot_area="double",
    pds_location_type_en="string", pds_mtg_type="string", pds_store_segmentation="string",
    pds_grace="string", pds_floor_type="string", city_tier="string", zone_id="string",
    is_intracity_dlvr_store="string", loc_wh="string", is_central_store="string", loc_start_dt="date",
)
PRODUCT = _struct(item_code="string", item_desc="string", sbclass_desc="string", class_desc="string", item_brand="string")
RAW_OFFERS = _struct(
    item="string", offer_code="string", offer_start_date="string", offer_end_date="string",
    osd_type="string", outputs="string",
    **{label: "string" for label in PROMOTION_LABELS},
    is_vip="string", free_gift="string",
    **{name: "string" for name in OFFER_PRICES},
    flag="string",
)
OFFERS = _struct(
    item="string", offer_code="string", offer_start_date="date", offer_end_date="date",
    osd_type="string", outputs="string",
    **{name: "double" for name in [*PROMOTION_FLAGS, *OFFER_PRICES]},
    flag="string",
)
UNIT_PRICE = _struct(item_code="string", area_idnt="string", day_dt="date", unit_price2="double")
LUNAR = _struct(day_dt="date", dis_spring="int")
FUTURE_SAMPLE = _struct(day_dt="date", store_id="string")
CODE_MAP = _struct(code_type="string", key_id="string", value_id="string")
RESULT = _struct(
    model_id="string", item_code="string", store_id="string", day_dt="date",
    ttl_quantity="double", y_pred="double", istest="int",
)

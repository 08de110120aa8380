"""Record schemas.  Streams never infer a schema.

Fixed values: field and column names, and their order, are those of the shop's topics and tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(16, 2)


def _record(**fields: str | T.DataType) -> T.StructType:
    named = {"string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "money": MONEY}
    return T.StructType(
        [T.StructField(n, named[t] if isinstance(t, str) else t) for n, t in fields.items()]
    )


TEXT_MAP = T.MapType(T.StringType(), T.StringType())

# Leaves of a log line are read as text and cast afterwards, so that a value of
# an unexpected type does not make a well-formed line look malformed.
LOG_LINE = _record(
    log_id="string",
    common=_record(mid="string", vc="string", ch="string", ar="string", is_new="string"),
    page=_record(
        page_id="string", last_page_id="string", item="string", item_type="string",
        during_time="string", source_type="string",
    ),
    start="string",
    displays=T.ArrayType(_record(item="string", item_type="string")),
    ts="string",
)

CHANGE = _record(database="string", tableName="string", type="string", data=TEXT_MAP, before=TEXT_MAP)
CONNECT_VALUE = _record(op="string", before=TEXT_MAP, after=TEXT_MAP)

ROUTE = _record(
    sourceTable="string", operateType="string", sinkType="string", sinkTable="string",
    sinkColumns="string", sinkPk="string", sinkExtend="string",
)

ORDER_INFO = _record(
    id="long", province_id="long", order_status="string", user_id="long", total_amount="money",
    activity_reduce_amount="money", coupon_reduce_amount="money", original_total_amount="money",
    feight_fee="money", expire_time="string", create_time="string", operate_time="string",
)
ORDER_DETAIL = _record(
    id="long", order_id="long", sku_id="long", order_price="money", sku_num="long", sku_name="string",
    create_time="string", split_total_amount="money", split_activity_amount="money",
    split_coupon_amount="money",
)
PAYMENT_INFO = _record(
    id="long", order_id="long", user_id="long", total_amount="money", subject="string",
    payment_type="string", create_time="string", callback_time="string",
)
# Order and detail records of the shop's change-data topics (all text but the amount).
SHOP_ORDER = _record(
    id="string", province_id="string", consignee="string", order_comment="string",
    consignee_tel="string", order_status="string", payment_way="string", user_id="string",
    img_url="string", total_amount="money", expire_time="string", delivery_address="string",
    create_time="string", operate_time="string", tracking_no="string", parent_order_id="string",
    out_trade_no="string", trade_body="string",
)
SHOP_DETAIL = _record(
    id="string", order_id="string", sku_name="string", sku_id="string", order_price="string",
    img_url="string", sku_num="string",
)
USER_INFO = _record(id="string", login_name="string", user_level="string", birthday="string", gender="string")

FAVOR = _record(sku_id="long", create_time="string")
CART = FAVOR
REFUND = _record(sku_id="long", order_id="long", refund_amount="money", create_time="string")
COMMENT = _record(sku_id="long", appraise="string", create_time="string")

STARTUP_LOG = _record(
    mid="string", uid="string", appid="string", area="string", os="string", ch="string",
    type="string", vs="string", ts="long",
)
EVENT_LOG = _record(
    mid="string", uid="string", appid="string", area="string", os="string", type="string",
    evid="string", pgid="string", npgid="string", itemid="string", ts="long",
)

_PROVINCE = ["province_name", "province_area_code", "province_iso_code", "province_3166_2_code"]
_PRODUCT = ["spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name"]

# Column order of the published tables.
ORDER_WIDE_COLUMNS = [
    "detail_id", "order_id", "sku_id", "order_price", "sku_num", "sku_name", "province_id",
    "order_status", "user_id", "total_amount", "activity_reduce_amount", "coupon_reduce_amount",
    "original_total_amount", "feight_fee", "split_feight_fee", "split_activity_amount",
    "split_coupon_amount", "split_total_amount", "expire_time", "create_time", "operate_time",
    "create_date", "create_hour", *_PROVINCE, "user_age", "user_gender", *_PRODUCT,
]
PAYMENT_WIDE_COLUMNS = [
    "payment_id", "subject", "payment_type", "payment_create_time", "callback_time",
    *ORDER_WIDE_COLUMNS[:18], "order_create_time", *_PROVINCE, "user_age", "user_gender", *_PRODUCT,
]

_TYPES = {
    **{n: "long" for n in ("payment_id", "detail_id", "order_id", "sku_id", "sku_num", "province_id", "user_id")},
    **{n: "money" for n in (
        "order_price", "total_amount", "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount",
        "feight_fee", "split_feight_fee", "split_activity_amount", "split_coupon_amount", "split_total_amount",
    )},
    "user_age": "int",
}
# The wide facts as read back from their topics; dimension ids stay text.
ORDER_WIDE = _record(**{n: _TYPES.get(n, "string") for n in ORDER_WIDE_COLUMNS})
PAYMENT_WIDE = _record(**{n: _TYPES.get(n, "string") for n in PAYMENT_WIDE_COLUMNS})
DISPLAY = _record(page_id="string", item="string", item_type="string")

VISITOR_STATS_COLUMNS = [
    "stt", "edt", "vc", "ch", "ar", "is_new", "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum", "ts",
]
PRODUCT_STATS_COLUMNS = [
    "stt", "edt", "sku_id", "sku_name", "sku_price", "spu_id", "spu_name", "tm_id", "tm_name",
    "category3_id", "category3_name", "display_ct", "click_ct", "favor_ct", "cart_ct",
    "order_sku_num", "order_amount", "order_ct", "payment_amount", "paid_order_ct",
    "refund_order_ct", "refund_amount", "comment_ct", "good_comment_ct", "ts",
]
PROVINCE_STATS_COLUMNS = [
    "stt", "edt", "province_id", "province_name", "province_area_code", "province_iso_code",
    "province_3166_2_code", "order_amount", "order_count", "ts",
]
KEYWORD_STATS_COLUMNS = ["keyword", "ct", "source", "stt", "edt", "ts"]
SALE_DETAIL_COLUMNS = [
    "order_detail_id", "order_id", "order_status", "create_time", "user_id", "sku_id",
    "user_gender", "user_age", "user_level", "sku_price", "sku_name", "dt",
]

"""Status and type codes of the shop."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# The shop's code table.
CODES = {
    "order_status": {
        "1001": "unpaid",
        "1002": "paid",
        "1003": "cancelled",
        "1004": "finished",
        "1005": "refunding",
        "1006": "refunded",
    },
    "payment_type": {"1101": "alipay", "1102": "wechat", "1103": "unionpay"},
    "appraise": {"1201": "good", "1202": "so-so", "1203": "bad", "1204": "automatic"},
    "refund_reason": {
        "1301": "bad goods",
        "1302": "wrong description",
        "1303": "sold out",
        "1304": "wrong size",
        "1305": "mistake",
        "1306": "no reason",
        "1307": "other",
    },
    "coupon_status": {"1401": "unused", "1402": "in use", "1403": "used"},
    "refund_type": {"1501": "money only", "1502": "with goods"},
    "source_type": {
        "2401": "query",
        "2402": "promotion",
        "2403": "recommendation",
        "2404": "activity",
    },
    "activity_rule": {"3101": "amount off", "3102": "quantity discount", "3103": "discount"},
    "coupon_type": {"3201": "amount off", "3202": "quantity discount", "3203": "voucher"},
    "coupon_range": {"3301": "category", "3302": "trademark", "3303": "product"},
}
APPRAISE_GOOD = "1201"
KEYWORD_SEARCH = "SEARCH"


def code_label(kind: str, code: Column | str) -> Column:
    """Label of a code, null for an unknown one."""
    pairs = F.create_map(*[F.lit(x) for x in chain(*CODES[kind].items())])
    return F.try_element_at(pairs, F.col(code) if isinstance(code, str) else code)

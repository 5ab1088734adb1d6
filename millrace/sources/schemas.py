"""Record types of the analytics, fields in file order."""

from __future__ import annotations

from pyspark.sql import types as T


def _record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()

WATER_SENSOR = _record(id=_S, ts=_L, vc=_I)
WATER_SENSOR_AVG = _record(id=_S, ts=_L, vc=_D)
USER_BEHAVIOR = _record(user_id=_L, item_id=_L, category_id=_I, behavior=_S, ts=_L)
MARKETING_BEHAVIOR = _record(user_id=_L, behavior=_S, channel=_S, ts_ms=_L)
AD_CLICK = _record(user_id=_L, ad_id=_L, province=_S, city=_S, ts=_L)
WEB_LOG = _record(ip=_S, user=_S, ts_ms=_L, method=_S, url=_S)
LOGIN_EVENT = _record(user_id=_L, ip=_S, event_type=_S, event_time=_L)
ORDER_EVENT = _record(order_id=_L, event_type=_S, tx_id=_S, event_time=_L)
RECEIPT = _record(tx_id=_S, pay_channel=_S, event_time=_L)
WORD_COUNT = _record(word=_S, n=_L)
NAMED = _record(id=_S, name=_S)
CLASSED = _record(id=_S, class_id=_I)
EVENT = T.StructType(
    [
        T.StructField("event_id", _L),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", _L),
        T.StructField("event_type", _S),
        T.StructField("value", _D),
        T.StructField("props", _S),
    ]
)

"""Record types, declared once and never inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def record(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_INT, _LONG, _FLOAT, _DOUBLE = T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()
_TEXT, _BYTES, _FLAG, _NTZ = T.StringType(), T.BinaryType(), T.BooleanType(), T.TimestampNTZType()

# Field names and types of the records. Ids are 64 bits wide where 32 are declared:
# a log may hold more than 2^31 records, and every 32-bit id fits.
CUSTOMER_ID = record(("customerId", _LONG))
CUSTOMER = record(
    ("customerId", _LONG),
    ("firstName", _TEXT),
    ("lastName", _TEXT),
    ("email", _TEXT),
    ("update", _TEXT),
    ("age", _INT),
    ("region", _TEXT),
    ("epoch", _INT),
)
CUSTOMER_WITH_REGION = record(
    ("customerId", _LONG),
    ("firstName", _TEXT),
    ("lastName", _TEXT),
    ("email", _TEXT),
    ("age", _INT),
    ("regionName", _TEXT),
    ("areaCode", _TEXT),
)
REGION = record(("identifier", _TEXT), ("longName", _TEXT), ("areaCode", _TEXT), ("update", _TEXT))
ORDER = record(("orderId", _LONG), ("date", _LONG), ("customerId", _TEXT), ("orderAmount", _INT))
ORDER_ITEM = record(("productId", _LONG), ("orderId", _LONG), ("count", _INT), ("price", _DOUBLE))
PRODUCT = record(("productId", _LONG), ("name", _TEXT), ("description", _TEXT))
PRICE_POINT = record(("productId", _LONG), ("price", _FLOAT), ("date", _LONG))
COUNTER = record(("counterId", _LONG), ("timestamp", _LONG))
LARGE_COUNTER = record(("counterId", _BYTES), ("timestamp", _LONG))
BINARY = record(("id", _BYTES), ("payload", _TEXT))
HEX_STRING = record(("id", _TEXT), ("payload", _TEXT))
SENSOR_VALUE = record(("member0", _INT), ("member1", _FLOAT), ("member2", _FLAG), ("member3", _TEXT))
SENSOR = record(("id", _LONG), ("sensorTime", _TEXT), ("value", SENSOR_VALUE))
SUIT = record(("suit", _TEXT))
CHANGE = record(("change", _LONG), ("date", _LONG), ("user", _TEXT), ("client", _TEXT))
REVISION = record(("change", _LONG), ("filename", _TEXT), ("revision", _INT), ("action", _TEXT))
USER = record(("userId", _TEXT))

# Record names as readers see them, enum members, field defaults.
RECORDS = {
    "schema.Customer": CUSTOMER,
    "schema.CustomerId": CUSTOMER_ID,
    "schema.CustomerWithRegion": CUSTOMER_WITH_REGION,
    "schema.Region": REGION,
    "schema.Order": ORDER,
    "schema.OrderItem": ORDER_ITEM,
    "schema.Product": PRODUCT,
    "schema.PricePoint": PRICE_POINT,
    "schema.Counter": COUNTER,
    "schema.LargeCounter": LARGE_COUNTER,
    "schema.Binary": BINARY,
    "schema.HexString": HEX_STRING,
    "schema.SensorData": SENSOR,
    "schema.Suit": SUIT,
    "schema.Change": CHANGE,
    "schema.Revision": REVISION,
    "schema.User": USER,
}
SUITS = ("SPADES", "CLUBS", "HEARTS", "DIAMONDS")
ORDER_AMOUNT_DEFAULT = 1

# Columns of the given tables that the queries read.
EVENTS = record(
    ("event_id", _LONG),
    ("ts", _NTZ),
    ("user_id", _LONG),
    ("event_type", _TEXT),
    ("value", _DOUBLE),
    ("props", _TEXT),
)
PART = record(
    ("p_partkey", _LONG),
    ("p_name", _TEXT),
    ("p_brand", _TEXT),
    ("p_type", _TEXT),
    ("p_size", _INT),
    ("p_retailprice", _DOUBLE),
)
ORDERS = record(
    ("o_orderkey", _LONG),
    ("o_custkey", _LONG),
    ("o_orderstatus", _TEXT),
    ("o_totalprice", _DOUBLE),
    ("o_orderdate", _NTZ),
    ("o_orderpriority", _TEXT),
)

TABLES = {"events": EVENTS, "part": PART, "orders": ORDERS}

"""The registered queries as plain SQL over the same tables."""

from __future__ import annotations

from keytide.plans.queries import CHANGE_OFFSET, COUNTER_OFFSET, POLL_SIZE, SEED

# Code, name and dialling prefix of each region, by index, written out here again.
REGIONS = (
    ("UK", "United Kingdom", "+49"), ("DE", "Germany", "+49"), ("FR", "France", "+33"), ("IT", "Italy", "+39"),
    ("UA", "Ukraine", "+380"), ("SE", "Sweden", "+46"), ("DK", "Denmark", "+45"), ("NO", "Norway", "+47"),
    ("PL", "Poland", "+48"), ("IS", "Iceland", "+354"), ("US", "United States of America", "+1"),
    ("IE", "Ireland", "+353"), ("IN", "India", "+91"), ("HK", "Hong Kong", "+852"),
)
_RC = "rc(idx, identifier, longName, areaCode) AS (VALUES {})".format(
    ", ".join(f"({i}, '{code}', '{name}', '{prefix}')" for i, (code, name, prefix) in enumerate(REGIONS))
)
_TEXT = "strftime({}, '%Y/%m/%d %H:%M:%S') || ' +00:00'"
_UPDATE = _TEXT.format("ts")
_CUST = f"""cust AS (
  SELECT e.user_id AS key, e.user_id AS customerId,
    'first_' || e.user_id AS firstName, 'last_' || e.user_id AS lastName,
    'email_' || e.user_id || '@email.com' AS email, {_TEXT.format('e.ts')} AS "update",
    CAST(18 + e.user_id % 50 AS INTEGER) AS age, rc.identifier AS region, CAST(1 AS INTEGER) AS epoch,
    e.event_id AS off, e.ts
  FROM events e JOIN rc ON rc.idx = e.user_id % {len(REGIONS)})"""
_REGIONS = f"""regions AS (
  SELECT identifier, longName, areaCode
  FROM (SELECT event_id % {len(REGIONS)} AS idx, arg_max(event_type, event_id) AS newest FROM events
    WHERE event_type IN ('error', 'signup') GROUP BY 1) JOIN rc USING (idx)
  WHERE newest = 'error')"""
_REGION_LOG = f"""regionlog AS (
  SELECT e.ts, e.event_id AS off, rc.identifier, rc.longName AS regionName, rc.areaCode || '#' || e.event_id AS areaCode
  FROM events e JOIN rc ON rc.idx = e.event_id % {len(REGIONS)} WHERE e.event_type = 'error')"""
_PRODUCTS = """products AS (
  SELECT p_partkey AS key, p_partkey AS productId, p_name AS name,
    'description_' || p_partkey AS description, p_partkey AS off FROM part)"""
_COUNTER = f"""counterlog AS (
  SELECT {COUNTER_OFFSET} + event_id + 1 AS key, epoch_us(ts) // 1000 AS "timestamp", false AS is_deleted,
    event_id * 2 AS off FROM events
  UNION ALL
  SELECT {COUNTER_OFFSET} + event_id - 1000, NULL, true, event_id * 2 + 1 FROM events
  WHERE event_id > 1000)"""
_PRICES = "prices AS (SELECT user_id AS key, value AS price, ts, event_id AS off FROM events)"
_EVENT_STEPS = "steps AS (SELECT event_id AS n, ts FROM events)"

_PARTS = """parts AS (
  SELECT i, low + (high - low + 1) * i // 3 AS a, low + (high - low + 1) * (i + 1) // 3 AS b
  FROM (SELECT min(event_id) AS low, max(event_id) AS high FROM events), range(3) AS numbers(i))"""

_BASE = f"WITH {_RC}, {_CUST}"
_FIELDS = 'customerId, firstName, lastName, email, "update", age, region, epoch'


def _bits(field: str, n: str = "n") -> str:
    return f"CAST('0x' || substr(md5('{SEED}:{field}:' || {n}), 1, 15) AS BIGINT)"


def _below(field: str, bound: int, n: str = "n") -> str:
    return f"CAST({_bits(field, n)} % {bound} AS INTEGER)"


def _unit(field: str) -> str:
    return f"(CAST({_bits(field)} % 16777216 AS DOUBLE) / 16777216.0::DOUBLE)"


_JOINED = "customerId, firstName, lastName, email, age, longName AS regionName, areaCode, off"
_INNER = f"SELECT {{key}} AS key, {_JOINED} FROM cust JOIN regions ON region = identifier"
_LEFT = f"SELECT key, {_JOINED} FROM cust LEFT JOIN regions ON region = identifier"
_ASOF = """SELECT {key} AS key, c.customerId, c.firstName, c.lastName, c.email, c.age, v.regionName, v.areaCode, c.off, c.ts
  FROM cust c ASOF {how} JOIN regionlog v ON c.region = v.identifier AND c.ts >= v.ts"""
_LATEST_PRICE = """SELECT key, price, ts, off FROM prices
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY off DESC) = 1"""
_GENERATED = f"""WITH {_RC}, {_EVENT_STEPS}, drawn AS (
  SELECT CAST({_below('customer', 1000)} + 1 AS BIGINT) AS id, n, ts FROM steps)
SELECT {{key}}, id AS customerId, 'first_' || id AS firstName, 'last_' || id AS lastName,
  'email_' || id || '@email.com' AS email, {_UPDATE} AS "update", CAST(18 + id % 50 AS INTEGER) AS age,
  rc.identifier AS region, CAST(1 AS INTEGER) AS epoch, n AS off, ts
FROM drawn JOIN rc ON rc.idx = id % {len(REGIONS)}"""
_CUSTOMER_JSON = """'{"customerId":' || customerId || ',"firstName":"' || firstName || '","lastName":"' || lastName
  || '","email":"' || email || '","update":"' || "update" || '","age":' || age || ',"region":"' || region
  || '","epoch":' || epoch || '}'"""
_PRODUCT_JSON = """'{"productId":' || productId || ',"name":"' || name || '","description":"' || description || '"}'"""
_FIRST_OF = f"""SELECT key, {_FIELDS}, off, ts FROM cust
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY off) = 1"""
_FLAGGED = """SELECT key, customerId, firstName, lastName, email, "update", age, region,
  CAST(epoch + CASE WHEN row_number() OVER (PARTITION BY key ORDER BY off) > 1 THEN 1 ELSE 0 END AS INTEGER) AS epoch,
  off, ts FROM cust"""


def _counted(key: str) -> str:
    first = ", ".join(
        f"first_value({name}) OVER w AS {name}"
        for name in ("customerId", "firstName", "lastName", "email", '"update"', "age", "region")
    )
    return f"""SELECT {key} AS key, {first},
  CAST(first_value(epoch) OVER w + row_number() OVER w - 1 AS INTEGER) AS epoch, off, ts
  FROM cust WINDOW w AS (PARTITION BY {key} ORDER BY off)"""


_NEWEST = f"""SELECT key, customerId, firstName, lastName, email, "update", age, region, epoch FROM ({_counted('key')})
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY off DESC) = 1"""
_REVISIONS = f"""changes AS (
  SELECT o_orderkey + {CHANGE_OFFSET} AS change, epoch_us(o_orderdate) // 1000000 AS date,
    'developer' AS user, 'developer_workspace' AS client FROM orders),
files AS (
  SELECT change, unnest(range({_below('files', 10, 'change')} + 1)) AS file FROM changes),
revisions AS (
  SELECT change, '//depot/project/file' || file AS filename, CAST(1 AS INTEGER) AS revision, 'add' AS action FROM files)"""

ORACLES: dict[str, str] = {
    "scan_customers": f"{_BASE} SELECT key, {_FIELDS}, off, ts FROM cust",
    "scan_products": f"WITH {_PRODUCTS} SELECT * FROM products",
    "scan_price_points": f"WITH {_PRICES} SELECT * FROM prices",
    "scan_struct_key": f"{_BASE} SELECT customerId AS key_customerId, lastName, region, off FROM cust",
    "scan_numbers": "SELECT CAST(NULL AS VARCHAR) AS key, event_id + 1 AS value FROM events",
    "scan_generic": f"""{_BASE}, {_PRODUCTS}
SELECT 'schema.Customer' AS schema_name, CAST(key AS VARCHAR) AS key, {_CUSTOMER_JSON} AS payload FROM cust
UNION ALL SELECT 'schema.Product', CAST(key AS VARCHAR), {_PRODUCT_JSON} FROM products""",
    "route_by_type": f"""WITH {_PRODUCTS}
SELECT CAST(key AS VARCHAR) AS key, productId, name, description FROM products""",
    "route_customers": f"{_BASE} SELECT CAST(key AS VARCHAR) AS key, {_FIELDS} FROM cust",
    "decode_customer": f"{_BASE} SELECT key, {_FIELDS}, off, ts FROM cust",
    "sensor_union": f"""WITH {_EVENT_STEPS}, drawn AS (
  SELECT CAST({_below('sensor', 1000)} + 1 AS BIGINT) AS id, {_below('sensor-kind', 4)} AS k, {_below('sensor-flag', 2)} = 1 AS flag, n, ts
  FROM steps)
SELECT id AS key, id, {_UPDATE} AS sensorTime,
  CASE k WHEN 0 THEN 'float' WHEN 1 THEN 'int' WHEN 2 THEN 'boolean' ELSE 'string' END AS kind,
  CASE WHEN k = 1 THEN CAST({_below('sensor-int', 100)} AS VARCHAR) END AS int_value,
  CASE WHEN k = 0 THEN CAST({_unit('sensor-float')} AS FLOAT) END AS float_value,
  CASE WHEN k = 2 THEN CAST(flag AS VARCHAR) END AS boolean_value,
  CASE WHEN k = 3 THEN CASE WHEN flag THEN 'true' ELSE 'false' END END AS string_value,
  n AS off FROM drawn""",
    "scan_from_latest": f"""{_BASE} SELECT key, {_FIELDS}, off, ts FROM cust
WHERE off >= (SELECT count(*) // 2 FROM events)""",
    "scan_bounded": f"""{_BASE} SELECT key, {_FIELDS}, off, ts FROM cust
WHERE off < ((SELECT count(*) // 2 FROM events) // {POLL_SIZE} + 1) * {POLL_SIZE}""",
    "filter_age_lt_30": f"{_BASE} SELECT key, lastName, age FROM cust WHERE age < 30",
    "filter_age_range": f"{_BASE} SELECT key, {_FIELDS}, off, ts FROM cust WHERE age > 30 AND age < 55",
    "rekey_by_region": f"{_BASE} SELECT region AS key, {_FIELDS}, off, ts FROM cust",
    "repartition_by_region": f"{_BASE} SELECT region AS key, {_FIELDS}, off, ts FROM cust",
    "binary_to_hex": """SELECT upper(md5(p_name)) AS key, upper(md5(p_name)) AS id, p_type AS payload, p_partkey AS off
FROM part""",
    "integer_hex": """WITH digits AS (
  SELECT p_partkey AS key, md5(p_name) AS d, CAST('0x' || right(md5(p_name), 8) AS BIGINT) AS u FROM part)
SELECT key, ltrim(d, '0') AS text, CAST(CASE WHEN u >= 2147483648 THEN u - 4294967296 ELSE u END AS INTEGER) AS low
FROM digits""",
    "time_text": f"""SELECT event_id AS off, {_UPDATE} AS "update", epoch_us(ts) // 1000000 AS read_back,
  epoch_us(ts) // 1000 AS millis, epoch_us(ts) // 1000 AS millis_back, epoch_us(ts) // 1000000 AS seconds_back FROM events""",
    "price_table": f"WITH {_PRICES} {_LATEST_PRICE}",
    "latest_customer": f"""{_BASE} SELECT key, {_FIELDS}, off FROM cust
QUALIFY row_number() OVER (PARTITION BY key ORDER BY off DESC) = 1""",
    "latest_region": f"""WITH {_RC}, {_REGION_LOG} SELECT identifier, regionName, areaCode FROM regionlog
QUALIFY row_number() OVER (PARTITION BY identifier ORDER BY ts DESC, off DESC) = 1""",
    "price_table_changes": f"WITH {_PRICES} {_LATEST_PRICE}",
    "compact_with_deletes": """WITH newest AS (
  SELECT user_id AS key, value AS price, ts, event_id AS off, event_type FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
SELECT key, price, ts, off FROM newest WHERE event_type IS DISTINCT FROM 'error'""",
    "counter_log": f"""WITH {_COUNTER}
SELECT key, CAST("timestamp" AS VARCHAR) AS "timestamp", is_deleted, off FROM counterlog""",
    "counter_survivors": f"""WITH {_COUNTER}, newest AS (
  SELECT * FROM counterlog QUALIFY row_number() OVER (PARTITION BY key ORDER BY off DESC) = 1)
SELECT key, "timestamp" FROM newest WHERE NOT is_deleted""",
    "batch_counts": f"""WITH counts AS (
  SELECT event_id // {POLL_SIZE} AS batch, count(*) AS records FROM events GROUP BY 1)
SELECT batch, records, CAST(sum(records) OVER (ORDER BY batch) AS BIGINT) AS total FROM counts""",
    "join_region_left": f"{_BASE}, {_REGIONS} {_LEFT}",
    "join_region_asof_inner": f"{_BASE}, {_REGION_LOG} {_ASOF.format(key='c.region', how='')}",
    "join_region_asof_left": f"{_BASE}, {_REGION_LOG} {_ASOF.format(key='c.key', how='LEFT')}",
    "dedup_first": f"{_BASE} {_FIRST_OF}",
    "dedup_epoch_flag": f"{_BASE} {_FLAGGED}",
    "dedup_epoch_join": f"{_BASE} {_counted('key')}",
    "dedup_epoch_join_segmented": f"{_BASE} {_counted('region')}",
    "dedup_epoch_latest": f"{_BASE} {_NEWEST}",
    "stream_dedup_keys": f"{_BASE} {_FIRST_OF}",
    "stream_restart": f"{_BASE} SELECT key, {_FIELDS}, off, ts FROM cust",
    "replay_batch": f"{_BASE} SELECT key, {_FIELDS}, off, ts FROM cust",
    "observed_counts": """SELECT 'customer' AS "table", count(*) AS records FROM events HAVING count(*) > 0""",
    "stream_bounded": f"""{_BASE}, {_PARTS} SELECT key, {_FIELDS}, off, ts FROM cust
WHERE off < (SELECT b FROM parts WHERE i = 1)""",
    "join_region_live": f"""{_BASE}, {_PARTS}, regions AS (
  SELECT i, identifier, longName, areaCode
  FROM (SELECT i, event_id % {len(REGIONS)} AS idx, arg_max(event_type, event_id) AS newest FROM events JOIN parts ON event_id < b
    WHERE event_type IN ('error', 'signup') GROUP BY ALL) JOIN rc USING (idx)
  WHERE newest = 'error')
SELECT key, {_JOINED}, i AS table_version
FROM cust JOIN parts ON off >= a AND off < b JOIN regions USING (i) WHERE region = identifier""",
    "stream_dedup_weekly": f"""{_BASE} SELECT key, {_FIELDS}, off, ts FROM cust
QUALIFY row_number() OVER (PARTITION BY key, epoch_us(ts) // (7 * 86400000000) ORDER BY off) = 1""",
    "counter_log_payload": f"""WITH {_COUNTER}
SELECT key, CASE WHEN NOT is_deleted THEN '{{"counterId":' || key || ',"timestamp":' || "timestamp" || '}}' END AS value, off
FROM counterlog""",
    "join_region_asof_deletes": f"""{_BASE}, regionlog AS (
  SELECT e.ts, rc.identifier, rc.longName AS regionName, rc.areaCode, e.event_type = 'signup' AS gone
  FROM events e JOIN rc ON rc.idx = e.event_id % {len(REGIONS)} WHERE e.event_type IN ('error', 'signup'))
SELECT c.key, c.customerId, c.firstName, c.lastName, c.email, c.age, v.regionName, v.areaCode, c.off, c.ts
FROM cust c ASOF JOIN regionlog v ON c.region = v.identifier AND c.ts >= v.ts WHERE NOT v.gone""",
    "fan_out_two": f"""{_BASE} SELECT key, {_FIELDS}, off, ts, 'topic1' AS topic FROM cust
UNION ALL SELECT key, {_FIELDS}, off, ts, 'topic2' FROM cust""",
    "atomic_change_revision": f"""WITH {_REVISIONS}
SELECT c.change, c.date, c.user, c.client, r.filename, r.revision, r.action
FROM changes c JOIN revisions r ON c.change = r.change""",
    "gen_customer": _GENERATED.format(key="id AS key"),
    "gen_customer_keyed": _GENERATED.format(key="id AS key_customerId"),
    "gen_region": f"""WITH {_RC}, {_EVENT_STEPS}, drawn AS (SELECT {_below('region', len(REGIONS))} AS i, n, ts FROM steps)
SELECT identifier AS key, identifier, longName, areaCode, {_UPDATE} AS "update", n AS off, ts
FROM drawn JOIN rc ON rc.idx = i""",
    "gen_product": f"""WITH drawn AS (
  SELECT CAST({_below('product', 1000, 'p_partkey')} + 1 AS BIGINT) AS id, p_partkey AS n, TIMESTAMP '2024-01-01 00:00:00' AS ts FROM part)
SELECT id AS key, id AS productId, 'product_' || id AS name, 'description_' || id AS description, n AS off, ts FROM drawn""",
    "gen_order": f"""WITH drawn AS (SELECT o_orderkey AS n, o_orderdate AS ts FROM orders)
SELECT CAST({_below('order', 1000)} + 1 AS BIGINT) AS key, CAST({_below('order', 1000)} + 1 AS BIGINT) AS orderId, epoch_us(ts) // 1000 AS date,
  CAST({_below('order-customer', 1000)} + 1 AS VARCHAR) AS customerId, {_below('order-amount', 1000)} + 1 AS orderAmount,
  n AS off, CAST(ts AS TIMESTAMP) AS ts FROM drawn""",
    "gen_order_item": f"""WITH {_EVENT_STEPS}
SELECT CAST({_below('item-order', 100000)} AS BIGINT) AS key, CAST({_below('item-product', 100)} AS BIGINT) AS productId,
  CAST({_below('item-order', 100000)} AS BIGINT) AS orderId, {_below('item-count', 10)} + 1 AS count,
  floor({_unit('item-price')} * 10000::DOUBLE + 0.5::DOUBLE) / 100::DOUBLE AS price, n AS off, ts FROM steps""",
    "gen_price_point": f"""WITH {_EVENT_STEPS}
SELECT CAST({_below('price-product', 1000)} + 1 AS BIGINT) AS key, CAST({_below('price-product', 1000)} + 1 AS BIGINT) AS productId,
  CAST({_unit('price')} * 100::DOUBLE AS FLOAT) AS price, epoch_us(ts) // 1000 AS date, n AS off, ts FROM steps""",
    "gen_suit": "SELECT CAST(1 AS INTEGER) AS key, 'DIAMONDS' AS suit, event_id AS off, ts FROM events",
    "gen_binary": f"""WITH {_EVENT_STEPS}, low AS (
  SELECT n, ts, CAST('0x96A57BFE4DD91954' AS UBIGINT)::HUGEINT + n + 1 AS v FROM steps)
SELECT CAST(CASE WHEN v % 4294967296 >= 2147483648 THEN v % 4294967296 - 4294967296 ELSE v % 4294967296 END AS INTEGER) AS key,
  '430E009A80B53D78' || upper(to_hex(CAST(v AS UBIGINT))) AS id,
  lower('430E009A80B53D78' || to_hex(CAST(v AS UBIGINT))) AS payload, n AS off, ts FROM low""",
    "gen_change_revision": f"WITH {_REVISIONS} SELECT * FROM revisions",
}

_PRICE_LOOKUP = f"""WITH {_PRICES}, latest AS ({_LATEST_PRICE})
SELECT p.key, p.price, p.ts, p.off, l.price AS latest_price FROM prices p JOIN latest l ON p.key = l.key"""
for _name in ("price_lookup_broadcast", "price_lookup_shuffled"):
    ORACLES[_name] = _PRICE_LOOKUP
for _name in ("join_region_broadcast", "join_region_stream"):
    ORACLES[_name] = f"{_BASE}, {_REGIONS} {_INNER.format(key='cust.key')}"
for _name in ("join_region_inner", "join_region_inner_shuffled"):
    ORACLES[_name] = f"{_BASE}, {_REGIONS} {_INNER.format(key='region')}"
ORACLES["join_region_left_shuffled"] = ORACLES["join_region_left"]
ORACLES["join_region_asof_segmented"] = ORACLES["join_region_asof_left"]
ORACLES["dedup_epoch_flag_shuffled"] = ORACLES["dedup_epoch_flag"]
ORACLES["stream_epoch_flag"] = ORACLES["dedup_epoch_flag"]
ORACLES["stream_epoch_join"] = ORACLES["dedup_epoch_join"]
ORACLES["stream_epoch_latest"] = ORACLES["dedup_epoch_latest"]
ORACLES["fold_epoch_flag"] = ORACLES["dedup_epoch_flag"]
ORACLES["fold_epoch_join"] = ORACLES["dedup_epoch_join"]
ORACLES["stream_region_changing"] = ORACLES["join_region_asof_left"]

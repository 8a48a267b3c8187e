"""Readers: declared schemas, broker options, decoding that needs optional modules."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F, types as T

from keytide import schemas
from keytide.operators.fanout import counter_log
from keytide.plans import inputs
from keytide.sources import generators, generic, kafka, topics


def test_log_schema_has_key_and_position(spark):
    schema = topics.log_schema(schemas.CUSTOMER, schemas.CUSTOMER_ID)
    assert schema.fieldNames() == ["key", *schemas.CUSTOMER.fieldNames(), "off", "ts"]
    assert topics.log_schema(T.StructType([]), None)["key"].dataType == T.StringType()


@pytest.mark.parametrize(
    ("make", "record"),
    [
        (lambda s: generators.customers(s, 1), schemas.CUSTOMER),
        (lambda s: generators.regions(s, 1), schemas.REGION),
        (lambda s: generators.products(s, 1), schemas.PRODUCT),
        (lambda s: generators.orders(s, 1), schemas.ORDER),
        (lambda s: generators.order_items(s, 1), schemas.ORDER_ITEM),
        (lambda s: generators.price_points(s, 1), schemas.PRICE_POINT),
        (lambda s: generators.sensors(s, 1), schemas.SENSOR),
        (lambda s: generators.suits(s), schemas.SUIT),
        (lambda s: generators.binaries(s), schemas.BINARY),
        (lambda s: generators.changes(s), schemas.CHANGE),
    ],
)
def test_generated_logs_have_the_declared_record(spark, make, record):
    made = make(generators.numbered(spark, 10))
    assert made.columns == ["key", *record.fieldNames(), "off", "ts"]
    assert [f.dataType for f in made.select(*record.fieldNames()).schema] == [f.dataType for f in record]


def test_written_log_reads_back_typed(spark, tmp_path):
    made = generators.customers_with_record_key(generators.numbered(spark, 50), 1)
    made.write.parquet(str(tmp_path / "log"))
    back = topics.read_log(spark, str(tmp_path / "log"), topics.log_schema(schemas.CUSTOMER, schemas.CUSTOMER_ID))
    assert sorted(back.collect()) == sorted(made.collect())
    assert back.where("key.customerId <> customerId").isEmpty()


@pytest.mark.parametrize("name", ["schema.Customer", "schema.SensorData", "schema.Binary"])
def test_payload_round_trip(spark, name):
    steps = generators.numbered(spark, 40)
    made = {
        "schema.Customer": lambda: generators.customers(steps, 1),
        "schema.SensorData": lambda: generators.sensors(steps, 1),
        "schema.Binary": lambda: generators.binaries(steps),
    }[name]()
    record = schemas.RECORDS[name]
    encoded = generic.encode_value(made, record)
    assert dict(encoded.dtypes)["value"] == "binary"
    back = generic.decode_value(encoded, record)
    assert back.columns == made.columns
    assert sorted(map(str, back.collect())) == sorted(map(str, made.collect()))


def test_mixed_topic_routes_each_type(spark, data):
    mixed = generic.as_generic(inputs.customers(spark, data), "schema.Customer").unionByName(
        generic.as_generic(inputs.products(spark, data), "schema.Product")
    )
    assert generic.route(mixed, "schema.Customer").count() == 1000
    assert generic.route(mixed, "schema.Product").count() == 200
    assert generic.route(mixed, "schema.Region").isEmpty()


def test_broker_options():
    assert kafka.read_options("h:1", "t") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest"
    }
    bounded = kafka.read_options("h:1", "t", latest=True, records_per_batch=1000)
    assert bounded["startingOffsets"] == "latest" and bounded["maxOffsetsPerTrigger"] == "1000"
    assert kafka.write_options("h:1", "t")["kafka.acks"] == "all"


def test_missing_connector_is_named(spark):
    try:
        kafka.stream_topic(spark, "localhost:1", "t")
    except RuntimeError as error:
        assert "spark-sql-kafka" in str(error)


def test_avro_decoding_where_the_module_exists(spark):
    if not kafka.avro_available(spark):
        pytest.skip("this session has no Avro module")
    raw = spark.range(1).select(F.unhex(F.lit("000000000106")).alias("value"))
    assert raw.select(kafka.avro_value(F.col("value"), '"int"').alias("v")).first().v == 3


def test_delete_markers_become_null_payloads(spark):
    steps = spark.range(10).select(F.col("id").alias("n"), F.col("id").alias("timestamp"))
    log = counter_log(steps, 0, 3)
    assert log.where("is_deleted AND timestamp IS NOT NULL").isEmpty()

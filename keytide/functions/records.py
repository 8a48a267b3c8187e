"""Expressions over whole records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F, types as T

from keytide.schemas import ORDER_AMOUNT_DEFAULT, SUITS


def to_struct(schema: T.StructType) -> Column:
    """The columns of ``schema`` as one struct."""
    return F.struct(*[F.col(name) for name in schema.fieldNames()])


def to_text(schema: T.StructType) -> Column:
    """A record as JSON text."""
    return F.to_json(to_struct(schema), {"ignoreNullFields": "false"})


def checked_enum(value: Column, allowed: Sequence[str] = SUITS) -> Column:
    """The value, or an error where it is outside the allowed set."""
    message = F.concat(F.lit("not an allowed value: "), value)
    return F.when(value.isNull() | value.isin(*allowed), value).otherwise(F.raise_error(message).cast("string"))


def order_amount(value: Column) -> Column:
    return F.coalesce(value, F.lit(ORDER_AMOUNT_DEFAULT))


def union_kind(value: Column) -> Column:
    """Which member of the (int, float, boolean, string) union is set."""
    return (
        F.when(value["member0"].isNotNull(), F.lit("int"))
        .when(value["member1"].isNotNull(), F.lit("float"))
        .when(value["member2"].isNotNull(), F.lit("boolean"))
        .when(value["member3"].isNotNull(), F.lit("string"))
    )


def union_variant(value: Column) -> Column:
    """The union as one VARIANT; boolean true and text "true" stay distinct."""
    members = [F.to_variant_object(F.struct(value[f"member{i}"].alias("v"))) for i in range(4)]
    picked = F.coalesce(*[F.when(value[f"member{i}"].isNotNull(), members[i]) for i in range(4)])
    return F.variant_get(picked, "$.v", "variant")

"""Small hand-made tables."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType

from tillspan.sources.schemas import schema_of
from tillspan.sources.statuses import ORDER_STATUS
from tillspan.sources.tables import Retail


def make(spark: SparkSession, table: str, rows: list[dict]) -> DataFrame:
    """Rows of a table from dicts; columns left out are NULL. Text becomes decimals, dates and times as needed."""
    schema = schema_of(table)

    def value(field, raw):
        if raw is None:
            return None
        if isinstance(field.dataType, DecimalType):
            return Decimal(str(raw))
        if isinstance(field.dataType, DateType):
            return dt.date.fromisoformat(raw)
        if isinstance(field.dataType, TimestampNTZType):
            return dt.datetime.fromisoformat(raw)
        return raw

    unknown = {name for row in rows for name in row} - set(schema.fieldNames())
    assert not unknown, unknown
    return spark.createDataFrame([tuple(value(f, row.get(f.name)) for f in schema.fields) for row in rows], schema)


def statuses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ORDER_STATUS, schema_of("order_status"))


def rows(df: DataFrame, *columns: str) -> list:
    """Sorted tuples of some columns, decimals as floats."""
    found = df.select(*columns).collect() if columns else df.collect()
    plain = [tuple(float(v) if isinstance(v, Decimal) else v for v in row) for row in found]
    return sorted(plain, key=lambda row: tuple((v is None, str(v)) for v in row))


def by_key(df: DataFrame, key: str) -> dict:
    return {row[key]: row.asDict() for row in df.collect()}


PLACES = {
    "states": [
        {"state_id": 1, "name": "North State", "code": "NS", "region": "North"},
        {"state_id": 2, "name": "South State", "code": "SS", "region": "South"},
    ],
    "cities": [
        {"city_id": 10, "name": "Alpha", "state_id": 1},
        {"city_id": 20, "name": "Beta", "state_id": 2},
    ],
    "categories": [
        {"category_id": 1, "name": "Figures", "active": True},
        {"category_id": 2, "name": "Games", "active": True},
    ],
    "payment_methods": [
        {"method_id": 1, "name": "Card", "fee_pct": "2.99", "max_instalments": 12, "active": True},
        {"method_id": 2, "name": "Transfer", "fee_pct": "0", "max_instalments": 1, "active": True},
        {"method_id": 3, "name": "Cash", "fee_pct": "0", "max_instalments": 1, "active": False},
    ],
}


def shop(spark: SparkSession, **tables: list[dict]) -> Retail:
    """A shop with two places, two categories and three methods; any table can be given or replaced."""
    content = {**PLACES, **tables}
    frames = {name: make(spark, name, content[name]) for name in content}
    for name in ("customers", "products", "addresses", "orders", "order_items", "reviews", "carts", "coupons"):
        frames.setdefault(name, make(spark, name, []))
    return Retail.of(order_status=statuses(spark), **frames)

"""User-defined functions, as column expressions and as SQL functions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from brookmill.functions.dates import is_weekend
from brookmill.functions.types import as_col


# The limits of the rules, and the names they give.
HIGH_VALUE, LARGE_SUM, RARE_FROM, FREQUENT_UPTO = 100, 1000, 510, 120
FRAUD_PRICE, FRAUD_PRODUCT = 2000, 590
HIGH, LOW = "high_value", "low_value"
LARGE, RARE, FREQUENT, REGULAR = "large_purchase", "rare_product", "frequent_buyer", "regular"
FRAUD, FINE = "potential_fraud", "ok"


def simple_sql(total: str) -> str:
    """The SQL form of :func:`classify_transaction_simple`."""
    return f"CASE WHEN {total} >= {HIGH_VALUE} THEN '{HIGH}' ELSE '{LOW}' END"


def class_sql(cost: str, product: str, user: str) -> str:
    """The SQL form of :func:`classify_transaction` for known arguments."""
    return (
        f"CASE WHEN {cost} > {LARGE_SUM} THEN '{LARGE}' WHEN {product} > {RARE_FROM} THEN '{RARE}' "
        f"WHEN {user} <= {FREQUENT_UPTO} THEN '{FREQUENT}' ELSE '{REGULAR}' END"
    )


def fraud_sql(price: str, product: str, weekend: str) -> str:
    """The SQL form of :func:`detect_fraud` for known arguments."""
    return f"CASE WHEN {price} > {FRAUD_PRICE} AND {product} > {FRAUD_PRODUCT} AND {weekend} THEN '{FRAUD}' ELSE '{FINE}' END"


def total_cost_simple(price: Column | str, quantity: Column | str) -> Column:
    """Product, not rounded."""
    return as_col(price) * as_col(quantity)


def classify_transaction_simple(total: Column | str) -> Column:
    """From 100 up 'high_value', else (and for NULL) 'low_value'."""
    return F.when(as_col(total) >= HIGH_VALUE, HIGH).otherwise(LOW)


def total_cost(price: Column | str, quantity: Column | str) -> Column:
    """Product rounded to two decimals."""
    return F.round(as_col(price).cast("double") * as_col(quantity), 2)


def classify_transaction(
    price: Column | str, quantity: Column | str, product_id: Column | str, user_id: Column | str
) -> Column:
    """First rule that holds: large sum, rare product, frequent buyer, else regular.

    A row with a missing argument gets NULL: it has no class, but it stays.
    """
    price, quantity, product_id, user_id = map(as_col, (price, quantity, product_id, user_id))
    known = price.isNotNull() & quantity.isNotNull() & product_id.isNotNull() & user_id.isNotNull()
    return F.when(
        known,
        F.when(price * quantity > LARGE_SUM, LARGE)
        .when(product_id > RARE_FROM, RARE)
        .when(user_id <= FREQUENT_UPTO, FREQUENT)
        .otherwise(REGULAR),
    )


def detect_fraud(price: Column | str, product_id: Column | str, date: Column | str) -> Column:
    """High price, rare product and a weekend day together."""
    price, product_id, date = map(as_col, (price, product_id, date))
    known = price.isNotNull() & product_id.isNotNull() & date.isNotNull()
    return F.when(
        known,
        F.when((price > FRAUD_PRICE) & (product_id > FRAUD_PRODUCT) & is_weekend(date), FRAUD).otherwise(FINE),
    )


def labelled_value(c: Column | str) -> Column:
    return F.concat(F.lit("Value "), as_col(c).cast("string"))


# SQL bodies are inlined by the optimizer, so a call costs what the body costs.
_SQL_FUNCTIONS = {
    "total_cost_simple(price DOUBLE, quantity DOUBLE) RETURNS DOUBLE": "price * quantity",
    "classify_transaction_simple(total DOUBLE) RETURNS STRING": simple_sql("total"),
    "total_cost(price DOUBLE, quantity DOUBLE) RETURNS DOUBLE": "round(price * quantity, 2)",
    "classify_transaction(price DOUBLE, quantity DOUBLE, product_id BIGINT, user_id BIGINT) RETURNS STRING": (
        "CASE WHEN price IS NULL OR quantity IS NULL OR product_id IS NULL OR user_id IS NULL THEN NULL "
        f"ELSE {class_sql('price * quantity', 'product_id', 'user_id')} END"
    ),
    "detect_fraud(price DOUBLE, product_id BIGINT, day DATE) RETURNS STRING": (
        "CASE WHEN price IS NULL OR product_id IS NULL OR day IS NULL THEN NULL "
        f"ELSE {fraud_sql('price', 'product_id', 'weekday(day) >= 5')} END"
    ),
    "labelled_value(v BIGINT) RETURNS STRING": "concat('Value ', CAST(v AS STRING))",
    "yyyymm(ts TIMESTAMP_NTZ) RETURNS INT": "year(ts) * 100 + month(ts)",
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Make the functions callable from ``spark.sql``; returns their names."""
    for head, body in _SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [head.split("(")[0] for head in _SQL_FUNCTIONS]

"""Table and payload types: the only place where column types are written."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "BIGINT": T.LongType(), "INT": T.IntegerType(), "STRING": T.StringType(), "DOUBLE": T.DoubleType(),
    "FLOAT": T.FloatType(), "BOOLEAN": T.BooleanType(), "TIMESTAMP": T.TimestampType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def flat(columns: str, required: tuple[str, ...] = ()) -> T.StructType:
    """StructType of "name TYPE, name TYPE, ..."; needs no running session."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(n, _TYPES[t], n not in required) for n, t in pairs])


# The column names and types of the source tables, in source order.
DDL = {
    "users": (
        "id BIGINT, first_name STRING, last_name STRING, email STRING, age INT, "
        "gender STRING, street_address STRING, postal_code STRING, city STRING, "
        "state STRING, country STRING, latitude DOUBLE, longitude DOUBLE, "
        "traffic_source STRING, created_at TIMESTAMP, updated_at TIMESTAMP"
    ),
    "orders": (
        "order_id BIGINT, user_id BIGINT, status STRING, gender STRING, "
        "created_at TIMESTAMP, updated_at TIMESTAMP, returned_at TIMESTAMP, "
        "shipped_at TIMESTAMP, delivered_at TIMESTAMP, num_of_item INT"
    ),
    "order_items": (
        "id BIGINT, order_id BIGINT, user_id BIGINT, product_id BIGINT, "
        "inventory_item_id BIGINT, status STRING, created_at TIMESTAMP, "
        "updated_at TIMESTAMP, shipped_at TIMESTAMP, delivered_at TIMESTAMP, "
        "returned_at TIMESTAMP, sale_price DOUBLE"
    ),
    "products": (
        "id BIGINT, cost DOUBLE, category STRING, name STRING, brand STRING, "
        "retail_price DOUBLE, department STRING, sku STRING, "
        "distribution_center_id BIGINT"
    ),
    "inventory_items": (
        "id BIGINT, product_id BIGINT, created_at TIMESTAMP, sold_at TIMESTAMP, "
        "cost DOUBLE, product_category STRING, product_name STRING, "
        "product_brand STRING, product_retail_price DOUBLE, "
        "product_department STRING, product_sku STRING, "
        "product_distribution_center_id BIGINT"
    ),
    "distribution_centers": "id BIGINT, name STRING, latitude DOUBLE, longitude DOUBLE",
    "events": (
        "id BIGINT, user_id BIGINT, sequence_number INT, session_id STRING, "
        "ip_address STRING, city STRING, state STRING, postal_code STRING, "
        "browser STRING, traffic_source STRING, uri STRING, event_type STRING, "
        "created_at TIMESTAMP"
    ),
}

# Primary key, event-day column and storage layout of each table.
PRIMARY_KEY = {
    "users": ["id"],
    "orders": ["order_id"],
    "order_items": ["id"],
    "products": ["id"],
    "inventory_items": ["id"],
    "distribution_centers": ["id"],
    "events": ["id"],
}

SOURCE = {name: flat(ddl, tuple(PRIMARY_KEY[name])) for name, ddl in DDL.items()}

# Stream payload: as `events`, but the creation time arrives as text.
CLICK_PAYLOAD = T.StructType([
    T.StructField(f.name, T.StringType() if f.name == "created_at" else f.dataType, True)
    for f in SOURCE["events"].fields
])

# The nested position message.
WAYPOINT = flat(
    "vehicle STRING, driver STRING, speed FLOAT, datetime INT, x DOUBLE, y DOUBLE, "
    "z FLOAT, heading FLOAT, ignition BOOLEAN, aircon BOOLEAN, door_up BOOLEAN, "
    "door_down BOOLEAN, sos BOOLEAN, working BOOLEAN, analog1 FLOAT, analog2 FLOAT"
)
GPS_PAYLOAD = T.StructType([
    T.StructField("msgType", T.StringType(), True),
    T.StructField("msgBusWayPoint", WAYPOINT, True),
])
# The serving path keeps every value as text, so a bad number stays visible.
GPS_PAYLOAD_TEXT = T.StructType([
    T.StructField("msgType", T.StringType(), True),
    T.StructField("msgBusWayPoint", T.StructType([
        T.StructField(f.name, T.StringType(), True) for f in WAYPOINT.fields
    ]), True),
])

GOLD = {
    "sales_performance": flat(
        "order_date TIMESTAMP, product_category STRING, total_revenue DOUBLE, "
        "total_items_sold BIGINT, updated_at TIMESTAMP"),
    "user_statistics": flat(
        "user_id BIGINT, total_orders BIGINT, total_items_purchased BIGINT, "
        "total_spend DOUBLE, total_events BIGINT, last_order_at TIMESTAMP, "
        "last_event_at TIMESTAMP, updated_at TIMESTAMP"),
    "user_engagement": flat(
        "user_id BIGINT, event_count BIGINT, last_event_at TIMESTAMP, "
        "updated_at TIMESTAMP"),
}

RUN_RECORD = flat(
    "engine STRING, query_name STRING, run_type STRING, run_number INT, "
    "query_id STRING, status STRING, query_time_seconds DOUBLE, "
    "throughput_qps DOUBLE, peak_memory_bytes BIGINT, spill_bytes BIGINT, "
    "cpu_time_millis BIGINT, result_hash STRING, row_count BIGINT, "
    "error_message STRING"
)


def _business_fields(name: str) -> list[T.StructField]:
    return [
        T.StructField("source_updated_at" if f.name == "updated_at" else f.name, f.dataType, True)
        for f in SOURCE[name].fields
    ]


def silver_schema(name: str) -> T.StructType:
    """Business columns of a source table as kept in the silver layer (the
    audit stamp `updated_at` is added by the job)."""
    return T.StructType(_business_fields(name))


def bronze_schema(name: str) -> T.StructType:
    """Business columns plus the load stamp of the bronze layer."""
    return T.StructType(_business_fields(name) + [T.StructField("load_at", T.TimestampType(), True)])

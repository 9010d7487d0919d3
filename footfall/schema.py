"""Input and output schemas, and the by-name read contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


# Column names, order and types of the tables users already have.
USER_VISIT_ACTION = _struct(
    ("date", StringType()),
    ("user_id", LongType()),
    ("session_id", StringType()),
    ("page_id", LongType()),
    ("action_time", StringType()),
    ("search_keyword", StringType()),
    ("click_category_id", LongType()),
    ("click_product_id", LongType()),
    ("order_category_ids", StringType()),
    ("order_product_ids", StringType()),
    ("pay_category_ids", StringType()),
    ("pay_product_ids", StringType()),
    ("city_id", LongType()),
)
USER_INFO = _struct(
    ("user_id", LongType()),
    ("username", StringType()),
    ("name", StringType()),
    ("age", IntegerType()),
    ("professional", StringType()),
    ("gender", StringType()),
)
PRODUCT_INFO = _struct(
    ("product_id", LongType()),
    ("product_name", StringType()),
    ("extend_info", StringType()),
)
CITY_INFO = _struct(
    ("city_id", LongType()),
    ("city_name", StringType()),
    ("area", StringType()),
)

# The result tables.
SESSION_STAT_INFO = _struct(
    ("task_id", StringType()),
    ("condition_json", StringType()),
    ("session_count", LongType()),
    ("visit_length_gt_10_ratio", DoubleType()),
    ("visit_length_le_10_ratio", DoubleType()),
    ("step_length_gt_5_ratio", DoubleType()),
    ("step_length_le_5_ratio", DoubleType()),
)
RANDOM_SESSION_INFO = _struct(
    ("taskId", StringType()),
    ("sessionId", StringType()),
    ("startTime", StringType()),
    ("stepLength", LongType()),
    ("visitLength", LongType()),
    ("searchKeyWords", StringType()),
    ("clickProductIds", StringType()),
    ("orderProductIds", StringType()),
    ("payProductIds", StringType()),
)
CATEGORY_TOP10 = _struct(
    ("taskId", StringType()),
    ("category_id", StringType()),
    ("click_count", LongType()),
    ("order_count", LongType()),
    ("pay_count", LongType()),
)
CATEGORY_TOP10_SESSION_COUNT = _struct(
    ("taskId", StringType()),
    ("categoryId", StringType()),
    ("sessionId", StringType()),
    ("clickCount", LongType()),
)
PAGE_CONVERT_RATE = _struct(
    ("taskId", StringType()),
    ("step", IntegerType()),
    ("from_page", LongType()),
    ("to_page", LongType()),
    ("views", LongType()),
    ("conversions", LongType()),
    ("conversion_rate", DoubleType()),
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Pick the schema's columns by name, in its order, cast to its types.

    Extra columns are dropped; a missing one is an error.
    """
    types = columns_of(df, schema)
    return df.select(
        [
            f.name
            if types.get(f.name) == f.dataType
            else F.col(f.name).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def columns_of(df: DataFrame, schema: StructType) -> dict[str, DataType]:
    """The types of the frame's columns by name; an error if it lacks one of the schema."""
    present = {name.lower() for name in df.columns}
    missing = [f.name for f in schema if f.name.lower() not in present]
    if missing:
        raise ValueError(f"input lacks column(s): {', '.join(missing)}")
    return {field.name: field.dataType for field in df.schema}

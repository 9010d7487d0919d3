"""What an action is.

Two classifiers exist and they differ on purpose: categories are counted by
click, then order, then pay, with empty lists ignored; a session's product
lists look at the keyword first and treat an empty text as present.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from footfall.functions.text import split_ids

# Fixed value: the id that stands for "not a click".
NOT_A_CLICK = -1


def _has_ids(name: str) -> Column:
    return F.col(name).isNotNull() & (F.length(name) > 0)


def is_click() -> Column:
    return F.col("click_category_id") != NOT_A_CLICK


def is_order() -> Column:
    return _has_ids("order_category_ids")


def is_pay() -> Column:
    return _has_ids("pay_category_ids")


def category_kind() -> Column:
    return (
        F.when(is_click(), "click").when(is_order(), "order").when(is_pay(), "pay")
    )


def category_ids() -> Column:
    """Category ids, as text, that the action counts towards."""
    return (
        F.when(is_click(), F.array(F.col("click_category_id").cast("string")))
        .when(is_order(), split_ids(F.col("order_category_ids")))
        .when(is_pay(), split_ids(F.col("pay_category_ids")))
    )


def _is_product_click() -> Column:
    return F.col("click_product_id") != NOT_A_CLICK


def product_kind() -> Column:
    return (
        F.when(F.col("search_keyword").isNotNull(), "keyword")
        .when(_is_product_click(), "click")
        .when(F.col("order_product_ids").isNotNull(), "order")
        .when(F.col("pay_product_ids").isNotNull(), "pay")
    )


def product_value() -> Column:
    """The text the action adds to its session's list."""
    return (
        F.when(F.col("search_keyword").isNotNull(), F.col("search_keyword"))
        .when(_is_product_click(), F.col("click_product_id").cast("string"))
        .when(F.col("order_product_ids").isNotNull(), F.col("order_product_ids"))
        .when(F.col("pay_product_ids").isNotNull(), F.col("pay_product_ids"))
    )

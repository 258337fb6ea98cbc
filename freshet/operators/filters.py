"""Row filters and projections over change rows and log rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.maps import fields

DIM_TYPES = ("insert", "update", "delete", "bootstrap-insert")
FACT_TYPES = ("insert", "update")


def dim_changes(changes: DataFrame, database: str) -> DataFrame:
    """Change rows that may alter a dimension: right database, type and payload."""
    return changes.where(
        (F.col("database") == database)
        & F.col("type").isin(*DIM_TYPES)
        & (F.size("data") > 0)
    )


def fact_changes(changes: DataFrame, database: str) -> DataFrame:
    """Change rows that may become fact rows."""
    return changes.where(
        (F.col("database") == database) & F.col("type").isin(*FACT_TYPES)
    )


def of_table(changes: DataFrame, database: str, table: str, kind: str) -> DataFrame:
    return changes.where(
        (F.col("database") == database)
        & (F.col("table") == table)
        & (F.col("type") == kind)
    )


def inserts(
    changes: DataFrame, database: str, table: str, names: Mapping[str, str]
) -> DataFrame:
    """Inserted rows of one table as columns ``names`` plus ``ts`` and ``et``."""
    return of_table(changes, database, table, "insert").select(
        *fields(F.col("data"), names), "ts", "et"
    )


def transitions(
    changes: DataFrame,
    database: str,
    table: str,
    names: Mapping[str, str],
    field: str,
    to: str,
    from_: str | None = None,
) -> DataFrame:
    """Updates that set ``field`` to ``to``, from ``from_`` or from anything."""
    before = F.col("old")[field]
    moved = before.isNotNull() if from_ is None else before == from_
    return (
        of_table(changes, database, table, "update")
        .where(moved & (F.col("data")[field] == to))
        .select(*fields(F.col("data"), names), "ts", "et")
    )


def cart_additions(changes: DataFrame, database: str) -> DataFrame:
    """Goods put into a cart: a new line, or a line whose quantity grew.

    ``sku_num`` is the new quantity of a new line and the quantity before the
    change of a grown line; ``sku_num_added`` is how many were added.
    """
    new = F.col("data")["sku_num"].try_cast("int")
    old = F.col("old")["sku_num"].try_cast("int")
    inserted = F.col("type") == "insert"
    grown = (F.col("type") == "update") & old.isNotNull() & (new > old)
    return changes.where(
        (F.col("database") == database)
        & (F.col("table") == "cart_info")
        & (inserted | grown)
    ).select(
        *fields(F.col("data"), {"id": "id", "user_id": "user_id", "sku_id": "sku_id"}),
        F.when(inserted, new).otherwise(old).alias("sku_num"),
        F.when(inserted, new).otherwise(new - old).alias("sku_num_added"),
        "ts",
        "et",
    )


def search_phrases(pages: DataFrame) -> DataFrame:
    """Page views that came from a keyword search: ``phrase`` and ``et``."""
    page = F.col("page")
    return pages.where(
        page["last_page_id"].isin("search", "home")
        & (page["item_type"] == "keyword")
        & page["item"].isNotNull()
    ).select(page["item"].alias("phrase"), "et")


def is_login() -> Column:
    """A page view by a known user arriving from the login page."""
    return F.col("common")["uid"].isNotNull() & (
        F.col("page")["last_page_id"] == "login"
    )

"""The menu: catalog variations with the ids a business uses for them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from starledger.operators.quality import duplicate_keys, null_counts

# Columns of the mapping file and of the menu, in order.
MAPPING_COLUMNS = {
    "BusinessMenuID": "business_menu_id",
    "BusinessCategoryID": "business_category_id",
    "ItemID": "mapping_item_id",
    "VariationID": "mapping_variation_id",
}
MENU_COLUMNS = (
    "business_menu_id",
    "business_category_id",
    "item_name",
    "description",
    "variation_name",
    "sku",
    "category_id",
    "item_id",
    "variation_id",
    "price_amount",
    "price_currency",
    "is_taxable",
    "product_type",
)


def trim_mapping(mapping: DataFrame, columns: Mapping[str, str] = MAPPING_COLUMNS) -> DataFrame:
    """The mapping file's key columns, trimmed and renamed. ``columns`` gives the header's names and ours."""
    if set(columns.values()) != set(MAPPING_COLUMNS.values()):
        raise ValueError(f"columns must name {sorted(MAPPING_COLUMNS.values())}")
    return mapping.select(*[F.trim(F.col(old)).alias(new) for old, new in columns.items()])


def join_menu_mapping(variations: DataFrame, mapping: DataFrame) -> DataFrame:
    """Variations with their business ids, on item and variation together; unmapped ones keep NULL ids."""
    same = (F.col("item_id") == F.col("mapping_item_id")) & (F.col("variation_id") == F.col("mapping_variation_id"))
    return variations.join(mapping, same, "left")


def final_menu(joined: DataFrame) -> DataFrame:
    return joined.select(*MENU_COLUMNS)


def menu_gaps(menu: DataFrame) -> DataFrame:
    """One row: menu rows, and rows missing each of the ids."""
    return null_counts(
        menu, ["business_menu_id", "business_category_id", "category_id", "item_id", "variation_id"]
    )


def menu_duplicates(menu: DataFrame) -> DataFrame:
    """One row: business and variation id pairs that occur more than once."""
    return duplicate_keys(menu, ["business_menu_id", "variation_id"])

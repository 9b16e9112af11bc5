"""Catalogue lookups and the per-item gate (inactive / already right / to treat)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slugmend.functions.slug import evaluated_once, normalize_slug
from slugmend.functions.text import template
from slugmend.operators.lookup import lookup
from slugmend.operators.outcomes import failures_of
from slugmend.schemas import (
    EMPTY_SLUG,
    ERRO_API,
    MSG_DETAILS_FAILED,
    MSG_LOOKUP_FAILED,
    MSG_UNHANDLED,
    NOT_FOUND_PRODUCT,
    NOT_FOUND_SKU,
    PULADO_INATIVO,
    PULADO_JA_CORRIGIDO,
    READ_PRODUCT,
    READ_SKU,
)

TREAT = "TRATAR"


def sku_products(catalog: DataFrame) -> DataFrame:
    """SKU -> product map ``(sku_id, product_id)``, one row per SKU."""
    return catalog.groupBy(F.col("sku_id").cast("string").alias("sku_id")).agg(
        F.min("product_id").alias("product_id")
    )


def products(catalog: DataFrame) -> DataFrame:
    """Product details ``(product_id, link_id, is_active)``, one row per product.

    Where a product's rows disagree, link and flag come from one row: the one
    with the smallest link (null last), then an inactive flag before an active one.
    """
    row = F.struct(
        F.col("link_id").isNull().alias("no_link"), "link_id", F.col("is_active").isNull().alias("no_flag"), "is_active"
    )
    return catalog.groupBy("product_id").agg(F.min(row).alias("_row")).select(
        "product_id", "_row.link_id", "_row.is_active"
    )


def rows_for_products(catalog: DataFrame, product_ids: DataFrame) -> DataFrame:
    """Every catalogue row of the given products (a semi join)."""
    return catalog.join(product_ids.select("product_id").distinct(), "product_id", "left_semi")


def catalog_lookup(
    items: DataFrame, catalog: DataFrame, sku_col: str = "sku_id", failures: DataFrame | None = None,
    one_row_per_sku: bool = False,
) -> DataFrame:
    """SKU -> product -> (link, active) for each item, with lookup errors.

    The catalogue is first cut to the items' SKUs and then to all rows of
    their products (semi joins), so the per-SKU and per-product aggregates
    shuffle what the items touch. SKUs are compared as text on both sides. A
    miss or a failed read (``failures``: kind, key, msg) at either step is an
    ``ERRO_API`` message. Items without a product meet no details and are
    spread over tasks by their SKU instead of sharing the null key; those of a SKU or
    product that many items share are dealt over salts (``operators.lookup``). ``one_row_per_sku``: the caller knows that no
    SKU is shared, so none is looked for.
    """
    own = items.withColumn("_sku", F.col(sku_col).cast("string"))
    cat = catalog.withColumn("sku_id", F.col("sku_id").cast("string"))
    wanted = own.select(F.col("_sku").alias("sku_id")).distinct()
    sku_map = sku_products(cat.join(wanted, "sku_id", "left_semi"))
    details = products(rows_for_products(cat, sku_map)).select(
        F.col("product_id").cast("string").alias("_pkey"), "link_id", "is_active", F.lit(True).alias("_known")
    )
    sku_failed = failures_of(failures, READ_SKU, "_sku", "_sku_failed", items)
    product_failed = failures_of(failures, READ_PRODUCT, "_pkey", "_product_failed", items)
    sku_map = sku_map.withColumnRenamed("sku_id", "_sku")
    mapped = own.join(sku_map, "_sku", "left") if one_row_per_sku else lookup(own, sku_map, "_sku")
    mapped = mapped.join(sku_failed, "_sku", "left")
    mapped = mapped.withColumn("product_id", F.when(F.col("_sku_failed").isNull(), F.col("product_id")))
    mapped = mapped.withColumn(
        "_pkey", F.coalesce(F.col("product_id").cast("string"), F.concat(F.lit("no product: "), F.col("_sku")))
    )
    full = lookup(mapped, details, "_pkey").join(product_failed, "_pkey", "left")
    sku_miss = F.col("product_id").isNull()
    unread = F.col("_product_failed").isNotNull() | F.col("_known").isNull()
    read = ~sku_miss & ~unread
    return full.select(
        *items.columns,
        "product_id",
        F.when(read, F.col("link_id")).alias("link_id"),
        F.when(read, F.col("is_active")).alias("is_active"),
        (~read).alias("erro"),
        F.when(sku_miss, template(MSG_LOOKUP_FAILED, F.coalesce("_sku_failed", F.lit(NOT_FOUND_SKU))))
        .when(unread, template(MSG_DETAILS_FAILED, F.coalesce("_product_failed", F.lit(NOT_FOUND_PRODUCT))))
        .alias("mensagem"),
    )


def gate_column(link: Column, slug_norm: Column, active: Column) -> Column:
    """Inactive (null counts as inactive) -> empty slug -> already right -> treat."""
    return (
        F.when(~F.coalesce(active, F.lit(False)), F.lit(PULADO_INATIVO))
        .when(slug_norm.isNull() | (slug_norm == ""), F.lit(ERRO_API))
        .when(link == slug_norm, F.lit(PULADO_JA_CORRIGIDO))
        .otherwise(F.lit(TREAT))
    )


def empty_slug_message() -> Column:
    """Text logged when a link normalises to nothing."""
    return template(MSG_UNHANDLED, F.lit("ValueError"), F.lit(EMPTY_SLUG))


def slug_gate(catalog: DataFrame) -> DataFrame:
    """Gate every catalogue SKU before any write would happen."""
    norm = normalize_slug(F.col("link_id"))
    return catalog.select(
        F.col("sku_id").cast("string").alias("sku_id"),
        "product_id",
        "is_active",
        F.col("link_id").alias("slug_original"),
        evaluated_once(norm).alias("slug_normalizado"),
    ).withColumn(
        "gate", gate_column(F.col("slug_original"), F.col("slug_normalizado"), F.col("is_active"))
    )

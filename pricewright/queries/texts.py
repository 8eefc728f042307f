"""Cleaning and extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewright import fixed
from pricewright.functions import text as X
from pricewright.operators.features import DETAILED_TEXTS, LABELLED_TEXTS, length_features
from pricewright.operators.parse import parse_detailed, parse_labelled
from pricewright.queries import sql as Q
from pricewright.queries.registry import query
from pricewright.session import new_table_path
from pricewright.sources.catalog import quick_subset, read_catalog, write_catalog
from pricewright.sources.tables import catalog, table


@query("catalog_csv_scan", f"WITH {Q.CATALOG} SELECT sample_id, catalog_content, image_link, price FROM catalog")
def catalog_csv_scan(spark, sf):
    """The catalog written as CSV and scanned back: line ends and quotes inside fields survive."""
    return read_catalog(spark, write_catalog(catalog(spark, sf), new_table_path(spark, "csv")))


@query("quick_subset", f"WITH {Q.CATALOG} SELECT sample_id, price FROM catalog ORDER BY sample_id LIMIT 1000")
def quick(spark, sf):
    return quick_subset(catalog(spark, sf).select("sample_id", "price"), 1000)


@query("clean_text", f"""
SELECT 'document' AS kind, doc_id AS id, {Q.clean('text')} AS cleaned FROM documents
UNION ALL SELECT 'page', page_id, {Q.clean('html')} FROM pages""")
def clean_text(spark, sf):
    docs = table(spark, sf, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), X.clean_text(F.col("text")).alias("cleaned"))
    pages = table(spark, sf, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), X.clean_text(F.col("html")).alias("cleaned"))
    return docs.unionByName(pages)


@query("clean_text_500", f"""
SELECT doc_id, substr(trim(regexp_replace(regexp_replace(coalesce(text, ''), '{Q.SPACE}+', ' ', 'g'), '[^\\x00-\\x7F]', '', 'g')), 1, 500) AS cleaned
FROM documents""")
def clean_text_500(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.clean_text_short(F.col("text")).alias("cleaned"))


def _labelled(name: str, *columns: str):
    sql = f"WITH {Q.LABELLED} SELECT sample_id, {', '.join(columns)} FROM parsed"
    query(name, sql)(lambda spark, sf: parse_labelled(catalog(spark, sf)).select("sample_id", *columns))


_labelled("extract_item_name", "item_name")
_labelled("extract_brand", "brand")
_labelled("extract_pack_count", "pack_count")
_labelled("extract_description", "description")


def _detailed(name: str, *columns: str):
    """The same fields of both modes, side by side in rows."""
    picked = ", ".join(columns)
    sql = f"WITH {Q.BOTH} SELECT 'flat' AS mode, sample_id, {picked} FROM flat UNION ALL SELECT 'lines', sample_id, {picked} FROM lines"

    def run(spark, sf):
        rows = catalog(spark, sf)
        flat, lines = (
            parse_detailed(rows, mode).select(F.lit(mode).alias("mode"), "sample_id", *columns) for mode in ("flat", "lines")
        )
        return flat.unionByName(lines)

    query(name, sql)(run)


_detailed("extract_item_name_flat", "item_name", "brand")
_detailed("extract_bullets", "bullet_points_text")
_detailed("extract_product_description", "product_description")
_detailed("extract_unit", "unit")
_detailed("extract_weight", "spec_weight_value", "spec_weight_unit")
_detailed("extract_spec_pack", "spec_pack_count")
_detailed("category_flags", *[f"category_{c}" for c in fixed.CATEGORY_KEYWORDS])


@query("extract_value", f"""
WITH {Q.LABELLED}, raw AS (SELECT sample_id, price, image_link, coalesce(catalog_content, '') AS content FROM catalog),
{Q.detailed('raw', 'fields')}
SELECT sample_id, p.value AS value, f.value AS value_any_case FROM parsed p JOIN fields f USING (sample_id)""")
def extract_value(spark, sf):
    """Case-sensitive in the labelled extraction, not so in the detailed one."""
    content = F.col("catalog_content")
    return catalog(spark, sf).select(
        "sample_id", X.labelled_value(X.labelled_window(content)).alias("value"),
        X.detailed_value(X.or_empty(content)).alias("value_any_case"),
    )


@query("detect_categories", "SELECT doc_id, array_to_string(list_filter([" + ", ".join(
    "CASE WHEN " + " OR ".join(f"contains(lower(coalesce(text, '')), '{w}')" for w in words) + f" THEN '{name}' END"
    for name, words in fixed.CATEGORY_KEYWORDS.items()) + "], lambda c: c IS NOT NULL), ',') AS categories FROM documents")
def detect_categories(spark, sf):
    found = X.detect_categories(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.array_join(found, ",").alias("categories"))


@query("image_link_features", f"""
WITH {Q.CATALOG}, links AS (
  SELECT 'catalog' AS kind, sample_id AS id, image_link AS link FROM catalog
  UNION ALL SELECT 'page', page_id, url FROM pages)
SELECT kind, id, CAST(coalesce(starts_with(link, 'http'), false) AS INT) AS image_link_valid,
  CAST(length(coalesce(link, 'nan')) AS INT) AS image_url_length FROM links""")
def image_link_features(spark, sf):
    links = catalog(spark, sf).select(F.lit("catalog").alias("kind"), F.col("sample_id").alias("id"), F.col("image_link").alias("link"))
    urls = table(spark, sf, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("url").alias("link"))
    link = F.col("link")
    return links.unionByName(urls).select(
        "kind", "id", X.image_link_valid(link).alias("image_link_valid"), X.image_url_length(link).alias("image_url_length")
    )


@query("catalog_defaults", f"""
WITH {Q.CATALOG} SELECT sample_id, '' AS item_name, '' AS description, CAST(NULL AS DOUBLE) AS value, '' AS brand,
  CAST(1 AS BIGINT) AS pack_count FROM catalog""")
def catalog_defaults(spark, sf):
    """Rows without a content column still get every parsed field."""
    bare = catalog(spark, sf).select("sample_id")
    return parse_labelled(bare).select("sample_id", "item_name", "description", "value", "brand", "pack_count")


@query("combine_text", f"""
WITH {Q.LABELLED}, raw AS (SELECT sample_id, price, image_link, coalesce(catalog_content, '') AS content FROM catalog),
{Q.detailed('raw', 'fields')}
SELECT sample_id, p.item_name || ' ' || p.description AS labelled,
  f.item_name || ' ' || f.bullet_points_text || ' ' || f.product_description AS detailed
FROM parsed p JOIN fields f USING (sample_id)""")
def combine_text(spark, sf):
    rows = catalog(spark, sf)
    content = F.col("catalog_content")
    window = X.labelled_window(content)
    return rows.select(
        "sample_id",
        X.combine_labelled(X.labelled_item_name(window), X.labelled_description(window)).alias("labelled"),
        X.combine_detailed(X.detailed_item_name(content), X.detailed_bullets(content), X.detailed_description(content)).alias("detailed"),
    )


@query("length_features", f"""
WITH {Q.BOTH} SELECT sample_id, """ + ", ".join(
    f"CAST(length({c}) AS INT) AS {c}_length, {Q.words(c)} AS {c}_word_count" for c in DETAILED_TEXTS) + " FROM flat")
def lengths(spark, sf):
    rows = length_features(parse_detailed(catalog(spark, sf)), DETAILED_TEXTS, ("length", "word_count"))
    return rows.select("sample_id", *[f"{c}_{s}" for c in DETAILED_TEXTS for s in ("length", "word_count")])


@query("length_features_labelled", f"""
WITH {Q.LABELLED} SELECT sample_id, """ + ", ".join(
    f"CAST(length({c}) AS INT) AS {c}_len, {Q.words(c)} AS {c}_words" for c in LABELLED_TEXTS) + " FROM parsed")
def lengths_labelled(spark, sf):
    rows = length_features(parse_labelled(catalog(spark, sf)), LABELLED_TEXTS, ("len", "words"))
    return rows.select("sample_id", *[f"{c}_{s}" for c in LABELLED_TEXTS for s in ("len", "words")])



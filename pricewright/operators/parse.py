"""From a catalog row to typed fields: one projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewright import fixed
from pricewright.functions import text as T


def parse_labelled(
    df: DataFrame, content: str = "catalog_content", max_chars: int | None = None, max_name_chars: int | None = None, max_parts: int | None = None
) -> DataFrame:
    """item_name, description, value, brand, pack_count of the labelled extraction, from the whole text.

    For trials, ``max_chars`` reads the beginning of a text only, ``max_name_chars`` cuts the item name and
    ``max_parts`` keeps the first parts of the description (``fixed.TRIAL_CUTS``).  A frame without the content column gets the defaults of an empty text.
    """
    if content not in df.columns:
        missing = {
            "item_name": F.lit(""), "description": F.lit(""), "value": F.lit(None).cast("double"),
            "brand": F.lit(""), "pack_count": F.lit(1).cast("bigint"),
        }
        return df.withColumns({c: v for c, v in missing.items() if c not in df.columns})
    window = T.labelled_window(F.col(content), max_chars)
    return (
        df.withColumns({
            "item_name": T.labelled_item_name(window, max_name_chars),
            "description": T.labelled_description(window, max_parts),
            "value": T.labelled_value(window),
            "pack_count": T.labelled_pack_count(window),
        })
        .withColumn("brand", T.first_word(F.col("item_name")))
    )


def parse_detailed(df: DataFrame, mode: str = "flat", content: str = "catalog_content") -> DataFrame:
    """The detailed extraction: fields, weight and pack, category flags, link features.

    ``flat`` cleans the text first, which removes the line ends, so that a field runs to the end of the
    text.  ``lines`` extracts from the raw text, line by line.
    """
    if mode not in ("flat", "lines"):
        raise ValueError("mode is 'flat' or 'lines'")
    out = df.withColumn("catalog_content_clean", T.clean_text(F.col(content)))
    source = F.col("catalog_content_clean") if mode == "flat" else T.or_empty(F.col(content))
    out = out.withColumns({
        "item_name": T.detailed_item_name(source),
        "bullet_points_text": T.detailed_bullets(source),
        "product_description": T.detailed_description(source),
        "value": T.detailed_value(source),
        "unit": T.detailed_unit(source),
        "spec_weight_value": T.weight_value(source),
        "spec_weight_unit": T.weight_unit(source),
        "spec_pack_count": T.detailed_pack_count(source),
        **{f"category_{c}": T.has_category(source, c).cast("int") for c in fixed.CATEGORY_KEYWORDS},
    }).withColumn("brand", T.first_word(F.col("item_name")))
    if "image_link" in df.columns:
        link = F.col("image_link")
        out = out.withColumns({"image_link_valid": T.image_link_valid(link), "image_url_length": T.image_url_length(link)})
    return out

"""Fragments of the SQL twins, written for DuckDB."""

from __future__ import annotations

from pricewright import fixed
from pricewright.sources.tables import CATALOG_SQL, LINE_SQL

CATALOG = "catalog AS (" + CATALOG_SQL.format(part="part") + ")"
LINE = "line AS (" + LINE_SQL.format(part="part", lineitem="lineitem") + ")"

# Unicode whitespace and the four separators, spelled out for RE2.
SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NON_SPACE = SPACE.replace("[", "[^", 1)


def clean(x: str) -> str:
    x = f"regexp_replace(coalesce({x}, ''), '{SPACE}+', ' ', 'g')"
    x = f"regexp_replace({x}, '[^\\x00-\\x7F]', '', 'g')"
    return f"trim(regexp_replace({x}, '<[^>]+>', '', 'g'))"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '\\A{SPACE}+|{SPACE}+\\z', '', 'g')"


def find(x: str, pattern: str, group: int = 1, ignore_case: bool = True) -> str:
    return f"regexp_extract({x}, '{'(?i)' if ignore_case else ''}{pattern}', {group})"


def find_all(x: str, pattern: str) -> str:
    return f"regexp_extract_all({x}, '(?i){pattern}', 1)"


def first_word(x: str) -> str:
    return f"regexp_extract({x}, '\\A{SPACE}*({NON_SPACE}+)', 1)"


def words(x: str) -> str:
    return f"CAST(len(regexp_extract_all(coalesce({x}, ''), '{NON_SPACE}+')) AS INT)"


def fold(x: str, k: int, seed: str = "") -> str:
    return f"CAST(('0x' || substr(md5('{seed}' || CAST({x} AS VARCHAR)), 1, 8))::BIGINT % {k} AS INT)"


# Fields of the labelled extraction over the catalog.
WINDOW = "coalesce(catalog_content, '')"
LABELLED = f"""{CATALOG},
labelled AS (
  SELECT sample_id, price, image_link,
    {strip(find(WINDOW, fixed.ITEM_NAME_OR_EMPTY))} AS item_name,
    array_to_string({find_all(WINDOW, fixed.BULLET_OR_DESCRIPTION)}, ' ') AS description,
    TRY_CAST({find(WINDOW, fixed.VALUE, 1, False)} AS DOUBLE) AS value,
    coalesce(TRY_CAST({find(WINDOW, fixed.PACK_OR_COUNT)} AS BIGINT), 1) AS pack_count
  FROM catalog
),
parsed AS (SELECT *, {first_word('item_name')} AS brand FROM labelled)"""


def detailed(source: str, name: str, content: str = "content") -> str:
    """A CTE with the fields of the detailed extraction over ``source.content``."""
    flags = ", ".join(
        "CAST(" + " OR ".join(f"contains(lower({content}), '{w}')" for w in kws) + f" AS INT) AS category_{c}"
        for c, kws in fixed.CATEGORY_KEYWORDS.items()
    )
    return f"""{name} AS (
  SELECT sample_id, price, image_link,
    {clean(find(content, fixed.ITEM_NAME))} AS item_name,
    array_to_string(list_transform({find_all(content, fixed.BULLET_POINT)}, lambda b: {clean('b')}), ' ') AS bullet_points_text,
    {clean(find(content, fixed.PRODUCT_DESCRIPTION))} AS product_description,
    TRY_CAST({find(content, fixed.VALUE)} AS DOUBLE) AS value,
    {clean(find(content, fixed.UNIT))} AS unit,
    TRY_CAST({find(content, fixed.WEIGHT, 1)} AS DOUBLE) AS spec_weight_value,
    nullif(lower({find(content, fixed.WEIGHT, 2)}), '') AS spec_weight_unit,
    TRY_CAST({find(content, fixed.PACK_OF_OR_COUNT)} AS BIGINT) AS spec_pack_count,
    {flags}
  FROM {source}
)"""


FLAT = f"""{CATALOG},
cleaned AS (SELECT sample_id, price, image_link, {clean('catalog_content')} AS content FROM catalog),
{detailed('cleaned', 'fields')},
flat AS (SELECT *, {first_word('item_name')} AS brand FROM fields)"""

LINES = f"""{CATALOG},
raw AS (SELECT sample_id, price, image_link, coalesce(catalog_content, '') AS content FROM catalog),
{detailed('raw', 'fields_of_lines')},
lines AS (SELECT *, {first_word('item_name')} AS brand FROM fields_of_lines)"""

BOTH = FLAT + ", " + LINES.removeprefix(CATALOG + ",")


def metrics(y: str, p: str, digits: int = 4) -> str:
    half = f"((abs({y}) + abs({p})) / 2)"
    parts = {
        "smape": f"coalesce(avg(abs({y} - {p}) / CASE WHEN {half} = 0 THEN 1e-8 ELSE {half} END) * 100, 0)",
        "mae": f"avg(abs({y} - {p}))",
        "rmse": f"sqrt(avg(({y} - {p}) * ({y} - {p})))",
        "r2": f"CASE WHEN min({y}) = max({y}) THEN CASE WHEN sum(({y} - {p}) * ({y} - {p})) = 0 THEN 1 ELSE 0 END "
              f"ELSE 1 - sum(({y} - {p}) * ({y} - {p})) / (var_pop({y}) * count({y})) END",
        "mape": f"avg(abs(({y} - {p}) / CASE WHEN {y} = 0 THEN 1e-8 ELSE {y} END)) * 100",
        "max_error": f"max(abs({y} - {p}))",
        "mean_prediction": f"avg({p})",
        "std_prediction": f"stddev_pop({p})",
    }
    # Prices are cents over a small number, so the largest error may end in a 5 after up to seven digits.
    return ", ".join(f"round({e}, {8 if n == 'max_error' else digits}) AS {n}" for n, e in parts.items())

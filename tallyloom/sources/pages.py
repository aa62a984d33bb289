"""Captured pages: structured data, inline values, pagination, options, combinations."""

from __future__ import annotations

import html
import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRUCTURED = T.StructType([T.StructField(n, T.StringType()) for n in ("name", "brand", "sku", "gtin", "description", "price")])
COMBINATION = "array<struct<attributes:map<string,string>,reference:string,ean13:string>>"
_SCRIPT = re.compile(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>")
# Texts of an option that is no choice.
PLACEHOLDER = re.compile(r"(?i)^(?:elige|elegir|selecciona|choose|select|opci[oó]n|-+|\.{3})")


def _products(node):
    """Every Product of a structured document, inside lists and @graph too."""
    if isinstance(node, list):
        for x in node:
            yield from _products(x)
    elif isinstance(node, dict):
        kinds = node.get("@type")
        if "Product" in (kinds if isinstance(kinds, list) else [kinds]):
            yield node
        yield from _products(node.get("@graph", []))


def product_of(page: str | None) -> dict | None:
    """The first Product of a page's structured data; documents that do not parse are skipped."""
    for text in _SCRIPT.findall(page or ""):
        try:
            found = next(_products(json.loads(html.unescape(text.strip()))), None)
        except ValueError:
            continue
        if found:
            brand, offers = found.get("brand"), found.get("offers")
            offers = offers[0] if isinstance(offers, list) and offers else offers
            text_of = lambda v: None if v is None else str(v)
            return {
                "name": text_of(found.get("name")), "brand": text_of(brand.get("name") if isinstance(brand, dict) else brand), "sku": text_of(found.get("sku")), "gtin": text_of(found.get("gtin13") or found.get("gtin")),
                "description": text_of(found.get("description")), "price": text_of(offers.get("price")) if isinstance(offers, dict) else None,
            }
    return None


@F.pandas_udf(STRUCTURED)
def structured_product(pages: pd.Series) -> pd.DataFrame:
    rows = [product_of(p) or {} for p in pages]
    return pd.DataFrame({n: pd.Series([r.get(n) for r in rows], dtype="object") for n in STRUCTURED.fieldNames()})


def inline_value(page: Column, name: str) -> Column:
    """The text or number an inline script gives a name: `name = 'x'`, `"name": "x"`, `name: 12.5`; null where none does."""
    pattern = rf"(?s)[\"']?\b{re.escape(name)}\b[\"']?\s*[:=]\s*(?:\"((?:[^\"\\]|\\.)*)\"|'((?:[^'\\]|\\.)*)'|(-?\d+(?:\.\d+)?))"
    return F.coalesce(*[F.nullif(F.regexp_extract(page, pattern, i), F.lit("")) for i in (1, 2, 3)])


def next_page(page: Column, current: Column) -> Column:
    """Number of the following page: from a `rel=next` link, or from `X - Y de Z` while Y is under Z; null on the last."""
    linked = F.regexp_extract(page, r"(?is)<(?:a|link)\b(?=[^>]*rel=[\"']next[\"'])[^>]*[?&](?:p|page)=(\d+)", 1).try_cast("int")
    upto, of = (F.regexp_extract(page, r"(?i)(\d+)\s*-\s*(\d+)\s+(?:de|of)\s+(\d+)", i).try_cast("int") for i in (2, 3))
    return F.when(linked > current, linked).when(linked.isNull() & (upto < of), current + 1)


@F.pandas_udf(T.MapType(T.StringType(), T.ArrayType(T.StringType())))
def options(pages: pd.Series) -> pd.Series:
    """Dimension -> choices of the fieldsets and selects of a page, placeholders left out."""
    out = []
    for p in pages:
        found: dict[str, list[str]] = {}
        for legend, body in re.findall(r"(?is)<fieldset\b[^>]*>\s*<legend[^>]*>(.*?)</legend>(.*?)</fieldset>", p or ""):
            values = re.findall(r"(?is)<label\b[^>]*>(.*?)</label>|<input\b[^>]*\btitle=[\"']([^\"']+)[\"']", body)
            found[_text(legend).rstrip(" :")] = [_text(a or b) for a, b in values]
        for name, body in re.findall(r"(?is)<select\b[^>]*\b(?:aria-label|name)=[\"']([^\"']+)[\"'][^>]*>(.*?)</select>", p or ""):
            found[_text(name)] = [_text(v) for v in re.findall(r"(?is)<option\b[^>]*>(.*?)</option>", body)]
        out.append({k: [v for v in vs if v and not PLACEHOLDER.match(v)] for k, vs in found.items() if k})
    return pd.Series(out)


def _text(fragment: str) -> str:
    return re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", " ", fragment))).strip()


def value_key(values: Column) -> Column:
    """Order-insensitive key of a combination's values."""
    return F.array_join(F.array_sort(F.transform(values, lambda v: F.lower(F.trim(v)))), "|")


def combination_codes(rows, dims: str, combinations: str):
    """rows joined to the identifier of their combination: rows have a map of dimension to value and the page's
    combinations (JSON); the parent's identifier is not copied, so a row without one gets null."""
    parsed = F.from_json(combinations, COMBINATION)
    codes = F.transform(F.coalesce(parsed, F.array().cast(COMBINATION)), lambda c: F.struct(value_key(F.map_values(c["attributes"])).alias("k"), F.coalesce(c["ean13"], c["reference"]).alias("code")))
    return rows.withColumn("combination_reference", F.get(F.filter(codes, lambda c: c["k"] == value_key(F.map_values(dims))), F.lit(0)).getField("code"))


def derived_value(lookup: Column, dims: Column, dimension: str) -> Column:
    """What a map of dimension -> value -> derived value says of a row's own value."""
    return F.try_element_at(F.try_element_at(lookup, F.lit(dimension)), F.try_element_at(dims, F.lit(dimension)))

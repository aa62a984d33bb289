"""Scans: lenient JSON, containers, delimited text, optional and tagged inputs, captured pages."""

from __future__ import annotations

import html
import re
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRODUCT = (
    "distributor string, name string, url string, variants map<string,string>, sku string, brand string, brandCandidates array<string>, "
    "commercialBrand string, productLine string, reference string, syntheticReference string, categoryId string, category string, categoryUrl string, "
    "breadcrumbPath array<string>, priceTaxExcluded double, description string, metaDescription string, "
    "derived struct<matchedReferenceColor:string,matchedBrandAlias:string>"
)


PAGE_FIELDS = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("meta", T.StringType()),
        T.StructField("options", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
    ]
)


def lenient(text: Column) -> Column:
    """JSON text without a byte order mark and without trailing commas."""
    return F.regexp_replace(F.regexp_replace(text, "^﻿", ""), r",\s*([\]}])", "$1")


def products(spark: SparkSession, path: str, contains: str = "", distributor: str | None = None) -> DataFrame:
    """Product JSON documents below a folder: arrays or {items} or {products}, trailing commas allowed.

    Documents that are none of these give no rows. source_file is the document's name.
    """
    raw = (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[jJ][sS][oO][nN]").text(path, wholetext=True)
        .select(F.col("_metadata.file_name").alias("source_file"), lenient(F.col("value")).alias("v"))
        .where(F.col("source_file").contains(contains))
    )
    rows = f"array<struct<{PRODUCT.replace(' string', ':string').replace(' map<', ':map<').replace(' array<', ':array<').replace(' double', ':double').replace(' struct<', ':struct<')}>>"
    held = F.when(F.ltrim(F.col("v")).startswith("["), F.from_json("v", rows)).otherwise(
        F.coalesce(F.from_json("v", f"struct<items:{rows}>")["items"], F.from_json("v", f"struct<products:{rows}>")["products"])
    )
    out = raw.select("source_file", F.explode(held).alias("p")).select("source_file", "p.*")
    return out if distributor is None else out.where(F.lower(F.trim("distributor")) == distributor.lower().strip())


def delimited(spark: SparkSession, path: str, sep: str = ",", normal_headers: bool = False) -> DataFrame:
    """Quoted delimited text with a header; missing cells are empty texts, blank rows left out."""
    df = spark.read.options(header=True, multiLine=True, escape='"', sep=sep, encoding="UTF-8", ignoreLeadingWhiteSpace=True).csv(path)
    df = df.toDF(*[c.strip().lstrip("﻿") for c in df.columns])
    if normal_headers:
        df = df.toDF(*[re.sub("[^a-z0-9]+", "_", c.lower()).strip("_") for c in df.columns])
    return df.na.fill("").where(F.concat_ws("", *df.columns) != "")


def optional(spark: SparkSession, path: str, schema: str | T.StructType, fmt: str = "json") -> DataFrame:
    """The file, or an empty table of the schema where it does not exist."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
    return spark.read.schema(schema).format(fmt).load(path) if there else spark.createDataFrame([], schema)


def tagged(spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet") -> DataFrame:
    """Several files under one schema with the kind each came from."""
    out = None
    for kind, path in paths.items():
        df = spark.read.format(fmt).load(path).withColumn("kind", F.lit(kind))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def blocks(spark: SparkSession, path: str) -> DataFrame:
    """Lines `brand[=>brand]:type`, comma lists and # comments allowed."""
    line = F.explode(F.transform(F.split(F.regexp_replace("value", "#.*$", ""), ","), F.trim))
    parts = spark.read.text(path).select(line.alias("l")).where("l <> ''").select(F.split("l", ":").alias("p"))
    brands = F.split(F.col("p")[0], "=>")
    return parts.select(F.trim(brands[0]).alias("a_brand"), F.trim(F.coalesce(F.get(brands, 1), brands[0])).alias("b_brand"), F.trim(F.get("p", F.lit(1))).alias("product_type"))


def loose_json(text: Column) -> Column:
    """The object inside a fenced or surrounded JSON answer."""
    return F.nullif(F.regexp_extract(text, r"(?s)(\{.*\})", 1), F.lit(""))


def links(page: Column) -> Column:
    """Targets of the links of a page, in order."""
    return F.regexp_extract_all(page, F.lit(r"(?i)<a\b[^>]*\bhref=[\"']([^\"'#]+)"), F.lit(1))


def strip_tags(page: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(page, r"<[^>]*>", " "), r"\s+", " "))


@F.pandas_udf(PAGE_FIELDS)
def page_fields(pages: pd.Series) -> pd.DataFrame:
    """h1, meta description and the options of every select of captured pages."""
    rows = []
    for p in pages:
        p = p or ""
        h1 = re.search(r"(?is)<h1[^>]*>(.*?)</h1>", p)
        meta = re.search(r"(?is)<meta[^>]+name=[\"']description[\"'][^>]+content=[\"']([^\"']*)", p)
        options = {}
        for m in re.finditer(r"(?is)<select[^>]*\bname=[\"']([^\"']+)[\"'][^>]*>(.*?)</select>", p):
            found = [html.unescape(re.sub("<[^>]*>", "", o)).strip() for o in re.findall(r"(?is)<option[^>]*>(.*?)</option>", m.group(2))]
            options[m.group(1)] = [o for o in found if o and not re.match(r"(?i)(elige|choose|select|-+)", o)]
        rows.append((html.unescape(re.sub("<[^>]*>", "", h1.group(1))).strip() if h1 else None, html.unescape(meta.group(1)) if meta else None, options))
    return pd.DataFrame(rows, columns=["name", "meta", "options"])

"""Captured rows to base products and variants: type, brand, keys, liquid contents, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import text as T
from tallyloom.functions import variants as V
from tallyloom.functions.binding import let
from tallyloom.functions.similarity import product_kind
from tallyloom.session import salted_lookup

# Breadcrumb parts that are no brand.
GENERIC_CRUMBS = (
    "inicio,productos,producto,alquimia,aromas,aroma,liquidos,liquidos electronicos,sales,sales de nicotina,kits,kits pod system,pod system,pods,"
    "resistencias,recambios,desechables,mods,mod electronico,atomizadores,accesorios"
).split(",")
# Types that are liquids, and those that may hold nicotine.
LIQUIDS = ["aroma_concentrate", "eliquid", "nicotine_salt", "base_booster"]
NICOTINE = ["eliquid", "nicotine_salt", "base_booster"]
GROUP = ["side", "brand_or_none", "base_key", "base_url"]
_ML = r"(\d+(?:[.,]\d+)?)\s*ml"


def some(c: Column) -> Column:
    """The text, or null where it is empty."""
    return F.nullif(c, F.lit(""))


def parts_of(c: Column) -> Column:
    """The trimmed non-blank elements of an array."""
    return F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), T.trimmed), lambda x: x.isNotNull() & (x != ""))


def own_variants(m: Column) -> Column:
    """map of canonical dimension to trimmed value; blank values are left out, of equal dimensions the last counts."""
    named = F.transform(F.map_entries(m), lambda e: F.struct(T.variant_name(e["key"]).alias("key"), T.trimmed(e["value"]).alias("value")))
    filled = F.filter(named, lambda e: e["value"].isNotNull() & (e["value"] != ""))

    def last(es: Column) -> Column:
        rest = lambda i: F.slice(es, i + 2, F.size(es))
        return F.map_from_entries(F.filter(es, lambda e, i: ~F.exists(rest(i), lambda later: later["key"] == e["key"])))

    return F.coalesce(let(filled, last), F.create_map().cast("map<string,string>"))


def variant_label(own: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(F.map_entries(own)), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "; ")


def variant_signature(own: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(F.map_entries(own)), lambda e: F.concat(e["key"], F.lit("="), F.regexp_replace(T.fold(e["value"]), "[^a-z0-9]+", ""))), "|")


def stripped_title(name: Column, variants: Column) -> Column:
    """The name without ` - value` endings of its own variants, longest first; blanks collapsed."""
    values = F.array_sort(parts_of(F.map_values(variants)), lambda a, b: F.length(b) - F.length(a))
    cut = F.aggregate(values, T.trimmed(name), lambda acc, v: F.regexp_replace(acc, F.concat(F.lit(r"(?i)\s+-\s+\Q"), F.replace(v, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit(r"\E$")), F.lit("")))
    return F.coalesce(some(T.trimmed(F.regexp_replace(cut, f"{T.BLANK}+", " "))), name)


def breadcrumb_brand(path: Column) -> Column:
    """The last part of a breadcrumb that is no general heading."""
    return F.try_element_at(F.filter(parts_of(path), lambda p: ~T.fold(p).isin(*GENERIC_CRUMBS)), F.lit(-1))


def inferred_brand(candidates: Column, commercial: Column, brand: Column, title: Column, path: Column) -> Column:
    """First candidate, commercial brand, brand, what follows the last dash of the title (tails that are measures skipped), breadcrumb."""
    pieces = parts_of(F.split(F.translate(title, "–—", "--"), r"\s+-\s+|-\s+"))
    measure = r"(?i)\b(?:\d+\s*(?:mg|ml|mah|ohm|w)|\d+\s*/\s*\d+)\b"

    def tail(ps: Column) -> Column:
        at = F.array_max(F.filter(F.transform(ps, lambda p, i: F.when(~p.rlike(measure), i + 1)), lambda i: i.isNotNull()))
        return F.when(at >= 2, F.get(ps, at - 1))

    return F.coalesce(F.get(parts_of(candidates), F.lit(0)), some(commercial), some(brand), let(pieces, tail), breadcrumb_brand(path))


def unique_spellings(values: Column) -> Column:
    """Distinct by letters and digits, first spelling and order kept."""
    key = lambda v: F.regexp_replace(T.fold(v), "[^a-z0-9]+", "")
    first = lambda vs, ks: F.filter(vs, lambda v, i: (F.get(ks, i) != "") & (F.array_position(ks, F.get(ks, i)) == i + 1))
    return let(parts_of(values), lambda vs: let(F.transform(vs, key), lambda ks: first(vs, ks)))


def profiled(p: DataFrame) -> DataFrame:
    """product with own (canonical variants), title, brand, brands, product_type, base_key and base_url."""
    url = F.substring_index(F.coalesce("url", F.lit("")), "#", 1)
    ref = T.reference_key(F.coalesce(some(F.col("synthetic_reference")), F.col("reference"), F.lit("")))
    out = p.withColumn("own", own_variants(F.col("variants"))).withColumn("title", stripped_title(F.col("name"), F.col("variants")))
    out = out.withColumn("brand_found", inferred_brand(F.col("brand_candidates"), F.col("commercial_brand"), F.col("brand"), F.col("title"), F.col("breadcrumb_path")))
    crumbs = F.array(F.col("commercial_brand"), F.col("brand_found"), breadcrumb_brand(F.col("breadcrumb_path")))
    return out.withColumns(
        {
            "brands": unique_spellings(F.concat(F.coalesce("brand_candidates", F.array().cast("array<string>")), crumbs)),
            "product_type": product_kind(F.col("name"), F.col("category"), F.col("category_id"), F.col("reference"), F.col("synthetic_reference"), F.col("variants")),
            "base_key": F.coalesce(some(ref), T.reference_key(url), F.lit("")),
            "base_url": url,
            "side": F.coalesce("distributor", F.lit("")),
            "brand_or_none": F.coalesce(some(F.col("brand_found")), F.lit("NO_BRAND")),
        }
    )


def base_id(distributor: Column, key: Column, title: Column, url: Column) -> Column:
    return F.concat(F.coalesce(some(distributor), F.lit("SRC")), F.lit(":"), F.coalesce(some(key), T.reference_key(title), F.lit("")), F.lit(":"), F.right(T.reference_key(url), F.lit(80)))


#: What is held of a representative; the texts only where they are described.
IDENTITY = ["distributor", "title", "brand_found", "brands", "commercial_brand", "product_line", "breadcrumb_path", "reference", "synthetic_reference", "product_type"]
TEXTS = ["description", "meta_description", "category"]


def _representatives(rows: DataFrame, held: Sequence[str] = (*IDENTITY, *TEXTS)) -> DataFrame:
    """Per base group the row with the shortest title, then the first name and row_id, with counts and prices."""
    price = F.when(~F.isnan("price_tax_excluded"), F.col("price_tax_excluded"))
    return rows.groupBy(*GROUP).agg(
        F.min_by(F.struct(*held), F.struct(F.length("title"), "name", "row_id")).alias("rep"),
        F.count(F.lit(1)).alias("variant_count"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        F.array_join(F.array_sort(F.collect_set(some(F.col("source_file")))), " | ").alias("source_files"),
        F.array_join(F.array_sort(F.collect_set(some(F.col("category")))), " | ").alias("source_categories"),
    )


def _summaries(rows: DataFrame) -> DataFrame:
    """Per base group `k: n` and `k: a | b` of its dimensions, in the order they first appear."""
    flat = rows.select(*GROUP, "row_id", F.posexplode(F.map_entries("own")).alias("pos", "e"))
    per_key = flat.groupBy(*GROUP, F.col("e.key").alias("k")).agg(F.array_sort(F.collect_set("e.value")).alias("vs"), F.min(F.struct("row_id", "pos")).alias("first"))
    lines = F.array_sort(F.collect_list(F.struct("first", "k", "vs")))
    return per_key.groupBy(*GROUP).agg(lines.alias("l")).select(
        *GROUP,
        F.array_join(F.transform("l", lambda x: F.concat(x["k"], F.lit(": "), F.size(x["vs"]).cast("string"))), "; ").alias("variant_summary"),
        F.array_join(F.transform("l", lambda x: F.concat(x["k"], F.lit(": "), F.array_join(x["vs"], " | "))), "; ").alias("variant_values"),
    )


def _named_groups(rows: DataFrame) -> DataFrame:
    """Per base group rep (without texts) and variant_values, over one shuffle: equal captures fall together before a group is listed."""
    order = F.struct(F.length("title"), "name", "row_id")
    placed = rows.select(*GROUP, "row_id", F.struct(*IDENTITY).alias("rep"), order.alias("order"), F.map_entries("own").alias("entries")).repartition(*GROUP)
    captures = placed.groupBy(*GROUP, "entries").agg(F.min_by("rep", "order").alias("rep"), F.min("order").alias("order"), F.min("row_id").alias("row_id"))
    groups = captures.groupBy(*GROUP).agg(F.min_by("rep", "order").alias("rep"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("row_id", "entries"))), lambda x: x["entries"])).alias("es"))
    values = lambda es, k: F.array_sort(F.array_distinct(F.transform(F.filter(es, lambda e: e["key"] == k), lambda e: e["value"])))
    line = lambda es: F.transform(F.array_distinct(F.transform(es, lambda e: e["key"])), lambda k: F.concat(k, F.lit(": "), F.array_join(values(es, k), " | ")))
    return groups.select(*GROUP, "rep", F.array_join(line(F.col("es")), "; ").alias("variant_values"))


def named_bases(product: DataFrame) -> DataFrame:
    """base_rows without descriptions, categories, counts, prices and sources, none of which a match reads."""
    joined = _named_groups(profiled(product))
    r = lambda c: F.col(f"rep.{c}")
    blank = lambda c: F.coalesce(c, F.lit("")).alias
    return joined.select(
        base_id(F.col("side"), F.col("base_key"), r("title"), F.col("base_url")).alias("id"), r("distributor").alias("distributor"), F.col("base_url").alias("url"), r("title").alias("title"),
        blank(r("brand_found"))("brand"), F.array_join(r("brands"), " | ").alias("brand_candidates"), blank(r("commercial_brand"))("commercial_brand"), blank(r("product_line"))("product_line"),
        F.array_join(parts_of(r("breadcrumb_path")), " > ").alias("breadcrumb_path"), r("product_type").alias("product_type"), blank(r("reference"))("reference"),
        blank(r("synthetic_reference"))("synthetic_reference"), "base_key", blank(F.col("variant_values"))("variant_values"),
    )


def base_rows(product: DataFrame) -> DataFrame:
    """One row per base product (side, brand, base key and url without fragment).

    Title, brand, texts and type come from the representative; the description is the labelled
    join of all that is known. Null prices and NaN do not count; null texts are left out. Empty
    tables give none; repeated captures are counted and change nothing else.
    """
    rows = profiled(product)
    joined = _representatives(rows).join(_summaries(rows), GROUP, "left")
    r = lambda c: F.col(f"rep.{c}")
    said = lambda label, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(label), c))
    crumbs = F.array_join(parts_of(r("breadcrumb_path")), " > ")
    candidates = F.array_join(r("brands"), " | ")
    description = F.concat_ws(
        ". ",
        some(r("title")), said("Descripcion scrapeada: ", r("description")), said("Meta descripcion: ", r("meta_description")), said("Marca: ", r("brand_found")),
        said("Marcas candidatas: ", candidates), said("Marca comercial: ", r("commercial_brand")), said("Linea: ", r("product_line")), said("Breadcrumb: ", crumbs),
        said("Categoria: ", r("category")), said("Referencia: ", r("reference")), said("Referencia sintetica: ", r("synthetic_reference")),
        said("Variantes: ", F.col("variant_summary")), said("Valores de variantes: ", F.col("variant_values")),
    )
    blank = lambda c: F.coalesce(c, F.lit(""))
    return joined.select(
        base_id(F.col("side"), F.col("base_key"), r("title"), F.col("base_url")).alias("id"), r("distributor").alias("distributor"), F.col("base_url").alias("url"), r("title").alias("title"),
        description.alias("description"), blank(r("category")).alias("category"), "source_categories", blank(r("brand_found")).alias("brand"), candidates.alias("brand_candidates"),
        blank(r("commercial_brand")).alias("commercial_brand"), blank(r("product_line")).alias("product_line"), crumbs.alias("breadcrumb_path"), blank(r("meta_description")).alias("meta_description"),
        r("product_type").alias("product_type"), blank(r("reference")).alias("reference"), blank(r("synthetic_reference")).alias("synthetic_reference"), "base_key", "variant_count",
        blank(F.col("variant_summary")).alias("variant_summary"), blank(F.col("variant_values")).alias("variant_values"), "min_price", "max_price", "source_files",
    )


def ml_text(number: Column) -> Column:
    """`2,50` as `2.5 ml`, whole numbers without a point; null for none."""
    n = F.replace(number, F.lit(","), F.lit(".")).try_cast("double")
    return F.when(n == F.floor(n), F.concat(F.floor(n).cast("string"), F.lit(" ml"))).when(n.isNotNull(), F.concat(n.cast("string"), F.lit(" ml")))


def ml_number(c: Column) -> Column:
    return F.replace(F.regexp_extract(c, r"(?i)" + _ML, 1), F.lit(","), F.lit(".")).try_cast("double")


def liquid_parts(own: Column, kind: Column, source: Column) -> Column:
    """struct<contenido_ml, bote_ml>: what a liquid holds and the bottle it comes in, from stated values
    and then from the wording, pattern by pattern. A bottle over 10 ml holds no nicotine."""
    stated = lambda *ks: F.coalesce(*[some(F.try_element_at(own, F.lit(k))) for k in ks])
    n = r"(\d+(?:[.,]\d+)?)"
    patterns = {
        "compact": rf"{n}\s*ml\s*/\s*{n}\s*(?:ml|\b(?=\s*(?:longfill|shortfill|shake|\(|$)))",
        "label": rf"{n}\s*ml\s+en\s+(?:bote|botella)\s+de\s+{n}\s*ml",
        "with": rf"(?:botella|bote)\s+de\s+{n}\s*ml\s+con\s+{n}\s*ml",
        "named": rf"capacidad\s+del\s+bote\s*:?\s*{n}\s*ml",
        "bottle": rf"(?:botella|bote)\s+de\s+{n}\s*ml",
        "content": rf"(?:formato|contenido|aroma)\s*:?\s*{n}\s*ml",
    }

    def solved(t: Column) -> Column:
        hit = lambda name, g: ml_text(some(F.regexp_extract(t, patterns[name], g)))
        content = F.coalesce(stated("contenido_ml", "contenido"), hit("compact", 1), hit("label", 1), hit("with", 2), hit("content", 1), ml_text(some(F.regexp_extract(t, _ML, 1))))
        bottle = F.coalesce(stated("bote_ml", "capacidad_bote"), hit("compact", 2), hit("label", 2), hit("with", 1), hit("named", 1), hit("bottle", 1))
        own_nicotine = stated("nicotina")
        signal = ~t.rlike(r"\b(?:sin|without)\s+nicotina\b|\b0\s*mg\b") & t.rlike(r"\b(?:nicotine|sales|salts|\d+(?:[.,]\d+)?\s*mg)\b")
        nicotine = F.coalesce(~own_nicotine.rlike(r"(?i)\b0\s*mg\b|\bsin\s+nicotina\b"), F.lit(False)) | (
            kind.isin(*NICOTINE) & (kind.isin("nicotine_salt", "base_booster") | signal)
        )
        longfill = t.rlike(r"\b(?:longfill|shortfill|shake\s*(?:and|&)?\s*vape)\b")

        def bottled(s: Column) -> Column:
            size = ml_number(s["c"])
            same = s["b"].isNull() & s["c"].isNotNull() & ~s["longfill"] & kind.isin(*NICOTINE) & (~s["nicotine"] | size.isNull() | (size <= 10))
            bottle_now = F.when(same, s["c"]).otherwise(s["b"])
            limited = F.when(s["nicotine"] & (ml_number(bottle_now) > 10), F.when(size <= 10, s["c"])).otherwise(bottle_now)
            return F.struct(F.coalesce(s["c"], F.lit("")).alias("contenido_ml"), F.coalesce(limited, F.lit("")).alias("bote_ml"))

        return let(F.struct(content.alias("c"), bottle.alias("b"), nicotine.alias("nicotine"), longfill.alias("longfill")), bottled)

    plain = F.struct(F.coalesce(stated("contenido_ml", "contenido"), F.lit("")).alias("contenido_ml"), F.coalesce(stated("bote_ml", "capacidad_bote"), F.lit("")).alias("bote_ml"))
    return F.when(kind.isin(*LIQUIDS), let(source, solved)).otherwise(plain)


DIMENSIONS = ["color", "reference_color", "pod_type", "nicotina", "capacidad", "resistencia", "base_ratio", "sabor", "cafeina", "tamano"]


def variant_rows(product: DataFrame) -> DataFrame:
    """One row per captured row with the identity of its base, its signature and its dimensions.

    Brand, candidates, type and base title are those of the base's representative. Rows of a base
    with a third of the table are spread by salts when they meet it.
    """
    rows = profiled(product)
    reps = _representatives(rows).select(
        *GROUP, F.col("rep.title").alias("base_title"), F.col("rep.brand_found").alias("base_brand"), F.array_join("rep.brands", " | ").alias("base_brands"), F.col("rep.product_type").alias("base_type")
    )
    v = salted_lookup(rows, reps, GROUP, "row_id", how="inner")
    signature, label = variant_signature(F.col("own")), variant_label(F.col("own"))
    v = v.withColumns({"variant_signature": signature, "variant_label": label, "base_id": base_id(F.col("distributor"), F.col("base_key"), F.col("base_title"), F.col("base_url"))})
    source = T.fold(F.concat_ws(" ", some(F.col("variant_label")), some(F.try_element_at("own", F.lit("capacidad"))), some(F.col("name")), some(F.col("base_title")), some(F.col("url")), some(F.col("description"))))
    v = v.withColumn("liquid", liquid_parts(F.col("own"), F.col("base_type"), source))
    tail = T.reference_key(F.coalesce(some(F.col("sku")), some(F.col("url")), F.col("name")))
    blank = lambda c: F.coalesce(c, F.lit(""))
    return v.select(
        "row_id", F.concat("base_id", F.lit(":"), F.coalesce(some(F.col("variant_signature")), tail)).alias("id"), "base_id", "distributor", blank(F.col("url")).alias("url"), "base_url",
        blank(F.col("name")).alias("title"), "base_title", blank(F.col("base_brand")).alias("brand"), F.col("base_brands").alias("brand_candidates"), F.col("base_type").alias("product_type"),
        blank(F.col("reference")).alias("reference"), blank(F.col("synthetic_reference")).alias("synthetic_reference"), blank(F.col("sku")).alias("sku"), "variant_signature", "variant_label",
        *[blank(F.try_element_at("own", F.lit(k))).alias(k) for k in DIMENSIONS], F.col("liquid.contenido_ml").alias("contenido_ml"), F.col("liquid.bote_ml").alias("bote_ml"),
        blank(F.col("derived.matched_reference_color")).alias("derived_reference_color"),
    )


FIELDS = ["color", "reference_color", "derived_reference_color", "effective_color", "nicotina", "capacidad", "contenido_ml", "bote_ml", "resistencia", "base_ratio", "sabor", "cafeina", "tamano", "pod_type", "product_type"]


def variant_fields(variants: DataFrame) -> DataFrame:
    """One row per variant id (its first captured row) with the dimensions that are compared."""
    first = variants.groupBy("id").agg(F.min_by(F.struct(*[c for c in variants.columns if c != "id"]), "row_id").alias("v")).select("id", "v.*")
    return first.withColumns(V.derived_fields()).select("id", "base_id", "title", "url", "variant_label", *FIELDS)


def best_variants(pairs: DataFrame, fields: DataFrame, threshold: float = 0.72) -> DataFrame:
    """Per matched pair of bases and variant of its side A the best variant of side B.

    pairs(a_base, b_base) are distinct matched bases, fields the variants of both sides. Variants of a
    base are one per signature, so repeated captures are scored once. The largest confidence wins,
    then label and id. Under the threshold the A variant stays without partner and confidence 0;
    a pair of which a base has no variants is one row `missing_variants`.
    """
    own = F.struct(*FIELDS)
    side = lambda n: fields.select(F.col("base_id").alias(f"{n}_base"), F.col("id").alias(f"{n}_id"), F.col("variant_label").alias(f"{n}_label"), own.alias(f"{n}_v"))
    met = pairs.select("a_base", "b_base").distinct().join(side("a"), "a_base").join(side("b"), "b_base")
    scored = met.select("a_base", "b_base", "a_id", "b_id", "b_label", V.variant_score(F.col("a_v"), F.col("b_v")).alias("s"))
    order = F.struct((-F.col("s.confidence")).alias("c"), "b_label", "b_id")
    best = scored.groupBy("a_base", "b_base", "a_id").agg(F.min(F.struct(order.alias("o"), F.col("s.decision").alias("d"))).alias("m"))
    fits = -F.col("m.o.c") >= threshold
    matched = best.select(
        "a_base", "b_base", "a_id", F.when(fits, F.col("m.o.b_id")).alias("b_id"), F.when(fits, F.col("m.d")).otherwise("a_variant_without_b_variant").alias("decision"), F.when(fits, -F.col("m.o.c")).otherwise(0.0).alias("confidence")
    )
    known = fields.select("base_id").distinct()
    both = pairs.select("a_base", "b_base").distinct().join(known.select(F.col("base_id").alias("a_base")), "a_base", "left_semi").join(known.select(F.col("base_id").alias("b_base")), "b_base", "left_semi")
    none = F.lit(None).cast("string")
    missing = pairs.select("a_base", "b_base").distinct().join(both, ["a_base", "b_base"], "left_anti")
    return matched.unionByName(missing.select("a_base", "b_base", none.alias("a_id"), none.alias("b_id"), F.lit("missing_variants").alias("decision"), F.lit(0.0).alias("confidence")))

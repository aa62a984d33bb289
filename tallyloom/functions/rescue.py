"""The rescue score of two captured variants from their own fields, with the hard conflicts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions import similarity as S
from tallyloom.functions import text as T
from tallyloom.functions.binding import let
from tallyloom.operators.candidates import STOP, words

# Fixed values of the reference.
NAME_STOP = (
    "additif bar classic classique concentrado concentrados creations dessert desserts francia fresh fruit fruits fruitfull gama green les liquid "
    "longfill nicotine nicotina premium salt salts sales series sweets valores variante variantes version"
).split()
HARD_LINE = ["zero", "primal", "legend", "legends", "limited", "v2", "pro", "mini", "nano", "max", "plus", "x"]
GROUPS = {
    "hardware_repuesto": ["pod_replacement", "coil", "pyrex", "atomizer_tank"], "hardware_dispositivo": ["kit_device", "mod_device"],
    "liquidos": ["aroma_concentrate", "eliquid", "nicotine_salt", "base_booster"],
}
MODELS = [r"\b([a-z]{2,})\s*-?\s*(\d+[a-z]?)\b", r"\b([a-z]{1,3})\s*-?\s*(mini|nano|max|pro|plus)\b"]


def _measures(text: Column, unit: str) -> Column:
    hits = F.regexp_extract_all(text, F.lit(rf"(?i)(\d+(?:[.,]\d+)?)\s*{unit}"), F.lit(1))
    return F.array_distinct(F.transform(hits, lambda x: F.translate(x, ",", ".").cast("double")))


def captured_features() -> Column:
    """What the score reads of a row of product."""
    brand_texts = [F.col("brand"), F.array_join("brand_candidates", "|"), F.col("commercial_brand")]
    values = F.concat_ws(" ", F.map_values("variants"))
    refs = [F.col("reference"), F.col("synthetic_reference")]
    named, primary = F.concat_ws(" ", "name", values, *refs), F.concat_ws(" ", "name", values, *refs, "url")
    whole = T.numbered(F.concat_ws(" ", "name", values, *refs, *brand_texts, F.concat_ws(" ", "breadcrumb_path"), "url"))
    model_text = T.numbered(F.concat_ws(" ", "name", *refs, "url"))
    kind = S.product_kind(*[F.col(c) for c in ("name", "category", "category_id", "reference", "synthetic_reference", "variants")])
    group = F.lit(None).cast("string")
    for name, kinds in GROUPS.items():
        group = F.when(kind.isin(*kinds), F.lit(name)).otherwise(group)
    brand_list = F.filter(F.transform(F.split(F.concat_ws("|", *brand_texts), "[|,]"), T.compact), lambda b: b != "")
    skip = F.array_union(F.array(*[F.lit(w) for w in [*STOP, *NAME_STOP]]), words(*brand_texts))
    names = F.filter(words(named), lambda w: ~F.array_contains(skip, w) & ~w.rlike(r"^\d+(?:ml|mg|pcs?|ohm|w|mah)?$"))
    markers = F.flatten(F.array(*[F.transform(F.regexp_extract_all(model_text, F.lit(p), F.lit(0)), lambda m: F.regexp_replace(m, "[^a-z0-9]+", "")) for p in MODELS]))
    colours = F.transform(F.filter(F.map_entries("variants"), lambda e: T.variant_name(e["key"]) == "color"), lambda e: T.compact(e["value"]))
    flavour = T.numbered(primary)
    return F.struct(
        words(primary).alias("title"),
        words(F.concat_ws(" ", "name", "description", "meta_description", F.concat_ws(" ", "breadcrumb_path"), values, *refs, "url")).alias("described"),
        F.when(T.numbered(named).rlike(r"\bx\b"), F.array_union(names, F.array(F.lit("x")))).otherwise(names).alias("names"),
        kind.alias("kind"),
        F.coalesce(group, kind).alias("group"),
        F.coalesce(brand_list, F.array().cast("array<string>")).alias("brands"),
        _measures(primary, "ml").alias("ml"),
        _measures(primary, "(?:ohm|Ω)").alias("ohm"),
        _measures(primary, "mg").alias("mg"),
        F.nullif(F.coalesce(F.get(F.filter(colours, lambda c: c != ""), F.lit(0)), F.lit("")), F.lit("")).alias("colour"),
        F.filter(F.array_distinct(markers), lambda m: ~m.isin("pack2", "pack3", "pack5", "p2", "p3", "p5")).alias("models"),
        whole.rlike(r"\bdrip\s*tip\b|\bboquillas?\b").alias("tip"),
        whole.rlike(r"\blong\s*fill\b|\b\d+\s*ml\s*/\s*\d+\b|\bbote\s+de\s+\d+\s*ml\b").alias("longfill"),
        F.filter(F.array(F.when(flavour.rlike(r"\bsweet\b"), "sweet"), F.when(flavour.rlike(r"\bgreen\b"), "green")), lambda m: m.isNotNull()).alias("edition"),
    )


def pair_audit(a: Column, b: Column, same_base: Column, split_base: Column) -> Column:
    """struct(score unrounded in 0..1, hard_conflict) of two features."""
    size = lambda x, y: F.size(F.array_intersect(x, y))
    coverage = lambda n, x, y: n / F.greatest(F.lit(1), F.least(F.size(x), F.size(y)))
    either = lambda groups: a["group"].isin(*groups) | b["group"].isin(*groups)
    liquid, hardware = either(["liquidos"]), either(["hardware_repuesto", "hardware_dispositivo"])
    hard = F.array(*[F.lit(w) for w in HARD_LINE])
    line = lambda x: F.array_intersect(x, hard)
    unequal = lambda x, y: F.size(F.array_union(x, y)) > F.size(F.array_intersect(x, y))
    extra_a, extra_b = F.size(F.array_except(a["names"], b["names"])) > 0, F.size(F.array_except(b["names"], a["names"])) > 0
    n = size(a["names"], b["names"])
    conflict = (
        S.sets_conflict(a["ml"], b["ml"]) | S.sets_conflict(a["ohm"], b["ohm"]) | S.sets_conflict(a["mg"], b["mg"])
        | F.coalesce(a["colour"] != b["colour"], F.lit(False)) | (hardware & S.sets_conflict(a["models"], b["models"])) | (hardware & (a["tip"] != b["tip"]))
        | (liquid & S.sets_conflict(line(a["title"]), line(b["title"]))) | (liquid & (a["longfill"] != b["longfill"]))
        | (~same_base & (
            (liquid & (unequal(line(a["names"]), line(b["names"])) | ((n <= 1) & extra_a & extra_b) | ((n == 1) & (extra_a | extra_b)) | S.sets_conflict(a["edition"], b["edition"])))
            | ((liquid | hardware) & (n == 0))
        ))
    )
    known = (F.size(a["brands"]) > 0) & (F.size(b["brands"]) > 0)
    brand = F.when(known, F.arrays_overlap(a["brands"], b["brands"]))
    same_group = a["group"] == b["group"]
    distinct = F.size(F.filter(F.array_intersect(a["names"], b["names"]), lambda w: ~w.isin("color", "pack", "p2", "p3", "p5")))
    long_words = F.size(F.filter(F.array_intersect(a["described"], b["described"]), lambda w: F.length(w) >= 4))
    facts = F.struct(size(a["title"], b["title"]).alias("t"), size(a["described"], b["described"]).alias("d"), conflict.alias("conflict"))

    def scored(f: Column) -> Column:
        total = (
            F.when(split_base, 0.12).otherwise(0.0) + F.when(same_base, 0.2).otherwise(0.0)
            + F.when(a["kind"] == b["kind"], 0.14).when(same_group, 0.08).otherwise(0.0)
            + F.when(brand.isNull(), 0.0).when(brand, 0.16).otherwise(-0.16)
            + 0.24 * coverage(f["t"], a["title"], b["title"]) + 0.32 * coverage(f["d"], a["described"], b["described"])
            + F.when(F.arrays_overlap(a["ohm"], b["ohm"]), 0.08).otherwise(0.0)
        )
        strong = ~f["conflict"] & liquid & same_group & F.coalesce(brand, F.lit(False)) & (distinct >= 1) & (long_words >= 3)
        inside = ~f["conflict"] & same_base & same_group & ((f["t"] >= 2) | (f["d"] >= 6))
        total = F.when(strong, F.greatest(total, F.lit(0.86))).otherwise(total)
        total = F.when(inside, F.greatest(total, F.lit(0.82))).otherwise(total)
        return F.struct(S.clamp(total).alias("score"), f["conflict"].alias("hard_conflict"))

    return let(facts, scored)

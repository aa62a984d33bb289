"""How alike two variants are: derived dimensions, similarity of values, weighted score and decision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions import similarity as S
from tallyloom.functions import text as T
from tallyloom.functions.binding import let

# Words no value is told by, words that only soften one, build words of coils and pods.
VALUE_STOP = ["and", "y", "de", "color", "oxva", "uwell", "vaporesso", "voopoo"]
SOFT = ["dark", "light", "metal", "metallic"]
BUILD = ["mesh", "dual", "corex", "dtl", "mtl", "lush", "top", "fill"]
# Weight of each dimension; liquids are compared by content and bottle, others by capacity.
WEIGHTS = {"nicotina": 2.0, "capacidad": 1.5, "contenido_ml": 2.0, "bote_ml": 2.0, "resistencia": 2.0, "base_ratio": 1.5, "sabor": 2.5, "cafeina": 1.5, "tamano": 1.0, "pod_type": 4.0}
COLOUR_WEIGHT = 1.0
# Types whose capacity, and whose resistance, may be read from the wording.
CAPACITY_FROM_TEXT = ["pyrex", "atomizer_tank", "pod_replacement", "eliquid", "nicotine_salt", "aroma_concentrate", "base_booster", "disposable"]
REFERENCE_CAPACITY = ["pyrex", "atomizer_tank", "pod_replacement"]
RESISTANCE_FROM_TEXT = ["coil", "pod_replacement"]


def american(c: Column) -> Column:
    """plain text with colour written color."""
    return F.replace(T.plain(F.coalesce(c, F.lit(""))), F.lit("colour"), F.lit("color"))


def _mended(c: Column) -> Column:
    return F.replace(F.replace(F.regexp_replace(american(c), r"\bartic\b", "arctic"), F.lit("graffitti"), F.lit("graffiti")), F.lit("grey"), F.lit("gray"))


def value_key(c: Column) -> Column:
    return F.regexp_replace(_mended(c), "[^a-z0-9]+", "")


def value_words(c: Column) -> Column:
    return F.filter(F.split(_mended(c), "[^a-z0-9]+"), lambda w: (w != "") & ~w.isin(*VALUE_STOP))


def build_words(c: Column) -> Column:
    return F.array_distinct(F.filter(value_words(c), lambda w: w.isin(*BUILD)))


def value_similarity(a: Column, b: Column) -> Column:
    """1 equal or both empty, .35 one empty, by the Jaccard of the words .95, .88, .72, contained .86 where
    only softening words differ and .45 otherwise, else 0."""

    def ladder(s: Column) -> Column:
        x, y = s["x"], s["y"]
        shared = F.size(F.filter(x, lambda w: F.array_contains(y, w)))
        union = F.size(F.array_union(x, y))
        j = F.when(union > 0, shared / union).otherwise(0.0)
        inside = s["a"].contains(s["b"]) | s["b"].contains(s["a"])
        extra = F.concat(F.filter(x, lambda w: ~F.array_contains(y, w)), F.filter(y, lambda w: ~F.array_contains(x, w)))
        return (
            F.when((s["a"] == "") & (s["b"] == ""), 1.0)
            .when((s["a"] == "") | (s["b"] == ""), 0.35)
            .when(s["a"] == s["b"], 1.0)
            .when(j >= 0.8, 0.95)
            .when(j >= 0.66, 0.88)
            .when(j >= 0.5, 0.72)
            .when(inside & F.forall(extra, lambda w: w.isin(*SOFT)), 0.86)
            .when(inside, 0.45)
            .otherwise(0.0)
        )

    return let(F.struct(value_key(a).alias("a"), value_key(b).alias("b"), value_words(a).alias("x"), value_words(b).alias("y")), ladder)


def numbers(c: Column, unit: str) -> Column:
    """The distinct numbers before ml or ohm."""
    pattern = r"(?i)(\d+(?:[.,]\d+)?)\s*" + ("(?:ohm|Ω)" if unit == "ohm" else "ml")
    hits = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(pattern), F.lit(1))
    return F.array_distinct(F.transform(hits, lambda x: F.replace(x, F.lit(","), F.lit(".")).cast("double")))


def derived_fields() -> dict[str, Column]:
    """Dimensions of a variant row with what its wording says where they are not stated."""
    c = F.col
    some = lambda k: F.nullif(c(k), F.lit(""))
    texts = lambda *ks: F.concat_ws(" ", *[some(k) for k in ks])
    worded = T.plain(texts("variant_label", "capacidad", "resistencia", "title", "base_title", "url"))
    pod = F.coalesce(some("pod_type"), F.when(worded.rlike(r"\bdtl\b"), F.lit("DTL")).when(worded.rlike(r"\bmtl\b"), F.lit("MTL")), F.lit(""))

    def first_ml(*ks: str) -> Column:
        return F.coalesce(*[F.nullif(F.regexp_extract(c(k), r"(?i)(\d+(?:[.,]\d+)?)\s*ml", 1), F.lit("")) for k in ks])

    read = F.when(c("product_type").isin(*REFERENCE_CAPACITY), first_ml("variant_label", "title", "base_title", "reference", "synthetic_reference", "sku", "url")).when(
        c("product_type").isin(*CAPACITY_FROM_TEXT), first_ml("variant_label", "title", "base_title", "url")
    )
    capacity = F.coalesce(some("capacidad"), F.concat(F.replace(read, F.lit(","), F.lit(".")), F.lit(" ml")), F.lit(""))
    built = F.array_join(build_words(texts("variant_label", "title", "base_title", "reference", "synthetic_reference", "url")), " ")
    stated = F.when((F.size(build_words(c("resistencia"))) > 0) | (built == ""), c("resistencia")).otherwise(F.concat(c("resistencia"), F.lit(" "), built))
    ohms = F.regexp_extract_all(texts("variant_label", "title", "base_title", "url"), F.lit(r"(?i)(\d+(?:[.,]\d+)?)\s*(?:ohm|Ω)"), F.lit(1))
    found = F.array_join(F.array_distinct(F.transform(ohms, lambda x: F.concat(F.replace(x, F.lit(","), F.lit(".")), F.lit(" ohm")))), " - ")
    worded_ohm = F.when(c("product_type").isin(*RESISTANCE_FROM_TEXT), F.trim(F.concat_ws(" ", found, built))).otherwise("")
    return {
        "effective_color": F.coalesce(some("reference_color"), some("derived_reference_color"), some("color"), F.lit("")),
        "pod_type": pod, "capacidad": capacity, "resistencia": F.when(c("resistencia") != "", stated).otherwise(worded_ohm),
    }


def _field_score(field: str, a: Column, b: Column, partial: float) -> Column:
    """Similarity of one dimension of a pair of which at least one side states it."""
    base = value_similarity(a, b)
    if field in ("capacidad", "contenido_ml", "bote_ml"):
        one_sided = (value_key(a) == "") != (value_key(b) == "")
        by_number = S.numeric_similarity(numbers(a, "ml"), numbers(b, "ml"), partial)
        return F.when(one_sided, 0.35).otherwise(F.coalesce(by_number, base))
    if field == "resistencia":
        by_number = S.numeric_similarity(numbers(a, "ohm"), numbers(b, "ohm"))

        def capped(m: Column) -> Column:
            has = lambda side, w: F.array_contains(m[side], w)
            opposed = (has("x", "corex") & has("y", "dual")) | (has("x", "dual") & has("y", "corex")) | S.sets_conflict(m["x"], m["y"])
            return F.when(opposed, F.least(m["n"], F.lit(0.72))).otherwise(m["n"])

        built = F.struct(build_words(a).alias("x"), build_words(b).alias("y"), by_number.alias("n"))
        return F.coalesce(F.when(by_number.isNotNull(), let(built, capped)), base)
    return base


def variant_score(a: Column, b: Column, partial_capacity: float = 0.72, accept_base_only: bool = False) -> Column:
    """struct<confidence, decision> of two variants (structs of derived fields and product_type).

    The mean of the similarities of the dimensions that either side states, by their weights; the
    colour is the one of the reference where either has one. Without any, the base's match stands.
    """
    liquid = a["product_type"].isin(*S.LIQUID) | b["product_type"].isin(*S.LIQUID)
    parts = []
    by_reference = (value_key(a["reference_color"]) != "") | (value_key(b["reference_color"]) != "") | (value_key(a["derived_reference_color"]) != "") | (value_key(b["derived_reference_color"]) != "")
    colour = F.when(by_reference, value_similarity(a["effective_color"], b["effective_color"])).otherwise(value_similarity(a["color"], b["color"]))
    parts.append(F.when((value_key(a["effective_color"]) != "") | (value_key(b["effective_color"]) != ""), F.struct(F.lit(COLOUR_WEIGHT).alias("w"), colour.alias("s"))))
    for field, weight in WEIGHTS.items():
        stated = (value_key(a[field]) != "") | (value_key(b[field]) != "")
        if field == "capacidad":
            stated = stated & ~liquid
        elif field in ("contenido_ml", "bote_ml"):
            stated = stated & liquid
        parts.append(F.when(stated, F.struct(F.lit(weight).alias("w"), _field_score(field, a[field], b[field], partial_capacity).alias("s"))))

    def decided(ps: Column) -> Column:
        total = F.aggregate(ps, F.lit(0.0), lambda t, p: t + p["w"])
        score = F.aggregate(ps, F.lit(0.0), lambda t, p: t + p["w"] * p["s"])
        confidence = S.js_round(score / total)
        # a base accepted for lack of dimensions
        alone = F.struct(F.lit(1.0).alias("confidence"), F.lit("variant_match").alias("decision")) if accept_base_only else F.struct(F.lit(0.75).alias("confidence"), F.lit("base_only").alias("decision"))
        decision = F.when(confidence >= 0.95, "variant_match").when(confidence >= 0.72, "possible_variant_match").otherwise("no_variant_match")
        return F.when(total == 0, alone).otherwise(F.struct(confidence.alias("confidence"), decision.alias("decision")))

    return let(F.filter(F.array(*parts), lambda p: p.isNotNull()), decided)

"""The whole score of two base products: what rules a pair out, equal references, weights and bonuses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions import similarity as S
from tallyloom.functions import text as T
from tallyloom.functions.binding import let

# Fixed values of the reference: words that name no model, letters and qualifiers that do.
GENERIC = (
    "a al and aroma aromas bote by capacidad com cartucho cartridge coil coils con de del deposito dl dla eciglogistica el empty en es fill for "
    "fruit full fum glass html http https incluida incluido kit la las los longfill concentrado concentrate edition limited mesh meshed ml moon "
    "new no nuevo nueva ohm ohmios mao o4v apv pack packs para pc pcs pod pods pyrex recambio replacement repuesto resistencia resistencias "
    "serie series sin tank updated vaperalia vpm version vacio vacia bar with wonder y"
).split()
RESPELLED = {
    "bleu": "blue", "colour": "color", "cartridges": "cartridge", "berries": "berry", "grapes": "grape", "fruits": "fruit", "slices": "slice",
    "resistances": "resistencia", "tips": "tip",
}
LETTERS = ["g", "j", "m", "n", "q", "s", "t", "x"]
QUALIFIERS = ["koko", "legend", "lite", "max", "mini", "nano", "plus", "primal", "pro"]
NUMBERED_KINDS = ["kit_device", "mod_device", "pod_replacement", "atomizer_tank", "pyrex"]
HEAVY = ["dtl", "ez", "mtl", "rba", "ss"]
DIRECTIONS = [("top", "side"), ("dtl", "mtl"), ("regular", "pro")]
PACKS = [r"\bpack\s*(?:de\s*)?(\d+)\b", r"\b(\d+)\s*(?:pcs|pc|pzs|unidades)\b", r"(?:^|[\s.-])p(\d+)(?:$|[\s.-])"]


def _split(c: Column) -> Column:
    return F.filter(F.split(c, "[^a-z0-9]+"), lambda w: w != "")


def _numbers(text: Column, pattern: str) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda x: F.translate(x, ",", ".").cast("double"))


def numbers_in(text: Column, pattern: str) -> Column:
    return F.array_distinct(_numbers(text, pattern))


def word_weight(tokens: Column) -> Column:
    return _weight(tokens)


def model_words(text: Column, brands: Column, kind: Column, generic: Sequence[str]) -> Column:
    """The words of a text that name the model, with another list of general words."""
    return _tokens(text, brands, kind, generic, {k: v for k, v in RESPELLED.items() if k in ("bleu", "berries", "grapes", "fruits", "slices")})


def _tokens(text: Column, brands: Column, kind: Column, generic: Sequence[str] = GENERIC, respelling: dict[str, str] = RESPELLED) -> Column:
    for pattern in (r"\b(\d+)[.,](\d+)\s*ml\b", r"\b\d+(?:[.,]\d+)?\s*ohm\b", r"\b\d+\s*(?:ml|mah|w|pcs|pc|pzs|unidades)\b", r"\bpack\s*(?:de\s*)?\d+\b"):
        text = F.regexp_replace(text, pattern, " ")
    respelled = F.create_map(*[F.lit(x) for pair in respelling.items() for x in pair])
    def kept(w: Column) -> Column:
        number = w.rlike("^[0-9]+$") & ~(F.coalesce(kind.isin(*NUMBERED_KINDS), F.lit(False)) & (F.length(w) == 1))
        letter = (F.length(w) == 1) & ~w.rlike("[0-9]") & ~w.isin(*LETTERS)
        return ~(w.isin(*generic) | F.array_contains(brands, w) | w.rlike(r"^p\d+$|^\d+b$|\d+ml") | number | letter)

    return F.array_distinct(F.filter(F.transform(_split(text), lambda w: F.coalesce(F.element_at(respelled, w), w)), kept))


def _subtype(text: Column, ref: Column, kind: Column) -> Column:
    coil = ref.rlike(r"^r[-.\s]") | text.rlike(r"^\s*resistencias?\b")
    adapter = text.rlike(r"\b(?:adaptador|adapter)\b")
    tip = text.rlike(r"\b(?:boquillas?|drip\s*tip|filter\s*tips?|filtro|algodon|pom)\b") & ~text.rlike(r"\b(?:pod|cartucho|cartridge)\b")
    return (
        F.when(kind == "coil", F.when(adapter, "adapter").when(text.rlike(r"\brba\b"), "rba").otherwise("coil"))
        .when(kind == "pod_replacement", F.when(coil, "coil").when(adapter, "adapter").when(tip, "tip").otherwise("pod"))
        .otherwise(kind)
    )


def product_features(
    title: Column, brands: Sequence[Column], kind: Column, reference: Column | None = None, synthetic: Column | None = None,
    base_key: Column | None = None, url: Column | None = None, more: Sequence[Column] = (),
) -> Column:
    """What the score reads of one product; brands are texts, more are further fields of its primary text."""
    none = F.lit(None).cast("string")
    reference, synthetic, base_key, url = (T.blank_to_null(none if c is None else c) for c in (reference, synthetic, base_key, url))
    texts = F.struct(
        T.numbered(F.concat_ws(" ", title, *brands, *more, reference, synthetic, base_key, url)).alias("primary"),
        T.numbered(F.concat_ws(" ", title, reference, synthetic, url)).alias("named"),
        _split(T.numbered(F.concat_ws(" ", *brands))).alias("brands"),
    )
    return let(texts, lambda t: features_of(t["primary"], t["named"], t["brands"], kind, F.coalesce(reference, synthetic, base_key), F.coalesce(base_key, synthetic, reference)))


def features_of(primary: Column, named: Column, brand_words: Column, kind: Column, ref: Column, key: Column) -> Column:
    """product_features from texts that are columns already, so that they are made once."""
    packs = F.flatten(F.array(*[_numbers(primary, p) for p in PACKS]))
    return F.struct(
        _tokens(named, brand_words, kind).alias("tokens"),
        F.array_distinct(_numbers(primary, r"\b(\d+(?:[.,]\d+)?)\s*ml\b")).alias("caps"),
        F.array_distinct(packs).alias("packs"),
        F.coalesce(_subtype(primary, F.coalesce(T.numbered(ref), F.lit("")), kind), F.lit("")).alias("subtype"),
        primary.rlike(r"\b(?:salts?|nicotine\s*salt|sales)\b").alias("salt"),
        F.nullif(T.compact(T.numbered(key)), F.lit("")).alias("key"),
        F.nullif(T.compact(T.numbered(ref)), F.lit("")).alias("ref"),
        F.coalesce(kind == "aroma_concentrate", F.lit(False)).alias("aroma"),
    )


def _weight(tokens: Column) -> Column:
    return F.aggregate(tokens, F.lit(0.0), lambda s, w: s + F.when(w.isin(*HEAVY), 1.45).when(w.rlike("[0-9]"), 1.4).when(F.length(w) <= 2, 0.75).otherwise(1.0))


def _differ(a: Column, b: Column, picked) -> Column:
    x, y = F.filter(a, picked), F.filter(b, picked)
    return (F.size(F.array_except(x, y)) > 0) | (F.size(F.array_except(y, x)) > 0)


def _opposed(a: Column, b: Column) -> Column:
    out = F.lit(False)
    for group in DIRECTIONS:
        words = F.array(*[F.lit(w) for w in group])
        out = out | S.sets_conflict(F.array_intersect(a, words), F.array_intersect(b, words))
    return out


def product_pair_score(a: Column, b: Column) -> Column:
    """Score of two products' features in 0..1; 0 for a pair that is ruled out, 1 for equal references."""
    ta, tb = a["tokens"], b["tokens"]
    common = F.array_intersect(ta, tb)
    ruled_out = (
        (a["subtype"] != b["subtype"]) | S.sets_conflict(a["caps"], b["caps"]) | (a["aroma"] & (a["salt"] != b["salt"])) | S.sets_conflict(a["packs"], b["packs"])
        | _differ(ta, tb, lambda w: w.rlike(r"^v\d+[a-z]?$")) | _differ(ta, tb, lambda w: w.isin(*QUALIFIERS) | w.rlike(r"^s\d+[a-z]?$")) | _opposed(ta, tb)
    )
    unanchored = ~F.exists(common, lambda w: (F.length(w) >= 3) | w.rlike("[0-9]")) | (a["aroma"] & _differ(ta, tb, lambda w: F.lit(True)))
    x, y = F.array_join(ta, ""), F.array_join(tb, "")

    def within(p: Column, q: Column) -> Column:
        return F.coalesce(p.contains(q) | q.contains(p), F.lit(False))

    def scored(s: Column) -> Column:
        total = 0.62 * s["c"] / s["u"] + 0.28 * F.greatest(s["c"] / s["a"], s["c"] / s["b"]) + F.when(within(x, y), 0.08).otherwise(0.0) + F.when(within(a["ref"], b["ref"]), 0.05).otherwise(0.0)
        floor = F.when((s["n"] >= 2) & (s["c"] / F.least(s["a"], s["b"]) >= 0.68), F.greatest(total, F.lit(0.72))).otherwise(total)
        shared = F.when(F.arrays_overlap(a["caps"], b["caps"]), 0.03).otherwise(0.0) + F.when(F.arrays_overlap(a["packs"], b["packs"]), 0.02).otherwise(0.0)
        return F.least(F.lit(1.0), floor + shared)

    weights = F.struct(_weight(common).alias("c"), _weight(F.array_union(ta, tb)).alias("u"), _weight(ta).alias("a"), _weight(tb).alias("b"), F.size(common).alias("n"))
    return F.when(ruled_out, 0.0).when(a["key"] == b["key"], 1.0).when(unanchored, 0.0).otherwise(let(weights, scored))

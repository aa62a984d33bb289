"""Tokens, measures, similarities, scores and status ladders as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.binding import let
from tallyloom.functions.text import fold, numbered

# Words that say nothing about which device it is.
GENERIC = "kit pod coil coils resistencia resistencias cartucho cartuchos cartridge starter device dispositivo pack de con para by the y uds pcs new original".split()
SPECIAL = ["dtl", "mtl", "rdl"]
UNIT = {"ml": r"(\d+(?:[.,]\d+)?)\s*ml\b", "mg": r"(\d+(?:[.,]\d+)?)\s*mg\b", "ohm": r"(\d+(?:[.,]\d+)?)\s*(?:ohms?|ohmios|Ω|ω)"}


def js_round(x: Column, digits: int = 2) -> Column:
    """Half up on the binary value: floor(x * 10^d + 0.5) / 10^d."""
    return F.floor(x * 10**digits + 0.5) / float(10**digits)


def to_fixed2(x: Column) -> Column:
    """The two-decimal rendering of a number in 0..1: exact binary ties up, the rest by format."""
    tie = (x * 8 == F.floor(x * 8)) & (x * 4 != F.floor(x * 4))
    return F.when(tie, F.floor(x * 100 + 0.5) / 100).otherwise(F.format_number(x, 2).try_cast("double"))


def clamp(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def numeric_set(c: Column, unit: str) -> Column:
    """The distinct numbers written before a unit, ascending."""
    hits = F.regexp_extract_all(F.lower(c), F.lit(UNIT[unit]), F.lit(1))
    return F.array_sort(F.array_distinct(F.filter(F.transform(hits, lambda x: F.translate(x, ",", ".").try_cast("double")), lambda x: x.isNotNull())))


def tokens(c: Column, drop: list[str] | None = None) -> Column:
    """Distinct words of a text in order, generic ones and single letters left out."""
    stop = F.array(*[F.lit(w) for w in (GENERIC if drop is None else drop)])
    return F.array_distinct(F.filter(F.split(numbered(c), "[^a-z0-9]+"), lambda w: ((F.length(w) > 1) | w.rlike("[0-9]")) & ~F.array_contains(stop, w)))


def token_weight(w: Column) -> Column:
    return F.when(w.isin(*SPECIAL), 1.45).when(w.rlike("[0-9]"), 1.4).when(F.length(w) <= 2, 0.75).otherwise(1.0)


def jaccard(a: Column, b: Column) -> Column:
    n = F.size(F.array_union(a, b))
    return F.when(n > 0, F.size(F.array_intersect(a, b)) / n).otherwise(0.0)


def numeric_similarity(a: Column, b: Column, partial: float = 0.72) -> Column:
    """Two number sets: null without numbers on either side, 1 equal, partial overlapping, 0 disjoint."""
    return (
        F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(None).cast("double"))
        .when((F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) == 0), 1.0)
        .when(F.arrays_overlap(a, b), partial)
        .otherwise(0.0)
    )


def sets_conflict(a: Column, b: Column) -> Column:
    """Both filled and nothing in common."""
    return (F.size(a) > 0) & (F.size(b) > 0) & ~F.arrays_overlap(a, b)


def status(decision: Column, confidence: Column, a_missing: Column, b_missing: Column) -> Column:
    """Where a variant pair ends: one side only, valid, probable, impossible or discarded."""
    return (
        F.when(b_missing, "a_only")
        .when(a_missing, "b_only")
        .when((decision == "match") & (confidence >= 0.95), "valid")
        .when(decision.isin("match", "possible") & (confidence >= 0.85), "probable")
        .when(confidence <= 0, "impossible")
        .otherwise("discarded_low_confidence")
    )


def confidence_label(percent: Column) -> Column:
    return F.when(percent >= 90, "high").when(percent >= 70, "medium").otherwise("low")


LIQUID = ["aroma_concentrate", "eliquid", "nicotine_salt", "base_booster"]
HARDWARE = ["kit_device", "mod_device"]
PARTS = ["pod_replacement", "coil", "pyrex", "atomizer_tank"]


# Product types in the order they are tried. A rule is a type and the pattern of the text;
# the four with a condition of their own are written out in product_kind.
_COUNTED = r"\b(?:\d+\s*pcs|\d+\s*pc|\d+\s*unidades?|pack\s*\d+)\b"
_FIRST = [
    ("pouch", r"\b(?:pouch|pouches|nicotine pouch)\b"), ("cbd", r"\bcbd\b"),
    ("aroma_concentrate", r"\b(?:aroma|aromas|concentrado|concentrate|longfill|shortfill|shake and vape|alquimia|diy)\b"),
    ("base_booster", r"\b(?:base|bases|booster|nicokit|base neutra)\b"),
    ("nicotine_salt", r"\b(?:sales|salts|nic salt|nicotine salts|salt nic|sales de nicotina)\b"),
    ("eliquid", r"\b(?:liquido|liquidos|liquid|liquids|e-liquid|eliquid|e liquid)\b"),
]
_MIDDLE = [
    ("kit_device", r"\+\s*(?:itank|xtank|tank|atomizador|clearomizador|rta|rdta|rda)|\bcon\s+(?:itank|xtank|tank|atomizador|clearomizador)\b"),
    ("pyrex", r"\b(?:pyrex|glass|cristal)\b|deposito\s+de\s+pyrex"), ("atomizer_tank", r"\b(?:atomizador|atomizadores|tank|tanks|clearomizador|rta|rda|rdta)\b"),
    ("coil", r"\b(?:coil|coils|resistencia|resistencias)\b"),
    ("pod_replacement", r"\b(?:empty pod|replacement pod|pod replacement|cartridge|cartucho|pods? vacios?|pods? recambio|pack ?\d+|\d+\s*pcs|\d+\s*pc)\b"),
]
_LAST = [
    ("kit_device", r"\b(?:pod kit|kit pod|starter kit|kit|pod system|dispositivo|device|aio)\b"), ("disposable", r"\b(?:desechable|disposable)\b"),
    ("battery_charger", r"\b(?:bateria|battery|cargador|charger|pila)\b"), ("accessory", r"\b(?:algodon|cotton|drip tip|boquilla|accesorio|adapter|adaptador)\b"),
]


def reference_prefix(reference: Column) -> Column:
    """The first letter of a reference where a blank, point or dash follows it; else empty."""
    return F.regexp_extract(fold(reference), r"^([a-z])[\s.-]", 1)


def product_kind(name: Column, category: Column, category_id: Column, reference: Column, synthetic: Column, variants: Column) -> Column:
    """The product type: the first of 19 rules that fits, unknown if none does."""
    some = lambda c: F.nullif(c, F.lit(""))
    facts = F.struct(
        fold(F.concat_ws(" ", *[some(c) for c in (name, category, category_id, reference, synthetic)])).alias("t"),
        fold(F.array_join(F.transform(F.map_entries(variants), lambda e: F.concat_ws(" ", e["key"], e["value"])), " ")).alias("v"),
        F.coalesce(reference_prefix(reference), F.lit("")).alias("p"),
    )

    def first(f: Column) -> Column:
        t = f["t"]
        rules = [(n, t.rlike(p)) for n, p in _FIRST]
        rules.append(("pod_replacement", t.rlike(r"\bpod\b") & t.rlike(_COUNTED) & F.coalesce(f["v"].rlike(r"\b(?:ohm|ohmios|resistencia)\b"), F.lit(False))))
        rules.append(("kit_device", f["p"] == "k"))
        rules += [(n, t.rlike(p)) for n, p in _MIDDLE]
        rules.append(("mod_device", f["p"] == "m"))
        rules.append(("mod_device", t.rlike(r"\b(?:mod|mods|box mod|solo mod)\b") & ~t.rlike(r"\b(?:kit|pod kit|starter kit)\b")))
        rules += [(n, t.rlike(p)) for n, p in _LAST]
        out = None
        for n, hit in rules:
            out = F.when(hit, F.lit(n)) if out is None else out.when(hit, F.lit(n))
        return out.otherwise("unknown")

    return let(facts, first)


def type_group(kind: Column) -> Column:
    return F.when(kind.isin(*PARTS), "hardware_repuesto").when(kind.isin(*HARDWARE), "hardware_dispositivo").when(kind.isin(*LIQUID), "liquidos").otherwise(F.coalesce(F.nullif(kind, F.lit("")), F.lit("unknown")))


# Commercial categories by what the categories and the type contain, in order.
COMMERCIAL = [
    ("DESECHABLES", ["desech", "disposable"]), ("RESISTENCIAS", ["coil", "resistencia"]), ("ALQUIMIAS", ["aroma", "alquimia", "concentrate"]),
    ("NICOTINA", ["nicotine", "nicotina", "pouch", "sales"]), ("LIQUIDOS", ["eliquid", "liquid", "líquido", "liquido"]),
    ("MAQUINAS", ["kit_device", "mod_device", "pod_replacement", "atomizer_tank", "pyrex"]),
]


def commercial_category(*texts: Column) -> Column:
    """category, its sources, type and type group in one text; accents count."""

    def first(x: Column) -> Column:
        out = None
        for name, held in COMMERCIAL:
            hit = x.rlike("|".join(held))
            out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
        return out.otherwise("OTROS")

    return let(F.lower(F.concat_ws(" ", *texts)), first)

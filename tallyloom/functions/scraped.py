"""Names, brands, references and addresses as the capture side writes them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions import text as T
from tallyloom.functions.binding import let

# Hardware categories and their reference prefix; the words a reference body leaves out.
PREFIXES = {"COILS": "R", "DESECHABLE": "D", "BATERIAS Y CARGADORES": "B", "ATOMIZADORES": "C", "DIY": "W"}
HARDWARE_CATEGORIES = ["COILS", "DESECHABLE", "BATERIAS Y CARGADORES", "ATOMIZADORES", "DIY", "ACCESORIOS", "MODS Y KITS", "POD SYSTEMS", "NGP", "PREFILLED POD"]
KIT_CATEGORIES = ["MODS Y KITS", "POD SYSTEMS", "NGP", "PREFILLED POD"]
NO_BRAND = (
    "vaper vapers desechable desechables pack sabores bote sales de del la el los las un una y e o en con por para al ml nic top individual envase bolsa flores aceite aroma base "
    "nicokit cajetilla sobre sobres recargable pod pods"
).split()
#: The edge of a word of plain letters and digits.
EDGE = r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))"
#: A side's brand texts may carry these prefixes, one after the other.
BRAND_PREFIXES = ["grossiste", "e-liquides?", "marque", "marca", "fabricante"]


def trade_brand(c: Column) -> Column:
    """Lower case without trade words."""
    return T.trimmed(F.regexp_replace(F.regexp_replace(F.lower(c), r"\b(?:e-?liquids?|nic\s*salts?|salts?|vapes?|labs?|liquids?|flavou?rs?)\b", ""), r"\s+", " "))


def quoted(c: Column) -> Column:
    return F.concat(F.lit("\\Q"), F.replace(c, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))


def matching_name(name: Column, brands: Column) -> Column:
    """The words of a name that tell products apart: no measures, brands, product and filler words, signs."""
    n = F.lower(name)
    for p in (r"\b\d+\s*ml\b", r"\b\d+\s*mah\b", r"\b\d+\s*w\b", r"\b\d+\s*puffs?\b", r"\b\d+\s*mg\b", r"\b\d+\s*ohm\b", r"\(\d+\s*pcs\)", r"\(pack\s*\d+\)"):
        n = F.regexp_replace(n, p, "")
    known = F.filter(F.coalesce(brands, F.array().cast("array<string>")), lambda b: b.isNotNull() & (b != ""))
    n = F.aggregate(known, n, lambda acc, b: F.regexp_replace(acc, F.concat(F.lit(EDGE), quoted(F.lower(b)), F.lit(EDGE)), F.lit("")))
    for p, r in (
        (r"\b(?:kit|pod|pods|mod|mods|coil|coils|replacement|empty|drip\s*tip|glass|case|starter|vape|resistencias?|dep[oó]sitos?|pyrex|boquillas?|algod[oó]n|accesorios?)\b", ""),
        (r"\b(?:para|con|de|del|las?|los?|una?|el|y)\b", ""), (r"[+&/\\()\[\]{}.;:!?'\"_,]", " "), (r"\s*-\s*", " "), (r"\s+", " "),
    ):
        n = F.regexp_replace(n, p, r)
    return T.trimmed(n)


def base_name(name: Column, variants: Column) -> Column:
    """name without ` - a / b`, the values of its variants in their order."""
    suffix = F.concat(F.lit(" - "), F.array_join(F.map_values(variants), " / "))
    return F.when((F.size(variants) > 0) & F.endswith(name, suffix), F.substring(name, F.lit(1), F.length(name) - F.length(suffix))).otherwise(name)


def value_signature(variants: Column) -> Column:
    """The lower-case values in the order of their keys, measures left out."""
    entries = F.array_sort(F.transform(F.map_entries(variants), lambda e: F.struct(T.trimmed(F.lower(e["key"])).alias("k"), T.trimmed(F.lower(e["value"])).alias("v"))))
    joined = F.regexp_replace(F.array_join(F.transform(entries, lambda e: e["v"]), " "), r"(?iu)\b\d+\s*(?:ml|mah|w|ohm|mg|puffs?|pcs)\b", "")
    return F.when(F.size(variants) > 0, T.trimmed(F.regexp_replace(joined, r"\s+", " "))).otherwise("")


def value_slug(variants: Column) -> Column:
    entries = F.array_sort(F.transform(F.map_entries(variants), lambda e: F.struct(F.lower(e["key"]).alias("k"), e["value"].alias("v"))))
    joined = F.upper(F.array_join(F.transform(entries, lambda e: e["v"]), "-"))
    return F.when(F.size(variants) > 0, F.regexp_replace(F.regexp_replace(joined, "[^A-Z0-9]+", "-"), "^-|-$", "")).otherwise("")


def word_overlap(a: Column, b: Column) -> Column:
    """Similarity of two signatures: the Jaccard of their words or .85 of the containment, whichever is more."""

    def of(s: Column) -> Column:
        n = F.size(F.array_intersect(s["x"], s["y"]))
        return F.when(n == 0, 0.0).otherwise(F.greatest(n / F.size(F.array_union(s["x"], s["y"])), 0.85 * n / F.least(F.size(s["x"]), F.size(s["y"]))))

    words = lambda c: F.array_distinct(F.filter(F.split(c, r"\s+"), lambda w: w != ""))
    return F.when(a == b, 1.0).when((F.coalesce(a, F.lit("")) == "") | (F.coalesce(b, F.lit("")) == ""), 0.0).otherwise(let(F.struct(words(a).alias("x"), words(b).alias("y")), of))


def neutral_title(title: Column) -> Column:
    """The title without ` - 10 mg` and ` - 10 mg / 10 ml`."""
    t = F.regexp_replace(F.coalesce(title, F.lit("")), r"(?iu)\s+-\s*\d+(?:[.,]\d+)?\s*mg\s*/\s*\d+(?:[.,]\d+)?\s*ml\b", "")
    return T.trimmed(F.regexp_replace(F.regexp_replace(t, r"(?iu)\s+-\s*\d+(?:[.,]\d+)?\s*mg\b", ""), r"\s{2,}", " "))


def slug_of_url(url: Column) -> Column:
    return F.substring_index(F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), "/$", ""), "/", -1)


def title_of_slug(slug: Column) -> Column:
    """The words of a slug, each with a capital first letter."""
    words = F.filter(F.split(slug, "-"), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, F.lit(2), F.length(w)))), " ")


def brand_of_url_or_name(url: Column, name: Column) -> Column:
    """First word of the subcategory of a `/producto/` address, else the first capitalised word of the name that says something."""
    parts = F.filter(F.split(F.regexp_extract(url, r"/producto/([^?#]+)", 1), "/"), lambda s: s != "")
    sub = F.split(F.get(parts, F.size(parts) - 2), "-")[0]
    from_url = F.when((F.size(parts) >= 4) & (F.length(sub) > 2) & ~F.lower(sub).isin(*NO_BRAND), F.concat(F.upper(F.substring(sub, 1, 1)), F.substring(sub, F.lit(2), F.length(sub))))
    plain = lambda w: F.regexp_replace(F.lower(w), "[^a-záéíóúñ]", "")
    words = F.filter(F.split(name, r"\s+"), lambda w: (F.length(plain(w)) > 2) & ~plain(w).isin(*NO_BRAND) & w.rlike("^[A-ZÁÉÍÓÚÑ]"))
    return F.coalesce(from_url, F.get(words, F.lit(0)))


def stripped_prefixes(brand: Column) -> Column:
    """The brand without any run of prefixes; null where nothing is left."""
    return F.nullif(T.trimmed(F.regexp_replace(T.trimmed(brand), rf"(?iu)^(?:(?:{'|'.join(BRAND_PREFIXES)})\b[\s:]*)+", "")), F.lit(""))


def reference_suffix(reference: Column, base: Column) -> Column:
    """What a reference adds to `base-`, signs as blanks, upper case; null where it adds nothing."""
    rest = T.trimmed(F.substring(reference, F.length(base) + 2, F.length(reference)))
    said = F.upper(T.trimmed(F.regexp_replace(F.regexp_replace(rest, "[._-]+", " "), r"\s+", " ")))
    return F.when(F.startswith(reference, F.concat(base, F.lit("-"))) & (rest != ""), said)


def synthetic_reference(title: Column, brand: Column, category: Column) -> Column:
    """PREFIX-BODY of a hardware title: prefix by category, body in dotted upper case without brand, type words and measures."""
    accessory = F.when(title.rlike(r"(?iu)\b(?:tank|pod\s+replacement|atomiz|rda|rta|rdta|cartridge|clearomiz|depósito)\b"), "C").otherwise("A")
    prefix = None
    for name, letter in PREFIXES.items():
        prefix = F.when(category == name, letter) if prefix is None else prefix.when(category == name, letter)
    prefix = prefix.when(category == "ACCESORIOS", accessory).otherwise("K")
    kit = category.isin(*KIT_CATEGORIES)
    body = T.trimmed(F.regexp_replace(title, F.concat(F.lit("(?iu)^(.*?)"), quoted(brand)), F.lit("$1")))
    body = F.regexp_replace(body, r"(?iu)\b(?:kit|pod kit|starter kit|mod)\b", "")
    body = F.when(kit, F.regexp_replace(body, r"(?iu)\btank\b", "")).otherwise(body)
    for p in (r"(?iu)\b(?:replacement|refill|empty|disposable|desechable)\b", r"(?iu)\b(?:coil|coils|mesh coil)\b", r"(?iu)\b(?:battery|bateria|batería)\b", r"(?iu)\bpod\b",
              r"(?iu)\b\d+\s*ml\b", r"(?iu)\b\d+\s*mah\b", r"(?iu)\b\d+\s*w\b", r"(?iu)\b\d+\s*ohm\b", r"(?iu)\b\d+\s*puffs?\b"):
        body = F.regexp_replace(body, p, "")

    def finished(b: Column) -> Column:
        pack = F.regexp_extract(b, r"(?iu)\(?pack\s*(\d+)\)?", 1)
        rest = F.regexp_replace(b, r"(?iu)\(?pack\s*\d+\)?", "")
        rest = F.when(kit, F.regexp_replace(rest, r"\s*\+\s*.+$", "")).otherwise(rest)
        rest = F.regexp_replace(F.regexp_replace(F.regexp_replace(rest, "[-_]", " "), r"[()\[\]{}]", ""), r"[+&/\;:!?'\",.]", " ")
        dotted = F.regexp_replace(F.upper(T.trimmed(F.regexp_replace(rest, r"\s+", " "))), r"\s+", ".")
        whole = F.regexp_replace(F.concat(dotted, F.when(pack != "", F.concat(F.lit(".P"), pack)).otherwise("")), r"^\.+|\.+$", "")
        return F.when((whole != "") & category.isin(*HARDWARE_CATEGORIES) & (brand != "") & (title != ""), F.concat(prefix, F.lit("-"), whole))

    return let(body, finished)


def variant_url(base: Column, segments: Column) -> Column:
    """base#/a/b for the segments there are, base where there are none."""
    known = F.filter(segments, lambda s: s.isNotNull() & (s != ""))
    return F.when(F.size(known) > 0, F.concat(F.substring_index(base, "#", 1), F.lit("#/"), F.array_join(known, "/"))).otherwise(base)


def ean_of_url(url: Column) -> Column:
    """The 13 digits at the end of an address's slug."""
    return F.nullif(F.regexp_extract(url, r"[-/](\d{13})(?:\.html)?(?:[?#].*)?$", 1), F.lit(""))

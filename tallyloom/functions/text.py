"""Text normalisation, keys and identifiers as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.binding import let


def _unaccented() -> dict[str, str]:
    """Every accented letter and the letter under its accents."""
    out = {}
    for code in range(0xC0, 0x2000):
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) > 1 and not unicodedata.combining(parts[0]) and all("\u0300" <= c <= "\u036f" for c in parts[1:]):
            out[chr(code)] = parts[0]
    return out


ACCENTED, PLAIN = ("".join(x) for x in zip(*_unaccented().items()))
#: What counts as a blank.
BLANK = "[\\s\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{feff}]"
# Dimension names and what they are called in the output.
VARIANT_NAMES = [
    ("color", ["color", "colour"]),
    ("reference_color", ["reference color", "reference colour", "color referencia", "colour reference", "color de referencia"]),
    ("pod_type", ["tipo de pod", "tipo pod", "pod type", "type of pod"]),
    ("resistencia", ["ohm", "ohmios", "resistencia"]),
    ("capacidad", ["capacidad", "ml", "tamano", "size"]),
    ("nicotina", ["nicotina", "mg", "sales de nicotina"]),
    ("base_ratio", ["vgpg", "pgvg", "vg/pg", "pg/vg", "compuesto base"]),
    ("sabor", ["elige sabor", "sabor", "flavor", "flavour"]),
    ("cafeina", ["cafeina"]),
]


def unaccented(c: Column) -> Column:
    """Lower case without accents."""
    return F.lower(F.regexp_replace(F.translate(c, ACCENTED, PLAIN), "[\u0300-\u036f]", ""))


def fold(c: Column) -> Column:
    """Lower case without accents, trimmed; blanks inside stay."""
    return trimmed(unaccented(c))


def trimmed(c: Column) -> Column:
    """Without blanks of any kind at either end."""
    return F.regexp_replace(c, f"^{BLANK}+|{BLANK}+$", "")


def plain(c: Column) -> Column:
    return F.trim(F.regexp_replace(unaccented(c), f"{BLANK}+", " "))


def roman(c: Column) -> Column:
    """plain, with ii, iii and iv as digits."""
    for numeral, digit in (("iii", "3"), ("ii", "2"), ("iv", "4")):
        c = F.regexp_replace(c, rf"\b{numeral}\b", digit)
    return c


def numbered(c: Column) -> Column:
    return roman(plain(c))


def compact(c: Column) -> Column:
    """Letters a-z and digits only."""
    return F.regexp_replace(plain(c), "[^a-z0-9]+", "")


def reference_key(c: Column) -> Column:
    """Upper-case letters and digits, accents not folded."""
    return F.regexp_replace(F.upper(c), "[^A-Z0-9]+", "")


def slug(c: Column, longest: int = 120) -> Column:
    return F.substring(F.regexp_replace(F.regexp_replace(plain(c), "[^a-z0-9]+", "-"), "^-+|-+$", ""), 1, longest)


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def short_text(c: Column, longest: int) -> Column:
    """Blanks collapsed; cut with an ellipsis where longer."""
    t = F.trim(F.regexp_replace(c, r"\s+", " "))
    return F.when(F.length(t) > longest, F.concat(F.rtrim(F.substring(t, 1, longest - 1)), F.lit("…"))).otherwise(t)


def listed(c: Column) -> Column:
    """A `|` or `,` delimited text as an array of its non-blank parts."""
    return F.filter(F.transform(F.split(c, "[|,]"), F.trim), lambda x: x != "")


def variant_name(c: Column) -> Column:
    """The canonical name of a dimension; others keep their folded name, blank ones are `variante`."""

    def first(k: Column) -> Column:
        out = None
        for name, spelled in VARIANT_NAMES:
            out = F.when(k.isin(*spelled), F.lit(name)) if out is None else out.when(k.isin(*spelled), F.lit(name))
        return out.otherwise(F.coalesce(F.nullif(k, F.lit("")), F.lit("variante")))

    return let(fold(c), first)


def sorted_entries(m: Column) -> Column:
    return F.array_sort(F.map_entries(m))


def signature(m: Column) -> Column:
    """key=value of every dimension, keys sorted, both in plain form."""
    return F.array_join(F.transform(F.array_sort(F.transform(F.map_entries(m), lambda e: F.concat(plain(e["key"]), F.lit("="), plain(e["value"])))), lambda x: x), "|")


def label(m: Column) -> Column:
    """Values in the order of their keys."""
    return F.array_join(F.transform(sorted_entries(m), lambda e: F.trim(e["value"])), " / ")


def decode_entities(c: Column) -> Column:
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(sign))
    return c


def redacted_diagnostics(c: Column) -> Column:
    """Addresses and secrets of a diagnostic text replaced by placeholders."""
    c = F.regexp_replace(c, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[EMAIL_REDACTED]")
    return F.regexp_replace(c, r"(?i)\b(api[_-]?key|token|secret|password)\s*[=:]\s*\S+", "$1=[REDACTED]")


def fragmentless(url: Column) -> Column:
    return F.split(url, "#")[0]


def url_key(url: Column) -> Column:
    return F.lower(F.regexp_replace(fragmentless(url), "/+$", ""))


def canonical_url(url: Column) -> Column:
    """No fragment, no tracking parameters, no slash before the query or the end."""
    bare = fragmentless(url)
    path = F.regexp_replace(F.split(bare, r"\?")[0], "/+$", "")
    query = F.when(F.instr(bare, "?") > 0, F.substring_index(bare, "?", -1)).otherwise("")
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("(?i)^(?:utm_|fbclid|gclid|ref|mc_)")), "&")
    return F.when(kept == "", path).otherwise(F.concat(path, F.lit("?"), kept))


def ean13(c: Column) -> Column:
    """The text if it is an EAN-13 with a right check digit, else null."""
    digits = F.regexp_replace(c, r"\s", "")
    total = F.aggregate(
        F.sequence(F.lit(1), F.lit(12)), F.lit(0), lambda a, i: a + F.substring(digits, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 3).otherwise(1)
    )
    return F.when(digits.rlike(r"^\d{13}$"), F.when(F.pmod(10 - F.pmod(total, F.lit(10)), F.lit(10)) == F.substring(digits, 13, 1).cast("int"), digits))


def generated_sku(brand: Column, *parts: Column) -> Column:
    """Brand slug and eight hex digits of the parts' SHA-256."""
    return F.concat(slug(brand), F.lit("-"), F.upper(F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 8)))


def reference_body(c: Column) -> Column:
    """The letters before the number of a reference such as CO-MAMORO.MES-72154."""
    return F.nullif(F.regexp_extract(F.upper(c), r"^[A-Z]{2}[-.]([A-Z0-9]+)", 1), F.lit(""))


def comparison_hash(*cols: Column) -> Column:
    """SHA-256 of the fields in their plain form, nulls as empty."""
    return F.sha2(F.array_join(F.array(*[F.coalesce(plain(c.cast("string")), F.lit("")) for c in cols]), "\u001f"), 256)


def coalesce_filled(*cols: Column) -> Column:
    """The first text that is neither null nor blank."""
    return F.coalesce(*[blank_to_null(c) for c in cols])



"""Visually identical text with different characters brought to one form, by script sets."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Letters of other scripts that look like a Latin letter.
LATIN_LOOK = {
    # Cyrillic
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X",
    "І": "I", "Ї": "Ï", "Ј": "J", "Ѕ": "S", "Ѵ": "V", "Ԛ": "Q", "Ԝ": "W", "Һ": "H", "Ӏ": "I", "Ԍ": "G", "Ԁ": "D",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ї": "ï", "ј": "j", "ѕ": "s", "һ": "h",
    "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v", "ӏ": "l", "ѐ": "è", "ё": "ë", "Ё": "Ë", "Ѐ": "È", "ү": "y", "Ү": "Y", "г": "r",
    # Greek
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T",
    "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J", "Ά": "Á", "Έ": "É", "Ή": "H", "Ί": "Í", "Ό": "Ó", "Ύ": "Ý",
    "α": "a", "ά": "á", "γ": "y", "ι": "i", "ί": "í", "κ": "k", "ν": "v", "ο": "o", "ό": "ó", "ρ": "p", "σ": "o", "υ": "u",
    "ύ": "ú", "ϲ": "c", "ϳ": "j", "η": "n", "τ": "t",
    # Armenian
    "Ս": "U", "Օ": "O", "Լ": "L", "ս": "u", "օ": "o", "ո": "n", "հ": "h", "ց": "g", "զ": "q", "ք": "p", "յ": "j", "ւ": "i",
    # Cherokee
    "Ꭰ": "D", "Ꭱ": "R", "Ꭲ": "T", "Ꭵ": "i", "Ꭹ": "Y", "Ꭺ": "A", "Ꭻ": "J", "Ꭼ": "E", "Ꮃ": "W", "Ꮇ": "M", "Ꮋ": "H", "Ꮍ": "Y", "Ꮐ": "G", "Ꮒ": "h",
    "Ꮓ": "Z", "Ꮟ": "b", "Ꮢ": "R", "Ꮤ": "W", "Ꮥ": "S", "Ꮩ": "V", "Ꮪ": "S", "Ꮮ": "L", "Ꮯ": "C", "Ꮲ": "P", "Ꮶ": "K", "Ꮷ": "d", "Ᏻ": "G", "Ᏼ": "B",
    # Coptic
    "Ⲏ": "H", "Ⲓ": "I", "Ⲕ": "K", "Ⲙ": "M", "Ⲛ": "N", "Ⲟ": "O", "ⲟ": "o", "Ⲣ": "P", "ⲣ": "p", "Ⲥ": "C", "ⲥ": "c", "Ⲧ": "T", "Ⲩ": "Y", "Ⲭ": "X",
    # Lisu
    "ꓐ": "B", "ꓑ": "P", "ꓒ": "d", "ꓓ": "D", "ꓔ": "T", "ꓖ": "G", "ꓗ": "K", "ꓙ": "J", "ꓚ": "C", "ꓜ": "Z", "ꓝ": "F", "ꓟ": "M", "ꓠ": "N", "ꓡ": "L",
    "ꓢ": "S", "ꓣ": "R", "ꓦ": "V", "ꓧ": "H", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓮ": "A", "ꓰ": "E", "ꓲ": "I", "ꓳ": "O", "ꓴ": "U",
    # Latin letters of other uses
    "ɑ": "a", "ɡ": "g", "ı": "i", "ɩ": "i", "ʏ": "y", "ᴏ": "o", "ᴄ": "c", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z", "ꜱ": "s", "ʜ": "H",
}
# Marks that look like the usual one, and signs that are meant as they are.
MARK_LOOK = {"‐": "-", "‑": "-", "⁃": "-", "˗": "-", "﹣": "-", "ꞏ": "·", "∕": "/", "⁄": "/", "․": ".", "ǃ": "!", "ⵑ": "!"}
MEANT_AS_SUCH = set("ΩÅµªº™℠№℃℉…")
_FILLERS = set("͏ᅟᅠ឴឵᠋᠌᠍᠎⠀ㅤﾠ")
_LOOK_OF: dict[str, dict[str, str]] = {}
_LETTERS = regex.compile(r"[\p{L}\p{M}]+")
_UNUSUAL = re.compile(r"[^ -~]")
# Scripts whose shared letters are looked up, and the writing systems that mix scripts.
_TRIED = "Latin Greek Cyrillic Armenian Hebrew Arabic Syriac Thaana Devanagari Bengali Georgian Hangul Cherokee Coptic Lisu Han Hiragana Katakana Bopomofo".split()
_SYSTEMS = {"HAN": ["JPAN", "KORE", "HANB"], "HIRAGANA": ["JPAN"], "KATAKANA": ["JPAN"], "HANGUL": ["KORE"], "BOPOMOFO": ["HANB"]}
_EXTENSIONS = {name.upper(): regex.compile(rf"\p{{scx={name}}}") for name in _TRIED}
_SCRIPTS: dict[str, frozenset[str] | None] = {}


def scripts(ch: str) -> frozenset[str] | None:
    """The resolved script set of a letter: its script extensions and the writing systems that use
    them; None for the characters of every script."""
    if ch not in _SCRIPTS:
        _SCRIPTS[ch] = _resolved(ch)
    return _SCRIPTS[ch]


def _resolved(ch: str) -> frozenset[str] | None:
    head = unicodedata.name(ch, "").split(" ", 1)[0]
    if unicodedata.category(ch)[0] == "M" or head in ("MODIFIER", "FEMININE", "MASCULINE", "MICRO", "OHM"):
        return None
    found = {name for name, pattern in _EXTENSIONS.items() if pattern.match(ch)}
    if not found:
        return frozenset({head}) if regex.match(r"\p{L}", ch) and not regex.match(r"\p{scx=Common}", ch) else None
    return frozenset(found.union(*[_SYSTEMS.get(name, ()) for name in found]))


def look_in(ch: str, script: str) -> str | None:
    """The letter of `script` that looks like ch, or ch itself if it belongs there."""
    s = scripts(ch)
    if s is None or script in s:
        return ch
    if script == "LATIN":
        return LATIN_LOOK.get(ch)
    if not _LOOK_OF:
        for other, latin in LATIN_LOOK.items():
            for own in scripts(other) or ():
                _LOOK_OF.setdefault(own, {}).setdefault(latin, other)
    latin = ch if "LATIN" in s else LATIN_LOOK.get(ch)
    return _LOOK_OF.get(script, {}).get(latin) if latin else None


def spelled(token: str) -> str:
    """The token in the script that can spell all of it, Latin first; unchanged where none can.

    The scripts of all letters are intersected. An empty intersection is a mixed-script token;
    a single foreign script whose every letter has a Latin look-alike is a whole-script
    confusable. A foreign word with a letter of its own keeps its script.
    """
    common: frozenset[str] | None = None
    present: list[str] = []
    odd = False
    for ch in token:
        s = scripts(ch)
        odd = odd or (ch in LATIN_LOOK and s is not None and "LATIN" in s)
        if s is None:
            continue
        common = s if common is None else common & s
        present.extend(x for x in s if x not in present)
    if common is None or ("LATIN" in common and not odd):
        return token
    targets = ["LATIN", *sorted(present, key=lambda x: (-sum(x in (scripts(c) or ()) for c in token), x))]
    if common and "LATIN" not in common:
        targets = ["LATIN"]
    for target in targets:
        out = [LATIN_LOOK[c] if target == "LATIN" and c in LATIN_LOOK else look_in(c, target) for c in token]
        if all(x is not None for x in out):
            return "".join(out)  # type: ignore[arg-type]
    return token


def invisible(ch: str) -> bool:
    cat = unicodedata.category(ch)
    return cat == "Cf" or ch in _FILLERS or "︀" <= ch <= "️" or (cat == "Cc" and ch not in "\t\n\r\v\f\x1c\x1d\x1e\x1f\x85")


def blank(ch: str) -> bool:
    return ch != " " and (unicodedata.category(ch) in ("Zs", "Zl", "Zp") or ch in "\t\n\r\v\f\x1c\x1d\x1e\x1f\x85")


def usual(ch: str) -> str:
    """The usual character a compatibility form stands in for; signs meant as such stay."""
    if ch in MARK_LOOK:
        return MARK_LOOK[ch]
    if ch < "Ā" or ch in MEANT_AS_SUCH:
        return ch
    cat = unicodedata.category(ch)
    if cat == "Nd":
        return str(unicodedata.digit(ch))
    plain = unicodedata.normalize("NFKC", ch)
    if plain == ch:
        return ch
    if "＀" <= ch <= "￯" or cat[0] == "L" or unicodedata.normalize("NFC", ch) != ch:
        return plain
    return ch


def consistent(text: str) -> str:
    """One form for all spellings that look the same.

    Invisible characters go, other blanks become the plain one, compatibility forms the usual
    character, each run of letters gets its consistent script, and accents join their letter.
    Idempotent; letter case, signs and foreign words stay.
    """
    if text.isascii() and text.isprintable():
        return text
    joined = unicodedata.normalize("NFC", _UNUSUAL.sub(lambda m: _one(m.group(0)), text))
    if all(_plain_latin(ch) for ch in set(joined) if ch > "~"):
        return joined
    return unicodedata.normalize("NFC", _LETTERS.sub(lambda m: m.group(0) if m.group(0).isascii() else spelled(m.group(0)), joined))


@lru_cache(maxsize=None)
def _one(ch: str) -> str:
    """What one character becomes whatever stands beside it."""
    return "" if invisible(ch) else " " if blank(ch) else usual(ch)


@lru_cache(maxsize=None)
def _plain_latin(ch: str) -> bool:
    """Whether a character gives a token no reason to be respelled."""
    return unicodedata.category(ch)[0] != "L" or (ch not in LATIN_LOOK and scripts(ch) in (None, frozenset({"LATIN"})))


def folded(text: str) -> str:
    """consistent, lower case and without accents: the key for comparisons."""
    low = consistent(text).lower()
    if low.isascii():
        return low
    return _UNUSUAL.sub(lambda m: "" if unicodedata.combining(m.group(0)) else m.group(0), unicodedata.normalize("NFD", low))


def _keeps(ch: str) -> bool:
    """Whether a character comes through `consistent` as it is in any value of such characters only."""
    cat = unicodedata.category(ch)
    if cat[0] == "M" or cat in ("Cs", "Cn", "Co") or unicodedata.combining(ch) or consistent(ch) != ch or unicodedata.normalize("NFC", ch) != ch:
        return False
    return _plain_latin(ch)


@lru_cache(maxsize=1)
def usual_class() -> str:
    """The pattern of the values that `consistent` leaves alone, found by asking it for every character.

    No letter of it is of another script than Latin or looks like one of another use, and none
    joins its neighbour, so a value of such characters changes only if one of them does alone.
    """
    ranges: list[list[int]] = []
    for code in range(0x20, 0x10000):
        if _keeps(chr(code)):
            if ranges and ranges[-1][1] == code - 1:
                ranges[-1][1] = code
            else:
                ranges.append([code, code])
    return "^[" + "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in ranges) + "]*$"


#: Plain and Western letters, a part of usual_class that is told at once.
QUICK_CLASS = "^[\\x20-\\x7e\\u00c0-\\u00ff]*$"


def is_usual(c: Column) -> Column:
    return c.rlike(QUICK_CLASS) | c.rlike(usual_class())


def _udf(fn, kind: str = "string"):
    @F.pandas_udf(kind)
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo: dict[str, object] = {}
        for s in batches:
            if len(memo) > 100_000:
                memo.clear()
            out = []
            for t in s:
                if t is None:
                    out.append(None)
                    continue
                got = memo.get(t)
                if got is None:
                    got = memo[t] = fn(t)
                out.append(got)
            yield pd.Series(out, dtype="object")

    return apply


def consistent_col(c: Column) -> Column:
    return _udf(consistent)(c)


def folded_col(c: Column) -> Column:
    return _udf(folded)(c)


def disguised_values(df: DataFrame, ids: list[str], columns: list[str]) -> DataFrame:
    """ids, field, value, normal: the values that change when brought to the consistent form.

    Null values give no row; a value of usual characters only never leaves the JVM. Values of
    any length are read whole; repeated rows give their rows again.
    """
    values = (
        df.select(*ids, F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns])).alias("_v"))
        .select(*ids, "_v.field", "_v.value")
        .where(F.col("value").isNotNull() & ~is_usual(F.col("value")))
    )
    return values.withColumn("normal", consistent_col(F.col("value"))).where("normal <> value")


def normalized(df: DataFrame, ids: list[str], columns: list[str]) -> DataFrame:
    """ids and the columns in their consistent form; nulls stay null."""
    return df.select(
        *ids,
        *[F.when(is_usual(F.col(c)), F.col(c)).otherwise(consistent_col(F.when(~is_usual(F.col(c)), F.col(c)))).alias(c) for c in columns],
    )

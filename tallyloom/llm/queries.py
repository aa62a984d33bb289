"""Queries of the text and matching problems 2, 3, 5, 7, 8 and 9."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import canonical, leaks, mixing, pii, same_item, unify
from tallyloom.session import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.product_brands(table(spark, d, "product"), table(spark, d, "brand_ref")).select("row_id", "field", "pos", "brand_id")


def p2_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """The texts that mean no listed brand, with their number of occurrences."""
    return (
        canonical.product_brands(table(spark, d, "product"), table(spark, d, "brand_ref"))
        .where("brand_id = -1")
        .groupBy("text")
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return unify.disguised_values(table(spark, d, "product"), ["row_id"], ["name", "reference"]).select("row_id", "field")


def p3_normalized(spark: SparkSession, d: str) -> DataFrame:
    return unify.normalized(table(spark, d, "product"), ["row_id"], ["name", "reference"])


def p5_groups(spark: SparkSession, d: str) -> DataFrame:
    return same_item.item_groups(table(spark, d, "product"), table(spark, d, "brand_ref")).select("row_id", "item_id")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return same_item.item_pairs(same_item.item_groups(table(spark, d, "product"), table(spark, d, "brand_ref")))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaked(table(spark, d, "documents"), table(spark, d, "eval_item"))


def p7_item_report(spark: SparkSession, d: str) -> DataFrame:
    """Every leaked item with the number of documents that hold it."""
    found = leaks.leaked(table(spark, d, "documents"), table(spark, d, "eval_item"))
    return found.groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixed(table(spark, d, "documents"), table(spark, d, "mix_target"))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    targets = table(spark, d, "mix_target")
    return mixing.share_report(mixing.mixed(table(spark, d, "documents"), targets), targets)


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.personal_data(table(spark, d, "documents"), pii.pseudonym_key(spark)).select("doc_id", "kind", "found_text")


def p9_links(spark: SparkSession, d: str) -> DataFrame:
    """How many documents hold the same value, per kind; values stay hidden behind their pseudonyms."""
    found = pii.personal_data(table(spark, d, "documents"), pii.pseudonym_key(spark))
    per_value = found.groupBy("kind", "pseudonym").agg(F.countDistinct("doc_id").alias("documents"))
    return per_value.groupBy("kind", "documents").agg(F.count(F.lit(1)).alias("values"))


def p9_redacted(spark: SparkSession, d: str) -> DataFrame:
    return pii.redacted(table(spark, d, "documents"), pii.pseudonym_key(spark))


def p9_redacted_dates(spark: SparkSession, d: str) -> DataFrame:
    """p9_redacted with calendar dates replaced as well."""
    return pii.redacted(table(spark, d, "documents"), pii.pseudonym_key(spark), dates=True)


QUERIES = {
    "p5_found": p5_found,
    "p5_groups": p5_groups,
    "p7_found": p7_found,
    "p7_item_report": p7_item_report,
    "p8_mix": p8_mix,
    "p8_shares": p8_shares,
    "p9_found": p9_found,
    "p9_links": p9_links,
    "p9_redacted": p9_redacted,
    "p9_redacted_dates": p9_redacted_dates,
    "p2_found": p2_found,
    "p2_unmatched": p2_unmatched,
    "p3_found": p3_found,
    "p3_normalized": p3_normalized,
}

_LOOKS = "".join(unify.LATIN_LOOK)
_MARKS = "".join(c for c in unify.MARK_LOOK if c != "ǃ")
_ODD = (
    "regexp_matches(v, '[\\p{Cf}\\x{034F}\\x{115F}\\x{1160}\\x{3164}\\x{FFA0}\\x{2800}\\x{17B4}\\x{17B5}\\x{180B}-\\x{180E}\\x{FE00}-\\x{FE0F}\\x{00}-\\x{1F}\\x{7F}-\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]') "
    f"or nfc_normalize(v) <> v or regexp_matches(v, '[\\x{{FF01}}-\\x{{FFEF}}\\x{{1D400}}-\\x{{1D7FF}}\\x{{FB00}}-\\x{{FB06}}{_MARKS}]') "
    "or len(list_filter(regexp_extract_all(v, '[\\p{L}\\p{M}]+'), lambda t: (regexp_matches(t, '\\p{Latin}') and "
    f"regexp_matches(t, '[{_LOOKS}]')) or regexp_full_match(t, '[{_LOOKS}]+'))) > 0"
)
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
_FROM = "".join(unify.LATIN_LOOK) + _WIDE
_TO = "".join(unicodedata.normalize("NFC", x) for x in unify.LATIN_LOOK.values()) + "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F))
_HIDDEN = "[\\p{Cf}\\x{034F}\\x{115F}\\x{1160}\\x{3164}\\x{FFA0}\\x{2800}\\x{180B}-\\x{180E}\\x{FE00}-\\x{FE0F}]"
_BLANKS = "[\\p{Zs}\\p{Zl}\\p{Zp}\\s]"


def _folded_sql(c: str) -> str:
    return f"lower(strip_accents(translate(regexp_replace(regexp_replace({c}, '{_HIDDEN}', '', 'g'), '{_BLANKS}', ' ', 'g'), '{_FROM.replace(chr(39), chr(39) * 2)}', '{_TO.replace(chr(39), chr(39) * 2)}')))"


def _key_sql(f: str) -> str:
    """The folded text as plain words, step by step."""
    t = f"regexp_replace({f}, '[®™©]|\\btm\\b', ' ', 'g')"
    for _ in range(2):
        t = f"regexp_replace({t}, '(\\w)[.''’](\\w)', '\\1\\2', 'g')"
    t = f"trim(regexp_replace(regexp_replace({t}, '\\((?:oficial|official)\\)', ' ', 'g'), '[^\\p{{L}}\\p{{N}}&]+', ' ', 'g'))"
    t = f"array_to_string(list_transform(string_split({t}, ' '), lambda w: case when regexp_matches(w, '\\p{{L}}') then translate(w, '01345', 'oieas') else w end), ' ')"
    t = f"regexp_replace({t}, '^(?:(?:by|de la marca|marca|fabricante|brand|de) )+(\\S{{3}})', '\\1')"
    t = f"regexp_replace({t}, '(\\S)(?: (?:oficial|official|vape|espana|spain|iberia|sales|store|shop))+$', '\\1')"
    return f"regexp_replace({t}, '(\\S{{3}}) (?:s ?l ?u?|s ?a ?s?|ltda?|lda|gmbh|inc|llc|bv|srl|technology co|co)$', '\\1')"


_MULTISET = "(string_split({0}, '') || list_transform(range(1, length({0})), lambda i: substr({0}, i::int, 2)))"
_A, _B = _MULTISET.format("a"), _MULTISET.format("b")
_BRANDS = f"""
    raw as (select row_id, 'brand' as field, 0 as pos, brand as text from product union all select row_id, 'commercial_brand', 0, commercial_brand from product
            union all select row_id, 'brand_candidates', e.i, e.x from (select row_id, unnest(list_transform(brand_candidates, lambda x, i: {{'x': x, 'i': i - 1}})) as e from product)),
    told as (select * from raw where text is not null and regexp_matches(text, '[^\\s\\p{{Z}}]')),
    keyed as (select text, {_key_sql(_folded_sql('text'))} as key from (select distinct text from told)),
    own as (select distinct key, replace(key, ' ', '') as a, false as turned from keyed where key <> '' union all select distinct key, array_to_string(list_sort(string_split(key, ' ')), ''), true from keyed where key like '% %'),
    name0 as (select brand_id as entry, {_key_sql(_folded_sql('n'))} as key, kind from (select brand_id, brand_name as n, 0 as kind from brand_ref union all select brand_id, legal_name, 1 from brand_ref) where n is not null and brand_id is not null),
    names as (select entry, key, min(kind) as kind from name0 where key <> '' group by 1, 2),
    firsts as (select entry, split_part(key, ' ', 1) as b, 10 as kind from names where length(split_part(key, ' ', 1)) >= 4),
    begun as (select entry, replace(substr(key, 1, unnest(range(length(split_part(key, ' ', 1)) + 2, length(key)))::int), ' ', '') as b, 20 as kind from names where length(key) > length(split_part(key, ' ', 1)) + 2),
    sole as (select b, kind, min(entry) as entry from (select * from firsts union select * from begun) group by 1, 2 having count(*) = 1),
    forms as (select entry, b, turned, min(kind) as kind from (select entry, replace(key, ' ', '') as b, false as turned, kind from names union all select entry, array_to_string(list_sort(string_split(key, ' ')), ''), true, kind from names where key like '% %'
              union all select entry, b, false, kind from sole) group by 1, 2, 3),
    near as (select key, entry, kind, a, b from own join forms using (turned) where abs(length(a) - length(b)) <= 1 and length(b) >= 5 and kind <> 20 and a <> b and damerau_levenshtein(a, b) = 1),
    shared as (select key, entry, kind, list_sum(list_transform(list_distinct({_A}), lambda x: least(len(list_filter({_A}, lambda y: y = x)), len(list_filter({_B}, lambda y: y = x))))) as n, len({_A}) + len({_B}) as whole from near),
    met as (select key, entry, kind, 1.0::double as j from own join forms using (turned) where a = b union all select key, entry, kind, n::double / (whole - n) from shared),
    best as (select key, entry from met qualify row_number() over (partition by key order by round(j, 9) desc, kind, entry) = 1),
    mapped as (select told.*, coalesce(entry, -1)::int as brand_id from told join keyed using (text) left join best using (key))"""
SQL = {
    "p2_found": f"with {_BRANDS} select row_id, field, pos::int as pos, brand_id from mapped",
    "p2_unmatched": f"with {_BRANDS} select text, count(*) as occurrences from mapped where brand_id = -1 group by 1",
    "p3_found": f"select row_id, field from (select row_id, 'name' as field, name as v from product union all select row_id, 'reference', reference from product) where v is not null and ({_ODD})",
}

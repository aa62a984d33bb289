"""Queries of the capture-side texts, the master's guard and resolution, the loader and the reports, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import rescue, scraped
from tallyloom.functions import similarity as S
from tallyloom.functions import text as T
from tallyloom.functions import variants as V
from tallyloom.operators import assign, catalog, loading, products
from tallyloom.plans import products_sql as Q
from tallyloom.plans.sql import BLANK, sql_compact, sql_fold, sql_group, sql_numbered, sql_plain, sql_type
from tallyloom.session import bounded, table

QUERIES = {}
SQL = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def _nested(column: str, *steps: tuple[str, str]) -> str:
    for pattern, by in steps:
        column = f"regexp_replace({column}, '{pattern}', '{by}', 'g')"
    return column


_MEASURES = [(p, "") for p in (r"\b\d+\s*ml\b", r"\b\d+\s*mah\b", r"\b\d+\s*w\b", r"\b\d+\s*puffs?\b", r"\b\d+\s*mg\b", r"\b\d+\s*ohm\b", r"\(\d+\s*pcs\)", r"\(pack\s*\d+\)")]
_NAME = f"list_reduce(list_prepend({_nested('lower(name)', *_MEASURES)}, list_filter(coalesce(brand_candidates, []), lambda b: b is not null and b <> '')), lambda acc, b: regexp_replace(acc, '\\b' || regexp_escape(lower(b)) || '\\b', '', 'g'))"
_SIGNS = "[+&/\\\\()\\[\\]{}.;:!?''\"_,]"
_MATCHING = f"regexp_replace({_nested(_NAME, (r'\b(?:kit|pod|pods|mod|mods|coil|coils|replacement|empty|drip\s*tip|glass|case|starter|vape|resistencias?|dep[oó]sitos?|pyrex|boquillas?|algod[oó]n|accesorios?)\b', ''), (r'\b(?:para|con|de|del|las?|los?|una?|el|y)\b', ''), (_SIGNS, ' '), (r'\s*-\s*', ' '), (r'\s+', ' '))}, '^{BLANK}+|{BLANK}+$', '', 'g')"
_ENTRIES = "list_sort(list_transform(map_entries(variants), lambda e: {{'k': {}, 'v': {}}}))"
_SLUG = "list_last(string_split(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/$', ''), '/'))"


@query(
    f"""select row_id, {_MATCHING} as matching_name,
        trim(regexp_replace(regexp_replace(lower(brand), '\\b(?:e-?liquids?|nic\\s*salts?|salts?|vapes?|labs?|liquids?|flavou?rs?)\\b', '', 'g'), '\\s+', ' ', 'g')) as trade_brand,
        case when cardinality(variants) > 0 and ends_with(name, ' - ' || array_to_string(map_values(variants), ' / ')) then substr(name, 1, length(name) - 3 - length(array_to_string(map_values(variants), ' / '))) else name end as base_name,
        case when cardinality(variants) > 0 then trim(regexp_replace(regexp_replace(array_to_string(list_transform({_ENTRIES.format('trim(lower(e.key))', 'trim(lower(e.value))')}, lambda e: e.v), ' '), '(?i)\\b\\d+\\s*(?:ml|mah|w|ohm|mg|puffs?|pcs)\\b', '', 'g'), '\\s+', ' ', 'g')) else '' end as value_signature,
        case when cardinality(variants) > 0 then regexp_replace(regexp_replace(upper(array_to_string(list_transform({_ENTRIES.format('lower(e.key)', 'e.value')}, lambda e: e.v), '-')), '[^A-Z0-9]+', '-', 'g'), '^-|-$', '', 'g') else '' end as value_slug,
        trim(regexp_replace(regexp_replace(regexp_replace(coalesce(name, ''), '(?i)\\s+-\\s*\\d+(?:[.,]\\d+)?\\s*mg\\s*/\\s*\\d+(?:[.,]\\d+)?\\s*ml\\b', '', 'g'), '(?i)\\s+-\\s*\\d+(?:[.,]\\d+)?\\s*mg\\b', '', 'g'), '\\s{{2,}}', ' ', 'g')) as neutral_title,
        {Q.american('category')} as american, {Q._keyed('category')} as value_key from product where name is not null"""
)
def q_capture_names(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    return table(spark, d, "product").where("name is not null").select(
        "row_id", scraped.matching_name(c("name"), c("brand_candidates")).alias("matching_name"), scraped.trade_brand(c("brand")).alias("trade_brand"), scraped.base_name(c("name"), c("variants")).alias("base_name"),
        scraped.value_signature(c("variants")).alias("value_signature"), scraped.value_slug(c("variants")).alias("value_slug"), scraped.neutral_title(c("name")).alias("neutral_title"),
        V.american(c("category")).alias("american"), V.value_key(c("category")).alias("value_key"),
    )


_BODY = _nested("trim(regexp_replace(name, '(?i)' || regexp_escape(b), ''))", (r"(?i)\b(?:kit|pod kit|starter kit|mod)\b", ""))
_BODY2 = _nested(
    f"case when kit then {_nested(_BODY, (r'(?i)\btank\b', ''))} else {_BODY} end",
    *[(p, "") for p in (r"(?i)\b(?:replacement|refill|empty|disposable|desechable)\b", r"(?i)\b(?:coil|coils|mesh coil)\b", r"(?i)\b(?:battery|bateria|batería)\b", r"(?i)\bpod\b", r"(?i)\b\d+\s*ml\b", r"(?i)\b\d+\s*mah\b", r"(?i)\b\d+\s*w\b", r"(?i)\b\d+\s*ohm\b", r"(?i)\b\d+\s*puffs?\b")],
)
_UNPACKED = _nested("body", (r"(?i)\(?pack\s*\d+\)?", ""))
_DOTTED = ("regexp_replace(upper(regexp_replace({}, '^" + BLANK.replace("{", "{{").replace("}", "}}") + "+|" + BLANK.replace("{", "{{").replace("}", "}}") + "+$', '', 'g')), '\\s+', '.', 'g')").format(
    _nested(f"case when kit then {_nested(_UNPACKED, (r'\s*\+\s*.+$', ''))} else {_UNPACKED} end", ("[-_]", " "), (r"[()\[\]{}]", ""), ("[+&/\\\;:!?''\",.]", " "), (r"\s+", " "))
)
_STATED = "case category_id when 'resist' then 'COILS' when 'coils' then 'COILS' when 'desechables' then 'DESECHABLE' when 'kits' then 'MODS Y KITS' when 'cartuchos' then 'ACCESORIOS' else 'POD SYSTEMS' end"


@query(
    f"""with s as (select *, coalesce(trim(commercial_brand), trim(brand), '') as b, {_STATED} as stated from product where name is not null), t as (select *, stated in ('MODS Y KITS', 'POD SYSTEMS') as kit from s),
        u as (select *, {_BODY2} as body from t), v as (select *, regexp_replace({_DOTTED} || case when regexp_matches(body, '(?i)\\(?pack\\s*(\\d+)\\)?') then '.P' || regexp_extract(body, '(?i)\\(?pack\\s*(\\d+)\\)?', 1) else '' end, '^\\.+|\\.+$', '', 'g') as whole from u)
        select row_id, case when whole <> '' and b <> '' and name <> '' then case stated when 'COILS' then 'R' when 'DESECHABLE' then 'D' when 'ACCESORIOS' then case when regexp_matches(name, '(?i)\\b(?:tank|pod\\s+replacement|atomiz|rda|rta|rdta|cartridge|clearomiz|depósito)\\b') then 'C' else 'A' end else 'K' end || '-' || whole end as synthetic,
               nullif(regexp_extract(reference, '^[A-Z]{{1,2}}-(.+)$', 1), '') as body, coalesce(regexp_matches(reference, '^[KMCRBADW]-'), false) as hardware from v"""
)
def q_synthetic_reference(spark: SparkSession, d: str) -> DataFrame:
    stated = (
        F.when(F.col("category_id").isin("resist", "coils"), "COILS").when(F.col("category_id") == "desechables", "DESECHABLE").when(F.col("category_id") == "kits", "MODS Y KITS").when(F.col("category_id") == "cartuchos", "ACCESORIOS").otherwise("POD SYSTEMS")
    )
    brand = F.coalesce(F.trim("commercial_brand"), F.trim("brand"), F.lit(""))
    return table(spark, d, "product").where("name is not null").select(
        "row_id", scraped.synthetic_reference(F.col("name"), brand, stated).alias("synthetic"), F.nullif(F.regexp_extract("reference", r"^[A-Z]{1,2}-(.+)$", 1), F.lit("")).alias("body"),
        F.coalesce(F.col("reference").rlike("^[KMCRBADW]-"), F.lit(False)).alias("hardware"),
    )


_PLAIN_WORD = "regexp_replace(lower(w), '[^a-záéíóúñ]', '', 'g')"
_NO_BRAND = ", ".join(f"'{w}'" for w in (
    "vaper vapers desechable desechables pack sabores bote sales de del la el los las un una y e o en con por para al ml nic top individual envase bolsa flores aceite aroma base nicokit cajetilla sobre sobres recargable pod pods"
).split())


@query(
    f"""select row_id, array_to_string(list_transform(list_filter(string_split({_SLUG}, '-'), lambda w: w <> ''), lambda w: upper(w[1]) || w[2:]), ' ') as name_of_url,
        list_filter(regexp_split_to_array(name, '\\s+'), lambda w: length({_PLAIN_WORD}) > 2 and {_PLAIN_WORD} not in ({_NO_BRAND}) and regexp_matches(w, '^[A-ZÁÉÍÓÚÑ]'))[1] as brand_of_name,
        nullif(regexp_extract(url, '[-/](\\d{{13}})(?:\\.html)?(?:[?#].*)?$', 1), '') as ean_of_url,
        case when len(list_filter(map_keys(variants), lambda k: k <> '')) > 0 then split_part(url, '#', 1) || '#/' || array_to_string(list_filter(list_transform(map_entries(variants), lambda e: lower(e.key) || '-' || lower(e.value)), lambda s: s is not null), '/') else url end as variant_url,
        nullif(trim(regexp_replace(trim(brand), '(?i)^(?:(?:grossiste|e-liquides?|marque|marca|fabricante)\\b[\\s:]*)+', '')), '') as own_brand,
        case when starts_with(reference, left(reference, 2) || '-') and trim(substr(reference, 4)) <> '' then upper(trim(regexp_replace(regexp_replace(trim(substr(reference, 4)), '[._-]+', ' ', 'g'), '\\s+', ' ', 'g'))) end as suffix
        from product"""
)
def q_capture_urls(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    segments = F.transform(F.map_entries("variants"), lambda e: F.concat(F.lower(e["key"]), F.lit("-"), F.lower(e["value"])))
    return table(spark, d, "product").select(
        "row_id", scraped.title_of_slug(scraped.slug_of_url(c("url"))).alias("name_of_url"), scraped.brand_of_url_or_name(c("url"), c("name")).alias("brand_of_name"), scraped.ean_of_url(c("url")).alias("ean_of_url"),
        F.coalesce(scraped.variant_url(c("url"), segments), c("url")).alias("variant_url"), scraped.stripped_prefixes(c("brand")).alias("own_brand"), scraped.reference_suffix(c("reference"), F.substring("reference", 1, 2)).alias("suffix"),
    )


# --- master ------------------------------------------------------------------------------------
_STOP = ", ".join(f"'{w}'" for w in "a and aroma bote botella capacidad coil con de del e el en edition for la las los ml mg nic nicotine ohm pack para pcs pod replacement resistencia salt salts the unidades uds y".split())


def _ids(c: str) -> str:
    return f"list_distinct(list_filter(regexp_split_to_array({sql_plain(f'coalesce({c}, {chr(39) * 2})')}, '[^a-z0-9]+'), lambda w: length(w) > 1 and w not in ({_STOP})))"


def _identity(url: str, title: str) -> str:
    return f"case when len({_ids(title)}) > 0 then len(list_intersect({_ids(title)}, {_ids(f'split_part({url}, {chr(39)}#{chr(39)}, 1)')}))::double / len({_ids(title)}) else 0.0 end"


_ROUND = "s{i} as (select *, min(rk) over (partition by a_variant_id) as x, min(rk) over (partition by b_variant_id) as y from l{i}), w{i} as (select a_variant_id, b_variant_id, rk from s{i} where rk = x and rk = y), l{j} as (select a_variant_id, b_variant_id, rk from l{i} where a_variant_id not in (select a_variant_id from w{i}) and b_variant_id not in (select b_variant_id from w{i}))"
_GUARD = f"""
    e0 as (select *, a_variant_id || '|||' || b_variant_id as pair_key from variant_match where a_variant_id is not null and b_variant_id is not null qualify row_number() over (partition by a_variant_id, b_variant_id order by match_id) = 1),
    e1 as (select match_id, a_variant_id, b_variant_id, pair_key, cast(variant_decision = 'match' as int) as reviewed, cast(coalesce(variant_confidence >= 0.95, false) as int) as valid, coalesce(variant_confidence, 0) as confidence, round({_identity('a_url', 'b_title')} + {_identity('b_url', 'a_title')}, 6) as identity from e0),
    e as (select *, row_number() over (order by reviewed desc, valid desc, confidence desc, identity desc, pair_key) as rk from e1), l0 as (select a_variant_id, b_variant_id, rk from e),
    {', '.join(_ROUND.format(i=i, j=i + 1) for i in range(10))},
    won as ({' union all '.join(f'select * from w{i}' for i in range(10))}),
    g as (select e.*, won.rk is not null as accepted, coalesce(x.rk < e.rk, false) as on_a, coalesce(y.rk < e.rk, false) as on_b from e left join won on won.rk = e.rk left join won x on x.a_variant_id = e.a_variant_id left join won y on y.b_variant_id = e.b_variant_id),
    guard as (select match_id, pair_key, reviewed, valid, identity, accepted, case when accepted then null when on_a and on_b then 'both' when on_a then 'a' when on_b then 'b' end as conflict_side from g)"""


def _guarded(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "variant_match").where("a_variant_id is not null and b_variant_id is not null")
    cols = ["match_id", "variant_decision", "variant_confidence", "a_url", "a_title", "b_url", "b_title"]
    first = m.groupBy("a_variant_id", "b_variant_id").agg(F.min(F.struct(*cols)).alias("m")).select("a_variant_id", "b_variant_id", "m.*")
    identity = loading.url_title_identity(F.col("a_url"), F.col("b_title")) + loading.url_title_identity(F.col("b_url"), F.col("a_title"))
    edges = first.select(
        "match_id", "a_variant_id", "b_variant_id", F.concat_ws("|||", "a_variant_id", "b_variant_id").alias("pair_key"), (F.col("variant_decision") == "match").cast("int").alias("reviewed"),
        F.coalesce(F.col("variant_confidence") >= 0.95, F.lit(False)).cast("int").alias("valid"), F.coalesce("variant_confidence", F.lit(0.0)).alias("confidence"), F.round(identity, 6).alias("identity"),
    )
    return loading.master_guard(edges, "a_variant_id", "b_variant_id", ["reviewed", "valid", "confidence", "identity"], "pair_key")


@query(f"with {_GUARD} select * from guard")
def q_master_guard(spark: SparkSession, d: str) -> DataFrame:
    return _guarded(spark, d).select("match_id", "pair_key", "reviewed", "valid", "identity", "accepted", "conflict_side")


_RESOLVE = f"""
    rows_ as (select row_id, distributor || ':' || row_id as vid, split_part(url, '#', 1) as base, regexp_replace({sql_plain('name')}, '[^a-z0-9]+', '', 'g') as title from product where url is not null),
    info as (select match_id, a_variant_id, split_part(a_url, '#', 1) as base, regexp_replace({sql_plain('a_title')}, '[^a-z0-9]+', '', 'g') as title from variant_match),
    t1 as (select vid, min(row_id) as r from rows_ group by 1), t2 as (select base, min(row_id) as r, count(*) as n from rows_ group by 1), t3 as (select base, title, min(row_id) as r from rows_ where title <> '' group by 1, 2 having count(*) = 1)"""


@query(
    f"with {_RESOLVE} select match_id, case when t1.r is not null then 'exact_variant_id' when t2.n = 1 then 'single_url_in_base' when t3.r is not null then 'single_title_in_base' else 'synthetic_output_variant' end as resolution, "
    "coalesce(t1.r, case when t2.n = 1 then t2.r end, t3.r) as row_id from info left join t1 on t1.vid = a_variant_id left join t2 on t2.base = info.base left join t3 on t3.base = info.base and t3.title = info.title"
)
def q_variant_resolution(spark: SparkSession, d: str) -> DataFrame:
    """Prepared variant of side A of every pair: by id, the only one of its address, the only one with its title there, else synthetic."""
    rows = table(spark, d, "product").where("url is not null").select("row_id", F.concat_ws(":", "distributor", F.col("row_id").cast("string")).alias("vid"), F.substring_index("url", "#", 1).alias("base"), T.compact(F.col("name")).alias("title"))
    info = table(spark, d, "variant_match").select("match_id", F.col("a_variant_id").alias("vid"), F.substring_index("a_url", "#", 1).alias("base"), T.compact(F.col("a_title")).alias("title"))
    t1 = rows.groupBy("vid").agg(F.min("row_id").alias("r1"))
    t2 = rows.groupBy("base").agg(F.min("row_id").alias("r2"), F.count(F.lit(1)).alias("n")).where("n = 1").drop("n")
    t3 = rows.where("title <> ''").groupBy("base", "title").agg(F.min("row_id").alias("r3"), F.count(F.lit(1)).alias("n")).where("n = 1").drop("n")
    out = info.join(t1, "vid", "left").join(t2, "base", "left").join(t3, ["base", "title"], "left")
    kind = F.when(F.col("r1").isNotNull(), "exact_variant_id").when(F.col("r2").isNotNull(), "single_url_in_base").when(F.col("r3").isNotNull(), "single_title_in_base").otherwise("synthetic_output_variant")
    return out.select("match_id", kind.alias("resolution"), F.coalesce("r1", "r2", "r3").alias("row_id"))


# --- loader ------------------------------------------------------------------------------------
_PREPARED = f"with {Q.OWN}, {Q.PROFILE}, {Q.REPS}, {Q.VARIANTS}"
_FLOAT = "try_cast(nullif(regexp_extract(replace(lower({}), ',', '.'), '(\\d+(?:\\.\\d+)?)', 1), '') as double)"
_TRIMMED = "nullif(regexp_replace({0}, '^{1}+|{1}+$', '', 'g'), '')"


def _cut(c: str, n: int) -> str:
    return f"substr({_TRIMMED.format(c, BLANK)}, 1, {n})"


@query(
    f"""{_PREPARED}, r0 as (select * from vr qualify row_number() over (partition by id order by row_id) = 1),
        r1 as (select *, coalesce({_TRIMMED.format('sku', BLANK)}, {_TRIMMED.format('reference', BLANK)}, id) as want, case when regexp_matches(reference, '^\\d{{13}}$') then reference end as ean from r0),
        r2 as (select *, count(*) over (partition by want) as n, count(*) over (partition by ean) as en from r1)
        select id as source_key, {_cut('base_ratio', 40)} as base_ratio, {_FLOAT.format('bote_ml')} as bottle_ml, {_cut('cafeina', 80)} as caffeine, coalesce(nullif({_FLOAT.format('capacidad')}, 0), nullif({_FLOAT.format('contenido_ml')}, 0), {_FLOAT.format('bote_ml')}) as quantity_ml,
               {_cut("coalesce(nullif(reference_color, ''), nullif(derived_reference_color, ''), color)", 80)} as color, {_FLOAT.format('contenido_ml')} as content_ml, case when en = 1 then ean end as ean13, {_cut('brand', 120)} as brand, {_FLOAT.format('nicotina')} as nicotine_level,
               coalesce({_cut('title', 160)}, {_cut('base_title', 160)}, {_cut('id', 160)}) as name, {_cut('resistencia', 80)} as resistance, {_cut('pod_type', 40)} as pod_type, {_cut('product_type', 80)} as product_type, {_cut('sabor', 160)} as flavor,
               coalesce({', '.join(_cut(c, 120) for c in ('tamano', 'variant_label', 'variant_signature', 'capacidad', 'contenido_ml', 'bote_ml', 'resistencia', 'color'))}, 'unidad') as size,
               case when n = 1 and length(want) <= 120 then want else substr(want, 1, 107) || '-' || substr(sha256(id), 1, 12) end as sku from r2"""
)
def q_reference_rows(spark: SparkSession, d: str) -> DataFrame:
    """The rows of the reference table: cut texts, numbers, size, unique SKU and EAN."""
    v = products.variant_rows(table(spark, d, "product"))
    one = v.groupBy("id").agg(F.min_by(F.struct(*[c for c in v.columns if c != "id"]), "row_id").alias("v")).select("id", "v.*")
    c, cut, num = F.col, loading.cut, loading.number_in
    skus = loading.unique_skus(one, "id", F.coalesce(cut(c("sku"), 10_000), cut(c("reference"), 10_000)))
    eans = one.where(c("reference").rlike(r"^\d{13}$")).groupBy("reference").agg(F.count(F.lit(1)).alias("en")).where("en = 1").select(c("reference").alias("ean13"), c("reference"))
    positive = lambda x: F.when(x != 0, x)
    sizes = ("tamano", "variant_label", "variant_signature", "capacidad", "contenido_ml", "bote_ml", "resistencia", "color")
    return one.drop("sku").join(skus, "id").join(eans, "reference", "left").select(
        c("id").alias("source_key"), cut(c("base_ratio"), 40).alias("base_ratio"), num(c("bote_ml")).alias("bottle_ml"), cut(c("cafeina"), 80).alias("caffeine"), F.coalesce(positive(num(c("capacidad"))), positive(num(c("contenido_ml"))), num(c("bote_ml"))).alias("quantity_ml"),
        cut(F.coalesce(products.some(c("reference_color")), products.some(c("derived_reference_color")), c("color")), 80).alias("color"), num(c("contenido_ml")).alias("content_ml"), "ean13", cut(c("brand"), 120).alias("brand"), num(c("nicotina")).alias("nicotine_level"),
        F.coalesce(cut(c("title"), 160), cut(c("base_title"), 160), cut(c("id"), 160)).alias("name"), cut(c("resistencia"), 80).alias("resistance"), cut(c("pod_type"), 40).alias("pod_type"), cut(c("product_type"), 80).alias("product_type"), cut(c("sabor"), 160).alias("flavor"),
        F.coalesce(*[cut(c(k), 120) for k in sizes], F.lit("unidad")).alias("size"), "sku",
    )


_LINKS = f"{_PREPARED}, dist as (select distributor, row_number() over (order by distributor) as distributor_id from (select distinct distributor from vr where distributor is not null)), lk as (select row_id, base_id, distributor, substr(url, 1, 2048) as url, substr(base_url, 1, 2048) as base_url, coalesce({_cut('variant_label', 255)}, {_cut('variant_signature', 255)}, {_cut('reference', 255)}, 'unidad') as variant, {_cut('title', 255)} as name from vr)"


@query(f"{_LINKS} select row_id, distributor_id, url, base_url, variant, name, count(*) over (partition by distributor, url, variant) > 1 as ambiguous from lk left join dist using (distributor)")
def q_link_rows(spark: SparkSession, d: str) -> DataFrame:
    """The rows of the link table; those that share distributor, address and variant are ambiguous and not loaded."""
    links = _links(spark, d)
    same = links.groupBy("distributor", "url", "variant").agg(F.count(F.lit(1)).alias("n"))
    on = F.expr("a.distributor <=> b.distributor and a.url <=> b.url and a.variant <=> b.variant")
    ids = catalog.numbered_names(links, "distributor", "distributor_id")
    return links.alias("a").join(same.alias("b"), on).select("a.*", (F.col("b.n") > 1).alias("ambiguous")).join(ids, "distributor", "left").select("row_id", "distributor_id", "url", "base_url", "variant", "name", "ambiguous")


def _links(spark: SparkSession, d: str) -> DataFrame:
    v = products.variant_rows(table(spark, d, "product"))
    cut, c = loading.cut, F.col
    variant = F.coalesce(cut(c("variant_label"), 255), cut(c("variant_signature"), 255), cut(c("reference"), 255), F.lit("unidad"))
    return v.select("row_id", "base_id", "distributor", F.substring("url", 1, 2048).alias("url"), F.substring("base_url", 1, 2048).alias("base_url"), variant.alias("variant"), cut(c("title"), 255).alias("name"), "title")


_MERGE = f"""{_LINKS}, re as (select base_id, min(row_id) as reference_id, min_by(regexp_replace({sql_plain('name')}, '[^a-z0-9]+', '', 'g'), row_id) as grp from lk group by 1),
    dep as (select reference_id, count(*) as d from variant_match m join lk on lk.row_id = try_cast(regexp_extract(a_variant_id, '(\\d+)$', 1) as bigint) join re using (base_id) group by 1),
    gr as (select grp, count(*) as members, count(*) filter (d > 0) as referenced, min(reference_id) filter (d > 0) as rr, min(reference_id) as mm from re left join dep using (reference_id) where grp is not null group by 1 having count(*) > 1),
    sl as (select grp, distributor, variant, count(*) as n, count(distinct lk.base_url) as urls from lk join re using (base_id) join gr using (grp) group by 1, 2, 3),
    ss as (select grp, sum(n) as links, count(*) filter (n > 1) as collisions, count(*) filter (n > 1 and urls > 1) as differing, sum(n - 1) as redundant from sl group by 1),
    fin as (select *, case when referenced > 1 then 'multiple_references_have_business_dependencies' when collisions > 0 and ({{}} or differing > 0) then 'distributor_variant_collision' end as reason from gr join ss using (grp))
    select grp as "group", members, referenced, case when reason is null then case when referenced = 1 then rr else mm end end as survivor, reason is null as merged, reason, cast(links as bigint) as links, cast(case when reason is null then redundant else 0 end as bigint) as deleted from fin"""


def _merges(spark: SparkSession, d: str, dedupe: bool) -> DataFrame:
    links = _links(spark, d)
    first = links.groupBy("base_id").agg(F.min("row_id").alias("reference_id"), F.min_by(T.compact(F.col("name")), "row_id").alias("group"))
    of_base = links.join(first, "base_id")
    row = F.regexp_extract("a_variant_id", r"(\d+)$", 1).try_cast("bigint")
    deps = table(spark, d, "variant_match").select(row.alias("row_id")).join(of_base.select("row_id", "reference_id"), "row_id").select("reference_id")
    return loading.safe_merges(
        first.where(F.col("group").isNotNull()).select("group", "reference_id"), of_base.select(F.col("row_id").alias("link_id"), "reference_id", "distributor", "variant", F.col("base_url").alias("url")), deps, dedupe
    )


@query(_MERGE.replace("({} or", "(true or"))
def q_safe_merge(spark: SparkSession, d: str) -> DataFrame:
    """Bases of one title merged into one reference where nothing forbids it."""
    return _merges(spark, d, dedupe=False)


@query(_MERGE.replace("({} or", "(false or"))
def q_safe_merge_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """As q_safe_merge, where links equal but for the id may be deleted."""
    return _merges(spark, d, dedupe=True)


# --- reports -----------------------------------------------------------------------------------
_FINDINGS = f"""with {_GUARD}, fi as (
    select 'model_rejected_match' as type, 'ledger' as source, 'match:' || match_id as id, coalesce(reason, '') as reason, true as review from variant_match where variant_decision = 'no_match'
    union all select 'master_cardinality_rejected', 'master', 'match:' || match_id, coalesce(conflict_side, ''), true from guard where not accepted
    union all select 'ambiguous_links', 'loader', a_variant_id || '|' || b_variant_id, cast(count(*) as varchar), false from variant_match where a_variant_id is not null and b_variant_id is not null group by a_variant_id, b_variant_id having count(*) > 1
    union all select 'pair_disagreement', 'evaluation', 'pair:' || pair_id, string_agg(distinct verdict, '/' order by verdict), true from pair_spec where verdict is not null group by pair_id having count(distinct verdict) > 1)"""


def _findings(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "variant_match")
    shape = lambda df, kind, source, i, reason, review: df.select(F.lit(kind).alias("type"), F.lit(source).alias("source"), i.alias("id"), F.coalesce(reason, F.lit("")).alias("reason"), F.lit(review).alias("review"))
    numbered = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    double = catalog.ambiguous(m.where("a_variant_id is not null and b_variant_id is not null"), ["a_variant_id", "b_variant_id"])
    torn = table(spark, d, "pair_spec").where("verdict is not null").groupBy("pair_id").agg(F.array_sort(F.collect_set("verdict")).alias("v")).where(F.size("v") > 1)
    return (
        shape(m.where("variant_decision = 'no_match'"), "model_rejected_match", "ledger", numbered("match:", "match_id"), F.col("reason"), True)
        .unionByName(shape(_guarded(spark, d).where("not accepted"), "master_cardinality_rejected", "master", numbered("match:", "match_id"), F.col("conflict_side"), True))
        .unionByName(shape(double, "ambiguous_links", "loader", F.concat_ws("|", "a_variant_id", "b_variant_id"), F.col("rows").cast("string"), False))
        .unionByName(shape(torn, "pair_disagreement", "evaluation", numbered("pair:", "pair_id"), F.array_join("v", "/"), True))
    )


@query(f"{_FINDINGS} select type, source, id, reason, review from fi")
def q_findings(spark: SparkSession, d: str) -> DataFrame:
    return _findings(spark, d)


@query(f"{_FINDINGS} select type, count(*) as findings, count(*) filter (review) as requires_review, min(id) as first_id from fi group by 1")
def q_findings_by_type(spark: SparkSession, d: str) -> DataFrame:
    return _findings(spark, d).groupBy("type").agg(F.count(F.lit(1)).alias("findings"), F.count_if("review").alias("requires_review"), F.min("id").alias("first_id"))


def _batch_sql(where: str, name: str) -> str:
    return f"""{name}0 as (select *, cast(floor((row_number() over (partition by base_match_a_id order by match_id) - 1) / 20) as bigint) as batch from variant_match where base_match_a_id is not null and {where}),
        {name} as (select base_match_a_id, batch, count(*) as rows, sha256('model=m1;effort=high' || chr(10) || string_agg(concat_ws('|', cast(match_id as varchar), coalesce(a_title, ''), coalesce(b_title, ''), coalesce(a_variant, ''), coalesce(b_variant, '')), chr(10) order by match_id)) as key from {name}0 group by 1, 2)"""


@query(
    f"with {_batch_sql('true', 'w')}, {_batch_sql('variant_confidence is not null', 's')} select w.*, case when s.key is null then 'run' when s.key = w.key then 'reuse' else 'rerun' end as action from w left join s using (base_match_a_id, batch)"
)
def q_checkpoint_plan(spark: SparkSession, d: str) -> DataFrame:
    """Review batches per base and which of them an earlier run (rows that have a confidence) already answered."""
    m = table(spark, d, "variant_match").where("base_match_a_id is not null")
    make = lambda df: loading.batches(df, "base_match_a_id", "match_id", ["a_title", "b_title", "a_variant", "b_variant"], 20, "model=m1;effort=high")
    return loading.checkpoint_plan(make(m), make(m.where("variant_confidence is not null")), ["base_match_a_id", "batch"])


_LATEST = "select pair_id, arg_max(verdict, {'t': reviewed_at, 'v': verdict}) as verdict from pair_spec where verdict is not null and reviewed_at is not null group by 1"


@query(
    f"with t as ({_LATEST}), p as (select match_id as pair_id, case when variant_decision = 'match' then 'SAME' else 'DIFFERENT' end as verdict from variant_match) "
    "select coalesce(t.verdict, 'none') as verdict, count(*) as pairs, count(*) filter (t.verdict = p.verdict) as passed, count(*) filter (t.verdict <> p.verdict) as failed, count(*) filter (t.verdict is not null and p.verdict is null) as missing, count(*) filter (t.verdict is null) as unexpected "
    "from t full join p using (pair_id) group by 1"
)
def q_eval_accuracy(spark: SparkSession, d: str) -> DataFrame:
    """Last verdict of every pair against the decision of the match of that number."""
    s = table(spark, d, "pair_spec").where("verdict is not null and reviewed_at is not null")
    truth = s.groupBy("pair_id").agg(F.max(F.struct("reviewed_at", "verdict")).getField("verdict").alias("verdict"))
    predicted = table(spark, d, "variant_match").select(F.col("match_id").alias("pair_id"), F.when(F.col("variant_decision") == "match", "SAME").otherwise("DIFFERENT").alias("verdict"))
    return loading.review_report(truth, predicted, "pair_id")


@query(
    "with n as (select s.pair_id, count(p.row_id) as rows, min(p.row_id) as row_id from (select distinct pair_id, b_url from pair_spec) s left join product p on p.url = s.b_url group by 1) "
    "select pair_id, rows, case when rows = 1 then row_id end as row_id, case when rows = 0 then 'missing' when rows = 1 then 'selected' else 'ambiguous' end as outcome from n"
)
def q_eval_rows(spark: SparkSession, d: str) -> DataFrame:
    """The captured row of every pair's side B, which must be exactly one."""
    s = table(spark, d, "pair_spec").select("pair_id", F.col("b_url").alias("url")).distinct()
    n = s.join(table(spark, d, "product").select("url", "row_id"), "url", "left").groupBy("pair_id").agg(F.count("row_id").alias("rows"), F.min("row_id").alias("r"))
    return n.select("pair_id", "rows", F.when(F.col("rows") == 1, F.col("r")).alias("row_id"), F.when(F.col("rows") == 0, "missing").when(F.col("rows") == 1, "selected").otherwise("ambiguous").alias("outcome"))


# --- first matcher -----------------------------------------------------------------------------
_SIGNATURE = f"case when cardinality(variants) > 0 then trim(regexp_replace(regexp_replace(array_to_string(list_transform({_ENTRIES.format('trim(lower(e.key))', 'trim(lower(e.value))').replace('{{', '{').replace('}}', '}')}, lambda e: e.v), ' '), '(?i)\\b\\d+\\s*(?:ml|mah|w|ohm|mg|puffs?|pcs)\\b', '', 'g'), '\\s+', ' ', 'g')) else '' end"
_URL_PAIRS = """
    up as (select distinct a.url as a_url, b.url as b_url from variant_match m join product a on a.row_id = try_cast(regexp_extract(a_variant_id, '(\\d+)$', 1) as bigint) join product b on b.row_id = try_cast(regexp_extract(b_variant_id, '(\\d+)$', 1) as bigint)
           where a.url is not null and b.url is not null and a.url <> b.url)"""
_GREEDY = "y{i} as (select *, min(rk) over (partition by a_url, b_url, a_sig) as x, min(rk) over (partition by a_url, b_url, b_sig) as y from k{i}), z{i} as (select a_url, b_url, a_sig, b_sig, similarity, rk from y{i} where rk = x and rk = y), k{j} as (select k.a_url, k.b_url, k.a_sig, k.b_sig, k.similarity, k.rk from k{i} k where not exists (select 1 from z{i} z where z.a_url = k.a_url and z.b_url = k.b_url and (z.a_sig = k.a_sig or z.b_sig = k.b_sig)))"


@query(
    f"""with {_URL_PAIRS}, sg as (select distinct url, {_SIGNATURE} as sig from product where url is not null),
        mt as (select a_url, b_url, a.sig as a_sig, b.sig as b_sig, list_distinct(list_filter(regexp_split_to_array(a.sig, '\\s+'), lambda w: w <> '')) as wa, list_distinct(list_filter(regexp_split_to_array(b.sig, '\\s+'), lambda w: w <> '')) as wb from up join sg a on a.url = a_url join sg b on b.url = b_url),
        sc as (select *, round(case when a_sig = b_sig then 1.0 when a_sig = '' or b_sig = '' or len(list_intersect(wa, wb)) = 0 then 0.0 else greatest(len(list_intersect(wa, wb))::double / len(list_distinct(wa || wb)), 0.85 * len(list_intersect(wa, wb)) / least(len(wa), len(wb))) end::double, 6) as similarity from mt),
        k0 as (select a_url, b_url, a_sig, b_sig, similarity, row_number() over (order by similarity desc, a_url, b_url, a_sig, b_sig) as rk from sc where similarity >= 0.6), {', '.join(_GREEDY.format(i=i, j=i + 1) for i in range(8))}
        select a_url, b_url, a_sig, b_sig, similarity from ({' union all '.join(f'select * from z{i}' for i in range(8))})"""
)
def q_variant_pairs(spark: SparkSession, d: str) -> DataFrame:
    """One-to-one variants inside every matched pair of addresses: signatures at least .6 alike, greedy from the best."""
    p = table(spark, d, "product").where("url is not null")
    row = lambda c: F.regexp_extract(c, r"(\d+)$", 1).try_cast("bigint")
    m = table(spark, d, "variant_match").select(row("a_variant_id").alias("a_row"), row("b_variant_id").alias("b_row"))
    at = lambda n: p.select(F.col("row_id").alias(f"{n}_row"), F.col("url").alias(f"{n}_url"))
    pairs = m.join(at("a"), "a_row").join(at("b"), "b_row").where("a_url <> b_url").select("a_url", "b_url").distinct()
    sig = p.select("url", scraped.value_signature(F.col("variants")).alias("sig")).distinct()
    side = lambda n: sig.select(F.col("url").alias(f"{n}_url"), F.col("sig").alias(f"{n}_sig"))
    scored = pairs.join(side("a"), "a_url").join(side("b"), "b_url").withColumn("similarity", F.round(scraped.word_overlap(F.col("a_sig"), F.col("b_sig")), 6)).where("similarity >= 0.6")
    # an end is a signature within its pair of addresses
    ends = scored.withColumns({f"{n}_end": F.to_json(F.struct("a_url", "b_url", f"{n}_sig")) for n in "ab"})
    order = [("similarity", True), ("a_url", False), ("b_url", False), ("a_sig", False), ("b_sig", False)]
    return assign.greedy_one_to_one(ends, "a_end", "b_end", order).select("a_url", "b_url", "a_sig", "b_sig", "similarity")


_TRADE = "trim(regexp_replace(regexp_replace(lower({}), '\\b(?:e-?liquids?|nic\\s*salts?|salts?|vapes?|labs?|liquids?|flavou?rs?)\\b', '', 'g'), '\\s+', ' ', 'g'))"


@query(
    f"with r as (select distinct {_TRADE.format('brand_name')} as ref from brand_ref where brand_name is not null), b as (select {_TRADE.format('brand')} as brand, count(*) as rows from product where brand is not null group by 1) "
    "select brand, ref, rows from b join r on brand = ref or (length(brand) > 2 and contains(ref, brand)) or (length(ref) > 2 and contains(brand, ref))"
)
def q_brand_blocking(spark: SparkSession, d: str) -> DataFrame:
    """Brand texts and listed brands of which one holds the other; the list is counted before it is sent."""
    refs = bounded(table(spark, d, "brand_ref").where("brand_name is not null").select(scraped.trade_brand(F.col("brand_name")).alias("ref")).distinct(), 100_000, "brands")
    brands = table(spark, d, "product").where("brand is not null").groupBy(scraped.trade_brand(F.col("brand")).alias("brand")).agg(F.count(F.lit(1)).alias("rows"))
    b, r = F.col("brand"), F.col("ref")
    return brands.join(refs, (b == r) | ((F.length(b) > 2) & r.contains(b)) | ((F.length(r) > 2) & b.contains(r))).select("brand", "ref", "rows")


@query(
    "with x as (select row_id, distributor, nullif(regexp_extract(reference, '^[A-Z]{1,2}-(.+)$', 1), '') as body from product), b as (select body, max(row_id) as b_id from x where body is not null and distributor in ('vahoria', 'nubarolia') group by 1) "
    "select row_id as a_id, b_id, body from x join b using (body) where distributor in ('brumacat', 'calimadis', 'humedra')"
)
def q_reference_prepass(spark: SparkSession, d: str) -> DataFrame:
    """Side A rows whose reference has the body of a side B row; the last B row of a body counts."""
    x = table(spark, d, "product").select("row_id", "distributor", F.nullif(F.regexp_extract("reference", r"^[A-Z]{1,2}-(.+)$", 1), F.lit("")).alias("body")).where("body is not null")
    b = x.where(F.col("distributor").isin("vahoria", "nubarolia")).groupBy("body").agg(F.max("row_id").alias("b_id"))
    return x.where(F.col("distributor").isin("brumacat", "calimadis", "humedra")).join(b, "body").select(F.col("row_id").alias("a_id"), "b_id", "body")


# --- rescue ------------------------------------------------------------------------------------
_RESCUE_STOP = ", ".join(f"'{w}'" for w in (
    "a al and aroma aromas base bote botella by capacidad caracteristicas cartucho con de del descripcion distribuidor edition el en es este formato html http https la las liquido liquidos los marca marcas meta ml para "
    "pod producto que referencia scrapeada sin sweet the ultimate un una vapeo vaperalia eciglogistica venta y").split())  # fmt: skip
_RESCUE_NAMES = ", ".join(f"'{w}'" for w in (
    "additif bar classic classique concentrado concentrados creations dessert desserts francia fresh fruit fruits fruitfull gama green les liquid longfill nicotine nicotina premium salt salts sales series sweets valores "
    "variante variantes version").split())  # fmt: skip


def _words_sql(c: str) -> str:
    return f"list_distinct(list_filter(regexp_split_to_array({sql_numbered(c)}, '[^a-z0-9]+'), lambda w: length(w) > 1 and w not in ({_RESCUE_STOP})))"


def _measure(c: str, unit: str) -> str:
    return f"list_distinct(list_transform(regexp_extract_all({c}, '(?i)(\\d+(?:[.,]\\d+)?)\\s*{unit}', 1), lambda x: cast(replace(x, ',', '.') as double)))"


def _hard(c: str) -> str:
    return f"list_filter({c}, lambda w: w in ('zero', 'primal', 'legend', 'legends', 'limited', 'v2', 'pro', 'mini', 'nano', 'max', 'plus', 'x'))"


def _either(*groups: str) -> str:
    held = ", ".join(f"'{g}'" for g in groups)
    return f"(a.grp in ({held}) or b.grp in ({held}))"


_N = "len(list_intersect(a.names, b.names))"
_EXTRA_A, _EXTRA_B = "len(list_filter(a.names, lambda w: not list_contains(b.names, w))) > 0", "len(list_filter(b.names, lambda w: not list_contains(a.names, w))) > 0"
_LIQUID, _HARDWARE = _either("liquidos"), _either("hardware_repuesto", "hardware_dispositivo")
_UNEQUAL = f"len(list_distinct({_hard('a.names')} || {_hard('b.names')})) > len(list_intersect({_hard('a.names')}, {_hard('b.names')}))"
_RESCUE = f"""
    f0 as (select *, coalesce(array_to_string(map_values(variants), ' '), '') as vals, array_to_string(brand_candidates, '|') as cands from product),
    f1 as (select *, concat_ws(' ', name, vals, reference, synthetic_reference) as named, concat_ws(' ', name, vals, reference, synthetic_reference, url) as prim, concat_ws(' ', brand, cands, commercial_brand) as bt,
                  {sql_numbered("concat_ws(' ', name, vals, reference, synthetic_reference, brand, cands, commercial_brand, array_to_string(breadcrumb_path, ' '), url)")} as whole, {sql_numbered("concat_ws(' ', name, reference, synthetic_reference, url)")} as mt, {sql_type()} as kind from f0),
    f2 as (select row_id, kind, {sql_group('kind')} as grp, whole, {sql_numbered('named')} as nn, {_words_sql('prim')} as title, {_words_sql("concat_ws(' ', name, description, meta_description, array_to_string(breadcrumb_path, ' '), vals, reference, synthetic_reference, url)")} as described, {_words_sql('bt')} as bw,
                  {_words_sql('named')} as nw, list_filter(list_transform(regexp_split_to_array(concat_ws('|', brand, cands, commercial_brand), '[|,]'), lambda x: {sql_compact('x')}), lambda k: k <> '') as brands,
                  {_measure('prim', 'ml')} as ml, {_measure('prim', '(?:ohm|Ω)')} as ohm, {_measure('prim', 'mg')} as mg,
                  list_filter(list_transform(list_filter(map_entries(variants), lambda e: {sql_fold('e.key')} in ('color', 'colour')), lambda e: {sql_compact('e.value')}), lambda c: c <> '')[1] as colour,
                  list_filter(list_distinct(list_transform(regexp_extract_all(mt, '\\b([a-z]{{2,}})\\s*-?\\s*(\\d+[a-z]?)\\b') || regexp_extract_all(mt, '\\b([a-z]{{1,3}})\\s*-?\\s*(mini|nano|max|pro|plus)\\b'), lambda x: regexp_replace(x, '[^a-z0-9]+', '', 'g'))), lambda x: x not in ('pack2', 'pack3', 'pack5', 'p2', 'p3', 'p5')) as models,
                  regexp_matches(whole, '\\bdrip\\s*tip\\b|\\bboquillas?\\b') as tip, regexp_matches(whole, '\\blong\\s*fill\\b|\\b\\d+\\s*ml\\s*/\\s*\\d+\\b|\\bbote\\s+de\\s+\\d+\\s*ml\\b') as longfill,
                  list_filter([case when regexp_matches({sql_numbered('prim')}, '\\bsweet\\b') then 'sweet' end, case when regexp_matches({sql_numbered('prim')}, '\\bgreen\\b') then 'green' end], lambda x: x is not null) as edition from f1),
    rf as (select *, list_distinct(list_filter(nw, lambda w: w not in ({_RESCUE_NAMES}) and not list_contains(bw, w) and not regexp_matches(w, '^\\d+(?:ml|mg|pcs?|ohm|w|mah)?$')) || case when regexp_matches(nn, '\\bx\\b') then ['x'] else [] end) as names from f2),
    rp as (select match_id, a_variant_id, b_variant_id, a, b, nullif(trim(base_match_a_id), '') is not null and nullif(trim(base_match_b_id), '') is not null as same_base, nullif(trim(base_match_a_id), '') is not null and nullif(trim(base_match_b_id), '') is null as split_base
           from variant_match m join rf a on a.row_id = try_cast(regexp_extract(a_variant_id, '(\\d+)$', 1) as bigint) join rf b on b.row_id = try_cast(regexp_extract(b_variant_id, '(\\d+)$', 1) as bigint)),
    ra as (select *, {Q._clash('a.ml', 'b.ml')} or {Q._clash('a.ohm', 'b.ohm')} or {Q._clash('a.mg', 'b.mg')} or coalesce(a.colour <> b.colour, false) or ({_HARDWARE} and {Q._clash('a.models', 'b.models')}) or ({_HARDWARE} and a.tip <> b.tip)
                  or ({_LIQUID} and {Q._clash(_hard('a.title'), _hard('b.title'))}) or ({_LIQUID} and a.longfill <> b.longfill)
                  or (not same_base and (({_LIQUID} and ({_UNEQUAL} or ({_N} <= 1 and {_EXTRA_A} and {_EXTRA_B}) or ({_N} = 1 and ({_EXTRA_A} or {_EXTRA_B})) or {Q._clash('a.edition', 'b.edition')})) or (({_LIQUID} or {_HARDWARE}) and {_N} = 0))) as conflict,
                  case when len(a.brands) > 0 and len(b.brands) > 0 then len(list_intersect(a.brands, b.brands)) > 0 end as same_brand, len(list_intersect(a.title, b.title)) as t, len(list_intersect(a.described, b.described)) as dd from rp),
    rs as (select *, case when split_base then 0.12::double else 0.0::double end + case when same_base then 0.2::double else 0.0::double end + case when a.kind = b.kind then 0.14::double when a.grp = b.grp then 0.08::double else 0.0::double end
                  + case when same_brand is null then 0.0::double when same_brand then 0.16::double else -0.16::double end + 0.24::double * (t::double / greatest(1, least(len(a.title), len(b.title)))) + 0.32::double * (dd::double / greatest(1, least(len(a.described), len(b.described))))
                  + case when len(list_intersect(a.ohm, b.ohm)) > 0 then 0.08::double else 0.0::double end as raw from ra),
    r1 as (select *, case when not conflict and {_LIQUID} and a.grp = b.grp and coalesce(same_brand, false) and len(list_filter(list_intersect(a.names, b.names), lambda w: w not in ('color', 'pack', 'p2', 'p3', 'p5'))) >= 1
                         and len(list_filter(list_intersect(a.described, b.described), lambda w: length(w) >= 4)) >= 3 then greatest(raw, 0.86::double) else raw end as strong from rs),
    rescue as (select match_id, a_variant_id, b_variant_id, least(1.0::double, greatest(0.0::double, case when not conflict and same_base and a.grp = b.grp and (t >= 2 or dd >= 6) then greatest(strong, 0.82::double) else strong end)) as score, conflict from r1)"""


def _rescued(spark: SparkSession, d: str) -> DataFrame:
    """match_id, ids, unrounded score and hard_conflict of the pairs of variant_match from the product rows their ids end in.

    A pair with both base ids is of one matched base; with a base on side a only it is a split base.
    """
    p = table(spark, d, "product").select("row_id", rescue.captured_features().alias("f"))
    row = lambda c: F.regexp_extract(c, r"(\d+)$", 1).try_cast("bigint")
    filled = lambda c: T.blank_to_null(F.col(c)).isNotNull()
    v = table(spark, d, "variant_match").select("match_id", "a_variant_id", "b_variant_id", row("a_variant_id").alias("a_row"), row("b_variant_id").alias("b_row"), filled("base_match_a_id").alias("a_base"), filled("base_match_b_id").alias("b_base"))
    side = lambda n: p.select(F.col("row_id").alias(f"{n}_row"), F.col("f").alias(n))
    audit = rescue.pair_audit(F.col("a"), F.col("b"), F.col("a_base") & F.col("b_base"), F.col("a_base") & ~F.col("b_base"))
    return v.join(side("a"), "a_row").join(side("b"), "b_row").select("match_id", "a_variant_id", "b_variant_id", audit.alias("r")).select("match_id", "a_variant_id", "b_variant_id", "r.score", "r.hard_conflict")


@query(f"with {_RESCUE} select match_id, round(score, 6) as score, conflict as hard_conflict from rescue")
def q_rescue_score(spark: SparkSession, d: str) -> DataFrame:
    return _rescued(spark, d).select("match_id", F.round("score", 6).alias("score"), "hard_conflict")


@query(
    f"with {_RESCUE}, ed as (select a_variant_id, b_variant_id, max(round(score, 6)) as score from rescue where not conflict and score >= 0.74 group by 1, 2), e as (select *, row_number() over (order by score desc, a_variant_id, b_variant_id) as rk from ed), l0 as (select a_variant_id, b_variant_id, rk from e), "
    f"{', '.join(_ROUND.format(i=i, j=i + 1) for i in range(10))} select e.a_variant_id, e.b_variant_id, e.score from e join ({' union all '.join(f'select rk from w{i}' for i in range(10))}) w using (rk)"
)
def q_rescue_accept(spark: SparkSession, d: str) -> DataFrame:
    """Rescued pairs without a hard conflict and over .74, each variant once, the best first."""
    ok = _rescued(spark, d).where("not hard_conflict and score >= 0.74").groupBy("a_variant_id", "b_variant_id").agg(F.max(F.round("score", 6)).alias("score"))
    return assign.greedy_one_to_one(ok, "a_variant_id", "b_variant_id", [("score", True), ("a_variant_id", False), ("b_variant_id", False)])


# --- smaller ones ------------------------------------------------------------------------------
@query(
    "select row_id, replace(replace(replace(replace(replace(replace(description, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&') as decoded, "
    "coalesce(len(list_filter(list_transform(regexp_split_to_array(commercial_brand, '[|,]'), lambda x: trim(x, ' ')), lambda x: x <> '')), 0) as listed from product where description is not null"
)
def q_decoded_texts(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "product").where("description is not null")
    return p.select("row_id", T.decode_entities(F.col("description")).alias("decoded"), F.coalesce(F.size(T.listed(F.col("commercial_brand"))), F.lit(0)).alias("listed"))


@query(
    "select match_id, case when variant_confidence * 100 >= 90 then 'high' when variant_confidence * 100 >= 70 then 'medium' else 'low' end as label, case variant_decision when 'match' then 'accepted' when 'no_match' then 'rejected' when 'possible' then 'needs_review' else variant_decision end as decision, "
    "json_object('a', nullif(a_title, ''), 'b', nullif(b_title, ''), 'reason', left(reason, 60)) as prompt from variant_match where a_title is not null and b_title is not null and reason is not null"
)
def q_review_labels(spark: SparkSession, d: str) -> DataFrame:
    """Label, decision and the lines a reviewer is sent of every pair with both titles."""
    m = table(spark, d, "variant_match").where("a_title is not null and b_title is not null and reason is not null")
    decision = F.col("variant_decision")
    said = F.when(decision == "match", "accepted").when(decision == "no_match", "rejected").when(decision == "possible", "needs_review").otherwise(decision)
    prompt = F.to_json(F.struct(F.nullif("a_title", F.lit("")).alias("a"), F.nullif("b_title", F.lit("")).alias("b"), F.substring("reason", 1, 60).alias("reason")), {"ignoreNullFields": "false"})
    return m.select("match_id", S.confidence_label(F.col("variant_confidence") * 100).alias("label"), said.alias("decision"), prompt.alias("prompt"))


@query(
    "with n as (select row_id, name, cast(coalesce(nullif(regexp_extract(replace(lower(variants['Nicotina']), ',', '.'), '(\\d+(?:\\.\\d+)?)\\s*mg', 1), ''), nullif(regexp_extract(replace(lower(variants['MG']), ',', '.'), '(\\d+(?:\\.\\d+)?)\\s*mg', 1), '')) as double) as mg from product), "
    "v as (select match_id, try_cast(regexp_extract(a_variant_id, '(\\d+)$', 1) as bigint) as a, try_cast(regexp_extract(b_variant_id, '(\\d+)$', 1) as bigint) as b from variant_match) "
    "select match_id, x.mg from v join n x on x.row_id = v.a join n y on y.row_id = v.b where x.mg = y.mg"
)
def q_exact_nicotine(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of variants that state the same nicotine."""
    stated = lambda k: F.nullif(F.regexp_extract(F.replace(F.lower(F.try_element_at("variants", F.lit(k))), F.lit(","), F.lit(".")), r"(\d+(?:\.\d+)?)\s*mg", 1), F.lit(""))
    n = table(spark, d, "product").select("row_id", F.coalesce(stated("Nicotina"), stated("MG")).cast("double").alias("mg")).where("mg is not null")
    row = lambda c: F.regexp_extract(c, r"(\d+)$", 1).try_cast("bigint")
    v = table(spark, d, "variant_match").select("match_id", row("a_variant_id").alias("a"), row("b_variant_id").alias("b"))
    return v.join(n.select(F.col("row_id").alias("a"), "mg"), "a").join(n.select(F.col("row_id").alias("b"), "mg"), ["b", "mg"]).select("match_id", "mg")

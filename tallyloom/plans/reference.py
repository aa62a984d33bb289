"""Queries of the catalogue operators over the test tables, each with the SQL that must agree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.functions import similarity as S
from tallyloom.functions import text as T
from tallyloom.functions import variants as V
from tallyloom.operators import assign, candidates, catalog, snapshots
from tallyloom.plans import products_sql as Q
from tallyloom.plans.sql import COLOURS_SQL, sql_category, sql_compact, sql_group, sql_key, sql_numbered, sql_numbers, sql_plain, sql_status, sql_type, sql_weight
from tallyloom.session import table
from tallyloom.sources import files

QUERIES = {}
SQL = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


# --- text -------------------------------------------------------------------------------
@query(f"select row_id, {sql_plain('name')} as norm, {sql_plain('category')} as category_norm from product")
def q_norm_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "product").select("row_id", T.plain(F.col("name")).alias("norm"), T.plain(F.col("category")).alias("category_norm"))


@query(f"select row_id, {sql_compact('name')} as compact_name, regexp_replace(upper(reference), '[^A-Z0-9]+', '', 'g') as ref_key from product")
def q_compact_key(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "product").select("row_id", T.compact(F.col("name")).alias("compact_name"), T.reference_key(F.col("reference")).alias("ref_key"))


@query(
    f"select brand, substr(regexp_replace(regexp_replace({sql_plain('brand')}, '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 120) as slug, count(*) as n from product group by 1, 2"
)
def q_slug(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "product").groupBy("brand", T.slug(F.col("brand")).alias("slug")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "select row_id, case when length(t) > 40 then rtrim(substr(t, 1, 39)) || '…' else t end as short, nullif(trim(meta_description), '') as meta from "
    "(select *, trim(regexp_replace(description, '\\s+', ' ', 'g')) as t from product)"
)
def q_short_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "product").select("row_id", T.short_text(F.col("description"), 40).alias("short"), T.blank_to_null(F.col("meta_description")).alias("meta"))


@query(
    f"select row_id, k as dimension, trim(v) as value from (select row_id, {sql_key('e.key')} as k, e.value as v from (select row_id, unnest(map_entries(variants)) as e from product where variants is not null))"
)
def q_variant_keys(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "product").select("row_id", F.explode("variants").alias("k", "v"))
    return p.select("row_id", T.variant_name(F.col("k")).alias("dimension"), F.trim("v").alias("value"))


@query(
    f"select row_id, list_aggregate(list_sort(list_transform(map_entries(variants), lambda e: {sql_plain('e.key')} || '=' || {sql_plain('e.value')})), 'string_agg', '|') as signature from product where cardinality(variants) > 0"
)
def q_variant_signature(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "product").where(F.size("variants") > 0).select("row_id", T.signature(F.col("variants")).alias("signature"))


@query(
    "with u as (select row_id, url, split_part(url, '#', 1) as b from product) select row_id, lower(regexp_replace(b, '/+$', '')) as url_key, "
    "regexp_replace(split_part(b, '?', 1), '/+$', '') || case when strpos(b, '?') = 0 then '' else coalesce('?' || nullif(list_aggregate(list_filter(string_split(split_part(b, '?', 2), '&'), "
    "lambda p: p <> '' and not regexp_matches(p, '^(?i)(?:utm_|fbclid|gclid|ref|mc_)')), 'string_agg', '&'), ''), '') end as canonical from u"
)
def q_url_canonical(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "product").select("row_id", T.url_key(F.col("url")).alias("url_key"), T.canonical_url(F.col("url")).alias("canonical"))


@query(
    "select row_id, reference as ean from product where regexp_matches(reference, '^\\d{13}$') and (10 - list_sum(list_transform(range(1, 13), "
    "lambda i: cast(substr(reference, cast(i as int), 1) as int) * case when i % 2 = 0 then 3 else 1 end)) % 10) % 10 = cast(substr(reference, 13, 1) as int)"
)
def q_ean13_valid(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "product").where(F.col("reference").rlike(r"^\d{13}$"))
    return p.select("row_id", T.ean13(F.col("reference")).alias("ean")).where("ean is not null")


@query(
    "select doc_id, regexp_replace(regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}', '[EMAIL_REDACTED]', 'g'), '(?i)\\b(api[_-]?key|token|secret|password)\\s*[=:]\\s*\\S+', '\\1=[REDACTED]', 'g') as safe from documents"
)
def q_redact_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.redacted_diagnostics(F.col("text")).alias("safe"))


@query(
    f"select row_id, upper(substr(sha256(concat_ws('|', distributor, coalesce(reference, ''), url)), 1, 8)) as sku_hash, sha256({sql_plain('name')} || chr(31) || {sql_plain(chr(99) + 'oalesce(category, ' + chr(39) * 2 + ')')}) as comparison_hash from product"
)
def q_comparison_hash(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "product")
    sku = F.element_at(F.split(T.generated_sku(F.lit("x"), F.col("distributor"), F.coalesce("reference", F.lit("")), F.col("url")), "-"), -1)
    return p.select("row_id", sku.alias("sku_hash"), T.comparison_hash(F.col("name"), F.col("category")).alias("comparison_hash"))


@query(
    "select row_id, coalesce(nullif(trim(commercial_brand), ''), nullif(trim(brand), ''), nullif(trim(brand_candidates[1]), '')) as brand_text, nullif(regexp_extract(upper(reference), '^[A-Z]{2}[-.]([A-Z0-9]+)', 1), '') as body from product"
)
def q_first_filled(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "product")
    return p.select(
        "row_id", T.coalesce_filled(F.col("commercial_brand"), F.col("brand"), F.get("brand_candidates", F.lit(0))).alias("brand_text"), T.reference_body(F.col("reference")).alias("body")
    )


# --- measures, classes, similarity --------------------------------------------------------
@query(f"select row_id, {sql_numbers('name', 'ml')} as ml, {sql_numbers('name', 'mg')} as mg, {sql_numbers('name', 'ohm')} as ohm from product")
def q_measure_extract(spark: SparkSession, d: str) -> DataFrame:
    render = lambda u: F.array_join(F.transform(S.numeric_set(F.col("name"), u), lambda x: F.round(x * 1000).cast("bigint").cast("string")), " ")
    return table(spark, d, "product").select("row_id", render("ml").alias("ml"), render("mg").alias("mg"), render("ohm").alias("ohm"))


def _kinds(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "product")
    return p.withColumn("product_type", S.product_kind(*[F.col(c) for c in ("name", "category", "category_id", "reference", "synthetic_reference", "variants")]))


@query(f"with t as (select {sql_type()} as product_type from product) select product_type, {sql_group('product_type')} as type_group, count(*) as n from t group by 1, 2")
def q_type_classify(spark: SparkSession, d: str) -> DataFrame:
    return _kinds(spark, d).groupBy("product_type", S.type_group(F.col("product_type")).alias("type_group")).agg(F.count(F.lit(1)).alias("n"))


@query(f"with t as (select row_id, category, {sql_type()} as product_type from product) select row_id, {sql_category('category', 'product_type', sql_group('product_type'))} as commercial from t")
def q_commercial_category(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("product_type")
    return _kinds(spark, d).select("row_id", S.commercial_category(F.col("category"), kind, S.type_group(kind)).alias("commercial"))


@query(
    f"select status, count(*) as pairs, count(distinct base_match_a_id) as products, round(avg(variant_confidence), 6) as mean_confidence from (select *, {sql_status()} as status from variant_match) group by 1"
)
def q_status_ladder(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "variant_match")
    s = S.status(_decision(), F.col("variant_confidence"), F.col("a_variant_id").isNull(), F.col("b_variant_id").isNull())
    return v.groupBy(s.alias("status")).agg(
        F.count(F.lit(1)).alias("pairs"), F.countDistinct("base_match_a_id").alias("products"), F.round(F.avg("variant_confidence"), 6).alias("mean_confidence")
    )


def _decision():
    return F.col("variant_decision")


@query(
    f"select match_id, case when ka = '' and kb = '' then 1.0 when ka = '' or kb = '' then 0.35 when ka = kb then 1.0 when j >= 0.8 then 0.95 when j >= 0.66 then 0.88 when j >= 0.5 then 0.72 when inside and soft then 0.86 when inside then 0.45 else 0.0 end::double as similarity "
    f"from (select *, contains(ka, kb) or contains(kb, ka) as inside, case when len(list_distinct(wa || wb)) > 0 then len(list_filter(wa, lambda w: list_contains(wb, w)))::double / len(list_distinct(wa || wb)) else 0.0 end as j, "
    "len(list_filter(list_filter(wa, lambda w: not list_contains(wb, w)) || list_filter(wb, lambda w: not list_contains(wa, w)), lambda w: w not in ('dark', 'light', 'metal', 'metallic'))) = 0 as soft "
    f"from (select match_id, {Q._keyed('a_title')} as ka, {Q._keyed('b_title')} as kb, {Q.words('a_title')} as wa, {Q.words('b_title')} as wb from variant_match))"
)
def q_value_similarity(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "variant_match").select("match_id", V.value_similarity(F.col("a_title"), F.col("b_title")).alias("similarity"))


@query(
    "select match_id, case when variant_confidence * 8 = floor(variant_confidence * 8) and variant_confidence * 4 <> floor(variant_confidence * 4) then floor(variant_confidence * 100 + 0.5) / 100 "
    "else cast(printf('%.2f', variant_confidence) as double) end as fixed, floor(0.72::double * variant_confidence * 1000 + 0.5) / 1000 as final_confidence from variant_match where variant_confidence is not null"
)
def q_final_confidence(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "variant_match").where("variant_confidence is not null")
    return v.select("match_id", S.to_fixed2(F.col("variant_confidence")).alias("fixed"), S.js_round(F.lit(0.72) * F.col("variant_confidence"), 3).alias("final_confidence"))


@query(
    f"with t as (select unnest(list_distinct(list_filter(regexp_split_to_array({sql_plain('name')}, '[^a-z0-9]+'), lambda w: length(w) > 1 or regexp_matches(w, '[0-9]')))) as token from product) "
    f"select token, {sql_weight('token')} as weight, count(*) as products from t group by 1, 2"
)
def q_token_weight(spark: SparkSession, d: str) -> DataFrame:
    t = F.filter(F.split(T.plain(F.col("name")), "[^a-z0-9]+"), lambda w: (F.length(w) > 1) | w.rlike("[0-9]"))
    flat = table(spark, d, "product").select(F.explode(F.array_distinct(t)).alias("token"))
    return flat.groupBy("token", S.token_weight(F.col("token")).alias("weight")).agg(F.count(F.lit(1)).alias("products"))


# --- base rows ------------------------------------------------------------------------------
@query(
    "select distributor, url, category, count(*) as variant_count, min(price_tax_excluded) as min_price, max(price_tax_excluded) as max_price from product group by all"
)
def q_base_group(spark: SparkSession, d: str) -> DataFrame:
    return catalog.base_groups(table(spark, d, "product"), ["distributor", "url", "category"], "price_tax_excluded")


@query(
    f"with f as (select url, {sql_key('e.key')} as dimension, {sql_plain('e.value')} as v from (select url, unnest(map_entries(variants)) as e from product where variants is not null) where e.value is not null) "
    "select url, dimension, count(distinct v) as value_count, string_agg(distinct v, ' | ' order by v) as value_list from f group by 1, 2"
)
def q_variant_summary(spark: SparkSession, d: str) -> DataFrame:
    return catalog.variant_summary(table(spark, d, "product"), "url", "variants")


@query("select url, arg_min(name, (length(name), name)) as representative from product where name is not null group by url")
def q_representative(spark: SparkSession, d: str) -> DataFrame:
    return assign.representative(table(spark, d, "product").where("name is not null"), ["url"], "name")


@query(
    "select row_id, coalesce(nullif(trim(brand), ''), first_value(nullif(trim(brand), '') ignore nulls) over w) as brand from product window w as (partition by url order by row_id rows between unbounded preceding and unbounded following)"
)
def q_brand_propagation(spark: SparkSession, d: str) -> DataFrame:
    return catalog.fill_from_group(table(spark, d, "product").select("row_id", "url", "brand"), "url", ["brand"], "row_id").select("row_id", "brand")


@query(
    "with r as (select row_id, url, row_number() over (partition by lower(regexp_replace(split_part(url, '#', 1), '/+$', '')) order by captured_at nulls first, row_id) as n from product) select row_id, url from r where n = 1"
)
def q_distinct_url(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("k").orderBy(F.col("captured_at").asc_nulls_first(), "row_id")
    return table(spark, d, "product").withColumn("k", T.url_key(F.col("url"))).withColumn("n", F.row_number().over(w)).where("n = 1").select("row_id", "url")


# --- blocking and scores ---------------------------------------------------------------------
_SIDES = "with a as (select p_partkey as a_id, p_name as a_name, p_brand as brand, p_type as kind, p_size as size from part where p_partkey % 2 = 0), b as (select p_partkey as b_id, p_name as b_name, p_brand as brand, p_type as kind, p_size as b_size from part where p_partkey % 2 = 1)"


def _part_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    p = table(spark, d, "part")
    side = lambda rest, n: p.where(F.col("p_partkey") % 2 == rest).select(
        F.col("p_partkey").alias(f"{n}_id"), F.col("p_name").alias(f"{n}_name"), F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"), F.col("p_size").alias("size" if n == "a" else "b_size")
    )
    return side(0, "a"), side(1, "b")


_ALIASES = [("Brand#1", "Brand#11", None), ("Brand#2", "Brand#22", "SMALL"), ("Brand#3", "Brand#13", "ECONOMY")]


@query(
    f"with a as (select p_partkey, p_type, {sql_compact('p_brand')} as k from part), r(s, t, y) as (values ('brand1', 'brand11', null), ('brand2', 'brand22', 'SMALL'), ('brand3', 'brand13', 'ECONOMY')) "
    "select p_partkey, k as brand_key from a union all select p_partkey, t from a join r on a.k = r.s and (r.y is null or r.y = a.p_type)"
)
def q_alias_expand(spark: SparkSession, d: str) -> DataFrame:
    rules = spark.createDataFrame(_ALIASES, "source_brand string, target_brand string, product_type string")
    return catalog.alias_keys(table(spark, d, "part"), "p_brand", "p_type", rules).select("p_partkey", "brand_key")


@query(f"{_SIDES} select brand, kind, count(*) as pairs, count(distinct a_id) as a_rows, count(distinct b_id) as b_rows from a join b using (brand, kind, size) group by 1, 2".replace("p_size as b_size", "p_size as size"))
def q_block_pairs(spark: SparkSession, d: str) -> DataFrame:
    a, b = _part_sides(spark, d)
    pairs = catalog.block_pairs(a, b.withColumnRenamed("b_size", "size"), ["brand", "kind", "size"], "a_id", "b_id")
    return pairs.groupBy("brand", "kind").agg(F.count(F.lit(1)).alias("pairs"), F.countDistinct("a_id").alias("a_rows"), F.countDistinct("b_id").alias("b_rows"))


_TFIDF = (
    f"with p as (select p_partkey as id, p_brand, p_type, p_size, unnest(string_split({sql_plain('p_name')} || ' ' || lower(p_type) || ' ' || lower(replace(p_brand, '#', '')), ' ')) as token from part), "
    "tf as (select id, token, count(*) as tf from p group by 1, 2), df as (select token, count(*) as df from tf group by 1), n as (select count(*) as n from part)"
)


def _part_tfidf(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat_ws(" ", T.plain(F.col("p_name")), F.lower("p_type"), F.lower(F.replace(F.col("p_brand"), F.lit("#"), F.lit(""))))
    return catalog.tfidf(table(spark, d, "part").select("p_partkey", F.split(text, " ").alias("tokens")), "p_partkey", "tokens")


@query(f"{_TFIDF} select token, df, round(ln(n::double / df), 6) as idf from df, n")
def q_tfidf_df(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "part").agg(F.count(F.lit(1)).alias("n"))
    return _part_tfidf(spark, d).groupBy("token").agg(F.max("df").alias("df")).join(F.broadcast(n)).select("token", "df", F.round(F.ln(F.col("n") / F.col("df")), 6).alias("idf"))


@query(
    f"{_TFIDF}, w as (select tf.id, tf.token, tf * ln(n::double / df) as w from tf join df using (token), n), v as (select id, sqrt(sum(w * w)) as norm from w group by 1), "
    "s as (select a.p_partkey as a_id, b.p_partkey as b_id from part a join part b on a.p_brand = b.p_brand and a.p_type = b.p_type and a.p_size = b.p_size and a.p_partkey % 2 = 0 and b.p_partkey % 2 = 1), "
    "c as (select s.a_id, s.b_id, sum(x.w * y.w) / (max(p.norm) * max(q.norm)) as cosine from s join w x on x.id = s.a_id join w y on y.id = s.b_id and y.token = x.token join v p on p.id = s.a_id join v q on q.id = s.b_id group by 1, 2) "
    "select a_id, b_id, round(cosine, 6) as cosine from c where cosine >= 0.45"
)
def q_tfidf_cosine(spark: SparkSession, d: str) -> DataFrame:
    """Cosine of the pairs of a block over tf-idf weights of all parts."""
    a, b = _part_sides(spark, d)
    pairs = a.join(b.withColumnRenamed("b_size", "size"), ["brand", "kind", "size"]).select("a_id", "b_id")
    w = _part_tfidf(spark, d)
    x = w.select(F.col("p_partkey").alias("a_id"), "token", (F.col("weight") / F.col("norm")).alias("wa"))
    y = w.select(F.col("p_partkey").alias("b_id"), "token", (F.col("weight") / F.col("norm")).alias("wb"))
    return (
        pairs.join(x, "a_id").join(y, ["b_id", "token"]).groupBy("a_id", "b_id").agg(F.sum(F.col("wa") * F.col("wb")).alias("c")).where("c >= 0.45")
        .select("a_id", "b_id", F.round("c", 6).alias("cosine"))
    )


_TOKENS = f"""with tk as (select row_id, distributor, unnest(list_distinct(list_filter(regexp_split_to_array({sql_numbered("concat_ws(' ', name, meta_description, description, reference, synthetic_reference, array_to_string(map_values(variants), ' '), url)")}, '[^a-z0-9]+'),
        lambda w: length(w) >= 3 and w not in ({', '.join(f"'{w}'" for w in (
            "a al and aroma aromas base bote botella by capacidad caracteristicas cartucho con de del descripcion distribuidor edition el en es este formato html http https la las liquido liquidos los marca marcas "
            "meta ml para pod producto que referencia scrapeada sin sweet the ultimate un una vapeo vaperalia eciglogistica venta y").split())})))) as token from product where distributor is not null)"""
_SHARED = "s as (select a.row_id as a_id, b.distributor as b_distributor, b.row_id as b_id, count(*) as shared from tk a join b on a.token = b.token and a.distributor <> b.distributor group by 1, 2, 3) select *, row_number() over (partition by a_id, b_distributor order by shared desc, b_id) as position from s qualify position <= 120"


def _row_tokens(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "product").select("row_id", "distributor", candidates.product_words().alias("tokens"))


@query(f"{_TOKENS}, b as (select * from tk qualify count(*) over (partition by distributor, token) <= 400), {_SHARED}")
def q_inverted_index_topk(spark: SparkSession, d: str) -> DataFrame:
    """The reference's candidates: postings over 400 rows skipped, best 120 per row and other distributor."""
    return candidates.shared_token_top(_row_tokens(spark, d), "row_id", "distributor", "tokens", 400, 120).withColumnRenamed("b_side", "b_distributor")


@query(f"{_TOKENS}, b as (select * from tk), {_SHARED}")
def q_inverted_index_all(spark: SparkSession, d: str) -> DataFrame:
    """The 120 best candidates of every row at every other distributor over all tokens, whatever their frequency."""
    return candidates.shared_token_best(_row_tokens(spark, d), "row_id", "distributor", "tokens", 120).withColumnRenamed("b_side", "b_distributor")


# --- joins, merges, coverage ---------------------------------------------------------------------
@query("select row_id, url from product where url is not null and url not in (select url from catalog_snapshot where url is not null and snapshot_no is not null and category is not null)")
def q_coverage_anti(spark: SparkSession, d: str) -> DataFrame:
    """Captured rows whose address no delivered listing with a category covers."""
    covered = table(spark, d, "catalog_snapshot").where("url is not null and snapshot_no is not null and category is not null")
    return catalog.unmatched(table(spark, d, "product").where("url is not null").select("row_id", "url"), covered, "url")


@query(
    "select distributor || ':' || row_id as id from product where row_id not in (select try_cast(regexp_extract(v, '(\\d+)$', 1) as bigint) from (select a_variant_id as v from variant_match union all select b_variant_id from variant_match) where v is not null)"
)
def q_inverse_anti(spark: SparkSession, d: str) -> DataFrame:
    """Captured variants that no match covers on either side."""
    m = table(spark, d, "variant_match").select(F.explode(F.array("a_variant_id", "b_variant_id")).alias("v"))
    covered = m.select(F.regexp_extract("v", r"(\d+)$", 1).try_cast("bigint").alias("row_id")).where("row_id is not null")
    return catalog.unmatched(table(spark, d, "product").select("row_id", F.concat_ws(":", "distributor", F.col("row_id").cast("string")).alias("id")), covered, "row_id").select("id")


_RANK = "case o_orderstatus when 'F' then 4 when 'O' then 3 when 'P' then 2 else 1 end"


@query(
    f"with o as (select *, {_RANK} as k from orders), m as (select *, max(k) over (partition by o_custkey) as best from o), r as (select *, row_number() over (partition by o_custkey order by o_orderkey) as n from m where k = best) "
    "select o_custkey, o_orderkey, o_orderstatus from r where n = 1"
)
def q_rank_merge(spark: SparkSession, d: str) -> DataFrame:
    return catalog.rank_merge(table(spark, d, "orders"), "o_custkey", F.expr(_RANK), "o_orderkey").select("o_custkey", "o_orderkey", "o_orderstatus")


@query(
    "with m as (select o_custkey as k, min(o_orderkey) as v from orders where o_orderstatus = 'F' group by 1), f as (select o_custkey as k, min(o_orderkey) as v from orders where o_orderstatus <> 'F' group by 1) "
    "select k, v, 'main' as origin from m union all select k, v, 'fallback' from f where k not in (select k from m)"
)
def q_no_match_fallback(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    pick = lambda cond, name: o.where(cond).groupBy(F.col("o_custkey").alias("k")).agg(F.min("o_orderkey").alias("v")).withColumn("origin", F.lit(name))
    return catalog.with_fallback(pick("o_orderstatus = 'F'", "main"), pick("o_orderstatus <> 'F'", "fallback"), "k", "v")


@query(
    "select distributor, category, count(*) as products, row_number() over (order by case distributor when 'brumacat' then 1 when 'calimadis' then 2 else 80 end, distributor, category nulls first) as position from product group by 1, 2"
)
def q_manifest_order(spark: SparkSession, d: str) -> DataFrame:
    """The manifest has one row per dataset, so its order is one small sort."""
    g = table(spark, d, "product").groupBy("distributor", "category").agg(F.count(F.lit(1)).alias("products"))
    order = F.when(F.col("distributor") == "brumacat", 1).when(F.col("distributor") == "calimadis", 2).otherwise(80)
    return g.withColumn("position", F.row_number().over(Window.orderBy(order, "distributor", F.col("category").asc_nulls_first())))


@query(
    "with v as (select a_variant_id as k, count(*) as l from variant_match where a_variant_id is not null group by 1), p as (select distributor || ':' || row_id as k, count(*) as r from product group by 1) "
    "select case when r is null then 'missing' when l is null then 'unknown' when l > 1 or r > 1 then 'duplicate' else 'matched' end as outcome, count(*) as keys from v full join p using (k) group by 1"
)
def q_bijection_check(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "variant_match").where("a_variant_id is not null").select(F.col("a_variant_id").alias("k"))
    p = table(spark, d, "product").select(F.concat_ws(":", "distributor", F.col("row_id").cast("string")).alias("k"))
    return catalog.bijection_report(v, p, "k")


@query(
    "with l as (select a_variant_id, max(match_id) as match_id from variant_match where variant_decision = 'match' group by 1) select v.match_id, v.variant_decision, l.match_id is not null as reviewed from variant_match v left join l on l.a_variant_id = v.a_variant_id"
)
def q_ledger_join(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "variant_match")
    ledger = v.where("variant_decision = 'match' and a_variant_id is not null").groupBy("a_variant_id").agg(F.max("match_id").alias("_l"))
    return v.select("match_id", "variant_decision", "a_variant_id").join(ledger, "a_variant_id", "left").select("match_id", "variant_decision", F.col("_l").isNotNull().alias("reviewed"))


@query(
    f"with p as (select row_id, url as k1, lower(regexp_replace(split_part(url, '#', 1), '/+$', '')) as k2, {sql_plain('name')} as k3 from product), "
    f"w as (select match_id, a_url as k1, lower(regexp_replace(split_part(a_url, '#', 1), '/+$', '')) as k2, {sql_plain('a_title')} as k3 from variant_match), "
    "u1 as (select k1, min(row_id) as r from p where k1 is not null group by 1 having count(*) = 1), u2 as (select k2, min(row_id) as r from p where k2 is not null group by 1 having count(*) = 1), u3 as (select k3, min(row_id) as r from p where k3 is not null group by 1 having count(*) = 1) "
    "select match_id, case when u1.r is not null then 1 when u2.r is not null then 2 when u3.r is not null then 3 else 0 end as tier, coalesce(u1.r, u2.r, u3.r) as resolved from w left join u1 using (k1) left join u2 using (k2) left join u3 using (k3)"
)
def q_tier_resolve(spark: SparkSession, d: str) -> DataFrame:
    keyed = lambda df, i, u, n: df.select(i, F.col(u).alias("k1"), T.url_key(F.col(u)).alias("k2"), T.plain(F.col(n)).alias("k3"))
    return catalog.resolve_in_tiers(keyed(table(spark, d, "variant_match"), "match_id", "a_url", "a_title"), keyed(table(spark, d, "product"), "row_id", "url", "name"), "match_id", "row_id", ["k1", "k2", "k3"])


@query(
    f"with a as (select {sql_compact('name')} as k, count(*) as n from product where name is not null group by 1), b as (select {sql_compact('b_title')} as k, count(*) as n from variant_match where b_title is not null group by 1) "
    "select k, case when b.n is null then 'a_only' when a.n is null then 'b_only' else 'both' end as side, coalesce(a.n, 0) as a_rows, coalesce(b.n, 0) as b_rows from a full join b using (k)"
)
def q_master_three_way(spark: SparkSession, d: str) -> DataFrame:
    """Captured names against the matched titles of side B."""
    names = table(spark, d, "product").where("name is not null").select(T.compact(F.col("name")).alias("k"))
    return catalog.three_way(names, table(spark, d, "variant_match").where("b_title is not null").select(T.compact(F.col("b_title")).alias("k")), "k")


# --- identity ---------------------------------------------------------------------------------------
@query(
    "select row_id, case when reference is null or count(*) over (partition by reference) = 1 then reference else substr(reference, 1, 111) || '-' || substr(sha256(reference || '|' || row_id), 1, 8) end as unique_code from product"
)
def q_unique_sku(spark: SparkSession, d: str) -> DataFrame:
    return catalog.unique_codes(table(spark, d, "product"), "row_id", "reference")


@query(
    "with c as (select row_id, case when regexp_matches(reference, '^\\d{13}$') then reference end as e from product) select row_id, case when count(*) over (partition by e) = 1 then e end as unique_code from c"
)
def q_unique_ean(spark: SparkSession, d: str) -> DataFrame:
    return catalog.unique_or_null(table(spark, d, "product"), "row_id", F.when(F.col("reference").rlike(r"^\d{13}$"), F.col("reference")))


@query(
    "with g as (select url, count(distinct reference) as n, min(reference) as v from product group by 1) select url, n as distinct_values, case when n = 1 then v end as sole_value, case when n = 1 then 'unique' when n > 1 then 'conflict' else 'none' end as outcome from g"
)
def q_ean_enrich(spark: SparkSession, d: str) -> DataFrame:
    return catalog.sole_value(table(spark, d, "product"), "url", "reference")


@query("select a_variant_id, b_variant_id, count(*) as rows from variant_match group by all having count(*) > 1")
def q_ambiguous_links(spark: SparkSession, d: str) -> DataFrame:
    return catalog.ambiguous(table(spark, d, "variant_match"), ["a_variant_id", "b_variant_id"])


@query(
    "with c as (select row_id, name, category from product), i as (select listing_id as row_id, name, category from catalog_snapshot where listing_id is not null qualify row_number() over (partition by listing_id order by snapshot_no, captured_at nulls first, name nulls first, category nulls first) = 1) "
    "select coalesce(c.row_id, i.row_id) as row_id, coalesce(i.name, c.name) as name, coalesce(i.category, c.category) as category, case when c.row_id is null then 'insert' when i.row_id is null then 'keep' else 'update' end as action from c full join i on c.row_id = i.row_id"
)
def q_upsert_merge(spark: SparkSession, d: str) -> DataFrame:
    """Captured rows merged with the first delivered row of every listing."""
    first = F.struct("snapshot_no", "captured_at", "name", "category")
    incoming = table(spark, d, "catalog_snapshot").where("listing_id is not null").groupBy(F.col("listing_id").alias("row_id")).agg(F.min(first).alias("m")).select("row_id", "m.name", "m.category", F.lit(0).alias("o"))
    return catalog.upserted(table(spark, d, "product").select("row_id", "name", "category"), incoming, "row_id", ["name", "category"], "o")


@query(
    "with m as (select url as g, row_id as id from product where url is not null), d as (select try_cast(regexp_extract(a_variant_id, '(\\d+)$', 1) as bigint) as id, count(*) as n from variant_match group by 1), x as (select g, count(*) as members, count(*) filter (n > 0) as referenced, min(id) filter (n > 0) as r, min(id) as l from m left join d using (id) group by 1) "
    "select g as url, members, referenced, case when referenced = 1 then r when referenced = 0 then l end as survivor from x"
)
def q_merge_survivor(spark: SparkSession, d: str) -> DataFrame:
    """Per address the captured row that survives; matches are the dependents."""
    deps = table(spark, d, "variant_match").select(F.regexp_extract("a_variant_id", r"(\d+)$", 1).try_cast("bigint").alias("row_id")).where("row_id is not null")
    return catalog.merge_survivors(table(spark, d, "product").where("url is not null").select("url", "row_id"), "url", "row_id", deps)


# --- JSON, pages, maps, checks ------------------------------------------------------------------------
@query("select event_type, count(*) as events, sum(cast(json_extract_string(props, '$.k') as bigint)) as total_k, round(avg(value), 6) as mean_value from events group by 1")
def q_json_props(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("k", F.from_json("props", "k bigint")["k"])
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"), F.sum("k").alias("total_k"), F.round(F.avg("value"), 6).alias("mean_value"))


@query("select row_id, trim(regexp_replace(regexp_replace(description, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) as plain_description, contains(description, '<p>') as had_markup from product where description is not null")
def q_html_fields(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "product").where("description is not null")
    return p.select("row_id", files.strip_tags(F.col("description")).alias("plain_description"), F.col("description").contains("<p>").alias("had_markup"))


@query(
    "with b as (select p_partkey, unnest(['L', 'M', 'S']) as s from part), c as (select *, unnest(['blue', 'red']) as v from b) select p_partkey, 'color=' || v || ';size=' || s as combination from c"
)
def q_cartesian_expand(spark: SparkSession, d: str) -> DataFrame:
    dims = F.create_map(F.lit("size"), F.array(*map(F.lit, ["L", "M", "S"])), F.lit("color"), F.array(F.lit("blue"), F.lit("red")))
    return catalog.expanded(table(spark, d, "part"), "p_partkey", dims)


@query(
    "select field, level, rows from (select unnest([{'field': 'distributor', 'level': 'error', 'rows': count(*) filter (nullif(trim(distributor), '') is null)}, {'field': 'name', 'level': 'error', 'rows': count(*) filter (nullif(trim(name), '') is null)}, "
    "{'field': 'url', 'level': 'error', 'rows': count(*) filter (nullif(trim(url), '') is null)}, {'field': 'reference', 'level': 'warning', 'rows': count(*) filter (nullif(trim(reference), '') is null)}, "
    "{'field': 'variants', 'level': 'warning', 'rows': count(*) filter (coalesce(cardinality(variants), 0) = 0)}, {'field': 'description', 'level': 'warning', 'rows': count(*) filter (nullif(trim(description), '') is null)}, "
    "{'field': 'breadcrumb_path', 'level': 'warning', 'rows': count(*) filter (coalesce(len(breadcrumb_path), 0) = 0)}], recursive := true) from product)"
)
def q_contract_check(spark: SparkSession, d: str) -> DataFrame:
    return catalog.contract_findings(table(spark, d, "product"), ["distributor", "name", "url"], ["reference", "variants", "description", "breadcrumb_path"])


@query(
    "with seq as (select distributor, snapshot_no, row_number() over w as i, lead(snapshot_no) over w as next_no from (select distinct distributor, snapshot_no from snapshot_delivery) window w as (partition by distributor order by snapshot_no)), "
    "l as (select distributor, snapshot_no, url, count(*) as n from catalog_snapshot group by 1, 2, 3), u as (select l.distributor, l.snapshot_no, url, 0 as o, n as k from l join seq using (distributor, snapshot_no) where i > 1 "
    "union all select l.distributor, next_no, url, n, 0 from l join seq using (distributor, snapshot_no) where next_no is not null), g as (select distributor, snapshot_no, url, cast(sum(o) as bigint) as old_rows, cast(sum(k) as bigint) as new_rows from u group by 1, 2, 3) "
    "select *, case when old_rows = 0 then 'added' when new_rows = 0 then 'missing' when old_rows <> new_rows then 'row_count' else 'same' end as outcome from g"
)
def q_snapshot_diff(spark: SparkSession, d: str) -> DataFrame:
    """Captured rows per address in every delivery after a distributor's first, against its preceding delivery."""
    return snapshots.url_row_counts(table(spark, d, "catalog_snapshot"), table(spark, d, "snapshot_delivery"))


@query(
    "select variant_decision, count(*) as rows, count(distinct base_match_a_id) as products, count(*) filter (variant_confidence >= 0.95) as sure, count(*) filter (b_variant_id is null) as a_only from variant_match group by 1"
)
def q_match_summary(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "variant_match").groupBy("variant_decision").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("base_match_a_id").alias("products"), F.count_if(F.col("variant_confidence") >= 0.95).alias("sure"), F.count_if(F.col("b_variant_id").isNull()).alias("a_only")
    )


@query(
    f"select row_id, length(list_intersect(c, b)) as shared, length(list_distinct(c || b)) as all_words, length(list_filter(c, lambda x: not list_contains(b, x))) as only_name from (select row_id, list_distinct(string_split({sql_plain('name')}, ' ')) as c, list_distinct(string_split({sql_plain('category')}, ' ')) as b from product where name is not null and category is not null)"
)
def q_set_algebra(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "product").where("name is not null and category is not null").select(
        "row_id", F.array_distinct(F.split(T.plain(F.col("name")), " ")).alias("c"), F.array_distinct(F.split(T.plain(F.col("category")), " ")).alias("b")
    )
    return p.select("row_id", F.size(F.array_intersect("c", "b")).alias("shared"), F.size(F.array_union("c", "b")).alias("all_words"), F.size(F.array_except("c", "b")).alias("only_name"))


@query(f"select row_id, {COLOURS_SQL} as colour from product where variants is not null")
def q_colour_value(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "product").where("variants is not null")
    return v.select("row_id", F.coalesce(*[F.lower(F.trim(F.col("variants")[k])) for k in ("Colour", "Color", "COLOR", "color de referencia")]).alias("colour"))


@query("select source_file, count(*) as rows, count(distinct url) as urls, min(row_id) as first_row from product group by 1")
def q_source_summary(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "product").groupBy("source_file").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("url").alias("urls"), F.min("row_id").alias("first_row")
    )


@query("select match_id, variant_confidence, reason from variant_match order by variant_confidence desc nulls last, match_id limit 250")
def q_top_250(spark: SparkSession, d: str) -> DataFrame:
    """A top-k report."""
    return assign.top_k(table(spark, d, "variant_match").select("match_id", "variant_confidence", "reason"), 250, F.desc_nulls_last("variant_confidence"), F.asc("match_id"))


@query("select distinct concat_ws('|', cast(user_id as varchar), cast(cast(ts as date) as varchar), event_type) as k from events")
def q_stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    """First event of every user, day and type, read as a stream until its end; a test compares it with a batch."""
    import uuid

    from tallyloom.session import shared_folder
    from tallyloom.streaming import capture

    like = table(spark, d, "events")
    root = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    stream = spark.readStream.schema(like.schema).option("pathGlobFilter", "events*.parquet").option("recursiveFileLookup", "true").parquet(d)
    keyed = stream.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("k", F.concat_ws("|", F.col("user_id").cast("string"), F.to_date("ts").cast("string"), "event_type"))
    out = f"{root}/out"
    capture.run_available(capture.first_seen(keyed, "k", "ts", "400 days").select("k"), f"{root}/state", lambda df, _: df.write.mode("append").parquet(out))
    return spark.read.schema("k string").parquet(out)

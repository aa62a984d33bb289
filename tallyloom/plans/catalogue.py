"""Queries of base products, variants, their scores and what follows from them, each with the SQL that must agree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import similarity as S
from tallyloom.operators import assign, base_match, products
from tallyloom.plans import products_sql as Q
from tallyloom.plans.sql import sql_fold
from tallyloom.session import stored, table

QUERIES = {}
SQL = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


@query(
    f"with {Q.PROFILE} select row_id, title, coalesce(brand_found, '') as brand, array_to_string(brands, ' | ') as brands, product_type, base_key, base_url, regexp_extract({sql_fold('reference')}, '^([a-z])[\\s.-]', 1) as prefix from prof"
)
def q_product_profile(spark: SparkSession, d: str) -> DataFrame:
    p = products.profiled(table(spark, d, "product"))
    return p.select(
        "row_id", "title", F.coalesce("brand_found", F.lit("")).alias("brand"), F.array_join("brands", " | ").alias("brands"), "product_type", "base_key", "base_url", S.reference_prefix(F.col("reference")).alias("prefix")
    )


_SAID = [
    ("Descripcion scrapeada: ", "description"), ("Meta descripcion: ", "meta_description"), ("Marca: ", "brand_found"), ("Marcas candidatas: ", "array_to_string(brands, ' | ')"), ("Marca comercial: ", "commercial_brand"),
    ("Linea: ", "product_line"), ("Breadcrumb: ", "crumbs"), ("Categoria: ", "category"), ("Referencia: ", "reference"), ("Referencia sintetica: ", "synthetic_reference"), ("Variantes: ", "variant_summary"), ("Valores de variantes: ", "variant_values"),
]


@query(
    f"""with {Q.OWN}, {Q.PROFILE}, {Q.REPS}, {Q.SUMMARY}
    select base_id as id, distributor, base_url as url, title, concat_ws('. ', nullif(title, ''), {', '.join(f"case when coalesce({c}, '') <> '' then '{label}' || {c} end" for label, c in _SAID)}) as description,
           coalesce(category, '') as category, source_categories, coalesce(brand_found, '') as brand, array_to_string(brands, ' | ') as brand_candidates, coalesce(commercial_brand, '') as commercial_brand, coalesce(product_line, '') as product_line,
           crumbs as breadcrumb_path, coalesce(meta_description, '') as meta_description, product_type, coalesce(reference, '') as reference, coalesce(synthetic_reference, '') as synthetic_reference, base_key, variant_count,
           coalesce(variant_summary, '') as variant_summary, coalesce(variant_values, '') as variant_values, min_price, max_price, source_files from r2"""
)
def q_base_rows(spark: SparkSession, d: str) -> DataFrame:
    return products.base_rows(table(spark, d, "product"))


_VARIANTS = f"with {Q.OWN}, {Q.PROFILE}, {Q.REPS}, {Q.VARIANTS}"


@query(f"{_VARIANTS} select * from vr")
def q_variant_rows(spark: SparkSession, d: str) -> DataFrame:
    return products.variant_rows(table(spark, d, "product"))


@query(f"{_VARIANTS}, {Q.FIELDS} select * from vf")
def q_variant_fields(spark: SparkSession, d: str) -> DataFrame:
    return products.variant_fields(products.variant_rows(table(spark, d, "product")))


_BASES = """
    side as (select row_id, base_id from vr),
    pairs as (select distinct coalesce(x.base_id, 'unknown:' || a_url) as a_base, coalesce(y.base_id, 'unknown:' || b_url) as b_base
              from variant_match m left join side x on x.row_id = try_cast(regexp_extract(a_variant_id, '(\\d+)$', 1) as bigint) left join side y on y.row_id = try_cast(regexp_extract(b_variant_id, '(\\d+)$', 1) as bigint)
              where a_variant_id is not null and b_variant_id is not null)"""


def _fields(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(matched bases, fields of all variants): bases are matched where variant_match has a pair of their variants."""
    v = products.variant_rows(table(spark, d, "product"))
    row = lambda c: F.regexp_extract(c, r"(\d+)$", 1).try_cast("bigint")
    m = table(spark, d, "variant_match").where("a_variant_id is not null and b_variant_id is not null").select(row("a_variant_id").alias("a_row"), row("b_variant_id").alias("b_row"), "a_url", "b_url")
    side = lambda n: v.select(F.col("row_id").alias(f"{n}_row"), F.col("base_id").alias(f"{n}_known"))
    named = lambda n: F.coalesce(f"{n}_known", F.concat(F.lit("unknown:"), f"{n}_url")).alias(f"{n}_base")
    pairs = m.join(side("a"), "a_row", "left").join(side("b"), "b_row", "left").select(named("a"), named("b")).distinct()
    return pairs, products.variant_fields(v)


_BEST = f"{_VARIANTS}, {Q.FIELDS}, {_BASES}, {Q.SCORES}"


@query(f"{_BEST} select * from vm")
def q_variant_best(spark: SparkSession, d: str) -> DataFrame:
    return products.best_variants(*_fields(spark, d))


def _status(decision, confidence):
    return (
        F.when(decision.isin("a_variant_without_b_variant", "missing_variants"), "a_only")
        .when((decision == "variant_match") & (confidence >= 0.95), "valid")
        .when((decision == "possible_variant_match") & (confidence >= 0.85), "probable")
        .when(confidence <= 0, "impossible")
        .otherwise("discarded_low_confidence")
    )


@query(
    f"{_BEST}, st as (select *, case when decision in ('a_variant_without_b_variant', 'missing_variants') then 'a_only' when decision = 'variant_match' and confidence >= 0.95 then 'valid' when decision = 'possible_variant_match' and confidence >= 0.85 then 'probable' when confidence <= 0 then 'impossible' else 'discarded_low_confidence' end as status from vm) "
    "select status, decision, count(*) as variants, count(distinct a_base) as bases, count(distinct b_id) as partners, count(*) filter (confidence >= 0.95) as sure, count(*) filter (b_id is null) as alone, round(avg(confidence), 6) as mean_confidence, "
    "min(confidence) as least_confidence, max(confidence) as most_confidence, sum(cast(floor(0.72::double * confidence * 1000 + 0.5) as bigint)) as final_thousandths, count(distinct a_id) as a_variants from st group by 1, 2"
)
def q_variant_status(spark: SparkSession, d: str) -> DataFrame:
    """The twelve counts of a match dataset by status and decision."""
    best = products.best_variants(*_fields(spark, d))
    c = F.col("confidence")
    return best.groupBy(_status(F.col("decision"), c).alias("status"), "decision").agg(
        F.count(F.lit(1)).alias("variants"), F.countDistinct("a_base").alias("bases"), F.countDistinct("b_id").alias("partners"), F.count_if(c >= 0.95).alias("sure"), F.count_if(F.col("b_id").isNull()).alias("alone"),
        F.round(F.avg(c), 6).alias("mean_confidence"), F.min(c).alias("least_confidence"), F.max(c).alias("most_confidence"), F.sum(F.floor(F.lit(0.72) * c * 1000 + 0.5).cast("bigint")).alias("final_thousandths"), F.countDistinct("a_id").alias("a_variants"),
    )


@query(
    f"{_BEST}, u as (select p.b_base, p.a_base, f.id from pairs p join vf f on f.base_id = p.b_base where f.id not in (select b_id from vm where b_id is not null)) "
    "select b_base, id as b_id, min(a_base) as emitted_by from u group by 1, 2"
)
def q_b_only(spark: SparkSession, d: str) -> DataFrame:
    """Variants of matched B bases that no A variant took, each once, by the first base that has it."""
    pairs, fields = _fields(spark, d)
    taken = products.best_variants(pairs, fields).where("b_id is not null").select(F.col("b_id").alias("id"))
    all_b = pairs.join(fields.select(F.col("base_id").alias("b_base"), "id"), "b_base")
    return all_b.join(taken.distinct(), "id", "left_anti").groupBy("b_base", F.col("id").alias("b_id")).agg(F.min("a_base").alias("emitted_by"))


_HARDWARE = f"with {Q.OWN}, {Q.PROFILE}, {Q.REPS}, {Q.SUMMARY}, {Q.HARDWARE}"
LEFT, RIGHT = ["brumacat", "calimadis", "humedra"], ["vahoria", "nubarolia"]


def _base_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Features of all bases: three distributors are side A, the other two side B."""
    features = stored(base_match.base_features(products.named_bases(table(spark, d, "product"))))
    return features.where(F.col("distributor").isin(*LEFT)), features.where(F.col("distributor").isin(*RIGHT))


def _base_scores(spark: SparkSession, d: str) -> DataFrame:
    return base_match.scored_bases(*_base_sides(spark, d))


@query(f"{_HARDWARE} select distributor, block, subtype, salt, len(tokens) as words, len(caps) as capacities, len(packs) as packs, count(*) as bases, sum(length(array_to_string(tokens, ' '))) as letters from hf group by all")
def q_block_types(spark: SparkSession, d: str) -> DataFrame:
    a, b = _base_sides(spark, d)
    f = a.unionByName(b)
    return f.groupBy("distributor", "block", F.col("f.subtype").alias("subtype"), F.col("f.salt").alias("salt"), F.size("f.tokens").alias("words"), F.size("f.caps").alias("capacities"), F.size("f.packs").alias("packs")).agg(
        F.count(F.lit(1)).alias("bases"), F.sum(F.length(F.array_join("f.tokens", " "))).alias("letters")
    )


@query(f"{_HARDWARE} select a_id, b_id, score from hw")
def q_hw_score(spark: SparkSession, d: str) -> DataFrame:
    return _base_scores(spark, d).select("a_id", "b_id", "score")


_RANKED = f"{_HARDWARE}, r as (select *, row_number() over (partition by a_id order by score desc, b_title, b_id) as n from hw)"


@query(f"{_RANKED} select ha.a_id, r.b_id as best, r.score, case when r.b_id is null then 'no_match' else 'match' end as decision from ha left join r on r.a_id = ha.a_id and n = 1")
def q_best_match(spark: SparkSession, d: str) -> DataFrame:
    a, b = _base_sides(spark, d)
    best = assign.best_and_alternatives(base_match.scored_bases(a, b), "a_id", "b_id", "score", "b_title").select("a_id", "best", F.col("best_score").alias("score"))
    ids = a.select(F.col("id").alias("a_id")).distinct()
    return ids.join(best, "a_id", "left").select("a_id", "best", "score", F.when(F.col("best").isNull(), "no_match").otherwise("match").alias("decision"))


@query(f"{_RANKED} select a_id, string_agg(b_id || ':' || printf('%.2f', score), '|' order by n) filter (n between 2 and 6) as alternatives from r group by 1")
def q_alternatives(spark: SparkSession, d: str) -> DataFrame:
    return assign.best_and_alternatives(_base_scores(spark, d), "a_id", "b_id", "score", "b_title").select("a_id", F.nullif("alternatives", F.lit("")).alias("alternatives"))


_ROUND = "a{i} as (select *, row_number() over (partition by a_id order by score desc, a_id, b_id) as x, row_number() over (partition by b_id order by score desc, a_id, b_id) as y from l{i}), w{i} as (select a_id, b_id, score from a{i} where x = 1 and y = 1), l{j} as (select a_id, b_id, score from l{i} where a_id not in (select a_id from w{i}) and b_id not in (select b_id from w{i}))"


@query(
    f"{_HARDWARE}, l0 as (select a_id, b_id, score from hw), " + ", ".join(_ROUND.format(i=i, j=i + 1) for i in range(8)) + " " + " union all ".join(f"select * from w{i}" for i in range(8)) + " union all select * from l8"
)
def q_greedy_pairs(spark: SparkSession, d: str) -> DataFrame:
    """One-to-one by sequential greedy; the SQL unrolls eight rounds and keeps what is left visible."""
    return assign.greedy_one_to_one(_base_scores(spark, d).select("a_id", "b_id", "score"), "a_id", "b_id", [("score", True), ("a_id", False), ("b_id", False)])


@query(f"{_RANKED}, f as (select * from r where n = 1) select b_id, arg_min(a_id, {{'s': -score, 'a': a_id}}) as a_id, max(score) as score from f group by b_id")
def q_best_then_unique(spark: SparkSession, d: str) -> DataFrame:
    """Each left base gives its best edge; on the right the best of those stays."""
    best = _base_scores(spark, d).groupBy("a_id").agg(F.min(F.struct((-F.col("score")).alias("s"), "b_title", "b_id")).alias("m"))
    return best.groupBy(F.col("m.b_id").alias("b_id")).agg(F.min(F.struct("m.s", "a_id")).alias("k")).select("b_id", "k.a_id", (-F.col("k.s")).alias("score"))


INVERSE_THRESHOLD = 0.4
_INVERSE = f"with {Q.OWN}, {Q.PROFILE}, {Q.REPS}, {Q.SUMMARY}, {Q.INVERSE}"


def _inverse_scores(spark: SparkSession, d: str) -> DataFrame:
    f = stored(base_match.inverse_features(products.named_bases(table(spark, d, "product"))))
    return base_match.inverse_candidates(f.where(F.col("distributor").isin(*LEFT)), f.where(F.col("distributor").isin(*RIGHT)), INVERSE_THRESHOLD)


@query(f"{_INVERSE} select a_id, b_id, score from inv")
def q_inverse_score(spark: SparkSession, d: str) -> DataFrame:
    """Candidates of the inverse audit with their score.

    Over .4 here: the addresses of the test tables share few words, so nothing reaches the usual .88.
    """
    return _inverse_scores(spark, d).select("a_id", "b_id", "score")


@query(
    f"{_INVERSE}, r as (select *, row_number() over (partition by a_id order by score desc, b_title, b_id) as n from inv) select a_id, max(b_id) filter (n = 1) as best, max(score) filter (n = 1) as best_score, coalesce(string_agg(b_id || ':' || printf('%.2f', score), '|' order by n) filter (n between 2 and 6), '') as alternatives from r group by 1"
)
def q_inverse_best(spark: SparkSession, d: str) -> DataFrame:
    return assign.best_and_alternatives(_inverse_scores(spark, d), "a_id", "b_id", "score", "b_title")

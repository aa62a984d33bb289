"""Base products, blocking, joins, merges, ledger and master of a two-sided catalogue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import text as T


def base_groups(rows: DataFrame, keys: Sequence[str], price: str) -> DataFrame:
    """One base row per key: rows, least and largest price; prices that are no number do not count."""
    p = F.when(~F.isnan(F.col(price)), F.col(price))
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("variant_count"), F.min(p).alias("min_price"), F.max(p).alias("max_price"))


def variant_summary(rows: DataFrame, group: str, variants: str) -> DataFrame:
    """Per group and dimension the number of distinct values and the values, sorted."""
    flat = rows.select(group, F.explode(variants).alias("k", "v")).where("v is not null")
    return (
        flat.groupBy(group, T.variant_name(F.col("k")).alias("dimension"))
        .agg(F.array_sort(F.collect_set(T.plain(F.col("v")))).alias("s"))
        .select(group, "dimension", F.size("s").alias("value_count"), F.array_join("s", " | ").alias("value_list"))
    )


def alias_keys(rows: DataFrame, brand: str, kind: str, aliases: DataFrame) -> DataFrame:
    """Every row under its own brand key and the targets of the directional, type-bound aliases.

    aliases(source_brand, target_brand, product_type) is a rule table of fixed size.
    """
    own = rows.withColumn("brand_key", T.compact(F.col(brand)))
    extra = own.join(
        F.broadcast(aliases.select(T.compact(F.col("source_brand")).alias("brand_key"), T.compact(F.col("target_brand")).alias("_t"), F.col("product_type").alias("_k"))), "brand_key"
    ).where(F.col("_k").isNull() | (F.col("_k") == F.col(kind)))
    return own.unionByName(extra.withColumn("brand_key", F.col("_t")).drop("_t", "_k"))


def block_pairs(a: DataFrame, b: DataFrame, keys: Sequence[str], a_id: str, b_id: str) -> DataFrame:
    """Distinct pairs of the two sides that share a block key; equi-joined, so AQE may split hot blocks."""
    return a.join(b, list(keys)).dropDuplicates([a_id, b_id])


def unmatched(rows: DataFrame, covered: DataFrame, key: str) -> DataFrame:
    """Rows whose key no dataset covers."""
    return rows.join(covered.select(key).distinct(), key, "left_anti")


def fill_from_group(rows: DataFrame, group: str, columns: Sequence[str], order: str) -> DataFrame:
    """Blank columns filled from the first row of the group that has them."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.select(*[F.coalesce(T.blank_to_null(F.col(c)), F.first(T.blank_to_null(F.col(c)), ignorenulls=True).over(w)).alias(c) if c in columns else F.col(c) for c in rows.columns])


def rank_merge(datasets: DataFrame, key: str, rank: Column, order: str) -> DataFrame:
    """Per key the rows of the highest rank; among datasets of that rank the first by order."""
    w = Window.partitionBy(key)
    best = datasets.withColumn("_rank", rank).withColumn("_best", F.max("_rank").over(w)).where("_rank = _best")
    return best.withColumn("_n", F.row_number().over(w.orderBy(order))).where("_n = 1").drop("_rank", "_best", "_n")


def with_fallback(main: DataFrame, fallback: DataFrame, key: str, order: str) -> DataFrame:
    """main, and of fallback the first row of each key that main lacks."""
    first = fallback.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_n = 1").drop("_n")
    return main.unionByName(first.join(main.select(key).distinct(), key, "left_anti"))


def bijection_report(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Counts of keys missing on either side, repeated or matched one to one."""
    a = left.groupBy(key).agg(F.count(F.lit(1)).alias("n_left"))
    b = right.groupBy(key).agg(F.count(F.lit(1)).alias("n_right"))
    kind = (
        F.when(F.col("n_right").isNull(), "missing")
        .when(F.col("n_left").isNull(), "unknown")
        .when((F.col("n_left") > 1) | (F.col("n_right") > 1), "duplicate")
        .otherwise("matched")
    )
    return a.join(b, key, "full_outer").groupBy(kind.alias("outcome")).agg(F.count(F.lit(1)).alias("keys"))


def resolve_in_tiers(wanted: DataFrame, rows: DataFrame, want_id: str, row_id: str, tiers: Sequence[str]) -> DataFrame:
    """Each wanted row resolved by the first tier key that exactly one row has; tier 0 means none."""
    out = wanted
    for i, key in enumerate(tiers, 1):
        unique = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_c"), F.min(row_id).alias(f"_t{i}")).where("_c = 1").drop("_c")
        met = out.where(F.col(key).isNotNull()).join(unique, key, "left")
        out = met.unionByName(out.where(F.col(key).isNull()).withColumn(f"_t{i}", F.lit(None).cast(dict(rows.dtypes)[row_id])))
    tier = None
    for i in range(1, len(tiers) + 1):
        hit = F.col(f"_t{i}").isNotNull()
        tier = F.when(hit, F.lit(i)) if tier is None else tier.when(hit, F.lit(i))
    return out.select(want_id, tier.otherwise(0).alias("tier"), F.coalesce(*[F.col(f"_t{i}") for i in range(1, len(tiers) + 1)]).alias("resolved"))


def three_way(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """The master of two keyed sides: both, a_only or b_only, with the count of each side."""
    x, y = a.groupBy(key).agg(F.count(F.lit(1)).alias("a_rows")), b.groupBy(key).agg(F.count(F.lit(1)).alias("b_rows"))
    side = F.when(F.col("b_rows").isNull(), "a_only").when(F.col("a_rows").isNull(), "b_only").otherwise("both")
    return x.join(y, key, "full_outer").select(key, side.alias("side"), F.coalesce("a_rows", F.lit(0)).alias("a_rows"), F.coalesce("b_rows", F.lit(0)).alias("b_rows"))


def _sole_codes(codes: DataFrame) -> DataFrame:
    """_c of the codes that exactly one row has; nulls are grouped with nothing."""
    return codes.where("_c is not null").groupBy("_c").agg(F.count(F.lit(1)).alias("_n")).where("_n = 1").select("_c", F.lit(True).alias("_sole"))


def unique_codes(rows: DataFrame, row_id: str, code: str, longest: int = 120) -> DataFrame:
    """The code where one row has it, else the code with eight digits of a hash of code and id; null stays null."""
    coded = rows.select(row_id, F.col(code).alias("_c"))
    filled = coded.where("_c is not null").join(_sole_codes(coded), "_c", "left")
    suffix = F.substring(F.sha2(F.concat_ws("|", "_c", F.col(row_id).cast("string")), 256), 1, 8)
    own = F.when(F.col("_sole"), F.col("_c")).otherwise(F.concat(F.substring("_c", 1, longest - 9), F.lit("-"), suffix))
    return filled.select(row_id, own.alias("unique_code")).unionByName(coded.where("_c is null").select(row_id, F.col("_c").alias("unique_code")))


def unique_or_null(rows: DataFrame, row_id: str, code: Column) -> DataFrame:
    """The code where exactly one row has it, else null."""
    coded = rows.select(row_id, code.alias("_c"))
    filled = coded.where("_c is not null").join(_sole_codes(coded), "_c", "left")
    return filled.select(row_id, F.when(F.col("_sole"), F.col("_c")).alias("unique_code")).unionByName(coded.where("_c is null").select(row_id, F.col("_c").alias("unique_code")))


def sole_value(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Per key the number of its distinct values and the value where there is exactly one."""
    g = rows.groupBy(key).agg(F.countDistinct(value).alias("distinct_values"), F.min(value).alias("_v"))
    return g.select(key, "distinct_values", F.when(F.col("distinct_values") == 1, F.col("_v")).alias("sole_value"), F.when(F.col("distinct_values") == 1, "unique").when(F.col("distinct_values") > 1, "conflict").otherwise("none").alias("outcome"))


def ambiguous(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups of rows that share all keys, largest first by count."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def numbered_names(rows: DataFrame, name: str, id_col: str) -> DataFrame:
    """name, id: one number per distinct name in their order. The names are those of the sides of a catalogue, so few."""
    return rows.select(name).where(F.col(name).isNotNull()).distinct().withColumn(id_col, F.row_number().over(Window.orderBy(name)).cast("bigint"))


def upserted(current: DataFrame, incoming: DataFrame, key: str, columns: Sequence[str], order: str) -> DataFrame:
    """Full state after merging: of repeated incoming keys the first wins, its filled columns
    replace, missing ones keep; rows absent from incoming stay as they are."""
    first = incoming.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_n = 1")
    new = first.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_in"))
    out = current.select(key, *columns, F.lit(True).alias("_cur")).join(new, key, "full_outer")
    action = F.when(F.col("_cur").isNull(), "insert").when(F.col("_in").isNull(), "keep").otherwise("update")
    return out.select(key, *[F.coalesce(f"_new_{c}", c).alias(c) for c in columns], action.alias("action"))


def merge_survivors(members: DataFrame, group: str, member: str, dependents: DataFrame) -> DataFrame:
    """Per group the id that survives a merge: the only one with dependents, else the lowest.

    Two or more with dependents are not merged (survivor null).
    """
    deps = dependents.groupBy(member).agg(F.count(F.lit(1)).alias("_d"))
    g = members.join(deps, member, "left").groupBy(group).agg(
        F.count(F.lit(1)).alias("members"), F.count_if(F.col("_d") > 0).alias("referenced"), F.min(F.when(F.col("_d") > 0, F.col(member))).alias("_r"), F.min(member).alias("_m")
    )
    return g.select(group, "members", "referenced", F.when(F.col("referenced") == 1, F.col("_r")).when(F.col("referenced") == 0, F.col("_m")).alias("survivor"))


def expanded(rows: DataFrame, row_id: str, dims: Column) -> DataFrame:
    """The cartesian product of dimension -> values as one row per combination (sorted `k=v` parts)."""
    combos = F.aggregate(
        F.array_sort(F.map_entries(dims)),
        F.array(F.array().cast("array<string>")),
        lambda acc, e: F.flatten(F.transform(acc, lambda done: F.transform(e["value"], lambda v: F.concat(done, F.array(F.concat(e["key"], F.lit("="), v)))))),
    )
    return rows.select(row_id, F.posexplode(combos).alias("_p", "_c")).select(row_id, F.array_join("_c", ";").alias("combination"))


def tfidf(docs: DataFrame, doc: str, tokens: str) -> DataFrame:
    """doc, token, df, weight = tf * ln(N / df), norm of the doc's vector. df and N count all documents."""
    flat = docs.select(doc, F.explode(tokens).alias("token"))
    tf = flat.groupBy(doc, "token").agg(F.count(F.lit(1)).alias("tf"))
    df = tf.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    n = docs.select(doc).distinct().agg(F.count(F.lit(1)).alias("n"))
    weighted = tf.join(df, "token").join(F.broadcast(n)).withColumn("weight", F.col("tf") * F.ln(F.col("n") / F.col("df"))).drop("n", "tf")
    return weighted.withColumn("norm", F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(doc))))


def contract_findings(rows: DataFrame, required: Sequence[str], wanted: Sequence[str]) -> DataFrame:
    """Counts per finding: blank required fields are errors, blank wanted ones warnings."""
    checks = [(c, "error") for c in required] + [(c, "warning") for c in wanted]
    types = dict(rows.dtypes)

    def blank(c: str) -> Column:
        if types[c].startswith(("array", "map")):
            return F.coalesce(F.size(c), F.lit(0)) <= 0
        return T.blank_to_null(F.col(c).cast("string")).isNull()

    counts = rows.agg(*[F.count_if(blank(c)).alias(c) for c, _ in checks])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.lit(level).alias("level"), F.col(c).alias("rows")) for c, level in checks])))

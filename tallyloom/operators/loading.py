"""From matched variants to a master and its load: guard, resolution, unique codes, links, merges, checkpoints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import text as T
from tallyloom.operators.assign import greedy_one_to_one
from tallyloom.operators.products import some

# Words that identify no product.
IDENTITY_STOP = (
    "a and aroma bote botella capacidad coil con de del e el en edition for la las los ml mg nic nicotine ohm pack para pcs pod replacement resistencia salt salts the unidades uds y"
).split()


def identity_words(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(T.plain(F.coalesce(c, F.lit(""))), "[^a-z0-9]+"), lambda w: (F.length(w) > 1) & ~w.isin(*IDENTITY_STOP)))


def url_title_identity(url: Column, title: Column) -> Column:
    """Share of the title's words that the address holds as well."""
    words = identity_words(title)
    return F.when(F.size(words) > 0, F.size(F.array_intersect(words, identity_words(F.substring_index(url, "#", 1)))) / F.size(words)).otherwise(0.0)


def master_guard(edges: DataFrame, a: str, b: str, priority: Sequence[str], pair: str) -> DataFrame:
    """edges with accepted and conflict_side: one-to-one by sequential greedy over the priority (all
    descending), then the pair key. A rejected edge names the side that a better accepted one has taken."""
    order = [*[(c, True) for c in priority], (pair, False)]
    rank = F.struct(*[(-F.col(c) if down else F.col(c)).alias(f"k{i}") for i, (c, down) in enumerate(order)])
    won = greedy_one_to_one(edges, a, b, order).select(a, b, pair, rank.alias("_o"))
    out = edges.withColumn("_e", rank)
    for end, name in ((a, "_wa"), (b, "_wb")):
        out = out.join(won.select(F.col(end), F.col("_o").alias(name), *([F.col(pair).alias("_won")] if end == a else [])), end, "left")
    accepted = F.coalesce(F.col("_won") == F.col(pair), F.lit(False))
    on_a, on_b = F.coalesce(F.col("_wa") < F.col("_e"), F.lit(False)), F.coalesce(F.col("_wb") < F.col("_e"), F.lit(False))
    side = F.when(accepted, F.lit(None).cast("string")).when(on_a & on_b, "both").when(on_a, "a").when(on_b, "b")
    return out.withColumns({"accepted": accepted, "conflict_side": side}).select(*edges.columns, "accepted", "conflict_side")


def unique_skus(rows: DataFrame, key: str, wanted: Column, longest: int = 120) -> DataFrame:
    """key, sku: the wanted code where one row has it and it fits, else its head with twelve digits of the key's hash."""
    base = rows.select(key, F.coalesce(wanted, F.col(key)).alias("_w"))
    shared = base.groupBy("_w").agg(F.count(F.lit(1)).alias("_n"))
    suffix = F.substring(F.sha2(F.col(key), 256), 1, 12)
    fits = (F.col("_n") == 1) & (F.length("_w") <= longest)
    return base.join(shared, "_w").select(key, F.when(fits, F.col("_w")).otherwise(F.concat(F.substring("_w", 1, longest - 13), F.lit("-"), suffix)).alias("sku"))


def number_in(c: Column) -> Column:
    """The first number of a text, a comma as the decimal mark."""
    return F.nullif(F.regexp_extract(F.replace(F.lower(F.coalesce(c, F.lit(""))), F.lit(","), F.lit(".")), r"(\d+(?:\.\d+)?)", 1), F.lit("")).try_cast("double")


def cut(c: Column, longest: int) -> Column:
    """Trimmed, null where blank, cut to the column's width."""
    return F.substring(some(T.trimmed(c)), 1, longest)


def safe_merges(references: DataFrame, links: DataFrame, dependents: DataFrame, dedupe: bool) -> DataFrame:
    """What becomes of each group of references that state one product.

    references(group, reference_id), links(link_id, reference_id, distributor, variant, url),
    dependents(reference_id), one row each. A group is merged into its only reference with
    dependents, else its lowest, unless two have dependents or two links of the group share
    distributor and variant; with dedupe such links may differ in nothing but the id, and all but
    one (the survivor's lowest, else the lowest) are deleted. Groups of one reference give no row.
    """
    deps = dependents.where("reference_id is not null").groupBy("reference_id").agg(F.count(F.lit(1)).alias("_d"))
    members = references.join(deps, "reference_id", "left")
    groups = members.groupBy("group").agg(
        F.count(F.lit(1)).alias("members"), F.count_if(F.col("_d") > 0).alias("referenced"), F.min(F.when(F.col("_d") > 0, F.col("reference_id"))).alias("_r"), F.min("reference_id").alias("_m")
    ).where("members > 1")
    groups = groups.withColumn("survivor", F.when(F.col("referenced") == 1, F.col("_r")).when(F.col("referenced") == 0, F.col("_m")))
    of_group = links.join(references, "reference_id").join(groups.select("group", "survivor"), "group")
    per_slot = of_group.groupBy("group", "distributor", "variant").agg(F.count(F.lit(1)).alias("n"), F.min("url").alias("u"), F.max("url").alias("v"), F.count("url").alias("k"))
    same = (F.col("u") == F.col("v")) & (F.col("k") == F.col("n")) | (F.col("k") == 0)
    slots = per_slot.groupBy("group").agg(
        F.sum("n").alias("links"), F.count_if(F.col("n") > 1).alias("collisions"), F.count_if((F.col("n") > 1) & ~same).alias("differing"), F.sum(F.col("n") - 1).alias("redundant")
    )
    g = groups.join(slots, "group", "left").na.fill(0, ["links", "collisions", "differing", "redundant"])
    collides = (F.col("collisions") > 0) & (F.lit(not dedupe) | (F.col("differing") > 0))
    reason = F.when(F.col("referenced") > 1, "multiple_references_have_business_dependencies").when(collides, "distributor_variant_collision")
    return g.select(
        "group", "members", "referenced", F.when(reason.isNull(), F.col("survivor")).alias("survivor"), reason.isNull().alias("merged"), reason.alias("reason"), "links", F.when(reason.isNull(), F.col("redundant")).otherwise(0).alias("deleted")
    )


def batches(rows: DataFrame, group: str, order: str, content: Sequence[str], size: int, settings: str) -> DataFrame:
    """group, batch, rows, key: fixed-size batches within a group and the hash of what a reviewer is sent.

    The key is the SHA-256 of the settings and the rows in order, so it changes with the content,
    the model and the effort and with nothing else.
    """
    numbered = rows.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1) / size).cast("bigint"))
    line = F.concat_ws("|", F.col(order).cast("string"), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in content])
    held = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("t")))), lambda x: x["t"])
    return numbered.groupBy(group, "batch").agg(F.count(F.lit(1)).alias("rows"), F.sha2(F.concat(F.lit(settings + "\n"), F.array_join(held, "\n")), 256).alias("key"))


def checkpoint_plan(wanted: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """wanted with action: `reuse` where the stored batch has the same key, `rerun` where another, `run` where there is none."""
    old = stored.select(*keys, F.col("key").alias("_old"))
    action = F.when(F.col("_old").isNull(), "run").when(F.col("_old") == F.col("key"), "reuse").otherwise("rerun")
    return wanted.join(old, list(keys), "left").withColumn("action", action).drop("_old")


def review_report(truth: DataFrame, predicted: DataFrame, key: str) -> DataFrame:
    """truth(key, verdict) against predicted(key, verdict): counts of passed, failed, missing and unexpected per true verdict."""
    both = truth.select(key, F.col("verdict").alias("t")).join(predicted.select(key, F.col("verdict").alias("p")), key, "full_outer")
    return both.groupBy(F.coalesce("t", F.lit("none")).alias("verdict")).agg(
        F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("t") == F.col("p")).alias("passed"), F.count_if(F.col("t") != F.col("p")).alias("failed"),
        F.count_if(F.col("t").isNotNull() & F.col("p").isNull()).alias("missing"), F.count_if(F.col("t").isNull()).alias("unexpected"),
    )

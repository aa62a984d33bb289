"""Base products of two sides matched inside their blocks of brand and type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import hardware as H
from tallyloom.functions import similarity as S
from tallyloom.functions import text as T
from tallyloom.functions.binding import let
from tallyloom.operators import near
from tallyloom.operators.products import some
from tallyloom.session import bounded, stored


# What a base's whole text is made of, in order.
PRIMARY = ["title", "brand_candidates", "commercial_brand", "product_line", "breadcrumb_path", "reference", "synthetic_reference", "base_key", "url", "variant_values"]


def block_types(kind: Column, text: Column, ref: Column) -> Column:
    """The block types a base row belongs to: its own, `coil` where it reads like one, neither a pod that
    is a coil nor an aroma that is a nicotine base."""
    starts = ref.rlike(r"^r[-.\s]") | text.rlike(r"^\s*resistencias?\b")
    named = text.rlike(r"\bcoils?\b")
    pod = text.rlike(r"\bpod\b") & text.rlike(r"\b(?:replacement|recambio|cartucho|cartridge)\b") & ~named & ~starts
    coil = starts | named | ((kind == "coil") & ~pod)
    base = text.rlike(r"\b(?:nicokit|niko|nicotina|nicotine|base\s*(?:pack|glicerina|pdo|propilenglicol)|glicerina|propilenglicol)\b")
    none = F.lit(None).cast("string")
    own = F.when(kind == "coil", none).when((kind == "pod_replacement") & starts, none).when((kind == "aroma_concentrate") & base, none).otherwise(kind)
    return F.filter(F.array(F.when(coil, F.lit("coil")), own), lambda x: x.isNotNull())


def base_features(bases: DataFrame) -> DataFrame:
    """id (with the brand, which tells bases of one key and url apart), distributor, title, block, keys (its brands), f: a base row once per block type.

    The texts are columns of their own, so each is normalised once.
    """
    filled = lambda *ks: [some(F.col(k)) for k in ks]
    first = lambda *ks: F.coalesce(*[T.blank_to_null(F.col(k)) for k in ks])
    texts = bases.select(
        F.concat_ws("|", "id", "brand").alias("id"), "distributor", "title", "product_type",
        T.numbered(F.concat_ws(" ", *filled(*PRIMARY))).alias("primary"),
        T.numbered(F.concat_ws(" ", "title", *[T.blank_to_null(F.col(k)) for k in ("reference", "synthetic_reference", "url")])).alias("named"),
        F.filter(F.split(T.numbered(F.concat_ws(" ", "brand_candidates", "commercial_brand")), "[^a-z0-9]+"), lambda w: w != "").alias("brand_words"),
        T.numbered(F.coalesce(*filled("reference", "synthetic_reference", "base_key"), F.lit(""))).alias("ref_text"),
        first("reference", "synthetic_reference", "base_key").alias("ref"), first("base_key", "synthetic_reference", "reference").alias("key"),
        F.array_distinct(F.filter(F.transform(F.split("brand_candidates", r" \| "), T.compact), lambda k: k != "")).alias("keys"),
    )
    rows = texts.withColumn("block", F.explode(block_types(F.col("product_type"), F.col("primary"), F.col("ref_text"))))
    features = H.features_of(F.col("primary"), F.col("named"), F.col("brand_words"), F.col("block"), F.col("ref"), F.col("key"))
    return rows.select("id", "distributor", "title", "block", "keys", features.alias("f"))


def _held_pairs(a: DataFrame, b: DataFrame, met: DataFrame) -> DataFrame:
    """The rows of both sides of the met ids as structs a and b; only rows that are met are shuffled."""

    def side(df: DataFrame, n: str) -> DataFrame:
        rows = df.select(F.xxhash64("id").alias(f"_{n}"), F.struct(*df.columns).alias(n))
        return rows.join(bounded(met.select(f"_{n}").distinct(), 500_000, "ids of pairs"), f"_{n}", "left_semi")

    return met.join(side(a, "a"), "_a").join(side(b, "b"), "_b")


def scored_bases(a: DataFrame, b: DataFrame, threshold: float = 0.72) -> DataFrame:
    """a_id, b_id, b_title, score of the base pairs of one block and brand at or over the threshold.

    A pair that is not ruled out has the subtype, versions and qualifiers in common; those of aromas that
    differ in a word score by equal references only. So pairs are met inside such groups and by what
    their words can still reach; together that loses none. Ids of one base are distinct rows of one block.
    """
    bound = near.Bound(least=threshold - 0.0000005, common=0.62, larger=0.28, always=0.13, bonuses=(0.03, 0.02), floor=0.68)

    def side(df: DataFrame) -> DataFrame:
        f = F.col("f")
        apart = F.array_sort(F.filter(f["tokens"], lambda w: w.rlike(r"^(?:v\d+[a-z]?|s\d+[a-z]?)$") | w.isin(*H.QUALIFIERS)))
        group = F.xxhash64("block", F.col("key"), f["subtype"], F.array_join(apart, " "), F.when(f["aroma"], f["salt"]))
        by = F.when(f["aroma"], F.xxhash64("_group", F.array_join(F.array_sort(f["tokens"]), " "))).otherwise(F.col("_group"))
        rows = df.select("id", "block", "f", F.explode("keys").alias("key")).withColumn("_group", group)
        return rows.select(
            F.xxhash64("id").alias("_id"), "_group", by.alias("_by"), near.coded(f["tokens"], H.HEAVY).alias("_words"), F.array().cast("array<bigint>").alias("_drop"),
            F.when(f["key"].isNotNull(), F.xxhash64(f["key"])).otherwise(F.lit(0)).alias("_key"), near.bits([f["caps"], f["packs"]]).alias("_bits"), F.lit(0).alias("_kind"),
        )

    met = stored(near.near_pairs(side(a), side(b), bound))
    full = _held_pairs(a, b, met).where((F.col("a.block") == F.col("b.block")) & F.arrays_overlap("a.keys", "b.keys"))
    scored = full.select(F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"), F.col("b.title").alias("b_title"), F.round(H.product_pair_score(F.col("a.f"), F.col("b.f")), 6).alias("score"))
    return scored.groupBy("a_id", "b_id").agg(F.max("score").alias("score"), F.min("b_title").alias("b_title")).where(F.col("score") >= threshold)


# Words that name no product in the inverse audit, colours among them.
INVERSE_STOP = (
    "a al and aroma aromas base bar bote by capacidad cartucho cartridge coil coils com con de del deposito eciglogistica edition el empty en es fill for full glass html http https incluida incluido juice kit la "
    "las limited liquid liquids longfill los mesh meshed ml new nic nicokit no nuevo nueva ohm ohmios pack packs para pc pcs pod pods pyrex recambio replacement repuesto resistencia resistencias salt salts serie "
    "series sin tank updated vaperalia version vpm vacio vacia with y black blue brown gold gray grey green orange pink purple rainbow red silver violet white yellow"
).split()
INVERSE_TEXT = ["title", "brand_candidates", "commercial_brand", "reference", "synthetic_reference", "base_key", "url"]


def inverse_features(bases: DataFrame) -> DataFrame:
    """id, distributor, title, keys (brands), f: what the inverse score reads of a base."""
    rows = bases.select(
        F.concat_ws("|", "id", "brand").alias("id"), "distributor", "title", F.col("product_type").alias("kind"),
        T.numbered(F.concat_ws(" ", *[some(F.col(k)) for k in INVERSE_TEXT])).alias("text"),
        F.filter(F.split(T.numbered(F.concat_ws(" ", "brand_candidates", "commercial_brand")), "[^a-z0-9]+"), lambda w: w != "").alias("brand_words"),
        F.array_distinct(F.filter(F.transform(F.split("brand_candidates", r" \| "), T.compact), lambda k: k != "")).alias("keys"), T.compact(F.col("base_key")).alias("key"),
    )
    f = F.struct(
        H.model_words(F.col("text"), F.col("brand_words"), F.col("kind"), INVERSE_STOP).alias("tokens"), "brand_words", "kind", S.type_group(F.col("kind")).alias("group"), some(F.col("key")).alias("key"),
        H.numbers_in(F.col("text"), r"(\d+(?:[.,]\d+)?)\s*ml").alias("ml"), H.numbers_in(F.col("text"), r"(\d+(?:[.,]\d+)?)\s*ohm").alias("ohm"),
        F.array_distinct(F.flatten(F.array(*[H.numbers_in(F.col("text"), p) for p in H.PACKS]))).alias("packs"), F.col("title").rlike(r"(?i)\b(?:promo|promopack|2x1)\b").alias("promo"),
    )
    return rows.select("id", "distributor", "title", "keys", f.alias("f"))


def inverse_score(a: Column, b: Column) -> Column:
    """Rounded score of two bases of one brand; 0 for a pair that is ruled out, 1 for equal base keys."""
    pair = F.struct(
        F.filter(a["tokens"], lambda w: ~F.array_contains(b["brand_words"], w)).alias("x"), F.filter(b["tokens"], lambda w: ~F.array_contains(a["brand_words"], w)).alias("y")
    )

    def scored(t: Column) -> Column:
        common = F.array_intersect(t["x"], t["y"])
        extra = (F.size(F.array_except(t["x"], t["y"])) > 0) | (F.size(F.array_except(t["y"], t["x"])) > 0)
        aroma = (a["kind"] == "aroma_concentrate") | (b["kind"] == "aroma_concentrate")
        w = H.word_weight
        value = (
            0.62 * w(common) / w(F.array_union(t["x"], t["y"])) + 0.3 * F.greatest(w(common) / w(t["x"]), w(common) / w(t["y"])) + F.when(a["kind"] == b["kind"], 0.08).otherwise(0.0)
            + F.when(F.arrays_overlap(a["ml"], b["ml"]), 0.03).otherwise(0.0) + F.when(F.arrays_overlap(a["ohm"], b["ohm"]), 0.03).otherwise(0.0) + F.when(F.arrays_overlap(a["packs"], b["packs"]), 0.02).otherwise(0.0)
        )
        none = ~F.exists(common, lambda x: (F.length(x) >= 3) | x.rlike("[0-9]")) | ((a["group"] == "liquidos") & (F.size(common) < 2)) | (aroma & extra)
        return F.when(none, 0.0).otherwise(F.least(F.lit(1.0), S.js_round(value)))

    ruled_out = (a["promo"] != b["promo"]) | ((a["group"] != b["group"]) & (a["kind"] != b["kind"]))
    unequal = S.sets_conflict(a["ml"], b["ml"]) | S.sets_conflict(a["ohm"], b["ohm"]) | S.sets_conflict(a["packs"], b["packs"])
    return F.when(ruled_out, 0.0).when(F.coalesce(a["key"] == b["key"], F.lit(False)), 1.0).when(unequal, 0.0).otherwise(let(pair, scored))


def inverse_candidates(a: DataFrame, b: DataFrame, threshold: float = 0.88) -> DataFrame:
    """a_id, b_id, b_title, score of the pairs of one brand (or both without) over the threshold.

    Met inside brand and type group by the base key and by what their words can still reach; a word that
    is a brand word of some row there may be dropped from the other side, so it adds nothing to the least weight.
    """

    bound = near.Bound(least=threshold - 0.005, common=0.62, larger=0.3, always=0.0, bonuses=(0.03, 0.03, 0.02), alike=0.08)
    brands = F.when(F.size("keys") > 0, F.col("keys")).otherwise(F.array(F.lit("")))

    def side(df: DataFrame) -> DataFrame:
        f = F.col("f")
        bits = near.bits([f["ml"], f["ohm"], f["packs"]], whole=f["kind"] == "aroma_concentrate", two=f["group"] == "liquidos")
        return df.select("id", "f", F.explode(brands).alias("brand")).withColumn("_group", F.xxhash64("brand", f["group"])).select(
            F.xxhash64("id").alias("_id"), "_group", F.col("_group").alias("_by"), near.coded(f["tokens"], H.HEAVY).alias("_words"), near.coded(F.array_distinct(f["brand_words"]), H.HEAVY).alias("_drop"),
            F.when(f["key"].isNotNull(), F.xxhash64(f["key"])).otherwise(F.lit(0)).alias("_key"), bits.alias("_bits"), F.xxhash64(f["kind"]).alias("_kind"),
        )

    full = _held_pairs(a, b, stored(near.near_pairs(side(a), side(b), bound)))
    one_brand = F.arrays_overlap("a.keys", "b.keys") | ((F.size("a.keys") == 0) & (F.size("b.keys") == 0))
    scored = full.where(one_brand).select(F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"), F.col("b.title").alias("b_title"), inverse_score(F.col("a.f"), F.col("b.f")).alias("score"))
    return scored.where(F.col("score") >= threshold)

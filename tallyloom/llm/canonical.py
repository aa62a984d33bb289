"""Free-typed values mapped to a canonical list by a prefix-filtered set-similarity join."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.unify import folded_col
from tallyloom.session import checkpointed, lookup_join, salted_lookup

# Words round a brand that are not part of it, and digits typed for letters.
LEGAL = r"(?:s ?l ?u?|s ?a ?s?|ltda?|lda|gmbh|inc|llc|bv|srl|technology co|co)"
BEFORE = r"(?:by|de la marca|marca|fabricante|brand|de)"
AFTER = r"(?:oficial|official|vape|espana|spain|iberia|sales|store|shop)"
LOOK_DIGITS = ("01345", "oieas")
#: Spellings of fewer letters must be met exactly.
SHORTEST_WITH_ERROR = 5
#: The canonical list is broadcast up to this many token rows; a longer one is joined by salted keys.
MAX_BROADCAST = 500_000


def key_of(text: Column) -> Column:
    """Folded text as plain words: signs apart, digits inside a word read as letters, affixes off."""
    t = F.regexp_replace(F.regexp_replace(text, r"[®™©]|\btm\b", " "), r"(?<=\w)[.'’](?=\w)", "")
    t = F.regexp_replace(t, r"\((?:oficial|official)\)", " ")
    t = F.trim(F.regexp_replace(t, r"[^\p{L}\p{N}&]+", " "))
    words = F.transform(F.split(t, " "), lambda w: F.when(w.rlike(r"\p{L}"), F.translate(w, *LOOK_DIGITS)).otherwise(w))
    t = F.array_join(words, " ")
    t = F.regexp_replace(t, rf"^(?:{BEFORE} )+(?=\S{{3}})", "")
    t = F.regexp_replace(t, rf"(?<=\S)(?: {AFTER})+$", "")
    return F.regexp_replace(t, rf"(?<=\S{{3}}) {LEGAL}$", "")


def token_set(compact: str) -> list[str]:
    """Letters and letter pairs, repeats numbered, so that a set stands for the multiset; turned forms keep their mark."""
    mark = "~" if compact.startswith("~") else ""
    compact = compact.removeprefix("~")
    seen: dict[str, int] = {}
    out = []
    for x in [*compact, *(compact[i : i + 2] for i in range(len(compact) - 1))]:
        seen[x] = seen.get(x, 0) + 1
        out.append(f"{mark}{x}#{seen[x]}")
    return out


def one_error(a: str, b: str) -> int:
    """0 for equal strings, 1 where one typing error leads from a to b, 2 otherwise."""
    if a == b:
        return 0
    n, m = len(a), len(b)
    if abs(n - m) > 1:
        return 2
    i = 0
    while i < min(n, m) and a[i] == b[i]:
        i += 1
    if n == m:
        if a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :]):
            return 1
        return 2
    return 1 if (a[i + 1 :] == b[i:] if n > m else a[i:] == b[i + 1 :]) else 2


@F.pandas_udf(T.ArrayType(T.StringType()))
def tokens_of(forms: pd.Series) -> pd.Series:
    return forms.map(token_set)


@F.pandas_udf(T.IntegerType())
def typing_errors(keys: pd.Series, forms: pd.Series) -> pd.Series:
    return pd.Series([one_error(k, f) for k, f in zip(keys, forms)])


def least_jaccard(letters: Column) -> Column:
    """The Jaccard similarity that one typing error leaves to a spelling of so many letters, at least.

    A replaced letter or two swapped neighbours leave 2n - 4 of the 2n - 1 letters and pairs on
    either side; a letter too many or too few leaves more.
    """
    return F.when(letters < SHORTEST_WITH_ERROR, 1.0).otherwise((2 * letters - 4) / (2 * letters + 2))


def similar_pairs(left: DataFrame, right: DataFrame, threshold: float | None = None) -> DataFrame:
    """left_id, right_id, jaccard of every pair of token sets at or over the threshold.

    left(id, tokens), right(id, tokens) with distinct tokens; without a threshold both have a
    column `least`, and a pair must reach that of either side. Tokens are ordered by their global
    rarity; two sets can reach a threshold only if their prefixes of
    size - ceil(threshold * size) + 1 share a token, so only prefixes are joined. A pair is
    dropped early when its sizes differ too much or when, at the position of a shared prefix
    token, the tokens left on either side cannot make up the overlap; the Jaccard of the rest
    is computed from the whole sets. Empty sets pair with nothing.
    """
    if threshold is not None:
        left, right = (x.withColumn("least", F.lit(float(threshold))) for x in (left, right))
    both = left.select(F.explode("tokens").alias("t")).unionAll(right.select(F.explode("tokens").alias("t")))
    counted = both.groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    # an ordinal that grows with the frequency: unique by the token's own hash in the low bits
    rank = F.shiftleft(F.least("df", F.lit(2**31 - 1)).cast("bigint"), 32) + F.pmod(F.xxhash64("t"), F.lit(2**32))
    rarity = counted.select("t", rank.alias("k"))
    # as many partitions as cores at least: what follows multiplies the rows
    parts = max(left.sparkSession.sparkContext.defaultParallelism, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def ordered(side: DataFrame) -> DataFrame:
        """id, least and the sorted ordinals of its tokens, rarest first."""
        sets = side.select("id", "least", F.explode("tokens").alias("t")).join(rarity, "t").groupBy("id", "least").agg(F.array_sort(F.collect_list("k")).alias("ts"))
        return checkpointed(sets.repartition(parts, "id"))

    left, right = ordered(left), ordered(right)

    def prefixed(side: DataFrame, name: str) -> DataFrame:
        n = F.size("ts")
        return side.select(
            F.col("id").alias(f"{name}_id"),
            n.alias(f"{name}_n"),
            F.col("least").alias(f"{name}_least"),
            F.posexplode(F.slice("ts", F.lit(1), (n - F.ceil(n * F.col("least") - 1e-9) + 1).cast("int"))).alias(f"{name}_pos", "t"),
        )

    a, b = prefixed(left, "left"), prefixed(right, "right")
    least = F.greatest("left_least", "right_least")
    need = F.ceil(least / (1 + least) * (F.col("left_n") + F.col("right_n")) - 1e-9)
    room = F.least(F.col("left_n") - F.col("left_pos"), F.col("right_n") - F.col("right_pos"))
    candidates = (
        lookup_join(a, b, ["t"], "left_id", MAX_BROADCAST)
        .where(
            (F.col("left_n") >= F.col("right_n") * least - 1e-9)
            & (F.col("right_n") >= F.col("left_n") * least - 1e-9)
            # the first shared prefix token has at most min(pos) shared tokens before it
            & (room + F.least("left_pos", "right_pos") >= need)
        )
        .select("left_id", "right_id")
        .distinct()
    )
    full = lookup_join(
        candidates.join(left.select(F.col("id").alias("left_id"), F.col("ts").alias("lt"), F.col("least").alias("ll")), "left_id"),
        right.select(F.col("id").alias("right_id"), F.col("ts").alias("rt"), F.col("least").alias("rl")), ["right_id"], "left_id", MAX_BROADCAST,
    )
    shared = F.size(F.array_intersect("lt", "rt"))
    return (
        full.withColumn("jaccard", shared / (F.size("lt") + F.size("rt") - shared))
        .where(F.col("jaccard") >= F.greatest("ll", "rl") - 1e-9)
        .select("left_id", "right_id", "jaccard")
    )


def _letters(key: Column) -> Column:
    return F.replace(key, F.lit(" "), F.lit(""))


def _turned(key: Column) -> Column:
    """The letters of a key with its words in alphabetical order, marked; null for a single word."""
    words = F.split(key, " ")
    return F.when(F.size(words) > 1, F.concat(F.lit("~"), F.array_join(F.array_sort(words), "")))


def spellings(reference: DataFrame, id_col: str, names: list[str]) -> DataFrame:
    """entry, form, kind, least: what each entry may be written as.

    Full names (kind 0, 1, ..), also with their words in alphabetical order (form marked ~);
    beginnings of a full name that reach past its first word (20) and first words (10), where
    only one entry has them. least is the Jaccard similarity a text must reach; a beginning must
    be met exactly.
    """
    full = reference.select(
        F.col(id_col).alias("entry"), F.explode(F.array(*[F.struct(F.lit(i).alias("kind"), folded_col(F.col(c)).alias("n")) for i, c in enumerate(names)])).alias("s")
    ).select("entry", key_of(F.col("s.n")).alias("key"), "s.kind")
    full = checkpointed(full.where("key is not null and key <> ''").groupBy("entry", "key").agg(F.min("kind").alias("kind")))
    natural = full.select("entry", _letters(F.col("key")).alias("form"), "kind")
    turned = full.select("entry", _turned(F.col("key")).alias("form"), "kind").where("form is not null")
    first = F.split("key", " ")[0]
    lone = full.where(F.length(first) >= 4).select("entry", first.alias("form"), F.lit(10).alias("kind"))
    beyond = F.sequence(F.length(first) + 2, F.length("key") - 1)
    begun = full.where(F.length("key") > F.length(first) + 2).select("entry", F.explode(F.transform(beyond, lambda n: F.substring(F.col("key"), F.lit(1), n))).alias("k")).select("entry", _letters(F.col("k")).alias("form"), F.lit(20).alias("kind"))
    sole = lone.unionByName(begun).distinct().withColumn("owners", F.count(F.lit(1)).over(Window.partitionBy("form", "kind"))).where("owners = 1").drop("owners")
    forms = natural.unionByName(turned).unionByName(sole).groupBy("entry", "form").agg(F.min("kind").alias("kind"))
    return forms.withColumn("least", F.when(F.col("kind") == 20, 1.0).otherwise(least_jaccard(F.length(F.ltrim(F.col("form"), F.lit("~"))))))


def map_to_canonical(texts: DataFrame, reference: DataFrame, id_col: str, names: list[str]) -> DataFrame:
    """texts(text) of distinct values -> text, id, jaccard, errors; id is null where none is meant.

    Candidates are the pairs of the set-similarity join of the distinct keys and the spellings,
    over letters and letter pairs, from the Jaccard similarity that one typing error leaves. An
    exact check then asks for at most one typing error (letter replaced, left out, doubled, added,
    or two neighbours swapped), none for spellings under five letters and for beginnings. The
    largest Jaccard wins, then the fuller kind of spelling and the smaller id, so ties are
    resolved alike on every run.
    """
    keyed = checkpointed(texts.select("text", folded_col(F.col("text")).alias("f")).select("text", key_of(F.col("f")).alias("key")))
    forms = checkpointed(spellings(reference, id_col, names))
    keys = keyed.select("key").where("key <> ''").distinct()
    written = checkpointed(
        keys.select("key", F.explode(F.filter(F.array(_letters(F.col("key")), _turned(F.col("key"))), lambda f: f.isNotNull())).alias("form"))
    )
    n = F.length(F.ltrim(F.col("form"), F.lit("~")))
    # the spelling met with an error has at least one letter less
    own = F.when(n < SHORTEST_WITH_ERROR - 1, 1.0).otherwise(least_jaccard(F.greatest(F.lit(SHORTEST_WITH_ERROR), n - 1)))
    left = written.select(F.col("form").alias("id"), own.alias("least")).distinct().withColumn("tokens", tokens_of("id"))
    right = forms.groupBy(F.col("form").alias("id")).agg(F.min("least").alias("least")).withColumn("tokens", tokens_of("id"))
    pairs = similar_pairs(checkpointed(left), checkpointed(right)).withColumn("errors", typing_errors("left_id", "right_id"))
    entries = forms.select(F.col("form").alias("right_id"), "entry", "kind", F.col("least").alias("l"))
    measured = lookup_join(pairs.where("errors < 2"), entries, ["right_id"], "left_id", MAX_BROADCAST).where("errors = 0 or l < 1")
    # two words in another order show the same letters turned
    met = measured.withColumnRenamed("left_id", "form").join(written, "form")
    w = Window.partitionBy("key").orderBy(F.desc("jaccard"), "kind", "entry")
    best = met.withColumn("r", F.row_number().over(w)).where("r = 1").select("key", F.col("entry").alias("id"), "jaccard", "errors")
    return keyed.join(best, "key", "left").select("text", "id", "jaccard", "errors")


def brand_texts(product: DataFrame) -> DataFrame:
    """row_id, field, pos, text of every brand text that is neither null nor blank."""
    singles = F.array(
        F.struct(F.lit("brand").alias("field"), F.lit(0).alias("pos"), F.col("brand").alias("text")),
        F.struct(F.lit("commercial_brand").alias("field"), F.lit(0).alias("pos"), F.col("commercial_brand").alias("text")),
    )
    many = F.transform(
        F.coalesce("brand_candidates", F.array().cast("array<string>")),
        lambda x, i: F.struct(F.lit("brand_candidates").alias("field"), i.alias("pos"), x.alias("text")),
    )
    return product.select("row_id", F.inline(F.concat(singles, many))).where(F.col("text").isNotNull() & F.col("text").rlike(r"[^\s\p{Z}]"))


def product_brands(product: DataFrame, brand_ref: DataFrame) -> DataFrame:
    """row_id, field, pos, text, brand_id (-1 where no listed brand is meant), jaccard, errors.

    Null and blank texts and elements give no row but elements keep their position; repeated
    rows give their rows again; an empty list of brands gives -1 throughout. Each distinct
    text is mapped once; a text that a third of the rows carry is joined back by salted keys.
    """
    rows = brand_texts(product)
    mapped = map_to_canonical(rows.select("text").distinct(), brand_ref.where("brand_id is not null"), "brand_id", ["brand_name", "legal_name"])
    out = salted_lookup(rows, mapped, ["text"], "row_id")
    return out.select("row_id", "field", "pos", "text", F.coalesce(F.col("id"), F.lit(-1)).cast("int").alias("brand_id"), "jaccard", "errors")

"""Listings of the same product grouped by seller-constrained assignment."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.listings import parse
from tallyloom.llm.unify import folded, folded_col
from tallyloom.operators.assign import components
from tallyloom.session import checkpointed, lookup_join, salted_lookup

#: A word of names is a brand word if the brand texts of so many of the rows that have it say it too.
BRAND_SHARE = 0.3
#: Rarity-weighted Jaccard of the model words from which two listings are compared.
SIMILAR = 0.8
#: The table of brand words is broadcast up to this many rows, and joined by salted keys beyond.
MAX_BROADCAST = 500_000
ATTRIBUTES = ("volume", "strength", "ohm", "colour", "brand")
_SIG = ["model", "edition", "volume", "strength", "ohm", "pack", "colour"]
_WORDS = re.compile(r"[a-z0-9&]+")


def _words(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit("[a-z0-9&]+"), F.lit(0)))


def brand_words(product: DataFrame, brand_ref: DataFrame) -> DataFrame:
    """word, generic: the words of the listed brands, and those that brand texts say of a row whose name has them.

    A word counts if at least two rows and BRAND_SHARE of the rows with it in the name have it in a
    brand text as well; a share, so the answer does not depend on the size of the table. generic
    says that several listed brands share the word. Null names and brand texts say nothing.
    """
    listed = (
        brand_ref.select(folded_col(F.col("brand_name")).alias("t")).where("t is not null").distinct()
        .select("t", F.explode(_words(F.col("t"))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("owners"))
    )
    # no brand text holds the separator, so one fold serves all of a row's texts
    texts = F.concat_ws(" | ", "brand", "commercial_brand", "brand_candidates")
    rows = product.select(_words(folded_col(F.col("name"))).alias("n"), _words(folded_col(texts)).alias("b")).where("n is not null")
    said = (
        rows.select(F.explode("n").alias("word"), "b").groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.array_contains("b", F.col("word"))).alias("k"))
        .where((F.col("k") >= 2) & (F.col("k") >= F.col("n") * BRAND_SHARE)).select("word")
    )
    return listed.join(said, "word", "full_outer").select("word", F.coalesce(F.col("owners") > 1, F.lit(False)).alias("generic"))


def with_brand_words(product: DataFrame, words: DataFrame) -> DataFrame:
    """product with _known, the brand words of its name, and _generic, those of several brands."""
    names = product.select("name").where("name is not null").distinct()
    flat = names.select("name", F.explode(_words(folded_col(F.col("name")))).alias("word"))
    found = lookup_join(flat, words, ["word"], "name", MAX_BROADCAST).groupBy("name").agg(
        F.collect_list("word").alias("_known"), F.collect_list(F.when(F.col("generic"), F.col("word"))).alias("_generic")
    )
    return salted_lookup(product, found, ["name"], "row_id")


def brand_word(texts: list[str], name: str | None, model: str, generic: frozenset[str] | set[str]) -> str | None:
    """The longest word of the brand texts that the name confirms and that no second brand shares."""
    in_name = set(_WORDS.findall(folded(name or ""))) - set(model.split()) - generic
    words = {w for t in texts for w in _WORDS.findall(folded(t)) if len(w) > 3}
    return max(words & in_name, key=lambda w: (len(w), w), default=None)


def attributes(product: DataFrame, words: DataFrame) -> DataFrame:
    """row_id, seller and what each listing says of its item; listings that say nothing of a model are left out.

    Brand words are counted first: up to MAX_BROADCAST they are sent to the executors, more are joined to
    the names. Either way a listing sees those of its own name.
    """
    schema = "row_id bigint, seller string, model string, edition string, volume double, strength double, ohm double, pack int, colour string, brand string"

    small = words.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST
    sent = product.sparkSession.sparkContext.broadcast({r["word"]: r["generic"] for r in words.collect()}) if small else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                texts = [t for t in (r.brand, r.commercial_brand, *(r.brand_candidates if r.brand_candidates is not None else ())) if t]
                if sent is None:
                    known, generic = (set(x) if x is not None else set() for x in (r.known, r.generic))
                else:
                    known = {w for w in _WORDS.findall(folded(r.name or "")) if w in sent.value}
                    generic = {w for w in known if sent.value[w]}
                p = parse(r.name, r.description, dict(r.variants) if r.variants is not None else None, known)
                if not p["model"]:
                    continue
                brand = brand_word([*texts, *([p["named_brand"]] if p["named_brand"] else [])], r.name, p["model"], generic)
                device = p["volume"] is None and p["strength"] is None and p["ohm"] is None
                out.append((r.row_id, r.seller, p["model"], p["edition"], p["volume"], p["strength"], p["ohm"], p["pack"], p["colour"] if device else None, brand))
            yield pd.DataFrame(out, columns=["row_id", "seller", *_SIG, "brand"]).astype({"pack": "Int32"})

    rows = product.select("row_id", F.col("distributor").alias("seller"), "name", "description", "variants", "brand", "commercial_brand", "brand_candidates")
    rows = rows.where("row_id is not null and seller is not null")
    if sent is None:
        rows = with_brand_words(rows, words).withColumnsRenamed({"_known": "known", "_generic": "generic"})
    return rows.mapInPandas(run, schema)


def scored_pairs(nodes: DataFrame) -> DataFrame:
    """a, sa, b, sb, weight of the node pairs of different sellers that may be one item.

    Prefix-filtered join: model words weigh by their rarity over all nodes, ln(1 + nodes / nodes
    with the word), and a node's prefix is its rarest words up to where the rest weighs less than
    SIMILAR of the whole; two nodes as similar as that share a prefix word. Only nodes of one
    edition and pack meet. The weight is the weighted Jaccard of the model words plus one for
    each attribute both state alike, less a quarter for one that only one of them states; a pair
    that states an attribute differently is none.
    """
    flat = nodes.select("node", F.explode(F.array_distinct(F.split("model", " "))).alias("w"))
    total = float(nodes.count())
    rarity = flat.groupBy("w").agg(F.count(F.lit(1)).alias("_df")).select("w", F.log1p(F.lit(total) / F.col("_df")).alias("x"))
    weighed = flat.join(rarity, "w").groupBy("node").agg(F.array_sort(F.collect_list(F.struct((-F.col("x")).alias("x"), "w"))).alias("ws"))
    full = checkpointed(nodes.join(weighed, "node").withColumn("whole", F.aggregate("ws", F.lit(0.0), lambda a, t: a - t["x"])))
    before = F.transform("ws", lambda t, i: F.struct(t["w"].alias("w"), F.aggregate(F.slice(F.col("ws"), F.lit(1), i), F.lit(0.0), lambda a, u: a - u["x"]).alias("before")))
    # the words from the i-th on weigh whole - before; while that is enough for the overlap, the i-th belongs to the prefix
    prefix = F.transform(F.filter(before, lambda t: F.col("whole") - t["before"] >= F.col("whole") * SIMILAR - 1e-9), lambda t: t["w"])
    side = full.select("node", "seller", "edition", F.coalesce("pack", F.lit(0)).alias("pack"), *ATTRIBUTES, "ws", "whole", F.explode(prefix).alias("w"))
    a, b = (side.select("edition", "pack", "w", *[F.col(c).alias(f"{c}_{n}") for c in ("node", "seller", *ATTRIBUTES, "ws", "whole")]) for n in "ab")
    unlike = F.lit(False)
    agreement = F.lit(0.0)
    for k in ATTRIBUTES:
        x, y = F.col(f"{k}_a"), F.col(f"{k}_b")
        unlike = unlike | F.coalesce(x != y, F.lit(False))
        agreement = agreement + F.when(x.isNull() & y.isNull(), 0.0).when(x.isNull() | y.isNull(), -0.25).otherwise(1.0)
    shared = F.aggregate(F.array_intersect("ws_a", "ws_b"), F.lit(0.0), lambda s, t: s - t["x"])
    jaccard = shared / (F.col("whole_a") + F.col("whole_b") - shared)
    met = a.join(b, ["edition", "pack", "w"]).where((F.col("seller_a") < F.col("seller_b")) & ~unlike)
    # of the prefix words two nodes share only the first lets them meet, so a pair comes once
    first = F.element_at(F.array_intersect(F.transform("ws_a", lambda t: t["w"]), F.transform("ws_b", lambda t: t["w"])), 1)
    return (
        met.where(first == F.col("w"))
        .select(F.col("node_a").alias("a"), F.col("seller_a").alias("sa"), F.col("node_b").alias("b"), F.col("seller_b").alias("sb"), jaccard.alias("j"), agreement.alias("g"))
        .where(F.col("j") >= SIMILAR - 1e-9)
        .select("a", "sa", "b", "sb", (F.col("j") + F.col("g")).alias("weight"))
        .where("weight > 0")
    )


def assignment(weights: np.ndarray) -> list[tuple[int, int]]:
    """Maximum-weight matching of a bipartite component; entries that are not positive are no edges.

    The Hungarian method on the square matrix padded with zeros, so leaving a node alone costs nothing.
    """
    n, m = weights.shape
    size = max(n, m)
    cost = np.zeros((size + 1, size + 1))
    cost[1 : n + 1, 1 : m + 1] = -np.maximum(weights, 0.0)
    u, v = np.zeros(size + 1), np.zeros(size + 1)
    match = np.zeros(size + 1, dtype=int)
    for i in range(1, size + 1):
        match[0], j0 = i, 0
        least = np.full(size + 1, np.inf)
        used = np.zeros(size + 1, dtype=bool)
        way = np.zeros(size + 1, dtype=int)
        while True:
            used[j0] = True
            row = match[j0]
            free = np.flatnonzero(~used)
            reduced = cost[row, free] - u[row] - v[free]
            better = reduced < least[free]
            least[free[better]] = reduced[better]
            way[free[better]] = j0
            j1 = free[np.argmin(least[free])]
            delta = least[j1]
            u[match[used]] += delta
            v[used] -= delta
            least[~used] -= delta
            j0 = j1
            if match[j0] == 0:
                break
        while j0:
            match[j0] = match[way[j0]]
            j0 = way[j0]
    return [(match[j] - 1, j - 1) for j in range(1, size + 1) if match[j] <= n and j <= m and weights[match[j] - 1, j - 1] > 0]


def group_edges(edges: list[dict]) -> dict[int, int]:
    """node id -> item id (least node id of its group) for the scored pairs of one component.

    Per pair of sellers and connected component of their pairs, a maximum-weight matching.
    Matches are merged from the heaviest down; one that would put two nodes of a seller into a
    group, and so contradicts the matches round a cycle, is refused. Ties go by node ids.
    """
    between: dict[tuple[str, str], dict[tuple[int, int], float]] = defaultdict(dict)
    seller: dict[int, str] = {}
    for e in edges:
        between[e["sa"], e["sb"]][e["a"], e["b"]] = e["weight"]
        seller[e["a"]], seller[e["b"]] = e["sa"], e["sb"]
    matches: list[tuple[float, int, int]] = []
    for pair in sorted(between):
        weights = between[pair]
        for ls, rs in _components(weights):
            if len(ls) == 1 and len(rs) == 1:
                pairs = [(0, 0)]
            else:
                pairs = assignment(np.array([[weights.get((i, j), 0.0) for j in rs] for i in ls]))
            matches += [(-weights[ls[i], rs[j]], ls[i], rs[j]) for i, j in pairs]
    parent = {n: n for n in seller}
    sellers = {n: {s} for n, s in seller.items()}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for _, a, b in sorted(matches):
        ra, rb = root(a), root(b)
        if ra != rb and not sellers[ra] & sellers[rb]:
            ra, rb = min(ra, rb), max(ra, rb)
            parent[rb] = ra
            sellers[ra] |= sellers[rb]
    return {n: root(n) for n in sorted(seller)}


def _components(edges: dict[tuple[int, int], float]) -> list[tuple[list[int], list[int]]]:
    of_left, of_right = defaultdict(list), defaultdict(list)
    for i, j in edges:
        of_left[i].append(j)
        of_right[j].append(i)
    seen: set[int] = set()
    out = []
    for start in sorted(of_left):
        if start in seen:
            continue
        ls, rs, todo = {start}, set(), [start]
        seen.add(start)
        while todo:
            for j in of_left[todo.pop()]:
                if j not in rs:
                    rs.add(j)
                    for i in of_right[j]:
                        if i not in seen:
                            seen.add(i)
                            ls.add(i)
                            todo.append(i)
        out.append((sorted(ls), sorted(rs)))
    return out


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("node", T.LongType()), T.StructField("item", T.LongType())])))
def _grouped(batches: pd.Series) -> pd.Series:
    return pd.Series([[{"node": n, "item": i} for n, i in group_edges(list(edges)).items()] for edges in batches])


def item_groups(product: DataFrame, brand_ref: DataFrame) -> DataFrame:
    """row_id, seller, item_id: one row per listing whose item another seller offers too.

    A seller's listings with the same attributes (repeated captures) are one node before
    anything is compared, so copies cost nothing. Scored pairs of nodes come from scored_pairs.
    A pair whose ends have no other is a group; the other pairs are gathered per connected
    component, assigned and merged by group_edges. A component holds the pairs of nodes, not of
    rows.

    Null sellers and ids give no row. A null name leaves the model to what the description says,
    and a name without model words to all its words; a listing that says neither gives no row. Null
    descriptions, variants and brands leave attributes unknown: an unknown one neither agrees nor
    conflicts.
    """
    rows = checkpointed(attributes(product, checkpointed(brand_words(product, brand_ref))))
    sig: Column = F.to_json(F.struct("seller", *_SIG), {"ignoreNullFields": "false"})
    keyed = rows.withColumn("sig", sig)
    usual = keyed.where("brand is not null").groupBy("sig").agg(F.mode("brand", True).alias("usual"))
    branded = salted_lookup(keyed, usual, ["sig"], "row_id").withColumn("brand", F.coalesce("brand", "usual")).withColumn("key", F.concat_ws("|", "sig", "brand"))
    branded = checkpointed(branded.select("row_id", "seller", *_SIG, "brand", "key"))
    nodes = checkpointed(branded.groupBy("key", "seller", *_SIG, "brand").agg(F.min("row_id").alias("node")))
    pairs = checkpointed(scored_pairs(nodes.drop("key")))
    degree = pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    ends = pairs.join(degree.select(F.col("node").alias("a"), F.col("n").alias("na")), "a").join(degree.select(F.col("node").alias("b"), F.col("n").alias("nb")), "b")
    ends = checkpointed(ends)
    alone = ends.where("na = 1 and nb = 1").select(F.explode(F.array("a", "b")).alias("node"), F.least("a", "b").alias("item_id"))
    tied = ends.where("na > 1 or nb > 1").drop("na", "nb")
    labels = components(tied.select("a", "b"), "a", "b")
    grouped = tied.join(labels.select(F.col("node").alias("a"), "component"), "a").groupBy("component").agg(F.collect_list(F.struct("a", "sa", "b", "sb", "weight")).alias("e"))
    assigned = grouped.select(F.explode(_grouped("e")).alias("g")).select("g.node", F.col("g.item").alias("item_id"))
    shared = assigned.join(assigned.groupBy("item_id").agg(F.count(F.lit(1)).alias("k")).where("k > 1").drop("k"), "item_id").select("node", "item_id")
    members = nodes.select("key", "node").join(alone.unionByName(shared), "node").select("key", "item_id")
    return salted_lookup(branded.select("row_id", "seller", "key"), members, ["key"], "row_id", how="inner").select("row_id", "seller", "item_id")


def item_pairs(groups: DataFrame, salts: int = 8) -> DataFrame:
    """row_id_1 < row_id_2 of rows of different sellers in one group, distinct.

    One side of every group is spread over salts, so a group with many captures is several tasks.
    """
    left = groups.select(F.col("row_id").alias("a"), F.col("seller").alias("sa"), "item_id").withColumn("_salt", F.pmod(F.xxhash64("a"), F.lit(salts)).cast("int"))
    right = groups.select(F.col("row_id").alias("b"), F.col("seller").alias("sb"), "item_id").withColumn("_salt", F.explode(F.array([F.lit(i) for i in range(salts)])))
    return (
        left.join(right, ["item_id", "_salt"])
        .where("a < b and sa <> sb")
        .select(F.col("a").alias("row_id_1"), F.col("b").alias("row_id_2"))
    )

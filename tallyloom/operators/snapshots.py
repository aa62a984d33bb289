"""What changed between consecutive full snapshots of a table, by content-defined chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import bounded

#: The table of deliveries is broadcast up to this many rows.
MAX_BROADCAST = 1_000_000


def canonical_map(c: Column) -> Column:
    """A map as a sorted array of its entries; null counts as empty."""
    return F.coalesce(F.array_sort(F.map_entries(c)), F.array().cast("array<struct<key:string,value:string>>"))


def collapsed(c: Column) -> Column:
    """Blanks trimmed and runs of them made one; case kept."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def cents(c: Column) -> Column:
    return F.round(c * 100).cast("bigint")


def delivery_sequence(deliveries: DataFrame, source: str, snapshot: str) -> DataFrame:
    """_source, _snapshot, _seq (from 1) and _next snapshot of every delivery of a source."""
    order_w = Window.partitionBy("_source").orderBy("_snapshot")
    return (
        deliveries.select(F.col(source).alias("_source"), F.col(snapshot).alias("_snapshot"))
        .where("_source is not null and _snapshot is not null")
        .distinct()
        .withColumn("_seq", F.row_number().over(order_w))
        .withColumn("_next", F.lead("_snapshot").over(order_w))
    )


def delivered_rows(
    rows: DataFrame, deliveries: DataFrame, *, source: str, snapshot: str, key: str, order: str, content: Sequence[Column], carry: Sequence[str] = ()
) -> DataFrame:
    """The row of each key that counts in a delivery: _source, _snapshot, _key, two content hashes, _carry_*, _seq, _next.

    The largest `order` counts (null first; of equal ones the largest content hash and then the
    carried columns, so the result does not depend on row order). Rows whose source, snapshot or
    key is null, and rows without a delivery, take no part.
    """
    canon = F.to_json(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(content)]), {"ignoreNullFields": "false"})
    picked = rows.select(
        F.col(source).alias("_source"),
        F.col(snapshot).alias("_snapshot"),
        F.col(key).alias("_key"),
        F.col(order).alias("_order"),
        canon.alias("_canon"),
        *[F.col(c).alias(f"_carry_{i}") for i, c in enumerate(carry)],
    ).where("_source is not null and _snapshot is not null and _key is not null")
    counting = F.max(
        F.struct(
            "_order",
            F.xxhash64(F.lit(1), "_key", "_canon").alias("h1"),
            F.xxhash64(F.lit(2), "_canon", "_key").alias("h2"),
            *[f"_carry_{i}" for i in range(len(carry))],
        )
    )
    seq = bounded(delivery_sequence(deliveries, source, snapshot), MAX_BROADCAST, "deliveries")
    return picked.groupBy("_source", "_snapshot", "_key").agg(counting.alias("m")).select("_source", "_snapshot", "_key", "m.*").join(seq, ["_source", "_snapshot"])


def snapshot_changes(
    rows: DataFrame,
    deliveries: DataFrame,
    *,
    source: str,
    snapshot: str,
    key: str,
    order: str,
    content: Sequence[Column],
    carry: Sequence[str] = (),
    block_rows: int = 1 << 14,
    chunk_rows: int = 64,
) -> DataFrame:
    """One row per key added, removed or changed against the source's preceding delivery.

    rows hold full snapshots; deliveries(snapshot, source) say which source delivered when.
    Which row of a key counts in a delivery is said by delivered_rows. A delivery without rows
    removes everything. An empty table gives an empty result.

    Each delivery is cut into chunks of its key-sorted rows. Keys are first grouped into ranges
    of about block_rows keys, which bounds every sort, and inside a range a new chunk starts at
    keys whose hash says so: the cut depends on content only, so an insertion shifts no later
    chunk. A whole-number key is sorted by itself, in ranges as wide as its spread over the table
    asks for; a key of another type by its hash. A chunk equal to the same chunk of the
    neighbouring delivery (row count and two independent 64-bit sums over key and content) is
    discarded; only rows of the other chunks are joined.

    Columns: snapshot, source, key, change_kind, old_*/new_* for each column of carry.
    """
    kept = delivered_rows(rows, deliveries, source=source, snapshot=snapshot, key=key, order=order, content=content, carry=carry)
    whole = dict(rows.dtypes)[key] in ("tinyint", "smallint", "int", "bigint")
    position = F.col("_key").cast("bigint") if whole else F.xxhash64("_key")
    spread = rows.agg(F.min(key if whole else F.xxhash64(key)).alias("a"), F.max(key if whole else F.xxhash64(key)).alias("b"), F.count(key).alias("n")).first()
    width = max(block_rows, block_rows * (int(spread["b"]) - int(spread["a"])) // max(1, spread["n"])) if spread["n"] else block_rows
    block = F.floor(position / F.lit(float(width)))
    cut = F.when(F.pmod(F.xxhash64("_key"), F.lit(chunk_rows)) == 0, F.col("_key"))
    chunked = kept.withColumn("_block", block).withColumn(
        "_chunk",
        F.last(cut, ignorenulls=True).over(
            Window.partitionBy("_source", "_seq", "_block").orderBy(position, "_key").rowsBetween(Window.unboundedPreceding, 0)
        ),
    )
    chunk_key = ["_source", "_seq", "_block", "_chunk"]
    digests = chunked.groupBy(*chunk_key).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("h1").cast("decimal(38,0)")).alias("s"),
        F.bit_xor("h2").alias("x"),
    )
    beside = Window.partitionBy("_source", "_block", "_chunk").orderBy("_seq")
    digest = F.struct("n", "s", "x")
    flags = digests.select(
        *chunk_key,
        F.coalesce((F.lag("_seq").over(beside) == F.col("_seq") - 1) & (F.lag(digest).over(beside) == digest), F.lit(False)).alias("_as_before"),
        F.coalesce((F.lead("_seq").over(beside) == F.col("_seq") + 1) & (F.lead(digest).over(beside) == digest), F.lit(False)).alias("_as_after"),
    )
    on = F.expr(
        "a._source = b._source and a._seq = b._seq and a._block = b._block and a._chunk <=> b._chunk"
    )
    loose = (
        chunked.alias("a")
        .join(flags.where("not (_as_before and _as_after)").alias("b"), on)
        .select("a.*", "b._as_before", "b._as_after")
    )
    held = ["h1", "h2", *[f"_carry_{i}" for i in range(len(carry))]]
    new = loose.where("not _as_before and _seq > 1").select(
        "_source", F.col("_snapshot").alias("_at"), "_key", F.struct(*held).alias("_new")
    )
    old = loose.where("not _as_after and _next is not null").select(
        "_source", F.col("_next").alias("_at"), "_key", F.struct(*held).alias("_old")
    )
    both = new.join(old, ["_source", "_at", "_key"], "full_outer")
    kind = (
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_new").isNull(), "removed")
        .when((F.col("_new.h1") != F.col("_old.h1")) | (F.col("_new.h2") != F.col("_old.h2")), "changed")
    )
    return both.withColumn("change_kind", kind).where("change_kind is not null").select(
        F.col("_at").alias(snapshot),
        F.col("_source").alias(source),
        F.col("_key").alias(key),
        "change_kind",
        *[F.col(f"_old._carry_{i}").alias(f"old_{c}") for i, c in enumerate(carry)],
        *[F.col(f"_new._carry_{i}").alias(f"new_{c}") for i, c in enumerate(carry)],
    )


def _catalogue() -> dict:
    """The catalogue's notion of a listing, its order and its content."""
    return {
        "source": "distributor", "snapshot": "snapshot_no", "key": "listing_id", "order": "captured_at",
        "content": [collapsed(F.col("name")), canonical_map(F.col("variants")), F.col("reference"), F.col("category"), cents(F.col("price_tax_excluded"))],
    }


def catalog_changes(snapshots: DataFrame, deliveries: DataFrame, carry: Sequence[str] = ("url", "name")) -> DataFrame:
    """The operator with the catalogue's notion of a changed listing."""
    return snapshot_changes(snapshots, deliveries, carry=carry, **_catalogue())


def url_names(snapshots: DataFrame, deliveries: DataFrame) -> DataFrame:
    """snapshot_no, distributor, url, name, old_rows, new_rows of every url and collapsed name.

    Rows are the listings that count in the delivery (new) and in the distributor's preceding one
    (old), by the same tie rule as the changes. A null url or name is a value of its own. Counts
    are added up before the shuffle, so a url with a tenth of all rows costs one row per name.
    """
    kept = delivered_rows(snapshots, deliveries, carry=("url", "name"), **_catalogue())
    none, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    facts = ["_source", F.col("_carry_0").alias("url"), collapsed(F.col("_carry_1")).alias("name")]
    sides = F.array(
        F.when(F.col("_seq") > 1, F.struct(F.col("_snapshot").alias("at"), none.alias("old"), one.alias("new"))),
        F.when(F.col("_next").isNotNull(), F.struct(F.col("_next").alias("at"), one.alias("old"), none.alias("new"))),
    )
    flat = kept.select(*facts, F.explode(F.filter(sides, lambda s: s.isNotNull())).alias("s"))
    return flat.groupBy(F.col("s.at").alias("snapshot_no"), F.col("_source").alias("distributor"), "url", "name").agg(F.sum("s.old").alias("old_rows"), F.sum("s.new").alias("new_rows"))


def url_report(snapshots: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Per delivery, distributor and url that gained, lost or changed a listing: the rows before
    and after, how many listings were added, removed and changed, and how many names are on one
    side only. url_only_names lists those names, one a row."""
    changes = catalog_changes(snapshots, deliveries)
    moved = F.array(
        F.when(F.col("change_kind") != "added", F.struct(F.col("old_url").alias("url"), F.col("change_kind").alias("kind"))),
        F.when((F.col("change_kind") != "removed") & ~((F.col("change_kind") == "changed") & F.col("old_url").eqNullSafe(F.col("new_url"))), F.struct(F.col("new_url").alias("url"), F.col("change_kind").alias("kind"))),
    )
    count = lambda k: F.count_if(F.col("m.kind") == k).alias(k)
    urls = (
        changes.select("snapshot_no", "distributor", F.explode(F.filter(moved, lambda m: m.isNotNull())).alias("m"))
        .groupBy("snapshot_no", "distributor", F.col("m.url").alias("url"))
        .agg(count("added"), count("removed"), count("changed"))
    )
    rows = url_names(snapshots, deliveries).groupBy("snapshot_no", "distributor", "url").agg(
        F.sum("old_rows").alias("old_rows"),
        F.sum("new_rows").alias("new_rows"),
        F.count_if((F.col("new_rows") == 0) & F.col("name").isNotNull()).alias("only_old_names"),
        F.count_if((F.col("old_rows") == 0) & F.col("name").isNotNull()).alias("only_new_names"),
    )
    on = F.expr("a.distributor = b.distributor and a.snapshot_no = b.snapshot_no and a.url <=> b.url")
    return urls.alias("a").join(rows.alias("b"), on).select("a.*", "b.old_rows", "b.new_rows", "b.only_old_names", "b.only_new_names")


def url_only_names(snapshots: DataFrame, deliveries: DataFrame) -> DataFrame:
    """snapshot_no, distributor, url, side (old or new), name, rows: the names that a url has on one side only."""
    n = url_names(snapshots, deliveries).where("name is not null and (old_rows = 0 or new_rows = 0)")
    side = F.when(F.col("new_rows") == 0, "old").otherwise("new")
    return n.select("snapshot_no", "distributor", "url", side.alias("side"), "name", (F.col("old_rows") + F.col("new_rows")).alias("rows"))


def url_row_counts(snapshots: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Per distributor, delivery after its first and url: captured rows before and after, and the outcome.

    Before is the distributor's preceding delivery, so a snapshot it did not deliver reports nothing.
    """
    seq = delivery_sequence(deliveries, "distributor", "snapshot_no").withColumnsRenamed({"_source": "distributor", "_snapshot": "snapshot_no"})
    listed = snapshots.groupBy("distributor", "snapshot_no", "url").agg(F.count(F.lit(1)).alias("n")).join(bounded(seq, MAX_BROADCAST, "deliveries"), ["distributor", "snapshot_no"])
    none = F.lit(0).cast("bigint")
    new = listed.where("_seq > 1").select("distributor", "snapshot_no", "url", none.alias("o"), F.col("n").alias("k"))
    old = listed.where("_next is not null").select("distributor", F.col("_next").alias("snapshot_no"), "url", F.col("n").alias("o"), none.alias("k"))
    g = new.unionByName(old).groupBy("distributor", "snapshot_no", "url").agg(F.sum("o").alias("old_rows"), F.sum("k").alias("new_rows"))
    outcome = F.when(F.col("old_rows") == 0, "added").when(F.col("new_rows") == 0, "missing").when(F.col("old_rows") != F.col("new_rows"), "row_count").otherwise("same")
    return g.withColumn("outcome", outcome)

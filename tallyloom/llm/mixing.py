"""Sources mixed to target token shares by entropy balancing."""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import checkpointed, release

#: Where the vocabulary files of the public tokenizers lie, and the one that counts.
TOKENIZER_DIR = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
# Fixed value: how that vocabulary splits a text before merging bytes.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The mix targets are a parameter table; more sources than this are refused.
MAX_SOURCES = 100_000
#: Documents of one size are ranked in parts of about this many.
PART_ROWS = 50_000


def token_counts(documents: DataFrame, id_col: str, source_col: str, text_col: str, tokenizer_dir: str = TOKENIZER_DIR) -> DataFrame:
    """id, source, tokens of every document; a null or empty text has 0.

    The vocabulary file (about 1 MB) is read on the driver and sent once to each executor.
    """
    spark = documents.sparkSession
    ranks_file = spark.sparkContext.broadcast(Path(tokenizer_dir, VOCABULARY).read_bytes())

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks_file.value.splitlines() if line)}
        encoding = tiktoken.Encoding("own", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})
        for texts in batches:
            yield pd.Series([len(encoding.encode_ordinary(t)) if t else 0 for t in texts])

    return documents.select(F.col(id_col).alias("_d"), F.col(source_col).alias("_s"), count(F.col(text_col)).alias("_n"))


def tilted_rate(lam: Column, z: Column, cap: Column) -> Column:
    """The rate exp(lambda z) of a document, at most its cap."""
    return F.least(cap.cast("double"), F.exp(F.least(F.lit(50.0), F.greatest(F.lit(-50.0), lam * z))))


def solve(sizes: DataFrame, wanted: dict[str, tuple[float, int]], rounds: int = 60, tolerance: float = 1e-9) -> dict[str, float]:
    """lambda per source so that the rates' tokens equal the wanted ones.

    sizes(_s, _z, _n, count): documents by source and size. The dual of the entropy problem is
    convex and separates by source; each round one aggregation gives every source's gradient
    and curvature, a Newton step inside a bracket that the monotone gradient keeps narrowing,
    and only one row per source comes back.
    """
    lam = {s: 0.0 for s in wanted}
    low, high = {s: -60.0 for s in wanted}, {s: 60.0 for s in wanted}
    spark = sizes.sparkSession
    done: set[str] = set()
    for _ in range(rounds):
        if len(done) == len(wanted):
            break
        open_ = [s for s in wanted if s not in done]
        current = F.broadcast(spark.createDataFrame([(s, lam[s], wanted[s][1]) for s in open_], "_s string, _lam double, _cap int"))
        rate = tilted_rate(F.col("_lam"), F.col("_z"), F.col("_cap"))
        free = F.when(rate < F.col("_cap"), rate).otherwise(F.lit(0.0))
        rows = (
            sizes.join(current, "_s")
            .groupBy("_s")
            .agg(F.sum(rate * F.col("_n") * F.col("count")).alias("g"), F.sum(free * F.col("_z") * F.col("_n") * F.col("count")).alias("h"))
            .collect()
        )
        for r in rows:
            s, gap = r["_s"], r["g"] - wanted[r["_s"]][0]
            if abs(gap) <= tolerance * max(1.0, wanted[s][0]):
                done.add(s)
                continue
            if gap > 0:
                high[s] = lam[s]
            else:
                low[s] = lam[s]
            step = lam[s] - gap / r["h"] if r["h"] else math.inf
            lam[s] = step if low[s] < step < high[s] else (low[s] + high[s]) / 2
    return lam


def mixed(
    documents: DataFrame,
    targets: DataFrame,
    *,
    total_tokens: int | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    tokenizer_dir: str = TOKENIZER_DIR,
) -> DataFrame:
    """id, source, tokens, rate, copies of every document whose source has a target.

    targets(source, target_share, max_repeats). The rates minimise the relative entropy to one
    use of each document subject to each source's token total; they are exp(lambda_s size) up
    to max_repeats. Rates are rounded to copies by systematic sampling along size: within a
    source the fractions are added up from the smallest document to the largest (equal sizes by
    the hash of the id), and a document gets one more copy where the sum passes a half. So the
    copies of a source's documents up to any size differ from their rates by less than one, and
    no document exceeds its cap. The sums run over groups of one size and part, whose number is
    bounded by the sizes, and over the ranks within a group of about PART_ROWS documents.

    total_tokens is the size of the mix; by default the largest for which no source needs more
    than its cap. Sources without documents or tokens cannot contribute: the others keep their
    proportions. Sources without a target, a null share, or a share that is not positive take
    no part; a null or non-positive max_repeats counts as 1. Documents with null source take no
    part; null texts have no tokens and get a copy by their rate.
    """
    rows = targets.select("source", "target_share", "max_repeats").limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources in the targets")
    goals = {r[0]: (float(r[1]), int(r[2]) if r[2] and r[2] > 0 else 1) for r in rows if r[0] is not None and r[1] is not None and r[1] > 0}
    counted = checkpointed(token_counts(documents.where(F.col(source_col).isNotNull()), id_col, source_col, text_col, tokenizer_dir))
    totals = {r["_s"]: (r["t"], r["m"]) for r in counted.groupBy("_s").agg(F.sum("_n").alias("t"), F.avg("_n").alias("m")).collect() if r["t"] and r["_s"] in goals}
    share = sum(goals[s][0] for s in totals) or 1.0
    largest = min((goals[s][1] * t / (goals[s][0] / share) for s, (t, _) in totals.items()), default=0.0)
    total = largest if total_tokens is None else min(float(total_tokens), largest)
    wanted = {s: (total * goals[s][0] / share, goals[s][1]) for s in totals}
    spark = documents.sparkSession
    means = F.broadcast(spark.createDataFrame([(s, float(m), wanted[s][1]) for s, (_, m) in totals.items()], "_s string, _mean double, _cap int"))
    sized = counted.join(means, "_s").withColumn("_z", F.col("_n") / F.col("_mean"))
    histogram = checkpointed(sized.groupBy("_s", "_n", "_z", "_cap").agg(F.count(F.lit(1)).alias("count")))
    lam = solve(histogram.drop("_cap"), wanted) if wanted else {}
    multipliers = F.broadcast(spark.createDataFrame(list(lam.items()), "_s string, _lam double"))
    rates = histogram.join(multipliers, "_s").withColumn("rate", tilted_rate(F.col("_lam"), F.col("_z"), F.col("_cap"))).select("_s", "_n", "_cap", "rate", "count")
    # a hot size (copies of one text) is ranked in parts
    parts = F.greatest(F.lit(1), F.ceil(F.col("count") / F.lit(float(PART_ROWS)))).cast("int")
    rates = checkpointed(rates.withColumn("_parts", parts).drop("count"))
    release(histogram)
    rated = counted.join(rates, ["_s", "_n"]).withColumn("_part", F.pmod(F.xxhash64(F.lit("mix"), "_d"), F.col("_parts")))
    fraction = F.col("rate") - F.floor("rate")
    group = ["_s", "_n", "_part"]
    before = Window.partitionBy("_s").orderBy("_n", "_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = rated.groupBy(*group).agg(F.sum(fraction).alias("_f")).select(*group, F.coalesce(F.sum("_f").over(before), F.lit(0.0)).alias("_before"))
    ranked = rated.withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy(F.xxhash64("_d"), "_d"))).join(sums, group)
    passed = lambda rank: F.floor(F.round(F.col("_before") + rank * fraction, 9) + 0.5)
    copies = F.floor("rate") + passed(F.col("_rank")) - passed(F.col("_rank") - 1)
    return ranked.select(
        F.col("_d").alias(id_col), F.col("_s").alias(source_col), F.col("_n").alias("tokens"), F.round("rate", 6).alias("rate"), F.least(copies, F.col("_cap")).cast("int").alias("copies")
    )


def share_report(mix: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target source: documents, copies, tokens before and in the mix, target and actual share."""
    got = mix.groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("copies").alias("copies"), F.max("copies").alias("most_copies"), F.sum("tokens").alias("tokens"), F.sum(F.col("tokens") * F.col("copies")).alias("mixed_tokens")
    )
    total = mix.agg(F.sum(F.col("tokens") * F.col("copies")).alias("all_tokens"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return (
        targets.select("source", "target_share", "max_repeats")
        .join(got, "source", "left")
        .join(F.broadcast(total))
        .select(
            "source", "target_share", "max_repeats", zero("documents").alias("documents"), zero("copies").alias("copies"), zero("most_copies").alias("most_copies"), zero("tokens").alias("tokens"),
            zero("mixed_tokens").alias("mixed_tokens"), F.round(zero("mixed_tokens") / F.col("all_tokens"), 6).alias("actual_share"),
        )
    )

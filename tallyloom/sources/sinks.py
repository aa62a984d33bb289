"""Writers: JSON lines and documents, delimited text, partitioned tables, reports, upsert batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_PARAMETERS = 60_000


def json_lines(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).json(path)


def delimited(df: DataFrame, path: str, columns: Sequence[str], sep: str = ",") -> None:
    """Fixed column order, quotes doubled."""
    df.select(*columns).write.mode("overwrite").options(header=True, quote='"', escape='"', sep=sep).csv(path)


def refreshed(df: DataFrame, path: str, side: str) -> None:
    """Only the partitions of the sides in df are replaced; other sides stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(side).parquet(path)


def nested_pairs(variants: DataFrame, pair: Sequence[str], order: str) -> DataFrame:
    """One JSON document per pair with its variants, highest confidence first, empty fields left out."""
    rest = [c for c in variants.columns if c not in pair]
    held = F.array_sort(F.collect_list(F.struct((-F.col(order)).alias("_o"), *rest)))
    grouped = variants.groupBy(*pair).agg(F.transform(held, lambda x: F.struct(*[x[c].alias(c) for c in rest])).alias("variants"))
    return grouped.select(*pair, F.to_json(F.struct(*pair, "variants")).alias("document"))


def markdown(rows: DataFrame, title: str, limit: int = 200) -> str:
    """A report table of a small aggregated result; the rows beyond the limit are counted in its last line."""
    held = rows.limit(limit + 1).collect()
    cells = [[("" if v is None else str(v)) for v in r] for r in held[:limit]]
    lines = [f"# {title}", "", "| " + " | ".join(rows.columns) + " |", "|" + " --- |" * len(rows.columns)]
    rest = [f"{rows.count() - limit} more rows", ""] if len(held) > limit else []
    return "\n".join([*lines, *["| " + " | ".join(c) + " |" for c in cells], "", *rest])


def batch_rows(requested: int, columns: int) -> int:
    """Rows of one statement so that its parameters stay within the limit."""
    return max(1, min(requested, MAX_PARAMETERS // max(1, columns)))


def upsert_statement(table: str, columns: Sequence[str], conflict: Sequence[str], dialect: str = "postgresql") -> str:
    """insert .. on conflict .. do update with quoted names."""
    q = lambda n: '"' + n.replace('"', '""') + '"'
    sets = ", ".join(f"{q(c)} = excluded.{q(c)}" for c in columns if c not in conflict)
    return (
        f"insert into {table} ({', '.join(map(q, columns))}) values ({', '.join(['%s'] * len(columns))}) "
        f"on conflict ({', '.join(map(q, conflict))}) do " + (f"update set {sets}" if sets else "nothing")
    )

import duckdb

import __spark_entry__ as e

TABLES = "region nation customer supplier part orders lineitem events documents embeddings product catalog_snapshot snapshot_delivery variant_match pair_spec brand_ref eval_item mix_target".split()


def _plain(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    return str([_plain(x) for x in v]) if isinstance(v, (list, tuple)) else str(v)


def rows(it):
    return sorted(tuple(_plain(v) for v in r) for r in it)


def test_entry_has_rows(spark):
    assert e.entry(spark).limit(1).count() == 1


def test_queries_agree_with_sql(spark):
    d = "/root/testdata/sf0.001"
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{d}/{t}.parquet'")
    sql, queries = e.oracle_sql(), e.queries()
    assert set(sql) <= set(queries)
    for name in sorted(sql):
        rel = c.sql(sql[name])
        df = queries[name](spark, d)
        cols = sorted(df.columns)
        assert cols == sorted(rel.columns)
        assert rows(df.select(*cols).collect()) == rows(rel.select(*[f'"{x}"' for x in cols]).fetchall()), name

import datetime as dt
import random

from pyspark.sql import functions as F

from tallyloom.operators import snapshots

SCHEMA = "snapshot_no int, captured_at timestamp, listing_id bigint, distributor string, url string, name string, variants map<string,string>, reference string, category string, price_tax_excluded double, change_kind string"


def row(no, lid, src="a", name="n", variants=None, ref=None, price=1.0, minute=0):
    return (no, dt.datetime(2026, 1, no, 0, minute), lid, src, f"u{lid}", name, variants, ref, "c", price, "clash")


def changes(spark, rows, deliveries):
    s = spark.createDataFrame(rows, SCHEMA)
    d = spark.createDataFrame(deliveries, "snapshot_no int, distributor string")
    return sorted((r.snapshot_no, r.listing_id, r.change_kind) for r in snapshots.catalog_changes(s, d).collect())


def test_kinds_form_only_differences_and_superseded_rows(spark):
    rows = [
        row(1, 1), row(3, 1, name=" n ", variants={}, price=1.001),
        row(1, 2, variants={"a": "1", "b": "2"}), row(3, 2, variants={"b": "2", "a": "1"}),
        row(1, 3), row(3, 3, price=None),
        row(1, 4), row(3, 5),
        row(1, 6), row(3, 6, name="old", minute=1), row(3, 6, name="n", minute=5), row(3, 6, name="n", minute=5),
        row(1, 7, ref=None), row(3, 7, ref="r"),
        (3, None, None, "a", None, None, None, None, None, None, None),
    ]
    assert changes(spark, rows, [(1, "a"), (3, "a"), (3, "a"), (None, "a")]) == [(3, 3, "changed"), (3, 4, "removed"), (3, 5, "added"), (3, 7, "changed")]


def test_empty_delivery_removes_and_empty_table(spark):
    assert changes(spark, [row(1, 1), row(3, 1)], [(1, "a"), (2, "a"), (3, "a")]) == [(2, 1, "removed"), (3, 1, "added")]
    assert changes(spark, [], [(1, "a")]) == []


def test_against_brute_force(spark):
    rnd = random.Random(5)
    rows, state = [], {s: {} for s in "ab"}
    for no in range(1, 5):
        for s in "ab":
            for lid in range(0, 400):
                k = lid * 977 + (s == "b")
                if rnd.random() < 0.05:
                    state[s].pop(k, None)
                elif k not in state[s] and rnd.random() < 0.3 or rnd.random() < 0.02:
                    state[s][k] = f"name {rnd.randrange(9)}"
            rows += [row(no, k, s, name=v) for k, v in state[s].items()]
    by = {}
    for r in rows:
        by.setdefault((r[3], r[0]), {})[r[2]] = r[5]
    want = []
    for s in "ab":
        for no in range(2, 5):
            old, new = by.get((s, no - 1), {}), by.get((s, no), {})
            want += [(no, k, "added") for k in new.keys() - old.keys()] + [(no, k, "removed") for k in old.keys() - new.keys()]
            want += [(no, k, "changed") for k in new.keys() & old.keys() if new[k] != old[k]]
    assert changes(spark, rows, [(n, s) for n in range(1, 5) for s in "ab"]) == sorted(want)


def test_url_report(spark):
    same = lambda r, url: (*r[:4], url, *r[5:])
    rows = [row(1, 1), row(2, 2), row(1, 3), row(2, 3, name="m"), same(row(1, 4, name="q"), "v"), same(row(2, 4, name="r"), "v"), same(row(1, 5, name="q"), "v"), same(row(2, 5, name=" q "), "v")]
    s = spark.createDataFrame(rows, SCHEMA)
    d = spark.createDataFrame([(1, "a"), (2, "a")], "snapshot_no int, distributor string")
    got = {r.url: (r.added, r.removed, r.changed, r.old_rows, r.new_rows, r.only_old_names, r.only_new_names) for r in snapshots.url_report(s, d).collect()}
    # the name q of url v stays on both sides through the unchanged listing 5
    assert got == {"u1": (0, 1, 0, 1, 0, 1, 0), "u2": (1, 0, 0, 0, 1, 0, 1), "u3": (0, 0, 1, 1, 1, 1, 1), "v": (0, 0, 1, 2, 2, 0, 1)}
    names = sorted((r.url, r.side, r.name, r.rows) for r in snapshots.url_only_names(s, d).collect())
    assert names == [("u1", "old", "n", 1), ("u2", "new", "n", 1), ("u3", "new", "m", 1), ("u3", "old", "n", 1), ("v", "new", "r", 1)]


def test_keys_of_other_types_and_sparse_ones(spark):
    for kind, key in (("string", lambda i: f"k{i}"), ("bigint", lambda i: i * 10**12)):
        rows = [(1, "a", key(i), "x", 0) for i in range(50)] + [(2, "a", key(i), "y" if i == 7 else "x", 0) for i in range(1, 51)]
        df = spark.createDataFrame(rows, f"no int, src string, id {kind}, v string, o int")
        d = spark.createDataFrame([(1, "a"), (2, "a")], "no int, src string")
        got = snapshots.snapshot_changes(df, d, source="src", snapshot="no", key="id", order="o", content=[F.col("v")], block_rows=16, chunk_rows=4)
        assert sorted((r.id, r.change_kind) for r in got.collect()) == sorted([(key(0), "removed"), (key(50), "added"), (key(7), "changed")])


def test_row_counts_of_every_delivery_and_none_of_undelivered_snapshots(spark):
    rows = [row(1, 1), row(1, 2), row(3, 2), row(3, 2), row(4, 2), row(4, 3), row(1, 9, "b"), row(2, 9, "b"), row(2, 8, "b")]
    s = spark.createDataFrame(rows, SCHEMA)
    d = spark.createDataFrame([(1, "a"), (3, "a"), (4, "a"), (1, "b"), (2, "b")], "snapshot_no int, distributor string")
    got = {(r.distributor, r.snapshot_no, r.url): (r.old_rows, r.new_rows, r.outcome) for r in snapshots.url_row_counts(s, d).collect()}
    assert got == {
        ("a", 3, "u1"): (1, 0, "missing"), ("a", 3, "u2"): (1, 2, "row_count"), ("a", 4, "u2"): (2, 1, "row_count"), ("a", 4, "u3"): (0, 1, "added"),
        ("b", 2, "u9"): (1, 1, "same"), ("b", 2, "u8"): (0, 1, "added"),
    }

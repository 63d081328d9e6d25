"""Queries on small tables that larger ones showed to be wrong, or too dear."""

from __future__ import annotations

import os

import duckdb
import pytest
from compare import TABLES, connect, difference

from gleanery.plans.registry import ORACLE_SQL, QUERIES


@pytest.fixture
def folder(tmp_path, sf_dir):
    """A data folder with some tables of its own, told as SQL, and the others as they are."""

    def make(**own: str) -> str:
        for name in TABLES:
            if name in own:
                duckdb.connect().execute(f"COPY ({own[name]}) TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
            else:
                os.symlink(f"{sf_dir}/{name}.parquet", f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return make


@pytest.mark.parametrize("name", ["value_queue", "queue_summary"])
def test_prices_at_a_half_are_rounded_alike(spark, folder, name):
    # each user's cost over 24 days ends in half a ten-thousandth: 872.31 / 24 = 36.34625 and others
    events = """SELECT u * 100 + d AS event_id, TIMESTAMP '2024-01-01' + to_days(CAST(d AS INTEGER)) AS ts, u AS user_id, CASE WHEN d % 2 = 0 THEN 'purchase' ELSE 'click' END AS event_type,
        CASE WHEN d = 0 THEN (87231 + u * 6) / 100 ELSE 0.0 END AS value, '{"k": ' || d || '}' AS props FROM range(3000) a(u), range(24) b(d)"""
    path = folder(events=events)
    found = QUERIES[name](spark, path).toPandas()
    assert difference(found, connect(path).execute(ORACLE_SQL[name]).df()) == ""
    if name == "value_queue":
        prices = {int(r.id[1:]): r.usd_per_fetch for r in found.itertuples()}
        assert prices == {u: ((87231 + u * 6) * 200 + 24) // 48 / 10000 for u in range(3000)}


def test_overlaps_shuffle_no_pairs(spark):
    from gleanery.operators import yields

    told = [(f"s{(n * 7) % 41}", f"k{n % 13}") for n in range(300)] + [("s1", None), (None, "k1"), ("s1", "k1"), ("s1", "k1")]
    df = yields.overlaps_of(spark.createDataFrame(told, "source string, key string"))
    has = {(s, k) for s, k in told if s and k}
    want: dict = {}
    for s, k in has:
        for t, m in has:
            if k == m and s != t:
                want[s, t] = want.get((s, t), 0) + 1
    assert {(r.a, r.b): r.n for r in df.collect()} == want
    assert "hashpartitioning(a#" not in df._jdf.queryExecution().executedPlan().toString()  # pairs were shuffled by both ends before


def test_hits_of_one_host_make_no_pairs(spark):
    from gleanery.operators import discovery

    keys = ["h/a", "h/a/b", "h/a/b/c", "h/x", "h", "", None, "h/ab", "h/a"]
    p = [(n, k, h) for n, (k, h) in enumerate((k, h) for k in keys for h in ("h", "g", None))]
    q = [(n * 2, 50 - n % 7, k, h) for n, (k, h) in enumerate((k, h) for k in (*keys[:4], "h/a/bb", None, "h/y") for h in ("h", None))]
    proposals, hits = spark.createDataFrame(p, "proposal_id long, key string, host string"), spark.createDataFrame(q, "hit_id long, hit_pos long, hit_key string, hit_host string")
    tier = lambda a, b: 2 if a is None or b is None else 0 if a == b else 1 if a.startswith(b) or b.startswith(a) else 2
    want = {i: min((tier(k, hk), pos, j) for j, pos, hk, hh in q if hh == h) for i, k, h in p if h == "h"}
    df = discovery.match_hit(proposals, hits)
    assert {r.proposal_id: (r.tier, r.hit_id) for r in df.collect()} == {i: (t, j) for i, (t, _, j) in want.items()}
    many = lambda n, **names: spark.range(n).select(*[e.alias(c) for c, e in names.items()])
    from pyspark.sql import functions as F

    n = 100_000  # 10,000,000,000 pairs before
    proposals = many(n, proposal_id=F.col("id"), key=F.concat(F.lit("h/p"), "id"), host=F.lit("h"))
    hits = many(n, hit_id=F.col("id"), hit_pos=F.col("id"), hit_key=F.concat(F.lit("h/q"), "id"), hit_host=F.lit("h"))
    assert discovery.match_hit(proposals, hits).where("tier = 2 and hit_id = 0").count() == n


def test_batches_count_items_before_they_meet_orders(spark, folder):
    orders = "SELECT k AS o_orderkey, k AS o_custkey, CASE WHEN k % 2 = 0 THEN 'P' ELSE 'O' END AS o_orderstatus, 1.0 AS o_totalprice, TIMESTAMP '1996-01-01' AS o_orderdate, '5-LOW' AS o_orderpriority FROM (SELECT range % 40 AS k FROM range(60))"
    items = "SELECT range % 45 AS l_orderkey, 1 AS l_partkey, 1 AS l_suppkey, range % 8 AS l_linenumber, 1.0 AS l_quantity, 1.0 AS l_extendedprice, 0.0 AS l_discount, 0.0 AS l_tax, CASE range % 3 WHEN 0 THEN 'R' WHEN 1 THEN 'N' END AS l_returnflag, 'O' AS l_linestatus, TIMESTAMP '1996-01-01' AS l_shipdate FROM range(200)"
    path = folder(orders=orders, lineitem=items)
    found = QUERIES["batch_routes"](spark, path)
    assert difference(found.toPandas(), connect(path).execute(ORACLE_SQL["batch_routes"]).df()) == ""
    assert found._jdf.queryExecution().sparkPlan().toString().count("FileScan parquet") == 2  # the items were read twice before


def test_rhythms_deal_no_events(spark):
    from pyspark.sql import functions as F

    from gleanery.operators import series

    events = spark.range(100).select("id", F.lit("2026-08-03").cast("date").alias("date_start"), F.lit("2026-08-09").cast("date").alias("date_end"), F.when(F.col("id") % 2 == 0, "pn; śr").alias("repeat"))
    df = series.expand_repeat(events, F.lit("2026-08-01").cast("date"))
    assert df.count() == 150
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()  # all events of one rhythm met in one task before


def test_sources_of_the_same_stems_make_no_pairs(spark):
    from pyspark.sql import functions as F

    from gleanery.operators import discovery

    rows = lambda own, n, shift: spark.range(n).select((F.col("id") + shift).alias(own), F.lit("t").alias("town"), F.explode(F.array(*map(F.lit, "abc"))).alias("stem"))
    rare = spark.createDataFrame([("t", "a")], "town string, stem string")
    n = 60_000  # 10,800,000,000 shared rows before
    found = discovery.best_peer(rows("page_id", n, 0), rows("peer_id", n, 100_000), rare)
    assert found.where("peer_id = 100000 and score = 5").count() == n


def test_long_texts_reach_python_in_small_batches(spark):
    from pyspark.sql import functions as F

    from gleanery.functions import parsing

    df = spark.createDataFrame([('[{"a": "}"}, {"b": {"c": 1}}, {"d"',), (None,)], "j string").select(parsing.salvaged(F.col("j")).alias("o"))
    assert [r.o for r in df.collect()] == [['{"a": "}"}', '{"b": {"c": 1}}'], []]
    assert "ArrowEvalPython" not in df._jdf.queryExecution().executedPlan().toString()  # ten thousand texts at once before


def test_bodies_are_made_once_for_three_parsers(spark, sf_dir):
    plan = QUERIES["capabilities"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan  # bodies were put together for each parser, nine times in all


def test_texts_are_dealt_before_they_are_judged(spark, sf_dir):
    from pyspark.sql import functions as F

    from gleanery.functions.chrome import looks_like_chrome

    plan = QUERIES["segment"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [xxhash64" in plan  # a file of one row group was one task
    told = {"Zwykły tekst bez niczego": False, "Polityka  Prywatności, pliki cookies": True, "BIP": True, "rodo 12:30 bip": False, "bip rodo": True, "12.05.2024": False, "": False, None: False, "Menu\nSzukaj": True}
    rows = spark.createDataFrame([(t,) for t in told], "t string").select("t", looks_like_chrome(F.col("t")).alias("c"))
    assert {r.t: r.c for r in rows.collect()} == told


def test_links_of_titles_read_rows_that_are_written(spark, sf_dir, monkeypatch):
    from gleanery.operators import dedupe

    seen = []
    monkeypatch.setattr(dedupe, "title_links", lambda rows: seen.append(rows) or spark.createDataFrame([], "a long, b long"))
    QUERIES["title_components"](spark, sf_dir)
    assert "Aggregate" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()  # keys were grouped anew for each of their readers before


def test_titles_that_hold_many_hang_on_one_of_them(spark):
    from pyspark.sql import functions as F

    from gleanery.operators import dedupe, graph

    # 200 titles of two words, and 40 that hold all of these words, each with one of its own
    words = [f"word{k:03}" for k in range(20)]
    short = [(k, f"{words[k % 20]} {words[(k + 1 + k // 20) % 20]}") for k in range(200)]
    told = short + [(1000 + k, " ".join([*words, f"only{k:03}"])) for k in range(40)] + [(5000, "nothing else"), (5001, "nothing else"), (6000, "quite alone")]
    df = spark.createDataFrame(told, "pos long, n string").select("pos", F.lit("A").alias("bucket"), "n", F.split("n", " ").alias("t"), F.array().cast("array<string>").alias("v"), F.lit("2026-08-01").cast("date").alias("date_start"), F.lit("2026-08-01").cast("date").alias("date_end"))
    rows = dedupe.classes(df)
    assert rows.where("pos = 5001").first().class_id == 5000
    links = dedupe.title_links(rows)
    assert links.count() < 400  # 8,000 and more before: each with all that it holds
    found = {r.id: r.component for r in graph.components(links).collect()}
    classes = {r.class_id for r in rows.select("class_id").collect()}
    assert found == {k: 0 for k in classes if k < 5000}


"""Follow-up pages, the registry's verdicts and state, and its stream with timers."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from gleanery.operators import followups, normalise, registry

D = dt.date.fromisoformat


def today():
    return F.lit("2026-08-20").cast("date")

# follow-ups


def queued(spark, urls, events=(), muted=(), same=(), limit=7, source="s"):
    p = spark.createDataFrame([(source, k, u) for k, u in enumerate(urls)], "source_id string, pos int, url string")
    e = spark.createDataFrame([(source, *x) for x in events], "source_id string, source_url string, venue string, time_start string")
    m = spark.createDataFrame([(h,) for h in muted], "host string")
    s = spark.createDataFrame([(source, k, D(d)) for k, d in same], "source_id string, url_key string, at date")
    rows = followups.queue(p, e, m, s, today(), limit).collect()
    return {r.url: r.verdict for r in rows}, [r.url for r in sorted(rows, key=lambda r: r["rank"] or 0) if r["rank"]]


def test_lacking_addresses_come_first_and_order_stays(spark):
    urls = [f"https://x.pl/{c}" for c in "abcde"]
    verdicts, taken = queued(spark, urls, [("https://www.x.pl/d/", "", "18:00"), ("https://x.pl/b", "Sala", "18:00"), ("https://x.pl/e", "Sala", None)], limit=3)
    assert taken == [urls[3], urls[4], urls[0]]
    assert verdicts[urls[1]] == verdicts[urls[2]] == "over"


def test_muted_hosts_and_the_page_itself_take_no_place(spark):
    urls = ["https://m.pl/1", "https://x.pl/lista?page=1", "https://x.pl/2"]
    verdicts, taken = queued(spark, urls, muted=["m.pl"], same=[("x.pl/lista?page=1", "2026-08-01")])
    assert verdicts == {urls[0]: "muted", urls[1]: "same-page", urls[2]: "taken"} and taken == [urls[2]]
    # a verdict that has grown old holds no more
    assert queued(spark, urls[1:2], same=[("x.pl/lista?page=1", "2026-07-01")])[0] == {urls[1]: "taken"}
    assert followups.known_same(spark.createDataFrame([("s", "k", D("2026-08-20"))], "source_id string, url_key string, at date"), today(), 0).count() == 0


def test_entrypoint_comes_first_unless_known(spark):
    taken = spark.createDataFrame([("s", 1, "https://x.pl/a", "x.pl/a"), ("s", 2, "https://x.pl/b", "x.pl/b"), ("t", 1, "https://t.pl/a", "t.pl/a"), ("u", 1, "https://u.pl/w", "u.pl/w")], "source_id string, rank int, url string, url_key string")
    entries = spark.createDataFrame([("s", "https://x.pl/kalendarz", "https://x.pl/"), ("t", "https://t.pl/", "http://www.t.pl"), ("u", "https://u.pl/w/", "https://u.pl/"), ("v", "https://v.pl/e", "https://v.pl/")], "source_id string, url string, page_url string")
    same = spark.createDataFrame([("v", "v.pl/e", D("2026-08-19"))], "source_id string, url_key string, at date")
    rows = followups.with_entrypoints(taken, entries, same, today(), 2).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        got.setdefault(r.source_id, []).append((r.url_key, r.via))
    assert got == {"s": [("x.pl/kalendarz", "entrypoint"), ("x.pl/a", "proposal")], "t": [("t.pl/a", "proposal")], "u": [("u.pl/w", "proposal")]}


def test_outcomes_and_what_they_leave(spark):
    taken = spark.createDataFrame([("s", k) for k in ("new", "same", "hash", "304", "304-unknown", "down", "gone")], "source_id string, url_key string")
    captures = spark.createDataFrame([("new", "h1", False, False, 4), ("same", "page", False, False, 9), ("hash", "old", False, False, 7), ("304", None, True, False, 0), ("304-unknown", None, True, False, 0), ("down", None, False, True, 0)], "url_key string, hash string, not_modified boolean, failed boolean, events int")
    cache = spark.createDataFrame([("same", "x", 3), ("hash", "old", 2), ("304", "y", 5), ("other", "z", 1)], "url_key string, hash string, events int")
    pages = spark.createDataFrame([("s", "page")], "source_id string, page_hash string")
    told = followups.outcomes(taken, captures, pages, cache)
    assert {r.url_key: (r.outcome, r.events) for r in told.collect()} == {"new": ("ok", 4), "same": ("same-as-page", 0), "hash": ("unchanged", 2), "304": ("unchanged", 5), "304-unknown": ("error", 0), "down": ("error", 0), "gone": ("error", 0)}
    assert {r.url_key: (r.hash, r.events) for r in followups.next_cache(cache, told).collect()} == {"new": ("h1", 4), "hash": ("old", 2), "304": ("y", 5), "other": ("z", 1)}
    before = spark.createDataFrame([("s", "same", D("2026-01-01")), ("s", "b", D("2026-01-01"))], "source_id string, url_key string, at date")
    assert {(r.url_key, str(r.at)) for r in followups.next_same_page(before, told, today()).collect()} == {("same", "2026-08-20"), ("b", "2026-01-01")}


def expanded(spark, seeds, links, *args):
    s = spark.createDataFrame(seeds, "source_id string, url_key string")
    e = spark.createDataFrame(links, "url_key string, pos int, to_key string")
    return sorted((r.source_id, r.hop, r["rank"], r.url_key, r.parent) for r in followups.expand(s, e, *args).collect())


def test_links_are_followed_once_in_order(spark):
    links = [("a", 0, "a"), ("a", 1, "c"), ("a", 2, "b"), ("a", 3, "b"), ("a", 4, None), ("b", 0, "a"), ("b", 1, "d"), ("c", 5, "d"), ("d", 0, "e")]
    assert expanded(spark, [("s", "a"), ("s", "a"), (None, "a"), ("t", None)], links, 2) == [("s", 0, 1, "a", None), ("s", 1, 1, "c", "a"), ("s", 1, 2, "b", "a"), ("s", 2, 1, "d", "c")]
    assert [r[3] for r in expanded(spark, [("s", "a")], links, 9)] == ["a", "c", "b", "d", "e"]
    assert expanded(spark, [], links, 2) == []


def test_caps_of_source_and_run(spark):
    links = [("a", k, f"a{k}") for k in range(5)] + [("b", k, f"b{k}") for k in range(5)] + [("a0", 0, "z")]
    got = expanded(spark, [("s", "a"), ("t", "b")], links, 2, 2, 3)
    assert [(r[0], r[3]) for r in got if r[1]] == [("s", "a0"), ("s", "a1"), ("t", "b0")]  # the run's share is used up by the first hop
    assert [(r[0], r[1], r[3]) for r in expanded(spark, [("s", "a"), ("t", "b")], links, 2, 2, 5) if r[1] == 2] == [("s", 2, "z")]


# registry


def probe(spark, **over):
    base = {"url": "http://x.pl/", "fetch": "plain", "reach": "ok", "answered": True, "reached_url": "http://x.pl/", "reached_fetch": "plain", "can_search": False, "candidate": None, "candidate_reach": None, "candidate_url": None, "verdict": None, "dated": None, "is_new": False, "harvested": 0}
    schema = "url string, fetch string, reach string, answered boolean, reached_url string, reached_fetch string, can_search boolean, candidate string, candidate_reach string, candidate_url string, verdict string, dated boolean, is_new boolean, harvested int"
    r = registry.verdicts(spark.createDataFrame([tuple((base | over).values())], schema)).first()
    return r.outcome, r.new_url, r.why


DOWN = {"answered": False, "reached_url": None, "reached_fetch": None}


def test_verdicts_on_probes(spark):
    assert probe(spark) == ("ok", None, "answered")
    assert probe(spark, fetch="fb_group", **DOWN) == ("skipped", None, "not-probed")
    # an address that moved is registered anew, one that is a template keeps its page
    assert probe(spark, reached_url="https://x.pl/nowa") == ("fixed", "https://x.pl/nowa", "moved")
    assert probe(spark, url="https://x.pl/l?page={page}", reached_url="http://x.pl/l?page=1") == ("fixed", "http://x.pl/l?page={page}", "moved")
    assert probe(spark, url="https://x.pl/l?page={page}", reached_url="https://x.pl/l?page=1") == ("ok", None, "answered")
    assert probe(spark, reached_fetch="headless") == ("fixed", None, "moved")
    # a dead domain is dead without a search, anything else waits for one
    assert probe(spark, reach="dns-dead", **DOWN) == ("dead", None, "unreachable")
    assert probe(spark, reach="http-error", **DOWN) == ("error", None, "no-search")
    assert probe(spark, reach="http-error", can_search=True, **DOWN) == ("dead", None, "unreachable")
    # harvest vetoes death, but only there
    assert probe(spark, reach="dns-dead", harvested=3, **DOWN) == ("error", None, "harvested")
    # replacements
    found = {"can_search": True, "candidate": "https://nowy.pl/", "candidate_reach": "ok", "candidate_url": "https://nowy.pl/start"}
    assert probe(spark, reach="dns-dead", **DOWN, **found) == ("fixed", "https://nowy.pl/start", "replaced")
    assert probe(spark, reach="dns-dead", **DOWN, **(found | {"candidate": "https://www.x.pl"})) == ("dead", None, "unreachable")
    assert probe(spark, reach="dns-dead", **DOWN, **(found | {"candidate_reach": "placeholder"})) == ("dead", None, "unreachable")
    assert probe(spark, reach="dns-dead", **DOWN, **(found | {"can_search": False})) == ("dead", None, "unreachable")
    # a profile without events kills new sources alone, and not against a feed with days
    assert probe(spark, verdict="none", is_new=True)[0::2] == ("dead", "no-events")
    assert probe(spark, verdict="none", is_new=True, dated=True)[0] == "ok"
    assert probe(spark, verdict="none")[0] == "ok"


def test_rebase(spark):
    of = lambda *u: spark.range(1).select(registry.rebase(*map(F.lit, u))).first()[0]
    assert of("https://x.pl/a?p={page}", "https://x.pl/a?p=1", "https://x.pl/a?p=1") == "https://x.pl/a?p={page}"
    assert of("https://x.pl/a?p={page}", "http://www.x.pl/a?p=1", "https://x.pl/a?p=1") == "http://www.x.pl/a?p={page}"
    assert of("https://x.pl/a?p={page}", "https://x.pl/b", "https://x.pl/a?p=1") == "https://x.pl/b"
    assert of("https://x.pl", "http://x.pl/", "https://x.pl") == "http://x.pl"


LOG = [("s", 1, "error", None), ("s", 2, "error", None), ("s", 3, "dead", None), ("s", 4, "ok", None), ("s", 16, "ok", None), ("s", 17, "error", None), ("s", 18, "fixed", "http://n/"), ("s", 150, "error", None), ("t", 2, "skipped", None), ("t", 3, "error", None), ("u", 1, "error", None), ("u", 2, "error", None), ("u", 3, "error", None), ("u", 17, "error", None), ("u", 18, "error", None), ("u", 31, "ok", None), ("w", 1, "error", None), ("w", 2, "error", None), ("w", 3, "error", None)]
WANT = [("s", 1, "tried", 1, False), ("s", 2, "tried", 2, False), ("s", 3, "tried", 3, True), ("s", 4, "resting", 3, True), ("s", 16, "resting", 3, True), ("s", 17, "tried", 4, True), ("s", 18, "resting", 4, True), ("s", 150, "tried", 1, False), ("t", 2, "tried", 0, False), ("t", 3, "tried", 1, False), ("u", 1, "tried", 1, False), ("u", 2, "tried", 2, False), ("u", 3, "tried", 3, False), ("u", 17, "tried", 4, False), ("u", 18, "resting", 4, False), ("u", 31, "tried", 0, False), ("w", 1, "tried", 1, False), ("w", 2, "tried", 2, False), ("w", 3, "tried", 3, False)]


def test_replay_rests_and_forgets(spark):
    log = spark.createDataFrame([(s, d, f"http://{s}/", o, n) for s, d, o, n in LOG], "source_id string, day long, url string, outcome string, new_url string")
    got = [(r.source_id, r.day, r.action, r.failures, r.dead) for r in registry.replay(log.repartition(3)).collect()]
    assert sorted(got) == WANT
    moved = registry.replay(spark.createDataFrame([("s", 1, "a", "fixed", "b"), ("s", 2, "a", "fixed", "c"), ("s", 3, "a", "ok", None), (None, 1, "a", "ok", None)], "source_id string, day long, url string, outcome string, new_url string"))
    assert [(r.url, r.n_former) for r in moved.orderBy("day").collect()] == [("b", 1), ("c", 2), ("c", 2)]


FIELDS = "source_id string, day long, url string, fetch string, reach string, answered boolean, reached_url string, reached_fetch string, can_search boolean, candidate string, candidate_reach string, candidate_url string, verdict string, dated boolean, is_new boolean, harvested int"


def as_probe(source, day, outcome):
    """A probe that gives this outcome."""
    url = f"http://{source}/"
    up = outcome in ("ok", "fixed")
    return {"source_id": source, "day": day, "url": url, "fetch": "fb" if outcome == "skipped" else "plain", "reach": "ok" if up else "dns-dead" if outcome == "dead" else "http-error", "answered": up, "reached_url": "http://n/" if outcome == "fixed" else url, "reached_fetch": "plain", "can_search": False, "is_new": False, "harvested": 0}


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.set(key, before)


def test_stream_with_timers_gives_the_batch_twin(spark, tmp_path, rocks):
    from gleanery.streaming.registry import registry_stream

    source = tmp_path / "in"
    source.mkdir()
    got = []
    for n, (first, last) in enumerate([(1, 3), (4, 17), (18, 150), (200, 200), (400, 400), (500, 500)]):
        rows = [as_probe(s, d, o) for s, d, o, _ in LOG if first <= d <= last] or [as_probe("z", first, "ok")]
        (source / f"{n}.json").write_text("\n".join(map(json.dumps, rows)))
        os.utime(source / f"{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))
    stream = registry_stream(spark.readStream.schema(FIELDS).option("maxFilesPerTrigger", 1).json(str(source)))
    q = stream.writeStream.foreachBatch(lambda b, _: got.extend(tuple(r) for r in b.collect())).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    assert q.awaitTermination(240)
    told = sorted((r[0], r[1], r[2], r[6], r[5]) for r in got if r[2] in ("tried", "resting") and r[0] != "z")
    assert told == WANT
    # timers: a rest that nobody ended, and entries that are forgotten after the last sight
    timers = {(r[0], r[1], r[2]) for r in got if r[2] in ("due", "forgotten")}
    assert {("t", 3 + 91, "forgotten"), ("u", 31 + 91, "forgotten"), ("s", 150 + 91, "forgotten"), ("w", 3 + 14, "due"), ("w", 3 + 91, "forgotten")} <= timers


# proposals


def normalised(spark, *bodies, town="Poznań"):
    df = spark.createDataFrame([(k, b if b is None or isinstance(b, str) else json.dumps(b), town) for k, b in enumerate(bodies)], "k int, body string, town string")
    return normalise.proposals(df).orderBy("k").collect()


def test_refusals(spark):
    rows = normalised(spark, None, '"x"', "42", "null", {"name": "A"}, {"url": "https://a.pl"}, {"url": "zobacz w google", "name": "A"}, {"url": "ftp://x", "name": "A"}, {"url": "https://", "name": "A"}, {"url": 5, "name": "A"})
    assert [r.refused for r in rows] == ["not-object"] * 4 + ["no-url", "no-name", "not-an-address", "not-an-address", "unparsable", "no-url"]
    assert all(r.id is None and r.url is None and r.fixes is None for r in rows)
    assert normalised(spark, {"url": "https://a.pl", "name": "???", "id": "!!!"}, town="!!!")[0].refused == "no-id"


def test_fixes_are_told_in_order(spark):
    good = {"name": "A", "fetch": "plain", "type": "library"}
    rows = normalised(
        spark,
        good | {"url": "https://a.pl"},
        {"url": "gok.lubon.pl", "name": "GOK", "fetch": "plain", "type": "culture_center"},
        {"url": "https://a.pl", "name": "A"},
        {"url": "https://www.facebook.com/groups/poznan123/posts/9/?ref=x", "name": "Grupa"},
        good | {"url": "https://www.facebook.com/DomKultury"},
        {"url": "https://a.pl", "name": "A", "fetch": "magia", "type": "cokolwiek"},
        good | {"url": "facebook.com/groups/x1"},
    )
    assert [(r.url, r.fetch, r.type, r.fixes) for r in rows] == [
        ("https://a.pl", "plain", "library", []),
        ("https://gok.lubon.pl", "plain", "culture_center", ["scheme"]),
        ("https://a.pl", "plain", "venue", ["unknown-fetch", "unknown-type"]),
        ("https://www.facebook.com/groups/poznan123", "fb_group", "fb_group", ["group-root", "group-fetch", "group-type"]),
        ("https://www.facebook.com/DomKultury", "fb", "library", ["page-fetch"]),
        ("https://a.pl", "plain", "venue", ["unknown-fetch", "unknown-type"]),
        ("https://www.facebook.com/groups/x1", "fb_group", "fb_group", ["scheme", "group-root", "group-fetch", "group-type"]),
    ]


def test_fields_of_proposals(spark):
    rows = normalised(spark, {"url": "https://a.pl/l?p={page}", "name": "Dom Kultury Łódź", "confidence": 1.7}, {"url": "https://a.pl", "name": "A", "confidence": -3, "town": "Mosina", "notes": " x "}, {"url": "https://a.pl", "name": "A", "confidence": "wysoka", "notes": ""}, town="Luboń")
    assert [(r.id, r.place, r.confidence, r.notes) for r in rows] == [("lubon-dom-kultury-lodz", "Luboń", 1.0, None), ("lubon-a", "Mosina", 0.0, "x"), ("lubon-a", "Luboń", None, None)]
    assert rows[0].url == "https://a.pl/l?p={page}" and rows[0].refused is None


def test_rules_are_data(spark):
    df = spark.createDataFrame([("a", 1), ("b", None)], "x string, y int")
    rules = (normalise.Rule("double", "y > 0", {"y": "y * 2", "x": "concat(x, y)"}), normalise.Rule("again", "y = 2", {"y": "y + 1"}))
    assert [tuple(r) for r in normalise.mended(df, rules).collect()] == [("a1", 3, ["double", "again"]), ("b", None, [])]

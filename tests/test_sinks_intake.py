"""Sinks that replays and stops don't change, providers' records, feeds as XML and nested JSON."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from gleanery.operators.durable import hadoop_path
from gleanery.sources import providers, syndication
from gleanery.streaming import sinks

D = dt.date.fromisoformat

# sinks


def table_of(spark, path):
    return sinks.BatchTable(spark, str(path), spark.createDataFrame([], "k string, v long").schema, ["k"])


def rows(spark, **values):
    return spark.createDataFrame(list(values.items()), "k string, v long")


def read(table):
    return {r.k: r.v for r in table.read().collect()}


def test_replayed_batches_change_nothing(spark, tmp_path):
    t = table_of(spark, tmp_path / "t")
    assert read(t) == {}
    assert t.write(rows(spark, a=1, b=1), 0) and t.write(rows(spark, b=2, c=2), 1)
    assert read(t) == {"a": 1, "b": 2, "c": 2}
    assert not t.write(rows(spark, a=99), 1) and not t.write(rows(spark, b=99), 0)
    assert read(t) == {"a": 1, "b": 2, "c": 2}
    t.fold()
    assert read(t) == {"a": 1, "b": 2, "c": 2} and not t.write(rows(spark, a=99), 1)
    assert t.write(rows(spark, a=3), 2) and read(t) == {"a": 3, "b": 2, "c": 2}
    t.fold()
    t.fold()
    assert read(table_of(spark, tmp_path / "t")) == {"a": 3, "b": 2, "c": 2}


def test_a_stop_between_write_and_commit_leaves_no_trace(spark, tmp_path, monkeypatch):
    t = table_of(spark, tmp_path / "t")
    t.write(rows(spark, a=1), 0)

    def stop(*_):
        raise RuntimeError("stopped")

    monkeypatch.setattr(t, "_enter", stop)
    with pytest.raises(RuntimeError):
        t.write(rows(spark, a=5, b=5), 1)
    monkeypatch.undo()
    assert read(t) == {"a": 1} and not t.committed(1)
    assert t.write(rows(spark, a=5, b=5), 1) and read(t) == {"a": 5, "b": 5}


def test_stream_into_a_table_started_twice(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n, v in enumerate(({"a": 1, "b": 1}, {"b": 2})):
        rows(spark, **v).coalesce(1).write.parquet(str(tmp_path / f"in/{n}"))
    t = table_of(spark, tmp_path / "t")
    stream = spark.readStream.schema("k string, v long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    for checkpoint in ("c1", "c2"):  # the second start has lost its place and sends every batch again
        q = stream.writeStream.foreachBatch(t.sink).option("checkpointLocation", str(tmp_path / checkpoint)).trigger(availableNow=True).start()
        assert q.awaitTermination(120)
        assert read(t)["a"] == 1 and len(t._ledger()) == 2


def files_of(spark, path):
    where, files = hadoop_path(spark, str(path))
    found, it = [], files.listFiles(where, True)
    while it.hasNext():
        found.append(it.next().getPath().getName() if False else str(it.next().getPath()))
    return sorted(f for f in found if "_draft-" not in f)


def test_dry_runs_side_by_side_leave_the_table_alone(spark, tmp_path):
    t = table_of(spark, tmp_path / "t")
    t.write(rows(spark, a=1, b=1), 0)
    t.write(rows(spark, b=2), 1)
    before = files_of(spark, tmp_path / "t")
    one, two = t.snapshot(), t.snapshot()
    one.forget(F.col("k") == "b")
    one.write(rows(spark, c=7), 0)
    two.write(rows(spark, a=9), 0)
    two.write(rows(spark, a=10), 1)
    t.write(rows(spark, d=4), 2)  # a version that the drafts don't see
    assert read(one) == {"a": 1, "c": 7} and read(two) == {"a": 10, "b": 2}
    with pytest.raises(Exception, match="zero|ZERO"):
        two.write(spark.range(3).select(F.lit("x").alias("k"), F.raise_error(F.lit("zero")).cast("long").alias("v")), 2)
    assert read(two) == {"a": 10, "b": 2}
    one.drop()
    two.drop()
    assert read(t) == {"a": 1, "b": 2, "d": 4} and set(before) <= set(files_of(spark, tmp_path / "t"))


def captures(spark, *told):
    return spark.createDataFrame([(D(d) if d else None, s, b, n) for d, s, b, n in told], "day date, source_id string, body string, seen long")


def test_archive_by_content(spark, tmp_path):
    path = str(tmp_path / "archive")
    first = captures(spark, ("2026-08-01", "s", "x", 3), ("2026-08-01", "s", "x", 1), ("2026-08-01", "t", "x", 2), (None, "s", "x", 1), ("2026-08-01", None, "x", 1), ("2026-08-01", "s", None, 1))
    sinks.archive(first, path)
    state = lambda: sorted((str(r.day), r.source_id, r.body, r.seen) for r in sinks.read_archive(spark, path).collect())
    assert state() == [("2026-08-01", "s", "x", 1), ("2026-08-01", "t", "x", 2)]
    t_files = files_of(spark, f"{path}/day=2026-08-01/source_id=t")
    second = captures(spark, ("2026-08-01", "s", "y", 5), ("2026-08-01", "s", "x", 6), ("2026-08-03", "s", "x", 7))
    for _ in range(2):
        sinks.archive(second, path)
        assert state() == [("2026-08-01", "s", "x", 1), ("2026-08-01", "s", "y", 5), ("2026-08-01", "t", "x", 2), ("2026-08-03", "s", "x", 7)]
    assert files_of(spark, f"{path}/day=2026-08-01/source_id=t") == t_files  # untouched folders keep their files
    assert [str(r.day) for r in sinks.archived_days(spark, path, 1).collect()] == ["2026-08-03"]
    assert {(r.source_id, r.n_days, r.n_bodies) for r in sinks.archived_sources(spark, path, F.lit("2026-08-01").cast("date"), F.lit("2026-08-02").cast("date")).collect()} == {("s", 1, 2), ("t", 1, 1)}
    assert {(r.source_id, r.seen) for r in sinks.latest_captures(spark, path).collect()} == {("s", 7), ("t", 2)}
    plan = sinks.read_archive(spark, path).where("source_id = 't'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source_id" in plan


def test_archive_costs_a_file_a_folder_and_nothing_for_a_batch_sent_again(spark, tmp_path):
    day, month = str(tmp_path / "day"), str(tmp_path / "month")
    first = captures(spark, *[("2026-08-01", "s", f"x{n}", n) for n in range(50)], *[(f"2026-08-{d:02d}", "t", f"y{n}", n) for d in range(1, 29) for n in range(2)])
    sinks.archive(first, day)
    sinks.archive(first, month, "month")
    data = lambda path: [f for f in files_of(spark, path) if f.endswith(".parquet")]
    assert len(data(day)) == 29 and len(data(month)) == 2  # 16 files a folder before, by the hash's first digit
    before = files_of(spark, month)
    sinks.archive(first, month, "month")
    assert files_of(spark, month) == before  # all touched folders were written anew before
    sinks.archive(captures(spark, ("2026-08-02", "t", "y0", -1)), month, "month")
    assert [f for f in data(month) if "source_id=s" in f] == [f for f in before if f.endswith(".parquet") and "source_id=s" in f]
    state = lambda path: {(str(r.day), r.source_id, r.body, r.seen) for r in sinks.read_archive(spark, path).collect()}
    assert state(month) == state(day) - {("2026-08-02", "t", "y0", 0)} | {("2026-08-02", "t", "y0", -1)}
    told = lambda path: {(r.source_id, r.n_days, r.n_bodies) for r in sinks.archived_sources(spark, path, F.lit("2026-08-20").cast("date"), F.lit("2026-08-28").cast("date")).collect()}
    assert told(month) == told(day) == {("t", 9, 2)}


def test_usage_lines_and_snapshots(spark, tmp_path):
    line = spark.createDataFrame([("r1", 0.5)], "run string, usd double")
    path = str(tmp_path / "usage")
    assert sinks.append_usage(spark, line, path, "r1") and not sinks.append_usage(spark, line, path, "r1") and sinks.append_usage(spark, line, path, "r2")
    assert spark.read.json(path).count() == 2
    for n in (1, 2):
        sinks.save_snapshot(rows(spark, a=n), str(tmp_path / "events"))
    assert [r.v for r in sinks.load_snapshot(spark, str(tmp_path / "events")).collect()] == [2]


# providers


def drafted(spark, *bodies):
    return providers.drafts(spark.createDataFrame([(k, b) for k, b in enumerate(bodies)], "id int, body string"))


def test_fields_go_by_many_names(spark):
    a, b, c, d = drafted(
        spark,
        '{"name": "  Koncert ", "start_date": "2026-08-21T18:00:00Z", "end_date": "2026-08-22", "location": "Sala", "address": "ul. X 1, 61-000 Poznań", "ticket_url": "https://b.pl", "url": "https://f.pl/1"}',
        '{"name": "", "title": 5, "startDate": 1787335200, "venue": "Klub, ul. Y", "full_address": "ul. Y", "city": "Luboń", "event_type": "Film"}',
        '{"name": {"x": 1}, "event_name": true, "start": "wkrótce"}',
        "nothing",
    ).orderBy("id").collect()
    assert (a.title, str(a.date_start), a.time_start, str(a.date_end), a.time_end, a.venue, a.town, a.tag, a.registration, a.source_url) == ("Koncert", "2026-08-21", "18:00", "2026-08-22", None, "Sala, ul. X 1, 61-000 Poznań", "Poznań", "fb:wydarzenie", "https://b.pl", "https://f.pl/1")
    assert (b.title, str(b.date_start), b.time_start, b.venue, b.town, b.tag) == ("5", "2026-08-21", None, "Klub, ul. Y", "Luboń", "fb:film")
    assert (c.title, c.date_start, d.title, d.venue) == (None, None, None, "")


def test_drops_are_counted_while_rows_go_by(spark):
    told = drafted(spark, '{"name": "A", "start": "2026-08-21", "end": "2026-08-21"}', '{"name": "B", "start": "2026-08-01", "end": "2026-08-20"}', '{"name": "C", "start": "2026-08-01"}', '{"name": "D"}', '{"start": "2026-08-01"}', "{}", '{"name": "E", "start": "2026-13-01"}')
    counts = Observation("drops")
    kept = sorted(providers.to_events(told, F.lit("2026-08-20").cast("date"), counts).collect(), key=lambda r: r.id)
    assert [(r.title, r.date_end) for r in kept] == [("A", None), ("B", D("2026-08-20"))]
    assert counts.get == {"seen": 7, "kept": 2, "no_title": 2, "no_date": 2, "past": 1}


def test_whole_days_have_no_times(spark):
    df = spark.createDataFrame([("00:00", "23:59"), ("00:00", None), ("00:00", "12:00"), ("18:00", None)], "time_start string, time_end string")
    assert [tuple(r) for r in providers.whole_days(df).collect()] == [(None, None), (None, None), ("00:00", "12:00"), ("18:00", None)]


# feeds

def today():
    return F.lit("2026-08-01").cast("date")


def dated(spark, *records):
    df = spark.createDataFrame([(k, r) for k, r in enumerate(records)], "id int, body string")
    return [r.has_date for r in syndication.with_event_date(df, "id", "body", today()).orderBy("id").collect()]


def test_days_of_events_in_nested_records(spark):
    assert dated(
        spark,
        '{"id": 85193, "date": "2026-07-29T10:04:31", "modified": "2026-08-29", "title": {"rendered": "Fest | 23.08"}, "acf": [], "meta": {"_acf_changed": false}}',
        '{"id": 7, "date": "2026-07-01T09:00:00", "start_date": "2026-08-15 18:00:00"}',
        '{"id": 7, "meta": {"mec_start_date": "2026-08-15"}}',
        '{"start_position": 3}',
        '{"a": {"b": {"c": {"d": {"start_date": "2026-08-15"}}}}}',
        '{"a": {"b": {"c": {"start_date": "2026-08-15"}}}}',
        '{"id": 7, "start_date": "2026-06-15 18:00:00"}',
        '{"x": [{"y": 1}, {"termin": "2026-09-01"}]}',
        '{"date": {"start": "2026-09-01"}}',
        '{"dtstart": 1787335200000, "k": null}',
        "not json",
    ) == [False, True, True, False, False, True, False, True, False, True, False]


@pytest.mark.parametrize(("text", "days"), [("05.09.2026 oraz 2026-10-11 i 7 grudnia", ["2026-09-05", "2026-10-11", "2026-12-07"]), ("5 lipca", ["2026-07-05"]), ("31.02.2026, 3 Października", ["2026-10-03"]), ("w dniu 5/9/2026", ["2026-09-05"]), ("bez terminu", []), (None, [])])
def test_days_in_texts(spark, text, days):
    df = spark.createDataFrame([(text,)], "t string").select(syndication.event_dates(F.col("t"), today()).alias("d"))
    assert [str(x) for x in df.first().d] == days


def test_items_of_feeds(spark):
    rss = '<?xml version="1.0"?><rss version="2.0"><channel><title>k</title>{}</channel></rss>'
    item = "<item><title>{}</title><pubDate>Thu, 30 Jul 2026 21:24:07 +0200</pubDate><description>{}</description></item>"
    bodies = [
        ("none", rss.format(item.format("Tytuł", "Zapraszamy na warsztaty."))),
        ("cdata", rss.format(item.format("Tytuł", "<![CDATA[<p>odbędzie się w&nbsp;dniu 05.09.2026</p>]]>"))),
        ("mixed", rss.format(item.format("Fest 23.08.2026", "") + item.format("Relacja", "z pikniku 5 lipca") + item.format("Koncert", "15 września"))),
        ("atom", '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title type="html">Piknik</title><summary>12.08.2026</summary></entry><entry><title>Piknik</title><content type="html">bez terminu</content></entry></feed>'),
        ("cut", rss.format(item.format("Tytuł", "12.08.2026"))[:-9]),
        ("page", "<html><body>12.08.2026</body></html>"),
    ]
    got = {r.source_id: (r.kind, r.items_seen, r.dates_parsed) for r in syndication.probe_feeds(spark.createDataFrame(bodies, "source_id string, body string"), today()).collect()}
    assert got == {"none": ("rss", 1, 0), "cdata": ("rss", 1, 1), "mixed": ("rss", 3, 2), "atom": ("atom", 2, 1), "cut": ("malformed", 0, 0)}


def test_candidates_of_feeds(spark):
    pages = [("g", "https://gok.pl/", '<link rel="alternate" type="application/rss+xml" href="/rss/aktualnosci_pl.xml">'), ("x", "https://x.pl/a/b?c", "<link type='application/atom+xml' href='https://x.pl/feed/'><link type=\"application/rss+xml\" href=\"r.xml\"><link type='application/rss+xml' href='//y.pl/f'>"), ("n", "https://n.pl", None)]
    rows = syndication.feed_candidates(spark.createDataFrame(pages, "source_id string, url string, html string")).orderBy("source_id", "place").collect()
    urls = {s: [r.url for r in rows if r.source_id == s] for s in "gxn"}
    assert urls["g"] == ["https://gok.pl/rss/aktualnosci_pl.xml", "https://gok.pl/feed", "https://gok.pl/rss.xml", "https://gok.pl/aktualnosci.xml", "https://gok.pl/rss/wydarzenia_pl.xml"]
    assert urls["x"][:3] == ["https://x.pl/feed/", "https://x.pl/a/r.xml", "https://y.pl/f"] and "https://x.pl/feed" not in urls["x"] and len(urls["x"]) == 7
    assert urls["n"] == ["https://n.pl" + p for p in syndication.GUESSED]

"""Cases of the event operators that tables of line items don't have."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gleanery.config import EngineConfig
from gleanery.functions import chrome, dates, redact, text, urls
from gleanery.operators import blocks, budget, dedupe, filters, retention, series, yields
from gleanery.sources import feeds

D = dt.date.fromisoformat


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1)]).select(column).first()[0]


def events(spark, rows):
    schema = "pos long, title string, venue string, town string, date_start date, date_end date, richness long"
    return spark.createDataFrame([(p, t, v, w, D(s), D(e) if e else None, r) for p, t, v, w, s, e, r in rows], schema)


def winners(spark, rows):
    return {r.pos: r.winner_pos for r in dedupe.by_containment(events(spark, rows), "town").collect()}


def test_containment(spark):
    day = "2026-08-01"
    film, cycle = "SEANS KINA PLENEROWEGO: CICHA DZIEWCZYNA", "10. LATO Z ESTRADĄ CICHA DZIEWCZYNA SEANS KINA PLENEROWEGO"
    assert winners(spark, [(1, film, "", "A", day, None, 5), (2, cycle, "", "A", day, None, 9)]) == {1: 2, 2: 2}
    # two films of one cycle stay two
    assert winners(spark, [(1, "Kino letnie Wielki Błękit", "", "A", day, None, 5), (2, "Kino letnie Cicha Dziewczyna", "", "A", day, None, 5)]) == {1: 1, 2: 2}
    # other towns don't meet
    assert winners(spark, [(1, film, "", "A", day, None, 5), (2, film, "", "B", day, None, 9)]) == {1: 1, 2: 2}
    # a short title needs agreeing places
    assert winners(spark, [(1, "Kino letnie", "Zamek", "A", day, None, 5), (2, "Kino letnie plenerowe", "Biblioteka", "A", day, None, 5)]) == {1: 1, 2: 2}
    assert winners(spark, [(1, "Kino letnie", "", "A", day, None, 5), (2, "Kino letnie plenerowe", "Biblioteka", "A", day, None, 6)]) == {1: 2, 2: 2}
    # a span takes its days in, and the earlier of equals wins
    assert winners(spark, [(1, "Lato w mieście dzieci", "", "A", "2026-08-03", None, 5), (2, "Lato w mieście dzieci", "", "A", day, "2026-08-10", 1), (3, "Lato w mieście dzieci", "", "A", "2026-09-01", None, 1)]) == {1: 2, 2: 2, 3: 3}


def test_by_key(spark):
    rows = [(1, "Koncert", "", "A", "2026-08-01", None, 1), (2, "koncert!", "Zamek", "A", "2026-08-01", None, 9), (3, "Koncert", "", "A", "2026-08-02", None, 1)]
    got = {r.key: (r.first_pos, r.winner_pos, r.n_rows) for r in dedupe.by_key(events(spark, rows)).collect()}
    assert got == {"koncert|2026-08-01": (1, 2, 2), "koncert|2026-08-02": (3, 3, 1)}


def test_final_winner_of_chain_and_cycle(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (10, 11), (11, 10)], "loser long, winner long")
    got = {r.loser: r.final for r in dedupe.final_winners(edges).collect()}
    assert {k: got[k] for k in (1, 2, 3)} == {1: 4, 2: 4, 3: 4}
    assert {10, 11} <= set(got)


@pytest.mark.parametrize(("raw", "days"), [("sr", [3]), ("ŚR", [3]), (" środa ", [3]), ("sb,nd", [0, 6]), ("codziennie", list(range(7))), ("sb, niedziele parzyste", None), ("co drugi tydzień", None), ("", None)])
def test_parse_repeat(spark, raw, days):
    assert one(spark, dates.parse_repeat(F.col("r")), r=raw) == days


def test_expand_repeat(spark):
    rows = [(1, "2026-08-01", "2026-08-10", "sb,nd"), (2, "2026-08-01", "2026-08-04", "codziennie"), (3, "2026-08-01", None, "sb"), (4, "2026-08-01", "2026-08-10", "??"), (5, "2026-07-25", "2026-08-02", "sb,nd"), (6, "2026-08-01", "2026-12-31", "codziennie"), (7, "2026-08-01", "2026-08-09", "")]
    df = spark.createDataFrame([(p, D(s), D(e) if e else None, r) for p, s, e, r in rows], "pos long, date_start date, date_end date, repeat string")
    out = series.expand_repeat(df, F.lit("2026-08-01").cast("date")).collect()
    days = lambda p: sorted(r.date_start.isoformat()[5:] for r in out if r.pos == p)
    assert days(1) == ["08-01", "08-02", "08-08", "08-09"]
    assert len(days(2)) == 4 and days(3) == ["08-01"] and days(4) == ["08-01"] and days(5) == ["08-01", "08-02"] and len(days(6)) == 60
    assert [r.date_end for r in out if r.pos == 7] == [D("2026-08-09")]


def test_series_label(spark):
    label = lambda *d: one(spark, dates.series_label(F.array(*[F.lit(D(x)) for x in d])))
    assert label("2026-08-05", "2026-08-12", "2026-08-19") == "środy do 19.08"
    assert label("2026-08-01", "2026-08-02", "2026-08-08") == "soboty i niedziele do 8.08"
    assert label("2026-08-01", "2026-08-02", "2026-08-03") == "codziennie do 3.08"
    assert label("2026-08-05", "2026-08-19") == "5.08, 19.08"
    assert label("2026-08-05") == ""


def test_non_events_and_region(spark):
    df = spark.createDataFrame([(1, "Półkolonie letnie", "", []), (2, "Wycieczka", "polkolonie", []), (3, "X", "", ["Zebranie organizacyjne"]), (4, "Zwolniły się dwa ostatnie terminy", "", []), (5, "Kolonia artystyczna", "", ["obóz"])], "pos long, title string, container string, tags array<string>")
    kept, dropped = filters.without_non_events(df)
    assert [r.pos for r in kept.collect()] == [5]
    assert {r.pos: r.why for r in dropped.collect()} == {1: "półkolonie", 2: "półkolonie", 3: "spotkanie organizacyjne", 4: "zwolniony termin w usłudze"}
    places = spark.createDataFrame([(k, v) for k, v in enumerate(["region", "far", "abroad", "unknown", None])], "pos long, locality string")
    assert sorted(r.pos for r in filters.within_region(places).collect()) == [0, 3, 4]


def test_addresses(spark):
    key = lambda u: one(spark, urls.url_key(F.col("u")), u=u)
    assert key("https://www.Example.org/Abc/?b=2&a=1#x") == key("http://example.org/abc?a=1&b=2") == "example.org/abc?a=1&b=2"
    shape = lambda u: one(spark, urls.url_template(F.col("u")), u=u)
    assert shape("https://x.pl/wydarzenia/dozynki-wiorka-i-czapur") == "/wydarzenia/{slug}"
    assert shape("https://x.pl/events/2026-08-15") == "/events/{date}"
    assert shape("https://x.pl/events/8215") == "/events/{id}"
    assert shape("https://x.pl/o-nas") == "/o-nas"
    assert shape("https://x.pl/lista/page/3") == "/lista/page/{page}"
    assert shape("https://x.pl/?co=list&p=3") == "/?co=list&p={page}"


def test_redaction(spark):
    mail, tel = "[e-mail w źródle]", "[tel. w źródle]"
    cases = [
        ("zapisy: 601 234 567", f"zapisy: {tel}", 0, 1), ("tel. +48 512-345-678", f"tel. {tel}", 0, 1), ("kom. 48 733 111 222", f"kom.{tel}", 0, 1), ("kom. 0048 733 111 222", f"kom. {tel}", 0, 1),
        ("kom. 00 48 733 111 222", f"kom. {tel}", 0, 1), ("tel. 0048 22 123 45 67", "tel. 0048 22 123 45 67", 0, 0), ("tel. 61 123 45 67", "tel. 61 123 45 67", 0, 0), ("600\u00a0123\u00a0456", tel, 0, 1),
        ("mail a.b@c.pl!", f"mail {mail}!", 1, 0), ("https://x.pl/601234567", "https://x.pl/601234567", 0, 0), ("patrz https://x.pl/601234567 lub 601 234 567", f"patrz https://x.pl/601234567 lub {tel}", 0, 1),
        ("wstęp 25 zł, sala 1234", "wstęp 25 zł, sala 1234", 0, 0), ("601 234 567, 602 000 111, x@y.pl", f"{tel}, {tel}, {mail}", 1, 2), ("numer 1234567890", "numer 1234567890", 0, 0), (None, None, 0, 0), ("", "", 0, 0),
    ]
    rows = redact.redact_events(spark.createDataFrame([(k, t, [t, "x@y.pl"]) for k, (t, *_) in enumerate(cases)], "k int, text string, slots array<string>"), ["text"]).orderBy("k").collect()
    assert [(r.text, r.n_emails, r.n_phones) for r in rows] == [(w, e, p) for _, w, e, p in cases]
    both = redact.redact_events(spark.createDataFrame([(["601 234 567", None, "x@y.pl"], None)], "slots array<string>, text string"), ["slots", "text"]).first()
    assert both.slots == [tel, None, mail] and (both.n_emails, both.n_phones) == (1, 1)
    kinds = spark.createDataFrame([("601234567",), ("221234567",), ("991234567",), ("12345",)], "n string").select(redact.phone_kind(F.col("n"))).collect()
    assert [r[0] for r in kinds] == ["mobile", "landline", "other", None]


def test_chrome(spark):
    judge = lambda t: one(spark, chrome.looks_like_chrome(F.col("t")), t=t)
    assert judge("Strona korzysta z plików cookie. Polityka prywatności")
    assert judge("Aktualności [/a]\nKultura [/b]\nSport [/c]\nO nas [/d]")
    assert judge("1 [/w?p=1]\n2 [/w?p=2]\n3\n» [/w?p=4]")
    assert not judge("Polityka prywatności i pliki cookies, 12.08 koncert")
    assert not judge("Zapraszamy na międzynarodowe spotkanie z autorem książki, które poprowadzi znany krytyk")
    assert not judge("") and not one(spark, chrome.looks_like_chrome(F.lit(None).cast("string")))


def test_blocks_change_alone(spark):
    parts = [f"Akapit numer {k} o czymś zupełnie innym" for k in range(40)]
    frame = lambda p: spark.createDataFrame([("p", "\n\n".join(p))], "page string, text string")
    a = {r.hash for r in blocks.segment(frame(parts), "page", "text").collect()}
    b = {r.hash for r in blocks.segment(frame(parts[:20] + parts[21:]), "page", "text").collect()}
    assert len(a - b) <= 2 and len(a & b) >= len(a) - 2
    assert blocks.segment(frame([]), "page", "text").count() == 0


def test_cards_of_one_tag_with_classes_that_differ():
    from gleanery.operators.cards import cards_of

    words = "Warsztaty ceramiczne dla dzieci i rodziców w domu kultury "
    page = "<ul>" + "".join(f'<li class="{c}"><a href="/e/{k}">{words}{k}</a></li>' for k, c in enumerate(("first", "odd", "even", "last"))) + "</ul>"
    assert [h for h, _ in cards_of(page)] == ["/e/0", "/e/1", "/e/2", "/e/3"]
    assert cards_of(page.replace("/e/", "/e#").replace("/e#0", "/same").replace("/e#1", "/same").replace("/e#2", "/same").replace("/e#3", "/same")) == []
    assert cards_of(None) == cards_of("<ul><li>a</li></ul>") == []


def test_budget_passes_over(spark):
    df = spark.createDataFrame([("g", k, float(c)) for k, c in enumerate([3, 5, 1])], "g string, id int, cost double")
    assert [r.fits for r in budget.greedy_budget(df, ["id"], "cost", 4.0).orderBy("rank").collect()] == [True, False, True]
    rng = random.Random(1)
    sizes = [rng.randint(1, 9) for _ in range(30)]
    chunks = one(spark, budget.greedy_chunks(F.array(*[F.lit(s) for s in sizes]), 12))
    for c in set(chunks):
        assert sum(s for s, x in zip(sizes, chunks) if x == c) <= 12


def test_simulation_drops_the_dearer_twin(spark):
    made = spark.createDataFrame([("a", "k1"), ("b", "k1"), ("c", "k2")], "source string, key string")
    costs = spark.createDataFrame([("a", 2.0), ("b", 5.0), ("c", 1.0), ("d", 9.0)], "source string, cost double")
    assert {r.source: r.reason for r in yields.simulate_drops(made, costs).collect()} == {"d": "barren", "b": "redundant", "a": "keep", "c": "keep"}


def test_retention_edges(spark):
    df = spark.createDataFrame([("s", k) for k in range(10)], "s string, day int")
    left = lambda cut, least, most: sorted(r.day for r in retention.retain(df, ["s"], [F.col("day")], F.col("day") >= cut, least, most).collect())
    assert left(7, 2, 30) == [7, 8, 9] and left(100, 2, 30) == [8, 9] and left(0, 2, 4) == [6, 7, 8, 9]


def test_feeds(spark):
    ical = "BEGIN:VCALENDAR\r\nBEGIN:VEVENT\r\nSUMMARY:Koncert\\, plener\r\nDTSTART:20260801T160000Z\r\nLOCATION:Park\r\n  Miejski\r\nEND:VEVENT\r\nBEGIN:VEVENT\r\nSUMMARY:Jarmark\r\nDTSTART;VALUE=DATE:20260802\r\nEND:VEVENT\r\nEND:VCALENDAR"
    got = sorted((r.title, str(r.date_start), r.time_start, r.venue) for r in feeds.from_ical(spark.createDataFrame([("s", ical)], "source_id string, body string")).collect())
    assert got == [("Jarmark", "2026-08-02", None, ""), ("Koncert, plener", "2026-08-01", "18:00", "Park Miejski")]
    body = '{"events":[{"title":"Wystawa","start_date":"2026-08-01 00:00:00","end_date":"2026-08-01 23:59:59","venue":{"venue":"Dom","address":"Dom"}},{"title":"","start_date":"2026-08-01"}]}'
    assert [(r.title, r.time_start, r.venue) for r in feeds.from_plugin(spark.createDataFrame([("s", body)], "source_id string, body string")).collect()] == [("Wystawa", None, "Dom")]
    page = '<script type="application/ld+json">{"@graph":[{"@type":"MusicEvent","name":"Recital","startDate":"2026-08-01T19:00"},{"@type":"Person","name":"X"}]}</script>'
    assert [(r.title, r.time_start) for r in feeds.from_json_ld(spark.createDataFrame([("s", page)], "source_id string, html string")).collect()] == [("Recital", "19:00")]


def test_share_shape_and_slug(spark):
    shape = lambda o, c: one(spark, text.share_shape(F.col("o"), F.col("c")), o=o, c=c)
    assert (shape("Koncert w parku!", "koncert"), shape("koncert", "Koncert w parku"), shape("a", "b"), shape("a", "")) == ("original", "caption", "both", "original")
    assert one(spark, text.slug(F.col("t")), t="  Święto Łąki – 2026! ") == "swieto-laki-2026"


def test_config_from_env(monkeypatch):
    monkeypatch.setenv("GLEANERY_MUTE_DAYS", "12")
    monkeypatch.setenv("GLEANERY_MIN_RUNS", "many")
    assert (EngineConfig.from_env().mute_days, EngineConfig.from_env().min_runs) == (12, 5)


def test_cards():
    from gleanery.operators.cards import cards_of

    card = lambda k: f'<div class="card c{k}"><a href="/e/{k}">Koncert numer {k}</a><p>Opis wydarzenia, które odbędzie się w parku</p></div>'
    page = "<body><nav>" + card(9) * 3 + "</nav><main>" + "".join(map(card, range(4))) + "</main><footer>x</footer>"
    assert [h for h, _ in cards_of(page)] == ["/e/0", "/e/1", "/e/2", "/e/3"]
    assert cards_of("<main>" + "<div><p>Zgoda na przetwarzanie danych osobowych w celach</p></div>" * 4 + "</main>") == []
    assert cards_of(None) == cards_of("") == cards_of("<div><div>") == []


def test_salvage_and_verdicts(spark):
    from gleanery.functions import parsing

    assert parsing.salvage('{"sources":[{"id":"a"},{"id":"b"},{"id":"c","name":"Nie') == ['{"id":"a"}', '{"id":"b"}']
    assert parsing.salvage('[{"a":"x}{"},{"b":{"c":1}}') == ['{"a":"x}{"}', '{"b":{"c":1}}']
    assert parsing.salvage('[{"a":1},{"b" oops},\n{"c":3}]') == ['{"a":1}', '{"c":3}']
    assert parsing.salvage(None) == parsing.salvage("none") == []
    verdict = lambda t: one(spark, parsing.parse_verdict(F.col("t")), t=t)
    assert [verdict(t) for t in ("no", 'x {"a":1} y', '{"a":', '{"a" b}')] == ["no-json", "ok", "truncated", "bad-json"]
    assert parsing.decode_entities("a&nbsp;&#322;&amp;  b &unknown;") == "a ł& b &unknown;"
    fixed = one(spark, parsing.fix_calendar_links(F.col("t")), t="?dates=20260801T180000Z/20260801T180000Z&x")
    assert fixed == "?dates=20260801/20260801&x"


def test_parsing_columns(spark):
    from gleanery.functions import parsing

    part = lambda v: tuple(one(spark, parsing.clock_parts(F.col("t")), t=v))
    assert part("2026-08-01T18:30:00+02:00") == (D("2026-08-01"), "18:30")
    assert part("2026-08-01") == (D("2026-08-01"), None)
    assert part("1785600000")[0] == D("2026-08-01") and part("soon") == (None, None)
    assert one(spark, parsing.venue_of(F.col("n"), F.col("a")), n="Zamek, Poznań", a="Poznań") == "Zamek, Poznań"
    assert tuple(one(spark, text.price_of(F.col("p")), p="Bilety 25,50 zł")) == (False, 25.5)
    assert tuple(one(spark, text.price_of(F.col("p")), p="Wstęp wolny")) == (True, 0.0)

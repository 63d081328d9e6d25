"""Geocoder queries, ledgers written anew, and listing shapes."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from gleanery.functions import places
from gleanery.operators import costs, listing

CASES = [
    ("Hipodrom Wola, ul. Lutycka 34", "", ["Hipodrom Wola", "Lutycka 34"]),
    ("ul. Śniadeckich 30", "", ["Śniadeckich 30"]),
    ("ulica Lutycka 34", "", ["Lutycka 34"]),
    ("ul Gromadzka", "", ["Gromadzka"]),
    ("Nad Stawem, ul Gromadzka, Więckowice", "", ["Nad Stawem", "Gromadzka", "Więckowice"]),
    ("Mosina ul Jana Cybisa 4", "", [("Jana Cybisa 4", "Mosina")]),
    ("Mosina ul. Jana Cybisa 4 - garaż", "", [("Jana Cybisa 4", "Mosina")]),
    ("os. Lecha 43", "", ["os. Lecha 43"]),
    ("al. Niepodległości 16", "", ["al. Niepodległości 16"]),
    ("Start: przy fontannie na placu Wolności", "", ["plac Wolności"]),
    ("Park Cytadela w Poznaniu, Lasek Marceliński w Poznaniu, Las Dębiński w Poznaniu", "", ["Park Cytadela", "Lasek Marceliński", "Las Dębiński"]),
    ("Sala kolumnowa, Akademia Lubrańskiego, ul. Lubrańskiego 1 (Ostrów Tumski)", "", ["Akademia Lubrańskiego", "Lubrańskiego 1", "Ostrów Tumski"]),
    *[(x, "", []) for x in ("Sala kolumnowa", "Start", "Hala", "parking", "Miejsce", "", "  ", ",,,", "-", "??", None)],
    ("Hala Arena, ul. Wyspiańskiego 33", "", ["Hala Arena", "Wyspiańskiego 33"]),
    ("Park Wilsona, park Wilsona", "", ["Park Wilsona"]),
    ("Rynek 1 – wejście od podwórza", "", ["Rynek 1"]),
    ("Poznań - Nowe Miasto", "", ["Poznań - Nowe Miasto"]),
    ("Park nad Wartą przy amfiteatrze", "", ["Park nad Wartą"]),
    ("Cytadela poznańska", "Poznań", ["Cytadela poznańska", "Cytadela"]),
    ("Poznańska Cytadela", "Poznań", ["Poznańska Cytadela", "Cytadela"]),
    ("Katedra poznańska, ul. Ostrów Tumski 17", "Poznań", ["Katedra poznańska", "Katedra", "Ostrów Tumski 17"]),
    *[(x, "Poznań", [x]) for x in ("Ostrów Tumski", "Klub żeglarski", "Rynek Jeżycki", "Park poznański")],
    ("Cytadela poznańska", "", ["Cytadela poznańska"]),
    ("Cytadela poznańska", None, ["Cytadela poznańska"]),
    ("Akademia Lubrańskiego Muzeum Archidiecezjalne", "", ["Akademia Lubrańskiego Muzeum Archidiecezjalne", "Akademia Lubrańskiego", "Muzeum Archidiecezjalne"]),
    *[(x, "", [x]) for x in ("Wiejski Dom Kultury", "Centrum Kultury Zamek", "Dom Kultury Orle Gniazdo", "Muzeum Broni Pancernej", "Hala Arena")],
    ("AMAkids - Akademia Rozwoju Intelektualnego - Centrum Edukacji dla Dzieci", "", ["AMAkids - Akademia Rozwoju Intelektualnego - Centrum Edukacji dla Dzieci", "AMAkids - Akademia Rozwoju Intelektualnego", "Centrum Edukacji dla Dzieci"]),
    ("Muzeum Kultur Świata (wejście od ul. Mostowej 7)", "", ["Muzeum Kultur Świata", "Mostowej 7"]),
]


def test_ladders_of_venues(spark):
    df = spark.createDataFrame([(k, v, t) for k, (v, t, _) in enumerate(CASES)], "k int, venue string, town string")
    got = {r.k: [(x.q, x.town) for x in r.p] for r in df.select("k", places.place_queries(F.col("venue"), F.col("town")).alias("p")).collect()}
    assert got == {k: [x if isinstance(x, tuple) else (x, None) for x in want] for k, (_, _, want) in enumerate(CASES)}


# costs


def test_ledger_written_anew(spark):
    rows = [("new", "a", "extract", 2, 0.2, 10, 1, 0), ("new", "b", "extract", 1, 0.1, 5, 1, 0), ("new", "b", "poster", 1, 0.5, 7, 1, 4), ("new", "c", "poster", 0, 0.0, 0, 0, 0), ("old", "a", None, 3, 0.3, 9, 2, 0), ("old", "b", None, 0, 0.0, 0, 0, 2), ("none", "a", None, 0, 0.0, 0, 0, 0)]
    df = spark.createDataFrame(rows, "run_id string, source_id string, task string, calls int, usd double, tokens_in int, tokens_out int, records int")
    got = {(r.run_id, r.category): (round(r.usd, 6), r.estimated, r.inferred, r.units, r.unit, r.tokens_in, r.n_drivers) for r in costs.backfilled(df, 0.01).collect()}
    assert got == {
        ("new", "llm-extract"): (0.3, False, False, 3, "calls", 15, 2),
        ("new", "llm-vision"): (0.5, False, False, 1, "calls", 7, 1),
        ("new", "fb"): (0.04, True, False, 4, "records", None, 1),
        ("old", "llm-extract"): (0.3, False, True, 3, "calls", 9, 1),
        ("old", "fb"): (0.02, True, False, 2, "records", None, 1),
    }


def test_parts_add_up_exactly(spark):
    rng = random.Random(2)
    totals = [(f"r{k}", rng.choice([0, 1, 2, 7, 100, 99_999, -5, -100])) for k in range(40)] + [("alone", 5), ("blind", 7)]
    weights = [(r, p, rng.choice([0.0, 0.1, 1.0, 3.3, float("nan"), float("inf"), -2.0, None])) for r, _ in totals[:40] for p in "abc"] + [("blind", "x", 0.0), ("blind", "y", None), ("blind", None, 3.0), ("other", "a", 1.0)]
    t, w = spark.createDataFrame(totals, "run string, cents long"), spark.createDataFrame(weights, "run string, part string, weight double")
    got = costs.attributed(t, w, ["run"], "part").collect()
    sums = {}
    for r in got:
        sums[r.run] = sums.get(r.run, 0) + r.cents
    assert sums == dict(totals)
    assert {(r.part, r.cents) for r in got if r.run == "blind"} == {("x", 4), ("y", 3)} and [(r.part, r.cents) for r in got if r.run == "alone"] == [(None, 5)]
    third = costs.attributed(spark.createDataFrame([("r", 100)], "run string, cents long"), spark.createDataFrame([("r", p, 1.0) for p in "cab"], "run string, part string, weight double"), ["run"], "part")
    assert {r.part: r.cents for r in third.collect()} == {"a": 34, "b": 33, "c": 33}


# listings


def links_of(spark, page_url, *told):
    return spark.createDataFrame([("p", page_url, u, nav) for u, nav in told], "page string, page_url string, url string, in_nav boolean")


def winner(spark, page_url, *told):
    return listing.winners(listing.groups(links_of(spark, page_url, *told))).collect()


def test_entries_beat_menus_and_calendars(spark):
    menu = [(f"https://x.pl/dzial-numer-{k}", True) for k in range(40)]
    items = [(f"https://x.pl/wydarzenia/koncert-w-parku-{k}", False) for k in range(9)]
    days = [(f"https://x.pl/wydarzenia/2026-08-{k:02d}", False) for k in range(1, 28)]
    (r,) = winner(spark, "https://x.pl/", *menu, *items, *days)
    assert r.template == "/wydarzenia/{slug}" and r.n_urls == 9 and r.n_rivals == 2 and r.lead > 0
    # too few, without slots, or a pager: no listing
    assert winner(spark, "https://x.pl/", *items[:2], ("https://x.pl/a", False), ("https://x.pl/l?page=1", False), ("https://x.pl/l?page=2", False), ("https://x.pl/l?page=3", False)) == []
    # an address of menu and text counts as text
    both = [(u, True) for u, _ in items] + items
    assert winner(spark, "https://x.pl/", *both)[0].content_ratio == 1.0


def test_a_pages_own_section_counts_more(spark):
    far = [(f"https://x.pl/aktualnosci/wpis-numer-{k}", False) for k in range(12)]
    near = [(f"https://x.pl/kalendarz/wpis-numer-{k}", False) for k in range(6)]
    assert winner(spark, "https://x.pl/", *far, *near)[0].template == "/aktualnosci/{slug}"
    (r,) = winner(spark, "https://x.pl/kalendarz.html", *far, *near)
    assert r.template == "/kalendarz/{slug}" and r.same_section
    of = lambda t, p: spark.range(1).select(listing.affinity(F.lit(t), F.lit(p))).first()[0]
    assert [of("/a/b/{id}", "/a"), of("/a/{id}", "/a/b/c"), of("/a/x/{id}", "/a/b"), of("/{slug}", "/a"), of("/a/{id}", "/")] == [2.2, 2.2, 1.0, 1.0, 1.0]


def test_candidates_of_pagers(spark):
    df = spark.createDataFrame([(1, "https://x.pl/l"), (2, "https://x.pl/l?kat=3&p=7#top")], "page int, page_url string")
    got = {(r.page, r.place): r.template for r in listing.page_candidates(df).collect()}
    assert got[1, 0] == "https://x.pl/l?page={page}" and got[2, 0] == "https://x.pl/l?kat=3&p=7&page={page}" and got[2, 1] == "https://x.pl/l?kat=3&p={page}" and len(got) == 12


def test_next_pages(spark):
    base = [(f"https://x.pl/w/wpis-numer-{k}", False) for k in range(5)]
    own = links_of(spark, "https://x.pl/w", *base).select("page", "url").unionByName(spark.createDataFrame([("q", "https://y.pl/")], "page string, url string"))
    shapes = listing.winners(listing.groups(links_of(spark, "https://x.pl/w", *base)))
    entry = lambda k: f"https://x.pl/w/wpis-numer-{k}"
    told = [("p", "new", entry(k)) for k in (3, 4, 5, 6)] + [("p", "same", entry(k)) for k in (1, 2, 9)] + [("p", "other", "https://x.pl/o"), ("q", "x", entry(1))]
    got = {r.candidate: (r.n_entries, r.n_new, r.verdict) for r in listing.next_pages(own, spark.createDataFrame(told, "page string, candidate string, url string"), shapes).collect()}
    assert got == {"new": (4, 2, "next"), "same": (3, 1, "same"), "other": (0, 0, "none"), "x": (0, 0, "no-listing")}


def test_measured_before_asked(spark):
    measured = spark.createDataFrame([("a", "https://a/1", 10, 0, 5), ("a", "https://a/2", 4, 2, 0), ("b", "https://b/1", 2, 0, 9), ("b", "https://b/2", 1, 0, 9), ("c", "https://c/long", 3, 0, 1), ("c", "https://c/s", 3, 0, 1), ("d", "https://d", 0, 0, 0)], "source_id string, url string, n_entries int, n_dated int, hint int")
    asked = spark.createDataFrame([("a", "https://a/1", 0.9), ("b", "https://b/2", 0.7), ("b", "https://b/9", 0.99), ("d", "https://d", 0.4)], "source_id string, url string, confidence double")
    got = {r.source_id: (r.url, r.via, r.confidence) for r in listing.entrypoints(measured, asked).collect()}
    assert got == {"a": ("https://a/2", "measured", 0.75), "b": ("https://b/2", "asked", 0.7), "c": ("https://c/s", "measured", 0.5)}


@pytest.mark.parametrize("df", ["groups", "candidates"])
def test_empty_listings(spark, df):
    none = spark.createDataFrame([], "page string, page_url string, url string, in_nav boolean")
    assert (listing.winners(listing.groups(none)) if df == "groups" else listing.page_candidates(none)).count() == 0

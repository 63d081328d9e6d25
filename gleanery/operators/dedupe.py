"""De-duplication of events: by key, by original, by containment; each pass keeps the richest."""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.config import CONFIG
from gleanery.functions.text import event_key, long_words, norm
from gleanery.operators.durable import settle
from gleanery.operators.graph import components


def by_key(events: DataFrame) -> DataFrame:
    """One row for each event key: the richest (then the earliest), at the earliest row's place; winner_pos tells whose it is.

    Columns: pos, title, date_start, richness; key too, where it is known. Without a shuffle beyond the key's, and with partial aggregation.
    """
    columns = [c for c in events.columns if c != "key"]
    keyed = events if "key" in events.columns else events.withColumn("key", event_key(F.col("title"), F.col("date_start")))
    best = F.max_by(F.struct(*columns), F.struct(F.col("richness"), -F.col("pos"))).alias("w")
    return keyed.groupBy("key").agg(F.min("pos").alias("first_pos"), F.count("*").alias("n_rows"), best).select("key", "first_pos", "n_rows", *(F.col(f"w.{c}").alias("winner_pos" if c == "pos" else c) for c in columns))


def _same(a: dict, b: dict, short: int) -> bool:
    """Whether one title's words hold the other's, and for short titles the places agree or one is unknown."""
    ta, tb = a["t"], b["t"]
    small, large = (ta, tb) if len(ta) <= len(tb) else (tb, ta)
    if not small or not small <= large:
        return False
    return len(small) > short or not a["v"] or not b["v"] or bool(a["v"] & b["v"])


def _comparable(a: dict, b: dict, short: int) -> bool:
    if not _same(a, b, short):
        return False
    if a["start"] == b["start"]:
        return True
    return a["n"] == b["n"] and a["start"] <= b["end"] and b["start"] <= a["end"]


def _beats(a: dict, b: dict) -> bool:
    """Whether the first record is worth more: a span before a single day, then the richer."""
    if a["span"] != b["span"]:
        return a["span"]
    return a["rich"] > b["rich"]


class _Day:
    """The survivors of one day, found by their words: what a record can be compared with is looked up, not searched for.

    A survivor whose words hold a record's has its rarest word; one whose words the record's hold hangs on a single word of its own, the one that fewest
    survivors had when it came. Short ones hang on their venue's words too.
    """

    def __init__(self, short: int):
        self.short = short
        self.having: dict = defaultdict(set)
        self.at: dict = defaultdict(set)
        self.long: dict = defaultdict(set)
        self.brief: dict = defaultdict(set)
        self.brief_at: dict = defaultdict(set)
        self.hook: dict[int, str] = {}

    def add(self, k: int, t: frozenset, v: frozenset) -> None:
        if not t:
            return
        hook = self.hook[k] = min(t, key=lambda w: (len(self.having.get(w, ())), w))
        for w in t:
            self.having[w].add(k)
        for w in v or ("",):
            self.at[w].add(k)
        if len(t) > self.short:
            self.long[hook].add(k)
        else:
            self.brief[hook].add(k)
            for w in v or ("",):
                self.brief_at[hook, w].add(k)

    def drop(self, k: int, t: frozenset, v: frozenset) -> None:
        if not t:
            return
        hook = self.hook.pop(k)
        held = [(self.having, w) for w in t] + [(self.at, w) for w in v or ("",)]
        held += [(self.long, hook)] if len(t) > self.short else [(self.brief, hook), *((self.brief_at, (hook, w)) for w in v or ("",))]
        for index, key in held:
            index[key].discard(k)
            if not index[key]:
                del index[key]

    def near(self, t: frozenset, v: frozenset) -> set[int]:
        """All whose words hold these or are held by them, and some others."""
        found: set[int] = set()
        larger = min((self.having.get(w, ()) for w in t), key=len, default=())
        if larger:
            places = [self.at.get(w, ()) for w in (*v, "")] if v and len(t) <= self.short else [larger]
            for some in places if sum(map(len, places)) < len(larger) else [larger]:
                found.update(some)
        for w in t:
            found.update(self.long.get(w, ()))
            for some in [self.brief_at.get((w, x), ()) for x in (*v, "")] if v else [self.brief.get(w, ())]:
                found.update(some)
        return found


class Fold:
    """Records of one component, in order of place: a record meets those that survive so far.

    Without any comparable one it takes a seat. Else the best of those competes with it for the seat, and the others are absorbed. Survivors are looked
    up by the words of their day and by title, since only these can be comparable: as all that a record is compared with but one go, work grows with the
    records and not with the survivors of a day. A seat keeps the place of the record that took it first.
    """

    def __init__(self, short: int = CONFIG.short_title_tokens):
        self.short = short
        self.seats: list[dict | None] = []
        self.places: list[int] = []
        self.by_day: dict = {}
        self.by_title: dict = defaultdict(set)
        self.lost_to: dict[int, int] = {}
        self.order: list[int] = []

    def _hang(self, k: int, row: dict | None) -> None:
        old = self.seats[k]
        if old is not None:
            self.by_day[old["start"]].drop(k, old["t"], old["v"])
            self.by_title[old["n"]].discard(k)
        self.seats[k] = row
        if row is not None:
            self.by_day.setdefault(row["start"], _Day(self.short)).add(k, row["t"], row["v"])
            self.by_title[row["n"]].add(k)

    def _hits(self, row: dict) -> list[int]:
        near = self.by_day[row["start"]].near(row["t"], row["v"]) if row["start"] in self.by_day else set()
        near.update(self.by_title.get(row["n"], ()))
        return sorted(k for k in near if _comparable(self.seats[k], row, self.short))

    def add(self, row: dict) -> None:
        self.order.append(row["pos"])
        hits = self._hits(row)
        if not hits:
            self.seats.append(None)
            self.places.append(row["place"])
            self._hang(len(self.seats) - 1, row)
            return
        best = hits[0]
        for k in hits[1:]:
            if _beats(self.seats[k], self.seats[best]):
                best = k
        holder = self.seats[best]
        if _beats(row, holder):
            self.lost_to[holder["pos"]] = row["pos"]
            self._hang(best, row)
        else:
            self.lost_to[row["pos"]] = holder["pos"]
        for k in hits:
            if k != best:
                self.lost_to[self.seats[k]["pos"]] = self.seats[best]["pos"]
                self._hang(k, None)

    def verdicts(self) -> Iterator[tuple[int, int, int]]:
        """(pos, winner_pos, the winner's place) of every record, in order."""
        place = {row["pos"]: p for row, p in zip(self.seats, self.places) if row is not None}
        last: dict[int, int] = {}
        for pos in self.order:
            trail = [pos]
            while trail[-1] in self.lost_to and trail[-1] not in last:
                trail.append(self.lost_to[trail[-1]])
            end = last.get(trail[-1], trail[-1])
            last.update(dict.fromkeys(trail, end))
            yield pos, end, place[end]


def _fold_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Verdicts over rows that come component by component, each in order of place and numbered from 1; only one component's records are held.

    Words come as one text; sets of words that come again are shared.
    """

    def told(verdicts: Iterable[tuple[int, int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*verdicts)], ["pos", "winner_pos", "place"])

    def ended() -> Iterator[tuple[int, int, int]]:
        nonlocal fold, sets
        for batch in batches:
            for nth, pos, place, n, t, v, start, end, span, rich in zip(*(c.to_pylist() for c in batch.columns)):
                if nth == 1:
                    yield from fold.verdicts()
                    fold, sets = Fold(), {} if len(sets) > 100_000 else sets
                for words in (t, v):
                    if words not in sets:
                        sets[words] = frozenset(map(sys.intern, words.split()))
                fold.add({"pos": pos, "place": place, "n": n, "t": sets[t], "v": sets[v], "start": start, "end": end, "span": span, "rich": rich})
        yield from fold.verdicts()

    fold, sets = Fold(), {}
    some = ended()
    while chunk := list(islice(some, 10_000)):
        yield told(chunk)


def classes(rows: DataFrame, short: int = CONFIG.short_title_tokens) -> DataFrame:
    """Rows with their class_id, the smallest pos of rows alike, written; those without a bucket, a day or a word in the title go.

    Rows: pos, bucket, t, v, date_start; words as arrays or as one text. Rows alike share bucket, day and title words; short titles share all words of the venue too, and
    where it isn't known are alike to none.
    """
    brief = F.size(F.split("t", " ")) <= short
    rows = rows.withColumns({"t": F.concat_ws(" ", "t"), "v": F.when(F.col("v").isNotNull(), F.concat_ws(" ", "v"))})
    ready = rows.where("bucket is not null and date_start is not null and t <> ''").withColumn("venues", F.when(brief, F.coalesce("v", F.concat(F.lit("?"), "pos"))).otherwise(""))
    alike = ["bucket", "date_start", "t", "venues"]
    return settle(ready.join(ready.groupBy(*alike).agg(F.min("pos").alias("class_id")), alike).drop("venues"))


def title_links(rows: DataFrame, short: int = CONFIG.short_title_tokens) -> DataFrame:
    """(a, b): links that tie all rows of a bucket that can be compared, between representatives (class_id) of rows alike.

    Rows: class_id, bucket, n, t, v, date_start, date_end, words as arrays or as one text; a class holds rows of one bucket, day and set of title words, for short titles of one set of venue words too.
    On one day, the shorter title's rarest word finds the titles that may hold it: a word that many titles share finds only what it alone names. Words of a bucket and day are
    told by a hash, and what it finds is compared. All that a title holds hang on the smallest of them, and the title too: so links don't grow with what it holds.
    Under one title, spans that meet are runs in order of their starts; a run hangs on its smallest class. Venues aren't asked there, so short titles may be
    tied that the fold keeps apart: it decides anyhow.
    """
    text = lambda c: F.when(F.col(c).isNotNull(), F.concat_ws(" ", c)).alias(c)
    one = settle(rows.select("class_id", "bucket", "date_start", text("t"), text("v")).distinct())
    words = one.select("*", F.explode(F.split("t", " ")).alias("w")).withColumn("g", F.expr("xxhash64(bucket, date_start, w) & 8796093022207"))  # 43 bits, beside counts of 20
    common = words.groupBy("g").agg((F.least(F.count("*"), F.lit((1 << 20) - 1)) * (1 << 43)).alias("titles"))
    rarest = words.select("class_id", "g").join(common, "g").groupBy("class_id").agg(F.min(F.col("titles") + F.col("g")).alias("r")).select("class_id", F.expr("r & 8796093022207").alias("g"))
    a, b = one.join(rarest, "class_id").alias("a"), words.drop("w").alias("b")
    some = lambda c: F.split(c, " ")
    key = (F.col("a.g") == F.col("b.g")) & (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.date_start") == F.col("b.date_start"))
    held = (F.col("a.class_id") != F.col("b.class_id")) & (F.length("a.t") <= F.length("b.t")) & (F.size(F.array_except(some("a.t"), some("b.t"))) == 0)
    agree = (F.size(some("a.t")) > short) | (F.col("a.v") == "") | (F.col("b.v") == "") | F.arrays_overlap(some("a.v"), some("b.v"))
    holds = a.join(b, key & held & agree).groupBy(F.col("b.class_id").alias("b")).agg(F.collect_set("a.class_id").alias("held"))
    same_day = holds.select(F.explode(F.array_append("held", F.col("b"))).alias("a"), F.array_min("held").alias("b")).where("a <> b").distinct()

    spans = rows.groupBy("bucket", "n", "date_start", "class_id").agg(F.max("date_end").alias("date_end"))
    title = Window.partitionBy("bucket", "n").orderBy("date_start", "date_end", "class_id")
    reach = F.max("date_end").over(title.rowsBetween(Window.unboundedPreceding, -1))
    begun = spans.withColumn("begins", F.when(F.col("date_start") <= reach, 0).otherwise(1)).withColumn("run", F.sum("begins").over(title))
    run = Window.partitionBy("bucket", "n", "run")
    meeting = begun.select("class_id", F.min("class_id").over(run).alias("b")).where("class_id <> b").select(F.col("class_id").alias("a"), "b")
    return same_day.unionByName(meeting)


def by_containment(events: DataFrame, bucket: str | Column) -> DataFrame:
    """pos, winner_pos, place of every row: records of one bucket whose titles hold each other are one, on the same day or, under one title, on meeting spans.

    Columns: pos, title, venue, date_start, date_end, richness and the bucket; place too, where the order isn't that of pos. The fold is sequential by
    definition, as winners change on the way; but only records that are tied by a chain of comparable ones can touch each other. So links are found
    first, and each component of them is folded by itself, in order, as its rows stream by. Rows that are tied to nothing never leave the JVM; rows without a bucket,
    or without a word in the title, meet nothing. A row's place in the result is that of the record that first held its winner's seat.
    """
    place = F.col("place") if "place" in events.columns else F.col("pos")
    named = events.select("pos", place.cast("long").alias("place"), (F.col(bucket) if isinstance(bucket, str) else bucket).alias("bucket"), norm(F.col("title")).alias("n"), norm(F.coalesce(F.col("venue"), F.lit(""))).alias("at"), "date_start", F.coalesce("date_end", "date_start").alias("date_end"), F.col("date_end").isNotNull().alias("span"), F.col("richness").cast("long").alias("rich"))
    # words are worked out once: filters and classes read what is written
    words = lambda c: F.concat_ws(" ", F.sort_array(long_words(F.col(c))))
    told = settle(named.withColumns({"t": words("n"), "v": words("at")}).drop("at"))
    rows = classes(told)
    tied = rows.join(components(title_links(rows)).withColumnRenamed("id", "class_id"), "class_id", "left").withColumn("component", F.coalesce("component", "class_id"))
    # the window keeps each component in one task, in order; a repartition alone gives way where the join before it is dealt otherwise at run time
    whole = Window.partitionBy("component")
    numbered = tied.withColumns({"nth": F.row_number().over(whole.orderBy("place", "pos")), "rows": F.count("*").over(whole)}).where("rows > 1")
    folded = settle(numbered.select("nth", "pos", "place", "n", "t", "v", F.unix_date("date_start"), F.unix_date("date_end"), "span", "rich").mapInArrow(_fold_sorted, "pos long, winner_pos long, place long"))
    return told.select("pos", F.col("place").alias("own")).join(folded, "pos", "left").select("pos", F.coalesce("winner_pos", "pos").alias("winner_pos"), F.coalesce("place", "own").alias("place"))


def every_pass(events: DataFrame) -> DataFrame:
    """pos, winner_pos, why of every row: three passes, each over what the one before left, and each row's final winner.

    Columns: pos, title, venue, town, origin, date_start, date_end, richness. First rows of one key are one ("key"); then those of one original
    whose titles hold each other ("origin"), whatever their towns; then those of one town ("containment"). why names the pass that a row lost in, and is
    null for winners. Rows without an original don't take part in the second pass; a null town is a town of its own, the empty one.
    Rows without a title or a day stay as they are. Events are worked out once, and written with their keys, unless they have them already; winners are followed from key to
    key, and only then told to the rows, in one join.
    """
    if "key" not in events.columns:
        events = settle(events.select("pos", "title", "venue", "town", "origin", "date_start", "date_end", "richness", event_key(F.col("title"), F.col("date_start")).alias("key")))
    told = F.col("key").isNotNull()
    keyed = events.where(told)
    first = settle(by_key(keyed).select("key", F.col("winner_pos").alias("pos"), F.col("first_pos").alias("place"), "title", "venue", "town", "origin", "date_start", "date_end", "richness"))
    by_origin = settle(by_containment(first.where("origin is not null"), "origin"))
    moved = by_origin.where("winner_pos = pos").select("pos", F.col("place").alias("seat"))
    lost = by_origin.where("winner_pos <> pos").select("pos")
    second = settle(first.drop("key").join(lost, "pos", "left_anti").join(moved, "pos", "left").withColumn("place", F.coalesce("seat", "place")).drop("seat"))
    by_town = settle(by_containment(second, norm(F.coalesce(F.col("town"), F.lit("")))))
    step = lambda df, own, won: df.select(F.col("pos").alias(own), F.col("winner_pos").alias(won))
    chain = first.select("key", F.col("pos").alias("w1")).join(step(by_origin, "w1", "w2"), "w1", "left").withColumn("w2", F.coalesce("w2", "w1")).join(step(by_town, "w2", "w3"), "w2")
    chain = keyed.select(F.col("pos").alias("own"), "key").join(chain, "key")
    why = F.when(F.col("own") != F.col("w1"), "key").when(F.col("w1") != F.col("w2"), "origin").when(F.col("w2") != F.col("w3"), "containment")
    untold = events.where(~told).select("pos", F.col("pos").alias("winner_pos"), F.lit(None).cast("string").alias("why"))
    return chain.select(F.col("own").alias("pos"), F.col("w3").alias("winner_pos"), why.alias("why")).unionByName(untold)


def final_winners(edges: DataFrame, most: int = 100) -> DataFrame:
    """(loser, winner) edges to (loser, final), by doubling: each round follows the winner's own edge, is written, and the last one moves nothing.

    Rounds end when they reach ``most`` hops: a longer chain stops on the way, as the record's own guard has it, and a cycle at one of its members.
    """
    now, hops = settle(edges.groupBy("loser").agg(F.min("winner").alias("final"))), 1
    while hops < most:
        step = now.select(F.col("loser").alias("final"), F.col("final").alias("onward"))
        moves = F.col("onward").isNotNull() & (F.col("onward") != F.col("loser"))
        after = settle(now.join(step, "final", "left").select("loser", F.when(moves, F.col("onward")).otherwise(F.col("final")).alias("final"), moves.alias("moved")))
        now, hops = after.drop("moved"), hops * 2
        if after.where("moved").isEmpty():
            break
    return now


def first_in_bucket(df: DataFrame, key: str, order: str) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_r = 1").drop("_r")

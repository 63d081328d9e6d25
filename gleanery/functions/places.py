"""What to ask a geocoder about a venue: its parts, without prose, as a ladder of queries. All column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.text import ACCENTED, PLAIN, let

#: Words that are no place by themselves. Fixed values.
GENERIC = ("sala", "salka", "aula", "hala", "start", "meta", "zbiorka", "parking", "wejscie", "scena", "foyer", "swietlica", "budynek", "miejsce")
#: Kinds of places as they stand in a sentence, and by themselves. Fixed values.
CASES = {"placu": "plac", "parku": "park", "rynku": "rynek", "skwerze": "skwer", "osiedlu": "osiedle", "alei": "aleja", "dworcu": "dworzec", "moście": "most"}
#: Lower-case words that begin a name. Fixed values.
STARTS = (*CASES, *CASES.values(), "ul", "ul.", "ulica", "al", "al.", "aleja", "aleje", "os", "os.", "osiedle", "pl", "pl.", "plac", "park", "rynek", "skwer", "bulwar", "las", "lasek")
#: Nouns that open an institution's name: in capitals within a part they are the seam of two names. Fixed values.
HEADS = (
    "muzeum", "akademia", "uniwersytet", "politechnika", "teatr", "kino", "opera", "filharmonia", "galeria", "biblioteka", "kosciol", "katedra", "bazylika", "klasztor", "palac", "zamek", "dwor", "dworek", "ratusz", "stadion",
    "hala", "basen", "hipodrom", "centrum", "klub", "dom", "szkola", "liceum", "przedszkole", "swietlica", "amfiteatr", "skansen", "ogrod", "fort", "cytadela", "osrodek", "arena", "planetarium",
)
#: What stands around a name: a label, a remark behind a dash, a tail with a preposition. Fixed values, in order.
PROSE = ("^[\\p{L} ]{1,15}:\\s*", "\\s+[-–—]\\s+\\p{Ll}[^-–—]{0,24}$", "\\s+(?:przy|koło|obok|naprzeciw(?:ko)?|nieopodal|pod)\\s+\\p{Ll}.*$")
#: What a query leaves out: the word for a street, the town in the locative, signs at the ends. Fixed values, in order.
LEFT_OUT = ("(?i)^(?:ulica|ul)\\.?\\s+", "\\s+w\\s+\\p{Lu}\\p{L}+$", "^[\\s.,;–-]+|[\\s.,;–-]+$")
#: Endings of adjectives made of a town's name, without marks. Fixed values.
ADJECTIVE = "(?:sk|ck|dzk)(?:i|a|ie|iego|iej|iemu|im|ich)$"
#: Letters that such an adjective shares with its town.
SHARED = 4


def plain(text: Column) -> Column:
    """Lower case without marks; the crossed l has none to lose."""
    return F.translate(F.lower(text), ACCENTED, PLAIN)


def _without(text: Column, patterns: tuple[str, ...]) -> Column:
    for p in patterns:
        text = F.regexp_replace(text, p, "")
    return text


def _capital(word: Column) -> Column:
    return word.rlike("^\\p{Lu}")


def _from(words: Column, first: Column) -> Column:
    """Words from the place ``first`` (from 0) on."""
    return F.slice(words, first + 1, F.greatest(F.size(words) - first, F.lit(0)))


def trimmed(part: Column) -> Column:
    """A part without the prose around its name, which begins with its first capital or kind of place, in the nominative."""
    begins = lambda w: let(F.lower(w), lambda x: _capital(w) | x.isin(*STARTS) | F.replace(x, F.lit("."), F.lit("")).isin(*STARTS))
    cases = F.create_map(*[F.lit(x) for pair in CASES.items() for x in pair])

    def cut(words: Column) -> Column:
        at = F.array_position(F.transform(words, begins), True).cast("int")
        return let(at, lambda k: _from(words, F.when(k > 0, k - 1).otherwise(F.size(words) - 1)))

    def nominative(kept: Column) -> Column:
        return let(F.get(kept, F.lit(0)), lambda head: F.array_join(F.concat(F.array(F.coalesce(cases[F.lower(head)], head)), _from(kept, F.lit(1))), " "))

    return let(let(F.split(_without(F.trim(F.regexp_replace(part, "\\s+", " ")), PROSE), " "), cut), nominative)


def one_query(part: Column) -> Column:
    """What to ask about a part, or null where it is no place: too short, or a common word, alone or with an adjective."""

    def judged(q: Column) -> Column:
        common = lambda w: plain(F.get(w, F.lit(0))).isin(*GENERIC) & ((F.size(w) == 1) | ((F.size(w) == 2) & ~_capital(F.coalesce(F.get(w, F.lit(1)), F.lit("X")))))
        return F.when((F.length(q) >= 3) & ~let(F.split(q, " "), common), q)

    return let(_without(trimmed(part), LEFT_OUT), judged)


def locality(part: Column) -> Column:
    """(text, town): the street of a part that has one, and the town before it: one or two words in capitals; other words before a street are prose."""
    pattern = "(?iu)^(.*?)\\s+(?:ulica|ul)\\.?\\s+(.+)$"
    both = F.struct(F.trim(F.regexp_extract(F.trim(part), pattern, 1)).alias("left"), F.regexp_extract(F.trim(part), pattern, 2).alias("street"))
    town = lambda b: F.when((b["street"] != "") & b["left"].rlike("^\\p{Lu}[\\p{L}-]+(\\s\\p{Lu}[\\p{L}-]+)?$"), b["left"])
    return let(both, lambda b: F.struct(F.when(b["street"] != "", b["street"]).otherwise(part).alias("text"), town(b).alias("town")))


def without_adjective(q: Column, town: Column) -> Column:
    """A query without the adjective of its town at its end or start; null where there is none, or where only a kind of place would be left."""
    own = lambda w, near: let(plain(w), lambda x: (F.length(x) > 4) & x.rlike(ADJECTIVE) & (F.length(near) == SHARED) & x.startswith(near))

    def rest_of(words: Column) -> Column:
        n = F.size(words)
        return let(F.substring(plain(town), 1, SHARED), lambda near: F.when(n >= 2, F.when(own(F.element_at(words, -1), near), F.slice(words, F.lit(1), F.greatest(n - 1, F.lit(0)))).when(own(F.get(words, F.lit(0)), near), _from(words, F.lit(1)))))

    alone = lambda rest: (F.size(rest) == 1) & plain(F.get(rest, F.lit(0))).isin(*STARTS, *GENERIC)
    return let(let(F.split(q, " "), rest_of), lambda rest: F.when(rest.isNotNull() & ~alone(rest), F.array_join(rest, " ")))


def two_names(q: Column) -> Column:
    """Both names of a part that runs two together, as an array; null where no seam leaves two whole words on either side."""
    clean = lambda s: F.regexp_replace(s, "^[\\s.,;–—-]+|[\\s.,;–—-]+$", "")
    full = lambda s: F.size(F.filter(F.split(s, " "), lambda w: w.rlike("[\\p{L}0-9]")))

    def first_seam(words: Column) -> Column:
        halves = lambda k: F.array(clean(F.array_join(F.slice(words, F.lit(1), k), " ")), clean(F.array_join(_from(words, k), " ")))
        seam = lambda k: let(F.get(words, k), lambda w: plain(w).isin(*HEADS) & _capital(w))
        seams = F.filter(F.when(F.size(words) > 1, F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1)))), seam)
        return F.get(F.filter(F.transform(seams, halves), lambda h: (full(h[0]) >= 2) & (full(h[1]) >= 2)), F.lit(0))

    return let(F.split(q, " "), first_seam)


def place_queries(venue: Column, town: Column) -> Column:
    """The ladder of a venue as an array of (q, town), in the order of asking: each part, then without its town's adjective, then its two names; equal ones once.

    town is there where a part names its own. A null or blank venue asks nothing.
    """
    parts = F.split(F.regexp_replace(F.coalesce(venue, F.lit("")), "[()]", ","), "[,;]|\\s/\\s")
    home = F.coalesce(town, F.lit(""))

    def asked(part: Column) -> Column:
        def told(own: Column) -> Column:
            every = lambda q: F.concat(F.array(q, without_adjective(q, F.coalesce(own["town"], home))), F.coalesce(two_names(q), F.array().cast("array<string>")))
            return F.transform(F.filter(let(one_query(own["text"]), every), lambda x: x.isNotNull()), lambda x: F.struct(x.alias("q"), own["town"].alias("town")))

        return let(locality(part), told)

    def once(ladder: Column) -> Column:
        keys = F.transform(ladder, lambda x: F.concat_ws("|", plain(x["q"]), F.coalesce(plain(x["town"]), F.lit(""))))
        return let(keys, lambda names: F.filter(F.transform(ladder, lambda x, k: F.when(F.array_position(names, F.get(names, k)) == k + 1, x)), lambda x: x.isNotNull()))

    return F.coalesce(let(F.flatten(F.transform(parts, asked)), once), F.array().cast("array<struct<q:string,town:string>>"))

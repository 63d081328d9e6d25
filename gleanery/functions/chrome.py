"""Boilerplate: whether a block of lines is the site's own furniture, as a column expression."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Beginnings of month names, phrases that no event holds, lines that are buttons, and a line of a pager.
MONTH = "(?iu)(?:^|[^A-Za-z0-9_])(?:stycz|lut(?:y|ego)|marc|marz|kwie|maj|czerw|lip|sierp|wrze|paździer|listopad|grud)"
DATE = "(?<!\\d)(?:(?:[0-2]?\\d|3[01])[.\\-/](?:0?\\d|1[0-2])(?:[.\\-/]\\d{2,4})?|\\d{4}-\\d{2}-\\d{2})(?!\\d)"
TIME = "(?:^|[^A-Za-z0-9_])\\d{1,2}[:.]\\d{2}(?:$|[^A-Za-z0-9_])"
PHRASES = (
    "polityka prywatności", "polityki prywatności", "pliki cookies", "plików cookies",
    "pliki cookie", "plików cookie", "wykorzystujemy pliki", "używamy plików", "korzysta z plików",
    "zgodę na przetwarzanie", "administratorem danych", "przetwarzania danych osobowych",
    "deklaracja dostępności", "deklarację dostępności", "rodo", "wszelkie prawa zastrzeżone",
    "regulamin serwisu", "ustawienia cookies", "niezbędne cookies",
    "strona główna", "mapa strony", "przejdź do treści", "przejdź do menu", "menu główne",
    "javascript:void", "biuletyn informacji publicznej", "bip", "wersja kontrastowa",
    "rozmiar czcionki", "zmień rozmiar", "wyczyść filtry", "zapisz się do newslettera",
    "wpisz szukaną", "wyszukiwarka", "szukaj w serwisie",
)
BUTTONS = (
    "czytaj więcej", "pokaż więcej", "zobacz więcej", "zobacz wszystkie", "wróć do listy",
    "powrót do listy", "poprzednia strona", "następna strona", "zaloguj", "wyloguj",
    "rejestracja", "newsletter", "akceptuję wszystkie", "zamknij", "menu", "szukaj",
    "ustawienia", "kontakt",
)
PAGER = "(?iu)^[*\\s]*(?:[«»<>←→]+|\\d{1,3}|poprzedni\\w*|następn\\w*|nastepn\\w*)\\s*(?:\\(aktualna\\))?\\s*(?:\\[[^\\]]*\\])?[*\\s]*$"


def _words(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}]+", " "))


def lines_of(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def looks_like_chrome(text: Column, phrases: tuple[str, ...] = PHRASES, buttons: tuple[str, ...] = BUTTONS) -> Column:
    """A date or a time speaks for content. Two phrases, one with a furniture-like shape, or the shape alone by higher bars, speak for furniture."""
    # the text's words and lines are worked out once: a lambda gets them as a value
    ready = F.array(F.struct(text.alias("text"), F.concat(F.lit(" "), _words(text), F.lit(" ")).alias("words"), lines_of(text).alias("lines")))
    known = F.array(*[F.lit(" " + " ".join("".join(c if c.isalnum() else " " for c in p).split()) + " ") for p in phrases])
    button = lambda x: _words(F.regexp_replace(x, "\\[[^\\]]*\\]", " ")).isin(*buttons)
    shape = lambda x: F.struct(F.size(F.split(x, "\\s+")).alias("n"), x.contains("[").alias("link"), x.rlike(PAGER).alias("pager"), button(x).alias("button"))
    # dates and times need a digit, which is quickly looked for
    vetoed = lambda t: (t.rlike("\\d") & (t.rlike(DATE) | t.rlike(TIME))) | t.rlike(MONTH)
    measured = F.transform(ready, lambda r: F.struct(vetoed(r["text"]).alias("veto"), r["text"].rlike("\\d").alias("digit"), F.size(F.filter(known, lambda p: r["words"].contains(p))).alias("hits"), F.transform(r["lines"], shape).alias("lines")))
    count = lambda m, cond: F.size(F.filter(m["lines"], cond))
    counted = F.transform(
        measured,
        lambda m: F.struct(
            m["veto"].alias("veto"), m["digit"].alias("digit"), m["hits"].alias("hits"), F.size(m["lines"]).alias("n"),
            count(m, lambda x: x["n"] <= 3).alias("short3"), count(m, lambda x: x["n"] <= 6).alias("short6"), count(m, lambda x: x["link"]).alias("links"),
            count(m, lambda x: x["pager"]).alias("pages"), count(m, lambda x: x["button"]).alias("buttons"),
        ),
    )

    def judge(c: Column) -> Column:
        n = c["n"]
        by_shape = (
            ((c["links"] >= 0.7 * n) & (c["short3"] >= 0.8 * n) & (n >= 4) & ~c["digit"])
            | ((c["links"] >= 0.85 * n) & (c["short6"] >= 0.9 * n) & (n >= 6))
            | ((c["pages"] >= 4) & (c["pages"] >= 0.6 * n))
            | ((c["buttons"] >= 2) & (c["buttons"] >= 0.5 * n))
        )
        one = (c["hits"] == 1) & ((c["short3"] >= 0.6 * n) | (c["links"] >= 0.5 * n))
        return F.when(c["veto"] | (n == 0), F.lit(False)).when((c["hits"] >= 2) | one, F.lit(True)).otherwise(by_shape)

    verdict = F.coalesce(F.transform(counted, judge)[0], F.lit(False))
    # most texts are settled by a glance: a single line with no word of any phrase has no hit, and no shape
    rarest = sorted({max("".join(c if c.isalnum() else " " for c in p).split(), key=len) for p in phrases}, key=len)
    telling = [w for k, w in enumerate(rarest) if not any(v in w for v in rarest[:k])]
    hinted = lambda t: reduce(or_, (t.contains(w) for w in telling), F.lit(False))
    plain = F.transform(F.array(F.lower(text)), lambda t: ~t.contains("\n") & ~hinted(t))[0]
    return F.when(plain, F.lit(False)).otherwise(verdict)

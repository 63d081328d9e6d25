"""Text functions, column to column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.config import CONFIG

#: Letters with marks and what remains of them. Fixed values; the crossed l has no mark to lose and is not among them.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿąćęńóśźż"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyacenoszz"
#: What keyboards have besides letters, digits and the underscore: settled one by one, so that few texts need a pattern that stops at each.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^`{|}~\t\n\r"
POLISH, POLISH_PLAIN = "ąćęłńóśźż", "acelnoszz"


def let(value: Column, then) -> Column:
    """A value that an expression uses several times, computed once; nested expressions stay small."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def norm(text: Column) -> Column:
    """Lower case without marks, other characters as single spaces, trimmed; the crossed l becomes a space."""
    marks = MARKS + "_"
    plain = F.translate(F.lower(text), ACCENTED + marks, PLAIN + " " * len(marks))
    # a look from end to end is cheap, a search for what doesn't belong is not
    plain = F.when(plain.rlike("\\A[a-z0-9 ]*+\\z"), plain).otherwise(F.regexp_replace(plain, "[^a-z0-9 ]+", " "))
    single = F.replace(F.replace(plain, F.lit("  "), F.lit(" ")), F.lit("  "), F.lit(" "))
    return F.trim(F.when(single.contains("  "), F.regexp_replace(single, "  +", " ")).otherwise(single))


def long_words(normal: Column, least: int = CONFIG.token_length) -> Column:
    """The distinct words of a normal form that are long enough."""
    return F.array_distinct(F.regexp_extract_all(normal, F.lit(f"[^ ]{{{least},}}+"), F.lit(0)))


def tokens(text: Column, least: int = CONFIG.token_length) -> Column:
    """The distinct words of the normal form that are long enough."""
    return long_words(norm(text), least)


def deascii(text: Column) -> Column:
    return F.translate(F.lower(text), POLISH, POLISH_PLAIN)


def slug(text: Column, most: int = 48) -> Column:
    """Lower-case letters and digits with single dashes between, of bounded length."""
    return F.substring(F.regexp_replace(F.regexp_replace(deascii(text), "[^a-z0-9]+", "-"), "^-+|-+$", ""), 1, most)


def fold(text: Column) -> Column:
    """For searches: lower case without marks, the crossed l as l."""
    return F.translate(F.lower(text), ACCENTED + "ł", PLAIN + "l")


def canonical(text: Column) -> Column:
    """Lower-case letters and digits alone."""
    return F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}]+", "")


def event_key(title: Column, day: Column, length: int = CONFIG.key_length) -> Column:
    """ASCII word characters of the lower-case title, cut, and the day."""
    # what keyboards have goes first, as literals: the pattern is for what is left
    bare = F.translate(F.lower(title), " " + MARKS, "")
    bare = F.when(bare.rlike("\\A[a-z0-9_]*+\\z"), bare).otherwise(F.regexp_replace(bare, "[^a-zA-Z0-9_]+", ""))
    return F.concat(F.substring(bare, 1, length), F.lit("|"), day.cast("string"))


def share_shape(original: Column, caption: Column) -> Column:
    """Which of an original and its caption adds nothing: 'original' suffices, 'caption' suffices, or 'both' are needed."""
    a, b = canonical(F.coalesce(original, F.lit(""))), canonical(F.coalesce(caption, F.lit("")))
    return F.when(a.contains(b), "original").when(b.contains(a), "caption").otherwise("both")


def stems(text: Column, length: int = CONFIG.stem_length) -> Column:
    """Distinct beginnings of the words of three letters or more."""
    words = F.filter(F.split(F.trim(F.regexp_replace(fold(text), "[^a-z0-9]+", " ")), " "), lambda w: F.length(w) >= 3)
    return F.array_distinct(F.transform(words, lambda w: F.substring(w, 1, length)))


def paragraphs(text: Column) -> Column:
    """What stands between blank lines, with line ends trimmed; blank ones go."""
    unix = F.regexp_replace(text, "\\r\\n", "\n")
    parts = F.transform(F.split(unix, "\n[ \\t]*\n+"), lambda p: F.regexp_replace(F.regexp_replace(p, "[ \\t]+(\n|$)", "$1"), "^\\s+|\\s+$", ""))
    return F.filter(parts, lambda p: p != "")


def stable_text(text: Column) -> Column:
    """The text with dated calendar paths made alike, so that a day's turn changes no hash."""
    dated = F.regexp_replace(text, "/(?:19|20)\\d\\d-\\d\\d-\\d\\d(?:/)?(?:\\?[^\\s\\]]*)?", "/@@D@@")
    return F.when(text.contains("/19") | text.contains("/20"), dated).otherwise(text)


def block_hash(text: Column) -> Column:
    return F.sha2(stable_text(text), 256)


def author_key(salt: str, author: Column) -> Column:
    """A salted short hash, so that no name is stored."""
    return F.substring(F.sha2(F.concat(F.lit(salt), author), 256), 1, 16)


def price_of(raw: Column) -> Column:
    """Struct (free, amount) of a price text: a word for free or a zero makes it free; the first number is the amount."""
    amount = F.regexp_replace(F.regexp_extract(raw, "([0-9]+(?:[.,][0-9]{1,2})?)", 1), ",", ".").try_cast("double")
    free = F.lower(raw).rlike("bezp[łl]atn|wst[ęe]p woln|za darmo|free")
    return F.struct((free | F.coalesce(amount == 0, F.lit(False))).alias("free"), F.when(free, F.lit(0.0)).otherwise(amount).alias("amount"))

"""String functions as Column expressions. Nothing here leaves the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that count as white space.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: White space that is not one space alone: a run that begins with another character, or that has more than one.
_RUNS = rf"{SPACE.replace(chr(92) + 'x20', chr(92) + 'x1f')}{SPACE}*| {SPACE}+"
#: Digits, among them superscript, subscript and circled ones.
DIGIT = r"[\p{Nd}²³¹⁰⁴-⁹₀-₉①-⑨]"
#: Punctuation stripped from both ends of a name.
EDGES = ".,;:()[]{}"
#: Word beginnings after which a capital does not start a new word.
PREFIXES = ("Mc", "Mac", "O")
#: What may follow a last name.
SUFFIXES = ("jr", "sr", "ii", "iii", "iv", "v")


def normalize_space(text: Column) -> Column:
    """Null is empty; runs of white space are one space; none at the ends."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), _RUNS, " "))


def _once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with a value that is computed once however often f names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def chunks(text: Column) -> Column:
    """The non-empty pieces between full stops and commas, normalised, in order, duplicates kept."""
    return F.filter(F.transform(F.split(normalize_space(text), "[.,]+"), lambda c: F.trim(c)), lambda c: c != "")


def is_upper(text: Column) -> Column:
    """Some cased character and none in lower case."""
    return (F.upper(text) == text) & (F.lower(text) != text)


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def title(text: Column) -> Column:
    """Upper case after every character without case, lower case elsewhere; of a letter whose capital is two, the first is large."""
    capital = lambda c: F.concat(F.substring(F.upper(c), 1, 1), F.lower(F.substring(F.upper(c), 2, 9)))
    letters = _characters(text)
    cased = lambda c: F.upper(c) != F.lower(c)
    # Each character meets the one before it; the array of those is longer by one, and what it leaves over is null.
    before = F.concat(F.array(F.lit("")), letters)
    return F.array_join(F.zip_with(letters, before, lambda c, b: F.when(cased(b), F.lower(c)).otherwise(capital(c))), "")


#: What a joined word falls into: what is before its first capital; then a capital and what follows up to the next one, which takes
#: the next such piece too if it is one of PREFIXES alone.
_JOINED = rf"\P{{Lu}}+|(?:(?:{'|'.join(PREFIXES)})(?=\p{{Lu}}))?\p{{Lu}}\P{{Lu}}*"


def split_joined_capitals(text: Column) -> Column:
    """JakeSmith -> Jake Smith; words in capitals and words of fewer than six letters stay as they are."""
    parts = F.regexp_extract_all(text, F.lit(rf"[A-Za-z]+|{SPACE}+|[^A-Za-z{SPACE[1:-1]}]+"), F.lit(0))
    joined = lambda p: p.rlike(r"^\p{L}+$") & ~is_upper(p) & (F.length(p) >= 6)
    return F.array_join(F.transform(parts, lambda p: F.when(joined(p), F.array_join(F.regexp_extract_all(p, F.lit(_JOINED), F.lit(0)), " ")).otherwise(p)), "")


def clean_name(text: Column, stopwords: tuple[str, ...] = ()) -> Column:
    """Normalised, stripped of edge punctuation, capitals turned to title case; null if a token is short, has a digit or is a stopword."""
    stripped = F.btrim(normalize_space(text), F.lit(EDGES))
    cased = _once(stripped, lambda s: F.when(is_upper(s), title(s)).otherwise(s))
    # Of white space only single spaces are left here.
    tokens = F.filter(F.split(cased, " "), lambda t: t != "")
    bad = lambda t: (F.length(t) < 2) | t.rlike(DIGIT) | (t.isin(*stopwords) if stopwords else F.lit(False))
    return _once(tokens, lambda own: F.when((F.size(own) > 0) & ~F.exists(own, bad), F.array_join(own, " ")))


def corpus_key(token: Column) -> Column:
    return F.regexp_replace(F.lower(token), "[^a-z]", "")


def similarity(a: Column, b: Column, cutoff: float = 0.0, processor: Callable[[Column], Column] | None = None) -> Column:
    """0 to 100: edit distance and difference of lengths against the shorter length; 0 below the cutoff. Null is empty.

    processor: what is done to both texts first.
    """
    a, b = (F.coalesce(processor(x) if processor else x, F.lit("")) for x in (a, b))
    shorter = F.greatest(F.lit(1), F.least(F.length(a), F.length(b)))
    value = F.greatest(F.lit(0.0), (1 - (F.levenshtein(a, b) + F.abs(F.length(a) - F.length(b))) / shorter) * 100)
    return F.when(value >= cutoff, value).otherwise(F.lit(0.0))


def page_stem(page: Column) -> Column:
    return F.format_string("page%04d", page)


def utc_stamp(at: Column) -> Column:
    """Seconds in UTC, whatever the session's time zone."""
    wall = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.unix_seconds(at))
    return F.concat(F.replace(wall.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def scale_of(dpi: float) -> float:
    """Pixels for each point of a page at this resolution."""
    return dpi / 72

"""Scalar text functions as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fold_heading(x: Column) -> Column:
    """Lower case, `&` as `and`, runs of white space as one blank."""
    return F.trim(F.regexp_replace(F.replace(F.lower(x), F.lit("&"), F.lit(" and ")), r"\s+", " "))


def slug(url: Column) -> Column:
    """The last segment of a url's path that isn't empty, in lower case, other characters than letters and digits as single hyphens; `index` without one."""
    path = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*:", "")
    path = F.regexp_replace(path, r"^//[^/]*", "")
    last = F.try_element_at(F.filter(F.split(path, "/"), lambda x: x != ""), F.lit(-1))
    plain = F.regexp_replace(F.regexp_replace(F.lower(last), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.coalesce(F.nullif(plain, F.lit("")), F.lit("index"))


def clock(hhmm: Column) -> Column:
    return F.format_string("%02d:%02d", F.floor(hhmm / 100).cast("int"), (hhmm % 100).cast("int"))


def clock_of_minutes(minutes: Column) -> Column:
    m = F.pmod(minutes, F.lit(1440))
    return F.format_string("%02d:%02d", F.floor(m / 60).cast("int"), (m % 60).cast("int"))


def html(x: Column) -> Column:
    out = x
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def command(x: Column) -> Column:
    """A text inside a CI command: per cent signs first, then line ends."""
    out = x
    for a, b in (("%", "%25"), ("\r", "%0D"), ("\n", "%0A")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def rate(x: Column) -> Column:
    """The shortest text of a rate, whole numbers without a fraction; a dash for none."""
    return F.coalesce(F.regexp_replace(x.cast("string"), r"\.0$", ""), F.lit("-"))


def fixed(x: Column, places: int) -> Column:
    """A number that isn't negative with so many places: the closest one, the larger of two as close.

    Near a midpoint the double next to it is compared; if the number is that double, the sign of its error decides, as doubles seldom are midpoints.
    """
    scale = 10**places
    n = F.floor(x * scale)
    middle = (2 * n + 1) / F.lit(2.0 * scale)
    half = F.lit(134217729.0) * middle
    high = half - (half - middle)
    product = middle * (2.0 * scale)
    error = (high * (2.0 * scale) - product) + (middle - high) * (2.0 * scale)
    above = F.when(x == middle, (product - (2 * n + 1)) + error >= 0).otherwise(x > middle)
    whole = (n + above.cast("int")).cast("bigint")
    return F.concat(F.floor(whole / scale).cast("string"), F.lit("."), F.lpad((whole % scale).cast("string"), places, "0"))


def usd(x: Column) -> Column:
    """money() of the page with its sign."""
    from .page import money

    return F.concat(F.lit("$"), money(x))


def weekday(day: Column) -> Column:
    return F.lower(F.date_format(day, "EEEE"))


def real_day(text: Column) -> Column:
    """Whether a text is a day of the calendar, not only shaped like one."""
    return F.coalesce(text.rlike(r"^\d{4}-\d{2}-\d{2}$") & (F.date_format(F.try_to_date(text, "yyyy-MM-dd"), "yyyy-MM-dd") == text), F.lit(False))


#: Characters that a line of wrapped prose may have, unless one word is longer.
LINE = 600


def wrapped(text: Column) -> Column:
    """A sentence a line, longer lines broken at blanks, a line end behind the last; unwrapped() is its inverse for prose of single blanks."""
    words = lambda line: F.split(line, " ")
    start = F.struct(F.array().cast("array<string>").alias("lines"), F.lit("").alias("now"))

    def put(state: Column, word: Column) -> Column:
        joins = (state["now"] == "") | (F.length(state["now"]) + 1 + F.length(word) <= LINE)
        now = F.when(state["now"] == "", word).when(joins, F.concat(state["now"], F.lit(" "), word)).otherwise(word)
        return F.struct(F.when(joins, state["lines"]).otherwise(F.concat(state["lines"], F.array(state["now"]))).alias("lines"), now.alias("now"))

    broken = lambda line: F.aggregate(words(line), start, put, lambda s: F.concat(s["lines"], F.filter(F.array(s["now"]), lambda x: x != "")))
    sentences = F.split(F.regexp_replace(text, r"(?<=[.!?]) ", "\n"), "\n")
    return F.concat(F.array_join(F.flatten(F.transform(sentences, lambda line: F.when(F.length(line) <= LINE, F.array(line)).otherwise(broken(line)))), "\n"), F.lit("\n"))


def unwrapped(text: Column) -> Column:
    """Every run of white space as one blank."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def channel_prose(url: Column, page: Column) -> Column:
    """prose() of a channel: text files as they are, dates of a feed left out, as they move with every fetch."""
    text_file = F.regexp_replace(url, r"[?#].*$", "").rlike(r"(?i)\.(md|txt)$")
    feed = page.rlike(r"(?is)^\s*(<\?xml[^>]*>\s*)?(<!--.*?-->\s*)*<(rss|feed)\b")
    undated = F.regexp_replace(page, r"(?is)<(lastbuilddate|pubdate|published|updated|dc:date)\b[^>]*>.*?</\1\s*>", " ")
    return F.when(text_file, F.trim(F.regexp_replace(page, r"\s+", " "))).otherwise(prose(F.when(feed, undated).otherwise(page)))


def prose(page: Column) -> Column:
    """A page's visible text: no scripts, styles or tags, white space as single blanks."""
    bare = F.regexp_replace(page, r"(?is)<(script|style|noscript)\b.*?</\1\s*>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"(?s)<[^>]*>", " "), r"\s+", " "))


def tokens(text: Column) -> Column:
    """A token count such as 128K or 1M: the number is floored, then scaled by 1024."""
    n = F.regexp_extract(text, r"^\s*([\d,]+(?:\.\d+)?)\s*([KkMm]?)", 1)
    unit = F.upper(F.regexp_extract(text, r"^\s*([\d,]+(?:\.\d+)?)\s*([KkMm]?)", 2))
    number = F.floor(F.replace(n, F.lit(","), F.lit("")).try_cast("double"))
    return (number * F.when(unit == "K", 1024).when(unit == "M", 1024 * 1024).otherwise(1)).cast("bigint")


def today() -> Column:
    """The day in UTC, whatever the session's zone."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd")

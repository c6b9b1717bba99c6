"""Column helpers for strings, numbers, dates and codes.

White space is Unicode's throughout: Java's plain \\s and Spark's trim know ASCII only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WS = r"(?U)\s+"
DASHES = ("", "—", "–", "-")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    return F.regexp_replace(c, WS, " ")


def is_missing(c: Column) -> Column:
    """Null, blank and the word null count as missing identifiers."""
    return c.isNull() | (strip(c.cast("string")) == "") | (c.cast("string") == "null")


def present(c: Column) -> Column:
    return F.when(~is_missing(c), c)


def mended(c: Column) -> Column:
    """Text without no-break spaces, words broken at a hyphen joined, / as a blank, squeezed."""
    s = F.regexp_replace(F.coalesce(c, F.lit("")), "\u00a0", " ")
    s = F.regexp_replace(s, r"(?U)(\w)-\s+(\w)", "$1$2")
    return squeeze(F.regexp_replace(s, "/", " "))


def clean_text(c: Column) -> Column:
    """Cell text: hyphenated breaks joined, bracketed notes, $ and commas gone, squeezed, lower case."""
    s = F.regexp_replace(mended(c), r"\([^)]*\)", "")
    s = F.translate(s, "$,", "")
    return F.lower(strip(squeeze(s)))


def snake(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def fold(c: Column) -> Column:
    """Text as the scorers see it."""
    return F.lower(strip(squeeze(c)))


def zfill(c: Column, width: int) -> Column:
    """Zero-padded, longer values untouched (lpad would cut them)."""
    s = c.cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def gvkey(c: Column) -> Column:
    digits = F.regexp_extract(c.cast("string"), r"^\s*(\d+)(?:\.0+)?\s*$", 1)
    return F.when(digits != "", zfill(digits, 6))


NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_double(c: Column) -> Column:
    """A double if the whole text is a number; casts alone would also take 12d."""
    return F.when(c.rlike(NUMBER), F.trim(c).try_cast("double"))


def to_number_or_zero(c: Column) -> Column:
    """Placeholders are 0.0, a bracket is a minus sign, other characters go; null if nothing parses."""
    s = strip(F.coalesce(c, F.lit("")))
    digits = F.regexp_replace(F.regexp_replace(s, r"\(", "-"), r"[^0-9.\-]", "")
    return F.when(s.isin(*DASHES), F.lit(0.0)).otherwise(to_double(digits))


def to_number(c: Column) -> Column:
    """Dash or blank is null, (n) is negative only as a whole."""
    s = F.translate(strip(c), "$, ", "")
    inner = F.regexp_extract(s, r"^\(([^()]*)\)$", 1)
    return F.when(s.isin(*DASHES), F.lit(None).cast("double")).when(inner != "", -to_double(inner)).otherwise(to_double(s))


def to_int(c: Column) -> Column:
    """Lenient integer; fractions are cut."""
    return to_double(c.cast("string")).cast("long")


def year_of(c: Column) -> Column:
    """A number's integer, else the first 19xx or 20xx that stands alone."""
    found = F.regexp_extract(c, r"\b((?:19|20)\d{2})\b", 1)
    return F.coalesce(to_double(c).cast("int"), F.when(found != "", found.cast("int")))


#: Fixed words of positions.
POSITIONS = (
    r"chief\s*executive\s*officer|ceo|chief\s*financial\s*officer|cfo|chief\s*operating\s*officer|coo|president|vice\s*president|vp|senior\s*vice\s*president|svp|"
    r"executive\s*vice\s*president|evp|director|chairman|chair|officer|secretary|treasurer|principal|general\s*counsel|principal\s*accounting\s*officer|pao|"
    r"chief\s*legal\s*officer|clo|vice\s*chairman|founder|lead\s*director"
)


def looks_like_name(c: Column) -> Column:
    """Whether a lower-case part can be a person: initials, commas, suffixes or two words that aren't a position as a whole, or letters side by side."""
    s = strip(c)
    position = s.rlike(rf"(?i)^\b(?:{POSITIONS})\b$")
    marked = s.rlike(r"\b[a-z]\.?\b|,|jr|sr|iii|iv") | (F.regexp_count(s, F.lit("[a-z]+")) >= 2)
    return (s != "") & ((marked & ~position) | s.rlike(r"(?i)[a-z]\.?\s*[a-z]"))


def name_and_position(parts: Column) -> Column:
    """Struct name, position of a block's parts: the first part that can be a name, and all others; without one all are position."""
    parts = F.filter(F.transform(parts, strip), lambda x: x != "")
    at = F.array_position(F.transform(parts, looks_like_name), True).cast("int")
    rest = F.array_join(F.filter(parts, lambda x, i: i + 1 != at), " ")
    return F.struct(
        F.when(at > 0, F.get(parts, at - 1)).otherwise(F.lit("")).alias("name"),
        F.when(at > 0, rest).otherwise(F.array_join(parts, " | ")).alias("position"),
    )


#: Fixed patterns of names and words of positions of the first splitter, in the order they are tried.
FIRST_NAMES = (
    r"((?:[A-Z]\.?\s*){1,2}\s*[A-Z][a-z]+(?:\s+(?:Jr\.?|Sr\.?|III|IV))?)",
    r"([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,2}(?:\s+(?:Jr\.?|Sr\.?|III|IV))?)",
    r"([A-Z][a-z]+,\s*[A-Z]\.?)",
)
FIRST_POSITIONS = (
    r"chief\s*executive\s*officer|ceo|chief\s*financial\s*officer|cfo|chief\s*operating\s*officer|coo|president|vice\s*president|vp|senior\s*vice\s*president|svp|"
    r"executive\s*vice\s*president|evp|director|chairman|chair|officer|secretary|treasurer|principal|general\s*counsel"
)


def first_split(c: Column) -> Column:
    """Struct name, position of one text, as the first splitter has it: a name by pattern and what is left of the text
    around it, else a position by its word and what is left as name, if that is one; else all is name."""
    title_word = rf"(?i)\b(?:{FIRST_POSITIONS})\b"
    found = lambda text, pattern: F.nullif(F.regexp_extract(text, pattern, 0), F.lit(""))
    without = lambda text, part: strip(F.overlay(text, F.lit(""), F.instr(text, part), F.length(part)))

    def likely(s: Column) -> Column:
        marked = s.rlike(r"\b[A-Z]\.?\b|,|Jr\.?|Sr\.?|III|IV")
        return (F.regexp_count(s, F.lit("[A-Za-z]+")) >= 2) & (marked | ~s.rlike(rf"(?i)^\b(?:{FIRST_POSITIONS})\b$"))

    def step(value: Column, then) -> Column:
        """then(value), the value worked out once."""
        return F.get(F.transform(F.array(value), then), F.lit(0))

    def named(text: Column, name: Column) -> Column:
        pick = lambda rest: F.struct(name.alias("name"), F.when(rest.rlike(title_word) | ~likely(rest), rest).otherwise("").alias("position"))
        return step(without(text, name), pick)

    def titled(text: Column, title: Column) -> Column:
        def pick(person: Column) -> Column:
            whole = ~likely(person) & (F.regexp_count(person, F.lit(r"\S+")) < 2)
            return F.struct(F.when(whole, "").otherwise(person).alias("name"), F.when(whole, text).otherwise(title).alias("position"))

        return step(without(text, title), pick)

    def whole(x: Column) -> Column:
        text, name, title = x["text"], x["name"], x["title"]
        plain = F.struct(text.alias("name"), F.lit("").alias("position"))
        return F.when(name.isNotNull(), named(text, name)).when(title.isNotNull(), titled(text, title)).otherwise(plain)

    def parts(text: Column) -> Column:
        name = strip(F.coalesce(*[found(text, f"(?i){p}") for p in FIRST_NAMES]))
        return step(F.struct(text.alias("text"), name.alias("name"), found(text, title_word).alias("title")), whole)

    return step(strip(F.coalesce(c, F.lit(""))), parts)


#: The characters that Windows has in place of the control characters from 0x80, in order; five have none.
WINDOWS = "\u20ac\x81\u201a\u0192\u201e\u2026\u2020\u2021\u02c6\u2030\u0160\u2039\u0152\x8d\u017d\x8f\x90\u2018\u2019\u201c\u201d\u2022\u2013\u2014\u02dc\u2122\u0161\u203a\u0153\x9d\u017e\u0178"


def repaired(c: Column) -> Column:
    """UTF-8 that was read as Windows or Latin-1 text, read right; other texts as they are.

    A text is taken for that if all its characters are of that set and their bytes are valid UTF-8, some beyond ASCII.
    """
    latin = F.translate(c, WINDOWS, "".join(map(chr, range(0x80, 0xA0))))
    fits = latin.rlike(r"^[\x00-\xFF]*$") & latin.rlike(r"[\x80-\xFF]")
    raw = F.encode(F.when(fits, latin), "ISO-8859-1").cast("string")
    return F.when(fits & F.coalesce(F.is_valid_utf8(raw), F.lit(False)), raw).otherwise(c)


def exchange_name(code: Column) -> Column:
    return F.when(code == 1, "NYSE").when(code == 2, "AMEX").when(code == 3, "NASDAQ")


def is_delisted(code: Column) -> Column:
    """100 means active; unknown counts as active."""
    return F.coalesce(to_int(code) != 100, F.lit(False))


def location(address: Column, city: Column, state: Column, zip_code: Column) -> Column:
    blank = lambda c: F.when(strip(c) != "", strip(c))
    tail = F.concat_ws(" ", blank(state), blank(zip_code))
    return F.concat_ws(", ", blank(address), blank(city), F.when(tail != "", tail))


def tagged(source: Column, tag: str) -> Column:
    """source with tag appended once."""
    return F.when(F.coalesce(source, F.lit("")).contains(tag), source).otherwise(F.concat_ws(", ", F.when(source != "", source), F.lit(tag)))


def form_folder(form: Column) -> Column:
    return F.regexp_replace(strip(form), WS, "_")


def file_parts(path: Column) -> dict[str, Column]:
    """Ticker, form and date in <ticker>/<form>/<date>_<form>.<ext>."""
    pattern = r"([^/]+)/([^/]+)/(\d{4}-\d{2}-\d{2})_[^/]*\.(html|txt)$"
    return {n: F.nullif(F.regexp_extract(path, pattern, i), F.lit("")) for i, n in enumerate(("ticker", "form", "date", "ext"), 1)}


def close_to(a: Column, b: Column, rtol: float = 1e-10, atol: float = 1e-8) -> Column:
    """Tolerant equality; two nulls are equal."""
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(F.abs(a - b) <= atol + rtol * F.abs(b))


#: Fixed phrases of a page that was refused.
BLOCKED = ("access denied", "request has been blocked", "forbidden")


def html_status(content: Column, least: int = 2048) -> Column:
    """empty, too_small:<n, blocked or ok of a page, text or bytes; phrases of refusal count in its first 4096 bytes.

    The lenient parser reads any bytes, so no page is unparseable.
    """
    raw = content.cast("binary")
    head = F.lower(F.make_valid_utf8(F.substring(raw, 1, 4096).cast("string")))
    blocked = head.rlike("|".join(BLOCKED))
    return (
        F.when(content.isNull() | (F.length(raw) == 0), F.lit("empty"))
        .when(F.length(raw) < least, F.lit(f"too_small:<{least}"))
        .when(blocked, F.lit("blocked"))
        .otherwise(F.lit("ok"))
    )

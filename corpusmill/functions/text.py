"""Text and path expressions. All of them are built-in column expressions, evaluated in the JVM."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules

#: What Python counts as white space, spelled out so that no regex engine's own notion matters.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


#: The same characters, one by one.
SPACES = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def java(pattern: str, any_case: bool = False) -> str:
    """A pattern of `rules` for Java: digits, case and white space are Unicode's, and only a line feed ends a line."""
    return ("(?Udi)" if any_case else "(?Ud)") + pattern.replace(r"\s", SPACE)


@cache
def _decimals() -> tuple[str, str]:
    """All decimal digits of Unicode but ASCII's, and what they stand for."""
    found = [c for c in map(chr, range(0x80, 0x110000)) if c.isdecimal()]
    return "".join(found), "".join(str(unicodedata.decimal(c)) for c in found)


def ascii_digits(x: Column | str) -> Column:
    return F.translate(col(x), *_decimals())


def strip(x: Column | str) -> Column:
    """Without the white space at both ends, in one pass over the ends."""
    return F.btrim(col(x), F.lit(SPACES))


def suffix(path: Column | str) -> Column:
    """Lower-case extension with its dot; none for `.hidden` and `x.`."""
    return F.lower(F.regexp_extract(col(path), r"[^/.][^/]*?(\.[^./]+)$", 1))


def file_name(path: Column | str) -> Column:
    return F.element_at(F.split(col(path), "/"), -1)


def stem(name: Column | str) -> Column:
    return F.regexp_replace(col(name), r"(?<=[^.])\.[^./]+$", "")


def stat_hash(path: Column | str, length: Column | str, micros: Column | str) -> Column:
    return F.md5(F.concat_ws(":", col(path), col(length).cast("string"), col(micros).cast("string")))


def project_name(x: Column | str) -> Column:
    """White space at the ends goes first, then _ and -, then runs inside become one space."""
    return F.regexp_replace(F.btrim(strip(x), F.lit("_-")), f"{SPACE}+", " ")


def year_in(parts: Column, fallback: Column) -> Column:
    """The first part whose first year is from 1990 to 2030, else `fallback`. Strings."""
    years = F.filter(F.transform(parts, lambda p: ascii_digits(F.regexp_extract(p, java(rules.YEAR), 1))), lambda y: (y >= "1990") & (y <= "2030"))
    return F.coalesce(F.get(years, F.lit(0)), fallback)


def classified(text: Column, table: list[tuple[str, list[str]]] = rules.CATEGORIES, other: str = rules.OTHER_CATEGORY) -> Column:
    """The first label any of whose words is in the lower-cased text."""
    low, out = F.lower(text), None
    for label, words in table:
        hit = F.lit(False)
        for w in words:
            hit = hit | low.contains(w.lower())
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(other) if out is not None else F.lit(other)


def labels(text: Column, table: list[tuple[str, list[str]]] = rules.THEMES) -> Column:
    """All labels any of whose words is in the lower-cased text, in the table's order."""
    low, found = F.lower(text), []
    for label, words in table:
        hit = F.lit(False)
        for w in words:
            hit = hit | low.contains(w.lower())
        found.append(F.when(hit, F.lit(label)))
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def slugify(x: Column | str, empty: str = "unknown") -> Column:
    dashed = F.regexp_replace(F.regexp_replace(strip(x), f"(?:{SPACE}|_)+", "-"), "[^0-9A-Za-z가-힣-]", "")
    return F.coalesce(F.nullif(F.lower(F.btrim(dashed, F.lit("-"))), F.lit("")), F.lit(empty))


def folder_fields(name: Column | str) -> Column:
    """struct(period_start, period_end, title, is_yearly, yearly) of a project folder's name."""
    name = col(name)
    part = lambda k: F.regexp_extract(name, java(rules.PERIOD_FOLDER), k)
    period, year = part(1) != "", F.regexp_extract(name, java(rules.YEARLY_FOLDER), 1)
    month = lambda y, m: F.when(period, F.concat(part(y), F.lit("-"), F.lpad(ascii_digits(part(m)), 2, "0")))
    return F.struct(month(1, 2).alias("period_start"), month(3, 4).alias("period_end"), F.when(period, strip(part(5))).otherwise(name).alias("title"), (~period & (year != "")).alias("is_yearly"), F.when(~period & (year != ""), year).alias("yearly"))


def auto_slug(name: Column | str) -> Column:
    f = folder_fields(name)
    s = F.lower(F.regexp_replace(F.trim(F.regexp_replace(f["title"], r"[^A-Za-z0-9_\s-]", "")), r"\s+", "-"))
    year = F.substring(f["period_start"], 1, 4)
    dated = F.when(s != "", F.concat(year, F.lit("-"), s)).otherwise(year)
    return F.when(f["is_yearly"], F.concat(F.lit("yearly-"), f["yearly"])).when(year.isNotNull(), dated).otherwise(F.coalesce(F.nullif(s, F.lit("")), F.lit("untitled")))


def doc_key(stem_: Column | str) -> Column:
    """A document's name without version, date and copy marks."""
    stem_ = col(stem_)
    s = F.substring_index(stem_, "(", 1)
    for pattern, any_case in ((rules.VERSION, True), (rules.VERSION_NUMBER, True), (rules.DATE, False), (r"\[\d+\]", False), (r"[_\-\s.]+$", False)):
        s = F.regexp_replace(s, java(pattern, any_case), "")
    s = F.btrim(F.regexp_replace(s, f"{SPACE}+", " "), F.lit(" -_."))
    return F.coalesce(F.nullif(F.lower(s), F.lit("")), F.lower(stem_))


def _number(digits: Column) -> Column:
    """A whole number of any length, as what compares like it: how many digits it has, and these."""
    bare = F.coalesce(F.nullif(F.ltrim(ascii_digits(digits), F.lit("0")), F.lit("")), F.lit("0"))
    return F.struct(F.length(bare).alias("digits"), bare.alias("number"))


def version_numbers(stem_: Column | str) -> Column:
    """array<struct<digits, number>>, which compares as the list of the version's numbers does, a letter after them as one
    more; 0 alone without a version."""
    part = lambda k: F.regexp_extract(col(stem_), java(rules.VERSION, True), k)
    letter = F.lower(part(2))
    found = F.transform(F.split(part(1), r"\."), _number)
    return F.when(part(1) == "", F.array(_number(F.lit("0")))).when(letter == "", found).otherwise(F.concat(found, F.array(_number((F.ascii(letter) - 96).cast("string")))))


def version_date(stem_: Column | str) -> Column:
    return F.coalesce(F.nullif(ascii_digits(F.regexp_extract(col(stem_), java(rules.DATE), 1)), F.lit("")).cast("int"), F.lit(0))


def md_escape(x: Column | str) -> Column:
    return strip(F.replace(F.replace(F.coalesce(col(x), F.lit("")), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" ")))


def for_store(x: Column | str) -> Column:
    return F.replace(col(x), F.lit("\0"), F.lit(""))


def for_tokenizer(x: Column | str) -> Column:
    s = strip(for_store(x))
    return F.when(s.isNull() | (s == ""), " ").otherwise(s)


def distinct_lines(x: Column | str) -> Column:
    """Lines in order, each once, stripped, without blank ones."""
    lines = F.transform(F.array_distinct(F.split(col(x), "\n")), strip)
    return F.array_join(F.filter(lines, lambda s: s != ""), "\n")


def failure_category(error: Column | str) -> Column:
    e = col(error)
    low = F.lower(e)
    return (
        F.when(e.isNull() | (e == ""), "unknown")
        .when(e.contains("too short"), "too short")
        .when(e.contains("unsupported"), "unsupported")
        .when(low.contains("encoding") | low.contains("codec"), "encoding")
        .when(low.contains("embedding"), "embedding")
        .when(low.contains("store"), "store")
        .when(low.contains("conversion") | low.contains("convert"), "conversion")
        .otherwise(F.substring(e, 1, 60))
    )


def estimated_tokens(x: Column | str) -> Column:
    """A stand-in for a tokenizer: a token for each four bytes begun."""
    return F.ceil(F.octet_length(col(x)) / F.lit(4)).cast("long")


def json_payload(x: Column | str, schema: str) -> Column:
    """A JSON object out of a model's answer: fenced or not, else from the first brace to the last."""
    bare = F.regexp_replace(F.regexp_replace(strip(x), r"^```(?:json)?\s*", ""), r"\s*```$", "")
    inner = F.regexp_extract(bare, r"(?s)\{.*\}", 0)
    return F.coalesce(F.when(F.substring(bare, 1, 1) == "{", F.from_json(bare, schema)), F.when(inner != "", F.from_json(inner, schema)))


def micros(ts: Column | str) -> Column:
    """Microseconds since 1970 of a timestamp without time zone, whatever the session's zone."""
    t = col(ts)
    seconds = F.unix_date(F.to_date(t)) * F.lit(86_400).cast("long") + F.hour(t) * 3600 + F.minute(t) * 60
    return seconds * 1_000_000 + (F.date_part(F.lit("SECOND"), t) * 1_000_000).cast("long")

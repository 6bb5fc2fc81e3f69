"""Scalar functions over text, time and loose values, as Column expressions."""

from __future__ import annotations

import sys
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as text splitting sees it (29 code points), the mark of cut text and the null-like words.
_ASCII = r"\t\n\x0B\f\r\x1c\x1d\x1e\x1f "
_OTHER = r"\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WHITE = f"[{_ASCII}{_OTHER}]+"
CUT_MARK = " ... [truncated]"
CUT_ROOM = 15
NULLISH = ("", "null", "none", "n/a", "na", "unknown", "unsupported", "not applicable")
SECONDS_BELOW = 10_000_000_000


def collapse(x: Column) -> Column:
    """White space runs become one space, none at the ends; null becomes ''. Texts without the rarer kinds take the plainer pattern, which is several times faster."""
    text = F.coalesce(x.cast("string"), F.lit(""))
    plain = (F.octet_length(text) == F.length(text)) | ~text.rlike(r"[\x85\xa0\u1680-\u3000]")
    return F.trim(F.when(plain, F.regexp_replace(text, f"[{_ASCII}]+", " ")).otherwise(F.regexp_replace(text, WHITE, " ")))


def has_text(x: Column) -> Column:
    """Whether there is anything but white space."""
    return F.coalesce(x.rlike(f"[^{_ASCII}{_OTHER}]"), F.lit(False))


def strip(x: Column) -> Column:
    """Without white space of any kind at the ends; null stays null."""
    return F.regexp_replace(x, f"^{WHITE}|{WHITE}$", "")


@cache
def _folding() -> tuple[str, str, dict[str, str]]:
    """Code points whose caseless form is one code point, those forms, and the code points whose form is longer."""
    every = {c: c.casefold() for c in map(chr, range(sys.maxunicode + 1)) if c.casefold() != c}
    one = {c: f for c, f in every.items() if len(f) == 1}
    return "".join(one), "".join(one.values()), {c: f for c, f in every.items() if len(f) > 1}


def folded(x: Column) -> Column:
    """The caseless form of a text, code point by code point, for comparisons."""
    ones, forms, longer = _folding()
    text = F.translate(x, ones, forms)
    pairs = F.split(F.lit("\x01".join(c + f for c, f in longer.items())), "\x01")  # one literal: a code point, then its form
    full = F.when(text.rlike(f"[{''.join(longer)}]"), F.aggregate(pairs, text, lambda s, p: F.replace(s, F.substring(p, 1, 1), F.substring(p, 2, 9)))).otherwise(text)
    return F.when(F.octet_length(x) == F.length(x), F.lower(x)).otherwise(full)  # plain texts need no table


def truncate(x: Column, most: int) -> Column:
    """Collapsed text; over ``most`` characters it is cut and marked (the mark makes that one more than most)."""
    clean = collapse(x)
    return F.when(F.length(clean) > most, F.concat(F.rtrim(F.substring(clean, 1, most - CUT_ROOM)), F.lit(CUT_MARK))).otherwise(clean)


def strip_html(x: Column) -> Column:
    """Code elements become [CODE], other tags a space; entities stay."""
    no_code = F.regexp_replace(F.coalesce(x, F.lit("")), r"(?is)<code.*?>.*?</code>", " [CODE] ")
    return collapse(F.regexp_replace(no_code, r"(?s)<.*?>", " "))


def parse_tags(x: Column) -> Column:
    """Distinct tags of '<a><b>' in order."""
    words = F.split(collapse(F.translate(F.coalesce(x, F.lit("")), "<>", "  ")), " ")
    return F.array_distinct(F.filter(words, lambda t: t != ""))


def clean_tags(x: Column) -> Column:
    """Distinct non-empty tags of an array in order; null becomes an empty array."""
    cleaned = F.transform(F.coalesce(x, F.array().cast("array<string>")), collapse)
    return F.array_distinct(F.filter(cleaned, lambda t: t != ""))


def category_path(x: Column, most: int = 6) -> Column:
    """First ``most`` distinct names of a JSON text: a list, a list of lists, or a plain name."""
    lists = F.from_json(x, "array<array<string>>")
    flat = F.from_json(x, "array<string>")
    names = F.when(
        F.ltrim(x).startswith("["), F.coalesce(F.when(F.ltrim(F.substring(F.ltrim(x), 2, 1 << 20)).startswith("["), F.flatten(lists)), flat)
    ).when(x.isNotNull(), F.array(x))
    return F.slice(clean_tags(names), 1, most)


def epoch_ms(x: Column, negatives: bool = False) -> Column:
    """Milliseconds from seconds or milliseconds; not a whole number, or negative unless wanted: null."""
    n = x.cast("string").try_cast("bigint")
    ms = F.when(n < SECONDS_BELOW, n * 1000).otherwise(n)
    return ms if negatives else F.when(n >= 0, ms)


DATE = r"^(\d{4})(?:-(\d{2})-(\d{2})|(\d{2})(\d{2})|-?W(\d{2})(?:-?(\d))?)(?:$|.)"
TIME = r"(\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?"
ZONE = r"(Z|([+-])(\d{2})(?::?(\d{2})(?::?(\d{2})(?:\.\d+)?)?)?)?$"
PLAIN = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})?$"


def iso_ms(x: Column) -> Column:
    """Milliseconds of an ISO 8601 text; without an offset it is UTC. Dates may lack hyphens or be of weeks, times may end at the hour."""
    text = collapse(x)
    zoned = F.when(text.rlike(r"(Z|[+-]\d{2}:\d{2})$"), text).otherwise(F.concat(text, F.lit("Z")))
    return F.when(text.rlike(PLAIN), F.unix_millis(zoned.try_cast("timestamp"))).otherwise(_other_iso_ms(text))


def _other_iso_ms(text: Column) -> Column:
    pattern = DATE.replace("(?:$|.)", f"(?:[^0-9]{TIME}{ZONE}|$)")
    part = lambda i: F.nullif(F.regexp_extract(text, pattern, i), F.lit(""))
    number = lambda i, default=0: F.coalesce(part(i).try_cast("int"), F.lit(default))
    date = F.concat_ws("-", part(1), F.coalesce(part(2), part(4)), F.coalesce(part(3), part(5))).try_cast("date")
    first = F.date_trunc("week", F.concat(part(1), F.lit("-01-04")).try_cast("date")).cast("date")  # the Monday of week 1
    of_week = F.date_add(first, (number(6) - 1) * 7 + number(7, 1) - 1)
    fits = number(7, 1).between(1, 7) & number(6).between(1, 53) & (F.weekofyear(of_week) == number(6))
    day = F.when(part(6).isNotNull(), F.when(fits, of_week)).otherwise(date)
    hour, minute, second = number(8), number(9), number(10)
    offset = (number(14) * 3600 + number(15) * 60 + number(16)) * F.when(part(13) == "-", -1).otherwise(1)
    milli = F.rpad(F.coalesce(part(11), F.lit("0")), 3, "0").substr(1, 3).cast("int")
    seconds = F.unix_date(day).cast("long") * 86_400 + hour * 3600 + minute * 60 + second - offset
    good = text.rlike(pattern) & (hour < 24) & (minute < 60) & (second < 60) & (number(14) < 24) & (number(15) < 60)
    return F.when(good, seconds * 1000 + milli)


def iso_plus7(ms: Column) -> Column:
    """ISO 8601 to the second at the offset +07:00."""
    moved = F.timestamp_seconds(F.floor(ms / 1000) + 7 * 3600)
    return F.concat(_utc_format(moved, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+07:00"))


def utc_date(ms: Column) -> Column:
    """Date of milliseconds; null and 0 have none."""
    return F.when(ms != 0, F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(ms / 86_400_000).cast("int")), "yyyy-MM-dd"))


def _utc_format(ts: Column, pattern: str) -> Column:
    return F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz")), pattern)


def utc_year(ms: Column) -> Column:
    return F.year(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(ms / 86_400_000).cast("int")))


def valid_rating(x: Column) -> Column:
    """Whether it is a number from 1 to 5."""
    return F.coalesce(x.cast("string").try_cast("double").between(1, 5), F.lit(False))


def loose_double(x: Column, default: float | None = None) -> Column:
    found = x.cast("string").try_cast("double")
    return found if default is None else F.coalesce(found, F.lit(default))


def confidence(x: Column) -> Column:
    """A number clamped to 0..1; anything else is 0."""
    n = F.coalesce(x.cast("string").try_cast("double"), F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.when(F.isnan(n), 0.0).otherwise(n)))


def is_nullish(x: Column) -> Column:
    return x.isNull() | folded(strip(x)).isin(*NULLISH)


def dash_key(x: Column) -> Column:
    """Form in which values are compared: hyphens as en dashes, spaces collapsed, lower case."""
    return F.translate(folded(collapse(x)), "-", "–")


def hyphen_key(x: Column) -> Column:
    """The other way round: en and em dashes as hyphens."""
    return folded(collapse(F.regexp_replace(x, "[–—]", "-")))


def coerce_value(x: Column, allowed: Column, how: str = "dash") -> Column:
    """The allowed value that x stands for: itself, else the last with the same key (``dash``, ``hyphen``) or none (``exact``). No allowed values: any."""
    text = strip(x)
    values = F.coalesce(allowed, F.array().cast("array<string>"))
    key = {"dash": dash_key, "hyphen": hyphen_key}.get(how)
    found = F.when(F.array_contains(values, text), text)
    if key:
        found = F.coalesce(found, F.try_element_at(F.filter(values, lambda v: key(v) == key(text)), F.lit(-1)))
    return F.when(~is_nullish(x), F.when(F.size(values) == 0, text).otherwise(found))


def quote_found(quote: Column, profile: Column, plain: Column | None = None) -> Column:
    """Whether a non-empty quote stands in the profile, as it is or with spaces collapsed. plain: the collapsed profile, where it is at hand."""
    plain = collapse(profile) if plain is None else plain
    return (quote != "") & (F.contains(profile, quote) | F.contains(plain, collapse(quote)))


def rating_text(r: Column) -> Column:
    return F.when(r == F.floor(r), r.cast("bigint").cast("string")).otherwise(r.cast("string"))


def surrogate_id(*parts: Column) -> Column:
    """sha1 over the parts joined by '|'; nulls count as empty."""
    return F.sha1(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))


def shard(user: Column, n: int) -> Column:
    """First four bytes of the user's sha1, as a number, modulo n."""
    return (F.conv(F.substring(F.sha1(user.cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint") % n).cast("int")


def post_type(x: Column) -> Column:
    v = F.lower(strip(F.coalesce(x.cast("string"), F.lit(""))))
    return F.when(v.isin("1", "question"), "question").when(v.isin("2", "answer"), "answer").otherwise("post")


def category_of_file(name: Column) -> Column:
    """Category that a file's name tells: no suffix, no ``meta_``, nothing from ``_part_`` or ``_sample_`` on."""
    stem = F.regexp_replace(F.regexp_replace(name, r"\.jsonl?(\.gz)?$", ""), "^meta_", "")
    return F.regexp_replace(stem, r"_(part|sample)_.*$", "")


def glob_match(value: Column, pattern: Column) -> Column:
    """A pattern that ends in '*' is a prefix, any other the whole value."""
    return F.when(pattern.endswith("*"), F.startswith(value, F.regexp_replace(pattern, r"\*$", ""))).otherwise(value == pattern)

"""Keys, hashes and times as Column expressions. All times are UTC ``timestamp_ntz``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gripelode.functions.text import WS, clean, strip, text_of

# The text forms that are read, each taken apart by one match; unnamed pieces come out blank.
_CLOCK = r"(?<h{0}>\d{{2}})(?:(?::(?<n{0}>\d{{2}})(?::(?<s{0}>\d{{2}})(?:[.,](?<f{0}>\d+))?)?)|(?:(?<p{0}>\d{{2}})(?:(?<t{0}>\d{{2}})(?:[.,](?<r{0}>\d+))?)?))?"
_ISO = (
    r"(?s)\A(?:(?<ya>\d{4})-(?<ma>\d{2})-(?<da>\d{2})|(?<yb>\d{4})(?<mb>\d{2})(?<db>\d{2})|(?<yc>\d{4})-W(?<wc>\d{2})(?:-(?<ec>\d))?|(?<yd>\d{4})W(?<wd>\d{2})(?<ed>\d)?)"
    rf"(?:.{_CLOCK.format('a')}(?:(?<g>[+-]){_CLOCK.format('b')})?)?\z"
)
_ISO_PIECES = "${ya}${yb}${yc}${yd}|${ma}${mb}|${da}${db}|${wc}${wd}|${ec}${ed}|${ha}|${na}${pa}|${sa}${ta}|${fa}${ra}|${g}|${hb}|${nb}${pb}|${sb}${tb}|${fb}${rb}"
_DAY = r"(?<d> ?[1-9]|\d{2})"
_CLOCK_TEXT = r"(?<h>\d{1,2}):(?<n>\d{1,2}):(?<s>\d{1,2})"
_PLAIN = rf"\A(?<y>\d{{4}})-(?<m>\d{{1,2}})-{_DAY}(?:\s+{_CLOCK_TEXT})?\z"
_PLAIN_PIECES = "${y}|${m}|${d}|||${h}|${n}|${s}||||||"
_MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
_MAIL = (
    rf"(?i)\A(?:mon|tue|wed|thu|fri|sat|sun),\s+{_DAY}\s+(?<m>{'|'.join(_MONTHS)})\s+(?<y>\d{{4}})\s+{_CLOCK_TEXT}"
    r"\s+(?<g>[+-])(?<o>\d{2})(?::(?<u>[0-5]\d)(?::(?<v>[0-5]\d)(?:\.(?<w>\d{1,6}))?)?|(?<x>[0-5]\d)(?:(?<z>[0-5]\d)(?:\.(?<q>\d{1,6}))?)?)\z"
)
# What nearly all texts look like; these are times as they stand, or with their pieces put in order.
_DAYTIME = r"(?:[01]\d|2[0-3])(?::[0-5]\d){2}"
_USUAL_ISO = rf"\A(?!0000)\d{{4}}-\d\d-\d\d[T ]{_DAYTIME}(?:\.\d{{1,6}})?(?:\+00:00)?\z"
_USUAL_MAIL = rf"\A(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun), \d\d (?:{'|'.join(m.title() for m in _MONTHS)}) (?!0000)\d{{4}} {_DAYTIME} [+]0000\z"
_MAIL_PIECES = "${y}|${m}|${d}|||${h}|${n}|${s}||${g}|${o}|${u}${x}|${v}${z}|${w}${q}"


def sha1_id(length: int, *parts: Column) -> Column:
    return F.substring(F.sha1(F.concat(*parts)), 1, length)


def fingerprint(source: Column, item_id: Column, entity_id: Column, reviewer: Column, comment: Column, posted_at: Column) -> Column:
    parts = [F.lower(strip(text_of(c))) for c in (source, item_id, entity_id, reviewer)]
    return F.sha2(F.concat_ws("|", *parts, F.lower(clean(comment)), F.lower(strip(text_of(posted_at)))), 256)


def clean_fingerprint(*parts: Column) -> Column:
    """``fingerprint`` of texts that ``clean`` made, in which it would find no blanks to take away."""
    return F.sha2(F.concat_ws("|", *map(F.lower, parts)), 256)


def from_epoch(seconds: Column) -> Column:
    """Epoch seconds (fractions allowed) to UTC; independent of the session time zone."""
    micros = F.round(seconds.cast("double") * 1e6).cast("long")
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def epoch_micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def _assembled(pieces: Column) -> Column:
    """UTC time of (year, month, day, week, weekday, hour, minute, second, fraction, sign and offset); null where it is none."""
    def number(i: int) -> Column:
        return F.coalesce(F.trim(F.get(pieces, F.lit(i))).try_cast("int"), F.lit(0))

    def micros(i: int) -> Column:
        return F.rpad(F.substring(F.get(pieces, F.lit(i)), 1, 6), 6, "0").cast("long")

    month_text = F.lower(F.get(pieces, F.lit(1)))
    month = F.when(month_text.isin(_MONTHS), F.array_position(F.array(*map(F.lit, _MONTHS)), month_text).cast("int")).otherwise(number(1))
    calendar = F.format_string("%04d-%02d-%02d", number(0), month, number(2)).try_cast("date")
    # The week that holds 4 January is the first one; a week of the year is right where its Thursday lies in it.
    first = F.format_string("%04d-01-04", number(0)).try_cast("date")
    weekday = F.when(F.get(pieces, F.lit(4)) == "", 1).otherwise(number(4))
    monday = F.date_add(first, number(3) * 7 - 7 - F.weekday(first))
    by_week = F.when((F.weekofyear(F.date_add(monday, 3)) == number(3)) & number(3).between(1, 53) & weekday.between(1, 7), F.date_add(monday, weekday - 1))
    day = F.when(F.get(pieces, F.lit(3)) == "", calendar).otherwise(by_week)
    right = (number(5) < 24) & (number(6) < 60) & (number(7) < 60) & (number(0) > 0)
    clock = (number(5) * 3600 + number(6) * 60 + number(7)).cast("long") * 1_000_000 + micros(8)
    offset = (number(10) * 3600 + number(11) * 60 + number(12)).cast("long") * 1_000_000 + micros(13)
    shift = F.when(F.get(pieces, F.lit(9)) == "-", offset).otherwise(-offset)
    # An offset is right below a day, whatever its minutes.
    return F.when(right & (offset < 86_400_000_000), F.timestamp_add("MICROSECOND", clock + shift, day.cast("timestamp_ntz")))


def parse_time(c: Column) -> Column:
    """ISO text (calendar or week dates, separated or compact, any fraction, offsets down to fractions of a second), plain
    dates and times without leading zeros, or RFC-822 text with a weekday; NULL for anything else. No offset means UTC.

    Forms are tried in this order, and the first one that gives a time counts.
    """
    txt = F.replace(strip(text_of(c)), F.lit("Z"), F.lit("+00:00"))

    def read(pattern: str, pieces: str, t: Column) -> Column:
        parts = F.split(F.regexp_replace(t, pattern, pieces), "[|]", -1)
        return F.when(t.rlike(pattern), F.get(F.transform(F.array(parts), _assembled), F.lit(0)))

    def usual(t: Column) -> Column:
        month = F.lpad(((F.position(F.lower(F.substring(t, 9, 3)), F.lit("".join(_MONTHS))) + 2) / 3).cast("int").cast("string"), 2, "0")
        mail = F.concat(F.substring(t, 13, 4), F.lit("-"), month, F.lit("-"), F.substring(t, 6, 2), F.lit("T"), F.substring(t, 18, 8))
        return F.when(t.rlike(_USUAL_ISO), F.replace(t, F.lit("+00:00"), F.lit(""))).when(t.rlike(_USUAL_MAIL), mail).try_cast("timestamp_ntz")

    def first(t: Column) -> Column:
        return F.coalesce(usual(t), read(_ISO, _ISO_PIECES, t), read(_PLAIN, _PLAIN_PIECES, t), read(_MAIL, _MAIL_PIECES, t))

    return F.get(F.transform(F.array(txt), first), F.lit(0))


def iso_utc(ts: Column) -> Column:
    """ISO text with ``+00:00``; the fraction is left out when it is zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(ts, ".SSSSSS")
    return F.concat(whole, F.when(fraction == ".000000", "").otherwise(fraction), F.lit("+00:00"))


def iso_or_blank(ts: Column) -> Column:
    return F.coalesce(iso_utc(ts), F.lit(""))


def epoch_or_millis(x: Column) -> Column:
    """Numbers above 1e11 are milliseconds."""
    return F.when(x > 1e11, x / 1000.0).otherwise(x)


def cluster_key(domain: Column, terms: Column) -> Column:
    """Domain and the sorted distinct first three content terms."""
    joined = F.array_join(F.array_sort(F.array_distinct(F.slice(terms, 1, 3))), "-")
    sig = F.when(F.size(terms) == 0, "general").otherwise(joined)
    return F.concat(F.trim(F.regexp_replace(F.lower(domain), WS + "+", " ")), F.lit("::"), sig)


def key_domain(key: Column) -> Column:
    return F.substring_index(key, "::", 1)

"""Text normalisation and extraction as Column expressions; nothing here leaves the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gripelode import lexicon as lx
from gripelode.functions.entities import unescape

# Java's \s is ASCII; this class also covers the Unicode blanks.
WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
# Texts without any of them but plain blanks. Characters that a decoder puts for broken bytes are left to the replacing form.
COLLAPSED = r"\A[ -~[^\x00-\xa0\p{Z}\ufffd]]*+\z"
# The same class as single characters, for trimming.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def text_of(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def words(values: list[str]) -> Column:
    """A fixed list as an array; folded to one literal when the query is planned."""
    return F.split(F.lit("|".join(values)), "[|]")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def collapsed(t: Column) -> Column:
    """True for texts in which ``clean`` has nothing to do but trim blanks at their ends."""
    return t.rlike(COLLAPSED) & ~t.contains("  ")


def squeezed(c: Column) -> Column:
    """``clean`` without a look at whether there is anything to clean."""
    return F.trim(F.regexp_replace(text_of(c), "[" + WS[1:-1] + r"\x00]+", " "))


def clean(c: Column) -> Column:
    """NULL to '', NUL to blank, runs of whitespace to one blank, ends trimmed."""
    return text_of(let(text_of(c), lambda t: F.when(collapsed(t), F.trim(t)).otherwise(squeezed(t))))


def with_clean(df: DataFrame, names: list[str]) -> DataFrame:
    """``clean`` of several columns. Most rows have nothing to clean, which one look at all their texts tells."""
    others = [c for c in df.columns if c not in names]
    given = df.select(*others, *[text_of(F.col(c)).alias(c) for c in names])
    # The bars show blanks at the ends of any.
    barred = given.withColumn("_all", F.concat(F.lit("|"), F.concat_ws("|", *names), F.lit("|")))
    told = barred.withColumn("_clean", collapsed(F.col("_all")) & ~F.col("_all").contains(" |") & ~F.col("_all").contains("| "))
    return told.select(*[F.when(F.col("_clean"), F.col(c)).otherwise(squeezed(F.col(c))).alias(c) if c in names else c for c in df.columns])


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def normalize(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text_of(c)), WS + "+", " "))


def or_default(c: Column, default: str | Column) -> Column:
    """The text, or the default when it is blank."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default) if isinstance(default, str) else default)


def strip_html(c: Column) -> Column:
    return strip_clean_html(clean(c))


def strip_clean_html(c: Column) -> Column:
    """``strip_html`` of a text that ``clean`` made."""
    def stripped(t: Column) -> Column:
        plain = ~t.contains("<") & ~t.contains("&")
        return F.when(plain, t).otherwise(clean(unescape(F.regexp_replace(t, "<[^>]+>", " "))))

    return text_of(let(c, stripped))


def tokens(c: Column) -> Column:
    """Lower-case letter and digit runs of at least three characters, in order, repeats kept."""
    return F.regexp_extract_all(F.lower(text_of(c)), F.lit("[a-z0-9]{3,}"), F.lit(0))


def content_terms(c: Column) -> Column:
    # Shorter stopwords cannot occur among tokens of three or more characters; a literal list is looked up by hash.
    return F.filter(tokens(c), lambda t: ~t.isin([w for w in lx.STOPWORDS if len(w) > 2]))


def contains_any(lowered: Column, values: list[str]) -> Column:
    return F.exists(words(values), lambda w: lowered.contains(w))


def count_all(lowered: Column, values: list[str]) -> Column:
    """Sum over the words of their non-overlapping occurrences as substrings."""

    def add_hits(low: Column) -> Callable[[Column, Column], Column]:
        def step(total: Column, w: Column) -> Column:
            # Most words do not occur, and looking for one costs far less than replacing it.
            gone = F.length(low) - F.length(F.replace(low, w, F.lit("")))
            return total + F.when(~low.contains(w), 0).otherwise(F.floor(gone / F.length(w)))

        return step

    return let(lowered, lambda low: F.aggregate(words(values), F.lit(0).cast("long"), add_hits(low)))


def sentiment(lowered: Column) -> Column:
    return let(lowered, lambda low: count_all(low, lx.POSITIVE_WORDS) - count_all(low, lx.NEGATIVE_WORDS))


def query_tokens(query: Column) -> Column:
    return F.regexp_extract_all(F.lower(clean(query)), F.lit("[a-z0-9]{3,}"), F.lit(0))


def query_match(text: Column, query: Column) -> Column:
    """How many query tokens occur in the text as substrings."""
    wanted = query_tokens(query)
    return let(F.lower(clean(text)), lambda low: F.size(F.filter(wanted, lambda t: low.contains(t))))


def slug(c: Column, length: int = 120, default: str = "idea") -> Column:
    dashed = F.btrim(F.regexp_replace(F.lower(text_of(c)), "[^a-z0-9]+", "-"), F.lit("-"))
    return or_default(F.substring(dashed, 1, length), default)


def title_case(c: Column) -> Column:
    """Upper case after every non-letter, which ``initcap`` does not do."""
    runs = F.regexp_extract_all(c, F.lit(r"[\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+"), F.lit(0))

    def cap(r: Column) -> Column:
        # Upper-casing one letter can give several, of which only the first stays upper.
        head = F.upper(F.substring(r, 1, 1))
        return F.concat(F.substring(head, 1, 1), F.lower(F.concat(F.substring(head, 2, 9), F.substring(r, 2, 1 << 30))))

    return F.array_join(F.transform(runs, cap), "")


def _is_place(txt: Column) -> Column:
    places = words(lx.LOCATIONS)
    named = let(
        F.regexp_extract_all(txt, F.lit("[a-z]+"), F.lit(0)),
        lambda found: F.size(found).between(1, 3) & F.arrays_overlap(found, places),
    )
    ending = txt.rlike("(" + "|".join(lx.LOCATION_SUFFIXES) + ")$")
    return (txt != "") & (F.array_contains(words(lx.LOCATIONS + lx.LOCATION_CODES), txt) | ending | named)


def looks_like_location(c: Column) -> Column:
    return let(F.regexp_replace(normalize(c), "^r/", ""), _is_place)


def clean_tag(c: Column) -> Column:
    """Display tag, or NULL when the value is blank, generic or a place name."""
    spaced = F.btrim(F.regexp_replace(text_of(c), "[/_]+", " "), F.lit(" ,;"))

    def display(short: Column) -> Column:
        return F.when(short == F.lower(short), title_case(short)).otherwise(short)

    def kept(flat: Column) -> Column:
        drop = (flat == "") | F.array_contains(words(lx.GENERIC_TAGS), F.lower(flat)) | looks_like_location(flat)
        return F.when(~drop, let(F.trim(F.substring(flat, 1, 40)), display))

    return let(F.trim(F.regexp_replace(spaced, WS + "+", " ")), kept)


def category_tags(domain: Column, model_tags: Column, top_terms: Column) -> Column:
    """Up to four tags: domain, model tags, three leading terms; first spelling of each wins."""
    raw = F.concat(F.array(domain), model_tags, F.transform(F.slice(top_terms, 1, 3), lambda t: F.replace(t, F.lit("_"), F.lit(" "))))
    tags = F.filter(F.transform(raw, clean_tag), lambda t: t.isNotNull())

    def first_spellings(pairs: Column) -> Column:
        keys = F.transform(pairs, lambda p: p["key"])
        firsts = F.filter(pairs, lambda p, i: F.array_position(keys, p["key"]) == i + 1)
        return F.transform(F.slice(firsts, 1, 4), lambda p: p["tag"])

    pairs = F.transform(tags, lambda t: F.struct(t.alias("tag"), normalize(t).alias("key")))
    return let(let(pairs, first_spellings), lambda t: F.when(F.size(t) == 0, F.array(F.lit("Pain Intelligence"))).otherwise(t))


def level(c: Column, default: Column) -> Column:
    txt = normalize(c)
    return F.when(txt.contains("high"), "high").when(txt.contains("low"), "low").otherwise(default)


def bounded(c: Column, default: Column, lo: float, hi: float) -> Column:
    """A number clamped to [lo, hi]; anything that is not a number gives the default."""
    x = c.try_cast("double")
    # least and greatest skip NULLs, so a missing number needs its own branch.
    return F.when(x.isNull(), default).otherwise(F.least(F.lit(hi), F.greatest(F.lit(lo), x)))


def genre(c: Column) -> Column:
    return or_default(strip(text_of(c)), "Unknown")


def budget(c: Column) -> Column:
    """Amount after ``Budget:``, else the range after ``Hourly Range:``; NULL when neither occurs."""
    fixed = r"(?i)Budget\s*[:\-]\s*\$?\s*([0-9][0-9,\.]*)"
    hourly = r"(?i)Hourly Range\s*[:\-]\s*\$?\s*([0-9][0-9,\.]*\s*-\s*\$?\s*[0-9][0-9,\.]*)"
    found = [F.nullif(F.regexp_extract(c, p, 1), F.lit("")) for p in (fixed, hourly)]
    return F.regexp_replace(F.coalesce(*found), WS + "+", " ")


def _nonblank(parts: Column) -> Column:
    return F.filter(F.transform(parts, clean), lambda p: p != "")


def blocks(c: Column) -> Column:
    """Pieces between blank lines, cleaned, blanks dropped."""
    return _nonblank(F.split(text_of(c), r"\n{2,}"))


def chunks(c: Column) -> Column:
    """Blocks of the page text; a single block is split into sentences instead."""
    low = F.lower(text_of(c))
    raw = F.when(low.contains("<html") | low.contains("<body"), strip_html(c)).otherwise(text_of(c))
    return let(raw, lambda r: let(
        blocks(r), lambda parts: F.when(F.size(parts) <= 1, _nonblank(F.split(r, rf"(?<=[.!?]){WS}+"))).otherwise(parts)
    ))


def page_rating(html: Column) -> Column:
    patterns = [
        r'(?i)"ratingValue"\s*:\s*"?([0-9.]+)"?', r'(?i)data-rating\s*=\s*"([0-9.]+)"', r"(?i)Rating\s*[:=]\s*([0-9.]+)",
    ]
    found = [F.nullif(F.regexp_extract(text_of(html), p, 1), F.lit("")) for p in patterns]
    return F.coalesce(*found).try_cast("double")


def _lines(c: Column) -> Column:
    return _nonblank(F.split(text_of(c), r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"))


def page_title(html: Column) -> Column:
    """The title element, else a ``title:`` line, else the first line longer than eight characters."""
    body = text_of(html)
    element = r"(?is)<title[^>]*>(.*?)</title>"
    heading = F.get(F.filter(_lines(body), lambda l: F.lower(l).startswith("title:") | (F.length(l) > 8)), F.lit(0))
    from_line = let(heading, lambda l: F.when(l.rlike("(?i)^title:"), F.trim(F.substring(l, 7, 1 << 30))).otherwise(F.substring(l, 1, 180)))
    return F.when(body.rlike(element), clean(F.regexp_extract(body, element, 1))).otherwise(F.coalesce(from_line, F.lit("")))


def page_description(html: Column) -> Column:
    """The description meta tag in either attribute order, else the first five content lines."""
    body = text_of(html)
    name_first = r"""(?is)<meta[^>]+name=["']description["'][^>]+content=["'](.*?)["']"""
    content_first = r"""(?is)<meta[^>]+content=["'](.*?)["'][^>]+name=["']description["']"""
    headers = r"(?i)^(title|url source|warning|markdown content):"
    lines = F.slice(F.filter(_lines(body), lambda l: ~l.rlike(headers)), 1, 5)
    return (
        F.when(body.rlike(name_first), clean(F.regexp_extract(body, name_first, 1)))
        .when(body.rlike(content_first), clean(F.regexp_extract(body, content_first, 1)))
        .otherwise(F.substring(F.array_join(lines, " "), 1, 1000))
    )


def query_encode(c: Column) -> Column:
    """Form encoding of a query value: blanks become ``+``, ``~`` stays, ``*`` is escaped."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def query_param(url: Column, name: str) -> Column:
    """First non-empty value of a URL query parameter, decoded; '' when absent."""
    raw = F.regexp_extract(text_of(url), rf"[?&]{name}=([^&#]+)", 1)
    return F.coalesce(F.try_url_decode(raw), raw)


def lenient_json(c: Column) -> Column:
    """JSON object as VARIANT: the whole text, else the outermost braces; NULL for anything else."""

    def obj(t: Column) -> Column:
        return let(F.try_parse_json(t), lambda v: F.when(F.schema_of_variant(v).startswith("OBJECT"), v))

    return let(strip(text_of(c)), lambda t: F.coalesce(obj(t), obj(F.regexp_extract(t, r"(?s)\{.*\}", 0))))


def json_items(c: Column) -> Column:
    """Length of a JSON array text; 0 for anything else."""
    return F.coalesce(F.json_array_length(c), F.lit(0))


def truthy(c: Column, default: bool = False) -> Column:
    return F.when(c.isNull(), F.lit(default)).otherwise(F.lower(strip(text_of(c))).isin(lx.TRUE_TEXTS))

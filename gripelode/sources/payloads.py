"""Landed payloads to review rows, one function per payload shape.

Input is one row per payload with its text in ``body``; output rows carry the review columns
plus ``posted_ts``. Gates are applied; cursors, caps and fingerprints come later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gripelode import lexicon as lx
from gripelode.functions import gates, keys, text
from gripelode.operators.cluster import top_rows
from gripelode.session import stage

MAX_DEPTH = 1_000  # objects and arrays within each other that Spark's JSON parser reads

OUT = [
    "source", "source_item_id", "entity_id", "entity_name", "category", "reviewer_name", "rating", "comment_text",
    "posted_at", "posted_ts", "url", "country", "language", "raw_json",
]


def _rows(df: DataFrame, **cols) -> DataFrame:
    """Review columns from the given expressions; missing ones take the common defaults."""
    defaults = {
        "reviewer_name": F.lit(""), "rating": F.lit(None).cast("double"), "country": F.lit(""), "language": F.lit("en"),
        "posted_ts": F.lit(None).cast("timestamp_ntz"),
    }
    made = {**defaults, **cols}
    rows = df.select(*[made[c].alias(c) for c in OUT if c in made])
    if "posted_at" not in made:
        # From the column, so that a text is not parsed again for each piece of the time.
        rows = rows.withColumn("posted_at", keys.iso_or_blank(F.col("posted_ts")))
    return rows.select(*OUT)


def _once(df: DataFrame, *made: Column, keep: list[str] | None = None) -> DataFrame:
    """Kept columns and made ones. Filters on made columns stay above them, so that costly texts are not made a second time."""
    return df.select(*(df.columns if keep is None else keep), F.inline(F.array(F.struct(*made))))


# --- mobile stores ---------------------------------------------------------------------------

PLAY_SCHEMA = "array<struct<reviewId:string,userName:string,content:string,score:double,at:string>>"


def play_reviews(payloads: DataFrame) -> DataFrame:
    """(play_id, app_name, category, country, body: JSON array of store reviews)"""
    items = payloads.select("play_id", "app_name", "category", "country", F.explode(F.from_json("body", PLAY_SCHEMA)).alias("r"))
    items = items.withColumn("content", text.clean(F.col("r.content"))).where(gates.mobile(F.col("r.score"), F.col("content")))
    fallback = F.md5(F.concat_ws("-", "play_id", text.text_of(F.col("r.userName")), text.text_of(F.col("r.at"))))
    return _rows(
        items, source=F.lit("play_store"), source_item_id=text.or_default(text.clean(F.col("r.reviewId")), fallback),
        entity_id=F.col("play_id"), entity_name=F.coalesce("app_name", "play_id"), category=F.col("category"),
        reviewer_name=text.clean(F.col("r.userName")), rating=F.col("r.score"), comment_text=F.col("content"),
        posted_ts=keys.parse_time(F.col("r.at")), country=F.upper("country"),
        url=F.concat(F.lit("https://play.google.com/store/apps/details?id="), "play_id"), raw_json=F.to_json("r"),
    )


_LABEL = "struct<label:string>"
APPLE_ENTRY = f"struct<`im:rating`:{_LABEL},content:{_LABEL},updated:{_LABEL},id:{_LABEL},author:struct<name:{_LABEL}>>"


def appstore_reviews(payloads: DataFrame) -> DataFrame:
    """(apple_id, app_name, category, country, body: feed JSON whose entry is an array or one object)"""
    # The entry comes out as text; read as an array, one object becomes an array of itself.
    entry = F.from_json("body", "struct<feed:struct<entry:string>>")["feed"]["entry"]
    entries = F.from_json(entry, f"array<{APPLE_ENTRY}>")
    items = payloads.select("apple_id", "app_name", "category", "country", F.explode(entries).alias("r"))
    items = (
        items.withColumn("rating", F.col("r")["im:rating"]["label"].try_cast("double"))
        .withColumn("content", text.clean(F.col("r.content.label")))
        .where(F.col("rating").isNotNull() & gates.mobile(F.col("rating"), F.col("content")))
    )
    item_id = text.clean(F.col("r.id.label"))
    return _rows(
        items, source=F.lit("app_store"), source_item_id=item_id, entity_id=F.col("apple_id"),
        entity_name=F.coalesce("app_name", "apple_id"), category=F.col("category"),
        reviewer_name=text.clean(F.col("r.author.name.label")), rating=F.col("rating"), comment_text=F.col("content"),
        posted_ts=keys.parse_time(F.col("r.updated.label")), url=item_id, country=F.upper("country"), raw_json=F.to_json("r"),
    )


# --- communities -----------------------------------------------------------------------------

LISTING_SCHEMA = (
    "struct<data:struct<children:array<struct<data:struct<id:string,name:string,title:string,selftext:string,"
    "author:string,permalink:string,created_utc:double>>>>>"
)


def community_posts(payloads: DataFrame) -> DataFrame:
    """(community, body: listing JSON)"""
    listing = F.from_json("body", LISTING_SCHEMA)
    items = payloads.select("community", F.explode(listing["data"]["children"]).alias("c")).select("community", "c.data.*")
    items = items.withColumn("content", text.clean(F.concat_ws("\n", text.text_of(F.col("title")), text.text_of(F.col("selftext")))))
    raw = F.to_json(F.struct("id", "name", "title", "selftext", "author", "permalink", "created_utc"))
    return _rows(
        items.where(gates.community(F.col("content"))), source=F.lit("reddit"),
        source_item_id=text.or_default(text.clean(F.col("name")), F.concat(F.lit("t3_"), text.text_of(F.col("id")))),
        entity_id=F.col("community"), entity_name=F.col("community"), category=F.lit("reddit"),
        reviewer_name=text.clean(F.col("author")), comment_text=F.col("content"), posted_ts=keys.from_epoch(F.col("created_utc")),
        url=F.concat(F.lit("https://reddit.com"), text.clean(F.col("permalink"))), raw_json=raw,
    )


# --- search and launch pages -----------------------------------------------------------------

FORUM_SEARCH = "https://hn.algolia.com/?q={q}&type=comment&sort=byDate"
FORUM_ITEM = r"https://news\.ycombinator\.com/item\?id=\d+"
LAUNCH_SEARCH = "https://www.producthunt.com/search/posts?q={q}"


def _url(template: str, query: Column) -> Column:
    before, after = template.split("{q}")
    return F.concat(F.lit(before), text.query_encode(query), F.lit(after))


def _chunk_id(prefix: str) -> Column:
    return F.sha1(F.concat(F.lit(prefix + ":"), "query", F.lit(":"), F.col("pos"), F.lit(":"), F.substring("chunk", 1, 220)))


def forum_chunks(pages: DataFrame) -> DataFrame:
    """(query, category, body: text page with blank-line separated results)"""
    found = pages.select(text.clean(F.col("query")).alias("query"), "category", F.posexplode(text.blocks(F.col("body"))).alias("pos", "chunk"))
    link = F.regexp_extract("chunk", FORUM_ITEM, 0)
    return _rows(
        found.where(gates.forum(F.col("chunk"), F.col("query"))), source=F.lit("hacker_news"), source_item_id=_chunk_id("hn"),
        entity_id=F.col("query"), entity_name=F.concat(F.lit("Hacker News - "), "query"),
        category=F.coalesce("category", F.lit("Startups")), comment_text=F.substring("chunk", 1, 2500),
        url=text.or_default(link, _url(FORUM_SEARCH, F.col("query"))), raw_json=F.to_json(F.struct("query", F.substring("chunk", 1, 3000).alias("chunk"))),
    )


def launch_chunks(pages: DataFrame) -> DataFrame:
    """(query, category, body: launch search page, text or HTML); challenge pages give nothing."""
    open_pages = pages.where(~gates.blocked(F.col("body"), launch_page=True))
    found = open_pages.select(text.clean(F.col("query")).alias("query"), "category", F.posexplode(text.chunks(F.col("body"))).alias("pos", "chunk"))
    return _rows(
        found.where(gates.launch(F.col("chunk"), F.col("query"))), source=F.lit("product_hunt"), source_item_id=_chunk_id("producthunt-html"),
        entity_id=F.col("query"), entity_name=F.concat(F.lit("Product Hunt - "), "query"),
        category=F.coalesce("category", F.lit("Productivity")), comment_text=F.substring("chunk", 1, 2500),
        url=_url(LAUNCH_SEARCH, F.col("query")), raw_json=F.to_json(F.struct("query", F.substring("chunk", 1, 3000).alias("chunk"))),
    )


ATOM_SCHEMA = (
    "struct<entry:array<struct<title:string,summary:string,content:string,id:string,updated:string,"
    "link:array<struct<_href:string>>>>>"
)
_RSS_FIELDS = ["title", "description", "link", "guid", "pubDate"]
RSS_SCHEMA = "struct<channel:struct<item:array<struct<" + ",".join(f"{c}:string" for c in _RSS_FIELDS) + ">>>>"


def atom_entries(feeds: DataFrame) -> DataFrame:
    """Feed rows to entries with title or summary; the other columns are kept."""
    keep = [c for c in feeds.columns if c != "body"]
    entries = feeds.select(*keep, F.posexplode(F.from_xml("body", ATOM_SCHEMA)["entry"]).alias("pos", "e"))
    made = _once(
        entries, text.clean(F.col("e.title")).alias("title"),
        text.strip_html(text.or_default(text.text_of(F.col("e.summary")), F.coalesce("e.content", F.lit("")))).alias("summary"),
        text.clean(F.col("e.id")).alias("id"), text.clean(F.col("e.updated")).alias("updated"),
        text.clean(F.get("e.link", F.lit(0))["_href"]).alias("link"), keep=[*keep, "pos"],
    )
    return made.where((F.col("title") != "") | (F.col("summary") != ""))


def atom_reviews(feeds: DataFrame) -> DataFrame:
    """(query, category, body: Atom XML)"""
    entries = _once(atom_entries(feeds), F.trim(F.concat_ws(". ", "title", "summary")).alias("content"))
    fallback = F.sha1(F.concat(F.lit("producthunt-feed:"), "query", F.lit(":"), "link", F.lit(":"), "title"))
    return _rows(
        entries.where(gates.launch(F.col("content"), F.col("query"))), source=F.lit("product_hunt"),
        source_item_id=text.or_default(F.col("id"), fallback), entity_id=F.col("query"),
        entity_name=F.concat(F.lit("Product Hunt - "), "query"), category=F.coalesce("category", F.lit("Productivity")),
        comment_text=F.substring("content", 1, 2500), posted_ts=keys.parse_time(F.col("updated")),
        url=text.or_default(F.col("link"), _url(LAUNCH_SEARCH, F.col("query"))),
        raw_json=F.to_json(F.struct("title", "summary", "id", "updated", "link")),
    )


# --- job listings ----------------------------------------------------------------------------

JOB_FEED = "https://www.upwork.com/ab/feed/jobs/rss?q={q}"
JOB_SEARCH = "https://www.upwork.com/nx/search/jobs/?q={q}&sort=recency"


def rss_items(feeds: DataFrame) -> DataFrame:
    keep = [c for c in feeds.columns if c != "body"]
    items = feeds.select(*keep, F.posexplode(F.from_xml("body", RSS_SCHEMA)["channel"]["item"]).alias("pos", "i"))
    tidy = text.with_clean(items.select(*keep, "pos", *[f"i.{c}" for c in _RSS_FIELDS]), _RSS_FIELDS)
    return tidy.withColumns({"description": text.strip_clean_html(F.col("description")), "provider": F.lit("rss")})


_DATASET_ITEM = "struct<title:string,description:string,url:string,link:string,id:string,jobId:string,publishedAt:string,createdAt:string>"


def dataset_items(payloads: DataFrame) -> DataFrame:
    """Job dataset JSON: a list, or an object with ``items``."""
    keep = [c for c in payloads.columns if c != "body"]
    plain = F.from_json("body", f"array<{_DATASET_ITEM}>")
    nested = F.from_json("body", f"struct<items:array<{_DATASET_ITEM}>>")["items"]
    items = F.when(F.ltrim("body").startswith("["), plain).otherwise(nested)
    rows = payloads.select(*keep, F.posexplode(items).alias("pos", "i")).where(F.col("i").isNotNull())

    def first(*names: str) -> Column:
        return F.coalesce(*[F.nullif(F.col(f"i.{n}"), F.lit("")) for n in names])

    read = rows.select(*keep, "pos", "i.title", "i.description", first("url", "link").alias("link"), first("id", "jobId").alias("guid"), first("publishedAt", "createdAt").alias("pubDate"))
    tidy = text.with_clean(read, _RSS_FIELDS)
    return tidy.withColumns({"description": text.strip_clean_html(F.col("description")), "provider": F.lit("dataset")})


def _kind(value: Column) -> Column:
    """The first character of a value's JSON: { for objects, [ for arrays."""
    return F.substring(F.to_json(value), 1, 1)


#: A string that begins like an object or array, be it by an escape.
_LOOKALIKE = r'"(?:[{\[]|\\u00[57][bB])'
IN_A_ROW = 8  # levels below a root that are walked within its row


def _flat(body: Column) -> Column:
    """Without a bracket after the first there is nothing below, which needs no parser."""
    return (F.locate("{", body, 2) == 0) & (F.locate("[", body, 2) == 0)


def _children(kind: Column, body: Column, plain: Column) -> Column:
    """The objects and arrays directly inside an object or array: (i, kind, body) in document order.

    Their bodies are read as text, which keeps the order of names. Where a string may look like an object (not ``plain``), they
    are read a second time as variants, which tell the two apart.
    """
    texts, values = F.from_json(body, "map<string,string>"), F.from_json(body, "map<string,variant>")
    items, variants = F.from_json(body, "array<string>"), F.from_json(body, "array<variant>")

    def with_first(found: Column) -> Column:
        return F.transform(found, lambda t: F.struct(t.alias("body"), F.substring(t, 1, 1).alias("kind")))

    both = (
        F.when(plain & (kind == "{"), with_first(F.map_values(texts))).when(plain, with_first(items))
        .when(kind == "{", F.arrays_zip(F.map_values(texts).alias("body"), F.transform(F.map_values(values), _kind).alias("kind")))
        .otherwise(F.arrays_zip(items.alias("body"), F.transform(variants, _kind).alias("kind")))
    )
    numbered = F.transform(both, lambda x, i: F.struct(i.alias("i"), x["kind"].alias("kind"), x["body"].alias("body")))
    return F.filter(numbered, lambda x: x["kind"].isin("{", "["))


def _two_levels(kind: Column, body: Column, plain: Column) -> Column:
    """Children and their children: (path from here, kind, body); a path's numbers fall, so that it sorts in visiting order."""
    def and_below(c: Column) -> Column:
        own = F.struct(F.array(-c["i"]).alias("path"), c["kind"].alias("kind"), c["body"].alias("body"))
        return F.concat(F.array(own), F.transform(_children(c["kind"], c["body"], plain), lambda g: F.struct(F.array(-c["i"], -g["i"]).alias("path"), g["kind"].alias("kind"), g["body"].alias("body"))))

    return F.flatten(F.transform(_children(kind, body, plain), and_below))


def _in_a_row(kind: Column, body: Column, plain: Column, depth: int = 0) -> Column:
    """An object or array and what is in it down to IN_A_ROW levels: (depth, kind, body) in visiting order."""
    own = F.array(F.struct(F.lit(depth).alias("depth"), kind.alias("kind"), body.alias("body")))
    if depth == IN_A_ROW:
        return own
    below = F.transform(F.reverse(_children(kind, body, plain)), lambda c: _in_a_row(c["kind"], c["body"], plain, depth + 1))
    return F.when(_flat(body), own).otherwise(F.concat(own, F.flatten(below)))


def json_objects(payloads: DataFrame) -> DataFrame:
    """Every JSON object at any depth of ``body``, one row each: pos, depth, object (its JSON).

    ``pos`` numbers a payload's objects, parents first and the last child before its siblings. A payload of fewer than IN_A_ROW
    levels is walked within its row. Deeper ones go down two levels at a time; what is found is staged and gives the next ones,
    until there are no objects or arrays below, and a payload's objects are numbered by one window. Bodies that cannot be read
    give no rows; ``unreadable`` lists them.
    """
    keep = [c for c in payloads.columns if c != "body"]
    readable = payloads.where(F.try_parse_json("body").isNotNull())
    kind = F.substring(F.ltrim("body", F.lit(" \t\r\n")), 1, 1)
    root = readable.select(*keep, kind.alias("_kind"), F.col("body").alias("_body"), (~F.col("body").rlike(_LOOKALIKE)).alias("_plain")).where(F.col("_kind").isin("{", "["))
    walked = _once(root, _in_a_row(F.col("_kind"), F.col("_body"), F.col("_plain")).alias("_found"), keep=[*keep, "_plain"])
    deep = F.exists("_found", lambda o: o["depth"] == IN_A_ROW)
    # Of a deeper payload only the root is taken, which begins the walk by levels.
    taken = F.when(deep, F.slice("_found", 1, 1)).otherwise(F.filter("_found", lambda o: o["kind"] == "{"))
    rows = walked.select(*keep, "_plain", deep.alias("_deep"), F.posexplode(taken).alias("pos", "o"))
    found = stage(rows.select(*keep, "_plain", "_deep", "pos", F.col("o.depth").alias("depth"), F.col("o.kind").alias("_kind"), F.col("o.body").alias("object")), "objects")
    out = found.where(~F.col("_deep")).select(*keep, "pos", "depth", "object")
    below = found.where("_deep")
    return out if below.isEmpty() else out.unionByName(_by_levels(below.select(*keep, "_plain", "_kind", F.col("object").alias("_body")), keep))


def _by_levels(roots: DataFrame, keep: list[str]) -> DataFrame:
    """The walk of payloads of any depth, two levels at a time."""
    # Numbered once and staged, a payload keeps its number however often a task runs.
    held = [*keep, "_payload", "_plain"]
    level = stage(roots.select(*keep, F.monotonically_increasing_id().alias("_payload"), "_plain", F.array().cast("array<int>").alias("_path"), "_kind", "_body"), "level")
    found, depth = level, 0
    while True:
        below = level.select(*held, "_path", F.explode(_two_levels(F.col("_kind"), F.col("_body"), F.col("_plain"))).alias("c"))
        rows = stage(below.select(*held, F.concat("_path", "c.path").alias("_path"), F.col("c.kind").alias("_kind"), F.col("c.body").alias("_body")), "level")
        found, depth = found.unionByName(rows), depth + 2
        level = rows.where(F.size("_path") == depth)
        if level.isEmpty():
            break
    order = Window.partitionBy("_payload").orderBy("_path")
    objects = found.where("_kind = '{'").withColumn("pos", F.row_number().over(order) - 1)
    return objects.select(*keep, "pos", F.size("_path").alias("depth"), F.col("_body").alias("object"))


def unreadable(payloads: DataFrame) -> DataFrame:
    """Payloads whose body ``json_objects`` cannot read, with a ``reason``."""
    body = F.col("body")
    opened = F.length(body) - F.length(F.translate(body, "{[", ""))
    reason = (
        F.when(F.trim(text.text_of(body)) == "", "empty").when(F.from_json(body, "map<string,string>").isNotNull(), "a name twice in one object, or a value that is none")
        .when(opened > MAX_DEPTH, "no JSON, or nested deeper than the parser reads").otherwise("no JSON")
    )
    return payloads.where(F.try_parse_json("body").isNull()).withColumn("reason", reason).drop("body")


#: Where a job item's fields are found, the first spelling first.
JOB_FIELDS = {
    "title": ["title", "jobTitle", "name", "headline"], "description": ["description", "summary", "snippet", "details", "workDescription"],
    "date": ["publishedOn", "publishedAt", "createdAt", "createTime"], "low": ["hourlyBudgetMin"], "high": ["hourlyBudgetMax"], "amount": ["amount"],
    "currency": ["amountCurrencyCode", "currencyCode"], "link": ["jobPostingUrl", "jobUrl", "canonicalUrl", "url", "link"],
    "guid": ["id", "jobId", "jobPostingId", "uid", "uuid"],
}


def job_nodes(objects: DataFrame) -> DataFrame:
    """(query, pos, object, ...) to job items by the first non-blank of several spellings."""
    keep = [c for c in objects.columns if c not in ("object", "depth")]
    hinted = F.arrays_overlap(F.json_object_keys("object"), text.words(lx.JOB_NODE_HINTS))
    # All spellings are read in one walk over the object; each lookup by path would go through its names again.
    held = "struct<" + ",".join(f"{name}:string" for names in JOB_FIELDS.values() for name in names) + ">"
    objects = objects.where(hinted).select(*keep, F.try_variant_get(F.try_parse_json("object"), "$", held).alias("v"))

    def field(name: str) -> Column:
        return F.get(F.filter(F.array(*[F.col("v")[n] for n in JOB_FIELDS[name]]), lambda t: t != ""), F.lit(0))

    def day(found: Column) -> Column:
        number = F.when(found.rlike(r"^-?\d+(\.\d+)?([eE][+-]?\d+)?$"), found.try_cast("double"))
        return F.when(number.isNotNull(), keys.iso_or_blank(keys.from_epoch(keys.epoch_or_millis(number)))).otherwise(text.clean(found))

    low, high, amount, currency = (text.clean(field(n)) for n in ("low", "high", "amount", "currency"))
    hourly = F.when((low != "") | (high != ""), F.concat(F.lit("Hourly: "), text.or_default(low, "?"), F.lit("-"), text.or_default(high, "?")))
    fixed = F.when(amount != "", F.trim(F.concat(F.lit("Budget: "), amount, F.lit(" "), currency)))
    nodes = _once(
        objects, text.clean(field("title")).alias("title"), text.strip_html(field("description")).alias("_desc"),
        F.concat_ws(" ", hourly, fixed).alias("_budget"), text.clean(field("link")).alias("link"),
        text.clean(field("guid")).alias("guid"), text.text_of(text.let(field("date"), day)).alias("pubDate"), keep=keep,
    )
    described = nodes.withColumn("_desc", text.or_default(F.col("_desc"), F.col("_budget"))).where((F.col("title") != "") | (F.col("_desc") != ""))
    fallback = F.sha1(F.concat_ws("|", "query", "title", "link", F.col("pos").cast("string")))
    return described.select(
        *keep, text.or_default(F.col("title"), F.concat(F.lit("Upwork job: "), "query")).alias("title"),
        F.substring("_desc", 1, 4000).alias("description"), "link", text.or_default(F.col("guid"), fallback).alias("guid"), "pubDate",
        F.lit("upwork_first_party_api").alias("provider"),
    )


def first_items(items: DataFrame, payload: list[str], order: list[Column], limit: int | None) -> DataFrame:
    """Per payload the first item of every id, link or title, then at most ``limit`` items, or all of them."""
    named = items.withColumn("dedupe_key", F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in ("guid", "link", "title")]))
    named = named.where(F.col("dedupe_key").isNotNull())
    # Ids come first, since they differ early; a sort compares whole texts only where their beginnings are equal.
    first = top_rows(named, ["dedupe_key", *payload], order, 1, "_first").drop("_first")
    return first if limit is None else top_rows(first, payload, order, limit, "item_rank")


def job_page_chunks(pages: DataFrame, limit: int | None, compat: bool = False) -> DataFrame:
    """(query, body: job search page as text) to job items, at most ``limit`` of a query or all.

    ``compat`` collapses the page before splitting, which makes it one chunk.
    """
    body = text.clean(F.col("body")) if compat else F.col("body")
    open_pages = pages.where(~gates.blocked(F.col("body")))
    found = open_pages.select("query", F.posexplode(text.blocks(body)).alias("pos", "chunk")).where(gates.job_chunk(F.col("chunk")))
    # Blocks at the same place of two pages of one query follow their text.
    if limit is None:
        taken, rank = found, []
    else:
        taken, rank = top_rows(found, ["query"], [F.col("pos").asc(), F.col("chunk").asc()], limit, "item_rank"), ["item_rank"]
    return taken.select(
        "query", *rank, F.concat(F.lit("Upwork market signal: "), "query").alias("title"), F.substring("chunk", 1, 2000).alias("description"),
        _url(JOB_SEARCH, F.col("query")).alias("link"), _chunk_id("upwork-jina").alias("guid"), F.lit("").alias("pubDate"), F.lit("jina_proxy").alias("provider"),
    )


def job_reviews(items: DataFrame) -> DataFrame:
    """(query, category, title, description, link, guid, pubDate, provider); query signals skip the gate."""
    tidy = text.with_clean(items.withColumns({"_link": F.col("link"), "_guid": F.col("guid"), "_date": F.col("pubDate")}), ["title", "description", "_link", "_guid", "_date"])
    others = [c for c in tidy.columns if c != "description"]
    described = _once(tidy, text.strip_clean_html(F.col("description")).alias("description"), keep=others)
    described = _once(described, F.trim(F.concat_ws(". ", "title", "description")).alias("content"))
    kept = described.where((F.col("provider") == "query_signal") | gates.job(F.col("content")))
    fallback = F.sha1(F.concat_ws("|", "query", "title", "link"))
    raw = F.struct("query", "title", "description", text.budget(F.col("description")).alias("budget_hint"), "link", "pubDate", "provider")
    return _rows(
        kept, source=F.lit("upwork"), source_item_id=text.or_default(F.col("_guid"), fallback), entity_id=F.col("query"),
        entity_name=F.concat(F.lit("Upwork - "), "query"), category=F.coalesce("category", F.lit("Operations")),
        reviewer_name=F.lit("client"), comment_text=F.col("content"), posted_ts=keys.parse_time(F.col("_date")),
        url=text.or_default(F.col("_link"), _url(JOB_FEED, F.col("query"))), raw_json=F.to_json(raw),
    )


# --- product pages and synthetic signals -----------------------------------------------------


def market_reviews(pages: DataFrame, relaxed: bool = True) -> DataFrame:
    """(source, url, product_name, category, html) to at most one review per page."""
    read = pages.withColumns({
        "title": text.page_title(F.col("html")), "description": text.page_description(F.col("html")), "rating": text.page_rating(F.col("html")),
    }).withColumn("snippet", text.clean(F.concat_ws(". ", "title", "description")))
    kept = read.where(gates.market(F.col("rating"), F.col("snippet"), F.col("source"), relaxed))
    return _rows(
        kept, source=F.col("source"), source_item_id=F.sha1(F.concat_ws(":", "source", "url")), entity_id=F.col("url"),
        entity_name=F.coalesce("product_name", "url"), category=F.coalesce("category", F.lit("Unknown")), rating=F.col("rating"),
        comment_text=F.col("snippet"), url=F.col("url"), raw_json=F.to_json(F.struct("title", "description", "rating")),
    )


def market_signals(seeds: DataFrame, pages: DataFrame, reason: str) -> DataFrame:
    """One demand row for every enabled marketplace seed (source, url, ...) without a landed page.

    ``posted_at`` stays blank so that the fingerprint, and with it the row, is stable.
    """
    missing = seeds.where(F.col("enabled")).join(pages.select("source", "url").distinct(), ["source", "url"], "left_anti")
    focus = text.or_default(text.clean(F.col("product_name")), text.or_default(F.replace(text.clean(text.query_param(F.col("url"), "query")), F.lit("+"), F.lit(" ")), "software buyers"))
    body = F.concat(
        F.upper("source"), F.lit(" marketplace demand signal: buyers are researching "), focus, F.lit(" in "),
        text.or_default(text.clean(F.col("category")), "Unknown"),
        F.lit(". Search and review discovery pages indicate active comparison intent around pricing, alternatives, "
              "feature gaps, and fit for business workflows."),
        F.when(F.lit(reason) != "", F.concat(F.lit(" Capture reason: "), F.lit(reason), F.lit("."))).otherwise(""),
    )
    return _rows(
        missing, source=F.col("source"), source_item_id=F.sha1(F.concat_ws(":", "source", "url")), entity_id=F.col("url"),
        entity_name=F.coalesce("product_name", "url"), category=F.coalesce("category", F.lit("Unknown")),
        comment_text=F.substring(text.clean(body), 1, 1200), url=F.col("url"),
        raw_json=F.to_json(F.struct(F.lit("marketplace_query_signal").alias("provider"), F.lit(reason).alias("reason"))),
    )


def job_query_signals(seeds: DataFrame) -> DataFrame:
    """Demand item for every job query (query, category), in the shape ``job_reviews`` reads."""
    dashed = F.substring(F.btrim(F.regexp_replace(F.lower("query"), "[^a-z0-9]+", "-"), F.lit("-")), 1, 80)
    body = F.concat(
        F.lit("Upwork demand signal query: "), "query", F.lit(". This query indicates ongoing buyer intent around "),
        text.or_default(F.col("category"), "operations"), F.lit(" workflows and manual-process pain that teams want to automate."),
    )
    return seeds.select(
        "query", "category", F.concat(F.lit("Upwork demand signal: "), "query").alias("title"), body.alias("description"),
        _url(JOB_FEED, F.col("query")).alias("link"), F.concat(F.lit("upwork-query-signal:"), dashed).alias("guid"),
        F.lit("").alias("pubDate"), F.lit("query_signal").alias("provider"),
    )


# --- forum HTML ------------------------------------------------------------------------------

FORUM_HOST = "https://news.ycombinator.com/"


def forum_stories(pages: DataFrame, id_col: str) -> DataFrame:
    """Story rows of listing HTML: id, title, link, item_url."""
    rows = pages.select(id_col, F.posexplode(F.regexp_extract_all("html", F.lit(lx.FORUM_ROW), F.lit(0))).alias("pos", "row"))
    head = F.regexp_extract("row", r"(?is)^<tr[^>]*>", 0)
    link = text.clean(F.regexp_extract("row", lx.FORUM_TITLE, 1))
    made = rows.where(F.col("row").rlike(lx.FORUM_TITLE)).select(
        id_col, "pos", F.regexp_extract(head, lx.FORUM_ROW_ID, 1).alias("id"),
        text.strip_html(F.regexp_extract("row", lx.FORUM_TITLE, 2)).alias("title"),
        F.when(link.startswith("item?id="), F.concat(F.lit(FORUM_HOST), link)).otherwise(link).alias("link"),
    )
    return made.where((F.col("id") != "") & (F.col("title") != "")).withColumn("item_url", F.concat(F.lit(FORUM_HOST + "item?id="), "id"))


def forum_comments(pages: DataFrame, id_col: str) -> DataFrame:
    found = pages.select(id_col, F.posexplode(F.regexp_extract_all("html", F.lit(lx.FORUM_COMMENT), F.lit(1))).alias("pos", "c"))
    return found.select(id_col, "pos", text.strip_html(F.col("c")).alias("comment_text")).where(F.col("comment_text") != "")


def forum_new_comments(pages: DataFrame, id_col: str) -> DataFrame:
    """Rows of a new-comments page: comment id, story link and title, comment text."""
    rows = pages.select(id_col, F.posexplode(F.regexp_extract_all("html", F.lit(lx.FORUM_NEW_COMMENT), F.lit(0))).alias("pos", "row"))
    # One more match takes a row's four pieces apart; NUL, which pages cannot hold, stands between them.
    pieces = F.split(F.regexp_replace(F.translate("row", "\0", " "), lx.FORUM_NEW_COMMENT, "$1\0$2\0$3\0$4"), "\0", -1)
    rows = rows.select(id_col, "pos", pieces.alias("pieces"))
    link = text.clean(F.get("pieces", F.lit(1)))
    absolute = F.when((link != "") & ~link.startswith("http"), F.concat(F.lit(FORUM_HOST), F.regexp_replace(link, "^/+", ""))).otherwise(link)
    made = rows.select(
        id_col, "pos", F.get("pieces", F.lit(0)).alias("comment_id"), absolute.alias("story_link"),
        text.strip_html(F.get("pieces", F.lit(2))).alias("story_title"), text.strip_html(F.get("pieces", F.lit(3))).alias("comment_text"),
    )
    return made.where((F.col("comment_id") != "") & (F.col("comment_text") != ""))

"""Rows out of HTML and JSON responses (X1-X11) and the split into rows and rejects.

Responses are ``(resp_seq, url, body)`` or pages ``(page_id, url, status, html)``. Extracted
rows carry ``resp_seq`` and ``pos``, which together give the arrival order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlmart import schemas
from crawlmart.functions import keys
from crawlmart.functions.html import html_unescape

SEQ = ["resp_seq", "pos"]

# Shapes of table rows, cells and embedded state in the crawled pages.
ROW = r"(?is)<tr\b[^>]*>(.*?)(?=<tr\b|</tr\b|</table\b|\z)"
CELL = r"(?is)<td\b[^>]*>(.*?)(?=<t[dh]\b|</td\b|\z)"
CHILD = r"(?is)<([a-z][a-z0-9]*)\b[^>]*>.*?</\1\s*>|<[^>]*>"
TABLE_TAG = r"(?is)</?(?:table|tr|td|th)\b[^>]*>"
STATE = '(?s)<textarea id="{id}" hidden="">(.*?)</textarea>'
UPDATED_START, UPDATED_END, UPDATED_VALUE = '"updated":', ',"canComment"', '" "'
PROXY_LAYOUTS = {
    "six": {"host": 2, "port": 3, "protocol": 6},
    "four": {"host": 1, "port": 2, "protocol": 4},
    "five": {"host": 1, "port": 2, "protocol": 5},
}


# -- F5 --------------------------------------------------------------------------------
def with_reject_reason(df: DataFrame, conds: dict[str, Column]) -> DataFrame:
    """Add ``reject_reason``: the first condition that holds, or null."""
    return df.withColumn(
        "reject_reason", F.coalesce(*[F.when(c, F.lit(name)) for name, c in conds.items()])
    )


def split_rejects(
    df: DataFrame, conds: dict[str, Column], seen: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows that pass, rejects with their reason). ``seen`` counts rows per reason."""
    marked = with_reject_reason(df, conds)
    if seen is not None:
        counts = [
            F.count(F.when(F.col("reject_reason") == name, 1)).alias(name) for name in conds
        ]
        marked = marked.observe(seen, F.count(F.lit(1)).alias("rows_in"), *counts)
    rows = marked.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return rows, marked.filter(F.col("reject_reason").isNotNull())


def broken_bodies(df: DataFrame, schema: T.DataType) -> DataFrame:
    """Responses whose body does not parse: a broken or missing array gives null, a broken
    object fills the corrupt-record field."""
    if isinstance(schema, T.ArrayType):
        bad = F.from_json("body", schema).isNull()
    else:
        marked = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
        options = {"columnNameOfCorruptRecord": "_corrupt"}
        parsed = F.from_json("body", marked, options)
        bad = F.col("body").isNull() | parsed.getField("_corrupt").isNotNull()
    return df.filter(bad).withColumn("reject_reason", F.lit("broken_body"))


# -- HTML ------------------------------------------------------------------------------
def layout_columns(layout: str) -> dict[str, Column]:
    """Cell numbers of the proxy lists by the value of the layout column."""
    return {
        name: F.coalesce(
            *[F.when(F.col(layout) == k, F.lit(cols[name])) for k, cols in PROXY_LAYOUTS.items()]
        )
        for name in ("host", "port", "protocol")
    }


def html_table_rows(
    df: DataFrame, html: str, cols: dict[str, int | Column], skip: int = 1
) -> DataFrame:
    """One row per table row after the first ``skip``; each named column is the first own
    text of that ``<td>`` (counted from 1), trimmed, or null where the cell or text is
    missing. Closing tags may be left out; nested tables are not supported. A cell number
    may be a column, so pages of several layouts are read in one pass."""
    found = df.withColumn("_rows", F.regexp_extract_all(html, F.lit(ROW), F.lit(1))).drop(html)
    rest = F.slice("_rows", F.lit(skip + 1), F.greatest(F.size("_rows") - skip, F.lit(0)))
    rows = found.select("*", F.posexplode_outer(rest).alias("pos", "_row"))
    cells = rows.filter(F.col("pos").isNotNull()).withColumn(
        "_cells", F.regexp_extract_all("_row", F.lit(CELL), F.lit(1))
    )

    def own_text(number: int | Column) -> Column:
        at = (F.lit(number) if isinstance(number, int) else number) - 1
        parts = F.split(F.get("_cells", at), CHILD, -1)
        first = F.try_element_at(F.filter(parts, lambda p: p != ""), F.lit(1))
        return F.regexp_replace(first, r"^\s+|\s+$", "")

    return cells.withColumns({name: own_text(no) for name, no in cols.items()}).drop(
        "_rows", "_row", "_cells"
    )


def html_table_rows_nested(
    df: DataFrame, html: str, cols: dict[str, int | Column], page: str, skip: int = 1
) -> DataFrame:
    """The same where tables stand in cells of tables: every row at any depth, in the order in
    which rows begin, each with its own cells only. A cell's text is its first own one, before,
    between or behind the tables in it. ``page`` is unique in ``df``; the result has it, ``pos``
    and the named columns.

    Tags are exploded; a running sum over their starts and ends is the depth, and the last
    table, row and cell that began at a tag's depth are the ones around it.
    """
    numbers = {
        f"_no_{name}": F.lit(no) if isinstance(no, int) else no for name, no in cols.items()
    }
    tags = F.regexp_extract_all(html, F.lit(TABLE_TAG), F.lit(0))
    texts = F.slice(F.split(html, TABLE_TAG, -1), F.lit(2), F.size(tags))
    cut = df.select(page, *[no.alias(name) for name, no in numbers.items()], F.arrays_zip(
        tags.alias("tag"), texts.alias("after")).alias("_tags"))
    each = cut.select(page, *numbers, F.posexplode("_tags").alias("_i", "_t"))
    each = each.select(page, *numbers, "_i", "_t.tag", "_t.after")
    name = F.lower(F.regexp_extract("tag", "^</?([a-zA-Z]+)", 1))
    each = each.withColumns({"_name": name, "_open": ~F.col("tag").startswith("</")})

    def begins(kind: str) -> Column:
        return (F.col("_name") == kind) & F.col("_open")

    def last(value: Column, *within: str) -> Column:
        return F.last(value, ignorenulls=True).over(Window.partitionBy(*within).orderBy("_i"))

    order = Window.partitionBy(page).orderBy("_i")
    step = F.when(F.col("_name") == "table", F.when(F.col("_open"), 1).otherwise(-1)).otherwise(0)
    each = each.withColumns(
        {"_sum": F.sum(step).over(order), "_tr": F.sum(begins("tr").cast("int")).over(order)}
    )
    # An end without a start takes nothing from the depth of what follows.
    low = F.least(F.lit(0), F.min("_sum").over(order))
    each = each.withColumn("_depth", F.col("_sum") - low)
    each = each.withColumn("_table", last(F.when(begins("table"), F.col("_i")), page, "_depth"))
    place = [page, "_depth", "_table"]
    row = F.when(F.col("_name") == "tr", F.when(F.col("_open"), F.col("_tr")).otherwise(0))
    row = F.when(begins("table"), 0).otherwise(row)
    each = each.withColumn("_row", last(row, *place)).filter(F.col("_row") > skip)
    inside = Window.partitionBy(page, "_row").orderBy("_i")
    each = each.withColumn("_td", F.sum(begins("td").cast("int")).over(inside))
    cell = F.when(F.col("_name").isin("td", "th", "tr"), F.when(begins("td"), F.col("_td")).otherwise(0))
    each = each.withColumn("_cell", last(cell, page, "_row"))
    own = F.filter(F.split("after", CHILD, -1), lambda p: p != "")
    text = F.struct("_i", F.try_element_at(own, F.lit(1)).alias("text"))
    found = each.withColumn("_text", F.when(F.size(own) > 0, text))
    out = found.groupBy(page, "_row").agg(
        *[F.min(F.when(F.col("_cell") == F.col(f"_no_{c}"), F.col("_text"))).alias(c) for c in cols]
    )
    trimmed = [F.regexp_replace(F.col(c)["text"], r"^\s+|\s+$", "").alias(c) for c in cols]
    return out.select(page, (F.col("_row") - skip - 1).cast("int").alias("pos"), *trimmed)


def embedded_text(html: Column, element_id: str) -> Column:
    """Raw text of the first ``<textarea id=… hidden="">``, null if there is none."""
    return F.nullif(F.regexp_extract(html, STATE.format(id=element_id), 1), F.lit(""))


def embedded_json(
    df: DataFrame,
    html: str,
    element_id: str,
    schema: T.StructType,
    repair: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Replace the HTML by ``data``, the parsed JSON of the hidden element; ``data`` is null
    where the element is missing and ``_corrupt`` is filled where the JSON is broken."""
    # One column per step: each is computed once however often the next one refers to it.
    text = F.col("_text")
    marked = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(repair(text) if repair else text, marked, {"columnNameOfCorruptRecord": "_corrupt"})
    return (
        df.withColumn("_raw", embedded_text(F.col(html), element_id))
        .drop(html)
        .withColumn("_text", html_unescape(F.col("_raw")))
        .withColumn("data", parsed)
        .drop("_raw", "_text")
    )


def repair_json_field(col: Column, start: str, end: str, value: str) -> Column:
    r"""Replace what stands between two literal texts, at that place only."""
    pattern = rf"(?s)(?<=\Q{start}\E).*?(?=\Q{end}\E)"
    return F.regexp_replace(col, pattern, value)


def repair_state(col: Column) -> Column:
    """The malformed "updated" value of the post state, made harmless."""
    return repair_json_field(col, UPDATED_START, UPDATED_END, UPDATED_VALUE)


# -- JSON ------------------------------------------------------------------------------
def _user_item(user: Column, headline: str, avatar: Column) -> Column:
    return F.when(
        user.isNotNull(),
        F.struct(
            user["uid"].alias("zuid"),
            user["name"].alias("name"),
            user["profileUrl"].alias("link"),
            user["hash"].alias("hash"),
            user["slug"].alias("slug"),
            user["description"].alias("description"),
            user[headline].alias("headline"),
            avatar.alias("avatar"),
        ),
    )


def _avatar(owner: Column, default: str) -> Column:
    return keys.avatar_url(owner["avatar"]["template"], owner["avatar"]["id"], "l", default)


def _article_columns(post: Column) -> list[Column]:
    token = post["slug"]
    return [
        post["title"].alias("title"),
        post["content"].alias("content"),
        post["summary"].alias("summary"),
        post["titleImage"].alias("cover"),
        token.alias("token"),
        keys.md5_key(token).alias("md5"),
        keys.build_link("article", token).alias("link"),
        post["publishedTime"].alias("published"),
    ]


def post_rejects() -> dict[str, Column]:
    """Why an extracted post cannot become an article."""
    return {
        "no_key": F.col("md5").isNull(),
        "no_author": F.col("author").isNull() | F.col("author.slug").isNull(),
        "bad_time": keys.parse_published(F.col("published")).isNull(),
    }


def post_columns(post: Column) -> list[Column]:
    """Article columns and author of one post of the posts API."""
    author = _user_item(post["author"], "headline", _avatar(post["author"], keys.USER_AVATAR))
    return [*_article_columns(post), author.alias("author")]


def explode_posts(df: DataFrame, broken: bool = False) -> DataFrame:
    """Article rows of JSON lists of posts, with the nested author.

    With ``broken``, a body that does not parse gives one row without a post and with a
    ``reject_reason``, from the same parse."""
    place = [
        "resp_seq",
        keys.column_from_api_url(F.col("url")).alias("column_slug"),
        keys.offset_from_url(F.col("url")).alias("offset"),
    ]
    body = F.from_json("body", schemas.POSTS)
    if not broken:
        rows = df.select(*place, F.posexplode(body).alias("pos", "post"))
        return rows.select("resp_seq", "pos", *["column_slug", "offset"], *post_columns(F.col("post")))
    rows = _with_broken(df.select(*place, F.explode(F.array(body)).alias("rows")), "post")
    return rows.select(
        "resp_seq", "pos", "column_slug", "offset", *post_columns(F.col("post")), "reject_reason"
    )


def _with_broken(parsed: DataFrame, name: str) -> DataFrame:
    """Takes ``rows`` apart; a null array gives one row with its reason, an empty one none."""
    reason = F.when(F.col("rows").isNull(), F.lit("broken_body")).alias("reject_reason")
    rows = parsed.select(
        *[c for c in parsed.columns if c != "rows"], reason, F.posexplode_outer("rows").alias("pos", name)
    )
    return rows.filter(F.col("pos").isNotNull() | F.col("reject_reason").isNotNull())


def post_keys(df: DataFrame) -> DataFrame:
    """Keys of the posts of each page, without their contents; a broken page has one row with
    its reason."""
    body = F.from_json("body", T.ArrayType(T.StructType([T.StructField("slug", T.StringType())])))
    parsed = df.select(
        "resp_seq",
        keys.column_from_api_url(F.col("url")).alias("column_slug"),
        keys.offset_from_url(F.col("url")).alias("offset"),
        F.explode(F.array(body)).alias("rows"),
    )
    return _with_broken(parsed, "post").select(
        "resp_seq", "pos", "column_slug", "offset",
        keys.md5_key(F.col("post.slug")).alias("md5"), "reject_reason",
    )


def flatten_post_state(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Article row of a page state: the post with the smallest key, its author looked up in
    the user map, the column slug and the topics. Needs ``data`` of ``embedded_json``; a
    page without a usable state gives a row of nulls. ``keep`` names columns to carry on."""
    posts = F.col("data.database.Post")
    post = F.try_element_at(posts, F.array_min(F.map_keys(posts)))
    chosen = df.withColumn("post", post).withColumn(
        "_author", F.try_element_at(F.col("data.database.User"), F.col("post.author"))
    )
    post, author = F.col("post"), F.col("_author")
    return chosen.select(
        F.col("page_id").alias("resp_seq"),
        F.lit(0).alias("pos"),
        post["column"]["slug"].alias("column_slug"),
        *_article_columns(post),
        _user_item(author, "headline", author["avatarUrl"]).alias("author"),
        post["topics"].alias("topics"),
        *keep,
    )


def state_rejects() -> dict[str, Column]:
    """Why a page has no usable post state."""
    return {
        "no_state": F.col("data").isNull(),
        "broken_state": F.col("data._corrupt").isNotNull(),
        "no_post": F.coalesce(F.size("data.database.Post"), F.lit(0)) < 1,
    }


def _explode_data(df: DataFrame, schema: T.StructType) -> DataFrame:
    # One parse per body: the struct is taken apart only above the generator, so the
    # parsing expression is not copied into several columns.
    parsed = df.select("resp_seq", "url", F.explode(F.array(F.from_json("body", schema))).alias("b"))
    return parsed.select("resp_seq", "url", F.posexplode("b.data").alias("pos", "row"))


def explode_members(df: DataFrame) -> DataFrame:
    """User rows of a follower or followee page."""
    row = F.col("row")
    slug = row["url_token"]
    return _explode_data(df, schemas.MEMBERS).select(
        "resp_seq",
        "pos",
        row["id"].alias("zuid"),
        row["name"].alias("name"),
        keys.build_link("people", slug).alias("link"),
        keys.md5_key(slug).alias("hash"),
        slug.alias("slug"),
        F.lit("").alias("description"),
        row["headline"].alias("headline"),
        row["avatar_url"].alias("avatar"),
    )


def _column_rows(df: DataFrame, slug: Column) -> DataFrame:
    return df.select(
        "resp_seq",
        "pos",
        slug.alias("slug"),
        keys.build_link("column", slug).alias("link"),
        keys.md5_key(slug).alias("hash"),
    )


def explode_contributions(df: DataFrame) -> DataFrame:
    """Column rows of a page of contributions (the column is nested)."""
    return _column_rows(_explode_data(df, schemas.CONTRIBUTIONS), F.col("row.column.id"))


def explode_following_columns(df: DataFrame) -> DataFrame:
    """Column rows of a page of followed columns (flat)."""
    return _column_rows(_explode_data(df, schemas.FOLLOWING), F.col("row.id"))


def explode_recommendations(df: DataFrame) -> DataFrame:
    """Column rows of a list of recommendations; a missing slug becomes ''."""
    rows = df.select(
        "resp_seq",
        F.posexplode(F.from_json("body", schemas.RECOMMENDATIONS)).alias("pos", "row"),
    )
    return _column_rows(rows, F.coalesce(F.col("row.slug"), F.lit("")))


def paging(df: DataFrame) -> DataFrame:
    """(url, next_url) of every page that is not the last of its chain."""
    body = F.from_json("body", schemas.PAGED)  # the items are skipped, not built
    parsed = df.select("url", F.explode(F.array(body)).alias("b"))
    is_end = F.coalesce(F.col("b.paging.is_end"), F.lit(False))
    return parsed.filter(~is_end & F.col("b.paging.next").isNotNull()).select(
        "url", F.col("b.paging.next").alias("next_url")
    )


def page_ends(df: DataFrame, by: str = "url") -> DataFrame:
    """url, or another column, of every whole page that is the last of its chain."""
    corrupt = T.StructField("_corrupt", T.StringType())
    body = F.from_json(
        "body",
        T.StructType([*schemas.PAGED.fields, corrupt]),
        {"columnNameOfCorruptRecord": "_corrupt"},
    )
    parsed = df.select(by, F.explode(F.array(body)).alias("b"))
    whole = F.col("b").isNotNull() & F.col("b._corrupt").isNull()
    is_end = F.coalesce(F.col("b.paging.is_end"), F.lit(False)) | F.col("b.paging.next").isNull()
    return parsed.filter(whole & is_end).select(by).distinct()


def column_rejects(df: DataFrame) -> DataFrame:
    """Responses about columns that give no column: broken, or without a slug."""
    corrupt = T.StructField("_corrupt", T.StringType())
    body = F.from_json(
        "body",
        T.StructType([*schemas.COLUMN_INFO.fields, corrupt]),
        {"columnNameOfCorruptRecord": "_corrupt"},
    )
    parsed = df.select("resp_seq", F.explode(F.array(body)).alias("b"))
    reasons = {
        "broken_body": F.col("b").isNull() | F.col("b._corrupt").isNotNull(),
        "no_key": F.col("b.slug").isNull(),
    }
    rejects = with_reject_reason(parsed, reasons).filter(F.col("reject_reason").isNotNull())
    return rejects.select("resp_seq", "reject_reason")


def flatten_column_info(df: DataFrame) -> DataFrame:
    """Column row with its creator (null if it has none) and its number of posts."""
    parsed = df.select(
        "resp_seq", F.explode(F.array(F.from_json("body", schemas.COLUMN_INFO))).alias("c")
    )
    c, creator = F.col("c"), F.col("c.creator")
    return parsed.filter(F.col("c.slug").isNotNull()).select(
        "resp_seq",
        c["name"].alias("name"),
        keys.build_link("column", c["slug"]).alias("link"),
        keys.md5_key(c["slug"]).alias("hash"),
        c["slug"].alias("slug"),
        c["description"].alias("description"),
        _avatar(c, keys.COLUMN_AVATAR).alias("avatar"),
        F.coalesce(c["postsCount"].try_cast("int"), F.lit(0)).alias("total"),
        _user_item(creator, "bio", _avatar(creator, keys.USER_AVATAR)).alias("creator"),
    )


def explode_tags(df: DataFrame) -> DataFrame:
    """(article key, tag name) for every topic of an article."""
    # The outer form with a filter after it: for the inner form Spark would test the array
    # below joins as well, and so parse each page again there.
    topics = df.select("md5", "resp_seq", F.posexplode_outer("topics").alias("pos", "topic"))
    return topics.filter(F.col("pos").isNotNull()).select(
        "md5", "resp_seq", "pos", F.col("topic.name").alias("name")
    )

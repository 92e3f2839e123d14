"""Scalar column functions: keys, links, times, codes, defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Address templates of the crawled site and the protocol codes.
PEOPLE_LINK = "https://www.zhihu.com/people/"
COLUMN_LINK = "https://zhuanlan.zhihu.com/"
ARTICLE_LINK = "https://zhuanlan.zhihu.com/p/"
USER_AVATAR = "https://pic1.zhimg.com/{id}_{size}.jpg"
COLUMN_AVATAR = "https://pic2.zhimg.com/{id}_{size}.jpg"
PUBLISHED = r"^([0-9]{4}-[0-9]{1,2}-[0-9]{1,2}T[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2})\+08:00$"
PROTOCOLS = {1: "HTTP", 2: "HTTPS"}

LINKS = {"people": PEOPLE_LINK, "column": COLUMN_LINK, "article": ARTICLE_LINK}


def md5_key(col: Column) -> Column:
    """Hex md5 of the natural key; a null key stays null and so becomes a reject."""
    return F.md5(col.cast("string"))


def build_link(kind: str, slug: Column) -> Column:
    """Address of a person, column or article."""
    return F.concat(F.lit(LINKS[kind]), slug)


def avatar_url(template: Column, id: Column, size: str = "l", default: str = USER_AVATAR) -> Column:
    """Fill ``{id}`` and ``{size}`` of the template, or of the default if there is none."""
    filled = F.replace(F.coalesce(template, F.lit(default)), F.lit("{size}"), F.lit(size))
    return F.replace(filled, F.lit("{id}"), id)


def slug_from_url(col: Column) -> Column:
    """Last path segment, slashes at either end ignored."""
    return F.element_at(F.split(F.btrim(col, F.lit("/")), "/"), -1)


def offset_from_url(col: Column) -> Column:
    """Integer value of the last query parameter; null if it is none."""
    last = F.element_at(F.split(col, "&"), -1)
    return F.element_at(F.split(last, "="), -1).try_cast("int")


def column_from_api_url(col: Column) -> Column:
    """Column slug inside an address of the shape ``…/columns/<slug>[/posts?…]``."""
    return F.nullif(F.regexp_extract(col, "/columns/([^/?]+)", 1), F.lit(""))


def parse_published(col: Column) -> Column:
    """Wall clock of ``yyyy-mm-ddThh:mm:ss+08:00`` as a zone-less timestamp.

    Any other offset or shape gives null. Independent of the session time zone.
    """
    return F.nullif(F.regexp_extract(col, PUBLISHED, 1), F.lit("")).try_cast("timestamp_ntz")


def encode_protocol(col: Column) -> Column:
    """Protocol text to its code, upper or lower case; anything but HTTP is HTTPS."""
    return F.when(F.upper(col) == "HTTP", 1).otherwise(2)


def decode_choice(col: Column, choices: dict[int, str] = PROTOCOLS) -> Column:
    """Code to display name, '' if unknown."""
    names = F.create_map(*[F.lit(part) for pair in choices.items() for part in pair])
    return F.coalesce(F.try_element_at(names, col), F.lit(""))


def choice_values(choices: dict[int, str] = PROTOCOLS) -> Column:
    """All codes of a choice as an array literal."""
    return F.array(*[F.lit(code) for code in choices])


def proxy_address(protocol: Column, host: Column, port: Column) -> Column:
    """One-entry map ``{protocol in lower case: host:port}``."""
    return F.create_map(F.lower(protocol), F.concat_ws(":", host, port))


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Replace nulls column by column. Columns without a default are left alone."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def stamp(df: DataFrame, at: Column | str | None = None) -> DataFrame:
    """Set create_time and modify_time to one run time.

    ``at`` makes a run repeatable; without it the wall clock of +08:00 is taken, which is
    the same moment in every row of a query.
    """
    if at is None:
        at = F.convert_timezone(F.lit("UTC"), F.lit("+08:00"), F.to_utc_timestamp(
            F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz"))
    elif isinstance(at, str):
        at = F.lit(at).cast("timestamp_ntz")
    return df.withColumns({"create_time": at, "modify_time": at})

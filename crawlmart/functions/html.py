"""HTML column functions: entities, images and links.

Text is cut at the tokens of interest (once for what lies between them, once for them), the
tokens are changed, each by its attributes, and the parts are joined again: linear in the
text, inside the JVM, without recursion.

Accepted grammar: tags and attribute names in any case; attribute values in double or
single quotes or bare; attributes in any order. Comments, scripts and styles are skipped.
"""

from __future__ import annotations

from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Host and path shapes of rewritten addresses.
IMAGE_HOST = "https://pic{n}.zhimg.com/"
IMAGE_HOSTS = 4
POST_PATH = "/p/([0-9]+)"
ARTICLE_PATH = "/article/"

ENTITY = "^(#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);"
XML_NAMES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}

# A quote opens a value only behind an equals sign; elsewhere, and if it is never closed, it
# is a character like others. Every loop is possessive over plain characters or over whole
# attributes, so a match needs no stack however long a tag is.
IN_TAG = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
# What the end of the text cuts off is one token up to there, so that no place is searched
# for an end that is not there more than once. Such a token stays as it is.
TOKEN = (
    r"(?is)<(?:!--(?>.*?-->|.*+)|script\b(?>.*?</script\s*+>|.*+)|style\b(?>.*?</style\s*+>|.*+)"
    rf"|img\b{IN_TAG}(?:>|\z)|a\b{IN_TAG}(?:>|\z))"
)
IMG_TAG = r"(?is)^<img\b.*+(?<=>)"
LINK_TAG = r"(?is)^<a\b.*+(?<=>)"


# Groups: name, text up to the value, double-quoted, single-quoted and bare value.
ATTRIBUTE = (
    r"""(?s)(?:(?<=[\s/])|\G)(([^\s=>/]++)\s*+=\s*+)"""
    r"""(?:"([^"]*+)"|'([^']*+)'|([^\s>]++))"""
)


def _map_tokens(text: Column, change: Callable[[Column], Column]) -> Column:
    parts = F.split(text, TOKEN, -1)
    tokens = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    joined = F.zip_with(
        parts, F.transform(tokens, change), lambda p, t: F.concat(p, F.coalesce(t, F.lit("")))
    )
    return F.array_join(joined, "")


def _attributes(tag: Column) -> Column:
    """The attributes with a value, in order, each as written."""
    return F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(0))


def _place(attributes: Column, name: str) -> Column:
    """Index of the first attribute of that name; -1 if there is none."""
    names = F.transform(attributes, lambda a: F.lower(F.regexp_extract(a, ATTRIBUTE, 2)))
    return F.array_position(names, F.lit(name)).cast("int") - 1


def _value(attribute: Column) -> Column:
    return F.concat(*[F.regexp_extract(attribute, ATTRIBUTE, g) for g in (3, 4, 5)])


def _bound(column: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a column that is computed once, as the element of a lambda."""
    return F.element_at(F.transform(F.array(column), use), 1)


def _changed(tag: Column, name: str, change: Callable[[Column], Column]) -> Column:
    """The tag with another value of an attribute. It stays as it is without the attribute,
    with an empty one, and where ``change`` gives null."""

    def rebuilt(attributes: Column) -> Column:
        def at(i: Column) -> Column:
            def put(value: Column) -> Column:
                def one(a: Column, j: Column) -> Column:
                    head = F.regexp_extract(a, ATTRIBUTE, 1)
                    return F.when(j == i, F.concat(head, F.lit('"'), value, F.lit('"'))).otherwise(a)

                parts = F.zip_with(
                    F.split(tag, ATTRIBUTE, -1),
                    F.transform(attributes, one),
                    lambda gap, a: F.concat(gap, F.coalesce(a, F.lit(""))),
                )
                return F.when(value.isNull(), tag).otherwise(F.array_join(parts, ""))

            old = F.nullif(_value(F.get(attributes, i)), F.lit(""))
            return F.when(i >= 0, _bound(_bound(old, change), put)).otherwise(tag)

        return _bound(_place(attributes, name), at)

    return _bound(_attributes(tag), rebuilt)


def html_unescape(col: Column) -> Column:
    """Decode HTML entities, one level: the named ones of HTML 4 plus ``apos``, decimal and
    hexadecimal ones. What is unknown or no character stays as it is.

    The text is cut at every ``&``; each piece then starts with its entity, if it is one, so
    nothing is decoded twice and the five frequent names need no pattern at all.
    """
    names = F.create_map(
        *[F.lit(x) for name, point in name2codepoint.items() for x in (name, chr(point))]
    )
    end = F.lit(2**31 - 1)

    def other(piece: Column) -> Column:
        entity = F.regexp_extract(piece, ENTITY, 1)
        hexed = F.conv(F.regexp_extract(entity, "^#[xX]0*([0-9a-fA-F]{1,8})$", 1), 16, 10)
        digits = F.regexp_extract(entity, "^#([0-9]+)$", 1)
        point = F.coalesce(digits.try_cast("long"), hexed.try_cast("long"))
        is_char = point.between(1, 0xD7FF) | point.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
        decoded = F.when(entity.startswith("#"), F.when(is_char, char)).otherwise(
            F.try_element_at(names, entity)
        )
        rest = F.substring(piece, F.length(entity) + 2, end)
        return F.coalesce(F.concat(decoded, rest), F.concat(F.lit("&"), piece))

    def decode(piece: Column) -> Column:
        frequent = F
        for name, text in XML_NAMES.items():
            rest = F.substring(piece, F.lit(len(name) + 2), end)
            frequent = frequent.when(piece.startswith(name + ";"), F.concat(F.lit(text), rest))
        return frequent.otherwise(other(piece))

    # The first piece stands before any "&". The pieces are named once, so cut once.
    pieces = F.split(col, "&", -1)
    return F.array_join(
        F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(decode(p))), ""
    )


def image_host(src: Column) -> Column:
    """Host prefix for an image; the same image always gets the same host."""
    number = F.conv(F.substring(F.md5(src), 1, 1), 16, 10).cast("int") % IMAGE_HOSTS + 1
    return F.replace(F.lit(IMAGE_HOST), F.lit("{n}"), number.cast("string"))


def _rewrite_image(tag: Column) -> Column:
    return _changed(tag, "src", lambda src: F.concat(image_host(src), src))


def _rewrite_link(tag: Column, base: str) -> Column:
    def target(href: Column) -> Column:
        number = F.nullif(F.regexp_extract(href, POST_PATH, 1), F.lit(""))
        return F.concat(F.lit(base + ARTICLE_PATH), number, F.lit("/"))

    return _changed(tag, "href", target)


def rewrite_images(col: Column) -> Column:
    """Prefix the source of every image with an image host; images without a source stay."""
    return _map_tokens(col, lambda t: F.when(t.rlike(IMG_TAG), _rewrite_image(t)).otherwise(t))


def rewrite_article_links(col: Column, base: str) -> Column:
    """Point links that hold ``/p/<digits>`` to ``<base>/article/<digits>/``."""
    return _map_tokens(
        col, lambda t: F.when(t.rlike(LINK_TAG), _rewrite_link(t, base)).otherwise(t)
    )


def rewrite_article(col: Column, base: str) -> Column:
    """Both rewrites in one go."""
    return _map_tokens(
        col,
        lambda t: F.when(t.rlike(IMG_TAG), _rewrite_image(t))
        .when(t.rlike(LINK_TAG), _rewrite_link(t, base))
        .otherwise(t),
    )


def cover_or_first_image(cover: Column, html: Column) -> Column:
    """The cover, or the rewritten source of the first image that has one; with neither,
    the empty cover stays as it is."""
    tokens = F.filter(F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0)), lambda t: t.rlike(IMG_TAG))

    def source(tag: Column) -> Column:
        value = _bound(_attributes(tag), lambda a: _value(F.get(a, _place(a, "src"))))
        return F.nullif(value, F.lit(""))

    found = F.filter(F.transform(tokens, source), lambda v: v.isNotNull())
    first = _bound(F.try_element_at(found, F.lit(1)), lambda v: F.concat(image_host(v), v))
    return F.coalesce(F.nullif(cover, F.lit("")), first, cover)

"""Scalar functions on shapes that the tables lack."""

import hashlib

import pytest
from pyspark.sql import functions as F

from crawlmart.functions import html, keys


def one(spark, fn, *values, types=None):
    names = [f"c{i}" for i in range(len(values))]
    schema = ", ".join(f"{n} {t}" for n, t in zip(names, types or ["string"] * len(values)))
    df = spark.createDataFrame([values], schema)
    return df.select(fn(*[F.col(n) for n in names]).alias("r")).first()[0]


def host(src):
    return f"https://pic{int(hashlib.md5(src.encode()).hexdigest()[0], 16) % 4 + 1}.zhimg.com/{src}"


@pytest.mark.parametrize(
    "text, want",
    [
        ("plain", "plain"),
        ("", ""),
        ("a&lt;b&gt;&quot;&apos;&amp;", "a<b>\"'&"),
        ("&amp;lt;", "&lt;"),
        ("&#38;lt;&#x26;gt;", "&lt;&gt;"),
        ("&&#97;mp;", "&amp;"),
        ("&#8364;&#x4e2d;&#X41;&#128512;", "€中A😀"),
        ("&eacute;&nbsp;&copy;&middot;", "é ©·"),
        ("&nosuch; & &; &#xZZ; &#55296; &#1114112;", "&nosuch; & &; &#xZZ; &#55296; &#1114112;"),
        ("tail &amp", "tail &amp"),
        ("&", "&"),
        ("x&amp;", "x&"),
    ],
)
def test_html_unescape(spark, text, want):
    assert one(spark, html.html_unescape, text) == want


def test_html_unescape_null(spark):
    assert one(spark, html.html_unescape, None) is None


@pytest.mark.parametrize(
    "text, want",
    [
        ("<p>no image</p>", "<p>no image</p>"),
        ('<img alt="x">', '<img alt="x">'),
        ('<img src="a.jpg">', f'<img src="{host("a.jpg")}">'),
        ("<IMG class=y SRC='a.jpg' />", f'<IMG class=y SRC="{host("a.jpg")}" />'),
        ("<img src=a.jpg>", f'<img src="{host("a.jpg")}">'),
        ('<img src="a"><br><img src="b">', f'<img src="{host("a")}"><br><img src="{host("b")}">'),
        ('<img alt="1>0" src="a">', f'<img alt="1>0" src="{host("a")}">'),
        ('<img alt=" src=&quot;x" data-src="l" src="a">', f'<img alt=" src=&quot;x" data-src="l" src="{host("a")}">'),
        ("<img alt=\" src='q'\" src=\"a\">", f"<img alt=\" src='q'\" src=\"{host('a')}\">"),
        ('<!-- <img src="a"> -->', '<!-- <img src="a"> -->'),
        ('<script>"<img src=\'a\'>"</script>', '<script>"<img src=\'a\'>"</script>'),
        ('<imgx src="a">', '<imgx src="a">'),
    ],
)
def test_rewrite_images(spark, text, want):
    assert one(spark, html.rewrite_images, text) == want


@pytest.mark.parametrize(
    "text, want",
    [
        ('<a href="https://x/p/12?a=1">t</a>', '<a href="B/article/12/">t</a>'),
        ("<a class='k' href='/p/7/p/8'>", "<a class='k' href=\"B/article/7/\">"),
        ('<a href="https://x/people/12">', '<a href="https://x/people/12">'),
        ('<a href="/p/x">', '<a href="/p/x">'),
        ('<a name="/p/1">', '<a name="/p/1">'),
        ('<link href="/p/1">', '<link href="/p/1">'),
        ('<abbr href="/p/1">', '<abbr href="/p/1">'),
    ],
)
def test_rewrite_article_links(spark, text, want):
    assert one(spark, lambda c: html.rewrite_article_links(c, "B"), text) == want


def test_rewrite_article_does_both(spark):
    text = 'a<img src="i">b<a href="/p/3">c</a>d'
    want = f'a<img src="{host("i")}">b<a href="B/article/3/">c</a>d'
    assert one(spark, lambda c: html.rewrite_article(c, "B"), text) == want


def test_long_text_is_processed_whole(spark):
    text = "x" * 300_000 + '<img src="a">' + "y&amp;" * 50_000
    assert one(spark, html.rewrite_images, text).endswith("y&amp;" * 50_000)
    assert host("a") in one(spark, html.rewrite_images, text)
    assert one(spark, html.html_unescape, text).endswith("y&" * 50_000)


@pytest.mark.parametrize(
    "cover, text, want",
    [
        ("c", '<img src="a">', "c"),
        ("", '<img alt="n"><img src="a"><img src="b">', host("a")),
        (None, '<img src="a">', host("a")),
        ("", "<p>", ""),
        (None, "<p>", None),
    ],
)
def test_cover_or_first_image(spark, cover, text, want):
    assert one(spark, html.cover_or_first_image, cover, text) == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("2017-05-30T17:08:09+08:00", "2017-05-30 17:08:09"),
        ("2017-5-3T7:8:09+08:00", "2017-05-03 07:08:09"),
        ("2017-05-30T17:08:09Z", None),
        ("2017-05-30T17:08:09+09:00", None),
        ("2017-13-30T17:08:09+08:00", None),
        ("2017-05-30T17:08:09", None),
        ("", None),
        (None, None),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_parse_published_keeps_the_wall_clock(spark, text, want, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = one(spark, lambda c: keys.parse_published(c).cast("string"), text)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == want


def test_keys_and_links(spark):
    assert one(spark, keys.md5_key, "a") == hashlib.md5(b"a").hexdigest()
    assert one(spark, keys.md5_key, None) is None
    assert one(spark, lambda c: keys.build_link("column", c), "s").endswith("/s")
    assert one(spark, keys.slug_from_url, "https://x.example/a/b/") == "b"
    assert one(spark, keys.offset_from_url, "https://x.example/a?limit=20&offset=40") == 40
    assert one(spark, keys.offset_from_url, "https://x.example/a") is None
    assert one(spark, keys.column_from_api_url, "https://x/api/columns/s/posts?o=1") == "s"
    assert one(spark, keys.column_from_api_url, "https://x/api/columns/s") == "s"


def test_avatar_template(spark):
    fill = lambda t, i: keys.avatar_url(t, i)
    assert one(spark, fill, "h/{size}/{id}", "7") == "h/l/7"
    assert one(spark, fill, None, "7") == keys.USER_AVATAR.format(id="7", size="l")


def test_choices(spark):
    assert [one(spark, keys.encode_protocol, p) for p in ("http", "HTTP", "HTTPS", "sock")] == [1, 1, 2, 2]
    decode = lambda c: keys.decode_choice(c)
    assert [one(spark, decode, c, types=["int"]) for c in (1, 2, 3, None)] == ["HTTP", "HTTPS", "", ""]


def test_proxy_address_and_defaults(spark):
    got = one(spark, lambda a, b, c: keys.proxy_address(a, b, c), "HTTP", "h", "1")
    assert got == {"http": "h:1"}
    df = spark.createDataFrame([(None, None)], "a int, b string")
    assert keys.with_defaults(df, {"a": 0}).first() == (0, None)


def test_stamp_default_is_one_moment(spark):
    rows = keys.stamp(spark.range(10)).select("create_time", "modify_time").distinct().collect()
    assert len(rows) == 1 and rows[0][0] == rows[0][1]


LONG = "x" * 1_000_000


@pytest.mark.parametrize(
    ("tag", "src"),
    [
        (f'<img alt={LONG} src="a.jpg">', "a.jpg"),
        (f'<img alt="{LONG}" src=\'a.jpg\'>', "a.jpg"),
        (f"<img {LONG} src=a.jpg>", "a.jpg"),
        ("<img " + "a=b " * 200_000 + "src=a.jpg>", "a.jpg"),
        ("<img alt=it's src=\"a.jpg\">", "a.jpg"),
        ('<img alt="x src=no.jpg" SRC = a.jpg>', "a.jpg"),
        ('<img alt="never closed src=a.jpg>', "a.jpg"),
        ("<img alt=''src=a.jpg>", "a.jpg"),
    ],
)
def test_images_in_odd_tags(spark, tag, src):
    df = spark.createDataFrame([(f"p {tag} q",)], "t string")
    host = df.select(html.image_host(F.lit(src)).alias("h")).first().h
    out = df.select(
        html.rewrite_images(F.col("t")).alias("t"),
        html.cover_or_first_image(F.lit(""), F.col("t")).alias("c"),
    ).first()
    if "never closed" in tag:  # the quote is a character; its value ends at the blank
        assert f'src="{host}{src}"' in out.t
    assert out.c == host + src
    assert f'"{host}{src}"' in out.t and out.t.startswith("p <img") and out.t.endswith("> q")

"""Pages with broken, endless and unusual markup: none may stop or stall the query."""

import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from crawlmart.llm.pages import main_text, pieces
from crawlmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    ("page", "wanted"),
    [
        ("<p>x</p><![foo[bar]]><p>y</p>", "x y"),
        ("<p>x</p><![ bar]><p>y</p>", "x y"),
        ("<p>x</p><![CDATA[a]]><p>y</p><!whatever><?php echo ?><p>z</p>", "x y z"),
        ("<p>x</p><!--><p>y</p><!---><p>z</p><!-- a > b --><p>u</p>", "x y z u"),
        ("<p>x</p><!-- never closed <p>y</p>", "x y"),
        ("<p>x</p></><p>y</p></ b><p>z</p>", "x y z"),
        ("<p title=\"a > b\">x</p><p title='c > d'>y</p><p title=>z</p>", "x y z"),
        ("<p>1 < 2 and 3 <4</p>", "1 < 2 and 3 <4"),
        ("<p>a &am<b>b</b> &amp<i>c</i></p>", "a &amb &c"),
        ("<script>a</scripty></script ><p>x</p><style><p>no</style><TITLE><b></Title>", "x"),
        ("<p>x</p><script>never closed <p>y</p>", "x"),
        ("<p class=\"x>open quote</p><p>y</p>", "open quote y"),
    ],
)
def test_broken_markup(page, wanted):
    assert main_text(page) == wanted


@pytest.mark.parametrize(
    "part",
    [
        "<a ", '<p a="', "<!--", "</a ", "<script", "<script>", "<", "&", "&am", "<![", "<a b='", "<a\n",
        '<a b=">" ', "<!-->x", "<title>", "<div>", "<p>a", "<a b", "=", "<a =",
    ],
)
@pytest.mark.parametrize("end", ["", ">", '">', "-->"])
def test_a_megabyte_of_it_takes_seconds(part, end):
    start = time.process_time()
    main_text("<p>x</p>" + part * (1_000_000 // len(part)) + end)
    assert time.process_time() - start < 30  # some 5 s; hours if each place were searched again


def test_pieces_keep_all_text():
    page = "a<b>c<i class='x y' id=z onclick='q'>d</i> < e"
    assert list(pieces(page)) == ["a", "<b>", "c", '<i class="x y" id="z">', "d", "</i>", " ", "&lt;", " e"]


def test_odd_rows_of_pages(spark, tmp_path):
    real = pq.read_table(f"{SF}/pages.parquet").to_pylist()[:5]
    rows = [(r["page_id"], r["url"], r["html"]) for r in real]
    rows += [(1, None, None), (None, "u", "<p>some text</p>"), (2, "u", ""), (2, "u", ""), (3, "v", "<![x[<p>y</p>")]
    rows += rows[:2]
    ids, urls, pages = zip(*rows, strict=True)
    columns = {"page_id": pa.array(ids, pa.int64()), "url": pa.array(urls), "html": pa.array(pages)}
    columns |= {c: pa.array([c] * len(rows)) for c in ("text", "n_chars", "line", "box")}
    pq.write_table(pa.table(columns), f"{tmp_path}/pages.parquet")
    found = QUERIES["op2_page_text"](spark, str(tmp_path)).collect()
    got = sorted(((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in found), key=str)
    wanted = [(i, u, main_text(h), len(main_text(h))) for i, u, h in rows]
    assert got == sorted(wanted, key=str)

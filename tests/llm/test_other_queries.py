"""Pages, vectors, conversations and the pipeline against brute force."""

import html
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402
from test_text_queries import check_sequences, rows, sha  # noqa: E402

import corpus_pipeline  # noqa: E402
from crawlmart import runtime  # noqa: E402
from crawlmart.llm import chat, pii, quality  # noqa: E402
from crawlmart.llm.pages import main_text  # noqa: E402
from crawlmart.llm.queries import QUERIES, tokenizer_path  # noqa: E402


# -- pages -----------------------------------------------------------------------------
def test_articles_of_all_pages(spark, odd_dir):
    found = {r["page_id"]: r for r in rows(QUERIES["op2_page_text"](spark, odd_dir))}
    pages = pq.read_table(f"{odd_dir}/pages.parquet").to_pylist()
    assert len(found) == len(pages)
    for page in pages:
        inside = re.search("<article>(.*?)</article>", page["html"], re.S)[1]
        inside = re.sub("</?b>", "", inside)
        wanted = " ".join(html.unescape(re.sub("<[^>]*>", " ", inside)).split())
        got = found[page["page_id"]]
        assert (got["text"], got["n_chars"], got["url"]) == (wanted, len(wanted), page["url"])


LONG = "A long paragraph with many words in it, enough to be read as the text of a page. "


@pytest.mark.parametrize(
    ("page", "wanted"),
    [
        (None, ""),
        ("", ""),
        ("no markup &amp; no end", "no markup & no end"),
        ("<p>cut off <b", "cut off"),
        ("<script>if (a<b) '<p>no</p>'</script><style>p{}</style><!-- <p>no -->", ""),
        (f"<body><div id='c'><p>{LONG}<p>{LONG}</div><div class='comment-list'><p>{LONG}</div>",
         f"{LONG.strip()} {LONG.strip()}"),
        (f"<main><h1>T</h1><p>{LONG}<form>no<input></form><aside>no</aside></main><p>{LONG}",
         f"T {LONG.strip()}"),
        (f"<nav>no</nav><header>no</header><p>{LONG}</p><p role='alert'>no</p><footer>no</footer>",
         LONG.strip()),
        ("<article><p>a<b>b</b>c</p>d<br>e&nbsp;f\n\tg</article>", "abc d e f g"),
        ("<article><p>&lt;p&gt; &#233; &#x41;</p></article>", "<p> é A"),
        ("<article>" + "<div>" * 3000 + "deep" + "</article>", "deep"),
        ("<article><p>" + "word " * 200_000 + "</p></article>", ("word " * 200_000).strip()),
    ],
)
def test_main_text(page, wanted):
    assert main_text(page) == wanted


def paragraphs(*sizes):
    """Paragraphs of about so many characters, each with words of its own."""
    texts = [" ".join(f"p{k}w{i}" for i in range(max(1, n // 6))) for k, n in enumerate(sizes)]
    return texts, "".join(f"<p>{t}</p>" for t in texts)


@pytest.mark.parametrize(
    "sizes",
    [
        [200] * 10 + [20_000] + [200] * 10,
        [20_000] + [200] * 20,
        [30, 600, 20, 9_000, 40, 15, 300, 10],
        [10, 20, 5_000, 5_000, 30, 10],
    ],
)
def test_uneven_paragraphs_of_an_unmarked_page_stay(sizes):
    texts, inside = paragraphs(*sizes)
    page = f"<nav>no</nav><div><a>Menu</a></div><div id='c'>{inside}</div><footer>no</footer>"
    assert main_text(page) == " ".join(texts)


def test_teasers_do_not_hide_the_text_of_a_page():
    texts, inside = paragraphs(300, 40, 800, 250, 15)
    teaser = "<article><h3><a href='/x'>Other news</a></h3><p>Short.</p></article>"
    for page in (
        f"<div>{inside}</div><div>{teaser * 4}</div>",
        f"<div>{teaser * 4}</div><div id='c'>{inside}</div>",
        f"<div id='c'>{inside}</div><div role='main'>Teaser</div>",
    ):
        assert " ".join(texts) in main_text(page)
    assert main_text(f"<div>{inside}</div><div>{teaser * 4}</div>") == " ".join(texts)


def test_a_link_among_the_text_of_an_article_stays():
    texts, inside = paragraphs(300, 200)
    between = f"<p>{texts[0]}</p><p><a>The paper that all of this is about</a></p><p>{texts[1]}</p>"
    wanted = f"{texts[0]} The paper that all of this is about {texts[1]}"
    links = "<ul><li><a>one</a></li><li><a>two</a></li></ul>"
    assert main_text(f"<article>{between}{links}</article>") == wanted
    assert main_text(f"<div>{between}{links}</div>") == wanted


def test_a_marked_article_outweighs_other_dense_text():
    texts, inside = paragraphs(300, 20, 200)
    other = "<div>" + "Words about the site that stand on each of its pages. " * 3 + "</div>"
    assert main_text(f"{other}<article>{inside}</article>{other}") == " ".join(texts)


@pytest.mark.parametrize(
    "wrapper",
    [
        "<form id='aspnetForm'>", "<form><div class='sidebar-page'>", "<div class='layout has-sidebar'>",
        "<div class='content with-sidebar'>", "<div class='page sticky-header'>",
        "<div id='main-widget'>", "<div class='post comments-open'>", "<div class='noAds hasSidebar'>",
        "<section class='social legal'><div class='share'>", "<aside>", "<main class='skip search'>",
    ],
)
@pytest.mark.parametrize("inner", ["<div>", "<article>"])
def test_a_mark_at_a_wrapper_does_not_bar_the_text(wrapper, inner):
    texts, inside = paragraphs(300, 40, 800, 250)
    end = "".join(f"</{x}>" for x in reversed(re.findall(r"<([a-z]+)", wrapper + inner)))
    page = (
        f"<body class='has-footer'><nav>no</nav>{wrapper}<div class='sidebar'>no no</div>{inner}{inside}"
        f"<form>no<input></form><div class='comments'><p>{LONG}</p></div>{end}<footer>no</footer></body>"
    )
    assert main_text(page) == " ".join(texts)


def test_an_article_in_a_part_with_a_mark_stays():
    texts, inside = paragraphs(100, 40)
    other = f"<div id='c'><p>{LONG}</p><p>{LONG}</p></div>"
    page = f"{other}<div class='widget'><article>{inside}</article></div>"
    assert " ".join(texts) in main_text(page)


def test_marks_bar_parts_that_are_small():
    texts, inside = paragraphs(300, 40, 800, 250)
    parts = "".join(
        f"<div class='{x}'><p>{LONG}</p></div>" for x in ("sidebar", "related has-img", "comments", "cookie")
    )
    page = f"{parts}<div>{inside}</div>{parts}<article class='comment'>{LONG * 30}</article>"
    assert main_text(page) == " ".join(texts)


# -- vectors ---------------------------------------------------------------------------
def test_nearest_is_exact(spark, tmp_path):
    random = np.random.default_rng(5)
    vectors = [list(map(float, v)) for v in random.normal(size=(300, 8)).astype(np.float32)]
    vectors[7] = vectors[9]  # ties
    vectors[20], vectors[40], vectors[60] = None, [0.0] * 8, [1.0, None] + [0.0] * 6
    vectors[80], vectors[100] = [float("nan")] * 8, [float("inf")] * 8
    vectors[120] = [1.0, 2.0]  # of another length
    vectors[140] = [x * 1e-6 for x in vectors[140]]
    vectors[160] = [1e6, *[1e-6] * 7]
    ids = [*range(300), 180, None]
    vectors += [vectors[180], vectors[5]]
    schema = {"vec_id": pa.int64(), "embedding": pa.list_(pa.float32()), "v": pa.int32()}
    table = pa.table(
        {"vec_id": ids, "embedding": vectors, "v": [1] * 302}, schema=pa.schema(list(schema.items()))
    )
    pq.write_table(table, tmp_path / "embeddings.parquet")
    exact = table.column("embedding").to_pylist()
    good = [
        (i, np.array(v, float))
        for i, v in zip(ids, exact, strict=True)
        if v and None not in v and np.isfinite(v).all() and any(v) and i is not None
    ]
    wanted = {}
    for i, v in good:
        if i % 20 == 0:
            near = [(-float(sum(v * w)), j) for j, w in good if j != i and len(w) == len(v)]
            wanted[i] = [(j, pytest.approx(-s)) for s, j in sorted(near)[:20]]
    got = defaultdict(list)
    for r in sorted(rows(QUERIES["op5_nearest_vectors"](spark, str(tmp_path))), key=lambda r: r["rank"]):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    assert dict(got) == {k: v for k, v in wanted.items() if v}


# -- conversations ---------------------------------------------------------------------
def test_chat_round_trip(spark, tmp_path):
    talk = [
        (1, 0, "system", "be kind"), (1, 1, "user", "[INST] <s> [\\INST] <\\\\/s>"),
        (1, 2, "assistant", "</s>\n[/INST]\n <s> \\"), (2, 0, "user", None), (2, 1, "assistant", ""),
        (3, 1, "assistant", " b "), (3, 0, "assistant", "a"), (4, 0, "tool", "[TEXT] [/ROLE]"),
        (4, 1, "[ROLE]", "x [TEXT] y"), (5, None, None, "late"), (5, 0, "user", "first"),
        (None, 0, "user", "no id"), (6, 0, "user", "same"), (6, 0, "user", "same"),
        (7, 0, "user", "q " * 50_000), (7, 1, "assistant", "é漢 😀" * 20_000),
    ]
    ids, turns, roles, texts = (list(x) for x in zip(*talk, strict=True))
    columns = {"conv_id": pa.array(ids, pa.int64()), "turn": pa.array(turns, pa.int64())}
    columns |= {"role": roles, "text": texts, "t": ["x"] * len(ids), "turns": ["y"] * len(ids)}
    pq.write_table(pa.table(columns), tmp_path / "conversations.parquet")
    said = "</s>[INST] ok [/INST]"
    by = defaultdict(list)
    for i, turn, role, text in [*talk, (-7, 0, "user", said), (-7, 1, "assistant", said)]:
        by[i].append((turn is None, turn or 0, role or "", text or ""))
    found = {r["conv_id"]: r for r in rows(QUERIES["op10_chat_format"](spark, str(tmp_path)))}
    assert set(found) == set(by)
    for i, told in by.items():
        told.sort()
        r = found[i]
        loss = "".join(text for _, _, role, text in told if role == "assistant")
        assert r["n_turns"] == len(told)
        assert r["turns_sha256"] == sha("".join(f"{role}\n{text}\n" for *_, role, text in told))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), sha(loss))
    assert found[1]["valid"] and found[1]["complete"] and not found[3]["valid"]
    assert not found[4]["valid"] and found[-7]["complete"] and found[7]["complete"]


def test_chat_output_has_its_control_strings_only_as_marks(spark):
    rows_ = [(1, 0, "user", "[INST] a </s>"), (1, 1, "assistant", "<s> b [/INST]")]
    df = spark.createDataFrame(rows_, "conv_id long, turn long, role string, text string")
    r = chat.format_conversations(df).first()
    assert r["formatted"] == "[INST] [\\INST] a <\\/s> [/INST]\n<s> <\\s> b [\\/INST] </s>\n"
    assert [s["text"] for s in r["segments"] if s["loss"]] == ["<\\s> b [\\/INST]"]


# -- added spans -----------------------------------------------------------------------
def test_skip_chain_adds_what_is_similar_to_a_match():
    texts = [
        f"call +1 ({200 + i}) 555-{1000 + i} or x{i}@mail.example.org for 10.1.2.{i % 200} of {i * 7919}"
        for i in range(200)
    ]
    labels, features, chain, skip = [], [], [], []
    for text in texts:
        field = pii.field_of(text + " " + text, pii.base_spans(text + " " + text))
        label = [max(x, 0) for x in field.label]
        before = [[-1] * len(label), [-1] * len(label)]
        for edges, to in zip((field.chain, field.skip), before, strict=True):
            for i, j in edges:
                to[j] = label[i]
        labels += label
        features += field.features
        chain += before[0]
        skip += before[1]
    model = pii.fit(*(np.array(x) for x in (labels, features, chain, skip)))
    text = "ring +1 (974) 555-3436 today; tomorrow 974-555-3436, and order 123456789 of 77 pieces"
    base, every = pii.spans_of(text, model)
    assert [text[a:b] for a, _, b in base] == ["+1 (974) 555-3436"]
    assert [text[a:b] for a, _, b in every] == ["+1 (974) 555-3436", "974-555-3436"]
    assert pii.redacted(text, every).count("[PHONE]") == 2
    clean = "order 123456789 of 77 pieces, order 123456789 again"
    assert pii.spans_of(clean, model) == ([], [])


@pytest.mark.parametrize(
    ("match", "again"),
    [
        ("+44 20 7946 0958", "020 7946 0958"),
        ("+44 20 7946 0958", "(020) 7946 0958"),
        ("+44 20 7946 0958", "0044 20 7946 0958"),
        ("+442079460958", "020.7946.0958"),
        ("+1 (974) 555-3436", "(974) 555-3436"),
        ("+1 (974) 555-3436", "974 555 3436"),
        ("+1 974-555-3436", "(974)555-3436"),
        ("4111 1111 1111 1111", "4111.1111.1111.1111"),
    ],
)
def test_numbers_written_in_groups_are_found_again(spark, match, again):
    texts = [
        f"call +1 ({200 + i}) 555-{1000 + i} or +1 ({200 + i}) 555-{1000 + i} or x{i}@mail.example.org "
        f"for 10.1.2.{i % 200}, room {i % 50}, card 4111 1111 1111 1111 is 4111 1111 1111 1111 of {i * 7919} pieces"
        for i in range(200)
    ]
    model = pii.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    for text in (f"ring {match} today; later {again}, and 12 34 567 89 of 77 pieces",
                 f"first {again} in 2024 then {match}", f"({match}) or {again}."):
        base, every = pii.spans_of(text, model)
        assert [text[a:b] for a, _, b in base] == [match]
        assert {text[a:b] for a, _, b in every} == {match, again}
        assert len({k for _, k, _ in every}) == 1


def test_runs_end_with_the_number_and_not_before_or_behind_it():
    text = "ring +44 20 7946 0958 or in 2024 020 7946 0958 12 times, not 020 7946 0959 or 10.7.946.958"
    assert [text[a:b] for a, b in pii.runs_of(text, pii.base_spans(text))] == ["020 7946 0958"]
    assert pii.runs_of("12 34 " * 100_000, [(0, 3, 5)]) == []


# -- the pipeline ----------------------------------------------------------------------
def hashed(*values):
    """Spark's hash of a row of longs and strings; null leaves it as it is."""
    h = 42
    for v in values:
        if v is not None:
            raw = v.to_bytes(8, "little", signed=True) if isinstance(v, int) else v.encode()
            h = xxhash.xxh64_intdigest(raw, seed=h)
    return h - (1 << 64) if h >> 63 else h


def brute_mix(docs):
    """(document, words taken) for each pass, by the order of the rows' hashes."""
    by = defaultdict(list)
    for d in docs:
        by[d["source"]].append(d)
    order = sorted((s for s in by if s is not None), key=lambda s: s.encode())
    order += [None] * (None in by)
    size = {s: sum(len(brute.words(d["text"])) for d in by[s]) for s in order}
    weights = [(3, 1, 2)[i % 3] for i in range(len(order))]
    targets = brute.water_filling([size[s] for s in order], weights, 1.5, 2)
    out = []
    for source, target in zip(order, targets, strict=True):
        rows_, cells = by[source], -(-len(by[source]) // 4096)
        keyed = [(hashed(*d.values()), d) for d in rows_]
        rows_ = [d for h, d in sorted(keyed, key=lambda x: (x[0] % cells, x[0]))]
        at, quota = 0, int(target + 1e-6)
        for _ in range(2):
            for d in rows_:
                n = len(brute.words(d["text"]))
                if (k := min(n, quota - at)) > 0:
                    out.append((d, k))
                at += n
    return out


def first_words(text, k):
    found = list(brute.WORD.finditer(text))
    return text if k >= len(found) else text[: found[k].start()]


def test_pipeline_equals_brute_force(spark, odd_dir):
    from tokenizers import Tokenizer

    names = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet").select(*names)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [r.asDict() for r in docs.collect()]
        docs = runtime.materialize(stage(spark, docs, odd_dir), name)
        after = [r.asDict() for r in docs.collect()]
        if k < 4:
            assert docs.columns == names
            assert all(r["n_chars"] == len(r["text"]) for r in after if r["text"] is not None)
        if name == "quality_rules":
            judged = quality.judge(spark.createDataFrame(before, docs.schema)).collect()
            kept = Counter((r["in_0"], r["cleaned"]) for r in judged if r["kept"])
            assert Counter((r["doc_id"], r["text"]) for r in after) == kept
            texts = {r["doc_id"]: r["text"] for r in before}
            assert all(set(r["text"].split("\n")) <= set(texts[r["doc_id"]].split("\n")) for r in after if r["doc_id"])
        elif name == "near_duplicates":
            sets = [brute.shingles(r["text"]) for r in before]
            best = {}
            for part, r in zip(brute.components(sets), before, strict=True):
                key = (r["doc_id"] is not None, r["doc_id"] or 0, hashed(*r.values()))
                best[part] = min(best.get(part, (key, r)), (key, r), key=lambda x: x[0])
            assert Counter(map(str, after)) == Counter(str(r) for _, r in best.values())
        elif name == "private_data":
            model = pii.train(spark.createDataFrame(before, docs.schema))
            wanted = [pii.redacted(r["text"], pii.spans_of(r["text"], model)[1]) for r in before]
            assert Counter(r["text"] for r in after) == Counter(wanted)
            assert not any(brute.spans(r["text"], brute.PERSONAL) for r in after)
        elif name == "source_mix":
            wanted = Counter((d["doc_id"], first_words(d["text"], k)) for d, k in brute_mix(before))
            assert Counter((r["doc_id"], r["text"]) for r in after) == wanted
        else:
            tokenizer = Tokenizer.from_file(tokenizer_path())
            wanted = Counter()
            for r in before:
                ids = [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 0]
                for p, low in enumerate(range(0, len(ids), 2048)):
                    raw = np.array(ids[low : low + 2048], "<u4").tobytes()
                    wanted[(r["doc_id"], p, low, len(raw) // 4, zlib.crc32(raw))] += 1
            columns = "doc_id piece start length ids_crc32".split()
            assert Counter(tuple(r[c] for c in columns) for r in after) == wanted
            check_sequences(after)

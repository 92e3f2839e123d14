"""Weak secrets beside their counterparts: shapes, scope borders, and the query's SQL."""

import duckdb
import pytest

from crawlmart.llm import secrets
from crawlmart.llm.oracles import ORACLES
from crawlmart.llm.queries import QUERIES

KEY = "Zm9vYmFyMTIzNDU2Nzg5MGFi"  # 24 characters
IDENT = "client_id=shop-4711"

CASES = {  # text: kinds of the linked spans
    f"{IDENT} {KEY}": ["ident", "secret"],
    f"{IDENT} {KEY}==": ["ident", "secret"],
    f"{IDENT} {KEY * 4}": ["ident", "secret"],
    f"{IDENT} {KEY[:12]}_{KEY[:6]}-{KEY[:3]}": ["ident", "secret"],
    f"{IDENT} secret_key={KEY}": ["ident", "secret"],
    f"{IDENT} {KEY[:19]}": [],
    f"{IDENT} {KEY.lower()}": [],
    f"{IDENT} //host/{KEY}": [],
    f"{IDENT} page.example/{KEY}": [],
    KEY: [],
    IDENT: [],
    f"{KEY} https://a.example/x": [],
    f"{IDENT} https://a.example/x": [],
    f"{IDENT} https://a.example/x {KEY}": ["ident", "endpoint", "secret"],
    # The scope runs from the end of one part to the start of the next.
    f"{IDENT}{' ' * 400}{KEY}": ["ident", "secret"],
    f"{IDENT}{' ' * 401}{KEY}": [],
    f"{KEY}{' ' * 400}{IDENT}": ["secret", "ident"],
    f"{KEY}{' ' * 401}{IDENT}": [],
    f"{IDENT} https://a.example/{'x' * 2000} {KEY}": ["endpoint"],
    f"{IDENT}{'z' * 3000} {KEY}": ["ident", "secret"],
    f"{KEY * 100} {IDENT} https://a.example/{'y' * 900}": ["secret", "ident", "endpoint"],
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("linked")
    rows = [*enumerate(CASES), (900, None), (901, ""), (902, next(iter(CASES))), (902, next(iter(CASES)))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame.coalesce(1).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_linked_spans(spark, folder):
    found = QUERIES["op4_secret_scan"](spark, folder).collect()
    kinds = {r["doc_id"]: [s.split(":")[0] for s in r["spans"].split(",") if s] for r in found}
    for i, (text, wanted) in enumerate(CASES.items()):
        if i != list(CASES).index(f"{IDENT} https://a.example/{'x' * 2000} {KEY}"):
            assert kinds[i] == wanted, text[:120]
    assert kinds[900] == kinds[901] == [] and kinds[902] == ["ident", "secret"]
    assert len(found) == len(CASES) + 4


def test_a_long_endpoint_links_both_sides(spark, folder):
    """The identifier and the secret lie 2,000 apart: the endpoint has both, they not each other."""
    i = list(CASES).index(f"{IDENT} https://a.example/{'x' * 2000} {KEY}")
    [row] = QUERIES["op4_secret_scan"](spark, folder).filter(f"doc_id = {i}").collect()
    assert [s.split(":")[0] for s in row["spans"].split(",") if s] == ["endpoint"]


def test_equals_sql(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    got = QUERIES["op4_secret_scan"](spark, folder)
    names = sorted(got.columns)
    wanted = con.sql(ORACLES["op4_secret_scan"]).project(", ".join(names)).fetchall()
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(wanted)


def test_scope_is_a_parameter(spark):
    found = spark.createDataFrame(
        [(1, "ident", 0, 20), (1, "secret", 25, 49), (2, "ident", 0, 20), (2, "secret", 26, 50)],
        "key long, kind string, start long, end long",
    )
    kept = {(r["key"], r["kind"]) for r in secrets.linked(found, 5).collect()}
    assert kept == {(1, "ident"), (1, "secret")}

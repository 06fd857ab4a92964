import hashlib
import re

import pytest
from cases import ROWS, frame
from hypothesis import given, settings
from hypothesis import strategies as st

from noticeworks.llm import pii, queries

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        total = sum(int(d) if k % 2 == 0 else sum(map(int, str(2 * int(d)))) for k, d in enumerate(reversed(digits)))
        return 16 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def plain(text):
    return [(k, *m.span()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if passes(k, m[0])]


@pytest.fixture(scope="module")
def anchors():
    return pii.automaton()


def base(text, anchors):
    return [x for x in pii.find(text, anchors) if x[0] in pii.BASE_KINDS]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="0123456789  ..--+()@@ab_%:/é", max_size=40))
def test_any_characters_give_the_spans_of_the_patterns(anchors, text):
    assert base(text, anchors) == plain(text)


PARTS = ["1.2", ".3", ".300", "a@b", ".c", "@", "+1", "(2", ") ", "4111 1111 1111 1111", "41111111", "1", " ", "-", "é", "x"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14))
def test_pieces_of_personal_data_give_the_spans_of_the_patterns(anchors, parts):
    assert base("".join(parts), anchors) == plain("".join(parts))


def test_very_long_runs_stay_linear(anchors):
    for run in ("1", "1.", "a@", "+1", "x"):
        assert base(run * 500 + "@a.b", anchors) == plain(run * 500 + "@a.b")
        pii.find(run * 200_000, anchors)


def test_added_spans(anchors):
    text = "see https://me:pw@host.example.com:80/x?y. IBAN DE89 3704 0044 0532 0130 00, account no. 12345678; iban DE00 1"
    found = {(k, text[s:e]) for k, s, e in pii.find(text, anchors) if k in pii.ADDED_KINDS}
    assert found == {
        ("address", "https://me:pw@host.example.com:80/x?y"),
        ("account", "DE89 3704 0044 0532 0130 00"),
        ("account", "12345678"),
    }


def test_odd_rows_and_names(spark):
    text = "é write a.b@c.de or +1 (234) 567-8901, 10.0.0.1"
    df = frame(spark, [*ROWS, (20, text, "en", "a", 1)], {"Spans": "x"})
    rows = pii.find_personal_data(df).collect()
    assert len(rows) == len(ROWS) + 1
    own = next(r for r in rows if r["doc_id"] == 20)
    assert [(x["kind"], x["value"]) for x in own["spans"]] == [
        ("email", "a.b@c.de"), ("ip", "10.0.0.1"), ("phone", "+1 (234) 567-8901")
    ]
    assert [r["spans"] for r in rows if not r["text"]] == [[]] * sum(not r[1] for r in ROWS)
    assert pii.masked(df).where("doc_id = 20").first()["text"] == "é write <email> or <phone>, <ip>"


def test_empty_table(spark):
    assert pii.find_personal_data(frame(spark, [])).count() == 0


def test_the_query_against_the_patterns(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for row in queries.op4_anchor_expansion(spark, folder).collect():
        spans = plain(texts[row["doc_id"]])
        assert [row[f"n_{k}"] for k in PATTERNS] == [sum(s[0] == k for s in spans) for k in PATTERNS]
        joined = ",".join(":".join(map(str, s)) for s in spans)
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(row["spans"].split(","))

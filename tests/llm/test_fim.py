"""Cuts against their definition, and the exact round trip."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from lodgestar.llm import fim
from validation.compare import connect, normalised

SCHEMA = "doc_id long, text string, n int, form int, output int, id string, key string"


def brute(doc_id, text):
    """n, form, prefix, middle and output over code points."""
    text = text or ""
    digest = hashlib.sha256(b"1:" + (b"" if doc_id is None else str(doc_id).encode())).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


TEXTS = [None, "", "a", "a\r\nb\n", "日本語のテキスト", "e\u0301 \U0001f600\U0001f600", "\x00\x1f", "<P> x",
         "x<S", "<M", "<<P", ">P<", "word " * 200_000, "ends <", "S>M>", " \t\n"]


def test_equals_definition(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS * 12)] + [(None, "no key"), (3, "twice"), (3, "twice")]
    frame = spark.createDataFrame([(i, t, 1, 2, 3, "x", "y") for i, t in rows], SCHEMA)
    cut = fim.transform(frame).withColumn("back", fim.restored(F.col("form"), F.col("output")))
    actual = sorted((tuple(r) for r in cut.collect()), key=repr)
    expected = sorted(((i, *brute(i, t), t or "") for i, t in rows), key=repr)
    assert actual == expected
    assert {r[2] for r in actual} == {"plain", "psm", "spm"}
    assert fim.transform(frame.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.text(st.sampled_from("<>PSM ab\n日"), max_size=40))
def test_cut_by_hand(doc_id, text):
    assert fim.Cutter().cut(str(doc_id), text) == brute(doc_id, text)


def test_other_units(spark):
    texts = ["one two  three\nfour", "  lead", "one"]
    frame = spark.createDataFrame(list(enumerate(texts * 8)), "doc_id long, text string")
    words = fim.Cutter(unit=r"\S+\s*|\s+", plain_percent=0, spm_percent=50)
    cut = fim.transform(frame, cutter=words).withColumn(
        "back", fim.restored(F.col("form"), F.col("output"))
    )
    rows = cut.collect()
    assert {r.form for r in rows} == {"psm", "spm"}
    for row in rows:
        text = texts[row.doc_id % 3]
        assert row.back == text and row.n == [4, 2, 1][row.doc_id % 3]
        edges = {0, len(text)} | {len(text) - len(text[i:]) for i in range(1, len(text))
                                  if text[i - 1].isspace() and not text[i].isspace()}
        assert row.prefix_chars in edges and row.prefix_chars + row.middle_chars in edges
    with pytest.raises(Exception, match="does not cover"):
        fim.transform(frame, cutter=fim.Cutter(unit="[a-z]")).collect()


@pytest.mark.parametrize("signs", [("<P>", "<P>", "<M>"), ("<P>", "", "<M>"), ("ab", "bc", "x"), ("aba", "x", "y"),
                                   ("abc", "b", "x")])
def test_signs_must_not_overlap(signs):
    with pytest.raises(ValueError):
        fim.Cutter(signs=signs)


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    frame = entry_module.queries()["op13_fim"](spark, folder)
    actual = normalised(frame.columns, frame.collect())
    result = connect(folder).execute(entry_module.oracle_sql()["op13_fim"])
    assert actual == normalised([c[0] for c in result.description], result.fetchall())

"""URL rules and terms against a plain reading of their definition."""

import random
import re

import pytest

import __spark_entry__ as entry_module
from lodgestar.llm import url_filter
from lodgestar.llm.queries import URL_RULES
from validation.compare import connect, normalised

SCHEMA = "page_id long, url string, host int, path int, rule int, verdict int, weight int, id int"
WORD = "[0-9a-z\x80-\U0010ffff]"


def brute(url, rules=URL_RULES):
    """Host, path, rule and verdict, terms by regular expressions."""
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    lower = {c: c + 32 for c in range(65, 91)}
    host = host.translate(lower)
    fits = [
        r for r in rules
        if ("." + host).endswith("." + r.host.translate(lower)) and path.startswith(r.path)
    ]
    best = max(fits, key=lambda r: (len(r.host) + len(r.path), len(r.host)), default=None)
    text = (url or "").translate(lower)

    def found(terms):
        patterns = (t.replace(" ", f"(?!{WORD})[\\s\\S]") for t in terms)
        return sum(bool(re.search(f"(?<!{WORD}){p}(?!{WORD})", text)) for p in patterns)

    blocked = found(url_filter.STRICT_TERMS) > 0 or found(url_filter.SOFT_TERMS) > 1
    verdict = best.verdict if best else "block" if blocked else "allow"
    return host, path, best and best.host.translate(lower) + best.path, verdict


def judged(spark, urls, rules=URL_RULES, **options):
    frame = spark.createDataFrame([(i, u, 1, 2, 3, 4, 5, 6) for i, u in enumerate(urls)], SCHEMA)
    rows = url_filter.judge(frame, rules, **options).collect()
    assert len(rows) == len(urls)
    return sorted(rows, key=lambda r: r.page_id)


URLS = [
    None,
    "",
    "no scheme casino",
    "://",
    "http://EXAMPLE.org",
    "http://example.org/es/1",
    "https://Blog.Example.ORG/en/17?x=/es/",
    "https://example.org/en/2",
    "https://notexample.org/es/1",
    "http://a.com/fr/x#casino",
    "http://a.com/de/",
    "http://a.com?/fr/",
    "http://a.com/FR/",
    "http://a.net/x://b.org/es/",
    "http://a.net/casino",
    "http://a.net/casinos",
    "http://a.net/mycasino",
    "http://a.net/Casino1",
    "http://a.net/CASINO.html",
    "http://a.net/écasino",
    "http://a.net/casino-é",
    "http://cheap-pills.net/",
    "http://cheappills.net/",
    "http://cheap--pills.net/",
    "http://a.net/free",
    "http://a.net/free/free?free=free",
    "http://a.net/free/win",
    "http://a.net/free_bonus",
    "http://free.net/?q=poker",
    "http://a.net/" + "x/" * 200_000 + "porn",
    "http://a.net/free",
    "http://a.org:80/x",
    "http://org/",
    "http://.org/",
    "http://a.org./",
    "http://a\nb.org/p\nq",
]


def test_equals_definition(spark):
    for row, url in zip(judged(spark, URLS), URLS):
        assert (row.host, row.path, row.rule, row.verdict) == brute(url), url[:80]


def test_random_urls(spark):
    draw = random.Random(7)
    parts = ["casino", "free", "win", "org", "com", "example", ".", "/", "-", "?", "#", "://", "É",
             "fr", "de", "es", "en", "1", "A", "spam", "cheap", "pills", " "]
    urls = ["http://" + "".join(draw.choices(parts, k=draw.randrange(12))) for _ in range(3_000)]
    rules = [*URL_RULES, url_filter.Rule("block", "Example.com"), url_filter.Rule("allow", "com", "/")]
    for row, url in zip(judged(spark, urls, rules), urls):
        assert (row.host, row.path, row.rule, row.verdict) == brute(url, rules), url


def test_weights_and_terms(spark):
    terms = {"a b": 1.0, "c": 1.5, "d": 0.5}
    urls = ["x://a-b", "x://a-b/c", "x://a.b/d", "x://d/d/d", "x://c/d"]
    rows = judged(spark, urls, (), terms=terms)
    assert [(r.weight, r.verdict) for r in rows] == [
        (1.0, "allow"), (2.5, "block"), (1.5, "allow"), (0.5, "allow"), (2.0, "block")
    ]
    assert rows[1].soft_terms == ["a b", "c"]
    assert [r.verdict for r in judged(spark, ["x://casino"], (), terms={})] == ["allow"]
    with pytest.raises(ValueError):
        url_filter.judge(spark.range(1), [URL_RULES[0]] * (url_filter.MOST_RULES + 1))
    with pytest.raises(ValueError):
        url_filter.Rule("maybe", "org")


def test_rows_are_kept(spark):
    frame = spark.createDataFrame(
        [(None, "http://a.org/", *[1] * 6), (1, None, *[1] * 6), (1, "u", *[1] * 6), (1, "u", *[1] * 6)],
        SCHEMA,
    )
    rows = url_filter.judge(frame, URL_RULES).collect()
    assert sorted(r.page_id for r in rows if r.page_id is not None) == [1, 1, 1] and len(rows) == 4
    assert url_filter.judge(frame.limit(0), URL_RULES).count() == 0


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    frame = entry_module.queries()["op12_url_filter"](spark, folder)
    actual = normalised(frame.columns, frame.collect())
    result = connect(folder).execute(entry_module.oracle_sql()["op12_url_filter"])
    assert actual == normalised([c[0] for c in result.description], result.fetchall())

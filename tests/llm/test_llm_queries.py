"""Queries against their SQL, URL filters, and the pipeline against brute force."""

import os
import subprocess
import sys

import duckdb
import oracle
import pytest
import sentencepiece
from llm_cases import SCHEMA, SMALL, odd_rows
from test_llm_near_dedup import brute
from test_llm_texts import PIECES, brute_hits

import corpus_pipeline
from rosterflow.llm import url_filter
from rosterflow.llm.queries import QUERIES, SQL, URL_RULES


@pytest.fixture(scope="module")
def db():
    return oracle.connect(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, db, name):
    assert oracle.differences(QUERIES[name](spark, SMALL), db, SQL[name]) == []


def test_all_operators_are_registered():
    numbers = {name[2:].partition("_")[0] for name in QUERIES}
    assert numbers == {str(n) for n in range(1, 14)}
    assert "pipeline" in corpus_pipeline.QUERIES and corpus_pipeline.ORACLE_SQL is None


URLS = [
    (0, "http://A.net", None, "allow"),
    (1, "http://a.NET/", None, "block"),
    (2, "https://www.example.net/en/x?q#f", None, "allow"),
    (3, "http://example.net/de/", None, "block"),
    (4, "http://notexample.com/de/", None, "allow"),
    (5, "http://m.example.com/de/y", None, "block"),
    (6, "no scheme/net/", None, "allow"),
    (7, None, "<link rel=canonical href=http://a.net/>", "allow"),
    (8, "", None, "allow"),
    # aliases: 9 points at a blocked page, 10 at 9, 11 at 10 and at an allowed page
    (9, "http://one.com/a", "<link rel='canonical' href='http://a.net/z'>", "block"),
    (10, "http://two.com/b?x=1", "<meta http-equiv=refresh content='0; url=//one.com/a'>", "block"),
    (11, "http://three.com/c", "<link href=\"http://x.org/fr/k\" rel=\"canonical\">", "allow"),
    (12, "http://x.org/de/", None, "allow"),
    (13, "http://four.com/e", "<meta content='5;URL=/f' http-equiv='Refresh'>", "block"),
    (14, "https://four.com/f#part", "<link rel=canonical href=https://b.net/>", "block"),
    (15, "https://four.com/f", None, "block"),
    (16, "https://four.com/f", None, "block"),
]


def test_url_verdicts(spark, db):
    pages = spark.createDataFrame([r[:3] for r in URLS], "page_id int, url string, html string").selectExpr("*", "'old' AS host", "'old' AS resource")
    judged = url_filter.judge(pages, URL_RULES)
    assert {r["page_id"]: r["verdict"] for r in judged.collect()} == {r[0]: r[3] for r in URLS}
    parts = {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in judged.collect()}
    assert parts[0] == ("a.net", "", None) and parts[2] == ("www.example.net", "/en/x", "example.net/en/") and parts[6] == parts[7] == parts[8] == ("", "", None)
    own = oracle.connect(SMALL)
    own.execute("CREATE OR REPLACE VIEW pages AS SELECT * FROM (VALUES " + ", ".join("(?, ?, ?)" for _ in URLS).replace("?", "{}").format(*(_literal(v) for r in URLS for v in r[:3])) + ") t(page_id, url, html)")
    assert oracle.differences(judged.select("page_id", "host", "path", "rule", "verdict"), own, SQL["op9_url_filter"]) == []


def _literal(value):
    return "NULL::VARCHAR" if value is None else str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


@pytest.mark.parametrize(
    "url, html, dst",
    [
        ("http://h.com/a/b?q", "<link rel=canonical href=page2>", "h.com/a/page2"),
        ("http://h.com", "<link rel=canonical href=page2#top>", "h.com/page2"),
        ("http://h.com/a/b/c", "<link rel=canonical href='../x'>", "h.com/a/x"),
        ("http://h.com/a/b/c", "<meta http-equiv=refresh content='0; url=./../../../..'>", "h.com/"),
        ("http://h.com/a/b/", "<link rel=canonical href='.'>", None),
        ("http://h.com/a/b", "<link rel=canonical href='?id=3'>", "h.com/a/b?id=3"),
        ("http://h.com/a/b", "<link rel=canonical href='/x/./y/../z?u=../v'>", "h.com/x/z?u=../v"),
        ("http://h.com/a", "<link rel=canonical href='p?u=http://o.com/'>", "h.com/p?u=http://o.com/"),
        ("http://h.com/a", '<link rel=canonical href="http://a/x?b=1&amp;c=2&#38;d&#x3D;&#233;&bogus;&#1114112;">', "a/x?b=1&c=2&d=\u00e9&bogus;\ufffd"),
        ("http://h.com/a", "<base href='//o.com/d/'><link rel=canonical href=e>", "o.com/d/e"),
        ("http://h.com/a/b", "<base target=t><base href='c/'><link rel=canonical href=e>", "h.com/a/c/e"),
        ("http://h.com/a/b", "<base href='/d/'><link rel=canonical href='#f'>", "h.com/d/"),
        ("http://h.com/a", "<base href='/d'><link rel=canonical>", None),
        ("http://h.com/a", "<link rel=canonical href='mailto:x@y'><link rel=canonical href='#f'>", None),
    ],
)
def test_targets_of_links_are_resolved(spark, url, html, dst):
    pages = spark.createDataFrame([(url, html)], "url string, html string")
    assert [r["dst"] for r in url_filter.page_links(pages).collect()] == ([dst] if dst else [])


@pytest.mark.parametrize(
    "html, dst",
    [
        ("<script>var t = '<link rel=canonical href=http://t.com/a>'</script>", None),
        ("<!-- <link rel=canonical href='http://t.com/a'> -->", None),
        ("<style>/* <link rel=canonical href='http://t.com/a'> */", None),
        ("<link data-rel='canonical' href='http://t.com/a'>", None),
        ("<link rel='canonical-x' href='http://t.com/a'>", None),
        ("<link rel='canonical' data-href='http://t.com/a'>", None),
        ("<link rel='nofollow canonical' href='http://t.com/a'>", "t.com/a"),
        ("<script src=x></script><link href='http://t.com' rel=canonical>", "t.com/"),
        ("<meta http-equiv=refresh content='0;url=http://t.com?x'>", "t.com/?x"),
    ],
)
def test_only_markup_ties_pages(spark, html, dst):
    found = url_filter.page_links(spark.createDataFrame([("http://p.com", html)], "url string, html string")).collect()
    assert [tuple(r) for r in found] == ([("p.com/", dst)] if dst else [])


def test_links_of_the_query_are_those_of_its_sql(spark):
    rows = [
        (1, "http://p.com/1", "<!-- <link rel=canonical href='http://a.net/'> -->x"), (2, "http://p.com/2", "<link rel=canonical href='http://t.com'>"),
        (3, "http://t.com/", "<meta http-equiv=refresh content='1; url=http://bad.net/z'>"), (4, "http://p.com/4", "<link data-rel=canonical href='http://bad.net/z'>"), (5, "http://bad.net", None),
    ]
    frame = spark.createDataFrame(rows, "page_id int, url string, html string")
    db = duckdb.connect()
    db.execute("CREATE TABLE pages (page_id INT, url VARCHAR, html VARCHAR)")
    db.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    want = {r[0]: r[1] for r in db.execute(f"SELECT page_id, verdict FROM ({SQL['op9_url_filter']})").fetchall()}
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(frame, URL_RULES).collect()}
    assert got == want == {1: "allow", 2: "block", 3: "block", 4: "allow", 5: "allow"}
    assert url_filter.judge(frame.limit(0), URL_RULES).isEmpty()


def test_an_allowed_alias_wins_over_a_blocked_one(spark):
    pages = spark.createDataFrame([(1, "http://plain.com/"), (2, "http://q.com/")], "page_id int, url string")
    links = spark.createDataFrame([("plain.com/", "bad.net/"), ("plain.com/", "good.org/fr/"), ("q.com/", "bad.net/x")], "src string, dst string")
    assert {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, URL_RULES, links).collect()} == {1: "allow", 2: "block"}
    none = url_filter.judge(pages, [], links.limit(0)).collect()
    assert {(r["rule"], r["verdict"]) for r in none} == {(None, "allow")}


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, items = docs.columns, [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    good = {r["doc_id"]: r["predicted"] for r in QUERIES["op3_quality_classifier"](spark, SMALL).collect()}
    fit = {r["doc_id"]: r["kept"] for r in QUERIES["op2_quality_rules"](spark, SMALL).collect()}
    for (name, stage), check in zip(corpus_pipeline.STAGES[:4], ("quality", "rules", "near", "benchmark"), strict=True):
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        stage(spark, docs, SMALL).write.parquet(path := f"{tmp_path}/{check}")
        docs = spark.read.parquet(path)
        assert docs.columns == columns, name
        kept = {r["doc_id"] for r in docs.collect()}
        if check == "quality":
            expected = {i for i in before if good[i]}
        elif check == "rules":
            expected = {i for i in before if fit[i]}
        elif check == "near":
            expected = {i for i, _, c in brute(list(before.items()), corpus_pipeline.SHINGLE_WORDS) if i == c}
        else:
            expected = set()
            for i, text in before.items():
                n, hit, _ = brute_hits(text, items)
                if not (hit and 20 * hit >= n):
                    expected.add(i)
        assert kept == expected, name
    processor = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, SMALL).collect()} == {i: processor.encode(t) for i, t in left.items()}


def test_stages_take_odd_rows(spark):
    docs = spark.createDataFrame(odd_rows(), SCHEMA).selectExpr("*", "'old' AS score", "'old' AS kept", "'old' AS matches")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        assert set(map(tuple, out.collect())) <= set(map(tuple, docs.collect()))
        assert stage(spark, docs.limit(0), SMALL).isEmpty()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == len(odd_rows())


def test_workers_are_given_the_package(tmp_path):
    """A session elsewhere, which has the package on the driver's path alone."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = tmp_path / "job.py"
    script.write_text(
        f"import sys\nsys.path.insert(0, {root!r})\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '2').getOrCreate()\n"
        "from rosterflow.llm import decontaminate, near_dedup\n"
        "docs = spark.createDataFrame([(1, 'a b c d'), (2, 'a b c d')], 'doc_id long, text string')\n"
        "print('KEPT', near_dedup.representatives(docs, 2).count(), decontaminate.clean(docs, docs.selectExpr('doc_id AS item_id', 'text')).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=280)
    assert "KEPT 1 0" in ran.stdout, ran.stderr[-2000:]

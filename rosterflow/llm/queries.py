"""The numbered operators as queries over the driver tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.llm import decontaminate, html_extract, license_scan, near_dedup, ngram_automaton, phrase_transducers, piece_codec, prefix_trie, quality_classifier, quality_rules, sorted_passes, toxicity, url_filter
from rosterflow.llm.learning import remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(folds: int) -> Column:
    return (remainder(F.col("doc_id"), folds) == 0).alias("held_out")


@query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by supervised subword embeddings."""
    documents = table(spark, sf_dir, "documents")
    model = quality_classifier.fit(documents, table(spark, sf_dir, "labels"))
    scored = quality_classifier.score(documents.select("doc_id", "text"), model, keep=("doc_id",))
    return scored.select("doc_id", held_out(5), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document by a naive Bayes scaled linear classifier."""
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    scored = toxicity.score(documents.select("doc_id", "text"), model, keep=("doc_id",))
    return scored.select("doc_id", held_out(5), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, base rule and verdict of boosted trees for every document."""
    documents = table(spark, sf_dir, "documents")
    trees = quality_rules.fit(documents, table(spark, sf_dir, "labels"))
    judged = quality_rules.judge(documents.select("doc_id", "text"), trees, keep=("doc_id",))
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept")


def piece_model() -> piece_codec.PieceModel:
    import public_tokenizers

    return piece_codec.load(public_tokenizers.path("piece_bpe_32k.model"))


@query
def op7_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document, their digest, those of their spans in the text's bytes and of the decoded text."""
    encoded = piece_codec.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), piece_model(), keep=("doc_id",))
    spans = F.concat_ws(";", *(F.array_join(F.col(c).cast("array<string>"), ",") for c in ("begins", "ends")))
    return encoded.select("doc_id", *piece_digests(), F.sha2(spans, 256).alias("spans_sha256"))


def piece_digests() -> list[Column]:
    """Columns of the pieces' count and digest and of the decoded text's digest."""
    return [
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    ]


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside benchmark windows, and the items they come from."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = decontaminate.judge(decontaminate.match(documents, table(spark, sf_dir, "benchmark"), keep=("doc_id",)))
    return judged.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ALPHANUMERIC_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), '{}', '{}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_UPPER, _LOWER)

SQL["op4_decontaminate"] = f"""
WITH d AS (SELECT doc_id, {_ALPHANUMERIC_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_ALPHANUMERIC_WORDS} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[p:p + least(len(w), 13) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p FROM i WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT size FROM iw),
dw AS (
  SELECT doc_id, p, size, array_to_string(w[p:p + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM d, sizes WHERE len(w) >= size)
),
hits AS (SELECT doc_id, p, dw.size, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.size = iw.size),
covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document's set of 2-word shingles and its group of near-duplicates."""
    linked = near_dedup.link(table(spark, sf_dir, "documents"), width=2)
    return linked.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


SQL["op1_near_dedup"] = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents
),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS grams FROM d
),
g AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS shared
  FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY 1, 2
),
links AS (SELECT x, y FROM pairs WHERE 100 * shared >= 80 * (nx + ny - shared)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT x AS node, x AS seen FROM both_ways UNION SELECT b.y, r.seen FROM reach r JOIN both_ways b ON r.node = b.x),
least_seen AS (SELECT node, min(seen) AS component FROM reach GROUP BY node)
SELECT doc_id, CAST(len(grams) AS BIGINT) AS n_shingles, coalesce(component, doc_id) AS component_id, doc_id = coalesce(component, doc_id) AS kept
FROM s LEFT JOIN least_seen ON s.doc_id = least_seen.node
"""


@query
def op6_ngram_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base score and backoff automaton score of every document, learnt from nine tenths of them."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = ngram_automaton.score(documents, remainder(F.col("doc_id"), 10) != 0)
    return scored.select("doc_id", held_out(10), *ngram_automaton.SCORES)


URL_RULES = [
    url_filter.Rule("block", "net/"),
    url_filter.Rule("allow", "example.net/en/"),
    url_filter.Rule("block", "example.com/de/"),
    url_filter.Rule("allow", "org/fr/"),
]


@query
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url", "html"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _fits(rule: url_filter.Rule) -> str:
    return f"WHEN (host = '{rule.host}' OR host LIKE '%.{rule.host}') AND starts_with(path, '{rule.path}') THEN '{rule.site}'"


_BY_LENGTH = sorted(URL_RULES, key=lambda r: -len(r.site))
_RULE = "CASE " + " ".join(map(_fits, _BY_LENGTH)) + " END"
_VERDICT = "CASE rule " + " ".join(f"WHEN '{r.site}' THEN '{r.verdict}'" for r in URL_RULES) + " END"


def _url_parts(url: str) -> str:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
    host = f"translate(regexp_extract({url}, '{pattern}', 1), '{_UPPER}', '{_LOWER}')"
    return f"coalesce({host}, '') AS host, coalesce(regexp_extract({url}, '{pattern}', 2), '') AS path, coalesce(regexp_extract({url}, '{pattern}', 3), '') AS query"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


SQL["op9_url_filter"] = f"""
WITH RECURSIVE p AS (SELECT page_id, url, html, {_url_parts('url')} FROM pages),
r AS (SELECT * REPLACE (regexp_replace(html, {_quoted(url_filter.NO_MARKUP)}, '', 'g') AS html), CASE WHEN host <> '' THEN host || CASE path WHEN '' THEN '/' ELSE path END || query END AS resource, {_RULE} AS rule FROM p),
tags AS (
  SELECT resource, host, regexp_extract(t, {_quoted(url_filter.CANONICAL_TARGET)}, 1) AS target
  FROM (SELECT resource, host, unnest(regexp_extract_all(html, {_quoted(url_filter.CANONICAL_TAG)})) AS t FROM r)
  UNION ALL
  SELECT resource, host, regexp_extract(t, {_quoted(url_filter.REFRESH_TARGET)}, 1)
  FROM (SELECT resource, host, unnest(regexp_extract_all(html, {_quoted(url_filter.REFRESH_TAG)})) AS t FROM r)
),
full_target AS (
  SELECT resource AS src, CASE WHEN starts_with(target, '//') THEN 'x:' || target WHEN starts_with(target, '/') THEN 'x://' || host || target ELSE target END AS url FROM tags
),
links AS (
  SELECT DISTINCT src, dst FROM (SELECT src, host, host || CASE path WHEN '' THEN '/' ELSE path END || query AS dst FROM (SELECT src, {_url_parts('url')} FROM full_target)) WHERE host <> '' AND src IS NOT NULL AND src <> dst
),
both_ways AS (SELECT src, dst FROM links UNION SELECT dst, src FROM links),
reach AS (SELECT src AS node, src AS seen FROM both_ways UNION SELECT b.dst, reach.seen FROM reach JOIN both_ways b ON reach.node = b.src),
nodes AS (SELECT seen, {_VERDICT} AS verdict FROM (SELECT seen, {_RULE} AS rule FROM (SELECT DISTINCT seen, {_url_parts("'x://' || seen")} FROM reach))),
carried AS (SELECT node, CASE WHEN bool_or(verdict = 'allow') THEN 'allow' WHEN bool_or(verdict = 'block') THEN 'block' END AS carried FROM reach JOIN nodes USING (seen) GROUP BY node)
SELECT page_id, host, path, rule, coalesce({_VERDICT}, carried, 'allow') AS verdict FROM r LEFT JOIN carried ON r.resource = carried.node
"""


@query
def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses whose notices every document holds, and the words that they were found in."""
    matched = license_scan.match(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=("doc_id",))
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    spans = F.transform("matches", lambda m: F.concat_ws(":", m["license"], m["word"], m["length"]))
    return matched.select("doc_id", F.size("matches").cast("long").alias("n_matches"), F.array_join(names, ",").alias("licenses"), F.array_join(spans, ";").alias("spans"))


@query
def op11_sorted_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector among the vectors of its label."""
    linked = sorted_passes.link(table(spark, sf_dir, "embeddings"))
    return linked.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))


SQL["op11_sorted_passes"] = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS place, vec_id, label, CAST(embedding AS DOUBLE[]) AS x,
    coalesce(label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(embedding, lambda e: e <> 0)) > 0, false) AS fit
  FROM embeddings
),
links AS (
  SELECT a.place AS one, a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND len(a.x) = len(b.x) AND a.place <> b.place
  WHERE a.fit AND b.fit AND list_dot_product(a.x, b.x) / sqrt(list_dot_product(a.x, a.x) * list_dot_product(b.x, b.x)) >= 0.93
),
counts AS (SELECT one, count(*) AS n_links FROM links GROUP BY one),
reach AS (SELECT x AS node, x AS seen FROM links UNION SELECT l.y, r.seen FROM reach r JOIN links l ON r.node = l.x),
least_seen AS (SELECT node, min(seen) AS component FROM reach GROUP BY node)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(CASE WHEN fit THEN component END, vec_id) AS component_id,
  coalesce(vec_id = coalesce(CASE WHEN fit THEN component END, vec_id), true) AS kept
FROM v LEFT JOIN counts ON counts.one = v.place LEFT JOIN least_seen ON least_seen.node = v.vec_id
"""


@query
def op12_phrase_transducers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best phrases of every language, with the counts of their parts."""
    return phrase_transducers.phrases(table(spark, sf_dir, "documents").select("lang", "text"))


SQL["op12_phrase_transducers"] = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?
-
]')) AS piece FROM documents
),
w AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM pieces),
grams AS (
  SELECT lang, size, array_to_string(w[p:p + size - 1], ' ') AS phrase, w[p:p + size - 1] AS words
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM w, (SELECT unnest([1, 2, 3]) AS size) WHERE len(w) >= size)
),
f AS (SELECT lang, size, phrase, any_value(words) AS words, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY lang, size, phrase),
totals AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, size, phrase, words, f AS a FROM f WHERE size > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.phrase, c.size, c.a, k, l.f AS l, r.f AS r, (1000000 * c.a * c.a) // (l.f * r.f) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM c) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1:k], ' ') AND l.size = k
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[k + 1:], ' ') AND r.size = c.size - k
),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, phrase, max(longer) AS longer FROM (SELECT lang, a AS longer, unnest([array_to_string(words[1:2], ' '), array_to_string(words[2:3], ' ')]) AS phrase FROM c WHERE size = 3) GROUP BY lang, phrase),
kept AS (SELECT lowest.* FROM lowest LEFT JOIN inside ON inside.lang = lowest.lang AND inside.phrase = lowest.phrase WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT k.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) k JOIN totals t ON t.lang = k.lang WHERE rank <= 2000
"""


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


SQL["op13_prefix_trie"] = r"""
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS t
  FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM (SELECT unnest(range(256)) AS i))
),
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM conversations WHERE conv_id IS NOT NULL
),
own AS (SELECT conv_id, conv_id - conv_id % 20 AS base, list({'role': role, 'text': text} ORDER BY place) AS said FROM turns GROUP BY conv_id),
crcs AS (
  SELECT conv_id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))), lambda c, x: xor(t[CAST(xor(c, x) & 255 AS INTEGER) + 1], c >> 8)), 4294967295) AS crc
  FROM own, crc_table
),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.said, [])[1:CAST(crc % 4 AS INTEGER)], o.said[CAST(crc % 4 AS INTEGER) + 1:]) AS said
  FROM own o JOIN crcs USING (conv_id) LEFT JOIN own b ON b.conv_id = o.base
),
steps AS (
  SELECT conv_id, depth, said[1:depth] AS prefix, len(said) = depth AS ends, CASE WHEN depth > 0 THEN len(regexp_extract_all(said[depth].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
  FROM (SELECT conv_id, said, unnest(range(0, len(said) + 1)) AS depth FROM rebuilt)
),
members AS (SELECT conv_id AS member, depth, min(conv_id) OVER (PARTITION BY prefix) AS conv_id, ends, words FROM steps),
nodes AS (
  SELECT conv_id, depth, count(*) AS n_convs, max(words) AS words, coalesce(string_agg(CAST(member AS VARCHAR), ',' ORDER BY member) FILTER (WHERE ends), '') AS end_ids
  FROM members GROUP BY conv_id, depth
),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN members p ON p.member = n.conv_id AND p.depth = n.depth - 1
),
children AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY 1, 2),
counted AS (SELECT l.*, coalesce(c.n_children, 0) AS n_children FROM linked l LEFT JOIN children c ON c.conv_id = l.conv_id AND c.depth = l.depth),
sums AS (
  SELECT a.conv_id, a.depth, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((v.n_convs - 1) * v.words) AS saved_tokens
  FROM counted v JOIN members a ON a.member = v.conv_id AND a.depth <= v.depth GROUP BY 1, 2
)
SELECT c.conv_id, CAST(c.depth AS BIGINT) AS depth, c.parent_conv_id, CAST(c.n_convs AS BIGINT) AS n_convs, CAST(c.n_children AS BIGINT) AS n_children,
  CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(c.end_ids) AS ends_sha256
FROM counted c JOIN sums s ON s.conv_id = c.conv_id AND s.depth = c.depth
"""

"""Decontamination, SentencePiece codec, license scans and main text extraction."""

import hashlib
import random
import re
import time
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from llm_cases import SMALL, alphanumeric, empty_frame, odd_frame, odd_rows, small
from pyspark.sql import functions as F

from rosterflow.llm import arrays, decontaminate, html_extract, license_scan, piece_codec
from rosterflow.llm.queries import QUERIES, piece_model

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def brute_hits(text, items):
    """Hit places and items, trying every window at every place."""
    words, hit, named = alphanumeric(text), set(), set()
    for item, item_text in items:
        own = alphanumeric(item_text)
        size = min(13, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
                named.add("" if item is None else str(item))
    return len(words), len(hit), sorted(named)


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 60])
def test_same_as_trying_every_window(spark, block_bytes):
    rng = random.Random(8)
    vocabulary = ["a", "b", "Cc", "d3", "é"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 12, 13, 14, 30])))) for i in range(12)]
    items += [(3, items[3][1]), (50, None), (None, " ".join(f"word{i}" for i in range(5, 25)))]
    rows = [(1000 + i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60))) + " " + (rng.choice(items)[1] or ""), None, None, None) for i in range(60)]
    frame = odd_frame(spark, "matches", "n_words").unionByName(spark.createDataFrame(rows, odd_frame(spark).schema), allowMissingColumns=True)
    judged = decontaminate.judge(decontaminate.match(frame, spark.createDataFrame(items, "item_id int, text string"), block_bytes=block_bytes))
    got = sorted(((r["doc_id"] or 0, r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in judged.collect()))
    expected = []
    for r in [*odd_rows(), *rows]:
        n, hit, named = brute_hits(r[1], items)
        expected.append((r[0] or 0, n, hit, named, hit > 0 and 20 * hit >= n))
    assert got == sorted(expected)


def test_longest_matches_have_places(spark):
    item = " ".join(f"w{i}" for i in range(40))
    text = "x y " + " ".join(f"w{i}" for i in range(5, 30)) + " z"
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = decontaminate.match(frame, spark.createDataFrame([(9, item)], "item_id int, text string")).collect()
    assert [tuple(m) for m in row["matches"]] == [("9", 5, 2, 25)]


def test_match_goes_on_where_the_prompt_that_items_share_ends(spark):
    prompt = " ".join(f"p{i}" for i in range(20))
    own = [" ".join(f"q{k}x{i}" for i in range(30)) for k in range(3)]
    items = spark.createDataFrame([(k, f"{prompt} {own[k]}") for k in range(3)], "item_id int, text string")
    texts = [(0, f"a b {prompt} c"), (1, f"a {prompt} {own[2]} b {own[1]}"), (2, own[0] + " " + prompt)]
    got = {r["doc_id"]: ([tuple(m) for m in r["matches"]], sorted(r["items"])) for r in decontaminate.match(spark.createDataFrame(texts, "doc_id int, text string"), items).collect()}
    assert got == {0: ([("0", 0, 2, 20)], ["0", "1", "2"]), 1: ([("0", 0, 1, 20), ("2", 0, 1, 50), ("1", 20, 52, 30)], ["0", "1", "2"]), 2: ([("0", 20, 0, 30), ("0", 0, 30, 20)], ["0", "1", "2"])}


def test_a_prompt_that_all_items_share_costs_one_search():
    prompt = " ".join(f"p{i}" for i in range(20))
    texts = arrays.Texts(pa.array([f"{prompt} own{i} word{i}" for i in range(2500)]))
    words = arrays.Words(texts, arrays.ALPHANUMERIC, fold=True)
    windows = decontaminate.Windows([str(i) for i in range(2500)], words, 13)
    assert len(windows.begin) == 8 + 2 * 2500 and len(windows.members) == 2 * 2500
    tracemalloc.start()
    (text, *_), (owner, group) = decontaminate.longest_matches(words, windows)
    assert tracemalloc.get_traced_memory()[1] < 100_000_000
    tracemalloc.stop()
    assert len(text) <= 2 * 2500 and len(owner) == 2 * 2500


def test_suffixes_are_in_order():
    rng = np.random.default_rng(2)
    text = np.sort(rng.integers(0, 9, 400))
    hashes = rng.integers(0, 4, 400).astype(np.uint64)
    shard = decontaminate.Shard(hashes, text, 13)
    ends = np.searchsorted(text, text, "right")
    suffixes = [hashes[p : min(p + 13, ends[p])].tolist() for p in shard.order]
    assert suffixes == sorted(suffixes) and sorted(shard.order.tolist()) == list(range(400))


def test_nothing_to_find(spark):
    none = spark.createDataFrame([], "item_id int, text string")
    assert decontaminate.clean(odd_frame(spark, "n_words"), none).count() == len(odd_rows())
    assert decontaminate.clean(empty_frame(spark), none).isEmpty()


def samples():
    rng = random.Random(6)
    letters = "ab c de  ▁\n\t\r\0é漢字🎉ßx0A<>.,' ​"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(400)]
    texts += ["", " ", "  ", "▁", "\n", "<0x0A>", "a" * 3000, "the" * 500, " " * 200, "é" * 90]
    return texts + [t for (t,) in small("SELECT text FROM 'SF/documents.parquet'")]


def test_pieces_spans_and_decoding_are_the_library_s():
    processor = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    codec, texts = piece_codec.Codec(piece_codec.load(PIECES)), samples()
    ids, first, begin, end = codec.encode([t.encode() for t in texts])
    decoded = codec.decode(ids, first)
    for i, text in enumerate(texts):
        own = slice(first[i], first[i + 1])
        assert ids[own].tolist() == processor.encode(text)
        assert decoded[i] == processor.decode(ids[own].tolist())
        if i % 7 == 0:
            # byte pieces have their own byte here, and the whole character at its last byte there
            spans = [None if codec.model.kinds[p.id] == piece_codec.BYTE else (p.begin, p.end) for p in processor.encode(text, return_type="proto").pieces]
            assert all(s is None or s == (b, e) for s, b, e in zip(spans, begin[own].tolist(), end[own].tolist(), strict=True))


def test_a_full_memory_is_emptied(monkeypatch):
    monkeypatch.setattr(piece_codec, "REMEMBERED", 20)
    processor = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    codec = piece_codec.Codec(piece_codec.load(PIECES))
    for text in samples()[:60]:
        assert codec.encode([text.encode()])[0].tolist() == processor.encode(text)


def test_damaged_pieces_decode_as_the_library_does():
    processor, codec = sentencepiece.SentencePieceProcessor(model_file=PIECES), piece_codec.Codec(piece_codec.load(PIECES))
    rng = random.Random(9)
    for _ in range(300):
        ids = [rng.choice([1, 2, *range(3, 259), 500, 28705, 1000]) for _ in range(rng.randint(0, 8))]
        assert codec.decode(np.array(ids, np.int32), np.array([0, len(ids)])) == [processor.decode(ids)]


def compiled_map(rules):
    """A double-array trie of the rules, in the library's layout; every node has 256 places of its own."""
    values, units, bases = b"", [0] * 8192, iter(range(256, 8192, 256))

    def place(node, options):
        children = {}
        for key, value in options:
            children.setdefault(key[0] if key else None, []).append((key[1:], value))
        base = next(bases)
        units[node] |= (node ^ base) << 10
        for label, rest in children.items():
            if label is None:
                units[node] |= 1 << 8
                units[base] = rest[0][1] | 1 << 31
            else:
                units[base ^ label] |= label
                place(base ^ label, rest)

    options = []
    for key, to in rules.items():
        options.append((key.encode(), len(values)))
        values += to.encode() + b"\0"
    place(0, options)
    blob = b"".join(u.to_bytes(4, "little") for u in units)
    return len(blob).to_bytes(4, "little") + blob + values


def test_longest_prefix_wins_and_keeps_the_source():
    model = piece_codec.load(PIECES)
    model.map = piece_codec.CharacterMap(compiled_map({"Ａ": "A", "ab": "xyz", "abc": "q", "　": " ", "é": ""}))
    text = "Ａab abc　éd".encode()
    out, source = model.normalise(text)
    assert out == b" Axyz q d"
    assert source.tolist() == [0, 0, 3, 3, 3, 5, 6, 9, 14, 15]
    model.squeeze = True
    out, source = model.normalise("  ab 　 d  ".encode())
    assert out == b" xyz d" and source.tolist() == [2, 2, 2, 2, 4, 9, 10]


def test_encoding_odd_rows(spark):
    processor = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    model = piece_model()
    encoded = piece_codec.encode(odd_frame(spark, "ids", "decoded"), model)
    rows = encoded.collect()
    assert sorted((r["doc_id"] or -1, r["ids"]) for r in rows) == sorted((r[0] or -1, processor.encode(r[1] or "")) for r in odd_rows())
    again = piece_codec.decode(encoded.drop("text").withColumnRenamed("decoded", "first").withColumn("decoded", F.lit("old")), model)
    assert all(r["decoded"] == r["first"] for r in again.collect())
    assert piece_codec.encode(empty_frame(spark), model).isEmpty()
    (row,) = QUERIES["op7_piece_codec"](spark, SMALL).filter("doc_id = 3").collect()
    (text,) = small("SELECT text FROM 'SF/documents.parquet' WHERE doc_id = 3")[0]
    ids = processor.encode(text)
    assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert row["decoded_sha256"] == hashlib.sha256(processor.decode(ids).encode()).hexdigest() and row["n_tokens"] == len(ids)


def test_retrieved_windows_are_all_that_verify(spark):
    rng = random.Random(12)
    filler = [f"f{i}" for i in range(50)] + ["the", "license", "under", "software"]
    rows = []
    for i in range(200):
        words = rng.choices(filler, k=rng.choice([0, 3, 20, 150]))
        if i % 2:
            notice = rng.choice(list(license_scan.TEMPLATES.values())).split()
            if i % 3 == 0:
                notice[rng.randrange(len(notice))] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = notice
        rows.append((i, " ".join(words), None, None, None))
    frame = spark.createDataFrame(rows, odd_frame(spark).schema).unionByName(odd_frame(spark))
    found = license_scan.match(frame.withColumn("matches", F.lit("old"))).collect()
    every = license_scan.match(frame, retrieve=False).collect()
    assert [(r["doc_id"], r["matches"]) for r in found] == [(r["doc_id"], r["matches"]) for r in every]
    for r in found:
        for name, notice in license_scan.TEMPLATES.items():
            if notice in (r["text"] or ""):
                assert name in {m["license"] for m in r["matches"]}
    assert license_scan.match(empty_frame(spark)).isEmpty()
    assert license_scan.match(frame, templates={}).filter("size(matches) > 0").isEmpty()


def test_licenses_are_those_that_a_plain_count_contains(spark):
    rng = random.Random(12)
    notice = {f"l{k}": " ".join(rng.choices([f"v{i}" for i in range(40)], k=rng.choice([20, 45, 90]))) for k in range(5)}
    templates = license_scan.templates_of(spark.createDataFrame([*notice.items(), ("l0", notice["l0"]), (None, "x y"), ("none", None)], "name string, text string"))
    assert templates == notice
    texts = []
    for i in range(60):
        name = rng.choice(sorted(notice))
        kept = [w for w in notice[name].split() if rng.random() > rng.choice([0.0, 0.03, 0.3])]
        texts.append((i, " ".join([f"a{i}"] * rng.randrange(30) + kept + [f"b{i}"] * rng.randrange(30))))
    found = {r["doc_id"]: {m["license"] for m in r["matches"]} for r in license_scan.match(spark.createDataFrame(texts, "doc_id int, text string"), templates).collect()}
    for i, text in texts:
        words = text.split()
        pairs = set(zip(words, words[1:], strict=False))
        for name, own in notice.items():
            wanted = set(zip(own.split(), own.split()[1:], strict=False))
            share = len(wanted & pairs) / len(wanted)
            assert (name in found[i]) == (share >= license_scan.CONTAINMENT), (i, name, share)
    with pytest.raises(ValueError, match="may be sent"):
        license_scan.templates_of(spark.createDataFrame([("l", "x" * 100)], "name string, text string"), 50)


PAGE = "<html><head><title>t</title></head><body>{}</body></html>"


def extracted(spark, pages, **settings):
    frame = spark.createDataFrame([(i, u, h, "old") for i, (u, h) in enumerate(pages)], "page_id int, url string, html string, text string")
    return [r["text"] for r in sorted(html_extract.extract(frame, **settings).collect(), key=lambda r: r["page_id"])]


def test_main_text(spark):
    article = (
        "<nav><a href=x>menu</a></nav><article><header><h1>A &amp; B</h1></header><p>one<br>two  <b>bold</b><p>&lt;three&gt;&nbsp;x<script>var t='</p>';</script>"
        "<div class='ad'>buy</div><ul><li>i<li>j</ul><form>f</form><section id=comments><article class=comment><p>me too</article></section></article><aside>side</aside>"
    )
    pages = [("http://a.b/1", PAGE.format(article)), (None, None), ("http://a.b/2", ""), ("x", "plain"), (None, "<p>un<b>closed"), ("http://a.b/3", "<p>a &copy b &#228; &bogus;")]
    assert extracted(spark, pages) == ["A & B\n\none two bold\n\n<three> x\n\ni\n\nj", "", "", "plain", "unclosed", "a © b ä &bogus;"]


def test_subtrees_that_recur_on_a_host_go(spark):
    def page(i):
        return PAGE.format(f"<div><div>Site line</div><div>Box <b>of</b> links</div></div><div><p>Own text {i}</p><p>Passage</p></div>")

    ours = [("http://h.x/%d" % i, page(i)) for i in range(6)]
    other = [("http://k.x/1", PAGE.format("<div>Site line</div><p>Else</p>"))]
    copies = [("http://c.x/%d" % i, PAGE.format("<p>The same page</p>")) for i in range(9)]
    texts = extracted(spark, [*ours, *other, *copies], least_pages=5)
    assert texts[:6] == [f"Own text {i}" for i in range(6)]
    assert texts[6] == "Site line\n\nElse"
    assert set(texts[7:]) == {"The same page"}
    kept = [("http://h.x/%d" % i, PAGE.format(f"<article><p>Own {i}</p><p>Passage</p></article>")) for i in range(6)]
    assert extracted(spark, kept, least_pages=5) == [f"Own {i}\n\nPassage" for i in range(6)]


def test_recurrence_decides_beside_an_article(spark):
    def page(i):
        beside = f"Site line<div><h2>Lead {i}</h2><p>Box of links</p></div>"
        return PAGE.format(f"<div id=wrap>{beside}<article><p>Own {i}</p><p>Passage</p></article><div>Rights held<p>Second {i}</p></div><nav>menu</nav></div>")

    texts = extracted(spark, [("http://h.x/%d" % i, page(i)) for i in range(6)], least_pages=5)
    assert texts == [f"Lead {i}\n\nOwn {i}\n\nPassage\n\nSecond {i}" for i in range(6)]


def test_passages_of_a_hot_host_are_no_template(spark):
    def page(i):
        return PAGE.format(f"<div>Site line</div><p>Own text {i}</p>" + "<p>Les.</p>" * (i % 4 == 0) + "<p>Shared passage</p>" * (i % 5 < 2))

    hot = [("http://hot.x/%d" % i, page(i)) for i in range(60)]
    few = [("http://few.x/%d" % i, PAGE.format(f"<div>Site line</div><p>Text {i}</p>")) for i in range(3)]
    texts = extracted(spark, [*hot, *few])
    for i in range(60):
        assert texts[i].split("\n\n") == [f"Own text {i}"] + ["Les."] * (i % 4 == 0) + ["Shared passage"] * (i % 5 < 2)
    assert texts[60:] == [f"Text {i}" for i in range(3)]


@pytest.mark.parametrize(
    "html, text",
    [
        ("<p>a</p><![foo x]><p>b</p>", "a\n\nb"),
        ("<p>a</p><![ x", "a"),
        ("<p>a</p><!-- x", "a"),
        ("<p>a</p><!-- x > y <p>z", "a"),
        ("<p>a</p><a href=\"x", "a"),
        ("<p>a</p><!", "a"),
        ("<p>a</p><!x>b", "a\n\nb"),
        ("<p>a</p><![CDATA[x]]>b", "a\n\nb"),
        ("<p>a < b</p> <3", "a < b\n\n<3"),
        ("<p>a</p></", "a"),
        ("<!DOCTYPE", ""),
        ("\x00<p>\ud7ff</p>", "\x00\n\n\ud7ff"),
    ],
)
def test_malformed_markup_never_fails(html, text):
    assert "\n\n".join(html_extract.Page(html).blocks) == text


def test_names_mark_as_a_whole_only(spark):
    pages = [
        '<article class="share-post"><p>a</p></article>', '<article id="form-3"><p>a</p></article>', '<div class="ad-free-content">a</div>',
        '<article><h1 id="search">a</h1><div class="related-work">b</div><div class="big AD">c</div></article>', '<article id="comments">a</article>', "<div id=comments>a</div><p>b</p>",
    ]
    assert extracted(spark, [(f"http://{i}.x/", PAGE.format(p)) for i, p in enumerate(pages)]) == ["a", "a", "a", "a\n\nb", "a", "b"]


def test_templates_of_a_generated_site_against_a_plain_count(spark):
    chance = random.Random(6)
    boxes = [f"<div><p>box {k}</p></div>" for k in range(12)]
    pages, wanted, seen = [], [], {}
    for i in range(300):
        box, rare = chance.choice(boxes), f"<div>rare {chance.randrange(250)}</div>"
        pages.append(("http://g.x/%d" % i, PAGE.format(f"{box}<article><p>Own {i}</p></article>{rare}")))
        for element in (box, rare):
            seen.setdefault(element, set()).add(i)
        wanted.append((box, rare))
    texts = extracted(spark, pages)
    for i, (box, rare) in enumerate(wanted):
        kept = [re.sub("<[^>]*>", "", e) for e in (box, rare) if len(seen[e]) < max(html_extract.LEAST_PAGES, 300 * html_extract.SHARE_BESIDE)]
        assert sorted(texts[i].split("\n\n")) == sorted([f"Own {i}", *kept])


def test_a_deep_page_takes_its_length():
    began = time.process_time()
    page = html_extract.Page("<b><p>x</p>" * 40_000)
    assert len(page.blocks) == 40_000 and len(page.hashes) <= 120_001
    assert time.process_time() - began < 10


def test_no_pages(spark):
    frame = spark.createDataFrame([], "page_id long, url string, html string, host string")
    assert html_extract.extract(frame).isEmpty()

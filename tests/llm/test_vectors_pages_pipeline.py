"""Embedding near-dedup, HTML extraction and the pipeline against brute force."""

import re
import time
from html import unescape

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lymphoframe.llm import pages, vectors
from lymphoframe.llm.registry import QUERIES


def brute(rows, least=0.95):
    ids = [i for i, _ in rows]
    links, parent = {i: 0 for i in ids}, {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sound = [(i, np.array(v, np.float64)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    for k, (i, x) in enumerate(sound):
        for j, y in sound[k + 1 :]:
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                links[i] += 1
                links[j] += 1
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (links[i], root(i), root(i) == i) for i in ids}


@pytest.mark.parametrize("block", [4096, 40])
def test_embedding_dedup(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "SHARD", block)
    monkeypatch.setattr(vectors, "PER_SHARD", 60)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(120, 16))
    near = np.repeat(base[:6], 12, axis=0) + rng.normal(size=(72, 16)) * 0.12
    rows = [(k, [float(np.float32(x)) for x in v]) for k, v in enumerate(np.concatenate([base, near, np.repeat(base[7:8], 9, axis=0)]))]
    rows += [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [None] + [1.0] * 15), (905, [float("inf")] + [1.0] * 15), (906, [1.0, 2.0]), (907, [1.5, 3.0]), (908, [2.0, -1.0]), (909, [1.0, 2.25])]  # a shorter length links among itself
    frame = spark.createDataFrame([(i, v, "x", 5) for i, v in rows], "vec_id long, embedding array<float>, label string, n_links int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(frame).collect()}
    want = brute(rows)
    assert got.keys() == want.keys()
    assert sum(g[0] for g in got.values()) >= 0.97 * sum(w[0] for w in want.values())
    assert all(g[0] <= w[0] for g, w in zip((got[i] for i in want), want.values(), strict=True))
    assert sum(got[i] != want[i] for i in want) <= 4
    recall = {r.audited_recall for r in vectors.near_duplicates(frame).collect()}
    assert len(recall) == 1 and min(recall) >= vectors.RECALL


def test_embedding_dedup_of_the_table_with_near_copies(spark):
    """The table's own vectors hold few links, so near copies of every tenth are put in."""
    base = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()][:600]
    rng = np.random.default_rng(9)
    rows = base + [(100_000 + 10 * i + k, [float(np.float32(x)) for x in np.array(v) * 3 + rng.normal(size=len(v)) * np.linalg.norm(v) * 0.03]) for i, v in base[::10] for k in range(3)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    want = brute(rows)
    assert sum(w[0] for w in want.values()) >= 360
    assert sum(g[0] for g in got.values()) >= 0.98 * sum(w[0] for w in want.values()) and all(got[i][0] <= want[i][0] for i in want)


def test_embedding_search_leaves_the_shard_by_united_edges(spark, monkeypatch):
    """Few shards to a vector: pairs that share none are found over guests' edges, and only verified ones count."""
    monkeypatch.setattr(vectors, "PER_SHARD", 9)
    monkeypatch.setattr(vectors, "OVERLAP", 2)
    monkeypatch.setattr(vectors, "RECALL", 0.0)
    rng = np.random.default_rng(5)
    rows = [(k, [float(np.float32(x)) for x in v]) for k, v in enumerate(rng.normal(size=(500, 3)))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want = brute(rows)
    got = {r.vec_id: r.n_links for r in vectors.near_duplicates(frame).collect()}
    monkeypatch.setattr(vectors, "_guests", lambda dealt, edges: dealt.limit(0))
    alone = {r.vec_id: r.n_links for r in vectors.near_duplicates(frame).collect()}
    true = sum(w[0] for w in want.values())
    assert all(alone[i] <= got[i] <= want[i][0] for i in want)
    assert sum(alone.values()) < sum(got.values()) and sum(got.values()) >= 0.98 * true


def test_embedding_dedup_by_pairs_of_centroids(spark, monkeypatch):
    """More shards wanted than the sample gives centroids."""
    monkeypatch.setattr(vectors, "SAMPLE", 64)
    monkeypatch.setattr(vectors, "PER_SHARD", 20)
    rng = np.random.default_rng(6)
    base = rng.normal(size=(150, 12))
    rows = [(k, [float(np.float32(x)) for x in v]) for k, v in enumerate(np.concatenate([base, np.repeat(base[:50], 3, axis=0) + rng.normal(size=(150, 12)) * 0.1]))]
    got = {r.vec_id: (r.n_links, r.audited_recall) for r in vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    want = brute(rows)
    assert sum(g for g, _ in got.values()) >= 0.97 * sum(w[0] for w in want.values()) and all(got[i][0] <= want[i][0] for i in want)
    assert min(r for _, r in got.values()) >= vectors.RECALL
    near = vectors._nearest(rng.normal(size=(40, 9)), 4, True)
    assert all(len(set(x)) == 4 for x in near.tolist()) and near.max() < 81


def test_embedding_dedup_small_and_empty(spark, sf):
    frame = spark.createDataFrame([(5, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(frame).collect()} == {5: (1, 3, False), 3: (1, 3, True), 4: (0, 4, True)}
    assert {r.audited_recall for r in vectors.near_duplicates(frame).collect()} == {None}  # of two distinct vectors none is linked: nothing to measure
    assert vectors.near_duplicates(frame.where("vec_id < 0")).count() == 0
    assert QUERIES["op6_embedding_dedup"](spark, sf).count() == spark.read.parquet(f"{sf}/embeddings.parquet").count()


def test_embedding_dedup_of_repeated_ids(spark):
    """Rows that share a vec_id stay rows; none is lost, and what is alike lies in one component."""
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.99, 0.01]), (2, [0.0, 1.0]), (3, [0.01, 0.99]), (4, [-1.0, 0.0]), (4, None)]
    out = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert sorted(r.vec_id for r in out) == sorted(i for i, _ in rows)
    assert all(r.component_id <= r.vec_id and r.kept == (r.component_id == r.vec_id) for r in out)
    assert {r.component_id for r in out if r.vec_id == 4} == {4} and all(r.component_id == 1 for r in out if r.vec_id == 1)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x:1}</style></head><body class="home">
<header><div class=logo>Site name</div></header><div id="cookieNotice">We use cookies, all right?</div><ul class="main-menu"><li><a href=x>Home</a><li><a>News</a></ul>
<div class="content"><h1>Title &amp; more</h1><p>First <b>bold</b>&nbsp;text, with <a href=q>a link</a>.<p>Second   para
wraps.<ul><li>item one, yes<li>item two</ul><table><tr><td>Cell a<td>Cell b</table><form><input><label>Mail</label></form><div class="ad">Buy now!</div></div>
<div class="sidebar"><p>Popular things here, a lot of them, and more text than you think, really, of all kinds.</p></div>
<div id=comments><p>I disagree with this, totally, and at great length, as ever.</p></div><div class="footer">&copy; 2020</div><script>if(a<b){x="</p>"}</script></body></html>"""


def test_page_text():
    assert pages.content(PAGE) == ["Title & more", "First bold text, with a link.", "Second para wraps.", "item one, yes", "item two", "Cell a", "Cell b"]
    assert pages.content(None) == pages.content("") == pages.content("<nav>a menu</nav>") == []
    assert pages.content("plain text only") == ["plain text only"] and pages.content("<p>a<p>b < c") == ["a", "b < c"]
    assert pages.content("<article><header><h1>Head</h1><p>By someone</p></header><p>Body of it.</p></article><p>else</p>") == ["Head", "Body of it."]


def test_linked_text_of_the_article_stays():
    long = "A sentence of the body, with commas, and of some length, so that the path scores well. " * 3
    items = "".join(f"<li><a href=r{k}>Reference {k}, by its authors, in the journal of the field, volume {k}.</a></li>" for k in range(3))
    page = f"<nav><a href=/>Home</a></nav><article><h1><a href=t>Title</a></h1><p>{long}</p><p><a href=s>One linked sentence, whole.</a></p><p>{long}</p><ul><li><a href=o>Single</a></li></ul><ol>{items}</ol></article>"
    assert pages.content(page) == ["Title", long.strip(), "One linked sentence, whole.", long.strip(), "Single", *[f"Reference {k}, by its authors, in the journal of the field, volume {k}." for k in range(3)]]
    menu = "".join(f"<li><a href=m{k}>Go {k}</a></li>" for k in range(8))
    assert pages.content(f"<article><h1>Title</h1><ul>{menu}</ul><p>{long}</p><p>{long}</p></article>") == ["Title", long.strip(), long.strip()]


def test_doubtful_names_and_buttons_inside_an_article():
    long = ["The committee met on Tuesday, and after some hours of debate it agreed on the first part of the plan.", "In a related study, published last year, the authors found that the effect was smaller, but still there.", "What comes next, nobody knows; the second part will be debated in spring, once the figures are in."]
    page = f'<body><article><h1>Plan</h1><p>{long[0]}</p><p class="related">{long[1]}</p><p>{long[2]} <button>Like</button> Really.</p><p class="share">Send it on</p><p class="advert">{long[0]} Buy.</p></article><footer>End</footer></body>'
    assert pages.content(page) == ["Plan", long[0], long[1], f"{long[2]} Really."]
    assert pages.content("<p>One <select><option>a<option>b</select> two <span hidden>no</span>three.</p>") == ["One two three."]


def test_reader_comments_longer_than_the_article():
    text = "The bridge was closed on Monday, and it will open again in May."
    said = "I have crossed this bridge every day, for thirty years, and never has anyone asked us what we think of it. "
    talk = "".join(f"<div class=c{k}><p>{said * 3}</p></div>" for k in range(6))
    for name in ("user-responses", "thread", "x9"):  # outside the article by its title, whatever the name
        for heading in ("", "<h2>What you say</h2>"):
            page = f'<body><h2>The Daily</h2><article><h1>Bridge</h1><p>{text}</p><p>{text}</p></article><section id="{name}">{heading}{talk}</section></body>'
            assert pages.content(page) == ["Bridge", text, text]
    for name in ("user-responses", "thread", "readerFeedback"):  # inside it, or without an article, by its name
        assert pages.content(f'<article><h1>Bridge</h1><p>{text}</p><p>{text}</p><section id="{name}">{talk}</section></article>') == ["Bridge", text, text]
        assert pages.content(f'<div><h1>Bridge</h1><p>{text}</p><p>{text}</p></div><div class="{name}">{talk}</div>') == ["Bridge", text, text]
    # teasers in article elements don't outweigh a text outside that has the title, nor one of two titled texts the other
    cards = "".join(f"<article><h3>Card {k}</h3><p>A short teaser, number {k}.</p></article>" for k in range(2))
    assert pages.content(f"<div class=x1><h1>Bridge</h1><p>{said * 4}</p><p>{said * 4}</p></div><div>{cards}</div>")[:3] == ["Bridge", *[(said * 4).strip()] * 2]
    two = pages.content(f"<article><h1>One</h1><p>{text}</p></article><div class=x2><h1>Two</h1><p>{said * 4}</p><p>{said * 4}</p></div>")
    assert two[-3:] == ["Two", *[(said * 4).strip()] * 2]
    assert pages.content(f'<p class="thread">{text}</p><p>{text}</p>') == [text, text]  # a forum page that is all thread, too:
    assert pages.content(f'<div id="thread"><h1>Bridge</h1><p>{text}</p><p>{text}</p></div>') == ["Bridge", text, text]


def test_pages_without_article_or_main():
    """Tag-path ratios alone: names say nothing, the threshold decides."""
    long = "A sentence of the body, with commas, and of some length, so that the path scores well."
    page = f"<div class=x1><div>Buy now</div><div><a href=1>Home</a><a href=2>News</a></div><div class=x2><h1>Title</h1><p>{long}</p><p>Short.</p><ul><li>item one</ul><p>{long}</p></div><div class=x3><p>{{}}</p></div><div class=x4>Call us</div></div>"
    first = ["Title", long, "Short.", "item one", long]
    assert pages.content(page.format("tiny")) == first != pages.content(page.format("tiny"), threshold=0)
    assert pages.content(page.format(long)) == [*first, long]  # two articles
    assert pages.content(page.format(long).replace("x2", "content-share-legal")) == [*first, long]  # names that say both
    assert pages.content(page.format(long).replace("x3", "comments")) == first
    assert pages.content(f"<form><label>Name</label><div><h1>Title</h1><p>{long}</p><p>{long}</p></div></form>") == ["Title", long, long]
    assert pages.content(f"<article><p>{long}</p></article><div>Next one</div><article><p>{long}</p><p>End.</p></article>") == [long, long, "End."]
    assert pages.content("<p title=it's>first</p><p>second isn't here</p><p>third</p>") == ["first", "second isn't here", "third"]
    assert pages.content("<head><title>T</title><p>no end of head") == ["no end of head"] and pages.content("x <b y") == ["x <b y"]


@pytest.mark.parametrize("piece", ['<a b="', "<p class='", "<a <b ", "<!--", "<script>", "<b></p>", "<b><div></div>", "<h1><p></p>", "<svg>", "<div>x"])
def test_reading_is_linear(piece):
    sizes = []
    for n in (20_000, 200_000):
        began = time.process_time()
        pages.content(piece * (n // len(piece)) + piece[:3] * 3)
        sizes.append(time.process_time() - began)
    assert sizes[1] < max(2.0, 40 * sizes[0])


def test_deep_nesting_keeps_its_text():
    assert len(pages.content("<div>x" * 3000)) >= 2800


def test_html_query(spark, sf):
    html = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in QUERIES["op10_html_text"](spark, sf).collect():
        inner = re.search(r"<article>(.*?)</article>", html[r.page_id], re.S)[1]
        parts = [re.sub(r"\s+", " ", unescape(re.sub(r"<[^>]*>", lambda m: " " if m[0] == "<br>" else "", p))).strip() for p in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(p for p in parts if p) and r.n_chars == len(r.text)
    frame = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, PAGE * 200, "z")], "page_id long, html string, text string")
    out = {r.page_id: r.text for r in pages.extract(frame).collect()}
    assert out[1] == out[2] == "" and out[3].count("Title & more") == 200
    assert pages.extract(frame.where("page_id > 9")).count() == 0


def test_pipeline_stages(spark, sf):
    """Every stage works on what its predecessor kept; the last one's pieces spell the last texts."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    seen = [{r.doc_id: r for r in docs.collect()}]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.cut(stage(spark, docs, sf), "test-stage")
        assert docs.columns == corpus_pipeline.COLUMNS
        seen.append({r.doc_id: r for r in docs.collect()})
    start, good, lines, unique, clean = seen
    wrong = [i for i in labels if (i in good) != bool(labels[i])]
    assert len(wrong) <= 0.03 * len(labels)
    assert lines.keys() == good.keys() and sum(len(r.text) for r in lines.values()) <= sum(len(r.text) for r in good.values())

    def shingles(t):
        w = [x.lower() for x in re.findall(r"[^\x20\x09-\x0D]+", t)]
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    sets = {i: shingles(r.text) for i, r in lines.items()}
    kept = [i for i in unique if sets[i]]
    assert all(100 * len(sets[a] & sets[b]) < 80 * len(sets[a] | sets[b]) for a in kept for b in kept if a < b)
    assert unique.keys() <= lines.keys() and clean.keys() == unique.keys()
    assert all(r.n_chars == len(r.text) for r in clean.values())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert sum(r.length for r in pieces) == sum(len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in clean.values())


def test_pipeline_on_odd_tables(spark, tmp_path):
    """Nulls, repeated rows, ties and shared doc_ids in every stage; an empty table; a scratch that is empty afterwards."""
    body = "Some words of a clean text, one after the other, with stops. And another sentence of it, as good as the first one."
    rows = [(1, body), (1, body), (5, body), (5, body.replace("clean", "plain and other") + " It goes on with more of its own words here."), (None, body), (None, None), (3, None), (4, ""), (7, body + "\nLine two of it.\n" + body), (8, "token = abcdefgh12345678")]
    kind = "doc_id long, text string, lang string, source string, n_chars long, kept string, copy int, _id int, ids int"
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", 1, 2, 3) for i, t in rows], kind)
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert out and {r.doc_id for r in out} <= {1, 3, 4, 5, 7, 8, None} and {1, 5} <= {r.doc_id for r in out}
    docs = frame.select(corpus_pipeline.COLUMNS)
    one = corpus_pipeline.minhash_stage(spark, docs, "").collect()
    assert sum(r.text == body for r in one) == 1 and [r.doc_id for r in one if r.text == body] == [1] and sum(r.doc_id == 5 for r in one) == 1
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0
    (tmp_path / "none").mkdir()
    empty.write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0

"""Inputs that once lost data or ended a query: quotes in tags, layouts, labels, clashing names, very large components; the pipeline."""

import math
import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymark.llm import covertree, hpylm, html_content, hyperminhash, toxicity
from tallymark.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pages(spark):
    return [r.html for r in table(spark, SF, "pages").orderBy("page_id").limit(60).collect()]


@pytest.fixture(scope="module")
def model(pages):
    return html_content.train(pages)


STORY = [
    "The first paragraph of the story is here, and it has some words in it. It goes on.",
    "A second paragraph follows, with another sentence. It is about as long as the first.",
    "The third one tells more of it, in as many words as it takes.",
    "At last the fourth paragraph ends the story, and all is well.",
]
SAID = "<p>I liked this story a lot, it was well told and long enough.</p><p>Me too. I read it twice and told my friends about it.</p>"
NAV, FOOT = "<nav><a href='/'>Home</a> <a href='/b'>About us</a></nav>", "<footer>All rights reserved.</footer>"


def paragraphs(*texts):
    return "".join(f"<p>{t}</p>" for t in texts)


LAYOUTS = {
    "article": f"<article><h1>T</h1>{paragraphs(*STORY)}</article>",
    "quote in a bare value": f"<article><h1>T</h1><p><a href=/o'neil></a>{STORY[0]}</p>{paragraphs(*STORY[1:3])}<p title=don't>{STORY[3]}</p></article>",
    "quote never closed": f'<article><h1>T</h1><p class="x>{STORY[0]}</p>{paragraphs(*STORY[1:])}</article>',
    "quote closed by the next": f'<article><h1>T</h1><p class="x>{STORY[0]}</p><p class="y">{STORY[1]}</p>{paragraphs(*STORY[2:])}</article>',
    "quoted end of tag": f"""<article><h1 title='a > b' x="<p>">T</h1>{paragraphs(*STORY)}</article>""",
    "quote as a name": f"<article><h1 ' \">T</h1>{paragraphs(*STORY)}</article>",
    "end in capitals with blanks": f"<ARTICLE><H1>T</H1 >{paragraphs(*STORY)}<script>var a = '</p>';</SCRIPT\n></ARTICLE>",
    "a named div": f"<div class='content'><h1>T</h1>{paragraphs(*STORY)}</div>",
    "a bare div": f"<div><h1>T</h1>{paragraphs(*STORY)}</div>",
    "body alone": f"<h1>T</h1>{paragraphs(*STORY)}",
    "section": f"<section><h1>T</h1>{paragraphs(*STORY)}</section>",
    "main": f"<main id='main'><h1>T</h1>{paragraphs(*STORY)}</main><aside class='sidebar'>{paragraphs('Popular today', 'Sign up for our newsletter and get the best of it.')}</aside>",
    "comments after": f"<article><h1>T</h1>{paragraphs(*STORY)}</article><section class='comments'><h2>Comments</h2>{SAID}</section>",
    "comments inside": f"<article><h1>T</h1>{paragraphs(*STORY)}<div id='comments'>{SAID}</div></article>",
}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_layouts(model, layout):
    page = f"<html><body>{NAV}{LAYOUTS[layout]}{FOOT}</body></html>"
    assert model.extract([page]) == ["\n\n".join(["T", *STORY])]


def test_articles_of_the_table(model, pages):
    """Every page gives what its article holds, without the advert."""
    for page, text in zip(pages, model.extract(pages), strict=True):
        marked = page.replace("<article", "<article mk='1'").replace('<div class="ad"', '<div class="ad" mk="0"')
        own = html_content.Page(marked, "mk")
        assert text == own.content([bool(x) for x in own.label])


def test_text_that_looks_like_tags(model):
    shown = lambda source: html_content.Page(source).content([True] * 99)
    assert shown("a < b, 1<2 and <3") == "a < b, 1<2 and <3"
    assert shown("x<!-- <p>no</p> -->y<!doctype z>w<?php ?>v") == "xywv"
    assert shown("x<!-- never closed <p>y") == "x"
    assert shown("<p>one<br>two<p>three") == "one two\n\nthree"
    assert shown("x <a href='y") == "x <a href='y"
    assert shown("") == "" and shown("<") == "<" and shown("</") == "</"


@pytest.mark.parametrize("hostile", ["<a '", '<a x="', "<a x='>", "<b>", "<br>x", "<", "<!", "</p", "<p><i>", "<li><b>", "<!--", "<a '>", "<script>", "&#x41;", '<a x="=">'])
def test_time_grows_with_the_page(model, hostile):
    short, long = hostile * (100_000 // len(hostile)), hostile * (1_000_000 // len(hostile))
    times = []
    for page in (short, long):
        started = time.process_time()
        model.extract([page])
        times.append(time.process_time() - started)
    assert times[1] < 40 * max(times[0], 0.05)


def test_extract_rows(spark, pages):
    rows = [(1, "u", pages[0], "x", 1), (1, "u", pages[0], "x", 1), (None, None, None, None, None), (3, "v", "", "y", 2), (4, "w", "plain", "", 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    found = sorted(html_content.extract(df).collect(), key=str)
    assert len(found) == 5 and all(r.n_chars == len(r.text) for r in found)
    assert [r.text for r in found if r.page_id in (None, 3)] == ["", ""]
    assert html_content.extract(df.where("false")).count() == 0


# --- toxicity ----------------------------------------------------------------


def test_swaps_of_odd_letters():
    assert toxicity.swapped("gİrls") == []
    assert toxicity.swapped("girlſ and Männer") != []
    assert toxicity.swapped("Women, gİrls") == ["men, gİrls", "girls, gİrls", "boys, gİrls"]


def test_held_out_labels_change_nothing(spark):
    draw = np.random.default_rng(1)
    words = ["alpha", "beta", "gamma", "delta", "omega", "scum", "awful", "women", "gİrls", "men"]
    docs = spark.createDataFrame([(i, " ".join(draw.choice(words, 8).tolist())) for i in range(400)] + [(900, "twice told"), (901, "twice told")], "doc_id long, text string")
    labels = [(i, int(i % 5 == 0)) for i in range(400)] + [(900, 1), (900, 0), (901, 0), (7, None)]
    own = F.col("doc_id") % 4 != 2
    scores = []
    for change in (False, True):
        changed = [(i, y if i % 4 != 2 or not change or y is None else 1 - y) for i, y in labels]
        frame = spark.createDataFrame(changed + ([(2, 1)] * 50 if change else []), "doc_id long, toxic int").repartition(3)
        model = toxicity.train(docs, frame, own, sample=60)
        scores.append(sorted(toxicity.score(docs, model).collect(), key=str))
    assert scores[0] == scores[1] and len(scores[0]) == 402


# --- near duplicates, top-k --------------------------------------------------


def test_a_column_named_gone(spark):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text, True, 1), (2, text + " end", False, 2), (3, None, None, 3)], "doc_id long, text string, gone boolean, class long")
    assert sorted(r.doc_id for r in hyperminhash.one_of_each(docs).collect()) == [1, 3]


def brute_top(rows, k, is_query):
    whole = {}
    for n, (i, v) in enumerate(rows):
        if i is not None and v and all(c is not None and math.isfinite(c) for c in v):
            whole[n] = (i, [math.floor(64 * np.float64(c)) for c in v])
    lists = []
    for q in {(i, tuple(v)) for i, v in whole.values() if is_query(i)}:
        best = sorted((-sum(a * b for a, b in zip(q[1], v, strict=True)), i) for i, v in whole.values() if i != q[0] and len(v) == len(q[1]))[:k]
        lists.append((q[0], [(i, -s if abs(s) < 2**63 - 1 else None) for s, i in best]))
    return sorted(lists, key=str)


def lists_of(found):
    return [(r.query_id, r.rank, r.vec_id, r.score) for r in found.collect()]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_top_k_against_all_pairs(spark, kind):
    draw = np.random.default_rng(4)
    rows = [(i, [float(c) for c in np.float32(draw.normal(size=5))]) for i in range(230)]
    rows += [(i, [0.5] * 5) for i in range(300, 340)]  # ties
    rows += [(400, [1e20, 1.0, 0.0, 0.0, -1.0]), (420, [-1e20, 2.0, 1.0, 0.0, 0.0]), (401, [3e38, 1.0, 1.0, 1.0, 1.0]), (402, [2e9, -2e9, 1.0, 0.0, 0.0])]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in rows]
    rows += [(500, None), (501, []), (502, [1.0, None, 0.0, 0.0, 0.0]), (503, [float("nan")] * 5), (504, [float("inf")] * 5), (540, [1.0, 2.0]), (541, [3.0, 1.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, rank int, which string").repartition(3)
    got = lists_of(covertree.top_k(df, F.col("vec_id") % 20 == 0, k=7))
    want = [(q, n, i, s) for q, best in brute_top(rows, 7, lambda i: i % 20 == 0) for n, (i, s) in enumerate(best, 1)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert covertree.top_k(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("spread", [0.05, 1.0, 30.0])
def test_top_k_over_many_cells(spark, monkeypatch, spread):
    """Clusters in small cells: the same lists as over all pairs, and cells that are not worth it are not sent."""
    monkeypatch.setattr(covertree, "DATA_BLOCK", 40)
    monkeypatch.setattr(covertree, "QUERY_BLOCK", 10)
    monkeypatch.setattr(covertree, "LEAF", 8)
    draw = np.random.default_rng(5)
    middles = draw.normal(size=(12, 8)) * 10
    rows = [(i, [float(np.float32(c)) for c in middles[i % 12] + spread * draw.normal(size=8)]) for i in range(700)]
    rows += [(i, [1.0, 2.0]) for i in range(700, 730)] + [(800, [1e20] + [0.0] * 7), (820, [-1e20] + [1.0] * 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    seen, planned = [], covertree.other_pairs

    def counted(queries, data, met, bar):
        pairs = planned(queries, data, met, bar)
        every = sum(m * n for q, m in queries.size.items() for x, n in data.size.items() if q[0] == x[0])
        seen.append(sum(queries.size[q] * data.size[x] for some in (pairs, met) for q, cells in some.items() for x in cells) / every)
        return pairs

    monkeypatch.setattr(covertree, "other_pairs", counted)
    got = lists_of(covertree.top_k(df, F.col("vec_id") % 20 == 0, k=6))
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in rows]
    want = [(q, n, i, s) for q, best in brute_top(rows, 6, lambda i: i % 20 == 0) for n, (i, s) in enumerate(best, 1)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert seen[0] <= 1 and (spread > 0.1 or seen[0] < 0.35)


def test_top_k_of_repeated_ids(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [2.0, 1.0]), (1, [1.0, 3.0]), (2, [5.0, 5.0])]
    found = covertree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") == 0, k=2)
    assert sorted((r.rank, r.vec_id, r.score) for r in found.collect()) == sorted([(1, 2, 20480), (2, 1, 8192), (1, 2, 20480), (2, 1, 12288)])


def test_a_query_looks_only_at_rows_that_reach_its_kth_score(monkeypatch):
    """Every block gave each query k rows, sorted, whatever it had found before."""
    rng = np.random.default_rng(3)
    x = np.floor(rng.normal(0, 20, (3000, 16)))
    x[1000:1400] = x[7]
    q, names = x[:60], rng.permutation(3000)
    scores = q @ x.T
    scores[np.arange(60)[:, None] == np.arange(3000)[None]] = -np.inf
    want = [sorted(zip(-s, names, strict=True))[:20] for s in scores]
    floor = np.array([-w[9][0] for w in want])  # ten rows elsewhere could be better than those from the tenth on
    for held in (1 << 20, 500):
        monkeypatch.setattr(covertree, "HELD", held)
        got, ids = covertree.dual_tree(q, names[:60], x, names, 20)
        assert [list(zip(-g, i, strict=True)) for g, i in zip(got, ids, strict=True)] == want
        got, ids = covertree.dual_tree(q, names[:60], x, names, 20, floor)
        for w, f, g, i in zip(want, floor, got, ids, strict=True):
            assert [(-s, n) for s, n in zip(g, i, strict=True) if n != covertree.NOBODY] == [p for p in w if -p[0] >= f]


def test_pairs_met_once_take_no_part_in_sweeps(spark):
    """All pairs were joined, seated and written in every sweep; 8 of 10 million were met once and sit at one table."""
    rng = np.random.default_rng(5)
    n = np.minimum(rng.zipf(1.5, 600), 500)
    rows = [(int(c), int(w), int(m)) for c, w, m in zip(rng.integers(0, 20, 600), range(600), n, strict=True)]
    rows = [(c, w % 40, m) for c, w, m in rows]
    counts = spark.createDataFrame(rows, "context long, word long, customers long").groupBy("context", "word").agg(F.sum("customers").alias("customers"))
    counts = hpylm.written(counts)
    model = hpylm.sampled(counts)
    seated = {(r.context, r.word): r for r in model.pairs.collect()}
    every = {(r.context, r.word): r.customers for r in counts.collect()}
    assert seated and {p for p, m in every.items() if m > 1} == seated.keys()
    assert {(r.context, r.word) for r in model.once.collect()} == every.keys() - seated.keys() != set()
    assert all(1 <= r[t] <= r.customers for r in seated.values() for t in hpylm._TABLES)
    for key, sums, at in (("word", model.words, 1), ("context", model.contexts, 0)):
        for r in hpylm.with_extra(sums, model.pairs, key, *hpylm._TABLES).collect():
            own = [p for p in every if p[at] == r[key]]
            assert r.customers == sum(every[p] for p in own)
            assert [r[t] for t in hpylm._TABLES] == [sum(seated[p][t] if p in seated else 1 for p in own) for t in hpylm._TABLES]


def _texts(n, seed=11):
    rng = np.random.default_rng(seed)
    texts = [" ".join(f"W{w}" for w in np.minimum(rng.zipf(1.4, rng.integers(0, 60)), 200)) for _ in range(n)]
    return [(i, t if i % 17 else None) for i, t in enumerate(texts)]


def test_packed_numbers():
    """Keys and counts were shuffled as rows, 16 bytes and more for each pair of a block."""
    rng = np.random.default_rng(2)
    for x in (np.empty(0, np.uint64), np.array([2**64 - 1], np.uint64), np.sort(rng.integers(0, 2**64, 100_000, dtype=np.uint64))):
        assert (hpylm._ascended(hpylm._ascending(x)) == x).all() and (hpylm.unpacked(hpylm.packed(x), np.uint64) == x).all()
    assert len(hpylm._ascending(x)) < 6.7 * len(x)


def test_language_model_counts_pairs_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(hpylm, "BLOCK_BYTES", 1000)
    rows = _texts(150)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    blocks = hpylm.kept(hpylm.blocks_of(df.select("doc_id", (F.col("doc_id") % 5 != 1).alias("learn"), F.coalesce("text", F.lit("")).alias("text"))))
    assert blocks.count() > 3 and sorted(d for b in blocks.collect() for d in b.docs) == [i for i, _ in rows]
    every = {}
    for i, text in rows:
        word, context, _ = hpylm.tokens([(text or "").encode()])
        for pair in zip(context.view(np.int64).tolist(), word.view(np.int64).tolist(), strict=True) if i % 5 != 1 else ():
            every[pair] = every.get(pair, 0) + 1
    found = hpylm.counted(blocks, 7).collect()
    pairs = [(r.context, r.word, r.customers) for r in found if r.of == "pair"]
    assert sorted(pairs) == sorted((*p, n) for p, n in every.items() if n > 1)
    for of, at in (("context", 0), ("word", 1)):
        sums, want = {}, {}
        for key, n, m in [(r[of], r.customers, r.pairs) for r in found if r.of == of]:
            sums[key] = tuple(np.add(sums.get(key, (0, 0)), (n, m)))
        for pair, n in every.items():
            want[pair[at]] = tuple(np.add(want.get(pair[at], (0, 0)), (n, 1)))
        assert sums == want


@pytest.mark.parametrize("learn", ["doc_id % 5 != 1", "false", "cast(null as boolean)"])
def test_language_model_is_the_same_for_any_blocks(spark, monkeypatch, learn):
    rows = [*_texts(120), (3, "once more"), (3, "once more"), (None, "W1 W2")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = lambda: sorted(map(repr, hpylm.score(df, F.expr(learn)).collect()))
    whole = got()
    monkeypatch.setattr(hpylm, "BLOCK_BYTES", 1500)
    monkeypatch.setattr(hpylm, "BUCKET_BYTES", 900)
    assert got() == whole and len(whole) == len(rows)


def test_language_model_keeps_only_tables_that_are_still_read(spark, monkeypatch):
    """Every sweep left its tables and shuffle files: 0.72 GB on 0.10 GB when the check stopped it."""
    made = []
    monkeypatch.setattr(hpylm, "written", lambda df, f=hpylm.written: made.append(f(df)) or made[-1])
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    found = hpylm.score(spark.createDataFrame(_texts(40), "doc_id long, text string"), F.col("doc_id") % 5 != 1)
    folders = {f.removeprefix("file:").rpartition("/")[0] for t in made for f in t.inputFiles()}
    assert len(made) > 10 and sum(os.path.exists("/" + f.lstrip("/")) for f in folders) == 3  # blocks and what they are told
    assert found.count() == 40 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == before

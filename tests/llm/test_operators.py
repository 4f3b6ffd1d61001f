"""The operators on rows with nulls, blanks, ties, repeats and clashing columns, against brute force."""

import hashlib
import random
import re

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tallymark.llm import byte_bpe, covertree, exact_dedup, hpylm, html_content, hyperminhash, licenses, mixing, quality, toxicity
from tallymark.llm.common import table

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double, labels string"


def words(n, seed=0):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdeé", k=draw.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    base = words(120)
    texts = [None, "", " \n\t", "a b", "a  b", "A b", base, base, base.replace("a", "b", 2), base + " end", words(3000, 1), "x" * 20000, "日本 ñandú 12\x00", "GNU General Public License gnu general public license", "idiot you idiot"]
    rows = [(i, t, "en", ["s", "t", None][i % 3], None, None, None, None) for i, t in enumerate(texts)]
    rows += [rows[6], (None, base, None, "s", 1, True, 0.5, "x"), (None, None, None, None, None, None, None, None)]
    table(spark, "/root/testdata/sf0.001", "documents")  # tells workers where the package lies
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def test_exact_dedup(docs, none):
    rows = exact_dedup.exact_dedup(docs).collect()
    source = docs.select("doc_id", "text").collect()
    assert len(rows) == len(source)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    for s in source:
        same = [x for x in source if norm(x.text) == norm(s.text)]
        best = min(same, key=lambda x: (-len(x.text or ""), x.doc_id is None, x.doc_id or 0))
        if s.doc_id is not None:
            assert (by_id[s.doc_id].keep_id, by_id[s.doc_id].group_size) == (best.doc_id, len(same))
            assert by_id[s.doc_id].text_sha256 == hashlib.sha256(norm(s.text).encode()).hexdigest()
    left = exact_dedup.without_copies(docs)
    assert left.columns == docs.columns
    assert sorted(norm(r.text) for r in left.collect()) == sorted({norm(s.text) for s in source})
    assert exact_dedup.exact_dedup(none).count() == 0


def test_byte_bpe_is_what_the_library_gives(docs, none):
    tokens = byte_bpe.read_ranks(PATH)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    for r in docs.join(byte_bpe.encode(docs, PATH, public_tokenizers.PATTERN), "doc_id").select("text", "ids").collect():
        assert r.ids in ([], own.encode_ordinary(r.text or "")) or r.text is None
    trip = byte_bpe.round_trip(docs, PATH, public_tokenizers.PATTERN)
    assert sorted(map(str, trip.collect())) == sorted(map(str, docs.collect()))
    assert byte_bpe.digests(none, PATH, public_tokenizers.PATTERN).count() == 0


def test_perfect_hash_is_minimal():
    keys = [str(i).encode() for i in range(2000)]
    perfect = byte_bpe.PerfectHash(keys)
    assert perfect.lookup(keys).tolist() == list(range(2000))
    assert sorted(perfect.key_at.tolist()) == list(range(2000))


def brute_components(rows, k, percent):
    sets = {}
    for i, text in rows:
        w = [x for x in re.split(r"[ \t\n\x0b\f\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    name = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if sets[a] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    name[a] = name[b] = min(name[a], name[b])
    return name, {i: len(s) for i, s in sets.items()}


def test_near_duplicates(docs, none):
    known = docs.where("doc_id is not null")
    name, size = brute_components([(r.doc_id, r.text) for r in known.collect()], 4, 80)
    for r in hyperminhash.near_duplicates(known, 4, 80).collect():
        assert (r.component_id, r.n_shingles) == (name[r.doc_id], size[r.doc_id])
    assert hyperminhash.near_duplicates(docs, 4).count() == docs.count()
    assert hyperminhash.near_duplicates(none, 4).count() == 0
    assert hyperminhash.one_of_each(docs).columns == docs.columns


def test_mixing(docs, none):
    assert mixing.allocate([10, 100, 1], [1, 2, 3]) == pytest.approx([30.0, 78.0, 3.0])
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count() and all(0 <= r.taken <= 3 * r.size for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs).collect()))
    assert mixing.mix(none).count() == 0 and mixing.mixed_rows(docs).columns == docs.columns


def test_licenses(docs, none):
    assert len(licenses.RULES) > 300
    row = licenses.scan(docs).where("doc_id = 13").first()
    assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == (8, 2, 0, 4, "gpl")
    assert licenses.scanned(b"Licensed under CC BY-NC 4.0.")[4:6] == ("cc-by", "cc-by,cc-by-nc-4.0")
    assert licenses.scanned(b"") == (0, 0, None, None, "", "", 0.0)
    assert licenses.scan(none).count() == 0


def example(parsed):
    """A short text that a parsed regular expression matches."""
    out = ""
    for kind, value in parsed:
        match str(kind):
            case "LITERAL":
                out += chr(value)
            case "IN":
                out += chr(value[0][1] if str(value[0][0]) == "LITERAL" else value[0][1][0])
            case "ANY":
                out += "x"
            case "BRANCH":
                out += example(value[1][0])
            case "SUBPATTERN":
                out += example(value[3])
            case "MAX_REPEAT" | "MIN_REPEAT":
                out += example(value[2]) * value[0]
            case "ASSERT":
                pass
            case _:
                raise ValueError(kind)
    return out


def test_license_keywords_hide_no_rule(monkeypatch):
    texts = [example(re._parser.parse(signature.pattern.decode())).encode() for *_, signature in licenses.RULES]
    texts += [b"Available under Creative Commons Attribution 4.0 International", b"Source: MPL 2.0", b"Creative Commons Zero", b"Confidential and proprietary."]
    gated = [licenses.scanned(t) for t in texts]
    monkeypatch.setattr(licenses, "ANCHORS", (b"",))
    monkeypatch.setattr(licenses, "RULES", [(p, label, b"", signature) for p, label, _, signature in licenses.RULES])
    assert gated == [licenses.scanned(t) for t in texts]
    assert all(row[5] and row[6] > 0 for row in gated)


def test_toxicity_ignores_mentions(docs, none, spark):
    draw = random.Random(1)
    plain = [words(12, i) for i in range(200)]
    bad = [p + " awful scum" + (" women" if draw.random() < 0.7 else "") for p in plain[:80]]
    model = toxicity.Model(plain + bad, [0] * 200 + [1] * 80)
    told = model.scores([t.encode() for t in ("they are awful scum " + words(5, 3), words(9, 4), words(9, 4) + " women", words(9, 4) + " men", "")])
    assert told[0] >= toxicity.CUT > max(told[1], told[2], told[3]) and abs(told[2] - told[3]) < 0.2
    labels = spark.createDataFrame([(14, 1), (3, 0), (5, 0), (6, None)], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.train(docs, labels, F.lit(True))).count() == docs.count()
    assert toxicity.score(none, toxicity.train(none, labels, F.lit(True))).count() == 0


def test_cover_tree(spark):
    draw = random.Random(2)
    rows = [(i, [draw.choice([0.5, -0.25, 1.0, 0.1]) for _ in range(4)]) for i in range(300)]
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0]), (302, [float("nan")] * 4), (303, []), (304, [9.0] * 4), (305, [9.0] * 4)]
    found = covertree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0, k=5)
    import math

    whole = {i: [math.floor(64 * x) for x in v] for i, v in rows[:300] + rows[304:]}
    whole = {i: [math.floor(64 * (0.10000000149011612 if x == 0.1 else x)) for x in dict(rows)[i]] for i in whole}
    for q in (i for i in whole if i % 20 == 0):
        best = sorted((-sum(a * b for a, b in zip(whole[q], whole[i], strict=True)), i) for i in whole if i != q)[:5]
        assert [(r.vec_id, -r.score) for r in found.where(F.col("query_id") == q).orderBy("rank").collect()] == [(i, s) for s, i in best]
        break


def test_language_model(docs, none):
    rows = hpylm.score(docs, F.col("doc_id") != 7).collect()
    assert len(rows) == docs.where("doc_id is not null").count() or len(rows) == docs.count()
    assert all(r.n_tokens >= 1 and r.score < 0 and r.n_known <= r.n_tokens for r in rows)
    assert hpylm.score(none, F.lit(True)).count() == 0


def test_language_model_knows_the_word_before(spark):
    texts = ["qa xa ya za"] * 40 + ["qa xa ya za", "qa ya xa za"]  # all words end alike
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    own = {r.doc_id: r for r in hpylm.score(rows, F.col("doc_id") < 40).collect()}
    assert own[40].base_score == pytest.approx(own[41].base_score)
    assert own[40].score > own[41].score + 0.5
    assert (own[40].train_tokens, own[40].n_known, own[40].n_tokens) == (200, 5, 5)


def test_html(spark):
    model = html_content.train([])
    page = html_content.layouts(["A title", "First long paragraph of the story, which goes on for some time.", "Fish &amp; chips."], 7)
    text = model.extract([page, "", "<p>unclosed", "<!-- x"])
    assert "First long paragraph" in text[0] and "newsletter" not in text[0] and text[1] == ""


def test_language_model_is_the_same_in_any_layout(spark):
    rows = [(i, words(40, i % 50)) for i in range(120)]
    one, other = (spark.createDataFrame(x, "doc_id long, text string").repartition(n) for x, n in ((rows, 1), (rows[::-1], 7)))
    assert sorted(hpylm.score(one, F.col("doc_id") % 5 != 1).collect()) == sorted(hpylm.score(other, F.col("doc_id") % 5 != 1).collect())


@pytest.mark.parametrize("icon", ['<svg class="i"/>', "<svg/>", '<svg class="i"><path d="M0 0"/><title/><g><svg/></g></svg>', '<svg class="i"><path d="M0 0">', "<svg class=i/>"])
def test_html_goes_on_after_a_drawing(icon):
    model = html_content.train([])
    first, last = "First long paragraph of the story, which goes on for some time.", "Fish and chips were had by all of them."
    page = html_content.layouts(["A title", first, last], 7)
    head, foot = page.replace("<body>", f"<body><header>{icon}</header>"), page.replace(f"<p>{last}", f"<p>{icon}</p><p>{last}")
    assert page not in (head, foot)
    for text in model.extract([page, head, foot]):
        assert first in text and last in text and "newsletter" not in text


def test_html_takes_no_labels_from_pages():
    page = html_content.layouts(["A title", "First long paragraph of the story, which goes on for some time."], 7)
    chart = page.replace("<body>", "<body><div x-label='Year'></div><div data-x-label=\"7\"></div>")
    model = html_content.train([])
    assert model.extract([chart]) == model.extract([page]) and "First long" in model.extract([page])[0]
    story = "<html><body><nav x-label='1'>Home</nav><article><h1>A title</h1><p>A story of some length, told in a sentence.</p></article></body></html>"
    own, plain = html_content.train([story]), html_content.train([story.replace(" x-label='1'", "")])
    assert own.slots == plain.slots and (own.weights == plain.weights).all()


def test_quality(docs, none):
    rows = quality.judged(docs)
    assert rows.count() == docs.count() and quality.judged(none).count() == 0
    junk = " ".join(f"{w}***" for w in words(60, 5).split())
    assert (quality.votes([junk.encode()]) == quality.JUNK).sum() >= 2
    assert (quality.votes([b""]) == quality.ABSTAIN).all()

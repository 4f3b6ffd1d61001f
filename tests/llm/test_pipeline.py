"""The pipeline stage by stage, and results of single operators, against plain Python."""

import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tallymark.llm import byte_bpe, exact_dedup, hyperminhash, licenses, mixing, quality
from tallymark.llm.common import table

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, gone boolean, id long, keep_id long"


def prose(seed, n=80):
    draw = random.Random(seed)
    out = ["".join(draw.choices("abcdefghijklmnoprstuw", k=draw.randint(2, 9))) for _ in range(n)]
    return " ".join(w.capitalize() + "." if i % 9 == 8 else w for i, w in enumerate(out))


@pytest.fixture(scope="module")
def rows():
    found = [(i, prose(i), "en", f"s{i % 4}") for i in range(60)]
    found += [(100 + i, prose(i), "en", "s0") for i in range(20)]  # copies
    found += [(200 + i, prose(i) + " One more end.", "en", "s1") for i in range(15)]  # near copies
    found += [(300 + i, prose(i).replace(" ", "\n"), "en", None) for i in range(5)]  # copies but for white space
    found += [(400 + i, "*** $$$ @@@ ### " * 40 + str(i), "xx", "s2") for i in range(5)]  # junk
    found += [(500, None, None, None), (501, "", "en", "s3"), (502, " \n", "en", "s3"), (503, "short text", "en", "s3"), (504, "é日本 " * 3000, "ja", "s3")]
    found += [found[0], (None, prose(3), None, "s0"), (None, None, None, None)]
    return [(*r, len(r[1] or ""), True, 7, 8) for r in found]


@pytest.fixture(scope="module")
def docs(spark, rows):
    table(spark, "/root/testdata/sf0.001", "documents")
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def run_stage(spark, name, docs):
    stage = dict(corpus_pipeline.STAGES)[name]
    return stage(spark, docs, "")


def bare(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "encoding"]


def test_quality_stage(spark, docs):
    scorer = quality.train(docs)
    want = Counter(str(r) for r in docs.collect() if scorer.junk([(r.text or "").encode()])[0] < quality.JUNK_FROM)
    kept = run_stage(spark, "quality", docs)
    assert kept.columns == docs.columns and Counter(map(str, kept.collect())) == want
    ids = {r.doc_id for r in kept.collect()}
    assert ids >= set(range(60)) and not ids & {400, 401, 402, 403, 404}


def test_exact_dedup_stage(spark, docs, rows):
    left = run_stage(spark, "exact_dedup", docs)
    assert left.columns == docs.columns
    best = {}
    for r in rows:
        key = (-len(r[1] or ""), r[0] is None, r[0] or 0)
        best[bare(r[1])] = min(best.get(bare(r[1]), (key, r)), (key, r), key=lambda x: x[0])
    assert Counter(tuple(r) for r in left.collect()) == Counter(r for _, r in best.values())
    assert run_stage(spark, "exact_dedup", docs.where("false")).count() == 0


def test_exact_dedup_keeps_one_of_equal_rows(spark):
    rows = [(1, "a b"), (1, "ab "), (1, "a b"), (2, "ab"), (None, "x"), (None, "x"), (3, "y"), (3, "z"), (4, None), (5, "")]
    left = exact_dedup.without_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r.doc_id or 0, bare(r.text)) for r in left) == [(0, "x"), (1, "ab"), (3, "y"), (3, "z"), (4, "")]


def sets_of(text, k):
    w = [x for x in re.split(r"[ \t\n\x0b\f\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(rows, k):
    sets, name = {i: sets_of(t, k) for i, t in rows}, {i: i for i, _ in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            name[a] = name[b] = min(name[a], name[b])
    return name


def test_near_dedup_stage(spark, docs):
    known = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    name = components([(r.doc_id, r.text) for r in known.collect()], 5)
    left = run_stage(spark, "near_dedup", known)
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i in name if name[i] == i)


def test_a_chain_inside_one_family(spark):
    """Each text is alike to the next only; links go from one end of the chain to the other."""
    words = [f"w{i}" for i in range(240)]
    chain = [(i, " ".join(words[3 * i : 3 * i + 60])) for i in range(40)]
    apart = [(100 + i, " ".join(f"x{i}_{j}" for j in range(60))) for i in range(10)]
    rows = chain + apart + [(200 + i, t) for i, t in chain[::3]]
    name = components(rows, 4)
    assert len({name[i] for i, _ in chain}) == 1
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for exact in (False, True):
        found = hyperminhash.near_duplicates(df, 4, 80, exact=exact).collect()
        assert {r.doc_id: r.component_id for r in found} == name


def test_exact_links(spark, docs):
    known = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    for words, percent in ((4, 80), (1, 50), (2, 100)):
        sets = {r.doc_id: sets_of(r.text, words) for r in known.collect()}
        name = {i: i for i in sets}
        links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
        for _ in sets:
            for a, b in links:
                name[a] = name[b] = min(name[a], name[b])
        found = hyperminhash.near_duplicates(known, words, percent, exact=True).collect()
        assert {r.doc_id: r.component_id for r in found} == name


def test_mixing_stage(spark, docs, rows):
    decided = mixing.mix(docs).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter(r.size for r in decided) == Counter(size(r[1]) for r in rows)
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + size(r[1])
    names = sorted(sizes, key=lambda n: (n is None, n or ""))
    targets = dict(zip(names, mixing.allocate([sizes[n] for n in names], [(1, 2, 3)[i % 3] for i in range(len(names))]), strict=True))
    by_id = {r[0]: r[3] for r in rows}
    taken = Counter()
    for r in decided:
        n = by_id[r.doc_id] if r.doc_id is not None else ("s0" if r.size else None)
        assert (r.source_size, r.taken <= 3 * r.size) == (sizes[n], True) and r.target == pytest.approx(targets[n])
        assert r.size == 0 or r.taken % r.size == 0
        taken[n] += r.taken
    largest = {n: max(size(r[1]) for r in rows if r[3] == n) for n in names}
    for n in names:
        assert abs(taken[n] - targets[n]) <= largest[n], n  # less than one more document
    mixed = Counter(map(str, run_stage(spark, "mixing", docs).collect()))
    assert sum(mixed.values()) == sum(r.taken // r.size if r.size else 1 for r in decided)


def test_inclusion():
    words = {1: 10, 3: 100, 6: 1000, 10: 5000}
    for room in (1, 100, 3000, 6000, 6110):
        p = mixing.inclusion(words, room)
        assert sum(p[b] * n for b, n in words.items()) == pytest.approx(room) and 0 <= min(p) and max(p) <= 1
        assert p[1] <= p[3] <= p[6] <= p[10]
    p = mixing.inclusion(words, 100)
    assert p[10] / p[6] == pytest.approx(4) and mixing.inclusion({}, 5) == [0.0] and mixing.inclusion({3: 5}, 0) == [0.0] * 4


def test_inclusion_is_unequal(spark):
    """Over many sources of the same texts, long ones are taken more often, as their probabilities say."""
    texts = [(s, i, " ".join(["w"] * (4 if i % 2 else 64)) + f" {s} {i}") for s in range(8) for i in range(400)]
    rows = [(1000 * s + i, t, f"s{s:02}") for s, i, t in texts]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(1, 3)).where("target < source_size")
    share = {r["long"]: r["share"] for r in found.groupBy((F.col("size") > 20).alias("long")).agg(F.avg((F.col("taken") > 0).cast("int")).alias("share")).collect()}
    assert 0.45 < share[True] < 0.6 and 0.05 < share[False] < 0.3


def expected_tokens():
    tokens = byte_bpe.read_ranks(PATH)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})


def test_encoding_stage(spark, docs, rows):
    own = expected_tokens()
    want = Counter()
    for r in rows:
        ids = own.encode_ordinary(r[1] or "")
        want[r[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()] += 1
    found = run_stage(spark, "encoding", docs)
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found.collect()) == want


def test_the_whole_run(spark, docs, rows, tmp_path):
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    by_id = {r[0]: r for r in rows if r[0] is not None}
    kept = {r.doc_id for r in found if r.doc_id is not None}
    assert kept and not kept & {400, 401, 402, 403, 404} and not kept & (set(range(101, 120)) | set(range(200, 215)))
    own = expected_tokens()
    assert all(r.n_tokens == len(own.encode_ordinary(by_id[r.doc_id][1] or "")) for r in found if r.doc_id is not None)


# --- licenses ----------------------------------------------------------------


def brute_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = sorted((i, label) for phrase, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split())
    first = [i for i, _ in places]
    return len(words), len(places), min(first, default=None), max(first, default=None), ",".join(sorted({label for _, label in places}))


def test_base_places(spark):
    draw = random.Random(5)
    pieces = ["GNU General Public License", "Apache License", "apache-license", "CC BY", "cc by-sa", "MIT License", "mit", "license", "gnu general public", "é", "word", "…", "9"]
    texts = [None, "", "   ", "CC BYE", *(draw.choice([" ", "\n", "-", ", "]).join(draw.choices(pieces, k=draw.randint(1, 30))) for _ in range(300))]
    found = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in found:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_suppression_against_all_pairs():
    draw = random.Random(6)
    phrases = ["gnu general public license version 3 or any later version", "mit license", "mit x11 license", "licensed under the mpl", "mpl 2.0 license", "apache license 2.0", "all rights reserved",
               "redistribution and use in source and binary forms, with or without modification, are permitted", "cc by nc sa 4.0", "creative commons attribution share alike 3.0", "the gnu lesser general public license"]
    for _ in range(200):
        text = " ".join(draw.choices([*phrases, "x", "the", "2"], k=draw.randint(1, 25))).encode()
        folded = b" " + b" ".join(text.translate(licenses._FOLD).split()) + b" "
        found = []
        for order, (priority, label, _, signature) in enumerate(licenses.RULES):
            found += [(priority, m.start() - m.end(), m.start(), m.end(), order, label) for m in signature.finditer(folded)]
        left = []
        for _, _, low, high, _, label in sorted(found):
            if not any(a <= low and high <= b for _, a, b in left):
                left.append((label, low, high))
        assert licenses.detections(folded) == left


def test_short_names_need_a_context():
    labels = lambda text: licenses.scanned(text.encode())[5]
    assert labels("EPL fans met the ASL 2 interpreter; MPL was there") == ""
    assert labels("Source: MPL 2.0") == "mpl-2.0" and labels("Licensed under the EPL") == "epl" and labels("ASL licensed code") == "apache"
    assert len(licenses._FREE) + sum(len(names) for _, names, _ in licenses._NAMED) >= 170


# --- language model ----------------------------------------------------------


def test_base_scores(spark):
    import math
    import zlib

    from tallymark.llm import hpylm
    from tallymark.llm.common import crc_remainder

    draw = random.Random(8)
    texts = [None, "", " \n ", "A a\x00 a", "é É", *(" ".join(draw.choices(["A", "b", "cé", "d-e", "f\x85g", "H"], k=draw.randint(1, 60))) for _ in range(80))]
    rows = [(i, t, "x", 1.0) for i, t in enumerate(texts)] + [(3, texts[3], "x", 2.0)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, word string, score double").repartition(3)
    tokens = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w] + [None]
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    seen = Counter(w for i, t, *_ in rows if not held(i) for w in tokens(t))
    n, v = sum(seen.values()), len(seen)
    want = []
    for i, t, *_ in rows:
        own = tokens(t)
        base = sum(math.log10((seen[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        want.append((i, held(i), len(own), sum(seen[w] > 0 for w in own), n, round(base, 6)))
    found = hpylm.score(df, crc_remainder("doc_id", 5) != 1).collect()
    assert sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == sorted(want)
    assert all(r.score < 0 for r in found) and {r.held_out for r in found} == {True, False}

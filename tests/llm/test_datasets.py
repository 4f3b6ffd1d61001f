"""Whitening, decontamination and the Merkle manifest against plain Python, with nulls, blanks, ties, repeats and clashing columns."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.run import _sorted_rows
from tallymark.llm import decontamination, merkle, whitening
from tallymark.llm.common import table
from tallymark.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module", autouse=True)
def package(spark):
    table(spark, SF, "documents")  # tells workers where the package lies


@pytest.mark.parametrize("name", ["op12_decontamination", "op13_merkle_manifest"])
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    answer = con.execute(ORACLE[name])
    want = _sorted_rows([d[0] for d in answer.description], answer.fetchall())
    df = QUERIES[name](spark, SF)
    assert _sorted_rows(df.columns, df.collect()) == want


# --- Merkle manifest ---------------------------------------------------------


def h_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def grown(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 3])) for i in range(0, len(last), 3)])
    return levels


def path_of(levels, i):
    out = []
    for level in levels[:-1]:
        s = i // 3 * 3
        out.append(("".join(level[s:i]), "".join(level[i + 1 : s + 3])))
        i //= 3
    return out


def brute_merkle(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    order = lambda r: (r[0] is not None, r[0] or 0, h_of(r))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = [grown([h_of(r) for r in sorted(by[s], key=order)]) for s in sources]
    top = grown([t[-1][0] for t in trees])
    out = []
    for k, s in enumerate(sources):
        for i, r in enumerate(sorted(by[s], key=order)):
            path = path_of(trees[k], i) + path_of(top, k)
            text = r[4]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = h_of((*r[:4], text))
            for before, after in path:
                node = sha(before + node + after)
            out.append((r[0], trees[k][0][i], trees[k][-1][0], top[-1][0], sha("".join(b + a for b, a in path)), node, node == top[-1][0]))
    return sorted(out, key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, position long, digest string, path string"


def merkle_rows(sizes):
    draw = random.Random(1)
    rows = []
    for s, n in sizes.items():
        for i in range(n):
            text = draw.choice([None, "", "a\nb", "\n", "é\n日本", "x" * 5000 + "\n", f"t{i}"])
            rows.append((draw.choice([i, i, -i, 10 * i]), s, draw.choice([None, "en"]), draw.choice([None, 7]), text))
    rows.append((None, "s", None, None, "no\nid"))
    rows += [rows[0]] * 7
    return rows


@pytest.mark.parametrize("sizes", [{None: 5, "": 1, "a": 3, "Z": 9, "é": 28, "s": 10}, {"one": 1}, {None: 12}])
def test_merkle(spark, sizes):
    rows = merkle_rows(sizes) if len(sizes) > 1 else merkle_rows(sizes)[: max(sizes.values())]
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)
    got = merkle.verified(docs).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_merkle(rows)


def test_merkle_requests_and_records(spark):
    rows = merkle_rows({"a": 30, "b": 4, "c": 1})
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)
    manifest = merkle.build(docs.select("doc_id", "source", merkle.leaf_of(*map(F.col, merkle.COLUMNS)).alias("leaf")))
    want = {r[4] for r in brute_merkle(rows) if r[0] in (3, 20)}
    asked = spark.createDataFrame([(3,), (20,), (12345,), (3,)], "doc_id long")
    proved = merkle.proofs(manifest, asked)
    assert {r[0] for r in proved.select(F.sha2(merkle.siblings(F.col("path")), 256)).collect()} == want
    assert proved.where(merkle.folded(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0
    other = F.unhex(F.sha2(F.lit("another"), 256))
    assert proved.where(merkle.folded(other, F.col("path")) == F.col("root")).count() == 0
    store = {r.digest.hex(): [c.hex() for c in r.children] for r in manifest.store().collect()}
    assert all(sha("".join(children)) == digest for digest, children in store.items())
    # Every leaf can be reached from the root by the records alone.
    reached, todo = set(), [manifest.root]
    while todo:
        node = todo.pop()
        reached.add(node)
        todo += store.get(node, [])
    assert {r.leaf.hex() for r in manifest.leaves.collect()} <= reached


def test_merkle_of_nothing(spark):
    assert merkle.verified(spark.createDataFrame([], SCHEMA)).count() == 0


# --- decontamination ---------------------------------------------------------


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_contamination(docs, items, window):
    found = {}
    for item, text in items:
        w = words_of(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1) if n else []:
            found.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        w, hit, own = words_of(text), set(), set()
        for n in {len(x) for x in found}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in found:
                    own |= found[tuple(w[i : i + n])]
                    hit |= set(range(i, i + n))
        out.append((doc_id, len(w), len(hit), sorted(own)))
    return sorted(out, key=str)


@pytest.mark.parametrize("window,shingle", [(10, 5), (4, 2), (6, 6), (3, 5), (1, 1)])
def test_decontamination(spark, window, shingle):
    draw = random.Random(window)
    say = lambda n, of="abc": " ".join(draw.choices(of, k=n))
    long = " ".join(f"w{i}" for i in range(200))
    items = [(i, say(draw.randint(1, 25))) for i in range(30)] + [(7, long), (8, long), (8, "a b"), (None, "Ünï-CODE 9 x y z ü 1 2 3 4"), (50, None), (51, " \n-"), (52, "solo"), (53, "a a a a a a a a a a a a")]
    docs = [(i, say(draw.randint(0, 120))) for i in range(40)]
    docs += [(90, None), (91, ""), (92, long * 20), (92, long * 20), (None, "x " + long.upper() + ". y"), (93, "Solo\x00solo"), (94, "ünï code 9 x Y z ü 1,2;3\t4"), (95, "Ünï code 9 x y z ü 1 2 3 4"), (96, "a " * 3000), (97, long[5:] + " solo")]
    d = spark.createDataFrame([(*r, 1, "x", []) for r in docs], "doc_id long, text string, row long, size string, parts array<int>").repartition(3)
    b = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, passage string").repartition(2)
    got = decontamination.contamination(d, b, window, shingle).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_contamination(docs, items, window)


def test_decontamination_spans(spark):
    b = spark.createDataFrame([(1, "one two three four"), (2, "three four")], "item_id long, text string")
    d = spark.createDataFrame([(1, "zero One two, three four three four")], "doc_id long, text string")
    got = {tuple(r) for r in decontamination.spans(d, b, 3, 2).collect()}
    assert got == {(1, "1", 1, 4, "one two three"), (1, "1", 2, 5, "two three four"), (1, "2", 3, 5, "three four"), (1, "2", 5, 7, "three four")}


def test_decontamination_of_nothing(spark):
    d = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert decontamination.digests(d.where("false"), b).count() == 0
    rows = sorted(tuple(r) for r in decontamination.digests(d, b.where("false")).collect())
    assert rows == [(1, 2, 0, 0, sha(""), False), (2, 0, 0, 0, sha(""), False)]


# --- whitening ---------------------------------------------------------------


def brute_whitening(vectors):
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors], dtype=object)
    n = len(x)
    d = n * x - x.sum(axis=0)
    products = d.T.dot(d)
    v = np.array([[float(Fraction(int(p), n**3)) for p in row] for row in products])
    return d, v


@pytest.mark.parametrize("stretch", [1.0, 2.0**30, 2.0**44])
def test_whitening(spark, stretch):
    draw = np.random.default_rng(3)
    mix = draw.normal(size=(6, 6))
    vectors = (draw.normal(size=(300, 6)) @ mix * stretch).tolist()
    odd = [None, [], [1.0] * 5, [1.0, None, 0, 0, 0, 0], [float("nan")] + [0.0] * 5, [float("-inf")] + [0.0] * 5, [1e300] + [0.0] * 5]
    rows = [(i, [float(c) for c in v], 1.0) for i, v in enumerate(vectors)] + [(900 + i, v, 2.0) for i, v in enumerate(odd)]
    rows += [(5, vectors[5], 1.0), (None, vectors[6], 1.0)]
    df = spark.createDataFrame([(i, v and [c if c is None else float(c) for c in v], w) for i, v, w in rows], "vec_id long, embedding array<double>, whitened double").repartition(3)
    used = [v for i, v, _ in rows if i is None or i < 900]
    d, v = brute_whitening(used)
    model = whitening.fit(df)
    assert model.n == len(used) and (model.covariance == v).all()
    values, basis = np.linalg.eigh(v)
    assert np.allclose(model.values, values[::-1])
    got = whitening.transform(df, model).collect()
    assert len(got) == len(used)
    exact = {i: int((d[i] ** 2).sum()) for i in range(300)}
    assert all(r.deviation == (exact[r.vec_id] if exact[r.vec_id] < 10**38 else None) for r in got if r.vec_id is not None)
    expected = np.abs((d.astype(float) / len(used)) @ basis[:, ::-1] / np.sqrt(values[::-1]))
    assert all(np.allclose(np.abs(r.whitened), expected[r.vec_id], atol=1e-6) for r in got if r.vec_id is not None)
    assert whitening.identity_error(df, model) < 1e-6


def test_whitened_rows(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = whitening.whitened(vectors).collect()
    n = vectors.count()
    assert len(rows) == 32 * n and {r.n for r in rows} == {n}
    z = np.zeros((n, 32))
    place = {i: k for k, i in enumerate(sorted({r.vec_id for r in rows}))}
    for r in rows:
        z[place[r.vec_id], r.component - 1] = r.whitened
    error = np.abs(z.T @ z / n - np.eye(32)).max()
    assert error < 1e-9 and max(r.identity_error for r in rows) < 1e-9
    shares = {r.component: r.explained for r in rows}
    assert [shares[c] for c in range(1, 33)] == sorted(shares.values(), reverse=True) and 0 < sum(shares.values()) <= 1


def test_whitening_of_little(spark):
    schema = "vec_id int, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whitened(spark.createDataFrame(rows, schema)).count() == 0
    two = whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 2.0])], schema)).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation, round(abs(r.whitened), 9), r.explained) for r in two) == [(1, 1, 2, 128**2, 1.0, 1.0), (2, 1, 2, 128**2, 1.0, 1.0)]

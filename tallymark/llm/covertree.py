"""Exact top-k inner products by dual-tree search over cover trees.

Rows and queries go to cells, by the nearest of some pivots, which come from a bounded
sample; a cell is a centre with the greatest distance of its rows. Each query cell
first meets the data cell that its centre likes best, which gives every query a
kth score. Then it meets the cells whose bound (below) is not under the least of
these scores; the vectors of other cells are not sent to it, and of the rows it
meets only those not under a query's own kth score are looked at further. Cells are dealt into
blocks of bounded size, and a pair of blocks meets in one task. There both sides are
indexed by a cover tree: a node is a centre with the greatest distance of its points, and its
children are a net of its points at a smaller radius. A pair of a query node
(centre q, radius r) and a data node (centre x, radius s) is pruned when
<q,x> + |q| s + |x| r + r s, which no inner product below it can exceed, is
smaller than the worst kth score of the query node's queries. Ties are not
pruned, so the smaller vec_id wins them exactly. The k best of each block pair
are merged per query in rounds of a top-k window. The driver holds pivots and, for at
most ``CELLS`` cells a side, radius, count and kth score.

Components are scaled and floored to whole numbers; scores are exact integers.
Defined results: vectors that are null, empty, or hold a null or non-finite
component take no part, nor do those that scaling takes out of the range of a
double; a query is not its own candidate, by vec_id; rows that repeat a vec_id count
once each as candidates of others, and once as a query if their vectors are equal
(with other vectors each has a list of its own); vectors of another length than a
query's are not its candidates; an empty table gives no rows. Rows whose products
could pass 2^53 are compared by Python integers, and only they. Such scores are
ranked exactly whatever their size; one that is no long is shown as null.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import written

DATA_BLOCK, QUERY_BLOCK = 4096, 1024
#: Cells at most, and rows, chosen by hash, from which their pivots are taken.
CELLS, SAMPLE = 256, 2048
LEAF = 256
# Scores from here on are ordered by their text, in which all have the same number of hex digits.
_MOST, _SHIFT, _DIGITS = 2**63 - 1, 1 << 2200, 552
#: Found rows that a worker holds before it keeps only the best, and the id of an empty place.
HELD, NOBODY = 1 << 20, np.iinfo(np.int64).max
NET = 24
SHRINK = 1.4


class Node:
    __slots__ = ("centre", "children", "norm", "points", "radius")

    def __init__(self, x: np.ndarray, points: np.ndarray, centre: np.ndarray):
        self.centre, self.norm = centre, float(np.sqrt(centre @ centre))
        self.points, self.children = points, []
        self.radius = float(np.sqrt(max(((x[points] - centre) ** 2).sum(axis=1).max(), 0.0)))


def cover_tree(x: np.ndarray) -> Node:
    """The tree of all rows of ``x``; equal rows end up in one leaf of radius 0."""
    root, squares = Node(x, np.arange(len(x)), x.mean(axis=0)), (x * x).sum(axis=1)
    todo = [root]
    while todo:
        node = todo.pop()
        if len(node.points) <= LEAF or node.radius == 0:
            continue
        own, size = x[node.points], squares[node.points]

        def distances(i, own=own, size=size):
            return np.maximum(size - 2 * (own @ own[i]) + size[i], 0)

        # A net by farthest points, until all are within the next radius or the net is full.
        nearest = distances(0)
        member = np.zeros(len(own), dtype=np.int64)
        centres = [own[0]]
        while len(centres) < NET and nearest.max() > (node.radius / SHRINK) ** 2:
            far = int(nearest.argmax())
            distance = distances(far)
            closer = distance < nearest
            nearest, member = np.where(closer, distance, nearest), np.where(closer, len(centres), member)
            centres.append(own[far])
        if len(centres) == 1:
            far = int(nearest.argmax())
            member = (distances(far) < nearest).astype(np.int64)
            centres.append(own[far])
        for k, centre in enumerate(centres):
            points = node.points[member == k]
            if len(points):
                node.children.append(Node(x, points, centre))
        if len(node.children) < 2:
            node.children = []
        todo += node.children
    return root


def dual_tree(queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, data_ids: np.ndarray, k: int, floor: np.ndarray | None = None):
    """Scores and ids of the k best rows of ``data`` for each query; empty places have id ``NOBODY``.

    ``floor``: a score that k rows elsewhere reach, for each query; rows below are not wanted.
    """
    # The k best scores so far, the least of them first, and all that reached them: query, score and id.
    best = np.repeat((np.full(len(queries), -np.inf) if floor is None else floor)[:, None], k, axis=1)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held = 0

    def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The k best of each query among those found, ties to smaller ids, and their places."""
        row, score, name = (np.concatenate(x) for x in zip(*found, strict=True))
        at = np.flatnonzero(score >= best[row, 0])
        at = at[np.lexsort((name[at], -score[at], row[at]))]
        row, score, name = row[at], score[at], name[at]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        first = place < k
        return row[first], score[first], name[first], place[first]

    def compare(q: np.ndarray, x: np.ndarray) -> None:
        nonlocal held
        scores = queries[q] @ data[x].T
        scores[query_ids[q][:, None] == data_ids[x][None]] = -np.inf
        rows = np.flatnonzero(scores.max(axis=1) >= best[q, 0])
        if not len(rows):
            return
        q, scores = q[rows], scores[rows]
        top = scores if scores.shape[1] <= k else np.partition(scores, scores.shape[1] - k, axis=1)[:, -k:]
        all_scores = np.concatenate([best[q], top], axis=1)
        best[q] = np.partition(all_scores, all_scores.shape[1] - k, axis=1)[:, -k:]
        row, column = np.nonzero((scores >= best[q, 0][:, None]) & (scores > -np.inf))
        found.append((q[row], scores[row, column], data_ids[x[column]]))
        held += len(row)
        if held > HELD:  # many rows of one score
            found[:] = [merged()[:3]]
            held = len(found[0][0])

    def bound(a: Node, b: Node) -> float:
        return float(a.centre @ b.centre) + a.norm * b.radius + b.norm * a.radius + a.radius * b.radius

    roots = cover_tree(queries), cover_tree(data)
    stack = [(bound(*roots), *roots)]
    while stack:
        most, a, b = stack.pop()
        if most * (1 + 1e-9) + 1e-6 < best[a.points, 0].min():
            continue
        if not a.children and not b.children:
            compare(a.points, b.points)
        elif b.children and (not a.children or b.radius >= a.radius):
            stack += sorted(((bound(a, c), a, c) for c in b.children), key=lambda s: s[0])
        else:
            stack += sorted(((bound(c, b), c, b) for c in a.children), key=lambda s: s[0])
    scores, names = np.full((len(queries), k), -np.inf), np.full((len(queries), k), NOBODY)
    if found:
        row, score, name, place = merged()
        scores[row, place], names[row, place] = score, name
    return scores, names


def whole_vectors(vectors: DataFrame, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and vec: the vectors that take part, scaled and floored."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).alias("vec_id"), v.alias("v")).where("vec_id is not null and size(v) > 0")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < float("inf")))
    # Beyond 2^53 a double is a whole number, and floor would stop at the largest long.
    whole = F.transform("v", lambda x: F.when(F.abs(x * scale) < 2.0**53, F.floor(x * scale).cast("double")).otherwise(x * scale))
    return rows.where(finite).select("vec_id", whole.alias("vec"))


def _array(column, width: int) -> np.ndarray:
    """An Arrow column of vectors of one length as an array of rows."""
    import pyarrow as pa

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def pivots(rows: DataFrame, cells: int) -> dict[int, np.ndarray]:
    """Centres of cells by length of vectors: the farthest from each other of a bounded sample."""
    sample = rows.orderBy(F.xxhash64("vec_id", "vec"), "vec_id").select("vec").limit(SAMPLE).collect()
    found = {}
    for width in sorted({len(r["vec"]) for r in sample}):
        x = np.array([r["vec"] for r in sample if len(r["vec"]) == width])
        with np.errstate(over="ignore", invalid="ignore"):
            chosen, nearest = [0], ((x - x[0]) ** 2).sum(axis=1)
            while len(chosen) < min(cells, len(x)) and nearest.max() > 0:
                chosen.append(int(nearest.argmax()))
                nearest = np.minimum(nearest, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
        found[width] = x[chosen]
    return found


def in_cells(rows: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """The rows with their cell, ``width`` and number of the nearest pivot (-1 if there is none), and the distance to it."""

    def batches(stream):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in stream:
            vectors = batch.column("vec")
            widths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int32)
            cell, distance = np.full(len(vectors), -1, dtype=np.int32), np.full(len(vectors), np.inf)
            for width in set(widths.tolist()) & centres.keys():
                at = np.flatnonzero(widths == width)
                x, c = _array(vectors.take(pa.array(at)), width), centres[width]
                with np.errstate(over="ignore", invalid="ignore"):
                    best = ((c * c).sum(axis=1) - 2 * (x @ c.T)).argmin(axis=1)
                    cell[at] = best
                    distance[at] = np.sqrt(((x - c[best]) ** 2).sum(axis=1)) * (1 + 1e-9)
            columns = [*batch.columns, pa.array(widths), pa.array(cell), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "width", "cell", "distance"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(batches, f"{schema}, width int, cell int, distance double")


class Cells:
    """What the driver knows of the cells of one side: count and radius by (width, number)."""

    def __init__(self, rows: DataFrame, centres: dict[int, np.ndarray], block: int):
        found = rows.groupBy("width", "cell").agg(F.count("*").alias("n"), F.max("distance").alias("radius")).collect()
        self.size = {(r["width"], r["cell"]): r["n"] for r in found}
        self.radius = {(r["width"], r["cell"]): r["radius"] for r in found}
        self.blocks = {key: -(-n // block) for key, n in self.size.items()}
        self.centres = centres

    def centre(self, key: tuple[int, int]) -> np.ndarray | None:
        return self.centres[key[0]][key[1]] if key[1] >= 0 else None


def most_possible(queries: Cells, q: tuple[int, int], data: Cells, x: tuple[int, int]) -> float:
    """No inner product of rows of these two cells is larger."""
    a, b = queries.centre(q), data.centre(x)
    if a is None or b is None:
        return np.inf
    with np.errstate(over="ignore", invalid="ignore"):
        r, s = queries.radius[q], data.radius[x]
        bound = float(a @ b) + float(np.sqrt(a @ a)) * s + float(np.sqrt(b @ b)) * r + r * s
    return np.inf if np.isnan(bound) else bound + abs(bound) * 1e-9 + 1e-6


def first_pairs(queries: Cells, data: Cells, k: int) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """For each query cell the data cell that its centre likes best, of those with more than k rows if there are any."""
    out = {}
    for q in queries.size:
        same = [x for x in data.size if x[0] == q[0]]
        a = queries.centre(q)
        liked = [x for x in same if x[1] >= 0]
        liked = [x for x in liked if data.size[x] > k] or liked
        if same:
            out[q] = [max(liked, key=lambda x: float(a @ data.centre(x)))] if a is not None and liked else same
    return out


def other_pairs(queries: Cells, data: Cells, met: dict, bar: dict) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """The data cells that may still hold one of the k best of a query cell's queries; ``bar``: the least of their kth scores."""
    return {
        q: [x for x in data.size if x[0] == q[0] and x not in met.get(q, ()) and most_possible(queries, q, data, x) >= bar.get(q, -np.inf)]
        for q in queries.size
    }


def shared_out(rows: DataFrame, pairs: dict, other: Cells, own: Cells, salt: str) -> DataFrame:
    """The rows of one side, once for every block of the other side's cells that theirs is paired with: key and columns."""
    listed = [(*key, own.blocks[key], [(x[1], b) for x in cells for b in range(other.blocks[x])]) for key, cells in pairs.items() if cells]
    schema = "width int, cell int, blocks int, partners array<struct<cell:int,block:int>>"
    # One row for each of at most a few hundred cells.
    plan = F.broadcast(rows.sparkSession.createDataFrame(listed, schema))
    block = F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.col("blocks")).cast("int").alias("block")
    again = rows.select(*(F.col(c).alias(c) for c in rows.columns))  # the other side comes from the same rows
    return again.join(plan, ["width", "cell"]).select("*", block, F.explode("partners").alias("partner"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the k best rows of every query."""
    plain = whole_vectors(vectors, scale, id_col, vector_col)
    n = plain.count()
    centres = pivots(plain, max(1, min(CELLS, -(-n // DATA_BLOCK))))
    rows = written(in_cells(plain, centres))
    queries = rows.where(is_query).distinct().withColumn("which", F.xxhash64("vec")).withColumn("floor", F.lit(None).cast("double"))
    data_cells, query_cells = Cells(rows, centres, DATA_BLOCK), Cells(queries, centres, QUERY_BLOCK)
    met = first_pairs(query_cells, data_cells, k)
    first = written(_searched(queries, rows, met, query_cells, data_cells, k))
    # The least kth score of a query cell; none if one of its queries has no k rows yet.
    kth = first.where(F.col("rank") == k).groupBy("width", "cell").agg(F.count("*").alias("n"), F.min("score").alias("least")).collect()
    bar = {}
    for r in kth:
        key = r["width"], r["cell"]
        if r["n"] == query_cells.size[key] and r["least"] > -_MOST:  # a score beyond a long says nothing below
            bar[key] = r["least"] - abs(r["least"]) * 1e-9
    # What a query has found already; a score beyond 2^53 is no exact double.
    reached = first.where((F.col("rank") == k) & (F.abs("score") < 2**53)).select(F.col("query_id").alias("vec_id"), "which", F.col("score").cast("double").alias("floor"))
    queries = queries.drop("floor").join(reached, ["vec_id", "which"], "left")
    rest = _searched(queries, rows, other_pairs(query_cells, data_cells, met, bar), query_cells, data_cells, k)
    score = F.when(F.col("beyond").isNull(), F.col("score")).alias("score")
    return _best(first.unionByName(rest), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id", "which").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _searched(queries: DataFrame, rows: DataFrame, pairs: dict, query_cells: Cells, data_cells: Cells, k: int) -> DataFrame:
    """The k best of every query among the rows of the cells that its cell is paired with: width, cell, query_id, which, vec_id, score, beyond, rank."""
    back: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for q, cells in pairs.items():
        for x in cells:
            back.setdefault(x, []).append(q)
    key = ["width", "qc", "qb", "xc", "xb"]
    left = shared_out(queries, pairs, data_cells, query_cells, "q").select(
        "width", F.col("cell").alias("qc"), F.col("block").alias("qb"), F.col("partner.cell").alias("xc"), F.col("partner.block").alias("xb"), "vec_id", "which", "floor", "vec"
    ).toDF(*key, "vec_id", "which", "floor", "vec")
    right = shared_out(rows, back, query_cells, data_cells, "x").select(
        "width", F.col("partner.cell").alias("qc"), F.col("partner.block").alias("qb"), F.col("cell").alias("xc"), F.col("block").alias("xb"), "vec_id", "vec"
    ).toDF(*key, "vec_id", "vec")

    def met(a, b):
        import pyarrow as pa

        kinds = {"width": pa.int32(), "cell": pa.int32(), "query_id": pa.int64(), "which": pa.int64(), "vec_id": pa.int64(), "score": pa.int64(), "beyond": pa.string()}
        found: dict[str, list] = {name: [] for name in kinds}
        if a.num_rows and b.num_rows:
            width = a.column("width")[0].as_py()
            (qi, q), (xi, x) = ((t.column("vec_id").to_numpy(), _array(t.column("vec"), width)) for t in (a, b))
            which, floor = a.column("which").to_numpy(), a.column("floor").fill_null(-np.inf).to_numpy()

            def keep(rows: np.ndarray, best: np.ndarray, names: np.ndarray) -> None:
                at = np.flatnonzero(rows)
                row, place = np.nonzero(names != NOBODY)
                found["query_id"] += qi[at][row].tolist()
                found["which"] += which[at][row].tolist()
                found["vec_id"] += names[row, place].tolist()
                if best.dtype == np.float64:  # below 2^53
                    found["score"] += best[row, place].astype(np.int64).tolist()
                    found["beyond"] += [None] * len(row)
                    return
                for score in best[row, place].tolist():
                    score = int(score)
                    found["score"].append(max(-_MOST, min(_MOST, score)))
                    found["beyond"].append(None if abs(score) < _MOST else f"{score + _SHIFT:0{_DIGITS}x}")

            # Rows that are small enough for exact products of doubles, on both sides, and the rest.
            limit = np.floor(np.sqrt(2.0**53 / q.shape[1]))
            plain_q, plain_x = np.abs(q).max(axis=1) < limit, np.abs(x).max(axis=1) < limit
            if plain_q.any() and plain_x.any():
                keep(plain_q, *dual_tree(q[plain_q], qi[plain_q], x[plain_x], xi[plain_x], k, floor[plain_q]))
            for some_q, some_x in ((plain_q, ~plain_x), (~plain_q, np.ones(len(x), dtype=bool))):
                if some_q.any() and some_x.any():
                    keep(some_q, *_by_integers(q[some_q], qi[some_q], x[some_x], xi[some_x], k))
            found["width"] = [q.shape[1]] * len(found["score"])
            found["cell"] = [a.column("qc")[0].as_py()] * len(found["score"])
        return pa.table({c: pa.array(v, kinds[c]) for c, v in found.items()})

    schema = "width int, cell int, query_id long, which long, vec_id long, score long, beyond string"
    return _best(left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(met, schema), k)


def _by_integers(q: np.ndarray, query_ids: np.ndarray, x: np.ndarray, data_ids: np.ndarray, k: int):
    """As dual_tree, for components whose products need more than 53 bits."""
    left, right = [[int(c) for c in v] for v in q], [[int(c) for c in v] for v in x]
    best, names = np.full((len(q), k), 0, dtype=object), np.full((len(q), k), NOBODY)
    for i, a in enumerate(left):
        scores = sorted((-sum(map(int.__mul__, a, b)), int(n)) for b, n in zip(right, data_ids, strict=True) if n != query_ids[i])[:k]
        for j, (s, n) in enumerate(scores):
            best[i, j], names[i, j] = -s, n
    return best, names

"""Near-duplicate vectors by dual traversal of cover trees.

Vectors are unit points; a cosine of c is a distance of sqrt(2 - 2 c). The points of a label are dealt to cells around pivots, cells to
parts of at most ``PART`` points, and each part becomes a cover tree: nested levels, radii halved from one to the next. Two
parts, and in a task two nodes of their trees, are left alone if the distance of their centres is more than the sum of their covering
radii and the search distance; all that is left is compared exactly, in double precision. Where halving the radius no longer groups points, the tree ends.

Equal vectors are one point with a multiplicity. A pair of parts gives a count per point and a spanning forest of its links, never
the pairs themselves, so groups of copies cost no more than their points. Pivots are up to ``PIVOTS`` points per label, those with the least
hash; they decide which parts exist, not what is found: nothing is missed.

Null labels, null or zero vectors, and vectors with null, infinite or NaN components link with nothing; nor do vectors of different length. Rows that
repeat a vec_id count as vectors each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mercato.llm.links import components
from mercato.llm.tables import lookup
from mercato.sources.tables import stage

LEAST = 0.93
PIVOTS = 16
PART = 2_048
LEAF = 32
#: A node is not split further if this many children cover less than half of it.
TRIES = 16
SLACK = 1e-9


class Node:
    """A centre (row), its covering radius, and children, or members (rows) of a leaf."""

    def __init__(self, centre: int, rows: np.ndarray, far: np.ndarray, points: np.ndarray):
        self.centre, self.radius, self.rows, self.kids = centre, float(far.max(initial=0.0)), rows, []
        if len(rows) <= LEAF or self.radius < 1e-6:
            return
        left, kids = rows, []
        while len(left):
            away = np.sqrt(np.maximum(0, 2 - 2 * (points[left] @ points[left[0]])))
            near = away <= self.radius / 2
            near[0] = True
            kids.append((int(left[0]), left[near], away[near]))
            left = left[~near]
            if len(kids) == TRIES and 2 * len(left) > len(rows):
                return
        if len(kids) > 1:
            self.kids = [Node(*k, points) for k in kids]


def tree(points: np.ndarray) -> Node:
    return Node(0, np.arange(len(points)), np.sqrt(np.maximum(0, 2 - 2 * (points @ points[0]))), points)


class Links:
    """Links found so far: counts and a forest over the points of two parts."""

    def __init__(self, weights: np.ndarray):
        self.weights, self.count, self.parent = weights, np.zeros(len(weights), np.int64), np.arange(len(weights))

    def roots(self, at: np.ndarray) -> np.ndarray:
        found = self.parent[at]
        while (up := self.parent[found])[()].tolist() != found.tolist():
            found = up
        return found

    def add(self, a: np.ndarray, b: np.ndarray, linked: np.ndarray, both_ways: bool) -> None:
        """``linked``: matrix of rows a by columns b."""
        self.count[a] += linked @ self.weights[b]
        if both_ways:
            self.count[b] += linked.T @ self.weights[a]
        for k in np.flatnonzero(linked.any(1)):
            found = np.unique(self.roots(np.append(b[linked[k]], a[k])))
            self.parent[found] = found[0]


def traverse(x: Node, y: Node, points: np.ndarray, least: float, links: Links) -> None:
    """All links between two trees, or within one (x is y). Nodes hold rows of ``points``."""
    reach = np.sqrt(max(0.0, 2 - 2 * least)) + SLACK
    todo = [(x, y)]
    while todo:
        x, y = todo.pop()
        if x is not y:
            apart = np.sqrt(max(0.0, 2 - 2 * float(points[x.centre] @ points[y.centre])))
            if apart > x.radius + y.radius + reach:
                continue
        if not x.kids and not y.kids:
            for k in range(0, len(x.rows), 512):
                rows = x.rows[k : k + 512]
                linked = points[rows] @ points[y.rows].T >= least
                if x is y:
                    linked &= rows[:, None] != y.rows
                if linked.any():
                    links.add(rows, y.rows, linked, x is not y)
        elif x is y:
            todo += [(a, b) for k, a in enumerate(x.kids) for b in x.kids[k:]]
        elif not y.kids or (x.kids and x.radius >= y.radius):
            todo += [(a, y) for a in x.kids]
        else:
            todo += [(x, b) for b in y.kids]


def shifted(node: Node, by: int) -> Node:
    node.centre += by
    node.rows = node.rows + by
    for kid in node.kids:
        shifted(kid, by)
    return node


def _unit(rows: list) -> np.ndarray:
    x = np.array(rows, np.float64)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def near_duplicates(vectors: DataFrame, least: float = LEAST) -> DataFrame:
    """vec_id, n_links, component_id, kept, one row per row."""
    rows = vectors.select("vec_id", "label", "embedding")
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    usable = F.coalesce(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & whole, F.lit(False))
    keyed = rows.withColumn("ok", usable).withColumn("k1", F.xxhash64("embedding")).withColumn("k2", F.xxhash64(F.lit(1), "embedding"))
    key = ["label", "k1", "k2"]
    points = keyed.filter("ok").groupBy(*key).agg(F.min(F.struct("vec_id", "embedding")).alias("x"), F.count(F.lit(1)).alias("times"))
    points = points.select(*key, F.concat_ws("/", F.col("label").cast("string"), F.size("x.embedding").cast("string")).alias("space"), F.col("x.vec_id").alias("point"), "times", F.col("x.embedding").alias("embedding"))
    points = stage(points, "points")

    # pivots: the least hashes, cut in each task before the shuffle
    by_hash = Window.partitionBy("space").orderBy(F.xxhash64("point"), "point")
    chosen = points.select("space", "point", "embedding", F.row_number().over(by_hash).alias("n")).filter(F.col("n") <= PIVOTS)
    # no more cells than the points of a label fill parts: a pair of parts carries both
    many = points.groupBy("space").agg(F.ceil(F.count(F.lit(1)) / PART).alias("most"))
    chosen = chosen.join(many, "space").filter("n <= most")
    pivots = chosen.groupBy("space").agg(F.sort_array(F.collect_list(F.struct("n", "embedding"))).alias("pivots"))
    pivots = lookup(pivots.select("space", F.col("pivots.embedding").alias("pivots")), 500)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells, last, to = [], None, np.empty(0)
            for own, around in zip(b["embedding"].to_pylist(), b["pivots"]):
                if last is None or not around.equals(last):
                    last, to = around, _unit(around.as_py())
                cells.append(int(np.argmax(to @ np.array(own, np.float64))))
            names = ["space", "point", "times", "embedding"]
            yield pa.RecordBatch.from_arrays([*[b[n] for n in names], pa.array(cells, pa.int32())], [*names, "cell"])

    schema = "space string, point bigint, times bigint, embedding array<float>, cell int"
    if dict(points.dtypes)["embedding"] != "array<float>":
        points = points.withColumn("embedding", F.col("embedding").cast("array<double>"))
        schema = schema.replace("array<float>", "array<double>")
    celled = stage(points.join(pivots, "space").select("space", "point", "times", "embedding", "pivots").mapInArrow(dealt, schema), "cells")
    sizes = lookup(celled.groupBy("space", "cell").agg(F.count(F.lit(1)).alias("size")))
    salted = celled.join(sizes, ["space", "cell"]).withColumn("salt", F.pmod(F.xxhash64("point"), F.ceil(F.col("size") / PART)))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def made() -> pa.RecordBatch:
            x = _unit([r["embedding"] for r in held])
            middle = x.mean(0)
            centre = x[int(np.argmax(x @ middle))]
            radius = float(np.sqrt(np.maximum(0, 2 - 2 * (x @ centre)).max()))
            row = {
                "space": held[0]["space"], "part": min(r["point"] for r in held), "centre": centre.tolist(), "radius": radius,
                "ids": [r["point"] for r in held], "times": [r["times"] for r in held], "x": x.tobytes(),
            }
            held.clear()
            return pa.RecordBatch.from_pylist([row])

        for b in batches:
            for r in b.to_pylist():
                same = held and all(held[0][k] == r[k] for k in ("space", "cell", "salt"))
                if held and (not same or len(held) >= PART):
                    yield made()
                held.append(r)
        if held:
            yield made()

    dealt_out = salted.repartition("space", "cell", "salt").sortWithinPartitions("space", "cell", "salt", "point")
    packed = stage(dealt_out.mapInArrow(parts, "space string, part bigint, centre array<double>, radius double, ids array<bigint>, times array<bigint>, x binary"), "parts")

    heads = packed.select("space", "part", "centre", "radius")
    side = lambda p: [F.col("part").alias(p), F.col("centre").alias(f"c_{p}"), F.col("radius").alias(f"r_{p}")]
    pairs = heads.select("space", *side("a")).join(heads.select("space", *side("b")), "space").filter("a <= b")
    dot = F.aggregate(F.zip_with("c_a", "c_b", lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    apart = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * dot))
    reach = float(np.sqrt(2 - 2 * least)) + SLACK
    pairs = pairs.filter((F.col("a") == F.col("b")) | (apart <= F.col("r_a") + F.col("r_b") + reach)).select("a", "b")
    body = lambda p: packed.select(F.col("part").alias(p), *[F.col(c).alias(f"{c}_{p}") for c in ("ids", "times", "x")])
    work = pairs.join(body("a"), "a").join(body("b"), "b").repartition("a", "b")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, times = list(r["ids_a"]), list(r["times_a"])
                x = np.frombuffer(r["x_a"], np.float64).reshape(len(ids), -1)
                if r["a"] == r["b"]:
                    links, points = Links(np.array(times)), x
                    one = tree(x)
                    traverse(one, one, points, least, links)
                else:
                    y = np.frombuffer(r["x_b"], np.float64).reshape(len(r["ids_b"]), -1)
                    points, ids, times = np.vstack([x, y]), ids + r["ids_b"], times + r["times_b"]
                    links = Links(np.array(times))
                    traverse(tree(x), shifted(tree(y), len(x)), points, least, links)
                hit = np.flatnonzero(links.count)
                if len(hit):
                    own = np.array(ids)
                    columns = own[hit], links.count[hit], own[links.roots(hit)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["point", "links", "root"])

    found = stage(work.mapInArrow(compared, "point bigint, links bigint, root bigint"), "vector-links")
    groups = components(found.select(F.col("point").alias("a"), F.col("root").alias("b")))
    linked = found.groupBy("point").agg(F.sum("links").alias("links")).join(groups, F.col("point") == F.col("node"), "left")
    class_ = points.select(*key, "point", "times").join(linked, "point", "left").select(
        *key, (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n"), F.coalesce("component", "point").alias("c")
    )
    out = keyed.select("vec_id", "ok", *[F.when(F.col("ok"), F.col(k)).alias(k) for k in key]).join(class_, key, "left")
    part = F.coalesce("c", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).alias("n_links"), part.alias("component_id"), F.coalesce(part == F.col("vec_id"), F.lit(True)).alias("kept"))

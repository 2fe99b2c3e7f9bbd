"""Near-duplicate embeddings by collision-counting projections.

Every unit vector is projected on many random directions. For each direction
the values are sorted and a window is laid around every vector; vectors that
fall into one another's window collide. Pairs that collide often enough are
verified by their cosine in double precision.

One direction alone tells 0.98 from chance only sevenfold, so its windows
would hold a fixed part of all pairs. Each direction is therefore sorted
within a cell: the label, the dimension and the signs of a few further random
directions, drawn anew for each. The number of signs grows with the logarithm
of the largest label's size, so that a cell's size, and with it the windows a
vector meets, stays the same at every size of the table. The count a pair must
reach is calibrated from the chance that a pair at the threshold shares a cell
and a window: the largest count that such a pair reaches with RECALL, and more
directions where that would be below two.

Sorting and windows are one equi-join on (cell, bin): bins as wide as the
window, each vector meets its own bin and the next one; Spark splits a bin
that holds many vectors. Equal vectors are one class, grouped by a partial
aggregation; classes are compared and each stands for its members, so copies
are never paired with one another.

Results for odd rows: vectors that are null, zero or hold null or non-finite
components, rows without a label and rows without an id link with nothing and
are their own component; vectors of different length never meet; rows that
repeat an id and a vector are copies, and another vector of that id is a vector
of its own, with its own links and component; an empty table gives an empty table;
other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage
from .components import connected_components

COSINE = 0.98
#: Chance that a pair at the threshold is found, before verification.
RECALL = 0.998
#: Vectors of the largest label for each cell, and directions to begin with.
CELL, DIRECTIONS = 32, 16
#: Half a window in standard deviations of the difference at the threshold.
SPREAD = 2.0


def calibrate(largest: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int, int, float]:
    """``(signs, directions, count, width)`` for the largest label's size."""
    signs = max(0, round(math.log2(max(largest, 1) / CELL)))
    p = (1 - math.acos(cosine) / math.pi) ** signs * math.erf(SPREAD / math.sqrt(2))
    m = DIRECTIONS
    while True:
        tail, reach = 1.0, 0
        for k in range(m):
            tail -= math.comb(m, k) * p**k * (1 - p) ** (m - k)
            if tail < recall:
                break
            reach = k + 1
        if reach >= 2:
            return signs, m, reach, SPREAD * math.sqrt(2 - 2 * cosine)
        m += 4


def _directions(dim: int, signs: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([7, dim])
    return rng.standard_normal((m, dim)), rng.standard_normal((m, signs, dim))


def _projector(signs: int, m: int, width: float):
    def project(batches):
        kept: dict[int, tuple] = {}
        for batch in batches:
            rep, label, vectors = batch.column(0), batch.column(1), batch.column(2)
            lengths = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = vectors.offsets.to_numpy()[:-1] - vectors.offsets.to_numpy()[0]
            for dim in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == dim)
                x = flat[starts[at][:, None] + np.arange(dim)]
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                if dim not in kept:
                    kept[dim] = _directions(dim, signs, m)
                lines, planes = kept[dim]
                value = x @ lines.T
                bits = (x @ planes.reshape(m * signs, dim).T > 0).reshape(len(at), m, signs)
                cell = (bits * (1 << np.arange(signs))).sum(axis=2, dtype=np.int64)
                take = np.repeat(at, m)
                yield pa.RecordBatch.from_arrays(
                    [rep.take(pa.array(take)), label.take(pa.array(take)), pa.array(np.full(len(take), dim, np.int32)), pa.array(np.tile(np.arange(m, dtype=np.int32), len(at))),
                     pa.array(cell.ravel()), pa.array(np.floor(value / width).astype(np.int32).ravel()), pa.array(value.ravel())],
                    ["rep", "label", "dim", "line", "cell", "bin", "value"])
    return project


def _cosines(batches):
    for batch in batches:
        a, b, va, vb = batch.columns
        if not len(a):
            continue
        lengths = np.diff(va.offsets.to_numpy())
        row = np.repeat(np.arange(len(a)), lengths)
        x, y = (v.flatten().to_numpy(zero_copy_only=False).astype(np.float64) for v in (va, vb))
        total = lambda z: np.bincount(row, z, len(a))
        # scaled first, so that squares neither overflow nor vanish
        peak = lambda z: np.maximum.reduceat(np.abs(z), np.concatenate(([0], np.cumsum(lengths)[:-1])))[row]
        x, y = x / peak(x), y / peak(y)
        cos = total(x * y) / np.sqrt(total(x * x) * total(y * y))
        yes = pa.array(cos >= COSINE)
        yield pa.RecordBatch.from_arrays([a.filter(yes), b.filter(yes)], ["a", "b"])


def embedding_links(vectors: DataFrame) -> DataFrame:
    """Links ``a b`` (a < b) between the classes ``rep label embedding``."""
    largest = vectors.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    signs, m, count, width = calibrate(largest)
    kinds = dict(vectors.dtypes)
    spread = vectors.select("rep", "label", "embedding").mapInArrow(
        _projector(signs, m, width), f"rep {kinds['rep']}, label {kinds['label']}, dim int, line int, cell bigint, bin int, value double")
    spread = stage(spread, "projections")
    key = ["label", "dim", "line", "cell", "bin"]
    left = spread.select(*key, F.col("rep").alias("x"), F.col("value").alias("vx"))
    right = spread.select("label", "dim", "line", "cell", F.explode(F.array(F.col("bin"), F.col("bin") + 1)).alias("bin"), F.col("bin").alias("home"), F.col("rep").alias("y"), F.col("value").alias("vy"))
    # the pair of two vectors of one bin is met there once, from the lesser id; else from the upper bin
    hit = left.join(right, key).where((F.abs(F.col("vx") - F.col("vy")) <= width) & ((F.col("home") < F.col("bin")) | (F.col("x") < F.col("y"))))
    pairs = hit.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).count().where(F.col("count") >= count)
    pairs = stage(pairs.select("a", "b"), "collisions")
    va = vectors.select(F.col("rep").alias("a"), F.col("embedding").alias("va"))
    vb = vectors.select(F.col("rep").alias("b"), F.col("embedding").alias("vb"))
    return pairs.join(va, "a").join(vb, "b").select("a", "b", "va", "vb").mapInArrow(_cosines, f"a {kinds['rep']}, b {kinds['rep']}")


def near_duplicate_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id n_links component_id kept`` per row."""
    rows = df.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("embedding"), F.col(label_col).alias("label"))
    rows = rows.withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0).cast(dict(rows.dtypes)["embedding"][6:-1])))  # -0.0 is 0.0
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("embedding", lambda x: x != 0)
    usable = F.col("embedding").isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull() & sound
    # one class for each vector and label, known by a number that is written down
    classes = stage(rows.where(usable).groupBy("label", "embedding")
                    .agg(F.min("vec_id").alias("least"), F.count("*").alias("n")).withColumn("rep", F.monotonically_increasing_id()), "vec-classes")
    links = stage(embedding_links(classes), "vec-links")
    comp = stage(connected_components(links, "a", "b"), "vec-components")
    both = links.union(links.select("b", "a"))
    size = classes.select(F.col("rep").alias("b"), "n")
    linked = stage(both.join(size, "b").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others")), "vec-linked")
    named = classes.join(linked, "rep", "left").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
    named = stage(named.select("label", "embedding", "least", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("part")), "vec-named")
    named = named.join(named.groupBy("part").agg(F.min("least").alias("c")), "part").select("label", "embedding", "n_links", "c")
    out = rows.withColumn("_usable", F.coalesce(usable, F.lit(False)))
    out = out.where("_usable").join(named, ["label", "embedding"]).select("vec_id", "n_links", F.col("c").alias("component_id")).union(
        out.where("not _usable").select("vec_id", F.lit(0).cast("long"), "vec_id"))
    return out.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))

"""Near-duplicate vectors through spherical k-means cells.

Vectors of one label are compared only within cells. A vector lives in the cell
of its best centroid and visits every other cell it may have a neighbour in: a
neighbour in that cell lies beyond the bisector of the two centroids, so the
vector's angle to the bisector is at most the angle of the similarity sought.
No pair is lost, whatever the centroids; they are fitted on a bounded sample.

Cells lie one after the other in parts of bounded size. A vector travels to a part
once, however many cells it visits there, and only to those parts whose pair with
its own is not compared the other way round.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import _arrow_schema, one_blas_thread
from .components import connected_components
from .simhash_trees import spanning_links


def fit_centroids(sample: np.ndarray, cells: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means: unit centroids by cosine, started from spread sample rows."""
    cells = max(1, min(cells, len(sample)))
    centroids = sample[:: max(1, len(sample) // cells)][:cells].copy()
    for _ in range(rounds):
        best = np.argmax(sample @ centroids.T, axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, best, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(size > 0, sums / np.where(size > 0, size, 1), centroids)
    return centroids


def unit_rows(lists: list | np.ndarray) -> np.ndarray:
    """Unit rows of finite, non-zero vectors of one length, whatever their scale."""
    rows = np.array(lists, np.float64).reshape(len(lists), -1)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def list_rows(lists: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """``unit_rows`` of an Arrow column of lists of one length."""
    flat = (lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists).flatten()
    return unit_rows(flat.to_numpy(zero_copy_only=False).reshape(len(lists), -1))


def visited(points: np.ndarray, home: np.ndarray, centres: np.ndarray, cells: np.ndarray, sine: float) -> np.ndarray:
    """Which of ``cells`` each point may have a neighbour in; ``home`` is its own cell."""
    own, at = np.unique(home, return_inverse=True)
    apart = np.sqrt(np.maximum(0, 2 - 2 * centres[own] @ centres[cells].T))[at]
    ahead = (points * centres[home]).sum(axis=1)[:, None] - points @ centres[cells].T
    return ahead <= sine * apart + 1e-6  # beyond rounding errors


def usable(vector: Column) -> Column:
    """Finite components without nulls, some of them not zero."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return (
        vector.isNotNull()
        & (F.size(vector) > 0)
        & F.forall(vector, number)
        & F.exists(vector, lambda x: x.isNotNull() & (x != 0))
    )


PLACE = "id bigint, sub bigint, label string, dim int, copies bigint, vector array<{kind}>, cell int, visits array<int>"
PLACE_VALUES = 1 << 18  # of points by cells, of which a worker holds a few arrays at a time
COMPARED = 1 << 20  # pairs of vectors, likewise
FOUND = "id bigint, sub bigint, n bigint, other bigint"
FOUND_ARROW = pa.schema([(name, pa.int64()) for name in ("id", "sub", "n", "other")])


def near_vectors(
    vectors: DataFrame,
    id_column: str,
    vector_column: str,
    label_column: str,
    threshold: float = 0.93,
    sample_rows: int = 20_000,
    sample_values: int = 4_000_000,
    cell_rows: int = 1_000,
    most_cells: int = 1_024,
    block_rows: int = 4_096,
) -> DataFrame:
    """Links and components of vectors with the same label and a cosine of ``threshold`` or more.

    Returns ``id_column``, ``n_links`` (other rows linked directly),
    ``component_id`` (the smallest id reachable) and ``kept`` (whether that is the
    row's own id). One row per input row. A null label, a null id, and a vector
    that is null, empty, zero or holds a null or non-finite component link with
    nothing; a null id has no component and is not kept. Vectors of unlike length
    are not compared. Repeated rows link with each other; rows that share an id
    share a component. An empty table gives an empty result; other columns are
    ignored. ``id_column`` holds 64-bit integers.

    ``sample_rows`` and ``sample_values`` (components) bound what the centroids are
    fitted on and the driver receives; every vector is placed and compared, and no pair is lost to the cells. There are about as many
    cells per label as give each ``cell_rows`` rows, ``most_cells`` at most. Cells are
    compared in parts of about ``block_rows``, however many a cell holds. Where vectors
    have no structure they visit nearly all cells; each then travels to half of the
    label's parts, so rows sent grow with the square of the label's, in groups of bounded size.
    Equal vectors are compared once.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must lie above 0 and not above 1")
    kind = "float" if vectors.select(vector_column).dtypes[0][1] == "array<float>" else "double"
    rows = vectors.select(
        vectors[id_column].cast("bigint").alias("id"),
        vectors[label_column].cast("string").alias("label"),
        vectors[vector_column].cast(f"array<{kind}>").alias("vector"),
    )
    compared = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
    classes = materialize(
        compared.groupBy("label", "vector")
        .agg(F.min("id").alias("id"), F.count("*").alias("copies"))
        .select(
            "id", F.xxhash64("label", "vector").alias("sub"), "label", F.size("vector").alias("dim"), "copies", "vector"
        ),
        "vector-classes",
    )
    size = classes.agg(
        F.count("*").alias("rows"), F.approx_count_distinct("label").alias("labels"), F.max("dim").alias("dim")
    ).first()
    cells = max(1, min(most_cells, math.ceil(size["rows"] / max(1, size["labels"]) / cell_rows)))
    sampled = max(1, min(sample_rows, sample_values // max(1, size["dim"] or 1)))
    sample = classes.orderBy(F.xxhash64("id", "sub")).limit(sampled).select("dim", "vector").collect()
    centroids = {
        dim: fit_centroids(unit_rows([r["vector"] for r in sample if r["dim"] == dim]), cells)
        for dim in sorted({r["dim"] for r in sample})
    }
    sine = math.sqrt(1 - threshold**2)

    placing = _arrow_schema(vectors.sparkSession, PLACE.format(kind=kind))
    centres_of = lambda dim: centroids.get(dim, np.ones((1, dim)))

    def place(batches):
        one_blas_thread()
        for batch in batches:
            dims = batch.column(3).to_numpy()
            for dim in np.unique(dims):
                centres, rows = centres_of(dim), batch.filter(pa.array(dims == dim))
                step = max(1, PLACE_VALUES // max(dim, len(centres)))
                for at in range(0, rows.num_rows, step):
                    part = rows.slice(at, step)
                    points = list_rows(part.column(5))
                    home = np.argmax(points @ centres.T, axis=1)
                    visit = visited(points, home, centres, np.arange(len(centres)), sine)
                    ends = np.cumsum([0, *visit.sum(axis=1)])
                    visits = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.nonzero(visit)[1], pa.int32()))
                    columns = [*part.columns, pa.array(home, pa.int32()), visits]
                    yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, placing)], schema=placing)

    placed = materialize(classes.mapInArrow(place, PLACE.format(kind=kind)), "vector-cells")
    # Cells of a label one after the other, cut into parts of equal size.
    group = ["label", "dim"]
    cell_sizes = placed.groupBy(*group, "cell").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(*group).orderBy("cell")) - F.col("n")
    spots = F.map_from_entries(F.collect_list(F.struct("cell", F.struct("before", "n"))))
    layout = (
        cell_sizes.withColumn("before", before)
        .groupBy(*group)
        .agg(F.ceil(F.sum("n") / block_rows).alias("parts"), spots.alias("spots"))
        .withColumn("spots", F.transform(F.sequence(F.lit(0), F.lit(cells - 1)), lambda c: F.col("spots")[c]))
    )
    spot = F.col("spots")[F.col("cell")]
    own = F.floor((spot["before"] + F.pmod(F.xxhash64("id", "sub"), spot["n"])) / block_rows)
    held = F.filter(F.transform("visits", lambda c: F.col("spots")[c]), lambda s: s.isNotNull())
    met = F.transform(held, lambda s: F.sequence(F.floor(s["before"] / block_rows), F.floor((s["before"] + s["n"] - 1) / block_rows)))
    # Of two parts one is home and the other's vectors are its guests, by turns.
    ahead = lambda r: F.pmod(F.col("own") - r, F.col("parts"))
    guest = lambda r: (r != F.col("own")) & (
        (2 * ahead(r) < F.col("parts")) | ((2 * ahead(r) == F.col("parts")) & (r < F.col("own")))
    )
    located = (
        placed.join(layout, group)
        .withColumn("own", own)
        .select(*group, "id", "sub", "copies", "vector", "cell", "own", F.filter(F.array_distinct(F.flatten(met)), guest).alias("met"))
    )
    key = [*group, "r", "v"]
    row = ["id", "sub", "copies", "vector", "cell"]
    guests = located.select(*group, F.explode("met").alias("r"), F.col("own").alias("v"), F.lit(False).alias("lives"), *row)
    callers = guests.groupBy(*group, "r").agg(F.collect_set("v").alias("callers"))
    every = F.concat(F.array("r"), F.coalesce("callers", F.array().cast("array<bigint>")))
    residents = (
        located.withColumnRenamed("own", "r")
        .join(callers, [*group, "r"], "left")
        .select(*group, "r", F.explode(every).alias("v"), F.lit(True).alias("lives"), *row)
    )
    dealt = residents.unionByName(guests)

    def compare(key, table):
        one_blas_thread()
        lives = table.column("lives").to_numpy()
        ids = table.column("id").to_numpy().astype(np.int64)
        subs = table.column("sub").to_numpy().astype(np.int64)
        copies = table.column("copies").to_numpy().astype(np.float64)
        cell = table.column("cell").to_numpy().astype(np.int64)
        points, centres = list_rows(table.column("vector")), centres_of(key[1].as_py())
        home, alone = np.flatnonzero(lives), key[2].as_py() == key[3].as_py()
        others = home if alone else np.flatnonzero(~lives)
        home = home[np.argsort(cell[home], kind="stable")]
        here, starts = np.unique(cell[home], return_index=True)
        visit = visited(points[others], cell[others], centres, here, sine)
        counts = np.zeros(len(ids))

        def links():
            for at, residents in enumerate(np.split(home, starts[1:])):
                guests = others[visit[:, at]]
                step = max(1, COMPARED // max(1, len(guests)))
                for part in (residents[i : i + step] for i in range(0, len(residents), step)):
                    near = points[part] @ points[guests].T >= threshold
                    if alone:  # each pair is met twice
                        near &= part[:, None] < guests[None]
                    i, j = np.nonzero(near)
                    if len(i):
                        counts[part] += near @ copies[guests]
                        counts[guests] += copies[part] @ near
                        yield index[part[i]], index[guests[j]]

        nodes, index = np.unique(ids, return_inverse=True)
        forest = spanning_links(len(nodes), links())
        counts = np.rint(counts).astype(np.int64)
        some = np.flatnonzero(counts)
        n = len(forest)
        return pa.table(
            {
                "id": np.r_[ids[some], nodes[[a for a, _ in forest]]].astype(np.int64),
                "sub": np.r_[subs[some], np.zeros(n, np.int64)],
                "n": np.r_[counts[some], np.zeros(n, np.int64)],
                "other": pa.array([None] * len(some) + [int(nodes[b]) for _, b in forest], pa.int64()),
            },
            FOUND_ARROW,
        )

    found = materialize(dealt.groupBy(*key).applyInArrow(compare, FOUND), "vector-links")
    counted = found.where("n > 0").groupBy("id", "sub").agg(F.sum("n").alias("n"))
    roots = connected_components(found.where("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b")))
    named = materialize(
        classes.join(counted, ["id", "sub"], "left")
        .join(roots.withColumnRenamed("node", "id"), "id", "left")
        .select(
            F.col("label"), F.col("vector"),
            (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("root", "id").alias("root"),
        ),
        "vector-components",
    )
    alone = F.when(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")), F.col("label"))
    return (
        rows.withColumn("label", alone)
        .join(named, ["label", "vector"], "left")
        .select(
            F.col("id").alias(id_column),
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            F.coalesce("root", "id").alias("component_id"),
            (F.col("id").isNotNull() & (F.coalesce("root", "id") == F.col("id"))).alias("kept"),
        )
    )

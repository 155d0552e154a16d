"""Embedding near-dedup: PCA-ordered tiled comparison.

Vectors are scaled to length one and turned onto the principal axes of all vectors, so the leading
coordinates carry most of a difference.  cosine >= t means a distance of at most r = sqrt(2 - 2t), in
every coordinate too: vectors are dealt to cells of width r on the leading axes and meet only the same
and the neighbouring cells.  How many axes a cell has follows from the measured counts: a cell of more than a tile's
vectors is split along the next axis, as long as its vectors spread over more than three slabs there (fewer
would all be neighbours, and splitting would save nothing).  Neighbours are found from the whole downwards, by
splitting pairs of cells together, so only cells that are neighbours on all their common axes are
looked at.  What can't be split is cut into tiles of bounded size.  A pair of tiles is compared
by its leading products first; the rest of a product is at most the product of the suffix norms, and
pairs whose bound stays below the threshold are dropped before more dimensions are added.  What is left
is decided by the cosine of the vectors as given, in double precision.

Equal vectors are one class, so copies never meet each other.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.components import components
from corpusmill.llm.store import written

#: vectors of a tile; most axes that make cells; dimensions added at a time
TILE, AXES, STEP = 1024, 8, 16
#: room for rounding in bounds
SLACK = 1e-6


def _by_length(column: pa.Array):
    """(rows, matrix) of the vectors of each length in a column of lists."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.values.to_numpy(False)
    starts = column.offsets.to_numpy()[:-1]
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        yield at, flat[starts[at][:, None] + np.arange(d)].astype(np.float64)


def units(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, without overflow or underflow on the way."""
    m = m / np.abs(m).max(1, keepdims=True)
    return m / np.sqrt(np.einsum("ij,ij->i", m, m))[:, None]


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each dimension, orthonormal axes, largest spread first. Workers send one dim x dim sum each, over all vectors (v)."""

    def gram(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, m in _by_length(batch.column("v")):
                u = units(m)
                sums[m.shape[1]] = sums.get(m.shape[1], 0) + u.T @ u
        for d, m in sums.items():
            i, j = np.indices((d, d))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(d * d, d), pa.int32()), pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(m.ravel(), pa.float64())], ["dim", "i", "j", "s"])

    out: dict[int, np.ndarray] = {}
    for r in vectors.select("v").mapInArrow(gram, "dim int, i int, j int, s double").groupBy("dim", "i", "j").agg(F.sum("s").alias("s")).collect():
        out.setdefault(r.dim, np.zeros((r.dim, r.dim)))[r.i, r.j] = r.s
    return {d: np.linalg.eigh((m + m.T) / 2)[1][:, ::-1] for d, m in out.items()}


def near_vectors(df: DataFrame, threshold: float = 0.98, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row a vector: vec_id, n_links, component_id, kept.

    Vectors link if their labels are equal and not null, their lengths are equal and their cosine is at
    least threshold.  Null, empty and zero vectors and those with null or non-finite components link
    with nothing: n_links 0, component_id the own id, kept.  Equal vectors link with each other; rows that
    repeat, ids too, count as vectors of their own.  Other columns are not carried; an empty table
    gives an empty table.
    """
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    fine = F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    largest = F.array_max(F.transform("v", F.abs))
    rows = rows.withColumn("fine", F.coalesce(fine, F.lit(False)))
    rows = rows.withColumn("fine", F.col("fine") & F.coalesce(largest > 0, F.lit(False)))
    # equal vectors of a label are one class, named by content; -0.0 is 0.0
    named = F.when(F.col("fine"), F.md5(F.concat_ws("|", F.col("label").cast("string"), F.concat_ws(",", F.transform("v", lambda x: (x + F.lit(0.0)).cast("string"))))))
    rows = written(rows.select("vec_id", "label", "v", "fine", named.alias("name")), "vectors")
    classes = rows.filter("fine").groupBy("name").agg(F.count("*").alias("copies"), F.min("vec_id").alias("id"), F.first("label").alias("label"), F.first("v").alias("v"))
    classes = written(classes, "vector-classes")
    axes = principal_axes(classes)
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK

    def place(batches):
        for batch in batches:
            cells: list = [None] * len(batch)
            for at, m in _by_length(batch.column("v")):
                for k, cell in zip(at.tolist(), np.floor((units(m) @ axes[m.shape[1]][:, :AXES]) / reach).astype(np.int64).tolist(), strict=True):
                    cells[k] = cell
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("name", "copies", "label", "v")), pa.array(cells, pa.list_(pa.int64()))], ["name", "copies", "label", "v", "cell"])

    source = classes.select("name", "copies", "label", "v")
    turned = source.mapInArrow(place, T.StructType([*source.schema.fields, T.StructField("cell", T.ArrayType(T.LongType()))]))
    turned = written(turned.withColumn("dim", F.size("v")), "turned")
    leaves, of_cell, depth = _leaves(turned.groupBy("label", "dim", "cell").agg(F.count("*").alias("n")))
    tile = F.pmod(F.xxhash64("name"), F.col("tiles")).cast("int")
    placed = written(turned.join(of_cell, ["label", "dim", "cell"]).select("name", "copies", "label", "dim", "v", "leaf", tile.alias("tile")), "placed")
    # each pair of tiles of neighbouring leaves once; a tile also meets itself
    pairs = _neighbours(leaves, depth)
    sized = leaves.filter("tiles > 0").select("label", "dim", "node", F.sequence(F.lit(0), F.col("tiles") - 1).alias("t"))
    side = lambda x: sized.select("label", "dim", F.col("node").alias(x), F.explode("t").alias(f"{x}_tile"))
    meets = pairs.join(side("a"), ["label", "dim", "a"]).join(side("b"), ["label", "dim", "b"]).filter((F.col("a") != F.col("b")) | (F.col("a_tile") <= F.col("b_tile")))
    group = ["label", "dim", "a", "a_tile", "b", "b_tile"]
    alone = (F.col("a") == F.col("b")) & (F.col("a_tile") == F.col("b_tile"))
    left = meets.select(*group, F.col("a").alias("leaf"), F.col("a_tile").alias("tile"), F.lit(True).alias("here"))
    right = meets.filter(~alone).select(*group, F.col("b").alias("leaf"), F.col("b_tile").alias("tile"), F.lit(False).alias("here"))
    members = left.unionByName(right).join(placed, ["label", "dim", "leaf", "tile"]).select(*group, "here", "name", "copies", "v")

    def compare(table: pa.Table) -> pa.Table:
        here = table.column("here").to_numpy()
        names = table.column("name").to_numpy()
        ((_, v),) = _by_length(table.column("v").combine_chunks())
        p = units(v) @ axes[v.shape[1]]
        own = bool(here.all())
        i, j = (np.flatnonzero(here), np.flatnonzero(here if own else ~here))
        copies = table.column("copies").to_numpy()
        linked, root = np.zeros(len(here), np.int64), np.arange(len(here))
        pairs = []
        # nearest suffix norms: rest[k] bounds what dimensions k.. can add
        rest = np.sqrt(np.maximum(0, np.cumsum((p**2)[:, ::-1], 1)[:, ::-1]))
        for part in range(0, len(i), 256):
            at = i[part : part + 256]
            dots = p[at][:, :STEP] @ p[j][:, :STEP].T
            k = min(STEP, p.shape[1])
            bound = dots + (np.outer(rest[at, k], rest[j, k]) if k < p.shape[1] else 0)
            x, y = np.nonzero(bound >= threshold - SLACK)
            dots = dots[x, y]
            x, y = at[x], j[y]
            if own:
                ok = x < y
                x, y, dots = x[ok], y[ok], dots[ok]
            while k < p.shape[1] and len(x):
                end = min(k + STEP, p.shape[1])
                dots = dots + np.einsum("ij,ij->i", p[x, k:end], p[y, k:end])
                ok = dots + (rest[x, end] * rest[y, end] if end < p.shape[1] else 0) >= threshold - SLACK
                x, y, dots, k = x[ok], y[ok], dots[ok], end
            if len(x):
                ok = cosines(v[x], v[y]) >= threshold
                pairs.append((x[ok], y[ok]))
        # of a pair of tiles, what each vector is linked with, and who hangs together: rows in proportion to vectors, not to links
        for x, y in pairs:
            np.add.at(linked, x, copies[y])
            np.add.at(linked, y, copies[x])
        moved = True
        while moved:
            before = root.copy()
            for x, y in pairs:
                least = np.minimum(root[x], root[y])
                np.minimum.at(root, x, least)
                np.minimum.at(root, y, least)
            moved = bool((root != before).any())
        at, tied = np.flatnonzero(linked), np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"a": pa.array(names[np.concatenate([at, tied])], pa.string()), "b": pa.array([None] * len(at) + names[root[tied]].tolist(), pa.string()), "n": pa.array(np.concatenate([linked[at], np.zeros(len(tied), np.int64)]), pa.int64())})

    links = written(members.groupBy(*group).applyInArrow(compare, "a string, b string, n long"), "vector-links")
    others = links.filter("b is null").groupBy(F.col("a").alias("name")).agg(F.sum("n").alias("others"))
    known = _named_components(links.filter("b is not null"), classes)
    of_class = classes.select("name", "copies").join(others, "name", "left").join(known, "name")
    found = rows.select("vec_id", "name").join(of_class, "name", "left")
    component = F.coalesce("component", "vec_id")
    return found.select("vec_id", F.coalesce(F.col("copies") - 1 + F.coalesce("others", F.lit(0)), F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def _named_components(links: DataFrame, classes: DataFrame) -> DataFrame:
    """(name, component): the smallest vec_id of a class's component. The walk is on the names themselves."""
    placed = classes.select("name", "id").join(components(links).withColumnRenamed("id", "name"), "name", "left").select("name", "id", F.coalesce("component", "name").alias("group"))
    least = placed.groupBy("group").agg(F.min("id").alias("component"))
    return placed.join(least, "group").select("name", "component")


def _leaves(cells: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """From counts (label, dim, cell, n) of cells on all axes: the tree's nodes (label, dim, node, tiles; tiles 0 where it is split), each cell's leaf (label, dim, cell, leaf, tiles), and how deep the tree is."""
    open_ = cells = written(cells, "cells")
    nodes, of_cell = [], []
    for depth in range(AXES + 1):
        node = F.slice("cell", F.lit(1), F.lit(depth)).alias("node")
        along = F.get("cell", F.lit(depth))
        sizes = open_.select("label", "dim", node, "n", along.alias("along")).groupBy("label", "dim", "node").agg(F.sum("n").alias("n"), (F.max("along") - F.min("along") + 1).alias("slabs"))
        ends = (F.col("n") <= TILE) | F.coalesce(F.col("slabs") <= 3, F.lit(True))
        sizes = written(sizes.select("label", "dim", "node", F.when(ends, F.ceil(F.col("n") / TILE)).otherwise(0).cast("int").alias("tiles")), "nodes")
        nodes.append(sizes)
        placed = open_.withColumn("node", node).join(sizes, ["label", "dim", "node"])
        of_cell.append(placed.filter("tiles > 0").select("label", "dim", "cell", F.col("node").alias("leaf"), "tiles"))
        if sizes.filter("tiles = 0").isEmpty():
            break
        open_ = placed.filter("tiles = 0").select("label", "dim", "cell", "n")
    return reduce(DataFrame.unionByName, nodes), reduce(DataFrame.unionByName, of_cell), depth


def _neighbours(nodes: DataFrame, depths: int) -> DataFrame:
    """(label, dim, a, b): each pair of leaves once, a leaf with itself too, whose cells are the same or next to each other on every axis that both have."""
    pairs = nodes.filter("size(node) = 0").select("label", "dim", F.col("node").alias("a"), F.col("node").alias("b"))
    if not depths:
        return pairs
    split = nodes.filter("tiles = 0").select("label", "dim", F.col("node").alias("parent"))
    children = nodes.filter("size(node) > 0").select("label", "dim", F.slice("node", F.lit(1), F.size("node") - 1).alias("parent"), F.col("node").alias("child"))
    # a split node gives way to its children, a leaf to itself
    itself = nodes.filter("tiles > 0").select("label", "dim", F.col("node").alias("parent"), F.col("node").alias("child"))
    below = written(children.join(split, ["label", "dim", "parent"]).unionByName(itself), "below")
    for depth in range(depths):
        side = lambda x: below.select("label", "dim", F.col("parent").alias(x), F.col("child").alias(f"{x}_"))
        pairs = pairs.join(side("a"), ["label", "dim", "a"]).join(side("b"), ["label", "dim", "b"])
        near = F.coalesce(F.abs(F.get("a_", F.lit(depth)) - F.get("b_", F.lit(depth))) <= 1, F.lit(True))
        pairs = pairs.filter(near & ((F.col("a") != F.col("b")) | (F.col("a_") <= F.col("b_")))).select("label", "dim", F.col("a_").alias("a"), F.col("b_").alias("b"))
        pairs = written(pairs, "neighbours")
    return pairs


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each two rows, in double precision."""
    a, b = a / np.abs(a).max(1, keepdims=True), b / np.abs(b).max(1, keepdims=True)
    return np.einsum("ij,ij->i", a, b) / np.sqrt(np.einsum("ij,ij->i", a, a) * np.einsum("ij,ij->i", b, b))

"""Embedding near-duplicates: an epsilon grid order join on leading principal dimensions."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.unions import Unions
from millrace.llm.work import Scratch, mounted

# Leading principal dimensions whose grid cells make the order; rows per block; rows per leaf that is
# compared in full.
LEADING, BLOCK, LEAF = 8, 4096, 256
# Groups that partial sums of the covariance are added up in before the driver adds the last few.
SUMS = 8
# Leading dimensions of the sketch that bounds a cosine, what rounding may add to that bound, and the part of
# a leaf's pairs beyond which all of them are taken.
SKETCH, SLACK, DENSE = 16, 1e-5, 1 / 8
# Pairs of blocks a task joins, and blocks it holds at a time.
PAIRS, HELD = 64, 4
# In place of a null id.
LAST = (1 << 63) - 1


def unit_rows(values) -> np.ndarray:
    """Rows as unit vectors in double precision; scaled first, so no square over- or underflows."""
    x = np.array([np.asarray(v, dtype=np.float64) for v in values])
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _moments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = None
    for frame in frames:
        if len(frame):
            x = unit_rows(frame["embedding"])
            x = np.c_[np.ones(len(x)), x]
            total = x.T @ x if total is None else total + x.T @ x
    if total is not None:
        yield pd.DataFrame({"part": [0], "sums": [total.tobytes()]})


def _add(frame: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"sums": [np.sum([np.frombuffer(s) for s in frame["sums"]], axis=0).tobytes()]})


def principal_axes(vectors: DataFrame, size: int) -> np.ndarray:
    """Axes of the unit vectors by falling variance; only sums of squares reach the driver."""
    parts = vectors.mapInPandas(_moments, "part int, sums binary").withColumn("part", F.spark_partition_id() % SUMS)
    rows = parts.groupBy("part").applyInPandas(_add, "sums binary").collect()
    total = np.sum([np.frombuffer(r["sums"]) for r in rows], axis=0).reshape(size + 1, size + 1)
    n = total[0, 0]
    mean = total[0, 1:] / n
    values, axes = np.linalg.eigh(total[1:, 1:] / n - np.outer(mean, mean))
    return axes[:, np.argsort(values)[::-1]]


def _merged(rows: pd.DataFrame) -> pd.DataFrame:
    """One row per vector, in the order of their first ones; copies are added up."""
    if not rows.duplicated(["k1", "k2"]).any():
        return rows
    same = rows.groupby(["k1", "k2"], sort=False)
    sums = {c: same[c].transform(how) for c, how in (("id", "min"), ("named", "max"), ("copies", "sum"))}
    return rows.assign(**sums)[~rows.duplicated(["k1", "k2"])].reset_index(drop=True)


def _cells(axes: np.ndarray, reach: float, kind: str):
    """Grid cells of the vectors; copies within a batch leave it as one row."""
    lead = axes[:, :LEADING]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame = _merged(frame.assign(copies=1))
            x = unit_rows(frame["embedding"]) if len(frame) else np.zeros((0, len(axes)))
            cells = np.floor(x @ lead / reach).astype(np.int32)
            out = frame.drop(columns="embedding").assign(x=[np.asarray(v, dtype=kind).tobytes() for v in frame["embedding"]])
            yield out.assign(**{f"c{i}": cells[:, i] for i in range(cells.shape[1])})

    return run


def _blocks(axes: np.ndarray, kind: str, rank: int, room: int):
    """Cut a sorted partition into blocks: their classes, vectors and box on all principal dimensions.

    Classes are numbered by the vectors' ``rank`` (in the bits from ``room`` on), the partition and their place in it.
    """

    def block(rows: pd.DataFrame, name: int, first: int) -> pd.DataFrame:
        on_axes = unit_rows(_unpacked(b"".join(rows["x"]), kind, len(rows))) @ axes
        return pd.DataFrame(
            {
                "block": [name],
                "low": [on_axes.min(axis=0)],
                "high": [on_axes.max(axis=0)],
                "nodes": [np.arange(first, first + len(rows))],
                **{c: [rows[c].to_numpy()] for c in ("k1", "k2", "id", "named", "copies")},
                "x": [b"".join(rows["x"])],
            }
        )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        if part >> (room - 32):
            raise ValueError(f"too many partitions to number the classes: {part}")
        name, first = part << 32, rank << room | part << 32
        held = []
        for frame in frames:
            held.append(frame)
            if sum(map(len, held)) > BLOCK:
                rows = _merged(pd.concat(held, ignore_index=True))
                while len(rows) > BLOCK:  # the last row may have copies yet to come
                    yield block(rows[:BLOCK], name, first)
                    rows, name, first = rows[BLOCK:], name + 1, first + BLOCK
                held = [rows]
        rows = _merged(pd.concat(held, ignore_index=True)) if held else pd.DataFrame()
        while len(rows):
            yield block(rows[:BLOCK], name, first)
            rows, name, first = rows[BLOCK:], name + 1, first + BLOCK

    return run


def _unpacked(x: bytes, kind: str, n: int) -> np.ndarray:
    return np.frombuffer(x, kind).reshape(n, -1)


class Blocks:
    """Blocks as the files of a table have them; the last few are held."""

    def __init__(self, axes: np.ndarray, kind: str):
        self.axes, self.kind = axes, kind
        self.get = lru_cache(HELD)(self._read)
        self.opened = lru_cache(HELD)(self._open)

    def _open(self, path: str) -> tuple[pq.ParquetFile, dict[int, tuple[int, int]]]:
        """A file, and the row group of each block in it with its place there."""
        file, at = pq.ParquetFile(path), {}
        for group in range(file.num_row_groups):
            names = file.read_row_group(group, columns=["block"])["block"].to_pylist()
            at |= {name: (group, i) for i, name in enumerate(names)}
        return file, at

    def _read(self, path: str, block: int) -> Sequence:
        file, at = self.opened(path)
        group, i = at[block]
        row = file.read_row_group(group, columns=["nodes", "copies", "x"]).slice(i, 1).to_pylist()[0]
        nodes, copies = (np.array(row[c], np.int64) for c in ("nodes", "copies"))
        x = unit_rows(_unpacked(row["x"], self.kind, len(nodes)))
        return Sequence({"nodes_a": nodes.tobytes(), "copies_a": copies.tobytes(), "x_a": x.tobytes()}, self.axes, "a")


class Sequence:
    """A block's rows in grid order, with the boxes of its leaves and of longer and longer runs."""

    def __init__(self, row, axes: np.ndarray, side: str):
        self.nodes = np.frombuffer(row[f"nodes_{side}"], np.int64)
        self.copies = np.frombuffer(row[f"copies_{side}"], np.int64)
        self.x = np.frombuffer(row[f"x_{side}"]).reshape(len(self.nodes), -1)
        self.on_axes = self.x @ axes
        self.sketch = np.c_[self.on_axes[:, :SKETCH], np.linalg.norm(self.on_axes[:, SKETCH:], axis=1)].astype(np.float32)
        self.boxes: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def box(self, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        if (start, stop) not in self.boxes:
            part = self.on_axes[start:stop]
            self.boxes[start, stop] = part.min(axis=0), part.max(axis=0)
        return self.boxes[start, stop]


def box_gap(low_a, high_a, low_b, high_b) -> float:
    """Least distance between two boxes."""
    apart = np.maximum(0, np.maximum(low_b - high_a, low_a - high_b))
    return float(np.sqrt(apart @ apart))


def near_leaves(a: Sequence, b: Sequence, same: bool, reach: float) -> Iterator[tuple[slice, slice]]:
    """Recursively join two sequence intervals: halve the longer one, drop what is provably distant."""
    stack = [(0, len(a.nodes), 0, len(b.nodes))]
    while stack:
        i, j, k, m = stack.pop()
        if (same and k + (m - k) <= i) or box_gap(*a.box(i, j), *b.box(k, m)) > reach:
            continue
        if j - i <= LEAF and m - k <= LEAF:
            yield slice(i, j), slice(k, m)
        elif j - i >= m - k:
            half = i + LEAF * max(1, (j - i) // LEAF // 2)
            stack += [(i, half, k, m), (half, j, k, m)]
        else:
            half = k + LEAF * max(1, (m - k) // LEAF // 2)
            stack += [(i, j, k, half), (i, j, half, m)]


def close_pairs(a: Sequence, left: slice, b: Sequence, right: slice, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two leaves whose cosine is ``least`` or more.

    The leading dimensions' part of a product and the lengths of what is left of the two vectors bound it, so
    the whole product is taken only of pairs that the bound leaves.
    """
    wide = right.stop - right.start
    at = np.flatnonzero(a.sketch[left] @ b.sketch[right].T >= np.float32(least - SLACK))
    if dense := len(at) > DENSE * wide * (left.stop - left.start):
        at = np.flatnonzero(a.x[left] @ b.x[right].T >= least)
    i, j = at // wide + left.start, at % wide + right.start
    if dense or not len(at):
        return i, j
    close = np.einsum("ij,ij->i", a.x[i], b.x[j]) >= least
    return i[close], j[close]


def _join(axes: np.ndarray, kind: str, least: float, reach: float):
    """Links between two blocks: per vector how many, and one member of its group inside the two."""

    def pair(a: Sequence, b: Sequence, same: bool) -> pd.DataFrame:
        offset = 0 if same else len(a.nodes)
        nodes = a.nodes if same else np.r_[a.nodes, b.nodes]
        links, groups = np.zeros(len(nodes), np.int64), Unions(len(nodes))
        for left, right in near_leaves(a, b, same, reach):
            i, j = close_pairs(a, left, b, right, least)
            if same:  # each unordered pair once
                i, j = i[i < j], j[i < j]
            if not len(i):
                continue
            np.add.at(links, i, b.copies[j])
            np.add.at(links, j + offset, a.copies[i])
            groups.add(i, j + offset)
        hit = np.flatnonzero(links)
        return pd.DataFrame({"node": nodes[hit], "links": links[hit], "root": nodes[groups.roots()[hit]]})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks = Blocks(axes, kind)
        for frame in frames:
            for row in frame.to_dict("records"):
                a = blocks.get(mounted(row["at_a"]), row["a"])
                same = row["a"] == row["b"]
                yield pair(a, a if same else blocks.get(mounted(row["at_b"]), row["b"]), same)

    return run


def near_blocks(blocks: DataFrame, reach: float) -> DataFrame:
    """Pairs ``(a, b)``, a <= b, of blocks whose boxes are within reach.

    Boxes are matched on the grid cells of the first principal dimension and then compared on all.
    """
    cell = lambda c: F.floor(F.get(c, F.lit(0)) / F.lit(reach)).cast("int")
    boxes = blocks.select("block", "low", "high")
    left = boxes.select(
        F.col("block").alias("a"), F.col("low").alias("la"), F.col("high").alias("ha"), F.explode(F.sequence(cell("low"), cell("high"))).alias("cell")
    )
    right = boxes.select(
        F.col("block").alias("b"), F.col("low").alias("lb"), F.col("high").alias("hb"), F.explode(F.sequence(cell("low") - 1, cell("high") + 1)).alias("cell")
    )
    gap = lambda l, h: F.zip_with(l, h, lambda x, y: F.greatest(x - y, F.lit(0.0)))  # noqa: E731, E741
    apart = F.aggregate(
        F.zip_with(gap("lb", "ha"), gap("la", "hb"), lambda x, y: F.greatest(x, y)), F.lit(0.0), lambda s, g: s + g * g
    )
    return left.join(right, "cell").filter("a <= b").filter(apart <= reach * reach).select("a", "b").distinct()


def link_vectors(embeddings: DataFrame, threshold: float = 0.95) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``embeddings``.

    Two vectors of the same length are linked when their cosine, in double precision, is ``threshold``
    or more. Equal vectors become one class: copies leave a batch of rows as one, and the others meet in
    the sort (a vector that a third of all rows share costs one row per batch), so copies are never
    expanded into pairs. The classes are sorted by grid cells of width epsilon (the distance of unit
    vectors at the threshold) on the leading principal dimensions and cut into blocks; pairs of blocks
    within epsilon are joined by recursion into shorter and shorter intervals. Vectors are shuffled by
    that sort alone: a task reads the blocks of its pairs from the files they were written to, so the
    folder of intermediate tables must be mounted on every worker. Tasks pass on counts and group
    members, not links.

    Null and zero vectors and those with null or non-finite components link with nothing and are their
    own component. ``n_links`` counts rows, so repeated rows link to each other; ``component_id`` is the
    smallest id reachable. A null id is kept as an id of its own only where no other id is reachable.
    """
    scratch = Scratch(embeddings.sparkSession)
    valid = F.coalesce(
        F.size("embedding") > 0, F.lit(False)
    ) & F.coalesce(
        F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
        & F.exists("embedding", lambda v: v != 0),
        F.lit(False),
    )
    keyed = embeddings.select(
        "vec_id",
        F.when(valid, F.xxhash64("embedding")).alias("k1"),
        F.when(valid, F.xxhash64(F.lit(7), "embedding")).alias("k2"),
        "embedding",
    )
    # What any vector is kept as is what it comes as.
    kind, stored = ("float32", "float") if dict(embeddings.dtypes)["embedding"] == "array<float>" else ("float64", "double")
    sound = keyed.filter("k1 is not null").select(
        "k1",
        "k2",
        F.coalesce(F.col("vec_id").cast("long"), F.lit(LAST)).alias("id"),
        F.col("vec_id").isNotNull().alias("named"),
        F.col("embedding").cast(f"array<{stored}>").alias("embedding"),
    )
    found = classes = None
    # Lengths of vectors: one in practice.
    sizes = [r["n"] for r in sound.select(F.size("embedding").alias("n")).distinct().sort("n").collect()]
    for rank, n in enumerate(sizes):
        parts = _link_classes(sound.filter(F.size("embedding") == n), n, threshold, scratch, kind, rank, 63 - len(sizes).bit_length())
        classes, found = parts if found is None else (classes.union(parts[0]), found.union(parts[1]))
    if found is None:
        classes = sound.select("k1", "k2", F.col("id").alias("first_id"), F.lit(1).cast("long").alias("copies"), F.lit(0).cast("long").alias("node"))
        found = classes.select("node", F.lit(0).cast("long").alias("links"), F.col("node").alias("root"))
    found = scratch.keep(found)
    groups = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), scratch)
    counted = found.groupBy(F.col("node").alias("n1")).agg(F.sum("links").alias("links"))
    placed = scratch.keep(
        classes.join(counted, F.col("node") == F.col("n1"), "left")
        .join(groups.withColumnRenamed("node", "n2"), F.col("node") == F.col("n2"), "left")
        .select("k1", "k2", "first_id", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "node").alias("component"))
    )
    least = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    per_class = placed.join(least, "component").select("k1", "k2", (F.col("links") + F.col("copies") - 1).alias("n"), "component_id")
    return (
        keyed.drop("embedding")
        .join(per_class, ["k1", "k2"], "left")
        .select(
            "vec_id",
            F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "vec_id").cast("long").alias("component_id"),
            F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id")).alias("kept"),
        )
    )


def _link_classes(rows: DataFrame, size: int, threshold: float, scratch: Scratch, kind: str, rank: int, room: int) -> tuple[DataFrame, DataFrame]:
    """``(k1, k2, first_id, copies, node)`` of the classes of one vector length, and their ``(node, links, root)``."""
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9)
    axes = principal_axes(rows.select("embedding"), size)
    leading = [f"c{i}" for i in range(min(LEADING, size))]
    order = [*leading, "k1", "k2"]
    cells = rows.mapInPandas(
        _cells(axes, reach, kind), "k1 long, k2 long, id long, named boolean, copies long, x binary, " + ", ".join(f"{c} int" for c in leading)
    )
    cut = (
        cells.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("k1", "k2", "id", "named", "copies", "x")
        .mapInPandas(
            _blocks(axes, kind, rank, room),
            "block long, low array<double>, high array<double>, nodes array<long>, k1 array<long>, k2 array<long>, "
            "id array<long>, named array<boolean>, copies array<long>, x binary",
        )
    )
    # A row group per block: one is read without the others.
    blocks = scratch.keep(cut, options={"parquet.block.row.count.limit": 1})
    each = blocks.select(F.explode(F.arrays_zip("k1", "k2", "id", "named", "copies", "nodes")).alias("c"))
    classes = each.select("c.k1", "c.k2", F.when(F.col("c.named"), F.col("c.id")).alias("first_id"), "c.copies", F.col("c.nodes").alias("node"))
    at = blocks.select("block", F.col("_metadata.file_path").alias("at"))
    pairs = scratch.keep(near_blocks(blocks, reach))
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(pairs.count() / PAIRS))
    work = (
        pairs.join(at.toDF("a", "at_a"), "a")
        .join(at.toDF("b", "at_b"), "b")
        .repartitionByRange(parts, "a", "b")
        .sortWithinPartitions("a", "b")
    )
    return classes, work.mapInPandas(_join(axes, kind, threshold, reach), "node long, links long, root long")

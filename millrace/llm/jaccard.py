"""Near-duplicate documents: a chosen-path similarity join on the Jaccard similarity of word shingles."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.unions import Unions
from millrace.llm.work import Scratch, words

# Words of a shingle, the least similarity of a link, the tokens of a path.
SHINGLE, SIMILARITY, DEPTH = 5, 0.8, 4
# The share of pairs at exactly that similarity that runs are repeated for; more similar pairs have more.
RECALL = 0.995
# Classes whose sketches are compared with each other at once; larger buckets are cut up by leaders.
SMALL = 2048
# Bits of a sketch that agree for sets this alike: (1 + J) / 2 of 128, less some four deviations.
SKETCH_BITS, ALIKE = 128, 102
# A class may stand for another one on a path when their sketches agree in this many bits.
SAME = 124
# Bins a sketch's rounds should throw tokens into at a time (rounds of few tokens are done together).
THROWN = 1024
# Classes of a cluster in one chunk, and shingles compared at once, in verification.
CHUNK, SLICE, FREQUENT = 1024, 4096, 24
# More ids than this are joined by a shuffle instead of a broadcast; the rows are the same.
BROADCAST_IDS = 2_000_000
M1, M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
FULL = 2.0**64


@dataclass(frozen=True)
class Plan:
    """Similarity, depth and how often the paths are drawn."""

    similarity: float = SIMILARITY
    depth: int = DEPTH
    recall: float = RECALL

    @property
    def runs(self) -> int:
        """Runs until a pair at the threshold shares a path with probability ``recall``.

        Each shared token extends a path with probability 1 / (similarity * larger set), so at the
        threshold a shared path has one shared extension on average: a critical branching process
        with Poisson offspring, whose survival to ``depth`` is what one run finds.
        """
        alive = 1.0
        for _ in range(self.depth):
            alive = 1 - math.exp(-alive)
        return math.ceil(math.log(1 - self.recall) / math.log(1 - alive))


def scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * M1
    h = (h ^ (h >> np.uint64(33))) * M2
    return h ^ (h >> np.uint64(33))


def chosen_paths(tokens: np.ndarray, plan: Plan) -> np.ndarray:
    """Hashes of the paths a set of distinct tokens chooses, over all runs.

    A path takes a token when the pair's hash is below 1 / (similarity * set size): two sets that share
    a path's tokens both choose it, if the larger one does.
    """
    share = 1 / (plan.similarity * len(tokens))
    limit = np.uint64(min(FULL - 2048, share * FULL))
    paths = scramble(np.arange(1, plan.runs + 1, dtype=np.uint64) * M1)
    step = max(1, (1 << 22) // max(1, len(paths)))
    for level in range(plan.depth):
        found = []
        for at in range(0, len(tokens), step):
            part = tokens[at : at + step]
            key = scramble(paths[:, None] ^ (part * M2 + np.uint64(level + 1))[None, :])
            row, _ = np.nonzero(key < limit) if share < 1 else np.nonzero(np.ones(key.shape, bool))
            picked = key[key < limit] if share < 1 else key.ravel()
            found.append(scramble(picked + paths[row]))
        paths = np.concatenate(found)
        if not len(paths):
            break
    return np.unique(paths)


def sketch(tokens: np.ndarray) -> np.ndarray:
    """128 one-bit values of bins that hold a set's least token of the first round that reaches them.

    Each round throws all tokens into the bins anew, so bins that few tokens leave empty are filled by
    later rounds. The first token that two sets' union has in a bin is common to both with the sets'
    Jaccard similarity, whatever their sizes: short sets agree as independently as long ones.
    """
    least = np.full(SKETCH_BITS, np.uint64(2**64 - 1))
    together = max(1, THROWN // len(tokens))
    first = 0
    while (least >> np.uint64(48) == 0xFFFF).any() and first < 0xFFFF:
        rounds = np.arange(first, min(0xFFFF, first + together), dtype=np.uint64)
        h = scramble((tokens ^ M2)[None, :] + rounds[:, None] * M1).ravel()
        value = (np.repeat(rounds, len(tokens)) << np.uint64(48)) | ((h << np.uint64(7)) >> np.uint64(16))
        np.minimum.at(least, (h >> np.uint64(57)).astype(np.intp), value)
        first += together
    bits = (scramble(least + np.arange(SKETCH_BITS, dtype=np.uint64) * M1) >> np.uint64(40)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8)).view(np.uint64)


def classed_words(docs: DataFrame) -> DataFrame:
    """``doc_id, h, k1, tokens``: text hash, class (equal words; null without words), word hashes."""
    hashed = docs.select(
        "doc_id", F.xxhash64("text").alias("h"), F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("tokens")
    )
    return hashed.select("doc_id", "h", F.when(F.size("tokens") > 0, F.xxhash64("tokens")).alias("k1"), "tokens")


def shingle_hashes(words_: np.ndarray) -> np.ndarray:
    """Distinct shingles of some words; fewer words than a shingle, but not none, are one shingle."""
    size = min(SHINGLE, len(words_))
    n = len(words_) - size + 1
    out = np.full(n, np.uint64(size))
    for k in range(size):
        out = scramble(out + words_[k : k + n])
    return np.unique(out)


def _token_rows(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    column = batch.column("tokens")
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).view(np.uint64)
    for i in range(batch.num_rows):
        yield i, shingle_hashes(values[offsets[i] : offsets[i + 1]])


# A row is a class on a path with its sketch, or (with a root) a link found before the shuffle.
PATHS = "path long, node long, s0 long, s1 long, root long"
# On a path met this often by one task's batch, members whose sketch all but equals a former one's are
# linked to that one, which alone goes on to the path's bucket. What is alike one of them agrees with
# the other in four bits less at most, which a pair at the threshold falls short of in 0.5 % of cases.
OFTEN = 64


def _paths(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # classes of this task; equal ones choose equal paths
        for batch in batches:
            names = batch.column("k1").to_pylist()
            paths, nodes, sketches = [], [], []
            for i, tokens in _token_rows(batch):
                if names[i] not in seen:
                    seen.add(names[i])
                    paths.append(chosen_paths(tokens, plan))
                    nodes.append(np.full(len(paths[-1]), names[i], np.int64))
                    sketches.append(np.repeat(sketch(tokens)[None, :], len(paths[-1]), axis=0))
            if paths:
                yield _combined(np.concatenate(paths).view(np.int64), np.concatenate(nodes), np.concatenate(sketches))

    return run


def _combined(path: np.ndarray, node: np.ndarray, sketches: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(path, kind="stable")
    path, node, sketches = path[order], node[order], sketches[order]
    cuts, sizes = _runs(path)
    keep, left, right = np.ones(len(path), bool), [], []
    for at, n in zip(cuts[sizes >= OFTEN], sizes[sizes >= OFTEN], strict=True):
        root = stand_ins(sketches[at : at + n])
        moved = np.flatnonzero(root != np.arange(n))
        keep[at + moved] = False
        left.append(node[at + moved])
        right.append(node[at + root[moved]])
    links = _distinct_pairs(left, right)
    pad = np.zeros(len(links), np.int64)
    s = sketches[keep].view(np.int64)
    columns = [
        np.r_[path[keep], scramble(links[:, 0].view(np.uint64)).view(np.int64)],
        np.r_[node[keep], links[:, 0]],
        np.r_[s[:, 0], pad],
        np.r_[s[:, 1], pad],
    ]
    root = pa.concat_arrays([pa.nulls(int(keep.sum()), pa.int64()), pa.array(links[:, 1])])
    return pa.RecordBatch.from_arrays([*map(pa.array, columns), root], names=["path", "node", "s0", "s1", "root"])


def _runs(path: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values."""
    cuts = np.flatnonzero(np.r_[len(path) > 0, path[1:] != path[:-1]])
    return cuts, np.diff(np.r_[cuts, len(path)])


def _grouped(sketches: np.ndarray) -> np.ndarray:
    """Per member of a bucket, the first member of its group."""
    unions = Unions(len(sketches))
    unions.add(*alike(sketches))
    return unions.roots()


def _distinct_pairs(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    if not left:
        return np.zeros((0, 2), np.int64)
    pairs = np.c_[np.concatenate(left), np.concatenate(right)]
    return np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)


def agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal bits of each sketch of ``a`` with each of ``b``."""
    differ = np.bitwise_count(a[:, None, 0] ^ b[None, :, 0]).astype(np.int16) + np.bitwise_count(a[:, None, 1] ^ b[None, :, 1])
    return SKETCH_BITS - differ


def stand_ins(sketches: np.ndarray) -> np.ndarray:
    """Per member, the former member that stands for it (itself, if none is the same but for few bits)."""
    out = np.arange(len(sketches))
    for at in range(0, len(sketches), SMALL):
        same = agreement(sketches[at : at + SMALL], sketches[at : at + SMALL]) >= SAME
        free = np.ones(len(same), bool)
        for i in np.flatnonzero(np.triu(same, 1).any(axis=1)):
            if free[i]:
                took = np.flatnonzero(same[i, i + 1 :] & free[i + 1 :]) + i + 1
                free[took] = False
                out[at + took] = at + i
    return out


def alike(sketches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all members of a bucket whose sketches agree in ``ALIKE`` bits.

    Small buckets: all pairs. Large ones: every member belongs to a leader it is alike. Differing bits
    are a metric, so what is alike a member agrees with the member's leader in 2 * ALIKE - SKETCH_BITS
    bits; the members of a leader are compared with those alone.
    """
    n = len(sketches)
    if n <= SMALL:
        return np.nonzero(np.triu(agreement(sketches, sketches) >= ALIKE, 1))
    leader = np.full(n, -1)
    left, right = [], []
    while (leader < 0).any():
        first = int(np.argmax(leader < 0))
        with_first = agreement(sketches, sketches[first : first + 1])[:, 0]
        own = np.flatnonzero((leader < 0) & (with_first >= ALIKE))
        # Members of former leaders were compared with all that can be alike them when theirs was made.
        others = np.flatnonzero((leader < 0) & (with_first < ALIKE) & (with_first >= 2 * ALIKE - SKETCH_BITS))
        leader[own] = first
        left.append(own)
        right.append(np.full(len(own), first))
        for a in range(0, len(own), SMALL):
            for b in range(0, len(others), SMALL):
                i, j = np.nonzero(agreement(sketches[own[a : a + SMALL]], sketches[others[b : b + SMALL]]) >= ALIKE)
                some = np.unique(j, return_index=True)[1]  # one link to the leader's members is enough
                left.append(own[a + i[some]])
                right.append(others[b + j[some]])
    return np.concatenate(left), np.concatenate(right)


def bucket_links(path: np.ndarray, node: np.ndarray, sketches: np.ndarray) -> np.ndarray:
    """Links that connect the alike members of each bucket of rows sorted by path."""
    cuts, sizes = _runs(path)
    left, right = [], []
    for size in range(2, 9):
        rows = cuts[sizes == size][:, None] + np.arange(size)
        for i in range(size):
            for j in range(i + 1, size):
                differ = np.bitwise_count(sketches[rows[:, i]] ^ sketches[rows[:, j]]).sum(axis=1, dtype=int)
                near = rows[SKETCH_BITS - differ >= ALIKE]
                left.append(node[near[:, i]])
                right.append(node[near[:, j]])
    for at, n in zip(cuts[sizes > 8], sizes[sizes > 8], strict=True):
        own = node[at : at + n]
        left.append(own)
        right.append(own[_grouped(sketches[at : at + n])])
    return _distinct_pairs(left, right)


def _buckets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of a partition sorted by path. A bucket that goes on in the next frame waits for it."""
    rest = None
    for frame in frames:
        done = frame[frame["root"].notna()]
        if len(done):
            yield pd.DataFrame({"a": done["node"], "b": done["root"].astype("int64")})
        rows = frame[frame["root"].isna()]
        rows = rows if rest is None else pd.concat([rest, rows], ignore_index=True)
        if len(rows):
            cut = int(np.searchsorted(rows["path"].to_numpy(), rows["path"].iloc[-1]))
            rest = rows.iloc[cut:]
            yield _links_of(rows.iloc[:cut])
    if rest is not None:
        yield _links_of(rest)


def _links_of(rows: pd.DataFrame) -> pd.DataFrame:
    sketches = rows[["s0", "s1"]].to_numpy(np.int64).view(np.uint64)
    links = bucket_links(rows["path"].to_numpy(), rows["node"].to_numpy(np.int64), sketches)
    return pd.DataFrame({"a": links[:, 0], "b": links[:, 1]})


def candidate_links(classed: DataFrame, plan: Plan) -> DataFrame:
    """``(a, b)``: classes that share a path and look alike, enough of them to connect each cluster."""
    paths = classed.filter("k1 is not null").select("k1", "tokens").mapInArrow(_paths(plan), PATHS)
    bucketed = paths.repartition(F.col("path")).sortWithinPartitions("path", "node")
    return bucketed.mapInPandas(_buckets, "a long, b long").distinct()


def _pack_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [t.tobytes() for _, t in _token_rows(batch)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("k1"), batch.column("cluster"), batch.column("copies"), batch.column("members"), pa.array(sets, pa.binary())],
            names=["node", "cluster", "copies", "members", "tokens"],
        )


def intersections(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """Common tokens of each left set with each right set (or of the left sets with each other)."""
    sets = left + (right or [])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    cuts = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
    sizes = np.diff(np.r_[cuts, len(flat)])
    n = len(sets)
    counts = np.zeros((n, n), np.float32 if n * n > 16 else np.float64)
    # Rare tokens: add up their pairs. Frequent ones: a product of 0/1 matrices, some tokens at a time.
    for size in np.unique(sizes[(sizes > 1) & (sizes < FREQUENT)]):
        at = cuts[sizes == size]
        members = owner[at[:, None] + np.arange(size)[None, :]]
        for i in range(size):
            for j in range(i + 1, size):
                np.add.at(counts, (members[:, i], members[:, j]), 1)
    common = np.flatnonzero(sizes >= FREQUENT)
    for start in range(0, len(common), SLICE):
        some = common[start : start + SLICE]
        grid = np.zeros((n, len(some)), np.float32)
        for k, t in enumerate(some):
            grid[owner[cuts[t] : cuts[t] + sizes[t]], k] = 1
        both = grid @ grid.T
        counts += np.triu(both, 1)
    counts = counts + counts.T
    return counts[: len(left), len(left) :] if right is not None else counts


def _verify(similarity: float):
    """Exact Jaccard similarities inside a unit of clusters or between two chunks of one."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, rows in frame.groupby("cluster"):
            sets = [np.frombuffer(t, np.uint64) for t in rows["tokens"]]
            side = rows["side"].to_numpy()
            nodes, copies = rows["node"].to_numpy(), rows["copies"].to_numpy()
            sizes = np.array([len(s) for s in sets])
            two = (side == 1).any() and (side == 0).any()
            a = np.flatnonzero(side == 0) if two else np.arange(len(rows))
            b = np.flatnonzero(side == 1) if two else a
            common = intersections([sets[i] for i in a], [sets[i] for i in b] if two else None)
            need = similarity / (1 + similarity) * (sizes[a][:, None] + sizes[b][None, :]) - 1e-6
            near = common >= need
            if not two:
                np.fill_diagonal(near, False)
            i, j = np.nonzero(near)
            i, j = a[i], b[j]
            links = np.zeros(len(rows), np.int64)
            np.add.at(links, i, copies[j])
            if two:
                np.add.at(links, j, copies[i])
            unions = Unions(len(rows))
            unions.add(i, j)
            hit = np.flatnonzero(links)
            out.append(pd.DataFrame({"node": nodes[hit], "links": links[hit], "root": nodes[unions.roots()[hit]]}))
        return pd.concat(out, ignore_index=True)

    return run


def verified_links(docs: DataFrame, classes: DataFrame, clusters: DataFrame, plan: Plan, scratch: Scratch) -> DataFrame:
    """``(node, links, root)``: rows linked to a class, and a member of its group.

    Every class of a cluster is sent with its whole set, once to a unit of small clusters or to each
    pair of chunks of a large one, so no task holds more than two chunks or a bounded unit.
    """
    sized = clusters.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    members = scratch.keep(
        clusters.join(sized, "component")
        .join(classes.withColumnRenamed("k1", "node"), "node")
        .select("node", F.col("component").alias("cluster"), "members", "copies", "first")
    )
    firsts = members.select("first.doc_id", "first.h")
    small = firsts.count() <= BROADCAST_IDS
    same = lambda l, r: l["doc_id"].eqNullSafe(r["doc_id"]) & (l["h"] == r["h"])  # noqa: E731, E741
    texts = docs.select("doc_id", F.xxhash64("text").alias("h"), "text")
    ids = F.broadcast(firsts) if small else firsts
    chosen = texts.join(ids, same(texts, ids), "left_semi").select("doc_id", "text")
    sets = classed_words(chosen).select("k1", "tokens").dropDuplicates(["k1"])
    packed = scratch.keep(
        sets.join(members.withColumnRenamed("node", "k1"), "k1")
        .select("k1", "cluster", "copies", "members", "tokens")
        .mapInArrow(_pack_sets, "node long, cluster long, copies long, members long, tokens binary")
    )
    chunks = F.ceil(F.col("members") / F.lit(CHUNK)).cast("int")
    units = max(1, -(-(members.count()) // CHUNK))
    own = F.pmod(F.xxhash64("node"), chunks).cast("int")
    spread = (
        packed.withColumn("chunks", chunks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            "node",
            "cluster",
            "copies",
            "tokens",
            F.when(F.col("chunks") == 1, F.pmod(F.xxhash64("cluster"), F.lit(units))).otherwise(F.col("cluster")).alias("unit"),
            F.when(F.col("chunks") == 1, -1).otherwise(F.least("own", "other")).alias("i"),
            F.when(F.col("chunks") == 1, -1).otherwise(F.greatest("own", "other")).alias("j"),
            F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"),
        )
    )
    return scratch.keep(
        spread.groupBy("unit", "i", "j").applyInPandas(_verify(plan.similarity), "node long, links long, root long")
    )


def near_duplicates(docs: DataFrame, plan: Plan | None = None) -> DataFrame:
    """``doc_id, n_links, class_id, component_id, kept`` for every row of ``docs``.

    Texts are sets of shingles of five words (lower-cased letters, digits and non-ASCII characters).
    Rows with equal words are one class from the first shuffle on. Each class draws its chosen paths,
    classes with equal paths are compared by sketches inside the path's bucket, and what looks alike
    forms clusters in which all pairs are compared by exact Jaccard similarity, in chunks. Two texts
    with a similarity of ``plan.similarity`` or more are linked; a pair at exactly that similarity
    shares no path with a probability of at most 1 - ``plan.recall``, a more similar one with less. Sketches
    lose less than 0.1 % of such pairs, whatever their length, and stand-ins on paths that one batch
    meets ``OFTEN`` times another 0.5 % at most.

    ``n_links`` counts linked rows, copies included; ``class_id`` is the smallest id with equal words,
    ``component_id`` the smallest id reachable by links; ``kept`` marks the row that stays of each group.
    Texts without words (null, empty, signs only) link with nothing. Repeated rows link to each other,
    and all rows with the group's smallest id are kept; a null id is kept only where nothing else is
    reachable.
    """
    return _judged(docs, plan or Plan()).drop("h")


def _judged(docs: DataFrame, plan: Plan) -> DataFrame:
    """The rows of ``near_duplicates`` with the text hash ``h``."""
    scratch = Scratch(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    classed = classed_words(rows)
    keys = scratch.keep(classed.select("doc_id", "h", "k1"))
    classes = scratch.keep(
        keys.filter("k1 is not null").groupBy("k1").agg(F.min(F.struct("doc_id", "h")).alias("first"), F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("copies"))
    )
    links = scratch.keep(candidate_links(classed, plan))
    clusters = scratch.keep(components(links, scratch))
    verified = verified_links(rows, classes, clusters, plan, scratch)
    groups = components(verified.select(F.col("node").alias("a"), F.col("root").alias("b")), scratch)
    counted = verified.groupBy(F.col("node").alias("n1")).agg(F.sum("links").alias("links"))
    placed = scratch.keep(
        classes.join(counted, F.col("k1") == F.col("n1"), "left")
        .join(groups, F.col("k1") == F.col("node"), "left")
        .select("k1", "class_id", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "k1").alias("component"))
    )
    least = placed.groupBy("component").agg(F.min("class_id").alias("component_id"))
    per_class = placed.join(least, "component").select("k1", "class_id", "component_id", (F.col("links") + F.col("copies") - 1).alias("n"))
    return keys.join(per_class, "k1", "left").select(
        "doc_id",
        "h",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("component_id", "doc_id")).alias("kept"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` less those that are near duplicates of one with a smaller id.

    A row is found again by id and text, so rows with the same id (or none) and other texts are judged apart.
    """
    dropped = _judged(docs, Plan()).filter(~F.col("kept")).select(F.col("doc_id").alias("__id"), F.col("h").alias("__h")).distinct()
    same = docs["doc_id"].eqNullSafe(F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__h"))
    return docs.join(dropped, same, "left_anti")

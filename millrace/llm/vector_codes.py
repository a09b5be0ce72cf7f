"""Vectors as short codes: one codebook entry per part, codebooks by integer Lloyd rounds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.work import Scratch

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
# Integer components are held within this bound, and one part's squared distance within the other, so
# that no sum leaves the long range; vectors of ordinary scale come nowhere near either.
LARGEST, FARTHEST = 1 << 40, (1 << 61) - 1
# Up to this many labels are joined by a broadcast; more by a shuffle of both sides. The rows are the same.
BROADCAST_LABELS = 1_000_000
NEW = -1


def squared_distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to integer entries: doubles, or Python's integers beyond 2**53."""
    top = max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))
    exact = 4 * int(top) ** 2 * x.shape[1] < 1 << 53
    x, entries = (v.astype(np.float64 if exact else object) for v in (x, entries))
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(axis=1)


def _rows_of(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)


def nearest(books: np.ndarray):
    """Batches of members with their nearest entry (the lower one of equals), its distance, and whether they move."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            position = batch.column("position").to_numpy()
            x = _rows_of(batch, "x", books.shape[2])
            entry, far = np.zeros(len(x), np.int32), np.zeros(len(x), np.int64)
            for p in range(PARTS):
                at = np.flatnonzero(position == p)
                if len(at):
                    d = squared_distances(x[at], books[p])
                    entry[at] = d.argmin(axis=1)
                    far[at] = np.minimum(d[np.arange(len(at)), entry[at]], FARTHEST)
            moved = entry != batch.column("entry").to_numpy()
            keep = [batch.column(c) for c in ("row", "vec_id", "label", "position")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(entry), batch.column("x"), pa.array(far), pa.array(moved)],
                [*MEMBER, "distance", "moved"],
            )

    return run


MEMBER = ("row", "vec_id", "label", "position", "entry", "x")


def _sums(width: int):
    """Per task, the member count and the component sums of every entry it owns a share of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((PARTS * ENTRIES, width), np.int64)
        count = np.zeros(PARTS * ENTRIES, np.int64)
        for batch in batches:
            owner = batch.column("position").to_numpy() * ENTRIES + batch.column("entry").to_numpy()
            order = np.argsort(owner, kind="stable")
            owners, first, n = np.unique(owner[order], return_index=True, return_counts=True)
            if len(owners):
                total[owners] += np.add.reduceat(_rows_of(batch, "x", width)[order], first, axis=0)
                count[owners] += n
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array((used // ENTRIES).astype(np.int32)),
                pa.array((used % ENTRIES).astype(np.int32)),
                pa.array(count[used]),
                pa.array(list(total[used]), pa.list_(pa.int64())),
            ],
            ["position", "entry", "n", "sums"],
        )

    return run


def _updated(members: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks whose used entries are the floor means of their members.

    Every task adds up the members that reside with it; the few sums per entry meet in one small
    aggregate. What the driver gets are the codebooks, whose size is fixed.
    """
    parts = members.select("position", "entry", "x").mapInArrow(
        _sums(books.shape[2]), "position int, entry int, n long, sums array<long>"
    )
    sums = (
        parts.select("position", "entry", "n", F.posexplode("sums").alias("i", "s"))
        .groupBy("position", "entry", "i")
        .agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    )
    out = books.copy()
    for r in sums.collect():
        out[r["position"], r["entry"], r["i"]] = r["s"] // r["n"]
    return out


def _salt(loads: DataFrame, partitions: int) -> Column:
    """How a member's owner is split: an entry is cut into as many owners as it fills partitions.

    ``loads`` has one row per entry at most, however many members there are.
    """
    rows = {(r["position"], r["entry"]): r["n"] for r in loads.collect()}
    share = max(1, sum(rows.values()) // partitions)
    owners = [min(partitions, max(1, -(-rows.get((k // ENTRIES, k % ENTRIES), 0) // share))) for k in range(PARTS * ENTRIES)]
    listed = F.split(F.lit(",".join(map(str, owners))), ",")
    n = F.get(listed, F.col("position") * ENTRIES + F.col("entry")).cast("int")
    return F.pmod(F.xxhash64("row"), n)


def _rehome(members: DataFrame, books: np.ndarray, scratch: Scratch, partitions: int) -> DataFrame:
    """Members under the entry that is now nearest; only those that change it are shuffled.

    The assignment is written where it is computed, movers apart from stayers. Stayers are read back
    from there; movers go to the owner of their position, entry and salt.
    """
    schema = T.StructType([*members.select(*MEMBER).schema.fields, T.StructField("distance", T.LongType()), T.StructField("moved", T.BooleanType())])
    assigned = scratch.keep(members.select(*MEMBER).mapInArrow(nearest(books), schema), "moved")
    stayers, movers = assigned.filter(~F.col("moved")), assigned.filter("moved")
    loads = assigned.groupBy("position", "entry").agg(F.count(F.lit(1)).alias("n"))
    arrivals = scratch.keep(movers.select(*MEMBER).repartition("position", "entry", _salt(loads, partitions)))
    return stayers.select(*MEMBER).unionByName(arrivals)


@dataclass
class Codes:
    """``rows`` (row, vec_id, label, code, error) and the codebooks, as ``[part, entry, component]``."""

    rows: DataFrame
    books: np.ndarray


def compress(vectors: DataFrame, rounds: int = ROUNDS) -> Codes:
    """Vectors as ``PARTS`` entry numbers each, by codebooks of at most ``ENTRIES`` entries a part.

    Member-resident Lloyd rounds: parts live with the owner of their entry, owners update it from the
    members they hold, and only parts whose nearest entry has changed travel to another owner. A hot
    entry has several owners, in proportion to its members. All arithmetic is on integers, so results
    do not depend on the order or the tasks in which sums are taken.

    A component counts as ``floor(1024 * x)``, within ``LARGEST``. Null vectors and those with null, NaN
    or infinite components are left out. Vectors are cut into equal parts; shorter ones than the
    longest, or a length that does not divide, count as ending in zeros (an empty one is all zeros). The
    first entries are the parts of the rows with the smallest ids; equal ids are ordered by their
    vectors, null ids come last, and fewer rows make fewer entries. Equal vectors get equal codes.
    ``row`` tells repeated ids apart. A missing ``label`` column counts as nulls; others are ignored; an
    empty table has no rows.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sound = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    whole = F.transform(
        "embedding",
        lambda v: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(v.cast("double") * SCALE))),
    )
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int")
    # Written first: the row numbers stay the same from here on.
    kept = scratch.keep(
        vectors.filter(F.col("embedding").isNotNull() & F.coalesce(sound, F.lit(False))).select(
            F.monotonically_increasing_id().alias("row"), "vec_id", label.alias("label"), whole.alias("v")
        )
    )
    longest = kept.agg(F.max(F.size("v"))).first()[0] or 0
    width = -(-longest // PARTS)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).select("v").collect()
    books = np.zeros((PARTS, len(first), width), np.int64)
    for e, r in enumerate(first):
        books[:, e] = np.array([*r["v"], *[0] * (PARTS * width - len(r["v"]))], np.int64).reshape(PARTS, width)
    padded = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(PARTS * width) - F.size("v")))
    cut = F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda p: F.slice("v", p * width + 1, F.lit(width)))
    members = (
        kept.withColumn("v", padded)
        .select("row", "vec_id", "label", F.posexplode(cut).alias("position", "x"))
        .select("row", "vec_id", "label", "position", F.lit(NEW).alias("entry"), "x")
    )
    for _ in range(rounds if first else 0):
        members = _rehome(members, books, scratch, partitions)
        books = _updated(members, books)
    schema = T.StructType([*members.schema.fields, T.StructField("distance", T.LongType()), T.StructField("moved", T.BooleanType())])
    final = members.mapInArrow(nearest(books), schema)
    numbers = [F.max(F.when(F.col("position") == p, F.col("entry"))) for p in range(PARTS)]
    code = F.concat(*[F.lower(F.lpad(F.hex(n), 2, "0")) for n in numbers])
    rows = final.groupBy("row", "vec_id", "label").agg(code.alias("code"), F.sum("distance").alias("error"))
    return Codes(scratch.keep(rows), books)


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def digest(codes: Codes) -> DataFrame:
    """Codes and errors, the error of each row's label (nulls are one label), and the codebooks' hash."""
    rows = codes.rows
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    errors = rows.groupBy(F.col("label").alias("of")).agg(
        F.least(F.sum(F.col("error").cast("decimal(28,0)")), most).cast("long").alias("label_error")
    )
    if errors.count() <= BROADCAST_LABELS:
        errors = F.broadcast(errors)
    return rows.join(errors, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books_sha256(codes.books)).alias("codebooks_sha256")
    )


def oracle(rounds: int = ROUNDS) -> str:
    """The digest of ``embeddings`` in DuckDB SQL."""
    steps = [
        f"""kept as materialized (select row_number() over () as row, vec_id, label,
  list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as v from embeddings
 where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
        f"dim as (select cast(ceil(max(len(v)) / {PARTS}) as bigint) as w from kept)",
        f"""members as materialized (select row, p, cast(list_resize(v, {PARTS} * w, 0)[p * w + 1:(p + 1) * w] as double[]) as x
 from kept, dim, range({PARTS}) t(p))""",
        f"""book0 as materialized (select p, e, m.x as c
 from (select row, row_number() over (order by vec_id, v) - 1 as e from kept order by vec_id, v limit {ENTRIES}) f
 join members m using (row))""",
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""near{r} as materialized (select row, p, min({{'d': d, 'e': e}}) as best from (select m.row, m.p, b.e,
  cast(list_dot_product(m.x, m.x) - 2 * list_dot_product(m.x, b.c) + list_dot_product(b.c, b.c) as bigint) as d
  from members m join book{r} b using (p)) group by row, p)"""
        )
        if r < rounds:
            steps.append(
                f"""mean{r} as (select p, e, list(m order by i) as c from (
  select p, e, i, (s - ((s % n) + n) % n) // n as m from (
   select p, n.best.e as e, i, sum(cast(x[i] as bigint)) as s, count(*) as n
   from near{r} n join members using (row, p), dim, lateral (select unnest(range(1, w + 1)) as i) group by all)) group by p, e)"""
            )
            steps.append(
                f"""book{r + 1} as materialized (select b.p, b.e, cast(coalesce(m.c, b.c) as double[]) as c
 from book{r} b left join mean{r} m on m.p = b.p and m.e = b.e)"""
            )
    steps.append(
        f"""coded as (select k.vec_id, k.label,
 string_agg(lower(lpad(to_hex(n.best.e), 2, '0')), '' order by n.p) as code, cast(sum(n.best.d) as bigint) as error
 from near{rounds} n join kept k using (row) group by k.row, k.vec_id, k.label)"""
    )
    return f"""with {", ".join(steps)}
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
 (select sha256(string_agg(array_to_string(cast(c as bigint[]), ','), ',' order by p, e)) from book{rounds}) as codebooks_sha256
from coded"""

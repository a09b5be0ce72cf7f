"""Benchmark decontamination: documents against the word windows of test items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.work import Scratch, let, with_columns_last, words

# Up to this many item windows (16 bytes of key and payload each) are broadcast; more are joined by a
# shuffle of both sides. The rows are the same either way.
BROADCAST_WINDOWS = 2_000_000


def with_window_hashes(df: DataFrame, words_column: str, n: int, out: str) -> DataFrame:
    """Add one hash per window of ``n`` words, built by doubling: about log2(n) hashes a word, not n.

    Each step is a column of its own, so no step is computed twice.
    """
    names = {1: "__h1"}
    df = df.withColumn(names[1], F.transform(words_column, lambda w: F.xxhash64(w)))

    def combine(df: DataFrame, left: int, right: int) -> DataFrame:
        """Hashes of ``left + right`` words from those of ``left`` and, shifted, those of ``right``."""
        a, b = F.col(names[left]), F.col(names[right])
        size = F.greatest(F.size(b) - left, F.lit(0))
        names[left + right] = f"__h{left + right}"
        pairs = F.zip_with(F.slice(a, 1, size), F.slice(b, left + 1, size), lambda x, y: F.xxhash64(x, y))
        return df.withColumn(names[left + right], pairs)

    width = 1
    while width * 2 <= n:
        df, width = combine(df, width, width), width * 2
    for size in sorted(names, reverse=True):
        if width + size <= n:
            df, width = combine(df, width, size), width + size
    return df.withColumnRenamed(names[n], out).drop(*[c for k, c in names.items() if k != n])


def item_windows(benchmark: DataFrame, n: int) -> DataFrame:
    """``(item_id, size, hash, window)``: windows of ``n`` words; a shorter item is one window of its own."""
    worded = benchmark.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(n))
    starts = F.sequence(F.lit(1), F.size("w") - size + 1)
    return worded.select(
        "item_id", size.alias("size"), F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("window")
    ).distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """``documents`` with the words that occur in windows of benchmark items found.

    Columns: ``doc_id``, ``n_words``, ``n_hit`` (words inside any occurrence of an item window),
    ``n_items`` and ``item_ids`` (items with occurring windows, as sorted texts), ``spans`` (merged hit
    runs as ``{start, end}`` word positions, end exclusive) and ``contaminated`` (``n_hit > 0``).

    Item windows become hashes in a broadcast set, each document is scanned once for hashes in the set,
    and only the documents with such hits are read again, to compare the hit windows word by word.
    Neither side carries texts through the scan. A hash that many items or documents share stays one
    row of the set (its items are attached after the check), so a frequent passage costs one row per
    occurrence. Null and empty texts have no words and no hits; items without words match nothing; with
    no items or no documents the result has no hits or no rows. Rows with a repeated ``doc_id`` are
    judged each by their own text; a null ``doc_id`` is an id like another.
    """
    return _judged(docs, benchmark, n).drop("h")


def _judged(docs: DataFrame, benchmark: DataFrame, n: int) -> DataFrame:
    """The rows of ``decontaminate`` with the text hash ``h``."""
    scratch = Scratch(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    windows = scratch.keep(item_windows(benchmark, n))
    sizes = [r["size"] for r in windows.select("size").distinct().sort("size").collect()]  # at most n
    hits = None
    for size in sizes:
        found = _scan(rows, windows.filter(F.col("size") == size), size)
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        hits = rows.select("doc_id", _text_hash(), F.array().cast("array<struct<pos:int,size:int>>").alias("candidates")).limit(0)
    hits = scratch.keep(hits)
    verified = scratch.keep(_verify(rows, hits, windows))
    # A row is found again by id and text, so repeated ids with other texts stay apart.
    counted = rows.select("doc_id", _text_hash(), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    return _join_rows(counted, verified, "left").select(
        counted["doc_id"],
        counted["h"],
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def _text_hash() -> Column:
    return F.xxhash64("text").alias("h")


def _join_rows(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    return left.join(right, left["doc_id"].eqNullSafe(right["doc_id"]) & (left["h"] == right["h"]), how)


def _scan(rows: DataFrame, windows: DataFrame, size: int) -> DataFrame:
    """Positions whose hash is in the set, packed per document row."""
    wanted = with_window_hashes(windows, "window", size, "hashes").select(F.get("hashes", F.lit(0)).alias("hash")).distinct()
    if wanted.count() <= BROADCAST_WINDOWS:
        wanted = F.broadcast(wanted)
    worded = rows.select("doc_id", _text_hash(), words(F.col("text")).alias("w"))
    # The outer form: the inner one adds a filter on the array, which computes all of it again.
    scanned = with_window_hashes(worded, "w", size, "hashes").select(
        "doc_id", "h", F.posexplode_outer("hashes").alias("pos", "hash")
    )
    found = scanned.join(wanted, "hash", "left_semi")
    return found.groupBy("doc_id", "h").agg(F.collect_set(F.struct("pos", F.lit(size).alias("size"))).alias("candidates"))


def _verify(rows: DataFrame, hits: DataFrame, windows: DataFrame) -> DataFrame:
    """Hits whose words equal an item's, and per document row the merged spans and the items."""
    hits = hits.groupBy("doc_id", "h").agg(F.flatten(F.collect_list("candidates")).alias("candidates"))
    keyed = rows.select("doc_id", _text_hash(), "text")
    ids = hits.select("doc_id", "h")
    if ids.count() <= BROADCAST_WINDOWS:
        keyed = _join_rows(keyed, F.broadcast(ids), "left_semi")
    keyed = keyed.dropDuplicates(["doc_id", "h"])
    def windows_of(w: Column) -> Column:
        return F.transform(
            "candidates",
            lambda c: F.struct(
                c["pos"].alias("pos"), c["size"].alias("size"), F.slice(w, c["pos"] + 1, c["size"]).alias("window")
            ),
        )

    # Cut before they are exploded: a text is split into words once, not once per window.
    cut = (
        _join_rows(keyed, hits, "inner")
        .select(keyed["doc_id"], keyed["h"], F.explode_outer(let(words(F.col("text")), windows_of)).alias("c"))
        .select("doc_id", "h", "c.pos", "c.size", "c.window")
    )
    owners = windows.groupBy("window").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    per_row = cut.join(owners, "window").groupBy("doc_id", "h").agg(
        F.array_sort(F.collect_set(F.struct("pos", (F.col("pos") + F.col("size")).alias("end")))).alias("runs"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("item_ids"),
    )
    return per_row.select("doc_id", "h", merge_spans(F.col("runs")).alias("spans"), "item_ids").withColumn(
        "n_hit", F.aggregate("spans", F.lit(0), lambda a, s: a + s["end"] - s["start"])
    )


def merge_spans(runs: Column) -> Column:
    """Sorted ``{pos, end}`` runs merged where they touch, as ``{start, end}``."""
    size = F.size(runs)
    state = F.aggregate(
        runs,
        F.struct(
            F.array().cast("array<struct<start:int,end:int>>").alias("done"),
            F.lit(-1).alias("start"),
            F.lit(-1).alias("end"),
        ),
        lambda a, r: F.when(
            r["pos"] <= a["end"],
            F.struct(a["done"].alias("done"), a["start"].alias("start"), F.greatest(a["end"], r["end"]).alias("end")),
        ).otherwise(
            F.struct(
                F.when(a["end"] >= 0, F.concat(a["done"], F.array(F.struct(a["start"].alias("start"), a["end"].alias("end")))))
                .otherwise(a["done"])
                .alias("done"),
                r["pos"].alias("start"),
                r["end"].alias("end"),
            )
        ),
    )
    last = F.struct(state["start"].alias("start"), state["end"].alias("end"))
    return F.when(size > 0, F.concat(state["done"], F.array(last)))


def digest(found: DataFrame) -> DataFrame:
    """The operator's rows with the item ids as one hash."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 10, share: float = 0.5) -> DataFrame:
    """Documents without their hit spans; ``n_chars`` follows.

    A document whose hit words exceed ``share`` of all is left out; from the others the hit words and
    what separates them are cut, and the rest stays as it is. Documents without hits are unchanged. A row
    is found again by id and text, so rows with the same id (or none) are each cut by their own spans.
    """
    found = _judged(docs, benchmark, n).filter("contaminated").select(
        F.col("doc_id").alias("__id"),
        F.col("h").alias("__h"),
        F.col("n_words").alias("__words"),
        F.col("n_hit").alias("__hit"),
        F.col("spans").alias("__spans"),
    ).dropDuplicates(["__id", "__h"])
    joined = docs.join(
        found, docs["doc_id"].eqNullSafe(F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__h")), "left"
    ).filter(F.col("__hit").isNull() | (F.col("__hit") <= F.col("__words") * F.lit(share)))
    cut = F.when(F.col("__hit").isNotNull(), without_words(F.col("text"), F.col("__spans"))).otherwise(F.col("text"))
    out = with_columns_last(joined, text=cut)
    if "n_chars" in docs.columns:
        length = F.when(F.col("__hit").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))
        out = with_columns_last(out, n_chars=length)
    return out.select(*docs.columns)


# A word with the separators that follow it.
PIECE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"


def without_words(text: Column, spans: Column) -> Column:
    """Text without the words at ``spans`` and the separators after them."""
    lead = F.regexp_extract(text, r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", 0)
    pieces = F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))
    count = F.size(pieces)
    starts = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(count))
    kept = F.zip_with(starts, ends, lambda a, b: F.slice(pieces, a + 1, F.greatest(b - a, F.lit(0))))
    return F.concat(lead, F.array_join(F.flatten(kept), ""))


def oracle(n: int = 10) -> str:
    """The digest rows in DuckDB SQL."""
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    worded = f"list_filter(regexp_split_to_array({low}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"
    return f"""with b as (select item_id, {worded} as w from benchmark),
iw as (select distinct item_id, least(len(w), {n}) as size,
  unnest(list_transform(range(1, len(w) - least(len(w), {n}) + 2), lambda i: list_slice(w, i, i + least(len(w), {n}) - 1))) as win
  from b where len(w) > 0),
sizes as (select distinct size from iw),
d as (select doc_id, {worded} as w from documents),
dw as (select doc_id, size, unnest(range(1, len(w) - size + 2)) as pos, w from d, sizes where len(w) >= size),
hit as (select dw.doc_id, pos, iw.size, item_id from dw join iw on iw.size = dw.size and iw.win = list_slice(w, pos, pos + dw.size - 1)),
hw as (select distinct doc_id, unnest(range(pos, pos + size)) as p from hit),
n as (select doc_id, count(*) as n_hit from hw group by 1),
i as (select doc_id, count(distinct item_id) as n_items,
  string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids from hit group by 1)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
 cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256,
 coalesce(n_hit, 0) > 0 as contaminated
from d left join n using (doc_id) left join i using (doc_id)"""

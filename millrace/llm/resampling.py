"""Importance resampling towards a target text distribution: scored arrays, then a distributed quickselect."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.sql import CRC, CRC_TABLE, WORDS
from millrace.llm.work import Scratch, with_columns_last

BUCKETS, RUN, SEED = 10_000, 3, 42
LEAST_WORDS, PERCENT = 20, 5
# Texts are worked on in pieces of about this many bytes, so that memory does not follow the batch.
PIECE = 4 << 20
# Words of more bytes are hashed one by one instead of side by side.
SIDE_BY_SIDE = 64
# Pivots that each round of the selection draws and counts.
PIVOTS = 16
# Fixed value: the reversed CRC-32 polynomial.
POLYNOMIAL = 0xEDB88320


def _crc_table() -> np.ndarray:
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> 1) ^ np.uint32(POLYNOMIAL), value >> 1)
    return value


class Crc:
    """crc32 of many byte runs at once, and of runs joined from others.

    crc32(a + b) is crc32(a) carried over len(b) zero bytes, xor crc32(b). Carrying is linear in the
    bits, so four table look-ups, one per byte of the value, do it for any length in the tables; longer
    ways are made of doubled ones.
    """

    SHORT = 128

    def __init__(self) -> None:
        self.table = _crc_table()
        one = np.stack([self._zero(np.arange(256, dtype=np.uint32) << np.uint32(8 * b)) for b in range(4)])
        carry = [np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * b) for b in range(4)])]
        for _ in range(self.SHORT):
            carry.append(self._through(one, carry[-1]))
        self.short = np.stack(carry)
        self.doubled = [self.short[self.SHORT]]

    def _zero(self, value: np.ndarray) -> np.ndarray:
        return (value >> np.uint32(8)) ^ self.table[value & np.uint32(255)]

    @staticmethod
    def _through(tables: np.ndarray, value: np.ndarray) -> np.ndarray:
        out = tables[0][value & np.uint32(255)]
        for b in range(1, 4):
            out = out ^ tables[b][(value >> np.uint32(8 * b)) & np.uint32(255)]
        return out

    def carried(self, value: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Values as they are after ``length`` more zero bytes."""
        flat, at = self.short.reshape(-1), (length % self.SHORT).astype(np.intp) << 10
        out = flat[at + (value & np.uint32(255))]
        for b in range(1, 4):
            out ^= flat[at + (b << 8) + ((value >> np.uint32(8 * b)) & np.uint32(255))]
        rest, k = length // self.SHORT, 0
        while (far := np.flatnonzero(rest >> k)).size:
            if k == len(self.doubled):
                self.doubled.append(self._through(self.doubled[-1], self.doubled[-1]))
            step = far[(rest[far] >> k) & 1 == 1]
            out[step] = self._through(self.doubled[k], out[step])
            k += 1
        return out

    def of_runs(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """crc32 of ``data[start:start + length]`` for every run, a byte of all runs at a time."""
        value = np.full(len(start), 0xFFFFFFFF, np.uint32)
        order = np.argsort(-length, kind="stable")
        sorted_length, s = length[order], start[order]
        state = value[order]
        short = int(np.searchsorted(-sorted_length, -SIDE_BY_SIDE, "left"))
        longest = int(sorted_length[short]) if short < len(order) else 0
        for j in range(longest):
            live = int(np.searchsorted(-sorted_length, -j, "left"))
            part = state[short:live]
            state[short:live] = (part >> np.uint32(8)) ^ self.table[(part ^ data[s[short:live] + j]) & np.uint32(255)]
        state ^= np.uint32(0xFFFFFFFF)
        for i in range(short):
            state[i] = zlib.crc32(data[s[i] : s[i] + sorted_length[i]].tobytes())
        value[order] = state
        return value


def _byte_classes() -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes (A-Z only), and which bytes belong to words: letters, digits and all of non-ASCII."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    word = np.zeros(256, bool)
    word[48:58] = word[97:123] = word[128:] = True
    return lower, word


class Features:
    """Buckets of the runs of 1 to ``RUN`` words of texts, for a whole piece of a column at once."""

    def __init__(self) -> None:
        self.crc = Crc()
        self.lower, self.word = _byte_classes()
        self.blank = np.uint32(zlib.crc32(b" "))

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Lower-cased bytes, and of every word its first byte, its length and its text's number."""
        data = self.lower[data]
        inside = self.word[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edges = offsets[1:-1]
        edges = edges[edges < len(data)]
        begins[edges] |= inside[edges]
        start = np.flatnonzero(begins)
        # A word ends before the next byte outside of words, the next text, or at the end of the piece.
        stops = np.flatnonzero(np.concatenate([~inside, [True]]))
        end = stops[np.searchsorted(stops, start)]
        text = np.searchsorted(offsets, start, "right") - 1
        return data, start, np.minimum(end, offsets[text + 1]) - start, text

    def buckets(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Words per text, and for runs of 1, 2, ... words the text and the bucket of every run."""
        data, start, length, text = self.words(data, offsets)
        single = self.crc.of_runs(data, start, length)
        out = [(text, single % BUCKETS)]
        value = single
        for n in range(1, RUN):
            # Runs of n words are made longer by a blank and the word after them.
            with_blank = self.crc.carried(value, np.ones(len(value), np.int64)) ^ self.blank
            follow = np.arange(n, len(single))
            value = self.crc.carried(with_blank[: len(follow)], length[follow]) ^ single[follow]
            whole = text[: len(follow)] == text[follow]
            out.append((text[follow][whole], value[whole] % BUCKETS))
        return np.bincount(text, minlength=len(offsets) - 1), out


def _pieces(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes and offsets of runs of whole texts, cut at about ``PIECE`` bytes; null texts are empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + PIECE, "right")) - 1)
        last = min(last, len(texts))
        yield data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    features, counts = Features(), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for data, offsets in _pieces(batch.column("text")):
            for _, bucket in features.buckets(data, offsets)[1]:
                counts += np.bincount(bucket, minlength=BUCKETS)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], ["bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How many features of all texts fall into each bucket: one row per bucket and task is shuffled."""
    parts = texts.select("text").mapInArrow(_count, "bucket int, n long")
    out = np.zeros(BUCKETS, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket, a thousand times the logarithm of how much likelier the target has it, rounded down."""
    s_all, t_all = float(source.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    ratios = ((float(t) + 1) * s_all / ((float(s) + 1) * t_all) for s, t in zip(source, target, strict=True))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def _weigh(gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            n_words, weights = [], []
            for data, offsets in _pieces(batch.column("text")):
                words, runs = features.buckets(data, offsets)
                weight = np.zeros(len(words), np.int64)
                for text, bucket in runs:
                    # Texts come in order: differences of running sums are exact sums per text.
                    sums = np.concatenate([[0], np.cumsum(gain[bucket])])
                    edges = np.searchsorted(text, np.arange(len(words) + 1))
                    weight += sums[edges[1:]] - sums[edges[:-1]]
                n_words.append(words.astype(np.int64))
                weights.append(weight)
            if n_words:
                columns = [batch.column("doc_id"), batch.column("h"), np.concatenate(n_words), np.concatenate(weights)]
                yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], ["doc_id", "h", "n_words", "weight"])

    return run


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """``floor(1000 * Gumbel)`` from the seed and the id alone, whatever task asks for it."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def score(docs: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """``doc_id, h, n_words, n_features, weight, score`` of every document; ``h`` is the text's hash."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, h long, n_words long, weight long"
    weighed = rows.withColumn("h", F.xxhash64("text")).mapInArrow(_weigh(gain), schema)
    n_features = sum((F.greatest(F.col("n_words") - n, F.lit(0)) for n in range(RUN)), F.lit(0).cast("long"))
    return weighed.select(
        "doc_id", "h", "n_words", n_features.alias("n_features"), "weight", (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score")
    )


# The order of the draw: higher scores, then smaller ids (null ids last), then the text's hash; rows equal
# in all of these are alike in every result column, and their row number tells them apart.
KEY = ("score", "none", "id", "h", "row")


def _before(key: tuple, equal: bool = False) -> Column:
    """Whether a row comes before a key in the order of the draw (or is at it)."""
    columns = [-F.col("score"), *[F.col(c) for c in KEY[1:]]]
    values = [F.lit(-key[0]), *[F.lit(v) for v in key[1:]]]
    test = F.lit(equal)
    for column, value in zip(reversed(columns), reversed(values), strict=True):
        test = (column < value) | ((column == value) & test)
    return test


def kth_key(candidates: DataFrame, k: int, seed: int = SEED) -> tuple:
    """The key of the k-th row in the order of the draw, by quickselect over all rows.

    Each round draws a few pivots among the rows that are still candidates (those with the least hashes
    of their key in this round, so a retry draws the same), and counts exactly how many rows lie before
    each pivot, in one pass that returns one row. The k-th row is a pivot, or lies between two of
    them: only that stretch stays. Pivots are random, so a stretch keeps about one row in ``PIVOTS``,
    whatever the scores look like, and fewer candidates than pivots are all pivots.
    """
    low = high = None
    turn = passed = 0
    while True:
        inside = candidates
        if low is not None:
            inside = inside.filter(~_before(low, equal=True))
        if high is not None:
            inside = inside.filter(_before(high))
        drawn = inside.orderBy(F.xxhash64(F.lit(seed), F.lit(turn), *[F.col(c) for c in KEY]), *KEY).select(*KEY).limit(PIVOTS).collect()
        pivots = sorted((tuple(r) for r in drawn), key=lambda p: (-p[0], *p[1:]))
        # Three ways at once: before the pivot, at it (keys differ, so one row), and after.
        counts = inside.agg(*[F.count(F.when(_before(p), 1)).alias(f"p{i}") for i, p in enumerate(pivots)]).first()
        before = [passed + n for n in counts]
        for pivot, n in zip(pivots, before, strict=True):
            if n == k - 1:
                return pivot
            if n >= k:
                high = pivot
                break
            low, passed = pivot, n + 1
        turn += 1


def draw(scored: DataFrame, k: int, scratch: Scratch, seed: int = SEED) -> DataFrame:
    """``scored`` rows (with the columns of ``KEY``) and the rank of the k first in the order of the draw.

    Only the winners are sorted: into ranges, and ranked within each from the number of rows before it.
    ``eligible`` tells which rows take part.
    """
    null_rank = F.lit(None).cast("long").alias("rank")
    if k < 1:
        return scored.select("*", null_rank)
    wins = F.col("eligible") & _before(kth_key(scored.filter("eligible"), k, seed), equal=True)
    order = [F.desc("score"), *KEY[1:]]
    winners = scratch.keep(scored.filter(wins).repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    sizes = {r["range"]: r["n"] for r in winners.groupBy("range").agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, before = [], 0
    for r in range(max(sizes) + 1):
        starts.append(before)
        before += sizes.get(r, 0)
    start = F.get(F.split(F.lit(",".join(map(str, starts))), ","), F.col("range")).cast("long")
    within = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    ranked = winners.withColumn("rank", start + within).drop("range")
    return scored.filter(~wins).select("*", null_rank).unionByName(ranked)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED
) -> DataFrame:
    """Draw ``percent`` of the documents, without replacement, so that their features look like the target's.

    Features are runs of 1 to 3 lower-cased (A-Z) words, hashed into ``BUCKETS``; a text's weight is the
    sum of its features' gains, and the score adds seeded Gumbel noise. Of the N documents of at least
    ``least_words`` words, the ``floor(percent * N / 100)`` of highest score are drawn; ties go to the
    smaller id.

    Columns: ``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` (1, 2, ... or
    null). Texts are read twice, to count and to score, in numpy over whole columns; only bucket counts
    and the winners' scores are shuffled. What the driver holds is the gain of each bucket and a few
    pivots. Null and empty texts have no features and are never drawn; an empty table stays empty; an
    empty target has no counts, so rare features gain. A null id hashes as an empty text and comes last
    among ties, rows with one id are told apart by their text, and full repeats are drawn one by one.
    Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    gain = gains(bucket_counts(docs), bucket_counts(target))
    key = {
        "none": F.col("doc_id").isNull(),
        "id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)),
        "row": F.monotonically_increasing_id(),
        "eligible": F.col("n_words") >= least_words,
    }
    # Written once: the row numbers stay, and every round of the selection reads a few numbers a row.
    scored = scratch.keep(with_columns_last(score(docs, gain, seed), **key))
    n = scored.filter("eligible").count()
    return draw(scored, percent * n // 100, scratch, seed).select("doc_id", "n_words", "n_features", "weight", "score", "rank")


def digest(drawn: DataFrame) -> DataFrame:
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def oracle() -> str:
    """The digest of ``documents`` towards ``benchmark`` in DuckDB SQL."""

    def runs(table: str, key: str) -> str:
        parts = [f"select {key}, unnest(ws) as f from {table}"]
        for n in range(1, RUN):
            joined = " || ' ' || ".join(f"ws[i + {j + 1}]" for j in range(n + 1))
            parts.append(f"select {key}, unnest(list_transform(range(len(ws) - {n}), lambda i: {joined})) as f from {table} where len(ws) > {n}")
        return " union all ".join(parts)

    return f"""with {CRC_TABLE},
docs as (select row_number() over () as row, doc_id, {WORDS.format("text")} as ws from documents),
items as (select 0 as row, {WORDS.format("text")} as ws from benchmark),
source as materialized (select row, f, count(*) as n from ({runs("docs", "row")}) group by all),
target as materialized (select f, count(*) as n from ({runs("items", "row")}) group by all),
hashed as materialized (select f, {CRC.format("f")} % {BUCKETS} as bucket
 from (select f from source union select f from target), crc_table),
s as (select bucket, sum(n) as n from source join hashed using (f) group by bucket),
t as (select bucket, sum(n) as n from target join hashed using (f) group by bucket),
totals as (select (select cast(coalesce(sum(n), 0) as double) from s) as s_all, (select cast(coalesce(sum(n), 0) as double) from t) as t_all),
gains as (select bucket, cast(floor(1000 * ln((cast(coalesce(t.n, 0) as double) + 1) * (s_all + {BUCKETS})
  / ((cast(coalesce(s.n, 0) as double) + 1) * (t_all + {BUCKETS})))) as bigint) as gain
 from (select unnest(range({BUCKETS})) as bucket) left join s using (bucket) left join t using (bucket), totals),
weights as (select row, sum(n) as n_features, sum(n * gain) as weight
 from source join hashed using (f) join gains using (bucket) group by row),
scored as (select d.row, doc_id, len(ws) >= {LEAST_WORDS} as eligible,
  cast(coalesce(n_features, 0) as bigint) as n_features, cast(coalesce(weight, 0) as bigint) as weight,
  cast(coalesce(weight, 0) + floor(-1000 * ln(-ln((cast('0x' || substr(sha256('{SEED}:' || coalesce(cast(doc_id as varchar), '')), 1, 8) as bigint)
   + 0.5::double) / 4294967296::double))) as bigint) as score
 from docs d left join weights w on w.row = d.row),
ranked as (select row, row_number() over (order by score desc, doc_id) as place, count(*) over () as n from scored where eligible)
select doc_id, n_features, weight, score, case when place <= {PERCENT} * n // 100 then place end as rank
from scored left join ranked using (row)"""

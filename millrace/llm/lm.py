"""Language-model scoring: a modified Kneser-Ney bigram model in sorted, memory-mapped hash arrays."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.quality import in_fold
from millrace.llm.work import Scratch, lower_ascii, mounted, tokens

# Tokens worked on at once in a task, and tokens of the corpus per model file.
CHUNK, PER_FILE = 1 << 20, 1 << 21
# A word that makes up more than this share of a file's tokens is dealt out over several files.
HOT_SHARE = 0.25
# Added count of the base score.
ADDED = 0.1
M1, M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mix(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    """Hash of a pair of hashes."""
    h = (a ^ (b * M2 + (b >> np.uint64(29)))) * M1
    h ^= h >> np.uint64(32)
    h *= M2
    return h ^ (h >> np.uint64(29))


def end_hash(spark) -> tuple[int, int]:
    """Hashes of the end of a text and of its start; no word equals either, as both hold a blank."""
    row = spark.range(1).select(F.xxhash64(F.lit(" end")).alias("e"), F.xxhash64(F.lit(" start")).alias("s")).first()
    return row["e"], row["s"]


def _hashed(docs: DataFrame, folds: int, held: int) -> DataFrame:
    words = F.transform(tokens(lower_ascii(F.col("text"))), lambda w: F.xxhash64(w))
    return docs.select("doc_id", in_fold(F.col("doc_id"), folds, held).alias("held_out"), words.alias("t"))


def chunks(batches: Iterator[pa.RecordBatch], end: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows in pieces of about ``CHUNK`` tokens: the rows, their tokens with an end each, and lengths."""
    for batch in batches:
        column = batch.column("t")
        offsets = column.offsets.to_numpy()
        offsets = offsets - offsets[0]
        values = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + CHUNK, "right")) - 1)
            lengths = np.diff(offsets[start : stop + 1])
            flat = np.insert(values[offsets[start] : offsets[stop]], np.cumsum(lengths), np.uint64(end & (2**64 - 1)))
            yield batch.slice(start, stop - start), flat, lengths + 1
            start = stop


def left_of(flat: np.ndarray, lengths: np.ndarray, start: int) -> np.ndarray:
    """The token before each token."""
    left = np.empty_like(flat)
    left[1:] = flat[:-1]
    left[np.cumsum(lengths) - lengths] = np.uint64(start & (2**64 - 1))
    return left


def totals(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order with the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    return (keys[first], *[np.add.reduceat(v[order], first) if len(first) else v for v in values])


def file_of(keys: np.ndarray, files: int) -> np.ndarray:
    """Which of ``files`` equal hash ranges a key is in."""
    return ((keys >> np.uint64(32)) * np.uint64(files) >> np.uint64(32)).astype(np.int64)


@dataclass(frozen=True)
class Shape:
    """How the model's files are dealt out. ``hot`` words are spread over ``spread`` files each."""

    folder: str
    files: int
    hot: np.ndarray
    spread: np.ndarray
    start: int
    end: int

    def pair_file(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """File of a pair: its left word's, or for a hot left word one of several."""
        salt = np.zeros(len(left), np.uint64)
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, left), len(self.hot) - 1)
            is_hot = self.hot[at] == left
            salt[is_hot] = right[is_hot] % self.spread[at[is_hot]].astype(np.uint64)
        return file_of(mix(left, salt), self.files)


def pack(*arrays: np.ndarray) -> bytes:
    return np.int64(len(arrays[0])).tobytes() + b"".join(a.tobytes() for a in arrays)


def unpack(blob: bytes, *kinds: type) -> list[np.ndarray]:
    n, at, out = int(np.frombuffer(blob, np.int64, 1)[0]), 8, []
    for kind in kinds:
        out.append(np.frombuffer(blob, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def unpack_all(blobs, *kinds: type) -> list[np.ndarray]:
    parts = [unpack(b, *kinds) for b in blobs]
    return [np.concatenate(p) for p in zip(*parts, strict=True)]


def deal(files: np.ndarray, *arrays: np.ndarray) -> dict[str, list]:
    """Columns ``file`` and ``blob``: the arrays cut up by file."""
    order = np.argsort(files, kind="stable")
    sorted_files = files[order]
    cuts = np.flatnonzero(np.diff(sorted_files)) + 1
    parts = np.split(order, cuts) if len(order) else []
    return {
        "file": [int(files[p[0]]) for p in parts],
        "blob": [pack(*[a[p] for a in arrays]) for p in parts],
    }


def save(folder: str, name: str, array: np.ndarray) -> None:
    """Write whole or not at all: a repeated task replaces the file by an equal one."""
    path = f"{folder}/{name}.{uuid.uuid4().hex}"
    with open(path, "wb") as f:
        np.save(f, array)
    os.replace(path, f"{folder}/{name}.npy")


@lru_cache(maxsize=4096)
def mapped(folder: str, name: str) -> np.ndarray:
    return np.load(f"{folder}/{name}.npy", mmap_mode="r")


# The fields of a word's row. Pairs hold a hash and a count, as two arrays.
WORD = np.dtype([("count", "<i8"), ("left", "<i8"), ("n1", "<i8"), ("n2", "<i8"), ("n3", "<i8")])
BLOB = "file int, blob binary"


def count_words(hashed: DataFrame, files: int, end: int) -> DataFrame:
    """``(file, blob)``: training tokens per hash range, partly summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, flat, _ in chunks(batches, end):
            keys, n = np.unique(flat, return_counts=True)
            yield pa.RecordBatch.from_pydict(deal(file_of(keys, files), keys, n), schema=_blob_schema())

    return hashed.filter(~F.col("held_out")).select("t").mapInArrow(run, BLOB)


def _blob_schema() -> pa.Schema:
    return pa.schema([("file", pa.int32()), ("blob", pa.binary())])


def _hot_words(least: float):
    """Sum a range of words; report its total, its distinct words and the frequent ones."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        keys, n = totals(*unpack_all(frame["blob"], np.uint64, np.int64))
        hot = n >= least
        return pd.DataFrame(
            {"file": [int(frame["file"].iloc[0])], "words": [pack(keys, n)], "total": [int(n.sum())], "kinds": [len(keys)], "hot": [pack(keys[hot], n[hot])]}
        )

    return run


def _count_pairs(shape: Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, flat, lengths in chunks(batches, shape.end):
            left = left_of(flat, lengths, shape.start)
            order = np.lexsort((flat, left))
            left, right = left[order], flat[order]
            first = np.flatnonzero(np.r_[True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])])
            n = np.diff(np.r_[first, len(left)]).astype(np.int32)
            left, right = left[first], right[first]
            yield pa.RecordBatch.from_pydict(deal(shape.pair_file(left, right), left, right, n), schema=_blob_schema())

    return run


def _merge_pairs(shape: Shape):
    """Sum a file's pairs, write them, and pass on what their words need to know."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        name = int(frame["file"].iloc[0])
        left, right, n = unpack_all(frame["blob"], np.uint64, np.uint64, np.int32)
        order = np.lexsort((right, left))
        left, right, n = left[order], right[order], n[order]
        first = np.flatnonzero(np.r_[True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])])
        n = np.add.reduceat(n.astype(np.int64), first)
        left, right = left[first], right[first]
        keys = mix(left, right)
        order = np.argsort(keys)
        save(shape.folder, f"pair-{name}", keys[order])
        save(shape.folder, f"count-{name}", np.minimum(n[order], 2**32 - 1).astype(np.uint32))
        seen = [int((n == k).sum()) for k in (1, 2, 3, 4)]
        contexts = totals(left, (n == 1).astype(np.int32), (n == 2).astype(np.int32), (n >= 3).astype(np.int32))
        follows = totals(right, np.ones(len(right), np.int32))
        zero = np.zeros(len(follows[0]), np.int32)
        words = np.r_[contexts[0], follows[0]]
        fields = [
            np.r_[np.zeros(len(contexts[0]), np.int32), follows[1]],
            *[np.r_[c, zero] for c in contexts[1:]],
        ]
        words, *fields = totals(words, *fields)
        out = deal(file_of(words, shape.files), words, *[f.astype(np.int32) for f in fields])
        return pd.DataFrame(out).assign(seen=[seen] + [None] * (len(out["file"]) - 1))

    return run


def _merge_words(shape: Shape):
    """Write a range of words with their counts; report what the lower order's discounts need."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        name = int(frame["file"].iloc[0])
        of_pairs = frame["words"].isna()
        keys, left, n1, n2, n3 = unpack_all(frame["blob"][of_pairs], np.uint64, *[np.int32] * 4) if of_pairs.any() else (np.zeros(0, np.uint64), *[np.zeros(0, np.int32)] * 4)
        words, count = unpack_all(frame["words"][~of_pairs], np.uint64, np.int64) if (~of_pairs).any() else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        zero, none = np.zeros(len(words), np.int64), np.zeros(len(keys), np.int64)
        keys, *fields = totals(np.r_[keys, words], np.r_[none, count], *[np.r_[f, zero] for f in (left, n1, n2, n3)])
        table = np.zeros(len(keys), WORD)
        for field, values in zip(WORD.names, fields, strict=True):
            table[field] = values
        save(shape.folder, f"word-{name}", keys)
        save(shape.folder, f"stat-{name}", table)
        follows = table["left"]
        seen = [int((follows == k).sum()) for k in (1, 2, 3, 4)] + [int((follows >= 3).sum())]
        return pd.DataFrame({"file": [name], "seen": [seen]})

    return run


def discounts(seen: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and 3 or more, from the counts of counts 1 to 4."""
    n1, n2, n3, n4 = [float(x) for x in seen[:4]]
    if not n1 or not n2:
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    d = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 2.0]
    return np.array([0.0, *[min(max(v, 0.05), k) for v, k in zip(d[1:], (0.95, 1.95, 2.95), strict=True)]])


@dataclass(frozen=True)
class LanguageModel:
    """The files' shape and the few numbers the whole model shares."""

    shape: Shape
    train_tokens: int
    vocabulary: int
    texts: int
    pairs: int
    high: np.ndarray
    low: np.ndarray
    low_left: float

    def look_up(self, files: np.ndarray, keys: np.ndarray, key_name: str, value_name: str, missing) -> np.ndarray:
        """Values of keys, file by file; queries are sorted so each file is read front to back."""
        out = np.repeat(missing, len(keys))
        order = np.lexsort((keys, files))
        cuts = np.flatnonzero(np.diff(files[order])) + 1
        for part in np.split(order, cuts) if len(order) else []:
            name = int(files[part[0]])
            if not os.path.exists(f"{self.shape.folder}/{key_name}-{name}.npy"):
                continue
            known = mapped(self.shape.folder, f"{key_name}-{name}")
            at = np.searchsorted(known, keys[part])
            at[at == len(known)] = 0
            if len(known):
                hit = known[at] == keys[part]
                out[part[hit]] = mapped(self.shape.folder, f"{value_name}-{name}")[at[hit]]
        return out

    def log10(self, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per token, the model's log10 probability given the token before, and the token's count."""
        left = left_of(flat, lengths, self.shape.start)
        words, at = np.unique(np.r_[flat, left], return_inverse=True)
        stats = self.look_up(file_of(words, self.shape.files), words, "word", "stat", np.zeros(1, WORD))
        right_at, left_at = at[: len(flat)], at[len(flat) :]
        keys = mix(left, flat)
        unique, first, back = np.unique(keys, return_index=True, return_inverse=True)
        files = self.shape.pair_file(left[first], flat[first])
        pair = self.look_up(files, unique, "pair", "count", np.zeros(1, np.uint32))[back].astype(np.float64)

        follows = stats["left"].astype(np.float64)
        lower = (follows - self.low[np.minimum(stats["left"], 3)]) / max(self.pairs, 1) + self.low_left / (self.vocabulary + 1)
        context = stats["count"].astype(np.float64)
        context[words == np.uint64(self.shape.start & (2**64 - 1))] = self.texts
        left_mass = self.high[1] * stats["n1"] + self.high[2] * stats["n2"] + self.high[3] * stats["n3"]
        given = np.maximum(context[left_at], 1)
        own = (pair - self.high[np.minimum(pair, 3).astype(int)]) / given
        share = np.where(context[left_at] > 0, left_mass[left_at] / given, 1.0)
        return np.log10(own + share * lower[right_at]), stats["count"][right_at]


def train(docs: DataFrame, scratch: Scratch, folds: int = 10, held: int = 0) -> LanguageModel:
    """Count the training texts into model files below the shared folder."""
    spark = docs.sparkSession
    end, start = end_hash(spark)
    hashed = _hashed(docs, folds, held)
    folder = mounted(scratch.new_path())
    os.makedirs(folder)
    # Characters bound tokens from above; this only sets how many files there are.
    letters = docs.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    files = max(1, -(-(letters // 4) // PER_FILE))
    least = HOT_SHARE * PER_FILE
    words = scratch.keep(
        count_words(hashed, files, end)
        .groupBy("file")
        .applyInPandas(_hot_words(least), "file int, words binary, total long, kinds long, hot binary")
    )
    summed = words.agg(F.sum("total").alias("total"), F.sum("kinds").alias("kinds")).first()
    # At most tokens / least of them, a few per file.
    hot = [unpack(r["hot"], np.uint64, np.int64) for r in words.select("hot").collect()]
    hot_words = np.concatenate([h[0] for h in hot]) if hot else np.zeros(0, np.uint64)
    hot_counts = np.concatenate([h[1] for h in hot]) if hot else np.zeros(0, np.int64)
    texts = hashed.filter(~F.col("held_out")).count()
    if texts >= least:
        hot_words, hot_counts = np.r_[hot_words, np.uint64(start & (2**64 - 1))], np.r_[hot_counts, texts]
    order = np.argsort(hot_words)
    spread = -(-hot_counts[order] // int(least))
    shape = Shape(folder, files, hot_words[order], spread, start, end)

    pairs = scratch.keep(
        hashed.filter(~F.col("held_out"))
        .select("t")
        .mapInArrow(_count_pairs(shape), BLOB)
        .groupBy("file")
        .applyInPandas(_merge_pairs(shape), f"{BLOB}, seen array<long>")
    )
    high = np.array([r["seen"] for r in pairs.filter("seen is not null").select("seen").collect()]).reshape(-1, 4).sum(axis=0)
    both = pairs.select("file", "blob", F.lit(None).cast("binary").alias("words")).union(
        words.select("file", F.lit(None).cast("binary"), "words")
    )
    low = both.groupBy("file").applyInPandas(_merge_words(shape), "file int, seen array<long>").collect()
    seen = np.array([r["seen"] for r in low]).reshape(-1, 5).sum(axis=0)
    distinct = int(_distinct_pairs(folder, files))
    low_d = discounts(seen)
    low_left = (low_d[1] * seen[0] + low_d[2] * seen[1] + low_d[3] * seen[4]) / distinct if distinct else 1.0
    return LanguageModel(
        shape, summed["total"] or 0, summed["kinds"] or 0, texts, distinct, discounts(high), low_d, float(low_left)
    )


def _distinct_pairs(folder: str, files: int) -> int:
    """Pairs in all files, from the files' headers."""
    names = [f"{folder}/pair-{i}.npy" for i in range(files)]
    return sum(len(np.load(n, mmap_mode="r")) for n in names if os.path.exists(n))


SCORED = "held_out boolean, n_tokens long, n_known long, base_score double, score double"


def score_lm(docs: DataFrame, folds: int = 10, held: int = 0) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity`` per row.

    The model is an interpolated modified Kneser-Ney bigram model over a uniform share for unknown
    words, counted from all texts outside the held-out fold. Tasks count their tokens before anything
    is shuffled, as packed arrays of hashes; a word's pairs stay together unless the word is frequent,
    then they are spread over several files, so no file grows with one word. The files hold sorted
    64-bit hashes and counts in the shared folder, which the scoring tasks map into memory.

    ``score`` is the model's log10 probability of the text and its end, ``base_score`` that of the
    smoothed unigram model. Null and empty texts consist of their end alone. Repeated rows are scored
    (and learnt) each; a null id hashes as an empty text; other columns are ignored; an empty table
    gives no rows. With no training text every token has probability one.
    """
    spark = docs.sparkSession
    model = train(docs, Scratch(spark), folds, held)
    kind = dict(docs.dtypes)["doc_id"]
    base_total = np.log10(model.train_tokens + ADDED * (model.vocabulary + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, flat, lengths in chunks(batches, model.shape.end):
            logs, counts = model.log10(flat, lengths)
            first = np.cumsum(lengths) - lengths
            per_row = lambda v: np.add.reduceat(v, first)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("held_out"),
                    pa.array(lengths.astype(np.int64)),
                    pa.array(per_row((counts > 0).astype(np.int64))),
                    pa.array(per_row(np.log10(counts + ADDED) - base_total)),
                    pa.array(per_row(logs)),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
            )

    scored = _hashed(docs, folds, held).mapInArrow(run, f"doc_id {kind}, {SCORED}")
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )

"""Quality classifier: random-indexing word vectors, a two-layer network, calibrated probabilities."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.work import Scratch

# Documented bound: the classifier is fitted on at most this many labelled rows, those with the
# smallest hashed ids. Scoring covers every row.
SAMPLE_ROWS = 8192
# Word vectors are kept for the sample's most frequent words.
VOCABULARY, DIMENSIONS, NONZERO, WINDOW = 16_384, 96, 8, 2
BLOCKS = 16
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 60, 128, 2e-3, 1e-3
# One word, number or run of signs.
PIECE = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")


def in_fold(column: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % folds == fold


@dataclass
class Model:
    words: dict[str, int]
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def features(self, text: str | None) -> np.ndarray:
        return pooled(text, self.words, self.vectors)

    def scores(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0)
        return _sigmoid((hidden @ self.w2 + self.b2) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each word's few non-zero entries, the same in every process."""
    rng = np.random.default_rng(4)
    places = rng.integers(0, DIMENSIONS, (VOCABULARY, NONZERO))
    return places, rng.choice(np.array([-1.0, 1.0]), (VOCABULARY, NONZERO))


def pooled(text: str | None, words: dict[str, int], vectors: np.ndarray) -> np.ndarray:
    """Mean word vector of the whole text, and how varied and how odd its words are."""
    counts = Counter(PIECE.findall(text or ""))
    total = sum(counts.values())
    out = np.zeros(DIMENSIONS + 7)
    if not total:
        return out
    known: Counter[int] = Counter()
    upper = signs = letters = 0
    for piece, n in counts.items():
        i = words.get(piece.lower())
        if i is not None:
            known[i] += n
        if piece[0].isalpha():
            letters += n * len(piece)
            if len(piece) > 1 and piece.isupper():
                upper += n
        elif not piece[0].isdigit():
            signs += n * len(piece)
    hits = sum(known.values())
    if hits:
        weights = np.fromiter(known.values(), float, len(known)) / hits
        out[:DIMENSIONS] = weights @ vectors[np.fromiter(known.keys(), int, len(known))]
    top = max(counts.values())
    out[DIMENSIONS:] = (
        np.log1p(total),
        len(counts) / total,
        top / total,
        upper / total,
        signs / (signs + letters + 1),
        hits / total,
        np.linalg.norm(out[:DIMENSIONS]),
    )
    return out


def _count_words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: Counter[str] = Counter()
    for frame in frames:
        for text in frame["text"]:
            counts.update(p.lower() for p in PIECE.findall(text or ""))
    if counts:
        yield pd.DataFrame({"word": list(counts.keys()), "n": list(counts.values())})


def _contexts(words: dict[str, int]):
    """Per partition, the sum of the neighbours' index vectors for every known word."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places, signs = index_vectors()
        sums = np.zeros(VOCABULARY * DIMENSIONS)
        for frame in frames:
            for text in frame["text"]:
                pieces = PIECE.findall(text or "")
                ids = np.fromiter((words.get(p.lower(), -1) for p in pieces), int, len(pieces))
                for step in range(1, WINDOW + 1):
                    for a, b in ((ids[:-step], ids[step:]), (ids[step:], ids[:-step])):
                        both = (a >= 0) & (b >= 0)
                        at = (a[both, None] * DIMENSIONS + places[b[both]]).ravel()
                        np.add.at(sums, at, signs[b[both]].ravel())
        parts = np.split(sums, BLOCKS)
        yield pd.DataFrame({"block": range(BLOCKS), "sums": [p.tobytes() for p in parts]})

    return run


def _add_blocks(frame: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.frombuffer(b) for b in frame["sums"]], axis=0)
    return pd.DataFrame({"block": [frame["block"].iloc[0]], "sums": [total.tobytes()]})


def word_vectors(sample: DataFrame) -> tuple[dict[str, int], np.ndarray]:
    """Vocabulary and unit context vectors of the sample's words."""
    counted = sample.mapInPandas(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "word").limit(VOCABULARY).collect()
    words = {r["word"]: i for i, r in enumerate(top)}
    blocks = (
        sample.mapInPandas(_contexts(words), "block int, sums binary")
        .groupBy("block")
        .applyInPandas(_add_blocks, "block int, sums binary")
        .collect()
    )
    sums = {r["block"]: np.frombuffer(r["sums"]) for r in blocks}
    size = VOCABULARY * DIMENSIONS // BLOCKS
    table = np.concatenate([sums.get(b, np.zeros(size)) for b in range(BLOCKS)]).reshape(VOCABULARY, DIMENSIONS)
    norms = np.linalg.norm(table, axis=1, keepdims=True)
    return words, (table / np.where(norms > 0, norms, 1)).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, scratch: Scratch, folds: int = 3, held: int = 1) -> Model | None:
    """Learn from the labelled rows outside the held-out fold; ``None`` without any."""
    usable = (
        labels.filter(~in_fold(F.col("doc_id"), folds, held) & F.col("quality").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(SAMPLE_ROWS)
    )
    sample = scratch.keep(
        docs.select("doc_id", "text").join(F.broadcast(usable), "doc_id").dropDuplicates(["doc_id"])
    )
    words, vectors = word_vectors(sample)
    shipped = sample.sparkSession.sparkContext.broadcast((words, vectors))

    def pool(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, table = shipped.value
        for frame in frames:
            x = [pooled(t, known, table).tobytes() for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "quality": frame["quality"], "x": x})

    rows = sample.mapInPandas(pool, "doc_id long, quality int, x binary").orderBy("doc_id").collect()
    if not rows:
        return None
    x = np.array([np.frombuffer(r["x"]) for r in rows])
    y = np.array([r["quality"] for r in rows], dtype=float)
    # A fifth of the sample is kept for early stopping and the temperature.
    aside = np.array([zlib.crc32(b"calibrate%d" % r["doc_id"]) % 5 == 0 for r in rows])
    if aside.all() or not aside.any():
        aside = np.zeros(len(rows), bool)
    return _train(words, vectors, x[~aside], y[~aside], x[aside], y[aside])


def _train(words, vectors, x, y, cx, cy) -> Model:
    """Two layers by Adam with weight decay; the epoch with the least loss set aside is kept."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z, cz = (x - mean) / scale, (cx - mean) / scale
    rng = np.random.default_rng(4)
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    params = [
        rng.normal(0, np.sqrt(2 / z.shape[1]), (z.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN) * 0.1,
        np.array(np.log(share / (1 - share))),
    ]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    best, kept, t = np.inf, params, 0
    logits = lambda p, a: np.maximum(a @ p[0] + p[1], 0) @ p[2] + p[3]
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            pick, t = order[at : at + BATCH], t + 1
            a, target = z[pick], y[pick]
            pre = a @ params[0] + params[1]
            hidden = np.maximum(pre, 0)
            error = (_sigmoid(hidden @ params[2] + params[3]) - target) / len(pick)
            back = np.outer(error, params[2]) * (pre > 0)
            grads = [a.T @ back, back.sum(axis=0), hidden.T @ error, np.array(error.sum())]
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                move = (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
                params[i] = params[i] - RATE * (move + DECAY * params[i] * (i in (0, 2)))
        loss = _loss(logits(params, cz), cy) if len(cy) else _loss(logits(params, z), y)
        if loss < best:
            best, kept = loss, [p.copy() for p in params]
    temperature = 1.0
    if len(cy):
        out = logits(kept, cz)
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 201))
        temperature = float(min(grid, key=lambda s: _loss(out / s, cy)))
    return Model(words, vectors, mean, scale, kept[0], kept[1], kept[2], float(kept[3]), temperature)


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    p = np.clip(_sigmoid(z), 1e-9, 1 - 1e-9)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


def score_quality(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Words get random-indexing vectors (sums of sparse index vectors of their neighbours) from a bounded
    labelled sample, documents the mean of their words' vectors and a few figures of variety, and a
    two-layer network turns these into a probability, divided by a temperature fitted on rows it did
    not learn from. Only ``text`` enters a score: equal texts have equal scores. Nothing is shuffled
    for scoring; the model sent to the tasks has a fixed size.

    Null and empty texts are scored like any other, from empty features. Rows with null or repeated
    ids are scored each; labels with other values than 0 and 1 are ignored, of repeated ones the
    higher counts. Without any usable label every score is 0.5. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    model = fit(docs, labels, scratch, folds, held)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = scores_of(batch, shipped.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores)], names=["doc_id", "held_out", "score"]
            )

    rows = docs.select("doc_id", in_fold(F.col("doc_id"), folds, held).alias("held_out"), "text")
    kind = dict(docs.dtypes)["doc_id"]
    scored = rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def scores_of(batch: pa.RecordBatch, model: Model | None) -> np.ndarray:
    if model is None or not batch.num_rows:
        return np.full(batch.num_rows, 0.5)
    return model.scores(np.array([model.features(t.as_py()) for t in batch.column("text")]))


def keep_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose text the classifier does not reject, with their columns."""
    scratch = Scratch(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, scratch))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(scores_of(batch, model.value) >= 0.5))

    return docs.mapInArrow(run, docs.schema)

"""Substring deduplication: word windows that also start in an earlier document, by FM-indexes."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.fm_index import FMIndex
from millrace.llm.lm import M1, M2, deal, file_of, mapped, pack, save, unpack_all
from millrace.llm.work import Scratch, mounted, tokens, with_columns_last

# Words of a window, and of the anchors: of the GRAM-word runs inside a window the one with the least
# hash anchors it, so equal windows have equal anchors wherever they stand.
WINDOW, GRAM = 13, 6
# Words worked on at once in a task, and words of the corpus per shard.
PIECE, PER_SHARD = 1 << 20, 1 << 19
NULL_ID = np.iinfo(np.int64).min


def scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * M1
    h = (h ^ (h >> np.uint64(33))) * M2
    return h ^ (h >> np.uint64(33))


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("h"),
        F.transform(tokens(F.col("text")), lambda w: F.xxhash64(w)).alias("t"),
    )


class Piece:
    """Some documents' words one after the other, with the windows that lie inside one document."""

    def __init__(self, batch: pa.RecordBatch):
        column = batch.column("t")
        offsets = column.offsets.to_numpy().astype(np.int64)
        self.offsets = offsets - offsets[0]
        self.words = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        ids = batch.column("doc_id")
        self.ids = ids.fill_null(NULL_ID).to_numpy(zero_copy_only=False)
        self.hashes = batch.column("h").to_numpy(zero_copy_only=False)
        lengths = np.diff(self.offsets)
        self.doc = np.repeat(np.arange(len(lengths)), lengths)
        count = max(0, len(self.words) - WINDOW + 1)
        self.starts = np.flatnonzero(self.doc[:count] == self.doc[WINDOW - 1 :][:count]) if count else np.zeros(0, np.int64)

    def anchors(self) -> np.ndarray:
        """The anchor hash of each window in ``starts``."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        n = len(self.words) - GRAM + 1
        gram = np.zeros(n, np.uint64)
        for k in range(GRAM):
            gram = gram * np.uint64(6364136223846793005) + self.words[k : k + n]
        gram = scramble(gram)
        # Running minimum over the window's grams, by doubling.
        span, least, width = WINDOW - GRAM + 1, gram, 1
        while width * 2 <= span:
            least, width = np.minimum(least[:-width], least[width:]), width * 2
        if width < span:
            over = span - width
            least = np.minimum(least[:-over], least[over:])
        return least[self.starts]


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[Piece]:
    for batch in batches:
        offsets = batch.column("t").offsets.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + PIECE, "right")) - 1)
            yield Piece(batch.slice(start, stop - start))
            start = stop


BLOB = "file int, blob binary"


def _blobs(files: np.ndarray, *arrays: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(deal(files, *arrays), schema=pa.schema([("file", pa.int32()), ("blob", pa.binary())]))


def _anchor_rows(shards: int):
    """Distinct anchors of a piece with the least and greatest document that has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            anchors = piece.anchors()
            if not len(anchors):
                continue
            ids = piece.ids[piece.doc[piece.starts]]
            # Neighbouring windows mostly share their anchor.
            change = np.r_[True, (anchors[1:] != anchors[:-1]) | (ids[1:] != ids[:-1])]
            anchors, ids = anchors[change], ids[change]
            order = np.argsort(anchors, kind="stable")
            anchors, ids = anchors[order], ids[order]
            first = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])
            low, high = np.minimum.reduceat(ids, first), np.maximum.reduceat(ids, first)
            yield _blobs(file_of(anchors[first], shards), anchors[first], low, high)

    return run


def _repeated(folder: str):
    """Write the anchors of a hash range that more than one document has."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        name = int(frame["file"].iloc[0])
        anchors, low, high = unpack_all(frame["blob"], np.uint64, np.int64, np.int64)
        order = np.argsort(anchors, kind="stable")
        anchors = anchors[order]
        first = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])
        several = np.minimum.reduceat(low[order], first) < np.maximum.reduceat(high[order], first)
        save(folder, f"anchor-{name}", anchors[first][several])
        return pd.DataFrame({"file": [name], "n": [int(several.sum())]})

    return run


def _known(folder: str, files: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Whether anchors are in the written files; queries are sorted, so files are read front to back."""
    unique, back = np.unique(anchors, return_inverse=True)
    found = np.zeros(len(unique), bool)
    of = files[np.unique(anchors, return_index=True)[1]]
    cuts = np.flatnonzero(np.diff(of)) + 1  # ranges of hashes: sorted by file as well
    for part in np.split(np.arange(len(unique)), cuts) if len(unique) else []:
        name = int(of[part[0]])
        if os.path.exists(f"{folder}/anchor-{name}.npy"):
            table = mapped(folder, f"anchor-{name}")
            at = np.searchsorted(table, unique[part])
            inside = at < len(table)
            found[part[inside]] = table[at[inside]] == unique[part[inside]]
    return found[back]


def _segments(folder: str, shards: int):
    """Stretches of windows with one repeated anchor, dealt out by the anchor.

    Equal stretches of a piece are sent once, with all the places they stand at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            anchors = piece.anchors()
            files = file_of(anchors, shards)
            keep = _known(folder, files, anchors)
            starts, anchors, files = piece.starts[keep], anchors[keep], files[keep]
            if not len(starts):
                continue
            doc = piece.doc[starts]
            begins = np.flatnonzero(np.r_[True, (anchors[1:] != anchors[:-1]) | (starts[1:] != starts[:-1] + 1) | (doc[1:] != doc[:-1])])
            first = starts[begins]
            length = starts[np.r_[begins[1:], len(starts)] - 1] + WINDOW - first
            one, two = stretch_hashes(piece.words, first, length)
            order = np.lexsort((two, one))
            same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
            number = np.empty(len(order), np.int64)
            number[order] = np.cumsum(np.r_[0, ~same])
            sample = order[np.r_[True, ~same]]
            yield pa.RecordBatch.from_pydict(
                _shard_rows(piece, files[begins], first, length, number, sample), schema=pa.schema([("file", pa.int32()), ("blob", pa.binary())])
            )

    return run


def stretch_hashes(words: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each stretch, from sums of words weighted by their place in it."""
    at = np.repeat(first - (np.cumsum(length) - length), length) + np.arange(length.sum())
    place = (at - np.repeat(first, length)).astype(np.uint64)
    bounds = np.cumsum(length) - length
    one = np.add.reduceat(scramble(words[at] + place * M1), bounds)
    two = np.add.reduceat(scramble((words[at] ^ M2) + place * M2), bounds)
    return one ^ length.astype(np.uint64), two


def _shard_rows(piece: Piece, files, first, length, number, sample) -> dict[str, list]:
    """Per shard: its stretches' words (as codes into a list of words) and places (document, start)."""
    out: dict[str, list] = {"file": [], "blob": []}
    order = np.argsort(files, kind="stable")
    cuts = np.flatnonzero(np.diff(files[order])) + 1
    sample_files = files[sample]
    by_file = np.argsort(sample_files, kind="stable")
    sample = sample[by_file]
    edges = sample_files[by_file]
    renumber = np.empty(len(sample), np.int64)
    for part in np.split(order, cuts):
        name = files[part[0]]
        some = sample[np.searchsorted(edges, name) : np.searchsorted(edges, name, "right")]
        renumber[number[some]] = np.arange(len(some))
        words, codes = np.unique(piece.words[_places(first[some], length[some])], return_inverse=True)
        docs, doc_at = np.unique(piece.doc[first[part]], return_inverse=True)
        blob = b"".join(
            [
                pack(words),
                pack(codes.astype(np.uint32)),
                pack(length[some].astype(np.uint32)),
                pack(piece.ids[docs]),
                pack(piece.hashes[docs]),
                pack(doc_at.astype(np.uint32)),
                pack((first[part] - piece.offsets[piece.doc[first[part]]]).astype(np.uint32)),
                pack(renumber[number[part]].astype(np.uint32)),
            ]
        )
        out["file"].append(int(name))
        out["blob"].append(blob)
    return out


PARTS = (np.uint64, np.uint32, np.uint32, np.int64, np.int64, np.uint32, np.uint32, np.uint32)


def _read_parts(blob: bytes) -> list[np.ndarray]:
    out, at = [], 0
    for kind in PARTS:
        n = int(np.frombuffer(blob, np.int64, 1, at)[0])
        out.append(np.frombuffer(blob, kind, n, at + 8))
        at += 8 + n * np.dtype(kind).itemsize
    return out


def _places(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Positions of stretches, one after the other."""
    return np.repeat(first - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))


FOUND = "doc_id long, h long, starts array<int>, ends array<int>"


def shard_repeats(blobs: list[bytes]) -> tuple[np.ndarray, ...]:
    """Ids, text hashes, starts and ends of the word ranges that an earlier document has as well.

    Distinct stretches are indexed once with the least document they stand in. The documents' stretches
    are then streamed through the index: where the matching statistics reach a window's length, the
    match's suffix range names every place the window starts at, and so the least document.
    """
    lengths, ids, hashes, doc_at, starts, stretch = [], [], [], [], [], []
    flat, docs_before, stretches_before = [], 0, 0
    for blob in blobs:
        words, codes, length, i, h, d, s, n = _read_parts(blob)
        flat.append(words[codes])
        lengths.append(length.astype(np.int64))
        ids.append(i)
        hashes.append(h)
        doc_at.append(d.astype(np.int64) + docs_before)
        starts.append(s.astype(np.int64))
        stretch.append(n.astype(np.int64) + stretches_before)
        docs_before, stretches_before = docs_before + len(i), stretches_before + len(length)
    words, length = np.concatenate(flat), np.concatenate(lengths)
    ids, hashes = np.concatenate(ids), np.concatenate(hashes)
    doc_at, starts, stretch = np.concatenate(doc_at), np.concatenate(starts), np.concatenate(stretch)

    # Equal stretches of several pieces become one.
    first = np.cumsum(length) - length
    one, two = stretch_hashes(words, first, length)
    order = np.lexsort((two, one))
    new = np.r_[True, (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    keep = order[new]
    stretch = number[stretch]
    length = length[keep]
    _, codes = np.unique(words[_places(first[keep], length)], return_inverse=True)
    least = np.full(len(keep), np.iinfo(np.int64).max)
    np.minimum.at(least, stretch, ids[doc_at])

    # A separator before each stretch.
    begin = np.cumsum(length + 1) - length
    text = np.zeros(int((length + 1).sum()) + 1, np.int64)
    text[_places(begin, length)] = codes + 1
    index = FMIndex(text, WINDOW)
    count = length - WINDOW + 1
    at = _places(begin, count)
    matched, low, high = index.matching(text, at + WINDOW, WINDOW)
    # Suffix ranges of whole windows are equal or apart; the places outside are no windows' starts.
    of_suffix = np.zeros(len(text), np.int64)
    of_suffix[_places(begin, length)] = np.repeat(least, length)
    ranges, back = np.unique(low, return_inverse=True)
    ends = np.zeros(len(ranges), np.int64)
    ends[back] = high
    sorted_least = np.r_[of_suffix[index.suffixes], np.iinfo(np.int64).max]  # so a range may end at the end
    earliest = np.minimum.reduceat(sorted_least, np.c_[ranges, ends].ravel())[::2] if len(ranges) else ranges
    window_least = np.where(matched >= WINDOW, earliest[back], np.iinfo(np.int64).max)

    # Per place of a stretch, its windows that start in an earlier document.
    offset = np.cumsum(count) - count
    places = _places(offset[stretch], count[stretch])
    place_doc = np.repeat(doc_at, count[stretch])
    place_start = np.repeat(starts, count[stretch]) + places - np.repeat(offset[stretch], count[stretch])
    hit = window_least[places] < ids[place_doc]
    doc, start = place_doc[hit], place_start[hit]
    return merged(ids[doc], hashes[doc], start, start + WINDOW)


def merged(ids: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges of each document joined where they touch, in order of document and start."""
    order = np.lexsort((starts, hashes, ids))
    ids, hashes, starts, ends = ids[order], hashes[order], starts[order], ends[order]
    new = np.r_[len(ids) > 0, (ids[1:] != ids[:-1]) | (hashes[1:] != hashes[:-1])]
    # The furthest end so far within the document: ends grow by document when shifted far enough.
    shift = np.cumsum(new) * (int(ends.max(initial=0)) + 1)
    reach = np.maximum.accumulate(ends + shift)
    opens = new | np.r_[False, starts[1:] + shift[1:] > reach[:-1]]
    at = np.flatnonzero(opens)
    last = np.r_[at[1:], len(ids)][: len(at)] - 1
    return ids[at], hashes[at], starts[at], (reach - shift)[last]


def _search(shards: int):
    """A shard's ranges, dealt out by document."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        ids, hashes, starts, ends = shard_repeats(list(frame["blob"]))
        files = file_of(scramble(ids.view(np.uint64)), shards)
        return pd.DataFrame(deal(files, ids, hashes, starts.astype(np.uint32), ends.astype(np.uint32)), columns=["file", "blob"])

    return run


def _of_documents(frame: pd.DataFrame) -> pd.DataFrame:
    """One row per document with all its ranges."""
    parts = unpack_all(frame["blob"], np.int64, np.int64, np.uint32, np.uint32)
    ids, hashes, starts, ends = merged(parts[0], parts[1], *[p.astype(np.int64) for p in parts[2:]])
    heads = np.flatnonzero(np.r_[len(ids) > 0, (ids[1:] != ids[:-1]) | (hashes[1:] != hashes[:-1])])
    lists = lambda v: pd.Series(np.split(v.astype(np.int32), heads[1:]), dtype=object)
    out = pd.DataFrame({"doc_id": pd.array(ids[heads], dtype="Int64"), "h": hashes[heads], "starts": lists(starts), "ends": lists(ends)})
    out["doc_id"] = out["doc_id"].mask(out["doc_id"] == NULL_ID)
    return out


def repeated_ranges(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``(doc_id, h, starts, ends)``, one row per document: ranges of words that repeat earlier documents."""
    hashed = _hashed(docs)
    folder = mounted(scratch.new_path())
    os.makedirs(folder)
    letters = docs.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    shards = max(1, -(-(letters // 5) // PER_SHARD))
    # Only counts come back; the anchors are in the files.
    hashed.select("doc_id", "h", "t").mapInArrow(_anchor_rows(shards), BLOB).groupBy("file").applyInPandas(
        _repeated(folder), "file int, n long"
    ).agg(F.sum("n")).first()
    sent = hashed.mapInArrow(_segments(folder, shards), BLOB)
    found = sent.groupBy("file").applyInPandas(_search(shards), BLOB)
    return scratch.keep(found.groupBy("file").applyInPandas(_of_documents, FOUND))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Documents without the words of windows that also start in a document with a smaller id.

    Words are runs of anything but blanks. Each window of ``WINDOW`` words belongs to the shard of its
    anchor, so equal windows meet in one shard wherever they stand, and only windows whose anchor is in
    two documents or more are sent there. A shard builds an FM-index of its distinct stretches and
    streams the documents' stretches through it (``shard_repeats``). A passage that a third of all
    documents share reaches its shard once per task, with a list of places.

    Adds ``n_words``, ``n_removed`` and ``text``: the kept words, joined by one blank; input columns of
    these names give way. Null texts have no words, like empty ones. Windows are judged on the input.
    Rows with the same id do not remove each other's words; a null id counts as smaller than any other.
    An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    ranges = repeated_ranges(docs.select("doc_id", "text"), scratch)
    cut = ranges.select(
        F.col("doc_id").alias("__id"), F.col("h").alias("__h"), F.arrays_zip("starts", "ends").alias("__ranges")
    )
    gone = F.flatten(F.transform("__ranges", lambda r: F.sequence(r["starts"], r["ends"] - 1)))
    joined = docs.join(cut, docs["doc_id"].eqNullSafe(F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__h")), "left")
    worded = joined.withColumn("__words", tokens(F.col("text"))).withColumn("__gone", F.coalesce(gone, F.array().cast("array<int>")))
    left = F.array_except(F.sequence(F.lit(0), F.size("__words") - 1), F.col("__gone"))
    kept = F.when(F.size("__gone") == 0, F.col("__words")).otherwise(F.transform(left, lambda i: F.get("__words", i)))
    return with_columns_last(
        worded,
        n_words=F.size("__words").cast("long"),
        n_removed=F.size("__gone").cast("long"),
        text=F.array_join(kept, " "),
    ).drop("__id", "__h", "__ranges", "__words", "__gone")


def digest(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def oracle(window: int = WINDOW) -> str:
    """The digest rows in DuckDB SQL."""
    return f"""with d as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w
 from documents),
s as (select doc_id, w, unnest(range(1, len(w) - {window} + 2)) as pos from d where len(w) >= {window}),
h as (select doc_id, pos, list_slice(w, pos, pos + {window} - 1) as win from s),
m as (select doc_id, pos, min(doc_id) over (partition by win) as first_doc from h),
r as (select distinct doc_id, unnest(range(pos, pos + {window})) as p from m where first_doc < doc_id),
g as (select doc_id, list(p) as gone, count(*) as n from r group by 1)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_removed,
 sha256(array_to_string(case when gone is null then w else
  [x[1] for x in list_filter(list_zip(w, range(1, len(w) + 1)), lambda z: not list_contains(gone, z[2]))] end, ' ')) as kept_sha256
from d left join g using (doc_id)"""

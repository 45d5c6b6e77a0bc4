"""Substring de-duplication over words with difference-cover anchors."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ebbtide.llm.places import (
    SCHEMA, Layout, by_bucket, groups, later, owned, parts_for, positions, sent, shared,
    text_columns)
from ebbtide.llm.staging import batches, id_back, id_or_least, keep, only, unused

# The differences of these residues give every residue of the period.
COVERS = ((13, (0, 1, 3, 9)), (7, (0, 1, 3)), (3, (0, 1)), (1, (0,)))
SLICE = 4 << 20
ANCHOR = Layout()
WINDOW = Layout(("<u8",), ("<u4",))
SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


@dataclass(frozen=True)
class Cover:
    """Anchor positions for windows of window words: an anchor starts at a covered residue.

    Two equal windows at i and j have an offset below the period at which both i + offset and
    j + offset are covered, so they share an anchor of window - period + 1 words.
    """

    window: int
    period: int
    residues: tuple[int, ...]

    @classmethod
    def of(cls, window: int) -> Cover:
        period, residues = next(c for c in COVERS if c[0] <= min(window, window // 2 + 3))
        return cls(window, period, residues)

    @property
    def size(self) -> int:
        return self.window - self.period + 1

    def positions(self, words: int) -> np.ndarray:
        """Anchors inside some window of a text of so many words."""
        if words < self.window:
            return np.zeros(0, np.int64)
        at = np.arange(words - self.size + 1)
        return at[np.isin(at % self.period, self.residues)]

    def windows(self, anchors: np.ndarray, words: int) -> np.ndarray:
        """Starts of all windows that hold one of the anchors."""
        last = words - self.window
        if last < 0:
            return np.zeros(0, np.int64)
        marks = np.zeros(last + 2, np.int64)
        np.add.at(marks, np.clip(anchors - (self.period - 1), 0, last + 1), 1)
        np.add.at(marks, np.clip(anchors + 1, 0, last + 1), -1)
        return np.flatnonzero(np.cumsum(marks[:-1]) > 0)


class Words:
    """The words of one text, joined by one space, with the place of each."""

    def __init__(self, text: bytes):
        self.words = text.split()
        self.n = len(self.words)
        self.joined = b" ".join(self.words)
        self.ends = np.cumsum(np.fromiter(map(len, self.words), np.int64, self.n) + 1) - 1
        self.starts = self.ends - np.fromiter(map(len, self.words), np.int64, self.n)

    def pieces(self, at: np.ndarray, size: int):
        joined = self.joined
        for s, e in zip(self.starts[at].tolist(), self.ends[at + size - 1].tolist()):
            yield joined[s:e]


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, tid, text): tid tells texts apart that share an id; NULL texts are empty."""
    return only(docs, doc=key, text=text).select(
        id_or_least("doc").alias("doc"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).select("doc", F.xxhash64("text").alias("tid"), "text")


def shared_anchors(docs: DataFrame, cover: Cover, parts: int) -> DataFrame:
    """(doc, tid, ats): anchors whose words occur at two places or more, of any text.

    Inside a slice of rows an anchor that occurs several times is known to be shared at once
    and sends one entry only, so a common passage costs one entry a slice, not one a copy.
    """
    def run(items):
        digest = xxhash.xxh3_64_intdigest
        for batch in batches(items, SLICE):
            names, starts, keys = [], [], []
            for doc, tid, text in zip(*text_columns(batch)):
                words = Words(text)
                at = cover.positions(words.n)
                if len(at):
                    names.append(np.fromiter(
                        map(digest, words.pieces(at, cover.size)), np.uint64, len(at)))
                    starts.append(at)
                    keys.append((doc, tid))
            if keys:
                low = np.concatenate(names)
                places = owned(starts, keys, low, np.zeros_like(low))
                order, new = groups(places)
                send = np.zeros(len(low), bool)
                send[order] = new
                yield from sent(places, send, {1: shared(places)}, ANCHOR, parts)

    return by_bucket(docs.mapInArrow(run, SCHEMA), ANCHOR, lambda p: {1: shared(p)}, parts)


def later_windows(texts: DataFrame, cover: Cover, parts: int) -> DataFrame:
    """texts(doc, tid, text, ats) -> (doc, tid, ats): windows whose words also start earlier.

    Windows are compared by 96-bit fingerprints of their exact words. Inside a slice only the
    earliest place of a window goes on to the comparison by bucket; the others are decided.
    """
    def run(items):
        digest = xxhash.xxh3_128_digest
        for batch in batches(items, SLICE):
            names, starts, keys = [], [], []
            for doc, tid, text, blobs in zip(*text_columns(batch), batch.column(3).to_pylist()):
                words = Words(text)
                at = cover.windows(positions(blobs), words.n)
                if len(at):
                    names += map(digest, words.pieces(at, cover.window))
                    starts.append(at)
                    keys.append((doc, tid))
            if keys:
                name = np.frombuffer(b"".join(names), "<u8").reshape(-1, 2)
                places = owned(starts, keys, name[:, 0], name[:, 1] & np.uint64(0xFFFFFFFF))
                late = later(places)
                yield from sent(places, ~late, {1: late}, WINDOW, parts)

    return by_bucket(texts.mapInArrow(run, SCHEMA), WINDOW, lambda p: {1: later(p)}, parts)


def cut(text: bytes, windows: np.ndarray, size: int) -> tuple[int, int, bytes, bytes]:
    """Words, removed words, kept words joined by one space, and text without removed words.

    In the last the white space after a removed word goes with it; all else stays as it is.
    """
    words = Words(text)
    marks = np.zeros(words.n + 1, np.int64)
    np.add.at(marks, windows, 1)
    np.add.at(marks, windows + size, -1)
    gone = np.cumsum(marks[:-1]) > 0
    if not gone.any():
        return words.n, 0, words.joined, text
    kept = b" ".join([w for w, g in zip(words.words, gone.tolist()) if not g])
    data = np.frombuffer(text, np.uint8)
    blank = SPACE[data]
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    stay = np.repeat(~gone, np.diff(np.append(starts, len(data))))
    return words.n, int(gone.sum()), kept, text[:starts[0]] + data[starts[0]:][stay].tobytes()


def cut_repeats(docs: DataFrame, *, window: int = 20, key: str = "doc_id", text: str = "text",
                length: str | None = "n_chars") -> DataFrame:
    """docs, all columns and rows, with the text and its length after substring_dedup.

    Rows whose text loses nothing stay as they are; a text that loses all its words is empty or
    white space. length names a column that holds the number of characters, if there is one.
    """
    doc, kept, tid = unused(docs, "cut_id", "cut_text", "cut_tid")
    shorter = (substring_dedup(docs, window=window, key=key, text=text)
               .where(F.col("n_removed") > 0)
               .select(F.col(key).alias(doc), F.col("kept_text").alias(kept),
                       F.col("_tid").alias(tid))
               .dropDuplicates([doc, tid]))
    match = docs[key].cast("long").eqNullSafe(shorter[doc]) & (
        F.xxhash64(F.coalesce(docs[text].cast("string"), F.lit(""))) == shorter[tid])
    new = {text: F.coalesce(kept, F.col(text))}
    if length in docs.columns:
        new[length] = F.when(F.col(kept).isNull(), F.col(length)).otherwise(
            F.char_length(kept)).cast(docs.schema[length].dataType)
    return docs.join(shorter, match, "left").withColumns(new).select(*docs.columns)


def substring_dedup(docs: DataFrame, *, window: int = 20, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """Per row of docs: key, n_words, n_removed, kept_text and kept_sha256.

    A word goes if a window of window words that covers it also starts earlier: in a text with
    a smaller id, or earlier in the same text. Windows are judged on the input. Words are runs
    of anything but ASCII white space, unchanged. kept_text is the input without the removed
    words and the space after them; kept_sha256 is over the kept words joined by one space.
    NULL or empty texts and texts shorter than a window lose nothing. A NULL id comes before
    all others; rows with the same id and text are the same place, so neither is earlier and
    both keep their words. Other columns are ignored; an empty table gives an empty result.
    """
    cover = Cover.of(window)
    rows = keyed(docs, key, text)
    parts = parts_for(rows)
    # a NULL id may stand on many rows, so texts meet their places by id and text
    same = ["doc", "tid"]
    near = keep(shared_anchors(rows, cover, parts).select(*same, F.array("ats").alias("ats")))
    placed = rows.repartition(parts, *same)
    late = later_windows(placed.join(near, same).select(*same, "text", "ats"), cover, parts)
    gone = late.select(*same, F.array("ats").alias("ats"))

    def run(items):
        for batch in batches(items, SLICE):
            out = [[], [], [], [], [], []]
            for doc, tid, value, ats in zip(*text_columns(batch), batch.column(3).to_pylist()):
                n, removed, kept, rest = cut(value, positions(ats), window)
                for column, item in zip(out, (doc, n, removed, rest.decode(),
                                              hashlib.sha256(kept).hexdigest(), tid)):
                    column.append(item)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(),
                                                      pa.string(), pa.string(), pa.int64()))],
                names=["doc", "n_words", "n_removed", "kept_text", "kept_sha256", "tid"])

    # placed stands twice in the plan and is shuffled once
    found = placed.join(gone, same, "left").select(*same, "text", "ats")
    return found.mapInArrow(
        run, "doc long, n_words long, n_removed long, kept_text string, kept_sha256 string, "
             "tid long").select(
        id_back(F.col("doc")).alias(key), "n_words", "n_removed", "kept_text", "kept_sha256",
        F.col("tid").alias("_tid"))

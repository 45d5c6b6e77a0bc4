"""Repeated byte strings by distributed prefix doubling over sampled suffixes.

The rank of a position stands for the string of a given length that starts there. Ranks are
fingerprints: the rank of twice the length is made from the ranks at the position and one length
further, so a task can pair them without asking another. Which ranks are unique is what Spark
finds out, by sorting them in buckets, and a position whose rank is unique leaves. Round one ranks
sampled positions at 128 bytes; round two pairs that rank with the strings around the position
that the threshold allows; round three ranks the single windows of what is still open at the
threshold.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ebbtide.llm.places import (
    SCHEMA, Layout, Places, by_bucket, groups, owned, parts_for, positions, sent, shared,
    text_columns)
from ebbtide.llm.staging import batches, id_back, keep
from ebbtide.llm.substrings import keyed

SLICE = 4 << 20
STRIDE = 1 << 22  # windows of a long text that are looked at together
PLACE_BITS = 24
NAMES_A_SLICE = 4
RANK = Layout()
AROUND = Layout(("<u4", "<u2"), ("<u8",))
WINDOW = Layout(("<u8",), ("<u4",))
DUP, OPEN = 1, 2
_draw = np.random.default_rng(20240229)
BYTE_RANKS = _draw.integers(0, 1 << 64, 256, np.uint64)
ODD = _draw.integers(0, 1 << 63, 2, np.uint64) * np.uint64(2) + np.uint64(1)


def pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Rank of the joined strings from the ranks of both."""
    out = left * ODD[0]
    out ^= right
    out *= ODD[1]
    out ^= out >> np.uint64(31)
    return out


def ranks(data: np.ndarray, doublings: int) -> np.ndarray:
    """Ranks of all strings of 2 ** doublings bytes."""
    out = BYTE_RANKS[data]
    for step in range(doublings):
        size = 1 << step
        out = pair(out[:-size], out[size:])
    return out


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every run of width values, by doubling."""
    out, size = values, 1
    while size < width:
        step = min(size, width - size)
        out = np.minimum(out[:-step], out[step:])
        size += step
    return out


@dataclass(frozen=True)
class Sampler:
    """Picks of every window of so many bytes the position with the least rank inside it.

    The choice depends on the bytes of the window alone, so equal windows pick alike. A picked
    position stands for the run of windows that pick it.
    """

    window: int
    doublings: int

    @classmethod
    def of(cls, window: int) -> Sampler:
        """The largest power of two below about two thirds of the window."""
        return cls(window, max(0, (max(1, 2 * window // 3)).bit_length() - 1))

    @property
    def size(self) -> int:
        return 1 << self.doublings

    def runs(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Picked position, its rank, first and last window of its run."""
        found = []
        for start in range(0, max(0, len(text) - self.window + 1), STRIDE):
            data = np.frombuffer(text, np.uint8)[start:start + STRIDE + self.window - 1]
            rank = ranks(data, self.doublings)
            place = np.arange(len(rank), dtype=np.uint64)
            high = np.uint64(PLACE_BITS)
            least = sliding_least((rank >> high << high) | place, self.window - self.size + 1)
            at = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
            firsts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            lasts = np.append(firsts[1:], len(at)) - 1
            picked = at[firsts]
            found.append((picked + start, rank[picked], firsts + start, lasts + start))
        if not found:
            empty = np.zeros(0, np.int64)
            return empty, empty.view(np.uint64), empty, empty
        return tuple(map(np.concatenate, zip(*found)))


def ranked_samples(texts: DataFrame, sampler: Sampler, parts: int) -> DataFrame:
    """Round one: sampled positions whose string occurs at least twice."""
    def run(items):
        for batch in batches(items, SLICE):
            names, starts, keys = [], [], []
            for doc, tid, text in zip(*text_columns(batch)):
                # the first window of its run names a sample: it is unique in a text
                _, rank, first, _ = sampler.runs(text)
                if len(first):
                    names.append(rank)
                    starts.append(first)
                    keys.append((doc, tid))
            if keys:
                low = np.concatenate(names)
                places = owned(starts, keys, low, np.zeros_like(low))
                order, new = groups(places)
                send = np.zeros(len(low), bool)
                send[order] = new
                yield from sent(places, send, {DUP: shared(places)}, RANK, parts)

    return by_bucket(texts.mapInArrow(run, SCHEMA), RANK, lambda p: {DUP: shared(p)}, parts)


def split_open(places: Places) -> dict[int, np.ndarray]:
    """Samples with an equal surrounding are repeats; of a rank with several, one each is open."""
    order, new = groups(places)
    repeat, first = np.zeros(len(order), bool), np.zeros(len(order), bool)
    if not len(order):
        return {DUP: repeat, OPEN: first}
    name = places.low[order]
    new_name = np.concatenate([[True], name[1:] != name[:-1]])
    repeat[order] = ~new | ~np.append(new[1:], True)
    kinds = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_name))
    first[order] = new & (kinds[np.cumsum(new_name) - 1] > 1)
    return {DUP: repeat, OPEN: first}


def surroundings(texts: DataFrame, sampler: Sampler, parts: int) -> DataFrame:
    """Round two: (doc, tid, code, ats) of samples, as the first window of their run.

    The surrounding of a sample is all that its run of windows covers. DUP: it occurs twice, so
    every window of the run repeats. OPEN: the rank occurs with different surroundings, and the
    windows have to be compared one by one. A slice sends at most NAMES_A_SLICE surroundings of
    one rank; what it has beyond that is open at once, so a rank met everywhere stays cheap.
    """
    def run(items):
        digest = xxhash.xxh3_64_intdigest
        for batch in batches(items, SLICE):
            names, around, starts, keys = [], [], [], []
            for doc, tid, text, blobs in zip(*text_columns(batch), batch.column(3).to_pylist()):
                at, rank, first, last = sampler.runs(text)
                rows = np.flatnonzero(np.isin(first, positions(blobs)))
                if len(rows):
                    names.append(rank[rows])
                    around.append(np.fromiter(
                        (digest(text[s:e + sampler.window], a - s) for a, s, e in zip(
                            at[rows].tolist(), first[rows].tolist(), last[rows].tolist())),
                        np.uint64, len(rows)))
                    starts.append(first[rows])
                    keys.append((doc, tid))
            if keys:
                places = owned(starts, keys, np.concatenate(names), np.concatenate(around))
                order, new = groups(places)
                name = places.low[order]
                heads = np.concatenate([[True], name[1:] != name[:-1]])
                kinds = np.cumsum(new)
                number = kinds - np.maximum.accumulate(np.where(heads, kinds, 0))
                send, extra = np.zeros(len(order), bool), np.zeros(len(order), bool)
                send[order] = new & (number < NAMES_A_SLICE)
                extra[order] = new & (number >= NAMES_A_SLICE)
                yield from sent(places, send, {DUP: split_open(places)[DUP], OPEN: extra},
                                AROUND, parts)

    return by_bucket(texts.mapInArrow(run, SCHEMA), AROUND, split_open, parts)


def open_windows(texts: DataFrame, sampler: Sampler, parts: int) -> DataFrame:
    """Round three: windows of open samples whose bytes start at another place too."""
    def run(items):
        digest = xxhash.xxh3_128_digest
        for batch in batches(items, SLICE):
            names, starts, keys = [], [], []
            for doc, tid, text, blobs in zip(*text_columns(batch), batch.column(3).to_pylist()):
                at = windows(sampler, text, positions(blobs))
                if len(at):
                    names += [digest(text[p:p + sampler.window]) for p in at.tolist()]
                    starts.append(at)
                    keys.append((doc, tid))
            if keys:
                name = np.frombuffer(b"".join(names), "<u8").reshape(-1, 2)
                places = owned(starts, keys, name[:, 0], name[:, 1] & np.uint64(0xFFFFFFFF))
                order, new = groups(places)
                send = np.zeros(len(order), bool)
                send[order] = new
                yield from sent(places, send, {DUP: shared(places)}, WINDOW, parts)

    return by_bucket(texts.mapInArrow(run, SCHEMA), WINDOW, lambda p: {DUP: shared(p)}, parts)


def windows(sampler: Sampler, text: bytes, firsts: np.ndarray) -> np.ndarray:
    """All windows of the runs that begin at firsts."""
    if not len(firsts):
        return firsts
    _, _, first, last = sampler.runs(text)
    rows = np.isin(first, firsts)
    return np.concatenate([firsts[:0], *map(np.arange, first[rows], last[rows] + 1)])


def cut_bytes(text: bytes, starts: np.ndarray, window: int) -> tuple[int, int, bytes]:
    """Removed bytes, maximal removed runs and the bytes that stay."""
    if not len(starts):
        return 0, 0, text
    marks = np.zeros(len(text) + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + window, -1)
    gone = np.cumsum(marks[:-1]) > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return int(gone.sum()), spans, np.frombuffer(text, np.uint8)[~gone].tobytes()


def suffix_dedup(docs: DataFrame, *, window: int = 200, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Per row of docs: key, n_bytes, n_removed, n_spans, kept (bytes) and kept_sha256.

    A byte of the UTF-8 text goes if a string of window bytes that covers it also starts at any
    other place, of the same text or another; strings are judged on the input and do not cross
    texts. NULL, empty and shorter texts lose nothing. Rows that repeat an id and a text are
    copies of each other like any others; a NULL id is kept as it is. Other columns are ignored;
    an empty table gives an empty result.
    """
    sampler = Sampler.of(window)
    rows = keyed(docs, key, text)
    parts = parts_for(rows)
    # a NULL id may stand on many rows, so texts meet their places by id and text
    same = ["doc", "tid"]
    near = keep(ranked_samples(rows, sampler, parts).select(*same, F.array("ats").alias("ats")))
    # the texts stand three times in the plan below and are shuffled once
    placed = rows.repartition(parts, *same)
    judged = surroundings(placed.join(near, same).select(*same, "text", "ats"), sampler, parts)
    still = judged.where(F.col("code") == OPEN).select(*same, F.array("ats").alias("ats"))
    single = open_windows(placed.join(still, same).select(*same, "text", "ats"), sampler,
                          parts).withColumn("code", F.lit(OPEN))
    gone = judged.where(F.col("code") == DUP).unionByName(single).groupBy(*same).agg(
        *[F.collect_list(F.when(F.col("code") == code, F.col("ats"))).alias(name)
          for name, code in (("whole", DUP), ("single", OPEN))])

    def run(items):
        for batch in batches(items, SLICE):
            out = [[], [], [], [], [], []]
            for doc, _, value, whole, single in zip(
                    *text_columns(batch), batch.column(3).to_pylist(),
                    batch.column(4).to_pylist()):
                starts = np.concatenate([
                    windows(sampler, value, positions(whole)), positions(single)])
                removed, spans, kept = cut_bytes(value, np.unique(starts), window)
                for column, item in zip(out, (doc, len(value), removed, spans, kept,
                                              hashlib.sha256(kept).hexdigest())):
                    column.append(item)
            kinds = [pa.int64()] * 4 + [pa.binary(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, kinds)],
                names=["doc", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    found = placed.join(gone, same, "left").select(*same, "text", "whole", "single")
    return found.mapInArrow(
        run, "doc long, n_bytes long, n_removed long, n_spans long, kept binary, "
             "kept_sha256 string").select(
        id_back(F.col("doc")).alias(key), "n_bytes", "n_removed", "n_spans", "kept",
        "kept_sha256")

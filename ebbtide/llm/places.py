"""Fingerprints and the places they were seen at, packed into few wide rows for a shuffle.

A slice of rows sends one row to each bucket instead of one row a fingerprint: fingerprints,
positions and the texts they are in are plain arrays, so an entry costs its fingerprint and
about two bytes. A task holds one bucket at a time and Spark sorts, and spills, the buckets of a
partition. The numbers of partitions and of buckets follow the bytes of the texts, so a bucket is
no larger for a larger input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SCHEMA = ("bucket int, code int, low binary, high binary, at binary, texts binary, "
          "counts binary")
FIELDS = pa.schema([("bucket", pa.int32()), ("code", pa.int32()), *(
    (name, pa.binary()) for name in ("low", "high", "at", "texts", "counts"))])


def _planes(values: np.ndarray, widths: tuple[str, ...]) -> bytes:
    """Little-endian integers as one array per group of bytes: empty high bytes compress."""
    raw = values.astype("<u8").view(np.uint8).reshape(-1, 8)
    out, at = [], 0
    for width in widths:
        size = np.dtype(width).itemsize
        out.append(np.ascontiguousarray(raw[:, at:at + size]).tobytes())
        at += size
    return b"".join(out)


def _whole(data: bytes, n: int, widths: tuple[str, ...]) -> np.ndarray:
    out, start, shift = np.zeros(n, np.uint64), 0, 0
    for width in widths:
        size = np.dtype(width).itemsize
        part = np.frombuffer(data, width, n, start).astype(np.uint64)
        out |= part << np.uint64(shift)
        start, shift = start + n * size, shift + 8 * size
    return out


BUCKETS_A_PART = 2
PART_BYTES = 32 << 20  # of text, for each partition of a shuffle
MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Places:
    """Entries: fingerprint (low, high), owner (a row of texts) and position at.

    texts has the id and the text's own hash per row. Entries are in order of their owner.
    """

    low: np.ndarray
    high: np.ndarray
    owner: np.ndarray
    at: np.ndarray
    texts: np.ndarray

    def take(self, rows: np.ndarray) -> Places:
        return Places(self.low[rows], self.high[rows], self.owner[rows], self.at[rows],
                      self.texts)

    def per_text(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(doc, tid, positions) of each text with entries, from whatever rows of texts."""
        doc, tid = self.texts[self.owner].T
        order = np.lexsort((tid, doc))
        doc, tid, at = doc[order], tid[order], self.at[order]
        cuts = np.flatnonzero((np.diff(doc) != 0) | (np.diff(tid) != 0)) + 1
        firsts = np.concatenate([[0], cuts]) if len(at) else []
        for first, own in zip(firsts, np.split(at, cuts)):
            yield int(doc[first]), int(tid[first]), own


@dataclass(frozen=True)
class Layout:
    """How many bytes of a fingerprint are sent: of low 6 or 8, of high 0, 4 or 8."""

    low: tuple[str, ...] = ("<u4", "<u2")
    high: tuple[str, ...] = ()

    def rows(self, places: Places, buckets: int, code: int | None = None) -> pa.RecordBatch:
        """One row for each bucket that has an entry; the bucket comes from the top bits."""
        bucket = ((places.low >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        out = [[] for _ in FIELDS]
        for number, (start, end) in enumerate(zip(cuts, cuts[1:])):
            if start < end:
                own = self._row(places.take(order[start:end]))
                for column, item in zip(out, (number, code, *own)):
                    column.append(item)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(out, FIELDS)], schema=FIELDS)

    def decided(self, places: Places, bucket: int, code: int = 1) -> pa.RecordBatch:
        """Entries that need no comparison: one row without fingerprints."""
        row = (bucket, code, None, None, *self._row(places)[2:])
        return pa.RecordBatch.from_arrays(
            [pa.array([x], f.type) for x, f in zip(row, FIELDS)], schema=FIELDS)

    def _row(self, p: Places) -> tuple[bytes, ...]:
        used, owner, counts = np.unique(p.owner, return_inverse=True, return_counts=True)
        order = np.argsort(owner, kind="stable")
        return (_planes(p.low[order], self.low), _planes(p.high[order], self.high),
                _planes(p.at[order], ("<u2", "<u2", "<u4")),
                _planes(p.texts[used, 0].view(np.uint64), ("<u2", "<u2", "<u4"))
                + p.texts[used, 1].tobytes(), counts.astype("<u4").tobytes())

    def read(self, table: pa.Table) -> tuple[Places, np.ndarray]:
        """All entries of a bucket, and the code of those that are decided, else 0."""
        lows, highs, owners, ats, texts, codes = [], [], [], [], [], []
        seen = 0
        for row in table.select(FIELDS.names).to_pylist():
            counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
            n, m = int(counts.sum()), len(counts)
            known = row["code"] is not None
            lows.append(np.zeros(n, np.uint64) if known else _whole(row["low"], n, self.low))
            highs.append(np.zeros(n, np.uint64) if known else _whole(row["high"], n, self.high))
            ats.append(_whole(row["at"], n, ("<u2", "<u2", "<u4")).astype(np.int64))
            owners.append(np.repeat(np.arange(seen, seen + m), counts))
            docs = _whole(row["texts"], m, ("<u2", "<u2", "<u4")).view(np.int64)
            tids = np.frombuffer(row["texts"], np.int64, m, 8 * m)
            texts.append(np.stack([docs, tids], axis=1))
            codes.append(np.full(n, row["code"] or 0))
            seen += m
        return Places(*map(np.concatenate, (lows, highs, owners, ats, texts))), np.concatenate(
            codes)


BACK = Layout((), ())


def sent(places: Places, send: np.ndarray, decided: dict[int, np.ndarray], layout: Layout,
         parts: int) -> Iterator[pa.RecordBatch]:
    """Entries to compare by bucket, and per code those that the slice has decided itself.

    The latter need no certain bucket; the first text of the slice picks one.
    """
    buckets = parts * BUCKETS_A_PART
    anywhere = int(places.texts[0, 1]) % buckets
    if send.any():
        yield layout.rows(places.take(np.flatnonzero(send)), buckets)
    for code, known in decided.items():
        if known.any():
            yield layout.decided(places.take(np.flatnonzero(known)), anywhere, code)


def parts_for(texts: DataFrame) -> int:
    """Partitions for texts: the session's number, or more for many bytes of text."""
    least = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(least, -(-held // PART_BYTES))


def by_bucket(rows: DataFrame, layout: Layout, judge: Callable[[Places], dict[int, np.ndarray]],
              parts: int) -> DataFrame:
    """rows (SCHEMA) -> (doc, tid, code, ats): positions in texts by code, one row for
    each text and code.

    judge gets the open entries of a bucket and marks entries per code; decided ones are added.
    What is marked goes back by text the way it came, one row for a bucket and a group of texts.
    It is much less than what came, so there are fewer groups: two partitions' worth each.
    """
    back_groups = max(1, parts // 2)

    def run(table: pa.Table) -> pa.Table:
        places, codes = layout.read(table)
        open_rows = np.flatnonzero(codes == 0)
        marked = {code: open_rows[mask]
                  for code, mask in judge(places.take(open_rows)).items()}
        out = []
        for code in sorted(marked.keys() | set(np.unique(codes[codes > 0]).tolist())):
            own = places.take(np.concatenate([
                marked.get(code, open_rows[:0]), np.flatnonzero(codes == code)]))
            doc, tid = own.texts.view(np.uint64).T
            mixed = (doc * MIX ^ tid) * MIX >> np.uint64(33)
            own.low = mixed[own.owner] << np.uint64(40)  # a text is in one bucket
            out.append(BACK.rows(own, back_groups, code))
        return pa.Table.from_batches(out, schema=FIELDS)

    def gather(table: pa.Table) -> pa.Table:
        places, codes = BACK.read(table)
        found = [(doc, tid, code, at.astype("<u4").tobytes())
                 for code in np.unique(codes).tolist()
                 for doc, tid, at in places.take(np.flatnonzero(codes == code)).per_text()]
        columns = zip(*found) if found else ([], [], [], [])
        return pa.table([pa.array(c, t) for c, t in zip(
            columns, (pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
            names=["doc", "tid", "code", "ats"])

    back = rows.repartition(parts, "bucket").groupBy("bucket").applyInArrow(run, SCHEMA)
    return back.groupBy("bucket").applyInArrow(
        gather, "doc long, tid long, code int, ats binary")


def groups(places: Places) -> tuple[np.ndarray, np.ndarray]:
    """Order that puts equal fingerprints together, and where a new one starts in it."""
    order = np.lexsort((places.at, places.texts[places.owner, 0], places.high, places.low))
    low, high = places.low[order], places.high[order]
    new = np.ones(len(order), bool)
    new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    return order, new


def shared(places: Places) -> np.ndarray:
    """Entries whose fingerprint occurs at least twice."""
    order, new = groups(places)
    out = np.zeros(len(order), bool)
    out[order] = ~new | ~np.append(new[1:], True)
    return out


def later(places: Places) -> np.ndarray:
    """Entries whose fingerprint also has a place with a smaller id, or earlier in that id."""
    order, new = groups(places)
    if not len(order):
        return np.zeros(0, bool)
    head = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    doc, at = places.texts[places.owner[order], 0], places.at[order]
    out = np.zeros(len(order), bool)
    out[order] = (doc != doc[head]) | (at != at[head])
    return out


def owned(parts: list[np.ndarray], keys: list[tuple[int, int]], low: np.ndarray,
          high: np.ndarray) -> Places:
    """Entries of several texts: positions per text, and fingerprints in the same order."""
    return Places(low, high, np.repeat(np.arange(len(parts)), [len(p) for p in parts]),
                  np.concatenate(parts), np.array(keys, np.int64).reshape(-1, 2))


def text_columns(batch: pa.RecordBatch) -> tuple[list, list, list]:
    """doc, tid and the bytes of text."""
    return (batch.column(0).to_pylist(), batch.column(1).to_pylist(),
            batch.column(2).cast(pa.binary()).to_pylist())


def positions(blobs: list[bytes] | None) -> np.ndarray:
    """Sorted distinct positions out of collected ats."""
    return np.unique(np.frombuffer(b"".join(blobs or ()), "<u4")).astype(np.int64)

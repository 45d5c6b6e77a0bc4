"""Best-two-fit packing of tokenised documents into sequences of a fixed length."""

from __future__ import annotations

import base64
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ebbtide.llm.staging import batches, id_back, id_or_least, keep, only

# How the byte-level vocabulary splits text before merging.
SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
SPECIAL = {"<|endoftext|>": 50256}  # added token of the vocabulary file
# A run of white space so long that the splitting pattern may run out of stack on it.
LONG_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{100000,}")
END = 2
CAPACITY = 1024
SLICE = 4 << 20
_encoders: dict[str, tiktoken.Encoding] = {}


def encoder(ranks_path: str) -> tiktoken.Encoding:
    """The byte-level vocabulary as ranks; one per worker process."""
    if ranks_path not in _encoders:
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(piece): int(rank)
                     for piece, rank in (line.split() for line in lines)}
        _encoders[ranks_path] = tiktoken.Encoding(
            "byte_bpe", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=SPECIAL)
    return _encoders[ranks_path]


def token_ids(encoding: tiktoken.Encoding, text: str, special: bool = False) -> np.ndarray:
    """Ids of the whole text, then the end id; with special its strings get their own ids.

    The pattern takes a run of white space as one piece but for its last character, which
    belongs to what follows, so long runs are merged without it.
    """
    allowed, out, start = "all" if special else set(), [], 0
    for run in LONG_BLANKS.finditer(text):
        # before the end of the text the whole run is one piece, as it is before a special token
        whole = run.end() == len(text) or special and text.startswith(tuple(SPECIAL), run.end())
        end = run.end() if whole else run.end() - 1
        out.append(encoding.encode_to_numpy(
            text[start:run.start()], allowed_special=allowed, disallowed_special=()))
        out.append(np.array(encoding._encode_single_piece(text[run.start():end]), np.uint32))
        start = end
    out.append(encoding.encode_to_numpy(
        text[start:], allowed_special=allowed, disallowed_special=()))
    return np.append(np.concatenate(out), END).astype("<u4")


def pieces(docs: DataFrame, ranks_path: str, *, capacity: int = CAPACITY, key: str = "doc_id",
           text: str = "text", ids: bool = False, special: bool = False) -> DataFrame:
    """(doc, piece, start, length, ids_crc32, part, rank): documents cut to the capacity.

    A longer document is cut into full pieces, what is left over goes first. rank numbers the
    pieces of one length inside a task. With ids the token ids themselves come along.
    """
    def run(items):
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        encoding = encoder(ranks_path)
        for batch in batches(items, SLICE):
            made: dict[str, np.ndarray] = {}
            out = [[] for _ in range(8)]
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if value not in made:
                    made[value] = token_ids(encoding, value, special)
                tokens = made[value]
                cuts = [0, *range(len(tokens) % capacity or capacity, len(tokens), capacity),
                        len(tokens)]
                for number, (start, end) in enumerate(zip(cuts, cuts[1:])):
                    own = tokens[start:end]
                    row = (doc, number, start, end - start, zlib.crc32(own.tobytes()), part,
                           int(seen[end - start]), own.astype(np.int32).tolist() if ids else None)
                    for column, item in zip(out, row):
                        column.append(item)
                    seen[end - start] += 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
                     pa.int64(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, kinds)], names=names)

    names = ["doc", "piece", "start", "length", "ids_crc32", "part", "rank", "ids"]
    rows = only(docs, doc=key, text=text).select(
        id_or_least("doc").alias("doc"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(
        run, "doc long, piece int, start long, length long, ids_crc32 long, part long, "
             "rank long, ids array<int>")


@dataclass(frozen=True)
class Plan:
    """Where the pieces of each length go, as runs over their ranks.

    A run holds (first rank, times, first sequence, first offset): the next times pieces go to
    consecutive sequences, the times after those to the same sequences one length further.
    """

    runs: dict[int, np.ndarray]
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for size in np.unique(length).tolist():
            rows = np.flatnonzero(length == size)
            runs = self.runs[size]
            run = runs[np.searchsorted(runs[:, 0], rank[rows], "right") - 1]
            slot, turn = np.divmod(rank[rows] - run[:, 0], run[:, 1])
            sequence[rows] = run[:, 2] + turn
            offset[rows] = run[:, 3] + slot * size
        return sequence, offset


def largest_fit(left: np.ndarray) -> np.ndarray:
    """For each gap the largest length at hand that fits, or 0."""
    return np.maximum.accumulate(np.where(left > 0, np.arange(len(left)), 0))


def fill(left: np.ndarray, capacity: int) -> dict[int, int]:
    """One sequence: greedy, then its smallest piece gives way to two that fit more tightly."""
    used: dict[int, int] = {}
    fits, gap = largest_fit(left), capacity
    size = int(fits[gap])
    while size:
        n = min(int(left[size]), gap // size)
        used[size] = n
        gap -= n * size
        size = int(fits[min(gap, size - 1)])
    while gap and used:
        free = left.copy()
        for size, n in used.items():
            free[size] -= n
        small = min(used)
        room = gap + small
        fits = largest_fit(free)
        first = np.flatnonzero(free[:room] > 0)
        below = np.where(free[first] > 1, first, first - 1)
        second = fits[np.minimum(below, room - first)]
        best = int(np.argmax(np.where(second > 0, first + second, 0))) if len(first) else -1
        if best < 0 or not second[best] or first[best] + second[best] <= small:
            break
        used[small] -= 1
        if not used[small]:
            del used[small]
        for size in (int(first[best]), int(second[best])):
            used[size] = used.get(size, 0) + 1
        gap = room - int(first[best] + second[best])
    return used


def best_two_fit(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Packs counts[length] pieces of every length, whole patterns of a sequence at a time.

    A filled sequence is repeated as often as the counts allow, so the work depends on the
    capacity and not on the number of documents: every round uses up at least one length.
    """
    left = np.zeros(capacity + 1, np.int64)
    for size, n in counts.items():
        left[size] = n
    total = left.copy()
    runs: dict[int, list] = {size: [] for size in counts}
    sequence = 0
    while left.any():
        used = fill(left, capacity)
        times = min(int(left[size]) // n for size, n in used.items())
        offset = 0
        for size in sorted(used, reverse=True):
            runs[size].append((int(total[size] - left[size]), times, sequence, offset))
            offset += size * used[size]
            left[size] -= times * used[size]
        sequence += times
    return Plan({size: np.array(r, np.int64) for size, r in runs.items() if r}, sequence)


def pack(docs: DataFrame, ranks_path: str, *, capacity: int = CAPACITY, key: str = "doc_id",
         text: str = "text", ids: bool = False, special: bool = False) -> DataFrame:
    """Per piece: key, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    The plan is made over the counts of the piece lengths of the whole corpus, at most capacity
    numbers, so all documents are packed together whatever task they are in. Pieces then find
    their place by their number among those of the same length: a number inside the task, plus
    the pieces of that length in tasks before. Offsets of a sequence have no gaps. With special the strings of
    special tokens get the ids of the vocabulary file, else they are ordinary text. NULL and
    empty texts are one piece with the end id alone. Rows that repeat are packed each; a NULL id
    stays NULL; other columns are ignored; an empty table gives an empty result.
    """
    made = keep(pieces(docs, ranks_path, capacity=capacity, key=key, text=text, ids=ids,
                       special=special))
    per_part = made.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = per_part.select(
        "part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    counts = {row["length"]: row["n"] for row in
              made.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = best_two_fit(counts, capacity)

    def run(items):
        for batch in items:
            sequence, offset = plan.place(
                batch.column("length").to_numpy(), batch.column("number").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"])

    names = ["doc", "piece", "start", "length", "ids_crc32"] + ["ids"] * ids
    numbered = made.join(offsets, ["part", "length"]).withColumn(
        "number", F.col("rank") + F.col("before")).select(*names, "number")
    kinds = {f.name: f.dataType.simpleString() for f in made.schema}
    placed = numbered.mapInArrow(
        run, ", ".join(f"{c} {kinds[c]}" for c in names) + ", sequence_id long, offset long")
    return placed.withColumn("doc", id_back(F.col("doc"))).withColumnRenamed("doc", key)

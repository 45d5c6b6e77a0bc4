"""Offset-preserving encoding with a sentence-piece model.

A text is normalised by the longest prefix in the model's compiled character map, and every byte
of the normalised text remembers the byte of the source it came from. The model then only
segments, and each piece is projected back to the bytes of the source it covers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from ebbtide.llm.staging import batches, id_back, id_or_least, only

SPACE = "▁".encode()
SLICE = 4 << 20
USER_DEFINED, BYTE, UNKNOWN = 4, 6, 2
# A normaliser that changes nothing, as the model file writes it.
IDENTITY = b"\x0a\x08identity\x18\x00\x20\x00\x28\x00"


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(message):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
        else:
            size = varint() if kind == 2 else 8 if kind == 1 else 4
            yield number, message[at:at + size]
            at += size


def delimited(number: int, value: bytes) -> bytes:
    out, size = bytearray([number << 3 | 2]), len(value)
    while size > 0x7F:
        out.append(size & 0x7F | 0x80)
        size >>= 7
    return bytes(out) + bytes([size]) + value


@dataclass
class CharacterMap:
    """Longest-prefix replacement by a compiled map: a double-array trie and its replacements."""

    units: np.ndarray
    replacements: bytes

    @classmethod
    def read(cls, blob: bytes) -> CharacterMap | None:
        if len(blob) <= 4:
            return None
        size = int.from_bytes(blob[:4], "little")
        return cls(np.frombuffer(blob[4:4 + size], "<u4"), blob[4 + size:])

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest mapped prefix of text[at:] and what replaces it."""
        units, found = self.units, None
        unit = int(units[0])
        node = (unit >> 10) << ((unit & 0x200) >> 6)
        for end in range(at, len(text)):
            node ^= text[end]
            if node >= len(units):
                break
            unit = int(units[node])
            if unit & 0x800000FF != text[end]:
                break
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit >> 8 & 1:
                found = end + 1 - at, int(units[node]) & 0x7FFFFFFF
        if found is None:
            return None
        start = found[1]
        return found[0], self.replacements[start:self.replacements.index(b"\0", start)]


@dataclass
class Normaliser:
    """Source bytes to normalised bytes and, for each of these, its place in the source."""

    charmap: CharacterMap | None = None
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True
    suffix: bool = False
    kept: tuple[bytes, ...] = ()  # user-defined pieces, left as they are
    _heads: frozenset = field(init=False, default=frozenset())

    def __post_init__(self):
        self.kept = tuple(sorted(self.kept, key=len, reverse=True))
        self._heads = frozenset(k[0] for k in self.kept)

    def _prefix(self, text: bytes, at: int) -> tuple[int, bytes]:
        if text[at] in self._heads:
            for piece in self.kept:
                if text.startswith(piece, at):
                    return len(piece), piece
        found = self.charmap.longest(text, at) if self.charmap is not None else None
        if found is not None:
            return found
        lead = text[at]
        size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return size, text[at:at + size]

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and where each starts in text, with len(text) at the end."""
        if not text:
            return b"", np.zeros(1, np.int64)
        if self.charmap is None and not self.squeeze and not self.kept:
            return self._plain(text)
        space = SPACE if self.escape else b" "
        out, places, at, end = [], [], 0, len(text)
        if self.squeeze:
            while at < end and self._prefix(text, at)[1] == b" ":
                at += self._prefix(text, at)[0]
            if at == end:
                return b"", np.array([end])
        if self.dummy_prefix and not self.suffix:
            out.append(space)
            places.append((at, len(space)))
        blank = self.squeeze
        while at < end:
            size, new = self._prefix(text, at)
            if blank:
                new = new.lstrip(b" ")
            if new:
                whole = new.replace(b" ", space)
                out.append(whole)
                places.append((at, len(whole)))
                blank = self.squeeze and new.endswith(b" ")
            at += size
        stop = end
        joined = b"".join(out)
        starts = np.repeat(*np.array(places).T) if places else np.zeros(0, np.int64)
        while self.squeeze and joined.endswith(space):
            joined, stop = joined[:-len(space)], int(starts[-len(space)])
            starts = starts[:-len(space)]
        if self.dummy_prefix and self.suffix:
            joined += space
            starts = np.append(starts, np.full(len(space), stop))
        return joined, np.append(starts, stop)

    def _plain(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """Without a map every byte stands for itself and a space for an escaped one."""
        space = SPACE if self.escape else b" "
        new = text.replace(b" ", space)
        sizes = np.where(np.frombuffer(text, np.uint8) == 0x20, len(space), 1)
        places = np.repeat(np.arange(len(text)), sizes)
        if self.dummy_prefix:
            ends = [len(text)] * len(space) if self.suffix else [0] * len(space)
            new = new + space if self.suffix else space + new
            places = np.concatenate([places, ends] if self.suffix else [ends, places])
        return new, np.append(places, len(text))


@dataclass
class Encoded:
    ids: list[int]
    begins: np.ndarray
    ends: np.ndarray
    decoded: str


class Encoder:
    """Normaliser, segmenter and decoder of one model file."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            model = file.read()
        kinds, lengths, kept, rest = [], [], [], []
        norm: dict[int, int | bytes] = {}
        trainer: dict[int, int | bytes] = {}
        for number, value in fields(model):
            if number == 1:
                piece = dict(fields(value))
                kind = piece.get(3, 1)
                kinds.append(kind)
                lengths.append(1 if kind == BYTE else len(piece[1]))
                if kind == USER_DEFINED:
                    kept.append(piece[1])
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                norm = dict(fields(value))
                continue
            rest.append(delimited(number, value))
        self.lengths = np.array(lengths)
        self.unknown = kinds.index(UNKNOWN) if UNKNOWN in kinds else -1
        self.names = [str(i) for i in range(len(kinds))]
        self.normalise = Normaliser(
            CharacterMap.read(norm.get(2, b"")), bool(norm.get(3, 1)), bool(norm.get(4, 1)),
            bool(norm.get(5, 1)), bool(trainer.get(24, 0)), tuple(kept))
        plain = b"".join([*rest, delimited(3, IDENTITY)])
        self.segmenter = sentencepiece.SentencePieceProcessor(model_proto=plain)
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=model)

    def encode(self, texts: list[bytes]) -> list[Encoded]:
        """Ids of each text, the source bytes every piece covers, and the decoded text."""
        made = [self.normalise(text) for text in texts]
        strings = [new.decode() for new, _ in made]
        ids = self.segmenter.encode(strings, num_threads=1)
        decoded = self.whole.decode(ids, num_threads=1) if ids else []
        out = []
        for own, text, new, (_, places) in zip(ids, decoded, strings, made):
            at = np.array(own, np.int64)
            sizes = self.lengths[at] if len(at) else at
            if (at == self.unknown).any():  # an unknown piece is as long as its surface
                surfaces = self.segmenter.encode(new, out_type=str)
                sizes = np.array([len(s.encode()) if i == self.unknown else n
                                  for s, i, n in zip(surfaces, own, sizes)])
            cuts = places[np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)]
            out.append(Encoded(own, cuts[:-1], cuts[1:], text))
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process and model."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return only(docs, doc=key, text=text).select(
        id_or_least("doc").alias("doc"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def _mapped(docs: DataFrame, path: str, key: str, text: str, row, names, kinds, schema):
    def run(items):
        coder = encoder(path)
        for batch in batches(items, SLICE):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            distinct = list(dict.fromkeys(texts))
            made = {t: row(coder, t, e) for t, e in zip(distinct, coder.encode(distinct))}
            columns = zip(*(made[t] for t in texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds))],
                names=["doc", *names])

    out = _rows(docs, key, text).mapInArrow(run, "doc long, " + schema)
    return out.withColumn("doc", id_back(F.col("doc"))).withColumnRenamed("doc", key)


def encode_texts(docs: DataFrame, path: str, *, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Per row of docs: key, ids, begins and ends (source bytes of each piece) and decoded.

    Texts are encoded whole, without begin or end ids. The spans follow each other without a
    gap unless the normaliser drops something; a piece of the added leading space alone is
    empty, and byte pieces of one character are its single bytes. An empty or NULL text has no
    pieces and decodes to an empty text. Repeated rows are encoded alike, other columns are
    ignored, an empty table gives an empty result.
    """
    longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
    return _mapped(
        docs, path, key, text, lambda _, __, e: (e.ids, e.begins, e.ends, e.decoded),
        ["ids", "begins", "ends", "decoded"], [ints, longs, longs, pa.string()],
        "ids array<int>, begins array<long>, ends array<long>, decoded string")


def encoding_digests(docs: DataFrame, path: str, *, key: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """Per row of docs: key, n_tokens, ids_sha256, decoded_sha256 and n_covered.

    Digests of what encode_texts returns, made in the tasks so that the ids need not leave
    them; n_covered is the number of source bytes that the pieces cover.
    """
    def row(coder: Encoder, _: bytes, e: Encoded):
        listed = ",".join([coder.names[i] for i in e.ids]).encode()
        return (len(e.ids), hashlib.sha256(listed).hexdigest(),
                hashlib.sha256(e.decoded.encode()).hexdigest(), int((e.ends - e.begins).sum()))

    return _mapped(
        docs, path, key, text, row, ["n_tokens", "ids_sha256", "decoded_sha256", "n_covered"],
        [pa.int64(), pa.string(), pa.string(), pa.int64()],
        "n_tokens long, ids_sha256 string, decoded_sha256 string, n_covered long")

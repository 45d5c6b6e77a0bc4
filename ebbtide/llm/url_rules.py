"""URL allow and block rules as one bit-parallel wildcard automaton."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ebbtide.llm.staging import only

# These two bytes stand in no UTF-8 text.
GAP = 0xFF  # between host and path; a wildcard does not cross it
PAD = 0xFE
MATRIX = 4 << 20
CUT = re.compile("[/?#]")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


@dataclass(frozen=True)
class UrlRule:
    """A verdict for a host with its subdomains and all paths that start with path."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def glob(self) -> bytes:
        """The rule over '.' + host, GAP, path; '*' and '?' of the rule are wildcards too."""
        return b"*." + self.host.encode() + bytes([GAP]) + self.path.encode() + b"*"


class Globs:
    """Shift-And automaton of many globs packed into 64-bit words, run on many texts at once.

    A pattern of m symbols takes m + 1 bits, one for each number of symbols read. A symbol moves
    every bit whose next pattern symbol fits one place up; bits before a '*' also stay.
    """

    def __init__(self, patterns: Sequence[bytes]):
        bits = sum(len(p) + 1 for p in patterns)
        self.words = bits // 64 + 1
        self.fits = np.zeros((256, self.words), np.uint64)
        self.first = np.zeros(self.words, np.uint64)
        self.stay = np.zeros(self.words, np.uint64)
        self.last = []
        at = 0
        for pattern in patterns:
            self._set(self.first, at)
            for symbol in pattern:
                if symbol == ord("*"):
                    self._set(self.stay, at)
                    continue
                at += 1
                for byte in range(256) if symbol == ord("?") else (symbol,):
                    if symbol != ord("?") or byte not in (GAP, PAD):
                        self._set(self.fits[byte], at)
            self.last.append(at)
            at += 1

    @staticmethod
    def _set(words: np.ndarray, bit: int) -> None:
        words[bit // 64] |= np.uint64(1 << bit % 64)

    def run(self, symbols: np.ndarray) -> np.ndarray:
        """symbols: a row of bytes per text, padded with PAD -> bool (texts, patterns)."""
        one, top = np.uint64(1), np.uint64(63)
        state = np.tile(self.first, (len(symbols), 1))
        for column in symbols.T:
            live = column != PAD
            if not live.any():
                break
            moved = state << one
            moved[:, 1:] |= state[:, :-1] >> top
            moved &= self.fits[column]
            moved |= np.where((column == GAP)[:, None], np.uint64(0), state & self.stay)
            state = np.where(live[:, None], moved, state)
        last = np.array(self.last)
        return (state[:, last // 64] >> (last % 64).astype(np.uint64)) & one != 0

    def match(self, texts: Sequence[bytes]) -> np.ndarray:
        """Like run, for texts of any length: texts of like length share a bounded matrix."""
        out = np.zeros((len(texts), len(self.last)), bool)
        order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
        start = 0
        while start < len(order):
            end = start + 1
            while end < len(order) and (end + 1 - start) * len(texts[order[end]]) <= MATRIX:
                end += 1
            rows, width = order[start:end], max(1, len(texts[order[end - 1]]))
            joined = b"".join(texts[i].ljust(width, bytes([PAD])) for i in rows)
            out[rows] = self.run(np.frombuffer(joined, np.uint8).reshape(len(rows), width))
            start = end
        return out


def canonical(url: str | None) -> tuple[str, str]:
    """Host, A-Z lower-cased, and path of a URL; both empty without '://'."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    cut = CUT.search(rest)
    if cut is None:
        return rest.translate(LOWER), ""
    path = re.split("[?#]", rest[cut.start():], maxsplit=1)[0] if cut[0] == "/" else ""
    return rest[:cut.start()].translate(LOWER), path


def judge_urls(pages: DataFrame, rules: Sequence[UrlRule], *, default: str = "allow",
               key: str = "page_id", url: str = "url") -> DataFrame:
    """Per row of pages: key, host, path, rule and verdict.

    Of the rules that fit, the one with the longest host and path decides; at equal length a
    block rule goes before an allow rule, then the smaller name. Without any the rule is NULL
    and the verdict is default. A NULL URL or one without '://' has an empty host and path.
    Rows are kept as often as they come, other columns are ignored, an empty table gives an
    empty result.
    """
    ranked = sorted(rules, key=lambda r: (-len(r.name), r.verdict != "block", r.name))
    globs = Globs([rule.glob() for rule in ranked]) if ranked else None
    names = np.array([rule.name for rule in ranked] + [None], object)
    verdicts = np.array([rule.verdict for rule in ranked] + [default], object)

    def run(items):
        for batch in items:
            parts = [canonical(value) for value in batch.column(1).to_pylist()]
            won = np.full(len(parts), len(ranked))
            if globs is not None and parts:
                hit = globs.match([b"." + h.encode() + bytes([GAP]) + p.encode()
                                   for h, p in parts])
                won = np.where(hit.any(axis=1), hit.argmax(axis=1), won)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([p[i] for p in parts], pa.string())
                                    for i in range(2)),
                 pa.array(names[won], pa.string()), pa.array(verdicts[won], pa.string())],
                names=["key", "host", "path", "rule", "verdict"])

    rows = only(pages, key=key, url=url)
    kind = rows.schema["key"].dataType.simpleString()
    rows = rows.withColumn("url", rows["url"].cast("string"))
    return rows.mapInArrow(
        run, f"key {kind}, host string, path string, rule string, verdict string"
    ).withColumnRenamed("key", key)


def urls_sql(rules: Sequence[UrlRule], default: str = "allow") -> str:
    """The same as SQL over pages."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    ranked = sorted(rules, key=lambda r: (-len(r.name), r.verdict != "block", r.name))
    fits = [(f"ends_with('.' || host, '.{r.host}') AND starts_with(path, '{r.path}')", r)
            for r in ranked]
    rule = " ".join(f"WHEN {test} THEN '{r.name}'" for test, r in fits)
    verdict = " ".join(f"WHEN {test} THEN '{r.verdict}'" for test, r in fits)
    return f"""
        WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0
                         THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        parts AS (SELECT page_id,
                      translate(regexp_extract(rest, '^[^/?#]*'), '{upper}', '{lower}') AS host,
                      regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1) AS path FROM cut)
        SELECT page_id, host, path, CASE {rule} END AS rule,
               CASE {verdict} ELSE '{default}' END AS verdict
        FROM parts"""

"""Byte-level BPE by backtracking from longest matches.

Bytes are mapped to Latin-1 characters, so a pyahocorasick automaton over characters finds the
vocabulary entries in a piece. From each place the longest entry is tried first; an entry may follow
another only when the two would stay apart under the merges, which is decided from how each entry
was merged and remembered per pair of ids. A dead end goes back to the next shorter entry, and each
place is left at most once, so a piece takes linear time and gets exactly the merges' result.
"""

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm.common import chunks

#: Pieces remembered by one worker in each of two generations, and pairs; bounds its memory.
REMEMBERED, REMEMBERED_PAIRS = 200_000, 1 << 17
#: Longer pieces are encoded without being remembered.
REMEMBERED_CHARS = 64


class Vocabulary:
    """Byte strings by rank, and the two parts each entry is merged from."""

    def __init__(self, ranks: dict[bytes, int]):
        self.text = {rank: word for word, rank in ranks.items()}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank in sorted(self.text):
            self._split(rank, ranks)

    def _split(self, rank: int, ranks: dict[bytes, int]) -> None:
        """Merge an entry's bytes by lower ranks; entries that end as two parts are reachable."""
        word = self.text[rank]
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 2:
            joined = [ranks.get(a + b, rank) for a, b in zip(parts, parts[1:])]
            lowest = min(joined)
            if lowest >= rank:
                return
            at = joined.index(lowest)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 1:
            self.parts[rank] = (rank, rank)
        elif all(p in ranks for p in parts):
            self.parts[rank] = (ranks[parts[0]], ranks[parts[1]])


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """A rank file (base64 of an entry and its rank per line), read by Spark; bounded by the vocabulary."""
    lines = spark.read.text(path if ":" in path else f"file://{path}").collect()
    pairs = (line.value.split() for line in lines if line.value.strip())
    return {base64.b64decode(word): int(rank) for word, rank in pairs}


class Pieces(dict):
    """Ids by piece, filled on demand."""

    def __init__(self, encoder: "Encoder"):
        self.encoder, self.older = encoder, {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            ids = self.encoder.piece_ids(piece.encode("utf-8").decode("latin-1"))
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.older = self.copy()
                self.clear()
            self[piece] = packed
        return packed


class Encoder:
    """Encodes pieces; built once per worker from a broadcast vocabulary."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        import ahocorasick
        import regex

        self.text, self.parts = vocabulary.text, vocabulary.parts
        self.whole = {pair: rank for rank, pair in self.parts.items() if pair[0] != rank}
        self.find = regex.compile(pattern).findall
        #: Every entry as Latin-1 text; those no merges lead to only stand for a whole piece.
        self.every = {word.decode("latin-1"): rank for rank, word in self.text.items()}
        reached = len(self.parts) == len(self.text)
        self.entry = self.every if reached else {w: r for w, r in self.every.items() if r in self.parts}
        self.automaton = ahocorasick.Automaton()
        for word, rank in self.entry.items():
            self.automaton.add_word(word, rank)
        self.size = [0] * (max(self.text, default=0) + 1)
        for rank, word in self.text.items():
            self.size[rank] = len(word)
        self.longest = max(self.size)
        self.shorter: dict[int, int | None] = {}
        self.apart = lru_cache(maxsize=REMEMBERED_PAIRS)(self._apart)
        self.known = Pieces(self)

    def _apart(self, left: int, right: int) -> bool:
        """True when two neighbouring entries stay two under the merges.

        Undo merges from the highest rank down, on whichever side was made last, and look whether
        the entries that touch at the border would have been merged before.
        """
        limit = 1 << 62
        while True:
            if self.whole.get((left, right), limit) < limit:
                return False
            if left > right:
                limit, inner = left, self.parts[left][1]
                if inner == left:
                    limit, inner = right + 1, self.parts[right][0]
                    if inner == right:
                        return True
                    right = inner
                else:
                    left = inner
            else:
                limit, inner = right + 1, self.parts[right][0]
                if inner == right:
                    limit, inner = left, self.parts[left][1]
                    if inner == left:
                        return True
                    left = inner
                else:
                    right = inner

    def _longest(self, text: str, at: int) -> int:
        """The longest entry at a place; the automaton says how far any entry could reach."""
        near = text[at : at + self.longest]
        for size in range(self.automaton.longest_prefix(near), 0, -1):
            rank = self.entry.get(near[:size])
            if rank is not None:
                return rank
        raise ValueError("the vocabulary lacks a byte of the text")

    def _shorter(self, rank: int) -> int | None:
        """The next shorter entry that begins an entry."""
        if rank not in self.shorter:
            word = self.text[rank].decode("latin-1")
            found = (self.entry.get(word[:size]) for size in range(len(word) - 1, 0, -1))
            self.shorter[rank] = next((r for r in found if r is not None), None)
        return self.shorter[rank]

    def piece_ids(self, text: str) -> list[int]:
        """Ids of one match of the pattern, given as Latin-1 text."""
        direct = self.every.get(text)
        if direct is not None:
            return [direct]
        stop = len(text)
        apart, size, dead = self.apart, self.size, set()
        out, at, rank = [], 0, self._longest(text, 0)
        while True:
            while rank is not None:
                end = at + size[rank]
                if end not in dead and (not out or apart(out[-1], rank)):
                    break
                rank = self._shorter(rank)
            if rank is None:  # nothing fits here: this place is never entered again
                dead.add(at)
                rank = out.pop()
                at -= size[rank]
                continue
            out.append(rank)
            if end == stop:
                return out
            at, rank = end, self._longest(text, end)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.known.__getitem__, self.find(text)))


_encoders: dict[tuple[str, str], Encoder] = {}


def _worker_encoder(shared, path: str, pattern: str) -> Encoder:
    """The worker's encoder; it keeps that of the last vocabulary only."""
    if (path, pattern) not in _encoders:
        _encoders.clear()
        _encoders[path, pattern] = Encoder(shared.value, pattern)
    return _encoders[path, pattern]


def _shared(spark: SparkSession, path: str):
    return spark.sparkContext.broadcast(Vocabulary(read_ranks(spark, path)))


def encode(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``ids`` (unsigned 32-bit, little endian) and ``n_tokens`` of every row.

    ``path`` is a rank file, ``pattern`` splits texts into pieces that are encoded separately. A
    null or empty text has no ids, null and repeated ``doc_id`` stay as they are, other columns are
    not used. Only the vocabulary is broadcast, whose size no input changes.
    """
    shared = _shared(documents.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _worker_encoder(shared, path, pattern)
        for batch, texts in chunks(batches):
            ids = [enc.encode(t.decode("utf-8")) for t in texts]
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary()), counts], ["doc_id", "ids", "n_tokens"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary, n_tokens long")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Add ``decoded``, the bytes of ``ids``; null ids give null. All other columns stay."""
    words = {rank: word for word, rank in read_ranks(encoded.sparkSession, path).items()}
    shared = encoded.sparkSession.sparkContext.broadcast(words)
    names = encoded.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields if f.name != "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value.__getitem__
        kept = [n for n in names if n != "decoded"]
        for batch in batches:
            for at in range(0, batch.num_rows, 512):  # bounded output batches
                part = batch.slice(at, 512)
                found = [None if x is None else b"".join(map(words, np.frombuffer(x, "<u4").tolist())) for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in kept), pa.array(found, pa.binary())], [*kept, "decoded"])

    return encoded.mapInArrow(run, f"{fields}, decoded binary")

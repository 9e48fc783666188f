"""Substring dedup by relative Lempel-Ziv factors of whole words.

The reference of a document is everything with a smaller id. Sampled word grams index it: every
window of 50 words names the smallest hash of its 25-word grams as its anchor, so equal windows
have equal anchors, and a long factor can begin only where an anchor also occurs in another
document. At these places all windows are looked up, each is referred to the smallest document that
holds it, and consecutive windows with the same reference are parsed greedily into one factor.
Because every window near a border between factors is looked up itself, none is lost there. All
words of the factors are duplicates.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlake.llm.common import Scratch, chunks, free_name, gram_hashes, mix, split_words, word_hashes

WINDOW, GRAM = 50, 25
_LAST = 2**63 - 1


def _order(doc_id: Column) -> Column:
    """Documents without an id come after all others."""
    return F.coalesce(doc_id.cast("long"), F.lit(_LAST))


def _text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of ``width`` neighbours from each place."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _anchors(texts: list[bytes]) -> list[pa.Array]:
    """For each text: a digest of its words, anchors, and the first and past-the-last window of each."""
    words, bounds = word_hashes(texts)
    digests = pa.array([hashlib.md5(b" ".join(t.split())).hexdigest() for t in texts])
    sizes = np.diff(bounds)
    grams = gram_hashes(words, GRAM)
    width = WINDOW - GRAM + 1
    # a chunk of many words may have no text of a whole window
    if sizes.max(initial=0) >= WINDOW:
        lowest = _sliding_min(grams, width)
        doc = np.repeat(np.arange(len(texts)), sizes)
        at = np.flatnonzero(doc[: len(lowest)] == doc[WINDOW - 1 :])
        lowest, owner = lowest[at], doc[at]
        new = np.ones(len(at), bool)
        new[1:] = (lowest[1:] != lowest[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        end = np.append(first[1:], len(at))
        owner, value = owner[first], lowest[first].view(np.int64)
        begin, stop = at[first] - bounds[owner], at[end - 1] + 1 - bounds[owner]
    else:
        owner = value = begin = stop = np.zeros(0, np.int64)
    offsets = pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)), pa.int32())
    runs = pa.StructArray.from_arrays([pa.array(value, pa.int64()), pa.array(begin, pa.int32()), pa.array(stop, pa.int32())], ["anchor", "begin", "stop"])
    return [pa.array(sizes, pa.int64()), digests, pa.ListArray.from_arrays(offsets, runs)]


_RUNS = "array<struct<anchor:long,begin:int,stop:int>>"


def _marks(documents: DataFrame) -> DataFrame:
    """One narrow row per document: place in the order, hash of the text, words, anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches):
            columns = [part.column("place"), part.column("key"), *_anchors(texts)]
            yield pa.RecordBatch.from_arrays(columns, ["place", "key", "n_words", "words", "runs"])

    text = _text(F.col("text"))
    rows = documents.select(_order(F.col("doc_id")).alias("place"), F.xxhash64(text).alias("key"), text.alias("text"))
    return rows.mapInArrow(run, f"place long, key long, n_words long, words string, runs {_RUNS}")


def _windows(texts: list[bytes], runs: list[list[dict]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document number, position and two hashes of every window in the runs of anchors."""
    words, bounds = word_hashes(texts)
    at = [np.unique(np.concatenate([np.arange(r["begin"], r["stop"]) for r in some])) for some in runs]
    doc = np.repeat(np.arange(len(texts)), [len(x) for x in at])
    position = np.concatenate([np.zeros(0, np.int64), *at]).astype(np.int64)
    place = bounds[doc] + position
    one, two = gram_hashes(words, WINDOW), gram_hashes(mix(words ^ np.uint64(0xA5A5A5A5A5A5A5A5)), WINDOW)
    return doc, position, one[place].view(np.int64), two[place].view(np.int64)


def factors(documents: DataFrame, scratch: Scratch) -> DataFrame:
    """Duplicate windows of the documents that have some: ``place, key, positions, refs, whole``.

    ``positions`` are the first words of duplicate windows, ``refs`` the smallest documents that
    hold them; ``whole`` marks documents of 50 words or more whose word sequence a smaller document
    has too, which are not parsed further.
    """
    marks = scratch.keep(_marks(documents), "marks")
    # exact copies first: one row per word sequence that several ids share
    firsts = marks.groupBy("words").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    firsts = scratch.keep(firsts.filter("first < last").select("words", "first"), "firsts")
    known = marks.join(firsts, "words", "left").withColumn("copy", F.coalesce(F.col("first") < F.col("place"), F.lit(False)))
    known = scratch.keep(known.select("place", "key", "n_words", "copy", F.when(~F.col("copy"), F.col("runs")).alias("runs")), "known")
    scratch.drop("marks", "firsts")

    # anchors that documents with different ids share; sums up on the map side, so no anchor is hot
    anchors = known.filter("not copy").select("place", "key", F.explode("runs").alias("run")).select("place", "key", "run.*")
    shared = anchors.groupBy("anchor").agg(F.min("place").alias("low"), F.max("place").alias("high"))
    shared = scratch.keep(shared.filter("low < high").select("anchor"), "shared")
    places = anchors.join(shared, "anchor").groupBy("place", "key").agg(F.collect_set(F.struct("begin", "stop")).alias("runs"))
    places = scratch.keep(places, "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches):
            doc, position, one, two = _windows(texts, part.column("runs").to_pylist())
            which = pa.array(doc)
            columns = [part.column("place").take(which), part.column("key").take(which), pa.array(position, pa.int32()), pa.array(one), pa.array(two)]
            yield pa.RecordBatch.from_arrays(columns, ["place", "key", "position", "one", "two"])

    text = _text(F.col("text"))
    texts = documents.select(_order(F.col("doc_id")).alias("place"), F.xxhash64(text).alias("key"), text.alias("text"))
    found = texts.join(places, ["place", "key"]).select("place", "key", "text", "runs")
    windows = scratch.keep(found.mapInArrow(run, "place long, key long, position int, one long, two long"), "windows")
    smallest = windows.groupBy("one", "two").agg(F.min("place").alias("ref"), F.max("place").alias("high"))
    smallest = scratch.keep(smallest.filter("ref < high").select("one", "two", "ref"), "smallest")
    later = windows.join(smallest, ["one", "two"]).filter("ref < place")
    parsed = later.groupBy("place", "key").agg(F.sort_array(F.collect_set(F.struct("position", "ref"))).alias("found"))
    parsed = parsed.select("place", "key", F.col("found.position").alias("positions"), F.col("found.ref").alias("refs"), F.lit(False).alias("whole"))
    copies = known.filter((F.col("copy")) & (F.col("n_words") >= WINDOW)).select("place", "key").distinct()
    nothing = (F.lit(None).cast("array<int>").alias("positions"), F.lit(None).cast("array<long>").alias("refs"))
    out = scratch.keep(parsed.union(copies.select("place", "key", *nothing, F.lit(True).alias("whole"))), "factors")
    scratch.drop("known", "shared", "places", "windows", "smallest")
    return out


def greedy(positions: list[int], refs: list[int]) -> list[tuple[int, int, int]]:
    """Factors (first word, words, reference) of consecutive windows with one reference."""
    out: list[list[int]] = []
    for position, ref in zip(positions, refs):
        if out and out[-1][2] == ref and out[-1][0] + out[-1][1] == position + WINDOW - 1:
            out[-1][1] += 1
        else:
            out.append([position, WINDOW, ref])
    return [tuple(x) for x in out]


def _kept(text: bytes, spans: list[tuple[int, int, int]], whole: bool) -> tuple[bytes, int, int]:
    """The text without its duplicate words, its words, and how many go.

    What stays keeps its own white space; a gap becomes one space.
    """
    words = split_words(text)
    gone = np.zeros(len(words) + 1, np.int64)
    for begin, size, _ in spans:
        gone[begin] += 1
        gone[begin + size] -= 1
    drop = np.cumsum(gone[:-1]) > 0
    if whole:
        drop[:] = True
    if not drop.any():
        return text, len(words), 0
    pieces, at, inside = [], 0, False
    for word, out in zip(words, drop.tolist()):
        start = text.index(word, at)
        if not out:
            pieces.append(text[at if inside else start : start + len(word)])
            if not inside and len(pieces) > 1:
                pieces[-1] = b" " + pieces[-1]
        inside, at = not out, start + len(word)
    return b"".join(pieces), len(words), int(drop.sum())


def remove_repeats(documents: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """All columns of the table with duplicate words removed from ``text``, and new columns.

    A word goes when a window of 50 words that covers it also starts in a document with a smaller
    ``doc_id``, judged on the input. Returns the table and the names of the columns added: words
    before (``n_words``) and removed (``n_removed``), and the ``factors`` (first word, words,
    reference id). Null and empty texts have no words; rows with a null id come after all others;
    rows that share an id do not judge each other, repeated rows get the same result; texts that
    lose nothing stay as they are. An empty table gives none.
    """
    scratch = Scratch(documents.sparkSession, "substring")
    found = factors(documents, scratch)
    names = {c: free_name(documents, c) for c in ("n_words", "n_removed", "factors")}
    inner = {c: free_name(documents, f"_{c}") for c in ("place", "key", "positions", "refs", "whole")}
    text = _text(F.col("text"))
    keyed = documents.withColumns({inner["place"]: _order(F.col("doc_id")), inner["key"]: F.xxhash64(text)})
    joined = keyed.join(found.select(*(F.col(c).alias(n) for c, n in inner.items())), [inner["place"], inner["key"]], "left")
    fields = documents.schema.fields
    joined = joined.select(*(F.col(f"`{f.name}`") for f in fields), *(inner[c] for c in ("positions", "refs", "whole")))
    at = documents.columns.index("text")
    factor = T.ArrayType(T.StructType([T.StructField("first_word", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("ref", T.LongType())]))
    arrow = pa.list_(pa.struct([("first_word", pa.int64()), ("n_words", pa.int64()), ("ref", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches):
            results, parsed = [], []
            missing = part.column("text").is_null().to_pylist()
            *own, positions, refs, whole = part.columns
            for t, p, r, w in zip(texts, positions.to_pylist(), refs.to_pylist(), whole.to_pylist()):
                parsed.append(greedy(p or [], r or []))
                results.append(_kept(t, parsed[-1], bool(w)))
            own[at] = pa.array([None if m else x[0].decode() for x, m in zip(results, missing)], pa.string())
            counts = [pa.array([x[i] for x in results], pa.int64()) for i in (1, 2)]
            spans = pa.array([[dict(zip(("first_word", "n_words", "ref"), f)) for f in some] for some in parsed], arrow)
            yield pa.RecordBatch.from_arrays([*own, *counts, spans], [*(f.name for f in fields), *names.values()])

    added = [T.StructField(names[c], T.LongType()) for c in ("n_words", "n_removed")] + [T.StructField(names["factors"], factor)]
    kept = [T.StructField("text", T.StringType()) if f.name == "text" else f for f in fields]
    return joined.mapInArrow(run, T.StructType([*kept, *added])), names

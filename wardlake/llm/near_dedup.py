"""Near duplicates by order MinHash, verified by banded alignment.

A document's k-mers are runs of five words, labelled by occurrence. Each of several hash functions
samples the smallest labelled k-mers and keeps them in text order, so a sketch matches only when
the same k-mers come in the same order. Documents that share a sketch are first compared with a few
of them, which joins most of every group. These representatives come first in random orders that
all sketches have in common, so groups of much the same documents choose the same ones and a pair
found by many sketches is one pair. Where members of a group are still in different classes, all of
them are compared with one another. What a cheap estimate leaves
is verified on the texts: the k-mer sequences are aligned and similar when their common subsequence
is at least 0.8 of all k-mers.
"""

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.llm.common import Scratch, chunks, gram_hashes, mix, word_hashes
from wardlake.llm.components import components

K, SIMILARITY = 5, 0.8
#: Sketches per document and k-mers in each. Of a long pair at the threshold a sketch matches with
#: probability 0.8^6 = 0.26, so all 32 miss once in 17,000 pairs, and once in 8,000 at 64 k-mers.
SKETCHES, SAMPLED = 32, 6
#: Documents of up to SHORT k-mers have as many sketches of FEW k-mers besides, as sampling without
#: replacement matches less often: 6 of 8 common k-mers with 0.13, 3 of 4 in 5 with 0.4, the least
#: for FEW. Partners of up to 64 k-mers are at most SHORT long, so they have them, too.
SHORT, FEW = 80, 3
#: Of 32 single minima a pair at the threshold shares 25.6 on average; 15 is over four deviations less.
SHARED_MINIMA = 15
#: Representatives of a sketch, with whom all members are compared first.
LEADERS = 6
#: Members, and k-mers of them, that are compared with as many others in one task.
BLOCK, BLOCK_GRAMS = 2048, 1 << 20
#: Members verified against one copy of a representative's text.
MEMBERS_TOGETHER = 512
_LONG_DOCUMENT = 1 << 16
_SEEDS = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64))
_FACTORS = mix(np.arange(1001, 1001 + SKETCHES, dtype=np.uint64)) | np.uint64(1)
_LAST = 2**63 - 1


def label_occurrences(grams: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Hash of each k-mer with the number of equal ones before it in its document."""
    mine = mix(grams ^ mix(owner.astype(np.uint64)))
    order = np.argsort(mine, kind="stable")
    same = np.zeros(len(order), bool)
    same[1:] = mine[order][1:] == mine[order][:-1]
    if not same.any():
        return mix(grams)
    begin = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    count = np.zeros(len(order), np.uint64)
    count[order] = (np.arange(len(order)) - begin).astype(np.uint64)
    return mix(grams + count * np.uint64(0x9E3779B97F4A7C15))


def _sketch(grams: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sketches of one document, and 16 bits of the smallest value of each hash function."""
    takes = [n for n in ((FEW, SAMPLED) if len(labels) <= SHORT else (SAMPLED,)) if n <= len(labels)]
    picked = [np.empty((SKETCHES, n), np.int64) for n in takes]
    lowest = np.empty(SKETCHES, np.uint64)
    step = SKETCHES if len(labels) <= _LONG_DOCUMENT else 1
    for j in range(0, SKETCHES, step):
        values = (labels[None, :] ^ _SEEDS[j : j + step, None]) * _FACTORS[j : j + step, None]
        lowest[j : j + step] = values.min(axis=1)
        for n, places in zip(takes, picked):
            places[j : j + step] = np.sort(np.argpartition(values, n - 1, axis=1)[:, :n], axis=1)
    chains = [np.zeros(0, np.uint64)]
    for n, places in zip(takes, picked):
        chain = np.arange(1, SKETCHES + 1, dtype=np.uint64)
        for i in range(n):
            chain = mix(chain) + grams[places[:, i]]
        chains.append(mix(chain))
    return np.concatenate(chains).view(np.int64), (mix(lowest) >> np.uint64(48)).astype(np.uint16)


def _shingles(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text: its k-mers and the same labelled by occurrence."""
    words, bounds = word_hashes(texts)
    grams = gram_hashes(words, K)
    sizes = np.maximum(np.diff(bounds) - K + 1, 0)
    at = np.repeat(bounds[:-1], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    grams = grams[at]
    labels = label_occurrences(grams, np.repeat(np.arange(len(texts)), sizes))
    ends = np.cumsum(sizes)
    return [(grams[e - n : e], labels[e - n : e]) for e, n in zip(ends.tolist(), sizes.tolist())]


def _order(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(_LAST))


def _text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def _keyed(documents: DataFrame) -> DataFrame:
    text = _text(F.col("text"))
    return documents.select(_order(F.col("doc_id")).alias("place"), F.xxhash64(text).alias("key"), text.alias("text"))


def _marks(documents: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches):
            words, sizes, bands, minima = [], [], [], []
            for text, (grams, labels) in zip(texts, _shingles(texts)):
                words.append(hashlib.md5(b" ".join(text.split())).hexdigest())
                sizes.append(len(grams))
                found = _sketch(grams, labels) if len(grams) else (np.zeros(0, np.int64), np.zeros(0, np.uint16))
                bands.append(found[0])
                minima.append(found[1].tobytes())
            columns = [pa.array(words), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(minima, pa.binary())]
            yield pa.RecordBatch.from_arrays([part.column("place"), part.column("key"), *columns], ["place", "key", "words", "size", "bands", "minima"])

    marked = _keyed(documents).mapInArrow(run, "place long, key long, words string, size long, bands array<long>, minima binary")
    return marked.withColumn("row", F.monotonically_increasing_id())


def banded_common(a: np.ndarray, b: np.ndarray, width: int) -> int:
    """Length of the longest common subsequence that stays within ``width`` of the diagonal."""
    best = np.zeros(2 * width + 2, np.int64)
    padded = np.concatenate([np.zeros(width, np.uint64), b, np.zeros(width + len(a), np.uint64)])
    inside = np.zeros(len(padded), bool)
    inside[width : width + len(b)] = True
    for i, value in enumerate(a):
        match = (padded[i : i + 2 * width + 1] == value) & inside[i : i + 2 * width + 1]
        step = np.maximum(best[1:], best[:-1] + match)
        best[:-1] = np.maximum.accumulate(step)
        best[-1] = 0
    return int(best.max())


def similar(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray], least: float = SIMILARITY) -> bool:
    """Whether the aligned k-mers are at least this share of all: common / (n + m - common).

    The labelled k-mers both have bound the alignment from above, the longest run of them in order
    bounds it from below; between the two the alignment is computed within the band that the
    threshold leaves.
    """
    (a, a_labels), (b, b_labels) = one, two
    n, m = len(a), len(b)
    needed = least * (n + m) / (1 + least)
    if min(n, m) < needed - 1e-9:
        return False
    _, i, j = np.intersect1d(a_labels, b_labels, assume_unique=True, return_indices=True)
    if len(i) < needed - 1e-9:
        return False
    tails: list[int] = []
    for place in j[np.argsort(i)].tolist():
        k = bisect_left(tails, place)
        tails[k : k + 1] = [place]
    if len(tails) >= needed - 1e-9:
        return True
    width = int(n + m - 2 * needed) + 1
    return banded_common(a, b, width) >= needed - 1e-9


def _estimated(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """Pairs whose sizes and shared minima leave the threshold possible, with the shared minima."""
    side = marks.select("row", "size", "minima")
    joined = pairs.join(side.select(F.col("row").alias("member"), F.col("size").alias("n"), F.col("minima").alias("x")), "member")
    joined = joined.join(side.select(F.col("row").alias("leader"), F.col("size").alias("m"), F.col("minima").alias("y")), "leader")
    joined = joined.filter(F.least("n", "m") >= SIMILARITY * F.greatest("n", "m")).select("member", "leader", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, SKETCHES) for c in ("x", "y"))
            shared = (x == y).sum(1)
            keep = pa.array(shared >= SHARED_MINIMA)
            columns = [batch.column("member"), batch.column("leader"), pa.array(shared.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([c.filter(keep) for c in columns], ["member", "leader", "shared"])

    return joined.mapInArrow(run, "member long, leader long, shared int")


def _joined_blocks(sketches: DataFrame, large: DataFrame, marks: DataFrame, documents: DataFrame, roots: DataFrame, scratch: Scratch) -> DataFrame | None:
    """Links that join classes, from the groups in which not every pair had a representative; None without such groups.

    A group whose members are one class by now has none. The others are dealt into blocks, bounded by
    members and by k-mers, and every block meets every block of its group, so that a task holds two
    blocks however large the group is. It estimates every pair of different classes, verifies on the
    texts those that are still apart, and keeps the links that joined two classes: fewer than it has
    members, and no connection is lost.
    """
    classed = sketches.join(large, "band").join(roots.select(F.col("node").alias("row"), "root"), "row", "left")
    classed = scratch.keep(classed.select("band", "row", F.coalesce("root", "row").alias("class")), "classed")
    parted = classed.groupBy("band").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low < high").select("band")
    sized = classed.join(parted, "band").join(marks.select("row", "size", "minima"), "row")
    members = scratch.keep(sized, "block-members")
    if members.isEmpty():
        scratch.drop("classed", "block-members")
        return None
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") / BLOCK_GRAMS)).cast("int")
    members = members.join(members.groupBy("band").agg(blocks.alias("blocks")), "band").withColumn("block", F.pmod(F.xxhash64("row"), "blocks").cast("int"))
    texts = scratch.keep(_texts(members.select("row").distinct(), marks, documents), "block-texts")
    dealt = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "row", "class", "size", "minima")
    dealt = dealt.join(texts.hint("merge"), "row")

    def run(group: pa.Table) -> pa.Table:
        # a document row that is given twice comes twice
        once = np.unique(group.column("row").to_numpy(), return_index=True)[1]
        group = group.take(pa.array(once))
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        block, row, root, size = (group.column(c).to_numpy() for c in ("block", "row", "class", "size"))
        minima = np.frombuffer(b"".join(group.column("minima").to_pylist()), np.uint16).reshape(-1, SKETCHES)
        shingles = [s for _, texts in chunks(iter(group.select(["text"]).to_batches())) for s in _shingles(texts)]
        one, two = np.flatnonzero(block == i), np.flatnonzero(block == j)
        members, leaders = [], []
        for k, x in enumerate(one.tolist()):
            y = two[k + 1 :] if i == j else two
            least, most = np.minimum(size[x], size[y]), np.maximum(size[x], size[y])
            y = y[(root[y] != root[x]) & (least >= SIMILARITY * most)]
            shared = (minima[y] == minima[x]).sum(1)
            likely = np.argsort(-shared, kind="stable")
            for z in y[likely][shared[likely] >= SHARED_MINIMA].tolist():
                if root[z] != root[x] and similar(shingles[x], shingles[z]):
                    root = np.where(root == root[z], root[x], root)
                    members.append(max(int(row[x]), int(row[z])))
                    leaders.append(min(int(row[x]), int(row[z])))
        return pa.table([pa.array(members, pa.int64()), pa.array(leaders, pa.int64())], ["a", "b"])

    out = scratch.keep(dealt.groupBy("band", "i", "j").applyInArrow(run, "a long, b long"), "block-links")
    scratch.drop("classed", "block-members", "block-texts")
    return out


def _paired(pairs: DataFrame) -> DataFrame:
    """The rows of some pair."""
    return pairs.select(F.col("member").alias("row")).union(pairs.select("leader")).distinct()


def _texts(rows: DataFrame, marks: DataFrame, documents: DataFrame) -> DataFrame:
    """``row, text`` of the given rows: the one time that their texts are shuffled whole."""
    wanted = rows.join(marks.select("row", "place", "key"), "row").groupBy("place", "key").agg(F.collect_list("row").alias("rows"))
    found = _keyed(documents).join(wanted.hint("merge"), ["place", "key"])
    return found.select(F.explode("rows").alias("row"), "text")


def _verified(pairs: DataFrame, texts: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """The pairs whose texts align. A leader's text goes once to each group of its members."""
    spread = F.pmod(F.xxhash64("member"), F.greatest(F.ceil(F.col("members") / MEMBERS_TOGETHER), F.lit(1)))
    sizes = scratch.keep(pairs.groupBy("leader").agg(F.count("*").alias("members")), f"{label}-sizes")
    dealt = scratch.keep(pairs.join(sizes, "leader").select("leader", spread.alias("salt"), "member"), f"{label}-dealt")
    roles = dealt.select(F.col("member").alias("row"), "leader", "salt", F.lit(1).alias("role"))
    roles = roles.union(dealt.select("leader", "leader", "salt", F.lit(0)).distinct())
    # a document row that is given twice comes twice here, which verifies the same pair again
    found = texts.join(roles.hint("merge"), "row").select("text", "row", "leader", "salt", "role")
    found = found.repartition("leader", "salt").sortWithinPartitions("leader", "salt", "role", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holder, held = None, None
        for part, texts in chunks(batches):
            members, leaders = [], []
            columns = [part.column(c).to_pylist() for c in ("leader", "salt", "role", "row")]
            for leader, salt, role, row, shingles in zip(*columns, _shingles(texts)):
                if role == 0:
                    # copies, so that the chunk's arrays are not kept alive
                    holder, held = (leader, salt), tuple(x.copy() for x in shingles)
                elif holder == (leader, salt) and similar(held, shingles):
                    members.append(row)
                    leaders.append(leader)
            yield pa.RecordBatch.from_arrays([pa.array(members, pa.int64()), pa.array(leaders, pa.int64())], ["a", "b"])

    out = scratch.keep(found.mapInArrow(run, "a long, b long").distinct(), f"{label}-links")
    scratch.drop(f"{label}-sizes", f"{label}-dealt")
    return out


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose rows are in different classes."""
    for side in ("member", "leader"):
        pairs = pairs.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root")), side, "left")
    return pairs.filter(F.coalesce("member_root", "member") != F.coalesce("leader_root", "leader")).select("member", "leader")


def _joined(pairs: DataFrame, roots: DataFrame, texts: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """The classes after the pairs are verified."""
    links = _verified(pairs, texts, scratch, label)
    edges = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links)
    return scratch.keep(components(edges, scratch, f"{label}-edges"), f"{label}-classes")


def classes(documents: DataFrame) -> DataFrame:
    """One row per document row: ``place, key`` (its id, last when null, and a hash of its text), ``class_place`` and ``class_key``.

    Documents are in one class when a chain of similar documents connects them. Equal word
    sequences always are; a document of fewer than five words has no other duplicates.
    """
    scratch = Scratch(documents.sparkSession, "near-dedup")
    marks = scratch.keep(_marks(documents), "marks")
    firsts = marks.groupBy("words").agg(F.min(F.struct("place", "key", "row")).alias("first"), F.count("*").alias("n"))
    firsts = scratch.keep(firsts.filter("n > 1").select("words", F.col("first.row").alias("first")), "firsts")
    narrow = marks.select("row", "place", "key", "words")
    known = narrow.join(firsts, "words", "left").select("row", "place", "key", F.coalesce("first", "row").alias("rep"))
    known = scratch.keep(known, "known")
    alone = scratch.keep(marks.join(known.filter("row = rep").select("row"), "row").filter("size > 0"), "alone")
    scratch.drop("marks", "firsts")

    sketches = alone.select("row", F.explode("bands").alias("band"))
    # the whole group has been compared when all but one of it are representatives
    # orders that do not depend on the sketch: the same documents lead in all sketches they share
    drawn = [F.min_by("row", F.xxhash64("row", F.lit(i))).alias(f"l{i}") for i in range(LEADERS)]
    leaders = sketches.groupBy("band").agg(*drawn, F.count("*").alias("n")).filter("n > 1")
    leaders = scratch.keep(leaders.select("band", F.array_distinct(F.array(*(f"l{i}" for i in range(LEADERS)))).alias("leaders"), "n"), "leaders")
    pairs = sketches.join(leaders.drop("n"), "band").select(F.col("row").alias("member"), F.explode("leaders").alias("leader")).filter("member != leader")
    pairs = pairs.select(F.greatest("member", "leader").alias("member"), F.least("member", "leader").alias("leader")).distinct()
    pairs = scratch.keep(pairs, "pairs")
    pairs = scratch.keep(_estimated(pairs, alone), "candidates")
    scratch.drop("pairs")

    # every member with its likeliest representative first, then only what could still join classes
    best = pairs.groupBy("member").agg(F.max_by("leader", F.struct("shared", "leader")).alias("leader"))
    texts = scratch.keep(_texts(_paired(pairs), alone, documents), "texts")
    links = _verified(best.select("member", "leader"), texts, scratch, "first")
    roots = scratch.keep(components(links, scratch, "first-roots"), "roots")
    rest = _apart(pairs.join(best, ["member", "leader"], "left_anti"), roots)
    roots = _joined(scratch.keep(rest, "rest"), roots, texts, scratch, "second")

    large = leaders.filter(F.col("n") > F.size("leaders") + 1).select("band")
    links = _joined_blocks(sketches, large, alone, documents, roots, scratch)
    scratch.drop("leaders")
    if links is not None:
        edges = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links)
        roots = scratch.keep(components(edges, scratch, "third-edges"), "third-classes")

    joined = known.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
    joined = scratch.keep(joined.select("row", "place", "key", F.coalesce("root", "rep").alias("root")), "rooted")
    first = joined.groupBy("root").agg(F.min(F.struct("place", "key", "row")).alias("first"), F.count("*").alias("n"))
    first = scratch.keep(first.filter("n > 1").select("root", F.col("first.place").alias("fp"), F.col("first.key").alias("fk"), F.col("first.row").alias("fr")), "class-firsts")
    out = joined.join(first, "root", "left")
    out = out.select("place", "key", F.coalesce("fp", "place").alias("class_place"), F.coalesce("fk", "key").alias("class_key"), F.coalesce(F.col("fr") == F.col("row"), F.lit(True)).alias("kept"))
    out = scratch.keep(out, "classes")
    scratch.drop("known", "alone", "candidates", "texts", "roots", "rest", "rooted", "class-firsts")
    scratch.drop("first-links", "second-links", "second-classes", "block-links", "third-classes")
    return out


def near_duplicates(documents: DataFrame) -> DataFrame:
    """``doc_id, class_id, kept`` of every row; ``class_id`` is the smallest id of its class.

    One row of each class is kept, that of the smallest id. Null and empty texts are one class of
    documents without words; a null ``doc_id`` comes after all others and stays null; repeated rows
    are copies; an empty table gives no row; other columns are not used.
    """
    real = lambda c: F.when(F.col(c) != _LAST, F.col(c))
    return classes(documents).select(real("place").alias("doc_id"), real("class_place").alias("class_id"), "kept")


def keep_one(documents: DataFrame) -> DataFrame:
    """The table with one row of each class, all columns unchanged."""
    kept = classes(documents).filter("kept").select("place", "key").distinct()
    columns = documents.columns
    place, key = "_place", "_key"
    while {place, key} & {c.lower() for c in columns}:
        place, key = place + "_", key + "_"
    keyed = documents.withColumns({place: _order(F.col("doc_id")), key: F.xxhash64(_text(F.col("text")))})
    found = keyed.join(kept.select(F.col("place").alias(place), F.col("key").alias(key)), [place, key], "left_semi")
    # rows that repeat both id and text stay once
    return found.dropDuplicates([place, key]).select(*(F.col(f"`{c}`") for c in columns))

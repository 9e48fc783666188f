"""Transcript parsing by a hidden Markov model over lines, and canonical rendering of turns.

A transcript is a conversation's parts in order; every line is in one of two states per role: the
first line of a turn or a later one. Lines show a speaker marker or none, their length, a question
mark at the end, and whether a blank line came before. The model is counted from labelled
conversations, and Viterbi's path gives the turns.

A conversation may be of any length. Its parts are cut into segments; each segment is reduced to
the best log-probabilities between its first and last state, these are combined along the
conversation forwards and backwards, and every segment then finds its own path between the states
its borders are known to have.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.llm.common import Scratch

ROLES = ("system", "user", "assistant")
#: Words that name a speaker, by role.
SPEAKERS = {
    "system": ("system", "instructions", "prompt"),
    "user": ("user", "human", "customer", "question", "q", "me"),
    "assistant": ("assistant", "ai", "bot", "model", "answer", "a"),
}
#: Parts in a segment.
SEGMENT_PARTS = 64
STATES = 2 * len(ROLES)  # first line, later line of each role
_LENGTHS = (0, 40, 120, 400)
_WORDS = {w: i for i, role in enumerate(ROLES) for w in SPEAKERS[role]}
_MARKER = re.compile(rf"^\W{{0,6}}({'|'.join(sorted(_WORDS, key=len, reverse=True))})(?:[^\w\s]*[:\]>][^\w\s]*|\s*$)\s*", re.IGNORECASE)
#: Values of each feature: marker of a role or none, length, question, blank line before.
_SIZES = (len(ROLES) + 1, len(_LENGTHS) + 1, 2, 2)


@dataclass
class Model:
    """Log probabilities: of the next state, and per feature of a value in a state."""

    steps: np.ndarray
    features: list[np.ndarray]


def marker(line: str) -> tuple[int, str]:
    """The role a line's marker names (or the number of roles) and the line without the marker."""
    found = _MARKER.match(line)
    return (_WORDS[found[1].lower()], line[found.end() :]) if found else (len(ROLES), line)


def observe(lines: list[str]) -> np.ndarray:
    """Feature values of each line of a segment; the first is taken to follow a blank line."""
    out = np.zeros((len(lines), len(_SIZES)), np.int64)
    for i, line in enumerate(lines):
        bare = line.strip()
        size = sum(len(bare) > bound for bound in _LENGTHS)
        out[i] = marker(line)[0], size, bare.endswith("?"), i == 0 or not lines[i - 1].strip()
    return out


def _grouped(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows of sorted batches group by group."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            now = tuple(row[k] for k in keys)
            if now != key and rows:
                yield key, rows
                rows = []
            key = now
            rows.append(row)
    if rows:
        yield key, rows


def _conversation(conv_id: Column) -> Column:
    """A key that is never null."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit("null"))


def _segments(parts: DataFrame, *more: str) -> DataFrame:
    """Parts with their segment, each segment in one task and in order; ties go by text."""
    place = F.coalesce(F.col("part").cast("long"), F.lit(-1).cast("long"))
    rows = parts.select(
        _conversation(F.col("conv_id")).alias("conv"), F.col("conv_id").cast("long").alias("conv_id"), place.alias("part"),
        F.floor(place / SEGMENT_PARTS).alias("segment"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more,
    )
    return rows.repartition("conv", "segment").sortWithinPartitions("conv", "segment", "part", "text", *more)


def train(parts: DataFrame) -> Model:
    """Count a model from parts with a ``role``: one part is one turn. Other roles are left out.

    Every task hands in at most one row per count, so the driver gets a few hundred numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = np.zeros((STATES, STATES), np.int64)
        seen = [np.zeros((STATES, n), np.int64) for n in _SIZES]
        for _, rows in _grouped(batches, ("conv", "segment")):
            lines, states = [], []
            for row in rows:
                if row["role"] in ROLES:
                    own = row["text"].split("\n")
                    role = 2 * ROLES.index(row["role"])
                    lines += own
                    states += [role] + [role + 1] * (len(own) - 1)
            if lines:
                s = np.array(states)
                np.add.at(steps, (s[:-1], s[1:]), 1)
                for f, values in enumerate(observe(lines).T):
                    np.add.at(seen[f], (s, values), 1)
        for kind, counts in enumerate([steps, *seen]):
            i, j = np.nonzero(counts)
            columns = [np.full(len(i), kind), i, j, counts[i, j]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["kind", "i", "j", "n"])

    counted = _segments(parts, "role").mapInArrow(run, "kind long, i long, j long, n long")
    # a marker that contradicts the role is all but impossible, even where little was counted
    tables = [np.full((STATES, STATES), 0.5), np.full((STATES, _SIZES[0]), 1e-3), *(np.full((STATES, n), 0.5) for n in _SIZES[1:])]
    for row in counted.groupBy("kind", "i", "j").agg(F.sum("n").alias("n")).collect():
        tables[row.kind][row.i, row.j] += row.n
    later = np.arange(1, STATES, 2)
    for j in later:  # a later line follows its own role only
        tables[0][[i for i in range(STATES) if i // 2 != j // 2], j] = 0
    with np.errstate(divide="ignore"):
        logs = [np.log(t / t.sum(axis=1, keepdims=True)) for t in tables]
    return Model(logs[0], logs[1:])


def _scores(model: Model, lines: list[str]) -> np.ndarray:
    return sum(table.T[values] for table, values in zip(model.features, observe(lines).T))


def _opening(scores: np.ndarray) -> np.ndarray:
    """Log probabilities after the first line of a conversation, which begins a turn."""
    out = scores[0].copy()
    out[1::2] = -np.inf
    return out


def _reduced(model: Model, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best paths through a segment: as the first of its conversation, and from any state before."""
    first, between = _opening(scores), model.steps + scores[0]
    for score in scores[1:]:
        step = model.steps + score
        first = (first[:, None] + step).max(axis=0)
        between = (between[:, :, None] + step[None, :, :]).max(axis=1)
    return first, between


def _path(model: Model, scores: np.ndarray, before: int | None, last: int) -> list[int]:
    """Best states of a segment's lines that end in ``last``."""
    best = _opening(scores) if before is None else model.steps[before] + scores[0]
    back = []
    for score in scores[1:]:
        options = best[:, None] + model.steps
        back.append(options.argmax(axis=0))
        best = options.max(axis=0) + score
    states = [last]
    for choice in reversed(back):
        states.append(int(choice[states[-1]]))
    return states[::-1]


def parse(transcripts: DataFrame, model: Model) -> DataFrame:
    """``conv_id, turn, role, text`` of every turn found in parts (``conv_id, part, text``).

    Parts are only pieces of text: where turns begin and who speaks comes from the model. Markers
    are removed and outer white space is stripped. A null part number comes first, equal numbers
    follow by text, null texts are blank lines; parts without a ``conv_id`` are one conversation;
    repeated rows are repeated text. An empty table gives no row; other columns are not used.
    """
    scratch = Scratch(transcripts.sparkSession, "transcripts")
    shared = transcripts.sparkSession.sparkContext.broadcast(model)

    def lines_of(rows: list[dict]) -> list[str]:
        return [line for row in rows for line in row["text"].split("\n")]

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (conv, segment), rows in _grouped(batches, ("conv", "segment")):
            first, between = _reduced(shared.value, _scores(shared.value, lines_of(rows)))
            yield pa.RecordBatch.from_pylist([{"conv": conv, "segment": segment, "first": first.tolist(), "between": between.ravel().tolist()}])

    segments = _segments(transcripts)
    reduced = scratch.keep(segments.mapInArrow(reduce, "conv string, segment long, first array<double>, between array<double>"), "reduced")

    def carry(forwards: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            conv, now = None, None
            for batch in batches:
                out = []
                for row in batch.to_pylist():
                    between = np.array(row["between"]).reshape(STATES, STATES)
                    opens = row["conv"] != conv
                    conv = row["conv"]
                    if forwards:
                        now = np.array(row["first"]) if opens else (now[:, None] + between).max(axis=0)
                        out.append({"conv": conv, "segment": row["segment"], "ahead": now.tolist(), "opens": opens})
                    else:
                        now = np.zeros(STATES) if opens else now
                        out.append({"conv": conv, "segment": row["segment"], "behind": now.tolist()})
                        now = (between + now[None, :]).max(axis=1)
                yield pa.RecordBatch.from_pylist(out) if out else pa.RecordBatch.from_pylist([], schema=_AHEAD if forwards else _BEHIND)

        order = F.col("segment") if forwards else F.col("segment").desc()
        schema = "conv string, segment long, ahead array<double>, opens boolean" if forwards else "conv string, segment long, behind array<double>"
        return reduced.repartition("conv").sortWithinPartitions("conv", order).mapInArrow(run, schema)

    both = carry(True).join(carry(False), ["conv", "segment"])
    total = F.zip_with("ahead", "behind", lambda a, b: a + b)
    ends = both.select("conv", "segment", "opens", (F.array_position(total, F.array_max(total)) - 1).cast("int").alias("last"))
    ends = scratch.keep(ends, "ends")
    order = _window()
    borders = ends.withColumn("before", F.lag("last").over(order))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (conv, segment), rows in _grouped(batches, ("conv", "segment")):
            lines = lines_of(rows)
            before = None if rows[0]["opens"] else rows[0]["before"]
            states = _path(shared.value, _scores(shared.value, lines), before, rows[0]["last"])
            turns: list[dict] = []
            turn = 0
            for line, state in zip(lines, states):
                begins = state % 2 == 0
                turn += begins
                if begins or not turns:
                    turns.append({"conv": conv, "conv_id": rows[0]["conv_id"], "segment": segment, "local": turn, "role": ROLES[state // 2], "lines": []})
                turns[-1]["lines"].append(marker(line)[1] if begins else line)
            out = [{k: v for k, v in t.items() if k != "lines"} | {"text": "\n".join(t["lines"])} for t in turns]
            yield pa.RecordBatch.from_pylist(out, schema=_TURNS)

    again = _segments(transcripts).join(borders, ["conv", "segment"]).repartition("conv", "segment").sortWithinPartitions("conv", "segment", "part", "text")
    found = scratch.keep(again.mapInArrow(decode, "conv string, conv_id long, segment long, local int, role string, text string"), "found")
    begun = found.groupBy("conv", "segment").agg(F.max("local").alias("n"))
    before = begun.withColumn("earlier", F.coalesce(F.sum("n").over(order.rowsBetween(-(2**31), -1)), F.lit(0))).drop("n")
    numbered = found.join(before, ["conv", "segment"]).withColumn("turn", F.col("earlier") + F.col("local") - 1)
    pieces = F.sort_array(F.collect_list(F.struct("segment", "text")))
    turns = numbered.groupBy("conv", "turn").agg(F.first("conv_id").alias("conv_id"), F.first("role").alias("role"), pieces.alias("pieces"))
    text = F.regexp_replace(F.array_join(F.col("pieces.text"), "\n"), r"^\s+|\s+$", "")
    return turns.select("conv_id", "turn", "role", text.alias("text"))


def _window():
    from pyspark.sql import Window

    return Window.partitionBy("conv").orderBy("segment")


_AHEAD = pa.schema([("conv", pa.string()), ("segment", pa.int64()), ("ahead", pa.list_(pa.float64())), ("opens", pa.bool_())])
_BEHIND = pa.schema([("conv", pa.string()), ("segment", pa.int64()), ("behind", pa.list_(pa.float64()))])
_TURNS = pa.schema([("conv", pa.string()), ("conv_id", pa.int64()), ("segment", pa.int64()), ("local", pa.int32()), ("role", pa.string()), ("text", pa.string())])


def render(turns: DataFrame) -> DataFrame:
    """Add ``rendered``: a turn in the canonical form ``<|role|>``, text, ``<|end|>`` on lines of their own."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return turns.withColumn("rendered", F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), text, F.lit("\n<|end|>\n")))


def as_transcripts(conversations: DataFrame) -> DataFrame:
    """Raw transcripts (``conv_id, part, role, text``) of stored turns, in several hands.

    A hash of the conversation picks how speakers are marked; every tenth turn by hash has no
    marker. Each turn ends with a blank line.
    """
    names = [("System", "User", "Assistant"), ("Instructions", "Human", "AI"), ("System", "Q", "A"), ("Prompt", "Customer", "Bot")]
    hand = F.pmod(F.xxhash64("conv_id"), F.lit(len(names)))
    forms = [("", ": "), ("### ", ":\n"), ("[", "] "), ("**", ":** ")]
    mark = F.lit("")
    for i, (speakers, (left, right)) in enumerate(zip(names, forms)):
        for role, name in zip(ROLES, speakers):
            mark = F.when((hand == i) & (F.col("role") == role), F.lit(left + name + right)).otherwise(mark)
    mark = F.when(F.pmod(F.xxhash64("conv_id", "turn", "role"), F.lit(10)) == 0, F.lit("")).otherwise(mark)
    text = F.concat(mark, F.coalesce(F.col("text"), F.lit("")), F.lit("\n"))
    return conversations.select("conv_id", F.col("turn").alias("part"), "role", text.alias("text"))


def in_training(conv_id: Column) -> Column:
    """Conversations the model is counted from: crc32 of the id as text is no multiple of 5."""
    return F.coalesce(F.crc32(conv_id.cast("string").cast("binary")), F.lit(0)) % 5 != 0

import random
import zlib

import pytest
from pyspark.sql import functions as F

from wardlake.llm import transcripts
from wardlake.llm.queries import op5_transcripts, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model(spark):
    raw = transcripts.as_transcripts(table(spark, SF, "conversations"))
    return transcripts.train(raw.filter(transcripts.in_training(F.col("conv_id"))))


@pytest.mark.parametrize(
    "line, role, rest",
    [("**AI:** hello", 2, "hello"), ("### Human:", 1, ""), ("[Q] why", 1, "why"), ("System: x", 0, "x"), ("User", 1, ""), ("A lot of it", 3, "A lot of it"), ("", 3, "")],
)
def test_markers(line, role, rest):
    assert transcripts.marker(line) == (role, rest)


def test_held_out_turns_are_recovered(spark):
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    given = {(r.conv_id, r.role, (r.text or "").strip()) for r in table(spark, SF, "conversations").collect() if held(r.conv_id)}
    turns = [r for r in op5_transcripts(spark, SF).collect() if held(r.conv_id)]
    found = {(r.conv_id, r.role, r.text) for r in turns}
    assert len(given & found) >= 0.97 * len(given)
    assert all(r.rendered == f"<|{r.role}|>\n{r.text}\n<|end|>\n" for r in turns)


def test_segments_do_not_change_the_path(spark, model, monkeypatch):
    rows = [(1, i, f"{'User' if i % 2 else 'Assistant'}: line {i}\nmore of {i}\n" if i % 7 else f"unmarked {i}\n") for i in range(300)]
    rows += [(2, i, t) for _, i, t in rows[:40]]
    raw = spark.createDataFrame(rows, "conv_id long, part long, text string")
    results = []
    for size in (7, 64, 100_000):
        monkeypatch.setattr(transcripts, "SEGMENT_PARTS", size)
        results.append(sorted((r.conv_id, r.turn, r.role, r.text) for r in transcripts.parse(raw, model).collect()))
    # only the first line of a segment, which is taken to follow a blank one, can tell them apart
    assert results[0] == results[1] == results[2]
    assert {r[0] for r in results[0]} == {1, 2} and [r[1] for r in results[0] if r[0] == 2] == list(range(len([r for r in results[0] if r[0] == 2])))


def test_odd_rows(spark, model):
    rows = [(None, 0, "User: hi\n", 1), (None, 1, "Bot: ho\n", 1), (3, None, None, 1), (4, 0, "", 1), (5, 0, "Human: " + "x" * 50_000, 1), (6, 0, "Q: same\n", 1), (6, 0, "Q: same\n", 1)]
    raw = spark.createDataFrame(rows, "conv_id long, part long, text string, segment int")
    found = sorted(((r.conv_id is None, r.conv_id or 0), r.turn, r.role, r.text) for r in transcripts.parse(raw, model).collect())
    assert [f[2:] for f in found if f[0] == (True, 0)] == [("user", "hi"), ("assistant", "ho")]
    assert [f[2:] for f in found if f[0] == (False, 6)] == [("user", "same")] * 2
    assert [f[3] for f in found if f[0][1] in (3, 4)] == ["", ""]
    assert transcripts.parse(raw.filter("part > 9"), model).count() == 0
    empty = transcripts.train(raw.withColumn("role", F.lit("nobody")))
    assert transcripts.parse(raw, empty).count() > 0


def _features(lines):
    """Features of a segment's lines, written out."""
    return [
        (transcripts.marker(x)[0], sum(len(x.strip()) > n for n in (0, 40, 120, 400)), int(x.strip().endswith("?")), int(i == 0 or lines[i - 1].strip() == ""))
        for i, x in enumerate(lines)
    ]


def _best_paths(model, features):
    """All state paths of lines with their log probability, the best first."""
    paths = [((), 0.0)]
    for seen in features:
        longer = []
        for path, score in paths:
            for state in range(6):
                step = model.steps[path[-1], state] if path else (0.0 if state % 2 == 0 else -float("inf"))
                total = score + step + sum(table[state, value] for table, value in zip(model.features, seen))
                if total > -float("inf"):
                    longer.append(((*path, state), total))
        paths = longer
    return sorted(paths, key=lambda p: -p[1])


def test_turns_against_all_paths(spark, model, monkeypatch):
    monkeypatch.setattr(transcripts, "SEGMENT_PARTS", 2)
    draw = random.Random(5)
    some = ["User: why?", "and more of it", "", "Assistant: " + "so " * 30, "no marker here?", "System: be kind", "A: yes", "x" * 130]
    given = {c: ["\n".join(draw.choices(some, k=draw.randint(1, 2))) for _ in range(draw.randint(1, 4))] for c in range(40)}
    raw = spark.createDataFrame([(c, i, t) for c, texts in given.items() for i, t in enumerate(texts)], "conv_id long, part long, text string")
    found = {}
    for r in transcripts.parse(raw, model).collect():
        found.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    compared = 0
    for c, texts in given.items():
        segments = [[x for t in texts[i : i + 2] for x in t.split("\n")] for i in range(0, len(texts), 2)]
        lines = [x for s in segments for x in s]
        paths = _best_paths(model, [f for s in segments for f in _features(s)])
        if len(paths) > 1 and paths[0][1] - paths[1][1] < 1e-9:
            continue  # either of two equal paths will do
        turns = []
        for line, state in zip(lines, paths[0][0]):
            if state % 2 == 0:
                turns.append((transcripts.ROLES[state // 2], [transcripts.marker(line)[1]]))
            else:
                turns[-1][1].append(line)
        assert sorted(found[c]) == [(i, role, "\n".join(own).strip()) for i, (role, own) in enumerate(turns)], c
        compared += 1
    assert compared >= 35

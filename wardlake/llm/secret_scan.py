"""Secret scans with DataFrame functions only.

Three patterns find the well-known shapes. Two Markov models over characters, one of random strings
and one of ordinary words, then judge every other long run of key characters: it is a secret when
the log-likelihood ratio of the models outweighs the prior odds. The models are trained on a
bounded sample of documents: their long words count as ordinary, and digests of their ids (hex,
Base64, upper case) with the values the patterns found count as random.
"""

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.llm.common import free_name, hashed_sample, stash

# The kinds in the order they are listed, and their patterns.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
#: Runs the models judge, and words and numbers they learn as ordinary: no mixture of both.
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"
WORD = r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z_-]{8,}+|[0-9-]{8,}+)(?![A-Za-z0-9+/_-])"
CLASSES = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"
#: Documents the models are trained on at most, and the log odds a run has to outweigh.
TRAINING_ROWS, LOG_ODDS = 2_000, math.log(1_000_000)
#: Weight of a character's own frequency against the counted steps.
BACKOFF = 8.0

#: Rows of an array that are gathered before the result is joined.
TOGETHER = 512

_SPAN = "struct<start:int,end:int>"
_SPANS = f"array<{_SPAN}>"
_PIECE = "struct<from:int,to:int,mark:string>"


def _let(value: Column, body: Callable) -> Column:
    """``body(value)`` with the value computed once: inside a lambda an expression would be computed again per element."""
    return F.get(F.transform(F.array(value), body), 0)


def _fold(rows: Column, state: Column, step: Callable, emit: Callable, kind: str, last: Callable | None = None) -> Column:
    """Run a state along an array and collect what ``emit(state, row)`` gives, an array of ``kind``.

    An array grows by copying, so results are gathered in pieces of ``TOGETHER`` rows and joined at
    the end: the work grows with the number of rows, not with its square.
    """
    nothing = F.array().cast(f"array<{kind}>")

    def cut(rows: Column) -> Column:
        first = F.sequence(F.lit(0), F.greatest(F.size(rows) - 1, F.lit(0)), F.lit(TOGETHER))
        return F.transform(first, lambda i: F.slice(rows, i + 1, F.lit(TOGETHER)))

    def one(acc: Column, row: Column) -> Column:
        return F.struct(step(acc["state"], row).alias("state"), F.concat(acc["out"], emit(acc["state"], row)).alias("out"))

    def piece(acc: Column, some: Column) -> Column:
        begin = F.struct(acc["state"].alias("state"), nothing.alias("out"))
        done = lambda a: F.struct(a["state"].alias("state"), F.concat(acc["out"], F.array(a["out"])).alias("out"))
        return F.aggregate(some, begin, one, done)

    end = lambda acc: F.flatten(F.concat(acc["out"], F.array(last(acc["state"]))) if last else acc["out"])
    return F.aggregate(_let(rows, cut), F.struct(state.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("out")), piece, end)


def _spans(text: Column, pattern: str, gate: Column, keep=lambda match, value: F.lit(True), group: int = 0) -> Column:
    """Start and end (code points, end exclusive) of the matches that are kept, in order.

    Splitting at the pattern gives the lengths between the matches. The work is done only where
    ``gate`` holds.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    between = F.split(text, pattern, -1)
    rows = F.arrays_zip(matches.alias("m"), values.alias("v"), F.slice(between, 1, F.size(matches)).alias("b"))
    # lengths and the decision are all that is carried on
    sized = F.transform(rows, lambda r: F.struct(F.length(r["b"]).alias("b"), F.length(r["m"]).alias("m"), keep(r["m"], r["v"]).alias("kept")))

    def emit(at: Column, row: Column) -> Column:
        begin = at + row["b"]
        one = F.array(F.struct(begin.alias("start"), (begin + row["m"]).alias("end")))
        return F.when(row["kept"], one).otherwise(F.array().cast(_SPANS))

    found = _fold(sized, F.lit(0), lambda at, row: at + row["b"] + row["m"], emit, _SPAN)
    return F.when(gate, found).otherwise(F.array().cast(_SPANS))


def base_spans(text: Column) -> dict[str, Column]:
    """Spans by kind for the three patterns; a cheap search decides which texts a pattern sees."""
    lowered = F.lower(text)
    key = F.lit(False)
    for part in ("passw", "secret", "token", "apikey", "api_key"):
        key = key | lowered.contains(part)
    long_value = lambda match, value: F.length(value) >= 8
    long_key = lambda match, value: F.length(match) >= 16
    return {
        "assign": _spans(text, ASSIGN, key, long_value, 2),
        "access": _spans(text, ACCESS, text.contains("AKIA"), long_key),
        "hex": _spans(text, HEX, text.rlike(HEX)),
    }


def _neighbours(string: Column, pair: Callable) -> Column:
    """``pair(a, b)`` of every character and the next one; the string is cut into characters once."""
    return _let(F.split(string, ""), lambda c: F.zip_with(F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0))), F.slice(c, 2, F.size(c)), pair))


def _steps(strings: DataFrame) -> DataFrame:
    """Counts of neighbouring character classes in a column ``s``."""
    pairs = strings.select(F.inline(_neighbours(F.col("s"), lambda a, b: F.struct(a.alias("a"), b.alias("b")))))
    return pairs.groupBy("a", "b").agg(F.count("*").alias("n"))


def train(documents: DataFrame, rows: int = TRAINING_ROWS) -> list[float]:
    """Log ratio of the two models for each pair of characters, random over ordinary.

    The sample is the documents with the smallest hashes of their ids; only these ids are broadcast.
    The driver gets at most one count per pair of characters.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    named = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), text.alias("text"))
    chosen = hashed_sample(named.select("id"), "id", rows)
    # of rows that share an id one is enough
    sample = named.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("text").alias("text"))
    sample = stash(sample, "secret-sample")
    found = base_spans(F.col("text"))
    taken = F.concat(*found.values())
    digest = F.sha2("id", 256)
    drawn = [F.base64(F.unhex(digest)), digest, F.upper(F.translate(F.base64(F.unhex(digest)), "+/=abcdefghijklm", ""))]
    values = F.transform(taken, lambda s: F.substring(F.col("text"), s["end"] - F.least(F.lit(32), s["end"] - s["start"]) + 1, F.lit(32)))
    random = sample.select(F.explode(F.concat(F.array(*drawn), values)).alias("s"))
    words = F.regexp_extract_all(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), f"{ACCESS}|{HEX}", " "), F.lit(WORD), F.lit(0))
    ordinary = sample.select(F.explode(words).alias("s"))
    counted = _steps(random).withColumn("kind", F.lit(1)).union(_steps(ordinary).withColumn("kind", F.lit(0)))
    known = {c: i for i, c in enumerate(CLASSES)}
    n = len(CLASSES)
    counts = [[[0] * n for _ in range(n)] for _ in range(2)]
    for row in counted.collect():
        if row.a in known and row.b in known:
            counts[row.kind][known[row.a]][known[row.b]] += row.n
    shares = []
    for table in counts:
        # steps seen too seldom fall back on how common the second character is
        total = sum(map(sum, table))
        common = [(sum(line[b] for line in table) + 0.5) / (total + 0.5 * n) for b in range(n)]
        shares.append([[(v + BACKOFF * c) / (sum(line) + BACKOFF) for v, c in zip(line, common)] for line in table])
    return [math.log(r / o) for line_r, line_o in zip(shares[1], shares[0]) for r, o in zip(line_r, line_o)]


def _ratio(run: Column, table: list[float]) -> Column:
    """Log-likelihood ratio of a run, summed over its steps; padding has no class and no weight."""
    weights = F.split(F.lit(",".join(f"{x:.4f}" for x in table)), ",").cast("array<double>")

    def weight(a: Column, b: Column) -> Column:
        a, b = F.instr(F.lit(CLASSES), a), F.instr(F.lit(CLASSES), b)
        return F.when((a > 0) & (b > 0), F.get(weights, (a - 1) * len(CLASSES) + b - 1)).otherwise(0.0)

    return F.aggregate(_neighbours(run, weight), F.lit(0.0), lambda total, w: total + w)


def _apart(runs: Column, base: Column) -> Column:
    """The runs that overlap no base span; runs do not overlap each other.

    In order of their starts, base spans first, a run overlaps a span before it when one of those
    ends behind its start, or the next span when that starts before its end. So the state is the
    furthest end so far and the run that waits for the next span.
    """
    part = lambda spans, kind: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))
    rows = F.sort_array(F.concat(part(base, 0), part(runs, 1)))
    nobody = F.lit(None).cast(_SPAN)
    none, waiting = F.array().cast(_SPANS), lambda state: F.array(state["run"])

    def step(state: Column, row: Column) -> Column:
        own = F.struct(row["start"].alias("start"), row["end"].alias("end"))
        run = F.when((row["kind"] == 1) & (state["far"] <= row["start"]), own).otherwise(nobody)
        far = F.when(row["kind"] == 0, F.greatest(state["far"], row["end"])).otherwise(state["far"])
        return F.struct(far.alias("far"), run.alias("run"))

    def emit(state: Column, row: Column) -> Column:
        gone = state["run"].isNull() | ((row["kind"] == 0) & (row["start"] < state["run"]["end"]))
        return F.when(gone, none).otherwise(waiting(state))

    start = F.struct(F.lit(0).alias("far"), nobody.alias("run"))
    found = _fold(rows, start, step, emit, _SPAN, lambda state: F.when(state["run"].isNull(), none).otherwise(waiting(state)))
    return F.when((F.size(runs) > 0) & (F.size(base) > 0), found).otherwise(runs)


def _with_spans(documents: DataFrame, text: str, table: list[float]) -> tuple[DataFrame, dict[str, str]]:
    """Add one column of spans per kind under free names."""
    names: dict[str, str] = {}
    for kind in KINDS:
        names[kind] = free_name(documents, f"_{kind}")
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    out = documents.withColumns({names[k]: c for k, c in base_spans(whole).items()})
    base = F.concat(*(F.col(names[k]) for k in KINDS[:3]))
    runs = _spans(whole, RUN, whole.rlike(RUN), lambda match, value: _ratio(match, table) > LOG_ODDS)
    out = out.withColumn(names["markov"], runs)
    return out.withColumn(names["markov"], _apart(F.col(names["markov"]), base)), names


def _listed(names: dict[str, str], kinds: tuple[str, ...]) -> Column:
    """Spans of some kinds by start, then kind: structs of start, rank and end."""
    def ranked(rank: int) -> Column:
        mark = lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"))
        return F.transform(F.col(names[KINDS[rank]]), mark)

    parts = [ranked(rank) for rank, kind in enumerate(KINDS) if kind in kinds]
    return F.sort_array(F.concat(*parts))


def _written(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])), ",")


def scan(documents: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_markov, base_spans, spans`` of every row.

    Spans are written ``kind:start:end`` in code points, by start and then kind. Null and empty texts
    have none, repeated rows are scanned each, a null ``doc_id`` stays null, an empty table gives
    none. Other columns are not used.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found, names = _with_spans(rows, "text", train(rows))
    counts = [F.size(names[k]).cast("long").alias(f"n_{k}") for k in KINDS]
    base = _written(_listed(names, KINDS[:3])).alias("base_spans")
    return found.select("doc_id", *counts, base, _written(_listed(names, KINDS)).alias("spans"))


def redact(documents: DataFrame, text: str = "text") -> DataFrame:
    """The same table with every secret replaced by ``[kind]``; a null text stays null."""
    rows = documents.select("doc_id", F.col(f"`{text}`").alias("text"))
    found, names = _with_spans(documents, text, train(rows))
    kinds = F.array(*map(F.lit, KINDS))
    source = F.col(f"`{text}`").cast("string")

    def emit(at: Column, s: Column) -> Column:
        # overlapping spans share one replacement
        mark = F.concat(F.lit("["), F.get(kinds, s["rank"]), F.lit("]"))
        piece = F.struct(at.alias("from"), s["start"].alias("to"), mark.alias("mark"))
        return F.when(s["start"] >= at, F.array(piece)).otherwise(F.array().cast(f"array<{_PIECE}>"))

    spans = _listed(names, KINDS)
    # what follows the last mark ends behind any text
    rest = lambda at: F.array(F.struct(at.alias("from"), F.lit(2**31 - 1).alias("to"), F.lit("").alias("mark")))
    pieces = _fold(spans, F.lit(0), lambda at, s: F.greatest(at, s["end"]), emit, _PIECE, rest)
    # the text is cut into characters once, and each piece is a slice of them
    piece = lambda c: lambda p: F.concat(F.array_join(F.slice(c, p["from"] + 1, p["to"] - p["from"]), ""), p["mark"])
    written = _let(F.split(source, ""), lambda c: F.array_join(F.transform(pieces, piece(c)), ""))
    clean = F.when(F.size(spans) > 0, written).otherwise(source)
    return found.withColumn(text, clean).drop(*names.values())

"""Gate for arriving batches: a pair of patients and admissions is processed once complete.

``process_arrivals`` follows a folder of batch directories with a file stream:

    incoming/<batch>/patients.csv      a file, or a directory of part files
    incoming/<batch>/admissions.csv

Each is moved into place in one rename, as a whole. The stream looks at paths only, never at
the content. The two halves of a pair may arrive in different micro-batches: the stream keeps one
small state per incomplete batch, which goes when the pair is complete. A complete batch is open
until its callback succeeds; one that failed is tried again on the next trigger, and a finished one
moves to ``processed``. One caller at a time has the turn, so no batch runs twice.

``check_incoming`` is the same gate for a single folder with fixed file names.
"""

import logging
import time
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wardlake import fs
from wardlake.schemas import ADMISSIONS_FILE, PATIENTS_FILE

log = logging.getLogger(__name__)

OnReady = Callable[[str, str], object]
#: All complete pairs at once; tells for each whether it succeeded.
OnAll = Callable[[list[tuple[str, str]]], list[bool]]

#: State of the stream: a few bytes per incomplete batch, whatever the batches hold.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.shuffle.partitions": "4",
}
#: Seconds after which a turn that was not renewed counts as lost with its driver.
TURN_SECONDS = 3600.0


def check_incoming(spark: SparkSession, incoming: str, on_ready: OnReady, processed: str = "processed") -> bool:
    """Call back and archive when both files are there. False when not, or when it failed."""
    _need_folder(spark, incoming)
    pair = [f"{incoming}/{PATIENTS_FILE}", f"{incoming}/{ADMISSIONS_FILE}"]
    if not all(fs.exists(spark, p) for p in pair):
        return False
    try:
        on_ready(*pair)
    except Exception:
        log.exception("callback failed, %s stays where it is", incoming)
        return False
    for path in pair:
        fs.move(spark, path, f"{incoming}/{processed}/{path.rsplit('/', 1)[-1]}")
    return True


def complete_batches(arrivals: DataFrame) -> DataFrame:
    """Names of the batches both of whose files have come, from a stream of (batch, file)."""

    # a local class goes to the workers whole, so they need not have this module
    class PairGate(StatefulProcessor):
        """One state per batch: which of the two files have come. Both: it fires, the state goes."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self._seen = handle.getValueState("seen", "patients boolean, admissions boolean")

        def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
            patients, admissions = self._seen.get() or (False, False)
            for row in rows:
                patients |= row["file"] == PATIENTS_FILE
                admissions |= row["file"] == ADMISSIONS_FILE
            if patients and admissions:
                self._seen.clear()
                yield Row(batch=key[0])
            else:
                self._seen.update((patients, admissions))

        def close(self) -> None:
            pass

    return arrivals.groupBy("batch").transformWithState(PairGate(), "batch string", "Append", "None")


def process_arrivals(
    spark: SparkSession,
    incoming: str,
    state: str,
    on_ready: OnReady,
    processed: str | None = None,
    on_all: OnAll | None = None,
    turn_seconds: float = TURN_SECONDS,
) -> list[str]:
    """Process what has arrived since the last call; returns the batches that succeeded.

    ``state`` keeps the stream's checkpoint and a marker per open batch. Files that were there
    before the first call count. Call it again, from any scheduler, for what comes next: a call
    while another one works does nothing. With ``on_all`` several open batches are handed over
    together, a single one still goes to ``on_ready``.
    """
    _need_folder(spark, incoming)
    root = fs.qualified(spark, incoming)
    turn = _Turn(spark, f"{state}/turn", turn_seconds)
    if not turn.take():
        log.info("another caller has the turn at %s", incoming)
        return []
    try:
        _follow(spark, root, state)
        return _run_open(spark, root, state, on_ready, processed, on_all, turn)
    finally:
        turn.end()


def _follow(spark: SparkSession, root: str, state: str) -> None:
    """Let the stream catch up; every batch that is complete now gets a marker."""
    arrivals = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", True)
        .load(root)
        .select(_relative("path", root).alias("parts"))
        .select(F.element_at("parts", 1).alias("batch"), F.try_element_at("parts", F.lit(2)).alias("file"))
        .filter(F.col("file").isin(PATIENTS_FILE, ADMISSIONS_FILE))
    )

    def note(fired: DataFrame, epoch: int) -> None:
        # one short name per batch; a replayed epoch finds its markers there
        for row in fired.toLocalIterator():
            if not fs.exists_exactly(spark, f"{state}/open/{row['batch']}"):
                fs.create_text(spark, f"{state}/open/{row['batch']}", "")

    with fs.settings(spark, STATE):
        query = (
            complete_batches(arrivals)
            .writeStream.foreachBatch(note)
            .option("checkpointLocation", f"{state}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()


def _run_open(spark: SparkSession, root: str, state: str, on_ready: OnReady, processed: str | None, on_all: OnAll | None, turn: "_Turn") -> list[str]:
    waiting = fs.names(spark, f"{state}/open")
    pair = lambda batch: (f"{root}/{batch}/{PATIENTS_FILE}", f"{root}/{batch}/{ADMISSIONS_FILE}")
    done = []

    def finish(batch: str) -> None:
        if not fs.exists_exactly(spark, f"{state}/finished/{batch}"):
            fs.create_text(spark, f"{state}/finished/{batch}", "")
        if processed is not None and fs.exists_exactly(spark, f"{root}/{batch}"):
            fs.move(spark, f"{root}/{batch}", f"{processed}/{batch}")
        fs.remove(spark, f"{state}/open/{batch}")

    # a batch whose driver was lost between its callback and its move
    for batch in [b for b in waiting if fs.exists_exactly(spark, f"{state}/finished/{b}")]:
        finish(batch)
        waiting.remove(batch)
    if on_all is not None and len(waiting) > 1:
        turn.renew()
        outcome = zip(waiting, on_all([pair(b) for b in waiting]), strict=True)
        for batch in [b for b, succeeded in outcome if succeeded]:
            finish(batch)
            done.append(batch)
        return done
    for batch in waiting:
        turn.renew()
        try:
            on_ready(*pair(batch))
        except Exception:
            log.exception("batch %s failed and stays open", batch)
            continue
        finish(batch)
        done.append(batch)
    return done


class TurnLostError(RuntimeError):
    """Another caller took over, because this one had not renewed its turn in time."""


class _Turn:
    """A file that only one caller can create, and that its owner touches while it works."""

    def __init__(self, spark: SparkSession, path: str, seconds: float):
        self.spark, self.path, self.seconds, self.owner = spark, path, seconds, uuid.uuid4().hex

    def take(self) -> bool:
        try:
            fs.create_text(self.spark, self.path, self.owner)
            return True
        except FileExistsError:
            if time.time() - fs.modified(self.spark, self.path) < self.seconds:
                return False
        # its owner is gone: of several callers who see that, one can rename the file
        try:
            fs.rename(self.spark, self.path, f"{self.path}-lost-{self.owner}")
            fs.create_text(self.spark, self.path, self.owner)
            return True
        except OSError:
            return False

    def mine(self) -> bool:
        return fs.exists_exactly(self.spark, self.path) and fs.read_text(self.spark, self.path) == self.owner

    def renew(self) -> None:
        if not self.mine():
            raise TurnLostError(self.path)
        fs.touch(self.spark, self.path)

    def end(self) -> None:
        if self.mine():
            fs.remove(self.spark, self.path)


def _relative(column: str, root: str):
    bare = r"^[a-zA-Z0-9]+:/*"
    prefix = F.regexp_replace(F.lit(root.rstrip("/") + "/"), bare, "")
    tail = F.substr(F.regexp_replace(F.col(column), bare, ""), F.length(prefix) + 1)
    return F.split(tail, "/")


def _need_folder(spark: SparkSession, path: str) -> None:
    if not fs.exists(spark, path):
        raise FileNotFoundError(f"nothing to watch at {path}")

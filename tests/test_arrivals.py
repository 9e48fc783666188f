import shutil

import pytest

from wardlake import fs
from wardlake.plans.pipeline import run_from_files
from wardlake.plans.store import ClinicalStore
from wardlake.streaming.arrivals import TurnLostError, _Turn, check_incoming, process_arrivals


@pytest.fixture
def incoming(tmp_path):
    path = tmp_path / "incoming"
    path.mkdir()
    return path


def put(incoming, inputs, batch, *names):
    for source in inputs:
        if source.rsplit("/", 1)[-1] in names:
            (incoming / batch).mkdir(exist_ok=True)
            shutil.copy(source, incoming / batch)


def test_one_folder_waits_for_both_files(spark, incoming, inputs):
    calls = []
    shutil.copy(inputs[0], incoming)
    assert not check_incoming(spark, str(incoming), lambda p, a: calls.append((p, a)))
    shutil.copy(inputs[1], incoming)
    (incoming / "processed").mkdir()
    (incoming / "processed" / "patients.csv").write_text("older")
    assert check_incoming(spark, str(incoming), lambda p, a: calls.append((p, a)))
    assert calls == [(f"{incoming}/patients.csv", f"{incoming}/admissions.csv")]
    assert sorted(p.name for p in incoming.iterdir()) == ["processed"]
    assert (incoming / "processed" / "patients.csv").read_text() != "older"
    assert not check_incoming(spark, str(incoming), lambda p, a: calls.append((p, a)))


def test_one_folder_stays_when_the_callback_fails(spark, incoming, inputs):
    for source in inputs:
        shutil.copy(source, incoming)

    def fail(*paths):
        raise RuntimeError("no")

    assert not check_incoming(spark, str(incoming), fail)
    assert (incoming / "patients.csv").exists() and (incoming / "admissions.csv").exists()
    assert check_incoming(spark, str(incoming), lambda *paths: None)


def test_missing_folder(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        check_incoming(spark, str(tmp_path / "none"), lambda *paths: None)
    with pytest.raises(FileNotFoundError):
        process_arrivals(spark, str(tmp_path / "none"), str(tmp_path / "state"), lambda *paths: None)


def test_batches_across_triggers(spark, incoming, inputs, tmp_path):
    calls = []
    failing = {"b2"}

    def on_ready(patients, admissions):
        batch = patients.split("/")[-2]
        calls.append(batch)
        if batch in failing:
            raise RuntimeError("not yet")

    def trigger():
        calls.clear()
        return process_arrivals(spark, str(incoming), str(tmp_path / "state"), on_ready, str(tmp_path / "processed"))

    assert trigger() == []
    put(incoming, inputs, "b1", "patients.csv", "admissions.csv", "other.txt")
    put(incoming, inputs, "b2", "patients.csv")
    assert trigger() == ["b1"] and calls == ["b1"]
    assert (tmp_path / "processed" / "b1" / "patients.csv").exists() and not (incoming / "b1").exists()
    # the second half arrives in a later micro-batch; the callback fails once, then works
    put(incoming, inputs, "b2", "admissions.csv")
    put(incoming, inputs, "b3", "patients.csv", "admissions.csv")
    assert trigger() == ["b3"] and calls == ["b2", "b3"]
    assert (incoming / "b2" / "patients.csv").exists()
    failing.clear()
    assert trigger() == ["b2"] and calls == ["b2"]
    assert trigger() == [] and calls == []


def test_batches_run_the_pipeline(spark, incoming, inputs, tmp_path):
    store = ClinicalStore(spark, str(tmp_path / "store"))
    put(incoming, inputs, "b1", "patients.csv", "admissions.csv")
    # part files below a directory of the same name work alike
    for source in inputs:
        folder = incoming / "b2" / source.rsplit("/", 1)[-1]
        folder.mkdir(parents=True)
        shutil.copy(source, folder / "part-00000.csv")
    done = process_arrivals(
        spark, str(incoming), str(tmp_path / "state"), lambda p, a: run_from_files(store, p, a, trigger_type="watcher")
    )
    assert done == ["b1", "b2"]
    assert store.patients().count() == 2 and store.admissions().count() == 3
    assert {(r["trigger_type"], r["status"], r["records_processed"]) for r in store.runs().collect()} == {("watcher", "success", 6)}
    assert fs.names(spark, f"{tmp_path}/state/finished") == ["b1", "b2"]


def test_two_callers_process_a_batch_once(spark, incoming, inputs, tmp_path):
    calls, inner = [], []
    put(incoming, inputs, "b1", "patients.csv", "admissions.csv")

    def on_ready(patients, admissions):
        calls.append(patients)
        # a second scheduler wakes up while the first one works
        inner.append(process_arrivals(spark, str(incoming), str(tmp_path / "state"), on_ready))

    assert process_arrivals(spark, str(incoming), str(tmp_path / "state"), on_ready) == ["b1"]
    assert len(calls) == 1 and inner == [[]]
    assert process_arrivals(spark, str(incoming), str(tmp_path / "state"), on_ready) == [] and len(calls) == 1


def test_a_lost_turn_is_taken_over(spark, tmp_path):
    path = str(tmp_path / "turn")
    lost, other, late = (_Turn(spark, path, seconds) for seconds in (100.0, 0.0, 100.0))
    assert lost.take() and not _Turn(spark, path, 100.0).take()
    assert other.take() and not late.take()
    with pytest.raises(TurnLostError):
        lost.renew()
    lost.end()
    assert other.mine()
    other.renew()
    other.end()
    assert late.take()


def test_batches_are_handed_over_together(spark, incoming, inputs, tmp_path):
    for batch in ("b1", "b2", "b3"):
        put(incoming, inputs, batch, "patients.csv", "admissions.csv")
    together, alone = [], []

    def on_all(pairs):
        together.append([p.split("/")[-2] for p, _ in pairs])
        return [p.split("/")[-2] != "b2" for p, _ in pairs]

    def trigger():
        return process_arrivals(spark, str(incoming), str(tmp_path / "state"), lambda p, a: alone.append(p.split("/")[-2]), on_all=on_all)

    assert trigger() == ["b1", "b3"] and together == [["b1", "b2", "b3"]]
    # the one that failed is alone now
    assert trigger() == ["b2"] and alone == ["b2"] and len(together) == 1
    assert fs.names(spark, f"{tmp_path}/state/open") == []


def test_a_batch_finished_before_its_driver_was_lost(spark, incoming, inputs, tmp_path):
    put(incoming, inputs, "b1", "patients.csv", "admissions.csv")
    state = tmp_path / "state"

    def fail(*paths):
        raise RuntimeError("not yet")

    assert process_arrivals(spark, str(incoming), str(state), fail) == []
    fs.create_text(spark, f"{state}/finished/b1", "")
    assert process_arrivals(spark, str(incoming), str(state), fail, str(tmp_path / "processed")) == []
    assert (tmp_path / "processed" / "b1").exists() and fs.names(spark, f"{state}/open") == []

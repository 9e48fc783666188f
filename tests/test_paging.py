import random

import pytest

from wardlake.operators import ordinals
from wardlake.operators.ordinals import write_sorted
from wardlake.operators.paging import page, page_rows, rows_after, sorted_page


@pytest.fixture
def sorted_tables(tmp_path, monkeypatch):
    """Pages of several sorted tables with small files."""

    def make(*frames, order):
        monkeypatch.setattr(ordinals, "MAX_FILE_ROWS", 150)
        tables = [write_sorted(df, order, f"{tmp_path}/t{k}") for k, df in enumerate(frames)]
        return lambda limit, offset: sorted_page(frames[0], tables, order, limit, offset)

    return make


def rows(n, seed=1):
    out = [(f"k{i % 97:03d}" if i % 97 else None, i) for i in range(n)]
    random.Random(seed).shuffle(out)
    return out


def key(row):
    return (row[0] is not None, row[0] or "", row[1])


OFFSETS = [0, 7, 149, 150, 450, 1999, 2990, 3000, 9999]


def test_pages_match_a_full_sort(spark, sorted_tables):
    data = rows(3000)
    df = spark.createDataFrame(data, "a string, b long").repartition(4)
    everything = sorted(data, key=key)
    assert [tuple(r) for r in page_rows(df, ["a", "b"], 25, 450).collect()] == everything[450:475]
    paged = sorted_tables(df, order=["a", "b"])
    for offset in OFFSETS:
        found = paged(25, offset)
        assert found.total == 3000
        assert [tuple(r) for r in found.items.collect()] == everything[offset : offset + 25]


def test_pages_of_several_tables(spark, sorted_tables):
    data = rows(3000)
    df = spark.createDataFrame(data, "a string, b long")
    parts = [df.filter("b % 5 < 3"), df.filter("b % 5 = 3"), df.filter("b < 0"), df.filter("b % 5 = 4")]
    paged = sorted_tables(*parts, order=["a", "b"])
    for offset in OFFSETS:
        assert [tuple(r) for r in paged(40, offset).items.collect()] == sorted(data, key=key)[offset : offset + 40]


def test_a_key_that_holds_most_rows(spark, sorted_tables):
    data = [("hot", i) for i in range(2000)] + [(f"z{i}", i) for i in range(50)]
    paged = sorted_tables(spark.createDataFrame(data, "a string, b long"), order=["a", "b"])
    for offset in (0, 1500, 1990, 2045):
        assert [tuple(r) for r in paged(10, offset).items.collect()] == sorted(data)[offset : offset + 10]


def test_a_deep_page_opens_the_files_it_lies_in(spark, tmp_path):
    df = spark.range(0, 1_100_000, 1, 8).selectExpr("id % 3 AS a", "id AS b")
    table = write_sorted(df, ["a", "b"], str(tmp_path / "t"))
    found = sorted_page(df, [table], ["a", "b"], 50, 1_000_000)
    assert [r["a"] for r in found.items.collect()] == [2] * 50 and len(table.files) > 3
    assert 1 <= len(found.items.inputFiles()) <= 2
    plan = found.items._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_orders_that_a_directory_cannot_keep(spark, tmp_path):
    with pytest.raises(TypeError):
        write_sorted(spark.createDataFrame([(1.5,)], "a double"), ["a"], str(tmp_path / "t"))


def test_reference_page(spark):
    df = spark.createDataFrame([(f"HOSP-{i:06d}",) for i in range(25)], "external_id string")
    found = page(df, ["external_id"], limit=10, offset=20)
    assert (found.total, found.limit, found.offset) == (25, 10, 20)
    assert [r[0] for r in found.items.collect()] == [f"HOSP-{i:06d}" for i in range(20, 25)]


@pytest.mark.parametrize("limit, offset", [(0, 0), (501, 0), (-1, 0), (10, -1)])
def test_bounds(spark, limit, offset):
    with pytest.raises(ValueError):
        page_rows(spark.range(3).toDF("a"), ["a"], limit, offset)


def test_after(spark):
    data = [(a, b) for a in ("x", "y") for b in range(5)]
    df = spark.createDataFrame(data, "a string, b long")
    assert [tuple(r) for r in rows_after(df, ["a", "b"], ["x", 3], 3).collect()] == [("x", 4), ("y", 0), ("y", 1)]


def test_pages_among_many_null_keys(spark, sorted_tables):
    data = [(f"k{i % 97:03d}" if i % 3 else None, i) for i in range(3000)]
    df = spark.createDataFrame(data, "a string, b long").repartition(4)
    data.sort(key=key)
    paged = sorted_tables(df, order=["a", "b"])
    for offset in (0, 300, 600, 980, 990, 1005, 2000):
        assert [tuple(r) for r in paged(25, offset).items.collect()] == data[offset : offset + 25]
        after = rows_after(df, ["a", "b"], list(data[offset]), 25).collect()
        assert [tuple(r) for r in after] == data[offset + 1 : offset + 26]

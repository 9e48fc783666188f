import hashlib
import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wardlake.llm import sharding


def choice(key, weights):
    def score(s):
        text = f"{'' if key is None else key}#{s}"
        return -weights[s] / math.log((int(hashlib.md5(text.encode()).hexdigest()[:13], 16) + 0.5) / 16**13)

    return max(range(len(weights)), key=score)


def gapless(rows):
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r.slot)
    return all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())


def test_against_plain_python(spark):
    weights = [1.0, 2.0, 0.5, 4.0]
    rows = sharding.assign(spark.range(5000).withColumnRenamed("id", "doc_id"), weights, more=[3.0]).collect()
    assert all(r.shard == choice(r.doc_id, weights) and r.grown_shard == choice(r.doc_id, [*weights, 3.0]) for r in rows)
    assert gapless(rows)
    # slots follow the keys
    assert all(a.doc_id < b.doc_id for a in rows for b in rows[:50] if a.shard == b.shard and a.slot < b.slot)


def test_shares_follow_the_weights_and_few_rows_move(spark):
    weights = [1.0, 1.0, 2.0, 4.0]
    keys = spark.range(40_000).withColumnRenamed("id", "doc_id")
    rows = sharding.with_shard(keys, weights, more=[2.0]).collect()
    for s, n in Counter(r.shard for r in rows).items():
        assert n / len(rows) == pytest.approx(weights[s] / 8, abs=0.01)
    assert all(r.grown_shard in (r.shard, 4) for r in rows)
    assert sum(r.grown_shard == 4 for r in rows) / len(rows) == pytest.approx(0.2, abs=0.01)


def test_a_key_may_hold_most_rows(spark):
    hot = F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id"))
    rows = sharding.assign(spark.range(0, 30_000, 1, 8).withColumn("doc_id", hot), [1.0] * 4).collect()
    assert len(rows) == 30_000 and gapless(rows) and len({r.shard for r in rows if r.doc_id == 7}) == 1


def test_odd_rows(odd):
    documents, rows = odd
    sized = sharding.with_text_size(documents.withColumns({"_row": F.lit("x"), "_scores": F.lit(1), "_task": F.lit(2)}))
    found = sharding.assign(sized, [1.0] * 16, more=[1.0])
    assert found.columns == [*sized.columns, "shard", "grown_shard", "slot"]
    got = found.collect()
    assert gapless(got) and all(r.shard == choice(r.doc_id, [1.0] * 16) and r._row == "x" for r in got)
    utf8 = [(i, (t or "").encode()) for i, t in rows]
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, len(t) + 1, zlib.crc32(t)) for i, t in utf8)


def test_empty_table_and_bad_weights(nothing):
    assert sharding.assign(nothing, [1.0, 2.0]).count() == 0
    for weights in ([], [1.0, 0.0], [float("nan")]):
        with pytest.raises(ValueError):
            sharding.with_shard(nothing, weights)


def test_written_shards(corpus, spark, tmp_path):
    assigned = sharding.assign(corpus, [1.0, 3.0])
    sharding.write_shards(assigned, f"{tmp_path}/shards")
    assert sorted(p.name for p in tmp_path.glob("shards/shard=*")) == ["shard=0", "shard=1"]
    back = spark.read.parquet(f"{tmp_path}/shards").select(assigned.columns)
    assert sorted(back.collect()) == sorted(assigned.collect())


def test_no_python_and_no_gathered_shard(corpus):
    placed = sharding.assign(sharding.with_text_size(corpus), [1.0] * 16)
    plan = placed._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "CartesianProduct", "ExistingRDD"))

import numpy as np

from wardlake.llm import embedding_dedup, small_world


def expected(rows, least=0.95):
    usable = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    n = len(usable)
    near = np.zeros((n, n), bool)
    for a in range(n):
        for b in range(n):
            x, y = usable[a][1], usable[b][1]
            near[a, b] = a != b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= least
    root = np.arange(n)
    while True:
        after = np.minimum(root, np.where(near, root[None, :], n).min(axis=1, initial=n))
        if (after == root).all():
            break
        root = after
    smallest = {}
    for k, (i, _) in enumerate(usable):
        smallest[root[k]] = min(float("inf") if i is None else i, smallest.get(root[k], float("inf")))
    return sorted((usable[k][0] if usable[k][0] is not None else float("inf"), int(near[k].sum()), smallest[root[k]]) for k in range(n))


def check(spark, rows):
    found = embedding_dedup.similar_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, row long, v string")).collect()
    far = lambda x: float("inf") if x is None else x
    assert len(found) == len(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)
    alone = len(rows) - len(expected([r[:2] for r in rows]))
    got = sorted((far(r.vec_id), r.n_links, far(r.component_id)) for r in found)
    for one in expected([r[:2] for r in rows]):
        got.remove(one)
    assert len(got) == alone and all(n == 0 and i == c for i, n, c in got)


def test_clusters_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    vectors = []
    for size in (1, 1, 1, 2, 5, 30, 120):
        centre = rng.normal(size=16)
        vectors += [centre + rng.normal(size=16) * rng.choice([0.0, 0.1, 0.25]) for _ in range(size)]
    vectors += [rng.normal(size=16) for _ in range(200)]
    order = rng.permutation(len(vectors))
    check(spark, [(int(i), vectors[k].tolist(), 1, 2, "x") for i, k in enumerate(order)])


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 0.0], [1.0, 0.0], [0.0, 0.0], None, [nan, 1.0], [1.0, None], [1.0, 0.1], [1.0, 0.0, 0.0], [2.0, 0.0], [inf, 1.0], [], [-0.0, 0.0]]
    rows = [(i, v, 1, 2, "x") for i, v in enumerate(vectors, 1)] + [(None, [1.0, 0.0], 1, 2, "x"), (1, [1.0, 0.0], 1, 2, "x")]
    check(spark, rows)
    assert embedding_dedup.similar_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_graph_search_finds_what_brute_force_finds():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 24))
    x[2000:] = x[rng.integers(0, 2000, 1000)] + rng.normal(size=(1000, 24)) * 0.05
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    q, n = small_world.within(x, small_world.build(x), x, 0.95, embedding_dedup.BEAM)
    truth = x @ x.T >= 0.95
    assert truth[q, n].all() and len(set(zip(q.tolist(), n.tolist()))) >= 0.99 * truth.sum()


def test_query_on_table(spark):
    from wardlake.llm.queries import op9_small_world, table

    rows = [(r.vec_id, r.embedding) for r in table(spark, "/root/testdata/sf0.01", "embeddings").collect()]
    found = sorted((r.vec_id, r.n_links, r.component_id) for r in op9_small_world(spark, "/root/testdata/sf0.01").collect())
    assert found == expected(rows)


def test_links_of_a_node_lead_to_distinct_others():
    x = np.random.default_rng(6).normal(size=(300, 8)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for nodes, links in small_world.build(x):
        for at, row in enumerate(links):
            there = row[row >= 0].tolist()
            assert len(there) == len(set(there)) and at not in there


def test_a_wide_beam_sees_every_node_once():
    x = np.random.default_rng(7).normal(size=(900, 4)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    queries = np.concatenate([x[:300], -x[:20]])  # more than walk together
    ids, cosines = small_world.search(x, small_world.build(x), queries, 900)
    assert (np.sort(ids, axis=1) == np.arange(900)).all()
    assert np.allclose(cosines, np.take_along_axis(queries @ x.T, ids, axis=1), atol=1e-6)


def test_shards_are_not_shuffled_and_links_not_listed(spark, monkeypatch):
    """Two shards meet without an exchange, and no table grows with the square of a group."""
    rng = np.random.default_rng(11)
    n, keep, plans, counts = 600, embedding_dedup.Scratch.keep, {}, {}

    def spied(self, df, name, **more):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        kept = keep(self, df, name, **more)
        counts[name] = kept.count()
        return kept

    monkeypatch.setattr(embedding_dedup.Scratch, "keep", spied)
    monkeypatch.setattr(embedding_dedup, "AUDITED", 3)
    centre = rng.normal(size=8)
    rows = [(k, (centre + rng.normal(size=8) * 0.02).tolist(), 0, 0, "x") for k in range(n)]
    check(spark, rows)
    meetings = [plan for plan in plans.values() if "links" in plan and "nodes" in plan and "Scan parquet" in plan]
    assert meetings and all("Exchange" not in plan for plan in meetings)
    shards = embedding_dedup.LEAST_SHARDS
    assert max(counts.values()) <= n * (2 * shards + 3)


def test_vectors_of_single_and_double_precision_and_copies(spark):
    rng = np.random.default_rng(12)
    vectors = [v for v in rng.normal(size=(40, 5)).astype(np.float32).tolist() for _ in range(3)]
    vectors += [(np.array(v) * 1.01 + 0.01).tolist() for v in vectors[:30]]
    rows = [(k, v) for k, v in enumerate(np.array(vectors, np.float32).tolist())]
    found = [
        sorted((r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.similar_vectors(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")).collect())
        for kind in ("float", "double")
    ]
    assert found[0] == found[1] == expected(rows)


def test_pairs_found_from_one_side_count_for_both():
    rng = np.random.default_rng(13)
    exact = rng.normal(size=(30, 4))
    rows = []
    for k, part in enumerate((exact[:13], exact[13:])):
        levels = small_world.build((part / np.linalg.norm(part, axis=1, keepdims=True)).astype(np.float32))
        rows.append({"size": 4, "shard": k, "ids": list(range(13 * k, 13 * k + len(part))), "copies": [1 + i % 3 for i in range(len(part))], "flat": part.tobytes()}
                    | {"nodes": [x.astype(np.int32).tobytes() for x, _ in levels], "links": [x.astype(np.int32).tobytes() for _, x in levels]})
    unit = exact / np.linalg.norm(exact, axis=1, keepdims=True)
    near, copies = unit @ unit.T >= 0.7, np.array([*rows[0]["copies"], *rows[1]["copies"]])
    np.fill_diagonal(near, False)
    one, other = (embedding_dedup._Shard(r) for r in rows)
    counted, linked, shown = np.zeros(30, int), [], []
    for a, b, same in ((one, one, True), (one, other, False), (other, other, True)):
        for batch in embedding_dedup._met(a, b, same, 0.7, 16, np.array([2, 20])):
            for kind, x, y in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == embedding_dedup._COPIES:
                    counted[x] += y
                (linked if kind == embedding_dedup._LINK else shown if kind == embedding_dedup._AUDITED else []).append((x, y))
    assert (counted == near @ copies).all()
    assert sorted(shown) == sorted((a, b) for a in range(30) for b in range(a + 1, 30) if near[a, b] and {a, b} & {2, 20})
    label = np.arange(30)
    embedding_dedup._connect(label, *np.array(linked).T)
    truth = np.arange(30)
    embedding_dedup._connect(truth, *np.nonzero(near))
    assert (label == truth).all()

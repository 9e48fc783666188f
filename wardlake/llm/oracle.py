"""SQL that must give the same rows, for the queries SQL can express."""

#: Every window of 50 words, the smallest document it starts in, and the words later ones lose.
SUBSTRING = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
  windows AS (SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS run
    FROM docs, unnest(range(1, len(words) - 48)) AS t(i)),
  firsts AS (SELECT run, min(doc_id) AS first FROM windows GROUP BY run),
  repeats AS (SELECT doc_id, i FROM windows JOIN firsts USING (run) WHERE first < doc_id),
  gone AS (SELECT DISTINCT doc_id, i + k AS place FROM repeats, range(50) AS r(k)),
  single AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM docs),
  kept AS (SELECT s.doc_id, count(g.place) AS n_removed,
    string_agg(s.word, ' ' ORDER BY s.place) FILTER (g.place IS NULL) AS rest
    FROM single s LEFT JOIN gone g ON s.doc_id = g.doc_id AND s.place = g.place GROUP BY s.doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

#: All pairs of usable vectors, and what they reach.
EMBEDDINGS = """
WITH RECURSIVE usable AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
  links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y
    ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v) AND list_cosine_similarity(x.v, y.v) >= 0.95),
  reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
  counted AS (SELECT a, count(*) AS n FROM links GROUP BY a),
  smallest AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, coalesce(m, e.vec_id)) AS component_id,
  e.vec_id = least(e.vec_id, coalesce(m, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN counted c ON e.vec_id = c.a LEFT JOIN smallest s ON e.vec_id = s.a
"""

#: Scores of every key on 17 shards, and crc32 by its table.
SHARDS = r"""
WITH steps AS (SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: xor(c >> 1, (c & 1) * 3988292384))) AS t),
  docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS utf8 FROM documents),
  summed AS (SELECT doc_id, length(utf8) // 2 + 1 AS size,
    xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(utf8, '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32 FROM docs, steps),
  ids AS (SELECT DISTINCT doc_id FROM docs),
  draws AS (SELECT doc_id, s, -1 / ln((('0x' || substr(md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), '#', s)), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE) AS score
    FROM ids, unnest(range(17)) AS r(s)),
  chosen AS (SELECT doc_id, arg_max(s, score) FILTER (s < 16) AS shard, arg_max(s, score) AS grown FROM draws GROUP BY doc_id)
SELECT d.doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, CAST(shard AS INT) AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY d.doc_id NULLS FIRST) - 1 AS slot, CAST(grown AS INT) AS grown_shard
FROM summed d JOIN chosen c ON d.doc_id IS NOT DISTINCT FROM c.doc_id
"""

#: All scores of every 50th vector, its five positives, and three negatives below each.
NEGATIVES = """
WITH usable AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM usable a JOIN usable b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
  positives AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INT) AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
  AND 100 * score BETWEEN 50 * positive_score AND 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) <= 3
"""

ORACLE = {"op7_substring": SUBSTRING, "op9_small_world": EMBEDDINGS, "op11_rendezvous_shards": SHARDS, "op12_vertical_negatives": NEGATIVES}

"""DuckDB SQL for the manifest, the resampling and the shards, as the queries define them."""

# crc_row: the CRC-32 table, from the polynomial; CRC of a text goes through the bytes of its UTF-8 form.
_CRC_ROW = """crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_row)"""


def _crc32(text):
    values = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {values}), lambda c, b: xor(c >> 8, crc_row[1 + (xor(c, b) & 255)])), 4294967295)"


def _field(value):
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"


def _tree(first, prefix, levels):
    """CTEs of a ternary tree: ``prefix``k holds level k (s, i, h, nodes of the level m, digests on the left and right in the run)."""
    out, below = [], first
    for k in range(levels + 1):
        out.append(f"""{prefix}{k} AS MATERIALIZED (SELECT s, i, h, count(*) OVER (PARTITION BY s) AS m,
  coalesce(string_agg(h, '') OVER (PARTITION BY s, i // 3 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(h, '') OVER (PARTITION BY s, i // 3 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {below})""")
        below = f"(SELECT s, i // 3 AS i, CASE WHEN any_value(m) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {prefix}{k} GROUP BY ALL)"
    return out


def _climb(start, prefix, tree, levels):
    """CTEs that carry (doc_id, s, i, digest, proof) up a tree."""
    out, below = [], start
    for k in range(levels + 1):
        out.append(f"""{prefix}{k} AS MATERIALIZED (SELECT doc_id, s, i // 3 AS i, leaf, proof || l || r AS proof,
  CASE WHEN m = 1 THEN digest ELSE sha256(l || digest || r) END AS digest FROM {below} JOIN {tree}{k} USING (s, i))""")
        below = f"{prefix}{k}"
    return out


def merkle_sql(levels=14, top=6):
    """Trees of up to 3^levels leaves a source and 3^top sources."""
    columns = ("doc_id", "source", "lang", "n_chars")
    shared = " || ".join(_field(c) for c in columns)
    shown = "CASE WHEN even THEN replace(text, chr(10), '') ELSE text END"
    parts = [
        _CRC_ROW,
        f"told AS (SELECT *, {_crc32('CAST(doc_id AS VARCHAR)')} % 2 = 0 AS even FROM documents, crc)",
        f"leaves AS (SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s, sha256({shared} || {_field('text')}) AS leaf, sha256({shared} || {_field(shown)}) AS alt FROM told)",
        "placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves)",
        *_tree("(SELECT s, i, leaf AS h FROM placed)", "n", levels),
        *_tree(f"(SELECT 0 AS s, s AS i, h FROM n{levels})", "t", top),
        *_climb("(SELECT doc_id, s, i, leaf, alt AS digest, '' AS proof FROM placed)", "c", "n", levels),
        *_climb(f"(SELECT doc_id, 0 AS s, s AS i, leaf, digest, proof FROM c{levels})", "u", "t", top),
    ]
    return f"""WITH {", ".join(parts)}
SELECT doc_id, p.leaf, n{levels}.h AS subroot, t{top}.h AS root, sha256(proof) AS proof_sha256, digest AS folded_root, digest = t{top}.h AS verified
FROM placed p JOIN u{top} USING (doc_id) JOIN n{levels} ON n{levels}.s = p.s, t{top}"""


def resampling_sql(words, benchmark_words):
    """``words``, ``benchmark_words``: SQL for the list of words of a text of either table."""
    grams = "SELECT {key}, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM (SELECT *, unnest([1, 2, 3]) AS n FROM {t}) WHERE len(w) >= n)"
    return f"""WITH {_CRC_ROW},
d AS (SELECT doc_id, {words} AS w FROM documents),
b AS (SELECT 0 AS doc_id, {benchmark_words} AS w FROM benchmark),
dg AS MATERIALIZED ({grams.format(key='doc_id', t='d')}), bg AS MATERIALIZED ({grams.format(key='doc_id', t='b')}),
codes AS MATERIALIZED (SELECT g, {_crc32('g')} % 10000 AS k FROM (SELECT DISTINCT g FROM (SELECT g FROM dg UNION ALL SELECT g FROM bg)), crc),
have AS (SELECT k, count(*) AS s FROM dg JOIN codes USING (g) GROUP BY k), want AS (SELECT k, count(*) AS t FROM bg JOIN codes USING (g) GROUP BY k),
sums AS (SELECT (SELECT count(*) FROM dg) AS all_s, (SELECT count(*) FROM bg) AS all_t),
gains AS (SELECT k, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (all_s + 10000) / ((coalesce(s, 0) + 1)::DOUBLE * (all_t + 10000)))) AS BIGINT) AS gain
          FROM have FULL JOIN want USING (k), sums),
weights AS (SELECT doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM dg JOIN codes USING (g) JOIN gains USING (k) GROUP BY doc_id),
scored AS (SELECT doc_id, len(w) >= 20 AS long_, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM d LEFT JOIN weights USING (doc_id)),
placed AS (SELECT *, row_number() OVER (PARTITION BY long_ ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY long_) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN long_ AND place <= 5 * n // 100 THEN place END AS rank FROM placed"""


def shards_sql(shards=16):
    """One heap over all groups: what the query gives for up to 16,384 of them."""
    return f"""WITH RECURSIVE {_CRC_ROW},
d AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
g AS MATERIALIZED (SELECT md5(x) AS item, sum(octet_length(encode(x)) + 1) AS size FROM d GROUP BY ALL),
o AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY size DESC, item) AS i FROM g),
run AS (SELECT CAST(0 AS BIGINT) AS i, list_transform(range({shards}), lambda m: CAST(0 AS HUGEINT)) AS loads, CAST(-1 AS INTEGER) AS shard
  UNION ALL SELECT o.i, list_transform(loads, lambda v, m: CASE WHEN m = list_position(loads, list_min(loads)) THEN v + size ELSE v END),
  CAST(list_position(loads, list_min(loads)) - 1 AS INTEGER) FROM run JOIN o ON o.i = run.i + 1)
SELECT doc_id, CAST(octet_length(encode(x)) + 1 AS BIGINT) AS size, coalesce({_crc32('x')}, 0) AS text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id, item) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM d JOIN o ON o.item = md5(x) JOIN run ON run.i = o.i, crc"""

"""Registered queries of the corpus operators, and their reference SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.scratch import scratch_path
from barlake.llm import (
    centroids,
    decontaminate,
    langid,
    licenses,
    outliers,
    packing,
    quality,
    resample,
    secrets,
    sharding,
    simhash,
    suffix_dedup,
    warc,
)
from barlake.llm.common import table

SHARDS = 24


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[
            F.size(F.expr(f"filter(split(base_spans, ','), s -> startswith(s, '{kind}:'))"))
            .cast("long")
            .alias(f"n_{kind}")
            for kind in secrets.BASE_KINDS
        ],
        F.sha2("base_spans", 256).alias("base_sha256"),
        "spans",
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).drop("doc_key")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: ``source/lang/doc_id``."""
    files = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("file_key"),
        F.concat_ws("/", F.coalesce("source", F.lit("_")), F.coalesce("lang", F.lit("_")), F.col("doc_id").cast("string")).alias("path"),
        "text",
    )
    found = licenses.scan_licenses(files)
    return found.select(F.col("file_key").alias("doc_id"), "path", "license", "cosine", "origin")


def op9_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judge(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "distance",
    )


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op11_orchard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, written to the shared folder and read back."""
    archives = scratch_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), archives)
    read = warc.read_archives(spark, archives).where("kind = 'record'")
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_langid": op2_langid,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_secrets": op4_secrets,
    "op5_packing": op5_packing,
    "op6_quality": op6_quality,
    "op7_simhash": op7_simhash,
    "op8_licenses": op8_licenses,
    "op9_outliers": op9_outliers,
    "op10_decontaminate": op10_decontaminate,
    "op11_orchard": op11_orchard,
    "op12_resample": op12_resample,
    "op13_warc": op13_warc,
}
_VALUES = ", ".join(f"('{name}', '{statement}')" for name, statement in licenses.TEMPLATES)
_SPLIT = "list_filter(regexp_split_to_array(lower({}), '[^a-z0-9]+'), lambda t: t <> '')"


def _cluster_rounds() -> str:
    """The rounds of the clustering, one assignment and one table of centroids each."""
    out = []
    for i in range(centroids.ROUNDS + 1):
        out.append(f"""
      a{i} AS MATERIALIZED (
        SELECT rid, vec_id, v, c AS cluster, d AS distance FROM (
          SELECT rid, vec_id, v, c, list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
          FROM ints, c{i})
        QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c) = 1)""")
        if i < centroids.ROUNDS:
            out.append(f"""
      c{i + 1} AS MATERIALIZED (
        SELECT c{i}.c, coalesce(n.m, c{i}.m) AS m FROM c{i} LEFT JOIN (
          SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY k) AS m FROM (
            SELECT cluster, k, sum(v[k])::BIGINT AS s, count(*) AS n FROM a{i}, range(1, {centroids.DIMENSIONS + 1}) AS t(k) GROUP BY 1, 2)
          GROUP BY 1) n ON n.cluster = c{i}.c)""")
    return ",".join(out)


_CRC_TABLE = """
        SELECT list(v ORDER BY i) AS crc FROM (
          SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END,
                                CAST(i AS BIGINT)) AS v
          FROM range(256) AS t(i))"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _network_rounds() -> str:
    """The rounds of the permutation as nested selects over ``walk`` (l, r: the halves)."""
    prime, inner = sharding.PRIME, "SELECT w.*, x >> low AS l, x & ((1 << low) - 1) AS r FROM walk w WHERE x >= n OR NOT moved"
    for i, (multiplier, addend) in enumerate(sharding.Permutation(1).round_keys()):
        h = f"((r * {multiplier} + {addend}) % {prime})"
        mixed = f"((((xor({h}, {h} >> 15) % {prime}) * 69621 + {addend}) % {prime}) >> 3)"
        width = "wide" if i % 2 == 0 else "low"
        inner = f"SELECT * REPLACE (r AS l, xor(l, {mixed}) & ((1 << {width}) - 1) AS r) FROM ({inner})"
    return inner


#: SQL expresses op1, op3 and op8 in full. The others rest on hashes, fitted models or greedy steps
#: that it lacks; tests/llm holds them against brute force.
ORACLES: dict[str, str] = {
    "op1_sharding": f"""
      WITH RECURSIVE bits AS (
        SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END,
                              CAST(i AS BIGINT)) AS v
        FROM range(256) AS t(i)),
      crc_table AS (SELECT list(v ORDER BY i) AS crc FROM bits),
      raw AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
      sums AS (
        SELECT doc_id, CAST(octet_length(b) + 8 AS BIGINT) AS size,
               xor(list_reduce(list_transform(range(1, octet_length(b) + 1),
                                              lambda k: CAST('0x' || hex(array_slice(b, k, k)) AS BIGINT)),
                               lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1]), CAST(4294967295 AS BIGINT)),
                   4294967295) AS text_crc32
        FROM raw, crc_table),
      numbered AS (
        SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS x, count(*) OVER () AS n FROM documents),
      sized AS (SELECT *, greatest(2, length(bin(n - 1))) AS width FROM numbered),
      walk AS (
        SELECT doc_id, x, n, CAST(width // 2 AS INTEGER) AS low, CAST(width - width // 2 AS INTEGER) AS wide, false AS moved
        FROM sized
        UNION ALL
        SELECT doc_id, (l << low) | r AS x, n, low, wide, true AS moved FROM ({_network_rounds()}))
      SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(x % {SHARDS} AS INTEGER) AS shard, x // {SHARDS} AS slot,
             CAST(NULL AS INTEGER) AS grown_shard
      FROM walk JOIN sums USING (doc_id) WHERE moved AND x < n""",
    "op3_suffix_dedup": """
      WITH docs AS (
        SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
      windows AS (SELECT doc_id, p, array_slice(b, p + 1, p + 50) AS w FROM (SELECT *, unnest(range(0, n - 49)) AS p FROM docs)),
      firsts AS (SELECT w, min(doc_id) AS least FROM windows GROUP BY 1),
      hits AS (SELECT doc_id, p FROM windows JOIN firsts USING (w) WHERE least < doc_id),
      starts AS (SELECT doc_id, p, p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS gap FROM hits),
      runs AS (SELECT doc_id, p, sum(CASE WHEN gap <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM starts),
      spans AS (SELECT doc_id, run, min(p) AS a, max(p) + 50 AS z FROM runs GROUP BY 1, 2),
      sums AS (SELECT doc_id, sum(z - a) AS removed, count(*) AS spans FROM spans GROUP BY 1),
      pieces AS (
        SELECT doc_id, a AS pos, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS f, a AS t FROM spans
        UNION ALL SELECT doc_id, n AS pos, coalesce(z, 0) AS f, n AS t FROM docs LEFT JOIN (SELECT doc_id, max(z) AS z FROM spans GROUP BY 1) USING (doc_id)),
      kept AS (
        SELECT doc_id, string_agg(hex(array_slice(b, f + 1, t)), '' ORDER BY pos) AS h FROM pieces JOIN docs USING (doc_id) GROUP BY 1)
      SELECT doc_id, n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
             sha256(unhex(coalesce(h, ''))) AS kept_sha256
      FROM docs LEFT JOIN sums USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op8_licenses": f"""
      WITH templates(template, statement) AS (VALUES {_VALUES}),
      counts AS (
        SELECT template, token, count(*) AS n
        FROM (SELECT template, unnest({_SPLIT.format("statement")}) AS token FROM templates) GROUP BY 1, 2),
      idf AS (SELECT token, ln((1.0 + {len(licenses.TEMPLATES)}) / (1 + count(*))) + 1 AS idf FROM counts GROUP BY 1),
      weights AS (
        SELECT token, template, n * idf / sqrt(sum((n * idf) * (n * idf)) OVER (PARTITION BY template)) AS weight
        FROM counts JOIN idf USING (token)),
      files AS (
        SELECT doc_id, coalesce(source, '_') || '/' || coalesce(lang, '_') AS dir, text FROM documents),
      cut AS (
        SELECT doc_id, dir, text, list_filter(list_transform(
                 string_split(regexp_replace(text, '([.!?])[ \t]+', '\1' || chr(10), 'g'), chr(10)),
                 lambda s: lower(trim(s))), lambda s: s <> '') AS sentences
        FROM files WHERE regexp_matches(lower(text), '{licenses.CUES}')),
      stated AS (
        SELECT doc_id, dir, len(sentences) AS total, sentence, true AS spoken
        FROM (SELECT *, unnest(sentences) AS sentence FROM cut)
        WHERE regexp_matches(sentence, '{licenses.CUES}')
        UNION ALL
        SELECT doc_id, dir, total, header, false
        FROM (SELECT doc_id, dir, len(sentences) AS total, lower(regexp_split_to_array(text, '\\n[ \\t\\r]*\\n')[1]) AS header FROM cut)
        WHERE regexp_matches(header, '{licenses.CUES}')),
      vectors AS (
        SELECT sentence, token, n * coalesce(idf, ln(1.0 + {len(licenses.TEMPLATES)}) + 1) AS w
        FROM (SELECT sentence, token, count(*) AS n
              FROM (SELECT sentence, unnest({_SPLIT.format("sentence")}) AS token
                    FROM (SELECT DISTINCT sentence FROM stated)) GROUP BY 1, 2)
        LEFT JOIN idf USING (token)),
      cosines AS (
        SELECT sentence, template, round(sum(w * weight) / any_value(norm), 6) AS cosine
        FROM vectors JOIN (SELECT sentence, sqrt(sum(w * w)) AS norm FROM vectors GROUP BY 1) USING (sentence)
        JOIN weights USING (token) GROUP BY 1, 2),
      best AS (
        SELECT sentence, split_part(template, '#', 1) AS license, cosine FROM cosines
        QUALIFY row_number() OVER (PARTITION BY sentence ORDER BY cosine DESC, template) = 1),
      own AS (
        SELECT doc_id, dir, arg_min(license, row(-cosine, license)) AS license, max(cosine) AS cosine,
               count(*) FILTER (spoken) >= any_value(total) AS whole
        FROM stated JOIN (FROM best WHERE cosine >= {licenses.LIKE}) USING (sentence) GROUP BY 1, 2),
      holders AS (
        SELECT dir, arg_min(license, row(-cosine, license)) AS license FROM own WHERE whole GROUP BY 1)
      SELECT f.doc_id, f.dir || '/' || f.doc_id AS path, coalesce(o.license, h.license) AS license, o.cosine,
             CASE WHEN o.doc_id IS NOT NULL THEN 'own' WHEN h.dir IS NOT NULL THEN 'inherited' END AS origin
      FROM files f LEFT JOIN own o ON o.doc_id = f.doc_id LEFT JOIN holders h ON h.dir = f.dir""",
    "op11_orchard": f"""
      WITH ints AS MATERIALIZED (
        SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({centroids.SCALE} * x::DOUBLE)::BIGINT) AS v
        FROM embeddings
        WHERE len(embedding) = {centroids.DIMENSIONS}
          AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {centroids.DIMENSIONS}),
      c0 AS MATERIALIZED (
        SELECT (row_number() OVER (ORDER BY h) - 1)::INTEGER AS c, v AS m FROM (
          SELECT sha256('{centroids.SEED}:' || vec_id) AS h, v FROM ints ORDER BY h LIMIT {centroids.CLUSTERS})),
      {_cluster_rounds()}
      SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
             sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
      FROM a{centroids.ROUNDS} JOIN c{centroids.ROUNDS} ON c = cluster""",
    "op12_resample": f"""
      WITH crc_table AS ({_CRC_TABLE}),
      cut AS (
        SELECT row_number() OVER () AS rid, doc_id,
               regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS words
        FROM documents),
      feats AS (SELECT rid, unnest(words) AS word FROM cut),
      aims AS (
        SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                         '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')) AS word FROM benchmark),
      hashed AS (
        SELECT word, xor(list_reduce(list_transform(range(1, octet_length(encode(word)) + 1),
                                                    lambda k: CAST('0x' || hex(array_slice(encode(word), k, k)) AS BIGINT)),
                                     lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1]), CAST(4294967295 AS BIGINT)),
                         4294967295) % {resample.BUCKETS} AS bucket
        FROM (SELECT word FROM feats UNION SELECT word FROM aims), crc_table),
      s AS (SELECT bucket, count(*) AS s FROM feats JOIN hashed USING (word) GROUP BY 1),
      t AS (SELECT bucket, count(*) AS t FROM aims JOIN hashed USING (word) GROUP BY 1),
      totals AS (SELECT (SELECT count(*) FROM feats) AS sa, (SELECT count(*) FROM aims) AS ta),
      gains AS (
        SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (sa + {resample.BUCKETS})::DOUBLE
                                       / ((s + 1)::DOUBLE * (ta + {resample.BUCKETS})::DOUBLE)))::BIGINT AS gain
        FROM s LEFT JOIN t USING (bucket), totals),
      sums AS (
        SELECT rid, count(*) AS n, sum(gain)::BIGINT AS g FROM feats JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY 1),
      scored AS (
        SELECT rid, doc_id, len(words) AS n_words, coalesce(n, 0)::BIGINT AS n_features,
               coalesce((g - ((g % n) + n) % n) // n, 0)::BIGINT AS weight,
               ('0x' || left(sha256('{resample.SEED}:' || doc_id), 8))::BIGINT AS h
        FROM cut LEFT JOIN sums USING (rid)),
      drawn AS (
        SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM scored),
      ranked AS (
        SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS able
        FROM drawn WHERE n_words >= {resample.LEAST_WORDS})
      SELECT doc_id, n_features, weight, score, CASE WHEN r <= {resample.SHARE} * able // 100 THEN r END AS rank
      FROM drawn LEFT JOIN ranked USING (rid)""",
    "op13_warc": f"""
      WITH sums AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
      firsts AS (SELECT *, CASE WHEN n >= {warc.LEAST_BYTES} THEN max(page_id) OVER (PARTITION BY h) ELSE page_id END AS first FROM sums)
      SELECT page_id, n AS payload_bytes,
             list_reduce(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               (1 + ((('0x' || substr(h, (1 + 5 * (i // 4))::BIGINT, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31))::BIGINT, 1)),
               lambda a, b: a || b) AS payload_digest,
             CASE WHEN first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
             CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
      FROM firsts""",
}

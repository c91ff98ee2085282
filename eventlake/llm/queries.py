"""The named queries over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import (
    code_search,
    decontaminate,
    filter_audit,
    language_id,
    license_scan,
    line_dedup,
    merkle,
    packing,
    sharding,
    simhash,
    suffix_dedup,
    surrogates,
    url_filter,
)
from eventlake.llm import common as C
from eventlake.llm.common import table
from eventlake.llm.shipping import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.col("n_hit").cast("long").alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        "contaminated",
    )


ORACLE["op1_winnowing"] = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM item_windows),
places AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM words, sizes WHERE len(w) >= size),
hits AS (
  SELECT p.doc_id, p.i, p.size, t.item_id FROM (SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win FROM places) p
  JOIN item_windows t ON t.size = p.size AND t.win = p.win),
hit_words AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS pos FROM hits) GROUP BY 1),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


@query
def op6_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = language_id.identify(documents, language_id.learn(documents))
    held = F.coalesce(language_id.held_out(F.col("doc_id")), F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "bits_per_byte")


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_code(F.col("code")).alias("fingerprint"), "component_id")


@query
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(url_filter.RULES, url_filter.RULE_SCHEMA)
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


ORACLE["op4_url_filter"] = r"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
rules(verdict, rhost, rpath) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fits AS (
  SELECT page_id, verdict, rhost || rpath AS rule,
         row_number() OVER (PARTITION BY page_id ORDER BY len(string_split(rhost, '.')) DESC, len(rpath) DESC) AS rn
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN host = '' THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE rn = 1) USING (page_id)
"""


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("matches")




def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pieces(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.deduplicated(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_lines", "n_removed", "removed_runs", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


@query
def op5_code_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows of every row whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    return code_search.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), 10)


ORACLE["op5_code_search"] = """
WITH codes AS (
  SELECT DISTINCT vec_id, [x > 0 for x in embedding] AS signs FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) = 64 AND len([x for x in embedding if x IS NULL OR isnan(x)]) = 0),
bits AS (SELECT vec_id, unnest(signs) AS bit, unnest(range(64)) AS at_bit FROM codes),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(CAST(q.bit <> c.bit AS INTEGER)) AS distance
  FROM bits q JOIN bits c ON q.at_bit = c.at_bit WHERE q.vec_id % 50 = 0 GROUP BY 1, 2)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(distance AS INTEGER) AS distance
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM pairs)
WHERE rank <= 10
"""


@query
def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = surrogates.pseudonymised(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("entities").alias("n_entities"), "entities", "text")


@query
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.deduplicated(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shards(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


#: The second engine has no CRC-32: its table comes from the polynomial, and bytes are taken in one by one.
ORACLE["op11_sampled_splitters"] = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS tab),
sized AS (
  SELECT doc_id, coalesce(text, '') AS t, octet_length(encode(coalesce(text, ''))) + 8 AS size,
         CAST('0x' || substr(md5(coalesce(text, '')), 1, 15) AS BIGINT) AS text_place,
         coalesce(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT), -1) AS id_place
  FROM documents),
lined AS (
  SELECT *, sum(size) OVER w - size AS place, row_number() OVER w - 1 AS row_at, sum(size) OVER () AS total
  FROM sized WINDOW w AS (ORDER BY text_place, id_place, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING)),
grouped AS (
  SELECT *, sum(size) OVER (PARTITION BY text_place) AS group_bytes, min(place) OVER (PARTITION BY text_place) AS group_at
  FROM lined),
dealt AS (
  SELECT *, CASE WHEN group_bytes * 50 * 24 <= total THEN group_at ELSE place END * 24 // total AS shard FROM grouped)
SELECT doc_id, CAST(size AS BIGINT) AS size,
       xor(4294967295, list_reduce(list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: CAST('0x' || x AS BIGINT)),
                                   lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)]), CAST(4294967295 AS BIGINT))) AS text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
       CAST(row_at - min(row_at) OVER (PARTITION BY shard) AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM dealt, crc
"""


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE["op12_filter_audit"] = r"""
WITH marks AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY 1),
texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
  FROM documents),
words AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts),
fails AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
          100 * (octet_length(encode(t)) - octet_length(encode(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')))) > 3 * length(t),
          regexp_matches(t, '[#$%&*|]'), coalesce(words.doc_id > least, false)] AS f
  FROM words LEFT JOIN marks USING (doc_id)),
kinds AS (
  SELECT part, f, list_sum(list_transform(f, lambda x: CAST(x AS INTEGER))) AS n_failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM fails GROUP BY ALL),
letters AS (SELECT unnest(range(1, 6)) AS i),
orders AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
steps AS (
  SELECT array_to_string(list_transform(o, lambda x: substr('ABCDE', CAST(x AS INTEGER), 1)), '') AS filter_order, step,
         o[step] AS own, o[1:step - 1] AS earlier FROM orders, (SELECT unnest(range(1, 6)) AS step)),
met AS (
  SELECT part, filter_order, step, n, good, toxic, n_failed, f[own] AS own_fails,
         len(list_filter(earlier, lambda x: f[x])) > 0 AS gone FROM kinds, steps)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
       CAST(sum(CASE WHEN NOT gone AND NOT own_fails THEN n ELSE 0 END) AS BIGINT) AS kept,
       CAST(sum(CASE WHEN NOT gone AND own_fails THEN n ELSE 0 END) AS BIGINT) AS removed,
       CAST(sum(CASE WHEN gone AND own_fails THEN n ELSE 0 END) AS BIGINT) AS redundant,
       CAST(sum(CASE WHEN own_fails AND n_failed = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
       CAST(sum(CASE WHEN NOT gone AND own_fails THEN good ELSE 0 END) AS BIGINT) AS good_lost,
       CAST(sum(CASE WHEN NOT gone AND own_fails THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost,
       CAST(sum(CASE WHEN own_fails THEN n * 120 // n_failed ELSE 0 END) AS BIGINT) AS shapley
FROM met GROUP BY part, filter_order, step
"""


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third document, by the checksum of its id, is tried with its text lower-cased."""
    tried = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    made = merkle.manifest(table(spark, sf_dir, "documents"), changed_text=F.when(tried, C.lower_letters(F.col("text"))))
    return merkle.verified(made)


def _merkle_sql(levels: int = 6, top_levels: int = 2) -> str:
    """Level by level: enough for 8 to the power of ``levels`` rows a language, and of ``top_levels`` languages."""

    def field(value: str) -> str:
        return f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || CAST({value} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(map(field, ['doc_id', 'source', 'lang', 'n_chars', text]))})"

    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = "xor(4294967295, list_reduce(list_transform(regexp_extract_all(hex(encode(CAST(doc_id AS VARCHAR))), '..'), " \
        "lambda x: CAST('0x' || x AS BIGINT)), lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)]), CAST(4294967295 AS BIGINT)))"
    steps = [
        "crc AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8), "
        "lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS tab)",
        f"leaves AS (SELECT doc_id, lang AS grp, {leaf('text')} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {leaf(low)} ELSE {leaf('text')} END AS tried "
        "FROM documents, crc)",
        "n0 AS (SELECT grp, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, leaf AS node, "
        "count(*) OVER (PARTITION BY grp) AS size FROM leaves)",
        "walk0 AS (SELECT doc_id, grp, leaf, tried AS folded, '' AS proof, "
        "row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank FROM leaves)",
    ]

    def level(before: str, after: str, walk: str, walked: str) -> list[str]:
        """One level up: runs of nodes, and the siblings that each leaf collects there."""
        return [
            f"r{after} AS (SELECT grp, rank // 8 AS run, size, list(node ORDER BY rank) AS nodes FROM n{before} GROUP BY grp, rank // 8, size)",
            f"n{after} AS (SELECT grp, run AS rank, CASE WHEN size = 1 THEN nodes[1] ELSE sha256(array_to_string(nodes, '')) END AS node, "
            f"count(*) OVER (PARTITION BY grp) AS size FROM r{after})",
            f"{walked} AS (SELECT doc_id, w.grp, leaf, "
            "CASE WHEN size = 1 THEN folded ELSE sha256(array_to_string(list_transform(nodes, lambda x, i: CASE WHEN i = rank % 8 + 1 THEN folded ELSE x END), '')) END AS folded, "
            "CASE WHEN size = 1 THEN proof ELSE proof || array_to_string(list_transform(nodes, lambda x, i: CASE WHEN i = rank % 8 + 1 THEN '' ELSE x END), '') END AS proof, "
            f"rank // 8 AS rank FROM {walk} w JOIN r{after} r ON w.grp IS NOT DISTINCT FROM r.grp AND w.rank // 8 = r.run)",
        ]

    for k in range(levels):
        steps += level(str(k), str(k + 1), f"walk{k}", f"walk{k + 1}")
    steps += [
        f"subroots AS (SELECT grp AS lang, node, row_number() OVER (ORDER BY encode(grp) NULLS FIRST) - 1 AS rank FROM n{levels})",
        "nt0 AS (SELECT 0 AS grp, rank, node, count(*) OVER () AS size FROM subroots)",
        f"top0 AS (SELECT doc_id, 0 AS grp, leaf, folded, proof, s.rank FROM walk{levels} w JOIN subroots s ON w.grp IS NOT DISTINCT FROM s.lang)",
    ]
    for k in range(top_levels):
        steps += level(f"t{k}", f"t{k + 1}", f"top{k}", f"top{k + 1}")
    body = ",\n".join(steps)
    return f"""WITH {body}
SELECT l.doc_id, l.leaf, s.node AS subroot, r.node AS root, sha256(t.proof) AS proof_sha256, t.folded AS folded_root, t.folded = r.node AS verified
FROM top{top_levels} t JOIN leaves l ON l.doc_id IS NOT DISTINCT FROM t.doc_id AND l.leaf = t.leaf
JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.grp, nt{top_levels} r
"""


ORACLE["op13_merkle_manifest"] = _merkle_sql()

"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from logframe.llm import chunks, filteraudit, hashforest, langid, licenses, merkle, minhash, packing, pieces, products, sharding, simhash, warc
from logframe.llm.common import table
from logframe.llm.registry import query


@query("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op3_chunks")
def op3_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that repeat across documents, at each document but the first."""
    return chunks.repeats(table(spark, sf_dir, "documents"))


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
w AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS d, max(page_id) OVER (PARTITION BY h) AS m FROM p),
b AS (SELECT *, list_transform(range(0, 32), lambda i:
    (CAST(('0x' || substr(d, CAST((i * 5) // 4 + 1 AS BIGINT), 2 - CASE WHEN (i * 5) // 4 + 1 = 40 THEN 1 ELSE 0 END)) AS INTEGER)
      * CASE WHEN (i * 5) // 4 + 1 = 40 THEN 16 ELSE 1 END)) AS two FROM w)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (two[i + 1] // CAST(pow(2, 3 - (i * 5) % 4) AS INTEGER)) % 32 + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = m THEN NULL ELSE m END AS refers_to
FROM b
"""


@query("op5_warc", WARC_SQL)
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, written, indexed, and read back through the index."""
    captures = warc.write_archives(table(spark, sf_dir, "pages"))
    files = warc.write_index(captures)
    return warc.look_up(files, captures).drop("payload")


@query("op9_langid")
def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


@query("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


def license_sql() -> str:
    """The licence scan by comparing every block of words with every template."""
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    places = " || ".join(
        "list_transform(list_filter(range(0, len(ws)), lambda i: "
        + " AND ".join(f"coalesce(ws[i + {k + 1}] = '{w}', false)" for k, w in enumerate(phrase.split()))
        + f"), lambda i: {{'at': i, 'label': '{label}'}})"
        for phrase, label in licenses.PHRASES
    )
    templates = ", ".join(f"({t.words}, {t.needed}, {t.block}, {'NULL' if t.name is None else repr(t.name)}, '{t.label}')" for t in licenses.as_sets())
    return f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
w AS (SELECT k, doc_id, regexp_extract_all(low, '{pattern}') AS ws FROM d),
p AS (SELECT k, doc_id, len(ws) AS n_words, {places} AS places FROM w),
t(tw, a, block, name, label) AS (VALUES {templates}),
c AS (SELECT k, ws, t.*, unnest(range(0, len(ws))) AS i FROM w JOIN t ON len(list_intersect(tw, ws)) >= a),
b AS (SELECT k, label, tw, a, name, ws[i + 1:i + block] AS bw FROM c WHERE list_contains(tw, ws[i + 1])),
m AS (SELECT k, label, len(list_intersect(tw, bw)) / len(tw) AS share FROM b WHERE len(list_intersect(tw, bw)) >= a AND (name IS NULL OR list_contains(bw, name))),
g AS (SELECT k, list(DISTINCT label) AS of_templates, max(share) AS share FROM m GROUP BY k),
j AS (SELECT *, list_transform(places, lambda x: x.at) AS ats, list_distinct(list_transform(places, lambda x: x.label)) AS base FROM p LEFT JOIN g USING (k))
SELECT doc_id, n_words, len(places) AS n_base, list_min(ats) AS first_word, list_max(ats) AS last_word,
  array_to_string(list_sort(base), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(base || coalesce(of_templates, []))), ',') AS labels,
  CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
FROM j
"""


@query("op8_licenses", license_sql())
def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates in every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op7_sharding")
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes."""
    found = sharding.shard(table(spark, sf_dir, "documents"), 16)
    return found.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


@query("op2_hashforest")
def op2_hashforest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest vectors found for every hundredth vector."""
    return hashforest.neighbours(table(spark, sf_dir, "embeddings"))


PRODUCT_SQL = """
WITH e AS (SELECT DISTINCT vec_id, embedding FROM embeddings),
v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM e
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.w) = len(c.w)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


@query("op4_products", PRODUCT_SQL)
def op4_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest integer inner products for every hundredth vector."""
    return products.top_products(table(spark, sf_dir, "embeddings"))


@query("op6_pieces")
def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded into pieces and decoded again."""
    return pieces.digests(table(spark, sf_dir, "documents"))


MINHASH_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(range(0, greatest(len(ws) - 3, 1)), lambda i: array_to_string(ws[i + 1:i + 4], ' ')))) END AS s FROM d),
c AS (SELECT min(doc_id) AS node, s FROM g WHERE len(s) > 0 GROUP BY s),
x AS (SELECT node, len(s) AS n, hash(unnest(s)) AS h FROM c),
p AS (SELECT a.node AS a, b.node AS b FROM x a JOIN x b ON a.h = b.h AND a.node < b.node AND a.n * 100 >= 80 * b.n AND b.n * 100 >= 80 * a.n
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
r(node, reached) AS (SELECT node, node FROM c UNION SELECT e.a, r.reached FROM r JOIN e ON e.b = r.node),
k AS (SELECT node, min(reached) AS component_id FROM r GROUP BY node)
SELECT g.doc_id, CAST(len(g.s) AS BIGINT) AS n_shingles, coalesce(k.component_id, g.doc_id) AS component_id, g.doc_id = coalesce(k.component_id, g.doc_id) AS kept
FROM g LEFT JOIN c ON c.s = g.s LEFT JOIN k ON k.node = c.node
"""


@query("op11_minhash", MINHASH_SQL)
def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents by the similarity of their shingle sets."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


LOW_TEXT = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def merkle_sql(inner: int = 6, outer: int = 4) -> str:
    """The manifest level by level, for at most ``16 ** inner`` rows of a source and ``16 ** outer`` sources."""

    def leaf(text: str) -> str:
        columns = [text if name == "text" else name for name in merkle.FIELDS]
        return "sha256(" + " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns) + ")"

    def level(k: str, s: str, p: str, i: str) -> list[str]:
        """Runs of level ``p`` as ``k``r, nodes above as ``k``."""
        return [
            f"{i} AS (SELECT s, r // 16 AS r, c, list(h ORDER BY r) AS hs FROM {p} GROUP BY s, r // 16, c)",
            f"{k} AS (SELECT s, r, (c + 15) // 16 AS c, CASE WHEN c = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h FROM {i})",
        ]

    def fold(k: str, before: str, i: str, s: str, r: str, power: int) -> str:
        at = f"CAST(({r} // {16**power}) % 16 AS BIGINT)"
        left, right = f"array_to_string(hs[1:{at}], '')", f"array_to_string(hs[{at} + 2:], '')"
        return (
            f"{k} AS (SELECT {before}.* EXCLUDE (node, proof), CASE WHEN {i}.c = 1 THEN node ELSE sha256({left} || node || {right}) END AS node, "
            f"proof || CASE WHEN {i}.c = 1 THEN '' ELSE {left} || {right} END AS proof "
            f"FROM {before} JOIN {i} ON {i}.s IS NOT DISTINCT FROM {s} AND {i}.r = {r} // {16 ** (power + 1)})"
        )

    crc = (
        "xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
        "lambda ch: [CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) "
        "WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295)"
    )
    parts = [
        f"d AS (SELECT doc_id, source, {leaf('text')} AS leaf, {leaf(LOW_TEXT)} AS low, coalesce({crc} % 5 = 0, false) AS hit FROM documents)",
        "n0 AS (SELECT source AS s, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY source) AS c, leaf AS h, doc_id, CASE WHEN hit THEN low ELSE leaf END AS start FROM d)",
    ]
    for k in range(inner):
        parts += level(f"n{k + 1}", "s", f"n{k}", f"i{k}")
    parts.append(f"m0 AS (SELECT 0 AS s, row_number() OVER (ORDER BY s NULLS FIRST) - 1 AS r, count(*) OVER () AS c, h, s AS name FROM n{inner})")
    for k in range(outer):
        parts += level(f"m{k + 1}", "s", f"m{k}", f"j{k}")
    parts.append("f0 AS (SELECT n0.*, m0.h AS subroot, m0.r AS place, n0.start AS node, '' AS proof FROM n0 JOIN m0 ON m0.name IS NOT DISTINCT FROM n0.s)")
    for k in range(inner):
        parts.append(fold(f"f{k + 1}", f"f{k}", f"i{k}", f"f{k}.s", f"f{k}.r", k))
    for k in range(outer):
        parts.append(fold(f"f{inner + k + 1}", f"f{inner + k}", f"j{k}", "0", "place", k))
    last = f"f{inner + outer}"
    return (
        "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, {last}.h AS leaf, subroot, m{outer}.h AS root, sha256(proof) AS proof_sha256, "
        f"node AS folded_root, node = m{outer}.h AS verified FROM {last}, m{outer}"
    )


@query("op12_merkle", merkle_sql())
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Merkle manifest of all documents and the proof of every leaf."""
    return merkle.audit(table(spark, sf_dir, "documents"))


FILTER_SQL = """
WITH RECURSIVE d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
l AS (SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN w.doc_id > first THEN 16 ELSE 0 END AS mask
  FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY ALL),
f(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
p(prefix, applied, letter, bit) AS (SELECT '', 0, '', 0
  UNION ALL SELECT p.prefix || f.letter, p.applied + p.bit, f.letter, f.bit FROM p JOIN f ON (p.applied + p.bit) & f.bit = 0),
s AS (SELECT part, prefix, letter,
    coalesce(sum(n) FILTER (mask & (applied + bit) = 0), 0) AS kept,
    coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & applied = 0), 0) AS removed,
    coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & applied <> 0), 0) AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
    coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & applied = 0), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (mask & bit <> 0 AND mask & applied = 0), 0) AS toxic_lost
  FROM c, p WHERE prefix <> '' GROUP BY ALL),
o AS (SELECT s.*, q.prefix AS filter_order, length(s.prefix) AS step FROM s JOIN p q ON length(q.prefix) = 5 AND starts_with(q.prefix, s.prefix))
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM o
"""


@query("op13_filteraudit", FILTER_SQL)
def op13_filteraudit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from all documents in each of their orders."""
    return filteraudit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

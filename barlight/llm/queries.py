"""The registered queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlight.llm import clusters, decontaminate, language, licenses, line_dedup, merkle, ngram_join, pieces, pii, sharding, suffix_dedup, token_counts, topk
from barlight.llm.common import read

#: Folder of the public vocabulary files; their module names it where it is installed.
WORD_BPE = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


@query("op1_sharding")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sharding.kd_shards(read(spark, sf_dir, "documents"), shards=40)
    return s.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op2_pii")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(read(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] < len(pii.KINDS))
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = {i})) as long)").alias(f"n_{k.name}") for i, k in enumerate(pii.ALL)]
    base_counts, more_counts = counts[: len(pii.KINDS)], counts[len(pii.KINDS) :]
    scores = F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores")
    return found.select("doc_id", *base_counts, F.sha2(pii.spell(base), 256).alias("base_sha256"), pii.spell(F.col("spans")).alias("spans"), *more_counts, scores)


@query(
    "op3_line_dedup",
    """WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
    u AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
    x AS (SELECT *, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i) AS c FROM u),
    g AS (SELECT s.doc_id, s.i AS s, min(e.i) AS e FROM x s JOIN x e ON e.doc_id = s.doc_id AND e.i >= s.i AND e.i < s.i + 40 AND e.c - s.c + length(s.line) + 1 >= 40 GROUP BY 1, 2
      UNION SELECT e.doc_id, max(s.i), e.i FROM x s JOIN x e ON e.doc_id = s.doc_id AND s.i <= e.i AND s.i > e.i - 40 AND e.c - s.c + length(s.line) + 1 >= 40 GROUP BY 1, 3),
    t AS (SELECT doc_id, s, e, row_number() OVER (PARTITION BY array_to_string(ls[s : e], chr(10)) ORDER BY doc_id, s) AS k FROM g JOIN d USING (doc_id)),
    gone AS (SELECT DISTINCT doc_id, unnest(generate_series(s, e)) AS i FROM t WHERE k > 1),
    m AS (SELECT u.doc_id, count(gone.i) AS n_removed, coalesce(string_agg(CASE WHEN gone.i IS NULL THEN line END, chr(10) ORDER BY u.i), '') AS text, count(*) AS n_lines
      FROM u LEFT JOIN gone ON gone.doc_id = u.doc_id AND gone.i = u.i GROUP BY 1)
    SELECT doc_id, n_lines, n_removed, text FROM m""",
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(read(spark, sf_dir, "documents", "doc_id", "text"))
    return kept.select("row.doc_id", "n_lines", "n_removed", "text")


@query(
    "op4_ngram_join",
    r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM w WHERE len(w) > 0) x),
    n AS (SELECT w.doc_id, count(s.s) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY 1),
    p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
    e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
    both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
    r AS (SELECT doc_id, doc_id AS c FROM n UNION SELECT b, c FROM r JOIN both_ways ON a = r.doc_id)
    SELECT n.doc_id, n.n AS n_shingles, (SELECT min(c) FROM r WHERE r.doc_id = n.doc_id) AS component_id,
      (SELECT count(*) FROM both_ways WHERE a = n.doc_id) AS n_links FROM n""",
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.join_ngrams(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id", "n_links")


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read(spark, sf_dir, "documents", "doc_id", "text", "lang"))


@query("op6_decontamination")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return found.drop("uid")


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(read(spark, sf_dir, "documents", "doc_id", "text"), vocabulary(WORD_BPE))
    return counted.select("*", (F.col("n_tokens") > 2048).alias("over_limit"))


@query("op8_sentencepiece")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(read(spark, sf_dir, "documents", "doc_id", "text"), vocabulary(PIECES), with_ids=False)


@query(
    "op9_top_k",
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, x.vec_id, CAST(list_sum(list_transform(list_zip(q.v, x.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q JOIN v x ON q.vec_id % 100 = 0 AND x.vec_id <> q.vec_id),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 100 == 0, k=10)


@query(
    "op10_suffix_dedup",
    """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
    w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(generate_series(0, n - 50)) AS i FROM d WHERE n >= 50) x),
    f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY 1),
    g AS (SELECT doc_id, i, CASE WHEN i > lag(i) OVER o + 50 THEN 1 ELSE 0 END AS new FROM w JOIN f USING (s) WHERE doc_id > first WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    r AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM g) t GROUP BY doc_id, k),
    k AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS low, a AS high FROM r
      UNION ALL SELECT d.doc_id, coalesce(max(b), 0), any_value(n) FROM d LEFT JOIN r USING (doc_id) GROUP BY 1),
    t AS (SELECT doc_id, string_agg(substr(h, 2 * low + 1, 2 * (high - low)), '' ORDER BY low, high) AS kept FROM k JOIN d USING (doc_id) GROUP BY 1),
    c AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM r GROUP BY 1)
    SELECT d.doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
    FROM d JOIN t USING (doc_id) LEFT JOIN c USING (doc_id)""",
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_bytes(read(spark, sf_dir, "documents", "doc_id", "text"))


def _clusters_sql(k: int = 8, rounds: int = 10) -> str:
    """The rounds one below the other: (vec_id, c, d) of each assignment, then the centroids (c, v) after it."""
    far = "list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    out = """WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
      WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS INTEGER) AS c, v FROM v ORDER BY sha256('3:' || vec_id) LIMIT %d)""" % k
    for r in range(rounds + 1):
        out += f""",
    a{r} AS MATERIALIZED (SELECT vec_id, v, c, d FROM (SELECT vec_id, v.v, c, CAST({far} AS BIGINT) AS d FROM v CROSS JOIN c{r} c) x
      QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)"""
        if r < rounds:
            out += f""",
    c{r + 1} AS MATERIALIZED (SELECT c, coalesce(n.v, o.v) AS v FROM c{r} o LEFT JOIN (
      SELECT c, list((s - ((s % m) + m) % m) // m ORDER BY i) AS v FROM (
        SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS m FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) u GROUP BY 1, 2) t GROUP BY 1) n USING (c))"""
    return out + f"""
    SELECT vec_id, a.c AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
      sha256(array_to_string(c.v, ',')) AS centroid_sha256 FROM a{rounds} a JOIN c{rounds} c USING (c)"""


@query("op11_centroid_clusters", _clusters_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.clusters(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def _licenses_sql() -> str:
    """Base places by looking ahead; blocks against templates by counting the words that they share, without any filter."""
    values = ", ".join(f"({n}, '{t.label}', {t.step}, {t.needed}, {len(t.tokens)}, '{w}')" for n, t in enumerate(licenses.templates()) for w in t.tokens)
    hit = " OR ".join("(" + " AND ".join(f"w{k} = '{w}'" for k, w in enumerate(p.split())) + f" AND label = '{x}')" for p, x in licenses.PHRASES)
    phrases = ", ".join(f"('{x}')" for _, x in licenses.PHRASES)
    return rf"""WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    u AS (SELECT doc_id, unnest(w) AS w0, generate_subscripts(w, 1) - 1 AS i FROM w),
    l AS (SELECT *, lead(w0, 1) OVER o AS w1, lead(w0, 2) OVER o AS w2 FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    b AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS base FROM l, (VALUES {phrases}) p(label) WHERE {hit} GROUP BY 1),
    t(template, label, step, needed, size, word) AS (VALUES {values}),
    m AS (SELECT doc_id, template, label, size, count(DISTINCT word) AS k FROM u JOIN t ON word = w0, (VALUES (0), (1)) o(back) WHERE i // step >= back
      GROUP BY doc_id, template, label, size, needed, i // step - back HAVING count(DISTINCT word) >= needed),
    f AS (SELECT doc_id, list(DISTINCT label) AS more, max(CAST(k AS DOUBLE) / size) AS share FROM m GROUP BY 1)
    SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
      coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
      coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(more, [])))), ','), '') AS labels,
      CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END AS score
    FROM w LEFT JOIN b USING (doc_id) LEFT JOIN f USING (doc_id)"""


@query("op12_license_scan", _licenses_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents", "doc_id", "text"))


def _manifest_sql() -> str:
    """Every node of every tree, every leaf beside all its siblings."""
    cell = lambda c: f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || {c}, '-')"
    leaf = lambda n: "sha256(" + " || ".join(cell(c) for c in ("doc_id", "source", "lang", n, "text")) + ")"
    bit = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    crc = f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))), lambda c, b: {bit}), 4294967295)"
    return f"""WITH RECURSIVE l AS (SELECT doc_id, coalesce('=' || lang, '') AS t, {leaf('n_chars')} AS leaf,
      CASE WHEN n_chars IS NOT NULL AND {crc} % 7 = 0 THEN {leaf('(n_chars + 1)')} END AS other FROM documents),
    p AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY t) AS n FROM l),
    nodes(t, k, i, n, h) AS (SELECT t, 0, i, n, leaf FROM p UNION ALL
      SELECT t, k + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY t, k, i // 2, n),
    subs AS (SELECT t, h, row_number() OVER (ORDER BY t) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
    upper_(k, i, n, h) AS (SELECT 0, i, n, h FROM subs UNION ALL
      SELECT k + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM upper_ WHERE n > 1 GROUP BY k, i // 2, n),
    seen AS (SELECT p.t, p.i, v.k AS step, (p.i >> v.k) % 2 AS side, s.h FROM p JOIN (SELECT DISTINCT t, k FROM nodes WHERE n > 1) v USING (t)
        LEFT JOIN nodes s ON s.t = p.t AND s.k = v.k AND s.i = xor(p.i >> v.k, 1)
      UNION ALL SELECT p.t, p.i, 1000 + v.k, (u.i >> v.k) % 2, s.h FROM p JOIN subs u USING (t) CROSS JOIN (SELECT DISTINCT k FROM upper_ WHERE n > 1) v
        LEFT JOIN upper_ s ON s.k = v.k AND s.i = xor(u.i >> v.k, 1)),
    path AS (SELECT t, i, sha256(coalesce(string_agg(h, '' ORDER BY step), '')) AS proof_sha256, list(side || coalesce(h, '') ORDER BY step) AS sides FROM seen GROUP BY 1, 2),
    f AS (SELECT doc_id, leaf, u.h AS subroot, (SELECT h FROM upper_ WHERE n = 1) AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
      list_reduce(list_prepend(coalesce(other, leaf), coalesce(sides, [])), lambda a, b: sha256(CASE WHEN b[1] = '1' THEN b[2:] || a ELSE a || b[2:] END)) AS folded_root
      FROM p JOIN subs u USING (t) LEFT JOIN path ON path.t = p.t AND path.i = p.i)
    SELECT *, folded_root = root AS verified FROM f"""


@query("op13_merkle_manifest", _manifest_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read(spark, sf_dir, "documents"))

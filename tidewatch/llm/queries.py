"""The operators with production parameters over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import bytededup, clusters, decontaminate, extraction, host_rules, mixing, neighbours, quality, ranking, secrets, sharding, simhash, url_filter
from tidewatch.llm.common import cut_lineage, read_table, scratch_path, ship, words
from tidewatch.llm.components import components

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


# 6 -------------------------------------------------------------------------------------------------


@query
def op6_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document through a fresh ledger."""
    ledger = scratch_path(spark, "secret-ledger")
    rows = secrets.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"), ledger)
    found = secrets.findings(rows, ledger)
    every = secrets.joined_spans(secrets.BASE_RULES)
    counts = [F.size(r.kind).cast("long").alias(f"n_{r.kind}") for r in secrets.BASE_RULES]
    return found.select("doc_id", *counts, F.sha2(every, 256).alias("base_sha256"), every.alias("spans"))


_ASSIGN = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?"""
_VALUE = "[A-Za-z0-9+/_.=-]+"


def _pieces(kind: str, rank: int, pattern: str, judged: str, least: int) -> str:
    return f"""
    SELECT k, {rank} AS r, '{kind}' AS kind, s, e FROM (
        SELECT k,
               list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS s,
               list_sum(list_transform(gaps[1:i], lambda x: length(x))) + list_sum(list_transform(hits[1:i], lambda x: length(x))) AS e,
               length(judged[i]) AS n
        FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM (
            SELECT k, string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}') AS hits, {judged} AS judged FROM d)))
    WHERE n >= {least}"""


ORACLES["op6_secret_ledger"] = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({_pieces("assign", 0, _ASSIGN + _VALUE, f"regexp_extract_all(t, '({_ASSIGN})({_VALUE})', 2)", 6)}
    UNION ALL {_pieces("access", 1, "AKIA[A-Z0-9]+", "regexp_extract_all(t, 'AKIA[A-Z0-9]+')", 20)}
    UNION ALL {_pieces("hex", 2, "[0-9a-f]{24,}", "regexp_extract_all(t, '[0-9a-f]{24,}')", 24)}),
by_row AS (SELECT k, count(*) FILTER (r = 0) AS n0, count(*) FILTER (r = 1) AS n1, count(*) FILTER (r = 2) AS n2,
                  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, r) AS spans FROM found GROUP BY k)
SELECT doc_id, coalesce(n0, 0)::BIGINT AS n_assign, coalesce(n1, 0)::BIGINT AS n_access, coalesce(n2, 0)::BIGINT AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN by_row USING (k)"""

# 7 -------------------------------------------------------------------------------------------------

SHARDS = 40


def shard_key() -> list[Column]:
    """Document, checksum and size: tells apart documents that share an id."""
    return [F.col("doc_id"), F.col("text_crc32"), F.col("size")]


@query
def op7_hash_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents on a ring of 40 shards with equal row counts."""
    rows = read_table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
    )
    return sharding.assign(rows, shard_key(), SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


# 9 -------------------------------------------------------------------------------------------------

#: Fixed by the contract.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


@query
def op9_url_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the longest rule for every page; allowed without one."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, url_filter.rule_table(spark, URL_RULES))


ORACLES["op9_url_sweep"] = f"""
WITH p AS (SELECT row_number() OVER () AS k, page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(rule_host, rule_path, verdict) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
hits AS (SELECT k, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule, max_by(verdict, length(rule_host || rule_path)) AS verdict
    FROM p JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY k)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN hits USING (k)"""

# 10 ------------------------------------------------------------------------------------------------


@query
def op10_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document when 150 % of all words are dealt to sources by weight."""
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", "source", words().alias("words"), F.crc32(F.coalesce("text", F.lit(""))).alias("crc")
    )
    mixed = mixing.copies(docs, F.col("words"), [F.col("doc_id"), F.col("crc"), F.col("words")])
    return mixed.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )

# 8 -------------------------------------------------------------------------------------------------


@query
def op8_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of 3-word shingles and component at two bits or fewer, for every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    prints = cut_lineage(simhash.with_fingerprints(docs, 3), "fingerprints")
    roots = components(simhash.links_within(prints))
    own = prints.groupBy("fp0").agg(F.min("doc_id").alias("least"))
    placed = own.join(roots.withColumnRenamed("node", "fp0"), "fp0", "left").withColumn("root", F.coalesce("root", "fp0"))
    reached = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(reached, "root").select("fp0", "component_id")
    return prints.join(named, "fp0").select("doc_id", F.lpad(F.lower(F.hex("fp0")), 16, "0").alias("fingerprint"), "component_id")

# 3 -------------------------------------------------------------------------------------------------


@query
def op3_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by trees that were fitted on labels outside the held-out third."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    forest = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.with_score(docs, forest).select(
        "doc_id",
        quality.is_held_out(F.col("doc_id")).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.5).cast("int").alias("predicted"),
    )


# 4 -------------------------------------------------------------------------------------------------


@query
def op4_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extraction.with_text(pages).select("page_id", "url", "text", "n_chars")

# 5 -------------------------------------------------------------------------------------------------


@query
def op5_bucket_pointers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeated strings of 200 bytes cover in every document."""
    return bytededup.removed_bytes(read_table(spark, sf_dir, "documents").select("doc_id", "text"))

# 2 -------------------------------------------------------------------------------------------------


@query
def op2_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contaminated documents with the benchmark items they hold."""
    docs = decontaminate.with_digest(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    items = decontaminate.with_digest(read_table(spark, sf_dir, "benchmark").select("item_id", "text"))
    found = decontaminate.contaminated(docs, items)
    held = found.join(items.select("item_id", F.col("digest").alias("item")), "item").drop("item")
    return docs.select("doc_id", "digest").join(held, "digest").select("doc_id", "item_id", "n_tokens", "covered", "tiles", "coverage")

# 1 -------------------------------------------------------------------------------------------------


@query
def op1_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest found for every hundredth vector."""
    return neighbours.nearest(read_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)

# 11 ------------------------------------------------------------------------------------------------

CENTROIDS, ROUNDS, COMPONENTS = 8, 10, 64


@query
def op11_bisector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight centroids after ten rounds, and the vectors of each."""
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return clusters.cluster(vectors, "vec_id", "embedding", COMPONENTS, CENTROIDS, ROUNDS)


def _rounds_sql() -> str:
    """Each round: distances to all centroids, the least (ties: smaller number), and floors of the means."""
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (SELECT k, min_by(c, d * 8 + c) AS c, min(d) AS d FROM (
    SELECT k, c, list_sum(list_transform(range(1, {COMPONENTS + 1}), lambda i: (v.p[i] - q.p[i]) * (v.p[i] - q.p[i])))::BIGINT AS d FROM v CROSS JOIN c{r} q) GROUP BY k)""")
        if r < ROUNDS:
            steps.append(f"""
m{r} AS (SELECT c, list(m ORDER BY i) AS p FROM (
    SELECT c, i, (s - ((s % n) + n) % n) // n AS m FROM (
        SELECT a.c, i, sum(v.p[i])::BIGINT AS s, count(*)::BIGINT AS n FROM a{r} a JOIN v USING (k) CROSS JOIN range(1, {COMPONENTS + 1}) t(i) GROUP BY a.c, i)) GROUP BY c),
c{r + 1} AS MATERIALIZED (SELECT q.c, coalesce(m.p, q.p) AS p FROM c{r} q LEFT JOIN m{r} m USING (c))""")
    return ",".join(steps)


ORACLES["op11_bisector_clusters"] = f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS k, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS p
    FROM embeddings WHERE len(embedding) = {COMPONENTS} AND len(list_filter(embedding, lambda x: isfinite(x))) = {COMPONENTS}),
c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY h NULLS LAST, p) - 1)::INTEGER AS c, p FROM (
    SELECT sha256('3:' || vec_id) AS h, p FROM v ORDER BY h NULLS LAST, p LIMIT {CENTROIDS})),{_rounds_sql()}
SELECT vec_id, a.c AS cluster, d AS distance, sum(d) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
    sha256(array_to_string(q.p, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN v USING (k) JOIN c{ROUNDS} q ON a.c = q.c"""

# 12 ------------------------------------------------------------------------------------------------


@query
def op12_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, own failures and the verdict of the host (the source) for every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return host_rules.judge(docs, "source").select("doc_id", *host_rules.NUMBERS[:5], "base_failed", "kept")


def _rate_sql(name: str) -> str:
    """Posterior mean of a host; the mean of all hosts where they differ by no more than chance, or there is one."""
    within = f"({name}_m * (1 - {name}_m))"
    rho = f"((({name}_2 - h * {name}_m * {name}_m) / (h - 1)) / {within} - chance) / (1 - chance)"
    weight = f"greatest(1 / least({rho}, 1) - 1, 0)"
    return f"""CASE WHEN h < 2 OR {within} <= 0 OR chance >= 1 THEN {name}_m WHEN {rho} <= 0 THEN {name}_m
        ELSE ({name} + {name}_m * {weight}) / (documents + {weight}) END"""


_RULE_NAMES = [r.name for r in host_rules.RULES]
ORACLES["op12_host_rules"] = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS k, doc_id, source, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
spots AS (SELECT k, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) > 2),
wins AS (SELECT k, i, count(*) OVER (PARTITION BY k, w[i], w[i + 1], w[i + 2]) AS times FROM spots),
repeats AS (SELECT k, count(DISTINCT spot) AS n_repeat_words FROM (SELECT k, unnest([i, i + 1, i + 2]) AS spot FROM wins WHERE times > 1) GROUP BY k),
lines AS (SELECT k, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT k, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k),
nums AS MATERIALIZED (SELECT k, doc_id, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
    FROM d LEFT JOIN repeats USING (k) LEFT JOIN lines USING (k)),
hosts AS (SELECT source, count(*) AS documents, {", ".join(f"count(*) FILTER ({r.fails}) AS {r.name}" for r in host_rules.RULES)}
    FROM nums WHERE source IS NOT NULL GROUP BY source),
total AS (SELECT count(*) AS h, avg(1.0::DOUBLE / documents) AS chance,
    {", ".join(f"avg({r}::DOUBLE / documents) AS {r}_m, sum(({r}::DOUBLE / documents) ** 2) AS {r}_2" for r in _RULE_NAMES)} FROM hosts),
verdicts AS (SELECT source, greatest({", ".join(_rate_sql(r) for r in _RULE_NAMES)}) >= {host_rules.LIMIT} AS rejected FROM hosts CROSS JOIN total)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT coalesce(rejected, false) AS kept
FROM nums LEFT JOIN verdicts USING (source)"""

# 13 ------------------------------------------------------------------------------------------------


@query
def op13_hybrid_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return ranking.ranked(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), 20)


def _terms_sql(text: str) -> str:
    return f"regexp_extract_all(translate({text}, '{url_filter.UPPER}', '{url_filter.LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


ORACLES["op13_hybrid_ranking"] = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS k, doc_id, {_terms_sql("text")} AS t FROM documents),
size AS MATERIALIZED (SELECT k, doc_id, len(t)::BIGINT AS n FROM d WHERE len(t) > 0),
total AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS l FROM size),
q AS MATERIALIZED (SELECT j, item_id, term, count(*)::BIGINT AS times FROM (
    SELECT j, item_id, unnest({_terms_sql("text")}) AS term FROM (SELECT row_number() OVER () AS j, item_id, text FROM benchmark)) GROUP BY ALL),
tf AS MATERIALIZED (SELECT k, term, count(*)::BIGINT AS tf FROM (SELECT k, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
df AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf CROSS JOIN total GROUP BY term, big_n),
part AS (SELECT k, doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * big_n) // l))) AS c FROM tf JOIN size USING (k) CROSS JOIN total),
score AS (SELECT j, item_id, k, doc_id, sum(times * w * c)::BIGINT AS score FROM q JOIN df USING (term) JOIN part USING (term) GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
    SELECT item_id, doc_id, score, (row_number() OVER (PARTITION BY j ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank FROM score WHERE score > 0)
WHERE rank <= 20"""

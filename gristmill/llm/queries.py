"""The registered queries of this subpackage: ``(spark, sf_dir)`` to the whole result.

``QUERIES`` and ``SQL`` are what the entry module adds. Each query runs its operator with
production parameters over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill import scratch
from gristmill.llm import bpe, decontaminate, hard_negatives, near_vectors, neardup, packing, quality, runs, substrings, suffix_tree, toxicity, urls, vectors, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: str, divisor: int):
    """crc32 of an id as text, modulo ``divisor``: the fold of a row."""
    return F.crc32(F.col(key).cast("string")) % divisor


@query
def op2_token_counts(spark, sf_dir):
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = bpe.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query
def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0)
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs, model).select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op5_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM_WORDS = f"regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

SQL["op5_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_ALNUM_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_ALNUM_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, len(w[s : s + 9]) AS n, array_to_string(w[s : s + 9], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, least(len(w), 1)) + 1)) AS s FROM b)
),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes)
),
m AS (SELECT DISTINCT doc_id, dw.n, s, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM m) GROUP BY doc_id),
it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM m) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""


@query
def op10_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = substrings.remove_repeats(docs)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


_SPACED = "regexp_extract_all({0}, '[^\\x20\\x09-\\x0D]+')"

SQL["op10_substring_dedup"] = f"""
WITH d AS (SELECT doc_id, {_SPACED.format("coalesce(text, '')")} AS w FROM documents),
win AS (
  SELECT doc_id, s, array_to_string(w[s : s + 12], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS s FROM d)
),
late AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY win) AS least FROM win) WHERE least < doc_id
),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS p FROM late),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS body
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@query
def op7_near_duplicates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")


SQL["op7_near_duplicates"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SPACED.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
sh AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[s : s + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS s FROM d)
),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
link AS MATERIALIZED (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS met FROM sh x JOIN sh y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2
  ) JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * met >= 75 * (na.n + nb.n - met)
),
reach AS (
  SELECT doc_id AS a, doc_id AS r FROM d
  UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.r
),
part AS (SELECT a AS doc_id, min(r) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN part USING (doc_id)
"""


@query
def op3_url_filters(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"))


@query
def op6_quality_rules(spark, sf_dir):
    judged = quality.assess(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op9_best_fit_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sized = docs.select("doc_id", "source", packing.word_count(F.col("text")).alias("n_words"), F.xxhash64("text").alias("cluster"), F.monotonically_increasing_id().alias("row"))
    return packing.pack(scratch.materialize(sized, "sizes"), "n_words", row="row")


@query
def op8_lm_scoring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = suffix_tree.scores(docs, remainder("doc_id", 10) != 0)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op1_warc_transactions(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    records = warc.read(spark, warc.write(pages, scratch.folder(spark, "warc")))
    captures = warc.assemble(records)
    payload, announced = F.col("main.payload"), F.regexp_extract("main.http_header", "(?i)content-length: ([0-9]+)", 1)
    full = F.col("main.type") == "response"
    return captures.select(
        warc.field(F.col("metadata"), "key").cast("bigint").alias("page_id"),
        F.when(full, F.octet_length(payload)).otherwise(announced.try_cast("bigint")).cast("bigint").alias("payload_bytes"),
        F.when(full, F.sha1(payload)).otherwise(F.col("main.payload_digest")).alias("payload_digest"),
        F.col("main.type").alias("record_type"),
        warc.field(F.col("metadata"), "refers-to").cast("bigint").alias("refers_to"),
    )


SQL["op1_warc_transactions"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to
FROM m
"""

# The patterns of the line rules, as text.
_TERMINAL = quality.TERMINAL.replace("'", "''")
_BARE = "regexp_replace(y, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g')"
_LINE_PASSES = f"""
  (regexp_matches(b, '{_TERMINAL}')
   OR (regexp_matches(b, '[.,;:!?]') AND len({_SPACED.format("b")}) >= {quality.LONG_LINE}))
  AND length(b) - length(regexp_replace(b, '{quality.NAVIGATION}', '', 'g')) < {quality.MAX_NAVIGATION}
  AND NOT regexp_matches(b, '{quality.BOILERPLATE}')"""

SQL["op6_quality_rules"] = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, {_SPACED.format("coalesce(text, '')")} AS w,
         [y FOR y IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(y, '[^\\x20\\x09-\\x0D]')] AS x
  FROM documents
),
win AS (
  SELECT doc_id, s, array_to_string(w[s : s + 4], ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS s FROM d)
),
often AS (SELECT doc_id, s FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, win) AS n FROM win) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + 5)) AS p FROM often) GROUP BY doc_id),
good AS (
  SELECT doc_id, sum(length(y)) AS n FROM (SELECT doc_id, y, {_BARE} AS b FROM (SELECT doc_id, unnest(x) AS y FROM d))
  WHERE {_LINE_PASSES} GROUP BY doc_id
),
m AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(x) - len(list_distinct(x)) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words, coalesce(good.n, 0) AS good, length(array_to_string(x, '')) AS chars
  FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN good USING (doc_id)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
         AND 100 * good >= {quality.MIN_KEPT_PERCENT} * chars AS kept
FROM m
"""


@query
def op11_periodic_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # One document of ten gets a tail that repeats its first p words.
    n = F.size("w").cast("bigint")
    bent = docs.withColumn("h", F.crc32(F.col("doc_id").cast("string"))).withColumn("g", F.floor(F.col("h") / 10))
    bent = bent.withColumn("w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))))
    bent = bent.withColumn("a", F.when(n > 0, F.col("g") % n))
    bent = bent.withColumn("p", F.expr("1 + (size(w) - a) div (3 + g % 8)"))
    tail = F.expr("array_join(transform(sequence(0, size(w) - 1), i -> w[int(if(i < a, i, a + (i - a) % p))]), ' ')")
    text = F.when(n > 0, tail).otherwise(F.col("text"))
    found = runs.periodic_runs(bent.select("doc_id", text.alias("text")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    # Quotients of whole numbers below 2^26 are equal as doubles only if they are equal.
    ranked = F.transform("runs", lambda r: F.struct((-r["length"] / r["period"]).alias("e"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))
    return found.withColumn("best", F.array_min(ranked)).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text, bit by bit."""
    step = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))"
    codes = f"[CAST(ascii(z) AS BIGINT) FOR z IN string_split({text}, '')]"
    return f"xor(list_reduce(list_concat([4294967295], {codes}), lambda c, b: {step}), 4294967295)"


def _grams(top: int) -> str:
    """Numbers of the grams of 1, 2, 4, ... words that a document has twice or more, and the periods they hint at.

    Inside a run of four periods q, consecutive occurrences of a gram of q to 2q - 1 words are q apart.
    """
    parts = ["g0 AS MATERIALIZED (SELECT doc_id, i, id FROM (SELECT doc_id, i, word AS v, min(i) OVER p AS id, count(*) OVER p AS n FROM tok WINDOW p AS (PARTITION BY doc_id, word)) WHERE n > 1)"]
    for k in range(1, top + 1):
        parts.append(
            f"g{k} AS MATERIALIZED (SELECT doc_id, i, id FROM (SELECT a.doc_id, a.i, min(a.i) OVER p AS id, count(*) OVER p AS n"
            f" FROM g{k - 1} a JOIN g{k - 1} b ON b.doc_id = a.doc_id AND b.i = a.i + {1 << (k - 1)}"
            " WINDOW p AS (PARTITION BY a.doc_id, a.id, b.id)) WHERE n > 1)"
        )
    hints = [
        f"SELECT DISTINCT doc_id, q FROM (SELECT doc_id, i - lag(i) OVER (PARTITION BY doc_id, id ORDER BY i) AS q FROM g{k}) WHERE 2 * q > {1 << k} AND q <= {1 << k}"
        for k in range(top + 1)
    ]
    return ",\n".join([*parts, f"hint AS MATERIALIZED ({' UNION ALL '.join(hints)})"])


#: Grams of up to 2^17 words find the periods of texts of up to 2^19 words.
SQL["op11_periodic_runs"] = f"""
WITH o AS (SELECT doc_id, {_SPACED.format("coalesce(text, '')")} AS w, {_crc32("CAST(doc_id AS VARCHAR)")} AS h FROM documents),
b AS (SELECT *, CAST(len(w) AS BIGINT) AS n, h // 10 AS g FROM o),
c AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a FROM b),
d AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM c),
tok AS MATERIALIZED (
  SELECT doc_id, n, i, w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END] AS word FROM (SELECT *, unnest(range(n)) AS i FROM d)
),
{_grams(17)},
same AS (
  SELECT h.doc_id, h.q, x.i, x.i - row_number() OVER (PARTITION BY h.doc_id, h.q ORDER BY x.i) AS island
  FROM hint h JOIN tok x ON x.doc_id = h.doc_id AND 4 * h.q <= x.n JOIN tok y ON y.doc_id = h.doc_id AND y.i = x.i + h.q AND y.word = x.word
),
run AS MATERIALIZED (
  SELECT doc_id, start, length, min(q) AS period
  FROM (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM same GROUP BY doc_id, q, island)
  WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length
),
best AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) AS place,
         count(*) OVER (PARTITION BY doc_id) AS n_runs FROM run
),
told AS (SELECT doc_id, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS t FROM run GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM run),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM tok ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, CAST(length AS BIGINT) AS length, period,
       CAST(1000 * length // period AS BIGINT) AS exponent_milli,
       sha256(coalesce(told.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM d LEFT JOIN (SELECT * FROM best WHERE place = 1) USING (doc_id) LEFT JOIN told USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query
def op13_near_vectors(spark, sf_dir):
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))


SQL["op13_near_vectors"] = """
WITH RECURSIVE d AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS MATERIALIZED (
  SELECT vec_id, label, v, len(v) AS n FROM d
  WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
),
link AS MATERIALIZED (
  SELECT x.vec_id AS a, y.vec_id AS b FROM u x JOIN u y ON x.label = y.label AND x.n = y.n AND x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.v, y.v) >= 0.98
),
reach AS (
  SELECT vec_id AS a, vec_id AS r FROM d
  UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.r
),
part AS (SELECT a AS vec_id, min(r) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a)
SELECT d.vec_id, coalesce(n_links, 0) AS n_links, component_id, d.vec_id = component_id AS kept
FROM d JOIN part USING (vec_id) LEFT JOIN n USING (vec_id)
"""


@query
def op12_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    vector = F.when(vectors.usable(F.col("embedding")), whole)
    rows = rows.select("vec_id", label.alias("label"), vector.alias("vector"))
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


SQL["op12_hard_negatives"] = """
WITH d AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM d a JOIN d b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS place FROM s WHERE same) WHERE place <= 5),
m AS (
  SELECT p.a, p.b AS p, p.score AS ps, s.b AS n, s.score AS ns, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS rank
  FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
)
SELECT a AS anchor_id, p AS positive_id, CAST(rank AS INTEGER) AS rank, n AS negative_id, ps AS positive_score, ns AS negative_score
FROM m WHERE rank <= 5
"""

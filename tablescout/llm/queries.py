"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablescout.llm import collocations, decontaminate, langid, licenses, linededup, lmscore, mixing, packing, secrets, simhash, topk, toxicity, vectorcodes
from tablescout.llm.common import in_fold


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.dropped_lines(_table(spark, sf_dir, "documents"))
    lines = F.array_join(F.col("dropped").cast("array<string>"), ",")
    return found.select("doc_id", "n_lines", F.size("dropped").cast("bigint").alias("n_dropped"), lines.alias("dropped_lines"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = in_fold(F.col("doc_id"), 4, 2)
    found = langid.identify(docs, langid.fit(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits_per_char", "accepted")


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = in_fold(F.col("doc_id"), 10, 0)
    found = lmscore.score(_table(spark, sf_dir, "documents"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), words=3, max_bits=2)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = in_fold(F.col("doc_id"), 3, 1)
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out)
    found = toxicity.classify(docs, toxicity.fit(docs, labels))
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted", "evidence", "cosines")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir, "documents"))
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
    return found.select("doc_id", text("licenses"), text("sentence_ids"), text("sentence_nos"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window_words=10)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated"
    )


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(_table(spark, sf_dir, "documents"), F.array("source"))
    return found.select("doc_id", "size", F.col("source_sizes")[0].alias("source_size"), F.col("targets")[0].alias("target"), "taken")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = vectorcodes.compress(_table(spark, sf_dir, "embeddings"))
    digest = F.lit(None if books is None else vectorcodes.books_sha256(books)).cast("string")
    return found.select("vec_id", vectorcodes.hex_code(F.col("codes")).alias("code"), "error", "label_error", digest.alias("codebooks_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_language_id": op2_language_id,
    "op3_lm_score": op3_lm_score,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_toxicity": op7_toxicity,
    "op8_secret_scan": op8_secret_scan,
    "op9_license_scan": op9_license_scan,
    "op10_decontaminate": op10_decontaminate,
    "op11_source_mix": op11_source_mix,
    "op12_vector_codes": op12_vector_codes,
    "op13_collocations": op13_collocations,
}


def _topk_sql() -> str:
    return """WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id, c.rid AS cid,
         CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda p: coalesce(p[1] * p[2], 0))), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.rid <> c.rid)
SELECT query_id, CAST(row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id ASC NULLS LAST, cid) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5"""


def _license_sql() -> str:
    quoted = lambda *xs: "(" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + ")"
    known, code = licenses.known_sentences(), licenses.codes()
    values = ", ".join(quoted(s, i, code[i]) for s, i in known.items())
    end = licenses.SENTENCE_END.encode().decode("unicode_escape").replace("\t", "\\t").replace("\r", "\\r").replace("\n", "\\n")
    cases = " ".join(f"WHEN regexp_matches(m, '{p}') THEN '{name}'" for name, p in licenses.rule_patterns())
    return f"""WITH known(sentence, identifier, code) AS (VALUES {values}),
d AS (SELECT DISTINCT doc_id, text, string_split_regex(text, '{end}') AS parts FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, text, unnest(list_transform(parts, lambda x, i: {{'raw': x, 'no': i - 1}})) AS p FROM d),
n AS (SELECT doc_id, text, p.no AS no, regexp_replace(regexp_replace(
        trim(regexp_replace(lower(p.raw), '{licenses.OTHER}', ' ', 'g'), ' '), '{licenses.LEAD_IN}', 'under '), '{licenses.LIST_MARK}', '') AS sentence FROM s),
k AS (SELECT n.*, identifier, code, no - lag(no) OVER (PARTITION BY doc_id, text ORDER BY no) AS step FROM n JOIN known USING (sentence)),
g AS (SELECT doc_id, string_agg(CASE WHEN step > {licenses.MAX_GAP + 1} THEN '|' ELSE '' END || code, '' ORDER BY no) AS codes,
        string_agg(identifier, ',' ORDER BY no) AS sentence_ids, string_agg(CAST(no AS VARCHAR), ',' ORDER BY no) AS sentence_nos
      FROM k GROUP BY doc_id, text)
SELECT doc_id, array_to_string(list_transform(regexp_extract_all(codes, '{licenses.rule_pattern()}'), lambda m: CASE {cases} END), ',') AS licenses,
       sentence_ids, sentence_nos
FROM g WHERE len(regexp_extract_all(codes, '{licenses.rule_pattern()}')) > 0"""


def _decontaminate_sql() -> str:
    words = (
        "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
        " '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    )
    return f"""WITH b AS (SELECT item_id, {words} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n,
         unnest(list_transform(range(1, len(w) - least(10, len(w)) + 2), lambda i: array_to_string(w[i:i + least(10, len(w)) - 1], ' '))) AS win
       FROM b WHERE len(w) > 0),
d AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS w FROM documents),
dw AS (SELECT rid, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: {{'i': i, 'win': array_to_string(w[i:i + n - 1], ' ')}})) AS x
       FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n),
h AS (SELECT rid, x.i AS i, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND x.win = bw.win),
p AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS q FROM h) GROUP BY rid),
t AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
      FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM h WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (rid) LEFT JOIN t USING (rid)"""


def _vector_codes_sql() -> str:
    """Each round is three tables: nearest entries, sums, new codebook."""
    distance = "list_sum(list_transform(list_zip(p.x, c.x), lambda q: (q[1] - q[2]) * (q[1] - q[2])))"
    tables = []
    for i in range(vectorcodes.ROUNDS + 1):
        tables.append(f"""a{i} AS MATERIALIZED (SELECT p.rid, p.part, min(CAST({distance} AS BIGINT) * 256 + c.entry) AS m FROM p JOIN c{i} c ON p.part = c.part GROUP BY ALL)""")
        if i < vectorcodes.ROUNDS:
            tables.append(f"""s{i} AS (SELECT part, entry, i, sum(x[i]) AS s, count(*) AS n
  FROM (SELECT a.part, a.m % 256 AS entry, p.x, unnest(range(1, len(p.x) + 1)) AS i FROM a{i} a JOIN p USING (rid, part)) GROUP BY ALL),
c{i + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(u.x, c.x) AS x FROM c{i} c LEFT JOIN (
  SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM s{i} GROUP BY ALL) u USING (part, entry))""")
    last = vectorcodes.ROUNDS
    return f"""WITH v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, e) AS rid, * FROM v),
p AS MATERIALIZED (SELECT rid, part, e[part * (len(e) // 4) + 1 : (part + 1) * (len(e) // 4)] AS x FROM k, range(4) r(part)),
c0 AS (SELECT part, rid - 1 AS entry, x FROM p WHERE rid <= 256),
{", ".join(tables)},
r AS (SELECT rid, string_agg(lower(lpad(to_hex(m % 256), 2, '0')), '' ORDER BY part) AS code, CAST(sum(m // 256) AS BIGINT) AS error FROM a{last} GROUP BY rid),
h AS (SELECT sha256(string_agg(CAST(x[i] AS VARCHAR), ',' ORDER BY part, entry, i)) AS digest FROM (SELECT *, unnest(range(1, len(x) + 1)) AS i FROM c{last}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256
FROM k JOIN r USING (rid), h"""


def _collocations_sql() -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""WITH w AS MATERIALIZED (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
  FROM (SELECT lang, unnest(string_split_regex({lower}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
t AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS MATERIALIZED (
  SELECT lang, k, phrase, count(*) AS a FROM (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM w, range(1, 6) s(k) WHERE len(w) >= k) GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, phrase, k, a, string_split(phrase, ' ') AS p FROM g WHERE k > 1),
cuts AS (SELECT lang, phrase, k, a, p, unnest(range(1, k)) AS cut FROM c),
scored AS (
  SELECT c.lang, c.phrase, c.k, c.a, f.a AS l, s.a AS r, n, cut, (1000 * c.a::HUGEINT * n) // (f.a::HUGEINT * s.a) AS score
  FROM cuts c JOIN g f ON f.lang = c.lang AND f.phrase = array_to_string(p[1:cut], ' ')
  JOIN g s ON s.lang = c.lang AND s.phrase = array_to_string(p[cut + 1:], ' ') JOIN t ON t.lang = c.lang
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, cut) = 1),
longer AS (
  SELECT DISTINCT lang, a, unnest(list_transform(list_filter(flatten(list_transform(range(1, k + 1), lambda i: list_transform(range(i + 1, k + 1), lambda j: [i, j]))),
    lambda x: x[2] - x[1] + 1 < k), lambda x: array_to_string(p[x[1]:x[2]], ' '))) AS phrase FROM c)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM scored s WHERE NOT EXISTS (SELECT 1 FROM longer o WHERE o.lang = s.lang AND o.phrase = s.phrase AND o.a >= s.a) QUALIFY rank <= 2000"""


ORACLE_SQL: dict[str, str] = {
    "op4_exact_top_k": _topk_sql(),
    "op9_license_scan": _license_sql(),
    "op10_decontaminate": _decontaminate_sql(),
    "op12_vector_codes": _vector_codes_sql(),
    "op13_collocations": _collocations_sql(),
}

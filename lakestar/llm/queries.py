"""Registered queries of this subpackage: one for each operator, on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bloom_lm, collocations, decontaminate, embed_dedup, html_extract, jaccard_join, language_id, lexical_search,
               mixing, pseudonyms, secret_scan, sharding, token_files)

SHARDS = 40
END_ID = 1
PSEUDONYM_KEY = "registered-query"  # a deployment passes a secret of its own


def tokenizer_path(name: str) -> str:
    """A public vocabulary file; its folder comes with the ``public_tokenizers`` package."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def token_estimate() -> F.Column:
    """Tokens of a text without encoding it: a quarter of its bytes, and an end mark."""
    return F.ceil(F.coalesce(F.octet_length("text"), F.lit(0)) / 4) + 1


def domain() -> F.Column:
    """The domain of a source: its number's block of five; ``other`` without a number."""
    number = F.regexp_extract("source", r"^src([0-9]{1,9})$", 1)
    return F.when(number != "", F.concat(F.lit("domain"), F.floor(number.cast("int") / 5).cast("string"))).otherwise(F.lit("other"))


#: Target weights of the mixture by path: (domain, language, source).
MIX_WEIGHTS = {("domain0",): 3.0, ("domain1",): 2.0, ("domain2",): 2.0, ("domain3",): 2.0}
LANG_WEIGHTS = {"en": 4.0, "de": 3.0, "fr": 3.0, "es": 3.0}
MIX_WEIGHTS |= {(f"domain{d}", x): w for d in range(4) for x, w in LANG_WEIGHTS.items()}


def mixture(docs: DataFrame, *, fraction: float, epochs: int) -> DataFrame:
    return mixing.mix(docs, {"domain": domain(), "lang": F.col("lang"), "source": F.col("source")},
                      tokens=token_estimate(), fraction=fraction, weights=MIX_WEIGHTS, epochs=epochs,
                      salt=F.crc32(F.coalesce("text", F.lit("")).cast("binary")))


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digests(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict_languages(table(spark, sf_dir, "documents"),
                                         vocabulary=tokenizer_path("piece_bpe_32k.model"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op5_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pseudonyms.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PSEUDONYM_KEY)

    def count(kind):
        return F.size(F.filter("pii_found", lambda x: x["kind"] == kind)).alias(f"n_{kind}")

    return done.select("doc_id", "text", *[count(k) for k in pseudonyms.KINDS])


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each epoch that a document is taken in."""
    chosen = mixture(table(spark, sf_dir, "documents"), fraction=0.5, epochs=2)
    return chosen.select("doc_id", domain().alias("domain"), "lang", "source", F.col("_epoch").alias("epoch"),
                         F.col("_tokens").alias("n_tokens"), F.floor("_budget").cast("long").alias("leaf_budget"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digests(table(spark, sf_dir, "documents"),
                                     tokenizer=tokenizer_path("word_bpe_49k.json"), end_id=END_ID)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), SHARDS)


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.score_documents(table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_embedding_near_dedup, op2_secret_scan, op3_language_id, op4_html_extraction, op5_pii_pseudonyms,
        op6_decontamination, op7_mixing, op8_token_files, op9_jaccard_join, op10_sharding, op11_lm_scoring,
        op12_lexical_search, op13_collocations)}


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _terms(column: str) -> str:
    return f"regexp_extract_all(translate(COALESCE({column}, ''), '{UPPER}', '{LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"


SEARCH_SQL = f"""
WITH doc AS (SELECT ROW_NUMBER() OVER () AS rid, doc_id, {_terms('text')} AS ws FROM documents),
stat AS (SELECT COUNT(*) AS docs, CAST(SUM(len(ws)) AS BIGINT) AS terms FROM doc WHERE len(ws) > 0),
item AS (SELECT DISTINCT item_id, UNNEST({_terms('text')}) AS t FROM benchmark),
tf AS (SELECT rid, t, COUNT(*) AS tf FROM (SELECT rid, UNNEST(ws) AS t FROM doc)
       WHERE t IN (SELECT t FROM item) GROUP BY rid, t),
weight AS (SELECT t, CAST(floor(1000 * ln((2.0 * docs + 2) / (2 * COUNT(*) + 1))) AS BIGINT) AS w
           FROM tf, stat GROUP BY t, docs),
size AS (SELECT rid, doc_id, 100 - 50 + (50 * len(ws) * docs) // terms AS m FROM doc, stat WHERE len(ws) > 0),
scored AS (
  SELECT i.item_id, s.rid, s.doc_id, CAST(SUM(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM item i JOIN tf USING (t) JOIN weight USING (t) JOIN size s ON s.rid = tf.rid
  GROUP BY i.item_id, s.rid, s.doc_id),
ranked AS (SELECT item_id, CAST(ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
                  doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50"""

PHRASE_SQL = f"""
WITH piece AS (
  SELECT COALESCE(lang, 'und') AS lang, UNNEST(regexp_split_to_array(translate(COALESCE(text, ''), '{UPPER}', '{LOWER}'),
         '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
ws AS (SELECT lang, regexp_extract_all(piece, '[^ \x09]+') AS ws FROM piece),
total AS (SELECT lang, CAST(SUM(len(ws)) AS BIGINT) AS n FROM ws GROUP BY lang),
gram AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, ws, k, UNNEST(range(1, len(ws) - k + 2)) AS i
        FROM ws, (SELECT UNNEST(range(1, 6)) AS k) WHERE len(ws) >= k)),
freq AS (SELECT lang, k, phrase, COUNT(*) AS a FROM gram GROUP BY lang, k, phrase HAVING COUNT(*) >= 100),
kept AS (
  SELECT * FROM freq x WHERE k > 1 AND NOT EXISTS (
    SELECT 1 FROM freq y WHERE y.lang = x.lang AND y.k > x.k AND 100 * y.a >= 100 * x.a
      AND contains(' ' || y.phrase || ' ', ' ' || x.phrase || ' '))),
cut AS (
  SELECT lang, phrase, a, c, array_to_string(w[1:c], ' ') AS head, array_to_string(w[c + 1:k], ' ') AS tail
  FROM (SELECT lang, phrase, a, k, string_split(phrase, ' ') AS w, UNNEST(range(1, k)) AS c FROM kept)),
scored AS (
  SELECT cut.lang, cut.phrase, cut.a, c, h.a AS l, t.a AS r, n,
         CAST((CAST(1000 AS HUGEINT) * cut.a * n) // (CAST(h.a AS HUGEINT) * t.a) AS BIGINT) AS score
  FROM cut JOIN freq h ON h.lang = cut.lang AND h.phrase = head JOIN freq t ON t.lang = cut.lang AND t.phrase = tail
  JOIN total ON total.lang = cut.lang),
best AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS place FROM scored),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best WHERE place = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000"""

# Links of all pairs, then everything reachable from each row: brute force, for small tables.
EMBEDDING_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
         WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y),
root AS (SELECT x, MIN(y) AS component_id FROM reach GROUP BY x),
degree AS (SELECT x, COUNT(*) AS n FROM link GROUP BY x)
SELECT vec_id, COALESCE(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN root ON root.x = vec_id LEFT JOIN degree ON degree.x = vec_id"""

JACCARD_SQL = f"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), '{UPPER}', '{LOWER}'), '[^ \x09-\x0D]+') AS ws FROM documents),
gram AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, UNNEST(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM doc WHERE len(ws) > 0)),
size AS (SELECT doc_id, COUNT(*) AS n FROM gram GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS c FROM gram a JOIN gram b ON a.g = b.g AND a.doc_id <> b.doc_id
           GROUP BY a.doc_id, b.doc_id),
link AS (SELECT x, y FROM common JOIN size a ON a.doc_id = x JOIN size b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y),
root AS (SELECT x, MIN(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, COALESCE(n, 0) AS n_shingles, component_id
FROM documents d JOIN root ON root.x = d.doc_id LEFT JOIN size USING (doc_id)"""

# DuckDB has no crc32: its table of 256 bytes by rule, then a fold over a text's bytes.
CRC_SQL = """
crc_table AS (SELECT list(v ORDER BY i) AS t FROM (
  SELECT i, list_reduce([i] || range(8), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
  FROM range(256) x(i))),
byte AS (SELECT *, encode(COALESCE(text, '')) AS bytes FROM documents),
crc AS (SELECT * EXCLUDE (bytes, t), octet_length(bytes) AS n_bytes, xor(list_reduce([4294967295] || list_transform(
    range(octet_length(bytes)), lambda i: CAST('0x' || hex(bytes[i + 1:i + 1]) AS BIGINT)),
    lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)])), 4294967295) AS crc
  FROM byte, crc_table)"""


def _seeded(seed: int, *columns: str) -> str:
    return f"CAST('0x' || left(md5(concat_ws(':', {', '.join([str(seed), *columns])})), 8) AS BIGINT)"


def _level(name: str, above: str, depth: int) -> str:
    """Budgets of the nodes ``depth`` levels deep from those of the nodes above: children in the order
    of how soon they are full, each is full if its share of what is left then reaches its cap."""
    path = ", ".join(f"k{i}" for i in range(1, depth + 1))
    parent = ", ".join(f"k{i}" for i in range(1, depth)) or "1"
    using = f"JOIN {above} USING ({parent})" if depth > 1 else f"CROSS JOIN {above}"
    weight = {1: "CASE k1 WHEN 'domain0' THEN 3.0 WHEN 'domain1' THEN 2.0 WHEN 'domain2' THEN 2.0 WHEN 'domain3' THEN 2.0 ELSE 1.0 END",
              2: "CASE WHEN k1 NOT IN ('domain0', 'domain1', 'domain2', 'domain3') THEN 1.0 WHEN k2 = 'ven' THEN 4.0"
                 " WHEN k2 IN ('vde', 'vfr', 'ves') THEN 3.0 ELSE 1.0 END", 3: "1.0"}[depth]
    return f"""
{name}_child AS (SELECT {path}, CAST({weight} AS DOUBLE) AS w, CAST(SUM(2 * t) AS DOUBLE) AS cap FROM leaf GROUP BY {path}),
{name}_left AS (SELECT {name}_child.*, budget AS b,
    budget - COALESCE(SUM(cap) OVER (PARTITION BY {parent} ORDER BY cap / w, k{depth} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_,
    SUM(w) OVER (PARTITION BY {parent} ORDER BY cap / w, k{depth} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM {name}_child {using}),
{name} AS (SELECT {path}, CASE WHEN left_ * w >= cap * rest THEN cap ELSE
    w * ((b - COALESCE(SUM(cap) FILTER (left_ * w >= cap * rest) OVER (PARTITION BY {parent}), 0))
         / SUM(w) FILTER (left_ * w < cap * rest) OVER (PARTITION BY {parent})) END AS budget
  FROM {name}_left)"""


MIX_SQL = f"""
WITH {CRC_SQL},
number AS (SELECT *, regexp_extract(source, '^src([0-9]{{1,9}})$', 1) AS num FROM crc),
doc AS (SELECT *, CASE WHEN num <> '' THEN 'domain' || CAST(CAST(num AS INTEGER) // 5 AS VARCHAR) ELSE 'other' END AS k1,
    COALESCE('v' || lang, 'n') AS k2, COALESCE('v' || source, 'n') AS k3, (n_bytes + 3) // 4 + 1 AS tokens FROM number),
leaf AS (SELECT k1, k2, k3, SUM(tokens) AS t FROM doc GROUP BY k1, k2, k3),
root AS (SELECT 0.5 * SUM(t) * 2 AS budget FROM leaf), {_level('l1', 'root', 1)}, {_level('l2', 'l1', 2)}, {_level('l3', 'l2', 3)},
plan AS (SELECT *, least(2, CAST(floor(budget / t) AS BIGINT)) AS whole FROM l3 JOIN leaf USING (k1, k2, k3)),
placed AS (SELECT *, CASE WHEN whole < 2 THEN budget - whole * t ELSE 0 END AS rest, {_seeded(29, 'whole', 'doc_id', 'crc')} AS h
           FROM doc JOIN plan USING (k1, k2, k3)),
taken AS (SELECT *, COALESCE(SUM(tokens) OVER (PARTITION BY k1, k2, k3 ORDER BY h, doc_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < rest AS partly FROM placed)
SELECT doc_id, k1 AS domain, lang, source, CAST(epoch AS INTEGER) AS epoch, CAST(tokens AS BIGINT) AS n_tokens,
       CAST(floor(budget) AS BIGINT) AS leaf_budget
FROM (SELECT *, UNNEST(range(whole + CASE WHEN partly THEN 1 ELSE 0 END)) AS epoch FROM taken)"""

SHARD_SQL = f"""
WITH {CRC_SQL},
doc AS (SELECT doc_id, COALESCE('v' || source, 'n') AS s, n_bytes + 16 AS size, crc,
               {_seeded(17, 'doc_id', 'crc', 'n_bytes + 16')} AS h FROM crc),
ranked AS (SELECT *, (ROW_NUMBER() OVER (PARTITION BY s ORDER BY h, doc_id NULLS FIRST, crc, size) - 0.5::DOUBLE)
                     / COUNT(*) OVER (PARTITION BY s) AS f, COUNT(*) OVER () AS total FROM doc),
placed AS (SELECT *, ROW_NUMBER() OVER (ORDER BY f, s, h, doc_id NULLS FIRST, crc, size) - 1 AS pos FROM ranked),
dealt AS (SELECT *, pos * {SHARDS} // total AS k FROM placed)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'rows' AS law, CAST(k AS INTEGER) AS shard,
       CAST(pos - (k * total + {SHARDS - 1}) // {SHARDS} AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM dealt"""

ORACLE_SQL: dict[str, str] = {"op1_embedding_near_dedup": EMBEDDING_SQL, "op7_mixing": MIX_SQL, "op9_jaccard_join": JACCARD_SQL,
                              "op10_sharding": SHARD_SQL, "op12_lexical_search": SEARCH_SQL, "op13_collocations": PHRASE_SQL}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)

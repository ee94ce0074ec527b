"""One query per corpus operator, with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudmart.llm import op1_warc as op1
from fraudmart.llm import op10_mixing as op10
from fraudmart.llm import op11_merkle_manifest as op11
from fraudmart.llm import op12_token_alignment as op12
from fraudmart.llm import op13_toxicity as op13
from fraudmart.llm import op2_secret_scan as op2
from fraudmart.llm import op3_license_scan as op3
from fraudmart.llm import op4_simhash_near_dup as op4
from fraudmart.llm import op5_lm_scoring as op5
from fraudmart.llm import op6_token_binary as op6
from fraudmart.llm import op7_collision_ann as op7
from fraudmart.llm import op8_quality_rules as op8
from fraudmart.llm import op9_sentencepiece as op9
from fraudmart.llm.common import prepare, table

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = op1.round_trip(table(spark, sf_dir, "pages"), min_bytes=1000)
    key = lambda c: F.regexp_extract(c, r"<urn:page:(-?[0-9]+)>", 1).try_cast("long")
    return got.select(key("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      key("refers_to").alias("refers_to"), "status")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op2.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(op2.as_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        op2.as_text(F.col("spans")).alias("spans"))


def derived_paths(docs: DataFrame) -> DataFrame:
    """The documents as a file tree: source/language/hundreds of 64/file; the first file
    of each leaf directory is its licence file (whether it holds a licence or not)."""
    leaf = F.floor(F.col("doc_id") / 64)
    name = F.when(F.col("doc_id") % 64 == 0, F.lit("LICENSE")).otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return docs.withColumn("path", F.concat_ws("/", "source", "lang", (leaf / 100).cast("long"), leaf, name))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return op3.scan(derived_paths(docs), keep=["doc_id"])


def op4_simhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op4.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = op5.fit(docs, op5.good_ids(table(spark, sf_dir, "labels")))
    return op5.score(docs, model).withColumnRenamed("id", "doc_id").withColumn("selected", F.col("ce_diff") < 0)


def op6_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6.round_trip(table(spark, sf_dir, "documents"), WORDS, end_id=2).withColumnRenamed("id", "doc_id")


def op7_collision_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return op7.nearest(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    entries = op8.stored_ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = op8.mask_of("base-1")
    return op8.with_sole_rule(entries, "web-2").select(
        "doc_id", *op8.MEASURES,
        (F.col("rule_bits").bitwiseAND(F.lit(base).cast("long")) != 0).alias("base_failed"),
        op8.verdict("web-1").alias("kept"), op8.verdict("web-2").alias("kept_web_2"), "rule_bits",
        "sole_rule", "sole_rule_docs")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), PIECES)


#: Target shares of the token total, by domain.
SHARES = {"clean": 0.9, "low": 0.08, "toxic": 0.02}


def domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the label table."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low")
                         .when((F.col("quality") == 1) & (F.col("toxic") == 0), "clean").alias("domain"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs, names = table(spark, sf_dir, "documents").select("doc_id", "text"), list(SHARES)
    model = op10.fit_classifier(docs, domains(table(spark, sf_dir, "labels")), names)
    mixed = op10.mix(docs, model, SHARES, names)
    return mixed.select("doc_id", "n_tokens", *[F.get("posterior", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(names)],
                        "rate", op10.copies(F.col("rate"), F.col("doc_id")).alias("copies"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    fields = [F.when(hit, op11.lower_ascii(F.col("text"))).otherwise(F.col("text")) if c == "text" else F.col(c)
              for c in docs.columns]
    made = op11.build(docs, docs.columns, "lang", "doc_id", keep=["doc_id"],
                      carry={"now": F.when(hit, op11.digest(op11.framed(*fields)))})
    proof = op11.digest(op11.joined(F.col("path"))).alias("proof_sha256")
    back = op11.folded(F.coalesce("now", "leaf"), F.col("path")).alias("folded_root")
    return made.select("doc_id", "leaf", "subroot", "root", proof, back).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = op12.align(table(spark, sf_dir, "documents").select("doc_id", "text"), (BYTES, PIECES))
    return op12.score(rows, op12.piece_model(PIECES).size).drop("groups")


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    network = op13.fit(docs, labels.filter(~op13.held_out()), label="toxic")
    return op13.score(docs, network).select("doc_id", op13.held_out().alias("held_out"), "score", "predicted")


QUERIES = {f.__name__: f for f in (
    op1_warc, op2_secret_scan, op3_license_scan, op4_simhash_near_dup, op5_lm_scoring, op6_token_binary,
    op7_collision_ann, op8_quality_rules, op9_sentencepiece, op10_mixing, op11_merkle_manifest,
    op12_token_alignment, op13_toxicity)}
ORACLES: dict[str, str] = {"op1_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
     m AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY h) END AS first FROM p)
SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to, 'ok' AS status
FROM m"""}

#: CRC-32 of each half byte (fixed values of the reflected polynomial 0xEDB88320).
_NIBBLES = [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
            3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII string expression in DuckDB, half byte by half byte."""
    step = f"xor(c >> 4, {_NIBBLES}[CAST(xor(c & 15, b) AS INTEGER) + 1])"
    halves = f"list_transform(range(2 * length({text})), lambda i: (ascii({text}[i // 2 + 1]) >> CAST(4 * (i % 2) AS INTEGER)) & 15)"
    return f"xor(list_reduce({halves}, lambda c, b: {step}, 4294967295), 4294967295)"


def _framed_sql(*fields: str) -> str:
    one = lambda c: f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || {c}, '-')"
    return "sha256(" + " || ".join(one(c) for c in fields) + ")"


ORACLES["op11_merkle_manifest"] = f"""
WITH RECURSIVE
d AS (SELECT *, coalesce({crc32_sql("CAST(doc_id AS VARCHAR)")} % 3 = 0, false) AS hit FROM documents),
h AS (SELECT doc_id, lang, {_framed_sql("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
      CASE WHEN hit THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS low,
      source, n_chars FROM d),
leaves AS (SELECT doc_id, lang, leaf, {_framed_sql("doc_id", "source", "lang", "n_chars", "low")} AS now,
      row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
      count(*) OVER (PARTITION BY lang) AS n FROM h),
up AS (SELECT 0 AS lv, lang, pos, n, leaf AS hash FROM leaves
      UNION ALL
      SELECT lv + 1, lang, pos // 8, (any_value(n) + 7) // 8, sha256(string_agg(hash, '' ORDER BY pos))
      FROM up WHERE n > 1 GROUP BY lv, lang, pos // 8),
subs AS (SELECT lang, hash, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
      FROM up WHERE n = 1),
top AS (SELECT 0 AS lv, pos, n, hash FROM subs
      UNION ALL
      SELECT lv + 1, pos // 8, (any_value(n) + 7) // 8, sha256(string_agg(hash, '' ORDER BY pos))
      FROM top WHERE n > 1 GROUP BY lv, pos // 8),
steps AS (SELECT l.lang, l.pos, u.lv,
        coalesce(string_agg(u.hash, '' ORDER BY u.pos) FILTER (u.pos < l.pos // CAST(pow(8, u.lv) AS BIGINT)), '') AS lt,
        coalesce(string_agg(u.hash, '' ORDER BY u.pos) FILTER (u.pos > l.pos // CAST(pow(8, u.lv) AS BIGINT)), '') AS rt
      FROM leaves l JOIN up u ON u.lang IS NOT DISTINCT FROM l.lang AND u.n > 1
        AND u.pos // 8 = l.pos // CAST(pow(8, u.lv + 1) AS BIGINT)
      GROUP BY l.lang, l.pos, u.lv
      UNION ALL
      SELECT l.lang, l.pos, t.lv + 100,
        coalesce(string_agg(t.hash, '' ORDER BY t.pos) FILTER (t.pos < s.pos // CAST(pow(8, t.lv) AS BIGINT)), ''),
        coalesce(string_agg(t.hash, '' ORDER BY t.pos) FILTER (t.pos > s.pos // CAST(pow(8, t.lv) AS BIGINT)), '')
      FROM leaves l JOIN subs s ON s.lang IS NOT DISTINCT FROM l.lang
        JOIN top t ON t.n > 1 AND t.pos // 8 = s.pos // CAST(pow(8, t.lv + 1) AS BIGINT)
      GROUP BY l.lang, l.pos, t.lv),
path AS (SELECT *, row_number() OVER (PARTITION BY lang, pos ORDER BY lv) AS k FROM steps),
fold AS (SELECT lang, pos, 0 AS k, now AS hash FROM leaves
      UNION ALL
      SELECT f.lang, f.pos, f.k + 1, sha256(p.lt || f.hash || p.rt)
      FROM fold f JOIN path p ON p.lang IS NOT DISTINCT FROM f.lang AND p.pos = f.pos AND p.k = f.k + 1),
proof AS (SELECT lang, pos, string_agg(lt || rt, '' ORDER BY k) AS p FROM path GROUP BY lang, pos),
last AS (SELECT lang, pos, arg_max(hash, k) AS hash FROM fold GROUP BY lang, pos)
SELECT l.doc_id, l.leaf, s.hash AS subroot, r.hash AS root, sha256(coalesce(p.p, '')) AS proof_sha256,
       f.hash AS folded_root, f.hash = r.hash AS verified
FROM leaves l JOIN subs s ON s.lang IS NOT DISTINCT FROM l.lang
CROSS JOIN (SELECT hash FROM top WHERE n = 1) r
LEFT JOIN proof p ON p.lang IS NOT DISTINCT FROM l.lang AND p.pos = l.pos
JOIN last f ON f.lang IS NOT DISTINCT FROM l.lang AND f.pos = l.pos"""

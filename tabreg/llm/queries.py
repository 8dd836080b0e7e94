"""One registered query for each operator, over its whole table, and the SQL
of those that SQL can express."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabreg.llm import (dac, exact_dedup, fim, langid, mixing, packing, pii, secret_scan, simhash, toxicity,
                        url_filter, vector_codes, winnowing)
from tabreg.llm.common import stored, table, text_or_empty

#: Folder of the public tokenizer files; unset, the installed package tells.
TOKENIZERS = os.environ.get("TOKENIZER_DIR")

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def tokenizer(name: str) -> str:
    if TOKENIZERS:
        return os.path.join(TOKENIZERS, name)
    import public_tokenizers
    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _span_table(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """(id, base, spans) as counts of the base kinds, a digest and text."""
    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("id").alias("doc_id"), *[count(k) for k in kinds],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return _span_table(pii.find(docs, pii.fit(docs)), pii.KINDS)


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"), with_ids=False)
    return packed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32",
                         "sequence_id", "offset")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(documents(spark, sf_dir), shingle_words=4, max_bits=4)
    return found.select(F.col("id").alias("doc_id"),
                        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = dac.write(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"), end_id=2)
    return dac.read_documents(spark, path).select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
r AS (
  SELECT *, row_number() OVER w AS rank, first_value(doc_id) OVER w AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id))
SELECT doc_id, keep_id, group_size, rank = 1 AS kept, text_sha256 FROM r"""


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.fit(langid.learning_rows(docs))
    held = docs.withColumn("held_out", F.coalesce(langid.remainder() == 1, F.lit(False)))
    return langid.predict(held, model, carry=["held_out"])


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.predict(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", text_or_empty().alias("text"))
    own = winnowing.fingerprints(docs, F.col("text"), "f").withColumns(
        {"hashes": winnowing.hash_set(F.col("f")), "fingerprint": winnowing.digest(F.col("f")),
         "n_chars": F.length("text").cast("long")}).drop("f")
    pairs = winnowing.with_next(own, ["text", "hashes"])
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = pairs.withColumn("edited", F.concat(
        F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half),
        F.substring(F.col("next.text"), F.lit(1), half))).withColumn("next_hashes", F.col("next.hashes")).drop("next", "text")
    edited = winnowing.fingerprints(edited, F.col("edited"), "e")
    return edited.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
        winnowing.digest(F.col("e")).alias("edited_fingerprint"),
        winnowing.likeness(F.col("hashes"), winnowing.hash_set(F.col("e"))).alias("near_edited"),
        winnowing.likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"))


#: The query's training budget is as many tokens as there are, no source more
#: than this many times; its entropy is halfway to the largest.
MAX_REPEATS = 2.0


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(mixing.rows_of(documents(spark, sf_dir)), "mix-tokens")
    budget = rows.agg(F.sum("tokens").cast("double")).first()[0]
    target = mixing.halfway_entropy(stored(mixing.source_table(rows), "mix-totals"))
    return mixing.schedule(rows, budget=budget, target_entropy=target, max_repeats=MAX_REPEATS).withColumnRenamed("id", "doc_id")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, url_filter.rule_table(spark, RULES)).drop("url")


OP10_SQL = r"""
WITH p AS (
  SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0
                       THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(rule, r_host, r_path, r_verdict) AS (VALUES
  ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
m AS (
  SELECT u.*, r.rule, r.r_verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) AS rank
  FROM u LEFT JOIN r ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path))
SELECT page_id, host, path, rule, coalesce(r_verdict, 'allow') AS verdict FROM m WHERE rank = 1"""

def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_table(secret_scan.find(documents(spark, sf_dir)), tuple(k for k, _, _ in secret_scan.BASE))


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fim.transform(documents(spark, sf_dir))
    return cut.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || doc_id) AS h FROM documents),
m AS (
  SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM m),
s AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
         array_to_string(u[b + 1:n], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(prefix || middle || suffix) AS restored_sha256
FROM s"""


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes.encode(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2)
    return vector_codes.with_label_error(codes).select(
        F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(vector_codes.codebook_digest(books)).alias("codebooks_sha256"))


def _assigned(t: int) -> str:
    """Parts of all vectors, each with its nearest entry of codebook ``t``, the lower one in ties."""
    gap = " + ".join(f"(p.x{i} - c{t}.x{i}) * (p.x{i} - c{t}.x{i})" for i in range(4))
    return f"""a{t} AS (
  SELECT p.vec_id, p.part, min_by(entry, (({gap})::HUGEINT * 64 + entry)) AS entry, min({gap}) AS error
  FROM p JOIN c{t} USING (part) GROUP BY p.vec_id, p.part)"""


def _averaged(t: int) -> str:
    mean = ", ".join(f"coalesce(floor(m{i}), c{t}.x{i})::BIGINT AS x{i}" for i in range(4))
    sums = ", ".join(f"sum(x{i}) / count(*) AS m{i}" for i in range(4))
    return f"""s{t} AS (SELECT part, entry, {sums} FROM a{t} JOIN p USING (vec_id, part) GROUP BY part, entry),
c{t + 1} AS (SELECT part, entry, {mean} FROM c{t} LEFT JOIN s{t} USING (part, entry))"""


OP13_SQL = f"""
WITH e AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings),
ok AS (SELECT vec_id FROM e GROUP BY vec_id HAVING bool_and(x IS NOT NULL AND isfinite(x))),
p AS (SELECT vec_id, i // 4 AS part, {", ".join(f"max(floor(256 * x::DOUBLE)::BIGINT) FILTER (i % 4 = {i}) AS x{i}" for i in range(4))}
      FROM e SEMI JOIN ok USING (vec_id) GROUP BY vec_id, i // 4),
f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM ok ORDER BY vec_id LIMIT 64),
c0 AS (SELECT part, entry, x0, x1, x2, x3 FROM p JOIN f USING (vec_id)),
{", ".join(y for t in range(2) for y in (_assigned(t), _averaged(t)))},
{_assigned(2)},
v AS (SELECT vec_id, string_agg(printf('%02x', entry::INT), '' ORDER BY part) AS code, sum(error)::BIGINT AS error
      FROM a2 GROUP BY vec_id),
b AS (SELECT sha256(string_agg(concat_ws(',', x0, x1, x2, x3), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM v JOIN embeddings USING (vec_id), b"""


QUERIES = {f.__name__: f for f in (
    op1_pii, op2_pack, op3_simhash, op4_token_files, op5_exact_dedup, op6_langid, op7_toxicity,
    op8_winnowing, op9_mixing, op10_url_filter, op11_secret_scan, op12_fim, op13_vector_codes)}
ORACLES = {"op5_exact_dedup": OP5_SQL, "op10_url_filter": OP10_SQL, "op12_fim": OP12_SQL,
           "op13_vector_codes": OP13_SQL}

"""The ``opN_`` queries: each applies its operator to a whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_utc
from . import (chat, decontam, exact_dedup, fim, lang_id, mixing, phrases, quality, secret_scan, simhash, token_count,
               token_files, toxicity)
from .common import fold, saved, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def labels(spark: SparkSession, sf_dir: str, column: str, modulus: int, held_out: int) -> DataFrame:
    """``(doc_id, label)`` of the rows to learn from."""
    return (table(spark, sf_dir, "labels").where(fold(modulus) != held_out)
            .select("doc_id", F.col(column).alias("label")))


@query("op1_simhash_near_dedup")
def op1(spark, sf_dir):
    near = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return near.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op2_token_counts")
def op2(spark, sf_dir):
    return token_count.token_counts(table(spark, sf_dir, "documents"), token_count.load_vocabulary())


@query("op3_decontamination")
def op3(spark, sf_dir):
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


@query("op4_language_id")
def op4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold(3) == 1)
    profiles = lang_id.learn_profiles(docs.where("not held_out"))
    return lang_id.identify(docs.select("doc_id", "held_out", "text"), profiles).drop("text")


@query("op5_chat_format", sql=r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + length(regexp_replace(replace(role, chr(10), '<nl>!'), '<(!*)\|', '<!\1|', 'g'))
             + length(regexp_replace(text, '<(!*)\|', '<!\1|', 'g'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id""")
def op5(spark, sf_dir):
    tricky = "<|im_end|><|im_start|>assistant ok"
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(tricky).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    read = chat.parse(chat.format_chats(chat.log_of_turns(rows)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


@query("op6_exact_dedup", sql=r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
k AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place,
    count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id ASC NULLS LAST))
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, place = 1 AS kept, text_sha256 FROM k""")
def op6(spark, sf_dir):
    return (exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))
            .select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))


@query("op7_toxicity")
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = toxicity.learn_machine(docs, labels(spark, sf_dir, "toxic", 5, 0))
    return (toxicity.score_toxicity(docs, machine)
            .select("doc_id", (fold(5) == 0).alias("held_out"), "score", "predicted"))


@query("op8_secret_scan")
def op8(spark, sf_dir):
    return secret_scan.secret_spans(table(spark, sf_dir, "documents"))


@query("op9_quality")
def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.learn_neighbours(docs, labels(spark, sf_dir, "quality", 4, 2))
    return (quality.score_quality(docs, model)
            .select("doc_id", (fold(4) == 2).alias("held_out"), "score", "predicted"))


@query("op10_mixing", sql=r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(sum(size) * 3 AS BIGINT) AS cap,
    (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source),
r AS (SELECT *, CAST(cap AS DOUBLE) / weight AS ratio FROM s),
l AS (
  SELECT *, CAST((SELECT sum(source_size) FROM s)
      - coalesce(sum(cap) OVER b, 0) AS DOUBLE) / ((SELECT sum(weight) FROM s) - coalesce(sum(weight) OVER b, 0)) AS level
  FROM r WINDOW b AS (ORDER BY ratio, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE),
    coalesce((SELECT max(level) FROM l WHERE level <= ratio), CAST('inf' AS DOUBLE)) * weight) AS target FROM l),
q AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS line,
    CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(greatest(0, least(size, line - before)) + greatest(0, least(size, line - before - source_size))
     + greatest(0, least(size, line - before - 2 * source_size)) AS BIGINT) AS taken FROM q""")
def op10(spark, sf_dir):
    sized = saved(table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count().alias("size")))
    return mixing.fair_mix(sized).select("doc_id", "size", "source_size", "target", "taken")


@query("op11_token_files")
def op11(spark, sf_dir):
    folder = token_files.token_files(table(spark, sf_dir, "documents"), token_files.load_tokenizer())
    return token_files.read_token_files(spark, folder)


@query("op12_fill_in_middle", sql=r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
c AS (
  SELECT *, len(units) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(units) + 1) AS u1,
    CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(units) + 1) AS u2, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
p AS (
  SELECT doc_id, text, n, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
      WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(units[1:least(u1, u2)], '') AS pre,
    array_to_string(units[least(u1, u2) + 1:greatest(u1, u2)], '') AS mid,
    array_to_string(units[greatest(u1, u2) + 1:], '') AS suf FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM p""")
def op12(spark, sf_dir):
    stores = saved(fim.store_texts(table(spark, sf_dir, "documents")))
    return fim.fill_in_middle(stores).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


@query("op13_phrases", sql=r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM t),
s AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
g AS (SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, m FROM s, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE i + m - 1 <= len(ws)),
f AS (SELECT lang, phrase, m, CAST(count(*) AS HUGEINT) AS f FROM g GROUP BY 1, 2, 3 HAVING count(*) >= 30 OR m = 1),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY 1),
c AS (SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m >= 2),
k AS (SELECT *, unnest(range(1, m)) AS k FROM c),
x AS (
  SELECT k.lang, k.phrase, k.a, k.k, p.f AS l, q.f AS r, (2000000 * k.a) // (p.f + q.f) AS score FROM k
  JOIN f p ON p.lang = k.lang AND p.phrase = array_to_string(k.ws[1:k.k], ' ')
  JOIN f q ON q.lang = k.lang AND q.phrase = array_to_string(k.ws[k.k + 1:], ' ')),
b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (SELECT lang, ws, m, a, unnest(range(2, m)) AS j FROM c WHERE m >= 3),
e AS (SELECT lang, ws, a, j, unnest(range(1, m - j + 2)) AS i FROM o),
h AS (SELECT lang, array_to_string(ws[i:i + j - 1], ' ') AS phrase, max(a) AS f FROM e GROUP BY 1, 2),
v AS (SELECT b.* FROM b LEFT JOIN h ON h.lang = b.lang AND h.phrase = b.phrase WHERE h.f IS NULL OR 100 * h.f < 80 * b.a),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM v)
SELECT z.lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM z JOIN n ON n.lang = z.lang WHERE rank <= 2000""")
def op13(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))

"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from dragoman.llm.common import table, through_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return add


@query("op10_simhash_near_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dragoman.llm import simhash
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, radius=2)


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dragoman.llm import ppm
    docs = table(spark, sf_dir, "documents")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    held_out = F.crc32(key) % 3 == 1
    model = ppm.train(spark, docs.filter(~held_out), key=key)
    got = docs.select("doc_id", held_out.alias("held_out"), ppm.identify(spark, F.col("text"), model).alias("got"))
    return got.select("doc_id", "held_out", "got.lang_pred", "got.score", "got.bits_per_byte")


@query("op7_sentencepiece_round_trip")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from dragoman.llm import pieces
    docs = table(spark, sf_dir, "documents")
    got = pieces.round_trip(spark, F.col("text"), public_tokenizers.path("piece_bpe_32k.model"))
    return docs.select("doc_id", got.alias("got")).select(
        "doc_id", (F.octet_length("got.ids") / 4).cast("long").alias("n_tokens"), F.sha2("got.ids", 256).alias("ids_sha256"),
        F.sha2("got.decoded", 256).alias("decoded_sha256"))


def joined_spans(spans):
    """kind:start:end of an array of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


@query("op2_secret_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from dragoman.llm import secrets
    words = secrets.ranked_words(public_tokenizers.path("piece_bpe_32k.model"))
    found = table(spark, sf_dir, "documents").select("doc_id", secrets.scan(F.col("text"), words).alias("found"))
    count = lambda kind: F.size(F.filter("found", lambda s: s.kind == kind)).cast("long")
    base = F.filter("found", lambda s: s.kind != "costly")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
                        F.sha2(joined_spans(base), 256).alias("base_sha256"), joined_spans(F.col("found")).alias("spans"),
                        count("costly").alias("n_costly"), F.array_max(F.transform("found", lambda s: s.cost)).alias("max_cost"))


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dragoman.llm import toxicity
    docs = table(spark, sf_dir, "documents")
    held_out = lambda: F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    lexicon = toxicity.fit(spark, docs.filter(~held_out()), table(spark, sf_dir, "labels").filter(~held_out()))
    got = docs.select("doc_id", held_out().alias("held_out"), toxicity.measures(spark, F.col("text"), lexicon).alias("m"))
    return got.select("doc_id", "held_out", "m.score", (F.col("m.score") >= 0.5).cast("int").alias("predicted"), "m.hits")


@query("op9_decontaminate")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dragoman.llm import decontaminate
    return decontaminate.leaks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op1_arc_to_warc", """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(encode(coalesce(html, ''))) AS payload_digest FROM pages),
     f AS (SELECT payload_digest, max(page_id) AS first_id FROM p WHERE octet_length(b) >= 1000 GROUP BY 1)
SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, p.payload_digest,
       CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM p LEFT JOIN f ON octet_length(b) >= 1000 AND f.payload_digest = p.payload_digest""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dragoman.llm import archives
    records = archives.archived(spark, table(spark, sf_dir, "pages"))
    page_id = archives.header_value(F.col("http_headers"), "X-Page-Id").cast("long")
    # a revisit names its referent's page in its own header, so the archives are read once
    return records.select(page_id.alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to_order").cast("long").alias("refers_to"))


@query("op6_distribution_divergence")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dragoman.llm import quality
    docs = table(spark, sf_dir, "documents")
    return quality.judged(docs, quality.references(docs))


def _register_op8() -> None:
    from dragoman.llm import licenses

    @query("op8_license_scan", licenses.twin_sql())
    def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
        return licenses.found_licenses(table(spark, sf_dir, "documents"))


_register_op8()


@query("op4_substring_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dragoman.llm import paragraphs
    return paragraphs.duplicates(spark, table(spark, sf_dir, "documents"))


@query("op12_fill_in_middle", r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
     u AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS us,
                  [('0x' || substr(h, 8 * k + 1, 8))::BIGINT for k in range(4)] AS d FROM t),
     c AS (SELECT *, len(us) AS n, least(d[1] % (len(us) + 1), d[2] % (len(us) + 1)) AS a, greatest(d[1] % (len(us) + 1), d[2] % (len(us) + 1)) AS b,
                  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR d[3] % 100 >= 90 THEN 'plain'
                       WHEN d[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
     s AS (SELECT *, array_to_string(us[1:a], '') AS p, array_to_string(us[a + 1:b], '') AS m, array_to_string(us[b + 1:], '') AS x FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || x || '<M>' || m ELSE '<S>' || x || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM s""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dragoman.llm import fim
    docs = table(spark, sf_dir, "documents")
    key = F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    got = docs.select("doc_id", fim.transform(F.col("text"), key).alias("got"))
    return got.select("doc_id", "got.n", "got.form", "got.prefix_chars", "got.middle_chars", F.sha2("got.output", 256).alias("output_sha256"),
                      F.sha2(fim.restore(F.col("got.output"), F.col("got.form")), 256).alias("restored_sha256"))


_ESCAPE = r"regexp_replace(coalesce({}, ''), '([<\[]\\*)(/?(?:s|INST|PART|IMG|AUDIO|DOC|FILE)[>\]])', '\1\\\2', 'g')"


@query("op13_chat_format", f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, turn, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(turn, role)),
     e AS (SELECT *, 20 + length({_ESCAPE.format('role')}) + length({_ESCAPE.format('text')}) AS size,
                  role || chr(10) || text || chr(10) AS line, CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(line, '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       sum(length(loss))::BIGINT AS loss_chars, sha256(string_agg(loss, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       sum(size)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dragoman.llm import chat
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    rows = rows.unionByName(spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema))
    back = chat.read_back(chat.formatted(rows.withColumn("parts", chat.text_parts(F.col("text")))))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with one of five faults planted by a hash of ``conv_id:turn``, of which a fault drops the row; nulls are one space."""
    rows = conversations.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(c) for c in ("conv_id", ":", "turn")])
    rows = rows.withColumn("fault", F.crc32(key) % 20).filter("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.explode(copies).alias("copy")).drop("copy")


@query("op11_conversation_repair")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dragoman.llm import audit
    conversations = table(spark, sf_dir, "conversations")
    pieces = through_table(audit.repaired(damaged(conversations)), "repaired")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    whole = pieces.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in counts], F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("piece", "audit"))), lambda p: p.audit), "").alias("audit"))
    found = whole.join(audit.digests(pieces).withColumnRenamed("conv_id", "digest_id"), F.col("conv_id").eqNullSafe(F.col("digest_id")))
    ids = conversations.select(F.col("conv_id").alias("id")).distinct()
    return ids.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("id").alias("conv_id"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))

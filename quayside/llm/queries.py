"""The operators applied to the given tables: one query each, and their SQL where there is any."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import bpe, capfilters, chat, langid, packing, periodic, pii, posindex, repair, secrets, simhash, warc, wavelet
from quayside.llm.common import sha256_hex, snapshot, table


BYTE_BPE = "byte_bpe_50k.tiktoken"


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_BPE)
    encoded = bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, decoded=True)
    return encoded.select(
        F.col("id").alias("doc_id"),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        sha256_hex("ids").alias("ids_sha256"),
        sha256_hex("decoded").alias("decoded_sha256"),
    )


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.learn(docs.where(~langid.held_out("doc_id")), F.col("text"), F.col("lang"))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score")


WORD_BPE = "word_bpe_49k.json"
END_ID = 2


def op3_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = wavelet.round_trip(docs, public_tokenizers.path(WORD_BPE), END_ID)
    return found.select(
        F.col("id").alias("doc_id"), "start", F.col("n_ids").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def op4_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = capfilters.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select(
        F.col("id").alias("vec_id"),
        F.col("links").alias("n_links"),
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select(
        "page_id",
        "payload_bytes",
        F.when(F.col("record_type") == "response", F.sha1("payload")).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    base = F.concat(*(pii.listed(k, F.col(k)) for k in pii.KINDS))
    every = F.concat(*(pii.listed(k, pii.all_spans(k)) for k in pii.KINDS))
    return found.select(
        F.col("id").alias("doc_id"),
        *(F.size(k).cast("long").alias(f"n_{k}") for k in pii.KINDS),
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(every, ",").alias("spans"),
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


#: Words of a benchmark item that are looked for together.
WINDOW_WORDS = 10


#: Words around its rarest one in which a window's words, in any order, make an item a near one.
NEAR_WORDS = 12


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str, span: int | None = None) -> DataFrame:
    """What the benchmark's windows hit in each document; with a span also what they nearly hit."""
    index = snapshot(posindex.build(docs), "index")
    asked = posindex.windows(table(spark, sf_dir, "benchmark"), "item_id", "text", WINDOW_WORDS)
    return posindex.search_windows(index, asked, span)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminated(spark, table(spark, sf_dir, "documents"), sf_dir, NEAR_WORDS)
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "near_items",
    )


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.find(docs, secrets.learn(docs))
    base = F.filter("spans", lambda s: s["kind"] != secrets.MARKOV)

    def listed(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("id").alias("doc_id"),
        *(count(k) for k in secrets.KINDS),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    columns = ["conv_id", "turn", "role", "text"]
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    turns = chat.turns_of_rows(rows.select(*columns).unionByName(extra), columns)
    found = chat.parsed(chat.formatted(chat.gathered(turns))).withColumn("learned", chat.masked())
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return found.select(
        F.col("conv").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


SEQUENCE_TOKENS = 2048
SEPARATOR_ID = 0


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = packing.pieces(docs, public_tokenizers.path(WORD_BPE), SEPARATOR_ID, SEQUENCE_TOKENS, with_ids=False)
    placed = packing.pack(snapshot(found, "pieces"), packing.capacities(SEQUENCE_TOKENS))
    return placed.select(
        F.col("id").alias("doc_id"),
        "piece",
        "start",
        "length",
        "ids_crc32",
        F.col("sequence").alias("sequence_id"),
        "offset",
    )


def _damaged(rows: DataFrame) -> DataFrame:
    """Rows of conversations of which some are dropped, emptied, cut short, repeated or given another role, by a hash."""
    named = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.pmod(F.crc32(named.cast("binary")), F.lit(20))
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    left = rows.withColumn("kind", kind).where("kind <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).alias("times"),
    )
    return left.withColumn("again", F.explode(F.array_repeat(F.lit(0), F.col("times")))).drop("times", "again")


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    found = repair.pieces(_damaged(rows))
    decisions = repair.decided(found)
    line = F.struct("part", "piece", "place", repair.said(F.col("role"), F.col("text")).alias("line"))
    # the digest of a conversation is one value over all its text, so here, and only here, its lines come together
    lines = repair.repaired(found, decisions).groupBy("conv").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    texts = lines.select(F.col("conv").alias("of"), F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("text"))
    ids = rows.select("conv_id").distinct()
    facts = repair.facts(decisions)
    every = ids.join(facts, F.col("conv_id").cast("string").eqNullSafe(F.col("conv")), "left")
    every = every.join(texts, F.col("conv_id").cast("string").eqNullSafe(F.col("of")), "left")
    return every.select(
        "conv_id",
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("repaired_sha256"),
    )


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeating(text: Column, doc_id: Column) -> Column:
    """The text of every tenth document (by a hash of its id) with its words from some place on repeating."""
    hashed = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(hashed / 10).cast("long")

    def reread(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, n).cast("int")
        p = (F.floor((n - a) / (F.pmod(g, F.lit(8)) + 3)) + 1).cast("int")
        numbers = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)))
        return F.when(n > 0, F.array_join(F.transform(numbers, lambda i: F.get(words, i)), " ")).otherwise("")

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.when(F.pmod(hashed, F.lit(10)) == 0, _let(words, reread)).otherwise(text)


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = _repeating(F.coalesce("text", F.lit("")), F.col("doc_id"))
    found = periodic.find(docs.select("doc_id", text.alias("text")))
    best = F.aggregate(
        "runs", F.get("runs", F.lit(0)), lambda a, b: F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a)
    )
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_langid": op2_langid,
    "op3_wavelet": op3_wavelet,
    "op4_cap_filters": op4_cap_filters,
    "op5_warc": op5_warc,
    "op6_pii": op6_pii,
    "op7_simhash": op7_simhash,
    "op8_decontamination": op8_decontamination,
    "op9_secrets": op9_secrets,
    "op10_chat": op10_chat,
    "op11_packing": op11_packing,
    "op12_repair": op12_repair,
    "op13_periodic": op13_periodic,
}

ORACLE: dict[str, str] = {
    # formatted_chars: <s> and [INST] with a space before a text, [/INST]</s> with a space after it, and a
    # backslash for each control string
    "op10_chat": r"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(22 + length(role) + length(text)
                   + len(regexp_extract_all(role || ' ' || text, '<\\*/?s>|\[\\*/?INST\]')))::BIGINT AS formatted_chars
        FROM rows GROUP BY conv_id
    """,
    "op5_warc": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), d AS (
            SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest FROM p
        ), w AS (
            SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS newest FROM d
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> newest THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> newest THEN newest END AS refers_to
        FROM w
    """,
}

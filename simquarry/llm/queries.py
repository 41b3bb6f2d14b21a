"""The queries of this subpackage, and their DuckDB texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from simquarry.llm import bpe, chat, collocations, decontam, jaccard, language, line_dedup, oracle, quality, runs, secrets, segment_bpe, token_files, warc
from simquarry.llm.text import hex_sha256
from simquarry.session import freeze

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_secret_scan")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    named = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != "random")
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *(n(k).alias(f"n_{k}") for k in ("assign", "access", "hex")), hex_sha256(named(base)).alias("base_sha256"), named(F.col("spans")).alias("spans"), n("random").alias("n_random")
    )


@query("op3_quality_rules", oracle.QUALITY)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("quality")
    return quality.measure(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *(q[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        quality.fails(quality.BASE, q["failed"]).alias("base_failed"),
        (~quality.fails(quality.FULL, q["failed"])).alias("kept"),
        q["failed"].alias("failed_bits"),
    )


@query("op5_benchmark_decontamination", oracle.DECONTAMINATION)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        hex_sha256(F.array_join("item_ids", ",")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op6_line_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("removed.n_removed").alias("n_removed"), F.col("removed.n_lines").alias("n_lines"), F.col("removed.n_chars").alias("n_chars"), hex_sha256(F.col("text")).alias("text_sha256"))


@query("op10_chat_formatting", oracle.CHAT)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = f"{chat.END}{chat.START}assistant ok"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    written = freeze(chat.format_turns(turns.select("conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("parts"))))
    read = written.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), F.array_join(chat.masked_texts(F.col("formatted"), F.col("loss")), "").alias("loss_text"))
    told: Column = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), chat.unescape(t["content"]), F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        hex_sha256(told).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        hex_sha256(F.col("loss_text")).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op2_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.digests(table(spark, sf_dir, "documents"), path)


@query("op7_token_files")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = token_files.new_folder(docs)
    token_files.write(docs, public_tokenizers.path("word_bpe_49k.json"), folder)
    return token_files.digests(token_files.read(spark, folder))


@query("op4_warc", oracle.WARC)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = warc.new_folder(pages)
    warc.write(pages, folder)
    read = freeze(
        warc.read(spark, folder).select(
            "page_id", "record_type", "refers_to", "status", F.octet_length("payload").cast("long").alias("own_bytes"), F.coalesce(F.sha2("payload", 256), F.col("digest")).alias("payload_digest")
        )
    )
    first = read.where("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.min("own_bytes").alias("first_bytes"))
    return read.join(first, ["refers_to", "payload_digest"], "left").select(
        "page_id", F.coalesce("own_bytes", "first_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to", "status"
    )


@query("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language.held_out(F.col("doc_id")))
    return language.predict(docs, language.fit(docs.where("not held_out")), ["doc_id", "held_out"])


@query("op9_jaccard_join", oracle.JACCARD)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(table(spark, sf_dir, "documents"))


UPPER_AND_TAB = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || chr(9)"


@query(
    "op11_phrase_collocations",
    f"""
    with texts as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), {UPPER_AND_TAB}, 'abcdefghijklmnopqrstuvwxyz ') as t from documents),
    pieces as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as p from texts),
    words as (select lang, list_filter(string_split(p, ' '), lambda x: x <> '') as w from pieces),
    sizes as (select lang, w, unnest(range(1, 6)) as k from words),
    places as (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from sizes),
    grams as materialized (select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase, count(*) as f from places group by all),
    totals as (select lang, sum(f)::bigint as n from grams where k = 1 group by lang),
    often as materialized (select * from grams where f >= 100),
    cuts as (select lang, phrase, k, f as a, string_split(phrase, ' ') as w, unnest(range(1, k)) as c from often where k > 1),
    scored as (
        select x.lang, x.phrase, x.a, x.c, l.f as l, r.f as r, n, ((1000::hugeint * x.a * n) // (l.f::hugeint * r.f))::bigint as score
        from cuts x join often l on l.lang = x.lang and l.phrase = array_to_string(w[1:c], ' ')
        join often r on r.lang = x.lang and r.phrase = array_to_string(w[c + 1:], ' ')
        join totals t on t.lang = x.lang),
    weakest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, c) = 1),
    longer as (
        select lang, f, array_to_string(w[i:i + j - 1], ' ') as phrase
        from (select *, unnest(range(1, k - j + 2)) as i from (select lang, f, k, string_split(phrase, ' ') as w, unnest(range(2, k)) as j from often where k > 2))),
    kept as (select * from weakest x where not exists (select 1 from longer y where y.lang = x.lang and y.phrase = x.phrase and 100 * y.f >= 100 * x.a))
    select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
    from kept qualify rank <= 2000
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op12_segment_bpe")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(table(spark, sf_dir, "documents"), plant=True)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        hex_sha256(listed).alias("runs_sha256"),
        hex_sha256(F.col("collapsed")).alias("collapsed_sha256"),
    )


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)

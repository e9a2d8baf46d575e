"""Named queries over the test tables, and the SQL they are checked against where SQL can say it."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import arrays as A, dependence, rules as R, text as X, vocabulary as V
from ..operators import chunking, dedup, embedding, generation, names, recall, relations, retrieval
from ..sources import files
from . import normalise, pipeline, reports

QUERIES: dict = {}
SQL: dict[str, str] = {}

# what the JVM's Unicode white space is, as a class for the SQL engine
BLANK = r"[\t\n\x0b\f\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def query(sql: str | None = None):
    def take(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return take


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_inline(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '{BLANK}+', ' ', 'g'))"


def sql_document(c: str) -> str:
    strip = lambda x: f"regexp_replace(regexp_replace({x}, '^{BLANK}+', ''), '{BLANK}+$', '')"
    line = strip("regexp_replace(l, '[ \\t]+', ' ', 'g')")
    lines = f"list_transform(string_split(regexp_replace(coalesce({c}, ''), '\\r\\n?', chr(10), 'g'), chr(10)), lambda l: {line})"
    return strip(f"regexp_replace(array_to_string({lines}, chr(10)), '\\n{{3,}}', chr(10) || chr(10), 'g')")


def sql_bucket(c: str) -> str:
    return f"('0x' || substr(sha256({c}), 1, 8))::BIGINT % 100"


def sql_shuffle(seed: int, c: str) -> str:
    return f"substr(sha256('{seed}:' || {c}), 1, 16)"


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --- normalisation and identity ------------------------------------------------------------
@query(f"SELECT evidence_source_id, source_index, {sql_inline('text')} AS line FROM d3_fault_texts")
def inline_texts(spark, sf_dir):
    return table(spark, sf_dir, "d3_fault_texts").select("evidence_source_id", "source_index", X.inline(F.col("text"), False).alias("line"))


@query(f"SELECT doc_id, {sql_document('text')} AS body FROM documents")
def document_texts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.document(F.col("text"), False).alias("body"))


@query()
def composed_texts(spark, sf_dir):
    """As document_texts, with the compatibility form."""
    return table(spark, sf_dir, "d4_documents").select("document_id", X.document(F.col("text")).alias("body"))


@query(f"SELECT evidence_source_id, {sql_inline('regexp_replace(coalesce(answer, chr(32)), ' + quoted('(?i)(?:https?://|www[.])[^' + BLANK[1:-1] + ']+') + ', chr(32), ' + quoted('g') + ')')} AS answer FROM d2_qa")
def answers_without_urls(spark, sf_dir):
    return table(spark, sf_dir, "d2_qa").select("evidence_source_id", X.without_urls(F.col("answer"), False).alias("answer"))


@query("SELECT vehicle_id, " + ", ".join(f"regexp_replace(lower({sql_inline(c)}), '[^a-z0-9\\x{{4e00}}-\\x{{9fff}}]+', '', 'g') AS {c}_key" for c in ("brand", "model")) + " FROM vehicle_catalogue")
def name_keys(spark, sf_dir):
    return table(spark, sf_dir, "vehicle_catalogue").select("vehicle_id", X.name_key(F.col("brand"), False).alias("brand_key"), X.name_key(F.col("model"), False).alias("model_key"))


@query(
    f"SELECT query_id, 'q_' || substr(sha256(query || chr(0) || coalesce(base_answer, '')), 1, 16) AS sample_id, {sql_bucket('query_id')} AS bucket, "
    f"CASE WHEN {sql_bucket('query_id')} < 90 THEN 'train' WHEN {sql_bucket('query_id')} < 95 THEN 'validation' ELSE 'test' END AS stable FROM d1_queries"
)
def stable_splits(spark, sf_dir):
    q = F.col("query_id")
    return table(spark, sf_dir, "d1_queries").select(q, X.identity("q", F.col("query"), F.col("base_answer")).alias("sample_id"), X.bucket(q).alias("bucket"), X.split_of(q).alias("stable"))


@query(f"SELECT stable AS split, count(*) AS n FROM (SELECT CASE WHEN {sql_bucket('query_id')} < 80 THEN 'train' WHEN {sql_bucket('query_id')} < 90 THEN 'validation' ELSE 'test' END AS stable FROM d1_queries) GROUP BY 1")
def split_counts(spark, sf_dir):
    return table(spark, sf_dir, "d1_queries").select(X.split_of(F.col("query_id"), 80, 10).alias("split")).groupBy("split").agg(F.count("*").alias("n"))


@query(f"SELECT DISTINCT evidence_source_id, {sql_shuffle(42, 'evidence_source_id')} AS place FROM d2_qa ORDER BY place, evidence_source_id LIMIT 100")
def hash_sample(spark, sf_dir):
    df = table(spark, sf_dir, "d2_qa").select("evidence_source_id", X.shuffle_key(42, F.col("evidence_source_id")).alias("place")).distinct()
    return relations.hash_sample(df, 100, 42, "evidence_source_id")


# --- deduplication ---------------------------------------------------------------------------
def evidence(spark, sf_dir) -> DataFrame:
    """source_rank, source, record_id, text, split of the three evidence tables."""
    d2, d3, d4 = (table(spark, sf_dir, t) for t in ("d2_qa", "d3_fault_texts", "d4_documents"))
    qa = F.concat(F.lit("Question: "), F.col("question"), F.lit("\n\nAnswer: "), F.coalesce("answer", F.lit("")))
    rows = d2.select(F.lit(1).alias("source_rank"), F.lit("d2").alias("source"), F.col("evidence_source_id").alias("record_id"), qa.alias("text"), "split", "language")
    rows = rows.unionByName(d3.select(F.lit(2).alias("source_rank"), F.lit("d3").alias("source"), F.col("evidence_source_id").alias("record_id"), "text", "split", "language"))
    return rows.unionByName(d4.select(F.lit(3).alias("source_rank"), F.lit("d4").alias("source"), F.col("document_id").alias("record_id"), "text", "split", "language"))


SQL_EVIDENCE = (
    "SELECT 1 AS source_rank, 'd2' AS source, evidence_source_id AS record_id, 'Question: ' || question || chr(10) || chr(10) || 'Answer: ' || coalesce(answer, '') AS text, split FROM d2_qa "
    "UNION ALL SELECT 2, 'd3', evidence_source_id, text, split FROM d3_fault_texts UNION ALL SELECT 3, 'd4', document_id, text, split FROM d4_documents"
)


@query(
    f"WITH e AS ({SQL_EVIDENCE}), k AS (SELECT source_rank, source, record_id, split, sha256(lower({sql_inline('text')})) AS k FROM e) "
    "SELECT k AS text_key, source, record_id, split FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY source_rank, record_id, split) AS n FROM k) WHERE n = 1"
)
def evidence_first_wins(spark, sf_dir):
    rows = evidence(spark, sf_dir).select("source_rank", "source", "record_id", "split", F.sha2(X.key(F.col("text"), False), 256).alias("text_key"))
    return dedup.first_wins(rows, ["text_key"], ["source_rank", "record_id", "split"]).select("text_key", "source", "record_id", "split")


@query(
    f"WITH k AS (SELECT query_id, source_index, lower({sql_inline('query')}) AS k, len(flags) > 0 OR domain_status = 'non_automotive' AS blocked FROM d1_queries), "
    "f AS (SELECT k, min(source_index) AS first FROM k WHERE NOT blocked GROUP BY k) "
    "SELECT query_id, source_index, coalesce(source_index > first, false) AS duplicate FROM k LEFT JOIN f USING (k)"
)
def repeated_queries(spark, sf_dir):
    rows = table(spark, sf_dir, "d1_queries").select("query_id", "source_index", X.key(F.col("query"), False).alias("k"), ((F.size("flags") > 0) | (F.col("domain_status") == "non_automotive")).alias("blocked"))
    return dedup.repeated_after_keeper(rows, ["k"], "source_index", F.col("blocked")).select("query_id", "source_index", "duplicate")


@query(
    f"WITH k AS (SELECT DISTINCT query_id, split, lower({sql_inline('query')}) AS k, {sql_shuffle(42, 'query_id')} AS o FROM d1_queries), "
    "a AS (SELECT *, row_number() OVER (PARTITION BY split, k ORDER BY o, query_id) AS n FROM k), "
    "b AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY o, query_id) AS m FROM a WHERE n = 1), "
    "c AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY CASE split WHEN 'test' THEN 0 WHEN 'validation' THEN 1 ELSE 2 END, o, query_id) AS p FROM b WHERE split = 'train' OR m <= 200) "
    "SELECT query_id, split FROM c WHERE p = 1"
)
def split_safe_queries(spark, sf_dir):
    """At most 200 queries in each held-out split (the export's cap), none of them also in train."""
    rows = table(spark, sf_dir, "d1_queries").select("query_id", "split", X.key(F.col("query"), False).alias("k")).distinct()
    safe = dedup.split_safe(rows, "k", "split", X.shuffle_key(42, F.col("query_id")), {"validation": 200, "test": 200}, {"test": 0, "validation": 1, "train": 2}, "query_id")
    return safe.select("query_id", "split")


@query(
    "WITH k AS (SELECT query_id, source_index, domain_status FROM d1_queries), f AS (SELECT max(source_index) AS last, count(*) AS n FROM (SELECT source_index FROM k WHERE domain_status = 'automotive' ORDER BY source_index LIMIT 1000)) "
    "SELECT query_id, source_index, domain_status FROM k, f WHERE n < 1000 OR source_index <= last"
)
def kept_prefix(spark, sf_dir):
    """Rows up to the thousandth kept one (a run limit)."""
    rows = table(spark, sf_dir, "d1_queries").select("query_id", "source_index", "domain_status")
    return dedup.kept_prefix(rows, "source_index", F.col("domain_status") == "automotive", 1000)


# --- rules -------------------------------------------------------------------------------------
def _sql_scores() -> str:
    return ", ".join("(" + " + ".join(f"(length(t) - length(replace(t, {quoted(p)}, ''))) // {len(p)}" for p in parts) + f") AS s_{n}" for n, parts in V.SYSTEM.items())


def _sql_best() -> str:
    best = "greatest(" + ", ".join(f"s_{n}" for n in V.SYSTEM) + ")"
    return f"CASE WHEN {best} <= 0 THEN 'other' " + " ".join(f"WHEN s_{n} = {best} THEN '{n}'" for n in V.SYSTEM) + " END"


def _sql_first() -> str:
    return "CASE " + " ".join("WHEN " + " OR ".join(f"contains(t, {quoted(p)})" for p in parts) + f" THEN '{n}'" for n, parts in V.POWERTRAIN.items()) + " ELSE 'unknown' END"


@query(f"WITH t AS (SELECT evidence_source_id, source_index, lower({sql_inline('text')}) AS t FROM d3_fault_texts), s AS (SELECT *, {_sql_scores()} FROM t) SELECT evidence_source_id, source_index, {_sql_best()} AS system_label, {_sql_first()} AS powertrain_label FROM s")
def text_labels(spark, sf_dir):
    rows = table(spark, sf_dir, "d3_fault_texts").select("evidence_source_id", "source_index", X.key(F.col("text"), False).alias("t"))
    rows = rows.withColumn("scores", R.label_scores(F.col("t"), V.SYSTEM))
    return rows.select("evidence_source_id", "source_index", R.best_label(F.col("scores"), list(V.SYSTEM), "other").alias("system_label"), R.first_label(F.col("t"), V.POWERTRAIN, "unknown").alias("powertrain_label"))


def _sql_term(t: str, c: str) -> str:
    return f"regexp_matches({c}, {quoted('(^|[^a-z0-9])' + t + '([^a-z0-9]|$)')})" if R._PLAIN_TERM.fullmatch(t) else f"contains({c}, {quoted(t)})"


def _sql_any(terms: list[str], c: str) -> str:
    return "(" + " OR ".join(_sql_term(t, c) for t in terms) + ")"


def _sql_reasons(c: str) -> str:
    """Sorted list of the reasons that put a text outside."""
    inside = _sql_any(V.DOMAIN_TERMS, c)
    terms = [f"CASE WHEN {_sql_term(t, c)}{' AND NOT ' + inside if t == V.EXCUSED_TERM else ''} THEN {quoted(t)} END" for t in V.FOREIGN_TERMS]
    terms.append(f"CASE WHEN regexp_matches({c}, {quoted(V.PEST)}) AND regexp_matches({c}, {quoted(V.PEST_WORDING)}) THEN 'spider' END")
    return f"list_sort(list_filter([{', '.join(terms)}], lambda x: x IS NOT NULL))"


def _sql_domain(c: str, default: str, auxiliary: str | None = None) -> str:
    inside = _sql_any(V.DOMAIN_TERMS, c) + (f" OR {_sql_any(V.DOMAIN_TERMS, auxiliary)}" if auxiliary else "")
    return f"CASE WHEN len({_sql_reasons(c)}) > 0 THEN 'non_automotive' WHEN {inside} THEN 'automotive' ELSE '{default}' END"


@query(
    f"WITH t AS (SELECT evidence_source_id, source_index, lower({sql_inline('question')}) AS q, lower({sql_inline('answer')}) AS a FROM d2_qa) SELECT evidence_source_id, source_index, {_sql_domain('q', 'uncertain', 'a')} AS domain, {_sql_reasons('q')}::VARCHAR AS reasons, "
    + "list_sort(list_filter([" + ", ".join("CASE WHEN " + " OR ".join(_sql_term(t, "a") for t in ts) + f" THEN '{n}' END" for n, ts in V.RISK_TERMS.items()) + "], lambda x: x IS NOT NULL))::VARCHAR AS risks FROM t"
)
def domain_and_risks(spark, sf_dir):
    rows = table(spark, sf_dir, "d2_qa").select("evidence_source_id", "source_index", X.key(F.col("question"), False).alias("q"), X.key(F.col("answer"), False).alias("a"))
    shown = lambda c: F.concat(F.lit("["), F.array_join(c, ", "), F.lit("]"))
    return rows.select("evidence_source_id", "source_index", normalise.domain(F.col("q"), auxiliary=F.col("a")).alias("domain"), shown(normalise.foreign(F.col("q"))).alias("reasons"), shown(R.term_flags(F.col("a"), V.RISK_TERMS)).alias("risks"))


@query(f"SELECT document_id, extracted_at, regexp_matches({sql_inline("coalesce(title, '') || ' ' || coalesce(text, '')")}, {quoted(V.UNSAFE_CHANGE)}) AS review, {sql_inline('title')} LIKE '%保养%' OR {sql_inline('title')} LIKE '%维护%' AS upkeep FROM d4_documents")
def safety_reviews(spark, sf_dir):
    """Documents that put safety devices out of action."""
    both = X.inline(normalise.joined(F.col("title"), F.col("text")), False)
    return table(spark, sf_dir, "d4_documents").select("document_id", "extracted_at", both.rlike(V.UNSAFE_CHANGE).alias("review"), X.inline(F.col("title"), False).rlike("保养|维护").alias("upkeep"))


@query(f"WITH t AS (SELECT evidence_source_id, source_index, {sql_document('text')} AS t FROM d3_fault_texts) SELECT evidence_source_id, source_index, " + ", ".join(f"len(regexp_extract_all(t, {quoted('(?i)' + p)}))::INT AS {n}" for n, p in V.PROCESS_COUNTS.items()) + " FROM t")
def process_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "d3_fault_texts").select("evidence_source_id", "source_index", R.counts_of(X.document(F.col("text"), False), V.PROCESS_COUNTS).alias("c"))
    return rows.select("evidence_source_id", "source_index", "c.*")


@query()
def numbered_steps(spark, sf_dir):
    return table(spark, sf_dir, "d4_documents").select("document_id", R.counts_of(X.document(F.col("text")), {"step_count": V.NUMBERED_STEP})["step_count"].alias("step_count"))


@query()
def bypass_pairs(spark, sf_dir):
    """Answers in which an action and an object stand close together, in a sentence that instructs."""
    pair = R.near_pair(X.key(F.col("answer")), r"bypass|disable|override|jump|绕过|短接", r"interlock|airbag|parking brake|relay|fuse|sensor|继电器|传感器", 55, context=r"you can|should|need to|可以|需要|应")
    return table(spark, sf_dir, "d2_qa").select("evidence_source_id", pair.alias("paired")).groupBy("paired").agg(F.count("*").alias("n"))


# --- literals, arrays, JSON ----------------------------------------------------------------------
@query()
def text_literals(spark, sf_dir):
    rows = table(spark, sf_dir, "d3_fault_texts")
    found = A.literals(F.col("text"))
    return rows.select("evidence_source_id", "source_index", F.array_join(found, "|").alias("found"), F.size(A.unsupported(F.col("text"), F.array(F.array_join("literals", " ")))).alias("unsupported"))


@query(
    f"WITH l AS (SELECT unnest(literals) AS x FROM d1_queries), p AS (SELECT upper(regexp_replace(x, '{BLANK}+', '', 'g')) AS p FROM l WHERE x IS NOT NULL), "
    "d AS (SELECT p, regexp_extract(p, '^([0-9]{2}|[0-9]{4})(?:年|款)$', 1) AS y FROM p) "
    "SELECT CASE WHEN length(y) = 4 THEN 'MODEL_YEAR:' || y WHEN length(y) = 2 AND y::INT <= 29 THEN 'MODEL_YEAR:' || (2000 + y::INT) WHEN length(y) = 2 AND y::INT >= 80 THEN 'MODEL_YEAR:' || (1900 + y::INT) ELSE p END AS literal_key, count(*) AS n FROM d GROUP BY 1"
)
def literal_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "d1_queries").select(F.explode("literals").alias("x")).where("x is not null")
    return rows.groupBy(A.literal_key(F.col("x")).alias("literal_key")).agg(F.count("*").alias("n"))


@query("SELECT event_type, count(*) AS n, sum((props->>'k')::BIGINT)::BIGINT AS total FROM events GROUP BY 1")
def model_answers(spark, sf_dir):
    """JSON objects out of fenced answers."""
    answer = F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```"))
    rows = table(spark, sf_dir, "events").select("event_type", A.model_json(answer, "k long")["k"].alias("k"))
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("k").alias("total"))


@query("SELECT unnest(flags) AS label, count(*) AS n FROM d1_queries GROUP BY 1")
def flag_counts(spark, sf_dir):
    return relations.counts(table(spark, sf_dir, "d1_queries"), "flags")


@query(
    "SELECT 'domain_status' AS field, domain_status AS value, count(*) AS n FROM d1_queries GROUP BY 2 UNION ALL SELECT 'intent', intent, count(*) FROM d1_queries GROUP BY 2 "
    "UNION ALL SELECT 'split', split, count(*) FROM d1_queries GROUP BY 2 UNION ALL SELECT 'system', system, count(*) FROM d1_queries GROUP BY 2"
)
def label_counts(spark, sf_dir):
    """Four groupings in one pass over the table."""
    fields = ["domain_status", "intent", "split", "system"]
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("p")
    return table(spark, sf_dir, "d1_queries").select(pairs).groupBy("p.field", "p.value").agg(F.count("*").alias("n"))


@query(
    "SELECT split, count(confidence) AS n, round(min(confidence), 6) AS min, round(quantile_cont(confidence, 0.25), 6) AS p25, round(quantile_cont(confidence, 0.5), 6) AS median, "
    "round(quantile_cont(confidence, 0.75), 6) AS p75, round(max(confidence), 6) AS max, round(avg(confidence), 6) AS mean FROM retrieval_results GROUP BY 1"
)
def confidence_summary(spark, sf_dir):
    return retrieval.score_summary(table(spark, sf_dir, "retrieval_results"), "confidence", ["split"])


@query("SELECT CASE WHEN confidence IS NULL THEN 'none' WHEN confidence >= 0.65 THEN 'high' WHEN confidence >= 0.6 THEN 'medium' ELSE 'low' END AS grade, retrieval_status, coalesce(len(candidates), 0) AS candidates, count(*) AS n FROM retrieval_results GROUP BY ALL")
def retrieval_counts(spark, sf_dir):
    grade = R.grade(F.col("confidence"), [(0.65, "high"), (0.60, "medium")], "none", "low").alias("grade")
    size = F.coalesce(F.when(F.col("candidates").isNotNull(), F.size("candidates")), F.lit(0)).alias("candidates")
    return table(spark, sf_dir, "retrieval_results").groupBy(grade, "retrieval_status", size).agg(F.count("*").alias("n"))


# --- joins -------------------------------------------------------------------------------------------
@query("SELECT r.query_id, q.query, CASE WHEN q.query_id IS NULL THEN 'query_not_found' END AS lookup_error FROM retrieval_results r LEFT JOIN (SELECT query_id, min(query) AS query FROM d1_queries WHERE split <> 'test' GROUP BY 1) q USING (query_id)")
def retrieval_lookup(spark, sf_dir):
    known = table(spark, sf_dir, "d1_queries").where("split <> 'test'").groupBy("query_id").agg(F.min("query").alias("query"))
    return relations.lookup(table(spark, sf_dir, "retrieval_results").select("query_id"), known, "query_id", "query_not_found").select("query_id", "query", "lookup_error")


@query(
    f"WITH e AS (SELECT record_id, any_value(source) AS owner FROM ({SQL_EVIDENCE}) GROUP BY 1), c AS (SELECT query_id, unnest(candidates) AS c FROM retrieval_results) "
    "SELECT c.source AS source, owner, count(*) AS n, round(avg(c.score), 6) AS mean_score FROM c JOIN e ON c.source_record_id = e.record_id GROUP BY 1, 2"
)
def candidate_evidence(spark, sf_dir):
    owners = evidence(spark, sf_dir).groupBy("record_id").agg(F.min("source").alias("owner"))
    rows = relations.expanded(table(spark, sf_dir, "retrieval_results"), "candidates", ["query_id"])
    return rows.join(owners, F.col("source_record_id") == F.col("record_id")).groupBy("source", "owner").agg(F.count("*").alias("n"), F.round(F.avg("score"), 6).alias("mean_score"))


@query("SELECT DISTINCT document_id FROM d4_documents WHERE document_id NOT IN (SELECT c.source_record_id FROM (SELECT unnest(candidates) AS c FROM retrieval_results) WHERE c.source_record_id IS NOT NULL)")
def unused_documents(spark, sf_dir):
    used = table(spark, sf_dir, "retrieval_results").select(F.transform("candidates", lambda c: c["source_record_id"]).alias("ids"))
    return relations.unused(table(spark, sf_dir, "d4_documents").select("document_id").distinct(), "document_id", used, "ids")


@query(
    "WITH b AS (SELECT evidence_source_id AS id, 'base' AS origin FROM d2_qa GROUP BY 1), c AS (SELECT evidence_source_id AS id, 'change' AS origin FROM d2_qa WHERE metadata.storage_source IS NULL GROUP BY 1) "
    "SELECT * FROM c UNION ALL SELECT * FROM b WHERE id NOT IN (SELECT id FROM c)"
)
def upserted_answers(spark, sf_dir):
    rows = table(spark, sf_dir, "d2_qa")
    base = rows.select(F.col("evidence_source_id").alias("id"), F.lit("base").alias("origin")).distinct()
    changes = rows.where("metadata.storage_source is null").select(F.col("evidence_source_id").alias("id"), F.lit("change").alias("origin"))
    return relations.upsert(base, changes, "id", ["origin"])


@query(
    "WITH r AS (SELECT query_id, substr(sha256(query_id || chr(0) || split), 1, 32) AS f FROM d1_queries GROUP BY ALL), c AS (SELECT query_id, substr(sha256(query_id || chr(0) || retrieval_status), 1, 32) AS f FROM retrieval_results "
    "UNION SELECT query_id, substr(sha256(query_id || chr(0) || split), 1, 32) FROM retrieval_results) SELECT c.query_id IS NOT NULL AS cached, count(*) AS n FROM r LEFT JOIN c USING (query_id, f) GROUP BY 1"
)
def cache_hits(spark, sf_dir):
    print_of = lambda c: X.digest(F.concat_ws("\0", "query_id", c), 32).alias("f")
    records = table(spark, sf_dir, "d1_queries").select("query_id", print_of("split")).distinct()
    results = table(spark, sf_dir, "retrieval_results")
    cache = results.select("query_id", print_of("retrieval_status")).union(results.select("query_id", print_of("split")))
    return relations.cache_state(records, cache, "query_id", "f").groupBy("cached").agg(F.count("*").alias("n"))


# --- retrieval -----------------------------------------------------------------------------------------
def _vectors(spark, sf_dir) -> DataFrame:
    """The vectors with a split, a system, a powertrain and fault codes made from label and id."""
    label, n = F.col("label"), F.col("vec_id")
    codes = F.when(n % 3 == 0, F.array(F.concat(F.lit("p0"), (label % 7 + 100).cast("string")))).otherwise(F.array().cast("array<string>"))
    return table(spark, sf_dir, "embeddings").select(
        n.alias("evidence_id"), n.alias("source_record_id"), F.col("embedding").alias("vector"), F.concat(F.lit("g"), n % 2).alias("split"), F.concat(F.lit("s"), label).alias("system"),
        F.when(n % 5 < 2, "bev").when(n % 5 < 4, "ice").otherwise("unknown").alias("powertrain"), codes.alias("literals"),
    )


def _queries(vectors: DataFrame) -> DataFrame:
    return vectors.where("evidence_id % 20 = 0").withColumnRenamed("evidence_id", "query_id")


_SQL_POWER = "CASE WHEN {0}.vec_id % 5 < 2 THEN 'bev' WHEN {0}.vec_id % 5 < 4 THEN 'ice' ELSE 'unknown' END"
SQL_NEAREST = (
    "SELECT q.vec_id AS query_id, e.vec_id AS evidence_id, e.embedding::DOUBLE[] AS vec, list_inner_product(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) AS raw, round(list_inner_product(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 6) AS score, "
    f"'s' || q.label AS qs, 's' || e.label AS es, {_SQL_POWER.format('q')} AS qp, {_SQL_POWER.format('e')} AS ep, q.vec_id % 3 = 0 AND e.vec_id % 3 = 0 AND q.label % 7 = e.label % 7 AS same_code, "
    "row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_inner_product(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 12) DESC, e.vec_id) AS raw_rank FROM embeddings q, embeddings e WHERE q.vec_id % 20 = 0 AND q.vec_id % 2 = e.vec_id % 2"
)
SQL_RESCORED = (
    "SELECT *, round(raw + CASE WHEN qs = es THEN 0.02 ELSE -0.03 END + CASE WHEN qp <> 'unknown' AND ep <> 'unknown' AND qp <> ep THEN -0.01 ELSE 0 END + CASE WHEN same_code THEN 0.05 ELSE 0 END, 6) AS adjusted "
    f"FROM ({SQL_NEAREST}) WHERE raw_rank <= 50 AND raw >= 0.2"
)
FLOOR = dict(min_score=0.2, system_bonus=0.02, system_penalty=0.03)


@query(f"SELECT query_id, evidence_id, score, raw_rank FROM ({SQL_NEAREST}) WHERE raw_rank <= 10")
def nearest_vectors(spark, sf_dir):
    """The ten nearest vectors of the same split."""
    vectors = _vectors(spark, sf_dir)
    found = retrieval.nearest(_queries(vectors), vectors, 10, "split")
    return found.select("query_id", "evidence_id", F.round("raw_score", 6).alias("score"), "raw_rank")


def _rescored(spark, sf_dir, cfg) -> DataFrame:
    vectors = _vectors(spark, sf_dir)
    queries = _queries(vectors)
    return retrieval.rescored(retrieval.nearest(queries, vectors, cfg.pool, "split"), queries, vectors, cfg)


@query(f"SELECT query_id, evidence_id, adjusted FROM ({SQL_RESCORED})")
def rescored_vectors(spark, sf_dir):
    return _rescored(spark, sf_dir, retrieval.RetrievalConfig(**FLOOR)).select("query_id", "evidence_id", F.col("adjusted_score").alias("adjusted"))


@query(
    f"WITH RECURSIVE c AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY adjusted DESC, raw_rank) AS rn FROM ({SQL_RESCORED})), "
    "walk AS (SELECT query_id, 0::BIGINT AS rn, []::BIGINT[] AS ids, []::DOUBLE[][] AS vecs FROM (SELECT DISTINCT query_id FROM c) UNION ALL "
    "SELECT c.query_id, c.rn, CASE WHEN coalesce(list_max(list_transform(vecs, lambda v: list_inner_product(v, c.vec))), -2) < 0.5 THEN list_append(ids, c.rn) ELSE ids END, "
    "CASE WHEN coalesce(list_max(list_transform(vecs, lambda v: list_inner_product(v, c.vec))), -2) < 0.5 THEN list_append(vecs, c.vec) ELSE vecs END FROM walk w JOIN c ON c.query_id = w.query_id AND c.rn = w.rn + 1), "
    "k AS (SELECT query_id, unnest(ids) AS rn, generate_subscripts(ids, 1) AS pos FROM (SELECT query_id, max_by(ids, rn) AS ids FROM walk GROUP BY 1)), "
    "r AS (SELECT c.*, pos FROM k JOIN c USING (query_id, rn)), t AS (SELECT query_id, count(DISTINCT es) FILTER (pos <= 5) AS systems, max(es) FILTER (pos = 1) AS top, max(adjusted) FILTER (pos = 1) AS best FROM r GROUP BY 1), "
    "o AS (SELECT query_id, min(pos) AS other FROM r JOIN t USING (query_id) WHERE systems <= 1 AND pos > 5 AND es <> top AND adjusted >= best - 0.3 GROUP BY 1), "
    "f AS (SELECT r.* FROM r LEFT JOIN o USING (query_id) WHERE CASE WHEN other IS NULL THEN pos <= 5 ELSE pos <= 4 OR pos = other END) "
    "SELECT query_id, evidence_id, adjusted, score AS raw, es AS system, row_number() OVER (PARTITION BY query_id ORDER BY adjusted DESC, pos)::INT AS rank FROM f"
)
def selected_vectors(spark, sf_dir):
    """The five best that are not too close to each other, with room for another system."""
    cfg = retrieval.RetrievalConfig(**FLOOR, dedup_similarity=0.5, diversity_margin=0.3)
    rows = retrieval.selected(_rescored(spark, sf_dir, cfg), cfg)
    return rows.select("query_id", "evidence_id", F.col("adjusted_score").alias("adjusted"), F.round("raw_score", 6).alias("raw"), "system", "rank")


@query(
    f"WITH c AS (SELECT * FROM ({SQL_NEAREST}) WHERE raw_rank <= 50), s AS (SELECT * FROM ({SQL_RESCORED})) SELECT 'step' AS section, * FROM (SELECT 'pooled' AS label, count(*) AS n FROM c UNION ALL SELECT 'below_min_score', count(*) FROM c WHERE raw < 0.2 UNION ALL SELECT 'rescored', count(*) FROM s "
    "UNION ALL SELECT 'system_bonus', count(*) FROM s WHERE qs = es UNION ALL SELECT 'system_penalty', count(*) FROM s WHERE qs <> es UNION ALL SELECT 'powertrain_penalty', count(*) FROM s WHERE qp <> 'unknown' AND ep <> 'unknown' AND qp <> ep UNION ALL SELECT 'code_boost', count(*) FROM s WHERE same_code) WHERE n > 0"
)
def retrieval_steps(spark, sf_dir):
    """Candidates at the steps before the selection."""
    cfg = retrieval.RetrievalConfig(**FLOOR)
    vectors = _vectors(spark, sf_dir)
    queries = _queries(vectors)
    found = retrieval.nearest(queries, vectors, cfg.pool, "split")
    rescored = retrieval.rescored(found, queries, vectors, cfg)
    none = rescored.select("query_id", "evidence_id").withColumn("rank", F.lit(0)).limit(0)
    steps = reports.retrieval_steps(found, rescored, none, cfg)
    return steps.where("label not in ('left_out', 'selected', 'first')")


@query(
    f"WITH t AS (SELECT evidence_source_id AS id, source_index, lower({sql_inline('text')}) AS t FROM d3_fault_texts), "
    "k AS (SELECT DISTINCT id, source_index, list_concat(regexp_extract_all(t, '[a-z0-9]+|[\\x{4e00}-\\x{9fff}]'), list_transform(range(1, greatest(length(t) - 1, 1)), lambda i: substr(t, i, 3))) AS ks FROM t), "
    "e AS (SELECT id, source_index, md5(k) AS h FROM (SELECT id, source_index, unnest(ks) AS k FROM k)), "
    "s AS (SELECT id, source_index, ('0x' || substr(h, 7, 2) || substr(h, 5, 2) || substr(h, 3, 2) || substr(h, 1, 2))::BIGINT % 512 AS slot, sum(CASE WHEN ('0x' || substr(h, 9, 2))::BIGINT % 2 = 0 THEN 1 ELSE -1 END) AS v FROM e GROUP BY ALL) "
    "SELECT id, source_index, count(*) FILTER (v <> 0) AS filled, round(sqrt(sum(v * v)::DOUBLE), 6) AS norm FROM s GROUP BY ALL"
)
def hashed_embeddings(spark, sf_dir):
    """Signed hashing of words, ideographs and runs of three: filled slots and norm of each vector, row by row."""
    rows = table(spark, sf_dir, "d3_fault_texts").select(F.col("evidence_source_id").alias("id"), "source_index", X.key(F.col("text"), False).alias("t")).distinct()

    @F.pandas_udf("struct<filled: long, norm: double>")
    def measure(t: pd.Series) -> pd.DataFrame:
        counts = [embedding.hashed_counts(t.iloc[i : i + 256].tolist(), 512) for i in range(0, len(t), 256)]
        counts = np.concatenate(counts) if counts else np.zeros((0, 512))
        return pd.DataFrame({"filled": (counts != 0).sum(axis=1), "norm": np.sqrt((counts**2).sum(axis=1)).round(6)})

    some = (F.length("t") >= 3) | F.col("t").rlike("[a-z0-9一-鿿]")  # texts without any token have no vector
    return rows.where(some).withColumn("m", measure("t")).select("id", "source_index", "m.*")


# --- samples, checks, export --------------------------------------------------------------------------------
@query(f"WITH e AS (SELECT DISTINCT source, record_id FROM ({SQL_EVIDENCE})) SELECT source, record_id, row_number() OVER (PARTITION BY source ORDER BY {sql_shuffle(42, 'record_id')}, record_id)::INT AS turn FROM e")
def round_robin(spark, sf_dir):
    return relations.round_robin(evidence(spark, sf_dir).select("source", "record_id").distinct(), "source", "record_id", 42)


@query(
    f"WITH q AS (SELECT query_id, min(intent) AS intent, min(split) AS split, max(len(flags)) AS f FROM d1_queries GROUP BY 1), s AS (SELECT *, row_number() OVER (PARTITION BY intent ORDER BY {sql_shuffle(42, 'query_id')}, query_id) AS n FROM q) "
    "SELECT query_id, CASE WHEN f > 0 THEN 'flagged' WHEN split = 'test' THEN 'test' ELSE 'intent:' || intent END AS review_reason FROM s WHERE f > 0 OR split = 'test' OR n <= 30"
)
def review_sample(spark, sf_dir):
    rows = table(spark, sf_dir, "d1_queries").groupBy("query_id").agg(F.min("intent").alias("intent"), F.min("split").alias("split"), F.max(F.size("flags")).alias("f"))
    always = [(F.col("split") == "test", F.lit("test")), (F.col("f") > 0, F.lit("flagged"))]
    return relations.review_sample(rows, "query_id", {"intent": F.col("intent")}, 30, 42, always).select("query_id", "review_reason")


@query(
    "WITH e AS (SELECT unnest(list_filter([CASE WHEN split NOT IN ('train', 'validation', 'test') THEN 'invalid_split' END, CASE WHEN coalesce(question, '') = '' THEN 'empty_question' END, CASE WHEN coalesce(answer, '') = '' THEN 'empty_answer' END, "
    "CASE WHEN length(coalesce(question, '')) + length(coalesce(answer, '')) > 600 THEN 'too_many_chars' END], lambda x: x IS NOT NULL)) AS code FROM d2_qa) SELECT code, count(*) AS n FROM e GROUP BY 1"
)
def sample_errors(spark, sf_dir):
    q, a = F.coalesce("question", F.lit("")), F.coalesce("answer", F.lit(""))
    codes = {"invalid_split": ~F.col("split").isin("train", "validation", "test"), "empty_question": q == "", "empty_answer": a == "", "too_many_chars": F.length(q) + F.length(a) > 600}
    return relations.counts(table(spark, sf_dir, "d2_qa").select(generation.error_codes(codes).alias("codes")), "codes", "code")


@query("SELECT evidence_source_id, source_index, question, coalesce(answer, '') AS answer FROM d2_qa")
def conversation_round_trip(spark, sf_dir):
    """Question and answer as a two-turn conversation, written as JSON and read back."""
    rows = files.conversations(table(spark, sf_dir, "d2_qa").select("evidence_source_id", "source_index", "question", "answer"), "question", "answer")
    kind = rows.schema["conversations"].dataType
    back = rows.select("evidence_source_id", "source_index", F.from_json(F.to_json("conversations", {"ignoreNullFields": "false"}), kind).alias("conversations"))
    return files.turns(back).drop("conversations")


@query()
def evidence_split_counts(spark, sf_dir):
    """Chunks of all three sources: normalised, cut, first of equal ones, counted by source, split and language."""
    cut = chunking.exploded(evidence(spark, sf_dir), "text", 2000, 80)
    cut = cut.select("source_rank", "source", "record_id", "split", "language", "chunk_index", F.length("chunk").alias("size"), F.sha2(F.lower("chunk"), 256).alias("k"))
    first = dedup.first_wins(cut, ["k"], ["source_rank", "record_id", "chunk_index", "split", "language"])
    return first.groupBy("source", "split", "language").agg(F.count("*").alias("chunks"), F.sum("size").cast("long").alias("chars"))


@query()
def corpus_chunks(spark, sf_dir):
    """Pre-training chunks of all evidence: validation wins over train, then hash order."""
    rows = evidence(spark, sf_dir).where("split <> 'test'")
    cut = chunking.exploded(rows, "text", 6000, 20)
    cut = cut.withColumn("pt_id", F.concat_ws("_", F.lit("pt"), "source", X.digest(F.col("record_id")), F.col("chunk_index")))
    narrow = cut.select("pt_id", "source", "split", F.length("chunk").alias("size"), F.sha2(F.lower("chunk"), 256).alias("k"), X.shuffle_key(42, F.col("pt_id")).alias("o"))
    rank = F.when(F.col("split") == "validation", 0).otherwise(1)
    return dedup.by_priority(narrow, ["k"], rank, ["o", "pt_id"]).select("pt_id", "source", "split", "size")


def _sql_key(c: str) -> str:
    return f"regexp_replace(lower({sql_inline(c)}), '[^a-z0-9\\x{{4e00}}-\\x{{9fff}}]+', '', 'g')"


def _sql_within(a: str, b: str) -> str:
    return f"({a} <> '' AND {b} <> '' AND ({a} = {b} OR (least(length({a}), length({b})) >= 2 AND (contains({a}, {b}) OR contains({b}, {a})))))"


def _sql_bare(c: str) -> str:
    return f"regexp_replace({c}, '(汽车|轿车)$', '')"


SQL_ALIASES = (
    f"k AS (SELECT DISTINCT {_sql_key('brand')} AS bk, {_sql_key('model')} AS mk FROM vehicle_catalogue WHERE brand IS NOT NULL AND model IS NOT NULL), p AS (SELECT * FROM k WHERE mk <> ''), "
    "a AS (SELECT bk || mk AS alias, bk, mk, true AS whole FROM p UNION ALL SELECT mk, bk, mk, false FROM p WHERE len(regexp_extract_all(mk, '[\\x{4e00}-\\x{9fff}]')) >= 3 OR (len(regexp_extract_all(mk, '[\\x{4e00}-\\x{9fff}]')) >= 2 AND regexp_matches(mk, '[a-z0-9]'))), "
    "o AS (SELECT alias, any_value(bk) AS bk, any_value(mk) AS mk, bool_or(whole) AS whole FROM a GROUP BY alias HAVING count(DISTINCT bk || chr(0) || mk) = 1), "
    "o2 AS (SELECT * FROM o WHERE whole OR alias NOT IN (SELECT bk FROM p)), pattern AS (SELECT string_agg(alias, '|' ORDER BY length(alias) DESC, alias) AS re FROM o2)"
)


@query(
    f"WITH {SQL_ALIASES}, q AS (SELECT DISTINCT query_id, {_sql_key('query')} AS key, instruction_vehicle IS NOT NULL AS declared, {_sql_key('instruction_vehicle.brand')} AS db, {_sql_key('instruction_vehicle.model')} AS dm FROM d1_queries), "
    "u AS (SELECT DISTINCT key FROM q), f AS (SELECT key, regexp_extract_all(key, re) AS m, string_split_regex(key, re) AS parts FROM u, pattern), "
    "x AS (SELECT key, unnest(range(1, len(m) + 1)) AS i, m, parts FROM f), "
    "y AS (SELECT key, m[i] AS alias, coalesce(list_sum(list_transform(parts[1:i], lambda v: length(v))), 0) + coalesce(list_sum(list_transform(m[1:i - 1], lambda v: length(v))), 0) AS start FROM x), "
    "z AS (SELECT y.key, y.alias, start, substr(y.key, (greatest(start - 20, 0) + 1)::BIGINT, least(start, 20)::BIGINT) AS before, o2.bk, o2.mk, o2.whole FROM y JOIN o2 USING (alias)), "
    f"g AS (SELECT query_id, declared, db, dm, q.key, count(z.alias) AS n, bool_or({_sql_within(_sql_bare('z.bk'), _sql_bare('db'))} OR {_sql_within('z.mk', 'dm')}) AS own, "
    f"bool_or(regexp_matches(before, {quoted(V.OWNED)}) OR (whole AND regexp_matches(before, {quoted(V.YEAR_ONLY)}))) AS claimed, bool_or(whole) AS named, string_agg(z.alias, '|' ORDER BY start) AS mentions FROM q LEFT JOIN z ON q.key = z.key GROUP BY 1, 2, 3, 4, 5) "
    f"SELECT query_id, coalesce(mentions, '') AS mentions, CASE WHEN NOT declared OR db IN ({', '.join(map(quoted, V.NO_BRAND))}) THEN 'unknown' WHEN n = 0 THEN 'no_explicit_vehicle' WHEN own THEN 'consistent' WHEN regexp_matches(key, {quoted(V.COMPARED)}) THEN 'review' WHEN claimed THEN 'conflict' WHEN named THEN 'review' ELSE 'no_explicit_vehicle' END AS status FROM g"
)
def vehicle_contexts(spark, sf_dir):
    """The vehicles that each query names, and how they stand to the declared one."""
    catalogue = names.alias_catalogue(table(spark, sf_dir, "vehicle_catalogue"), compose=False)
    rows = table(spark, sf_dir, "d1_queries").select("query_id", X.name_key(F.col("query"), False).alias("key"), "instruction_vehicle").distinct()
    rows = rows.withColumn("found", names.mention_arrays(F.col("key"), catalogue, False))
    status = names.vehicle_context(F.col("instruction_vehicle"), F.col("key"), F.col("found"), False)
    return rows.select("query_id", F.array_join(F.transform("found", lambda m: m["alias"]), "|").alias("mentions"), status.alias("status"))


@query()
def generated_answers(spark, sf_dir):
    """A generation stage with an offline provider: prompts, pending set, call, parsing, counts."""
    rows = table(spark, sf_dir, "d2_qa").groupBy("evidence_source_id").agg(F.min("question").alias("question"))
    rows = rows.withColumn("prompt", generation.prompt_of([F.lit("Question:"), F.col("question")])).withColumn("f", relations.input_hash(F.col("prompt"), F.lit("mock").alias("model")))
    cache = rows.where("f < '8'").select("evidence_source_id", "f")
    todo = generation.pending(rows, cache, "evidence_source_id", "f")
    done = generation.generate(todo.select("evidence_source_id", "prompt"), "prompt", generation.constant_provider({"route": "no_evidence", "answer": "not known yet"}))
    return done.select(A.model_json(F.col("response"), "route string, answer string")["route"].alias("route"), "attempts").groupBy("route", "attempts").agg(F.count("*").alias("n"))


@query()
def file_inventory(spark, sf_dir):
    rows = files.inventory(spark, sf_dir)
    return rows.groupBy("extension", "temporary").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


@query()
def reference_flag_counts(spark, sf_dir):
    """Answers that lean on images, links, comments or other answers, and risk wording."""
    rows = table(spark, sf_dir, "d2_qa").select(X.document(F.col("answer")).alias("a"), X.inline(F.col("question")).alias("q"))
    flags = F.concat(dependence.reference_flags(F.col("a"), F.col("q")), dependence.risk_flags(F.lower("a"), F.lower("q")))
    return relations.counts(rows.select(flags.alias("flags")), "flags")


def _sql_flags(*pairs: tuple[str, str]) -> str:
    return "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in pairs) + "], lambda x: x IS NOT NULL), ',')"


def _sql_says(c: str, p: str) -> str:
    return f"regexp_matches({c}, {quoted('(?i)' + p)})"


_OWN = sql_inline(f"regexp_replace(a, {quoted('(?i)(?:https?://|www[.])[^' + BLANK[1:-1] + ']+')}, ' ', 'g')")
_BOTH = sql_inline(f"regexp_replace(q || ' ' || a, {quoted('(?i)' + V.IMAGE_IDIOM)}, ' ', 'g')")


@query(
    f"WITH t AS (SELECT evidence_source_id, source_index, {sql_inline('question')} AS q, {sql_document('answer')} AS a FROM d2_qa), u AS (SELECT *, {_OWN} AS own FROM t), "
    f"v AS (SELECT *, length(own) >= 180 OR (length(own) >= 90 AND {_sql_says('own', V.SUBSTANTIVE)}) AS stands, {_sql_says('a', '(?:https?://|www[.])[^' + BLANK[1:-1] + ']+')} AS link, len(regexp_extract_all(own, {quoted('(?i)' + V.ACTIONS_TOLD)})) AS told FROM u) "
    "SELECT evidence_source_id, source_index, "
    + _sql_flags(
        ("has_comment_reference", _sql_says("a", V.COMMENT)),
        ("has_external_link", "link"),
        ("has_image_reference", _sql_says(_BOTH, V.IMAGE)),
        ("has_other_answer_reference", _sql_says("a", V.OTHER_ANSWER)),
        ("needs_comment", f"{_sql_says('a', V.COMMENT)} AND {_sql_says('a', V.COMMENT_NEEDED)} AND NOT stands"),
        ("needs_external_link", f"link AND (length(own) < 60 OR {_sql_says('a', V.LINK_FULFILS)} OR ({_sql_says('a', V.LINK_DIRECTS)} AND NOT stands AND length(own) < 300 AND told < 2))"),
        (
            "needs_image",
            f"{_sql_says(_BOTH, V.IMAGE)} AND ({_sql_says('q', V.IMAGE_ASKED_ATTACHED)} OR ({_sql_says('q', V.IMAGE)} AND ({_sql_says('q', V.IMAGE_ASKED_BROAD)} OR {_sql_says('q', V.IMAGE_ASKED)})) OR {_sql_says('a', V.IMAGE_STRONG)} OR (({_sql_says('a', V.IMAGE_POINTED)} OR {_sql_says('a', V.IMAGE_SHOWS)}) AND NOT stands))",
        ),
        ("needs_other_answer", f"{_sql_says('a', V.OTHER_ANSWER)} AND {_sql_says('a', V.OTHER_ANSWER_NEEDED)} AND NOT stands"),
    )
    + " AS flags FROM v"
)
def reference_flags(spark, sf_dir):
    """What each answer leans on."""
    rows = table(spark, sf_dir, "d2_qa").select("evidence_source_id", "source_index", X.document(F.col("answer"), False).alias("a"), X.inline(F.col("question"), False).alias("q"))
    return rows.select("evidence_source_id", "source_index", F.array_join(dependence.reference_flags(F.col("a"), F.col("q")), ",").alias("flags"))


@query()
def document_kinds(spark, sf_dir):
    rows = table(spark, sf_dir, "d4_documents").select("document_id", X.inline(F.col("title")).alias("t"), X.document(F.col("text")).alias("b"))
    rows = rows.withColumn("s", dependence.process_signals(F.col("b")))
    return rows.select("document_id", "s.*", dependence.has_process(F.col("s")).alias("process"), dependence.document_kind(F.col("t"), F.col("b"), F.col("s")).alias("kind")).distinct()


RECALL_QUOTE = "Nm拧紧"
EXCLUDED = ["d3_excluded_by_hand"]  # the test tables name no exclusions


@query(
    f"WITH t AS (SELECT evidence_source_id AS id, list_contains(flags, 'short') AND NOT list_has_any(flags, ['empty', 'off_topic', 'uncertain_domain']) AS wanted, {sql_document('text')} AS text FROM d3_fault_texts), "
    "u AS (SELECT id, min(text) AS text FROM t WHERE wanted GROUP BY id), "
    f"v AS (SELECT id, contains({sql_inline('text')}, {quoted(RECALL_QUOTE)}) AS held, id IN ('d3_excluded_by_hand') AS excluded FROM u) "
    "SELECT id, excluded, held AND NOT excluded AS accepted, CASE WHEN held THEN '' ELSE 'unsupported_action_quotes,unsupported_finding_quotes' END AS errors FROM v"
)
def recalled_texts(spark, sf_dir):
    """Short fault texts, decided on by an offline model that quotes one phrase; nobody has excluded any."""
    rows = table(spark, sf_dir, "d3_fault_texts").drop("semantic_recall")
    answer = {"decision": "recall", "label": "diagnostic_case", "confidence": "high", "unsafe_operation": False, "reason": "offline", "supporting_quotes": [], "action_quotes": [RECALL_QUOTE], "finding_quotes": [RECALL_QUOTE], "verification_quotes": []}
    decisions, _, _ = recall.second_look(rows, replace(recall.FAULTS, wanted=("short",), dropped_flags=("short",)), generation.constant_provider(answer), "offline", {"manual_exclusions": {"d3": EXCLUDED}}, compose=False)
    return decisions.select("id", "excluded", "accepted", F.array_join("errors", ",").alias("errors"))


@query(f"SELECT split, count(*) AS n, 512 AS dim, round(avg(CASE WHEN q = '' THEN 0 ELSE 1 END), 4) AS norm FROM (SELECT DISTINCT split, lower({sql_inline('query')}) AS q FROM d1_queries) GROUP BY 1")
def text_vectors(spark, sf_dir):
    """Vectors of the queries by the hashing backend: dimensions and mean norm per split."""
    rows = table(spark, sf_dir, "d1_queries").select("split", X.key(F.col("query"), False).alias("q")).distinct()
    vectors = embedding.embed(rows, "q", embedding.hashing_encoder())
    return vectors.groupBy("split").agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("dim"), F.round(F.avg(A.cosine(F.col("vector"), F.col("vector"))), 4).alias("norm"))


# --- stages over the test tables --------------------------------------------------------------------------------
def _raw_queries(spark, sf_dir):
    return table(spark, sf_dir, "d1_queries").select("source_index", "instruction", F.col("query").alias("input"), F.col("base_answer").alias("output"))


def _raw_answers(spark, sf_dir):
    return table(spark, sf_dir, "d2_qa").select("source_index", F.col("question").alias("input"), F.col("answer").alias("output"), "metadata")


def _raw_faults(spark, sf_dir):
    return table(spark, sf_dir, "d3_fault_texts").select("source_index", F.col("text").alias("input"), F.array_join("weak_labels", ",").alias("output"))


def _sql_id(prefix: str, *parts: str) -> str:
    return f"'{prefix}_' || substr(sha256({' || chr(0) || '.join(parts)}), 1, 16)"


def _sql_split(c: str, train: int, validation: int) -> str:
    return f"CASE WHEN {sql_bucket(c)} < {train} THEN 'train' WHEN {sql_bucket(c)} < {train + validation} THEN 'validation' ELSE 'test' END"


@query(
    f"WITH n AS (SELECT source_index, {sql_inline('instruction')} AS i, {sql_inline('query')} AS q, {sql_document('base_answer')} AS a FROM d1_queries), t AS (SELECT *, lower(trim(i || ' ' || q)) AS k, lower(i || ' ' || q) AS t FROM n), "
    f"d AS (SELECT *, {_sql_domain('t', 'uncertain')} AS domain_status, q = '' OR a = '' AS empty, {_sql_scores()} FROM t), "
    "f AS (SELECT k, min(source_index) AS first FROM d WHERE NOT empty AND domain_status = 'automotive' GROUP BY k), e AS (SELECT d.*, coalesce(source_index > first, false) AS dup FROM d LEFT JOIN f USING (k)) "
    f"SELECT {_sql_id('d1', 'k')} AS query_id, source_index, q AS query, a AS base_answer, domain_status, {_sql_first()} AS powertrain, {_sql_best()} AS system, {_sql_split('k', 90, 5)} AS split, "
    f"{_sql_flags(('empty', 'empty'), ('duplicate_query', 'dup'), ('off_topic', "domain_status <> 'automotive'"))} AS flags, NOT (empty OR dup OR domain_status <> 'automotive') AS kept FROM e"
)
def normalised_queries(spark, sf_dir):
    """Questions with labels, flags and a split; vehicles are left to vehicle_contexts."""
    none = spark.createDataFrame([], "alias string, brand string, model string, whole boolean")
    rows = normalise.queries(_raw_queries(spark, sf_dir), none, compose=False)
    return rows.select("query_id", "source_index", "query", "base_answer", "domain_status", "powertrain", "system", "split", F.array_join("flags", ",").alias("flags"), "kept")


@query(
    f"WITH n AS (SELECT source_index, {sql_inline('question')} AS q, {sql_document('answer')} AS a FROM d2_qa), t AS (SELECT *, lower(q) AS k, lower(q || chr(10) || a) AS t FROM n), d AS (SELECT *, {_sql_domain('k', 'automotive')} AS domain_status, {_sql_scores()} FROM t) "
    f"SELECT {_sql_id('d2', 'q', 'a')} AS evidence_source_id, source_index, q AS question, a AS answer, domain_status, {_sql_first()} AS powertrain, {_sql_best()} AS system, {_sql_split('k', 90, 5)} AS split, NOT (q = '' OR a = '' OR domain_status = 'non_automotive') AS kept FROM d"
)
def normalised_answers(spark, sf_dir):
    rows = normalise.answers(_raw_answers(spark, sf_dir), compose=False)
    return rows.select("evidence_source_id", "source_index", "question", "answer", "domain_status", "powertrain", "system", "split", "kept")


@query(
    f"WITH n AS (SELECT source_index, {sql_document('text')} AS b, {sql_document("array_to_string(weak_labels, ',')")} AS w FROM d3_fault_texts), t AS (SELECT *, lower({sql_inline('b')}) AS t FROM n), d AS (SELECT *, {_sql_domain('t', 'uncertain', 'lower(w)')} AS domain_status, {_sql_scores()} FROM t) "
    f"SELECT {_sql_id('d3', 'b')} AS evidence_source_id, source_index, b AS text, w AS weak_labels, domain_status, {_sql_first()} AS powertrain, {_sql_best()} AS system, {_sql_flags(('empty', "b = ''"), ('off_topic', "domain_status = 'non_automotive'"), ('uncertain_domain', "domain_status = 'uncertain'"))} AS flags FROM d"
)
def normalised_faults(spark, sf_dir):
    rows = normalise.faults(_raw_faults(spark, sf_dir), compose=False)
    flags = F.array_join(F.filter("flags", lambda f: f != "no_diagnosis_process"), ",").alias("flags")
    return rows.select("evidence_source_id", "source_index", "text", "weak_labels", "domain_status", "powertrain", "system", flags)


@query(
    f"WITH n AS (SELECT source_index, {sql_inline('question')} AS q, {sql_document('answer')} AS a FROM d2_qa), d AS (SELECT *, lower({sql_inline('q || chr(10) || a')}) AS t FROM n), e AS (SELECT *, {_sql_domain('t', 'uncertain')} AS s FROM d) "
    f"SELECT {_sql_id('legacy', 'q', 'a')} AS sample_id, source_index, q AS question, a AS answer, {_sql_flags(('empty', "q = '' OR a = ''"), ('off_topic', "s <> 'automotive'"))} AS flags, NOT (q = '' OR a = '' OR s <> 'automotive') AS kept FROM e"
)
def normalised_conversations(spark, sf_dir):
    """The question and answer pairs as ready-made conversations."""
    raw = files.conversations(table(spark, sf_dir, "d2_qa").select("source_index", "question", "answer"), "question", "answer")
    rows = normalise.conversations(raw.select("source_index", "conversations"), compose=False)
    return rows.select("sample_id", "source_index", "question", "answer", F.array_join("flags", ",").alias("flags"), "kept")


@query(
    f"WITH n AS (SELECT document_id, extracted_at, media_count, {sql_inline('title')} AS i, {sql_document('text')} AS b FROM d4_documents), t AS (SELECT *, {sql_inline("i || ' ' || b")} AS v FROM n), u AS (SELECT *, lower(v) AS t FROM t), d AS (SELECT *, {_sql_scores()} FROM u) "
    f"SELECT document_id, extracted_at, i AS title, length(b) AS chars, {_sql_first()} AS powertrain, {_sql_best()} AS system, {_sql_split('document_id', 80, 10)} AS split, {_sql_flags(('empty', "b = ''"), ('needs_image', 'coalesce(media_count, 0) > 0 AND length(b) < 300'), ('safety_review', f'regexp_matches(v, {quoted(V.UNSAFE_CHANGE)})'))} AS flags FROM d"
)
def normalised_documents(spark, sf_dir):
    rows = normalise.documents(table(spark, sf_dir, "d4_documents").select("document_id", "title", "text", "media_count", "extracted_at"), compose=False)
    flags = F.array_join(F.array_compact(F.array(*[F.when(F.array_contains("flags", f), f) for f in ("empty", "needs_image", "safety_review")])), ",").alias("flags")
    return rows.select("document_id", "extracted_at", "title", F.length("text").alias("chars"), "powertrain", "system", "split", flags)


def _sql_tally(section: str, source: str, label: str, where: str = "true") -> str:
    return f"SELECT '{section}' AS section, ({label})::VARCHAR AS label, count(*) AS n FROM {source} WHERE {where} AND ({label}) IS NOT NULL GROUP BY 2"


@query(
    " UNION ALL ".join(
        [
            _sql_tally("queries", "retrieval_results", "'all'"), _sql_tally("status", "retrieval_results", "retrieval_status"), _sql_tally("reason", "retrieval_results", "no_candidate_reason"),
            _sql_tally("candidate_count", "retrieval_results", "coalesce(len(candidates), 0)"), _sql_tally("source", "(SELECT unnest(candidates) AS c FROM retrieval_results)", "c.source"), _sql_tally("first_source", "retrieval_results", "candidates[1].source"),
        ]
    )
)
def retrieval_totals(spark, sf_dir):
    return reports.retrieval_report(table(spark, sf_dir, "retrieval_results"))


def _sql_packed(text: str, most: int, least: int) -> str:
    """List of the chunks of a text: lines packed by a fold over the lines, long lines sliced."""
    lines = f"list_filter(list_transform(string_split({text}, chr(10)), lambda l: trim(l)), lambda l: l <> '')"
    slices = f"list_transform(range(0, length(l), {most}), lambda i: substr(l, (i + 1)::BIGINT, {most}))"
    start = "{'done': []::VARCHAR[], 'pack': '', 'size': 0::BIGINT, 'l': ''}"
    items = f"list_transform({lines}, lambda l: {{'done': []::VARCHAR[], 'pack': '', 'size': 0::BIGINT, 'l': l}})"
    flush = "CASE WHEN s.size > 0 THEN list_append(s.done, s.pack) ELSE s.done END"
    step = (
        f"CASE WHEN length(x.l) > {most} THEN {{'done': list_concat({flush}, {slices.replace('length(l)', 'length(x.l)').replace('substr(l,', 'substr(x.l,')}), 'pack': '', 'size': 0::BIGINT, 'l': ''}} "
        f"WHEN s.size > 0 AND s.size + length(x.l) + 1 > {most} THEN {{'done': list_append(s.done, s.pack), 'pack': x.l, 'size': (length(x.l) + 1)::BIGINT, 'l': ''}} "
        "ELSE {'done': s.done, 'pack': CASE WHEN s.size > 0 THEN s.pack || chr(10) || x.l ELSE x.l END, 'size': (s.size + length(x.l) + 1)::BIGINT, 'l': ''} END"
    )
    end = f"list_reduce(list_prepend({start}, {items}), lambda s, x: {step})"
    folded = f"list_transform([{end}], lambda s: {flush})[1]"
    return f"list_filter(CASE WHEN length({text}) <= {most} THEN [{text}] ELSE {folded} END, lambda c: length(c) >= {least})"


@query(
    f"WITH t AS (SELECT doc_id, {sql_document('text')} AS t FROM documents), c AS (SELECT doc_id, {_sql_packed('t', 400, 40)} AS cs FROM t) "
    "SELECT doc_id, (i - 1)::INT AS chunk_index, cs[i] AS chunk FROM (SELECT doc_id, cs, unnest(range(1, len(cs) + 1)) AS i FROM c)"
)
def line_chunks(spark, sf_dir):
    """Chunks of up to 400 signs of the documents' lines."""
    return chunking.exploded(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", 400, 40, compose=False).select("doc_id", "chunk_index", "chunk")


@query()
def stage_totals(spark, sf_dir):
    """The stages in a row over the whole tables, with the hashing backend and an offline model: normalise, evidence, retrieval, rewriting, QA, export; their reports."""
    from ..session import stored

    queries, _ = normalise.two_way(stored(normalise.queries(_raw_queries(spark, sf_dir)), "stage-queries"))
    answers, _ = normalise.two_way(stored(normalise.answers(_raw_answers(spark, sf_dir)), "stage-answers"))
    found_faults, set_aside = normalise.two_way(stored(normalise.faults(_raw_faults(spark, sf_dir)), "stage-faults"))
    docs, _ = normalise.two_way(stored(normalise.documents(table(spark, sf_dir, "d4_documents").drop("char_count")), "stage-documents"))
    wide = lambda df, c, source: df.select(F.col(c).alias("record_id"), F.lit(source).alias("source"), "split", "text", "powertrain", "system").dropDuplicates(["record_id"])
    qa_text = answers.withColumn("text", F.concat(F.lit("Question: "), "question", F.lit("\n\nAnswer: "), "answer"))
    evidence_rows = stored(pipeline.build_evidence([wide(qa_text, "evidence_source_id", "d2"), wide(found_faults, "evidence_source_id", "d3"), wide(docs, "document_id", "d4")]), "stage-evidence")
    asked = queries.dropDuplicates(["query_id"])
    asked = stored(asked.withColumns({"symptom": X.key(F.col("query")), "context": X.key(normalise.joined(F.col("instruction"), F.col("query")))}), "stage-asked")
    results = stored(pipeline.retrieve(asked, evidence_rows, embedding.hashing_encoder(), retrieval.RetrievalConfig(min_score=0.2)), "stage-retrieval")
    answer = {"route": "no_evidence", "answer": "目前的资料还不足以判断。请先记录出现的条件、次数和仪表提示,再把车辆交给有资质的人员逐项确认,结果出来之前先停用。", "reason": "", "selected_evidence_ids": []}
    rewritten = stored(pipeline.rewrite(results, asked, evidence_rows, generation.constant_provider(answer)), "stage-rewrites")
    made = {"usable": True, "question": "这条记录反映了什么问题?请说明检查的顺序。", "answer": "应先核对现象和出现的条件,再按照记录中的顺序确认相关部件、线路和测量结果,逐项排除后再作判断。"}
    qa = stored(pipeline.evidence_qa(evidence_rows, rewritten, generation.constant_provider(made)), "stage-qa")
    candidates = stored(pipeline.generated_candidates(rewritten, qa, asked, with_mock=True, mock=True), "stage-candidates")
    samples, refused, review = pipeline.export_sft([candidates], risks=pipeline.evidence_risks(evidence_rows))
    name = lambda df, stage: df.select(F.lit(stage).alias("stage"), "section", "label", "n")
    parts = [
        name(reports.normalise_report(normalise.with_kept(set_aside, [])), "faults set aside"),
        name(reports.retrieval_report(results.withColumn("candidates", F.transform("candidates", lambda c: F.struct(c["evidence_id"].alias("evidence_id"), F.lit("all").alias("source")))), reason="reason"), "retrieval"),
        name(reports.tallies(rewritten, {"route": F.col("route"), "error": F.col("errors")}), "rewriting"),
        name(reports.tallies(qa, {"source": F.col("source"), "error": F.col("errors")}), "qa"),
        name(reports.export_report(candidates, refused, samples, review), "export"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

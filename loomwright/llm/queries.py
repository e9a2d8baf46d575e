"""Named queries of this package over the test tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .components import connected_components
from . import cross_split as cs, near_duplicates as nd
from .forms import consistent_forms, same_look_classes, same_look_records
from .frames import collection, nonblank, read
from .leakage import leaks
from .packing import fill_report, pack
from .quality import agreement, quality
from .shared_spans import shared_spans
from .splitting import SplitConfig, split_texts
from .tokens import language_tag, token_budget

QUERIES: dict = {}
SQL: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


_BLANK = r"[\t\n\x0b\f\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{1c}-\x{1f}]"
SQL["p2_found"] = f"""
WITH t AS (SELECT document_id, max(text) AS text FROM d4_documents WHERE text IS NOT NULL GROUP BY 1),
s AS (SELECT document_id, string_split_regex(regexp_replace(text, '[.]({_BLANK})', chr(10) || '\\1', 'g'), '[\\n\\r。！？；!?;]') AS parts FROM t WHERE length(text) > 2000 AND regexp_matches(text, '[^' || '{_BLANK[1:]}'))
SELECT document_id, CASE WHEN list_max(list_transform(parts, lambda x: length(x))) > 2000 THEN 'forced' ELSE 'natural' END AS kind FROM s
"""


def records(spark, sf_dir: str) -> DataFrame:
    """The technical documents, one row per record: the last extracted, ties by file.

    The row is chosen on narrow columns; rows equal in these are one by their text's hash.
    """
    df = read(spark, sf_dir, "d4_documents").where("document_id is not null")
    place = F.struct(F.coalesce(F.col("extracted_at").cast("string"), F.lit("")).alias("t"), F.coalesce("source_file", F.lit("")).alias("f"), F.xxhash64("text").alias("h"))
    last = df.select("document_id", place.alias("p")).groupBy("document_id").agg(F.max("p").alias("p"))
    several = df.groupBy("document_id").agg(F.count("*").alias("n")).where("n > 1").select("document_id")
    once = df.join(several, "document_id", "left_anti")
    chosen = df.withColumn("p", place).join(several, "document_id", "left_semi").join(last, ["document_id", "p"], "left_semi").drop("p").dropDuplicates(["document_id"])
    return once.unionByName(chosen)


@query
def p5_found(spark, sf_dir: str) -> DataFrame:
    return nd.record_pairs(*nd.near_duplicates(read(spark, sf_dir, "d4_documents")))


@query
def p5_groups(spark, sf_dir: str) -> DataFrame:
    """One row per record that has a near-duplicate or copy: its group and the number of linked records."""
    members, links = nd.near_duplicates(read(spark, sf_dir, "d4_documents"))
    sizes = members.groupBy("k1").agg(F.count("*").alias("copies"))
    ends = links.select("a", "b").union(links.select("b", "a")).toDF("k1", "other")
    linked = ends.join(sizes.toDF("other", "n"), "other").groupBy("k1").agg(F.sum("n").alias("near"))
    groups = connected_components(links).toDF("k1", "component")
    rows = (
        members.join(sizes, "k1").join(linked, "k1", "left").join(groups, "k1", "left")
        .select(F.col("id").alias("document_id"), F.coalesce("component", "k1").alias("group_id"), (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("links"))
    )
    return rows.where("links > 0")


@query
def p2_pieces(spark, sf_dir: str) -> DataFrame:
    return split_texts(records(spark, sf_dir)).withColumnRenamed("id", "document_id")


@query
def p2_found(spark, sf_dir: str) -> DataFrame:
    """Records that had to be cut, read off their first piece."""
    limit = SplitConfig().limit
    rows = split_texts(read(spark, sf_dir, "d4_documents").where(nonblank()), with_text=False).where(f"piece_no > 0 or n_chars > {limit}")
    kind = F.when(F.max("forced"), "forced").otherwise("natural").alias("kind")
    return rows.groupBy(F.col("id").alias("document_id")).agg(kind)


@query
def p4_forms(spark, sf_dir: str) -> DataFrame:
    """Every row with text, title and literals in their consistent form."""
    df = read(spark, sf_dir, "d4_documents").select("document_id", "title", "text", "literals", "split", "source_file")
    return consistent_forms(df, ["title", "text"], ["literals"], "text")


@query
def p4_classes(spark, sf_dir: str) -> DataFrame:
    """Spellings of texts of one look, with their numbers of records."""
    return same_look_classes(read(spark, sf_dir, "d4_documents"))


@query
def p4_found(spark, sf_dir: str) -> DataFrame:
    return same_look_records(read(spark, sf_dir, "d4_documents"))


@query
def p6_quality(spark, sf_dir: str) -> DataFrame:
    return quality(read(spark, sf_dir, "d4_documents")).withColumnRenamed("id", "document_id")


@query
def p6_found(spark, sf_dir: str) -> DataFrame:
    rows = quality(read(spark, sf_dir, "d4_documents").where(nonblank()))
    return rows.groupBy(F.col("id").alias("document_id")).agg(F.min("kind").alias("kind")).where("kind in ('list', 'table', 'junk')")


@query
def p6_agreement(spark, sf_dir: str) -> DataFrame:
    """Kinds against the reviewers' majority."""
    df = read(spark, sf_dir, "d4_documents").where(nonblank())
    return agreement(quality(df), read(spark, sf_dir, "d4_labels"))


@query
def p8_leaks(spark, sf_dir: str) -> DataFrame:
    """Leaked test items with their longest unbroken passage, how near their terms stand, and the kind of match."""
    rows = leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return rows.withColumnRenamed("doc", "doc_id").withColumnRenamed("item", "item_id")


@query
def p8_found(spark, sf_dir: str) -> DataFrame:
    return p8_leaks(spark, sf_dir).where("match <> 'proximity'").select("doc_id", "item_id")


@query
def p9_shared(spark, sf_dir: str) -> DataFrame:
    """For each doc how much of its text also stands elsewhere."""
    return shared_spans(read(spark, sf_dir, "documents")).withColumnRenamed("doc", "doc_id")


@query
def p9_found(spark, sf_dir: str) -> DataFrame:
    return p9_shared(spark, sf_dir).where("shared > 0").select("doc_id")


@query
def p1_found(spark, sf_dir: str) -> DataFrame:
    rows = cs.overlapping_pairs(*cs.cross_split(read(spark, sf_dir, "d4_documents")))
    return rows.select("split", "document_id_a", "document_id_b")


@query
def p1_classes(spark, sf_dir: str) -> DataFrame:
    """The same links between classes of equal texts, with their numbers of records."""
    return cs.overlapping_classes(*cs.cross_split(read(spark, sf_dir, "d4_documents")))


@query
def p1_report(spark, sf_dir: str) -> DataFrame:
    """Evaluation records found in training texts, by split and source collection."""
    df = read(spark, sf_dir, "d4_documents")
    return cs.overlap_report(df, *cs.cross_split(df), collection())


@query
def p7_windows(spark, sf_dir: str) -> DataFrame:
    """Every text of documents in windows of each capacity."""
    rows = pack(read(spark, sf_dir, "documents"), read(spark, sf_dir, "packing_targets"))
    return rows.withColumnRenamed("id", "doc_id").withColumnRenamed("bin", "window_id")


@query
def p7_fill(spark, sf_dir: str) -> DataFrame:
    targets = read(spark, sf_dir, "packing_targets")
    return fill_report(pack(read(spark, sf_dir, "documents"), targets), targets)


@query
def p3_budget(spark, sf_dir: str) -> DataFrame:
    """Documents, characters and tokens per source collection, language and system."""
    slices = {"source": collection(), "language": language_tag(F.col("language")), "system": F.col("system")}
    return token_budget(read(spark, sf_dir, "d4_documents"), "document_id", "text", "extracted_at", slices)

"""Texts and literals in one consistent form, and records that only look the same.

The form is :func:`lookalike.same_look`.  Null text and null literals stay null,
null entries of literals stay null, an empty list stays empty.  Records with
several rows are compared by all their rows; a record never pairs with itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .batches import spread, text_slices
from .frames import nonblank
from .grams import text_hash
from .lookalike import codes, fold, same_look, same_looks, script_report


def consistent_forms(df: DataFrame, text_cols: list[str], list_cols: list[str], report: str | None = None) -> DataFrame:
    """The frame with the named columns in their consistent form; all other columns as they are.

    ``report`` names a text column whose tokens are looked at before they change: ``mixed_script`` counts those whose
    letters have no script in common, ``whole_script`` those of one other script that Latin can spell as a whole.
    """
    def work(batches):
        for batch in batches:
            arrays = {n: batch.column(n) for n in batch.schema.names}
            if report:
                mixed, whole_script = zip(*map(script_report, batch.column(report).to_pylist())) if batch.num_rows else ((), ())
            for c in text_cols:
                out = []
                whole = batch.column(c).to_pylist()
                for rows, _ in text_slices(batch, c):
                    out += same_looks(whole[rows])
                arrays[c] = pa.array(out, pa.string())
            for c in list_cols:
                values = batch.column(c).to_pylist()
                arrays[c] = pa.array([None if v is None else [same_look(x) for x in v] for v in values], pa.list_(pa.string()))
            if report:
                arrays |= {"mixed_script": pa.array(mixed, pa.int32()), "whole_script": pa.array(whole_script, pa.int32())}
            yield pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))

    kinds = {f.name: f for f in df.schema.fields}
    schema = T.StructType([T.StructField(n, f.dataType, True) for n, f in kinds.items()])
    if report:
        df = df.drop("mixed_script", "whole_script")
        schema = T.StructType([f for f in schema.fields if f.name in df.columns] + [T.StructField(n, T.IntegerType(), True) for n in ("mixed_script", "whole_script")])
    return df.mapInArrow(work, schema)


def look_hashes(df: DataFrame, id_col: str, text_col: str, list_col: str) -> DataFrame:
    """id, hashes of the form (l1, l2) and of the raw text (r1, r2), and whether two unequal entries of the list look the same."""
    source = spread(df.where(nonblank(text_col) & F.col(id_col).isNotNull())).select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(list_col).alias("entries")
    )

    def twins(entries) -> bool:
        distinct = {e for e in entries or () if e is not None}
        return len({same_look(e) for e in distinct}) < len(distinct)

    def work(batches):
        for batch in batches:
            for rows, texts in text_slices(batch, "text"):
                part = batch.slice(rows.start, rows.stop - rows.start)
                x, bounds = fold(texts, "look")
                l1, l2 = text_hash(x, bounds)
                r1, r2 = text_hash(*codes(texts))
                entries = [twins(e) for e in part.column("entries").to_pylist()]
                out = pa.RecordBatch.from_arrays(
                    [part.column("id"), *map(pa.array, (l1, l2, r1, r2)), pa.array(entries)], names=["id", "l1", "l2", "r1", "r2", "twins"]
                )
                yield out.filter(pa.array(np.diff(bounds) > 0))

    return source.mapInArrow(work, "id string, l1 long, l2 long, r1 long, r2 long, twins boolean")


def same_look_classes(df: DataFrame, id_col: str = "document_id", text_col: str = "text", list_col: str = "literals") -> DataFrame:
    """look, spelling, spellings, records: every spelling of a look that has several, with its number of records; nothing is paired."""
    rows = look_hashes(df, id_col, text_col, list_col)
    spellings = rows.groupBy("l1", "l2", "r1", "r2").agg(F.count_distinct("id").alias("records"))
    several = spellings.groupBy("l1", "l2").agg(F.count("*").alias("spellings")).where("spellings > 1")
    name = lambda a, b: F.concat(F.lower(F.hex(a)), F.lower(F.hex(b)))
    return spellings.join(several, ["l1", "l2"]).select(name("l1", "l2").alias("look"), name("r1", "r2").alias("spelling"), "spellings", "records")


def same_look_records(df: DataFrame, id_col: str = "document_id", text_col: str = "text", list_col: str = "literals") -> DataFrame:
    """field, document_id_a, document_id_b: unequal texts of one look, and records with unequal literals of one look."""
    rows = look_hashes(df, id_col, text_col, list_col)
    # spellings of each look; copies of one spelling meet other spellings only, never each other
    spellings = rows.groupBy("l1", "l2", "r1", "r2").agg(F.count("*").alias("n")).drop("n")
    several = spellings.groupBy("l1", "l2").agg(F.count("*").alias("n")).where("n > 1").select("l1", "l2")
    # few records have twins, so members are cut down before any join
    members = rows.select("id", "l1", "l2", "r1", "r2").join(several, ["l1", "l2"], "left_semi").distinct()
    other = members.select(F.col("id").alias("other"), "l1", "l2", F.col("r1").alias("o1"), F.col("r2").alias("o2"))
    pairs = members.join(other, ["l1", "l2"]).where("id <> other and (r1 < o1 or (r1 = o1 and r2 < o2))")
    texts = pairs.select(F.lit("text").alias("field"), F.least("id", "other").alias("document_id_a"), F.greatest("id", "other").alias("document_id_b"))
    literals = rows.where("twins").select(F.lit("literals").alias("field"), F.col("id").alias("document_id_a"), F.col("id").alias("document_id_b"))
    return texts.union(literals).distinct()

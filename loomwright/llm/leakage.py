"""Test items that leak into training texts: a stored positional inverted index, searched from the rarest terms.

Terms are runs of ``q`` letters and digits of the same-look form in lower case (blanks,
line breaks and punctuation do not count), thinned by winnowing: every passage of
``least`` signs keeps at least one term that depends on nothing but the passage.  The
index (term, doc, position) holds the training texts and nothing of the items, so that it
is built once and serves every later set of items.  It is partitioned by document, each
partition sorted by term: building it shuffles nothing, a term that stands in every
document is spread over all partitions, and the few terms of the items go to the postings.

Each item is searched from its rarest terms:

* any passage of at least ``share`` of an item holds a whole window of its terms; of each
  window the term with the fewest postings is an anchor;
* a document that holds at least ``share`` of the terms, in whatever order, holds one of
  the rarest ``n - ceil(share n) + 1`` of them: these are anchors too;
* the lists of the other terms are intersected with the documents of the anchors;
  position minus offset gives the shifts at which item and text are laid side by side, and
  the longest run of equal signs is the unbroken passage;
* the greatest share of the terms within ``span`` times the item's size is the proximity.

Items with passages shorter than ``least`` have no such window: all their passages of the
needed length go into one automaton for each length, which scans the texts.  So a short
item changes nothing for the others.

Null and sign-less texts and items never match.  Repeated doc rows count once, equal items
match alike.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import shared_dir, stored
from .automaton import Automaton
from .batches import spread, text_slices
from .lookalike import codes, fold
from .shared_spans import winnow


@dataclass(frozen=True)
class LeakConfig:
    share: float = 0.5
    q: int = 10
    least: int = 24
    #: proximity looks at stretches of so many times the item's size
    span: float = 2.0
    #: terms of the items up to this many are sent to the postings, more meet them in a shuffle
    broadcast_terms: int = 200_000
    #: candidates up to this many bytes are sent to the texts, more meet them in a shuffle
    broadcast_bytes: int = 16 << 20


def _terms(df: DataFrame, id_col: str, text_col: str, cfg: LeakConfig) -> DataFrame:
    """id, term, pos: the winnowed terms of every text."""
    source = spread(df.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull())).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def work(batches):
        for batch in batches:
            for rows, texts in text_slices(batch, "text"):
                x, bounds = fold(texts, "alnum")
                at, h = winnow(x, bounds, cfg.q, cfg.least)
                owner = np.searchsorted(bounds, at, side="right") - 1
                ids = batch.column("id").slice(rows.start, rows.stop - rows.start).take(pa.array(owner))
                yield pa.RecordBatch.from_arrays([ids, pa.array(h.view(np.int64)), pa.array((at - bounds[owner]).astype(np.int32))], names=["id", "term", "pos"])

    return source.mapInArrow(work, f"id {source.schema['id'].dataType.simpleString()}, term long, pos int")


@dataclass(frozen=True)
class PositionalIndex:
    """Postings (term, doc, pos) in a folder, for items of passages from ``cfg.least`` signs on."""

    spark: SparkSession
    path: str
    cfg: LeakConfig = LeakConfig()

    @classmethod
    def build(cls, docs: DataFrame, doc_id: str = "doc_id", text_col: str = "text", cfg: LeakConfig = LeakConfig(), path: str | None = None) -> PositionalIndex:
        spark = docs.sparkSession
        path = path or f"{shared_dir(spark)}/leak-index-{uuid.uuid4().hex[:12]}"
        postings = _terms(docs, doc_id, text_col, cfg).withColumnRenamed("id", "doc")
        postings.sortWithinPartitions("term").write.option("compression", "zstd").parquet(path)
        return cls(spark, path, cfg)

    def postings(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def lists(self, terms: DataFrame, few: bool) -> DataFrame:
        """The postings of the given terms (term and other columns)."""
        return self.postings().join(F.broadcast(terms) if few else terms, "term")


def folded_items(items: DataFrame, item_id: str, text_col: str, share: float) -> DataFrame:
    """item, folded, size, need (signs of the shortest passage that counts)."""
    source = items.where(F.col(text_col).isNotNull() & F.col(item_id).isNotNull()).select(F.col(item_id).alias("item"), F.col(text_col).alias("text"))

    def work(batches):
        for batch in batches:
            for rows, texts in text_slices(batch, "text"):
                x, bounds = fold(texts, "alnum")
                whole = x.tobytes().decode("utf-32-le", "surrogatepass")
                folded = [whole[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                yield pa.RecordBatch.from_arrays([batch.column("item").slice(rows.start, rows.stop - rows.start), pa.array(folded, pa.string())], names=["item", "folded"])

    sized = source.mapInArrow(work, f"item {source.schema['item'].dataType.simpleString()}, folded string").withColumn("size", F.length("folded"))
    return sized.where("size > 0").distinct().withColumn("need", F.greatest(F.lit(1), F.ceil(F.col("size") * F.lit(share)).cast("int")))


def anchors_of(terms: DataFrame, cfg: LeakConfig) -> DataFrame:
    """item, term: the rarest term of every window that a passage holds, and the rarest that proximity can't do without."""

    def rarest(pdf):
        pdf = pdf.sort_values("off")
        off, postings = pdf["off"].to_numpy(), pdf["postings"].to_numpy()
        need, size = int(pdf["need"].iloc[0]), int(pdf["size"].iloc[0])
        lo = np.searchsorted(off, np.arange(size - need + 1))
        hi = np.searchsorted(off, np.arange(size - need + 1) + need - cfg.q, side="right")
        chosen = {a + int(np.argmin(postings[a:b])) for a, b in set(zip(lo.tolist(), hi.tolist())) if a < b}
        n = len(pdf)
        chosen |= set(np.argsort(postings, kind="stable")[: n - int(np.ceil(cfg.share * n)) + 1].tolist())
        return pdf.iloc[sorted(chosen)][["item", "term"]]

    return terms.groupBy("item").applyInPandas(rarest, f"item {terms.schema['item'].dataType.simpleString()}, term long").distinct()


def longest_equal(x: np.ndarray, y: np.ndarray, shift: int) -> int:
    """Length of the longest run of equal signs of ``y`` laid ``shift`` signs into ``x``."""
    lo, hi = max(0, -shift), min(len(y), len(x) - shift)
    if hi <= lo:
        return 0
    apart = np.flatnonzero(x[lo + shift : hi + shift] != y[lo:hi])
    return int(np.diff(np.concatenate([[-1], apart, [hi - lo]])).max()) - 1


def closest(off: np.ndarray, pos: np.ndarray, width: int) -> int:
    """Most different offsets among the positions of one stretch of ``width`` signs."""
    order = np.argsort(pos, kind="stable")
    off, pos = off[order].tolist(), pos[order].tolist()
    held: dict[int, int] = {}
    best = a = 0
    for b, o in enumerate(off):
        held[o] = held.get(o, 0) + 1
        while pos[b] - pos[a] >= width:
            held[off[a]] -= 1
            if not held[off[a]]:
                del held[off[a]]
            a += 1
        best = max(best, len(held))
    return best


def _weighed(docs: DataFrame, places: DataFrame, doc_id: str, text_col: str, cfg: LeakConfig) -> DataFrame:
    """doc, item, longest, near of the candidates, on the texts themselves."""
    bulk = places.agg(F.coalesce(F.sum(F.aggregate("places", F.lit(32), lambda n, p: n + 32 + F.length(p["folded"]) * 3 + F.size(p["at"]) * 16)), F.lit(0))).first()[0]
    few = bulk <= cfg.broadcast_bytes
    kind_d, kind_i = places.schema["doc"].dataType.simpleString(), places.schema["places"].dataType.elementType["item"].dataType.simpleString()
    source = docs.where(F.col(text_col).isNotNull()).select(F.col(doc_id).alias("doc"), F.col(text_col).alias("text")).join(F.broadcast(places) if few else places, "doc")

    def work(batches):
        for batch in batches:
            rows, items, longest, near = [], [], [], []
            found = batch.column("places").to_pylist()
            for part, texts in text_slices(batch, "text"):
                x, bounds = fold(texts, "alnum")
                for i in range(part.start, part.stop):
                    own = x[bounds[i - part.start] : bounds[i - part.start + 1]]
                    for f in found[i]:
                        y = codes([f["folded"]])[0]
                        off, pos = (np.array([p[c] for p in f["at"]], dtype=np.int64) for c in ("off", "pos"))
                        rows.append(i), items.append(f["item"])
                        longest.append(max(longest_equal(own, y, s) for s in np.unique(pos - off).tolist()))
                        near.append(closest(off, pos, int(cfg.span * len(y))) / f["terms"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(pa.array(rows, pa.int64())), pa.array(items, batch.schema.field("places").type.value_type.field("item").type), pa.array(longest, pa.int32()), pa.array(near, pa.float64())],
                names=["doc", "item", "longest", "near"],
            )

    return source.mapInArrow(work, f"doc {kind_d}, item {kind_i}, longest int, near double")


def _short_items(docs: DataFrame, items: DataFrame, doc_id: str, text_col: str) -> DataFrame | None:
    """doc, item, longest for items whose passages are shorter than any indexed one; None where there are none."""
    rows = items.toPandas()  # bounded: texts of less than twice ``least`` signs that are test items
    if not len(rows):
        return None
    kind = items.schema["item"].dataType.simpleString()
    automata = []
    for need, own in rows.groupby("need"):
        x, bounds = codes(own["folded"].tolist())
        at = np.concatenate([np.arange(a, b - need + 1) for a, b in zip(bounds[:-1], bounds[1:])])
        automaton, pattern = Automaton.build(x, at, int(need))
        owners: list[set] = [set() for _ in range(automaton.patterns)]
        for p, a in zip(pattern.tolist(), at.tolist()):
            owners[p].add(int(np.searchsorted(bounds, a, side="right")) - 1)
        automata.append((automaton, owners, own["item"].tolist(), own["folded"].tolist()))
    shared = docs.sparkSession.sparkContext.broadcast(automata)
    source = spread(docs.where(F.col(text_col).isNotNull() & F.col(doc_id).isNotNull())).select(F.col(doc_id).alias("doc"), F.col(text_col).alias("text"))

    def most(text: str, item: str, need: int) -> int:
        """The longest passage of the item in the text, of which ``need`` signs are known to be there."""
        for n in range(len(item), need, -1):
            if any(item[k : k + n] in text for k in range(len(item) - n + 1)):
                return n
        return need

    def work(batches):
        for batch in batches:
            docs_of, items_of, longest = [], [], []
            for part, texts in text_slices(batch, "text"):
                x, bounds = fold(texts, "alnum")
                whole = x.tobytes().decode("utf-32-le", "surrogatepass")
                for automaton, owners, ids, folded in shared.value:
                    at, p = automaton.scan(x, bounds)
                    hits = {(int(t), i) for t, q in set(zip((np.searchsorted(bounds, at, side="right") - 1).tolist(), p.tolist())) for i in owners[q]}
                    for t, i in sorted(hits):
                        docs_of.append(part.start + t), items_of.append(ids[i])
                        longest.append(most(whole[bounds[t] : bounds[t + 1]], folded[i], automaton.length))
            yield pa.RecordBatch.from_pydict({"doc": batch.column("doc").take(pa.array(docs_of, pa.int64())), "item": items_of, "longest": pa.array(longest, pa.int32())}, schema=pa.schema([("doc", batch.schema.field("doc").type), ("item", pa.from_numpy_dtype(rows["item"].dtype) if rows["item"].dtype != object else pa.string()), ("longest", pa.int32())]))

    return source.mapInArrow(work, f"doc {source.schema['doc'].dataType.simpleString()}, item {kind}, longest int").select("doc", "item", "longest", F.lit(0.0).alias("near"))


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text_col: str = "text", cfg: LeakConfig = LeakConfig(), index: PositionalIndex | None = None) -> DataFrame:
    """doc, item, longest (signs of the longest unbroken passage), size (of the item), near, match: whole, passage or proximity."""
    index = index or PositionalIndex.build(docs, doc_id, text_col, cfg)
    tests = stored(folded_items(items, item_id, text_col, cfg.share), "leak-items")
    long = tests.where(F.col("need") >= cfg.least)
    terms = _terms(long, "item", "folded", cfg).select(F.col("id").alias("item"), "term", F.col("pos").alias("off")).distinct()
    terms = stored(terms.join(long.select("item", "size", "need"), "item"), "leak-terms")
    few = terms.count() <= cfg.broadcast_terms
    counts = index.lists(terms.select("term").distinct(), few).groupBy("term").agg(F.count("*").alias("postings"))
    weighed = terms.join(counts, "term", "left").withColumn("postings", F.coalesce("postings", F.lit(0)))
    anchors = stored(anchors_of(weighed, cfg), "leak-anchors")
    found = stored(index.lists(anchors, few).select("item", "doc").distinct(), "leak-candidates")
    lists = index.lists(terms.select("item", "term", "off"), few).join(found, ["item", "doc"], "left_semi")
    numbers = terms.groupBy("item").agg(F.count_distinct("off").alias("terms"))
    each = lists.groupBy("doc", "item").agg(F.collect_set(F.struct("off", "pos")).alias("at"))  # bounded by the item times the doc
    each = each.join(numbers, "item").join(long.select("item", "folded"), "item")
    places = stored(each.groupBy("doc").agg(F.collect_list(F.struct("item", "folded", "terms", "at")).alias("places")), "leak-places")
    rows = _weighed(docs, places, doc_id, text_col, cfg)
    short = _short_items(docs, tests.where(F.col("need") < cfg.least), doc_id, text_col)
    rows = rows if short is None else rows.unionByName(short)
    best = rows.groupBy("doc", "item").agg(F.max("longest").alias("longest"), F.round(F.max("near"), 6).alias("near"))
    match = F.when(F.col("longest") == F.col("size"), "whole").when(F.col("longest") >= F.col("need"), "passage").when(F.col("near") >= cfg.share, "proximity")
    return best.join(tests.select("item", "size", "need"), "item").withColumn("match", match).where("match is not null").select("doc", "item", "longest", "size", "near", "match")

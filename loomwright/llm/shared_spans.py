"""Long spans that stand verbatim in more than one record: a log-structured fingerprint index.

Fingerprints are hashes of windows of ``window`` characters, thinned by winnowing
so that every span of ``span`` characters or more keeps at least one fingerprint
that depends on nothing but the span itself.  The index (:class:`FingerprintIndex`)
is a list of immutable runs in the shared folder, each hashed into the same fixed
number of buckets and sorted by fingerprint in each, with a manifest from which a
later session opens it.  A new batch is shuffled once, into a run of its own, and
merge-joined with the runs before it, bucket by bucket: history is neither shuffled
nor sorted again.  The matches of the batch are verified on the text, then runs of one
tier are compacted into one of the next once there are more than ``fanout`` of them.

A fingerprint with very many occurrences (found by a sketch of the batch; at most
``hot_fingerprints`` a run) stays out of the buckets, in files of its own that no bucket
limits; it counts as matched wherever it occurs, and the verification decides.

Verification is exact and never pairwise: around each matched fingerprint every
window of ``span`` characters is compared by its content within the group of that
fingerprint.  Equal surroundings are one entry with its least and greatest doc,
so copies cost one entry; groups with more than ``group_limit`` different
surroundings go through a shuffle on the window's hash instead of one task.

Exact copies are collapsed before any of this.  Null texts have no spans.
A span that repeats only inside one record does not count.  Repeated rows of one
id count as one record (the least text wins if they differ).
"""

from __future__ import annotations

import json
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import shared_dir, stored
from .batches import spread, text_slices
from .grams import sliding, text_hash, window_hashes
from .lookalike import codes


@dataclass(frozen=True)
class SpanConfig:
    span: int = 200
    window: int = 100
    batches: int = 3
    fanout: int = 2
    group_limit: int = 512
    #: places of matches up to this many bytes are sent to the texts, more meet them in a shuffle
    broadcast_bytes: int = 16 << 20
    #: occurrences from which a fingerprint of a batch stays out of the buckets
    hot_rows: int = 100_000


def winnow(x: np.ndarray, bounds: np.ndarray, window: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions in x, hashes) of the selected windows; texts shorter than ``span`` have none."""
    w = span - window + 1
    h = window_hashes(x, window)
    if len(h) < w:
        return np.zeros(0, dtype=np.int64), h[:0]
    owner_end = np.repeat(bounds[1:], np.diff(bounds))
    least = sliding(h, w, np.minimum)
    within = np.arange(len(least)) + span <= owner_end[: len(least)]
    least = np.where(within, least, np.uint64(0))
    edge = np.zeros(w - 1, dtype=np.uint64)
    best = sliding(np.concatenate([edge, least, edge]), w, np.maximum)[: len(h)]
    chosen = np.flatnonzero((best == h) & (best > 0))
    # the selecting span must lie in the same text as the window itself
    return chosen, h[chosen]


def fingerprints(df: DataFrame, doc_id: str, text_col: str, batch_col, cfg: SpanConfig) -> DataFrame:
    """doc, batch, h1, h2, size, fps, places: one row per row of the input."""
    source = spread(df.where(F.col(text_col).isNotNull() & F.col(doc_id).isNotNull())).select(F.col(doc_id).alias("doc"), batch_col.cast("int").alias("batch"), F.col(text_col).alias("text"))

    def work(batches):
        for batch in batches:
            for rows, texts in text_slices(batch, "text"):
                x, bounds = codes(texts)
                at, h = winnow(x, bounds, cfg.window, cfg.span)
                cut = np.searchsorted(at, bounds).astype(np.int32)
                owner = np.searchsorted(bounds, at, side="right") - 1
                h1, h2 = text_hash(x, bounds)
                part = batch.slice(rows.start, rows.stop - rows.start)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc"),
                        part.column("batch"),
                        pa.array(h1),
                        pa.array(h2),
                        pa.array(np.diff(bounds).astype(np.int32)),
                        pa.ListArray.from_arrays(cut, pa.array(h.view(np.int64))),
                        pa.ListArray.from_arrays(cut, pa.array((at - bounds[owner]).astype(np.int32))),
                    ],
                    names=["doc", "batch", "h1", "h2", "size", "fps", "places"],
                )

    kind = source.schema["doc"].dataType.simpleString()
    return source.mapInArrow(work, f"doc {kind}, batch int, h1 long, h2 long, size int, fps array<long>, places array<int>")


@contextmanager
def _sorted_buckets(spark: SparkSession):
    """Lets joins rely on the order within the buckets, which hold one file each."""
    key = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@dataclass
class FingerprintIndex:
    """Immutable runs of (fp, doc, pos) in a folder: bucketed by fp and sorted; see the module."""

    spark: SparkSession
    folder: str
    buckets: int = 32
    fanout: int = 2
    hot_rows: int = 100_000
    hot_fingerprints: int = 100
    #: name, tier, hot (its hot fingerprints) of each run
    runs: list[dict] = field(default_factory=list)
    schema: str = ""
    version: int = 0

    @classmethod
    def open(cls, spark: SparkSession, folder: str, **options) -> FingerprintIndex:
        """The index in the folder as its last manifest has it; an empty one where there is none."""
        index = cls(spark, folder, **options)
        path, files = index._files()
        if files.exists(path):
            names = [f.getPath().getName() for f in files.listStatus(path)]
            numbers = [int(n[9:-5]) for n in names if n.startswith("manifest-") and n.endswith(".json")]
            if numbers:
                index.version = max(numbers)
                said = json.loads(spark.read.text(f"{folder}/manifest-{index.version:08d}.json", wholetext=True).first()[0])
                index.buckets, index.runs, index.schema = said["buckets"], said["runs"], said["schema"]
        return index

    def _files(self, name: str = ""):
        sc = self.spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)
        return path, path.getFileSystem(sc._jsc.hadoopConfiguration())

    def commit(self) -> None:
        """The runs as a new manifest, which is there as a whole or not at all."""
        self.version += 1
        part, files = self._files(f"part-{uuid.uuid4().hex}")
        out = files.create(part)
        out.write(bytearray(json.dumps({"buckets": self.buckets, "schema": self.schema, "runs": self.runs}).encode()))
        out.close()
        if not files.rename(part, self._files(f"manifest-{self.version:08d}.json")[0]):
            raise RuntimeError("another writer has changed the index")

    def table(self, run: dict) -> DataFrame:
        """The bucketed part of a run."""
        if not self.spark.catalog.tableExists(run["name"]):
            self.spark.sql(f"CREATE TABLE {run['name']} ({self.schema}) USING parquet CLUSTERED BY (fp) SORTED BY (fp) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{run['name']}'")
        return self.spark.table(run["name"])

    def hot(self, run: dict) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.folder}/{run['name']}-hot")

    def _write(self, rows: DataFrame, tier: int) -> dict:
        top = rows.select(F.expr(f"approx_top_k(fp, {self.hot_fingerprints}, {100 * self.hot_fingerprints})").alias("t")).first()["t"] or []
        run = {"name": f"fp_run_{uuid.uuid4().hex[:16]}", "tier": tier, "hot": sorted(t["item"] for t in top if t["count"] >= self.hot_rows)}
        if run["hot"]:
            rows.where(F.col("fp").isin(run["hot"])).write.option("compression", "zstd").parquet(f"{self.folder}/{run['name']}-hot")
            rows = rows.where(~F.col("fp").isin(run["hot"]))
        rows.repartition(self.buckets, "fp").write.format("parquet").option("compression", "zstd").option("path", f"{self.folder}/{run['name']}").bucketBy(self.buckets, "fp").sortBy("fp").saveAsTable(run["name"])
        return run

    def matches(self, run: dict) -> DataFrame:
        """Occurrences, of the run and of the runs before it, of fingerprints of the run that stand in two docs."""
        new = self.table(run)
        summary = new.groupBy("fp").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
        known, parts = ["s.lo <> s.hi"], []
        everywhere = sorted({h for r in self.runs for h in r["hot"]})
        if everywhere:
            known.append(f"s.fp IN ({', '.join(map(str, everywhere))})")
        for old in self.runs:
            rows = self.table(old)
            parts.append(rows.join(summary.select("fp").hint("merge"), "fp", "left_semi"))
            if run["hot"]:
                parts.append(rows.where(F.col("fp").isin(run["hot"])))
            if old["hot"]:  # at most hot_fingerprints of them
                present = {r["fp"] for r in new.where(F.col("fp").isin(old["hot"])).select("fp").distinct().collect()} | (set(run["hot"]) & set(old["hot"]))
                parts.append(self.hot(old).where(F.col("fp").isin(sorted(present))) if present else self.hot(old).limit(0))
            known.append(f"EXISTS (SELECT /*+ MERGE(o) */ 1 FROM {old['name']} o WHERE o.fp = s.fp)")
        matched = self.spark.sql("SELECT s.fp FROM {s} s WHERE " + " OR ".join(known), s=summary)
        parts.append(new.join(matched.hint("merge"), "fp", "left_semi"))
        if run["hot"]:
            parts.append(self.hot(run))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.select("fp", "doc", "pos")

    def add(self, fresh: DataFrame) -> DataFrame:
        """Take a batch (fp, doc, pos) in; its matches, old and new."""
        self.schema = self.schema or ", ".join(f"{n} {t}" for n, t in fresh.dtypes)
        run = self._write(fresh, 0)
        with _sorted_buckets(self.spark):
            hits = stored(self.matches(run), "span-hits")
        self.runs.append(run)
        self.commit()
        return hits

    def compact(self) -> None:
        """Runs of a tier that has more than ``fanout`` become one of the next tier."""
        tier = 0
        while tier <= max((r["tier"] for r in self.runs), default=-1):
            own = [r for r in self.runs if r["tier"] == tier]
            if len(own) > self.fanout:
                rows = self.table(own[0])
                for r in own[1:]:
                    rows = rows.unionByName(self.table(r))
                for r in own:
                    if r["hot"]:
                        rows = rows.unionByName(self.hot(r))
                merged = self._write(rows, tier + 1)
                self.runs = [r for r in self.runs if r["tier"] != tier] + [merged]
                self.commit()
                for r in own:
                    self.spark.sql(f"DROP TABLE IF EXISTS {r['name']}")
                    for name in (r["name"], f"{r['name']}-hot"):
                        path, files = self._files(name)
                        files.delete(path, True)
            tier += 1

    def close(self) -> None:
        """Forget the tables in the session; the folder stays."""
        for r in self.runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {r['name']}")


def contexts(df: DataFrame, hits: DataFrame, doc_id: str, text_col: str, cfg: SpanConfig) -> DataFrame:
    """fp, doc, pos, left, context: the text around each hit that spans holding it can reach."""
    places = hits.groupBy("doc").agg(F.collect_list(F.struct("fp", "pos")).alias("places"))  # bounded by the doc's length
    places = stored(places, "span-places")
    bulk = places.agg(F.count("*").alias("docs"), F.coalesce(F.sum(F.size("places")), F.lit(0)).alias("n")).first()
    wanted = F.broadcast(places) if 32 * bulk["docs"] + 16 * bulk["n"] <= cfg.broadcast_bytes else places
    source = df.where(F.col(text_col).isNotNull()).select(F.col(doc_id).alias("doc"), F.col(text_col).alias("text")).join(wanted, "doc")
    reach = cfg.span - cfg.window
    kind = source.schema["doc"].dataType.simpleString()

    def work(batches):
        for batch in batches:
            rows, fps, pos, left, context = [], [], [], [], []
            for i, (text, found) in enumerate(zip(batch.column("text").to_pylist(), batch.column("places").to_pylist())):
                for f in found:
                    p = f["pos"]
                    begin = max(0, p - reach)
                    rows.append(i), fps.append(f["fp"]), pos.append(p), left.append(p - begin)
                    context.append(text[begin : p + cfg.window + reach])
            arrays = [batch.column("doc").take(pa.array(rows, pa.int64())), pa.array(fps, pa.int64()), pa.array(pos, pa.int32()), pa.array(left, pa.int32()), pa.array(context, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc", "fp", "pos", "left", "context"])

    return source.mapInArrow(work, f"doc {kind}, fp long, pos int, left int, context string")


def _windows(context: str, span: int) -> list[str]:
    return [context[i : i + span] for i in range(len(context) - span + 1)]


def _ranges(flags: list[bool]) -> list[dict]:
    out, start = [], None
    for i, f in enumerate([*flags, False]):
        if f and start is None:
            start = i
        elif not f and start is not None:
            out.append({"a": start, "b": i - 1})
            start = None
    return out


def _match_groups(span: int):
    """Shared windows of each context, by content, within groups that arrive sorted by fp."""
    schema = "fp long, cid long, ranges array<struct<a:int,b:int>>"

    def close(group):
        seen: dict[str, list] = {}
        cut = [_windows(c, span) for _, c, _, _ in group]
        for (_, _, lo, hi), ws in zip(group, cut):
            for w in ws:
                have = seen.get(w)
                if have is None:
                    seen[w] = [lo, hi]
                else:
                    have[0], have[1] = min(have[0], lo), max(have[1], hi)
        for (cid, _, _, _), ws in zip(group, cut):
            yield cid, _ranges([seen[w][0] != seen[w][1] for w in ws])

    def work(batches):
        current, group = None, []
        for batch in batches:
            fps, cids, ranges = [], [], []

            def flush():
                for cid, r in close(group):
                    if r:
                        fps.append(current), cids.append(cid), ranges.append(r)

            for fp, *entry in zip(*(batch.column(c).to_pylist() for c in ("fp", "cid", "context", "lo", "hi"))):
                if fp != current:
                    flush()
                    current, group = fp, []
                group.append(entry)
            yield _range_batch(fps, cids, ranges)
        fps, cids, ranges = [], [], []
        for cid, r in close(group):
            if r:
                fps.append(current), cids.append(cid), ranges.append(r)
        yield _range_batch(fps, cids, ranges)

    return work, schema


def _range_batch(fps, cids, ranges):
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    return pa.RecordBatch.from_arrays([pa.array(fps, pa.int64()), pa.array(cids, pa.int64()), pa.array(ranges, kind)], names=["fp", "cid", "ranges"])


def _large_groups(entries: DataFrame, span: int) -> DataFrame:
    """The same through a shuffle on the content hash of each window: no task holds a group."""
    places = F.sequence(F.lit(1), F.length("context") - (span - 1))
    rows = entries.where(F.length("context") >= span).select("fp", "cid", "lo", "hi", "context", F.explode(places).alias("i"))
    rows = rows.select("fp", "cid", "lo", "hi", (F.col("i") - 1).alias("a"), F.sha2(F.substring("context", F.col("i"), F.lit(span)), 256).alias("w"))
    shared = rows.groupBy("w").agg(F.min("lo").alias("l"), F.max("hi").alias("h")).where("l <> h").select("w")
    return rows.join(shared, "w", "left_semi").groupBy("fp", "cid").agg(F.collect_list(F.struct(F.col("a"), F.col("a").alias("b"))).alias("ranges"))


def shared_intervals(df: DataFrame, hits: DataFrame, doc_id: str, text_col: str, cfg: SpanConfig) -> DataFrame:
    """doc, start, end: verified spans (overlapping ones not merged)."""
    around = stored(contexts(df, hits, doc_id, text_col, cfg).withColumn("cid", F.xxhash64("context", "left")), "span-contexts")
    entries = around.groupBy("fp", "cid").agg(F.min("context").alias("context"), F.min("doc").alias("lo"), F.max("doc").alias("hi"))
    sizes = entries.groupBy("fp").agg(F.count("*").alias("m"))
    entries = stored(entries.join(sizes, "fp"), "span-entries")
    work, schema = _match_groups(cfg.span)
    small = entries.where(F.col("m") <= cfg.group_limit).select("fp", "cid", "context", "lo", "hi").repartition("fp").sortWithinPartitions("fp")
    ranges = small.mapInArrow(work, schema)
    large = entries.where(F.col("m") > cfg.group_limit)
    if not large.isEmpty():
        ranges = ranges.unionByName(_large_groups(large, cfg.span))
    found = around.select("fp", "cid", "doc", "pos", "left").join(ranges, ["fp", "cid"]).select("doc", (F.col("pos") - F.col("left")).alias("base"), F.explode("ranges").alias("r"))
    return found.select("doc", (F.col("base") + F.col("r.a")).alias("start"), (F.col("base") + F.col("r.b") + cfg.span).alias("end")).distinct()


def merged_length(intervals: DataFrame) -> DataFrame:
    """doc, shared: characters in the union of each doc's intervals."""
    w = Window.partitionBy("doc").orderBy("start", "end")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    gain = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(reach, F.col("start"))))
    return intervals.withColumn("gain", gain).groupBy("doc").agg(F.sum("gain").cast("long").alias("shared"))


def shared_spans(
    df: DataFrame, doc_id: str = "doc_id", text_col: str = "text", order_col: str | None = "crawled_at", cfg: SpanConfig = SpanConfig(), index: FingerprintIndex | None = None, history: DataFrame | None = None
) -> DataFrame:
    """doc, size, shared, share: one row per record with a non-null text.

    Without an index the rows are taken in as ``cfg.batches`` batches by ``order_col``.  With one they are a further batch
    of it, and ``history`` gives the records that are already in it; only their matched texts are read.
    """
    spark = df.sparkSession
    batch, batches = F.lit(0), cfg.batches if order_col and index is None else 1
    if batches > 1:
        key = F.col(order_col)
        key = (key.cast("timestamp") if "timestamp" in dict(df.dtypes)[order_col] else key).cast("double")
        cuts = df.agg(F.percentile_approx(key, [i / batches for i in range(1, batches)], 1000).alias("c")).first()["c"] or []
        for c in cuts:
            batch = batch + F.when(key > c, 1).otherwise(0)
    rows = stored(fingerprints(df, doc_id, text_col, batch, cfg), "span-fingerprints")
    records = rows.groupBy("doc").agg(F.min(F.struct("h1", "h2", "batch", "size")).alias("x")).select("doc", "x.*")
    copies = records.groupBy("h1", "h2").agg(F.min(F.struct("batch", "doc")).alias("first"), F.count("*").alias("n"), F.first("size").alias("size"))
    heads = stored(copies.select(F.col("first.doc").alias("doc"), "h1", "h2", "n", "size"), "span-heads")
    base = rows.join(heads.select("doc", "h1", "h2"), ["doc", "h1", "h2"]).select("doc", "batch", F.explode(F.arrays_zip("fps", "places")).alias("z"))
    base = stored(base.select("batch", F.col("z.fps").alias("fp"), "doc", F.col("z.places").alias("pos")).distinct(), "span-windows")
    texts = df.select(F.col(doc_id).alias(doc_id), F.col(text_col).alias(text_col))
    if history is not None:
        texts = texts.unionByName(history.select(F.col(doc_id).alias(doc_id), F.col(text_col).alias(text_col)))
    own = index or FingerprintIndex.open(spark, f"{shared_dir(spark)}/span-index-{uuid.uuid4().hex[:12]}", buckets=int(spark.conf.get("spark.sql.shuffle.partitions")), fanout=cfg.fanout, hot_rows=cfg.hot_rows)
    spans = None
    for b in range(batches):
        hits = own.add(base.where(F.col("batch") == b).select("fp", "doc", "pos"))
        found = stored(shared_intervals(texts, hits, doc_id, text_col, cfg), "span-intervals")
        spans = found if spans is None else spans.unionByName(found)
        own.compact()
    if index is None:
        own.close()
    lengths = merged_length(spans.distinct() if batches > 1 else spans)
    result = heads.join(lengths, "doc", "left").select("h1", "h2", F.when((F.col("n") > 1) & (F.col("size") >= cfg.span), F.col("size").cast("long")).otherwise(F.coalesce("shared", F.lit(0))).alias("shared"))
    share = F.when(F.col("size") > 0, F.col("shared") / F.col("size")).otherwise(F.lit(0.0))
    return records.join(result, ["h1", "h2"]).select("doc", "size", "shared", share.alias("share"))

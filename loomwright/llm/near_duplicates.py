"""Near-duplicate records: odd sketches over MinHash samples, banded candidates, exact check.

Texts are compared in their same-look form, lower case, without blanks; a text is
the set of its distinct runs of eight characters and a pair counts from a Jaccard
similarity of ``threshold`` on.

1. one pass over the texts gives each row a 128-bit hash of its folded text (its
   *class*: exact copies), a MinHash sample (one-permutation hashing with
   densification, several permutations), the bands of that sample, and the odd
   sketch: a parity bitmap into which the sample is folded;
2. copies are collapsed to their class, so a hot group of copies is one row from here;
3. classes that share a band key are candidates (self-join on the key); a band with many
   members is cut into parts of which each two meet in a task of their own;
4. the XOR population count of two odd sketches estimates the similarity; pairs
   clearly below the threshold end here, before any text is moved;
5. the others are verified on the full run sets.

Null, blank and sign-less texts are never part of a pair.  Texts shorter than a
run have no runs and pair only with equal texts.  A record that has several rows
counts once, with its row of the greatest ``order`` value.  Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stored
from .batches import lists, spread, text_slices
from .frames import nonblank
from .grams import distinct, inside, mix, text_hash, window_hashes
from .lookalike import fold

RUN = 8


@dataclass(frozen=True)
class NearDuplicateConfig:
    threshold: float = 0.6
    bands: int = 50
    rows: int = 5
    permutations: int = 5
    sketch_bits: int = 512
    #: estimated similarity below which a candidate is dropped; some four standard deviations under the threshold
    sketch_floor: float = 0.38
    #: members of a band that meet in one task; larger bands are cut into that many and each two parts meet in a task of their own
    band_members: int = 1000
    #: ids up to this many are sent to the text scan as a broadcast; more go by a shuffle join
    broadcast_ids: int = 200_000

    @property
    def samples(self) -> int:
        return self.bands * self.rows


def minhash(x: np.ndarray, bounds: np.ndarray, cfg: NearDuplicateConfig) -> np.ndarray:
    """uint64 [texts, samples]; texts without runs get arbitrary rows (they are masked by the caller)."""
    n = len(bounds) - 1
    bins = cfg.samples // cfg.permutations
    starts, owner = inside(bounds, RUN, len(x))
    h = window_hashes(x, RUN)[starts] if len(starts) else np.zeros(0, dtype=np.uint64)
    parts = []
    empty = np.uint64(0xFFFFFFFF)
    rng = np.random.default_rng(20231)
    probes = rng.integers(0, bins, size=(64, bins))
    for p in range(cfg.permutations):
        g = mix(h ^ np.uint64((0x9E3779B97F4A7C15 * (2 * p + 1)) & 0xFFFFFFFFFFFFFFFF))
        slot = owner * bins + ((g >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
        sig = np.full(n * bins, empty, dtype=np.uint64)
        np.minimum.at(sig, slot, g & empty)
        sig = sig.reshape(n, bins)
        first, out = sig != empty, sig.copy()
        for attempt in probes:
            rows, cols = np.nonzero(out == empty)
            if not len(rows):
                break
            src = attempt[cols]
            ok = first[rows, src]
            out[rows[ok], cols[ok]] = mix(sig[rows[ok], src[ok]] + np.uint64(1)) & np.uint64(0xFFFFFFFE)
        parts.append(out)
    return np.concatenate(parts, axis=1)


def odd_sketch(sample: np.ndarray, bits: int) -> np.ndarray:
    """int64 [texts, bits / 64]: bit k is the parity of the samples that hash to k."""
    n, k = sample.shape
    where = mix(sample * np.uint64(0x2545F4914F6CDD1D) + np.arange(k, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(bits)
    flat = (np.arange(n)[:, None] * bits + where.astype(np.int64)).ravel()
    parity = (np.bincount(flat, minlength=n * bits) & 1).astype(np.uint8).reshape(n, bits)
    return np.packbits(parity, axis=1, bitorder="little").view(np.int64)


def band_keys(sample: np.ndarray, cfg: NearDuplicateConfig) -> np.ndarray:
    n = len(sample)
    s = sample[:, : cfg.samples].reshape(n, cfg.bands, cfg.rows)
    key = np.broadcast_to(np.arange(cfg.bands, dtype=np.uint64)[None, :] * np.uint64(0xD6E8FEB86659FD93), (n, cfg.bands)).copy()
    for r in range(cfg.rows):
        key = mix(key ^ s[:, :, r] * np.uint64(0x9FB21C651E98DF25))
    return key.view(np.int64)


def signatures(df: DataFrame, id_col: str, text_col: str, order: str | None, cfg: NearDuplicateConfig) -> DataFrame:
    """id, seq, k1, k2 (class), sketch, bands for every row with at least one visible sign."""
    order_col = F.col(order).cast("string") if order else F.lit("")
    source = spread(df.where(nonblank(text_col) & F.col(id_col).isNotNull())).select(
        F.col(id_col).cast("string").alias("id"), F.coalesce(order_col, F.lit("")).alias("seq"), F.col(text_col).alias("text")
    )

    def work(batches):
        for batch in batches:
            for rows, texts in text_slices(batch, "text"):
                x, bounds = fold(texts)
                sizes = np.diff(bounds)
                keep = np.flatnonzero(sizes > 0)
                if not len(keep):
                    continue
                k1, k2 = text_hash(x, bounds)
                sample = minhash(x, bounds, cfg)[keep]
                bands = band_keys(sample, cfg)
                has_runs = sizes[keep] >= RUN
                offsets = np.zeros(len(keep) + 1, dtype=np.int32)
                np.cumsum(np.where(has_runs, cfg.bands, 0), out=offsets[1:])
                part = batch.slice(rows.start, rows.stop - rows.start).take(pa.array(keep))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("seq"),
                        pa.array(k1[keep]),
                        pa.array(k2[keep]),
                        lists(odd_sketch(sample, cfg.sketch_bits)),
                        pa.ListArray.from_arrays(offsets, pa.array(bands[has_runs].ravel())),
                    ],
                    names=["id", "seq", "k1", "k2", "sketch", "bands"],
                )

    return source.mapInArrow(work, "id string, seq string, k1 long, k2 long, sketch array<long>, bands array<long>")


def members_of(rows: DataFrame) -> DataFrame:
    """One row per record: its class.  ``seq`` decides between rows of a record, the hash breaks ties."""
    last = F.max(F.struct("seq", "k1", "k2")).alias("x")
    return rows.groupBy("id").agg(last).select("id", F.col("x.k1").alias("k1"), F.col("x.k2").alias("k2"))


def candidate_pairs(classes: DataFrame, cfg: NearDuplicateConfig) -> DataFrame:
    """Pairs of classes (a < b) that share a band and whose odd sketches look similar enough."""
    keys = classes.select("k1", F.explode("bands").alias("band"))
    sizes = keys.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    # part p of n meets the parts p .. n - 1 as the one side and 0 .. p as the other
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") / cfg.band_members)).cast("int").alias("parts")
    placed = keys.join(sizes.select("band", parts), "band").withColumn("p", F.pmod(F.xxhash64("k1"), F.col("parts")).cast("int"))
    one = placed.select("band", F.col("k1").alias("a"), F.col("p").alias("x"), F.explode(F.sequence(F.col("p"), F.col("parts") - 1)).alias("y"))
    two = placed.select("band", F.col("k1").alias("b"), F.explode(F.sequence(F.lit(0), F.col("p"))).alias("x"), F.col("p").alias("y"))
    met = one.join(two, ["band", "x", "y"]).where("x < y or a < b")
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    sketches = classes.select("k1", "sketch")
    both = pairs.join(sketches.toDF("a", "sa"), "a").join(sketches.toDF("b", "sb"), "b")
    n, k = cfg.sketch_bits, cfg.samples
    # expected XOR count of two sketches whose samples differ in 2 k (1 - J) entries
    most = n / 2 * (1 - (1 - 2 / n) ** (2 * k * (1 - cfg.sketch_floor)))
    differing = sum((F.bit_count(F.col("sa")[i].bitwiseXOR(F.col("sb")[i])) for i in range(n // 64)), F.lit(0))
    return both.where(differing <= F.lit(int(round(most)))).select("a", "b")


def texts_of(df: DataFrame, ids: DataFrame, id_col: str, text_col: str, limit: int) -> DataFrame:
    """k1, text of the records in ``ids`` (id, k1); ids are broadcast while few, joined by shuffle beyond."""
    wanted = F.broadcast(ids) if ids.count() <= limit else ids
    found = df.where(nonblank(text_col)).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).join(wanted, "id")
    return found.groupBy("k1").agg(F.min("text").alias("text"))


def folded_runs(texts: list[str]) -> list[np.ndarray]:
    """Distinct run hashes of each text, folded and hashed together."""
    x, bounds = fold(texts)
    h = window_hashes(x, RUN)
    return [distinct(h[a : max(a, b - RUN + 1)]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def jaccard(pairs: DataFrame) -> DataFrame:
    """a, b, ta, tb -> a, b, similarity on the distinct runs of the folded texts."""

    def work(batches):
        for batch in batches:
            out = []
            for rows, ta in text_slices(batch, "ta"):
                tb = batch.column("tb").slice(rows.start, rows.stop - rows.start).to_pylist()
                p, q = (folded_runs(texts) for texts in (ta, tb))
                for x, y in zip(p, q):
                    both = len(x) + len(y) - len(distinct(np.concatenate([x, y])))
                    out.append(both / max(1, len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out, pa.float64())], names=["a", "b", "similarity"])

    return pairs.select("a", "b", "ta", "tb").mapInArrow(work, "a long, b long, similarity double")


def verified(df: DataFrame, members: DataFrame, pairs: DataFrame, id_col: str, text_col: str, cfg: NearDuplicateConfig, compare=jaccard) -> DataFrame:
    """The pairs of classes whose exact similarity reaches the threshold; ``compare`` turns a, b, ta, tb into a, b, similarity and more."""
    used = pairs.select(F.explode(F.array("a", "b")).alias("k1")).distinct()
    ids = stored(members.join(used, "k1").groupBy("k1").agg(F.min("id").alias("id")), "nd-ids")
    texts = stored(texts_of(df, ids, id_col, text_col, cfg.broadcast_ids), "nd-texts")
    both = pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b")
    return compare(both).where(F.col("similarity") >= cfg.threshold)


def near_duplicates(df: DataFrame, id_col: str = "document_id", text_col: str = "text", order: str | None = "extracted_at", cfg: NearDuplicateConfig = NearDuplicateConfig()) -> tuple[DataFrame, DataFrame]:
    """(members: id, k1) and (links: a, b, similarity between classes, a < b)."""
    rows = stored(signatures(df, id_col, text_col, order, cfg), "nd-signatures")
    members = members_of(rows).select("id", "k1")
    classes = rows.where(F.size("bands") > 0).groupBy("k1").agg(F.first("sketch").alias("sketch"), F.first("bands").alias("bands"))
    pairs = stored(candidate_pairs(classes, cfg), "nd-candidates")
    return members, stored(verified(df, members, pairs, id_col, text_col, cfg), "nd-links")


def record_pairs(members: DataFrame, links: DataFrame) -> DataFrame:
    """All pairs of different records, a < b: equal texts and linked classes."""
    left, right = members.toDF("x", "ka"), members.toDF("y", "kb")
    same = left.join(right, F.col("ka") == F.col("kb")).where("x < y").select("x", "y")
    near = links.select("a", "b").join(left, F.col("a") == F.col("ka")).join(right, F.col("b") == F.col("kb")).select("x", "y")
    return same.union(near).select(F.least("x", "y").alias("document_id_a"), F.greatest("x", "y").alias("document_id_b"))

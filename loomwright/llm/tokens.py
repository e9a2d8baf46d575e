"""Exact token counts under a public byte-pair tokenizer, and token budgets per slice.

A text is cut into pieces by the tokenizer's pattern; tokens never cross pieces.  Pieces
that are one token count at once.  The others are tokenized once in the whole corpus:

1. each task gathers the distinct pieces of its texts, each with the documents that hold
   it and how often (:func:`piece_lists`);
2. these lists are range-partitioned and sorted by piece, so that each partition is a part
   of the prefix trie of all distinct pieces, and equal pieces of all tasks meet
   (:func:`trie_counts`);
3. a partition walks its part of the trie: a node is a prefix, its state is the last token
   of the prefix's encoding and the number of tokens up to it.  The state of a longer
   prefix follows from states already known: exactly one token that ends at the new byte
   is compatible with the last token of the prefix before it (adjacent pairs decide
   whether a token series is the encoding of its text).  Shared prefixes are tokenized
   once; a piece's count is the state of its terminal node;
4. the terminal counts go to the documents on the node's list, and their sums per
   document meet the counts of the first step.

Null text gives a null count, empty text zero.
"""

from __future__ import annotations

import base64
import os
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import stored
from .batches import spread, text_slices

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@dataclass(frozen=True)
class Tokenizer:
    """A rank file (``base64 rank`` per line) and the pattern that cuts pieces."""

    path: str = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    pattern: str = PATTERN


def shipped(df: DataFrame, spec: Tokenizer) -> Tokenizer:
    """The tokenizer, its file sent along to executors that don't have it at its path."""
    df.sparkSession.sparkContext.addFile(spec.path)
    return spec


@lru_cache(maxsize=2)
def ranks_of(path: str) -> dict[bytes, int]:
    if not os.path.exists(path):
        from pyspark import SparkFiles

        path = SparkFiles.get(os.path.basename(path))
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=2)
def encoding(spec: Tokenizer):
    import tiktoken

    return tiktoken.Encoding("public", pat_str=spec.pattern, mergeable_ranks=ranks_of(spec.path), special_tokens={})


class PrefixStates:
    """Token counts of byte strings that come in ascending order, from the states of their shared prefixes."""

    def __init__(self, spec: Tokenizer):
        self.ranks = ranks_of(spec.path)
        self.encoding = encoding(spec)
        self.token = {i: b for b, i in self.ranks.items()}
        self.pairs: dict[int, bool] = {}
        lengths: dict[bytes, set[int]] = {}
        for b in self.ranks:
            lengths.setdefault(b[-2:], set()).add(len(b))
        #: lengths of the tokens of two bytes and more by their last two bytes
        self.lengths = {k: sorted(v, reverse=True) for k, v in lengths.items() if len(k) == 2}
        self.last, self.count, self.before = [-1], [0], b""

    def _compatible(self, left: int, right: int) -> bool:
        key = left << 20 | right
        known = self.pairs.get(key)
        if known is None:
            known = self.encoding._encode_single_piece(self.token[left] + self.token[right]) == [left, right]
            self.pairs[key] = known
        return known

    def _alone(self, token: int) -> bool:
        known = self.pairs.get(-token - 1)
        if known is None:
            known = self.encoding._encode_single_piece(self.token[token]) == [token]
            self.pairs[-token - 1] = known
        return known

    def next(self, b: bytes) -> int:
        """The number of tokens of the next string."""
        ranks, lengths, compatible = self.ranks, self.lengths, self._compatible
        last, count, before = self.last, self.count, self.before
        n, same = min(len(b), len(before)), 0
        while same < n and b[same] == before[same]:
            same += 1
        del last[same + 1 :], count[same + 1 :]
        for i in range(same + 1, len(b) + 1):
            for size in lengths.get(b[i - 2 : i], ()) if i > 1 else ():
                at = i - size
                if at < 0:
                    continue
                token = ranks.get(b[at:i])
                if token is not None and (compatible(last[at], token) if at else self._alone(token)):
                    break
            else:
                at, token = i - 1, ranks[b[i - 1 : i]]
            last.append(token), count.append(count[at] + 1)
        self.before = b
        return count[-1]


@lru_cache(maxsize=2)
def _states(spec: Tokenizer) -> PrefixStates:
    return PrefixStates(spec)


#: postings that a task gathers before it passes its lists on
GATHERED = 1_000_000


def piece_lists(df: DataFrame, text_col: str, spec: Tokenizer) -> DataFrame:
    """Two kinds of rows: documents (row, kept columns, tokens of one-token pieces) and pieces of several tokens (piece, rows, times)."""
    kept = [c for c in df.columns if c != text_col]
    source = spread(df).select(*kept, F.col(text_col).alias(text_col))
    kept_types = [(c, t) for c, t in source.dtypes if c != text_col]
    own = ["__row", "__base", "__piece", "__rows", "__times"]

    def work(batches):
        import regex
        from pyspark import TaskContext

        cut, ranks = regex.compile(spec.pattern).findall, ranks_of(spec.path)
        single: dict[str, bool] = {}
        lists: dict[str, tuple[list[int], list[int]]] = {}
        row = TaskContext.get().partitionId() << 33
        gathered = 0
        schema = None

        def flush():
            pieces = list(lists)
            ends = np.concatenate([[0], np.cumsum([len(lists[p][0]) for p in pieces])]).astype(np.int32)
            rows, times = ([x for p in pieces for x in lists[p][k]] for k in (0, 1))
            arrays = [pa.nulls(len(pieces), f.type) for f in schema]
            arrays += [pa.nulls(len(pieces), pa.int64()), pa.nulls(len(pieces), pa.int64()), pa.array(pieces, pa.string()), pa.ListArray.from_arrays(ends, pa.array(rows, pa.int64())), pa.ListArray.from_arrays(ends, pa.array(times, pa.int32()))]
            lists.clear()
            return pa.RecordBatch.from_arrays(arrays, names=[*(f.name for f in schema), *own])

        for batch in batches:
            schema = [batch.schema.field(c) for c in kept]
            nulls = batch.column(text_col).is_null().to_pylist()
            first, base = row, []
            for part, texts in text_slices(batch, text_col):
                if len(single) > GATHERED:
                    single.clear()
                for t in texts:
                    total = 0
                    for p, n in Counter(cut(t)).items():
                        one = single.get(p)
                        if one is None:
                            one = single[p] = p.encode("utf-8", "surrogatepass") in ranks
                        if one:
                            total += n
                        else:
                            have = lists.get(p)
                            if have is None:
                                have = lists[p] = ([], [])
                            have[0].append(row), have[1].append(n)
                            gathered += 1
                    base.append(total)
                    row += 1
            base = [None if null else b for null, b in zip(nulls, base)]
            arrays = [batch.column(c) for c in kept] + [pa.array(range(first, row), pa.int64()), pa.array(base, pa.int64()), pa.nulls(len(base), pa.string()), pa.nulls(len(base), pa.list_(pa.int64())), pa.nulls(len(base), pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *own])
            if gathered >= GATHERED:
                yield flush()
                gathered = 0
        if lists:
            yield flush()

    columns = [f"`{c}` {t}" for c, t in kept_types] + ["`__row` long", "`__base` long", "`__piece` string", "`__rows` array<long>", "`__times` array<int>"]
    return source.mapInArrow(work, ", ".join(columns))


def trie_counts(lists: DataFrame, spec: Tokenizer) -> DataFrame:
    """row, tokens: of each partition of the trie, what its pieces add to each document."""
    parts = lists.select(F.encode("__piece", "UTF-8").alias("b"), F.col("__rows").alias("rows"), F.col("__times").alias("times"))
    parts = parts.repartitionByRange("b").sortWithinPartitions("b")

    def work(batches):
        states = _states(spec)
        states.last, states.count, states.before = [-1], [0], b""
        before, n = None, 0
        for batch in batches:
            counts = np.zeros(batch.num_rows, dtype=np.int64)
            for i, b in enumerate(batch.column("b").to_pylist()):
                if b != before:
                    n, before = states.next(b), b
                counts[i] = n
            rows, times = batch.column("rows"), batch.column("times")
            sizes = rows.value_lengths().to_numpy()
            total = times.flatten().to_numpy() * np.repeat(counts, sizes)
            found, where = np.unique(rows.flatten().to_numpy(), return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(np.bincount(where, total, minlength=len(found)).astype(np.int64))], names=["row", "n"])

    return parts.mapInArrow(work, "row long, n long")


def token_counts(df: DataFrame, text_col: str = "text", spec: Tokenizer = Tokenizer(), out: str = "tokens") -> DataFrame:
    """The frame without its text column and with the number of tokens of each text."""
    rows = stored(piece_lists(df.drop(out) if out != text_col else df, text_col, shipped(df, spec)), "token-pieces")
    several = trie_counts(rows.where("__piece is not null"), spec).groupBy("row").agg(F.sum("n").alias("n")).toDF("__r", "__n")
    own = rows.where("__row is not null").drop("__piece", "__rows", "__times")
    total = (F.col("__base") + F.coalesce("__n", F.lit(0))).alias(out)
    return own.join(several, F.col("__row") == F.col("__r"), "left").select(*[c for c in own.columns if not c.startswith("__")], total)


def tokenizer_sizes(df: DataFrame, text_col: str = "text", spec: Tokenizer = Tokenizer(), out: str = "tokens") -> DataFrame:
    """As :func:`token_counts`, by the tokenizer library itself (nothing is shuffled)."""
    shipped(df, spec)
    kept = [c for c in df.columns if c not in (text_col, out)]
    source = spread(df).select(*kept, F.col(text_col).alias(text_col))

    def work(batches):
        encode = encoding(spec).encode_ordinary
        for batch in batches:
            totals = [None if t is None else len(encode(t)) for t in batch.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(totals, pa.int64())], names=[*kept, out])

    schema = ", ".join(f"`{c}` {t}" for c, t in source.select(*kept).dtypes) + f"{', ' if kept else ''}`{out}` long"
    return source.mapInArrow(work, schema)


# --- fixed values: language names and codes brought to one tag ---------------------------
LANGUAGE_NAMES = {"chinese": "zh", "zho": "zh", "chi": "zh", "cmn": "zh", "中文": "zh", "english": "en", "eng": "en", "german": "de", "deutsch": "de", "deu": "de", "ger": "de"}
# -----------------------------------------------------------------------------------------


def language_tag(col: Column) -> Column:
    """``zh_cn``, ``zh-CN``, ``ZH``, ``chinese`` -> ``zh``; unknown spellings keep their primary subtag; null and blank -> ``und``."""
    primary = F.regexp_extract(F.lower(F.trim(col)), r"^([^-_]*)", 1)
    named = F.create_map(*[F.lit(x) for kv in LANGUAGE_NAMES.items() for x in kv])
    return F.when(F.coalesce(primary, F.lit("")) == "", "und").otherwise(F.coalesce(named[primary], primary))


def token_budget(df: DataFrame, id_col: str, text_col: str, order: str | None, slices: dict[str, Column], spec: Tokenizer = Tokenizer()) -> DataFrame:
    """documents, chars and tokens per combination of the slices; each record counts once, by its last row."""
    order_col = F.coalesce(F.col(order).cast("string"), F.lit("")) if order else F.lit("")
    named = [c.alias(f"slice_{n}") for n, c in slices.items()]
    rows = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), order_col.alias("seq"), F.length(text_col).cast("long").alias("chars"), *named, F.col(text_col).alias("text"))
    counted = token_counts(rows, "text", spec)
    parts = [f"slice_{n}" for n in slices]
    last = counted.groupBy("id").agg(F.max(F.struct("seq", "tokens", "chars", *parts)).alias("x")).select("x.*")
    return last.groupBy(*[F.col(f"slice_{n}").alias(n) for n in slices]).agg(
        F.count("*").alias("documents"), F.coalesce(F.sum("chars"), F.lit(0)).alias("chars"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")
    )

"""Pieces of bounded length, cut at natural boundaries, with a trailing overlap.

A text longer than ``limit`` is split by a hierarchy of separators: sections
(empty lines), paragraphs (line ends), sentences, words, characters.  A part that
fits stays whole, one that does not is split by the next separator.  The parts are
packed greedily: each piece takes parts while it stays within the limit, and starts
with the last ``overlap`` or fewer characters of the piece before (fewer only where
the next part would not fit otherwise).  All lengths are code points of the stored
text, whatever other columns say; joining the pieces without their overlaps gives
back the text exactly.

Null texts give no piece, blank and short texts give one piece equal to the text.
``cut`` says what the piece ends at: ``end``, ``section``, ``paragraph``,
``sentence``, ``word`` or ``character``; ``forced`` marks texts of which the hierarchy
had to part a stretch between two natural boundaries, as it is itself longer than the limit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .batches import spread

SECTION = re.compile(r"(?:\r\n|\n|\r)[^\S\n\r]*(?:\r\n|\n|\r)+")
PARAGRAPH = re.compile(r"\r\n|\n|\r")
SENTENCE = re.compile(r"[。！？；!?;\n\r]|\.(?=\s)")
WORD = re.compile(r"\s+")
LEVELS = (("section", SECTION), ("paragraph", PARAGRAPH), ("sentence", SENTENCE), ("word", WORD))


@dataclass(frozen=True)
class SplitConfig:
    limit: int = 2000
    overlap: int = 100


def parts(text: str, start: int, end: int, limit: int, level: int = 0) -> Iterator[tuple[int, str]]:
    """(end, what it ends at) of consecutive parts of text[start:end], each within the limit."""
    if level == len(LEVELS):
        for e in range(start + limit, end, limit):
            yield e, "character"
        yield end, "character"
        return
    name, separator = LEVELS[level]
    at = start
    cuts = [(m.start(), m.end()) for m in separator.finditer(text, start, end)]
    if not cuts or cuts[-1][1] < end:
        cuts.append((end, end))
    for stop, after in cuts:
        if after - at <= limit:
            yield after, name
        elif stop - at <= limit and after - stop <= limit:
            if stop > at:
                yield stop, name
            yield after, name
        else:
            last = None
            for last in parts(text, at, after, limit, level + 1):
                if last[0] < after:
                    yield last
            yield after, name if after < end or last is None else last[1]
        at = after


def pieces(text: str, cfg: SplitConfig = SplitConfig()) -> tuple[list[tuple[int, int, int, str]], bool]:
    """(start, end, overlap with the piece before, what it ends at) of each piece, and whether a stretch without boundaries was parted."""
    if len(text) <= cfg.limit:
        return [(0, len(text), 0, "end")], False
    out: list[tuple[int, int, int, str]] = []
    begin, lap, at, how, forced = 0, 0, 0, "end", False
    for end, name in parts(text, 0, len(text), cfg.limit):
        forced = forced or name in ("word", "character")  # below sentences the hierarchy goes only within one stretch
        if end == at:
            continue
        if end - begin > cfg.limit:
            out.append((begin, at, lap, how))
            begin = max(at - cfg.overlap, end - cfg.limit, begin + 1)
            lap = at - begin
        at, how = end, name
    out.append((begin, at, lap, "end"))
    return out, forced


def split_texts(df: DataFrame, id_col: str = "document_id", text_col: str = "text", cfg: SplitConfig = SplitConfig(), with_text: bool = True) -> DataFrame:
    """id, piece_no, start, overlap, n_chars, cut, forced, piece: one row per piece of every non-null text; ``piece`` is left out unless ``with_text``."""
    if not 0 <= cfg.overlap < cfg.limit:
        raise ValueError("0 <= overlap < limit")
    source = spread(df.where(F.col(text_col).isNotNull())).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    names = ["id", "piece_no", "start", "overlap", "n_chars", "cut", "forced"]

    def work(batches):
        for batch in batches:
            rows, no, start, lap, size, cut, forced, piece = [], [], [], [], [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                cuts, hard = pieces(text, cfg)
                for k, (a, b, o, how) in enumerate(cuts):
                    rows.append(i), no.append(k), start.append(a), lap.append(o), size.append(b - a)
                    cut.append(how), forced.append(hard)
                    if with_text:
                        piece.append(text[a:b])
            columns = [pa.array(no, pa.int32()), pa.array(start, pa.int64()), pa.array(lap, pa.int32()), pa.array(size, pa.int32()), pa.array(cut, pa.string()), pa.array(forced, pa.bool_())]
            columns += [pa.array(piece, pa.string())] * with_text
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(rows, pa.int64())), *columns], names=names + ["piece"] * with_text)

    return source.mapInArrow(work, f"id {id_type}, piece_no int, start long, overlap int, n_chars int, cut string, forced boolean" + ", piece string" * with_text)

"""Per-document statistics that tell prose from lists, tables and junk.

Counts and ratios of the text without its title line: length against the stored
count, words, signs, lines, sentence ends, common words; repetition (shares of
duplicate lines and paragraphs, share of the characters that the copies of the most
frequent run of characters cover, longest unit that repeats); shares of lines shaped
like rows of columns or like list entries.  :func:`kind_of` joins them by rules:
repeated short entries are a list however they are strung together, repeated sentences
are boilerplate, and duplicate lines lower what it takes to be a list.

Null text gives a row of nulls and no kind; blank text and a lone title give
zeros and the kind ``prose`` (nothing speaks against it).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .batches import spread, text_slices
from .grams import window_hashes
from .lookalike import codes

# --- fixed values: frequent function words of the languages at hand ---------------------
COMMON_WORDS = {
    "en": "the of and to a in is that for it was on are as with be at by this from or an which not but have had has we if when then also there after were under alone does no its more than".split(),
    "de": "der die das und ist von zu den mit auf für im dem nicht ein eine als auch sich des bei war wurde dass nach aus an unter einer oft dann sich zeigte laut zum vom damit also".split(),
}
COMMON_SIGNS = "的了是在有和与不为以后应再可能由时将到被从会让并仍其他又也这该个已经"
# ----------------------------------------------------------------------------------------
# signs that come from a wrong decoding, replacement signs, and drawing signs
_ODD_SIGNS = set("�□▯◆锟斤拷烫屯葛銆鏄鍦絉殑傜簡ㄤãæçèéÂÃÎƒ†‡ˆ‰Šš‹›ŒœŽžŸ€™˜¡¢£¤¥¦¨ª¬¯´¶¸¹º¿âïðÐ^~\\<>|_*#=+") - set("é")
_COMMON = frozenset(w for ws in COMMON_WORDS.values() for w in ws)

WORD = re.compile(r"[^\W\d_]+")
CJK = re.compile(r"[一-鿿]")
RUN_OF_CJK = re.compile(r"[一-鿿]+")
SENTENCE_END = re.compile(r"[。！？!?]|\.(?=\s|$)")
NUMBER = re.compile(r"[+-]?\d+(?:[.,]\d+)*%?|-|–|—|n/?a|", re.I)
#: a part number or a plain count closes or opens a list entry
CODE = re.compile(r"(?<![A-Za-z0-9])[A-Z]{1,3}\d{2,6}(?![A-Za-z0-9])|(?<=\s)\d{1,5}\s*$|^\d{2,5}\b|[x×]\s?\d+\s*$")
BULLET = re.compile(r"^\s*(?:[-*•·–]\s|\d{1,3}[.)、]\s*|\(\d+\)\s*)")
RULE = re.compile(r"[\s|:+-]+")
COLUMN = (re.compile(r"\s*\|\s*"), re.compile(r"\t"), re.compile(r" {2,}"), re.compile(r"\s*;\s*"), re.compile(r"\s*,(?!\d{3}\b(?![,.]))\s*|,"))
ENTRY_BREAK = re.compile(r"[、,，;；/|]\s*|\s+[-•*·]\s+")
LONG_RUN = re.compile(r"[A-Za-z0-9+/=]{24,}")
LOWER_WORD = re.compile(r"(?<![A-Za-z\-])[a-z]{3,}(?![A-Za-z\-])")
CONSONANTS = re.compile(r"[bcdfghjklmnpqrstvwxz]{6,}")
HEX_PAIR = re.compile(r"(?<![0-9A-Za-z])[0-9a-fA-F]{2}(?=\s|$)")
LATIN_WORD = re.compile(r"[A-Za-zÀ-ɏ]+")
PARAGRAPH = re.compile(r"\n\s*\n")
#: bytes of UTF-8 read as single signs, and signs that a right reading has
MISREAD = re.compile(r"Ã[\x80-\xbf‚„†‡ˆ‰Š‹ŒœŸš›–—€™Žž]|Â[°±²³µ·]|Î[©]|[âÅåæçèé][\x80-\xbf€™œŸ„‚†‡ˆ‰Š‹Œš›Žž]")
FINE = re.compile(r"[öäüßÖÄÜ°Ωμ](?![\x80-\xbf])")
VARIANT = re.compile("[\u00a0\u00ad\u2000-\u200f\u2010\u2011\u202f\u2060\u3000\ufeff\uff01-\uff5e]")
_PLAIN = {o: o - 0xFEE0 for o in range(0xFF01, 0xFF5F)} | dict.fromkeys([0xA0, *range(0x2000, 0x200B), 0x202F, 0x3000], 32)
_PLAIN |= dict.fromkeys([0xAD, *range(0x200B, 0x2010), 0x2060, 0xFEFF], None) | {0x2010: "-", 0x2011: "-"}
SYLLABLE = re.compile(r"[aeiouyäöüåéèáóúæø]", re.I)

STATS = (
    "n_chars int, count_ratio double, n_words int, mean_word double, n_lines int, mean_line double, sign_ratio double, digit_ratio double, "
    "sentence_ends int, lines_ended double, common_ratio double, dup_lines double, dup_paragraphs double, top_run double, "
    "row_share double, entry_share double, odd_share double, kind string"
)
NAMES = [x.split()[0] for x in STATS.split(", ")]


def columns_of(line: str) -> int:
    """Number of fields if the line is a row of columns most of whose fields are values, else 0."""
    if "。" in line or len(line) > 300:
        return 0
    line = line.strip().strip("|").strip(" ")
    fields = line.split()
    if len(fields) >= 5 and all(NUMBER.fullmatch(f) or CODE.fullmatch(f) for f in fields[-4:]):
        return len(fields)
    for separator in COLUMN:
        fields = separator.split(line)
        if len(fields) >= 4:
            values = sum(1 for f in fields[1:] if NUMBER.fullmatch(f.strip()) or CODE.fullmatch(f.strip()))
            if values >= 0.7 * (len(fields) - 1) and max(map(len, fields)) <= 60:
                return len(fields)
    return 0


def entry_like(part: str) -> bool:
    """A short item: a name with a part number or a count, without a verb's function words."""
    part = BULLET.sub("", part).strip()
    if not part or len(part) > 60 or SENTENCE_END.search(part[:-1] if part.endswith(".") else part):
        return False
    bare = CODE.sub("", part).strip(" x×")
    if len(bare) > 45:
        return False
    words = WORD.findall(RUN_OF_CJK.sub(" ", bare))
    if len(words) > 6 or sum(1 for w in words if w.lower() in _COMMON) > 1:
        return False
    return len(CJK.findall(bare)) <= 16


def odd_letters(body: str) -> int:
    """Letters in stretches that no language writes: too long, without vowels, or pairs of hex digits."""
    odd = sum(map(len, LONG_RUN.findall(body)))  # base64, hex: longer than words of any language here
    for w in LOWER_WORD.findall(body):
        if w not in _COMMON:
            vowels = len(SYLLABLE.findall(w))
            if vowels == 0 or len(w) > 5 and (vowels / len(w) < 0.18 or CONSONANTS.search(w)):
                odd += len(w)
    return odd


def dominant_runs(x: np.ndarray, bounds: np.ndarray, n: int = 8) -> np.ndarray:
    """For each text the share of its characters that the copies of its most frequent run of ``n`` characters cover, overlapping ones once; 0 where no run repeats."""
    h, out = window_hashes(x, n), np.zeros(len(bounds) - 1)
    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:] - n + 1)):
        if b - a >= 3 * n:
            order = np.argsort(h[a:b], kind="stable")
            w = h[a:b][order]
            starts = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1], [True]]))
            sizes = np.diff(starts)
            most = int(np.argmax(sizes))
            if sizes[most] > 1:
                at = order[starts[most] : starts[most + 1]]  # ascending
                out[i] = (np.minimum(np.diff(at), n).sum() + n) / (b + n - 1 - a)
    return out


_FLAGS = ("space", "alnum", "digit", "cjk", "common", "odd")
_table: list[np.ndarray] = []


def sign_counts(x: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """Per text the number of signs of each class."""
    if not _table:
        t = np.zeros((0x11000, len(_FLAGS)), dtype=bool)
        for o in [*range(0x3000), *range(0x3000, 0x3400), *range(0xFE00, 0x10000)]:
            c = chr(o)
            t[o, :3] = c.isspace(), c.isalnum(), c.isdigit()
            t[o, 5] = c in _ODD_SIGNS or 0x80 <= o < 0xC0 and c not in "°±²³µ·»«¼½¾§©®×\xa0\xad" or 0x2500 <= o < 0x2600
        t[0x3400:0xFE00, 1] = True
        t[0x4E00:0xA000, 3] = True
        for c in COMMON_SIGNS:
            t[ord(c), 4] = True
        for c in _ODD_SIGNS:
            t[ord(c), 5] = True
        _table.append(np.packbits(t, axis=1, bitorder="little")[:, 0])
    flags = _table[0][np.minimum(x, 0x10FFF)]
    out = {}
    for i, name in enumerate(_FLAGS):
        sums = np.zeros(len(x) + 1, dtype=np.int64)
        np.cumsum((flags >> i) & 1, out=sums[1:])
        out[name] = sums[bounds[1:]] - sums[bounds[:-1]]
    return out


def plain_signs(body: str) -> str:
    """Full-width signs and odd blanks as their plain twins, so that shapes are judged alike in every form."""
    return body.translate(_PLAIN) if VARIANT.search(body) else body


def line_shapes(lines: list[str]) -> tuple[int, int, int]:
    """Characters in all lines, in rows of columns, and in list entries."""
    rows = entries = total = 0
    for line in lines:
        size = len(line)
        total += size
        if "。" in line[:-1] or ". " in line and size > 90:
            continue
        if RULE.fullmatch(line) or columns_of(line):
            rows += size
        elif size <= 80 and entry_like(line):
            entries += size
        else:
            parts = [p for p in ENTRY_BREAK.split(line) if p]
            if len(parts) >= 4:
                coded = sum(1 for p in parts if CODE.search(p))
                if coded >= 0.4 * len(parts):
                    good = sum(len(p) for p in parts if entry_like(p))
                    if good >= 0.8 * sum(map(len, parts)):
                        entries += size
    return total, rows, entries


def stats(texts: list[str | None], stored: list[int | None]) -> list[tuple]:
    """One tuple per text, in the order of NAMES."""
    bodies = ["" if t is None or "\n" not in t else t[t.index("\n") + 1 :] for t in texts]
    x, bounds = codes(bodies)
    n = sign_counts(x, bounds)
    top = dominant_runs(x, bounds)
    result = []
    for i, (text, count, body) in enumerate(zip(texts, stored, bodies)):
        if text is None:
            result.append((None,) * len(NAMES))
            continue
        body = plain_signs(body)
        lines = [v for v in body.split("\n") if v and not v.isspace()]
        paragraphs = [v for v in PARAGRAPH.split(body) if v.strip()]
        dense = len(body) - int(n["space"][i])
        cjk = int(n["cjk"][i])
        words = LATIN_WORD.findall(body)
        n_words = len(words) + cjk
        common = sum(1 for w in words if w in _COMMON or w.lower() in _COMMON) + 2 * int(n["common"][i])
        total, rows, entries = line_shapes(lines)
        pairs = HEX_PAIR.findall(body)
        odd = int(n["odd"][i]) + odd_letters(body) + (2 * len(pairs) if len(pairs) * 4 > dense else 0)
        broken = len(MISREAD.findall(body))
        fine = len(FINE.findall(body)) if broken else 0
        out = {
            "n_chars": len(text),
            "count_ratio": len(text) / count if count and count > 0 else None,
            "n_words": n_words,
            "mean_word": (sum(map(len, words)) + cjk) / n_words if n_words else 0.0,
            "n_lines": len(lines),
            "mean_line": total / len(lines) if lines else 0.0,
            "sign_ratio": (dense - int(n["alnum"][i])) / dense if dense else 0.0,
            "digit_ratio": int(n["digit"][i]) / dense if dense else 0.0,
            "sentence_ends": len(SENTENCE_END.findall(body)),
            "lines_ended": sum(1 for v in lines if v.rstrip()[-1] in "。！？!?.;；:：") / len(lines) if lines else 0.0,
            "common_ratio": common / n_words if n_words else 0.0,
            "dup_lines": 1 - len(set(lines)) / len(lines) if lines else 0.0,
            "dup_paragraphs": 1 - len(set(paragraphs)) / len(paragraphs) if paragraphs else 0.0,
            "top_run": float(top[i]),
            "row_share": rows / total if total else 0.0,
            "entry_share": entries / total if total else 0.0,
            "odd_share": 1.0 if broken >= 3 and fine <= broken // 4 else min(1.0, odd / dense) if dense else 0.0,
        }
        result.append((*out.values(), kind_of(out)))
    return result


def repeated(s: dict) -> bool:
    """Most of the text is said more than once: lines, paragraphs, or one run of characters."""
    return s["n_lines"] >= 4 and s["dup_lines"] >= 0.5 or s["dup_paragraphs"] >= 0.5 or s["top_run"] >= 0.4


def kind_of(s: dict) -> str:
    """prose, boilerplate, list, table or junk."""
    if s["n_lines"] == 0:
        return "prose"
    if s["odd_share"] >= 0.15 and s["common_ratio"] < 0.04 and s["row_share"] + s["entry_share"] < 0.3:
        return "junk"
    if s["odd_share"] >= (0.35 if s["row_share"] < 0.5 else 0.6):
        return "junk"
    if s["row_share"] >= 0.5 and s["row_share"] >= s["entry_share"]:
        return "table"
    if s["entry_share"] >= 0.6 - 0.3 * s["dup_lines"] or s["entry_share"] + s["row_share"] >= 0.75:
        return "list"
    if repeated(s):  # short units are entries, longer ones sentences
        return "list" if s["n_chars"] <= 24 * (s["n_lines"] + s["sentence_ends"]) else "boilerplate"
    return "prose"


def agreement(rows: DataFrame, labels: DataFrame, id_col: str = "document_id", kind_col: str = "kind") -> DataFrame:
    """verdict, kind, records: the kinds found against the majority of the reviewers (ties count for neither), for precision and recall."""
    votes = labels.where(F.col(id_col).isNotNull() & F.col(kind_col).isNotNull()).groupBy(F.col(id_col).alias("id"), F.col(kind_col).alias("verdict")).agg(F.count("*").alias("n"))
    best = votes.groupBy("id").agg(F.max("n").alias("n"))
    clear = votes.join(best, ["id", "n"]).groupBy("id").agg(F.min("verdict").alias("verdict"), F.count("*").alias("tied")).where("tied = 1")
    found = rows.where("kind is not null").groupBy("id").agg(F.min("kind").alias("kind"))
    return clear.join(found, "id").groupBy("verdict", "kind").agg(F.count("*").alias("records"))


def quality(df: DataFrame, id_col: str = "document_id", text_col: str = "text", count_col: str = "char_count") -> DataFrame:
    """id and the statistics of every row."""
    source = spread(df).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(count_col).cast("long").alias("stored"))
    schema = f"id {source.schema['id'].dataType.simpleString()}, {STATS}"
    kinds = {"int": pa.int32(), "double": pa.float64(), "string": pa.string()}
    types = [kinds[x.split()[1]] for x in STATS.split(", ")]

    def work(batches):
        for batch in batches:
            texts, stored = batch.column("text").to_pylist(), batch.column("stored").to_pylist()
            rows = []
            for part, _ in text_slices(batch, "text"):
                rows += stats(texts[part], stored[part])
            columns = list(zip(*rows)) or [()] * len(NAMES)
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(c, t) for c, t in zip(columns, types))], names=["id", *NAMES])

    return source.mapInArrow(work, schema)

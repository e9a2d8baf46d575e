"""One consistent form for text whose characters differ but whose look does not.

The form is built in four steps, each a function of what a reader sees:

1. signs without visible mark go, every kind of blank becomes one space, every
   kind of line end becomes ``\\n``;
2. width and block variants, ligatures, unit signs and radicals are replaced by
   what they stand for, accented letters are composed;
3. for each token the script sets of its letters (:mod:`confusables`) are intersected,
   where a letter that has twins in other scripts may belong to any of them; the token
   is spelt in the script that can spell all of it, Latin first, and where no script can
   (mixed-script spoof such as ``Bоlt``) in the Latin twins;
4. runs of blanks shrink to one, blanks at line ends go.

Superscripts, fractions and circled signs keep their own form: a reader tells
them from plain ones.  Case is kept.

Two implementations share the tables: :func:`same_look` (scalar, used for the
few texts that need steps 2-3 in full) and :func:`fold` (a table gather over
whole Arrow batches).  ``None`` stays ``None``, an empty text stays empty.
"""

from __future__ import annotations

import re
import unicodedata as ud
from functools import lru_cache

import numpy as np

from .confusables import resolved, script_set, twins

# --- fixed values --------------------------------------------------------------------
# simplified radicals that have no compatibility mapping of their own
RADICALS = """
⺟母 ⺠民 ⻁虎 ⻄西 ⻅见 ⻆角 ⻉贝 ⻋车 ⻓长 ⻔门 ⻘青 ⻙韦 ⻚页 ⻛风 ⻜飞 ⻝食 ⻢马 ⻣骨 ⻤鬼 ⻥鱼 ⻦鸟
⻧卤 ⻨麦 ⻩黄 ⻫斉 ⻬齐 ⻮齿 ⻯竜 ⻰龙 ⻱龜 ⻲亀 ⻳龟
"""
# letters whose compatibility mapping changes their look
LOOKS = "ϹC ϲc"
HYPHENS = "‐‑−﹣－"
# signs of other blocks drawn like an ASCII one
SIGNS = {"∶": ":", "⁄": "/", "∕": "/"}
LINE_ENDS = "\n\x0b\x0c\r\x1c\x1d\x1e\x85  "
# --------------------------------------------------------------------------------------

_CLASS = twins()
_PREFERRED = ("Latn", "Grek", "Cyrl")
_RADICAL = {x[0]: x[1] for x in (RADICALS + LOOKS).split()}
_KEPT_KINDS = ("<super>", "<sub>", "<fraction>", "<circle>")


@lru_cache(maxsize=1 << 17)
def _plain(c: str) -> str:
    """What one sign stands for; '' when it has no visible mark."""
    if c in LINE_ENDS:
        return "\n"
    if c.isspace():
        return " "
    if c in HYPHENS:
        return "-"
    if c in _RADICAL or c in SIGNS:
        return _RADICAL.get(c) or SIGNS[c]
    kind = ud.category(c)
    if kind in ("Cf", "Cc") or 0xFE00 <= ord(c) <= 0xFE0F or c in "͏ᅟᅠㅤﾠ":
        return ""
    how = ud.decomposition(c)
    if not how or how.startswith(_KEPT_KINDS):
        return c
    full = ud.normalize("NFKC", c)
    if full[0] == " ":  # a spacing accent is a sign of its own
        return c
    return "".join(_plain(x) if x != c else x for x in full)


class _Plain(dict):
    def __missing__(self, code: int) -> str:
        self[code] = _plain(chr(code))
        return self[code]


_PLAIN = _Plain()


@lru_cache(maxsize=1 << 16)
def _spelt(token: str) -> str:
    """The token in the script its letters' script sets have in common."""
    common: frozenset[str] | None = None
    for c in token:
        own = frozenset(_CLASS[c]) if c in _CLASS else script_set(c) if c.isalpha() else None
        if own:
            common = own if common is None else common & own
    target = "Latn"
    if common and "Latn" not in common:
        target = next((s for s in _PREFERRED if s in common), min(common))
    return "".join(_CLASS[c].get(target, c) if c in _CLASS else c for c in token)


# letters, digits and accents of the scripts that have twins; ideographs end a token
_ALPHABETIC = "0-9A-Za-zÀ-ʯ\u0300-\u036fͰ-ԯ\u0531-\u0587\u10a0-\u10ffᎠ-ᏽḀ-῿Ⱡ-ⷿꓐ-ꓽꙀ-ꚟꜢ-ꟿꬰ-ꮿ\U00010400-\U000104ff"
_HIDDEN = "".join(c for c in _CLASS if ord(c) > 127)
_TOKEN = re.compile(f"[{_ALPHABETIC}]*[{_HIDDEN}][{_ALPHABETIC}]*")
_LINE_EDGE = re.compile(" *\n *")
_BLANKS = re.compile("  +")


def same_look(text: str | None) -> str | None:
    """The consistent form of one text."""
    if text is None:
        return None
    text = text.replace("\r\n", "\n")
    if not text.isascii() or not text.isprintable():
        # letters are compared without their accents, so that an accented twin is a twin too
        text = ud.normalize("NFD", text).translate(_PLAIN)
        text = ud.normalize("NFC", _TOKEN.sub(lambda m: _spelt(m[0]), text))
    return _LINE_EDGE.sub("\n", _BLANKS.sub(" ", text)).strip()


@lru_cache(maxsize=1)
def _suspects() -> re.Pattern:
    """Any letter outside ASCII that is a twin, or becomes one without its accents or in its plain form."""
    hidden = set(_HIDDEN)
    found = [c for c in map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x1F200)]) if c in hidden or ud.normalize("NFKD", c)[0] in hidden]
    return re.compile("[" + "".join(found) + "]")


def script_report(text: str | None) -> tuple[int, int]:
    """(tokens whose letters have no script in common, tokens of one other script that Latin can spell as a whole)."""
    mixed = whole = 0
    if not text or not _suspects().search(text):
        return 0, 0
    for m in _TOKEN.finditer(ud.normalize("NFD", text).translate(_PLAIN)):
        common = resolved(m[0])
        if common is not None and not common:
            mixed += 1
        elif common and "Latn" not in common and all(c in _CLASS for c in m[0] if c.isalpha()):
            whole += 1
    return mixed, whole


# --- the same over whole batches ------------------------------------------------------
SLOW = 0xFFFFFFFF
_SIZE = 0x30000
_tables: dict[str, np.ndarray] = {}


def _hidden_twin(c: str) -> bool:
    """A letter outside Latin, accented or not, that has a twin."""
    base = ud.normalize("NFD", c)[0]
    return ord(base) > 127 and base in _CLASS


def _table(mode: str) -> np.ndarray:
    """code point -> code point of the form; 0 drops it; SLOW asks for :func:`same_look`.

    Modes: ``look`` = the consistent form itself, ``runs`` = lower case without
    blanks and line ends, ``alnum`` = of these only letters and digits.
    """
    if mode not in _tables:
        t = np.arange(_SIZE, dtype=np.uint32)
        t[0xD800:0xE000] = 0
        blocks = [(0, 0x3400), (0xA000, 0xAC00), (0xD7A4, 0xD800), (0xE000, 0x10000), (0x10400, 0x10500), (0x1D400, 0x1D800), (0x1F100, 0x1F200), (0x2F800, 0x2FA20)]
        for lo, hi in blocks:
            for o in range(lo, hi):
                c = chr(o)
                p = _plain(c)
                if not p or p.isspace():
                    t[o] = ord(p) if p and mode == "look" else 0
                elif len(p) > 1 or ud.combining(c) or (not 0xFF00 <= o < 0x10000 and _hidden_twin(c)) or 0x1100 <= o < 0x1200:
                    t[o] = SLOW
                else:
                    low = p if mode == "look" else p.lower()
                    low = low if len(low) == 1 else p
                    t[o] = 0 if mode == "alnum" and not low.isalnum() else ord(low)
        _tables[mode] = t
    return _tables[mode]


def _kept_sign(c: str, mode: str) -> int:
    low = c if mode == "look" or len(c.lower()) > 1 else c.lower()
    return 0 if mode == "alnum" and not low.isalnum() else ord(low)


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts end to end, and the bounds of each."""
    raw = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    bounds = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    return raw, bounds


def _single_blanks(out: np.ndarray, kept: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Of the kept signs: one blank of each run, none at line ends, nothing before the first or after the last visible sign."""
    where = np.flatnonzero(kept)
    if not len(where):
        return kept
    owner = np.searchsorted(bounds, where, side="right")
    blank, end = out[where] == 32, out[where] == 10
    visible = ~(blank | end)
    at = np.arange(len(where))
    before = np.maximum.accumulate(np.where(blank, -1, at))  # last sign that is no blank
    after = np.minimum.accumulate(np.where(blank, len(where), at)[::-1])[::-1]
    inner = (before >= 0) & (after < len(where))
    b, a = np.maximum(before, 0), np.minimum(after, len(where) - 1)
    inner &= visible[b] & visible[a] & (owner[b] == owner) & (owner[a] == owner)
    first = np.ones(len(where), dtype=bool)
    first[1:] = before[1:] == at[1:] - 1
    seen = np.maximum.accumulate(np.where(visible, at, -1))
    to_come = np.minimum.accumulate(np.where(visible, at, len(where))[::-1])[::-1]
    s, t = np.maximum(seen, 0), np.minimum(to_come, len(where) - 1)
    between = (seen >= 0) & (to_come < len(where)) & (owner[s] == owner) & (owner[t] == owner)
    good = np.where(blank, inner & first, np.where(end, between, True))
    result = np.zeros_like(kept)
    result[where[good]] = True
    return result


def same_looks(texts: list[str | None]) -> list[str | None]:
    """:func:`same_look` of many texts at once."""
    x, bounds = fold(texts, "look")
    whole = x.tobytes().decode("utf-32-le", "surrogatepass")
    return [None if t is None else whole[a:b] for t, a, b in zip(texts, bounds[:-1].tolist(), bounds[1:].tolist())]


def fold(texts: list[str | None], mode: str = "runs") -> tuple[np.ndarray, np.ndarray]:
    """Folded code points of all texts end to end, and the bounds of each text.

    Equal to ``same_look(t).lower()`` without blanks (``runs``), or letters and
    digits of that (``alnum``).  A null text counts as empty.
    """
    texts = ["" if t is None else t for t in texts]
    table = _table(mode)
    raw, bounds = codes(texts)

    def gathered(raw: np.ndarray) -> np.ndarray:
        out = table[np.minimum(raw, _SIZE - 1)]
        if len(raw) and raw.max() >= _SIZE:
            out[raw >= _SIZE] = SLOW
        return out

    out = gathered(raw)
    hard = np.unique(np.searchsorted(bounds, np.flatnonzero(out == SLOW), side="right") - 1)
    if len(hard):
        texts = list(texts)
        for i in hard:
            texts[i] = same_look(texts[i])
        raw, bounds = codes(texts)
        out = gathered(raw)
        rest = np.flatnonzero(out == SLOW)  # signs that the scalar form keeps
        if len(rest):
            distinct, where = np.unique(raw[rest], return_inverse=True)
            out[rest] = np.array([_kept_sign(chr(c), mode) for c in distinct], dtype=np.uint32)[where]
    kept = out != 0
    if mode == "look":
        kept[:-1] &= ~((raw[:-1] == 13) & (raw[1:] == 10))
        kept = _single_blanks(out, kept, bounds)
    ends = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum(kept, out=ends[1:])
    return out[kept], ends[bounds]

"""Letters of equal shape, from the public confusables data that every Spark distribution carries.

The International Components for Unicode ship the table as ``confusables.cfu`` inside the ICU
archive among Spark's jars: sorted code points, each with the string it is drawn like (its
prototype).  :func:`prototypes` reads that file; :func:`twins` keeps what is a matter of script
and not of meaning: cased letters (and Lisu, whose letters are Latin capitals) of other scripts
whose prototype is an ASCII letter of the same case.  The data draw capital I, small l, 1 and |
alike; case decides between I and l here, digits and signs are left alone.

Script sets are those of the Unicode script-extensions property, with the joint writing systems
of East Asia added (Unicode TR 39); letters of no particular script go with every script.
"""

from __future__ import annotations

import glob
import os
import struct
import unicodedata as ud
import zipfile
from functools import lru_cache

# --- fixed values ------------------------------------------------------------------------
#: small Greek letters drawn like a Latin one; the other ones only resemble it
GREEK_SMALL = "ονρϳϲ"
#: letters of the Latin script itself that are drawn like an ASCII one
LATIN_FORMS = {"ɑ": "a", "ɡ": "g"}
#: writing systems of several scripts
JOINT = {"Hani": ("Hanb", "Jpan", "Kore"), "Hira": ("Jpan",), "Kana": ("Jpan",), "Hang": ("Kore",), "Bopo": ("Hanb",)}
SCRIPTS = (
    "Latn Grek Cyrl Armn Hebr Arab Syrc Thaa Deva Beng Guru Gujr Orya Taml Telu Knda Mlym Sinh Thai Laoo Tibt Mymr Geor Hang Ethi Cher Cans Ogam Runr Khmr Mong "
    "Hira Kana Bopo Hani Yiii Ital Goth Dsrt Tglg Hano Buhd Tagb Limb Tale Linb Ugar Shaw Osma Cprt Brai Bugi Copt Talu Glag Tfng Sylo Xpeo Khar Bali Xsux Phnx "
    "Phag Nkoo Sund Lepc Olck Vaii Saur Kali Rjng Lyci Cari Lydi Cham Lana Tavt Avst Egyp Samr Lisu Bamu Java Mtei Armi Sarb Prti Phli Orkh Kthi Osge Adlm"
).split()
# -----------------------------------------------------------------------------------------


def archive() -> str:
    """Path of the ICU archive among Spark's jars."""
    import pyspark

    for home in (os.environ.get("SPARK_HOME", ""), pyspark.__path__[0]):
        found = sorted(glob.glob(os.path.join(home, "jars", "icu4j-*.jar"))) if home else []
        if found:
            return found[-1]
    raise RuntimeError("no ICU archive (icu4j) among Spark's jars")


@lru_cache(maxsize=1)
def prototypes() -> dict[str, str]:
    """Every sign that is drawn like something else, and what it is drawn like."""
    with zipfile.ZipFile(archive()) as z:
        name = next(n for n in z.namelist() if n.endswith("/confusables.cfu"))
        raw = z.read(name)
    data = raw[struct.unpack_from(">H", raw)[0] :]  # behind the common header of such files
    magic, _, _, keys, n_keys, values, _, strings, n_strings = struct.unpack_from(">9I", data)
    if magic != 0x3845FDEF:
        raise RuntimeError("unknown layout of the confusables data")
    pool = data[strings : strings + 2 * n_strings]
    out = {}
    for i in range(n_keys):
        key = struct.unpack_from(">I", data, keys + 4 * i)[0]
        value = struct.unpack_from(">H", data, values + 2 * i)[0]
        size = (key >> 24) + 1  # one unit stands in place of its address
        units = struct.pack(">H", value) if size == 1 else pool[2 * value : 2 * (value + size)]
        out[chr(key & 0xFFFFFF)] = units.decode("utf-16-be", "surrogatepass")
    return out


@lru_cache(maxsize=1 << 16)
def script_set(c: str) -> frozenset[str]:
    """Scripts a sign may belong to; empty for signs that go with every script."""
    import regex

    own = {s for s in SCRIPTS if regex.match(rf"\p{{scx={s}}}", c)}
    return frozenset(own.union(*(JOINT.get(s, ()) for s in own)))


@lru_cache(maxsize=1)
def twins() -> dict[str, dict[str, str]]:
    """letter -> {script: letter of that script drawn alike}, ASCII under ``Latn``; of several of one script the least."""
    classes: dict[str, dict[str, str]] = {}
    for c, drawn in sorted(prototypes().items()):
        kind = ud.category(c)
        if len(drawn) != 1 or not drawn.isascii() or not drawn.isalpha() or ud.normalize("NFKC", c) != c and c != "ϲ":
            continue
        own = script_set(c)
        if drawn == "l" and kind == "Lu":
            drawn = "I"
        if "Latn" in own or not own or "Grek" in own and kind == "Ll" and c not in GREEK_SMALL:
            continue
        if kind == ("Lu" if drawn.isupper() else "Ll") or "Lisu" in own and drawn.isupper():
            members = classes.setdefault(drawn, {"Latn": drawn})
            for s in own:
                members.setdefault(s, c)
            classes[c] = members
    for c, drawn in LATIN_FORMS.items():
        classes[c] = classes.setdefault(drawn, {"Latn": drawn})
    return classes


def resolved(token: str) -> frozenset[str] | None:
    """Scripts in which all letters of the token can stand as they are; None if none of them has a script, empty if scripts are mixed."""
    common = None
    for c in token:
        own = script_set(c) if c.isalpha() else None
        if own:
            common = own if common is None else common & own
    return common

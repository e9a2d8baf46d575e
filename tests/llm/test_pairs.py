"""Near-duplicates and cross-split overlaps against brute force."""

import itertools
import random

import pytest

from loomwright.llm import cross_split as cs, near_duplicates as nd
from loomwright.llm.lookalike import same_look


def runs(text):
    t = "".join(same_look(text or "").lower().split())
    return t, {t[i : i + 8] for i in range(len(t) - 7)}


def brute(records):
    out = set()
    for (a, x), (b, y) in itertools.combinations(sorted(records.items()), 2):
        (s, p), (t, q) = runs(x), runs(y)
        if s and t and (s == t or p and q and len(p & q) >= 0.6 * len(p | q)):
            out.add((a, b))
    return out


@pytest.fixture
def rows(invent):
    out = []
    for k in range(30):
        base = invent(k, 150 + 40 * k)
        split = ("train", "validation", "test")[k % 3]
        out.append((f"d{k:02d}", base, split, "2026-01-01"))
        if k % 3 == 0:
            cut = len(base) // 8
            out.append((f"e{k:02d}", base[:cut] + "新增" + base[cut + 6 :], "test" if k % 2 else "train", "2026-01-01"))
        if k % 5 == 0:
            out.append((f"f{k:02d}", base.replace(",", "，").upper() + " \n", "train", None))
    out += [("g1", "短文", "train", None), ("g2", "短 文", "test", None), ("g3", None, "test", None), ("g4", " ​\n", "test", None), (None, out[0][1], "test", None), ("g5", out[3][1], None, None)]
    out.append(out[0])  # a repeated row
    out.append((out[1][0], out[1][1], out[1][2], "2026-02-01"))  # a second row of a record
    return out


def frame(spark, rows):
    df = spark.createDataFrame(rows, "document_id string, text string, split string, extracted_at string")
    return df.selectExpr("*", "'x' as k1", "1 as a", "2 as id")


def test_near_duplicates(spark, rows):
    members, links = nd.near_duplicates(frame(spark, rows))
    found = [tuple(r) for r in nd.record_pairs(members, links).collect()]
    want = brute({r[0]: r[1] for r in rows if r[0] and r[1]})
    assert len(found) == len(set(found)) and set(found) == want and len(want) > 10
    members, links = nd.near_duplicates(frame(spark, rows), cfg=nd.NearDuplicateConfig(band_members=1, broadcast_ids=0))  # every band is hot
    assert {tuple(r) for r in nd.record_pairs(members, links).collect()} == want


def test_cross_split(spark, rows):
    records, links = cs.cross_split(frame(spark, rows))
    found = [tuple(r)[:3] for r in cs.overlapping_pairs(records, links).collect()]
    split = {r[0]: r[2] for r in rows}
    want = {(split[b] if split[a] == "train" else split[a], a, b) for a, b in brute({r[0]: r[1] for r in rows if r[0] and r[1]}) if split[a] and split[b] and (split[a] == "train") != (split[b] == "train")}
    assert len(found) == len(set(found)) and set(found) == want and len(want) > 3


def test_empty(spark):
    df = frame(spark, [("a", None, "train", None)])
    members, links = nd.near_duplicates(df)
    assert nd.record_pairs(members, links).count() == 0
    records, links = cs.cross_split(df)
    assert cs.overlapping_pairs(records, links).count() == 0


def test_sketch_estimates():
    import numpy as np

    from loomwright.llm.lookalike import fold

    cfg = nd.NearDuplicateConfig()
    a = "".join(chr(0x4E00 + (i * 7919) % 5000) for i in range(1500))
    for share in (0.9, 0.5):
        b = a[: int(1500 * share)] + "".join(chr(0x5000 + (i * 6007) % 4000) for i in range(int(1500 * (1 - share))))
        x, bounds = fold([a, b])
        s = nd.odd_sketch(nd.minhash(x, bounds, cfg), cfg.sketch_bits).view(np.uint64)
        differ = sum(bin(int(v)).count("1") for v in s[0] ^ s[1])
        j = 1 + cfg.sketch_bits / (4 * cfg.samples) * np.log(max(1e-9, 1 - 2 * differ / cfg.sketch_bits))
        (_, p), (_, q) = runs(a), runs(b)
        assert abs(j - len(p & q) / len(p | q)) < 0.15


def test_components(spark):
    from loomwright.llm.components import connected_components

    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3)], "a int, b int")
    got = {r["node"]: r["component"] for r in connected_components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def edited(base, seed, every, at=None):
    """The base with one sign substituted in each stretch of ``every``."""
    r = random.Random(seed)
    out = list(base)
    for k in range(0, len(base) - every, every):
        out[k + (r.randrange(every) if at is None else at)] = chr(0x5000 + r.randrange(4000))
    return "".join(out)


def family(spark, base, variants):
    rows = [("base", base, "train", None)] + [(f"v{k:03d}", v, "test", None) for k, v in enumerate(variants)]
    records, links = cs.cross_split(frame(spark, rows))
    found = {(r["document_id_a"], r["document_id_b"]) for r in cs.overlapping_pairs(records, links).collect()}
    want = {("base", x) for x, text, _, _ in rows[1:] if len(runs(base)[1] & runs(text)[1]) >= 0.6 * len(runs(base)[1] | runs(text)[1])}
    return found, want


def test_cross_split_family(spark):
    """The unedited passages of a large family are frequent, the edited ones rare."""
    r = random.Random(7)
    base = "".join(chr(0x4E00 + r.randrange(400)) for _ in range(1500))
    found, want = family(spark, base, [edited(base, k, 37) for k in range(200)])
    assert len(want) > 150 and found == want


def test_cross_split_even_edits(spark):
    """Edits at even distances, wherever they start; repeated parts; short texts."""
    r = random.Random(8)
    base = "".join(chr(0x4E00 + r.randrange(400)) for _ in range(1500))
    for text in (base, base[:700] * 2 + base[:300], base[:90], base[:40] * 20):
        found, want = family(spark, text, [edited(text, k, every, k % every) for every in (34, 36, 44) for k in range(0, every, 3)])
        assert found == want and (want or len(text) == 800)


def test_cross_split_report(spark, invent):
    """Coverage is the union over all training texts; copies are counted, not expanded."""
    base = invent(1, 900)
    rows = [("e1", base, "test", None), ("e2", base, "test", None), ("t1", base[:700], "train", None), ("t2", base[200:], "train", None), ("t3", base[200:], "train", None), ("e3", invent(2, 300), "validation", None)]
    df = frame(spark, rows)
    records, links = cs.cross_split(df)
    classes = {(r["records"], r["training_records"]) for r in cs.overlapping_classes(records, links).collect()}
    assert classes == {(2, 1), (2, 2)}
    report = {r["split"]: r for r in cs.overlap_report(df, records, links, cs.F.lit("s")).collect()}
    assert (report["test"]["records"], report["test"]["exact"], report["test"]["near"]) == (2, 0, 2)
    assert report["test"]["mean_coverage"] == 1.0 and report["validation"]["mean_coverage"] == 0.0


def test_cross_split_many_shards(spark, rows):
    cfg = cs.CrossSplitConfig(shard_passages=40, kept_shards=1, scan_signs=500, postings_at_once=10)
    df = frame(spark, rows)
    one, many = (sorted(map(tuple, cs.overlapping_pairs(*cs.cross_split(df, cfg=c)).collect())) for c in (cs.CrossSplitConfig(), cfg))
    assert one == many and len(one) > 3


def test_cross_split_shards(spark, invent):
    """Copies make no more shards, and a text only meets shards of sizes it can be similar to."""
    rows = [(f"t{k}", invent(k, 80 + 60 * k), "test", None) for k in range(12)]
    cfg = cs.CrossSplitConfig(shard_passages=100)
    plans = [cs.shard_plan(cs.evaluation_rows(frame(spark, r), "document_id", "text", "split", "extracted_at", cfg), cfg) for r in (rows, rows + [(f"{i}{k}", t, s, o) for k in range(5) for i, t, s, o in rows])]
    assert plans[0] == plans[1] and len(plans[0].ranges) > 3
    assert all(b[0] == a[1] + 1 and b[3] == a[3] + a[2] for a, b in zip(plans[0].ranges, plans[0].ranges[1:]))
    assert plans[0].sizes()[0][1] < 0.6 * max(r[1] for r in plans[0].ranges)

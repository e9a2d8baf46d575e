"""Shared spans and leaks against brute force."""

import math

import numpy as np

from loomwright.llm import leakage, shared_spans as ss
from loomwright.llm.grams import window_hashes, sliding
from loomwright.llm.lookalike import same_look


def brute_shared(rows, span):
    texts = {d: t for d, t in rows if d is not None and t is not None}
    seen = {}
    for d, t in texts.items():
        for i in range(len(t) - span + 1):
            seen.setdefault(t[i : i + span], set()).add(d)
    out = {}
    for d, t in texts.items():
        hit = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - span + 1):
            if len(seen[t[i : i + span]]) > 1:
                hit[i : i + span] = True
        out[d] = int(hit.sum())
    return out


def make(invent):
    rows = [(i, invent(i, 300 + 37 * i)) for i in range(24)]
    quote, edge, short = invent(900, 260), invent(901, 200), invent(902, 199)
    for i in (2, 5, 9):
        rows[i] = (i, rows[i][1][:120] + quote + rows[i][1][120:])
    for i in (3, 4):
        rows[i] = (i, rows[i][1] + edge)
    for i in (6, 7):
        rows[i] = (i, short + rows[i][1])
    rows[8] = (8, rows[8][1] + quote[:230] + "x" + quote[:230])
    rows.append((50, rows[10][1]))  # a copy
    rows.append((51, invent(77, 250) * 2))  # repeats only itself
    rows += [(52, None), (53, ""), (54, "a" * 500), (55, "a" * 260), (56, "a" * 500), (None, quote)]
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.selectExpr("*", "cast(doc_id % 5 as timestamp) as crawled_at", "1 as fp", "2 as pos", "'x' as doc")


def test_shared_spans(spark, invent):
    rows = make(invent)
    df = frame(spark, rows)
    want = brute_shared(rows, 200)
    for cfg in (ss.SpanConfig(), ss.SpanConfig(batches=4, fanout=1, group_limit=1, broadcast_bytes=0, hot_rows=4)):
        got = {r["doc"]: r["shared"] for r in ss.shared_spans(df, cfg=cfg).collect()}
        assert got == want
    assert want[6] == 0 and want[51] == 0 and want[3] >= 200
    assert ss.shared_spans(df.limit(0)).count() == 0


def test_kept_index(spark, invent, tmp_path):
    """A second session's batch meets the history by a merge join, without shuffling or sorting it."""
    rows = [r for r in make(invent) if r[0] is not None]
    old, new = frame(spark, [r for r in rows if r[0] % 3]), frame(spark, [r for r in rows if r[0] % 3 == 0])
    folder = f"file://{tmp_path}/index"
    first = ss.FingerprintIndex.open(spark, folder, buckets=4)
    assert {r["doc"]: r["shared"] for r in ss.shared_spans(old, index=first).collect()} == brute_shared([r for r in rows if r[0] % 3], 200)
    first.close()
    again = ss.FingerprintIndex.open(spark, folder)
    assert again.runs == first.runs and again.buckets == 4
    want = {d: n for d, n in brute_shared(rows, 200).items() if d % 3 == 0}
    assert {r["doc"]: r["shared"] for r in ss.shared_spans(new, index=again, history=old).collect()} == want
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with ss._sorted_buckets(spark):
            last = ss.FingerprintIndex.open(spark, folder)
            run = last.runs.pop()
            plan = last.matches(run)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "ExistenceJoin" in plan and "Exchange" not in plan, plan
    lines, history = plan.split("\n"), again.runs[0]["name"]
    for i, line in enumerate(lines):
        if history in line:  # between the scan of the history and its join nothing sorts or groups
            above = next(k for k in range(i, -1, -1) if "SortMergeJoin" in lines[k])
            assert not any("Sort [" in x or "Aggregate" in x for x in lines[i - 3 : i] if lines.index(x) > above), plan


def test_winnowing_keeps_every_span(invent):
    text = invent(3, 3000)
    x = np.array([ord(c) for c in text], dtype=np.uint32)
    at, _ = ss.winnow(x, np.array([0, len(x)]), 100, 200)
    assert all(((at >= s) & (at <= s + 100)).any() for s in range(len(x) - 199))


def test_sliding():
    h = np.random.default_rng(1).integers(0, 99, 57).astype(np.uint64)
    for w in (1, 5, 57):
        assert sliding(h, w, np.minimum).tolist() == [h[i : i + w].min() for i in range(len(h) - w + 1)]
    assert len(sliding(h, 58, np.maximum)) == 0


def test_window_hashes_depend_on_content_only():
    x = np.array([1, 2, 3, 9, 1, 2, 3], dtype=np.uint32)
    h = window_hashes(x, 3)
    assert h[0] == h[4] and len(set(h.tolist())) == 4


def test_leaks(spark, invent):
    items = [(i, invent(500 + i, 60 + i)) for i in range(20)] + [(90, None), (91, "。 "), (92, "Check the Relay 12345 now, please")]
    docs = [(i, invent(i, 400)) for i in range(30)]
    docs += [(100, docs[0][1] + items[3][1]), (101, items[4][1][: math.ceil(len(items[4][1]) * 0.8)] + docs[1][1])]
    docs += [(102, docs[2][1] + items[5][1][:15] + "隔" + items[5][1][15:30]), (103, None), (104, ""), (105, "check THE relay\n12345 — now")]
    docs += [(100, docs[0][1] + items[3][1]), (106, " ".join(items[6][1]))]  # a repeated row, and blanks that don't count
    plain = lambda t: "".join(c for c in same_look(t or "").lower() if c.isalnum())
    want = set()
    for d, t in docs:
        for i, s in items:
            s, need = plain(s), math.ceil(len(plain(s)) / 2)
            if s and any(s[k : k + need] in plain(t) for k in range(len(s) - need + 1)):
                want.add((d, i))
    left = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as term", "2 as item")
    right = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as size")
    everything = leakage.leaks(left, right).collect()
    rows = [r for r in everything if r["match"] != "proximity"]
    assert len(rows) == len({(r["doc"], r["item"]) for r in rows}) and {(r["doc"], r["item"]) for r in rows} == want
    assert {(100, 3), (101, 4), (105, 92), (106, 6)} <= want
    assert {r["item"]: r["match"] for r in rows if r["doc"] == 100} == {3: "whole"}
    assert leakage.leaks(left.limit(0), right).count() == 0 and leakage.leaks(left, right.limit(0)).count() == 0


def test_short_items_change_nothing_else(spark, invent):
    items = [(i, invent(500 + i, 60 + i)) for i in range(4)]
    docs = [(i, invent(i, 300) + (items[i % 4][1] if i < 6 else "") + ("油 K9 表" if i == 7 else "")) for i in range(12)]
    left = spark.createDataFrame(docs, "doc_id long, text string")
    index = leakage.PositionalIndex.build(left)  # one index for both sets of items
    right = lambda extra: spark.createDataFrame(items + extra, "item_id long, text string")
    got = [sorted(map(tuple, leakage.leaks(left, right(extra), index=index).collect())) for extra in ([], [(90, "K9"), (91, "k9表q")])]
    assert got[0] == [r for r in got[1] if r[1] < 90] and len(got[0]) >= 6
    plain = {d: "".join(c for c in same_look(t).lower() if c.isalnum()) for d, t in docs}
    assert {r[0] for r in got[1] if r[1] == 90} == {d for d, t in plain.items() if "k" in t or "9" in t}
    assert [(r[0], r[2], r[5]) for r in got[1] if r[1] == 91] == [(7, 3, "passage")]


def test_proximity(spark, invent):
    """All the words of an item near each other, in pieces too short for a passage."""
    item = invent(700, 120)
    pieces = [item[k : k + 40] for k in range(0, 120, 40)]
    docs = [(1, invent(1, 200) + "甲".join(reversed(pieces)) + invent(2, 200)), (2, invent(3, 900).join(pieces)), (3, invent(4, 500)), (4, item)]
    rows = leakage.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert {r["doc"]: r["match"] for r in rows} == {1: "proximity", 4: "whole"}
    assert {r["doc"]: r["near"] for r in rows}[4] == 1.0


def test_closest():
    off, pos = np.array([0, 5, 9, 5, 0]), np.array([100, 50, 52, 110, 112])
    assert leakage.closest(off, pos, 13) == 2 and leakage.closest(off, pos, 70) == 3 and leakage.closest(off[:0], pos[:0], 5) == 0
    x, y = (np.array([ord(c) for c in t]) for t in ("xxabcdyy", "zabcde"))
    assert leakage.longest_equal(x, y, 1) == 4 and leakage.longest_equal(x, y, 99) == 0

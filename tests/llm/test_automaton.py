"""The automaton against a plain search."""

import random

import numpy as np
import pytest

from loomwright.llm.automaton import LANE, Automaton
from loomwright.llm.lookalike import codes


@pytest.mark.parametrize("alphabet, length", [("ab", 3), ("ab", 8), ("abcdefgh电阻", 4), ("x", 5), ("αβγ😀z", 1)])
def test_every_occurrence(alphabet, length):
    r = random.Random(length)
    invent = lambda n: "".join(r.choice(alphabet) for _ in range(n))
    sources = [invent(60) for _ in range(4)]
    texts = [invent(n) for n in (0, 1, length - 1, length, 40, LANE, LANE + length - 1, 3 * LANE + 5)] + [sources[0], "q" * 20, sources[1] + "q" + sources[2]]
    x, bounds = codes(sources)
    at = np.array([int(bounds[i]) + k for i, s in enumerate(sources) for k in range(0, len(s) - length + 1, length)])
    automaton, pattern = Automaton.build(x, at, length)
    words = ["".join(map(chr, x[a : a + length])) for a in at]
    name = dict(zip(words, pattern.tolist()))
    assert len(set(pattern.tolist())) == len(set(words)) == automaton.patterns
    again = Automaton(length, automaton.leaves, automaton.patterns, automaton.arrays())
    y, ends = codes(texts)
    want = {(int(ends[i]) + k, name[t[k : k + length]]) for i, t in enumerate(texts) for k in range(len(t) - length + 1) if t[k : k + length] in name}
    places, found = again.scan(y, ends)
    assert len(places) == len(want) and set(zip(places.tolist(), found.tolist())) == want


def test_no_passages():
    x, bounds = codes(["some text"])
    automaton, pattern = Automaton.build(x, np.zeros(0, dtype=np.int64), 8)
    assert len(pattern) == 0 and len(automaton.scan(x, bounds)[0]) == 0

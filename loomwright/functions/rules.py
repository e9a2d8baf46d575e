"""Row-level classifiers over vocabularies, as column expressions.

Texts are expected in the form of ``functions.text.key`` where case must not count.
Null texts give the default label, no terms and zero counts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, functions as F

from .text import bound, rx

_PLAIN_TERM = re.compile(r"[a-z0-9 ]+")


def has_term(text: Column, term: str) -> Column:
    """Latin words and phrases stand between non-alphanumerics; all else is a plain substring."""
    term, text = term.lower(), F.coalesce(text, F.lit(""))
    if _PLAIN_TERM.fullmatch(term):
        return text.rlike(f"(?<![a-z0-9]){re.escape(term)}(?![a-z0-9])")
    return F.contains(text, F.lit(term))


def any_term(text: Column, terms: list[str]) -> Column:
    """Some term occurs, as :func:`has_term` has it: one pattern for words, one for substrings."""
    lows = [t.lower() for t in terms]
    plain = [re.escape(t) for t in lows if _PLAIN_TERM.fullmatch(t)]
    other = [re.escape(t) for t in lows if not _PLAIN_TERM.fullmatch(t)]
    found = [f"(?<![a-z0-9])(?:{'|'.join(plain)})(?![a-z0-9])"] if plain else []
    return F.coalesce(text.rlike("|".join(found + other)), F.lit(False)) if terms else F.lit(False)


def terms_in(text: Column, terms: list[str]) -> Column:
    """The terms that occur, in the order of the vocabulary."""
    return F.array_compact(F.array(*[F.when(has_term(text, t), F.lit(t)) for t in terms]))


def occurrences(text: Column, part: str) -> Column:
    """Non-overlapping occurrences of a substring."""
    text = F.coalesce(text, F.lit(""))
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("int")


def first_label(text: Column, labels: dict[str, list[str]], default: str) -> Column:
    """The first label any of whose substrings occurs."""
    text = F.coalesce(text, F.lit(""))
    out = F
    for label, parts in labels.items():
        found = reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in parts])
        out = out.when(found, label)
    return out.otherwise(default)


def label_scores(text: Column, labels: dict[str, list[str]]) -> Column:
    """Struct of the summed occurrences per label."""
    return F.struct(*[reduce(lambda a, b: a + b, [occurrences(text, p) for p in parts]).alias(label) for label, parts in labels.items()])


def best_label(scores: Column, labels: list[str], default: str) -> Column:
    """The label with the most occurrences; ties go to the earlier one, no occurrence to the default."""
    best = F.greatest(*[scores[label] for label in labels])
    out = F.when(best <= 0, default)
    for label in labels:
        out = out.when(scores[label] == best, label)
    return out.otherwise(default)


def score_array(text: Column, labels: dict[str, list[str]]) -> Column:
    """The summed occurrences of each label as an array, to be kept as a column of its own before :func:`top_label` reads it several times."""
    # one loop over the parts (an expression for each of them is slow to compile), and the text worked out once, not for each part
    parts = F.array(*[F.array(*map(F.lit, ps)) for ps in labels.values()])
    count = lambda t, p: ((F.length(t) - F.length(F.replace(t, p, F.lit("")))) / F.length(p)).cast("int")
    scores = lambda t: F.transform(parts, lambda ps: F.aggregate(ps, F.lit(0), lambda n, p: n + count(t, p)))
    return bound(F.coalesce(text, F.lit("")), scores)


def top_label(scores: Column, labels: list[str], default: str) -> Column:
    """As :func:`best_label`, from an array of scores."""
    best = F.array_max(scores)
    return F.when(best > 0, F.element_at(F.array(*map(F.lit, labels)), F.array_position(scores, best).cast("int"))).otherwise(default)


def counts_of(text: Column, patterns: dict[str, str]) -> Column:
    """Struct of the number of matches of each pattern, case ignored."""
    text = F.coalesce(text, F.lit(""))
    return F.struct(*[F.regexp_count(text, F.lit(rx(p, True))).alias(n) for n, p in patterns.items()])


def flags_of(flags: dict[str, Column]) -> Column:
    """Names of the conditions that hold, sorted and distinct."""
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in flags.items()]))))


def term_flags(text: Column, groups: dict[str, list[str]]) -> Column:
    return flags_of({n: any_term(text, ts) for n, ts in groups.items()})


def domain_of(text: Column, inside: list[str], outside: list[str], trusted: Column | None = None, auxiliary: Column | None = None) -> Column:
    """outside beats inside; auxiliary text only speaks for inside; trusted rows default to inside."""
    ins = any_term(text, inside)
    if auxiliary is not None:
        ins = ins | any_term(auxiliary, inside)
    if trusted is not None:
        ins = ins | trusted
    return F.when(any_term(text, outside), "outside").when(ins, "inside").otherwise("uncertain")


def foreign_reasons(text: Column, foreign: list[str], inside: list[str], excused: str | None = None, animal: str | None = None, animal_wording: str | None = None) -> Column:
    """Terms that put a text outside, sorted: one of them excused beside a term of the domain, and ``spider`` where an animal meets the wording of pests."""
    found = F.when(any_term(text, foreign), terms_in(text, foreign)).otherwise(F.array().cast("array<string>"))
    if excused:
        found = F.when(F.array_contains(found, excused) & any_term(text, inside), F.array_remove(found, excused)).otherwise(found)
    if animal:
        pest = F.coalesce(text.rlike(rx(animal, True)) & text.rlike(rx(animal_wording, True)), F.lit(False))
        found = F.when(pest, F.array_append(found, "spider")).otherwise(found)
    return F.array_sort(F.array_distinct(found))


def domain_status(text: Column, reasons: Column, inside: list[str], trusted: bool = False, auxiliary: Column | None = None) -> Column:
    """non_automotive where there are reasons against, automotive where a term speaks for it (in the auxiliary text too) or the source is trusted, else uncertain."""
    positive = any_term(text, inside)
    if auxiliary is not None:
        positive = positive | any_term(auxiliary, inside)
    return F.when(F.size(reasons) > 0, "non_automotive").when(positive | F.lit(trusted), "automotive").otherwise("uncertain")


def says(text: Column, pattern: str) -> Column:
    """The pattern occurs, case ignored; a null text says nothing."""
    return F.coalesce(text.rlike(rx(pattern, True)), F.lit(False))


def near_pair(text: Column, first: str, second: str, distance: int, breaks: str = r"[.!?;。！？；\n]", context: str | None = None) -> Column:
    """A match of each pattern, starts within ``distance`` and no break between; with ``context`` the sentence around must match it too.

    Match positions are needed, so this is one vectorised Arrow function; only texts that hold both go to it.
    """
    one, two, stop = (re.compile(p, re.I) for p in (first, second, breaks))
    around = re.compile(context, re.I) if context else None

    def check(t: str | None) -> bool:
        if not t:
            return False
        spans = [m.span() for m in two.finditer(t)]
        if not spans:
            return False
        edges = [-1, *(m.start() for m in stop.finditer(t)), len(t)]
        for m in one.finditer(t):
            for a, b in spans:
                if abs(m.start() - a) <= distance:
                    lo, hi = min(m.start(), a), max(m.end(), b)
                    gap = (min(m.end(), b), max(m.start(), a))
                    if any(gap[0] <= e < gap[1] for e in edges):
                        continue
                    if around is None:
                        return True
                    left = max(e for e in edges if e < lo)
                    right = min(e for e in edges if e >= hi)
                    if around.search(t, left + 1, right):
                        return True
        return False

    @F.pandas_udf("boolean")
    def run(s: pd.Series) -> pd.Series:
        return s.map(check)

    both = says(text, first) & says(text, second)  # null stands for texts that can't have a pair
    return F.coalesce(run(F.when(both, text)), F.lit(False))


@dataclass(frozen=True)
class Guard:
    """Wording near an action that excuses it: in the signs from ``left`` before the match, or its ``start`` or ``end``, up to ``right`` behind its end."""

    pattern: str
    left: int = 0
    right: int = 0
    #: "around" the match, "from" its start, "before" it or "behind" it; behind it the wording must begin at once
    where: str = "before"

    def excuses(self, sentence: str, start: int, end: int) -> bool:
        lo = {"around": max(0, start - self.left), "before": max(0, start - self.left), "from": start, "behind": end}[self.where]
        hi = start if self.where == "before" else end + self.right
        look = re.compile(self.pattern).match if self.where == "behind" else re.compile(self.pattern).search
        return look(sentence[lo:hi]) is not None


def unexcused(text: Column, action: str, guards: list[Guard], sentences: str = r"[。！？!?；;\n]") -> Column:
    """Some sentence has a match of ``action`` that no guard excuses; only texts with a match go to Python."""
    act, split = re.compile(action, re.I), re.compile(sentences)

    def check(t: str | None) -> bool:
        return any(not any(g.excuses(s, *m.span()) for g in guards) for s in split.split(t or "") for m in act.finditer(s))

    @F.pandas_udf("boolean")
    def run(s: pd.Series) -> pd.Series:
        return s.map(check)

    return F.coalesce(run(F.when(says(text, action), text)), F.lit(False))


def unguarded(text: Column, action: str, before: str, before_width: int, after: str | None = None, after_width: int = 0, sentences: str = r"[。！？!?；;\n]") -> Column:
    """:func:`unexcused` with one wording before the action (negation) and one behind it (note of danger)."""
    guards = [Guard(before, left=before_width)] + ([Guard(after, right=after_width, where="behind")] if after else [])
    return unexcused(text, action, guards, sentences)


def grade(score: Column, steps: list[tuple[float, str]], missing: str, lowest: str) -> Column:
    """A name for a score: the first step it reaches; null has its own."""
    out = F.when(score.isNull(), missing)
    for least, name in steps:
        out = out.when(score >= least, name)
    return out.otherwise(lowest)


def names_contain(a: Column, b: Column, suffixes: str = "(?:汽车|轿车)$") -> Column:
    """Two name keys are equal or one holds the other, generic suffixes aside; both must have two signs for that."""
    x, y = F.regexp_replace(a, suffixes, ""), F.regexp_replace(b, suffixes, "")
    present = (F.length(a) > 0) & (F.length(b) > 0)
    return F.coalesce(present & ((x == y) | ((F.least(F.length(x), F.length(y)) >= 2) & (F.contains(x, y) | F.contains(y, x)))), F.lit(False))


def models_contain(a: Column, b: Column) -> Column:
    """As :func:`names_contain`, with nothing taken off."""
    same = (a == b) | ((F.least(F.length(a), F.length(b)) >= 2) & (F.contains(a, b) | F.contains(b, a)))
    return F.coalesce((F.length(a) > 0) & (F.length(b) > 0) & same, F.lit(False))

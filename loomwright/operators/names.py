"""Alias catalogues, leftmost-longest mentions of many names in many texts, and what they say about a declared name."""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import vocabulary as V
from ..functions.rules import models_contain, names_contain
from ..functions.text import name_key


def alias_catalogue(names: DataFrame, brand: str = "brand", model: str = "model", compose: bool = True) -> DataFrame:
    """alias, brand, model, whole: aliases that belong to exactly one pair.

    A pair gives its whole name; the model alone only if it is distinctive (three ideographs, or two and a Latin
    letter or digit) and no brand is called so.  Pairs are compared by their name keys.
    """
    keyed = names.where(F.col(brand).isNotNull() & F.col(model).isNotNull()).select(
        F.col(brand).alias("brand"), F.col(model).alias("model"), name_key(F.col(brand), compose).alias("bk"), name_key(F.col(model), compose).alias("mk")
    ).where("mk <> ''")
    pairs = keyed.groupBy("bk", "mk").agg(F.min("brand").alias("brand"), F.min("model").alias("model"))
    ideographs, latin = F.regexp_count("mk", F.lit("[一-鿿]")), F.col("mk").rlike("[a-z0-9]")
    alone = (ideographs >= 3) | ((ideographs >= 2) & latin)
    whole = pairs.select(F.concat("bk", "mk").alias("alias"), "brand", "model", "bk", "mk", F.lit(True).alias("whole"))
    bare = pairs.where(alone).select(F.col("mk").alias("alias"), "brand", "model", "bk", "mk", F.lit(False).alias("whole"))
    single = whole.union(bare).groupBy("alias").agg(F.count_distinct("bk", "mk").alias("owners"), F.max_by(F.struct("brand", "model", "whole"), "whole").alias("x")).where("owners = 1").select("alias", "x.*")
    brands = pairs.select(F.col("bk").alias("alias")).distinct().withColumn("__b", F.lit(True))
    return single.join(brands, "alias", "left").where("whole or __b is null").drop("__b")


@lru_cache(maxsize=2)
def _finder(names: tuple[str, ...]):
    """text -> (start, name) of its mentions: of those that begin first the longest, none within another."""
    try:
        import ahocorasick
    except ImportError:
        pattern = re.compile("|".join(map(re.escape, sorted(names, key=len, reverse=True))))
        return lambda t: [(m.start(), m[0]) for m in pattern.finditer(t)]
    automaton = ahocorasick.Automaton()
    for n in names:
        automaton.add_word(n, n)
    automaton.make_automaton()

    def find(t: str) -> list[tuple[int, str]]:
        out, free = [], 0
        for start, _, n in sorted((end - len(n) + 1, -len(n), n) for end, n in automaton.iter(t)):
            if start >= free:
                out.append((start, n))
                free = start + len(n)
        return out

    return find


MENTION = "start int, alias string, brand string, model string, brand_key string, model_key string, whole boolean"


def mention_arrays(key: Column, catalogue: DataFrame, compose: bool = True, most_aliases: int = 200_000) -> Column:
    """array of mentions in a name key, by one automaton a worker.

    The catalogue is a dictionary of bounded size: more than ``most_aliases`` is an error, not a bigger broadcast.
    """
    keyed = catalogue.select("alias", "brand", "model", name_key(F.col("brand"), compose).alias("bk"), name_key(F.col("model"), compose).alias("mk"), "whole")
    rows = keyed.limit(most_aliases + 1).toPandas()
    if len(rows) > most_aliases:
        raise ValueError(f"more than {most_aliases} aliases")
    table = {r.alias: {"alias": r.alias, "brand": r.brand, "model": r.model, "brand_key": r.bk, "model_key": r.mk, "whole": bool(r.whole)} for r in rows.itertuples()}
    shared = catalogue.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf(f"array<struct<{', '.join(x.replace(' ', ':') for x in MENTION.split(', '))}>>")
    def find(keys: pd.Series) -> pd.Series:
        names = shared.value
        if not names:
            return keys.map(lambda _: [])
        finder = _finder(tuple(names))
        return keys.map(lambda k: [{"start": at, **names[n]} for at, n in finder(k or "")])

    return find(key)


def mentions(texts: DataFrame, id_col: str, key_col: str, catalogue: DataFrame, most_aliases: int = 200_000) -> DataFrame:
    """id, start, alias, brand, model, whole: leftmost-longest, non-overlapping mentions in a name key."""
    found = mention_arrays(F.col(key_col), catalogue, most_aliases=most_aliases)
    return texts.select(F.col(id_col), F.explode(found).alias("m")).select(id_col, *[f"m.{c}" for c in ("start", "alias", "brand", "model", "whole")])


def vehicle_context(declared: Column, key: Column, found: Column, compose: bool = True) -> Column:
    """unknown, no_explicit_vehicle, consistent, review or conflict.

    ``declared`` is struct<brand, model> or null, ``key`` the name key of the query, ``found`` its mentions.  Another
    vehicle is a conflict if wording of ownership stands before it, or if it is named in full with nothing but a year
    before it; it is for review if the query compares, or names it in full.
    """
    brand, model = name_key(declared["brand"], compose), name_key(declared["model"], compose)
    own = lambda m: names_contain(m["brand_key"], brand) | models_contain(m["model_key"], model)
    before = lambda m: F.substring(key, F.greatest(m["start"] - 19, F.lit(1)), F.least(m["start"], F.lit(20)))
    claimed = lambda m: before(m).rlike(V.OWNED) | (m["whole"] & before(m).rlike(V.YEAR_ONLY))
    return (
        F.when(declared.isNull() | brand.isin(V.NO_BRAND), "unknown")
        .when(F.coalesce(F.size(found), F.lit(0)) <= 0, "no_explicit_vehicle")
        .when(F.exists(found, own), "consistent")
        .when(key.rlike(V.COMPARED), "review")
        .when(F.exists(found, claimed), "conflict")
        .when(F.exists(found, lambda m: m["whole"]), "review")
        .otherwise("no_explicit_vehicle")
    )


def consistency(declared: Column, found: Column) -> Column:
    """unknown (nothing declared), none (nothing mentioned), consistent, different; both are name keys (found an array)."""
    hit = F.exists(found, lambda k: (k == declared) | F.contains(k, declared) | F.contains(declared, k))
    return F.when(F.coalesce(declared, F.lit("")) == "", "unknown").when(F.size(F.coalesce(found, F.array().cast("array<string>"))) <= 0, "none").when(hit, "consistent").otherwise("different")

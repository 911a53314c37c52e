"""Mixing sources to target weights by capped water-filling.

Every source asks for its weight's share of the budget, but may be repeated
``max_epochs`` times at most: sources over that cap are clamped to it, and
the excess is dealt to the others by weight, until no target is above its
cap. A target is met by whole repetitions of the source plus, for the rest,
the documents that come first in a seeded order; the one at which the rest
runs out gives the fraction of its words that still fits. The order goes by a
seeded hash of the id, then by one of the text, then (between equal rows) by
their place in the stored table of sizes. The place where that order is cut is
found by refining a histogram of one hash after the other around the cut, the
later ones only where rows tie, so nothing is sorted and no source, however
large, and no tie meets in one task.

Nulls: null text has size 0; a null source is a source of its own, last in
order; null ids tie. Rows that repeat an id are taken or left one by one; a
source meets its target to less than a word as long as it has any. With no
words at all every target is 0. Texts of any length are read whole, in the scan.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import global_rank, small_or_shuffled, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: Bits of the seeded hash, and bits by which each pass refines the cut.
HASH_BITS, STEP_BITS = 60, 12
#: The order of a source's rows: hashes of id and text, place in the stored table.
KEYS = ("h", "t", "u")


def seeded_hash(seed: int, *cols: str) -> Column:
    """60 bits of md5 over seed and columns, as a long."""
    text = F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def water_level(sources: DataFrame, budget: float, max_epochs: int) -> float:
    """The level at which targets min(cap, level * weight) use the budget up:
    clamp every source whose share is above its cap, deal the excess to the
    rest by weight, and repeat until none is above. Each round is one small
    aggregate over (size, weight)."""
    level = -1.0
    while True:
        over = F.lit(level) * F.col("weight") > F.col("size") * max_epochs
        used, weight = sources.agg(F.sum(F.when(over, F.col("size") * max_epochs).otherwise(0)),
                                   F.sum(F.when(over, 0).otherwise(F.col("weight")))).first()
        if not weight:
            return level
        now = (budget - used) / weight
        if now == level:
            return level
        level = now


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, size, source_size, target, taken, epochs) per row of ``docs``
    (doc_id, text, source). Weights repeat over the sources in code point order."""
    rows = written(_sizes(docs, seed), "sizes")
    full, n = _plan(rows, weights, max_epochs, KEYS)
    r = rows.join(small_or_shuffled(full, n), "key")
    return r.select("doc_id", "size", "source_size", "target", _taken().alias("taken"),
                    F.try_divide(F.col("target"), F.col("source_size")).alias("epochs"))


def _source_key() -> Column:
    return F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), "source"))


def _size() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def _sizes(docs: DataFrame, seed: int) -> DataFrame:
    return docs.select("doc_id", _source_key().alias("key"), _size().alias("size"), seeded_hash(seed, "doc_id").alias("h"),
                       seeded_hash(seed, "text").alias("t"), F.monotonically_increasing_id().alias("u"))


def _against_cut(keys: tuple[str, ...]) -> tuple[Column, Column]:
    """Whether a row comes before its source's cut, and whether it stands at it; a null cut is met by every row."""
    before, at = F.lit(False), F.lit(True)
    for k in reversed(keys):
        cut = F.col(f"cut_{k}")
        before = F.when(cut.isNull(), F.lit(False)).otherwise((F.col(k) < cut) | ((F.col(k) == cut) & before))
    for k in keys:
        at = at & (F.col(f"cut_{k}").isNull() | (F.col(k) == F.col(f"cut_{k}")))
    return before, at


def _taken() -> Column:
    """Words taken of a row (size, h, t, u) beside its source's plan: only one row stands at the cut."""
    before, at = _against_cut(KEYS)
    return F.col("size") * F.col("whole") + F.when(before, F.col("size")).when(at & (F.col("size") > 0), F.floor("room")).otherwise(0)


def _plan(rows: DataFrame, weights: tuple[int, ...], max_epochs: int, keys: tuple[str, ...]) -> tuple[DataFrame, int]:
    """(key, source_size, target, whole, a cut of each key, room, held, n) of the sources, and their number."""
    totals = rows.groupBy("key").agg(F.sum("size").alias("size"))
    ranked = global_rank(totals, [F.col("key") == "-", F.col("key")], "sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = written(ranked.select("key", "size", weight.alias("weight")), "weights")
    n, budget = sources.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    level = water_level(sources, budget, max_epochs)
    cap = (F.col("size") * max_epochs).cast("double")
    plan = (sources.withColumn("target", F.least(cap, F.lit(level) * F.col("weight")))
            .withColumn("whole", F.when(F.col("size") > 0, F.least(F.lit(max_epochs), F.floor(F.col("target") / F.col("size")))).otherwise(0).cast("long"))
            .withColumn("rest", F.col("target") - F.col("whole") * F.col("size"))
            .withColumnRenamed("size", "source_size"))
    cut = _cuts(rows, plan.select("key", "rest"), n, keys)
    full = written(plan.join(cut, "key", "left"), "plan")
    return full, n


def _cuts(rows: DataFrame, rest: DataFrame, n_sources: int, keys: tuple[str, ...]) -> DataFrame:
    """(key, a cut of each of ``keys``, room, held, n): rows before the cut fit
    into ``rest`` whole; the ``n`` at it, ``held`` words together, have ``room``
    words left. Cuts of keys that no tie needs are null."""
    state = rest.select("key", "rest", F.lit(0).cast("long").alias("before"))
    done: list[str] = []
    for name in keys:
        state = written(state.drop("held", "n").withColumn("prefix", F.lit(0).cast("long")), "cut")
        for bits in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
            _, tied = _against_cut(tuple(done))
            inside = (rows.filter("size > 0").join(small_or_shuffled(state, n_sources), "key")
                      .filter(tied & (F.shiftright(name, bits + STEP_BITS) == F.col("prefix"))))
            sums = inside.groupBy("key", F.shiftright(name, bits).alias("p")).agg(
                F.sum("size").alias("size"), F.count("*").alias("n"), F.first("rest").alias("rest"), F.first("before").alias("was"),
                *(F.first(f"cut_{k}").alias(f"cut_{k}") for k in done))
            # at most 2^STEP_BITS rows a source
            w = Window.partitionBy("key").orderBy("p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
            cum = sums.withColumn("upto", F.col("was") + F.sum("size").over(w))
            # the first bucket whose end passes the rest; the last one if none does
            at = F.min(F.when(F.col("upto") >= F.col("rest"), F.col("p")))
            best = cum.groupBy("key").agg(F.coalesce(at, F.max("p")).alias("p"))
            state = written(cum.join(best, ["key", "p"]).select(
                "key", "rest", F.col("p").alias("prefix"), (F.col("upto") - F.col("size")).alias("before"), F.col("size").alias("held"), "n",
                *(f"cut_{k}" for k in done)), "cut")
        state = state.withColumnRenamed("prefix", f"cut_{name}")
        done.append(name)
        if (state.agg(F.max("n")).first()[0] or 0) <= 1:
            break
    for name in keys[len(done):]:
        state = state.withColumn(f"cut_{name}", F.lit(None).cast("long"))
    room = F.least(F.col("rest") - F.col("before"), F.col("held").cast("double"))
    return state.select("key", *(f"cut_{k}" for k in keys), F.greatest(room, F.lit(0.0)).alias("room"), "held", "n")


def repeat_rows(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3, seed: int = 42) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, by its own source,
    size, id and text; the one fractional repetition a source may have rounds
    to a whole row or none. Of rows equal in id and text at the cut, each is
    taken or left by a hash of its place, in proportion to the room."""
    keys = ("h", "t")
    full, n = _plan(written(_sizes(docs, seed), "sizes"), weights, max_epochs, keys)
    row = docs.select(F.struct("*").alias("row"), _source_key().alias("key"), _size().alias("size"),
                      seeded_hash(seed, "doc_id").alias("h"), seeded_hash(seed, "text").alias("t"),
                      (F.xxhash64(F.lit(seed), F.monotonically_increasing_id()) / F.lit(2.0**64) + 0.5).alias("u"))
    before, at = _against_cut(keys)
    last = (F.when(F.col("n") > 1, F.when(F.col("u") < F.col("room") / F.col("held"), 1).otherwise(0))
            .otherwise(F.round(F.col("room") / F.col("size"))))
    copies = (F.when(F.col("size") == 0, 0).otherwise(F.col("whole") + F.when(before, 1).when(at, last).otherwise(0))).cast("int")
    return (row.join(small_or_shuffled(full, n), "key")
            .select("row", F.explode(F.array_repeat(F.lit(0), copies)).alias("copy")).select("row.*"))

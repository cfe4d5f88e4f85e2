"""Mix sources to target weights by subset-sum budget fitting.

Documents are counted by (source, exact length). Per source a count of documents of
each length is chosen: an equal share first, then a bounded-knapsack dynamic program
for what is left of the budget, from below and, by what is left out, from above. Which documents of a length are taken follows a seeded
hash order, ranked in hash slices so that no task holds all documents of a length."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from callsheet.functions.stages import stored
from callsheet.operators.skew import ranked

#: Budget to which longer ones are filled before the dynamic program looks for an exact sum, and
#: bits of its states up to which it does so for any budget.
EXACT_BUDGET, EXACT_BITS = 1 << 16, 1 << 29


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def knapsack(budget: int, lengths: list[int], counts: list[int]) -> dict[int, int]:
    """How many of each length to take for the largest sum up to ``budget``.

    Bounded knapsack over bit sets: bit s is set when s can be made. Counts are split
    into powers of two; the search ends as soon as the budget itself can be made."""
    full, states, parts = (1 << (budget + 1)) - 1, [1], []
    for length, count in zip(lengths, counts):
        count, step = min(count, budget // length) if length else 0, 1
        while count and not states[-1] >> budget & 1:
            take = min(step, count)
            states.append((states[-1] | states[-1] << take * length) & full)
            parts.append((length, take))
            count, step = count - take, step * 2
    left, chosen = states[-1].bit_length() - 1, {}
    for (length, take), before in zip(reversed(parts), reversed(states[:-1])):
        if not before >> left & 1:
            left -= take * length
            chosen[length] = chosen.get(length, 0) + take
    return chosen


def below(budget: int, lengths: np.ndarray, counts: np.ndarray, shares: bool = True) -> np.ndarray:
    """How many of each length to take for a sum close to ``budget``, at most that.

    Equal shares, one more of each by remainder, then as many spare ones as lead into the
    knapsack's range, longest first; the knapsack is exact for what is left then. Where that
    misses the budget, the same without shares may come nearer."""
    lengths, size = [int(n) for n in lengths], int((lengths * counts).sum())
    share = [int(c) * budget * shares for c in counts]
    take = np.array([s // size for s in share], dtype=np.int64)
    spare = [int(c - t) for c, t in zip(counts, take)]
    left = budget - sum(int(t) * n for t, n in zip(take, lengths))

    def add(i: int, n: int) -> None:
        nonlocal left
        take[i], spare[i], left = take[i] + n, spare[i] - n, left - n * lengths[i]

    for i in sorted(range(len(lengths)), key=lambda i: (-(share[i] % size), lengths[i])):
        if left <= EXACT_BUDGET or not shares:
            break
        if spare[i] and lengths[i] <= left:
            add(i, 1)
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    for i in order:
        if left <= EXACT_BUDGET or left * sum(min(spare[j], left // lengths[j]).bit_length() for j in order) <= EXACT_BITS:
            break
        # Of lengths within the range no more than lead into it.
        most = left // lengths[i] if lengths[i] > EXACT_BUDGET else -(-(left - EXACT_BUDGET) // lengths[i])
        add(i, min(spare[i], most))
    order = [i for i in order if spare[i] and lengths[i] <= left]
    if order:
        at = {lengths[i]: i for i in order}
        for length, n in knapsack(left, [lengths[i] for i in order], [spare[i] for i in order]).items():
            add(at[length], n)
    if left and shares:
        free = below(budget, np.array(lengths), counts, False)
        return free if int((free * np.array(lengths)).sum()) > budget - left else take
    return take


def fit_budget(target: float, lengths: np.ndarray, counts: np.ndarray) -> tuple[int, np.ndarray]:
    """Copies that every document gets, and per length how many documents get one more.

    Of the sums found below and above ``target`` the nearer one, the smaller if both are
    as near. Exact where the budget is in the knapsack's range; lengths are positive and
    distinct."""
    size = int((lengths * counts).sum())
    none = np.zeros(len(lengths), dtype=np.int64)
    if size == 0:
        return 0, none
    copies = min(int(target // size), 2)
    rest = target - copies * size
    if copies == 2 or rest <= 0:
        return copies, none
    under = below(math.floor(rest), lengths, counts)
    short = rest - int((under * lengths).sum())
    if short == 0:
        return copies, under
    # The smallest sum above leaves out the largest one that may be left out.
    over = counts - below(size - math.ceil(rest), lengths, counts)
    return copies, under if short <= int((over * lengths).sum()) - rest else over


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """``sid, source, source_size, target`` per source, from one row per source.

    Sources in code-point order, null last, get ``weights`` in turn. A target is
    min(most x size, level x weight); the level at which they add up to ``share`` of
    all sizes follows from the sources sorted by the level that fills them."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    rows = sizes.withColumn("sid", F.row_number().over(order))
    rows = rows.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("sid") - 1) % len(weights) + 1).cast("int")))
    rows = rows.withColumn("cap", most * F.col("source_size"))
    everything = Window.partitionBy()
    fill = Window.orderBy(F.col("cap") / F.col("w"), "sid")
    before, after = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    rows = (rows.withColumn("total", share * F.sum("source_size").over(everything))
            .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after))
            .withColumn("full", F.col("cap") < F.col("level") * F.col("w")))
    rows = rows.withColumn("open_level", F.max(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("w") * -1, -F.col("sid"), "level"))).over(everything)["level"])
    return rows.select("sid", "source", "source_size",
                       F.when(F.col("full") | F.col("open_level").isNull(), F.col("cap"))
                       .otherwise(F.least("cap", F.col("open_level") * F.col("w"))).alias("target"))


def _fit(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("size")
    copies, take = fit_budget(float(rows["target"].iloc[0]), rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64))
    return pd.DataFrame({"sid": rows["sid"], "size": rows["size"], "n": rows["n"], "copies": copies, "extra": take})


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 7, row: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, source_size, target, taken``.

    ``row`` adds a column of that name to carry along. Reads ``doc_id``, ``text`` and
    ``source``. ``size`` counts words (null text: 0); a document without words is never
    taken. A null source is a source of its own, the last in order. Equal documents are
    told apart by id only: rows repeated with one id take their places in any order.
    An empty table gives an empty result.

    A source's histogram has at most as many rows as it has distinct lengths, which is
    what one fitting task holds, never its documents."""
    carried = [row.alias("row")] if row is not None else []
    sized = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *carried), "mix_sizes")
    # Seeded order of the documents; a row's place in the written table tells rows of one id apart.
    h = F.xxhash64(F.lit(seed), F.col("doc_id"))
    sized = sized.select("*", F.struct(h.alias("h"), "doc_id", F.col("_metadata.file_name").alias("file"),
                                       F.col("_metadata.row_index").alias("at")).alias("place"))
    hist = sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    goal = stored(targets(hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share, most), "mix_targets")
    same = F.col("a.source").eqNullSafe(F.col("b.source"))
    plan = (hist.filter("size > 0").alias("a").join(goal.alias("b"), same).select("b.sid", "a.size", "a.n", "b.target")
            .groupBy("sid").applyInPandas(_fit, "sid int, size long, n long, copies int, extra long"))
    plan = stored(plan, "mix_plan")
    rows = sized.alias("a").join(goal.alias("b"), same).select("a.*", "b.sid", "b.source_size", "b.target")
    # Lengths of which some documents are taken: the last place that is. Only places are ranked, no texts.
    some = rows.select("sid", "size", "place").join(plan.filter("0 < extra and extra < n").select("sid", "size", "extra"), ["sid", "size"])
    some = ranked(some.withColumn("slice", F.shiftright("place.h", 56)), ["sid", "size"], ["slice"], [F.col("place")], "pos")
    last = some.filter("pos = extra").select("sid", "size", F.col("place").alias("last"))
    # One row per length and salt, so that documents of one very frequent length meet it in many tasks.
    salted = plan.join(last, ["sid", "size"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(15))))
    rows = rows.withColumn("salt", F.pmod("place.h", F.lit(16)).cast("int")).join(salted, ["sid", "size", "salt"], "left")
    chosen = (F.col("extra") > 0) & ((F.col("extra") >= F.col("n")) | (F.col("place") <= F.col("last")))
    copies = F.coalesce("copies", F.lit(0)) + F.when(chosen, 1).otherwise(0)
    return rows.select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"),
                       (F.col("size") * copies).cast("long").alias("taken"), *(["row"] if carried else []))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with their own columns."""
    taken = mix(docs, row=F.struct(*[F.col(f"`{c}`") for c in docs.columns]), **options)
    times = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0).cast("int")
    return taken.filter("taken > 0").select("row", F.explode(F.sequence(F.lit(1), times))).select("row.*")

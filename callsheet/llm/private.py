"""Personal data in texts: wide patterns propose spans, boosted trees choose among them.

Everything on the way is a built-in expression. One scan of the texts finds, per kind, the
base spans (a strict pattern and its check) and the candidates of a wider pattern, each with
small integer features of its format and of what stands around it. A candidate that holds
base data is a known example. The features leave out the marks that only the base patterns
demand (a plus sign, plain separators), but keep the checks (octets, check digit), so that
a candidate written in another way can look like the known ones, and one that fails its
check cannot. Equal features are counted over all documents; the counts are bounded by the
number of feature values, trees are boosted on them, and a kind's threshold is the lowest
score whose calibrated rate of known examples is ``share``, on documents kept out of the fit. Nothing but these counts is shuffled."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from callsheet.functions.stages import computed, let, stored

from .common import fold

#: The kinds in their order.
KINDS = ("email", "ip", "card", "phone")
LOCAL, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: Base patterns. Quantifiers give nothing back where that cannot change the match, and a
#: match begins where a run does, so that long runs are read once.
BASE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++(?: ?+[(\[{{<] ?+(?:at|AT|@) ?+[)\]}}>] ?+| ?+@ ?+){LABEL}++"
             rf"(?:(?:\.| ?+[(\[{{<] ?+(?:dot|DOT|\.) ?+[)\]}}>] ?+){LABEL}++)++",
    "ip": r"(?<![0-9A-Za-z.:])(?:[0-9]{1,4}(?:[.,()\[\]-]{1,3}[0-9]{1,4}){3}|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7})(?![0-9A-Za-z])",
    "card": r"(?<![0-9])[0-9](?:[ .,_/-]{0,2}+[0-9]){11,22}+(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:(?:\+|00) ?+)?+\(?+[0-9](?:[ ()./-]{0,3}+[0-9]){6,16}+(?![0-9])",
}
#: Only texts that hold this are searched for a kind (quick tests before slow patterns).
HINT = {"email": r"@|[(\[{<] ?(?:at|AT) ?[)\]}>]", "ip": r"[0-9][.,()\[\]-]|:", "card": "[0-9]", "phone": "[0-9]"}
#: Words before a span that speak for its kind.
WORDS = {"email": r"(?i)mail|contact|write|address", "ip": r"(?i)\bip|addr|host|server", "card": r"(?i)card|visa|master|credit|payment|karte",
         "phone": r"(?i)tel|phone|call|fax|mobile|number|ruf"}
NEAR = 24


def found(text: Column, pattern: str, hint: str, block: int = 128) -> Column:
    """Matches of ``pattern`` as ``raw, start, end`` (code points) with the text around each.

    The text between matches comes from a split at them, so a start is a sum of lengths:
    over blocks of matches, then inside a block."""
    def placed(raws: Column, gaps: Column) -> Column:
        steps = F.transform(raws, lambda r, i: F.length(F.get(gaps, i)) + F.length(r))

        def within(steps: Column) -> Column:
            sums = F.transform(F.sequence(F.lit(0), F.floor((F.size(raws) - 1) / block).cast("int")),
                               lambda b: F.aggregate(F.slice(steps, b * block + 1, F.lit(block)), F.lit(0).cast("long"), lambda a, x: a + x))
            starts = F.aggregate(sums, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<long>").alias("all")), lambda a, x: F.struct(
                (a["at"] + x).alias("at"), F.concat(a["all"], F.array(a["at"])).alias("all")), lambda a: a["all"])

            def match(begins: Column) -> Column:
                def one(raw: Column, i: Column) -> Column:
                    b = F.floor(i / block).cast("int")
                    start = (F.get(begins, b) + F.length(F.get(gaps, i))
                             + F.aggregate(F.slice(steps, b * block + 1, i - b * block), F.lit(0).cast("long"), lambda a, x: a + x))
                    return F.struct(raw.alias("raw"), start.alias("start"), (start + F.length(raw)).alias("end"),
                                    F.right(F.get(gaps, i), F.lit(NEAR)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(1)).alias("after"))

                return F.transform(raws, one)

            return let(starts, match)

        return let(steps, within)

    none = F.array().cast("array<struct<raw:string,start:long,end:long,before:string,after:string>>")
    raws = F.when(text.rlike(hint), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    return let(raws, lambda r: F.when(F.size(r) > 0, let(F.split(text, pattern, -1), lambda gaps: placed(r, gaps))).otherwise(none))


def digits(raw: Column) -> Column:
    return F.regexp_replace(raw, "[^0-9]", "")


def octets(raw: Column) -> Column:
    """Whether all numbers of ``raw`` are 255 at most."""
    return ~raw.rlike(r"(?<![0-9])0*+(?:[1-9][0-9]{3}|[3-9][0-9]{2}|2[6-9][0-9]|25[6-9])")


def check_digit(number: Column) -> Column:
    """Luhn sum of up to 20 digits; every second digit from the right counts as its double's digit sum."""
    even = F.lpad(number, 20, "0")
    odd = F.translate(even, "0123456789", "0246813579")
    total = F.aggregate(F.sequence(F.lit(1), F.lit(20)), F.lit(0), lambda a, i: a + F.substring(
        F.when(i % 2 == 1, odd).otherwise(even), i, F.lit(1)).cast("int"))
    return total % 10 == 0


def _card(raw: Column, longest: int) -> Column:
    return (F.length(raw) <= longest) & let(digits(raw), lambda d: F.length(d).between(13, 19) & check_digit(d))


def valid(kind: str, raw: Column) -> Column:
    """The check of a base match."""
    if kind == "ip":
        return octets(raw)
    if kind == "card":
        return _card(raw, 37)
    if kind == "phone":
        return F.length(digits(raw)).between(9, 15)
    return F.lit(True)


def known(kind: str, raw: Column) -> Column:
    """Whether a candidate holds base data."""
    return let(F.regexp_extract(raw, BASE[kind], 0), lambda m: (m != "") & valid(kind, m))


def _side(char: Column) -> Column:
    return F.when((char == "") | char.rlike(r"\s"), 0).when(char.rlike("[0-9]"), 2).when(char.rlike(r"\p{L}"), 1).otherwise(3)


def _groups(raw: Column) -> Column:
    return F.filter(F.split(raw, "[^0-9]+", -1), lambda g: g != "")


def _group(groups: Column, back: int) -> Column:
    return F.least(F.coalesce(F.length(F.try_element_at(groups, F.lit(-back))), F.lit(0)), F.lit(6))


def features(kind: str, c: Column) -> Column:
    """Small integers: format of the span in its plain writing, and what stands around it."""
    raw = c["raw"]
    around = [_side(F.right(c["before"], F.lit(1))), _side(c["after"]), c["before"].rlike(WORDS[kind]).cast("int")]
    if kind == "email":
        plain = F.regexp_replace(F.regexp_replace(raw, r" ?[(\[{<] ?(?:at|AT|@) ?[)\]}>] ?| ?@ ?", "@"), r" ?[(\[{<] ?(?:dot|DOT|\.) ?[)\]}>] ?", ".")
        return let(plain, lambda p: let(F.substring_index(p, ".", -1), lambda top: F.array(
            F.least(F.length(F.substring_index(p, "@", 1)), F.lit(4)), F.least(F.length(top), F.lit(8)), top.rlike("^[A-Za-z]+$").cast("int"),
            F.least(F.size(F.split(F.substring_index(p, "@", -1), r"\.")), F.lit(4)), *around)))
    if kind == "ip":
        return F.array(octets(raw).cast("int"), raw.contains(":").cast("int"), raw.rlike("(?<![0-9])0[0-9]").cast("int"), *around)
    if kind == "card":
        return let(digits(raw), lambda d: let(_groups(raw), lambda g: F.array(
            F.least(F.length(d), F.lit(20)), ((F.length(d) <= 19) & check_digit(d)).cast("int"), F.least(F.size(g), F.lit(6)), _group(g, 1),
            F.substring(d, 1, 1).cast("int"), *around)))
    core = F.regexp_replace(raw, r"^(?:\+|00) ?[0-9]{1,3}(?=[^0-9])", "")
    return let(core, lambda p: let(_groups(p), lambda g: F.array(
        F.least(F.length(digits(p)), F.lit(13)), F.least(F.size(g), F.lit(6)), _group(g, 1), _group(g, 2), p.contains("(").cast("int"),
        p.rlike("^[^0-9]*0").cast("int"), *around)))


def boosted(x: np.ndarray, known: np.ndarray, n: np.ndarray, trees: int = 12, depth: int = 3, rate: float = 0.4) -> list:
    """Trees on counted feature rows (``known`` of ``n`` each), logistic loss, Newton steps.
    A tree is a leaf value or (feature, highest value on the left, left, right)."""
    score, out = np.zeros(len(x)), []

    def value(rows, g, h):
        return -rate * float(g[rows].sum() / (h[rows].sum() + 1))

    def grow(rows, g, h, level):
        best, cut = 1e-3, None
        whole = g[rows].sum() ** 2 / (h[rows].sum() + 1)
        if level < depth:
            for f in range(x.shape[1]):
                values, place = np.unique(x[rows, f], return_inverse=True)
                gs, hs = np.cumsum(np.bincount(place, g[rows])), np.cumsum(np.bincount(place, h[rows]))
                gain = gs[:-1] ** 2 / (hs[:-1] + 1) + (gs[-1] - gs[:-1]) ** 2 / (hs[-1] - hs[:-1] + 1) - whole
                if len(gain) and gain.max() > best:
                    best, cut = gain.max(), (f, int(values[gain.argmax()]))
        if cut is None:
            return value(rows, g, h)
        left = x[rows, cut[0]] <= cut[1]
        return (*cut, grow(rows[left], g, h, level + 1), grow(rows[~left], g, h, level + 1))

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        tree = grow(np.arange(len(x)), n * p - known, n * p * (1 - p), 0)
        out.append(tree)
        score += tree_values(tree, x)
    return out


def tree_values(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    return np.where(x[:, tree[0]] <= tree[1], tree_values(tree[2], x), tree_values(tree[3], x))


def tree_column(tree, f: Column) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    return F.when(F.get(f, tree[0]) <= tree[1], tree_column(tree[2], f)).otherwise(tree_column(tree[3], f))


def threshold(score: np.ndarray, known: np.ndarray, n: np.ndarray, share: float) -> float:
    """The lowest score with a calibrated rate of known examples of ``share``; infinite if none.
    Rates rise with the score: neighbours that do not are pooled."""
    values, place = np.unique(score, return_inverse=True)
    pools: list[list[float]] = []  # first score, known, candidates
    for v, y, c in zip(values, np.bincount(place, known), np.bincount(place, n)):
        pools.append([v, y, c])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            _, y, c = pools.pop()
            pools[-1][1] += y
            pools[-1][2] += c
    return next((v for v, y, c in pools if y >= share * c), math.inf)


def learn(cells: DataFrame, share: float, least: int) -> dict[str, tuple[list, float]]:
    """Trees and threshold per kind from ``kind, f, held, n, known`` rows.

    Every feature is capped, so there are some ten thousand rows per kind at most, however
    many documents were counted. A kind with fewer than ``least`` known examples has no model."""
    by: dict[str, list] = {}
    for r in cells.collect():
        by.setdefault(r["kind"], []).append(r)
    out = {}
    for kind, rows in by.items():
        rows.sort(key=lambda r: (r["f"], r["held"]))  # sums do not depend on the order of arrival
        x, n, y = np.array([r["f"] for r in rows]), np.array([r["n"] for r in rows], float), np.array([r["known"] for r in rows], float)
        held = np.array([r["held"] for r in rows])
        if y.sum() < least or y.sum() == n.sum():
            continue
        fit = ~held if y[~held].sum() and y[held].sum() >= least else np.ones(len(rows), bool)
        test = ~fit if not fit.all() else fit
        trees = boosted(x[fit], y[fit], n[fit])
        score = sum(tree_values(t, x[test]) for t in trees)
        at = threshold(score, y[test], n[test], share)
        if at < math.inf:
            out[kind] = trees, at - 1e-9
    return out


def find_private(docs: DataFrame, share: float = 0.5, least: int = 20, row: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, base, spans``, and ``row`` if given.

    ``base`` and ``spans`` are arrays of ``kind`` (its place in ``KINDS``), ``start``, ``end`` in
    code points, end exclusive, in that order; ``spans`` holds all of ``base`` and the candidates
    chosen beside it. Spans of different kinds may overlap. Reads ``doc_id`` and ``text`` (null:
    empty); no other column decides. Rows repeated with one id and null ids stay rows. An empty
    table gives an empty result; without enough known examples ``spans`` is ``base``."""
    extra = ["row"] if row is not None else []
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *([row.alias("row")] if extra else []))

    def base(kind: str) -> Column:
        return F.transform(F.filter(found(F.col("text"), BASE[kind], HINT[kind]), lambda c: valid(kind, c["raw"])),
                           lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end")))

    def wide(kind: str) -> Column:
        return F.transform(found(F.col("text"), WIDE[kind], HINT[kind]), lambda c: F.struct(
            c["start"].alias("start"), c["end"].alias("end"), known(kind, c["raw"]).alias("known"), features(kind, c).alias("f")))

    scanned = computed(rows, **{f"base_{k}": base(k) for k in KINDS}, **{f"wide_{k}": wide(k) for k in KINDS}).drop("text")
    spans = stored(scanned, "private_spans")
    cells = None
    for k in KINDS:
        one = spans.select(F.lit(k).alias("kind"), F.coalesce(fold(F.col("doc_id"), 4) == 0, F.lit(False)).alias("held"), F.inline(f"wide_{k}"))
        cells = one if cells is None else cells.unionByName(one)
    models = learn(cells.groupBy("kind", "f", "held").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("known").cast("long")).alias("known")), share, least)

    def told(kind: str, column: Column) -> Column:
        return F.transform(column, lambda c: F.struct(F.lit(KINDS.index(kind)).alias("kind"), c["start"].alias("start"), c["end"].alias("end")))

    def added(kind: str) -> Column:
        if kind not in models:
            return F.array().cast("array<struct<kind:int,start:long,end:long>>")
        trees, least_score = models[kind]

        def chosen(c: Column) -> Column:
            score = tree_column(trees[0], c["f"])
            for t in trees[1:]:
                score = score + tree_column(t, c["f"])
            return ~c["known"] & (score >= least_score)

        return told(kind, F.filter(f"wide_{kind}", chosen))

    base_all = F.concat(*[told(k, F.col(f"base_{k}")) for k in KINDS])
    return computed(spans, base=base_all, added=F.concat(*[added(k) for k in KINDS])).select(
        "doc_id", "base", F.when(F.size("added") == 0, F.col("base")).otherwise(F.array_sort(F.concat("base", "added"))).alias("spans"), *extra)


def redacted(text: Column, spans: Column, block: int = 4096) -> Column:
    """``text`` with each span replaced by its kind in brackets; of overlapping spans the
    first counts and is drawn out to the last one's end. Cost grows with the text and with
    the square of its number of spans."""
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
    name = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def merge(acc: Column, s: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))
        return F.when((F.size(acc) > 0) & (s["start"] < last["end"]), F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(wider))).otherwise(F.concat(acc, F.array(s)))

    def cut(parts: Column, start: Column, end: Column) -> Column:
        first = F.floor(start / block).cast("int")
        some = F.array_join(F.slice(parts, first + 1, F.floor((end - 1) / block).cast("int") - first + 1), "")
        return F.when(end > start, F.substring(some, (start - first * block + 1).cast("int"), (end - start).cast("int"))).otherwise("")

    def put(merged: Column) -> Column:
        def piece(parts: Column, s: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get(merged, i - 1)["end"]).otherwise(F.lit(0).cast("long"))
            return F.concat(cut(parts, before, s["start"]), F.get(name, s["kind"]))

        return let(blocks, lambda parts: F.concat(F.array_join(F.transform(merged, lambda s, i: piece(parts, s, i)), ""),
                                                  cut(parts, F.try_element_at(merged, F.lit(-1))["end"], F.length(text).cast("long"))))

    none = F.array().cast("array<struct<start:long,end:long,kind:int>>")
    return F.when(F.size(spans) == 0, text).otherwise(let(F.aggregate(order, none, merge), put))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def digests(found_spans: DataFrame) -> DataFrame:
    """Counts and hash of the base spans, and all spans as text."""
    def count(k: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    return found_spans.select("doc_id", *map(count, range(len(KINDS))), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))

"""Personal data by candidates and gradient-boosted trees, in DataFrame operations only.

Base patterns (e-mail, IP address, card, phone) give spans that always stay. Two high-recall generators propose
further, overlapping candidates: runs of digits with separators, and anything around an ``@``. Boosted
trees, one ensemble per kind, score each candidate from its format and context; a threshold per kind,
calibrated to ``MIN_PRECISION``, selects the spans that are added. All candidates of all texts are learned from, labelled by the base
patterns' checks (checksum, ranges, digit counts), which the features do not contain. Spark finds and counts them: features are cut into ``BINS``
by quantiles of all candidates, and the driver, which fits the trees, gets one row with a number for all candidates whose bins are alike. Scoring
is one CASE expression per tree; precision is that of scores by trees that did not see the candidate.

There is no least number of examples: with few, leaves and the measured precision shrink, the latter towards that of all kinds
together, so fewer unlike candidates or none are added. A kind without any base span in the table adds nothing.

All spans count code points, with exclusive ends. Inputs: a null text is an empty one; rows repeat as given, null ids
included; texts of null ids are learned from, and copies count once there. Only id and text are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillhouse.llm.common import SPACE, fenced, written

KINDS = ("email", "ip", "card", "phone")
# The base patterns; possessive, and where a run can only match from its start, bound to it: same
# matches as the plain patterns in linear time, also for very long runs.
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
DIGIT_RUN = r"[+(]?[0-9](?:[\x20.()/-]{0,2}[0-9]){6,24}"
AROUND_AT = rf"(?:(?<![^{SPACE}@])|\G)[^{SPACE}@]++\x20?@\x20?[^{SPACE}@]++"
#: Words before a candidate that tell of its kind, in the languages at hand.
CONTEXT = {"near_phone": "phone|tel|call|fon|fax|mobil", "near_card": "card|visa|pay|karte|carte|tarjeta",
           "near_ip": "ip|host|server|addr", "near_secret": "token|key|secret|sha|hash|="}
FEATURES = ("n_digits", "n_chars", "n_dots", "n_blanks", "n_dashes", "n_brackets", "plus", "zero_first", "longest_run",
            "letter_before", "letter_after", "dots_after_at", *CONTEXT)

#: Bins of a feature.
BINS = 16
ROUNDS, DEPTH, RATE, LEAF = 15, 3, 0.3, 10
#: Parts for scores by trees that did not see a row.
PARTS = 3
MIN_PRECISION = 0.98
#: Rows that the precision of all kinds counts for: as many as one error is allowed in.
PRIOR = 1 / (1 - MIN_PRECISION)
BLOCK = 256


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once and bound to a name."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def matches(text: Column, pattern: str) -> Column:
    """All leftmost matches as array<struct<s, e, v>>; places are sums over blocks of matches."""
    def placed(items: Column, at: Column, shift) -> Column:
        zero = F.struct(at.alias("at"), F.expr("cast(array() as array<struct<s:int,e:int,v:string>>)").alias("out"))
        return F.aggregate(items, zero, shift)

    def of(items: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int")), lambda b: placed(
            F.slice(items, b * BLOCK + 1, BLOCK), F.lit(0), lambda a, x: F.struct(
                (a["at"] + x["d"]).alias("at"), F.concat(a["out"], F.array(F.struct(
                    (a["at"] + x["d"] - x["l"]).alias("s"), (a["at"] + x["d"]).alias("e"), x["v"].alias("v")))).alias("out"))))
        return placed(blocks, F.lit(0), lambda a, b: F.struct(
            (a["at"] + b["at"]).alias("at"), F.concat(a["out"], F.transform(b["out"], lambda x: F.struct(
                (x["s"] + a["at"]).alias("s"), (x["e"] + a["at"]).alias("e"), x["v"].alias("v")))).alias("out")))["out"]

    none = F.expr("cast(array() as array<struct<s:int,e:int,v:string>>)")
    items = lambda hits: F.filter(F.zip_with(F.split(text, pattern, -1), hits, lambda p, h: F.struct(
        (F.length(p) + F.length(h)).alias("d"), F.length(h).alias("l"), h.alias("v"))), lambda x: x["v"].isNotNull())
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
               lambda hits: F.when(F.size(hits) > 0, let(items(hits), of)).otherwise(none))


def digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(number: Column) -> Column:
    def step(total, i):
        d = F.substring(F.reverse(number), i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)
    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), step) % 10 == 0


def passes(kind: str, v: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(v, r"\."), lambda p: let(F.regexp_replace(p, "^0+", ""), lambda x: (F.length(x) <= 3) & (
            F.coalesce(x.try_cast("int"), F.lit(0)) <= 255)))
    if kind == "card":
        return let(digits(v), lambda x: F.length(x).between(12, 19) & luhn(x))
    if kind == "phone":
        return F.length(digits(v)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Spans of the base patterns as array<struct<s, k, e, kind>>, in order."""
    might = {"email": text.contains("@"), "ip": text.rlike(r"[0-9]\.[0-9]+\.[0-9]"), "phone": text.rlike(r"\+[0-9]"),
             "card": text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}")}
    none = F.expr("cast(array() as array<struct<s:int,k:int,e:int,kind:string>>)")

    def of_kind(k: int, kind: str) -> Column:
        valid = F.filter(matches(text, PATTERNS[kind]), lambda m: passes(kind, m["v"]))
        return F.when(might[kind], F.transform(valid, lambda m: F.struct(
            m["s"], F.lit(k).alias("k"), m["e"], F.lit(kind).alias("kind")))).otherwise(none)

    return F.sort_array(F.concat(*[of_kind(k, kind) for k, kind in enumerate(KINDS)]))


def candidates(text: Column, base: Column) -> Column:
    """Proposed spans with features; ``base`` labels them: the kind of the base span they overlap, else null."""
    def count(v, chars):
        return F.length(v) - F.length(F.translate(v, chars, ""))

    def features(m):
        v, before = m["v"], F.lower(F.substring(text, F.greatest(m["s"] - 23, F.lit(1)), F.least(m["s"], F.lit(24))))
        after = F.substring(text, m["e"] + 1, F.lit(1))
        runs = F.regexp_extract_all(v, F.lit("[0-9]+"), F.lit(0))
        over = F.filter(base, lambda b: (b["s"] < m["e"]) & (m["s"] < b["e"]))
        return F.struct(
            m["s"], m["e"], F.get(over, F.lit(0))["kind"].alias("label"), F.length(digits(v)).alias("n_digits"),
            F.length(v).alias("n_chars"), count(v, ".").alias("n_dots"), count(v, " ").alias("n_blanks"),
            count(v, "-").alias("n_dashes"), count(v, "()").alias("n_brackets"), v.startswith("+").cast("int").alias("plus"),
            v.startswith("0").cast("int").alias("zero_first"),
            F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0)).alias("longest_run"),
            F.substring(before, -1, 1).rlike(r"[\p{L}0-9_\"'=]").cast("int").alias("letter_before"),
            after.rlike(r"[\p{L}0-9_\"']").cast("int").alias("letter_after"),
            F.when(v.contains("@"), count(F.regexp_replace(v, "^[^@]*@", ""), ".")).otherwise(-1).alias("dots_after_at"),
            *[before.rlike(words).cast("int").alias(name) for name, words in CONTEXT.items()])

    numbers = F.when(text.rlike("[0-9]"), matches(text, DIGIT_RUN))
    mails = F.when(text.contains("@"), matches(text, AROUND_AT))
    none = F.expr("cast(array() as array<struct<s:int,e:int,v:string>>)")
    return F.transform(F.concat(F.coalesce(mails, none), F.coalesce(numbers, none)), features)


def _tree(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, w: np.ndarray, cuts: list[np.ndarray], bins: np.ndarray, depth: int,
          least: int):
    """A regression tree as (feature, threshold, low, high), or a leaf's value; splits are sought among ``cuts``
    and leave ``least`` candidates on each side."""
    leaf = float(RATE * grad.sum() / (hess.sum() + 1))
    gain, split = 1e-6, None
    if depth and w.sum() >= 2 * least:
        g, h = grad.sum(), hess.sum()
        for f, at in enumerate(cuts):
            low_g, low_h, low_n = (np.cumsum(np.bincount(bins[:, f], v, len(at) + 1))[:-1] for v in (grad, hess, w))
            worth = low_g ** 2 / (low_h + 1) + (g - low_g) ** 2 / (h - low_h + 1) - g * g / (h + 1)
            worth[(low_n < least) | (w.sum() - low_n < least)] = 0
            if len(at) and worth.max() > gain:
                gain, split = worth.max(), (f, float(at[worth.argmax()]))
    if split is None:
        return leaf
    low = x[:, split[0]] <= split[1]
    return *split, *(_tree(x[m], grad[m], hess[m], w[m], cuts, bins[m], depth - 1, least) for m in (low, ~low))


def _value(tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    f, t, low, high = tree
    return np.where(x[:, f] <= t, _value(low, x), _value(high, x))


def boosted(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> list:
    """Trees whose summed values are the log odds of ``y``, each row ``w`` times; leaves shrink towards 0, and get smaller with few positives."""
    least = int(min(LEAF, max(1, (w * y).sum() // 4)))
    cuts = [np.unique(c)[:-1] for c in x.T]
    bins = np.stack([np.searchsorted(c, v) for c, v in zip(cuts, x.T)], axis=1)
    total, trees = np.zeros(len(y)), []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-total))
        trees.append(_tree(x, w * (y - p), w * p * (1 - p), w, cuts, bins, DEPTH, least))
        total = total + _value(trees[-1], x)
    return trees


def scored(trees: list, x: np.ndarray) -> np.ndarray:
    return sum((_value(t, x) for t in trees), np.zeros(len(x)))


def crossed(x: np.ndarray, y: np.ndarray, w: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Each row's score by trees that did not see its part."""
    out = np.zeros(len(y))
    for k in range(PARTS):
        if (part == k).any() and (part != k).any():
            out[part == k] = scored(boosted(x[part != k], y[part != k], w[part != k]), x[part == k])
    return out


def lowest_precise(scores: dict[str, np.ndarray], ys: dict[str, np.ndarray], w: np.ndarray) -> dict[str, float]:
    """By kind the lowest score from which on the weighted precision is at least ``MIN_PRECISION``, if there is one.

    It is shrunk towards that of all kinds together from the same score on, which counts like ``PRIOR`` rows.
    """
    def falling(s: np.ndarray, y: np.ndarray, w: np.ndarray):
        order = np.argsort(-s, kind="stable")
        last = np.append(s[order][1:] != s[order][:-1], True)
        return s[order][last], np.cumsum((w * y)[order])[last], np.cumsum(w[order])[last]

    all_s, all_right, all_n = falling(np.concatenate([*scores.values()]), np.concatenate([*ys.values()]), np.tile(w, len(scores)))
    found = {}
    for kind, score in scores.items():
        s, right, n = falling(score, ys[kind], w)
        at = np.searchsorted(-all_s, -s, side="right") - 1
        good = (right > 0) & (right + PRIOR * all_right[at] / all_n[at] >= MIN_PRECISION * (n + PRIOR))
        if good.any():
            found[kind] = float(s[good].min())
    return found


def fit_trees(x: np.ndarray, labels: list[str | None], w: np.ndarray, part: np.ndarray) -> dict[str, tuple[list, float]]:
    """For each kind with positives its trees and the lowest sum of their values that is precise enough, both on parts
    the trees did not see and on all; ``w`` says how many candidates a row counts."""
    ys = {k: y for k in KINDS if (y := np.array([v == k for v in labels], float)).any()}
    if not ys:
        return {}
    trees = {k: boosted(x, y, w) for k, y in ys.items()}
    unseen = lowest_precise({k: crossed(x, y, w, part) for k, y in ys.items()}, ys, w)
    seen = lowest_precise({k: scored(t, x) for k, t in trees.items()}, ys, w)
    return {k: (trees[k], max(unseen[k], seen[k])) for k in ys if k in unseen and k in seen}


def tree_column(tree, c: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    f, t, low, high = tree
    return F.when(c[FEATURES[f]] <= t, tree_column(low, c)).otherwise(tree_column(high, c))


def _counts(docs: DataFrame, text_col: str) -> list:
    """All candidates by part, label and bins, with their number ``w``; a bin is named by its greatest value, the last by the cut before it and one more."""
    text = F.col("t")
    rows = docs.select(F.col(text_col).alias("t")).where(text.rlike("[0-9@]"))
    texts = rows.groupBy(F.xxhash64("t").alias("key")).agg(F.first("t").alias("t"))  # copies of a text count once
    found = texts.withColumn("b", fenced(base_spans(text)))
    found = found.select("key", F.explode(fenced(candidates(text, F.col("b")))).alias("c")).select("key", "c.*")
    part = F.pmod(F.xxhash64("key", "s", "e"), F.lit(PARTS)).alias("part")
    held = written(found.groupBy(part, "label", *FEATURES).agg(F.count("*").alias("w")), "personal-data-candidates")
    at = ", ".join(str(k / BINS) for k in range(BINS + 1))
    cuts = held.agg(*[F.expr(f"percentile({f}, array({at}), w)").alias(f) for f in FEATURES]).first()

    def binned(f: str) -> Column:
        ends = sorted({int(v) for v in cuts[f] or ()})[:-1]
        return F.coalesce(*[F.when(F.col(f) <= v, F.lit(v)) for v in ends], F.lit(ends[-1] + 1 if ends else 0)).alias(f)

    # At most some thousands of rows, see the README; in order, so that sums are the same each time.
    return held.groupBy("part", "label", *map(binned, FEATURES)).agg(F.sum("w").alias("w")).orderBy("part", "label", *FEATURES).collect()


def fit(docs: DataFrame, text_col: str = "text") -> dict[str, tuple[list, float]]:
    """Trees and threshold by kind, from all candidates; a kind without base spans has none."""
    found = _counts(docs, text_col)
    x = np.array([[r[f] for f in FEATURES] for r in found], float).reshape(-1, len(FEATURES))
    return fit_trees(x, [r["label"] for r in found], *(np.array([r[c] for r in found], float) for c in ("w", "part")))


def added_spans(text: Column, base: Column, model: dict[str, tuple[list, float]]) -> Column:
    """Candidates that overlap no base span and that a kind's trees select; the first such kind counts."""
    none = F.expr("cast(array() as array<struct<s:int,k:int,e:int,kind:string>>)")
    if not model:
        return none

    def judged(c):
        kind = F.lit(None).cast("int")
        for k in reversed(range(len(KINDS))):
            if KINDS[k] in model:
                trees, least = model[KINDS[k]]
                total = sum((tree_column(t, c) for t in trees[1:]), tree_column(trees[0], c))
                kind = F.when(total >= least - 1e-9, F.lit(k)).otherwise(kind)
        return F.struct(c["s"], kind.alias("k"), c["e"])

    fresh = F.filter(candidates(text, base), lambda c: c["label"].isNull())
    chosen = F.filter(F.transform(fresh, judged), lambda c: c["k"].isNotNull())
    return F.transform(chosen, lambda c: F.struct(c["s"], c["k"], c["e"], F.get(F.array(*map(F.lit, KINDS)), c["k"]).alias("kind")))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       model: dict[str, tuple[list, float]] | None = None) -> DataFrame:
    """The rows with ``base_found`` and ``found``: spans of the base patterns, and of all, in order.

    Columns of the input with these names are replaced.
    """
    model = fit(docs, text_col) if model is None else model
    carried = [c for c in docs.columns if c not in ("base_found", "found") or c in (id_col, text_col)]
    df = docs.select(F.struct(*carried).alias("_row"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    df = df.withColumn("_b", fenced(F.when(F.col("_t").rlike("[0-9@]"), base_spans(F.col("_t")))))
    none = F.expr("cast(array() as array<struct<s:int,k:int,e:int,kind:string>>)")
    more = F.when(F.col("_t").rlike("[0-9@]"), F.sort_array(F.concat("_b", added_spans(F.col("_t"), F.col("_b"), model))))
    df = df.withColumn("_f", fenced(more))
    return df.select("_row.*", F.coalesce("_b", none).alias("base_found"), F.coalesce("_f", none).alias("found"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans become one, named after the first."""
    def join(a, x):
        last = F.element_at(a, -1)
        return F.when((F.size(a) > 0) & (x["s"] < F.try_element_at(a, F.lit(-1))["e"]), F.concat(
            F.slice(a, 1, F.size(a) - 1), F.array(F.struct(last["s"], F.greatest(last["e"], x["e"]).alias("e"), last["kind"])))
        ).otherwise(F.concat(a, F.array(F.struct(x["s"], x["e"], x["kind"]))))

    apart = F.aggregate(spans, F.expr("cast(array() as array<struct<s:int,e:int,kind:string>>)"), join)
    start = lambda m, i: F.coalesce(F.get(m, i - 1)["e"], F.lit(0))
    pieces = let(apart, lambda m: F.concat(F.array_join(F.transform(m, lambda x, i: F.concat(
        F.substring(text, start(m, i) + 1, x["s"] - start(m, i)), F.lit("["), F.upper(x["kind"]), F.lit("]"))), ""),
        F.substring(text, F.element_at(m, -1)["e"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, pieces).otherwise(text)

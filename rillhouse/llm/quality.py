"""Quality rules: a decision list learned by sequential covering, emitted as Spark conditions.

Statistics of each whole text are column expressions. A list is learned from labelled statistics: each rule
grows by the threshold condition that gains most information on two thirds of the rows, is pruned on
the last third, and covers rows that later rules no longer see. The ordered rules become one CASE
expression: the first that fits rejects, and the default keeps.

Learning sees at most ``SAMPLE_ROWS`` labelled rows, picked by a hash of the id; all else covers all rows.

Inputs: a null text has no words. Rows repeat as given, null ids included. Labels that are null, or of ids
without a text, are left out; without bad or without good examples the list is empty and keeps all. Only id
and text are read; other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillhouse.llm.common import SPACE, fenced

#: Labelled rows that learning sees at most.
SAMPLE_ROWS = 6000
MIN_WORDS = 50
#: A rule must be right for this share of the rows it covers when pruned, and cover so many rows when grown.
MIN_PRECISION = 0.95
MIN_COVER = 8
MAX_CONDITIONS = 3
MAX_RULES = 12
THRESHOLDS = 32

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_digits")
#: Shares that conditions compare with thresholds.
FEATURES = {
    "symbols_per_word": ("n_symbols", "n_words"), "upper_share": ("n_upper", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"), "digit_share": ("n_digits", "word_chars"),
    "repeat_share": ("n_repeat_words", "n_words"), "dup_line_share": ("n_dup_lines", "n_lines"),
}


def with_statistics(docs: DataFrame, text: Column) -> DataFrame:
    """The rows with the counts named in ``COUNTS``, each over the whole text."""
    df = docs.withColumn("_text", F.coalesce(text, F.lit("")))
    df = df.withColumn("_words", F.filter(F.split("_text", f"[{SPACE}]+", -1), lambda w: w != ""))
    df = df.withColumn("_lines", F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(f"[^{SPACE}]")))
    w = F.col("_words")
    df = df.withColumn("n_words", F.size("_words").cast("long")).withColumn("_windows", F.when(
        F.col("n_words") >= 3, F.transform(F.sequence(F.lit(0), F.size("_words") - 3),
                                           lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))))
    # Only texts in which some window recurs have theirs sorted with their places.
    df = df.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    s = F.col("_sorted")
    again = F.filter(s, lambda x, k: (F.get(s, k - 1)["h"].eqNullSafe(x["h"])) | (F.get(s, k + 1)["h"].eqNullSafe(x["h"])))
    covered = F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    counts = {
        "n_words": F.col("n_words"), "word_chars": F.length(F.regexp_replace("_text", f"[{SPACE}]+", "")),
        "n_symbols": F.regexp_count("_text", F.lit(r"[#*$%&|<>]")),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.coalesce(F.size(covered), F.lit(0)), "n_lines": F.size("_lines"),
        "n_upper": F.regexp_count("_text", F.lit(r"\p{Lu}")), "n_marks": F.regexp_count("_text", F.lit(r"[!?]")),
        "n_digits": F.regexp_count("_text", F.lit(r"[0-9]")),
    }
    df = df.select(*docs.columns, fenced(F.struct(*[c.cast("long").alias(n) for n, c in counts.items()])).alias("_counts"))
    return df.select(*docs.columns, "_counts.*")


def feature(name: str) -> Column:
    above, below = FEATURES[name]
    return F.when(F.col(below) > 0, F.col(above) / F.col(below)).otherwise(F.lit(0.0))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        v = values[self.feature]
        return v > self.threshold if self.above else v <= self.threshold

    def column(self) -> Column:
        f = feature(self.feature)
        return f > self.threshold if self.above else f <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _fits(rule: Rule, values: dict[str, np.ndarray]) -> np.ndarray:
    return np.logical_and.reduce([c.holds(values) for c in rule])


def _best_condition(values: dict[str, np.ndarray], bad: np.ndarray) -> Condition | None:
    """The condition of most information gain over the rows given.

    Thresholds lie half-way between neighbouring quantiles of the bad rows and of all rows.
    """
    p, n = int(bad.sum()), int((~bad).sum())
    gain, best = 1e-9, None
    for name in FEATURES:
        v = values[name]
        q = np.unique(np.concatenate([np.quantile(x, np.linspace(0, 1, THRESHOLDS + 1), method="lower") for x in (v, v[bad])]))
        cuts = (q[:-1] + q[1:]) / 2
        p_low, n_low = (np.searchsorted(np.sort(x), cuts, side="right") for x in (v[bad], v[~bad]))
        for above, p1, n1 in ((True, p - p_low, n - n_low), (False, p_low, n_low)):
            with np.errstate(divide="ignore", invalid="ignore"):
                g = np.where(p1 >= MIN_COVER, p1 * (np.log2(p1 / (p1 + n1)) - np.log2(p / (p + n))), 0.0)
            if len(g) and g.max() > gain:
                gain, best = g.max(), Condition(name, above, float(cuts[g.argmax()]))
    return best


def learn_rules(rows: list[dict]) -> list[Rule]:
    """Ordered rules for bad rows; each row holds the features and ``bad`` (0 or 1)."""
    rules: list[Rule] = []
    values = {name: np.array([r[name] for r in rows], float) for name in FEATURES}
    bad = np.array([r["bad"] for r in rows], bool)
    while len(rules) < MAX_RULES:
        held = np.arange(len(bad)) % 3 == 0
        inside, rule = ~held, ()
        if bad[inside].sum() < MIN_COVER:
            break
        while len(rule) < MAX_CONDITIONS and not bad[inside].all():
            best = _best_condition({k: v[inside] for k, v in values.items()}, bad[inside])
            if best is None:
                break
            rule += (best,)
            inside = inside & best.holds(values)
        if not rule:
            break

        def worth(r: Rule) -> float:
            hit = bad[_fits(r, values) & held]
            return (2 * hit.sum() - len(hit)) / len(hit) if len(hit) else -1.0

        rule = max((rule[:k] for k in range(len(rule), 0, -1)), key=worth)
        fits = _fits(rule, values)
        if bad[fits].sum() < MIN_PRECISION * fits.sum():
            break
        rules.append(rule)
        values, bad = {k: v[~fits] for k, v in values.items()}, bad[~fits]
    return rules


def labelled_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """Features and label of at most ``sample_rows`` labelled texts; a bounded list."""
    picked = labels.select(F.col(id_col).alias("k"), F.col(label_col).alias("y")).where("k IS NOT NULL AND y IS NOT NULL")
    picked = picked.orderBy(F.xxhash64("k"), "k", "y").limit(sample_rows)
    texts = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).join(F.broadcast(picked), "k")
    stats = with_statistics(texts, F.col("t")).orderBy(F.xxhash64("k"), "k").limit(sample_rows)
    rows = stats.select((F.col("y") == 0).cast("int").alias("bad"), *[feature(n).alias(n) for n in FEATURES]).collect()
    return [r.asDict() for r in rows]


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that fits, from 1; 0 where none does."""
    out = None
    for i, rule in enumerate(rules, 1):
        fits = rule[0].column()
        for c in rule[1:]:
            fits &= c.column()
        out = F.when(fits, F.lit(i)) if out is None else out.when(fits, F.lit(i))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def judge_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  rules: list[Rule] | None = None) -> DataFrame:
    """The rows with counts, ``base_failed``, ``rule`` (number of the learned rule that rejects, else 0) and ``kept``.

    Columns of the input with such names are replaced.
    """
    if rules is None:
        rules = learn_rules(labelled_rows(docs, labels, id_col, text_col))
    own = [*COUNTS, "base_failed", "rule", "kept"]
    carried = [c for c in docs.columns if c not in own or c in (id_col, text_col)]
    stats = with_statistics(docs.select(F.struct(*carried).alias("_row"), F.col(text_col).alias("_in")), F.col("_in"))
    stats = stats.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) |
                             (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    stats = stats.withColumn("rule", verdict(rules))
    return stats.select("_row.*", *COUNTS, "base_failed", "rule",
                        (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"))

"""Quality rules as a learned decision list (operator 13), DataFrame only.

Method: sequential covering.  Labelled rows are described by statistics of
their texts and split by a hash of the id into a growing and a pruning part.  A
rule is a conjunction of thresholds; it grows by the condition of the highest
information gain until it covers no good row (or gains nothing), then loses the
last conditions that do not pay on the pruning part.  A rule that is precise
enough there is appended, the rows it covers are removed, and the next one is
grown.  The list is emitted as one ordered ``CASE WHEN`` expression.

Each step is one aggregation over the labelled rows: histograms by statistic,
cut, part and label (a few hundred counts whatever the corpus).  At most
``TRAIN_ROWS`` labelled rows are learnt from, those with the least hash of
their id.

Statistics are built-in functions over whole texts: arrays of words, hashes of
three-word windows, and a sort of a text's own windows where any two are equal.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_written, text_of, written
from .quality import held_out

#: Bound of the training sample, of the list and of a rule.
TRAIN_ROWS, MAX_RULES, MAX_CONDITIONS = 12_000, 24, 3
#: Cuts of a statistic: quantiles of the good and of the bad rows.
CUTS = 24
#: What a pruned rule has to reach on the pruning part.
PRECISION, LEAST_COVER = 0.9, 3
#: A window of words counts as repeated if it is found twice or more.
WINDOW = 3

#: The text is refused before any rule if it has fewer words, or if more than
#: this share (in percent) of its words stands in repeated windows.
LEAST_WORDS, MOST_REPEATED = 50, 50


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words_of(text: Column) -> Column:
    r"""Runs of anything but blank, tab and line ends (Java's ``\S+``)."""
    return F.array_remove(F.split(text, r"\s+"), "")


def repeated_words(words: Column) -> Column:
    """Words inside windows of three words that the text holds twice or more.

    Windows are 64-bit hashes.  Only a text with equal windows is sorted; its
    places in order then count three words each, less what two places share.
    """

    def places(windows: Column) -> Column:
        ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def equal_ones(s: Column) -> Column:
            # A neighbour beyond either end is null, and so is the comparison.
            same = lambda e, j: (F.get(s, j - 1)["h"] == e["h"]) | (F.get(s, j + 1)["h"] == e["h"])
            return F.array_sort(F.transform(F.filter(s, same), lambda e: e["i"]))

        return let(ordered, equal_ones)

    def covered(at: Column) -> Column:
        shares = F.transform(at, lambda p, j: F.coalesce(F.least(p - F.get(at, j - 1), F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(shares, F.lit(0), lambda a, b: a + b)

    def count(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(places(windows), covered))

    def windows_of(h: Column) -> Column:
        starts = F.slice(h, 1, F.greatest(F.size(h) - (WINDOW - 1), F.lit(0)))
        return F.transform(starts, lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return let(hashed, lambda h: let(windows_of(h), count))


def statistics(docs: DataFrame, keep: dict[str, Column], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and the counts of every whole text (null: empty).

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols`` (of
    ``#*$%&|<>``), ``n_lines`` (lines with a word), ``n_dup_lines`` (those equal
    to an earlier line), ``n_repeat_words``, ``n_distinct`` (different words),
    ``n_upper`` (A-Z) and ``n_marks`` (of ``.,;:!?``).
    """
    held = docs.select(*[c.alias(k) for k, c in keep.items()], text_of(text_col).alias("_text"))
    cut = held.withColumns({"_words": words_of(F.col("_text")), "_lines": F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"\S"))})
    of_class = lambda chars: F.octet_length(F.regexp_replace("_text", f"[^{chars}]+", ""))
    counts = {
        "n_words": F.size("_words"),
        "word_chars": F.char_length(F.array_join("_words", "")),
        "n_symbols": of_class("#*$%&|<>"),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": repeated_words(F.col("_words")),
        "n_distinct": F.size(F.array_distinct("_words")),
        "n_upper": of_class("A-Z"),
        "n_marks": of_class(".,;:!?"),
    }
    return cut.select(*keep, *[c.cast("long").alias(n) for n, c in counts.items()])


#: What rules compare with a threshold; a share of nothing is zero.
FEATURES: dict[str, str] = {
    "symbols_per_word": "coalesce(try_divide(n_symbols, n_words), 0D)",
    "upper_per_char": "coalesce(try_divide(n_upper, word_chars), 0D)",
    "marks_per_word": "coalesce(try_divide(n_marks, n_words), 0D)",
    "distinct_per_word": "coalesce(try_divide(n_distinct, n_words), 0D)",
    "repeats_per_word": "coalesce(try_divide(n_repeat_words, n_words), 0D)",
    "equal_lines_per_line": "coalesce(try_divide(n_dup_lines, n_lines), 0D)",
    "chars_per_word": "coalesce(try_divide(word_chars, n_words), 0D)",
    "words": "double(n_words)",
}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > F.lit(self.cut) if self.above else value <= F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def holds(rule: Rule) -> Column:
    found = F.lit(True)
    for condition in rule:
        found = found & condition.column()
    return found


def verdict(rules: list[Rule]) -> Column:
    """The list as one expression: the first rule that holds refuses the text."""
    chain = None
    for rule in rules:
        chain = F.when(holds(rule), F.lit(False)) if chain is None else chain.when(holds(rule), F.lit(False))
    return F.lit(True) if chain is None else chain.otherwise(F.lit(True))


def base_failed() -> Column:
    n, repeated = F.col("n_words"), F.col("n_repeat_words")
    return (n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * n)


def labelled_statistics(docs: DataFrame, labels: DataFrame, target: str, id_col: str, text_col: str) -> DataFrame:
    """Statistics of a bounded sample of labelled rows, with ``_bad`` and
    ``_grow`` (whether the row belongs to the growing part).

    Held-out rows are not learnt from.  Of several labels of a document the
    least counts; null ids and labels other than 0 and 1 are ignored.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col(target).cast("int").alias("_y"))
    known = known.where(F.col("_y").isin(0, 1) & F.col("_id").isNotNull() & ~held_out(F.col("_id")))
    sample = known.groupBy("_id").agg(F.min("_y").alias("_y")).orderBy(F.xxhash64("_id"), "_id").limit(TRAIN_ROWS)
    rows = docs.withColumn("_doc", F.col(id_col).cast("long")).select("_doc", F.col(text_col).alias("_body"))
    rows = rows.join(F.broadcast(sample), F.col("_doc") == F.col("_id"))  # the sample is bounded
    keep = {"_bad": F.col("_y") == 0, "_grow": F.pmod(F.xxhash64(F.lit("part"), F.col("_id")), F.lit(3)) > 0}
    return statistics(rows, keep, "_body")


def cuts_of(rows: DataFrame) -> dict[str, list[float]]:
    """Cuts of each statistic: halfway between neighbouring quantiles of the
    good and of the bad rows, so that a cut keeps its distance from both."""
    at = [i / CUTS for i in range(CUTS + 1)]
    found = rows.groupBy("_bad").agg(*[F.percentile_approx(F.expr(value), at, 10_000).alias(name) for name, value in FEATURES.items()]).collect()
    values = {name: sorted({v for row in found for v in row[name] or []}) for name in FEATURES}
    return {name: [(a + b) / 2 for a, b in pairwise(v)] for name, v in values.items()}


def _bin(value: Column, cuts: list[float]) -> Column:
    """How many cuts lie below the value."""
    return F.size(F.filter(F.lit(cuts or [0.0]), lambda cut: value > cut))


def _histogram(binned: DataFrame, rest: Column) -> dict[str, dict[int, list[int]]]:
    """Growing rows by feature and bin: ``[bad, good]``."""
    pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("feature"), F.col(f"bin_{name}").alias("bin")) for name in FEATURES]))
    counted = binned.where(rest & F.col("_grow")).select("_bad", pairs.alias("p")).groupBy("p.feature", "p.bin")
    out: dict[str, dict[int, list[int]]] = {name: {} for name in FEATURES}
    for row in counted.agg(F.count_if("_bad").alias("bad"), F.count_if(~F.col("_bad")).alias("good")).collect():
        out[row["feature"]][row["bin"]] = [row["bad"], row["good"]]
    return out


def _best(histogram: dict[str, dict[int, list[int]]], cuts: dict[str, list[float]]) -> tuple[float, Condition | None, int]:
    """Highest gain, its condition and the good rows that it leaves covered;
    of equal ones the first in the order of features, cuts and directions."""
    best: tuple[float, Condition | None, int] = (1e-9, None, 0)
    for name, bins in histogram.items():
        bad, good = (sum(b[k] for b in bins.values()) for k in (0, 1))
        if not bad:
            continue
        before = math.log2(bad / (bad + good))
        low = [0, 0]
        for i, cut in enumerate(cuts[name]):
            low = [low[k] + bins.get(i, [0, 0])[k] for k in (0, 1)]  # rows with value <= cut
            for above, (p, n) in ((True, (bad - low[0], good - low[1])), (False, tuple(low))):
                gain = p * (math.log2(p / (p + n)) - before) if p else 0.0
                if gain > best[0]:
                    best = (gain, Condition(name, above, cut), n)
    return best


def _pruned(binned: DataFrame, rest: Column, rule: Rule) -> tuple[Rule, int, int]:
    """The shortest prefix of the rule that is worth most on the pruning part,
    with the bad and good rows that it covers there."""
    sums = []
    for k in range(1, len(rule) + 1):
        sums += [F.count_if(holds(rule[:k]) & F.col("_bad")), F.count_if(holds(rule[:k]) & ~F.col("_bad"))]
    row = binned.where(rest & ~F.col("_grow")).agg(*[s.alias(f"c{i}") for i, s in enumerate(sums)]).first()
    worth = lambda k: (row[2 * k] - row[2 * k + 1]) / max(1, row[2 * k] + row[2 * k + 1])
    best = max(range(len(rule)), key=lambda k: (worth(k), -k))
    return rule[: best + 1], row[2 * best], row[2 * best + 1]


def learn(docs: DataFrame, labels: DataFrame, target: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> list[Rule]:
    """The decision list for ``labels.<target> = 0``; without labels an empty
    one, which keeps every text."""
    known = written(labelled_statistics(docs, labels, target, id_col, text_col), "labelled")
    rows = known.where(~base_failed())  # the list judges the others only
    cuts = cuts_of(rows)
    binned = written(rows.withColumns({f"bin_{name}": _bin(F.expr(value), cuts[name]) for name, value in FEATURES.items()}), "binned")
    rules: list[Rule] = []
    rest = F.lit(True)
    while len(rules) < MAX_RULES:
        rule: Rule = ()
        while len(rule) < MAX_CONDITIONS:
            _, condition, left = _best(_histogram(binned, rest & holds(rule)), cuts)
            if condition is None:
                break
            rule += (condition,)
            if not left:
                break
        if not rule:
            break
        rule, bad, good = _pruned(binned, rest, rule)
        if bad < LEAST_COVER or bad < PRECISION * (bad + good):
            break
        rules.append(rule)
        rest = rest & ~holds(rule)
    drop_written(known)
    drop_written(binned)
    return rules


def judge(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept`` of every row.

    A text is refused outright below 50 words or with over half its words in
    repeated windows; the list decides on the others.  Null texts count as
    empty and are refused; null ids and repeated rows are judged like any row;
    extra columns are ignored; an empty table gives an empty table.
    """
    found = statistics(docs, {"doc_id": F.col(id_col).cast("long")}, text_col)
    shown = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select(*shown, base_failed().alias("base_failed"), (~base_failed() & verdict(rules)).alias("kept"))


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn a list from the labelled rows and judge every row by it."""
    return judge(docs, learn(docs, labels, "quality", id_col, text_col), id_col, text_col)

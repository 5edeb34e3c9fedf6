"""Quality by a sparse rule ensemble over statistics of the text.

Shallow trees, each on some of the rows and statistics, split the labelled
sample; every path from a root is a rule, a conjunction of bounds. Lasso
logistic regression gives most rules no weight; the others are compiled into
one Spark column over the statistics.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import reduce
from operator import and_, eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from curbflow.llm.common import beside_rows, bytes_of, fold, keyed_texts, labelled_sample, map_arrow, texts_of

# Classes of bytes whose share of a text is a statistic.
BYTE_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "space": b" \t\r",
    "line_end": b"\n",
    "stop": b".,;:?'\"()-",
    "shout": b"!",
    "bar": b"|",
    "symbol": b"#$%&*+/<=>@[\\]^_`{}~",
    "high": bytes(range(128, 256)),
}
STATISTICS = (
    *(f"{name}_share" for name in BYTE_CLASSES),
    "log_words", "word_length", "distinct_words", "repeated_next", "top_word", "distinct_lines", "line_words", "symbol_words", "capital_words",
)
PREFIX = "stat_"
# Labelled rows the model is fitted on: label 0 and label 1.
ROWS_PER_LABEL = (6000, 12000)
TREES, DEPTH, BINS = 60, 3, 32
# Of the root of the rows that a tree sees: rows that a node must have to be split, and each of its sides.
NODE, SIDE = 0.42, 0.16
THRESHOLD = 0.3


def byte_shares(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    flat, offsets = bytes_of(batch)
    sizes = np.diff(offsets)
    filled = sizes > 0
    out = {}
    for name, members in BYTE_CLASSES.items():
        inside = np.zeros(256, np.uint8)
        inside[np.frombuffer(members, np.uint8)] = 1
        share = np.zeros(len(sizes))
        if filled.any():
            share[filled] = np.add.reduceat(inside[flat], offsets[:-1][filled], dtype=np.int64) / sizes[filled]
        out[f"{name}_share"] = share
    return out


def word_statistics(text: str) -> tuple[float, ...]:
    words = text.split()
    if not words:
        return (0.0,) * 9
    n, lines = len(words), [line for line in text.split("\n") if line]
    counts = Counter(words)
    return (
        float(np.log1p(n)),
        sum(map(len, counts.keys())) / len(counts),
        len(counts) / n,
        sum(map(eq, words, words[1:])) / n,
        max(counts.values()) / n,
        len(set(lines)) / len(lines),
        n / len(lines),
        sum(not word[-1].isalnum() and word[-1] not in ".,;:?!'\")" for word in counts) / len(counts),
        sum(word[0].isupper() for word in counts) / len(counts),
    )


def statistics(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    """The statistics of the texts of a batch; an empty or null text has 0 everywhere."""
    rows = np.array([word_statistics(text) for text in texts_of(batch)]).reshape(batch.num_rows, 9)
    found = byte_shares(batch) | dict(zip(STATISTICS[-9:], rows.T))
    return {f"{PREFIX}{name}": found[name] for name in STATISTICS}


SCHEMA = ", ".join(f"{PREFIX}{name} double" for name in STATISTICS)


def with_statistics(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` and its statistics; ``docs`` has a string column text."""
    return map_arrow(docs, lambda: statistics, SCHEMA, keep=True)


@dataclass(frozen=True)
class Rule:
    """Bounds on statistics, (statistic, lower, upper): lower < value <= upper. All must hold."""

    bounds: tuple[tuple[int, float, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        return reduce(and_, ((x[:, k] > low) & (x[:, k] <= high) for k, low, high in self.bounds))

    def column(self) -> Column:
        sides = []
        for k, low, high in self.bounds:
            value = F.col(f"{PREFIX}{STATISTICS[k]}")
            sides += [value > F.lit(low)] * (low > -np.inf) + [value <= F.lit(high)] * (high < np.inf)
        return reduce(and_, sides)


def tree_rules(x: np.ndarray, y: np.ndarray, edges: list[np.ndarray], binned: np.ndarray, random: np.random.Generator) -> set[Rule]:
    """The paths of one tree on half of the rows, each split over some of the statistics."""
    found: set[Rule] = set()
    seen = max(1, len(y) // 2)
    node, side = max(4, round(NODE * seen**0.5)), max(2, round(SIDE * seen**0.5))

    def split(rows: np.ndarray, bounds: dict[int, tuple[float, float]], depth: int) -> None:
        if bounds:
            found.add(Rule(tuple(sorted((k, low, high) for k, (low, high) in bounds.items()))))
        if depth == DEPTH or len(rows) < node or y[rows].min() == y[rows].max():
            return
        best = (1e-4, -1, 0)
        for k in random.choice(x.shape[1], max(1, x.shape[1] // 2), replace=False):
            if not len(edges[k]):
                continue
            n = np.bincount(binned[rows, k], minlength=len(edges[k]) + 1).cumsum()[:-1]
            ones = np.bincount(binned[rows, k], y[rows], len(edges[k]) + 1).cumsum()[:-1]
            total, positive = len(rows), y[rows].sum()
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = ones**2 / n + (positive - ones) ** 2 / (total - n) - positive**2 / total
            gain[(n < side) | (total - n < side)] = 0
            at = int(np.nanargmax(gain))
            if gain[at] / total > best[0]:
                best = (gain[at] / total, int(k), at)
        _, k, at = best
        if k < 0:
            return
        low, high = bounds.get(k, (-np.inf, np.inf))
        edge, below = float(edges[k][at]), binned[rows, k] <= at
        split(rows[below], bounds | {k: (low, edge)}, depth + 1)
        split(rows[~below], bounds | {k: (edge, high)}, depth + 1)

    split(random.choice(len(y), seen, replace=False), {}, 0)
    return found


def lasso_logistic(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias by accelerated proximal gradient steps; the bias has no penalty."""
    n = len(y)
    step = 4 / (np.linalg.norm(x, 2) ** 2 / n + 1)
    bias = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    now = past = np.r_[np.zeros(x.shape[1]), bias]
    for k in range(1, rounds + 1):
        ahead = now + (k - 1) / (k + 2) * (now - past)
        error = 1 / (1 + np.exp(-np.clip(x @ ahead[:-1] + ahead[-1], -40, 40))) - y
        moved = ahead - step * np.r_[x.T @ error / n, error.mean()]
        moved[:-1] = np.sign(moved[:-1]) * np.maximum(np.abs(moved[:-1]) - step * penalty, 0)
        past, now = now, moved
    return now[:-1], float(now[-1])


@dataclass
class RuleEnsemble:
    rules: list[tuple[Rule, float]]
    bias: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        odds = self.bias + sum((weight * rule.holds(x) for rule, weight in self.rules), np.zeros(len(x)))
        return 1 / (1 + np.exp(-odds))

    def column(self) -> Column:
        """The score as a Spark column over the statistics."""
        odds = F.lit(self.bias)
        for rule, weight in self.rules:
            odds = odds + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-odds))


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, seed: int = 3) -> RuleEnsemble:
    """Rules by trees, weights by lasso. With rows of one label only, with none or too few the score is constant."""
    if not len(y) or y.min() == y.max():
        return RuleEnsemble([], 0.0 if not len(y) else 20.0 * (2 * int(y[0]) - 1))
    random = np.random.default_rng(seed)
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
    edges = [e[e < x[:, k].max()] for k, e in enumerate(edges)]
    binned = np.stack([np.searchsorted(e, x[:, k], "left") for k, e in enumerate(edges)], axis=1)
    found: set[Rule] = set()
    for _ in range(TREES):
        found |= tree_rules(x, y.astype(float), edges, binned, random)
    if not found:  # too few rows for any split
        return RuleEnsemble([], float(np.log(y.mean() / (1 - y.mean()))))
    rules = sorted(found, key=lambda rule: rule.bounds)
    hold = np.stack([rule.holds(x) for rule in rules], axis=1)
    # Of rules that hold for the same rows the first stays.
    _, first = np.unique(np.packbits(hold, axis=0).T, axis=0, return_index=True)
    rules, hold = [rules[i] for i in sorted(first)], hold[:, sorted(first)].astype(np.float32)
    weights, bias = lasso_logistic(hold, y.astype(np.float32), penalty)
    return RuleEnsemble([(rule, float(w)) for rule, w in zip(rules, weights) if w], bias)


def train(docs: DataFrame, labels: DataFrame, learn, per_label: tuple[int, int] = ROWS_PER_LABEL) -> RuleEnsemble:
    """Fit on a bounded sample of labelled documents; their statistics are made in Spark."""
    sample = with_statistics(labelled_sample(docs, labels, "quality", per_label, learn).select("doc_id", "text", "label"))
    rows = sample.drop("text").toArrow().sort_by("doc_id")
    x = np.stack([rows.column(f"{PREFIX}{name}").to_numpy() for name in STATISTICS], axis=1)
    return fit(x, rows.column("label").to_numpy().astype(int))


def quality(docs: DataFrame, model: RuleEnsemble, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, score, predicted), one per row of ``docs``.

    Null and empty texts have statistics of 0 and are scored like any other. Repeated rows give repeated rows,
    a null key stays null, an empty table gives no rows. Other columns are ignored, whatever their names.
    """
    scored = map_arrow(keyed_texts(docs, key, text), lambda: lambda batch: {"doc_id": batch.column("doc_id")} | statistics(batch), f"doc_id long, {SCHEMA}")
    return scored.select("doc_id", model.column().alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def good_rows(docs: DataFrame, model: RuleEnsemble) -> DataFrame:
    """The rows of ``docs`` that the model predicts 1 for, with all their columns."""
    return beside_rows(docs, lambda: statistics, SCHEMA).where(model.column() >= THRESHOLD).select("row.*")


def held_out(key: Column) -> Column:
    return fold(key, 5) == 0


def quality_of_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from labels that aren't held out, score all: doc_id, held_out, score, predicted."""
    model = train(docs, labels, lambda key: ~held_out(key))
    return quality(docs, model).withColumn("held_out", held_out(F.col("doc_id")))

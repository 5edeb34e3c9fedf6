"""Toxicity by bags of subword embeddings, averaged into a linear softmax.

A word is the mean of the embeddings of its character n-grams and of itself, a
text the mean of its words; a linear softmax on that mean tells toxic from
clean. Embeddings and softmax are trained together in numpy. Unseen spellings
share n-grams with known words. As all steps up to the softmax are linear, a
trained model comes down to one number per n-gram bucket.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from curbflow.llm.common import fold, keyed_texts, labelled_sample, map_arrow, texts_of

BUCKETS = 1 << 17
SIZES = (3, 4, 5)
WIDTH = 8
# Empty words that each text is padded with.
PADDING = 20
# Labelled rows the model is fitted on: clean and toxic.
ROWS_PER_LABEL = (3500, 1500)
THRESHOLD = 0.5
REMEMBERED = 300_000


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ (h >> np.uint64(32))) % np.uint64(BUCKETS)


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of each word and of the word itself, and which word they belong to."""
    marked = [f"<{word}>" for word in words]
    letters = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.array([len(word) for word in marked])
    owner = np.repeat(np.arange(len(words)), lengths)
    step = np.uint64(0x9E3779B97F4A7C15)
    ids, owners = [], []
    for size in SIZES:
        if len(letters) >= size:
            h = np.full(len(letters) - size + 1, size, np.uint64)
            for k in range(size):
                h = h * step + letters[k : len(letters) - size + 1 + k]
            whole = owner[: len(h)] == owner[size - 1 :]
            ids.append(mixed(h[whole]))
            owners.append(owner[: len(h)][whole])
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - np.repeat(starts, lengths)
    powers = np.cumprod(np.r_[np.uint64(1), np.full(max(lengths, default=1), step, np.uint64)])
    ids.append(mixed(np.add.reduceat(letters * powers[place], starts) if len(words) else np.zeros(0, np.uint64)))
    owners.append(np.arange(len(words)))
    return np.concatenate(ids).astype(np.int64), np.concatenate(owners)


def word_cutter():
    return re.compile(r"\w+").findall


def bag(text: str, cut) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their weights in its mean. A word counts once however often it stands there,
    and ``PADDING`` empty words are added, so that neither one repeated word nor a very short text is judged by a single word."""
    words = sorted(set(cut(text.lower())))
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    ids, owner = subwords(words)
    share = 1 / (len(words) + PADDING) / np.bincount(owner)
    ids, back = np.unique(ids, return_inverse=True)
    return ids, np.bincount(back, share[owner])


def fit(bags: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, width: int = WIDTH, rounds: int = 8, batch: int = 256, rate: float = 0.05, decay: float = 0.001, seed: int = 5):
    """Train embeddings and softmax together by Adam; returns the weight of each bucket and the bias of the log odds."""
    random = np.random.default_rng(seed)
    if not len(bags) or len(set(toxic.tolist())) < 2:
        return np.zeros(BUCKETS, np.float32), float(-20 if not len(bags) or not toxic[0] else 20)
    used, flat = np.unique(np.concatenate([ids for ids, _ in bags]), return_inverse=True)
    flat = flat.astype(np.int32)
    sizes = np.array([len(ids) for ids, _ in bags])
    starts = np.r_[0, np.cumsum(sizes)]
    weights = np.concatenate([w for _, w in bags])
    embed = random.normal(0, 0.05, (len(used), width))
    softmax, bias = random.normal(0, 1, (width, 2)), np.zeros(2)
    balance = len(toxic) / 2 / np.bincount(toxic, minlength=2)
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (embed, softmax, bias)]
    step = 0
    for _ in range(rounds):
        order = random.permutation(len(bags))
        for rows in (order[at : at + batch] for at in range(0, len(order), batch)):
            rows = rows[sizes[rows] > 0]
            if not len(rows):
                continue
            step += 1
            at = np.concatenate([np.arange(starts[r], starts[r + 1]) for r in rows])
            owner = np.repeat(np.arange(len(rows)), sizes[rows])
            ids, w = flat[at], weights[at].astype(float)
            means = np.add.reduceat(embed[ids] * w[:, None], np.r_[0, np.cumsum(sizes[rows])[:-1]])
            logits = means @ softmax + bias
            share = np.exp(logits - logits.max(axis=1, keepdims=True))
            share /= share.sum(axis=1, keepdims=True)
            share[np.arange(len(rows)), toxic[rows]] -= 1
            share *= (balance[toxic[rows]] / len(rows))[:, None]
            down = share @ softmax.T
            slopes = [
                np.stack([np.bincount(ids, w * down[owner, k], len(used)) for k in range(width)], axis=1),
                means.T @ share,
                share.sum(axis=0),
            ]
            for value, slope, (m, v) in zip((embed, softmax, bias), slopes, state):
                m += 0.1 * (slope - m)
                v += 0.01 * (slope**2 - v)
                value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            embed *= 1 - decay
    odds = np.zeros(BUCKETS, np.float32)
    odds[used] = embed @ (softmax[:, 1] - softmax[:, 0])
    return odds, float(bias[1] - bias[0])


def scorer(odds: np.ndarray, bias: float, remembered: int = REMEMBERED):
    """A function from texts to toxicity scores."""
    cut = word_cutter()
    known: dict[str, float] = {}

    def score(texts: list[str]) -> np.ndarray:
        bags = [set(cut(text.lower())) for text in texts]
        if len(known) > remembered:
            known.clear()
        new = list({word for words in bags for word in words if word not in known})
        for at in range(0, len(new), 50_000):
            part = new[at : at + 50_000]
            ids, owner = subwords(part)
            known.update(zip(part, (np.bincount(owner, odds[ids]) / np.bincount(owner)).tolist()))
        means = [sum(map(known.__getitem__, words)) / (len(words) + PADDING) for words in bags]
        return 1 / (1 + np.exp(-np.clip(np.array(means) + bias, -40, 40)))

    return score


def train(docs: DataFrame, labels: DataFrame, learn, per_label: tuple[int, int] = ROWS_PER_LABEL):
    """Fit on a bounded sample of labelled documents; their bags are made in Spark."""

    def build():
        cut = word_cutter()

        def work(batch: pa.RecordBatch) -> dict:
            ids, weights = zip(*(bag(text, cut) for text in texts_of(batch)))
            return {
                "doc_id": batch.column("doc_id"), "label": batch.column("label"),
                "ids": [i.astype("<i4").tobytes() for i in ids], "weights": [w.astype("<f4").tobytes() for w in weights],
            }

        return work

    sample = labelled_sample(docs, labels, "toxic", per_label, learn).select("doc_id", "text", "label")
    rows = map_arrow(sample, build, "doc_id long, label int, ids binary, weights binary").toArrow().sort_by("doc_id").to_pylist()
    bags = [(np.frombuffer(r["ids"], "<i4"), np.frombuffer(r["weights"], "<f4")) for r in rows]
    return fit(bags, np.array([r["label"] for r in rows], int))


def toxicity(docs: DataFrame, odds: np.ndarray, bias: float, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, score, predicted), one per row of ``docs``.

    Null, empty and wordless texts score by the bias alone. Repeated rows give repeated rows, a null key stays
    null, an empty table gives no rows. Other columns are ignored, whatever their names.
    """

    def build():
        score = scorer(odds, bias)

        def work(batch: pa.RecordBatch) -> dict:
            return {"doc_id": batch.column("doc_id"), "score": score(texts_of(batch))}

        return work

    scored = map_arrow(keyed_texts(docs, key, text), build, "doc_id long, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def held_out(key: Column) -> Column:
    return fold(key, 5) == 0


def toxicity_of_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from labels that aren't held out, score all: doc_id, held_out, score, predicted."""
    odds, bias = train(docs, labels, lambda key: ~held_out(key))
    return toxicity(docs, odds, bias).withColumn("held_out", held_out(F.col("doc_id")))

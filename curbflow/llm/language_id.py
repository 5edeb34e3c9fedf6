"""Language identification by words first, with character n-grams for unseen words.

A known word scores by its log frequency in each language. An unseen word is
covered from left to right by the longest known character n-grams, from
``LONGEST`` characters down to one, and scores by their log frequencies.

Texts are cut at blanks. Each distinct part of a batch is scored once, from
matrices of the words' and n-grams' log frequencies; a text's score adds those
of its parts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from curbflow.llm.common import beside_rows, blank_parts, keyed_texts, map_arrow, sent_if_small, texts_of
from curbflow.session import cut_lineage

LETTER_RUN = r"\p{L}+"
LONGEST = 5
# Labelled rows the model is fitted on, about this many of each language.
ROWS_PER_LANGUAGE = 3000
# Times that a word, and an n-gram, must stand in those rows to be known.
WORD_TIMES, GRAM_TIMES = 2, 3
# Words' worth of evidence in a score: longer texts are judged by their mean.
EVIDENCE = 25
# The most that one word can count against a language.
WORST = -12.0
UNKNOWN = "und"
# Bytes of parts, and of words, whose scores a task remembers.
REMEMBERED = 16 << 20


class ScoreRows:
    """Rows of numbers by text, in one matrix; once they take ``most`` bytes they start anew."""

    def __init__(self, width: int, most: int):
        self.width, self.most = width, most
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.table, self.held = np.zeros((1024, self.width), np.float32), 0

    def missing(self, texts: list[str]) -> list[str]:
        return [text for text in texts if text not in self.at]

    def add(self, texts: list[str], rows: np.ndarray) -> None:
        first, end = len(self.at), len(self.at) + len(texts)
        if end > len(self.table):
            self.table = np.r_[self.table, np.zeros((end, self.width), np.float32)]
        self.table[first:end] = rows
        self.at.update(zip(texts, range(first, end)))
        # A text, its place in the dictionary and its row.
        self.held += sum(map(len, texts)) + len(texts) * (160 + 4 * self.width)

    def places(self, texts: list[str]) -> np.ndarray:
        return np.fromiter(map(self.at.__getitem__, texts), np.int64, len(texts))


def added(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of ``sizes`` rows at a time; zeros where the size is 0."""
    out = np.zeros((len(sizes), rows.shape[1]), np.float64)
    there = sizes > 0
    if there.any():
        starts = (np.cumsum(sizes) - sizes)[there]
        for j in range(rows.shape[1]):
            out[there, j] = np.add.reduceat(rows[:, j], starts, dtype=np.float64)
    return out


@dataclass
class LanguageModel:
    """Log frequencies by language (columns) of words and of n-grams (marked by < and > at word ends)."""

    languages: list[str]
    words: list[str]
    word_logs: np.ndarray
    grams: list[str]
    gram_logs: np.ndarray

    @classmethod
    def of_counts(cls, languages: list[str], words: dict[str, list[int]], grams: dict[str, list[int]]) -> LanguageModel:
        counts = lambda found: np.array(list(found.values()), float).reshape(len(found), len(languages))
        return cls.of_matrices(languages, list(words), counts(words), list(grams), counts(grams))

    @classmethod
    def of_matrices(cls, languages: list[str], words: list[str], word_counts: np.ndarray, grams: list[str], gram_counts: np.ndarray) -> LanguageModel:
        """Frequencies of words are those among words, of n-grams those among the n-grams of their length."""

        def logs(counts: np.ndarray, groups: np.ndarray) -> np.ndarray:
            out = np.zeros(counts.shape, np.float32)
            for g in np.unique(groups):
                own = counts[groups == g]
                out[groups == g] = np.log((own + 0.5) / (own.sum(axis=0) + 0.5 * len(own)))
            return out

        return cls(languages, words, logs(word_counts, np.zeros(len(words))), grams, logs(gram_counts, np.array([len(g) for g in grams])))

    def unseen(self) -> Callable[[str], list[int]]:
        """A function from a word to the longest known n-grams that cover it, from left to right."""
        of_gram = {gram: n for n, gram in enumerate(self.grams)}

        def cover(word: str) -> list[int]:
            marked = f"<{word}>"
            found, at, end = [], 0, len(word) + 2
            while at < end:
                for size in range(min(LONGEST, end - at), 0, -1):
                    if (n := of_gram.get(marked[at : at + size])) is not None:
                        found.append(n)
                        break
                at += size
            return found

        return cover

    def batch_predictor(self, remembered: int = REMEMBERED):
        """A function from a batch to its texts' languages and scores from 0 to 1."""
        cut, cover = letter_runs(), self.unseen()
        of_seen = {word: n for n, word in enumerate(self.words)}
        width = len(self.languages)
        # Words with their scores; parts with theirs and the number of their words.
        words, parts = ScoreRows(width, remembered), ScoreRows(width + 1, remembered)

        def add_words(new: list[str]) -> None:
            logs = np.zeros((len(new), width))
            seen = np.array([of_seen.get(word, -1) for word in new], np.int64).reshape(-1)
            logs[seen >= 0] = self.word_logs[seen[seen >= 0]]
            others = np.flatnonzero(seen < 0)
            covers = [cover(new[i]) for i in others.tolist()]
            grams = np.array([n for found in covers for n in found], np.int64)
            logs[others] = added(self.gram_logs[grams], np.array([len(found) for found in covers], np.int64))
            # Only differences between languages count; one odd word can't outweigh the rest.
            words.add(new, np.maximum(logs - logs.max(axis=1, keepdims=True), WORST))

        def add_parts(new: list[str]) -> None:
            runs = [cut(part.lower()) for part in new]
            add_words(words.missing(list(set().union(*runs))))
            sizes = np.array([len(found) for found in runs], np.int64)
            scores = added(words.table[words.places([word for found in runs for word in found])], sizes)
            parts.add(new, np.c_[scores, sizes])

        def predict(batch: pa.RecordBatch) -> tuple[list[str], np.ndarray]:
            if not width:
                return [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            for rows in (words, parts):
                if rows.held > rows.most:
                    rows.clear()
            distinct, places, offsets = blank_parts(batch)
            add_parts(parts.missing(distinct))
            found = parts.places(distinct)[places]
            totals = np.stack([np.add.reduceat(parts.table[found, j], offsets[:-1], dtype=np.float64) for j in range(width + 1)], axis=1)
            n, total = totals[:, -1], totals[:, :-1]
            total = total * np.minimum(1.0, EVIDENCE / np.maximum(n, 1))[:, None]
            share = np.exp(total - total.max(axis=1, keepdims=True))
            best = share.argmax(axis=1)
            score = np.where(n > 0, 1 / share.sum(axis=1), 0.0)
            return [self.languages[b] if known else UNKNOWN for b, known in zip(best.tolist(), (n > 0).tolist())], score

        return predict

    def predictor(self):
        """A function from a text to (language, score from 0 to 1)."""
        predict = self.batch_predictor()

        def one(text: str) -> tuple[str, float]:
            languages, scores = predict(pa.RecordBatch.from_pydict({"text": pa.array([text], pa.string())}))
            return languages[0], float(scores[0])

        return one


def letter_runs():
    """Runs of letters of a lower-case text."""
    import regex

    any_text, latin_text = regex.compile(LETTER_RUN).findall, re.compile(r"[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+").findall

    def cut(text: str) -> list[str]:
        if text.isascii():
            return latin_text(text)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return any_text(text)
        return latin_text(text)

    return cut


def bounded_sample(rows: DataFrame, label: str, per_label: int) -> DataFrame:
    """About ``per_label`` rows of each label, chosen by a hash of the text, so that copies don't decide."""
    total = rows.groupBy(label).count()
    share = F.least(F.lit(1.0), F.lit(float(per_label)) / F.col("count"))
    place = F.pmod(F.xxhash64(F.col("text"), F.lit(7)), F.lit(1_000_000)) / 1_000_000.0
    return rows.join(sent_if_small(cut_lineage(total)), label).where(place < share).drop("count")


def train(rows: DataFrame, per_language: int = ROWS_PER_LANGUAGE, word_times: int = WORD_TIMES, gram_times: int = GRAM_TIMES) -> LanguageModel:
    """Fit on rows (lang, text); rows without a language don't count.

    The counts of the bounded sample are added up in Spark. Known are all words that stand in it ``word_times`` and all
    n-grams that stand in it ``gram_times``; the sample bounds their number.
    """

    def build():
        cut = letter_runs()

        def work(batch: pa.RecordBatch) -> dict:
            words: dict[tuple[str, str], int] = Counter()
            for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch)):
                words.update((lang, word) for word in cut(text.lower()))
            grams: dict[tuple[str, str], int] = Counter()
            for (lang, word), n in words.items():
                marked = f"<{word}>"
                for size in range(1, LONGEST + 1):
                    for at in range(len(marked) - size + 1):
                        grams[lang, marked[at : at + size]] += n
            both = [*words.items(), *grams.items()]
            return {
                "kind": ["w"] * len(words) + ["g"] * len(grams), "lang": [lang for (lang, _), _ in both],
                "item": [item for (_, item), _ in both], "n": [n for _, n in both],
            }

        return work

    sample = bounded_sample(rows.select("lang", "text").where(F.col("lang").isNotNull() & F.col("text").isNotNull()), "lang", per_language)
    counted = map_arrow(sample.select("lang", "text"), build, "kind string, lang string, item string, n long")
    by_item = (
        counted.groupBy("kind", "item", "lang").agg(F.sum("n").alias("n"))
        .groupBy("kind", "item").agg(F.sum("n").alias("total"), F.collect_list(F.struct("lang", "n")).alias("counts"))
        .where(F.col("total") >= F.when(F.col("kind") == "w", word_times).otherwise(gram_times))
    )
    found = by_item.select("kind", "item", "counts").toArrow().combine_chunks().sort_by([("kind", "ascending"), ("item", "ascending")])
    by_lang = found["counts"].combine_chunks()
    coded = by_lang.flatten().field("lang").dictionary_encode()
    languages = sorted(coded.dictionary.to_pylist())
    column = np.array([languages.index(lang) for lang in coded.dictionary.to_pylist()], np.int64)
    counts = np.zeros((found.num_rows, len(languages)))
    sizes = np.diff(by_lang.offsets.to_numpy())
    if found.num_rows:
        counts[np.repeat(np.arange(found.num_rows), sizes), column[coded.indices.to_numpy()]] = by_lang.flatten().field("n").to_numpy()
    is_word = np.array(found["kind"].to_pylist(), object) == "w"
    items = np.array(found["item"].to_pylist(), object)
    return LanguageModel.of_matrices(languages, items[is_word].tolist(), counts[is_word], items[~is_word].tolist(), counts[~is_word])


def identify(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, lang_pred, score), one per row of ``docs``.

    Null, empty and letterless texts are ``und`` with score 0. Repeated rows give repeated rows, a null key
    stays null, an empty table gives no rows. Other columns are ignored, whatever their names.
    """
    def build():
        predict = model.batch_predictor()

        def work(batch: pa.RecordBatch) -> dict:
            langs, scores = predict(batch)
            return {"doc_id": batch.column("doc_id"), "lang_pred": langs, "score": scores}

        return work

    return map_arrow(keyed_texts(docs, key, text), build, "doc_id long, lang_pred string, score double")


def known_rows(docs: DataFrame, model: LanguageModel, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language is told with a score of ``least`` or more, with all their columns."""

    def build():
        predict = model.batch_predictor()

        def work(batch: pa.RecordBatch) -> dict:
            langs, scores = predict(batch)
            return {"lang_pred": langs, "score": scores}

        return work

    told = beside_rows(docs, build, "lang_pred string, score double")
    return told.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("row.*")


def held_out(key: Column) -> Column:
    """Rows the model of the registered query doesn't learn from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def language_of_documents(docs: DataFrame) -> DataFrame:
    """Learn from the rows of ``docs`` that aren't held out, predict all: doc_id, held_out, lang_pred, score."""
    model = train(docs.where(~held_out(F.col("doc_id"))).select("lang", "text"))
    return identify(docs, model).withColumn("held_out", held_out(F.col("doc_id")))

"""Token counts by rank-synchronous merging of ragged symbol arrays.

Pre-tokens of many texts lie end to end in one numpy array of symbols. In each
round every pre-token finds its pair of lowest rank and joins all places where
that pair stands, at once for all pre-tokens; those without a known pair drop
out. What is left of a pre-token is its number of tokens.
"""

from __future__ import annotations

import json
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from curbflow.llm.common import keyed_texts, map_arrow, texts_of

# How this kind of vocabulary cuts text into pre-tokens.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same for texts within Latin-1, which Python's own and faster matcher can cut.
LETTERS, NUMBERS, SPACES = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"
PRE_TOKEN_LATIN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
NONE = np.iinfo(np.int32).max
# Pre-tokens whose count a task remembers before it starts anew.
REMEMBERED = 400_000


def byte_symbols() -> list[str]:
    """The visible character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(spare)) for b in range(256)]


class PairTable:
    """Ranks of the pairs of a byte-level vocabulary file, as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.of_byte = np.array([vocab[c] for c in byte_symbols()], np.int64)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.width = 1 + max(vocab.values())
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left * self.width + right
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == wanted, self.ranks[at], NONE)


def surviving_symbols(words: list[bytes], pairs: PairTable) -> np.ndarray:
    """Number of symbols left of each word after all merges."""
    lengths = np.array([len(w) for w in words], np.int64)
    left_over = lengths.copy()
    symbols = pairs.of_byte[np.frombuffer(b"".join(words), np.uint8)]
    owner = np.repeat(np.arange(len(words)), lengths)
    while len(symbols) > 1:
        ranks = np.full(len(symbols), NONE, np.int32)
        ranks[:-1] = np.where(owner[:-1] == owner[1:], pairs.rank(symbols[:-1], symbols[1:]), NONE)
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        sizes = np.diff(np.r_[first, len(symbols)])
        lowest = np.minimum.reduceat(ranks, first)
        left_over[owner[first]] = sizes
        # Words without a known pair are done; the others go on alone.
        going = np.repeat(lowest != NONE, sizes)
        if not going.any():
            break
        best = np.repeat(lowest, sizes)[going]
        symbols, owner, ranks = symbols[going], owner[going], ranks[going]
        hit = ranks == best
        # Of overlapping places (a pair of equal symbols in a row) every second one counts, from the left.
        place = np.arange(len(hit))
        run_start = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], place, 0))
        hit &= (place - run_start) % 2 == 0
        symbols[hit] = pairs.made[best[hit]]
        keep = ~np.r_[False, hit[:-1]]
        symbols, owner = symbols[keep], owner[keep]
    if len(symbols) == 1:
        left_over[owner[0]] = 1
    return left_over


def pre_token_cutter():
    any_text, latin_text = regex.compile(PRE_TOKEN).findall, re.compile(PRE_TOKEN_LATIN).findall

    def cut(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return any_text(text)
        return latin_text(text)

    return cut


def counter(path: str, remembered: int = REMEMBERED):
    """A function from texts to token counts, with the default handling of special strings."""
    pairs = PairTable(path)
    cut = pre_token_cutter()
    special = regex.compile("|".join(map(regex.escape, sorted(pairs.special, key=len, reverse=True)))) if pairs.special else None
    known: dict[str, int] = {}

    def count(texts: list[str]) -> list[int]:
        cuts, extra = [], []
        for text in texts:
            parts = special.split(text) if special is not None and "<" in text else [text]
            extra.append(len(parts) - 1)
            cuts.append(cut(text) if len(parts) == 1 else [t for part in parts for t in cut(part)])
        if len(known) > remembered:
            known.clear()
        new = list({t for tokens in cuts for t in tokens if t not in known})
        if new:
            known.update(zip(new, surviving_symbols([t.encode("utf-8") for t in new], pairs).tolist()))
        return [more + sum(map(known.__getitem__, tokens)) for more, tokens in zip(extra, cuts)]

    return count


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Null and empty texts have no tokens; repeated rows give repeated rows; a null key stays null;
    an empty table gives no rows. Other columns of ``docs`` are ignored, whatever their names.
    """

    def build():
        count = counter(vocabulary)

        def work(batch: pa.RecordBatch) -> dict:
            texts = texts_of(batch)
            n = count(texts)
            return {"doc_id": batch.column("doc_id"), "n_bytes": [len(t.encode("utf-8")) for t in texts], "n_tokens": n}

        return work

    counted = map_arrow(keyed_texts(docs, key, text), build, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def byte_level_vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")

"""Best-fit packing of documents into fixed-length sequences by exact complements.

Which pieces go together depends on their lengths alone, so the plan is made on
the histogram of lengths, which has one entry per length whatever the number of
documents. A sequence starts with the longest length left; its gap is filled by
one, two or three lengths whose sum is the gap exactly, looked up under the
counts that are left. Where none is, the longest length that fits goes in (best
fit) and the smaller gap is looked up again. A combination is used as often as
the counts allow. Pieces find their place from their running number among the
pieces of their length.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import Counter
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from curbflow.llm.common import keyed_texts, map_arrow, texts_of
from curbflow.llm.token_counts import LETTERS, NONE, NUMBERS, SPACES, PairTable, byte_symbols
from curbflow.session import cut_lineage

CAPACITY = 2048
# Pieces of one length that are numbered together, about.
PER_BUCKET = 20_000
# Bytes of words and their ids that a task remembers.
REMEMBERED = 64 << 20
# How the vocabulary cuts lower-cased text within Latin-1; other texts go to the library whole.
WORD = rf"[{LETTERS}]+|[{NUMBERS}]|'(?:[stmd]|re|ve|ll)|[^{SPACES}{LETTERS}{NUMBERS}]+"


class WordTable(PairTable):
    """Pairs of a vocabulary whose symbols at the end of a word are marked."""

    def __init__(self, path: str):
        super().__init__(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.of_last_byte = np.array([model["vocab"][c + model["end_of_word_suffix"]] for c in byte_symbols()], np.int64)


def merged(words: list[bytes], pairs: WordTable) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words end to end, and how many each has. Each round joins every word's pair of lowest rank."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"".join(words), np.uint8)
    symbols = pairs.of_byte[data]
    last = np.cumsum(lengths)[lengths > 0] - 1
    symbols[last] = pairs.of_last_byte[data[last]]
    owner = np.repeat(np.arange(len(words)), lengths)
    done: list[tuple[np.ndarray, np.ndarray]] = []

    def rank_at(places: np.ndarray) -> np.ndarray:
        """Ranks of the symbols at some places with the next one of their word."""
        after = np.minimum(places + 1, len(symbols) - 1)
        found = np.full(len(places), NONE, np.int32)
        inside = np.flatnonzero((owner[places] == owner[after]) & (after > places))
        found[inside] = pairs.rank(symbols[places[inside]], symbols[after[inside]])
        return found

    ranks = rank_at(np.arange(len(symbols)))
    while len(symbols):
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        sizes = np.diff(np.r_[first, len(symbols)])
        best = np.repeat(np.minimum.reduceat(ranks, first), sizes)
        going = best != NONE
        if not going.all():
            done.append((owner[~going], symbols[~going]))
            symbols, owner, ranks, best = symbols[going], owner[going], ranks[going], best[going]
            if not len(symbols):
                break
        hit = ranks == best
        # Of overlapping places (a pair of equal symbols in a row) every second one counts, from the left.
        place = np.arange(len(hit))
        hit &= (place - np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], place, 0))) % 2 == 0
        symbols[hit] = pairs.made[best[hit]]
        keep = ~np.r_[False, hit[:-1]]
        symbols, owner, ranks, hit = symbols[keep], owner[keep], ranks[keep], hit[keep]
        # Only ranks with a new symbol on either side are others now.
        changed = np.flatnonzero(hit | np.r_[hit[1:], False])
        ranks[changed] = rank_at(changed)
    owners, ids = (np.concatenate([d[k] for d in done] or [np.zeros(0, np.int64)]) for k in (0, 1))
    return ids[np.argsort(owners, kind="stable")].astype("<u4"), np.bincount(owners, minlength=len(words))


def places_of(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each run, end to end."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


class Ragged:
    """Runs of numbers by text, in one array; once they take ``most`` bytes they start anew."""

    def __init__(self, most: int):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.flat, self.starts, self.sizes = (np.zeros(0, t) for t in ("<u4", np.int64, np.int64))
        self.held = 0

    def add(self, texts: list[str], flat: np.ndarray, sizes: np.ndarray) -> None:
        self.at.update(zip(texts, range(len(self.at), len(self.at) + len(texts))))
        self.starts = np.r_[self.starts, len(self.flat) + np.cumsum(sizes) - sizes]
        self.sizes = np.r_[self.sizes, sizes]
        self.flat = np.r_[self.flat, flat]
        self.held += sum(map(len, texts)) + 160 * len(texts) + 4 * len(flat)

    def runs(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs of the given rows end to end, and their sizes."""
        sizes = self.sizes[rows]
        return self.flat[places_of(self.starts[rows], sizes)], sizes


def word_ids(path: str, remembered: int = REMEMBERED):
    """A function from texts to the ids of all of them end to end and where each text's start.

    Each distinct word is encoded once and remembered."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer, pairs = Tokenizer.from_file(path), WordTable(path)
    cut = re.compile(WORD).findall
    words = Ragged(remembered)

    def plain(text: str) -> bool:
        """Whether a text is within Latin-1 and holds nothing that may be a special token; others go to the library whole."""
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return False
        return "<|" not in text

    def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        whole = [i for i, text in enumerate(texts) if not plain(text)]
        cuts = [cut(text.lower()) for text in texts]
        for i in whole:
            cuts[i] = []
        if words.held > words.most:
            words.clear()
        unseen = list(set().union(*cuts).difference(words.at))
        words.add(unseen, *merged([word.encode() for word in unseen], pairs))
        count = np.fromiter(map(len, cuts), np.int64, len(cuts))
        ids, sizes = words.runs(np.fromiter(map(words.at.__getitem__, chain.from_iterable(cuts)), np.int64, int(count.sum())))
        before = np.r_[0, np.cumsum(sizes)][np.r_[0, np.cumsum(count)]]
        if whole:
            pieces = np.split(ids, before[1:-1])
            for i, found in zip(whole, tokenizer.encode_batch([texts[i] for i in whole], add_special_tokens=False)):
                pieces[i] = np.array(found.ids, "<u4")
            ids, before = np.concatenate(pieces), np.r_[0, np.cumsum([len(p) for p in pieces])]
        return ids, before

    return encode


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32): each text's ids and ``end_id``, cut where longer than ``capacity``."""
    end = np.array([end_id], "<u4").tobytes()
    width = 4 * capacity

    def build():
        encode = word_ids(vocabulary)

        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
            flat, offsets = encode(texts_of(batch))
            flat, offsets = flat.tobytes(), (4 * offsets).tolist()
            for doc_id, first, last in zip(batch.column("doc_id").to_pylist(), offsets, offsets[1:]):
                ids = flat[first:last] + end
                for piece, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    for name, value in zip(out, (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part))):
                        out[name].append(value)
            return out

        return work

    return map_arrow(keyed_texts(docs, key, text), build, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Complements:
    """Lengths that are left, with their counts, looked up by sums of one, two or three."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts.astype(np.int64)
        self.pair_sums = 0
        self.pair_sums_of = -1

    def longest(self, most: int) -> int:
        """The longest length left that is no longer than ``most``; 0 if none."""
        there = np.flatnonzero(self.counts[1 : most + 1])
        return int(there[-1]) + 1 if len(there) else 0

    def spare(self, length: int, held: Counter) -> int:
        return int(self.counts[length]) - held[length]

    def pair(self, total: int, held: Counter) -> tuple[int, ...]:
        """Two lengths that sum to ``total``, the longer one as long as can be."""
        low = (total + 1) // 2
        left = self.counts[: total + 1]
        for long in (np.flatnonzero((left[low:total] > 0) & (left[total - low : 0 : -1] > 0))[::-1] + low).tolist():
            short = total - long
            if self.spare(long, held) > 0 and self.spare(short, held) > (long == short):
                return long, short
        return ()

    def exact(self, gap: int, held: Counter) -> tuple[int, ...]:
        if self.spare(gap, held) > 0:
            return (gap,)
        if found := self.pair(gap, held):
            return found
        there = np.flatnonzero(self.counts[:gap])
        if len(there) != self.pair_sums_of:  # sums of any two lengths left, as the bits of one number
            bits = sum(1 << n for n in np.flatnonzero(self.counts).tolist())
            self.pair_sums, self.pair_sums_of = 0, len(there)
            for n in np.flatnonzero(self.counts).tolist():
                self.pair_sums |= bits << n
        for first in there[::-1].tolist():
            if 3 * first < gap:
                break  # the longest of three is a third at least
            if self.pair_sums >> (gap - first) & 1 and self.spare(first, held) > 0:
                held[first] += 1
                rest = self.pair(gap - first, held)
                held[first] -= 1
                if rest:
                    return first, *rest
        return ()


def packing_plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Sequences as (lengths in order, how many such), from the number of pieces of each length (index 0 to capacity)."""
    left = Complements(counts)
    plan = []
    while first := left.longest(capacity):
        lengths, held, gap = [first], Counter([first]), capacity - first
        while gap:
            filled = left.exact(gap, held)
            if not filled:
                fit = next((n for n in range(left.longest(gap), 0, -1) if left.spare(n, held) > 0), 0)
                filled = (fit,) if fit else ()
            if not filled:
                break
            lengths += filled
            held.update(filled)
            gap -= sum(filled)
        held = +held  # without lengths tried and put back
        times = min(int(left.counts[n]) // k for n, k in held.items())
        for n, k in held.items():
            left.counts[n] -= k * times
        plan.append((tuple(lengths), times))
    return plan


def places(plan: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """For each run of pieces of one length: its length and first number, the sequence of the first, and the offset."""
    used: Counter = Counter()
    rows, sequence = [], 0
    for lengths, times in plan:
        offset = 0
        for n in lengths:
            rows.append((n, used[n], sequence, offset))
            used[n] += times
            offset += n
        sequence += times
    rows.sort()
    return dict(zip(("length", "first", "sequence", "offset"), np.array(rows, np.int64).reshape(-1, 4).T))


def pack(pieces: DataFrame, capacity: int = CAPACITY, per_bucket: int = PER_BUCKET) -> DataFrame:
    """Add sequence_id and offset to ``pieces`` (see ``token_pieces``).

    Pieces of one length are dealt to as many buckets as hold about ``per_bucket`` each, and numbered within. They are told
    apart by where they are written, so equal rows don't share a bucket."""
    pieces = cut_lineage(pieces.withColumn("row", F.monotonically_increasing_id()))
    counts = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    buckets = counts // per_bucket + 1
    # Of all buckets one after another, where those of each length start.
    first = np.cumsum(buckets) - buckets
    dealt = pieces.sparkSession.createDataFrame(list(zip(range(capacity + 1), buckets.tolist(), first.tolist())), "length long, buckets long, first long")
    pieces = pieces.join(F.broadcast(dealt), "length").withColumn("bucket", F.col("first") + F.pmod(F.xxhash64("row"), F.col("buckets"))).drop("buckets", "first")
    # One row per bucket: one per length and one per ``per_bucket`` pieces.
    sizes = np.zeros(int(buckets.sum()), np.int64)
    for row in pieces.groupBy("bucket").count().collect():
        sizes[row["bucket"]] = row["count"]
    before = np.cumsum(sizes) - sizes
    before -= np.repeat(before[first], buckets)
    place = places(packing_plan(counts, capacity))
    step = np.int64(1) << 48
    known = place["length"] * step + place["first"]

    def build():
        def work(batch: pa.RecordBatch) -> dict:
            length, bucket, number = (batch.column(n).to_numpy() for n in ("length", "bucket", "number"))
            rank = before[bucket] + number - 1
            at = np.searchsorted(known, length * step + rank, "right") - 1
            same = {n: batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")}
            return same | {"sequence_id": place["sequence"][at] + rank - place["first"][at], "offset": place["offset"][at]}

        return work

    numbered = pieces.withColumn("number", F.row_number().over(Window.partitionBy("bucket").orderBy("row"))).withColumn("none", F.lit(""))
    return map_arrow(
        numbered, build, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long", "none"
    )


def packed_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pack all texts into sequences of at most ``capacity`` tokens, one row per piece.

    A null or empty text is the end id alone. Repeated rows and null keys are packed like any other row.
    An empty table gives no rows. Other columns of ``docs`` are ignored, whatever their names.
    """
    return pack(token_pieces(docs, vocabulary, capacity, end_id, key, text), capacity)


def word_vocabulary() -> str:
    return public_tokenizers.path("word_bpe_49k.json")

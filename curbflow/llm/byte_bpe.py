"""Byte-level BPE encoding and decoding with Spark's higher-order functions.

A word is a text with one character for each of its pieces, at first for each byte;
the character stands for the piece's rank. A fold finds the ranks of every two
neighbours in a literal map, joins the first two of the lowest rank, and goes on
until no two neighbours have a rank. Ids are the ranks of the pieces that are
left; decoding puts the bytes of the ids' pieces together.

The words that stand in most documents are folded once and travel as a map, the
value of a subquery; every other word is folded where it stands, so no word is a
row between tasks. Maps are lists of small ones, found by the crc32 of the key,
since Spark searches a map from its first key on; those of the literal are texts.

Words of over ``2 * PART`` bytes are folded in parts of ``PART`` bytes and in
zones over each border of two parts. Where a part and a zone have the same piece
at the same place, one may go on with the other: every two neighbours then stand
so in an encoding, which makes the whole one. A word without such a place is
folded as a whole.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable
from dataclasses import dataclass

import public_tokenizers
from pyspark.sql import Column, DataFrame, functions as F

from curbflow.llm.common import keyed_texts, written

# Words that are folded once, the most bytes of such a word, and about how many documents they are counted in.
# All other words are folded where they stand; the choice changes the cost and no result.
FREQUENT, FREQUENT_BYTES, COUNTED = 131_072, 32, 50_000
PART = 128
# Slots that a literal map is dealt out to, and small maps that the map of frequent words is.
SLOTS, WORD_SLOTS = 1 << 16, 1 << 16
# The character of rank r is that of code FIRST + r, past the surrogates. Characters that stand for no piece: at both ends of a
# word, between the entries of a slot, between slots, and the rank of two pieces that are none together, the greatest.
FIRST, EDGE, ENTRY, SLOT, NONE = 16, "\x01", "\x02", "\x03", "\U0010ffff"

# Letters and numbers that the pattern's library knows and that Java 17 (Unicode 13) does not.
NEWER_LETTERS = (
    "870-887 889-88E 8B5 8C8-8C9 C5D CDD 170D 171F 1B4C 1C89-1C8A 2C2F 2C5F 9FFD-9FFF A7C0-A7C1 A7CB-A7CD A7D0-A7D1 A7D3 A7D5-A7DC "
    "A7F2-A7F4 10570-1057A 1057C-1058A 1058C-10592 10594-10595 10597-105A1 105A3-105B1 105B3-105B9 105BB-105BC 105C0-105F3 10780-10785 "
    "10787-107B0 107B2-107BA 10D4A-10D65 10D6F-10D85 10EC2-10EC4 10F70-10F81 11071-11072 11075 1123F-11240 11380-11389 1138B 1138E "
    "11390-113B5 113B7 113D1 113D3 11740-11746 11AB0-11ABF 11BC0-11BE0 11F02 11F04-11F10 11F12-11F33 12F90-12FF0 1342F 13441-13446 "
    "13460-143FA 16100-1611D 16A70-16ABE 16D40-16D6C 18CFF 1AFF0-1AFF3 1AFF5-1AFFB 1AFFD-1AFFE 1B11F-1B122 1B132 1B155 1DF00-1DF1E "
    "1DF25-1DF2A 1E030-1E06D 1E290-1E2AD 1E4D0-1E4EB 1E5D0-1E5ED 1E5F0 1E7E0-1E7E6 1E7E8-1E7EB 1E7ED-1E7EE 1E7F0-1E7FE 2A6DE-2A6DF "
    "2B735-2B739 2EBF0-2EE5D 31350-323AF"
)
NEWER_NUMBERS = "10D40-10D49 116D0-116E3 11BF0-11BF9 11F50-11F59 16130-16139 16AC0-16AC9 16D70-16D79 1CCF0-1CCF9 1D2C0-1D2D3 1E4F0-1E4F9 1E5F1-1E5FA"


def in_class(ranges: str) -> str:
    """Ranges of code points as they are written in a Java character class."""
    return "".join("-".join(rf"\x{{{end}}}" for end in one.split("-")) for one in ranges.split())


def words_of(text: Column, pattern: str = public_tokenizers.PATTERN) -> Column:
    """All matches of the pattern in order. Only texts with characters from U+0870 on need the newer classes."""
    newer = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^\s\p{{L}}\p{{N}}{in_class(NEWER_LETTERS + ' ' + NEWER_NUMBERS)}]")
    newer = newer.replace(r" ?\p{L}+", rf" ?[\p{{L}}{in_class(NEWER_LETTERS)}]+").replace(r" ?\p{N}+", rf" ?[\p{{N}}{in_class(NEWER_NUMBERS)}]+")
    matches = lambda p: F.regexp_extract_all(text, F.lit(f"(?U){p}"), F.lit(0))
    return F.when(text.rlike(r"[\x{870}-\x{10FFFF}]"), matches(newer)).otherwise(matches(pattern))


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def char_of(rank: int) -> str:
    """The character of a rank."""
    return chr(FIRST + rank + (0x800 if FIRST + rank >= 0xD800 else 0))


def rank_of(char: Column) -> Column:
    """The rank that a character stands for."""
    return F.ascii(char) - F.when(char < F.lit("\ue000"), FIRST).otherwise(FIRST + 0x800)


def literal_map(entries: dict[str, str]) -> Column:
    """A list of texts, each with the entries of a slot; see ``rank_in``. Spark makes it a literal when it plans."""
    slots = [ENTRY + NONE] * SLOTS
    for key, char in entries.items():
        slots[zlib.crc32(key.encode()) % SLOTS] += ENTRY + key + ENTRY + char
    return F.split(F.lit(SLOT.join(slots)), SLOT)


def slot_of(entries: Column, key: Column, slots: int = SLOTS) -> Column:
    return F.get(entries, F.crc32(key.cast("binary")) % slots)


def rank_in(entries: Column, pair: Column) -> Column:
    """The character of the rank that two characters have together in a literal map; NONE if there is none."""
    # What stands after the pair, or the whole slot; in both the character is the second.
    return F.substring(F.call_function("substring_index", slot_of(entries, pair), pair, F.lit(-1)), 2, 1)


@dataclass
class Ranks:
    """A vocabulary of byte strings by rank, which is also the id."""

    by_bytes: dict[bytes, int]

    @classmethod
    def of_file(cls, path: str) -> Ranks:
        """Read a file with a base64 piece and its rank on each line."""
        with open(path, "rb") as file:
            return cls({base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)})

    def joins(self) -> dict[str, str]:
        """The character of every piece by those of any two pieces that it is together."""
        by_bytes, found = self.by_bytes, {}
        for piece, rank in by_bytes.items():
            for cut in range(1, len(piece)):
                left, right = by_bytes.get(piece[:cut]), by_bytes.get(piece[cut:])
                if left is not None and right is not None:
                    found[char_of(left) + char_of(right)] = char_of(rank)
        return found

    def literals(self) -> Column:
        """The map of joins, the characters of bytes, and lists of each rank's bytes and of each id as 4 bytes, both as hexadecimal text."""
        pieces = [""] * (1 + max(self.by_bytes.values()))
        for piece, rank in self.by_bytes.items():
            pieces[rank] = piece.hex().upper()
        numbers = [rank.to_bytes(4, "little").hex() for rank in range(len(pieces))]
        texts = lambda values: F.split(F.lit(",".join(values)), ",")
        of_bytes = "".join(char_of(self.by_bytes[bytes([b])]) for b in range(256))
        return F.struct(
            literal_map(self.joins()).alias("joins"), F.lit(of_bytes).alias("bytes"),
            texts(pieces).alias("pieces"), texts(numbers).alias("numbers"),
        )


def text_of(word: Column, known: Column) -> Column:
    """A character for each byte of a word or of other bytes."""
    latin = F.lit("".join(map(chr, range(256))))
    return F.call_function("translate", F.decode(word.cast("binary"), "ISO-8859-1"), latin, known["bytes"])


def chars(text: Column) -> Column:
    """All characters of a text."""
    return let(text, lambda whole: F.slice(F.split(whole, ""), F.lit(1), F.length(whole)))


def on_bytes(of_text: Callable[[Column], Column], parts: Column, known: Column) -> Column:
    """The pieces that a function of texts finds, from an array of bytes; both as hexadecimal text."""
    found = let(text_of(F.unhex(F.array_join(parts, "")), known), of_text)
    return F.transform(chars(found), lambda char: F.get(known["pieces"], rank_of(char)))


def tail(parts: Column) -> Column:
    return F.slice(parts, F.lit(2), F.size(parts))


def merged(text: Column, known: Column) -> Column:
    """The text of a word after all merges. Each step joins the first two neighbours of the lowest rank."""
    rank = lambda pair: rank_in(known["joins"], pair)
    # Character j of ranks is that of characters j and j + 1 of text together; an edge has none with any.
    state = lambda text, ranks: F.struct(text.alias("text"), ranks.alias("ranks"))
    pair = lambda text, j: text.substr(j, F.lit(2))

    def step(s: Column, _: Column) -> Column:
        def join(best: Column) -> Column:
            def at(j: Column) -> Column:
                # Overlay copies whole texts at once, where a lambda would be worked out for each piece.
                beside = lambda text: F.concat(rank(pair(text, j - 1)), rank(pair(text, j)))
                joined = lambda text: state(text, F.overlay(s["ranks"], beside(text), j - 1, F.lit(3)))
                return let(F.overlay(s["text"], best, j, F.lit(2)), joined)

            return F.when(best == NONE, s).otherwise(let(F.instr(s["ranks"], best), at))

        return let(F.array_min(F.split(s["ranks"], "")), join)

    def whole(text: Column) -> Column:
        ranks = F.array_join(F.transform(F.sequence(F.lit(1), F.length(text) - 1), lambda j: rank(pair(text, j))), "")
        return F.aggregate(F.sequence(F.lit(3), F.length(text)), state(text, ranks), step)["text"]

    edged = let(F.concat(F.lit(EDGE), text, F.lit(EDGE)), whole)
    return let(edged, lambda text: F.substr(text, F.lit(2), F.length(text) - 2))


def folded(parts: Column, known: Column) -> Column:
    """The pieces of an array of bytes after all merges; see ``merged``."""
    return on_bytes(lambda text: merged(text, known), parts, known)


def merged_at_once(text: Column, known: Column) -> Column:
    """What ``merged`` gives. Each step joins all neighbours of the lowest rank at once, which is what joining them one by
    one from the left gives: a join makes no neighbours of a lower rank. A step costs more, and long words need few."""
    stale = F.lit(EDGE)
    rank = lambda a, b: F.coalesce(rank_in(known["joins"], F.concat(a, b)), F.lit(NONE))
    # Each piece with the rank that it has together with the next one.
    item = lambda piece, r: F.struct(piece.alias("piece"), r.alias("rank"))
    state = lambda items: F.struct(items.alias("items"), F.array_min(F.transform(items, lambda x: x["rank"])).alias("rank"))
    none = F.lit(None).cast("struct<piece:string,rank:string>")

    def step(s: Column, _: Column) -> Column:
        items, best = s["items"], s["rank"]

        def join(marks: Column) -> Column:
            # Of overlapping places, which only twice the same piece has, every second counts, from the left.
            taken = F.transform(F.split(F.regexp_replace(marks, "11", "10"), ""), lambda mark: mark == "1")
            put = lambda at: F.filter(F.transform(items, lambda x, i: (
                F.when(F.get(at, i), item(best, stale)).when(F.get(at, i - 1), none).when(F.get(at, i + 1), item(x["piece"], stale)).otherwise(x)
            )), lambda x: x.isNotNull())
            ranked = lambda left: F.transform(left, lambda x, i: (
                F.when(x["rank"] == stale, item(x["piece"], rank(x["piece"], F.get(left, i + 1)["piece"]))).otherwise(x)
            ))
            return let(let(let(taken, put), ranked), state)

        marks = F.array_join(F.transform(items, lambda x: F.when(x["rank"] == best, "1").otherwise("0")), "")
        return F.when(F.coalesce(best, F.lit(NONE)) == NONE, s).otherwise(let(marks, join))

    start = let(chars(text), lambda parts: F.zip_with(parts, tail(parts), lambda a, b: item(a, rank(a, b))))
    items = F.aggregate(F.sequence(F.lit(1), F.length(text)), let(start, state), step)["items"]
    return F.array_join(F.transform(items, lambda x: x["piece"]), "")


def folded_at_once(parts: Column, known: Column) -> Column:
    """What ``folded`` gives; see ``merged_at_once``."""
    return on_bytes(lambda text: merged_at_once(text, known), parts, known)


def spans(text: Column, start: Column, known: Column) -> Column:
    """Pieces with their places: an array of (start, end, piece)."""
    none = F.expr("cast(array() as array<struct<start:int,end:int,piece:string>>)")

    def step(state: Column, piece: Column) -> Column:
        size = F.shiftright(F.length(F.get(known["pieces"], rank_of(piece))), 1)
        one = F.struct(state["at"].alias("start"), (state["at"] + size).alias("end"), piece.alias("piece"))
        return F.struct(F.concat(state["done"], F.array(one)).alias("done"), (state["at"] + size).alias("at"))

    return F.aggregate(chars(text), F.struct(none.alias("done"), start.cast("int").alias("at")), step)["done"]


def merged_in_parts(text: Column, known: Column, part: int = PART) -> Column:
    """What ``merged`` gives, from the folds of parts and of zones over their borders; null if some border has no common piece."""
    count = F.ceil(F.length(text) / part).cast("int")
    piecewise = lambda first, last, shift: F.transform(
        F.sequence(first, last), lambda k: let(k * part + shift, lambda at: spans(merged(text.substr(at + 1, F.lit(part)), known), at, known))
    )

    def cut(sides: Column) -> Column:
        own, zones = sides["own"], sides["zones"]
        # Where the zone after each part takes over, and where the next part does.
        over = F.zip_with(F.slice(own, F.lit(1), F.size(zones)), zones, lambda a, z: F.get(F.array_intersect(a, z), F.lit(0))["end"])
        back = F.zip_with(zones, tail(own), lambda z, a: F.get(F.array_intersect(z, a), F.lit(0))["start"])
        ends = F.struct(F.concat(F.array(F.lit(0)), back).alias("starts"), F.concat(over, F.array(F.length(text))).alias("ends"))

        def whole(at: Column) -> Column:
            def of_part(found_in: Column, k: Column) -> Column:
                kept = F.filter(found_in, lambda p: (p["start"] >= F.get(at["starts"], k)) & (p["end"] <= F.get(at["ends"], k)))
                between = F.filter(F.get(zones, k), lambda p: (p["start"] >= F.get(at["ends"], k)) & (p["end"] <= F.get(at["starts"], k + 1)))
                return F.concat(kept, F.when(k < F.size(zones), between).otherwise(F.slice(kept, F.lit(1), F.lit(0))))

            pieces = F.array_join(F.transform(F.flatten(F.transform(own, of_part)), lambda p: p["piece"]), "")
            missing = F.exists(F.concat(at["starts"], at["ends"]), lambda p: p.isNull())
            return F.when(~missing, pieces)

        return let(ends, whole)

    return let(F.struct(piecewise(F.lit(0), count - 1, 0).alias("own"), piecewise(F.lit(0), count - 2, part // 2).alias("zones")), cut)


def stitched(parts: Column, known: Column, part: int = PART) -> Column:
    """What ``folded`` gives, or null; see ``merged_in_parts``."""
    return on_bytes(lambda text: merged_in_parts(text, known, part), parts, known)


def merged_long(text: Column, known: Column, part: int = PART) -> Column:
    return F.coalesce(merged_in_parts(text, known, part), merged_at_once(text, known))


def word_text(word: Column, known: Column, part: int = PART) -> Column:
    """The text of a word after all merges."""
    return let(text_of(word, known), lambda text: F.when(F.length(text) > 2 * part, merged_long(text, known, part)).otherwise(merged(text, known)))


def ids_of(text: Column) -> Column:
    return F.transform(chars(text), rank_of)


def word_ids(word: Column, known: Column, part: int = PART) -> Column:
    """The ids of a word."""
    return ids_of(word_text(word, known, part))


def merged_between(text: Column, known: Column) -> Column:
    """A text with its words between two edges after all merges; around them stand texts of finished words."""

    def whole(parts: Column) -> Column:
        done = F.transform(F.filter(parts, lambda _, i: i % 2 == 1), lambda word: merged(word, known))
        around = F.filter(parts, lambda _, i: i % 2 == 0)
        return F.array_join(F.zip_with(around, done, lambda a, word: F.concat(a, F.coalesce(word, F.lit("")))), "")

    return let(F.split(text, EDGE), whole)


def frequent_words(words: DataFrame, ranks: Ranks, most: int = FREQUENT, most_bytes: int = FREQUENT_BYTES, counted: int = COUNTED) -> DataFrame:
    """Rows (word, text), settled, of the words that stand in most of about ``counted`` rows of ``words`` (doc_id, words), at most
    ``most`` words of few bytes."""
    share = counted / max(counted, words.count())
    drawn = words.where(F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(1_000_000)) < int(share * 1_000_000))
    each = drawn.select(F.explode(F.array_distinct("words")).alias("word")).where(F.octet_length("word") <= most_bytes)
    often = each.groupBy("word").count().orderBy(F.desc("count"), "word").limit(most).select("word")
    return written(often.repartition(24).select("word", let(ranks.literals(), lambda known: word_text(F.col("word"), known)).alias("text")))


def settled_map(entries: DataFrame) -> Column:
    """A list of small maps of the rows (word, text), which Spark puts in place of a subquery when the query starts.

    It never goes through Python, and tasks read it as one block of bytes."""
    slot = (F.crc32("word") % WORD_SLOTS).alias("slot")
    dealt = entries.groupBy(slot).agg(F.collect_list("word").alias("words"), F.collect_list("text").alias("texts"))
    empty = entries.sparkSession.range(WORD_SLOTS).select(F.col("id").alias("slot"))
    slots = empty.join(dealt, "slot", "left").agg(F.sort_array(F.collect_list(F.struct("slot", "words", "texts"))).alias("slots"))
    return slots.select(F.transform("slots", lambda x: F.map_from_arrays(x["words"], x["texts"]))).scalar()


def encode(docs: DataFrame, ranks: Ranks, key: str = "doc_id", text: str = "text", pattern: str = public_tokenizers.PATTERN, most: int = FREQUENT) -> DataFrame:
    """Rows (doc_id, ids), one per row of ``docs``: the ids of each match of the pattern, in order.

    A null or empty text has no ids. Repeated rows give repeated rows, a null key stays null, an empty table gives
    no rows. Texts and words may be of any length. Other columns are ignored, whatever their names.
    """
    words = keyed_texts(docs, key, text).select("doc_id", words_of(F.coalesce("text", F.lit("")), pattern).alias("words"))
    # Within a lambda Spark takes a column that stands for a subquery, and no subquery.
    words = words.withColumn("frequent", settled_map(frequent_words(words, ranks, most)))
    known = F.struct(ranks.literals().alias("vocabulary"), "frequent")

    def of_word(at: Column, word: Column) -> Column:
        folding = lambda text: F.when(F.length(text) > 2 * PART, merged_long(text, at["vocabulary"])).otherwise(F.concat(F.lit(EDGE), text, F.lit(EDGE)))
        return F.coalesce(F.element_at(slot_of(at["frequent"], word, WORD_SLOTS), word), let(text_of(word, at["vocabulary"]), folding))

    joined = lambda at: F.array_join(F.transform("words", lambda word: of_word(at, word)), "")
    return words.select("doc_id", ids_of(let(known, lambda at: merged_between(joined(at), at["vocabulary"]))).alias("ids"))


def id_bytes(ids: Column, known: Column) -> Column:
    """Ids as little-endian unsigned 32-bit numbers."""
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(known["numbers"], i)), ""))


def decode(ids: Column, known: Column) -> Column:
    """The bytes that the ids stand for."""
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(known["pieces"], i)), ""))


def encoded_documents(docs: DataFrame, ranks: Ranks, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode all texts and decode them again: doc_id, n_tokens, ids_sha256, decoded_sha256. See ``encode`` for odd rows."""
    digests = let(ranks.literals(), lambda known: F.struct(
        F.sha2(id_bytes(F.col("ids"), known), 256).alias("ids_sha256"), F.sha2(decode(F.col("ids"), known), 256).alias("decoded_sha256")
    )).alias("digests")
    ids = encode(docs, ranks, key, text)
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digests).select("doc_id", "n_tokens", "digests.*")


def multilingual_ranks() -> Ranks:
    return Ranks.of_file(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))

"""Exact clusterings of vectors and byte-level BPE, against plain versions and the public library."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
import tiktoken
from public_tokenizers import PATTERN
from tables import ODD_TEXTS, SF_DIR, no_docs, odd_docs

from curbflow.llm import byte_bpe, centroid_clusters, vector_codes
from curbflow.llm.common import table

VECTORS = "vec_id long, embedding array<double>, label int, code string, ids string, _label int, vector int"


def vectors(spark, rows):
    """Rows (vec_id, vector, label), with columns that operators might use themselves."""
    return spark.createDataFrame([(i, v, label, "x", "x", 1, 1) for i, v, label in rows], VECTORS)


def sha(numbers):
    return hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()


def nearest(x, centers):
    far = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centers]
    return far.index(min(far)), min(far)


def means(members, old):
    return [sum(m[j] for m in members) // len(members) for j in range(len(old))] if members else old


# ---- clusters ----


def clusters_by_brute_force(rows, k, rounds, dim, scale):
    kept = [(i, [int(np.floor(scale * v)) for v in x]) for i, x, _ in rows if x is not None and len(x) == dim and all(v is not None and np.isfinite(v) for v in x)]
    first = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None)[:k]
    centers = [x for _, x in first]
    for n in range(rounds + 1):
        homes = [nearest(x, centers) for _, x in kept]
        if n < rounds:
            centers = [means([x for (_, x), (home, _) in zip(kept, homes) if home == c], old) for c, old in enumerate(centers)]
    inertia = defaultdict(int)
    for home, far in homes:
        inertia[home] += far
    return sorted(
        (-1 if i is None else i, home, far, inertia[home], sum(inertia.values()), sha(centers[home])) for (i, _), (home, far) in zip(kept, homes)
    )


def odd_vectors(dim, n, hot=0.4):
    random_ = np.random.default_rng(4)
    x = np.round(random_.normal(size=(n, dim)), 2)
    x[: int(hot * n)] = x[0]  # one common vector
    rows = [(i, v.tolist(), [None, 0, 0, 0, 1][i % 5]) for i, v in enumerate(x)]
    nan, inf = float("nan"), float("inf")
    odd = [(n, None, 1), (n + 1, [], 1), (n + 2, [None] + [1.0] * (dim - 1), 1), (n + 3, [nan] * dim, 1), (n + 4, [inf] + [0.0] * (dim - 1), None)]
    odd += [(n + 5, [0.0] * (dim - 2), 1), (n + 6, [0.0] * dim, 7), (None, x[1].tolist(), 7), (5, x[6].tolist(), 7), (5, x[5].tolist(), 7), (5, x[5].tolist(), 7)]
    return rows + odd + [(n + 7, [30000.5] * dim, 7), (n + 8, [-30000.5] * dim, 9)]


@pytest.mark.parametrize("chunk", [16, 32_768])
def test_clusters_are_those_of_plain_rounds(spark, chunk):
    rows = odd_vectors(8, 300)
    found = centroid_clusters.clusters(vectors(spark, rows).repartition(5), k=7, rounds=3, dim=8, scale=256, chunk=chunk).collect()
    got = sorted((-1 if r.vec_id is None else r.vec_id, *tuple(r)[1:]) for r in found)
    assert got == clusters_by_brute_force(rows, 7, 3, 8, 256)


def test_clusters_of_few_and_of_no_vectors(spark):
    rows = odd_vectors(4, 9)
    found = centroid_clusters.clusters(vectors(spark, rows), dim=4).collect()
    assert sorted((-1 if r.vec_id is None else r.vec_id, *tuple(r)[1:]) for r in found) == clusters_by_brute_force(rows, 40, 5, 4, 256)
    assert centroid_clusters.clusters(vectors(spark, []), dim=4).count() == 0
    assert centroid_clusters.clusters(vectors(spark, [(None, [1.0] * 4, 1), (3, None, 1)]), dim=4).count() == 0


def test_dictionaries_lose_nothing_and_fit_the_rows():
    random_ = np.random.default_rng(5)
    spread, common = random_.integers(-300, 300, (2000, 16)), np.tile(random_.integers(-300, 300, (3, 16)), (700, 1))
    for x in (spread, common, spread[:1], np.hstack([common[:2000], spread])):
        blocks = centroid_clusters.blocks_of(x)
        assert (np.hstack([values[codes] for values, codes in blocks]) == x).all()
        assert all(len(np.unique(values, axis=0)) == len(values) for values, _ in blocks)
    assert [values.shape for values, _ in centroid_clusters.blocks_of(common)] == [(3, 16)]
    assert len(centroid_clusters.blocks_of(spread)) > 4


# ---- codes ----


def codes_by_brute_force(rows, parts, entries, rounds, scale, dim):
    kept = [(i, [int(np.floor(scale * v)) for v in x], label) for i, x, label in rows if x is not None and len(x) == dim and all(v is not None and np.isfinite(v) for v in x)]
    width = dim // parts
    cut = [[x[p * width : (p + 1) * width] for p in range(parts)] for _, x, _ in kept]
    first = sorted((i, x) for i, x, _ in kept if i is not None)[:entries]
    books = [[x[p * width : (p + 1) * width] for _, x in first] for p in range(parts)]
    for n in range(rounds + 1):
        homes = [[nearest(x[p], books[p]) for p in range(parts)] for x in cut]
        if n < rounds:
            books = [[means([x[p] for x, home in zip(cut, homes) if home[p][0] == e], old) for e, old in enumerate(books[p])] for p in range(parts)]
    errors = [sum(far for _, far in home) for home in homes]
    by_label = defaultdict(int)
    for (_, _, label), error in zip(kept, errors):
        by_label[label] += error
    digest = sha([v for book in books for entry in book for v in entry])
    out = [(-1 if i is None else i, "".join(f"{h:02x}" for h, _ in home), e, by_label[label], digest) for (i, _, label), home, e in zip(kept, homes, errors)]
    return sorted(out)


def test_codes_are_those_of_plain_rounds(spark):
    rows = odd_vectors(8, 200)
    found = vector_codes.codes(vectors(spark, rows).repartition(5), parts=4, entries=16, rounds=3, scale=1024).collect()
    assert sorted((-1 if r.vec_id is None else r.vec_id, *tuple(r)[1:]) for r in found) == codes_by_brute_force(rows, 4, 16, 3, 1024, 8)


def test_codes_of_few_and_of_no_vectors(spark):
    rows = [(3, [1.0, 2.0, 3.0, 4.0], 1), (2, [1.0, 2.0, 3.5, 4.0], None), (9, [1.0, 2.0], None)]
    found = vector_codes.codes(vectors(spark, rows)).collect()
    assert sorted(tuple(r) for r in found) == codes_by_brute_force(rows, 4, 256, 4, 1024, 4)
    for none in ([], [(None, [1.0] * 4, 1), (3, None, 1)], [(1, [1.0] * 3, 1)]):
        assert vector_codes.codes(vectors(spark, none)).count() == 0
    with pytest.raises(ValueError):
        vector_codes.codes(vectors(spark, rows), entries=257)


@pytest.mark.parametrize("largest", [1, 1 << 11, 1 << 24, 1 << 28])
def test_limb_products_are_exact(largest):
    random_ = np.random.default_rng(6)
    for width in (1, 3, 16, 100):
        x, y = random_.integers(-largest, largest + 1, (50, width)), random_.integers(-largest, largest + 1, (9, width))
        x[0], y[0], x[1] = largest, largest, -largest
        assert vector_codes.dot_products(x, y).tolist() == [[sum(int(a) * int(b) for a, b in zip(u, v)) for v in y] for u in x]
        assert width * (1 << 2 * vector_codes.limb_bits(width)) < 1 << 53
    assert len(vector_codes.limbs(np.array([1 << 29]), 24)) == 2 and len(vector_codes.limbs(np.array([-5]), 24)) == 1


def test_ties_go_to_the_first_entry():
    x = np.array([[0, 0], [2, 0]])
    entries = np.array([[1, 0], [-1, 0], [1, 0], [3, 0]])
    assert [a.tolist() for a in vector_codes.nearest(x, entries)] == [[0, 0], [1, 1]]


# ---- byte-level BPE ----


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.multilingual_ranks()


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks.by_bytes, special_tokens={})


def test_ids_are_those_of_the_library(spark, ranks, library):
    choose = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = [*ODD_TEXTS]
    texts += [(100 + i, "".join(choose.choices(letters, k=choose.choice((3, 50, 300, 700, 3000))))) for i in range(20)]
    texts += [(200, "x" * 9000), (201, "abc" * 2000), (202, "-" * 5001), (203, " " * 3000 + "x"), (204, "中文字" * 500), (205, "it's I'LL 12½ \u0085　 \n\n a")]
    texts += [(206, "".join(map(chr, range(1, 0x2100)))), (207, " ".join(chr(c) for c in range(0x800, 0x20000, 7) if not 0xD800 <= c < 0xE000))]
    want = {text: library.encode_ordinary(text or "") for _, text in texts}
    docs = odd_docs(spark, texts)
    for rows in (byte_bpe.encode(docs, ranks, most=50).collect(), byte_bpe.encode(docs, ranks).collect()):
        assert [(r.doc_id, list(r.ids)) for r in rows] == [(i, want[text]) for i, text in texts]
    digests = byte_bpe.encoded_documents(docs, ranks).collect()
    as_bytes = lambda ids: np.array(ids, "<u4").tobytes()
    assert [tuple(r) for r in digests] == [
        (i, len(want[t]), hashlib.sha256(as_bytes(want[t])).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in texts
    ]
    assert byte_bpe.encoded_documents(no_docs(spark), ranks).count() == 0


def test_classes_of_characters_are_those_of_the_library(spark, library):
    """Each character alone, between letters and between numbers, for all blocks with newer letters or numbers."""
    ends = [int(end, 16) for one in (byte_bpe.NEWER_LETTERS + " " + byte_bpe.NEWER_NUMBERS).split() for end in one.split("-")]
    odd = sorted({c for end in ends for c in (end - 1, end, end + 1)} | {*range(0x80, 0x100), 0x180E, *range(0x2000, 0x2070), 0x3000, 0xFEFF})
    texts = [(n, f"a{chr(c)}b 1{chr(c)}2 !{chr(c)}! {chr(c)}") for n, c in enumerate(odd)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    cut = docs.select("doc_id", byte_bpe.words_of(docs["text"]).alias("words")).collect()
    # A vocabulary of single bytes shows each match of a class by whether its bytes come out.
    alone = lambda p: tiktoken.Encoding(p, pat_str=p, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    classes = [(alone(p), kind) for p, kind in ((r"\p{L}", "letter"), (r"\p{N}", "number"), (r"\s", "space"))]
    for c, (_, text), row in zip(odd, texts, cut):
        kind = next((kind for library, kind in classes if library.encode_ordinary(chr(c))), "other")
        x = chr(c)
        want = {
            "letter": [f"a{x}b", " 1", x, "2", " !", x, "!", f" {x}"], "number": ["a", x, "b", f" 1{x}2", " !", x, "!", f" {x}"],
            "space": ["a", x, "b", " 1", x, "2", " !", x, "!", f" {x}"], "other": ["a", x, "b", " 1", x, "2", f" !{x}!", f" {x}"],
        }[kind]
        if kind == "space":
            # A blank goes with the word after it; another space stands alone.
            want = ["a", *([f"{x}b"] if x == " " else [x, "b"]), " 1", *([f"{x}2"] if x == " " else [x, "2"]), " !", *([f"{x}!"] if x == " " else [x, "!"]), f" {x}"]
        assert list(row.words) == want, (hex(c), kind)


def test_long_words_are_put_together_from_parts(spark, ranks, library):
    from pyspark.sql import functions as F

    choose = random.Random(9)
    texts = ["".join(choose.choices("etaoinshrdlu", k=n)) for n in (17, 64, 65, 200, 999)] + ["ab" * 300, "thequickbrownfox" * 40]
    docs = spark.createDataFrame([(t,) for t in texts], "t string")
    known = ranks.literals()
    parts = F.regexp_extract_all(F.hex("t"), F.lit(".."), F.lit(0))
    rows = docs.select(
        byte_bpe.let(known, lambda k: byte_bpe.word_ids(F.col("t"), k, part=32)).alias("ids"),
        F.when(F.octet_length("t") > 32, byte_bpe.let(known, lambda k: byte_bpe.stitched(parts, k, 32))).alias("pieces"),
    ).collect()
    assert [list(r.ids) for r in rows] == [library.encode_ordinary(t) for t in texts]
    for text, row in zip(texts, rows):
        if row.pieces is not None:
            assert [ranks.by_bytes[bytes.fromhex(p)] for p in row.pieces] == library.encode_ordinary(text)
    assert sum(r.pieces is not None for r in rows) >= 4


def test_whole_table_round_trip(spark, ranks, library):
    docs = table(spark, SF_DIR, "documents")
    rows = {r.doc_id: r for r in byte_bpe.encoded_documents(docs, ranks).collect()}
    for doc in docs.collect():
        ids = library.encode_ordinary(doc.text or "")
        assert rows[doc.doc_id].n_tokens == len(ids) and rows[doc.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[doc.doc_id].decoded_sha256 == hashlib.sha256((doc.text or "").encode()).hexdigest()


def test_one_join_a_step_gives_what_all_at_once_give(spark, ranks, library):
    from pyspark.sql import functions as F

    choose = random.Random(11)
    texts = ["a", "aa", "aaa", "ababababa", "--------", *("".join(choose.choices("aeinrst", k=n)) for n in (2, 5, 9, 17, 40, 200))]
    docs = spark.createDataFrame([(t,) for t in texts], "t string")
    parts = F.regexp_extract_all(F.hex("t"), F.lit(".."), F.lit(0))
    both = lambda k: F.struct(byte_bpe.folded(parts, k).alias("first"), byte_bpe.folded_at_once(parts, k).alias("all"))
    for text, (row,) in zip(texts, docs.select(byte_bpe.let(ranks.literals(), both)).collect()):
        assert list(row["first"]) == list(row["all"])
        assert [ranks.by_bytes[bytes.fromhex(p)] for p in row["first"]] == library.encode_ordinary(text)


def test_frequent_words_are_no_part_of_the_plan(spark, ranks):
    """They are a subquery's value: no literal in Python or in the plan, and no column that every row would carry."""
    docs = spark.createDataFrame([(1, "zeventy zeventy"), (2, "zeventy words")], "doc_id long, text string")
    plan = byte_bpe.encode(docs, ranks)._jdf.queryExecution().optimizedPlan()
    assert "zeventy" not in plan.toString().replace("zeventy zeventy", "").replace("zeventy words", "")
    assert plan.toString().count("scalar-subquery") == 1 and len(plan.output().mkString(",").split(",")) == 2
    assert not plan.children().head().output().mkString(",").count("frequent")


def test_a_word_is_a_text_of_its_pieces(spark, ranks, library):
    """One character a piece, in the order of ranks, also past the surrogates; the map of frequent words holds such texts."""
    from pyspark.sql import functions as F

    numbers = [0, 1, 93, 255, 50_000, 0xD7EF, 0xD7F0, 60_000, 200_000]
    held = spark.createDataFrame([(byte_bpe.char_of(n),) for n in numbers], "c string")
    assert [r[0] for r in held.orderBy("c").select(byte_bpe.rank_of(F.col("c"))).collect()] == numbers
    assert all(len(pair) == 2 for pair in ranks.joins()) and byte_bpe.NONE > max(ranks.joins().values())
    words = ["zeventy", " \x01\x02\x03", "\x00", "ééaupa", "aaaaaaa", " word"]
    docs = spark.createDataFrame([(1, words)], "doc_id long, words array<string>")
    rows = byte_bpe.frequent_words(docs, ranks).collect()
    assert {r.word: [ord(c) - byte_bpe.FIRST for c in r.text] for r in rows} == {w: library.encode_ordinary(w) for w in words}

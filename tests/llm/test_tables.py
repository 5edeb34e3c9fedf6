"""Operators over whole tables: fixity, decontamination, neighbours, near-duplicates, packing, the pipeline."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from tables import ODD_TEXTS, SF_DIR, no_docs, odd_docs
from tokenizers import Tokenizer

from curbflow.llm import ann_search, decontamination, near_dedup, packing, warc_fixity
from curbflow.llm.common import give_back, table
from curbflow.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_their_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings"):
        db.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    ours, theirs = QUERIES[name](spark, SF_DIR).toPandas(), db.execute(ORACLES[name]).df()
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    ours, theirs = (f[columns].astype(str).sort_values(columns).reset_index(drop=True) for f in (ours, theirs))
    assert ours.equals(theirs)


# ---- fixity ----


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_audit_locates_what_differs(spark):
    rows = [(i, f"http://x/{i}", f"<p>{'text ' * (i % 40)}{i}</p>") for i in range(400)] + [(None, None, None), (7, "http://x/7", "<p>other</p>")]
    rows += [(8, "http://x/8", "twice")] * 3
    changed = [(i, u, "#" + h[1:] if i == 33 else h) for i, u, h in rows if i not in (200, 399)] + [(400, "http://x/400", "new")]
    layouts = [warc_fixity.layout(pages(spark, r), 3) for r in (rows, changed)]
    found = warc_fixity.audit(*layouts, range_bytes=2000, fanout=2).collect()
    by_status = defaultdict(set)
    for r in found:
        by_status[r.status].add(r.page_id)
    assert by_status["altered"] == {33} and by_status["missing"] == {200, 399} and by_status["extra"] == {400}
    assert warc_fixity.audit(layouts[0], warc_fixity.layout(pages(spark, rows[::-1]), 3), range_bytes=2000, fanout=2).count() == 0
    # The same by comparing all records.
    old, new = ({(r.file, r.page_id, r.nth): r for r in layout.collect()} for layout in layouts)
    moved = {k for k in old.keys() & new.keys() if old[k].sha == new[k].sha and old[k].offset != new[k].offset}
    assert {(r.file, r.page_id, r.nth) for r in found if r.status == "moved"} == moved and moved


def test_audit_of_nothing(spark):
    empty = warc_fixity.layout(pages(spark, []), 1)
    one = warc_fixity.layout(pages(spark, [(1, "u", "h")]), 1)
    assert warc_fixity.audit(empty, empty).count() == 0
    assert [r.status for r in warc_fixity.audit(one, empty).collect()] == ["missing"]


def test_warc_files_hold_the_records_where_the_layout_says(spark, tmp_path):
    source = pages(spark, [(i, f"u{i}", f"é{'x' * i}") for i in range(30)])
    warc_fixity.write_warc(source, str(tmp_path / "warc"), 2)
    for r in warc_fixity.layout(source, 2).collect():
        (part,) = (tmp_path / "warc" / f"file={r.file}").glob("part-*")
        record = part.read_bytes()[r.offset : r.offset + r.length]
        assert hashlib.sha256(record).hexdigest() == r.sha


# ---- decontamination ----


def hits_by_brute_force(texts, items):
    cut = lambda t: __import__("re").findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    out = []
    for doc_id, text in texts:
        words, hit, names = cut(text), set(), set()
        for name, item in items:
            w = cut(item)
            n = min(13, len(w))
            for s in range(len(w) - n + 1 if n else 0):
                for at in range(len(words) - n + 1):
                    if words[at : at + n] == w[s : s + n]:
                        hit.update(range(at, at + n))
                        names.add(name)
        ids = sorted(str(n) for n in names if n is not None)
        sha = hashlib.sha256(",".join(ids).encode()).hexdigest()
        out.append((doc_id or -1, len(words), len(hit), len(ids), sha, bool(hit) and 20 * len(hit) >= len(words)))
    return sorted(out)


def test_decontamination_is_exact(spark):
    choose = random.Random(5)
    vocabulary = [f"w{i}" for i in range(6)]
    items = [(n, " ".join(choose.choices(vocabulary, k=k))) for n, k in enumerate((40, 20, 13, 14, 5, 3, 1, 2))]
    items += [(100, None), (101, ""), (101, "!!"), (0, items[0][1]), (None, "w9 w9 w8 w9 w8"), (102, items[0][1])]
    texts = [*ODD_TEXTS]
    for i in range(40):
        item = items[choose.randrange(4)][1].split()
        at = choose.randrange(len(item) - 12)
        span = item[at : at + choose.choice((12, 13, 15))]
        texts.append((50 + i, " ".join(["W7"] * choose.randrange(9) + [w.upper() for w in span] + ["w7"] * choose.randrange(300)) + "."))
    texts.append((99, "w9, w9 w8. w9 w8"))
    short = [t for t in texts if len(t[1] or "") < 5000]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = decontamination.contamination(odd_docs(spark, short), benchmark).collect()
    found = sorted((r.doc_id or -1, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows)
    assert found == hits_by_brute_force(short, items)
    assert decontamination.contamination(no_docs(spark), benchmark).count() == 0
    clean = decontamination.contamination(odd_docs(spark), benchmark.limit(0)).collect()
    assert len(clean) == len(ODD_TEXTS) and not any(r.contaminated or r.n_hit for r in clean)


# ---- neighbours ----


def test_neighbours_of_clustered_vectors(spark):
    random_ = np.random.default_rng(0)
    x = (random_.normal(size=(30, 24))[random_.integers(0, 30, 3000)] + 0.2 * random_.normal(size=(3000, 24))).astype(np.float32)
    x[100:160] = x[100]  # ties
    odd = [(9000, None), (9001, [0.0] * 24), (9020, [float("nan")] + [1.0] * 23), (9040, [1.0] * 3), (9060, [None] + [1.0] * 23), (None, [1.0] * 24)]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(0, x[0].tolist())] + odd
    vectors = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, floor string, list int")
    found = ann_search.neighbours(vectors).toPandas()
    asked = np.arange(0, 3000, 20)
    assert sorted(set(found.query_id)) == asked.tolist() and (found.groupby("query_id").size() == 20).all()
    score = x[asked].astype(float) @ x.T.astype(float)
    score[np.arange(len(asked)), asked] = -np.inf
    best = {q: np.lexsort((np.arange(3000), -s))[:20].tolist() for q, s in zip(asked.tolist(), score)}
    got = {q: g.sort_values("rank").vec_id.tolist() for q, g in found.groupby("query_id")}
    assert np.mean([len(set(got[q]) & set(best[q])) / 20 for q in got]) >= 0.9
    assert got[100][:5] == best[100][:5]
    exact = [float(x[q].astype(float) @ x[v].astype(float)) for q, v in zip(found.query_id, found.vec_id)]
    assert np.allclose(found.score, exact, rtol=0, atol=1e-12)
    assert all((g.sort_values("rank").score.diff().dropna() <= 0).all() for _, g in found.groupby("query_id"))


def test_queries_left_short_are_filled_up(spark, monkeypatch):
    """With a test that abandons nearly everything each query still has its 20 nearest."""
    monkeypatch.setattr(ann_search, "DOUBT", -3.0)
    random_ = np.random.default_rng(3)
    x = random_.normal(size=(400, 48)).astype(np.float32)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = ann_search.neighbours(vectors).toPandas()
    assert (found.groupby("query_id").size() == 20).all() and found.query_id.nunique() == 20
    score = x.astype(float) @ x.T.astype(float)
    np.fill_diagonal(score, -np.inf)
    got = {q: g.sort_values("rank").vec_id.tolist() for q, g in found.groupby("query_id")}
    assert np.mean([len(set(got[q]) & set(np.argsort(-score[q])[:20])) / 20 for q in got]) >= 0.9


def test_neighbours_of_few_vectors(spark):
    few = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(5)], "vec_id long, embedding array<float>")
    rows = ann_search.neighbours(few).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in rows] == [(0, 1, 1), (0, 2, 2), (0, 3, 3), (0, 4, 4)]
    assert ann_search.neighbours(few.limit(0)).count() == ann_search.neighbours(few.limit(1)).count() == 0


# ---- near-duplicates ----


def components_by_brute_force(texts):
    sets = defaultdict(list)
    for i, text in texts:
        w = (text or "").encode().lower().split()
        sets[i].append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    ids = [i for i in sets if i is not None]
    home = {i: i for i in ids}

    def root(i):
        while home[i] != i:
            i = home[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                u, v = sorted((root(a), root(b)))
                home[v] = u
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("small", [2, 32])
def test_near_duplicates_are_those_of_all_pairs(spark, monkeypatch, small):
    """With buckets listed as pairs, and with nearly all compared in blocks."""
    monkeypatch.setattr(near_dedup, "SMALL", small)
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    monkeypatch.setattr(near_dedup, "SETS", 4)
    monkeypatch.setattr(near_dedup, "STAR", 3)
    choose = random.Random(6)
    texts, n = [t for t in ODD_TEXTS if t[1] is not LONG_TEXT], 200
    for _ in range(8):  # groups that grow by copying any member with some words changed
        group = [[f"v{choose.randrange(5000)}" for _ in range(60)]]
        for _ in range(12):
            copy = list(choose.choice(group))
            for _ in range(choose.choice((0, 1, 1, 2))):
                copy[choose.randrange(60)] = f"v{choose.randrange(5000)}"
            group.append(copy)
        for words in group:
            texts.append((n, " ".join(words)))
            n += 1
    rows = near_dedup.near_duplicates(odd_docs(spark, texts)).collect()
    want = components_by_brute_force(texts)
    assert len(rows) == len(texts)
    assert {r.doc_id: r.component_id for r in rows if r.doc_id is not None} == want
    assert all(r.kept == (r.doc_id is None or want[r.doc_id] == r.doc_id) for r in rows)
    assert {r.n_shingles for r in rows if r.doc_id in (2, 3, 4)} == {0}


def test_near_duplicates_of_each_text_of_a_shared_id(spark):
    choose = random.Random(8)
    texts, near = [], lambda text: " ".join(["other", *text.split()[1:]])
    for n in range(0, 400, 20):
        a, b, c = (" ".join(f"s{choose.randrange(9000)}" for _ in range(60)) for _ in range(3))
        texts += [(n + 5, a), (n + 5, b), (n + 5, c), (n + 5, b), (n + 7, near(a)), (n + 8, near(b)), (n + 3, near(c)), (n + 9, c), (n + 9, None)]
        texts += [(n + 11, " ".join(c.split()[::-1]))]
    choose.shuffle(texts)
    rows = near_dedup.near_duplicates(odd_docs(spark, texts)).collect()
    want = components_by_brute_force(texts)
    assert len(rows) == len(texts) and {r.doc_id: r.component_id for r in rows} == want
    assert all(want[n + k] == n + 3 for n in range(0, 400, 20) for k in (3, 5, 7, 8, 9))


def test_a_shared_passage_links_only_what_is_similar(spark, monkeypatch):
    """A large group shares half of its words and is mostly not linked; some are near copies of others in it."""
    monkeypatch.setattr(near_dedup, "SMALL", 4)
    monkeypatch.setattr(near_dedup, "BLOCK", 32)
    monkeypatch.setattr(near_dedup, "SETS", 8)
    choose = random.Random(12)
    passage = [f"p{i}" for i in range(60)]
    texts = [(n, passage + [f"q{choose.randrange(10**6)}" for _ in range(choose.choice((25, 30, 60)))]) for n in range(150)]
    texts += [(n + 500, [*words[:-2], "end"]) for n, words in texts[::10]]
    texts = [(n, " ".join(words)) for n, words in texts] + [(n + 1000, " ".join(words)) for n, words in texts[:80:2]]
    rows = near_dedup.near_duplicates(odd_docs(spark, texts)).collect()
    assert {r.doc_id: r.component_id for r in rows} == components_by_brute_force(texts)
    # By text: ids play no part but to choose which one stays.
    gone = {(r.doc_id, r.version) for r in near_dedup.other_texts(odd_docs(spark, texts)).collect()}
    assert {i for i, _ in gone} == {r.doc_id for r in rows if not r.kept}


LONG_TEXT = ODD_TEXTS[8][1]


def test_near_duplicates_of_nothing(spark):
    assert near_dedup.near_duplicates(no_docs(spark)).count() == 0
    assert near_dedup.near_duplicates(odd_docs(spark)).count() == len(ODD_TEXTS)


def test_pruning_keeps_what_may_be_a_link():
    for slots, enough in near_dedup.least_matches(240, 0.75):
        below = sum(__import__("math").comb(slots, k) * 0.75**k * 0.25 ** (slots - k) for k in range(enough))
        assert below < 1e-5


# ---- packing ----


def test_packed_pieces_are_those_of_the_library(spark):
    library = Tokenizer.from_file(packing.word_vocabulary())
    texts = [*ODD_TEXTS, (70, "it's <|endoftext|> 'S ÀÉÎ 12"), (71, "x" * 9000), (72, "ΣΑΣ İ é")]
    rows = packing.packed_documents(odd_docs(spark, texts), packing.word_vocabulary(), capacity=64).collect()
    want = []
    for i, text in texts:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(i or -1, p, s, len(ids[s : s + 64]), zlib.crc32(ids[s : s + 64].tobytes())) for p, s in enumerate(range(0, len(ids), 64))]
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    check_places(rows, 64)
    assert packing.packed_documents(no_docs(spark), packing.word_vocabulary()).count() == 0


def check_places(rows, capacity):
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(held)


def test_plans_use_every_piece_and_few_sequences():
    random_ = np.random.default_rng(7)
    for capacity, high in ((50, 50), (50, 20), (2048, 900), (2048, 2048), (7, 7)):
        counts = np.bincount(random_.integers(1, high + 1, 4000), minlength=capacity + 1)
        plan = packing.packing_plan(counts, capacity)
        used = np.zeros(capacity + 1, int)
        for lengths, times in plan:
            assert sum(lengths) <= capacity and times > 0
            np.add.at(used, list(lengths), times)
        assert (used == counts).all()
        bound = -(-(counts * np.arange(capacity + 1)).sum() // capacity)
        # No plan can put two lengths over half into one sequence.
        bound = max(bound, counts[capacity // 2 + 1 :].sum())
        assert sum(times for _, times in plan) <= 1.02 * bound + 1
    assert packing.packing_plan(np.zeros(8, int), 7) == []


def test_pieces_of_one_length_are_dealt_to_many_buckets(spark):
    """Nearly all pieces have one length, and most rows are equal, keys and all."""
    texts = [(None if i % 2 else 7, "same words here") for i in range(900)] + [(i, "other words " * (i % 9)) for i in range(60)]
    pieces = packing.token_pieces(odd_docs(spark, texts).repartition(4), packing.word_vocabulary(), 16)
    rows = packing.pack(pieces, 16, per_bucket=50).collect()
    assert len(rows) == pieces.count()
    assert sorted((r.doc_id or -1, r.piece, r.length) for r in rows) == sorted((r.doc_id or -1, r.piece, r.length) for r in pieces.collect())
    assert check_places(rows, 16) <= 1.02 * sum(r.length for r in rows) / 16 + 1


def test_plans_of_few_pieces_are_as_short_as_can_be():
    """Against the best of all ways to put the pieces together."""
    random_ = np.random.default_rng(11)

    def fewest(lengths, capacity):
        best = [len(lengths)]

        def put(i, gaps):
            if len(gaps) >= best[0]:
                return
            if i == len(lengths):
                best[0] = len(gaps)
                return
            for g in {gap for gap in gaps if gap >= lengths[i]}:
                rest = list(gaps)
                rest[rest.index(g)] -= lengths[i]
                put(i + 1, rest)
            put(i + 1, [*gaps, capacity - lengths[i]])

        put(0, [])
        return best[0]

    over = 0
    for _ in range(60):
        lengths = sorted(random_.integers(1, 11, random_.integers(1, 9)).tolist(), reverse=True)
        plan = packing.packing_plan(np.bincount(lengths, minlength=11), 10)
        over += sum(times for _, times in plan) - fewest(lengths, 10)
        assert sum(times for _, times in plan) <= fewest(lengths, 10) + 1
    assert over <= 4


# ---- pipeline ----


def test_pipeline_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = table(spark, SF_DIR, "documents")
    columns, counts = docs.columns, [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / str(k)))
        after = spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert after.columns == columns and after.join(docs, "doc_id", "left_anti").count() == 0, name
            counts.append(after.count())
        if name == "near dedup":
            want = components_by_brute_force([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
            assert {r.doc_id for r in after.select("doc_id").collect()} == {i for i, c in want.items() if i == c}
        if name == "decontamination":
            items = [tuple(r) for r in table(spark, SF_DIR, "benchmark").select("item_id", "text").collect()]
            rows = decontamination.contamination(docs, table(spark, SF_DIR, "benchmark")).where("contaminated")
            assert after.count() == docs.count() - rows.count() and items
        docs = after
    assert counts[0] > counts[1] >= counts[2] > counts[3] >= counts[4] > 0
    assert docs.where("piece = 0").count() == counts[4]
    assert corpus_pipeline.run(spark, SF_DIR).count() == docs.count()


def test_stages_bear_odd_rows(spark):
    docs = odd_docs(spark)
    for name, stage in corpus_pipeline.STAGES:
        if name == "quality classifier":
            continue  # needs labels of these documents; its rows are tested with the classifier
        assert stage(spark, docs, SF_DIR).count() >= 0
        assert stage(spark, no_docs(spark), SF_DIR).count() == 0
    once = corpus_pipeline.one_of_each(spark, docs, SF_DIR)
    assert once.where("doc_id = 1").count() == 2 and once.where("doc_id is null").count() == 2


def test_freed_memory_goes_back_to_the_system():
    """A block that stays above freed ones keeps them in the process until they are given back."""
    def resident() -> float:
        with open("/proc/self/statm") as file:
            return int(file.read().split()[1]) * 4096 / 1e6

    blocks = [bytearray(b"x") * 100_000 for _ in range(2_000)]
    last = blocks[-1]
    del blocks
    held = resident()
    give_back()
    assert last and held - resident() > 100

"""Operators that look at one text at a time: language, licences, quality, toxicity, token counts."""

from __future__ import annotations

import random
import textwrap

import numpy as np
import pytest
from tables import ODD_TEXTS, SF_DIR, labels, no_docs, odd_docs
from tokenizers import Tokenizer

from curbflow.llm import language_id, license_scan, quality_rules, token_counts, toxicity
from curbflow.llm.common import table


def area(score, truth):
    """Area under the ROC curve."""
    place = np.argsort(np.argsort(score)) + 1
    ones = truth.sum()
    return (place[truth == 1].sum() - ones * (ones + 1) / 2) / ones / (len(truth) - ones)


@pytest.fixture(scope="module")
def counter():
    return token_counts.counter(token_counts.byte_level_vocabulary())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(token_counts.byte_level_vocabulary())


def test_token_counts_are_those_of_the_library(counter, library):
    choose = random.Random(4)
    letters = [chr(c) for c in (*range(400), 0x301, 0x2028, 0x3000, 0x200B, 0x1C, 0x85, 0xFEFF, 0x4E2D, 0x1F600, 0x2160, 0x661)]
    pools = [letters, letters[:256], list("ab '\n\t sdre1<|")]
    texts = ["".join(choose.choices(choose.choice(pools), k=choose.randint(0, 40))) for _ in range(1500)]
    texts += ["", "a" * 5000, "aaa" * 7, "<|endoftext|>x<|endoftext|><|endoftext|>", "it's we'll 'sx", "x <|endoftext"]
    assert counter(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_token_counts_of_odd_rows(spark, library):
    rows = token_counts.token_counts(odd_docs(spark), token_counts.byte_level_vocabulary(), limit=3).collect()
    assert len(rows) == len(ODD_TEXTS)
    want = sorted((i or -1, len((t or "").encode()), len(library.encode(t or "").ids)) for i, t in ODD_TEXTS)
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in rows) == want
    assert all(r.over_limit == (r.n_tokens > 3) for r in rows)
    assert token_counts.token_counts(no_docs(spark), token_counts.byte_level_vocabulary()).count() == 0


def test_language_of_held_out_documents(spark):
    docs = table(spark, SF_DIR, "documents")
    found = language_id.language_of_documents(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_language_of_unseen_words_comes_from_their_letters():
    model = language_id.LanguageModel.of_counts(
        ["de", "en"], {"the": [0, 9], "der": [9, 0]}, {"sch": [5, 0], "ing": [0, 5], "s": [3, 3], "i": [3, 3]}
    )
    predict = model.predictor()
    assert predict("The")[0] == "en" and predict("schsch")[0] == "de" and predict("inging")[0] == "en"
    assert predict("123 !")[0] == predict("")[0] == "und"


def test_language_of_odd_rows(spark):
    docs = odd_docs(spark)
    rows = language_id.language_of_documents(docs).collect()
    assert len(rows) == len(ODD_TEXTS)
    assert all(r.lang_pred == "und" for r in rows if r.doc_id in (2, 3, 4, 5))
    assert language_id.language_of_documents(no_docs(spark)).count() == 0
    model = language_id.LanguageModel.of_counts(["en"], {"the": [3]}, {"t": [1]})
    kept = language_id.known_rows(docs, model)
    assert kept.columns == docs.columns and kept.where("doc_id in (2, 3, 4, 5)").count() == 0 and kept.where("doc_id = 1").count() == 3


def test_license_blocks_and_differences(spark):
    text = "Lorem ipsum.\nReleased under the MIT License.\nMore text. Licensed under the Apache License, Version 1.1."
    scanner = license_scan.Scanner()
    first, second = scanner.scan(text)
    assert (first["license"], first["confirmed"], first["differences"]) == ("MIT", True, [])
    assert text[first["start"] : first["end"]] == "Released under the MIT License."
    assert (second["license"], second["confirmed"], second["differences"]) == ("Apache-2.0", False, ["-2.0", "+1.1"])
    whole = license_scan.TEMPLATES["MIT notice"]
    assert scanner.winner(whole)["license"] == "MIT notice" and scanner.winner(whole)["missing"] == 0


def test_license_winner_is_that_of_all_templates():
    """Comparing the best few by compression finds what word differences over all templates find."""
    scanner = license_scan.Scanner()
    for name, text in license_scan.TEMPLATES.items():
        block = text.replace(",", "").replace("the", "this", 1)
        diffs = {n: sum(license_scan.differences(license_scan.words(block), scanner.words[n])[:2]) for n in scanner.words}
        assert diffs[scanner.winner(block)["license"]] == min(diffs.values()), name


@pytest.mark.parametrize("mark", ["", "# ", " * "])
def test_wrapped_licenses_are_told(mark):
    scanner = license_scan.Scanner()
    for name in ("MIT notice", "GPL-3.0 notice", "Apache-2.0 notice"):
        lines = textwrap.wrap(license_scan.TEMPLATES[name], 68)
        text = "Some prose.\n\n" + "\n".join(mark + line for line in lines) + "\n\nMore prose."
        (row,) = scanner.scan(text)
        assert (row["license"], row["confirmed"], row["differences"]) == (name, True, []), name
        assert text[row["start"] : row["end"]].split()[-1] == lines[-1].split()[-1]


def test_all_licenses_of_a_stretch_are_told():
    scanner = license_scan.Scanner()
    told = lambda text: [(r["license"], r["confirmed"]) for r in scanner.scan(text)]
    assert told("Released under the MIT License. Licensed under CC BY 4.0.") == [("MIT", True), ("CC-BY-4.0", True)]
    names = ["CC-BY-SA-4.0", "MIT", "GPL-3.0 notice", "MPL-2.0", "MIT notice", "MIT", "Proprietary"]
    assert told(" ".join(license_scan.TEMPLATES[name] for name in names)) == [(name, True) for name in names]
    assert told("Licensed under CC BY 4.0.\n" * 500) == [("CC-BY-4.0", True)] * 500


def test_only_the_wording_of_a_license_is_confirmed():
    scanner = license_scan.Scanner()
    told = lambda text: [(r["license"], r["confirmed"]) for r in scanner.scan(text)]
    for name in ("GPL-1.0", "AGPL-3.0", "LGPL-2.1", "GPL-3.0-or-later", "MPL-1.1", "AGPL-3.0 notice", "GPL-2.0 notice"):
        assert told(license_scan.TEMPLATES[name]) == [(name, True)]
    work = "This work is licensed under the GNU General Public License, version"
    for text in (f"{work} 4.", "Licensed under CC BY 3.0.", "Licensed under the Apache License, Version 1.0.", work.replace("GNU", "XYZ") + " 2."):
        assert told(text) and not any(confirmed for _, confirmed in told(text)), text
    assert told("This file is licensed under the GNU General Public License, version 2.") == [("GPL-2.0", True)]
    no_fee = license_scan.TEMPLATES["MIT notice"].replace("free of charge", "for a fee")
    assert told(no_fee) == [("MIT notice", False)]
    assert ("MIT notice", True) not in told(license_scan.TEMPLATES["MIT notice"].split("THE SOFTWARE IS PROVIDED")[0])


@pytest.mark.parametrize("mark", ["", "# "])
def test_whole_licenses_are_told(mark):
    scanner = license_scan.Scanner()
    for name in ("BSD-2-Clause text", "BSD-3-Clause text", "ISC text", "MPL-2.0 text", "GPL-3 text"):
        text = license_scan.WHOLE[name]
        found = scanner.scan("Some prose.\n\n" + "".join(mark + line for line in text.splitlines(True)))
        assert [(r["license"], r["differences"]) for r in found if r["confirmed"]] == [(name, [])]
    three = license_scan.WHOLE["BSD-3-Clause text"].replace("the copyright holder nor", "the University nor").replace("Redistributions", "1. Redistributions", 1)
    assert [(r["license"], r["confirmed"]) for r in scanner.scan(three)] == [("BSD-3-Clause text", True)]
    assert not any(r["confirmed"] for r in scanner.scan(three.replace("without specific", "with or without")))


def test_licenses_of_odd_rows(spark):
    assert license_scan.licenses(odd_docs(spark)).count() == license_scan.licenses(no_docs(spark)).count() == 0
    twice = odd_docs(spark, [(1, "Licensed under CC BY-NC 4.0."), (1, "Licensed under CC BY-NC 4.0."), (None, "MIT License?")])
    rows = license_scan.licenses(twice).collect()
    assert [r.license for r in rows if r.doc_id == 1] == ["CC-BY-NC-4.0"] * 2 and len(rows) == 3


def test_quality_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs, known = table(spark, folder, "documents"), table(spark, folder, "labels")
    found = quality_rules.quality_of_documents(docs, known).join(known, "doc_id").where("held_out").toPandas()
    assert area(found.score.to_numpy(), found.quality.to_numpy()) > 0.97


def test_rules_are_the_same_as_columns(spark):
    random_ = np.random.default_rng(1)
    x = random_.random((800, len(quality_rules.STATISTICS))).round(2)
    y = ((x[:, 0] > 0.5) & (x[:, 3] <= 0.7)).astype(int)
    model = quality_rules.fit(x, y)
    assert area(model.scores(x), y) > 0.99
    assert 0 < len(model.rules) < 400
    rows = spark.createDataFrame([tuple(r) for r in x.tolist()], quality_rules.SCHEMA)
    assert np.allclose([r[0] for r in rows.select(model.column()).collect()], model.scores(x))


@pytest.mark.parametrize("rule", [quality_rules, toxicity])
def test_scores_of_odd_rows(spark, rule):
    docs = odd_docs(spark)
    column, run = ("quality", quality_rules.quality_of_documents) if rule is quality_rules else ("toxic", toxicity.toxicity_of_documents)
    known = labels(spark, docs, column)
    rows = run(docs, known).collect()
    assert len(rows) == len(ODD_TEXTS)
    limit = 0.3 if rule is quality_rules else 0.5
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= limit) for r in rows)
    assert run(no_docs(spark), known).count() == 0
    assert run(docs, known.limit(0)).count() == len(ODD_TEXTS)
    if rule is quality_rules:
        assert quality_rules.good_rows(docs, quality_rules.RuleEnsemble([], 9.0)).columns == docs.columns


def test_toxicity_knows_misspellings():
    cut, choose = toxicity.word_cutter(), random.Random(2)
    plain = [f"{a}{b}" for a in ("tion", "ent", "hou", "ere") for b in ("ing", "ed", "th", "ea", "or")]
    texts = [" ".join(choose.choices(plain, k=60)) for _ in range(600)]
    truth = np.arange(600) % 2
    texts = [t + (" stupid idiot" if y else "") for t, y in zip(texts, truth)]
    odds, bias = toxicity.fit([toxicity.bag(t, cut) for t in texts], truth, rounds=40)
    score = toxicity.scorer(odds, bias)
    new = [" ".join(choose.choices(plain, k=60)) for _ in range(40)]
    clean, toxic, odd = score(new), score([t + " stupid idiot" for t in new]), score([t + " stupidd idiott" for t in new])
    assert (toxic > 0.5).mean() > 0.95 and (clean < 0.5).mean() > 0.95 and odd.mean() > clean.mean() + 0.2


def test_license_scan_of_a_table_is_that_of_plain_ranking(spark):
    """Templates ranked by how much they compress the text, the first whose words stand in it one after another."""
    import zstandard

    templates = {**license_scan.TEMPLATES, **{n: t for n, t in license_scan.WHOLE.items() if len(t) < 4000}}
    around = ("Some words before it.\n\n", "\n\nAnd some more words after it, as ever.")
    texts = [(i, around[0] + " ".join(t.split()) + around[1]) for i, t in enumerate(templates.values())]

    def plain(text):
        own = f" {' '.join(license_scan.words(text))} "
        size = lambda d: len(zstandard.ZstdCompressor(level=license_scan.LEVEL, **d).compress(text.encode()))
        given = {n: size({"dict_data": zstandard.ZstdCompressionDict(t.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)}) for n, t in templates.items()}
        return next(n for n in sorted(templates, key=lambda n: (given[n], n)) if f" {' '.join(license_scan.words(templates[n]))} " in own)

    rows = license_scan.licenses(odd_docs(spark, texts), templates).where("confirmed").collect()
    found = {i: [r.license for r in rows if r.doc_id == i] for i, _ in texts}
    for i, text in texts:
        assert plain(text) in found[i], (list(templates)[i], found[i])


def test_reduction_decides_among_confirmed_templates():
    """Both templates stand in the text; the one that compresses it better wins, whatever their names and order."""
    short, long = "Licensed under the Foo License.", "Licensed under the Foo License. No warranty of any kind is given with it."
    text = f"Words before.\n\n{long}\n\nWords after."
    for names in (("a", "b"), ("b", "a")):
        (row,) = [r for r in license_scan.Scanner({names[0]: short, names[1]: long}).scan(text) if r["confirmed"]]
        assert row["license"] == names[1]
    scanner = license_scan.Scanner({"a": short, "b": long})
    scanner.reductions = lambda block, templates: sorted(((0.0, n) for n in templates), key=lambda r: r[1])
    assert scanner.scan(text)[0]["license"] == "a"


def test_long_runs_of_marks_are_read_once():
    import time

    started = time.perf_counter()
    assert license_scan.words("-" * 1_000_000 + " a--b " + "./" * 500_000) == ["a--b"]
    assert license_scan.Scanner().scan("All rights reserved. " + "-" * 1_000_000)[0]["license"] == "Proprietary"
    assert time.perf_counter() - started < 10


def test_language_is_that_of_a_plain_back_off(spark):
    docs = table(spark, SF_DIR, "documents").select("doc_id", "lang", "text")
    model = language_id.train(docs.select("lang", "text"))
    # Counts anew, in plain Python.
    import regex
    from collections import Counter

    rows = [(r.lang, regex.findall(r"\p{L}+", r.text.lower())) for r in docs.where("lang is not null and text is not null").collect()]
    words, grams = Counter(), Counter()
    for lang, found in rows:
        for word in found:
            words[word, lang] += 1
            marked = f"<{word}>"
            for size in range(1, 6):
                for at in range(len(marked) - size + 1):
                    grams[marked[at : at + size], lang] += 1
    languages = sorted({lang for lang, _ in rows})
    total = lambda counts: Counter({k: sum(counts[k, lang] for lang in languages) for k in {k for k, _ in counts}})
    known = {k for k, n in total(words).items() if n >= 2}, {k for k, n in total(grams).items() if n >= 3}
    assert model.languages == languages and set(model.words) == known[0] and set(model.grams) == known[1]

    def log(item, counts, group):
        return [np.log((counts[item, lang] + 0.5) / (sum(counts[k, lang] for k in group) + 0.5 * len(group))) for lang in languages]

    by_size = {n: [g for g in known[1] if len(g) == n] for n in range(1, 6)}
    sums = {n: [sum(grams[g, lang] for g in group) for lang in languages] for n, group in by_size.items()}
    word_sums = [sum(words[w, lang] for w in known[0]) for lang in languages]

    def score(word):
        if word in known[0]:
            logs = np.array([np.log((words[word, lang] + 0.5) / (t + 0.5 * len(known[0]))) for lang, t in zip(languages, word_sums)])
        else:
            logs, marked, at = np.zeros(len(languages)), f"<{word}>", 0
            while at < len(marked):
                size = next((n for n in range(min(5, len(marked) - at), 0, -1) if marked[at : at + n] in known[1]), 1)
                gram = marked[at : at + size]
                if gram in known[1]:
                    logs = logs + [np.log((grams[gram, lang] + 0.5) / (t + 0.5 * len(by_size[size]))) for lang, t in zip(languages, sums[size])]
                at += size
        return np.maximum(logs - logs.max(), language_id.WORST)

    texts = [r for r in docs.limit(25).collect()] + [type("R", (), {"doc_id": -1 - i, "text": t}) for i, t in enumerate(("zzyx qu", "", "12 !!", "schxyz der unseenwörd"))]
    found = {r.doc_id: r for r in language_id.identify(spark.createDataFrame([(r.doc_id, r.text) for r in texts], "doc_id long, text string"), model).collect()}
    for r in texts:
        own = regex.findall(r"\p{L}+", (r.text or "").lower())
        if not own:
            assert (found[r.doc_id].lang_pred, found[r.doc_id].score) == ("und", 0.0)
            continue
        logs = sum(score(w) for w in own) * min(1.0, language_id.EVIDENCE / len(own))
        share = np.exp(logs - logs.max())
        assert found[r.doc_id].lang_pred == languages[int(share.argmax())]
        assert found[r.doc_id].score == pytest.approx(share.max() / share.sum(), abs=1e-4)


def test_remembered_scores_start_anew_and_change_nothing():
    model = language_id.LanguageModel.of_counts(["de", "en"], {"the": [0, 9], "der": [9, 0]}, {"sch": [5, 0], "ing": [0, 5], "s": [3, 3], "i": [3, 3]})
    texts = [f"the word{i} der schs{i} ing" for i in range(300)] + ["der der", None, ""]
    import pyarrow as pa

    batches = [pa.RecordBatch.from_pydict({"text": pa.array(texts[at : at + 50], pa.string())}) for at in range(0, len(texts), 50)]
    small, large = model.batch_predictor(remembered=1000), model.batch_predictor()
    for batch in batches:
        (a, x), (b, y) = small(batch), large(batch)
        assert a == b and np.allclose(x, y, atol=1e-6)


@pytest.mark.parametrize("n", [68, 300])
def test_quality_rules_of_a_small_sample(n):
    random_ = np.random.default_rng(1)
    x = random_.normal(size=(n, len(quality_rules.STATISTICS)))
    y = (x[:, 3] > 0.8).astype(int)
    model = quality_rules.fit(x, y)
    assert model.rules and area(model.scores(x), y) > 0.9

"""Benchmark decontamination by winnowing, in DataFrame functions only.

A window is ``WINDOW`` consecutive words of a benchmark item, or all of a
shorter item. Of every window's worth of k-grams the least hash is kept, in
documents and in items. Equal windows keep equal hashes, so a join of what is
kept finds every shared window; each hit is then extended word by word to the
windows around it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from curbflow.llm.common import sent_if_small
from curbflow.session import cut_lineage

WINDOW, GRAM = 13, 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS), "")


def with_grams(df: DataFrame, sizes: set[int]) -> DataFrame:
    """Add gram_k, the hashes of all k consecutive words, for each size k, to rows with words and word_hash."""
    for k in sorted(sizes):
        grams = F.transform(
            F.sequence(F.lit(0), F.size("words") - k),
            lambda i: F.xxhash64(F.lit(k), *(F.col("word_hash")[i + j] for j in range(k))),
        )
        df = df.withColumn(f"gram_{k}", F.when(F.size("words") >= k, grams).otherwise(F.array().cast("array<bigint>")))
    return df


def with_least(df: DataFrame, gram: str, width: int, name: str) -> DataFrame:
    """Add ``name``, the least of every ``width`` consecutive entries of ``gram`` (of fewer at the end), by doubling."""
    def joined(df: DataFrame, source: str, step: int) -> DataFrame:
        later = F.slice(F.col(source), F.lit(step + 1), F.size(source))
        return df.withColumn(name, F.zip_with(F.col(source), later, lambda a, b: F.least(a, b)))

    df, done = df.withColumn(name, F.col(gram)), 1
    while 2 * done <= width:
        df, done = joined(df, name, done), 2 * done
    return joined(df, name, width - done) if done < width else df


def shapes(lengths: list[int]) -> list[tuple[int, int, int]]:
    """(window, k, grams per window) of each window length."""
    return [(n, min(GRAM, n), n - min(GRAM, n) + 1) for n in lengths]


def kept(df: DataFrame, lengths: list[int]) -> DataFrame:
    """Add kept, the distinct hashes that winnowing keeps for windows of these lengths."""
    df = with_grams(df, {k for _, k, _ in shapes(lengths)})
    for n, k, width in shapes(lengths):
        df = with_least(df, f"gram_{k}", width, f"least_{n}")
    return df.withColumn("kept", F.array_distinct(F.concat(*(f"least_{n}" for n in lengths))))


def with_words(df: DataFrame) -> DataFrame:
    return df.withColumn("words", words(F.col("text"))).withColumn("word_hash", F.transform("words", lambda w: F.xxhash64(w)))


def places(k: int) -> Column:
    """Places of the k-grams whose hash is in kept, each with the words around: up to WINDOW - 1 before, WINDOW from there on."""
    gram = F.col(f"gram_{k}")
    chosen = F.filter(F.sequence(F.lit(0), F.size(gram) - 1), lambda i: F.array_contains("kept", gram[i]))
    around = F.transform(
        chosen,
        lambda i: F.struct(
            i.alias("place"), gram[i].alias("hash"), F.least(i, F.lit(WINDOW - 1)).alias("before"),
            F.slice("words", F.greatest(i - (WINDOW - 1), F.lit(0)) + 1, F.lit(2 * WINDOW - 1)).alias("around"),
        ),
    )
    return F.when(F.size(gram) > 0, around)


def item_places(items: DataFrame, lengths: list[int]) -> DataFrame:
    """Winnowed k-grams of the items: window, grams, hash, item_id, before, around."""
    parts = []
    for n, k, width in shapes(lengths):
        own = kept(items.where(F.least(F.size("words"), F.lit(WINDOW)) == n), [n])
        parts.append(
            own.select("item_id", F.explode(places(k)).alias("p")).select(
                F.lit(n).alias("window"), F.lit(width).alias("width"), F.col("p.hash").alias("hash"), "item_id",
                F.col("p.before").alias("item_before"), F.col("p.around").alias("item_around"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def contamination(docs: DataFrame, benchmark: DataFrame, **names: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    n_hit counts the words inside any window that an item has too, n_items the items with such windows;
    contaminated is n_hit > 0 and 20 * n_hit >= n_words. Null and wordless texts and items have no windows.
    Repeated rows give repeated rows, rows with the same key and different texts are told apart, a null key
    stays null; an item without id hits words and isn't counted. Empty tables give no rows or no hits.
    Other columns are ignored, whatever their names. ``names`` are those of ``judged``.
    """
    return judged(docs, benchmark, **names).drop("version")


def judged(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """As ``contamination``, with version, a hash of the text that tells rows of one key apart."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("version"), F.col(text).alias("text"))
    items = cut_lineage(
        with_words(benchmark.select(F.col(item).cast("string").alias("item_id"), F.col(item_text).alias("text")))
        .where(F.size("words") > 0).select("item_id", "words", "word_hash").distinct()
    )
    lengths = sorted(r[0] for r in items.select(F.least(F.size("words"), F.lit(WINDOW))).distinct().collect())
    if not lengths:
        counted = rows.select("doc_id", "version", F.size(words(F.col("text"))).cast("long").alias("n_words"))
        return verdict(counted.withColumns({"n_hit": F.lit(0), "n_items": F.lit(0), "item_ids": F.array().cast("array<string>")}))
    wanted = cut_lineage(item_places(items, lengths))
    wanted_hashes = sent_if_small(cut_lineage(wanted.select("hash").distinct()))

    winnowed = cut_lineage(kept(with_words(rows), lengths).select("doc_id", "version", F.size("words").cast("long").alias("n_words"), "kept"))
    candidates = cut_lineage(
        winnowed.select("doc_id", "version", F.explode("kept").alias("hash")).join(wanted_hashes, "hash", "left_semi")
        .groupBy("doc_id", "version").agg(F.collect_set("hash").alias("kept"))
    )
    named = sent_if_small(candidates.select(F.col("doc_id").alias("c_doc_id"), F.col("version").alias("c_version"), "kept"))
    same = F.col("doc_id").eqNullSafe(F.col("c_doc_id")) & (F.col("version") == F.col("c_version"))
    grams = sorted({k for _, k, _ in shapes(lengths)})
    found = with_grams(with_words(rows.join(named, same)), set(grams))
    found = found.select("doc_id", "version", F.explode(F.concat(*(F.coalesce(places(k), F.array()) for k in grams))).alias("p")).select("doc_id", "version", "p.*")
    start = lambda s: (F.col("before") + s, F.col("item_before") + s)

    def agrees(s: Column) -> Column:
        mine, its = start(s)
        inside = (mine >= 0) & (its >= 0) & (mine + F.col("window") <= F.size("around")) & (its + F.col("window") <= F.size("item_around"))
        part = lambda of, at: F.slice(of, F.greatest(at, F.lit(0)) + 1, F.col("window"))
        return inside & (part("around", mine) == part("item_around", its))

    hits = (
        found.join(sent_if_small(wanted), "hash")
        .withColumn("starts", F.filter(F.sequence(1 - F.col("width"), F.lit(0)), agrees))
        .where(F.size("starts") > 0)
        .select(
            "doc_id", "version", "item_id",
            (F.col("place") + F.array_min("starts")).alias("low"), (F.col("place") + F.array_max("starts") + F.col("window")).alias("high"),
        )
        .distinct()
    )
    hits = cut_lineage(hits)
    # Of stretches with the same start the longest covers the others; each adds what lies beyond all before it.
    stretches = hits.groupBy("doc_id", "version", "low").agg(F.max("high").alias("high"))
    earlier = Window.partitionBy("doc_id", "version").orderBy("low").rowsBetween(Window.unboundedPreceding, -1)
    covered = (
        stretches.withColumn("reached", F.coalesce(F.max("high").over(earlier), F.lit(0)))
        .groupBy("doc_id", "version").agg(F.sum(F.greatest(F.lit(0), F.col("high") - F.greatest("low", "reached"))).alias("n_hit"))
    )
    by_item = hits.groupBy("doc_id", "version").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    counted = (
        winnowed.select("doc_id", "version", "n_words").alias("d")
        .join(covered.alias("c"), F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & F.col("d.version").eqNullSafe(F.col("c.version")), "left")
        .join(by_item.alias("i"), F.col("d.doc_id").eqNullSafe(F.col("i.doc_id")) & F.col("d.version").eqNullSafe(F.col("i.version")), "left")
        .select("d.doc_id", "d.version", "d.n_words", "c.n_hit", "i.item_ids")
    )
    return verdict(counted.withColumn("n_items", F.size(F.coalesce("item_ids", F.array()))))


def verdict(counted: DataFrame) -> DataFrame:
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return counted.select(
        "doc_id", "version", "n_words", n_hit.alias("n_hit"), F.col("n_items").cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("item_ids", ","), F.lit("")), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


ORACLE = rf"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), b as (
  select cast(item_id as varchar) as item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
), bw as (
  select item_id, t, array_to_string(w[s : s + t - 1], ' ') as part
  from (select item_id, w, least(len(w), {WINDOW}) as t, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) as s from b where len(w) > 0)
), dw as (
  select doc_id, s, t, array_to_string(w[s : s + t - 1], ' ') as part
  from (select doc_id, w, t, unnest(range(1, len(w) - t + 2)) as s from d, (select distinct t from bw) where len(w) >= t)
), hit as (
  select distinct doc_id, s, dw.t, item_id from dw join bw on dw.t = bw.t and dw.part = bw.part
), n as (
  select doc_id, count(distinct place) as n_hit from (select doc_id, unnest(range(s, s + t)) as place from (select distinct doc_id, s, t from hit)) group by doc_id
), i as (
  select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids from (select distinct doc_id, item_id from hit) group by doc_id
)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join n on d.doc_id = n.doc_id left join i on d.doc_id = i.doc_id
"""

"""Near-duplicates by MinHash with sequential Bayesian verification.

Documents with the same set of shingles are one set with a number; a document with
several texts has several sets, which are linked. Bands of the
MinHash signature name candidates; a candidate's signature is compared batch by
batch and the pair is dropped as soon as the posterior probability of enough
similarity falls below ``MISS``; survivors are confirmed on their full sets.

Only the links that join components matter, so candidates of a band bucket are
not all paired. First every member meets the hubs of some of its buckets and is
held against the likeliest. Then what is still apart from the largest component
of a bucket meets the members of other components: in small buckets as pairs,
in large ones block by block within a task. There the signatures go first, in
large blocks; they name the members of smaller blocks that may be linked, and
only their sets follow. That reaches the components of all candidate links.

A group of n members of which m are still apart sends each signature once per
BLOCK of the other side, n * m / BLOCK rows; the comparisons are n * m.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from curbflow.llm.common import SENT_BYTES, bytes_of, keyed_texts, map_arrow, sent_if_small, table_bytes, written

SHINGLE = 5
BANDS, ROWS = 48, 5
# Bands whose hubs a member is held against; most members find a link there.
HUB_BANDS = 12
# Members up to which a bucket's pairs are listed; signatures of larger ones are compared in blocks of BLOCK members,
# and sets in blocks of SETS members.
SMALL, BLOCK, SETS = 32, 2048, 256
# Pairs with one hub that are confirmed by one task.
STAR = 512
# Files that a small table is written to.
FEW_FILES = 8
# A pair is linked if SHARE[1] * |intersection| >= SHARE[0] * |union|.
SHARE = (75, 100)
# Slots compared at a time, and the posterior probability of a link below which a pair is dropped.
BATCH, MISS = 24, 1e-6

U = np.uint64


def random_odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * U(2) + U(1)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


class Shingler:
    """Distinct hashes of the word shingles of texts, worked out on the bytes of many texts at once."""

    def __init__(self, size: int = SHINGLE):
        self.size = size
        self.of_byte = random_odd(256, 1)
        self.of_byte[ord("A") : ord("Z") + 1] = self.of_byte[ord("a") : ord("z") + 1]
        self.space = np.zeros(256, bool)
        self.space[[0x20, *range(0x09, 0x0E)]] = True
        self.of_byte[self.space] = 0
        self.base = random_odd(1, 2)[0]
        self.places = random_odd(size, 3)

    def word_hashes(self, flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each word, and how many words each text has."""
        if not len(flat):
            return np.zeros(0, U), np.zeros(len(offsets) - 1, np.int64)
        space = self.space[flat]
        before = np.r_[True, space[:-1]]
        before[offsets[:-1][offsets[:-1] < len(flat)]] = True
        starts = np.flatnonzero(before & ~space)
        counts = np.diff(np.searchsorted(starts, offsets))
        if not len(starts):
            return np.zeros(0, U), counts
        # A word's hash is a polynomial of its bytes in the place within the word; spaces count 0.
        place = np.arange(starts[0], len(flat)) - np.repeat(starts, np.diff(np.r_[starts, len(flat)]))
        powers = np.cumprod(np.r_[U(1), np.full(int(place.max()), self.base, U)])
        return mixed(np.add.reduceat(self.of_byte[flat[starts[0] :]] * powers[place], starts - starts[0])), counts

    def __call__(self, batch: pa.RecordBatch) -> list[np.ndarray]:
        """The sorted set of each text: hashes of all ``size`` words in a row; of all words if there are fewer; nothing without words."""
        words, counts = self.word_hashes(*bytes_of(batch))
        out, at, size = [], 0, self.size
        grams = np.zeros(max(0, len(words) - size + 1), U)
        for k in range(size):
            grams += words[k : k + len(grams)] * self.places[k]
        grams = mixed(grams)
        for n in counts.tolist():
            if n >= size:
                out.append(np.unique(grams[at : at + n - size + 1]))
            elif n:
                out.append(mixed((words[at : at + n] * self.places[:n]).sum(keepdims=True) + U(n)))
            else:
                out.append(np.zeros(0, U))
            at += n
        return out


def signer(bands: int = BANDS, rows: int = ROWS):
    """A function from a set to (keys of its bands, signature of 8 bits a slot).

    Slots that differ are equal in 8 bits now and then; that keeps a few pairs longer and drops none."""
    factors = random_odd(bands * rows, 4)[:, None]
    weights = random_odd(bands * rows, 5).reshape(bands, rows)
    salt = random_odd(bands, 6)

    def sign(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        least = np.full(bands * rows, np.iinfo(U).max)
        for at in range(0, len(members), 512):
            np.minimum(least, (factors * members[None, at : at + 512]).min(axis=1), out=least)
        slots = mixed(least)
        keys = mixed((slots.reshape(bands, rows) * weights).sum(axis=1) + salt)
        return keys.view(np.int64), (slots >> U(56)).astype(np.uint8)

    return sign


def least_matches(slots: int, similarity: float, batch: int = BATCH, miss: float = MISS) -> list[tuple[int, int]]:
    """For each number of compared slots, the fewest equal ones at which similarity >= ``similarity`` has a posterior
    probability of ``miss`` or more (from a uniform prior): that of at most m successes among n + 1 trials."""
    out = []
    for n in [*range(batch, slots, batch), slots]:
        chance = np.cumsum([comb(n + 1, k) * similarity**k * (1 - similarity) ** (n + 1 - k) for k in range(n + 1)])
        out.append((n, int(np.argmax(chance >= miss))))
    return out


def names(sets: list[np.ndarray]) -> dict[str, np.ndarray]:
    """Two sums over a set name it: equal sets have equal names, others practically never."""
    salts = {"name_1": U(0), "name_2": U(0x5851F42D4C957F2D)}
    return {name: np.array([mixed(s ^ salt).sum() for s in sets], U).view(np.int64) for name, salt in salts.items()}


def versions(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Key, text and a hash that tells the texts of one key apart."""
    return keyed_texts(docs, key, text).withColumn("version", F.xxhash64("text"))


def signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    def build():
        shingler, sign = Shingler(), signer()

        def work(batch: pa.RecordBatch) -> dict:
            sets = shingler(batch)
            signed = [sign(s) if len(s) else (np.zeros(0, np.int64), np.zeros(0, np.uint8)) for s in sets]
            return {
                "doc_id": batch.column("doc_id"), "version": batch.column("version"), "n_shingles": [len(s) for s in sets],
                **names(sets),
                "bands": [keys for keys, _ in signed], "signature": [s.tobytes() for _, s in signed],
            }

        return work

    schema = "doc_id long, version long, n_shingles long, name_1 long, name_2 long, bands array<bigint>, signature binary"
    return map_arrow(versions(docs, key, text), build, schema)


def free(df: DataFrame, *names: str) -> DataFrame:
    """Rows as they are, but dealt out anew when joined, so that Spark can split the rows of a hot key."""
    return df.withColumns({name: F.expr(f"{name} + 0L") for name in names})


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) for every node of the rows (u, v) that isn't the smallest of its component.

    Alternating large-star and small-star steps, each an aggregate and a join, until every node has one edge, to a
    node that has none. The aggregate has a row a node, however many edges meet there; it is sent to all tasks if there
    are few edges, and is dealt out apart from the edges if not, so that Spark can split a node of many edges."""
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    few = False
    while True:
        # A list of edges doesn't grow from step to step, so one that was small goes to few files.
        edges = written(edges.coalesce(FEW_FILES) if few else edges)
        ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        if ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up + down > 1").isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        few = table_bytes(edges) <= SENT_BYTES // 2
        sent = lambda least: F.broadcast(least) if few else free(least, "u")
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(sent(least), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(sent(least), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def agreeing(x: np.ndarray, y: np.ndarray, rows: np.ndarray, cols: np.ndarray, bounds) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of pairs (rows of x, rows of y) those that no batch of their signatures speaks against, with their equal slots."""
    equal, done = np.zeros(len(rows), int), 0
    for slots, enough in bounds:
        equal = equal + (x[rows, done:slots] == y[cols, done:slots]).sum(axis=1)
        going = equal >= enough
        rows, cols, equal, done = rows[going], cols[going], equal[going], slots
    return rows, cols, equal


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets are similar enough for a link."""
    low, high = SHARE
    if high * min(len(x), len(y)) < low * max(len(x), len(y)):
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return high * common >= low * (len(x) + len(y) - common)


def unpacked(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)


def likely(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """Of pairs (a, b) those that no batch of their signatures speaks against, with the number of equal slots."""
    bounds = least_matches(BANDS * ROWS, SHARE[0] / SHARE[1])

    def build():
        def work(batch: pa.RecordBatch) -> dict:
            every = np.arange(batch.num_rows)
            left, _, equal = agreeing(unpacked(batch.column("sig_a")), unpacked(batch.column("sig_b")), every, every, bounds)
            return {n: batch.column(n).take(pa.array(left)) for n in ("a", "b")} | {"equal": equal}

        return work

    side = lambda n: signed.select(F.col("rep").alias(n), F.col("signature").alias(f"sig_{n}"))
    return map_arrow(pairs.join(side("a"), "a").join(side("b"), "b"), build, "a long, b long, equal int", "sig_a")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs (a, b) those whose full sets are similar enough, as links (u, v).

    The set of ``a`` travels with its pair, that of ``b`` once for every STAR of its pairs."""
    stars = free(pairs.groupBy("b").agg(F.ceil(F.count("*") / STAR).cast("int").alias("blocks")), "b")
    own = sets.select(F.col("rep").alias("a"), F.col("members").alias("set_a"))
    left = pairs.select("a", "b").join(stars, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int").alias("block")).join(own, "a")
    right = stars.join(sets, F.col("b") == F.col("rep")).select("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "members")

    def compare(few: pa.Table, one: pa.Table) -> pa.Table:
        hub = np.frombuffer(one["members"][0].as_buffer(), U) if few.num_rows else None
        found = [i for i, x in enumerate(few["set_a"]) if similar(np.frombuffer(x.as_buffer(), U), hub)]
        return few.select(["a", "b"]).take(pa.array(found, pa.int64())).rename_columns(["u", "v"])

    return left.groupBy("b", "block").cogroup(right.groupBy("b", "block")).applyInArrow(compare, "u long, v long")


def may_be_linked(few: pa.Table, many: pa.Table, bounds) -> pa.Table:
    """Members of two blocks, by the smaller block they are in, that their signatures don't speak against linking."""
    x, y = unpacked(few["signature"]), unpacked(many["signature"])
    home, main = few["component"].to_numpy(), many["component"].to_numpy()
    first, second = few["sets"].to_numpy(), many["sets"].to_numpy()
    first_y = np.ascontiguousarray(y[:, :BATCH])
    found: set[tuple[int, int, bool, int]] = set()
    ids, others = few["rep"].to_numpy(), many["rep"].to_numpy()
    for i in range(len(x)):  # one member against a block
        near = np.flatnonzero((main != home[i]) & ((x[i, :BATCH] == first_y).sum(axis=1) >= bounds[0][1]))
        _, cols, _ = agreeing(x, y, np.full(len(near), i), near, bounds)
        for j in cols.tolist():
            found.add((int(first[i]), int(second[j]), True, int(ids[i])))
            found.add((int(first[i]), int(second[j]), False, int(others[j])))
    rows = list(zip(*found)) or [(), (), (), ()]
    names = (("sets_few", pa.int32()), ("sets_many", pa.int32()), ("is_few", pa.bool_()), ("rep", pa.int64()))
    cluster = few["cluster"][0].as_py() if found else 0
    return pa.table({"cluster": pa.array([cluster] * len(found), pa.int64())} | {n: pa.array(v, t) for (n, t), v in zip(names, rows)})


def links_of_cell(few: pa.Table, many: pa.Table, bounds) -> pa.Table:
    """Links between the members of two blocks that are in different components; one a member of ``few`` and component."""
    x, y = unpacked(few["signature"]), unpacked(many["signature"])
    ids, others = few["rep"].to_numpy(), many["rep"].to_numpy()
    home, main = few["component"].to_numpy(), many["component"].to_numpy()
    sets = [[np.frombuffer(v.as_buffer(), U) for v in side["members"]] for side in (few, many)]
    found: dict[tuple[int, int], tuple[int, int]] = {}
    for i in range(len(x)):  # one member against a block
        near = np.flatnonzero((main != home[i]) & ((x[i, :BATCH] == y[:, :BATCH]).sum(axis=1) >= bounds[0][1]))
        _, cols, equal = agreeing(x, y, np.full(len(near), i), near, bounds)
        for j in cols[np.argsort(-equal, kind="stable")].tolist():
            if (i, main[j]) not in found and similar(sets[0][i], sets[1][j]):
                found[i, main[j]] = int(ids[i]), int(others[j])
    return pa.table({"u": pa.array([u for u, _ in found.values()], pa.int64()), "v": pa.array([v for _, v in found.values()], pa.int64())})


def links_in_clusters(placed: DataFrame, signed: DataFrame, whole: DataFrame) -> DataFrame:
    """Links (u, v) between components within large buckets; ``placed`` has (key, rep, component).

    Buckets with common members form a cluster, so that a pair is compared once however many buckets it shares.
    Members outside a cluster's largest component meet all members, in cells of a block of either."""
    bounds = least_matches(BANDS * ROWS, SHARE[0] / SHARE[1])
    first = placed.groupBy("key").agg(F.min("rep").alias("least"))
    star = placed.join(free(first, "key"), "key").select(F.col("rep").alias("u"), F.col("least").alias("v"))
    cluster = components(star).select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
    rows = placed.select("rep", "component").distinct().join(cluster, "rep", "left").withColumn("cluster", F.coalesce("cluster", "rep"))
    rows = written(rows)
    parts = rows.groupBy("cluster", "component").agg(F.count("*").alias("n"))
    sizes = parts.groupBy("cluster").agg(F.max(F.struct("n", "component")).alias("most"), F.sum("n").alias("all"))
    blocks = lambda n, size: F.ceil(n / size).cast("int")
    apart = F.col("all") - F.col("most.n")
    sizes = (
        sizes.where(F.col("all") > F.col("most.n")).select(
            "cluster", F.col("most.component").alias("main"), blocks(apart, BLOCK).alias("few"), blocks(F.col("all"), BLOCK).alias("many"),
            blocks(apart, SETS).alias("few_sets"), blocks(F.col("all"), SETS).alias("many_sets"),
        )
    )
    held = written(rows.join(free(sizes, "cluster"), "cluster").join(signed, "rep"))
    part = lambda n, salt: F.pmod(F.xxhash64("rep", F.lit(salt)), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["cluster", "at_few", "at_many", "sets", "rep", "component", "signature"]
    few = held.where("component <> main").withColumn("sets", part("few_sets", 2)).withColumn("at_few", part("few", 1)).withColumn("at_many", each("many"))
    many = held.withColumn("sets", part("many_sets", 2)).withColumn("at_many", part("many", 1)).withColumn("at_few", each("few"))
    few, many, cell = few.select(*columns).toDF(*columns), many.select(*columns).toDF(*columns), columns[:3]  # columns of their own, though of one source
    involved = few.groupBy(*cell).cogroup(many.groupBy(*cell)).applyInArrow(
        lambda x, y: may_be_linked(x, y, bounds), "cluster long, sets_few int, sets_many int, is_few boolean, rep long"
    )
    involved = written(involved.distinct())
    with_sets = involved.join(held.select("rep", "component", "signature"), "rep").join(whole, "rep")
    cell, columns = ["cluster", "sets_few", "sets_many"], ["cluster", "sets_few", "sets_many", "rep", "component", "signature", "members"]
    few, many = (with_sets.where(side).select(*columns).toDF(*columns) for side in ("is_few", "not is_few"))

    def compare(x: pa.Table, y: pa.Table) -> pa.Table:
        return links_of_cell(x, y, bounds)

    return few.groupBy(*cell).cogroup(many.groupBy(*cell)).applyInArrow(compare, "u long, v long")


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows (rep, members) for the sets in ``wanted`` (rep, first, first_version, name_1, name_2), from the first text that has that set."""

    def build():
        shingler = Shingler()

        def work(batch: pa.RecordBatch) -> dict:
            sets = shingler(batch)
            own = [found == batch.column(name).to_numpy() for name, found in names(sets).items()]
            at = np.flatnonzero(own[0] & own[1])
            return {"rep": batch.column("rep").take(pa.array(at)), "members": [sets[i].tobytes() for i in at.tolist()]}

        return work

    here = (docs.doc_id == wanted["first"]) & (docs.version == wanted["first_version"])
    chosen = docs.join(sent_if_small(wanted), here).select("rep", "name_1", "name_2", "text")
    return map_arrow(chosen, build, "rep long, members binary").dropDuplicates(["rep"])


def shared_ids(named: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (u, v) between the sets of each doc_id that has several."""
    name = F.struct("name_1", "name_2")
    several = written(named.groupBy("doc_id").agg(F.min(name).alias("a"), F.max(name).alias("b")).where("a <> b").select("doc_id"))
    held = named.join(several, "doc_id").distinct().join(sets.select("name_1", "name_2", "rep"), ["name_1", "name_2"]).select("doc_id", "rep")
    return held.join(held.groupBy("doc_id").agg(F.min("rep").alias("v")), "doc_id").select(F.col("rep").alias("u"), "v")


def linked(docs: DataFrame, rows: DataFrame, by_text: bool = False) -> DataFrame:
    """Rows (name_1, name_2, least): the sets, and the first (doc_id, version) of their component.

    The sets of one doc_id are linked, unless ``by_text``."""
    named = rows.where("n_shingles > 0 and doc_id is not null").select("doc_id", "version", "name_1", "name_2")
    sets = named.groupBy("name_1", "name_2").agg(F.min(F.struct("doc_id", "version")).alias("first"))
    # Numbered where it is written, so that all that follows sees the same numbers.
    sets = written(sets.select("name_1", "name_2", "first.*").toDF("name_1", "name_2", "first", "first_version").withColumn("rep", F.monotonically_increasing_id()))
    named = named.drop("version")
    at_first = sets.withColumnsRenamed({"first": "doc_id", "first_version": "version"})
    reps = rows.join(at_first, ["doc_id", "version", "name_1", "name_2"])
    reps = reps.select("rep", F.col("doc_id").alias("first"), F.col("version").alias("first_version"), "name_1", "name_2", "bands", "signature")
    keyed = reps.select("rep", F.posexplode("bands").alias("band", "key"))
    # The hub of a bucket: the least member after each is mixed with the key, so that buckets of one group have different hubs.
    buckets = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min(F.col("rep").bitwiseXOR(F.col("key"))).alias("code")).where("n > 1").drop("n")
    members = keyed.join(free(buckets, "key"), "key").select("key", "band", "rep", F.col("code").bitwiseXOR(F.col("key")).alias("hub"))
    members = written(members)
    within = members.select("rep").distinct()
    signed = written(reps.drop("bands").join(within, "rep", "left_semi").dropDuplicates(["rep"]))
    whole = written(full_sets(docs, signed.drop("signature")))
    signed = signed.select("rep", "signature")

    def tried(pairs: DataFrame) -> DataFrame:
        """Components after each rep in ``pairs`` (rep, hub) is held against its likeliest hub."""
        known = likely(pairs.where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct(), signed)
        best = known.groupBy("a").agg(F.max(F.struct("equal", "b")).alias("best")).select("a", F.col("best.b").alias("b"))
        return components(confirmed(best, whole))

    def of_component(rows: DataFrame, at: DataFrame) -> DataFrame:
        """Add the component of each member."""
        known = at.select(F.col("node").alias("rep"), "component")
        return rows.join(known, "rep", "left").withColumn("component", F.coalesce("component", "rep"))

    def stars(at: DataFrame) -> DataFrame:
        return at.select(F.col("node").alias("u"), F.col("component").alias("v"))

    at = tried(members.where(F.col("band") < HUB_BANDS))
    # What is still apart from the largest component of its bucket meets the members of other components.
    placed = written(of_component(members.select("key", "rep"), at))
    parts = placed.groupBy("key", "component").agg(F.count("*").alias("n"))
    main = parts.groupBy("key").agg(F.max(F.struct("n", "component")).alias("most"), F.sum("n").alias("all")).where("all > most.n")
    main = main.select("key", F.col("most.component").alias("main"), "all")
    split = written(placed.join(free(main, "key"), "key"))
    small = split.where(F.col("all") <= SMALL)
    few = small.where("component <> main").select("key", F.col("rep").alias("other"), F.col("component").alias("other_component"))
    meet = small.join(free(few, "key"), "key").where("component <> other_component")
    meet = meet.select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")).distinct()
    links = stars(at).unionByName(confirmed(likely(meet, signed), whole))
    if not by_text:
        links = links.unionByName(shared_ids(named, sets))
    large = split.where(F.col("all") > SMALL).select("key", "rep", "component")
    if not large.isEmpty():
        links = links.unionByName(links_in_clusters(large, signed, whole))
    placed = written(of_component(sets, components(links)))
    least = placed.groupBy("component").agg(F.min(F.struct(F.col("first").alias("doc_id"), F.col("first_version").alias("version"))).alias("least"))
    return placed.join(free(least, "component"), "component").select("name_1", "name_2", "least")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked if their sets of five-word shingles have a similarity of 0.75 or more; component_id is the
    smallest doc_id reachable over links, kept says whether that is the document itself. Null, empty and wordless
    texts have an empty set and no links. Rows that share a doc_id are one document with the links of each; a row
    without doc_id has no links, no component and is kept. Empty tables give no rows. Other columns are ignored.
    """
    rows = written(signatures(docs, key, text))
    placed = linked(versions(docs, key, text), rows)
    named = rows.where("n_shingles > 0 and doc_id is not null").select("doc_id", "name_1", "name_2")
    ids = named.join(free(placed, "name_1"), ["name_1", "name_2"]).where("doc_id <> least.doc_id")
    found = ids.select(F.col("doc_id").alias("node"), F.col("least.doc_id").alias("component")).distinct()
    out = rows.select("doc_id", "n_shingles").join(found, F.col("doc_id") == F.col("node"), "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def other_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Distinct rows (doc_id, version) of the texts that are near-duplicates of an earlier one: of each component all but the
    text with the smallest doc_id (of several, the smallest version, a hash of the text). Texts of one doc_id are linked
    only if they are near-duplicates. Null, empty and wordless texts and rows without doc_id are never among them."""
    rows = written(signatures(docs, key, text))
    placed = linked(versions(docs, key, text), rows, by_text=True)
    named = rows.where("n_shingles > 0 and doc_id is not null").select("doc_id", "version", "name_1", "name_2")
    ids = named.join(free(placed, "name_1"), ["name_1", "name_2"])
    return ids.where((F.col("doc_id") != F.col("least.doc_id")) | (F.col("version") != F.col("least.version"))).select("doc_id", "version").distinct()

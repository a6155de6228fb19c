"""Exact Jaccard join of texts on word n-grams, with set-relation skipping.

Texts with equal shingle sets form a class; classes are joined, not texts.

*Index.* The shingles of a set are ordered by rarity, and the first
``n - ceil(t n) + 1`` of them are listed in an inverted index: two sets that link
share one of those. Lists of one entry go. What counts as rare comes from the
counts of all documents' repeated shingles; the order has no effect on results.

*Skipping in lists.* The entries of a list fall into blocks by set size and by
the shingle's position; pairs of blocks whose sizes and positions rule out the
overlap that a link needs are skipped as a whole, then pairs of entries. What is
left passes a sketch of each set, whose differing bits bound the sets' difference,
before the sets themselves are read and compared.

*Deriving answers.* Highly similar sets share lists, so their answers are derived
from one of them: first every set is verified against the leaders of its lists
only. Sets that linked to a leader form a group, and a link within a group adds
nothing. A list of one group is done. In the others, pairs between groups are
verified, but for those that the leaders' computed similarities rule out: Jaccard
distance is a metric, so sets whose distances to one leader differ by more than
``1 - t`` can't link. While leaders still link many sets, further rounds of other
leaders come first. No pair between groups is left out, so no link between
different texts is lost, and a group of any size costs a few pairs per member.

Words are the runs of ``[^\\x20\\x09-\\x0D]`` after lower-casing A-Z. Shingles are
compared by 64-bit hashes, classes by 64-bit keys that are checked against
128 bits (another seed is taken if two sets share a key).

Defined cases: a text of fewer words than a shingle is one shingle; a null, empty
or wordless text has an empty set and links with nothing; a text without a doc_id
belongs to its equal texts' component, and is alone (component null) if none has
an id; rows that repeat a doc_id are separate texts under one name; columns other
than doc_id and text pass through ``keep_one`` as they are, which decides on rows: see
there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketbars.llm.common import arrow_rows, binary_rows, space_words, stage
from marketbars.llm.components import components

WORDS, PERCENT = 4, 85
SKETCH_BITS = 1024
FREQUENT = 1 << 18              # shingles whose counts order the index, at most
COUNT_CHUNK = 1_000_000         # shingles counted at once in a task
BATCH_SHINGLES = 500_000        # of one record batch
POSITION_BLOCK = 8
ROUNDS = 3                      # of leaders, at most
WORTH = 0.05                    # links per open set below which the rounds end
BROADCAST_SETS = 1_000_000      # (key, doc_id) pairs, 16 bytes each, that may be broadcast
ORDERS = (0x5851F42D4C957F2D, 0x14057B7EF767814F, 0x2545F4914F6CDD1D,
          0x369DEA0F31A53F85, 0x27BB2EE687B0B0FD, 0x1B873593CC9E2D51)

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)
_hash = xxhash.xxh3_64_intdigest


def shingles(text: bytes | None, words: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    tokens = space_words(text) if text else []
    if not tokens:
        return np.empty(0, np.uint64)
    if len(tokens) < words:
        return np.array([_hash(b" ".join(tokens))], np.uint64)
    h = np.fromiter(map(_hash, tokens), np.uint64, len(tokens))
    n = len(tokens) - words + 1
    mixed = h[:n] * _MIX
    for i in range(1, words):
        mixed = ((mixed ^ (mixed >> _SHIFT)) + h[i:i + n]) * _MIX
    return np.unique(mixed ^ (mixed >> _SHIFT))


def at_least(percent: int, n):
    """ceil(t n)."""
    return (percent * n + 99) // 100


# ---- rarity ------------------------------------------------------------------

def _count(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def repeated() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            many = counts > 1
            return pa.RecordBatch.from_arrays(
                [pa.array(values[many].view(np.int64)), pa.array(counts[many].astype(np.int64))],
                names=["shingle", "n"])
        for batch in batches:
            for text in binary_rows(batch, "text"):
                found = shingles(text, words)
                if len(found):
                    held.append(found)
                    size += len(found)
                if size >= COUNT_CHUNK:
                    yield repeated()
                    held, size = [], 0
        if held:
            yield repeated()
    return run


def frequent_shingles(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The most repeated shingles (sorted) and their counts: of all documents,
    summed on Spark; ``FREQUENT`` rows come back."""
    with arrow_rows(docs.sparkSession):
        rows = (docs.select("text").mapInArrow(_count(words), "shingle long, n long")
                .groupBy("shingle").agg(F.sum("n").alias("n")).where("n > 2")
                .orderBy(F.col("n").desc(), "shingle").limit(FREQUENT).toArrow())
    values = rows.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(values)
    return values[order], rows.column("n").to_numpy()[order]


# ---- sets and their index ------------------------------------------------------

SETS = "doc_id long, n int, k long, k2 long, sketch array<long>, prefix array<long>"


def odd_sketch(found: np.ndarray) -> np.ndarray:
    """A bit per hash slot: whether the set has an odd number of shingles there. The
    bits in which two sketches differ are at most the shingles in which the sets do."""
    odd = np.bincount((found & np.uint64(SKETCH_BITS - 1)).astype(np.int64),
                      minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _index(shared, words: int, percent: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, counts = shared.value
        for batch in batches:
            sizes, keys, keys2, sketches, prefixes = [], [], [], [], []
            for text in binary_rows(batch, "text"):
                found = shingles(text, words)
                n = len(found)
                data = found.tobytes()
                sizes.append(n)
                keys.append(xxhash.xxh3_64_intdigest(data, seed) - (1 << 63))
                keys2.append(xxhash.xxh64_intdigest(data, seed + 1) - (1 << 63))
                sketches.append(odd_sketch(found))
                rarity = np.zeros(n, np.int64)
                if n and len(values):
                    at = np.minimum(np.searchsorted(values, found), len(values) - 1)
                    rarity = np.where(values[at] == found, counts[at], 0)
                listed = n - at_least(percent, n) + 1 if n else 0
                prefixes.append(found[np.lexsort((found, rarity))[:listed]].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int32()), pa.array(keys, pa.int64()),
                 pa.array(keys2, pa.int64()), pa.array(sketches, pa.list_(pa.int64())),
                 pa.array(prefixes, pa.list_(pa.int64()))],
                names=["doc_id", "n", "k", "k2", "sketch", "prefix"])
    return run


def shingle_sets(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, int]:
    """(doc_id, n, k, k2, prefix) of every row, written; and the keys' seed."""
    rare = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs, words))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    seed = 0
    while True:
        sets = stage(rows.mapInArrow(_index(rare, words, percent, seed), SETS), "shingle-sets")
        if not (sets.groupBy("k").agg(F.min("k2").alias("a"), F.max("k2").alias("b"))
                .where("a <> b").limit(1).count()):
            rare.destroy()
            return sets, seed
        seed += 2


def _contents(words: int, seed: int):
    schema = pa.schema([("k", pa.int64()), ("data", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, data, size = [], [], 0

            def out() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(data, pa.list_(pa.int64()))],
                    schema=schema)
            for k, text in zip(batch.column(0).to_pylist(), binary_rows(batch, "text")):
                found = shingles(text, words)
                if xxhash.xxh3_64_intdigest(found.tobytes(), seed) - (1 << 63) == k:
                    keys.append(k)
                    data.append(found.view(np.int64))
                    size += len(found)
                if size >= BATCH_SHINGLES:
                    yield out()
                    keys, data, size = [], [], 0
            yield out()
    return run


# ---- verification ----------------------------------------------------------------

def verify(pairs: DataFrame, contents: DataFrame, percent: int) -> DataFrame:
    """(a, b, common, total, link) of the distinct pairs."""
    left = contents.select(F.col("k").alias("a"), F.col("data").alias("x"))
    right = contents.select(F.col("k").alias("b"), F.col("data").alias("y"))
    common = F.size(F.array_intersect("x", "y")).cast("long")
    return (pairs.join(left, "a").join(right, "b")
            .select("a", "b", common.alias("common"), (F.size("x") + F.size("y")).alias("both"))
            .select("a", "b", "common", (F.col("both") - F.col("common")).alias("total"))
            .distinct()
            .withColumn("link", F.col("common") * 100 >= F.col("total") * percent))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")) \
                .where("a < b").distinct()


# ---- the join ----------------------------------------------------------------------

def _sizes_allow(a: Column, b: Column, percent: int) -> Column:
    return (F.least(a, b) * 100 >= F.greatest(a, b) * percent)


def _overlap_allows(rest: Column, both: Column, percent: int) -> Column:
    """Linked sets overlap in t / (1 + t) of their sizes' sum, or more."""
    return rest * (100 + percent) >= both * percent


def _difference_allows(apart: Column, both: Column, percent: int) -> Column:
    return apart * (100 + percent) <= both * (100 - percent)


def _size_block(n: Column, percent: int) -> Column:
    """Sets whose sizes allow a link are in the same block or in adjacent ones."""
    return F.floor(F.log(n) / F.log(F.lit(100.0 / percent)))


def _leader_pairs(entries: DataFrame, order: int, percent: int) -> DataFrame:
    """Every set of a list with leaders of its size blocks: the earliest document's
    set, and those that come first and last in the round's order; without the
    pairs that sizes or positions rule out."""
    turned = F.col("k").bitwiseXOR(F.lit(order))
    key = ["token", "block"]
    blocked = entries.withColumn("block", _size_block(F.col("n"), percent))
    own = F.struct("k", "n", "pos")
    leaders = blocked.groupBy(*key).agg(
        F.min(F.struct(F.col("doc").alias("o"), own.alias("s"))).alias("x"),
        F.min(F.struct(turned.alias("o"), own.alias("s"))).alias("y"),
        F.max(F.struct(turned.alias("o"), own.alias("s"))).alias("z"))
    # and of the next smaller block, which joins the groups across its border
    both = blocked.withColumn("block", F.explode(F.array("block", F.col("block") - 1)))
    met = (both.join(leaders, key)
           .select("k", "n", "pos", F.explode(F.array("x.s", "y.s", "z.s")).alias("l")))
    return _ordered(
        met.where((F.col("k") != F.col("l.k")) & _sizes_allow(F.col("n"), F.col("l.n"), percent)
                  & _overlap_allows(F.least(F.col("n") - F.col("pos"),
                                            F.col("l.n") - F.col("l.pos")),
                                    F.col("n") + F.col("l.n"), percent))
        .select(F.col("k").alias("a"), F.col("l.k").alias("b")))


def _near_groups(verified: DataFrame) -> DataFrame:
    """(k, g): sets that links join in a few steps, under a common name: the least
    set two links away, and from that on once more. Groups may be smaller than the
    components; that costs pairs, and loses none."""
    links = verified.where("link").select("a", "b")
    both = stage(links.union(links.select("b", "a")), "links")
    one = (both.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("m"))
           .select("k", F.least("k", "m").alias("g")))
    one = stage(one, "groups")
    two = stage(both.join(one.withColumnRenamed("k", "b"), "b").select(F.col("a").alias("k"), "g")
                .union(one).groupBy("k").agg(F.min("g").alias("g")), "groups")
    further = two.select(F.col("k").alias("g"), F.col("g").alias("g2"))
    return two.join(further, "g", "left").select("k", F.coalesce("g2", "g").alias("g"))


def _grouped(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """The entries with their set's group, of the lists that hold several groups."""
    named = (entries.join(groups.withColumnRenamed("g", "_g"), "k", "left")
             .withColumn("g", F.coalesce("_g", "k")).drop("_g"))
    several = (named.groupBy("token").agg(F.min("g").alias("x"), F.max("g").alias("y"))
               .where("x <> y").select("token"))
    return named.join(several, "token", "left_semi")


def _main_groups(named: DataFrame) -> DataFrame:
    """(token, main, m, n): each list's largest group, its entries, all entries."""
    per = named.groupBy("token", "g").agg(F.count(F.lit(1)).alias("m"))
    return per.groupBy("token").agg(F.max(F.struct("m", "g")).alias("top"),
                                    F.sum("m").alias("n")) \
              .select("token", F.col("top.g").alias("main"), F.col("top.m").alias("m"), "n")


def _folded(sketches: DataFrame) -> DataFrame:
    """(k, f): the sketch folded to 256 bits, which are as good a bound."""
    def fold(i: int) -> Column:
        out = F.col("sketch")[i]
        for j in range(i + 4, SKETCH_BITS // 64, 4):
            out = out.bitwiseXOR(F.col("sketch")[j])
        return out
    return sketches.select("k", *[fold(i).alias(f"f{i}") for i in range(4)])


def _pairs_between(named: DataFrame, mains: DataFrame, sketches: DataFrame,
                   percent: int) -> DataFrame:
    """Pairs of sets of different groups that a list's blocks and positions allow,
    and the sets' folded sketches."""
    blocked = (named.join(mains.select("token", "main"), "token")
               .join(_folded(sketches), "k")
               .withColumn("rest", F.col("n") - F.col("pos"))
               .withColumn("size_block", _size_block(F.col("n"), percent))
               .withColumn("pos_block", F.floor(F.col("pos") / POSITION_BLOCK)))
    key = ["token", "size_block", "pos_block"]
    blocks = blocked.groupBy(*key).agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max("rest").alias("rest"),
        F.max(F.col("g") != F.col("main")).alias("odd"))
    x, y = blocks.alias("x"), blocks.alias("y")
    allowed = (x.where("odd").join(y, "token")
               .where((F.col("x.least") * percent <= F.col("y.most") * 100)
                      & (F.col("y.least") * percent <= F.col("x.most") * 100)
                      & _overlap_allows(F.least("x.rest", "y.rest"),
                                        F.col("x.least") + F.col("y.least"), percent))
               .select("token", F.col("x.size_block").alias("xs"),
                       F.col("x.pos_block").alias("xp"), F.col("y.size_block").alias("ys"),
                       F.col("y.pos_block").alias("yp")))
    left = blocked.where("g <> main").select(
        "token", F.col("size_block").alias("xs"), F.col("pos_block").alias("xp"),
        F.col("k").alias("a"), F.col("g").alias("ga"), F.col("n").alias("na"),
        F.col("rest").alias("ra"), *[F.col(f"f{i}").alias(f"a{i}") for i in range(4)])
    right = blocked.select(
        "token", F.col("size_block").alias("ys"), F.col("pos_block").alias("yp"),
        F.col("k").alias("b"), F.col("g").alias("gb"), F.col("n").alias("nb"),
        F.col("rest").alias("rb"), *[F.col(f"f{i}").alias(f"b{i}") for i in range(4)])
    apart = sum((F.bit_count(F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}"))) for i in range(1, 4)),
                F.bit_count(F.col("a0").bitwiseXOR(F.col("b0"))))
    both = F.col("na") + F.col("nb")
    return _ordered(
        left.join(allowed, ["token", "xs", "xp"]).join(right, ["token", "ys", "yp"])
        .where((F.col("ga") != F.col("gb"))
               & _sizes_allow(F.col("na"), F.col("nb"), percent)
               & _overlap_allows(F.least("ra", "rb"), both, percent)
               & _difference_allows(apart, both, percent)))


def _not_ruled_out(pairs: DataFrame, verified: DataFrame, percent: int) -> DataFrame:
    """Without the pairs that have been verified, and those whose similarities to
    one leader are too far apart."""
    both = verified.select("a", "b", (1 - F.col("common") / F.col("total")).alias("d"))
    known = both.union(both.select("b", "a", "d"))
    home = known.groupBy(F.col("a").alias("b")).agg(
        F.min(F.struct("d", F.col("b").alias("leader"))).alias("home"))
    far = (known.select("a", F.col("b").alias("leader"), F.col("d").alias("da")))
    return (pairs.join(both.select("a", "b"), ["a", "b"], "left_anti")
            .join(home, "b", "left")
            .withColumn("leader", F.col("home.leader"))
            .join(far, ["a", "leader"], "left")
            .where(F.col("da").isNull()
                   | (F.abs(F.col("da") - F.col("home.d")) <= F.lit(1 - percent / 100 + 1e-9)))
            .select("a", "b"))


class _Verifier:
    """Verifies pairs on the sets of the texts they name; each set is read once."""

    def __init__(self, docs: DataFrame, sets: DataFrame, met: DataFrame, words: int,
                 percent: int, seed: int):
        small = F.broadcast(met) if met.count() <= BROADCAST_SETS else met
        own = small.withColumnRenamed("doc", "doc_id")
        self.sketches = stage(sets.select("k", "doc_id", "n", "sketch").join(own, ["k", "doc_id"])
                              .dropDuplicates(["k"]).select("k", "n", "sketch"), "sketches")
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text"))
        self.met, self.words, self.percent, self.seed = met, words, percent, seed
        self.contents: DataFrame | None = None

    def _close(self, pairs: DataFrame) -> DataFrame:
        """Without the pairs whose sketches differ in more bits than linked sets can
        differ in shingles."""
        x, y = (self.sketches.select(F.col("k").alias(c), F.col("n").alias(f"n{c}"),
                                     F.col("sketch").alias(f"s{c}")) for c in "ab")
        apart = F.aggregate(F.zip_with("sa", "sb", lambda s, t: F.bit_count(s.bitwiseXOR(t))),
                            F.lit(0), lambda total, bits: total + bits)
        near = _difference_allows(apart, F.col("na") + F.col("nb"), self.percent)
        return pairs.join(x, "a").join(y, "b").where(near).select("a", "b")

    def __call__(self, pairs: DataFrame) -> DataFrame:
        pairs = stage(self._close(pairs), "pairs")
        needed = pairs.select(F.col("a").alias("k")).union(pairs.select("b")).distinct()
        if self.contents is not None:
            needed = needed.join(self.contents.select("k"), "k", "left_anti")
        needed = stage(needed.join(self.met, "k").select("k", "doc"), "needed")
        small = needed.count() <= BROADCAST_SETS
        read = (self.docs.join(F.broadcast(needed) if small else needed, "doc").select("k", "text")
                .mapInArrow(_contents(self.words, self.seed), "k long, data array<long>"))
        new = stage(read, "contents")       # a row more where rows repeat an id
        self.contents = new if self.contents is None else self.contents.union(new)
        return stage(verify(pairs, self.contents, self.percent), "verified")


def link_texts(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, class_id, component_id."""
    sets, seed = shingle_sets(docs, words, percent)
    classes = (sets.where("n > 0").groupBy("k")
               .agg(F.min(F.struct("doc_id", "n", "prefix")).alias("s"),
                    F.min("doc_id").alias("doc"))
               .select("k", "doc", F.col("s.n").alias("n"), F.col("s.prefix").alias("prefix")))
    listed = classes.select("k", "doc", "n", F.posexplode("prefix").alias("pos", "token"))
    several = listed.groupBy("token").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    entries = stage(listed.join(several.select("token"), "token", "left_semi"), "index")
    met = stage(entries.groupBy("k").agg(F.min("doc").alias("doc")), "met")
    check = _Verifier(docs, sets, met, words, percent, seed)

    verified = named = None
    for turn in range(ROUNDS):
        pairs = _leader_pairs(entries if named is None else named, ORDERS[turn], percent)
        if verified is not None:
            pairs = pairs.join(verified.select("a", "b"), ["a", "b"], "left_anti")
        new = check(pairs)
        verified = new if verified is None else verified.union(new)
        named = stage(_grouped(entries, _near_groups(verified)), "open-lists")
        # another round pays while it still links many of the sets that are open
        open_sets = named.select("k").distinct().count()
        if new.where("link").count() < WORTH * open_sets or not open_sets:
            break
    if open_sets:
        between = _pairs_between(named, _main_groups(named), check.sketches, percent)
        verified = verified.union(check(_not_ruled_out(between, verified, percent)))
    groups = components(verified.where("link").select(F.col("a").alias("u"),
                                                      F.col("b").alias("v")))
    named_groups = (groups.join(met.select(F.col("k").alias("node"), "doc"), "node")
                    .withColumnRenamed("node", "k"))
    least = named_groups.groupBy("component").agg(F.min("doc").alias("component_id"))
    by_class = named_groups.join(least, "component").select("k", "component_id")
    own = sets.where("n > 0").groupBy("k").agg(F.min("doc_id").alias("class_id"))
    return (sets.select("doc_id", "n", "k").join(own, "k", "left").join(by_class, "k", "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("class_id"))
                    .otherwise(F.col("doc_id")).alias("class_id"),
                    F.when(F.col("n") > 0, F.coalesce("component_id", "class_id"))
                    .otherwise(F.col("doc_id")).alias("component_id")))


_KEY = "_text_key"


def _row_key() -> Column:
    """What decisions go by: the doc_id and the text."""
    return F.xxhash64(F.col("doc_id").cast("long"), "text")


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of every component: that of the smallest doc_id (rows
    without one come last). Documents that link with nothing all stay.

    Rows, not ids, are kept or dropped: different texts under one doc_id, or without one,
    are different documents. Of rows that agree in doc_id and text, all of which link
    with each other, one stays; those whose texts have no words link with nothing, and all
    stay."""
    keyed = docs.withColumn(_KEY, _row_key())
    linked = (link_texts(keyed.select(F.col(_KEY).alias("doc_id"), "text"), words, percent)
              .where("n_shingles > 0").select(F.col("doc_id").alias(_KEY), "component_id"))
    # the keys of components of several rows, with the rows' ids
    several = linked.groupBy("component_id").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    named = stage(linked.join(several, "component_id").groupBy(_KEY, "component_id")
                  .agg(F.count(F.lit(1)).alias("m")), "linked-rows")
    ids = (keyed.select(_KEY, F.col("doc_id").cast("long").alias("_id")).join(named, _KEY)
           .select(_KEY, "_id", "component_id").distinct())
    first = ids.groupBy("component_id").agg(F.min(F.struct(
        F.col("_id").isNull().alias("absent"), F.col("_id").alias("i"), F.col(_KEY).alias("k"))).alias("f"))
    kept = first.select(F.col("f.k").alias(_KEY))
    gone = stage(named.select(_KEY).join(kept, _KEY, "left_anti"), "gone-rows")
    again = stage(named.where("m > 1").join(kept, _KEY, "left_semi").select(_KEY), "repeated-rows")
    rest = keyed.join(gone, _KEY, "left_anti")
    return (rest.join(again, _KEY, "left_anti")
            .unionByName(rest.join(again, _KEY, "left_semi").dropDuplicates([_KEY])).drop(_KEY))

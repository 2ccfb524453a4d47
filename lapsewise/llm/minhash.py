"""Near-duplicate detection with b-bit MinHash.

Words are the runs of characters outside U+0020 and U+0009 to U+000D, A-Z lower-cased; a document's
set holds its distinct shingles of four words (a parameter), or its whole sequence if it has fewer. Documents are
linked if 100 * intersection >= 80 * union.

Documents with equal sets form a class, and only one of them goes on. Bands of full minima give
candidate buckets; of each minimum the lowest bits are kept, packed into a short signature, and bit
counts over two signatures estimate their similarity, corrected for equal bits by chance. Candidates
whose estimate is far below the threshold are dropped; every other one is confirmed on the full sets.

Buckets are never turned into all their pairs. First each document is compared with the smallest
one of its buckets. Confirmed links are joined to components, and members that already share a
component need no further comparison. What is left are candidates across components, often many
edited copies of one text just below the threshold. They are gathered by the largest component
near them and compared on their full sets in blocks of bounded size, the documents outside that
component against all others; a block returns no more links than join its documents.

Rows without words, or without text, have an empty set and are linked with nothing. Rows with one
doc_id count as one document with the links of all of them. A row without doc_id can't be referred
to: it keeps a null component and is kept. Other columns are ignored. Empty tables give empty ones.
"""

import sys
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lapsewise.llm.arrays import ascii_space, hash_of, ranges
from lapsewise.sources.workspace import materialise

# executors unpickle the helpers below without having this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Shingle length in words, and the share of the union that must be common, in percent.
#: Words of a shingle unless a caller says otherwise; similarity in percent.
WORDS, PERCENT = 4, 80
#: 32 bands of 5 minima miss a pair at the threshold with a chance of 3 in a million.
BANDS, ROWS = 32, 5
MINIMA = BANDS * ROWS
#: Bits kept of each minimum, and the integers that hold them.
BITS = 2
PACKED = [f"s{i}" for i in range(MINIMA * BITS // 64)]
#: Candidates estimated below this are dropped: five standard deviations under the threshold.
ESTIMATE = 0.61
#: Documents on either side of a block, and their shingles together.
BLOCK, BLOCK_SHINGLES = 64, 1_000_000
#: Best candidates of each document that are confirmed first.
FIRST = 3
#: Bits that mark the documents whose full sets are needed.
MARKS = 1 << 25
#: Bytes of texts handled at once.
TOGETHER = 1_000_000


def mixed(x):
    """A bijection that spreads 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list, words: int = WORDS) -> tuple:
    """Distinct hashes of each text's shingles of so many words, sorted, in one array, and how many each text has."""
    raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    text = np.frombuffer(b"".join(r + b"\n" for r in raw), np.uint8)
    start, end = ranges(~ascii_space()[text])
    word = mixed(hash_of(text, start, end, 0))
    stop = np.searchsorted(start, np.cumsum([len(r) + 1 for r in raw]))
    n = np.diff(stop, prepend=0)
    owner = np.repeat(np.arange(len(raw)), n)
    random = np.random.Generator(np.random.PCG64(11))
    factor = random.integers(0, 2**63, words, np.uint64) * np.uint64(2) + np.uint64(1)
    total = word * factor[0]
    for k in range(1, words):  # a short text's single shingle ends with it
        total[:-k] += np.where(owner[k:] == owner[:-k], word[k:] * factor[k], 0)
    at = np.arange(len(word)) - np.repeat(stop - n, n)
    whole = at <= np.maximum(np.repeat(n, n) - words, 0)
    shingle = mixed(total[whole] + np.minimum(n, words).astype(np.uint64)[owner[whole]])
    owner = owner[whole]
    edge = np.searchsorted(owner, np.arange(len(raw) + 1)).tolist()
    for a, b in zip(edge, edge[1:]):
        shingle[a:b].sort()
    new = np.ones(len(shingle), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (owner[1:] != owner[:-1])
    return shingle[new], np.bincount(owner[new], minlength=len(raw))


def sketches(shingle, n) -> tuple:
    """For each nonempty set: two 64-bit sums that identify it, band keys and the packed low bits."""
    n = n[n > 0]
    first = np.cumsum(n) - n
    if not len(n):
        return np.zeros((0, 2), np.int64), np.zeros((0, BANDS), np.int64), np.zeros((0, len(PACKED)), np.int64)
    sums = np.stack([np.add.reduceat(mixed(shingle ^ np.uint64(c)), first) for c in (0x5851F42D4C957F2D, 0x14057B7EF767814F)], 1)
    random = np.random.Generator(np.random.PCG64(13))
    factor = random.integers(0, 2**31, MINIMA, np.uint32) * np.uint32(2) + np.uint32(1)
    shift = random.integers(0, 2**32, MINIMA, np.uint32)
    short = (shingle >> np.uint64(32)).astype(np.uint32)
    low = np.empty((len(n), MINIMA), np.uint32)
    row = np.empty_like(short)
    for k in range(MINIMA):
        np.multiply(short, factor[k], out=row)
        np.add(row, shift[k], out=row)
        low[:, k] = np.minimum.reduceat(row, first)
    wide = low.astype(np.uint64).reshape(len(n), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), wide.shape[:2]).copy()
    for k in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + wide[:, :, k])
    bits = (low & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(len(n), len(PACKED), 64 // BITS)
    packed = (bits << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))).sum(2, dtype=np.uint64)
    return sums.view(np.int64), key.view(np.int64), packed.view(np.int64)


def split_up(batch, column: str):
    """Parts of a record batch whose texts are of about one size together, with those texts."""
    texts, at, size = batch.column(column).to_pylist(), 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size > TOGETHER or i + 1 == len(texts):
            yield batch.slice(at, i + 1 - at), texts[at : i + 1]
            at, size = i + 1, 0


def sketched(batches, words: int):
    for batch in batches:
        for part, texts in split_up(batch, "text"):
            shingle, n = shingle_sets(texts, words)
            sums, key, packed = sketches(shingle, n)
            empty = n == 0
            at = np.maximum(np.cumsum(~empty) - 1, 0)
            take = lambda rows: pa.array(np.r_[rows, [0]][at], pa.int64(), mask=empty)
            offsets = np.r_[0, np.cumsum(np.where(empty, 0, BANDS))]
            bands = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(key.ravel()))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()), take(sums[:, 0]), take(sums[:, 1]), bands,
                 *(take(packed[:, i]) for i in range(len(PACKED)))],
                names=["doc_id", "n_shingles", "key_a", "key_b", "bands", *PACKED],
            )


def full_sets(batches, words: int):
    for batch in batches:
        for part, texts in split_up(batch, "text"):
            shingle, n = shingle_sets(texts, words)
            sets = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)], pa.int32()), pa.array(shingle.view(np.int64)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), sets], names=["node", "shingles"])


def estimate(a: str, b: str) -> Column:
    """Similarity from equal low bits, corrected for those that are equal by chance."""
    differ = sum(
        F.bit_count((F.col(f"{a}{s}").bitwiseXOR(F.col(f"{b}{s}"))).bitwiseOR(
            F.shiftrightunsigned(F.col(f"{a}{s}").bitwiseXOR(F.col(f"{b}{s}")), 1)
        ).bitwiseAND(F.lit(0x5555555555555555)))
        for s in PACKED
    )
    chance = 2.0**-BITS
    return ((MINIMA - differ) / MINIMA - chance) / (1 - chance)


def near(a: str, b: str) -> Column:
    """What two documents' sizes and signatures must fulfil to be worth confirming."""
    sizes = (F.col(f"{a}n") * PERCENT <= F.col(f"{b}n") * 100) & (F.col(f"{b}n") * PERCENT <= F.col(f"{a}n") * 100)
    return sizes & (estimate(a, b) >= ESTIMATE)


def renamed(df: DataFrame, prefix: str, *columns: str) -> DataFrame:
    return df.select(*(F.col(c).alias(prefix + c) for c in columns))


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = pairs.join(renamed(sets, "a", "node", "shingles"), F.col("a") == F.col("anode"))
    both = left.join(renamed(sets, "b", "node", "shingles"), F.col("b") == F.col("bnode"))
    common = F.size(F.array_intersect("ashingles", "bshingles"))
    union = F.size("ashingles") + F.size("bshingles") - common
    return both.where(common * 100 >= union * PERCENT).select("a", "b").distinct()


def few(df: DataFrame, name: str) -> DataFrame:
    """Links, written by fewer tasks than a shuffle of documents has: their rows are short."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialise(df.coalesce(max(1, parts // 8)), name)


def observed(df: DataFrame, name: str, *metrics: Column) -> tuple[DataFrame, dict]:
    """The same, and metrics of the rows, taken while they are written."""
    seen = Observation()
    return few(df.observe(seen, *metrics), name), seen.get


def components(edges: DataFrame) -> DataFrame:
    """The smallest member reachable from each node of the edges (a, b): columns node and label.

    Each round links every node's larger neighbours, then the node and its smaller neighbours, to
    the smallest member of its neighbourhood, until all that is left are stars. The smallest members
    are grouped by the node that the links are then joined by, so a join of shuffled rows needs
    no exchange of its own; a broadcast would.
    """
    def linked(pairs, condition):
        low = pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        return pairs.join(low.hint("merge"), "a").where(condition).select(F.col("b").alias("a"), F.col("low").alias("b"))

    def written(df):
        return observed(df, "edges", F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum"))

    flipped = lambda df: df.unionByName(df.select(F.col("b").alias("a"), F.col("a").alias("b")))
    now, seen = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct())
    before = {"n": 0}
    while seen["n"] and seen != before:
        before = seen
        # stored, since a plan that holds it three times fills the driver's memory
        large = few(linked(flipped(now), "b > a").distinct(), "large")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low.hint("merge"), "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        now, seen = written(small.union(low).distinct())
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )


def best(pairs: DataFrame, n: int) -> DataFrame:
    """The n candidates of each larger document that look most similar."""
    order = W.partitionBy("b").orderBy(F.desc("similar"), "a")
    return pairs.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n).drop("_rank")


def find_links(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """Components of the linked classes; nodes holds each class's smallest document and its sketch."""
    stored = ["node", "n", *PACKED]
    bands = nodes.select("node", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first < last")
    members = materialise(bands.join(shared.select("band", "first"), "band"), "members")

    stars = members.where("node > first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    stars = stars.join(renamed(nodes, "a", *stored), F.col("a") == F.col("anode"))
    stars = stars.join(renamed(nodes, "b", *stored), F.col("b") == F.col("bnode"))
    stars = stars.where(near("a", "b")).select("a", "b", estimate("a", "b").alias("similar"))
    pairs = few(best(stars, FIRST).select("a", "b"), "pairs")
    sets = materialise(sets_of(docs, ids_of(pairs), words), "sets")
    labels = components(confirmed(pairs, sets))

    rows = mixed_buckets(members, nodes, labels)
    count = F.count(F.lit(1)).alias("n")
    open_, seen = observed(still_open(rows), "open", count)
    if not seen["n"]:
        return labels
    sets = sets.union(materialise(sets_of(docs, open_.join(sets, "node", "left_anti").withColumnRenamed("node", "doc_id"), words), "sets"))
    rows = materialise(gathered_by_main(rows.join(open_, "node")), "gathered")
    links, seen = observed(within_gathered(rows, sets).union(confirmed(few(across(rows), "pairs"), sets)), "links", count)
    if not seen["n"]:
        return labels
    return components(links.union(labels.select(F.col("label").alias("a"), F.col("node").alias("b"))))


def ids_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()


def marked(wanted: DataFrame, bits: int) -> DataFrame:
    """(part, marks): a bit for each hash of a wanted doc_id, in parts of 32 768 bits."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    return wanted.select(F.bitmap_bucket_number(place).alias("part"), F.bitmap_bit_position(place).alias("bit")).groupBy("part").agg(
        F.bitmap_construct_agg("bit").alias("marks")
    )


def sets_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """The full sets of the wanted doc_ids, each named once.

    Texts whose id has no mark among MARKS bits are left out before anything is shuffled; the marks are 4 MB at most.
    Of the rest, whether the ids go to the texts or both are shuffled is left to Spark, by their size. The last join is
    an inner one, since Spark would move a semi join below that of the marks, and so shuffle every text.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(MARKS))
    texts = docs.select("doc_id", "text").withColumn("part", F.bitmap_bucket_number(place)).withColumn("bit", F.bitmap_bit_position(place))
    texts = texts.join(F.broadcast(marked(wanted, MARKS)), "part")
    byte = F.conv(F.hex(F.substring("marks", (F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    texts = texts.where(F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1)
    texts = texts.select("doc_id", "text").join(wanted, "doc_id")
    return texts.mapInArrow(partial(full_sets, words=words), "node long, shingles array<long>")


def mixed_buckets(members: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """The members, with sketches, of buckets that hold several components; main is a bucket's largest one."""
    known = members.join(labels, "node", "left").select("band", "node", F.coalesce("label", "node").alias("label"))
    sizes = known.groupBy("band", "label").agg(F.count("*").alias("m"))
    several = blocked(sizes.groupBy("band").agg(
        F.max(F.struct("m", "label")).alias("main"), F.sum("m").alias("all"), F.count("*").alias("labels")
    ).where("labels > 1"), F.col("all") - F.col("main.m"), F.col("all"))
    several = several.select("band", F.col("main.label").alias("main"), "i_blocks", "j_blocks")
    return materialise(known.join(several, "band").join(nodes.select("node", "n", *PACKED), "node"), "mixed")


def blocked(df: DataFrame, outside: Column, everyone: Column, block: int = 4 * BLOCK) -> DataFrame:
    return df.withColumn("i_blocks", F.ceil(outside / block).cast("int")).withColumn("j_blocks", F.ceil(everyone / block).cast("int"))


def dealt(rows: DataFrame, kept: list[str], *group: str) -> tuple[DataFrame, DataFrame]:
    """The members outside their group's main component, and all members, dealt to the group's blocks i, j."""
    block = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "node"), F.col(n)).cast("int")
    outside = rows.where("label <> main").select(
        *group, block(1, "i_blocks").alias("i"), F.explode(F.sequence(F.lit(0), F.col("j_blocks") - 1)).alias("j"),
        *(F.col(c).alias("x" + c) for c in kept),
    )
    everyone = rows.select(
        *group, F.explode(F.sequence(F.lit(0), F.col("i_blocks") - 1)).alias("i"), block(2, "j_blocks").alias("j"),
        (F.col("label") == F.col("main")).alias("in_main"), *(F.col(c).alias("y" + c) for c in kept),
    )
    return outside, everyone


def opposed(rows: DataFrame, *more: str) -> tuple[DataFrame, DataFrame, list]:
    """Both sides of each bucket, and when two of them are a candidate."""
    outside, everyone = dealt(rows, ["node", "label", "n", *PACKED, *more], "band")
    once = (F.col("xlabel") != F.col("ylabel")) & (F.col("in_main") | (F.col("xnode") < F.col("ynode")))
    return outside, everyone, [*(outside[c] == everyone[c] for c in ("band", "i", "j")), once, near("x", "y")]


def still_open(rows: DataFrame) -> DataFrame:
    """The nodes that have a candidate in another component."""
    outside, everyone, candidate = opposed(rows)
    x = outside.join(everyone, candidate, "left_semi").select(F.col("xnode").alias("node"))
    y = everyone.join(outside, candidate, "left_semi").select(F.col("ynode").alias("node"))
    return x.union(y).distinct()


def gathered_by_main(rows: DataFrame) -> DataFrame:
    """The rows with ``near``: the smallest main component among the buckets of their node."""
    nearest = few(rows.groupBy("node").agg(F.min("main").alias("near")), "nearest")
    return rows.join(nearest, "node")


def across(rows: DataFrame) -> DataFrame:
    """Candidates (a, b) of one bucket that aren't gathered around one component."""
    outside, everyone, candidate = opposed(rows, "near")
    found = outside.join(everyone, [*candidate, F.col("xnear") != F.col("ynear")])
    return found.select(F.least("xnode", "ynode").alias("a"), F.greatest("xnode", "ynode").alias("b")).distinct()


def within_gathered(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between the components that are gathered around one, on the full sets."""
    rows = rows.select("near", "node", "label", "n").distinct()
    sizes = rows.groupBy("near", "label").agg(F.count("*").alias("m"), F.sum("n").alias("n"))
    sizes = sizes.groupBy("near").agg(
        F.max(F.struct("m", "label", "n")).alias("main"), F.sum("m").alias("m"), F.sum("n").alias("n"), F.count("*").alias("labels")
    ).where("labels > 1")
    units = lambda m, n: F.greatest(m.cast("double"), n * (BLOCK / BLOCK_SHINGLES))
    sizes = blocked(sizes, units(F.col("m") - F.col("main.m"), F.col("n") - F.col("main.n")), units(F.col("m"), F.col("n")), BLOCK)
    sizes = sizes.select("near", F.col("main.label").alias("main"), "i_blocks", "j_blocks")
    rows = materialise(rows.join(sizes, "near"), "placed").join(sets, "node")
    outside, everyone = dealt(rows, ["node", "label", "shingles"], "near")
    both = outside.select("near", "i", "j", F.lit(True).alias("x"), *(F.col("x" + c).alias(c) for c in ("node", "label", "shingles")))
    both = both.union(everyone.select("near", "i", "j", F.lit(False), "ynode", "ylabel", "yshingles"))
    return both.groupBy("near", "i", "j").applyInArrow(block_links, "a long, b long")


def block_links(block):
    """Links of one block between documents of different components, as few as join them."""
    side = np.asarray(block.column("x").combine_chunks())
    node, label = (np.asarray(block.column(c).combine_chunks()) for c in ("node", "label"))
    lists = block.column("shingles").combine_chunks()
    size = np.diff(np.asarray(lists.offsets))
    _, shingle = np.unique(np.asarray(lists.flatten()), return_inverse=True)
    owner = np.repeat(np.arange(len(node)), size)
    xs, ys = np.flatnonzero(side), np.flatnonzero(~side)
    row = np.empty(len(node), np.int64)
    row[xs], row[ys] = np.arange(len(xs)), np.arange(len(ys))
    common = np.zeros((len(xs), len(ys)), np.float32)
    order = np.argsort(shingle, kind="stable")
    shingle, owner = shingle[order], owner[order]
    step = 1 << 16
    for first in range(0, int(shingle[-1]) + 1 if len(shingle) else 0, step):
        part = slice(*np.searchsorted(shingle, [first, first + step]))
        held, term = owner[part], shingle[part] - first
        has = []
        for chosen, n in ((side[held], len(xs)), (~side[held], len(ys))):
            table = np.zeros((n, step), np.float32)
            table[row[held[chosen]], term[chosen]] = 1
            has.append(table)
        common += has[0] @ has[1].T
    union = size[xs][:, None] + size[ys][None, :] - common
    x, y = np.nonzero((common * 100 >= union * PERCENT) & (label[xs][:, None] != label[ys][None, :]))
    parent = {}

    def root(v):
        while parent.setdefault(v, v) != v:
            v = parent[v]
        return v

    out = []
    for i, j in zip(xs[x].tolist(), ys[y].tolist()):
        a, b = root(int(label[i])), root(int(label[j]))
        if a != b:
            parent[a] = b
            out.append((int(node[i]), int(node[j])))
    return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})


def near_duplicates(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, for each row of documents, by shingles of so many words."""
    schema = "doc_id long, n_shingles long, key_a long, key_b long, bands array<long>, " + ", ".join(f"{s} long" for s in PACKED)
    rows = materialise(docs.select("doc_id", "text").mapInArrow(partial(sketched, words=words), schema), "sketches")
    linked = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    key = ["key_a", "key_b", "n_shingles"]
    classes = linked.groupBy(*key).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("last > first").drop("last")
    classes = few(classes, "classes")
    # a class is represented by its smallest document
    nodes = linked.join(classes, key, "left").where("first IS NULL OR first = doc_id")
    nodes = materialise(nodes.select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "bands", *PACKED), "nodes")
    labels = find_links(docs, nodes, words)

    several = linked.groupBy("doc_id").agg(*(f(c).alias(f"{c} {f.__name__}") for c in key for f in (F.min, F.max)))
    several = several.where(" OR ".join(f"`{c} min` <> `{c} max`" for c in key))
    if observed(several.select("doc_id"), "several", F.count(F.lit(1)).alias("n"))[1]["n"]:
        # a doc_id with several texts joins their classes
        same = linked.join(classes, key).where("doc_id > first").select(F.col("first").alias("a"), F.col("doc_id").alias("b"))
        labels = components(labels.select(F.col("label").alias("a"), F.col("node").alias("b")).union(same))
    own = labels.withColumnRenamed("label", "own")
    shared = classes.join(labels, F.col("first") == F.col("node"), "left").select(*key, F.coalesce("label", "first").alias("shared"))
    placed = rows.select("doc_id", *key).join(shared, key, "left").join(own, F.col("doc_id") == F.col("node"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.coalesce("shared", "own", "doc_id")))
    return placed.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")
    )

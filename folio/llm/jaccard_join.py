"""N-gram Jaccard self-join with a count-vector R-tree.

1. Each text becomes its set of word shingles (64-bit hashes). Equal sets are one class from here on.
2. Classes that can be similar share one of the rarest shingles of both sets (the first
   n - ceil(t n) + 1 of each set, rarest first: a lossless prefix filter). Rarity comes from counters of
   all shingles in BUCKETS buckets. The classes that have such a shingle are a block; of blocks with the
   same classes one is kept.
3. Shingles are hashed into GROUPS groups. The group counts of a class are a point of an R-tree; the
   overlap of two sets is at most the sum of the coordinate minima, so a node is passed over if the minima
   with its upper corner add up to too little. In each block the classes that surviving pairs connect
   belong together (blocks of more than PAGE classes as a whole), and what belongs together in any block,
   directly or over others, is a cluster; no link crosses clusters.
4. In a cluster the tree is searched again, and surviving pairs are verified with the whole sets, unless
   they are already known to be connected.
5. A cluster of more than PAGE classes is dealt to pages. Connected parts of each page are merged over
   their representatives, page by page, and then every class outside its cluster's largest part searches
   the trees of all pages, so that no link is lost.

A text is lower-cased (A-Z only); words are what white space (space, tab to carriage return) separates. A
text of fewer words than a shingle has is one shingle of all its words. Defined cases: a null text or one
without words has no shingle, is linked with nothing and is its own component; a null doc_id never names
a component that has another; repeated rows are equal sets; an empty table gives an empty result; other
columns are ignored by components() and kept by representatives(). Distinct shingles are taken to have
distinct 64-bit hashes, and distinct sets distinct sums of mixed hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import batches_of, small_batches, table, texts, unused, written

BUCKETS = 1 << 17
GROUPS = 128
#: Classes of a page; one of more than HEAVY shingles counts for its share of HEAVY.
PAGE, HEAVY = 2000, 1000
LEAF = 32
#: Groups of the finer counts, a power of two with 12 bits.
FINE = 1 << 12
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_K = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the output depends on every bit of the input."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= 500_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


WORDS = WordHashes()


def shingles(text: str | None, n: int) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles of n words."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(WORDS.__getitem__, words), np.uint64, len(words))
    width = min(n, len(h))
    total = np.full(len(h) - width + 1, width, np.uint64)
    for i in range(width):
        total = _mixed((total + h[i : len(h) - width + 1 + i]) * _K)
    return np.unique(total)


def set_id(h: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    return int(_mixed(np.array([_mixed(h * _K).sum(dtype=np.uint64) + np.uint64(len(h))], np.uint64)).view(np.int64)[0])


class Similarity:
    """Jaccard similarity of at least num / den, in whole numbers."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def overlap(self, a, b):
        """The least overlap that sets of sizes a and b need."""
        return -(-self.num * (a + b) // (self.num + self.den))

    def smallest(self, a):
        return -(-self.num * a // self.den)

    def prefix(self, n: int) -> int:
        return n - self.smallest(n) + 1

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        both = len(np.intersect1d(a, b, assume_unique=True))
        return self.den * both >= self.num * (len(a) + len(b) - both)


def point(h: np.ndarray) -> np.ndarray:
    """Counts of the groups."""
    return np.bincount((h >> np.uint64(57)).astype(np.int64), minlength=GROUPS)


def _in_bytes(size: int, p: np.ndarray) -> bytes:
    """The size and the counts, rounded up to multiples of the least power of two by which each fits a byte."""
    most, shift = int(p.max(initial=0)), 0
    while -(-most >> shift) > 255:
        shift += 1
    return np.array([size, shift], np.int32).tobytes() + (-(-p >> shift)).astype(np.uint8).tobytes()


def small_point(h: np.ndarray) -> bytes:
    """The size and the counts of the groups in bytes, never less than they are."""
    return _in_bytes(len(h), point(h))


def from_small(data: bytes) -> tuple[int, np.ndarray]:
    size, shift = np.frombuffer(data, np.int32, 2)
    return int(size), np.frombuffer(data, np.uint8, GROUPS, 8).astype(np.int64) << int(shift)


class CountTree:
    """An R-tree over count vectors, packed bottom-up: by size, then by groups in turn."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes
        order = np.lexsort((points[:, 1], points[:, 0], self.sizes))
        self.leaves = [order[at : at + LEAF] for at in range(0, len(order), LEAF)]
        # levels[0] covers the leaves: upper corners, least and largest sizes; each level covers LEAF nodes of the one below.
        level = [(points[x].max(axis=0), self.sizes[x].min(), self.sizes[x].max()) for x in self.leaves]
        self.levels = []
        while level:
            corners, low, high = (np.array(x) for x in zip(*level, strict=True))
            self.levels.append((corners, low, high))
            if len(level) == 1:
                break
            level = [(corners[at : at + LEAF].max(axis=0), low[at : at + LEAF].min(), high[at : at + LEAF].max()) for at in range(0, len(level), LEAF)]

    def search(self, q: np.ndarray, n: int, least: Similarity) -> np.ndarray:
        """The points that the bound does not rule out for a set of size n and counts q."""
        nodes = np.zeros(1, np.int64) if self.levels else np.empty(0, np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            corners, low, high = self.levels[depth]
            if depth < len(self.levels) - 1:
                nodes = (nodes[:, None] * LEAF + np.arange(LEAF)).ravel()
                nodes = nodes[nodes < len(corners)]
            # The smallest set in the node that size alone allows needs the least overlap.
            need = least.overlap(n, np.maximum(low[nodes], least.smallest(n)))
            reach = np.minimum(corners[nodes], q).sum(axis=1)
            nodes = nodes[(reach >= need) & (high[nodes] >= least.smallest(n)) & (least.smallest(low[nodes]) <= n)]
        if not len(nodes):
            return np.empty(0, np.int64)
        at = np.concatenate([self.leaves[i] for i in nodes])
        at = at[(self.sizes[at] >= least.smallest(n)) & (least.smallest(self.sizes[at]) <= n)]
        return at[np.minimum(self.points[at], q).sum(axis=1) >= least.overlap(n, self.sizes[at])]


def connected(sets: list[np.ndarray], labels: np.ndarray, queries: np.ndarray, least: Similarity) -> np.ndarray:
    """Labels after joining what is linked: each query against all sets, pairs of one label are not verified again."""
    labels = labels.copy()
    points, sizes = np.stack([point(h) for h in sets]), np.array([len(h) for h in sets])
    tree = CountTree(points, sizes)
    # Long sets fill all groups alike; finer counts give them a bound that tells.
    long = np.flatnonzero(sizes > FINE // 8)
    row, fine = np.full(len(sets), -1), np.zeros((len(long), FINE), np.uint16)
    row[long] = np.arange(len(long))
    for k, i in enumerate(long):
        fine[k] = np.minimum(np.bincount((sets[i] >> np.uint64(64 - 12)).astype(np.int64), minlength=FINE), 65535)
    for q in queries:
        found = tree.search(points[q], sizes[q], least)
        found = found[labels[found] != labels[q]]
        if row[q] >= 0 and sizes[q] < 65535 and len(found):
            near = row[found]
            near = np.where(near >= 0, np.minimum(fine[near], fine[row[q]]).sum(axis=1, dtype=np.int64), sizes[found])
            found = found[near >= least.overlap(sizes[q], sizes[found])]
        while len(found):
            other = found[0]
            if least.linked(sets[q], sets[other]):
                a, b = labels[q], labels[other]
                labels[labels == max(a, b)] = min(a, b)
                found = found[labels[found] != labels[q]]
            else:
                found = found[1:]
    return labels


def together(points: np.ndarray, sizes: np.ndarray, least: Similarity) -> np.ndarray:
    """For each point the least index that surviving pairs connect it with."""
    labels, tree = np.arange(len(points)), CountTree(points, sizes)
    for q in range(len(points)):
        found = np.unique(labels[tree.search(points[q], sizes[q], least)])
        if len(found) > 1:
            labels[np.isin(labels, found)] = found[0]
    return labels


def _blocks(num: int, den: int):
    """Rows of one token follow each other: token, sid, small; out: edges (a, b) between classes that may be linked."""
    least = Similarity(num, den)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = batches_of({"a": pa.int64(), "b": pa.int64()})
        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("token", "sid", "small")), strict=True))
        done: tuple[list, list] = ([], [])
        for _, block in groupby(rows, key=lambda r: r[0]):
            block = list(block)  # PAGE rows at most
            sizes, points = zip(*(from_small(r[2]) for r in block), strict=True)
            if len(block) == 1:
                continue
            if len(block) == 2:
                labels = [0, int(np.minimum(*points).sum() < least.overlap(*sizes) or min(sizes) < least.smallest(max(sizes)))]
            else:
                labels = together(np.stack(points), np.array(sizes), least)
            for k, label in enumerate(labels):
                if k != label:
                    done[0].append(block[k][1])
                    done[1].append(block[label][1])
            if len(done[0]) >= 10_000:
                yield make(*done)
                done = ([], [])
        yield make(*done)

    return run


def _pages(n: int, num: int, den: int):
    """Rows of one (cluster, page) follow each other: sid, label, asks, own (whether it lies on this page), text; out: label -> label."""
    least = Similarity(num, den)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = batches_of({"label": pa.int64(), "to": pa.int64()})
        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("cluster", "page", "sid", "label", "asks", "text")), strict=True))
        for _, page in groupby(rows, key=lambda r: r[:2]):
            sets, labels, asks, seen = [], [], [], set()
            for _, _, sid, label, ask, text in page:
                h = shingles(text, n)
                if sid not in seen and set_id(h) == sid:  # another text under the same doc_id
                    seen.add(sid)
                    sets.append(h)
                    labels.append(label)
                    asks.append(ask)
            if len(sets) > 1:
                before = np.array(labels, np.int64)
                after = connected(sets, before, np.flatnonzero(asks), least)
                changed = np.unique(np.stack([before, after])[:, before != after], axis=1)
                if changed.size:
                    yield make(changed[0], changed[1])

    return run


def fine_point(h: np.ndarray) -> bytes:
    """As small_point(), with FINE groups for sets of more than 512 shingles."""
    if len(h) <= 512:
        return small_point(h)
    p = np.bincount((h >> np.uint64(64 - 12)).astype(np.int64), minlength=FINE)
    return _in_bytes(len(h), p)


def from_fine(data: bytes) -> tuple[int, np.ndarray]:
    size, shift = np.frombuffer(data, np.int32, 2)
    return int(size), np.frombuffer(data, np.uint8, -1, 8).astype(np.int32) << int(shift)


def folded(counts: np.ndarray) -> np.ndarray:
    """FINE groups as GROUPS groups: both take leading bits of a hash."""
    return counts if counts.shape[-1] == GROUPS else counts.reshape(*counts.shape[:-1], GROUPS, -1).sum(axis=-1)


def _fine_points(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = batches_of({"sid": pa.int64(), "data": pa.binary()})
        for batch, all_ in texts(batches, "text"):
            sets = [shingles(t, n) for t in all_]
            right = [(sid, fine_point(h)) for sid, h in zip(batch.column("sid").to_pylist(), sets, strict=True) if len(h) and set_id(h) == sid]
            if right:
                yield make(*zip(*right, strict=True))

    return run


def _page_pairs(num: int, den: int):
    """Rows of a page, its own first: cluster, page, sid, label, asks, data; out: surviving pairs of different labels, a < b."""
    least = Similarity(num, den)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = batches_of({"a": pa.int64(), "b": pa.int64(), "label": pa.int64(), "to": pa.int64()})
        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("cluster", "page", "sid", "label", "asks", "data")), strict=True))
        for _, page in groupby(rows, key=lambda r: r[:2]):
            own, kinds = [], None
            for _, _, sid, label, asks, data in page:
                size, counts = from_fine(data)
                if not asks:
                    own.append((sid, label, size, counts))
                    continue
                if kinds is None:  # own classes of few and of many groups
                    kinds = [(k, *(np.array([x[i] for x in part]) for i in range(3)), np.stack([x[3] for x in part])) for k in (GROUPS, FINE) if (part := [x for x in own if len(x[3]) == k])]
                for k, sids, labels, sizes, points in kinds:
                    near = np.flatnonzero((labels != label) & (sizes >= least.smallest(size)) & (least.smallest(sizes) <= size))
                    mine, theirs = (counts, points[near]) if len(counts) == k else (folded(counts), folded(points[near]))
                    near = near[np.minimum(theirs, mine).sum(axis=1) >= least.overlap(size, sizes[near])]
                    if len(near):
                        other, to = sids[near], labels[near]
                        yield make(np.minimum(other, sid), np.maximum(other, sid), np.full(len(near), label), to)

    return run


def _verified(n: int, num: int, den: int):
    """label and to of the pairs of texts that are linked."""
    least = Similarity(num, den)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = batches_of({"label": pa.int64(), "to": pa.int64()})
        for batch in batches:
            a, b, ta, tb, label, to = (batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b", "label", "to"))
            found = []
            for k in range(len(a)):
                x, y = shingles(ta[k], n), shingles(tb[k], n)
                if set_id(x) == a[k] and set_id(y) == b[k] and least.linked(x, y):
                    found.append((label[k], to[k]))
            if found:
                yield make(*zip(*found, strict=True))

    return run


def joined_pages(rows: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """label and to: labels that a link connects. rows: cluster, page, sid, label, asks, text."""
    dealt = rows.select("cluster", "page", "sid", "label", "asks", "text").repartition("cluster", "page").sortWithinPartitions("cluster", "page", "sid")
    return dealt.mapInArrow(_pages(n, num, den), "label long, to long")


def connected_components(edges: DataFrame) -> DataFrame:
    """v and component (the least v it is connected with) for all ends of edges (a, b).

    In each round a vertex points to its least neighbour or itself, pointers are followed, and edges are
    drawn between what they lead to; the graph shrinks until no edge is left.
    """
    edges = written(edges.select("a", "b").where("a <> b").distinct(), "edges")
    known = None
    while True:
        both = edges.union(edges.select("b", "a"))
        step = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("v"), F.least("a", "m").alias("c"))
        for _ in range(2):
            step = step.join(step.select(F.col("v").alias("at"), F.col("c").alias("to")), F.col("c") == F.col("at")).select("v", F.col("to").alias("c"))
        step = written(step, "labels")
        known = step if known is None else written(known.join(step.select(F.col("v").alias("at"), F.col("c").alias("to")), F.col("c") == F.col("at"), "left").select("v", F.coalesce("to", "c").alias("c")), "labels")
        a, b = (step.select(F.col("v").alias(x), F.col("c").alias(f"c{x}")) for x in ("a", "b"))
        edges = written(edges.join(a, "a").join(b, "b").where("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), "edges")
        if not edges.limit(1).count():
            return known.select("v", F.col("c").alias("component"))


def _classes(n: int):
    """Rows of both kinds: (0, doc_id, size, sid, small, h) for a text, (1, bucket, count and nulls) for the shingles of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = batches_of({"kind": pa.int8(), "a": pa.int64(), "b": pa.int64(), "sid": pa.int64(), "small": pa.binary(), "h": pa.int64()})
        total = np.zeros(BUCKETS, np.int64)
        for batch, all_ in texts(batches, "text"):
            sizes, sids, small = [], [], []
            for text in all_:
                h = shingles(text, n)
                small.append(small_point(h) if len(h) else None)
                np.add.at(total, (h & np.uint64(BUCKETS - 1)).astype(np.int64), 1)
                sizes.append(len(h))
                sids.append(set_id(h) if len(h) else None)
            yield make(np.zeros(len(sizes), np.int8), batch.column("doc_id"), sizes, sids, small, batch.column("h"))
        there = np.flatnonzero(total)
        yield make(np.ones(len(there), np.int8), there, total[there], pa.nulls(len(there), pa.int64()), pa.nulls(len(there), pa.binary()), pa.nulls(len(there), pa.int64()))

    return run


def _prefixes(n: int, num: int, den: int, counters):
    least = Similarity(num, den)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, seen, rare = batches_of({"token": pa.int64(), "sid": pa.int64()}), set(), counters.value
        for _, all_ in texts(batches, "text"):
            tokens, sids = [], []
            for text in all_:
                h = shingles(text, n)
                if not len(h) or (sid := set_id(h)) in seen:
                    continue
                if len(seen) >= 200_000:
                    seen.clear()
                seen.add(sid)
                first = h[np.lexsort((h, rare[(h & np.uint64(BUCKETS - 1)).astype(np.int64)]))[: least.prefix(len(h))]]
                tokens.append(first.view(np.int64))
                sids.append(np.full(len(first), sid))
            if tokens:
                yield make(np.concatenate(tokens), np.concatenate(sids))

    return run


def _paged(rows: DataFrame) -> DataFrame:
    """rows (cluster, sid, weight, ...) with page and pages: a cluster's classes dealt to pages of a weight of about PAGE."""
    sizes = rows.groupBy("cluster").agg(F.sum("weight").alias("_n"))
    pages = F.ceil(F.col("_n") / PAGE).cast("int")
    return rows.join(sizes, "cluster").withColumn("pages", pages).withColumn("page", F.pmod(F.xxhash64("sid"), F.col("pages")).cast("int")).drop("_n")


def _relabelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    """rows with label replaced where links (v, component) has it."""
    return rows.join(links.withColumnRenamed("v", "label"), "label", "left").withColumn("label", F.coalesce("component", "label")).drop("component")


def _as_links(pairs: DataFrame) -> DataFrame:
    return connected_components(pairs.select(F.col("label").alias("a"), F.col("to").alias("b")))


def components(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id of the component) of each row of docs (doc_id, text)."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.selectExpr("CAST(doc_id AS long) doc_id", "text", "xxhash64(text) h")
    both = written(docs.mapInArrow(_classes(n), "kind byte, a long, b long, sid long, small binary, h long"), "jaccard-classes")
    rows = both.where("kind = 0").select(F.col("a").alias("doc_id"), F.col("b").alias("n_shingles"), "sid", "h")
    counters = np.zeros(BUCKETS, np.int64)
    for r in both.where("kind = 1").groupBy("a").agg(F.sum("b").alias("n")).collect():  # BUCKETS rows at most
        counters[r.a] = r.n
    classes = rows.where("sid IS NOT NULL").groupBy("sid").agg(F.min("doc_id").alias("first_id"), F.min_by("h", F.struct(F.col("doc_id").isNull(), "doc_id", "h")).alias("first_h"), F.greatest(F.lit(1.0), F.max("n_shingles") / HEAVY).alias("weight"))

    shared = spark.sparkContext.broadcast(counters)  # BUCKETS numbers
    prefixes = written(docs.mapInArrow(_prefixes(n, num, den, shared), "token long, sid long"), "jaccard-prefixes")
    clusters = connected_components(candidate_edges(prefixes, both, num, den)).select(F.col("v").alias("sid"), F.col("component").alias("cluster"))

    members = _paged(clusters.join(classes, "sid"))
    # The row of the class's first doc_id; rows without a doc_id, or with one that comes again, are told apart by their text.
    found = docs.join(members, docs.doc_id.eqNullSafe(members.first_id) & (docs.h == members.first_h)).dropDuplicates(["sid"])
    asked = F.lit(True).alias("asks")
    # The texts of clustered classes, once; later steps read them here.
    members = written(found.select("cluster", "page", "pages", "weight", "sid", "text"), "jaccard-members")
    links = written(joined_pages(members.select("*", F.col("sid").alias("label"), asked), n, num, den), "jaccard-links")
    label = _as_links(links)
    paged = members.where("pages > 1")
    if paged.limit(1).count():
        label = _across_pages(paged, label, n, num, den)
    named = classes.drop("weight", "first_h").join(label.withColumnRenamed("v", "sid"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    named = written(named, "jaccard-named")
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    names = named.join(least, "component").select("sid", "component_id")
    out = rows.join(names, "sid", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def candidate_edges(prefixes: DataFrame, both: DataFrame, num: int, den: int) -> DataFrame:
    """a, b: classes that a block's surviving pairs connect. A class may be in the prefixes more than once."""
    # Sums of hashes tell blocks with the same classes; a class that a block has twice only hides this.
    key = F.pmod(F.xxhash64("sid"), F.lit(1 << 31))
    blocks = prefixes.groupBy("token").agg(F.count("*").alias("n"), F.min("sid").alias("low"), F.max("sid").alias("high"), F.sum(key).alias("sum")).where("low < high")
    blocks = written(blocks.groupBy("n", "low", "high", "sum").agg(F.min("token").alias("token")).select("token", "n", "low"), "jaccard-blocks")
    rows = prefixes.join(blocks.where(F.col("n") <= PAGE).select("token"), "token").distinct()
    points = both.where("sid IS NOT NULL").groupBy("sid").agg(F.min("small").alias("small"))
    rows = rows.join(points, "sid").select("token", "sid", "small")
    dealt = rows.repartition("token").sortWithinPartitions("token", "sid")
    edges = dealt.mapInArrow(_blocks(num, den), "a long, b long")
    # A large block belongs together as a whole: an edge from each class to its least, without gathering it.
    large = prefixes.join(blocks.where(F.col("n") > PAGE), "token").where("sid <> low").select(F.col("sid").alias("a"), F.col("low").alias("b"))
    return written(edges.unionByName(large), "jaccard-edges").distinct()


def _across_pages(paged: DataFrame, label: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """label (v, component) with the links between the pages of large clusters."""
    start = written(_relabelled(paged.select("cluster", "page", "pages", "weight", "sid", F.col("sid").alias("label")), label), "jaccard-paged")
    known, asked = label, F.lit(True).alias("asks")
    current = start
    while True:
        # One representative of each connected part, on pages again; parts that meet are one.
        parts = _paged(current.groupBy("cluster", "label").agg(F.min("sid").alias("sid"), F.max("weight").alias("weight")))
        parts = written(parts.join(parts.groupBy("cluster").agg(F.count("*").alias("_k")).where("_k > 1").drop("_k"), "cluster"), "jaccard-parts")
        if not parts.limit(1).count():
            return known
        reps = parts.join(paged.select("sid", "text"), "sid")
        more = written(joined_pages(reps.select("*", asked), n, num, den), "jaccard-links")
        met = more.limit(1).count() > 0
        if met:
            more = _as_links(more)
            current = written(_relabelled(current, more), "jaccard-paged")
            known = _composed(known, start, current)
        if not met or parts.agg(F.max("pages")).first()[0] == 1:
            break
    # What is outside the largest part of its cluster asks every page.
    sizes = current.groupBy("cluster", "label").agg(F.count("*").alias("k"))
    largest = sizes.groupBy("cluster").agg(F.max_by("label", F.struct("k", "label")).alias("main"))
    asking = current.join(largest, "cluster").where("label <> main").drop("main")
    asking = asking.select("cluster", F.explode(F.sequence(F.lit(0), F.col("pages") - 1)).alias("page"), "sid", "label", asked)
    # Every page has the counts of its own classes and of those that ask; texts move for surviving pairs only.
    points = written(paged.select("sid", "text").mapInArrow(_fine_points(n), "sid long, data binary"), "jaccard-points").dropDuplicates(["sid"])
    open_ = current.join(asking.select("cluster").distinct(), "cluster").select("cluster", "page", "sid", "label", F.lit(False).alias("asks"))
    both = open_.unionByName(asking).join(points, "sid").select("cluster", "page", "sid", "label", "asks", "data")
    dealt = both.repartition("cluster", "page").sortWithinPartitions("cluster", "page", "asks", "sid")
    pairs = dealt.mapInArrow(_page_pairs(num, den), "a long, b long, label long, to long").dropDuplicates(["a", "b"])
    texts_ = paged.select("sid", "text")
    pairs = pairs.join(texts_.select(F.col("sid").alias("a"), F.col("text").alias("text_a")), "a").join(texts_.select(F.col("sid").alias("b"), F.col("text").alias("text_b")), "b")
    rest = written(pairs.mapInArrow(_verified(n, num, den), "label long, to long"), "jaccard-links")
    if not rest.limit(1).count():
        return known
    current = written(_relabelled(current, _as_links(rest)), "jaccard-paged")
    return _composed(known, start, current)


def _composed(known: DataFrame, start: DataFrame, current: DataFrame) -> DataFrame:
    """known (v, component), with the labels that the classes of paged clusters have now."""
    now = current.select(F.col("sid").alias("v"), F.col("label").alias("component")).dropDuplicates(["v"])
    rest = known.join(start.select(F.col("sid").alias("v")).distinct(), "v", "left_anti")
    return written(rest.unionByName(now), "jaccard-known")


def representatives(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row of docs for each component, that of the least doc_id, with all columns; rows of one doc_id stay or go together."""
    name = unused(docs, "kept")
    kept = components(docs.select("doc_id", "text"), n, num, den).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
    return docs.join(kept.withColumnRenamed("doc_id", name), docs.doc_id.eqNullSafe(F.col(name)), "left_semi").select(*docs.columns)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(table(spark, sf_dir, "documents").select("doc_id", "text"), 3, 90, 100)

"""Near-duplicate documents by an LSH forest over MinHash signatures.

1. A document's set is the hashes (64 bits) of its distinct word shingles. Documents with equal sets are one node.
2. A node's signature is sorted in `TREES` orders, each beginning with other positions of it. Neighbours in a sorted
   order are candidates by their longest common prefix: two nodes meet if the smallest region (run with a common prefix)
   that holds both has at most `REGION` nodes - so dense regions are read deeper and sparse ones
   less deep - or if they lie within `NEAR` places in any region. Orders are range-partitioned, so that a large group
   of near copies is spread over tasks.
3. Candidates with sizes or signatures too far apart for the similarity are dropped. What is left is confirmed on the full
   sets: first each node's three likeliest partners, then all pairs that are not yet in one component.
4. Components are joined by the confirmed links.
5. Regions of more than `REGION` nodes that still hold several components are compared in full on the sets, in pairs of parts of
   bounded size: every two nodes of different components, once; those of the component with most nodes in a region are dealt once, and
   meet only nodes of the others. Nodes that are found linked are one component from then
   on, so that a part gives at most as many links as it has nodes.

A pair at the similarity of 0.8 shares a prefix of five in a given order with probability 0.33, so it misses all 32
orders with a probability of about 3 in a million; a larger group has many more ways to connect. A run of
neighbours cut by a task boundary in one order is whole in others.

Null or empty texts and texts without words have an empty set and are linked with nothing. Fewer words than a shingle make
one shingle of all. Rows with equal sets (repeated rows too) are in one component; its id is the smallest doc_id, null
ids being larger than any. Columns other than doc_id and text are not read."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from notesight.llm.common import sliced, staged
from notesight.llm.components import connect

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
HASHES, TREES, DEPTH, LEAST = 128, 32, 12, 5
REGION, NEAR = 16, 2
STEP = HASHES // TREES
#: Standard deviations that a signature's estimate may lie below the similarity.
SIGMAS = 4.5
#: Nodes, and bytes of sets, in a part of a region that is compared in full.
PART_NODES, PART_BYTES = 1024, 4 << 20

_WORDS: dict[bytes, int] = {}


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of `width` words, A-Z lower-cased."""
    words = WORD.findall(text.encode().lower()) if text else []
    if not words:
        return np.zeros(0, np.uint64)
    numbers = np.fromiter(map(_word, words), np.uint64, len(words))
    width = min(width, len(words))
    mixed = np.zeros(len(words) - width + 1, np.uint64)
    for j in range(width):
        mixed = _mix(mixed * np.uint64(31) + numbers[j : j + len(mixed)])
    return np.unique(mixed)


def _word(word: bytes) -> int:
    found = _WORDS.get(word)
    if found is None:
        found = xxhash.xxh3_64_intdigest(word)
        if len(_WORDS) < 200_000:
            _WORDS[word] = found
    return found


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_RANDOM = np.random.default_rng(20240229)
_FACTORS = (_RANDOM.integers(0, 1 << 63, HASHES, np.uint64) << np.uint64(1)) | np.uint64(1)
_TERMS = _RANDOM.integers(0, 1 << 63, HASHES, np.uint64)


def signature(members: np.ndarray) -> np.ndarray:
    """16 bits of each of HASHES minima, as big-endian numbers."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(members), 1024):
        part = members[start : start + 1024, None] * _FACTORS + _TERMS
        np.minimum(least, part.min(0), out=least)
    return (_mix(least) >> np.uint64(48)).astype(">u2")


def nodes(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, node (digest of the set; null if empty), signature: one row per document."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, signatures = [], [], []
            for text in batch.column("text"):
                members = shingles(text.as_py(), width)
                sizes.append(len(members))
                digests.append(xxhash.xxh3_128_digest(members.tobytes()) if len(members) else None)
                signatures.append(signature(members).tobytes() if len(members) else None)
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "node", "signature"])
        _WORDS.clear()  # the worker goes on to other stages

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(make, "doc_id long, n_shingles long, node binary, signature binary")


def sets(docs: DataFrame, width: int) -> DataFrame:
    """node and its members (binary, 8 bytes each, sorted)."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            made = [shingles(text.as_py(), width).tobytes() for text in batch.column("text")]
            digests = [xxhash.xxh3_128_digest(m) for m in made]
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(made, pa.binary())], ["node", "members"])
        _WORDS.clear()

    return docs.select("text").mapInArrow(make, "node binary, members binary")


def orders(classes: DataFrame) -> DataFrame:
    """A row per node and tree: tree, key (the first DEPTH positions of its order), node, n_shingles."""
    positions = (np.arange(TREES)[:, None] * STEP + np.arange(DEPTH)) % HASHES

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            n = batch.num_rows
            values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), ">u2").reshape(n, HASHES)
            keys = np.ascontiguousarray(values[:, positions]).view(f"S{2 * DEPTH}").reshape(n, TREES)
            raw = keys.tobytes()
            every = [raw[i : i + 2 * DEPTH] for i in range(0, len(raw), 2 * DEPTH)]
            repeated = pa.array(np.repeat(np.arange(n), TREES))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(TREES, dtype=np.int32), n)), pa.array(every, pa.binary()),
                 batch.column("node").take(repeated), batch.column("n_shingles").take(repeated)],
                ["tree", "key", "node", "n_shingles"],
            )

    return classes.select("signature", "node", "n_shingles").mapInArrow(make, "tree int, key binary, node binary, n_shingles long")


def candidates(sorted_orders: DataFrame, percent: int) -> DataFrame:
    """Pairs a < b of neighbours in the partitions of sorted orders."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.frombuffer(b"".join(batch.column("key").to_pylist()), ">u2").reshape(-1, DEPTH)
            rows = (batch.column("tree").to_numpy(), keys, np.array(batch.column("node").to_pylist(), object), batch.column("n_shingles").to_numpy())
            old = 0
            if before is not None:
                old = len(before[0])
                rows = tuple(np.concatenate([x, y]) for x, y in zip(before, rows))
            yield neighbours(*rows, old, percent)
            before = tuple(x[-REGION:] for x in rows)

    return sorted_orders.mapInArrow(make, "a binary, b binary")


def neighbours(tree, keys, node, size, old: int, percent: int) -> pa.RecordBatch:
    """Candidate pairs of rows in sorted order, the later of which lies at `old` or after."""
    n = len(tree)
    same = (keys[1:] == keys[:-1]) & (tree[1:] == tree[:-1])[:, None]
    prefix = np.where(same.all(1), DEPTH, same.argmin(1)) if n > 1 else np.zeros(0, int)
    sizes = np.zeros((DEPTH + 1, n), np.int64)  # of the region of each depth around each row
    for depth in range(LEAST, DEPTH + 1):
        region = np.concatenate([[0], (prefix < depth).cumsum()])
        sizes[depth] = np.bincount(region)[region]
    common, firsts, seconds = prefix.copy(), [], []
    for apart in range(1, min(REGION, n)):
        if apart > 1:
            common = np.minimum(common[:-1], prefix[apart - 1 :])
        if not (common >= LEAST).any():
            break
        i = np.flatnonzero(common >= LEAST)
        meet = (i + apart >= old) & ((apart <= NEAR) | (sizes[common[i], i] <= REGION))
        i = i[meet]
        small, large = np.minimum(size[i], size[i + apart]), np.maximum(size[i], size[i + apart])
        i = i[100 * small >= percent * large]
        firsts.append(node[i])
        seconds.append(node[i + apart])
    pairs = {(min(a, b), max(a, b)) for a, b in zip(np.concatenate(firsts), np.concatenate(seconds)) if a != b} if firsts else set()
    columns = list(zip(*pairs)) or [(), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], ["a", "b"])


def least_agreement(percent: int) -> float:
    share = percent / 100
    return HASHES * (share - SIGMAS * (share * (1 - share) / HASHES) ** 0.5)


def likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose signatures agree often enough, with that number as `agree`."""
    least = least_agreement(percent)
    of = lambda side: classes.select(F.col("node").alias(side), F.col("signature").alias(f"{side}_signature"))

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, HASHES) for c in ("a_signature", "b_signature"))
            agree = (a == b).sum(1).astype(np.int32)
            keep = pa.array(agree >= least)
            columns = [batch.column("a").filter(keep), batch.column("b").filter(keep), pa.array(agree).filter(keep)]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "agree"])

    both = pairs.join(of("a"), "a").join(of("b"), "b")
    return both.select("a", "b", "a_signature", "b_signature").mapInArrow(make, "a binary, b binary, agree int")


def confirmed(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union."""
    of = lambda side: members.select(F.col("node").alias(side), F.col("members").alias(f"{side}_members"))

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("a_members"), batch.column("b_members")):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            kept = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(kept), batch.column("b").filter(kept)], ["a", "b"])

    both = pairs.select("a", "b").join(of("a"), "a").join(of("b"), "b")
    return both.select("a", "b", "a_members", "b_members").mapInArrow(make, "a binary, b binary")


def regions(parts: DataFrame) -> DataFrame:
    """A row per node and tree: tree, region (hash of the tree and the first LEAST positions of its order), node, group, n_shingles."""
    positions = (np.arange(TREES)[:, None] * STEP + np.arange(LEAST)) % HASHES

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), ">u2").reshape(n, HASHES).astype(np.uint64)
            mixed = np.tile(np.arange(1, TREES + 1, dtype=np.uint64), (n, 1))
            for j in range(LEAST):
                mixed = _mix(mixed * np.uint64(31) + values[:, positions[:, j]])
            repeated = pa.array(np.repeat(np.arange(n), TREES))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(TREES, dtype=np.int32), n)), pa.array(mixed.ravel().view(np.int64)),
                 *[batch.column(c).take(repeated) for c in ("node", "group", "n_shingles")]],
                ["tree", "region", "node", "group", "n_shingles"],
            )

    of_nodes = parts.select("signature", "node", F.xxhash64("top").alias("group"), "n_shingles")
    return of_nodes.mapInArrow(make, "tree int, region long, node binary, group long, n_shingles long")


def within_regions(texts: DataFrame, parts: DataFrame, width: int, percent: int) -> DataFrame | None:
    """Links a, b between the components (`top`) of `parts` (node, rank, n_shingles, signature, top) from all pairs of nodes of different
    components in regions of more than REGION nodes; None if no such region holds two components."""
    bytes_of = F.col("n_shingles") * 8 + 2 * HASHES
    many = staged(
        regions(parts).groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.min("group").alias("low"), F.max("group").alias("high"))
        .filter((F.col("n") > REGION) & (F.col("low") < F.col("high"))).select("region"),
        "regions",
    )
    if not many.limit(1).count():
        return None
    inside = staged(regions(parts).join(many, "region"), "inside")
    # no pair within the component that has most nodes of a region: these need only one part each
    counts = inside.groupBy("region", "group").agg(F.count(F.lit(1)).alias("n"), F.sum(bytes_of).alias("size"))
    parts_for = lambda n, size: F.ceil(F.greatest(n / PART_NODES, size / PART_BYTES)).cast("int")
    most = F.max(F.struct("n", "size", "group"))
    large = counts.groupBy("region").agg(F.sum("n").alias("n"), F.sum("size").alias("size"), most.alias("most")).select(
        "region", F.col("most.group").alias("major"), parts_for(F.col("most.n"), F.col("most.size")).alias("n_major"),
        parts_for(F.col("n") - F.col("most.n"), F.col("size") - F.col("most.size")).alias("n_minor"),
    )
    one = F.struct("tree", "region", (F.col("group") == F.col("major")).alias("is_major"), "n_major", "n_minor")
    at = staged(inside.join(large, "region").groupBy("node").agg(F.collect_list(one).alias("at")), "at")
    ranks = at.join(parts.select("node", "rank"), "node").select("rank").distinct()
    wanted = texts.join(ranks, texts["doc_id"].eqNullSafe(F.col("rank")), "left_semi")
    members = staged(sets(wanted, width).join(at.select("node"), "node", "left_semi").dropDuplicates(["node"]), "sets")
    rows = at.join(members, "node").join(parts.select("node", "signature", "top"), "node")
    # parts of the minor components are numbered first; each meets every part, those of the major one only them
    minor = F.pmod(F.xxhash64("node"), F.col("one.n_minor")).cast("int")
    major = F.col("one.n_minor") + F.pmod(F.xxhash64("node"), F.col("one.n_major")).cast("int")
    others = F.col("one.n_minor") + F.when(F.col("one.is_major"), 0).otherwise(F.col("one.n_major"))
    dealt = (
        rows.select("*", F.explode("at").alias("one"))
        .withColumn("part", F.when(F.col("one.is_major"), major).otherwise(minor))
        .withColumn("other", F.explode(F.sequence(F.lit(0), others - 1)))
        .select(
            F.col("one.region").alias("region"), F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"),
            "part", F.col("one.tree").alias("tree"), "top", "signature", "members",
            F.transform("at", lambda r: r["tree"]).alias("trees"), F.transform("at", lambda r: r["region"]).alias("regions"),
        )
    )
    return dealt.groupBy("region", "x", "y").applyInArrow(lambda rows: linked_parts(rows, percent), "a binary, b binary")


def linked_parts(rows: pa.Table, percent: int) -> pa.Table:
    """Links between the components of two parts of a region, or within one part. Pairs that are in one region of an earlier
    tree too are left to that."""
    rows = rows.sort_by("part")
    n, x, y, tree = rows.num_rows, rows["x"][0].as_py(), rows["y"][0].as_py(), rows["tree"][0].as_py()
    firsts = int((rows["part"].to_numpy() == x).sum())
    tops = np.array(rows["top"].to_pylist(), object)
    label = np.unique(tops, return_inverse=True)[1]
    signatures = np.frombuffer(b"".join(rows["signature"].to_pylist()), np.uint16).reshape(n, HASHES)
    parts = [np.frombuffer(m, np.uint64) for m in rows["members"].to_pylist()]
    size = np.array([len(m) for m in parts])
    starts = size.cumsum() - size
    ids = np.unique(np.concatenate(parts), return_inverse=True)[1]
    mark = np.zeros(len(ids), bool)
    earlier = np.zeros((n, TREES), np.int64)
    for i, (trees, found) in enumerate(zip(rows["trees"].to_pylist(), rows["regions"].to_pylist())):
        earlier[i, trees] = found
    earlier = earlier[:, :tree]
    least, a, b = least_agreement(percent), [], []
    for i in range(firsts):
        begin = i + 1 if x == y else firsts
        small, large = np.minimum(size[begin:], size[i]), np.maximum(size[begin:], size[i])
        j = begin + np.flatnonzero((label[begin:] != label[i]) & (100 * small >= percent * large))
        own = np.flatnonzero(earlier[i])
        j = j[~(earlier[j][:, own] == earlier[i, own]).any(1)]
        j = j[(signatures[j] == signatures[i]).sum(1) >= least]
        if not len(j):
            continue
        mark[ids[starts[i] : starts[i] + size[i]]] = True
        each = size[j]
        offsets = each.cumsum() - each
        both = np.add.reduceat(mark[ids[np.repeat(starts[j] - offsets, each) + np.arange(each.sum())]], offsets, dtype=np.int64)
        mark[ids[starts[i] : starts[i] + size[i]]] = False
        j = j[100 * both >= percent * (size[i] + each - both)]
        met, at = np.unique(label[j], return_index=True)
        a += [tops[i]] * len(met)
        b += tops[j[at]].tolist()
        label[np.isin(label, met)] = label[i]
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def groups(docs: DataFrame, width: int = 2, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (doc_id = component_id) of every row of (doc_id, text)."""
    rows = staged(nodes(docs, width), "nodes")
    classes = staged(
        rows.filter("node is not null").groupBy("node").agg(
            F.min("doc_id").alias("rank"), F.max("n_shingles").alias("n_shingles"), F.min("signature").alias("signature")
        ),
        "classes",
    )
    ordered = orders(classes).repartitionByRange("tree", "key", "node").sortWithinPartitions("tree", "key", "node")
    pairs = candidates(ordered, percent).distinct()
    probable = staged(likely(pairs, classes, percent), "likely")
    wanted = probable.select(F.col("a").alias("node")).union(probable.select("b")).distinct()
    needed = staged(wanted.join(classes.select("node", "rank"), "node"), "wanted")
    texts = texts_of(docs)
    texts = texts.join(needed.select("rank").distinct(), texts["doc_id"].eqNullSafe(F.col("rank")), "left_semi")
    members = staged(sets(texts, width).dropDuplicates(["node"]), "sets")

    sides = probable.select("a", "b", "agree", F.col("a").alias("node")).union(probable.select("a", "b", "agree", "b"))
    best = Window.partitionBy("node").orderBy(F.desc("agree"), F.xxhash64("a", "b"))
    first = staged(sides.withColumn("place", F.row_number().over(best)).filter("place <= 3").select("a", "b").distinct(), "first")
    links = staged(confirmed(first, members, percent), "links")
    roots = connect(links, needed)
    root_of = lambda side: roots.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root"))
    rest = (
        probable.join(first, ["a", "b"], "left_anti")
        .join(root_of("a"), "a").join(root_of("b"), "b")
        .filter("a_root <> b_root")
    )
    more = confirmed(rest, members, percent)
    between = more.join(root_of("a"), "a").join(root_of("b"), "b").select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))
    tops = roots.filter("node = root").select("node", F.col("root_rank").alias("rank"))
    joined = connect(between, tops).select(F.col("node").alias("root"), F.col("root").alias("top"), F.col("root_rank").alias("top_rank"))
    ids = roots.select("node", "root").join(joined, "root").select("node", "top", "top_rank")
    last = F.lit((1 << 63) - 1)
    parts = staged(
        classes.join(ids, "node", "left").select(
            "node", "rank", "n_shingles", "signature", F.coalesce("top", "node").alias("top"), F.coalesce("top_rank", "rank", last).alias("top_rank")
        ),
        "parts",
    )
    dense = within_regions(texts_of(docs), parts, width, percent)
    if dense is None:
        known = parts.withColumn("component", F.col("top_rank"))
    else:
        dense = staged(dense.distinct(), "links")
        met = dense.select(F.col("a").alias("node")).union(dense.select("b")).distinct()
        tops = parts.filter("node = top").select("node", F.col("top_rank").alias("rank")).join(met, "node", "left_semi")
        joined = connect(dense, tops).select(F.col("node").alias("top"), "root_rank")
        known = parts.join(joined, "top", "left").withColumn("component", F.coalesce("root_rank", "top_rank"))
    known = staged(known.select("node", F.nullif("component", last).alias("component")), "components")
    component = F.coalesce("component", "doc_id")
    return rows.select("doc_id", "n_shingles", "node").join(known, "node", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept")
    )


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` with one document of each group left: that with the smallest id. Rows without an id stay
    only if they are linked with nothing that has one."""
    found = groups(docs, width, percent)
    gone = found.filter(~F.col("kept") & F.col("component_id").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return docs.join(gone, docs["doc_id"] == gone["doc_id"], "left_anti")

"""Jaccard join of word shingles with signature trees.

Two texts link when 100 * |A & B| >= 75 * |A | B| for their sets of 5-word shingles; classes are the connected components.

1. Each text becomes a sorted set of 64-bit shingle hashes; equal sets are one node, so copies never meet again.
2. Nodes that may link must meet under a key, one of their KEYS least shingles. The least KEYS elements of a union of two
   linked sets are each shared with a chance of 0.75, so two linked nodes miss each other with a chance under 0.42 ** 32
   (about 1e-12), and never where a set has at most KEYS elements. Hot shingles, counted over all texts, are no keys for
   a node unless they are 65 in 100 of it: up to there more cold keys, at most 83, keep that bound for what is left, and
   neither a common line nor a template that is the smaller part of its texts gathers a crowd.
3. Under each key, nodes hold a bitmap of their shingles. A signature tree joins them: inner nodes hold OR-combined
   bitmaps and size ranges, and pairs of tree nodes are dropped when the most overlap they allow is too small. Pairs of
   leaves left are dropped the same way. Of its possible partners each node is first compared with the least one. A key
   of more than BLOCK nodes is dealt to several tasks by hash, each a tree of its own, and all its nodes go on.
4. Those pairs are compared on whole sets; true ones are links, and classes so far are their components. Then each class
   of more than BIG nodes is cut into blocks, and the strangers that share a key with any of its nodes are sent to each
   block: the trees of both sides are traversed together and what is left is compared on whole sets. A class's nodes
   travel once, not once for each key, and no task holds more than a block of them.
5. What is not in such a class meets again under its keys, heavy keys as pairs of blocks: where nodes hang together by
   possible pairs but not yet by links, each is compared with one more partner outside its class, drawn by hash, TURNS
   times; what is still apart is then compared in full, so no link between different classes is lost.
6. Classes come from label propagation with pointer jumping, each round written to the shared folder.

Defined results: null and empty texts have no shingles and form classes alone; a text of 1 to 4 words has one shingle;
repeated rows share a class; rows with a null doc_id take the class of their set, or null; an empty table gives no rows;
other columns are ignored. Of nodes with equal ties the least digest goes first, so results repeat. Very long: a text is
held whole by one worker with some 30 to 60 bytes for each of its own; its set travels as eight bytes a shingle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.scratch import release
from .common import Chunk, NOT_SPACE, Slices, chunks, key_of, materialize, mix, small_batches, texts_of, unused, words

N, PERCENT = 5, 75
KEYS, HOT_DEPTH, HOT_SHARE, MISS = 32, 64, 0.65, 1e-12
HOT_COUNT, HOT_PART = 12, 2.4e-4  # a shingle is hot if so many texts, and this part of all, have it among their least HOT_DEPTH
WIDTH, LEAF, FAN, TURNS = 1024, 32, 8, 2
BIG, BLOCK, BLOCK_SHINGLES = 256, 1024, 1_000_000  # nodes of a big class; nodes and shingles of a block
SENT, SENT_ROWS = 1_000_000, 200_000  # ids (8 bytes), and rows of two nodes (32 bytes), that are broadcast at most


def shingle_sets(c: Chunk, n: int = N) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a chunk."""
    ws = words(c, NOT_SPACE)
    h, at = ws.grams(n)
    first, count = np.searchsorted(at, ws.first), np.diff(ws.first)
    out = []
    for i in range(c.n):
        own = h[first[i] : first[i + 1]]
        if not len(own) and count[i]:
            one = Slices(ws.hashes[ws.first[i] : ws.first[i + 1]])
            own = one.hash(np.zeros(1, np.int64), np.array([count[i]]))
        own = np.sort(own)
        out.append(own[np.append(True, own[1:] != own[:-1])] if len(own) > 1 else own)
    return out


def node_of(s: np.ndarray) -> bytes:
    """16 bytes that stand for a set."""
    if not len(s):
        return b""
    return mix(s).sum(dtype=np.uint64).tobytes() + mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).tobytes()


def width_of(n: int) -> int:
    return WIDTH << max(0, math.ceil(math.log2(n / 512))) if n > 512 else WIDTH


def signature(s: np.ndarray) -> bytes:
    """A bitmap of the low bits of the hashes; at least two bits for each element."""
    w = width_of(len(s))
    bits = np.zeros(w, bool)
    bits[(s & np.uint64(w - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def n_keys(hot_share: float) -> int:
    """How many of the least cold shingles are keys. A set that links with one of this hot share shares at least
    1 - 0.25 / (1 - hot_share) of their cold union; the count keeps the chance of a miss under 1e-12."""
    return max(KEYS, math.ceil(math.log(MISS) / math.log((1 - PERCENT / 100) / (1 - hot_share))))


def keys_of(s: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """The shingles under which a set meets others. Of two sets the one of the smaller hot share has the fewer cold keys,
    which are enough for the pair; the other has as many at least."""
    prefix = len(s) - -(-PERCENT * len(s) // 100) + 1
    if not len(hot):
        return s[: min(KEYS, prefix)]
    at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
    is_hot = hot[at] == s
    cold = s[~is_hot][: n_keys(min(is_hot.mean(), HOT_SHARE))]
    if is_hot.sum() >= HOT_SHARE * len(s):
        return np.union1d(cold, s[: min(KEYS, prefix)])
    return cold


def row_key(documents: DataFrame) -> Column:
    """16 bytes for each different row. Maps have no hash: they count as their sorted entries, within other values as JSON."""

    def plain(f) -> Column:
        if f.dataType.typeName() == "map" and "map<" not in f.dataType.valueType.simpleString() + f.dataType.keyType.simpleString():
            return F.array_sort(F.map_entries(f.name))
        return F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name)

    return key_of(*(plain(f) for f in documents.schema))


def _describe(batches: Iterator[pa.RecordBatch], hot) -> Iterator[pa.RecordBatch]:
    for c in chunks(batches):
        sets = shingle_sets(c)
        keys = [keys_of(s, hot.value) if len(s) else s for s in sets]
        yield pa.RecordBatch.from_arrays(
            [c.column("doc_id"), c.column("row"), pa.array([len(s) for s in sets], pa.int64()), pa.array([node_of(s) for s in sets], pa.binary()), pa.array([k.view(np.int64) for k in keys], pa.list_(pa.int64())), pa.array([signature(s) if len(s) else b"" for s in sets], pa.binary())],
            ["doc_id", "row", "n", "node", "keys", "sig"],
        )


def _low(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least shingles of texts and how many texts have them, summed up within a chunk."""
    for c in chunks(batches):
        key, n = np.unique(np.concatenate([s[:HOT_DEPTH] for s in shingle_sets(c)]), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["key", "texts"])


def hot_shingles(docs: DataFrame) -> np.ndarray:
    """Shingles that many of all texts have among their least ones: at most HOT_DEPTH / HOT_PART numbers."""
    texts = docs.select("text").where("text <> ''")
    least = max(HOT_COUNT, math.ceil(HOT_PART * texts.count()))
    low = texts.mapInArrow(_low, "key long, texts long")
    rows = low.groupBy("key").agg(F.sum("texts").alias("n")).where(F.col("n") >= least).select("key").toPandas()
    return np.sort(rows["key"].to_numpy().astype(np.int64).view(np.uint64))


def _fold(m: np.ndarray, words64: int) -> np.ndarray:
    while m.shape[1] > words64:
        half = m.shape[1] // 2
        m = m[:, :half] | m[:, half:]
    return m


class Bucket:
    """Nodes under one or more keys: sizes and bitmaps."""

    def __init__(self, n: np.ndarray, sigs: list[bytes]):
        self.n = n
        self.width = np.array([len(s) // 8 for s in sigs])
        self.row = np.zeros(len(n), np.int64)
        self.maps = {}
        for w in np.unique(self.width):
            own = np.flatnonzero(self.width == w)
            self.row[own] = np.arange(len(own))
            self.maps[int(w)] = np.frombuffer(b"".join(sigs[i] for i in own), np.uint64).reshape(len(own), int(w))

    def possible(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs allow enough overlap: elements on bits that the other lacks are surely not shared."""
        ok = PERCENT * np.maximum(self.n[i], self.n[j]) <= 100 * np.minimum(self.n[i], self.n[j])
        todo = np.flatnonzero(ok)
        for a in self.maps:
            for b in self.maps:
                at = todo[(self.width[i[todo]] == a) & (self.width[j[todo]] == b)]
                for k in range(0, len(at), 8192):
                    p = at[k : k + 8192]
                    w = min(a, b)
                    x, y = _fold(self.maps[a][self.row[i[p]]], w), _fold(self.maps[b][self.row[j[p]]], w)
                    most = np.minimum(self.n[i[p]] - np.bitwise_count(x & ~y).sum(1, dtype=np.int64), self.n[j[p]] - np.bitwise_count(y & ~x).sum(1, dtype=np.int64))
                    ok[p] = (100 + PERCENT) * most >= PERCENT * (self.n[i[p]] + self.n[j[p]])
        return ok

    def tree(self, own: np.ndarray, depth: int = 1) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """At least `depth` levels from leaves to root over nodes sorted by size: bitmaps, least and greatest size, and
        greatest excess of elements over bits."""
        bits = np.stack([_fold(self.maps[int(self.width[i])][self.row[i]][None], WIDTH // 64)[0] for i in own])
        n = self.n[own]
        level, out, fan = (bits, n, n, n - np.bitwise_count(bits).sum(1, dtype=np.int64)), [], LEAF
        while len(level[1]) > 1 or len(out) < depth:
            cut = np.arange(0, len(level[1]), fan)
            level = (np.bitwise_or.reduceat(level[0], cut), np.minimum.reduceat(level[1], cut), np.maximum.reduceat(level[2], cut), np.maximum.reduceat(level[3], cut))
            out.append(level)
            fan = FAN
        return out

    def join(self, own: np.ndarray, others: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of all possible pairs among the given nodes, or of one of them and one of the others, by dual traversal
        from the roots."""
        own = own[np.argsort(self.n[own], kind="stable")]
        one = others is None
        others = own if one else others[np.argsort(self.n[others], kind="stable")]
        left = self.tree(own)
        right = left if one else self.tree(others, len(left))
        left = left if len(left) == len(right) else self.tree(own, len(right))
        a = b = np.zeros(1, np.int64)
        for depth in range(len(left) - 1, -1, -1):
            (p_bits, p_least, p_most, p_excess), (q_bits, q_least, q_most, q_excess) = left[depth], right[depth]
            keep = np.zeros(len(a), bool)
            for k in range(0, len(a), 8192):
                p, q = a[k : k + 8192], b[k : k + 8192]
                shared = np.bitwise_count(p_bits[p] & q_bits[q]).sum(1, dtype=np.int64)
                most = np.minimum(shared + np.minimum(p_excess[p], q_excess[q]), np.minimum(p_most[p], q_most[q]))
                keep[k : k + 8192] = ((100 + PERCENT) * most >= PERCENT * (p_least[p] + q_least[q])) & (100 * p_most[p] >= PERCENT * q_least[q]) & (100 * q_most[q] >= PERCENT * p_least[p])
            a, b = a[keep], b[keep]
            if not depth:
                break
            x = (a[:, None] * FAN + np.arange(FAN))[:, :, None] + np.zeros((1, 1, FAN), np.int64)
            y = (b[:, None] * FAN + np.arange(FAN))[:, None, :] + np.zeros((1, FAN, 1), np.int64)
            x, y = x.ravel(), y.ravel()
            ok = (x < len(left[depth - 1][1])) & (y < len(right[depth - 1][1])) & ((x <= y) | (not one))
            a, b = x[ok], y[ok]
        step = np.arange(LEAF)
        for k in range(0, len(a), 64):
            x = (a[k : k + 64, None] * LEAF + step)[:, :, None] + np.zeros((1, 1, LEAF), np.int64)
            y = (b[k : k + 64, None] * LEAF + step)[:, None, :] + np.zeros((1, LEAF, 1), np.int64)
            x, y = x.ravel(), y.ravel()
            ok = (x < len(own)) & (y < len(others)) & ((x < y) | (not one))
            i, j = own[x[ok]], others[y[ok]]
            ok = self.possible(i, j)
            yield i[ok], j[ok]

    def pairs(self, group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of all possible pairs of equal group; groups are sorted. Small ones side by side, large ones by tree."""
        start = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        size = np.diff(np.append(start, len(group)))
        run = np.repeat(np.arange(len(start)), size)
        small = size[run] <= 2 * LEAF
        for k in range(1, int(size[size <= 2 * LEAF].max(initial=0))):
            i = np.flatnonzero(small[:-k] & (run[k:] == run[:-k]))
            ok = self.possible(i, i + k)
            yield i[ok], i[ok] + k
        for g in np.flatnonzero(size > 2 * LEAF):
            yield from self.join(np.arange(start[g], start[g] + size[g]))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables that hold whole runs of equal groups, from batches sorted by their first column."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        key = np.asarray(batch.column(0))
        if not len(key):
            continue
        cut = int(np.searchsorted(key, key[-1]))
        if rest and (cut or rest[-1].column(0)[-1].as_py() != key[0]):
            yield pa.Table.from_batches([*rest, batch.slice(0, cut)]).combine_chunks()
            rest = []
        elif cut:
            yield pa.Table.from_batches([batch.slice(0, cut)])
        rest.append(batch.slice(cut))
    if rest:
        yield pa.Table.from_batches(rest).combine_chunks()


def _bucket(t: pa.Table) -> tuple[np.ndarray, np.ndarray, Bucket]:
    return t.column("group").to_numpy(), t.column("node").to_numpy(zero_copy_only=False), Bucket(t.column("n").to_numpy(), t.column("sig").to_pylist())


def _first_partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In each group, for each node y its least possible partner x (null if it has none below it), with `more` where
    three or more nodes hang together or the key has further groups. Other nodes without partners are left out."""
    for t in _groups(batches):
        group, nodes, bucket = _bucket(t)
        key, split = t.column("key").to_numpy(), t.column("split").to_numpy(zero_copy_only=False).astype(bool)
        order = np.argsort(nodes, kind="stable")
        rank = np.empty(len(nodes), np.int64)
        rank[order] = np.arange(len(nodes))
        best, some, degree = np.full(len(nodes), len(nodes)), np.arange(len(nodes)), np.zeros(len(nodes), np.int64)
        for i, j in bucket.pairs(group):
            swap = rank[i] > rank[j]
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            np.minimum.at(best, j, rank[i])
            some[i], some[j] = j, i
            degree += np.bincount(i, minlength=len(nodes)) + np.bincount(j, minlength=len(nodes))
        has = best < len(nodes)
        more = (degree > 1) | ((degree == 1) & (degree[some] > 1)) | split
        y = np.flatnonzero(has | more)
        if len(y):
            x = [nodes[order[best[k]]] if has[k] else None for k in y.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(key[y]), pa.array(x, pa.binary()), pa.array(nodes[y], pa.binary()), pa.array(more[y])], ["key", "x", "y", "more"])


def _other_partners(batches: Iterator[pa.RecordBatch], turn: int | None) -> Iterator[pa.RecordBatch]:
    """Possible pairs of different labels: with a turn, for each node the one of least hash; without, all of them. A pair
    that meets under several keys counts under the least of them alone."""
    for t in _groups(batches):
        group, nodes, bucket = _bucket(t)
        key = t.column("key").to_numpy()
        _, label = np.unique(t.column("label").to_numpy(zero_copy_only=False), return_inverse=True)
        homes = t.column("homes").to_pylist()
        table = np.full((len(key), max(map(len, homes))), np.iinfo(np.int64).max)
        for k, h in enumerate(homes):
            table[k, : len(h)] = h
        own = np.array([int.from_bytes(x[:8], "little") for x in nodes], np.uint64)
        best, partner = np.full(len(nodes), np.iinfo(np.uint64).max, np.uint64), np.full(len(nodes), -1)

        def here(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            ok = np.zeros(len(i), bool)
            for k in range(0, len(i), 2048):
                a, b = table[i[k : k + 2048]], table[j[k : k + 2048]]
                shared = (a[:, :, None] == b[:, None, :]).any(2)
                ok[k : k + 2048] = np.where(shared, a, np.iinfo(np.int64).max).min(1) == key[i[k : k + 2048]]
            return ok

        def batch(i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
            ok = here(i, j)
            i, j = i[ok], j[ok]
            swap = nodes[i] > nodes[j]
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            return pa.RecordBatch.from_arrays([pa.array(nodes[i], pa.binary()), pa.array(nodes[j], pa.binary())], ["x", "y"])

        for i, j in bucket.pairs(group):
            differ = label[i] != label[j]
            i, j = i[differ], j[differ]
            if not len(i):
                continue
            if turn is None:
                yield batch(i, j)
                continue
            draw = mix(mix(own[i]) + mix(own[j]) + np.uint64(turn))
            for a, b in ((i, j), (j, i)):
                np.minimum.at(best, a, draw)
                won = draw == best[a]
                partner[a[won]] = b[won]
        drawn = np.flatnonzero(partner >= 0)
        if len(drawn):
            yield batch(drawn, partner[drawn])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for c in chunks(batches):
        sets = shingle_sets(c)
        yield pa.RecordBatch.from_arrays([pa.array([node_of(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "shingles"])


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    shared = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return 100 * shared >= PERCENT * (len(a) + len(b) - shared)


def _read(shingles: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.uint64) for x in shingles]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = np.array([similar(a, b) for a, b in zip(_read(batch.column(2)), _read(batch.column(3)), strict=True)], bool)
        yield batch.select(["x", "y"]).filter(pa.array(ok))


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each stranger that comes to a block of a class, one link to a node of the block, if it has any. Rows are sorted
    by group, the block's own nodes first; strangers pass by in batches."""
    at, block = None, []
    for batch in batches:
        group, stranger = np.asarray(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        rows = list(zip(batch.column(2).to_pylist(), _read(batch.column(3)), strict=True))
        cut = np.flatnonzero(np.append(True, (group[1:] != group[:-1]) | (stranger[1:] != stranger[:-1]))) if len(rows) else []
        for lo, hi in zip(cut, np.append(cut[1:], len(rows)), strict=True):
            if not stranger[lo]:
                block = (block if group[lo] == at else []) + rows[lo:hi]
                at = group[lo]
            elif group[lo] == at:
                for k in range(lo, hi, BLOCK):
                    found = _first_links(block, rows[k : min(k + BLOCK, hi)])
                    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.binary()), pa.array([y for _, y in found], pa.binary())], ["x", "y"])


def _first_links(block: list[tuple[bytes, np.ndarray]], others: list[tuple[bytes, np.ndarray]]) -> list[tuple[bytes, bytes]]:
    both, m = block + others, len(block)
    bucket, found = Bucket(np.array([len(s) for _, s in both]), [signature(s) for _, s in both]), {}
    for i, j in bucket.join(np.arange(m), np.arange(m, len(both))):
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            if b not in found and similar(both[a][1], both[b][1]):
                found[b] = a
    return [(both[a][0], both[b][0]) for b, a in found.items()]


def _whole_sets(docs: DataFrame, nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """node and shingles of the distinct nodes in `ends`, from one text of each."""
    ids = materialize(ends.join(nodes, "node").select("doc_id").distinct(), "ids")
    own = docs.join(F.broadcast(ids) if ids.count() <= SENT else ids, "doc_id", "left_semi").select("text")
    return materialize(own.mapInArrow(_sets, "node binary, shingles binary").dropDuplicates(["node"]), "sets")


def _true_links(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (x, y) whose whole sets are similar enough."""
    sets = _whole_sets(docs, nodes, pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct())
    both = pairs.join(sets.withColumnsRenamed({"node": "x", "shingles": "a"}), "x").join(sets.withColumnsRenamed({"node": "y", "shingles": "b"}), "y")
    return both.select("x", "y", "a", "b").mapInArrow(_verify, "x binary, y binary")


def _big_classes(docs: DataFrame, nodes: DataFrame, crowd: DataFrame, label: DataFrame, n_labels: int) -> tuple[DataFrame | None, DataFrame | None]:
    """Links between nodes of big classes and the strangers under their keys, and those nodes; None if no class is big.

    crowd: key and node. What travels is each such node once, and each stranger once to each block of a class.
    """
    parts = int(crowd.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    big = materialize(label.groupBy("label").count().where(F.col("count") > BIG).select(F.col("label").alias("big")), "big")
    n_big = big.count()
    if not n_big:
        return None, None
    own = crowd.select("node").distinct().join(sent(label.withColumnRenamed("label", "big"), n_labels), "node").join(sent(big, n_big), "big", "left_semi")
    own = materialize(own.join(nodes, "node").select("big", "node", "n"), "own")
    n_own = own.count()
    under = crowd.join(sent(own.select("node", "big"), n_own), "node").select("key", "big").distinct()
    here = crowd.join(sent(label, n_labels), "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    strangers = materialize(here.join(under, (here["key"] == under["key"]) & (here["label"] != under["big"])).select("big", "node").distinct(), "strangers")
    blocks = own.groupBy("big").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    sets = _whole_sets(docs, nodes, own.select("node").union(strangers.select("node")).distinct())
    group = F.xxhash64("big", "block").alias("group")
    mine = own.join(blocks, "big").withColumn("block", F.pmod(F.xxhash64("node"), "blocks")).select("node", group, F.lit(False).alias("stranger"))
    theirs = strangers.join(blocks, "big").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select("node", group, F.lit(True).alias("stranger"))
    dealt = mine.union(theirs).join(sets, "node").select("group", "stranger", "node", "shingles")
    found = dealt.repartition(parts, "group").sortWithinPartitions("group", "stranger").mapInArrow(_block_links, "x binary, y binary")
    return materialize(found, "links"), own.select("node")


def sent(df: DataFrame, rows: int) -> DataFrame:
    """df with a broadcast hint if it has few rows; else the join shuffles."""
    return F.broadcast(df) if rows <= SENT_ROWS else df


def components(edges: DataFrame) -> tuple[DataFrame, int]:
    """node and label (the least node of its component) for all nodes of the edges (x, y), and their number.

    Every round each node takes the least label among its neighbours' labels, then the label of its label.
    """
    two = edges.union(edges.select("y", "x").toDF("x", "y"))
    labels = materialize(two.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    held, n = labels, labels.count()
    while True:
        near = two.join(sent(labels.withColumnRenamed("node", "y"), n), "y").groupBy(F.col("x").alias("node")).agg(F.min("label").alias("m"))
        least = near.join(sent(labels, n), "node").select("node", F.least("label", "m").alias("new"), F.col("label").alias("old"))
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("next"))
        new = materialize(least.join(sent(jump, n), "new", "left").select("node", "old", F.least("new", "next").alias("label")), "labels")
        release(held)
        held, labels = new, new.select("node", "label")
        if not new.where("label <> old").limit(1).count():
            return labels, n


def joined(label: DataFrame, n: int, links: DataFrame) -> tuple[DataFrame, int]:
    """The labels after further links: components of the labels that they connect, so that old links are not read again."""
    name = F.coalesce("label", "node").alias("label")
    ends = links.select(F.explode(F.array("x", "y")).alias("node")).distinct().join(sent(label, n), "node", "left_anti").select("node", F.col("node").alias("label"))
    both = links
    for end in ("x", "y"):
        both = both.withColumnRenamed(end, "node").join(sent(label, n), "node", "left").withColumn("label", name).drop("node").withColumnRenamed("label", end)
    merged, m = components(both.where("x <> y").distinct())
    new = merged.select(F.col("node").alias("label"), F.col("label").alias("new"))
    out = materialize(label.union(ends).join(sent(new, m), "label", "left").select("node", F.coalesce("new", "label").alias("label")), "labels")
    return out, out.count()


def _block_pairs() -> Column:
    """The groups that a node under `key` goes to: the key itself, or where that is cut into `blocks`, one for each other
    block, so that any two nodes of the key meet."""
    own = F.pmod(F.xxhash64("node", "key"), "blocks")
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda x: x != own)
    pair = F.transform(others, lambda x: F.xxhash64("key", F.least(own, x), F.greatest(own, x)))
    return F.when(F.col("blocks") > 1, pair).otherwise(F.array("key"))


def classes(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of each document row."""
    return row_classes(documents).drop("row", "class")


def row_classes(documents: DataFrame) -> DataFrame:
    """classes() with the row_key() of each row, and `class`: the node that names its class, which no other class has,
    whereas classes can share a component_id if a doc_id has unlike texts."""
    with small_batches(documents.sparkSession):  # a row may hold two whole sets
        return _row_classes(documents)


def _row_classes(documents: DataFrame) -> DataFrame:
    spark: SparkSession = documents.sparkSession
    docs = texts_of(documents, F.col("doc_id").cast("long").alias("doc_id"), row_key(documents).alias("row"))
    hot = spark.sparkContext.broadcast(hot_shingles(docs))
    all_ = materialize(docs.mapInArrow(lambda b: _describe(b, hot), "doc_id long, row binary, n long, node binary, keys array<long>, sig binary"), "shingles")
    real = all_.where("n > 0")
    nodes = materialize(real.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n")).where("doc_id is not null"), "nodes")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    once = real.join(nodes.drop("n"), ["node", "doc_id"], "left_semi").dropDuplicates(["node"])
    keyed = once.select("node", "n", F.explode("keys").alias("key"))
    shared = keyed.join(keyed.groupBy("key").count().where("count > 1"), "key")
    under = materialize(shared.join(once.select("node", "sig"), "node"), "under")
    blocks = F.ceil(F.col("count") / BLOCK)
    own_group = F.when(blocks > 1, F.xxhash64("key", F.pmod(F.xxhash64("node", "key"), blocks))).otherwise(F.col("key"))
    alone = under.select(own_group.alias("group"), "key", "node", "n", "sig", (blocks > 1).alias("split"))
    first = materialize(alone.repartition(parts, "group").sortWithinPartitions("group").mapInArrow(_first_partners, "key long, x binary, y binary, more boolean"), "pairs")
    pairs = first.where("x is not null").select("x", "y").distinct()
    label, n_labels = components(materialize(_true_links(docs, nodes, pairs), "links"))

    crowd = first.where("more").select("key", F.col("y").alias("node"))
    more, done = _big_classes(docs, nodes, crowd, label, n_labels)
    if done is not None:
        crowd = crowd.join(sent(done, done.count()), "node", "left_anti")
        if more.limit(1).count():
            label, n_labels = joined(label, n_labels, more)
    homes = crowd.groupBy("node").agg(F.sort_array(F.collect_set("key")).alias("homes"))  # at most KEYS + n_keys(HOT_SHARE)
    crowd = materialize(crowd.join(homes, "node").join(under.drop("count"), ["key", "node"]), "crowd")
    tried = pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    n_crowd = crowd.count()
    for turn in [*range(1, TURNS + 1), None] if n_crowd else []:
        labelled = crowd.join(sent(label, n_labels), "node", "left").withColumn("label", F.coalesce("label", "node"))
        split = labelled.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.count("*").alias("count")).where("a <> b").select("key", F.ceil(F.col("count") / BLOCK).alias("blocks"))
        rest = labelled.join(sent(split, n_crowd), "key").withColumn("group", F.explode(_block_pairs())).select("group", "key", "node", "n", "sig", "label", "homes")
        dealt = rest.repartition(parts, "group").sortWithinPartitions("group")
        again = dealt.mapInArrow(lambda b, turn=turn: _other_partners(b, turn), "x binary, y binary").distinct()
        again = materialize(again.join(tried, ["x", "y"], "left_anti"), "again")
        if not again.limit(1).count():
            continue
        more = materialize(_true_links(docs, nodes, again), "links")
        if more.limit(1).count():
            label, n_labels = joined(label, n_labels, more)
        tried = tried.union(again)

    least = nodes.join(sent(label, n_labels), "node", "left").withColumn("label", F.coalesce("label", "node"))
    ids = least.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    final = least.join(ids, "label").select("node", "component_id", F.col("label").alias("class"))
    return all_.select("doc_id", "row", "n", "node").join(final, "node", "left").select("doc_id", "row", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "class")


def keep_one(documents: DataFrame) -> DataFrame:
    """One row of each class, one with the least doc_id, with all columns; texts without words and rows with a null
    doc_id all stay, but rows that are equal in every column once.

    What goes is few ids: they are broadcast up to a number, so texts are not shuffled; beyond it the join shuffles.
    """
    key = unused(documents, "row")
    judged = materialize(row_classes(documents).where("n_shingles > 0 AND doc_id IS NOT NULL").select(F.col("row").alias(key), "doc_id", "component_id", "class"), "judged")
    stays = judged.where("doc_id = component_id").groupBy("class").agg(F.min(key).alias(key)).select(key)
    goes = materialize(judged.select(key).distinct().join(stays, key, "left_anti"), "goes")
    keyed = documents.withColumn(key, row_key(documents))
    again = materialize(keyed.where("doc_id IS NOT NULL").groupBy(key).count().where("count > 1").select(key), "again")
    hint = lambda d: F.broadcast(d) if d.count() <= SENT else d
    kept = keyed.join(hint(goes), key, "left_anti")
    again = hint(again)
    single = kept.join(again, key, "left_anti")
    repeats = kept.join(again, key, "left_semi").dropDuplicates([key])
    return single.unionByName(repeats).drop(key)

"""Conversation prefix trie by burst tries.

A turn is known by 16 bytes of the digest of its role and text, a conversation by those of its turns in a row, so texts are
never shuffled. Equal conversations are one class with a count before anything else is done. All classes start in one
container under the root. A container of more than `most` turns and more than one class is burst: what all its suffixes
share (read off its least and greatest one) is a chain of nodes under its head, and the next turn id of each deals it to a
new head. The rest are dealt to shards by head, sorted, and swept into nodes, one container in memory at a time. The nodes
of burst heads get their sums from the heads below, round by round from the last.

The ids of the conversations that end at a node are joined in blocks of 65,536 neighbouring ids and hashed as a stream in
order, so a class of any size passes through its task in rows that do not hold it.

Defined results: rows whose conv_id is null or no integer belong to no conversation; a null role or text is empty, a null
turn comes first; equal turns of a conversation are ordered by the digest of role and text, repeated rows are turns of
their own; an empty table has no members and hence no root; other columns are ignored. Very long: a text is hashed in
place; a conversation is held as one row of 20 bytes a turn. Identity of turns and heads is by 128 bits of SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

MOST, BLOCK, SENT, FLUSH = 4096, 65_536, 200_000, 20_000
NONE = hashlib.sha256(b"").hexdigest()
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
COLUMNS = [x.split()[0] for x in NODE.split(", ")]


def short(x) -> F.Column:
    """16 bytes of a digest."""
    return F.unhex(F.substring(F.sha2(x.cast("binary"), 256), 1, 32))


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order, each with its digest and code points."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.select(
        F.col("conv_id").try_cast("long").alias("conv_id"), "turn", short(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("id"), F.length(text).alias("chars")
    ).where(F.col("conv_id").isNotNull())
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id", "chars"))).alias("turns"))


def rebuilt(conversations: DataFrame, group: int = 100, heads: int = 6) -> DataFrame:
    """Conversations whose first turns are those of the first one of their group of ids: seq (16 bytes a turn) and lens.

    The number of such turns is the CRC-32 of the decimal id modulo `heads`.
    """
    own = turns(conversations)
    first = own.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("leader"), F.slice("turns", 1, heads - 1).alias("lead"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    lead = F.coalesce("lead", F.slice("turns", 1, 0))
    joined = own.withColumn("leader", F.col("conv_id") - F.col("conv_id") % group).join(first, "leader", "left")
    return sequences(joined.select("conv_id", F.concat(F.slice(lead, F.lit(1), h), F.slice("turns", h + 1, F.size("turns"))).alias("turns")))


def sequences(rows: DataFrame) -> DataFrame:
    """conv_id, seq and lens of conversations given as arrays of turns."""
    return rows.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda x: F.hex(x["id"])), "")).alias("seq"), F.transform("turns", lambda x: x["chars"]).alias("lens"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest of each key from its joined ids, which arrive in order."""
    now, digest = None, None
    for batch in batches:
        keys, out = [], []
        for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if key != now:
                if now is not None:
                    keys.append(now)
                    out.append(digest.hexdigest())
                now, digest = key, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(out, pa.string())], ["key", "ends"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([digest.hexdigest()])], ["key", "ends"])


def classes(seqs: DataFrame) -> DataFrame:
    """Equal conversations as one row: seq, lens, n, conv_id (the least) and ends, the digest of their ids."""
    keyed = seqs.withColumn("key", short(F.col("seq")))
    blocks = keyed.groupBy("key", F.floor(F.col("conv_id") / F.lit(BLOCK)).alias("block")).agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    ends = blocks.repartition("key").sortWithinPartitions("key", "block").select("key", "ids").mapInArrow(_digests, "key binary, ends string")
    return keyed.groupBy("key", "seq", "lens").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id")).join(ends, "key").drop("key")


def _container(rows: list[tuple], depth: int) -> list[list]:
    """The nodes of one container, its head first, from its classes in order: conv_id, depth, parent's place, sums."""
    CONV, DEPTH, PARENT, N, CHILDREN, LEAVES, SAVED, ENDS = range(8)
    chars = rows[0][1]
    nodes = [[None, depth, None, 0, 0, 0, 0, NONE, chars[depth - 1] if depth else 0]]
    path, before = [0], b""
    for seq, lens, n, conv, ends in rows:
        at, most = 16 * depth, min(len(seq), len(before))
        while at < most and seq[at : at + 16] == before[at : at + 16]:
            at += 16
        del path[at // 16 - depth + 1 :]
        for d in range(at // 16, len(lens)):
            nodes[path[-1]][CHILDREN] += 1
            nodes.append([None, d + 1, path[-1], 0, 0, 0, 0, NONE, lens[d]])
            path.append(len(nodes) - 1)
        end = nodes[path[-1]]
        end[CONV], end[N], end[ENDS], before = conv, n, ends, seq
    for node in reversed(nodes):
        node[LEAVES] = node[LEAVES] or 1
        node[SAVED] += (node[N] - 1) * node[-1]
        if node[PARENT] is not None:
            up = nodes[node[PARENT]]
            up[CONV] = node[CONV] if up[CONV] is None else min(up[CONV], node[CONV])
            up[N] += node[N]
            up[LEAVES] += node[LEAVES]
            up[SAVED] += node[SAVED]
    return nodes


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the containers, which arrive by head and in order of their suffixes; a head's own node names the head above."""
    out: list[list] = []
    head, top, rows = None, None, []

    def close() -> None:
        depth, up, under = top
        nodes = _container(rows, depth)
        for i, (conv, d, parent, n, children, leaves, saved, ends, _) in enumerate(nodes):
            out.append([conv, d, nodes[parent][0] if i else up, n, children, leaves, saved, ends, None if i else under])

    def flush() -> pa.RecordBatch:
        kinds = [*[pa.int64()] * 7, pa.string(), pa.binary()]
        made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [[]] * 9, kinds, strict=True)], [*COLUMNS, "under"])
        out.clear()
        return made

    for batch in batches:
        for h, depth, up, under, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if h != head:
                if rows:
                    close()
                    if len(out) >= FLUSH:
                        yield flush()
                head, top, rows = h, (depth, up, under), []
            rows.append(row)
    if rows:
        close()
    yield flush()


SUFFIX = ["head", "hd", "up", "under", "seq", "lens", "n", "conv_id", "ends"]


def _burst(rows: DataFrame, most: int) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """The settled rows, the burst heads with their chains, and the rows under new heads; None if no container is too large."""
    sizes = rows.groupBy("head").agg(F.count(F.lit(1)).alias("classes"), F.sum(F.size("lens") - F.col("hd")).alias("turns"))
    large = materialize(sizes.where((F.col("classes") > 1) & (F.col("turns") > most)).select("head"), "trie-large")
    if not (count := large.count()):
        return None
    small = (lambda df: F.broadcast(df)) if count <= SENT else (lambda df: df)  # a row of some 30 bytes for each head
    inside = rows.join(small(large), "head", "left_semi")
    ranges = inside.groupBy("head", "hd", "up", "under").agg(F.min(F.struct("seq", "lens")).alias("lo"), F.max("seq").alias("hi"), F.sum("n").alias("n_convs"), F.min("conv_id").alias("least"))
    unlike = F.expr("transform(sequence(hd, size(lo.lens)), i -> substring(lo.seq, 16 * i + 1, 16) <> substring(hi, 16 * i + 1, 16))")
    edges = ranges.withColumn("at", (F.col("hd") + F.array_position(unlike, True) - 1).cast("int"))
    edges = materialize(edges.withColumn("chain", F.expr("slice(concat(array(0), lo.lens), hd + 1, at - hd + 1)")).drop("lo", "hi"), "trie-heads")
    dealt = inside.join(small(edges.select("head", "at", "least")), "head")
    after = dealt.select(
        F.when(F.size("lens") > F.col("at"), short(F.concat("head", F.expr("substring(seq, 16 * at + 1, 16)")))).alias("head"),
        (F.col("at") + 1).alias("hd"), F.col("least").alias("up"), F.col("head").alias("under"), *SUFFIX[4:],
    )
    return rows.join(small(large), "head", "left_anti").select(SUFFIX), edges, materialize(after, "trie-suffixes")


def _heads(edges: DataFrame, ended: DataFrame, below: DataFrame) -> DataFrame:
    """Nodes of burst heads and their chains: below has n_leaves and saved_tokens of the heads under each."""
    sums = below.groupBy(F.col("under").alias("head")).agg(F.count(F.lit(1)).alias("below"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved"))
    links = edges.join(sums, "head").join(ended.select(F.col("under").alias("head"), "ends"), "head", "left")
    chain = links.select("*", F.posexplode("chain").alias("k", "chars"))
    last, first = F.col("hd") + F.col("k") == F.col("at"), F.col("k") == 0
    own = F.expr("sum((n_convs - 1) * chars) over (partition by head order by k desc rows unbounded preceding)")
    return chain.select(
        F.col("least").alias("conv_id"), (F.col("hd") + F.col("k")).cast("long").alias("depth"), F.when(first, F.col("up")).otherwise(F.col("least")).alias("parent_conv_id"), "n_convs",
        F.when(last, F.col("below")).otherwise(F.lit(1)).cast("long").alias("n_children"), F.col("n_leaves").cast("long").alias("n_leaves"), (F.col("saved") + own).cast("long").alias("saved_tokens"),
        F.when(last, F.coalesce("ends", F.lit(NONE))).otherwise(F.lit(NONE)).alias("ends_sha256"), F.when(first, F.col("under")).alias("under"),
    )


def trie(seqs: DataFrame, most: int = MOST) -> DataFrame:
    """The nodes of the trie of conversations given as seq and lens: one row a node, see the module."""
    seqs = materialize(seqs, "trie-conversations")
    rows = classes(seqs).select(F.lit(b"").alias("head"), F.lit(0).alias("hd"), F.lit(None).cast("long").alias("up"), F.lit(None).cast("binary").alias("under"), "seq", "lens", "n", "conv_id", "ends")
    rows, settled, rounds = materialize(rows, "trie-classes"), [], []
    while made := _burst(rows, most):
        calm, edges, after = made
        settled.append(calm)
        rounds.append((edges, after.where("head IS NULL")))
        rows = after.where("head IS NOT NULL")
    whole = rows.select(SUFFIX)
    for calm in settled:
        whole = whole.unionByName(calm)
    swept = whole.repartition("head").sortWithinPartitions("head", "seq").mapInArrow(_sweep, NODE + ", under binary")
    if not rounds:
        return swept.select(COLUMNS)
    swept = out = materialize(swept, "trie-nodes")
    below = swept
    for edges, ended in reversed(rounds):
        heads = materialize(_heads(edges, ended, below.where("under IS NOT NULL")), "trie-burst")
        out, below = out.unionByName(heads), swept.unionByName(heads)
    return out.select(COLUMNS)


def report(conversations: DataFrame, most: int = MOST) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations."""
    return trie(rebuilt(conversations), most)

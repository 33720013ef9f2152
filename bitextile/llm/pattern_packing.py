"""Best-fit packing by patterns of few documents, fitted by non-negative least squares.

Each partition is tokenized once; documents are cut only where longer than a sequence, and a piece is written with its
checksum and its number among the pieces of equal length in its partition. The histogram of lengths, at most one row a length,
goes to the driver. There lengths are put in UNITS bins, rounded up, all patterns of at most three bins that fill a sequence
are enumerated, and their repeat counts are fitted to the histogram by non-negative least squares (rows weighted by length),
rounded and held to what there is. Each repeated pattern becomes ranges of sequences with the same exact lengths. What is left
is packed longest first, by best fit, into the room left in these ranges and into new ones, a whole range at a time. The plan
is a list of placements (length, range of sequences, copies in each, offset), whose size depends on the number of lengths and
not of documents. Prefix sums of (partition, length) counts give each piece its number among all of its length, by which it
looks up its placement.

Defined results: a null or empty text is its end id alone; repeated rows are packed once each; pieces of equal length take
their places in order of partitions; an empty table gives no pieces; other columns are ignored; a null doc_id is kept as null. Very
long: one text's ids are held at a time.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, texts_of
from .packing import byte_of, in_merge_order

LENGTH, END, UNITS, KEPT, SENT = 4096, 1, 128, 150_000, 500_000
#: How the files of this kind part words, and mark their ends.
PARTS, ENDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+", "</w>"
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
PLAIN_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+")
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_made: dict[str, WordEncoder] = {}


# -- ids


class WordEncoder:
    """Ids of texts by a tokenizer file. Where its rules drop white space and never join what it parts, words between it are
    encoded for themselves and kept: up to KEPT new ones beside the KEPT before them, so frequent words stay.

    Words of Latin-1 letters, digits and ASCII marks are parted and merged here by rank, an end of word standing as byte
    255, which no text has; all others go to the `tokenizers` library.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.exact, data = Tokenizer.from_str(spec), json.loads(spec)
        steps = (data.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        split = steps[0].get("pattern", {}).get("Regex", "")
        normal = [x.get("type") for x in (data.get("normalizer") or {}).get("normalizers", [])]
        parted = steps[0].get("behavior") == "Removed" and steps[0].get("invert") and split == PARTS
        specials = [x["content"] for x in data.get("added_tokens", [])]
        self.by_words = bool(parted) and normal == ["NFC", "Replace", "Lowercase"] and not any(c.isspace() for s in specials for c in s)
        self.kind = "<u2" if len(data["model"]["vocab"]) + len(specials) < 65_536 else "<u4"
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.merge = None
        if self.by_words and data["model"].get("end_of_word_suffix") == ENDS and in_merge_order(data["model"]) and all("<|" in s for s in specials):
            byte = byte_of()
            ranks = {bytes(byte[c] for c in t.removesuffix(ENDS)) + b"\xff" * t.endswith(ENDS): i for t, i in data["model"]["vocab"].items() if t not in specials}
            self.merge = tiktoken.Encoding("words", pat_str=".", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def word(self, w: str) -> bytes:
        """The ids of a word without white space, as it is stored."""
        if self.merge is None or not PLAIN.fullmatch(w) or "<|" in w:
            ids = self.exact.encode(w, add_special_tokens=False).ids
        else:
            ids = [i for p in PLAIN_PARTS.findall(w.lower()) for i in self.merge(p.encode() + b"\xff")]
        return np.array(ids, self.kind).tobytes()

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_words:
            return [np.array(self.exact.encode(t, add_special_tokens=False).ids, "<u4") for t in texts]
        out = []
        for t in texts:
            words = t.replace("\n", " ").replace("\t", " ").split(" ")
            if len(self.new) >= KEPT:
                self.old, self.new = self.new, {}
            new, old = self.new, self.old
            for w in words:
                if w not in new:
                    new[w] = old[w] if w in old else self.word(w)
            out.append(np.frombuffer(b"".join([new[w] for w in words]), self.kind).astype("<u4"))
        return out


def encoder(spec: str) -> WordEncoder:
    """One encoder for each Python worker."""
    if spec not in _made:
        _made[spec] = WordEncoder(spec)
    return _made[spec]


def _pieces(batches: Iterator[pa.RecordBatch], spec: str, length: int, end: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    encode, part, seen = encoder(spec), TaskContext.get().partitionId(), np.zeros(length + 1, np.int64)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            own = batch.slice(at, 256)
            ids = [np.append(x, np.uint32(end)) for x in encode(own.column(1).to_pylist())]
            n = np.array([len(x) for x in ids], np.int64)
            count = -(-n // length)
            row = np.repeat(np.arange(len(n)), count)
            k = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            size = np.minimum(n[row] - k * length, length)
            parts = [ids[r][s : s + z].astype("<u4").tobytes() for r, s, z in zip(row.tolist(), (k * length).tolist(), size.tolist(), strict=True)]
            order = np.argsort(size, kind="stable")
            first = np.searchsorted(size[order], size[order])
            number = np.empty(len(size), np.int64)
            number[order] = np.arange(len(size)) - first + seen[size[order]]
            seen += np.bincount(size, minlength=length + 1)
            cols = [own.column(0).take(pa.array(row)), pa.array(k, pa.int32()), pa.array(k * length), pa.array(size), pa.array([zlib.crc32(p) for p in parts], pa.int64()), pa.array(np.full(len(row), part), pa.int32()), pa.array(number)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "number"]
            if with_ids:
                cols, names = [*cols, pa.array(parts, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names)


# -- the plan


def patterns(units: int) -> list[tuple[int, ...]]:
    """All descending patterns of at most three bins that fill `units`."""
    two = [(a, units - a) for a in range(units - 1, (units - 1) // 2, -1) if a >= units - a]
    three = [(a, b, units - a - b) for a in range(units - 2, 0, -1) for b in range(min(a, units - a - 1), 0, -1) if b >= units - a - b]
    return [(units,), *two, *three]


def nonnegative(a: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The x >= 0 with the least |a x - h|, by the active-set method of Lawson and Hanson on the normal equations."""
    ata, ath = a.T @ a, a.T @ h
    x, inside = np.zeros(len(ath)), np.zeros(len(ath), bool)
    slack = 1e-9 * max(1.0, float(np.abs(ath).max()))
    for _ in range(3 * len(ath)):
        w = np.where(inside, -np.inf, ath - ata @ x)
        if w.max() <= slack:
            break
        inside[int(w.argmax())] = True
        while True:
            at = np.flatnonzero(inside)
            z = np.linalg.lstsq(ata[np.ix_(at, at)], ath[at], rcond=None)[0]
            if z.min() > 0:
                x[:] = 0
                x[at] = z
                break
            bad = z <= 0
            step = np.min(x[at][bad] / (x[at][bad] - z[bad] + 1e-300))
            x[at] += step * (z - x[at])
            gone = at[(x[at] <= 1e-12) & bad]
            x[gone], inside[gone] = 0, False
            if not len(gone) or not inside.any():
                break
    return x


class Plan:
    """Placements of lengths: (length, first sequence, sequences, copies in each, offset)."""

    def __init__(self, length: int):
        self.length, self.sequences = length, 0
        self.placed: list[tuple[int, int, int, int, int]] = []
        self.room: list[tuple[int, int, int]] = []  # what is left in a range of sequences, its first one, their number; in order

    def open(self, count: int) -> int:
        first = self.sequences
        self.sequences += count
        return first

    def put(self, length: int, first: int, count: int, copies: int, room: int) -> int:
        """Place `copies` in each sequence of a range with that room; what is left there."""
        self.placed.append((length, first, count, copies, self.length - room))
        return room - length * copies

    def leave(self, room: int, first: int, count: int) -> None:
        if room and count:
            insort(self.room, (room, first, count))

    def best_fit(self, length: int, count: int) -> None:
        """Place `count` pieces where least room fits, as many of them in each sequence as it takes."""
        while count:
            i = bisect_left(self.room, (length, -1, -1))
            if i < len(self.room):
                room, first, n = self.room.pop(i)
            else:
                n = -(-count // (self.length // length))
                room, first = self.length, self.open(n)
            copies = room // length
            whole = min(n, count // copies)
            if whole:
                self.leave(self.put(length, first, whole, copies, room), first, whole)
            count, rest = count - whole * copies, n - whole
            if rest and count:  # fewer pieces than one more sequence takes
                self.leave(self.put(length, first + whole, 1, count, room), first + whole, 1)
                whole, rest, count = whole + 1, rest - 1, 0
            self.leave(room, first + whole, rest)


def fitted(counts: dict[int, int], length: int, units: int = UNITS) -> Plan:
    """A plan for so many pieces of each length."""
    plan, unit = Plan(length), -(-length // units)
    left = dict(sorted(((n, c) for n, c in counts.items() if c), reverse=True))
    if not left:
        return plan
    top = length // unit
    bins: dict[int, list[int]] = {}
    for n in left:
        if -(-n // unit) <= top:
            bins.setdefault(-(-n // unit), []).append(n)
    stock = np.zeros(top + 1, np.int64)
    for b, ns in bins.items():
        stock[b] = sum(left[n] for n in ns)
    shapes = [p for p in patterns(top) if all(stock[b] for b in p)]
    if shapes:
        a = np.zeros((top + 1, len(shapes)))
        for j, p in enumerate(shapes):
            for b in p:
                a[b, j] += 1
        weight = np.arange(top + 1, dtype=float) / top
        scale = float(stock.max())
        x = nonnegative(a * weight[:, None], stock / scale * weight) * scale
        alive = sorted(left)
        for j in sorted(np.flatnonzero(x >= 0.5).tolist(), key=lambda j: shapes[j], reverse=True):
            p, repeats = shapes[j], round(x[j])
            while repeats:
                ns, room = [], length
                for b in p[:-1] if len(p) > 1 else p:  # the longest left of each bin
                    ns += [n for n in bins[b] if left[n] > ns.count(n)][:1]
                    room = length - sum(ns)
                i = bisect_left(alive, room + 1) - 1  # and what best fits the room left, of whatever bin
                while i >= 0 and left[alive[i]] <= ns.count(alive[i]):
                    i -= 1
                if len(ns) < max(1, len(p) - 1) or (len(p) > 1 and (i < 0 or room - alive[i] > unit)):
                    break
                if len(p) > 1:
                    ns.append(alive[i])
                run = min([repeats, *(left[n] // ns.count(n) for n in ns)])
                first, room = plan.open(run), length
                for n in ns:
                    room = plan.put(n, first, run, 1, room)
                    left[n] -= run
                    if not left[n]:
                        del alive[bisect_left(alive, n)]
                plan.leave(room, first, run)
                repeats -= run
    for n, count in left.items():
        plan.best_fit(n, count)
    return plan


def table(plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """For lookups: (length, number of the first piece) of each placement in order, and its range, copies and offset."""
    placed = np.array(sorted(plan.placed), np.int64).reshape(-1, 5)
    size = placed[:, 2] * placed[:, 3]
    before = np.cumsum(size) - size
    _, at = np.unique(placed[:, 0], return_index=True)
    start = before - np.repeat(before[at], np.diff(np.append(at, len(placed))))
    return (placed[:, 0] << 44) + start, np.column_stack([start, placed[:, 1], placed[:, 3], placed[:, 4], placed[:, 0]])


def _place(batches: Iterator[pa.RecordBatch], keys: np.ndarray, facts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        number = np.asarray(col["number"]) + np.asarray(col["before"])
        start, first, copies, offset, length = facts[np.searchsorted(keys, (np.asarray(col["length"]) << 44) + number, "right") - 1].T
        number = number - start
        names = [n for n in col if n not in ("part", "number", "before")]
        yield pa.RecordBatch.from_arrays([*(col[n] for n in names), pa.array(first + number // copies), pa.array(offset + number % copies * length)], [*names, "sequence_id", "offset"])


def pack(documents: DataFrame, tokenizer: str, length: int = LENGTH, end: int = END, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents in sequences of at most `length` ids; with_ids adds them as little-endian 32-bit integers."""
    sc = documents.sparkSession.sparkContext
    spec = sc.broadcast(open(tokenizer, encoding="utf-8").read())
    docs = texts_of(documents, F.col("doc_id").cast("long").alias("doc_id"))
    ids = ", ids binary" if with_ids else ""
    rows = materialize(docs.mapInArrow(lambda b: _pieces(b, spec.value, length, end, with_ids), f"{PIECES}, part int, number long{ids}"), "pattern-pieces")
    counts = materialize(rows.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "pattern-counts")
    plan = fitted({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, length)  # at most a row for each length
    before = counts.select("part", "length", F.expr("sum(n) over (partition by length order by part) - n").alias("before"))
    sent = sc.broadcast(table(plan))
    placed = rows.join(F.broadcast(before) if counts.count() <= SENT else before, ["part", "length"])
    names = [x.split()[0] for x in (PIECES + ids).split(", ")]
    return placed.select(*names, "part", "number", "before").mapInArrow(lambda b: _place(b, *sent.value), f"{PIECES}{ids}, sequence_id long, offset long")

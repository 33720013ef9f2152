"""Fill-in-the-middle transformation by secondary-sort assembly.

Each text is cut at unit starts (`[A-Za-z]+|[^A-Za-z]`) into pieces of at most CHUNK units or WIDE code points, each keyed by
its document's row and its place in the output. Pieces are dealt by row and sorted by place within partitions (the
DataFrame form of repartitionAndSortWithinPartitions), and stream into the output's text or its incremental digest. For
restoration the output's bytes, as they stream by, are searched for the three marks, whatever the pieces were; what lies
between is emitted again under its place in the original, sorted once more where it lies, and streams into a second digest. So
no task holds more than a piece of an output, and both passes are one chain with one shuffle and no join.

Defined results: a null text is empty, and so plain; a null doc_id is drawn from as the empty decimal; repeated rows are
transformed each, alike; texts that hold a mark stay plain, whatever the draws; an empty table gives no rows; other columns
are ignored. Draws never tie: equal cuts give an empty middle. Very long: a text is one value of its own row, its cuts are
found in slices of WIDE code points, and beyond that only pieces are held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts_of

CHUNK, WIDE, SEED, RATE, SPM = 65_536, 1 << 20, "1", 90, 20
MARKS = ("<P>", "<S>", "<M>")  # before prefix, suffix and middle
PIECE = "uid long, at long, doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, data binary"
KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
NAMES = [x.split()[0] for x in PIECE.split(", ")]
RESULT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
FLUSH = 4 << 20  # bytes of pieces in one batch


def units(text: str) -> Iterator[np.ndarray]:
    """The code points at which units start, in slices."""
    last = False
    for at in range(0, len(text), WIDE):
        c = np.frombuffer(text[at : at + WIDE].encode("utf-32-le", "surrogatepass"), "<u4")
        letter = ((c | 32) - np.uint32(97)) < 26
        inner = letter.copy()
        inner[1:] &= letter[:-1]
        inner[0] &= last
        last = bool(letter[-1])
        yield at + np.flatnonzero(~inner)


def start_of(text: str, ks: list[int]) -> list[int]:
    """The code points at which the units of these numbers (ascending) start; the text's end after the last unit."""
    out, before = [], 0
    for starts in units(text):
        while len(out) < len(ks) and ks[len(out)] < before + len(starts):
            out.append(int(starts[ks[len(out)] - before]))
        before += len(starts)
    return out + [len(text)] * (len(ks) - len(out))


def draws(doc_id: int | None, seed: str) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def plan(doc_id: int | None, text: str, seed: str = SEED, rate: int = RATE, spm: int = SPM) -> tuple[int, str, int, int]:
    """n, form, and the code points at which prefix and middle end."""
    n = sum(len(x) for x in units(text))
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or any(m in text for m in MARKS) or h3 % 100 >= rate:
        return n, "plain", 0, 0
    a, b = start_of(text, sorted((h1 % (n + 1), h2 % (n + 1))))
    return n, "spm" if h4 % 100 < spm else "psm", a, b


def cuts(text: str, first: int, last: int) -> Iterator[str]:
    """text[first:last] in pieces of whole units, but for units longer than a piece may be."""
    at = first
    if last - first > CHUNK:
        seen = 0
        for starts in units(text):
            for s in starts[(-seen) % CHUNK :: CHUNK].tolist():
                if at < s < last:
                    yield text[at:s]
                    at = s
            seen += len(starts)
            while min(last, int(starts[-1]) if len(starts) else at) - at > WIDE:
                yield text[at : at + WIDE]
                at += WIDE
    while at < last:
        yield text[at : min(last, at + WIDE)]
        at += WIDE


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), KINDS, strict=True)], NAMES)
    rows.clear()
    return out


def _cut(batches: Iterator[pa.RecordBatch], seed: str, rate: int, spm: int) -> Iterator[pa.RecordBatch]:
    """For each text a row of facts (at = -1) and its output's pieces, numbered."""
    uid, rows, held = TaskContext.get().partitionId() << 40, [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
            doc_id, text, uid = doc_id.as_py(), text.as_py(), uid + 1
            n, form, a, b = plan(doc_id, text, seed, rate, spm)
            plain = form == "plain"
            rows.append((uid, -1, doc_id, n, form, None if plain else a, None if plain else b - a, None, None))
            parts = {"P": (0, a), "M": (a, b), "S": (b, len(text))}
            at = 0
            for mark in [""] if plain else "PSM" if form == "psm" else "SPM":
                lead = f"<{mark}>" if mark else ""
                for piece in cuts(text, *parts.get(mark, (0, len(text)))):
                    data = (lead + piece).encode("utf-8", "surrogatepass")
                    rows.append((uid, at, None, None, None, None, None, None, data))
                    lead, at, held = "", at + 1, held + len(data)
                    if held > FLUSH:
                        yield _batch(rows)
                        held = 0
                if lead:
                    rows.append((uid, at, None, None, None, None, None, None, lead.encode()))
                    at += 1
        if rows:
            yield _batch(rows)
            held = 0


class Restorer:
    """Finds the parts of an output that arrives in pieces: feed() gives (part, bytes), part 0 prefix, 1 middle, 2 suffix."""

    PART = {b"P": 0, b"S": 2, b"M": 1}

    def __init__(self, plain: bool):
        self.plain, self.tail, self.part = plain, b"", 0

    def feed(self, data: bytes, end: bool = False) -> Iterator[tuple[int, bytes]]:
        if self.plain:
            if data:
                yield 0, data
            return
        data = self.tail + data
        at = 0
        while (i := data.find(b"<", at)) >= 0:
            if data[i + 1 : i + 2] in self.PART and data[i + 2 : i + 3] == b">":
                if i:
                    yield self.part, data[:i]
                self.part, data, at = self.PART[data[i + 1 : i + 2]], data[i + 3 :], 0
            else:
                at = i + 1
        keep = 0 if end else min(len(data), 2)
        self.tail = data[len(data) - keep :]
        if len(data) > keep:
            yield self.part, data[: len(data) - keep]


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of all batches, one by one."""
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        yield from zip(*columns, strict=True)


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Outputs from sorted pieces: the facts with the digest, and the parts found in each output under their old places."""
    rows, held, facts, digest, restorer, at = [], 0, None, None, None, 0

    def emit(found) -> None:
        nonlocal at, held
        for part, data in found:
            rows.append((facts[0], (part << 40) + at, None, None, None, None, None, None, data))
            at, held = at + 1, held + len(data)

    def close() -> None:
        emit(restorer.feed(b"", end=True))
        rows.append((*facts[:7], digest.hexdigest(), None))

    for row in _documents(batches):
        if row[1] < 0:
            if facts:
                close()
            facts, digest, restorer, at = row, hashlib.sha256(), Restorer(row[4] == "plain"), 0
        else:
            digest.update(row[-1])
            emit(restorer.feed(row[-1]))
        if held > FLUSH or len(rows) > 10_000:
            yield _batch(rows)
            held = 0
    if facts:
        close()
        yield _batch(rows)


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The facts of each document with the digest of its restored text, from parts sorted by their old places."""
    out, facts, digest = [], None, None
    kinds = [*KINDS[2:8], pa.string()]
    names = [x.split()[0] for x in RESULT.split(", ")]

    def flush() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
        out.clear()
        return made

    for row in _documents(batches):
        if row[1] < 0:
            if facts:
                out.append((*facts[2:8], digest.hexdigest()))
            facts, digest = row, hashlib.sha256()
        else:
            digest.update(row[-1])
        if len(out) >= 10_000:
            yield flush()
    if facts:
        out.append((*facts[2:8], digest.hexdigest()))
        yield flush()


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The whole output of each document."""
    facts, held = None, []

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((*facts[2:7], b"".join(held).decode("utf-8", "surrogatepass")), [*KINDS[2:7], pa.string()], strict=True)], [*NAMES[2:7], "text"])

    for row in _documents(batches):
        if row[1] < 0:
            if facts:
                yield made()
            facts, held = row, []
        else:
            held.append(row[-1])
    if facts:
        yield made()


def pieces(documents: DataFrame, seed: str = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """The pieces of all outputs, dealt by document and in their order there, each document's facts first (at = -1).

    `rate` of 100 documents are transformed, `spm` of 100 of these with the suffix first.
    """
    rows = texts_of(documents, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(lambda b: _cut(b, seed, rate, spm), PIECE)
    return rows.repartition("uid").sortWithinPartitions("uid", "at")


def transformed(documents: DataFrame, seed: str = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the transformed text of each document."""
    return pieces(documents, seed, rate, spm).mapInArrow(_texts, "doc_id long, n long, form string, prefix_chars long, middle_chars long, text string")


def report(documents: DataFrame, seed: str = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """The facts of each document with the digests of its output and of the text restored from that output and its form."""
    found = pieces(documents, seed, rate, spm).mapInArrow(_assemble, PIECE)
    return found.sortWithinPartitions("uid", "at").mapInArrow(_restore, RESULT)  # parts lie where their document was dealt

"""Packing by concatenate-and-cut.

Pass one tokenizes each partition once and writes the ids with each document's place in its own partition. The token
totals of the partitions, one row each, are summed in order, which gives every partition its global offset. Pass two
reads the ids and cuts the one long stream at multiples of the sequence length; a document that crosses a cut leaves a
record on each side. No row is shuffled, and only partition totals reach the driver.

Ids are those of the `tokenizers` library for the given file. They are made by `tiktoken` from the same vocabulary, which
is some four times faster; where a text holds the special token, or that library fails, `tokenizers` itself is used.

Defined results: a null or empty text is its end id alone; repeated rows are packed once each; an empty table gives no
pieces; other columns are ignored. A null doc_id is kept as null. Very long: the ids of one text are one value of its row.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, texts_of

LENGTH, END = 2048, 1
#: Fixed value: how byte-level BPE cuts a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_made: dict[str, Encoder] = {}


def in_merge_order(model: dict) -> bool:
    """Whether ids follow the order of merges, so that they can serve as merge ranks."""
    pairs = (m.split(" ") if isinstance(m, str) else m for m in model.get("merges", []))
    ids = [model["vocab"].get("".join(p), -1) for p in pairs]
    return all(a < b for a, b in zip(ids, ids[1:], strict=False)) and not model.get("ignore_merges")


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in the file
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}


class Encoder:
    """Texts to ids; made from the bytes of a tokenizer file."""

    def __init__(self, spec: str):
        import tiktoken

        self.spec, self._exact = spec, None
        data = json.loads(spec)
        byte = byte_of()
        self.special = [x["content"] for x in data.get("added_tokens", [])]
        pre = data.get("pre_tokenizer") or {}
        self.fast = None
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not data.get("normalizer") and in_merge_order(data["model"]):
            ranks = {bytes(byte[c] for c in t): i for t, i in data["model"]["vocab"].items() if t not in self.special}
            self.fast = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None and not any(s in text for s in self.special):
            try:
                return np.frombuffer(self.fast.encode_to_tiktoken_buffer(text, set()), "<u4")
            except BaseException as e:  # its pattern engine may panic on odd texts, which is no Exception
                if isinstance(e, KeyboardInterrupt | SystemExit):
                    raise
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, "<u4")

    @property
    def exact(self):
        """The library's own tokenizer, made when it is first needed: few texts do."""
        if self._exact is None:
            from tokenizers import Tokenizer

            self._exact = Tokenizer.from_str(self.spec)
        return self._exact


def encoder(spec: str) -> Encoder:
    """One encoder for each Python worker."""
    if spec not in _made:
        _made[spec] = Encoder(spec)
    return _made[spec]


def _tokenize(batches: Iterator[pa.RecordBatch], spec: str, end: int) -> Iterator[pa.RecordBatch]:
    encode, start, part = encoder(spec), 0, TaskContext.get().partitionId()
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            own = batch.slice(at, 1024)
            ids = [np.append(encode(t), np.uint32(end)) for t in own.column(1).to_pylist()]
            n = np.array([len(x) for x in ids], np.int64)
            first = start + np.cumsum(n) - n
            start += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [own.column(0), pa.array(np.full(len(n), part), pa.int32()), pa.array(first), pa.array(n), pa.array([x.astype("<u2" if x.max() < 65536 else "<u4").tobytes() for x in ids], pa.binary())],
                ["doc_id", "part", "first", "n", "ids"],
            )


def _cut(batches: Iterator[pa.RecordBatch], offsets: dict[int, int], length: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            own = batch.slice(at, 1024)
            n = np.asarray(own.column(3))
            g = np.asarray(own.column(2)) + np.array([offsets[p] for p in own.column(1).to_pylist()], np.int64)
            pieces = (g + n - 1) // length - g // length + 1
            row = np.repeat(np.arange(len(n)), pieces)
            k = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            seq = g[row] // length + k
            start = np.maximum(seq * length, g[row]) - g[row]
            size = np.minimum((seq + 1) * length, (g + n)[row]) - g[row] - start
            blobs = []
            for x, m in zip(own.column(4).to_pylist(), n.tolist(), strict=True):
                blobs.append(memoryview(np.frombuffer(x, "<u2" if len(x) == 2 * m else "<u4").astype("<u4").tobytes()))
            parts = [blobs[r][4 * s : 4 * (s + z)] for r, s, z in zip(row.tolist(), start.tolist(), size.tolist(), strict=True)]
            cols = [own.column(0).take(pa.array(row)), pa.array(start), pa.array(size), pa.array([zlib.crc32(p) for p in parts], pa.int64()), pa.array(n[row]), pa.array(seq), pa.array(g[row] + start - seq * length)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                cols, names = [*cols, pa.array([bytes(p) for p in parts], pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names)


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def tokenized(documents: DataFrame, tokenizer: str, end: int = END) -> DataFrame:
    """doc_id, part, first (ids before it in its partition), n and ids (little-endian) of each document; written once."""
    spec = documents.sparkSession.sparkContext.broadcast(open(tokenizer, encoding="utf-8").read())
    docs = texts_of(documents, F.col("doc_id").cast("long").alias("doc_id"))
    rows = docs.mapInArrow(lambda b: _tokenize(b, spec.value, end), "doc_id long, part int, first long, n long, ids binary")
    return materialize(rows, "packing")


def pack(documents: DataFrame, tokenizer: str, length: int = LENGTH, end: int = END, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents in sequences of `length` ids; with_ids adds them as little-endian 32-bit integers."""
    rows = tokenized(documents, tokenizer, end)
    totals = sorted(rows.groupBy("part").agg(F.sum("n").alias("n")).collect())  # a row for each partition
    offsets, at = {}, 0
    for part, n in totals:
        offsets[part], at = at, at + n
    sent = documents.sparkSession.sparkContext.broadcast(offsets)
    return rows.mapInArrow(lambda b: _cut(b, sent.value, length, with_ids), PIECES + (", ids binary" if with_ids else ""))



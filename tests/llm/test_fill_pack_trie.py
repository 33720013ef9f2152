"""Fill-in-middle, pattern packing and the prefix trie against plain versions on small tables with odd cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from bitextile.llm import fill_middle, pattern_packing, prefix_trie

from .test_llm import ODD, frame, prose

LONG = "Ab1 é漢🙂<\n" * 60_000 + "z" * 200_000
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


# -- fill in the middle


def filled(doc_id, text):
    """The output by the rule, on whole strings."""
    text = text or ""
    w = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(w), "plain", None, None, text
    a, b = sorted((h[0] % (len(w) + 1), h[1] % (len(w) + 1)))
    p, m, s = "".join(w[:a]), "".join(w[a:b]), "".join(w[b:])
    form = "spm" if h[3] % 100 < 20 else "psm"
    return len(w), form, len(p), len(m), f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"


FILL = [*ODD, "<P>", "a<S>b", "<<P", "<", ">" * 40, "P>S>", "<" * 50, "<M", LONG, LONG + "<M>", "z" * 3_000_000, *[prose(20, i) for i in range(60)]]


def test_fill_middle_is_the_rule_and_restores(spark):
    rows = fill_middle.report(frame(spark, FILL)).collect()
    assert len(rows) == len(FILL)
    for r in rows:
        n, form, p, m, out = filled(r["doc_id"], FILL[r["doc_id"]])
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == (n, form, p, m)
        assert r["output_sha256"] == sha(out) and r["restored_sha256"] == sha(FILL[r["doc_id"]] or "")
    assert {r["form"] for r in rows} == {"plain", "psm", "spm"}
    texts = {r["doc_id"]: r["text"] for r in fill_middle.transformed(frame(spark, FILL)).collect()}
    assert texts == {i: filled(i, t)[-1] for i, t in enumerate(FILL)}


def test_fill_middle_repeated_rows_nulls_clashing_names_and_an_empty_table(spark):
    odd = spark.createDataFrame([(1, "a b c", 7, 8, b"x", "y"), (1, "a b c", 7, 8, b"x", "y"), (None, "d e", 1, 1, None, None), (2, None, 0, 0, None, None)], "doc_id int, text string, uid int, at int, data binary, form string")
    rows = fill_middle.report(odd).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n"]) for r in rows) == [(False, 1, 5), (False, 1, 5), (False, 2, 0), (True, 0, 3)]
    assert all(r["output_sha256"] == sha(filled(r["doc_id"], {1: "a b c", None: "d e", 2: None}[r["doc_id"]])[-1]) for r in rows)
    assert fill_middle.report(odd.limit(0)).collect() == []


def test_marks_are_found_in_pieces_of_any_size(monkeypatch):
    monkeypatch.setattr(fill_middle, "CHUNK", 3)
    monkeypatch.setattr(fill_middle, "WIDE", 7)
    for text in ("abc de<f <P <S> é" * 3, "abcdefghijklmnopqrstuvwxyz" * 3 + " x", "", "<", "1234567890" * 5):
        for a in range(0, len(text) + 1, 5):
            assert "".join(fill_middle.cuts(text, a, len(text))) == text[a:]
            assert max((len(x) for x in fill_middle.cuts(text, a, len(text))), default=0) <= 7 + 7
        assert sum(len(x) for x in fill_middle.units(text)) == len(re.findall("[A-Za-z]+|[^A-Za-z]", text))
    output = "<P>ab<<S>S>c<M>>d<"
    for size in range(1, len(output)):
        r, got = fill_middle.Restorer(False), ["", "", ""]
        for i in range(0, len(output), size):
            for part, data in r.feed(output[i : i + size].encode()):
                got[part] += data.decode()
        for part, data in r.feed(b"", end=True):
            got[part] += data.decode()
        assert got == ["ab<", ">d<", "S>c"]


# -- pattern packing


def packed_right(rows, texts, length):
    """Every id lies in one piece, pieces in sequences are gapless and fit, checksums are those of the tokenizer's ids."""
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(docs) == set(range(len(texts)))
    for i, pieces in docs.items():
        ids = [*exact.encode(texts[i] or "", add_special_tokens=False).ids, 1]
        pieces.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(-(-len(ids) // length)))
        for r in pieces:
            own = ids[r["piece"] * length : (r["piece"] + 1) * length]
            assert (r["start"], r["length"], r["ids_crc32"]) == (r["piece"] * length, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= length
    return len(sequences)


WORDS = [*ODD, "İstanbul ΣΑΣ ﬁn", "é a ́b", "a b c\x1cd\x85e", "<|endoftext|> x<|startoftext|>y", "don't  'RE\r\n\tit's", "x" * 30_000, "日本" * 6000, prose(6000, 9)]


def test_pattern_packing_places_every_id(spark):
    texts = [*WORDS, *[prose(random.Random(i).randint(1, 900), i) for i in range(200)]]
    for length in (64, 4096):
        rows = pattern_packing.pack(frame(spark, texts), P.path("word_bpe_49k.json"), length=length).collect()
        total = sum(r["length"] for r in rows)
        assert packed_right(rows, texts, length) <= 1.02 * -(-total // length) + 1
    ids = pattern_packing.pack(frame(spark, texts[:9]), P.path("word_bpe_49k.json"), with_ids=True).collect()
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in ids)


def test_pattern_packing_of_odd_tables(spark):
    odd = spark.createDataFrame([(1, "a b", 3, "p"), (1, "a b", 3, "p"), (None, None, 4, None)], "doc_id int, text string, length int, part string")
    rows = pattern_packing.pack(odd, P.path("word_bpe_49k.json")).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in rows) == [(0, 1), (1, 3), (1, 3)] and len({(r["sequence_id"], r["offset"]) for r in rows}) == 3
    assert pattern_packing.pack(odd.limit(0), P.path("word_bpe_49k.json")).collect() == []


def fits(plan, counts, length):
    """The plan places each piece once and no sequence twice at one place; its number of sequences."""
    room = {}
    placed = Counter()
    for n, first, count, copies, offset in plan.placed:
        placed[n] += count * copies
        for s in range(first, first + count):
            room.setdefault(s, []).append((offset, n * copies))
    assert placed == Counter({n: c for n, c in counts.items() if c})
    for parts in room.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    return len(room)


def best_fit_decreasing(counts, length):
    rooms = []
    from bisect import bisect_left, insort

    for n in sorted(Counter(counts).elements(), reverse=True):
        i = bisect_left(rooms, n)
        room = rooms.pop(i) if i < len(rooms) else length
        insort(rooms, room - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(8))
def test_plans_need_about_as_few_sequences_as_best_fit(seed):
    r = random.Random(seed)
    kind = [lambda: r.randint(1, 100), lambda: r.randint(20, 60), lambda: min(100, int(r.lognormvariate(3, 1)) + 1), lambda: r.choice([34, 33, 51, 49, 17]), lambda: 100, lambda: r.randint(51, 100), lambda: r.choice([1, 99]), lambda: 37][seed]
    counts = Counter(kind() for _ in range(3000))
    n = fits(pattern_packing.fitted(counts, 100), counts, 100)
    assert n <= best_fit_decreasing(counts, 100) * 1.01 + 2


def test_a_plan_does_not_grow_with_the_number_of_pieces():
    r = random.Random(1)
    counts = Counter(min(4096, int(r.lognormvariate(6, 1.2)) + 1) for _ in range(30_000))
    few = pattern_packing.fitted(counts, 4096)
    many = pattern_packing.fitted({n: c * 100_000 for n, c in counts.items()}, 4096)
    assert len(many.placed) < 1.5 * len(few.placed) + 4096 and len(many.placed) < 60_000
    total = sum(n * c for n, c in counts.items())
    assert few.sequences <= 1.005 * total / 4096 + 1 and many.sequences <= 1.001 * 100_000 * total / 4096


def test_nonnegative_least_squares():
    rng = np.random.default_rng(4)
    for _ in range(20):
        a, h = rng.random((12, 30)), rng.random(12)
        x = pattern_packing.nonnegative(a, h)
        w = a.T @ (h - a @ x)
        assert (x >= 0).all() and w.max() < 1e-6 and np.abs(w[x > 0]).max(initial=0) < 1e-6


# -- the prefix trie


def nodes_of(rows):
    """The nodes by the contract, on whole sequences; rows of (conv_id, turn, role, text)."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()[:16], (role or "", text or "")))
    own = {c: [x[3] for x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        lead = int(np.fmod(c, 100))
        whole[c] = tuple(own.get(c - lead, [])[:h] + own[c][h:])
    members = {}
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    kids, leaves, saved = Counter(), Counter(), Counter()
    for s in members:
        if s:
            kids[s[:-1]] += 1
    for s, m in members.items():
        for d in range(len(s) + 1):
            leaves[s[:d]] += not kids[s]
            saved[s[:d]] += (len(m) - 1) * (len(s[-1][1]) if s else 0)
    return sorted(
        (min(m), len(s), min(members[s[:-1]]) if s else None, len(m), kids[s], leaves[s], saved[s], sha(",".join(str(c) for c in sorted(m) if whole[c] == s)))
        for s, m in members.items()
    )


def by_node(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda x: (x[0], x[1]))


def conversations():
    r = random.Random(3)
    rows = []
    for c in [*range(0, 240), *range(1001, 1030), *range(-130, -100), 10**12]:  # 1000 is missing: those have no first conversation
        kind = r.random()
        n = r.randint(1, 7) if kind < 0.5 else 30
        for t in range(n):
            same = kind >= 0.5 and t < 28
            rows.append((c, t, "user" if t % 2 else "assistant", f"common {t}" if same else r.choice("abé") * r.randint(0, 3)))
    rows += [(300, None, None, None), (300, 1, "", "x"), (301, 5, "u", "tie b"), (301, 5, "u", "tie a"), (301, 5, "u", "tie a"), (None, 1, "u", "nobody's"), (400, 0, "u", "x"), (305, 0, "u", ""), (402, 0, "u", "x"), (402, 1, "u", "y" * 100_000)]
    r.shuffle(rows)
    return rows


CONV = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("most", [1, 6, 60, 10**6])
def test_trie_is_that_of_whole_sequences(spark, most):
    rows = conversations()
    got = by_node(prefix_trie.report(spark.createDataFrame(rows, CONV).repartition(5), most))
    assert got == nodes_of(rows)


def test_trie_of_copies_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 7)
    rows = [(c * 100, t, "u", f"t{t}") for c in range(-40, 60) for t in range(12)] + [(c * 100, t, "u", f"t{t}") for c in range(60, 80) for t in range(6)]
    for most in (1, 5000):
        assert by_node(prefix_trie.report(spark.createDataFrame(rows, CONV), most)) == nodes_of(rows)


def test_trie_of_odd_tables(spark):
    odd = spark.createDataFrame([(1, 0, "u", "x", b"h", 3), (1, 0, "u", "x", b"h", 3), (None, None, None, None, None, None)], "conv_id int, turn int, role string, text string, head binary, hd int")
    assert by_node(prefix_trie.report(odd)) == nodes_of([tuple(r)[:4] for r in odd.collect()])
    assert prefix_trie.report(odd.limit(0)).collect() == []
    named = odd.withColumn("conv_id", F.lit("c7"))
    assert prefix_trie.report(named).collect() == []


def test_a_conversation_of_many_turns(spark):
    rows = spark.range(60_000).select(F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("u").alias("role"), F.col("id").cast("string").alias("text"))
    out = prefix_trie.report(rows)
    r = out.agg(F.count(F.lit(1)).alias("n"), F.max("depth").alias("d"), F.max("n_leaves").alias("l"), F.max("saved_tokens").alias("s")).collect()[0]
    assert r["n"] == r["d"] + 1 and r["d"] >= 60_000 - 5 and (r["l"], r["s"]) == (1, 0)


# -- very long texts


def test_texts_of_many_megabytes(spark):
    """One text of 17 MB through the operators that hold a text at a time, beside short ones."""
    from bitextile.llm import decontam, ngram_join, packing, suffix_dedup, syncmers, token_counts

    words = prose(4000, 77)
    long = " ".join(f"{words[i % 20_000 : i % 20_000 + 60]} {i}" for i in range(260_000))
    assert len(long) > 17_000_000
    docs = frame(spark, [long, "short text", None, long[:900]]).withColumns({"n": F.lit(1), "ids": F.lit("x"), "row": F.lit(2), "tid": F.lit(3)}).repartition(2)
    by = lambda df, c: {r["doc_id"]: r[c] for r in df.select("doc_id", c).collect()}
    assert by(token_counts.count(docs, P.path("piece_bpe_32k.model")), "n_chars") == {0: len(long), 1: 10, 2: 0, 3: 900}
    pieces = packing.pack(docs, P.path("byte_bpe_50k.json")).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()
    assert all(r["n"] == r["t"] for r in pieces) and len(pieces) == 4
    assert by(pattern_packing.pack(docs, P.path("word_bpe_49k.json")).groupBy("doc_id").agg(F.max(F.col("start") + F.col("length")).alias("n")), "n")[0] > 4_000_000
    kept = {r["doc_id"]: r for r in suffix_dedup.repeated(docs).collect()}
    assert kept[3]["n_removed"] == 900 and kept[0]["n_bytes"] == len(long) and kept[0]["n_removed"] >= 900
    assert by(ngram_join.classes(docs), "component_id") == {0: 0, 1: 1, 2: 2, 3: 3}
    bench = spark.createDataFrame([(1, long[5_000_000:5_000_200])], "item_id long, text string")
    assert by(decontam.report(docs, bench), "n_hit")[0] > 0
    assert by(fill_middle.report(docs), "restored_sha256")[0] == sha(long)
    assert len(syncmers.edited_pairs(docs).collect()) == 4

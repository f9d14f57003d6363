"""Merkle manifest, token files and aligned tokens against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers as public
import pytest
from pyspark.sql import functions as F

from tidemart.llm import alignment, exact_dedup, manifest, near_dedup, token_file
from tidemart.llm.token_ids import CHUNKS_KEPT, ByteIds, PieceIds, byte_ids

BYTES, PIECES = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, `meta.x` string"


def made_texts(seed, n):
    draw = random.Random(seed)
    signs = [*"ab \n\t,.é'1日½<|>-s", " ", " ", "\x85", "\x1c", "▁", "'s", " the ", "<|endoftext|>", "<0x0A>", "ing "]
    return ["".join(draw.choices(signs, k=draw.randint(0, 40))) for _ in range(n)]


def rows():
    texts = [None, "", " ", "a" * 4000, "one word " * 9000, "日本" * 300, " lead", "trail ", "two  spaces", *made_texts(3, 60)]
    out = [(i, text, ["en", "de", None][i % 3], "ab"[i % 2] if i % 5 else None, i if i % 4 else None)
           for i, text in enumerate(texts)]
    out += [(7, "shares an id", "en", "a", 3), (7, "shares an id", "en", "a", 3), (None, "null id", "fr", "a", 1)]
    return [(*row, "clash", "clash") for row in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(row):
    doc_id, text, lang, source, n_chars = row[:5]
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def brute_tree(leaves):
    """(root, proof of each leaf as a list of siblings)."""
    proofs, place, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        for i, at in enumerate(place):
            proofs[i] += nodes[at ^ 1:(at ^ 1) + 1]
            place[i] = at // 2
        nodes = [sha("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
    return nodes[0], proofs


@pytest.mark.parametrize("size", [1, 2, 64, 65, 129, 4097])
def test_proofs_of_a_tree(spark, size):
    docs = spark.range(size).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("en").alias("lang"),
                                    F.lit(None).cast("string").alias("source"), F.lit(1).alias("n_chars"))
    built = manifest.build(docs)
    root, proofs = brute_tree([brute_leaf((i, "x", "en", None, 1)) for i in range(size)])
    assert [r.root for r in built.root.collect()] == [root]
    found = {r.id: [step[1:] for step in r.proof if step] for r in manifest.proofs(built).collect()}
    assert found == dict(enumerate(proofs))
    # Only every sixth level is there.
    assert len(built.rows) == 1 + (size > 64) + (size > 4096)
    again = manifest.proofs(built).withColumn("folded", manifest.folded(F.col("leaf"), F.col("proof")))
    assert again.filter(F.col("folded") != root).count() == 0
    wrong = manifest.proofs(built).withColumn("folded", manifest.folded(F.sha2("leaf", 256), F.col("proof")))
    assert wrong.filter(F.col("folded") == root).count() == 0


def test_manifest_of_groups(spark, docs):
    groups = defaultdict(list)
    for row in rows():
        groups[row[2]].append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    tops = {}
    for group, members in groups.items():
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, brute_leaf(r)))
        tops[group] = brute_tree([brute_leaf(r) for r in members])
    root, upper = brute_tree([tops[g][0] for g in order])
    want = Counter((row[0], group, brute_leaf(row), tops[group][0], "".join(proof + upper[order.index(group)]))
                   for group, members in groups.items() for row, proof in zip(members, tops[group][1]))
    built = manifest.build(docs)
    got = Counter((r.id, r.group, r.leaf, r.subroot, "".join(s[1:] for s in r.proof)) for r in manifest.proofs(built).collect())
    assert got == want and built.root.first().root == root
    empty = manifest.build(docs.filter("false"))
    assert empty.root.count() == 0 and manifest.proofs(empty).count() == 0


def test_code_words():
    draw = np.random.default_rng(0)
    for n in (0, 1, 239, 240, 1023, 1024, 1025, 5000):
        for ids in (draw.integers(0, 50257, n), np.zeros(n), draw.integers(0, 2 ** draw.integers(0, 63, n), n),
                    np.where(draw.random(n) < 0.02, 2.0 ** 63, 3)):
            ids = ids.astype(np.uint64)
            first, words, escapes = token_file.encode(ids)
            assert (token_file.decode(first, words, escapes, n) == ids).all() and len(first) == -(-n // 1024)
            if n > 1024:  # a block is decoded alone
                part = words[int(first[1]):int(first[2])] if len(first) > 2 else words[int(first[1]):]
                alone = token_file.decode(np.zeros(1, np.uint64), part, escapes, min(1024, n - 1024))
                assert (alone == ids[1024:2048]).all()
    assert len(token_file.encode(np.zeros(960, np.uint64))[1]) == 4
    assert len(token_file.encode(np.full(60, 32767, np.uint64))[1]) == 15


def test_token_files(spark, docs, tmp_path, monkeypatch):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BYTES)
    want, start = [], 0
    texts = {row[0]: row[1] for row in rows() if row[0] != 7}
    order = sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    for row in order:
        ids = [*tokenizer.encode(row[1] or "", add_special_tokens=False).ids, 0]
        want.append((row[0], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    monkeypatch.setattr(token_file, "SEGMENT_IDS", 500)
    monkeypatch.setattr(token_file, "FILE_SEGMENTS", 3)
    token_file.write(docs, f"{tmp_path}/ids", BYTES)
    assert len(list(Path(f"{tmp_path}/ids").glob("part-*"))) > 2
    back = token_file.read(spark, f"{tmp_path}/ids")
    got = token_file.with_starts(back, ["doc_id", "n_tokens", F.crc32("ids").alias("crc")]).orderBy("start").collect()
    assert Counter((r.doc_id, r.n_tokens, r.crc) for r in got) == Counter(want)
    assert [r.doc_id for r in got] == [row[0] for row in order]
    for r in got:
        assert r.start == start
        start += r.n_tokens
    for r in back.filter("doc_id % 9 = 0").collect():
        assert tokenizer.decode(np.frombuffer(r.ids, "<u4")[:-1].tolist(), skip_special_tokens=False) == (texts[r.doc_id] or "")
    token_file.write(docs.filter("false"), f"{tmp_path}/none", BYTES)
    assert token_file.read(spark, f"{tmp_path}/none").count() == 0
    with pytest.raises(ValueError):
        list(token_file.segments(token_file.segment([1], [2], np.array([5, 6], np.uint64))[:-8] + b"damaged!" * 3))


def test_chunks_give_the_ids_of_whole_texts():
    plain, named, pieces = ByteIds(BYTES, plain=True), ByteIds(BYTES), PieceIds(PIECES)
    for text in [*made_texts(1, 4000), "a" * 3000, "it's the  end\n\n of 12 days' work.\tNew", "ÄÖ ü,x ß\n"]:
        for ids in (plain, named):
            assert np.frombuffer(ids.encode(text), "<u4").tolist() == ids.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(pieces.encode(text), "<u4").tolist() == pieces.model.encode(text)


def brute_groups(text, work):
    """Groups of A and B ids, by walking both sides; None without tokens."""
    if not text:
        return None
    sides = work.a.tokenizer.encode(" " + text, add_special_tokens=False).ids, work.b.model.encode(text)
    ends = []
    for ids, table in zip(sides, (work.bytes_a, work.bytes_b)):
        if b"".join(table[i] for i in ids) != (" " + text).encode():
            return None
        ends.append(np.cumsum([len(table[i]) for i in ids]).tolist())
    groups, begin = [], (0, 0)
    for end in sorted({*ends[0]} & {*ends[1]}):
        stop = ends[0].index(end) + 1, ends[1].index(end) + 1
        groups.append((sides[0][begin[0]:stop[0]], sides[1][begin[1]:stop[1]]))
        begin = stop
    return groups


def test_overlaps():
    found = alignment.align(np.array([0, 0, 0, 1]), np.array([2, 5, 6, 9]), np.array([0, 0, 1, 1]), np.array([3, 6, 7, 9]))
    assert sorted(map(tuple, found.overlaps.values.tolist())) == [(0, 0), (1, 0), (1, 1), (2, 1), (3, 2), (3, 3)]
    assert found.a_group.tolist() == [0, 0, 0, 1] and found.b_group.tolist() == [0, 0, 1, 1]
    number = {(int(g), int(p) >> 32, int(p) & 0xFFFFFFFF): int(n) for g, p, n in zip(*alignment.links(
        np.array([5, 5, 6, 7]), np.array([1, 2, 1, 1]), found))}
    assert number[(0, 5, 1)] == 2 and number[(0, 6, 2)] == 1


@pytest.mark.parametrize("most", [0, alignment.BROADCAST_PAIRS])
def test_alignment(docs, monkeypatch, most):
    monkeypatch.setattr(alignment, "BROADCAST_PAIRS", most)
    monkeypatch.setattr(alignment, "BATCH_CHARS", 5000)
    work = alignment.aligner(BYTES, PIECES)
    table = rows()
    pairs = []
    for row in table:
        groups = brute_groups(row[1], work) or []
        pairs.append(Counter((a, b) for left, right in groups for a in left for b in right))
    counts = Counter(pair for held in pairs for pair in held)
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    want = Counter()
    for row, held in zip(table, pairs):
        groups = brute_groups(row[1], work) or []
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        want[row[0], sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(held.values()),
             sum(n for p, n in held.items() if counts[p] == best[p[0]]), sum(n * counts[p] for p, n in held.items()),
             text, sha(text) if text else ""] += 1
    found = alignment.with_counts(alignment.staged(alignment.aligned_documents(docs, BYTES, PIECES)))
    got = Counter(tuple(r) for r in found.select("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups",
                                                 "groups_sha256").collect())
    assert got == want
    assert sum(1 for row in table if row[1] and not brute_groups(row[1], work)) > 3
    assert alignment.with_counts(alignment.aligned_documents(docs.filter("false"), BYTES, PIECES)).count() == 0


def test_columns_with_dots(spark):
    docs = spark.createDataFrame([(1, "a b c", "x"), (2, "a b c", "y"), (3, "d", "z")], "doc_id long, text string, `meta.x` string")
    for kept in (exact_dedup.exact_dedup(docs), near_dedup.near_dedup(docs)):
        assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_remembered_chunks_are_bounded():
    """Two workers of an executor keep two generations each; the older one goes before the younger is copied."""
    assert byte_ids(BYTES).kept <= 3 * CHUNKS_KEPT // 2
    ids = ByteIds(BYTES, kept=2)
    older = ids.older
    for word in ("one", "two", "three", "four", "five", "six", "seven", "eight"):
        ids.encode("the " + word)
        assert ids.older is older and len(ids) <= 4 and len(older) <= 4


def test_chunks_over_line_ends_are_not_remembered():
    from tokenizers import Tokenizer

    tokens = byte_ids(BYTES)
    assert tokens.kept <= 6 * CHUNKS_KEPT // 5
    tokens.clear()
    whole = Tokenizer.from_file(BYTES)
    for text in ("one two.\nThree four", "a b.\n\nc d", "x é.\nÜber 1\n2 it's\nit's", "a don't\ndo ,\nb"):
        assert tokens.encode(text) == np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert tokens and not any("\n" in chunk for chunk in tokens)

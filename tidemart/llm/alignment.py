"""Tokens of two tokenizers aligned by bytes: as-of merges per batch find the overlaps, equal ends cut them into groups."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import load, small_batches, staged
from tidemart.llm.token_ids import SPACE, ByteIds, PieceIds

#: Id pairs whose counts are broadcast; more of them are joined by a shuffle.
BROADCAST_PAIRS = 2_000_000
#: Characters of texts that are aligned at a time, as long as they are whole texts.
BATCH_CHARS = 1_000_000
#: Ids of the second tokenizer fit into so many bits.
SHIFT = 32


class Aligned(NamedTuple):
    """Tokens of a batch in order and how they go together.

    ``overlaps`` has the places of the A and the B token of each pair that shares a byte; ``a_group`` and ``b_group`` number
    the groups through the batch.
    """

    overlaps: pd.DataFrame
    a_group: np.ndarray
    b_group: np.ndarray


def byte_table(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level tokenizer."""
    from tokenizers import Tokenizer

    vocabulary = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    # Bytes that print stand for themselves, the others for the characters from 256 on, in order.
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(prints)]
    byte = {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}
    table = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        table[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
    return table


def piece_table(path: str) -> list[bytes]:
    """The bytes of each id of a sentencepiece model."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return [bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(SPACE, " ").encode()
            for i, piece in enumerate(pieces)]


def align(docs_a: np.ndarray, ends_a: np.ndarray, docs_b: np.ndarray, ends_b: np.ndarray) -> Aligned:
    """Overlaps and groups of the tokens of a batch.

    ``docs`` number the documents of the tokens, in ascending order; ``ends`` are byte ends that run on through the batch.
    Both sides' tokens cover the same bytes of each document, and none is empty.
    """
    starts = lambda ends: np.r_[0, ends[:-1]]
    side = lambda docs, ends, name: pd.DataFrame(
        {"doc": docs, "start": starts(ends), name: np.arange(len(ends)), f"{name}_start": starts(ends)})
    a, b = side(docs_a, ends_a, "a"), side(docs_b, ends_b, "b")
    # Each start lies in the other side's last token that begins no later.
    over_a = pd.merge_asof(a, b, on="start", by="doc")
    over_b = pd.merge_asof(b, a, on="start", by="doc")
    first_a, first_b = (over_a["a_start"] == over_a["b_start"]).to_numpy(), (over_b["a_start"] == over_b["b_start"]).to_numpy()
    # Pairs that start together are found from both sides.
    overlaps = pd.concat([over_a[["a", "b"]], over_b.loc[~first_b, ["a", "b"]]], ignore_index=True)
    # Where both start, both end before: a group begins.
    return Aligned(overlaps, np.cumsum(first_a) - 1, np.cumsum(first_b) - 1)


def links(ids_a: np.ndarray, ids_b: np.ndarray, found: Aligned) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, id pair, number) of the linked id pairs of each group: all A with all B tokens of it.

    In groups with one token on either side the links are the overlaps. Of others, tokens with the same id are counted first.
    """
    groups = (found.a_group[-1] if len(found.a_group) else -1) + 1
    many = (np.bincount(found.a_group, minlength=groups) > 1) & (np.bincount(found.b_group, minlength=groups) > 1)
    a, b = found.overlaps["a"].to_numpy(), found.overlaps["b"].to_numpy()
    group = found.a_group[a]
    simple = ~many[group]
    pair = lambda x, y: (x.astype(np.int64) << SHIFT) | y.astype(np.int64)
    out = [(group[simple], pair(ids_a[a[simple]], ids_b[b[simple]]), np.ones(simple.sum(), np.int64))]
    if many.any():
        def counted(ids: np.ndarray, groups: np.ndarray) -> pd.DataFrame:
            here = many[groups]
            return pd.DataFrame({"group": groups[here], "id": ids[here]}).value_counts(sort=False).rename("n").reset_index()

        both = counted(ids_a, found.a_group).merge(counted(ids_b, found.b_group), on="group")
        out.append((both["group"].to_numpy(), pair(both["id_x"].to_numpy(), both["id_y"].to_numpy()),
                    (both["n_x"] * both["n_y"]).to_numpy()))
    return tuple(np.concatenate(parts) for parts in zip(*out, strict=True))


class Aligner:
    """Encodes and aligns batches of texts; one per Python worker."""

    def __init__(self, path_a: str, path_b: str):
        self.bytes_a, self.bytes_b = byte_table(path_a), piece_table(path_b)
        self.a, self.b = ByteIds(path_a, plain=True, table=self.bytes_a), PieceIds(path_b, table=self.bytes_b)
        sizes = lambda table: np.array([len(x) for x in table], dtype=np.int64)
        self.sizes_a, self.sizes_b = sizes(self.bytes_a), sizes(self.bytes_b)
        signs = lambda n, sign: np.array([f"{i}{sign}" for i in range(n)], dtype=object)
        self.inner_a, self.last_a = signs(len(self.bytes_a), ","), signs(len(self.bytes_a), "|")
        self.inner_b, self.last_b = signs(len(self.bytes_b), ","), signs(len(self.bytes_b), ";")

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides; None where either side's bytes aren't those of a space and the text."""
        if not text:
            return None
        chunks = text.split(" ")
        a = self.a.spelled(chunks, text)
        b = None if a is None else self.b.spelled(chunks, text)
        return None if b is None else (np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4"))

    def batch(self, texts: list[str | None]) -> pd.DataFrame:
        """A row per text: n_a, n_b, n_groups, n_links, groups and the distinct linked id pairs with their numbers."""
        found = [self.tokens(text) for text in texts]
        whole = [x for x in found if x is not None]
        out = pd.DataFrame({"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups": "", "pairs": None, "numbers": None},
                           index=range(len(texts)))
        out["pairs"] = out["numbers"] = pd.Series([[] for _ in texts], dtype=object)
        if not whole:
            return out
        rows = np.array([i for i, x in enumerate(found) if x is not None])
        a, b = np.concatenate([x[0] for x in whole]), np.concatenate([x[1] for x in whole])
        n_a, n_b = np.array([len(x[0]) for x in whole]), np.array([len(x[1]) for x in whole])
        doc_a, doc_b = np.repeat(np.arange(len(whole)), n_a), np.repeat(np.arange(len(whole)), n_b)
        aligned = align(doc_a, np.cumsum(self.sizes_a[a]), doc_b, np.cumsum(self.sizes_b[b]))
        group_doc = doc_a[np.r_[True, aligned.a_group[1:] != aligned.a_group[:-1]]]
        n_groups = np.bincount(group_doc, minlength=len(whole))

        group, pair, number = links(a, b, aligned)
        doc = group_doc[group]
        order = np.lexsort((pair, doc))
        doc, pair, number = doc[order], pair[order], number[order]
        first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])])
        doc, pair, number = doc[first], pair[first], np.add.reduceat(number, first)
        cuts = np.searchsorted(doc, np.arange(1, len(whole)))
        n_links = np.bincount(doc, weights=number, minlength=len(whole)).astype(np.int64)

        signs = self._signs(a, b, aligned)
        ends = np.cumsum(n_a + n_b).tolist()
        # The last sign of a document closes no further group.
        text = ["".join(signs[begin:end])[:-1] for begin, end in zip([0, *ends], ends, strict=False)]
        for name, values in (("n_a", n_a), ("n_b", n_b), ("n_groups", n_groups), ("n_links", n_links), ("groups", text)):
            column = out[name].to_numpy(copy=True)
            column[rows] = values
            out[name] = column
        for name, values in (("pairs", pair), ("numbers", number)):
            column = out[name].to_numpy(copy=True)
            column[rows] = _objects(np.split(values, cuts))
            out[name] = column
        return out

    def _signs(self, a: np.ndarray, b: np.ndarray, found: Aligned) -> list[str]:
        """Ids and separators of the groups in order, the A ids of each before its B ids."""
        last = lambda group: np.r_[group[1:] != group[:-1], True]
        groups = found.a_group[-1] + 1
        before = lambda group: np.r_[0, np.cumsum(np.bincount(group, minlength=groups))]
        out = np.empty(len(a) + len(b), dtype=object)
        out[np.arange(len(a)) + before(found.b_group)[found.a_group]] = np.where(
            last(found.a_group), self.last_a[a], self.inner_a[a])
        out[np.arange(len(b)) + before(found.a_group)[found.b_group + 1]] = np.where(
            last(found.b_group), self.last_b[b], self.inner_b[b])
        return out.tolist()


def _objects(parts: list) -> np.ndarray:
    out = np.empty(len(parts), dtype=object)
    for i, part in enumerate(parts):
        out[i] = part
    return out


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def aligned_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
                      texts: bool = True) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, groups, groups_sha256, pairs and numbers of each document.

    ``groups`` reads ``a1,a2|b1;a3|b2,b3`` (null unless ``texts``), ``pairs`` holds the distinct linked pairs as A id * 2^32
    + B id, ``numbers`` how many links each has. Texts that are null, empty, or not what either side's tokens spell have no
    tokens: zeros, empty texts and lists. Rows that share an id or a text are documents of their own. An empty table gives an
    empty result; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    kind = docs.select(F.col(id_col).alias("id")).schema["id"].dataType

    def parts(column: pd.Series) -> Iterator[slice]:
        begin, size = 0, 0
        for i, text in enumerate(column):
            size += len(text or "")
            if size >= BATCH_CHARS:
                yield slice(begin, i + 1)
                begin, size = i + 1, 0
        yield slice(begin, len(column))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        work = aligner(path_a, path_b)
        for batch in batches:
            for part in parts(batch["text"]):
                out = work.batch(batch["text"].iloc[part].tolist())
                out["id"] = batch["id"].iloc[part].to_numpy()
                out["groups_sha256"] = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in out["groups"]]
                if not texts:
                    out["groups"] = None
                yield out

    kinds = ("n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, numbers array<long>, "
             "id string, groups_sha256 string")
    return narrow.mapInPandas(run, kinds).withColumn("id", F.col("id").cast(kind))


def pair_counts(documents: DataFrame) -> DataFrame:
    """pair, docs (how many documents hold it linked) and best (whether that is the most for its A id)."""
    counts = staged(documents.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs")))
    a = F.shiftright("pair", SHIFT)
    most = counts.groupBy(a.alias("a")).agg(F.max("docs").alias("most"))
    return counts.withColumn("a", a).join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def with_counts(documents: DataFrame) -> DataFrame:
    """``documents`` with n_best and count_sum: links whose count is the highest of their A id, and the sum of all counts.

    Counts reach the documents by a broadcast where there are few enough id pairs, else by a join on the pair, whose hot
    pairs adaptive execution splits. What comes back is a row per document and task.
    """
    counts = staged(pair_counts(documents))
    if counts.limit(BROADCAST_PAIRS + 1).count() <= BROADCAST_PAIRS:
        counts = F.broadcast(counts)
    documents = documents.withColumn("_llm_row", F.monotonically_increasing_id())
    each = documents.select("_llm_row", F.explode(F.arrays_zip("pairs", "numbers")).alias("it"))
    each = each.select("_llm_row", F.col("it.pairs").alias("pair"), F.col("it.numbers").alias("n")).join(counts, "pair")
    sums = each.groupBy("_llm_row").agg(F.sum(F.when(F.col("best"), F.col("n"))).alias("n_best"),
                                        F.sum(F.col("n") * F.col("docs")).alias("count_sum"))
    return documents.join(sums, "_llm_row", "left").fillna(0, ["n_best", "count_sum"]).drop("_llm_row")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens by two public tokenizers, aligned and counted over the corpus."""
    import public_tokenizers as public

    docs = aligned_documents(load(spark, sf_dir, "documents"), public.path("byte_bpe_50k.json"),
                             public.path("piece_bpe_32k.model"), texts=False)
    found = with_counts(staged(docs.drop("groups")))
    return found.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                        "groups_sha256")

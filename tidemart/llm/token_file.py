"""Token ids in binary files: Simple-8b words of 64 bits, with escapes, block offsets and a table of documents.

A file is a run of segments, each followed by the 8 bytes of ``MARK``. A segment holds whole documents, as little-endian
64-bit words:

    MAGIC, documents, ids, blocks, code words, escapes
    id of each document (0 for null)
    2 * number of ids of each document, plus 1 where the id is null
    first code word of each block
    code words, escapes

Each block codes 1024 ids, the last one fewer. A code word's upper 4 bits select how many ids of how many bits fill its other
60, lowest first; the rest of a block's last word is zero. Ids of 60 bits and more, and others that look like it, escape: the
word then holds 2 ** 59 plus the place of the id among the segment's escapes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.common import load, shared_folder, small_batches, staged
from tidemart.llm.token_ids import byte_ids

MAGIC = int.from_bytes(b"S8BIDS01", "little")
MARK = "S8BLKEND"
BLOCK = 1024
#: Ids after which a segment ends with its document; segments of a file.
SEGMENT_IDS = 1 << 18
FILE_SEGMENTS = 128
#: Ids in a word by selector, and their bits.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = 1 << 59
_HEAD = 6
_LENGTHS = np.frexp(np.arange(1 << 16))[1].astype(np.uint8)


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word of each block, code words, escapes) of unsigned 64-bit ``ids``."""
    blocks = -(-len(ids) // BLOCK)
    padded = np.zeros((blocks, BLOCK + COUNTS[0]), np.uint64)
    for block in range(blocks):
        part = ids[block * BLOCK:(block + 1) * BLOCK]
        padded[block, :len(part)] = part
    escaped = padded >= ESCAPE
    escapes = padded[escaped]
    padded[escaped] = ESCAPE + np.arange(len(escapes), dtype=np.uint64)
    width = _bit_lengths(padded)
    # Widest ids of the windows of each length that begin at a place; the longest window whose ids fit is taken.
    selector = np.full((blocks, BLOCK), len(COUNTS) - 1, np.int8)
    widest, reach = {1: width}, 1
    for s in range(len(COUNTS) - 2, -1, -1):
        n = int(COUNTS[s])
        while reach < n:
            step = min(reach, n - reach)
            more = widest[reach].copy()
            more[:, :-step] = np.maximum(more[:, :-step], widest[reach][:, step:])
            reach += step
            widest[reach] = more
        fits = widest[n][:, :BLOCK] <= int(BITS[s])  # a number of numpy would widen the comparison
        if not fits.any():
            break  # nor does any longer window, whose ids have fewer bits
        selector[fits] = s
    # All blocks step from word to word at once.
    begins, jump = np.zeros(blocks * BLOCK, bool), COUNTS[selector].reshape(-1)
    at = np.arange(blocks) * BLOCK
    ends = np.minimum(at + BLOCK, len(ids))
    while len(at):
        begins[at] = True
        at = at + jump[at]
        go = at < ends
        if not go.all():
            at, ends = at[go], ends[go]
    rows, places = np.divmod(np.flatnonzero(begins), BLOCK)
    first = np.searchsorted(rows, np.arange(blocks))
    chosen = selector[rows, places]
    words = chosen.astype(np.uint64) << np.uint64(60)
    flat, starts = padded.reshape(-1), rows * padded.shape[1] + places
    for s in range(2, len(COUNTS)):
        at = np.flatnonzero(chosen == s)
        if len(at):
            start, word = starts[at], words[at]
            for slot in range(int(COUNTS[s])):
                word |= flat[start + slot] << np.uint64(slot * int(BITS[s]))
            words[at] = word
    return first.astype(np.uint64), words, escapes


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits of each number, by a table of those of 16 bits."""
    lengths = _LENGTHS[values & np.uint64(0xFFFF)]
    for shift in (16, 32, 48):
        upper = values >> np.uint64(shift)
        if not upper.any():
            break
        lengths = np.where(upper > 0, shift + _LENGTHS[upper & np.uint64(0xFFFF)], lengths)
    return lengths.astype(np.uint8)


def decode(first: np.ndarray, words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids that :func:`encode` coded, or those of a run of whole blocks."""
    out = np.empty(n, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selector]
    ends = np.cumsum(counts)
    sizes = np.diff(np.append(first, len(words)).astype(np.int64))
    block = np.repeat(np.arange(len(first)), sizes)
    begins = (ends - counts)[first.astype(np.int64)] if len(first) else np.zeros(0, np.int64)
    at = block * BLOCK + (ends - counts) - begins[block]
    end = np.minimum((block + 1) * BLOCK, n)
    for s in np.unique(selector):
        here = np.flatnonzero(selector == s)
        slots = np.arange(COUNTS[s])
        places = at[here, None] + slots
        mask = np.uint64((1 << int(BITS[s])) - 1)
        values = (words[here, None] >> (slots * BITS[s]).astype(np.uint64)) & mask
        if s == len(COUNTS) - 1:
            away = values >= ESCAPE
            values[away] = escapes[(values[away] - np.uint64(ESCAPE)).astype(np.int64)]
        there = places < end[here, None]
        out[places[there]] = values[there]
    return out


def segment(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    first, words, escapes = encode(ids)
    head = [MAGIC, len(doc_ids), len(ids), len(first), len(words), len(escapes)]
    keys = np.array([0 if key is None else key for key in doc_ids], dtype=np.int64)
    sizes = np.array([2 * size + (key is None) for key, size in zip(doc_ids, lengths, strict=True)], dtype=np.uint64)
    parts = [np.array(head, np.uint64), keys.view(np.uint64), sizes, first, words, escapes]
    return b"".join(part.astype("<u8").tobytes() for part in parts)


def segments(content: bytes) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """(document ids, number of ids of each, ids) of the segments of a file."""
    data, at = np.frombuffer(content, "<u8"), 0
    mark = int.from_bytes(MARK.encode(), "little")
    while at < len(data):
        magic, docs, n, blocks, words, escapes = map(int, data[at:at + _HEAD])
        cuts = np.cumsum([at + _HEAD, docs, docs, blocks, words, escapes])
        if magic != MAGIC or cuts[-1] >= len(data) or int(data[cuts[-1]]) != mark:
            raise ValueError("not a file of token ids, or damaged")
        keys, sizes, first, code, rest = (data[a:b] for a, b in zip(cuts, cuts[1:], strict=False))
        names = [None if size & 1 else key for key, size in zip(keys.view(np.int64).tolist(), sizes.tolist(), strict=True)]
        yield names, (sizes >> np.uint64(1)).astype(np.int64), decode(first, code, rest, n)
        at = int(cuts[-1]) + 1


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 0, id_col: str = "doc_id",
          text_col: str = "text") -> None:
    """Files below ``path`` with the ids of all documents in ascending order of their id, null first.

    File names ascend with the documents. Spark's own text writer makes them, so any store that Spark writes to will do, and
    a task that fails leaves nothing. Ids of documents are whole numbers. A null text is an empty document, which holds only
    ``end_id``. Rows that share an id are documents of their own, ordered by text hash. An empty table gives no segments;
    other columns are ignored.
    """
    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"),
                         F.monotonically_increasing_id().alias("row"))
    # The row's place deals even an id that many rows share.
    narrow = narrow.withColumn("hash", F.xxhash64("text")).orderBy("id", "hash", "row")
    narrow = narrow.select(F.col("id").cast("string").alias("id"), "text")  # pandas would make numbers with nulls floating

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = byte_ids(tokenizer)
        last = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        keys, sizes, found, total = [], [], [], 0
        for batch in batches:
            full = []
            for key, text in zip(batch["id"], batch["text"], strict=True):
                ids = tokens.encode(text) + last
                keys.append(None if key is None else int(key))
                sizes.append(len(ids) // 4)
                found.append(ids)
                total += sizes[-1]
                if total >= SEGMENT_IDS:
                    full.append(segment(keys, sizes, np.frombuffer(b"".join(found), "<u4").astype(np.uint64)))
                    keys, sizes, found, total = [], [], [], 0
            yield pd.DataFrame({"segment": full}, dtype=object)
        if keys:
            yield pd.DataFrame({"segment": [segment(keys, sizes, np.frombuffer(b"".join(found), "<u4").astype(np.uint64))]})

    coded = narrow.mapInPandas(run, "segment binary")
    # Text of Spark is bytes; the writer adds the mark after each row.
    (coded.select(F.col("segment").cast("string").alias("value")).write.option("lineSep", MARK)
     .option("maxRecordsPerFile", FILE_SEGMENTS).text(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, file, place, start_in_file, n_tokens, ids) of all documents in files below ``path``.

    ``place`` counts the documents of a file; ``ids`` are little-endian unsigned 32-bit numbers. Damaged files raise an error.
    """
    small_batches(spark)
    kinds = "doc_id string, file string, place long, start_in_file long, n_tokens long, ids binary"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["file"], batch["content"], strict=True):
                place, start = 0, 0
                for names, sizes, ids in segments(content):
                    data, ends = ids.astype("<u4").tobytes(), np.cumsum(sizes)
                    begins = ends - sizes
                    yield pd.DataFrame({
                        "doc_id": [None if name is None else str(name) for name in names], "file": file,
                        "place": np.arange(place, place + len(names)), "start_in_file": start + begins, "n_tokens": sizes,
                        "ids": [data[4 * a:4 * b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]})
                    place, start = place + len(names), start + len(ids)

    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")
    return files.mapInPandas(run, kinds).withColumn("doc_id", F.col("doc_id").cast("long"))


def with_starts(tokens: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and ``start``, the ids of all documents in earlier places of this and earlier files."""
    # One row a file is added up.
    files = tokens.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select(F.col("file"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return tokens.join(files, "file").withColumn("start", F.col("before") + F.col("start_in_file")).select("start", *keep)


def op12_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document written as token ids and read back."""
    import public_tokenizers

    path = f"{shared_folder(spark)}/token-ids-{uuid.uuid4().hex}"
    write(load(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    found = staged(read(spark, path).select("doc_id", "file", "start_in_file", "n_tokens", F.crc32("ids").alias("ids_crc32")))
    return with_starts(found, ["doc_id", "n_tokens", "ids_crc32"])

"""Packing token sequences: non-negative least squares over shallow length combinations, then a greedy fill."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.common import load, ranked, small_batches, staged

WINDOW = 2048
#: Lengths are counted in steps of so many tokens, rounded up.
STEP = 8
#: Pieces of a combination that fills a window.
DEPTH = 3
#: The id that ends a document.
END = (1).to_bytes(4, "little")
#: Words the merges can be applied to directly: lower-case Latin-1 letters, digits, signs but the apostrophe.
PLAIN = re.compile(r"[a-zß-öø-ÿ0-9!-&(-/:-@\[-`{-~]+")
RUNS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:-@\[-`{-~]+")
#: Words after which the older half of what a worker remembers goes; results don't depend on it.
WORDS_KEPT = 400_000
#: Tokens that may stay empty in a window that is not the last.
SPARE = 64


def combinations(slots: int, depth: int = DEPTH) -> np.ndarray:
    """All multisets of 1 to ``depth`` lengths (in steps) that add up to ``slots``; zeros fill up rows."""
    found = []

    def grow(rest: int, most: int, left: int, taken: tuple[int, ...]) -> None:
        if rest == 0:
            found.append(taken + (0,) * left)
        elif left:
            for length in range(min(rest, most), (rest - 1) // left, -1):
                grow(rest - length, length, left - 1, (*taken, length))

    grow(slots, slots, depth, ())
    return np.array(found)


def least_squares(combos: np.ndarray, histogram: np.ndarray, tolerance: float = 1e-6) -> dict[int, float]:
    """Repeat counts x >= 0 of ``combos`` that bring their lengths nearest to ``histogram`` (index: length).

    The active-set method: the combination with the steepest gain joins, the unbounded problem over those
    that joined is solved, and a step towards its solution stops where a count reaches zero.
    """
    bins = len(histogram)
    column = lambda j: np.bincount(combos[j][combos[j] > 0], minlength=bins).astype(float)
    goal, used, x = histogram.astype(float), [], np.zeros(0)
    matrix = np.zeros((bins, 0))
    for _ in range(3 * bins):
        residual = goal - matrix @ x
        padded = np.r_[0.0, residual[1:]]
        gain = padded[combos].sum(axis=1)
        gain[used] = -np.inf
        best = int(gain.argmax())
        if gain[best] <= tolerance * max(1.0, goal.max()):
            break
        used.append(best)
        matrix, x = np.c_[matrix, column(best)], np.r_[x, 0.0]
        while True:
            # The ridge keeps dependent combinations solvable.
            aim = np.linalg.solve(matrix.T @ matrix + 1e-9 * np.eye(len(used)), matrix.T @ goal)
            low = np.flatnonzero(aim <= 1e-12)
            if not len(low):
                x = aim
                break
            with np.errstate(divide="ignore", invalid="ignore"):
                ratio = np.where(x[low] > aim[low], x[low] / (x[low] - aim[low]), 0.0)
            x = x + ratio.min() * (aim - x)
            keep = x > 1e-9
            if not keep.any():
                x = np.zeros(0)
            matrix, x, used = matrix[:, keep], x[keep], [j for j, k in zip(used, keep, strict=True) if k]
            if not used:
                break
    return {j: float(n) for j, n in zip(used, x, strict=True)}


class Plan:
    """Where each piece goes. Pieces are told by length in steps and by rank among the pieces of that length.

    ``places[length]`` holds (first rank, end rank, first sequence, pieces of this length in one sequence, slot);
    ``splits[length]`` holds (first rank, end rank, power of two, first block, first rank of what remains);
    ``blocks`` says at which sequence the blocks of each power of two begin.
    """

    def __init__(self, histogram: dict[int, int], slots: int = WINDOW // STEP):
        self.slots, self.sequences = slots, 0
        self.ends = np.zeros(slots + 1, dtype=np.int64)  # pieces of each length so far
        self.next = np.zeros(slots + 1, dtype=np.int64)  # of these, the first that has no place yet
        self.places: dict[int, list[tuple]] = {}
        self.splits: dict[int, list[tuple]] = {}
        self.block_count: dict[int, int] = {}
        for length, n in histogram.items():
            self.ends[length] = n
        self._combine()
        self._fill()
        self.blocks = {}
        for power, n in sorted(self.block_count.items()):
            self.blocks[power] = self.sequences
            self.sequences += sum(self._block_rows(power, n))

    def _place(self, uses: dict[int, int], times: int) -> None:
        for slot, (length, k) in enumerate(uses.items()):
            first = int(self.next[length])
            self.places.setdefault(length, []).append((first, first + times * k, self.sequences, k, slot))
            self.next[length] += times * k
        self.sequences += times

    def _combine(self) -> None:
        """Full windows first: counts from least squares, rounded, as far as the pieces last."""
        combos = combinations(self.slots)
        combos = combos[((self.ends[combos] > 0) | (combos == 0)).all(axis=1)]
        if not len(combos):
            return
        for j, n in sorted(least_squares(combos, self.ends).items(), key=lambda item: (-item[1], item[0])):
            lengths = [int(v) for v in combos[j] if v]
            uses = {v: lengths.count(v) for v in lengths}
            n = min(round(n), *((self.ends[v] - self.next[v]) // k for v, k in uses.items()))
            if n > 0:
                self._place(uses, int(n))

    def _fill(self) -> None:
        """What is left, largest first. Where a window stays too empty its largest piece is cut, and what
        remains of it comes again; only the very last window may be less full."""
        while (left := self.ends - self.next).any():
            rest, uses = self.slots, {}
            for length in range(self.slots, 0, -1):
                if k := min(rest // length, int(left[length])):
                    uses[length] = k
                    rest -= k * length
            times = min(int(left[length]) // k for length, k in uses.items())
            largest = next(iter(uses))
            last = sum(length * int(n) for length, n in enumerate(left)) <= self.slots
            if rest * STEP > SPARE and largest > 1 and not last:
                self._split(largest, times * uses[largest])
            else:
                self._place(uses, times)

    def _split(self, length: int, n: int) -> None:
        power = largest_block(length)
        first, rest = int(self.next[length]), length - (1 << power) // STEP
        block = self.block_count.get(power, 0)
        self.splits.setdefault(length, []).append((first, first + n, power, block, int(self.ends[rest])))
        self.block_count[power] = block + n
        self.next[length] += n
        self.ends[rest] += n

    def _block_rows(self, power: int, n: int) -> list[int]:
        """Sequences with 1, 2, 4, ... blocks in each, full ones last: none of them is padded."""
        full = WINDOW >> power
        return [(n % full) >> i & 1 for i in range(full.bit_length() - 1)] + [n // full]

    def find(self, length: int, rank: int) -> tuple:
        """("place", sequence, order) or ("split", power, block, rank of the rest)."""
        for first, end, sequence, k, slot in self.places.get(length, ()):
            if first <= rank < end:
                return "place", sequence + (rank - first) // k, slot * WINDOW + (rank - first) % k
        for first, end, power, block, rest in self.splits.get(length, ()):
            if first <= rank < end:
                return "split", power, block + rank - first, rest + rank - first
        raise KeyError((length, rank))

    def find_block(self, power: int, block: int) -> tuple[int, int]:
        """(sequence, order) of a block of 2 ** power tokens."""
        sequence = self.blocks[power]
        *parts, full = self._block_rows(power, self.block_count[power])
        for i, there in enumerate(parts):
            if there:
                if block < 1 << i:
                    return sequence, block
                block -= 1 << i
                sequence += 1
        return sequence + block // (WINDOW >> power), block % (WINDOW >> power)


def largest_block(length: int) -> int:
    """The power of two that every piece of ``length`` (above 1) steps can give away and keep something."""
    return ((length - 1) * STEP).bit_length() - 1


class WordIds(dict):
    """Ids of words as little-endian 32-bit numbers.

    The tokenizer lower-cases and splits at white space before anything else, so a text's ids are those of
    its words in turn, and a word that came before costs one look-up. The last 400,000 to 800,000 words are
    remembered. Within a word the tokenizer splits into runs of letters, single digits and runs of other
    signs; for plain Western words that is done here, which leaves it only the merges.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.tokenizer, self.older = Tokenizer.from_file(path), {}
        to_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self.to_bytes = {c: to_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(33, 256) if PLAIN.match(chr(c))}
        self.merge = self.tokenizer.model.tokenize

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            text = word.decode()
            plain = text.lower()
            if b"<|" not in word and PLAIN.fullmatch(plain):
                found = [token.id for run in RUNS.findall(plain) for token in self.merge(run.translate(self.to_bytes))]
            else:
                found = self.tokenizer.encode(text, add_special_tokens=False).ids
            ids = array("I", found).tobytes()
        self[word] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text and the one that ends a document."""
        data = (text or "").encode("utf-8", "replace")
        if b"<|" not in data:  # the names of special tokens are told by case
            data = data.lower()
        ids = b"".join(map(self.__getitem__, data.split()))
        if len(self) > WORDS_KEPT:
            self.older = dict(self)
            self.clear()
        return ids + END


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One per Python worker, which Spark uses for many tasks."""
    return WordIds(path)


PIECES = "start long, length long, doc_tokens long, crc long, block_crcs array<long>, rest_crcs array<long>"


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document in pieces of a whole window and one remainder, with check sums of what cuts would leave."""
    small_batches(docs.sparkSession)
    # Ids pass through Python as text: pandas would make numbers with nulls floating.
    narrow = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    kind = docs.select(F.col(id_col).alias("id")).schema["id"].dataType

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = word_ids(path)
        for batch in batches:
            rows = []
            for key, text in zip(batch["id"], batch["text"], strict=True):
                ids = words.encode(text)
                tokens = len(ids) // 4
                for start in range(0, tokens, WINDOW):
                    piece = ids[4 * start:4 * (start + WINDOW)]
                    rows.append((key, start, len(piece) // 4, tokens, zlib.crc32(piece), *_cut_crcs(piece)))
            yield pd.DataFrame(rows, columns=["id", "start", "length", "doc_tokens", "crc", "block_crcs", "rest_crcs"])

    return narrow.mapInPandas(run, f"id string, {PIECES}").withColumn("id", F.col("id").cast(kind))


def _cut_crcs(piece: bytes) -> tuple[list[int], list[int]]:
    """Check sums of the blocks that cuts take off one after the other, and of what remains each time."""
    blocks, rests = [], []
    if len(piece) < 4 * WINDOW:
        while (steps := -(-len(piece) // (4 * STEP))) > 1:
            size = 4 << largest_block(steps)
            blocks.append(zlib.crc32(piece[:size]))
            piece = piece[size:]
            rests.append(zlib.crc32(piece))
    return blocks, rests


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, start, length, ids_crc32, doc_tokens, sequence_id, offset of the pieces that fill windows of 2048.

    Only the counts of the 256 lengths reach the driver, which makes the plan from them; a piece finds its
    place there by its rank among those of its length. A null text is an empty document of one token.
    Repeated rows and ids are documents of their own. An empty table gives an empty result; other columns
    are ignored.
    """
    cut = staged(pieces(docs, path, id_col, text_col).withColumn("steps", F.expr(f"int((length + {STEP - 1}) div {STEP})")))
    plan = Plan({r["steps"]: r["n"] for r in cut.groupBy("steps").agg(F.count("*").alias("n")).collect()})
    order = ranked(cut, [F.col(c) for c in ("steps", "id", "start", "length", "crc")])
    begins = order.groupBy("steps").agg(F.min("rank").alias("begin"))
    order = order.join(F.broadcast(begins), "steps")  # at most 256 rows

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                start, length, crc, steps, rank, cuts = row.start, row.length, row.crc, row.steps, row.rank - row.begin, 0
                while (found := plan.find(steps, rank))[0] == "split":
                    _, power, block, rank = found
                    rows.append((row.id, start, 1 << power, row.block_crcs[cuts], row.doc_tokens,
                                 *plan.find_block(power, block)))
                    start, length, crc = start + (1 << power), length - (1 << power), row.rest_crcs[cuts]
                    steps, cuts = -(-length // STEP), cuts + 1
                rows.append((row.id, start, length, crc, row.doc_tokens, *found[1:]))
            yield pd.DataFrame(rows, columns=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "slot"])

    kind = cut.schema["id"].dataType
    placed = order.withColumn("id", F.col("id").cast("string")).mapInPandas(
        run, "id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, slot long")
    placed = placed.withColumn("id", F.col("id").cast(kind))
    # A sequence has at most 2048 pieces.
    before = (Window.partitionBy("sequence_id").orderBy("slot", "id", "start")
              .rowsBetween(Window.unboundedPreceding, -1))
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("slot") \
        .withColumnRenamed("id", id_col)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed by the public tokenizer."""
    import public_tokenizers

    return pack(load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))

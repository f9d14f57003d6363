"""Toxicity by compression distance: which of two zstandard dictionaries makes a window of text shorter."""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import load, small_batches

#: Labelled rows the model is fitted on: at most so many of each label, those with the smallest hash of the id.
TOXIC_ROWS, ORDINARY_ROWS = 1500, 3000
#: Bytes of the words in the toxic dictionary, and of the trained ordinary one, which both sides begin with.
TOXIC_BYTES, ORDINARY_BYTES = 8192, 98304
#: A window is one whole word. Longer runs, as of scripts without spaces, give overlapping pieces, one every ``STEP`` bytes.
LONGEST, PIECE, STEP = 40, 9, 3
#: A word goes to the toxic dictionary if it is in so many of its documents, this share of them and this much likelier there.
LEAST, SHARE, RATIO = 4, 0.005, 30.0
#: Bytes by which a window must be shorter with the toxic dictionary to count, per counter.
GAINS = (1, 2, 3, 4)
#: Gains a worker remembers at most before it begins anew; results don't depend on it.
REMEMBERED = 500_000
#: Bytes of a sample the ordinary dictionary is trained on, and samples at most.
_SAMPLE, _SAMPLES = 96, 60000
# ASCII letters and digits, and all bytes of other letters.
_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
# Both dictionaries end with the first, each window begins with it and ends with the second, which neither holds. Without them
# zstandard stores a short window as it is: a block must save some bytes, and its last eight aren't searched.
_BEGIN, _END = bytes(range(0xE0, 0xF0)), bytes(range(0x10, 0x18))


@dataclass
class Model:
    """Both dictionaries, and the calibration over a document's window gains."""

    toxic: bytes
    ordinary: bytes
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    def score(self, features: np.ndarray) -> np.ndarray:
        z = np.c_[np.ones(len(features)), (features - self.mean) / self.spread] @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _plain(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace").lower()


def windows(text: bytes) -> list[bytes]:
    """The words of the whole text in order, long runs in overlapping pieces."""
    out = []
    for word in _WORD.findall(text):
        if len(word) <= LONGEST:
            out.append(word)
        else:
            out += [word[at:at + PIECE] for at in range(0, len(word) - PIECE + STEP, STEP)]
    return out


class Gains:
    """Window gains of documents: bytes with the ordinary dictionary less bytes with the toxic one."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.to_toxic, self.to_ordinary = self._compress(toxic + _BEGIN), self._compress(ordinary + _BEGIN)
        self.known: dict[bytes, int] = {}

    @staticmethod
    def _compress(content: bytes):
        settings = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_BTOPT, min_match=3, window_log=17, hash_log=14, chain_log=14, search_log=5,
            write_content_size=0, write_checksum=0, write_dict_id=0)
        words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(compression_params=settings)
        return zstandard.ZstdCompressor(dict_data=words, compression_params=settings).compress

    def gain(self, window: bytes) -> int:
        found = self.known.get(window)
        if found is None:
            framed = _BEGIN + b" " + window + b" " + _END
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            found = self.known[window] = len(self.to_ordinary(framed)) - len(self.to_toxic(framed))
        return found

    def features(self, text: str | None) -> list[float]:
        gains = np.array([self.gain(w) for w in windows(_plain(text))] or [0])
        count = [int((gains >= least).sum()) for least in GAINS]
        best = np.sort(gains)[-3:]
        # No length on its own: a text without a gain scores the same however long it is.
        return [best[-1], best.sum(), *(math.log1p(n) for n in count), *(n / len(gains) for n in count)]


def _leans(toxic: int, ordinary: int, toxic_rows: int, ordinary_rows: int) -> bool:
    """Whether what so many rows of each side have leans to the toxic one."""
    return (toxic >= max(LEAST, math.ceil(SHARE * toxic_rows))
            and toxic / toxic_rows > RATIO * (ordinary + 0.25) / max(1, ordinary_rows))


def telling_words(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Windows that lean to toxic text, from the most frequent on, as many as the toxic dictionary takes."""
    found = Counter(w for text in toxic for w in set(windows(text)))
    found = {w: n for w, n in found.items() if _leans(n, 0, len(toxic), len(ordinary))}
    seen = Counter(w for text in ordinary for w in found.keys() & set(windows(text)))
    leaning = sorted((-n, w) for w, n in found.items() if _leans(n, seen[w], len(toxic), len(ordinary)))
    room = np.cumsum([len(w) + 1 for _, w in leaning])
    return [w for (_, w), used in zip(leaning, room, strict=True) if used < TOXIC_BYTES]


def _ordinary_content(texts: list[bytes]) -> bytes:
    """The content of a dictionary trained on ordinary text, or the samples themselves if they are too few to train one."""
    samples = [text[at:at + _SAMPLE] for text in texts for at in range(0, len(text), _SAMPLE)]
    random.Random(1).shuffle(samples)
    try:
        return zstandard.train_dictionary(ORDINARY_BYTES, samples[:_SAMPLES]).as_bytes()[-(ORDINARY_BYTES - 140):]
    except zstandard.ZstdError:
        return b"".join(samples)[:ORDINARY_BYTES]


def dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    """The toxic and the ordinary dictionary.

    Both begin with what is trained on ordinary text. Telling words follow whole in the toxic one, the most frequent last, where
    references are shortest; zstandard's own trainer would cut them. In the ordinary one the same words follow without their
    first and without their last byte, so that words that only share most of a telling word are as short with either.
    """
    common, words = _ordinary_content(ordinary), telling_words(toxic, ordinary)[::-1]
    whole = b" " + b" ".join(words) + b" "
    parts = b"".join(b" " + w[:-1] + b"\0" + w[1:] + b" " for w in words)
    size = max(len(whole), len(parts))
    return common + whole.rjust(size, b"\0"), common + parts.rjust(size, b"\0")


def fit(texts: list[str | None], labels: list[int], toxic_share: float) -> Model:
    """Both dictionaries, then a logistic calibration, weighed so that toxic rows have ``toxic_share``."""
    sides: list[list[bytes]] = [[], []]
    for text, label in zip(texts, labels, strict=True):
        sides[label].append(_plain(text))
    if not sides[0] or not sides[1]:
        level = 6.0 if sides[1] else -6.0
        n = 2 + 2 * len(GAINS)
        return Model(b"", b"", np.zeros(n), np.ones(n), np.r_[level, np.zeros(n)])
    toxic, ordinary = dictionaries(sides[1], sides[0])
    gains = Gains(toxic, ordinary)
    x, y = np.array([gains.features(text) for text in texts], float), np.array(labels, float)
    mean, spread = x.mean(0), x.std(0) + 1e-9
    share = y.mean()
    weigh = np.where(y == 1, toxic_share / share, (1 - toxic_share) / (1 - share))
    return Model(toxic, ordinary, mean, spread, _logistic(np.c_[np.ones(len(x)), (x - mean) / spread], y, weigh))


def _logistic(x: np.ndarray, y: np.ndarray, weigh: np.ndarray) -> np.ndarray:
    """Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = x.T @ (x * (weigh * (p * (1 - p) + 1e-6))[:, None]) + 0.5 * np.eye(len(w))
        w += np.linalg.solve(hessian, x.T @ (weigh * (y - p)) - 0.5 * w)
    return w


def held_out(id_col: str = "doc_id"):
    """One row in five by its id; never learned from. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from a bounded sample of labelled rows that are not held out (``TOXIC_ROWS``, ``ORDINARY_ROWS``).

    Only the sample reaches the driver. A document labelled twice takes the higher label.
    """
    known = (labels.filter(F.col("toxic").isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
             .groupBy(F.col(id_col).alias("id")).agg(F.max("toxic").alias("label")))
    shares = known.agg(F.avg("label")).first()[0] or 0.0
    pick = [known.filter(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(rows)
            for label, rows in ((1, TOXIC_ROWS), (0, ORDINARY_ROWS))]
    sample = F.broadcast(pick[0].unionAll(pick[1]))
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(sample, "id")
            .groupBy("id", "label").agg(F.max("text").alias("text")).collect())
    rows = sorted(rows, key=lambda r: r["id"])
    return fit([r["text"] for r in rows], [r["label"] for r in rows], shares)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          hashes: bool = False) -> DataFrame:
    """id, score in 0 to 1 and predicted for every row, and text_hash, the xxhash64 of its text, if ``hashes`` asks for
    that; whole texts, null read as empty, each row alone.

    A text without words, as an empty one, has one window without a gain. Repeated rows score alike; an empty table gives an empty
    result; other columns are ignored.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gains = Gains(model.toxic, model.ordinary)
        for batch in batches:
            found = np.array([gains.features(text) for text in batch["text"]], float).reshape(len(batch), -1)
            scores = model.score(found) if len(batch) else np.zeros(0)
            yield pd.DataFrame({"id": batch["id"], "score": scores, "predicted": (scores >= 0.5).astype("int32"),
                                **({"text_hash": batch["text_hash"]} if hashes else {})})

    # Ids pass through Python as text: pandas would make numbers with nulls floating.
    narrow = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    kind = docs.select(F.col(id_col).alias("id")).schema["id"].dataType
    if hashes:
        narrow = narrow.withColumn("text_hash", F.xxhash64("text"))
    more = ["text_hash"] if hashes else []
    return (narrow.mapInPandas(run, "id string, score double, predicted int" + "".join(f", {c} long" for c in more))
            .select(F.col("id").cast(kind).alias(id_col), "score", "predicted", *more))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = load(spark, sf_dir, "documents")
    found = score(docs, train(docs, load(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")

"""Language of pages: text likelihoods, declared language and address priors fused by Bayes' rule."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.common import load, small_batches, staged

#: Documents of each language the text model is fitted on at most, those with the smallest hash of the id.
TRAIN_ROWS = 400
#: Parts of a language's documents this sample is drawn from.
PARTS = 8
#: Hashed three-character runs the text model tells apart, and what each language has of every one beforehand.
RUNS, SMOOTH = 1 << 16, 0.1
#: Runs overlap and repeat, so their evidence counts as that of fewer independent ones, of 60 at most.
EVIDENCE, MOST = 0.2, 60.0
#: Pages that a level of the address is worth before its own pages speak, and the same for declarations.
PRIOR, DECLARED = 4.0, 1.0

_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|title)\b.*?(?:</\1\s*>|\Z)|<[^>]*>?", re.DOTALL | re.IGNORECASE)
_LANG = r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})"
_HOST = r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def _runs(text: str) -> np.ndarray:
    """Bucket of each run of three characters, letters lower-cased, everything between words one blank."""
    plain = " " + " ".join(re.findall(r"[^\W\d_]+", text.lower())) + " "
    codes = np.frombuffer(plain.encode("utf-32-le"), "<u4").astype(np.uint64)
    if len(codes) < 3:
        return np.zeros(0, np.int64)
    mixed = ((codes[:-2] * np.uint64(0x1F123BB5) + codes[1:-1]) * np.uint64(0x1F123BB5) + codes[2:])
    return ((mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"):
    """(languages, log probability of each run in each) from a bounded sample of each language's documents."""
    # A language may have most documents: its smallest hashes are found within parts, then among what the parts keep.
    within, pick = (Window.partitionBy("lang", *part).orderBy("h", "id") for part in (["part"], []))
    ids = (docs.filter(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
           .select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.xxhash64(id_col).alias("h")).distinct()
           .withColumn("part", F.pmod("h", F.lit(PARTS)))
           .withColumn("n", F.row_number().over(within)).filter(F.col("n") <= TRAIN_ROWS)
           .withColumn("n", F.row_number().over(pick)).filter(F.col("n") <= TRAIN_ROWS).select("id", "lang"))
    rows = (docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
            .join(F.broadcast(ids), ["id", "lang"])  # at most TRAIN_ROWS for each language
            .groupBy("id", "lang").agg(F.max("text").alias("text")).collect())
    languages = sorted({r["lang"] for r in rows})
    counts = np.full((len(languages), RUNS), SMOOTH)
    for r in rows:
        counts[languages.index(r["lang"])] += np.bincount(_runs(r["text"] or ""), minlength=RUNS)
    return languages, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def _evidence(pages: DataFrame, model: np.ndarray) -> DataFrame:
    """Page rows with ``text``: for each language, the log likelihood of the page's text."""
    small_batches(pages.sparkSession, 200)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for source in batch["html"]:
                buckets = _runs(_HIDDEN.sub(" ", source or ""))
                weight = min(EVIDENCE, MOST / max(1, len(buckets)))
                found.append((model[:, buckets].sum(axis=1, dtype=np.float64) * weight).tolist())
            yield batch.drop(columns="html").assign(text=found)

    return pages.mapInPandas(run, "id string, url string, declared string, host string, domain string, suffix string, "
                                  "text array<double>")


def _softmax(logs: str) -> Column:
    return F.expr(f"""transform(transform({logs}, x -> exp(x - array_max({logs}))),
      x -> x / aggregate(transform({logs}, y -> exp(y - array_max({logs}))), 0D, (s, y) -> s + y))""")


def _level(rows: DataFrame, key: str, count: int) -> DataFrame:
    """Summed text posteriors of the rows of each key; sums are combined before they are shuffled."""
    sums = F.array(*[F.sum(F.col("soft")[i]) for i in range(count)])
    return rows.groupBy(F.col(key).alias(f"{key}_key")).agg(sums.alias(f"{key}_sums"))


def identify(pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url_col: str = "url",
             html_col: str = "html") -> DataFrame:
    """id, url, lang, probability, text_lang, declared_lang and host of every page.

    The text gives a likelihood for each language the documents have; how far declared languages are to be
    trusted is counted over all pages. The prior of a host shrinks towards that of its domain, this towards
    the address suffix's, this towards all pages'; a page's own text is taken out of these counts, so it
    doesn't speak twice. Null or empty html gives no text evidence, a null or odd address the empty host;
    ties go to the first language by name. Without documents lang is null. Repeated rows are pages of
    their own; an empty table gives an empty result.
    """
    languages, model = train(docs)
    kind = pages.select(F.col(id_col).alias("id")).schema["id"].dataType
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), _HOST, 1))
    rows = pages.select(
        F.col(id_col).cast("string").alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
        F.lower(F.regexp_extract(F.coalesce(F.col(html_col), F.lit("")), _LANG, 1)).alias("declared"), host.alias("host"))
    rows = rows.select("id", "url", "html", "declared", "host",
                       F.substring_index("host", ".", -2).alias("domain"), F.substring_index("host", ".", -1).alias("suffix"))
    if not languages:
        none = F.lit(None)
        return rows.select(F.col("id").cast(kind).alias(id_col), F.col("url").alias(url_col), none.cast("string").alias("lang"),
                           none.cast("double").alias("probability"), none.cast("string").alias("text_lang"),
                           F.nullif("declared", F.lit("")).alias("declared_lang"), "host")
    n = len(languages)
    rows = staged(_evidence(rows, model).withColumn("soft", _softmax("text")))

    whole = staged(rows.agg(F.array(*[F.coalesce(F.sum(F.col("soft")[i]), F.lit(0.0)) for i in range(n)]).alias("all_sums")))
    joined = rows.crossJoin(F.broadcast(whole))  # one row
    for key in ("suffix", "domain", "host", "declared"):
        level = _level(rows, key, n)
        joined = joined.join(level, F.col(key) == F.col(f"{key}_key"))
    kinds = rows.select("declared").distinct().count() + 1
    prior = f"transform(all_sums, (x, i) -> (greatest(x - soft[i], 0D) + 1) / (aggregate(all_sums, 0D, (s, y) -> s + y) - 1 + {n}))"
    for key in ("suffix", "domain", "host"):
        own = f"transform({key}_sums, (x, i) -> greatest(x - soft[i], 0D))"
        prior = (f"transform({own}, (x, i) -> (x + {PRIOR}D * ({prior})[i]) / "
                 f"(aggregate({own}, 0D, (s, y) -> s + y) + {PRIOR}D))")
        joined = joined.withColumn("prior", F.expr(prior))
        prior = "prior"
    said = (f"(greatest(declared_sums[i] - soft[i], 0D) + {DECLARED}D) / "
            f"(greatest(all_sums[i] - soft[i], 0D) + {DECLARED * kinds}D)")
    fused = joined.withColumn("logs", F.expr(f"transform(text, (t, i) -> t + ln(prior[i]) + ln({said}))"))
    fused = fused.withColumn("posterior", _softmax("logs"))
    names = F.array(*map(F.lit, languages))
    name = lambda values: F.get(names, F.array_position(values, F.array_max(values)).cast("int") - 1)
    return fused.select(
        F.col("id").cast(kind).alias(id_col), F.col("url").alias(url_col), name("posterior").alias("lang"),
        F.array_max("posterior").alias("probability"), name("text").alias("text_lang"),
        F.nullif("declared", F.lit("")).alias("declared_lang"), "host")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page."""
    return identify(load(spark, sf_dir, "pages"), load(spark, sf_dir, "documents"))

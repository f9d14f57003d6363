"""Near duplicates: b-bit MinHash signatures joined by a multi-index Hamming join, confirmed on full sets.

A signature has 72 symbols of 8 bits in 12 chunks of 6. Two signatures that differ in at most 23 symbols
have, by pigeonhole, a chunk with at most one error; leaving out each symbol of each chunk in turn gives 72
keys of which such a pair shares one. All pairs within that distance are therefore found, and at the
limit of 0.8 a pair is missed with a probability of 0.000003, for then each of its chunks has two errors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import load, maybe_member, ranked, small_batches, staged
from tidemart.llm.exact_dedup import drop_rows

CHUNKS, CHUNK = 12, 6
SYMBOLS = CHUNKS * CHUNK
#: Candidates that differ in more symbols are none; a pair of 0.8 does so with a probability of 0.000005.
MOST_ERRORS = 30
#: Percent of the union that two linked sets share.
SHARED = 80
#: Members of a bucket from which on pairs are compared in blocks, and members of a block.
PAIRWISE, BLOCK = 64, 256
_WORDS_KEPT = 150_000
_draw = np.random.default_rng(7)
_FACTORS = _draw.integers(1, 1 << 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SUMMANDS = _draw.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64)
_PLACES = np.arange(CHUNK, dtype=np.uint64) * np.uint64(8)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Shingles:
    """The set of word shingles of a text as sorted 64-bit hashes."""

    def __init__(self, words: int):
        self.words, self.known = words, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "replace").lower().split()  # of bytes: only A-Z, only ASCII blanks
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > _WORDS_KEPT:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        hashes = np.fromiter((known[word] for word in words), np.uint64, len(words))
        n = min(self.words, len(words))
        mixed = np.full(len(words) - n + 1, n, np.uint64)
        for i in range(n):
            mixed = (mixed ^ hashes[i:len(words) - n + 1 + i]) * _MIX
            mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The chunks of the signature, six symbols in each long."""
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), 4096):
        least = np.minimum(least, (np.multiply.outer(_FACTORS, shingles[at:at + 4096]) + _SUMMANDS[:, None]).min(axis=1))
    symbols = ((least ^ (least >> np.uint64(31))) * _MIX) >> np.uint64(56)
    return (symbols.reshape(CHUNKS, CHUNK) << _PLACES).sum(axis=1).astype(np.int64)


def _signed(docs: DataFrame, words: int) -> DataFrame:
    """id, n, set_hash (128 bits of the whole set), signature and text_hash of each row (id as text, text, text_hash)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles(words)
        for batch in batches:
            sets = [shingles(text) for text in batch["text"]]
            yield pd.DataFrame({
                "id": batch["id"], "n": [len(s) for s in sets],
                "set_hash": [xxhash.xxh3_128_hexdigest(s.tobytes()) for s in sets],
                "sig": [signature(s) for s in sets], "text_hash": batch["text_hash"]})

    return docs.mapInPandas(run, "id string, n long, set_hash string, sig array<long>, text_hash long")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """set_hash and the hashes of the set of each row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles(words)
        for batch in batches:
            sets = [shingles(text) for text in batch["text"]]
            yield pd.DataFrame({"set_hash": [xxhash.xxh3_128_hexdigest(s.tobytes()) for s in sets],
                                "hashes": [s.view(np.int64) for s in sets]})

    return docs.mapInPandas(run, "set_hash string, hashes array<long>")


def _keyed(classes: DataFrame, *more: str) -> DataFrame:
    """(j, key, cls, more columns): for each chunk, the chunk without each of its symbols."""
    keys = F.expr(f"""transform(sequence(0, {SYMBOLS - 1}), j -> named_struct('j', j, 'key', xxhash64(j,
      sig[j div {CHUNK}] & ~shiftleft(255L, 8 * (j % {CHUNK})))))""")
    return classes.select(F.explode(keys).alias("k"), "cls", *more).select("k.j", "k.key", "cls", *more)


#: The lowest bit of each symbol of a chunk.
_LOWEST = sum(1 << 8 * i for i in range(CHUNK))


def _errors_text(x: str, y: str) -> str:
    """SQL for the number of symbols in which each chunk of x and y differs."""
    folded = "{0}"
    for by in (4, 2, 1):
        folded = f"({folded} | shiftrightunsigned({folded}, {by}))"
    # Folding to the right brings bits of the next symbol in, but only above the lowest bit of each.
    return (f"transform(sequence(0, {CHUNKS - 1}), c -> bit_count("
            + folded.replace("{0}", f"({x}[c] ^ {y}[c])") + f" & {_LOWEST}L))")


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of the edges (a, b), by contraction.

    In every round each node joins its neighbour with the smallest hash, if that is smaller than its own,
    and edges are redrawn between what the nodes became. The hashes are as good as random, so rounds are
    few however long a chain is. Counts by node are combined before they are shuffled.
    """
    labels = None
    while True:
        both = staged(edges.union(edges.select("b", "a")).distinct())
        near = both.groupBy("a").agg(F.min(F.struct(F.xxhash64("b").alias("h"), F.col("b"))).alias("m"))
        own = F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("b"))
        parent = staged(near.select(F.col("a").alias("node"), F.least("m", own)["b"].alias("root")))
        if labels is None:
            labels = parent
        else:
            onward = parent.select(F.col("node").alias("root"), F.col("root").alias("next"))
            labels = staged(labels.join(onward, "root", "left")
                            .select("node", F.coalesce("next", "root").alias("root")))
        to = lambda c: parent.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
        edges = staged(both.filter("a < b").join(to("a"), "a").join(to("b"), "b").filter("a_root != b_root")
                       .select(*_ordered("a_root", "b_root")).distinct())
        if edges.isEmpty():
            return labels


def _links_between(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Links between the sets of two blocks, for each left set one with every component that it links to."""
    found: list[tuple[int, int]] = []
    if len(left) and len(right):
        sizes = right["other_hashes"].map(len).to_numpy()
        owners, hashes = np.repeat(np.arange(len(right)), sizes), np.concatenate(right["other_hashes"].to_list())
        order = np.argsort(hashes, kind="stable")
        hashes, owners = hashes[order], owners[order]
        classes, comps = right["other"].to_numpy(), right["other_comp"].to_numpy()
        for cls, comp, own in zip(left["cls"], left["comp"], left["hashes"], strict=True):
            begins, ends = np.searchsorted(hashes, own, "left"), np.searchsorted(hashes, own, "right")
            counts = ends - begins
            at = np.arange(counts.sum()) + np.repeat(begins - np.cumsum(counts) + counts, counts)
            shared = np.bincount(owners[at], minlength=len(right))
            hit = (shared * 100 >= (len(own) + sizes - shared) * SHARED) & (comps != comp)
            _, one = np.unique(comps[hit], return_index=True)
            found += [(min(cls, c), max(cls, c)) for c in classes[hit][one].tolist()]
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


class NearGroups:
    """The join over the classes of equal sets: ``classes`` (cls, id, set_hash, n, sig) of ``docs`` (id, text)."""

    def __init__(self, docs: DataFrame, classes: DataFrame, words: int):
        self.docs, self.classes, self.words = docs, classes, words
        self.keyed = _keyed(classes)

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) of classes whose sets share enough, counted on the full sets."""
        side = lambda c: self.classes.select(F.col("cls").alias(c), F.col("n").alias(f"n_{c}"),
                                             F.col("sig").alias(f"sig_{c}"))
        errors = F.aggregate(F.expr(_errors_text("sig_a", "sig_b")), F.lit(0), lambda total, e: total + e)
        near = staged(pairs.join(side("a"), "a").join(side("b"), "b")
                      .filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * SHARED)
                      .filter(errors <= MOST_ERRORS).select("a", "b", "n_a", "n_b"))
        ids = near.select(F.col("a").alias("cls")).union(near.select("b")).distinct()
        sets = self._sets_of(ids)
        side = lambda c: sets.select(F.col("cls").alias(c), F.col("hashes").alias(f"set_{c}"))
        shared = F.size(F.array_intersect("set_a", "set_b"))
        return staged(near.join(side("a"), "a").join(side("b"), "b")
                      .filter(shared * 100 >= (F.col("n_a") + F.col("n_b") - shared) * SHARED).select("a", "b"))

    def _sets_of(self, ids: DataFrame) -> DataFrame:
        """(cls, hashes) of the classes ``ids``, from the texts of one document of each."""
        wanted = self.classes.join(ids, "cls", "left_semi").select("cls", "id", "set_hash")
        docs = maybe_member(self.docs, F.col("id"), wanted, F.col("id"), "_llm_maybe").filter("_llm_maybe")
        return staged(_sets(docs.select("text"), self.words).join(wanted, "set_hash")
                      .groupBy("cls").agg(F.first("hashes").alias("hashes")))

    def links(self) -> DataFrame:
        """Confirmed pairs that connect all classes a chain of links connects.

        A bucket of m members would give m * m pairs. Instead its members are first compared with its smallest
        one. Those that this leaves in different components are compared pair by pair in small buckets, and
        in larger ones block by block inside tasks, which give back only links.
        """
        buckets = staged(self.keyed.groupBy("key").agg(
            F.min("cls").alias("a"), F.max("cls").alias("b"), F.count("*").alias("n")).filter("n > 1"))
        large = buckets.filter("n > 2").select("key", F.col("a").alias("center"))
        members = _keyed(self.classes, "n", "sig")
        members = maybe_member(members, F.col("key"), large, F.col("key"), "_llm_maybe").filter("_llm_maybe")
        members = staged(members.join(large, "key").select("key", "j", "cls", "n", "sig", "center"))
        pairs = (buckets.filter("n = 2").select("a", "b")
                 .union(members.filter("cls != center").select(*_ordered("cls", "center"))).distinct())
        tried = staged(pairs)
        links = self.confirmed(tried)
        apart = self._apart(members, links)
        few = self._all_apart(apart.filter(F.col("m") <= PAIRWISE))
        fresh = staged(few.distinct().join(tried, ["a", "b"], "left_anti"))
        return links.union(self.confirmed(fresh)).union(self._compared(apart.filter(F.col("m") > PAIRWISE)))

    def _apart(self, members: DataFrame, links: DataFrame) -> DataFrame:
        """The members of buckets that hold several components, with the bucket's size m, its largest component
        main and how many members that has, most: (key, j, cls, comp, m, main, most, n, sig)."""
        known = components(links).withColumnRenamed("node", "cls")
        now = members.join(known, "cls", "left").select(
            "key", "j", "cls", "n", "sig", F.coalesce("root", "cls").alias("comp"))
        split = (now.groupBy("key", "comp").agg(F.count("*").alias("x")).groupBy("key")
                 .agg(F.max_by("comp", F.struct("x", "comp")).alias("main"), F.sum("x").alias("m"),
                      F.max("x").alias("most"), F.count("*").alias("comps")).filter("comps > 1").drop("comps"))
        return staged(now.join(split, "key"))

    def _compared(self, apart: DataFrame) -> DataFrame:
        """Links (a, b) between components that meet in the same bucket, one for each class and component.

        Members outside a bucket's largest component meet all members: both are dealt into blocks of about
        ``BLOCK``, and each pair of blocks is one task's group, however large the bucket.
        """
        sets = self._sets_of(apart.select("cls").distinct())
        rows = apart.withColumn("lefts", F.expr(f"int((m - most) div {BLOCK} + 1)")) \
            .withColumn("rights", F.expr(f"int(m div {BLOCK} + 1)")).join(sets, "cls")
        block = lambda n: F.pmod(F.xxhash64("cls"), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        out = [F.col(c) for c in ("cls", "comp", "hashes")]
        left = rows.filter("comp != main").select("key", block("lefts").alias("l"), every("rights").alias("r"), *out)
        # Renamed, so that Spark can tell the two sides of the same rows apart.
        right = rows.select("key", every("lefts").alias("l"), block("rights").alias("r"), *out).toDF(
            "right_key", "right_l", "right_r", "other", "other_comp", "other_hashes")
        right_keys, keys = ("right_key", "right_l", "right_r"), ("key", "l", "r")
        found = left.groupBy(*keys).cogroup(right.groupBy(*right_keys)).applyInPandas(_links_between, "a long, b long")
        return staged(found.distinct())

    @staticmethod
    def _all_apart(apart: DataFrame) -> DataFrame:
        """Pairs of members of different components that size and signature allow, each in the first key it shares.

        Members of the largest component of a bucket meet only those outside it.
        """
        left = apart.filter("comp != main").select(
            "key", "j", F.col("comp").alias("comp_x"), F.col("cls").alias("x"), F.col("n").alias("n_x"),
            F.col("sig").alias("sig_x"))
        right = apart.select("key", "comp", "main", F.col("cls").alias("y"), F.col("n").alias("n_y"),
                            F.col("sig").alias("sig_y"))
        first = f"""forall(slice(e, 1, j div {CHUNK}), v -> v > 1) and (j % {CHUNK} = 0 or e[j div {CHUNK}] = 1)
          and aggregate(e, 0, (s, v) -> s + v) <= {MOST_ERRORS}"""
        met = (left["key"] == right["key"]) & F.expr(
            f"(comp = main or comp_x < comp) and least(n_x, n_y) * 100 >= greatest(n_x, n_y) * {SHARED}")
        allowed = F.expr(f"exists(array({{errors}}), e -> {first})".replace("{errors}", _errors_text("sig_x", "sig_y")))
        return left.join(right, met & allowed).select(*_ordered("x", "y"))


def near_groups(docs: DataFrame, words: int = 5, id_col: str = "doc_id", text_col: str = "text",
                hashes: bool = False) -> DataFrame:
    """id, n_shingles, component_id and kept of every row: groups that links of 0.8 or more connect; text_hash, the
    xxhash64 of its text, too if ``hashes`` asks for that.

    A text's set holds its distinct shingles of ``words`` words, lower-cased in A-Z; with fewer words the
    whole sequence is the one shingle; without words or text the set is empty and linked with nothing. Rows
    of equal sets are one class, so copies cost nothing more. The component's id is its smallest; rows
    that repeat it all stay. Rows with a null id stand alone with a null component and stay. An empty table
    gives an empty result; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    kind = docs.select(F.col(id_col).alias("id")).schema["id"].dataType.simpleString()
    narrow = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    rows = staged(_signed(narrow.withColumn("text_hash", F.xxhash64("text")), words))
    linked = rows.filter("n > 0 and id is not null")
    classes = linked.groupBy("set_hash").agg(
        F.min(F.col("id").cast(kind)).alias("id"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    classes = ranked(classes, [F.col("set_hash")], "cls").withColumn("first_id", F.col("id"))
    classes = staged(classes.withColumn("id", F.col("id").cast("string")))

    found = NearGroups(narrow, classes, words)
    roots = components(found.links()).withColumnRenamed("node", "cls")
    placed = staged(classes.join(roots, "cls", "left")
                    .select("set_hash", "first_id", F.coalesce("root", "cls").alias("root")))
    least = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_set = placed.join(least, "root").select("set_hash", "component_id")
    grouped = linked.join(of_set, "set_hash").select(F.col("id").cast(kind).alias("id"), "n", "component_id", "text_hash")
    alone = rows.filter("n = 0 or id is null").select(F.col("id").cast(kind).alias("id"), "n",
                                                      F.col("id").cast(kind).alias("component_id"), "text_hash")
    return grouped.unionAll(alone).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"), *(["text_hash"] if hashes else []))


def near_dedup(docs: DataFrame, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each near-duplicate group, all columns kept."""
    groups = near_groups(docs, words, id_col, text_col, hashes=True)
    gone = staged(groups.filter("not kept").select(id_col, "text_hash").distinct())
    return drop_rows(docs, gone, F.xxhash64(F.col(text_col)), id_col)


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate group of every document, on shingles of two words."""
    return near_groups(load(spark, sf_dir, "documents"), words=2)

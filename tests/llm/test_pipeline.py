"""The pipeline's stages on the smallest test tables, and the queries that SQL can state."""

import math
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from compare import compare, connect

import corpus_pipeline
from tidemart.llm import exact_dedup, mixing, near_dedup, toxicity
from tidemart.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
BLANK = r"[\x20\x09-\x0D]+"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are missing")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    got, want, differences = compare(spark, connect(SF_DIR), QUERIES[name], ORACLES[name], SF_DIR)
    assert differences == [] and got == want > 0


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before, texts = docs, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.staged(stage(spark, before, SF_DIR))
        assert after.columns == docs.columns
        ids = [r.doc_id for r in after.select("doc_id").collect()]
        if name != "mixing":
            assert len(ids) == len(set(ids)) <= before.count()
        if name == "exact_dedup":
            assert len({" ".join(texts[i].split()) for i in ids}) == len(ids)
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SF_DIR)
    tokens = packed.groupBy("sequence_id").sum("length").collect()
    assert max(r[1] for r in tokens) <= 2048 and {r.doc_id for r in packed.select("doc_id").collect()} == set(ids)


def test_rows_that_share_an_id(spark, monkeypatch):
    base = " ".join(f"word{i}" for i in range(90))
    rows = [(1, base), (2, base.replace("word7 ", "other ")), (2, "one of a kind"), (3, base), (3, "another of a kind"),
            (4, "you moron text 7"), (4, "a kind word"), (None, "you moron text 7")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = lambda df: sorted((r.doc_id or 0, r.text) for r in df.collect())
    all_rows = sorted((i or 0, text) for i, text in rows)
    assert left(exact_dedup.exact_dedup(docs)) == [r for r in all_rows if r != (3, base)]
    assert left(near_dedup.near_dedup(docs)) == [r for r in all_rows if r not in (rows[1], (3, base))]
    texts = ["you moron " * (i % 2) + f"text {i}" for i in range(400)]
    monkeypatch.setattr(toxicity, "train", lambda *_: toxicity.fit(texts, [i % 2 for i in range(400)], 0.5))
    assert left(corpus_pipeline.drop_toxic(spark, docs, SF_DIR)) == [r for r in all_rows if r != (4, "you moron text 7")]


def kept_by_brute_force(name, rows, toxic):
    """Ids that a stage keeps, by comparing everything with everything."""
    if name == "toxicity":
        return {i for i in rows if i not in toxic}
    if name == "exact_dedup":
        first = {}
        for i in sorted(rows):
            first.setdefault(re.sub(BLANK, " ", rows[i] or ""), i)
        return set(first.values())
    sets = {}
    for i, text in rows.items():
        found = (text or "").encode("utf-8", "replace").lower().split()
        sets[i] = {tuple(found[k:k + 5]) for k in range(max(1, len(found) - 4))} if found else set()
    root = {i: i for i in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b), 1) and 5 * len(a & b) >= 4 * len(a | b):
                x, y = sorted((top(i), top(j)))
                root[y] = x
    return {i for i in rows if top(i) == i}


def copies_by_brute_force(rows):
    """How often each id is taken, from its source's target and its place in the source."""
    sources = {}
    for r in rows:
        size = len(re.sub(BLANK, " ", r.text or "").strip(" ").split(" ")) if (r.text or "").strip(" \t\n\v\f\r") else 0
        sources.setdefault(r.source, []).append((size, r.doc_id))
    names = sorted(sources, key=lambda name: (name is None, name or ""))
    weight = {name: k % mixing.WEIGHTS + 1 for k, name in enumerate(names)}
    total = {name: sum(size for size, _ in sources[name]) for name in names}
    capped = set()
    while True:
        free = [name for name in names if name not in capped]
        share = sum(total.values()) - sum(mixing.LIMIT * total[name] for name in capped)
        per = sum(weight[name] for name in free)
        above = {name for name in free if mixing.LIMIT * total[name] * per <= weight[name] * share}
        if not above:
            break
        capped |= above
    taken = Counter()
    for name in names:
        target = float(mixing.LIMIT * total[name]) if name in capped else weight[name] * share / per
        each = target / total[name] if total[name] else 0.0
        for k, (_, key) in enumerate(sorted(sources[name])):
            taken[key] += math.floor((k + 1) * each + mixing.OFFSET) - math.floor(k * each + mixing.OFFSET)
    return +taken


def test_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        rows = {r.doc_id: r.text for r in docs.collect()}
        toxic = set()
        if name == "toxicity":  # the model row by row, outside Spark
            model = toxicity.train(docs, labels)
            gains = toxicity.Gains(model.toxic, model.ordinary)
            toxic = {i for i, text in rows.items() if model.score(np.array([gains.features(text)], float))[0] >= 0.5}
        docs = corpus_pipeline.staged(stage(spark, docs, SF_DIR))
        got = docs.collect()
        assert {r.doc_id: r.text for r in got} == {i: rows[i] for i in kept_by_brute_force(name, rows, toxic)} and len(got) <= len(rows)
    mixed = Counter(r.doc_id for r in corpus_pipeline.mix_sources(spark, docs, SF_DIR).collect())
    assert mixed == copies_by_brute_force(got)

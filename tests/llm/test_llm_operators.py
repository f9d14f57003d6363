"""The operators against brute force on small fixtures with nulls, empty texts, ties and clashing columns."""

import pathlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemart.llm import (
    exact_dedup,
    html_text,
    language,
    mixing,
    near_dedup,
    packing,
    passages,
    sharding,
    topk,
    toxicity,
)
from tidemart.llm.common import shared_folder, word_count

SCHEMA = "doc_id long, text string, lang string, source string, rank long, size string"


def words(seed, n, letters="abcdefgh"):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices(letters, k=draw.randint(2, 6))) for _ in range(n))


def fixture_rows():
    base, long = words(1, 120), words(2, 3000)
    near = base.split()
    near[7] = "changed"
    rows = [(1, base, "en", "a"), (2, " ".join(near), "en", "a"), (3, base.replace(" ", "\n\t"), "en", "b"),
            (4, None, "de", None), (5, "", None, "b"), (6, long, "en", "c"), (7, long, "en", "c"),
            (7, long, "en", "c"), (8, "one", "en", "a"), (None, "null id", "en", "a"), (9, base.upper(), "en", "b")]
    rows += [(100 + i, words(i, 5 + 7 * i), "en", "abc"[i % 3]) for i in range(30)]
    return [(*row, i % 3, "clash") for i, row in enumerate(rows)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(fixture_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact(spark, docs):
    got = {r.doc_id: r for r in exact_dedup.exact_groups(docs, digests=True).collect()}
    assert (got[1].keep_id, got[1].group_size, got[3].keep_id, got[3].kept) == (1, 2, 1, False)
    assert (got[5].keep_id, got[5].group_size, got[7].keep_id, got[7].group_size) == (4, 2, 6, 3)
    assert got[2].keep_id == 2 and got[None].group_size == 1 and all(len(r.text_sha256) == 64 for r in got.values())
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 4
    assert exact_dedup.exact_groups(empty(spark)).count() == 0


def test_mixing(spark, docs):
    rows = mixing.mix_copies(docs, word_count(F.col("text"))).collect()
    assert len(rows) == docs.count()
    by = defaultdict(list)
    for r in rows:
        by[r.source_size, r.target].append(r)
        assert r.taken == r.copies * r.size <= 3 * r.size
    longest = max(r.size for r in rows)
    for (_, target), own in by.items():
        assert abs(sum(r.taken for r in own) - target) <= longest
    assert sum(t for _, t in by) == pytest.approx(sum(r.size for r in rows))
    taken = mixing.mix(docs, word_count(F.col("text")))
    assert taken.columns == docs.columns
    assert mixing.mix_copies(empty(spark), word_count(F.col("text"))).count() == 0


def test_sharding(spark, docs):
    rows = sharding.shard_documents(docs, 4).collect()
    assert len(rows) == docs.count()
    shards = defaultdict(list)
    for r in rows:
        shards[r.shard].append(r.slot)
    assert all(sorted(slots) == list(range(len(slots))) for slots in shards.values())
    assert sharding.shard_documents(empty(spark)).count() == 0


def test_sharding_cuts_a_large_group(spark):
    rows = spark.createDataFrame([(i, "same text") for i in range(900)] + [(1000 + i, words(i, 9)) for i in range(300)],
                                 "doc_id long, text string")
    sizes = sharding.shard_documents(rows, 8).groupBy("shard").agg(F.sum("size").alias("s")).collect()
    assert len(sizes) == 8 and max(r.s for r in sizes) < 1.1 * min(r.s for r in sizes)


def test_packing(spark, docs):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack(docs, path).collect()
    tokenizer = Tokenizer.from_file(path)
    want = defaultdict(list)
    for key, text, *_ in fixture_rows():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        want[key].append(np.array(ids, "<u4").tobytes())
    total = defaultdict(int)
    for r in rows:
        total[r.doc_id] += r.length
        assert r.ids_crc32 in {zlib.crc32(ids[4 * r.start:4 * (r.start + r.length)]) for ids in want[r.doc_id]}
    assert total == {key: sum(len(ids) for ids in texts) // 4 for key, texts in want.items()}
    ends = defaultdict(int)
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends[r.sequence_id]
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= packing.WINDOW
    assert packing.pack(empty(spark), path).count() == 0


def test_word_ids_equal_the_tokenizers():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    ids, draw = packing.WordIds(public_tokenizers.path("word_bpe_49k.json")), random.Random(4)
    signs = "abz ÀéßÿÞ×0 59'’.,!<|>#\n\t\x0b\x85́ΣσςİıªºK漢字'sre"
    texts = ["".join(draw.choices(signs, k=draw.randint(1, 40))) for _ in range(3000)] + ["a<|endoftext|> <|ENDOFTEXT|>"]
    for text in texts:
        want = [*ids.tokenizer.encode(text, add_special_tokens=False).ids, 1]
        assert ids.encode(text) == np.array(want, "<u4").tobytes()


@pytest.mark.parametrize("lengths", [[1100] * 500, [3] * 900, [2048] * 5 + [700] * 60, [1]])
def test_plan_leaves_little_empty(lengths):
    histogram = defaultdict(int)
    for n in lengths:
        histogram[-(-n // packing.STEP)] += 1
    plan, filled, rank = packing.Plan(dict(histogram)), defaultdict(int), defaultdict(int)
    for n in lengths:
        steps = -(-n // packing.STEP)
        at, rank[steps] = rank[steps], rank[steps] + 1
        while (found := plan.find(steps, at))[0] == "split":
            filled[plan.find_block(*found[1:3])[0]] += 1 << found[1]
            n, at = n - (1 << found[1]), found[3]
            steps = -(-n // packing.STEP)
        filled[found[1]] += n
    empty_tokens = sum(0 if n & (n - 1) == 0 else packing.WINDOW - n for n in filled.values())
    assert max(filled.values()) <= packing.WINDOW
    assert empty_tokens <= packing.WINDOW + 0.1 * sum(lengths) + 8 * len(lengths)


def shingles(text, n):
    parts = (text or "").encode().lower().split()
    return {tuple(parts[i:i + n]) for i in range(max(1, len(parts) - n + 1))} if parts else set()


@pytest.mark.parametrize("n", [2, 5])
def test_near(spark, docs, n):
    got = {r.doc_id: r for r in near_dedup.near_groups(docs, n).collect()}
    sets = {row[0]: shingles(row[1], n) for row in fixture_rows() if row[0] is not None}
    group = {key: key for key in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
    assert {key: r.component_id for key, r in got.items() if key is not None} == group
    assert all(got[key].n_shingles == len(s) for key, s in sets.items()) and got[None].kept
    assert near_dedup.near_groups(empty(spark), n).count() == 0


def test_near_crowded_bucket(spark):
    base = words(3, 150).split()
    rows = []
    for i in range(150):
        draw, text = random.Random(i), list(base)
        for at in draw.sample(range(len(text)), 3 + i % 18):
            text[at] = f"x{i}y{at}"
        rows.append((i, " ".join(text)))
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(
        spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()}
    sets = {i: shingles(text, 2) for i, text in rows}
    group = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if group[a] != group[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    assert got == group


def test_top_k(spark):
    draw = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in draw.normal(size=8)]) for i in range(250)]
    vectors += [(300, None), (301, [float("nan")] * 8), (302, [None] * 8), (303, vectors[3][1]), (304, vectors[3][1])]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    rows = topk.quantised(frame)
    got = [tuple(r) for r in topk.top_k(rows, rows.filter("id % 100 = 0")).collect()]
    exact = {r.id: np.array(r.vector) for r in rows.collect()}
    want = [(q, k + 1, v, -s) for q in exact if q % 100 == 0
            for k, (s, v) in enumerate(sorted((-int(exact[q] @ x), v) for v, x in exact.items() if v != q)[:10])]
    assert sorted(got) == sorted(want)
    assert topk.top_k(rows.limit(0), rows.limit(0)).count() == 0


def test_toxicity(spark):
    rows = [(i, words(i, 60) + (" scumbag you moron " if i % 4 == 0 else " ") + words(i + 9, 30), i % 3) for i in range(600)]
    rows += [(1000, None, 0), (1001, "", 0), (None, "x", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score long")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(600)] + [(5000, 1)], "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.train(docs, labels)).withColumn("held_out", toxicity.held_out()).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.95 * len(held) > 0
    none = toxicity.train(docs, labels.limit(0))
    assert toxicity.score(docs, none).filter("predicted = 1").count() == 0
    assert toxicity.score(docs.limit(0), none).count() == 0


def test_toxicity_of_a_rare_language():
    # Words of the second language are of the same syllables, in ordinary rows as in toxic ones.
    draw, parts = random.Random(4), "achlich ungkeit heitsch verber teteing ausein chenpf ieberau".split()
    bad = ["".join(draw.sample(parts, 3)) for _ in range(8)]
    texts, labels = [], []
    for i in range(1500):
        other, toxic = i % 4 == 0, i % 10 < 2
        text = [w for w in ("".join(draw.choices(parts, k=3)) for _ in range(60)) if w not in bad] if other else words(i, 60).split()
        for _ in range(3 if toxic else 0):
            text.insert(draw.randrange(len(text)), draw.choice(bad) if other else draw.choice(("scumbag", "moron")))
        texts.append(" ".join(text))
        labels.append(int(toxic))
    model = toxicity.fit(texts[:1000], labels[:1000], 0.2)
    gains = toxicity.Gains(model.toxic, model.ordinary)
    caught = model.score(np.array([gains.features(t) for t in texts[1000:]])) >= 0.5
    for other in (False, True):
        rows = [(c, y) for i, c, y in zip(range(1000, 1500), caught, labels[1000:], strict=True) if (i % 4 == 0) == other]
        assert sum(c and y for c, y in rows) >= 0.9 * sum(y for _, y in rows) > 0
        assert sum(c and not y for c, y in rows) <= 0.05 * len(rows)


def test_toxicity_windows():
    # Long runs, as of scripts without spaces, give overlapping pieces that reach the end; no byte of a word is left out.
    run = "語" * 5 + "悪い奴" + "文" * 40
    pieces = toxicity.windows(run.encode())
    assert "悪い奴".encode() in pieces and {len(p) for p in pieces[:-1]} == {toxicity.PIECE}
    assert pieces[-1].endswith("文".encode()) and sum(len(p) > 0 for p in pieces) == len(pieces)
    odd = b"a" * 47
    got = toxicity.windows(odd)
    assert (len(got) - 1) * toxicity.STEP + len(got[-1]) == len(odd)
    # Telling words are in the toxic dictionary whole, and only they gain; a very long text keeps a telling word at its end.
    toxic = [f"{words(i, 20)} Moron! {words(i + 5000, 20)}".lower().encode() for i in range(40)]
    plain = [words(i + 9000, 300).encode() for i in range(200)]
    gains = toxicity.Gains(*toxicity.dictionaries(toxic, plain))
    assert toxicity.telling_words(toxic, plain) == [b"moron"] and gains.gain(b"moron") >= 2
    assert max(gains.gain(w) for text in plain[:20] for w in toxicity.windows(text)) < 2
    long = words(1, 200_000)
    assert gains.features(long + " moron")[0] > gains.features(long)[0]
    assert gains.features(None) == gains.features("") == gains.features(" \n !")
    texts = ["you moron " * (i % 2) + f"text {i}" for i in range(400)]
    model = toxicity.fit(texts, [i % 2 for i in range(400)], 0.5)
    gains = toxicity.Gains(model.toxic, model.ordinary)
    scores = model.score(np.array([gains.features(t) for t in (long, "", "you moron")], float))
    assert scores[0] == scores[1] < 0.5 <= scores[2]  # length alone says nothing


def test_html():
    draw, pages = random.Random(8), []
    for i in range(120):
        inner = "".join(f"<p>{words(90 * i + k, draw.randint(1, 120))}.</p>" for k in range(draw.randint(1, 12)))
        links = "".join(f"<li><a href=/x>{words(i + k, 1)}</a></li>" for k in range(draw.randint(2, 7)))
        pages.append(f"<html><body><nav><ul>{links}</ul></nav><div class=ad>{words(i, 12)}</div><article>"
                     f"<h1>{words(i, 9)}</h1>{inner}</article><footer>{words(i, 9)}</footer></body></html>")
    model = html_text.train(pages)
    draw = random.Random(3)
    body = "".join(f"<p>{words(500 + i, draw.randint(20, 90))} &amp;\n &lt;b&gt;<br>end.</p>" for i in range(6))
    page = html_text.Page(f"<body><div class=menu><ul><li><a href=/>home</a></ul></div><div class=content>{body}"
                          f"</div><div class=ad>{words(9, 8)}</div><form><input><p>mail</p></form><!-- x -->"
                          "<script>var a='</p>'</script><footer>&copy; us</footer>")
    text = page.text(model.probability(np.array(page.features(), float)))
    draw = random.Random(3)
    assert text.split("\n\n") == [f"{words(500 + i, draw.randint(20, 90))} & <b> end." for i in range(6)]


def test_html_frames(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, None, ""), (3, "v", "<p>text")], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(pages, None, ["page_id"]).collect()}
    assert got == {"1": "", "2": "", "3": "text"}
    assert html_text.extract(pages.limit(0), None, ["page_id"]).count() == 0


def test_html_own_markers(spark):
    inner = "".join(f"<p>{words(i, 40)}.</p>" for i in range(4))
    frames = ['<div data-y="120px">text</div>', '<div data-y="">text</div>', '<div x-data-y="top">text</div>',
              f"<div data-y=0 {html_text.MARK}=x>text</div>"]
    pages = spark.createDataFrame(list(enumerate(frames)), "page_id long, html string")
    assert {r.text for r in html_text.extract(pages, None, ["page_id"]).collect()} == {"text"}
    plain = [f"<body><nav>{words(90 + k, 5)}</nav><article>{inner}</article></body>" for k in range(30)]
    own = [p.replace("<p>", f'<p data-y="0" {html_text.MARK}=0>').replace("<nav>", f"<nav data-y=1 {html_text.MARK}=1>") for p in plain]
    labels = [[html_text.Page(source, labelled=True).labels for source in html_text.layouts(pages)] for pages in (plain, own)]
    assert labels[0] == labels[1] and any(1 in page for page in labels[0])


@pytest.mark.parametrize("inside", [
    "<svg class=x/>", "<math />", "<svg><title/><path/></svg>", "<svg><svg>no</svg>no</svg>", "<button>no", "<select><option>no",
    "<object data=x>no", "<noscript>no", "<noscript><iframe src=x></noscript>", "<button><div>no</div></button>",
    "<template><p>no<p>no</template>", "<noscript><style>no</style><p>no</p></noscript>", "<button>no<svg/></button>"])
def test_html_skipped(inside):
    # Another element of each kind comes later: text up to its end must not be lost.
    later = "".join(f"<{tag}>no</{tag}>" for tag in ("svg", "math", "button", "select", "object", "noscript", "iframe"))
    page = html_text.Page(f"<div><p>one{inside}</p></div><div><p>two</p>{inside}<p>three</p></div><p>four</p>{later}<p>five")
    assert page.text(np.ones(len(page.rows))).split("\n\n") == ["one", "two", "three", "four", "five"]


def test_language(spark):
    docs = spark.createDataFrame([(i, words(i, 80, "abcdef" if i % 2 else "uvwxyz"), "aa" if i % 2 else "uu") for i in range(40)],
                                 "doc_id long, text string, lang string")
    pages = spark.createDataFrame(
        [(i, f"http://h{i % 2}.test/x", f"<html lang={'aa' if i % 2 else 'uu'}><p>{words(i + 99, 40, 'abcdef' if i % 2 else 'uvwxyz')}")
         for i in range(30)] + [(50, "http://h1.test/y", ""), (51, None, None)], "page_id long, url string, html string")
    got = {r.page_id: r for r in language.identify(pages, docs).collect()}
    assert all(got[i].lang == ("aa" if i % 2 else "uu") for i in range(30))
    assert got[50].lang == "aa" and got[51].host == "" and 0 < got[51].probability <= 1
    assert language.identify(pages.limit(0), docs).count() == 0
    assert language.identify(pages, docs.limit(0)).filter("lang is null").count() == 32


def test_html_sample_and_unclosed_quotes(spark):
    rows = [(i, f"<article>{i}</article>") for i in range(300)] + [(7, "<article>7</article>")] * 400 + [(None, None), (1, "<p>no")]
    got = html_text.sample(spark.createDataFrame(rows, "page_id long, html string").repartition(7))
    assert len(got) == len(set(got)) == html_text.TRAIN_PAGES and not html_text.sample(spark.createDataFrame([], "page_id long, html string"))
    page = html_text.Page("<p>one <a href=\"x\"y\">two</a> three</p><p class='a>four</p>")
    assert "".join("".join(parts) for _, parts in page.runs) == "one two threefour"


def test_top_k_of_huge_components(spark):
    # Scores beyond a long count as the nearest long; of equal ones the smaller ids come first.
    rows = [(0, [1e30, 1.0]), (1, [1e30, 0.0]), (2, [5e29, 0.0]), (3, [-1e30, 1.0]), (4, [0.0, 2.0]), (5, [1e-3, None])]
    asked = topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"id": F.lit("clash"), "vector": F.lit(1)}))
    got = {r.vec_id: (r["rank"], r.score) for r in topk.top_k(asked, asked.filter("id = 0")).collect()}
    assert got == {1: (1, 2**63 - 1), 2: (2, 2**63 - 1), 4: (3, 1024 * 2048), 3: (4, -2**63)}
    empty = spark.createDataFrame([(100, None), (None, [1.0])], "vec_id long, embedding array<double>")
    assert topk.top_k(topk.quantised(empty), topk.quantised(empty)).count() == 0


def test_languages_of_odd_names(spark):
    docs = spark.createDataFrame([(i, words(i, 80, ("abcd", "efgh")[i % 2]), ("a\u00a0'b\\", "z")[i % 2]) for i in range(40)],
                                 "doc_id long, text string, lang string")
    pages = spark.createDataFrame([(i, None, f"<p>{words(i, 60, ('abcd', 'efgh')[i % 2])}") for i in range(6)] * 2,
                                  "page_id long, url string, html string")
    got = language.identify(pages, docs).collect()
    assert len(got) == 12 and all(r.lang == ("a\u00a0'b\\", "z")[r.page_id % 2] for r in got)


def test_passages(spark, docs):
    shared = words(77, 70)
    rows = [(i, words(200 + i, 40) + " " + shared + " " + words(300 + i, 30)) for i in range(6)]
    rows += [(10, "and " * 90), (11, "and " * 80), (12, words(5, 200)), (None, shared), (13, None), (14, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = passages.repeated_passages(frame).collect()
    assert {(r.doc_id, r.ref_id) for r in got} == {(i, 0) for i in range(1, 6)} | {(11, 10)}
    assert all(r.first_word <= 40 and r.end_word >= 110 for r in got if r.doc_id < 6)
    assert passages.repeated_passages(frame.limit(0)).count() == 0
    assert {r.doc_id for r in passages.repeated_passages(docs).collect()} >= {2, 3, 7, 9}


def test_passages_of_known_pieces(spark):
    # Earlier documents hold every short seed of a passage; only long seeds lead to the document that has all of it.
    rows = []
    for k in range(40):
        whole = words(7000 + k, 52).split()
        rows += [(1000 * k + i, " ".join([words(k, 30 + i), *whole[i:i + 25], words(k + 50, 30 + i)])) for i in range(0, 28, 9)]
        rows += [(1000 * k + 100 + i, " ".join([words(9000 + 2 * k + i, 60), *whole, words(8000 + 2 * k + i, 60)])) for i in (0, 1)]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.ref_id) for r in got} >= {(1000 * k + 101, 1000 * k + 100) for k in range(40)}


def test_passages_whose_long_seeds_lie_in_earlier_documents(spark):
    # Every seed, long ones too, first occurs in a document that has 45 of the 52 words, which is no passage.
    rows = []
    for k in range(20):
        whole = words(6000 + k, 52).split()
        rows += [(1000 * k + i, " ".join([words(300 + 2 * k + i, 40), *whole[7 * i:7 * i + 45], words(400 + 2 * k + i, 40)])) for i in (0, 1)]
        rows += [(1000 * k + 100 + i, " ".join([words(9100 + 3 * k + i, 60), *whole, words(8100 + 3 * k + i, 60)])) for i in range(3)]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.ref_id) for r in got} >= {(1000 * k + 100 + i, 1000 * k + 100) for k in range(20) for i in (1, 2)}


def test_passages_write_no_seeds(spark):
    # Only what documents share is written to the shared folder, not every seed of every text.
    def written():
        return sum(f.stat().st_size for f in pathlib.Path(shared_folder(spark).removeprefix("file:")).rglob("*.parquet"))

    shared, before = words(4, 60), written()
    rows = [(i, words(40_000 + i, 3000) + (f" {shared}" if i < 2 else "")) for i in range(60)]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.doc_id, r.ref_id, r.first_word, r.end_word) for r in got] == [(1, 0, 3000, 3060)]
    assert written() - before < 300_000  # of 120,000 short seeds


def test_passages_of_a_very_frequent_line(spark):
    shared = words(78, 60)
    rows = [(7 + (i * 37) % 150, f"{words(600 + i, 30 + i % 9)} last{i} {shared}") for i in range(150)] * 2
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert sorted(r.doc_id for r in got if r.ref_id == 7) == list(range(8, 157)) and len(set(got)) == len(got)
    assert all(r.end_word - r.first_word == r.words_equal == 60 and r.ref_id < r.doc_id for r in got)


def test_word_hashes_of_many_texts():
    texts = ["", " \t\n", "One\x0btwo  one\r\n", "a\x1cb \x85 \xa0\u00c9 Z", " " + words(1, 40) + " ", "x"]
    hashes, sizes = passages.word_hashes(pa.array(texts))
    known = passages.Words()
    assert sizes.tolist() == [0, 0, 3, 4, 40, 1]
    assert hashes.tolist() == [h for text in texts for h in known(text).tolist()]
    text, _, at, wide = passages.seeds(hashes, sizes)
    assert set(text.tolist()) == {4} and at.max() <= 34 and wide.any()


def test_chains_of_equal_scores():
    # Up to 767 and up to 802 a chain gains the same: the longer one is taken, in whatever order the matches come.
    pos = [754, 762, 764, 765, 767, 801, 802]
    assert passages.chains(pos, pos) == [list(range(7))]
    assert passages.chains(pos[::-1], pos[::-1]) == [list(range(6, -1, -1))]


def test_straight_chains():
    # Matches equally far apart are chained without the tree; another pair far off leads through it.
    draw = random.Random(3)
    for _ in range(300):
        pos = [draw.randrange(draw.choice((30, 200, 800))) for _ in range(draw.randint(1, 20))]
        ref = [p + 5 for p in pos]
        whole = passages.chains([*pos, 90_000], [*ref, 10_000])
        assert sorted(passages.chains(pos, ref)) == sorted(c for c in whole if c != [len(pos)])


def test_passage_beyond_differences():
    ref = list(range(1000, 1200))
    doc = [*range(50), *(w if i % 9 else -i - 1 for i, w in enumerate(ref)), *range(50, 99)]
    begin, end, ref_begin, ref_end, _ = passages.align([(50 + 1, 1)], doc, ref)
    assert (begin, end, ref_begin, ref_end) == (51, 248, 1, 198)  # one word after a difference gains nothing


def test_fuzzy_passages(spark):
    draw, rows = random.Random(12), []
    for k in range(60):
        ref = words(5000 + k, 60).split()
        doc = list(ref)
        for i in draw.sample(range(1, 59), 11):
            doc[i] = f"changed{i}"
        rows += [(2 * k + i, " ".join([words(8000 + 2 * k + i, 70), *body, words(9000 + 2 * k + i, 70)])) for i, body in enumerate((ref, doc))]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len({(r.doc_id, r.ref_id) for r in got} & {(2 * k + 1, 2 * k) for k in range(60)}) >= 48


def test_whole_passages_beyond_earlier_documents(spark):
    # The last 700 of 1,000 common words first occur in a third document: the passage is no shorter for that.
    whole = words(31, 1000)
    rows = [(1, f"{words(32, 40)} {whole.split(' ', 300)[300]} {words(33, 40)}"), (2, f"{words(34, 60)} {whole} {words(35, 30)}"),
            (3, f"{words(36, 50)} {whole} {words(37, 20)}")]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.first_word, r.end_word, r.ref_id, r.ref_first_word, r.ref_end_word) for r in got} == {
        (2, 360, 1060, 1, 40, 740), (3, 350, 1050, 1, 40, 740), (3, 50, 1050, 2, 60, 1060)}


def test_passages_of_repeated_lines(spark):
    # Every run of 50 words that an earlier document has lies in a passage, also where lines come several times.
    draw, rows = random.Random(8), []
    lines = [words(500 + k, draw.choice((1, 5, 9, 20, 34))) for k in range(8)]
    for i in range(30):
        body = [" ".join([draw.choice(lines)] * draw.randint(1, 30)) for _ in range(3)]
        rows.append((i, " ".join([words(3000 + i, 15), *body, words(4000 + i, 15)])))
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    earlier, missed = set(), []
    for i, text in rows:
        split = text.split()
        runs = [tuple(split[k:k + 50]) for k in range(len(split) - 49)]
        spans = [(r.first_word, r.end_word) for r in got if r.doc_id == i]
        missed += [(i, k) for k, run in enumerate(runs) if run in earlier and not any(a <= k and k + 50 <= b for a, b in spans)]
        earlier.update(runs)
    assert not missed


def test_fuzzy_passages_whose_seeds_lie_in_earlier_documents(spark):
    # Earlier documents hold every stretch of 25 words; no 50 words in a row are equal.
    draw, rows = random.Random(5), []
    for k in range(30):
        ref = words(2000 + k, 80).split()
        doc = list(ref)
        for i in range(12, 80, 14):
            doc[i + draw.randrange(-3, 4)] = f"changed{i}"
        rows += [(1000 * k + i, " ".join([words(50 * k + i, 30), *(ref, doc)[i % 2][i:i + 25], words(50 * k + i + 9000, 30)]))
                 for i in [*range(0, 56, 8), *range(1, 56, 8)]]
        rows += [(1000 * k + 100 + i, " ".join([words(300_000 + 2 * k + i, 60), *body, words(400_000 + 2 * k + i, 60)]))
                 for i, body in enumerate((ref, doc))]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.ref_id) for r in got} >= {(1000 * k + 101, 1000 * k + 100) for k in range(30)}


def test_passages_on_either_side_of_a_difference(spark):
    # Together they are too unlike, each of them is a passage.
    rows = []
    for k in range(10):
        texts = []
        for i in (0, 1):
            body = [words(100 + 2 * k + j, 60).split() for j in (0, 1)]
            for part in body[:2 * i]:
                part[20] = part[40] = "changed"
            texts.append(" ".join([words(5000 + 2 * k + i, 30), *body[0], words(6000 + 2 * k + i, 38), *body[1], words(7000 + 2 * k + i, 30)]))
        rows += [(2 * k + i, text) for i, text in enumerate(texts)]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.first_word, r.end_word) for r in got} == {(2 * k + 1, *span) for k in range(10) for span in ((30, 90), (128, 188))}

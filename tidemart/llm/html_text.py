"""Main text of web pages: boosted trees over DOM nodes, decoded so that a node and its subtree agree."""

from __future__ import annotations

import html
import math
import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.boosting import Boosted
from tidemart.llm.common import load, small_batches

#: Pages the trees are fitted on at most, those with the smallest hash of the id; each gives ``VARIANTS`` layouts.
TRAIN_PAGES, VARIANTS = 200, 4
#: The attribute that carries labels in layouts, a private-use character that given pages have had removed.
MARK = "\ue000"
#: What it costs, as a log probability, to decide about the children of a node one by one.
OPEN = -1.0

# Element names of the HTML standard, by role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style iframe title textarea".split())
FOREIGN = {"svg", "math"}
SKIPPED = RAW | FOREIGN | set("template noscript select object button".split())
BLOCKS = set("""html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th
  blockquote pre figure figcaption nav aside header footer form fieldset address details summary hr center""".split())
GOOD, BAD = {"article", "main"}, {"nav", "aside", "header", "footer", "form", "fieldset", "address"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
LISTS = {"ul", "ol", "li", "dl", "dt", "dd"}
#: An element on the left is closed by the start of any on the right.
CLOSED_BY = {"p": BLOCKS - {"html", "body"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"},
             "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
# Words that class, id and role of an element tell its purpose by.
POSITIVE = set("article content post entry story main body text prose maincontent".split())
NEGATIVE = set("""nav navigation menu menubar navbar breadcrumb breadcrumbs header masthead footer foot sidebar side aside
  widget ad ads advert advertisement adverts sponsor sponsored promo promotion banner cookie cookies consent gdpr notice
  alert popup modal newsletter subscribe signup login form search share sharing social related recommended comment
  comments reply replies respond disqus discussion copyright legal pagination pager toolbar tags meta byline
  complementary contentinfo""".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+(?:["'][^>]*)?)>?""", re.DOTALL)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_MARKED = re.compile(rf"\s{MARK}=([0-2])")
_WORD = re.compile(r"[a-z]+")
_BLANKS = re.compile(r"[ \t\n\r\f\v]+")
_SIGNS = re.compile(r"[.,;:!?]")


def _raw_end(source: str, at: int, tags: str) -> int:
    """Where the next end tag of these names begins, or -1."""
    end = re.compile(rf"</(?:{tags})(?=[\s>/])", re.IGNORECASE).search(source, at)
    return end.start() if end else -1


def _skipped_ends(source: str, at: int) -> dict[int, int]:
    """Where each skipped element from ``at`` on ends, by the end of its start tag.

    That is its end tag in the same block or, if it isn't closed there, the next block's tag: what follows is text of
    the page. Script, style, iframe, title and textarea last to their end tag or the end of the page, as in browsers.
    """
    ends: dict[int, int] = {}
    open_tags: list[tuple[str, int]] = []  # blocks and skipped elements
    unsettled: list[int] = []  # skipped elements after which no block's tag has come
    while (found := _TAG.search(source, at)) is not None:
        begin, at = found.start(), found.end()
        tag = (found[2] or "").lower()
        if tag in BLOCKS:
            for start in unsettled:
                ends[start] = begin
            unsettled = []
        if found[1]:
            if tag in BLOCKS or tag in SKIPPED:
                for i in range(len(open_tags) - 1, -1, -1):
                    if open_tags[i][0] == tag:
                        if tag in SKIPPED:
                            ends[open_tags[i][1]] = begin
                            unsettled = [start for start in unsettled if start < open_tags[i][1]]
                        del open_tags[i:]
                        break
        elif tag in RAW:
            inside = next((name for name, _ in reversed(open_tags) if name in SKIPPED), None)
            if inside in FOREIGN and found[3].endswith("/"):
                continue
            end = _raw_end(source, at, f"{tag}|noscript" if inside == "noscript" else tag)
            ends[at] = end if end >= 0 else at if inside else len(source)
            at = ends[at]
        elif tag in FOREIGN and found[3].endswith("/"):
            ends[at] = at
        elif tag in SKIPPED:
            open_tags.append((tag, at))
            unsettled.append(at)
        elif tag in BLOCKS:
            open_tags.append((tag, at))
    return ends


class Page:
    """Block elements of a page in order, as rows of numbers, and the runs of text in them; labels only of layouts."""

    def __init__(self, source: str | None, labelled: bool = False):
        self.labelled = labelled
        self.parent, self.rows, self.runs, self.labels = [], [], [], []
        self.stack: list[tuple[str, int]] = []  # open elements and the block each belongs to
        self.links, self.fresh, self.length = 0, True, 0
        self._node("#page", "")
        self._read(source or "")
        self._add_up()

    def _node(self, tag: str, attributes: str) -> int:
        up = self.stack[-1][1] if self.stack else -1
        words: list[str] = []
        label = None
        if attributes and "=" in attributes:
            for _, *value in _NAMED.findall(attributes):
                words += _WORD.findall("".join(value).lower())
            if self.labelled and (marked := _MARKED.search(attributes)):
                label = int(marked[1])
        good, bad = sum(w in POSITIVE for w in words), sum(w in NEGATIVE for w in words)
        above = self.rows[up] if up >= 0 else None
        # tag, own words, words and elements above, depth, siblings before; then, added up: text, linked text,
        # elements, links, signs, controls, place in the page, siblings
        self.rows.append([tag, good, bad,
                          above[3] + (above[1] > 0) if above else 0, above[4] + (above[2] > 0) if above else 0,
                          above[5] + (above[0] in GOOD) if above else 0, above[6] + (above[0] in BAD) if above else 0,
                          above[7] + 1 if above else 0, above[15] if above else 0,
                          0, 0, 1, 0, 0, 0, 0, self.length])
        if above:
            above[15] += 1
        self.parent.append(up)
        self.labels.append(label if label is not None else self.labels[up] if up >= 0 else None)
        if not self.stack:
            self.stack.append((tag, 0))
        return len(self.rows) - 1

    def _read(self, source: str) -> None:
        at, ends = 0, None
        while (found := _TAG.search(source, at)) is not None:
            if found.start() > at:
                self._text(source[at:found.start()])
            at = found.end()
            if not found[2]:
                continue
            tag = found[2].lower()
            if found[1]:
                self._close(tag)
            elif tag in SKIPPED:
                if ends is None and tag in RAW:
                    end = _raw_end(source, at, tag)
                    at = end if end >= 0 else len(source)
                else:
                    ends = _skipped_ends(source, found.start()) if ends is None else ends
                    at = ends.get(at, len(source))
                if tag == "button":
                    self.rows[self.stack[-1][1]][14] += 1
            else:
                self._open(tag, found[3])
        if at < len(source):
            self._text(source[at:])

    def _open(self, tag: str, attributes: str) -> None:
        if tag in BLOCKS:
            self.fresh = True
            for i in range(len(self.stack) - 1, 0, -1):
                if tag in CLOSED_BY.get(self.stack[i][0], ()):
                    self._cut(i)
                    break
                if self.stack[i][0] in BLOCKS and self.stack[i][0] != "p":
                    break
        if tag in VOID:
            row = self.rows[self.stack[-1][1]]
            row[11] += 1
            row[14] += tag == "input"
            if tag in ("br", "wbr") and not self.fresh:
                self._text(" ")
            return
        if tag in BLOCKS:
            self.stack.append((tag, self._node(tag, attributes)))
        else:
            block = self.stack[-1][1]
            self.rows[block][11] += 1
            if tag == "a":
                self.links += 1
                self.rows[block][12] += 1
            self.stack.append((tag, block))

    def _close(self, tag: str) -> None:
        if tag in BLOCKS:
            self.fresh = True
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == tag:
                self._cut(i)
                return
            if tag not in BLOCKS and self.stack[i][0] in BLOCKS:
                return

    def _cut(self, to: int) -> None:
        self.links -= sum(tag == "a" for tag, _ in self.stack[to:])
        del self.stack[to:]

    def _text(self, raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        block = self.stack[-1][1]
        if self.fresh or not self.runs or self.runs[-1][0] != block:
            if not text.strip(" \t\n\r\f\v"):
                return
            self.runs.append((block, []))
            self.fresh = False
        self.runs[-1][1].append(text)
        row, n = self.rows[block], len(text)
        row[9] += n
        row[10] += n if self.links else 0
        row[13] += len(_SIGNS.findall(text))
        self.length += n

    def _add_up(self) -> None:
        self.own = [row[9] > 0 for row in self.rows]
        for i in range(len(self.rows) - 1, 0, -1):
            row, up = self.rows[i], self.rows[self.parent[i]]
            for k in range(9, 15):
                up[k] += row[k]

    def features(self) -> list[list[float]]:
        out, whole = [], max(1, self.length)
        for row, up in zip(self.rows, self.parent, strict=True):
            tag, good, bad, good_above, bad_above, in_good, in_bad, depth, before, text, linked, tags, links, signs, \
                controls, _, place = row
            siblings, around = (self.rows[up][15], max(1, self.rows[up][9])) if up >= 0 else (1, whole)
            out.append([
                tag in GOOD, tag in BAD, tag == "p", tag in HEADINGS, tag in LISTS, tag in ("div", "section"),
                good, bad, good_above, bad_above, in_good, in_bad, depth, before, siblings, before / siblings if siblings else 0,
                text / around, math.log1p(text), linked / (text + 1), text / tags, links / (text + 1), signs / (text + 1),
                controls, place / whole, text / whole])
        return out

    def text(self, p: np.ndarray) -> str:
        """Blocks of the nodes that are kept, given how likely each node is main text.

        A node keeps its whole subtree, drops it, or is opened, which leaves its text to itself and its
        children to themselves; the likeliest such choice for the whole page is taken.
        """
        yes, no = np.log(np.clip(p, 1e-6, 1)).tolist(), np.log(np.clip(1 - p, 1e-6, 1)).tolist()
        best = [OPEN + (max(yes[i], no[i]) if own else 0.0) for i, own in enumerate(self.own)]
        keep, drop, state = list(yes), list(no), [""] * len(yes)
        for i in range(len(yes) - 1, -1, -1):
            choice, best[i] = max((("keep", keep[i]), ("drop", drop[i]), ("open", best[i])), key=lambda c: c[1])
            state[i] = choice
            if (up := self.parent[i]) >= 0:
                keep[up] += keep[i]
                drop[up] += drop[i]
                best[up] += best[i]
        for i in range(1, len(yes)):
            if state[self.parent[i]] != "open":
                state[i] = state[self.parent[i]]
        kept = [s == "keep" or s == "open" and y >= n for s, y, n in zip(state, yes, no, strict=True)]
        blocks = (_BLANKS.sub(" ", "".join(parts)).strip(" ") for block, parts in self.runs if kept[block])
        return "\n\n".join(b for b in blocks if b)


def layouts(pages: list[str], seed: int = 5) -> Iterator[str]:
    """Pages with known main text: the articles of given pages, in their own and in made-up surroundings.

    Elements carry ``MARK``: 1 in main text, 0 elsewhere. Surroundings take their words from the pages.
    """
    draw = random.Random(seed)
    plain = (page.replace(MARK, "") for page in pages)
    found = [m for page in plain if (m := re.search(r"<(article|main)\b[^>]*>(.*?)(?:</\1>|\Z)", page, re.DOTALL | re.IGNORECASE))]
    words = [w for m in found for w in re.sub(r"<[^>]*>|&\w+;?", " ", m[2]).split()][:200_000] or ["word"]
    say = lambda low, high: " ".join(draw.choices(words, k=draw.randint(low, high)))

    def part(role: str, inner: str, *names: str, tag: str = "") -> str:
        semantic = tag and draw.random() < 0.5
        name = "" if semantic and draw.random() < 0.5 else f' {draw.choice(("class", "id"))}="{draw.choice(names)}"'
        return f"<{tag if semantic else 'div'}{name} {MARK}={role}>{inner}</{tag if semantic else 'div'}>"

    def linked(n: int) -> str:
        items = "".join(f'<li><a href="/x">{say(1, 4)}</a></li>' for _ in range(n))
        return f"<ul>{items}</ul>" if draw.random() < 0.8 else re.sub("</?li>", " ", items)

    for m in found:
        body, own = m[2], m.string
        yield own[:m.start()] + f"<{m[1]} {MARK}=1>" + body + f"</{m[1]}>" + own[m.end():]
        for _ in range(VARIANTS - 1):
            advert = lambda: part("0", say(4, 25), "ad", "advert", "sponsored", "promo-box", "banner-ad")
            if draw.random() < 0.5:
                cut = [c.end() for c in re.finditer("</p>", body)] or [0]
                at = draw.choice(cut)
                body_now = body[:at] + draw.choice((advert, lambda: part(
                    "0", linked(3), "related", "share-tools", "newsletter", tag="aside")))() + body[at:]
            else:
                body_now = body
            talk = "".join(f'<div class="{draw.choice(("comment", "reply", "item"))}"><p>{say(5, 60)}</p></div>'
                           for _ in range(draw.randint(1, 5)))
            before = [part("0", f"<h2>{say(1, 3)}</h2><p>{say(3, 8)}</p>", "header", "masthead", "site-header", tag="header"),
                      part("0", linked(draw.randint(3, 9)), "menu", "navbar", "nav-links", tag="nav"),
                      part("0", f"<p>{say(8, 30)}</p>", "cookie-notice", "consent", "notice", "alert-bar"), advert()]
            after = [part("0", f"<h3>{say(1, 2)}</h3>{talk}", "comments", "discussion", "respond", tag="section"),
                     part("0", f"<p>{say(4, 15)}</p><label>{say(1, 2)}</label><input><button>{say(1, 2)}</button>",
                          "newsletter", "signup-form", "search", tag="form"),
                     part("0", f"<h3>{say(1, 3)}</h3>{linked(4)}<p>{say(5, 30)}</p>", "sidebar", "widget", "related", tag="aside"),
                     part("0", f"&copy; {say(2, 15)}", "footer", "copyright", "site-footer", tag="footer")]
            aside = before.pop(2) if draw.random() < 0.4 else ""
            main = part("1", body_now, "content", "post-body", "entry", "story", "main-text", "page", tag=draw.choice(("article", "main")))
            some = lambda parts: "".join(x for x in parts if draw.random() < 0.7)
            inside = main + (some(after[:2]) if draw.random() < 0.5 else "")
            if draw.random() < 0.5:
                inside = f'<div class="{draw.choice(("wrapper", "container", "row", "layout"))}">{inside}{some(after[2:3])}</div>'
            yield f"<html><head><title>{say(1, 5)}</title></head><body {MARK}=2>{some(before)}{inside}{some(after)}{aside}</body></html>"


def train(pages: list[str]) -> Boosted | None:
    """Trees over the nodes of all layouts; nodes that hold main and other text aren't learned. None without articles."""
    rows, labels = [], []
    for source in layouts(pages):
        page = Page(source, labelled=True)
        # Outside any label a node is no main text, unless a labelled part lies in it.
        holds = [label == 1 for label in page.labels]
        for i in range(len(holds) - 1, 0, -1):
            holds[page.parent[i]] = holds[page.parent[i]] or holds[i]
        for label, mixed, row, node in zip(page.labels, holds, page.features(), page.rows, strict=True):
            if node[9] and not (label in (None, 2) and mixed):
                rows.append(row)
                labels.append(label == 1)
    return Boosted(np.array(rows, float), np.array(labels, float)) if rows else None


def sample(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> list[str]:
    """The bounded sample the trees learn from."""
    rows = (pages.filter(F.lower(html_col).rlike("<(article|main)[ >]"))
            .select(F.xxhash64(id_col, F.length(html_col)).alias("h"), F.col(html_col).alias("html")))
    # Hashes first: only the pages drawn reach the driver, one of each hash.
    drawn = [r[0] for r in rows.select("h").distinct().orderBy("h").limit(TRAIN_PAGES).collect()]
    found = rows.filter(F.col("h").isin(drawn)).groupBy("h").agg(F.max("html").alias("html")).collect()
    return [r["html"] for r in sorted(found)]


def extract(pages: DataFrame, model: Boosted | None, keep: list[str], html_col: str = "html") -> DataFrame:
    """Columns ``keep`` of each row, cast to text, with text: the main text of its whole page.

    Null or empty html, and pages without text, give an empty text. Without a model, every node counts as
    likelier main text than not unless it or one above it bears a name or element of other uses. Each row
    stands alone, so repeated ids and rows are extracted alike; an empty table gives an empty result.
    """
    small_batches(pages.sparkSession, 200)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parsed = [Page(source) for source in batch["llm_html"]]
            features = [page.features() for page in parsed]
            rows = np.array([row for f in features for row in f], float)
            if not len(rows):
                p = np.zeros(0)
            elif model is None:
                p = np.where(rows[:, [1, 7, 9, 11]].sum(axis=1) > 0, 0.1, 0.9)
            else:
                p = model.probability(rows)
            ends = np.cumsum([len(f) for f in features])
            texts = [page.text(part) for page, part in zip(parsed, np.split(p, ends[:-1]), strict=True)] if len(ends) else []
            yield batch[[c for c in batch.columns if c != "llm_html"]].assign(text=texts)

    narrow = pages.select(*[F.col(c).cast("string") for c in keep], F.col(html_col).alias("llm_html"))
    return narrow.mapInPandas(run, ", ".join(f"`{c}` string" for c in keep) + ", text string")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = load(spark, sf_dir, "pages")
    found = extract(pages, train(sample(pages)), ["page_id", "url"])
    kind = pages.schema["page_id"].dataType
    return found.select(F.col("page_id").cast(kind), "url", "text", F.length("text").cast("long").alias("n_chars"))

"""Main text of web pages by gradient-boosted trees over DOM-node features.

Every block element with text is scored from its subtree (text, link and tag
density), its attribute tokens and its ancestors', its depth and its siblings.
Inline elements (links, emphasis) follow the block they stand in and items their
list, unless their own attributes speak of a part that is none of the text.  The scores are
decoded together: an element can be kept only below kept ones, and the best
such choice is found from the leaves up, so no kept element stands in a dropped
one and none is dropped for its own score alone.

The model is trained on the driver from seeded labelled pages (page_samples),
about a second of work that does not grow with the table, and is broadcast.
Each page is one row in, one row out; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boosting, page_samples
from .columns import runs_of
from .dom import INLINE, Page

# Attribute tokens by what they tell about an element.
TOKENS = {
    "ad": "ad ads adv advert adverts advertisement advertising adsbygoogle adslot sponsor sponsored promo promoted promotion commercial banner",
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager tabs topnav toc",
    "head": "header head masthead branding logo topbar top",
    "foot": "footer foot copyright colophon bottom legal",
    "side": "sidebar side widget widgets rail aside secondary column",
    "notice": "cookie cookies consent gdpr notice notices alert popup modal overlay announcement dialog privacy paywall",
    "comment": "comment comments commentlist reply replies response responses disqus discussion thread respond",
    "related": "related recommended recommendations trending popular more also next",
    "social": "share sharing social follow facebook twitter",
    "form": "form newsletter signup subscribe subscription login register search contact",
    "content": "content article post entry story body text main copy hentry",
    "hidden": "hidden none invisible",
}
GROUP_OF = {token: g for g, tokens in enumerate(TOKENS.values()) for token in tokens.split()}

TAGS = [
    {"nav", "menu"}, {"header"}, {"footer"}, {"aside"}, {"form", "fieldset"}, {"button", "label", "select", "option", "legend"},
    {"article"}, {"main"}, {"section"}, {"div", "center"}, {"p"}, {"h1"}, {"h2", "h3", "h4", "h5", "h6"}, {"ul", "ol", "dl"},
    {"li", "dt", "dd"}, {"a"}, {"table", "tbody", "tr", "td", "th", "thead"}, {"blockquote", "pre", "figure", "figcaption"},
    {"dialog", "address", "ins", "details"}, {"html", "body", "#root"}, INLINE - {"a", "ins", "label"},
]
TAG_OF = {tag: k for k, tags in enumerate(TAGS) for tag in tags}
# Tag groups that are also told of ancestors.
ABOVE = list(range(8)) + [14, 15, 18]

_TELLING = re.compile(r"class|id|role|style|hidden|aria", re.IGNORECASE)
_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
MAX_TOKEN_SETS = 50_000
_GROUPS: dict[str, int] = {}


def token_groups(named: dict[str, str]) -> int:
    """Bit set of the token groups that an element's attributes speak of."""
    said = " ".join(_CAMEL.sub(" ", named.get(k, "")) for k in ("class", "id", "role", "aria-label"))
    groups = 0
    for token in _SPLIT.split(said.lower()):
        if token in GROUP_OF:
            groups |= 1 << GROUP_OF[token]
    hidden = "hidden" in named or named.get("aria-hidden") == "true" or re.search(
        r"display:\s*none|visibility:\s*hidden", named.get("style", ""))
    return groups | (1 << GROUP_OF["hidden"] if hidden else 0)


def groups_of(attributes: str, element) -> int:
    if not _TELLING.search(attributes):
        return 0
    if attributes not in _GROUPS:
        if len(_GROUPS) >= MAX_TOKEN_SETS:
            _GROUPS.clear()
        _GROUPS[attributes] = token_groups(element.named())
    return _GROUPS[attributes]


# Groups of attribute tokens that let an inline element be judged by itself.
_APART = sum(1 << GROUP_OF[t] for t in ("ad", "nav", "notice", "comment", "share", "form", "hidden"))


# Items are judged as a list: one that is only a link says nothing by itself.
_FOLLOWING = (INLINE - {"label"}) | {"li", "dt", "dd"}


def scored(tag: str, groups: int) -> bool:
    """Whether an element is judged: blocks, form labels, and whatever is named as some other part."""
    return tag not in _FOLLOWING or bool(groups & _APART)


def _running(values: list[int]) -> list[int]:
    out, total = [0], 0
    for v in values:
        total += v
        out.append(total)
    return out


def features(page: Page) -> tuple[list[int], list[list[float]]]:
    """Indices of the judged elements with text, and a row of features for each."""
    elements, texts = page.elements, page.texts
    in_link = [False] * len(elements)
    own_groups, above_groups, above_tags = [0] * len(elements), [0] * len(elements), [0] * len(elements)
    for e in elements[1:]:
        up = e.parent
        in_link[e.index] = e.tag == "a" or in_link[up]
        own_groups[e.index] = groups_of(e.attributes, e) if e.attributes else 0
        above_groups[e.index] = above_groups[up] | own_groups[up]
        above_tags[e.index] = above_tags[up] | 1 << TAG_OF.get(elements[up].tag, 20)
    lengths = [0 if o < 0 else len(t.strip()) for o, t in texts]
    chars = _running(lengths)
    linked = _running([n if n and in_link[o] else 0 for n, (o, _) in zip(lengths, texts, strict=True)])
    stops = _running([sum(map(t.count, ",.;")) if n else 0 for n, (_, t) in zip(lengths, texts, strict=True)])
    total = max(1, chars[-1])

    seen: dict[int, list[int]] = {}
    for e in elements[1:]:
        if chars[e.end_text] > chars[e.start_text]:
            seen.setdefault(e.parent, []).append(e.index)
    indices, rows = [], []
    for parent, children in seen.items():
        sizes = [chars[elements[c].end_text] - chars[elements[c].start_text] for c in children]
        tags = [elements[c].tag for c in children]
        p = elements[parent]
        parent_chars = max(1, chars[p.end_text] - chars[p.start_text])
        same = Counter(tags)
        mean = sum(sizes) / len(sizes)
        for k, (c, n) in enumerate(zip(children, sizes, strict=True)):
            e = elements[c]
            if not scored(e.tag, own_groups[c]):
                continue
            tag_group, groups, above, above_tag = TAG_OF.get(e.tag, 20), own_groups[c], above_groups[c], above_tags[c]
            link = linked[e.end_text] - linked[e.start_text]
            count = e.end - e.index
            row = [
                np.log1p(n), n / total, n / parent_chars, link / n, count, n / count, (stops[e.end_text] - stops[e.start_text]) / n,
                e.depth, chars[e.start_text] / total, chars[e.end_text] / total, len(children), k, same[e.tag] / len(children),
                n / max(1.0, mean), TAG_OF.get(tags[k - 1], 20) if k else -1,
                TAG_OF.get(tags[k + 1], 20) if k + 1 < len(tags) else -1,
            ]
            row += [float(tag_group == g) for g in range(len(TAGS))]
            row += [float(above_tag >> g & 1) for g in ABOVE]
            row += [float(groups >> g & 1) for g in range(len(TOKENS))]
            row += [float(above >> g & 1) for g in range(len(TOKENS))]
            indices.append(c)
            rows.append(row)
    return indices, rows


def decode(page: Page, indices: list[int], scores: np.ndarray) -> list[bool]:
    """Which elements are kept: the set closed under parents with the greatest sum of log-odds.

    The root is always kept, so text outside all elements is.  Elements without
    a score are kept with their parents.
    """
    gain, judged = [0.0] * len(page.elements), [False] * len(page.elements)
    for i, s in zip(indices, np.clip(scores, -4, 4).tolist(), strict=True):
        gain[i], judged[i] = s, True
    for e in reversed(page.elements[1:]):
        if gain[e.index] > 0:
            gain[e.parent] += gain[e.index]
    keep = [True] * len(page.elements)
    for e in page.elements[1:]:
        keep[e.index] = keep[e.parent] and (gain[e.index] > 0 or not judged[e.index])
    return keep


def kept_text(page: Page, keep: list[bool]) -> str:
    return " ".join("".join(t if o < 0 or keep[o] else " " for o, t in page.texts).split())


def sample_labels(page: Page, indices: list[int]) -> list[int]:
    """Whether any text below an element belongs to the main text, by the samples' marks."""
    marks = [0] * len(page.elements)
    for e in page.elements[1:]:
        mark = e.named().get("data-main") if "data-main" in e.attributes else None
        marks[e.index] = marks[e.parent] if mark is None else int(mark)
    held = _running([int(o >= 0 and bool(t.strip()) and marks[o]) for o, t in page.texts])
    return [int(held[page.elements[i].end_text] > held[page.elements[i].start_text]) for i in indices]


@lru_cache(maxsize=1)
def model() -> boosting.Trees:
    rows, labels, weights = [], [], []
    for html in page_samples.pages():
        page = Page(html)
        indices, x = features(page)
        rows += x
        labels += sample_labels(page, indices)
        # Every page weighs the same, large elements a little more than small ones.
        share = np.array([1.0 + r[0] for r in x])
        weights += (share / share.sum()).tolist()
    w = np.array(weights)
    return boosting.train(np.array(rows), np.array(labels, dtype=float), w / w.mean())


def extract(htmls: list[str], trees: boosting.Trees) -> list[str]:
    """Main texts of some pages; their elements are scored together."""
    parsed = [Page(h) for h in htmls]
    found = [features(p) for p in parsed]
    rows = [r for _, x in found for r in x]
    scores = trees.raw(np.array(rows)) if rows else np.empty(0)
    out, at = [], 0
    for page, (indices, _) in zip(parsed, found, strict=True):
        out.append(kept_text(page, decode(page, indices, scores[at:at + len(indices)])))
        at += len(indices)
    return out


RESULT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])


def _extractor(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            htmls, texts = batch.column(2).to_pylist(), []
            for start, end in runs_of(htmls, 500_000):
                texts += extract(htmls[start:end], trees)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], schema=RESULT)
    return run


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text (empty if none) and n_chars of every page.

    Character references are decoded, white space becomes single spaces.  Null
    and empty html gives an empty text, html without elements all of its text;
    unclosed and misnested elements are closed as browsers close them, in time
    that grows with the page alone.  Very long pages are read whole.  Repeated
    rows give repeated results; other columns are not read; an empty table
    gives an empty table.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model())
    read = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    return (read.mapInArrow(_extractor(shared), "page_id long, url string, text string")
            .withColumn("n_chars", F.length("text").cast("long")))

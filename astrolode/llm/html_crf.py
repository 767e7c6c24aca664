"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

Every block of a page is labelled as main text or not. Its features are the tags of its
ancestors, the words of their class, id and role, and the shape of its own text and of its
neighbours'; the labels of neighbouring blocks depend on each other. Weights come from labelled
pages by maximum likelihood (forward-backward), the labels of a page by Viterbi.

Labelled pages are a bounded sample of the given ones whose article is marked up as such, and
the same articles set into other layouts (`LAYOUTS`), where it is known which blocks are theirs.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from astrolode.llm.common import key_type
from astrolode.llm.dom import Block, blocks

HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_SENTENCE = (".", "!", "?", "…", ":", "\"", "”", "»", "。")


@dataclass(frozen=True)
class Fit:
    """`pages` bounds the sample of given pages; longer ones than `blocks` are not learnt from."""

    pages: int = 150
    blocks: int = 80
    layouts: int = 5
    rounds: int = 120
    rate: float = 0.3
    decay: float = 0.02


@dataclass(frozen=True)
class Model:
    """Weights for "main text"; `moves[a][b]` scores label b after label a, `start` the first."""

    weights: dict[str, float]
    moves: tuple[tuple[float, float], tuple[float, float]]
    start: tuple[float, float]


@lru_cache(maxsize=20_000)
def _place_features(ancestors: tuple) -> tuple[str, ...]:
    tags = [tag for tag, _ in ancestors if tag not in ("html", "body")]
    tokens = {t for _, held in ancestors for t in held}
    inner = ancestors[-1][1] if ancestors else ()
    found = {f"in {t}" for t in tags} | {f"class {t}" for t in tokens} | {f"own {t}" for t in inner}
    return (*sorted(found), f"tag {tags[-1] if tags else ''}", f"path {'/'.join(tags[-2:])}")


def _size(words: int) -> int:
    return min(words.bit_length(), 7)


def features(page: Sequence[Block]) -> list[list[str]]:
    """The feature names of each block of a page."""
    sizes = [_size(b.text.count(" ") + 1) for b in page]
    out = []
    for i, b in enumerate(page):
        text, share = b.text, 4 * min(b.link_chars, len(b.text)) // len(b.text)
        found = [
            "", f"words {sizes[i]}", f"links {share}",
            "sentence" if text.endswith(_SENTENCE) else "no sentence",
            f"before {sizes[i - 1] if i else 'none'}",
            f"after {sizes[i + 1] if i + 1 < len(page) else 'none'}",
        ]
        if "©" in text or "(c)" in text.lower():
            found.append("copyright")
        if "|" in text or "»" in text or "›" in text:
            found.append("separators")
        out.append(found + list(_place_features(b.ancestors)))
    return out


# --- Labelled pages -----------------------------------------------------------------------

# Words that name what is not main text, and what may enclose main text, on common pages.
ASIDE_NAMES = {
    "menu": "menu nav navigation navbar topbar breadcrumb breadcrumbs toc pager pagination skip".split(),
    "header": "header masthead banner branding logo top".split(),
    "footer": "footer bottom copyright colophon legal imprint".split(),
    "sidebar": "sidebar side widget related recommended popular trending archive tags".split(),
    "notice": "notice cookie cookies consent gdpr alert message popup modal overlay privacy".split(),
    "advert": "ad ads advert advertisement advertising sponsored sponsor promo promotion".split(),
    "form": "form login signup subscribe newsletter search register".split(),
    "comments": "comments comment commentlist reply replies respond discussion disqus feedback".split(),
    "share": "share social follow meta byline author tools".split(),
}
MAIN_NAMES = ["content", "post", "article", "entry", "story", "main", "body", "text", "page"]


class _Writer:
    """Writes a page and knows which of its blocks are main text."""

    def __init__(self, rnd: random.Random, phrases: list[str]):
        self.rnd, self.phrases = rnd, phrases
        self.parts: list[str] = []
        self.labels: list[int] = []

    def raw(self, markup: str) -> None:
        self.parts.append(markup)

    def put(self, tag: str, text: str, label: int, link: bool = False) -> None:
        shown = f"<a href='#'>{escape(text)}</a>" if link else escape(text)
        self.raw(f"<{tag}>{shown}</{tag}>")
        self.labels.append(label)

    def phrase(self, words: int) -> str:
        held = self.rnd.choice(self.phrases).split()
        return " ".join(held[:max(1, words)])

    def aside(self, kind: str) -> None:
        """A part of the page that is not main text."""
        rnd, name = self.rnd, self.rnd.choice(ASIDE_NAMES[kind])
        native = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside",
                  "form": "form", "comments": "section"}.get(kind, "div")
        tag = native if rnd.random() < 0.5 else "div"
        attrs = f' {rnd.choice(("class", "id"))}="{name}"' if tag == "div" or rnd.random() < 0.5 else ""
        if tag == "section" and not attrs:
            attrs = f' id="{name}"'
        self.raw(f"<{tag}{attrs}>")
        if kind in ("menu", "share") or kind == "sidebar" and rnd.random() < 0.5:
            self.raw("<ul>")
            for _ in range(rnd.randint(2, 7)):
                self.put("li", self.phrase(rnd.randint(1, 4)), 0, link=True)
            self.raw("</ul>")
        elif kind == "form":
            for _ in range(rnd.randint(1, 3)):
                self.put(rnd.choice(("label", "p", "button")), self.phrase(rnd.randint(1, 8)), 0)
        elif kind in ("comments", "sidebar"):
            if rnd.random() < 0.6:
                self.put(rnd.choice(("h2", "h3")), self.phrase(2), 0)
            for _ in range(rnd.randint(1, 5)):
                # Full paragraphs: only their place tells them from the article's.
                self.put(rnd.choice(("p", "div", "li")), rnd.choice(self.phrases), 0)
        elif rnd.random() < 0.5:
            self.raw(escape(self.phrase(rnd.randint(2, 30))))
            self.labels.append(0)
        else:
            self.put("p", self.phrase(rnd.randint(2, 40)), 0, link=rnd.random() < 0.3)
        self.raw(f"</{tag}>")


def _laid_out(article: list[tuple[str, str]], rnd: random.Random, phrases: list[str]
              ) -> tuple[str, list[int]]:
    """The article, as (tag, text) pairs, in a layout drawn at random; a label for each block."""
    page = _Writer(rnd, phrases)
    page.raw("<html><head><title>x</title></head><body>")
    for kind in ("notice", "header", "menu", "advert", "sidebar"):
        if rnd.random() < 0.5:
            page.aside(kind)
    tag = rnd.choice(("article", "main", "div", "section", "div", "td", ""))
    attrs = ""
    if tag in ("div", "section") or tag and rnd.random() < 0.3:
        names = rnd.sample(MAIN_NAMES, rnd.randint(1, 2))
        attrs = f' {rnd.choice(("class", "id"))}="{"-".join(names)}"'
    inside = rnd.choices(("advert", "share", "sidebar", "form", "notice"), k=rnd.randint(0, 2))
    spots = {rnd.randrange(1, len(article) + 1): kind for kind in inside}
    page.raw(f"<table><tr><td{attrs}>" if tag == "td" else f"<{tag}{attrs}>" if tag else "")
    for i, (own, text) in enumerate(article):
        if i in spots:
            page.aside(spots[i])
        if own == "p" and i and rnd.random() < 0.08:
            page.put(rnd.choice(("h2", "h3")), page.phrase(rnd.randint(2, 6)), 1)
        if rnd.random() < 0.15:
            own = rnd.choice(("h2", "h3")) if own in HEADINGS else rnd.choice(("blockquote", "li", "pre"))
        page.put(own, text, 1)
    nested = tag and rnd.random() < 0.4
    if nested:
        page.aside(rnd.choice(("comments", "share", "form", "sidebar")))
    page.raw("</td></tr></table>" if tag == "td" else f"</{tag}>" if tag else "")
    for kind in ("comments", "sidebar", "form", "advert", "notice", "footer"):
        if rnd.random() < 0.45:
            page.aside(kind)
    page.raw("</body></html>")
    return "".join(page.parts), page.labels


_EXAMPLES = (
    "A short heading", "The first paragraph of an article says what it is about.",
    "It goes on for some more sentences, with a comma here and there, and comes to its end.",
    "Another paragraph follows the one before. It is longer, as it has more to say, and it says so.",
)


def labelled(pages: Sequence[str], fit: Fit = Fit(), seed: int = 1) -> list[tuple[list[Block], list[int]]]:
    """Blocks with labels: of given pages with one marked article, and of the same in other layouts.

    Without any such page the layouts are filled with a few example sentences.
    """
    rnd, own, articles = random.Random(seed), [], []
    for html in pages:
        page = blocks(html)
        label = [int(any(t == "article" for t, _ in b.ancestors)) for b in page]
        if 0 < sum(label) and len(page) <= fit.blocks:
            own.append((page, label))
            articles.append([
                (b.ancestors[-1][0] if b.ancestors[-1][0] in HEADINGS else "p", b.text)
                for b, y in zip(page, label, strict=True) if y])
    articles = articles or [[("h1", _EXAMPLES[0]), *(("p", t) for t in _EXAMPLES[1:])]] * 40
    phrases = [text for article in articles for _, text in article]
    made = []
    for article in articles:
        for _ in range(fit.layouts):
            html, label = _laid_out(article, rnd, phrases)
            page = blocks(html)
            if len(page) == len(label):
                made.append((page, label))
    return own + made


# --- Training and decoding ----------------------------------------------------------------


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def train(pages: Sequence[tuple[list[Block], list[int]]], fit: Fit = Fit()) -> Model:
    """Maximum likelihood with all pages side by side; absent blocks at their ends are masked."""
    names: dict[str, int] = {}
    rows, cols, longest = [], [], max(len(y) for _, y in pages)
    label = np.full((len(pages), longest), -1)
    for p, (page, y) in enumerate(pages):
        label[p, :len(y)] = y
        for t, held in enumerate(features(page)):
            for name in held:
                rows.append(p * longest + t)
                cols.append(names.setdefault(name, len(names)))
    rows, cols = np.array(rows), np.array(cols)
    there = label >= 0
    weights, moves, start = np.zeros(len(names)), np.zeros((2, 2)), np.zeros(2)
    total = there.sum()
    squares = [np.full_like(x, 1e-6) for x in (weights, moves, start)]
    pair = there[:, 1:]
    true_moves = np.zeros((2, 2))
    np.add.at(true_moves, (label[:, :-1][pair], label[:, 1:][pair]), 1)
    true_start = np.bincount(label[:, 0], minlength=2)
    for _ in range(fit.rounds):
        score = np.zeros((len(pages), longest, 2))
        score[:, :, 1] = np.bincount(rows, weights[cols], label.size).reshape(label.shape)
        # Forward and backward; a masked block passes on what it gets.
        forward, backward = np.empty_like(score), np.zeros_like(score)
        forward[:, 0] = start + score[:, 0]
        for t in range(1, longest):
            step = _log_sum(forward[:, t - 1, :, None] + moves, 1) + score[:, t]
            forward[:, t] = np.where(there[:, t, None], step, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            step = _log_sum(moves + (score[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(there[:, t + 1, None], step, 0)
        whole = _log_sum(forward[:, -1], 1)
        chance = np.exp(forward + backward - whole[:, None, None])
        joint = np.exp(
            forward[:, :-1, :, None] + moves + (score[:, 1:] + backward[:, 1:])[:, :, None, :]
            - whole[:, None, None, None])
        missing = np.where(there, (label == 1) - chance[:, :, 1], 0).ravel()
        grads = (
            np.bincount(cols, missing[rows], len(names)),
            true_moves - (joint * pair[:, :, None, None]).sum(axis=(0, 1)),
            true_start - chance[:, 0].sum(axis=0),
        )
        for value, square, grad in zip((weights, moves, start), squares, grads, strict=True):
            grad = grad / total * 100 - fit.decay * value
            square += grad ** 2
            value += fit.rate * grad / np.sqrt(square)
    held = {n: round(float(weights[i]), 6) for n, i in names.items() if abs(weights[i]) > 1e-4}
    return Model(held, tuple(map(tuple, moves.tolist())), tuple(start.tolist()))


def decode(page: Sequence[Block], model: Model) -> list[int]:
    """The most probable labels of a page's blocks (Viterbi)."""
    look, (stay, move) = model.weights.get, model.moves
    back: list[tuple[int, int]] = []
    a = b = 0.0
    for i, held in enumerate(features(page)):
        score = sum(look(name, 0.0) for name in held)
        if i == 0:
            a, b = model.start[0], model.start[1] + score
            continue
        from_a, from_b = (a + stay[0], b + move[0]), (a + stay[1], b + move[1])
        back.append((int(from_a[1] > from_a[0]), int(from_b[1] > from_b[0])))
        a, b = max(from_a), max(from_b) + score
    if not page:
        return []
    labels = [int(b > a)]
    for step in reversed(back):
        labels.append(step[labels[-1]])
    return labels[::-1]


def main_text(html: str, model: Model) -> str:
    page = blocks(html)
    return "\n".join(b.text for b, y in zip(page, decode(page, model), strict=True) if y)


def learn(pages: DataFrame, fit: Fit = Fit()) -> Model:
    """Train on at most `fit.pages` pages, drawn by a hash of page_id."""
    draw = F.xxhash64(F.col("page_id").cast("string"), F.lit("sample"))
    ids = pages.select("page_id").dropna().distinct().orderBy(draw).limit(fit.pages)
    # No more ids than the sample has; only the sample's pages reach the driver.
    rows = pages.join(F.broadcast(ids), "page_id", "left_semi").select(
        "page_id", F.coalesce("html", F.lit("")).alias("html")).dropDuplicates(["page_id"]).collect()
    return train(labelled([r["html"] for r in sorted(rows, key=lambda r: r["page_id"])], fit), fit)


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """`page_id`, `url`, `text` (the main text, empty if none) and its `n_chars`.

    A null html counts as empty. The whole page is read. Rows never move; repeated rows give
    repeated results, an empty table an empty one; extra columns are left out.
    """
    def run(batches):
        for batch in batches:
            found = [main_text(h, model) for h in batch["html"].to_pylist()]
            yield pa.record_batch([
                batch["page_id"], batch["url"], pa.array(found, pa.string()),
                pa.array([len(t) for t in found], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    return rows.mapInArrow(
        run, f"page_id {key_type(pages, 'page_id')}, url string, text string, n_chars long")

"""Main text of web pages: boosted trees over DOM nodes, decoded from the top down.

A page is read into block elements with the text, links and tags below them. Gradient-boosted trees
score each node by subtree density, tag and attribute tokens of it and its parent, depth and sibling
statistics. Decoding picks the likeliest labelling of the whole tree in which nothing below a dropped
node is kept and a node that differs from its parent pays for it.

The trees are trained on a bounded sample of the pages themselves. Their sectioning elements give weak
labels, and their paragraphs are set anew into pages of other usual structures, labelled by construction.
"""

import html
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.llm.common import by_value

by_value(__name__)

#: Pages that train the trees, in expectation, and the longest of them in characters.
SAMPLE, SAMPLE_CHARS = 250, 100_000
ROUNDS, DEPTH, RATE, BINS = 50, 4, 0.25, 24
TOKENS = 96
#: What it costs, in nats, to drop a node below one that is kept.
PARTING = 1.0
_SLICE = 256

# fixed values: elements by their part in a page
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
SILENT = frozenset(
    "audio button canvas head iframe noscript object option script select style svg template textarea title video".split()
)
RAW = frozenset("iframe noscript script style textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY_SAME = frozenset("p li dt dd tr td th option".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p "
    "pre section table ul".split()
)
KEPT_TAGS = frozenset("article main".split())
DROPPED_TAGS = frozenset("aside footer form header nav".split())
DROPPED_ANYWHERE = frozenset("aside form nav".split())
DROPPED_TOKENS = frozenset(
    "ad ads advert advertisement banner breadcrumb comment cookie copyright footer menu nav newsletter notice promo related "
    "share sidebar signup social sponsored subscribe".split()
)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^>\"'])*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
_NAMED = re.compile(r"(class|id|role|data-keep)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?]")


class Page:
    """The block elements of a page, in page order, and its runs of text."""

    __slots__ = ("parent", "tag", "tokens", "depth", "place", "children", "chars", "linked", "tags", "marks", "runs", "keep")

    def __init__(self, source: str, seen: dict):
        self.parent, self.tag, self.tokens, self.depth, self.place, self.children = [-1], ["html"], [("html",)], [0], [0], [0]
        self.chars, self.linked, self.tags, self.marks, self.keep = [0], [0], [0], [0], [None]
        self.runs = []  # (node, text), a new run at every edge of a block
        self._read(source, seen)
        for node in range(len(self.parent) - 1, 0, -1):
            up = self.parent[node]
            for sums in (self.chars, self.linked, self.tags, self.marks):
                sums[up] += sums[node]

    def _read(self, source: str, seen: dict) -> None:
        stack, inline, silent = [0], [], 0  # open blocks, open inline elements, open silent blocks
        parts, links, at, raw = [], 0, 0, None
        find = _TAG.search
        node, opened = 0, {}  # how many blocks of each tag are open, so that a stray end tag costs no search

        def flush():
            text = "".join(parts)
            parts.clear()
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text and not silent:
                self.runs.append((node, text))
                self.chars[node] += len(text)
                self.marks[node] += len(_PUNCTUATION.findall(text))

        while True:
            if raw:  # up to the end tag nothing is markup
                end = re.compile(rf"</{raw}(?=[\s/>])", re.I).search(source, at)
                at, raw = end.start() if end else len(source), None
            found = find(source, at)
            text = source[at : found.start() if found else len(source)]
            if text and not silent:
                parts.append(text)
                if links:
                    self.linked[node] += len(text)
            if not found:
                flush()
                return
            at = found.end()
            name = found[2] or found[5]
            if not name:
                continue
            tag, closing = name.lower(), found[1] or found[4]
            self.tags[node] += 1
            if tag in INLINE:
                if tag == "a":
                    links = 0 if closing else 1
                continue
            if tag in VOID:
                flush()
                continue
            flush()
            if closing:
                if opened.get(tag):
                    while True:
                        gone = self.tag[stack.pop()]
                        opened[gone] -= 1
                        silent -= gone in SILENT
                        if gone == tag:
                            break
            else:
                if tag in CLOSES_P and self.tag[stack[-1]] == "p" or tag in CLOSED_BY_SAME and self.tag[stack[-1]] == tag:
                    opened[self.tag[stack.pop()]] -= 1
                self._open(stack, tag, found[3] or found[6] or "", seen)
                opened[tag] = opened.get(tag, 0) + 1
                silent += tag in SILENT
                raw = tag if tag in RAW else None
            node, links = stack[-1], 0

    def _open(self, stack: list, tag: str, attributes: str, seen: dict) -> None:
        up = stack[-1]
        described = seen.get((tag, attributes))
        if described is None:
            named = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _NAMED.finditer(attributes)}
            keep = named.pop("data-keep", None)
            tokens = {t.rstrip("s") if len(t) > 4 else t for v in named.values() for t in re.split(r"[^a-z]+", v) if t}
            described = seen[tag, attributes] = ((tag, *sorted("." + t for t in tokens)), keep)
        stack.append(len(self.parent))
        self.parent.append(up)
        self.tag.append(tag)
        self.tokens.append(described[0])
        self.keep.append(described[1])
        self.depth.append(len(stack) - 1)
        self.place.append(self.children[up])
        self.children[up] += 1
        self.children.append(0)
        for sums in (self.chars, self.linked, self.tags, self.marks):
            sums.append(0)


def features(pages: list, vocabulary: dict) -> np.ndarray:
    """A row per node of all pages: numbers first, then own tokens, then the parent's."""
    sizes = [len(p.parent) for p in pages]
    first = np.repeat(np.cumsum([0, *sizes[:-1]]), sizes)
    column = lambda name: np.concatenate([np.asarray(getattr(p, name), float) for p in pages])
    parent = np.maximum(column("parent").astype(int), 0) + first
    chars, linked, tags, marks = (column(n) for n in ("chars", "linked", "tags", "marks"))
    place, children = column("place"), column("children")
    siblings = np.maximum(children[parent], 1)
    numbers = np.stack([
        np.log1p(chars), linked / (chars + 1), np.log1p(tags), np.log1p(chars / (tags + 1)), column("depth"),
        np.log1p(children), place / siblings, np.log1p(siblings), chars / (chars[parent] + 1), marks / (chars + 1),
        np.log1p(chars[parent] / siblings), linked[parent] / (chars[parent] + 1),
    ], axis=1)
    width = len(vocabulary)
    own = np.zeros((len(parent), width), np.float32)
    known = {}
    for row, tokens in enumerate(t for p in pages for t in p.tokens):
        at = known.get(tokens)
        if at is None:
            at = known[tokens] = [vocabulary[t] for t in tokens if t in vocabulary]
        own[row, at] = 1
    return np.concatenate([numbers.astype(np.float32), own, own[parent]], axis=1)


class Trees:
    """Boosted regression trees for a logistic loss, grown level by level on binned features."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], axis=1)
        score, self.trees = np.zeros(len(y)), []
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-score))
            tree, leaf = self._grow(binned, edges, p - y, p * (1 - p))
            self.trees.append(tree)
            score += tree[2][leaf]

    @staticmethod
    def _grow(binned, edges, gradient, curvature):
        n_nodes = 2**DEPTH
        feature, limit = np.zeros(n_nodes, int), np.full(n_nodes, np.inf)
        node = np.ones(len(gradient), int)
        for level in range(DEPTH):
            here = 2**level
            best = np.full(here, 1e-6)
            cut = np.full(here, BINS)
            chosen = np.zeros(here, int)
            for f in range(binned.shape[1]):
                code = (node - here) * BINS + binned[:, f]
                g = np.bincount(code, gradient, here * BINS).reshape(here, BINS).cumsum(axis=1)
                h = np.bincount(code, curvature, here * BINS).reshape(here, BINS).cumsum(axis=1)
                total_g, total_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g**2 / (total_h + 1)
                gain[:, len(edges[f]) :] = 0
                at = gain.argmax(axis=1)
                top = gain[np.arange(here), at]
                better = top > best
                best[better], cut[better], chosen[better] = top[better], at[better], f
            for k in range(here):
                if cut[k] < BINS:
                    feature[here + k], limit[here + k] = chosen[k], edges[chosen[k]][cut[k]]
            own = node - here
            node = 2 * node + (binned[np.arange(len(node)), chosen[own]] > cut[own])
        leaf = node - n_nodes
        g, h = np.bincount(leaf, gradient, n_nodes), np.bincount(leaf, curvature, n_nodes)
        return (feature, limit, -RATE * g / (h + 1)), leaf

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row."""
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for feature, limit, values in self.trees:
            node = np.ones(len(x), int)
            for _ in range(DEPTH):
                node = 2 * node + (x[rows, feature[node]] > limit[node])
            total += values[node - len(values)]
        return total


def decode(parent: list, odds: np.ndarray) -> np.ndarray:
    """Which nodes are kept in the likeliest labelling: none under a dropped one. The root is kept."""
    kept, dropped = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
    for node in range(len(parent) - 1, 0, -1):  # children come behind their parents
        kept[parent[node]] += max(kept[node], dropped[node] - PARTING)
        dropped[parent[node]] += dropped[node]
    out = np.ones(len(parent), bool)
    for node in range(1, len(parent)):
        out[node] = out[parent[node]] and kept[node] >= dropped[node] - PARTING
    return out


def _weak_labels(page: Page) -> list:
    """True, False or None (holds both, or unknown) per node, by sectioning elements and marks."""
    labels = []
    for node, up in enumerate(page.parent):
        above = labels[up] if node else None
        words = {t.lstrip(".") for t in page.tokens[node]}
        if page.keep[node]:
            labels.append(page.keep[node] == "1")
        elif above is False or page.tag[node] in DROPPED_TAGS and above is None or page.tag[node] in DROPPED_ANYWHERE or DROPPED_TOKENS & words:
            labels.append(False)
        elif page.tag[node] in KEPT_TAGS:
            labels.append(True)
        else:
            labels.append(above)
    return labels


# fixed values: structures that pages usually have
_HOLDERS = [
    "<article>|</article>", "<main>|</main>", '<div class="content">|</div>', '<div class="post-body">|</div>',
    '<section id="article">|</section>', '<div class="entry">|</div>', '<div id="story">|</div>', "<div>|</div>",
]
_NOISE = {
    "links": ["<nav>|</nav>", '<div class="menu">|</div>', '<ul class="nav">|</ul>', '<div class="breadcrumb">|</div>',
              '<aside class="sidebar">|</aside>', "<aside>|</aside>", '<div class="tags">|</div>', '<div class="related">|</div>', '<div class="share-social">|</div>'],
    "words": ["<header>|</header>", "<footer>|</footer>", '<div class="footer">|</div>', '<div class="ad">|</div>',
              '<div class="advert sponsored">|</div>', '<div class="banner promo">|</div>', '<div class="cookie-notice">|</div>',
              '<div role="alert" class="notice">|</div>', '<div class="sidebar">|</div>', "<form>|</form>",
              '<form class="newsletter">|</form>', "<aside>|</aside>", '<p class="copyright">|</p>', '<div class="copyright">|</div>',
              '<div class="signup">|</div>', '<div class="subscribe box">|</div>', '<section class="newsletter-signup">|</section>',
              '<div class="modal consent">|</div>', '<div class="header">|</div>'],
    "talk": ['<section class="comments">|</section>', '<div id="comments">|</div>', '<ol class="commentlist">|</ol>'],
}


def _marked(frame: str, inside: str, keep: int) -> str:
    start, end = frame.split("|")
    return f'{start[:-1]} data-keep="{keep}">{inside}{end}'


def _shown(draw: random.Random, text: str) -> list:
    """Pictures with captions, tables and lists of terms: an article's own, too."""
    words = text.split() or ["x"]
    cells = [" ".join(words[k :: 4]) or "0" for k in range(4)]
    rows = "".join(f"<tr><td>{a}</td><td>{b}</td></tr>" for a, b in (cells[:2], cells[2:]))
    return [
        f'<figure><img src="a.png"><figcaption>{text[:60]}</figcaption></figure>', f"<table>{rows}</table>",
        f"<table><thead><tr><th>{cells[0][:12]}</th><th>{cells[1][:12]}</th></tr></thead><tbody>{rows}</tbody></table>",
        f"<dl><dt>{text[:12]}</dt><dd>{text}</dd></dl>",
    ]


def _composed(draw: random.Random, paragraphs: list, noise: list) -> str:
    """A page of usual structure around some paragraphs; every frame says whether it is kept."""
    some = lambda texts, low, high: [html.escape(draw.choice(texts)) for _ in range(draw.randint(low, high))]

    def bit():
        kind = draw.choice(list(_NOISE))
        frame = draw.choice(_NOISE[kind])
        if kind == "links":
            items = "".join(f'<li><a href="/{k}">{t[:12]}</a></li>' for k, t in enumerate(some(noise, 3, 9)))
            inside = items if "<ul" in frame else f"<ul>{items}</ul>"
        elif kind == "words":
            inside = draw.choice(["|", "<p>|</p>"]).replace("|", " ".join(some(noise, 1, 2)))
        else:
            inside = "".join(f'<div class="comment"><p>{t}</p></div>' for t in some(paragraphs, 1, 5))
        return _marked(frame, inside, 0)

    body = [f"<h1>{t[:60]}</h1>" for t in some(paragraphs, 1, 1)]
    for text in some(paragraphs, 1, 9):
        if draw.random() < 0.2:
            text = text[: draw.randint(2, 30)]
        body.append(draw.choice([f"<p>{text}</p>"] * 6 + [f"<h2>{text[:40]}</h2>", f"<ul><li>{text}</li></ul>", f"<p><b>{text}<br>", f"<blockquote><p>{text}</p></blockquote>", *_shown(draw, text)]))
    for _ in range(draw.choice([0, 0, 1, 1, 2])):
        body.insert(draw.randint(1, len(body)), bit())
    if draw.random() < 0.25:
        body.insert(draw.randint(1, len(body)), _marked("<aside>|</aside>", draw.choice(["|", "<p>|</p>"]).replace("|", some(noise + paragraphs, 1, 1)[0]), 0))
    holder = draw.choice(_HOLDERS)
    main = _marked(holder, "".join(body), 1)
    before, after = [bit() for _ in range(draw.randint(1, 4))], [bit() for _ in range(draw.randint(1, 4))]
    if draw.random() < 0.25:
        after.insert(1, _marked(draw.choice(['<p class="copyright">|</p>', '<div class="copyright">|</div>']), some(noise, 1, 1)[0], 0))
    middle = "".join([*before[1:], main, *after[1:]])
    if draw.random() < 0.4:
        middle = f'<div class="wrapper">{middle}</div>'
    return f"<html><body>{before[0]}{middle}{after[0]}</body></html>"


def train(sources: list) -> tuple[Trees, dict]:
    """Trees and token vocabulary from a sample of pages; the same ones for the same sample."""
    seen = {}
    pages = [Page(s, seen) for s in sources]
    labels = [_weak_labels(p) for p in pages]
    paragraphs, noise = ["text of a paragraph, as it is."], ["home", "about us"]
    for page, own in zip(pages, labels):
        for node, text in page.runs:
            if own[node] is not None:
                (paragraphs if own[node] else noise).append(text)
    draw = random.Random(5)
    for _ in range(max(200, len(sources))):
        pages.append(Page(_composed(draw, paragraphs, noise), seen))
        labels.append(_weak_labels(pages[-1]))
    counts = {}
    for page in pages:
        for token in {t for tokens in page.tokens for t in tokens}:
            counts[token] = counts.get(token, 0) + 1
    common = sorted(counts, key=lambda t: (-counts[t], t))[:TOKENS]
    vocabulary = {t: k for k, t in enumerate(common)}
    flat = [label for own in labels for label in own]
    known = np.array([label is not None for label in flat])
    y = np.array([bool(label) for label in flat], float)
    return Trees(features(pages, vocabulary)[known], y[known]), vocabulary


def extract(sources: list, trees: Trees, vocabulary: dict, seen: dict) -> list:
    """The main texts of some pages."""
    pages = [Page(s or "", seen) for s in sources]
    odds = trees.score(features(pages, vocabulary))
    texts, at = [], 0
    for page in pages:
        kept = decode(page.parent, odds[at : at + len(page.parent)])
        at += len(page.parent)
        texts.append(" ".join(text for node, text in page.runs if kept[node]))
    return texts


def main_texts(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per page: page_id, url, text and n_chars (code points).

    Reads ``page_id``, ``url`` and ``html``. A null or empty html has an empty text. Whole pages are read,
    whatever their length; unclosed and stray tags are mended as browsers do for blocks. Repeated rows
    come out alike, pages without page_id are read as others and not trained on. Training takes about
    ``sample`` pages, chosen by a hash of page_id, twice as many at most. An empty table gives an empty result.
    """
    usable = pages.filter("html is not null and page_id is not null").select("page_id", "html")
    usable = usable.filter(F.char_length("html") <= SAMPLE_CHARS)
    total = pages.select("page_id").count()
    draw = F.pmod(F.xxhash64("page_id"), F.lit(1 << 30)) / float(1 << 30)
    # about ``sample`` pages; a page_id of very many rows can't make them more than twice that
    drawn = usable.filter(draw < F.lit(sample / max(total, 1))).distinct()
    chosen = drawn.orderBy(F.xxhash64("page_id", "html")).limit(2 * sample).collect()
    trees, vocabulary = train([r["html"] for r in sorted(chosen, key=lambda r: (r["page_id"], r["html"]))])

    def read(batches):
        seen = {}
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                part = batch.slice(at, _SLICE)
                texts = extract(part.column(2).to_pylist(), trees, vocabulary, seen)
                if len(seen) > 50_000:
                    seen.clear()
                arrays = [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(read, "page_id bigint, url string, text string, n_chars bigint")

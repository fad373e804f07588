"""HTML extraction (1): flat text blocks classified by a small decision tree.

A page is cut into flat text blocks at block-level tags.  A block's features
are its word count and link density and those of its two neighbours (the
quantitative ones), whether it is a heading, whether it lies in the page's
article or main element, whether the page has one, and whether an element
around it is a menu, header, footer, sidebar, notice, advert, form or comment
list by its name, role, class or id.  The tree is trained on the labelled
blocks of ``page_samples`` by the same segmentation; the blocks it calls main
text are joined in page order.
"""

from __future__ import annotations

import html as html_lib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.llm.common import small_batches, text_chunks
from duelframe.llm.page_samples import PAGES

# HTML element names and words of class names.
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
                  "optgroup p pre search section summary table tbody tfoot thead tr ul caption".split())
CONTAINERS = frozenset("address article aside blockquote center details dialog div dl fieldset figure footer form "
                       "header main menu nav ol search section table ul".split())
RAW = ("script", "style", "noscript", "template", "textarea", "select", "svg", "math", "iframe", "object", "head",
       "button", "title", "audio", "video", "canvas", "noframes", "datalist")
BOILER_TAGS = frozenset("nav footer aside form menu dialog search fieldset".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu "
                         "menubar toolbar".split())
BOILER_WORDS = re.compile(
    r"(?:^|[\s_-])(?:nav(?:bar|igation)?|menu|header|masthead|topbar|footer|side-?bar|aside|ad|ads|adv|advert\w*|"
    r"adsense|banner|promo\w*|sponsor\w*|cookies?|consent|gdpr|notice|notification|alert|popup|modal|overlay|"
    r"newsletter|subscribe|subscription|sign-?up|share|sharing|social|related|recommend\w*|comment\w*|respond|"
    r"replies|reply|discussion|disqus|breadcrumbs?|pagination|pager|widget|toolbar|log-?in|search|copyright|"
    r"disclaimer|paywall|outbrain|taboola)(?=$|[\s_-])", re.I)
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(RAW) + r")\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^>]*>|<[!?][^>]*>", re.S | re.I)
_ATTR = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_RAW_END = {name: re.compile(rf"</{name}\s*[^>]*>", re.I) for name in RAW}
_HEAD_END = re.compile(r"</head\s*>|<body\b", re.I)


def _boiler(name: str, attrs: str) -> bool:
    if name in BOILER_TAGS:
        return True
    if not attrs or "=" not in attrs and "hidden" not in attrs:
        return False
    for key, a, b, c in _ATTR.findall(attrs):
        key, value = key.lower(), a or b or c
        if key in ("class", "id") and BOILER_WORDS.search(value):
            return True
        if key == "role" and value.lower() in BOILER_ROLES or key == "style" and _HIDDEN.search(value):
            return True
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
    return False


def blocks(page: str) -> list[tuple[str, int, int, bool, bool, bool]]:
    """Flat blocks in page order: (text, words, linked words, heading, in main, boilerplate element)."""
    out, parts, linked = [], [], 0
    stack: list[tuple[str, bool, bool]] = []       # (element, boilerplate, main) of the open containers
    in_link, heading, at, end, breaks = False, False, 0, len(page), 0

    def flush():
        nonlocal parts, linked
        if parts:
            text = " ".join(" ".join(parts).split()) if len(parts) > 1 else " ".join(parts[0].split())
            if text:
                main = any(m for _, _, m in stack)
                out.append((text, text.count(" ") + 1, linked, heading, main, any(b for _, b, _ in stack)))
        parts, linked = [], 0

    def add(raw: str):
        nonlocal linked, breaks
        text = html_lib.unescape(raw) if "&" in raw else raw
        if text.strip():
            breaks = 0
            if in_link:
                linked += len(text.split())
        glue.append(text)

    glue: list[str] = []

    def close_glue():
        if glue:
            parts.append("".join(glue))
            glue.clear()

    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        raw = m.group("raw")
        if raw:
            raw = raw.lower()
            stop = (_HEAD_END if raw == "head" else _RAW_END[raw]).search(page, at)
            if stop is None:
                at = at if raw == "head" else end        # an open head is read on, other raw text runs to the end
            else:
                at = stop.start() if stop.group().lower().startswith("<body") else stop.end()
            continue
        name = m.group("name")
        if not name:
            continue
        name, closing = name.lower(), bool(m.group("close"))
        if name == "br":
            breaks += 1
            close_glue()
            if breaks > 1:
                flush()
        elif name == "a":
            in_link = not closing
        elif name in ("td", "th"):
            close_glue()
        elif name in BLOCK:
            close_glue()
            flush()
            in_link, breaks = False, 0
            if name in HEADINGS:
                heading = not closing
            elif name in ("p", "li") or name in CONTAINERS:
                heading = False
            if name in CONTAINERS:
                if closing:
                    if any(s[0] == name for s in stack):
                        while stack.pop()[0] != name:
                            pass
                elif not m.group("attrs").rstrip().endswith("/"):
                    attrs = m.group("attrs")
                    main = name in ("article", "main") or 'role="main"' in attrs
                    boiler = _boiler(name, attrs) or name == "header" and not any(s[2] for s in stack)
                    stack.append((name, boiler and not main, main))
            elif name in ("p", "li") and not closing and stack and m.group("attrs"):
                if _boiler(name, m.group("attrs")):
                    stack.append((name, True, False))
            elif closing and stack and stack[-1][0] == name:
                stack.pop()
    close_glue()
    flush()
    return out


def block_features(found) -> np.ndarray:
    """(blocks, 10) feature table of one page."""
    n = len(found)
    x = np.zeros((n, 10))
    x[:, 0] = [b[1] for b in found]
    x[:, 1] = [b[2] / b[1] for b in found]
    x[1:, 2:4], x[:-1, 4:6] = x[:-1, 0:2], x[1:, 0:2]
    x[:, 6] = [b[3] for b in found]
    x[:, 7] = [b[4] for b in found]
    x[:, 8] = any(b[4] and not b[5] for b in found)
    x[:, 9] = [b[5] for b in found]
    return x


def labelled_blocks() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels (1 main text) of the blocks of the labelled pages."""
    def words(m):
        k = int(m.group(2))
        return f" <a>{'w ' * k}</a>" if m.group(1) else " " + "w " * k

    xs, ys = [], []
    for page in PAGES:
        found = blocks(re.sub(r"\{(l:)?(\d+)\}", words, page))
        marks = [b[0][0] for b in found]
        found = [(b[0][1:], b[1] - 1, b[2], *b[3:]) for b in found]
        xs.append(block_features(found))
        ys.append(np.array([m == "+" for m in marks], int))
    return np.concatenate(xs), np.concatenate(ys)


def train_tree(x: np.ndarray, y: np.ndarray, depth: int = 7) -> tuple:
    """A Gini decision tree as nested (feature, threshold, left, right); a leaf is 0 or 1."""
    if depth == 0 or y.min() == y.max():
        return int(2 * y.sum() >= len(y))
    best = None
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, ones = x[order, f], np.cumsum(y[order])
        cut = np.flatnonzero(v[1:] > v[:-1])
        if not len(cut):
            continue
        n = cut + 1.0
        left, right = ones[cut], ones[-1] - ones[cut]
        m = len(y) - n
        impurity = left * (n - left) / n + right * (m - right) / m
        k = int(np.argmin(impurity))
        if best is None or impurity[k] < best[0] - 1e-12:
            best = (impurity[k], f, (v[cut[k]] + v[cut[k] + 1]) / 2)
    if best is None:
        return int(2 * y.sum() >= len(y))
    _, f, threshold = best
    go = x[:, f] <= threshold
    return (f, float(threshold), train_tree(x[go], y[go], depth - 1), train_tree(x[~go], y[~go], depth - 1))


def apply_tree(tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, int):
        return np.full(len(x), tree, bool)
    f, threshold, low, high = tree
    go = x[:, f] <= threshold
    out = np.empty(len(x), bool)
    out[go], out[~go] = apply_tree(low, x[go]), apply_tree(high, x[~go])
    return out


def main_text(page: str | None, tree) -> str:
    """The main text of one page; null, empty and text-less pages give an empty string."""
    found = blocks(page) if page else []
    if not found:
        return ""
    keep = apply_tree(tree, block_features(found))
    return "\n".join(b[0] for b, k in zip(found, keep) if k)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "dfx_main") -> DataFrame:
    """All columns of ``pages`` and the main text of each row, from the whole html."""
    small_batches(pages.sparkSession)
    tree = train_tree(*labelled_blocks())
    names = pages.columns

    def run(batches):
        for batch in batches:
            for part in text_chunks(batch, html_col):
                texts = [main_text(p, tree) for p in part.column(html_col).to_pylist()]
                keep = [part.column(c) for c in names if c != html_col]
                yield pa.RecordBatch.from_arrays([*keep, pa.array(texts, pa.string())],
                                                 names=[*(c for c in names if c != html_col), text_col])

    slim = pages.drop(html_col).schema.add(text_col, "string")
    return pages.mapInArrow(run, slim)

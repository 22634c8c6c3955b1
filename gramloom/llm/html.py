"""Main text of web pages by a linear-chain conditional random field over the leaf blocks of the document tree.

A page is cut into blocks: stretches of text without a block-level tag in between. Each has features of its ancestors
(tags, and words in their classes and ids) and of its text (length, share of links, punctuation). The field gives every sequence of
labels, main or not, a score from features and from neighbouring labels; Viterbi's algorithm finds the best.

The field is trained by maximum likelihood on labelled pages: a bounded sample of the given pages in which an article or
main element tells the blocks apart, and pages laid out here in many ways with text of that sample, whose labels are
known because they were built so.

Null, empty and blank pages have the empty text, and so have pages without a main block. Scripts, styles, comments and other
content that is not shown is no block. Unclosed tags end with their parents.
"""

from __future__ import annotations

import html
import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramloom.llm.common import over_texts, row_share

SAMPLE = 300  # given pages that the field learns from, at most about
LAID_OUT, ROUNDS, RATE, PENALTY = 500, 150, 0.1, 1e-3
DEEPEST = 300  # open elements that count as ancestors, as browsers bound them; text further down is kept
MAX_BLOCKS = 120  # of a page learnt from; longer ones are not learnt from (they are decoded whole)

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][\w:-]*+)((?>\"[^\"]*\"|'[^']*'|[^'\">])*+)>", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_UNSEEN = set("script style noscript template textarea svg iframe head title select object canvas audio video math".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = set("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot
th thead tr ul label""".split())
#: Opening one of these closes an open element of the set after it.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_TAGS = "nav header footer aside form menu article main section ul table blockquote pre figure button label dialog address details".split()
#: Words in classes, ids and roles, by what they announce.
_HINTS = [re.compile(p, re.I) for p in (
    r"nav|menu|breadcrumb|toolbar|topbar|pagination|pager", r"foot|copyright|legal|imprint", r"side|widget|rail|column-right",
    r"\bads?\b|advert|sponsor|promo|\bad[-_]|banner|affiliate", r"cookie|consent|notice|alert|popup|modal|gdpr|privacy|warning|overlay",
    r"comment|repl(?:y|ies)|disqus|discuss|respond|feedback|review", r"share|social|related|recommend|\btags?\b|more-|teaser|trending|follow",
    r"login|sign-?(?:in|up)|subscri|newsletter|search|form|register|contact", r"content|article|post|entry|story|\bbody|text|main|page-body",
    r"head|masthead|logo|brand|title-?bar", r"hidden|display:\s*none|sr-only|visually", r"author|byline|meta|date|time")]
_STOP = re.compile(r"[.!?…][\"'”»)]*$")


def _features_of(path: tuple[tuple[str, str], ...]) -> np.ndarray:
    """Features of the ancestors, given as (tag, words of class, id and role)."""
    tags = {t for t, _ in path}
    words = [w for _, w in path if w]
    inner = path[-1][0] if path else ""
    out = [t in tags for t in _TAGS] + [any(h.search(w) for w in words) for h in _HINTS]
    last = max((i for i, (t, _) in enumerate(path) if t in ("article", "main")), default=-1)
    after = path[last + 1:] if last >= 0 else ()
    unwanted = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button"}
    out += [last >= 0 and not any(t in unwanted for t, _ in after), last >= 0 and any(t in unwanted for t, _ in after),
            last >= 0 and any(h.search(w) for h in _HINTS[:8] for _, w in after),
            inner == "p", inner in ("h1", "h2"), inner in ("h3", "h4", "h5", "h6"), inner == "li", inner in ("td", "th"), inner in ("div", "section", "article", "main")]
    return np.array(out, float)


_N_PATH = len(_features_of(()))
_N_TEXT = 12
N_FEATURES = _N_PATH + _N_TEXT


def _text_features(text: str, linked: int, at: float) -> list[float]:
    n = text.count(" ") + 1
    share = min(1.0, linked / max(1, len(text)))
    return [1.0, min(np.log1p(n), 6.0) / 3, n < 4, 4 <= n < 12, n >= 25, share, share > 0.6, bool(_STOP.search(text)),
            min(1.0, 10 * text.count(",") / n), "©" in text or "(c)" in text, text.isupper(), at]


def blocks(page: str | None) -> list[tuple[tuple, str, int]]:
    """(path of ancestors, text, characters in links) of every block, in page order."""
    out: list[tuple[tuple, str, int]] = []
    if not page:
        return out
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    linked = at = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append((tuple(stack), text, linked))
            parts.clear()
        linked = 0

    size = len(page)
    while at < size:
        found = _TOKEN.search(page, at)
        upto = found.start() if found else size
        if upto > at:
            piece = page[at:upto]
            parts.append(piece)
            if any(t == "a" for t, _ in stack):
                linked += len(piece)
        if not found:
            break
        at = found.end()
        name = found.group(2)
        if name is None:
            continue
        name, closing = name.lower(), bool(found.group(1))
        if name in _UNSEEN:
            if not closing and not found.group(3).endswith("/"):
                end = re.compile(rf"</{name}\s*>|</{name}\b[^>]*>", re.I).search(page, at)
                if end:
                    at = end.end()
                elif name != "head":
                    at = size
            continue
        block = name in _BLOCK
        if block:
            flush()
        if closing:
            if any(t == name for t, _ in stack):
                while stack and stack.pop()[0] != name:
                    pass
            continue
        if name in _VOID:
            if name == "br":
                parts.append(" ")
            continue
        if block:
            if any(t == "p" for t, _ in stack):  # a paragraph ends where a block begins
                while stack and stack.pop()[0] != "p":
                    pass
            if name in _CLOSES and stack and stack[-1][0] in _CLOSES[name]:
                stack.pop()
        words = ""
        if found.group(3):
            words = " ".join((v[1] or v[2] or v[3]) if v[0].lower() != "hidden" else "hidden" for v in _ATTRIBUTE.findall(found.group(3)))
        if len(stack) < DEEPEST:
            stack.append((name, words))
    flush()
    return out


class _Paths(dict):
    def __missing__(self, path: tuple) -> np.ndarray:
        if len(self) > 20_000:
            self.clear()
        self[path] = _features_of(path)
        return self[path]


def features(found: list, known: dict) -> np.ndarray:
    x = np.empty((len(found), N_FEATURES))
    for i, (path, text, linked) in enumerate(found):
        x[i, :_N_PATH] = known[path]
        x[i, _N_PATH:] = _text_features(text, linked, i / len(found))
    return x


@dataclass
class Field:
    """Weights of the features for "main", and the scores of neighbouring labels (from, to); first and last labels."""

    weights: np.ndarray
    moves: np.ndarray
    ends: np.ndarray  # (first or last, label)

    def labels(self, x: np.ndarray) -> np.ndarray:
        """The best sequence of labels, by Viterbi's algorithm."""
        if not len(x):
            return np.zeros(0, bool)
        gain = (x @ self.weights).tolist()
        (stay0, to1), (to0, stay1) = self.moves.tolist()
        a, b = float(self.ends[0, 0]), gain[0] + float(self.ends[0, 1])
        back = []
        for g in gain[1:]:
            from0, from1 = a + to1 >= b + stay1, a + stay0 >= b + to0
            a, b, row = (a + stay0 if from1 else b + to0), g + (a + to1 if from0 else b + stay1), (from1, from0)
            back.append(row)
        label = int(b + self.ends[1, 1] > a + self.ends[1, 0])
        out = [label]
        for zero_from_zero, one_from_zero in reversed(back):
            label = int(not (one_from_zero if label else zero_from_zero))
            out.append(label)
        return np.array(out[::-1], bool)


def train(pages: list[tuple[np.ndarray, np.ndarray]]) -> Field:
    """Maximum likelihood on (features, labels) of pages, all pages at once, by adaptive gradient steps."""
    pages = [(x, y) for x, y in pages if 0 < len(x) <= MAX_BLOCKS]
    longest = max(len(x) for x, _ in pages)
    x = np.zeros((len(pages), longest, N_FEATURES))
    y = np.zeros((len(pages), longest), int)
    mask = np.zeros((len(pages), longest))
    for i, (a, b) in enumerate(pages):
        x[i, :len(a)], y[i, :len(b)], mask[i, :len(a)] = a, b, 1
    last = mask.sum(1).astype(int) - 1
    rows = np.arange(len(pages))
    both = mask[:, 1:] * mask[:, :-1]
    theta = np.zeros(N_FEATURES + 8)
    first_m, second_m = np.zeros_like(theta), np.zeros_like(theta)
    for turn in range(1, ROUNDS + 1):
        weights, moves, ends = theta[:N_FEATURES], theta[N_FEATURES:N_FEATURES + 4].reshape(2, 2), theta[N_FEATURES + 4:].reshape(2, 2)
        unary = np.stack([np.zeros(mask.shape), x @ weights], 2)
        unary[:, 0] += ends[0]
        unary[rows, last] += ends[1]
        forward, backward = np.zeros_like(unary), np.zeros_like(unary)
        forward[:, 0] = unary[:, 0]
        for t in range(1, longest):
            step = np.logaddexp(forward[:, t - 1, 0, None] + moves[0], forward[:, t - 1, 1, None] + moves[1]) + unary[:, t]
            forward[:, t] = np.where(mask[:, t, None] > 0, step, forward[:, t - 1])
        total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
        for t in range(longest - 2, -1, -1):
            ahead = unary[:, t + 1] + backward[:, t + 1]
            step = np.logaddexp(moves[None, :, 0] + ahead[:, 0, None], moves[None, :, 1] + ahead[:, 1, None])
            backward[:, t] = np.where(mask[:, t + 1, None] > 0, step, 0.0)
        marginal = np.exp(forward + backward - total[:, None, None]) * mask[:, :, None]
        pair = np.exp(forward[:, :-1, :, None] + moves + (unary + backward)[:, 1:, None, :] - total[:, None, None, None]) * both[:, :, None, None]
        gradient = np.zeros_like(theta)
        gradient[:N_FEATURES] = np.einsum("pt,ptf->f", mask * (y - marginal[:, :, 1]), x)
        seen = np.array([[(both * (y[:, :-1] == a) * (y[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)])
        gradient[N_FEATURES:N_FEATURES + 4] = (seen - pair.sum((0, 1))).ravel()
        starts = np.array([(y[:, 0] == a).sum() for a in (0, 1)]) - marginal[:, 0].sum(0)
        stops = np.array([(y[rows, last] == a).sum() for a in (0, 1)]) - marginal[rows, last].sum(0)
        gradient[N_FEATURES + 4:] = np.concatenate([starts, stops])
        gradient = gradient / len(pages) - PENALTY * theta
        first_m = 0.9 * first_m + 0.1 * gradient
        second_m = 0.99 * second_m + 0.01 * gradient ** 2
        theta = theta + RATE * (first_m / (1 - 0.9 ** turn)) / (np.sqrt(second_m / (1 - 0.99 ** turn)) + 1e-8)
    return Field(theta[:N_FEATURES], theta[N_FEATURES:N_FEATURES + 4].reshape(2, 2), theta[N_FEATURES + 4:].reshape(2, 2))


def given_labels(found: list) -> np.ndarray | None:
    """Labels of a page whose article or main element tells: inside and not in chrome. None where there is no such element."""
    path_features = [_features_of(path) for path, _, _ in found]
    at = len(_TAGS) + len(_HINTS)
    labels = np.array([bool(f[at]) and not f[at + 2] for f in path_features])
    return labels if labels.any() else None


def laid_out(texts: list[str], count: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pages in many layouts, with text from the given ones. The same on every run."""
    draw = random.Random(7)
    words = [w for t in texts for w in t.split()] or "one two three four five six seven eight nine ten".split()
    words = words[:20_000]
    known, out, twice = _Paths(), [], words + words

    def prose(low: int, high: int, stop: str = ".") -> str:
        at = draw.randrange(len(words))
        n = draw.randint(low, high)
        return html.escape(" ".join(twice[at:at + n]).rstrip(".") + stop)

    def links(n: int) -> str:
        return "".join(f"<li><a href='/{i}'>{prose(1, 3, '')}</a></li>" for i in range(n))

    def chrome(kind: str) -> str:
        n = draw.randint(1, 4)
        return {
            "nav": f"<{(t := draw.choice(['nav', 'div class=menu', 'div id=navigation', 'ul class=breadcrumbs', 'div role=navigation']))}><ul>{links(draw.randint(2, 8))}</ul></{t.split()[0]}>",
            "header": f"<{(t := draw.choice(['header', 'div id=header', 'div class=masthead']))}><a href='/'>{prose(1, 3, '')}</a><p>{prose(3, 9, '')}</p></{t.split()[0]}>",
            "footer": f"<{(t := draw.choice(['footer', 'div id=footer', 'div class=site-footer']))}><p>&copy; {prose(3, 12)}</p>{draw.choice(['', f'<ul>{links(3)}</ul>'])}</{t.split()[0]}>",
            "side": f"<{(t := draw.choice(['aside', 'div class=sidebar', 'div id=right-rail', 'section class=widget']))}><h3>{prose(1, 4, '')}</h3><p>{prose(5, 40)}</p></{t.split()[0]}>",
            "ad": f"<div class='{draw.choice(['ad', 'ads', 'advert', 'sponsored', 'promo-box', 'banner-ad'])}'>{prose(3, 30)}</div>",
            "notice": f"<div {draw.choice(['class=cookie-notice', 'id=cookie-banner', 'class=alert', 'class=gdpr-consent', 'class=notice'])}><p>{prose(5, 30)}</p><button>{prose(1, 2, '')}</button></div>",
            "comments": f"<{(t := draw.choice(['section class=comments', 'div id=comments', 'div class=comment-list', 'div id=disqus_thread']))}><h3>{prose(1, 3, '')}</h3>"
                        + "".join(f"<div class=comment><p>{prose(4, 40)}</p></div>" for _ in range(n)) + f"</{t.split()[0]}>",
            "form": f"<form class='{draw.choice(['', 'newsletter', 'login', 'search'])}'><label>{prose(1, 6, '')}</label><input name=q><button>{prose(1, 2, '')}</button></form>",
            "share": f"<div class='{draw.choice(['share', 'social-links', 'related', 'tags', 'recommended'])}'><h4>{prose(1, 3, '')}</h4><ul>{links(n)}</ul></div>",
        }[kind]

    def main_block() -> str:
        kind = draw.random()
        if kind < 0.72:
            return f"<p>{prose(6, 90)}</p>"
        if kind < 0.82:
            return f"<h2>{prose(2, 7, '')}</h2>"
        if kind < 0.9:
            return "<ul>" + "".join(f"<li>{prose(4, 20)}</li>" for _ in range(3)) + "</ul>"
        return draw.choice([f"<blockquote>{prose(8, 40)}</blockquote>", f"<p><b>{prose(3, 30)}<br></p>", f"<table><tr><td>{prose(2, 8)}</td><td>{prose(2, 8)}</td></tr></table>",
                            f"<p>{prose(3, 20)} <a href='/x'>{prose(1, 3, '')}</a> {prose(5, 30)}</p>", f"<pre>{prose(4, 20)}</pre>"])

    for _ in range(count):
        pieces: list[tuple[bool, str]] = [(False, chrome(k)) for k in draw.sample(["notice", "header", "nav", "ad", "form"], draw.randint(1, 4))]
        box = draw.choice(["article", "article", "main", "div class=content", "div id=main-content", "div class=post-body", "div class=entry", "section class=story", "div"])
        inside = [(True, f"<h1>{prose(2, 12, '')}</h1>")] + [(True, main_block()) for _ in range(draw.randint(1, 12))]
        for k in draw.sample(["ad", "share", "comments", "side", "form", "notice"], draw.choice([0, 0, 1, 2])):
            inside.insert(len(inside) if k in ("comments", "share") else draw.randint(1, len(inside)), (False, chrome(k)))
        after = [(False, chrome(k)) for k in draw.sample(["comments", "side", "share", "ad", "form", "footer"], draw.randint(1, 5))]
        if draw.random() < 0.12:  # a bare text
            pieces, after, inside = [], [], [(True, main_block()) for _ in range(draw.randint(1, 4))]
            box = draw.choice(["div", "section", "article"])
        found, labels = [], []
        start, end = "<html><body>", "</body></html>"
        for wanted, piece, boxed in [(w, p, False) for w, p in pieces] + [(w, p, True) for w, p in inside] + [(w, p, False) for w, p in after]:
            got = blocks(f"{start}<{box}>{piece}</{box.split()[0]}>{end}" if boxed else f"{start}{piece}{end}")
            found += got
            labels += [int(wanted)] * len(got)
        out.append((features(found, known), np.array(labels, int)))
    return out


def sample(pages: DataFrame, n: int) -> DataFrame:
    """(page_id, html) of about SAMPLE of n pages, and of 2 * SAMPLE at most, also where many share an id."""
    chosen = pages.where(F.col("html").isNotNull() & row_share("page_id", "html", min(1.0, SAMPLE / max(n, 1)))).select("page_id", "html")
    return chosen.orderBy(F.xxhash64("page_id", "html")).limit(2 * SAMPLE)


def learn(pages: DataFrame) -> Field:
    """The field, from about SAMPLE of the pages (page_id, html), chosen by hash, and from laid-out pages."""
    n = pages.count()
    seen = sample(pages, n).collect()
    known, given, texts = _Paths(), [], []
    for row in sorted(seen, key=lambda r: (r["page_id"] is not None, 0 if r["page_id"] is None else r["page_id"], r["html"])):
        found = blocks(row["html"])
        labels = given_labels(found) if found else None
        if labels is not None:
            given.append((features(found, known), labels.astype(int)))
            texts.append(" ".join(t for (_, t, _), wanted in zip(found, labels) if wanted)[:2000])
    return train(given + laid_out(texts, LAID_OUT))


def main_text(page: Column, field: Field) -> Column:
    """The text of the blocks labelled main, joined by a space."""

    def make():
        known = _Paths()

        def one(page):
            found = blocks(page)
            if not found:
                return ""
            return " ".join(text for (_, text, _), wanted in zip(found, field.labels(features(found, known))) if wanted)

        return lambda pages: pa.array([one(p) for p in pages], pa.string())

    return over_texts(make, "string")(page)

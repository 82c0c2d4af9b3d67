"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

1.  A page is cut into leaf blocks, the longest runs of text that no block-level tag parts.
    Scripts, styles, comments and the head are markup and give no block; a form's fields give none either.
2.  Each block gets binary features: tags of its ancestors and what their class, id and role
    attributes say, length, share of linked text, punctuation, place in the page, and likeness to its
    neighbours.
3.  A chain of two states, main and other, scores features by state and the step from block to
    block.  It is trained by its exact likelihood (forward and backward sums, full gradients) on
    ``PAGES`` labelled pages of many layouts that this module writes, with invented words, so that it can
    learn structure and shape but no vocabulary; most of them lack some of the hints (no ``article``, no
    class names, unclosed tags).  Training takes seconds, once in the driver; tasks get the weights.
4.  The best sequence of states is found by Viterbi; the blocks of the main state are the text.

Character references are decoded, white space in a block (a ``br`` too) becomes one space, blocks
without text vanish, the others are joined by an empty line.  Whole pages are read, whatever their
length; work is linear in it.  Null and empty pages, and pages without main blocks, have an empty text.
A page cut off in the middle of a tag ends before it; one cut off elsewhere is read to its end.
Repeated rows are rows of their own; null ids and addresses stay; other columns are not read; an
empty table gives an empty one.
"""

from __future__ import annotations

import functools
import html
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled pages that the chain is trained on.
PAGES = 600

SKIPPED = frozenset("script style noscript template svg math head select textarea iframe object canvas audio video map".split())
RAW = frozenset("script style textarea iframe noscript".split())
BLOCKS = frozenset(
    "html body address article aside blockquote button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup "
    "hr legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Blocks that end an open one of these kinds directly around them.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"), "option": ("option",)}

_ATTRIBUTES = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
TOKEN = re.compile(rf"<(?:!--.*?(?:-->|\Z)|(/?)([a-zA-Z][^\s/>]*+)({_ATTRIBUTES})>|[!?/][^>]*+>)", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")

#: What class, id and role attributes say; each is one feature.
NAMED = {
    "body": r"content|article|post|entry|story|main|text",
    "comment": r"comment|disqus|repl(?:y|ies)|respond|discussion|thread",
    "advert": r"(?<![a-z])ads?(?![a-z])|advert|sponsor|promo|banner|affiliate",
    "menu": r"nav|menu|breadcrumb|pag(?:ination|er)|tabs|toc",
    "side": r"side|rail|widget|related|recommend|popular|trending|complementary|more-",
    "foot": r"foot|copyright|legal|contentinfo",
    "head": r"head|masthead|topbar|logo|brand",
    "notice": r"cookie|consent|notice|gdpr|modal|popup|overlay|newsletter|subscri|signup|alert|dialog|paywall",
    "share": r"share|social|byline|meta|tags|author|date",
    "form": r"form|search|login|input",
}
NAMED = {k: re.compile(v) for k, v in NAMED.items()}
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
TAGS = "article main section nav header footer aside form table ul ol li dl blockquote pre figure figcaption details button dialog menu td th p h1 h2 h3 h4 h5 h6 div".split()

FEATURES = [
    "always",
    *(f"in {t}" for t in TAGS),
    *(f"inside of {n}" for n in NAMED),
    "hidden",
    *(f"parent {t}" for t in TAGS),
    *(f"words {n}" for n in range(7)),
    *(f"links {n}" for n in range(4)),
    *("sentence end", "no mark", "comma", "sentences", "copyright", "capitals", "digits", "page title", "bars"),
    *(f"place {n}" for n in range(6)),
    *("like before", "like after", "only", "page has article", "page has main", "page has paragraphs", "bare in body", "under heading", "paragraph near"),
]
NUMBER = {f: k for k, f in enumerate(FEATURES)}


@functools.lru_cache(1 << 16)
def _said(attributes: str) -> int:
    """Features, as bits, of a tag's attributes."""
    bits = 0
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id", "role", "aria-label"):
            for k, pattern in NAMED.items():
                if pattern.search(value):
                    bits |= 1 << NUMBER[f"inside of {k}"]
        elif name == "hidden" or (name == "style" and HIDDEN.search(value)) or (name == "aria-hidden" and value == "true"):
            bits |= 1 << NUMBER["hidden"]
    return bits


_IN = {t: 1 << NUMBER[f"in {t}"] for t in TAGS}
_PARENT = {t: 1 << NUMBER[f"parent {t}"] for t in TAGS}


class Block:
    """A leaf block: its text, letters inside of links, and ancestors' features."""

    __slots__ = ("text", "linked", "bits", "parent")

    def __init__(self, text: str, linked: int, bits: int, parent: str):
        self.text, self.linked, self.bits, self.parent = text, linked, bits, parent


def leaf_blocks(page: str) -> tuple[list[Block], str]:
    """Leaf blocks in the page's order, and the page's title; one pass over its tags."""
    out: list[Block] = []
    title = ""
    stack: list[tuple[str, int]] = [("", 0)]  # open blocks with their features and those of all around them
    opened: Counter = Counter()
    parts: list[str] = []
    linked, link_depth, skipping, at = 0, 0, "", 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, linked, stack[-1][1], stack[-1][0]))
            parts.clear()
        linked = 0

    def close() -> None:
        nonlocal link_depth
        opened[stack.pop()[0]] -= 1
        if link_depth > len(stack):
            link_depth = 0

    def say(raw: str) -> None:
        nonlocal linked
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if link_depth:
            linked += len(text) - text.count(" ")

    while True:
        cut = page.find("<", at)
        if cut < 0:
            if not skipping:
                say(page[at:])
            break
        if cut > at and not skipping:
            say(page[at:cut])
        token = TOKEN.match(page, cut)
        if token is None:
            after = page[cut + 1 : cut + 2]
            if after.isalpha() or after in ("/", "!", "?"):
                if ">" not in page[cut:]:
                    break  # the page is cut off in a tag
                at = page.index(">", cut) + 1  # a tag with a stray quote
                continue
            if not skipping:
                say("<")
            at = cut + 1
            continue
        at = token.end()
        name = (token[2] or "").lower()
        if not name:
            continue
        ends = token[1] == "/"
        if skipping:
            if ends and name == skipping:
                skipping = ""
            elif skipping == "head" and name in ("body", "article", "main", "div", "p") and not ends:
                skipping = ""
            elif skipping == "head" and name == "title" and not ends:
                stop = page.find("</", at)
                title = " ".join(html.unescape(page[at : stop if stop >= 0 else len(page)]).split())
                continue
            else:
                if name in RAW and not ends:
                    at = _behind(page, name, at)
                continue
            if ends:
                continue
        if name in SKIPPED:
            if ends:
                continue
            if name in RAW:
                at = _behind(page, name, at)
            elif not token[3].rstrip().endswith("/"):
                skipping = name
        elif name == "br":
            parts.append(" ")
        elif name == "a":
            link_depth = 0 if ends else len(stack)
        elif name in BLOCKS:
            flush()
            if ends:
                if opened[name]:
                    while stack[-1][0] != name:
                        close()
                    close()
                continue
            if stack[-1][0] == "p":
                close()
            while stack[-1][0] in ENDS.get(name, ()):
                close()
            if name != "hr":
                stack.append((name, stack[-1][1] | _IN.get(name, 0) | (_said(token[3]) if token[3] else 0)))
                opened[name] += 1
    flush()
    return out, title


def _behind(page: str, name: str, at: int) -> int:
    """Behind the end tag of a raw element, whose content holds no tags."""
    end = re.compile(rf"</{name}[^>]*>", re.I).search(page, at)
    return end.end() if end else len(page)


def features(page: str) -> tuple[list[str], list[list[int]]]:
    """Texts of a page's leaf blocks and the numbers of each one's features."""
    blocks, title = leaf_blocks(page)
    n, around = len(blocks), 0
    for b in blocks:
        around |= b.bits
    has = [NUMBER[f"page has {t}"] for t in ("article", "main") if around & _IN[t]]
    if sum(b.parent == "p" for b in blocks) >= 3:
        has.append(NUMBER["page has paragraphs"])
    out = []
    for k, b in enumerate(blocks):
        text, words = b.text, b.text.count(" ") + 1
        own = ["always", f"words {sum(words > w for w in (1, 3, 6, 12, 25, 60))}"]
        share = b.linked / max(1, len(text) - words + 1)
        own.append(f"links {(share > 0) + (share > 0.3) + (share > 0.8)}")
        own.append("sentence end" if text[-1] in ".!?…:;\"'”»)" else "no mark")
        if "," in text:
            own.append("comma")
        if text.count(". ") + text.count("! ") + text.count("? ") >= 2:
            own.append("sentences")
        if "©" in text or "(c)" in text:
            own.append("copyright")
        letters = sum(map(str.isalpha, text[:400])) or 1
        if sum(map(str.isupper, text[:400])) > 0.5 * letters:
            own.append("capitals")
        if sum(map(str.isdigit, text[:400])) > 0.3 * min(400, len(text)):
            own.append("digits")
        if title and len(text) > 3 and (title.startswith(text) or text.startswith(title)):
            own.append("page title")
        if "|" in text or "»" in text:
            own.append("bars")
        own.append(f"place {min(2, k) if k < 3 else 5 - min(2, n - 1 - k) if n - 1 - k < 2 else 3}")
        before, after = (blocks[j] if 0 <= j < n else None for j in (k - 1, k + 1))
        alike = lambda o: o is not None and o.parent == b.parent and o.bits == b.bits  # noqa: E731, B023
        own += [f for f, x in (("like before", alike(before)), ("like after", alike(after)), ("only", n == 1), ("bare in body", b.parent in ("", "body", "html")), ("under heading", before is not None and before.parent[:1] == "h" and before.parent[1:].isdigit())) if x]
        if any(o is not None and o.parent == "p" and o.text.count(" ") > 11 for o in (before, after)):
            own.append("paragraph near")
        if b.parent in _PARENT:
            own.append(f"parent {b.parent}")
        numbers = [NUMBER[f] for f in own] + has
        bits = b.bits
        while bits:
            low = bits & -bits
            numbers.append(low.bit_length() - 1)
            bits ^= low
        out.append(numbers)
    return [b.text for b in blocks], out


class Chain:
    """Weights of a chain of two states (0 other, 1 main): by feature and state, by step, and of the first state."""

    def __init__(self, emission: np.ndarray, step: np.ndarray, first: np.ndarray):
        self.emission, self.step, self.first = emission, step, first

    def states(self, numbers: list[list[int]]) -> list[int]:
        """The best sequence of states, by Viterbi."""
        if not numbers:
            return []
        flat = np.concatenate(numbers)
        starts = np.cumsum([0, *map(len, numbers[:-1])])
        score = np.add.reduceat(self.emission[flat], starts).tolist()
        (s00, s01), (s10, s11) = self.step.tolist()
        a, b = (f + e for f, e in zip(self.first.tolist(), score[0], strict=True))
        back = []
        for e0, e1 in score[1:]:
            back.append((b + s10 > a + s00, b + s11 > a + s01))
            a, b = max(a + s00, b + s10) + e0, max(a + s01, b + s11) + e1
        out = [int(b > a)]
        for step in reversed(back):
            out.append(int(step[out[-1]]))
        return out[::-1]


def train(pages: list[tuple[list[list[int]], list[int]]], rounds: int = 150, rate: float = 0.2, decay: float = 1e-3) -> Chain:
    """The chain of the highest penalised likelihood of labelled pages (features and states of their blocks).

    All pages go forward and backward together, block by block, the longest first, so that those
    still in play are the first ones; steps are Adam's.
    """
    pages = sorted(pages, key=lambda p: -len(p[1]))
    size, n = np.array([len(y) for _, y in pages]), len(pages)
    longest, ends = int(size[0]), np.cumsum(size)
    x = np.zeros((int(ends[-1]), len(FEATURES)), np.float32)
    x[np.repeat(np.arange(len(x)), [len(f) for p, _ in pages for f in p]), np.concatenate([f for p, _ in pages for f in p])] = 1
    y = np.concatenate([states for _, states in pages])
    at = [(ends - size)[: int((size > k).sum())] + k for k in range(longest)]  # rows of the k-th blocks
    steps = np.zeros((2, 2))
    inner = np.setdiff1d(np.arange(len(y)), ends - 1)
    np.add.at(steps, (y[inner], y[inner + 1]), 1)
    observed = np.concatenate([(x.T @ np.eye(2, dtype=np.float32)[y]).ravel(), steps.ravel(), np.bincount(y[at[0]], minlength=2)])
    cut = 2 * len(FEATURES)
    w, m, v = np.zeros(cut + 6), np.zeros(cut + 6), np.zeros(cut + 6)
    for turn in range(1, rounds + 1):
        step = w[cut : cut + 4].reshape(2, 2)
        score = (x @ w[:cut].reshape(-1, 2).astype(np.float32)).astype(np.float64)
        fore, back = np.empty_like(score), np.zeros_like(score)
        fore[at[0]] = w[cut + 4 :] + score[at[0]]
        for k in range(1, longest):
            before = fore[at[k - 1][: len(at[k])]]
            fore[at[k]] = np.logaddexp(before[:, :1] + step[0], before[:, 1:] + step[1]) + score[at[k]]
        for k in range(longest - 2, -1, -1):
            after = score[at[k + 1]] + back[at[k + 1]]
            back[at[k][: len(after)]] = np.logaddexp(after[:, :1] + step[:, 0], after[:, 1:] + step[:, 1])
        whole = np.repeat(np.logaddexp(*fore[ends - 1].T), size)[:, None]
        state = np.exp(fore + back - whole)
        after = (score + back - whole)[inner + 1]
        pair = np.exp(fore[inner][:, :, None] + step + after[:, None, :]).sum(0)
        expected = np.concatenate([(x.T @ state.astype(np.float32)).ravel(), pair.ravel(), state[at[0]].sum(0)])
        gradient = (observed - expected) / n - decay * w
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        w = w + rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
    return Chain(w[:cut].reshape(-1, 2), w[cut : cut + 4].reshape(2, 2), w[cut + 4 :])


class _Writer:
    """Writes a labelled page: M marks the beginning of a main block's text, O of any other's."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.syllables = ["".join(self.r.choices("bcdfghklmnprstvw", k=1) + self.r.choices("aeiouéü", k=1) + self.r.choices("nrstl ", k=1)).strip() for _ in range(40)]
        self.named = self.r.random() < 0.6
        self.semantic = self.r.random() < 0.6

    def word(self) -> str:
        return "".join(self.r.choices(self.syllables, k=self.r.randint(1, 4)))

    def words(self, a: int, b: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(a, b)))

    def sentence(self) -> str:
        return (self.words(3, 9) + self.r.choice(["", ", " + self.words(2, 9)])).capitalize() + self.r.choice("....!?")

    def prose(self, most: int) -> str:
        kind = self.r.random()
        if kind < 0.08:
            return self.r.choice([self.words(1, 3).capitalize() + self.r.choice([".", ""]), " | ".join(self.words(1, 2) for _ in range(self.r.randint(3, 20))), self.words(4, 20).upper() + "!!!", self.sentence() + " $$$ " + self.words(2, 9) + " ### &amp;&amp;"])
        return " ".join(self.sentence() for _ in range(self.r.randint(1, most)))

    def attributes(self, *names: str) -> str:
        return f' {self.r.choice(["class", "class", "id"])}="{self.r.choice(names)}"' if self.named else self.r.choice(["", "", ' class="' + self.word() + '"'])

    def tag(self, name: str, *names: str) -> tuple[str, str]:
        """Start and end of a part: its own element, or a div, with a telling name, or without."""
        name = name if self.semantic and name else "div"
        return f"<{name}{self.attributes(*names)}>", f"</{name}>"

    def links(self, n: int) -> str:
        style = self.r.random()
        link = lambda: f'<a href="/{self.word()}">{{O}}{self.words(1, 3)}</a>'
        if style < 0.6:
            return "<ul>" + "".join(f"<li>{link()}" + self.r.choice(["</li>", "</li>", ""]) for _ in range(n)) + "</ul>"
        if style < 0.8:
            return "".join(f"<div>{link()}</div>" for _ in range(n))
        return "{O}" + self.r.choice([" | ", " &middot; ", " "]).join(f'<a href="/{self.word()}">{self.words(1, 2)}</a>' for _ in range(n))

    def wrapped(self, pair: tuple[str, str], inner: str) -> str:
        return pair[0] + inner + pair[1]

    def chrome_before(self) -> str:
        r, out = self.r, []
        if r.random() < 0.5:
            inner = r.choice(["{O}" + self.words(1, 3), f'<a href="/">{{O}}{self.words(1, 2)}</a>', f"<h1>{{O}}{self.words(1, 3)}</h1>"]) + r.choice(["", f"<p>{{O}}{self.words(2, 8)}</p>"])
            out.append(self.wrapped(self.tag("header", "header", "site-header", "masthead", "topbar"), inner))
        if r.random() < 0.85:
            out.append(self.wrapped(self.tag("nav", "nav", "menu", "navbar", "main-menu"), self.links(r.randint(3, 9))))
        if r.random() < 0.25:
            out.append(self.wrapped(self.tag("", "breadcrumbs", "breadcrumb"), self.links(r.randint(2, 4))))
        if r.random() < 0.25:
            out.append(self.notice())
        if r.random() < 0.6:
            out.append(self.advert())
        r.shuffle(out)
        return "".join(out)

    def advert(self) -> str:
        p = ('<div class="' + self.r.choice(["ad", "ads", "advert", "sponsored", "banner", "promo-box"]) + '">', "</div>") if self.r.random() < 0.75 else self.tag("aside", "ad", "sponsor")
        return self.wrapped(p, self.r.choice(["{O}", "<p>{O}"]) + self.r.choice([self.prose(4), self.words(2, 8)]) + self.r.choice(["", f'<a href="/{self.word()}">{self.words(1, 3)}</a>']))

    def notice(self) -> str:
        p = self.tag("dialog", "cookie-notice", "consent", "newsletter", "modal", "alert")
        if not self.named and not self.semantic:
            p = ('<div class="cookie-bar">', "</div>")
        return self.wrapped(p, f"<p>{{O}}{self.prose(3)}</p>" + self.r.choice(["", f"<button>{{O}}{self.words(1, 2)}</button>", f'<form><label>{{O}}{self.words(1, 3)}</label><input><button>{{O}}{self.word()}</button></form>']))

    def sidebar(self) -> str:
        inner = "".join(f"<h3>{{O}}{self.words(1, 3)}</h3>" + self.r.choice([self.links(self.r.randint(3, 6)), f"<p>{{O}}{self.prose(2)}</p>"]) for _ in range(self.r.randint(1, 3)))
        p = self.tag("aside", "sidebar", "widget", "related", "rail")
        if not self.named and not self.semantic:
            p = ("<aside>", "</aside>")
        return self.wrapped(p, inner)

    def comments(self) -> str:
        one = lambda: self.r.choice(["", f"<b>{{O}}{self.word()}</b>", f"<div>{{O}}{self.word()} {self.r.randint(1, 30)}</div>"]) + f"<p>{{O}}{self.prose(4)}</p>"
        kind = self.r.choice(["li", "div", "article"])
        names = self.r.choice(["comments", "comment-list", "disqus_thread", "replies", "responses-thread"])
        head = self.r.choice(["", f"<h2>{{O}}{self.r.randint(1, 90)} {self.word()}</h2>", f"<h3>{{O}}{self.words(1, 2)}</h3>"])
        inner = "".join(f'<{kind} class="comment">{one()}</{kind}>' for _ in range(self.r.randint(1, 6)))
        form = self.r.choice(["", f"<form>{{O}}{self.words(2, 6)}<textarea>{self.words(1, 9)}</textarea><button>{{O}}{self.word()}</button></form>"])
        outer = self.r.choice(["section", "div"])
        return f'<{outer} id="{names}">{head}' + (f"<ol>{inner}</ol>" if kind == "li" else inner) + form + f"</{outer}>"

    def article(self, title: str) -> str:
        r, out = self.r, []
        heading = r.random()
        if heading < 0.75:
            h = f"<h1>{{M}}{title}</h1>"
            out.append(f"<header>{h}</header>" if self.semantic and r.random() < 0.25 else h)
        if r.random() < 0.15:
            out.append(f'<div class="{r.choice(["share", "social-links", "share-bar"])}">{self.links(r.randint(2, 4))}</div>')
        style, closed = r.random(), r.random() < 0.8
        for k in range(r.choice([1, 2, 3, 5, 8, 12, 20])):
            kind = r.random()
            bold, br = r.choice([("", "")] * 6 + [("<b>", "</b>"), ("<b>", ""), ("<em>", "</em>")]), r.choice([""] * 8 + ["<br>" + self.sentence(), "<br>"])
            linked = r.choice([""] * 5 + [f' <a href="/{self.word()}">{self.words(1, 4)}</a> {self.words(2, 9)}.'])
            body = "{M}" + bold[0] + self.prose(9) + bold[1] + linked + br
            if kind < 0.06:
                out.append(f"<h2>{{M}}{self.words(1, 6)}</h2>")
            elif kind < 0.12:
                t = r.choice(["ul", "ol"])
                out.append(f"<{t}>" + "".join(f"<li>{{M}}{self.prose(2)}</li>" for _ in range(r.randint(2, 6))) + f"</{t}>")
            elif kind < 0.15:
                out.append(f"<blockquote>{r.choice(['', '<p>'])}{{M}}{self.prose(4)}</blockquote>")
            elif kind < 0.17:
                out.append("<table>" + "".join("<tr>" + "".join(f"<td>{{M}}{self.words(1, 3)}</td>" for _ in range(3)) + "</tr>" for _ in range(r.randint(2, 4))) + "</table>")
            elif kind < 0.19:
                out.append(f"<pre>{{M}}{self.words(5, 30)}</pre>")
            elif kind < 0.21:
                out.append(f"<figure><img src='x.png'><figcaption>{{M}}{self.prose(2)}</figcaption></figure>")
            elif kind < 0.25:
                out.append(self.advert() if r.random() < 0.7 else f'<div class="related">{self.links(r.randint(2, 4))}</div>')
            elif style < 0.12:
                out.append(f"<div>{body}</div>")
            else:
                out.append(f"<p>{body}" + ("</p>" if closed and bold[1] == bold[0].replace("<", "</") else ""))
        return "".join(out)

    def page(self) -> str:
        r = self.r
        title = self.prose(2)[:60]
        main = self.article(title)
        if r.random() < 0.03:
            return main if r.random() < 0.5 else "{M}" + self.prose(20)
        main = self.wrapped(r.choice([("<article>", "</article>")] * 3 + [("<main>", "</main>"), ("<main><article>", "</article></main>")]) if self.semantic else (f"<div{self.attributes('content', 'article-body', 'post', 'entry-content', 'story')}>", "</div>"), main)
        if r.random() < 0.15:
            main = f"<section>{main}</section>"
        parts = [main]
        if r.random() < 0.3:
            parts.append(self.comments())
        if r.random() < 0.35:
            parts.insert(r.choice([0, len(parts)]), self.sidebar())
        foot = r.choice(["&copy; ", "Copyright ", ""]) + f"{self.word()}.example.com &middot; " + r.choice([self.prose(3), self.words(2, 6)])
        foot = self.wrapped(self.tag("footer", "footer", "site-footer", "legal"), r.choice(["{O}" + foot, f"<p>{{O}}{foot}</p>", f"{self.links(4)}<p>{{O}}{foot}</p>"]))
        if not self.semantic and not self.named and r.random() < 0.5:
            foot = ""
        head = f'<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>{title}</title><style>p{{margin:0}}</style><script>var t="</p>";track({r.randint(0, 9)});</script></head><body>'
        cut = r.random() < 0.1
        return head + self.chrome_before() + "<!-- x -->" + "".join(parts) + foot + ("" if cut else "</body></html>")


#: Stand before the text of a block while a labelled page is written.
MAIN_MARK, OTHER_MARK = "\ue000", "\ue001"


def labelled_pages(n: int = PAGES, seed: int = 7) -> list[tuple[str, list[int]]]:
    """Pages and the states of their leaf blocks."""
    out = []
    for k in range(n):
        page = _Writer(seed * 1_000_003 + k).page().replace("{M}", MAIN_MARK).replace("{O}", OTHER_MARK)
        states = [int(MAIN_MARK in b.text) for b in leaf_blocks(page)[0]]
        plain = page.replace(MAIN_MARK, "").replace(OTHER_MARK, "")
        if len(leaf_blocks(plain)[0]) == len(states) and states:
            out.append((plain, states))
    return out


@functools.lru_cache(4)
def trained(n: int = PAGES, seed: int = 7) -> Chain:
    """The chain trained on labelled pages, once for a process."""
    return train([(features(page)[1], states) for page, states in labelled_pages(n, seed)])


def main_text(page: str, chain: Chain) -> str:
    texts, numbers = features(page)
    return "\n\n".join(t for t, s in zip(texts, chain.states(numbers), strict=True) if s)


def extract(pages: DataFrame, chain: Chain | None = None) -> DataFrame:
    """page_id, url, text and n_chars (its code points) for each row of (page_id, url, html)."""
    chain = trained() if chain is None else chain

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), chain) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars long")

"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: the text between block-level tags, with the tags, classes and ids above it. Each block becomes a
vector of hashed path tokens, hashed words and a few numbers (length, links, punctuation, place, how much of the page's text has
the same path, a copyright mark); a bidirectional LSTM (numpy) reads all blocks of a page in both directions and labels each with the whole page as
context. Blocks labelled as article are joined in page order.

The labeller is trained here, on at most ``SAMPLE`` pages: of each template (set of tags and classes, found over all pages) those
with the smallest hash, all templates in turn. No page is marked by hand. The sample gives articles (what stands inside an
article-like element and in none that is named as menu, header, footer, sidebar, notice, advert, form or comments) and menus;
from these, and from short stock phrases, ``PAGES`` training pages are laid out anew: articles in named, neutral, randomly named or no
elements, in tables, with other parts before, inside and after them, under telling names or not. So place, path, words and what
stands around are learned together, and not one template.

Null and empty pages give an empty text; markup never gets into the text: comments, scripts and tags that are not closed go to
where HTML ends them, an attribute whose quote is not closed ends with its tag; tags that are not closed end with their parent;
unknown references stay as they are. Reading takes time in proportion to the page, whatever is in it. A row without an id is read
like any other; repeated rows give a row each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tractworks.llm.common import lean, read

PATH_DIM, WORD_DIM, NUMBERS = 256, 64, 10
DIM = PATH_DIM + WORD_DIM + NUMBERS
HIDDEN = 20
#: Bounds of the fit: pages in the sample, pages laid out from it, and training.
SAMPLE, PAGES, STEPS, BATCH = 160, 1600, 520, 16
CELLS = 4096

INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose content is no text of the page.
HIDDEN_TEXT = frozenset("script style template noscript title svg math iframe textarea object".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ARTICLE_TAGS = ("article", "main")
ARTICLE_NAMES = ("article", "content", "post", "entry", "story", "main", "text", "body")
OTHER_TAGS = ("nav", "header", "footer", "aside", "form", "menu", "dialog", "head", "button", "select")
OTHER_NAMES = (
    "ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner", "nav", "navigation", "menu", "breadcrumb", "sidebar", "footer", "header", "cookie", "notice",
    "consent", "alert", "popup", "modal", "newsletter", "subscribe", "signup", "login", "form", "search", "comment", "comments", "reply", "replies", "share", "social", "related", "widget",
)
_ARTICLE = frozenset([f"t:{t}" for t in ARTICLE_TAGS] + [f"c:{n}" for n in ARTICLE_NAMES])
_OTHER = frozenset([f"t:{t}" for t in OTHER_TAGS] + [f"c:{n}" for n in OTHER_NAMES])
_NAME = re.compile(r"</?([a-zA-Z][\w:-]*)")
_PLAIN_TAG = re.compile(r"""(?:[^<>"']|"[^"<>]*"|'[^'<>]*')*+>""")
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_AFTER = frozenset(["", " ", "\t", "\n", "\r", "\f", "/", ">"])
_MARKUP = re.compile(r"<[/!a-zA-Z]")
_PART = re.compile(r"[a-z]+")
_RIGHTS = re.compile(r"©|\(c\)|copyright", re.I)


class Block:
    """A leaf block: its decoded text, how many of its characters are links, the bits of its path, its tag, and what its path names."""

    __slots__ = ("inside", "linked", "mask", "other", "tag", "text")

    def __init__(self, text: str, linked: int, mask: int, tag: str, inside: bool, other: bool):
        self.text, self.linked, self.mask, self.tag, self.inside, self.other = text, linked, mask, tag, inside, other


def bit(token: str) -> int:
    return 1 << zlib.crc32(token.encode()) % PATH_DIM


class Scanner:
    """Finds where tags, comments and hidden elements end; no stretch of the page is searched more than a few times."""

    def __init__(self, page: str):
        self.page = page
        self.ahead: dict[str, int] = {}
        self.asked_at: dict[str, int] = {}

    def find(self, what: str, at: int) -> int:
        """``str.find`` that remembers its last answer."""
        known = self.ahead.get(what, -2)
        if self.asked_at.get(what, 0) <= at and (known == -1 or known >= at):
            return known
        found = self.page.find(what, at)
        self.ahead[what], self.asked_at[what] = found, at
        return found

    def tag_end(self, at: int) -> int:
        """The place after a tag that begins at ``at``; the page's end if it never ends."""
        m = _PLAIN_TAG.match(self.page, at + 1)
        if m:
            return m.end()
        page, i = self.page, at + 1
        end = self.find(">", i)
        while end >= 0:
            quotes = [q for q in (self.find('"', i), self.find("'", i)) if 0 <= q < end]
            if not quotes:
                return end + 1
            q = min(quotes)
            close = self.find(page[q], q + 1)
            # a quote that swallows markup and ends where another begins was not closed
            if close < 0 or ((page[close - 1] == "=" or page[close + 1 : close + 2] not in _AFTER) and _MARKUP.search(page, q, close)):
                return self.find(">", q) + 1
            i = close + 1
            end = self.find(">", i)
        return len(page)

    def hidden_end(self, name: str, at: int) -> int:
        """The place after the end tag of a hidden element; without one, the page's end (a title's: the next tag)."""
        end = f"</{name}"
        i = self.find_lower(end, at)
        if i < 0:
            return len(self.page) if name != "title" else max(self.find("<", at), at)
        close = self.find(">", i)
        return close + 1 if close >= 0 else len(self.page)

    def find_lower(self, what: str, at: int) -> int:
        if not hasattr(self, "lower"):
            self.lower = Scanner(self.page.lower() if len(self.page.lower()) == len(self.page) else re.sub("[A-Z]+", lambda m: m[0].lower(), self.page))
        return self.lower.find(what, at)


def blocks_of(page: str | None) -> list[Block]:
    """Leaf blocks of a page in order; text is decoded and has single spaces."""
    page = page or ""
    scan = Scanner(page)
    out: list[Block] = []
    stack: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]
    open_tags: Counter = Counter()
    text: list[str] = []
    linked = links = at = 0

    def flush() -> None:
        nonlocal linked
        if text:
            joined = " ".join(html.unescape("".join(text)).split())
            if joined:
                tag, mask, inside, other = stack[-1]
                out.append(Block(joined, linked, mask, tag, inside, other))
            text.clear()
        linked = 0

    def pop() -> None:
        open_tags[stack.pop()[0]] -= 1

    while True:
        start = page.find("<", at)
        stop = len(page) if start < 0 else start
        if stop > at:
            text.append(page[at:stop])
            linked += (stop - at) * (links > 0)
        if start < 0:
            break
        if page.startswith("<!--", start):
            end = scan.find("-->", start + 4)
            at = len(page) if end < 0 else end + 3
            continue
        m = _NAME.match(page, start)
        if m is None:
            if page[start + 1 : start + 2] in ("!", "?", "/"):
                end = scan.find(">", start)
                at = len(page) if end < 0 else end + 1
            else:  # no tag
                text.append("<")
                linked += links > 0
                at = start + 1
            continue
        end = scan.tag_end(start)
        tag, closing = m[1].lower(), page[start + 1] == "/"
        at = end
        if tag in HIDDEN_TEXT:
            if not closing and not page.endswith("/>", start, end):
                at = scan.hidden_end(tag, end)
            continue
        if tag in INLINE:
            if tag == "br":
                text.append(" ")
            elif tag == "a":
                links = 0 if closing else 1
            continue
        flush()
        links = 0
        if closing:
            if open_tags[tag] > 0:
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        while stack[-1][0] == "p" or stack[-1][0] in CLOSES.get(tag, ()):
            pop()
        if tag not in VOID and not page.endswith("/>", start, end):
            names = [f"t:{tag}"]
            for n in _NAMED.findall(page, m.end(), end):
                names += [f"c:{w}" for w in _PART.findall("".join(n).lower())]
            _, mask, inside, other = stack[-1]
            for n in names:
                mask |= bit(n)
            stack.append((tag, mask, inside or not _ARTICLE.isdisjoint(names), other or not _OTHER.isdisjoint(names)))
            open_tags[tag] += 1
    flush()
    return out


def marked(blocks: list[Block]) -> list[int]:
    """1 for blocks that stand inside an article-like element and no other kind, else 0; all but the other kinds where there is no such element."""
    named = any(b.inside and not b.other for b in blocks)
    return [int(not b.other and (b.inside or not named)) for b in blocks]


def vectors(blocks: list[Block]) -> np.ndarray:
    """One row of DIM numbers per block."""
    n = len(blocks)
    x = np.zeros((n, DIM), np.float32)
    if not n:
        return x
    bits = np.frombuffer(b"".join(b.mask.to_bytes(PATH_DIM // 8, "little") for b in blocks), np.uint8)
    x[:, :PATH_DIM] = np.unpackbits(bits, bitorder="little").reshape(n, PATH_DIM)
    counts = []
    mass: Counter = Counter()
    for i, b in enumerate(blocks):
        words = b.text.encode().lower().split()
        k = len(words)
        counts.append(k)
        mass[b.mask] += k
        at = np.fromiter(map(zlib.crc32, words), np.uint32, k) % WORD_DIM
        x[i, PATH_DIM : PATH_DIM + WORD_DIM] = np.bincount(at, minlength=WORD_DIM) / k
    total = sum(counts)
    last = PATH_DIM + WORD_DIM
    for i, (b, k) in enumerate(zip(blocks, counts, strict=True)):
        size = len(b.text)
        ends = b.text.count(".") + b.text.count("!") + b.text.count("?")
        x[i, last:] = (np.log1p(k) / 5, min(b.linked / size, 1), 10 * (ends + b.text.count(",")) / size, b.tag in HEADINGS, i / n, 1 / n, mass[b.mask] / total, min(ends, 4) / 4, k > 12, _RIGHTS.search(b.text) is not None)
    return x


class Labeller:
    """A bidirectional LSTM with one logistic output for each place."""

    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        g = 4 * HIDDEN
        self.p = {}
        for d in "fb":
            self.p["w" + d] = (r.standard_normal((DIM, g)) * 0.1).astype(np.float32)
            self.p["u" + d] = (r.standard_normal((HIDDEN, g)) / np.sqrt(HIDDEN)).astype(np.float32)
            b = np.zeros(g, np.float32)
            b[HIDDEN : 2 * HIDDEN] = 1
            self.p["b" + d] = b
        self.p["o"] = (r.standard_normal(2 * HIDDEN) * 0.1).astype(np.float32)
        self.p["c"] = np.zeros(1, np.float32)

    @staticmethod
    def _sigmoid(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """Hidden states of one direction; x: batch x time x DIM. Places outside the mask leave the state as it is."""
        batch, time, _ = x.shape
        pre = x.reshape(-1, DIM) @ self.p["w" + d] + self.p["b" + d]
        pre = pre.reshape(batch, time, -1)
        h = np.zeros((batch, HIDDEN), np.float32)
        c = np.zeros_like(h)
        out = np.zeros((batch, time, HIDDEN), np.float32)
        for t in range(time) if d == "f" else range(time - 1, -1, -1):
            z = pre[:, t] + h @ self.p["u" + d]
            s = self._sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[:, t, None]
            new = f * c + i * g
            tanh = np.tanh(new)
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, tanh, m))
            h = m * (o * tanh) + (1 - m) * h
            c = m * new + (1 - m) * c
            out[:, t] = h
        return out

    def logits(self, x: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        f = self._run(x, mask, "f", None if keep is None else keep.setdefault("f", []))
        b = self._run(x, mask, "b", None if keep is None else keep.setdefault("b", []))
        both = np.concatenate([f, b], axis=2)
        if keep is not None:
            keep["h"] = both
        return both @ self.p["o"] + self.p["c"][0]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        keep: dict = {}
        v = self.logits(x, mask, keep)
        p = self._sigmoid(v)
        n = mask.sum()
        loss = float(-(mask * (y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9))).sum() / n)
        dv = mask * (p - y) / n
        grad = {"o": (dv[:, :, None] * keep["h"]).sum((0, 1)), "c": np.array([dv.sum()], np.float32)}
        dh_all = dv[:, :, None] * self.p["o"]
        for d, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
            dz_all = np.zeros((*mask.shape, 4 * HIDDEN), np.float32)
            u = self.p["u" + d]
            du = np.zeros_like(u)
            dh = np.zeros((len(x), HIDDEN), np.float32)
            dc = np.zeros_like(dh)
            for t, h, c, i, f, o, g, tanh, m in reversed(keep[d]):
                dh = dh + dh_all[:, t, part]
                inner, outer = dh * m, dh * (1 - m)
                dnew = inner * o * (1 - tanh * tanh) + dc * m
                dz = np.concatenate([dnew * g * i * (1 - i), dnew * c * f * (1 - f), inner * tanh * o * (1 - o), dnew * i * (1 - g * g)], axis=1)
                dz_all[:, t] = dz
                du += h.T @ dz
                dh = outer + dz @ u.T
                dc = dnew * f + dc * (1 - m)
            flat = dz_all.reshape(-1, 4 * HIDDEN)
            grad["w" + d] = x.reshape(-1, DIM).T @ flat
            grad["u" + d] = du
            grad["b" + d] = flat.sum(0)
        return loss, grad

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], steps: int = STEPS, rate: float = 0.02, seed: int = 9) -> float:
        """Adam on batches of pages of about one length; returns the last losses' mean."""
        pages = sorted(pages, key=lambda page: len(page[1]))
        r = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        losses = []
        for step in range(1, steps + 1):
            at = int(r.integers(0, max(len(pages) - 2 * BATCH, 0) + 1))
            some = [pages[i] for i in r.permutation(np.arange(at, min(at + 2 * BATCH, len(pages))))[:BATCH]]
            x, mask, y = padded([a for a, _ in some], [b for _, b in some])
            loss, grad = self.gradients(x, mask, y)
            losses.append(loss)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            now = rate * (1 - step / (steps + 1)) ** 0.5
            for k, g in grad.items():
                g = g * min(1, 5 / (norm + 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                self.p[k] = self.p[k] - (now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return float(np.mean(losses[-20:]))

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block of each page belongs to the article."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        start = 0
        while start < len(order):
            stop = start + 1
            while stop < len(order) and (stop + 1 - start) * len(pages[order[stop]]) <= CELLS:
                stop += 1
            some = order[start:stop]
            x, mask, _ = padded([pages[i] for i in some], [np.zeros(len(pages[i])) for i in some])
            v = self.logits(x, mask)
            for row, i in zip(v, some, strict=True):
                out[i] = row[: len(pages[i])] > 0
            start = stop
        return out


def padded(xs: list[np.ndarray], ys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    time = max(map(len, xs))
    x, mask, y = np.zeros((len(xs), time, DIM), np.float32), np.zeros((len(xs), time), np.float32), np.zeros((len(xs), time), np.float32)
    for i, (a, b) in enumerate(zip(xs, ys, strict=True)):
        x[i, : len(a)], mask[i, : len(a)], y[i, : len(b)] = a, 1, b
    return x, mask, y


#: What menus, notices, adverts, forms, comments and footers commonly say (training text; no string of a test page is among it).
STOCK = {
    "nav": "Overview|Topics|Team|Events|Careers|Support|Pricing|Magazine|Regions|Culture|Economy|Themen|Stellen|Boutique|Rubriques|Secciones|Tienda|Sobre nós|Legal|Site map|Feeds|Back to top",
    "header": "The morning post|City review|Notes from the coast|Guten Tag|Bonjour à tous|Hola|Your daily reading|Stories and reports",
    "footer": "(c) {y} The authors|© {y} Somebody & Sons|© {y} Verlag Muster|Copyright {y} by the publisher.|Copyright © {y} Press House. No part may be copied.|All material is protected by copyright.|Reproduction only with permission|Datenschutz|Droits réservés|Reservados todos los derechos|Conditions|Made with care|Find us on social networks|A publication of the Press House, {y}.",
    "notice": "Cookies help us deliver this page.|Your choices about cookies: accept or decline.|OK, understood|Diese Seite verwendet Cookies.|Ce site dépose des cookies.|Este sitio utiliza cookies.|Read our policy on data.|Your browser is out of date.|You have reached this month's limit.|Only subscribers can read on.|Choose a plan to see the rest.|This text is for supporters.",
    "ad": "Order today|Get yours.|Promoted|Partner content|Only this week: two for one!|Werbung|Annonce|Anuncio|30 % less on everything|Delivery at no cost|Start your trial.",
    "sidebar": "See also|More stories|Top ten|Trending|Further reading|Lesen Sie auch|Sur le même sujet|Más noticias|Labels|New on this site|Tell a friend|By month|Poll of the week|Calendar|Forecast|21 degrees|Index +0.4 %|Exchange 1.08|4 8 15 16",
    "form": "E-mail address|Full name|Get our letter every week|Register|Find|Submit|Your password|Sign me up|Registrieren|Je m'abonne|Darse de alta|Stay informed",
    "comments": "Responses|Join the discussion|Antworten|I could not agree more.|Well written.|Stimmen|Réactions|Opiniones|This is plainly wrong.|Good to know.|Me too|two hours ago",
}
#: What stands beside the prose of an article.
BYLINES = ("By", "Von", "Par", "Por", "Text:", "Photo:", "Published", "Updated")
UNITS = ("", "", "", " %", " m", " km", " kg", " €", " $", " h")
#: Elements and names under which they stand.
HOLDERS = {
    "nav": (("nav", "menu", "header"), ("nav", "navigation", "menu", "breadcrumb", "header")), "header": (("header",), ("header", "banner", "nav")), "footer": (("footer",), ("footer",)),
    "notice": (("aside", "dialog"), ("cookie", "notice", "consent", "alert", "popup", "modal", "wall", "paywall", "member")), "ad": (("aside",), ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner")),
    "sidebar": (("aside", "nav"), ("sidebar", "related", "widget", "share", "social", "rail", "teaser", "module")), "form": (("form",), ("form", "newsletter", "subscribe", "signup", "login", "search")), "comments": (("section", "aside"), ("comment", "comments", "reply", "replies")),
}
NEUTRAL = ("page", "wrap", "container", "row", "col", "inner", "box", "site", "layout", "block", "group", "outer", "grid", "view", "left", "right", "top", "area", "panel", "cell")


class Pool:
    """Texts of the sample from which training pages are laid out."""

    def __init__(self, pages: list[list[Block]]):
        self.articles: list[list[tuple[str, str]]] = []
        self.links: list[str] = []
        self.sentences: list[str] = []
        for page in pages:
            named = any(b.inside and not b.other for b in page)
            own = [b for b, m in zip(page, marked(page), strict=True) if m and (named or (len(b.text.split()) >= 15 and 2 * b.linked < len(b.text)))]
            if own:
                self.articles.append([(b.tag if b.tag in HEADINGS or b.tag in ("li", "blockquote", "td", "dd", "pre") else "p", b.text) for b in own])
                self.sentences += [x.strip() for b in own[:40] for x in re.split(r"(?<=[.!?])\s", b.text)[:40] if 2 <= len(x.split()) <= 60]
            self.links += [b.text for b in page if b.linked * 2 >= len(b.text) and len(b.text.split()) <= 8][:40]
        self.links += [x for x in STOCK["nav"].split("|")]
        self.sentences += [x for x in STOCK["comments"].split("|")]


def laid_out(pool: Pool, r: np.random.Generator) -> tuple[list[Block], list[int]]:
    """A page of a random layout: an article from the pool, and other parts before, inside and after it."""
    pick = lambda xs: xs[int(r.integers(0, len(xs)))]
    made_up = lambda: "c:" + "".join(pick("abcdefghijklmnopqrstuvwxyz") for _ in range(int(r.integers(2, 7))))
    neutral = lambda: [f"t:{pick(('div', 'div', 'section'))}", *([f"c:{pick(NEUTRAL)}"] if r.random() < 0.5 else [made_up()] if r.random() < 0.6 else [])]
    out: list[Block] = []
    y: list[int] = []

    def put(path: list[str], leaf: str, text: str, linked: float, mark: int) -> None:
        mask = 0
        for token in [*path, f"t:{leaf}"]:
            mask |= bit(token)
        out.append(Block(text, int(linked * len(text)), mask, leaf, False, False))
        y.append(mark)

    def stock(kind: str) -> str:
        return pick(STOCK[kind].split("|")).replace("{y}", str(int(r.integers(1998, 2027))))

    def prose(most: int) -> str:
        return " ".join(pick(pool.sentences) for _ in range(int(r.integers(1, most + 1))))

    table = r.random() < 0.16
    body = ["t:html", "t:body"] if r.random() < 0.9 else []
    for _ in range(int(r.integers(0, 3))):
        body = [*body, *neutral()]
    if table:
        body = [*body, "t:table", *(["t:tbody"] if r.random() < 0.5 else []), "t:tr"]

    def other(kind: str, base: list[str]) -> None:
        tags, names = HOLDERS[kind]
        style = r.random()
        if table and r.random() < 0.7:
            base = [*base, "t:td"]
        if style < 0.4:
            path = [*base, f"t:{pick(tags)}"]
            if tags[0] == "section" or r.random() < 0.3:
                path.append(f"c:{pick(names)}")
        elif style < (0.6 if kind == "nav" else 0.75) or kind in ("comments", "sidebar"):
            path = [*base, f"t:{pick(('div', 'div', 'section', 'ul', 'p'))}", f"c:{pick(names)}"]
        else:  # nothing tells but what it says and where it stands
            path = [*base, *neutral()] if r.random() < 0.6 else list(base)
        leaf = "div"
        if kind == "nav":
            leaf = pick(("li", "li", "div", "td", "p"))
            if r.random() < 0.35:
                put(path, pick(("div", "div", "p", "td")), pick((" | ", " · ", " ", " » ", "")).join(pick(pool.links) for _ in range(int(r.integers(2, 9)))), pick((1.0, 1.0, 0.9, 0.7, 0.0)), 0)
                return
            path = [*path, "t:ul"] if leaf == "li" else path
            for _ in range(int(r.integers(2, 9))):
                put(path, leaf, pick(pool.links), float(r.random() < 0.9), 0)
        elif kind == "header":
            put(path, "td" if table and r.random() < 0.5 else pick(("h1", "div", "p")), stock(kind) if r.random() < 0.5 else pick(pool.links), float(r.random() < 0.4), 0)
        elif kind == "footer":
            for _ in range(int(r.integers(1, 4))):
                put(path, pick(("div", "p", "li")), stock(kind) if r.random() < 0.8 else pick(pool.links), float(r.random() < 0.3), 0)
        elif kind == "ad":
            put(path, pick(("div", "p")), stock(kind) if r.random() < 0.5 else " ".join(prose(1).split()[:8]), float(r.random() < 0.3), 0)
        elif kind == "sidebar":
            put(path, pick(("h2", "h3", "div")), stock(kind), 0, 0)
            for _ in range(int(r.integers(1, 6))):
                put(path, pick(("li", "p", "div")), pick(pool.links) if r.random() < 0.4 else " ".join(prose(1).split()[:10]), float(r.random() < 0.8), 0)
        elif kind == "comments":
            put(path, pick(("h2", "h3", "div")), stock(kind), 0, 0)
            for _ in range(int(r.integers(1, 6))):
                inner = [*path, *(("t:article", "c:comment") if r.random() < 0.3 else ("t:li",) if r.random() < 0.3 else ("t:div", "c:comment"))]
                if r.random() < 0.5:
                    put(inner, "div", pick(pool.links), float(r.random() < 0.3), 0)
                put(inner, pick(("p", "p", "div")), prose(4), 0, 0)
        else:
            for _ in range(int(r.integers(1, 4))):
                put(path, pick(("p", "div", "label", "td")), stock(kind), float(r.random() < 0.2), 0)

    def short(most: int) -> str:
        return " ".join(pick(pool.sentences).split()[: int(r.integers(1, most + 1))]).rstrip(".,;:")

    def cell() -> str:
        return short(3) if r.random() < 0.4 else str(int(r.integers(1950, 2030))) if r.random() < 0.3 else f"{r.integers(0, 1000) / pick((1, 1, 10)):g}{pick(UNITS)}"

    def of_article(home: list[str]) -> None:
        """A data table, a list, a definition list or short lines that belong to an article."""
        style = r.random()
        if style < 0.4:
            where = [*home, *(["t:figure"] if r.random() < 0.2 else []), "t:table", *([f"t:{pick(('tbody', 'thead'))}"] if r.random() < 0.5 else []), "t:tr"]
            columns, head = int(r.integers(1, 5)), r.random() < 0.7
            for row in range(int(r.integers(2, 7))):
                for k in range(columns):
                    put(where, "th" if head and (row == 0 or k == 0 and r.random() < 0.1) else "td", short(2) if head and row == 0 else cell(), 0, 1)
        elif style < 0.6:
            for _ in range(int(r.integers(1, 6))):
                put([*home, "t:dl"], "dt", short(3), 0, 1)
                put([*home, "t:dl"], "dd", short(14), 0, 1)
        elif style < 0.85:
            for _ in range(int(r.integers(2, 6))):
                put([*home, f"t:{pick(('ul', 'ol'))}"], "li", short(12), 0.3 * (r.random() < 0.1), 1)
        else:
            put(home, pick(("p", "p", "div", "figcaption", "h4")), short(5) + pick(("", ".", "!", "?")), 0, 1)

    def byline(home: list[str]) -> None:
        name = " ".join("".join(pick("abcdefghijklmnopqrstuvwxyz") for _ in range(int(r.integers(2, 8)))).capitalize() for _ in range(2))
        date = f"{r.integers(1, 29)}.{r.integers(1, 13)}.{r.integers(1998, 2030)}"
        holder = [f"t:{pick(('div', 'p', 'address'))}", *([f"c:{pick(('byline', 'author', 'meta', 'date', 'info'))}"] if r.random() < 0.4 else [])] if r.random() < 0.5 else []
        put([*home, *holder], pick(("p", "div", "span", "address")), pick((f"{pick(BYLINES)} {name}", f"{pick(BYLINES)} {name}, {date}", f"{pick(BYLINES)} {date}", date)), 0.9 * (r.random() < 0.2), 1)

    style = r.random()
    if style < 0.22:
        home = [*body, "t:article"]
    elif style < 0.32:
        home = [*body, "t:main", *(["t:article"] if r.random() < 0.4 else [])]
    elif style < 0.52:
        home = [*body, f"t:{pick(('div', 'section'))}", f"c:{pick(ARTICLE_NAMES)}"]
    elif style < 0.8:
        home = [*body, *neutral()]
    else:
        home = list(body)
    if table:
        home = [*home, "t:td"]
    for kind in ("notice", "header", "nav", "ad", "form"):
        if r.random() < (0.7 if kind == "nav" else 0.5 if kind == "header" else 0.2):
            other(kind, body)
    article = pick(pool.articles)
    n = int(r.integers(1, 4)) if r.random() < 0.25 else int(r.integers(1, 25))
    start = 0 if r.random() < 0.6 else int(r.integers(0, len(article)))
    plain = r.random() < 0.15
    for i, (tag, text) in enumerate(article[start : start + n]):
        if r.random() < (0.1 if i else 0.4) and tag not in HEADINGS:  # headings of the article's own
            put(home, pick(("h1", "h2", "h2", "h3")), " ".join(pick(pool.sentences).split()[: int(r.integers(1, 9))]), 0, 1)
        if not i and r.random() < 0.2:
            byline(home)
        if i and r.random() < 0.12 or i == n - 1 and r.random() < 0.15:
            other(pick(("ad", "ad", "form", "sidebar", "notice", "notice")), home)
        words = text.split()
        if r.random() < 0.15 and len(words) > 6:
            text = " ".join(words[: int(r.integers(1, len(words)))])
        leaf = "div" if plain and tag == "p" else tag if r.random() < 0.85 else pick(("p", "p", "li", "blockquote", "pre", "h2", "h3", "td", "dd", "figcaption"))
        put([*home, *(["t:ul"] if leaf == "li" else [])], leaf, text, 0.1 * (r.random() < 0.1), 1)
        if r.random() < (0.1 if n > 3 else 0.25):
            of_article(home)
    for kind in ("ad", "comments", "sidebar", "form", "footer"):
        if r.random() < (0.75 if kind == "footer" else 0.3):
            other(kind, home if kind in ("ad", "comments") and r.random() < 0.25 else body)
    return out, y


def train(pages: list[str], laid: int = PAGES, seed: int = 3) -> Labeller | None:
    """A labeller from raw pages: these as they are (a stretch of each), and as many laid out from them as ``laid``."""
    cut = [b for b in map(blocks_of, pages) if b]
    pool = Pool(cut)
    if not pool.articles:
        return None
    r = np.random.default_rng(seed)
    data = []
    for page in cut:
        start = int(r.integers(0, len(page))) if r.random() < 0.3 else 0
        some = slice(start, start + 64)
        data.append((vectors(page)[some], np.array(marked(page)[some], np.float32)))
    for _ in range(laid):
        blocks, y = laid_out(pool, r)
        data.append((vectors(blocks), np.array(y, np.float32)))
    model = Labeller()
    model.fit(data)
    return model


def chosen_pages(pages: DataFrame, html_col: str, sample: int) -> list[str]:
    """Up to ``sample`` pages: of each template the one with the smallest hash, then the next ones, until they are enough."""
    names = F.regexp_extract_all(F.col(html_col), F.lit(r'<([a-zA-Z][a-zA-Z0-9]*(?:\s+(?:class|id)="[^"<>]{0,60}")?)'), 1)
    found = pages.where(F.length(html_col) > 0).select(F.xxhash64(F.array_sort(F.array_distinct(names))).alias("template"), F.xxhash64(html_col).alias("h"))
    rank = F.row_number().over(Window.partitionBy("template").orderBy("h"))
    first = found.withColumn("rank", rank).where(F.col("rank") <= sample)  # each task keeps that many of a template before they meet
    hashes = [r.h for r in first.orderBy("rank", "h").limit(sample).collect()]
    if not hashes:
        return []
    rows = pages.where(F.xxhash64(html_col).isin(*set(hashes))).select(F.col(html_col).alias("html")).groupBy(F.xxhash64("html").alias("h")).agg(F.min("html").alias("html"))
    return [r.html for r in rows.orderBy("h").collect()]


def main_text(pages: DataFrame, keys: list[str], html_col: str = "html", sample: int = SAMPLE) -> DataFrame:
    """``keys`` of each row with text and n_chars (code points)."""
    model = train(chosen_pages(pages, html_col, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = [blocks_of(p) for p in batch.column(len(keys)).to_pylist()]
            good = model.label([vectors(b) for b in cut]) if model else [np.zeros(len(b), bool) for b in cut]
            texts = [" ".join(b.text for b, g in zip(page, marks, strict=True) if g) for page, marks in zip(cut, good, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=out.names)

    out = T.StructType([*(pages.schema[k] for k in keys), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return pages.select(*keys, html_col).mapInArrow(lean(run), out)


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(read(spark, sf_dir, "pages"), ["page_id", "url"])

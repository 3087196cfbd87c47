"""Main text of web pages by a linear-chain conditional random field over leaf blocks of the page.

A tolerant scanner cuts a page into leaf blocks: runs of text between block-level tags, each with the tags and the class and id
words of its ancestors. The chain labels every block as main text or not, from features of the ancestors and of the text; it is
trained on labelled pages by stochastic gradients of the exact likelihood and decoded by Viterbi. `labelled_pages` writes
training pages in many layouts, as tables of labelled pages may be missing; `train` takes any pages of (block, label).
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements of HTML by the part they play here.
SILENT = frozenset("script style noscript template head title svg iframe object canvas select option datalist textarea button".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose start ends an open p, and those that end an open element of their own kind.
ENDS_P = BLOCK - {"html", "body", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"}
OWN_KIND = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "p": ("p",)}

# a quote opens a value only behind an equals sign
_tag = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(?:>|\Z)", re.S)
_attribute = re.compile(r"\b(class|id|role|hidden|aria-label|itemprop)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_word = re.compile(r"[a-z]+")
_space = re.compile(r"\s+")
_camel = re.compile(r"(?<=[a-z])(?=[A-Z])")


#: Elements that hold others of a list or table: what ends an open item of its own kind is not sought beyond them.
CONTAINERS = frozenset("ul ol dl table menu tbody thead".split())
_ITEMS = frozenset(k for kinds in OWN_KIND.values() for k in kinds) - {"p", "option"}
#: Silent elements without an end swallow the rest of the page.
SWALLOWS = frozenset("script style template svg textarea title noscript".split())


class Block:
    """A leaf block: its text, the elements around it, the last two block-level ones, class, id and role words, and how much of it is linked."""

    __slots__ = ("text", "tags", "leaf", "above", "names", "roles", "linked")

    def __init__(self, text: str, tags: frozenset[str], leaf: str, above: str, names: frozenset[str], roles: frozenset[str], linked: int):
        self.text, self.tags, self.leaf, self.above, self.names, self.roles, self.linked = text, tags, leaf, above, names, roles, linked


class _Open:
    """An open element with what it adds up with those around it, so that no block looks at all of them."""

    __slots__ = ("tag", "tags", "leaf", "above", "names", "roles", "items")

    def __init__(self, tag: str, names: set[str], roles: set[str], around: "_Open | None", place: int):
        self.tag = tag
        old = around.tags if around else frozenset()
        self.tags = old if tag in old else old | {tag}
        inner = tag in BLOCK
        self.leaf = tag if inner else around.leaf if around else "none"
        self.above = (around.leaf if around else "none") if inner else around.above if around else "none"
        self.names = _joined(around.names if around else frozenset(), names)
        self.roles = _joined(around.roles if around else frozenset(), roles)
        #: Where the first open item of each kind is, within the nearest container.
        items = {} if tag in CONTAINERS or not around else around.items
        self.items = items | {tag: place} if tag in _ITEMS and tag not in items else items


def _joined(old: frozenset[str], new: set[str]) -> frozenset[str]:
    return old if new <= old else old | new


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks in page order: non-empty texts with white space made single, character references decoded. The work grows with the page's length, however deep or broken its markup is."""
    out: list[Block] = []
    stack: list[_Open] = []
    count: dict[str, int] = {}
    parts: list[tuple[str, bool]] = []
    endless: set[str] = set()
    page = page or ""

    def close() -> None:
        if parts:
            text = _space.sub(" ", "".join(t for t, _ in parts)).strip()
            if text:
                linked = sum(len(t) for t, a in parts if a)
                top = stack[-1] if stack else None
                out.append(Block(text, top.tags, top.leaf, top.above, top.names, top.roles, linked) if top else Block(text, frozenset(), "none", "none", frozenset(), frozenset(), linked))
            parts.clear()

    def pop(depth: int) -> None:
        if any(x.tag in BLOCK for x in stack[depth:]):
            close()
        for x in stack[depth:]:
            count[x.tag] -= 1
        del stack[depth:]

    def last(tag: str) -> int:
        # all above it is popped next
        return next(i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag)

    at, n = 0, len(page)
    while at < n:
        m = _tag.search(page, at)
        # references are decoded in text between tags, so that no decoded character becomes a tag
        piece = page[at : m.start() if m else n]
        if piece:
            parts.append((html.unescape(piece), count.get("a", 0) > 0))
        if not m:
            break
        at = m.end()
        if not m[1]:
            if m[0].startswith("<![CDATA["):
                parts.append((m[0][9:].removesuffix("]]>"), False))
            continue
        name = m[1].lower()
        if m[0].startswith("</"):
            if count.get(name):
                pop(last(name))
            elif name in BLOCK:
                close()
            continue
        if name in SILENT and name != "head" and not m[0].endswith("/>"):
            end = None if name in endless else re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
            if end:
                at = end.end()
            else:
                endless.add(name)
                at = n if name in SWALLOWS else at
            continue
        if name == "head":
            continue
        if name == "br":
            parts.append((" ", False))
            continue
        if name in BLOCK:
            if name in ENDS_P and count.get("p"):
                pop(last("p"))
            if name in OWN_KIND and name != "p" and stack:
                places = [stack[-1].items[k] for k in OWN_KIND[name] if k in stack[-1].items]
                if places:
                    pop(min(places))
            close()
        if name not in VOID and not m[0].endswith("/>"):
            names, roles = set(), set()
            for a in _attribute.finditer(m[2]):
                kind, value = a[1].lower(), a[2] or a[3] or a[4] or ""
                if kind == "hidden":
                    names.add("hidden")
                elif kind == "role":
                    roles.add(value.strip().lower())
                else:
                    names.update(_word.findall(_camel.sub(" ", value).lower()))
            stack.append(_Open(name, names, roles, stack[-1] if stack else None, len(stack)))
            count[name] = count.get(name, 0) + 1
    close()
    return out


# Parts of class and id words that tell what an element is for, and words of its text that do.
STEMS = "nav menu bread crumb head foot side aside widget relat recommend share social promo teaser advert sponsor banner cookie consent gdpr notice alert popup modal subscri newsletter login signup search form comment reply replies discuss disqus respond author bio tag meta legal copyright pagin article content post entry story body main text".split()
SAYS = {
    "menu": r"^(home|about|about us|contact|contact us|news|blog|services|products|login|log in|sign in|sign up|register|menu|search|next|previous|skip to (main )?content)\W*$",
    "consent": r"\b(cookies?|gdpr|privacy policy|we use|accept all|consent)\b",
    "news": r"\b(newsletter|subscribe|sign up|follow us|free trial|e-?mail address)\b",
    "advert": r"\b(advertisement|advert|sponsored|promoted|buy now|% off|special offer|deal of)\b",
    "rights": r"(©|\(c\)|copyright|all rights reserved|terms of (use|service)|imprint|powered by)",
    "comment": r"\b(leave a (reply|comment)|post a comment|comments?\b.{0,12}$|replies|reply|says:|wrote:|join the discussion|log in to comment)",
    "related": r"\b(related (posts|articles|stories)|you (may|might) also like|read (more|next|also)|recommended|share (this|on)|most (read|popular)|popular posts|trending|tags?:|posted (in|by)|filed under)\b",
}
_says = {k: re.compile(v, re.I) for k, v in SAYS.items()}
_stem = re.compile("|".join(sorted(STEMS, key=len, reverse=True)))


def _linked(b: Block) -> int:
    share = b.linked / max(len(b.text), 1)
    return 0 if share < 0.05 else 1 if share < 0.3 else 2 if share < 0.7 else 3


def page_features(found: list[Block]) -> list[list[str]]:
    """Names of the features of each block of a page: the elements around it, their class, id and role words and parts of these, its text, and the shape of its neighbours."""
    own = []
    many = max(len(found) - 1, 1)
    shapes = [(_linked(b), min((b.text.count(" ") + 1).bit_length(), 8)) for b in found]
    for i, b in enumerate(found):
        text, (linked, words) = b.text, shapes[i]
        out = ["bias", f"leaf:{b.leaf}", f"leaf2:{b.above}>{b.leaf}", f"words:{words}", f"linked:{linked}", f"shape:{words}:{linked}:{b.leaf}"]
        out += [f"in:{t}" for t in b.tags]
        out += [f"name:{w}" for w in b.names]
        out += [f"role:{r}" for r in b.roles]
        out += {f"stem:{x}" for w in b.names for x in _stem.findall(w)}
        # phrases tell in short blocks only: articles may speak of anything
        if len(text) < 200:
            out += [f"says:{k}" for k, p in _says.items() if p.search(text)]
        if not b.names and not b.roles:
            out.append("plain")
        out.append("stop" if text[-1] in ".!?…\"”»)" else "nostop")
        for side, j in (("before", i - 1), ("after", i + 1)):
            out.append(f"{side}:{shapes[j][1]}:{shapes[j][0]}" if 0 <= j < len(found) else f"{side}:none")
        if i / many < 0.1:
            out.append("early")
        if i / many > 0.9:
            out.append("late")
        own.append(out)
    return own


class Chain:
    """Two labels, 1 for main text; weights of (feature, label 1) and of label pairs, for label 0 as reference."""

    def __init__(self, weights: dict[str, float], pairs: np.ndarray, start: np.ndarray):
        self.weights, self.pairs, self.start = weights, pairs, start

    def scores(self, rows: list[list[str]]) -> np.ndarray:
        get = self.weights.get
        return np.array([sum([get(f, 0.0) for f in fs]) for fs in rows])

    def viterbi(self, rows: list[list[str]]) -> list[int]:
        """The labels of the best path."""
        if not rows:
            return []
        e = self.scores(rows).tolist()
        (p00, p01), (p10, p11) = self.pairs.tolist()
        a, b = self.start[0], self.start[1] + e[0]
        back = []
        for s in e[1:]:
            to0, to1 = a + p00 >= b + p10, a + p01 >= b + p11
            back.append((0 if to0 else 1, 0 if to1 else 1))
            a, b = (a + p00 if to0 else b + p10), (a + p01 if to1 else b + p11) + s
        label = 0 if a >= b else 1
        out = [label]
        for choice in reversed(back):
            label = choice[label]
            out.append(label)
        return out[::-1]

    def main_text(self, page: str | None) -> str:
        found = blocks(page)
        rows = page_features(found)
        return " ".join(b.text for b, y in zip(found, self.viterbi(rows), strict=True) if y)


def train(pages: list[tuple[list[list[str]], list[int]]], epochs: int = 8, rate: float = 0.25, ridge: float = 1e-4, seed: int = 7) -> Chain:
    """Maximises the conditional likelihood of the labels by AdaGrad over pages; expectations come from forward-backward sums."""
    names = {f: i for i, f in enumerate(sorted({f for rows, _ in pages for r in rows for f in r}))}
    coded = [([np.array([names[f] for f in r]) for r in rows], np.array(ys)) for rows, ys in pages if rows]
    w, gw = np.zeros(len(names)), np.full(len(names), 1e-6)
    pairs, gp = np.zeros((2, 2)), np.full((2, 2), 1e-6)
    start, gs = np.zeros(2), np.full(2, 1e-6)
    order = list(range(len(coded)))
    rng = random.Random(seed)
    for _ in range(epochs):
        rng.shuffle(order)
        for k in order:
            rows, y = coded[k]
            n = len(rows)
            e = np.zeros((n, 2))
            e[:, 1] = [w[r].sum() for r in rows]
            f, b = np.zeros((n, 2)), np.zeros((n, 2))
            f[0] = start + e[0]
            for i in range(1, n):
                f[i] = np.logaddexp(f[i - 1, 0] + pairs[0], f[i - 1, 1] + pairs[1]) + e[i]
            for i in range(n - 2, -1, -1):
                x = e[i + 1] + b[i + 1]
                b[i] = np.logaddexp(pairs[:, 0] + x[0], pairs[:, 1] + x[1])
            total = np.logaddexp(f[-1, 0], f[-1, 1])
            node = np.exp(f + b - total)
            d = y - node[:, 1]
            grad = np.zeros_like(w)
            for r, v in zip(rows, d, strict=True):
                grad[r] += v
            grad -= ridge * w
            gw += grad * grad
            w += rate * grad / np.sqrt(gw)
            dp = np.zeros((2, 2))
            if n > 1:
                edge = np.exp(f[:-1, :, None] + pairs[None] + (e[1:] + b[1:])[:, None, :] - total)
                np.add.at(dp, (y[:-1], y[1:]), 1.0)
                dp -= edge.sum(axis=0)
            gp += dp * dp
            pairs += rate * dp / np.sqrt(gp)
            ds = np.eye(2)[y[0]] - node[0]
            gs += ds * ds
            start += rate * ds / np.sqrt(gs)
    return Chain({f: float(w[i]) for f, i in names.items() if abs(w[i]) > 1e-6}, pairs, start)


# Layouts that the training pages vary: (element, class or id words).
MENUS = (("nav", ""), ("div", "nav"), ("ul", "menu"), ("div", "navbar main-nav"), ("div", "breadcrumbs"), ("nav", "pagination"), ("div", "site-navigation"), ("div", "tabs"))
HEADERS = (("header", ""), ("div", "header"), ("div", "site-header masthead"), ("div", "topbar"), ("header", "banner"), ("div", "logo tagline"))
FOOTERS = (("footer", ""), ("div", "footer"), ("div", "site-footer"), ("div", "copyright"), ("footer", "colophon"), ("div", "legal imprint"))
SIDES = (("aside", ""), ("div", "sidebar"), ("div", "widget related"), ("section", "related-posts"), ("div", "recommended"), ("aside", "newsletter"), ("div", "share social"), ("div", "promo teaser"), ("div", "tags meta"), ("div", "author-bio"))
ADVERTS = (("div", "ad"), ("div", "ads advert"), ("div", "advertisement"), ("div", "sponsored"), ("aside", "ad-slot"), ("div", "banner ad"), ("ins", "adsbygoogle"))
NOTICES = (("div", "cookie"), ("div", "cookie-notice consent"), ("div", "notice"), ("div", "alert"), ("div", "gdpr banner"), ("section", "popup modal"), ("div", "subscribe paywall"), ("p", "notice"), ("div", "message warning"))
FORMS = (("form", ""), ("form", "search"), ("form", "login signup"), ("div", "newsletter-form"))
COMMENTS = (("section", "comments"), ("div", "comment-list"), ("ol", "commentlist"), ("div", "comment"), ("div", "discussion replies"), ("div", "reader-comments"), ("div", "disqus_thread"))
ARTICLES = (("article", ""), ("main", ""), ("div", "content"), ("div", "post entry-content"), ("div", "article-body"), ("section", "story"), ("div", "main-content"), ("article", "post"), ("div", "text"), ("div", ""), ("main", "page"))


# Wording that pages have around their texts.
PHRASES = {
    "menu": ("Home", "About", "About us", "Contact", "News", "Blog", "Products", "Log in", "Sign up", "Search", "Archive", "Help"),
    "consent": ("We use cookies to improve your visit.", "This site uses cookies. Accept all?", "By staying here you accept our privacy policy.", "We value your consent to cookies and similar things."),
    "comment": ("Leave a reply", "Leave a comment", "Comments", "3 comments", "12 replies", "Join the discussion", "Post a comment", "What readers say"),
    "related": ("Related posts", "Related articles", "You may also like", "Read more", "Recommended for you", "Share this", "Most read", "Popular posts", "Trending now"),
    "advert": ("Advertisement", "Sponsored", "Ad", "Sponsored content", "Buy now and save", "Special offer: 20% off"),
    "rights": ("&copy; 2024 All rights reserved.", "Copyright 2021 Example. Terms of use", "All rights reserved | Imprint", "Powered by Example"),
}


def labelled_pages(count: int = 500, seed: int = 11, odd: float = 0.0) -> list[tuple[str, str]]:
    """(page, its main text), written from the layouts above with invented words, in a fixed order for a seed. odd: the share of elements whose class or id names are altered, some of them beyond knowing."""
    rng = random.Random(seed)
    syllables = "an be co der en fi gan ho in ka lo men ne or pa qui re st ti un ver wo".split()

    def word() -> str:
        return "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))

    def sentence(least: int = 4, most: int = 16) -> str:
        return " ".join(word() for _ in range(rng.randint(least, most))).capitalize() + rng.choice("....!?")

    def prose() -> str:
        text = " ".join(sentence() for _ in range(rng.randint(1, 6)))
        x = rng.random()
        return text[:-1] if x < 0.25 else text.upper() if x < 0.3 else text.replace(" ", " | ") if x < 0.35 else text

    def short() -> str:
        return " ".join(word() for _ in range(rng.randint(1, 5))).capitalize()

    def wrap(kind: tuple[str, str], inner: str, role: str = "") -> str:
        tag, names = kind
        x = rng.random()
        if names and x < odd / 10:  # names that say nothing, or a part of them
            names = f"{word()[:2]}{rng.choice('bcdfgx')}-{rng.randint(1, 99)}"
        elif names and x < odd:
            names = rng.choice((f"g{names.split()[0]}", f"{word()}-{names.split()[-1]}-{rng.randint(1, 9)}", f"{names.split()[0]}s {word()}"))
        if role and rng.random() < 0.3:
            tag, names = "div" if rng.random() < 0.7 else tag, "" if rng.random() < 0.6 else names
            return f'<{tag} role="{role}"{f" class={chr(34)}{names}{chr(34)}" if names else ""}>{inner}</{tag}>'
        attribute = f' {rng.choice(["class", "class", "id"])}="{names}"' if names else ""
        return f"<{tag}{attribute}>{inner}</{tag}>"

    def phrase(kind: str) -> str:
        return rng.choice(PHRASES[kind])

    def menu() -> str:
        label = short if rng.random() < 0.6 else lambda: phrase("menu")
        items = "".join(f'<li><a href="/{word()}">{label()}</a></li>' for _ in range(rng.randint(3, 9)))
        if rng.random() < 0.2:
            return "".join(f'<{rng.choice(("p", "span", "div"))}><a href="/{word()}">{label()}</a></div>'.replace("</div>", "") for _ in range(rng.randint(3, 7)))
        return f"<ul>{items}</ul>" if rng.random() < 0.8 else " ".join(f'<a href="/{word()}">{short()}</a>' for _ in range(5))

    def aside() -> str:
        if rng.random() < 0.25:
            return f"<h3>{phrase('related')}</h3>{menu()}"
        return rng.choice((lambda: f"<h3>{short()}</h3>{menu()}", lambda: f"<p>{prose()}</p>", lambda: f"<h4>{short()}</h4><p>{sentence()}</p>", lambda: sentence()))()

    def form() -> str:
        return f'<label>{short()}</label><input type="text"><button>{short()}</button>' + (f"<p>{sentence()}</p>" if rng.random() < 0.5 else "")

    def comment() -> str:
        tag = rng.choice(("h2", "h3", "h4", "p"))
        head = f"<{tag}>{short() if rng.random() < 0.4 else phrase('comment')}</{tag}>" if rng.random() < 0.6 else ""
        if rng.random() < 0.2:
            return head + form()
        return head + "".join(wrap((rng.choice(("div", "li", "article")), "comment"), f"<b>{short()}</b><p>{prose()}</p>") for _ in range(rng.randint(1, 5)))

    def article() -> tuple[str, list[str]]:
        texts, made = [], []
        if rng.random() < 0.9:
            texts.append(short())
            made.append(f"<h1>{texts[-1]}</h1>")
        for _ in range(rng.randint(1, 12)):
            x = rng.random()
            if x < 0.57:
                t = prose() if rng.random() < 0.8 else sentence(1, 5)
                texts.append(t)
                body = t if rng.random() < 0.6 else re.sub(r"^(\S+)", r"<b>\1</b>", t) if rng.random() < 0.6 else f"<b>{t}<br>"
                made.append(rng.choice((f"<p>{body}</p>", f"<p>{body}</p>", f"<p>{body}", f"<div>{body}</div>" if "<br>" not in body else f"<p>{body}")))
            elif x < 0.67:
                texts.append(short())
                made.append(rng.choice((f"<h2>{texts[-1]}</h2>", f"<h3>{texts[-1]}</h3>")))
            elif x < 0.76:
                items = [sentence(2, 10) for _ in range(rng.randint(2, 5))]
                texts += items
                made.append(f"<ul>{''.join(f'<li>{i}</li>' for i in items)}</ul>")
            elif x < 0.82:
                texts.append(prose())
                made.append(f"<blockquote><p>{texts[-1]}</p></blockquote>")
            elif x < 0.835:
                texts.append(sentence())
                made.append(f'<p><a href="/{word()}">{texts[-1]}</a></p>')
            elif x < 0.86:
                a = sentence()
                texts.append(f"{a} {short()}")
                made.append(f'<p>{a} <a href="/x">{texts[-1][len(a) + 1 :]}</a></p>')
            elif x < 0.89:
                texts.append(sentence())
                made.append(f"<pre>{texts[-1]}</pre>")
            else:
                made.append(wrap(rng.choice(ADVERTS), phrase("advert")) if rng.random() < 0.3 else wrap(rng.choice(ADVERTS + SIDES + NOTICES), aside()))
        if rng.random() < 0.1:
            made.append(wrap(rng.choice(FOOTERS), rng.choice((short, sentence))()))
        return "".join(made), texts

    pages = []
    for _ in range(count):
        body, texts = article()
        before = [wrap(rng.choice(HEADERS), role="banner", inner=rng.choice((short, lambda: f"<a href='/'>{short()}</a>", sentence))()) if rng.random() < 0.5 else "", wrap(rng.choice(MENUS), menu(), "navigation") if rng.random() < 0.85 else ""]
        before += [wrap(rng.choice(NOTICES), rng.choice((sentence, lambda: phrase("consent"), lambda: f"<p>{phrase('consent')} {sentence()}</p>", lambda: f"<p>{prose()}</p>"))()) if rng.random() < 0.4 else "", wrap(rng.choice(ADVERTS), rng.choice((sentence, prose, aside, lambda: phrase("advert")))()) if rng.random() < 0.5 else ""]
        before += [wrap(rng.choice(FORMS), form(), "search") if rng.random() < 0.3 else "", wrap(rng.choice(SIDES), aside(), "complementary") if rng.random() < 0.3 else ""]
        after = [wrap(rng.choice(SIDES), aside(), "complementary") if rng.random() < 0.5 else "", wrap(rng.choice(COMMENTS), comment()) if rng.random() < 0.5 else "", wrap(rng.choice(FORMS), form()) if rng.random() < 0.3 else ""]
        after += [wrap(rng.choice(ADVERTS), rng.choice((sentence, lambda: phrase("advert")))()) if rng.random() < 0.3 else "", wrap(rng.choice(FOOTERS), role="contentinfo", inner=rng.choice((lambda: phrase("rights"), lambda: f"&copy; {word()}.example &middot; {sentence()}", menu, lambda: f"<p>{sentence()}</p>"))()) if rng.random() < 0.85 else ""]
        rng.shuffle(before)
        rng.shuffle(after[:-1])
        outer = rng.choice((("", ""), ("", ""), ('<div id="page">', "</div>"), ('<div class="wrapper"><div class="container">', "</div></div>")))
        if rng.random() < 0.15:  # comments and the like within the article element
            inner = wrap(rng.choice(ARTICLES[:1] + ARTICLES[7:8]), body + (after[1] or wrap(rng.choice(COMMENTS), comment())) + after[0])
            after[0] = after[1] = ""
        elif rng.random() < 0.1:  # no element of its own, and little or nothing around it
            inner = body
            if rng.random() < 0.6:
                before, after = [], []
            if rng.random() < 0.15:
                texts = [prose()]
                pages.append((texts[0], texts[0]))
                continue
        else:
            inner = wrap(rng.choice(ARTICLES), body, "main")
        page = f"<!DOCTYPE html><html><head><title>{short()}</title><style>p{{}}</style></head><body>{outer[0]}{''.join(before)}{inner}{''.join(after)}{outer[1]}</body></html>"
        pages.append((page, " ".join(texts)))
    return pages


def labelled_blocks(page: str, main: str) -> tuple[list[list[str]], list[int]]:
    """Features of a page's blocks, and 1 for those that the main text holds in order."""
    found, at, ys = blocks(page), 0, []
    for b in found:
        hit = main.find(b.text, at)
        good = hit >= 0 and hit - at <= 1
        ys.append(int(good))
        if good:
            at = hit + len(b.text)
    return page_features(found), ys


_trained: dict[int, Chain] = {}


def default_chain(pages: int = 2800) -> Chain:
    if pages not in _trained:
        data = [labelled_blocks(*p) for p in [*labelled_pages(pages // 2), *labelled_pages(pages // 2, seed=12, odd=0.2)]]
        # every third page without whole names, so that their parts, roles, elements and texts must do
        _trained[pages] = train([([[f for f in r if not f.startswith("name:")] for r in rows] if i % 3 == 0 else rows, ys) for i, (rows, ys) in enumerate(data)])
    return _trained[pages]


def _extract(at: int, chain):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = chain.value
        for batch in batches:
            texts = [model.main_text(page) for page in batch.column(at).to_pylist()]
            cols = [c for i, c in enumerate(batch.columns) if i != at]
            names = [c for i, c in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(texts, pa.string())], [*names, "main_text"])

    return run


def extract(pages: DataFrame, html_col: str = "html", chain: Chain | None = None) -> DataFrame:
    """pages without html_col, with main_text (string; a column of that name is replaced).

    The main text joins the chosen blocks in page order by one space; it is empty for null or empty pages and pages without
    any. Broken markup is read as far as it goes. Whole pages are read whatever their length; repeated rows give repeated rows,
    an empty table an empty one."""
    pages = (pages.drop("main_text") if html_col != "main_text" else pages).withColumn(html_col, F.col(html_col).cast("string"))
    shared = pages.sparkSession.sparkContext.broadcast(chain or default_chain())  # a weight for each feature of the training pages
    schema = T.StructType([f for f in pages.schema.fields if f.name != html_col]).add("main_text", "string")
    return pages.mapInArrow(_extract(pages.columns.index(html_col), shared), schema)

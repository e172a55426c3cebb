"""HTML extraction: a linear-chain conditional random field over leaf blocks.

A page is cut into leaf blocks, the stretches of text between block-level
tags. Each block has features of its ancestors (tags, words of their class,
id and role) and of its text; the chain knows which neighbours go together.
The weights are trained by gradient steps on the conditional likelihood of
labelled pages, with marginals from the forward-backward recursion, and
pages are decoded by Viterbi.

Labelled pages are made from a bounded sample of the table's own pages:
their texts are laid out anew in many page shells (with and without semantic
tags, with sidebars, notices, forms, comments, adverts inside the article),
where every block's label is known because the shell put it there.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
import uuid
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import seeded, ship

MARK = re.compile(r"<!--(?:-?>|.*?(?:-->|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)|<[!?/][^>]*>", re.S)
ATTRS = re.compile(r"""((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>""")
OPEN_END = re.compile(r"<!--|<!\[CDATA\[")
QUOTED = re.compile(r"""=\s*(["'])""")
ATTR = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
NAME = re.compile(r"[a-z]+")
UNNAMED = 0.5  # share of training pages without telling names
PROSE = 60  # least unlinked characters of a block of prose
#: Fixed values of HTML: elements that end at their end tag only, whose content is no text, without content, and inside a line of text.
RAW = frozenset("script style title textarea iframe xmp noembed noframes".split())
SKIPPED = frozenset("noscript template svg object canvas audio video select annotation annotation-xml".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q s samp small span "
                   "strike strong sub sup time tt u var wbr "
                   "math semantics mrow mi mn mo ms mtext mspace mfrac msqrt mroot mstyle msub msup msubsup munder mover munderover "
                   "mmultiscripts mprescripts mpadded mphantom menclose merror maction mtable mtr mtd".split())
CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
          "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}


class Place:
    """An open element: the features it adds to those of the elements around it (``up``)."""

    __slots__ = ("up", "inner", "told", "box")

    def __init__(self, up: Place | None, tag: str, told: tuple):
        self.up, self.told = up, told
        inline = tag in INLINE
        self.inner = (up.inner if up else "") if inline else tag
        #: What holds the innermost block-level element, among its like.
        self.box = (up.box if up else None) if inline else up


class Block:
    __slots__ = ("text", "place", "linked")

    def __init__(self, text: str, place: Place | None, linked: int):
        self.text, self.place, self.linked = text, place, linked


def names_of(attrs: str) -> tuple:
    """Words of an element's class, id and role; ``hidden`` if it isn't shown."""
    out = []
    for m in ATTR.finditer(attrs):
        key, value = m.group(1).lower(), (m.group(2) or "").strip("\"'").lower()
        if key in ("class", "id", "role"):
            out += NAME.findall(value)
        elif key == "hidden" or key == "aria-hidden" and value == "true" or "display:none" in value.replace(" ", ""):
            out.append("hidden")
    return tuple(out)


def tag_ends(page: str):
    """A function that tells where a tag ends whose attributes start at a place
    (-1: nowhere, as a quote is left open). All ends are found in one pass from
    the last quoted value back, for pages on which reading on from each tag
    comes to no end."""
    quoted = list(QUOTED.finditer(page))
    starts, ends = [m.start() for m in quoted], [-1] * len(quoted)
    marks = {c: [m.start() for m in re.finditer(c, page)] for c in "\"'>"}

    def end(at: int) -> int:
        close, value = bisect_left(marks[">"], at), bisect_left(starts, at)
        shut = marks[">"][close] if close < len(marks[">"]) else -1
        if value == len(starts) or 0 <= shut < starts[value]:
            return shut
        return ends[value]

    for k in range(len(quoted) - 1, -1, -1):
        opened = quoted[k].start(1)
        same = marks[quoted[k].group(1)]
        closed = bisect_left(same, opened + 1)
        ends[k] = end(same[closed] + 1 if closed < len(same) else opened)
    return end


def leaf_blocks(page: str) -> list[Block]:
    """The blocks of a page in page order, in time that grows with the page's
    length however its markup is broken: nothing is looked for twice, and
    blocks share what they know about the elements around them."""
    blocks: list[Block] = []
    stack: list[tuple[str, list[str], Place]] = []
    where: dict[str, list[int]] = {}  # places in the stack by tag
    outer: list[int] = []  # of elements that aren't inside a line
    around: Counter = Counter()  # features of the open elements
    parts: list[str] = []
    links, in_link, skipping = 0, 0, 0
    last_end: dict[str, int] = {}  # of skipped elements: without an end tag to come, they skip nothing

    def closed(tag: str, at: int) -> bool:
        if tag not in last_end:
            last_end[tag] = max((m.start() for m in re.finditer(rf"</{tag}(?![\w:-])", page, re.I)), default=-1)
        return last_end[tag] >= at

    def add(piece: str) -> None:
        nonlocal links
        if piece and not skipping:
            piece = entities.unescape(piece) if "&" in piece else piece
            parts.append(piece)
            if in_link:
                links += len(piece.strip())

    def flush() -> None:
        nonlocal links
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append(Block(text, stack[-1][2] if stack else None, links))
            parts.clear()
        links = 0

    def enter(tag: str, attrs: str) -> None:
        nonlocal in_link, skipping
        up = stack[-1][2] if stack else None
        inline = tag in INLINE
        found = sorted({f"name:{n}" for n in names_of(attrs)}) if attrs else []
        if not inline:
            found.append(f"under:{tag}")
            outer.append(len(stack))
        told = tuple(x for x in found if not around[x])
        around.update(found)
        where.setdefault(tag, []).append(len(stack))
        stack.append((tag, found, Place(up, tag, told)))
        in_link += tag == "a"
        skipping += tag in SKIPPED

    def leave(first: int) -> None:
        """Close the elements of the stack from ``first`` on."""
        nonlocal in_link, skipping
        while len(stack) > first:
            tag, found, _ = stack.pop()
            where[tag].pop()
            if tag not in INLINE:
                outer.pop()
            around.subtract(found)
            in_link -= tag == "a"
            skipping -= tag in SKIPPED

    def last(tags) -> int:
        return max((where[t][-1] for t in tags if where.get(t)), default=-1)

    at, size, limit = 0, len(page), page.rfind(">") + 1  # no tag ends after the limit
    tag_end = None
    while at < size:
        if at >= limit:
            m = OPEN_END.search(page, at)
            add(page[at:m.start() if m else size])
            if m and m.group() != "<!--":
                add(page[m.end():])
            break
        m = MARK.search(page, at, limit)
        if m is None:
            add(page[at:limit])
            at = limit
            continue
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        if m.group(2) is None:
            if page.startswith("<!--", m.start()):
                if not page.endswith(("-->", "<!-->", "<!--->"), m.start(), at):
                    break
            elif page.startswith("<![CDATA[", m.start()):
                if not page.endswith("]]>", m.start(), at):
                    add(page[m.start() + 9:])
                    break
                add(page[m.start() + 9:at - 3])
            continue
        close, tag = m.group(1), m.group(2).lower()
        if tag_end is None:
            whole = ATTRS.match(page, at, limit)
            if whole is None:  # a quote that is left open
                tag_end = tag_ends(page)
        end = whole.end() - 1 if tag_end is None else tag_end(at)
        if end < 0:
            end = page.find(">", at)
        attrs = page[at:end]
        at = end + 1
        block = tag not in INLINE
        if block:
            flush()
        if close:
            if where.get(tag):
                leave(where[tag][-1])
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at, limit) if not attrs.endswith("/") else None
            at = end.end() if end else (at if attrs.endswith("/") else size)
            continue
        if tag in CLOSES:
            shut, fence = CLOSES[tag]
            if last(shut | {"p"}) > last(fence):
                leave(last(shut | {"p"}))
        elif block and outer and stack[outer[-1]][0] == "p":
            leave(outer[-1])
        if tag not in VOID and not attrs.endswith("/") and (tag not in SKIPPED or closed(tag, at)):
            enter(tag, attrs)
    flush()
    return blocks


def main_places(blocks: list[Block]) -> list[str]:
    """Where each block lies from the element that holds most of the page's
    prose: in it, before, or after it. An element counts the unlinked
    characters of the longer blocks right below it, and half of those a step
    further down."""
    prose: dict = {}
    for b in blocks:
        size = len(b.text) - b.linked
        box = b.place and b.place.box
        if size >= PROSE:
            prose[box] = prose.get(box, 0) + 2 * size
            if box and box.box:
                prose[box.box] = prose.get(box.box, 0) + size
    main = max(prose, key=prose.get, default=None)
    known, out, seen = {None: main is None, main: True}, [], False
    for b in blocks:
        new, place = [], b.place
        while place not in known:
            new.append(place)
            place = place.up
        inside = known[place]
        known.update(dict.fromkeys(new, inside))
        seen |= inside
        out.append("in" if inside else "after" if seen else "before")
    return out


def own_features(blocks: list[Block]) -> list[list[str]]:
    """Features of the blocks' texts, innermost elements and neighbours."""
    out, share = [], []
    boxes: dict = {}  # characters in links and all
    for b in blocks:
        share.append(4 * b.linked // max(1, len(b.text)))
        linked, size = boxes.get(b.place and b.place.box, (0, 0))
        boxes[b.place and b.place.box] = linked + b.linked, size + len(b.text)
    for i, (b, main) in enumerate(zip(blocks, main_places(blocks))):
        words = b.text.count(" ") + 1
        linked, size = boxes[b.place and b.place.box]
        joined = i and (b.place and b.place.box) is (blocks[i - 1].place and blocks[i - 1].place.box)
        f = ["bias", f"words{min(7, words.bit_length())}", f"links{share[i]}", f"box{4 * linked // max(1, size)}", f"main:{main}",
             f"{main}:words{min(7, words.bit_length())}", f"{main}:{'joined' if joined else 'apart'}",
             f"before:{share[i - 1] if i else ''}", f"after:{share[i + 1] if i + 1 < len(blocks) else ''}",
             "ends" if b.text[-1] in ".!?:;\"'”»)" else "open", f"first{min(i, 3)}", f"last{min(len(blocks) - 1 - i, 3)}"]
        if b.place and b.place.inner:
            f.append(f"in:{b.place.inner}")
        if "©" in b.text or "|" in b.text:
            f.append("marks")
        out.append(f)
    return out


def features(blocks: list[Block]) -> list[list[str]]:
    """All features: the blocks' own and those of the elements around them."""
    out = own_features(blocks)
    for f, b in zip(out, blocks):
        place = b.place
        while place:
            f += place.told
            place = place.up
    return out


class Chain:
    """A two-label chain: score of label 1 over 0 by feature, and of label pairs."""

    def __init__(self):
        self.w: dict[str, float] = {}
        self.t = [[0.0, 0.0], [0.0, 0.0]]

    def scores(self, feats: list[list[str]]) -> list[float]:
        get = self.w.get
        return [sum(get(x, 0.0) for x in f) for f in feats]

    def block_scores(self, blocks: list[Block]) -> list[float]:
        """``scores(features(blocks))``, with the score of an element's surroundings computed once."""
        get, known = self.w.get, {None: 0.0}
        out = self.scores(own_features(blocks))
        for i, b in enumerate(blocks):
            new, place = [], b.place
            while place not in known:
                new.append(place)
                place = place.up
            for place in reversed(new):
                known[place] = known[place.up] + sum(get(x, 0.0) for x in place.told)
            out[i] += known[b.place]
        return out

    def decode(self, feats: list[list[str]]) -> list[int]:
        return self.best_labels(self.scores(feats))

    def best_labels(self, scores: list[float]) -> list[int]:
        """Viterbi: the labels of the best way through the chain."""
        best, back = (0.0, 0.0), []
        t = self.t
        for i, s in enumerate(scores):
            if i:
                up0, up1 = best[0] + t[0][0], best[1] + t[1][0]
                down0, down1 = best[0] + t[0][1], best[1] + t[1][1]
                back.append((int(up1 > up0), int(down1 > down0)))
                best = max(up0, up1), max(down0, down1) + s
            else:
                best = 0.0, s
        label = int(best[1] > best[0])
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1] if scores else []

    def marginals(self, feats):
        """(P(label 1) of each block, expected label pairs), in log space."""
        s, t, n = self.scores(feats), self.t, len(feats)
        add = lambda a, b: max(a, b) + math.log1p(math.exp(-abs(a - b)))
        fwd = [(0.0, s[0])]
        for i in range(1, n):
            a, b = fwd[-1]
            fwd.append((add(a + t[0][0], b + t[1][0]), add(a + t[0][1], b + t[1][1]) + s[i]))
        back = [(0.0, 0.0)]
        for i in range(n - 1, 0, -1):
            a, b = back[-1][0], back[-1][1] + s[i]
            back.append((add(t[0][0] + a, t[0][1] + b), add(t[1][0] + a, t[1][1] + b)))
        back.reverse()
        z = add(*fwd[-1])
        one = [math.exp(f[1] + b[1] - z) for f, b in zip(fwd, back)]
        pairs = [[0.0, 0.0], [0.0, 0.0]]
        for i in range(1, n):
            for x in (0, 1):
                for y in (0, 1):
                    pairs[x][y] += math.exp(fwd[i - 1][x] + t[x][y] + (s[i] if y else 0.0) + back[i][y] - z)
        return one, pairs

    def fit(self, pages: list[tuple[list[list[str]], list[int]]], epochs: int = 6, rate: float = 0.3,
            decay: float = 1e-3, seed: int = 1) -> Chain:
        """Adagrad on the log-likelihood, a page at a time."""
        rng, seen, seen_t = random.Random(seed), {}, [[1e-6, 1e-6], [1e-6, 1e-6]]
        for _ in range(epochs):
            for k in rng.sample(range(len(pages)), len(pages)):
                feats, labels = pages[k]
                one, pairs = self.marginals(feats)
                step: dict[str, float] = {}
                for f, y, p in zip(feats, labels, one):
                    for x in f:
                        step[x] = step.get(x, 0.0) + y - p
                for x, g in step.items():
                    g -= decay * self.w.get(x, 0.0)
                    seen[x] = seen.get(x, 1e-6) + g * g
                    self.w[x] = self.w.get(x, 0.0) + rate * g / math.sqrt(seen[x])
                for x, y in zip(labels, labels[1:]):
                    pairs[x][y] -= 1
                for x in (0, 1):
                    for y in (0, 1):
                        g = -pairs[x][y] - decay * self.t[x][y]
                        seen_t[x][y] += g * g
                        self.t[x][y] += rate * g / math.sqrt(seen_t[x][y])
        return self


#: Page shells: wrappers of each part, as (opening, closing) tags; words of class and id names.
SHELLS = {
    "header": ("header", "div:header masthead top banner branding site-header page-header"),
    "nav": ("nav", "div:nav navbar menu navigation topnav main-menu breadcrumb breadcrumbs", "ul:menu nav nav-list"),
    "notice": ("div:notice cookie consent alert banner gdpr cookie-notice privacy-notice", "aside:notice alert", "section:notice cookie-banner", "dialog"),
    "ad": ("div:ad ads advert advertisement sponsored promo promoted banner-ad ad-slot", "aside:ad advert promo", "section:advertisement sponsored"),
    "sidebar": ("aside", "div:sidebar side widget rail related recommended popular side-bar", "section:related recommended", "aside:sidebar related"),
    "form": ("form", "form:search login newsletter subscribe signup contact", "div:newsletter subscribe signup search-form"),
    "comments": ("section:comments replies", "div:comments comment-list comment discussion responses replies reader-comments", "ol:commentlist comments"),
    "share": ("div:share social sharing tools actions", "ul:share social", "p:share"),
    "author": ("div:author bio byline about-author author-box", "section:author bio", "aside:author"),
    "footer": ("footer", "center", "div:footer site-footer copyright legal bottom", "section:footer"),
    "article": ("article", "main", "div:content post entry article article-body story body text main-content post-content entry-content", "section:content article story",
                "article:post entry", "main:content main", "div"),
}
SENTENCES = ["The first of them came early.", "Nobody had seen it before.", "It is a long way from here to the coast.",
             "What follows was written down later.", "They left the house and went on.", "There was little to add."]


SYLLABLES = "ba ce di fo gu ha ke li mo nu pa re si to vu za".split()


def wrapped(rng: random.Random, kind: str, inner: str, named: bool = True) -> str:
    """``inner`` in a shell of its kind; if not ``named``, under a name that says nothing."""
    tag, _, names = rng.choice(SHELLS[kind]).partition(":")
    if names and not named:
        tag, names = rng.choice((tag, "div")), "".join(rng.choices(SYLLABLES, k=3))
    name = f' {rng.choice(("class", "class", "id"))}="{rng.choice(names.split())}"' if names else ""
    return f"<{tag}{name}>{inner}</{tag}>"


def labelled_page(rng: random.Random, texts: list[str], unnamed: float = 0.0) -> tuple[str, list[int]]:
    """A page and its blocks' labels (1: the article's). With probability
    ``unnamed`` its shells have names that say nothing, so the chain must
    learn from the page's structure, too."""
    out, labels = [], []
    named = rng.random() >= unnamed
    pick = lambda: entities.escape(rng.choice(texts))
    short = lambda: entities.escape(" ".join(rng.choice(texts).split()[:rng.randint(1, 8)]) or "x")

    def junk(kind: str) -> str:
        if kind in ("nav", "footer") and rng.random() < 0.7 or kind == "sidebar" and rng.random() < 0.5:
            n = rng.randint(2, 8)
            tag = rng.choice(("li", "li", "div", "p"))
            links = "".join(f'<{tag}><a href="/{i}">{short()}</a></{tag}>' for i in range(n))
            labels.extend([0] * n)
            return wrapped(rng, kind, f"<ul>{links}</ul>" if tag == "li" else links, named)
        if kind == "form":
            labels.extend([0, 0])
            return wrapped(rng, kind, f"<p><label>{short()}</label> <input name=q></p><button>{short()}</button>", named)
        if kind == "comments":
            n = rng.randint(1, 5)
            head = f"<h3>{short()}</h3>" if rng.random() < 0.5 else ""
            labels.extend([0] * (n + bool(head)))
            tag = rng.choice(("p", "div", "li"))
            if rng.random() < 0.5:  # a shell for each, with its writer's name
                labels.extend([0] * n)
                return wrapped(rng, kind, head + "".join(
                    wrapped(rng, "comments", f"<p>{short()}</p><{tag}>{pick()}</{tag}>", named) for _ in range(n)), named)
            return wrapped(rng, kind, head + "".join(f"<{tag}>{pick()}</{tag}>" for _ in range(n)), named)
        if kind == "share":
            labels.append(0)
            return wrapped(rng, kind, " ".join(rng.choice(("<a href=#>%s</a>", "<span>%s</span>")) % short() for _ in range(rng.randint(1, 4))), named)
        n = rng.randint(1, 2)
        labels.extend([0] * n)
        text = [f"&copy; {short()}" if kind == "footer" else rng.choice((pick, short))() for _ in range(n)]
        return wrapped(rng, kind, "".join(f"<p>{t}</p>" for t in text) if n > 1 or rng.random() < 0.4 else text[0], named)

    for kind in ("header", "nav", "notice", "ad"):
        if rng.random() < (0.8 if kind == "nav" else 0.5):
            out.append(junk(kind))
    body = []
    if rng.random() < 0.85:
        body.append(f"<h1>{short()}</h1>")
        labels.append(1)
    for _ in range(rng.randint(1, 10)):
        r = rng.random()
        if r < 0.08:
            body.append(junk(rng.choice(("ad", "sidebar", "form", "notice", "share"))))
            continue
        if r < 0.2:
            n = rng.randint(2, 4)
            tag = rng.choice(("ul", "ol"))
            body.append(f"<{tag}>" + "".join(f"<li>{rng.choice((pick, short))()}</li>" for _ in range(n)) + f"</{tag}>")
            labels.extend([1] * n)
            continue
        tag = "h2" if r < 0.3 else "blockquote" if r < 0.35 else "pre" if r < 0.38 else "div" if r < 0.42 else "p"
        text = short() if tag == "h2" else pick()
        body.append(f"<{tag}>{text}" + (f"</{tag}>" if tag != "p" or rng.random() < 0.8 else ""))
        labels.append(1)
    inner = "".join(body)
    if rng.random() < 0.1 and len(body) > 3:  # the article in sections
        cut = rng.randint(1, len(body) - 1)
        inner = "".join(f"<section>{''.join(x)}</section>" for x in (body[:cut], body[cut:]))
    out.append(wrapped(rng, "article", inner, named))
    for kind in ("share", "author", "comments", "sidebar", "ad", "form", "footer"):
        if rng.random() < (0.8 if kind == "footer" else 0.4):
            out.append(junk(kind))
    return f"<html><head><title>{short()}</title></head><body>{''.join(out)}</body></html>", labels


def train(pages: DataFrame, *, html: str = "html", sample: int = 200, longest: int = 100_000, made: int = 1_500,
          seed: int = 11) -> Chain:
    """A chain fitted on ``made`` labelled pages, laid out from the texts of at
    most ``sample`` pages (by seeded hash, of ``longest`` characters at most)."""
    rows = pages.where(F.length(html) <= longest).select(F.col(html).cast("string").alias("h")).withColumn("_h", seeded(seed, "h"))
    # The hashes are chosen first, so only the sample's pages reach the driver, and copies count once.
    least = [r["_h"] for r in rows.select("_h").distinct().orderBy("_h").limit(sample).collect()]
    rows = rows.where(F.col("_h") <= max(least, default=-1)).groupBy("_h").agg(F.min("h").alias("h")).collect()
    texts = sorted({b.text for r in rows for b in leaf_blocks(r["h"])}) or SENTENCES
    rng, out = random.Random(seed), []
    while len(out) < made:
        page, labels = labelled_page(rng, texts, UNNAMED)
        blocks = leaf_blocks(page)
        if len(blocks) == len(labels):  # a text without letters of its own may leave no block
            out.append((features(blocks), labels))
    return Chain().fit(out)


_chains: dict = {}  # by model: a worker's chain


def extractor(model_id: str, told):
    def run(batches):
        if model_id not in _chains:
            _chains.clear()
            chain = _chains[model_id] = Chain()
            chain.w, chain.t = told.value
        chain = _chains[model_id]
        for b in batches:
            texts, kept = [], []
            for page in b.column("_html").to_pylist():
                blocks = leaf_blocks(page) if page else []
                chosen = [x.text for x, y in zip(blocks, chain.best_labels(chain.block_scores(blocks))) if y]
                texts.append(" ".join(chosen))
                kept.append(len(chosen))
            names = [c for c in b.schema.names if c != "_html"]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64()), pa.array(kept, pa.int64())],
                                             [*names, "text", "n_chars", "n_blocks"])
    return run


def extract(pages: DataFrame, *, html: str = "html", keep: tuple = ("page_id", "url"), model: Chain | None = None) -> DataFrame:
    """The columns ``keep`` plus text, n_chars and n_blocks (kept) of every page.

    Null and empty pages, and pages without article blocks, have an empty
    text. White space inside a block becomes one space, blocks are joined in
    page order by one space, nothing is cut off; very long pages are read
    whole. Repeated rows give repeated results; an empty table gives an empty
    result; extra columns are ignored unless kept, and kept columns named
    like a result column are replaced.
    """
    spark = pages.sparkSession
    ship(spark)
    chain = model or train(pages, html=html)
    told = spark.sparkContext.broadcast((chain.w, chain.t))
    names = [c for c in keep if c not in ("text", "n_chars", "n_blocks")]
    rows = pages.select(*[F.col(f"`{c}`") for c in names], F.col(html).cast("string").alias("_html"))
    schema = rows.drop("_html").schema.add("text", "string").add("n_chars", "long").add("n_blocks", "long")
    return rows.mapInArrow(extractor(uuid.uuid4().hex, told), schema)

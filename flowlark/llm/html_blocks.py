"""Main-text extraction by a recurrent block labeller.

A page is cut into leaf blocks: runs of text between block-level tags, each with its
tag path (names, classes and ids from the root) and its words. A bidirectional LSTM
in numpy reads the blocks of a page in order; path tokens and words enter as hashed
vectors, with a few measures of the text. Every block is kept or dropped by what it
says together with the whole page before and after it.

The network is trained here, once per process, on ``TRAINING_PAGES`` pages drawn
from a grammar of page layouts with known main text; the pages of the table are
only read. In half of the layouts the main text has no telling element around it: a plain
or oddly named one, a cell of a table, or none. Names are dropped from paths at random
while training, so that texts and neighbours must decide where names do not. The draw is
fixed by a seed, so reruns agree.

Text: character references are decoded, white space inside a block is one space, kept
blocks are joined by one space. Scripts, styles, templates and comments are no text.
A self-closed svg is empty; an unclosed element without text ends with its parent, an
svg also where a tag of HTML begins. Only scripts and styles run to the end of the page.

Defined results: a null or empty page, or one without kept blocks, has an empty text;
broken markup is read as far as it goes; repeated rows give repeated results; an empty
table gives an empty result.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlark.llm.common import SPACED, hashed_words, slices, text_bytes

TRAINING_PAGES = 2400
EPOCHS = 8
#: Share of names in paths that training does not see.
UNSEEN = 0.15
PATH_SLOTS, PATH_SIZE = 2048, 24
WORD_SLOTS, WORD_SIZE = 1024, 8
MEASURES = 7
HIDDEN = 20
#: Padded blocks of a batch of pages.
BATCH_BLOCKS = 60_000

# Fixed values of HTML: elements inside a line, without content, and without text.
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style"
SILENT = set("template noscript svg iframe object".split())
#: Tags that end an open svg, unless one of the elements with HTML inside is open in it.
BREAKS = set(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu "
    "meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
FOREIGN = set("foreignobject desc title".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = set("ul ol dl table div section article main aside body form".split())

TOKEN = re.compile(
    rf"<!--.*?(?:-->|$)|<(?P<raw>{RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|$)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>",
    re.S | re.I,
)
NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
PARTS = re.compile(r"[a-z]+|[0-9]+")
MARK = re.compile(r"data-(keep|drop)\b")


@dataclass
class Page:
    paths: list[tuple[str, ...]] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    links: list[float] = field(default_factory=list)
    labels: list[int] = field(default_factory=list)


@lru_cache(maxsize=4096)
def _tokens(name: str, rest: str) -> tuple[str, ...]:
    out = [name]
    for m in NAMED.finditer(rest):
        value = (m[2] or m[3] or m[4] or "").lower()
        out += [f".{x}" for x in PARTS.findall(value) if not x.isdigit()]
    return tuple(out)


def blocks(source: str) -> Page:
    """Leaf blocks of a page in order."""
    page = Page()
    stack: list[tuple[str, tuple[str, ...], int]] = []  # name, path so far, label
    pieces: list[str] = []
    linked, in_link = 0, False
    inlines: list[str] = []  # open inline elements since the last block tag
    hidden: list[str] = []  # open elements from the outermost one without text

    def flush():
        nonlocal pieces, linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                page.paths.append(stack[-1][1] if stack else ())
                page.texts.append(text)
                page.links.append(min(1.0, linked / max(len(text), 1)))
                page.labels.append(stack[-1][2] if stack else 0)
            pieces, linked = [], 0

    def text_between(a: int, b: int):
        nonlocal linked
        if a < b and not hidden:
            pieces.append(source[a:b])
            if in_link:
                linked += b - a

    at = 0
    for m in TOKEN.finditer(source):
        text_between(at, m.start())
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if hidden:
            if m["end"]:
                if name in hidden:
                    del hidden[len(hidden) - 1 - hidden[::-1].index(name) :]
                    continue
                if name not in inlines and all(name != own for own, _, _ in stack):
                    continue
                hidden.clear()  # the end of an element around it
            elif hidden[0] == "svg" and name in BREAKS and not FOREIGN & set(hidden) and SILENT.isdisjoint(hidden[1:]):
                hidden.clear()
            else:
                if name not in VOID and not m["rest"].endswith("/"):
                    hidden.append(name)
                continue
        if name in SILENT and not m["end"]:
            if name != "svg" or not m["rest"].endswith("/"):
                hidden.append(name)
        elif name == "br":
            pieces.append(" ")
        elif name in INLINE:
            if name == "a":
                in_link = not m["end"]
            if not m["end"]:
                inlines.append(name)
            elif name in inlines:
                del inlines[len(inlines) - 1 - inlines[::-1].index(name) :]
        elif m["end"]:
            flush()
            in_link = False
            inlines.clear()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
        else:
            flush()
            in_link = False
            inlines.clear()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in CLOSES.get(name, ()) or name not in INLINE and stack[i][0] == "p":
                    del stack[i:]
                    break
                if stack[i][0] in SCOPES:
                    break
            if name not in VOID and not m["rest"].endswith("/"):
                path, label = (stack[-1][1], stack[-1][2]) if stack else ((), 0)
                mark = MARK.search(m["rest"]) if "data-" in m["rest"] else None
                label = label if mark is None else int(mark[1] == "keep")
                stack.append((name, path + _tokens(name, m["rest"]), label))
    text_between(at, len(source))
    flush()
    return page


# --- vectors ----------------------------------------------------------------------------


def _slot(token: str) -> int:
    return xxhash.xxh3_64_intdigest(token.encode()) % PATH_SLOTS


@dataclass
class Vectors:
    """Hashed tokens of blocks, flat, and measures."""

    path_slots: np.ndarray
    path_of: np.ndarray  # distinct path of each slot
    block_path: np.ndarray  # distinct path of each block
    word_slots: np.ndarray
    word_firsts: np.ndarray
    measures: np.ndarray


def vectors(pages: list[Page]) -> Vectors:
    seen: dict[tuple[str, ...], int] = {}
    block_path = [seen.setdefault(p, len(seen)) for page in pages for p in page.paths]
    slots, of = [], []
    for path, i in seen.items():
        # The last steps once more, by their place: near tags tell most.
        named = {_slot(t) for t in path} | {_slot(f"{d}{t}") for d, t in enumerate(path[::-1][:3])}
        slots += sorted(named)
        of += [i] * len(named)
    texts = [t for page in pages for t in page.texts]
    data, starts = text_bytes(pa.array(texts, pa.large_string()))
    words, firsts = hashed_words(data, starts, SPACED)
    counts = np.diff(firsts)
    ends = np.array([t[-1] in ".!?…:;\"'»”)" for t in texts], float)
    place = np.concatenate([np.linspace(0, 1, len(p.texts)) for p in pages if p.texts] or [np.zeros(0)])
    links = np.array([x for page in pages for x in page.links])
    sizes = np.diff(starts)
    measures = np.stack(
        [np.log1p(counts) / 4, np.log1p(sizes) / 6, links, ends, place, counts < 6, links > 0.8], axis=1
    )
    return Vectors(
        np.array(slots, np.int64), np.array(of, np.int64), np.array(block_path, np.int64),
        (words % np.uint64(WORD_SLOTS)).astype(np.int64), firsts, measures.astype(np.float32),
    )


def _mean_rows(table: np.ndarray, slots: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Mean of table rows per run of slots; runs may be empty."""
    counts = np.diff(firsts)
    out = np.zeros((len(counts), table.shape[1]), np.float32)
    full = np.flatnonzero(counts)
    if len(full):
        out[full] = np.add.reduceat(table[slots], firsts[:-1][full], axis=0) / counts[full, None]
    return out


def _inputs(p: dict, v: Vectors) -> np.ndarray:
    firsts = np.searchsorted(v.path_of, np.arange((v.path_of[-1] + 1 if len(v.path_of) else 0) + 1))
    paths = _mean_rows(p["path"], v.path_slots, firsts) * 3
    at = np.minimum(v.block_path, max(len(paths) - 1, 0))
    own = paths[at] if len(paths) else np.zeros((len(at), PATH_SIZE), np.float32)
    own = np.where((v.block_path < len(paths))[:, None], own, 0)
    return np.concatenate([own, _mean_rows(p["word"], v.word_slots, v.word_firsts), v.measures], axis=1)


# --- the network ------------------------------------------------------------------------


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def _run(w: dict, way: str, x: np.ndarray, mask: np.ndarray, keep: bool = False):
    """One direction over (steps, pages, inputs); returns states and, kept, the gates."""
    steps, pages, _ = x.shape
    order = range(steps) if way == "f" else range(steps - 1, -1, -1)
    drive = x @ w[f"{way}x"] + w[f"{way}b"]
    h = np.zeros((pages, HIDDEN), np.float32)
    c = np.zeros_like(h)
    states = np.zeros((steps, pages, HIDDEN), np.float32)
    trace = []
    for t in order:
        g = drive[t] + h @ w[f"{way}h"]
        i, f, o = (_sigmoid(g[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        a = np.tanh(g[:, 3 * HIDDEN :])
        m = mask[t][:, None]
        fresh = f * c + i * a
        squashed = np.tanh(fresh)
        if keep:
            trace.append((t, i, f, o, a, c, h, squashed, m))
        c = np.where(m, fresh, c)
        h = np.where(m, o * squashed, h)
        states[t] = h
    return states, trace


def _back(w: dict, way: str, x: np.ndarray, trace, ds: np.ndarray, grad: dict) -> np.ndarray:
    dx = np.zeros_like(x)
    dh = np.zeros_like(trace[0][6])
    dc = np.zeros_like(dh)
    for t, i, f, o, a, c, h, squashed, m in reversed(trace):
        total = dh + ds[t]
        go = np.where(m, total, 0)
        inner = np.where(m, dc, 0) + go * o * (1 - squashed**2)
        dg = np.concatenate(
            [inner * a * i * (1 - i), inner * c * f * (1 - f), go * squashed * o * (1 - o), inner * i * (1 - a**2)],
            axis=1,
        )
        grad[f"{way}x"] += x[t].T @ dg
        grad[f"{way}h"] += h.T @ dg
        grad[f"{way}b"] += dg.sum(0)
        dx[t] = dg @ w[f"{way}x"].T
        dh = dg @ w[f"{way}h"].T + np.where(m, 0, total)
        dc = np.where(m, inner * f, dc)
    return dx


def _padded(rows: np.ndarray, lengths: list[int]):
    steps = max(lengths)
    x = np.zeros((steps, len(lengths), rows.shape[1]), np.float32)
    mask = np.zeros((steps, len(lengths)), bool)
    at = 0
    for p, n in enumerate(lengths):
        x[:n, p], mask[:n, p] = rows[at : at + n], True
        at += n
    return x, mask


def _scores(p: dict, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
    both = np.concatenate([_run(p, way, x, mask)[0] for way in "fb"], axis=2)
    return both @ p["out"] + x @ p["direct"] + p["bias"]


def _start() -> dict[str, np.ndarray]:
    draw = np.random.default_rng(3)
    n = PATH_SIZE + WORD_SIZE + MEASURES
    p = {"path": draw.normal(0, 0.3, (PATH_SLOTS, PATH_SIZE)), "word": draw.normal(0, 0.1, (WORD_SLOTS, WORD_SIZE)),
         "out": draw.normal(0, 0.2, 2 * HIDDEN), "direct": np.zeros(n), "bias": np.zeros(1)}
    for way in "fb":
        p[f"{way}x"] = draw.normal(0, n**-0.5, (n, 4 * HIDDEN))
        p[f"{way}h"] = draw.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
        p[f"{way}b"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
    return {k: v.astype(np.float32) for k, v in p.items()}


def _gradients(p: dict, pages: list[Page]) -> dict[str, np.ndarray]:
    v = vectors(pages)
    rows = _inputs(p, v)
    x, mask = _padded(rows, [len(g.texts) for g in pages])
    y = _padded(np.array([l for g in pages for l in g.labels], np.float32)[:, None], [len(g.texts) for g in pages])[0][..., 0]
    grad = {k: np.zeros_like(a) for k, a in p.items()}
    forth = {way: _run(p, way, x, mask, keep=True) for way in "fb"}
    both = np.concatenate([forth["f"][0], forth["b"][0]], axis=2)
    d = (_sigmoid(both @ p["out"] + x @ p["direct"] + p["bias"]) - y) * mask / len(pages)
    grad["out"] = np.einsum("tp,tph->h", d, both)
    grad["direct"] = np.einsum("tp,tph->h", d, x)
    grad["bias"] = d.sum(keepdims=True)[0]
    dx = d[..., None] * p["direct"]
    ds = d[..., None] * p["out"]
    dx = dx + _back(p, "f", x, forth["f"][1], ds[..., :HIDDEN], grad)
    dx = dx + _back(p, "b", x, forth["b"][1], ds[..., HIDDEN:], grad)
    flat = dx.transpose(1, 0, 2)[mask.T]
    counts = np.bincount(v.path_of, minlength=int(v.block_path.max()) + 1)
    by_path = np.zeros((len(counts), PATH_SIZE), np.float32)
    np.add.at(by_path, v.block_path, flat[:, :PATH_SIZE] * 3)
    np.add.at(grad["path"], v.path_slots, by_path[v.path_of] / counts[v.path_of][:, None])
    words = np.diff(v.word_firsts)
    each = flat[:, PATH_SIZE : PATH_SIZE + WORD_SIZE] / np.maximum(words, 1)[:, None]
    np.add.at(grad["word"], v.word_slots, np.repeat(each, words, axis=0))
    return grad


def _without_names(page: Page, draw: np.random.Generator) -> Page:
    """The page with some of its names left out, the same ones in all paths."""
    names = sorted({t for path in page.paths for t in path if t[0] == "."})
    gone = {t for t, x in zip(names, draw.random(len(names))) if x < UNSEEN}
    paths = [tuple(t for t in path if t not in gone) for path in page.paths]
    return Page(paths, page.texts, page.links, page.labels)


@lru_cache(maxsize=1)
def trained(pages: int = TRAINING_PAGES, epochs: int = EPOCHS, seed: int = 1) -> dict[str, np.ndarray]:
    """The network after Adam over drawn pages."""
    draw = np.random.default_rng(seed)
    drawn = [blocks(draw_page(draw)) for _ in range(pages)]
    p = _start()
    first = {k: np.zeros_like(a) for k, a in p.items()}
    second = {k: np.zeros_like(a) for k, a in p.items()}
    step = 0
    for _ in range(epochs):
        order = draw.permutation(pages)
        for at in range(0, pages, 25):
            step += 1
            grad = _gradients(p, [_without_names(drawn[i], draw) for i in order[at : at + 25]])
            for k, g in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                slower = 1 - 0.97 * step / (epochs * -(-pages // 25))
                rate = 0.012 * slower * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                p[k] = (p[k] - rate * first[k] / (np.sqrt(second[k]) + 1e-6)).astype(np.float32)
    return p


def kept_blocks(p: dict, pages: list[Page]) -> list[np.ndarray]:
    """Which blocks of each page belong to the main text."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((i for i, g in enumerate(pages) if g.texts), key=lambda i: len(pages[i].texts))
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end + 1 - at) * len(pages[order[end]].texts) <= BATCH_BLOCKS:
            end += 1
        chosen = [pages[i] for i in order[at:end]]
        x, mask = _padded(_inputs(p, vectors(chosen)), [len(g.texts) for g in chosen])
        scores = _scores(p, x, mask)
        for n, i in enumerate(order[at:end]):
            out[i] = scores[: len(pages[i].texts), n] > 0
        at = end
    return out


def extract_text(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """Per page: key, url, text, n_chars and its number of blocks and kept blocks."""
    rows = pages.select(F.col(source).alias("_html"), F.col(key).alias("page_id"), F.col(url).alias("url"))
    shared = pages.sparkSession.sparkContext.broadcast(trained())  # fixed size

    def run(batches):
        for batch in batches:
            for part in slices(batch, 0):
                found = [blocks(h or "") for h in part.column(0).to_pylist()]
                kept = kept_blocks(shared.value, found)
                texts = [" ".join(t for t, k in zip(g.texts, ks) if k) for g, ks in zip(found, kept)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[1:],
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.array([len(g.texts) for g in found], pa.int64()),
                        pa.array([int(k.sum()) for k in kept], pa.int64()),
                    ],
                    names=["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"],
                )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(run, f"{kinds}, text string, n_chars long, n_blocks long, n_kept long")


# --- pages to learn from ----------------------------------------------------------------

# Usual class names and phrases of page parts.
NAMES = {
    "header": "header masthead top site-header banner topbar brand logo",
    "menu": "nav menu navbar navigation breadcrumb main-menu links topnav pagination toc",
    "footer": "footer site-footer bottom colophon copyright legal foot",
    "side": "sidebar side widget related rail recommended popular trending",
    "notice": "notice cookie consent alert gdpr banner-message popup modal warning",
    "ad": "ad ads advert advertisement sponsored promo promoted adbox banner-ad",
    "form": "form newsletter subscribe signup login search contact search-box",
    "comments": "comments comment-list comment responses discussion disqus replies",
    "share": "share social sharing follow tools meta byline-tools tags",
    "main": "content main article post entry-content story body-text post-body article-body text page-content",
    "frame": "wrapper container row col page layout inner outer grid site",
}
#: Small words of some languages, which stand in main text as well as in phrases.
COMMON = (
    "the of and to in a is that for it as was with on by this be are from at or an have not all we you our your "
    "der die und das in den ist mit von zu auf ein für nicht le la les de des et en un une que pour dans sur est "
    "el los que y a con por se del una"
).split()
PHRASES = {
    "menu": "home|about|contact|news|products|blog|sign in|help|next|previous|archive|search",
    "footer": "© 2020 all rights reserved|terms of use|privacy policy|powered by|contact us|imprint|copyright 2018|copyright 2021 ltd all rights reserved|all rights reserved",
    "notice": "we use cookies to improve your experience|accept all|please enable javascript|this site uses cookies",
    "ad": "advertisement|sponsored|buy now|limited offer|click here",
    "form": "subscribe to our newsletter|your email|submit|log in|search|password|send",
    "comments": "reply|says:|posted by|2 comments|leave a comment|report",
    "share": "share|tweet|follow us|print|email this",
    "side": "related articles|most read|popular posts|recommended",
    "header": "welcome|the daily|menu|sign in|skip to content",
}


def draw_page(draw: np.random.Generator) -> str:
    """A page of a random layout; marks tell main text from the rest."""
    syllables = [a + b for a in "b d f g k l m n p r s t v z".split() for b in "a e i o u é ä".split()]
    pick = lambda seq: seq[draw.integers(len(seq))]
    chance = lambda p: draw.random() < p

    often = pick([0.0, 0.3, 0.5])
    joint = pick([" | ", " / ", " - ", "*** ", "### ", "%%% ", " &amp;&amp; "]) if chance(0.12) else " "

    def word():
        return "".join(pick(syllables) for _ in range(draw.integers(1, 5)))

    def words(n):
        return " ".join(pick(COMMON) if chance(often) else word() for _ in range(n))

    def prose(low=3, high=60):
        text = joint.join(words(1) for _ in range(draw.integers(low, high))).capitalize()
        if chance(0.2):
            at = draw.integers(len(text))
            text = f"{text[:at]} <b>{word()}</b> {text[at:]}"
        if chance(0.15):
            text += f' <a href="/{word()}">{words(2)}</a> {words(4)}'
        return text + pick([".", ".", ".", "!", "?", "", " &amp;"])

    def odd():
        letters = "abcdefghjkmnpqrstuvwxyz0123456789"
        return pick(["css-", "sc-", "", "x", "_"]) + "".join(pick(letters) for _ in range(draw.integers(2, 8)))

    def named(kind, tags, mark="", outer=True):
        tag = pick(tags.split())
        if outer and layout != "named" and kind in ("menu", "header", "footer", "share", "form") and chance(0.7):
            tag = pick(["div", "div", "center", "section"]) if layout != "cell" else "td"
            return tag, f"<{tag} {'' if chance(0.5) else f'class={odd()}'} {mark}>"
        styles = [f'class="{pick(NAMES[kind].split())}"', f'id="{pick(NAMES[kind].split())}"',
                  f'class="{pick(NAMES["frame"].split())} {pick(NAMES[kind].split())}"']
        plain = tag not in ("div", "section", "ul", "span", "p") and chance(0.5)
        return tag, f"<{tag} {'' if plain else pick(styles)} {mark}>"

    def listing(kind):
        n = draw.integers(2, 9)
        text = lambda: pick(PHRASES[kind].split("|")) if chance(0.4) else words(draw.integers(1, 4))
        if chance(0.7):
            return "<ul>" + "".join(f'<li><a href="/{word()}">{text()}</a>{pick(["</li>", "</li>", ""])}' for _ in range(n)) + "</ul>"
        between = pick([" | ", " ", "<br>", " · "])
        return between.join(f'<a href="/{word()}">{text()}</a>' for _ in range(n))

    def part(kind, outer=True):
        tags = {"menu": "nav nav div ul", "header": "header header div", "footer": "footer footer div", "side": "aside aside div section",
                "notice": "div div section", "ad": "div div aside section", "form": "form form div", "comments": "section div ol div",
                "share": "div ul p"}[kind]
        tag, head = named(kind, tags, "data-drop", outer)
        body = ""
        nameless = outer and layout != "named" and kind in ("menu", "header", "footer", "share", "form")
        if kind == "menu" or kind in ("side", "footer", "share", "header") and chance(0.9 if nameless else 0.5):
            body += listing(kind)
        if kind == "form":
            body += f"<label>{pick(PHRASES[kind].split('|'))}</label><input type=text><button>{pick(PHRASES[kind].split('|'))}</button>"
        if kind == "comments":
            body += "".join(f'<div class="{pick(["comment", "reply", "c"])}"><p>{pick([word(), "Posted by " + word()])}</p><p>{prose()}</p></div>'
                            for _ in range(draw.integers(1, 6)))
        if kind in ("notice", "ad", "footer", "side", "header") and not (nameless and body) or not body:
            for _ in range(draw.integers(1, 4 if kind == "side" else 3)):
                said = 1.0 if nameless else 0.3
                text = pick(PHRASES[kind].split("|")) if chance(said) and kind in PHRASES else prose(2, 40)
                if nameless and chance(0.5):
                    text = ". ".join([text.capitalize(), words(2).title(), pick(PHRASES[kind].split("|")).capitalize()]) + pick([".", ""])
                if nameless and kind == "footer" and chance(0.6):
                    text = f"{pick(['Copyright', 'Copyright ©', '©'])} {draw.integers(1995, 2026)} {words(2).title()}{pick([' ', '. '])}All rights reserved."
                body += text if chance(0.5) else f"<p>{text}</p>"
        if nameless and tag not in ("td", "form", "nav") and chance(0.4) and body.startswith(("<ul>", "<p>")):
            return body.replace("<ul>", "<ul data-drop>").replace("<p>", "<p data-drop>")  # no element around it
        return f"{head}{body}</{tag}>"

    def article():
        if layout == "named":
            tag, head = named("main", "article article main div div section", "data-keep")
        elif layout in ("bare", "lines"):
            tag, head = "", ""
        else:
            tag = "td" if layout == "cell" else pick(["div", "div", "section"])
            head = f"<{tag} data-keep class={odd()}>" if layout == "odd" else f"<{tag} data-keep>"
        out = [head]
        if layout == "lines":  # text without elements
            return pick(["<br>", "<br><br>", " ", "\n\n"]).join(prose(5, 60) for _ in range(draw.integers(1, 9)))
        if chance(0.85):
            out.append(f"<h1>{words(draw.integers(2, 10))}</h1>")
        for _ in range(draw.integers(1, 14)):
            kind = draw.random()
            if layout == "named" and chance(0.05):  # what is a phrase elsewhere
                out.append(f"<p>{pick(PHRASES[pick(list(PHRASES))].split('|')).capitalize()}{pick(['', '.'])}</p>")
            if kind < 0.66 and paragraph != "p":
                out.append(f"<{paragraph}>{prose(5)}</{paragraph}>")
            elif kind < 0.66:
                out.append(f"<p>{prose()}{pick(['</p>', '</p>', '</p>', ''])}")
            elif kind < 0.70:
                items = "".join(f'<li><a href="/{word()}">{words(draw.integers(2, 8))}</a></li>' for _ in range(draw.integers(2, 5)))
                out.append(f"<p>{prose(8)}</p><ul>{items}</ul><p>{prose(8)}</p>")
            elif kind < 0.76:
                out.append(f"<h2>{words(draw.integers(1, 6))}</h2>")
            elif kind < 0.82:
                out.append("<ul>" + "".join(f"<li>{prose(2, 15)}</li>" for _ in range(draw.integers(1, 5))) + "</ul>")
            elif kind < 0.86:
                out.append(f"<blockquote>{prose()}</blockquote>")
            elif kind < 0.89:
                out.append(f"<table><tr><td>{words(2)}</td><td>{words(1)}</td></tr></table>")
            elif kind < 0.92:
                out.append(f"<p><b>{prose(3, 12)}<br><p>{prose()}</p>")
            elif kind < 0.94:
                out.append(f"<pre>{words(6)}</pre><figure><figcaption>{prose(3, 10)}</figcaption></figure>")
            else:
                out.append(part(pick(["ad", "form", "share", "notice", "side"]), outer=False))
        return "".join(out) + (f"</{tag}>" if tag else "")

    layout = pick(["named"] * 5 + ["plain", "odd", "bare", "cell", "lines"])
    paragraph = "p" if layout == "named" or chance(0.7) else "div"
    before = [k for k, p in (("notice", 0.3), ("header", 0.6), ("menu", 0.8), ("ad", 0.5), ("form", 0.15), ("side", 0.25)) if chance(p)]
    after = [k for k, p in (("share", 0.3), ("comments", 0.35), ("side", 0.35), ("form", 0.25), ("ad", 0.3), ("menu", 0.15), ("footer", 0.85), ("notice", 0.15)) if chance(p)]
    if layout != "named" and chance(0.5 if layout == "lines" else 0.2):
        before, after = [], []
    parts = [part(k) for k in before], article(), [part(k) for k in after]
    if layout == "cell":
        cells = [x if x.startswith("<td") else f"<td>{x}</td>" for x in (*parts[0], parts[1], *parts[2])]
        body = f"<table><tr>{pick(['', '</tr><tr>']).join(cells)}</tr></table>"
    else:
        body = "".join(parts[0]) + parts[1] + "".join(parts[2])
    for _ in range(draw.integers(0, 3)):
        body = f'<div class="{pick(NAMES["frame"].split())}">{body}</div>'
    head = f"<head><title>{words(4)}</title><style>p{{}}</style><script>var a='</p>';</script></head>" if chance(0.8) else ""
    return f"<!DOCTYPE html><html>{head}<body{' data-keep' if layout in ('bare', 'lines') else ''}>{body}{pick(['</body></html>', ''])}"

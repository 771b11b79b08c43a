"""Main text of web pages: a linear-chain conditional random field over leaf blocks.

A page becomes leaf blocks (text between block-level tags) with features of their ancestor
tags, of class, id and role words, and of the text itself. Two labels, main and other; the
weights maximise the conditional likelihood of labelled pages (forward-backward), and Viterbi
gives each page's labels. The labelled pages are written by `labelled_pages`, whose layouts
name every block's part; the fit takes TRAIN_PAGES of them and no page of the input.

Defined results: a null, empty or textless page gives the empty string and 0; malformed markup
is read as far as it goes; repeated rows are read each; an empty table gives no rows; columns
besides page_id, url and html are not read. Comments, scripts, styles and the like are never
text; nor are the contents of svg, select, object and their like, but one without a close tag loses its
open tag only. Elements may nest to any depth. Inside a block every run of white space, <br> included, is one space.
"""

from __future__ import annotations

import html as _html
import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_PAGES, TRAIN_SEED, ROUNDS = 400, 7, 160

BLOCK_TAGS = frozenset(
    "html head title body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th section article aside nav "
    "header footer main form fieldset legend blockquote pre figure figcaption address hr dialog details summary menu center hgroup "
    "search button select option label textarea iframe canvas svg object video audio".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags whose presence among the ancestors is a feature.
CONTEXT_TAGS = frozenset(
    "head title nav header footer aside article main form section ul ol li dl table h1 h2 h3 h4 p blockquote figure figcaption pre "
    "address dialog button select label fieldset a details menu search".split()
)
_CONTEXT = frozenset(f"in:{t}" for t in CONTEXT_TAGS)
#: Words in class, id or role, by the part of a page that they announce.
PARTS = {
    "menu": "nav navigation navbar menu menubar breadcrumb breadcrumbs toc tabs pagination pager skip topbar".split(),
    "advert": "ad ads adv advert advertisement adverts sponsor sponsored promo promotion banner adsense dfp outbrain taboola affiliate".split(),
    "side": "side sidebar aside widget widgets related recommend recommended rail complementary trending popular more".split(),
    "foot": "foot footer bottom copyright legal colophon contentinfo disclaimer".split(),
    "head": "head header masthead logo branding site top".split(),
    "comment": "comment comments commentlist reply replies respond disqus discussion reader readers thread review reviews responses".split(),
    "notice": "cookie cookies consent notice gdpr alert popup modal overlay newsletter subscribe paywall dialog toast privacy warning signup banner".split(),
    "share": "share sharing social follow tags meta byline author tools print".split(),
    "form": "form login search signin register input contact".split(),
    "main": "content article post story entry main body text page maincontent articlebody prose".split(),
    "hidden": "hidden visuallyhidden sr screenreader offscreen none".split(),
}
_PART_OF = {}
for _part, _words in PARTS.items():
    for _w in _words:
        _PART_OF.setdefault(_w, []).append(_part)
_TEXT_HINT = re.compile(
    r"©|\bcopyright\b|\ball rights reserved\b|\bcookies?\b|\bprivacy\b|\bterms of\b|\bsubscribe\b|\bnewsletter\b|\bsign (?:in|up)\b|\blog ?in\b"
    r"|\bshare\b|\bcomments?\b|\breply\b|\badvertisement\b|\bsponsored\b|\bread more\b|\brelated\b|\bfollow us\b|\bskip to\b",
    re.I,
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|iframe|textarea)(?=[\s/>])[^>]*+>.*?(?:</\1(?=[\s/>])[^>]*+>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:\"[^\"]*+\"|'[^']*+'|[^>\"'])*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>|<[!?/][^>]*+>",
    re.S | re.I,
)
#: Elements that are skipped whole if they have a close tag; without one only the open tag is.
_SKIPPED = frozenset("noscript template svg math select object canvas".split())
_SKIP_TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(/?)(script|{'|'.join(sorted(_SKIPPED))})(?=[\s/>])((?:\"[^\"]*+\"|'[^']*+'|[^>\"'])*+|[^>]*+)>",
    re.S | re.I,
)
_RAW_TAG = re.compile(r"<(/?(?:script|noscript))(?=[\s/>])[^>]*+>", re.I)
_ATTR = re.compile(r"\b(class|id|role|style|hidden|aria-hidden|itemprop)\b(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Opening one of these closes an open one of the same list entry.
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_P_ENDS = BLOCK_TAGS - {"p", "button", "label", "option", "select", "textarea", "body", "html", "head"}
_SCOPE = frozenset("table ul ol dl div section article aside nav header footer main form blockquote td th li body".split())


def _parts(attributes: str) -> frozenset[str]:
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return frozenset()
    found = set()
    for m in _ATTR.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                found.add("hidden")
        elif name == "hidden" or name == "aria-hidden":
            if value.lower() != "false":
                found.add("hidden")
        else:
            for w in _WORDS.findall(value):
                found.update(_PART_OF.get(w.lower(), ()))
    return frozenset(found)


def _skips(page: str) -> dict[int, int]:
    """Where each skipped element with a close tag starts, and where it ends; elements of one name may nest."""
    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    raw: dict[str, list[tuple[int, int]]] = {"script": [], "/script": [], "noscript": [], "/noscript": []}
    for m in _RAW_TAG.finditer(page):
        raw[m[1].lower()].append(m.span())
    at = 0
    while m := _SKIP_TAG.search(page, at):
        at, name = m.end(), (m[2] or "").lower()
        if not name:
            continue
        own = m[3].endswith("/")
        if name in raw:
            if m[1] or name == "script" and own:
                continue
            close, again = (raw[n][k : k + 1] for n in ("/" + name, name) for k in (bisect_left(raw[n], (at, 0)),))
            if name == "script":
                if not close:
                    break
                at = close[0][1]
            elif close and not (again and again < close):
                ends[m.start()] = at = close[0][1]
        elif m[1]:
            if opened.get(name):
                ends[opened[name].pop()] = at
        elif not (own and name in ("svg", "math")):
            opened.setdefault(name, []).append(m.start())
    return ends


def leaf_blocks(page: str) -> list[tuple[str, frozenset[str], float]]:
    """(text, context features, share of characters in links) for each block with text, in order."""
    out: list[tuple[str, frozenset[str], float]] = []
    # open elements: name, class words, and the context features of it and all around it
    stack: list[tuple[str, frozenset[str], frozenset[str]]] = []
    opened: dict[str, int] = {}
    text: list[str] = []
    at, in_link, link_chars, context = 0, 0, 0, None

    def flush():
        nonlocal link_chars, context
        if text:
            s = " ".join(_html.unescape("".join(text)).split())
            if s:
                if context is None:
                    context = stack[-1][2] | {f"own:{stack[-1][0]}"} if stack else frozenset()
                out.append((s, context, min(1.0, link_chars / max(1, len(s)))))
            text.clear()
        link_chars = 0

    def push(name, parts):
        around = stack[-1][2] if stack else frozenset()
        own = {f"in:{name}"} & _CONTEXT | {f"part:{p}" for p in parts}
        stack.append((name, parts, around if own <= around else around | own))
        opened[name] = opened.get(name, 0) + 1

    def close(k):
        for x in stack[k:]:
            opened[x[0]] -= 1
        del stack[k:]

    skips = _skips(page)
    while m := _TOKEN.search(page, at):
        if m.start() > at:
            piece = page[at : m.start()]
            text.append(piece)
            if in_link:
                link_chars += len(piece)
        at = skips.get(m.start(), m.end())
        name = (m[3] or m[6] or "").lower()
        if not name or name in _SKIPPED:
            continue
        closing = bool(m[2] or m[5])
        if name == "br":
            text.append(" ")
            continue
        if name == "a":
            in_link = 0 if closing else 1
            continue
        if name not in BLOCK_TAGS:
            continue
        flush()
        context, in_link = None, 0
        if name in VOID_TAGS:
            continue
        if closing:
            if opened.get(name):
                close(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name))
            continue
        ends = _CLOSES.get(name, frozenset()) | ({"p"} if name in _P_ENDS else frozenset())
        if any(opened.get(e) for e in ends):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ends:
                    close(k)
                    break
                if stack[k][0] in _SCOPE:
                    break
        if name == "body" and (opened.get("head") or opened.get("title")):
            kept = [x for x in stack if x[0] not in ("head", "title")]
            close(0)
            for x in kept:
                push(x[0], x[1])
        push(name, _parts(m[4] or m[7] or ""))
    if at < len(page):
        text.append(page[at:])
    flush()
    return out


def features(blocks: list[tuple[str, frozenset[str], float]]) -> list[list[str]]:
    out, n = [], len(blocks)
    for i, (s, context, links) in enumerate(blocks):
        words = s.count(" ") + 1
        f = ["bias", *context]
        f.append(f"words:{0 if words <= 2 else 1 if words <= 6 else 2 if words <= 15 else 3 if words <= 40 else 4}")
        f.append(f"links:{0 if links == 0 else 1 if links < 0.3 else 2 if links < 0.8 else 3}")
        f.append("stop" if s[-1] in ".!?:;…\"'”»)" else "open")
        if words <= 60 and _TEXT_HINT.search(s):
            f.append("hint")
        if "in:article" in context or "in:main" in context or "part:main" in context:
            f.append("inner")
            f += [f"inner&{p}" for p in context if p.startswith("part:") and p != "part:main"]
            f += [f"inner&{t}" for t in ("in:nav", "in:aside", "in:footer", "in:form", "in:header") if t in context]
        else:
            f.append("outer")
            f.append(f"outer&{f[len(context) + 1]}")
        if i == 0:
            f.append("first")
        if i == n - 1:
            f.append("last")
        out.append(f)
    return out


# --- labelled pages -------------------------------------------------------------------------

_MARK = ""


def labelled_pages(n: int, seed: int) -> list[tuple[list[list[str]], list[int]]]:
    """Pages of invented layouts: their blocks' features and labels (1: main text)."""
    rng = random.Random(seed)
    syllables = "an re lo ti mer ka so vi den ula por ne chi tra mon be ru el sha gri".split()

    def word():
        return "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))

    def words(a, b):
        return " ".join(word() for _ in range(rng.randint(a, b)))

    def sentence(main, a=4, b=60):
        s = words(a, b).capitalize() + rng.choice([".", ".", ".", "", "!", "?"])
        return (_MARK if main else "") + s

    def attr(*names):
        name = rng.choice(names)
        return f' {rng.choice(["class", "class", "id"])}="{name}{rng.choice(["", "", "-" + str(rng.randint(1, 9)), " x" + word()])}"'

    def links(k, tag="li"):
        return "".join(f'<{tag}><a href="/{word()}">{words(1, 3)}</a></{tag}>' for _ in range(k))

    def menu():
        k = rng.randint(2, 8)
        return rng.choice([f"<nav><ul>{links(k)}</ul></nav>", f"<nav{attr('main-nav', 'site')}>{links(k, 'div')}</nav>", f"<div{attr('menu', 'navbar', 'breadcrumb', 'top-nav')}><ul>{links(k)}</ul></div>", f'<div role="navigation">{links(k, "p")}</div>'])

    def advert():
        inner = rng.choice([sentence(False, 3, 15), f"<p>{sentence(False, 3, 25)}</p>", f'<a href="#">{words(2, 8)}</a>'])
        return rng.choice([f"<div{attr('ad', 'ads', 'advert', 'sponsored', 'promo', 'ad-banner')}>{inner}</div>", f"<aside{attr('ad', 'promo')}>{inner}</aside>", f"<section{attr('advertisement', 'sponsor')}>{inner}</section>"])

    def side():
        inner = rng.choice([f"<ul>{links(rng.randint(2, 6))}</ul>", f"<h3>{words(1, 4)}</h3><p>{sentence(False, 4, 40)}</p>", f"<p>{sentence(False, 10, 60)}</p>"])
        return rng.choice([f"<aside>{inner}</aside>", f"<div{attr('sidebar', 'widget', 'related', 'side', 'recommended')}>{inner}</div>", f"<aside{attr('related', 'sidebar')}>{inner}</aside>"])

    def notice():
        s = rng.choice(["We use cookies. ", "Subscribe to our newsletter. ", "", ""]) + sentence(False, 3, 25)
        return rng.choice([f"<div{attr('cookie', 'cookie-notice', 'consent', 'notice', 'popup', 'newsletter', 'alert')}><p>{s}</p><button>{words(1, 2)}</button></div>", f'<div role="{rng.choice(["alert", "dialog"])}">{s}</div>', f"<div{attr('cookie-banner', 'notice')}>{s}</div>", f"<section{attr('notice', 'consent')}><p>{s}</p></section>", f"<dialog>{s}</dialog>"])

    def header():
        inner = rng.choice([f"<h1>{words(1, 3)}</h1>", f"<p>{words(1, 8)}</p>", f'<a href="/">{words(1, 2)}</a>', f"<div>{sentence(False, 2, 12)}</div>"])
        return rng.choice([f"<header>{inner}</header>", f"<div{attr('header', 'masthead', 'site-header', 'logo')}>{inner}</div>", f"<header{attr('site-header')}>{inner}{menu()}</header>", f'<div role="banner">{inner}</div>'])

    def footer():
        s = rng.choice(["&copy; 2021 ", "Copyright ", "", ""]) + sentence(False, 2, 25)
        return rng.choice([f"<footer>{s}</footer>", f"<footer><p>{s}</p><ul>{links(3)}</ul></footer>", f"<div{attr('footer', 'site-footer', 'copyright')}>{s}</div>", f'<div role="contentinfo"><p>{s}</p></div>'])

    def form():
        return rng.choice([f"<form><label>{words(1, 4)}</label><input><button>{words(1, 2)}</button></form>", f"<form{attr('search', 'login')}><p>{sentence(False, 2, 20)}</p><input></form>", f"<div{attr('login', 'signup', 'search-form')}><form><fieldset><legend>{words(1, 3)}</legend>{sentence(False, 2, 12)}</fieldset></form></div>"])

    def comments():
        one = lambda: rng.choice([f"<p>{sentence(False, 3, 60)}</p>", f"<div><b>{word()}</b><p>{sentence(False, 3, 60)}</p></div>", f"<li>{sentence(False, 3, 40)}</li>", f"<article{attr('comment')}><p>{sentence(False, 3, 60)}</p></article>"])
        inner = "".join(one() for _ in range(rng.randint(1, 5)))
        title = rng.choice(["", f"<h2>{words(1, 3)}</h2>", "<h3>Comments</h3>"])
        return rng.choice([f"<section{attr('comments', 'comment-list', 'discussion')}>{title}{inner}</section>", f"<div{attr('comments', 'disqus', 'replies', 'reader-comments')}>{title}{inner}</div>", f"<ol{attr('commentlist', 'comments')}>{inner}</ol>", f"<aside{attr('comments')}>{title}{inner}</aside>"])

    def share():
        return rng.choice([f"<div{attr('share', 'social', 'tags')}>{links(rng.randint(1, 4), 'span')}</div>", f"<ul{attr('social', 'share')}>{links(3)}</ul>"])

    def story():
        kinds = [
            lambda: f"<p>{sentence(True)}</p>", lambda: f"<p>{sentence(True)}</p>", lambda: f"<p>{sentence(True, 1, 5)}", lambda: f"<p><b>{sentence(True, 3, 30)}<br>",
            lambda: f"<p>{sentence(True)} <a href='/x'>{words(1, 3)}</a> {words(1, 20)}</p>", lambda: f"<h2>{sentence(True, 1, 8)}</h2>", lambda: f"<blockquote>{sentence(True)}</blockquote>",
            lambda: f"<ul>{''.join(f'<li>{sentence(True, 1, 14)}</li>' for _ in range(rng.randint(2, 5)))}</ul>", lambda: f"<pre>{sentence(True)}</pre>",
            lambda: f"<table><tr><td>{sentence(True, 1, 4)}</td><td>{sentence(True, 1, 4)}</td></tr></table>", lambda: f"<figure><figcaption>{sentence(True, 2, 12)}</figcaption></figure>",
            lambda: f"<div>{sentence(True)}</div>", lambda: f"<section><h3>{sentence(True, 1, 6)}</h3><p>{sentence(True)}</p></section>",
        ]
        parts = [f"<h1>{sentence(True, 1, 12)}</h1>"] if rng.random() < 0.8 else []
        if parts and rng.random() < 0.15:
            parts = [f"<header>{parts[0]}</header>"]
        for _ in range(rng.randint(1, 12)):
            parts.append(rng.choice(kinds)())
            if rng.random() < 0.08:
                parts.append(rng.choice([advert, share, side, notice, comments])())
        if rng.random() < 0.15:
            parts.append(rng.choice([comments, share, form])())
        body = "".join(parts)
        return rng.choice([f"<article>{body}</article>", f"<article>{body}</article>", f"<main>{body}</main>", f"<main><article>{body}</article></main>", f"<div{attr('content', 'article', 'post', 'story', 'entry-content', 'main-text')}>{body}</div>", f"<div id=main><div{attr('post-body', 'article-content')}>{body}</div></div>", f"<div>{body}</div>"])

    pages = []
    for _ in range(n):
        before = [f() for f in (menu, header, advert, notice, form, side) if rng.random() < 0.5]
        after = [f() for f in (comments, side, advert, footer, form, notice, menu) if rng.random() < 0.5]
        rng.shuffle(before)
        if rng.random() < 0.5:
            rng.shuffle(after)
        body = "".join([*before, story(), *after])
        page = f"<html><head><title>{words(2, 9)}</title></head><body>{rng.choice([body, f'<div>{body}</div>'])}</body></html>"
        blocks = leaf_blocks(page)
        labels = [int(_MARK in s) for s, _, _ in blocks]
        pages.append((features([(s.replace(_MARK, ""), c, k) for s, c, k in blocks]), labels))
    return pages


@lru_cache(1)
def fitted(n: int = TRAIN_PAGES, seed: int = TRAIN_SEED) -> tuple[dict[str, float], list[list[float]]]:
    """Weights of label main for each feature, and the transitions [from][to]."""
    pages = [p for p in labelled_pages(n, seed) if p[1]]
    names = {f: k for k, f in enumerate(sorted({f for x, _ in pages for b in x for f in b}))}
    longest = max(len(y) for _, y in pages)
    x = np.zeros((len(pages), longest, len(names)), np.float32)
    y, real = np.zeros((len(pages), longest), int), np.zeros((len(pages), longest), bool)
    for i, (blocks, labels) in enumerate(pages):
        real[i, : len(labels)] = True
        y[i, : len(labels)] = labels
        for t, b in enumerate(blocks):
            x[i, t, [names[f] for f in b]] = 1
    w, trans = np.zeros(len(names)), np.zeros((2, 2))
    gold_w = np.einsum("ntf,nt->f", x, (y * real).astype(np.float32))
    gold_t = np.zeros((2, 2))
    np.add.at(gold_t, (y[:, :-1][real[:, 1:]], y[:, 1:][real[:, 1:]]), 1)
    params, m, v = np.concatenate([w, trans.ravel()]), 0, 0
    lse = lambda z, axis: np.logaddexp.reduce(z, axis=axis)
    for step in range(1, ROUNDS + 1):
        w, trans = params[:-4], params[-4:].reshape(2, 2)
        u = np.stack([np.zeros(real.shape), x @ w.astype(np.float32)], axis=2)
        forward, backward = np.zeros_like(u), np.zeros_like(u)
        forward[:, 0] = u[:, 0]
        for t in range(1, longest):
            go = lse(forward[:, t - 1, :, None] + trans, 1) + u[:, t]
            forward[:, t] = np.where(real[:, t, None], go, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            go = lse(trans + (u[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(real[:, t + 1, None], go, 0)
        z = lse(forward[:, -1], 1)
        p1 = np.exp(forward[..., 1] + backward[..., 1] - z[:, None]) * real
        pair = forward[:, :-1, :, None] + trans + (u + backward)[:, 1:, None, :] - z[:, None, None, None]
        expect_t = (np.exp(np.minimum(pair, 0)) * real[:, 1:, None, None]).sum((0, 1))
        grad = np.concatenate([gold_w - np.einsum("ntf,nt->f", x, p1.astype(np.float32)), (gold_t - expect_t).ravel()]) - 0.5 * params
        m, v = (0.9 * m + 0.1 * grad), (0.99 * v + 0.01 * grad**2)
        params = params + 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return {f: float(params[k]) for f, k in names.items()}, params[-4:].reshape(2, 2).tolist()


def viterbi(unary: list[float], trans: list[list[float]]) -> list[int]:
    """The likeliest labels; unary scores are for label 1, label 0 scores 0. Ties go to 0."""
    if not unary:
        return []
    (t00, t01), (t10, t11) = trans
    a, b, back = 0.0, unary[0], []
    for s in unary[1:]:
        to0 = a + t00 < b + t10
        to1 = a + t01 < b + t11
        back.append((to0, to1))
        a, b = (b + t10 if to0 else a + t00), (b + t11 if to1 else a + t01) + s
    label = int(b > a)
    out = [label]
    for to in reversed(back):
        label = int(to[label])
        out.append(label)
    return out[::-1]


def main_text(page: str | None, model) -> str:
    weights, trans = model
    blocks = leaf_blocks(page or "")
    get = weights.get
    labels = viterbi([sum(get(f, 0.0) for f in fs) for fs in features(blocks)], trans)
    return " ".join(s for (s, _, _), y in zip(blocks, labels) if y)


def _run(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = [main_text(v.as_py(), model) for v in batch.column("html")]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> DataFrame:
    """One row per page: page_id, url, text, n_chars. No shuffle."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(partial(_run, model=fitted(train_pages)), "page_id long, url string, text string, n_chars long")

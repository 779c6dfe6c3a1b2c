"""Main text of web pages by a recurrent block labeller.

A page is cut into blocks: the text between block-level tags, with the open elements above it. A
block's vector holds its tag path and its words, both hashed, and a few measures (length, share of
link text, punctuation, place). A bidirectional LSTM in numpy reads the page's blocks in
order and gives each the probability of being main text, so a block is judged with the whole page
in view. Blocks in elements that never hold an article (``NEVER``) are dropped whatever the score, unless such
an element is wrapped around most of the page.

Training: a bounded sample of the pages themselves. In a sampled page the blocks inside its
article element are main text. Each is also rewritten: the article gets another container, and
headers, menus, sidebars, notices, adverts, forms and reader comments, filled with text of other
pages, are put around and into it, so that neither one tag nor one kind of text decides alone.
The network is fitted by back-propagation through time with a fixed seed, so reruns agree.

Defined results: null or empty html gives an empty text; a page without any block likewise; a
sample without an article element gives no network, and then blocks are chosen by length and link
share; unclosed tags, comments and quotes end with the page; repeated rows get equal texts; columns
of the input never clash with the working columns; pages are read whole.
"""

import html as entities
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from draftledger.llm.common import load, pack

#: The sample's bounds: pages, and bytes of one page. Longer pages are read like any other.
MAX_PAGES, MAX_BYTES = 600, 64 * 1024
PATH_SLOTS, WORD_SLOTS, MEASURES = 64, 32, 8
HIDDEN, EPOCHS, BATCH, RATE = 24, 6, 32, 0.01
#: Gradient steps at least, whatever the size of the sample: a few pages are gone through more often.
MIN_STEPS = 200
SIZE = PATH_SLOTS + WORD_SLOTS + MEASURES

#: Elements whose text is no part of the page.
_RAW = "script|style|noscript|template|title|iframe|svg|math|object|textarea"
_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)
      |<({_RAW})\b(?:"[^"]*"|'[^']*'|[^'">]++)*+>.*?(?:</\1\s*>|\Z)
      |<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:"[^"]*"|'[^']*'|[^'">]++)*+)>
      |<[!?/][^>]*+>""", re.S | re.I | re.X)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[a-z]+")
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span "
             "strike strong sub sup time tt u var wbr img".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
NEVER = set("nav footer aside form button select option label dialog menu".split())
#: Of these the ones that may be wrapped around a whole page; one that holds over half of the text is left to the labeller.
_WRAPPERS = set("form label dialog menu".split())
_SCOPE = set("article aside body div footer form header main nav section table td th blockquote ul ol".split())


def blocks(page: str) -> list[tuple[tuple[str, ...], str, float]]:
    """(tag path, text, share of link text) of every block with text, in page order. A path has
    tags, and names in class, id and role marked with a dot."""
    out: list[tuple[tuple[str, ...], str, float]] = []
    stack: list[tuple[str, list[str]]] = []
    parts: list[str] = []
    linked, in_link, at = 0, False, 0

    def close():
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            path = tuple(dict.fromkeys(t for _, names in stack for t in names))
            out.append((path, text, min(1.0, linked / len(text))))
        parts.clear()
        linked = 0

    def say(raw: str):
        nonlocal linked
        if raw:
            text = entities.unescape(raw)
            parts.append(text)
            if in_link:
                linked += len(text.strip())

    for m in _TOKEN.finditer(page):
        say(page[at:m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            in_link = not m[2]
        elif tag in INLINE:
            continue
        elif m[2]:
            close()
            in_link = False
            if any(t == tag for t, _ in stack):
                while stack.pop()[0] != tag:
                    pass
        elif tag in VOID:
            if tag == "hr":
                close()
        else:
            close()
            in_link = False
            if tag not in ("html", "body", "head"):  # a block start ends an open paragraph
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == "p" or stack[i][0] == tag and tag in ("li", "tr", "td", "th", "dt", "dd", "option"):
                        del stack[i:]
                        break
                    if stack[i][0] in _SCOPE:
                        break
            names = [tag]
            for a in _ATTRIBUTE.finditer(m[4]):
                names += ["." + n for n in _NAME.findall((a[2] or a[3] or a[4] or "").lower())]
            if not m[4].rstrip().endswith("/"):
                stack.append((tag, names))
    say(page[at:])
    close()
    return out


def outside(found: list[tuple[tuple[str, ...], str, float]]) -> list[bool]:
    """For each block whether it stands in an element that never holds an article."""
    total = sum(len(t) for _, t, _ in found)
    around = {w for w in _WRAPPERS if 2 * sum(len(t) for path, t, _ in found if w in path) > total}
    return [bool((NEVER - around).intersection(path)) for path, _, _ in found]


class _Slots(dict):
    """Hash slots of names, computed once for each of the names seen lately."""

    def __init__(self, n: int):
        self.n = n

    def __missing__(self, name: str) -> int:
        if len(self) > 200_000:
            self.clear()
        self[name] = slot = zlib.crc32(name.encode("utf-8", "surrogatepass")) % self.n
        return slot


_PATHS, _TERMS = _Slots(PATH_SLOTS), _Slots(WORD_SLOTS)


def vectors(found: list[tuple[tuple[str, ...], str, float]]) -> np.ndarray:
    x = np.zeros((len(found), SIZE), dtype=np.float32)
    paths, terms = _PATHS, _TERMS
    for i, (path, text, linked) in enumerate(found):
        for name in path:
            x[i, paths[name]] = 1
        words = text.lower().split()
        slots = np.bincount([terms[w] for w in words], minlength=WORD_SLOTS)
        x[i, PATH_SLOTS:PATH_SLOTS + WORD_SLOTS] = slots / len(words)
        last = text[-1]
        x[i, PATH_SLOTS + WORD_SLOTS:] = (
            np.log1p(len(words)) / 5, linked, last in ".!?…\"”", sum(map(text.count, ".,;:!?")) / len(words),
            sum(map(str.isupper, text[:1])), i / len(found), (len(found) - i) / len(found), len(words) < 4)
    return x


class Labeller:
    """Bidirectional LSTM with a logistic output for each block."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None, seed: int = 1):
        if weights is None:
            r = np.random.default_rng(seed)
            weights = {}
            for d in "fb":
                weights[f"{d}x"] = r.normal(0, SIZE ** -0.5, (SIZE, 4 * HIDDEN))
                weights[f"{d}h"] = r.normal(0, HIDDEN ** -0.5, (HIDDEN, 4 * HIDDEN))
                weights[f"{d}0"] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)  # in, forget, out, new: remember at first
            weights["o"] = r.normal(0, 0.1, 2 * HIDDEN)
            weights["o0"] = np.zeros(1)
        self.w = {k: v.astype(np.float32) for k, v in weights.items()}

    def _run(self, d: str, x: np.ndarray, mask: np.ndarray) -> list[tuple]:
        """States by step of one direction; x is (steps, pages, SIZE), in the order read."""
        steps, pages, _ = x.shape
        pre = x.reshape(steps * pages, -1) @ self.w[f"{d}x"] + self.w[f"{d}0"]
        pre = pre.reshape(steps, pages, -1)
        h = c = np.zeros((pages, HIDDEN), dtype=np.float32)
        kept = []
        for t in range(steps):
            z = pre[t] + h @ self.w[f"{d}h"]
            gates = 1 / (1 + np.exp(-np.clip(z[:, :3 * HIDDEN], -30, 30)))
            i, f, o = np.split(gates, 3, axis=1)
            g = np.tanh(z[:, 3 * HIDDEN:])
            on = mask[t][:, None]
            c2 = f * c + i * g
            s = np.tanh(c2)
            h2 = o * s
            kept.append((h, c, i, f, o, g, s, on))
            h, c = on * h2 + (1 - on) * h, on * c2 + (1 - on) * c
            kept[-1] += (h,)
        return kept

    def forward(self, x: np.ndarray, mask: np.ndarray):
        forth, back = self._run("f", x, mask), self._run("b", x[::-1], mask[::-1])
        h = np.concatenate([np.stack([k[-1] for k in forth]), np.stack([k[-1] for k in back])[::-1]], axis=2)
        return 1 / (1 + np.exp(-np.clip(h @ self.w["o"] + self.w["o0"], -30, 30))), h, forth, back

    def gradient(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, h, forth, back = self.forward(x, mask)
        dz = (p - y) * mask / mask.sum()
        g = {"o": np.einsum("tp,tph->h", dz, h), "o0": np.array([dz.sum()])}
        dh = dz[:, :, None] * self.w["o"]
        for d, kept, inputs, part in (("f", forth, x, dh[:, :, :HIDDEN]), ("b", back, x[::-1], dh[::-1, :, HIDDEN:])):
            wh = self.w[f"{d}h"]
            all_dz = np.zeros((*x.shape[:2], 4 * HIDDEN), dtype=np.float32)
            gh = np.zeros_like(wh)
            dh_next = dc_next = np.zeros(kept[0][0].shape, dtype=np.float32)
            for t in reversed(range(len(kept))):
                h0, c0, i, f, o, new, s, on, _ = kept[t]
                full = part[t] + dh_next
                dh2 = on * full
                dc2 = on * dc_next + dh2 * o * (1 - s * s)
                all_dz[t] = np.concatenate([dc2 * new * i * (1 - i), dc2 * c0 * f * (1 - f), dh2 * s * o * (1 - o),
                                            dc2 * i * (1 - new * new)], axis=1)
                gh += h0.T @ all_dz[t]
                dh_next = (1 - on) * full + all_dz[t] @ wh.T
                dc_next = (1 - on) * dc_next + dc2 * f
            g[f"{d}h"] = gh
            g[f"{d}x"] = inputs.reshape(-1, SIZE).T @ all_dz.reshape(-1, 4 * HIDDEN)
            g[f"{d}0"] = all_dz.sum(axis=(0, 1))
        return g

    def scores(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        for at in range(0, len(order), 64):
            some = order[at:at + 64]
            x, mask = _padded([pages[i] for i in some])
            p = self.forward(x, mask)[0]
            for k, i in enumerate(some):
                out[i] = p[:len(pages[i]), k]
        return out


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x = np.zeros((steps, len(pages), SIZE), dtype=np.float32)
    mask = np.zeros((steps, len(pages)), dtype=np.float32)
    for k, v in enumerate(pages):
        x[:len(v), k], mask[:len(v), k] = v, 1
    return x, mask


def fit(examples: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = 1) -> dict[str, np.ndarray]:
    net, r = Labeller(seed=seed), random.Random(seed)
    examples = [e for e in examples if len(e[0])]
    epochs = max(epochs, -(-MIN_STEPS // max(1, -(-len(examples) // BATCH))))
    one = {k: np.zeros_like(v) for k, v in net.w.items()}
    two = {k: np.zeros_like(v) for k, v in net.w.items()}
    step = 0
    for _ in range(epochs):
        order = sorted(range(len(examples)), key=lambda i: (len(examples[i][0]) + r.random() * 8))
        batches = [order[i:i + BATCH] for i in range(0, len(order), BATCH)]
        r.shuffle(batches)
        for some in batches:
            x, mask = _padded([examples[i][0] for i in some])
            y = np.zeros_like(mask)
            for k, i in enumerate(some):
                y[:len(examples[i][1]), k] = examples[i][1]
            g = net.gradient(x, mask, y)
            step += 1
            norm = np.sqrt(sum((v ** 2).sum() for v in g.values()))
            for k, v in g.items():
                v = v * min(1.0, 5.0 / max(norm, 1e-9))
                one[k] = 0.9 * one[k] + 0.1 * v
                two[k] = 0.999 * two[k] + 0.001 * v * v
                net.w[k] = (net.w[k] - RATE * (one[k] / (1 - 0.9 ** step)) / (np.sqrt(two[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return net.w


_ARTICLE = re.compile(r"(<article\b[^>]*>)(.*?)(</article\s*>)", re.S | re.I)
_MARK = "\ue000"  # private character: marks text of the article in a rewritten page


def rewritten(page: str, others: list[str], r: random.Random) -> str | None:
    """The page with its article's text marked, in another container, with other matter around
    and in it; None without an article. Odd draws keep the page's own container."""
    m = _ARTICLE.search(page)
    if not m:
        return None

    def text(n: int) -> str:
        return " ".join(r.choice(others).split()[:n])

    def links(n: int) -> str:
        return "".join(f'<li><a href="#">{text(r.randint(1, 3))}</a></li>' for _ in range(n))

    def notice() -> str:
        return r.choice([
            f'<div class="{r.choice(["cookie-notice", "cookie-banner", "notice", "alert", "consent"])}"><p>{text(15)}</p></div>',
            f'<div class="{r.choice(["ad", "ads", "advert", "sponsored", "promo", "banner"])}">{text(r.randint(3, 40))}</div>',
            f'<aside class="{r.choice(["sidebar", "related", "widget"])}"><h3>{text(2)}</h3><ul>{links(4)}</ul><p>{text(30)}</p></aside>',
            f'<div class="{r.choice(["sidebar", "related", "share", "social", "widget", "breadcrumb", "menu"])}"><ul>{links(3)}</ul></div>',
            f'<form action="/s"><label>{text(2)}</label><input name="q"><p>{text(6)}</p><button>{text(1)}</button></form>',
            f'<div class="{r.choice(["newsletter", "subscribe", "popup", "paywall"])}"><p>{text(12)}</p></div>'])

    def comments() -> str:
        some = "".join(f'<div class="comment"><p class="author">{text(2)}</p><p>{text(r.randint(4, 60))}</p></div>' for _ in range(r.randint(1, 5)))
        return r.choice([f'<section class="comments"><h2>{text(2)}</h2>{some}</section>', f'<div id="comments">{some}</div>',
                         f'<ol class="commentlist">{some}</ol>'])

    spans, at, own = [], 0, m[2]
    for t in _TOKEN.finditer(own):  # a mark after every text of the article
        spans += [own[at:t.start()], _MARK if own[at:t.start()].strip() else "", t[0]]
        at = t.end()
    tail = own[at:]
    own = "".join(spans) + tail + (_MARK if tail.strip() else "")
    if r.random() < 0.5:
        cuts = [c.end() for c in re.finditer(r"</(?:p|h1|h2)\s*>", own)]
        for c in sorted(r.sample(cuts, min(len(cuts), r.randint(1, 2))), reverse=True):
            own = own[:c] + notice() + own[c:]
    if r.random() < 0.4:
        own += comments()
    first, last = m[1], m[3]
    if r.random() < 0.6:
        tag, name = r.choice([("div", "content"), ("div", "post"), ("main", "main"), ("div", "entry-content"), ("section", "article"),
                              ("div", "article-body"), ("div", "story"), ("div", "main"), ("article", "post"), ("div", "")])
        first, last = f'<{tag} {r.choice(["class", "id"])}="{name}">', f"</{tag}>"
    before = page[:m.start()] + "".join(notice() for _ in range(r.choice([0, 0, 1, 2])))
    if r.random() < 0.4:
        head = f"<h1>{text(3)}</h1><p>{text(8)}</p>"
        before += r.choice([f"<header>{head}</header>", f'<div class="header">{head}</div>', f'<div id="masthead">{head}<ul>{links(5)}</ul></div>'])
    after = "".join(notice() for _ in range(r.choice([0, 0, 1, 2]))) + (comments() if r.random() < 0.4 else "")
    end = page[m.end():]
    if r.random() < 0.3:
        end = f'<div class="footer"><p>{text(10)}</p></div></body></html>'
    return before + first + own + last + after + end


def examples(pages: list[str], seed: int = 1) -> list[tuple[np.ndarray, np.ndarray]]:
    r, out = random.Random(seed), []
    texts = [t for page in pages for _, t, _ in blocks(page) if len(t) > 40] or ["text"]
    for page in pages:
        page = page.replace(_MARK, " ")
        m = _ARTICLE.search(page)
        if not m:
            continue
        plain = blocks(page)
        inside = np.array([float("article" in path and not out_) for (path, _, _), out_ in zip(plain, outside(plain))])
        out.append((vectors(plain), inside))
        new = blocks(rewritten(page, texts, r))
        y = np.array([float(_MARK in t) for _, t, _ in new])
        clean = [(path, " ".join(t.replace(_MARK, " ").split()), linked) for path, t, linked in new]
        keep = [i for i, (_, t, _) in enumerate(clean) if t]
        out.append((vectors([clean[i] for i in keep]), y[keep]))
    return out


def train(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html") -> dict[str, np.ndarray] | None:
    page = F.col(f"`{html_col}`")
    mixed = F.xxhash64(F.col(f"`{id_col}`"), page)
    fit_for_it = pages.where(F.octet_length(page).between(1, MAX_BYTES))
    # the least hashes are the sample; those under a cut are enough to find them, so that not every task sends as
    # many pages as the sample has
    cut = -2 ** 63 - 1 + int(2 ** 64 * min(1.0, 2 * MAX_PAGES / max(1, fit_for_it.count())))
    sample = (fit_for_it.where(mixed <= F.lit(cut)).select(page.alias("html"), mixed.alias("mixed"))
              .orderBy("mixed", "html").limit(MAX_PAGES).collect())
    found = examples([r["html"] for r in sample])
    return fit(found) if found else None


def article(found: list, scores: np.ndarray | None) -> str:
    if scores is None:
        scores = np.array([float(len(t) >= 60 and linked < 0.3) for _, t, linked in found])
    return "\n\n".join(t for (_, t, _), s, out in zip(found, scores, outside(found)) if s >= 0.5 and not out)


def _extractor(weights):
    @F.pandas_udf(T.StringType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        net = weights and Labeller(weights)
        for pages in batches:
            out = []
            for at in range(0, len(pages), 256):  # a few pages' vectors at a time
                found = [blocks(p) if p else [] for p in pages.iloc[at:at + 256]]
                scores = net.scores([vectors(b) for b in found]) if net else [None] * len(found)
                out += [article(b, s) for b, s in zip(found, scores)]
            yield pd.Series(out, dtype=object)

    return run.asNondeterministic()


def extract(pages: DataFrame, weights: dict | None, *, html_col: str = "html") -> DataFrame:
    """Every page as struct ``row`` with its main ``text``."""
    return pack(pages, text=_extractor(weights)(F.col(f"`{html_col}`")))


def query(spark, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = extract(pages, train(pages))
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))

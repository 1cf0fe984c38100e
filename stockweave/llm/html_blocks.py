"""Main text of web pages: a bidirectional LSTM labels every block in the context of the whole page.

A page becomes the sequence of its leaf blocks: text between block-level tags, with the path of open
tags (names and class/id words). A block's input is a signed-hash vector of its tag path, one of its
words and a few figures (length, share of linked text, position). A numpy LSTM reads the sequence in
both directions, so a block is judged by what stands before and after it on the whole page.

No table has labels, so the training pages are made from a bounded sample of real pages: their blocks are
taken as main text or as furniture by the meaning of their own tags, and set into other page layouts
(other wrappers, class names, orders, comments, forms, notices), whose labels are then known.

Cases: null or empty pages and pages of scripts or furniture only give the empty text; unclosed tags end
with the next block or page, also those of elements whose contents are not shown (only script and style run to the end
of the page); a head ends at its end tag, at body or at the first element or text that cannot stand in it; character references are decoded, also without semicolon, as HTML defines;
a page without any tag is one block; long pages are labelled whole; repeated rows give the same text;
an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import html as entities
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_sample, text_udf

TRAIN_PAGES = 400  # bound of the sample
COPIES, EPOCHS, CELLS = 6, 6, 16
PATH_DIM, WORD_DIM, FIGURES = 128, 32, 6
WIDTH = PATH_DIM + WORD_DIM + FIGURES
SCHEMA = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_blocks", T.LongType())])

# Fixed values of HTML: elements without end tag, elements inside a line, raw and hidden contents.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
HIDDEN = frozenset("noscript template svg math iframe object".split())
HEAD = frozenset("head title base basefont bgsound link meta noframes noscript template".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
OPENING = re.compile(r"</?[a-zA-Z][a-zA-Z0-9:-]*")
SPECIAL = re.compile(r"[>\"']")
RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style")}
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORD = re.compile(r"[a-z]+")

# Names by which pages mark main text and furniture.
MAIN_TAGS = ("article", "main")
MAIN_NAMES = ("article", "content", "main", "post", "entry", "story", "body", "text", "page", "blog", "detail")
NEUTRAL_NAMES = ("wrapper", "container", "page", "row", "col", "layout", "inner", "section", "grid", "site")
SIDE_TAGS = ("nav", "header", "footer", "aside", "form", "menu", "button", "select", "dialog")
SIDE_NAMES = (
    "nav", "navbar", "menu", "header", "footer", "sidebar", "side", "aside", "ad", "ads", "advert", "advertisement", "sponsor",
    "sponsored", "promo", "banner", "cookie", "consent", "notice", "alert", "popup", "modal", "newsletter", "subscribe", "signup",
    "comment", "comments", "reply", "discussion", "related", "recommended", "share", "social", "breadcrumb", "breadcrumbs",
    "widget", "login", "search", "copyright", "pagination", "tags", "toolbar", "masthead", "legal",
)


class Token:
    """A tag, or a comment or declaration (without name); a script or style is one token with its contents."""

    __slots__ = ("parts", "first", "last")

    def __init__(self, first: int, last: int, name: str = "", end: str = "", attributes: str = "", raw: str = ""):
        self.first, self.last = first, last
        self.parts = {"name": name, "end": end, "attributes": attributes, "raw": raw}

    def __getitem__(self, part: str) -> str:
        return self.parts[part]

    def start(self) -> int:
        return self.first

    def end(self) -> int:
        return self.last


def scan(page: str) -> list[Token]:
    """All tokens of a page, in time that grows with its length alone.

    A ``>`` inside a quoted value ends no tag. Where a quote never closes, so that no ``>`` would end the tag, quotes are
    given up for this tag and it ends at its next ``>``. Once that has happened, places outside of quotes from which a
    page's end was reached are kept, and no later tag follows them again. A ``<`` that no ``>`` follows is text.
    """
    out: list[Token] = []
    at, last_close, lost, broken = 0, page.rfind(">"), set(), False

    def closes(place: int) -> bool:
        """Whether a ``>`` outside of quotes follows, with the places on the way kept if none does."""
        seen = []
        while (m := SPECIAL.search(page, place)) and m.start() not in lost:
            if m[0] == ">":
                return True
            seen.append(m.start())
            place = page.find(m[0], m.end()) + 1
            if place == 0:
                break
        lost.update(seen)
        return False

    while (at := page.find("<", at)) >= 0:
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = len(page) if end < 0 else end + 3
            out.append(Token(at, end))
            at = end
            continue
        if at > last_close:
            break
        if page[at + 1 : at + 2] in ("!", "?"):
            end = page.find(">", at) + 1
            out.append(Token(at, end))
            at = end
            continue
        opening = OPENING.match(page, at)
        if opening is None:
            at += 1
            continue
        m = TAG.match(page, at) if not broken or closes(opening.end()) else None
        if m is None:
            if not broken:
                broken = True
                closes(opening.end())
            end = page.find(">", opening.end()) + 1
            closing, name, attributes = ("/" if page[at + 1] == "/" else ""), opening[0].lstrip("</"), page[opening.end() : end - 1]
        else:
            end, (closing, name, attributes) = m.end(), m.groups()
        raw = name.lower() if not closing and name.lower() in RAW_END else ""
        if raw:
            shut = RAW_END[raw].search(page, end)
            end = shut.end() if shut else len(page)
        out.append(Token(at, end, name if not raw else "", closing, attributes, raw))
        at = end
    return out


def ends(tokens: list[Token]) -> dict[int, int]:
    """Token of each hidden element that has an end tag → token of that end tag; the innermost open one of a name ends."""
    opened: dict[str, list[int]] = {}
    out = {}
    for k, m in enumerate(tokens):
        name = (m["name"] or "").lower()
        if name in HIDDEN:
            if not m["end"]:
                if not m["attributes"].rstrip().endswith("/"):
                    opened.setdefault(name, []).append(k)
            elif opened.get(name):
                out[opened[name].pop()] = k
    return out


def blocks(page: str) -> list[tuple[tuple[str, ...], str, float]]:
    """(path words, text with single blanks, share of linked characters) of each block in page order."""
    out: list[tuple[tuple[str, ...], str, float]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    piece: list[tuple[str, bool]] = []
    path_at: list[tuple[str, tuple[str, ...]]] = []
    linked = 0

    def flush() -> None:
        text = " ".join("".join(p for p, _ in piece).split())
        if text:
            inside = sum(len(p) for p, a in piece if a)
            total = sum(len(p) for p, _ in piece)
            words = tuple(w for name, own in path_at for w in (f"<{name}>", *own))
            out.append((words, text, inside / total))
        piece.clear()

    done, until, unseen, in_head = 0, -1, False, False

    def close(at: int) -> None:
        nonlocal linked, unseen, in_head
        linked -= sum(name == "a" for name, _ in stack[at:])
        del stack[at:]
        unseen = unseen and any(s[0] in HIDDEN for s in stack)
        in_head = in_head and any(s[0] == "head" for s in stack)

    tokens = scan(page)
    closed = ends(tokens)
    for k, m in enumerate(tokens):
        if k <= until:  # inside an element that is not shown, up to its end tag
            done = m.end()
            continue
        if in_head and m.start() > done and stack[-1][0] != "title" and not page[done : m.start()].isspace():
            close(next(at for at, s in enumerate(stack) if s[0] == "head"))  # text ends the head as well
        if m.start() > done and not unseen and not in_head:
            piece_text = entities.unescape(page[done : m.start()])
            if not piece and not piece_text.isspace():
                path_at = [s for s in stack if s[0] not in INLINE]
            if piece or not piece_text.isspace():
                piece.append((piece_text, linked > 0))
        done = m.end()
        name = (m["name"] or "").lower()
        if m["raw"] or not name:
            if m["raw"] and piece:
                piece.append((" ", False))
            continue
        if in_head and (name not in HEAD if not m["end"] else name in ("head", "body", "html", "br")):
            close(next(at for at, s in enumerate(stack) if s[0] == "head"))
        if unseen and name in BLOCK:  # an element without end tag ends with the next block
            close(next(at for at, s in enumerate(stack) if s[0] in HIDDEN))
        if name in HIDDEN:
            if piece:
                piece.append((" ", False))
            if k in closed:
                until = closed[k]
            elif not m["end"] and not m["attributes"].rstrip().endswith("/") and not in_head:
                stack.append((name, ()))
                unseen = True
            continue
        if name not in INLINE and not unseen:
            flush()
        elif name in ("br", "wbr", "img") and piece:
            piece.append((" " if name == "br" else "", False))
        if m["end"]:
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == name:
                    close(at)
                    break
        elif name not in VOID:
            if name not in INLINE:  # a block ends an open paragraph and what is open inside it
                for at in range(len(stack) - 1, -1, -1):
                    if stack[at][0] not in INLINE:
                        if stack[at][0] == "p" or stack[at][0] == name == "li":
                            close(at)
                        break
            if not m["attributes"].rstrip().endswith("/"):
                names = " ".join("".join(x) for x in NAMED.findall(m["attributes"])).lower()
                stack.append((name, tuple(WORD.findall(names))))
                linked += name == "a"
                in_head = in_head or name == "head"
    if done < len(page) and not unseen and not (in_head and stack[-1][0] == "title"):
        rest = entities.unescape(page[done:])
        if not piece:
            path_at = [s for s in stack if s[0] not in INLINE]
        piece.append((rest, linked > 0))
    flush()
    return out


def hashed(words, dim: int, seen: dict) -> list[tuple[int, float]]:
    found = []
    for w in words:
        if w not in seen:
            if len(seen) > 200_000:
                seen.clear()
            h = zlib.crc32(w.encode("utf-8", "surrogatepass"))
            seen[w] = (h % dim, 1.0 if h >> 16 & 1 else -1.0)
        found.append(seen[w])
    return found


def vectors(found, path_seen: dict, word_seen: dict) -> np.ndarray:
    """One row per block: tag path, words (mean), figures."""
    x = np.zeros((len(found), WIDTH), np.float32)
    paths: dict = {}
    for k, (path, text, share) in enumerate(found):
        if path not in paths:
            row = np.zeros(PATH_DIM, np.float32)
            depth = len(path)
            for i, (at, sign) in enumerate(hashed(path, PATH_DIM, path_seen)):
                row[at] += sign * (1.0 if i >= depth - 4 else 0.7)
            paths[path] = row
        x[k, :PATH_DIM] = paths[path]
        words = text.lower().split()
        at = np.array([i for i, _ in hashed(words, WORD_DIM, word_seen)])
        x[k, PATH_DIM : PATH_DIM + WORD_DIM] = np.bincount(at, minlength=WORD_DIM) / len(words)
        x[k, PATH_DIM + WORD_DIM :] = (
            np.log1p(len(text)) / 6,
            np.log1p(len(words)) / 4,
            share,
            k / len(found),
            1.0,
            sum(c in ".,;:!?" for c in text[-1:]),
        )
    return x


# ---------------------------------------------------------------- the network


def initial(seed: int = 1) -> dict:
    rng = np.random.default_rng(seed)
    net = {}
    for side in "fb":
        net[f"x{side}"] = rng.normal(0, 0.15, (WIDTH, 4 * CELLS)).astype(np.float32)
        net[f"h{side}"] = rng.normal(0, 0.2, (CELLS, 4 * CELLS)).astype(np.float32)
        net[f"b{side}"] = np.repeat(np.float32([0, 1, 0, 0]), CELLS)
    net["o"] = rng.normal(0, 0.2, 2 * CELLS).astype(np.float32)
    net["s"] = np.zeros(WIDTH, np.float32)
    net["d"] = np.zeros(1, np.float32)
    return net


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def run_side(net: dict, side: str, x: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """LSTM over padded pages (time, page, width); padding leaves the state as it is."""
    steps, pages, _ = x.shape
    z = (x.reshape(-1, WIDTH) @ net[f"x{side}"] + net[f"b{side}"]).reshape(steps, pages, -1)
    h = c = np.zeros((pages, CELLS), np.float32)
    out, tape = np.zeros((steps, pages, CELLS), np.float32), []
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        a = z[t] + h @ net[f"h{side}"]
        gate = sigmoid(a[:, : 3 * CELLS])
        i, f, o = gate[:, :CELLS], gate[:, CELLS : 2 * CELLS], gate[:, 2 * CELLS :]
        g = np.tanh(a[:, 3 * CELLS :])
        new = f * c + i * g
        th = np.tanh(new)
        m = mask[t][:, None]
        if keep:
            tape.append((t, i, f, o, g, c, th, h, m))
        h, c = m * (o * th) + (1 - m) * h, m * new + (1 - m) * c
        out[t] = h
    return out, tape


def forward(net: dict, x: np.ndarray, mask: np.ndarray, keep: bool = False):
    f, tape_f = run_side(net, "f", x, mask, keep)
    b, tape_b = run_side(net, "b", x, mask, keep)
    z = f @ net["o"][:CELLS] + b @ net["o"][CELLS:] + x @ net["s"] + net["d"][0]
    return sigmoid(z), f, b, tape_f, tape_b


def back_side(net: dict, side: str, x: np.ndarray, gout: np.ndarray, tape: list, g: dict) -> None:
    dh = dc = np.zeros_like(gout[0])
    gz = np.zeros((x.shape[0], x.shape[1], 4 * CELLS), np.float32)
    gh = np.zeros_like(net[f"h{side}"])
    for t, i, f, o, gg, c, th, h, m in reversed(tape):
        d = gout[t] + dh
        dn = dc + d * o * (1 - th**2)
        da = np.concatenate([dn * gg * i * (1 - i), dn * c * f * (1 - f), d * th * o * (1 - o), dn * i * (1 - gg**2)], axis=1) * m
        gz[t] = da
        gh += h.T @ da
        dh = da @ net[f"h{side}"].T + (1 - m) * d
        dc = m * dn * f + (1 - m) * dc
    flat = gz.reshape(-1, 4 * CELLS)
    g[f"x{side}"], g[f"h{side}"], g[f"b{side}"] = x.reshape(-1, WIDTH).T @ flat, gh, flat.sum(axis=0)


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x, mask = np.zeros((steps, len(pages), WIDTH), np.float32), np.zeros((steps, len(pages)), np.float32)
    for k, p in enumerate(pages):
        x[: len(p), k], mask[: len(p), k] = p, 1
    return x, mask


def train(pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = EPOCHS, batch: int = 32) -> dict | None:
    """Adam on the mean block loss; None without both labels."""
    if not pages or len(np.unique(np.concatenate(labels))) < 2:
        return None
    net, rng, step = initial(), np.random.default_rng(2), 0
    m = {k: np.zeros_like(w) for k, w in net.items()}
    v = {k: np.zeros_like(w) for k, w in net.items()}
    order = np.argsort([len(p) for p in pages], kind="stable")
    groups = [order[a : a + batch] for a in range(0, len(order), batch)]
    for _ in range(epochs):
        for k in rng.permutation(len(groups)):
            x, mask = padded([pages[i] for i in groups[k]])
            y = np.zeros_like(mask)
            for j, i in enumerate(groups[k]):
                y[: len(labels[i]), j] = labels[i]
            p, f, b, tape_f, tape_b = forward(net, x, mask, True)
            gz = ((p - y) * mask / mask.sum()).astype(np.float32)
            g = {"o": np.concatenate([np.einsum("tpc,tp->c", f, gz), np.einsum("tpc,tp->c", b, gz)]), "s": np.einsum("tpw,tp->w", x, gz), "d": gz.sum(keepdims=True).reshape(1)}
            back_side(net, "f", x, gz[:, :, None] * net["o"][:CELLS], tape_f, g)
            back_side(net, "b", x, gz[:, :, None] * net["o"][CELLS:], tape_b, g)
            step += 1
            for key, d in g.items():
                m[key], v[key] = 0.9 * m[key] + 0.1 * d, 0.99 * v[key] + 0.01 * d * d
                net[key] = (net[key] - 0.01 * (m[key] / (1 - 0.9**step)) / (np.sqrt(v[key] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


# ---------------------------------------------------------------- training pages


def own_label(path: tuple[str, ...]) -> int | None:
    """What a block's own tags say: 1 main text, 0 furniture, None nothing."""
    bare = [w.strip("<>") if w[0] == "<" else w for w in path]
    if any(w in SIDE_NAMES or w in SIDE_TAGS for w in bare):
        return 0
    return 1 if any(w in MAIN_TAGS or w in MAIN_NAMES for w in bare) else None


def make_page(main: list[str], side: list[str], rng) -> str:
    """A page of another layout around real blocks."""
    pick = lambda x: x[int(rng.integers(len(x)))]
    esc = entities.escape

    def furniture(texts: list[str]) -> str:
        tag, name = pick(SIDE_TAGS[:5]), pick(SIDE_NAMES)
        words = " ".join(texts).split() or ["x"]
        style = rng.integers(6)
        if style == 0:
            body = "<ul>" + "".join(f'<li><a href="/{k}">{esc(w)}</a></li>' for k, w in enumerate(words[:12])) + "</ul>"
        elif style == 1:
            body = "".join(f"<p>{esc(t)}</p>" for t in texts)
        elif style == 2:
            body = "<form><label>" + esc(" ".join(words[:4])) + "</label><input><button>" + esc(words[0]) + "</button></form>"
        elif style == 3:
            body = "".join(f'<div class="{name}"><b>{esc(words[0])}</b><p>{esc(t)}</p></div>' for t in texts)
        else:
            body = esc(" ".join(words[:40]))
        kind = rng.integers(4)
        if kind == 0:
            return f"<{tag}>{body}</{tag}>"
        if kind == 1:
            return f'<{tag} class="{name}">{body}</{tag}>'
        attribute = pick(("class", "id"))
        return f'<{pick(("div", "section", "div", "ul"))} {attribute}="{name}{pick(("", "-box", " block", "-area"))}">{body}</{pick(("div", "section"))}>' if kind == 2 else f'<div {attribute}="{pick(("site-", "page-", "top-", ""))}{name}">{body}</div>'

    paragraphs = [f"<{t}>{esc(x)}</{t}>" for x in main for t in [pick(("p", "p", "p", "p", "h2", "li", "blockquote", "div", "td", "pre"))]]
    title = f"<{pick(('h1', 'h1', 'h2'))}>{esc(pick(main)[:60])}</h1>" if rng.random() < 0.7 else ""
    if rng.random() < 0.3 and len(side) > 1:  # furniture inside the article
        paragraphs.insert(int(rng.integers(len(paragraphs) + 1)), furniture([pick(side)]))
    body = "".join([title, *paragraphs])
    wrap = rng.integers(5)
    if wrap <= 1:
        body = f"<{pick(MAIN_TAGS)}>{body}</article>"
    elif wrap <= 3:
        body = f'<div {pick(("class", "id"))}="{pick(("", "", "post-", "page-", "entry-"))}{pick(MAIN_NAMES)}">{body}</div>'
    if rng.random() < 0.3:
        body = f'<main>{body}{furniture([pick(side)]) if rng.random() < 0.5 else ""}</main>'
    opened, closed = "", ""
    for _ in range(int(rng.integers(0, 3))):
        opened, closed = opened + f'<div {pick(("class", "id"))}="{pick(NEUTRAL_NAMES)}">', closed + "</div>"
    before = "".join(furniture([pick(side + main) for _ in range(int(rng.integers(1, 4)))]) for _ in range(int(rng.integers(0, 4))))
    after = "".join(furniture([pick(side + main) for _ in range(int(rng.integers(1, 4)))]) for _ in range(int(rng.integers(0, 4))))
    return f"<html><body>{opened}{before}<!--MAIN-->{body}<!--END-->{after}{closed}</body></html>"


def training_pages(pages: list[str], copies: int = COPIES, seed: int = 4) -> tuple[list[np.ndarray], list[np.ndarray]]:
    rng, x, y = np.random.default_rng(seed), [], []
    seen: tuple[dict, dict] = ({}, {})

    def add(found, labels) -> None:
        if found:
            x.append(vectors(found, *seen))
            y.append(np.array(labels, np.float32))

    for page in pages:
        found = blocks(page)
        labels = [own_label(p) for p, _, _ in found]
        main = [t for (_, t, _), l in zip(found, labels) if l == 1]
        side = [t for (_, t, _), l in zip(found, labels) if l == 0]
        if not main or not side:
            continue
        add([b for b, l in zip(found, labels) if l is not None], [l for l in labels if l is not None])
        for _ in range(copies):
            use = [main[int(i)] for i in sorted(rng.integers(0, len(main), min(len(main), int(rng.integers(1, 14)))))]
            made = make_page(use, side, rng)
            head, rest = made.split("<!--MAIN-->")
            body, tail = rest.split("<!--END-->")
            whole = blocks(made)
            n_head, n_tail = len(blocks(head)), len(blocks("<body>" + tail))
            inside = range(n_head, len(whole) - n_tail)
            add(whole, [1 if k in inside and own_label(p) != 0 else 0 for k, (p, _, _) in enumerate(whole)])
    return x, y


def fit(pages: DataFrame, rows: int = TRAIN_PAGES, html: str = "html", key: str = "page_id") -> dict | None:
    """Labeller from at most ``rows`` pages, in the order of a hash of their id."""
    sample = bounded_sample(pages.filter(F.col(html).isNotNull()), [key], rows, 23)
    return train(*training_pages([r[0] for r in sample.select(html).collect()]))


def extractor(net: dict | None):
    """Main text of each page; pages of similar length run through the network together."""
    seen: tuple[dict, dict] = ({}, {})

    def extract(pages: list[str]) -> dict:
        texts, sizes = [""] * len(pages), [0] * len(pages)
        for at in range(0, len(pages), 256):
            found = {k: b for k in range(at, min(at + 256, len(pages))) if (b := blocks(pages[k]))}
            order = sorted(found, key=lambda k: len(found[k]))
            for g in range(0, len(order), 32):
                group = order[g : g + 32]
                x, mask = padded([vectors(found[k], *seen) for k in group])
                p = forward(net, x, mask)[0] if net else mask
                for j, k in enumerate(group):
                    kept = [t for i, (_, t, _) in enumerate(found[k]) if p[i, j] >= 0.5]
                    texts[k], sizes[k] = "\n\n".join(kept), len(kept)
        return {"text": texts, "n_blocks": sizes}

    return extract


def extract_text(pages: DataFrame, net: dict | None, html: str = "html", name: str = "text") -> DataFrame:
    """Adds column ``name`` (replacing one of that name): the page's main text."""
    shared = pages.sparkSession.sparkContext.broadcast(net)
    return pages.withColumn(name, text_udf(SCHEMA, lambda: extractor(shared.value))(F.col(html))["text"])


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``."""
    found = extract_text(pages.select("page_id", "url", "html"), fit(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))

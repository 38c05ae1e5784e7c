"""Main text of web pages: a bidirectional LSTM labels every text block with the whole page in view.

A page becomes the sequence of its leaf blocks, texts between block-level tags.  A block's vector holds its tag path
(tags, classes and ids of all open elements, hashed), its words (hashed, all of them) and a few plain measures.  The
network reads the sequence in both directions and says for each block whether it belongs to the article.

The network is trained in numpy on ``TRAIN_PAGES`` pages that ``make_page`` composes with known labels: articles in
many containers among menus, headers, footers, sidebars, notices, adverts, forms and comments.  Pages of the table are
never labelled by rules.
"""

from __future__ import annotations

import html as entities
import random
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wattsift.llm.words import text_rows

PATH_SIZE, TAG_SIZE, WORD_SIZE, MEASURES = 320, 32, 48, 8
INPUT_SIZE = PATH_SIZE + TAG_SIZE + WORD_SIZE + MEASURES
HIDDEN = 24
TRAIN_PAGES = 1_000
CACHED = 50_000
BATCH_BLOCKS = 4_096

#: Elements that hold no page text.  The raw ones hold no tags either and run to the page's end if they are not closed.
RAW = "script|style|noscript|textarea|title|iframe"
NESTED = frozenset("template select svg math object canvas video audio".split())
#: What ends an open svg or math, where raw elements are ordinary ones and may be closed by "/>".
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s "
    "small span strong strike sub sup table tt u ul var".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol option p pre search section summary table "
    "tbody td tfoot th thead tr ul".split()
)
#: An element that starts closes an open one of the second kind, if none of the third kind stands between.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ()),
}
VOID = frozenset(("hr",))

_COMMENT = r"<!--(?:-?>|.*?(?:--!?>|\Z))"
_TAG = r"""<(/?)([a-z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-z][^\s/>]*)([^>]*)>|<[/!?][^>]*>"""
_TOKEN = re.compile(rf"{_COMMENT}|<({RAW})(?=[\s/>])[^>]*>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)|{_TAG}", re.S | re.I)
_FOREIGN = re.compile(rf"{_COMMENT}|<(script|style)(?=[\s/>])[^>]*(?<!/)>.*?(?:</\1(?=[\s/>])[^>]*>|(?=</(?:svg|math)[\s/>])|\Z)|{_TAG}", re.S | re.I)
_NAMES = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_LETTERS = re.compile(r"[a-z]+")


class Block:
    __slots__ = ("text", "path", "tag", "linked")

    def __init__(self, text: str, path: tuple[str, ...], tag: str, linked: int):
        self.text, self.path, self.tag, self.linked = text, path, tag, linked


def page_tags(page: str) -> list[tuple[int, int, str, bool, str]]:
    """(start, end, tag, closing, attributes) in page order.  Comments and elements without page text are one entry with
    an empty tag; a nested one that is never closed is its start tag alone."""
    found: list[tuple[int, int, str, bool, str]] = []
    open_: dict[str, list[int]] = {tag: [] for tag in NESTED}
    at, foreign = 0, False
    while m := (_FOREIGN if foreign else _TOKEN).search(page, at):
        at = m.end()
        tag, closing, names = (m[3] or m[6] or "").lower(), bool(m[2] or m[5]), m[4] or m[7] or ""
        found.append((m.start(), at, tag, closing, names))
        foreign_tag = tag in ("svg", "math")
        if foreign_tag and not closing and names.endswith("/"):
            continue
        if foreign_tag:
            foreign = not closing
        elif closing and tag == "foreignobject":
            foreign = True
        elif foreign and (tag in ("p", "br") if closing else tag in BREAKOUT):
            foreign = False
        if tag in open_:
            if not closing:
                open_[tag].append(len(found) - 1)
            elif open_[tag]:
                first = open_[tag].pop()
                found[first] = (found[first][0], at, "", False, "")
    ended, whole = 0, []
    for t in found:
        if t[0] >= ended:
            whole.append(t)
            ended = t[1]
    return whole


def page_blocks(page: str | None) -> list[Block]:
    """Leaf blocks in page order: character references decoded, white space as one space, empty ones left out."""
    if not page:
        return []
    blocks: list[Block] = []
    open_: list[tuple[str, tuple[str, ...]]] = []  # tag, its names and those of all around it
    parts: list[str] = []
    linked = links = 0

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                tag, path = open_[-1] if open_ else ("", ())
                blocks.append(Block(text, path, tag, min(linked, len(text))))
            parts, linked = [], 0

    def add(raw: str) -> None:
        nonlocal linked
        text = entities.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if links:
            linked += len(text)

    at = 0
    for start, end, tag, closing, names in page_tags(page):
        if start > at:
            add(page[at:start])
        at = end
        if not tag:
            continue
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            links = 0 if closing else 1
        elif tag in BLOCKS:
            flush()
            links = 0
            tags = [t for t, _ in open_]
            if closing:
                if tag in tags:
                    del open_[len(tags) - 1 - tags[::-1].index(tag) :]
                continue
            if "p" in tags:  # a paragraph ends where any block begins
                del open_[len(tags) - 1 - tags[::-1].index("p") :]
                tags = [t for t, _ in open_]
            kinds, bounds = CLOSES.get(tag, ((), ()))
            for i in range(len(tags) - 1, -1, -1):
                if tags[i] in bounds:
                    break
                if tags[i] in kinds:
                    del open_[i:]
                    break
            if tag not in VOID:
                own = [tag]
                for value in _NAMES.findall(names) if names else ():
                    own += _LETTERS.findall(value.lower())
                open_.append((tag, (open_[-1][1] if open_ else ()) + tuple(own)))
    if at < len(page):
        add(page[at:])
    flush()
    return blocks


# ---------------------------------------------------------------------------------------------- vectors


def _place(word: str, size: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % size


class _Cache(dict):
    """Values by key, worked out once; emptied when full."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, key):
        if len(self) >= CACHED:
            self.clear()
        self[key] = value = self.make(key)
        return value


def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    out = np.zeros(PATH_SIZE, np.float32)
    out[[_place(name, PATH_SIZE) for name in path if name not in ("html", "body")]] = 1.0
    return out


_paths = _Cache(_path_vector)
_words = _Cache(lambda w: _place(w, WORD_SIZE))


def block_vectors(blocks: list[Block]) -> np.ndarray:
    """One row per block: path, tag, words and measures."""
    out = np.zeros((len(blocks), INPUT_SIZE), np.float32)
    first, second = PATH_SIZE + TAG_SIZE, PATH_SIZE + TAG_SIZE + WORD_SIZE
    for row, b in zip(out, blocks, strict=True):
        words = b.text.lower().split()
        row[:PATH_SIZE] = _paths[b.path]
        row[PATH_SIZE + _place(b.tag, TAG_SIZE)] = 1.0
        counts = np.bincount(np.fromiter(map(_words.__getitem__, words), np.int64, len(words)), minlength=WORD_SIZE)
        row[first:second] = counts / max(len(words), 1) ** 0.5
        n = len(b.text)
        stops = b.text.count(".") + b.text.count("!") + b.text.count("?")
        row[second:] = (min(n, 10_000) ** 0.5 / 20, np.log1p(len(words)) / 4, b.linked / n, stops / (len(words) + 1), b.text[-1] in ".!?", "\xa9" in b.text, "|" in b.text, 1.0)
    return out


# ---------------------------------------------------------------------------------------------- the network


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


class BlockLabeller:
    """A bidirectional LSTM and a logistic output; arrays only, so it travels well."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.normal(size=shape) / shape[0] ** 0.5).astype(np.float32)
        self.weights = {}
        for side in "fb":
            self.weights |= {f"{side}x": draw(INPUT_SIZE, 4 * HIDDEN), f"{side}h": draw(HIDDEN, 4 * HIDDEN), f"{side}b": np.zeros(4 * HIDDEN, np.float32)}
            self.weights[f"{side}b"][HIDDEN : 2 * HIDDEN] = 1.0  # forget gates start open
        self.weights |= {"o": draw(2 * HIDDEN, 1), "ob": np.zeros(1, np.float32)}

    def _side(self, side: str, x: np.ndarray, mask: np.ndarray, keep: list | None) -> np.ndarray:
        """Hidden states (time, page, unit) of one direction; ``mask`` is 0 beyond a page's end."""
        w, steps, pages = self.weights, x.shape[0], x.shape[1]
        inputs = x @ w[f"{side}x"] + w[f"{side}b"]
        h, c, out = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32), np.zeros((steps, pages, HIDDEN), np.float32)
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            gates = inputs[t] + h @ w[f"{side}h"]
            i, f, o = (_sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in (0, 1, 2))
            g = np.tanh(gates[:, 3 * HIDDEN :])
            new_c = (f * c + i * g) * mask[t, :, None]
            new_h = o * np.tanh(new_c) * mask[t, :, None]
            if keep is not None:
                keep.append((t, i, f, o, g, c, new_c, h))
            h, c = new_h, new_c
            out[t] = h
        return out

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Log odds (time, page) that a block is main text."""
        both = np.concatenate([self._side("f", x, mask, None), self._side("b", x, mask, None)], axis=2)
        return (both @ self.weights["o"] + self.weights["ob"])[:, :, 0]

    def gradients(self, x: np.ndarray, mask: np.ndarray, wanted: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        w, kept = self.weights, {"f": [], "b": []}
        both = np.concatenate([self._side(s, x, mask, kept[s]) for s in "fb"], axis=2)
        chance = _sigmoid((both @ w["o"] + w["ob"])[:, :, 0])
        n = mask.sum()
        loss = -(mask * (wanted * np.log(chance + 1e-9) + (1 - wanted) * np.log(1 - chance + 1e-9))).sum() / n
        error = (chance - wanted) * mask / n
        out = {"o": np.einsum("tpu,tp->u", both, error)[:, None], "ob": np.array([error.sum()], np.float32)}
        back = error[:, :, None] * w["o"][:, 0]
        for at, side in enumerate("fb"):
            up = back[:, :, at * HIDDEN : (at + 1) * HIDDEN]
            gates = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            weights_h = np.zeros_like(w[f"{side}h"])
            dh, dc = np.zeros_like(up[0]), np.zeros_like(up[0])
            for t, i, f, o, g, c, new_c, h in reversed(kept[side]):
                m = mask[t, :, None]
                dh = (dh + up[t]) * m
                bent = np.tanh(new_c)
                dc = (dc + dh * o * (1 - bent**2)) * m
                parts = [dc * g * i * (1 - i), dc * c * f * (1 - f), dh * bent * o * (1 - o), dc * i * (1 - g**2)]
                gates[t] = np.concatenate(parts, axis=1)
                weights_h += h.T @ gates[t]
                dh, dc = gates[t] @ w[f"{side}h"].T, dc * f
            flat = gates.reshape(-1, 4 * HIDDEN)
            out |= {f"{side}x": x.reshape(-1, INPUT_SIZE).T @ flat, f"{side}h": weights_h, f"{side}b": flat.sum(0)}
        return float(loss), out

    def main_blocks(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """For each page which of its blocks are main text; pages of like length are read side by side."""
        found: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
        while order:
            n = len(pages[order[-1]])
            group = order[-max(1, BATCH_BLOCKS // n) :]
            del order[-len(group) :]
            x, mask = np.zeros((n, len(group), INPUT_SIZE), np.float32), np.zeros((n, len(group)), np.float32)
            for k, i in enumerate(group):
                x[: len(pages[i]), k] = block_vectors(pages[i])
                mask[: len(pages[i]), k] = 1.0
            odds = self.scores(x, mask)
            for k, i in enumerate(group):
                found[i] = odds[: len(pages[i]), k] > 0
        return found


# ---------------------------------------------------------------------------------------------- training pages

MARK = ""  # begins every main block of a composed page
SYLLABLES = "an er on the ti en re ou ion le es mi do que sch ung ge ra ta lo na vi pa to si ko".split()
MAIN_NAMES = ["content", "article", "article-body", "post", "post-content", "entry-content", "story", "story-body", "main", "main-content", "text", "body-copy", ""]
PLAIN_NAMES = ["container", "wrapper", "row", "col", "inner", "box", "section", "block", "page", "left", "x", ""]
#: Words that menus, notices and forms are made of, in the four languages of the tables.
SMALL_TALK = (
    "home menu about contact login sign up search news privacy terms cookies accept all settings copyright rights reserved share follow reply comment "
    "comments advertisement sponsored subscribe newsletter email password submit read more related next previous accueil connexion rechercher cookies "
    "accepter commentaires abonnez startseite anmelden suche datenschutz impressum kommentare werbung inicio buscar aceptar comentarios publicidad"
).split()
BOILERPLATE = {
    "nav": ["nav", "menu", "navigation", "navbar", "breadcrumb", "breadcrumbs", "topbar"],
    "header": ["header", "site-header", "masthead", "branding", "top"],
    "footer": ["footer", "site-footer", "bottom", "copyright", "legal"],
    "aside": ["sidebar", "aside", "widget", "related", "recommended", "trending", "rail", "popular"],
    "notice": ["cookie", "cookie-notice", "notice", "consent", "alert", "gdpr", "banner", "popup", "modal", "disclaimer", "paywall"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "promotion", "banner-ad", "sponsor"],
    "form": ["search", "newsletter", "login", "subscribe", "contact-form", "signup"],
    "comments": ["comments", "comment", "comment-list", "discussion", "replies", "responses", "disqus", "reviews"],
    "share": ["share", "social", "tags", "pagination", "meta-links"],
}


def make_page(rng: random.Random) -> str:
    """A page whose main blocks begin with ``MARK``."""
    word = lambda: "".join(rng.choices(SYLLABLES, k=rng.randint(1, 4)))
    name = lambda names: f' {rng.choice(["class", "class", "id"])}="{n}"' if (n := rng.choice(names)) else ""

    def words(low: int, high: int) -> str:
        return " ".join(word() for _ in range(rng.randint(low, high)))

    def prose(low: int = 4, high: int = 90) -> str:
        text = words(low, high)
        if rng.random() < 0.15:
            text = " | ".join(text.split(" "))
        if rng.random() < 0.1:
            text = text.upper().replace(" ", "!! ")
        if rng.random() < 0.3:
            text = text.replace(" ", ". ", 1 + len(text) // 60)
        if rng.random() < 0.2:
            text = f"<b>{text}" + ("</b>" if rng.random() < 0.6 else "")
        if rng.random() < 0.15:
            text += f' <a href="/{word()}">{words(1, 4)}</a> {words(1, 9)}'
        return text[:1].upper() + text[1:] + rng.choice([".", ".", ".", "", "!", "<br>"])

    def talk(low: int, high: int) -> str:
        return " ".join(rng.choice(SMALL_TALK) if rng.random() < 0.5 else word() for _ in range(rng.randint(low, high))).capitalize()

    def links(low: int = 2, high: int = 7) -> str:
        items = [f'<a href="/{word()}">{talk(1, 3)}</a>' for _ in range(rng.randint(low, high))]
        shape = rng.random()
        return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>" if shape < 0.6 else "".join(f"<div>{i}</div>" for i in items) if shape < 0.8 else " ".join(items)

    def junk(kind: str, inside: bool = False) -> str:
        tag = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}.get(kind, "section")
        own = rng.random() < (0.6 if kind in ("nav", "header", "footer", "aside", "form") else 0.15)
        names = "" if own and tag != "section" and rng.random() < 0.6 else name(BOILERPLATE[kind])
        tag = tag if own else "form" if kind == "form" else rng.choice(["div", "div", "section", "ul"] if kind == "comments" else ["div"])
        if kind == "nav":
            body = links()
        elif kind == "header":
            body = rng.choice([f"<h1>{talk(1, 4)}</h1>", f"<div>{talk(1, 4)}</div>", f"<p>{talk(2, 8)}</p>", ""]) + (links() if rng.random() < 0.5 else "")
            body = body or talk(1, 4)
        elif kind == "footer":
            body = rng.choice([f"&copy; {word()}.example.net &middot; {prose(2, 20)}", f"<p>&copy; 2020 {talk(1, 5)}</p>", links(), f"<p>{prose(3, 30)}</p>", talk(2, 10)])
        elif kind == "aside":
            body = rng.choice([f"<h3>{talk(1, 4)}</h3>" + links(), f"<p>{prose(4, 40)}</p>", links(), f"<h2>{talk(1, 3)}</h2><p>{prose(4, 60)}</p><p>{prose(4, 60)}</p>"])
        elif kind == "notice":
            body = rng.choice([f"<p>{talk(4, 25)}</p><button>{talk(1, 2)}</button>", prose(4, 30), f"<p>{prose(4, 40)}</p>", f"<div>{talk(4, 20)}</div>"])
        elif kind == "ad":
            body = rng.choice([prose(2, 25), f"<p>{prose(2, 25)}</p>", f'<a href="/{word()}">{prose(2, 15)}</a>', f"<div><h4>{talk(1, 5)}</h4><p>{prose(2, 30)}</p></div>"])
        elif kind == "form":
            body = f"<label>{talk(1, 4)}</label><input name=q><button>{talk(1, 2)}</button>" + (f"<p>{talk(3, 15)}</p>" if rng.random() < 0.4 else "")
        elif kind == "comments":
            one = lambda: rng.choice([f"<p>{prose(3, 60)}</p>", f'<div class="comment"><span>{word()}</span><p>{prose(3, 60)}</p></div>', f"<b>{word()}</b><div>{prose(3, 50)}</div>"])
            item = "li" if tag == "ul" else "div"
            body = rng.choice(["", f"<h2>{talk(1, 3)}</h2>"]) + "".join(f"<{item}>{one()}</{item}>" for _ in range(rng.randint(1, 6)))
        else:
            body = links(2, 5)
        return f"<{tag}{names}>{body}</{tag}>"

    def main_block() -> str:
        shape = rng.random()
        if shape < 0.18:
            return f"<p>{MARK}{prose(1, 12)}" + ("</p>" if rng.random() < 0.9 else "")
        if shape < 0.62:
            return f"<p>{MARK}{prose()}" + ("</p>" if rng.random() < 0.9 else "")
        if shape < 0.72:
            return f"<h{(n := rng.randint(1, 4))}>{MARK}{words(2, 10)}</h{n}>"
        if shape < 0.80:
            return "<ul>" + "".join(f"<li>{MARK}{prose(2, 25)}</li>" for _ in range(rng.randint(1, 6))) + "</ul>"
        if shape < 0.85:
            return f"<blockquote>{MARK}{prose(4, 40)}</blockquote>"
        if shape < 0.90:
            return "<table>" + "".join(f"<tr><td>{MARK}{words(1, 4)}</td><td>{MARK}{words(1, 4)}</td></tr>" for _ in range(rng.randint(1, 4))) + "</table>"
        if shape < 0.94:
            return f"<figure><img src=x><figcaption>{MARK}{prose(3, 15)}</figcaption></figure>"
        return f"<pre>{MARK}{words(3, 30)}</pre>" if shape < 0.96 else f"<div>{MARK}{prose()}</div>"

    blocks = [f"<h1>{MARK}{words(2, 12)}</h1>"] if rng.random() < 0.7 else []
    for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 12])):
        blocks.append(main_block())
        if rng.random() < 0.12:
            blocks.append(junk(rng.choice(["ad", "aside", "notice", "form", "share", "nav"]), True))
    if rng.random() < 0.15:
        blocks.append(junk("comments", True))
    body = "".join(blocks)
    holder = rng.random()
    if holder < 0.5:
        body = f"<article{name(MAIN_NAMES)}>{body}</article>"
    elif holder < 0.65:
        body = f"<main{name(MAIN_NAMES)}>{body}</main>"
    elif holder < 0.92:
        body = f'<div {rng.choice(["class", "id"])}="{rng.choice([n for n in MAIN_NAMES if n])}">{body}</div>'
    if rng.random() < 0.2:
        body = f"<main>{body}</main>"
    for _ in range(rng.choice([0, 0, 1, 2])):
        body = f"<div{name(PLAIN_NAMES)}>{body}</div>"
    before = [junk(k) for k in ("nav", "header", "notice", "ad", "share", "form") if rng.random() < 0.45]
    after = [junk(k) for k in ("comments", "aside", "ad", "form", "share", "notice", "nav") if rng.random() < 0.35]
    rng.shuffle(before)
    rng.shuffle(after)
    if rng.random() < 0.2:
        before.append(junk("aside"))
    if rng.random() < 0.8:
        after.append(junk("footer"))
    head = f"<!DOCTYPE html><html><head><title>{words(1, 6)}</title><style>p{{margin:0}}</style></head><body>"
    whole = "".join(before) + body + "".join(after)
    return head + whole + ("</body></html>" if rng.random() < 0.9 else "")


@cache
def trained_labeller(pages: int = TRAIN_PAGES, rounds: int = 8, seed: int = 11) -> BlockLabeller:
    """Train on composed pages with Adam; the same each time."""
    rng, model = random.Random(seed), BlockLabeller(seed)
    examples = []
    for _ in range(pages):
        blocks = page_blocks(make_page(rng))
        labels = np.array([b.text.startswith(MARK) for b in blocks], np.float32)
        for b in blocks:
            b.text = b.text.removeprefix(MARK).strip() or "-"
        if blocks:
            examples.append((block_vectors(blocks), labels))
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    step, total = 0, rounds * -(-len(examples) // 16)
    for _ in range(rounds):
        rng.shuffle(examples)
        for at in range(0, len(examples), 16):
            group = examples[at : at + 16]
            n = max(len(y) for _, y in group)
            x, mask, wanted = np.zeros((n, len(group), INPUT_SIZE), np.float32), np.zeros((n, len(group)), np.float32), np.zeros((n, len(group)), np.float32)
            for k, (v, y) in enumerate(group):
                x[: len(y), k], mask[: len(y), k], wanted[: len(y), k] = v, 1.0, y
            _, slopes = model.gradients(x, mask, wanted)
            norm = np.sqrt(sum(float((g**2).sum()) for g in slopes.values()))
            step += 1
            rate = 0.012 * (1 - step / (total + 1))
            for k, g in slopes.items():
                g = g / max(1.0, norm / 2)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g**2
                model.weights[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


# ---------------------------------------------------------------------------------------------- the operator


def main_text(blocks: list[Block], is_main: np.ndarray) -> str:
    return " ".join(b.text for b, m in zip(blocks, is_main, strict=True) if m)


def extract_main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", model: BlockLabeller | None = None) -> DataFrame:
    """(key, url, text, n_chars, n_blocks, n_main): one row per row of ``pages``.

    Null and empty pages, and pages without main text, have the empty text.  Repeated rows give repeated rows; other
    columns are not read.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or trained_labeller())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            while at < batch.num_rows:  # a run of pages at a time, so that few are held as blocks
                rows = batch.slice(at, 256)
                at += rows.num_rows
                parsed = [page_blocks(h) for _, h in text_rows(rows, key, html)]
                labels = shared.value.main_blocks(parsed)
                texts = [main_text(b, m) for b, m in zip(parsed, labels, strict=True)]
                columns = [
                    rows.column(0), rows.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([len(b) for b in parsed], pa.int64()), pa.array([int(m.sum()) for m in labels], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[key, url, "text", "n_chars", "n_blocks", "n_main"])

    rows = pages.select(key, url, html)
    kind = {c: rows.schema[c].dataType.simpleString() for c in (key, url)}
    return rows.mapInArrow(work, f"`{key}` {kind[key]}, `{url}` {kind[url]}, text string, n_chars long, n_blocks long, n_main long")

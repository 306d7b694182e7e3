"""Main text of web pages: a bidirectional LSTM labels every block of a page.

A page is cut into leaf blocks, the runs of text between block-level tags. A block is seen as the
hashed names, classes and ids on its tag path, its hashed words, and a few measures; the LSTM reads
the blocks of the whole page in both directions and decides for each whether it is main text.

The model is trained here, on at most SAMPLE_PAGES pages that mark their article with an article or
main element. Such a mark teaches what is main text; so that the model does not lean on it, the
pages' own texts are also laid out anew in LAYOUTS other ways, with menus, notices, adverts, forms,
sidebars and reader comments around and inside the article, and with or without telling names.
"""

from __future__ import annotations

import html as entities
import pickle
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import rows, saved

#: Pages the model is fitted on, those of the least hash, and layouts made of each.
SAMPLE_PAGES = 320
LAYOUTS = 3
#: Blocks of a training page; pages to label are never cut.
TRAIN_BLOCKS = 90
EPOCHS = 8
BATCH = 24
RATE = 0.01
PATH_IDS, WORD_IDS, PATH_DIM, WORD_DIM, HIDDEN = 1024, 2048, 16, 8, 20
MEASURES = 7

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|</?[a-zA-Z](?:[^<>\"']|\"[^\"]*\"|'[^']*')*>|[^<]+|<", re.S
)
_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z]+")
#: Elements whose content is never text of the page.
SILENT = frozenset("script style template noscript head title svg iframe object canvas select textarea button".split())
#: Raw text up to their own end tag.
RAW = frozenset("script style textarea title iframe noscript template".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code del dfn em font i img input ins kbd label mark q s samp small span"
    " strike strong sub sup time tt u var wbr br".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An element of the key ends open elements of the values, up to the nearest container.
CLOSES = {
    **dict.fromkeys("li".split(), {"li"}),
    **dict.fromkeys("dt dd".split(), {"dt", "dd"}),
    **dict.fromkeys("td th".split(), {"td", "th"}),
    "tr": {"tr", "td", "th"},
    "option": {"option"},
}


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    link_chars: int = 0


@dataclass
class _Open:
    name: str
    names: tuple[str, ...]


def names_of(name: str, tag: str) -> tuple[str, ...]:
    """The element and the words of its class, id and role."""
    out = [name]
    if "=" in tag:
        for match in _ATTRIBUTE.finditer(tag):
            value = match[2] or match[3] or match[4] or ""
            out += ["." + part for part in _PART.findall(value.lower())]
    return tuple(out)


def blocks_of(page: str | None) -> list[Block]:
    """The page's blocks in order. Tags left open or closed twice do no harm."""
    found: list[Block] = []
    stack: list[_Open] = []
    parts: list[str] = []
    linked = silent = links = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            path = tuple(name for item in stack for name in item.names)
            found.append(Block(text, path, min(linked, len(text))))
        parts.clear()
        linked = 0

    def pop_to(place: int) -> None:
        nonlocal silent, links
        if any(item.name not in INLINE for item in stack[place:]):
            flush()
        for item in stack[place:]:
            silent -= item.name in SILENT
            links -= item.name == "a"
        del stack[place:]

    text = page or ""
    at, end = 0, len(text)
    while at < end:
        match = _TOKEN.match(text, at)
        token = match[0]
        at = match.end()
        if token[0] != "<" or len(token) == 1:
            if not silent:
                parts.append(token)
                if links:
                    linked += len(token)
            continue
        named = _NAME.match(token)
        if not named:
            continue
        name = named[1].lower()
        if token[1] == "/":
            place = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].name == name), -1)
            if place >= 0:
                pop_to(place)
            elif name not in INLINE:
                flush()
            continue
        if name in INLINE:
            if name == "br":
                parts.append(" ")
        else:
            open_p = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].name == "p"), -1)
            if open_p >= 0:
                pop_to(open_p)
            flush()
            ends = CLOSES.get(name, frozenset())
            while stack and stack[-1].name in ends | INLINE and ends:
                pop_to(len(stack) - 1)
        if name in VOID or token.endswith("/>"):
            continue
        if name in RAW:
            close = re.compile(rf"</{name}\s*>", re.I).search(text, at)
            at = close.end() if close else end
            continue
        stack.append(_Open(name, names_of(name, token)))
        silent += name in SILENT
        links += name == "a"
    flush()
    return found


def hashed(word: str, n: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % n


@dataclass
class Seen:
    """A page as the model reads it: ids in one list a kind, with the start of each block's."""

    path: np.ndarray
    path_at: np.ndarray
    word: np.ndarray
    word_at: np.ndarray
    measures: np.ndarray


_path_ids: dict[str, int] = {}


def path_id(name: str) -> int:
    if name not in _path_ids:
        if len(_path_ids) > 100_000:
            _path_ids.clear()
        _path_ids[name] = hashed(name, PATH_IDS)
    return _path_ids[name]


_word_ids: dict[str, int] = {}


def word_id(word: str) -> int:
    """The hash of a word; a worker remembers a bounded number of short ones."""
    found = _word_ids.get(word)
    if found is None:
        found = hashed(word, WORD_IDS)
        if len(word) <= 24:
            if len(_word_ids) > 100_000:
                _word_ids.clear()
            _word_ids[word] = found
    return found


def seen(blocks: list[Block]) -> Seen:
    path, path_at, word, word_at, measures = [], [], [], [], []
    n = len(blocks)
    for i, block in enumerate(blocks):
        path_at.append(len(path))
        word_at.append(len(word))
        path += [path_id(name) for name in block.path]
        path.append(path_id("leaf:" + next((p for p in reversed(block.path) if p[0] != "."), "")))
        words = block.text.lower().split()
        word += [word_id(w) for w in words]
        size = len(block.text)
        measures.append(
            (
                np.log1p(len(words)) / 5,
                block.link_chars / size,
                size / len(words) / 10,
                float(block.text[-1] in ".!?\"'…。"),
                i / n,
                (n - i) / n,
                min(block.text.count(",") / len(words), 1),
            )
        )
    return Seen(*(np.array(x, np.int64) for x in (path, path_at, word, word_at)), np.array(measures).reshape(-1, MEASURES))


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Labeller:
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fresh() -> "Labeller":
        rng = np.random.default_rng(10)
        d = PATH_DIM + WORD_DIM + MEASURES
        w = {
            "path": rng.normal(0, 0.1, (PATH_IDS, PATH_DIM)),
            "word": rng.normal(0, 0.1, (WORD_IDS, WORD_DIM)),
            "out": rng.normal(0, 0.2, 2 * HIDDEN + d),
            "bias": np.zeros(1),
        }
        for way in ("f", "b"):
            w["x" + way] = rng.normal(0, 1 / np.sqrt(d), (d, 4 * HIDDEN))
            w["h" + way] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
            w["o" + way] = np.concatenate((np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)))
        return Labeller(w)

    @staticmethod
    def keeping_all() -> "Labeller":
        model = Labeller.fresh()
        model.weights["out"][:] = 0
        model.weights["bias"][:] = 1
        return model

    def inputs(self, pages: list[Seen]) -> tuple[np.ndarray, np.ndarray]:
        """pages x blocks x features, zero beyond a page's end, and the mask of real blocks."""
        w = self.weights
        length = max(len(p.path_at) for p in pages)
        x = np.zeros((len(pages), length, PATH_DIM + WORD_DIM + MEASURES))
        mask = np.zeros((len(pages), length))
        for i, p in enumerate(pages):
            n = len(p.path_at)
            x[i, :n, :PATH_DIM] = np.add.reduceat(w["path"][p.path], p.path_at)
            count = np.diff(np.append(p.word_at, len(p.word)))[:, None]
            x[i, :n, PATH_DIM : PATH_DIM + WORD_DIM] = np.add.reduceat(w["word"][p.word], p.word_at) / count
            x[i, :n, PATH_DIM + WORD_DIM :] = p.measures
            mask[i, :n] = 1
        return x, mask

    def run(self, x: np.ndarray, mask: np.ndarray, way: str, keep: list | None = None) -> np.ndarray:
        """Hidden states. The state stands still on blocks beyond a page's end."""
        w = self.weights
        n, length, _ = x.shape
        gates_x = x @ w["x" + way] + w["o" + way]
        h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
        out = np.zeros((n, length, HIDDEN))
        for t in range(length) if way == "f" else range(length - 1, -1, -1):
            g = gates_x[:, t] + h @ w["h" + way]
            i, f, o = (sigmoid(g[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            u = np.tanh(g[:, 3 * HIDDEN :])
            m = mask[:, t : t + 1]
            new_c = m * (f * c + i * u) + (1 - m) * c
            tanh_c = np.tanh(new_c)
            if keep is not None:
                keep.append((t, h, c, i, f, o, u, tanh_c, m))
            h = m * (o * tanh_c) + (1 - m) * h
            c = new_c
            out[:, t] = h
        return out

    def scores(self, pages: list[Seen]) -> list[np.ndarray]:
        x, mask = self.inputs(pages)
        states = np.concatenate([self.run(x, mask, "f"), self.run(x, mask, "b"), x], axis=2)
        p = sigmoid(states @ self.weights["out"] + self.weights["bias"])
        return [p[i, : len(page.path_at)] for i, page in enumerate(pages)]

    def gradients(self, pages: list[Seen], truth: list[np.ndarray]) -> dict[str, np.ndarray]:
        w = self.weights
        x, mask = self.inputs(pages)
        kept: dict[str, list] = {"f": [], "b": []}
        states = np.concatenate([self.run(x, mask, k, kept[k]) for k in "fb"] + [x], axis=2)
        y = np.zeros(mask.shape)
        for i, t in enumerate(truth):
            y[i, : len(t)] = t
        error = (sigmoid(states @ w["out"] + w["bias"]) - y) * mask / mask.sum()
        g = {"out": np.einsum("nt,ntd->d", error, states), "bias": np.array([error.sum()])}
        back = error[:, :, None] * w["out"]
        dx = back[:, :, 2 * HIDDEN :].copy()
        for number, way in enumerate("fb"):
            dout = back[:, :, number * HIDDEN : (number + 1) * HIDDEN]
            dgates = np.zeros((*mask.shape, 4 * HIDDEN))
            g["h" + way] = np.zeros_like(w["h" + way])
            dh, dc = np.zeros((len(x), HIDDEN)), np.zeros((len(x), HIDDEN))
            for t, h, c, i, f, o, u, tanh_c, m in reversed(kept[way]):
                dh = dh + dout[:, t]
                live = dh * m
                dcell = dc * m + live * o * (1 - tanh_c**2)
                dg = np.concatenate(
                    [dcell * u * i * (1 - i), dcell * c * f * (1 - f), live * tanh_c * o * (1 - o), dcell * i * (1 - u**2)],
                    axis=1,
                )
                dgates[:, t] = dg
                g["h" + way] += h.T @ dg
                dh = dg @ w["h" + way].T + dh * (1 - m)
                dc = dcell * f + dc * (1 - m)
            g["x" + way] = np.einsum("ntd,ntg->dg", x, dgates)
            g["o" + way] = dgates.sum((0, 1))
            dx += dgates @ w["x" + way].T
        g["path"], g["word"] = np.zeros_like(w["path"]), np.zeros_like(w["word"])
        for i, p in enumerate(pages):
            n = len(p.path_at)
            sizes = np.diff(np.append(p.path_at, len(p.path)))
            np.add.at(g["path"], p.path, np.repeat(dx[i, :n, :PATH_DIM], sizes, axis=0))
            sizes = np.diff(np.append(p.word_at, len(p.word)))
            share = dx[i, :n, PATH_DIM : PATH_DIM + WORD_DIM] / sizes[:, None]
            np.add.at(g["word"], p.word, np.repeat(share, sizes, axis=0))
        return g


NOT_MAIN = {"nav", "aside", "footer", "form", "header", ".ad", ".ads", ".comments", ".comment", ".sidebar"}


def marked(block: Block) -> bool:
    """Whether the page's own elements mark the block as main text."""
    inner = [i for i, name in enumerate(block.path) if name in ("article", "main")]
    return bool(inner) and not NOT_MAIN.intersection(block.path[inner[0] :])


_MAIN = ["article", "main", "section", 'div class="{}"', 'div id="{}"', "div", 'td class="{}"', 'section class="{}"']
_MAIN_NAMES = "content post entry story article body text main page-content post-body entry-content article-text".split()
#: Kinds of matter around an article: elements and names such pages commonly use.
_AROUND = {
    "menu": (["nav", 'ul class="{}"', 'div class="{}"', 'div id="{}"'], "menu nav navigation navbar topnav breadcrumb breadcrumbs links toc".split()),
    "header": (["header", 'div class="{}"', 'div id="{}"'], "header masthead top banner branding site-header logo".split()),
    "footer": (["footer", 'div class="{}"', 'div id="{}"'], "footer bottom copyright site-footer colophon legal".split()),
    "sidebar": (["aside", 'div class="{}"', 'div id="{}"', 'td class="{}"'], "sidebar side related widget rail recommended popular more".split()),
    "notice": (['div class="{}"', 'div id="{}"', 'p class="{}"', 'section class="{}"'], "notice cookie cookies consent alert gdpr newsletter subscribe popup modal message".split()),
    "advert": (['div class="{}"', 'div id="{}"', "aside", 'p class="{}"'], "ad ads advert advertisement sponsored promo banner-ad sponsor".split()),
    "form": (["form", 'form class="{}"', 'div class="{}"'], "search login signup form contact comment-form".split()),
    "comments": (['section class="{}"', 'div id="{}"', 'div class="{}"', 'ol class="{}"'], "comments comment replies responses discussion commentlist reader-comments thread".split()),
}


def laid_out(main: list[str], other: list[str], rng: np.random.Generator) -> tuple[str, list[bool]]:
    """A page of these texts in a random layout, and which of its blocks are main text."""
    out: list[str] = []
    truth: list[bool] = []
    words = " ".join(other + main[:3]).split() or ["text"]

    def phrase(least: int, most: int) -> str:
        return entities.escape(" ".join(rng.choice(words, rng.integers(least, most + 1))), quote=False)

    def add(text: str, good: bool, tag: str = "p", close: bool = True) -> None:
        if entities.unescape(text).split():
            out.append(f"<{tag}>{text}" + (f"</{tag.split()[0]}>" if close else ""))
            truth.append(good)

    def around(kind: str) -> None:
        tags, names = _AROUND[kind]
        tag = str(rng.choice(tags)).format(rng.choice(names))
        inner = str(rng.choice(["p", "div", "span class=x"])) if rng.random() < 0.3 else "p"
        out.append(f"<{tag}>")
        if kind == "menu" or kind in ("sidebar", "footer") and rng.random() < 0.5:
            if rng.random() < 0.3 and kind == "sidebar":
                add(phrase(1, 4), False, "h3")
            listed = tag.startswith("ul") or rng.random() < 0.8
            out.append("<ul>" if listed and not tag.startswith("ul") else "")
            for _ in range(rng.integers(2, 9)):
                add(f'<a href="/x">{phrase(1, 4)}</a>', False, "li" if listed else "div")
            out.append("</ul>" if listed and not tag.startswith("ul") else "")
        elif kind == "form":
            for _ in range(rng.integers(1, 4)):
                add(f'<label>{phrase(1, 3)}</label> <input type="text">', False, "div")
        elif kind == "comments":
            if rng.random() < 0.6:
                add(phrase(1, 3), False, "h3")
            for _ in range(rng.integers(1, 6)):
                wrap = str(rng.choice(['div class="comment"', "li", "div", "article"]))
                out.append(f"<{wrap}>")
                if rng.random() < 0.6:
                    add(phrase(1, 3), False, str(rng.choice(["b", "div", "p", "h4"])) if wrap != "li" else "p")
                text = str(rng.choice(main)) if main and rng.random() < 0.3 else phrase(3, 40)
                add(text if "<" not in text else phrase(3, 40), False)
                out.append(f"</{wrap.split()[0]}>")
        else:
            if kind == "header" and rng.random() < 0.5:
                add(phrase(1, 5), False, str(rng.choice(["h1", "h2", "div"])))
            for _ in range(rng.integers(1, 3)):
                add(phrase(2, 20), False, "p" if inner.startswith("span") else inner)
        out.append(f"</{tag.split()[0]}>")

    out.append("<!DOCTYPE html><html><head><title>x</title></head><body>")
    if rng.random() < 0.5:
        out.append("<div>")
    for kind in ("header", "menu", "notice", "advert", "sidebar"):
        if rng.random() < 0.45:
            around(kind)
    tag = str(rng.choice(_MAIN)).format(rng.choice(_MAIN_NAMES))
    out.append(f"<{tag}>")
    for i, text in enumerate(main):
        safe = entities.escape(text, quote=False)
        kind = "h1" if not i and rng.random() < 0.7 else "h2" if len(text) < 60 and rng.random() < 0.4 else "p"
        if rng.random() < 0.1:
            kind = str(rng.choice(["li", "blockquote", "div", "pre", "td"]))
        if rng.random() < 0.1:
            safe = f'{safe} <a href="/y">{phrase(1, 3)}</a>'
        add(safe, True, kind, close=kind != "p" or rng.random() < 0.8)
        if rng.random() < 0.06:
            around(str(rng.choice(["advert", "sidebar", "notice", "form", "menu"])))
    inside = rng.random() < 0.3
    if inside and rng.random() < 0.6:
        around("comments")
    out.append(f"</{tag.split()[0]}>")
    for kind in ("comments", "sidebar", "advert", "form", "notice", "menu", "footer"):
        if rng.random() < 0.4:
            around(kind)
    out.append("</body></html>" if rng.random() < 0.8 else "")
    return "".join(out), truth


def fit(pages: list[str]) -> Labeller:
    model = Labeller.fresh()
    rng = np.random.default_rng(12)
    examples: list[tuple[Seen, np.ndarray]] = []
    for page in pages:
        blocks = blocks_of(page)
        truth = np.array([marked(block) for block in blocks], float)
        if not 0 < truth.sum():
            continue
        examples.append((seen(blocks[:TRAIN_BLOCKS]), truth[:TRAIN_BLOCKS]))
        main = [b.text for b, y in zip(blocks, truth) if y][: TRAIN_BLOCKS // 2]
        other = [b.text for b, y in zip(blocks, truth) if not y][:TRAIN_BLOCKS]
        for _ in range(LAYOUTS):
            some = main[: int(rng.integers(1, len(main) + 1))]
            made, labels = laid_out(some, other, rng)
            cut = blocks_of(made)
            if len(cut) == len(labels):
                examples.append((seen(cut[:TRAIN_BLOCKS]), np.array(labels[:TRAIN_BLOCKS], float)))
    if not examples:
        return Labeller.keeping_all()
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.weights.items()}
    step, total = 0, EPOCHS * -(-len(examples) // BATCH)
    for _ in range(EPOCHS):
        # pages of like length together, batches in random order
        order = sorted(rng.permutation(len(examples)), key=lambda i: len(examples[i][1]) // 8)
        starts = np.arange(0, len(order), BATCH)
        for start in rng.permutation(starts):
            part = [examples[i] for i in order[start : start + BATCH]]
            step += 1
            rate = RATE * (1 - 0.9 * step / total)
            for name, g in model.gradients([p for p, _ in part], [y for _, y in part]).items():
                g = np.clip(g, -1, 1)
                m, v = moments[name]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                scale = (1 - 0.9**step) / np.sqrt(1 - 0.99**step)
                model.weights[name] -= rate * m / (np.sqrt(v) + 1e-8) / scale
    return model


def train(spark: SparkSession, pages: DataFrame) -> Labeller:
    """Fitted in one task on the sample; its size is bounded in pages, whatever the table's.

    Copies of a page count once, so a large group of them cannot fill the sample.
    """
    order = F.xxhash64(F.lit(10), "html")
    marked_pages = pages.filter(F.lower("html").rlike("<(article|main)[\\s>]")).select(
        order.alias("rank"), "html"
    )
    # SAMPLE_PAGES rows at most, so broadcasting them is safe
    least = saved(spark, marked_pages.select("rank").distinct().orderBy("rank").limit(SAMPLE_PAGES), "page-ranks")
    chosen = marked_pages.join(F.broadcast(least), "rank", "left_semi")
    sample = saved(spark, chosen.groupBy("rank").agg(F.min("html").alias("html")), "page-sample")

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [page for _, page in sorted(rows(batches, "rank", "html"))]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(held))], pa.binary())], names=["model"])

    row = sample.repartition(1).mapInArrow(fitted, "model binary").first()
    return pickle.loads(row["model"]) if row else Labeller.keeping_all()


def extract(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row.

    NULL, empty and textless pages give an empty text. Blocks are joined in page order by a line
    end; nothing is cut off. Repeated rows count each time. Where no page marks its main text there
    is nothing to learn from, and every block is kept. No rows give no rows.
    """
    model = spark.sparkContext.broadcast(train(spark, pages))

    def main_texts(texts: list[str | None]) -> list[str]:
        cut = [blocks_of(text) for text in texts]
        order = sorted((i for i in range(len(cut)) if cut[i]), key=lambda i: len(cut[i]))
        out = [""] * len(cut)
        at = 0
        while at < len(order):
            size = max(1, min(64, 20_000 // len(cut[order[min(at + 63, len(order) - 1)]])))
            part = order[at : at + size]
            at += size
            for i, scores in zip(part, model.value.scores([seen(cut[i]) for i in part])):
                out[i] = "\n".join(b.text for b, p in zip(cut[i], scores) if p >= 0.5)
        return out

    @F.pandas_udf("string")
    def text_of(pages_html):
        import pandas as pd

        texts = pages_html.tolist()
        parts = [main_texts(texts[at : at + 512]) for at in range(0, len(texts), 512)]
        return pd.Series([text for part in parts for text in part], dtype="object")

    found = pages.select("page_id", "url", text_of(F.col("html")).alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))

"""Main text of web pages: flat text blocks, classified by a decision tree on words and link density of neighbours.

A page is cut at block-level tags into a flat list of text blocks.  Features of a block are its number of words and
its share of linked words, the same of the blocks before and after, whether an element such as nav or footer, or an
article, holds it, and how far the class words of its own container speak of furniture ("sidebar") or of text
("content").  The tree is trained by Spark ML on a small labelled table, pages of many layouts below, and applied block
by block.  A form is furniture unless most of the page's words are in it, and a headline in the page's header stands if
the page has no other and it leads nowhere.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Elements that begin or end a block of text, those whose content is no text, and void elements.
BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul".split())
NO_TEXT = set("noscript template iframe object svg math button select canvas audio video".split())
RAW = set("script style textarea title".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that may stand in a head, and block elements that hold text rather than other blocks.
IN_HEAD = set("meta link base basefont bgsound title noscript template noframes script style".split())
OF_TEXT = set("p h1 h2 h3 h4 h5 h6 pre li dt dd figcaption caption legend summary option".split())
#: Elements of furniture; words of class, id or role for furniture, for text, and that deny the next.
FURNITURE = set("nav aside footer dialog menu".split())
FURNITURE_WORDS = set("ad ads advert adverts advertisement advertisements advertising banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar side aside header masthead footer comment comments commentlist reply replies respond disqus cookie cookies consent notice alert popup modal overlay newsletter subscribe signup login share sharing social related recommended recommendations widget toolbar pagination pager tags copyright legal disclaimer search contentinfo complementary".split())
TEXT_WORDS = set("article main content post entry story body text articlebody news".split())
DENY = set("has with no without".split())
#: Last words of class names that say how a page is built, or in what state it is, not what an element is.
STATES = set("open opened page layout piece template theme enabled".split())

NAMES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "furniture", "class_words", "article")
TAG_NAME = re.compile(r"[A-Za-z][^\s/>]*+")
ATTRIBUTE = re.compile(r"""[\s/]*+(?:([^\s/>=]++)|=)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?""")
TAG_END = re.compile(r"[\s/]*+>")
SPACE = re.compile(r"\s+")
MARKS = ("class", "id", "role", "href", "data-main")


def tokens(page: str):
    """Texts ("", text, None, False) and tags (name, attributes, closing?, self-closed?) of a page, in one pass.

    Comments, declarations and the content of script, style, textarea and title are left out; a tag that never ends
    makes every later tag end at its first ">".
    """
    at, size, last = 0, len(page), page.rfind(">")
    plain, unclosed = False, set()
    while at < size:
        start = page.find("<", at)
        if start < 0 or start >= last:
            if start >= 0 and page.startswith("<!--", start):
                yield "", page[at:start], None, False
            else:
                yield "", page[at:], None, False
            return
        closing = page.startswith("/", start + 1)
        m = TAG_NAME.match(page, start + 1 + closing)
        if not m and not closing and page[start + 1 : start + 2] not in ("!", "?"):
            yield "", page[at : start + 1], None, False  # a mere sign
            at = start + 1
            continue
        if start > at:
            yield "", page[at:start], None, False
        if not m:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 2)
                at = size if end < 0 else end + 3
            else:
                at = page.find(">", start) + 1
            continue
        name, found, at = m[0].lower(), {}, m.end()
        self_closed = False
        if not plain:
            while not (end := TAG_END.match(page, at)):
                a = ATTRIBUTE.match(page, at)
                if not a or a.end() >= size:
                    plain, at = True, m.end()
                    break
                if a[1] and (k := a[1].lower()) in MARKS:
                    found.setdefault(k, a[2] or a[3] or a[4] or "")
                at = a.end()
            else:
                at = end.end()
                self_closed = page[at - 2] == "/"
        if plain:
            at = page.find(">", at) + 1 or size
        if name in RAW and not closing and name not in unclosed:
            close = re.compile(rf"</{name}(?=[\s/>])[^>]*+>", re.I).search(page, at)
            if close:
                at = close.end()
            elif name == "title":
                unclosed.add(name)  # the tag alone is passed over
            else:
                at = size
        yield name, found, closing, self_closed


def skipped(toks: list) -> dict[int, int]:
    """For the elements without text that are closed: the token of their opening tag to the one behind their end."""
    out: dict[int, int] = {}
    left_open: dict[str, list[int]] = {}
    for i, (name, _, closing, self_closed) in enumerate(toks):
        if name in NO_TEXT:
            if not closing:
                if not (name in ("svg", "math") and self_closed):
                    left_open.setdefault(name, []).append(i)
            elif left_open.get(name):
                out[left_open[name].pop()] = i + 1
    return out


def class_words(found: dict[str, str]) -> float:
    """From -1, all words of class, id and role are those of text, to 1, all are those of furniture."""
    furniture = text = n = 0
    for name in " ".join(found.get(k, "") for k in ("class", "id", "role")).split():
        words = [w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower()) if w]
        n += len(words)
        text += sum(w in TEXT_WORDS for w in words)
        if not (len(words) > 1 and words[-1] in STATES):
            furniture += sum(w in FURNITURE_WORDS and not (i and words[i - 1] in DENY) for i, w in enumerate(words))
    return furniture / n if furniture else -text / n if text else 0.0


class Blocks:
    """The flat blocks of a page: text, words, linked words, in a furniture element?, class words, label, in an article?"""

    def __init__(self, page: str) -> None:
        self.out: list[tuple[str, int, int, bool, float, bool, bool]] = []
        self.held: list[tuple] = []
        self.parts: list[str] = []
        self.linked: list[str] = []
        self.stack: list[tuple] = []
        self.open: Counter = Counter()
        # furniture element (1: the page's header), article or main?, class words of the container, of the text element, label, form
        self.place = (0, False, 0.0, 0.0, False, 0)
        self.forms = 0
        toks = list(tokens(page))
        ends = skipped(toks)
        i, links, in_head = 0, 0, False
        while i < len(toks):
            name, found, closing, self_closed = toks[i]
            i += 1
            if in_head:
                if (not name and not found.strip()) or name in IN_HEAD:
                    i = ends.get(i - 1, i)
                    continue
                in_head = False
                if name == "head":
                    continue
            if not name:
                self.add(found, links)
                continue
            if name in BLOCK or name in NO_TEXT or name in RAW:
                self.end_block()
            if name == "head":
                in_head = not closing
            elif name in NO_TEXT or name in RAW:
                i = ends.get(i - 1, i)  # left open, its tag alone is passed over
            elif name == "br":
                self.add(" ", 0)
            elif name == "a":
                links = int(not closing and "href" in found)
            elif name in BLOCK or name == "span":
                if closing:
                    self.leave(name)
                elif name not in VOID and not (self_closed and name == "span"):
                    self.enter(name, found)
        self.end_block()
        self.settle()

    def settle(self) -> None:
        """Decides on forms and on the header's headline, for which the whole page must be known."""
        words = Counter()
        for _, n, _, furniture, _, _, _, form, _ in self.held:
            words[form] += n * (furniture < 2)
        whole = {f for f, n in words.items() if f and 2 * n > sum(words.values())}
        other = any(h1 and not furniture and (not form or form in whole) for _, _, _, furniture, _, _, _, form, h1 in self.held)
        for text, n, linked, furniture, named, main, article, form, h1 in self.held:
            headline = furniture == 1 and h1 and not other and not linked
            self.out.append((text, n, linked, (furniture > 0 and not headline) or (form > 0 and form not in whole), named, main, article))

    def add(self, raw: str, links: int) -> None:
        self.parts.append(raw)
        if links:
            self.linked.append(raw)

    def enter(self, name: str, found: dict[str, str]) -> None:
        furniture, article, container, own, main, form = self.place
        # an article's own header is part of it
        inner = max(furniture, 2 * (name in FURNITURE), int(name == "header" and not article))
        if name == "form":
            self.forms += 1
            form = self.forms
        if name in OF_TEXT or name == "span":
            own = max(own, class_words(found)) if name != "span" else own
        elif name in ("html", "body", "main", "article"):
            container, own = min(0.0, class_words(found)), 0.0  # they speak of the page
        else:
            container, own = class_words(found) if found else container * (name in ("tr", "tbody", "thead")), 0.0
        self.stack.append((name, *self.place))
        self.open[name] += 1
        self.place = (inner, article or name in ("article", "main"), container, own, main or "data-main" in found, form)

    def pop(self) -> str:
        name, *place = self.stack.pop()
        self.open[name] -= 1
        self.place = tuple(place)
        return name

    def leave(self, name: str) -> None:
        if self.open[name] and (name not in ("p", "span") or self.stack[-1][0] == name):
            while self.pop() != name:
                pass

    def end_block(self) -> None:
        if self.parts:
            text = SPACE.sub(" ", html.unescape("".join(self.parts))).strip()
            if text:
                linked = SPACE.sub(" ", html.unescape(" ".join(self.linked))).split()
                furniture, article, container, own, main, form = self.place
                self.held.append((text, len(text.split()), len(linked), furniture, max(container, own) if own > 0 else container, main, article, form, self.open["h1"] > 0))
            self.parts, self.linked = [], []
        while self.stack and self.stack[-1][0] in ("p", "span"):
            self.pop()


def features(blocks: list[tuple]) -> list[list[float]]:
    """NAMES for each block."""
    own = [(float(min(n, 1000)), min(1.0, k / max(n, 1))) for _, n, k, *_ in blocks]
    edge = (0.0, 0.0)
    return [[*own[i], *(own[i - 1] if i else edge), *(own[i + 1] if i + 1 < len(own) else edge), float(b[3]), float(b[4]), float(b[6])] for i, b in enumerate(blocks)]


# ---------------------------------------------------------------- the labelled table

#: Layouts of pages.  A capital stands for blocks: H headline, M paragraphs, S a short and L a linked one, I items of
#: the article, R linked ones; N links of a menu, Q a row of links, A a short notice, T a long one, C comments with
#: links to reply.
LAYOUTS = (
    "<header><a>Home</a></header><nav><ul>N</ul></nav><div class='ad'>A</div><article>HMSML</article><footer>A</footer>",
    "<div class='ad'>A</div><article>HSM</article><footer>T</footer>",
    "<div class='ads'>A</div><article>HSS</article><footer>A</footer>",
    "<nav><ul>N</ul></nav><div class='ad'>T</div><article>HS</article><footer>A</footer>",
    "<div id='header'>A</div><div class='sidebar'><h3>A</h3><p>T</p></div><div id='content'>HMIMS<div class='share'>Q</div></div><div class='comments'>C</div>",
    "<ul>N</ul>HMMSM<p>Q</p><p>Q</p>",
    "<ul>N</ul>HMLMMLM<div>Q</div><div>A</div><div>Q</div>",
    "<div>Q</div><div>M</div><div>M</div><div>Q</div>",
    "<div>Q</div>HMSMMM<div>Q</div><div>C</div>",
    "<div>Q</div><div>A</div><div>Q</div>HMMLM<div>C</div><div>Q</div>",
    "<body class='page-with-sidebar'><nav>N</nav>HMMSM<aside>T</aside><footer>T</footer>",
    "<body class='has-header single-post'><div class='menu'>Q</div>HMLM<div class='copyright'>A</div>",
    "<div class='content has-sidebar'>HMSML</div><div class='sidebar'>T Q</div>",
    "<div class='legal-news'>HMMSM</div><div class='legal'>T</div>",
    "<div class='header-story'>HMM</div><div class='social-news'>HMLM</div>",
    "<ul>N</ul><div class='search-page'>HMLSM</div><div class='footer'>A</div>",
    "<div class='alert-level'>HSMLMM</div><div class='share-box'>A</div><p>Q</p>",
    "<main class='search-results'>HMISM</main><form><p>T</p><label>A</label></form>",
    "<div class='cookie-notice'><p>T</p></div><main>MSIM<aside>T</aside>M</main><form><p>T</p></form>",
    "<div class='comment-list'>C</div><div class='post'>HMM</div><ol class='comment-list'><li>C</li></ol>",
    "<div class='comment-content'>C</div><div class='entry'>HML</div><div class='comment-body'>C</div>",
    "<div class='post'>HMMI<section class='related'><h4>A</h4>Q</section></div><div class='newsletter'>T</div><div class='newsletter-box'>A</div>",
    "<div class='cookie-bar'>A</div><div class='top-banner'>A</div>HSMM<div class='site-footer'>T</div>",
    "<table><tr><td>Q</td><td>HMSM</td></tr></table><div class='page-footer'>A Q</div>",
    "<nav>N</nav><article>HMMR</article><footer>A</footer>", "<main>HMR<div class='share'>Q</div></main><ul>N</ul>", "<ul>N</ul><main>HMSRM</main><div>Q</div>",
    "<article>HM<nav>N</nav>MR</article>", "<article><div class='share'><ul>N</ul></div>HMR</article>", "<main>HM<aside><ul>N</ul></aside>RM</main>", "<main>HMM<div class='related'><ul>N</ul></div></main><footer>N</footer>",
    "<article>HM<div class='share-links'><ul>N</ul></div>R</article>", "<article>HMMR<div class='related-links'>QQ</div></article>", "<main>HSR<section class='social'><ul>N</ul>Q</section>M</main>", "<article>HMR</article><div class='related'>Q<ul>N</ul></div>",
    "<form><div>Q</div>HMMSMM<p>Q</p></form>", "<form><ul>N</ul><div class='content'>HMM</div></form><div>Q</div>", "<header><h1 data-main=1>word word</h1></header>MMSM<footer>Q</footer>",
    "<div class='wrapper menu-open'>HMM</div>", "<div class='comment-piece'>MM</div><div class='comment-list'>C</div>", "<ul>N</ul><div>HMM</div><form><p>T</p><p>A</p></form>",
    "HSMSSM", "HM", "M", "S", "HISI", "<div>HMM</div><div>MS</div>",
)
#: How many words the blocks of each kind have, in turn.
WORDS = {"H": (3, 12, 7, 1, 9), "M": (24, 41, 15, 60, 30, 88, 19, 150, 33), "S": (2, 1, 5, 8, 3, 11), "A": (8, 4, 12, 6, 10, 3), "T": (18, 27, 14, 35, 21), "C": (9, 26, 3, 41, 15)}


def labelled_pages(rounds: int = 24) -> list[str]:
    """The labelled table as pages; blocks of elements with data-main are main text, all others aren't."""
    turn: Counter = Counter()

    def words(kind: str) -> str:
        turn[kind] += 1
        return " ".join(["word"] * WORDS[kind][turn[kind] % len(WORDS[kind])])

    def blocks(m: re.Match) -> str:
        k = m[0]
        if k == "H":
            return f"<h1 data-main=1>{words('H')}</h1>"
        if k == "M":
            turn["link"] += 1
            link = " <a>in a link</a>" * (turn["link"] % 3 == 0)
            return f"<p data-main=1>{words('M')}{link}</p>"
        if k == "S":
            return f"<p data-main=1>{words('S')}</p>"
        if k == "L":
            turn["link"] += 1
            return f"<p data-main=1>See{' it' * (turn['link'] % 4)} <a>this</a>.</p>"
        if k == "I":
            return "<ul>" + "".join(f"<li data-main=1>{words('S')}</li>" for _ in range(3)) + "</ul>"
        if k == "R":
            return "<ul>" + "".join(f"<li data-main=1><a>{words('S')}</a></li>" for _ in range(3)) + "</ul>"
        if k == "N":
            return "".join(f"<li><a>{'word ' * n}</a></li>" for n in (1, 2, 1, 3))
        if k == "Q":
            turn["row"] += 1
            return f"<p><a>{words('A')}</a>" + " | <a>more</a>" * (turn["row"] % 3) + "</p>"
        if k == "C":
            return "".join(f"<p>{words('C')}</p><p><a>Reply</a></p>" for _ in range(2))
        return words(k)

    return [re.sub(r"(?<![A-Za-z<])[A-Z](?![a-z])|(?<=[A-Z>])[A-Z](?![a-z])", blocks, x).replace("<a>", "<a href='/'>") for _ in range(rounds) for x in LAYOUTS]


def table(pages: list[str]) -> list[tuple[bool, list[float]]]:
    rows = []
    for page in pages:
        blocks = Blocks(page).out
        rows += [(b[5], f) for b, f in zip(blocks, features(blocks), strict=True)]
    return rows


def train(spark: SparkSession, pages: list[str] | None = None, depth: int = 8):
    """The decision tree as nested tuples (feature, threshold, left, right), leaves being predictions."""
    rows = [(float(label), Vectors.dense(f)) for label, f in table(pages or labelled_pages())]
    data = spark.createDataFrame(rows, ["label", "features"]).coalesce(1)
    model = DecisionTreeClassifier(maxDepth=depth, maxBins=128, seed=1, minInstancesPerNode=12).fit(data)

    def walk(node):
        if node.getClass().getSimpleName() == "LeafNode":
            return bool(node.prediction())
        split = node.split()
        low, high = walk(node.leftChild()), walk(node.rightChild())
        return low if low == high and isinstance(low, bool) else (split.featureIndex(), split.threshold(), low, high)

    return walk(model._java_obj.rootNode())


def decide(tree, f: list[float]) -> bool:
    while not isinstance(tree, bool):
        k, threshold, low, high = tree
        tree = low if f[k] <= threshold else high
    return tree


def main_text(page: str | None, tree) -> str:
    blocks = Blocks(page).out if page else []
    return "\n\n".join(b[0] for b, f in zip(blocks, features(blocks), strict=True) if decide(tree, f))


def extract(pages: DataFrame, tree) -> DataFrame:
    """page_id, url, text, n_chars for each row of pages (repeated rows each); other columns are ignored.

    Null or empty html, or none that is main text, gives ''.  Time and memory grow in proportion to a page's length,
    however broken it is.  An empty table gives none.
    """

    def run(batches):
        for batch in batches:
            texts = [main_text(x.as_py(), tree) for x in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op6_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"), train(spark))

"""Main text of web pages as a maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive by the block
they stand in, tags negative, with weights learnt from labelled pages: pages
that mark their article (<article> or <main>) tell how often a kind of word
or tag stands inside and outside of it. A linear scan finds the contiguous
region of the highest sum. On a page that marks its article, words outside of
the mark score negative and tags inside of it cost nothing, so the region ends
with the article. Of that region, blocks inside elements that are
no article (menus, adverts, forms, comments and the like) are left out, and
the rest is written block by block.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hashed_share

#: Fixed values of HTML: elements without content, with raw content, and those that begin a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search
section summary table tbody td tfoot th thead title tr ul""".split())
ENDS_P = BLOCK - {"caption", "td", "th", "tr", "tbody", "thead", "tfoot", "body", "head", "html", "legend", "title"}
SIBLING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"},
           "option": {"option"}}
#: Elements, roles and words of class or id that are not the article.
OUT_TAGS = frozenset("nav aside footer form head script style noscript template svg button select textarea iframe "
                     "dialog menu audio video".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
OUT_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion
comment comments comentarios kommentare disqus respond reply replies sidebar sidebars side menu menus nav navbar
navigation breadcrumb breadcrumbs pagination pager cookie cookies consent gdpr notice notices notification popup modal
overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations
teaser widget footer header masthead toolbar topbar skip hidden legal disclaimer copyright tags""".split())
#: Words that also name parts of an article: they don't mark a text element inside one.
SOFT = frozenset("related legal side tags skip copyright disclaimer header footer share sharing reply replies respond "
                 "recommended notice notices".split())
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th figure figcaption span em strong b i a q cite code".split())
#: Words beside "header" that make it the header of the article.
OWN = frozenset("post article entry story content".split())
COMMENTS = frozenset("comment comments comentarios kommentare disqus respond reply replies".split())
ARTICLE = frozenset({"article", "main"})

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|"
                   r"<(/?)([a-zA-Z][^\s/>]*)((?:[^'\">]*(?:\"[^\"]*\"|'[^']*'))*[^'\">]*|[^>]*)>", re.S)
NAMES = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s'\">]+))", re.I)
HIDDEN = re.compile(r"\shidden(?:[\s=/>]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)

LABELLED = 2000  # size of the labelled sample: pages by the hash of their html
WORD_FLOOR, TAG_CEILING, CLIP = 0.05, -0.05, 5.0
UNSEEN_WORD, UNSEEN_TAG = 1.0, -0.1


class Named:
    """An element whose class or id words say that it is no article: a guess, which its size may refute."""

    def __init__(self, name: str, found: frozenset[str], parent: int):
        self.look, self.found, self.parent = (name, found), found, parent
        self.words, self.main, self.article = 0, name == "main", False


NONE: frozenset[str] = frozenset()


def is_out(name: str, attributes: str, in_article: bool, quoted: bool = False) -> tuple[bool, frozenset[str]]:
    """Whether an element's tag, role or hiding tells that it is no article, and the class or id words that say so."""
    if name in OUT_TAGS and not (quoted and name == "footer") or name == "header" and not in_article:
        return True, NONE
    if name in ARTICLE or name in ("body", "html") or not attributes:
        return False, NONE
    if HIDDEN.search(attributes):
        return True, NONE
    words: frozenset[str] = NONE
    for kind, *values in NAMES.findall(attributes):
        value = next(filter(None, values), "").lower()
        if kind.lower() == "role":
            if value in OUT_ROLES:
                return True, NONE
        elif found := OUT_WORDS.intersection(all_words := re.split(r"[^a-z]+", value)):
            if found == {"header"} and (in_article or OWN.intersection(all_words)):
                continue
            words |= found
    if in_article and name in TEXT and words <= SOFT:
        return False, NONE
    return False, words


def parse(html: str, freed: frozenset[int] | set[int] = NONE,
          named: list[Named] | None = None) -> list[tuple[str, str, bool, int, int]]:
    """Tokens in page order: (kind, text, out, block, inside).

    ``named`` receives the elements that only their class or id words mark;
    those whose positions there are ``freed`` aren't marked.

    kind is "w:" and the block's element for text, "t:" and the element for
    a tag ("x" within an element that is no article, which ``out`` tells, "y"
    for a tag of such an element that begins no block); ``block`` numbers the
    blocks, ``inside`` is 2 within <article>, 1 within <main> alone, else 0.
    """
    tokens: list[tuple[str, str, bool, int, int]] = []
    # element, out, inside an article, out by more than names, the innermost named element
    stack: list[tuple[str, bool, int, bool, int]] = []
    named = [] if named is None else named
    names: Counter = Counter()
    blocks = ["body"]
    block = 0

    def pop() -> None:
        name = stack.pop()[0]
        names[name] -= 1
        if name in BLOCK and len(blocks) > 1:
            blocks.pop()

    def tag(name: str, out: bool) -> str:
        return f"t:{name}" if not out else "t:x" if name in BLOCK else "t:y"

    def text(s: str) -> None:
        if s:
            out, inside = (stack[-1][1], stack[-1][2]) if stack else (False, 0)
            if stack and stack[-1][4] >= 0 and not stack[-1][3]:
                named[stack[-1][4]].words += len(s.split())
            kind = "w:x" if out else "w:a" if names["a"] > 0 else f"w:{blocks[-1]}"
            tokens.append((kind, s, out, block, inside))

    at = 0
    while m := TOKEN.search(html, at):
        text(html[at:m.start()])
        at = m.end()
        if m.group(2) is None:
            if m.group().startswith("<![CDATA["):
                text(m.group()[9:-3])
            continue
        closing, name, attributes = m.group(1) == "/", m.group(2).lower(), m.group(3)
        out, inside = (stack[-1][1], stack[-1][2]) if stack else (False, 0)
        if name == "br":
            text(" ")
        if name in BLOCK:
            block += 1
        if closing:
            tokens.append((tag(name, out), "", out, block, inside))
            if names[name] > 0:
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        if name in ENDS_P and names["p"] > 0:
            while stack[-1][0] != "p":
                pop()
            pop()
        elif stack and stack[-1][0] in SIBLING.get(name, ()):
            pop()
        out, inside = (stack[-1][1], stack[-1][2]) if stack else (False, 0)
        own, words = is_out(name, attributes, inside > 0 or name in ARTICLE, names["blockquote"] > 0)
        tokens.append((tag(name, out or own), "", out, block, inside))
        if name in VOID or attributes.endswith("/") and name not in BLOCK:
            continue
        here = max(inside, {"article": 2, "main": 1}.get(name, 0))
        hard, within = (stack[-1][3], stack[-1][4]) if stack else (False, -1)
        if words and not own and not hard:
            named.append(Named(name, words, within))
            within = len(named) - 1
            own_out = within not in freed
        else:
            own_out = own
        if name in ARTICLE and within >= 0 and not hard:
            named[within].article = True
            named[within].main |= name == "main"
        stack.append((name, out or own_out, here, hard or own, within))
        names[name] += 1
        if name in BLOCK:
            blocks.append(name)
        if name in RAW:  # no tags inside
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
            if name == "title":
                text(html[at:end.start() if end else len(html)])
            at = end.start() if end else len(html)
    text(html[at:])
    for e in reversed(named):  # parents stand before their children
        if e.parent >= 0:
            up = named[e.parent]
            up.words, up.main, up.article = up.words + e.words, up.main or e.main, up.article or e.article
    return tokens


def within_mark(tokens: list[tuple[str, str, bool, int, int]]) -> list[tuple[str, str, bool, int, bool]]:
    """The tokens with ``inside`` told for the page's mark: its <article> elements, or <main>.

    <main> counts if the page has no <article>, or if those in it have less
    than a fifth of its words (teasers).
    """
    n = Counter()
    for _, s, out, _, inside in tokens:
        if not out:
            n[inside] += len(s.split())
    least = 2 if n[2] and 4 * n[2] >= n[1] else 1
    return [(kind, s, out, block, inside >= least) for kind, s, out, block, inside in tokens]


def score(kind: str, s: str, inside: bool, marked: bool, weight: dict[str, float]) -> float:
    """What a token adds to a region's sum; ``marked``: the page marks its article."""
    if kind[0] == "w":
        sign = -1 if marked and not inside else 1
        return sign * weight.get(kind, UNSEEN_WORD) * len(s.split())
    if marked and inside or kind == "t:y":
        return 0.0
    return weight.get(kind, UNSEEN_TAG)


def with_title(tokens: list[tuple[str, str, bool, int, bool]], a: int, b: int) -> int:
    """The region's start, moved back to an h1 that only tags part from it."""
    i = a - 1
    while a < b and i >= 0 and (tokens[i][0][0] == "t" or tokens[i][2] or not tokens[i][1].strip()):
        i -= 1
    return i if a < b and i >= 0 and tokens[i][0] == "w:h1" else a


def judged(html: str, weight: dict[str, float]) -> tuple[list[tuple[str, str, bool, int, bool]], tuple[int, int]]:
    """The tokens of a page and their best region, names heeded only where they don't mark the content itself.

    While no article element outside of named elements has words, the named
    element with most words is freed of its mark if it has more words than
    the best region, or holds <main>; with it those of the same tag and
    names, and named elements inside that hold over half of its words.
    Comments may outgrow their article: their names yield only to an article
    element inside.
    """
    freed: set[int] = set()
    while True:
        named: list[Named] = []
        tokens = parse(html, freed, named)
        tokens = within_mark(tokens)
        marked = any(inside and not out and s.strip() for _, s, out, _, inside in tokens)
        a, b = region([score(kind, s, inside, marked, weight) for kind, s, _, _, inside in tokens])
        a = with_title(tokens, a, b)
        hidden = [e.parent >= 0 and e.parent not in freed for e in named]
        for i, e in enumerate(named):
            hidden[i] = hidden[i] or e.parent >= 0 and hidden[e.parent]
        outer = [i for i, e in enumerate(named) if i not in freed and not hidden[i] and e.words
                 and (e.article or e.main or not e.found & COMMENTS)]
        if not outer or marked:
            return tokens, (a, b)
        best = sum(len(s.split()) for _, s, out, *_ in tokens[a:b] if not out)
        top = max(outer, key=lambda i: (named[i].main, named[i].words, -i))
        if not named[top].main and named[top].words <= best:
            return tokens, (a, b)
        freed |= {i for i in outer if named[i].look == named[top].look}
        for i, e in enumerate(named):
            if e.parent in freed and 2 * e.words > named[e.parent].words and (e.article or e.main or not e.found & COMMENTS):
                freed.add(i)


def counts(html: str) -> Counter:
    """(kind, inside the marked article and no other element) -> words or tags, of a labelled page."""
    tokens, _ = judged(html, {})
    found: Counter = Counter()
    if any(inside for *_, inside in tokens):
        for kind, s, out, _, inside in tokens:
            n = len(s.split()) if kind[0] == "w" else 1
            if n:
                found[kind, inside and not out] += n
    return found


def weights(found: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Log-odds of standing inside; words at least a little positive, tags at least a little negative."""
    out = {}
    for kind in sorted({k for k, _ in found}):
        odds = math.log((found.get((kind, True), 0) + 1) / (found.get((kind, False), 0) + 1))
        odds = max(-CLIP, min(CLIP, odds))
        out[kind] = max(WORD_FLOOR, odds) if kind[0] == "w" else min(TAG_CEILING, odds)
    out["w:x"] = WORD_FLOOR
    return out


def region(scores: list[float]) -> tuple[int, int]:
    """The half-open range of the highest sum; the first of equal ones; empty if none is positive."""
    best, at = 0.0, (0, 0)
    total, start = 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, at = total, (start, i + 1)
    return at


def extract(html: str | None, weight: dict[str, float]) -> str:
    """Main text: blocks of one line each, joined by an empty line; empty if there is none."""
    tokens, (a, b) = judged(html or "", weight)
    blocks: dict[int, list[str]] = {}
    for kind, s, out, block, _ in tokens[a:b]:
        if s and not out:
            blocks.setdefault(block, []).append(s)
    lines = (" ".join(unescape("".join(parts)).split()) for _, parts in sorted(blocks.items()))
    return "\n\n".join(filter(None, lines))


def learn(pages: DataFrame, labelled: int = LABELLED) -> dict[str, float]:
    """Weights from about ``labelled`` pages that mark their article, told by the hash of their html."""
    marked = pages.select(F.col("html").cast("string").alias("html")).filter(
        F.lower("html").rlike("<(?:article|main)[\\s>]"))
    sample = marked.filter(hashed_share(F.xxhash64("html"), labelled, marked.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            for h in b.column(0):
                total.update(counts(h.as_py()))
        known = [k for k in total if k[0][2:] in KNOWN]  # element names are a fixed list, so few rows leave
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in known], pa.string()), pa.array([i for _, i in known], pa.bool_()),
             pa.array([total[k] for k in known], pa.int64())], ["kind", "inside", "n"])
    rows = (sample.select("html").mapInArrow(run, "kind string, inside boolean, n long")
            .groupBy("kind", "inside").agg(F.sum("n").alias("n")).collect())
    return weights({(r["kind"], r["inside"]): r["n"] for r in rows})


KNOWN = BLOCK | VOID | RAW | {"a", "x", "b", "i", "em", "strong", "span", "small", "u", "s", "sub", "sup", "code", "font",
                              "button", "label", "select", "option", "abbr", "cite", "q", "time", "mark", "picture"}


def main_text(pages: DataFrame, weight: dict[str, float]) -> DataFrame:
    """(page_id, url, text, n_chars) of every page: its main text and the text's code points.

    Null and empty html, and pages without words, give the empty text;
    repeated rows are extracted each; no rows give no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(h.as_py(), weight) for h in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
                        ).mapInArrow(run, "page_id long, url string, text string, n_chars long")

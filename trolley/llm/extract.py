"""Main-text extraction by tag-path ratios: text length and punctuation are
aggregated per root-to-leaf tag path, smoothed along the page, fused and held
against a threshold; nodes on passing paths are content."""

from __future__ import annotations

import re
from collections import defaultdict
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import row_slices

#: paths through these elements, or through elements whose class, id, role or label is such a word or a compound of such
#: words with PARTS, are no article; a value that merely holds such a word lowers the score of its paths (fixed values)
BOILERPLATE_TAGS = frozenset(("head title nav footer aside form script style noscript template select option textarea "
                              "iframe object svg canvas audio video dialog menu input fieldset annotation annotation-xml").split())
#: names of controls, part of a sentence that surrounds them and of nothing else (a form goes as a whole)
CONTROLS = frozenset(("button", "label"))
BOILERPLATE_WORDS = frozenset(("ad ads advert advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr "
                               "notice alert popup modal newsletter subscribe nav navbar navigation menu breadcrumb breadcrumbs "
                               "sidebar footer masthead comment comments respond replies disqus share sharing social related "
                               "recommended widget login signup search toolbar pagination pager skip hidden").split())
BOILERPLATE_PARTS = frozenset(("area bar block body bottom box btn button buttons container feed form global header icons inner item items "
                               "left link links list main module nav page panel post posts primary right secondary section site slot "
                               "top wrap wrapper").split())
#: what an article may be about: within one, paths through such words stay if their own text is like the rest
TOPICAL_WORDS = frozenset("share sharing social related recommended widget login signup search toolbar skip hidden".split())
#: such words say whether something is there, not what an element is
STATES = frozenset("has no not with without show hide hides".split())
DOUBT = 0.5
#: share of the other paths' mean ratio that a path through TOPICAL_WORDS has to reach without its neighbours' help
ALIKE = 0.5
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = frozenset(("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
                    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
                    "summary table tbody td tfoot th thead title tr ul").split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: an opening element ends an open one of these, up to the nearest of the containers
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
         "option": {"option"}}
_CONTAINERS = {"ul", "ol", "dl", "table", "tbody", "thead", "tfoot", "div", "section", "article", "main", "body", "blockquote"}
PUNCTUATION = frozenset(".,;:!?…。，、；：！？")
#: share of the fused scores' standard deviation that a path has to reach
THRESHOLD = 0.2
#: elements that go with a passing path that has the same parent
SENTENCES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote figcaption".split())
PROSE = frozenset("h1 h2 h3 h4 h5 h6 p pre blockquote ul ol dl table figure".split())
KERNEL = (0.25, 0.5, 0.25)

_WORD = re.compile(r"[a-z]+")
#: words of a value: at marks, digits and from lower case to upper
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: white space that the markup language collapses, and no-break and other spaces alike
_BLANK = re.compile(r"\s+")


@lru_cache(1 << 16)
def _stands_for(word: str) -> bool:
    """Whether a word of a value is one of BOILERPLATE_WORDS, or one run together with one of PARTS (commentlist)."""
    return word in BOILERPLATE_WORDS or any(
        (word[:k] in BOILERPLATE_WORDS and word[k:] in BOILERPLATE_PARTS) or (word[:k] in BOILERPLATE_PARTS and word[k:] in BOILERPLATE_WORDS)
        for k in range(2, min(len(word), 40) - 1))


class _Page(HTMLParser):
    """Text nodes in page order: block number, tag path, text.  Paths are numbered;
    ``parent`` and ``tag`` lead from a path to the root (path 0), so deep nesting
    costs no more than flat markup."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        #: open elements: name, whether outside the article, path, whether within an article
        self.stack: list[tuple[str, bool, int, bool]] = []
        #: where the open elements of a name stand in the stack
        self.open: dict[str, list[int]] = defaultdict(list)
        self.uncommented = False
        self.block = 0
        self.nodes: list[tuple[int, int, str]] = []
        #: for each node whether it names a control
        self.control: list[bool] = []
        self.path: dict[tuple[int, str, bool, bool], int] = {}
        self.parent, self.tag, self.weight, self.topical = [0], [""], [1.0], [False]

    def _judge(self, tag: str, attrs: list, inside: bool) -> tuple[bool, bool, bool]:
        """Whether the element is outside the article; whether its words cast doubt on it;
        whether they may be what the article is about.

        Words never count against articles, nor a name or label (id, aria-label)
        against headings, or against sections within an article: those name
        what the text is about.
        """
        if tag in BOILERPLATE_TAGS or tag == "header" and not inside:
            return True, False, False
        doubt = topical = False
        for name, value in attrs:
            if name in ("class", "id", "role", "aria-label") and value and tag not in ("html", "body", "main", "article"):
                if name in ("id", "aria-label") and (tag in HEADINGS or tag == "section" and inside):
                    continue
                for one in value.split() if name in ("class", "role") else [value]:
                    words = _WORD.findall(_HUMP.sub(" ", one).lower())
                    named = [w for w in words if _stands_for(w)]
                    if not named or not STATES.isdisjoint(words):
                        continue
                    if all(w in named or w in BOILERPLATE_PARTS for w in words):
                        if not (inside and TOPICAL_WORDS.issuperset(named)):
                            return True, False, False
                        topical = True
                    doubt = True
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                return True, False, False
        return False, doubt, topical

    def parse_comment(self, i, report=True):
        # once a comment has no end, none after it has one
        k = -1 if self.uncommented else super().parse_comment(i, report)
        self.uncommented = k < 0
        return k

    def _nearest(self, tags) -> int:
        return max((at[-1] for t in tags if (at := self.open.get(t))), default=-1)

    def _pop_to(self, index: int) -> None:
        while len(self.stack) > index:
            self.open[self.stack.pop()[0]].pop()

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag == "br":
                self.handle_data(" ")
            elif tag == "hr":
                self.block += 1
            return
        if tag in BLOCKS:
            self.block += 1
            ends, within = {"p"} | _ENDS.get(tag, set()), self._nearest(_CONTAINERS)
            while (i := self._nearest(ends)) > within:
                ended = self.stack[i][0]
                self._pop_to(i)
                self.block += 1
                if ended != "p":
                    break
        if tag in ("article", "main"):
            # an article doesn't begin in a menu: its end tag is missing
            menu = min((at[0] for t in ("nav", "header") if (at := self.open.get(t))), default=None)
            if menu is not None:
                self._pop_to(menu)
                self.block += 1
        _, outside, above, inside = self.stack[-1] if self.stack else ("", False, 0, False)
        beyond, doubt, topical = self._judge(tag, attrs, inside)
        path = self.path.setdefault((above, tag, doubt, topical), len(self.tag))
        if path == len(self.tag):
            self.parent.append(above)
            self.tag.append(tag)
            self.weight.append(self.weight[above] * (DOUBT if doubt else 1.0))
            self.topical.append(self.topical[above] or topical)
        self.open[tag].append(len(self.stack))
        self.stack.append((tag, outside or beyond, path, inside or tag in ("article", "main")))

    def handle_startendtag(self, tag, attrs):
        if tag in VOID:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if self.open.get(tag):
            if tag in BLOCKS:
                self.block += 1
            self._pop_to(self.open[tag][-1])

    def handle_data(self, data):
        if data and not (self.stack and self.stack[-1][1]):
            control = self._nearest(CONTROLS)
            if control >= 0 and self._nearest(SENTENCES) < max(self._nearest(_CONTAINERS), 0):
                return
            # a control counts with the path of its sentence
            at = control - 1 if control >= 0 else len(self.stack) - 1
            self.nodes.append((self.block, self.stack[at][2] if at >= 0 else 0, data))
            self.control.append(control >= 0)


def _content(page: _Page) -> list[bool]:
    """Which nodes stand on paths whose smoothed, fused ratios reach the threshold."""
    chars: dict = defaultdict(int)
    marks: dict = defaultdict(int)
    count: dict = defaultdict(int)
    solid = []
    for _, path, text in page.nodes:
        size = len(text.strip())
        if size:
            solid.append(path)
            chars[path] += size
            marks[path] += sum(map(text.count, PUNCTUATION))
            count[path] += 1
    if not solid:
        return [False] * len(page.nodes)
    ratio = np.array([[chars[p] / count[p], marks[p] / count[p]] for p in solid])
    padded = np.pad(ratio, ((1, 1), (0, 0)), mode="edge")
    smooth = sum(w * padded[k:k + len(ratio)] for k, w in enumerate(KERNEL))
    fused = smooth[:, 0] * (1 + smooth[:, 1]) * np.array([page.weight[p] for p in solid])
    # a path passes as a whole: short paragraphs stay with the long ones
    best: dict = defaultdict(float)
    for path, score in zip(solid, fused):
        best[path] = max(best[path], score)
    least = THRESHOLD * fused.std()
    own = ratio[:, 0] * (1 + ratio[:, 1])
    asked = np.array([page.topical[p] for p in solid])
    alike = ALIKE * own[~asked].mean() if not asked.all() else 0.0
    unlike = {p for p, score, t in zip(solid, own, asked) if t and score < alike}
    passing = {p for p, score in best.items() if score >= least} - unlike
    # headings, lists and the like beside passing paths belong to the same article, and so does all that lies within them
    beside = {page.parent[p] for p in passing if p}
    verdict = [False] * len(page.tag)
    for p in range(len(page.tag)):  # a path's number is larger than its parent's
        entered = page.topical[p] and not page.topical[page.parent[p]]
        verdict[p] = p in passing or p > 0 and not entered and (verdict[page.parent[p]] or page.tag[p] in PROSE and page.parent[p] in beside)
    return [verdict[path] for _, path, _ in page.nodes]


def main_text(html: str) -> str:
    """The article: blocks in page order, one line feed between two."""
    page = _Page()
    # no tag ends behind the last ">": what begins there is text, and is not looked at again and again
    last = html.rfind(">") + 1
    html = html[:last] + html[last:].replace("<", "&lt;")
    page.feed(html)
    page.close()
    blocks: dict[int, list[str]] = {}
    said = {block for (block, _, text), control in zip(page.nodes, page.control) if not control and not text.isspace()}
    for (block, _, text), content in zip(page.nodes, _content(page)):
        if block in said and (content or block in blocks):
            blocks.setdefault(block, []).append(text)
    lines = (_BLANK.sub(" ", "".join(parts)).strip() for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) for every row of ``pages``.

    Null and empty html give the empty text; markup that is cut off or not
    closed is read as far as it goes; repeated rows and null page_ids stay; an
    empty table gives no rows; other columns are not looked at.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def run(batches):
        for batch in batches:
            for part in row_slices(batch, "html", 1 << 23):
                text = [main_text(h or "") for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(text, pa.string())], schema=schema)

    return (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
            .mapInArrow(run, "page_id long, url string, text string")
            .select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")))

"""Main text by consensus host paths.

Every page's containers are scored by the text of their paragraphs and the page
votes for the generalised path (tags and classes without digits) of its best
one. Votes are counted per host in Spark, and every page is read again with its
host's winning path: a page whose own best guess went astray is extracted like
the rest of its site. A page that lacks the winning path uses its own best.

Votes are (host, path) counts with map-side partial sums, so a host may hold a
third of all pages. The table of winners has a row per host; the planner
broadcasts it below the session's threshold and joins by shuffle above.

Inside a container, menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments are left out, by tag and by class or id. A
class that tells a state ("has-sidebar", "no-ads") says nothing about its
element's text, and a wrapper is not left out for its class where the page's
main article, or all of its text, is inside it (``Page._settle``).

Defined results: null or empty html gives the empty text; a page without a
host uses its own best container; a page whose text is in no container (no
body) gives all of it that is not left out, unless most of it is in links or
there is no tag at all; a page with nothing else gives the empty text; equal votes go to the higher
total score, then to the greater path; repeated rows are extracted alike; an empty table gives
an empty result. Other columns are not read.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

# What HTML defines
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math select".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
                   "h5 h6 header hr main menu nav ol p pre section table ul".split())
#: an element of a list or table ends its open neighbour, up to the list or table
LISTED = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "option": ("select",), "tr": ("table",),
          "td": ("table",), "th": ("table",)}
SCOPE = frozenset("article aside body div footer form header html main nav section table td th".split())
# What is not the article
SKIP_TAGS = frozenset("nav footer aside form button dialog menu noscript".split())
SKIP_WORDS = frozenset("ad ads adsense advert adverts advertisement advertising sponsor sponsored promo promotion banner "
                       "menu nav navbar navigation breadcrumb breadcrumbs sidebar footer cookie cookies consent gdpr "
                       "notice notices alert popup modal overlay newsletter subscribe share sharing social related "
                       "recommended comment comments disqus reply replies respond login signup form".split())
SKIP_ROLES = frozenset("navigation banner contentinfo search complementary".split())
HEADERS = frozenset("header masthead topbar".split())
#: a class or id that begins with one of these tells what a layout has or lacks
STATES = frozenset("has hide no non not with without".split())
CONTAINERS = frozenset("article main section div body td center blockquote".split())

#: a tag with its quoted values (a quote opens one after "="), or, with many, long or unclosed ones, its name: see ``_end``
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]{0,8192}"|'[^']{0,8192}'|(?!["']))){0,100}+)>"""
                 r"""|<[!?/][^>]*>|<(/?)([a-zA-Z][^\s/>]*)""", re.S)
STOP = re.compile(r""">|=\s*+["']""")
OPEN_COMMENT = re.compile("<!--.*", re.S)
ATTR = re.compile(r"""([^\s"'/>=][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)))?""")
KEYS = frozenset("class id role hidden".split())
PART = re.compile(r"[a-z]+")


class Page:
    """Elements (tag, label, parent, skipped) and texts in page order: (element,
    number of the block, text). A new block begins wherever a tag that is not
    inline opens or closes. Linear in the page, whatever its nesting."""

    def __init__(self, html: str):
        self.tags, self.labels, self.parents = ["#root"], [""], [-1]
        self.by_class, self.by_tag, self.in_article, self.own_words = [False], [False], [False], [False]
        self.texts: list = []
        self.stack, self.open = [0], Counter()
        at, n, block, last = 0, len(html), 0, html.rfind(">")
        self.dead, self.closing = set(), {q: html.rfind(q) for q in "\"'"}
        while at < n:
            m = TAG.search(html, at) if at <= last else OPEN_COMMENT.search(html, at)
            if m and m.re is TAG and m[5] and m.end() > last:
                m = OPEN_COMMENT.search(html, m.start())  # no ">" follows
            start = m.start() if m else n
            if start > at:
                self.texts.append((self.stack[-1], block, _html.unescape(html[at:start])))
            if not m:
                break
            at = m.end()
            name = m.re is TAG and (m[2] or m[5])
            if name:
                name = name.lower()
                block += name not in INLINE
                attrs = m[3]
                if m[5]:
                    at = self._end(html, m.end()) + 1
                    attrs = html[m.end():at - 1]
                if m[1] or m[4]:
                    self._close(name)
                else:
                    self._open(name, attrs)
                    if name in RAW and not attrs.endswith("/"):
                        end = re.compile(rf"</{re.escape(name)}\s*[^>]*>", re.I).search(html, at)
                        at = end.end() if end else n
                        self._close(name)
        self._settle()

    def _settle(self) -> None:
        """Which elements are left out (``skips``): those with a reason of their
        own, by tag or by class, and all inside them. Where that leaves no
        article with text, the ancestors of an article or main with no such
        class itself and with most of the page's text are kept in spite of
        theirs; where it leaves no text, the outermost elements with most of it."""
        n = len(self.tags)
        hard, size = self.by_tag[:], [0] * n
        for i in range(1, n):
            hard[i] |= hard[self.parents[i]]
        for e, _, text in self.texts:
            if not hard[e]:
                size[e] += len(text.strip())
        held = size[:]
        for i in range(n - 1, 0, -1):
            held[self.parents[i]] += held[i]
        own = self.by_class[:]

        def spread():
            self.skips = hard[:]
            for i in range(1, n):
                self.skips[i] |= own[i] or self.skips[self.parents[i]]

        spread()
        named = [i for i in range(1, n) if self.tags[i] in ("article", "main") and held[i]]
        if all(self.skips[i] for i in named):
            climbed = {0}
            for i in named:
                if 2 * held[i] > held[0] and not self.own_words[i]:
                    while i not in climbed:
                        own[i] = False
                        climbed.add(i)
                        i = self.parents[i]
        far = n + 1  # more than all wrappers of a page
        wrappers = [0] * n  # around and at each element, far if one holds less than half
        for i in range(1, n):
            big = 2 * held[i] > held[0]
            wrappers[i] = wrappers[self.parents[i]] + (0 if not own[i] else 1 if big else far)
        nearest = min((wrappers[e] for e, _, text in self.texts if not hard[e] and text.strip()), default=far)
        if nearest < far:
            own = [o and k > nearest for o, k in zip(own, wrappers, strict=True)]
        spread()

    def _end(self, html: str, at: int) -> int:
        """Place of the ">" that ends the tag whose name ends at ``at``: the first
        one outside quoted values; where the closing quote or that ">" is
        missing, the next one. ``dead`` are the ends of values from which no
        such ">" follows, so no part of the page is read twice for nothing."""
        first, seen = at, []
        while at not in self.dead and (m := STOP.search(html, at)):
            if m[0] == ">":
                return m.start()
            quote = m[0][-1]
            if m.end() > self.closing[quote]:
                end = html.find(">", m.end())
                if end >= 0:
                    return end
                break
            at = html.find(quote, m.end()) + 1
            seen.append(at)
        self.dead.update(seen)
        return html.find(">", first)

    def _pop(self, k: int) -> None:
        """Closes the open elements from place ``k`` on."""
        for e in self.stack[k:]:
            self.open[self.tags[e]] -= 1
        del self.stack[k:]

    def _open(self, name, attrs):
        stack, tags = self.stack, self.tags
        if name in ENDS_P and self.open["p"]:
            for k in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                if tags[stack[k]] == "p":
                    self._pop(k)
                    break
                if tags[stack[k]] in SCOPE:
                    break
        ended = ("dt", "dd") if name in ("dt", "dd") else (name,)
        if name in LISTED and any(self.open[t] for t in ended):
            for k in range(len(stack) - 1, 0, -1):
                t = tags[stack[k]]
                if t in ended:
                    self._pop(k)
                    break
                if t in LISTED[name]:
                    break
        words, label, hidden = set(), [], False
        for a in ATTR.finditer(attrs) if attrs else ():
            key = a[1].lower()
            if key not in KEYS:
                continue
            value = (a[2] or a[3] or a[4] or "").lower()
            hidden |= key == "hidden" or (key == "role" and value in SKIP_ROLES)
            if key in ("class", "id"):
                for c in value.split():
                    parts = PART.findall(c)
                    words.update(parts if not parts or parts[0] not in STATES else ())
            if key == "class":
                label = sorted({re.sub(r"\d+", "", c) for c in value.split()} - {""})
        parent = stack[-1]
        head_ok = self.in_article[parent]
        whole = name in ("html", "body", "article", "main")  # its class says nothing about its text
        by_class = bool(words & SKIP_WORDS) or (bool(words & HEADERS) and not head_ok)
        by_tag = name in SKIP_TAGS or name in RAW or hidden or (name == "header" and not head_ok)
        tags.append(name)
        self.parents.append(parent)
        self.labels.append(".".join([name, *label]))
        self.by_tag.append(by_tag and not whole)
        self.by_class.append(by_class and not whole)
        self.own_words.append(bool(words & SKIP_WORDS))
        self.in_article.append(self.in_article[parent] or name in ("article", "main"))
        if name not in VOID:
            stack.append(len(tags) - 1)
            self.open[name] += 1

    def _close(self, name):
        if self.open[name]:
            for k in range(len(self.stack) - 1, 0, -1):
                t = self.tags[self.stack[k]]
                if t == name:
                    return self._pop(k)
                if t in SCOPE and name not in SCOPE:
                    return None  # an end tag does not reach out of its block
        return None

    def path(self, e: int) -> str:
        """Tags and classes from the root down; no class has a space in it."""
        labels = []
        while e > 0:
            labels.append(self.labels[e])
            e = self.parents[e]
        return " ".join(reversed(labels))

    def best(self) -> tuple[str | None, float]:
        """Path and score of the best container. A paragraph's text counts for
        its container and, halved at each step, for the containers above; the
        text of links counts against it."""
        score: dict = {}
        linked, box = [False], [0]  # inside a link; nearest container
        for i in range(1, len(self.tags)):
            linked.append(self.tags[i] == "a" or linked[self.parents[i]])
            box.append(i if self.tags[i] in CONTAINERS else box[self.parents[i]])
        for e, _, text in self.texts:
            if self.skips[e] or not (size := len(text.strip())):
                continue
            weight, up = (-1.0 if linked[e] else 1.0) * size, box[e]
            while up > 0 and abs(weight) > 1e-6:
                bonus = 2.0 if self.tags[up] in ("article", "main") else 1.0
                score[up] = score.get(up, 0.0) + weight * bonus
                weight, up = weight * 0.5, box[self.parents[up]]
        if not score:
            return None, 0.0
        top = max(score, key=lambda k: (score[k], -k))
        return (self.path(top), score[top]) if score[top] > 0 else (None, 0.0)

    def text(self, path: str) -> str:
        """Text of all elements at ``path``: white space inside a block is one
        space, blocks are joined by one."""
        want = path.split(" ")
        depth, inside = [0], [False]  # labels of the path that lead here, -1 off it
        for i in range(1, len(self.tags)):
            d = depth[self.parents[i]]
            depth.append(d + 1 if 0 <= d < len(want) and self.labels[i] == want[d] else -1)
            inside.append(inside[self.parents[i]] or depth[i] == len(want))
        return self._joined(inside)

    def loose(self) -> str:
        """All text that is not left out, of a page without a container; none
        if most of it is in links."""
        linked, plain = [False], 0
        for i in range(1, len(self.tags)):
            linked.append(self.tags[i] == "a" or linked[self.parents[i]])
        for e, _, text in self.texts:
            if not self.skips[e]:
                plain += -len(text.strip()) if linked[e] else len(text.strip())
        boxed = any(t in CONTAINERS and not s for t, s in zip(self.tags, self.skips, strict=True))
        return self._joined([True] * len(self.tags)) if plain > 0 and not boxed and len(self.tags) > 1 else ""

    def _joined(self, inside: list) -> str:
        out, last = [], None
        for e, block, text in self.texts:
            if inside[e] and not self.skips[e]:
                out += [" ", text] if block != last else [text]
                last = block
        return " ".join("".join(out).split())


def best_paths(pages: DataFrame, url_col="url", html_col="html") -> DataFrame:
    """``host, path, score`` of each page that has a container with text."""
    def run(batches):
        for b in batches:
            found = [Page(h or "").best() for h in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([p for p, _ in found], pa.string()),
                 pa.array([float(s) for _, s in found], pa.float64())], ["host", "path", "score"])

    p = pages.select(host_of(url_col).alias("host"), F.col(html_col).cast("string").alias("html"))
    return p.mapInArrow(run, "host string, path string, score double").where("path is not null")


def host_of(url_col: str):
    return F.lower(F.try_parse_url(F.col(url_col).cast("string"), F.lit("HOST")))


def winners(votes: DataFrame) -> DataFrame:
    """``host, path``: the path with most votes, then the highest total score."""
    counted = votes.where("host is not null").groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.floor("score")).alias("s"))
    return counted.groupBy("host").agg(F.max_by("path", F.struct("n", "s", "path")).alias("path"))


def extract(pages: DataFrame, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """``page_id, url, text, n_chars, by_host`` (the host's path was used)."""
    won = staged(winners(best_paths(pages, url_col, html_col)), "host-paths")
    won = won.select(F.col("host").alias("won_host"), F.col("path").alias("won_path"))
    p = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                     F.col(html_col).cast("string").alias("html"), host_of(url_col).alias("host"))
    p = p.join(won, p.host == won.won_host, "left").select("page_id", "url", "html", "won_path")

    def run(batches):
        for b in batches:
            texts, by_host = [], []
            for h, path in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                page = Page(h or "")
                text = page.text(path) if path else ""
                by_host.append(bool(text))
                if not text:
                    own = page.best()[0]
                    text = page.text(own) if own else page.loose()
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array(by_host)], ["page_id", "url", "text", "n_chars", "by_host"])

    kinds = {f.name: f.dataType.simpleString() for f in p.schema}
    return p.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long, by_host boolean")

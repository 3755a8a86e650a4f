"""Main text of pages by union-free wrappers inferred for each host.

A page is read into a stream of tokens: start and end tags of blocks, and texts. Streams of
one host are aligned with each other one after another, level by level of their tags. What
two streams share is template, texts included; texts that differ become slots; children
that only one side has become optional; runs of equal children, or of equal groups of
children, become repeated. What is left is a union-free regular expression, the wrapper of
the host. The text that varies in it, by amount, says which part of the host's pages is the
article, and texts that do not vary are told from it; names of elements only break ties and
take out what stands inside an article without being of it.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resultlake.llm import batches as B
from resultlake.llm.scratch import stored

#: Elements without content, elements whose content is no markup, elements that are blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript textarea title iframe xmp template svg".split())
BLOCKS = frozenset("address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold no text of a page's body; elements and words of class, id and role that are not the article.
SKIPPED = frozenset("head script style noscript template iframe svg button select textarea dialog menu title object canvas audio video".split())
OUTSIDE = frozenset("nav footer aside".split())
OUTSIDE_WORDS = frozenset("nav navbar navigation menu header footer sidebar aside ad ads advert adverts advertisement advertising banner promo promotion sponsor sponsored cookie cookies consent notice notices alert popup modal overlay newsletter subscribe subscription signup share sharing social related recommended breadcrumb breadcrumbs comment comments reply replies respond disqus login search widget pagination pager skip complementary contentinfo".split())
COMMENT_WORDS = frozenset("comment comments reply replies respond disqus navigation complementary contentinfo".split())
#: Words beside one of the above that change nothing, and words that turn it into a remark about the layout.
NEUTRAL = frozenset("area bar block body bottom box button buttons container content count form group icons inline inner item items left link links list main mobile page panel posts right section site slot text top unit wrap wrapper".split())
REMARKS = frozenset("with without has have no not is hide show".split())
#: Ways to say that an element is the article.
ARTICLE_WORDS = frozenset("articlebody article post entry story content main text".split())
#: An open element that the start of a block of the second set ends.
ENDS = {"p": BLOCKS - {"br"}, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"])}
#: Open elements that keep an end tag within from ending what is around them.
HOLDS = frozenset("article aside body div section table td th main nav footer header form ul ol li html".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(>|\Z)", re.S)
NAMED = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.I)
WORD = re.compile(r"[^a-z0-9]+")
#: Levels of tags, equal ones in a row being one, below which only articles make a level of their own. Longest repeated group.
LEVELS, GROUP = 200, 3
#: Children of one level of a wrapper, and cells of one comparison, above which names and then order are told apart less closely.
WIDE, CELLS = 512, 1 << 20
#: Wrappers of a host merged by one task; wrappers that a task holds before it hands them on.
FAN, HELD = 64, 4096
#: Share of a level's varying text that a child needs to be the article's place; that a child named like one needs.
MOST, SOME = 0.8, 0.3


def mark_of(name: str, found: dict[str, str], in_article: bool) -> str:
    """'!' for an element that its name takes out of the article, '!!' if nothing can bring it back, else ''.

    A token of class, id or role counts if its last word does (post-comments, not
    social-post), or its first with neutral words after it (ad-box, not comments-free).
    """
    if name in OUTSIDE:
        return "!!"
    mark = "!" if name == "form" or name == "header" and not in_article else ""
    if not found or name in ("html", "body"):
        return mark
    plain = False
    for value in found.values():
        for token in value.split():
            words = [w for w in WORD.split(token) if w and not w.isdigit()]
            if not words or words[0] in REMARKS:
                continue
            word = words[-1] if words[-1] in OUTSIDE_WORDS else words[0] if words[0] in OUTSIDE_WORDS and all(w in NEUTRAL or w in OUTSIDE_WORDS for w in words[1:]) else ""
            if word in COMMENT_WORDS:
                return "!!"
            if word:
                mark = mark or "?"
            elif words[-1] in ARTICLE_WORDS:
                plain = True
    return ("" if plain else "!") if mark == "?" else mark


def key_of(name: str, found: dict[str, str]) -> str:
    """The element and the first word of its class, else id, else role; an id with digits says nothing."""
    for a in ("class", "id", "role"):
        words = WORD.split(found.get(a, "").strip())
        if words[0]:
            return name if a == "id" and any(c.isdigit() for c in words[0]) else f"{name}.{words[0]}"
    return name


def digest(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


class Page:
    """The blocks of a page, each with its path of tags, and the tree of its tokens.

    ``wanted``: paths of elements; ``has`` tells whether one of them is on the page. A tree
    is a list of elements [key, quantifier, children] and texts ["#", quantifier, digest,
    characters, characters in links, pages]; the digest of a slot is ''.
    """

    def __init__(self, text: str, tree: bool, wanted: frozenset[tuple[str, ...]] = frozenset()):
        self.blocks: list[tuple[tuple[str, ...], str]] = []
        self.root: list = ["", "", []]
        self.has = False
        ends = {p[-1] for p in wanted if p}
        nodes = [self.root]
        names: list[str] = []  # open elements, and for each the levels before it and whether its text is skipped
        before: list[int] = []
        skipped: list[bool] = []
        keys: list[str] = []
        parts: list[str] = []
        place: tuple[str, ...] = ()
        holder = self.root
        linked = articles = 0

        def flush() -> None:
            nonlocal linked
            if parts:
                block = " ".join(entities.unescape("".join(parts)).split())
                parts.clear()
                if block:
                    self.blocks.append((place, block))
                    if tree:
                        holder[2].append(["#", "", digest(block), len(block), min(linked, len(block)), 1])
            linked = 0

        def close(to: int) -> None:
            nonlocal articles
            articles -= names[to:].count("article")
            del keys[before[to] :], nodes[before[to] + 1 :]
            del names[to:], before[to:], skipped[to:]

        def put(chunk: str) -> None:
            nonlocal place, holder, linked
            if skipped and skipped[-1]:
                return
            if parts and keys != list(place):
                flush()
            if not parts:
                place, holder = tuple(keys), nodes[-1]
            parts.append(chunk)
            if "a" in names:
                linked += len(chunk.strip())

        at, size = 0, len(text)
        while at < size:
            m = TOKEN.search(text, at)
            if m is None:
                put(text[at:])
                break
            if m.start() > at:
                put(text[at : m.start()])
            at = m.end()
            name = m[2]
            if name is None:
                continue
            name = name.lower()
            if not m[4]:  # a tag that the end of the page cuts off
                break
            if name in BLOCKS:
                flush()
            if m[1]:
                for i in range(len(names) - 1, -1, -1):
                    if names[i] == name:
                        close(i)
                        break
                    if names[i] in HOLDS and name not in HOLDS:
                        break
                continue
            if name in BLOCKS:
                for i in range(len(names) - 1, -1, -1):
                    if name in ENDS.get(names[i], ()):
                        close(i)
                        break
                    if names[i] in HOLDS:
                        break
            if name in VOID:
                continue
            if name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(text, at)
                at = end.end() if end else size
                continue
            if m[3].endswith("/") and name not in BLOCKS:
                continue
            found = {a.lower(): (q or s or u).lower() for a, q, s, u in NAMED.findall(m[3])} if "=" in m[3] else {}
            names.append(name)
            before.append(len(keys))
            mark = mark_of(name, found, articles > 0)
            articles += name == "article"
            skipped.append(bool(skipped and skipped[-1]) or name in SKIPPED or bool(HIDDEN.search(m[3])) or bool(mark) and name not in BLOCKS)
            if name not in BLOCKS:
                continue
            key = key_of(name, found) + mark
            if keys and keys[-1] == key or len(keys) >= LEVELS and name not in ("article", "main"):
                continue
            keys.append(key)
            if key in ends and tuple(keys) in wanted:
                self.has = True
            node = [key, "", []]
            nodes[-1][2].append(node)
            nodes.append(node)
        flush()


def _many(a: str, b: str) -> str:
    """The quantifier of what is a and b, each of '', '?', '+' or '*'."""
    some, many = "?" in (a, b) or "*" in (a, b), bool({a, b} & {"+", "*"})
    return "*" if some and many else "?" if some else "+" if many else ""


def _label(x: list) -> str:
    """What must be equal for two tokens to be template at once: the tag, and the text of a block of one text."""
    if x[0] == "#":
        return "#=" + x[2] if x[2] else "#"
    own = x[2]
    return f"{x[0]}={own[0][2]}" if len(own) == 1 and own[0][0] == "#" and own[0][2] else x[0]


def _settled(x: list) -> bool:
    """Whether a token is a text, or a block of one, that several pages have alike."""
    if x[0] != "#":
        if len(x[2]) != 1 or x[2][0][0] != "#":
            return False
        x = x[2][0]
    return bool(x[2]) and x[5] > 1


def merged(a: list, b: list) -> list:
    if a[0] == "#":
        return ["#", _many(a[1], b[1]), a[2] if a[2] == b[2] else "", a[3] + b[3], a[4] + b[4], a[5] + b[5]]
    return [a[0], _many(a[1], b[1]), align(a[2], b[2])]


def _matches(a: list[str], b: list[str]) -> Iterator[tuple[int, int]]:
    """Pairs of positions of equal keys, ascending on both sides."""
    if len(a) * len(b) <= CELLS:
        for i, j, n in SequenceMatcher(None, a, b, False).get_matching_blocks():
            yield from ((i + k, j + k) for k in range(n))
        return
    where: dict[str, list[int]] = defaultdict(list)
    for j, key in enumerate(b):
        where[key].append(j)
    j = 0
    for i, key in enumerate(a):
        own = where.get(key, ())
        k = bisect_left(own, j)
        if k < len(own) and own[k] - j <= WIDE:
            yield i, own[k]
            j = own[k] + 1


def align(a: list, b: list) -> list:
    """One list of tokens for two: what both have in order, slots for texts that differ, the rest optional."""
    lo, most = 0, min(len(a), len(b))
    while lo < most and _label(a[lo]) == _label(b[lo]):
        lo += 1
    hi = 0
    while hi < most - lo and _label(a[-1 - hi]) == _label(b[-1 - hi]):
        hi += 1
    out = [merged(x, y) for x, y in zip(a[:lo], b[:lo])]
    tail = [merged(x, y) for x, y in zip(a[len(a) - hi :], b[len(b) - hi :])]
    one, two = fold(a[lo : len(a) - hi]), fold(b[lo : len(b) - hi])
    middle: list = []
    i = j = 0
    for k, n in (*_matches([x[0] for x in one], [x[0] for x in two]), (len(one), len(two))):
        middle += [[x[0], _many(x[1], "?"), *x[2:]] for x in (*one[i:k], *two[j:n])]
        if k < len(one):
            middle.append(merged(one[k], two[n]))
        i, j = k + 1, n + 1
    return out + _narrow(fold(middle)) + tail


def _narrow(items: list) -> list:
    """A level of many children with the children of one tag as one, whatever their names and order."""
    if len(items) <= WIDE:
        return items
    by: dict[str, list] = {}
    for x in items:
        key = x[0] if x[0] in ("#", "(") else x[0].split(".")[0].rstrip("!") + "!" * x[0].count("!")
        same = by.get(key)
        by[key] = [key, "*", *x[2:]] if same is None else merged(same, [key, "*", *x[2:]]) if key != "(" else ["(", "*", align(same[2], x[2])]
    return list(by.values())


def _alike(a: list[list], b: list[list]) -> bool:
    return all(x[0] == y[0] != "(" and (not (_settled(x) or _settled(y)) or _label(x) == _label(y)) for x, y in zip(a, b))


def fold(items: list) -> list:
    """Make runs of equal children, or of equal groups of children, one repeated child or group.

    A text that several pages have alike is template and no part of a run of other texts.
    """
    out: list = []
    for node in items:
        out.append(node)
        again = True
        while again:
            again = False
            for n in range(1, GROUP + 1):
                if len(out) > n and out[-n - 1][0] == "(" and len(out[-n - 1][2]) == n and _alike(out[-n - 1][2], out[-n:]):
                    tail = out[-n:]
                    del out[-n:]
                    out[-1] = ["(", _many(out[-1][1], "+"), [merged(x, y) for x, y in zip(out[-1][2], tail)]]
                    again = True
                    break
                if len(out) >= 2 * n and _alike(out[-2 * n : -n], out[-n:]):
                    both = [merged(x, y) for x, y in zip(out[-2 * n : -n], out[-n:])]
                    del out[-2 * n :]
                    out.append([both[0][0], _many(both[0][1], "+"), *both[0][2:]] if n == 1 else ["(", "+", both])
                    again = n > 1
                    break
    return out


def expression(items: list) -> str:
    """A wrapper as a regular expression over tags and texts; ``#`` is a slot, ``"..."`` the digest of a template text."""
    out = []
    for key, many, below, *_ in items:
        if key == "#":
            one = f'"{below}"' if below else "#"
        else:
            one = expression(below) if key == "(" else f"<{key}>{expression(below)}</{key.split('.')[0]}>"
        out.append(f"({one}){many}" if many else one)
    return "".join(out)


def _slots(items: list) -> bool:
    return any(not x[2] if x[0] == "#" else _slots(x[2]) for x in items)


class Regions:
    """Where a wrapper has the article: ``paths``, and digests of template texts that are not of it.

    Articles and mains that the wrapper knows are the place. Without them, it is found by
    going down from the root into the child with most of the text that varies, as long as
    no heading is left beside it. An element inside the place is part of it, in spite of
    its name, if it holds more than half of the place's varying text.
    """

    def __init__(self, items: list, pages: int = 1):
        self.all = not _slots(items)  # one page only, or equal pages: nothing varies, so all counts
        self.paths: list[tuple[str, ...]] = []
        self.template: list[str] = []
        for name in ("article", "main"):
            self._named(items, (), name)
            if self.paths:
                break
        if not self.paths:
            self.barred = next((b for b in ("!", "!!") if self._mass(items, b)), "!!!")
            path = self._down(items, ())
            if not path:
                return
            self.paths = [path]
            if not self.all:
                self.template = sorted({t for t, n in self._texts(items) if n > 1 and 2 * n >= pages})
        for path in list(self.paths):
            self._kept(self._at(items, path), path)

    def _mass(self, items: list, barred: str) -> int:
        """Characters of varying text outside links, but for elements whose mark begins with ``barred``."""
        total = 0
        for x in items:
            if x[0] == "#":
                total += x[3] - x[4] if self.all or not x[2] else 0
            elif barred not in x[0]:
                total += self._mass(x[2], barred)
        return total

    def _children(self, items: list) -> Iterator[list]:
        for x in items:
            if x[0] == "(":
                yield from ([k, m, *r] if m in "+*" and m else [k, "+", *r] for k, m, *r in self._children(x[2]))
            else:
                yield x

    def _named(self, items: list, path: tuple[str, ...], name: str) -> None:
        for x in self._children(items):
            own = (*path, x[0])
            if x[0] == "#" or "!!" in x[0]:
                continue
            if x[0].split(".")[0] == name:
                if own not in self.paths:
                    self.paths.append(own)
            else:
                self._named(x[2], own, name)

    def _down(self, items: list, path: tuple[str, ...]) -> tuple[str, ...]:
        total = self._mass(items, self.barred)
        if not total:
            return ()
        kids = [x for x in self._children(items) if x[0] != "#" and self.barred not in x[0]]
        if path and self._article(path[-1]):
            return path
        mass = {i: self._mass([x], self.barred) for i, x in enumerate(kids)}
        for i in sorted(mass, key=lambda i: (-mass[i], i)):
            tag = kids[i][0].split(".")[0].rstrip("!")
            heading = any(mass[k] and kids[k][0].split(".")[0] in HEADINGS for k in mass if k != i)
            big = mass[i] >= MOST * total and not heading or mass[i] >= SOME * total and self._article(kids[i][0])
            if big and kids[i][1] not in ("+", "*") and tag not in ENDS and tag not in HEADINGS and tag not in ("ul", "ol", "table", "pre", "blockquote"):
                return self._down(kids[i][2], (*path, kids[i][0]))
        return path

    def _article(self, key: str) -> bool:
        return key.split(".")[0] in ("div", "section", "td") and key.partition(".")[2].rstrip("!") in ARTICLE_WORDS

    def _at(self, items: list, path: tuple[str, ...]) -> list:
        for key in path:
            items = [y for x in self._children(items) if x[0] == key for y in x[2]]
        return items

    def _kept(self, items: list, path: tuple[str, ...]) -> None:
        total = self._mass(items, "!!")
        for x in self._children(items):
            if x[0] == "#" or "!!" in x[0]:
                continue
            if "!" in x[0] and 2 * self._mass(x[2], "!!") > total:
                self.paths.append((*path, x[0]))

    def _texts(self, items: list) -> Iterator[tuple[str, int]]:
        for x in items:
            if x[0] != "#":
                yield from self._texts(x[2])
            elif x[2]:
                yield x[2], x[5]


def _inside(path: tuple[str, ...], regions: Iterable[tuple[str, ...]]) -> bool:
    """Whether a block is in one of the regions, and in nothing there that is not of the article."""
    for r in regions:
        if path[: len(r)] == r and not any("!" in k and k != "header!" for k in path[len(r) :]):
            return True
    return False


def main_text(text: str, paths: list[tuple[str, ...]], template: Iterable[str] = ()) -> str:
    """The blocks of the article, but for those whose text is template.

    On a page without the elements that the wrapper names, the page's own tree says where
    the article is; if it cannot either, blocks outside menus and the like are taken.
    """
    page = Page(text, tree=False, wanted=frozenset(paths))
    known = set(template)
    inside = [b for p, b in page.blocks if _inside(p, paths) and (not known or digest(b) not in known)]
    if not inside and not (page.has and paths):
        own = Regions(Page(text, tree=True).root[2]).paths or [()]
        inside = [b for p, b in page.blocks if _inside(p, own) and (not known or digest(b) not in known)]
    return " ".join(inside)


def _row(hosts: list[str], trees: list[list], counts: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array([json.dumps(t, separators=(",", ":")) for t in trees], pa.string()), pa.array(counts, pa.int64())], ["host", "tree", "n"])


def _partial(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wrapper of each host's pages in this task."""
    held: dict[str, list] = {}
    for b in B.pieces(it, "html"):
        for h, x in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
            tree = Page(x, tree=True).root[2]
            own = held.get(h)
            held[h] = [tree, 1] if own is None else [align(own[0], tree), own[1] + 1]
        if len(held) > HELD:
            yield _row(list(held), [t for t, _ in held.values()], [n for _, n in held.values()])
            held = {}
    if held:
        yield _row(list(held), [t for t, _ in held.values()], [n for _, n in held.values()])


def _aligned(group: pd.DataFrame) -> pd.DataFrame:
    """One wrapper for all of a group, that of most pages first."""
    rows = group.sort_values(["n", "tree"], ascending=[False, True])
    tree: list | None = None
    for text in rows["tree"]:
        other = json.loads(text)
        tree = other if tree is None else align(tree, other)
    return pd.DataFrame({"host": [rows["host"].iloc[0]], "tree": [json.dumps(tree, separators=(",", ":"))], "n": [int(rows["n"].sum())]})


def host_of(url):  # noqa: ANN001, ANN201
    """The host of a URL in lower case; '' where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)", 1)), F.lit(""))


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, tree, n): the wrapper of each host and its pages.

    Each task aligns the pages that it reads, so a host leaves a task as one wrapper. These
    are merged in rounds, each task taking ``FAN`` wrappers of a host or so; a host of any
    size takes more rounds, not larger tasks. Null pages count as empty ones, and pages
    without a URL are of one host, ''. An empty table gives no wrappers.
    """
    B.small_batches(pages.sparkSession)
    kind = "host string, tree string, n long"
    slim = pages.select(host_of(F.col(url_col)).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    found = stored(slim.mapInArrow(_partial, kind), "wrappers")
    while True:
        parts = found.groupBy("host").agg(F.count("*").alias("parts"))
        most = parts.agg(F.max("parts")).first()[0] or 0  # one number
        if most <= 1:
            return found
        salt = F.pmod(F.xxhash64("tree", "n"), F.ceil(F.col("parts") / F.lit(FAN)))
        salted = found.join(parts, "host").withColumn("salt", salt)
        found = stored(salted.select("host", "salt", "tree", "n").groupBy("host", "salt").applyInPandas(lambda g: _aligned(g), kind), "wrappers")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for each row of ``pages``; n_chars counts code points.

    Character references are decoded, white space in a block is one blank, blocks are joined
    by one blank. A null or empty page has the empty text; pages without a URL are of one
    host, ''. Rows are independent but for the wrapper of their host, so a repeated page has
    a row each time. A page that is cut off gives the text before the cut. An empty table
    gives an empty result. Other columns, whatever their names, are ignored. A host's row is
    joined to its pages by the host; a host of very many pages is split by Spark's handling
    of skewed joins, or sent to all where the wrappers are small.
    """
    found = wrappers(pages, url_col, html_col)

    def regions(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            own = [Regions(json.loads(t), n) for t, n in zip(b.column("tree").to_pylist(), b.column("n").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("host"), pa.array([r.paths for r in own], pa.list_(pa.list_(pa.string()))), pa.array([r.template for r in own], pa.list_(pa.string()))], ["h", "paths", "template"])

    places = stored(found.select("host", "tree", "n").mapInArrow(regions, "h string, paths array<array<string>>, template array<string>"), "regions")
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in B.pieces(it, "html"):
            rows = zip(*(b.column(c).to_pylist() for c in ("html", "paths", "template")))
            out = [main_text(x, [tuple(p) for p in paths or ()], template or ()) for x, paths, template in rows]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())], ["page_id", "url", "text", "n_chars"])

    both = base.join(places, F.col("host") == F.col("h"), "left").select("page_id", "url", "html", "paths", "template")
    return both.mapInArrow(run, "page_id long, url string, text string, n_chars long")

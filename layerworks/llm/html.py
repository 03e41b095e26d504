"""Main text of web pages by wrappers inferred for each host.

A page's token stream is read into nested groups (containers, and leaf blocks or inline elements whose
marks tell boilerplate) and blocks of text.  A group's path is the chain of labels from the
root; a label is the tag with its class, id and role.  A host's wrapper is a union-free regular expression, kept as one
expression for each path: the sequence of child labels and texts ("#") in its groups, each once, optional
("?"), repeated ("+") or both ("*").  Expressions of one path are aligned pairwise, again and again, until one is
left: what they have in common stays, what one side lacks becomes optional, adjacent runs that
recur fold into a repeated group.  A text is a literal where (nearly) all pages that have its path agree in
it, and a slot where they differ.

Expressions are counted as distinct forms before they meet, and they, pages and texts are aggregated by Spark for each
(host, path, form or text); rounds of alignment follow the number of forms, so that a host with a third of all pages is spread like
many small ones.  Walks use no recursion: groups may nest 100,000 deep.

The wrapper decides which texts are main: inside an article or main group all but groups that are literal as a
whole; on pages without such a group slots, but neither literals nor repeated groups that
are mostly links.  Names of tags and classes are a prior: menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and comments are left out where they say what they are.  A page of which the wrapper leaves nothing
is read by names alone.
"""

from __future__ import annotations

import html as references
import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerworks.llm.common import text_slices, written

_ATTRS = r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    rf"|<(?P<raw>script|style|template|textarea|iframe|select|button)\b(?:{_ATTRS}|[^>]*+)>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>{_ATTRS}|[^>]*+)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_MARK = re.compile(r"(?:\s|^)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_NUMBER = re.compile(r"[0-9]{3,}")
# Containers nest; leaf blocks only part the text.  All other tags stand inside a block.
CONTAINERS = frozenset("html head body nav header footer aside main article section div form ul ol dl table thead tbody tfoot tr td th figure details dialog fieldset li dt dd blockquote menu title noscript".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 pre hr br address figcaption caption summary legend option center".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SINGLE = frozenset("li dt dd tr td th".split())  # closed by the next one of its kind
OUTSIDE = frozenset("head title nav header footer aside form menu dialog".split())
OUTSIDE_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar "
    "notice notices cookie cookies consent popup modal newsletter subscribe comment comments disqus share social related widget search form contentinfo complementary".split()
)
# Words that beside a listed one leave a mark what it is ("ad-box", "share-buttons").
NEUTRAL = frozenset("box container wrapper wrap block inner outer slot unit area bar panel list link links button buttons icon icons item items post posts signup top bottom left right".split())
MAIN_TAGS = frozenset(("article", "main"))
# Groups inside an article that may be template as a whole.
PARTS = frozenset("div section aside nav form ul ol details dialog".split())
FEWEST, SHARE, HOST_SHARE, LINKS = 3, 0.9, 0.01, 0.6
FORMS = 32  # of one path that are aligned in one group
GAP = 64  # children between anchors up to which a longest common run is looked for

Token = list  # [label or "#", quantifier "1" "?" "+" "*"]


@lru_cache(maxsize=4096)
def label_of(name: str, attrs: str) -> str:
    """Tag, and the words of class, id and role in order, without long numbers."""
    marks = {_NUMBER.sub("", w.lower()) for m in _MARK.finditer(attrs) for w in (m[2] or m[3] or m[4] or "").split()} if attrs else ()
    return " ".join([name, *sorted(w for w in marks if w)])


@lru_cache(maxsize=4096)
def names(label: str) -> tuple[bool, bool, bool]:
    """(says boilerplate anywhere, says it inside an article too, says main text)."""
    tag, *marks = label.split(" ")
    words = [{w.lower() for w in _NAME.findall(m)} for m in marks]
    inside = tag in OUTSIDE or any(w & OUTSIDE_MARKS and w <= OUTSIDE_MARKS | NEUTRAL for w in words)
    return inside or tag == "noscript" or any(w & OUTSIDE_MARKS for w in words), inside, tag in MAIN_TAGS or any(w & MAIN_TAGS for w in words)


class Page:
    """Groups in order of opening (parents first) and blocks of text.

    ``parent``, ``label``, ``path`` (hash of the labels from the root), ``off`` (names say boilerplate), ``inside`` (within an
    article or main group), ``children`` (tokens) are lists by group; ``blocks`` holds
    (group, text, characters in links) of the blocks that names do not leave out."""

    def __init__(self, source: str):
        self.parent, self.label, self.path, self.off, self.inside = [-1], [""], [0], [False], [False]
        self.children: list[list[Token]] = [[]]
        self.blocks: list[tuple[int, str, int]] = []
        self._held: list[tuple[int, str, bool]] = []
        stack, opened, link, at = [0], {"": 1}, False, 0
        tags = [""]

        def leave(depth: int) -> None:
            for t in tags[depth:]:
                opened[t] -= 1
            del stack[depth:], tags[depth:]

        for m in _TOKEN.finditer(source):
            if m.start() > at:
                self._held.append((stack[-1], source[at : m.start()], link))
            at = m.end()
            name = (m["name"] or "").lower()
            if not name:
                continue
            block = name in CONTAINERS or name in LEAVES
            if block:
                self._close()
                if tags[-1] == "p":  # a marked paragraph ends where the next block begins
                    leave(len(stack) - 1)
            if m["end"]:
                if name == "a":
                    link = False
                if opened.get(name):
                    depth = len(tags) - 1 - tags[::-1].index(name) if tags[-1] != name else len(tags) - 1
                    if depth and (name in CONTAINERS or not any(t in CONTAINERS for t in tags[depth + 1 :])):
                        leave(depth)
                continue
            if name == "a":
                link = True
            if name in SINGLE:
                scope = ("ul", "ol", "dl", "table", "menu") if name in ("li", "dt", "dd") else ("table",)
                for i in range(len(stack) - 1, 0, -1):
                    tag = tags[i]
                    if tag in scope:
                        break
                    if tag == name or (name in ("dt", "dd") and tag in ("dt", "dd")) or (name == "tr" and tag in ("td", "th")):
                        leave(i)
                        if tag == name:
                            break
            label = label_of(name, m["attrs"])
            if name in CONTAINERS or (name not in VOID and " " in label and names(label)[1]):
                stack.append(self._open(stack[-1], label))
                tags.append(name)
                opened[name] = opened.get(name, 0) + 1
        if at < len(source):
            self._held.append((stack[-1], source[at:], link))
        self._close()

    def _open(self, parent: int, label: str) -> int:
        loose, strict, center = names(label)
        off = self.off[parent] or (strict if self.inside[parent] else loose)
        self.children[parent].append([label, "1"])
        self.parent.append(parent)
        self.label.append(label)
        self.path.append(xxhash.xxh64_intdigest(label, self.path[parent]))
        self.off.append(off)
        self.inside.append(self.inside[parent] or (center and not off))
        self.children.append([])
        return len(self.parent) - 1

    def _close(self) -> None:
        """Ends a block: its pieces outside boilerplate become one text, of the first piece's group."""
        pieces = [p for p in self._held if not self.off[p[0]]]
        if pieces:
            text = " ".join(references.unescape("".join(p[1] for p in pieces)).split())
            if text:
                links = sum(len(p[1].strip()) for p in pieces if p[2])
                self.blocks.append((pieces[0][0], text, min(links, len(text))))
                self.children[pieces[0][0]].append(["#", "1"])
        self._held.clear()

    def main(self, cut: frozenset[int] = frozenset()) -> str:
        """The page's main text; ``cut`` has hashes of paths and texts that its host's wrapper leaves out."""
        gone = [False] * len(self.parent)
        if cut:
            for g in range(1, len(gone)):
                gone[g] = gone[self.parent[g]] or cut_path(self.path[g]) in cut
        center = any(self.inside[g] for g, _, _ in self.blocks)
        return " ".join(
            text for g, text, _ in self.blocks
            if not gone[g] and (self.inside[g] if center else not (cut and cut_text(self.path[g], text) in cut))
        )


def digest(text: str, seed: int = 0) -> int:
    return xxhash.xxh64_intdigest(text, seed)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def cut_path(path: int) -> int:
    return signed(path)


def cut_text(path: int, text: str) -> int:
    return signed(digest(text, path))


def _both(a: str, b: str) -> str:
    """The quantifier that covers two."""
    many, none = {"+", "*"} & {a, b}, {"?", "*"} & {a, b}
    return ("*" if none else "+") if many else ("?" if none else "1")


def folded(tokens: list[Token]) -> list[Token]:
    """Adjacent runs of up to four labels that recur become one repeated group."""
    for width in (1, 2, 3, 4):
        out: list[Token] = []
        for t in tokens:
            out.append(list(t))
            while len(out) >= 2 * width and [x[0] for x in out[-width:]] == [x[0] for x in out[-2 * width : -width]]:
                tail = out[-width:]
                del out[-width:]
                for i, x in enumerate(tail):
                    a = out[len(out) - width + i]
                    a[1] = "*" if "1" not in (a[1], x[1]) and "+" not in (a[1], x[1]) else "+"
        tokens = out
    return tokens


def _anchors(x: list[str], y: list[str]) -> list[tuple[int, int]]:
    """Places of labels that occur once on either side, the longest chain that rises on both."""
    once = {c: i for i, c in enumerate(y) if y.count(c) == 1} if len(y) <= GAP else None
    if once is None:
        seen: dict[str, int] = {}
        for i, c in enumerate(y):
            seen[c] = -1 if c in seen else i
        once = {c: i for c, i in seen.items() if i >= 0}
    many: dict[str, int] = {}
    for c in x:
        many[c] = many.get(c, 0) + 1
    tails, ends, back, pairs = [], [], [], [(i, once[c]) for i, c in enumerate(x) if many[c] == 1 and c in once]
    for n, (_, j) in enumerate(pairs):
        k = bisect_left(tails, j)
        back.append(ends[k - 1] if k else -1)
        tails[k : k + 1], ends[k : k + 1] = [j], [n]
    out, n = [], ends[-1] if ends else -1
    while n >= 0:
        out.append(pairs[n])
        n = back[n]
    return out[::-1]


def _common(x: list[str], y: list[str]) -> list[tuple[int, int]]:
    """Places of a common run of labels: the longest, if either side is short."""
    if len(x) * len(y) > GAP * GAP:
        return []
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in reversed(range(len(x))):
        for j in reversed(range(len(y))):
            best[i][j] = best[i + 1][j + 1] + 1 if x[i] == y[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(x) and j < len(y):
        if x[i] == y[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def align(a: list[Token], b: list[Token]) -> list[Token]:
    """The expression of two: tokens in common with the quantifier that covers both, all others
    optional, recurring runs folded.  Space and time stay linear but for gaps of bounded size."""
    x, y = [t[0] for t in a], [t[0] for t in b]
    if x == y:
        return [[p[0], _both(p[1], q[1])] for p, q in zip(a, b, strict=True)]
    out: list[Token] = []
    i = j = 0
    for u, v in [*_anchors(x, y), (len(x), len(y))]:
        p, q = i, j
        for c, d in [*((p + c, q + d) for c, d in _common(x[p:u], y[q:v])), (u, v)]:
            out += [[t[0], _both(t[1], "?")] for t in a[i:c]] + [[t[0], _both(t[1], "?")] for t in b[j:d]]
            if c < u:
                out.append([x[c], _both(a[c][1], b[d][1])])
                i, j = c + 1, d + 1
            else:
                i, j = c, d
        if u < len(x) and v < len(y):
            out.append([x[u], _both(a[u][1], b[v][1])])
            i, j = u + 1, v + 1
    return folded(out)


def packed(tokens: list[Token]) -> str:
    return json.dumps(tokens, separators=(",", ":"))


def merged(forms: list[str]) -> str:
    out = [json.loads(f) for f in sorted(set(forms))]
    while len(out) > 1:
        out = [align(*out[i : i + 2]) if i + 1 < len(out) else out[i] for i in range(0, len(out), 2)]
    return packed(out[0])


def host(url: str) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


_PATHS = "host string, page long, path long, parent long, label string, inside boolean, whole long, chars long, links long, form string, texts array<long>"


def paths_of(source: str) -> list[dict]:
    """One row for each path of a page: the sum of its texts' hashes below (``whole``), their
    characters and those in links, its groups' expression, and hashes of the texts that stand in it."""
    page = Page(source)
    n = len(page.parent)
    whole, chars, links = [0] * n, [0] * n, [0] * n
    texts: dict[int, set[int]] = {}
    for g, text, linked in page.blocks:
        whole[g] += digest(text)
        chars[g] += len(text)
        links[g] += linked
        texts.setdefault(page.path[g], set()).add(cut_text(page.path[g], text))
    for g in range(n - 1, 0, -1):
        p = page.parent[g]
        whole[p], chars[p], links[p] = whole[p] + whole[g], chars[p] + chars[g], links[p] + links[g]
    rows: dict[int, dict] = {}
    forms: dict[int, set[str]] = {}
    for g in range(n):
        if page.off[g]:
            continue
        key = page.path[g]
        r = rows.setdefault(key, {"path": signed(key), "parent": signed(page.path[page.parent[g]]) if g else None, "label": page.label[g], "inside": page.inside[g], "whole": 0, "chars": 0, "links": 0})
        r["whole"], r["chars"], r["links"] = (r["whole"] + whole[g]) % (1 << 64), r["chars"] + chars[g], r["links"] + links[g]
        forms.setdefault(key, set()).add(packed(folded(page.children[g])))
    for key, r in rows.items():
        r |= {"whole": signed(r["whole"]), "form": merged(list(forms[key])), "texts": sorted(texts.get(key, ()))}
    return list(rows.values())


def wrappers(df: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """Per (host, path): parent path, label, whether inside an article or main group, distinct pages that have it, the
    expression of its groups, and what the wrapper finds: ``template`` (the texts below are the same on nearly all of these pages),
    ``menu`` (repeated and mostly links) and ``literals`` (hashes of texts that are the same on nearly all).

    Evidence takes ``FEWEST`` distinct pages, and one in a hundred of the host's, so that what a host's
    wrapper holds is bounded by the sizes of its pages.  Pages equal in host and html count once."""
    pages = df.select(host(url).alias("host"), F.xxhash64(source).alias("page"), F.col(source).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, "html"):
                out = [r | {"host": h, "page": p} for h, p, t in zip(b.column("host").to_pylist(), b.column("page").to_pylist(), b.column("html").to_pylist(), strict=True) for r in paths_of(t or "")]
                kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
                columns = [c.split() for c in _PATHS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], kinds[k]) for c, k in columns], names=[c for c, _ in columns])

    rows = written(pages.mapInArrow(run, _PATHS), "paths")
    n_pages = F.count_distinct("page").alias("pages")
    key = ["host", "path"]
    each = rows.groupBy(*key).agg(n_pages, F.min("parent").alias("parent"), F.min("label").alias("label"), F.bool_or("inside").alias("inside"), F.sum("chars").alias("chars"), F.sum("links").alias("links"))
    same = rows.groupBy(*key, "whole").agg(n_pages).groupBy(*key).agg(F.max("pages").alias("alike"))
    hosts = rows.filter("parent is null").groupBy("host").agg(F.count_distinct("page").alias("host_pages"))
    found = each.join(same, key).join(hosts, "host")
    known = written(found.withColumn("least", F.greatest(F.lit(FEWEST), F.ceil(HOST_SHARE * F.col("host_pages")), F.ceil(SHARE * F.col("pages")))), "counts")
    # texts that stand on few pages only are most of all: they go before the join
    often = rows.select(*key, "page", F.explode("texts").alias("text")).groupBy(*key, "text").agg(F.count_distinct("page").alias("n")).filter(F.col("n") >= FEWEST)
    literals = often.join(known.select(*key, "least"), key).filter("n >= least").groupBy(*key).agg(F.sort_array(F.collect_list("text")).alias("literals"))
    whole = F.col("alike") >= F.col("least")
    repeated = F.col("expression").rlike('"[+*]"')
    menu = (F.col("links") >= LINKS * F.col("chars")) & (F.col("chars") > 0) & repeated & (F.col("pages") >= F.greatest(F.lit(FEWEST), F.ceil(HOST_SHARE * F.col("host_pages"))))
    out = known.join(_expressions(rows.groupBy(*key, "form").agg(F.lit(1).alias("one"))), key).join(literals, key, "left")
    return written(
        out.select(*key, "parent", "label", "inside", "pages", "expression", (whole & (F.col("chars") > 0)).alias("template"), menu.alias("menu"), F.coalesce("literals", F.array().cast("array<long>")).alias("literals")),
        "wrappers",
    )


def _expressions(forms: DataFrame) -> DataFrame:
    """(host, path, expression): distinct forms aligned in groups of about ``FORMS``, dealt by hash, until
    one is left for each path."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [merged(f) for f in b.column("forms").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("host"), b.column("path"), pa.array(found, pa.string())], names=["host", "path", "form"])

    now = forms.select("host", "path", "form")
    while True:
        now = written(now.distinct(), "forms")
        many = written(now.groupBy("host", "path").agg(F.count("*").alias("n")), "many")
        most = many.agg(F.max("n")).first()[0] or 1
        if most == 1:
            return now.withColumnRenamed("form", "expression")
        dealt = now.join(many, ["host", "path"]).withColumn("salt", F.pmod(F.xxhash64("form"), F.ceil(F.col("n") / FORMS)))
        now = dealt.groupBy("host", "path", "salt").agg(F.collect_list("form").alias("forms")).select("host", "path", "forms").mapInArrow(join, "host string, path long, form string")


def cuts(wrapper: DataFrame) -> DataFrame:
    """(host, cut): hashes of the paths and texts that a host's wrapper leaves out.  Inside an article
    or main group these are groups that are template as a whole; elsewhere literals, template groups and menus."""
    tag = F.substring_index("label", " ", 1)
    outer = tag.isin("", "html", "body")
    paths = F.when(~outer & F.when(F.col("inside"), F.col("template") & tag.isin(*sorted(PARTS))).otherwise(F.col("template") | F.col("menu")), F.array("path")).otherwise(F.array().cast("array<long>"))
    texts = F.when(F.col("inside"), F.array().cast("array<long>")).otherwise(F.col("literals"))
    each = wrapper.select("host", F.explode(F.concat(paths, texts)).alias("cut"))
    return each.groupBy("host").agg(F.collect_set("cut").alias("cut"))


def extract(df: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """Adds ``text`` (main text, "" if none) and ``n_chars`` (its code points) to the rows of
    ``df``, without the html; columns of these names are replaced.

    Null html is an empty page.  Null urls, and urls without a host, form one host.  Repeated
    rows are pages of their own, but count once as evidence.  An empty table stays empty.  Pages of any
    length and depth are read whole."""
    new = ("text", "n_chars")
    base = df.drop(*[c for c in df.columns if c in new])
    own = [c for c in base.columns if c != source]
    known = written(cuts(wrappers(base, url, source)), "cuts")
    joined = base.withColumn("_llm_host", host(url)).join(known.withColumnsRenamed({"host": "_llm_host", "cut": "_llm_cut"}), "_llm_host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, frozenset[int]] = {}
        for whole in batches:
            for b in text_slices(whole, source):
                found = []
                for i, (t, h) in enumerate(zip(b.column(source).to_pylist(), b.column("_llm_host").to_pylist(), strict=True)):
                    if h not in held:
                        if len(held) >= 256:
                            held.clear()
                        held[h] = frozenset(b.column("_llm_cut")[i].as_py() or ())
                    page = Page(t or "")
                    found.append(page.main(held[h]) or (page.main() if held[h] else ""))
                yield pa.RecordBatch.from_arrays([*map(b.column, own), pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())], names=[*own, *new])

    fields = [f for f in base.schema.fields if f.name in own]
    schema = T.StructType([*fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return joined.select(*own, source, "_llm_host", "_llm_cut").mapInArrow(run, schema)

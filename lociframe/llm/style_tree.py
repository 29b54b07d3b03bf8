"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree: an element node for each path of
tags (with class and id), below it the presentation styles that pages give it
(the sequence of its children) and the content it holds (its text blocks).  The
importance of a node is the entropy of what its pages put there, relative to
the most diverse case: 0 if every page shows the same, 1 if each shows its own.
For n pages spread over features with counts c that is
1 - sum(c ln c) / (total ln n).  A branch in which neither the node nor any
descendant is important is site furniture and is cut from each page.  Elsewhere
each text block is weighed alone, 1 - ln c / ln n, and the ones that the site
repeats are cut, so unique prose stays beside them.  The plain prose blocks of a
declared article are decided by their content only, never as a branch.

Elements that are not main text by tag, role or being hidden (scripts, forms,
menus, footers ...) go whatever their importance.  A class or id word (advert,
comments, related ...) drops nothing by itself: it is a prior, a weight on the
importance that the tree gives the branch (apart from repeated blocks): ``INSIDE``
in a declared article and on pages that declare none, ``BESIDE`` next to a declared
article, where adverts that differ on every page stand.  A branch whose weighted
importance is under the threshold goes, unless it holds the declared article.
Where a site has too few pages to tell, a doubtful branch's importance is
``UNKNOWN``.

Below ``DEPTH`` levels a path keeps its first ``DEPTH`` elements and the last one, so
that the paths of very deep pages stay short; their text is read like any other.

Scale: pages are parsed where they are read and give (host, path, feature) rows;
a host's tree exists only as grouped rows, so a host with a third of all pages is
no hot task.  Pages of a host with equal article text (without an article: equal
text) count once.  What to cut is written to the shared folder and joined to the
pages by host; Spark sends that table to the executors only if its measured size
is small.

Defined results: null html or url is empty (pages without a host form one
site); broken markup is read as far as tags can be told; pages without main text
give an empty text; repeated rows are extracted each; an empty table gives an empty
result.  Only the named columns are read, so further columns never clash.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from functools import partial

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociframe.llm.common import stored, texts

THRESHOLD = 0.3          # importance below which a branch is furniture
INSIDE, BESIDE = 0.43, 0.25    # weights of branches with a noise word as class or id
UNKNOWN = 0.5            # importance of such a branch on a site of too few pages
LEAST_PAGES = 5          # a site of fewer different pages tells nothing
DEPTH = 100              # elements of a path
PAGES = 256              # pages worked on at a time

# Names of elements and of class or id words.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "textarea", "title", "xmp", "noframes")
NOT_TEXT = set("head script style noscript template svg math iframe object canvas form nav footer header aside menu dialog button select "
               "textarea title label fieldset input option xmp noframes".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rb rp rt s samp small span strike strong "
             "sub sup time tt u var wbr img".split())
PROSE = set("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol li dl dt dd table thead tbody tfoot tr td th figure figcaption hr br".split()) | INLINE
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}}
NOISE_WORDS = set("""ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation
menu breadcrumb breadcrumbs sidebar sidemenu footer header masthead topbar cookie cookies consent gdpr notice notices alert popup modal
overlay newsletter subscribe subscription signup login search share sharing social comment comments comentarios kommentare commentaires
disqus reply replies respond related recommended recommendations widget toolbar pagination pager skip hidden""".split())
NOISE_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>\x00]*)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*(?:>|\Z)|\Z", re.I) for t in RAW}


class Node:
    __slots__ = ("tag", "label", "noise", "doubt", "holds", "children")

    def __init__(self, tag: str, label: str, noise: bool, doubt: bool = False):
        self.tag, self.label, self.noise, self.doubt, self.children = tag, label, noise, doubt, []
        self.holds = False       # an article or main element stands below


class Aside(str):
    """Text of a doubtful inline element: part of the block, not of its key."""


def words_of(value: str) -> set[str]:
    return set(re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()))


def element(tag: str, rest: str) -> Node:
    label, noise, doubt = tag, tag in NOT_TEXT, False
    if rest and "=" in rest:
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(rest)}
        names = [found[k] for k in ("class", "id") if found.get(k)]
        if names:
            label += "." + re.sub(r"\d+", "0", ".".join(sorted(" ".join(names).split())))
            if tag not in ("body", "html", "article", "main"):
                doubt = bool(words_of(" ".join(names)) & NOISE_WORDS)
        noise = noise or found.get("role", "").lower() in NOISE_ROLES or found.get("aria-hidden", "").lower() == "true"
        if re.search(r"display\s*:\s*none", found.get("style", ""), re.I):
            noise = True
    if rest and re.search(r"(?:^|\s)hidden(?:\s|/|$)", re.sub(r"\"[^\"]*\"|'[^']*'", "", rest)):
        noise = True
    if tag == "header":
        noise, doubt = (False, False) if label == "header" else (noise or doubt, doubt)     # decided by its place, see blocks()
    return Node(tag, label + "!" if doubt else label, noise, doubt)


def parse(page: str) -> Node:
    """The DOM as far as text needs it: elements with children, and strings."""
    root = Node("", "", False)
    stack, at, find = [root], 0, TAG.search
    depth: Counter = Counter()       # open elements by tag

    def close(i: int) -> None:
        depth.subtract(n.tag for n in stack[i:])
        del stack[i:]

    while True:
        m = find(page, at)
        if m is None:
            if at < len(page):
                stack[-1].children.append(page[at:])
            return root
        if m.start() > at:
            stack[-1].children.append(page[at:m.start()])
        at = m.end()
        tag = m[2]
        if not tag:
            continue
        tag = tag.lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1) if depth[tag] else ():
                if stack[i].tag == tag:
                    close(i)
                    break
                if stack[i].tag in ("article", "main", "body", "html") and tag in INLINE:
                    break
            continue
        if tag in RAW:
            stack[-1].children.append(Node(tag, tag, True))
            at = RAW_END[tag].search(page, at).end() if not m[3].rstrip().endswith("/") or tag in ("script", "style") else at
            continue
        node = element(tag, m[3])
        if tag in CLOSES:
            for i in range(len(stack) - 1, 0, -1) if any(depth[t] for t in CLOSES[tag]) else ():
                if stack[i].tag in ("ul", "ol", "dl", "table", "select", "menu", "nav"):
                    break
                if stack[i].tag in CLOSES[tag]:
                    close(i)
                    break
        elif tag not in INLINE and tag not in VOID:
            # a block ends an open paragraph, and what was left open inside it
            for i in range(len(stack) - 1, 0, -1) if depth["p"] else ():
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag not in INLINE:
                    break
        stack[-1].children.append(node)
        if tag in ("article", "main") and not node.noise:
            for above in reversed(stack):
                if above.holds:
                    break
                above.holds = True
        if tag not in VOID and not m[3].endswith("/"):
            stack.append(node)
            depth[tag] += 1


def clean(text: str) -> str:
    return " ".join(entities.unescape(text).split()) if "&" in text else " ".join(text.split())


class Site:
    """What a site's tree decides: branches to cut, the importance of doubtful
    ones, and the keys of repeated blocks.  ``None`` in its place keeps everything."""
    __slots__ = ("cut", "doubt", "repeated", "threshold", "declared")

    def __init__(self, cut=(), doubt=None, repeated=(), threshold: float = THRESHOLD):
        self.cut, self.doubt, self.repeated, self.threshold = cut, doubt or {}, repeated, threshold
        self.declared = False

    def drops(self, node: Node, path: str, in_article: bool) -> bool:
        if path in self.cut:
            return True
        if not node.doubt or node.holds or path not in self.doubt:
            return False
        return self.doubt[path] * (INSIDE if in_article or not self.declared else BESIDE) < self.threshold


class Frame:
    """An element whose children are being visited; ``after`` runs behind the last."""
    __slots__ = ("children", "path", "depth", "in_article", "styles", "open_text", "labels", "after")

    def __init__(self, node, path, depth, in_article, styles, open_text, after=None):
        self.children, self.path, self.depth, self.in_article = iter(node.children), path, depth, in_article
        self.styles, self.open_text, self.labels, self.after = styles, open_text, [], after


def below(frame: Frame, label: str) -> str:
    path = frame.path if frame.depth <= DEPTH else frame.path.rsplit(">", 1)[0]
    return f"{path}>{label}"


def blocks(root: Node, site: Site | None, out: list[tuple[str, str, str, bool]], styles: list | None) -> None:
    """Text blocks (path, key text, text, in an article) of a page in page order,
    without noise and without what the site drops; ``styles`` collects (path,
    children's labels).  Elements may be nested to any depth."""
    frames = [Frame(root, "", 0, False, styles, [])]
    done = object()
    while frames:
        f = frames[-1]
        child = next(f.children, done)
        if child is done:
            frames.pop()
            if f.styles is not None:
                collapsed = [x for i, x in enumerate(f.labels) if not i or x != f.labels[i - 1]]
                f.styles.append((f.path, ",".join(collapsed)))
            if f.after is not None:
                f.after()
            continue
        if isinstance(child, str):
            f.open_text.append(child)
            continue
        f.labels.append(child.label)
        if child.tag in INLINE:
            if child.noise:
                continue
            if not child.doubt:
                frames.append(Frame(child, f.path, f.depth, f.in_article, None, f.open_text))
                continue
            path, inner = below(f, child.label), []
            if site is None:         # in the tree: a node of its own
                if f.styles is not None:
                    f.styles.append((path, ""))
                frames.append(Frame(child, path, f.depth + 1, f.in_article, None, inner, partial(flush, path, inner, f.in_article, site, out)))
            elif not site.drops(child, path, f.in_article):
                frames.append(Frame(child, path, f.depth + 1, f.in_article, None, inner, partial(aside, inner, f.open_text)))
            continue
        flush(f.path, f.open_text, f.in_article, site, out)
        if child.noise or child.tag == "header" and not f.in_article:
            continue
        path = below(f, child.label)
        if site is not None and site.drops(child, path, f.in_article):
            continue
        inside = f.in_article or child.tag in ("article", "main")
        frames.append(Frame(child, path, f.depth + 1, inside, f.styles, f.open_text, partial(flush, path, f.open_text, inside, site, out)))
    flush("", f.open_text, False, site, out)


def aside(inner: list[str], open_text: list[str]) -> None:
    open_text.extend(map(Aside, inner))


def flush(path: str, open_text: list[str], in_article: bool, site: Site | None, out: list[tuple[str, str, str, bool]]) -> None:
    if open_text:
        text = clean("".join(open_text))
        own = clean("".join(t for t in open_text if type(t) is str)) if any(type(t) is Aside for t in open_text) else text
        open_text.clear()
        if text and not (site is not None and site.repeated and own and hashed(f"{path}\n{own}") in site.repeated):
            out.append((path, own, text, in_article))


def protected(path: Column) -> Column:
    """Plain prose blocks of a declared article, and what such blocks stand in:
    their content decides block by block, see extract_pages()."""
    tags = F.split(path, ">")
    article = F.transform(tags, lambda t: F.substring_index(t, ".", 1).isin("article", "main"))
    # what stands behind the last article or main element
    rest = F.slice(tags, F.size(tags) - F.array_position(F.reverse(article), True).cast("int") + 2, F.size(tags))
    return F.element_at(tags, -1).isin("", "html", "body") | F.exists(article, lambda x: x) & F.forall(rest, lambda t: t.isin(*sorted(PROSE)))


def extract(page: str, cut=(), doubt=None, repeated=(), threshold: float = THRESHOLD) -> str:
    """The main text of a page of a site with this tree."""
    out: list[tuple[str, str, str, bool]] = []
    root = parse(page)
    site = Site(cut, doubt, repeated, threshold)
    site.declared = root.holds
    blocks(root, site, out, None)
    return " ".join(t for _, _, t, _ in out)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def hashed(text: str) -> int:
    v = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return v - (1 << 64) if v >> 63 else v


def feature_rows(batches):
    """The rows of ``page_features`` from batches (host, html) of one task.  ``PAGES``
    pages at a time become strings and rows: a task holds no batch of them."""
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64()]
    for b in batches:
        for part in (b.slice(at, PAGES) for at in range(0, b.num_rows, PAGES)):
            rows: set = set()
            for host, page in zip(part.column(0).to_pylist(), texts(part.column(1))):
                out: list[tuple[str, str, str, bool]] = []
                styles: list[tuple[str, str]] = []
                blocks(parse(page), None, out, styles)
                key = hashed("\n".join(t for _, _, t, inside in out if inside) or "\n".join(t for _, _, t, _ in out))
                rows.update((host, key, p, 0, hashed(s)) for p, s in styles)
                rows.update((host, key, p, 1, hashed(f"{p}\n{t}")) for p, t, _, _ in out)
                rows.update((host, key, p, 2, 0) for p in {p for p, _ in styles} | {x[0] for x in out})
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["host", "page", "path", "kind", "feature"])


def page_features(pages: DataFrame) -> DataFrame:
    """(host, page, path, kind, feature): what each page puts at each path, its
    noise left out.  kind 0: presentation style, 1: content block, 2: the page
    has the path."""
    return pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string").alias("html")).mapInArrow(
        feature_rows, "host string, page long, path string, kind int, feature long")


def counted(pages: DataFrame) -> DataFrame:
    """(host, path, kind, feature, total, c): c pages of a host put a feature at a
    path; the features of one page only are one row, of feature null, c = 1 and
    their number as total."""
    seen = page_features(pages).distinct()
    counts = seen.groupBy("host", "path", "kind", "feature").agg(F.count("*").alias("c"))
    single = F.col("c") == 1
    return stored(counts.groupBy("host", "path", "kind", F.when(~single, F.col("feature")).alias("feature"), single.alias("single"))
                  .agg(F.sum("c").alias("total"), F.max("c").alias("c")).drop("single"), "site-counts")


def importance(pages: DataFrame) -> DataFrame:
    """(host, path, n_pages, importance, diversity, holds_text): each node of
    each site's tree with the largest importance in its branch, and the largest
    without the repeated blocks."""
    return tree_of(weighed(counted(pages)))


def weighed(counts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``counts`` with the pages of each path (n_pages) and whether a content is
    repeated on so many of them that it is not important by itself."""
    sizes = counts.where("kind = 2").select(F.col("host").alias("h"), F.col("path").alias("p"), F.col("total").alias("n_pages"))
    joined = counts.join(sizes, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p"))).drop("h", "p")
    alone = (F.col("kind") == 1) & (F.col("c") > 1) & (1 - F.log("c") / F.log("n_pages") < threshold)
    return joined.withColumn("repeated", F.coalesce(alone, F.lit(False)))


def tree_of(contents: DataFrame) -> DataFrame:
    c = F.col("c").cast("double")

    def entropy(which: Column) -> Column:
        total, clc = F.sum(F.when(which, F.col("total"))), F.sum(F.when(which, F.when(c > 1, c * F.log(c)).otherwise(0.0)))
        return F.when(total > 0, F.when(F.max("n_pages") > 1, 1 - clc / (total * F.log(F.max("n_pages")))).otherwise(1.0))

    # text decides where there is any: a template may vary around equal text
    text = F.col("kind") == 1
    per_path = contents.groupBy("host", "path").agg(
        F.max("n_pages").alias("n_pages"), F.coalesce(entropy(text), F.lit(0.0)).alias("own"),
        F.coalesce(entropy(text & ~F.col("repeated")), F.lit(0.0)).alias("rest"), F.max(text).alias("has_text"))
    steps = F.split("path", ">")
    up = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.array_join(F.slice(steps, 1, i), ">"))
    above = per_path.select("host", F.explode(up).alias("path"), "own", "rest", "n_pages", "has_text", F.col("path").alias("from"))
    return above.groupBy("host", "path").agg(F.max(F.when(F.col("path") == F.col("from"), F.col("n_pages"))).alias("n_pages"),
                                             F.max("own").alias("importance"), F.max("rest").alias("diversity"), F.max("has_text").alias("holds_text"))


def main_texts(batches, threshold: float = THRESHOLD):
    """(page_id, url, text, n_chars) of batches (page_id, url, html, host, cut, doubt,
    repeated), ``PAGES`` pages at a time."""
    for b in batches:
        sites: dict = {}             # each site's sets once a batch
        for part in (b.slice(at, PAGES) for at in range(0, b.num_rows, PAGES)):
            found = []
            for i, (host, page) in enumerate(zip(part.column(3).to_pylist(), texts(part.column(2)))):
                if host not in sites:
                    cut, doubt, repeated = (part.column(k)[i].as_py() or () for k in (4, 5, 6))
                    sites[host] = frozenset(cut), {d["path"]: d["value"] for d in doubt}, frozenset(repeated)
                found.append(extract(page, *sites[host], threshold))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.string()),
                                              pa.array(map(len, found), pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame, threshold: float = THRESHOLD, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) for every page."""
    cuts = stored(decisions(pages, threshold, least_pages), "site-cuts")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("host"))
    rows = rows.join(cuts, F.col("host") == F.col("site"), "left").select("page_id", "url", "html", "host", "cut", "doubt", "repeated")

    def run(batches):
        yield from main_texts(batches, threshold)

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def decisions(pages: DataFrame, threshold: float = THRESHOLD, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(site, cut, doubt, repeated): what each site's tree decides, see ``Site``."""
    contents = weighed(counted(pages), threshold)
    tree = tree_of(contents)
    told = F.col("n_pages") >= least_pages
    doubtful = F.col("path").endswith("!")
    # unique blocks among many repeated ones: those go alone, the branch stays
    dull = told & F.col("holds_text") & (F.greatest("importance", "diversity") < threshold) & ~protected(F.col("path"))
    value = F.when(told, F.col("diversity")).otherwise(F.lit(UNKNOWN))
    none = F.lit(None)
    doubt_type = "struct<path:string,value:double>"
    rows = tree.where(dull | doubtful).select(
        "host", F.when(dull, F.col("path")).alias("cut"),
        F.when(doubtful, F.struct("path", value.alias("value"))).cast(doubt_type).alias("doubt"), none.cast("long").alias("repeated"))
    rows = rows.unionByName(contents.where(F.col("repeated") & told).select(
        "host", none.cast("string").alias("cut"), none.cast(doubt_type).alias("doubt"), F.col("feature").alias("repeated")))
    return rows.groupBy(F.col("host").alias("site")).agg(*[F.sort_array(F.collect_set(k)).alias(k) for k in ("cut", "doubt", "repeated")])

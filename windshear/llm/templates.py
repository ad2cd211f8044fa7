"""Main text of web pages by site template removal.

1. Each page is parsed leniently into elements; every element with text or
   a class gets a hash over its tag, class and content, bottom up.
2. Pages of a host with the same main text are one content, so copies of an article
   count once. Spark counts, per host, in how many contents each hash occurs.
3. A subtree that recurs in many contents of its host is a candidate: in half of them
   (at least ``LEAST_PAGES``) or in ``SHARE`` of them (at least ``MAIN_LEAST_PAGES``); inside the main element
   only from ``MAIN_SHARE``, at least ``MAIN_LEAST_PAGES``, as articles of one host may rightly quote the same
   paragraph. It is template, and deleted, if it is as frequent among the contents that stay articles
   of their own: those that keep ``OWN`` of their text (``MAIN_OWN`` inside main elements) without all
   candidates. Near copies of an article keep only what differs, so they prove no template.
4. Elements that name their own role go without counting, as hosts with few
   pages have no statistics: menus, page headers, footers, sidebars, forms,
   scripts, styles by their tag or role, and elements with one of a few exact names (``OUTSIDE``; inside
   main elements ``INSIDE``) as a whole word of class or id. Main elements and those that hold one are never judged
   by a name.
5. What is left of the main elements (``article``, ``main``; the body where there is none)
   is cut to blocks at block elements; character references are decoded, white
   space inside a block becomes one space, blocks are joined by a blank line.

The template table, (host, hash) pairs, is broadcast if it was counted at ``BROADCAST_PAIRS`` or
less; else each page's template hashes are joined to it and back to the page.

Defined cases: null and empty html give an empty text; a null url, or one
without host, belongs to the host ""; markup cut off at the end of a page is
dropped; repeated rows count once and are all returned; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windshear.llm.common import map_rows, share, small_enough, stored

SHARE, LEAST_PAGES = 0.1, 3
MAIN_SHARE, MAIN_LEAST_PAGES = 0.5, 20
OWN, MAIN_OWN = 0.25, 0.5
BROADCAST_PAIRS = 200_000

# Element names of HTML by how their content is treated.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
DROPPED = RAW | frozenset("head nav footer aside form select button dialog svg math canvas object audio video menu".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary "
                  "table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("body caption dd dt head html legend li tbody td tfoot th thead tr".split())
# An opening element ends an open one of these, up to the given container.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}
# Roles, and whole names in class or id, of parts that are no article text wherever they stand, and
# of parts that are none outside main elements.
ROLES = frozenset("alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
INSIDE = frozenset("ad ads advert advertisement adverts breadcrumb breadcrumbs comment-form comment-list comment-respond comments comments-area "
                   "cookie-banner cookie-notice disqus_thread menu nav navbar newsletter-signup pagination share-buttons sharedaddy sidebar "
                   "social-share sponsored".split())
OUTSIDE = INSIDE | frozenset("alert banner comment consent cookie cookies footer gdpr masthead navigation newsletter notice popup promo related "
                             "respond share sharing social subscribe toolbar widget".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


class Element:
    __slots__ = ("tag", "marks", "role", "children", "digest", "hasher", "holds")

    def __init__(self, tag: str, marks: str, role: str = ""):
        self.tag, self.marks, self.role, self.children, self.digest = tag, marks, role, [], 0
        self.holds = False  # whether a main element is below
        self.hasher = hashlib.blake2b(f"{tag}|{marks}".encode(), digest_size=8)

    def add(self, child) -> None:
        self.children.append(child)

    def close(self) -> None:
        for c in self.children:
            self.hasher.update(c.digest.to_bytes(8, "little", signed=True) if isinstance(c, Element)
                               else " ".join(c.split()).encode("utf-8", "surrogatepass"))
            self.holds = self.holds or isinstance(c, Element) and (c.holds or _is_main(c))
        self.digest = int.from_bytes(self.hasher.digest(), "little", signed=True)
        self.hasher = None


def parse(page: str | None) -> Element:
    """The element tree; unclosed elements end with their parent."""
    root = Element("html", "")
    stack, at, text = [root], 0, page or ""

    def pop() -> None:
        done = stack.pop()
        done.close()

    while True:
        m = _TOKEN.search(text, at)
        if m is None:
            if at < len(text):
                stack[-1].add(entities.unescape(text[at:]))
            break
        if m.start() > at:
            stack[-1].add(entities.unescape(text[at:m.start()]))
        at = m.end()
        if m.group(2) is None or not m.group().endswith(">"):
            continue
        tag = m.group(2).lower()
        if m.group(1):
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            # An end tag closes what is open inside its element, but an inline one no block.
            if depth and (tag in BLOCK or not any(e.tag in BLOCK for e in stack[depth + 1:])):
                while len(stack) > depth:
                    pop()
            continue
        if tag in ("html", "body") and len(stack) == 1 and tag == "html":
            continue
        named = [(a.group(1).lower(), v) for a in _ATTR.finditer(m.group(3)) for v in a.groups()[1:] if v]
        marks, role = " ".join(v for _, v in named), next((v.strip().lower() for k, v in named if k == "role"), "")
        if tag in CLOSES_P:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == "p"), 0)
            if depth and not any(e.tag in BLOCK for e in stack[depth + 1:]):
                while len(stack) > depth:
                    pop()
        if tag in CLOSES:
            ends, stop = CLOSES[tag]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ends:
                    while len(stack) > i:
                        pop()
                    break
                if stack[i].tag in stop:
                    break
        new = Element(tag, marks, role)
        stack[-1].add(new)
        if tag in VOID or m.group(3).endswith("/"):
            new.close()
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(text, at)
            new.add(text[at:end.start() if end else len(text)])
            new.close()
            at = end.end() if end else len(text)
            continue
        stack.append(new)
    while stack:
        pop()
    return root


def _aside(e: Element, in_main: bool) -> bool:
    """Whether an element names itself as no article text. Names of main elements, and of elements
    that hold one, say nothing."""
    if e.tag in DROPPED or (e.tag == "header" and not in_main):
        return True
    return not e.holds and not _is_main(e) and _named(e, in_main)


def _named(e: Element, in_main: bool) -> bool:
    return bool(e.marks) and e.tag not in ("html", "body") and (
        e.role in ROLES or not (INSIDE if in_main else OUTSIDE).isdisjoint(e.marks.lower().split()))


def _is_main(e: Element) -> bool:
    return e.tag in ("article", "main") or (bool(e.marks) and "main" in e.marks.split() and e.tag in ("div", "section"))


def subtrees(root: Element):
    """``(digest, in main)`` of the elements that may be template: blocks and marked ones with content."""
    return ((d, inside) for d, inside, _ in sized_subtrees(root))


def sized_subtrees(root: Element) -> list[tuple[int, bool, int]]:
    """``(digest, in main, characters)`` per element that may be template: the
    characters of its text that no smaller such element holds and no role drops."""
    top = [root.digest, False, 0]  # text of the body itself
    found, todo = [], [(root, False, False, top)]
    while todo:
        e, inside, gone, holder = todo.pop()
        for c in e.children:
            if not isinstance(c, Element):
                if not gone:
                    holder[2] += len("".join(c.split()))
            elif c.tag not in RAW:
                here, own = inside or _is_main(c), holder
                if (c.tag in BLOCK or c.marks) and c.children and c.tag not in ("body", "head"):
                    own = [c.digest, here, 0]
                    found.append(own)
                todo.append((c, here, gone or _aside(c, inside), own))
    return [tuple(x) for x in ([top] if top[2] else []) + found]


def main_text(root: Element, template, main_template) -> str:
    """The blocks of the main elements without template subtrees, in page order."""
    found = []
    todo = [(root, False)]
    while todo:
        e, beside = todo.pop()
        if e is not root and _aside(e, False):
            continue
        if e is not root and _is_main(e):
            found.append((e, beside))
            continue
        beside = beside or _named(e, False)
        todo.extend((c, beside) for c in reversed(e.children) if isinstance(c, Element))
    # Main elements in parts beside the article are teasers, unless there are no others.
    mains = [e for e, beside in found if not beside] or [e for e, _ in found]
    blocks, line = [], []

    def flush() -> None:
        block = " ".join("".join(line).split())
        if block:
            blocks.append(block)
        line.clear()

    for top in mains or [root]:
        inside = bool(mains)
        work = [(top, False)]
        while work:
            e, closing = work.pop()
            if isinstance(e, str):
                line.append(e)
                continue
            if closing:
                flush()
                continue
            if e is not top and (_aside(e, inside) or e.digest in (main_template if inside else template)):
                flush()
                continue
            if e.tag in BLOCK:
                flush()
                work.append((e, True))
            elif e.tag == "br":
                line.append(" ")
            work.extend((c, False) for c in reversed(e.children))
        flush()
    return "\n\n".join(blocks)


def _host(url):
    # The part between "//" and the next "/", "?" or "#", without user and port, lower-case.
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def contents(pages: DataFrame) -> DataFrame:
    """``(host, content, subs, bare)``: the distinct main texts of each host with the subtrees of one of
    their pages (the same one in each run); ``bare`` if that page has no text in a main element."""
    def run(cols):
        seen = {}
        for host, page in zip(cols["host"], cols["html"]):
            root = parse(page)
            text = hashlib.blake2b(main_text(root, (), ()).encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
            subs = sorted(_merged(sized_subtrees(root)))
            seen[host, text] = max(subs, seen.get((host, text), subs))
        return {"host": [k[0] for k in seen], "content": [k[1] for k in seen], "subs": list(seen.values())}

    rows = pages.select(_host(F.col("url")).alias("host"), "html")
    schema = "host string, content string, subs array<struct<digest:long,inner:boolean,chars:long>>"
    return (map_rows(rows, run, schema, ["host", "html"], chunk=2048).groupBy("host", "content").agg(F.max("subs").alias("subs"))
            .withColumn("bare", ~F.exists("subs", lambda x: x["inner"] & (x["chars"] > 0))))


def _merged(subs) -> list[tuple[int, bool, int]]:
    # A subtree that stands several times on a page counts once, with the text of all.
    chars = Counter()
    for d, inside, n in subs:
        chars[d, inside] += n
    return [(d, inside, n) for (d, inside), n in chars.items()]


def template_table(pages: DataFrame, share_: float = SHARE, least: int = LEAST_PAGES) -> DataFrame:
    """``(host, digest, inner)``: recurring subtrees; ``inner`` if also deleted inside main elements."""
    known = stored(contents(pages), "contents")
    key = ["host", "digest", "inner"]

    def frequent(subs: DataFrame, hosts: DataFrame) -> DataFrame:
        n, total = F.col("n"), F.col("pages")
        inner = n >= F.greatest(F.lit(float(MAIN_LEAST_PAGES)), MAIN_SHARE * total)
        outer = ((n >= least) & (n >= MAIN_SHARE * total)) | (n >= F.greatest(F.lit(float(MAIN_LEAST_PAGES)), share_ * total))
        counts = subs.groupBy(*key).agg(F.count("*").alias("n")).where("n >= 2")
        return counts.join(hosts, "host").where(F.when(F.col("inner"), inner).otherwise(outer)).select(*key)

    def per_host(rows: DataFrame) -> DataFrame:
        return rows.groupBy("host").agg(F.count("*").alias("pages"))

    each = known.select("host", "content", "bare", F.explode("subs").alias("x")).select("host", "content", "bare", "x.*")
    candidates = stored(frequent(each, per_host(known)), "candidates")
    marked = candidates.withColumn("candidate", F.lit(True))
    if small_enough(candidates):
        marked = F.broadcast(marked)
    # Only text that can be returned counts: of main elements, or of all where there is none.
    shown = each.where(F.col("inner") | F.col("bare")).where("chars > 0")
    kept = F.sum(F.when(F.col("candidate").isNull(), F.col("chars")).otherwise(0))
    own = (shown.join(marked, key, "left").groupBy("host", "content", "bare").agg(kept.alias("kept"), F.sum("chars").alias("chars"))
           .where(F.col("kept") >= F.when(F.col("bare"), OWN).otherwise(MAIN_OWN) * F.col("chars")).select("host", "content"))
    articles = stored(known.join(own, ["host", "content"]), "articles")
    subs = articles.select("host", F.explode("subs").alias("x")).select("host", "x.*")
    return frequent(subs, per_host(articles)).join(candidates, key, "left_semi")


EXTRACTED = "page_id long, url string, text string, n_chars long"


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` per row of ``pages(page_id, url, html)``."""
    table = stored(template_table(pages), "templates")
    rows = pages.select("page_id", "url", "html", _host(F.col("url")).alias("host"))
    pairs = table.limit(BROADCAST_PAIRS + 1).collect()
    if len(pairs) <= BROADCAST_PAIRS:
        by: dict[str, tuple[set, set]] = {}
        for r in pairs:
            by.setdefault(r["host"], (set(), set()))[r["inner"]].add(r["digest"])
        get = share(pages.sparkSession, by)
        known = lambda host, _: get().get(host, ((), ()))
        return _texts(rows, known, ["page_id", "url", "html", "host"])

    def hashes(cols):
        out = {"k": [], "host": [], "digest": [], "inner": []}
        for k, host, page in zip(cols["k"], cols["host"], cols["html"]):
            for d, i in set(subtrees(parse(page))):
                out["k"].append(k)
                out["host"].append(host)
                out["digest"].append(d)
                out["inner"].append(i)
        return out

    keyed = rows.withColumn("k", F.xxhash64("url", "html"))
    own = (map_rows(keyed.dropDuplicates(["k"]), hashes, "k long, host string, digest long, inner boolean", ["k", "host", "html"])
           .join(table, ["host", "digest", "inner"]).groupBy("k")
           .agg(F.collect_set(F.when(~F.col("inner"), F.col("digest"))).alias("outer"),
                F.collect_set(F.when(F.col("inner"), F.col("digest"))).alias("inner")))
    return _texts(keyed.join(own, "k", "left"), lambda _, lists: lists, ["page_id", "url", "html", "host", "outer", "inner"])


def _texts(rows: DataFrame, known, inputs: list[str]) -> DataFrame:
    def run(cols):
        lists = zip(cols["outer"], cols["inner"]) if "outer" in cols else ((None, None) for _ in cols["host"])
        texts = []
        for host, page, (outer, inner) in zip(cols["host"], cols["html"], lists):
            a, b = known(host, (set(outer or ()), set(inner or ())))
            texts.append(main_text(parse(page), a, b) if page else "")
        return {"page_id": cols["page_id"], "url": cols["url"], "text": texts, "n_chars": [len(t) for t in texts]}

    return map_rows(rows, run, EXTRACTED, inputs)

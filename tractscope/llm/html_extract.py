"""Main text of web pages by scoring the tree of blocks.

Each paragraph earns points for its length and commas and passes them to its ancestors, less
the farther up. A container's points are discounted by the share of its text that lies in
links. The container with most points is the article; siblings that look like parts of it
are kept with it, and so are headings, short texts and lists between and next to them.
Menus, headers, footers, sidebars, notices, adverts, forms and reader comments are recognised
by element, role or the words of class and id, and take no part.
Words and forms are only a suspicion: a suspect that holds the page's article element, or most
of the page's points, is the page and not a part beside it.
"""

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

# Vocabulary of HTML that the extraction depends on.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body button canvas caption center dd details dialog dir "
    "div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr "
    "html legend li main menu nav noscript object ol optgroup option p pre search section "
    "select summary svg table tbody td template tfoot th thead tr ul video audio".split()
)
CLOSES_P = BLOCKS - frozenset("button noscript object option select svg template".split())
# An element of the first kind ends an open one of the second, up to the third.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
# What is never part of an article, and what is so if the page lies outside it.
UNWANTED = frozenset(
    "head nav footer aside button select fieldset dialog menu noscript template svg object "
    "canvas video audio search".split()
)
UNWANTED_ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog menu "
    "menubar toolbar".split()
)
FORM = frozenset({"form"})
# Words of class and id names. Names are split at everything but letters and where an
# upper-case letter follows a lower-case one.
UNWANTED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo "
    "promotion promoted sidebar aside comment comments commentlist disqus respond reply replies "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "newsletter subscribe subscription signup share sharing social related recommended "
    "breadcrumb breadcrumbs menu menus nav navbar navigation pagination pager footer masthead "
    "topbar toolbar widget login paywall copyright skip".split()
)
HEADER_WORDS = frozenset({"header"})
# Words that name subjects as well. Joined to a word of its own ("related-work") such a name
# says little, and what the part holds decides; joined to words of layout it stays a suspicion.
AMBIGUOUS_WORDS = frozenset(
    "social related recommended share sharing copyright notice notices alert promotion "
    "subscription navigation".split()
)
LAYOUT_WORDS = frozenset(
    "area articles bar block bottom box button buttons column container content desktop element "
    "group icon icons inner item items layer left link links list main message mobile more news "
    "outer page panel post posts right row section site slot stories text title top wrap wrapper".split()
)
# Reader comments and notices are often longer than the article, so most points do not tell
# them from it.
COMMENT_WORDS = frozenset(
    "comment comments commentlist disqus respond reply replies cookie cookies consent gdpr popup "
    "modal overlay newsletter paywall login".split()
)
ARTICLE_TAGS = frozenset({"article", "main"})
PARAGRAPHS = frozenset("p pre td blockquote li dd div section article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
# What belongs to a text it stands next to, however short it is.
ADJOINING = HEADINGS | frozenset("p pre blockquote ul ol dl table figure".split())
WHOLE_PAGE = frozenset("#root html body".split())
TAG_POINTS = {"article": 10.0, "main": 10.0, "section": 2.0, "div": 2.0}
LEVELS = 5
SIBLING_POINTS, SIBLING_SHARE, SIBLING_CHARS, SIBLING_LINKS = 10.0, 0.2, 80, 0.25
LIST_LINKS, LIST_COUNT = 0.8, 3
# Shares of the page's points for an article element, and of the largest such for others of
# its kind, to be more than a teaser.
ARTICLE_SHARE, PEER_SHARE = 0.2, 0.5

# A quote opens a quoted value only where a value begins; elsewhere it is a character like any
# other, and the tag ends at the next '>'.
_NAME = r"[^ \t\n\f\r/>][^ \t\n\f\r/>=]*+"
_EQUALS = r"[ \t\n\f\r]*+=[ \t\n\f\r]*+"
_VALUE = r"(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])[^ \t\n\f\r>]*+)"
_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<(/?)([a-zA-Z][^\s/>]*+)"
    rf"((?:[ \t\n\f\r/]++|{_NAME}(?:{_EQUALS}{_VALUE}|(?!{_EQUALS})))*+)>"
    r"|<[!?/](?:[^>]*+>|[^>]*\Z)"
    r"|<[a-zA-Z].*\Z",
    re.S,
)
_ATTRIBUTE = re.compile(rf"({_NAME})(?:{_EQUALS}({_VALUE}))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_LAYOUT = re.compile(r"(has|no|with|without|is)[-_]", re.I)
_COMMAS = re.compile("[,،，、;]")


class Node:
    __slots__ = (
        "tag", "parent", "children", "wanted", "blame", "links", "chars", "link_chars", "points",
        "own", "own_links", "own_points", "held", "solid", "pool", "in_article", "vague",
        "all", "all_links",
    )

    def __init__(self, tag, parent, wanted, blame=frozenset(), vague=False):
        self.tag, self.parent, self.wanted, self.blame = tag, parent, wanted, blame
        # Whether the node's content is inside an article element; whether its name is vague.
        self.in_article = tag in ARTICLE_TAGS or parent is not None and parent.in_article
        self.vague = vague
        self.children, self.links = [], 0
        self.chars = self.link_chars = 0
        self.points = 0.0

    @property
    def suspect(self):
        return bool(self.blame) and self.tag not in ARTICLE_TAGS


def _judge(tag, attributes, in_article):
    """Whether a node can be wanted, the words (or ``form``) that speak against it, and whether
    they are all parts of vague names."""
    nothing = frozenset()
    if tag in UNWANTED or tag == "header" and not in_article:
        return False, nothing, False
    blame = FORM if tag == "form" else nothing
    if not attributes or tag in ("html", "body"):
        return True, blame, False
    found = {}
    for name, value in _ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), value[1:-1] if value[:1] in ("'", '"') else value)
    if "hidden" in found or found.get("aria-hidden") == "true":
        return False, nothing, False
    if re.search(r"display\s*:\s*none", found.get("style", "")):
        return False, nothing, False
    role = found.get("role", "").lower()
    if role in UNWANTED_ROLES:
        return False, nothing, False
    if tag in HEADINGS:  # a heading goes with the part it stands in
        return True, nothing, False
    names = (found.get("class", "") + " " + found.get("id", "")).split()
    # "has-sidebar" and "no-comments" tell of a page's layout, not of this element.
    names = [name for name in names if not _LAYOUT.match(name)]
    each = [{word.lower() for word in _WORDS.findall(name)} for name in names]
    accused = [words for words in each if words & UNWANTED_WORDS]
    blame = blame.union(*(words & UNWANTED_WORDS for words in accused))
    if role == "form":
        blame |= FORM
    if not in_article:
        blame = blame.union(*(words & HEADER_WORDS for words in each))
    vague = blame <= AMBIGUOUS_WORDS and all(words - UNWANTED_WORDS - LAYOUT_WORDS for words in accused)
    return True, blame, vague


def parse(source: str) -> Node:
    """Tree of blocks. Children are nodes, or (text, characters in links) runs."""
    root = Node("#root", None, True)
    stack = [root]
    buffer, link_chars, in_link = [], 0, False
    at, end = 0, len(source)
    # How many elements of a tag are open, so that the stack is searched only for one that is.
    opened = Counter()

    def flush():
        nonlocal link_chars
        if buffer:
            text = " ".join("".join(buffer).split())
            if text:
                stack[-1].children.append((text, min(link_chars, len(text))))
            buffer.clear()
        link_chars = 0

    def add(text):
        nonlocal link_chars
        if "&" in text:
            text = html.unescape(text)
        buffer.append(text)
        if in_link:
            link_chars += len(text.strip())

    def close_to(depth):
        nonlocal in_link
        flush()
        in_link = False
        opened.subtract(node.tag for node in stack[depth:])
        del stack[depth:]

    while at < end:
        token = _TOKEN.search(source, at)
        if token is None:
            add(source[at:])
            break
        if token.start() > at:
            add(source[at : token.start()])
        at = token.end()
        if token[2] is None:
            continue
        tag = token[2].lower()
        if token[1]:
            if tag == "a":
                in_link = False
            elif tag in BLOCKS:
                if not opened[tag]:
                    flush()
                    continue
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag == tag:
                        close_to(depth)
                        break
            continue
        if tag in RAW:
            found = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(source, at)
            at = found.end() if found else end
            if tag not in ("title",):
                buffer.append(" ")
            continue
        if tag == "br":
            buffer.append(" ")
        elif tag == "a":
            in_link = True
            stack[-1].links += 1
        elif tag in BLOCKS:
            flush()
            if tag in CLOSES_P and opened["p"]:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag == "p":
                        close_to(depth)
                        break
                    if stack[depth].tag in ("button", "td", "th", "caption", "object"):
                        break
            if tag in ENDS and any(opened[other] for other in ENDS[tag][0]):
                ended, within = ENDS[tag]
                lowest = None
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag in within:
                        break
                    if stack[depth].tag in ended:
                        lowest = depth
                if lowest is not None:
                    close_to(lowest)
            if tag in VOID:
                continue
            if tag in ("html", "body") and opened[tag]:
                continue
            if tag == "body" and opened["head"]:  # ends an open head
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag == "head":
                        close_to(depth)
                        break
            parent = stack[-1]
            wanted, blame, vague = _judge(tag, token[3], parent.in_article)
            node = Node(tag, parent, parent.wanted and wanted, blame, vague)
            parent.children.append(node)
            if not token[3].endswith("/") or tag != "svg":
                stack.append(node)
                opened[tag] += 1
    flush()
    return root


def _in_order(root):
    """Wanted nodes below ``root``, parents first."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(c for c in reversed(node.children) if isinstance(c, Node) and c.wanted)
    return out


def _density(node):
    return node.link_chars / node.chars if node.chars else 0.0


def _weigh(nodes):
    """The texts right inside each node, and the points they earn."""
    for node in nodes:
        own = own_links = commas = 0
        for child in node.children:
            if not isinstance(child, Node):
                own += len(child[0])
                own_links += child[1]
                commas += len(_COMMAS.findall(child[0]))
        node.own, node.own_links, node.own_points = own, own_links, 0.0
        if own and node.tag in PARAGRAPHS:
            points = 1.0 + commas + min(own / 100.0, 3.0)
            node.own_points = points * (1.0 - own_links / own)


def _prune(root):
    """Settle which suspects are unwanted, by what the nodes hold.

    A suspect is kept if it holds the page's article element, or more than half of the points
    of the page (inside an article element, of that element). Suspects of one word that lie
    side by side count together, as the text blocks of a page builder do. Comments and notices
    hold the page only if all longer texts lie in them. Without points, characters count. A
    suspect of a vague name is kept if it holds a longer text and few links.
    """
    nodes = _in_order(root)
    _weigh(nodes)
    suspects = [node for node in nodes if node.suspect]
    if not suspects:
        return
    earned = any(node.own_points for node in nodes)
    for node in nodes:
        free = node.own - node.own_links
        node.held, node.solid = node.own_points if earned else free, int(free > SIBLING_CHARS)
        node.all, node.all_links = node.own, node.own_links
    for node in reversed(nodes[1:]):
        node.parent.held += node.held
        node.parent.solid += node.solid
        node.parent.all += node.all
        node.parent.all_links += node.all_links

    main, peers = _article_elements(nodes)
    holders, main_holders = set(), set()
    _add_above(main_holders, main)
    for peer in peers:
        _add_above(holders, peer)
    for node in nodes:
        if node in peers:
            node.pool = node
        elif node is root:
            node.pool = None if peers else root
        else:
            node.pool = node.parent.pool

    def is_most(pool, held, solid, comments):
        return pool and 2 * held > pool.held and (not comments or solid == pool.solid)

    excused = set()
    for node in suspects:
        comments = bool(node.blame & COMMENT_WORDS)
        holds = node in (main_holders if comments else holders)
        text = node.vague and node.solid and node.all_links <= SIBLING_LINKS * node.all
        if text or holds or is_most(node.pool, node.held, node.solid, comments):
            excused.add(node)
    words, before = set(), -1
    while len(excused) > before:
        before = len(excused)
        sums, inside = {}, set()
        for node in nodes:
            if node.parent in inside:
                inside.add(node)
            elif node.suspect and node not in excused:
                inside.add(node)
                for word in node.blame:
                    sums.setdefault((node.pool, word), []).append(node)
        for (pool, word), some in sums.items():
            held, solid = sum(node.held for node in some), sum(node.solid for node in some)
            if is_most(pool, held, solid, word in COMMENT_WORDS):
                words.add((pool, word))
        excused.update(n for n in suspects if all((n.pool, word) in words for word in n.blame))
    for node in suspects:
        node.wanted = node in excused


def _article_elements(nodes):
    """The article or main element with most points, if it is more than a teaser, and all
    like it. One below a suspect counts half, one named like a suspect is none."""
    below, best, most = set(), None, 0.0
    found = []
    for node in nodes:
        if node.parent in below or node.parent is not None and node.parent.suspect:
            below.add(node)
        if node.tag == "main" or node.tag == "article" and not node.blame:
            found.append(node)
            points = node.held / 2 if node in below else node.held
            if points > most:
                best, most = node, points
    if best is None or best.held < ARTICLE_SHARE * nodes[0].held:
        return None, set()
    return best, {node for node in found if node.held >= PEER_SHARE * best.held}


def _add_above(nodes, node):
    """Put all that ``node`` lies in into ``nodes``."""
    while node is not None and node.parent is not None and node.parent not in nodes:
        node = node.parent
        nodes.add(node)


def _score(root):
    """Sum texts up and hand points out; returns the wanted nodes."""
    nodes = _in_order(root)
    for node in reversed(nodes):
        for child in node.children:
            if isinstance(child, Node) and child.wanted:
                node.chars += child.chars
                node.link_chars += child.link_chars
                node.links += child.links
        node.chars += node.own
        node.link_chars += node.own_links
        if node.own_points:
            # A text right inside a container counts for the container itself.
            up = node if node.tag not in ("p", "pre", "blockquote", "li", "td", "dd") else None
            up, share = (up or node.parent), 1.0
            for level in range(LEVELS):
                if up is None:
                    break
                up.points += node.own_points * share
                up, share = up.parent, share / 2 if level == 0 else share * 2 / 3
    return nodes


def _article(nodes):
    """The best container, widened to the article element it lies in."""
    best, most = None, 0.0
    for node in nodes:
        if node.points > 0 and node.tag not in ("#root", "html"):
            points = (node.points + TAG_POINTS.get(node.tag, 0.0)) * (1.0 - _density(node))
            if points > most:
                best, most = node, points
    up = best
    while up is not None:
        if up.tag in ARTICLE_TAGS:
            return up, most
        up = up.parent
    return best, most


def _blocks(node):
    """(text, whether in a list that is all links, whether it earned points) of the wanted
    blocks in page order."""
    todo, out = [(node, False, None)], []
    while todo:
        item, in_list, parent = todo.pop()
        if not isinstance(item, Node):
            out.append((item[0], in_list, parent.own_points > 0))
        elif item.wanted:
            in_list = in_list or (
                item is not node
                and item.tag in ("ul", "ol", "div", "section", "table")
                and item.links >= LIST_COUNT
                and _density(item) > LIST_LINKS
            )
            todo.extend((child, in_list, item) for child in reversed(item.children))
    return out


def _inside(best):
    """Texts of the article. If it is the whole page, lists of links before its first text are
    menus."""
    blocks = _blocks(best)
    first = 0
    if best.tag in WHOLE_PAGE:
        texts = (i for i, (_, in_list, earned) in enumerate(blocks) if earned and not in_list)
        first = next(texts, len(blocks))
    return [text for i, (text, in_list, _) in enumerate(blocks) if i >= first or not in_list]


def _beside(part):
    """Texts of a part outside the article, without lists that are all links."""
    if not isinstance(part, Node):
        return [part[0]]
    return [text for text, in_list, _ in _blocks(part) if not in_list]


def _is_part(node, best, best_points):
    """Whether a sibling of the article looks like a part of it by itself."""
    if not isinstance(node, Node) or not node.wanted or _density(node) > SIBLING_LINKS:
        return False
    if node.tag == "p":
        return node.chars > SIBLING_CHARS
    points = node.points * (1.0 - _density(node))
    share = SIBLING_SHARE * best_points
    # Beside an article element a part must have both, else either is enough.
    least = max if best.tag in ARTICLE_TAGS else min
    return points > 0 and points >= least(SIBLING_POINTS, share)


def _has_few_links(part):
    if not isinstance(part, Node):
        return part[1] <= SIBLING_LINKS * len(part[0])
    return _density(part) <= SIBLING_LINKS


def _is_heading(part):
    """Whether all text of a node is headings."""
    if not isinstance(part, Node):
        return False
    todo = [part]
    while todo:
        node = todo.pop()
        if node.tag not in HEADINGS:
            if node.own:
                return False
            todo.extend(c for c in node.children if isinstance(c, Node) and c.wanted and c.chars)
    return True


def _parts(best, best_points):
    """The article and its siblings that belong to it, in page order.

    Parts by themselves, then what lies between parts. Beside an article element that is all.
    Else also the texts that adjoin the first and the last part, and headings before the
    first, with what follows them, as far as no links come between. Headings may be links.
    """
    items = [
        item
        for item in best.parent.children
        if not isinstance(item, Node) or item.wanted and item.chars
    ]
    chosen = {
        i for i, item in enumerate(items) if item is best or _is_part(item, best, best_points)
    }
    first, last = min(chosen), max(chosen)
    if best.tag not in ARTICLE_TAGS:

        def adjoins(item):
            if isinstance(item, Node) and item.tag not in ADJOINING:
                return _is_heading(item)
            return _has_few_links(item) or isinstance(item, Node) and item.tag in HEADINGS

        while last + 1 < len(items) and adjoins(items[last + 1]) and _has_few_links(items[last + 1]):
            last += 1
        while first and adjoins(items[first - 1]):
            first -= 1
        for i in range(first - 1, -1, -1):
            if _is_heading(items[i]):
                first = i
            elif not _has_few_links(items[i]):
                break
    return [
        item
        for i, item in enumerate(items)
        if i in chosen or first <= i <= last and (_has_few_links(item) or _is_heading(item))
    ]


def _widened(best):
    """The outermost node that holds no other text than ``best``."""
    while (
        best.parent is not None
        and best.parent.tag not in WHOLE_PAGE
        and best.parent.chars == best.chars
    ):
        best = best.parent
    return best


def extract(source: str | None) -> str:
    """Main text of a page: its blocks in page order, joined by line breaks.

    White space inside a block is one space. Null, empty and text-free pages give an empty
    text. A page that ends early is read as far as it goes; a tag cut off at the end, also
    inside a quoted value that is never closed, is dropped. If nothing earned points, all wanted blocks but
    lists of links are the text.
    """
    if not source:
        return ""
    root = parse(source)
    _prune(root)
    best, points = _article(_score(root))
    if best is None:
        return "\n".join(_beside(root))
    if best.tag not in ARTICLE_TAGS:
        best = _widened(best)
    if best.parent is None or best.tag in WHOLE_PAGE:
        return "\n".join(_inside(best))
    out: list[str] = []
    for part in _parts(best, points):
        out += _inside(best) if part is best else _beside(part)
    return "\n".join(out)


def extract_text(
    pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")
) -> DataFrame:
    """``keep`` columns, ``text`` and ``n_chars`` (its code points) of every whole page.

    Pages are parsed one by one, so memory follows the longest page of a task. ``keep`` may
    hold any columns but text and n_chars.
    """
    fields = [StructField("text", StringType()), StructField("n_chars", LongType())]
    schema = StructType([*pages.select(*keep).schema.fields, *fields])

    def extracted(batch):
        texts = [extract(page.as_py()) for page in batch.columns[-1]]
        counts = pa.array([len(text) for text in texts], pa.int64())
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(texts, pa.string()), counts], names=schema.names
        )

    def run(batches):
        return map(extracted, batches)

    source = pages.select(*keep, F.col(html_col).cast("string").alias("html_to_extract"))
    return source.mapInArrow(run, schema)

"""Main text of web pages by a tree-structured graphical model.

The page becomes a tree of its elements. Every node has a hidden state, content
or not; the joint probability is the root's prior, times a parent-child
potential for each edge, times the probability of each node's features given its
state (its tag group, the words of its class, id and role, the length of its
own text, the share of its text in links, its stops). Sum-product message
passing, from the leaves up and back down, gives every node its marginal
probability of being content, exactly, as the graph is a tree.

The potentials are smoothed counts over labelled pages: ``LABELLED`` holds small
hand-labelled pages (``data-y`` marks where content starts and ends) and
``composed`` puts more together from labelled parts, so the model needs no
outside data. Text under a node of a marginal of ``CUT`` or more
is kept, in page order, one line per block.

Pages are handled alone; nothing is shuffled. Scripts, styles, templates and
comments are never text. Unclosed and crossed tags are repaired the usual way
(a block ends an open paragraph, a closing tag closes what is open inside it),
and a page cut off anywhere yields what it has.

Defined results: null or empty html gives an empty text; repeated rows are
extracted each; null ids and urls pass through; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from cuenca.llm.common import slices, table

NAME = "op3_tree_extract"
SQL = None               # a graphical model; tested by brute-force marginals and labelled pages
CUT = 0.5

#: fixed values of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg xmp noembed noframes".split())
SKIPPED = RAW | frozenset("head select button option datalist canvas object audio video".split())
BLOCK = frozenset(("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary "
                   "table tbody td tfoot th thead tr ul caption").split())
#: open items that a new one ends, unless one of ``AROUND`` is open inside
ITEMS = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
AROUND = ("ul", "ol", "menu", "dl", "table", "tbody", "thead", "tfoot", "select")
ENDS_P = BLOCK - frozenset("td th tr tbody thead tfoot caption li dd dt html body".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                   r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(class|id|role|aria-label|itemprop|data-y)\s*=\s*(?:\"([^\"]*)|'([^']*)|([^\s\"'>]+))", re.I)

GROUPS = {t: g for g, ts in {
    "article": "article main", "nav": "nav menu", "footer": "footer", "header": "header", "aside": "aside dialog",
    "form": "form fieldset label input", "list": "ul ol dl", "item": "li dd dt", "head": "h1 h2 h3 h4 h5 h6 hgroup",
    "para": "p blockquote pre figcaption", "table": "table tbody thead tfoot tr td th caption", "div": "div section center figure details summary",
    "link": "a", "inline": "b i em strong span u s small sub sup code q cite abbr time mark font kbd samp var dfn bdi bdo ins del tt "
              "math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot munder mover",
    "page": "html body"}.items() for t in ts.split()}

#: words of class, id and role attributes, by what they say
CUES = {w: c for c, ws in {
    "menu": "nav navbar menu menubar breadcrumb breadcrumbs toolbar tabs pagination pager navigation toc skip topbar",
    "edge": "header footer masthead banner copyright legal colophon contentinfo bottom credits",
    "side": "sidebar aside widget rail related recommended recirc trending popular teaser complementary tags sharebar share social",
    "advert": "ad ads advert advertisement adsense sponsor sponsored promo promotion banner-ad dfp outbrain taboola",
    "notice": "cookie cookies consent notice alert modal popup overlay gdpr newsletter subscribe paywall signup login",
    "comment": "comment comments disqus reply replies respond discussion commentlist",
    "main": "article content main post entry story body text articlebody entry-content post-content article-body maincontent"}.items()
    for w in ws.split()}


class Node:
    __slots__ = ("tag", "parent", "children", "items", "cues", "own", "linked", "total", "stops", "label")

    def __init__(self, tag, parent, cues=(), label=None):
        self.tag, self.parent, self.cues, self.label = tag, parent, cues, label
        self.children, self.items = [], []       # items: text and nodes in order
        self.own = self.linked = self.total = self.stops = 0


def parse(html: str) -> Node:
    """The element tree of a page; scripts, styles and comments are left out."""
    from html import unescape
    root = Node("html", None)
    tree = _Open(root)
    at, n = 0, len(html)

    def text(s):
        if s:
            tree.path[-1].items.append(unescape(s))

    while at < n:
        m = TOKEN.search(html, at)
        if m is None:
            text(html[at:])
            break
        text(html[at:m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            if m[0].startswith("<![CDATA["):
                text(m[0][9:-3] if m[0].endswith("]]>") else m[0][9:])
            continue
        tag = tag.lower()
        if m[1]:
            tree.close(tag)
            continue
        if not m[4]:                      # the page ends inside a tag
            break
        if tag in RAW and not m[3].endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
            if tag == "xmp":              # shown as it stands
                text((html[at:end.start() if end else n]).replace("&", "&amp;"))
            at = end.end() if end else n
            continue
        if tag in ("html", "body"):
            if tag == "body" or tree.path[-1] is root:
                cues, label = _attributes(m[3])
                root.cues, root.label = root.cues or cues, root.label if label is None else label
            continue
        if tag == "br":
            tree.path[-1].items.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                tree.close_p()
            continue
        if tag in ENDS_P:
            tree.close_p()
        elif tag in ITEMS:
            tree.close_item(tag)
        cues, label = _attributes(m[3])
        node = tree.path[-1]
        child = Node(tag, node, cues, label)
        node.children.append(child)
        node.items.append(child)
        if not m[3].endswith("/") or tag in BLOCK:
            tree.push(child)
    return root


def _attributes(s: str):
    cues, label = set(), None
    for m in ATTRIBUTE.finditer(s) if "=" in s else ():
        value = m[2] or m[3] or m[4] or ""
        if m[1].lower() == "data-y":      # of the labelled pages; ``learn`` alone looks at it
            label = {"0": 0, "1": 1}.get(value)
            continue
        for w in value.lower().split():
            for part in (w, *re.split(r"[-_:]+", w)):
                if part in CUES:
                    cues.add(CUES[part])
    return tuple(sorted(cues)), label


class _Open:
    """The open elements, innermost last, with the places of each tag and of the
    blocks among them, so closing never climbs over elements that stay open."""

    def __init__(self, root: Node):
        self.path, self.at, self.blocks = [root], {}, [0]

    def push(self, node: Node) -> None:
        if node.tag in BLOCK:
            self.blocks.append(len(self.path))
        self.at.setdefault(node.tag, []).append(len(self.path))
        self.path.append(node)

    def _cut(self, k: int) -> None:
        while len(self.path) > k:
            self.at[self.path.pop().tag].pop()
            if self.blocks[-1] == len(self.path):
                self.blocks.pop()

    def _last(self, tags) -> int:
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def close(self, tag: str) -> None:
        """Close the nearest open ``tag``; a closing inline tag crosses no block."""
        k = self._last((tag,))
        if k and (tag in BLOCK or self.blocks[-1] < k):
            self._cut(k)

    def close_p(self) -> None:
        """Close an open paragraph, with what is open inside it."""
        k = self.blocks[-1]
        if k and self.path[k].tag == "p":
            self._cut(k)

    def close_item(self, tag: str) -> None:
        """Close an open item that one of ``tag`` ends, within its list or table."""
        k = self._last(ITEMS[tag])
        if k > self._last(AROUND + (("tr",) if tag in ("td", "th") else ())):
            self._cut(k)


def ordered(root: Node) -> list[Node]:
    """All nodes, parents first."""
    out = [root]
    for node in out:
        out.extend(node.children)
    return out


def measure(nodes: list[Node]) -> None:
    """Lengths of own, whole and linked text of every node."""
    for node in reversed(nodes):
        for item in node.items:
            if isinstance(item, str):
                k = len(item.strip())
                node.own += k
                node.total += k
                node.stops += sum(map(item.count, ".!?;"))
            else:
                node.total += item.total
                node.stops += item.stops
                node.linked += item.total if item.tag == "a" else item.linked


def features(node: Node) -> tuple:
    """Discrete observations of a node."""
    length = 0 if not node.total else 1 if node.total < 25 else 2 if node.total < 80 else 3 if node.total < 300 else 4
    links = 0 if not node.total else 1 + min(3, 4 * node.linked // (node.total + 1))
    stops = 0 if not node.stops else 1 if node.stops < 3 else 2
    return (("tag", GROUPS.get(node.tag, "other")), ("length", length), ("links", links), ("stops", stops),
            *(("cue", c) for c in node.cues or ("none",)))


#: hand-labelled pages: data-y="1" where content starts, data-y="0" where it ends
LABELLED = (
    '<body data-y="0"><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">World</a></li><li><a href="/c">Sport</a></li></ul></nav>'
    '<div class="ad">Buy one today. Get one free.</div><article data-y="1"><h1>The river rose again</h1><p>The river rose again on Monday, and the town waited. Nobody slept.</p>'
    '<p>By noon the water had reached the bridge, where the guards had put up signs, and the road was shut until the evening.</p><p>It fell later.</p></article><footer>&copy; 2020 The Paper. All rights reserved.</footer></body>',
    '<body data-y="0"><header class="site-header"><h1><a href="/">Daily</a></h1><p>News since 1900.</p><form><label>Search</label><input></form></header>'
    '<main data-y="1"><article><h2>Bread prices</h2><p><b>Prices went up.</b> Bakers said that flour had become dear, and that fuel cost more.</p><ul><li>Flour is up by a tenth.</li><li>Fuel is up by a fifth, they said.</li></ul>'
    '<div class="share social" data-y="0"><a href="#">Share</a> <a href="#">Tweet</a></div><p>The mayor promised help. It will take some weeks, she said, before the money comes.</p></article></main>'
    '<aside class="sidebar" data-y="0"><h3>Most read</h3><ul><li><a href="/1">Storm over the coast</a></li><li><a href="/2">Old ships return</a></li></ul></aside><footer><p>Contact us. Terms and privacy.</p></footer></body>',
    '<body data-y="0"><div id="menu"><a href="/x">One</a> <a href="/y">Two</a> <a href="/z">Three</a></div><div class="cookie-notice"><p>We use cookies. By staying here you agree to them, as our policy explains.</p><button>OK</button></div>'
    '<div class="content" data-y="1"><h1>How to plant a tree</h1><p>Dig a hole that is twice as wide as the roots. Put the tree in it, and fill it up with soil.</p><blockquote>A tree is a friend, my father said.</blockquote>'
    '<p>Water it well for the first year. See <a href="/w">our guide</a> for more on this.</p><table><tr><th>Tree</th><th>Depth</th></tr><tr><td>Oak</td><td>60 cm</td></tr></table></div>'
    '<div id="comments" class="comments" data-y="0"><h3>Comments</h3><div class="comment"><p>I did this last year and it worked very well. Thanks for the help!</p></div><div class="comment"><p>Mine died. What did I do wrong?</p></div></div><div class="footer"><p>Made with care. &copy; us.</p></div></body>',
    '<body data-y="0"><div class="header"><a href="/">Blog</a></div><div class="breadcrumb"><a href="/">Home</a> &gt; <a href="/p">Posts</a></div><section data-y="1"><div class="post"><h1>A walk in May</h1><div>We left at dawn, when the fields were still wet. Nobody was about.</div>'
    '<p>After two hours we came to the old mill, which has stood empty since the war, and sat down.</p><figure><figcaption>The mill in the morning light.</figcaption></figure><pre>walk = 12 km</pre><p>Then it rained.</p></div></section>'
    '<div class="advertisement" data-y="0"><p>Great boots for every walk. Order now and save!</p></div><div class="related" data-y="0"><h4>Related</h4><p><a href="/q">A walk in June</a></p></div><form class="newsletter"><p>Sign up for our letter. No spam, ever.</p><input></form></body>',
    '<body data-y="0"><nav><a href="/">Start</a></nav><article data-y="1"><h1>Short news</h1><p>It snowed.</p></article><footer>Imprint. All rights reserved by us.</footer></body>',
    '<body data-y="0"><ul class="nav"><li><a href="/1">A</a></li></ul><div class="sponsored">An offer from our partner. Read more here.</div><article data-y="1"><header><h1>Two views on the port</h1></header><section><h2>First</h2><p>The port should grow, say the firms, since ships do.</p></section><section><h2>Second</h2><p>It should not, say the people who live beside it; the noise is bad enough.</p></section></article><footer><small>&copy; Port News &middot; Words and more words here.</small></footer></body>',
    '<body data-y="0"><nav><ul><li><a href="/a">All songs</a></li></ul></nav><div class="ad">A new record is out now.</div><article data-y="1"><h1>Row row row</h1><p><b>Row row row your boat gently down the stream row row row your boat gently down the stream row row row your boat gently down the stream row row row your boat gently down the stream row row row your boat<br></article><footer>&copy; Songs &middot; Sung by all.</footer></body>',
    '<body data-y="0"><nav><ul><li><a href="/a">Lists</a></li></ul></nav><article data-y="1"><h1>Numbers</h1><p>one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty</p><p>zero | one | two | three | four</p></article><footer>Counted for you.</footer></body>',
    '<body data-y="0"><header><p>The Gazette, founded long ago.</p><nav><a href="/">Front</a> <a href="/s">Sport</a></nav></header><article data-y="1"><h1>Council votes</h1><p>The council voted late on Friday, and the plan was passed by one vote.</p><aside data-y="0"><h4>Trending</h4><a href="/t">A cat came back</a></aside><div class="newsletter" data-y="0"><form><p>Get our letter each week. It is free.</p></form></div><p>Work starts in spring. It will cost nine million, the clerk said.</p><section id="comments" data-y="0"><h3>2 replies</h3><ol class="commentlist"><li><p>About time! We have waited for years, and nobody listened.</p></li><li><p>A waste of money, if you ask me.</p></li></ol></section></article><footer><p>Published by the Gazette. Write to us.</p></footer></body>',
    '<body data-y="0"><div class="alert" role="alert">This site will be down on Sunday. We are sorry for that.</div><div data-y="1"><p>A page with no frame at all can hold a story too, told in plain paragraphs.</p><p>It goes on for a while, and then it ends, as they do.</p></div><div data-y="0"><a href="/p">Previous</a> <a href="/n">Next</a></div></body>',
)


#: labelled parts that ``composed`` puts together: furniture before and after the
#: content, furniture inside it, content wrappers and content blocks
BEFORE_PARTS = (
    '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News and more</a></li></ul></nav>', '<nav><a href="/">Start</a> | <a href="/x">Shop</a></nav>',
    '<header><a href="/">The name of it</a><p>A line about the site.</p></header>', '<div class="navbar"><ul><li><a href="/1">One</a></li><li><a href="/2">Two</a></li></ul></div>',
    '<div class="ad">Something to buy. Cheap!</div>', '<div id="ads"><a href="/buy">Buy it now</a></div>', '<div class="cookie-consent"><p>This site uses cookies. Do you accept?</p><a href="/p">Policy</a></div>',
    '<div role="navigation"><a href="/q">Menu</a></div>', '<form action="/s"><label>Find</label><select><option>All</option></select></form>', '<div class="breadcrumbs"><a href="/">Top</a> / <a href="/t">This</a></div>',
    '<div class="alert"><p>We are closed on Monday. Sorry for that.</p></div>', '<ul class="menu"><li><a href="/k">K</a></li><li><a href="/l">L</a></li></ul>', '<div class="topbar"><span>Sign in</span></div>')
AFTER_PARTS = (
    '<footer>&copy; The owner. All rights reserved, of course.</footer>', '<footer><p>Write to us. We answer.</p><ul><li><a href="/i">Imprint</a></li></ul></footer>', '<div class="footer"><p>Made by hand in the north.</p></div>',
    '<aside><h3>More</h3><ul><li><a href="/m">Another piece to read</a></li><li><a href="/n">And one more</a></li></ul></aside>', '<div class="sidebar"><h4>About</h4><p>We write about things, and have done so for years.</p></div>',
    '<section id="comments"><h2>Comments</h2><div class="comment"><b>Ann</b><p>I do not agree at all. It was not like that, and everyone knows it.</p></div></section>',
    '<div class="comments"><ul><li><p>Great, thanks.</p></li><li><p>First! And a longer remark on it, as I have the time.</p></li></ul></div>', '<div id="disqus_thread"><p>Please write a reply. Be kind.</p></div>',
    '<div class="related-posts"><h3>Related</h3><div><a href="/r">A piece like this</a></div></div>', '<div class="newsletter-signup"><p>Join our list. It is free.</p><input></div>', '<div class="copyright">2021 the firm</div>', '<nav class="pagination"><a href="/2">Next</a></nav>',
    '<div class="social-share"><a href="#">Share it</a></div>', '<div class="promo"><p>Get ten off your first order. Use the code at the till.</p></div>')
WRAPPERS = ("<article{}>", "<main{}>", '<div class="content"{}>', '<div id="main"{}>', '<section class="post"{}>', "<article{}>", "<article{}>", '<div class="article-body"{}>', "<div{}>")
CONTENT = (
    "<h1>The title of a story</h1>", "<h2>A part of it</h2>", "<p>Short one.</p>", "<p>It was a long day, and when it ended nobody wanted to go home.</p>", "<p>The road went up the hill, past the old farm, and then down to the lake where the boats lay; the men who had come from the town stood there, "
    "smoked, and said little. One of them, the oldest, had been there before. He knew what would come, or so he said, and the others let him talk.</p>", "<p>words and words with no stop in them at all go on and on in this one and it does not seem to end</p>",
    "<ul><li>First, wash it.</li><li>Then cut it up</li><li>Salt</li></ul>", "<blockquote><p>I said so, she told us.</p></blockquote>", "<pre>x = 1</pre>", "<table><tr><td>north</td><td>12</td></tr><tr><td>south</td><td>7</td></tr></table>", '<p>As <a href="/e">an earlier piece</a> said, this was not new.</p>',
    "<figure><img src=a><figcaption>The lake in winter.</figcaption></figure>", "<p><b>A bold start.</b> And <i>then</i> on, in plain words.</p>", "<div>Text in a plain block, which some pages use for paragraphs.</div>", "<p><b>Left open and long, it ran to the end.<br>", "<ol><li><p>One step.</p></li><li><p>One more step, longer than the first one was.</p></li></ol>")


def composed(n: int = 150, seed: int = 3) -> tuple[str, ...]:
    """Labelled pages put together from the labelled parts."""
    import random
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        inside = [rng.choice(CONTENT) for _ in range(rng.randint(2, 9))]
        for _ in range(rng.randint(0, 2)):
            part = rng.choice(AFTER_PARTS[3:])
            inside.insert(rng.randrange(len(inside) + 1), f'<div data-y="0">{part}</div>' if rng.random() < 0.2 else part.replace(">", ' data-y="0">', 1))
        wrapper = rng.choice(WRAPPERS)
        end = "</" + re.match("<([a-z]+)", wrapper)[1] + ">"
        out.append('<body data-y="0">' + "".join(rng.sample(BEFORE_PARTS, rng.randint(1, 3))) + wrapper.format(' data-y="1"')
                   + CONTENT[0] + "".join(inside) + end + "".join(f'<div data-y="0">{x}</div>' if rng.random() < 0.2 else x.replace(">", ' data-y="0">', 1)
                                                                  for x in rng.sample(AFTER_PARTS, rng.randint(1, 3))) + "</body>")
    return tuple(out)


def learn(pages=None) -> dict:
    """Log potentials from labelled pages: counts with add-one smoothing."""
    from math import log
    pages = LABELLED + composed() if pages is None else pages
    pair, seen, total = {}, {}, {}
    values: dict = {}
    for html in pages:
        nodes = ordered(parse(html))
        measure(nodes)
        state = {}
        for node in nodes:
            up = state[id(node.parent)] if node.parent is not None else 0
            y = state[id(node)] = up if node.label is None else node.label
            if node.parent is not None:
                pair[up, y] = pair.get((up, y), 0) + 1
            for f in features(node):
                seen[f, y] = seen.get((f, y), 0) + 1
                total[f[0], y] = total.get((f[0], y), 0) + 1
                values.setdefault(f[0], set()).add(f[1])
    model: dict = {"pair": [[log((pair.get((a, b), 0) + 1) / (sum(pair.get((a, c), 0) for c in (0, 1)) + 2)) for b in (0, 1)] for a in (0, 1)],
                   "root": [log(0.95), log(0.05)], "new": {}}
    for name, vs in values.items():
        for v in vs:
            model[name, v] = tuple(log((seen.get(((name, v), y), 0) + 0.5) / (total.get((name, y), 0) + 0.5 * (len(vs) + 1))) for y in (0, 1))
    return model


def marginals(nodes: list[Node], model: dict) -> list[float]:
    """The probability of each node (parents first) to be content, by
    sum-product messages up and down the tree."""
    from math import exp
    number = {id(node): k for k, node in enumerate(nodes)}
    pair = [[exp(x) for x in row] for row in model["pair"]]
    root = [exp(x) for x in model["root"]]
    local, up = [], [None] * len(nodes)
    for node in nodes:
        a = b = 0.0
        for f in features(node):
            w = model.get(f)
            if w:
                a += w[0]
                b += w[1]
        m = max(a, b)
        local.append([exp(a - m), exp(b - m)])
    below = [list(x) for x in local]          # evidence at a node and under it
    for k in range(len(nodes) - 1, 0, -1):
        b0, b1 = below[k]
        m0, m1 = pair[0][0] * b0 + pair[0][1] * b1, pair[1][0] * b0 + pair[1][1] * b1
        s = m0 + m1
        up[k] = (m0 / s, m1 / s)
        x = below[number[id(nodes[k].parent)]]
        x[0] *= up[k][0]
        x[1] *= up[k][1]
        s = x[0] + x[1]
        x[0] /= s
        x[1] /= s
    down = [None] * len(nodes)
    down[0] = tuple(root)
    out = []
    for k, node in enumerate(nodes):
        if k:
            p = number[id(node.parent)]
            # the parent's belief without this child's message
            q0, q1 = down[p][0] * below[p][0] / up[k][0], down[p][1] * below[p][1] / up[k][1]
            d0, d1 = q0 * pair[0][0] + q1 * pair[1][0], q0 * pair[0][1] + q1 * pair[1][1]
            s = d0 + d1
            down[k] = (d0 / s, d1 / s)
        p0, p1 = down[k][0] * below[k][0], down[k][1] * below[k][1]
        out.append(p1 / (p0 + p1))
    return out


def main_text(html: str, model: dict, cut: float = CUT) -> str:
    """The text of the content nodes: blocks on lines, white space as one space."""
    if not html:
        return ""
    root = parse(html)
    nodes = ordered(root)
    measure(nodes)
    keep = {id(n): p >= cut for n, p in zip(nodes, marginals(nodes, model))}
    blocks, line = [], []

    def flush():
        s = " ".join("".join(line).split())
        if s:
            blocks.append(s)
        line.clear()

    stack = [(root, 0)]
    while stack:                              # no recursion: pages can be deep
        node, k = stack.pop()
        if k == 0 and node.tag in BLOCK:
            flush()
        while k < len(node.items):
            item = node.items[k]
            k += 1
            if isinstance(item, str):
                if keep[id(node)]:
                    line.append(item)
            elif item.tag not in SKIPPED:
                stack.append((node, k))
                stack.append((item, 0))
                break
        else:
            if node.tag in BLOCK:
                flush()
    flush()
    return "\n".join(blocks)


def extract(pages: DataFrame, labelled=None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    model = learn(labelled)                   # a few hundred numbers

    def run(batches):
        import pyarrow as pa
        for batch in (s for b in batches for s in slices(b, col="html")):
            texts = [main_text(h or "", model) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))

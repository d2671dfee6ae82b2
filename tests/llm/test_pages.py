"""Main text of pages made by hand."""

import html
import re

import pyarrow.parquet as pq

from cardloom.llm import pages

SITE = """<!doctype html><html><head><title>T &amp; U</title><style>p{}</style></head><body class="with-sidebar">
<header><h1>Site name</h1></header><nav><ul><li><a href=/a>Home</a><li><a href="/b">About, us.</a></ul></nav>
<div class="cookie-notice">We use cookies, as all do. Accept, please.</div>
<div id=page><div class="ad banner">Buy now, pay later. Great offers, cheap prices, today only.</div>
<div class="content"><h2>A  headline&nbsp;here</h2><p>First paragraph, with a <a href="/x">link</a> and &eacute;t&eacute;.<br>Same block.
<p>Second, unclosed <b>paragraph.<div>A block, too. &lt;tag&gt;</div><ul><li>One item<li>Another item</ul>
<script>document.write("<p>never, ever.</p>")</script><form><p>Your name, please:</p><input></form>
<table><tr><td>Cell one<td>Cell two</table><pre>code  (x)</pre></div>
<aside><p>Something else, a teaser. More, of that.</p></aside>
<div class="comments"><h3>Comments</h3><div class="comment"><p>Great, thanks a lot! I agree, fully, with all of it.</p></div></div></div>
<footer>&copy; 2026, all rights reserved.</footer></body></html>"""


def test_article_without_the_rest():
    assert pages.main_blocks(SITE) == [
        "A headline here", "First paragraph, with a link and été. Same block.", "Second, unclosed paragraph.", "A block, too. <tag>", "One item", "Another item",
        "Cell one", "Cell two", "code (x)",
    ]


def test_odd_input():
    cases = {None: [], "": [], "just text": ["just text"], "<p>a<p>b": ["a", "b"], "<!-- never <p>x</p>": [], "<script>x": [], "a < b &am &amp c": ["a < b &am & c"], "<nav>x</nav>": [], '<p title="a>b">c</p>': ["c"]}
    for text, expected in cases.items():
        assert pages.main_blocks(text) == expected, text
    assert pages.main_blocks("<div>" * 20000 + "deep, text." + "</div>" * 9) == ["deep, text."]


def test_pages_of_the_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").selectExpr("page_id", "url", "html", "'clash' AS text")
    got = {r.page_id: r.text for r in pages.extract(frame).collect()}
    for row in pq.read_table("/root/testdata/sf0.001/pages.parquet").to_pylist():
        inner = re.search("<article>(.*?)</article>", row["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", inner)]
        assert got[row["page_id"]] == "\n".join(b for b in blocks if b)
    empty = spark.createDataFrame([(1, None), (1, None)], "page_id long, html string")
    assert [r.text for r in pages.extract(empty).collect()] == ["", ""] and pages.extract(empty.limit(0)).count() == 0


ARTICLE = "<h1>Title</h1>" + "".join(f"<p>Paragraph {i}, of the article itself, with some words in it.</p>" for i in range(8))
TEXT = ["Title", *(f"Paragraph {i}, of the article itself, with some words in it." for i in range(8))]
COMMENTS = '<div id="comments"><p>Great, thanks a lot! I agree, fully.</p><p>So do I, by the way, with all of it.</p></div>'


def test_classes_of_layout_do_not_drop_the_article():
    for name in ("with-sidebar", "no-sidebar", "content has-sidebar", "elementor-widget", "no-comments", "social-science", "left-sidebar", "overlay", "skip"):
        for attribute in ("class", "id"):
            page = f'<body><div {attribute}="{name}">{ARTICLE}{COMMENTS}</div><div class="sidebar"><p>More, of that, elsewhere.</p></div></body>'
            assert pages.main_blocks(page) == TEXT, name
    widgets = "".join(f'<div class="elementor-widget"><p>{t}</p></div>' for t in TEXT)
    assert pages.main_blocks(f"<body>{widgets}{COMMENTS}</body>") == TEXT


def test_boilerplate_within_or_beside_goes():
    for name in ("sidebar", "site-footer", "post-comments", "cookie-notice", "share", "related-posts", "newsletter"):
        other = f'<div class="{name}"><p>Something else, to be left out, for sure.</p></div>'
        for page in (f'<div class="with-sidebar">{ARTICLE}{other}</div>', f'<div class="site-widget"><div>{ARTICLE}</div>{other}</div>'):
            assert pages.main_blocks(page) == TEXT, name
    long = f'<div class="comment-list">{"<p>I agree, fully, with all of it, as ever, and more so.</p>" * 12}</div>'
    assert pages.main_blocks(f"<div>{ARTICLE}</div>{long}") == TEXT
    assert pages.main_blocks(f"<article><p>A short note, no more.</p></article>{long}") == ["A short note, no more."]


def test_headline_lead_and_short_section_beside_a_long_part_stay():
    body = "".join(f"<p>{t}</p>" for t in TEXT[1:])
    other = '<nav><a href="/">Home</a></nav><footer>All rights reserved.</footer>'
    for tag in ("article", "main", "div"):
        page = f"<body>{other}<{tag}><h1>Title</h1><p>Lead, in short.</p><div class=body>{body * 9}</div></{tag}></body>"
        assert pages.main_blocks(page) == ["Title", "Lead, in short.", *TEXT[1:] * 9], tag
        page = f"<body>{other}<{tag}><section>{body * 9}</section><section><p>The end, at last.</p></section></{tag}></body>"
        assert pages.main_blocks(page) == [*TEXT[1:] * 9, "The end, at last."], tag
    page = f"<main><article><header><h1>Title</h1></header><div><div>{body * 9}</div><div class=end><span>Written, by hand.</span></div></div></article><div><span>More, elsewhere.</span></div></main>"
    assert pages.main_blocks(page) == ["Title", *TEXT[1:] * 9, "Written, by hand."]


def test_attributes_and_names_that_only_look_like_boilerplate_stay():
    more = (
        '<div style="overflow:hidden"><p>Shown, though it overflows.</p></div><p title="hidden gem">A gem, as it is.</p><div data-role="form"><p>No form, this one.</p></div>'
        '<div class="share-price"><p>Four, or five, a share.</p></div><div id="noticePeriod"><p>A month, or two.</p></div><div class="banner-story"><p>What the banners say, and why.</p></div>'
    )
    expected = ["Shown, though it overflows.", "A gem, as it is.", "No form, this one.", "Four, or five, a share.", "A month, or two.", "What the banners say, and why."]
    for tag in ("article", "main", "div"):
        assert pages.main_blocks(f"<body><nav><a href=/>Home</a></nav><{tag}>{ARTICLE}{more}</{tag}></body>") == TEXT + expected, tag
    assert pages.main_blocks(f"<article>{ARTICLE}<div hidden><p>Never shown, to anyone.</p></div></article>") == TEXT


def test_boilerplate_with_neutral_names_goes():
    links = "".join(f'<li><a href="/{i}">Place number {i}, and more</a></li>' for i in range(9))
    for tag in ("article", "main", "div"):
        page = (
            f'<body><div class="x1"><ul>{links}</ul></div><div class="x2">Buy now, today.</div><{tag} class="x3">{ARTICLE}<div class="x4"><ul>{links}</ul></div></{tag}>'
            f'<div class="x5"><ul>{links}</ul></div><div class="x6">All rights reserved.</div></body>'
        )
        assert pages.main_blocks(page) == TEXT, tag


def test_priors_alone_leave_nothing_out():
    assert pages.main_blocks(f'<body><form id="whole">{ARTICLE}</form></body>') == TEXT
    assert pages.main_blocks(f'<body><div class="sidebar">{ARTICLE}</div></body>') == TEXT
    assert pages.main_blocks("<nav>Home, sweet home.</nav><footer>All rights reserved, of course.</footer>") == []


def test_meaning_of_names():
    cases = {
        "share-price": "price", "comment-list": "comment", "site-footer": "footer", "cookieNotice": "notice", "with-sidebar": "", "side-bar": "sidebar", "related_posts": "related",
        "ad": "ad", "ad-300x250": "ad", "social-science": "science", "42": "", "SiteHeader": "siteheader",
        "disqus_thread": "disqus", "social-media-icons": "social", "related-articles": "related", "mainArticle": "article", "banner-story": "story",
    }
    assert {x: pages.meaning(x) for x in cases} == cases


def plain_blocks(page: pages._Page) -> list[str]:
    """Path ratios read off the docstring: sums over all blocks for each block, ancestors walked one by one."""
    pages._name_priors(page)
    blocks, parent, prior = page.blocks, page.parents, page.priors
    n_marks = [len(pages._MARKS.findall(b[2])) for b in blocks]

    def chain(e):
        return [e, *chain(parent[e])] if e else [0]

    def ratio(path):
        own = [(len(b[2]), b[3], k) for b, k in zip(blocks, n_marks) if b[0] == path]
        chars, linked, marks = (sum(x) for x in zip(*own))
        f = ((chars - linked) / len(own) * (1 + marks / len(own))) ** 0.5 * (1 - linked / chars) ** 2
        return f / (f + pages.HALF), 1 - linked / chars

    if not blocks:
        return []
    ratios = {b[0]: ratio(b[0]) for b in blocks}
    weigh = lambda e: sum((len(b[2]) - b[3] + 10 * k) * ratios[b[0]][0] * prior[b[1]] for b, k in zip(blocks, n_marks) if e in chain(b[1]))
    weights = [weigh(e) for e in range(len(parent))]
    best = max(prior[b[1]] for b in blocks)
    plain = [b for b in blocks if prior[b[1]] == best]
    root = whole = 0
    while True:
        children = [e for e in range(1, len(parent)) if parent[e] == root]
        if not children:
            break
        child = max(children, key=lambda e: (weights[e], -e))
        alike = [e for e in children if weights[e] > 0 and prior[e] >= best and page.paths_of[e] == page.paths_of[child]]
        direct = any(b[1] in (root, child) for b in plain) or page.tags[root] == "article"
        beside = any(parent[b[1]] == root and page.tags[b[1]] in pages._TOGETHER and b[3] < len(b[2]) for b in plain)
        if direct or beside or len(alike) > 1 or weights[child] < pages.ROOT_SHARE * weights[root]:
            break
        root = child
        whole = root if page.tags[root] in ("article", "main") else whole
    own = [b for b in blocks if (whole or root) in chain(b[1])]
    smooth = []
    for i in range(len(own)):
        near = [(2.718281828459045 ** -(((i - j) / 1.5) ** 2 / 2), ratios[b[0]][0]) for j, b in enumerate(own) if abs(i - j) <= pages.REACH]
        smooth.append(sum(w * r for w, r in near) / sum(w for w, _ in near))
    score = {}
    for path in {b[0] for b in own}:
        values = [s for s, b in zip(smooth, own) if b[0] == path]
        score[path] = sum(values) / len(values) * ratios[path][1] ** 2
    top = max((score[b[0]] * prior[b[1]] for b in own), default=0)
    return [b[2] for b in own if top >= pages.FLOOR and score[b[0]] * prior[b[1]] >= pages.LEAST_SHARE * top]


def test_equals_plain_path_ratios():
    table = [r["html"] for r in pq.read_table("/root/testdata/sf0.001/pages.parquet").to_pylist()]
    made = [SITE, f"<body><div class=x>{ARTICLE}</div>{COMMENTS}</body>", f"<form>{ARTICLE}{COMMENTS}</form>", '<p>a<p>b<div class="ad">c, d.</div>', "<nav>x</nav>", ""]
    for page in table + made:
        assert pages.main_blocks(page) == plain_blocks(pages._Page(page))


def test_ratios_alone_find_the_article():
    """Without any prior most pages of the table come out the same: links, notices and adverts go by their ratios."""
    rows = pq.read_table("/root/testdata/sf0.001/pages.parquet").to_pylist()
    same = 0
    for row in rows:
        bare = re.sub("<(/?)(?:nav|header|footer|aside|form)", r"<\1div", re.sub(' (?:class|id|role)="[^"]*"', "", row["html"]))
        same += pages.main_blocks(bare) == pages.main_blocks(row["html"])
    assert same >= 0.8 * len(rows)


def test_comments_never_take_the_place_of_a_short_article():
    """However long they are, and without an article or main element."""
    comments = "".join(f"<p>Reader {i} says that this is a rather long comment, with marks; and more, of course.</p>" for i in range(60))
    assert pages.main_blocks(f"<body><div class=post><p>Short post.</p></div><div id=comments>{comments}</div></body>") == ["Short post."]
    assert pages.main_blocks(f"<body><div class=comments>{comments}</div><p>Short post.</p></body>") == ["Short post."]
    assert len(pages.main_blocks(f"<body><div id=comments>{comments}</div></body>")) == 60  # there is nothing else
    assert len(pages.main_blocks(f"<body class=comments><h1>Title</h1>{comments}</body>")) == 61  # a name of layout


def test_linked_headings_and_lists_of_an_article():
    head, text = "<h2><a href=x>Linked heading</a></h2>", "<p>Text of the article, with some length to it.</p>"
    links = "<ul><li><a href=y>Source one</a></li><li><a href=z>Source two</a></li></ul>"
    own, sources = "Text of the article, with some length to it.", ["Source one", "Source two"]
    assert pages.main_blocks(f"<body><article>{head}{text}{text}{links}</article></body>") == ["Linked heading", own, own, *sources]
    menu = "<div><ul><li><a href=a>Home</a></li><li><a href=b>News</a></li></ul></div>"
    assert pages.main_blocks(f"<body>{menu}<div>{head}{text}{links}{text}</div>{links}</body>") == ["Linked heading", own, *sources, own]
    assert pages.main_blocks(f"<body><nav>{links}</nav><article>{text}{text}<nav>{links}</nav><div class=related>{links}</div></article></body>") == [own, own]

"""Wrapper induction on generated sites, whose true texts are known, and on odd markup."""

import html as markup
import random

import pytest

from corpusprep.llm.html_extract import CONSTANT, MIN_PAGES, OUTLINES, Induction, Page, content_path, extract, host_of, html_main_text, layout, main_blocks, match_trees, parse, wrappers

SCHEMA = "page_id long, url string, html string"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij é&<") for _ in range(rng.randrange(2, 9))).strip() or "x" for _ in range(n))


def one_line(text):
    return " ".join(text.split())


def site(rng, shell, constants=(), pages=8):
    """(html, text) of pages of one template: ``shell`` wraps the blocks; ``constants`` stand at both ends of all pages."""
    out = []
    for _ in range(pages):
        own = [words(rng, rng.randrange(3, 30)) for _ in range(rng.randrange(2, 7))]
        body = "".join(rng.choice(["<p>%s</p>", "<p>%s", "<div class='para'>%s</div>", "<h2>%s</h2>", "<ul><li>%s</ul>"]) % markup.escape(t) for t in own)
        top, end = ("".join(f"<p>{c}</p>" for c in part) for part in (constants[::2], constants[1::2]))
        out.append((shell % (top + body + end), "\n".join(one_line(t) for t in own)))
    return out


SHELLS = [
    "<html><body><div class='top'><a href=/>Home</a></div><div class='x1'><div class='x2'>%s</div></div><div class='links'><a href=a>One</a><a href=b>Two</a></div><footer>f</footer></body></html>",
    "<body><nav>n</nav><main class=c>%s<aside>s</aside></main><section class=comments><article class='comment'><p>nice</p></article></section>",
    "<body><div class='layout with-sidebar'><article class='post has-comments'>%s</article><div class='sidebar'>side</div></div><div class='teasers'><article class=teaser>more</article></div>",
    "<body><div id=page class='no-header'><div class='story'>%s</div></div><form><input><button>go</button></form>",
]


@pytest.mark.parametrize("shell", SHELLS)
def test_generated_sites(spark, shell):
    rng = random.Random(len(shell))
    pages = site(rng, shell)
    rows = [(k, f"https://s.example.com/{k}", h) for k, (h, _) in enumerate(pages)]
    got = {r.page_id: r.text for r in html_main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {k: t for k, (_, t) in enumerate(pages)}


def test_constant_blocks_are_template_and_varying_ones_content(spark):
    """The wrapper decides: the same page read alone keeps the blocks that its host has everywhere."""
    rng = random.Random(3)
    pages = site(rng, SHELLS[2], ["Read our newsletter every day", "All rights are with the paper"], pages=9)
    rows = [(k, f"https://s.example.com/{k}", h) for k, (h, _) in enumerate(pages)]
    rows += [(100, "https://alone.example.com/1", pages[0][0])]
    rows += [(200 + k, f"https://few.example.com/{k}", h) for k, (h, _) in enumerate(pages[: MIN_PAGES - 1])]
    rows += [(300 + k, f"https://s.example.com/{k}", pages[0][0]) for k in range(40)]  # equal pages count once
    got = {r.page_id: r.text for r in html_main_text(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    assert {k: got[k] for k in range(9)} == {k: t for k, (_, t) in enumerate(pages)}
    assert got[300] == got[339] == pages[0][1]
    whole = ["Read our newsletter every day", *pages[0][1].split("\n"), "All rights are with the paper"]
    assert got[100].split("\n") == got[200].split("\n") == whole
    assert MIN_PAGES * CONSTANT > MIN_PAGES - 1


def test_a_block_of_some_pages_is_content(spark):
    rng = random.Random(4)
    pages = site(rng, SHELLS[1], pages=20)
    some = "Shared by nine pages in ten"
    rows = [(k, "https://s.example.com/", h.replace("</main>", "") if k == 0 else h.replace("<main class=c>", f"<main class=c><p>{some}</p>") if k % 10 else h) for k, (h, _) in enumerate(pages)]
    got = {r.page_id: r.text for r in html_main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert sum(t.startswith(some) for t in got.values()) == 18


def test_a_host_with_two_layouts_has_two_wrappers(spark):
    rng = random.Random(5)
    first, second = site(rng, SHELLS[0]), site(rng, "<body><table class=t><tr><td class=left><a href=x>x</a></td><td class=right>%s</td></tr></table>")
    both = [(k, "https://two.example.com/", h) for k, (h, _) in enumerate(first + second)]
    assert len({layout(parse(h)) for _, _, h in both}) == 2
    got = {r.page_id: r.text for r in html_main_text(spark.createDataFrame(both, SCHEMA)).collect()}
    assert got == {k: t for k, (_, t) in enumerate(first + second)}


@pytest.mark.parametrize("depth", [1200, 5000])
def test_deep_pages_are_aligned(spark, depth):
    deep = lambda n: "<body>" + "<div>" * depth + f"<p>text {n}</p><p>again {n}</p>" + "</div>" * depth
    size, _ = match_trees(parse(deep(1)), parse(deep(2)))
    assert size >= depth
    assert len(content_path([parse(deep(1)), parse(deep(2))])) >= depth - 1
    rows = [(k, "https://deep.example.com/", deep(k)) for k in range(3)]
    got = {r.page_id: r.text for r in html_main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {k: f"text {k}\nagain {k}" for k in range(3)}


@pytest.mark.parametrize(
    "html,text",
    [
        ("<div class='layout with-sidebar'><article><p>a</p></article></div>", "a"),
        ("<div class='sidebar-left'><article><p>a</p></article><p>side</p></div>", "a"),
        ("<article><div class='post-header'><h1>t</h1></div><p>a</p></article>", "t\na"),
        ("<article class='story'><p>a</p></article><article class='comment'><p>c</p></article><article class=teaser>t</article>", "a"),
        ("<div class='widget'><article class='comment'>c</article></div><article><p>a</p></article>", "a"),
        ("<div id='main-content'><p>a</p><div class='cookie-bar'>c</div></div>", "a"),
        ("<nav><article>n</article></nav><p>a</p>", "a"),
    ],
)
def test_names_frame_only_what_they_name(html, text):
    assert extract(f"<body>{html}</body>", None) == text


def test_template_blocks_are_dropped_by_wrapper_and_text():
    from corpusprep.llm.html_extract import block_hash

    html = "<article><p>same</p><p>own</p></article>"
    wrapper, lines = main_blocks(parse(html), None)
    assert lines == ["same", "own"]
    assert extract(html, None, frozenset([block_hash(wrapper, "same")])) == "own"
    assert extract(html, None, frozenset([block_hash("other", "same")])) == "same\nown"


def paths_of(spark, sites):
    """Path by (host, layout) as learnt in Spark from sites: host -> pages."""
    from pyspark.sql import functions as F

    rows = [(k, f"https://{host}/{k}", h) for host, pages in sites.items() for k, h in enumerate(pages)]
    own = spark.createDataFrame(rows, SCHEMA).repartition(3).select(host_of(F.col("url")).alias("host"), "html")
    return {(r.host, w.layout): tuple(w.path) for r in wrappers(own).collect() for w in r.wrappers}


def paths_of_all_pairs(sites):
    layouts = {}
    for host, pages in sites.items():
        for h in set(pages):
            layouts.setdefault((host, layout(parse(h))), []).append(parse(h))
    return {k: path for k, pages in layouts.items() if (path := content_path(pages))}


def test_every_page_of_a_layout_has_its_part_in_the_wrapper(spark):
    """One page of twelve, another one on each host, has text that varies beside the element of the others."""
    sites = {}
    for odd in range(12):
        pages = [h for h, _ in site(random.Random(odd), SHELLS[0], pages=12)]
        pages[odd] = pages[odd].replace("<div class='x1'>", "<div class='x1'><p>Beside the others</p>")
        sites[f"h{odd}.example.com"] = pages + pages[:4]
    got = paths_of(spark, sites)
    assert got == paths_of_all_pairs(sites)
    assert set(got.values()) == {("html.", "body.", "div.x1")} and len(got) == 12
    rows = [(k, f"https://{host}/{k}", h) for host, pages in sites.items() for k, h in enumerate(pages)]
    texts = [r.text for r in html_main_text(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sum(t.startswith("Beside the others\n") for t in texts) == 12 + 4  # the odd pages, four of them twice


def some_tree(rng, depth):
    tags = "div,div class=a,div class=b,section,article,p,p,nav,ul,h1,a href=x".split(",")
    out = ""
    for _ in range(rng.randrange(4)):
        tag = rng.choice(tags)
        deep = tag[0] in "dsanu" and depth and rng.random() < 0.75
        out += f"<{tag}>{some_tree(rng, depth - 1) if deep else rng.choice(['x', 'y', '', 'z', '<a href=1>l</a>'])}</{tag.split()[0]}>"
    return out


def some_site(rng):
    shells = "<article>%s</article>,<div class=c><div class=d>%s</div></div>,<div class=b>%s</div>,<div><p>n</p></div><div>%s</div>,<table><tr><td>a<td>%s</table>".split(",")
    parts = [rng.choice(shells)]
    for _ in range(rng.randrange(4)):
        parts.insert(rng.randrange(len(parts) + 1), rng.choice(["<hr>", "<p></p>", "<div class=b></div>", "<p>c</p>", "<nav>%s</nav>", "<nav><p>i</p></nav>", "<div class=more><ul><li><a>%s</a></ul></div>"]))
    often = [rng.choice([1, 1, 0.5]) for _ in parts]
    return ["<body>" + "".join(p.replace("%s", some_tree(rng, 2)) for p, o in zip(parts, often) if rng.random() < o) for _ in range(rng.randrange(2, 9))]


def test_the_path_is_that_of_all_pairs():
    """What was learnt in parts, without aligning all pairs, against ``content_path``, which does."""
    known = 0
    for seed in range(1500):
        rng = random.Random(seed)
        pages = some_site(rng)
        parts, whole = [Induction() for _ in range(3)], Induction()
        for h in pages:
            rng.choice(parts).add(Page(h))
        for x in parts:
            whole.join(x.path, x.stuck, [p.html for p in x.pages.values()])
        if not whole.stuck or whole.path == ():
            assert (whole.path or None) == content_path([parse(h) for h in set(pages)]), seed
            known += 1
    assert known > 300


def test_pages_whose_outlines_do_not_settle_it_are_aligned_in_pairs(spark, monkeypatch):
    from corpusprep.llm import html_extract

    monkeypatch.setattr(html_extract, "BLOCK_PAGES", 2)
    sites = {f"h{seed}.example.com": some_site(random.Random(seed)) for seed in range(80)}
    assert paths_of(spark, sites) == paths_of_all_pairs(sites)
    stuck = Induction()
    for h in ("<body><p>n</p><div class=b><p>x</p></div>", "<body><div class=b></div><p>n</p><div class=b><p>y</p><p>z</p></div>"):
        stuck.add(Page(h))
    assert stuck.stuck
    many = ["<body><div><p>name</p></div><div>" + "".join(f"<{t}>{k}</{t}>" for t in format(k + 2, "b").replace("0", "p ").replace("1", "h2 ").split()) + "</div>" for k in range(OUTLINES + 9)]
    held = Induction()
    for h in many:
        held.add(Page(h))
    assert held.stuck and not held.pages
    assert paths_of(spark, {"many.example.com": many}) == paths_of_all_pairs({"many.example.com": many})

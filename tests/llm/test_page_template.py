import random
from collections import Counter, defaultdict

import pytest

from marketbars.llm import page_template as pt

from .conftest import prose

PAGES = "page_id long, url string, html string"


def site(host, n, plain=False, seed=0):
    """Pages of one host and their main texts; ``plain``: only divs, no names."""
    rng = random.Random(f"{host}{seed}")
    out = []
    for i in range(n):
        title = f"Title {prose(rng.random(), 3)}"
        paragraphs = [prose(rng.random(), rng.randrange(8, 60)) for _ in range(rng.randrange(1, 6))]
        links = "".join(f"<li><a href='/{j}'>{prose(rng.random(), 2)}</a></li>" for j in range(rng.randrange(2, 6)))
        body = "".join(f"<p>{p.replace('w1', '<i>w1</i>')}</p>\n" for p in paragraphs)
        if plain:
            page = (f"<html><body><div><div>Our site</div><ul>{links}</ul></div><div><h1>{title}</h1>"
                    f"<div>{body}</div></div><div>&copy; {host} all rights kept</div></body></html>")
        else:
            page = (f"<!doctype html><html><head><title>{title}</title><script>if (1<2) x('</p>');</script>"
                    f"</head><body class='has-sidebar'><header><a href='/'>{host}</a></header><nav><ul>{links}</ul>"
                    f"</nav><div class='cookie-notice'>We use cookies {i}</div><article class='post-{i}'><header><h1>"
                    f"{title}</h1></header><p>Read this aloud</p>{body}<div class='ad'>Buy {prose(rng.random(), 4)}"
                    f"</div><aside>See also</aside><form>Mail <input></form></article><section id='comments'>"
                    f"<article class='comment'>{prose(rng.random(), 9)}</article></section>"
                    f"<footer>{prose(rng.random(), 5)}</footer></body></html>")
        out.append((f"https://{host}/{i}", page, [title, *paragraphs]))
    return out


def truth(blocks):
    return "\n\n".join(" ".join(b.split()) for b in blocks)


def test_sites_with_and_without_article_elements(spark):
    rows, want = [], {}
    for host, n, plain in (("a.example.org", 12, False), ("B.example.org", 10, True), ("b.example.org", 2, True),
                           ("c.example.org", 2, False)):
        for url, page, blocks in site(host, n, plain):
            rows.append((len(rows), url, page))
            label = ["Read this aloud"] if host[0] == "c" else []
            want[rows[-1][0]] = truth([blocks[0], *label, *blocks[1:]])
    rows += [(900, None, None), (900, "x", ""), (901, "no host", "just text"), (None, "http://", "<p>a</p><p>b"),
             (902, rows[0][1], rows[0][2])]
    docs = spark.createDataFrame([(*r, "z") for r in rows], PAGES + ", host string")
    got = pt.extract_pages(docs).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by_id = {r.page_id: r.text for r in got if r.page_id is not None and r.page_id < 900}
    assert by_id == want
    rest = sorted((r.page_id or 0, r.text) for r in got if r.page_id is None or r.page_id >= 900)
    assert rest == [(0, "a\n\nb"), (900, ""), (900, ""), (901, "just text"), (902, want[0])]


def test_classes_against_brute_force(spark):
    pages = site("a.example.org", 7) + site("z.example.org", 5, True) + site("q.example.org", 2)
    docs = spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(pages)] + [(99, pages[0][0], pages[0][1])],
                                 PAGES)
    read = pt._once(docs.select(pt.host_of(docs["url"]).alias("host"), "html").mapInArrow(pt._read, pt._READ))
    assert read.count() == len(pages)
    got = defaultdict(set)
    for r in pt.equivalence_classes(read).collect():
        got[r["host"], r["class"]].add(r["token"])
    want, hosts = defaultdict(set), defaultdict(list)
    for url, source, _ in pages:
        hosts[url.split("/")[2]].append(Counter(pt.Page(source).keys))
    for host, counts in hosts.items():
        for token in set().union(*counts):
            vector = tuple(c[token] for c in counts)
            if len(counts) >= 3 and 2 * sum(v > 0 for v in vector) >= len(counts):
                want[host, vector].add(token)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values())) and len(want) > 4


def test_only_ordered_and_nested_classes_are_valid(spark):
    # x and y occur once on each page, in changing order; the list's items are nested
    pages = [f"<div><ul>{'<li>i</li>' * n}</ul>{'<b>x</b><i>y</i>' if n % 2 else '<i>y</i><b>x</b>'}</div>"
             for n in range(2, 8)]
    docs = spark.createDataFrame([(i, "http://h/", p) for i, p in enumerate(pages)], PAGES)
    read = pt._once(docs.select(pt.host_of(docs["url"]).alias("host"), "html").mapInArrow(pt._read, pt._READ))
    keys = {p: pt.Page(p).keys for p in pages}
    items = set(keys[pages[0]][2:5])
    found = defaultdict(dict)
    for r in pt.valid_classes(read, pt.equivalence_classes(read)).collect():
        found[r["class"]][r["token"]] = r["place"]
    assert [sorted(v.values()) for v in found.values() if set(v) == items] == [[0, 1, 2]]
    once = set(keys[pages[0]]) - items
    assert not any(set(v) & once for v in found.values())


CASES = [
    ("<p>a &amp; b&nbsp;c &lt;p&gt; &#233; &copy</p>", "a & b c <p> é ©"),
    ("<p>one<p>two <b>bold</b>er<br>line<div>three</div>four", "one\n\ntwo bolder line\n\nthree\n\nfour"),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a\n\nb\n\nc\n\nd"),
    ("<!-- no <p>x</p> --><style>p{}</style><p title='a>b'>yes</p><script>'</p>'</script >", "yes"),
    ("<p><b>open<p>next</b> one", "open\n\nnext one"),
    ("<nav>menu</nav>text <a href=x>link</a> on", "text link on"),
    ("<div class=sidebar>s</div><div class='entry content'>main<div class=share>tweet</div></div>x", "main"),
    ("<p>a <", "a <"), ("a < b > c", "a < b > c"), ("<p>cut <a href='", "cut"), ("<script>x", ""), ("   ", ""),
    ("<article>a<footer>f</footer><div class=comments>r</div></article><p>b</p>", "a"),
    ("<main><h1>t</h1><article>one</article><article>two</article></main>", "t\n\none\n\ntwo"),
    ("<div hidden>h</div><div style='display: none'>n</div><div role=navigation>r</div>v", "v"),
    ("</div></p></b>x</html>", "x"), ("<P>A</P><ARTICLE>B</ARTICLE>", "B"),
]


@pytest.mark.parametrize("source, want", CASES)
def test_single_pages(source, want):
    assert pt.main_text(source) == want


def test_very_long_pages_and_none(spark):
    text = prose(3, 50_000)
    deep = "<b>" * 20_000 + "x" + "<p>" * 2_000 + "y"
    docs = spark.createDataFrame([(1, "http://h/", f"<article><p>{text}</article>"), (2, "http://h/", deep),
                                  (3, "http://h/", "<" * 50_000), (4, "http://h/", "&amp;" * 50_000)], PAGES)
    got = {r.page_id: r.text for r in pt.extract_pages(docs).collect()}
    assert got[1] == text and got[2] == "x\n\ny" and got[3] == "<" * 50_000 and got[4] == "&" * 50_000
    assert pt.extract_pages(docs.limit(0)).collect() == []

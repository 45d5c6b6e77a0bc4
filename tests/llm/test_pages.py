"""Operators on pages and vectors against plain versions, and on awkward rows."""

import html as entities
import re

import brute
import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

from ebbtide.llm import projections, registered, site_style, url_rules
from ebbtide.llm.registered import URL_RULES

PAGES = "page_id long, url string, html string, HOST string, path string, tid int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 3) for r in rows], PAGES)


def article(html):
    """Blocks of the article element of the pages here, by plain patterns."""
    inner = re.search(r"<article>(.*?)(</article>|$)", html, re.S)[1]
    blocks = re.split(r"</?(?:p|h1|br|li|ul|div)\b[^>]*>", inner)
    texts = (" ".join(entities.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in blocks)
    return "\n".join(t for t in texts if t)


def test_articles_of_the_corpus(spark, folder):
    known = {r["page_id"]: r for r in pq.read_table(f"{folder}/pages.parquet").to_pylist()}
    out = registered.op3_site_style(spark, folder).collect()
    assert len(out) == len(known)
    for r in out:
        assert r["text"] == article(known[r["page_id"]]["html"])
        assert r["n_chars"] == len(r["text"]) and r["url"] == known[r["page_id"]]["url"]


def text_of(html):
    return "\n".join(t for _, mark, t in site_style.parse(html)[0] if mark >= 0)


@pytest.mark.parametrize("html, want", [
    ("", ""), ("plain  text\n here", "plain text here"),
    ("<p>a&amp;b&nbsp;c &#233;<p>d<br>e", "a&b c é\nd\ne"),
    ("<header>H</header><p>x</p><footer>F</footer><aside>s</aside>", "x"),
    ("<main><p>x</p><div class='comments'><p>no</p></div><form>q<input></form></main>out", "x"),
    ("<div class='ad'>buy<article><p>x</p></article>", "x"),
    ("<div id='cookie-notice'>ok?</div><div class='article-header'>T</div>", "T"),
    ("<p hidden>no</p><p style='display: none'>no</p><p>yes</p>", "yes"),
    ("<script>var a='<p>x</p>';</script><style>p{}</style><!-- c --><p>t</p><noscript>n", "t"),
    ("<ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table>", "a\nb\n1\n2\n3"),
    ("<p>a <b>bold <i>it</b> x</p></div></section> y", "a bold it x\ny"),
    ("<title>t</title><body>x<select><option>o</select><textarea>z</textarea>", "x")])
def test_blocks(html, want):
    assert text_of(html) == want


def test_deep_pages_keep_their_text():
    for tag in ("div", "i"):
        html = f"<{tag}>" * 50_000 + "<p>x</p><p>y" + f"</{tag}>" * 50_000 + "<p>z"
        assert text_of(html) == "x\ny\nz"


@pytest.mark.parametrize("html, want", [
    ("<div class='wrap has-sidebar'><article><p>x</p></article></div><p>out</p>", "x"),
    ("<div class='content comment-enabled'><p>x</p><div class='comments'>no</div></div>", "x"),
    ("<div class='content sidebar'><p>x</p></div>", "x"),
    ("<div class='post-comments'><p>no</p></div><p>x</p>", "x"),
    ("<article>" + "<b>" * 600 + "<p>one</p><p>two</p><nav>menu</nav></article>", "one\ntwo"),
    ("<div>" * 600 + "<article><p>one</p><nav>menu</nav></article>", "one"),
    ("<p>a <span hidden>no <span>no</span> no</span> b", "a b"),
    ("<ul><li>" * 20_000 + "deep<aside>no</aside>", "deep")])
def test_names_and_depth(html, want):
    assert text_of(html) == want


def test_repeated_footers_go_and_repeated_headings_stay(spark):
    rows = [(i, f"http://blog.example/{i}", f"<div class='wrap has-sidebar'><article><p>Story {i}."
             "</p></article></div><div class='line'><p>Same line on all pages</p></div>")
            for i in range(8)]
    rows += [(10 + i, f"http://cook.example/{i}", f"<main><h2>Ingredients</h2><ul><li>Salt</li></ul>"
              f"<p>Dish {i} is made so.</p><h2>Conclusion</h2><p>Serve at {i}.</p>"
              "<div class='x'><h3>More</h3><p>Read all that we print.</p></div></main>")
             for i in range(8)]
    out = {r["page_id"]: r["text"] for r in site_style.main_text(pages(spark, rows)).collect()}
    for i in range(8):
        assert out[i] == f"Story {i}."
        assert out[10 + i] == (f"Ingredients\nSalt\nDish {i} is made so.\nConclusion\n"
                               f"Serve at {i}.")


def test_style_tree_removes_what_a_site_repeats(spark):
    menu = "<div><span>Home</span> <span>News</span></div>"
    foot = "<section><p>All our pages say this.</p></section>"
    rows = [(i, f"http://Site.example/{i}", f"<html><body>{menu}<table><tr><td><p>Story number {i}"
             f" is its own.</p><p>It goes on {i * 7}.</p></td></tr></table>{foot}</body></html>")
            for i in range(12)]
    rows.append((99, "http://other.example/", f"<body>{menu}<p>alone</p></body>"))
    out = {r["page_id"]: r["text"] for r in site_style.main_text(pages(spark, rows)).collect()}
    for i in range(12):
        assert out[i] == f"Story number {i} is its own.\nIt goes on {i * 7}."
    assert out[99] == "Home News\nalone"


def test_style_tree_decides_inside_and_outside_of_marked_articles(spark):
    box = "<div class='x'><p>Read all that we print.</p></div>"
    rows = [(i, f"http://in.example/{i}", f"<main>{box}<p>Story {i} here.</p></main>out {i}")
            for i in range(6)]
    rows += [(10 + i, f"http://teased.example/{i}",
              f"<div class='a'><p>Body {i} of the page.</p></div><div class='b'><p>Same foot.</p>"
              "</div><aside><article><p>Teaser</p></article></aside><article><p>Now</p></article>")
             for i in range(6)]
    rows += [(20 + i, f"http://copies.example/{i}", "<main><p>One text.</p></main>")
             for i in range(6)]
    rows += [(30, "http://lone.example/", f"<main>{box}<p>Alone.</p></main>")]
    out = {r["page_id"]: r["text"] for r in site_style.main_text(pages(spark, rows)).collect()}
    for i in range(6):
        assert out[i] == f"Story {i} here."
        assert out[10 + i] == f"Body {i} of the page."
        assert out[20 + i] == "One text."
    assert out[30] == "Read all that we print.\nAlone."


def test_awkward_pages(spark):
    rows = [(None, None, None), (1, None, "<p>a"), (1, None, "<p>a"), (2, "x", ""),
            (3, "http://h/", "<p>" + "long " * 200_000)]
    out = sorted((str(r["page_id"]), r["url"], r["n_chars"])
                 for r in site_style.main_text(pages(spark, rows)).collect())
    assert out == [("1", None, 1), ("1", None, 1), ("2", "x", 0), ("3", "http://h/", 999_999),
                   ("None", None, 0)]
    assert site_style.main_text(pages(spark, [])).count() == 0
    assert url_rules.judge_urls(pages(spark, []), URL_RULES).count() == 0


URLS = [
    "http://a.example.net/en/x", "https://EXAMPLE.NET/en/", "http://example.net/enx",
    "http://example.net", "http://net/", "http://xnet/", "http://a.b.net/q?x#y",
    "http://example.com/de/1", "http://example.com/DE/1", "http://m.example.com/de", "org/fr/",
    "http://org/fr/a", "ftp://x.org/fr/?q", "http://x.org?/fr/", "http://x.org#/fr/", "", None,
    "no scheme.net/", "://net/", "http://net/://example.net/en/", "http://É.net/ü",
    "http://foo.com/x.net/", "http://x.net*/", "http://a" + "b" * 5000 + ".net/en/",
    "http://example.net/en/\nline", "http://user@host.net:80/"]


def test_urls_match_their_sql(spark):
    rows = [(i, u, "") for i, u in enumerate(URLS)]
    got = sorted(map(tuple, url_rules.judge_urls(pages(spark, rows), URL_RULES).collect()))
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", [(i, u) for i, u, _ in rows])
    want = sorted(con.execute(url_rules.urls_sql(URL_RULES)).fetchall())
    assert got == want
    assert [v for *_, v in got][:3] == ["allow", "allow", "block"]


def test_globs_match_a_plain_automaton():
    draw = np.random.default_rng(3)
    pick = lambda letters, n: "".join(draw.choice(list(letters), n))
    patterns = [pick("ab*?", draw.integers(1, 30)) for _ in range(40)]
    texts = [pick("ab", draw.integers(0, 25)) for _ in range(200)]
    found = url_rules.Globs([p.encode() for p in patterns]).match([t.encode() for t in texts])
    for j, pattern in enumerate(patterns):
        plain = re.compile("".join({"*": ".*", "?": "."}.get(c, c) for c in pattern))
        assert [bool(plain.fullmatch(t)) for t in texts] == found[:, j].tolist()


def brute_links(rows, least=0.9):
    fine = {i: np.array(v, float) for i, v in rows if v and None not in v
            and np.isfinite(np.array(v, float)).all() and np.any(v)}
    pairs = [(a, b) for a in fine for b in fine if b < a and len(fine[a]) == len(fine[b])
             and fine[a] @ fine[b] / np.linalg.norm(fine[a]) / np.linalg.norm(fine[b]) >= least]
    n = {i: 0 for i, _ in rows}
    for a, b in pairs:
        n[a] += 1
        n[b] += 1
    root = brute.groups([i for i, _ in rows], pairs)
    return {i: (n[i], root[i], root[i] == i) for i, _ in rows}


def vectors(spark, rows):
    return spark.createDataFrame(
        [(i, v, 1, 2, 3) for i, v in rows],
        "vec_id long, embedding array<float>, label int, node int, tile int")


def test_awkward_vectors(spark):
    draw = np.random.default_rng(4)
    base = draw.standard_normal(16)
    rows = [(i, (base + 0.05 * draw.standard_normal(16)).tolist()) for i in range(40)]
    rows += [(100 + i, draw.standard_normal(16).tolist()) for i in range(60)]
    rows += [(200 + i, rows[0][1]) for i in range(30)]
    rows += [(300, None), (301, []), (302, [0.0] * 16), (303, [float("nan")] + [1.0] * 15),
             (304, [None] + [1.0] * 15), (305, [float("inf")] + [0.0] * 15), (306, [1.0, 2.0]),
             (307, [2.0, 4.0]), (308, [0.0] * 16), (309, [1e30] * 16), (310, [1e-30] * 16)]
    rows = [(i, v if v is None else [x if x is None else float(np.float32(x)) for x in v])
            for i, v in rows]
    out = projections.embedding_links(vectors(spark, rows), block=8).collect()
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in out}
    want = brute_links(rows)
    assert len(out) == len(rows)
    assert sum(v[0] for v in got.values()) >= 0.9 * sum(v[0] for v in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)
    assert {i: got[i] for i in range(300, 309)} == {i: want[i] for i in range(300, 309)}
    assert got[0] == want[0] and got[229] == want[229]
    assert projections.embedding_links(vectors(spark, [])).count() == 0


def test_a_group_larger_than_a_block_is_found_whole(spark):
    draw = np.random.default_rng(6)
    base = draw.standard_normal(16)
    rows = [(i, (base + 0.01 * draw.standard_normal(16)).tolist()) for i in range(150)]
    out = projections.embedding_links(vectors(spark, rows), block=16, passes=4).collect()
    assert {r["n_links"] for r in out} == {149} and {r["component_id"] for r in out} == {0}


def test_recall_in_a_crowd_of_many_blocks():
    """Vectors at mutual cosine 0.7, hundreds of blocks of them, with pairs at 0.9 among them."""
    draw = np.random.default_rng(8)
    centre = projections.unit(draw.standard_normal((1, 32)))

    def aside(n, *axes):
        out = draw.standard_normal((n, 32))
        for axis in axes:
            out -= np.einsum("ij,ij->i", out, np.broadcast_to(axis, out.shape))[:, None] * axis
        return projections.unit(out)

    own = aside(4000, centre)
    turned = 2 / 3 * own[:300] + np.sqrt(5 / 9) * aside(300, centre, own[:300])
    crowd = np.sqrt(0.7) * centre + np.sqrt(0.3) * np.concatenate([own, turned])

    def met(units, passes, block=8):
        """Pairs in one tile or two neighbouring ones, in any pass."""
        found = np.zeros(300, bool)
        for number in range(passes):
            key, along = projections.pass_keys(units, number)
            place = np.empty(len(units), np.int64)
            place[np.lexsort((along, key))] = np.arange(len(units))
            tile = place // block
            found |= np.abs(tile[:300] - tile[4000:]) <= 1
        return found.sum()

    assert met(crowd, projections.PASSES) < 0.9 * 300
    assert met(crowd, projections.passes_for(crowd, len(crowd), 0.9, 8)) >= 0.9 * 300


def test_recall_on_the_corpus(spark, folder):
    known = [(r["vec_id"], r["embedding"])
             for r in pq.read_table(f"{folder}/embeddings.parquet").to_pylist()]
    want = brute_links(known)
    got = {r["vec_id"]: r["n_links"] for r in registered.op9_projections(spark, folder).collect()}
    assert got.keys() == want.keys()
    assert sum(got.values()) >= 0.9 * sum(v[0] for v in want.values())

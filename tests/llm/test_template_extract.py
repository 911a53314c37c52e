import random

from brickyard.llm import template_extract as T

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body class="home">
<header><h2>Site</h2></header><nav><a href=/>Home</a></nav><div class="ad-box">Buy</div><div id=cookie-notice>We use cookies</div>
<main><h1>The  title &amp; more</h1><p>First <b>bold</b>
line<p>Second &eacute;&#33; &lt;p&gt; <script>var x = "</p><p>no</p>"</script>end<ul><li>one<li>two</ul>
<form>Mail <input></form><aside>side</aside><section class="comments"><p>reader says</p></section><div hidden>h</div></main>
<footer>foot</footer></body></html>"""


def test_main_text():
    assert T.main_text(PAGE) == "The title & more\nFirst bold line\nSecond é! <p> end\none\ntwo"
    assert T.main_text(None) == T.main_text("") == T.main_text("<p") == T.main_text("<!-- x") == ""
    assert T.main_text("plain &amp text < 3") == "plain & text < 3"
    assert T.main_text("<p>a<br>b</p>tail<div>c") == "a b\ntail\nc"
    assert T.main_text("<article><p>x</p></article><p>out</p>") == "x"
    assert T.main_text("<p title='a>b'>q</p><p>r") == "q\nr"
    assert T.main_text("<article><header><h1>H</h1></header>t<footer>f</footer></article>") == "H\nt"
    assert T.main_text("<div class='page with-sidebar'><div class=sidebar>s</div><main><p>x</p><nav>n</nav></main></div>") == "x"
    assert T.main_text("<article><p>a</p><section id='comments'><article><p>c</p></article></section></article>") == "a"
    long = "word " * 200_000
    assert T.main_text(f"<p>{long}</p>") == long.strip()


def test_attributes():
    """A quote opens a value only after an equals sign."""
    assert T.main_text("<p data-x=it's>One</p><p>Don't stop</p>") == "One\nDon't stop"
    assert T.main_text("<p data-x=it's>One") == "One"
    assert T.main_text("""<p a="x>y" b='z>"' c = "q" 'd>One""") == "One"
    assert T.main_text("<div data-x='a class=ad b'>kept</div>") == "kept"
    assert T.main_text("<div hidden>no</div><div data-hidden>yes</div>") == "yes"


def test_implied_ends():
    """Items, cells and rows end by the next one; a block ends a paragraph however deep, but not across a cell."""
    assert T.main_text("<ul><li><form>Buy<li>real item</ul>") == "real item"
    assert T.main_text("<table><tr><td><nav>x<td>real cell<tr><td>next</table>") == "real cell\nnext"
    assert T.main_text("<ul><li>a<ul><li>b<li>c</ul><li>d</ul>") == "a\nb\nc\nd"
    assert T.main_text("<dl><dt>a<dd>b<dt>c</dl>") == "a\nb\nc"
    assert [t.path for t in T.page_tokens("<p><i><b><u><s><a>x<div>y") if t.text] == ["/p/i/b/u/s/a", "/div"]
    assert [t.path for t in T.page_tokens("<p><table><tr><td>x<div>y") if t.text][1].endswith("td/div")


def test_class_names_are_a_prior():
    """A class name leaves out what most of its telling parts mark, and never an article, a paragraph or a heading."""
    assert T.main_text("<article class='post social'><p>story</p></article>") == "story"
    assert T.main_text("<article><div class='search-and-rescue related'>team</div><p class='ad hoc'>group</p></article>") == "team\ngroup"
    assert T.main_text("<article><p>x</p><div class='ad-box'>buy</div><div class='related-posts'>more</div><div id=cookie-notice>ok</div></article>") == "x"
    assert T.hinted(["col-md-4", "sidebar"]) and not T.hinted(["menu-of-the-day"]) and not T.hinted(["col-md-4"]) and not T.hinted([])


def test_references_are_decoded_run_by_run():
    assert T.main_text("<p>AT&<b>lt;</b> &lt;b&gt; &amp;amp;</p>") == "AT&lt; <b> &amp;"


def pages(host, n, body):
    return [(f"https://{host}/{i}", f"<html><body><div class=top>Welcome to {host}</div><div class=c>{body(i)}</div><div>Send us a letter</div></body></html>") for i in range(n)]


def table(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash") for i, (u, h) in enumerate(rows)], "page_id long, url string, html string, template string").repartition(3)


def test_template_runs_leave(spark, monkeypatch):
    monkeypatch.setattr(T, "FLUSH_TOKENS", 60)
    rows = pages("a.example", 40, lambda i: f"<p>Story {i}</p><p>{'Same' if i % 2 else 'Other'} ending</p>")
    rows += pages("b.example", 4, lambda i: f"<p>Tale {i}</p>")
    rows += [(None, None), ("nohost", ""), ("https://a.example/9", rows[9][1])]
    got = {r.page_id: r for r in T.extract(table(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i in range(40):
        assert got[i].text == f"Story {i}\n{'Same' if i % 2 else 'Other'} ending"
        assert got[i].n_chars == len(got[i].text) and got[i].url == rows[i][0]
    # too few pages to tell a template from content
    assert got[40].text == "Welcome to b.example\nTale 0\nSend us a letter"
    assert got[44].text == got[45].text == "" and got[46].text == got[9].text


def test_classes_nest(spark):
    rows = pages("a.example", 20, lambda i: "<p>x</p>" if i % 10 else "<p>y</p><ul><li>z</li></ul>")
    found = T.templates(table(spark, rows)).collect()
    by_size = {frozenset(t.run for t in r.tokens if t.run): r for r in found}
    top = by_size[frozenset({"Welcome to a.example", "Send us a letter"})]
    assert top.support == top.pages == 20 and top.parent is None
    assert all(r.parent is None or r.parent in {x["class"] for x in found} for r in found)


def test_copies_are_content(spark):
    """A group of copies on a host is no template, however large its share of other hosts."""
    rows = pages("c.example", 30, lambda i: "<article><p>Copied text</p></article>" if i < 20 else f"<article><p>Own {i}</p></article>")
    got = {r.page_id: r.text for r in T.extract(table(spark, rows)).collect()}
    assert got[0] == "Copied text" and got[25] == "Own 25"


def test_empty(spark):
    assert T.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_repeated_pages_keep_their_text(spark):
    """Copies of a page vote once, and what repeats inside an article stays."""
    shell = "<html><body><div class=top>Top</div>{}<div>Letter</div><footer>{}</footer></body></html>"
    rows = [(f"https://copies.example/{i}", shell.format("<article><h1>Head</h1><p>Same story</p></article>", "")) for i in range(10)]
    rows += [(f"https://plain.example/{i}", shell.format("<p>Same tale</p>", i)) for i in range(10)]  # only footers differ
    rows += [(f"https://head.example/{i}", shell.format(f"<main><h1>Our series</h1><p>Part {i}</p></main>", "")) for i in range(10)]
    rows += [(f"https://many.example/{i}", shell.format(f"<p>{'Copied' if i < 90 else f'Own {i}'}</p>", "")) for i in range(100)]
    got = {r.url: r.text for r in T.extract(table(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i in range(10):
        assert got[f"https://copies.example/{i}"] == "Head\nSame story"
        assert got[f"https://plain.example/{i}"] == "Top\nSame tale\nLetter"
        assert got[f"https://head.example/{i}"] == f"Our series\nPart {i}"
        assert got[f"https://many.example/{i}"] == "Copied" and got[f"https://many.example/{i + 90}"] == f"Own {i + 90}"


def plain_host(n, story=lambda i: "", host="plain.example"):
    """No article, no main, no telling class name: the links, the line about the weather and the letter box differ from page to page."""
    r = random.Random(1)
    words = lambda k: " ".join(f"w{r.randrange(5000)}" for _ in range(k))
    out = []
    for i in range(n):
        links = "".join(f"<a href=/{r.randrange(99)}>go {r.randrange(9999)}</a> " for _ in range(8))
        text = [words(60), words(50)]
        out.append((f"https://{host}/{i}", f"<html><body><div class=a1>Daily news</div><div class=a2>{links}</div><div class=a3>rain {r.randrange(99)}</div>"
                    f"<div class=b><h1>Title {i}</h1><div class=c><p>{text[0]}</p><p>{story(i)}{text[1]}</p></div></div>"
                    f"<div class=a4>Write to us, reader {r.randrange(999)}</div><div class=a5>All rights kept</div></body></html>",
                    f"Title {i}\n{text[0]}\n{story(i)}{text[1]}"))
    return out


def test_article_without_telling_tags(spark, monkeypatch):
    """The host's classes find the article; without classes the page stays as it is."""
    rows = plain_host(40, lambda i: "As we always say: " if i % 3 else "")
    df = table(spark, [r[:2] for r in rows])
    got = {r.page_id: r.text for r in T.extract(df).collect()}
    assert got == {i: r[2] for i, r in enumerate(rows)}
    monkeypatch.setattr(T, "CLASS_PAGES", 10**6)   # no class is valid
    without = {r.page_id: r.text for r in T.extract(df).collect()}
    assert all(r[2] != without[i] and "Daily news" in without[i] and "rain" in without[i] for i, r in enumerate(rows))


def test_shuffled_host_rows_give_the_same(spark, monkeypatch):
    rows = plain_host(20)
    monkeypatch.setattr(T, "BROADCAST_BYTES", 0)
    assert {r.page_id: r.text for r in T.extract(table(spark, [r[:2] for r in rows])).collect()} == {i: r[2] for i, r in enumerate(rows)}


def test_wide_rows_beside_an_article_lose(spark):
    """Text outside the article wins only if it holds far more: here the article stays."""
    r = random.Random(2)
    body = lambda i, n: " ".join(f"w{r.randrange(999)}" for _ in range(n))
    rows = [(f"https://x.example/{i}", f"<html><body><div class=q>{body(i, 60)}</div><article><p>{(own := body(i, 30))}</p></article><div>Fixed end</div></body></html>", own)
            for i in range(20)]
    got = {x.page_id: x.text for x in T.extract(table(spark, [x[:2] for x in rows])).collect()}
    assert got == {i: x[2] for i, x in enumerate(rows)}


def brute_classes(rows):
    """Equal occurrence vectors over the distinct main regions of one host, by dictionaries."""
    votes = {}
    for _, html in rows:
        votes.setdefault(T.main_text(html), html)
    pages = list(votes.values())
    counts = []
    for html in pages:
        c = {}
        for t in T.page_tokens(html):
            if t.kind == "tag" or t.kind == "text" and T._run(t.text):
                k = T._token_key(t.kind, t.path, T._run(t.text))
                c[k] = c.get(k, 0) + 1
        counts.append(c)
    by_vector = {}
    for k in set().union(*counts):
        by_vector.setdefault(tuple(c.get(k, 0) for c in counts), set()).add(k)
    need = max(T.CLASS_PAGES, T.CLASS_SHARE * len(pages))
    return {frozenset(ks) for v, ks in by_vector.items() if sum(map(bool, v)) >= need and len(ks) >= T.CLASS_TOKENS}


def test_classes_against_brute_force(spark):
    r = random.Random(3)
    rows = [(f"https://c.example/{i}", f"<html><body><div class=top>Top</div><ul>{'<li>x</li>' * (i % 3)}</ul><div class=z>{'<p>Often</p>' if i % 10 else ''}<p>s{i}</p></div>"
             f"{'<hr><div>End</div>' if i % 9 else ''}</body></html>") for i in range(30)]
    rows += [rows[4]] * 5 + [rows[r.randrange(30)] for _ in range(5)]
    found = T.classes(table(spark, rows), by_region=True).collect()
    assert {frozenset(x & (2**64 - 1) for x in f.tokens) for f in found} == brute_classes(rows)


def test_very_long_page_and_clashing_names(spark):
    rows = plain_host(12)
    long = "word " * 300_000
    rows.append((rows[0][0], rows[0][1].replace("</p></div>", f" {long}</p></div>"), rows[0][2] + f" {long.strip()}"))
    df = spark.createDataFrame([(i, u, h, "x", 1) for i, (u, h, _) in enumerate(rows)], "page_id long, url string, html string, host string, slots int")
    assert {r.page_id: r.text for r in T.extract(df).collect()} == {i: r[2] for i, r in enumerate(rows)}

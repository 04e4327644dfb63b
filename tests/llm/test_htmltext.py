"""HTML extraction: hand-made pages with known main text, host consensus, edge rows."""

from civora.llm import htmltext as H

ARTICLE = ("<h1>Title &amp; more</h1><p>First <b>bold</b>  para\n graph with &eacute; and enough words to count."
           "<p>Second one,<br>with a <a href='/x'>link</a> inside it.<ul><li>item one<li>item two</ul>")
MAIN = ("Title & more\nFirst bold para graph with é and enough words to count.\n"
        "Second one, with a link inside it.\nitem one\nitem two")


def wrap(article, before="", after=""):
    return (f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a='</p><p>no';</script></head>"
            f"<body class=has-sidebar><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>{before}"
            f"{article}{after}<footer>&copy; us</footer></body></html>")


NOISE = ("<div class='cookie-notice'>We use cookies on this site and many more words about it than the article has, "
         "really very many words that go on and on until nobody reads them any more at all.</div>"
         "<!-- ad <p>no</p> --><div class=\"ad\">Buy this now</div><aside><p>Side text that is long long long</p></aside>"
         "<form><label>Mail</label><input><p>Sign up here</p></form><div id='sidebar-2'>More side</div>")
COMMENTS = ("<section class='comments'><article class='comment'><p>I think this comment is longer than all of the "
            "article text together, so a plain length rule would pick it instead of the article.</p></article></section>")


def main(html, winners=()):
    return H.Page(html).main_text(list(winners))[0]


def test_known_pages():
    assert main(wrap(f"<article>{ARTICLE}</article>", NOISE, COMMENTS + NOISE)) == MAIN
    assert main(wrap(f"<div class='post-12 content'>{ARTICLE}</div>", NOISE, COMMENTS)) == MAIN
    assert main(wrap(f"<main><article>{ARTICLE}<footer>by me</footer><div class=share>share</div></article></main>",
                     NOISE)) == MAIN
    assert main(wrap(f"<article><header><h1>Title &amp; more</h1></header>{ARTICLE.partition('</h1>')[2]}</article>")) == MAIN
    assert main(f"<p>{'bare text ' * 5}<p>two &lt; three &amp &am") == "bare text bare text bare text bare text bare text\ntwo < three & &am"
    assert main("<article><h1>Cut</h1><p><b>never closed") == "Cut\nnever closed"
    for empty in ("", "   ", "<html><body></body></html>", "<script>only", "<!-- open", "<nav>x</nav>"):
        assert main(empty) == ""


def test_parts_around_the_heaviest_container():
    long, other = "long body words " * 20, "other part words " * 9
    body = f"<div class=body><p>{long}</p></div>"
    want = f"Title\nLead\n{long.strip()}"
    assert main(wrap(f"<article><h1>Title</h1><p>Lead</p>{body}</article>")) == want
    assert main(wrap(f"<main><h1>Title</h1><p>Lead</p><article>{body}</article></main>")) == want
    assert main(wrap(f"<div class=post><h1>Title</h1><p>Lead</p>{body}</div>", NOISE)) == want
    for a, b in (("section", "section"), ("div class=part", "div")):
        assert main(wrap(f"<article><{a}><p>{long}</{b}><{a}><p>{other}</{b}></article>")) == f"{long.strip()}\n{other.strip()}"
    assert main(wrap(f"<div id=w><div class=part><p>{long}</div><div class=part><p>{other}</div></div>")) == f"{long.strip()}\n{other.strip()}"
    assert main(wrap(f"<div id=w>{body}<div class=teaser><p>Read on</p></div></div>")) == long.strip()
    listing = f"<main><article><p>{long}</article><article><p>{other}</article></main>"
    assert main(wrap(listing)) == f"{long.strip()}\n{other.strip()}"  # one path, every container with it
    assert main("<div>" * 20_000 + "deep") == "deep"
    assert H.Page(wrap(f"<article><h1>Title</h1>{body}</article>")).best()[0] == "body>article"


def test_unwanted_inline_elements():
    inner = "<span>in</span> " * 3000
    assert main(f"<article><p>Start <span class=ad>buy {inner} now</span> end</article>") == "Start end"
    assert main("<article><p>Start <span class=ad>never <b>closed</b></article>") == "Start never closed"
    assert main("<article><p>" + "<span class=ad>x" * 20_000 + "</article>") == "x" * 20_000


def test_two_templates_of_a_host(spark):
    one = wrap("<article><h1>T</h1><div class=body><p>" + "true words " * 20 + "</p></div></article>")
    two = wrap("<div class=text><p>" + "old words " * 20 + "</p></div><div class=teaser><p>short</p></div>")
    rows = [(i, "https://h.example.org/", (one, two)[i % 2]) for i in range(20)] * 2
    got = H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == 40 and {r.text for r in got} == {"T\n" + ("true words " * 20).strip(), ("old words " * 20).strip()}


def test_consensus_of_a_host(spark):
    good = lambda i: wrap(f"<div class='text t{i}'><p>{'true words ' * 20}{i}</p></div><div class=teaser><p>short</p></div>")
    odd = wrap("<div class='text t9'><p>true</p></div><div class=teaser><p>" + "teaser words " * 30 + "</p></div>")
    rows = [(i, f"https://H.example.org/{i}", good(i)) for i in range(30)] + [(99, "https://h.example.org:80/99", odd)]
    rows += [(100, "https://other.org/", odd), (101, None, None), (102, "nonsense", ""), (103, "http://e/", "<p>x" * 30_000)]
    df = spark.createDataFrame([(*r, "own") for r in rows], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in H.extract(df.repartition(5)).collect()}
    assert len(got) == len(rows)
    assert got[3].text == "true words " * 20 + "3"
    assert got[99].text == "true"  # the host's path, not the longest container
    assert got[100].text.startswith("teaser words")  # alone on its host: its own best
    assert got[101].text == got[102].text == "" and got[101].n_chars == 0
    assert got[103].text.count("\n") == 29_999
    assert H.extract(df.limit(0)).collect() == []

import html
import random
import re

from tidebook.llm import html_template as h
from tidebook.llm import queries


def test_blocks_entities_and_misnesting():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li>Home</li></ul></nav>
    <!-- ad --><div class="ad">Buy</div><article class="post"><h1>Ti&amp;tle</h1><p><b>First   line<br>goes&nbsp;on<p>Second &lt;b&gt; &#233; <i>it</i>em<ul><li>one<li>two</ul>
    <aside>side</aside><form>name <input></form><div class="comments">reader</div><div role="navigation">x</div><p hidden>gone</p><table><tr><td>a<td>b<tr><td>c</table></article>
    <footer>&copy; x</footer></body></html>"""
    assert h.main_text(page) == "Ti&tle\nFirst line goes on\nSecond <b> é item\none\ntwo\na b\nc"
    assert h.main_text(None) == "" == h.main_text("") == h.main_text("<html><body><nav>x</nav></body></html>")
    assert h.main_text("just text < 3 & more") == "just text < 3 & more"
    assert h.main_text("<p>" * 20_000 + "deep") == "deep"
    assert h.main_text("<p>unclosed <a href='x") .startswith("unclosed")
    assert h.main_text("<div>" + "word " * 100_000 + "</div>") == ("word " * 100_000).strip()


PARAGRAPH = "Unique paragraph {} {} with several words of text in it"


def plain_page(i, extra="", before=""):
    """A page without semantic tags or telling names: menu, notice, body, label and legal line."""
    body = "".join(f"<p>{PARAGRAPH.format(i, k)}</p>" for k in range(1 + i % 4))
    return (
        f"<html><body><div><span><a href='/'>Home</a> <a href='/b'>Menu entry</a></span></div>{before}"
        f"<div><div class='x'>{body}</div>{extra}</div><div><p>All rights kept by us</p></div></body></html>"
    )


def body_of(i):
    return "\n".join(PARAGRAPH.format(i, k) for k in range(1 + i % 4))


def slow_slots(pages):
    """{host: (main, fixed, {token: up class})} by plain loops over the distinct pages of each host."""
    import re as _re

    hosts = {}
    for url, page in pages:
        m = _re.match(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", url or "")
        if m:
            hosts.setdefault(m[1].lower(), {})[page] = h.profile(page)
    out = {}
    for host, seen in hosts.items():
        if len(seen) < 2:
            continue
        order = list(seen.values())
        info, vector = {}, {}
        for at, prof in enumerate(order):
            for token, (n, parent, kind, chars, linked, depth) in prof.items():
                was = info.setdefault(token, [parent, kind, 0, 0, depth, 0, 0])
                was[2] += chars
                was[3] += linked
                was[5] += 1
                was[6] = max(was[6], n)
                vector.setdefault(token, [0] * len(order))[at] = n
        classes = {}
        for token, v in vector.items():
            classes.setdefault(tuple(v), []).append(token)
        class_of = {t: min(ts) for ts in classes.values() for t in ts}
        valid = {t for ts in classes.values() for t in ts if len(ts) >= h.LARGE and info[t][5] >= min(h.FREQUENT, len(order))}
        root = [t for t in valid if info[t][6] == 1 and info[t][5] >= h.ROOT * len(order) and info[t][1] in (1, 3)]
        up_class = {}
        for t in info:
            up = info[t][0]
            while up and up not in valid:
                up = info[up][0]
            up_class[t] = class_of[up] if up else 0
        main = None
        if root:
            value = {t: info[t][2] - 2 * info[t][3] for t in root}
            top = max(value.values())
            main = max((info[t][1] == 1, info[t][4], value[t], t) for t in root if value[t] >= h.MOST * top)[3]
        fixed = {t for t in valid if info[t][1] != 2 and (texts := [x for x in info if info[x][1] == 2 and info[x][0] == t]) and all(x in valid for x in texts)}
        out[host] = (main, sorted(fixed), up_class)
    return out


def test_deduction_against_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for i in range(60):
        host = rng.choice(["a.example", "b.example", "c.example", "single.example"] if i < 40 else ["a.example", "b.example"])
        extra = rng.choice(["", "<div class='k'><p>Buy our things</p></div>", "<section><i>Read more</i></section><section><i>Read more</i></section>", f"<div class='k'><p>Note {rng.randint(0, 2)}</p></div>"])
        rows.append((i, f"https://{host}/{i}", plain_page(rng.randint(0, 30), extra, "<nav>Menu</nav>" * rng.randint(0, 1))))
    rows += [(200, "https://two.example/1", plain_page(1)), (201, "https://two.example/2", plain_page(2)), (202, "https://two.example/2", plain_page(2))]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    known = h.template(df)
    got = {r["host"]: (r["main"], r["fixed"] or []) for r in h.main_slots(known).collect()}
    nested = {}
    for r in known.collect():
        nested.setdefault(r["host"], {})[r["token"]] = r["up_class"]
    want = slow_slots([(u, p) for _, u, p in rows])
    assert {k: (m, f) for k, (m, f, _) in want.items() if m} == got
    assert {k: up for k, (_, _, up) in want.items()} == nested
    assert len(got) >= 3 and any(f for _, f in got.values())
    texts = {r["page_id"]: r["text"] for r in h.extract(df).collect()}
    for i, url, page in rows:
        main, fixed, _ = want.get(url.split("/")[2], (None, [], {}))
        assert texts[i] == h.main_text(page, main, frozenset(fixed))


def test_template_finds_the_slot_without_semantic_tags(spark):
    notice = "<div class='k'><p>Our site keeps small files on your machine</p></div>"
    label = "<div class='q'><a href='#'>Read</a> <i>more</i></div>"
    pages = [plain_page(i, (notice if i % 2 else "") + (label * 2 if i % 3 else "")) for i in range(12)]
    rows = [(i, f"https://a.example/{i}", p) for i, p in enumerate(pages)]
    rows += [(100, None, rows[0][2]), (101, "no host", ""), (102, "https://b.example/", None), (0, rows[0][1], rows[0][2])]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'x' AS host", "'y' AS text", "1 AS token", "2 AS salt", "3 AS parts")
    got = h.extract(df).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r["text"] for r in got}
    for i in range(12):
        assert by[i] == body_of(i)
        # Without the template the notice, the label, the menu and the legal line stay.
        assert by[i] != h.main_text(pages[i]) and "Menu entry" in h.main_text(pages[i])
    assert by[101] == "" and by[102] == "" and by[100] == h.main_text(pages[0])
    valid = h.template(df).filter("valid")
    assert valid.filter("root").count() > 3 and valid.filter("up_class <> 0").count() > 3
    assert h.extract(df.limit(0)).count() == 0


def test_identical_pages_and_repeated_rows_keep_their_text(spark):
    same = plain_page(1)
    rows = [(i, f"https://one.example/{i}", same) for i in range(4)] + [(9, "https://rep.example/1", same)] * 3
    near = plain_page(3).replace("Home", "Start")
    rows += [(20, "https://near.example/1", plain_page(3)), (21, "https://near.example/2", near), (22, "https://near.example/3", near.replace("Start", "Begin"))]
    got = h.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert PARAGRAPH.format(3 if r["page_id"] >= 20 else 1, 0) in r["text"] and PARAGRAPH.format(3 if r["page_id"] >= 20 else 1, 1) in r["text"]


def test_query_against_the_articles(spark, sf_dir):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = queries.op3_html(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", article)
        want = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "<br" in p else "", p)).split()) for p in parts]
        assert r["text"] == "\n".join(w for w in want if w)
        assert r["n_chars"] == len(r["text"])

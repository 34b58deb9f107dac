import random
import time

import duckdb
import pytest

from linecraft.llm import html_layout, oracles, url_rules

from .fixtures_llm import CLASH, awkward, empty, same

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
URLS = [
    "https://www.example.net/en/1?x=/de/", "http://EXAMPLE.net/de/2", "https://example.com/de/", "https://a.b.example.com/de/x#y",
    "https://example.com/fr/", "ftp://org/fr/9", "https://x.org/fr", "https://x.org/fr/", "no scheme", "://", "http://", "http:///en/",
    "https://notexample.com/de/", "https://net", "https://net/", "https://net?q", "https://é.org/fr/é", "https://a..net//", "x://y://z.net/",
]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    path = rest[n:]
    m = min([path.find(c) for c in "?#" if c in path] or [len(path)])
    return rest[:n].translate(LOWER), path[:m]


def brute(rows, rules=url_rules.RULES):
    for page, url in rows:
        host, path = split(url)
        fit = [
            (len(h + p), len(h), h + p, v)
            for h, p, v in rules
            if (h == "" or host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        best = max(fit, default=None, key=lambda x: (x[0], x[1], x[3] == "block"))
        yield (page, host, path, best and best[2], best[3] if best else "allow")


def test_judge_equals_brute_force_and_sql(spark):
    df, rows = awkward(spark, enumerate(URLS), "page_id", "url")
    got = url_rules.judge(df, url_rules.rules_frame(spark)).collect()
    same(got, brute(rows))
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar)")
    con.executemany("insert into pages values (?, ?)", rows)
    same(got, con.execute(oracles.URL_RULES_SQL).fetchall())


def test_many_nested_rules_and_a_hot_host(spark):
    hosts = ["a.com", "b.a.com", "c.b.a.com", "d.c.b.a.com", "z.com", "com", ""]
    rules = [(h, p, v) for i, h in enumerate(hosts) for j, p in enumerate(("/", "/x/", "/x/y", "")) for v in [("allow", "block")[(i + j) % 2]]]
    rules += [("a.com", "/x/", "block"), ("a.com", "/x/", "allow")]
    urls = [f"http://{h}{p}{i % 7}" for i, h in enumerate((hosts[:6] + ["b.a.com"] * 40) * 9) for p in ("/x/y", "/x/", "/", "")]
    rows = list(enumerate(urls))
    df = spark.createDataFrame(rows, "page_id bigint, url string")
    same(url_rules.judge(df, url_rules.rules_frame(spark, rules)).collect(), brute(rows, rules))


def test_empty_tables(spark):
    none = empty(spark, "page_id bigint, url string, html string")
    rules = url_rules.rules_frame(spark)
    assert url_rules.judge(none, rules).collect() == []
    one = spark.createDataFrame([(1, "http://a.net/")], "page_id bigint, url string")
    same(url_rules.judge(one, rules.where("false")).collect(), [(1, "a.net", "/", None, "allow")])
    assert html_layout.extract(none).collect() == []


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("a<p>b<p>c</p>d", "a\n\nb\n\nc\n\nd"),
        ("<div>a</div><div>b<div>c</div></div>d", "a\nb\nc\nd"),
        ("one<br>two<br/>three", "one\ntwo\nthree"),
        ("<b>a</b> <i>b</i>\n\n c", "a b c"),
        ("x<b>y</b>z", "xyz"),
        ("<head><title>t</title><style>p{}</style></head><body>b", "b"),
        ("<script>if (a < b) '</p>'</script>after", "after"),
        ("<!-- x > y -->a<!doctype html><?pi?>b", "ab"),
        ("<!-- open", ""),
        ("a < b &lt; c", "a < b < c"),
        ("<p hidden>no</p><p style='display : none'>no</p><p>yes", "yes"),
        ("<span style=\"VISIBILITY:hidden\">no<b>no</b></span>yes", "yes"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", "- a\n- b\n  - c\n- d\n\ne"),
        ("<ol start=3><li>a<p>b</p></li><li>c</li></ol>", "3. a\n\n   b\n4. c"),
        ("<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>", "a    bb\nccc  d"),
        ("<table><tbody><tr><th>n</th><th>v</th></tr><tr><td colspan=2>wide</td></tr></table>", "n  v\nwide"),
        ("<table><tr><td>a<br>b<td>c</table>", "a  c\nb"),
        ("<td>x<td>y", "x  y"),
        ("<table><tr><td><table><tr><td>in</table><td>out</table>", "in  out"),
        ("<pre>a\n  b\n\n c</pre>", "a\n  b\n\n c"),
        ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
        ("a</p></div></b>b", "a\n\nb"),
        ("<a href='x>y' title=\"q>\">link</a>", "link"),
        ("<p class=\"open>text<p>more", "text\n\nmore"),
        ("<a b='", ""),
        ("<blockquote>q</blockquote>r", "  q\n\nr"),
        ("<h1>T</h1><p>x</p><hr><p>y</p>", "T\n\nx\n\ny"),
        ("<textarea><b>&amp;</textarea>", "<b>&"),
        ("<select><option>a<option>b</select>", ""),
        ("a&nbsp;b \u00a0 c", "a\u00a0b \u00a0 c"),
        ("<p>a<table><tr><td>b</table>", "a\n\nb"),
        ("<html><head><title>T</title><p>Hello</html>", "Hello"),
        ("<html><head>\n<meta charset=x>\n<title>T</title>\n<style>p{}</style>\nHello <b>you</b></html>", "Hello you"),
        ("<head><noscript><img src=x></noscript><script>s</script><title>T</title><img src=y>seen", "seen"),
        ("<head><html><head><title>T</title><br>a", "a"),
        ("<head><title>T</title></body>a", "a"),
        ("<div>a<svg width='1'/>b</div>c", "ab\nc"),
        ("<div>a<math />b</div>c", "ab\nc"),
        ("<p><svg><title/><style/><path d=x /></svg>a</p>b", "a\n\nb"),
        ("<div><svg width=5/>no</svg>a</div>", "a"),
        ("<div><svg><path d='m'><p>a</div>b", "a\nb"),
        ("a <math> <mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac><annotation>no</annotation></math>, b", "a x = 1 2, b"),
        ("(<math><mi>x</mi><mphantom><mi>y</mi></mphantom></math>)", "(x)"),
        ("<svg><title>no</title><defs><text>no</text></defs><g><text>A</text><text x=1>B <tspan>c</tspan></text>no</g></svg>d", "A\nB c\nd"),
        ("<svg hidden><text>no</text></svg><svg><svg><text>in</text></svg><text/><foreignObject><p>html</p></foreignObject>no</svg>", "in\nhtml"),
        ("<svg><g style='display:none'><text>no</text></g><text><![CDATA[a > b]]></text></svg>", "a > b"),
        ("<text>plain</text> b", "plain b"),
    ],
)
def test_visible_text(html, text):
    assert html_layout.visible_text(html) == text


def test_deep_and_broken_pages_end():
    for html in ("<div>" * 20000 + "x", "<b>" * 20000 + "</i>" * 20000 + "x", "<a b='" * 9000, "<" * 9000, "<table><tr><td>" * 500 + "x"):
        html_layout.visible_text(html)


def test_extract_rows(spark):
    df, rows = awkward(spark, [(0, "<p>a"), (1, "b" * 100000)], "page_id", "html")
    assert set(CLASH) < set(df.columns)
    same(html_layout.extract(df).collect(), [(i, html_layout.visible_text(h) if h else "") for i, h in rows])


class SlowBuilder(html_layout.Builder):
    """Lays blocks out as plain lists of lines, copied at every level."""

    @staticmethod
    def lines_of(box):
        lines, apart, run = [], False, []
        for item in [*box.items, None]:
            if isinstance(item, str):
                run.append(item)
                continue
            for new, gap in ([(html_layout._inline(run, box.pre), False)] if run else []) + ([item] if item else []):
                text = new if isinstance(new, list) else new.texts()
                while text and not text[0]:
                    text = text[1:]
                while text and not text[-1]:
                    text = text[:-1]
                if text:
                    lines = lines + ([""] if lines and (gap or apart) else []) + text
                    apart = gap
                elif gap:
                    apart = bool(lines)
            run = []
        return lines

    @staticmethod
    def grid(rows):
        if all(len(r) == 1 for r in rows):
            return [x for r in rows for x in r[0][0]]
        width = {}
        for row in rows:
            at = 0
            for lines, span in row:
                if span == 1:
                    width[at] = max([width.get(at, 0), *map(len, lines)])
                at += span
        out = []
        for row in rows:
            for k in range(max((len(x) for x, _ in row), default=0)):
                line, at = "", 0
                for lines, span in row:
                    x = lines[k] if k < len(lines) else ""
                    if x:
                        left = sum(width.get(c, 0) + 2 for c in range(at))
                        line = line.ljust(max(left, len(line) + 2 if line else 0)) + x
                    at += span
                out.append(line.rstrip())
        return out

    def _place(self, box, above):
        lines = self.lines_of(box)
        if box.kind in html_layout.CELL and above.kind == "tr":
            above.rows.append((lines, box.span))
        elif box.kind in html_layout.CELL:
            above.items.append((lines, False))
        elif box.kind == "tr":
            row = [(lines, 1), *box.rows] if lines else box.rows
            if above.kind == "table":
                above.rows += [row] if row else []
            else:
                above.items.append((self.grid([row]), False))
        else:
            if box.kind == "table":
                lines = lines + self.grid(box.rows)
            elif box.kind == "li" and lines:
                mark = "- " if above.number is None else f"{above.number}. "
                above.number = above.number and above.number + 1 if above.number is None else above.number + 1
                lines = [mark + lines[0], *(" " * len(mark) + x if x else x for x in lines[1:])]
            elif box.kind in ("blockquote", "dd"):
                lines = ["  " + x if x else x for x in lines]
            above.items.append((lines, box.apart and not (box.kind in ("ul", "ol", "menu") and above.kind == "li")))

    def finish(self):
        while self.open:
            self._pop()
        return "\n".join(self.lines_of(self.boxes[0]))


def test_equals_a_plain_layout_on_random_pages(monkeypatch):
    r = random.Random(8)
    tags = ["p", "div", "ul", "ol", "li", "li", "table", "tr", "td", "td", "th", "td colspan=2", "blockquote", "dl", "dt", "dd", "pre", "b", "h1", "br", "hr"]
    pages = []
    for _ in range(1500):
        out = []
        for _ in range(r.randrange(1, 40)):
            k = r.random()
            if k < 0.45:
                out.append(f"<{r.choice(tags)}>")
            elif k < 0.7:
                out.append(f"</{r.choice(tags).split()[0]}>")
            else:
                out.append(r.choice(("a", "bb ", " c\n  d", "wide words here", "\n", "é")))
        pages.append("".join(out))
    fast = [html_layout.visible_text(x) for x in pages]
    monkeypatch.setattr(html_layout, "Builder", SlowBuilder)
    for page, text in zip(pages, fast, strict=True):
        assert html_layout.visible_text(page) == text, page


@pytest.mark.parametrize(
    "page",
    [
        "<br>" * 200_000 + "x",
        "<div>a" * 40_000,
        "<blockquote>line" * 10_000 + "<p>end" * 10_000,
        "<ul><li>" * 20_000 + "x" + "<li>y" * 20_000,
        "<table><tr><td>" + "w" * 50_000 + "<td>x" + "<tr><td>a<td>b" * 20_000,
        "<table><tr><td>a<td>b<td>" * 5_000,
        "<table><tr>" + "<td>x" * 10_000 + "<td>" + "y<br>" * 10_000,
        "<table>" + "<tr><td colspan=1000>a<td>b" * 10_000,
    ],
    ids=["breaks", "blocks", "quotes", "lists", "wide cell", "nested tables", "tall cell", "spans"],
)
def test_hostile_pages_stay_in_proportion(page):
    begin = time.process_time()
    text = html_layout.visible_text(page)
    assert time.process_time() - begin < 8
    assert len(text) < 120 * len(page)

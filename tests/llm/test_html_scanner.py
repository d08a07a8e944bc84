"""Tags by the states of the HTML standard, deep pages, and the linked paths against plain tuples."""

import random
import time
from html.parser import HTMLParser

import numpy as np
import pytest

from tidemark.llm import html


def texts(page):
    return [b[0] for b in html.blocks(page)]


def parts(path):
    out = []
    while path.above is not None:
        out.append(path.part)
        path = path.above
    return tuple(reversed(out))


@pytest.mark.parametrize("page, found", [
    ('<img alt="a < b" src=x>hello', ["hello"]),
    ("<p title=it's>hello", ["hello"]),
    ('<a title="x<y">link</a>', ["link"]),
    ('<p onclick="if(a<b){}">ok</p>', ["ok"]),
    ("<p title='1 > 0'>ok</p>", ["ok"]),
    ('<p "stray>ok</p>', ["ok"]),
    ("<p/class=x>ok</p >more", ["ok", "more"]),
    ("<p a = \n 'b>c' =d>ok", ["ok"]),
    ("<p>1 < 2 and 3<4</p>", ["1 < 2 and 3<4"]),
    ("a</>b</ x>c", ["abc"]),
    ("<!-->a<!--->b<!-- x --!>c<!-- open", ["abc"]),
    ("<script data-x='>'>if (a<b) '</p>'</script >x<script>open", ["x"]),
    ("<p>before <b unfinished", ["before"]),
    ("text </", ["text </"]),
    ("<scripted>no script</scripted>", ["no script"]),
])
def test_tags(page, found):
    assert texts(page) == found


class Plain(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.data, self.starts = [], []

    def handle_data(self, data):
        self.data.append(data)

    def handle_starttag(self, tag, attrs):
        self.starts.append((tag, [w for k, v in attrs if k in ("class", "id", "role") for w in html.NAME.findall((v or "").lower())]))


def test_random_pages_against_another_parser():
    rng = random.Random(5)
    values = ['"a < b"', "'x > y'", '"it\'s"', "'say \"no\"'", "plain", '""', '"nav bar"', "main", "'</div>'", '"<p>"', "a/b"]
    for _ in range(3000):
        page, words = "", 0
        for _ in range(rng.randint(1, 12)):
            tag = rng.choice(["div", "section", "ul", "b", "a", "h1"])
            named = "".join(" " * rng.randint(1, 2) + rng.choice(["class", "id", "title", "data-x", "role", "CLASS"]) + rng.choice(["=", " = "]) + rng.choice(values)
                            for _ in range(rng.randint(0, 3)))
            end = rng.choice(["", " ", "\n"])
            page += rng.choice([f"<{tag}{named}{end}>", f"</{tag}{end}>", f"w{words} ", f"w{words}&amp;&lt;", "<!-- < > -->"])
            words += 1
        plain = Plain()
        plain.feed(page)
        plain.close()
        assert " ".join(texts(page)).split() == " ".join(plain.data).split() or "".join(texts(page)).replace(" ", "") == "".join(
            "".join(plain.data).split()), page
        found = [html.class_words(m[4]) for m in html.MARKUP.finditer(page) if m[3] and not m[2]]
        assert found == [w for _, w in plain.starts], page


def test_deep_and_broken_pages_take_time_in_proportion():
    start = time.process_time()
    deep = "<div class='a b'>x" * 50_000 + "</section>" * 50_000 + "</div>" * 50_000
    found = html.blocks(deep)
    assert len(found) == 50_000 and found[-1][1].mask == found[1][1].mask
    assert html.Featuriser().page(found).shape == (50_000, html.SIZE)
    assert len(html.varied(found, np.random.default_rng(3))[0]) >= 50_000
    for broken in ('<p title="', "<a ", "<", "<script>", "<!--", "<a b=", "</script", "<svg/"):
        html.blocks(broken * 100_000)
    assert time.process_time() - start < 30


def test_paths_mean_what_tuples_mean():
    page = "<body><header><p>a</p></header><article class='post main'><h1>b</h1><div id=comments><p>c</p></div></article>d</body>"
    found = html.blocks(page)
    paths = [parts(p) for _, p, _ in found]
    assert paths == [
        ("body", "header", "p"), ("body", "article", ".post", ".main", "h1"),
        ("body", "article", ".post", ".main", "div", ".comments", "p"), ("body",)]
    assert html.guess(found) == [False, True, False, False]
    known = {}
    assert [parts(html.plainer(p, ("x", ".y"), known)) for _, p, _ in found][1] == ("body", "x", ".y", ".post", ".main", "h1")

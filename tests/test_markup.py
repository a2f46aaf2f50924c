"""Elements of pages: rules by example, and random well-formed pages against their own trees."""

import random

import pytest

from commentguard.operators.markup import Selector, elements


def texts(html, *selectors):
    return elements(html.encode(), [Selector.parse(s) for s in selectors], unclosed=True)


@pytest.mark.parametrize("html,selector,want", [
    ("<div dir='auto'>first <div>inner</div> tail</div>", "div[dir='auto']", ["first inner tail"]),
    ("<div dir=auto>a<div DIR=\"auto\">b</div>c</div>", "div[dir=auto]", ["b", "abc"]),
    ("<div>a<p>b<div>c</div>d</div>e", "p", ["bcd"]),                       # not closed: ends with its parent
    ("<p>a<b>b<p>c</p>d<p>e</p>", "p", ["abc", "e"]),                       # not closed: goes on through the next one
    ("<ul><li>a<ul><li>b</li><li>c</li></ul>d</li><li>e</ul>", "li", ["b", "c", "abcd", "e"]),
    ("<p>a<br>b<img src=x>c<hr/>d</p>", "p", ["abcd"]),                     # void elements are never open
    ("<p/>x<p>y</p>", "p", ["y"]),
    ("</p>x</div><p>y</i></p>", "p", ["y"]),                                # end tags without a start
    ("<P Class='a b'>x</p><p>y</P>", "p[class]", ["x"]),
    ("<p>a<!-- <p>no</p> --><script>'</p>'</script><STYLE>p{}</STYLE>b</p>", "p", ["ab"]),
    ("<p>1 < 2</p>", "p", ["1 "]),                                          # "<" to ">" is a tag, whatever is in it
    ("no tags", "p", []), ("", "p", []), ("<p>never ends", "p", ["never ends"]),
    ("<pre>a</pre><p>b</p>", "p", ["b"]), ("<p title=\"p\">ñ中</p>", "p[title=p]", ["ñ中"]),
])
def test_rules(html, selector, want):
    assert texts(html, selector) == want


def test_not_a_selector():
    with pytest.raises(ValueError):
        Selector.parse("div > p")


def tree(rnd, depth=0):
    """(html, text, [(name, attribute, text) of every element in it, as they end])"""
    html, text, found = "", "", []
    for _ in range(rnd.randint(0, 4)):
        if depth > 4 or rnd.random() < 0.4:
            piece = rnd.choice(["a ", "bé", "中", "&amp;", "\n"])
            html, text = html + piece, text + piece
        else:
            name, attr = rnd.choice(["div", "span", "b"]), rnd.choice([None, "x", "y"])
            inner, inner_text, inner_found = tree(rnd, depth + 1)
            quote = rnd.choice(["'", '"'])
            html += f"<{rnd.choice([name, name.upper()])}{f' k={quote}{attr}{quote}' if attr else ''}>{inner}{rnd.choice(['', '<br>'])}</{name}>"
            text += inner_text
            found += [*inner_found, (name, attr, inner_text)]
    return html, text, found


def test_random_pages_equal_their_trees():
    rnd = random.Random(3)
    for _ in range(2000):
        html, _, found = tree(rnd)
        assert texts(html, "div") == [t for n, _, t in found if n == "div"]
        assert texts(html, "div[k]", "span[k='x']") == [t for n, a, t in found if (n == "div" and a) or (n == "span" and a == "x")]


def test_deep_page_is_linear():
    n = 20_000
    assert texts("<b>" * n + "x" + "</b>" * n + "<p>y</p>", "p") == ["y"]


def test_elements_without_an_end_tag_are_left_out_by_default():
    html = b"<div><p>a<div>b</div></div><p>c</p><p>d"
    assert elements(html, [Selector.parse("p")]) == ["c"]
    assert elements(html, [Selector.parse("p")], unclosed=True) == ["ab", "c", "d"]
    assert elements(html, [Selector.parse("div")]) == ["b", "ab"]

"""Main text against a plain version of the method that keeps the whole path of
every line and looks at all open elements, on generated pages; and pages whose
size or nesting is out of the ordinary."""

import html
import random
import re
import time
import tracemalloc

import pytest

from nimbusframe.llm import html_text

BLOCK = {"html", "body", "div", "p", "ul", "li", "h1", "h2", "article", "main", "nav", "section", "table", "tr", "td"}
CLOSES = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td"}, "td": {"td"}}
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()


def page(rng):
    out = []

    def text(n):
        return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", "&amp;", " &lt;b&gt;", "\n  "]) for _ in range(n))

    def fill(depth):
        for _ in range(rng.randrange(1, 5)):
            r = rng.random()
            if depth == 0 or r < 0.35:
                name = rng.choice(["p", "p", "p", "li", "td"])
                end = rng.choice([f"</{name}>", "", "</div>" if rng.random() < 0.05 else ""])
                out.append(f"<{name}>{text(rng.choice([1, 2, 5, 15, 30]))}{rng.choice(['', '<br>more', '<b>bold</b>', '<a href=x>link text</a>'])}{end}")
            elif r < 0.45:
                out.append(f"<h{rng.randrange(1, 3)}>{text(2)}</h{rng.randrange(1, 3)}>")
            elif r < 0.55:
                out.append("<ul>" + "".join(f"<li><a href=x>{text(2)}</a>" for _ in range(3)) + "</ul>")
            elif r < 0.6:
                out.append("<nav><p>" + text(20) + "</nav>")
            else:
                name = rng.choice(["div", "section", "table", "div", "b", "tr"])
                out.append(f"<{name}>")
                fill(depth - 1)
                out.append(rng.choice([f"</{name}>"] * 9 + ["</p>"]))

    kind = rng.choice(["body", "div", "article", "main", "article"])
    out.append(rng.choice(["<body>", "", "<html><body>"]))
    fill(1)
    out.append(f"<{kind}>")
    fill(3)
    out.append(f"</{kind}>")
    fill(1)
    return "".join(out)


def plain(source):
    """The method on pages of the elements above, step by step."""
    lines, stack, buffer, links, number, pos = [], [], "", 0, 0, 0

    def flush():
        nonlocal buffer, links
        line = " ".join(html.unescape(buffer).split())
        if line:
            lines.append((line, min(links, len(line)), list(stack)))
        buffer, links = "", 0

    def take(piece):
        nonlocal buffer, links
        if not any(n == "nav" for n, _ in stack):
            buffer += piece
            if any(n == "a" for n, _ in stack):
                links += len(html.unescape(piece).strip())

    hidden = lambda: any(n == "nav" for n, _ in stack)
    for m in re.finditer(r"<(/?)(\w+)[^>]*>", source):
        take(source[pos : m.start()])
        pos = m.end()
        name = m[2]
        if name in BLOCK and not hidden():
            flush()
        if name == "br":
            if not hidden():
                buffer += " "
        elif m[1]:
            for i in reversed(range(len(stack))):
                if stack[i][0] == name:
                    del stack[i:]
                    break
                if stack[i][0] in ("article", "main", "body") and name not in ("article", "main", "body", "html"):
                    break
        else:
            for i in reversed(range(len(stack))) if name in CLOSES else ():
                if stack[i][0] in CLOSES[name]:
                    del stack[i:]
                    break
                if stack[i][0] in BLOCK:
                    break
            number += 1
            stack.append((name, number))
    take(source[pos:])
    flush()
    is_main = lambda x: any(n in ("article", "main") for n, _ in x[2])
    if any(map(is_main, lines)):
        return "\n".join(x[0] for x in lines if is_main(x))
    own = [0 if x[1] * 2 > len(x[0]) else len(x[0]) - x[1] for x in lines]
    if not any(own):
        return "\n".join(x[0] for x in lines)
    sums = [sum(own[i : i + 3]) for i in range(len(own))]
    hot = [i for i in range(len(own)) if sums[i] >= min(80, max(sums))]
    lo, hi = hot[0], min(len(own) - 1, hot[-1] + 2)
    part = min(80 // 3, max(own[lo : hi + 1]))
    lo = next(i for i in range(lo, len(own)) if own[i] >= part)
    hi = next(i for i in range(hi, -1, -1) if own[i] >= part)
    while lo and any(n in ("h1", "h2") for n, _ in lines[lo - 1][2]) and not lines[lo - 1][1]:
        lo -= 1
    shared = [a for a, b in zip(lines[lo][2], lines[hi][2]) if a == b]
    while len(shared) > 1 and shared[-1][0] not in BLOCK:
        shared.pop()
    if not shared or shared[-1][0] in ("html", "body"):
        return "\n".join(x[0] for x in lines[lo : hi + 1])
    return "\n".join(x[0] for i, x in enumerate(lines) if lo <= i <= hi or (shared[-1] in x[2] and (own[i] or x[1] * 2 <= len(x[0]))))


def test_main_text_equals_the_plain_version():
    rng = random.Random(6)
    kinds = set()
    for _ in range(3000):
        source = page(rng)
        got = html_text.main_text(source)
        assert got == plain(source), source
        kinds.add(bool(got))
    assert kinds == {True} or kinds == {True, False}


LONG = "A paragraph that is long enough to be a surge of text on a page, with a number of words in it."


@pytest.mark.parametrize(
    ("source", "text"),
    [
        # without an article the distribution decides, also right below the body
        (f"<ul><li>Home<li>About</ul><h1>T</h1><p>{LONG}</p><p>{LONG}</p><p>Copyright</p>", f"T\n{LONG}\n{LONG}"),
        (f"<body><p>Menu</p><h1>T</h1><h2>S</h2><p>{LONG}</p><p>{LONG}</p><p>Imprint</p></body>", f"T\nS\n{LONG}\n{LONG}"),
        # what an article may well hold stays, menus and the like in it go
        (f"<article><p>{LONG}</p><div class=legal>L</div><div class='social-policy'>S</div><div class='share-buttons'>X</div>"
         f"<p class=search-history>H</p><div class='ad-box'>{LONG}</div></article>", f"{LONG}\nL\nS\nH"),
        (f"<article><p>{LONG}</p></article><article><p>Short.</p></article>", f"{LONG}\nShort."),
    ],
)
def test_contract_cases(source, text):
    assert html_text.main_text(source) == text


@pytest.mark.parametrize(
    "source",
    [
        "<article>" + "<p>x y</p>" * 150_000 + "</article>", "<b>" * 40_000 + "</p>" * 40_000, "<div>" + "<b>" * 40_000 + "<p>" * 40_000,
        "<div>a" * 60_000, "<article>" * 40_000 + "x", "<div class=menu>" * 20_000 + "<article>x" * 20_000, "<p>" + LONG * 40_000,
        "<a href=x>" * 50_000 + "</div>" * 50_000, "<td>" * 50_000 + "</tr>" * 50_000,
    ],
)
def test_long_and_badly_nested_pages_take_linear_time_and_memory(source):
    tracemalloc.start()
    began = time.process_time()
    html_text.main_text(source)
    took, most = time.process_time() - began, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert took < 12 and most < 200e6

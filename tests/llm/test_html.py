"""Rendering of HTML pages."""

import random

import pytest

from footfall.llm.html_text import extract_text, page_title, visible_text

CASES = {
    "blocks": ("<p>One <b>two</b>\n three<p>Four<div>five</div>six", "One two three\n\nFour\n\nfive\nsix"),
    "spaces": ("<p>  a\t b&nbsp;c  </p>", "a b c"),
    "break": ("a<br>b<br><br>c", "a\nb\n\nc"),
    "hidden": (
        "<p>a<span style='color:red; display : none'>x</span><i hidden>y</i>"
        "<script>var s='</p>';</script><!-- n --><template><p>z</template>b",
        "ab",
    ),
    "head": ("<html><head><title>T</title><style>p{}</style><body>B", "B"),
    "head ended by text": ("<html><head><title>T</title>Hello <b>world</b><br>more", "Hello world\nmore"),
    "head ended by an inline tag": ("<head>\n<meta charset=x><style>s</style> <a href=x>go</a> on</head>!", "go on!"),
    "head ended by a void tag": ("<head><title>T</title><img alt='a cat'><input type=submit value=ok></head>x", "a catokx"),
    "head ended by a character": ("<head><!-- c --> &nbsp;a", "\xa0a"),
    "head stays open": (
        "<head><noscript><div><img alt=n>no</div></noscript> <template><p>t</p>u</template>\n"
        "<script>s</script><link rel=x><base href=y></p><noframes>f</noframes><title>T</title></head><p>B",
        "B",
    ),
    "implied head": ("<title>T</title><p>B", "B"),
    "lists": (
        "<ul><li>a<li>b<ol start=3><li>c<li>d</ol><li>e</ul>",
        "- a\n- b\n\n  3. c\n  4. d\n- e",
    ),
    "table": (
        "<table><tr><th>Name<th>N<tr><td>long name<td>1<tr><td>x<td>22</table>",
        "Name       N\nlong name  1\nx          22",
    ),
    "spans": (
        "<table><tr><td rowspan=2>a<td>b<td>c</tr><tr><td>d<td>e</tr><tr><td colspan=2>ff<td>g</tr></table>",
        "a  b  c\n   d  e\nff    g",
    ),
    "cell lines": ("<table><tr><td>a<br>b<td>c</table>", "a  c\nb"),
    "nested table": ("<table><tr><td><table><tr><td>i</table><td>o</table>", "i  o"),
    "caption": ("<table><caption>cap</caption><tr><td>a</table>", "cap\na"),
    "pre": ("<pre>\n a\n   b  \n</pre>", " a\n   b"),
    "quote": ("<blockquote>a<p>b</blockquote>c", "> a\n>\n> b\n\nc"),
    "definition": ("<dl><dt>t<dd>d<dt>u</dl>", "t\n  d\nu"),
    "entities": ("<p>a &amp; b &lt;c&gt; &#233;", "a & b <c> é"),
    "not a tag": ("a < b and c <3 d", "a < b and c <3 d"),
    "open quote": ("<a href=\"x>y", ""),
    "stray quote": ("<p class=\"x\"\">Hello world</p><p>more", "Hello world\n\nmore"),
    "quote in a value": ("<p title=it's>Hello</p><p class=a\"b hidden>z<p>more", "Hello\n\nmore"),
    "quote in a name": ("<p a' \"b = '>' =\"c>d", "d"),
    "quoted values": ("<p a = \"x>y\" b='>'c=\"'>\">d<p hidden =''>z", "d"),
    "no value": ("<p a=>b<p a= >c", "b\n\nc"),
    "open comment": ("a<!-- b", "a"),
    "unknown end": ("a</b></p>c", "ac"),
    "select": ("a<select><option>x<option>y</select>b", "axb"),
    "chosen option": ("<select><optgroup label=g><option>x<option selected> y  z</optgroup></select>!", "y z!"),
    "list box": ("<select size=3><option>x<option hidden>h<option>y</select>", "x y"),
    "text area": ("<p>a<textarea>\n b &lt;c>\n\n<b>d</textarea>e", "a\n b <c>\n\n<b>d\ne"),
    "dialogs": ("a<dialog>x</dialog>b<dialog open>y</dialog>c", "ab\ny\nc"),
    "no row tag": ("<table><td>a<td>b<tr><td>ccc<td>d</table>", "a    b\nccc  d"),
    "no row tag in a group": ("<table><thead><th>n<th>m<tbody><td>ccc<td>d</table>", "n    m\nccc  d"),
    "row after a row group": ("<table><tbody><tr><td>a<tfoot><tr><td>b</table>", "a\nb"),
    "block in an inline element": ("<b><p>x</b>y</p>", "xy"),
    "hidden inline around a block": ("<b hidden><p>x</b>y</p>z", "y\n\nz"),
    "inline end beyond two blocks": ("<i><div><p>x</i>y</p>z</div>w", "xy\n\nz\nw"),
    "visible within invisible": (
        "<div style='visibility:hidden'>a<p style='visibility: visible'>b<i>c</i><u style=visibility:hidden>d</u>",
        "bc",
    ),
    "invisible keeps display": ("<ul style='visibility:collapse'><li>a<li style='visibility:visible'>b</ul>", "- b"),
    "wide cell": ("<table><tr><td colspan=500>a<td>b<tr><td>c<td>d</table>", "a     b\nc  d"),
    "cell wider than its columns": (
        "<table><tr><td colspan=2>a long title<td>x<tr><td>b<td>c<td>y</table>",
        "a long title  x\nb  c          y",
    ),
    "hidden deep below": ("<div>" * 300 + "<div hidden>SECRET</div>ok", "ok"),
    "image": ("<img alt='a cat'> sat", "a cat sat"),
    "wide": ("<table><tr><td>日本<td>x<tr><td>abc<td>y</table>", "日本  x\nabc   y"),
    "empty": ("", ""),
}


@pytest.mark.parametrize("name", CASES)
def test_rendering(name):
    page, text = CASES[name]
    assert visible_text(page) == text


def test_deep_and_long_pages():
    assert visible_text("<div>" * 5000 + "x" + "</div>" * 5000) == "x"
    assert visible_text("<b" * 20000) == ""
    assert visible_text("<p>a" * 20000) == "\n\n".join(["a"] * 20000)
    assert visible_text("<table>" * 300 + "x").strip() == "x"


def test_deeper_than_calls_can_be():
    assert visible_text("<ul><li>" * 3000 + "x") == "- " * 3000 + "x"
    assert visible_text("<blockquote>" * 3000 + "x") == "> " * 3000 + "x"
    assert visible_text("<b>" * 50_000 + "<p>x" + "</b>" * 50_000 + "y").replace("\n", "") == "xy"
    assert visible_text("<table><tr><td>" * 2000 + "x") == "x"
    assert visible_text("<div>" * 60_000 + "<p>" * 60_000 + "</i>" * 60_000 + "x") == "x"


# Generated pages, and a second way to lay them out: a flat list of what comes along,
# made by recursion, and lines cut from it afterwards.

BLOCK = {"div": 1, "section": 1, "p": 2, "h1": 2, "ul": 2}
LOOKS = {
    "": ("", None, True), "gone": (" style='display:none'", None, False), "hid": (" hidden", None, False),
    "dim": (" style='visibility:hidden'", False, True), "lit": (" style=visibility:visible", True, True),
}


def page(rng, depth, inline):
    parts = []
    for _ in range(rng.randrange(5)):
        pick = rng.random()
        if pick < 0.45 or depth == 0:
            parts.append(rng.choice(["a", "b ", " c", " ", "d\n\te", "ff  "]))
        elif pick < 0.5:
            parts.append(("br", "", []))
        else:
            tag = rng.choice(["b", "span", "i"] if inline else ["div", "section", "p", "h1", "ul", "b", "span"])
            look = rng.choices(list(LOOKS), [8, 1, 1, 1, 1])[0]
            if tag == "ul":
                items = [("li", rng.choices(list(LOOKS), [8, 1, 1, 0, 0])[0], page(rng, depth - 1, False)) for _ in range(rng.randrange(4))]
                parts.append((tag, look if look not in ("dim", "lit") else "", items))
            else:
                parts.append((tag, look, page(rng, depth - 1, inline or tag in ("p", "h1", "b", "span"))))
    return parts


def markup(parts, rng):
    out = ""
    for i, part in enumerate(parts):
        if isinstance(part, str):
            out += part
        else:
            tag, look, inner = part
            end = f"</{tag}>"
            following = parts[i + 1] if i + 1 < len(parts) else None
            # Authors leave out what the next start tag implies.
            ends_p = isinstance(following, tuple) and following[0] in BLOCK
            if tag == "br" or (tag == "li" and rng.random() < 0.5) or (tag == "p" and ends_p and rng.random() < 0.5):
                end = ""
            out += f"<{tag}{LOOKS[look][0]}>{markup(inner, rng)}{end}"
    return out


def flat(parts, lit=True):
    """Texts, "\n" for a line break, and numbers for the gaps that blocks ask for."""
    out = []
    for part in parts:
        if isinstance(part, str):
            out += [("t", part)] if lit else []
            continue
        tag, look, inner = part
        _, own, displayed = LOOKS[look]
        if not displayed:
            continue
        if tag == "br":
            out.append(("n", 0))
        elif tag == "ul":
            lines = []
            for _, item_look, item in inner:
                if LOOKS[item_look][2]:
                    own_lines = lines_of(flat(item, lit))
                    if not lit:
                        lines += own_lines
                        continue
                    own_lines = own_lines or [""]
                    lines += [("- " + own_lines[0]).rstrip(), *(("  " + x).rstrip() for x in own_lines[1:])]
            out.append(("lines", lines))
        else:
            gap = BLOCK.get(tag)
            inside = flat(inner, lit if own is None else own)
            out += [("g", gap), *inside, ("g", gap)] if gap else inside
    return out


def lines_of(parts):
    lines, text, gap = [], "", 0
    begun = False

    def cut():
        nonlocal text, begun
        line = " ".join(w for w in text.replace("\n", " ").replace("\t", " ").split(" ") if w)
        if begun:
            lines.append(line)
        text, begun = "", False

    def open_gap():
        nonlocal gap
        if gap and lines:
            lines.extend([""] * (gap - 1))
        gap = 0

    for kind, value in [*parts, ("g", 1)]:
        if kind == "t":
            if value.strip():
                if not begun:
                    open_gap()
                begun = True
            text += value
        elif kind == "n":
            if not begun:
                open_gap()
            begun = True
            cut()
        else:
            asked = 2 if kind == "lines" else value
            cut()
            gap = max(gap, asked)
            if kind == "lines" and value:
                open_gap()
                lines.extend(value)
                gap = asked
    while lines and not lines[-1].strip():
        lines.pop()
    return lines


@pytest.mark.parametrize("seed", range(400))
def test_generated_pages(seed):
    rng = random.Random(seed)
    parts = page(rng, 4, False)
    lines = lines_of(flat(parts))
    while lines and not lines[0]:
        lines.pop(0)
    assert visible_text(markup(parts, rng)) == "\n".join(lines)


def test_title():
    assert page_title("<TITLE lang=en> a\n &amp; b </title>") == "a & b"
    assert page_title("<p>") == ""


def test_frame(spark):
    rows = [(1, "<p>a", "old"), (1, "<p>a", "old"), (None, None, None), (2, "", "x")]
    frame = extract_text(spark.createDataFrame(rows, "page_id long, html string, title string"))
    assert frame.columns == ["page_id", "title", "text"]
    expected = [(1, "", "a"), (1, "", "a"), (2, "", ""), (None, None, None)]
    assert sorted(map(tuple, frame.collect()), key=str) == sorted(expected, key=str)
    assert extract_text(spark.createDataFrame([], "page_id long, html string")).collect() == []

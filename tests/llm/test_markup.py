from __future__ import annotations

import json

import pytest

from fathomgrid.llm import markup


def counts(text, field="rendered_body"):
    got = markup.kinds(text, field, markup.labeller())
    return None if got is None else tuple(got[1].count(markup.KINDS.index(k)) for k in ("heading", "list_item", "code_block", "formula"))


HTML = {
    "<h3 class='x'><a name='n'></a>Next</h3><p>a</p>": (1, 0, 0, 0), "<ul><li>a<li>b<ul><li>c</ul></ul>": (0, 3, 0, 0), "<PRE>x * ok\n# no</PRE>": (0, 0, 1, 0), "<div class=\"code panel\"><div class=\"codeContent\">\n<pre class=\"code-java\">\"&lt;li&gt;no&lt;/li&gt;\"</pre></div></div>": (0, 0, 1, 0),
    "<p>a <script type=\"math/tex\">x^2</script> b</p>": (0, 0, 0, 1), "<p><script>alert(1)</script><style>.x{}</style>a</p>": (0, 0, 0, 0), "<span class=\"math display\">\\[x\\]</span>": (0, 0, 0, 1), "<img class=\"latex\" alt=\"x^{2}\" src=\"/t.png\">": (0, 0, 0, 1), "<p>a<img src='/s.png' alt=''/></p>": (0, 0, 0, 0),
    "<p>&lt;ol&gt;&lt;li&gt;a b&lt;/li&gt;&lt;li&gt;c d&lt;/li&gt;&lt;/ol&gt;</p>": (0, 2, 0, 0), "<p>## Title here</p>": (1, 0, 0, 0), "<p>* one two<br/>** three four</p>": (0, 2, 0, 0), "<p>```sql\n# no\n* no\n```</p>": (0, 0, 1, 0), "<p>h4. Steps</p>": (1, 0, 0, 0), "<p>Open questions\n=====</p>": (1, 0, 0, 0),
    "<p>Cost rose from $5 to $9 per seat.</p>": (0, 0, 0, 0), "<p>The bound is $\\sqrt{5 k}$ here, C# 5 and a*b*c.</p>": (0, 0, 0, 1), "<p>Range 5 &lt; x &lt; 47 is fine. Line -19 is odd.</p>": (0, 0, 0, 0), "": None, None: None, "plain": (0, 0, 0, 0), "<p": (0, 0, 0, 0),
}


@pytest.mark.parametrize("text", HTML)
def test_html(text):
    assert counts(text) == HTML[text]


def adf(*content):
    return json.dumps({"type": "doc", "content": list(content)})


def words(t):
    return {"type": "paragraph", "content": [{"type": "text", "text": t}]}


def test_rich_text():
    item = {"type": "listItem", "content": [words("a"), {"type": "bulletList", "content": [{"type": "listItem", "content": [words("b")]}]}]}
    doc = adf({"type": "heading", "content": [{"type": "text", "text": "T"}]}, {"type": "bulletList", "content": [item]}, {"type": "codeBlock", "content": [{"type": "text", "text": "# no\n* no"}]}, {"type": "extension", "attrs": {"extensionKey": "mathblock", "parameters": {"body": "x"}}}, {"type": "x-legacy", "content": None}, words("\\section*{A b}"), words("\\begin{lstlisting}\nx\n\\end{lstlisting}"), words("<h2>Open questions</h2>"))
    assert counts(doc, "body_adf") == (3, 2, 2, 1)
    assert counts(json.dumps(doc), "body_adf") == (3, 2, 2, 1)
    assert counts(doc[:-4], "body_adf") is None and counts("[]", "body_adf") is None
    marked = adf({"type": "paragraph", "content": [{"type": "text", "text": "$x^2$", "marks": [{"type": "code"}]}, {"type": "text", "text": " and text"}]})
    assert counts(marked, "body_adf") == (0, 0, 0, 0)


def test_clean_text_tells_the_structure():
    dom, best = markup.kinds("<h2>T</h2><p>a &amp; b</p><ul><li>x</li></ul><pre>c  d</pre><p>e <span class='math'>y^2</span></p>", "rendered_body", markup.labeller())
    assert markup.render(dom, best) == "# T\n\na & b\n\n- x\n\n```\nc  d\n```\n\ne $y^2$"


def test_no_contradictions():
    dom = markup.read("<pre>a</pre><h2>x <ul><li>y</li></ul></h2>", "rendered_body")
    sure = {"pre": 3, "h2": 1, "li": 2}
    scores = [tuple(0.0 if i == sure.get(t, 0) else -5.0 for i in range(5)) for t in dom.tags]
    best = markup.decode(dom, scores)
    assert [markup.KINDS[b] for b in best if b] == ["code_block", "heading"]


def test_rows(spark):
    schema = "load_id long, kind string, description_adf string, comments array<struct<id:string,body_adf:string,rendered_body:string>>"
    rows = [(1, "clash", adf(words("* a b\n* c d")), [("1", None, "<li>x y</li>"), None, ("2", "{", "")]), (2, None, None, None), (2, None, None, [])]
    df = spark.createDataFrame(rows, schema)
    got = sorted(map(tuple, markup.elements(markup.fields(df)).collect()))
    assert got == [(1, "description_adf", -1, "list_item", 1), (1, "description_adf", -1, "list_item", 2), (1, "rendered_body", 0, "list_item", 1)]
    clean = {(r.field, r.comment_pos): r.text for r in markup.clean(markup.fields(df)).collect()}
    assert clean == {("description_adf", -1): "- a b\n\n- c d", ("rendered_body", 0): "- x y", ("body_adf", 2): None}
    assert markup.elements(markup.fields(df.where("false"))).count() == 0


def test_long_lists_and_long_formulas():
    for line in ("\n", "<br/>"):
        assert counts("<p>" + line.join(f"{n}. Step of the list" for n in range(990, 1021)) + "</p>") == (0, 31, 0, 0)
    formula = "\\sqrt{" + " + ".join(f"x_{i}" for i in range(200)) + "}"
    assert counts(f"<p>The bound is ${formula}$ here.</p>") == (0, 0, 0, 1)
    for text in ("<p>We started in\n2019. It was a fine year.</p>", "<p>It costs\n15000. That is a lot.</p>", "<p>Cost rose from $5 " + "a good bit " * 60 + "to $9 per seat.</p>"):
        assert counts(text) == (0, 0, 0, 0)


def test_deep_trees_render_without_recursion():
    deep = {"type": "text", "text": "x"}
    for _ in range(400):
        deep = {"type": "paragraph", "content": [deep]}
    dom, best = markup.kinds(json.dumps({"type": "doc", "content": [deep]}), "body_adf", markup.labeller())
    assert markup.render(dom, best) == "x"
    html = "<div>" * 20_000 + "y"
    dom = markup.read(html, "rendered_body")
    assert markup.render(dom, [0] * len(dom.tags)) == "y"

"""Tag events: nested, unclosed and quoted markup; text, links, signals and forms from them."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from prospectra.functions import markup
from prospectra.functions.text import html_to_text
from prospectra.plans import forms, page_signals


def shape(html):
    return [(e[0], e[1] or e[3]) for e in markup.scan(html)]


@pytest.mark.parametrize("html, want", [
    ("", []), ("plain", [("text", "plain")]), ("a<b", [("text", "a"), ("open", "b")]), ("1 < 2 <3", [("text", "1 < 2 <3")]), ("a<", [("text", "a<")]),
    ("<p>x</p>", [("open", "p"), ("text", "x"), ("close", "p")]), ("<BR/>y", [("open", "br"), ("text", "y")]),
    ("<!-- <p> -->z", [("comment", None), ("text", "z")]), ("<!-- open", [("comment", None)]), ("<!DOCTYPE html>t", [("comment", None), ("text", "t")]),
    ("<script>a='</p>'<b></SCRIPT >x", [("open", "script"), ("raw", "script"), ("close", "script"), ("text", "x")]),
    ("<style>p{}", [("open", "style"), ("raw", "style")]), ("<textarea><b>no</textarea>k", [("open", "textarea"), ("text", "<b>no"), ("close", "textarea"), ("text", "k")]),
    ("<a title='x>y' href=\"/q'>\">t", [("open", "a"), ("text", "t")]), ("<a href='never", [("open", "a")]), ("</>x", [("comment", None), ("text", "x")]),
    ("<ul><li>1<li>2</ul>", [("open", "ul"), ("open", "li"), ("text", "1"), ("open", "li"), ("text", "2"), ("close", "ul")]),
])
def test_events_of_odd_markup(html, want):
    assert shape(html) == want


@pytest.mark.parametrize("tag, want", [
    ("<a b c=1 D='x y' e=\"'q'>\" f = g/ />", {"b": "", "c": "1", "d": "x y", "e": "'q'>", "f": "g/"}), ("<a b=1 B=2>", {"b": "1"}),
    ("<a/b=1/c>", {"b": "1/c"}), ("<a =x y=>", {"=x": "", "y": ""}), ("<a b='1'c='2'>", {"b": "1", "c": "2"}),
])
def test_attributes(tag, want):
    assert dict(markup.scan(tag)[0][2]) == want


def test_events_cover_the_page():
    pick = random.Random(1)
    parts = ["<p>", "</p>", "<", ">", "'", '"', "<!--", "-->", "<a href='", "<script>", "</script>", "x", " ", "=", "/", "<form>", "</form>", "<label>", "</label>", "é"]
    for _ in range(3000):
        html = "".join(pick.choice(parts) for _ in range(pick.randint(0, 25)))
        at = 0
        for e in markup.scan(html):
            assert e[4] == at and e[5] > at
            at = e[5]
        assert at == len(html)


def test_forms_nested_unclosed_and_very_long(spark):
    filler = "<div data-x='</form>'>" + "lorem " * 3000 + "</div>"
    html = (f"<form method=post id=one>{filler}<form><input name=email></form><form method=post action='/two?a>b'><label for=m>Your <b>message</b></label>"
            "<textarea id=m name=t></textarea><input type=email name=e required><input name=z")
    df = spark.createDataFrame([(1, "https://x.test/", html), (2, "https://y.test/", None)], "page_id int, url string, html string")
    got = {r.form_index: r for r in forms.classify(df, "page_id").collect()}
    assert [(k, got[k].form_key, got[k].action_url, got[k].n_fields) for k in sorted(got)] == [(0, "one", "https://x.test/", 1), (1, "form-1", "https://x.test/two?a>b", 3)]
    fields = {r["name"]: r for r in forms.fields_of(forms.forms_of(df)).filter("form_index = 1").collect()}
    assert (fields["t"].label, fields["t"].role, fields["e"].required, fields["z"].required) == ("Your message", "message", True, False)
    signals = page_signals.detect(df).orderBy("page_id").collect()
    assert [r.lead_form for r in signals] == ["native form with email/phone input", None]


def test_links_and_text_read_quoted_values(spark):
    html = "<a title='1 > 0' href='/a'>A</a><A HREF=/b>B</a><script>x='<a href=\"/no\">'</script><a href=''>C</a><p title=\"<a href='/no2'>\">D &amp; E"
    df = spark.createDataFrame([(1, "https://x.test/", html)], "page_id int, url string, html string")
    assert [r.target for r in page_signals.links(df).orderBy("pos").collect()] == ["https://x.test/a", "https://x.test/b"]
    assert df.select(html_to_text("html").alias("t")).first().t == "A B C D & E"
    assert df.select(F.size(markup.opened(markup.tag_events("html"), "a")).alias("n")).first().n == 3


def test_events_of_many_pages_are_packed_by_thousands_and_cut(monkeypatch):
    most = []

    def watched(flat, packed, pack=markup._pack):
        most.append(len(flat))
        pack(flat, packed)

    monkeypatch.setattr(markup, "AT_ONCE", 10)
    monkeypatch.setattr(markup, "_pack", watched)
    pages = pa.array(["<a href='/a' id=x>t</a>"] * 40 + [None, ""])
    found = markup.events_of(pages)
    assert max(most) <= 12 and len(found) == 42 and found[40].as_py() == [] == found[41].as_py()
    assert [e["kind"] for e in found[39].as_py()] == ["open", "text", "close"] and found[39].as_py()[0]["start"] == 0
    assert found[0].as_py()[0]["values"] == [("href", "/a"), ("id", "x")]
    only = markup.events_of(pages, ("open",), ("a",), ("href",))
    assert [(e["name"], e["values"]) for e in only[7].as_py()] == [("a", [("href", "/a")])]
    assert markup.events_of(pages, names=("form",))[0].as_py() == []

"""Element trees of pages: nesting, end tags left out, what is not content, references, nested records."""

from hypothesis import given, settings, strategies as st

from duelframe.sources import pages as H


def pages(spark, *html):
    return spark.createDataFrame(list(enumerate(html)), "page_id long, html string").repartition(2)


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy("page_id", "pos").collect()]


def test_items_nest_and_may_leave_out_their_end(spark):
    p = pages(spark, "<ul><li>a<ul><li>b</li><li>c</li></ul>d</li><li>e</li></ul>", "<ul><li>one<li>two <b>x</b><li>three</ul><p>no",
              "<!-- <li>no</li> --><script>'<li>no</li>'</script><style>li{}</style><li>yes</li>", "<li>R&amp;D &lt;1&gt; &eacute;&#233;</li>", None, "",
              "<LI CLASS=x>up</LI><li", "</li></ul><li>after")
    assert rows(H.page_items(p), "page_id", "pos", "item") == [
        (0, 0, "abcd"), (0, 1, "b"), (0, 2, "c"), (0, 3, "e"), (1, 0, "one"), (1, 1, "two x"), (1, 2, "three"), (2, 0, "yes"),
        (3, 0, "R&D <1> éé"), (6, 0, "up"), (7, 0, "after")]


def test_links_keep_quoted_blanks_and_skip_what_is_not_content(spark):
    p = pages(spark, '<a href="/u v">x</a><a href=/bare>y</a><a href=\'/q"r\'>z</a><a name=n>no</a><!-- <a href="/c">c</a> -->'
              '<script>document.write("<a href=/s>s</a>")</script><a class=k data-href="/no" HREF="/p?a=1&amp;b=2">w <i>i</i></a><a href="/open">end')
    assert rows(H.page_links(p), "text", "href") == [
        ("x", "/u v"), ("y", "/bare"), ("z", '/q"r'), ("w i", "/p?a=1&b=2"), ("end", "/open")]


def test_paragraphs_cells_and_void_elements(spark):
    p = pages(spark, "<p>one<br>two<img src=x><p>three<div>four</div>five", "<table><tr><td>a<p>b<td>c</p>d<tr><th>e</table><p>f")
    assert rows(H.page_items(p, "p"), "page_id", "item") == [(0, "onetwo"), (0, "three"), (1, "b"), (1, "f")]
    found = H.page_elements(p, ["td", "th", "tr"]).orderBy("page_id").collect()[1].elements
    assert [(e.tag, e.parent, e.text) for e in found] == [("tr", -1, "abcd"), ("td", 0, "ab"), ("td", 0, "cd"), ("tr", -1, "e"), ("th", 3, "e")]


INFOBOX = ("<table class='infobox vcard'><tbody><tr><th>Name</th><td>A. B.</td></tr><tr><th scope=row>Born</th><td>(1990) <a href=/c>City</a></td></tr>"
           "<tr><th>Residence</th><td> </td></tr><tr><td>Elevation: 3 m</td></tr></table>")


def test_labelled_fields_in_order(spark):
    p = pages(spark, INFOBOX, "<table><tr><th>Residence:</th><td>R&amp;S</td></table>", "<h1>none</h1>")
    labels = [("th", "Fighting out of", "td"), ("th", "Residence", "td"), ("th", "Residence:", "td"), ("th", "Born", "td"), "h1"]
    assert {r.page_id: r.value for r in H.page_labelled(p, labels).collect()} == {0: "(1990) City", 1: "R&S", 2: "none"}
    assert {r.page_id: r.field for r in H.page_field(p, "elevation", tag="tr").collect()} == {0: "Elevation: 3 m", 1: None, 2: None}


BOUTS = """<table id=other><tr><td>not this</td></tr></table>
<table class="toccolours wide" style="x"><tbody><tr><th>Class</th><th>Winner</th></tr>
<tr><td>Light</td><td> <a href="/wiki/A">Al A</a> (c) </td><td>def.</td><td><a href="/wiki/B">Bo B</a><a href="/second">2</a></td><td>KO (punch)</td><td>1
<tr><td>Heavy<td>No Link<td>def.<td>C<table><tr><td>inner</td></tr></table><td>Decision<td></tbody></table>"""


def test_nested_records_of_a_table(spark):
    p = pages(spark, BOUTS, "<p>no table", None)
    got = {r.page_id: r.records for r in H.page_records(p, where={"class": "toccolours"}).collect()}
    assert got[1] == [] and got[2] == []
    assert [[c.text for c in row] for row in got[0]] == [
        ["Class", "Winner"], ["Light", "Al A (c)", "def.", "Bo B2", "KO (punch)", "1"], ["Heavy", "No Link", "def.", "Cinner", "Decision", ""]]
    assert [c.tag for c in got[0][0]] == ["th", "th"] and [c.href for c in got[0][1]] == [None, "/wiki/A", None, "/wiki/B", None, None]
    bouts = p.sparkSession.createDataFrame([(row[1].text, row[3].text) for row in got[0] if all(c.tag == "td" for c in row)], "w string, l string")
    assert sorted(map(tuple, bouts.collect())) == [("Al A (c)", "Bo B2"), ("No Link", "Cinner")]


def test_long_pages_and_empty_tables(spark):
    deep = "<div>" * 3000 + "<li>x" + "<li>y" * 20_000
    p = pages(spark, deep)
    assert H.page_items(p).count() == 20_001
    assert H.page_items(p.limit(0)).count() == 0 and H.page_records(p.limit(0)).count() == 0


WORDS = st.lists(st.sampled_from(["<li>", "</li>", "<ul>", "</ul>", "<p>", "</p>", "<td>", "</td>", "<tr>", "</table>", "<table>", "<a href=x>", "</a>", "t",
                                  "&amp;", "<!--", "-->", "<br/>", "<script>", "</script>", "<", ">"]), max_size=30)


@settings(max_examples=300, deadline=None)
@given(WORDS)
def test_any_markup_gives_a_forest_in_document_order(words):
    found = H.Elements({"li", "td", "a", "p"}).read("".join(words))
    assert all(-1 <= e["parent"] < i for i, e in enumerate(found))
    for e in found:
        if e["parent"] >= 0:
            assert e["text"] in found[e["parent"]]["text"]

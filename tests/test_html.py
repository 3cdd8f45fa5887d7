"""HTML extraction: data table, sidebar links, locations script."""

from pyspark.sql import functions as F

from gaugeflow.sources.html import html_table_rows, js_locations, nav_links, parse_locations

TABLE = (
    '<html><div class="x"><table class="CenteredGrid">'
    "<tr><th>Time</th><th>Water Level</th></tr>"
    "<tr><td>Jan 04, 2024 10:00</td><td> 1.20**Estimated </td></tr>"
    "<tr><td>Jan 04, 2024 11:00</td><td>1&amp;2</td></tr>"
    "</table></div></html>"
)


def test_table_rows(spark):
    r = spark.createDataFrame([(TABLE,)], "html string").select(html_table_rows(F.col("html")).alias("t")).first().t
    assert r.width == 2
    assert [list(x) for x in r.rows] == [["Jan 04, 2024 10:00", "1.20**Estimated"], ["Jan 04, 2024 11:00", "1&2"]]


def test_table_inside_classed_div(spark):
    html = '<div class="CenteredGrid"><table><tr><td>a</td><td>b</td><td>c</td></tr></table></div>'
    r = spark.createDataFrame([(html,)], "html string").select(html_table_rows(F.col("html")).alias("t")).first().t
    assert r.width == 3 and [list(x) for x in r.rows] == [["a", "b", "c"]]


def test_no_table(spark):
    r = spark.createDataFrame([("<p>none</p>",)], "html string").select(html_table_rows(F.col("html")).alias("t")).first().t
    assert r.width == 0 and list(r.rows) == []


NAV = (
    '<ul id="example"><li><a href="Default.aspx">Home</a></li>'
    '<li><p class="sf-with-ul">Sarita River</p><ul>'
    '<li><a href="Content%20Pages/Sarita/WaterLevel.aspx">Staff Gauge</a></li>'
    '<li><a href="Content%20Pages/Sarita/SiteInfo.aspx">Site Info</a></li></ul></li>'
    '<li><p class="sf-with-ul">Admin</p><ul><li><a href="Login.aspx">Login</a></li></ul></li></ul>'
)


def test_nav_links(spark):
    df = spark.createDataFrame([(1, NAV)], "page_id long, html string")
    rows = [tuple(r) for r in nav_links(df, keep=["page_id"]).orderBy("link_pos").collect()]
    assert rows == [
        (1, 0, None, 1, "Home", "Default.aspx"),
        (1, 1, "Sarita River", 2, "Staff Gauge", "Content%20Pages/Sarita/WaterLevel.aspx"),
        (1, 1, "Sarita River", 3, "Site Info", "Content%20Pages/Sarita/SiteInfo.aspx"),
        (1, 2, "Admin", 4, "Login", "Login.aspx"),
    ]


SCRIPT = """<div id="main"><script type="text/javascript">
var locations = [
  ['Sarita River', 48.9, -124.9, 'http://x/a'],
  //['Old Station', 48.1, -124.1, 'http://x/b'],
  ['Short', 1.0, 2.0]
];
var other = [1];
</script></div>"""


def test_locations(spark):
    df = spark.createDataFrame([(SCRIPT,)], "html string")
    entries = df.select(F.explode(parse_locations(js_locations(F.col("html")))).alias("e")).collect()
    got = [(e.e["name"], e.e["lat"], e.e["long"]) for e in entries]
    # the commented entry is kept (slashes removed), the 3-part one dropped
    assert got == [("Sarita River", "48.9", "-124.9"), ("Old Station", "48.1", "-124.1")]


def test_locations_absent(spark):
    df = spark.createDataFrame([("<script>var x = 1;</script>",)], "html string")
    assert df.select(js_locations(F.col("html")).alias("x")).first().x is None


def test_nav_links_nested_sub_list(spark):
    html = (
        '<ul id="example"><li><p class="sf-with-ul">Sarita</p><ul>'
        '<li><a href="a.aspx">Staff Gauge</a><ul><li><a href="b.aspx">Voltage</a></li></ul></li>'
        '<li><a href="c.aspx">Site Info</a></li></ul></li>'
        '<li><a href="after.aspx">Outside</a></li></ul>'
    )
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    got = [(r.title, r.label) for r in nav_links(df, keep=["page_id"]).orderBy("link_pos").collect()]
    # anchors of the nested list belong to the entry; the one after it does not
    assert got == [("Sarita", "Staff Gauge"), ("Sarita", "Voltage"), ("Sarita", "Site Info")]


def test_thead_td_header_is_not_data(spark):
    html = ('<table class="CenteredGrid"><thead><tr><td>Time</td><td>Pressure</td></tr></thead>'
            "<tbody><tr><td>Jan 04, 2024 10:00</td><td>1.5</td></tr></tbody></table>")
    r = spark.createDataFrame([(html,)], "html string").select(html_table_rows(F.col("html")).alias("t")).first().t
    assert r.width == 2 and [list(x) for x in r.rows] == [["Jan 04, 2024 10:00", "1.5"]]


def test_unquoted_class_attributes(spark):
    html = "<table class=CenteredGrid><tr><td>Jan 04, 2024 10:00</td><td>2</td></tr></table>"
    r = spark.createDataFrame([(html,)], "html string").select(html_table_rows(F.col("html")).alias("t")).first().t
    assert r.width == 2 and [list(x) for x in r.rows] == [["Jan 04, 2024 10:00", "2"]]
    nav = '<li><p class=sf-with-ul>Sarita</p><ul><li><a href="x.aspx">Site Info</a></li></ul></li>'
    df = spark.createDataFrame([(1, nav)], "page_id long, html string")
    assert [(r.title, r.label) for r in nav_links(df, keep=["page_id"]).collect()] == [("Sarita", "Site Info")]


def test_station_links_follow_the_sidebar_structure(spark):
    from gaugeflow.sources.html import station_links

    page = (
        '<p class="sf-with-ul">Header</p><ul><li><a href="h.aspx">Site Info</a></li></ul>'
        '<div id="sidebar"><div class="c2"><ul class="m" id="example"><li><a href="Default.aspx">Home</a></li>'
        '<li><p class="sf-with-ul">Sarita</p><ul><li><a href="a.aspx">Staff Gauge</a></li>'
        '<li><p class="sf-with-ul">More</p><ul><li><a href="b.aspx">Voltage</a></li></ul></li>'
        '<li><a href="c.aspx">Voltage</a></li></ul></li>'
        '<li><p class="sf-with-ul">Empty</p><ul></ul></li>'
        '<LI><p class="sf-with-ul">Admin</p><UL><li><a href="Login.aspx">Login</a></li></UL></LI></ul></div></div>'
        '<p class="sf-with-ul">Footer</p><ul><li><a href="f.aspx">Site Info</a></li></ul>'
    )
    df = spark.createDataFrame([(1, page), (2, "<p class='sf-with-ul'>X</p><ul><li><a href='x'>Voltage</a></li></ul>"), (3, None)],
                               "page_id long, html string")
    got = [tuple(r) for r in station_links(df, keep=["page_id"]).orderBy("section_pos", "link_pos").collect()]
    assert got == [
        (1, 2, "Sarita", 1, "Staff Gauge", "a.aspx"), (1, 2, "Sarita", 2, "Voltage", "b.aspx"),
        (1, 2, "Sarita", 3, "Voltage", "c.aspx"), (1, 4, "Admin", 1, "Login", "Login.aspx"),
    ]


def _reference_lists(text):
    """The direct entries of the first list, and that list, cut tag by tag."""
    import re

    def walk(pattern):
        depth, out = 0, []
        for p in re.split(pattern, text):
            head = p.lower()
            if depth >= 0:
                after = depth + head.startswith("<ul") - (head.startswith("</ul>") and depth > 0)
                depth = -1 if depth > 0 and after == 0 else after
            out.append((p, depth))
        return out

    whole = "".join(p for p, d in walk(r"(?i)(?=</?ul\b)") if d >= 1)
    entries = []
    for p, d in walk(r"(?i)(?=</?ul\b)|(?=<li\b)"):
        if d == 1 and p.lower().startswith("<li"):
            entries.append(p)
        elif d >= 1 and entries:
            entries[-1] += p
    return whole, entries


def test_lists_by_either_way_equal_a_cut_tag_by_tag(spark):
    import random

    from gaugeflow.sources.html import first_list, list_entries

    rng = random.Random(3)
    tags = ["<ul>", "<UL id=x>", "</ul>", "</UL>", "</ul >", "<li>", "<Li a>", "</li>", "<link>", "<ulx>", "a", " b <", "<p>"]
    texts = ["<ul>" + "".join(rng.choices(tags, k=rng.randint(0, 14))) for _ in range(600)]
    texts += ["<ul><li>a<ul><li>b</li></ul></li><li>c</li></ul>z", "<ul><ul><li>x</li></ul><li>y</li></ul>", "<ul>"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", first_list("t").alias("f"), list_entries("t").alias("e")).collect()
    for r in got:
        assert (r.f, r.e) == _reference_lists(r.t), r.t


def test_sidebar_lists_are_cut_once(spark):
    from gaugeflow.plans.stations import station_urls

    df = spark.createDataFrame([(1, "u", NAV)], "page_id long, url string, html string")
    text = station_urls(df, "http://x/")._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("regexp_extract(html") == 1 and text.count("aggregate(") == 2  # entries, and the list of one

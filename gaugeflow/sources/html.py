"""Extraction from landed HTML: data tables, sidebar links and the
coordinates script. All of it is regular-expression and array work inside
Spark expressions, applied per page row, so it scales with the number of
pages and never needs a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.constants import DATA_TABLE_CLASS, NAV_LIST_ID, NAV_TITLE_CLASS
from gaugeflow.functions.text import cell_text, html_text, html_unescape, py_strip

_CLASS = r"""\bclass\s*=\s*(?:["'][^"']*\b{cls}\b[^"']*["']|{cls}(?=[\s>/]))"""
_TABLE_WITH_CLASS = r"(?is)<table\b[^>]*" + _CLASS + r"[^>]*>(.*)"
_TABLE_AFTER_CLASS = r"(?is)" + _CLASS + r"[^>]*>.*?<table\b[^>]*>(.*)"
_COMMENT = r"(?s)<!--.*?(?:-->|\z)"
_TABLE_TAG = r"(?i)(?=<table\b)|(?=</table\b)"
_ROW_TAG = r"<[tT][rR]\b[^>]*+>"
# A cell ends at its own closing tag, at the next cell or row end (closing tags
# may be left out) or with the row.
_CELL = r"<[tT][dDhH]\b([^>]*+)>([^<]*+(?:<(?!(?i:/?t(?:[dhr]|head|body|foot)\b))[^<]*+)*+)"
_SPAN = r"""(?i)(?:^|\s){name}\s*=\s*["']?\s*(\d+)"""
MAX_SPAN = 1000  # larger spans count as this, as browsers hold it
# Before a tag; one alternative, so that most characters fail at once.
_LIST_TAG = r"(?=</?[uU][lL]\b)"
_LIST_OR_ENTRY_TAG = r"(?=<(?:/?[uU][lL]|[lL][iI])\b)"
# The first list of a text, without its end tag, if no list is inside it.
_NO_LIST = r"[^<]*+(?:<(?!/?[uU][lL]\b)[^<]*+)*+"
_FLAT_LIST = r"\A[^<]*+(?:<(?![uU][lL]\b)[^<]*+)*+(<[uU][lL]\b" + _NO_LIST + r")(?=</[uU][lL]>|\z)"
# An entry whose lists hold no others, and a text that begins with a list of
# such entries (without the mark of list_entries).
_NO_ENTRY = r"<(?!(?:/?[uU][lL]|[lL][iI])\b)[^<\x01]*+"
_PLAIN_ENTRY = (r"<[lL][iI]\b[^<\x01]*+(?:" + _NO_ENTRY
                + r"|<[uU][lL]\b[^<\x01]*+(?:<(?!/?[uU][lL]\b)[^<\x01]*+)*+</[uU][lL]>[^<\x01]*+)*+")
_PLAIN_ENTRIES = r"\A(<[uU][lL]\b[^<\x01]*+(?:" + _NO_ENTRY + r")*+(?:" + _PLAIN_ENTRY + r")*+)(?=</[uU][lL]>|\z)"
LOCATIONS_MARK = "var locations = "
_ANCHOR = r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>"""


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), use), 0)


def without_comments(html) -> Column:
    """HTML without its comments (an unclosed one goes to the end)."""
    h = _c(html)
    return F.when(F.contains(h, F.lit("<!--")), F.regexp_replace(h, _COMMENT, "")).otherwise(h)


def _depths(pieces: Column) -> Column:
    """Per piece (cut before every table tag) how many tables inside the first
    one are open in it; -1 from the first one's end on."""
    zero = F.struct(F.lit(0).alias("now"), F.array().cast("array<int>").alias("all"))

    def step(acc: Column, p: Column) -> Column:
        head = F.lower(F.substring(p, 1, 7))
        change = F.when(head.startswith("</table"), -1).when(head.startswith("<table"), 1).otherwise(0)
        now = F.when(acc["now"] < 0, -1).otherwise(acc["now"] + change)
        return F.struct(now.alias("now"), F.array_append(acc["all"], now).alias("all"))

    return F.aggregate(pieces, zero, step, lambda acc: acc["all"])


def _up_to_its_end(tail: Column) -> Column:
    """The text after a table's opening tag up to that table's end. Tables
    inside it are left as their text without tags: they belong to the cell that
    holds them, their rows and cells are none of this table's."""
    def cut(pieces: Column) -> Column:
        inside = F.zip_with(pieces, _depths(pieces), lambda p, d: F.when(d == 0, p).when(
            d > 0, F.concat(F.lit(" "), F.regexp_replace(p, r"<[^>]*>", " "))))
        return F.array_join(F.filter(inside, lambda p: p.isNotNull()), "")

    def short(head: Column) -> Column:
        return F.when(head.rlike(r"</?[tT][aA][bB][lL][eE]"), _let(F.split(tail, _TABLE_TAG), cut)).otherwise(head)

    # mostly the text up to the first end tag holds no other table tag
    return F.when(F.contains(tail, F.lit("</table")), _let(F.substring_index(tail, "</table", 1), short)).otherwise(
        _let(F.split(tail, _TABLE_TAG), cut))


def data_table(html, cls: str = DATA_TABLE_CLASS) -> Column:
    """Inner HTML of the first table carrying ``cls`` (or the first table
    inside the first element carrying it), found by counting table tags, so
    tables inside its cells do not end it; null when the page has none.
    Comments are left out."""
    def after(h: Column, opening: str, otherwise) -> Column:
        def found(tail: Column) -> Column:
            return F.when(tail != "", _up_to_its_end(tail)).otherwise(otherwise)
        return _let(F.regexp_extract(h, opening.format(cls=cls), 1), found)

    def find(h: Column) -> Column:
        return after(h, _TABLE_WITH_CLASS, after(h, _TABLE_AFTER_CLASS, F.lit(None).cast("string")))

    return _let(without_comments(html), find)


def _span(attributes: Column, name: str) -> Column:
    # most cells have none: an empty text is not tried as a number
    n = _let(F.regexp_extract(attributes, _SPAN.format(name=name), 1), lambda t: F.when(t != "", t.try_cast("int")))
    return F.when(attributes == "", F.lit(1)).otherwise(
        F.coalesce(_let(n, lambda x: F.least(F.greatest(x, F.lit(1)), F.lit(MAX_SPAN))), F.lit(1)))


_HELD = "array<struct<col:int,text:string,left:int>>"


def span_grid(rows: Column) -> Column:
    """Rows of cells (``struct(text, across, down)``) laid out on a grid: a cell
    stands in ``across`` columns of ``down`` rows, later cells of those rows
    move on to the next free column. Rows that only cells from above reach past
    the last row are kept."""
    def lay(acc: Column, row: Column) -> Column:
        def place(held: Column) -> Column:
            units = F.flatten(F.transform(row, lambda c: F.array_repeat(
                F.struct(c["text"].alias("text"), c["down"].alias("left")), c["across"])))
            taken = F.transform(held, lambda h: h["col"])

            def join(u: Column) -> Column:
                places = F.sequence(F.lit(0), F.size(u) + F.size(held))
                free = F.slice(F.filter(places, lambda i: ~F.array_contains(taken, i)), 1, F.size(u))
                own = F.zip_with(free, u, lambda i, c: F.struct(i.alias("col"), c["text"].alias("text"), c["left"].alias("left")))
                return F.array_sort(F.concat(held, own), lambda x, y: x["col"] - y["col"])

            return _let(units, join)

        def keep(cells: Column) -> Column:
            below = F.transform(F.filter(cells, lambda c: c["left"] > 1), lambda c: F.struct(
                c["col"].alias("col"), c["text"].alias("text"), (c["left"] - 1).alias("left")))
            return F.struct(F.array_append(acc["rows"], F.transform(cells, lambda c: c["text"])).alias("rows"),
                            below.cast(_HELD).alias("held"))

        return _let(place(acc["held"]), keep)

    def run(r: Column) -> Column:
        deepest = F.coalesce(F.array_max(F.transform(F.flatten(r), lambda c: c["down"])), F.lit(1))
        none = F.filter(F.flatten(r), lambda c: F.lit(False))
        padded = F.concat(r, F.array_repeat(none, deepest - 1))
        zero = F.struct(F.array().cast("array<array<string>>").alias("rows"), F.array().cast(_HELD).alias("held"))
        laid = F.aggregate(padded, zero, lay, lambda acc: acc["rows"])
        return F.filter(laid, lambda row: F.size(row) > 0)

    return _let(rows, run)


def html_table_rows(html, cls: str = DATA_TABLE_CLASS) -> Column:
    """``struct(width int, rows array<array<string>>)`` of the data table.

    ``rows`` holds the cell texts of the table's own rows, without its header:
    the rows of its ``<thead>`` or, where it has none, the first rows without a
    ``<td>`` cell (column names are assigned by position anyway). ``rowspan``
    and ``colspan`` are laid out, header and body each by themselves. ``width``
    is the widest row, header included, which is the column count a table
    reader would produce. Rows without cells are no rows.
    """
    def rows_of(table: Column) -> Column:
        raw = F.slice(F.split(table, _ROW_TAG), 2, 1 << 30)

        def plain(rows: Column) -> Column:
            return F.transform(rows, lambda r: F.regexp_extract_all(r, F.lit(_CELL), 2))

        def spanned(rows: Column) -> Column:
            return span_grid(F.transform(rows, lambda r: F.zip_with(
                F.regexp_extract_all(r, F.lit(_CELL), 1), F.regexp_extract_all(r, F.lit(_CELL), 2),
                lambda a, t: F.struct(t.alias("text"), _span(a, "colspan").alias("across"),
                                      _span(a, "rowspan").alias("down")))))

        def has_cell(row: Column) -> Column:
            return row.rlike("<[tT][dD]")

        def parts(raw: Column) -> Column:
            head = F.regexp_extract(table, r"(?is)<thead\b[^>]*>(.*?)(?:</thead\b|<tbody\b|\z)", 1)
            n_head = F.when(table.rlike("<[tT][hH][eE][aA][dD]"), F.size(F.split(head, _ROW_TAG)) - 1).otherwise(0)
            # mostly the first or second row: the others are not searched then
            data_at = F.when(has_cell(F.get(raw, 0)), 1).when(has_cell(F.get(raw, 1)), 2).otherwise(
                F.array_position(F.transform(raw, has_cell), True))
            top = F.when(data_at > 0, data_at - 1).otherwise(F.size(raw)).cast("int")
            n = F.when(n_head > 0, n_head).otherwise(top)
            spans = table.rlike("[sS][pP][aA][nN]")

            def grid(rows: Column) -> Column:
                # header and body each: mostly the spans are in the header only
                held = spans & F.exists(rows, lambda r: r.rlike(r"(?i)\b(?:row|col)span\b"))
                return F.when(held, spanned(rows)).otherwise(F.filter(plain(rows), lambda r: F.size(r) > 0))

            def both(n: Column) -> Column:
                return F.struct(grid(F.slice(raw, 1, n)).alias("head"),
                                grid(F.slice(raw, n + 1, F.greatest(F.size(raw), F.lit(1)))).alias("rows"))

            return _let(n, both)

        return _let(raw, parts)

    def result(t: Column) -> Column:
        width = F.array_max(F.transform(F.concat(t["head"], t["rows"]), F.size))
        rows = F.transform(t["rows"], lambda r: F.transform(r, cell_text))
        return F.struct(F.coalesce(width, F.lit(0)).cast("int").alias("width"), rows.alias("rows"))

    none = F.struct(F.lit(0).alias("width"), F.array().cast("array<array<string>>").alias("rows"))
    return _let(data_table(html, cls), lambda table: F.when(table.isNull(), none).otherwise(
        _let(rows_of(table), result)))


def _list_depths(pieces: Column) -> Column:
    """Per piece (cut before every list tag, and maybe before entries) how many
    lists are open in it; -1 once the first list has ended."""
    def change(p: Column) -> Column:
        return F.when(F.lower(F.left(p, F.lit(3))) == "<ul", 1).when(F.lower(F.left(p, F.lit(5))) == "</ul>", -1).otherwise(0)

    def step(acc: Column, change: Column) -> Column:
        before = F.element_at(acc, -1)
        now = F.when((before < 0) | ((before > 0) & (before + change == 0)), -1).otherwise(F.greatest(before + change, F.lit(0)))
        return F.array_append(acc, now)

    return F.aggregate(F.transform(pieces, change), F.array(F.lit(0)), step, lambda acc: F.slice(acc, 2, 1 << 30))


def first_list(text) -> Column:
    """The first ``<ul>...</ul>`` of ``text`` with every list nested in it.

    A list that holds no other is matched as one text. Otherwise the text is cut
    before each ``<ul`` and ``</ul>``; only the depths are folded, so nested
    lists stay inside and the first list ends where its depth returns to zero."""
    def cut(pieces: Column) -> Column:
        kept = F.zip_with(pieces, _list_depths(pieces), lambda p, d: F.when(d >= 1, p))
        return F.array_join(F.filter(kept, lambda p: p.isNotNull()), "")

    t = _c(text)
    return _let(F.regexp_extract(t, _FLAT_LIST, 1), lambda flat: F.when(flat != "", flat).otherwise(_let(F.split(t, _LIST_TAG), cut)))


def list_entries(text) -> Column:
    """The direct ``<li>`` entries, as texts, of the first list of ``text``.

    Where the lists inside the entries hold no others, the entries are matched
    as they are. Otherwise the text is cut before each ``<ul``, ``</ul>`` and
    ``<li``; the entries that open at depth one are marked and the text is cut
    once more at the marks."""
    mark = "\u0001"

    def cut(pieces: Column) -> Column:
        def piece(p: Column, d: Column) -> Column:
            own = (d == 1) & (F.lower(F.substring(p, 1, 3)) == "<li")
            return F.when(d >= 1, F.concat(F.when(own, F.lit(mark)).otherwise(F.lit("")), p))

        kept = F.filter(F.zip_with(pieces, _list_depths(pieces), piece), lambda p: p.isNotNull())
        return F.slice(F.split(F.array_join(kept, ""), mark), 2, 1 << 30)

    def entries(t: Column) -> Column:
        return _let(F.regexp_extract(t, _PLAIN_ENTRIES, 1), lambda plain: F.when(
            plain != "", F.regexp_extract_all(plain, F.lit(_PLAIN_ENTRY), 0)).otherwise(
            _let(F.split(F.translate(t, mark, ""), _LIST_OR_ENTRY_TAG), cut)))

    return _let(_c(text), entries)


def station_links(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """One row per link of a page's station sidebar, in ``nav_links``' columns.

    The sidebar is the list with the id ``NAV_LIST_ID``. Each of its direct
    entries with a title is a section: the first title in the entry names it,
    titles of nested menus do not, and all anchors of the entry's list, nested
    ones included, are its links. Titles and links outside that list are no
    stations; a page without it gives no rows.
    """
    keep = keep if keep is not None else [c for c in pages.columns if c != html]
    opening = r"""(?is)(<ul\b[^>]*\bid\s*=\s*["']?""" + NAV_LIST_ID + r"""\b.*)"""
    title = r"(?is)<p\b[^>]*" + _CLASS.format(cls=NAV_TITLE_CLASS) + r"[^>]*>(.*?)</p>"

    def section(li: Column, pos: Column) -> Column:
        anchors = _let(first_list(li), lambda body: F.zip_with(
            F.regexp_extract_all(body, F.lit(_ANCHOR), 2), F.regexp_extract_all(body, F.lit(_ANCHOR), 1),
            lambda label, href: F.struct(label.alias("label"), href.alias("href"))))
        return _let(F.get(F.regexp_extract_all(li, F.lit(title), 1), 0), lambda t: F.when(t.isNotNull(), F.struct(
            (pos + 1).cast("int").alias("pos"), _let(t, html_text).alias("title"), anchors.alias("links"))))

    # The outer forms: the others make Spark test the array for rows first, which
    # computes it, and all it is made of, once more; and what a generator gives is
    # not computed again in the filters that follow.
    sections = F.transform(list_entries(F.regexp_extract(html, opening, 1)), section)
    held = pages.where(F.instr(F.col(html), NAV_TITLE_CLASS) > 0).select(*keep, F.explode_outer(sections).alias("_s"))
    links = held.select(*keep, F.col("_s.pos").alias("section_pos"), F.col("_s.title").alias("title"),
                        F.posexplode_outer("_s.links").alias("_i", "_l"))
    texts = links.where(F.col("_i").isNotNull()).select(
        *keep, "section_pos", "title", (F.col("_i") + 1).cast("int").alias("link_pos"), F.explode(F.array(F.struct(
            _let(F.col("_l.label"), html_text).alias("label"), _let(F.col("_l.href"), html_unescape).alias("href")))).alias("_t"))
    return texts.select(*keep, "section_pos", "title", "link_pos", F.col("_t.label").alias("label"), F.col("_t.href").alias("href"))


def nav_links(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """One row per link of a page's sidebar.

    The page is cut at every ``<p class="sf-with-ul">`` title. Links of a
    titled section are the anchors of the first ``<ul>`` after its title;
    anchors before the first title get ``section_pos`` 0 and a null title.
    Output: ``keep`` columns + ``section_pos, title, link_pos, label, href``;
    ``link_pos`` numbers the links of a page in document order from 1.
    Sections and links are numbered inside the page row (array functions),
    so no shuffle is needed; the page text is split once, and the other
    expressions run on the section or anchor texts only.
    """
    keep = keep if keep is not None else [c for c in pages.columns if c != html]
    title_split = r"(?is)<p\b[^>]*" + _CLASS.format(cls=NAV_TITLE_CLASS) + r"[^>]*>"
    h = F.col(html)
    # Pages without a titled section are one untitled section (no split).
    sections = F.when(F.instr(h, NAV_TITLE_CLASS) > 0, F.split(h, title_split)).otherwise(F.array(h))

    def cut(sec: Column, pos: Column) -> Column:
        # Title and the first list up to its first </ul>, each found once.
        titled = pos > 0
        return F.struct(
            pos.alias("pos"),
            sec.alias("sec"),
            F.when(titled, F.regexp_extract(sec, r"(?is)^(.*?)</p>", 1)).alias("title"),
            F.when(titled, F.regexp_extract(sec, r"(?is)<ul\b[^>]*>(.*?)</ul>", 1)).alias("flat"),
        )

    def section(c: Column) -> Column:
        # Only a first list holding another <ul> needs the depth-tracking fold.
        flat = c["flat"]
        nested = (F.instr(flat, "<ul") > 0) | (F.instr(flat, "<UL") > 0) | (F.instr(flat, "<Ul") > 0)
        body = F.when(c["pos"] == 0, c["sec"]).when(nested, first_list(c["sec"])).otherwise(flat)
        return F.struct(c["pos"].alias("pos"), c["title"].alias("title"), F.regexp_extract_all(body, F.lit(_ANCHOR), 0).alias("anchors"))

    cut_sections = pages.select(*keep, F.transform(sections, cut).alias("_c"))
    per_section = cut_sections.select(*keep, F.transform(F.col("_c"), section).alias("_s"))
    flat = F.flatten(
        F.transform(
            F.col("_s"),
            lambda s: F.transform(s["anchors"], lambda a: F.struct(s["pos"].alias("pos"), s["title"].alias("title"), a.alias("a"))),
        )
    )
    links = per_section.select(*keep, F.posexplode(flat).alias("p", "l"))
    return links.select(
        *keep,
        F.col("l.pos").cast("int").alias("section_pos"),
        html_text(F.col("l.title")).alias("title"),
        (F.col("p") + 1).cast("int").alias("link_pos"),
        html_text(F.regexp_extract(F.col("l.a"), _ANCHOR, 2)).alias("label"),
        html_unescape(F.regexp_extract(F.col("l.a"), _ANCHOR, 1)).alias("href"),
    )


def js_locations(html) -> Column:
    """Array literal text of ``var locations = [...];`` in the page's script:
    greedy to the last ``];`` of that script; null when absent."""
    scripts = F.split(_c(html), r"(?i)</script>")
    with_locations = F.filter(scripts, lambda s: s.contains(LOCATIONS_MARK))
    script = F.try_element_at(with_locations, F.lit(1))
    # Keep the text after the last opening script tag of that chunk.
    opened = F.split(script, r"(?i)<script\b")
    last = F.element_at(opened, -1)
    body = F.when(F.size(opened) > 1, F.regexp_replace(last, r"^[^>]*>", "")).otherwise(last)
    return F.nullif(F.regexp_extract(body, r"(?s)var locations = (\[.*\]);", 1), F.lit(""))


def _strip_brackets(c: Column) -> Column:
    return F.regexp_replace(c, r"^[\]\[]+|[\]\[]+$", "")


def parse_locations(text) -> Column:
    """Entries of a locations array literal as ``array<struct(name, lat, long)>``
    of texts, in source order.

    Brackets are stripped, every newline and slash removed (so a commented
    ``//[...]`` entry is kept), the text split on ``],``; each item is
    stripped, unquoted and split on ``", "``; items of exactly four parts
    are kept and their first three parts returned.
    """
    s = _strip_brackets(_c(text))
    s = F.regexp_replace(s, r"\n|/", "")
    items = F.transform(F.split(s, r"\],"), lambda i: _strip_brackets(py_strip(i)))
    parts = F.transform(items, lambda i: F.split(F.replace(i, F.lit("'"), F.lit("")), ", "))
    kept = F.filter(parts, lambda p: F.size(p) == 4)
    return F.transform(kept, lambda p: F.struct(p[0].alias("name"), p[1].alias("lat"), p[2].alias("long")))

"""Links, delimited cells and JSON pages on small inputs."""
import csv
import html
import io
import json
import random
from html.entities import html5
from html.parser import HTMLParser
from urllib.parse import unquote, urljoin, urlsplit

import pytest
from pyspark.sql import functions as F

from orestrata.functions.urls import anchor_hrefs, without_references
from orestrata.plans.exports import export_csv
from orestrata.session import staged
from orestrata.sources.contracts import FileContract, PageContract, SchemaDrift
from orestrata.sources.delimited import read_delimited, require_headers
from orestrata.sources.inventory import content_inventory
from orestrata.sources.json_pages import page_documents, parse_pages, require_pages
from orestrata.sources.links import EmptyListing, discover_links, require_links

BASE = "https://data.example.org/time.series/pr/"


class Anchors(HTMLParser):
    """The standard library's view of the same pages."""

    def __init__(self, html):
        super().__init__()
        self.hrefs = []
        self.feed(html)

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.hrefs += [value for name, value in attrs if name == "href" and value]


def children(html, base):
    root, names = urlsplit(base), set()
    for href in Anchors(html).hrefs:
        url = urlsplit(urljoin(base, href))
        same = (url.scheme, url.netloc) == (root.scheme, root.netloc)
        if not same or url.query or url.fragment or not url.path.startswith(root.path):
            continue
        name = unquote(url.path[len(root.path):])
        if name and not name.startswith(".") and not set(name) & set("/\\"):
            names.add(name)
    return names


PAGES = {
    "plain": '<html><a href="/time.series/pr/">[up]</a> <A HREF="pr.class">x</A> <a class=x href=\'pr.data.0.Current\'>y</a></html>',
    "escapes": '<a href="../ap/ap.data">no</a><a href="%2e%2e%2fsecret">no</a><a href="a%20b">yes</a><a href="x%5Cy">no</a><a href="a+b">yes</a>',
    "hosts": '<a href="https://other.example.org/time.series/pr/x">no</a><a href="//data.example.org/time.series/pr/same">yes</a>'
    '<a href="http://data.example.org/time.series/pr/scheme">no</a><a href="HTTPS://data.example.org/time.series/pr/upper">yes</a>',
    "parts": '<a href="q?x=1">no</a><a href="f#top">no</a><a href=".hidden">no</a><a href="./dot">yes</a><a href="sub/file">no</a><a href="t&amp;u">yes</a>',
    "noise": '<!-- <a href="commented">no</a> --><script>var s = \'<a href="scripted">no</a>\';</script><area href="area"><a name="x">no</a><a href=>no</a><a href="twice">1</a><a href="twice">2</a>',
}


def test_links_agree_with_the_standard_library(spark):
    pages = spark.createDataFrame(list(PAGES.items()), "page STRING, html STRING")
    found = {name: set() for name in PAGES}
    links = discover_links(pages, F.lit(BASE), keep=("page",))
    for row in links.collect():
        found[row.page].add(row.name)
        assert unquote(row.url).endswith("/" + row.name)
    assert found == {name: children(html, BASE) for name, html in PAGES.items()}
    assert found["plain"] == {"pr.class", "pr.data.0.Current"} and found["noise"] == {"twice"}
    assert links.filter("page = 'noise'").count() == 1
    require_links(pages, links, "page")


def test_hrefs_of_the_page_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("html", anchor_hrefs(F.col("html")).alias("hrefs"))
    for row in pages.collect():
        assert row.hrefs == Anchors(row.html).hrefs


def test_a_listing_without_links_is_an_error(spark):
    pages = spark.createDataFrame([("bare", "<p>maintenance</p>"), ("full", PAGES["plain"])], "page STRING, html STRING")
    with pytest.raises(EmptyListing, match="bare"):
        require_links(pages, discover_links(pages, F.lit(BASE), keep=("page",)), "page")


CONTRACT = (FileContract("points", r"points.*", ("key", "value")),)


def parse(spark, tmp_path, text, name="points"):
    folder = tmp_path / "landing"
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(text if isinstance(text, bytes) else text.encode())
    inventory = staged(spark, content_inventory(spark, str(folder)), "inventory")
    return read_delimited(spark, str(folder), inventory, CONTRACT)


@pytest.mark.parametrize(
    "line",
    [
        "a\t1", " a \t 1 ", "a\t1\t\t\t", "\t", 'a\t"1"', 'a\t"x\ty"', 'a\t"say ""x"" now"', 'a\tb"c', '"a"b\tc', 'a\t"" "', "a\t ",
        "a\u0001b\tc", 'x"\t"y"', '""\t""', '""', '" "\t"" ', '""""\t', ' ""\t', "\u2003a\u3000\t\u00a0", "\u2003\t\u3000",
    ],
)
def test_cells_agree_with_the_standard_library(spark, tmp_path, line):
    expected = next(csv.reader(io.StringIO(line), delimiter="\t"))
    expected = expected + [""] * (2 - len(expected))
    (row,) = parse(spark, tmp_path, f"key\tvalue\nfirst\tline\n{line}\n").lines.filter("fields['key'] <> 'first' OR problem IS NOT NULL").collect() or [None]
    if not any(cell.strip() for cell in expected):
        assert row is None
        return
    assert row.problem is None
    assert row.fields == {"key": expected[0].strip(), "value": expected[1].strip()}


def test_header_rules(spark, tmp_path):
    body = "\ufeff Key \tVALUE\tExtra\r\na\t1\tx\r\n\r\nb\t2\ty\r\n"
    read = parse(spark, tmp_path, body)
    require_headers(read.headers)
    assert read.headers.first()["columns"] == ["key", "value", "extra"]
    assert sorted(r.fields["extra"] for r in read.lines.collect()) == ["x", "y"]


@pytest.mark.parametrize(
    ("text", "problem"),
    [
        ("a\t1\n", "missing columns: key, value"),
        ("key\tvalue\tKey \na\t1\tb\n", "repeated column name"),
        ("  <HTML><body>denied\n", "HTML instead of data"),
        ("\nkey\tvalue\na\t1\n", "missing columns: key, value"),
        ("", "missing columns: key, value"),
        (b"key\tvalue\na\t1\nb\t\xff\xfe\n", "invalid UTF-8"),
    ],
)
def test_drifted_headers(spark, tmp_path, text, problem):
    read = parse(spark, tmp_path, text)
    assert read.headers.first()["problem"] == problem
    assert read.lines.count() == 0
    with pytest.raises(SchemaDrift, match="points"):
        require_headers(read.headers)


def test_bad_lines_are_reported_not_dropped(spark, tmp_path):
    text = "key\tvalue\na\t1\nshort\nlong\t1\t\t2\nopen\t\"x\nmarked\t\ufffd\n"
    problems = {r.bad_line.split("\t")[0]: r.problem for r in parse(spark, tmp_path, text).lines.filter("problem IS NOT NULL").collect()}
    assert problems == {"short": "wrong field count", "long": "wrong field count", "open": "open quote"}


PAGE = PageContract(
    "people", r".*", required=("Year", "Count"), columns=(("year", ("Year",)), ("place", ("New ID", "Old ID")), ("count", ("Count",))),
    defaults=(("place", ""),),
)


def test_page_rows(spark, tmp_path):
    rows = [
        {"Year": 2013, "Count": 316128839.0, "New ID": "n", "Old ID": "o"},
        {"Year": "2014", "Count": None, "Old ID": "o"},
        {"Year": 2015, "Count": 12.50, "New ID": None},
        {"Year": 2016, "Count": 1},
    ]
    (tmp_path / "page.json").write_text(json.dumps({"data": rows, "page": {"total": 4, "offset": 0}}, indent=1))
    read = parse_pages(page_documents(spark, str(tmp_path)), PAGE)
    require_pages(read.pages)
    assert [dict(r.fields) for r in read.rows.orderBy("row_number").collect()] == [
        {"year": "2013", "place": "n", "count": "316128839.0"},
        {"year": "2014", "place": "o", "count": None},
        {"year": "2015", "place": None, "count": "12.5"},
        {"year": "2016", "place": "", "count": "1"},
    ]


@pytest.mark.parametrize(
    ("page", "problem"),
    [
        ({"data": []}, "no data"),
        ({"page": {"total": 0}}, "no data"),
        ({"data": [{"Year": 1, "Count": 1}], "page": {"total": 2, "offset": 0}}, "partial page"),
        ({"data": [{"Year": 1, "Count": 1}], "page": {"total": 1, "offset": 1}}, "partial page"),
        ({"data": [{"Year": 1, "Count": 1}, {"Year": 1}]}, "missing keys"),
        ({"data": [{"Year": 1, "Count": 1}]}, None),
    ],
)
def test_page_problems(spark, tmp_path, page, problem):
    (tmp_path / "page.json").write_text(json.dumps(page))
    read = parse_pages(page_documents(spark, str(tmp_path)), PAGE)
    assert read.pages.first()["problem"] == problem
    assert read.rows.count() == (problem is None)


def test_very_long_tags_and_cells(spark, tmp_path):
    tag = F.concat(F.lit("<a "), F.repeat(F.lit('x="y" '), 20_000), F.lit('href="u">'))
    assert spark.range(1).select(anchor_hrefs(tag)).first()[0] == ["u"]
    cell = 'x""y' * 20_000
    (row,) = parse(spark, tmp_path, f'key\tvalue\na\t"{cell}"\n').lines.collect()
    assert row.problem is None and row.fields["value"] == 'x"y' * 20_000


def some_references(dice):
    names = sorted(html5)
    parts = [
        lambda: "&" + dice.choice(names),
        lambda: "&" + dice.choice(names).rstrip(";") + dice.choice(["", "x", "it;", "=", "1;", " "]),
        lambda: f"&#{dice.choice([0, 1, 9, 10, 12, 13, 38, 65, 127, 128, 129, 150, 159, 160, 55296, 64976, 65534, 65535, 128512, 1114111, 1114112, 10**12])}{dice.choice([';', '', 'a'])}",
        lambda: f"&#{dice.choice('xX')}{dice.choice(['0', '000041', '9f', '81', '1F600', 'FFFE', '110000', 'd800', 'FFFFFFFFFF', '7'])}{dice.choice([';', '', 'g'])}",
        lambda: dice.choice(["&", "&&", "&;", "&#;", "&#x;", "&amp;lt;", "&unknown;", "a", ";", " ", "&notit;", "&\u00e9", "plain"]),
    ]
    return "".join(dice.choice(parts)() for _ in range(dice.randint(1, 5)))


def test_character_references_agree_with_the_standard_library(spark):
    dice = random.Random(8)
    texts = [some_references(dice) for _ in range(3000)] + [f"&{name}" for name in html5] + ["", "none"]
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING").select("t", without_references(F.col("t")).alias("plain")).collect()
    assert [(r["t"], r["plain"]) for r in rows if r["plain"] != html.unescape(r["t"])] == []


def test_exported_files_are_in_order(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        export_csv(spark.range(2000).select((F.col("id") * 7919 % 2000).alias("n")), str(tmp_path / "out"), ["n"])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    files = sorted((tmp_path / "out").glob("*.csv"))
    assert len(files) > 1
    assert [int(line) for f in files for line in f.read_text().splitlines()[1:]] == list(range(2000))

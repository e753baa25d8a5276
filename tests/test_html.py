"""Extraction on invented pages."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.functions.jsontext import json_text
from roomledger.plans import daily, listing
from roomledger.schema import PAGE, RECORD
from roomledger.sources.html import extract
from roomledger.sources.matchers import Rule

DAY = datetime.date(2024, 5, 1)


def pages(spark, *rows):
    full = [(i, url, html, kind, "Hue", 0, "2024-05-01T00:00:00.000001", DAY)
            for i, (kind, url, html) in enumerate(rows)]
    return spark.createDataFrame(full, PAGE)


def test_selectors(spark):
    html = (
        "<p id=a class='x y'>one<p class=y>two <b>bold</b>&nbsp;&lt;3<br>line</p>"
        "<ul><li>first<li>second</ul><div data-a='v1'><span>in</span></div><span>out</span>"
        "<script>var s = '<li>no</li>';</script><!-- <li>no</li> --><i title=\"it's\">t</i>"
    )
    rules = [
        Rule("word", ".y"), Rule("id", "#a"), Rule("both", "p.x.y"), Rule("nth", "li:nth-child(2)"),
        Rule("inside", "[data-a] span"), Rule("beside", "[data-a*='v'] ~ span"),
        Rule("plain", "li"), Rule("attr", "i", take=("href", "title")), Rule("count", "li", take="count"),
        Rule("either", "b, i"), Rule("child", "> li", scope=("ul",)), Rule("bare", "span:not([class])"),
    ]
    row = extract(pages(spark, ("x", "u", html)), rules).first()
    got = {r.field: [c["text"] for c in row[r.field]] for r in rules}
    assert got == {
        "word": ["one", "two bold\xa0<3\nline"], "id": ["one"], "both": ["one"], "nth": ["second"],
        "inside": ["in"], "beside": ["out"], "plain": ["first", "second"], "attr": ["it's"],
        "count": ["#2"], "either": ["bold", "t"], "child": ["first", "second"], "bare": ["in", "out"],
    }


CARD = "<div data-testid='property-card'><a data-testid='title-link' href='/hotel/vn/{0}.vi.html?x'></a>{1}</div>"


def test_daily_run(spark, tmp_path):
    search = "<title>Stays</title>" + CARD.format("inn", "<div data-testid='title'>Inn</div>") + (
        CARD.format("inn", "<div data-testid='title'>Inn by the river, quiet rooms</div>")
        + "<div data-testid='property-card'>no link</div>"
    )
    detail = (
        "<h2 class='hp__hotel-name'>Inn</h2><meta itemprop='latitude' content='16.4'>"
        "<meta itemprop='longitude' content='107.6'>"
        "<div data-testid='facility-group'><h3>Food</h3><li>Bar</li></div>"
        "<div data-testid='facility-group'><h3>Food</h3><li>Cafe</li></div>"
    )
    table = pages(
        spark,
        ("search", "https://s.example.com/1", search),
        ("search", "https://s.example.com/2", "<title>Robot check</title>" + CARD.format("no", "")),
        ("search", "https://s.example.com/3", "<p>nothing</p>"),
        ("detail", "https://www.example.com/hotel/vn/inn.html", "<h2 class='hp__hotel-name'>old</h2>"),
        ("detail", "https://www.example.com/hotel/vn/inn.en-gb.html?x=1", detail),
    )
    for _ in range(2):
        run = daily.run_day(spark, table, str(tmp_path / "b"), str(tmp_path / "s"), 1)
    assert run.count() == 3
    silver = {r["hotel_id"]: r for r in spark.read.schema(daily.SILVER).parquet(str(tmp_path / "s")).collect()}
    assert set(silver) == {"inn", None}
    inn = silver["inn"]
    assert inn["name"] == "Inn by the river, quiet rooms" and inn["latitude"] == 16.4
    assert inn["facilities_all"] == {"Food": ["Cafe"]} and inn["availability_status"] == "available"
    kept = spark.read.schema(daily.SILVER).parquet(str(tmp_path / "s"))
    assert listing.child_rooms(kept).count() == 0
    assert listing.child_amenities(kept).count() == 0
    assert listing.child_review_categories(kept).count() == 0
    complete, counts = daily.report(run)
    assert {r["field"]: (r["filled"], r["percent"]) for r in complete.collect()}["name"] == (2, 66)
    assert [tuple(r) for r in counts.collect()] == [("Hue", 0, 3, 2, 1)]
    rejected = listing.rejected_pages(table.where("page_kind = 'search'")).collect()
    assert {(r["page_id"], r["reason"]) for r in rejected} == {(1, "blocked"), (2, "no cards")}
    assert [r["html"] for r in rejected if r["page_id"] == 2] == ["<p>nothing</p>"]


def test_records_have_the_declared_types(spark):
    table = pages(spark, ("search", "u", CARD.format("a", "")))
    records = daily.daily_records(table)
    kinds = {f.name: f.dataType.simpleString() for f in records.schema}
    for field in RECORD:
        assert kinds[field.name] == field.dataType.simpleString(), field.name


def test_json_text(spark):
    import json

    values = ({"đ": 12345678.1234567}, ["a", 'q"\n'], [("x", None, 15000000.0)])
    row = spark.createDataFrame(
        [values], "m map<string,double>, a array<string>, r array<struct<n:string,k:int,p:double>>"
    )
    texts = row.select(*[json_text(F.col(f.name), f.dataType) for f in row.schema]).first()
    expected = [values[0], values[1], [{"n": "x", "k": None, "p": 15000000.0}]]
    assert list(texts) == [json.dumps(v, ensure_ascii=False) for v in expected]


def test_workers_do_not_need_the_repository_folder(tmp_path):
    """A session started elsewhere, with the package only on the driver's path."""
    import pathlib
    import subprocess
    import sys

    root = pathlib.Path(__file__).resolve().parents[1]
    code = (
        f"import sys; sys.path.insert(0, {str(root)!r})\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "import __spark_entry__ as entry\n"
        "print(entry.queries()['page_fields'](spark, '/root/testdata/sf0.001').count())\n"
    )
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120
    )
    assert done.stdout.strip().splitlines()[-1:] == ["50"], done.stderr[-500:]


@pytest.mark.parametrize(
    "page", ['<a ' * 100_000, '\'"<b "' * 100_000, "<span>" * 50_000 + "</b>" * 50_000, "<!--" * 100_000,
             "<span>" * 20_000 + "<td></td>" * 50_000, "<script" * 100_000, '<a "x>' * 50_000]
)
def test_broken_markup_takes_linear_time(page):
    import time

    from roomledger.sources.html import _Page

    start = time.process_time()
    _Page(page)
    assert time.process_time() - start < 2


def test_a_page_that_fails_costs_only_itself(spark):
    table = pages(spark, ("search", "u", "<b>fine</b>"), ("search", "u", "<b>x</b><p>y</p>"), ("search", "u", ""))
    rules = [Rule("word", "b"), Rule("bad", "p", take=5)]  # a rule that fails where it finds an element
    rows = {r["page_id"]: r for r in extract(table, rules).collect()}
    assert [c["text"] for c in rows[0]["word"]] == ["fine"] and rows[0]["page_error"] is None
    assert rows[1]["units"] == 0 and rows[1]["unit"] is None and rows[1]["page_error"].startswith("TypeError")
    assert rows[2]["units"] == 1 and rows[2]["page_error"] is None


def test_rejects_hold_empty_pages(spark):
    table = pages(spark, ("search", "https://s/1", ""), ("search", "https://s/2", None))
    rows = {r["page_id"]: r["reason"] for r in listing.rejected_pages(table).collect()}
    assert rows == {0: "no cards", 1: "no cards"}


def test_later_batch_wins_whatever_its_page_ids(spark, tmp_path):
    def day(page_id, price):
        html = CARD.format("Inn", f"<span data-testid='price-and-discounted-price'>VND {price}</span>")
        return spark.createDataFrame(
            [(page_id, "https://s/1", html, "search", "Hue", 0, f"2024-05-01T{8 + page_id % 7:02}:00:00.000001", DAY)], PAGE)

    for batch, (page_id, price) in enumerate([(900, "500.000"), (5, "400.000")], 1):
        daily.run_day(spark, day(page_id, price), str(tmp_path / "b"), str(tmp_path / "s"), batch)
    silver = spark.read.schema(daily.SILVER).parquet(str(tmp_path / "s")).collect()
    assert [r["price_per_night_vnd"] for r in silver] == [400000.0]


def test_html_files_with_a_wrong_byte(spark, tmp_path):
    from roomledger.sources.pages import read_html_files

    (tmp_path / "a.html").write_bytes(b"<p>\xff ok")
    assert read_html_files(spark, str(tmp_path)).first()["html"] == "<p>\ufffd ok"


def test_first_card_of_a_page(spark):
    card = "<div data-testid='property-card'><h3>One</h3><P>two<br>three</P></DIV>"
    table = pages(
        spark, ("search", "a", f"<body>{card}<div data-testid='property-card'>next</div></body>"),
        ("search", "b", "<p>none</p>"), ("search", "c", None), ("search", "d", "<b data-hotelid=1>open"),
    )
    rows = {r["url"]: (r["has_card"], r["html"], r["text"]) for r in listing.card_dumps(table).collect()}
    assert rows == {
        "a": (True, card, "One\ntwo\nthree"), "b": (False, "<p>none</p>", None), "c": (False, None, None),
        "d": (True, "<b data-hotelid=1>open", "open"),
    }


def test_a_piece_of_a_value_is_found_behind_a_character_reference():
    from roomledger.sources.html import _Able, _Finder, _Page
    from roomledger.sources.matchers import Rule

    able = _Able([_Finder(Rule("link", "a[href*='b&c']", take=("href",))), _Finder(Rule("none", "a[href*='b&d']"))])
    page = _Page("<div><a href='/a'>x</a></div><p><a href='/b&amp;c'>y</a></p>")
    assert [f.rule.field for f in able.on(page, None)] == ["link"]
    assert able.on(page, page.nodes[0]) == [] and able.on(page, page.nodes[2])[0].run(page, page.nodes[2]) == [(0, 0, "/b&c")]


def test_json_text_escapes_what_needs_it(spark):
    texts = ["", "plain", "Hạ Long   \U0001f600", 'a "quote"', "back\\slash", "tab\t", "bell\x07", "del\x7f", "sl/ash"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select(json_text(F.col("t"), T.StringType()), F.to_json(F.array("t"))).collect()
    assert [f"[{mine}]" for mine, _ in got] == [theirs for _, theirs in got]
    bad = rows.limit(1).select(F.expr("cast(X'41FF' AS string)").alias("t"))
    mine, theirs = bad.select(json_text(F.col("t"), T.StringType()), F.to_json(F.array("t"))).first()
    assert f"[{mine}]" == theirs


def test_block_notices_are_not_searched(spark):
    """Their cards are dropped anyway; one row stays, as for a page without cards."""
    card = CARD.format("inn", "<div data-testid='title'>Inn</div>") * 2
    table = pages(
        spark,
        ("search", "https://s.example.com/1", "<title>Stays</title>" + card),
        ("search", "https://s.example.com/2", "<title>Access DENIED</title>" + card),
        ("search", "https://s.example.com/403", card),
    )
    found = listing.extract_cards(table, blocked=False)
    assert [(r.page_id, r.unit) for r in found.orderBy("page_id", "unit").collect()] == [(0, 0), (0, 1), (1, None), (2, None)]
    whole = listing.usable_cards(listing.extract_cards(table)).collect()
    assert listing.usable_cards(found).collect() == whole and len(whole) == 2


def test_siblings_of_the_unit(spark):
    """A sibling in front of the card itself counts for what is inside of the card."""
    html = "<i>a</i><p class=c><i></i><b>1</b></p><p class=c><i></i><b>2</b><u>3</u><b>4</b></p>"
    rules = [Rule("inside", "i ~ p b"), Rule("beside", "u ~ b"), Rule("none", "u ~ p b")]
    rows = extract(pages(spark, ("x", "u", html)), rules, [".c"]).orderBy("unit").collect()
    got = [[[c["text"] for c in row[r.field]] for r in rules] for row in rows]
    assert got == [[["1"], [], []], [["2", "4"], ["4"], []]]


def test_columns_are_built_once(spark, monkeypatch):
    """A second plan of the daily run takes few calls to the JVM (27,000 and more when each part is built again)."""
    table = pages(spark, ("search", "https://s.example.com/1", CARD.format("inn", "")))
    daily.bronze_rows(daily.daily_records(table))
    client = type(spark._sc._gateway._gateway_client)
    plain, calls = client.send_command, []
    monkeypatch.setattr(client, "send_command", lambda *args, **named: calls.append(1) or plain(*args, **named))
    again = daily.bronze_rows(daily.daily_records(table))
    assert len(calls) < 9000
    assert [r.hotel_id for r in again.collect()] == ["inn"]


def test_reading_a_page_makes_no_call_for_an_element_it_knows():
    import sys

    from roomledger.sources.html import _Page

    html = "<ul>" + "<li class='a'>one <b>two</b>\n" * 500 + "</ul>"
    _Page(html)
    calls = []
    sys.setprofile(lambda frame, event, _: calls.append(frame.f_code.co_name) if event == "call" else None)
    try:
        page = _Page(html)
    finally:
        sys.setprofile(None)
    assert len(page.nodes) == 1001 and calls.count("close") <= 501 and len(calls) < 520, len(calls)


def test_a_rule_that_climbs_out_of_its_unit(spark):
    html = "<p class=c><u>1</u><i>a</i></p><div><p class=c><b>x</b><i>b</i></p><u>2</u></div><script>1 < 2</script>"
    rules = [Rule("plain", "i"), Rule("up", "b", up="div", then="u"), Rule("script", "script", take="raw")]
    rows = extract(pages(spark, ("x", "u", html)), rules, [".c"]).orderBy("unit").collect()
    assert [[[c["text"] for c in row[r.field]] for r in rules] for row in rows] == [[["a"], [], []], [["b"], ["2"], []]]

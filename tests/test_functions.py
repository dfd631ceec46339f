"""Column functions on hand-written rows."""

import html
import math
from html.entities import html5

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions import dates, keys, money, nested, text, udfs, web
from larkspur.functions.charrefs import decode_references
from larkspur.functions.text import common_prefix

c = F.col


def apply(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", fn(c("x")).alias("y")).orderBy("i").collect()]


def test_locale_price(spark):
    cases = {
        "1'234.50": 1234.5, "1.234,50": 1234.5, "1,234.50": 1234.5, "12,50": 12.5, "12.50": 12.5, "1234": 1234.0,
        "1,234": 1234.0, "١٢٣٫٥": None, "٠٫٠": 0.0, None: None, "": None, "12 €": None, "12.50d": None, "1234,50": 1234.5,
    }
    assert apply(spark, list(cases), money.locale_price) == list(cases.values())


def test_loose_number(spark):
    cases = {"1.234.567": 1234.567, "€ 12.50": 12.5, "1,234": 1234.0, "": None, ".": None, None: None, "a1b2": 12.0, "١٢": 12.0}
    assert apply(spark, list(cases), money.loose_number) == list(cases.values())


def test_prefixed_amount(spark):
    got = apply(spark, ["$ 100", "INR 1000", "EUR 5", "$ x", None], lambda x: money.prefixed_amount(x, money.INCOME_RATES))
    assert [None if g is None else float(g) for g in got] == [100.0, 12.0, None, None, None]


def test_salary_samples(spark):
    values = ["10 - 20 triệu", "tới 15 triệu", "trên 12 triệu", "tới 2000 usd", "thoả thuận", "Tới 2,000 USD", "1.5 - 2 triệu"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = df.select("i", *[v.alias(k) for k, v in money.salary_columns(c("s")).items()]).orderBy("i").collect()
    assert [tuple(r)[1:] for r in got] == [
        (False, 10, 20, "M VND"), (False, None, 15, "M VND"), (False, 12, None, "M VND"), (False, None, 2000, "USD"),
        (True, None, None, "M VND"), (False, None, 2000, "USD"), (False, 5, 2, "M VND"),
    ]


def test_salary_repair(spark):
    rows = [
        (1, False, 0.0, 1000.0, "USD"), (2, False, 2e6, 3e6, "USD"), (3, False, 500.0, 2e6, "USD"),
        (4, True, 10.0, None, "USD"), (5, False, 5.0, 8.0, "M VND"),
    ]
    df = spark.createDataFrame(rows, "id int, negotiable boolean, salary_min double, salary_max double, salary_unit string")
    got = {r["id"]: (r["salary_min"], r["salary_max"], r["salary_unit"]) for r in money.repair_salaries(df).collect()}
    assert got[1] == (None, pytest.approx(25.554), "M VND")
    # the lower bound changes the unit, so the upper one is no longer in dollars
    assert got[2] == (pytest.approx(2.0), 3e6, "M VND")
    assert got[3] == (500.0, pytest.approx(2.0), "M VND")
    assert got[4] == (10.0, None, "M VND")
    assert got[5] == (5.0, 8.0, "M VND")


def test_head_count(spark):
    got = apply(spark, ["500-1000", "More than 1000", "5", "many", None, "a-b"], text.head_count)
    assert [tuple(g) for g in got] == [(500, 1000), (1001, None), (5, 5), (None, None), (None, None), (None, None)]
    assert [udfs.employees_of(x) for x in ["500-1000", "More than 1000", "5", "many", None]] == [tuple(g) for g in got[:5]]


def test_gender(spark):
    values = ["M", "male", "Man", "F", "Woman", "female", "w", "", None]
    want = ["Male"] * 3 + ["Female"] * 3 + ["Unknown"] * 3
    assert apply(spark, values, text.gender_label) == want
    assert [udfs.gender_of(v) for v in values] == want


def test_job_titles(spark):
    values = ["Data Scientist", "Software Engineer", "Sales Executive", "HR Manager", "Kỹ sư Hệ Thống", "Kế toán", "Nhân viên KINH DOANH"]
    assert apply(spark, values, text.job_category) == [
        "Data Science", "IT", "Sales", "Human Resources", "IT", "Other", "Sales"
    ]


def test_fold_accents(spark):
    values = ["Đà Nẵng", "Thừa Thiên Huế", "Straße Œuvre", "été", None]
    assert apply(spark, values, text.fold_accents) == ["da nang", "thua thien hue", "strasse oeuvre", "ete", None]


def test_height_and_region(spark):
    assert apply(spark, ["6-2", "5-11", "x", None], text.height_inches) == [74, 71, None, None]
    assert apply(spark, ["Austin, TX", "Samoa", "a,b,c"], text.region_part) == ["TX", "Samoa", "b"]


def test_label_and_tokens(spark):
    assert apply(spark, ["caloRie consuMed", "data engineer"], text.join_words) == ["Calorie_Consumed", "Data_Engineer"]
    assert apply(spark, ['Robert De Niro|"X"||Y', None], text.split_tokens) == [["Robert_De_Niro", "X", "Y"], None]


def test_html(spark):
    page = (
        '<html lang="vi"><head><style>p{}</style><script>if (a</b>) x("</p>");</script></head><body><!-- no\n -->'
        '<h1 class="a"> Nhẫn <b>Đẹp</b> </h1><p>Giá: 1.000...  &amp; hơn&#33;</p><span class="x base y">Ring</span></body></html>'
    )
    assert apply(spark, [page], text.clean_html) == ["nhẫn đẹp giá 1 000 & hơn!ring"]
    assert apply(spark, [page, "<p>"], lambda x: text.element_text(x, "span", "base")) == ["Ring", "fail"]
    assert apply(spark, [page], lambda x: text.element_text(x, "h1")) == ["Nhẫn Đẹp"]
    assert apply(spark, [page, "<html>"], lambda x: text.element_attribute(x, "html", "lang")) == ["vi", None]


def test_links(spark):
    md = '[A b](https://s.vn/a "t") [no](http://x.vn/b) [C](https://s.vn/c)'
    (got,) = apply(spark, [md], lambda x: text.markdown_links(x, "https://s.vn/"))
    # as in the original pattern, a label runs on to the next wanted address, and an address to the next blank
    assert [tuple(g) for g in got] == [("A b", "https://s.vn/a"), ("no](http://x.vn/b) [C", "https://s.vn/c)")]


def test_common_prefix(spark):
    groups = [
        ("a", ["abshdksajd", "abshiehand", "abshiehand", "ab"]), ("b", ["BeeBongBenh", "beebongBay", "1"]),
        ("c", ["upgrade", "UpgradeSkill"]), ("d", ["", "x"]), ("e", ["x" * 5000 + "a", "x" * 5000 + "b"]),
    ]
    df = spark.createDataFrame([(g, s) for g, ss in groups for s in ss], "g string, s string")
    low = F.lower("s")
    got = df.groupBy("g").agg(F.min(low).alias("lo"), F.max(low).alias("hi")).select("g", text.common_prefix(c("lo"), c("hi")).alias("p"))
    assert {r["g"]: r["p"] for r in got.collect()} == {"a": "ab", "b": "-1", "c": "upgrade", "d": "-1", "e": "x" * 5000}


def test_user_agents(spark):
    from larkspur.plans.clicks import AGENTS

    values = [a for a, _, _ in AGENTS] + [""]
    assert apply(spark, values, web.browser) == [b for _, b, _ in AGENTS] + [None]
    assert apply(spark, values, web.operating_system) == [o for _, _, o in AGENTS] + [None]


def test_authority(spark):
    cases = {
        "https://www.google.com/search?q=a b|c": "www.google.com", "facebook.com": "facebook.com", "x.de:8443/a": "x.de:8443",
        "": None, "  ": None, None: None, "a//b": None, "//cdn.org/x": "cdn.org", "http://[::1/x": None, "http:///p": None,
        "https://user@h.com?x#y": "user@h.com",
    }
    assert apply(spark, list(cases), web.authority) == list(cases.values())


def test_pages_and_suffix(spark):
    assert apply(spark, ["https://s.de/a.html?x=1", "https://s.de/a.html#b", "https://s.de/a.htm?x=b.html"], web.canonical_page) == [
        "https://s.de/a.html", "https://s.de/a.html", "https://s.de/a.htm.html"
    ]
    assert apply(spark, ["https://www.s.de:80/a", "s.co.uk/x", "", None], web.domain_suffix) == ["de", "uk", None, None]


def test_ipv4(spark):
    assert apply(spark, ["1.2.3.4", "255.255.255.255", "256.1.1.1", "1.2.3", "a.b.c.d", None], web.ipv4_number) == [
        16909060, 4294967295, None, None, None, None
    ]


def test_two_digit_years(spark):
    values = ["5/20/66", "1/2/30", "1/2/31", "12/31/29", "2/29/15", "2/29/16", "x", None]

    def iso(pivot):
        return [str(d) if d else None for d in apply(spark, values, lambda x: dates.two_digit_year_date(x, pivot))]

    tail = ["2029-12-31", None, "2016-02-29", None, None]
    assert iso(dates.SHELL_PIVOT) == ["1966-05-20", "2030-01-02", "1931-01-02"] + tail
    assert iso(dates.NOTEBOOK_PIVOT) == ["1966-05-20", "1930-01-02", "1931-01-02"] + tail


def test_calendars(spark):
    days = dates.calendar_span(spark, "2015-01-01", "2025-12-31")
    weeks = dates.sunday_week_attributes(days)
    assert weeks.count() == 4018
    import datetime as dt

    for r in weeks.where("day_of_month = 1 or day_of_year > 360").collect():
        d: dt.date = r["full_date"]
        assert r["week_of_year"] == int(d.strftime("%U"))
        assert (r["day_of_week"], r["day_of_week_short"]) == (d.strftime("%A"), d.strftime("%a"))
        assert r["is_weekday_or_weekend"] == ("Weekend" if d.weekday() > 4 else "Weekday")
    for r in dates.iso_week_attributes(days).where("day_of_month > 28").collect():
        d = dt.date.fromisoformat(r["full_date"])
        assert (r["day_of_week"], r["week_of_year"]) == (d.isoweekday(), d.isocalendar()[1])


def test_keys(spark):
    import hashlib

    df = spark.createDataFrame([("e1", "7"), ("e1", None), (None, "7")], "id string, p string")
    got = [tuple(r) for r in df.select(keys.sales_key(c("id"), c("p")), keys.fingerprint(c("id"), c("p"))).collect()]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert [g[0] for g in got] == [sha("e17"), sha("e1"), None]
    assert got[0][1] is not None and got[1][1] is None and got[2][1] is None


def test_json_shapes(spark):
    element = "struct<a:string>"
    got = apply(spark, ["", '{"a":"1"}', '[{"a":"1"},{"a":"2"}]', "[]", None], lambda x: nested.list_of(x, element))
    assert [None if g is None else [e["a"] for e in g] for g in got] == [[], ["1"], ["1", "2"], [], None]


def test_bad_json_is_all_null(spark):
    df = spark.createDataFrame([('{"id":"1","time_stamp":5}',), ('{"id":"1","time',), (None,)], "value string")
    got = nested.parse_json(df, "value", nested.CLICK_SCHEMA).select("id", "time_stamp").collect()
    assert [tuple(r) for r in got] == [("1", 5), (None, None), (None, None)]


def test_type_profile_and_schema(spark):
    docs = [
        '{"name":"J","age":30,"scores":[85,90.5],"profile":{"active":true,"deep":{"x":null}}}',
        '{"name":null,"age":"x","items":[{"k":1},{"k":2.5,"m":[]}]}', "not json", None,
    ]
    df = spark.createDataFrame([("t", d) for d in docs], "label string, doc string")
    profile = nested.type_profile(df, "doc", "label")
    got = {r["path"]: r["types"] for r in nested.path_types(profile).collect()}
    assert got == {
        "name": "NoneType,str", "age": "int,str", "scores": "list", "profile": "dict", "profile.active": "bool",
        "profile.deep": "dict", "profile.deep.x": "NoneType", "items": "list", "items.k": "float,int", "items.m": "list", "": "unreadable",
    }
    schema = nested.target_schema(profile)
    assert schema.simpleString() == (
        "struct<age:string,items:array<struct<k:double,m:array<string>>>,name:string,profile:map<string,string>,scores:array<string>>"
    )
    rounds = nested.type_profile(df, "doc", "label", levels=1)
    assert sorted(map(tuple, rounds.collect())) == sorted(map(tuple, profile.collect()))


def test_documents_of_any_depth(spark):
    def nest(n):
        return '{"a":' * n + "1" + "}" * n

    df = spark.createDataFrame([("t", nest(14)), ("t", nest(200)), ("u", nest(3)), ("u", "[[[[[[[[[[1]]]]]]]]]]"), ("u", "{}")], "label string, doc string")
    got = {(r["label"], r["path"]): (r["type"], r["n"]) for r in nested.type_profile(df, "doc", "label", levels=25).collect() if r["type"] != "int"}
    path = lambda n: ".".join("a" * n)
    assert got == {
        **{("t", path(n)): ("dict", 2 if n < 14 else 1) for n in range(1, 200)}, **{("u", path(n)): ("dict", 1) for n in (1, 2)},
    }


def test_schema_of_many_paths(spark):
    wide = "{" + ",".join(f'"k{i}":{i}' for i in range(20_000)) + "}"
    profile = nested.type_profile(spark.createDataFrame([("t", wide)], "label string, doc string"), "doc", "label")
    assert len(nested.target_schema(profile).fields) == 20_000


def test_function_registry(spark):
    assert udfs.column_function("extract_os") is web.operating_system
    with pytest.raises(ValueError):
        udfs.column_function("extract_mood")


def test_ratio_percent(spark):
    from larkspur.operators.aggregates import ratio_percent

    df = spark.createDataFrame([(1, 5.0, 0.0), (2, -5.0, 0.0), (3, 0.0, 0.0), (4, 1.0, 4.0)], "i int, p double, w double")
    got = [r[0] for r in df.orderBy("i").select(ratio_percent(c("p"), c("w"))).collect()]
    assert got == [math.inf, -math.inf, None, 25.0]


def test_click_schema_has_21_fields():
    assert len(nested.CLICK_SCHEMA.fields) == 21
    assert nested.CLICK_SCHEMA["option"].dataType == T.ArrayType(T.MapType(T.StringType(), T.StringType()))


def test_character_references_as_the_standard_library_decodes_them(spark):
    texts = [None, "", "plain", "&", "a&", "&&", "&;", "&#;", "&#x;", "&#xg;", "& amp;", "&am", "&amp", "&amp;lt;", "&notit;", "&#-1;", "&#x41 &#65&#66", "&" + "a" * 50 + ";"]
    for name in html5:
        texts += [f"a &{name}b", f"&{name.rstrip(';')}x&{name[:-1]};;", f"&&{name}é"]
    codes = [*range(0x180), *range(0xD7FE, 0xD802), *range(0xDFFE, 0xE002), *range(0xFDCE, 0xFDF2), 0xFEFF, 0xFFFE, 0x10000, 0x1FFFF, 0x10FFFF, 0x110000, 10**9, 2**64 + 65]
    for code in codes:
        texts += [f"&#{code};", f"x&#00{code}y", f"&#x{code:x};z", f"&#X000000000{code:X}"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", decode_references(F.col("t")).alias("u"))
    got = {r["i"]: r["u"] for r in df.collect()}
    for i, t in enumerate(texts):
        assert got[i] == (None if t is None else html.unescape(t)), t
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_common_prefix_of_long_texts(spark):
    df = spark.range(1).select(F.repeat(F.lit("a"), 40_000_000).alias("a"))
    both = df.select(common_prefix(F.concat("a", F.lit("x")), F.concat("a", F.lit("y"))).alias("p"))
    assert both.select(F.length("p")).first()[0] == 40_000_000

"""Column functions and scrubbing against fixed vectors."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F
from urllib.parse import urljoin

from rostrum.functions import casts, markup, names, text
from rostrum.operators import scrub


def values(spark, texts, *columns):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


def one(spark, texts, column):
    return [v[0] for v in values(spark, texts, column)]


SCRUB = [
    ("Caroline M.", "Caroline", None),
    ("Brantley IV", "Brantley", "IV"),
    ("J. R. Q.", "J. R. Q.", None),
    ('William "Bill" H.', "William", None),
    ("Smith Jr.", "Smith", "Jr."),
    ("Smith Jr", "Smith Jr", None),
    ("O Jr, X", "O X", "Jr,"),
    ("John (Jack) Sr.", "John", "Sr."),
    ("Mary IVan", "Maryan", "IV"),
    (' "A" x "B" ', "", None),
    ("a, b", "a b", None),
    ("Hank Jr. III", "Hank", "Jr."),
    ("", "", None),
    (None, None, None),
    ("\t Ann\xa0\n", "Ann", None),
    ("Ann\nB. C", "Ann\nB. C", None),
    ('Al "x\ny" Z', 'Al "x\ny" Z', None),
]


def test_scrub(spark):
    df = spark.createDataFrame([(i, c) for i, (c, _, _) in enumerate(SCRUB)], "i int, last_name string")
    out = scrub.scrub_column(df, "last_name", "suffix").orderBy("i").collect()
    assert [(r.last_name, r.suffix) for r in out] == [(n, s) for _, n, s in SCRUB]


def test_scrub_long_text(spark):
    """Whole texts: many initials, and one at the end of a long value."""
    many, single = "a B. c " * 20000, "word " * 40000 + "x Y. z"
    df = spark.createDataFrame([(1, many), (2, single)], "i int, last_name string")
    out = {r.i: r.last_name for r in scrub.scrub_column(df, "last_name", "s").collect()}
    assert out[1] == many.strip()
    assert out[2] == single.replace(" Y.", "")


def test_scrub_strips_quotes(spark):
    df = spark.createDataFrame([('Kim "K',)], "last_name string")
    assert scrub.scrub_column(df, "last_name", "s", strip_quotes=True).first().last_name == "Kim K"


def test_suffix_of_last_name_fills_in(spark):
    df = spark.createDataFrame([("Al Sr.", "Bo IV"), ("Al", "Bo IV")], "first_name string, last_name string")
    out = scrub.scrub_last_name(scrub.scrub_first_name(df, keep_suffix=True))
    assert sorted(r.suffix for r in out.collect()) == ["IV", "Sr."]


def test_legacy_scrub(spark):
    texts = ["Éva M. Smith, Jr.", 'A. B. "Bo" Lee', 'Al "Bo" C.']
    assert one(spark, texts, names.scrub_name_legacy(F.col("c"))) == ["Eva Smith", "A. B.  Lee", "Al"]


def test_int_cast(spark):
    texts = ["1", " 12 ", "+1", "-3", "1.0", "", "None", "1_0", None]
    assert one(spark, texts, casts.to_int(F.col("c"))) == [1, 12, 1, -3, None, None, None, None, None]


def test_votes(spark):
    texts = ["Yea", "Nay", "Aye", "No", "Present", None]
    assert one(spark, texts, casts.recode_vote(F.col("c"), casts.SENATE_VOTES)) == [1, 0, None, None, None, None]
    assert one(spark, texts, casts.recode_vote(F.col("c"), casts.HOUSE_VOTES)) == [1, 0, 1, 0, None, None]


@pytest.mark.parametrize("layout,texts", [
    (casts.SENATE_VOTE_DATE, ["December 5, 2018,  02:30 PM", "December 5, 2018, 2:30 pm"]),
    (casts.HOUSE_VOTE_DATE, ["5-Dec-2018", "05-Dec-2018"]),
    (casts.SENATE_MENU_DATE, ["Dec 5, 2018", "Dec 05, 2018"]),
    (casts.HOUSE_INDEX_DATE, ["5-Dec, 2018"]),
])
def test_dates(spark, layout, texts):
    day = datetime.date(2018, 12, 5)
    found = one(spark, [*texts, "not a date", "", None], casts.parse_date(F.col("c"), layout))
    assert found == [day] * len(texts) + [None] * 3


def test_introduced(spark):
    texts = [" (Introduced 01/03/2018) ", " (Submitted 01/03/2018) ", "x"]
    assert one(spark, texts, casts.introduced_date(F.col("c"))) == [datetime.date(2018, 1, 3), None, None]


def test_bill_numbers(spark):
    assert one(spark, ["h.r. 12"], text.clean_bill(F.col("c"))) == ["HR12"]
    parts = names.parse_bill(F.col("c"))
    found = values(spark, ["H.R.5 - A Bill - Again", "S.Amdt.123 to H.R.5", "nothing"],
                   parts["bill_id"], parts["amdt_id"], parts["bill_title"])
    assert found == [("HR5", None, "A Bill - Again"), ("HR5", "SAmdt123", "S.Amdt.123 to H.R.5"),
                     (None, None, None)]


def test_congress(spark):
    day = F.col("c").cast("date")
    found = values(spark, ["2018-06-01", "2019-06-01"], text.congress_number(day), text.session_number(day))
    assert found == [(115, 2), (116, 1)]


def test_people(spark):
    p = names.parse_politician(F.col("c"))
    texts = ["Rep. Smith, John A. [R-TX-5]", "Sen. Lee, Al [D-MA]", "Rep. Nobody", "Rep. X, Y [R-A-B-C]", None]
    found = values(spark, texts, p["first_name"], p["last_name"], p["party"], p["state"])
    none = (None,) * 4
    assert found == [("John A.", "Smith", "R", "TX"), ("Al", "Lee", "D", "MA"), none, none, none]


def test_full_name(spark):
    p = names.split_full_name(F.col("c"))
    found = values(spark, ["Lee, Ann", "Lee Ann", "Lee, Ann, Dr.", "Lee"], p["first_name"], p["last_name"])
    assert found == [("Ann", "Lee"), ("Ann", "Lee"), ("Ann", "Lee"), (None, "Lee")]


def test_transliterate(spark):
    texts = ["Éçä ß", "plain", "Łódź Ærø Œuvre", "“q” – it’s…", "é", "Nguyễn", None]
    expected = ["Eca ss", "plain", "Lodz AEro OEuvre", '"q" - it\'s...', "e", "Nguyen", None]
    assert one(spark, texts, text.transliterate(F.col("c"))) == expected


def test_positions(spark):
    assert one(spark, ["a-b--é-", "", "x"], text.char_positions(F.col("c"), "-")) == [[1, 3, 4, 6], [], []]


def test_urls(spark):
    bases = ["http://a.org/b/c/d?q=1#f", "https://a.org", "http://a.org/x/"]
    links = ["http://o.org/z?x", "//o.org/z", "/r/s", "e", "e/f?y", "../g", "../../../h", "./i", "?n=2", "#t",
             "", "j/../k", "..", "."]
    for base in bases:
        found = one(spark, links, text.resolve_url(F.lit(base), F.col("c")))
        assert found == [urljoin(base, link) if link else base for link in links], base


def test_markup(spark):
    html = ['<td class="x"> A &amp; B <a href="/p?x=1&amp;y=2">C&#39;s</a> &nbsp;D</td><td>2</td>']
    cell = markup.block(F.col("c"), "td")
    assert one(spark, html, markup.unescape(markup.own_text(cell))) == [" A & B "]
    assert one(spark, html, markup.unescape(F.get(markup.links(F.col("c")), F.lit(0)))) == ["/p?x=1&y=2"]
    assert one(spark, html, markup.unescape(markup.all_text(cell))) == [" A & B C's \xa0D"]
    assert one(spark, html, F.size(markup.blocks(F.col("c"), "td"))) == [2]
    assert one(spark, html, markup.block(F.col("c"), "th")) == [None]
    assert one(spark, ["&amp;lt;"], markup.unescape(F.col("c"))) == ["&lt;"]


def test_scripts_to_ascii(spark):
    cases = {
        "Чайковский, Щусев": "Chaikovskii, Shchusev", "Їжак Ґалаґан": "Izhak Galagan", "Ђорђе Њ": "Djordje Nj", "съезд ель": "s'ezd el'",
        "Θεόδωρος Ψ": "Theodoros Ps", "ΐώ": "io", "שָׁלוֹם": "shlvm", "مُحَمَّد ٢٠": "mhmd 20", "آب": "ab", "しゃしん": "shashin", "じょうほう": "jouhou", "マッチ": "matchi",
        "ニッポン": "nippon", "コーヒー": "kohi", "きゃく": "kyaku", "한글": "hangeul", "값 서울": "gap seoul", "中文 हिन्दी": "中文 हिन्दी", "Ünïcödé ß": None, "plain ~ text": "plain ~ text", "": "", None: None,
    }
    found = spark.createDataFrame([(k,) for k in cases], "c string").select("c", text.transliterate(F.col("c")).alias("x")).collect()
    for r in found:
        assert r.x == cases[r.c] or (r.c is not None and cases[r.c] is None and r.x.isascii()), (r.c, r.x)
    # a sign of the text's own stays
    assert spark.createDataFrame([("Юрий ~tilde",)], "c string").select(text.transliterate(F.col("c"))).first()[0] == "Iurii ~tilde"

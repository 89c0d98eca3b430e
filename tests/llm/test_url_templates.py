"""URL templates against their SQL, and what the trees make of planted paths."""

from __future__ import annotations

import duckdb
import pandas as pd

from rostrum.llm import url_templates
from rostrum.llm.queries import RULES


def judged(session, urls, rules=RULES):
    rows = [(i, u, "h", "p") for i, u in enumerate(urls)]
    df = url_templates.judge(session.createDataFrame(rows, "page_id bigint, url string, host string, path string"), rules)
    return {r.page_id: r for r in df.collect()}


def same_as_sql(session, urls, rules=RULES):
    found = judged(session, urls, rules)
    con = duckdb.connect()
    con.register("pages", pd.DataFrame({"page_id": range(len(urls)), "url": pd.Series(urls, dtype="string")}))
    want = con.execute(url_templates.sql(rules)).fetchall()
    assert sorted(map(tuple, found.values())) == sorted(want)
    return found


def test_host_path_and_rules(session):
    cases = {
        "HTTP://A.Example.ORG/es/x?q#f": ("a.example.org", "/es/x", "example.org/es/", "block"),
        "https://example.org/en/19": ("example.org", "/en/19", "example.org/en/1", "block"),
        "https://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"), "x://org/": ("org", "/", "org/", "allow"),
        "x://xorg/": ("xorg", "/", None, "allow"), "x://a.org": ("a.org", "", None, "allow"), "x://a.org?/fr/": ("a.org", "", None, "allow"),
        "x://A.com#/de/": ("a.com", "", None, "allow"), "x://a.com/FR/": ("a.com", "/FR/", None, "allow"), "x://É.com/fr/": ("É.com", "/fr/", "com/fr/", "allow"),
        "a://b://c/d": ("b:", "//c/d", None, "allow"), "://": ("", "", None, "allow"), "no scheme": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"),
        "x://a.com/de/\nline": ("a.com", "/de/\nline", "com/de/", "block"),
    }
    found = same_as_sql(session, list(cases))
    assert [(r.host, r.path, r.rule, r.verdict) for r in map(found.get, range(len(cases)))] == list(cases.values())


def test_templates(session):
    """Numbers and rare words become wildcards, like branches merge, unlike ones stay, and evidence spreads."""
    urls = [f"x://a.com/{lang}/{i}.html" for lang in ("fr", "de") for i in range(40)]          # decided by rules
    urls += [f"x://a.org/es/{i}" for i in range(60)] + [f"x://example.org/es/{i}" for i in range(40)]
    urls += [f"x://shop.net/{kind}/{i}" for kind in ("red", "blue", "green") for i in range(30)]  # alike
    urls += [f"x://shop.net/about/us/team{i}/{i:07x}f" for i in range(30)]                       # of another form
    urls += [f"x://new.net/es/{i}" for i in range(20)] + ["x://new.net/" + "/".join("abcdefghijk")]
    found = same_as_sql(session, urls)
    by = {u: found[i] for i, u in enumerate(urls)}
    assert by["x://shop.net/red/3"].template == by["x://shop.net/blue/4"].template == "/{~}/{n}"
    assert by["x://shop.net/about/us/team3/0000003f"].template == "/about/us/{s}/{x}"
    assert by["x://a.com/fr/1.html"].template == "/fr/{n}.html" and by["x://a.com/de/1.html"].template == "/de/{n}.html"
    assert by["x://new.net/" + "/".join("abcdefghijk")].template == "/{s}" * 8 + "/**"
    assert by["x://a.com/de/1.html"].blocked_share > 0.8 > 0.2 > by["x://a.com/fr/1.html"].blocked_share


def test_blocked_by_evidence_only(session):
    rules = (("allow", "good.net/"), ("block", "bad.net/spam/"), ("block", "b.net/"), ("allow", "b.net/"))
    urls = [f"x://bad.net/spam/{i}" for i in range(50)] + [f"x://good.net/news/{i}" for i in range(200)]
    urls += ["x://other.net/spam/7", "x://other.net/news/7", "x://other.net/else", "x://b.net/"]
    found = same_as_sql(session, urls, rules)
    assert [found[len(urls) - k].verdict for k in (4, 3, 2, 1)] == ["block", "allow", "allow", "block"]


def test_empty_and_repeated(session):
    assert judged(session, []) == {}
    rows = session.createDataFrame([(1, "x://a.com/de/1"), (1, "x://a.com/de/1"), (None, None)], "page_id bigint, url string")
    assert url_templates.judge(rows, RULES).groupBy("page_id").count().orderBy("page_id").collect() == [(None, 1), (1, 2)]
    long = "x://a.com/" + "/".join(["segment"] * 20_000)
    assert judged(session, [long, long + "?" + "q" * 100_000])[0].template.endswith("/**")


def test_no_python_in_the_plan(session):
    pages = session.createDataFrame([(1, "x://a.com/de/1")], "page_id bigint, url string")
    plan = url_templates.judge(pages.repartition(2), RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan

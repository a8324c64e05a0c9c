"""Operators 4, 6 and 10."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from duskwatch.llm.decontaminate import contamination, mark_documents, remove_contaminated
from duskwatch.llm.licences import BASE_PHRASES, evaluate, licence_table, parse_expression, scan_licences
from duskwatch.llm.redirects import Rule, judge_pages, node_of, page_links
from tests.llm.brute import letter_words

SCHEMA = "doc_id bigint, text string"


def test_expressions():
    assert parse_expression("MIT OR Apache-2.0 AND BSD-3-Clause") == ["mit", "apache-2.0", "bsd-3-clause", "and", "or"]
    assert parse_expression("(MIT or Zlib) and ISC rest of line") == ["mit", "zlib", "or", "isc", "and"]
    for bad in ("", "or MIT", "MIT and", "(MIT", "MIT (", "()", "with"):
        assert parse_expression(bad) == []
    assert parse_expression("MIT) */") == ["mit"]
    named, ok = evaluate(parse_expression("GPL-2.0-only WITH Classpath-exception-2.0 OR MIT"), {"mit"})
    assert named == {"gpl-2.0-only with classpath-exception-2.0", "mit"} and ok
    assert evaluate(parse_expression("MIT AND GPL-3.0-only"), {"mit"})[1] is False


def test_scan_agrees_with_every_place(spark):
    pick = random.Random(1)
    bits = ["under", "the", "MIT", "License", "license", "Apache", "version", "2", "CC", "BY-NC", "cc by nc", "é", "...", "under the MIT license", "apache license, version 2"]
    rows = [(k, " ".join(pick.choices(bits, k=pick.randint(0, 40)))) for k in range(200)]
    rows += [(900, None), (901, ""), (901, "CC-BY-NC CC-BY-NC"), (902, "x " * 50_000 + "under the mit license"),
             (903, "// SPDX-License-Identifier: Apache-2.0 OR GPL-2.0-only WITH Foo\nrest"), (904, "SPDX-License-Identifier: and"), (None, "cc by nc")]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as score", "2 as labels_2")
    got = {(r["doc_id"], r["n_words"], r["n_base"]): r for r in scan_licences(docs).collect()}
    for doc, text in rows:
        words, starts, labels = letter_words(text), [], set()
        for phrase, label in BASE_PHRASES.items():
            want = phrase.encode().split()
            own = [i for i in range(len(words)) if words[i:i + len(want)] == want]
            starts += own
            labels |= {label} if own else set()
        row = got[(doc, len(words), len(starts))]
        assert (row["first_word"], row["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert row["base_labels"] == ",".join(sorted(labels)) and labels <= set(row["labels"].split(","))
        assert 0 <= row["score"] <= 1
    more = [(1, "x = 1  # SPDX_License_Identifier = 'BSD-3-Clause'"), (2, "spdx license identifier is what files carry"), (3, "SPDX License Identifier MIT and so on"),
            (4, "SPDX-License-Identifier: (ISC OR Foo-1)\n * SPDX-License-Identifier: Zlib\n under the MIT license"), (5, "spdx license identifier ISC rest"),
            (6, "Permission is hereby granted, free of charge: under the MIT license, gnu lesser general public license gnu general public license")]
    found = {r["doc_id"]: (r["labels"], r["score"], r["n_base"]) for r in scan_licences(spark.createDataFrame(more, SCHEMA)).collect()}
    assert found == {1: ("bsd-3-clause", 1.0, 0), 2: ("", 0.0, 0), 3: ("", 0.0, 0), 4: ("foo-1,isc,mit,zlib", 1.0, 1), 5: ("isc", 1.0, 0),
                     6: ("gpl,lgpl,mit", 0.9, 1)}
    table = spark.createDataFrame([("Foo-1", "own"), ("Bar", None), (None, "x"), ("  ", "y"), ("Foo-1", "own")], "name string, label string")
    own = licence_table(table, "name", "label")
    assert own == {"bar": "bar", "foo-1": "own"} and licence_table(table.limit(0), "name") == {}
    with pytest.raises(ValueError):
        licence_table(table, "name", limit=1)
    notices = licence_table(spark.createDataFrame([("You may, freely, copy", "free")], "phrase string, label string"), "phrase", "label")
    few = spark.createDataFrame([(4, more[3][1]), (7, "x: you may freely copy / under the mit license")], SCHEMA)
    assert {r["doc_id"]: r["labels"] for r in scan_licences(few, notices=notices, identifiers=own).collect()} == {4: "isc,mit,own,zlib", 7: "free,mit"}
    tag = next(r for k, r in got.items() if k[0] == 903)
    assert tag["labels"] == "apache-2,gpl-2.0-only with foo" and tag["n_base"] == 0
    assert scan_licences(docs.limit(0)).count() == 0


def test_rules_and_aliases(spark):
    page = lambda to: f'<head><LINK href="{to}" rel="canonical"></head>'
    rows = [
        (1, "http://a.net/x", None), (2, "https://www.Example.net/en/1?q#f", ""), (3, "http://example.com/de/9", ""), (4, "http://badexample.com/de/9", ""),
        (5, "http://q.org/fr/", ""), (6, "http://net/x", ""), (7, "http://a.net", ""), (8, None, ""), (9, "no scheme", ""), (10, "http://h.io?x=/y", ""),
        # c -> b -> a.net (block); c is blocked through its alias
        (20, "http://b.io/1", page("http://a.net/y")), (21, "https://c.io/1#z", '<meta http-equiv="refresh" content="0; url=http://b.io/1">'),
        # a class with one blocked and one allowed address is allowed
        (30, "http://d.io/1", page("http://a.net/z")), (31, "http://e.io/1", page("http://d.io/1")), (32, "http://e.io/1", page("//q.org/fr/2")),
        (40, "http://f.io/a/b", page("../c")), (41, "http://g.io/1", page("/2")), (42, "http://g.io/2", "<link rel=canonical href=http://example.com/de/1>"),
        (50, "http://z.io/1", '<link rel="stylesheet" href="http://a.net/y"><a href="http://a.net/y">'), (50, "http://z.io/1", None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 as host", "2 as node", "3 as rule")
    got = {(r["page_id"]): (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_pages(pages).collect()}
    assert got[1] == ("a.net", "/x", "net/", "block")
    assert got[2] == ("www.example.net", "/en/1", "example.net/en/", "allow")
    assert got[3][2:] == ("example.com/de/", "block") and got[4][2:] == (None, "allow")
    assert got[5][2:] == ("org/fr/", "allow") and got[6][2:] == ("net/", "block") and got[7] == ("a.net", "", None, "allow")
    assert got[8] == got[9] == ("", "", None, "allow") and got[10][:2] == ("h.io", "")
    assert got[20][2:] == got[21][2:] == (None, "block")
    assert got[30][3] == got[31][3] == got[32][3] == "allow"
    assert got[41][3] == got[42][3] == "block" and got[50][3] == "allow"
    assert judge_pages(pages).count() == len(rows)
    more = spark.createDataFrame([("http://z.io/1", "http://a.net/q"), (None, "x")], "src string, dst string")
    assert {r["verdict"] for r in judge_pages(pages, redirects=more).where("page_id = 50").collect()} == {"block"}
    assert {r["verdict"] for r in judge_pages(pages, rules=(Rule("block", "a.net/"),)).where("page_id = 32").collect()} == {"block"}
    assert judge_pages(pages.limit(0)).count() == 0


def test_links_are_read_as_a_browser_does(spark):
    link = '<link rel="{}" href="{}">'
    cases = [  # page, html, where its link leads
        ("http://f.io/a/b", link.format("canonical", "../c"), "f.io/c"), ("http://f.io/a/b/", link.format("canonical", "./../../../x/."), "f.io/x/"),
        ("http://f.io/a", link.format("x canonical", "/d?a=1&amp;b=2#z"), "f.io/d?a=1&b=2"), ("http://f.io/q?x", link.format("CANONICAL", "?y"), "f.io/q?y"),
        ("http://f.io/e", link.format("canonical", "&#47;g&#x2F;&eacute;&amp;lt;&#38;gt;&#xD800;"), "f.io/g/&eacute;&lt;&gt;\ufffd"),
        ("http://f.io/a/b", '<base target=_top><BASE href="//h.io/k/l"><base href="/no">' + link.format("canonical", "m"), "h.io/k/m"),
        ("http://f.io/a/b", '<base href="../up/">' + link.format("canonical", "m"), "f.io/up/m"),
        ("http://f.io/r", """<meta content="5; URL='http://u.io/?v=http://w.io/'" http-equiv='Refresh'>""", "u.io/?v=http://w.io/"),
        ("http://f.io/s", link.format("canonical", "/go?u=http://w.io/x"), "f.io/go?u=http://w.io/x"),
        ("http://f.io", "<link rel=canonical href=n>", "f.io/n"), ("http://f.io/t", "é" * 200_000 + link.format("canonical", "/far"), "f.io/far")]
    none = ["<!-- " + link.format("canonical", "/c") + " -->", "<!-- " + link.format("canonical", "/c"), "<script>'" + link.format("canonical", "/c") + "'</script>",
            "<STYLE x>" + link.format("canonical", "/c"), link.format("canonical", ""), link.format("alternate", "/canonical"), '<link rel=canonical data-href="/c">',
            '<meta name="refresh" content="0; url=/c">', '<meta http-equiv="refresh" content="30">', link.format("canonical", "mailto:a@b"), link.format("canonical", "#top")]
    rows = [(url, html) for url, html, _ in cases] + [("http://n.io/1", html) for html in none] + [(None, cases[0][1]), ("http://n.io/1", None), ("x", cases[0][1])]
    links = page_links(spark.createDataFrame(rows, "url string, html string")).collect()
    found = spark.createDataFrame(links, "src string, dst string").select(
        node_of(F.col("src")).alias("a"), node_of(F.col("dst")).alias("b")).where("a != b").collect()
    assert sorted(r["b"] for r in found) == sorted(to for _, _, to in cases)
    # a page that repeats with links that clash is one node of both; a long chain of dots stays at the top
    pages = spark.createDataFrame([(1, "http://p.io/1", link.format("canonical", "http://a.net/x")), (1, "http://p.io/1", link.format("canonical", "http://q.org/fr/")),
                                   (2, "http://p.io/2", link.format("canonical", "../" * 300 + "1")), (3, "http://p.io/3", "<!--" + link.format("canonical", "http://a.net/x"))],
                                  "page_id bigint, url string, html string")
    assert [tuple(r) for r in judge_pages(pages).select("page_id", "verdict").orderBy("page_id").collect()] == [(1, "allow"), (1, "allow"), (2, "allow"), (3, "allow")]
    assert {r["page_id"]: r["verdict"] for r in judge_pages(pages, (Rule("block", "a.net/"),)).collect()} == {1: "block", 2: "block", 3: "allow"}


def test_decontamination_agrees_with_every_window(spark):
    pick = random.Random(8)
    known = [f"w{k}" for k in range(30)] + ["é"]
    items = [(k, " ".join(pick.choices(known, k=pick.randint(1, 25)))) for k in range(25)]
    items += [(100, None), (101, "..."), (102, "solo"), (103, items[0][1]), (None, "w1 w2"), (None, "one passage of a few words that no item id goes with"), (0, "another row of one item with ten words in all")]
    rows = []
    for k in range(120):
        words = pick.choices(known, k=pick.randint(0, 60))
        if k % 2:
            part = (pick.choice(items)[1] or "").split()
            at = pick.randint(0, len(words))
            words[at:at] = part[pick.randint(0, 3):]
        rows.append((k, ", ".join(words).upper()))
    rows += [(500, None), (501, ""), (501, "solo"), (502, "a " * 30_000 + items[0][1]), (None, items[0][1])]
    rows += [(503, "before one passage of a few words that no item id goes with after")]
    patterns = {}
    for item, text in items:
        words = letter_words(text)
        for at in range(max(1, len(words) - 9) if words else 0):
            patterns.setdefault(tuple(words[at:at + 10]), set()).update([item] if item is not None else [])
    want = []
    for doc, text in rows:
        words, hit, found = letter_words(text), set(), set()
        for pattern, owners in patterns.items():
            for at in range(len(words) - len(pattern) + 1):
                if words[at] == pattern[0] and tuple(words[at:at + len(pattern)]) == pattern:
                    hit.update(range(at, at + len(pattern)))
                    found |= owners
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        want.append((doc if doc is not None else -1, len(words), len(hit), len(found), digest, bool(hit)))
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as _hit_starts", "2 as n_hit")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for size in (1 << 20, 300):  # one slice of the benchmark, and several
        got = [(r[0] if r[0] is not None else -1, *r[1:]) for r in contamination(docs, bench, slice_bytes=size).collect()]
        assert sorted(got) == sorted(want)
    assert (503, 14, 12, 0, hashlib.sha256(b"").hexdigest(), True) in want
    marked = mark_documents(docs.select("doc_id", "text"), bench, slice_bytes=300)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in marked  # hits of several slices are read from tables
    clean = remove_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(w[0] for w in want if not w[5])
    assert contamination(docs.limit(0), bench).count() == 0
    assert {r["contaminated"] for r in contamination(docs, bench.limit(0)).collect()} == {False}

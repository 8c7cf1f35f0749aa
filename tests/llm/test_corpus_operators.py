"""Operators over the whole corpus: components, URL aliases, lines, decontamination, similarity."""

import itertools
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.llm import components, decontamination, jaccard, lines, quality, queries, urls
from tests.oracle_check import differences


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def word(rnd, n=3000):
    return f"w{rnd.randrange(n)}"


def unite(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


# --- components ---------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(2))
def test_components_equal_union_find(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(170)]
    edges += [(1000 + k, 1001 + k) for k in range(60)]  # a path
    edges += [(2000, 2001 + k) for k in range(200)] + [(7, 7), (1000, 1001)]  # a star, a loop, a repeat
    df = spark.createDataFrame([*edges, (None, 3), (4, None)], "u long, v long")
    got = {r.node: r.component for r in components.components(df).collect()}
    assert got == unite(edges)
    assert components.components(df.limit(0)).count() == 0


# --- URLs ---------------------------------------------------------------------------------


def page(k, url, html=None):
    return (k, url, html, "clash")


def test_url_verdicts(spark):
    canonical = '<link rel="canonical" href="http://www.b.net/x/">'
    refresh = "<META HTTP-EQUIV='refresh' content='0; url=https://shop.com/de/1'>"
    rows = [
        page(1, "https://Sub.Example.ORG/en/1?x#y"), page(2, "http://example.org/es/"), page(3, "http://a.org/es/"),
        page(4, "http://a.com/fr/2"), page(5, "http://a.com/de/2"), page(6, "http://notorg/"), page(7, None),
        page(8, "no scheme"), page(9, "http://a.net/1", canonical), page(10, "https://b.net/x", refresh),
        page(11, "https://shop.com/de/1"), page(12, "http://c.org/z", refresh), page(13, "http://b.net/x#top"),
        page(14, "http://lone.net/"), page(14, "http://lone.net/"), page(15, "http://org"), page(16, "http://org/", ""),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, component string")
    out = urls.judge(pages, urls.page_links(pages)).collect()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out}
    assert len(out) == len(rows)
    assert got == {
        1: ("sub.example.org", "/en/1", "example.org/en/1", "block"),
        2: ("example.org", "/es/", "example.org/es/", "block"),
        3: ("a.org", "/es/", "org/", "allow"), 4: ("a.com", "/fr/2", "com/fr/", "allow"),
        5: ("a.com", "/de/2", "com/de/", "block"), 6: ("notorg", "/", None, "allow"), 7: ("", "", None, "allow"),
        8: ("", "", None, "allow"), 9: ("a.net", "/1", None, "block"), 10: ("b.net", "/x", None, "block"),
        11: ("shop.com", "/de/1", "com/de/", "block"), 12: ("c.org", "/z", "org/", "allow"),
        13: ("b.net", "/x", None, "block"), 14: ("lone.net", "/", None, "allow"), 15: ("org", "", None, "allow"),
        16: ("org", "/", "org/", "allow"),
    }
    assert urls.judge(pages.limit(0), urls.page_links(pages.limit(0))).count() == 0


def test_relative_and_further_links_are_edges(spark):
    link = '<link rel="canonical" href="{}">'.format
    refresh = '<meta http-equiv="refresh" content="0; url={}">'.format
    rows = [
        page(1, "https://shop.com/de/1"), page(2, "http://a.net/de/x"), page(3, "http://blocked.example.org/en/1"),
        page(10, "http://shop.com/1", link("/de/1")), page(11, "https://m.net/1", link("//shop.com/de/1")),
        page(12, "http://shop.com/it/a/b?q", link("../../de/1")), page(13, "http://shop.com/de", refresh("./de/1")),
        page(14, "http://b.net/1", link("http://else.net/") + link("https://shop.com/de/1")),
        page(15, "http://c.net/1", refresh("/none") + refresh("https://shop.com/de/1")),
        page(16, "http://d.net/1", '<base href="https://shop.com/de/">' + link("1")),
        page(17, "http://e.net/1", link("/de/1")), page(18, "http://f.net/1", link("mailto:x@shop.com")),
        page(19, "no scheme", link("/de/1")), page(20, "http://g.net/1", link("?next=https://shop.com/de/1")),
        page(21, "http://h.net/1", link("#top")),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, component string")
    edges = {(r.u, r.v) for r in urls.page_links(pages).collect()}
    assert edges == {
        ("shop.com/1", "shop.com/de/1"), ("m.net/1", "shop.com/de/1"), ("shop.com/it/a/b?q", "shop.com/de/1"),
        ("shop.com/de", "shop.com/de/1"), ("b.net/1", "else.net"), ("b.net/1", "shop.com/de/1"), ("c.net/1", "c.net/none"),
        ("c.net/1", "shop.com/de/1"), ("d.net/1", "shop.com/de/1"), ("e.net/1", "e.net/de/1"),
        ("g.net/1", "g.net/1?next=https://shop.com/de/1"),
    }
    got = {r.page_id: r.verdict for r in urls.judge(pages, urls.page_links(pages)).collect()}
    assert {k for k, v in got.items() if v == "block"} == {1, 3, 10, 11, 12, 13, 14, 15, 16}


def odd_pages():
    """Pages whose links are written in ways that must, or must not, reach the blocked ones."""
    link, refresh = "<link rel={} href={}>".format, "<meta http-equiv={} content={}>".format
    aliases = [
        link('"canonical"', '"http://shop.com/de/q?a=1&amp;b=2"'), link("canonical", "http://shop.com/de/q?a=1&b=2"),
        link("'CANONICAL'", "'http://shop.com/de/q?a=1&#38;b=2'"), link('"alternate canonical"', '"http://shop.com/de/q?a=1&#x26;b=2"'),
        link('"canonical"', '"https://shop.com/de/o\'neil"'), "<LINK\nHREF = 'http://shop.com:80/de/o&#39;neil/'\n rel=canonical >",
        link("canonical", "https://SHOP.com:443/de/o'neil#x"), '<link href="https://www.shop.com:/de/o\'neil" data-x="1" rel="canonical"/>',
        refresh("refresh", '"0; URL=https://shop.com/de/o&apos;neil"'), refresh("'Refresh'", "' 5 , https://shop.com/de/o&#0039;neil'"),
        refresh("refresh", "'0;url=\"https://shop.com/de/caf&#233;&#x1F600;\"'"), link("canonical", '"https://shop.com/de/café😀"'),
        '<base target=_top><base href="https://shop.com/fr/x/">' + link("canonical", "'../../de/./o&#39;neil'"),
        '<base href="//shop.com/de/">' + link("canonical", '"o\'neil"'), "<!-- a --><!-- b -->" + link("canonical", '"//shop.com/de/o\'neil"'),
    ]
    others = [
        "<!-- " + link("canonical", '"https://shop.com/de/o\'neil"') + " -->", "<!-- " + link("canonical", '"https://shop.com/de/o\'neil"'),
        "<script>x = '" + link("canonical", '"https://shop.com/de/q?a=1&b=2"') + "'</script>", link("alternate", '"https://shop.com/de/o\'neil" title=canonical'),
        '<link data-rel="canonical" href="https://shop.com/de/o\'neil">', link("canonical", '""'), refresh("refresh", "30"), refresh("refresh", '"0;"'),
        link("canonical", '"http://shop.com:443/de/o\'neil"'), link("canonical", '"https://shop.com:8443/de/o\'neil"'), "canonical refresh", "", None,
        link("canonical", '"https://shop.com/de/q?a=1&amp;amp;b=2"'), link("canonical", '"https://shop.com/de/q?a=1&#0;b=2&#xD800;"'),
    ]
    blocked = ["http://shop.com/de/q?a=1&b=2", "https://shop.com/de/o'neil", "https://shop.com/de/café😀", "https://shop.com/de/"]
    rows = [page(k, u) for k, u in enumerate(blocked)] + [page(4, "http://m.com/fr/1", aliases[0]), page(5, None, aliases[0]), page(6, "none", aliases[0])]
    rows += [page(100 + k, f"http://a{k}.net/p/q", html) for k, html in enumerate(aliases)]
    rows += [page(200 + k, f"http://o{k}.net:8080/p/q", html) for k, html in enumerate(others)]
    return rows, {0, 1, 2, 3, *range(100, 100 + len(aliases))}


def test_links_do_not_repeat_their_parts_in_the_plan(spark):
    """Every step of a link names its input several times; a plan that writes that out fills the driver."""
    pages = spark.createDataFrame([("http://a.org/x", "<a>")], "url string, html string")
    assert len(urls.page_links(pages)._jdf.queryExecution().optimizedPlan().toString()) < 200_000


def test_links_of_any_spelling_equal_sql(spark, tmp_path):
    """Also over a chain of links, and beside a column that is called like one of the operator's."""
    rows, blocked = odd_pages()
    chain = [page(300 + i, f"http://c{i}.net/", f"<link rel=canonical href=http://c{i + 1}.net>") for i in range(6)]
    chain += [page(306, "http://c6.net", "<link rel=canonical href=http://a0.net/p/q>")]
    pages = spark.createDataFrame(rows + chain, "page_id long, url string, html string, tag string")
    pages.withColumn("base", F.lit("clash")).write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.op6_urls(spark, str(tmp_path)).toPandas()
    con = duckdb.connect()
    con.execute(f"create view pages as from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert differences(got, con.execute(queries.OP6_SQL).fetch_df()) is None
    assert set(got.page_id[got.verdict == "block"]) == blocked | {p[0] for p in chain}


@pytest.mark.parametrize("names", [("__key", "__text", "__place", "own"), ("row", "place", "hits", "windows")])
def test_columns_with_clashing_names_come_back(spark, names):
    """In every operator that returns the caller's columns, with nulls, repeated rows and a long text."""
    rnd = random.Random(5)
    item, long = prose(rnd, 30), prose(rnd, 20_000)
    rows = [(1, None), (2, ""), (3, f"{prose(rnd, 9)} {item}"), (3, f"{prose(rnd, 9)} {item}"), (4, long), (5, f"{long} end"), (None, long)]
    docs = docs_of(spark, rows)
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(name), F.coalesce("doc_id", F.lit(0))))
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    marked = decontamination.mark(docs, decontamination.overlaps(docs, bench))
    judged = quality.judge(docs, [0.0] * quality.BUCKETS)
    first = jaccard.keep_first(docs)
    for out, keys in ((marked, [r[0] for r in rows]), (judged, [r[0] for r in rows]), (first, [1, 2, 3, 4, None])):
        got = out.collect()
        assert Counter(r.doc_id for r in got) == Counter(keys)
        assert all(r[n] == f"{n}{r.doc_id or 0}" for r in got for n in names)
    assert {r.doc_id for r in marked.filter("contaminated").collect()} == {3}
    assert {r.n_words for r in judged.filter("doc_id = 5").collect()} == {20_001}
    none = docs.limit(0)
    assert decontamination.mark(none, decontamination.overlaps(none, bench)).count() == quality.judge(none, [0.0] * quality.BUCKETS).count() == 0


# --- lines --------------------------------------------------------------------------------


def prose(rnd, n):
    return " ".join(word(rnd, 100_000) for _ in range(n))


def test_templates_recur_and_copies_do_not_count(spark):
    rnd = random.Random(3)
    rows = []
    for k in range(12):  # a variable field with a digit, one without, and a licence
        rows.append((k, f"{prose(rnd, 30)}\nPosted on day {k} by somebody\n{prose(rnd, 20)}\nBrought to you by {word(rnd)}x today\nAll rights reserved."))
    copied = f"{prose(rnd, 30)}\n{prose(rnd, 25)}\nAll rights reserved."
    rows += [(100 + k, copied) for k in range(30)]
    rows += [(200, None), (201, ""), (202, "All rights reserved."), (203, "short line"), (None, "All rights reserved.\nx")]
    rows += [(0, rows[0][1])]
    docs = docs_of(spark, rows).withColumn("line", F.lit("clash")).withColumn("n_lines", F.lit("clash"))
    out = lines.drop_lines(docs).collect()
    assert len(out) == len(rows) and {r.line for r in out} == {"clash"}
    got = defaultdict(list)
    for r in out:
        got[r.doc_id].append((r.text, r.n_lines, r.n_dropped))
    for k in range(12):
        first, _, third, _, _ = rows[k][1].split("\n")
        assert got[k] == [(f"{first}\n{third}", 5, 3)] * (2 if k == 0 else 1)
    kept = "\n".join(copied.split("\n")[:2])
    assert all(got[100 + k] == [(kept, 3, 1)] for k in range(30))
    assert got[200] == [(None, 0, 0)] and got[201] == [("", 1, 0)] and got[202] == [("", 1, 1)]
    assert got[203] == [("short line", 1, 0)] and got[None] == [("x", 2, 1)]
    assert lines.drop_lines(docs.limit(0)).count() == 0


def letters(rnd, n):
    """Words without digits, which templates would take for variables."""
    return prose(rnd, n).translate(str.maketrans("0123456789", "abcdefghij"))


def test_pages_that_are_mostly_boilerplate_are_evidence(spark):
    """One shared line of 60 words over 50 words of their own: no copies by any measure."""
    rnd = random.Random(4)
    shared = letters(rnd, 60)
    rows = [(k, f"{shared}\n{letters(rnd, 50)}") for k in range(40)]
    # near copies of one text, each with two of its lines edited, stay whole
    lines_of = [letters(rnd, 40) for _ in range(12)]
    for k in range(30):
        own = list(lines_of)
        for j in rnd.sample(range(12), 2):
            own[j] = own[j].rsplit(" ", 1)[0] + f" {letters(rnd, 1)}y"
        rows.append((100 + k, "\n".join(own)))
    out = {r.doc_id: (r.text, r.n_dropped) for r in lines.drop_lines(docs_of(spark, rows)).collect()}
    for k, text in rows:
        assert out[k] == ((text.split("\n")[1], 1) if k < 100 else (text, 0)), k


def test_long_lines_recur_from_two_documents_on(spark):
    rnd = random.Random(6)
    own = lambda: letters(rnd, 40)
    long, short = letters(rnd, 30), letters(rnd, 8)
    footer, passage = "版权所有，保留一切权利2021。", "这是一个没有空格的很长的段落" * 4
    rows = [(k, f"{own()}\n{long}\n{own()}\n{short}") for k in range(2)]
    rows += [(10 + k, f"{own()}\n{footer.replace('2021', str(2000 + k))}\nContact us\nyes") for k in range(6)]
    rows += [(20 + k, f"{own()}\n{passage}\n{own()}\n{own()}") for k in range(2)]
    # two near copies share long lines and stay whole
    shared = "\n".join(own() for _ in range(10))
    rows += [(30 + k, f"{shared}\n{letters(rnd, 22)}") for k in range(2)]
    out = {r.doc_id: r.text.split("\n") for r in lines.drop_lines(docs_of(spark, rows)).collect()}
    for k, text in rows:
        parts = text.split("\n")
        gone = [1] if k < 2 or 20 <= k < 30 else [1, 2] if k < 20 else []
        assert out[k] == [p for i, p in enumerate(parts) if i not in gone], k


def test_a_chain_of_near_copies_is_one_unit(spark):
    """Neighbours of the chain are near copies, its ends are not; twelve other documents do share the line."""
    rnd = random.Random(12)
    line, spread = letters(rnd, 25), letters(rnd, 25)
    own, rows = [letters(rnd, 12) for _ in range(20)], []
    for k in range(12):
        rows.append((k, "\n".join([*own[:10], line, *own[10:]])))
        own[3 * k % 20], own[(3 * k + 1) % 20] = letters(rnd, 12), letters(rnd, 12)
    rows += [(100 + k, f"{letters(rnd, 30)}\n{spread}\n{letters(rnd, 30)}") for k in range(12)]
    rows += [(200, " ".join(letters(rnd, 30) for _ in range(2000)) + f"\n{spread}\n" + "\n".join(letters(rnd, 6) for _ in range(3000)))]
    out = {r.doc_id: (r.text, r.n_dropped) for r in lines.drop_lines(docs_of(spark, rows)).collect()}
    for k, text in rows:
        assert out[k] == ((text, 0) if k < 100 else (text.replace(f"\n{spread}", ""), 1)), k


def test_needed_documents_fall_step_by_step(spark):
    got = [r[0] for r in spark.range(0, 40).select(lines.needed(F.col("id"))).collect()]
    assert got == [5] * 10 + [4] * 5 + [3] * 5 + [2] * 20


@pytest.mark.parametrize("names", [("body", "gone", "row"), ("line", "template", "n"), ("__key", "__text", "__gone"), ("n_lines", "unit", "own")])
def test_lines_of_tables_with_clashing_names(spark, names):
    rows = [(k, f"own text {'abcdefghij'[k]} here\nAll rights are reserved by somebody") for k in range(6)]
    docs = docs_of(spark, rows)
    for name in names:
        docs = docs.withColumn(name, F.lit("clash"))
    out = lines.drop_lines(docs).collect()
    assert {r.n_dropped for r in out} == {1} and all(r[c] == "clash" for r in out for c in names if c != "n_lines")
    assert lines.drop_lines(docs.limit(0)).count() == 0


# --- decontamination ----------------------------------------------------------------------


def brute_overlap(doc, item):
    """Agreeing tokens of the best window at any place, tried one by one without seeds, and its width."""
    split = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    d, b = split(doc), split(item)
    best, width, where = 0, min(len(b), decontamination.WINDOW), defaultdict(list)
    for k, w in enumerate(b):
        where[w].append(k)
    places = {i - k for i, w in enumerate(d) for k in where.get(w, [])}
    for place in places:
        agree = [int(0 <= place + k < len(d) and d[place + k] == b[k]) for k in range(len(b))]
        best = max([best, *(sum(agree[s : s + width]) for s in range(len(b) - width + 1))])
    return best, width


def test_substituted_passages_are_found(spark):
    rnd = random.Random(5)
    items = [(k, " ".join(word(rnd) for _ in range(rnd.randrange(8, 50)))) for k in range(12)]
    items += [(50, "two words"), (51, ""), (52, None), (None, "an item without any key at all"), (0, items[0][1])]
    rows = []
    for k in range(60):
        own = [word(rnd) for _ in range(rnd.randrange(0, 80))]
        if k % 2:
            passage = items[k % 12][1].split()
            for _ in range(rnd.randrange(0, 6)):
                passage[rnd.randrange(len(passage))] = "other"
            cut = rnd.randrange(0, 3) * len(passage) // 8
            at = rnd.randrange(len(own) + 1)
            own[at:at] = passage[cut:]
        rows.append((k, " ".join(own)))
    rows += [(100, None), (101, ""), (102, "Two, WORDS!"), (None, items[3][1]), (5, rows[5][1]), (103, "an item without any key at all. " * 30)]
    rows += [(104, " ".join(word(rnd) for _ in range(20_000)) + " " + items[4][1])]
    docs = docs_of(spark, rows).withColumn("place", F.lit("clash")).withColumn("contaminated", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("hash", F.lit(1))
    found = decontamination.overlaps(docs, bench)
    out = decontamination.mark(docs, found).collect()
    assert len(out) == len(rows)
    want = Counter()
    for k, text in rows:
        hit = [(m, w) for _, item in items for m, w in [brute_overlap(text, item)] if item and m and 100 * m >= 80 * w]
        want[(k, bool(hit), max((100 * m // w for m, w in hit), default=0))] += 1
    assert Counter((r.doc_id, r.contaminated, r.best_match) for r in out) == want
    assert sum(c for _, c, _ in want) > 20
    assert decontamination.mark(docs, decontamination.overlaps(docs, bench.limit(0))).filter("contaminated").count() == 0
    assert decontamination.overlaps(docs.limit(0), bench).count() == 0


def test_masks_hit_every_pattern_that_counts():
    """Whichever tokens are substituted, some mask lies on agreeing ones only."""
    for n in range(1, 17):
        masks = [m for m, _, _ in decontamination._masks([n])]
        least = -(-decontamination.LEAST_PERCENT * n // 100)
        places = [{i + j for j, c in enumerate(m) if c == "1"} for m in masks for i in range(n - len(m) + 1)]
        for gone in itertools.combinations(range(n), n - least):
            assert any(not p.intersection(gone) for p in places), (n, gone)


def test_substitutions_at_any_place_are_found_without_seeds(spark):
    """Against an alignment that tries every place."""
    rnd = random.Random(9)
    items = [(n, [word(rnd, 100_000) for _ in range(n)]) for n in (*range(4, 13), 15, 16, 24)]
    rows, want = [], {}
    for n, own in items:
        width = min(n, decontamination.WINDOW)
        lose = width - -(-decontamination.LEAST_PERCENT * width // 100)
        patterns = list(itertools.combinations(range(width), lose)) + list(itertools.combinations(range(width), lose + 1))
        for gone in rnd.sample(patterns, min(len(patterns), 60)):
            passage = [f"other{k}" if k in gone or k >= width else w for k, w in enumerate(own)]
            doc = [word(rnd, 100_000) for _ in range(5)] + passage + ["end"]
            best = 0
            for place in range(-n, len(doc)):
                agree = [int(0 <= place + k < len(doc) and doc[place + k] == w) for k, w in enumerate(own)]
                best = max([best, *(sum(agree[s : s + width]) for s in range(n - width + 1))])
            want[len(rows)] = 100 * best // width if 100 * best >= decontamination.LEAST_PERCENT * width else 0
            rows.append((len(rows), " ".join(doc)))
    docs, bench = docs_of(spark, rows), spark.createDataFrame([(n, " ".join(w)) for n, w in items], "item_id long, text string")
    out = decontamination.mark(docs, decontamination.overlaps(docs, bench)).collect()
    assert {r.doc_id: r.best_match for r in out} == want


# --- similarity ---------------------------------------------------------------------------


def brute_sets(rows):
    out = []
    for k, text in rows:
        own = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        whole = {tuple(own)} if 0 < len(own) < 5 else {tuple(own[i : i + 5]) for i in range(len(own) - 4)}
        out.append((k, whole))
    return out


def brute_groups(rows):
    sets = brute_sets(rows)
    links = [
        (a, b)
        for i, (a, x) in enumerate(sets) for b, y in sets[:i]
        if None not in (a, b) and x and y and 100 * len(x & y) >= 80 * len(x | y)
    ]
    groups = unite(links)
    return Counter((k, len(x), groups.get(k, k)) for k, x in sets)


def edited(rnd, text, edits):
    own = text.split(" ")
    for _ in range(edits):
        at = rnd.randrange(len(own))
        own[at : at + rnd.randrange(2)] = [word(rnd)] * rnd.randrange(2)
    return " ".join(own)


def corpus(seed, hot=False):
    """Families around the threshold, of sizes from one word to hundreds, and odd rows."""
    rnd = random.Random(seed)
    passage = " ".join(word(rnd) for _ in range(60))
    rows = []
    for size in (1, 2, 4, 5, 6, 7, 8, 9, 10, 11, 13, 16, 20, 26, 34, 45, 60, 90, 150, 400):
        for _ in range(3):
            base = " ".join(word(rnd) for _ in range(size))
            if hot:
                base = f"{passage} {base}"
            for _ in range(rnd.randrange(2, 8)):
                rows.append((len(rows), edited(rnd, base, rnd.randrange(0, 2 + size // 25))))
    rows += [(len(rows) + k, t) for k, t in enumerate([None, "", " \n", rows[3][1], rows[40][1].upper(), rows[9][1] + "  "])]
    rows += [(None, rows[9][1]), (2, rows[2][1]), (5, rows[60][1])]
    return rows


@pytest.mark.parametrize("seed,hot,limits", [(1, False, {}), (2, True, {"SMALL": 2, "BLOCK": 5, "PIECE": 50, "PARTNERS": 2}), (3, True, {"SMALL": 2, "HOT": 2, "BLOCK": 5})])
def test_similar_groups_equal_brute_force(spark, monkeypatch, seed, hot, limits):
    """Also with small blocks, and with most signatures hot, so that neighbourhoods do the work."""
    for name, value in limits.items():
        monkeypatch.setattr(jaccard, name, value)
    rows = corpus(seed, hot)
    docs = docs_of(spark, rows).withColumn("n", F.lit("clash")).withColumn("sig", F.lit("clash"))
    out = jaccard.similar_groups(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute_groups(rows)


def test_one_of_each_group_stays(spark):
    rows = corpus(4)
    docs = docs_of(spark, rows).withColumn("component_id", F.lit("kept"))
    out = jaccard.keep_first(docs)
    assert out.columns == docs.columns
    groups = {k: c for k, _, c in brute_groups(rows)}
    got = Counter(r.doc_id for r in out.collect())
    assert got == Counter({k: 1 for k, c in groups.items() if k == c or k is None})
    assert jaccard.keep_first(docs.limit(0)).count() == 0


def test_sketches_never_overstate():
    rnd = np.random.default_rng(2)
    for n in (1, 3, 60, 64, 65, 100, 130, 1000):
        a = rnd.integers(0, 2**63, n).astype(np.uint64)
        for m in {n, n * 9 // 10, n * 5 // 4} - {0}:
            b = np.r_[a[: rnd.integers(0, min(n, m) + 1)], rnd.integers(0, 2**63, m).astype(np.uint64)][:m]
            apart = len(set(a.tolist()) ^ set(b.tolist()))
            assert jaccard.least_different(jaccard.sketch(a), jaccard.sketch(b)) <= apart


def test_pigeonhole_arithmetic():
    for n in (1, 2, 5, 9, 40, 333, 5000):
        for band in jaccard.bands_of(n):
            low, high = jaccard._bands(band + 1)[band]
            assert jaccard.spare(n, band) >= 0
            for partner in range(max(1, -(-n * 80 // 100)), n * 100 // 80 + 1):
                larger = max(n, partner)
                if low <= larger <= high:
                    assert band in jaccard.bands_of(partner)
                    assert jaccard.most_different(n, partner) <= jaccard.segments(band) - 1 - jaccard.spare(n, band)


# --- the pipeline -------------------------------------------------------------------------


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_copies", "decontamination", "bpe"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    planted = docs_of(spark, [(10**6, None), (10**6 + 1, ""), (10**6 + 2, docs.first().text)])
    bench = spark.read.parquet(f"{sf}/benchmark.parquet").first().text
    rnd = random.Random(9)
    leak = docs_of(spark, [(10**6 + 3, f"{prose(rnd, 40)} {bench} {prose(rnd, 40)}"), (10**6 + 4, prose(rnd, 90))])
    extra = planted.unionByName(leak).withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("x"), "n_chars": F.lit(0).cast("long")})
    now = docs.unionByName(extra)
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, sf)
        assert now.columns == docs.columns
        kept.append({r.doc_id for r in now.select("doc_id").collect()})
    assert kept[0] >= kept[1] >= kept[2] >= kept[3] and kept[0] == kept[1]
    assert 10**6 + 2 in kept[1] and 10**6 + 2 not in kept[2]
    assert 10**6 + 3 in kept[2] and 10**6 + 3 not in kept[3]
    assert {10**6, 10**6 + 1, 10**6 + 4} <= kept[3]
    last = corpus_pipeline.STAGES[-1][1](spark, now, sf)
    assert last.count() == len(kept[3])


def test_written_stages_delete_what_those_before_left(spark, tmp_path):
    import corpus_pipeline

    from demandloom.llm.common import shared_folder

    sf, tables = "/root/testdata/sf0.001", lambda: {p.name for p in Path(shared_folder(spark)).glob("table-*")}
    docs, before = spark.read.parquet(f"{sf}/documents.parquet"), tables()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[1:3]):
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
    assert corpus_pipeline._is_a_table(docs) and not corpus_pipeline._is_a_table(docs.union(docs))
    left = tables() - before
    corpus_pipeline.discard(spark, corpus_pipeline._scratch)
    assert left and not tables() - before


def test_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))

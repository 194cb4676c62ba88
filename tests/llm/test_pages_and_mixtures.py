"""Archives, URL verdicts, mixtures, the pipeline and the registered queries."""

import base64
import hashlib
import io
import math
import random
from collections import Counter, defaultdict
from fractions import Fraction
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pytest
from conftest import same_as_sql
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from tidemart.llm import mixing, queries, url_filter, warc

PAGES = "page_id long, url string, html string, host string"


def pages(spark, *rows):
    return spark.createDataFrame([(*r, "x") for r in rows], PAGES)


def test_archives_round_trip(spark):
    rows = [(1, "http://b.example/x#f", "same"), (2, "http://a.example/é?q", "same"), (3, None, None), (4, "no scheme\r\n", ""), (5, "http://a.example/", "é" * 70_000), (None, "http://c", "lone"), (2, "http://a.example/é?q", "same")]
    out = warc.archive_index(pages(spark, *rows)).orderBy("position").collect()
    assert len(out) == len(rows)
    for r in out:
        [(_, url, html)] = {x for x in rows if x[0] == r.page_id}
        raw = (html or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        assert r.url == (url and url.replace("\r", "%0D").replace("\n", "%0A"))
    kinds = Counter((r.page_id, r.record_type, r.refers_to) for r in out)
    assert kinds == {(1, "revisit", 2): 1, (2, "response", None): 2, (3, "revisit", 4): 1, (4, "response", None): 1, (5, "response", None): 1, (None, "response", None): 1}
    keys = [(r.url_key, r.captured) for r in out]
    assert keys == sorted(keys)
    assert warc.archive_index(pages(spark).limit(0)).count() == 0


def test_small_payloads_are_responses(spark):
    out = warc.archive_index(pages(spark, (1, "u://a", "ab"), (2, "u://b", "ab"), (3, "u://c", "abcdef"), (4, "u://d", "abcdef")), min_bytes=5).collect()
    assert {r.page_id: (r.record_type, r.refers_to) for r in out} == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}


def test_records_are_read_member_by_member():
    raw = b"".join(warc.record(i, f"http://x/{i}", b"p" * i, None if i % 2 else 7) for i in range(5))
    found = list(warc.read_records(io.BytesIO(raw)))
    assert [h["WARC-Type"] for _, _, h, _ in found] == ["revisit", "response"] * 2 + ["revisit"]
    assert sum(n for _, n, _, _ in found) == len(raw)
    with pytest.raises(EOFError):
        list(warc.read_records(io.BytesIO(raw[:-3])))


def test_runs_are_merged_from_their_files(spark, monkeypatch):
    monkeypatch.setattr(warc, "GROUP_BYTES", 2000)
    monkeypatch.setattr(warc, "STREAM_ROWS", 4)
    monkeypatch.setattr(warc, "BATCH_ROWS", 16)
    draw = random.Random(2)
    schema = T.StructType([T.StructField("page_id", T.LongType()), *(T.StructField(n, T._parse_datatype_string(k)) for n, k in warc.CAPTURE)])
    sizes = [draw.choice([0, 3, 400]) for _ in range(40)]
    captures = [[(draw.choice([None, 1, 2, draw.randrange(900)]), draw.choice(["hot", "hot", f"u{draw.randrange(50)}"]), f"d{draw.randrange(5)}", "u", "response", 1, "x", None, f"a{k}", i, 9) for i in range(n)] for k, n in enumerate(sizes)]

    def run(batches):
        for batch in batches:
            for k in batch.column(0).to_pylist():
                yield warc._batch(sorted(captures[k], key=warc.key_of), schema)

    runs = warc._run_files(warc._tasks(spark, len(sizes)).mapInArrow(run, schema))
    want = sorted((c for some in captures for c in some), key=warc.key_of)
    for fan_in, range_rows in ((100, 10_000), (7, 500), (3, 90)):
        got = warc.merge_runs(runs, "page_id", fan_in, range_rows).collect()
        got.sort(key=lambda r: r.position)
        assert [tuple(r)[:-2] for r in got] == want
        seen = Counter()
        for r in got:
            seen[r.url_key] += 1
            assert r.rank == seen[r.url_key]
    assert len({r.position >> 40 for r in got}) > 20  # the hot URL has many ranges

    held, most = 0, 0  # captures pulled from the files and not yet given out, over all streams
    files = [f for f, n in zip(sorted(runs.inputFiles()), sizes, strict=False)]

    def counted(path):
        nonlocal held, most
        for row in warc.run_stream(path):
            held += 1
            most = max(most, held)
            yield row

    for _ in warc.LoserTree(map(counted, files), warc.key_of):
        held -= 1
    assert most <= len(files) + 1 and held == 0


def test_every_pass_is_cut_into_ranges(spark, monkeypatch):
    """300 runs, 8 at a time: each of the passes has as many tasks as there are ranges, about."""
    monkeypatch.setattr(warc, "STREAM_ROWS", 4)
    monkeypatch.setattr(warc, "BATCH_ROWS", 64)
    schema = T.StructType([T.StructField("page_id", T.LongType()), *(T.StructField(n, T._parse_datatype_string(k)) for n, k in warc.CAPTURE)])
    captures = [[(k * 10 + i, f"u{(k * 7 + i * 13) % 90}", "d", "u", "response", 1, "x", None, f"a{k}", i, 9) for i in range(10)] for k in range(300)]

    def run(batches):
        for batch in batches:
            for k in batch.column(0).to_pylist():
                yield warc._batch(sorted(captures[k], key=warc.key_of), schema)

    runs, tasks, real = warc._run_files(warc._tasks(spark, 300).mapInArrow(run, schema)), [], warc._tasks
    monkeypatch.setattr(warc, "_tasks", lambda s, n: tasks.append(n) or real(s, n))
    got = warc.merge_runs(runs, "page_id", 8, 150).collect()
    assert [r.page_id for r in sorted(got, key=lambda r: r.position)] == [c[0] for c in sorted((c for some in captures for c in some), key=warc.key_of)]
    assert len(tasks) == 3 and min(tasks) >= 18 and max(tasks) < 60


def test_revisits_are_checked(spark):
    schema = "page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long"
    good = [(1, "response", 5, "A", None), (2, "revisit", 5, "A", 1)]
    warc._check_revisits(spark.createDataFrame(good, schema), "page_id")
    for bad in ((3, "revisit", 5, "B", 1), (3, "revisit", 4, "A", 1), (3, "revisit", 5, "A", 2)):
        with pytest.raises(ValueError, match="revisit"):
            warc._check_revisits(spark.createDataFrame([*good, bad], schema), "page_id")


@settings(max_examples=100, deadline=None)
@given(runs=st.lists(st.lists(st.integers(0, 30), max_size=12), max_size=9))
def test_loser_tree(runs):
    assert list(warc.LoserTree([sorted(r) for r in runs], lambda x: x)) == sorted(x for r in runs for x in r)


def test_url_verdicts(spark):
    rows = [
        (1, "https://x.Example.com/de/a", '<link rel="canonical" href="http://foo.example.com/c">'),
        (2, "http://foo.example.com/c#z", None),
        (3, "http://bar.example.com/r", "<META content='0; url=/de/q' http-equiv=refresh>"),
        (4, "http://bar.example.com/x/y", '<link href="../a" rel=canonical>'),
        (5, None, ""),
        (6, "nope", ""),
        (7, "HTTP://A.NET", "x"),
        (8, "http://A.NET/", "x"),
        (9, "http://q.example.net/en/", "x"),
        (10, "http://myorg/fr/x", ""),
        (11, "http://a.org/fr/x", '<link rel=canonical href="//foo.example.com/c">'),
        (2, "http://foo.example.com/c#z", None),
    ]
    out = url_filter.judge(pages(spark, *rows)).collect()
    assert len(out) == len(rows)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out}
    assert got[1] == ("x.example.com", "/de/a", "example.com/de/", "block")
    assert got[2] == ("foo.example.com", "/c", None, "allow")  # an alias is allowed by rule, another blocked: allow wins
    assert got[3][2:] == (None, "block") and got[4][2:] == (None, "allow")
    assert got[5][:2] == got[6][:2] == ("", "") and got[5][2:] == (None, "allow")
    assert got[7] == ("a.net", "", None, "allow") and got[8][2:] == ("net/", "block") and got[9][2:] == ("example.net/en/", "allow")
    assert got[10][2] is None and got[11][2:] == ("org/fr/", "allow")
    without = {r.page_id: r.verdict for r in url_filter.judge(pages(spark, *rows[:10])).collect()}
    assert without[2] == "block"  # the block of its alias reaches it
    more = spark.createDataFrame([("http://bar.example.com/x/y", "http://a.net/")], "url string, target string")
    assert {r.page_id: r.verdict for r in url_filter.judge(pages(spark, *rows), redirects=more).collect()}[4] == "block"
    assert url_filter.judge(pages(spark).limit(0)).count() == 0


class Links(HTMLParser):
    """Targets of a page by the library's parser."""

    def __init__(self, url, html):
        super().__init__()
        self.base, self.url, self.found = None, url, []
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        a = {}
        for k, v in attrs:
            a.setdefault(k, v or "")
        if tag == "base" and "href" in a and self.base is None:
            self.base = a["href"]
        if tag == "link" and "canonical" in a.get("rel", "").lower().split() and "href" in a:
            self.found.append(a["href"])
        if tag == "meta" and a.get("http-equiv", "").lower() == "refresh" and ";" in a.get("content", ""):
            self.found.append(a["content"].partition(";")[2].strip().removeprefix("url=").strip("'"))

    handle_startendtag = handle_starttag

    def targets(self):
        base = urljoin(self.url, self.base or "")
        for x in self.found:
            if x and not x.startswith("#") and urljoin(base, x).startswith("http"):
                yield urljoin(base, x)


def key_of(url):
    parts = urlsplit(urljoin(url, urlsplit(url).path or "/"))
    return parts.netloc.lower().removesuffix(":80") + (parts.path or "/") + ("?" + urlsplit(url).query if urlsplit(url).query else "")


def slow_verdicts(rows):
    root, urls = {}, {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    def rule_of(url):
        host, _, path = url.partition("://")[2].partition("/")
        fits = [(len(r), r, v) for v, r in url_filter.RULES for h, _, p in [r.partition("/")] if ("." + host.lower()).endswith("." + h) and ("/" in url.partition("://")[2]) and path.partition("?")[0].partition("#")[0].startswith(p)]
        return max(fits)[1:] if fits else (None, None)

    for _, url, html in rows:
        for target in Links(url, html or "").targets():
            for x in (url, target):
                urls.setdefault(key_of(x), set()).add(x)
            root[top(key_of(url))] = top(key_of(target))
    said = defaultdict(set)
    for k, some in urls.items():
        said[top(k)] |= {rule_of(u)[1] for u in some}
    out = {}
    for i, url, _ in rows:
        group = said[top(key_of(url))] if key_of(url) in urls else set()
        out[i] = rule_of(url)[1] or ("allow" if "allow" in group else "block" if "block" in group else "allow")
    return out


def linked_pages():
    """Chains, cycles, hubs and conflicts, with links written in many ways."""
    draw = random.Random(4)
    hosts = ["a.example.com", "b.example.com", "x.net", "q.example.net", "shop.org", "news.test", "w.test:80"]
    paths = ["/", "/de/a", "/en/b?x=1", "/fr/c", "/d/e/f", "/d/./g/../h", "/k?x=1&y=2"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths]
    forms = [
        '<link rel="canonical" href="{u}">',
        "<LINK HREF='{u}' REL='alternate Canonical'/>",
        "<link title='a > b rel=x' rel=canonical href={u}>",
        '<meta http-equiv="Refresh" content="0; url={u}">',
        "<!-- <link rel=canonical href='{u}'> -->",
        "<script>var a = '<link rel=canonical href=\"{u}\">'</script>",
        '<link rel="stylesheet" href="{u}">',
        '<link rel="canonical" href="javascript:go()">',
        '<link rel="canonical" href="mailto:a@b.test">',
        '<link rel="canonical" href="#top">',
        '<link data-rel="canonical" href="{u}">',
        '<a rel="canonical" href="{u}">x</a>',
        '<link title="rel=canonical" href="{u}">',
        "<iframe srcdoc='<link rel=canonical href=/quoted>'></iframe>",
        '<p title="<link rel=canonical href=/quoted>">x</p>',
        "<link " + 'data-x="y" ' * 300 + 'rel="canonical" href="{u}">',
    ]
    rows = []
    for i, url in enumerate(urls * 2):
        parts = ["<html><head>"]
        if draw.random() < 0.2:
            parts.append(draw.choice(['<base href="/base/dir/">', '<base target="_top">', "<base href='http://b.example.com/de/'>"]))
        for _ in range(draw.choice([0, 0, 0, 1, 2])):
            u = draw.choice([draw.choice(urls), draw.choice(urls), "../c", "?id=2", "/z/../de/q", "//shop.org/fr/", "g.html", "./de/./x"])
            parts.append(draw.choice(forms[:4] if draw.random() < 0.6 else forms).format(u=u.replace("&", "&amp;")))
        rows.append((i, url, "".join(parts) + "<p>text & more</p>" * 3 + "</html>"))
    rows += [(1000 + i, f"http://hub{i}.test/", '<link rel="canonical" href="http://hub.test/">') for i in range(40)]
    rows += [(1100 + i, f"http://ring.test/{i}", f'<link rel="canonical" href="{(i + 1) % 30}">') for i in range(30)]
    return rows + [(1200, "http://hub7.test/", '<meta http-equiv=refresh content="1;url=http://a.example.com/de/hub">'), (1201, "http://ring.test/11", '<link rel="canonical" href="//z.net/">')]


def test_links_like_brute_force(spark):
    rows = linked_pages()
    found = url_filter.alias_links(pages(spark, *rows)).collect()
    want = Counter((key_of(u), key_of(t)) for _, u, h in rows for t in Links(u, h).targets())
    links = url_filter.with_key(url_filter.with_key(spark.createDataFrame(found), "url", "a"), "target", "b")
    assert Counter((r.a, r.b) for r in links.collect()) == want and len(found) > 60
    got = {r.page_id: r.verdict for r in url_filter.judge(pages(spark, *rows)).collect()}
    assert got == slow_verdicts(rows)
    assert got[1000] == "block" and got[1100] == "block" and Counter(got.values())["allow"] > 20


C = '<link rel=canonical href="'
MARKUP = [  # (markup, targets) as browsers have them
    (C + 'http:&#x2F;&#47;a.net&sol;&eacute;&#233">', ["http://a.net/éé"]),
    (C + '/?a=1&copy=2&copyx=3&amp;b&lt;&bogus;&amp">', ["http://p.test/?a=1&copy=2&copyx=3&b<&bogus;&"]),
    (C + '/&#128;&#0;&#xD800;&#99999999999;&#x1F600;&#;&#x">', ["http://p.test/€\ufffd\ufffd\ufffd😀&#;&#x"]),
    ("<!-->" + C + '/a"><!--->' + C + '/b"><!-- x --!>' + C + '/c"><!-- ' + C + '/d">', ["http://p.test/a", "http://p.test/b", "http://p.test/c"]),
    ("<template>" + C + '/a"><template></template>' + C + '/b"></template></template>' + C + '/c">', ["http://p.test/c"]),
    ("<xmp>" + C + '/a"></xmp><title>' + C + '/b"></title ><script>"</scriptx>' + C + '/c"></script>' + C + '/d">', ["http://p.test/d"]),
    ("<p title='" + C + '/a">\'><a x=">">' + C + '/b">', ["http://p.test/b"]),
    ('<p "x><q a"b=c\'d>' + C + "/a'b\" rel=none>", ["http://p.test/a'b"]),
    (C + '/a" title="never closed>' + C.replace('"', "") + "/b>", []),
    ("<link rel=canonical href=/a/>" + "<link rel=canonical href = '/b' / ><link/rel=canonical/href=/c>", ["http://p.test/a/", "http://p.test/b"]),
    ("<?x " + C + '/a"><!doctype "' + C + '/b"></>' + C + '/c">', ["http://p.test/c"]),
    ("<scripty>" + C + '/a"><linker rel=canonical href=/b><link>', ["http://p.test/a"]),
]


def test_markup_is_cut_as_browsers_cut_it(spark):
    import duckdb

    rows = [(i, f"http://p{i}.test/", m) for i, (m, _) in enumerate(MARKUP)]
    found = defaultdict(list)
    for r in url_filter.alias_links(pages(spark, *rows)).collect():
        found[r.url].append(r.target.replace(r.url, "http://p.test/"))
    assert [found[url] for _, url, _ in rows] == [targets for _, targets in MARKUP]
    rows = [(i, f"http://p{i}.test/", m.replace("p.test", f"p{i}.test") + f"{C}/" + '">') for i, (m, _) in enumerate(MARKUP)]
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, ?, ?)", rows + [(99, "http://p1.test/?a=1&copy=2&copyx=3&b<&bogus;&", None)])
    same_as_sql(url_filter.judge(pages(spark, *rows, (99, "http://p1.test/?a=1&copy=2&copyx=3&b<&bogus;&", None))), con, url_filter.sql())


def test_links_like_sql(spark):
    import duckdb

    rows = linked_pages() + [(2000, None, None), (2001, "nope", "<link rel=canonical href=/x>"), (2002, "http://no.html/", None)]
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, ?, ?)", rows)
    same_as_sql(url_filter.judge(pages(spark, *rows)), con, url_filter.sql())


def test_very_long_markup(spark):
    rows = [(1, "http://p.test/", "<p>" * 400_000 + "<!--" + "x" * 300_000 + "-->" + '<link rel="canonical" href="http://x.net/">'), (2, "http://q.test/", "<link " + 'a="b" ' * 100_000 + ">"), (3, "http://r.test/", "<link " + "y" * 1_000_000)]
    got = {r.page_id: r.verdict for r in url_filter.judge(pages(spark, *rows)).collect()}
    assert got == {1: "block", 2: "allow", 3: "allow"}


def slow_schedule(blocks, weights):
    """(source, block, release, deadline, slot), slot by slot from the weights: of the released blocks the one due first."""
    left, done, out = {s: n for s, n in blocks.items() if n}, Counter(), []
    while left:
        total, had, start, t = sum(weights[s] for s in left), Counter(), len(out), 0
        while all(had[s] < n for s, n in left.items()):
            share = {s: weights[s] / total for s in left}
            ready = [(math.ceil((had[s] + 1) / share[s]), -weights[s], s) for s in left if math.floor(had[s] / share[s]) <= t]
            due, _, s = min(ready)
            out.append((s, done[s] + had[s], start + math.floor(had[s] / share[s]), start + due, start + t))
            had[s] += 1
            t += 1
        for s in list(left):
            done[s] += had[s]
            left[s] -= had[s]
            if not left[s]:
                del left[s]
    return out


def test_mixture_like_brute_force(spark):
    sizes = {"a": 61, "b": 30, "c": 5, None: 9}
    rows = [(i, s, "x") for s, n in sizes.items() for i in range(n)] + [(None, "a", "x")]
    df = spark.createDataFrame(rows, "doc_id long, source string, slot string")
    weights = {"a": 3.0, "b": 1.5}
    out = mixing.schedule(df, weights=weights, block_rows=4, task_slots=7).collect()
    assert Counter((r.doc_id, r.source) for r in out) == Counter((d, s) for d, s, _ in rows)
    counts = Counter(r[1] for r in rows)
    key = lambda s: "" if s is None else "s" + s
    want = slow_schedule({key(s): -(-n // 4) for s, n in counts.items()}, {key(s): Fraction(weights.get(s, 1.0)) for s in counts})
    assert sorted({(r.slot, key(r.source), r.block) for r in out}) == sorted((t, s, b) for s, b, _, _, t in want)
    assert all(r.release <= r.slot < r.deadline for r in out)
    assert len({(r.slot, r.position) for r in out}) == len(out)
    assert mixing.schedule(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        mixing.schedule(df, weights={"a": 0.0})


WEIGHT = st.builds(Fraction, st.integers(1, 40), st.integers(1, 30))


@settings(max_examples=150, deadline=None)
@given(sources=st.lists(st.tuples(WEIGHT, st.integers(0, 40)), max_size=7), alike=st.booleans(), each=st.integers(1, 25))
def test_any_range_of_slots_by_itself(sources, alike, each):
    weights = {f"s{i}": sources[i // 2 * 2 if alike else i][0] for i in range(len(sources))}
    blocks = {f"s{i}": n for i, (_, n) in enumerate(sources)}
    plan = mixing.Plan.of(blocks, weights)
    got = [row for low in range(0, plan.slots, each) for row in plan.rows(low, min(plan.slots, low + each))]
    assert got == slow_schedule(blocks, weights)


@pytest.mark.parametrize("weights", [{"a": "2", **{f"b{k:02}": "1" for k in range(19)}}, {"a": "1", "b": "0.000001"}, {"a": "1/7", "b": "6/7"}, {"a": "1", "b": "0.0004", "c": "0.123456789"}])
def test_lag_stays_under_one_block(weights):
    weights = {s: Fraction(w) for s, w in weights.items()}
    total, slots = sum(weights.values()), 100_000
    plan, had = mixing.Plan.of({s: 2 * slots for s in weights}, weights), Counter()
    assert plan.phases[0].slots >= slots
    for low in range(0, slots, 30_000):
        for s, block, _, _, t in plan.rows(low, min(slots, low + 30_000)):
            assert block == had[s]
            had[s] += 1
            if t % 11 == 0 or t > slots - 100:
                assert all(abs(had[x] - w * (t + 1) / total) < 1 for x, w in weights.items())


def test_many_sources(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("site"), F.col("id") % 1100).alias("source"))
    out = mixing.schedule(df, weights={"site7": 0.3, "site8": Fraction(1, 3)}, block_rows=1).collect()
    assert len(out) == 3000 and sorted(r.slot for r in out) == list(range(3000))


def test_packing_follows_the_mixture(spark, monkeypatch, sf_dir):
    import corpus_pipeline
    from tidemart.llm import packing

    docs = spark.createDataFrame([(i, f"src{i % 3}", "one two three " * (1 + i % 7) * 40) for i in range(1200)], "doc_id long, source string, text string")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("documents", lambda *_: docs), *corpus_pipeline.STAGES[3:]])
    found = []
    for weights in ({"src0": 2.0}, {"src0": 9.0}):
        monkeypatch.setattr(queries, "WEIGHTS", weights)
        out = corpus_pipeline.run(spark, sf_dir).collect()
        assert sorted(r.doc_id for r in out) == list(range(1200))
        found.append({r.doc_id: (r.sequence_id, r.offset) for r in out})
        first = sorted({r.sequence_id for r in out})[: len({r.sequence_id for r in out}) // 4]
        share = sum(r.length for r in out if r.sequence_id <= first[-1] and r.doc_id % 3 == 0) / sum(r.length for r in out if r.sequence_id <= first[-1])
        assert abs(share - weights["src0"] / (weights["src0"] + 2)) < 0.12
    assert found[0] != found[1]
    order = {r.doc_id: k for k, r in enumerate(mixing.mixed_rows(docs, weights=weights).collect())}
    rows = packing.pack(mixing.mixed_rows(docs, weights=weights), queries.byte_bpe(), shard_items=300, in_order=True).collect()
    assert all(order[r.doc_id] // 300 == r.sequence_id >> 40 for r in rows) and len(rows) == 1200


def test_mixed_rows_keep_all(spark):
    df = spark.createDataFrame([(i, f"s{i % 3}", f"t{i}") for i in range(200)] + [(5, "s2", "t5")], "doc_id long, source string, text string")
    out = mixing.mixed_rows(df, block_rows=8)
    assert out.columns == df.columns and out.exceptAll(df).count() == 0 and out.count() == df.count()


def test_numbers_are_dense_in_each_group(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 800, "hot").otherwise(F.col("id").cast("string")).alias("g"), "id")
    seen = defaultdict(list)
    for r in mixing.numbered(df, "_n", ["id"], ["g"]).collect():
        seen[r.g].append((r.id, r._n))
    for rows in seen.values():
        assert [n for _, n in sorted(rows)] == list(range(len(rows)))


def test_rows_that_share_an_id_keep_their_places(spark):
    df = spark.createDataFrame([(i % 3, "s", f"t{i}") for i in range(60)], "doc_id long, source string, text string")
    places = [{(r["_row"].text, r["_place"].slot, r["_place"].position) for r in mixing.scheduled(x, block_rows=4).collect()} for x in (df, df.repartition(7), df.orderBy(F.rand(3)))]
    assert places[0] == places[1] == places[2] and len(places[0]) == 60


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_as_sql(name, spark, duck, sf_dir):
    same_as_sql(queries.QUERIES[name](spark, sf_dir), duck, queries.ORACLES[name])


@pytest.mark.parametrize("k", range(5))
def test_stages_with_odd_rows(k, spark, sf_dir):
    import corpus_pipeline

    name, stage = corpus_pipeline.STAGES[k]
    shape = "doc_id long, text string, lang string, source string, n_chars long, _row string, _key int, id int, row string, md5 string, score int, node string, _place int"
    some = [(1, None), (None, "null id"), (2, ""), (3, "x " * 40_000), (4, "a b c d e f"), (4, "a b c d e f"), (5, "a b c d e f"), (None, None)]
    rows = [(d, t, None, None if d == 2 else "s", 0, "r", 1, 2, "w", "m", 3, "n", 4) for d, t in some]
    docs = spark.createDataFrame(rows, shape)
    for df in (docs, docs.limit(0)):
        out = stage(spark, df, sf_dir)
        got = out.collect()
        if name == "packing":
            assert len({r.sequence_id for r in got}) <= len(got) and (len(got) >= len(rows) if df is docs else got == [])
            continue
        assert out.columns == docs.columns and (got if df is docs else got == [])
        if name == "mixture":
            assert Counter(map(tuple, got)) == Counter(map(tuple, df.collect()))
        if name == "near_copies" and df is docs:
            assert sorted((r.text or "")[:20] for r in got) == ["", "a b c d e f", "null id", "x x x x x x x x x x "]


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir).persist()
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns and 0 < out.count() <= n
            n, docs = out.count(), out
        else:
            assert out.select("doc_id").distinct().count() == n
    assert corpus_pipeline.run(spark, sf_dir).select("doc_id").distinct().count() == n

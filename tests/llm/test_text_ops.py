import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from strata.llm import fingerprints, html_main, line_dedup, minhash, mixing
from tests.llm.conftest import SF


def small_docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


# line dedup

def plain_line_dedup(rows):
    last = (1 << 63) - 1
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(last if i is None else i)
    out = Counter()
    for i, text in rows:
        own = last if i is None else i
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == own]
        out[i, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


@pytest.mark.parametrize("batches,fanout", [(1, 2), (3, 2), (5, 3)])
def test_line_dedup_is_the_plain_one(spark, edge, batches, fanout):
    found = line_dedup.drop_repeated_lines(edge, batches=batches, fanout=fanout)
    assert Counter((r.rest.doc_id, r.n_lines, r.n_dropped, r.text) for r in found.collect()) \
        == plain_line_dedup([(r.doc_id, r.text) for r in edge.collect()])


def test_line_dedup_of_nothing_and_stage(spark, edge, nothing):
    assert line_dedup.drop_repeated_lines(nothing).count() == 0
    stage = line_dedup.dedup_stage(spark, edge, SF)
    assert stage.columns == edge.columns and stage.count() == edge.count()
    assert all(r.n_chars == len(r.text) for r in stage.collect())


# mixing

def test_mix_targets_and_taken(spark, edge, nothing):
    rows = mixing.mix(edge).collect()
    assert len(rows) == edge.count() and all(r.taken == r.times * r.size and r.times <= 3 for r in rows)
    assert {r.doc_id: r.size for r in rows}[4] == 0
    assert mixing.mix(nothing).count() == 0
    again = mixing.mix(edge.repartition(7)).collect()
    assert Counter((r.doc_id, r.taken) for r in rows) == Counter((r.doc_id, r.taken) for r in again)


def filled(sizes, weights, most=3):
    """Targets by sharing what is above the caps again and again."""
    target, capped, left = {s: 0.0 for s in sizes}, set(), float(sum(sizes.values()))
    while left > 1e-9 and len(capped) < len(sizes):
        total = sum(weights[s] for s in sizes if s not in capped)
        share = {s: left * weights[s] / total for s in sizes if s not in capped}
        left = 0.0
        for s, more in share.items():
            target[s] += more
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                capped.add(s)
    return target


@pytest.mark.parametrize("sizes", [[100, 1, 2, 3, 50], [5], [0, 7, 900], [1, 1, 1000, 1, 1, 1, 1], [0, 0]])
def test_targets_share_the_excess(spark, sizes):
    docs = spark.createDataFrame([(i, "w " * n, f"s{i:02}") for i, n in enumerate(sizes)], "doc_id bigint, text string, source string")
    got = {r.doc_id: r.target for r in mixing.mix(docs).collect()}
    want = filled(dict(enumerate(sizes)), {i: (1, 2, 3)[i % 3] for i in range(len(sizes))})
    assert all(math.isclose(got[i], want[i], abs_tol=1e-6) for i in want)


def test_taken_words_come_near_the_target(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").toPandas()
    for _, own in rows.groupby("source"):
        assert abs(own.taken.sum() - own.target.iloc[0]) <= own["size"].max() / 2 + 1e-6
    stage = mixing.mix_stage(spark, docs, SF)
    assert stage.columns == docs.columns
    assert stage.count() == rows.times.sum()


# near duplicates

def plain_components(rows, size):
    def words(text):
        return [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\n", " ").replace("\t", " ").split(" ") if w]

    sets = {}
    for i, text in rows:
        w = words(text)
        sets[i] = {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def grown(n):
    """A chain and a star of near copies, with pairs that are too far apart to link."""
    base = [f"b{i}" for i in range(100)]
    rows = [(k, " ".join(base[:100 - 3 * k] + [f"c{k}_{i}" for i in range(3 * k)])) for k in range(12)]
    rows += [(100 + k, " ".join([f"d{i}" if i != k else f"e{k}" for i in range(80)])) for k in range(n)]
    return rows + [(500 + k, " ".join(f"f{k}_{i % 40}" for i in range(60))) for k in range(10)]


@pytest.mark.parametrize("size", [1, 2, 5])
def test_near_duplicates_are_the_plain_ones(spark, size, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 3)
    rows = grown(30) + [(900 + i, t) for i, t in small_docs(spark)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), size=size)
    want = plain_components(rows, size)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == want
    assert got.where("kept <> (doc_id = component_id)").count() == 0


def test_near_duplicates_edge_rows(spark, edge, nothing):
    got = minhash.near_duplicates(edge, size=2).collect()
    assert len(got) == edge.count()
    by = {r.doc_id: r for r in got}
    assert by[1].component_id == by[2].component_id == by[3].component_id == 1 and by[9].component_id == 7
    assert by[4].n_shingles == 0 and by[4].kept and by[5].component_id == 5
    assert by[None].component_id is None and by[None].kept
    assert minhash.near_duplicates(nothing).count() == 0
    stage = minhash.near_dedup_stage(spark, edge, SF)
    assert stage.columns == edge.columns


def test_near_dedup_stage_keeps_rows_without_an_id(spark, edge):
    rows = edge.unionByName(edge.where("doc_id IS NULL"))
    of = {r.doc_id: r.kept for r in minhash.near_duplicates(rows).collect()}
    want = Counter((r.doc_id, r.text, r.rest) for r in rows.collect() if of[r.doc_id])
    got = Counter((r.doc_id, r.text, r.rest) for r in minhash.near_dedup_stage(spark, rows, SF).collect())
    assert got == want and got[None, "a text without a number", "r"] == 2


def test_components_of_a_long_path(spark):
    rows = [(i, i + 1) for i in range(1, 200)] + [(1000 - i, 1001 - i) for i in range(1, 50)] + [(5000, 4000)]
    got = {r.id: r.label for r in minhash.components(spark, spark.createDataFrame(rows, "a bigint, b bigint")).collect()}
    assert {got[i] for i in range(1, 201)} == {1} and {got[i] for i in range(951, 1001)} == {951} and got[5000] == 4000


# fingerprints

def test_fingerprint_rows_and_neighbours(spark, edge, nothing):
    rows = sorted([(r.doc_id, r.text or "") for r in edge.collect()], key=lambda r: -1 if r[0] is None else r[0], reverse=True)
    got = fingerprints.edited_likeness(edge).collect()
    assert len(got) == len(rows)
    want = Counter()
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        edited = text[:len(text) - len(text) // 3] + after[:len(text) // 3]
        a, b, c = fingerprints.fingerprints([text, edited, after])
        want[i, len(text), hashlib.sha256(edited.encode()).hexdigest(), fingerprints.as_text(a[None])[0],
             fingerprints.likeness(a[None], b[None])[0], fingerprints.likeness(a[None], c[None])[0]] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.near_edited, r.near_next) for r in got) == want
    assert fingerprints.edited_likeness(nothing).count() == 0
    one = fingerprints.edited_likeness(edge.where("doc_id = 11")).first()
    assert one.near_next == 1.0


def test_fingerprints_do_not_depend_on_company_or_offset(spark):
    texts = [t for _, t in small_docs(spark)][:60] + ["", "a", "aaaa" * 50, "ab" * 300]
    together = fingerprints.fingerprints(texts)
    assert all((fingerprints.fingerprints([t])[0] == f).all() for t, f in zip(texts, together))
    long = max(texts, key=len)
    moved = fingerprints.fingerprints(["shifted by this " + long, long])
    assert fingerprints.likeness(moved[:1], moved[1:])[0] > 0.8
    other = fingerprints.fingerprints(["".join(chr(97 + (i * i * 7919 >> 3) % 26) for i in range(len(long)))])
    assert fingerprints.likeness(moved[1:], other)[0] < 0.1


# main text

PAGE_SCHEMA = "page_id bigint, url string, html string, host int, template string"


def extracted(spark, htmls, host="one.example"):
    rows = [(i, f"http://{host}/{i}", source, i, None) for i, source in enumerate(htmls)]
    return [r.text for r in html_main.extract(spark.createDataFrame(rows, PAGE_SCHEMA)).orderBy("page_id").collect()]


def test_extraction_of_parts(spark):
    page = '''<html><head><title>x</title></head><body class="has-sidebar"><header>H <b>b</b></header>
<nav><ul><li>a<li>b</ul></nav><div class="ad">ad</div><article class="comments-open"><h1>T&eacute;st &amp; q</h1><p><b>one
two<br>three<p>fo<i>u</i>r<div class="share-box">s</div><aside>no</aside><script>var t="</p>";</script><p>five &lt;x&gt; a < b</article>
<section id="comments"><article>c</article></section><form>f</form><!-- c --><style>p{}</style><footer>f</footer></body>'''
    assert extracted(spark, [page]) == ["Tést & q one two three four five <x> a < b"]
    own = '<article><div class="entry-header"><h1>Title</h1></div><p>x <math>y</math> z</p><p><a href="x">a link</a></p></article>'
    assert extracted(spark, [own, "<div><a href=x>m</a> <a>n</a></div><div>Hello <b>wor</b>ld</div>x"]) == ["Title x y z a link", "Hello world x"]
    for odd in ("", "<", "<p", "<a b='", "<!-- x", "</p>", "<script>", "<div>" * 3000 + "x", "&am &amp", "<" * 100_000):
        html_main.parse(odd)


def test_long_pages_of_stray_tags():
    import time
    for odd in ("<div>" * 90_000 + "</p>" * 90_000, '<a b="' * 150_001 + ">", "<a '" * 150_001 + ">", "<script>" + "</script " * 90_000):
        start = time.perf_counter()
        html_main.parse(odd)
        assert time.perf_counter() - start < 20


BOILERPLATE = re.compile("<(/?)(?:nav|article|footer|main|section|aside|header)[^>]*>")


def test_template_decides_without_names(spark):
    """Structural tags renamed to div, class names gone: sizes over the pages of a layout decide."""
    story = lambda i: " ".join(f"word{i * k % 97}" for k in range(1, 40))
    page = lambda i: (f"<html><body><nav><ul><li><a href=x>menu {i}</a></li></ul></nav><div class=ad>buy {i} now</div>"  # noqa: E731
                      f"<article><h1>Title {i}</h1>{'<p>tiny</p>' if i == 3 else f'<p>{story(i)}</p>' * (i % 3 + 1)}<p>Written by us</p></article>"
                      f"<footer>{i} of ours, all rights reserved</footer></body></html>")
    other = lambda i: f"<html><body><article>Teaser {i}</article><div><p>{story(i + 50)}</p><p>{story(i + 70)}</p></div></body></html>"
    bare = [BOILERPLATE.sub(r"<\1div>", page(i)).replace(" class=ad", "") for i in range(8)]
    want = [f"Title {i} " + ("tiny" if i == 3 else " ".join([story(i)] * (i % 3 + 1))) for i in range(8)]
    # a page without text, a repeated row and a second layout on the host change nothing
    layouts = bare + [None, bare[2], ""] + [other(i) for i in range(4)]
    got = extracted(spark, layouts)
    assert got[:8] == want and got[8] == got[10] == "" and got[9] == want[2]
    assert got[11:] == [f"{story(i + 50)} {story(i + 70)}" for i in range(4)]
    assert extracted(spark, [page(i) for i in range(8)]) == want
    copies = [f"<html><body><article><h1>Same</h1><p>{story(1)}</p></article></body></html>"] * 4
    assert extracted(spark, copies) == [f"Same {story(1)}"] * 4


def plain_template(parsed):
    """Texts of the template of one layout, from whole occurrence vectors."""
    tokens = {t: w for p in parsed for t, w in p.tokens}
    vector = {t: tuple(sum(x == t for x, _ in p.tokens) for p in parsed) for t in tokens}
    groups = {}
    for t, v in vector.items():
        if min(v) > 0:
            groups.setdefault(v, set()).add(t)
    frame, out = groups.get((1,) * len(parsed), set()), set()
    for v, group in groups.items():
        firsts = [[t for t in dict.fromkeys(x for x, _ in p.tokens) if t in group] for p in parsed]
        gaps = {sum(x in frame for x, _ in p.tokens[:at]) for p in parsed for at, (t, _) in enumerate(p.tokens) if t in group}
        if len(group) >= 2 and all(f == firsts[0] for f in firsts) and (group == frame or len(gaps) == 1):
            out |= {t for t in group if tokens[t] == html_main.TEXT}
    return out


def test_template_against_whole_vectors(spark):
    rng = random.Random(4)
    say = lambda: rng.choice(["one", "two", "three", "four"])
    page = lambda: ("<body><div>" + "".join(f"<p>{say()}</p>" for _ in range(rng.randint(0, 3))) + "<h1>Head</h1><h2>Sub</h2></div><ul>"
                    + "<li>a</li><h3>b</h3>" * rng.randint(1, 3) + "</ul>" + "".join(rng.sample(["<h4>x</h4>", "<h4>y</h4>"], 2)) + "</body>")
    for _ in range(3):
        htmls = [page() for _ in range(5)]
        rows = spark.createDataFrame([("h", i, h) for i, h in enumerate(htmls)], "host string, page bigint, html string")
        got = {r.layout: set(r.texts) for r in html_main.templates(spark, rows).collect()}
        parsed = [html_main.parse(h) for h in htmls]
        assert got == {parsed[0].layout("h"): plain_template(parsed)}


def test_template_text_goes_and_slots_stay(spark):
    schema = PAGE_SCHEMA
    page = lambda i: (f"<div><b>Welcome to our site</b></div><div>{'A story of ' + str(i) if i != 4 else 'x'}</div>"
                      + "".join(f"<p>Part {k} of {i}</p>" for k in range(i % 3 + 1)) + "<div>All rights reserved</div>")
    rows = [(i, f"http://one.example/{i}", page(i), 1, None) for i in range(6)] + [(7, None, None, None, "t"), (8, "http://two.example/", page(8), 2, "")]
    got = {r.page_id: r.text for r in html_main.extract(spark.createDataFrame(rows, schema)).collect()}
    assert got[1] == "A story of 1 Part 0 of 1 Part 1 of 1"
    assert got[7] == "" and got[8].startswith("Welcome to our site A story of 8")
    assert html_main.extract(spark.createDataFrame([], schema)).count() == 0


def test_pages_table(spark):
    import html
    import re
    got = html_main.op7_html(spark, SF).collect()
    source = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in got:
        inner = re.search(r"<article>(.*?)</article>", source[r.page_id], re.S)[1]
        want = " ".join(html.unescape(re.sub(r"</?(?:h1|p)>|<br>", " ", inner).replace("<b>", "")).split())
        assert (r.text, r.n_chars) == (want, len(want))
    assert len(got) == len(source)

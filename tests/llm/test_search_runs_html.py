import hashlib
import itertools
import json
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.llm import html_extraction, lexical_search, periodic_runs
from meterlake.llm.queries import LLM_QUERIES

# -- 12: ranked lexical search ----------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def _search(docs, items, k):
    counts = [(d, Counter(_terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in counts:
            m = 75 + 25 * sum(c.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m)) for t in _terms(text) if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, r + 1, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def _zipf(rng, n):
    return " ".join(f"T{int(rng.paretovariate(0.6))}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    docs = [(i * 3, _zipf(rng, rng.choice((1, 5, 40, 200, 900)))) for i in range(700)]
    docs += [(5000 + i, "tie me up") for i in range(40)]
    docs += [(9000, None), (9001, ""), (9002, " .,; \n"), (3, docs[5][1]), (None, "t1 t2 rare-word é_É"),
             (9003, "t1 " * 30_000 + "needle"), (9004, "ÉÉ ßx É")]
    rng.shuffle(docs)
    items = [(i, _zipf(rng, rng.choice((1, 4, 30)))) for i in range(25)]
    items += [(100, "Tie"), (101, None), (102, "..."), (103, "needle T1 T1 t1"), (104, "é É rare word nowhere"), (0, "tie t2")]
    return docs, items


@pytest.mark.parametrize("shard_bytes,query_terms", [(20_000, 500_000), (1 << 24, 500_000), (60_000, 40)])
def test_search_equals_brute_force(spark, corpus, monkeypatch, shard_bytes, query_terms):
    docs, items = corpus
    monkeypatch.setattr(lexical_search, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(lexical_search, "QUERY_TERMS", query_terms)
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("x")).repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit("x"))
    # functions run in tasks see the settings of their module on the workers
    index = lexical_search.build_index(d)
    got = lexical_search.search(index, q, k=7)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == _search(docs, items, 7)
    heads = index.filter("term is null")
    assert heads.agg(F.sum(F.size("ids"))).first()[0] == len(docs)       # every row is indexed
    assert heads.count() >= (10 if shard_bytes == 20_000 else 1)


def test_search_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id string, text string")
    some = spark.createDataFrame([("a", "one two"), ("b", "one")], "doc_id string, text string")
    item = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert lexical_search.search(lexical_search.build_index(none), item).count() == 0
    index = lexical_search.build_index(some)
    assert lexical_search.search(index, item.limit(0)).count() == 0
    rows = lexical_search.search(index, item).collect()
    assert [(r["rank"], r["doc_id"]) for r in rows] == [(1, "b"), (2, "a")]      # ids of any type


def test_block_maxima_spare_decompression():
    """A weak list's blocks are decompressed for few candidates only."""
    n = 60_000
    norm = lexical_search._Norm(n, n * 10)
    m = norm.of(np.full(n, 10))

    def postings(docs, tfs, weight):
        data, starts, last, most, count = [], [0], [], [], []
        for i in range(0, len(docs), lexical_search.BLOCK):
            d, t = docs[i:i + lexical_search.BLOCK], tfs[i:i + lexical_search.BLOCK]
            gaps = np.concatenate([[d[0]], np.diff(d)])
            data.append(lexical_search._varints(np.stack([gaps, t], 1).ravel())[0].tobytes())
            last.append(d[-1])
            most.append(t.max())
            count.append(len(d))
        rows = {"weight": np.array([weight]), "last": np.array(last), "max_tf": np.array(most),
                "min_length": np.full(len(last), 10), "count": np.array(count), "data": lexical_search.pa.array(data)}
        return lexical_search._List(rows, slice(0, len(last)), norm)

    rng = np.random.default_rng(1)
    rare = np.sort(rng.choice(n, 300, replace=False))
    strong = postings(rare, rng.integers(1, 4, 300), 5000)
    weak_tf = np.ones(n, np.int64)
    weak_tf[::5000] = 9
    weak = postings(np.arange(n), weak_tf, 40)
    docs, scores = lexical_search._best([(1, strong), (1, weak)], m, 20, 1)
    total = {d: int(s) for d, s in zip(docs.tolist(), scores.tolist())}
    strong.need(np.arange(len(strong.last)), m)
    full = np.zeros(n, np.int64)
    full[strong.docs] += strong.scores
    before = int(weak.ready.sum())
    weak.need(np.arange(len(weak.last)), m)
    full[weak.docs] += weak.scores
    best = np.lexsort((np.arange(n), -full))[:20]
    assert [total[d] for d in best.tolist()] == full[best].tolist()
    assert before < len(weak.last) / 2


# -- 13: periodic runs -------------------------------------------------------

def _runs(w):
    out = set()
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if n >= max(6, 4 * q) and not any(all(w[i + t] == w[i + t + r] for t in range(n - r)) for r in range(1, q)):
                out.add((i, n, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def _words(rng):
    kinds = rng.randint(1, 4)
    w = [rng.randrange(kinds) for _ in range(rng.randint(0, 60))]
    if rng.random() < 0.6 and w:
        w = w + [rng.randrange(kinds) for _ in range(rng.randint(1, 6))] * rng.randint(2, 7) + w[:5]
    return w


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for _ in range(400):
        texts = [_words(rng) for _ in range(rng.randint(1, 6))]
        assert periodic_runs.runs_of([np.array(t, np.int64) for t in texts]) == [_runs(t) for t in texts]


def test_long_periodic_texts_take_time_in_proportion():
    for w, run in (([0] * 200_000, (0, 200_000, 1)), ([0, 1] * 60_000 + [0], (0, 120_001, 2)),
                   (list(range(500)) * 100, (0, 50_000, 500))):
        assert periodic_runs.runs_of([np.array(w)]) == [[run]]


def _row13(doc_id, text):
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if w and h % 10 == 0 and doc_id is not None:
        a = (h // 10) % len(w)
        p = 1 + (len(w) - a) // (3 + (h // 10) % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = _runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None,) * 3
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()),
            sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_op13_equals_brute_force(spark, tmp_dir):
    rng = random.Random(3)
    rows = [(i, rng.choice((" ", "\n", " \t ")).join(f"w{x}" for x in _words(rng))) for i in range(300)]
    rows += [(1000 + i, " ".join(f"v{rng.randrange(50)}" for _ in range(rng.randint(1, 300)))) for i in range(100)]
    rows += [(2000, None), (2001, ""), (2002, "x"), (2003, "a\x1ca\xa0a " * 9), (2004, "a\x85b \x0b" * 8),
             (None, "z " * 9), (7, "z " * 9), (7, "z " * 9)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    got = LLM_QUERIES["op13_periodic_runs"](spark, tmp_dir).collect()
    assert sorted(map(tuple, got), key=str) == sorted((_row13(*r) for r in rows), key=str)


def test_runs_keep_other_columns(spark):
    docs = spark.createDataFrame([("a a a a a a b", 1, "x")], "text string, runs int, other string")
    row = periodic_runs.find_runs(docs).first()
    assert (row["collapsed"], row["other"], row["n_words"]) == ("a b", "x", 7)
    assert [tuple(r) for r in row["runs"]] == [(0, 6, 1)]
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0


# -- 11: HTML extraction -----------------------------------------------------

def _sentence(rng):
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) for _ in range(rng.randint(5, 25)))


def _semantic(rng):
    """A page with everything that is not the article, inside and beside it."""
    blocks = [f"{_sentence(rng)} T"] + [f"{_sentence(rng)}." for _ in range(rng.randint(1, 6))]
    body = f"<h1>{blocks[0]}</h1>"
    for i, b in enumerate(blocks[1:]):
        body += rng.choice((f"<p>{b}</p>", f"<p>{b}", f"<p class='x{i}'><b>{b[:5]}</b>{b[5:]}</p>", f"<ul><li>{b}</ul>"))
        if rng.random() < 0.3:
            body += f"<div class=\"ad\">buy {_sentence(rng)}</div>"
        if rng.random() < 0.2:
            body += f"<aside>see {_sentence(rng)}</aside><script>var a = '</p>';</script>"
    comments = "".join(f"<li><p>{_sentence(rng)}</p></li>" for _ in range(rng.randint(0, 4)))
    return " ".join(blocks), (
        f"<!DOCTYPE html><html><head><title>{blocks[0]}</title><style>p{{}}</style></head><body>"
        f"<header><p>{_sentence(rng)}</p></header><nav><ul><li><a href='/'>{_sentence(rng)}</a></ul></nav>"
        f"<div class='cookie-notice'>{_sentence(rng)}</div><!-- <article>no</article> -->"
        f"<article>{body}<div id='comments'><ol>{comments}</ol></div><form><p>Name</p><input></form></article>"
        f"<div class='sidebar'>{_sentence(rng)}</div><footer>&copy; {_sentence(rng)}</footer></body></html>")


def _plain(rng):
    """A page of bare divs: only the wrapper's text tells where the article is."""
    title, blocks = _sentence(rng), [_sentence(rng) for _ in range(rng.randint(4, 12))]
    return " ".join([title, *blocks]), (
        f"<html><body><div><a href=a>{_sentence(rng)}</a><a href=b>{_sentence(rng)}</a></div>"
        f"<div><div><h1>{title}</h1>{''.join(f'<p>{b}</p>' for b in blocks)}</div></div>"
        f"<div><a href=c>imprint</a></div></body></html>")


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(11)
    rows, wanted = [], {}
    for i in range(120):
        text, html = (_semantic if i % 2 else _plain)(rng)
        rows.append((i, f"HTTP://{'Semantic' if i % 2 else 'plain'}.example.org/{i}?x", html))
        wanted[i] = text
    rows += [(200, None, None), (201, "no host", ""), (202, "http://semantic.example.org", "<p>"), (203, None, "&nbsp;<br>")]
    wanted.update(dict.fromkeys((200, 201, 202, 203), ""))
    # a page unlike its host's others is its own host; a cut page keeps its rest
    rows.append((204, "http://semantic.example.org/4", "<body><div><p>only   this&amp;that &lt;x&gt;</p></div>"))
    wanted[204] = "only this&that <x>"
    rows.append((205, "http://semantic.example.org/5", "<body><nav>menu</nav><article><h1>Cut</h1><p>in the mid"))
    wanted[205] = "Cut in the mid"
    rows.append((206, "http://deep.example.org/", "<div>" * 3000 + "deep" + "</div>" * 3000))
    wanted[206] = "deep"
    return rows, wanted


@pytest.mark.parametrize("limit", [html_extraction.BROADCAST_BYTES, 0])
def test_main_text(spark, pages, limit):
    rows, wanted = pages
    table = (spark.createDataFrame(rows, "page_id long, url string, html string")
             .withColumns({"host": F.lit(1), "wrapper": F.lit(2), "main_text": F.lit(3)}).repartition(5))
    wrappers = html_extraction.infer(table)
    assert wrappers.count() == wrappers.select("host").distinct().count() == 4
    got = html_extraction.extract(table, wrappers, broadcast_bytes=limit)
    assert got.columns == ["page_id", "url", "html", "host", "wrapper", "main_text"]
    assert {r["page_id"]: r["main_text"] for r in got.collect()} == wanted


def test_pages_of_an_empty_table(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    wrappers = html_extraction.infer(none)
    for limit in (1, -1):
        assert html_extraction.extract(none, wrappers, broadcast_bytes=limit).count() == 0


def _accepts(part_list, held):
    """Whether a wrapper's sequence can produce a page's element, tried out in full."""
    seq = [x for x in held if not isinstance(x, str) or x.strip()]

    def fits(part, node):
        if isinstance(node, str):
            return part[0] == "#"
        return part[0] == node[0] and _accepts(part[-1], node[1])

    def ends(j, at):
        """Where the parts from j on can stop, having begun at ``at``."""
        if j == len(part_list):
            return {at}
        part, out = part_list[j], set()
        starts = {at} if part[1] else set()
        reach, seen = {at}, set()
        while reach:
            i = reach.pop()
            after = set()
            if part[0] == "()":
                for n in range(1, len(seq) - i + 1):
                    if _accepts([[*x[:1], True, True, *x[3:]] for x in part[-1]] * n, seq[i:i + n]):
                        after.add(i + n)
            elif i < len(seq) and fits(part, seq[i]):
                after.add(i + 1)
            starts |= after
            if part[2]:
                reach |= after - seen
            seen |= after
        for s in starts:
            out |= ends(j + 1, s)
        return out

    return len(seq) in ends(0, 0)


def test_wrappers_accept_every_page():
    rng = random.Random(2)
    htmls = [_semantic(rng)[1] for _ in range(12)]
    for order in itertools.islice(itertools.permutations(range(len(htmls))), 3):
        wrapper = None
        for i in order:
            page = html_extraction.wrapper_of(html_extraction.parse(htmls[i]))
            wrapper = page if wrapper is None else html_extraction.merged(wrapper, page)
        for html in htmls:
            assert _accepts(wrapper[-1], html_extraction.parse(html)[1])


def test_wrapper_form():
    """Optional, repeated and grouped parts, constant texts and text slots."""
    a = "<ul><li>x</li></ul><h2>same</h2><p>one</p>"
    b = "<ul><li>y</li><li>z</li></ul><h2>same</h2><b>new</b><p>two</p>"
    w = html_extraction.merged(*[html_extraction.wrapper_of(html_extraction.parse(x)) for x in (a, b)])
    ul, h2, bold, p = w[-1]
    assert ul[-1][0][:3] == ["li", False, True]
    assert h2[-1][0][-1] == "same" and p[-1][0][-1] is None
    assert bold[:2] == ["b", True] and p[:2] == ["p", False]
    dl = html_extraction.wrapper_of(html_extraction.parse("<dl>" + "<dt>a<dd>b" * 5 + "</dl>"))
    group = dl[-1][0][-1][0]
    assert group[0] == "()" and [x[0] for x in group[-1]] == ["dt", "dd"]
    assert json.loads(html_extraction._dump(w)) == w


def test_wrapper_size_is_bounded(monkeypatch):
    monkeypatch.setattr(html_extraction, "MAX_NODES", 50)
    w = html_extraction.wrapper_of(html_extraction.parse("<article><p>x</p></article>"))
    for i in range(60):
        tag = "".join(chr(97 + int(c)) for c in str(i))
        w = html_extraction.merged(w, html_extraction.wrapper_of(html_extraction.parse(
            f"<article><p>x</p></article><div class=z{tag}><p>{i}</p></div>")))
    assert html_extraction._size(w) <= 50
    assert html_extraction.marked(w)[-1][0][0] == "article"

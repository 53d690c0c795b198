import math
import pickle
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.llm import decontaminate, license_scan, quality, url_filter
from meterlake.llm.queries import URL_RULES

URLS = ["http://WWW.Example.com/en/1?x=1", "https://example.com/en/", "http://a.example.com/fr/2#y",
        "http://b.net/es/x", "http://b.net/de/x", "http://com/", "http://com", "ftp://x.COM?q://y/", None, "",
        "no scheme", "http://", "://h/p", "http://notexample.com/en/1", "http://u@b.net:80/es/",
        "http://b.net/es", "http://x\ny.com/a\nb?c", "http://ÄB.com/é"]


def _parts(url):
    if url is None or "://" not in url:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1])
    return host, m[2]


def test_rules_against_plain_code(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    host, path = url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))
    rule, verdict = url_filter.rule_of(F.col("host"), F.col("path"), URL_RULES)
    rows = df.withColumn("host", host).withColumn("path", path).select("*", rule.alias("r"), verdict.alias("v"))
    for r in rows.collect():
        h, p = _parts(r.url)
        assert (r.host, r.path) == (h, p)
        fits = [(len(a + b), a + b, v) for v, a, b in URL_RULES
                if (h == a or h.endswith("." + a)) and p.startswith(b)]
        best = max(fits, default=(0, None, None))
        assert (r.r, r.v) == best[1:]


@pytest.mark.parametrize("listed, shards", [(0, 10), (1, 10), (400, 10**9), (400, 100), (3000, 700)])
def test_cascade_is_exact(spark, monkeypatch, listed, shards):
    monkeypatch.setattr(url_filter, "KEYS_PER_SHARD", shards)
    monkeypatch.setattr(url_filter, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(url_filter, "FIRST_BITS", 2)    # many false positives, so many levels
    keys = [(f"k{i}", i < listed, i) for i in range(3000)] + [("k5", False, 1), (None, False, 2)]
    df = spark.createDataFrame(keys, "key string, listed boolean, h1 int").repartition(4)
    cascade = url_filter.build(df.select("key", "listed"))
    out = url_filter.judge(df.drop("listed"), cascade, F.col("key")).collect()
    assert len(out) == len(keys)
    for r in out:
        assert r.listed == (r.key is not None and int(r.key[1:]) < listed)
    assert url_filter.judge(df.drop("listed").limit(0), cascade, F.col("key")).count() == 0


def _jobs(spark):
    """Jobs begun so far."""
    spark.range(1).collect()
    return max(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


def test_jobs_of_a_cascade_do_not_grow_with_partitions(spark, monkeypatch):
    df = spark.createDataFrame([(f"k{i}", i % 7 == 0) for i in range(400)], "key string, listed boolean")
    held = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        began = _jobs(spark)
        cascade = url_filter.build(df)
        assert _jobs(spark) - began < 60    # 60 for each level, when every partition was pulled by its own job
        monkeypatch.setattr(url_filter, "PULL_BYTES", 256)      # several parts
        again = url_filter.build(df)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    for made in (cascade, again):
        out = url_filter.judge(df, made, F.col("key"), "found").collect()
        assert len(out) == 400 and all(r.found == r.listed for r in out)
    assert [[b.tolist() for b, _, _ in x] for x in cascade.levels] == [[b.tolist() for b, _, _ in x] for x in again.levels]


def _measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = {i + j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(hit))


def test_quality(spark):
    rng = random.Random(3)
    good = ["the", "cat", "sat", "on", "a", "mat", "while", "rain", "fell", "over", "town", "and", "hills"]
    bad = ["BUY!!", "$$$", "***", "click", "%%%", "NOW!!", "|||", "win"]
    rows, labels = [], []
    for i in range(400):
        words = good if i % 4 else bad
        rows.append((i, " ".join(rng.choice(words) for _ in range(rng.randint(60, 90)))))
        if i < 300:
            labels.append((i, int(words is good)))
    rows += [(1000, None), (1001, ""), (1002, "x\n x\nx\n\n\nx"), (1003, "a b c d e " * 40), (None, rows[1][1]),
             (1, rows[1][1]), (1004, "\u00a0é " * 3), (1005, "w " * 30_000)]
    docs = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, kept string").repartition(3)
    marks = spark.createDataFrame(labels + [(None, 1)], "doc_id long, quality int")
    out = quality.judge(docs, marks).collect()
    assert len(out) == len(rows)
    for r in out:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == _measures(r.text)
        assert r.base_failed == (got[0] < 10 or 100 * got[4] > 20 * got[0])
        i = r["__row"].doc_id
        if i is not None and i < 400:
            assert r.kept == (not r.base_failed and i % 4 != 0)
    unlabelled = quality.judge(docs, marks.limit(0)).collect()
    assert all(r.kept == (not r.base_failed) for r in unlabelled)
    assert quality.judge(docs.limit(0), marks).count() == 0


@pytest.mark.parametrize("sample", [20, 1000])
def test_quality_verdict_equals_brute_force(spark, monkeypatch, sample):
    """Scores, threshold and verdicts by dictionaries; all trusted documents that are
    not in the target set the threshold, also those beyond a small sample."""
    monkeypatch.setattr(quality, "TRUSTED_SAMPLE", sample)
    rng = random.Random(9)
    common, good, bad = [[f"{k}{i}" for i in range(60)] for k in "cgb"]
    rows = []
    for i in range(240):
        share = rng.random()
        own = good if i % 3 else bad
        rows.append((i, " ".join(rng.choice(own if rng.random() < share else common) for _ in range(rng.randint(12, 80)))))
    labels = [(i, int(i % 3 > 0)) for i in range(200) if i % 7] + [(4, 1), (5, 0), (5, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r["__row"].doc_id: (r.score, r.kept) for r in quality.judge(docs, marks).collect()}

    trusted = {i for i, q in labels if q == 1} - {i for i, q in labels if q == 0}
    hashes = {r[0]: (r[1], r[2]) for r in spark.range(300).select("id", F.xxhash64("id"), F.pmod(
        F.xxhash64("id", F.lit(1)), F.lit(quality.HELD_OUT))).collect()}
    target = sorted((i for i in trusted if hashes[i][1]), key=lambda i: hashes[i])[:sample]
    grams = {i: quality._ngrams(t.encode().split(), quality._Hashes()).tolist() for i, t in rows}
    raw, fit = Counter(), Counter()
    for i, g in grams.items():
        raw.update(g)
        if i in target:
            fit.update(g)
    n, m = sum(raw.values()), sum(fit.values())
    p_raw = {b: (raw[b] + 1) / (n + quality.BUCKETS) for b in raw}
    ratio = {b: math.log((fit[b] + quality.BUCKETS * p_raw[b]) / (m + quality.BUCKETS) / p_raw[b]) for b in raw}
    score = {i: sum(ratio[b] for b in g) / len(g) for i, g in grams.items()}
    steps = sorted(math.floor(score[i] / quality.SCORE_STEP) for i in trusted.difference(target))
    assert len(steps) > (80 if sample == 20 else 10)
    below = [s for k, s in enumerate(steps) if sum(x <= s for x in steps) > quality.TRUSTED_MISS * len(steps)]
    cut = below[0] * quality.SCORE_STEP - quality.MARGIN
    for i, t in rows:
        m5 = _measures(t)
        failed = m5[0] < 10 or 100 * m5[4] > 20 * m5[0]
        assert abs(got[i][0] - score[i]) < 1e-9
        assert got[i][1] == (not failed and score[i] >= cut)
    assert {k for _, k in got.values()} == {True, False}


def _plain_hits(text, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, ids = split(text), set(), set()
    for i, t in items:
        w = split(t)
        for a in range(max(1, len(w) - 9) if w else 0):
            x = w[a:a + 10]
            for p in range(len(words) - len(x) + 1):
                if words[p:p + len(x)] == x:
                    hit.update(range(p, p + len(x)))
                    ids.add("" if i is None else str(i))
    return len(words), hit, sorted(ids)


@pytest.mark.parametrize("block, piece", [(1 << 24, 1 << 16), (100, 3)])
def test_decontamination(spark, monkeypatch, block, piece):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)   # 100: less than the longest item
    monkeypatch.setattr(decontaminate, "PIECE", piece)
    rng = random.Random(8)
    vocabulary = ["aa", "bb", "cc", "dd", "É", "x1"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 4, 9, 10, 14])))) for i in range(12)]
    items += [(3, items[3][1]), (50, None), (51, " .,! "), (None, "bb x1 bb x1 bb bb bb bb bb bb")]
    rows = []
    for i in range(60):
        body = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        if i % 3 == 0:
            body += rng.choice(items[:12])[1].split()
        rows.append((i, "; ".join(body).upper() if i % 5 == 0 else " ".join(body), 7))
    rows += [(100, None, 7), (101, "", 7), (102, "aa " * 20_000, 7), (1, rows[1][1], 7)]
    items = [x for x in items if x[1] is None or len(x[1].split()) != 1] + [(60, "x1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words long").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.find(docs, bench).collect()
    assert len(out) == len(rows)
    for r in out:
        n, hit, ids = (20_000, None, None) if r.doc_id == 102 else _plain_hits(r.text, items)
        assert r.n_words == n
        if hit is not None:
            assert {i for s in r.hit_spans for i in range(s.start, s.end)} == hit and r["items"] == ids
            assert all(a.end < b.start for a, b in zip(r.hit_spans, r.hit_spans[1:]))
    assert decontaminate.find(docs.limit(0), bench).count() == 0
    assert all(not r.hit_spans for r in decontaminate.find(docs, bench.limit(0)).collect())


def test_decontamination_block_is_small():
    rng = random.Random(5)
    rows = [(str(i), " ".join(str(rng.randrange(30_000)) for _ in range(60))) for i in range(3000)]
    rows.append(("again", rows[7][1]))
    block = decontaminate.Block(rows)
    block.choose({k: np.ones(len(lookup.sorted), "i8") for k, lookup in block.lookups.items()})
    size = sum(len(t) for _, t in rows)
    assert len(pickle.dumps(block)) < 12 * size + (2 << 20)   # and a bitmap of 1 MB
    words = rows[7][1].encode().split()
    found, begin, windows, places = block.prefix[5]
    assert len(windows) == 3000 * 51
    owners = {tuple(w): ids for w, ids in map(block.window, range(len(windows)))}
    assert owners[tuple(words[:10])] == ["7", "again"] and owners[tuple(words[50:])] == ["7", "again"]


def test_license_scan(spark):
    rng = random.Random(4)
    long_text = " ".join(f"term{i % 37}x{i}" for i in range(120))
    templates = license_scan.TEMPLATES | {"Long-1": long_text, "Short-1": "as is"}
    rows, expected = [], {}
    for i in range(80):
        words = [f"w{rng.randint(0, 50)}" for _ in range(rng.randint(5, 400))]
        expected[i] = set()
        if i % 4 == 0:
            name = rng.choice(list(templates))
            if name != "Short-1":
                at = rng.randint(0, len(words))
                words[at:at] = templates[name].upper().split()
                expected[i].add(name)
        if i % 7 == 0:
            cut = long_text.split()
            cut[60] = "changed"             # five of 116 shingles lost
            words += cut
            expected[i].add("Long-1")
        rows.append((i, " ".join(words)))
    rows += [(100, None), (101, ""), (102, "As  IS"), (103, "as is not"), (0, rows[0][1])]
    expected |= {100: set(), 101: set(), 102: {"Short-1"}, 103: set()}
    docs = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, licenses string").repartition(3)
    out = license_scan.scan(docs, templates=templates).collect()
    assert len(out) == len(rows)
    for r in out:
        assert {x.license for x in r.licenses} == expected[r.doc_id]
        words = (r.text or "").lower().split()
        for x in r.licenses:
            own = set(license_scan._grams(templates[x.license].lower().split()))
            found = set(license_scan._grams(words[x.start:x.end]))
            assert len(own & found) / len(own) == x.containment >= 0.75
    assert license_scan.scan(docs.limit(0)).count() == 0


def _words(text):
    return license_scan._split(text)


def test_license_scan_against_all_stretches():
    """Each stretch as long as a template that holds 0.75 of its shingles meets a
    place of it; places hold what they say and do not overlap."""
    rng = random.Random(11)
    templates = {"A": " ".join(f"a{i}" for i in range(8)), "B": " ".join(f"b{i % 23}" for i in range(40)),
                 "C": " ".join(f"c{i}" for i in range(90))}
    index, memo = license_scan.Index(templates), license_scan._Hashes()
    seen = 0
    for _ in range(150):
        words = []
        for _ in range(rng.randint(1, 6)):
            words += [f"w{rng.randint(0, 9)}" for _ in range(rng.choice([0, 3, 60]))]
            part = templates[rng.choice("ABC")].split()
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                i = rng.randrange(len(part))
                part[i:i + 1] = rng.choice([[], ["x"], [part[i], "y"]])
            words += part[rng.choice([0, 0, 5]):]
        words = _words(" ".join(words))
        found = license_scan._scan(index, [words], memo)[0]
        for name, text in templates.items():
            own = set(license_scan._grams(_words(text)))
            places = [(m["start"], m["end"]) for m in found if m["license"] == name]
            assert all(a[1] <= b[0] for a, b in zip(places, places[1:]))
            for m in found:
                if m["license"] == name:
                    inside = set(license_scan._grams(words[m["start"]:m["end"]]))
                    assert len(own & inside) / len(own) == m["containment"] >= 0.75
            grams, n = license_scan._grams(words), len(license_scan._grams(_words(text)))
            for i in range(max(1, len(grams) - n + 1)):
                if len(own.intersection(grams[i:i + n])) >= 0.75 * len(own):
                    seen += 1
                    assert any(a < i + n + 4 and i < b for a, b in places), (name, i)
    assert seen > 500


def test_all_places_of_a_license():
    notices = license_scan.NOTICES
    index, memo = license_scan.Index(notices, True), license_scan._Hashes(True)
    mit, rights, lesser = (notices[n] for n in ("MIT", "All-rights-reserved", "CC-BY-NC-SA-4.0/international"))
    words = _words(f"{mit} {mit} w1 w2 {rights} {mit} {rights} {rights} {lesser} {lesser} " + "w3 " * 500 + mit)
    got = [(m["license"], m["start"], m["end"]) for m in license_scan._scan(index, [words], memo)[0]]
    n = len(words)
    assert [x for x in got if x[0] == "MIT"] == [
        ("MIT", 0, 5), ("MIT", 5, 10), ("MIT", 15, 20), ("MIT", n - 5, n)]
    assert [x[1:] for x in got if x[0] == "All-rights-reserved"] == [(12, 15), (20, 23), (23, 26)]
    k = len(lesser.split())
    assert [x[1:] for x in got if x[0].startswith("CC-BY-NC-SA-4.0/i")] == [(26, 26 + k), (26 + k, 26 + 2 * k)]
    long = {"L": " ".join(f"t{i}" for i in range(300))}
    index, memo = license_scan.Index(long), license_scan._Hashes()
    words = _words("x " + f"{long['L']} " * 7)
    assert [(m["start"], m["end"]) for m in license_scan._scan(index, [words], memo)[0]] == [
        (1 + 300 * i, 301 + 300 * i) for i in range(7)]
    moved = long["L"].split()
    words = _words(" ".join(moved[150:] + moved[:150]))    # parts in another order: one place
    assert [(m["start"], m["end"]) for m in license_scan._scan(index, [words], memo)[0]] == [(0, 300)]


def test_public_licenses(spark):
    """Whole texts, headers, and notices in other punctuation or inside prose."""
    templates = license_scan.public_licenses()
    body = "w1 w2 w3 w4 w5 w6 w7. "
    apache = templates["Apache-2.0/header"]
    commented = "".join(f" * {line}\n" for line in apache.split("\n"))
    rows = [(1, body + "All rights reserved.\n" + body, {"All-rights-reserved"}),
            (2, body + "(all Rights, reserved)", {"All-rights-reserved"}),
            (3, "all rights are reserved", set()),
            (4, body + "Released under the MIT License", {"MIT"}),
            (5, body + 'Licensed under the Apache License, Version 2.0 (the "License")', {"Apache-2.0"}),
            (6, commented + body, {"Apache-2.0", "Apache-2.0/header"}),
            (7, body + "// SPDX-License-Identifier: GPL-3.0-only\n", {"GPL-3.0-only/spdx"}),
            (8, body * 50 + templates["MIT/text"] + body, {"MIT/text"}),
            (13, body + "under the GNU General Public License, version 2.", {"GPL-2.0/notice"}),
            (9, templates["GPL-3.0/text"], None), (10, "All rights", set()), (11, " .,! -- ", set()), (12, None, set())]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(2)
    got = {r.doc_id: {x.license: x for x in r.licenses}
           for r in license_scan.scan(docs, templates=templates, bare=True).collect()}
    for i, _, want in rows:
        assert want is None or set(got[i]) == want, i
    assert {"GPL-3.0/text", "GPL/header"} <= set(got[9])
    assert (got[1]["All-rights-reserved"].start, got[1]["All-rights-reserved"].end) == (7, 10)
    words = commented.split()
    place = got[6]["Apache-2.0/header"]
    assert place.containment == 1 and words[place.start] == "Licensed" and words[place.end - 1] == "License."


def test_public_licenses_find_themselves():
    templates = license_scan.public_licenses()
    index, memo = license_scan.Index(templates, True), license_scan._Hashes(True)
    assert len(pickle.dumps(index)) < 16 << 20      # broadcast: half a GB with bitmaps of 1 MB
    padded = [f"aa bb cc dd ee ff\n{t}\ngg hh ii jj kk" for t in templates.values()]
    for name, own in zip(templates, license_scan._scan(index, [license_scan._split(t) for t in padded], memo)):
        assert {m["license"]: m["containment"] for m in own}.get(name) == 1, name

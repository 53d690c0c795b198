import hashlib
import random
import re

from pyspark.sql import functions as F

from meterlake.llm import pii, warc_audit

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _base(text):
    out = {}
    for kind, pattern in PLAIN.items():
        out[kind] = []
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and _luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out[kind].append(m.span())
    return out


def _rows():
    rng = random.Random(9)
    pieces = ["a@b.c", "x.y+z@mail-1.example.com", "a@b", "@", "a@b.c_d@e.f", "1.2.3.4", "1.2.3.4.5.6.7.8",
              "256.1.1.1", "001.02.3.255", "4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111112",
              "41111111111111111111", "+1 (017) 555-7713", "+12", "+1 5", "+1234567890123456", "++44 20.7946.0958)",
              "é", "🙂", " ", "\n", "word", "1", "-", ".", "+", "2.0.", "aaa.bbb@", "%", "@x.y"]
    rows = [(i, "".join(rng.choice(pieces) + rng.choice(["", " "]) for _ in range(rng.randint(0, 25))))
            for i in range(150)]
    return rows + [(200, None), (201, ""), (202, "a" * 30_000), (203, "1" * 30_000), (204, "1 " * 15_000),
                   (205, "a.b@c" * 4000), (206, "+1" + "-" * 20_000), (0, rows[0][1]), (None, "me@x.org")]


def test_base_spans_against_re(spark):
    rows = _rows()
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, email int").repartition(4)
    out = pii.find(docs).select("*", pii.base_text().alias("b")).collect()
    assert len(out) == len(rows)
    texts = {}
    for d, t in rows:
        texts.setdefault(d, t)
    for r in out:
        want = _base(texts[r.doc_id])
        assert {k: [(s.start, s.end) for s in r[k]] for k in pii.KINDS} == want
        assert r.b == ",".join(f"{k}:{a}:{b}" for k, v in want.items() for a, b in v)
    assert pii.find(docs.limit(0)).count() == 0


def _plain_patterns(edges):
    """trusted_patterns by dictionaries."""
    by_pattern, seeds = {}, set()
    for p, i, s in edges:
        by_pattern.setdefault(p, set()).add(i)
    for p, i, s in edges:
        if s:
            seeds.add((p, i))
    known = {i for _, i in seeds}
    trust, best = {i: 1.0 for i in known}, {}
    for _ in range(pii.ROUNDS):
        best = {}
        for p, own in by_pattern.items():
            t = sum(trust.get(i, 0.0) for i in own)
            if t >= pii.MIN_TRUST and t / (len(own) + 1) >= pii.MIN_SCORE:
                best[p] = t / (len(own) + 1)
        trust = {i: 1.0 for i in known}
        for p, score in best.items():
            for i in by_pattern[p]:
                if (p, i) not in seeds:
                    trust[i] = max(trust.get(i, 0.0), score)
    return best


def test_pattern_graph(spark):
    rng = random.Random(12)
    edges = {(f"p{rng.randint(0, 8)}", f"i{rng.randint(0, 60)}") for _ in range(250)}
    edges |= {("good", f"s{i}") for i in range(30)} | {("good", "n1"), ("good", "n2"), ("next", "n1")}
    edges |= {("next", f"s{i}") for i in range(9)}
    rows = [(p, i, i.startswith("s") or int(i[1:]) % 3 == 0 and i[0] == "i") for p, i in sorted(edges)]
    got = pii.trusted_patterns(spark.createDataFrame(rows * 2, "pattern string, instance string, seed boolean"))
    got = {r.pattern: round(r.score, 9) for r in got.collect()}
    assert got == {p: round(s, 9) for p, s in _plain_patterns(rows).items()} and "good" in got


def test_unseen_identifiers_are_discovered_and_redacted(spark):
    rows = [(i, f"some words here. Reach me at user{i}@mail.example.org today") for i in range(30)]
    rows += [(100, "other words. Reach me at AB-998877 now"), (101, "nothing at AB-998877 now"),
             (102, "Reach me at soon"), (103, "Reach me at 12"), (104, None)]
    docs = spark.createDataFrame([(d, t, "v") for d, t in rows], "doc_id long, text string, found string")
    found = {r.doc_id: r for r in pii.find(docs).select("*", pii.all_text().alias("all")).collect()}
    at = rows[30][1].index("AB-998877")
    assert found[100]["all"] == f"id:{at}:{at + 9}"
    assert all(found[d]["all"] == "" for d in (101, 102, 103, 104))
    clean = pii.redact(docs)
    assert clean.columns == docs.columns
    clean = {r.doc_id: (r.text, r.found) for r in clean.collect()}
    assert clean[100] == ("other words. Reach me at [ID] now", "v") and clean[104] == (None, "v")
    assert clean[3][0] == "some words here. Reach me at [EMAIL] today" and clean[101][0] == rows[31][1]


def test_patterns_are_scored_against_known_negatives(spark):
    """Unseen identifiers do not count against the pattern that finds them."""
    wide, long_word = " " * 100, "x" * 90
    rows = [(i, f"Some text. Call us at +1 (017) 555-{7000 + i} now") for i in range(60)]
    rows += [(100 + i, f"Some text. Call us at 017-555-{7000 + i} now") for i in range(40)]
    rows += [(200, f"Call us{wide}at 017-555-9999"), (201, f"the {long_word} at 017-555-9998 x"),
             (202, "at 017-555-9997 now")]
    rows += [(300 + i, f"the sum of +1 (018) 555-{7000 + i} is") for i in range(20)]
    rows += [(400 + i, f"the sum of {1000 + i} is") for i in range(20)] + [(450, "the sum of 018-555-1234 is")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: [r.text[s.start:s.end] for s in r.found]
             for r in pii.find(docs).join(docs, "doc_id").select("*").collect()}
    for d, text in rows:
        want = []
        if 100 <= d <= 140 or d in (200, 202):
            want = [w for w in text.split() if w.startswith("017")]
        assert found[d] == want, (d, found[d])


def _stretches(spans):
    """[start, end, kind of the first] of overlapping spans."""
    out = []
    for a, b, kind in sorted(spans):
        if out and a < out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b, kind])
    return out


def test_redacted_text_against_plain_python(spark):
    rows = [(d, t) for d, t in _rows() if d is not None][:-1]
    pad = "é" * (pii.PAGE - 3)
    rows += [(300, pad + " me@x.org " + pad + "🙂 1.2.3.4 " + pad), (301, "me@x.org"), (302, "a@b.c" + pad + pad)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    found = {r.doc_id: r.found for r in pii.find(docs).collect()}
    for d, text in rows:
        spans = [(a, b, k.upper()) for k, v in _base(text).items() for a, b in v]
        spans += [(s.start, s.end, "ID") for s in found[d]]
        want = text
        for a, b, kind in reversed(_stretches(spans)):
            want = want[:a] + f"[{kind}]" + want[b:]
        assert got[d] == want, d


def test_pii_of_a_text_of_many_tokens(spark):
    """Every token of a long text meets only the spans near it."""
    import time
    def text(n):
        return " ".join(f"mail us at u{i}@x.org or 10.0.0.{i % 200}, order {i}" if i % 3 else
                        f"mail us at REF-{100000 + i} now" for i in range(n))
    took = {}
    for n in (2_000, 8_000, 32_000):
        docs = spark.createDataFrame([(1, text(n))], "doc_id long, text string")
        begin = time.monotonic()
        (row,) = pii.redact(docs).collect()
        took[n] = time.monotonic() - begin
        assert row.text.count("[EMAIL]") == n - -(-n // 3) and row.text.count("[ID]") == -(-n // 3)
        assert "@" not in row.text and "REF-" not in row.text
    assert took[32_000] < 8 * took[8_000]


def test_pii_plans_have_no_python(spark):
    docs = spark.createDataFrame([(1, "a@b.c")], "doc_id long, text string")
    plan = pii.redact(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_merkle_audit(spark, monkeypatch):
    monkeypatch.setattr(warc_audit, "FANOUT", 3)
    monkeypatch.setattr(warc_audit, "LEVELS", 3)
    monkeypatch.setattr(warc_audit, "ARCHIVE_RECORDS", 16)
    rows = [(i, f"http://h/{i}", "<p>" + "é" * (i % 50)) for i in range(300)]
    rows += [(7, "http://h/7", "<p>" + "é" * 7), (None, None, None), (400, "u", "x" * 100_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    good = warc_audit.archived(pages)
    assert good.count() == len(rows)
    bad, lost = {17, 18, 250}, {40, 299}
    copy = good.filter(F.coalesce(~F.col("record_id").isin(*lost), F.lit(True))).withColumn(
        "record", F.when(F.col("record_id").isin(*bad), F.concat("record", F.lit(b"!"))).otherwise(F.col("record")))
    out = warc_audit.audit(good, copy).collect()
    assert len(out) == len(rows)
    for r in out:
        want = "corrupt" if r.record_id in bad else "missing" if r.record_id in lost else "ok"
        assert r.status == want
    own = {(r.archive, r.seq): r for r in good.collect()}
    for r in out:
        assert hashlib.sha256(own[r.archive, r.seq].record).hexdigest() == r.hash
        assert r.end - r.start == len(own[r.archive, r.seq].record)
    leaves = warc_audit.manifest(good)
    assert warc_audit.compare(leaves, warc_audit.manifest(good)).count() == 0
    extra = warc_audit.compare(warc_audit.manifest(copy), leaves).filter("status = 'extra'")
    assert extra.count() == len(lost)
    assert warc_audit.audit(good.limit(0), copy.limit(0)).count() == 0
    turned = warc_audit.audit(copy, good).collect()
    assert sorted(r.record_id for r in turned if r.status == "extra") == sorted(lost)
    assert len(turned) == len(rows)
    assert {r.status for r in warc_audit.audit(good, copy.limit(0)).collect()} == {"missing"}


def test_undamaged_branches_are_not_read(spark):
    """A lost record changes the nodes above it and none behind it."""
    rows = [(i, f"http://h/{i}", "x" * (i % 70)) for i in range(warc_audit.ARCHIVE_RECORDS)]
    good = warc_audit.archived(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1))
    assert good.select("archive").distinct().count() == 1
    leaves = warc_audit.manifest(good)
    for hit in (5, 4000):
        nodes = warc_audit.descend(leaves, warc_audit.manifest(good.filter(F.col("seq") != hit)))
        assert [n.count() for n in nodes] == [1] * (warc_audit.LEVELS + 1)
        assert nodes[-1].first().seq == hit


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline
    from test_dedup import _groups
    from test_filters import _measures, _plain_hits
    rng = random.Random(21)
    words = [f"word{i}" for i in range(60)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(14)) for i in range(5)]
    rows = [(i, text(rng.randint(20, 120))) for i in range(60)]
    rows += [(100 + i, rows[i][1] + " extra end") for i in range(8)] + [(200 + i, text(30) + " " + items[i][1] + " " + text(30)) for i in range(5)]
    rows += [(300, "mail me@x.org " + text(40)), (301, None), (302, ""), (303, "few words"), rows[2]]
    docs = [(d, t, "en", "s", len(t or ""), 1) for d, t in rows]
    d = str(tmp_path)
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, kept int"
                          ).repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")

    good = [r for r in rows if (m := _measures(r[1]))[0] >= 10 and 100 * m[4] <= 20 * m[0]]
    groups = _groups(good)
    one = {}
    for r, (_, c, _) in zip(good, groups):
        if r[0] == c:
            one[c] = r[1]
    clean = {i: t for i, t in one.items() if not _plain_hits(t, items)[1]}
    want = {i: t.replace("me@x.org", "[EMAIL]") for i, t in clean.items()}
    assert len(good) > len(one) > len(clean) > 0 and 300 in want

    out = corpus_pipeline.run(spark, d)
    assert {"doc_id", "text", "lang", "source", "n_chars", "kept"} <= set(out.columns)
    out = out.collect()
    assert sorted((r.doc_id, r.text) for r in out) == sorted(want.items())
    assert all(r.decoded_ok and len(r.token_ids) == 4 * r.n_tokens > 0 for r in out)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "personal_data", "byte_bpe"]
    empty = spark.read.parquet(f"{d}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, d).columns == empty.columns and stage(spark, empty, d).count() == 0

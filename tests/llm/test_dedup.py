import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from meterlake.llm import minhash_dedup, suffix_dedup
from meterlake.llm.components import components


def _set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _groups(rows):
    """Smallest reachable id of each row, by brute force."""
    sets = [_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(len(s), least.get(root(i)), root(i)) for i, s in enumerate(sets)]


def _near_copies(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 3000)}"
    common = [word() for _ in range(25)]
    texts = []
    for _ in range(12):
        base = [word() for _ in range(rng.randint(30, 200))]
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 35))):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.3:
                copy += common
            texts.append(" ".join(copy))
    chain = [word() for _ in range(120)]        # each text is close to the next alone
    for i in range(8):
        texts.append(" ".join(chain))
        at = 15 * i
        chain[at:at + 3] = [word(), word(), word()]
    rows = [(10 * i + 7, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    n = len(rows)
    rows += [(n * 20, None), (n * 20 + 1, ""), (n * 20 + 2, " \n "), (n * 20 + 3, "one two"),
             (n * 20 + 4, "ONE  two"), (n * 20 + 5, "one"), (None, rows[0][1]), (None, "only here with no id"),
             rows[1], (rows[1][0], "other text under the same id"), (n * 20 + 6, "x y " * 9000)]
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, seed):
    monkeypatch.setattr(minhash_dedup, "MEMBERS", 3)
    rows = _near_copies(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = minhash_dedup.near_duplicates(docs).collect()
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in out)
    want = Counter((d, n, c if n else d) for (d, _), (n, c, _) in zip(rows, _groups(rows)))
    assert got == want


def test_sketches_and_bounds(spark):
    """Sketches agree as often as they should, and no linked pair fails a bound."""
    rng = random.Random(4)
    memo = minhash_dedup._Hashes()
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(40):
        words = list(base)
        for _ in range(rng.randint(0, 12)):
            words[rng.randrange(200)] = f"x{rng.random()}"
        rows.append((i, " ".join(words)))
    texts = spark.createDataFrame(rows, "node long, text string")
    kept = {r.node: r for r in minhash_dedup._profiles(texts).collect()}
    sets = {i: set(minhash_dedup.shingle_set(t, memo).tolist()) for i, t in rows}
    linked = 0
    for i in sets:
        own = sets[i].difference(*[s for j, s in sets.items() if j != i])
        assert (i in kept) == (4 * len(own) <= len(sets[i]))
        if i in kept:
            assert (kept[i].n, kept[i].own) == (len(sets[i]), len(own))
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and 100 * both >= 75 * len(sets[i] | sets[j]):
                linked += 1
                a, b = kept[i], kept[j]
                assert 7 * min(a.n - a.own, b.n - b.own) >= 3 * (a.n + b.n)
                same = sum((x ^ y) >> 4 * k & 15 == 0 for x, y in zip(a.sketch, b.sketch) for k in range(16))
                share = both / len(sets[i] | sets[j])
                assert abs(same / 1024 - (share + (1 - share) / 16)) < 0.09 and same >= minhash_dedup.SKETCH_MATCHES
                got = spark.createDataFrame([(a.sketch, b.sketch)], "x array<long>, y array<long>").select(
                    minhash_dedup._collisions(F.col("x"), F.col("y"))).first()[0] if linked < 3 else same
                assert got == same
    assert linked > 20


def test_one_row_of_each_group_stays(spark):
    rows = _near_copies(5)
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, node string")
    kept = minhash_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in kept.collect()]
    groups = _groups(rows)
    wordless = [r for r in rows if not _set(r[1])]
    heads = {(root, c) for n, c, root in groups if n and c is not None}
    assert sorted(d for d, t in kept if _set(t) and d is not None) == sorted(c for _, c in heads)
    assert sorted(map(str, (r for r in kept if not _set(r[1])))) == sorted(map(str, wordless))
    assert len(kept) == len(heads) + len(wordless) + 1      # the text that has no id at all
    assert minhash_dedup.drop_duplicates(docs.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 103), (103, 101), (7, 7)]
    out = {r.node: r.component for r in
           components(spark.createDataFrame(links, "a long, b long").repartition(3)).collect()}
    assert out == {**{i: 0 for i in range(1, 61)}, 101: 100, 103: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _removed(texts, length):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        mask = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                mask[i:i + length] = b"\1" * length
        out.append(mask)
    return out


def _spans(mask):
    out, start = [], None
    for i, m in enumerate([*mask, 0]):
        if m and start is None:
            start = i
        elif not m and start is not None:
            out.append((start, i))
            start = None
    return out


@pytest.mark.parametrize("length, gram, letters, group", [
    (200, 100, "abcdefgh ", 50_000), (20, 10, "ab", 50_000), (20, 10, "abc", 1), (24, 9, "abé", 3)])
def test_repeats_against_counting_all_windows(spark, monkeypatch, length, gram, letters, group):
    monkeypatch.setattr(suffix_dedup, "LENGTH", length)
    monkeypatch.setattr(suffix_dedup, "GRAM", gram)
    monkeypatch.setattr(suffix_dedup, "MAX_GROUP", group)
    monkeypatch.setattr(suffix_dedup, "PIECE", 2048 if length == 200 else 256)
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", 3000)
    rng = random.Random(length + gram)
    make = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [make(rng.randint(length // 2, 6 * length)) for _ in range(8)]
    rows = []
    for i in range(50):
        text = "".join(rng.choice(shared)[rng.randint(0, length):] if rng.random() < 0.7
                       else make(rng.randint(0, length)) for _ in range(rng.randint(0, 5)))
        text = list(text)
        for _ in range(rng.randint(0, 3) if text else 0):
            text[rng.randrange(len(text))] = "z"
        rows.append((i, "".join(text)))
    rows += [(60, None), (61, ""), rows[3], (None, rows[4][1]), (62, "q" * (3 * length)), (63, "x" * (length - 1))]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, kept int").repartition(4)
    out = suffix_dedup.remove_repeats(docs).collect()
    masks = _removed([(t or "").encode() for _, t in rows], length)
    want = Counter()
    for (d, t), m in zip(rows, masks):
        data = (t or "").encode()
        want[d, len(data), tuple(_spans(m)), bytes(b for b, x in zip(data, m) if not x)] += 1
    got = Counter((r["__row"].doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.removed), bytes(r.kept)) for r in out)
    assert got == want
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_suffix_order_is_sorted():
    import numpy as np
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 40))).encode() for _ in range(300)]
    group = np.sort(np.array([rng.randint(0, 9) for _ in texts]))
    length = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), "u1")
    hashes = suffix_dedup.PrefixHash(data, suffix_dedup.Powers())
    order, common = suffix_dedup.suffix_order(data, hashes, np.cumsum(length) - length, length, group)
    for g in range(10):
        own = [texts[i] for i in order[group == g]]
        assert own == sorted(texts[i] for i in np.flatnonzero(group == g))
    for k in range(1, 300):
        if group[k] == group[k - 1]:
            a, b = texts[order[k - 1]], texts[order[k]]
            n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert common[k] == n


def test_colliding_hashes_are_told_apart(monkeypatch):
    import numpy as np
    monkeypatch.setattr(suffix_dedup, "LENGTH", 6)
    monkeypatch.setattr(suffix_dedup, "GRAM", 3)
    monkeypatch.setattr(suffix_dedup.PrefixHash, "of", lambda self, start, length: np.zeros(len(start), "u8"))
    texts = [b"xxxabcyy", b"zxxabcyy", b"xxxabcqq", b"zxxabcyq"]
    out = suffix_dedup.shared_windows(texts, np.full(4, 3), np.full(4, 3), np.zeros(4, "i8"), suffix_dedup.Powers())
    every = Counter(t[i:i + 6] for t in texts for i in range(3))
    assert [[bool(x) for x in row[:3]] for row in out] == [[every[t[i:i + 6]] > 1 for i in range(3)] for t in texts]

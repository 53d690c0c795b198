import base64
import hashlib
import random
import struct
import time

import public_tokenizers as P
import pytest
import tiktoken

from meterlake.llm import bpe, chat


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in
             map(bytes.split, open(P.path(bpe.VOCABULARY), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _texts():
    rng = random.Random(5)
    out = ["", "a", " ", "\n\n  x", "don't 12345 !!?", "été ñandú 日本語 🙂\u200d", "<|endoftext|>",
           "a" * 5000, "ab" * 3000, " " * 4000, "".join(rng.choice("abcdefgh") for _ in range(20000)),
           "\x1c\x1f\x85\u2028 x"]
    for _ in range(60):
        out.append("".join(rng.choice("aabbeiont \n\t.,'0189éß中 ") for _ in range(rng.randint(0, 80))))
    return out


@pytest.mark.parametrize("small", [0, 12, 10**9])
def test_batches_equal_tiktoken(reference, monkeypatch, small):
    monkeypatch.setattr(bpe, "SMALL", small)
    monkeypatch.setattr(bpe, "MEMO_SIZE", 40)
    ranks = bpe.load_ranks(P.path(bpe.VOCABULARY))
    encoder, decoder = bpe.Encoder(ranks), bpe.Decoder(ranks)
    texts = _texts()
    for batch in (texts, texts[::-1], [None], [], texts[:3], ["a  b", "a   b", "x \n y", "x\n y", " x", "x ", "\tx y"]):
        for t, packed in zip(batch, encoder.encode(batch), strict=True):
            ids = list(struct.unpack(f"<{len(packed) // 4}I", packed))
            assert ids == reference.encode_ordinary(t or "")
            assert decoder.decode(packed) == (t or "").encode()


def test_rank_queue_order():
    import numpy as np
    q = bpe.RankQueue(70_000)
    for r, p in [(69_999, 1), (64, 5), (64, 2), (0, 9)]:
        q.push(r, p)
    q.push_all(np.array([4096, 64, 4096]), np.array([3, 8, 4]))
    seen = []
    while (x := q.pop()) is not None:
        seen.append((x[0], sorted(x[1])))
    assert seen == [(0, [9]), (64, [2, 5, 8]), (4096, [3, 4]), (69_999, [1])]


def test_a_lower_rank_that_appears_goes_first():
    # "bc" at rank 256 makes "abc" (rank 255) possible before the second "bc"
    ranks = {bytes([b]): b for b in range(255)} | {b"abc": 255, b"bc": 256, b"cabc": 254}
    ranks[b"\xfe"] = 300
    merger = bpe.Merger(ranks)
    reference = tiktoken.Encoding("x", pat_str=r"(?s:.+)", special_tokens={}, mergeable_ranks={**ranks, b"\xff": 301})
    for t in ("abcabc", "bcbcabcbc", "cabcabcabcbc", "abc"):
        ids = list(struct.unpack(f"<{len(merger.merge([t.encode()])[0]) // 4}I", merger.merge([t.encode()])[0]))
        assert ids == reference.encode_ordinary(t)


@pytest.mark.parametrize("small", [0, 12])
def test_any_order_of_ranks(monkeypatch, small):
    """Vocabularies whose ranks are dealt at random, so that lower ranks appear again and
    again: equal to merging the leftmost lowest pair, one at a time."""
    monkeypatch.setattr(bpe, "SMALL", small)
    rng = random.Random(8)
    for _ in range(60):
        tokens = {bytes([b]) for b in range(256)}
        tokens |= {bytes(rng.choice(b"ab") for _ in range(rng.randint(2, 6))) for _ in range(rng.randint(3, 25))}
        order = list(tokens)
        rng.shuffle(order)
        ranks = {t: r for r, t in enumerate(order)}
        pieces = [bytes(rng.choice(b"aab") for _ in range(rng.randint(1, 60))) for _ in range(12)] + [b"a" * 40, b"ab" * 25]
        for piece, packed in zip(pieces, bpe.Merger(ranks).merge(pieces)):
            parts = [bytes([b]) for b in piece] if piece not in ranks else [piece]
            while len(parts) > 1:
                best = min((ranks.get(a + b, 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                if best[0] == 1 << 30:
                    break
                parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
            assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == [ranks[x] for x in parts]


def test_chunks_of_a_batch_are_split_in_one_go(reference):
    """However many new chunks a batch has; their pre-tokens are the pattern's."""
    rng = random.Random(4)
    chunk = lambda: "".join(rng.choice("abé'st1²,.中\n\t\x1c\x85\u3000") for _ in range(rng.randint(1, 9)))
    for texts in ([" ".join(f"w{i} x{i}'s" for i in range(500))], ["ab cd ef"],
                  [" ".join(c for _ in range(300) if not (c := chunk())[0].isspace() and not c[-1].isspace())
                   for _ in range(4)]):
        encoder = bpe.Encoder(bpe.load_ranks(P.path(bpe.VOCABULARY)))
        split, calls = encoder.split, []
        encoder.split = lambda t, split=split, calls=calls: calls.append(t) or split(t)
        out = encoder.encode(texts)
        assert len(calls) <= 1 + len(texts)     # the new chunks, and each text's first one
        for t, packed in zip(texts, out, strict=True):
            assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == reference.encode_ordinary(t)


def test_few_equal_pairs_of_a_pre_token_are_merged_in_one_pass(reference, monkeypatch):
    """Not one pair at a time, unless a lower rank appears."""
    merger, pops = bpe.Merger(bpe.load_ranks(P.path(bpe.VOCABULARY))), []
    pop = bpe.RankQueue.pop
    monkeypatch.setattr(bpe, "SMALL", 10**9)
    monkeypatch.setattr(bpe.RankQueue, "pop", lambda q: pops.append(1) or pop(q))
    packed = merger.merge([b"ab" * 80])[0]
    assert len(pops) < 40
    assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == reference.encode_ordinary("ab" * 80)


@pytest.mark.parametrize("ids", [300, 2**32 - 1])
def test_an_id_outside_the_vocabulary_raises(ids):
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 301}      # 300 is a gap
    decoder = bpe.Decoder(ranks)
    assert decoder.decode(struct.pack("<2I", 97, 301)) == b"aab" and decoder.decode(None) == b""
    with pytest.raises((IndexError, TypeError)):
        decoder.decode(struct.pack("<2I", 97, ids))


def test_very_long_pre_tokens_take_time_in_proportion(reference):
    rng = random.Random(2)
    merger = bpe.Merger(bpe.load_ranks(P.path(bpe.VOCABULARY)))
    letters = "".join(rng.choice("abcdefgh") for _ in range(1 << 20)).encode()
    for piece in (b"a" * (1 << 20), b"ab" * (1 << 19), letters):
        began = time.process_time()
        packed = merger.merge([piece])[0]
        assert time.process_time() - began < 60
        ids = struct.unpack(f"<{len(packed) // 4}I", packed)
        assert reference.decode_bytes(ids) == piece
        # equal to the library at a length that it can still do
        short = piece[:20_000]
        got = merger.merge([short])[0]
        assert list(struct.unpack(f"<{len(got) // 4}I", got)) == reference.encode_ordinary(short.decode())


def test_encode_frames(spark, reference):
    rows = [(i, t, "x") for i, t in enumerate(_texts())] + [(900, None, "x"), (900, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(3)
    out = bpe.decode(bpe.encode(df)).withColumn("ids", bpe.unpacked()).collect()
    both = bpe.encode(df, decoded=True).select("doc_id", "text", "n_tokens", "token_ids", "decoded")
    assert sorted(map(str, both.collect())) == sorted(map(str, bpe.decode(bpe.encode(df)).select(both.columns).collect()))
    assert len(out) == len(rows)
    for r in out:
        assert bytes(r.decoded) == (r.text or "").encode()
        assert r.ids == reference.encode_ordinary(r.text or "") and r.n_tokens == len(r.ids)
    assert bpe.encode(df.limit(0)).count() == 0


CONVS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi \\</turn>"), (1, 2, "assistant", "a\\\\<say>b\\"),
    (1, 3, "assistant", ""), (1, 4, "assistant", "</turn></turn>\\\\\\"), (2, 0, "user", None),
    (2, 1, None, "no role"), (None, 0, "user", "lost"), (3, 5, "assistant", "<turn>"), (3, 5, "assistant", "<turn>"),
    (3, None, "us</turn>er", "\\### Assistant: </turn> ok"), (4, 0, "assistant", "é" * 9000),
]


def test_escape_round_trip():
    rng = random.Random(1)
    for _ in range(3000):
        t = "".join(rng.choice(["\\", "<turn>", "</turn>", "<say>", "a", "<"]) for _ in range(rng.randint(0, 9)))
        e = chat.escape(t)
        assert chat.unescape(e) == t
        for c in chat.CONTROLS:     # a control string never follows an even run of backslashes
            i = e.find(c)
            while i >= 0:
                assert (i - len(e[:i].rstrip("\\"))) % 2 == 1
                i = e.find(c, i + 1)


def test_conversations(spark):
    df = spark.createDataFrame(CONVS, "conv_id long, turn long, role string, text string").repartition(5)
    formatted = chat.format_conversations(df)
    out = {r.conv_id: r for r in chat.read_conversations(formatted).collect()}
    expected = {}
    for c, t, r, x in sorted(CONVS, key=lambda v: (v[0] or 0, -1 if v[1] is None else v[1], v[2] or "", v[3] or "")):
        expected.setdefault(c, []).append((r or "", x or ""))
    assert {k: [(t.role, t.text) for t in v.turns] for k, v in out.items()} == expected
    for k, v in out.items():
        learned = [x for r, x in expected[k] if r == "assistant"]
        assert "".join(v.loss_texts) == "".join(learned)
        assert v.formatted == "".join(f"<turn>{chat.escape(r)}<say>{chat.escape(x)}</turn>" for r, x in expected[k])
    for r in formatted.collect():
        assert len(r.token_ids) == 4 * len(r.loss_mask) and set(r.loss_mask) <= {0, 1}
    assert chat.read_conversations(chat.format_conversations(df.limit(0))).count() == 0


def test_digest_query_of_planted_conversation(spark):
    from meterlake.llm.queries import LLM_QUERIES, PLANTED
    row = LLM_QUERIES["op2_chat_format"](spark, "/root/testdata/sf0.001").filter("conv_id = -7").first()
    said = f"user\n{PLANTED}\nassistant\n{PLANTED}\n"
    assert row.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert row.loss_sha256 == hashlib.sha256(PLANTED.encode()).hexdigest() and row.n_turns == 2


def test_digest_of_a_conversation_in_segments(spark, monkeypatch):
    """A conversation of many segments reads as one; no task holds it whole."""
    monkeypatch.setattr(chat, "SEGMENT_BYTES", 300)
    rows = [(c, i, "assistant" if i % 2 else "user", f"é turn {i} <say> of {c}\\") for c in (1, 2, None) for i in range(120)]
    rows += [(4, 0, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = {r.conv_id: r for r in chat.digest_conversations(turns).collect()}
    whole = {r.conv_id: r for r in chat.read_conversations(chat.format_conversations(turns)).collect()}
    assert got.keys() == whole.keys() == {1, 2, None, 4}
    for c, r in got.items():
        own = [(x[2] or "", x[3] or "") for x in rows if x[0] == c]
        loss = "".join(t for role, t in own if role == "assistant")
        assert r.n_turns == len(own) and r.formatted_chars == len(whole[c].formatted)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.digest_conversations(turns.limit(0)).count() == 0
    import pyarrow as pa
    ids = b"\x01\x00\x00\x00" * 40
    batch = pa.RecordBatch.from_arrays([pa.array([1] * 50), pa.array([ids] * 50), pa.array([ids] * 50),
                                        pa.array([True] * 50)], ["c", "ids", "role_ids", "learn"])
    parts = list(chat._segments(iter([batch]), 100))
    assert len(parts) == 50 and max(len(x[1]) for x in parts) < 1000

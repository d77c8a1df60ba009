import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer, models, pre_tokenizers

from curatrix.llm import bpe, dac, packing, spm
from curatrix.llm.bpe import WordMemoEncoder
from curatrix.llm.common import scratch

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = [*"abcdef   ..,\n\t'\"()012éß漢😀▁-=", "the ", "  ", "ing", "\x1c", "\x85", "<|endoftext|>", "　"]


@pytest.fixture(scope="module")
def tok():
    t = Tokenizer.from_file(BPE)
    t.encode_special_tokens = True
    return t


def texts(n, seed=0):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


def test_word_memo_is_the_library(tok):
    for memo in (0, 50, 100_000):
        e = WordMemoEncoder(BPE, memo)
        for lo in range(0, 3000, 500):
            batch = texts(500, lo)
            assert [np.frombuffer(x, "<u4").tolist() for x in e.encode(batch)] == [tok.encode(t, add_special_tokens=False).ids for t in batch]


def test_added_tokens_are_the_library_by_default():
    plain, e = Tokenizer.from_file(BPE), bpe.encoder(BPE, 1000)
    assert np.frombuffer(e.encode(["a<|endoftext|> b"])[0], "<u4").tolist() == [64, 50256, 275]
    for lo in range(0, 3000, 500):
        batch = texts(500, lo)
        assert [np.frombuffer(x, "<u4").tolist() for x in e.encode(batch)] == [plain.encode(t, add_special_tokens=False).ids for t in batch]


def test_words_in_rows_are_the_library():
    plain, e = Tokenizer.from_file(BPE), WordMemoEncoder(BPE, 3000, added=True)
    assert e.rows is not None
    rnd = random.Random(5)
    letters = [*"abcxyzABZ019.,;:!?#$%&\"()[]{}|~^_`@/\\-+*<>=", *"àéßñüöçÀÖØÿœŉſŸ", *"ing tion the".split()]
    odd = [*"'×÷ªµº¡ƀǅαж漢😀\x00\x7f\x85\u00ad\u0301٣²", "'s", "'tion", "n't", "<|endoftext|>"]
    for share in (0, 0.002, 0.1):
        for _ in range(6):
            words = ["".join(rnd.choice(odd if rnd.random() < share else letters) for _ in range(rnd.randint(1, 12))) for _ in range(3000)]
            batch = ["".join(w + rnd.choice("       \n") for w in words[i : i + rnd.randint(1, 40)]) + "end" for i in range(0, 3000, 30)]
            assert [np.frombuffer(x, "<u4").tolist() for x in e.encode(batch)] == [plain.encode(t, add_special_tokens=False).ids for t in batch]


def test_plain_words_are_not_cut_again(monkeypatch):
    e, usual = WordMemoEncoder(BPE), []
    monkeypatch.setattr(e, "_learn_any", lambda words, own=e._learn_any: usual.extend(words) or own(words))
    e.encode(["some plain words, élan and\nöl", "a 漢 that's other"])
    assert sorted(usual) == ["that's", "漢"]


def test_a_full_memo_still_takes_words(monkeypatch):
    for memo in (20, 1000):
        e, learnt = WordMemoEncoder(BPE, memo), []
        monkeypatch.setattr(e, "_learn", lambda words, own=e._learn, learnt=learnt: learnt.extend(words) or own(words))
        for i in range(300):
            e.encode([f"x {i} {i + 1000} late"] if i > 200 else [f"x {i} {i + 1000} {i + 2000}"])
            assert len(e.memo) + len(e.older) <= 1.5 * memo
        assert learnt.count("late") == 1


def test_vocabulary_with_pieces_over_an_end(tmp_path):
    # "d" and "," are two pre-tokens, yet this vocabulary has a piece of both: words may not stand in a row
    letters = sorted(bpe.BYTE)
    vocab = {p: i for i, p in enumerate([*letters, "d,", "nd,"])}
    t = Tokenizer(models.BPE(vocab=vocab, merges=[("d", ","), ("n", "d,")]))
    t.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    t.save(str(tmp_path / "t.json"))
    e, text = WordMemoEncoder(str(tmp_path / "t.json")), "and, end, or\nd, and"
    assert e.rows is None
    assert np.frombuffer(e.encode([text])[0], "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_sentencepiece_is_the_library():
    lib, codec = sentencepiece.SentencePieceProcessor(model_file=PIECES), spm.SentencePieceCodec(PIECES, 1000)
    for t in texts(4000, 9) + ["", " ", "\n", "a" * 3000, "ab " * 2000]:
        ids = np.frombuffer(codec.encode(t), "<u4")
        assert ids.tolist() == lib.encode(t), t
        assert codec.decode(ids) == t.replace("▁", " "), t


def test_viterbi_streams_in_a_bounded_window():
    lib, model = sentencepiece.SentencePieceProcessor(model_file=PIECES), spm.Model(PIECES)
    v = spm.StreamingViterbi(model)
    rnd = random.Random(2)
    t = "".join(rnd.choice("abcdefgh") for _ in range(20_000))
    out, at = v.push("▁"), 0
    while at < len(t):
        n = rnd.randint(1, 300)
        out += v.push(t[at : at + n])
        at += n
    assert out + v.finish() == lib.encode(t) and v.window < 300


def test_unigram_takes_the_best_sum():
    model = spm.Model(PIECES)
    model.kind, model.bytes = spm.UNIGRAM, {}
    rnd = random.Random(3)
    model.ids = {p: i for i, p in enumerate(["a", "b", "ab", "ba", "aab", "bb", "abab", "c"])}
    model.pieces, model.scores = list(model.ids), [rnd.uniform(-5, -1) for _ in model.ids]
    model.longest, model.unknown, model.unknown_score = 4, 99, -20.0

    def best(s):  # all segmentations
        if not s:
            return 0.0
        out = best(s[1:]) + model.unknown_score
        for p, i in model.ids.items():
            if s.startswith(p):
                out = max(out, model.scores[i] + best(s[len(p) :]))
        return out

    for _ in range(200):
        s = "".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 14)))
        v = spm.StreamingViterbi(model)
        ids = v.push(s) + v.finish()
        assert abs(sum(model.scores[i] for i in ids if i != 99) + sum(20 * -1 for c in s if c == "d") - best(s)) < 1e-9


def test_sentencepiece_frames(odd):
    rows = {(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()}
    back = {(r.doc_id, r.text) for r in spm.decoded(spm.encoded(odd, PIECES), PIECES).collect()}
    assert back == {(i, t or "") for i, t in rows}
    out = spm.encode_documents(odd, PIECES).collect()
    assert len(out) == odd.count() and all(r.round_trip for r in out)
    assert spm.encode_documents(odd.limit(0), PIECES).count() == 0


def test_segment_gives_any_token():
    rnd = np.random.default_rng(0)
    for top in (1, 200, 300, 70_000, 2**32):
        ids = [rnd.integers(0, top, n, dtype=np.uint32) for n in (0, 1, 513, 2000, 0, 7)]
        seg = dac.Segment(dac.pack_segment([0, 1, 2, None, 4, -5], ids))
        flat = np.concatenate(ids)
        assert seg.n_tokens == len(flat) and seg.n_docs == 6 and seg.null_ids.tolist() == [0, 0, 0, 1, 0, 0]
        assert seg.tokens(0, len(flat)).tolist() == flat.tolist()
        for i in rnd.integers(0, len(flat), 300):
            assert seg.token(int(i)) == flat[i]
        for d in range(6):
            assert seg.document(d).tolist() == ids[d].tolist()
        a, z = sorted(rnd.integers(0, len(flat), 2))
        assert seg.tokens(a, z).tolist() == flat[a:z].tolist()
    assert dac.Segment(dac.pack_segment([], [])).n_tokens == 0


def test_token_files_round(odd, tok, spark):
    path = scratch(spark, "test-tokens")
    out = sorted(dac.token_output(odd, BPE, 0, path).collect(), key=lambda r: r.start)
    rows = odd.select("doc_id", "text").collect()
    want = sorted((-1 if r.doc_id is None else r.doc_id, zlib.crc32(np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4").tobytes())) for r in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.ids_crc32) for r in out) == want
    assert [r.doc_id for r in out] == sorted((r.doc_id for r in out), key=lambda i: -1 if i is None else i)
    n = 0
    for r in out:
        assert r.start == n
        n += r.n_tokens
    assert dac.token_output(odd.limit(0), BPE).count() == 0


def test_plan_is_a_packing_near_the_bound():
    rnd = random.Random(0)
    for _ in range(400):
        cap = rnd.choice([7, 16, 100, 1024])
        h = {}
        for _ in range(rnd.randint(0, 50)):
            s = rnd.randint(1, cap)
            h[s] = h.get(s, 0) + rnd.choice([1, 2, 5, 30])
        ranks, bins = {}, {}
        for s, r, n, q, o in packing.plan(h, cap):
            ranks.setdefault(s, []).append((r, n))
            for k in range(n):
                bins.setdefault(q + k, []).append((o, s))
        assert {s: sum(n for _, n in v) for s, v in ranks.items()} == h
        for v in ranks.values():
            at = 0
            for r, n in sorted(v):
                assert r == at
                at += n
        for v in bins.values():
            at = 0
            for o, s in sorted(v):
                assert o == at
                at += s
            assert at <= cap
        total = sum(s * n for s, n in h.items())
        half = sum(n for s, n in h.items() if 2 * s > cap)
        assert len(bins) <= 1.3 * max(half, -(-total // cap)) + 1
    with pytest.raises(ValueError):
        packing.plan({9: 1}, 8)


def test_large_pieces_pair_optimally():
    # brute force over pairings of pieces above a third
    rnd = random.Random(1)

    def fewest(items):
        if not items:
            return 0
        a, rest = items[0], items[1:]
        return 1 + min([fewest(rest)] + [fewest(rest[:i] + rest[i + 1 :]) for i, b in enumerate(rest) if a + b <= 30])

    for _ in range(60):
        items = [rnd.randint(11, 30) for _ in range(rnd.randint(1, 8))]
        runs = packing.plan({s: items.count(s) for s in set(items)}, 30)
        assert len({q + k for _, _, n, q, _ in runs for k in range(n)}) == fewest(items)


def test_packed_documents(odd, tok):
    out = packing.pack_documents(odd, BPE, 2, 64).collect()
    rows = odd.select("doc_id", "text").collect()
    total = sum(len(tok.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in rows)
    assert sum(r.length for r in out) == total
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for v in bins.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= 64
    assert len(bins) <= -(-total // 64) + 2
    ids = [*tok.encode(next(r.text for r in rows if r.doc_id == 3), add_special_tokens=False).ids, 2]
    for r in out:
        if r.doc_id == 3:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
            assert r.piece == 0 or r.length == 64
    assert packing.pack_documents(odd.limit(0), BPE).count() == 0

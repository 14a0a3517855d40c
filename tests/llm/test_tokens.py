import zlib

import numpy as np
import pytest

from helpers import AWKWARD, frame, prose
from tidemark.llm import token_counts as tc
from tidemark.llm import token_records as tr

public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def rows():
    return AWKWARD + [(i, prose(i, 40 * i)) for i in range(1, 6)] + [(50, "long " * 60000), (51, "'s don't 12 <|endoftext|>  x\r\ny\u00a0z"), (52, "  two  blanks \n\n lines")]


def test_crc32c_known_values():
    data = [b"", b"a", b"123456789", bytes(32), b"\xff" * 32, bytes(range(256)) * 5]
    got = tr.Crc32c()(np.frombuffer(b"".join(data), np.uint8), np.array([len(d) for d in data]))
    assert [hex(x) for x in got[:5].tolist()] == ["0x0", "0xc1d04330", "0xe3069283", "0x8a9136aa", "0x62a8ab43"]

    def plain(text):
        crc = 0xFFFFFFFF
        for byte in text:
            crc ^= byte
            for _ in range(8):
                crc = (crc >> 1) ^ (0x82F63B78 if crc & 1 else 0)
        return crc ^ 0xFFFFFFFF

    assert int(got[5]) == plain(data[5])


@pytest.fixture(scope="module")
def ids():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_records_round_trip(spark, ids):
    ordered = sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    got = sorted(tr.record_digests(frame(spark, rows()).repartition(5), WORDS, 1).collect(), key=lambda r: r.start)
    start = 0
    assert len(got) == len(ordered)
    for want, r in zip(ordered, got):
        expected = ids(want[1])
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (want[0], start, len(expected), zlib.crc32(np.array(expected, "<u4").tobytes()))
        start += len(expected)


def test_shuffled_reads_and_damage(spark, ids):
    folder, index = tr.write_records(frame(spark, rows()), WORDS, 1)
    fields = [tr.T.StructField("ids", tr.T.ArrayType(tr.T.LongType()))]
    read = tr.read_records(folder, index.orderBy(tr.F.rand(3)), ["doc_id"], lambda x: (x.tolist(),), fields)
    texts = {r[0]: r[1] for r in rows()}
    assert all(list(r.ids) == ids(texts[r.doc_id]) for r in read.collect())
    raw = tr.struct.pack("<Q", 4) + bytes(4) + b"abcd" + bytes(4)
    with pytest.raises(ValueError, match="checksum"):
        tr.checked_payloads(raw, tr.Crc32c())
    with pytest.raises(ValueError, match="beyond"):
        tr.checked_payloads(raw[:-2], tr.Crc32c())


def test_wide_ids(spark, ids, monkeypatch):
    monkeypatch.setattr(tr, "id_width", lambda *_: 4)
    wide = {r.doc_id: r.ids_crc32 for r in tr.record_digests(frame(spark, rows()[-3:]), WORDS, 1).collect()}
    assert wide[51] == zlib.crc32(np.array(ids(rows()[-2][1]), "<u4").tobytes())


def test_empty_table(spark):
    assert tr.record_digests(frame(spark, rows()).limit(0), WORDS, 1).count() == 0
    assert tc.token_counts(frame(spark, rows()).limit(0), PIECES).count() == 0


def reference(entries):
    from tokenizers import Tokenizer, models, normalizers

    tokenizer = Tokenizer(models.Unigram(entries, unk_id=0, byte_fallback=True))
    tokenizer.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_counts_are_the_tokenizers(spark):
    count = reference(tc.vocabulary(PIECES))
    got = sorted((r.doc_id or -1, r.n_tokens) for r in tc.token_counts(frame(spark, rows()), PIECES).collect())
    assert got == sorted((d or -1, count(t) if t else 0) for d, t, *_ in rows())


def test_ties_go_as_in_the_tokenizer():
    entries = [("<unk>", 0.0), *((f"<0x{b:02X}>", -50.0) for b in range(256)), ("▁", -1.0), ("a", -2.0), ("aa", -4.0), ("aaa", -6.0), ("b", -3.0), ("ab", -5.0), ("ba", -5.0), ("▁a", -3.0), ("▁▁", -2.0)]
    ours, theirs = tc.Counter(entries), reference(entries)
    import itertools

    for n in range(1, 7):
        for text in map("".join, itertools.product("ab ", repeat=n)):
            assert ours.count(text) == theirs(text), text
    for text in ("é", "aéb", "éé\n\na", "\n", "a\n b", "▁a", "🙂 a"):
        assert ours.count(text) == theirs(text), text


def test_unfit_vocabularies_are_refused():
    with pytest.raises(ValueError):
        tc.Counter([("a", -0.5)])
    with pytest.raises(ValueError):
        tc.Counter([("a▁b", -1.0)])


def test_word_ids_are_the_tokenizers(ids):
    import random

    rng, words = random.Random(8), tr.WordIds(WORDS, 2)
    alphabet = [*" \n'.,!-_<|>09aBZzéÉßøÿ×½ª́\t\x1c\x85 ", "'s", "'LL", "don't", "<|endoftext|>", "中", "word", "İ", "ﬁ", "</w>", "%%%", "가"]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(16))) for _ in range(5000)]
    for text, got in zip(texts, words.encode_all(texts)):
        assert np.frombuffer(got, "<u2").tolist() == ids(text)[:-1], text


def test_large_ids_beside_missing_ones(spark):
    big = 2**53 + 1
    docs = frame(spark, [(big, "a b"), (None, "c"), (big + 2, "d")]).coalesce(1)
    assert {r.doc_id for r in tr.record_digests(docs, WORDS, 1).collect()} == {big, None, big + 2}
    assert {r.doc_id for r in tc.token_counts(docs, PIECES).collect()} == {big, None, big + 2}


def test_unknown_pieces_go_to_the_model_alone_and_read_as_the_tokenizer_reads():
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    words = tr.WordIds(path, 2)
    calls = []
    words.tokenizer, plain = type("Counted", (), {"model": words.tokenizer.model, "encode_batch_fast": lambda self, *a, **k: calls.append(a)})(), words.tokenizer
    texts = ["Zwölf Größen, don't 'LL x1y22 é.É Àÿ!", "qxzv" * 9 + " a-b_c{d}~", ""]
    got = words.encode_all(texts)
    assert words.direct and not calls
    assert [list(np.frombuffer(g, "<u2")) for g in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    words.tokenizer, words.direct = plain, False
    words.pieces.clear()
    words.clear()
    words[""] = b""
    assert words.encode_all(texts) == got

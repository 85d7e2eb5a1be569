import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from hunch.llm import common as C
from hunch.llm import ordering as O
from hunch.llm import packing as P
from hunch.llm import tokens as T

from . import util as U

ODD = ["", " ", "  ", "a", " a", "  a", "a  ", "a \n b", "a\n\nb", "\n a", "don't we'll I've they're x'sabc 'tis ' s 's !'s !!'re's", "it''s", "a'", "'", "''",
       "12 3a 4", "été 12½ ²", "日本語 テスト", "a\t\tb \t c", "<|endoftext|>x", "😀 👍🏽!!", "\r\n x \r\n", "a'r 're", "x' y", "1's 2't", "a\x00b \x00\x00 x", "\x00"]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def test_ids_equal_the_library(library):
    e = T.Encoder(T.default_vocab())
    r = random.Random(3)
    mixed = ["".join(r.choice("ab'st re\n\t é1日.! ​") for _ in range(r.randrange(40))) for _ in range(400)]
    texts = ODD + mixed + [U.words(3000, 4)]
    ids, off = e.encode(texts)
    for i, x in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert ids[off[i]:off[i + 1]].tolist() == x.ids, texts[i]
    assert e.encode([])[1].tolist() == [0] and e.encode(["", ""])[1].tolist() == [0, 0, 0]


def test_added_tokens_equal_the_library(spark):
    """The ids that operators use, against the library as the file sets it up: added tokens keep their ids."""
    import public_tokenizers
    from tokenizers import Tokenizer
    default = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    e, r, mark = T.encoder(T.default_vocab()), random.Random(8), "<|endoftext|>"
    assert e.encode([f"one {mark} two"])[0].tolist() == [505, 220, 50256, 734]
    texts = ["plain", mark, mark * 3, f" {mark} ", "", f"a{mark}", f"{mark}b", "<|endoftext|", "|>", f"<|{mark}|>", f"x\x00{mark}\x00 \n{mark}\n y", f"it{mark}'s"]
    texts += ["".join(r.choice([mark, " ", "ab", "'s", "\n", "<|", "é1"]) for _ in range(r.randrange(12))) for _ in range(300)]
    ids, off = e.encode(texts)
    want = [x.ids for x in default.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:], strict=True)] == want
    C.ship(spark)
    got = P.pack_documents(U.docs(spark, list(enumerate(texts)))).toPandas()
    assert {(x.doc_id, x.length, x.ids_crc32) for x in got.itertuples()} == {
        (i, len(x) + 1, zlib.crc32(np.array([*x, 2], "<u4").tobytes())) for i, x in enumerate(want)}


def test_cache_bound_does_not_change_ids(library, monkeypatch):
    monkeypatch.setattr(T, "CACHE_PIECES", 50)
    e = T.Encoder(T.default_vocab())
    for seed in range(4):
        t = U.words(200, seed)
        assert e.encode([t])[0].tolist() == library.encode(t, add_special_tokens=False).ids


def test_plan_is_a_packing():
    r = random.Random(1)
    for _ in range(150):
        cap = r.choice([8, 64, 100])
        counts = {r.randint(1, cap): r.randint(1, 30) for _ in range(r.randint(1, 40))}
        slots, made = P.plan(counts, cap)
        fill, used = defaultdict(list), defaultdict(list)
        for size, lo, n, base, off in slots:
            used[size] += range(lo, lo + n)
            for i in range(n):
                fill[base + i].append((off, size))
        assert {k: sorted(v) for k, v in used.items()} == {k: list(range(n)) for k, n in counts.items()}
        assert sorted(fill) == list(range(made))
        for v in fill.values():
            at = 0
            for off, size in sorted(v):
                assert off == at
                at += size
            assert at <= cap and sum(3 * s > cap for _, s in v) <= 2


def test_packing(spark, library):
    C.ship(spark)
    texts = U.odd_texts()
    got = P.pack_documents(U.docs(spark, texts)).toPandas()
    want = []
    for i, t in texts:
        if i is not None:
            ids = library.encode(t or "", add_special_tokens=False).ids + [2]
            at = piece = 0
            while at < len(ids):
                n = (len(ids) - at) % 1024 or 1024
                want.append((i, piece, at, n, zlib.crc32(np.array(ids[at:at + n], "<u4").tobytes())))
                at, piece = at + n, piece + 1
    assert sorted(got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == sorted(want)
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert (s.offset.values == s.length.cumsum().values - s.length.values).all() and s.length.sum() <= 1024
    assert got.sequence_id.nunique() <= 1.1 * -(-got.length.sum() // 1024) + 1
    assert P.pack_documents(U.docs(spark, [])).count() == 0


def test_feistel_is_a_bijection():
    for n in (1, 2, 3, 5, 17, 256, 1000, 4097):
        f = O.Feistel(n, 9)
        s = f.slot(np.arange(n))
        assert sorted(s.tolist()) == list(range(n)) and (f.index(s) == np.arange(n)).all()
    assert (O.Feistel(1000, 1).slot(np.arange(1000)) != O.Feistel(1000, 2).slot(np.arange(1000))).any()


def test_shards_round_trip(spark, library, tmp_path):
    C.ship(spark)
    texts, uri = U.odd_texts(), f"file://{tmp_path}/out"
    m = O.materialise(U.docs(spark, texts).repartition(3), uri, length=64, per_shard=50).toPandas().sort_values("slot")
    assert m.slot.tolist() == list(range(len(m))) == sorted(m.sequence.tolist())
    got = list(O.read_slots(uri, 0, len(m), 64, 50))
    assert [zlib.crc32(g[:n].tobytes()) for g, n in zip(got, m.n_tokens, strict=True)] == m.ids_crc32.tolist()
    assert all((a == b).all() for a, b in zip(O.read_slots(uri, 47, 60, 64, 50), got[47:107], strict=True))  # resumes inside a shard
    stream = defaultdict(int)
    for g, n in zip(got, m.n_tokens, strict=True):
        for x in g[:n].tolist():
            stream[x] += 1
    want = defaultdict(int)
    for i, t in texts:
        if i is not None:
            for x in library.encode(t or "", add_special_tokens=False).ids + [2]:
                want[x] += 1
    assert stream == want
    assert sorted(x for d in m.doc_ids for x in set(d)) and {x for d in m.doc_ids for x in d} == {i for i, _ in texts if i is not None}
    assert O.materialise(U.docs(spark, []), uri + "2").count() == 0


def test_ids_beyond_two_bytes_raise():
    assert O._narrow(np.array([0, 65_535])).tolist() == [0, 65_535] and len(O._narrow(np.zeros(0, np.int64))) == 0
    with pytest.raises(ValueError, match="70000"):
        O._narrow(np.array([1, 70_000]))

"""Token operators against whole-text encoding: wavelet files, packing, the word cache."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from opslens.llm import encode as encoding
from opslens.llm import repacking, wavelet
from opslens.llm.common import new_path
from opslens.llm.encode import Encoder, with_end

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n b", "a\n\nb", "a  b", "a  b", "a   b",
    "don't we'll I'M", "x'llama 'll", "Zu und.\nDieüauß der.\n", "été à la carte", "<|endoftext|> end", "x <|endoftext|> y", "<|endoftext|><|endoftext|>", "a <|endoftext| >\n<|endoftext|>\n b  <|endoftext|>  c", "1,234.5 km²",
    "tab\there\x0bthere", "日本語 テキスト 。", "a\r\nb\r\n\r\nc", "🙂 🙂\n🙂", "\n\n\nx\n \ny", "end \n", "A.B.C ... !!\nWow\n1", "\x1c a\x1d b\x85 c",
    "word " * 3000,
]


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def split(ids, offsets):
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]


def test_encoder_equals_whole_text(plain):
    want = [plain(t) for t in ODD]
    for pieces in (1_000_000, 5):  # with room, and starting anew all the time
        encode = Encoder(PATH, pieces)
        assert split(*encode.encode(pa.array(ODD))) == want
        assert split(*encode.encode(pa.array(ODD[::-1]))) == want[::-1]  # all from the cache
        assert split(*encode.encode(pa.array(ODD).slice(7, 9))) == want[7:16]
    assert split(*with_end(*encode.encode(pa.array(ODD)))) == [w + [0] for w in want]
    assert split(*encode.encode(pa.array([], pa.string()))) == []


ENCODER = Encoder(PATH)


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.lists(st.sampled_from([*" \n\t\r.,'!-aAbtsléß  　\x1f\x85€漢🙂12", "<|endoftext|>", "<|endoftext", "|>"]), max_size=14).map("".join), max_size=5
    )
)
def test_encoder_equals_whole_text_on_any_text(plain, texts):
    assert split(*ENCODER.encode(pa.array(texts, pa.string()))) == [plain(t) for t in texts]


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 5000])
def test_wavelet_matrix(n):
    rng = np.random.default_rng(n)
    ids = rng.choice([0, 1, 5, 300, 50256], size=n).astype(np.uint16)
    shard = wavelet.Shard(wavelet.to_bytes(ids, 16, [7, None], np.array([n, 0]), part=3, sequence=1) + b"\n")
    m = shard.matrix
    assert shard.doc_ids == [7, None] and shard.header["part"] == 3
    assert m.decode().tolist() == ids.tolist()
    at = rng.integers(0, n, size=50) if n else np.array([], int)
    assert m.access(at).tolist() == ids[at].tolist()
    for token in (0, 5, 300, 50256, 2, 70000):
        places = np.flatnonzero(ids == token)
        assert m.occurrences(token).tolist() == places.tolist()
        assert m.count(token) == len(places)
        for low, high in ((0, n), (n // 3, n // 2)):
            assert m.count(token, low, high) == ((places >= low) & (places < high)).sum()
        if len(places):
            assert m.select(token, len(places) - 1) == places[-1]


@pytest.mark.parametrize("n", [wavelet._BLOCK - 1, wavelet._BLOCK, 2 * wavelet._BLOCK + 1])
def test_planes_over_several_blocks(n):
    ids = np.random.default_rng(n).integers(0, 50257, n).astype(np.uint16)
    m = wavelet.WaveletMatrix.build(ids, 16)
    assert (m.decode() == ids).all() and (m.access(np.arange(n)) == ids).all()
    here = ids
    for level, zeros in zip(range(15, -1, -1), m.zeros, strict=True):
        bit = (here >> level) & 1
        assert zeros == (bit == 0).sum()
        here = here[np.argsort(bit, kind="stable")]


def test_rare_words_of_earlier_tasks_are_not_encoded_again(monkeypatch):
    """The files' encoder has room for more pieces than that of packing, and a smaller limit holds again afterwards."""
    assert wavelet.CACHE_PIECES >= 4 * encoding.CACHE_PIECES
    monkeypatch.setattr(encoding, "_ENCODERS", {})
    first, second = ["".join(f" {w}{i}" for i in "abcdef") for w in ("one", "two")]

    def learned(limit):
        encode, pieces = encoding.encoder(PATH, limit), []
        known = encode._learn
        monkeypatch.setattr(encode, "_learn", lambda new: (pieces.extend(new), known(new))[1])
        for text in (first, second, first):
            encode.encode(pa.array([text]))
        monkeypatch.setattr(encode, "_learn", known)
        return len(pieces)

    assert [learned(20), learned(8), learned(20)] == [12, 18, 6]


ROWS = [(i * 3 % 40, t, "x") for i, t in enumerate(ODD)] + [(5, "same row", "x")] * 3 + [(None, "no id", "x"), (None, None, None)]
SCHEMA = "doc_id long, text string, start string"


@pytest.mark.parametrize("shard_tokens", [1, 50, 1 << 22])
def test_corpus_index(spark, plain, shard_tokens):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = wavelet.corpus_index(df, PATH, shard_tokens).collect()
    want = sorted(
        ((d is not None, d or 0), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        for d, ids in ((d, plain(t) + [0]) for d, t, _ in ROWS)
    )
    key = lambda r: (r.doc_id is not None, r.doc_id or 0)
    assert sorted((key(r), r.n_tokens, r.ids_crc32) for r in got) == want
    at, before = 0, (False, 0)
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and key(r) >= before
        at, before = at + r.n_tokens, key(r)


def test_index_of_nothing_and_search(spark, plain):
    assert wavelet.corpus_index(spark.createDataFrame([], SCHEMA), PATH).count() == 0
    path = new_path(spark, "test")
    wavelet.write_shards(spark.createDataFrame(ROWS, SCHEMA), path, PATH, 100)
    shards = [wavelet.Shard(bytes(r.content)) for r in wavelet.read_shards(spark, path).collect()]
    assert len(shards) > 1
    assert sum(s.matrix.count(0) for s in shards) == len(ROWS)  # every document's end


def check_packing(rows, capacity):
    """No sequence over capacity, no gap, no overlap; returns the number of sequences."""
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_pack_documents(spark, plain):
    df = spark.createDataFrame(ROWS, SCHEMA)
    rows = repacking.pack_documents(df, PATH, 64).collect()
    check_packing(rows, 64)
    whole = {}
    for d, t, _ in ROWS:
        ids = plain(t) + [0]
        first = (len(ids) - 1) % 64 + 1
        cuts = [0, *range(first, len(ids) + 1, 64)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            key = (d, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
            whole[key] = whole.get(key, 0) + 1
    got = {}
    for r in rows:
        key = (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
        got[key] = got.get(key, 0) + 1
    assert got == whole
    assert repacking.pack_documents(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_exchange_never_needs_more(spark):
    rng = np.random.default_rng(1)
    lengths = rng.choice([11, 21, 26, 34, 41, 51, 64], size=900)
    df = spark.createDataFrame([(i, 0, 0, int(n), 0) for i, n in enumerate(lengths)], repacking.PIECES)
    one = check_packing(repacking.pack(df, 64, 100, rounds=0).collect(), 64)
    more = repacking.pack(df, 64, 100, fan=3, rounds=3).collect()
    assert len(more) == 900
    assert repacking.lower_bound(lengths, 64) <= check_packing(more, 64) <= one


def optimum(lengths, capacity):
    best = len(lengths)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for b in sorted({v: k for k, v in enumerate(bins)}.values()):
            if bins[b] + lengths[i] <= capacity:
                place(i + 1, [v + lengths[i] * (k == b) for k, v in enumerate(bins)])
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.integers(5, 25).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), min_size=1, max_size=8))))
def test_bound_is_below_optimum(case):
    capacity, lengths = case
    lengths = sorted(lengths, reverse=True)
    best = optimum(lengths, capacity)
    bins, offsets, n = repacking.best_fit(np.array(lengths), capacity)
    assert repacking.lower_bound(np.array(lengths), capacity) <= best <= n == len(set(bins))
    # Large items alone certify what the plain total cannot.
    assert repacking.lower_bound(np.full(4, capacity // 2 + 1), capacity) == 4

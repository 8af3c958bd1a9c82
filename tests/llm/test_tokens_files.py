"""Tokenization, packing and record files against the tokenizers library."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import ODD_ROWS
from wardline.llm import packing, records
from wardline.llm.tokens import PieceTokenizer

P = pytest.importorskip("public_tokenizers")


def library_ids(name, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path(name))
    return [np.array(t.encode(x or "", add_special_tokens=False).ids + [2], "<u4") for x in texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_equal_whole_text_encoding(name):
    rng = random.Random(7)
    parts = ["a", "Bc", " ", "  ", "\n", "\t", "é", "\u0301", "12", "'s", "!", "\x1c", "\x1f", "\x85", "\xa0", "\u3000",
             "<|endoftext|>", "don't", " x", "日本", "Σ", "ΑΣ", "word.", "end,.", "...", "x.,y"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(1500)] + [None, "z " * 9000]
    piece = PieceTokenizer(P.path(name), 2)
    want = library_ids(name, texts)
    for rows, ids, offsets in piece.encode(pa.array(texts)):
        for i, w in enumerate(want[rows]):
            assert ids[offsets[i]: offsets[i + 1]].tolist() == w.tolist()


def test_place_fills_open_gaps_and_respects_capacity():
    rng = np.random.default_rng(2)
    for lengths in (rng.integers(1, 101, 700), np.full(50, 100), np.full(60, 51), np.array([1]), np.array([], int)):
        sequence, offset = packing.place(lengths, 100)
        used = defaultdict(list)
        for s, o, n in zip(sequence, offset, lengths):
            used[s].append((o, n))
        for parts in used.values():
            at = 0
            for o, n in sorted(parts):
                assert o == at
                at += n
            assert at <= 100
        if len(lengths) == 700:
            assert len(used) <= -(-int(lengths.sum()) // 100) * 1.02


def test_place_follows_the_sum_of_squares_rule():
    """Every placement is one of those with the smallest sum of squared counts, by recount."""
    lengths = np.random.default_rng(3).integers(1, 20, 120)
    sequence, offset = packing.place(lengths, 20)
    fill: dict[int, int] = {}
    for i in np.argsort(-lengths, kind="stable"):
        s = int(lengths[i])
        room = {20 - f for f in fill.values() if f < 20 and 20 - f >= s}

        def total(gap):
            counts = defaultdict(int)
            for f in fill.values():
                if f < 20:
                    counts[20 - f] += 1
            counts[gap] -= 1
            if gap > s:
                counts[gap - s] += 1
            return sum(c * c for c in counts.values())

        if room:
            assert sequence[i] in fill
            assert total(20 - int(offset[i])) == min(map(total, room))
        else:
            assert sequence[i] not in fill and offset[i] == 0
        fill[int(sequence[i])] = int(offset[i]) + s


def test_packing_returns_every_id_once(make_docs):
    docs = make_docs(ODD_ROWS, extra=True)
    got = packing.pack_documents(docs, P.path("byte_bpe_50k.json"), 2, capacity=64, with_ids=True, group=3).toPandas()
    want = defaultdict(list)
    for (i, t), ids in zip(ODD_ROWS, library_ids("byte_bpe_50k.json", [t for _, t in ODD_ROWS])):
        want[i].append(ids.tobytes())
    for i, copies in want.items():
        mine = got[got.doc_id.isna()] if i is None else got[got.doc_id == i]
        if len(copies) == 1:
            mine = mine.sort_values("piece")
            assert b"".join(mine.ids) == copies[0]
            assert mine.start.tolist() == np.concatenate(([0], mine.length.cumsum()[:-1])).tolist()
            assert (mine.length.iloc[1:] == 64).all()
        assert mine.length.sum() * 4 == sum(map(len, copies))
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in got.itertuples())
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == np.concatenate(([0], g.length.cumsum()[:-1])).tolist() and g.length.sum() <= 64
    assert packing.pack_documents(make_docs([]), P.path("byte_bpe_50k.json"), 2).count() == 0


def test_record_files_round_trip(spark, make_docs, tmp_path):
    rows = [r for r in ODD_ROWS if r[0] is not None] + [(100 + i, f"text {i} " * i) for i in range(60)] + [(-5, "neg")]
    folder = str(tmp_path / "rec")
    got = records.encode_and_read(make_docs(rows, extra=True), P.path("word_bpe_49k.json"), 2, folder).collect()
    got.sort(key=lambda r: r.start)
    order = sorted(range(len(rows)), key=lambda k: rows[k][0])
    ids = library_ids("word_bpe_49k.json", [t for _, t in rows])
    at = 0
    for r, k in zip(got, order, strict=True):
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (rows[k][0], at, len(ids[k]), zlib.crc32(ids[k].tobytes()))
        at += len(ids[k])
    shard = records.read_manifest(spark, folder).orderBy("shard").collect()[-1]
    index = records.read_index(folder, shard.shard)
    for n in (len(index) - 1, 0):                       # shuffled reads through the index
        _, some = records.read_record(folder, shard.shard, int(index[n, 0]))
        assert len(some) == index[n, 1]
    assert records.encode_and_read(make_docs([]), P.path("word_bpe_49k.json"), 2).count() == 0


def test_corruption_is_found():
    good = records.frame(7, np.array([1, 2, 70_000], np.uint32)) + records.frame(None, np.array([], np.uint32))
    first = records.parse(good)
    assert first[0] == 7 and first[1].tolist() == [1, 2, 70_000] and records.parse(good, first[2])[:1] == (None,)
    for at in (0, 5, 9, 14, 25, first[2] - 1):
        bad = bytearray(good)
        bad[at] ^= 1
        with pytest.raises((records.CorruptRecord, Exception)):
            records.parse(bytes(bad))


def test_tokenizer_cache_and_slices_stay_small(monkeypatch):
    """The pieces a worker keeps and the text it encodes at once are bounded; the ids stay the library's."""
    from wardline.llm import kernels, tokens

    assert tokens.MAX_CACHED <= 600_000 and tokens.SLICE_BYTES <= 1 << 20
    monkeypatch.setattr(tokens, "MAX_CACHED", 300)
    monkeypatch.setattr(tokens, "SLICE_BYTES", 2000)
    texts = [" ".join(f"w{i * j % 977}x{j}" for j in range(40)) for i in range(200)]
    piece, kept = PieceTokenizer(P.path("byte_bpe_50k.json"), 2), 0
    want = library_ids("byte_bpe_50k.json", texts)

    def encoded(batches):
        for column in batches:
            yield from piece.encode(column)

    at = 0
    for _, ids, offsets in kernels.lean(encoded)([pa.array(texts[:90]), pa.array(texts[90:])]):
        kept = max(kept, len(piece.index))
        for i in range(len(offsets) - 1):
            assert ids[offsets[i]: offsets[i + 1]].tolist() == want[at].tolist()
            at += 1
    assert at == 200 and kept < 2000


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_new_pieces_are_encoded_joined_and_a_full_cache_keeps_the_used_ones(monkeypatch, name):
    """Far fewer encodings than pieces, the library's ids, and pieces that came back stay when the cache is full."""
    from wardline.llm import tokens

    monkeypatch.setattr(tokens, "MAX_CACHED", 4000)
    monkeypatch.setattr(tokens, "SLICE_BYTES", 20_000)
    rng = random.Random(5)
    letters = "abcdefgéßñ"
    common = ["".join(rng.choice(letters) for _ in range(6)) for _ in range(100)]

    def text():
        return " ".join(rng.choice(common) if rng.random() < 0.5 else "".join(rng.choice(letters) for _ in range(9))
                        + rng.choice(["", ".", "!!", "###", ",&"]) for _ in range(100))

    texts = [text() for _ in range(200)] + ["aक़ क़b <|endoftext|> x<|endoftext|>", "don't!! 'tis'. \x7f a\x7f"]
    piece, cut = PieceTokenizer(P.path(name), 2), []
    encode, shrink = piece._encode, piece._shrink
    seen = []

    def counted(batch):
        seen.append(len(batch))
        return encode(batch)

    def shrunk():
        shrink()
        cut.append(len(set(piece.index) & {x for c in common for x in (c, " " + c)}))

    monkeypatch.setattr(piece, "_encode", counted)
    monkeypatch.setattr(piece, "_shrink", shrunk)
    want = library_ids(name, texts)
    for rows, ids, offsets in piece.encode(pa.array(texts)):
        for i, w in enumerate(want[rows]):
            assert ids[offsets[i]: offsets[i + 1]].tolist() == w.tolist()
    assert cut and min(cut) > 90
    assert sum(seen) < 2000

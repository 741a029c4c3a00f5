import random

import pytest
import public_tokenizers
import sentencepiece

from tidebook.llm import queries, spm

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", " ", "a", "Hello  world ", "\n\n x\ty", "naïve façade 東京 🎉 \x00 ​", "▁ already", "é " * 50, "word " * 20_000, "x" * 3000, "</s><s> <unk>"]


@pytest.fixture(scope="module")
def codec():
    return spm.Codec(spm.load(PATH))


def slow_bpe(text):
    """Merge the best-scoring neighbour pair, leftmost first, until none is a piece."""
    norm = ("▁" + text.replace(" ", "▁")) if text else ""
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    parts = list(norm)
    while True:
        best = None
        for i in range(len(parts) - 1):
            j = sp.piece_to_id(parts[i] + parts[i + 1])
            if j != sp.unk_id() and (best is None or sp.get_score(j) > best[0]):
                best = (sp.get_score(j), i)
        if best is None:
            break
        parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
    ids = []
    for p in parts:
        j = sp.piece_to_id(p)
        ids += [j] if j != sp.unk_id() else [sp.piece_to_id(f"<0x{b:02X}>") for b in p.encode()]
    return [sp.bos_id(), *ids, sp.eos_id()]


def test_encoding_equals_library_and_brute_force(codec):
    rng = random.Random(4)
    small = ["".join(rng.choice("abe tñ日 .0") for _ in range(rng.randint(1, 40))) for _ in range(60)] + TEXTS[:8]
    lib = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for text, got in zip(small, codec.encode(small)):
        assert got.ids.tolist() == [1, *lib.encode(text), 2] == slow_bpe(text)


def test_decode_of_any_ids_equals_library(codec):
    rng = random.Random(7)
    lib = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for _ in range(4000):
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(260), rng.randrange(259, 400), 0, 1, 2]) for _ in range(rng.randint(0, 7))]
        assert codec.decode(ids) == lib.decode(ids), ids


def test_long_words_and_a_full_cache(codec, monkeypatch):
    monkeypatch.setattr(spm, "HELD", 8)
    rng = random.Random(5)
    lib = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(300)) for _ in range(20)] + ["".join(rng.choice("theinga") for _ in range(20_000)), " " * 500 + "x" * 500]
    for _ in range(2):
        for at in range(0, len(texts), 4):
            assert [g.ids.tolist() for g in codec.encode(texts[at : at + 4])] == [[1, *lib.encode(t), 2] for t in texts[at : at + 4]]
    assert all(len(w) <= spm.SHORT for w in codec.young)


@pytest.mark.parametrize("trim,fallback", [(False, True), (True, False)])
def test_whole_texts_through_a_character_map(trim, fallback):
    """A model with a non-empty map is built from the file's fields; the library reads the same bytes."""
    import struct

    def field(number, value):
        if isinstance(value, int):
            return varint(number << 3) + varint(value)
        return varint(number << 3 | 2) + varint(len(value)) + value

    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    units = [0] * 1024
    units[0] = 256 << 10
    a, z = 256 ^ ord("A"), 256 ^ ord("Z")
    units[a], units[512] = (a ^ 512) << 10 | 256 | ord("A"), 1 << 31  # A -> a
    b = 512 ^ ord("E")
    units[b], units[768] = (b ^ 768) << 10 | 256 | ord("E"), 1 << 31 | 2  # AE -> ae
    units[z], units[1000] = (z ^ 1000) << 10 | 256 | ord("Z"), 1 << 31 | 5  # Z -> a space
    blob = struct.pack("<I", 4096) + struct.pack("<1024I", *units) + b"a\x00ae\x00 \x00"
    model = b""
    for number, value in spm._fields(spm.load(PATH)):
        if number == 2:
            if not fallback:
                value = b"".join(field(n, v) if not isinstance(v, bytes) or n < 35 else varint(n << 3 | 2) + varint(len(v)) + v if len(v) != 4 else varint(n << 3 | 5) + v for n, v in spm._fields(value) if n != 35)
        elif number == 3:
            value = field(1, b"own") + field(2, blob) + field(3, 1) + field(4, int(trim)) + field(5, 1)
        elif not fallback and dict(spm._fields(value)).get(3) == spm.BYTE:
            value = value[: value.rindex(b"\x18")] + field(3, spm.UNUSED)
        model += field(number, value)
    lib, own = sentencepiece.SentencePieceProcessor(model_proto=model), spm.Codec(model)
    rng = random.Random(9)
    texts = ["".join(rng.choice("AEZabe tñ日 .\u0fd5") for _ in range(rng.randint(0, 60))) for _ in range(300)] + ["AE" * 5000, "  AE  Z ", " "]
    for text, got in zip(texts, own.encode(texts)):
        assert got.ids.tolist() == [1, *lib.encode(text), 2], text
        assert own.decode(got.ids) == lib.decode(lib.encode(text))
        assert got.start[0] == 0 and got.end[-1] in (0, len(text.encode())) and (got.start <= got.end).all()


def test_spans_tile_the_text_and_decode_restores_it(codec):
    lib = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for text, got in zip(TEXTS, codec.encode(TEXTS)):
        data = text.encode()
        assert got.start[0] == 0 and got.end[-1] == len(data) and (got.start <= got.end).all()
        if data:
            assert (got.end[1:-2] == got.start[2:-1]).all() and got.start[1] == 0 and got.end[-2] == len(data)
        assert got.ids.tolist() == [1, *lib.encode(text), 2] and codec.decode(got.ids) == lib.decode(lib.encode(text))
        pieces = lib.encode(text, return_type="proto").pieces
        chars = [(p.begin, p.end) for p in pieces]  # bytes
        plain = [(a, b) for a, b, i in zip(got.start[1:-1].tolist(), got.end[1:-1].tolist(), got.ids[1:-1]) if codec.kind[i] == spm.NORMAL][:100]
        assert set(plain) <= set(chars)


def test_longest_prefix_of_a_character_map():
    """A hand-made double array with the keys 'a' -> 'X' and 'ab' -> 'YZ'."""
    import struct

    units = [0] * 1024
    offset = lambda x: x << 10
    units[0] = offset(256)
    a = 256 ^ ord("a")
    units[a] = offset(a ^ 512) | 256 | ord("a")
    units[512] = 1 << 31 | 0
    b = 512 ^ ord("b")
    units[b] = offset(b ^ 768) | 256 | ord("b")
    units[768] = 1 << 31 | 2
    blob = struct.pack("<I", 4096) + struct.pack("<1024I", *units) + b"X\x00YZ\x00"
    m = spm.CharsMap(blob)
    assert m.longest(b"abc", 0) == (2, b"YZ") and m.longest(b"ac", 0) == (1, b"X") and m.longest(b"c", 0) is None
    c = spm.Codec(spm.load(PATH))
    c.map, c.trim = m, True
    norm, at = c.normalise("  ab a  c ")
    assert norm.decode() == "▁YZ▁X▁c" and at.tolist()[:5] == [0, 0, 0, 2, 2] and at[-1] == 10


def test_query_shapes(spark, docs_of, empty_docs, sf_dir):
    blob = spm.load(PATH)
    df = docs_of([(i, t) for i, t in enumerate(TEXTS)] + [(99, None), (1, " ")])
    rows = {(r["doc_id"], r["n_tokens"]): r for r in spm.digests(df, blob).collect()}
    assert (99, 2) in rows and (0, 2) in rows
    assert spm.digests(empty_docs, blob).count() == 0 and spm.encoded(empty_docs.select("doc_id", "text"), blob).count() == 0
    wide = spm.encode_spans(df.select("doc_id", "text"), blob)
    assert wide.count() == len(TEXTS) + 2 and wide.filter("size(ids) <> size(starts)").count() == 0
    assert queries.op8_sentencepiece(spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()

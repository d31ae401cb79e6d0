"""SentencePiece encoding, spans and decoding, against the library itself."""

import hashlib
import random
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyframe.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", " ", "   ", "\t\n x", "Aé 𝄞b", "  a  b ▁c\x00�", "▁", "▁▁ ", "hello world", "日本語テスト" * 40, "a" * 500, "ab " * 300, "<s> </s> <0x41> <unk>",
    "①ﬁ Åẛ̣　ﾊﾞ㍿​\x07", " ".join("x" * k for k in range(40)), "trailing  ", "é" * 200 + "𝄞" * 100,
]
ALPHABET = "ab é▁ \t\n日本𝄞ßthe.,<>0x1́ ①ﬁÅẛ̣　ﾊﾞ㍿\x00\x07​가각"


def _number(n):
    return bytes([n]) if n < 128 else bytes([n & 127 | 128]) + _number(n >> 7)


def _field(number, value):
    if isinstance(value, bytes):
        return _number(number << 3 | 2) + _number(len(value)) + value
    return _number(number << 3) + _number(value)


def model_with(char_map, prefix, squeeze, fallback):
    """The public model with another normaliser, and without byte pieces."""
    out = b""
    with open(PATH, "rb") as file:
        blob = file.read()
    for number, value in pieces._fields(blob):
        if number == 1:
            piece = dict(pieces._fields(value))
            if not fallback and piece.get(3) == pieces.BYTE:
                value = _field(1, piece[1]) + _number(2 << 3 | 5) + piece[2]
        elif number == 2:
            value = value.replace(_number(35 << 3) + b"\x01", _number(35 << 3) + bytes([fallback]))
        elif number == 3:
            value = _field(1, b"own") + _field(2, char_map) + _field(3, prefix) + _field(4, squeeze) + _field(5, 1)
        out += _field(number, value)
    return out


@pytest.fixture(scope="module")
def char_map():
    rules = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto()
    return dict(pieces._fields(dict(pieces._fields(rules))[3]))[2]


@lru_cache(maxsize=2)
def library_with(blob):
    return sentencepiece.SentencePieceProcessor(model_proto=blob)


def assert_equal(blob, texts):
    own, library = pieces.compiled(blob), library_with(blob)
    raw = [t.encode() for t in texts]
    offsets = np.append(0, np.cumsum([len(x) for x in raw])).astype(np.int64)
    ids, starts, ends, counts = pieces.encode_slice(own, np.frombuffer(b"".join(raw), dtype=np.uint8), offsets)
    to = np.cumsum(counts)
    lists = [ids[hi - n : hi] for hi, n in zip(to, counts)]
    for text, got, lo, hi, decoded in zip(texts, lists, to - counts, to, pieces.decode_many(own, lists)):
        found = library.encode(text, return_type="proto")
        assert [(p.id, p.begin, p.end) for p in found.pieces] == list(zip(got.tolist(), starts[lo:hi].tolist(), ends[lo:hi].tolist())), text
        assert decoded == library.decode(got.tolist()), text


@pytest.mark.parametrize("prefix", [0, 1])
@pytest.mark.parametrize("squeeze", [0, 1])
@pytest.mark.parametrize("fallback", [0, 1])
def test_every_normaliser_equals_the_library(char_map, prefix, squeeze, fallback):
    rng = random.Random(prefix + 2 * squeeze + 4 * fallback)
    texts = TEXTS + ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(60))) for _ in range(150)]
    assert_equal(model_with(b"", prefix, squeeze, fallback), texts)
    assert_equal(model_with(char_map, prefix, squeeze, fallback), texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"])), max_size=5))
def test_any_texts_equal_the_library(texts):
    with open(PATH, "rb") as file:
        assert_equal(file.read(), texts)


def test_decoding_of_any_ids():
    """Also ids that no text has: bytes that are no character, control pieces in between."""
    library, own = sentencepiece.SentencePieceProcessor(model_file=PATH), pieces.compiled(pieces.read_model(PATH))
    rng = random.Random(7)
    near = [0, 1, 2, *range(3, 259), 259, 28705, 28725, 260, 261]
    lists = [[rng.choice(near) for _ in range(rng.randrange(12))] for _ in range(2000)]
    lists += [[3 + b for b in "é𝄞".encode()], [1, 3 + 0xC3, 2, 3 + 0xA9], [259, 259, 260], [1, 259, 28705]]
    assert pieces.decode_many(own, [np.array(x, dtype=np.int64) for x in lists]) == [library.decode(x) for x in lists]


def test_characters_that_are_no_utf8_stand_for_a_replacement_each():
    own = pieces.compiled(pieces.read_model(PATH))
    raw = b"a\xc3 b\xff\xfe"
    ids, starts, ends, _ = pieces.encode_slice(own, np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)]))
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert ids.tolist() == library.encode("a� b��")
    assert ends.max() == len(raw) and starts.min() == 0


def test_other_models_are_refused():
    with open(PATH, "rb") as file:
        blob = file.read()
    trainer = dict(pieces._fields(blob))[2]
    with pytest.raises(ValueError, match="byte-pair"):
        pieces.PieceModel(blob.replace(trainer, trainer.replace(_field(3, 2), _field(3, 1), 1)))


def test_query_equals_the_library(spark, sf):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = entry.queries()["op11_sentencepiece"](spark, sf).collect()
    assert len(found) == len(texts)
    for row in found:
        ids = library.encode(texts[row.doc_id], add_bos=True, add_eos=True)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_odd_rows(spark, odd, nothing):
    """Nulls, empty and very long texts, repeated rows and clashing names; all columns are carried in row."""
    model = pieces.read_model(PATH)
    clashing = odd.withColumn("ids", F.lit("x")).withColumn("row", F.lit(1)).withColumn("starts", F.lit(None).cast("int"))
    found = pieces.encode(spark, clashing, model).withColumn("text_again", pieces.decode(spark, F.col("ids"), model))
    assert found.select("row.*").columns == clashing.columns
    library, rows = sentencepiece.SentencePieceProcessor(model_file=PATH), found.collect()
    assert len(rows) == odd.count()
    for row in rows:
        text = row.row["text"] or ""
        assert row.ids == library.encode(text, add_bos=True, add_eos=True) and row.text_again == text
        raw = text.encode()
        assert row.ends[-1] == len(raw) and row.starts[0] == row.ends[0] == 0
        # the spans of all pieces cover the text once, in order
        assert b"".join(raw[a:b] for a, b in zip(row.starts, row.ends)) == raw
    bare = pieces.encode(spark, odd, model, begin=False, end=False).select(F.col("row.text").alias("text"), "ids").collect()
    assert all(r.ids == library.encode(r.text or "") for r in bare)
    assert pieces.encode(spark, nothing, model).select("ids", pieces.decode(spark, F.col("ids"), model)).collect() == []

import random
import zlib

import numpy as np
import pytest
import public_tokenizers
from corpus import documents, edge_rows, prose, with_clashes
from tokenizers import Tokenizer

from shelfrank.llm import store, token_records

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def texts():
    rng = random.Random(9)
    odd = [
        "", " ", "  two  blanks ", "line\nline \n next", "it's we'll I'd 'tis", "x <|endoftext|> y",
        "a<|endoftext|>", "éñ😀 ß nb wide", "tab\tand\rreturn", "12 345 6-7", "....,,,", "\x00 \x1f z",
        "trailing ", " leading", "don't 'll 's",
    ]
    return odd + [prose(rng, 50).replace(" ", rng.choice([" ", "\n", ", "]), 3) for _ in range(20)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_library_on_whole_texts(name):
    path = public_tokenizers.path(name)
    library, encoder = Tokenizer.from_file(path), token_records.Encoder(path)
    for got, text in zip(encoder.encode(texts()), texts(), strict=True):
        assert got.tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_encoder_forgets_words_without_harm(monkeypatch):
    monkeypatch.setattr(token_records, "CACHED_WORDS", 5)
    encoder = token_records.Encoder(TOKENIZER)
    first = [ids.tolist() for ids in encoder.encode(texts())]
    assert [ids.tolist() for ids in encoder.encode(texts())] == first


def test_unknown_words_are_encoded_together_and_repeated_ones_once(monkeypatch):
    encoder, asked = token_records.Encoder(TOKENIZER), []
    whole = encoder._whole
    monkeypatch.setattr(encoder, "_whole", lambda texts: asked.extend(texts) or whole(texts))
    rows = [" ".join(f"w{k}-{k * k}" for k in range(low, low + 400)) for low in range(0, 2800, 200)]
    library = Tokenizer.from_file(TOKENIZER)
    for got, text in zip(encoder.encode(rows), rows, strict=True):
        assert got.tolist() == library.encode(text, add_special_tokens=False).ids
    # 3,000 distinct words, and the first of every text.
    assert len(asked) == 3000 // token_records.JOINED_WORDS + len(rows)
    encoder.encode(rows)
    assert len(asked) == 3000 // token_records.JOINED_WORDS + len(rows)


@pytest.mark.parametrize("joined", [1, 2, 1000])
def test_joined_words_are_parted_where_they_begin(monkeypatch, joined):
    monkeypatch.setattr(token_records, "JOINED_WORDS", joined)
    odd = [
        "Ġ Ġa ĠĠ aĠ", "<|endoftext|> a <|endoftext|><|endoftext|> b<|endoftext|> Ġ<|endoftext|>", "a\u3000b \u3000c d\u00a0 e",
        "a\n\nb \n c\td", "1 22 333 4,4 ... !? a.\nB c'll 're", "é ñandú ß 漢字 \u0301x 😀😀", "\x00 \x01a b\x1f", " ", "  x", "x  ",
    ]
    library, encoder = Tokenizer.from_file(TOKENIZER), token_records.Encoder(TOKENIZER)
    for rows in (odd + texts(), odd[::-1], []):
        assert [ids.tolist() for ids in encoder.encode(rows)] == [library.encode(t, add_special_tokens=False).ids for t in rows]


def test_a_vocabulary_without_the_blank_has_its_words_encoded_alone():
    encoder = token_records.Encoder(TOKENIZER)
    encoder.opens[:] = False
    library = Tokenizer.from_file(TOKENIZER)
    for got, text in zip(encoder.encode(texts()), texts(), strict=True):
        assert got.tolist() == library.encode(text, add_special_tokens=False).ids


def test_frames_detect_damage():
    framed = token_records.frame(b"payload") + token_records.frame(b"")
    payload, place = token_records.unframe(framed, 0)
    assert payload == b"payload" and token_records.unframe(framed, place) == (b"", len(framed))
    for k in range(len(framed)):
        damaged = bytes([*framed[:k], framed[k] ^ 1, *framed[k + 1 :]])
        with pytest.raises(ValueError):
            token_records.unframe(damaged, token_records.unframe(damaged, 0)[1])
    with pytest.raises(ValueError):
        token_records.unframe(framed[:-1], place)


def round_trip(spark, docs, folder, parts=None, monkeypatch=None):
    token_records.write_token_records(docs, str(folder), TOKENIZER)
    return token_records.read_token_records(spark, str(folder))


def expected(rows):
    library, start, found = Tokenizer.from_file(TOKENIZER), 0, []
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        found.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return found


def test_round_trip_in_id_order_by_runs_of_frames(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_records, "READ_BYTES", 300)
    rows = [(7 * k % 101, text) for k, text in enumerate(texts())]
    records = round_trip(spark, documents(spark, rows).repartition(5), tmp_path / "r").collect()
    got = [(r["doc_id"], r["first_token"], r["n_tokens"], zlib.crc32(bytes(r["ids"]))) for r in records]
    assert sorted(got) == sorted(expected(rows))
    for r in records:
        assert np.frombuffer(bytes(r["ids"]), "<u4")[-1] == 0 and len(r["ids"]) == 4 * r["n_tokens"]


def test_edge_cases(spark, tmp_path):
    docs = with_clashes(documents(spark, edge_rows()))
    records = round_trip(spark, docs, tmp_path / "edge").collect()
    got = [(r["doc_id"], r["first_token"], r["n_tokens"], zlib.crc32(bytes(r["ids"]))) for r in records]
    total = sum(n for _, _, n, _ in expected(edge_rows()))
    assert len(got) == len(edge_rows()) and sum(n for _, _, n, _ in got) == total
    # Two rows without an id may stand in either order; all others have one place.
    known = [x for x in expected(edge_rows()) if x[0] is not None]
    assert sorted(x for x in got if x[0] is not None) == sorted(known)
    assert round_trip(spark, docs.limit(0), tmp_path / "none").count() == 0


def test_damaged_files_raise(spark, tmp_path):
    docs = documents(spark, [(k, text) for k, text in enumerate(texts())])
    manifest = token_records.write_token_records(docs, str(tmp_path / "d"), TOKENIZER)
    row = manifest.orderBy("shard").first()
    data = bytearray(store.read_range(row["data"], 0, row["bytes"]))
    data[20] ^= 1
    with store.create(row["data"]) as file:
        file.write(bytes(data))
    with pytest.raises(Exception, match="damaged record"):
        token_records.read_token_records(spark, str(tmp_path / "d")).collect()

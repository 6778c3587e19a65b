"""BPE, token files, WARC and fingerprints: equality with the library and exact round trips."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from basketry.llm import bpe, fingerprint, token_file, warc
from basketry.llm.queries import tokenizer_path
from basketry.llm.storage import new_folder, read_manifest

ODD = ["", "a", " ", "  ", " a  b ", "\n\n x", "hello<|endoftext|>world <|endoftext|> ", "don't we'll I'D they're", "日本語 テスト　x", "😀😀 é́\xa0x\x85y\x1cz",
       "1234567 ²½ abc١٢", "a" * 300 + " " + "the" * 200, " \t\r\n\x0b\x0c  end", "ñandú\n\n\nÉté", "x" * 65 + "yz" * 100, "a  b​ c﻿d", "\x00\x01", "end of line \n next  \n"]
DOCS = "doc_id long, text string, ids string"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def texts():
    r = random.Random(4)
    made = ["".join(r.choice(["the", "ing", " ", "  ", "\n", ",", "Zür", "é", "7", "'s", "***", "\u2003", "q"]) for _ in range(r.randint(0, 200))) for _ in range(150)]
    return ODD + made


def test_bpe_equals_the_library(library, texts):
    path = tokenizer_path()
    for text, raw in zip(texts, bpe.encode_texts(texts, path)):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(raw, "<u4").tolist() == ids, text
        assert bpe.decode_ids(raw, path) == library.decode(ids, skip_special_tokens=False)


def test_bpe_decodes_broken_characters_as_the_library(library):
    ids = library.encode("日本語é", add_special_tokens=False).ids
    for some in (ids[1:], ids[:-1], ids[::2], [50256, 0]):
        assert bpe.decode_ids(np.array(some, "<u4").tobytes(), tokenizer_path()) == library.decode(some, skip_special_tokens=False)


def test_long_words_give_the_same_as_repeated_scans():
    v = bpe.load(tokenizer_path())
    r = random.Random(1)
    words = ["".join(r.choice("abetionsh") for _ in range(r.randint(2, 64))).encode() for _ in range(200)]
    for word, ids in zip(words, bpe.merge_short(words, v)):
        assert bpe.merge_long(word, v).tolist() == ids.tolist()
    assert b"".join(v.bytes_of[i] for i in bpe.merge_long(b"the " * 50_000, v)) == b"the " * 50_000


def test_piece_memory_may_be_small(library, texts):
    v = bpe._encoder(tokenizer_path())
    small = bpe.PieceEncoder(v.whole, v.following, v.special, 5)
    for a in range(0, len(texts), 7):
        for text, ids in zip(texts[a : a + 7], small.encode(texts[a : a + 7])):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_bpe_over_rows(spark, library, texts):
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(900, None, None), (900, None, None)]
    both = bpe.decode(bpe.encode(spark.createDataFrame(rows, DOCS), tokenizer_path()), tokenizer_path()).collect()
    assert len(both) == len(rows)
    assert {r["doc_id"]: r["text"] for r in both} == {i: t or "" for i, t, _ in rows}
    assert bpe.encode(spark.createDataFrame([], DOCS), tokenizer_path()).collect() == []


def test_token_files_hold_the_librarys_ids(spark, library, texts):
    rows = [(3 * i, t, "x") for i, t in enumerate(texts)] + [(1, None, None), (4, "again", None), (4, "again", None)]
    random.Random(5).shuffle(rows)
    folder = new_folder(spark, "test")
    docs = spark.createDataFrame(rows, DOCS).repartition(7)
    manifest = token_file.write_tokens(docs, folder, tokenizer_path(), file_tokens=700)
    assert len(manifest) > 3 and [e["name"] for e in read_manifest(folder)] == sorted(e["name"] for e in manifest)
    got = sorted(tuple(r) for r in token_file.read_tokens(spark, folder, manifest).collect())
    start, expected = 0, []
    for doc, text, _ in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        expected.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == sorted(expected)
    assert token_file.round_trip(spark.createDataFrame([], DOCS), tokenizer_path()).collect() == []


@pytest.mark.parametrize("top", [1, 255, 256, 70_000, 2**31])
def test_any_token_is_addressed_directly(top):
    ids = np.random.default_rng(top).integers(0, top, 5000).astype("<u4")
    f = token_file.TokenFile(token_file.pack(ids, np.array([5, 6]), np.array([0, 100, 5000])))
    assert [f.token(i) for i in range(0, 5000, 37)] == ids[::37].tolist()
    for a, b in ((0, 5000), (511, 513), (512, 512), (4999, 5000), (1000, 3001)):
        assert np.array_equal(f.range(a, b), ids[a:b])
    with pytest.raises(IndexError):
        f.token(5000)


PAGES = "page_id long, url string, html string, digest string"


def test_warc_round_trip(spark):
    same, other = "<p>é" + "x" * 100, "y" * 99
    rows = [(5, "http://a/", same), (2, "http://b/\r\nX: 1", same), (9, None, same), (3, "u", other), (4, "u", other), (6, "u", None), (7, "u", ""),
            (8, "u", "z" * 300_000), (2, "http://b/", same), (10, "v", same + "!")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], PAGES).repartition(4)
    got = sorted(tuple(r) for r in warc.round_trip(pages).collect())
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    size = lambda t: len((t or "").encode())
    expected = [(p, size(h), sha(h), "response", None) for p, _, h in rows if p not in (2, 5, 9)]
    expected += [(2, size(same), sha(same), "response", None), (2, size(same), sha(same), "revisit", 2), (5, size(same), sha(same), "revisit", 2), (9, size(same), sha(same), "revisit", 2)]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert warc.round_trip(spark.createDataFrame([], PAGES)).collect() == []


def test_warc_files_are_the_same_on_every_run_and_roll_over(spark):
    r = random.Random(2)
    rows = [(i, f"http://h/{i}", "".join(r.choice("abcdefgh") for _ in range(2000)), "x") for i in range(60)]
    made = []
    for parts in (2, 9):
        folder = new_folder(spark, "test")
        made.append(warc.write_warc(spark.createDataFrame(rows, PAGES).repartition(parts), folder, file_bytes=3000))
    key = lambda m: sorted((e["name"], e["sha256"], e["records"]) for e in m)
    assert key(made[0]) == key(made[1])
    assert sum(e["records"] for e in made[0]) == 60 and max(e["bytes"] for e in made[0]) <= 3000


def test_fingerprints_are_homomorphic():
    a, b, c = "one two three", "four five", "six\tseven"
    fp = lambda t: tuple(x[0] for x in fingerprint.fingerprints([t]))
    same = lambda x, y: all(np.array_equal(i, j) for i, j in zip(x, y))
    assert same(fp(f"{a}\n{b}\n{c}"), fp(f"{c}\n{a}\n{b}"))
    assert same(fingerprint.add(fp(f"{a}\n{b}"), fp(c)), fp(f"{a}\n{b}\n{c}"))
    assert same(fingerprint.subtract(fp(f"{a}\n{b}\n{c}"), fp(b)), fp(f"{a}\n{c}"))
    assert not same(fp(f"{a}\n{b}"), fp(f"{a} {b}")) and not same(fp(a), fp(f"{a}\n"))
    assert same(fingerprint.decode(fingerprint.encode(*fingerprint.fingerprints([a]))[0]), fp(a))


def test_edited_fingerprints(spark):
    r = random.Random(8)
    rows = [(i, "\n".join(" ".join(r.choice("abcdefghijkl") * r.randint(1, 3) for _ in range(r.randint(1, 9))) for _ in range(r.randint(1, 30)))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "é" * 400_000), (503, "x"), (503, "w")]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, bucket string")
    got = sorted(fingerprint.edited_fingerprints(docs.repartition(5)).collect(), key=lambda x: (x["doc_id"], x["fingerprint"]))
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda x: (x[0], x[1]))
    expected = []
    for k, (i, t) in enumerate(ordered):
        following, half = ordered[(k + 1) % len(ordered)][1], len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        of = [fingerprint.fingerprints([x]) for x in (t, edited, following)]
        expected.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), fingerprint.encode(*of[0])[0], fingerprint.encode(*of[1])[0],
                         float(fingerprint.likeness(of[0], of[1])[0]), float(fingerprint.likeness(of[0], of[2])[0])))
    assert [tuple(x) for x in got] == sorted(expected, key=lambda x: (x[0], x[3]))
    long = [x for x in got if x["n_chars"] > 200 and x["doc_id"] < 200]
    assert min(x["near_edited"] for x in long) > 0.2 and max(x["near_next"] for x in long) < 0.4
    assert fingerprint.edited_fingerprints(docs.where("false")).collect() == []
    one = fingerprint.edited_fingerprints(docs.where("doc_id = 3")).first()
    assert one["near_next"] == 1.0


def test_likeness_of_scripts_without_spaces_and_of_short_lines():
    line = "".join(chr(0x4E00 + (k * 7919) % 20000) for k in range(300))
    near = line[:100] + "\u4e01\u4e02" + line[102:]
    other = "".join(chr(0x4E00 + (k * 104729) % 20000) for k in range(300))
    words = "\n".join(f"w{k}" for k in range(200))
    of = lambda *t: fingerprint.fingerprints(list(t))
    like = lambda a, b: float(fingerprint.likeness(*[tuple(x[:1] for x in of(t)) for t in (a, b)])[0])
    assert like(line + "\n" + other, near + "\n" + other) > 0.95 and like(line, other) < 0.3
    assert like(words, words.replace("w7\n", "v7\n")) > 0.95 and like("one", "one") == 1.0
    whole, parts = of(line + "\n" + words), [of(line), of(words)]
    total = fingerprint.add(*parts)
    assert (whole[0] == total[0]).all() and (whole[1] == total[1]).all()  # still a sum over paragraphs

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import awkward, awkward_rows, empty

from wordloom.llm import dac, separators, token_files
from wordloom.llm.tokens import Encoder

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

HARD = [
    "",
    " ",
    "  two  blanks   three    ",
    "a\n b\n\n c \n\nd",
    " lead\ttab \t mixed\r\n it's don't we'll 'tis",
    "nb sp thin space \x1c sep \x85 nel　wide",
    "<|endoftext|> ordinary <|endoftext|>",
    "é ü 😀 漢字 ١٢٣ 12 345 #2 ## !!",
    "x" * 5000 + " " * 300 + "y",
]


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_words_give_the_ids_of_whole_texts(reference):
    texts = HARD + [row[1] for row in awkward_rows()]
    for kept in (1 << 24, 600):
        encoder = Encoder(VOCABULARY, kept)
        for _ in range(2):
            got = [np.frombuffer(one, encoder.dtype).tolist() for one in encoder.encode(texts)]
            assert got == [reference(text) for text in texts]


def test_kept_words_are_bounded_in_bytes(reference):
    encoder = Encoder(VOCABULARY, 200_000)
    for number in range(30):
        text = " ".join(f"a{number * 100 + at % 100}x" for at in range(300)) + " " + "q" * 100_000 + str(number)
        assert np.frombuffer(encoder.encode([text])[0], encoder.dtype).tolist() == reference(text)
        held = [len(word) + len(ids) + 180 for part in (encoder._words, encoder._older) for word, ids in part.items()]
        assert sum(held) <= 200_000 + 40_000 and all(len(word) <= 64 for word in encoder._words)


def test_words_joined_for_the_tokenizer(reference):
    """Words that hold white space, blanks at their end, and many at once."""
    texts = ["a " + "\n".join(["b", "c d", "", "e  f"]) + "  ", "x \u00a0 y \u2003z  \t w", "one" + " two\r\n three" * 9000, "é " * 50 + "  end "]
    got = [np.frombuffer(one, np.uint16).tolist() for one in Encoder(VOCABULARY).encode(texts)]
    assert got == [reference(text) for text in texts]


def test_lines_and_marks_between_words_add_nothing_to_what_is_kept(reference):
    """Words that meet over marks and line ends are met once each, not once a pair."""
    words = [chr(97 + one) * 3 + "\u00e9" for one in range(26)]
    texts = ["".join(f" {left}.\n{right}" for left in words for right in words)]
    encoder = Encoder(VOCABULARY)
    got = [np.frombuffer(one, encoder.dtype).tolist() for one in encoder.encode(texts)]
    assert got == [reference(text) for text in texts]
    assert len(encoder._words) == 2 * 26 + 2


@pytest.mark.parametrize("seed", range(4))
def test_texts_of_all_kinds_of_characters(reference, seed):
    """Cuts beside white space, apostrophes and signs, in windows of any size and at the ends of texts."""
    rng = random.Random(seed)
    kinds = list(" '  \n\n\t\r'streved.,!1290abZ") + ["'ll", "'s", "'re", " '", "\u00e9", "\u00d7", "\u00f7", "\u0240", "\u00df", "\u023f"]
    kinds += list("\u00a0\u0085\u00aa\u00b2\u00bf\u2003\u2028\u3000\u1680\u180e\u200b\ufeff\u0301\u044f\u6f22\U0001f600\x1c\x1f\x0b\x0c\x00\x7f\u2014\u2019\u0661\u1ea5")
    for _ in range(150):
        some = rng.sample(kinds, rng.randint(2, len(kinds)))
        texts = ["".join(rng.choices(some, k=rng.randint(0, 40))) for _ in range(20)] + ["", None]
        encoder = Encoder(VOCABULARY, 600) if not _ % 50 else encoder
        encoder._window = rng.choice([1, 7, 40, 1 << 18])
        got = [np.frombuffer(one, encoder.dtype).tolist() for one in encoder.encode(texts)]
        assert got == [reference(text) for text in texts]


def test_no_text_and_empty_texts():
    encoder = Encoder(VOCABULARY)
    assert encoder.encode([]) == [] and encoder.encode([None, ""]) == [b"", b""]


def test_other_kinds_of_vocabulary_are_encoded_whole():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    (got,) = Encoder(path).encode(["Two  Words é"])
    assert np.frombuffer(got, "<u2").tolist() == tokenizer.encode("Two  Words é", add_special_tokens=False).ids


@pytest.mark.parametrize("count", [0, 1, 8, 511, 512, 513, 20_000])
@pytest.mark.parametrize("widths", [None, [8, 8], [3, 5, 7, 2], [16]])
def test_codes_round_trip(count, widths):
    rng = np.random.default_rng(count)
    ids = (rng.integers(0, 1 << 16, count) >> rng.integers(0, 16, count)).astype(np.uint32)
    data = b"front" + dac.encode(ids, widths) + b"after"
    codes = dac.Codes(data, 5)
    assert len(codes) == count and data[codes.end :] == b"after"
    assert (codes.run(0, count) == ids).all()
    for place in rng.integers(0, count, 50) if count else []:
        assert codes[int(place)] == ids[place]
        stop = int(rng.integers(place, count + 1))
        assert (codes.run(int(place), stop) == ids[place:stop]).all()
    with pytest.raises(IndexError):
        codes[count]


def test_codes_of_wide_numbers_and_best_widths():
    ids = np.array([0, 1, 2**31, 2**32 - 1, 77], np.uint32)
    assert (dac.Codes(dac.encode(ids)).run(0, 5) == ids).all()
    skewed = np.array([1] * 10_000 + [60_000] * 10, np.uint32)
    assert len(dac.encode(skewed)) < len(dac.encode(skewed, [16]))
    assert sum(dac.best_widths(skewed)) == 16


def plain_rows(rows, reference):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    out, start = [], 0
    for doc_id, text, *_ in ordered:
        ids = reference(text) + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_read_back(spark, reference, tmp_path):
    docs = awkward(spark, ["start", "n_tokens", "shard", "part"])
    folder = str(tmp_path / "shards")
    shards = token_files.write_tokens(docs, folder, VOCABULARY, shard_tokens=40)
    rows = token_files.read_tokens(spark, folder, shards).orderBy("start").collect()
    wanted = plain_rows(awkward_rows(), reference)
    assert [tuple(row) for row in rows] == wanted
    assert shards.count() > 4
    name = sorted((tmp_path / "shards").glob("*.dac"))[0]
    shard = token_files.Shard(name.read_bytes())
    assert shard.tokens(0).tolist() == [shard.codes[at] for at in range(*shard.span(0))]
    assert not list((tmp_path / "shards").glob("*.tmp"))


def test_token_files_of_an_empty_table(spark):
    assert token_files.token_file_rows(empty(spark), VOCABULARY).collect() == []


MULTI, FREE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), 50256


@pytest.mark.parametrize("block_bytes", [6, 64, 4 << 20])
def test_flat_files_are_counted(spark, tmp_path, block_bytes):
    import base64

    import tiktoken

    with open(MULTI, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [row for row in awkward_rows() if len(row[1] or "") < 1000 or block_bytes > 64]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, file string, place string, at bigint").repartition(3, "doc_id")
    folder = str(tmp_path / "flat")
    written = separators.write_flat(docs, folder, MULTI, FREE)
    counted = separators.count_tokens(spark, folder, written.select("file"), FREE, block_bytes=block_bytes)
    got = counted.join(written, ["file", "place"]).collect()
    assert all(row["closed"] for row in got)
    wanted = sorted((row[0] or 0, len(plain.encode_ordinary(row[1] or "")) + 1) for row in rows)
    assert sorted((row["doc_id"] or 0, row["n_tokens"]) for row in got) == wanted
    for file in {row["file"] for row in got}:
        at = 0
        for row in sorted((r for r in got if r["file"] == file), key=lambda r: r["place"]):
            assert row["start"] == at
            at += row["n_tokens"]


@pytest.mark.parametrize("ids", [[9], [5, 9, 1, 2, 3, 3, 3, 3, 9, 9, 4], [1, 2, 3, 4, 5, 6, 7], [9, 9, 9], [1, 9, 2, 9], []])
@pytest.mark.parametrize("block_bytes", [2, 4, 6, 100])
def test_boundaries_are_stitched(spark, tmp_path, ids, block_bytes):
    np.array(ids, "<u2").tofile(tmp_path / "one.ids")
    names = spark.createDataFrame([("one.ids",)], "file string")
    found = separators.count_tokens(spark, str(tmp_path), names, 9, block_bytes=block_bytes)
    wanted, start = [], 0
    for at, one in enumerate(ids):
        if one == 9:
            wanted.append((len(wanted), start, at + 1 - start, True))
            start = at + 1
    if start < len(ids):
        wanted.append((len(wanted), start, len(ids) - start, False))
    assert sorted(tuple(row)[1:] for row in found.collect()) == wanted


def test_flat_files_of_an_empty_table(spark):
    assert separators.flat_token_rows(empty(spark), MULTI, FREE).collect() == []


@pytest.mark.parametrize("run", [" ", "\t", " \n\u00a0\t", "a"])
def test_very_long_runs_in_flat_files(run):
    encode = separators._text_encoder(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    plain = separators._rank_encoder(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    for before, after in (("", ""), ("word", "next one"), ("x ", "\u001c y"), ("", "!")):
        for count in (999, 1000, 1001, 3000):
            text = before + run * count + after + run * 5 + "end" + run * 2000
            assert encode(text) == plain.encode_ordinary(text)
    ids = encode("start " + run * 2_000_000 + " end")
    assert plain.decode(ids) == "start " + run * 2_000_000 + " end"


def test_letters_with_marks_behind_them_are_not_encoded_again(monkeypatch):
    one = Encoder(VOCABULARY)
    asked = []
    encode_words = one._encode_words
    monkeypatch.setattr(one, "_encode_words", lambda words: asked.extend(words) or encode_words(words))
    texts = ["a straße Über cut"] + ["a straße, Über's\nend cut... cut\u00b2 cut\u0435x Über\u0301 cut_1 \u00d7cut"]
    assert one.encode(texts[:1]) + one.encode(texts[1:]) == one._encode(texts)
    assert sorted(asked[:3]) == ["cut", "straße", "Über"]
    assert not set(asked[3:]) & {"cut", "straße", "Über", "straße,", "Über's\nend", "cut...", "cut_1"}


def test_a_text_with_blanks_in_a_row_does_not_change_how_others_are_cut():
    texts = ["one two", "one  two ", "", "one two.  Three", "two three", " ", "one\n two"] * 3
    one = Encoder(VOCABULARY)
    assert one.encode(texts) == one._encode(texts)

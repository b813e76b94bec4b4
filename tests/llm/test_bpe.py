import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from articlemill.llm import bpe, token_files
from articlemill.llm.queries import tokenizer_path
from tests.llm.frames import by_key, documents, no_documents, odd_documents

PATH = tokenizer_path()
LETTERS = " \n\t  '\"ab Zé1२!<|endoftext|>　\u0085\x1c\U0001f600s'll"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts() -> list[str]:
    draw = random.Random(3)
    texts = ["".join(draw.choice(LETTERS) for _ in range(draw.randint(0, 40))) for _ in range(3000)]
    return [*texts, "", "a" * 3000, "ab" * 2000, " " * 700, "x <|endoftext|> y", "<|endoftext|>" * 3, "don't  we'll\n\n x"]


def test_both_encoders_agree_with_the_library(library):
    v = bpe.vocabulary(PATH)
    for limit in (0, 1000):
        own = bpe.rank_array_encoder(PATH, limit)
        other = token_files.library_encoder(PATH)
        for text in odd_texts():
            expected = library.encode(text, add_special_tokens=False).ids
            assert bpe.unpack(own.pack(text)) == expected, text
            assert bpe.unpack(other.pack(text)) == expected, text
            assert bpe.decode(v, expected) == library.decode(expected, skip_special_tokens=False)


def test_long_words_merge_alike_by_heap_and_by_scan():
    v, draw = bpe.vocabulary(PATH), random.Random(5)
    for _ in range(200):
        word = "".join(draw.choice("aabcthe") for _ in range(draw.randint(2, 200))).encode()
        assert bpe.merge_word(v, word) == bpe.merge_long_word(v, [v.of_byte[b] for b in word])


def test_other_tokenizers_are_refused(tmp_path):
    path = PATH.replace("byte_bpe_50k", "word_bpe_49k")
    with pytest.raises(ValueError):
        bpe.vocabulary(path)


def test_digests_and_round_trip(spark, library):
    import hashlib

    df = odd_documents(spark)
    texts = {r.doc_id: r.text or "" for r in df.collect()}
    found = by_key(bpe.round_trip_digests(df, PATH, with_ids=True))
    for key, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert found[key].n_tokens == len(ids) and found[key].ids == ids
        assert found[key].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found[key].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.round_trip_digests(df, PATH).count() == df.count()
    assert bpe.round_trip_digests(no_documents(spark), PATH).count() == 0


def test_documents_with_clashing_columns(spark):
    df = documents(spark, {1: "some words", 2: None}).withColumnRenamed("lang", "ids")
    encoded = bpe.encode_documents(df, PATH)
    assert encoded.columns.count("ids") == 1
    back = by_key(bpe.decode_documents(encoded.drop("text"), PATH))
    assert back[1].text == "some words" and back[2].text == ""


def expected_files(library, texts):
    start, out = 0, {}
    for key in sorted(texts):
        ids = library.encode(texts[key] or "", add_special_tokens=False).ids + [2]
        out[key] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


def test_token_files(spark, library, tmp_path):
    texts = {k * 7 % 101: t for k, t in enumerate(odd_texts()[:90])} | {200: None}
    folder = token_files.write_token_files(documents(spark, texts), PATH, 2, str(tmp_path / "t"))
    found = {r.key: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_token_files(spark, folder, PATH, 2).collect()}
    assert found == expected_files(library, texts)
    assert not [p for p in (tmp_path / "t").iterdir() if p.name.startswith((".ids", ".offsets")) and p.suffix != ".crc"]
    ids = np.concatenate([np.memmap(p, "<u2") for p in sorted((tmp_path / "t").glob("ids-*.bin")) if p.stat().st_size])
    assert len(ids) == sum(n for _, n, _ in found.values())


def test_folders_without_a_scheme_are_those_of_spark(spark, tmp_path):
    from articlemill.llm.common import qualified

    assert qualified(spark, str(tmp_path / "x")) == f"file:{tmp_path}/x" == qualified(spark, f"file:{tmp_path}/x")
    before = spark.conf.get("spark.hadoop.fs.defaultFS", None)
    spark._jsparkSession.sessionState().conf().setConfString("fs.defaultFS", "viewfs://elsewhere/")
    spark._jsparkSession.sessionState().conf().setConfString("fs.viewfs.mounttable.elsewhere.link./x", f"file://{tmp_path}")
    try:
        assert qualified(spark, "/x/y") == "viewfs://elsewhere/x/y"
    finally:
        spark._jsparkSession.sessionState().conf().unsetConf("fs.defaultFS")
        spark._jsparkSession.sessionState().conf().unsetConf("fs.viewfs.mounttable.elsewhere.link./x")
    assert before is None


def test_token_files_of_odd_rows(spark, tmp_path):
    df = odd_documents(spark)
    folder = token_files.write_token_files(df, PATH, 2, str(tmp_path / "t"))
    found = sorted(token_files.read_token_files(spark, folder, PATH, 2).collect(), key=lambda r: r.start)
    assert [r.key for r in found] == [None, *sorted(r.doc_id for r in df.collect() if r.doc_id is not None)]
    assert [r.start for r in found] == [0, *np.cumsum([r.n_tokens for r in found])[:-1]]
    empty = token_files.write_token_files(no_documents(spark), PATH, 2, str(tmp_path / "e"))
    assert token_files.read_token_files(spark, empty, PATH, 2).count() == 0

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from articlemill.llm import tree_bpe
from articlemill.llm.bpe import unpack
from articlemill.llm.queries import tokenizer_path
from tests.llm.frames import by_key, documents, no_documents, odd_documents

PATH = tokenizer_path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
LETTERS = " \n\t  '\"ab Zé1२!<|endoftext|>　\u0085\x1c\U0001f600s'lltheкак"


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=tree_bpe.read_ranks(PATH), special_tokens={})


def odd_texts() -> list[str]:
    draw = random.Random(11)
    texts = ["".join(draw.choice(LETTERS) for _ in range(draw.randint(0, 50))) for _ in range(3000)]
    letters = "".join(draw.choice("abcdefghijklmnop") for _ in range(20000))
    return [*texts, "", "a" * 3001, "ab" * 5000, " " * 700, "=-" * 999, "的" * 2000, letters, "\n" * 300 + "x", "don't  we'll\n\n x"]


def test_the_library_agrees(library):
    tree = tree_bpe.Tree(tree_bpe.read_ranks(PATH))
    encoder = tree_bpe.worker_encoder(PATH, PATTERN)
    for text in odd_texts():
        expected = library.encode_ordinary(text)
        assert unpack(encoder.pack(text)) == expected, text
        assert tree.decode(expected) == text.encode()


def test_joins_are_associative_and_memos_do_not_matter():
    draw, ranks = random.Random(5), tree_bpe.read_ranks(PATH)
    tree, forgetful = tree_bpe.Tree(ranks), tree_bpe.Tree(ranks, memo=0)
    for _ in range(300):
        part = "".join(draw.choice("aabcthe é") for _ in range(draw.randint(3, 90))).encode()
        i, j = sorted(draw.sample(range(len(part) + 1), 2))
        a, b, c = (tree.reduced(x) for x in (part[:i], part[i:j], part[j:]))
        whole = tree.reduced(part)
        assert tree.join(tree.join(a, b), c) == tree.join(a, tree.join(b, c)) == whole == forgetful.reduced(part)
        assert tree.window([ranks[bytes([x])] for x in part]) == whole
        assert tree.join([], a) == a == tree.join(a, [])


def test_a_toy_vocabulary_where_a_join_changes_everything():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"aaaa": 257, b"ab": 258, b"aab": 259, b"xyz": 260}
    tree = tree_bpe.Tree(ranks)
    for n in range(1, 40):
        assert tree.encode(b"a" * n) == tree.window([97] * n)
        assert tree.encode(b"a" * n + b"b") == tree.window([97] * n + [98])
    # No merge leads to the last token: only a whole match is that token.
    assert tree.encode(b"xyz") == [260] and not tree.is_own(260)
    assert tree.encode(b"xyza") == list(b"xyza")


def test_files_without_all_bytes_are_refused(tmp_path):
    (tmp_path / "few.tiktoken").write_bytes(b"YQ== 0\n")
    with pytest.raises(ValueError):
        tree_bpe.read_ranks(str(tmp_path / "few.tiktoken"))


def test_digests_and_round_trip(spark, library):
    df = odd_documents(spark)
    found = by_key(tree_bpe.round_trip_digests(df, PATH, PATTERN))
    for key, text in {r.doc_id: r.text or "" for r in df.collect()}.items():
        ids = library.encode_ordinary(text)
        assert found[key].n_tokens == len(ids)
        assert found[key].ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert found[key].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert tree_bpe.round_trip_digests(df, PATH, PATTERN).count() == df.count()
    assert tree_bpe.round_trip_digests(no_documents(spark), PATH, PATTERN).count() == 0


def test_documents_with_clashing_columns(spark):
    df = documents(spark, {1: "some words", 2: None, 3: ""}).withColumnRenamed("lang", "ids").withColumnRenamed("source", "decoded")
    back = by_key(tree_bpe.decode_documents(tree_bpe.encode_documents(df, PATH, PATTERN), PATH))
    assert [bytes(back[k].decoded) for k in (1, 2, 3)] == [b"some words", b"", b""]
    other = tree_bpe.encode_documents(df, PATH, r"\S+|\s+")
    assert by_key(tree_bpe.decode_documents(other, PATH))[1].decoded == b"some words"

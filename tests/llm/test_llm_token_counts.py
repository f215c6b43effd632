import random

import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from llm_cases import no_documents, odd_documents
from weirflow.llm.catalog import all_queries
from weirflow.llm.common import as_rows
from weirflow.llm.token_counts import TokenCounter, count_tokens, read_vocabulary


def exact(vocabulary):
    tokenizer = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=False)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def vocabulary():
    return read_vocabulary(None)


def test_equals_the_tokenizer(vocabulary):
    rnd = random.Random(1)
    texts = ["", " ", "  a  b ", "▁x", "日本語テキスト \U0001f600\U0001f600 é", "<s> <0x41>", "a\n\nb\t c", "\x00\x01"]
    texts += ["".join(rnd.choice("abcdeé▁ 日\U0001f600\n<0x41>_.") for _ in range(rnd.randint(1, 60)))
              for _ in range(400)]
    own, want = TokenCounter(vocabulary), exact(vocabulary)
    assert [own.count(t)[0] for t in texts] == [want(t) for t in texts]


def test_runs_of_blanks_match_across_words(vocabulary):
    own, want = TokenCounter(vocabulary), exact(vocabulary)
    for n in range(1, 40):
        for text in ("a" + " " * n + "b", " " * n, " " * n + "word", "word" + " " * n + ".\n" + "▁" * n + "x"):
            assert own.count(text)[0] == want(text), text
    assert own.count("a" + " " * 16 + "b")[0] == 3


def test_pieces_with_an_inner_blank():
    """Texts are not cut where a piece may match across words."""
    pieces = [("<unk>", 0.0), *((f"<0x{b:02X}>", 0.0) for b in range(256)), ("▁", -2.0), ("a", -2.0),
              ("▁a", -3.0), ("a▁b", -4.0), ("▁b", -3.0), ("b", -2.0), ("b▁▁a", -5.0)]
    rnd = random.Random(9)
    own, want = TokenCounter(pieces), exact(pieces)
    for text in ["".join(rnd.choice("ab  ") for _ in range(rnd.randint(1, 25))) for _ in range(300)]:
        assert own.count(text)[0] == want(text), text


def test_ties_take_the_piece_that_starts_first():
    pieces = [("<unk>", 0.0), *((f"<0x{b:02X}>", 0.0) for b in range(256)), ("▁", -1.0), ("a", -1.0),
              ("aa", -2.0), ("aaa", -3.0), ("b", -1.0), ("ab", -2.0), ("aab", -3.0)]
    rnd = random.Random(4)
    own, want = TokenCounter(pieces), exact(pieces)
    for text in ["".join(rnd.choice("ab c") for _ in range(rnd.randint(1, 25))) for _ in range(300)]:
        assert own.count(text)[0] == want(text), text


def test_query(spark, sf, documents, vocabulary):
    want = exact(vocabulary)
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    got = all_queries()["op8_token_counts"](spark, sf).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {i: want(t) for i, t in texts.items()}


def test_odd_documents(spark, vocabulary):
    want = exact(vocabulary)
    rows = count_tokens(as_rows(odd_documents(spark))).collect()
    assert len(rows) == odd_documents(spark).count()
    assert all(r["result"]["n_tokens"] == want(r["row"]["text"]) for r in rows)
    assert count_tokens(as_rows(no_documents(spark))).count() == 0

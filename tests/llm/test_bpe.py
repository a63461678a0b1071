import pytest

from lavra.llm import bpe

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def public():
    t = tokenizers.Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return t


def samples(rng):
    fixed = [None, "", " ", "\n\n  x", "a", "don't we'll I'M it's", "ação 😀 é 日本語 ١٢٣ ²½", "<|endoftext|>", "x" * 700, "ab" * 400, "12345678901234567890", "  　y \x85z", "\r\n\t tail  ", "...!!!???", "naïve café" * 30]
    alphabet = "abc éçãÑ.,;'\n\t 0123_-​ß 日😀"
    return fixed + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 200))) for _ in range(150)]


@pytest.mark.parametrize("ready", [0, 20, 10_000])
def test_ids_equal_the_public_tokenizer(spark, public, rng, ready):
    texts = samples(rng)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    got = {r.doc_id: list(r.ids) for r in bpe.encode(df, ready_words=ready).collect()}
    assert got == {i: public.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts)}


def test_round_trip(spark, rng):
    texts = samples(rng)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(df)).collect()}
    assert back == {i: t or "" for i, t in enumerate(texts)}


def test_empty(spark):
    assert bpe.encode(spark.createDataFrame([], "doc_id long, text string")).count() == 0

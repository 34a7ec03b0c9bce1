"""The faster twin of a tokenizer gives the same ids."""

from stayline.llm import packing, queries


def test_twin_gives_the_same_ids():
    encoder = packing.Encoder(queries.packing_model())
    assert encoder.quick
    texts = ["", "  ", " a", "a ", "a  b\n\n c\t d\r\n", "x <|endoftext|> y", "naïve ☕ 日本語", "don't we'll 123 4567 !!!", "\x00\x1c a\x1fb c", "a\u0085 b​ c"]
    assert encoder.encode(texts) == encoder.slow(texts)

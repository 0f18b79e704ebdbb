import types

import pytest
from pyspark.sql import functions as F

from daystack.config import RunConfig
from daystack.functions import text, tokens
from daystack.plans import pipeline

ODD = [None, "", "one two", "  İstanbul. नमस्ते! ", "word " * 3000, "x" * 9000, "<|endoftext|>", "one two"]


def vocabulary(name):
    found = pytest.importorskip("public_tokenizers")
    return found.path(name)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_tokens(spark, name):
    """Counts are the tokenizer's own; what is cut is a beginning of the text and within the limit."""
    from tokenizers import Tokenizer

    path = vocabulary(name)
    own = Tokenizer.from_file(path)
    rows = spark.createDataFrame(list(enumerate(ODD)), "k int, t string").repartition(3)
    t = F.col("t")
    got = rows.select("k", text.token_count(t, path).alias("n"), text.truncate_tokens(t, 7, path).alias("cut"), text.truncate_tokens(t, 0, path).alias("none"), text.request_tokens(t, 75, path).alias("asked"))
    for r in got.collect():
        whole = ODD[r.k] or ""
        ids = own.encode(whole, add_special_tokens=False)
        assert r.n == len(ids.ids) and r.asked == r.n + 75
        assert whole.startswith(r.cut) and len(own.encode(r.cut, add_special_tokens=False).ids) <= 7
        assert r.cut == whole if r.n <= 7 else len(r.cut) == ids.offsets[6][1]
        assert r.none == ("" if r.n else whole)


def test_tokens_of_an_empty_table(spark):
    path = vocabulary("word_bpe_49k.json")
    assert spark.createDataFrame([], "t string").select(text.token_count(F.col("t"), path)).collect() == []


def test_without_a_tokenizer_the_rule_counts(spark, tmp_path, capsys):
    broken = tmp_path / "broken.json"
    broken.write_text("{}")
    rows = spark.createDataFrame(list(enumerate(ODD)), "k int, t string")
    rule = rows.select("k", text.token_count(F.col("t")), text.truncate_tokens(F.col("t"), 3)).collect()
    assert [r[1] for r in sorted(rule)] == [len(t or "") // 4 for t in ODD]
    for name in (str(tmp_path / "absent.json"), str(broken), "tiktoken:no-such-model"):
        assert rows.select("k", text.token_count(F.col("t"), name), text.truncate_tokens(F.col("t"), 3, name)).collect() == rule
    assert "absent.json" in capsys.readouterr().err


def test_an_encoding_that_refuses_a_text():
    def encode(t):
        if "<|" in t:
            raise ValueError(t)
        return t.split()

    model = tokens._Model.__new__(tokens._Model)
    model.own = types.SimpleNamespace(encode=encode, decode=" ".join)
    assert model.counts(["a b c", "", "<|end|>!"]) == [3, 0, 2]
    assert model.cuts(["a b c", "a b", "<|end|>!"], 2) == ["a b", "a b", "<|end|>!"] and model.cuts(["<|end|>!"], 1) == ["<|en"]


def test_tokens_in_plans(spark):
    """Batches are cut by the tokenizer's counts."""
    path = vocabulary("word_bpe_49k.json")
    articles = spark.createDataFrame([(str(k), k, "w" * 40) for k in range(6)], "article_id string, seq long, content string")
    rule, own = RunConfig(max_tokens_per_batch=250), RunConfig(max_tokens_per_batch=250, tokenizer=path)
    n = {}
    for config in (rule, own):
        asked = text.request_tokens(text.extract_prompt(F.col("content"), config.max_tokens_per_request, config.tokenizer), config.request_overhead_tokens, config.tokenizer)
        each = articles.select(asked.alias("n")).first().n
        fit = 250 // each
        n[config.tokenizer] = each
        assert pipeline.batches(articles, config).select("batch_id").distinct().count() == -(-6 // fit)
    assert n[""] != n[path]

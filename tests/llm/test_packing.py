import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sieveline.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def texts():
    rng = random.Random(6)
    odd = ["it's", "'S", "don't", "a|b", "|", "||", "x y", "é", "́x", "Å", "K", "ΑΣ", "ς", "1234", "...", "!?|", "\x1c", "a\x1fb", "\x85q", "İ", "<|endoftext|>", "<|start", "oftext|>", "日本", "🙂🙂", "ﬁ", " z", "don'tt're", "word,", "​", "가"]
    mixed = ["".join(rng.choice(odd) + rng.choice([" ", "", "\n", "\t", "  "]) for _ in range(rng.randint(1, 60))) for _ in range(200)]
    return [*mixed, "the end " * 3000, "z" * 20_000, "", None, " \n"]


def test_chunks_give_the_tokenizers_own_ids():
    model, own = Tokenizer.from_file(PATH), texts()
    got = packing.encoder(PATH)(own)
    for t, g in zip(own, got, strict=True):
        assert np.frombuffer(g, "<u4").tolist() == model.encode(t or "", add_special_tokens=False).ids
    assert packing.encoder(PATH, by_chunk=False)(own) == got


def test_added_tokens_and_composition_come_before_lower_case():
    odd = ["<|ENDOFTEXT|>", "<|EndOfText|>", "H\u0331", "T\u0308", "W\u030a", "J\u030c", "Y\u030a", "É", "\u212a"]
    own = [t for o in odd for t in (o, o.lower(), f"The {o}. End", f"A{o}B, x{o.lower()}y", f"{o} <|endoftext|> {o}")]
    model, encode = Tokenizer.from_file(PATH), packing.encoder(PATH)
    for t, g in zip(own * 2, encode(own) + encode(own), strict=True):
        assert np.frombuffer(g, "<u4").tolist() == model.encode(t, add_special_tokens=False).ids


def test_stops_that_stay_on_their_words(tmp_path):
    from tokenizers import models, normalizers, pre_tokenizers

    letters = sorted(set("helo wrd.ten,!|"))
    merges = [("e", "n"), ("en", "d"), ("end", "."), ("d", "."), ("o", ","), ("l", "l"), (".", ".")]
    vocab = {t: i for i, t in enumerate([*letters, *(a + b for a, b in merges)])}
    path = str(tmp_path / "t.json")
    for cut, apart in ((pre_tokenizers.WhitespaceSplit(), False), (pre_tokenizers.Whitespace(), True)):
        model = Tokenizer(models.BPE(vocab, merges))
        model.normalizer, model.pre_tokenizer = normalizers.Lowercase(), cut
        model.save(path)
        packing._LOADED.clear()
        assert packing.splits_at_blanks(path) and packing.cuts_before_stops(path) is apart
        own = ["hello world. the end. ...", "The end.. hello, end", "end. end."]
        for t, g in zip(own * 2, packing.encoder(path)(own) + packing.encoder(path)(own), strict=True):
            assert np.frombuffer(g, "<u4").tolist() == model.encode(t, add_special_tokens=False).ids
    packing._LOADED.clear()
    assert packing.cuts_before_stops(PATH)


def test_forgetting_changes_nothing(monkeypatch):
    want = packing.encoder(PATH)(texts())
    monkeypatch.setattr(packing, "MEMORY_BYTES", 5000)
    packing._LOADED.clear()
    assert packing.encoder(PATH)(texts()) == want
    packing._LOADED.clear()


def test_pieces_are_whole_and_unpadded(spark):
    docs = list(enumerate(texts())) + [(0, "again"), (None, "no id")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).select("*", F.lit(1).alias("ids"), F.lit(2).alias("length"))
    rows = packing.pack(df, PATH, max_tokens=64).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert all(r.offset == 0 and r.length == 2**r.bucket <= 64 and len(r["ids"]) == 4 * r.length for r in rows)
    model = Tokenizer.from_file(PATH)
    for i, t in docs[1:205]:
        mine = sorted((r.start, r["ids"]) for r in rows if r.doc_id == i)
        joined = np.frombuffer(b"".join(x for _, x in mine), "<u4").tolist()
        assert joined == model.encode(t or "", add_special_tokens=False).ids + [1]
        assert [s for s, _ in mine] == np.cumsum([0] + [len(x) // 4 for _, x in mine])[:-1].tolist()
    assert sum(r.doc_id is None for r in rows) >= 1


def test_lengths_and_limits(spark):
    assert packing.piece_lengths(2048 * 2 + 13) == [2048, 2048, 8, 4, 1]
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
    with pytest.raises(ValueError):
        packing.pack(spark.range(1).select(F.col("id").alias("doc_id"), F.lit("").alias("text")), PATH, max_tokens=1000)


def test_whether_blanks_split_is_read_from_the_file():
    assert packing.splits_at_blanks(PATH) and not packing.splits_at_blanks(public_tokenizers.path("byte_bpe_50k.json"))
    other = public_tokenizers.path("byte_bpe_50k.json")
    model, own = Tokenizer.from_file(other), ["a b", " a  b\n", "x\n\n y", None]
    for t, g in zip(own, packing.encoder(other)(own), strict=True):
        assert np.frombuffer(g, "<u4").tolist() == model.encode(t or "", add_special_tokens=False).ids
    with pytest.raises(ValueError):
        packing.encoder(other, by_chunk=True)([" ".join(f"w{i}|{i}" for i in range(9)) + " a b c d"])


def test_long_chunks_are_not_kept():
    packing._LOADED.clear()
    encode = packing.encoder(PATH)
    long = ["ab" * 500_000, "x" * 65, "short"]
    encode(long)
    held = next(c.cell_contents for c, n in zip(encode.__closure__, encode.__code__.co_freevars, strict=True) if n == "known")
    assert b"short" in held and max(map(len, held)) <= packing.LONG
    packing._LOADED.clear()

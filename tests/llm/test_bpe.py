"""Byte-level BPE against tiktoken."""

import base64
import random
from array import array

import pytest
from pyspark.sql import functions as F

from siftworks.llm import byte_bpe

tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
rng = random.Random(11)
FILES = ("byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken")


def encoding(raw):
    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(raw), special_tokens={})


def ids(raw):
    return array("i", raw).tolist()


def texts():
    letters = "aaabcdeéßñ漢字かな한국어абвع  \n\t'019!?<|>—🙂́‍  \x1c\x85\0"
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    out += [x * n for x in ("a", "ab", "aab", " ", "\n", "é", "漢", "=", "-_", "🙂", "1") for n in (1, 2, 3, 7, 33, 500, 4001)]
    out += ["", "<|endoftext|>", "it's we'll I'M", "word " * 50, "".join(chr(c) for c in range(0x21, 0x3000)), "x" + "y" * 30_000 + "z", "".join(rng.choice("ab") for _ in range(20_000)), "".join(rng.choice("thequickbrownfox") for _ in range(20_000))]
    return out


@pytest.mark.parametrize("name", FILES)
def test_ids_are_tiktokens(name):
    raw = byte_bpe.ranks_at(tokenizers.path(name))
    own, theirs = byte_bpe.Vocabulary(raw, tokenizers.PATTERN), encoding(raw)
    for text in texts():
        assert ids(own.encode(text)) == theirs.encode_ordinary(text), text[:80]


@pytest.mark.parametrize("name", FILES)
def test_pieces_without_a_pattern(name):
    """Every token's bytes, and neighbours of tokens, as one match: those that merging doesn't give come out whole or in parts."""
    raw = byte_bpe.ranks_at(tokenizers.path(name))
    everything = r"[\s\S]+"
    own = byte_bpe.Vocabulary(raw, everything)
    theirs = tiktoken.Encoding("all", pat_str=everything, mergeable_ranks=byte_bpe.read_ranks(raw), special_tokens={})
    tokens = [t.decode("latin-1") for t in byte_bpe.read_ranks(raw)]
    readable = [t for t in (x.encode("latin-1").decode("utf-8", "ignore") for x in tokens) if t]
    pieces = readable + ["".join(rng.sample(readable, rng.randint(2, 5))) for _ in range(20_000)]
    for piece in pieces:
        assert ids(own.encode(piece)) == theirs.encode_ordinary(piece), piece


def test_ranks_that_merging_cannot_reach(tmp_path):
    """A vocabulary made up so that longest tokens mislead: steps back are needed, and a token that no merge gives is only found whole."""
    tokens = [bytes([b]) for b in range(256)] + [b"bc", b"ab", b"abc", b"cd", b"bcd", b"abcde", b"aa", b"aaaa", b"de", b"xyz"]
    raw = b"\n".join(base64.b64encode(t) + b" " + str(i).encode() for i, t in enumerate(tokens))
    own = byte_bpe.Vocabulary(raw, r"[\s\S]+")
    theirs = tiktoken.Encoding("small", pat_str=r"[\s\S]+", mergeable_ranks=byte_bpe.read_ranks(raw), special_tokens={})
    for n in range(1, 2000):
        text = "".join(rng.choice("abcdexyz") for _ in range(1 + n % 14))
        assert ids(own.encode(text)) == theirs.encode_ordinary(text), text
    assert len(ids(own.encode("xyz"))) == 1 and len(ids(own.encode("xyzx"))) == 4
    with pytest.raises(ValueError, match="lacks"):
        byte_bpe.Vocabulary(b"YQ== 0", "a")


def test_memories_that_are_full(monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 3)
    raw = byte_bpe.ranks_at(tokenizers.path(FILES[0]))
    own, theirs = byte_bpe.Vocabulary(raw, tokenizers.PATTERN), encoding(raw)
    text = " ".join(texts()[:80])
    assert ids(own.encode(text)) == theirs.encode_ordinary(text) and max(len(own.pieces), len(own.pieces.before), len(own.pairs)) <= 3


def test_tables(spark):
    path = tokenizers.path(FILES[0])
    theirs = encoding(byte_bpe.ranks_at(path))
    rows = [(i, t) for i, t in enumerate([*texts()[:60], None, "", "again", "again", "word " * 60_000])] + [(None, "no id"), (3, "three")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit("x"), "decoded": F.lit("x"), "__text": F.lit("x")}).repartition(3)
    got = byte_bpe.decode(byte_bpe.encode(df, path, tokenizers.PATTERN), path).collect()
    assert sorted(((r["doc_id"], r["text"], list(r["ids"])) for r in got), key=repr) == sorted(((i, t, theirs.encode_ordinary(t or "")) for i, t in rows), key=repr)
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in got)
    kept = byte_bpe.encode(df, path, tokenizers.PATTERN, keep=("doc_id",))
    assert kept.columns == ["doc_id", "ids"] and kept.count() == len(rows)
    assert byte_bpe.encode(df.limit(0), path, tokenizers.PATTERN).count() == 0
    bad = spark.createDataFrame([([70000, None],), (None,), ([],)], "ids array<int>")
    assert sorted(bytes(r["decoded"]) for r in byte_bpe.decode(bad, path).collect()) == [b"", b"", "��".encode()]
    broken = spark.sql("select cast(x'61ff62' as string) as text")
    assert bytes(byte_bpe.decode(byte_bpe.encode(broken, path, tokenizers.PATTERN, keep=()), path).first()["decoded"]).decode() == "a�b"


def test_query_against_tiktoken(spark):
    import hashlib
    import os

    from siftworks.llm import queries

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("the driver's tables are not here")
    theirs, want = encoding(byte_bpe.ranks_at(tokenizers.path(FILES[0]))), []
    sha = lambda x: hashlib.sha256(x).hexdigest()
    for i, t in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        found = theirs.encode_ordinary(t or "")
        want.append((i, len(found), sha(",".join(map(str, found)).encode()), sha((t or "").encode())))
    got = queries.op12_byte_bpe(spark, sf).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)

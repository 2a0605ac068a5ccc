"""Byte-level BPE: against the tiktoken library on whole texts, and the joins of the tree against flat merging."""

import hashlib
import random

import pytest
import tiktoken
from pyspark.sql import functions as F

from ledgerlake.llm import bytebpe

from . import helpers as h

ALPHABETS = ("a", "ab", "abc", "aeinrst", "éèaü", "日本語の", "АБВгде", "=-_", "0123456789", " ", " \n\t　", "'st", "😀🙂a", "\x1c\x85​ ", "ퟻ՘\U0001fbf0a1")


@pytest.fixture(scope="module")
def ranks():
    return bytebpe.read_ranks(bytebpe.default_ranks())


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("library", pat_str=bytebpe.default_pattern(), mergeable_ranks=ranks, special_tokens={})


def some_texts(n=300, seed=2):
    rng = random.Random(seed)
    say = lambda: "".join(rng.choice(rng.choice(ALPHABETS)) for _ in range(rng.randint(0, 30)))
    texts = ["".join(rng.choice(a) for _ in range(rng.choice((1, 2, 33, 65, 200, 700)))) for a in ALPHABETS for _ in range(8)]
    return texts + [say() for _ in range(n)]


def test_texts_equal_the_library(spark, library):
    long_ones = ["a" * 70_000, "ab" * 40_000 + " ", "xyzzy " * 50_000, "".join(random.Random(1).choices("aeinrstlo", k=90_000)), " " * 70_000]
    texts = [None, "", "Hello World", "Hello World", "<|endoftext|>", *some_texts(), *long_ones]
    docs = h.frame(spark, [(i, t, None, None, 0) for i, t in enumerate(texts)] + [(None, "no id", None, None, 0)])
    found = {r.doc_id: r for r in bytebpe.decode(bytebpe.encode(docs)).collect()}
    assert len(found) == len(texts) + 1
    for i, t in enumerate(texts):
        assert found[i].ids == library.encode_ordinary(t or ""), t
        assert bytes(found[i].decoded).decode() == (t or "")
    assert found[None].ids == library.encode_ordinary("no id")


def test_query_gives_digests(spark, library, tmp_path):
    texts = [None, "", "one two", "Zwölf Boxkämpfer jagen Viktor", "one two"]
    path = h.folder(spark, tmp_path / "t", [(i, t, None, None, 0) for i, t in enumerate(texts)])
    found = bytebpe.op12_byte_bpe(spark, path)
    assert found.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    wanted = []
    for i, t in enumerate(texts):
        ids = library.encode_ordinary(t or "")
        wanted.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    h.same_rows(found, found.columns, wanted)


def test_all_documents_of_a_folder(spark, library):
    path = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in bytebpe.documents(spark, path).collect()}
    found = bytebpe.op12_byte_bpe(spark, path).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode_ordinary(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_tree_equals_flat_merging(ranks):
    coder, rng = bytebpe.Coder(ranks), random.Random(7)
    for _ in range(300):
        data = "".join(rng.choices(rng.choice(ALPHABETS), k=rng.choice((1, 31, 32, 33, 64, 150, 1000)))).encode()
        flat = coder._many(data)
        assert coder.tree(data) == flat and b"".join(flat) == data
        if len(data) < 200:
            assert coder._few(data) == flat


def test_join_is_a_monoid(ranks):
    """Wherever a text is cut, and however its parts are bracketed, the encoding is the same; no bytes are its unit."""
    coder, rng = bytebpe.Coder(ranks), random.Random(8)
    for _ in range(200):
        data = "".join(rng.choices(rng.choice(ALPHABETS), k=60)).encode()
        a, b = sorted((rng.randint(1, len(data) - 1), rng.randint(1, len(data) - 1)))
        if a == b:
            continue
        x, y, z = (coder.tree(part) for part in (data[:a], data[a:b], data[b:]))
        assert coder.joined(coder.joined(x, y), z) == coder.joined(x, coder.joined(y, z)) == coder.tree(data)


def test_window_stays_small_on_ordinary_text(ranks, monkeypatch):
    coder, sizes = bytebpe.Coder(ranks), []
    merged = coder.merged
    monkeypatch.setattr(coder, "merged", lambda data: sizes.append(len(data)) or merged(data))
    left, right = coder.tree(b"internationalization" * 400), coder.tree(b"counterrevolutionary" * 400)
    sizes.clear()
    coder.joined(left, right)
    assert max(sizes) < 100


def test_other_ranks_and_pattern(spark, tmp_path):
    """Ranks with gaps, a token that no merge makes, and another pattern."""
    import base64

    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 300, b"bc": 290, b"abcd": 400, b"cd": 310, b"abab": 500}
    place = tmp_path / "own.tiktoken"
    place.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items()))
    pattern = r"\p{L}+|[^\p{L}]"
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    texts = ["abcd", "xabcd", "abababab", "bcbcab cd", "ab" * 100 + "abcd", "é1 ab"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r for r in bytebpe.decode(bytebpe.encode(docs, str(place), pattern), str(place)).collect()}
    for i, t in enumerate(texts):
        assert found[i].ids == library.encode_ordinary(t)
        assert bytes(found[i].decoded) == t.encode()


def test_decoding_is_a_tree_too(spark, ranks, monkeypatch):
    monkeypatch.setattr(bytebpe, "LEAF_TOKENS", 3)
    by_id = {r: t for t, r in ranks.items()}
    ids = list(range(1000, 1050))
    rows = spark.createDataFrame([(1, ids), (2, []), (3, None), (4, ids[:1])], "doc_id bigint, ids array<int>").withColumn("decoded", F.lit(1))
    found = {r.doc_id: bytes(r.decoded) for r in bytebpe.decode(rows).collect()}
    assert found == {1: b"".join(by_id[i] for i in ids), 2: b"", 3: b"", 4: by_id[1000]}


def test_memory_is_bounded(ranks, monkeypatch):
    monkeypatch.setattr(bytebpe, "REMEMBERED", 10)
    coder = bytebpe.Coder(ranks)
    assert [coder.of_match[f"w{i}"] for i in range(50)] == [coder.encode(f"w{i}") for i in range(50)]
    assert len(coder.of_match) <= 10
    coder.of_match["z" * 65]
    assert "z" * 65 not in coder.of_match

import hashlib
import random
import struct

import public_tokenizers
import pytest
from helpers import corpus, docs_frame
from tokenizers import Tokenizer

from quillspark.llm import bpe_trie

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return struct.pack(f"<{len(ids)}I", *ids), library.decode(ids, skip_special_tokens=False)


def test_same_ids_and_text_as_the_library(library):
    rnd = random.Random(3)
    letters = "abcdeßéàñ's !<|>ΣσIİ́ \x1c\x00\t\r\n日本語1٣🙂ǅ"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(2000)]
    texts += ["".join(rnd.choice("aeothn") for _ in range(rnd.randint(1, 300))) for _ in range(300)]
    texts += ["a" * k for k in range(1, 80)] + ["!" * k for k in range(1, 80)] + ["the<|endoftext|>cat", "<|startoftext|>", "<|STARTOFTEXT|> x", None, ""]
    vocabulary = [t.replace("</w>", "") for t in library.get_vocab()]
    texts += ["".join(rnd.sample(vocabulary, 3)) for _ in range(2000)]
    encoder = bpe_trie.TrieBpe(PATH)
    for _ in range(2):  # fresh, then remembered
        assert encoder.encode_texts(texts) == [expected(library, t) for t in texts]


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe_trie, "REMEMBER", 5)
    encoder = bpe_trie.TrieBpe(PATH)
    for t in [t for _, t, *_ in corpus() if t is None or len(t) < 5000]:
        assert encoder.encode_texts([t]) == [expected(library, t)]


def test_query_columns(spark, library):
    rows = corpus()
    got = bpe_trie.digests(bpe_trie.encode(docs_frame(spark, rows), PATH)).collect()
    want = []
    for i, t, *_ in rows:
        ids, text = expected(library, t)
        want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert bpe_trie.encode(docs_frame(spark, []), PATH).collect() == []


def test_latin_chunks_are_cut_as_the_library_cuts_them():
    import random

    e = bpe_trie.TrieBpe(public_tokenizers.path("word_bpe_49k.json"))
    rnd = random.Random(3)
    signs = [chr(c) for c in range(33, 256) if chr(c).isprintable()] + ["'s", "'LL", "ſ", "İ", "é", "­", " "]
    for _ in range(20_000):
        c = "".join(rnd.choice(signs) for _ in range(rnd.randint(1, 9)))
        assert e.pieces_plain(c) == [w for w, _ in e.library.pre_tokenizer.pre_tokenize_str(e.library.normalizer.normalize_str(c))], c

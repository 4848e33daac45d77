import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from brute import sha
from tokenizers import Tokenizer

from mercata.config import scratch_path
from mercata.llm import registry
from mercata.llm.packed_ids import PieceEncoder, pack, read_digests, read_ids, unpack, width_of, write_packed
from mercata.llm.space_runs import space_runs
from mercata.llm.token_counts import token_counts
from mercata.llm.trie_bpe import TrieEncoder, encode_decode

BYTES, WORDS = "byte_bpe_50k.json", "word_bpe_49k.json"
PARTS = ["a", "B", "é", "É", "ß", "İ", "Σ", "σ", "́", "'s", "'S", "'ll", " ", "  ", "\n", "\t", "\xa0", " ", "\x1c", "\x85", "1", "23", "²",
         "½", "<|endoftext|>", "<|startoftext|>", "<|", "!", "?!", "...", "中文", "한", "😀", "don't", "the", "ing", "ª", "_", "-", "\x00", "​"]


def library(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def mixed(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, 14))) for _ in range(n)]


def test_runs_are_encoded_as_the_whole_text():
    lib = library(BYTES)
    enc = PieceEncoder(public_tokenizers.path(BYTES))
    texts = mixed(3000, 1)
    for t, ids in zip(texts, enc.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, t
    assert space_runs("a b") == ["a", "b"]


def test_words_go_to_the_library_once_and_many_at_once():
    """Letters with different signs behind them are one word to the library; odd runs are still its own ids."""
    lib = library(BYTES)
    enc = PieceEncoder(public_tokenizers.path(BYTES))
    asked = []

    class Asked:
        def encode_batch_fast(self, texts, add_special_tokens):
            asked.extend(texts)
            return lib.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    enc.lib = Asked()
    words = [f"{a}{b}{c}" for a in "bdfgklmn" for b in "aeioué" for c in ("r", "st", "ÿx")]
    texts = ["x " + " ".join(w + s for w in words for s in ("", ",", ".", "'", "...", "!?", "&&&", "|>")),
             "y it's it' s 's' a'b foo<|endoftext|> <|endoftext|>, <|endoftext|> a\nb a.\nB, c\n d  e \x1c f\x1c 1, 2.5 x٣ ½, \u0301a µ, ×, ª.", "", " ", " a"]
    got = enc.encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [lib.encode(t, add_special_tokens=False).ids for t in texts]
    assert sum(t.count(" bar") for t in asked) == 1 and len(asked) < 60
    assert enc.encode(texts) == got  # from memory


def test_trie_equals_the_library():
    lib = library(WORDS)
    enc = TrieEncoder(public_tokenizers.path(WORDS))
    texts = mixed(3000, 2)
    for t, ids in zip(texts, enc.encode(texts), strict=True):
        assert ids == lib.encode(t, add_special_tokens=False).ids, t
        assert enc.decode(ids) == lib.decode(ids, skip_special_tokens=False)
    r = random.Random(3)
    tokens = sorted(t for t in enc.tokens if enc._merged([*t]) == [t])
    middle = [t for t in tokens if ord(t[-1]) < 0x400]
    for _ in range(3000):
        a, b = r.choice(middle), r.choice(tokens)
        assert enc._apart(a, b) == (enc._merged([*a, *b]) == [a, b])


def test_counts_query(spark, sf, rows):
    lib = library(BYTES)
    got = {r.doc_id: r for r in registry.op3_token_counts(spark, sf).collect()}
    assert len(got) == len(rows)
    for d, t in rows:
        n = len(lib.encode(t or "", add_special_tokens=False).ids)
        assert (got[d].n_bytes, got[d].n_tokens, got[d].over_limit) == (len((t or "").encode()), n, n > 512)


def test_trie_query(spark, sf, rows):
    lib = library(WORDS)
    got = {r.doc_id: r for r in registry.op8_trie_bpe(spark, sf).collect()}
    assert len(got) == len(rows)
    for d, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        assert (got[d].n_tokens, got[d].ids_sha256, got[d].decoded_sha256) == (
            len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids, skip_special_tokens=False)))


def test_packed_query(spark, sf, rows):
    lib = library(BYTES)
    got = {r.doc_id: r for r in registry.op10_packed_ids(spark, sf).collect()}
    at = 0
    for d, t in sorted(rows):
        ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 20, 31, 32])
def test_packing_round_trip_and_random_access(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001, dtype=np.uint64).astype(np.uint32)
    blob = pack(ids, bits)
    assert len(blob) == -(-1001 * bits // 8)
    assert (unpack(blob, bits, 0, 1001) == ids).all()
    for a, n in ((0, 0), (1000, 1), (17, 300), (500, 501)):
        assert (unpack(blob, bits, a, n) == ids[a:a + n]).all()
    assert width_of(50_257) == 16 and width_of(65_537) == 17 and width_of(1) == 1


def test_odd_rows(spark, odd, odd_rows):
    b, w = library(BYTES), library(WORDS)
    counts = Counter((d, len((t or "").encode()), len(b.encode(t or "", add_special_tokens=False).ids)) for d, t in odd_rows)
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts(odd).collect()) == counts
    words = Counter()
    for d, t in odd_rows:
        ids = w.encode(t or "", add_special_tokens=False).ids
        words[d, tuple(ids), w.decode(ids, skip_special_tokens=False)] += 1
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in encode_decode(odd).collect()) == words
    path = scratch_path(spark, "t")
    write_packed(odd, path, end_id=7, block_ids=64)
    whole = Counter((d, (*b.encode(t or "", add_special_tokens=False).ids, 7)) for d, t in odd_rows)
    assert Counter((r.doc_id, tuple(r.ids)) for r in read_ids(spark, path).collect()) == whole
    digests = sorted(read_digests(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in digests] == sorted((d for d, _ in odd_rows), key=lambda d: (d is not None, d))
    assert sum(r.n_tokens for r in digests) == sum(len(k[1]) * n for k, n in whole.items())


def test_empty_table(spark, nothing):
    assert token_counts(nothing).collect() == [] and encode_decode(nothing).collect() == []
    path = scratch_path(spark, "t")
    write_packed(nothing, path)
    assert read_digests(spark, path).collect() == [] and read_ids(spark, path).collect() == []


def test_words_of_any_script_go_through_the_trie():
    """The library only normalises and cuts: its encoder is never asked."""
    path = public_tokenizers.path(WORDS)
    own, plain = TrieEncoder(path), library(WORDS)
    letters = "Привет мир ΣΑΣ 中文字 한글 İstanbul don’t “quoted”—dash a\u2003b x\x1cz ﬁne é中 123٣ \u200b 😀!a \u3000 e\u0301 \u00a0x"
    r = random.Random(3)
    texts = [letters] + ["".join(r.choices(letters, k=r.randint(1, 40))) for _ in range(500)]

    class Cutter:
        normalizer, pre_tokenizer = plain.normalizer, plain.pre_tokenizer

    own.lib = Cutter()
    assert own.encode(texts) == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


def test_a_finished_bpe_task_gives_its_memories_back():
    """The Python worker stays for the next stage: no words and merge paths are kept, and collections run again."""
    import gc

    import pyarrow as pa

    from mercata.llm import trie_bpe

    def batch(texts):
        return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=[trie_bpe._DOC, trie_bpe._TEXT])

    texts = [f"word{i} Another{i * 7} <|endoftext|>" for i in range(300)] + [None, ""]
    enc = trie_bpe._encoder("word_bpe_49k.json")
    for _ in range(2):  # what was given up is made anew
        got = pa.Table.from_batches(trie_bpe._encoded(iter([batch(texts)]), "word_bpe_49k.json", False))
        assert got["ids"].to_pylist() == [enc.lib.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert len(enc.words) == len(enc.special)
        assert not any(enc.edges) and gc.isenabled()
        enc.end_task()


def test_a_task_of_another_operator_gives_up_what_a_worker_holds():
    """A vocabulary stays from task to task of its own operator only."""
    import pyarrow as pa

    from mercata.llm import common, toxicity, trie_bpe

    def batch(*names):
        return iter([pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["some words"])], names=names)])

    common.drop_held()
    list(trie_bpe._encoded(batch(trie_bpe._DOC, trie_bpe._TEXT), WORDS, True))
    first = trie_bpe._encoder(WORDS)
    list(trie_bpe._encoded(batch(trie_bpe._DOC, trie_bpe._TEXT), WORDS, True))
    assert trie_bpe._encoder(WORDS) is first and len(common._HELD) == 1
    model = toxicity.Model(np.zeros(0, np.int64), np.zeros(0, np.float32), -5.0)
    list(toxicity._scores(model, pa.array(["some words"])))
    assert not common._HELD and trie_bpe._encoder(WORDS) is not first


def test_lines_and_spaces_are_cut_alike_and_no_run_becomes_a_string_of_its_own(monkeypatch):
    """A word behind a line feed is its own word, not one with the word before; every odd piece gets the library's ids."""
    from mercata.llm import packed_ids

    lib = library(BYTES)
    enc = PieceEncoder(public_tokenizers.path(BYTES))
    asked = []

    class Asked:
        def encode_batch_fast(self, texts, add_special_tokens):
            asked.extend(texts)
            return lib.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    enc.lib = Asked()
    heads = ["bar", "été", "foo"]
    words = [f"{a}{b}" for a in "bdfgklmn" for b in ("ol", "ém", "ast")]
    texts = ["\n".join([h, *(f"{w}.\n{v}" for w in words for v in words)]) for h in heads]
    assert [np.frombuffer(g, "<u4").tolist() for g in enc.encode(texts)] == [lib.encode(t, add_special_tokens=False).ids for t in texts]
    assert sum(len(t) for t in asked) < 1000 and len(enc.memo) <= 2 * len(words)  # not a pair at a time
    r = random.Random(9)
    parts = ["a", "B.", "\n", "\n", " ", " ", "\n\n", " \n", "\n ", "\t", "\r\n", "\x85", "　", "\x1c", "\xa0", "é", "İ", "'s", "x'", "1", "½", "!?", "<|endoftext|>", "\x00", "中"]
    texts = ["".join(r.choices(parts, k=r.randint(0, 12))) for _ in range(6000)] + ["", "\n", " ", "\n\n", "a\n", "\na", "a\n\tb", "a \nb", "a\n b", "a.\nB!\n"]
    wanted = [lib.encode(t, add_special_tokens=False).ids for t in texts]
    for most in (packed_ids.MEMO_ENTRIES, 10):  # and with a memory that starts anew
        monkeypatch.setattr(packed_ids, "MEMO_ENTRIES", most)
        for a in range(0, len(texts), 1000):
            for t, ids, want in zip(texts[a:a + 1000], enc.encode(texts[a:a + 1000]), wanted[a:a + 1000], strict=True):
                assert np.frombuffer(ids, "<u4").tolist() == want, t

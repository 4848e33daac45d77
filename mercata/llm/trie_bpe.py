"""BPE encoding over a trie of distinct words, and decoding back to text.

For BPE the tokens of a word's prefix are fixed by one fact per prefix: its last token.  Token
``t`` is the last token of prefix ``p`` if ``p`` ends in ``t`` and either ``t`` is all of ``p``, or
the last token ``u`` of what stands before keeps apart from ``t`` (merging ``u + t`` by the rules
gives ``[u, t]``); exactly one token fits.  So a task puts its distinct new words into a trie and
walks it depth first, carrying the last token of every prefix on the path: shared prefixes are
computed once, and a word's tokens are read backwards from its end.  Sorted words are that trie in
depth-first order; the length of the prefix shared with the word before says how far to go back.

The candidates of a prefix are the vocabulary tokens it ends in, from an automaton over vocabulary
prefixes that is filled as it is used.

The vocabulary file's pipeline (NFC, white space, lower case, word pattern, bytes, word ends) is
followed for words of Latin letters, digits and ASCII signs; any other word, cut at ASCII white
space, where that pipeline never joins, is normalised and cut into pieces by the library, and its
pieces go into the trie like all others.  Memory is bounded: word and
pair memories start anew beyond a fixed number of entries, which changes no result, and a task's
words and merge paths go at its end, as its Python worker stays for whatever stage comes next; the
vocabulary goes when a task of another operator begins there.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercata.llm.common import held, pieces, release_memory, tokenizer_path

WORD_MEMO = 250_000  # some 50 MB
PAIR_MEMO = 1_000_000
PIECE = 1 << 20  # bytes of text whose words, ids and tokens a task holds at once
_END = "</w>"
_MARK = 0x400  # added to the last symbol of a word, which is a symbol of its own in the vocabulary
_DOC, _TEXT = "__llm_doc", "__llm_text"

# Characters that Python's str.split() or the tokenizer's pattern may treat as white space, beyond ASCII's six
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_ASCII_RUNS = re.compile(r"[^ \t\n\r\x0b\x0c]+")
_ASCII_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
_LATIN = re.compile("[\x00-\u024f]+")


def _byte_symbols() -> dict[int, str]:
    """Byte -> printable symbol, the usual byte-level alphabet (printable bytes stand for themselves)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class TrieEncoder:
    """Tokens of words of one vocabulary with word ends."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {(self._marked(a), self._marked(b)): i for i, (a, b) in reversed([*enumerate(merges)])}
        self.ids = {self._marked(t): i for t, i in model["vocab"].items()}
        self.shown = {i: t for t, i in model["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        products = {a + b: (a, b) for a, b in self.rank}
        made = {a + b: r for (a, b), r in self.rank.items()}
        # one rule per product, made of products of earlier rules, as in any trained vocabulary:
        # then merges inside a token happen in the order of their ranks
        self.in_order = len(products) == len(self.rank) and all(max(made.get(a, -1), made.get(b, -1)) < r for (a, b), r in self.rank.items())
        self.products = products
        self.tokens = {t for t in self.ids if len(t) == 1 or t in products}
        self.prefixes = {t[:i] for t in self.tokens for i in range(len(t) + 1)}
        self.table = _byte_symbols()
        self.number = [str(i) for i in range(max(self.shown, default=0) + 1)]
        self.latin_word = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        self.end_task()
        self._forget()

    def _no_words(self) -> None:
        # word of a text -> its ids, as 32-bit numbers
        self.words: dict[str, bytes] = {s: array("i", [i]).tobytes() for s, i in self.special.items()}

    def end_task(self) -> None:
        """Give up what the next task makes anew at little cost: its words, and the merge paths of tokens."""
        self._no_words()
        self.edges: tuple[dict[str, list], dict[str, list]] = {}, {}

    @staticmethod
    def _marked(token: str) -> str:
        if token.endswith(_END) and len(token) > len(_END):
            body = token[:-len(_END)]
            return body[:-1] + chr(ord(body[-1]) + _MARK)
        return token

    def _forget(self) -> None:
        self.nodes: dict[str, list] = {}
        self.pairs = 0
        self.root = self._node("")

    def _merged(self, symbols: list[str]) -> list[str]:
        """The merge rules applied to a few symbols: lowest rank first, leftmost of equals."""
        while len(symbols) > 1:
            best, at = min((self.rank.get((a, b), 1 << 60), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)))
            if best == 1 << 60:
                break
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def _edge(self, token: str, side: int) -> list[tuple[str, int]]:
        """Symbols at the left (0) or right (1) edge of a token while it is merged, from the first
        on, each with the rank of the merge that takes it up."""
        if token not in self.edges[side]:
            out, rank = [], 1 << 60
            at = token
            while True:
                out.append((at, rank))
                if at not in self.products:
                    break
                rank = self.rank[self.products[at]]
                at = self.products[at][side]
            self.edges[side][token] = out[::-1]
        return self.edges[side][token]

    def _apart(self, left: str, right: str) -> bool:
        """Do the merge rules leave ``left + right`` as these two tokens?"""
        if not self.in_order:
            return self._merged([*left, *right]) == [left, right]
        ends, starts = self._edge(left, 1), self._edge(right, 0)
        i = j = 0
        while True:
            (a, until_a), (b, until_b) = ends[i], starts[j]
            across = self.rank.get((a, b), 1 << 60)
            if across < until_a and across <= until_b and across < 1 << 60:
                return False  # the two meet before either is taken up on its own side
            if until_a == until_b == 1 << 60:
                return True
            if until_a <= until_b:
                i += 1
            else:
                j += 1

    def _node(self, text: str) -> list:
        """Automaton state of the vocabulary prefix ``text``: next states, tokens it ends in (longest first)."""
        if text not in self.nodes:
            ends = [text[i:] for i in range(len(text))]
            # per token: text, length, does it stand alone, memory of "keeps apart from a token before"
            outs = [(t, len(t), self._merged(list(t)) == [t], {}) for t in ends if t in self.tokens]
            self.nodes[text] = [{}, outs, text]
        return self.nodes[text]

    def _step(self, node: list, symbol: str) -> list:
        text = node[2] + symbol
        while text and text not in self.prefixes:
            text = text[1:]
        node[0][symbol] = out = self._node(text)
        return out

    def encode_words(self, words: set[str]) -> dict[str, list[str]]:
        """Tokens of each marked word, by one depth-first walk over the trie of the words."""
        if self.pairs > PAIR_MEMO:
            self._forget()
        out = {}
        before = ""
        nodes: list = [self.root]   # automaton state and last token of every prefix on the path
        last: list = [""]
        for word in sorted(words):
            depth = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                depth += 1
            del nodes[depth + 1:], last[depth + 1:]
            node = nodes[depth]
            for symbol in word[depth:]:
                depth += 1
                node = node[0].get(symbol) or self._step(node, symbol)
                for token, n, alone, apart in node[1]:
                    if n == depth:
                        if alone:
                            break
                        continue
                    left = last[depth - n]
                    ok = apart.get(left)
                    if ok is None:
                        self.pairs += 1
                        ok = apart[left] = self._apart(left, token)
                    if ok:
                        break
                else:
                    raise ValueError(f"no token ends {word[:depth]!r}")
                nodes.append(node)
                last.append(token)
            before = word
            at, tokens = depth, []
            while at:
                tokens.append(last[at])
                at -= len(last[at])
            tokens.reverse()
            out[word] = tokens
        return out

    def _symbols(self, piece: str) -> str:
        s = piece if piece.isascii() and piece.isalpha() else piece.encode().decode("latin-1").translate(self.table)
        return s[:-1] + chr(ord(s[-1]) + _MARK)

    def _cut(self, word: str) -> list[str] | None:
        """Pieces of a word of a text after normalisation; None: the library must cut it."""
        if word.isascii():
            low = word.lower()
            return [low] if low.isalpha() else None if _ODD_SPACE.search(low) else _ASCII_WORD.findall(low)
        if _LATIN.fullmatch(word) is None or _ODD_SPACE.search(word):
            return None
        low = unicodedata.normalize("NFC", word).lower()
        return [low] if low.isalpha() else self.latin_word.findall(low)

    def _library_cut(self, word: str) -> list[str]:
        """Symbols of the pieces of any word, normalised and cut by the library; merging is the trie's."""
        cut = self.lib.pre_tokenizer.pre_tokenize_str(self.lib.normalizer.normalize_str(word))
        return [p[:-1] + chr(ord(p[-1]) + _MARK) for p, _ in cut]

    def learn(self, words: set[str]) -> None:
        """Put the ids of all ``words`` into the memory."""
        if len(self.words) > WORD_MEMO:
            self._no_words()
        cut = {}
        for w in words.difference(self.words):
            parts = self._cut(w)
            cut[w] = self._library_cut(w) if parts is None else [self._symbols(p) for p in parts]
        tokens = self.encode_words({p for parts in cut.values() for p in parts})
        get = self.ids.__getitem__
        ids = {piece: array("i", map(get, got)).tobytes() for piece, got in tokens.items()}
        for w, parts in cut.items():
            self.words[w] = ids[parts[0]] if len(parts) == 1 else b"".join([ids[p] for p in parts])

    def split(self, text: str) -> list[str]:
        """Words of a text; special strings are words of their own."""
        if self.special_cut and "<" in text and self.special_cut.search(text):
            out = []
            for i, part in enumerate(self.special_cut.split(text)):
                out += [part] if i % 2 else _ASCII_RUNS.findall(part)
            return out
        return text.split() if _ODD_SPACE.search(text) is None else _ASCII_RUNS.findall(text)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        cut = [self.split(t) for t in texts]
        self.learn(set().union(*cut))
        get = self.words.__getitem__
        return [array("i", b"".join(map(get, words))).tolist() for words in cut]

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``; this vocabulary names no decoder, so tokens are joined by a space."""
        return " ".join([self.shown[i] for i in ids])


def _encoder(name: str) -> TrieEncoder:
    return held(f"trie {name}", lambda: TrieEncoder(tokenizer_path(name)))


def _encoded(batches: Iterator[pa.RecordBatch], vocabulary: str, digests: bool) -> Iterator[pa.RecordBatch]:
    import gc
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    enc = _encoder(vocabulary)
    gc.disable()  # many small lists and no cycles: collections would only walk the memories
    try:
        for piece in pieces(batches, _TEXT, PIECE, f"trie {vocabulary}"):
            yield _encoded_piece(enc, piece, digests)
    finally:
        enc.end_task()
        gc.enable()  # the worker is used again
        release_memory()


def _encoded_piece(enc: TrieEncoder, piece: pa.RecordBatch, digests: bool) -> pa.RecordBatch:
    got = enc.encode([t or "" for t in piece.column(_TEXT).to_pylist()])
    counts = pa.array([len(x) for x in got], pa.int64())
    if digests:
        numbers, shown = enc.number, enc.shown
        parts = [[" ".join([table[i] for i in ids]) for ids in got] for table in (numbers, shown)]
        sha = [pa.array([hashlib.sha256(x.encode()).hexdigest() for x in part], pa.string()) for part in parts]
        return pa.RecordBatch.from_arrays([piece.column(_DOC), counts, *sha], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return pa.RecordBatch.from_arrays(
        [piece.column(_DOC), counts, pa.array(got, pa.list_(pa.int32())), pa.array([enc.decode(x) for x in got], pa.string())],
        names=["doc_id", "n_tokens", "ids", "decoded"])


def encode_decode(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", *, id_col: str = "doc_id",
                  text_col: str = "text", digests: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids, decoded; or the SHA-256 of the last two.

    ``ids_sha256`` is over the decimal ids joined by one space, ``decoded_sha256`` over the decoded
    text in UTF-8.  Whole texts; null and empty texts have no ids and decode to an empty text; null
    or repeated ids and repeated rows stay as they are; other columns are not read.  Nothing is
    shuffled.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias(_DOC), F.col(f"`{text_col}`").alias(_TEXT))
    schema = "doc_id long, n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string")
    return rows.mapInArrow(lambda it: _encoded(it, vocabulary, digests), schema)

"""Byte-level BPE encoding and decoding by a prefix-sharing trie.

Distinct words go into a trie of bytes, in sorted order, which is the trie's depth-first order. Each node keeps
one number: the last token of the encoding of the prefix that ends there. It follows from the node's ancestors:
token t ends the prefix if t's bytes end it and t can stand behind the last token of the prefix before t. So a
prefix that many words share is encoded once, and a word's encoding is read off backwards along its path. The tokens
that end a prefix are listed by an Aho-Corasick automaton, so that only tokens are tried, not all byte slices.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import partial

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from siltstone.llm.wordhash import give_back, slices

#: How the byte-level scheme cuts text into words (fixed value of the public tokenizer).
WORD = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Trie nodes, bytes of distinct words, and neighbours that a Python worker keeps; beyond them it starts anew, within a slice too.
MAX_NODES, MAX_BYTES, MAX_PAIRS = 400_000, 32 << 20, 500_000
#: Words of more bytes share too little to be put into the trie.
LONG_WORD = 1024


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable Latin-1 itself, others from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(other)}


class Vocabulary:
    """Tokens and merges of a byte-level BPE file of the tokenizers library."""

    def __init__(self, text: str):
        file = json.loads(text)
        alphabet = byte_alphabet()
        raw = lambda s: bytes(alphabet[c] for c in s)
        model = file["model"]
        self.token = {raw(s): i for s, i in model["vocab"].items()}
        self.special = {x["content"]: x["id"] for x in file.get("added_tokens", ())}
        self.bytes: dict[int, bytes] = {i: b for b, i in self.token.items()} | {i: s.encode() for s, i in self.special.items()}
        self.longest = max(map(len, self.token))
        self.shift = max(self.bytes).bit_length()
        #: (left, right) as one number -> order of the merge; and for each token that a merge makes, its parts.
        self.order: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for k, m in enumerate(model["merges"]):
            a, b = map(raw, m if isinstance(m, list) else m.split(" "))
            left, right = self.token[a], self.token[b]
            self.order[left << self.shift | right] = k
            self.parts.setdefault(self.token[a + b], (k, left, right))
        #: Of bytes as Latin-1 characters: (length, token) of all tokens that end at a place.
        self.matches = ahocorasick.Automaton()
        for b, i in self.token.items():
            self.matches.add_word(b.decode("latin-1"), (len(b), i))
        self.matches.make_automaton()
        self._edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        #: What ``fits`` has said.
        self.known: dict[int, bool] = {}

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens at one end (side 1: left, 2: right) that ``token`` grew from, each with the merge that used it up."""
        found = self._edges.get((token, side))
        if found is None:
            found, used, t = [], len(self.order), token
            while True:
                found.append((t, used))
                if t not in self.parts:
                    break
                used, t = self.parts[t][0], self.parts[t][side]
            self._edges[token, side] = found
        return found

    def fits(self, key: int) -> bool:
        """Whether BPE leaves two tokens (left and right, as one number) apart, standing side by side.

        It doesn't if some merge across the border comes while both of its sides exist: before the merge that uses up
        the one to the left, and not after the one that uses up the one to the right (of equal merges the left goes first).
        """
        left, right = key >> self.shift, key & ((1 << self.shift) - 1)
        said, order, none = True, self.order, len(self.order)
        for a, a_used in self.edge(left, 2):
            for b, b_used in self.edge(right, 1):
                k = order.get(a << self.shift | b, none)
                if k < a_used and k <= b_used and k < none:
                    said = False
        if len(self.known) > MAX_PAIRS:
            self.known.clear()
        self.known[key] = said
        return said


class PrefixTrie:
    """Encodings of words, with those of shared prefixes computed once."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}
        self.last: list[int] = [-1]

    def encode_sorted(self, words: list[bytes]) -> Iterator[list[int]]:
        """The token ids of each word; words in order, so that each continues the path of the one before."""
        v = self.v
        fits, known, shift, names, longest, find = v.fits, v.known, v.shift, v.bytes, v.longest, v.matches.iter
        path, before = [0], b""
        for word in words:
            n = len(word)
            long = n > LONG_WORD
            if len(self.last) > MAX_NODES:
                self.clear()
                path, before = [0], b""
            child, last = ({}, [-1]) if long else (self.child, self.last)
            own = [0] if long else path
            k, top = 0, 0 if long else min(n, len(before))
            while k < top and word[k] == before[k]:
                k += 1
            del own[k + 1 :]
            while k < n and (below := child.get(own[k] << 8 | word[k])) is not None:
                own.append(below)
                k += 1
            if k < n:
                base = max(0, k + 1 - longest)
                done = k - base  # what is known already, from the first byte that can matter
                for end, (length, t) in find(word[base:].decode("latin-1")):
                    # of the tokens that end here, longest first, the one that fits; any shorter ones are skipped
                    if end < done:
                        continue
                    start = base + end + 1 - length
                    if start:
                        key = last[own[start]] << shift | t
                        said = known.get(key)
                        if not (fits(key) if said is None else said):
                            continue
                    done = end + 1
                    below = len(last)
                    if not long:
                        child[own[-1] << 8 | word[base + end]] = below
                    own.append(below)
                    last.append(t)
            if not long:
                before = word
            ids, end = [], n
            while end:
                t = last[own[end]]
                ids.append(t)
                end -= len(names[t])
            ids.reverse()
            yield ids


class Encoder:
    """Encodes texts as the tokenizers library does without adding special tokens; words are kept between batches."""

    def __init__(self, text: str):
        self.v = Vocabulary(text)
        self.trie = PrefixTrie(self.v)
        self.find = regex.compile(WORD, regex.V0).findall
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.v.special, key=len, reverse=True))) + ")").split if self.v.special else None
        self.digits = [str(i) for i in range(max(self.v.bytes) + 1)]
        #: Words with their ids as text, and those whose ids decode to anything but the word.
        self.ids: dict[str, str] = {}
        self.odd: dict[str, bytes] = {}
        self.clear()

    def words(self, text: str) -> list[str]:
        if self.split is None or not any(s in text for s in self.v.special):
            return self.find(text)
        return [w for part in self.split(text) if part for w in ((part,) if part in self.v.special else self.find(part))]

    def clear(self) -> None:
        """Forget all words."""
        self.trie.clear()
        self.bytes = 0
        self.ids.clear()
        self.odd.clear()
        self.ids |= {s: str(i) for s, i in self.v.special.items()}

    def learn(self, texts: list[list[str]]) -> None:
        """Encode the words of a batch that aren't known yet, and decode each again."""
        if self.bytes > MAX_BYTES:
            self.clear()
        new: set[str] = set()
        for words in texts:
            new.update(words)
        new.difference_update(self.ids)
        ordered = sorted(new)  # code points are in the order of their bytes
        raw = [w.encode() for w in ordered]
        names, digits = self.v.bytes.__getitem__, self.digits.__getitem__
        for w, b, ids in zip(ordered, raw, self.trie.encode_sorted(raw), strict=True):
            self.ids[w] = ",".join(map(digits, ids))
            if b"".join(map(names, ids)) != b:
                self.odd[w] = b"".join(map(names, ids))
            self.bytes += len(b) + 64

    def decoded(self, text: str, words: list[str]) -> bytes:
        """What the ids of a text's words decode to, which is the text itself where each word came back as it was."""
        if not self.odd:
            return text.encode()
        return _valid(b"".join([self.odd[w] if w in self.odd else w.encode() for w in words]))


_encoders: dict[str, Encoder] = {}


def encoder(text: str) -> Encoder:
    """The encoder of a vocabulary file's text; one stays with the Python worker."""
    key = hashlib.sha256(text.encode()).hexdigest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(text)
    return _encoders[key]


def _encode_batches(batches: Iterator[pa.RecordBatch], vocabulary, text_column: str, keep: list[str], with_ids: bool) -> Iterator[pa.RecordBatch]:
    e = encoder(vocabulary.value)
    for batch in batches:
        for part in slices(batch, text_column):
            texts = [t or "" for t in part.column(text_column).to_pylist()]
            split = [e.words(t) for t in texts]
            e.learn(split)
            ids = e.ids.__getitem__
            columns = {c: part.column(c) for c in keep}
            joined = [",".join(map(ids, w)) for w in split]
            columns["n_tokens"] = pa.array([j.count(",") + 1 if j else 0 for j in joined], pa.int64())
            if with_ids:
                columns["ids"] = pa.array([list(map(int, j.split(","))) if j else [] for j in joined], pa.list_(pa.int32()))
            columns["ids_sha256"] = pa.array([hashlib.sha256(j.encode()).hexdigest() for j in joined], pa.string())
            columns["decoded_sha256"] = pa.array([hashlib.sha256(e.decoded(t, w)).hexdigest() for t, w in zip(texts, split, strict=True)], pa.string())
            yield pa.RecordBatch.from_pydict(columns)
            del texts, split, joined, columns
    e.clear()  # the worker stays, and what it holds counts against the next stage
    give_back()


def _valid(raw: bytes) -> bytes:
    """As the library decodes: UTF-8, with U+FFFD where bytes aren't."""
    return raw.decode("utf-8", "replace").encode()


def tokenizer_text(path: str | None = None) -> str:
    """The text of a byte-level BPE file; by default the public one of 50,257 ids."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def bpe_encode(docs: DataFrame, tokenizer_path: str | None = None, text_column: str = "text", keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """Encode and decode each text: the columns ``keep``, n_tokens, ids (if asked), ids_sha256, decoded_sha256.

    Nulls count as empty texts: 0 tokens, the hashes of nothing. Very long texts are taken whole, in slices of
    bounded size by document. Repeated rows give repeated results; columns not in ``keep`` are left out, so
    names can't clash; an empty table gives an empty result. One narrow pass, no shuffle; what is broadcast is the
    vocabulary file, whose size doesn't depend on the data.
    """
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(tokenizer_text(tokenizer_path))
    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    schema = f"{kept}, n_tokens bigint, {'ids array<int>, ' if with_ids else ''}ids_sha256 string, decoded_sha256 string"
    run = partial(_encode_batches, vocabulary=vocabulary, text_column=text_column, keep=list(keep), with_ids=with_ids)
    return docs.select(*keep, text_column).mapInArrow(run, schema)


def _decode_batches(batches: Iterator[pa.RecordBatch], vocabulary, ids_column: str, into: str, keep: list[str]) -> Iterator[pa.RecordBatch]:
    names = encoder(vocabulary.value).v.bytes
    for batch in batches:
        texts = [b"".join([names.get(i, b"") for i in ids or ()]).decode("utf-8", "replace") for ids in batch.column(ids_column).to_pylist()]
        yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in keep} | {into: pa.array(texts, pa.string())})


def bpe_decode(encoded: DataFrame, tokenizer_path: str | None = None, ids_column: str = "ids", into: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Texts of arrays of ids, special tokens included; null arrays give empty texts, unknown ids nothing."""
    spark = encoded.sparkSession
    vocabulary = spark.sparkContext.broadcast(tokenizer_text(tokenizer_path))
    kept = ", ".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in keep)
    run = partial(_decode_batches, vocabulary=vocabulary, ids_column=ids_column, into=into, keep=list(keep))
    return encoded.select(*keep, ids_column).mapInArrow(run, f"{kept}, `{into}` string")

"""Token counts of a unigram vocabulary by a Viterbi search that keeps counts only.

An Aho-Corasick automaton lists the pieces that end at each character; for each end the search keeps the best score
and the number of pieces of the best path, no path. Ties go as in the public unigram tokenizers: paths are tried
by ascending start of their last piece, and a later one must be strictly better.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from siltstone.llm.wordhash import give_back, slices

SPACE = "▁"
#: How far below the worst piece a character without a piece scores (fixed value of the public tokenizers).
UNKNOWN_PENALTY = 10.0
#: Distinct words that a Python worker keeps between batches; beyond them it starts anew.
MAX_WORDS = 400_000
#: Longer words hardly occur again.
LONG_WORD = 64


def zipf_vocabulary(path: str | None = None) -> list[tuple[str, float]]:
    """Pieces of a sentencepiece model, in the order of their ids, with the log-probability of their rank by Zipf's law.

    The public piece model ranks its pieces but has no unigram scores, and nothing is trained here; so the score of
    rank r is -ln(r) - ln(1 + 1/2 + ... + 1/n). Control, unknown and byte pieces are left out.
    """
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    total = math.log(sum(1 / r for r in range(1, len(ids) + 1)))
    return [(model.id_to_piece(i), -math.log(r) - total) for r, i in enumerate(ids, 1)]


class Counter:
    """Counts the pieces of words; a character without a piece counts as its UTF-8 bytes (byte fallback)."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self.single = {p for p, _ in vocabulary if len(p) == 1}
        self.longest = max((len(p) for p, _ in vocabulary), default=1)
        self.known: dict[str, int] = {}

    def count(self, word: str) -> int:
        """Pieces of the best path. Only as many scores are held as the longest piece has characters, however long the word is."""
        m = self.longest + 1
        score, count, single = [0.0] * m, [0] * m, self.single
        matches = self.automaton.iter(word)
        ahead = next(matches, None)
        for end, char in enumerate(word, 1):
            best, found = None, []
            while ahead is not None and ahead[0] < end:
                found.append(ahead[1])
                ahead = next(matches, None)
            if len(found) > 1:
                found.sort(reverse=True)  # longest first: ascending starts
            for length, value in found:
                at = (end - length) % m
                total = value + score[at]
                if best is None or total > best:
                    best, pieces = total, count[at] + 1
            if char not in single:
                at = (end - 1) % m
                total = self.unknown + score[at]
                if best is None or total > best:
                    best, pieces = total, count[at] + len(char.encode("utf-8", "surrogatepass"))
            score[end % m], count[end % m] = best, pieces
        return count[len(word) % m]

    def text(self, text: str) -> int:
        """Spaces start words, the first word gets one if it lacks it, and words are counted apart."""
        if not text:
            return 0
        words = text.replace(SPACE, " ").split(" ")
        if not words[0] and len(words) > 1:
            del words[0]
        known, total = self.known, 0
        for w in words:
            n = known.get(w)
            if n is None:
                n = self.count(SPACE + w)
                if len(w) <= LONG_WORD:
                    known[w] = n
            total += n
        if len(known) > MAX_WORDS:
            known.clear()
        return total


_counters: dict[int, Counter] = {}


def _count(batches: Iterator[pa.RecordBatch], vocabulary, text_column: str, keep: list[str]) -> Iterator[pa.RecordBatch]:
    key = hash(tuple(vocabulary.value))
    if key not in _counters:
        _counters.clear()
        _counters[key] = Counter(vocabulary.value)
    counter = _counters[key]
    for batch in batches:
        for part in slices(batch, text_column):
            counts = [counter.text(t or "") for t in part.column(text_column).to_pylist()]
            yield pa.RecordBatch.from_pydict({c: part.column(c) for c in keep} | {"n_tokens": pa.array(counts, pa.int64())})
    counter.known.clear()  # the worker stays, and what it holds counts against the next stage
    give_back()


def token_counts(docs: DataFrame, vocabulary: list[tuple[str, float]] | None = None, text_column: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The number of unigram pieces of each whole text: the columns ``keep`` and n_tokens.

    Nulls and empty texts have 0; very long texts are taken whole; of paths with equal scores the one whose last piece begins first counts;
    repeated rows repeat; columns not in ``keep`` are left out, so names can't clash; an empty table gives an empty result. One narrow pass; the broadcast vocabulary doesn't grow with the data.
    """
    shared = docs.sparkSession.sparkContext.broadcast(zipf_vocabulary() if vocabulary is None else vocabulary)
    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, text_column).mapInArrow(partial(_count, vocabulary=shared, text_column=text_column, keep=list(keep)), f"{kept}, n_tokens bigint")

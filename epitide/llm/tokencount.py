"""Token counts under a unigram vocabulary, without building any token.

Inside a task an Aho-Corasick automaton over the pieces lists all pieces that end at each character of a word, longest
first. A dynamic programme over the characters carries the best score and the number of pieces of the best split: a
later candidate replaces an earlier one only if its score is strictly higher, so that of equal splits the one with the
longest last piece stays, as in the tokenizers library. A character that is no piece itself may stand alone at the
lowest score less 10; with byte fallback it counts as its UTF-8 bytes, else a run of such characters counts once.
Words begin at a space (or its mark), so each distinct word is counted once per worker while it is remembered.

The public vocabularies at hand hold merge ranks, not probabilities, and tokenizers are never trained here. A vocabulary
read from a rank file therefore gets its log-probabilities from Zipf's law over the ranks; a vocabulary with scores of its
own can be passed as it is.

Defined cases: null and empty texts have no tokens; words of any length are counted whole; a null id is kept; repeated
rows come out repeatedly; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from epitide.llm.common import batches_of, pick

MARK = "▁"  # stands for a space at the start of a word
KNOWN = 500_000  # words whose count a worker remembers
UNKNOWN_PENALTY = 10.0


@dataclass(frozen=True)
class Vocabulary:
    """(piece, score) in id order, the id of the unknown piece, and whether unknown characters fall back to bytes."""

    pieces: tuple[tuple[str, float], ...]
    unknown: int = 0
    byte_fallback: bool = False


def from_ranks(path: str) -> Vocabulary:
    """Pieces of a sentencepiece file in rank order, with Zipf's law as their scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    own = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in ids]
    n = sum(own)
    total = math.log(sum(1 / (r + 2.7) for r in range(n)))
    pieces, rank = [], 0
    for i in ids:
        # Control and byte pieces are reached by no text but their own name; they get the lowest score.
        pieces.append((model.id_to_piece(i), -math.log((rank if own[i] else n) + 2.7) - total))
        rank += own[i]
    return Vocabulary(tuple(pieces), model.unk_id(), any(model.is_byte(i) for i in ids))


class Counter(dict):
    """Number of tokens by word; missing words are counted by the dynamic programme."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in vocabulary.pieces) - UNKNOWN_PENALTY
        names = {piece for piece, _ in vocabulary.pieces}
        self.bytes = vocabulary.byte_fallback and all(f"<0x{b:02X}>" in names for b in range(256))

    def __missing__(self, word: str) -> int:
        if len(self) > KNOWN:
            self.clear()
        found = self[word] = self.count(word)
        return found

    def count(self, word: str) -> int:
        best, pieces, loose = [0.0], [0], [False]
        matches = self.automaton.iter(word)
        end, match = next(matches, (-1, None))
        for i, char in enumerate(word):
            score = n = None
            single = unknown = False
            while end == i:
                length, own = match
                candidate = own + best[i + 1 - length]
                if score is None or candidate > score:
                    score, n = candidate, pieces[i + 1 - length] + 1
                single = length == 1
                end, match = next(matches, (-1, None))
            if not single:
                candidate = self.unknown + best[i]
                if score is None or candidate > score:
                    score, unknown = candidate, True
                    n = pieces[i] + (len(char.encode()) if self.bytes else not loose[i])
            best.append(score)
            pieces.append(n)
            loose.append(unknown)
        return pieces[-1]

    def of(self, text: str | None) -> int:
        if not text:
            return 0
        words = text.replace(" ", MARK).split(MARK)
        if not words[0]:
            del words[0]
        return sum(map(self.__getitem__, [MARK + w for w in words]))


_COUNTERS: dict[str, Counter] = {}


def token_counts(df: DataFrame, id: str, text: str, vocabulary: str) -> DataFrame:
    """(id, n_tokens) of every row; `vocabulary` is the path of a rank file that every worker can read. No shuffle."""
    rows = pick(df, id=id, text=text)
    kind = rows.schema["id"].dataType.simpleString()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _COUNTERS:
            _COUNTERS[vocabulary] = Counter(from_ranks(vocabulary))
        of = _COUNTERS[vocabulary].of
        for batch in batches_of(batches):
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([of(t) for t in batch.column("text").to_pylist()], pa.int64())], ["id", "n_tokens"])

    return rows.mapInArrow(counted, f"id {kind}, n_tokens bigint")

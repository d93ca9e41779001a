"""Token counts of a unigram model, computed once for each shared prefix of the words."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import DataFrame

from signalframe.llm.common import map_texts

#: Nodes of a task's trie; a full trie is given up for a new one.
NODES = 300_000
#: Longer words are cut where no piece can cross; longer parts go through the same steps without being stored.
LONGEST_STORED = 48
#: Sign that starts every word.
START = "▁"
#: What a character that no piece covers scores below the least of the pieces.
UNKNOWN = 10.0


def vocabulary(path: str) -> dict[str, float]:
    """Pieces of a published vocabulary file, with the logarithm of a probability that falls with the rank by Zipf's law.

    Read once, on the driver; the size is that of the file.  Control, unknown
    and byte pieces are left out; the last are no text, see ``has_bytes``.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(k) for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k))]
    total = math.log(sum(1 / (k + 2) for k in range(len(pieces))))
    return {piece: -math.log(k + 2) - total for k, piece in enumerate(pieces)}


def has_bytes(path: str) -> bool:
    """Whether a vocabulary file has byte pieces, so that an uncovered character is written by its UTF-8 bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return any(model.is_byte(k) for k in range(model.get_piece_size()))


class Trie:
    """Distinct words by their prefixes; a node keeps the best score, and the tokens of it, of the prefix that it is.

    The score of a prefix depends on the prefix alone, so words that share one
    share its nodes, and each is computed once.  Of equal scores the one with
    fewer tokens wins.  A character that no piece covers is as many tokens as
    it has UTF-8 bytes, or one if the vocabulary has no bytes.
    """

    def __init__(self, pieces: dict[str, float], by_bytes: bool = True):
        self.pieces, self.by_bytes = pieces, by_bytes
        self.neighbours = {piece[k : k + 2] for piece in pieces for k in range(len(piece) - 1)}
        # lengths of the pieces that end in one, two or three characters, longest first: no other is looked up
        ends: dict[str, set[int]] = {}
        for piece in filter(None, pieces):
            ends.setdefault(piece[-3:], set()).add(len(piece))
        self.lengths = {e: tuple(sorted(ends[e].union(*[ends.get(e[k:], ()) for k in (1, 2)]), reverse=True)) for e in ends}
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN
        self.clear()

    def clear(self) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.score, self.tokens = [0.0], [0]
        self.counts: dict[str, int] = {}

    def step(self, word: str, end: int, score: list[float], tokens: list[int]) -> tuple[float, int]:
        """Best score and tokens of word[:end], given those of all shorter prefixes; ``score[j]`` is that of word[:j]."""
        last = word[end - 1]
        best = score[end - 1] + self.unknown
        least = tokens[end - 1] + (1 if last < "\x80" or not self.by_bytes else len(last.encode("utf-8", "surrogatepass")))
        pieces, lengths = self.pieces, self.lengths
        found = lengths.get(word[end - 3 : end]) if end > 2 else None
        if found is None:
            found = lengths.get(word[end - 2 : end]) if end > 1 else None
            if found is None:
                found = lengths.get(last, ())
        for length in found:
            if length <= end and (value := pieces.get(word[end - length : end])) is not None:
                start = end - length
                value += score[start]
                if value > best or value == best and tokens[start] + 1 < least:
                    best, least = value, tokens[start] + 1
        return best, least

    def count(self, word: str) -> int:
        """Tokens of the best segmentation of a word (with its start sign).

        A long one, such as a line of a script without spaces, is cut first
        where two characters meet that stand together in no piece: no token
        spans such a place, so the parts add up to the whole.
        """
        if len(word) <= LONGEST_STORED:
            return self.part(word)
        cuts = [0, *(k for k in range(1, len(word)) if word[k - 1 : k + 1] not in self.neighbours), len(word)]
        return sum([self.part(word[a:b]) for a, b in zip(cuts, cuts[1:])])

    def part(self, word: str) -> int:
        """Tokens of the best segmentation of a text that is not cut further."""
        if (known := self.counts.get(word)) is not None:
            return known
        stored = len(word) <= LONGEST_STORED
        if stored and len(self.score) > NODES:
            self.clear()
        node, score, tokens = 0, [0.0], [0]
        for end in range(1, len(word) + 1):
            following = self.children[node].get(word[end - 1]) if node >= 0 else None
            if following is None:
                best, least = self.step(word, end, score, tokens)
                if stored:
                    following = len(self.score)
                    self.children[node][word[end - 1]] = following
                    self.children.append({})
                    self.score.append(best)
                    self.tokens.append(least)
                else:
                    following = -1
            else:
                best, least = self.score[following], self.tokens[following]
            score.append(best)
            tokens.append(least)
            node = following
        if stored:
            self.counts[word] = tokens[-1]
        return tokens[-1]


def token_counts(docs: DataFrame, pieces: dict[str, float], by_bytes: bool = True) -> DataFrame:
    """doc_id, n_words and n_tokens of every document (doc_id, text) under a unigram vocabulary.

    Words are what white space parts, each with the start sign before it.
    A task puts the distinct words of a batch into its trie, whose terminal
    counts are multiplied by the words' occurrences.  Memory is bounded by NODES
    and by the batch; nothing is shuffled.  Null, empty and blank texts count
    0; rows that repeat are all counted.  Characters that no piece covers
    are a token for each of their UTF-8 bytes, or one each without ``by_bytes``.
    """
    tries: list[Trie] = []

    def step(texts: list[str]) -> dict[str, object]:
        if not tries:
            tries.append(Trie(pieces, by_bytes))
        trie, words, tokens = tries[0], [], []
        split = [Counter(t.split()) for t in texts]
        counts = _counted(trie, set().union(*split))
        for found in split:
            words.append(found.total())
            tokens.append(sum([counts[w] * n for w, n in found.items()]))
        return {"n_words": words, "n_tokens": tokens}

    return map_texts(docs.select("doc_id", "text"), step, "n_words long, n_tokens long")


def _counted(trie: Trie, words: Iterable[str]) -> dict[str, int]:
    # in order, so that words that share nodes follow each other
    return {w: trie.count(START + w) for w in sorted(words)}

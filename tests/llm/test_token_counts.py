import random

import pytest
from samples import AWKWARD, documents, prose
from tokenizers import Tokenizer
from tokenizers.models import Unigram

from signalframe.llm import token_counts as t
from signalframe.llm.queries import VOCABULARY


@pytest.fixture(scope="module")
def pieces():
    return t.vocabulary(VOCABULARY)


def brute(pieces, word):
    """Least tokens among all segmentations of the best score."""
    best = {0: (0.0, 0)}
    worst = min(pieces.values()) - t.UNKNOWN
    for end in range(1, len(word) + 1):
        found = [(best[s][0] + pieces[word[s:end]], best[s][1] + 1) for s in range(end) if word[s:end] in pieces]
        found.append((best[end - 1][0] + worst, best[end - 1][1] + len(word[end - 1].encode())))
        best[end] = max(found, key=lambda x: (x[0], -x[1]))
    return best[len(word)][1]


def test_equals_brute_force_and_a_published_library(pieces):
    words = set(prose(2000, 1).split()) | {"naïve", "straße", "ключ", "", "a", "aa" * 40, "z" * 300, "日本語", "\x01"}
    trie = t.Trie(pieces)
    other = Tokenizer(Unigram([("<unk>", 0.0), *pieces.items()], 0))
    for w in words:
        assert trie.count(t.START + w) == brute(pieces, t.START + w)
    for w in (w for w in words if w.isascii() and w.isprintable()):
        assert trie.count(t.START + w) == len(other.encode(t.START + w).tokens)


def test_only_pieces_with_the_right_ending_are_looked_up(pieces):
    class Asked(dict):
        n = 0

        def get(self, *args):
            self.n += 1
            return super().get(*args)

    words = set(prose(2000, 1).split()) | {"international" * 2, "unbelievable", "zqxjkvzqxjkv"}
    asked = Asked(pieces)
    trie = t.Trie(asked)
    assert [trie.count(t.START + w) for w in words] == [t.Trie(pieces).count(t.START + w) for w in words]
    assert asked.n < 5 * (len(trie.score) - 1)


@pytest.mark.parametrize("seed", range(20))
def test_any_vocabulary_equals_brute_force(seed):
    draw = random.Random(seed)
    spell = lambda most: "".join(draw.choices("abé▁", k=draw.randint(1, most)))
    pieces = {spell(6): -draw.randint(1, 40) / 4 for _ in range(draw.randint(1, 40))}  # quarters add up exactly, so ties are ties
    trie = t.Trie(pieces)
    for w in (spell(12) for _ in range(100)):
        assert trie.count(t.START + w) == brute(pieces, t.START + w)


def test_uncovered_characters_are_written_by_their_bytes(pieces):
    assert t.has_bytes(VOCABULARY)
    words = ["\u0294\u02a8\u0298", "\u9f98\u9750", "\ufb03", "a\ufb03b", "\U00020000", "naïve"]
    coded = [(f"<0x{k:02X}>", -100.0) for k in range(256)]
    other = Tokenizer(Unigram([("<unk>", 0.0), *pieces.items(), *coded], 0, byte_fallback=True))
    trie = t.Trie(pieces)
    assert [trie.count(t.START + w) for w in words] == [len(other.encode(t.START + w).tokens) for w in words]
    assert t.Trie(pieces, by_bytes=False).part("\ufb03") == 1


def test_long_lines_without_spaces_are_cut_where_no_piece_crosses(pieces):
    draw = random.Random(3)
    signs = [p for p in pieces if len(p) == 1 and p > "\u3040"] + ["\u9f98"]
    trie = t.Trie(pieces)
    for _ in range(20):
        line = "".join(draw.choices(signs, k=200))
        assert trie.count(t.START + line) == brute(pieces, t.START + line)
    assert len(trie.counts) > 20


def test_shared_prefixes_are_stored_once(pieces):
    trie = t.Trie(pieces)
    trie.count("abcdef")
    n = len(trie.score)
    trie.count("abcdxy")
    assert len(trie.score) == n + 2
    trie.count("x" * (t.LONGEST_STORED + 1))
    assert len(trie.score) == n + 2


def test_a_full_trie_changes_nothing(pieces, monkeypatch):
    words = prose(500, 2).split()
    want = [t.Trie(pieces).count(w) for w in words]
    monkeypatch.setattr(t, "NODES", 20)
    trie = t.Trie(pieces)
    assert [trie.count(w) for w in words] == want and len(trie.score) < 100


def test_awkward_rows(spark, pieces):
    out = t.token_counts(documents(spark, [*AWKWARD, "word"], [*range(len(AWKWARD)), None]), pieces).collect()
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in out}
    assert got[0] == got[1] == got[2] == got[3] == (0, 0) and got[4] == got[6] == got[None] and got[9][0] == 30_000
    assert len(out) == len(AWKWARD) + 1 and t.token_counts(documents(spark, []), pieces).count() == 0

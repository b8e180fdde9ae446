"""Greedy word-piece counts by a linear automaton.

The vocabulary is a trie with two roots: pieces that begin a word, and pieces that continue one. Each state has a failure
link and the number of pieces that leave the front of the state's string when the link is taken, so one pass over a word's
characters counts the pieces of its greedy longest-match segmentation without building any of them. Time is linear in the
word's length: each link taken shortens what is held.

Words are maximal runs of anything but six ASCII blanks; a word is matched with the vocabulary's word mark before it, so a
vocabulary that has the mark itself as a piece may begin any word with it. Texts are not normalised.

Defined results: a null text counts as an empty one (all zero); repeated rows give repeated rows; an empty table gives an
empty table; a word that its pieces cannot cover is one unknown piece, counted in n_unknown; texts and words of any length
are read whole; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame

from .common import SPACES, by_size, id_type, keyed_text, tokenizer_path

#: Words kept with their counts by one worker.
WORD_MEMO = 500_000
#: Fixed value: the character that marks a word's beginning in piece vocabularies.
MARK = "▁"
_WORD = re.compile(SPACES.replace("[", "[^", 1) + "+")

#: Roots of the two tries.
START, INSIDE = 0, 1


class LongestMatch:
    def __init__(self, starts: Iterable[str], insides: Iterable[str]):
        self.next: list[dict[str, int]] = [{}, {}]
        final: list[bool] = [False, False]
        for root, pieces in ((START, starts), (INSIDE, insides)):
            for piece in pieces:
                at = root
                for char in piece:
                    to = self.next[at].get(char)
                    if to is None:
                        to = self.next[at][char] = len(self.next)
                        self.next.append({})
                        final.append(False)
                    at = to
                final[at] = at > INSIDE
        #: -1: no way on from here; popped[s]: pieces that leave when state s fails over to link[s], a state inside a word.
        self.link, self.popped = [-1] * len(self.next), [0] * len(self.next)
        queue = deque([INSIDE, START])
        while queue:
            parent = queue.popleft()
            for char, state in self.next[parent].items():
                queue.append(state)
                if final[state]:
                    self.link[state], self.popped[state] = INSIDE, 1
                    continue
                back, count = self.link[parent], self.popped[parent]
                while back >= 0 and char not in self.next[back]:
                    count += self.popped[back]
                    back = self.link[back]
                if back >= 0:
                    self.link[state], self.popped[state] = self.next[back][char], count

    def count(self, word: str) -> int:
        """Pieces of the greedy segmentation; -1 if some part cannot be covered."""
        state, total, step, link, popped = START, 0, self.next, self.link, self.popped
        for char in word:
            while (to := step[state].get(char)) is None:
                if link[state] < 0:
                    return -1
                total += popped[state]
                state = link[state]
            state = to
        while state > INSIDE:
            if link[state] < 0:
                return -1
            total += popped[state]
            state = link[state]
        return total


def word_pieces(path: str) -> tuple[list[str], list[str]]:
    """(pieces that begin a word, mark included; pieces that continue one); control, byte and unknown pieces are none."""
    import sentencepiece

    tool = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [tool.id_to_piece(k) for k in range(tool.get_piece_size()) if not (tool.is_control(k) or tool.is_byte(k) or tool.is_unknown(k) or tool.is_unused(k))]
    return [p for p in pieces if p.startswith(MARK)], [p for p in pieces if MARK not in p]


class WordCounter:
    def __init__(self, path: str):
        self.automaton = LongestMatch(*word_pieces(path))
        self.memo: dict[str, int] = {}

    def __call__(self, text: str) -> tuple[int, int, int]:
        memo, total, unknown, words = self.memo, 0, 0, _WORD.findall(text)
        if len(memo) > WORD_MEMO:
            memo.clear()
        for word in words:
            n = memo.get(word)
            if n is None:
                n = self.automaton.count(MARK + word)
                if len(word) <= 64:
                    memo[word] = n
            if n < 0:
                unknown += 1
                n = 1
            total += n
        return len(words), total, unknown


_COUNTERS: dict[str, WordCounter] = {}


def count_tokens(docs: DataFrame, vocabulary: str = "piece_bpe_32k.model", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_words, n_tokens, n_unknown; one row for each input row, no shuffle."""
    frame = keyed_text(docs, id_col, text_col)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        path = tokenizer_path(vocabulary)
        if path not in _COUNTERS:
            _COUNTERS[path] = WordCounter(path)
        counter = _COUNTERS[path]
        for whole in batches:
            for batch, texts in by_size(whole, 1):
                rows = [(len((x or "").encode()), *counter(x or "")) for x in texts]
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(4))], ["doc_id", "n_bytes", "n_words", "n_tokens", "n_unknown"])

    return frame.mapInArrow(run, f"doc_id {id_type(frame, 'doc_id')}, n_bytes bigint, n_words bigint, n_tokens bigint, n_unknown bigint")

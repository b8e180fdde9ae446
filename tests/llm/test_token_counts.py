import random
import re

import public_tokenizers

from deltafolio.llm import token_counts as tc


def greedy(word, starts, insides):
    """The longest piece at each place, the mark before the word; -1 if there is none at some place."""
    at, n = 0, 0
    while at < len(word):
        own = starts if at == 0 else insides
        end = next((e for e in range(len(word), at, -1) if word[at:e] in own), None)
        if end is None:
            return -1
        at, n = end, n + 1
    return n


def test_automaton_like_greedy_search():
    r = random.Random(1)
    for _ in range(400):
        make = lambda most: {"".join(r.choice("abc") for _ in range(r.randint(1, 6))) for _ in range(r.randint(0, most))}
        starts, insides = {"_" + p for p in make(8)} | ({"_"} if r.random() < 0.5 else set()), make(10)
        automaton = tc.LongestMatch(starts, insides)
        for _ in range(40):
            word = "_" + "".join(r.choice("abc") for _ in range(r.randint(1, 14)))
            assert automaton.count(word) == greedy(word, starts, insides), (word, starts, insides)


def test_time_is_linear_where_greedy_search_is_not():
    automaton = tc.LongestMatch({"_a"}, {"a" * n for n in range(1, 60)} | {"a" * 80 + "b"})
    assert automaton.count("_" + "a" * 200_001) == 1 + -(-200_000 // 59)


def plain(rows):
    starts, insides = map(set, tc.word_pieces(public_tokenizers.path("piece_bpe_32k.model")))
    assert len(starts) > 10_000 and len(insides) > 10_000
    out = []
    for k, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        counts = [greedy(tc.MARK + w, starts, insides) for w in words]
        out.append((k, len((text or "").encode()), len(words), sum(max(n, 1) for n in counts), sum(n < 0 for n in counts)))
    return sorted(out)


def test_documents_like_greedy_search(documents):
    assert sorted(map(tuple, tc.count_tokens(documents).collect())) == plain([(r["doc_id"], r["text"]) for r in documents.collect()])


def test_odd_rows(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert sorted(map(tuple, tc.count_tokens(odd_docs).collect())) == plain(rows)
    assert tc.count_tokens(no_docs).collect() == []

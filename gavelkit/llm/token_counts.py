"""Token counts under a unigram vocabulary, by a trie of distinct pre-tokens that share forward scores.

A pre-token is a run of characters that aren't white space, with a boundary mark before it. The distinct pre-tokens of a
batch are put in a trie; a walk through it carries the best score and token count of each prefix, so a prefix that many
pre-tokens share is scored once, and each terminal keeps its counts for all texts that hold it.

The vocabulary is a public file's. Its entries are ranked by frequency, so an entry's probability is taken as falling with
its rank: log p = -log(rank + 1) - log H. Nothing is trained.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelkit.llm.common import BoundedCache

MARK = "▁"
_KIND = pa.struct([("n_pretokens", pa.int64()), ("n_tokens", pa.int64()), ("log_prob", pa.float64())])


class UnigramTrie:
    """Forward scores over a vocabulary of log probabilities; ``unknown`` is the score of a byte that no entry covers."""

    def __init__(self, scores: dict[str, float], unknown: float, keep: int = 800_000):
        self.scores, self.unknown = scores, unknown
        self.longest = max(map(len, scores), default=1)
        self.automaton = ahocorasick.Automaton()
        for entry, score in scores.items():
            self.automaton.add_word(entry, (len(entry), score))
        self.automaton.make_automaton()
        self.terminals: BoundedCache = BoundedCache(keep)

    def extend(self, word: str, shared: int, best: list[float], count: list[int]) -> None:
        """Append best score and token count of each prefix of ``word`` longer than ``shared``; ties go to fewer tokens."""
        at = shared
        for last, (size, s) in self.automaton.iter(word, max(0, shared + 1 - self.longest)):
            end = last + 1
            if end <= shared:
                continue
            while at < end:
                if at > shared and best[at] == -math.inf:
                    self.uncovered(word, at, best, count)
                at += 1
                best.append(-math.inf)
                count.append(0)
            x, n = best[end - size] + s, count[end - size] + 1
            if x > best[end] or x == best[end] and n < count[end]:
                best[end], count[end] = x, n
        while at < len(word):
            if at > shared and best[at] == -math.inf:
                self.uncovered(word, at, best, count)
            at += 1
            best.append(-math.inf)
            count.append(0)
        if at > shared and best[at] == -math.inf:
            self.uncovered(word, at, best, count)

    def uncovered(self, word: str, end: int, best: list[float], count: list[int]) -> None:
        """The character before ``end`` is in no entry: its bytes are tokens."""
        n = len(word[end - 1].encode())
        best[end], count[end] = best[end - 1] + n * self.unknown, count[end - 1] + n

    def insert(self, words: set[str]) -> dict[str, tuple[int, float]]:
        """Token count and score of each word: a walk through their trie in depth-first order.

        Sorted words are that order; what two neighbours share is the path that stays on the stack.
        """
        best, count, before, out = [0.0], [0], "", {}
        for w in sorted(words):
            shared = len(os.path.commonprefix((before, w)))
            del best[shared + 1 :], count[shared + 1 :]
            self.extend(w, shared, best, count)
            out[w], before = (count[-1], best[-1]), w
        return out

    def batch(self, texts: list[str | None]) -> list[tuple[int, int, float]]:
        """Pre-tokens, tokens and log probability of each text."""
        words = [[] if t is None else t.split() for t in texts]
        fresh = {w for ws in words for w in ws} - self.terminals.keys()
        made = {w[len(MARK) :]: v for w, v in self.insert({MARK + w for w in fresh}).items()}
        old = self.terminals
        out = []
        for ws in words:
            n, score = 0, []
            for w in ws:
                x = made.get(w) or old[w]
                n += x[0]
                score.append(x[1])
            out.append((len(ws), n, math.fsum(score)))
        if len(old) + len(made) > old.limit:
            old.clear()
        for w, x in made.items():
            old.keep(w, x)
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> UnigramTrie:
    """One trie a Python worker; the terminals that it keeps are bounded in number and outlive a task."""
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
    whole = math.log(sum(1 / (k + 1) for k in range(len(plain))))
    scores = {m.id_to_piece(i): -math.log(k + 1) - whole for k, i in enumerate(plain)}
    return UnigramTrie(scores, -math.log(len(plain) + 1) - whole - math.log(256))


def batches(texts: pa.Array, chars: int = 4_000_000):
    """Texts of an Arrow batch in runs of about ``chars`` bytes, so that a batch of long texts stays small in Python."""
    run, size = [], 0
    for x in texts:
        run.append(t := x.as_py())
        size += len(t or "")
        if size >= chars:
            yield run
            run, size = [], 0
    if run:
        yield run


def token_counts(text: Column, path: str) -> Column:
    """Struct of n_pretokens, n_tokens and log_prob of each text's best segmentation.

    Null and empty texts, and those of white space alone, count 0 with log_prob 0. Texts are counted whole. A character
    that no entry covers counts as its UTF-8 bytes.
    """

    @F.arrow_udf("n_pretokens bigint, n_tokens bigint, log_prob double")
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        trie = vocabulary(path)
        names = [f.name for f in _KIND]
        for part in parts:
            rows = [dict(zip(names, x, strict=True)) for texts in batches(part) for x in trie.batch(texts)]
            yield pa.array(rows, type=_KIND)

    return run.asNondeterministic()(text)


def with_token_counts(df: DataFrame, path: str, text: str = "text", out: str = "counts") -> DataFrame:
    """``df`` with a struct column ``out`` of its counts; every row stays."""
    return df.withColumn(out, token_counts(F.col(text), path))

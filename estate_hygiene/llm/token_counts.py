"""Token counts by dynamic programming over a trie of the distinct pre-tokens.

A pre-token is a word with the mark of a word's start. Its best segmentation under a unigram model is the one whose
pieces' log-probabilities add up to the most, and among equal ones that of fewest pieces. Of each batch the distinct
pre-tokens are walked as a trie, depth first: in sorted order, a pre-token starts where it leaves the path of the one
before, so the forward scores of a shared prefix are computed once; at a terminal the number of pieces is kept. A text's
count is the sum over its pre-tokens.

The vocabulary is that of a public tokenizer whose file gives its pieces in order of rank, not with probabilities. Zipf's
law over the ranks stands for them: log p = -log(rank + 1), in thousandths. A character of no piece falls back to its
UTF-8 bytes, one token each, at PENALTY below the rarest piece.

Rows: a null or empty text has no tokens; all rows are counted, whatever their other columns.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate_hygiene.llm.annotate import annotated, texts_of

MARK = "▁"
UNIT, PENALTY = 1_000, 10_000
#: A score and a number of pieces in one integer; a pre-token has fewer pieces than this.
SHIFT = 1 << 24


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """The pieces of a vocabulary with their scores, a piece's own count of one taken off."""

    def __init__(self, ranked: list[str]):
        self.value = {p: -round(UNIT * math.log(rank + 1)) * SHIFT - 1 for rank, p in enumerate(ranked, start=1) if p}
        self.longest = max(map(len, self.value), default=0)
        self.fallback = -(round(UNIT * math.log(len(ranked) + 1)) + PENALTY)

    @classmethod
    def load(cls, path: str) -> "Pieces":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        return cls([model.id_to_piece(i) for i in every if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))])

    def spelled(self, character: str) -> int:
        n = len(character.encode("utf-8", "surrogatepass"))
        return self.fallback * n * SHIFT - n

    def counts(self, words: list[str]) -> dict[str, int]:
        """The number of tokens of each distinct word, walking their trie in sorted order."""
        value, longest, found = self.value, self.longest, {}
        path, best = "", [0]
        for word in sorted(words):
            token = MARK + word
            same, most = 0, min(len(path), len(token))
            while same < most and path[same] == token[same]:
                same += 1
            del best[same + 1 :]
            for end in range(same + 1, len(token) + 1):
                score = best[end - 1] + self.spelled(token[end - 1]) if token[end - 1] not in value else None
                for start in range(max(0, end - longest), end):
                    own = value.get(token[start:end])
                    if own is not None and (score is None or best[start] + own > score):
                        score = best[start] + own
                best.append(score)
            path = token
            found[word] = -best[-1] % SHIFT
        return found


def with_token_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Rows of ``docs`` (text and any others, which stay) with n_pretokens and n_tokens."""
    path = vocabulary or default_vocabulary()

    def make() -> Callable[[pa.RecordBatch], dict[str, list]]:
        pieces = Pieces.load(path)

        def count(batch: pa.RecordBatch) -> dict[str, list]:
            split = [t.split() for t in texts_of(batch)]
            distinct = set().union(*split)
            by_word = pieces.counts([w.decode() for w in distinct])
            known = {w: by_word[w.decode()] for w in distinct}
            return {"n_pretokens": [len(s) for s in split], "n_tokens": [sum(map(known.__getitem__, s)) for s in split]}

        return count

    return annotated(docs.withColumn("text", F.col("text").cast("string")), make, "n_pretokens long, n_tokens long")

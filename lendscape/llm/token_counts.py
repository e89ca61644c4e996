"""Token counts under a unigram vocabulary.

The distinct pre-tokens of a batch are walked in sorted order, which is a
depth-first walk of their trie: the best segmentation of a prefix is computed
once and kept while the walk stays below it. What a terminal holds (score and
number of tokens) is stored, and documents add up their pre-tokens.

Nothing is shuffled; a worker's store of terminals is bounded by ``STORE``
entries and emptied when full, which changes no result.

Defined cases: a NULL text has no tokens; pre-tokens are words between ASCII
white space with the vocabulary's word mark in front; a character without a
piece costs one token per byte; of equal scores the one with fewer tokens wins;
repeated rows are counted one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscape.llm.common import table, text_of

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
STORE = 500_000
RESULT = "doc_id long, n_pre_tokens long, n_tokens long, score double"


def load_pieces(path: str = VOCABULARY) -> dict[str, float]:
    """Pieces and log probabilities.

    The file ranks its pieces by use but gives no probabilities: they follow
    from the rank by Zipf's law.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    plain = [
        model.id_to_piece(i) for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    total = math.log(sum(1 / r for r in range(1, len(plain) + 1)))
    return {piece: -math.log(rank) - total for rank, piece in enumerate(plain, 1)}


class Terminals:
    """Scores and token counts of pre-tokens under a vocabulary."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        self.byte = min(pieces.values(), default=0.0) - math.log(256)
        self.known: dict[str, tuple[float, int]] = {}

    def add(self, words: Iterable[str]) -> None:
        """Walk sorted ``words``; forward states of a shared prefix are computed once."""
        pieces, longest = self.pieces, self.longest
        path, states = "", [(0.0, 0)]  # score and minus the number of tokens, per prefix
        for word in words:
            marked = MARK + word
            shared, most = 0, min(len(path), len(marked))
            while shared < most and path[shared] == marked[shared]:
                shared += 1
            del states[shared + 1 :]
            for end in range(shared + 1, len(marked) + 1):
                best = None
                for start in range(max(0, end - longest), end):
                    weight = pieces.get(marked[start:end])
                    if weight is not None:
                        score, minus = states[start]
                        option = (score + weight, minus - 1)
                        if best is None or option > best:
                            best = option
                if marked[end - 1] not in pieces:
                    n = len(marked[end - 1].encode("utf-8", "surrogatepass"))
                    score, minus = states[end - 1]
                    option = (score + n * self.byte, minus - n)
                    if best is None or option > best:
                        best = option
                states.append(best)
            path = marked
            score, minus = states[-1]
            self.known[word] = (score, -minus)


def split_words(text: str) -> list[str]:
    """Words between ASCII white space (other white space belongs to words)."""
    return [w.decode("utf-8", "surrogatepass") for w in text.encode("utf-8", "surrogatepass").split()]


def count_tokens(docs: DataFrame, pieces: dict[str, float], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_pre_tokens, n_tokens, score`` per row; ``pieces`` goes to every task once."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)  # as large as the vocabulary, whatever the input
    names = pa.schema([("doc_id", pa.int64()), ("n_pre_tokens", pa.int64()), ("n_tokens", pa.int64()), ("score", pa.float64())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = Terminals(shared.value)
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                words = [split_words(t) for t in part.column(1).to_pylist()]
                if len(store.known) > STORE:
                    store.known.clear()
                known = store.known
                store.add(sorted(set().union(*words) - known.keys()))
                found = [[known[w] for w in own] for own in words]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) for x in found], pa.int64()), pa.array([sum(n for _, n in x) for x in found], pa.int64()),
                     pa.array([math.fsum(s for s, _ in x) for x in found], pa.float64())],
                    schema=names,
                )

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(F.col(text)).alias("text")).mapInArrow(count, RESULT)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), load_pieces())

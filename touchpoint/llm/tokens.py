"""Token counts of a unigram tokenizer, without building tokens.

The vocabulary (pieces and scores) comes from a public SentencePiece file. The tokenizer marks every space by ``▁``,
puts one before the text and starts a new chunk at each mark; in a chunk it takes the segmentation with the best sum
of scores. Characters that no piece covers are taken byte by byte.

* **Matches.** An Aho-Corasick automaton over the pieces lists, for every end, all pieces that end there, longest first.
* **Count-only Viterbi.** Per end the best score and the number of pieces of its path are kept, nothing else. Ties go
  to the earlier start, which is the order in which the tokenizer meets its candidates: the first of equal scores stays.
  A character without a piece of its own costs ten less than the worst piece, and neighbouring ones form one unknown
  run, which counts its bytes.
* **Chunks are independent**, so a task counts each distinct chunk once while it remembers it (a bounded memory).
  Where all scores are whole numbers, sums are exact, so a chunk may also be cut wherever no piece can reach across: at a
  line feed that no piece contains, and between a letter and a punctuation mark that follows a letter in no piece.

Null and empty texts have no tokens. Whole texts are read; repeated rows repeat; other columns are ignored.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_CHUNKS = 300_000


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a SentencePiece file, in id order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), float(model.get_score(i))) for i in range(model.get_piece_size())]


class UnigramCounter(dict):
    """Token counts of segments; a dict, so that known segments cost one lookup."""

    def __init__(self, pieces: list[tuple[str, float]], unknown: int = 0):
        import ahocorasick

        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for i, (piece, score) in enumerate(pieces):
            if piece:
                self.automaton.add_word(piece, (len(piece), score, i == unknown))
        self.automaton.make_automaton()
        self.unknown_piece = pieces[unknown][0]
        self.unknown_score = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.cuts_lines = all(score == int(score) for _, score in pieces) and not any("\n" in piece for piece, _ in pieces)
        joined = {(a, b) for piece, _ in pieces for a, b in zip(piece, piece[1:], strict=False) if a.isalnum() and b in string.punctuation}
        bound = "".join(sorted({a for a, _ in joined if not a.isalpha()}))
        free = "".join(c for c in string.punctuation if c != "_" and not any(a.isalpha() for a, b in joined if b == c))
        self.word_end = re.compile(rf"(?<=[^\W\d_{re.escape(bound)}])(?=[{re.escape(free)}])") if free else None

    def __missing__(self, segment: str) -> int:
        if len(self) >= CACHE_CHUNKS:
            self.clear()
        count = self[segment] = self.viterbi(segment)
        return count

    def viterbi(self, segment: str) -> int:
        """Number of tokens on the best path; ``best`` has the score and ``used`` the number of pieces up to each end."""
        n = len(segment)
        best, used, singles, end = [0.0] * (n + 1), [0] * (n + 1), 0, 0
        for last, (length, score, unknown) in self.automaton.iter(segment):
            total = score + best[last + 1 - length]
            if last + 1 != end:
                end = last + 1
                best[end], used[end] = total, used[end - length] + 1
            elif total > best[end]:
                best[end], used[end] = total, used[end - length] + 1
            if length == 1:
                singles += 1
            if unknown:
                singles = -n
        return used[n] if singles == n else self.viterbi_with_unknown(segment)

    def viterbi_with_unknown(self, segment: str) -> int:
        """The same with unknown characters. A node holds score, tokens before an unknown run, bytes of the run, the run is one unknown piece."""
        n = len(segment)
        ending: list[list] = [[] for _ in range(n + 1)]
        for last, match in self.automaton.iter(segment):
            ending[last + 1].append(match)
        best: list[tuple[float, int, int, bool]] = [(0.0, 0, 0, False)]
        for end in range(1, n + 1):
            top, at, unknown, covered = None, end - 1, True, False
            for length, score, is_unknown in ending[end]:
                total = score + best[end - length][0]
                if top is None or total > top:
                    top, at, unknown = total, end - length, is_unknown
                covered |= length == 1
            if not covered:
                total = self.unknown_score + best[end - 1][0]
                if top is None or total > top:
                    top, at, unknown = total, end - 1, True
            _, closed, run, single = best[at]
            if unknown:
                best.append((top, closed, run + len(segment[at:end].encode()), run == 0 and segment[at:end] == self.unknown_piece))
            else:
                best.append((top, closed + (1 if single else run) + 1, 0, False))
        _, closed, run, single = best[n]
        return closed + (1 if single else run)

    def count(self, text: str) -> int:
        if not text:
            return 0
        marked = text.replace(" ", MARK)
        if not marked.startswith(MARK):
            marked = MARK + marked
        if self.cuts_lines and self.unknown_piece not in text:
            lines = marked.count("\n")
            if self.word_end:
                marked = self.word_end.sub("\n", marked)
            return lines + sum(map(self.__getitem__, marked.replace(MARK, "\n" + MARK).split("\n")))
        return sum(self[MARK + chunk] for chunk in marked[1:].split(MARK))


_counters: dict[str, UnigramCounter] = {}


def counter_of(model_path: str) -> UnigramCounter:
    """The counter of this Python worker, with the segments it remembers; it serves all tasks of the worker."""
    if model_path not in _counters:
        _counters[model_path] = UnigramCounter(vocabulary(model_path))
    return _counters[model_path]


def count_tokens(docs: DataFrame, model_path: str) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(model_path)
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(1)]
            sizes = [len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(list(map(counter.count, texts)), pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")

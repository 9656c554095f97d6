"""Token counts of a unigram vocabulary by Viterbi over Aho-Corasick matches, without building the tokens.

The vocabulary is a list of (piece, score), as a public tokenizer file states it. White space becomes the word mark and a mark
precedes the text. An Aho-Corasick automaton gives all pieces that end at a place, longest first; the best score and
its number of pieces are carried forward over the last few places only. Ties follow the tokenizer: of equal scores the piece that
starts first stays, and a character that is no piece costs the lowest score less ten and falls back to its bytes.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

MARK = "▁"
PENALTY = 10.0


class Counter:
    """Counts pieces of texts. Texts are cut where no piece crosses: before a mark that follows another character, and around
    characters that no piece holds. Results of short stretches are remembered, within a bound."""

    def __init__(self, pieces: list[tuple[str, float]], remembered: int = 250_000):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in reversed(pieces):  # of equal pieces the first counts
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - PENALTY
        self.longest = max(len(piece) for piece, _ in pieces)
        self.separable = not any(MARK in piece.lstrip(MARK) for piece, _ in pieces)
        # Marks in a row and what follows them; line ends and tabs that no piece holds stand alone.
        alone = "".join(re.escape(c) for c in "\n\r\t" if not any(c in piece for piece, _ in pieces))
        self.stretches = re.compile((f"[{alone}]|" if alone else "") + f"{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+")
        self.seen: dict[str, tuple[int, float, int]] = {}
        self.remembered = remembered

    def best(self, text: str) -> tuple[int, float, int]:
        """(pieces, score, bytes of unknown characters among the pieces) of the best segmentation."""
        ring = self.longest + 1
        scores, counts, lost = [0.0] * ring, [0] * ring, [0] * ring
        done, singles = 0, set()

        def settle(upto, found):
            """Carry the best segmentation to the places up to ``upto``, whose matches are given by start."""
            nonlocal done
            for at in range(done + 1, upto + 1):
                best = None
                for start, score in found if at == upto else ():
                    value = score + scores[start % ring]
                    if best is None or value > best:
                        best, pick = value, start
                    if start == at - 1:
                        singles.add(at)
                if at not in singles:
                    value = self.unknown + scores[(at - 1) % ring]
                    if best is None or value > best:
                        best, pick = value, -1
                singles.discard(at)
                slot = at % ring
                if pick < 0:
                    size = len(text[at - 1].encode("utf-8", "surrogatepass"))
                    n, off = counts[(at - 1) % ring] + size, lost[(at - 1) % ring] + size
                else:
                    n, off = counts[pick % ring] + 1, lost[pick % ring]
                scores[slot], counts[slot], lost[slot] = best, n, off
            done = upto

        place, found = 0, []
        for end, (length, score) in self.automaton.iter(text):
            if end + 1 != place:
                if place:
                    settle(place, found)
                place, found = end + 1, []
            found.append((end + 1 - length, score))
        if place:
            settle(place, found)
        settle(len(text), ())
        slot = len(text) % ring
        return counts[slot], scores[slot], lost[slot]

    def _short(self, text: str) -> tuple[int, float, int] | None:
        """As :meth:`best`, for a stretch of which every character is a piece; else None."""
        scores, counts, at, single = [0.0] * (len(text) + 1), [0] * (len(text) + 1), 0, True
        for end, (length, score) in self.automaton.iter(text):
            if end != at - 1:
                if end != at or not single:
                    return None
                at, single = end + 1, length == 1
                scores[at], counts[at] = score + scores[at - length], counts[at - length] + 1
            else:
                value = score + scores[at - length]
                if value > scores[at]:
                    scores[at], counts[at] = value, counts[at - length] + 1
                if length == 1:
                    single = True
        return (counts[at], scores[at], 0) if single and at == len(text) else None

    def count(self, text: str) -> tuple[int, float, int]:
        if not text:
            return 0, 0.0, 0
        marked = MARK + text.replace(" ", MARK)
        if not self.separable:
            return self.best(marked)
        total, score, off, seen = 0, 0.0, 0, self.seen
        for word in self.stretches.findall(marked):
            known = seen.get(word)
            if known is None:
                if len(word) <= 64:
                    known = self._short(word) or self.best(word)
                    if len(seen) >= self.remembered:
                        seen.clear()
                    seen[word] = known
                else:
                    known = self.best(word)
            total += known[0]
            score += known[1]
            off += known[2]
        return total, score, off


def vocabulary(path: str, most: int = 500_000) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece model file, without its control, unknown and byte symbols.

    Scores of a unigram file are taken as they stand. Other files state ranks only: the piece of rank r then costs
    1000 ln(r + 2), rounded, so that sums are exact. ``most`` bounds what is broadcast.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if model.get_piece_size() > most:
        raise ValueError(f"{path}: more than {most} pieces")
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    scores = [model.get_score(i) for i in ids]
    if min(scores) < -100:  # ranks, not logarithms of probabilities
        scores = [-float(round(1000 * math.log(r + 2))) for r in range(len(ids))]
    return [(model.id_to_piece(i), score) for i, score in zip(ids, scores)]


def count_tokens(docs: DataFrame, pieces: list[tuple[str, float]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_byte_tokens (tokens that are bytes of unknown characters), score; one row per row of ``docs``, in one
    pass without a shuffle. Null and empty texts have no tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def run(batches):
        counter = Counter(shared.value)
        for batch in batches:
            found = [counter.count(x) if x else (0, 0.0, 0) for x in (v.as_py() for v in batch.column("text"))]
            n, score, off = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(off, pa.int64()), pa.array(score, pa.float64())],
                names=["doc_id", "n_tokens", "n_byte_tokens", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, n_byte_tokens long, score double")

"""Byte-pair pieces of a sentencepiece model as tables, and their merges over flat arrays.

Only the model file is read; nothing of the library runs here. The model must be of the byte-pair kind with byte
fallback, without normalisation, and white space may start a piece or fill it, never follow other characters.
"""

from __future__ import annotations

import functools

import numpy as np
from sentencepiece import sentencepiece_model_pb2 as model_pb2

SPACE = "▁"
_NORMAL, _BYTE = 1, 6
NO_RANK = np.int64(1) << 40
_REPEATS = 8


class Pieces:
    """Tables of a model. Symbols below `size` are piece ids, others are characters that are no piece."""

    def __init__(self, path: str) -> None:
        model = model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        trainer, normalizer = model.trainer_spec, model.normalizer_spec
        kinds = {piece.type for piece in model.pieces}
        plain = not normalizer.precompiled_charsmap and not normalizer.remove_extra_whitespaces
        if trainer.model_type != 2 or not trainer.byte_fallback or not plain or not kinds <= {1, 2, 3, 6}:
            raise ValueError(f"not a plain byte-pair model with byte fallback: {path}")
        self.prefix = SPACE if normalizer.add_dummy_prefix else ""
        self.size = len(model.pieces)
        self.texts = [piece.piece for piece in model.pieces]
        self.kinds = np.array([piece.type for piece in model.pieces])
        normal = {p.piece: k for k, p in enumerate(model.pieces) if p.type == _NORMAL}
        self.ids = normal
        self.byte_ids = np.zeros(256, np.int64)
        for k, piece in enumerate(model.pieces):
            if piece.type == _BYTE:
                self.byte_ids[int(piece.piece[3:-1], 16)] = k
        self.end = next((k for k, p in enumerate(model.pieces) if p.piece == "</s>"), 2)
        # Rank: place of the score from the best on; equal scores share it.
        scores = np.array([-p.score for p in model.pieces])
        rank = np.searchsorted(np.unique(scores), scores).astype(np.int64)
        self.run_ids = {len(text): k for text, k in normal.items() if not text.strip(SPACE)}
        run_ids, longest = set(self.run_ids.values()), max(self.run_ids)
        self.longest_run = longest
        self._rests = [self._filled(n) for n in range(longest)]
        if self._filled(2 * longest) != [longest, longest]:
            raise ValueError("runs of white space are not filled from the left")
        if any(SPACE in text[1:] for text, k in normal.items() if k not in run_ids):
            raise ValueError("a piece has white space after other characters")
        if longest > 1:
            tied = {rank[k] for n, k in self.run_ids.items() if n > 1}
            others = max(rank[k] for text, k in normal.items() if len(text) > 1 and k not in run_ids)
            if len(tied) != 1 or min(tied) <= others:
                raise ValueError("runs of white space do not come last with one score")
        self.space = normal[SPACE]
        # Characters inside pieces that are no piece themselves are symbols of their own.
        inner = sorted({c for text in normal for c in text} - set(normal))
        self.characters = {c: k for c, k in normal.items() if len(c) == 1} | {c: self.size + k for k, c in enumerate(inner)}
        self.first_other = self.size + len(inner)
        # All ways to join two symbols to a piece. Runs of white space are filled in afterwards.
        joins = {}
        symbols = normal | self.characters
        for text, k in normal.items():
            if k not in run_ids:
                for cut in range(1, len(text)):
                    a, b = symbols.get(text[:cut]), symbols.get(text[cut:])
                    if a is not None and b is not None:
                        joins[a * self.width + b] = (rank[k], k)
        self.join_keys = np.array(sorted(joins), np.int64)
        found = [joins[key] for key in self.join_keys.tolist()]
        self.join_ranks = np.array([r for r, _ in found] + [NO_RANK], np.int64)
        self.join_ids = np.array([k for _, k in found] + [-1], np.int64)
        # A first look, by a few bits of the key, that rules most unknown pairs out.
        self._filter = np.zeros(1 << 20, bool)
        self._filter[self._slot(self.join_keys)] = True
        # Characters that stand next to each other in some piece; all others are never merged over.
        self.neighbours = {text[k : k + 2] for text in normal for k in range(len(text) - 1)}
        codes = sorted({c for text in normal for c in text})
        self.char_codes = np.array([ord(c) for c in codes], np.int64)
        self.char_symbols = np.array([self.characters[c] for c in codes], np.int64)
        pairs = sorted(ord(pair[0]) << 21 | ord(pair[1]) for pair in self.neighbours)
        self.pair_codes = np.array(pairs, np.int64)
        self.longest = max(map(len, normal))

    def _filled(self, n: int) -> list[int]:
        """Sizes of the pieces of a run of n spaces: all joins have one rank, so the leftmost is always next."""
        sizes = [1] * n
        while True:
            k = next((k for k in range(len(sizes) - 1) if sizes[k] + sizes[k + 1] in self.run_ids), None)
            if k is None:
                return sizes
            sizes[k : k + 2] = [sizes[k] + sizes[k + 1]]

    def run(self, n: int) -> list[int]:
        """Token ids of a run of n spaces."""
        whole, rest = divmod(n, self.longest_run)
        return [self.run_ids[self.longest_run]] * whole + [self.run_ids[size] for size in self._rests[rest]]

    @property
    def width(self) -> int:
        return self.size + 70000

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(44)).astype(np.int64)

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """Symbols of code points; those in no piece are -1 - code point."""
        at = np.minimum(np.searchsorted(self.char_codes, codes), len(self.char_codes) - 1)
        return np.where(self.char_codes[at] == codes, self.char_symbols[at], -1 - codes)

    def joined(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and id of the piece that two symbols make; `NO_RANK` and -1 where they make none."""
        keys = a * self.width + b
        maybe = (a >= 0) & (b >= 0)
        maybe[maybe] = self._filter[self._slot(keys[maybe])]
        at = np.full(len(keys), len(self.join_keys))
        some = np.flatnonzero(maybe)
        place = np.searchsorted(self.join_keys, keys[some])
        place[place == len(self.join_keys)] = 0
        hit = self.join_keys[place] == keys[some]
        at[some[hit]] = place[hit]
        return self.join_ranks[at], self.join_ids[at]

    def merge(self, symbols: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols after all merges, and the word of each; `words` numbers the words in order.

        Every round finds the best pair of each word and merges it, in all words at once: every place where it
        stands, from the left, if no pair that arises is as good, else the leftmost place only. Words without a
        pair leave the arrays, so rounds get shorter; they end when no pair is left.
        """
        done_symbols, done_words, done_order = [], [], []
        order = np.arange(len(symbols))
        ranks, ids = self._pairs(symbols, words)
        while len(symbols):
            starts = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
            lengths = np.diff(np.concatenate([starts, [len(words)]]))
            best = np.minimum.reduceat(ranks, starts)
            open_words = best < NO_RANK
            if not open_words.all():
                closed = np.repeat(~open_words, lengths)
                done_symbols.append(symbols[closed])
                done_words.append(words[closed])
                done_order.append(order[closed])
                keep = ~closed
                symbols, words, order, ranks, ids = (x[keep] for x in (symbols, words, order, ranks, ids))
                if not len(symbols):
                    break
                lengths, best = lengths[open_words], best[open_words]
                starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            at = self._places(ranks, ids, symbols, starts, lengths, best)
            symbols[at] = ids[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            new = np.cumsum(keep) - 1
            symbols, words, order, ranks, ids = (x[keep] for x in (symbols, words, order, ranks, ids))
            at = new[at]
            # Pairs that begin before or at a merged symbol are looked up anew.
            touched = np.unique(np.concatenate([at, at[at > 0] - 1]))
            ranks[touched], ids[touched] = self._pairs_at(symbols, words, touched)
        if not done_symbols:
            return symbols, words
        order = np.argsort(np.concatenate(done_order), kind="stable")
        return np.concatenate(done_symbols)[order], np.concatenate(done_words)[order]

    def _pairs(self, symbols: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self._pairs_at(symbols, words, np.arange(len(symbols)))

    def _pairs_at(self, symbols: np.ndarray, words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ranks, ids = np.full(len(at), NO_RANK), np.full(len(at), -1, np.int64)
        inside = np.flatnonzero(at + 1 < len(symbols))
        inside = inside[words[at[inside]] == words[at[inside] + 1]]
        ranks[inside], ids[inside] = self.joined(symbols[at[inside]], symbols[at[inside] + 1])
        return ranks, ids

    def _places(self, ranks, ids, symbols, starts, lengths, best) -> np.ndarray:
        """Where to merge in this round."""
        match = np.flatnonzero(ranks == np.repeat(best, lengths))
        word = np.searchsorted(starts, match, "right") - 1
        leading = np.concatenate([[True], word[1:] != word[:-1]])
        first = match[leading]
        if len(first) == len(match):
            return first
        counts = np.diff(np.concatenate([np.flatnonzero(leading), [len(match)]]))
        # A look at every place pays off for long repetitions only; elsewhere the next rounds do the rest.
        out = [first[counts < _REPEATS]]
        several = np.flatnonzero(counts >= _REPEATS)
        begin = np.concatenate([[0], np.cumsum(counts)[:-1]])
        for k in several:
            places = match[begin[k] : begin[k] + counts[k]]
            end = starts[word[begin[k]]] + lengths[word[begin[k]]]
            out.append(self._all_places(places, ids, symbols, ranks[places[0]], starts[word[begin[k]]], end))
        return np.sort(np.concatenate(out))

    def _all_places(self, places, ids, symbols, rank, start, end) -> np.ndarray:
        if np.any(ids[places] != ids[places[0]]):
            return places[:1]
        # From the left without overlap: every second one in a row of neighbours.
        breaks = np.concatenate([[True], np.diff(places) > 1])
        run = places - np.maximum.accumulate(np.where(breaks, places, -1))
        chosen = places[run % 2 == 0]
        merged = ids[places[0]]
        after = symbols[np.minimum(chosen + 2, end - 1)]
        before = symbols[np.maximum(chosen - 1, start)]
        one = np.full(len(chosen), merged)
        arising = [
            self.joined(before, one)[0][chosen > start],
            self.joined(one, after)[0][chosen + 2 < end],
            self.joined(one[:1], one[:1])[0],
        ]
        return chosen[:1] if np.concatenate(arising).min(initial=NO_RANK) <= rank else chosen


@functools.lru_cache(maxsize=4)
def load(path: str) -> Pieces:
    """The tables of a model, once in each Python process."""
    return Pieces(path)

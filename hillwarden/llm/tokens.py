"""Token ids of texts with a public tokenizer, with the pieces between spaces remembered."""

from __future__ import annotations

import os
import re

import numpy as np

#: A byte-level BPE of this kind starts a new token run before a space that a visible character follows,
#: and before a line feed that stands between two visible characters.
CUT = re.compile(r" (?=\S)")
ODD = re.compile(r"\s(?=\s|\Z)|\A\s")


class Encoder:
    """Ids for byte-level BPE files whose pre-tokens may start with one space.

    Cutting there never changes the ids, so each piece is encoded by the
    library once and looked up afterwards. A piece follows a space unless it
    starts with a line feed. Pieces are kept while they take up to `remember`
    bytes, about EACH more than their own for a string, its number and its ids.
    """

    EACH = 200

    def __init__(self, path: str, remember: int = 80 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = True  # their strings in a text are ordinary text
        self.lib.model._resize_cache(0)  # pieces are remembered here
        self.vocab = self.lib.get_vocab_size()
        self.width = np.zeros(self.vocab, np.int64)
        for token, i in self.lib.get_vocab().items():
            self.width[i] = len(token)  # each character of a byte-level token is a byte
        self.room = remember  # bytes left
        self.place: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1, np.int64)  # of each remembered piece in flat, and the end

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that follow a space, one after the other, and how many each has."""
        ids, sizes = [], []
        for k in range(0, len(pieces), 20_000):
            part = [w if w[0] == "\n" else " " + w for w in pieces[k : k + 20_000]]
            got = np.array(self.lib.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.cumsum(np.fromiter((len(w.encode()) for w in part), np.int64, len(part)))
            sizes.append(np.diff(np.searchsorted(np.cumsum(self.width[got]), ends) + 1, prepend=0))
            ids.append(got)
        return np.concatenate(ids), np.concatenate(sizes)

    def batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's begin (with the end)."""
        cuts = [CUT.split(t) if ODD.search(t) else t.replace("\n", " \n").split(" ") for t in texts]
        heads = [e.ids for e in self.lib.encode_batch_fast([p[0] for p in cuts], add_special_tokens=False)]
        words = [w for p in cuts for w in p[1:]]
        at = np.array([self.place.get(w, -1) for w in words], np.int64)
        flat, start, known = self.flat, self.start, len(self.place)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            # those with a line feed first: none may follow a piece that ends in white space
            order = sorted({words[i] for i in missing.tolist()}, key=lambda w: w[0] != "\n")
            new = {w: known + i for i, w in enumerate(order)}
            at[missing] = [new[words[i]] for i in missing.tolist()]
            ids, sizes = self._encode(order)
            end = int(start[-1])
            flat = np.concatenate([flat[:end], ids])
            start = np.concatenate([start, end + np.cumsum(sizes)])
            cost = np.cumsum(np.fromiter((len(w) + self.EACH for w in order), np.int64, len(order)))
            room = int(np.searchsorted(cost, self.room, "right"))
            if room:
                self.room -= int(cost[room - 1])
                self.place.update((w, known + i) for i, w in enumerate(order[:room]))
                self.start = start[: known + room + 1]
                self.flat = flat[: self.start[-1]]
        size = start[at + 1] - start[at]
        done = np.concatenate([[0], np.cumsum(size)])
        rest = flat[np.repeat(start[at] - done[:-1], size) + np.arange(done[-1])]
        of = np.cumsum([0, *(len(p) - 1 for p in cuts)])
        out, begin = [], [0]
        for i, head in enumerate(heads):
            own = rest[done[of[i]] : done[of[i + 1]]]
            out += [np.array(head, np.uint32), own]
            begin.append(begin[-1] + len(head) + len(own))
        return (np.concatenate(out) if out else np.zeros(0, np.uint32)), np.array(begin)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(path)
    return _encoders[path]

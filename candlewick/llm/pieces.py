"""The tokenizer library behind the shared cut of texts: every distinct piece goes through it once per worker.

The library's own cut leaves a piece whole, so the ids of a text are the ids of its pieces end to end.
"""

from __future__ import annotations

import functools
import itertools
import os

import numpy as np

from candlewick.llm.arrow import ranges
from candlewick.llm.pretokens import Pieces, added_tokens, byte_letters, read_spec


GROUP = 500  # pieces in a sequence
UNSPELLED = ("unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback")  # ids that are not the text's bytes


class LibraryEncoder(Pieces):
    """Remembers pieces that come again: when the memory is full, only those that two blocks have asked for stay."""

    LIMIT = 1_000_000  # remembered pieces: the library takes longer for a new one than a merge table

    def __init__(self, content: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core belongs to a task
        import tokenizers

        self.library = tokenizers.Tokenizer.from_buffer(content)
        self.library.no_truncation()
        self.library.no_padding()
        self.largest = self.library.get_vocab_size(with_added_tokens=True) - 1
        spec = read_spec(content)
        vocab = spec["model"]["vocab"]
        # a letter of the vocabulary is a byte, and the bytes of all ids are those of the text
        self.spelled = not any(spec["model"].get(k) for k in UNSPELLED) and vocab.keys() >= set(byte_letters().values())
        self.n_bytes = np.zeros(max([self.largest, *vocab.values()]) + 1, np.int64)
        self.n_bytes[list(vocab.values())] = [len(letters) for letters in vocab]
        # pieces are cut already, so the library need not look for cuts in them
        self.library.pre_tokenizer = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        super().__init__(self.encode_pieces, added_tokens(spec))

    def clear(self) -> None:
        super().clear()
        self.asked = np.zeros(0, np.int32)  # blocks that asked for a piece

    def learn(self, pieces: list[bytes], ids: np.ndarray, count: np.ndarray) -> None:
        super().learn(pieces, ids, count)
        self.asked = np.concatenate([self.asked, np.zeros(len(pieces), np.int32)])

    def look_up(self, pieces: list[bytes]) -> np.ndarray:
        if len(self.index) > self.LIMIT:
            self.forget()
        number = super().look_up(pieces)
        self.asked[number] += 1  # a block asks once for each piece
        return number

    def forget(self) -> None:
        again = self.asked > 1
        kept = np.flatnonzero(again)
        if 2 * len(kept) > self.LIMIT:
            return self.clear()
        names, count = list(itertools.compress(self.index, again.tolist())), self.count[kept]
        ids = self.ids[ranges(self.at[kept], count)]
        self.clear()
        self.learn(names, ids, count)

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces go as words of longer sequences, which costs the library less than a sequence for each.

        Its fast form does not say which word an id is from; where ids spell their bytes, their lengths tell.
        """
        words = [p.decode() for p in pieces]
        groups = [words[i : i + GROUP] for i in range(0, len(words), GROUP)]
        encode = self.library.encode_batch_fast if self.spelled else self.library.encode_batch
        found = encode(groups, is_pretokenized=True, add_special_tokens=False)
        ids = np.fromiter(itertools.chain.from_iterable(e.ids for e in found), np.uint32)
        if self.spelled:
            ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
            return ids, np.diff(np.searchsorted(np.cumsum(self.n_bytes[ids]), ends) + 1, prepend=0)
        count = [np.bincount(e.word_ids, minlength=len(g)) for e, g in zip(found, groups)]
        return ids, np.concatenate([*count, np.zeros(0, np.int64)])


@functools.lru_cache(maxsize=4)
def library_encoder(content: bytes) -> LibraryEncoder:
    return LibraryEncoder(content)

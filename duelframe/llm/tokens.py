"""Token ids of whole texts, in Arrow batches inside tasks.

The vocabulary's pre-tokenizer drops white space and never joins across it,
so a text's ids are its words' ids one after the other.  A batch is split at
ASCII white space, its distinct words are encoded once (a closing stop or
comma apart), and the ids are gathered by numpy; a bounded cache keeps words
from batch to batch.
"""

from __future__ import annotations

import os
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from duelframe.llm.common import tidy

CACHE_WORDS = 500_000
#: fixed values: Latin letters without U+0130, whose lower case is two characters
LATIN = r"A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}"
_LOADED: dict[str, tuple] = {}


class WordEncoder:
    """Encodes Arrow string columns with one tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, int] = {}                    # word -> place among the bounds
        self.ids, self.bounds = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _words(self, distinct: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, bounds, place of each word among the bounds)."""
        place = np.fromiter(map(self.known.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(place < 0)
        ids, bounds, room = self.ids, self.bounds, True
        for at in range(0, len(new), 50_000):
            some = new[at:at + 50_000]
            words = [distinct[i] for i in some.tolist()]
            coded = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
            ends = np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)))
            place[some] = len(bounds) - 1 + np.arange(len(some))
            bounds = np.concatenate([bounds, len(ids) + ends])
            ids = np.concatenate([ids, np.fromiter(chain.from_iterable(coded), np.uint32, int(ends[-1]))])
            room = room and len(self.known) + len(words) <= CACHE_WORDS
            if room:
                self.known.update(zip(words, place[some].tolist()))
                self.ids, self.bounds = ids, bounds
        return ids, bounds, place

    def _dictionary(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of distinct words, each taken as a stem and a closing stop or comma.

        The pre-tokenizer always cuts between a letter and a stop, and case
        is dropped, so "Word", "word." and "word," are encoded once.  Only
        precomposed Latin letters that stay one letter in lower case count;
        other words are their own stem.
        """
        cut = pc.match_substring_regex(words, f"[{LATIN}][.,]$")
        stem = pc.if_else(cut, pc.utf8_slice_codeunits(words, 0, -1), words)
        plain = pc.match_substring_regex(stem, f"^[{LATIN}]+$")
        stem = pc.if_else(plain, pc.utf8_lower(stem), stem).dictionary_encode()
        ids, bounds, place = self._words([*stem.dictionary.to_pylist(), ".", ","])
        which = place[stem.indices.to_numpy(zero_copy_only=False)]
        cut = cut.to_numpy(zero_copy_only=False)
        comma = pc.ends_with(words, ",").to_numpy(zero_copy_only=False)
        piece = np.empty((len(which), 2), np.int64)               # stem, then "." or "," or nothing
        piece[:, 0], piece[:, 1] = which, np.where(cut, np.where(comma, place[-1], place[-2]), -1)
        flat = piece.ravel()
        flat = flat[flat >= 0]
        out, ends = gather(ids, bounds, flat)
        per_word = 1 + cut.astype(np.int64)
        return out, ends[np.concatenate([[0], np.cumsum(per_word)])]

    def encode(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts with ``end_id`` after each (null: empty), and the texts' bounds."""
        words = pc.ascii_split_whitespace(pc.fill_null(column, "").cast(pa.large_string()))
        per_text = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = pc.list_flatten(words).dictionary_encode()
        ids, bounds = self._dictionary(coded.dictionary)
        which = coded.indices.to_numpy(zero_copy_only=False)
        flat, ends = gather(ids, bounds, which)
        stop = ends[np.cumsum(per_text)]                          # end of each text without its end id
        k = np.arange(len(per_text))
        out = np.full(len(flat) + len(per_text), end_id, np.uint32)
        keep = np.ones(len(out), bool)
        keep[stop + k] = False
        out[keep] = flat
        return out, np.concatenate([[0], stop + k + 1])


def gather(ids: np.ndarray, bounds: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces ``which`` of ``ids`` one after the other, and their bounds."""
    size = bounds[which + 1] - bounds[which]
    ends = np.concatenate([[0], np.cumsum(size)])
    return ids[np.repeat(bounds[which] - ends[:-1], size) + np.arange(ends[-1])], ends


def encoder(path: str) -> WordEncoder:
    """The encoder of a file, once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = WordEncoder(path)
        tidy()                                           # what parsing the file took
    return _LOADED[path]
